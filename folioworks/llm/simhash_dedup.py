"""SimHash near-duplicates found through Golay-code fuzzy hashing.

A fingerprint has 64 bits in three segments of 22, 21 and 21.  If two fingerprints differ in at most
four bits, the two segments with the fewest differences hold at most two of them together.  So for
each pair of segments, a fingerprint gets the pairs of Golay indices of its own two segments and of
those with one bit flipped in either: two such fingerprints share at least one of these keys, about 29
in all.  Texts meet on a key, and the distance decides.

Links are found in two passes over the keys.  The first ties every fingerprint to the smallest one on
its keys, where the distance allows, which joins dense groups at a cost linear in the keys.  The
second joins on the keys, looking only at pairs not yet joined.  So a group of many copies never
becomes all its pairs, and no link between different groups is lost.

Joins of rows that grow with the documents are merge joins by hint.  The planner takes keys for as many
bytes as the fingerprints they are made of, and written columns for what they are compressed to, and would
send them through the driver.

Defined cases: a null or blank text has fingerprint zero and is linked like any other; a text of fewer
words than a shingle is one shingle; a null ``doc_id`` stands for no document that could be linked to,
its row keeps the component of its fingerprint; rows that repeat come back as often; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioworks.llm.common import by_value, fresh_name
from folioworks.llm.components import components
from folioworks.llm.golay import Golay
from folioworks.session import written

SHINGLE = 4
MAX_BITS = 4
#: Offset and width of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints with as many rows, and the thousandth part of all, are dealt out in pieces.
HOT_ROWS, MOST_HOT, PIECES = 10_000, 1_000, 256
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit k is set if it is set in more than half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(len(words) - shingle + 1, 1)
    begin, end = starts[:n], ends[min(shingle, len(words)) - 1 :][:n]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        places = zip(begin[at : at + _CHUNK].tolist(), end[at : at + _CHUNK].tolist(), strict=True)
        hashes = np.fromiter((digest(line[a:b], 42) for a, b in places), dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the fingerprint as a long of the same 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(values, dtype=np.uint64).view(np.int64))], names=["doc_id", "fp"])

    picked = docs.select("doc_id", F.col(text).alias("text"))
    return picked.mapInArrow(run, T.StructType([picked.schema["doc_id"], T.StructField("fp", T.LongType())]))


def fuzzy_keys(rows: DataFrame) -> DataFrame:
    """Adds ``key`` to rows with ``fp``, a row for each key."""
    others = [c for c in rows.columns if c != "fp"]

    def keys_of(prints: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
        around = [code.around((prints >> np.uint64(at)) & np.uint64((1 << width) - 1), width).astype(np.int64) for at, width in SEGMENTS]
        found, rows_of = [], []
        for no, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
            left, right = around[i], around[j]
            pairs = np.concatenate([left << 12 | right[:, :1], left[:, :1] << 12 | right[:, 1:]], axis=1) | np.int64(no << 24)
            pairs.sort(axis=1)
            fresh = np.ones(pairs.shape, dtype=bool)
            fresh[:, 1:] = pairs[:, 1:] != pairs[:, :-1]
            found.append(pairs[fresh])
            rows_of.append(np.nonzero(fresh)[0])
        return np.concatenate(found), np.concatenate(rows_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                prints = part.column("fp").to_numpy().view(np.uint64)
                keys, at_row = keys_of(prints, code)
                taken = part.take(pa.array(at_row))
                yield pa.RecordBatch.from_arrays([pa.array(keys), *[taken.column(c) for c in ["fp", *others]]], names=["key", "fp", *others])

    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("fp", T.LongType()), *[rows.schema[c] for c in others]])
    return rows.select("fp", *others).mapInArrow(run, schema)


def _distance(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def linked_groups(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows (node, component) for the distinct fingerprints that have links."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the keys find fingerprints within four bits")
    keys = written(fuzzy_keys(prints.select("fp").distinct()), "fuzzy-keys")
    stars = keys.join(keys.groupBy("key").agg(F.min("fp").alias("least")).hint("merge"), "key")
    stars = stars.filter((F.col("fp") != F.col("least")) & (_distance("fp", "least") <= max_bits))
    first = components(stars.select(F.col("fp").alias("a"), F.col("least").alias("b")))
    named = prints.select("fp").distinct().join(first.hint("merge"), F.col("fp") == F.col("node"), "left")
    named = written(named.select("fp", F.coalesce("component", "fp").alias("group")), "first-groups")
    keys = fuzzy_keys(named)
    left = keys.select("key", F.col("fp").alias("fp_a"), F.col("group").alias("a"))
    right = keys.select(F.col("key").alias("key_b"), F.col("fp").alias("fp_b"), F.col("group").alias("b"))
    met = left.join(right.hint("merge"), (F.col("key") == F.col("key_b")) & (F.col("a") < F.col("b")) & (_distance("fp_a", "fp_b") <= max_bits))
    second = components(met.select("a", "b").distinct())
    group = named.join(second.withColumnRenamed("node", "_group").hint("merge"), F.col("group") == F.col("_group"), "left")
    return group.select(F.col("fp").alias("node"), F.coalesce("component", "group").alias("component"))


def _dealt(rows: DataFrame, fp: str, hot: DataFrame, pieces) -> DataFrame:
    """Rows with the pieces, dealt by ``pieces``, that a frequent fingerprint is split into; 0 for any other."""
    frequent = F.broadcast(hot.select(F.col("fp").alias("_hot")))
    return rows.join(frequent, F.col(fp) == F.col("_hot"), "left").select(*rows.columns, pieces(F.col("_hot").isNotNull()).alias("_piece"))


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable, of every row."""
    prints = written(fingerprints(docs, text, shingle), "fingerprints")
    # One row per fingerprint: equal texts meet nowhere else.
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "distinct-fingerprints")
    groups = distinct.join(linked_groups(distinct, max_bits).hint("merge"), F.col("fp") == F.col("node"))
    smallest = groups.groupBy("component").agg(F.min("first").alias("component_id"))
    named = groups.join(smallest.hint("merge"), "component").select(F.col("fp").alias("_fp"), "component_id")
    # Each of these is the thousandth part of all rows at least, so they are a thousand at most.
    total = distinct.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = distinct.filter(F.col("n") >= max(total / MOST_HOT, HOT_ROWS))
    dealt = _dealt(prints, "fp", hot, lambda is_hot: F.when(is_hot, F.pmod(F.monotonically_increasing_id(), F.lit(PIECES))).otherwise(F.lit(0)))
    copies = _dealt(named, "_fp", hot, lambda is_hot: F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(PIECES - 1))).otherwise(F.array(F.lit(0)))))
    copies = copies.select("_fp", "component_id", F.col("_piece").cast("bigint").alias("_own"))
    return dealt.join(copies.hint("merge"), (F.col("fp") == F.col("_fp")) & (F.col("_piece") == F.col("_own"))).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """One row of each group, the one with the smallest doc_id, with the columns it came with.

    Rows are told apart by the hashes of all their columns, so rows that share a doc_id, or have none, are
    rows of their own; a row without a doc_id stays only where its group has no other.  Of rows that agree
    in all columns, one stays.
    """
    names = [fresh_name(docs, n) for n in ("_row_a", "_row_b")]
    hashed = docs.withColumns({n: F.xxhash64(F.lit(i), *docs.columns) for i, n in enumerate(names)})
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), *[F.col(n).alias(x) for n, x in zip(names, "ab", strict=True)])
    firsts = near_duplicates(hashed.select(place.alias("doc_id"), "text"), max_bits, shingle)
    firsts = firsts.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(*[F.col(f"doc_id.{x}").alias(n) for n, x in zip(names, "ab", strict=True)])
    kept = hashed.join(written(firsts.distinct(), "kept-rows").hint("merge"), names, "left_semi")
    return kept.dropDuplicates(names).select(*docs.columns)


by_value(__name__)
