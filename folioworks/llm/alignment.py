"""Alignment of two tokenizers over the same bytes, and counts of the ids that overlap.

A space and the text are encoded by a byte-level vocabulary (A), the text by a piece vocabulary that adds
the space itself (B).  Both give increasing lists of byte offsets at which tokens end.  The shorter list
drives a galloping search into the longer: from a start known to lie before it, each end doubles its step
until it is passed, then halves the stretch.  The ranks found say everything else: ends on both lists cut
the tokens into groups, and the difference of the ranks of a token's start and end is the range of tokens
of the other list that it overlaps.  Texts go through this in blocks of bounded size; as both lists of a
block are sums over the same bytes, ends of documents are common ends and need no care.

Counts over the corpus come from blocks, too.  A block keeps its documents as numbers into its own list of
distinct id pairs and asks for these pairs once, however often they occur; the answers go back to the
block, where its documents add them up.  No pair is ever counted by occurrence in a shuffle.

Defined cases: a null or empty text, and one whose tokens do not spell it, has no tokens, zeros
everywhere and the empty digest; special strings in a text are text; rows that repeat are documents of
their own; other columns are ignored; a very long text is a block by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioworks.llm import tokens
from folioworks.llm.common import by_value, whole
from folioworks.session import fresh_path, written

#: Bytes of text in a block; it bounds memory and nothing else.
BLOCK_BYTES = 4 << 20
_ANCHOR = 16
_LOW = (1 << 32) - 1


def gallop(longer: np.ndarray, driver: np.ndarray, low: np.ndarray) -> np.ndarray:
    """How many entries of ``longer`` lie below each of ``driver``, at least ``low`` of them being known to."""
    low, high = low.copy(), np.full(len(driver), len(longer))
    going, step = np.arange(len(driver)), 1
    while len(going):
        probe = low[going] + (step - 1)
        below = probe < len(longer)
        below[below] = longer[probe[below]] < driver[going[below]]
        passed = going[~below]
        high[passed] = np.minimum(probe[~below], len(longer))
        going = going[below]
        low[going] = probe[below] + 1
        step *= 2
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) >> 1
        below = longer[middle] < driver[going]
        low[going[below]] = middle[below] + 1
        high[going[~below]] = middle[~below]
        going = going[low[going] < high[going]]
    return low


def ranks(longer: np.ndarray, driver: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each end of ``driver`` in ``longer``, and whether it is there.

    Every so many ends one gallops from ``first``, where its document begins; the others from there.
    """
    anchors = np.arange(0, len(driver), _ANCHOR)
    found = gallop(longer, driver[anchors], first[anchors])
    rank = gallop(longer, driver, np.maximum(first, np.repeat(found, _ANCHOR)[: len(driver)]))
    return rank, longer[rank] == driver


class Alignment:
    """Two id lists over the same bytes: groups, and the links between tokens that overlap."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_bytes: np.ndarray, b_bytes: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> None:
        """``n_a`` and ``n_b``: tokens of each document in the two lists, one after the other."""
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b
        ends_a, ends_b = np.cumsum(a_bytes[a]), np.cumsum(b_bytes[b])
        swapped = len(a) > len(b)
        driver, longer = (ends_b, ends_a) if swapped else (ends_a, ends_b)
        own, other = (n_b, n_a) if swapped else (n_a, n_b)
        first = np.repeat(np.cumsum(other) - other, own)
        rank, common = ranks(longer, driver, first)
        at, there = np.flatnonzero(common), rank[common]
        # Last token of each group in either list.
        self.last_a, self.last_b = (there, at) if swapped else (at, there)
        # A token overlaps from the first end behind its start to the first end not before its own.
        start = np.concatenate([[0], (rank + common)[:-1]]).astype(np.int64)[: len(driver)]
        width = rank - start + 1
        mine = np.repeat(np.arange(len(driver)), width)
        theirs = np.arange(len(mine)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(start, width)
        self.link_a, self.link_b = (theirs, mine) if swapped else (mine, theirs)

    def of_documents(self, places: np.ndarray) -> np.ndarray:
        """How many of some places in the list A lie in each document."""
        ends = np.cumsum(self.n_a)
        return np.diff(np.searchsorted(places, np.concatenate([[0], ends])))

    def digests(self) -> list[str]:
        """SHA-256 of every document's groups, written ``a1,a2|b1;a3|b2,b3``."""
        last_a, last_b = self.last_a, self.last_b
        group_a = np.repeat(np.arange(len(last_a)), np.diff(last_a, prepend=-1))
        group_b = np.repeat(np.arange(len(last_b)), np.diff(last_b, prepend=-1))
        place_a = np.arange(len(self.a)) + np.concatenate([[0], last_b + 1])[group_a]
        place_b = np.arange(len(self.b)) + (last_a + 1)[group_b]
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        ids[place_a], ids[place_b] = self.a, self.b
        after = np.full(len(ids), ord(","), np.uint8)
        after[place_a[last_a]], after[place_b[last_b]] = ord("|"), ord(";")
        digits, lengths = decimal(int(ids.max(initial=0)) + 1)
        cells, size = digits[ids], lengths[ids]
        cells[np.arange(len(ids)), size] = after
        text = cells[np.arange(cells.shape[1])[None, :] <= size[:, None]].tobytes()
        ends = np.concatenate([[0], np.cumsum(size + 1)])
        edges = ends[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])].tolist()
        return [hashlib.sha256(text[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(edges, edges[1:], strict=False)]


def decimal(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits of 0 to n - 1, one row each with a cell to spare, and how many they are."""
    width = len(str(n - 1))
    numbers = np.arange(n)
    lengths = np.maximum(np.searchsorted(10 ** np.arange(width + 1), numbers, side="right"), 1)
    cells = np.zeros((n, width + 1), np.uint8)
    for k in range(width):
        power = lengths - 1 - k
        has = power >= 0
        cells[has, k] = ord("0") + numbers[has] // 10 ** power[has] % 10
    return cells, lengths


class Encoders:
    """Both tokenizers of a worker, with the number of bytes of each id."""

    def __init__(self, a: Broadcast, b: Broadcast) -> None:
        self.a, self.b = tokens.byte_pairs(a, plain=True), tokens.pieces(b)
        self.a_bytes = np.array([len(x) for x in self.a.bytes], np.int64)
        self.b_bytes = np.array([len(x) for x in self.b.bytes], np.int64)

    def align(self, texts: list[str]) -> Alignment:
        coded_a, coded_b = [], []
        for text, b in zip(texts, self.b.encode(texts), strict=True):
            spelt = (" " + text).encode()
            a = self.a.encode(" " + text) if text else np.zeros(0, np.uint32)
            fits = text and b"".join(map(self.b.bytes.__getitem__, b)) == spelt == b"".join(map(self.a.bytes.__getitem__, a.tolist()))
            coded_a.append(a if fits else a[:0])
            coded_b.append(np.array(b if fits else [], np.int64))
        lists = [np.concatenate([np.zeros(0, np.int64), *coded]).astype(np.int64) for coded in (coded_a, coded_b)]
        numbers = [np.array([len(x) for x in coded], np.int64) for coded in (coded_a, coded_b)]
        return Alignment(*lists, self.a_bytes, self.b_bytes, *numbers)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts (column 1), cut into blocks of bounded bytes, one text at least."""
    for batch in batches:
        ends = np.cumsum(np.array(pa.compute.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), np.int64))
        at = 0
        while at < batch.num_rows:
            gone = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, gone + BLOCK_BYTES, side="right")))
            yield batch.column(0).slice(at, stop - at), batch.column(1).slice(at, stop - at).to_pylist()
            at = stop


def align(docs: DataFrame, a_path: str = tokens.BYTE_PAIRS, b_path: str = tokens.PIECES, text: str = "text") -> DataFrame:
    """doc_id, both id lists ``a`` and ``b``, and ``a_last`` and ``b_last``: the last token of each group in either."""
    picked = docs.select("doc_id", whole(text).alias("text"))
    shared_a, shared_b = tokens.shared(docs.sparkSession, a_path), tokens.shared(docs.sparkSession, b_path)
    names = ["a", "b", "a_last", "b_last"]
    schema = T.StructType([picked.schema["doc_id"], *[T.StructField(n, T.ArrayType(T.IntegerType())) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = Encoders(shared_a, shared_b)
        for ids, texts in _blocks(batches):
            found = encoders.align(texts)
            groups = found.of_documents(found.last_a)
            lists = [(found.a, found.n_a, 0), (found.b, found.n_b, 0), (found.last_a, groups, found.n_a), (found.last_b, groups, found.n_b)]
            columns = []
            for values, numbers, sizes in lists:
                shift = np.repeat(np.cumsum(sizes) - sizes, numbers) if isinstance(sizes, np.ndarray) else 0
                ends = np.concatenate([[0], np.cumsum(numbers)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array((values - shift).astype(np.int32))))
            yield pa.RecordBatch.from_arrays([ids, *columns], names=schema.names)

    return picked.mapInArrow(run, schema)


def _kept(docs: DataFrame, a_path: str, b_path: str, text: str) -> DataFrame:
    """A row per document with its figures and its links by number of the pair, and a row per block with its pairs."""
    picked = docs.select("doc_id", whole(text).alias("text"))
    shared_a, shared_b = tokens.shared(docs.sparkSession, a_path), tokens.shared(docs.sparkSession, b_path)
    longs = T.ArrayType(T.LongType())
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            picked.schema["doc_id"],
            *[T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")],
            T.StructField("groups_sha256", T.StringType()),
            *[T.StructField(n, T.BinaryType()) for n in ("steps", "times")],
            *[T.StructField(n, longs) for n in ("pairs", "pair_times")],
        ]
    )
    schema["doc_id"].nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = Encoders(shared_a, shared_b)
        block = TaskContext.get().partitionId() << 32
        for ids, texts in _blocks(batches):
            found = encoders.align(texts)
            n = len(texts)
            links = found.of_documents(found.link_a)
            pairs, code = np.unique(found.a[found.link_a] << 32 | found.b[found.link_b], return_inverse=True)
            document = np.repeat(np.arange(n), links)
            held, times = np.unique(document * max(len(pairs), 1) + code, return_counts=True)
            document, code = np.divmod(held, max(len(pairs), 1))
            edges = np.searchsorted(document, np.arange(n + 1)).tolist()
            total = np.bincount(code, weights=times, minlength=len(pairs)).astype(np.int64)
            # Pairs of a document in order of their numbers: small steps, which pack well.
            steps = np.diff(code, prepend=0).astype("<i4")
            heads = np.array(edges[:-1])[np.diff(edges) > 0]
            steps[heads] = code[heads]
            times = times.astype("<i4")
            figures = [found.n_a, found.n_b, found.of_documents(found.last_a), links]
            columns = [
                pa.array(np.full(n + 1, block)),
                pa.concat_arrays([ids, pa.nulls(1, ids.type)]),
                *[pa.array([*f.tolist(), None], pa.int64()) for f in figures],
                pa.array([*found.digests(), None], pa.string()),
                *[pa.array([*[x[s:e].tobytes() for s, e in zip(edges, edges[1:], strict=False)], None], pa.binary()) for x in (steps, times)],
                *[pa.array([*[None] * n, x.tolist()], pa.list_(pa.int64())) for x in (pairs, total)],
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
            block += 1

    path = fresh_path(docs.sparkSession, "align-blocks")
    picked.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def pair_counts(asked: DataFrame) -> DataFrame:
    """``(pair, n, best)`` from ``(pair, times)``: links per id pair, and whether no other pair of its B id has more."""
    counts = written(asked.groupBy("pair").agg(F.sum("times").alias("n")), "align-counts")
    b = F.col("pair").bitwiseAND(F.lit(_LOW))
    most = counts.groupBy(b.alias("_b")).agg(F.max("n").alias("_most"))  # a row per id of B
    return counts.join(most, b == F.col("_b")).select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))


def digests(docs: DataFrame, a_path: str = tokens.BYTE_PAIRS, b_path: str = tokens.PIECES, text: str = "text") -> DataFrame:
    """Tokens, groups, links and the links' corpus-wide counts of every document."""
    kept = _kept(docs, a_path, b_path, text)
    asked = kept.filter(F.col("pairs").isNotNull()).select("block", F.posexplode(F.arrays_zip("pairs", "pair_times")).alias("code", "_p"))
    asked = asked.select("block", "code", F.col("_p.pairs").alias("pair"), F.col("_p.pair_times").alias("times"))
    answers = asked.drop("times").join(pair_counts(asked), "pair").select(F.col("block").alias("_block"), "code", "n", "best")
    rows = kept.filter(F.col("pairs").isNull()).drop("pairs", "pair_times")
    shown = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = T.StructType([*[rows.schema[c] for c in shown], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def add_up(documents: pa.Table, answered: pa.Table) -> pa.Table:
        code = answered["code"].to_numpy()
        n, best = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        n[code], best[code] = answered["n"].to_numpy(), answered["best"].to_numpy()
        n_best, count_sum = [], []
        for steps, times in zip(documents["steps"].to_pylist(), documents["times"].to_pylist(), strict=True):
            held, often = np.cumsum(np.frombuffer(steps, "<i4"), dtype=np.int64), np.frombuffer(times, "<i4")
            n_best.append(int((best[held] * often).sum()))
            count_sum.append(int((n[held] * often).sum()))
        return documents.select(shown).append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))

    return rows.groupBy("block").cogroup(answers.groupBy("_block")).applyInArrow(add_up, schema)


by_value(__name__)
