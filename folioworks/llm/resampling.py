"""Importance resampling of documents towards a target, by hashed n-gram features.

Features are runs of consecutive words; each falls into one of a fixed number of buckets by the CRC-32 of
its bytes.  The buckets' counts in all documents and in all target texts give each bucket a gain, the log
ratio of the two smoothed shares; a document's weight is the sum over its features, and Gumbel noise from
its id makes the highest scores a draw without replacement.

Counting and scoring both run over blocks of occurrences.  In a block, the occurrences are interned in an
open-addressed table: XXH64 keys, linear probing, and a comparison of the bytes before two occurrences are
taken for the same n-gram.  The slots hold the bucket, worked out once per distinct n-gram, and the number
of occurrences.  Counting adds the slots' numbers to their buckets; scoring gathers the slots' gains by the
occurrences' slot ids.  Texts are never rows of words, and what is shuffled is one row per bucket and task.

Defined cases: a null or empty text has no features and weight 0; rows that repeat are documents of their
own, in the order of the hash of the row where even their ids tie; a null id has the noise of the text
``null`` and comes before other ids among ties; without target texts or without documents the smoothing
alone decides; other columns are ignored; very long texts and words are taken in whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioworks.llm.common import by_value, whole
from folioworks.operators.tables import with_row_index
from folioworks.session import written

BUCKETS = 10_000
LONGEST = 1
SCALE = 1000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: Occurrences interned together, and bytes of text taken in at a time; both bound memory and nothing else.
BLOCK = 1 << 19
TEXT_BYTES = 4 << 20

# Primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def xxh64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XXH64 with seed 0 of many stretches of one buffer, which must go on for 8 bytes behind the last."""
    eights = np.lib.stride_tricks.as_strided(data[:8].view("<u8"), (max(len(data) - 7, 0),), (1,))
    at, left = starts.copy(), lengths.copy()
    h = _P5 + lengths.astype(np.uint64)
    for _ in range(3):
        k = np.flatnonzero((left >= 8) & (lengths < 32))
        if not len(k):
            break
        lane = _turned(eights[at[k]] * _P2, 31) * _P1
        h[k] = _turned(h[k] ^ lane, 27) * _P1 + _P4
        at[k] += 8
        left[k] -= 8
    k = np.flatnonzero((left >= 4) & (lengths < 32))
    lane = eights[at[k]] & np.uint64(0xFFFFFFFF)
    h[k] = _turned(h[k] ^ (lane * _P1), 23) * _P2 + _P3
    at[k] += 4
    left[k] -= 4
    for _ in range(3):
        k = np.flatnonzero((left >= 1) & (lengths < 32))
        if not len(k):
            break
        h[k] = _turned(h[k] ^ (data[at[k]].astype(np.uint64) * _P5), 11) * _P1
        at[k] += 1
        left[k] -= 1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    h ^= h >> np.uint64(32)
    buffer = memoryview(data)
    for k in np.flatnonzero(lengths >= 32).tolist():
        h[k] = xxhash.xxh64_intdigest(buffer[starts[k] : starts[k] + lengths[k]])
    return h


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the stretches at ``a`` and ``b``, of the same length each, hold the same bytes."""
    eights = np.lib.stride_tricks.as_strided(data[:8].view("<u8"), (max(len(data) - 7, 0),), (1,))
    same = np.ones(len(a), bool)
    k, done = np.arange(len(a)), 0
    while len(k):
        left = np.minimum(lengths[k] - done, 8).astype(np.uint64)
        differ = (eights[a[k] + done] ^ eights[b[k] + done]) << (np.uint64(64) - np.uint64(8) * left)
        same[k[differ != 0]] = False
        done += 8
        k = k[(differ == 0) & (lengths[k] > done)]
    return same


class Slots:
    """An open-addressed table of the distinct n-grams among the given stretches of a buffer."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, buckets: int) -> None:
        size = 1 << max(4, int(2 * len(starts)).bit_length())
        keys = xxh64(data, starts, lengths)
        holder = np.full(size, -1, np.int64)  # the occurrence that stands for the slot's n-gram
        self.of = np.empty(len(starts), np.int64)  # the slot of each occurrence
        open_, slot = np.arange(len(starts)), (keys & np.uint64(size - 1)).astype(np.int64)
        while len(open_):
            free = holder[slot] < 0
            holder[slot[free]] = open_[free]  # of several that claim a slot, one stays
            held = holder[slot]
            same = (keys[held] == keys[open_]) & (lengths[held] == lengths[open_])
            check = np.flatnonzero(same & (held != open_))
            same[check] = same_bytes(data, starts[held[check]], starts[open_[check]], lengths[open_[check]])
            self.of[open_[same]] = slot[same]
            open_, slot = open_[~same], (slot[~same] + 1) & (size - 1)
        self.used = np.flatnonzero(holder >= 0)
        self.count = np.bincount(self.of, minlength=size)
        self.bucket = np.zeros(size, np.int64)
        buffer, crc = memoryview(data), zlib.crc32
        first = holder[self.used]
        self.bucket[self.used] = [
            crc(buffer[s : s + n]) % buckets for s, n in zip(starts[first].tolist(), lengths[first].tolist(), strict=True)
        ]


def _word_bytes() -> np.ndarray:
    """What each byte counts as: digits, letters in lower case and all beyond ASCII; the rest a space."""
    table = np.full(256, 0x20, np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    table[0x30:0x3A] = np.arange(0x30, 0x3A)
    table[0x61:0x7B] = table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


_WORD_BYTES = _word_bytes()


def occurrences(texts: pa.Array, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The n-grams of a batch of texts: buffer, starts, lengths and number of the text, by n-gram length.

    The texts are cut out of the batch's own buffer, turned into words at once, with one space between
    two; an n-gram of several words is a stretch of that buffer.
    """
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    data = np.empty(len(raw) + 8, np.uint8)
    np.take(_WORD_BYTES, raw, out=data[: len(raw)])
    data[len(raw) :] = 0x20
    inside = data[:-7] != 0x20  # one more than the texts, a space
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[edges] = inside[edges]
    edges = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[edges] = inside[edges]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    text = np.searchsorted(offsets, starts, side="right") - 1
    if longest > 1:
        kept = inside.copy()
        kept[stops] = True  # the space behind a word; the place after the last text is one
        moved = np.cumsum(kept) - 1
        # Words of two texts that touch share no space, but no n-gram crosses texts.
        starts, stops = moved[starts], moved[stops - 1] + 1
        data = np.concatenate([data[: len(kept)][kept], np.full(8, 0x20, np.uint8)])
    for n in range(1, longest + 1):
        first = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :]) if len(text) >= n else np.zeros(0, np.int64)
        yield data, starts[first], stops[first + n - 1] - starts[first], text[first]


def _pieces(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Stretches of a text column of bounded bytes, one text at least, with the number of their first row."""
    sizes = np.array(pa.compute.binary_length(column).to_numpy(zero_copy_only=False), np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(column):
        gone = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, gone + TEXT_BYTES, side="right")))
        yield at, column.slice(at, stop - at)
        at = stop


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, text: str = "text") -> DataFrame:
    """``(bucket, n)``: the features of all texts by bucket; at most ``buckets`` rows."""
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, part in _pieces(batch.column(0)):
                for data, starts, lengths, _ in occurrences(part, longest):
                    for low in range(0, len(starts), BLOCK):
                        slots = Slots(data, starts[low : low + BLOCK], lengths[low : low + BLOCK], buckets)
                        np.add.at(counts, slots.bucket[slots.used], slots.count[slots.used])
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(counts[found])], names=schema.names)

    return texts.select(whole(text).alias("text")).mapInArrow(run, schema).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS, scale: int = SCALE) -> np.ndarray:
    """The gain of every bucket from two tables of bucket counts, whose size is that of the parameter."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, rows in ((s, source), (t, target)):
        for bucket, n in rows.collect():
            counts[bucket] = n
    ratio = ((t + 1.0) * float(s.sum() + buckets)) / ((s + 1.0) * float(t.sum() + buckets))
    return np.floor(scale * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, by_bucket: np.ndarray, longest: int = LONGEST, text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features and weight of every document."""
    picked = docs.select("doc_id", whole(text).alias("text"))
    fields = [picked.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight")]]
    shared = docs.sparkSession.sparkContext.broadcast(by_bucket)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            rows = batch.num_rows
            n_words, features, weight = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            for row, part in _pieces(batch.column(1)):
                for n, (data, starts, lengths, number) in enumerate(occurrences(part, longest)):
                    of = np.bincount(number, minlength=len(part))
                    features[row : row + len(part)] += of
                    if n == 0:
                        n_words[row : row + len(part)] += of
                    for low in range(0, len(starts), BLOCK):
                        slots = Slots(data, starts[low : low + BLOCK], lengths[low : low + BLOCK], len(gain))
                        np.add.at(weight, row + number[low : low + BLOCK], gain[slots.bucket][slots.of])
            columns = [batch.column(0), pa.array(n_words), pa.array(features), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return picked.mapInArrow(run, T.StructType(fields))


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; ``rank`` is null where it is not drawn.

    Drawn are the highest scores, a percentage of the documents with enough words, ties to the smaller id.
    """
    by_bucket = gains(bucket_counts(docs, buckets, longest, text), bucket_counts(target, buckets, longest, target_text), buckets)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256)
    noise = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-SCALE * F.log(-F.log((noise + 0.5) / F.lit(4294967296.0))))
    scored = weigh(docs, by_bucket, longest, text).withColumn("score", F.col("weight") + gumbel)
    scored = scored.withColumn("_unfit", F.col("n_words") < least_words).withColumn("_down", -F.col("score"))
    ranked = written(with_row_index(written(scored, "resample-scores"), ["_unfit", "_down", "doc_id"], "_place"), "resample-ranks")
    fit = ranked.filter(~F.col("_unfit")).count()
    drawn = ~F.col("_unfit") & (F.col("_place") < percent * fit // 100)
    return ranked.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("_place") + 1).alias("rank"))


# CRC-32 by its table of 256 entries, each made by eight divisions by the reversed polynomial.
_ENTRY = "list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)"
SQL = f"""
WITH crc AS (SELECT list({_ENTRY} ORDER BY b) AS entries FROM (SELECT unnest(range(0, 256)) AS b)),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
dw AS (SELECT r, unnest(words) AS word FROM d),
bw AS (SELECT unnest(words) AS word FROM b),
v AS (SELECT DISTINCT word FROM (SELECT word FROM dw UNION ALL SELECT word FROM bw)),
v2 AS (SELECT word, hex(encode(word)) AS h FROM v),
v3 AS (SELECT word, xor(list_reduce(list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT),
        lambda c, x: xor(c >> 8, entries[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) % {BUCKETS} AS bucket FROM v2, crc),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN v3 USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN v3 USING (word) GROUP BY bucket),
g AS (SELECT bucket, floor({SCALE} * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + {BUCKETS})::DOUBLE)
        / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT r, sum(gain)::BIGINT AS weight FROM dw JOIN v3 USING (word) JOIN g USING (bucket) GROUP BY r),
x AS (SELECT r, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS h FROM d LEFT JOIN w USING (r)),
y AS (SELECT *, (weight + floor(-{SCALE} * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))))::BIGINT AS score, n_features >= {LEAST_WORDS} AS fit FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id NULLS FIRST, r) AS place, count(*) FILTER (fit) OVER () AS n FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= {PERCENT} * n // 100 THEN place END AS rank FROM z
"""

by_value(__name__)
