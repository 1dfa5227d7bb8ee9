"""Language-model scores by context-tree weighting over bytes.

A text is read as its words, lower-cased, with a blank after each and a line end after the last.  Each
byte is eight binary decisions; each decision has a tree of contexts, the preceding 0 to ``DEPTH``
bytes, with a Krichevsky-Trofimov estimate at every node.  Context-tree weighting mixes the estimates
of all depths: a node's weight for stopping is half its own estimate's share of the weighted
probability, which follows from its children.  The trained tree predicts each byte of a text, and the
logarithms add up to the score.

How it runs.  Tasks gather the texts they read into blocks of bounded size.  A block sends its distinct
words and its distinct byte strings (context and next byte) with their training counts, packed, cut
into buckets by hash, and its own packed texts, which wait for the answers; a bucket merges what all
blocks sent.  The merged strings are grouped by the three latest bytes of the
context, so that each group holds whole subtrees.  Of the three levels above, the nodes of two bytes are
summed by Spark and join the groups that lie below them; the two levels on top, at most 255 * 257 nodes
whatever the corpus, go to all tasks.  Buckets answer each block's strings with their code lengths and its
words with their counts, in the order they were asked, and the block scores its texts.  So the model
never sits in one place, each string travels once per block, and texts move once.  Answers are single
precision, which changes a score by less than a ten-millionth part.

Defined cases: a null or blank text is the line end alone; training takes the texts whose
crc32(doc_id) mod 5 is not 1, a null doc_id counting as empty text; rows that repeat are texts of their
own; other columns are ignored; without training texts all estimates are one half.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioworks.llm.common import by_value
from folioworks.session import written

DEPTH = 5
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 64 << 20
#: Byte strings of the model that one task weighs at once.
PART_STRINGS = 2 << 20
FOLDS, HELD_OUT = 5, 1
_END = 10


def normal(text: str | None) -> tuple[list[bytes], bytes]:
    words = (text or "").encode("utf-8", "replace").lower().split()
    return words, b" ".join(words) + b"\n"


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def strings(streams: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Context and next byte, as one number, at each place of each stream; the streams' lengths."""
    pad = bytes([_END]) * depth
    line = np.frombuffer(pad + pad.join(streams), dtype=np.uint8)
    codes = np.zeros(len(line) - depth, dtype=np.int64)
    for back in range(depth + 1):
        codes <<= 8
        codes |= line[back : back + len(codes)]
    lengths = np.array([len(s) for s in streams], dtype=np.int64)
    # Places of the padding itself are nobody's.
    own = np.ones(len(codes), dtype=bool)
    after = np.cumsum(lengths + depth)[:-1]
    for back in range(depth):
        own[after - depth + back] = False
    return codes[own], lengths


def _bucket_of(codes: np.ndarray, buckets: int) -> np.ndarray:
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(words, buckets: int) -> dict[int, list[bytes]]:
    out: dict[int, list[bytes]] = {}
    for word in sorted(words):
        out.setdefault(zlib.crc32(word) % buckets, []).append(word)
    return out


def _code_groups(codes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Distinct sorted strings' places, bucket by bucket."""
    bucket = _bucket_of(codes, buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.nonzero(np.diff(bucket[order], prepend=-1))[0]
    for places in np.split(order, cuts[1:]) if len(order) else ():
        yield int(bucket[places[0]]), places


def _binary(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary())


_CODEC = "zstd"


def pack(numbers: np.ndarray) -> bytes:
    """Numbers as bytes, those of equal weight together, compressed."""
    width = numbers.dtype.itemsize
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, width).T)
    return pack_bytes(planes.tobytes())


def unpack(cell: bytes, dtype=np.int64) -> np.ndarray:
    planes, width = np.frombuffer(unpack_bytes(cell), np.uint8), np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(width, len(planes) // width).T).view(dtype).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=0))


def unpack_sorted(cell: bytes) -> np.ndarray:
    return np.cumsum(unpack(cell))


def pack_bytes(value: bytes) -> bytes:
    return len(value).to_bytes(8, "little") + pa.compress(value, codec=_CODEC, asbytes=True)


def unpack_bytes(cell: bytes) -> bytes:
    return pa.decompress(cell[8:], decompressed_size=int.from_bytes(cell[:8], "little"), codec=_CODEC, asbytes=True)


def _asked_schema(doc_id: T.StructField) -> T.StructType:
    fields = [("block", T.LongType()), ("kind", T.StringType()), ("bucket", T.LongType()), ("keys", T.BinaryType()), ("counts", T.BinaryType())]
    return T.StructType([*[T.StructField(n, t) for n, t in fields], T.StructField("ids", T.ArrayType(doc_id.dataType))])


def _ask_rows(ids: list, streams: list[bytes], word_lists: list[list[bytes]], buckets: int, depth: int) -> list[tuple]:
    """A block's texts, and its distinct words and strings with their training counts."""
    trained, others = Counter(), {b"\n"}
    trains = [not held_out(i) for i in ids]
    for words, train in zip(word_lists, trains, strict=True):
        if train:
            trained.update(words)
            trained[b"\n"] += 1
        else:
            others.update(words)
    rows = [("t", 0, pack_bytes(b"".join(streams)), None, ids)]
    for bucket, words in _by_bucket(others | trained.keys(), buckets).items():
        rows.append(("w", bucket, pack_bytes(b" ".join(words)), pack(np.array([trained[w] for w in words], dtype=np.int64)), None))
    codes, lengths = strings(streams, depth)
    train = np.repeat(np.array(trains, dtype=bool), lengths)
    own, n = np.unique(codes[train], return_counts=True)
    rest = np.setdiff1d(codes[~train], own)
    own, n = np.concatenate([own, rest]), np.concatenate([n, np.zeros(len(rest), np.int64)])
    order = np.argsort(own)
    own, n = own[order], n[order].astype(np.int64)
    for bucket, places in _code_groups(own, buckets):
        rows.append(("s", bucket, pack_sorted(own[places]), pack(n[places]), None))
    return rows


def _ask(buckets: int, depth: int):
    """Texts in, blocks of them out; a block's number is drawn by the attempt that writes it."""

    def table_of(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        number = uuid.uuid4().int >> 65
        kinds, numbers, keys, counts, ids = zip(*rows, strict=True)
        columns = [pa.array([number] * len(rows), pa.int64()), pa.array(kinds), pa.array(numbers, pa.int64()), _binary(keys), _binary(counts), pa.array(ids, pa.list_(id_type))]
        return pa.RecordBatch.from_arrays(columns, names=["block", "kind", "bucket", "keys", "counts", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, streams, word_lists, size, id_type = [], [], [], 0, None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words, stream = normal(text.as_py())
                ids.append(doc_id)
                streams.append(stream)
                word_lists.append(words)
                size += len(stream)
                if size >= BLOCK_BYTES:
                    yield table_of(_ask_rows(ids, streams, word_lists, buckets, depth), id_type)
                    ids, streams, word_lists, size = [], [], [], 0
        if ids:
            yield table_of(_ask_rows(ids, streams, word_lists, buckets, depth), id_type)

    return run


ANSWER = "block bigint, kind string, bucket bigint, answer binary, n_tokens bigint, n_types bigint"


def _answer_words(bucket: pa.Table) -> pa.Table:
    """Corpus counts of each block's words, in the block's order, and a row with the bucket's sums."""
    total: Counter = Counter()
    asked = bucket.column("keys").to_pylist()
    for keys, counts in zip(asked, bucket.column("counts").to_pylist(), strict=True):
        for word, n in zip(_words(keys), unpack(counts).tolist(), strict=True):
            total[word] += n
    answers = [pack(np.array([total[w] for w in _words(keys)], dtype=np.int64)) for keys in asked]
    n = len(asked)
    number = bucket.column("bucket")[0].as_py()
    return pa.table(
        {
            "block": pa.concat_arrays([*bucket.column("block").chunks, pa.array([-1], pa.int64())]),
            "kind": pa.array(["w"] * (n + 1)),
            "bucket": pa.array([number] * (n + 1), pa.int64()),
            "answer": _binary([*answers, None]),
            "n_tokens": pa.array([None] * n + [sum(total.values())], pa.int64()),
            "n_types": pa.array([None] * n + [sum(1 for v in total.values() if v)], pa.int64()),
        }
    )


def _words(keys: bytes) -> list[bytes]:
    return unpack_bytes(keys).split(b" ")


MERGED = "part bigint, bucket bigint, keys binary, counts binary, n bigint"


def _merge(parts: int):
    """A bucket's strings with their counts in all training texts, apart by the three latest bytes of the context."""

    def run(bucket: pa.Table) -> pa.Table:
        keys = np.concatenate([unpack_sorted(c) for c in bucket.column("keys").to_pylist()])
        counts = np.concatenate([unpack(c) for c in bucket.column("counts").to_pylist()])
        own, inverse = np.unique(keys, return_inverse=True)
        total = np.bincount(inverse, weights=counts).astype(np.int64)
        part = _bucket_of((own >> 8) & 0xFFFFFF, parts)
        rows = [(int(p), own[part == p], total[part == p]) for p in np.unique(part)]
        number = bucket.column("bucket")[0].as_py()
        return pa.table(
            {
                "part": pa.array([r[0] for r in rows], pa.int64()),
                "bucket": pa.array([number] * len(rows), pa.int64()),
                "keys": _binary([pack_sorted(r[1]) for r in rows]),
                "counts": _binary([pack(r[2]) for r in rows]),
                "n": pa.array([len(r[1]) for r in rows], pa.int64()),
            }
        )

    return run


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series eight places up."""
    below = np.ones_like(x)
    for step in range(8):
        below *= x + step
    y = x + 8.0
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(below)


def kt_log(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - math.log(math.pi) - log_gamma(zeros + ones + 1.0)


def reversed_keys(codes: np.ndarray, depth: int) -> np.ndarray:
    """The context with its latest byte first, so that a shorter context is a prefix, and the last byte."""
    out = np.zeros_like(codes)
    for back in range(depth):
        out = out << 8 | (codes >> 8 * (back + 1)) & 0xFF
    return out << 8 | codes & 0xFF


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the place of each key among them; quick where the keys come in few rising runs."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = np.cumsum(fresh) - 1
    return ordered[fresh], place


class Subtrees:
    """The nodes of depth 3 to ``depth`` over some strings, for one of the eight decisions of a byte.

    ``reversed_keys`` are the strings' contexts, latest byte first, and their last byte, in rising order.
    What the strings give to the nodes of depth 2 are sums in part, as other strings lie below the same nodes.
    """

    def __init__(self, reversed_keys: np.ndarray, counts: np.ndarray, bit: int, depth: int) -> None:
        byte = reversed_keys & 0xFF
        self.ones = ((byte >> (7 - bit)) & 1).astype(bool)
        keys = reversed_keys & ~0xFF | byte >> (8 - bit)
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        keys, place = keys[fresh], np.cumsum(fresh) - 1
        ones = np.bincount(place, weights=counts * self.ones, minlength=len(keys))
        zeros = np.bincount(place, weights=counts * ~self.ones, minlength=len(keys))
        weighted = kt_log(zeros, ones)
        # From the leaves up: place of each string's node, counts, probability of stopping.
        self.levels = [(place, zeros, ones, None)]
        for left in range(depth - 3, -1, -1):
            keys, up = _grouped(keys >> 16 << 8 | keys & 0xFF)
            ones, zeros = np.bincount(up, weights=ones), np.bincount(up, weights=zeros)
            below = np.bincount(up, weights=weighted)
            place = up[place]
            if left:
                own = kt_log(zeros, ones)
                weighted = np.logaddexp(own, below) - math.log(2)
                self.levels.append((place, zeros, ones, np.exp(own - math.log(2) - weighted)))
        # Two context bytes, the latest first, and the decisions so far behind a leading one.
        self.pairs, self.place = keys >> 8 << 8 | 1 << bit | keys & 0xFF, place
        self.zeros, self.n_ones, self.below = zeros, ones, below

    def predict(self, pairs: Pairs) -> np.ndarray:
        """Probability of each string's bit, mixed from the leaf up to depth 2."""
        out = None
        for place, zeros, ones, stop in [*self.levels, (self.place, *pairs.of(self.pairs))]:
            own = (np.where(self.ones, ones[place], zeros[place]) + 0.5) / (zeros + ones + 1.0)[place]
            out = own if out is None else stop[place] * own + (1 - stop[place]) * out
        return out


class Pairs:
    """The nodes of depth 2 above some strings, with the sums of all strings below."""

    def __init__(self, nodes: np.ndarray, *values: np.ndarray) -> None:
        order = np.argsort(nodes)
        self.nodes, self.values = nodes[order], [v[order] for v in values]

    def of(self, nodes: np.ndarray) -> list[np.ndarray]:
        """Zeros, ones and the probability of stopping."""
        place = np.searchsorted(self.nodes, nodes)
        return [v[place] for v in self.values]


TOP = "part bigint, node bigint, zeros double, ones double, below double"


def _tops(depth: int):
    """What a part gives to the nodes of depth 2."""

    def run(part: pa.Table) -> pa.Table:
        codes, counts = _strings_of(part)
        keys = reversed_keys(codes, depth)
        order = np.argsort(keys)
        ordered, counts = keys[order], counts[order]
        trees = [Subtrees(ordered, counts, bit, depth) for bit in range(8)]
        columns = {name: np.concatenate([getattr(t, own) for t in trees]) for name, own in (("node", "pairs"), ("zeros", "zeros"), ("ones", "n_ones"), ("below", "below"))}
        number = np.full(len(columns["node"]), part.column("part")[0].as_py())
        return pa.table({"part": number, **columns})

    return run


PAIR = "node bigint, zeros double, ones double, stop double, weighted double"


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of depth 2, mixed with what lies below them."""
    for batch in batches:
        node, zeros, ones, below = (batch.column(c).to_numpy() for c in ("node", "zeros", "ones", "below"))
        own = kt_log(zeros, ones)
        weighted = np.logaddexp(own, below) - math.log(2)
        columns = [node, zeros, ones, np.exp(own - math.log(2) - weighted), weighted]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "zeros", "ones", "stop", "weighted"])


def _strings_of(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([unpack_sorted(c) for c in part.column("keys").to_pylist()])
    return keys, np.concatenate([unpack(c) for c in part.column("counts").to_pylist()]).astype(float)


class Crown:
    """The nodes of depth 0 and 1: at most 255 and 255 * 256 of them, whatever the corpus."""

    def __init__(self, rows: list[tuple[int, int, float, float, float]]) -> None:
        shape = (256, 256)
        self.zeros, self.ones, below = np.zeros(shape), np.zeros(shape), np.zeros(shape)
        for latest, node, zeros, ones, weighted in rows:
            self.zeros[latest, node], self.ones[latest, node], below[latest, node] = zeros, ones, weighted
        own = kt_log(self.zeros, self.ones)
        mixed = np.logaddexp(own, below) - math.log(2)
        self.stop = np.exp(own - math.log(2) - mixed)
        self.root_zeros, self.root_ones = self.zeros.sum(axis=0), self.ones.sum(axis=0)
        own = kt_log(self.root_zeros, self.root_ones)
        self.root_stop = np.exp(own - math.log(2) - (np.logaddexp(own, mixed.sum(axis=0)) - math.log(2)))

    def predict(self, codes: np.ndarray, bit: int, below: np.ndarray) -> np.ndarray:
        byte, latest = codes & 0xFF, codes >> 8 & 0xFF
        node, ones = 1 << bit | byte >> (8 - bit), (byte >> (7 - bit) & 1).astype(bool)

        def estimate(zeros: np.ndarray, n_ones: np.ndarray) -> np.ndarray:
            return (np.where(ones, n_ones, zeros) + 0.5) / (zeros + n_ones + 1.0)

        stop = self.stop[latest, node]
        out = stop * estimate(self.zeros[latest, node], self.ones[latest, node]) + (1 - stop) * below
        stop = self.root_stop[node]
        return stop * estimate(self.root_zeros[node], self.root_ones[node]) + (1 - stop) * out


def log10_of(codes: np.ndarray, counts: np.ndarray, crown: Crown, pairs: Pairs, depth: int = DEPTH) -> np.ndarray:
    """Log10 of each string's probability of its last byte."""
    keys = reversed_keys(codes, depth)
    order = np.argsort(keys)
    codes, keys, counts = codes[order], keys[order], counts[order]
    total = np.zeros(len(codes))
    for bit in range(8):
        total += np.log10(crown.predict(codes, bit, Subtrees(keys, counts, bit, depth).predict(pairs)))
    out = np.empty(len(codes))
    out[order] = total
    return out


WEIGHED = "bucket bigint, keys binary, logs binary"


def _weigh(crown: Crown, depth: int):
    def run(part: pa.Table, above: pa.Table) -> pa.Table:
        codes, counts = _strings_of(part)
        pairs = Pairs(*[above.column(c).to_numpy() for c in ("node", "zeros", "ones", "stop")])
        logs = log10_of(codes, counts, crown, pairs, depth)
        ends = np.cumsum(part.column("n").to_numpy())[:-1]
        return pa.table({"bucket": part.column("bucket"), "keys": part.column("keys"), "logs": _binary([pack(v.astype(np.float32)) for v in np.split(logs, ends)])})

    return run


def _answer_strings(asked: pa.Table, weighed: pa.Table) -> pa.Table:
    if not asked.num_rows:
        return pa.table({"block": pa.array([], pa.int64()), "kind": pa.array([], pa.string()), "bucket": pa.array([], pa.int64()), "answer": _binary([]), "n_tokens": pa.array([], pa.int64()), "n_types": pa.array([], pa.int64())})
    keys = np.concatenate([unpack_sorted(c) for c in weighed.column("keys").to_pylist()])
    logs = np.concatenate([unpack(c, np.float32) for c in weighed.column("logs").to_pylist()])
    order = np.argsort(keys)
    keys, logs = keys[order], logs[order]
    answers = [pack(logs[np.searchsorted(keys, unpack_sorted(own))]) for own in asked.column("keys").to_pylist()]
    n = asked.num_rows
    none = pa.nulls(n, pa.int64())
    return pa.table({"block": asked.column("block"), "kind": pa.array(["s"] * n), "bucket": asked.column("bucket"), "answer": _binary(answers), "n_tokens": none, "n_types": none})


class Places:
    """The place of each code among distinct sorted ones, by hashing; the few that collide are searched."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes, self.shift = codes, 64 - max(len(codes), 1).bit_length() - 2
        self.table = np.zeros(1 << 64 - self.shift, dtype=np.int32)
        self.table[self._slot(codes)] = np.arange(len(codes), dtype=np.int32)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(self.shift)).view(np.int64)

    def of(self, codes: np.ndarray) -> np.ndarray:
        found = np.take(self.table, self._slot(codes))
        missed = np.nonzero(np.take(self.codes, found) != codes)[0]
        found[missed] = np.searchsorted(self.codes, codes[missed])
        return found


def _score(buckets: int, depth: int, n_tokens: int, n_types: int, names: list[str]):
    """Scores a block's texts from the answers it got."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        got = {(k, b): a for k, b, a in zip(answers.column("kind").to_pylist(), answers.column("bucket").to_pylist(), answers.column("answer").to_pylist(), strict=True)}
        ids = block.column("ids").chunk(0).flatten()
        streams = [line + b"\n" for line in unpack_bytes(block.column("keys")[0].as_py()).split(b"\n")[:-1]]
        word_lists = [stream.split() for stream in streams]
        codes, lengths = strings(streams, depth)
        own = np.unique(codes)
        logs = np.zeros(len(own))
        for bucket, places in _code_groups(own, buckets):
            logs[places] = unpack(got["s", bucket], np.float32)
        ends = np.cumsum(lengths)
        found = Places(own)
        spans = np.concatenate([logs[found.of(codes[at : at + (1 << 18)])] for at in range(0, len(codes), 1 << 18)])
        scores = np.add.reduceat(spans, ends - lengths)
        counts: dict[bytes, int] = {}
        for bucket, words in _by_bucket({b"\n"}.union(*word_lists), buckets).items():
            counts.update(zip(words, unpack(got["w", bucket]).tolist(), strict=True))
        whole = n_tokens + 0.5 * (n_types + 1)
        cost = {w: math.log10((c + 0.5) / whole) for w, c in counts.items()}
        unknown = {w for w, c in counts.items() if not c}
        base, n_known = [], []
        for words in word_lists:
            base.append(math.fsum(map(cost.__getitem__, words)) + cost[b"\n"])
            n_known.append(len(words) + 1 - sum(map(unknown.__contains__, words)) - (b"\n" in unknown))
        columns = {
            "doc_id": ids,
            "held_out": pa.array([held_out(i) for i in ids.to_pylist()], pa.bool_()),
            "n_tokens": pa.array([len(words) + 1 for words in word_lists], pa.int64()),
            "n_known": pa.array(n_known, pa.int64()),
            "train_tokens": pa.array([n_tokens] * len(ids), pa.int64()),
            "base_score": pa.array(base, pa.float64()),
            "score": pa.array(scores, pa.float64()),
            "n_bytes": pa.array(lengths, pa.int64()),
            "bits_per_byte": pa.array(-scores / math.log10(2) / lengths, pa.float64()),
        }
        return pa.table(columns).select(names)

    return run


def score(docs: DataFrame, depth: int = DEPTH, text: str = "text") -> DataFrame:
    """Scores of all texts under the model learnt from the training texts."""
    if not 3 <= depth <= 6:
        raise ValueError("the depth must lie between 3 and 6")
    picked = docs.select("doc_id", F.col(text).alias("text"))
    size = picked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(32, size // BUCKET_BYTES)
    asked = written(picked.mapInArrow(_ask(buckets, depth), _asked_schema(picked.schema["doc_id"])), "ctw-asked")
    words, codes = [asked.filter(F.col("kind") == k).select("block", "bucket", "keys", "counts") for k in "ws"]
    answered = written(words.groupBy("bucket").applyInArrow(_answer_words, ANSWER), "ctw-words")
    n_tokens, n_types = answered.filter("block = -1").agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_types"), F.lit(0))).first()
    # A part holds whole triples of latest bytes; below a triple there are at most 256 ** (depth - 2) strings.
    parts = min(1 << 13, max(32, size // (PART_STRINGS << 5)))
    merged = written(codes.groupBy("bucket").applyInArrow(_merge(parts), MERGED), "ctw-merged")
    tops = written(merged.groupBy("part").applyInArrow(_tops(depth), TOP), "ctw-tops")
    summed = tops.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")])
    pairs = written(summed.mapInArrow(_pairs, PAIR), "ctw-pairs")
    rows = pairs.groupBy(F.shiftright("node", 16).alias("latest"), F.col("node").bitwiseAND(0xFF).alias("node")).agg(*[F.sum(c) for c in ("zeros", "ones", "weighted")])
    crown = Crown([tuple(r) for r in rows.collect()])  # at most 256 * 255 rows
    above = tops.select("part", "node").join(pairs.select("node", "zeros", "ones", "stop"), "node")
    weighed = merged.groupBy("part").cogroup(above.groupBy("part")).applyInArrow(_weigh(crown, depth), WEIGHED)
    coded = codes.groupBy("bucket").cogroup(weighed.groupBy("bucket")).applyInArrow(_answer_strings, ANSWER)
    answers = answered.filter("block >= 0").unionByName(coded).select("block", "kind", "bucket", "answer")
    fields = [picked.schema["doc_id"], T.StructField("held_out", T.BooleanType())]
    fields += [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")]
    fields += [T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())]
    fields += [T.StructField("n_bytes", T.LongType()), T.StructField("bits_per_byte", T.DoubleType())]
    schema = T.StructType(fields)
    texts = asked.filter("kind = 't'").select("block", "keys", "ids")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(buckets, depth, n_tokens, n_types, schema.names), schema)


by_value(__name__)
