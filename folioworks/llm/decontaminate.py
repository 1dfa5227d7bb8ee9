"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

Items are put into classes of nearly equal length.  For each class, windows of its length slide over
every text; a window's SimHash over its shingles of five words is looked up in four tables of 16 bits
each.  Two fingerprints that differ in at most 19 bits differ in at most four bits in one of the
tables, and the tables list every item under all values that near, so every item within the radius is
met, and no item is compared that no table lists.  Each candidate is then compared exactly: around the place found, the windows with as many words
as the item are laid on it, and the best similarity of the bags of shingles, sum of minima over sum of
maxima, decides.

The benchmark is a stated query set: its items go to the tasks in blocks of bounded size, one pass over
the documents for each block.  Sums are kept for a batch of documents at a time, and texts longer than
a batch are cut into overlapping stretches, so memory does not follow the longest text.

Defined cases: a null or blank text holds nothing; an item without words is found nowhere; an item of
fewer than five words is one shingle of its own length; items that repeat are found each; rows that
repeat give a result each; a null id is carried as it is; other columns pass or are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioworks.llm.common import by_value

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19
#: Lengths of neighbouring classes, and the part of a window's length by which it moves.
CLASS_RATIO = 1.1
STRIDE_PART = 10
#: Items, and characters of items, that go to the tasks at once.
BLOCK_ITEMS = 4096
BLOCK_CHARS = 4 << 20
_BATCH_CHARS = 1 << 15
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def encoded(text: str | None) -> bytes:
    """The text without regard to case, in any script."""
    return (text or "").lower().encode("utf-8", "replace")


class WordHashes:
    """Hashes of the words of many texts at once: A to Z lowered, cut at white space, no object per word.

    A word's hash is its polynomial in an odd base, taken from running sums over the bytes.
    """

    def __init__(self) -> None:
        self.space = np.zeros(256, dtype=bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        inverse = pow(int(_FACTOR), -1, 1 << 64)
        self.powers = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, _FACTOR, np.uint64)]))
        self.inverse = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, inverse, np.uint64)]))

    def of(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All words' hashes in a row, and the number of words of each text."""
        line = b" ".join([*texts, b""]).lower()
        if len(line) >= len(self.powers):
            self._grow(2 * len(line))
        chars = np.frombuffer(line, dtype=np.uint8)
        gap = self.space[chars]
        edge = np.empty(len(chars), dtype=bool)
        edge[0], edge[1:] = True, gap[:-1]
        start = np.nonzero(edge & ~gap)[0]
        edge[:-1], edge[-1] = gap[1:], True
        end = np.nonzero(edge & ~gap)[0] + 1
        sums = np.zeros(len(chars) + 1, dtype=np.uint64)
        np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * self.powers[: len(chars)], out=sums[1:])
        hashes = (sums[end] - sums[start]) * self.inverse[start]
        hashes ^= hashes >> np.uint64(32)
        hashes *= np.uint64(0xD6E8FEB86659FD93)
        hashes ^= hashes >> np.uint64(32)
        stops = np.cumsum([len(t) + 1 for t in texts])
        upto = np.searchsorted(start, stops)
        return hashes, np.diff(upto, prepend=0)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for the shingle at each place; the last places, where none fits, hold nothing of use."""
    out = words.copy()
    for step in range(1, size):
        out *= _FACTOR
        out[: len(words) - step] += words[step:]
    out ^= out >> np.uint64(32)
    out *= _FACTOR
    out ^= out >> np.uint64(29)
    return out


def _signs(hashes: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """+1 and -1 for each of the 64 bits; a shingle that runs into the next text counts 0."""
    signs = np.unpackbits(hashes.view(np.uint8), bitorder="little").view(np.int8).reshape(-1, 64)
    signs += signs
    signs -= 1
    signs[~valid] = 0
    return signs


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits((sums > 0).ravel(), bitorder="little").view("<u8")


class WindowSums:
    """Sums over windows of any length, put together from sums over 1, 2, 4, ... places."""

    def __init__(self, signs: np.ndarray, longest: int) -> None:
        self.levels = [signs if longest < 128 else signs.astype(np.int16 if longest < 1 << 15 else np.int32)]
        while 2 << (len(self.levels) - 1) <= longest:
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            wider = last.copy()
            wider[: max(len(last) - step, 0)] += last[step:]
            self.levels.append(wider)

    def prints(self, start: np.ndarray, length: int) -> np.ndarray:
        total, at = None, 0
        for level, sums in enumerate(self.levels):
            if length >> level & 1:
                part = np.take(sums, start + at, axis=0)
                total = part if total is None else np.add(total, part, out=total)
                at += 1 << level
        return _packed(total)


class HammingTables:
    """All fingerprints of a group within a radius, through four tables of 16 bits for each group.

    For each value of 16 bits a table has a bucket: the numbers of the group's fingerprints that differ
    from it in at most a quarter of the radius there.  Only what a bucket names is compared; at a radius of
    19 a bucket names one in 26 of the group, the four together one in seven.
    """

    def __init__(self, groups: Sequence[np.ndarray], radius: int) -> None:
        self.prints, self.radius = np.concatenate([np.zeros(0, np.uint64), *groups]), radius
        values = np.arange(1 << 16, dtype=np.uint16)
        near = values[np.bitwise_count(values) <= radius // 4]
        sizes, named, first = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], 0
        for prints in groups:
            for block in range(4):
                key = ((prints >> np.uint64(16 * block)).astype(np.uint16)[:, None] ^ near).ravel()
                sizes.append(np.bincount(key, minlength=1 << 16))
                named.append((np.argsort(key, kind="stable") // len(near) + first).astype(np.int32))
            first += len(prints)
        #: The buckets of all tables in a row: how many numbers each has, where it begins, and the numbers.
        sizes, self.named = np.concatenate(sizes), np.concatenate(named)
        self.size = sizes.astype(np.min_scalar_type(int(sizes.max(initial=0))))
        self.begin = (np.cumsum(sizes) - sizes).astype(np.int32)

    def candidates(self, queries: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in ``queries``, number of a fingerprint) that a bucket names, one for each bucket."""
        bucket = queries.view(np.uint16).astype(np.int32).reshape(-1, 4)
        bucket += np.arange(4, dtype=np.int32) << 16
        bucket += (group.astype(np.int32) << 18)[:, None]
        bucket = bucket.ravel()
        size = np.take(self.size, bucket)
        some = np.flatnonzero(size)
        size = np.take(size, some).astype(np.int32)
        upto = np.cumsum(size, dtype=np.int32)
        shift = np.take(self.begin, np.take(bucket, some)) - upto + size
        at = np.repeat(shift, size)
        at += np.arange(len(at), dtype=np.int32)
        return np.repeat(some >> 2, size), np.take(self.named, at)

    def within(self, queries: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in ``queries``, number of a fingerprint of its group), each once."""
        rows, items = self.candidates(queries, group)
        close = np.flatnonzero(np.bitwise_count(np.take(queries, rows) ^ np.take(self.prints, items)) <= self.radius)
        pairs = np.unique(rows[close] * max(len(self.prints), 1) + items[close])
        return np.divmod(pairs, max(len(self.prints), 1))


class Matcher:
    """Finds items in texts."""

    def __init__(self, items: Sequence[tuple[int | None, str | None]], similarity: float = SIMILARITY, radius: int = RADIUS) -> None:
        self.similarity, self.radius, self.hashes = similarity, radius, WordHashes()
        self.ids, self.sizes, self.bags, self.shingles = [], [], [], []
        classes = defaultdict(list)
        for item_id, text in items:
            words = self.hashes.of([encoded(text)])[0]
            if not len(words):
                continue
            size = min(SHINGLE, len(words))
            hashed = shingle_hashes(words, size)[: len(words) - size + 1]
            number = round(np.log(len(words)) / np.log(CLASS_RATIO)) if len(words) > SHINGLE else len(words)
            classes[size, number if len(words) > SHINGLE else -len(words)].append(len(self.ids))
            self.ids.append(item_id)
            self.sizes.append(len(words))
            self.shingles.append(hashed)
            self.bags.append(Counter(hashed.tolist()))
        #: By the words of a shingle: the classes, their items in a row, and the tables over these.
        self.classes, self.members, self.tables = defaultdict(list), {}, {}
        prints = defaultdict(list)
        for (size, _), members in classes.items():
            length = round(sum(self.sizes[m] for m in members) / len(members))
            stride = max(1, length // STRIDE_PART)
            spread = max(abs(self.sizes[m] - length) for m in members)
            signs = [_signs(self.shingles[m], np.ones(len(self.shingles[m]), dtype=bool)) for m in members]
            prints[size].append(np.concatenate([_packed(s.sum(axis=0, dtype=np.int64)) for s in signs]))
            self.classes[size].append((length, stride, stride + spread))
            self.members.setdefault(size, []).extend(members)
        self.longest = max(self.sizes, default=1)
        for size, groups in prints.items():
            self.tables[size] = HammingTables(groups, radius)
        #: All shingles of the items, sorted, by the words they have.
        self.known = {size: np.unique(np.concatenate([self.shingles[m] for m in members])) for size, members in self.members.items()}

    def find(self, texts: Sequence[str | None]) -> Iterator[tuple[int, int, float, int, int, int]]:
        """(place of the text, place of the item, similarity, first word, words, differing bits), the best for each pair."""
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        held, n_held = [], 0
        for place, text in enumerate(texts):
            for offset, stretch in self._stretches(encoded(text)):
                held.append((place, offset, stretch))
                n_held += len(stretch)
                if n_held >= _BATCH_CHARS:
                    self._batch(held, best)
                    held, n_held = [], 0
        self._batch(held, best)
        for (place, item), (similarity, start, bits) in sorted(best.items()):
            yield place, item, similarity, start, self.sizes[item], bits

    def _stretches(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """A long text in stretches that share as many words as the longest window and its surroundings may need."""
        if len(text) <= 4 * _BATCH_CHARS:
            yield 0, text
            return
        words = text.split()
        step = max(_BATCH_CHARS // 4, 8 * self.longest)
        for at in range(0, max(len(words) - 3 * self.longest, 1), step):
            yield at, b" ".join(words[at : at + step + 3 * self.longest])

    def _batch(self, held: list[tuple[int, int, bytes]], best: dict) -> None:
        if not held or not self.classes:
            return
        words, lengths = self.hashes.of([h[2] for h in held])
        if not len(words):
            return
        ends = np.cumsum(lengths)
        begins = ends - lengths
        owner = np.repeat(np.arange(len(held)), lengths)
        left = ends[owner] - np.arange(len(words))
        for size, classes in self.classes.items():
            shingles = shingle_hashes(words, size)
            signs = _signs(shingles, left >= size)
            sums = WindowSums(signs, max(c[0] for c in classes) - size + 1)
            known = self.known[size]
            n_known = np.concatenate([[0], np.cumsum(known[np.minimum(np.searchsorted(known, shingles), len(known) - 1)] == shingles)])
            # Texts that no window fits into are windows themselves.
            short = np.nonzero((lengths >= size) & (lengths < max(c[0] for c in classes)))[0]
            whole = np.array([_packed(signs[begins[k] : ends[k]].sum(axis=0, dtype=np.int64))[0] for k in short], dtype=np.uint64)
            starts, windows, counts = [], [], []
            for length, stride, slack in classes:
                # Every so many words, and the last place of each text.
                start = np.arange(0, max(len(words) - length + 1, 0), stride)
                start = np.concatenate([start[left[start] >= length], ends[lengths >= length] - length])
                little = (lengths[short] < length) & (lengths[short] - size + 1 >= self.similarity * (length - slack - size + 1))
                starts += [start, begins[short[little]]]
                windows += [sums.prints(start, length - size + 1), whole[little]]
                counts.append(len(start) + int(little.sum()))
            group = np.repeat(np.arange(len(classes)), counts)
            start, prints, tables = np.concatenate(starts), np.concatenate(windows), self.tables[size]
            rows, items = tables.within(prints, group)
            # A place around which no item's shingle stands holds none.
            length, _, slack = np.array(classes)[group[rows]].T
            at, part = start[rows], owner[start[rows]]
            low, high = np.maximum(at - slack, begins[part]), np.minimum(at + length + slack, ends[part])
            some = n_known[np.maximum(high - size + 1, low)] > n_known[low]
            for row, number, low, high, part in zip(*[c[some].tolist() for c in (rows, items, low, high, part)], strict=True):
                item = self.members[size][number]
                found = self._exact(shingles, item, size, low, high)
                if found and found[0] >= self.similarity:
                    place, offset, _ = held[part]
                    bits = int(np.bitwise_count(prints[row] ^ tables.prints[number]))
                    new = (found[0], offset + found[1] - int(begins[part]), bits)
                    old = best.get((place, item))
                    # The most similar window, then the first, then the nearest fingerprint.
                    if old is None or (-new[0], new[1], new[2]) < (-old[0], old[1], old[2]):
                        best[place, item] = new

    def _exact(self, shingles: np.ndarray, item: int, size: int, low: int, high: int) -> tuple[float, int] | None:
        """Best similarity of a window with the item's number of words between two places, the first such window."""
        bag, n = self.bags[item], self.sizes[item] - size + 1
        window = shingles[low : max(high - size + 1, low)].tolist()
        if not any(s in bag for s in window):
            return None
        n = min(n, len(window))
        counts = Counter(window[:n])
        shared = sum(min(c, counts[s]) for s, c in bag.items() if s in counts)
        top, at = shared, 0
        for i in range(n, len(window)):
            out, new = window[i - n], window[i]
            if counts[out] <= bag.get(out, 0):
                shared -= 1
            counts[out] -= 1
            counts[new] += 1
            if counts[new] <= bag.get(new, 0):
                shared += 1
            if shared > top:
                top, at = shared, i - n + 1
        return top / (len(self.shingles[item]) + n - top), low + at


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list[tuple[int | None, str | None]]]:
    """The items in blocks of bounded size."""
    n, chars = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length(text)), F.lit(0))).first()
    blocks = max(-(-n // BLOCK_ITEMS), -(-chars // BLOCK_CHARS), 1)
    picked = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    for block in range(blocks):
        part = picked if blocks == 1 else picked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield sorted(((r[0], r[1]) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def find_leaks(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, text: str = "text") -> DataFrame:
    """A row for each document and item it holds: where, how similar, and by how many bits the fingerprints differ."""
    picked = docs.select("doc_id", F.col(text).alias("text"))
    schema = T.StructType(
        [
            picked.schema["doc_id"],
            *[T.StructField(n, t) for n, t in (("item_id", T.LongType()), ("similarity", T.DoubleType()), ("first_word", T.LongType()), ("n_words", T.LongType()), ("bits", T.LongType()))],
        ]
    )

    def task(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, similarity, radius)
            for batch in batches:
                found = list(matcher.find(batch.column(1).to_pylist()))
                if found:
                    places, numbers, *rest = zip(*found, strict=True)
                    columns = [batch.column(0).take(pa.array(places)), pa.array([matcher.ids[i] for i in numbers], pa.int64())]
                    columns += [pa.array(rest[0], pa.float64()), *[pa.array(c, pa.int64()) for c in rest[1:]]]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        return run

    parts = [picked.mapInArrow(task(block), schema) for block in item_blocks(items)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def drop_leaks(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, text: str = "text") -> DataFrame:
    """The documents that hold no item, with the columns they came with."""
    at = docs.columns.index(text)

    def task(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, similarity, radius)
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[found[0] for found in matcher.find(batch.column(at).to_pylist())]] = False
                yield batch.filter(pa.array(clean))

        return run

    for block in item_blocks(items):
        docs = docs.mapInArrow(task(block), docs.schema)
    return docs


by_value(__name__)
