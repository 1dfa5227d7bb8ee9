"""Best-fit packing of token pieces into sequences, by linear grouping.

1. Grouping: the lengths above a threshold, in descending order, are cut into groups of equal
   cardinality, and every length counts as the largest of its group.  So there are few sizes.
2. Configurations: a configuration is a multiset of sizes that fits a sequence.  How often each is used
   is a linear programme, solved by column generation: the simplex method on the configurations known so
   far, and a knapsack over the sizes for the configuration that would help most.
3. Substitution: documents of a group take the places of its size, all but the smallest of each
   configuration, which is left open, as what the rounding up wasted may make room for a longer one.
   These, the rest of the groups, and everything below the threshold go longest first to the fullest
   sequence that still takes them, or to a new one.

All this works on the number of pieces per length: at most ``capacity`` numbers, whatever the corpus.  Its
result, the plan, says for runs of pieces in order of length which sequences and places they get.  The
pieces themselves are numbered in that order by a range shuffle of short rows; a piece finds its run by
its number.  Plans for several thresholds, numbers of groups and shares of the programme that are opened
are made, and the shortest is taken.

Defined cases: a null or empty text is the end token alone; rows that repeat are documents of their own;
pieces of one length are interchangeable and ordered by the hash of their row; only documents longer than a
sequence are cut, the first piece taking the rest; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioworks.llm import tokens
from folioworks.llm.common import by_value, fresh_name, whole
from folioworks.operators.tables import with_row_index
from folioworks.session import written

CAPACITY = 2048
END = 0
#: Schemes tried: the share of a sequence up to which a length is small, and the number of groups above it.
SCHEMES = ((1 / 3, 64), (1 / 4, 64))
#: Shares of the programme's sequences that are opened before best fit goes on.
SHARES = (1.0, 0.7, 0.4)
_BATCH_BYTES = 8 << 20
_TOLERANCE = 1e-9


def linear_groups(counts: np.ndarray, above: int, groups: int) -> list[list[tuple[int, int]]]:
    """Lengths above a threshold, longest first, as lists (length, number), equally many in each.

    ``counts[l]`` is the number of pieces of length l.  A length may belong to two groups.
    """
    lengths = np.flatnonzero(counts)[::-1]
    lengths = lengths[lengths > above]
    total = int(counts[lengths].sum())
    out: list[list[tuple[int, int]]] = []
    ends = [total * (g + 1) // groups for g in range(groups)]
    seen, group, left = 0, [], 0
    for length in lengths.tolist():
        left = int(counts[length])
        while left:
            while ends and ends[0] <= seen:
                ends.pop(0)
                if group:
                    out.append(group)
                    group = []
            taken = min(left, ends[0] - seen)
            group.append((length, taken))
            seen += taken
            left -= taken
    return [*out, group] if group else out


def best_configuration(values: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """How often each size stands in the most valuable multiset that fits."""
    most = capacity // int(sizes.min())
    used = np.zeros(len(sizes), np.int64)
    places = np.arange(capacity + 1)[None, :] - sizes[:, None]
    outside = places < 0
    places = np.where(outside, 0, places)
    layers, choices = [np.zeros(capacity + 1)], []
    for _ in range(most):
        reached = layers[-1][places] + values[:, None]
        reached[outside] = -np.inf
        choice = reached.argmax(axis=0)
        layers.append(reached[choice, np.arange(capacity + 1)])
        choices.append(choice)
    ends = [layer[capacity] for layer in layers]
    at = capacity
    for k in range(int(np.argmax(ends)), 0, -1):
        item = int(choices[k - 1][at])
        used[item] += 1
        at -= int(sizes[item])
    return used


def configurations(sizes: np.ndarray, needs: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations with how often each is used, rounded down; none holds more pieces than are needed.

    A size beyond the capacity is a configuration of its own.
    """
    m = len(sizes)
    columns = np.diag(np.maximum(capacity // sizes, 1)).astype(np.int64)
    inverse = np.diag(1.0 / np.diag(columns))
    amounts = inverse @ needs
    for step in range(60 * m):
        if step % 40 == 39:
            inverse = np.linalg.inv(columns.astype(float))
            amounts = np.maximum(inverse @ needs, 0.0)
        entering = best_configuration(inverse.sum(axis=0), sizes, capacity)
        if inverse.sum(axis=0) @ entering <= 1 + 1e-7:
            break
        change = inverse @ entering
        positive = change > _TOLERANCE
        if not positive.any():
            break
        ratios = np.full(m, np.inf)
        ratios[positive] = amounts[positive] / change[positive]
        leaving = int(ratios.argmin())
        amounts = amounts - ratios[leaving] * change
        amounts[leaving] = ratios[leaving]
        row = inverse[leaving] / change[leaving]
        inverse = inverse - np.outer(change, row)
        inverse[leaving] = row
        columns[:, leaving] = entering
    left, out = needs.astype(np.int64).copy(), []
    for k in np.argsort(-amounts, kind="stable"):
        used = columns[:, k]
        times = min(int(amounts[k] + 1e-6), int((left[used > 0] // used[used > 0]).min()))
        if times > 0:
            left -= times * used
            out.append((used, times))
    return out


class Plan:
    """Sequences as runs that have the same room left, and the runs of pieces that went to them."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.sequences = capacity, 0
        self.by_room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: runs (first, number)
        self.runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)  # length: (pieces, first, each, offset)

    def place(self, length: int, number: int, first: int, each: int, room: int) -> None:
        """``each`` pieces to each of ``number // each`` sequences that have that much room."""
        self.runs[length].append((number, first, each, self.capacity - room))

    def configured(self, groups: list[list[tuple[int, int]]], used: np.ndarray, times: int) -> None:
        """Sequences of one configuration, without its smallest piece; pieces are taken from the groups' lists."""
        runs = [(self.sequences, times, self.capacity)]
        self.sequences += times
        slots = np.repeat(np.arange(len(used)), used)[:-1]  # sizes are in descending order
        for g in slots.tolist():
            after = []
            for first, number, room in runs:
                while number:
                    length, there = groups[g][-1]
                    n = min(number, there)
                    self.place(length, n, first, 1, room)
                    after.append((first, n, room - length))
                    first, number = first + n, number - n
                    groups[g][-1] = (length, there - n)
                    if there == n:
                        groups[g].pop()
            runs = after
        for first, number, room in runs:
            self.by_room[room].append((first, number))

    def best_fit(self, counts: np.ndarray) -> None:
        """All pieces counted, the longest first, each to the fullest sequence that takes it."""
        for length in np.flatnonzero(counts)[::-1].tolist():
            left = int(counts[length])
            rooms = sorted(r for r, runs in self.by_room.items() if r >= length and runs)
            for room in rooms:
                each = room // length
                runs = self.by_room[room]
                while left and runs:
                    first, number = runs.pop()
                    whole_ones = min(number, left // each)
                    if whole_ones:
                        self.place(length, whole_ones * each, first, each, room)
                        self.by_room[room - each * length].append((first, whole_ones))
                        left -= whole_ones * each
                        first, number = first + whole_ones, number - whole_ones
                    elif left:
                        self.place(length, left, first, left, room)
                        self.by_room[room - left * length].append((first, 1))
                        left, first, number = 0, first + 1, number - 1
                    if number:
                        runs.append((first, number))
                        if not left:
                            break
                if not left:
                    break
            each = self.capacity // length
            for number in (left // each, 1 if left % each else 0):
                if number:
                    n = min(each, left)
                    self.place(length, number * n, self.sequences, n, self.capacity)
                    self.by_room[self.capacity - n * length].append((self.sequences, number))
                    self.sequences += number
                    left -= number * n


def make_plan(counts: np.ndarray, capacity: int, above: int, groups: int, shares: Sequence[float]) -> Plan:
    """The shortest plan of those that open a share of the programme's sequences before best fit goes on."""
    grouped = linear_groups(counts, above, groups)
    # Groups may share their largest length; they are one size then.
    merged: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for group in grouped:
        merged[group[0][0]] += group
    sizes = np.array(sorted(merged, reverse=True))
    needs = np.array([sum(n for _, n in merged[s]) for s in sizes.tolist()])
    chosen = configurations(sizes, needs, capacity) if len(sizes) else []
    best = None
    for share in shares:
        plan, rest = Plan(capacity), counts.copy()
        lists = [list(merged[s]) for s in sizes.tolist()]
        for used, times in chosen:
            if used.sum() > 1:
                plan.configured(lists, used, int(times * share))
        rest[above + 1 :] = 0
        for length, n in (entry for group in lists for entry in group):
            rest[length] += n
        plan.best_fit(rest)
        if best is None or plan.sequences < best.sequences:
            best = plan
    return best


def shortest_plan(counts: np.ndarray, capacity: int) -> Plan:
    """The plan with the fewest sequences; one that cannot be shorter ends the search."""
    least = -(-int((counts * np.arange(len(counts))).sum()) // capacity)
    best = None
    for threshold, groups in SCHEMES:
        plan = make_plan(counts, capacity, int(capacity * threshold), groups, SHARES)
        if best is None or plan.sequences < best.sequences:
            best = plan
        if best.sequences <= least:
            break
    return best


def cut(docs: DataFrame, capacity: int = CAPACITY, path: str = tokens.BYTE_PAIRS, end: int = END, text: str = "text") -> DataFrame:
    """doc_id, piece, start, length and the ids (unsigned, four bytes each, little-endian) of every document's pieces."""
    picked = docs.select("doc_id", whole(text).alias("text"))
    vocabulary = tokens.shared(docs.sparkSession, path)
    fields = [picked.schema["doc_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.byte_pairs(vocabulary, plain=False)
        for batch in batches:
            rows, held = [], 0
            for place, words in enumerate(batch.column(1)):
                ids = np.append(encoder.encode(words.as_py()), np.uint32(end)).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                starts = [0, *range(first, len(ids), capacity)]
                for piece, (start, stop) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    rows.append((place, piece, start, stop - start, ids[start:stop].tobytes()))
                held += ids.nbytes
                if held >= _BATCH_BYTES:
                    yield _batch(batch, rows, fields)
                    rows, held = [], 0
            if rows:
                yield _batch(batch, rows, fields)

    return picked.mapInArrow(run, T.StructType(fields))


def _batch(batch: pa.RecordBatch, rows: list[tuple], fields: list[T.StructField]) -> pa.RecordBatch:
    places, pieces, starts, lengths, ids = zip(*rows, strict=True)
    columns = [batch.column(0).take(pa.array(places)), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces(length, ...)``, none longer than a sequence, with ``sequence_id`` and ``offset``."""
    place = fresh_name(pieces, "_place")
    ranked = written(with_row_index(pieces, ["length"], place), "pack-ranked")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in ranked.groupBy("length").count().collect():  # at most as many rows as a sequence has tokens
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit a sequence of {capacity}")
        counts[length] = n
    plan = shortest_plan(counts, capacity)
    # Runs of pieces in order of length: how many come before, first sequence, pieces in each, offset, length.
    runs = np.array([(n, first, each, offset, length) for length in sorted(plan.runs) for n, first, each, offset in plan.runs[length]] or [(0,) * 5], np.int64)
    before = np.concatenate([[0], np.cumsum(runs[:, 0])[:-1]])
    shared = pieces.sparkSession.sparkContext.broadcast((before, runs))  # grows with the capacity, not with the pieces
    added = T.StructType([*ranked.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    number = ranked.columns.index(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, table = shared.value
        for batch in batches:
            at = batch.column(number).to_numpy()
            k = np.searchsorted(starts, at, side="right") - 1
            _, first, each, offset, length = table[k].T
            j = at - starts[k]
            columns = [*batch.columns, pa.array(first + j // each), pa.array(offset + j % each * length)]
            yield pa.RecordBatch.from_arrays(columns, names=added.names)

    return ranked.mapInArrow(run, added).drop(place)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids``: the ids of its pieces in order, from the result of ``pack`` on ``cut``."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``capacity`` pieces
    joined = F.aggregate(ordered, F.lit(b""), lambda ids, p: F.concat(ids, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


by_value(__name__)
