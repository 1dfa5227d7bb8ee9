"""Packing, alignment and resampling on small tables, against plain versions of the same and on odd rows."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import sentencepiece
import tokenizers
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioworks.llm import alignment, packing, resampling, tokens

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, block string, n string, _place string"
LONG = " ".join(f"w{i % 977}" for i in range(9_000))
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, LONG), (5, "Same words here again"), (5, "Same words here again"), (None, "one two three four five"),
    (7, "a ▁ b"), (8, " \n\t x  <s> <|endoftext|> <unk> é😀 日本語 \x00 z"), (9, "aaa" * 2_000), (10, "x" + " " * 3_000 + "y"), (11, "Ärger Über STRASSE don't 12345"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", "y", "z") for i, t in ODD], DOCS)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokens.BYTE_PAIRS)


@pytest.fixture(scope="module")
def pairs():
    with open(tokens.BYTE_PAIRS) as file:
        source = file.read()
    return {plain: tokens.BytePairs(source, plain) for plain in (False, True)}


def ids_of(library, text, plain):
    library.encode_special_tokens = plain
    return library.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_library_for_every_usual_sign(library, pairs):
    signs = [chr(c) for low, high in ((1, 0x250), (0x2010, 0x205F), (0x20A0, 0x20C0)) for c in range(low, high)]
    for sign in signs:
        for text in (f"a{sign}b {sign} 1{sign}{sign}2 {sign}", f"{sign} x", f"x{sign}"):
            assert pairs[True].encode(text).tolist() == ids_of(library, text, True), repr(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'sSt 1\n\tÄß–é日😀<|endoftext|>."), max_size=60), st.booleans())
def test_ids_are_those_of_the_library(text, plain):
    test_ids_are_those_of_the_library.both = getattr(test_ids_are_those_of_the_library, "both", None) or (
        tokenizers.Tokenizer.from_file(tokens.BYTE_PAIRS),
        {p: tokens.BytePairs(open(tokens.BYTE_PAIRS).read(), p) for p in (False, True)},
    )
    library, pairs = test_ids_are_those_of_the_library.both
    for part in (text, text.replace("é", "<|endoftext|>")):
        assert pairs[plain].encode(part).tolist() == ids_of(library, part, plain)


def placed(plan, counts):
    """Every piece of a plan as (sequence, offset, length)."""
    out = []
    for length, runs in plan.runs.items():
        assert sum(n for n, *_ in runs) == counts[length]
        for n, first, each, offset in runs:
            out += [(first + j // each, offset + j % each * length, length) for j in range(n)]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_plans_place_every_piece_once_and_waste_little(seed):
    rng = random.Random(seed)
    capacity = rng.choice([64, 500, 2048])
    shape = [lambda: rng.randrange(1, capacity + 1), lambda: rng.randrange(1, capacity // 8), lambda: min(capacity, 1 + int(rng.expovariate(4 / capacity))), lambda: capacity // 2 + 1][seed % 4]
    lengths = [shape() for _ in range(rng.choice([1, 40, 3000]))]
    counts = np.bincount(lengths, minlength=capacity + 1)
    plan = packing.shortest_plan(counts, capacity)
    pieces = placed(plan, counts)
    assert sorted(length for *_, length in pieces) == sorted(lengths)
    by_sequence = collections.defaultdict(list)
    for sequence, offset, length in pieces:
        by_sequence[sequence].append((offset, length))
    assert sorted(by_sequence) == list(range(plan.sequences))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    least = max(-(-sum(lengths) // capacity), sum(2 * length > capacity for length in lengths))
    assert plan.sequences <= least * 1.02 + 1


def test_groups_are_of_equal_cardinality_and_rounded_up():
    counts = np.zeros(101, np.int64)
    counts[[10, 50, 60, 90]] = [99, 5, 7, 4]
    groups = packing.linear_groups(counts, 20, 4)
    assert [sum(n for _, n in g) for g in groups] == [4, 4, 4, 4]
    assert [g[0][0] for g in groups] == [90, 60, 60, 50] and sum((g for g in groups), []) == [(90, 4), (60, 4), (60, 3), (50, 1), (50, 4)]
    assert packing.linear_groups(counts, 95, 4) == []


def test_configurations_are_optimal():
    # Twelve of 7 and twelve of 5 in sequences of 12: one of each, not two of 5.
    found = packing.configurations(np.array([7, 5]), np.array([12, 12]), 12)
    assert [(used.tolist(), times) for used, times in found] == [([1, 1], 12)]
    used = packing.best_configuration(np.array([1.0, 0.6]), np.array([7, 4]), 12)
    assert used.tolist() == [0, 3]


def test_pieces_and_sequences(odd, spark, library):
    pieces = packing.cut(odd)
    rows = pieces.collect()
    for doc_id, text in ODD:
        ids = np.array([*ids_of(library, text or "", False), 0], "<u4")
        own = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.piece)
        copies = sum(d == doc_id for d, _ in ODD)
        joined = b"".join(bytes(r.ids) for r in own[:: copies])
        assert joined == ids.tobytes()
        assert [r.length for r in own[::copies]] == ([(len(ids) - 1) % 2048 + 1] + [2048] * ((len(ids) - 1) // 2048))
    packed = packing.pack(pieces)
    found = packed.withColumn("ids_crc32", F.crc32("ids")).collect()
    assert len(found) == len(rows) and all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in found)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in found:
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert sum(map(len, whole.values())) == sum(4 * r.length for r in rows) and all(len(w) <= 4 * 2048 for w in whole.values())
    assert packing.pack(packing.cut(odd.limit(0))).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(2049,)], "length bigint"))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=60), st.lists(st.integers(1, 9), min_size=1, max_size=60))
def test_galloping_finds_ranks(longer, driver):
    longer, driver = np.cumsum(longer), np.cumsum(driver)
    driver = driver[driver <= longer[-1]]
    expected = np.searchsorted(longer, driver)
    assert alignment.gallop(longer, driver, np.zeros(len(driver), np.int64)).tolist() == expected.tolist()
    rank, there = alignment.ranks(longer, driver, np.zeros(len(driver), np.int64))
    assert rank.tolist() == expected.tolist() and there.tolist() == [x in set(longer.tolist()) for x in driver.tolist()]


def plainly_aligned(rows, library):
    """Figures of every row, by comparing byte ranges."""
    pieces = sentencepiece.SentencePieceProcessor(model_file=tokens.PIECES)
    signs = tokens.byte_signs()
    counts, links, out = collections.Counter(), [], []
    for _, text in rows:
        text = text or ""
        a, b = ids_of(library, " " + text, True), pieces.encode(text)
        a_bytes = [bytes(signs[c] for c in library.id_to_token(x)) for x in a]
        b_bytes = [bytes([int(pieces.id_to_piece(x)[3:5], 16)]) if pieces.is_byte(x) else pieces.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            a, b, a_bytes, b_bytes = [], [], [], []
        ends = [np.cumsum([0, *map(len, x)]).tolist() for x in (a_bytes, b_bytes)]
        common = sorted(set(ends[0][1:]) & set(ends[1][1:]))
        groups, before = [], 0
        for end in common:
            parts = [",".join(str(x) for x, s, e in zip(ids, at, at[1:], strict=False) if s >= before and e <= end) for ids, at in ((a, ends[0]), (b, ends[1]))]
            groups.append("|".join(parts))
            before = end
        own, first = [], 0
        for i, (s, e) in enumerate(zip(ends[0], ends[0][1:], strict=False)):
            while first < len(b) and ends[1][first + 1] <= s:
                first += 1
            j = first
            while j < len(b) and ends[1][j] < e:
                own.append((a[i], b[j]))
                j += 1
        links.append(own)
        counts.update(own)
        out.append([len(a), len(b), len(groups), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""])
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [tuple(o + [sum(counts[p] == most[p[1]] for p in own), sum(counts[p] for p in own)]) for o, own in zip(out, links, strict=True)]


@pytest.mark.parametrize("files", [1, 5])
def test_alignment_matches_byte_ranges(odd, spark, library, files):
    more = [(100 + i, " ".join(random.Random(i).choices(["The", "quick", "brünett", "fox's", "jump-ed", "12,5", "\n"], k=i))) for i in range(40)]
    docs = odd.select("doc_id", "text", "n").unionByName(spark.createDataFrame([(*r, "y") for r in more], "doc_id bigint, text string, n string")).repartition(files)
    got = alignment.digests(docs).collect()
    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert sorted(repr((r.doc_id, *[r[n] for n in names])) for r in got) == sorted(
        repr((i, *f)) for (i, _), f in zip([*ODD, *more], plainly_aligned([*ODD, *more], library), strict=True)
    )
    assert alignment.digests(docs.limit(0)).count() == 0
    lists = {r.doc_id: r for r in alignment.align(docs).collect()}
    for i, text in more[5:]:
        row = lists[i]
        assert row.a == ids_of(library, " " + text, True)
        assert row.a_last[-1] == len(row.a) - 1 and row.b_last[-1] == len(row.b) - 1 and len(row.a_last) == len(row.b_last)


def test_hashes_are_those_of_the_library():
    rng = random.Random(3)
    data = np.frombuffer(rng.randbytes(5_000) + b" " * 8, np.uint8).copy()
    starts = np.array([rng.randrange(0, 4_800) for _ in range(2_000)])
    lengths = np.array([rng.randrange(0, 100) for _ in range(2_000)])
    expected = [xxhash.xxh64_intdigest(data[s : s + n].tobytes()) for s, n in zip(starts, lengths, strict=True)]
    assert resampling.xxh64(data, starts, lengths).tolist() == expected


@pytest.mark.parametrize("hashes", ["real", "few", "one"])
def test_slots_hold_distinct_grams_whatever_the_hash(monkeypatch, hashes):
    if hashes != "real":
        monkeypatch.setattr(resampling, "xxh64", lambda data, starts, lengths: (lengths % (3 if hashes == "few" else 1)).astype(np.uint64))
    rng = random.Random(4)
    words = [("ab" * rng.randrange(1, 12) + rng.choice("xyz")).encode() for _ in range(400)]
    data = np.frombuffer(b"".join(words) + b" " * 8, np.uint8).copy()
    lengths = np.array([len(w) for w in words])
    starts = np.cumsum(lengths) - lengths
    slots = resampling.Slots(data, starts, lengths, 1000)
    assert len(slots.used) == len(set(words))
    for word, slot in zip(words, slots.of.tolist(), strict=True):
        assert slots.bucket[slot] == zlib.crc32(word) % 1000 and slots.count[slot] == words.count(word)


def plain_grams(text, longest):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_matches_plain_counts(odd, spark, longest):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(["the", "Cat", "sat", "on", "é", "x9", "mat", "日本"], k=rng.randrange(0, 60)))) for i in range(100, 160)]
    docs = odd.select("doc_id", "text", "n").unionByName(spark.createDataFrame([(*r, "y") for r in rows], "doc_id bigint, text string, n string"))
    target = spark.createDataFrame([("the cat", 1), ("mat on MAT", 2), (None, 3)], "text string, n int")
    every, buckets = [*ODD, *rows], 500
    s, t = collections.Counter(), collections.Counter()
    for counts, texts in ((s, [x for _, x in every]), (t, ["the cat", "mat on MAT"])):
        for text in texts:
            counts.update(zlib.crc32(g.encode()) % buckets for g in plain_grams(text, longest)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    expected, fit = [], []
    for i, text in every:
        words, grams = plain_grams(text, longest)
        weight = sum(gain[zlib.crc32(g.encode()) % buckets] for g in grams)
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        expected.append((i, len(grams), weight, score))
        if len(words) >= 20:
            fit.append((-score, i))
    drawn = {i: k + 1 for k, (_, i) in enumerate(sorted(fit)[: 30 * len(fit) // 100])}
    got = resampling.resample(docs, target, buckets=buckets, longest=longest, percent=30).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((*e, drawn.get(e[0]))) for e in expected)


def test_resampling_matches_its_sql_on_odd_and_empty_tables(odd, spark):
    target = spark.createDataFrame([("Same words", 1), ("", 2)], "text string, item_id bigint")
    for documents, benchmark in ((odd, target), (odd.limit(0), target), (odd, target.limit(0))):
        con = duckdb.connect()
        con.register("documents", documents.toArrow())
        con.register("benchmark", benchmark.toArrow())
        relation = con.sql(resampling.SQL)
        got = resampling.resample(documents, benchmark)
        assert sorted(map(repr, map(tuple, got.select(*relation.columns).collect()))) == sorted(map(repr, relation.fetchall()))
