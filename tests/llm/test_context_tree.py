"""Scores of the context trees against a plain weighting that keeps every node in a dictionary."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest

from folioworks.llm import context_tree


def plain_scores(docs, depth):
    """Log10 of each text's probability, from the definition."""
    nodes = defaultdict(lambda: [0, 0])  # (decisions so far, context, latest byte last) -> zeros, ones
    kids = defaultdict(set)

    def decisions(stream):
        padded = b"\n" * depth + stream
        for at, byte in enumerate(stream):
            context = padded[at : at + depth]
            for bit in range(8):
                yield (bit, byte >> (8 - bit)), context, byte >> (7 - bit) & 1

    streams = [context_tree.normal(text)[1] for _, text in docs]
    for (doc_id, _), stream in zip(docs, streams, strict=True):
        if not context_tree.held_out(doc_id):
            for tree, context, one in decisions(stream):
                for length in range(depth + 1):
                    nodes[tree, context[depth - length :]][one] += 1
                    if length:
                        kids[tree, context[depth - length + 1 :]].add(context[depth - length :])

    def kt(zeros, ones):
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.log(math.pi) - math.lgamma(zeros + ones + 1)

    stops, known = {}, {}

    def weighted(tree, context):
        if (tree, context) not in known:
            own = kt(*nodes[tree, context])
            known[tree, context] = own
            if len(context) < depth:
                below = sum(weighted(tree, c) for c in kids[tree, context])
                top = max(own, below)
                known[tree, context] = top + math.log(math.exp(own - top) + math.exp(below - top)) - math.log(2)
                stops[tree, context] = math.exp(own - math.log(2) - known[tree, context])
        return known[tree, context]

    def probability(tree, context, one):
        out = None
        for length in range(depth, -1, -1):
            at = tree, context[depth - length :]
            own = (nodes[at][one] + 0.5) / (sum(nodes[at]) + 1)
            weighted(*at)
            out = own if out is None else stops[at] * own + (1 - stops[at]) * out
        return out

    return [sum(math.log10(probability(*d)) for d in decisions(stream)) for stream in streams]


@pytest.mark.parametrize("depth", [3, 5, 6])
def test_scores_are_those_of_a_plain_weighting(spark, depth):
    rng = random.Random(depth)
    words = ["the", "then", "there", "other", "Another", "é", "naïve", "x", "banana", "bandana", "aaaaaaaa", "漢字"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 25)))) for i in range(40)]
    docs += [(40, None), (41, ""), (7, docs[7][1]), (None, docs[3][1]), (42, " \t one\n\ntwo  ")]
    got = context_tree.score(spark.createDataFrame(docs, "doc_id bigint, text string"), depth).collect()
    want = sorted((i is None, i or 0, s) for (i, _), s in zip(docs, plain_scores(docs, depth), strict=True))
    assert [r[:2] for r in want] == sorted((r.doc_id is None, r.doc_id or 0) for r in got)
    for (_, _, plain), own in zip(want, sorted((r.doc_id is None, r.doc_id or 0, r.score) for r in got), strict=True):
        assert own[2] == pytest.approx(plain, rel=1e-6)


def test_repetition_is_learnt(spark):
    text = "a passage that many documents hold word for word"
    docs = [(i, text) for i in range(60)] + [(100, "zq vxk jjw qqz")]
    rows = context_tree.score(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert max(r.bits_per_byte for r in rows if r.doc_id < 60) < 1 < min(r.bits_per_byte for r in rows if r.doc_id == 100)


def test_depths_out_of_range_are_refused(spark):
    for depth in (2, 7):
        with pytest.raises(ValueError):
            context_tree.score(spark.createDataFrame([(1, "x")], "doc_id bigint, text string"), depth)
