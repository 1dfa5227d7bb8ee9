"""The pipeline on a small table of planted cases, stage by stage and as a whole, against plain decisions."""

from __future__ import annotations

import re

import corpus_pipeline
from folioworks.llm.common import table

WORDS = "the of and to in is was for that with as on by this his from at which are we be have had not but they".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _key string, _row string"


def prose(seed, n=60):
    """Clean English: stop words between words of its own."""
    return " ".join(WORDS[(seed * 7 + i) % len(WORDS)] if i % 2 else f"word{chr(97 + seed % 26)}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n)) + "."


ITEM = " ".join(f"item{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40))
CLEAN = {i: prose(i) for i in range(12)}
ROWS = [
    *[(i, t, "en", f"s{i % 3}") for i, t in CLEAN.items()],
    (20, CLEAN[3], "en", "s1"), (21, CLEAN[3], "en", "s2"), (None, CLEAN[3], "en", "s2"),  # copies: doc 3 stays
    (None, prose(14), "en", "s0"), (None, prose(14), "en", "s0"),  # without an id, twice the same: one stays
    (5, prose(15), "en", "s1"),  # shares its id with another text: both stay
    (30, prose(16, 30) + " " + ITEM + " " + prose(17, 30), "en", "s1"),  # holds a benchmark item
    (31, prose(18) + " password = hunter2hunter and hunter2hunter2 stays", "en", "s1"),  # one owner's secret
    (40, "too short", "en", "s1"), (41, None, "en", "s1"), (42, "", None, None),
]
SECRET = prose(18) + " password = [SECRET] and hunter2hunter2 stays"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, len(t or ""), "k", "r") for i, t, lang, source in rows], SCHEMA)


def test_pipeline_on_planted_cases(spark, tmp_path):
    documents(spark, ROWS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, texts = table(spark, str(tmp_path), "documents"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert sorted(docs.columns) == sorted(SCHEMA.replace(",", "").split()[::2]), name
        texts[name] = sorted((r.doc_id or -1, r.text) for r in docs.collect())
    good = [(i or -1, t) for i, t, *_ in ROWS if t and len(t) > 20]
    assert texts["quality_rules"] == sorted(good)
    copies = {(20, CLEAN[3]), (21, CLEAN[3]), (-1, CLEAN[3])}
    single = sorted({g for g in good if g not in copies})
    assert texts["simhash_dedup"] == single
    assert texts["decontamination"] == [g for g in single if g[0] != 30]
    kept = sorted((i, SECRET if i == 31 else t) for i, t in single if i != 30)
    assert texts["secret_scan"] == kept
    mixed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    sizes = sorted((i, len(re.findall("[^\x20\x09-\x0d]+", t))) for i, t in kept)
    assert sorted((r.doc_id or -1, r.size) for r in mixed) == sizes
    assert all(0 <= r.taken <= 3 * r.size for r in mixed)
    by_source = {r.source: r for r in mixed}
    for source, row in by_source.items():
        assert row.source_size == sum(r.size for r in mixed if r.source == source) and abs(sum(r.taken for r in mixed if r.source == source) - row.target) <= 200


def test_pipeline_of_nothing(spark, tmp_path):
    documents(spark, ROWS).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
