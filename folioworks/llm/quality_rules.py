"""Quality rules: a table of thresholds compiled into one projection.

Metrics and rules are column expressions; no user function runs.  Defined cases: a null text is
empty; a text without words fails on length; rows that repeat are judged one by one, alike; other
columns, whatever their names, are left alone.

The stop-word rule holds for texts of the languages in ``STOP_LANGUAGES``, by ``lang`` or, where that is
null, blank, unknown or absent, for texts without a majority of letters of another script than Latin; texts of other
languages pass it.  Texts mostly in a script that sets no spaces between words pass ``long_words`` too; the
base rules, which the contract fixes, count words between white space in any script.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.llm.common import let, whole, word_list

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = sorted(
    set(
        """
        the of and to in a is that it for on was be with as this by at are from
        der die und den von zu das mit sich des auf für ist im dem nicht ein eine als
        de la le et les en un du une que est pour qui dans par plus pas au
        el y los se del las por con no su para es al lo
        """.split()
    )
)
STOP_LANGUAGES = "en eng de deu ger fr fra fre es spa".split()
#: What tells no language.
UNKNOWN = ("", "und", "unknown")
#: Letters of scripts that set no spaces between words.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
PUNCTUATION = ".,;:!?\"'()[]"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``metric / per`` must lie between the bounds; a text without ``per`` passes."""

    name: str
    metric: str
    per: str | None = None
    least: float | None = None
    most: float | None = None


#: The base rules, which the contract fixes, come first.
BASE_RULES = (
    Rule("too_short", "n_words", least=20),
    Rule("repeated_windows", "n_repeat_words", "n_words", most=0.30),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", "n_symbols", "n_words", most=0.10),
    Rule("shouting", "n_bangs", "n_words", most=0.25),
    Rule("stuttering", "n_stutters", "n_words", most=0.20),
    Rule("few_stop_words", "n_stop_words", "n_words", least=0.06),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.40),
    Rule("short_words", "word_chars", "n_words", least=2.5),
    Rule("long_words", "word_chars", "n_words", most=12.0),
    Rule("no_letters", "n_letter_words", "n_words", least=0.70),
)


def _windows(words: Column) -> Column:
    """Hashes of all windows of eight words, built by doubling: pairs, fours, eights."""

    def doubled(hashes: Column, step: int) -> Column:
        return let(
            hashes,
            lambda a: F.zip_with(
                F.slice(a, F.lit(1), F.size(a) - step), F.slice(a, F.lit(1 + step), F.size(a) - step), lambda x, y: F.xxhash64(x, y)
            ),
        )

    return doubled(doubled(doubled(F.transform(words, lambda w: F.xxhash64(w)), 1), 2), 4)


def _covered(windows: Column) -> Column:
    """Words inside windows that occur more than once: sort by hash, compare neighbours, merge the places."""

    def by_place(ordered: Column) -> Column:
        same = F.zip_with(
            F.slice(ordered, F.lit(1), F.size(ordered) - 1),
            F.slice(ordered, F.lit(2), F.size(ordered) - 1),
            lambda x, y: x["h"] == y["h"],
        )
        marked = let(
            same,
            lambda e: F.zip_with(F.concat(F.array(F.lit(False)), e), F.concat(e, F.array(F.lit(False))), lambda a, b: a | b),
        )
        both = F.zip_with(ordered, marked, lambda s, m: F.struct(s["i"].alias("i"), m.alias("m")))
        places = F.sort_array(F.transform(F.filter(both, lambda s: s["m"]), lambda s: s["i"]))
        return let(
            places,
            lambda p: F.aggregate(
                F.zip_with(
                    F.slice(p, F.lit(1), F.size(p) - 1), F.slice(p, F.lit(2), F.size(p) - 1), lambda x, y: F.least(y - x, F.lit(WINDOW))
                ),
                F.lit(WINDOW),
                lambda n, step: n + step,
            ),
        )

    def count(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(ordered, by_place)).otherwise(F.lit(0))

    return let(windows, count)


def _metrics(text: Column, words: Column) -> dict[str, Column]:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_bangs": F.length(text) - F.length(F.translate(text, "!", "")),
        "_lines": let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))),
        "n_repeat_words": F.when(F.size(words) > WINDOW, _covered(_windows(words))).otherwise(F.lit(0)),
        "n_stop_words": F.size(F.filter(words, lambda w: F.trim(F.lower(w), F.lit(PUNCTUATION)).isin(STOP_WORDS))),
        "n_stutters": F.when(
            F.size(words) > 1,
            F.size(
                F.filter(
                    F.zip_with(
                        F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda x, y: x == y
                    ),
                    lambda same: same,
                )
            ),
        ).otherwise(F.lit(0)),
        "n_letter_words": F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))),
    }


METRICS = "n_words word_chars n_symbols n_bangs n_repeat_words n_stop_words n_stutters n_letter_words n_lines n_dup_lines".split()


def measured(text: Column) -> Column:
    """All metrics of a text as one struct of longs."""

    def fields(words: Column) -> Column:
        return F.struct(*[c.alias(n) for n, c in _metrics(whole(text), words).items()])

    def flat(m: Column) -> Column:
        column = {"n_lines": m["_lines"]["n"], "n_dup_lines": m["_lines"]["dup"]}
        return F.struct(*[column.get(n, m[n] if n not in column else None).cast("bigint").alias(n) for n in METRICS])

    return let(let(word_list(whole(text)), fields), flat)


def _mostly(text: Column, letters: str) -> Column:
    """Whether more than half of the text's letters are of a class."""
    of_class = F.length(F.regexp_replace(text, f"[^{letters}]", ""))
    return 2 * of_class > F.length(F.regexp_replace(text, r"[^\p{L}]", ""))


def _exempt(docs: DataFrame, text: Column) -> dict[str, Column]:
    """For rules that not every language is held to, whether a text is free of them."""
    foreign = _mostly(text, r"\p{L}&&[^\p{IsLatin}]")
    if "lang" in (c.lower() for c in docs.columns):
        lang = F.lower(F.trim(F.col("lang").cast("string")))
        foreign = F.when(F.coalesce(lang, F.lit("")).isin(*UNKNOWN), foreign).otherwise(~F.regexp_extract(lang, "^[a-z]*", 0).isin(*STOP_LANGUAGES))
    return {"few_stop_words": foreign, "long_words": _mostly(text, UNSPACED)}


def broken(metrics: Column, rules: Sequence[Rule] = RULES, exempt: Mapping[str, Column] | None = None) -> Column:
    """The names of the rules that the metrics break, in the table's order; ``exempt`` tells what is free of a rule."""

    def fails(rule: Rule) -> Column:
        low_or_high = outside(rule)
        # Only a text that breaks the rule is looked at for its script.
        return F.when(low_or_high, ~exempt[rule.name]).otherwise(F.lit(False)) if exempt and rule.name in exempt else low_or_high

    def outside(rule: Rule) -> Column:
        value, per = metrics[rule.metric].cast("double"), metrics[rule.per].cast("double") if rule.per else F.lit(1.0)
        too_low = value < rule.least * per if rule.least is not None else F.lit(False)
        return too_low | (value > rule.most * per) if rule.most is not None else too_low

    return F.filter(F.array(*[F.when(fails(r), F.lit(r.name)) for r in rules]), lambda name: name.isNotNull())


def judge(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Keys, metrics, ``base_failed``, ``kept`` and the broken rules of every row."""
    rest = [r for r in rules if r not in BASE_RULES]
    exempt = _exempt(docs, whole(text))

    def verdict(m: Column) -> Column:
        base = m["n_words"] < 20
        # In whole numbers, so that the bound itself passes exactly.
        base = base | (100 * m["n_repeat_words"] > 30 * m["n_words"])
        return F.struct(m.alias("metrics"), base.alias("base_failed"), broken(m, rest, exempt).alias("broken"))

    return (
        docs.select(*keys, let(measured(F.col(text)), verdict).alias("_verdict"))
        .select(*keys, "_verdict.metrics.*", "_verdict.base_failed", F.col("_verdict.broken").alias("_broken"))
        .withColumn("kept", ~F.col("base_failed") & (F.size("_broken") == 0))
        .withColumn("broken_rules", F.array_join("_broken", ","))
        .drop("_broken")
    )


def keep_good(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows that break no rule, with the columns they came with."""
    exempt = _exempt(docs, whole(text))
    verdict = let(
        measured(F.col(text)),
        lambda m: (m["n_words"] >= 20)
        & (100 * m["n_repeat_words"] <= 30 * m["n_words"])
        & (F.size(broken(m, [r for r in rules if r not in BASE_RULES], exempt)) == 0),
    )
    return docs.filter(verdict)


_STOP, _LISTED, _UNKNOWN = (", ".join(f"'{w}'" for w in words) for words in (STOP_WORDS, STOP_LANGUAGES, UNKNOWN))
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(lower(trim(lang)), '') AS lang FROM documents),
sc AS (SELECT r, CASE WHEN lang NOT IN ({_UNKNOWN}) THEN regexp_extract(lang, '^[a-z]*') NOT IN ({_LISTED})
         ELSE 2 * length(regexp_replace(letters, '\p{{Latin}}', '', 'g')) > length(letters) END AS is_foreign,
         2 * (length(letters) - length(regexp_replace(letters, '[\p{{Han}}\p{{Hiragana}}\p{{Katakana}}\p{{Thai}}\p{{Lao}}\p{{Khmer}}\p{{Myanmar}}]', '', 'g'))) > length(letters) AS unspaced
       FROM (SELECT r, lang, regexp_replace(text, '[^\p{{L}}]', '', 'g') AS letters FROM d)),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
u AS (SELECT r, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word, ws FROM w),
g AS (SELECT r, i, list_aggregate(list_slice(ws, i, i + 7), 'string_agg', ' ') AS gram FROM u WHERE i + 7 <= len(ws)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS k FROM dup) GROUP BY r),
ln AS (SELECT r, count(*) AS n, count(DISTINCT line) AS distinct_lines
       FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
st AS (SELECT r, sum(CASE WHEN trim(lower(word), '.,;:!?"''()[]') IN ({_STOP}) THEN 1 ELSE 0 END) AS n_stop,
              sum(CASE WHEN word = prev THEN 1 ELSE 0 END) AS n_stut,
              sum(CASE WHEN regexp_matches(word, '\p{{L}}') THEN 1 ELSE 0 END) AS n_letter
       FROM (SELECT r, word, lag(word) OVER (PARTITION BY r ORDER BY i) AS prev FROM u) GROUP BY r),
m AS (SELECT r, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(length(translate(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)), '')) AS BIGINT) AS word_chars,
       CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
       CAST(length(text) - length(replace(text, '!', '')) AS BIGINT) AS n_bangs,
       CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_stop, 0) AS BIGINT) AS n_stop_words,
       CAST(coalesce(n_stut, 0) AS BIGINT) AS n_stutters, CAST(coalesce(n_letter, 0) AS BIGINT) AS n_letter_words,
       CAST(coalesce(ln.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(ln.n - distinct_lines, 0) AS BIGINT) AS n_dup_lines
      FROM w LEFT JOIN cov USING (r) LEFT JOIN ln USING (r) LEFT JOIN st USING (r)),
j AS (SELECT m.*, is_foreign, unspaced, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, concat_ws(',',
       CASE WHEN n_symbols > 0.10::DOUBLE * n_words THEN 'symbols' END, CASE WHEN n_bangs > 0.25::DOUBLE * n_words THEN 'shouting' END,
       CASE WHEN n_stutters > 0.20::DOUBLE * n_words THEN 'stuttering' END, CASE WHEN n_stop_words < 0.06::DOUBLE * n_words AND NOT is_foreign THEN 'few_stop_words' END,
       CASE WHEN n_dup_lines > 0.40::DOUBLE * n_lines THEN 'repeated_lines' END, CASE WHEN word_chars < 2.5::DOUBLE * n_words THEN 'short_words' END,
       CASE WHEN word_chars > 12.0::DOUBLE * n_words AND NOT unspaced THEN 'long_words' END, CASE WHEN n_letter_words < 0.70::DOUBLE * n_words THEN 'no_letters' END) AS broken_rules
      FROM m JOIN sc USING (r))
SELECT * EXCLUDE (r, is_foreign, unspaced), NOT base_failed AND broken_rules = '' AS kept FROM j
"""
