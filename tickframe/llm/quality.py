"""Quality rules: a threshold table compiled into one projection.

Measures are Spark expressions over the text alone; ``RULES`` names, for each
measure, the range a document must stay in.  ``verdict`` turns the table into
one boolean expression, so measuring and judging is a single projection
without a shuffle and without user functions.

A word is ``[^\\x20\\x09-\\x0D]+``.  Null text has no words (every count 0).
Every row is judged on its own, so repeated rows and ties do not interact;
an empty table gives an empty result.  ``judge`` adds the measures as columns and
replaces input columns of the same name; ``judged`` puts them into one struct,
and ``passing`` returns the input's own columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Common function words of the four corpus languages, fixed values.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "are", "as", "with", "he", "be", "by", "at", "this",
    "from", "or", "an", "a",
    "der", "die", "das", "und", "von", "den", "dem", "im", "mit", "des", "auf", "sich", "nicht", "zu", "als", "ein", "eine", "auch",
    "für", "ist",
    "le", "la", "les", "de", "du", "et", "un", "une", "en", "que", "qui", "dans", "pour", "par", "sur", "au", "il", "elle", "pas", "est",
    "el", "los", "las", "del", "y", "se", "una", "con", "no", "para", "por", "su", "al", "lo", "como",
)
WORD_SEPARATORS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Words of a window (a power of two) that counts as repeated when found twice in a text.
REPEAT_WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """A document passes if low <= measure <= high; a missing bound is open."""
    measure: str
    low: float | None = None
    high: float | None = None


#: The base rules: too short, or too much text repeated word by word.
BASE_RULES = (
    Rule("n_words", low=20),
    Rule("repeat_pct", high=30),
)
#: The method's own table, on top of the base rules.
RULES = (
    Rule("mean_word_chars", low=2, high=20),
    Rule("symbol_ratio", high=0.08),
    Rule("stop_ratio", low=0.03),
    Rule("dup_line_ratio", high=0.4),
)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is read."""
    return F.transform(F.array(value), use)[0]


def _repeat_words(words: Column, n: Column) -> Column:
    """Words covered by windows of REPEAT_WINDOW words that occur twice or more.

    The windows' hashes are sorted with their positions; equal neighbours (the
    words themselves compared as well) are repeated windows.  Their sorted
    positions p1 < p2 < ... cover min(window, next - own) words each, the last
    one a whole window.  The sort runs only if a hash occurs twice.
    """
    k = REPEAT_WINDOW
    def paired(h: Column, span: int, then: Callable[[Column], Column]) -> Column:
        """Hashes of twice as many words from hashes of ``span`` words, up to a whole window."""
        if span == k:
            return then(h)
        twice = F.transform(F.sequence(F.lit(0), n - 2 * span), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + span)))
        return _bind(twice, lambda x: paired(x, 2 * span, then))

    def alike(a: Column, b: Column) -> Column:
        same = a["h"] == b["h"]
        for j in range(k):
            same = same & (F.get(words, a["i"] + j) == F.get(words, b["i"] + j))
        return same

    def repeated(s: Column) -> Column:
        """Positions in ``s``, sorted by hash, whose neighbour is the same window."""
        last = F.size(s) - 1
        return F.filter(s, lambda x, j: ((j > 0) & alike(x, F.get(s, j - 1))) | ((j < last) & alike(x, F.get(s, j + 1))))

    def total(p: Column) -> Column:
        covers = F.transform(p, lambda x, j: F.coalesce(F.least(F.get(p, j + 1) - x, F.lit(k)), F.lit(k)))
        return F.aggregate(covers, F.lit(0), lambda acc, x: acc + x)

    def covered(h: Column) -> Column:
        s = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return _bind(_bind(s, lambda v: F.sort_array(F.transform(repeated(v), lambda x: x["i"]))), total)

    several = _bind(F.transform(words, lambda w: F.xxhash64(w)), lambda a: paired(a, 1, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))
    return F.when(n >= k + 1, several).otherwise(F.lit(0))


def _ratios(of: Callable[[str], Column]) -> dict[str, Column]:
    per_word = F.greatest(of("n_words"), F.lit(1))
    return {
        "mean_word_chars": of("word_chars") / per_word,
        "symbol_ratio": of("n_symbols") / F.greatest(of("word_chars"), F.lit(1)),
        "stop_ratio": of("n_stop_words") / per_word,
        "dup_line_ratio": of("n_dup_lines") / F.greatest(of("n_lines"), F.lit(1)),
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")


def measures(df: DataFrame, into: str, text: str = "text") -> DataFrame:
    """``df`` with a struct column ``into`` of the counts of the rules.

    The struct is generated (a one-row explode), so a filter on a measure stops
    there: pushed into the projections below, it would take the words of a text
    apart again for every use.
    """
    words, lines = common.fresh(df, "words"), common.fresh(df, "lines")
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    gone = F.translate(t, WORD_SEPARATORS, "")
    df = df.withColumns({words: _words(t), lines: F.filter(F.split(t, "\n"), lambda x: F.translate(x, WORD_SEPARATORS, "") != "")})
    counts = (
        F.size(words),
        F.char_length(gone),
        F.char_length(gone) - F.char_length(F.translate(gone, SYMBOLS, "")),
        F.size(lines) - F.size(F.array_distinct(lines)),
        _repeat_words(F.col(words), F.size(words)),
        F.size(lines),
        F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))),
    )
    row = F.struct(*[x.cast("long").alias(c) for c, x in zip(COUNTS, counts, strict=True)])
    return df.withColumn(into, F.explode(F.array(row))).drop(words, lines)


def verdict(rules: tuple[Rule, ...], of: Callable[[str], Column]) -> Column:
    """The threshold table as one boolean expression over measures: true if all rules hold."""
    out = F.lit(True)
    for r in rules:
        # the percentage rule is judged in whole numbers: 100 * a > high * b
        if r.measure == "repeat_pct":
            out = out & (100 * of("n_repeat_words") <= int(r.high) * of("n_words"))
            continue
        if r.low is not None:
            out = out & (of(r.measure) >= r.low)
        if r.high is not None:
            out = out & (of(r.measure) <= r.high)
    return out


RESULTS = (*COUNTS, "mean_word_chars", "symbol_ratio", "stop_ratio", "dup_line_ratio", "base_failed", "kept")


def judged(df: DataFrame, into: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with a struct column ``into`` of the measures, ``base_failed`` and ``kept``; its own columns stay as they are."""
    name = common.fresh(df, "measured")
    out = measures(df, name, text)
    ratios = _ratios(lambda c: F.col(f"{name}.{c}"))

    def of(c: str) -> Column:
        return ratios[c] if c in ratios else F.col(f"{name}.{c}")

    failed = ~verdict(BASE_RULES, of)
    every = F.struct(*[f"{name}.{c}" for c in COUNTS], *[x.alias(c) for c, x in ratios.items()], failed.alias("base_failed"),
                     (~failed & verdict(rules, of)).alias("kept"))
    return out.withColumn(into, every).drop(name)


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with the measures, ``base_failed`` and ``kept`` as columns."""
    name = common.fresh(df, "quality")
    out = judged(df, name, text, rules)
    return out.withColumns({c: F.col(f"{name}.{c}") for c in RESULTS}).drop(name)


def passing(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` that pass the base rules and the table, with their own columns only."""
    name = common.fresh(df, "quality")
    return judged(df, name, text, rules).filter(F.col(f"{name}.kept")).drop(name)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(common.documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + {REPEAT_WINDOW - 1}), ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {REPEAT_WINDOW} + 2)) AS i FROM w)),
many AS (SELECT doc_id, g FROM win GROUP BY doc_id, g HAVING count(*) > 1),
twice AS (SELECT doc_id, i FROM win JOIN many USING (doc_id, g)),
cov AS (
  SELECT doc_id, count(DISTINCT pos) AS n
  FROM (SELECT doc_id, unnest(range(i, i + {REPEAT_WINDOW})) AS pos FROM twice) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
         coalesce(n, 0) AS n_repeat_words,
         len(list_filter(words, lambda x: list_contains([{stop}], lower(x)))) AS n_stop
  FROM w LEFT JOIN cov USING (doc_id)),
j AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND word_chars / greatest(n_words, 1) BETWEEN 2 AND 20
         AND n_symbols / greatest(word_chars, 1) <= 0.08 AND n_stop / greatest(n_words, 1) >= 0.03
         AND n_dup_lines / greatest(n_lines, 1) <= 0.4 AS kept
FROM j
"""


SQL = _sql()
