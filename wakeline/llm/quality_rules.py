"""Operator 8: a table of thresholds compiled into one projection.

Every metric is a Spark expression over the whole text and the verdict is one
boolean expression built from the rule table, so a document is judged by one map
stage: no shuffle, no user functions. A metric that is used several times is
bound once with :func:`let`, because expressions repeated inside lambda functions
are not shared by the optimizer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Function words of the four corpus languages.
STOP_WORDS = {
    "en": "the of and to in a is that it for on was as with be by this are or an at from not".split(),
    "fr": "le la les de des du et un une en que qui dans pour pas sur par au ce il est".split(),
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als".split(),
    "es": "el la los las de que y en un una por con no para su al lo como se es del".split(),
}


@dataclass(frozen=True)
class Rule:
    """Keep a document only while ``low <= metric <= high`` (a missing bound is open)."""

    metric: str
    low: float | None = None
    high: float | None = None


# bounds in the spirit of published web-corpus filters
RULES = (
    Rule("n_words", low=50),
    Rule("mean_word_chars", low=2, high=15),
    Rule("symbols_per_word", high=0.1),
    Rule("stop_word_share", low=0.02),
    Rule("dup_line_share", high=0.5),  # a text of a few lines may repeat one
    Rule("bullet_line_share", high=0.9),
    Rule("ellipsis_line_share", high=0.3),
    Rule("repeat_word_share", high=0.5),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice in ``words``.

    Windows are sorted with their start, so equal windows are neighbours; the
    starts of windows with an equal neighbour, in order, each add the part of
    their three words that the previous one does not cover.
    """
    def same(a: Column, b: Column) -> Column:
        return (a["a"] == b["a"]) & (a["b"] == b["b"]) & (a["c"] == b["c"])

    def covered(starts: Column) -> Column:
        state = F.aggregate(
            starts,
            F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
            lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(3), p - s["last"])).alias("n")),
        )
        return let(state, lambda s: s["n"])

    def repeated_starts(grams: Column) -> Column:
        n = F.size(grams)
        hits = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.when(i > 0, same(F.get(grams, i - 1), F.get(grams, i))).otherwise(F.lit(False))
            | F.when(i < n - 1, same(F.get(grams, i + 1), F.get(grams, i))).otherwise(F.lit(False)),
        )
        return F.array_sort(F.transform(hits, lambda i: F.get(grams, i)["i"]))

    grams = F.sort_array(F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.get(words, i).alias("a"), F.get(words, i + 1).alias("b"),
                           F.get(words, i + 2).alias("c"), i.alias("i"))))
    return F.when(F.size(words) >= 4, let(grams, lambda g: let(repeated_starts(g), covered))).otherwise(F.lit(0))


def _line_counts(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda ls: F.struct(
        F.size(ls).alias("lines"),
        (F.size(ls) - F.size(F.array_distinct(ls))).alias("dup"),
        F.size(F.filter(ls, lambda s: s.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).alias("bullet"),
        F.size(F.filter(ls, lambda s: s.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).alias("ellipsis"),
    ))


def document_metrics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts that the rules use, for every document (null text: no words)."""
    text = F.coalesce(docs["text"], F.lit(""))
    stop = sorted({w for words in STOP_WORDS.values() for w in words})
    per_word = let(_words(text), lambda ws: F.struct(
        F.size(ws).alias("words"),
        _repeat_words(ws).alias("repeat"),
        F.size(F.filter(ws, lambda w: F.lower(F.translate(w, ".,;:", "")).isin(stop))).alias("stop"),
    ))
    return docs.select(
        docs["doc_id"],
        per_word.alias("w"),
        _line_counts(text).alias("l"),
        F.length(F.translate(text, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    ).select(
        "doc_id",
        F.col("w.words").cast("long").alias("n_words"),
        "word_chars", "n_symbols",
        F.col("l.dup").cast("long").alias("n_dup_lines"),
        F.col("w.repeat").cast("long").alias("n_repeat_words"),
        F.col("w.stop").cast("long").alias("n_stop_words"),
        F.col("l.lines").cast("long").alias("n_lines"),
        F.col("l.bullet").cast("long").alias("n_bullet_lines"),
        F.col("l.ellipsis").cast("long").alias("n_ellipsis_lines"),
    )


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


METRICS: dict[str, Callable[[], Column]] = {
    "n_words": lambda: F.col("n_words"),
    "mean_word_chars": lambda: _share("word_chars", "n_words"),
    "symbols_per_word": lambda: _share("n_symbols", "n_words"),
    "stop_word_share": lambda: _share("n_stop_words", "n_words"),
    "dup_line_share": lambda: _share("n_dup_lines", "n_lines"),
    "bullet_line_share": lambda: _share("n_bullet_lines", "n_lines"),
    "ellipsis_line_share": lambda: _share("n_ellipsis_lines", "n_lines"),
    "repeat_word_share": lambda: _share("n_repeat_words", "n_words"),
}


def compile_rules(rules: Sequence[Rule]) -> Column:
    """The names of the rules that a document breaks, as one array expression."""
    def broken(rule: Rule) -> Column:
        value = METRICS[rule.metric]()
        checks = [value < rule.low] if rule.low is not None else []
        checks += [value > rule.high] if rule.high is not None else []
        hit = checks[0] if len(checks) == 1 else checks[0] | checks[1]
        return F.when(hit, F.lit(rule.metric))

    return F.array_compact(F.array(*(broken(r) for r in rules if r.low is not None or r.high is not None)))


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Metrics, the broken rules and the verdict of every document.

    Defined cases: a null or empty text has no words and is dropped by the word
    count; repeated rows are judged each; a null doc_id passes through; an empty
    table gives an empty result; other columns of ``docs`` are ignored.
    """
    judged = document_metrics(docs).withColumn("failed_rules", compile_rules(rules))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.withColumn("base_failed", base_failed).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def op8_quality_rules(spark, sf_dir):
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _op8_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws}))
    bounds = {r.metric: r for r in RULES}
    space = r"[\x20\x09-\x0D]"
    word = r"[^\x20\x09-\x0D]"
    return f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{word}+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '{word}')) AS ls
  FROM documents),
grams AS (
  SELECT doc_id, i, ws[i + 1] AS a, ws[i + 2] AS b, ws[i + 3] AS c
  FROM (SELECT doc_id, ws, unnest(range(len(ws) - 2)) AS i FROM t WHERE len(ws) >= 4)),
hits AS (
  SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM hits) GROUP BY doc_id),
m AS (
  SELECT t.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '{space}+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(ws, lambda w: lower(regexp_replace(w, '[.,;:]', '', 'g')) IN ({stop}))) AS n_stop,
         len(ls) AS n_lines,
         len(list_filter(ls, lambda s: regexp_matches(s, '^{space}*[-*•]'))) AS n_bullet,
         len(list_filter(ls, lambda s: regexp_matches(s, '([.][.][.]|…){space}*$'))) AS n_ell
  FROM t LEFT JOIN rep ON rep.doc_id = t.doc_id),
j AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND n_words >= {bounds['n_words'].low}
       AND word_chars / n_words BETWEEN {bounds['mean_word_chars'].low} AND {bounds['mean_word_chars'].high}
       AND n_symbols / n_words <= {bounds['symbols_per_word'].high}
       AND n_stop / n_words >= {bounds['stop_word_share'].low}
       AND n_dup_lines / n_lines <= {bounds['dup_line_share'].high}
       AND n_bullet / n_lines <= {bounds['bullet_line_share'].high}
       AND n_ell / n_lines <= {bounds['ellipsis_line_share'].high}
       AND n_repeat_words / n_words <= {bounds['repeat_word_share'].high} AS kept
FROM j
"""


OP8_SQL = _op8_sql()
