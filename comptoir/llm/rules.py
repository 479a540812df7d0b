"""Quality rules: a threshold table compiled into one native Spark projection.

Every measure is a built-in column expression over the whole text; no user
function runs. A word is a maximal run of characters other than space and
U+0009..U+000D; a line is what ``\\n`` separates. Null and empty texts have no
word and fail the length rule. A measure whose divisor is zero is zero.

Work per document is linear in its length, but for the sort of the window
hashes of documents that repeat a run of four words. Equal windows are equal
64-bit hashes within one document. An empty table gives no row; repeated rows and null ids are
judged like others; very long texts are measured whole; input columns that clash with a measure's name are
replaced by ``judge`` and left alone by ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.llm._util import ASCII_SPACE

SPACE_RE = r"[\x20\x09-\x0D]+"
WORD_RE = r"[^\x20\x09-\x0D]"
SYMBOL_RE = "[#*$%&|<>]"
WINDOW = 8

# Frequent function words of the supported languages (fixed values).
STOP_WORDS = (
    "the of and to in a is that it for on was be with as by this are or at from",
    "de la le les des et en un une que qui est pas pour dans sur avec du au par",
    "der die das und in den von zu mit ist des auf für ein eine nicht als auch es",
    "de la que el en y a los del se las por un para con no una su al es lo",
)


@dataclass(frozen=True)
class Rule:
    """A document passes when ``low <= measure <= high`` (a bound may be absent)."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (F.col(self.measure) >= F.lit(self.low))
        if self.high is not None:
            ok = ok & (F.col(self.measure) <= F.lit(self.high))
        return ok


#: Base rules in whole numbers (the share of repeated words as integers, free of rounding).
BASE = (Rule("too_few_words", "n_words", low=20), Rule("repeated_words", "_repeat_excess", high=0))

#: The threshold table of the method.
RULES = (
    Rule("word_length", "mean_word_chars", low=2.0, high=20.0),
    Rule("symbols", "symbols_per_word", high=0.25),
    Rule("shouting", "marks_per_word", high=0.5),
    Rule("stop_words", "stop_word_share", low=0.02),
    Rule("duplicate_lines", "dup_line_share", high=0.35),
    Rule("ellipsis_lines", "ellipsis_line_share", high=0.3),
    Rule("bullet_lines", "bullet_line_share", high=0.9),
)


def _count(t: Column, char_class: str) -> Column:
    return (F.length(t) - F.length(F.regexp_replace(t, char_class, ""))).cast("long")


def _runs(name: str, step: int, n: Column) -> Column:
    """Hashes of runs of ``2 * step`` words from those of ``step`` words; the first ``n``."""
    twice = F.transform(name, lambda h, i: F.xxhash64(h, F.get(F.col(name), i + step)))
    return F.slice(twice, 1, F.greatest(n, F.lit(0)).cast("int"))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures of ``text``; columns of the input are kept.

    Input columns that bear the name of a measure are replaced by it.
    """
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text).alias("_text"))
    t = F.coalesce(F.col("_text"), F.lit(""))
    stripped = F.expr(f"trim(BOTH {_sql(ASCII_SPACE)} FROM coalesce(_text, ''))")
    d = d.withColumn("_words", F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, SPACE_RE)))
    d = d.withColumn("_lines", F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD_RE)))
    d = d.withColumn("n_words", F.size("_words").cast("long"))
    # Hashes of 2, 4 and 8 consecutive words. A text whose 4-word runs all differ
    # repeats no window; only the others hash and sort their windows (hash, place).
    d = d.withColumn("_two", F.transform("_words", lambda w, i: F.xxhash64(w, F.get(F.col("_words"), i + 1))))
    d = d.withColumn("_four", _runs("_two", 2, F.col("n_words") - 3))
    d = d.withColumn("_windows", F.when(F.size(F.array_distinct("_four")) < F.size("_four"),
                                        _runs("_four", 4, F.col("n_words") - 7)))
    d = d.withColumn("_sorted", F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    s = F.col("_sorted")
    d = d.withColumn("_places", F.when(s.isNotNull(), F.sort_array(F.transform(
        F.filter(s, lambda x, i: ((i > 0) & (F.get(s, F.greatest(i - 1, F.lit(0)))["h"] == x["h"]))
                 | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))),
        lambda x: x["i"]))))
    p = F.col("_places")
    covered = F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1), x + WINDOW) - x).cast("long")),
        F.lit(0).cast("long"), lambda a, x: a + x)
    stop = sorted({x for lang in STOP_WORDS for w in lang.split() for x in (w, w.capitalize())})
    n_lines = F.size("_lines").cast("long")
    d = d.select(
        *[F.col("_row")[c].alias(c) for c in docs.columns if c.lower() not in _MEASURES], "n_words",
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _count(t, SYMBOL_RE).alias("n_symbols"),
        _count(t, "[!?]").alias("_marks"),
        (n_lines - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(p.isNotNull(), covered).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size(F.filter("_words", lambda w: w.isin(stop))).cast("long").alias("_stops"),
        n_lines.alias("n_lines"),
        F.size(F.filter("_lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).cast("long").alias("_ellipsis"),
        F.size(F.filter("_lines", lambda x: F.ltrim(x).rlike(r"^[-*•]"))).cast("long").alias("_bullets"),
    )
    w, n = F.col("n_words"), F.col("n_lines")
    return d.withColumns({
        "_repeat_excess": 100 * F.col("n_repeat_words") - 30 * w,
        "mean_word_chars": _share(F.col("word_chars"), w),
        "symbols_per_word": _share(F.col("n_symbols"), w),
        "marks_per_word": _share(F.col("_marks"), w),
        "stop_word_share": _share(F.col("_stops"), w),
        "dup_line_share": _share(F.col("n_dup_lines"), n),
        "ellipsis_line_share": _share(F.col("_ellipsis"), n),
        "bullet_line_share": _share(F.col("_bullets"), n),
    }).drop("_marks", "_stops", "_ellipsis", "_bullets")


_MEASURES = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "mean_word_chars",
             "symbols_per_word", "marks_per_word", "stop_word_share", "dup_line_share", "ellipsis_line_share",
             "bullet_line_share", "base_failed", "failed_rules", "kept"}


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures plus ``base_failed``, ``failed_rules`` (names) and ``kept``."""
    m = measures(docs, text)
    failed = F.filter(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in (*BASE, *rules)]), lambda x: x.isNotNull())
    m = m.withColumn("failed_rules", failed)
    base = F.arrays_overlap(F.col("failed_rules"), F.array(*[F.lit(r.name) for r in BASE]))
    return m.withColumn("base_failed", base).withColumn("kept", F.size("failed_rules") == 0).drop("_repeat_excess")


def keep(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(text).alias("_judged"))
    # Not a filter: the optimizer would push it below the projections and so repeat their expressions.
    return judge(packed, "_judged", rules).select(F.inline(F.when(F.col("kept"), F.array("_doc"))))


def _sql(s: str) -> str:
    return "'" + s.encode("unicode_escape").decode().replace("\\x0b", "\\u000B").replace("\\x0c", "\\u000C") + "'"
