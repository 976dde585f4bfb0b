"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystream.llm.common import BLANKS, let, word_array

SYMBOLS = "#*$%&|<>"
#: Frequent words of the languages the rules are meant for; the threshold on their share is low.
STOP_WORDS = (
    "a", "and", "for", "in", "is", "of", "that", "the", "to", "was", "with",
    "das", "der", "die", "ein", "eine", "mit", "und", "von", "zu",
    "de", "des", "du", "elle", "en", "et", "la", "le", "les", "que", "un", "une",
    "el", "los", "para", "por", "se", "una", "y",
)


@dataclass(frozen=True)
class Rule:
    """A document fails where ``metric`` is outside [least, most]; it counts from ``words`` words."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None
    words: int = 0


RULES = (
    Rule("short_words", "mean_word_chars", least=2.0),
    Rule("long_words", "mean_word_chars", most=30.0),
    Rule("symbols", "symbol_ratio", most=0.1),
    Rule("stop_words", "stop_word_ratio", least=0.02, words=100),
    Rule("repeated_lines", "dup_line_ratio", most=0.5),
    Rule("cut_lines", "ellipsis_line_ratio", most=0.5),
    Rule("list_lines", "bullet_line_ratio", most=0.9),
)


def _repeat_words(words: Column, width: int) -> Column:
    """Words that lie in windows of ``width`` words found twice or more in the text."""

    def covered(pairs: Column) -> Column:
        starts = F.sort_array(F.transform(
            F.filter(pairs, lambda x, k: F.coalesce(
                (x["h"] == F.get(pairs, k - 1)["h"]) | (x["h"] == F.get(pairs, k + 1)["h"]),
                x["h"] == F.get(pairs, k - 1)["h"], x["h"] == F.get(pairs, k + 1)["h"], F.lit(False))),
            lambda x: x["i"],
        ))
        return let(starts, lambda at: F.aggregate(
            F.transform(at, lambda s, k: F.least(F.lit(width), F.coalesce(F.get(at, k + 1) - s, F.lit(width)))),
            F.lit(0), lambda a, x: a + x,
        ))

    def of(w: Column) -> Column:
        windows = F.arrays_zip(w, *[F.slice(w, k + 1, F.size(w)) for k in range(1, width)])
        hashes = F.slice(F.transform(windows, lambda x: F.xxhash64(x)), F.lit(1), F.size(w) - (width - 1))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(
            let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered)))

    return F.when(F.size(words) < width, 0).otherwise(let(words, of)).cast("long")


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measure(docs: DataFrame, width: int = 5) -> DataFrame:
    """Counts and ratios of every whole text, in projections only.

    Null text counts as empty; all counts of a text without words are 0, and so are ratios
    with nothing below the line. Repeated rows are measured each, other columns are ignored.
    """
    text = F.col("text")
    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    split = bare.select(
        "doc_id", word_array(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0).alias("lines"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
    )
    stop = f"(?i)^(?:{'|'.join(STOP_WORDS)})$"
    counted = split.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words"), width).alias("n_repeat_words"),
        F.size(F.filter("words", lambda w: w.rlike(stop))).alias("n_stop"),
        F.size("lines").alias("n_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"(?:\.\.\.|…)[\x20\x09-\x0D]*$"))).alias("n_cut"),
        F.size(F.filter("lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).alias("n_bullet"),
    )
    words, lines = F.col("n_words"), F.col("n_lines")
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        _ratio(F.col("word_chars"), words).alias("mean_word_chars"),
        _ratio(F.col("n_symbols"), words).alias("symbol_ratio"),
        _ratio(F.col("n_stop"), words).alias("stop_word_ratio"),
        _ratio(F.col("n_dup_lines"), lines).alias("dup_line_ratio"),
        _ratio(F.col("n_cut"), lines).alias("ellipsis_line_ratio"),
        _ratio(F.col("n_bullet"), lines).alias("bullet_line_ratio"),
    )


def verdicts(measured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add ``failed``, the names of the rules a document fails, in the table's order."""

    def broken(r: Rule) -> Column:
        value = F.col(r.metric)
        tests = [value < r.least] * (r.least is not None) + [value > r.most] * (r.most is not None)
        outside = tests[0] if len(tests) == 1 else tests[0] | tests[1]
        return F.when(outside & (F.col("n_words") >= r.words), F.lit(r.name))

    return measured.withColumn("failed", F.array_compact(F.array(*[broken(r) for r in rules])))
