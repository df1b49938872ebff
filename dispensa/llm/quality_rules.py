"""Quality rules: a table of thresholds compiled into one projection.

Every rule compares a statistic of the text with bounds.  The statistics are
length, symbol, stop-word and line ratios, all built from SQL functions, so a
text is read once, no row leaves the JVM and nothing is shuffled.

Words are [^\\x20\\x09-\\x0D]+.  Null and empty texts have no words and fail the
base rule.  Repeated rows are judged each by itself.  An empty table gives an
empty result.  Extra columns are carried along if named in `keep`; those named
like the operator's own give way.

Windows of three words are told apart by 64 hash bits; two different windows of
one text of n words are taken for the same with a chance below n**2 / 2**65."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent function words of the languages at hand.
STOP_WORDS = {
    "en": "the be to of and that have with is in it for on are as was this by at from or an not which a he",
    "fr": "le la les de des du et en un une que qui dans pour par sur est au aux pas ne il elle ce se à",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er",
    "es": "el la los las de del y en un una que es por con para se no su al lo como más o",
}
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A text fails if the statistic is below `least` or above `most`; texts with fewer than `min_words` words are not judged by it."""

    name: str
    statistic: str
    least: float | None = None
    most: float | None = None
    min_words: int = 0


RULES = (
    Rule("word_length", "mean_word_length", least=2.0, most=20.0),
    Rule("symbol_ratio", "symbols_per_word", most=0.3),
    Rule("stop_words", "stop_word_ratio", least=0.02, min_words=50),
    Rule("duplicate_lines", "duplicate_line_ratio", most=0.5),
    Rule("ellipsis_lines", "ellipsis_line_ratio", most=0.3),
    Rule("bullet_lines", "bullet_line_ratio", most=0.9),
    Rule("upper_case", "upper_case_ratio", most=0.6),
)


def _count_chars(text: Column, chars: str) -> Column:
    """Characters of a class that is rare in texts."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{chars}]+", ""))


#: Up to so many distinct repeated windows are looked up one by one; beyond that windows are sorted with their positions.
FEW = 64


def _with_repeated_words(rows: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words inside three-word windows that are found twice or more.

    The windows' hashes are sorted, so that equal ones are neighbours, and the
    positions of the repeated ones are collected; a window's words that its left
    neighbour in the text does not cover already are counted.  That takes n log n
    steps, and no pair of windows is formed.  Each step is a column of its own,
    as a lambda would evaluate it anew for every element."""
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    inner = F.slice("hashes", 1, F.greatest(F.size("hashes") - 2, F.lit(0)))
    rows = rows.withColumn("windows", F.transform(inner, lambda h, i: F.xxhash64(h, F.get("hashes", i + 1), F.get("hashes", i + 2)))).drop("hashes")
    rows = rows.withColumn("ordered", F.sort_array("windows"))
    rows = rows.withColumn("twice", F.array_distinct(F.filter("ordered", lambda h, k: F.coalesce(h == F.get("ordered", k - 1), F.lit(False))))).drop("ordered")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.filter(placed, lambda _: F.lit(False))
    rows = rows.withColumn("placed", F.when(F.size("twice") > FEW, placed).otherwise(none))
    found = F.filter("placed", lambda w, k: F.coalesce(w["h"] == F.get("placed", k - 1)["h"], F.lit(False)) | F.coalesce(w["h"] == F.get("placed", k + 1)["h"], F.lit(False)))
    one_by_one = F.filter(F.transform("windows", lambda h, i: F.when(F.array_contains("twice", h), i)), lambda i: i.isNotNull())
    positions = F.when(F.size("twice") > FEW, F.sort_array(F.transform(found, lambda w: w["i"]))).when(F.size("twice") > 0, one_by_one).otherwise(F.array().cast("array<int>"))
    covered = F.aggregate(
        positions,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-9).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"]).cast("long")).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )
    return rows.withColumn("n_repeat_words", covered).drop("windows", "placed", "twice")


def judge_quality(docs: DataFrame, rules: Sequence[Rule] = RULES, keep: list[str] | None = None) -> DataFrame:
    """Counts, the base rule, every statistic, the failed rules and the verdict of each document.

    docs: doc_id, text.  Returns doc_id, the columns in `keep`, n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, the statistics,
    failed_rules (array of names), base_failed and kept."""
    stop = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    own = {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed_rules", "base_failed", "kept", *(r.statistic for r in rules)}
    extra = [c for c in keep or [] if c not in own]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("doc_id"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(extra)], text.alias("t"))
    rows = rows.withColumn("words", F.filter(F.split("t", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    rows = rows.withColumn("lines", F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = _with_repeated_words(rows)
    n, n_lines = F.size("words"), F.size("lines")
    rows = rows.select(
        "doc_id", *[f"keep_{i}" for i in range(len(extra))],
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _count_chars(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        (n_lines - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size(F.filter("words", lambda w: F.lower(w).isin(stop))).alias("n_stop"),
        n_lines.alias("n_lines"),
        F.size(F.filter("lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).alias("n_ellipsis"),
        F.size(F.filter("lines", lambda x: F.substring(F.ltrim(x), 1, 1).isin("-", "*", "•", "·", "–"))).alias("n_bullet"),
        _count_chars(F.col("t"), "A-Z").alias("n_upper"),
    )

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    statistics = {
        "mean_word_length": ratio("word_chars", "n_words"),
        "symbols_per_word": ratio("n_symbols", "n_words"),
        "stop_word_ratio": ratio("n_stop", "n_words"),
        "duplicate_line_ratio": ratio("n_dup_lines", "n_lines"),
        "ellipsis_line_ratio": ratio("n_ellipsis", "n_lines"),
        "bullet_line_ratio": ratio("n_bullet", "n_lines"),
        "upper_case_ratio": ratio("n_upper", "word_chars"),
    }
    failed = []
    for rule in rules:
        value, bad = statistics[rule.statistic], F.lit(False)
        if rule.least is not None:
            bad = bad | (value < rule.least)
        if rule.most is not None:
            bad = bad | (value > rule.most)
        failed.append(F.when(bad & (F.col("n_words") >= rule.min_words), F.lit(rule.name)))
    names = F.filter(F.array(*failed), lambda x: x.isNotNull()) if failed else F.array().cast("array<string>")
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select(
        "doc_id", *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(extra)],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        *[value.alias(name) for name, value in statistics.items()],
        names.alias("failed_rules"), base.alias("base_failed"), (~base & (F.size(names) == 0)).alias("kept"),
    )
