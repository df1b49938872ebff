"""Descriptions of medications as components, dosages and form: one native expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from . import vocabulary as voc
from .text import normalize_description

# A dose with its unit, and a number.
DOSE = r"\b(\d+(?:[.,]\d+)?)\s*(MG|MCG|G|UI|IU|GR|ML|%)\b"
NUMBER = r"\b(\d+(?:[.,]\d+)?)\b"


def form_phrase(clean: Column) -> Column:
    """The longest known spelling of a form in the text; null without one."""
    return F.coalesce(*[F.when(clean.rlike(rf"\b{k}\b"), F.lit(k)) for k in voc.FORM_ORDER])


def canonical_form(phrase: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in voc.FORMS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, phrase), F.lit(voc.UNKNOWN_FORM))


def _numbers(texts: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(texts, lambda x: F.translate(x, ",", ".").cast("double"))))


def dosages(rest: Column) -> Column:
    """Sorted distinct numbers before a unit, or all numbers if none has one."""
    with_unit = F.regexp_extract_all(rest, F.lit(DOSE), 1)
    return F.when(F.size(with_unit) > 0, _numbers(with_unit)).otherwise(_numbers(F.regexp_extract_all(rest, F.lit(NUMBER), 1)))


def components(rest: Column) -> Column:
    """Sorted names between plus signs, without doses, ignored words, numbers and single characters."""

    def name(part: Column) -> Column:
        said = F.filter(F.split(part, r"\s+"), lambda w: ~w.isin(voc.IGNORED_WORDS) & ~w.rlike(r"^\d+$") & (F.length(w) > 1))
        return F.array_join(said, " ")

    return F.array_sort(F.filter(F.transform(F.split(F.regexp_replace(rest, DOSE, " "), r"\+"), name), lambda x: x != ""))


def parse(df: DataFrame, column: str, prefix: str = "") -> DataFrame:
    """Adds original_clean, form, components and dosages of a description column."""
    step = df.withColumn("_clean", normalize_description(F.col(column))).withColumn("_phrase", form_phrase(F.col("_clean")))
    without = F.when(F.col("_phrase").isNull(), F.col("_clean")).otherwise(F.regexp_replace("_clean", F.concat(F.lit(r"\b"), F.col("_phrase"), F.lit(r"\b")), F.lit(" ")))
    step = step.withColumn("_rest", without)
    parsed = {"original_clean": F.col("_clean"), "form": canonical_form(F.col("_phrase")), "components": components(F.col("_rest")), "dosages": dosages(F.col("_rest"))}
    return step.withColumns({prefix + k: v for k, v in parsed.items()}).drop("_clean", "_phrase", "_rest")


def parse_distinct(df: DataFrame, column: str) -> DataFrame:
    """The distinct descriptions of a table, parsed: most deliveries repeat a few thousand of them.

    Written to the shared folder, since every step of a cascade reads it and the
    optimizer would otherwise copy the parser's 70 patterns into each of its filters."""
    return materialize(parse(df.select(column).distinct(), column), "parsed")
