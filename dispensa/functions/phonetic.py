"""Phonetic codes, significant words and numeric features of descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as voc
from .similarity import indel_ratio
from .text import text_or_empty

# Consonants with a digit, and the digits.
_LETTERS, _DIGITS = "BFPVCGJKQSXZDTLMNR", "111122222222334556"
_AMOUNT = r"(\d+(?:[.,]\d+)?)"


def phonetic_code(word: Column) -> Column:
    """First letter and up to three digits; a digit equal to the last one is skipped, also across vowels."""
    upper = F.upper(text_or_empty(word))
    first = F.substring(upper, 1, 1)
    coded = F.translate(F.regexp_replace(upper, f"[^{_LETTERS}]", ""), _LETTERS, _DIGITS)
    for d in "123456":
        coded = F.regexp_replace(coded, f"{d}+", d)
    rest = F.when(first.rlike(f"[{_LETTERS}]"), F.expr("null")).otherwise(coded)
    rest = F.coalesce(rest, F.substring(coded, 2, 100))
    return F.when(upper == "", F.lit("")).otherwise(F.rpad(F.concat(first, rest), 4, "0"))


def significant_words(text: Column) -> Column:
    """Words of three characters and more that are neither numbers nor stop words, in order."""
    words = F.split(F.translate(F.upper(text_or_empty(text)), ".", " "), r"\s+")
    return F.filter(words, lambda w: ~w.rlike(r"^\d+[.,]?\d*$") & (F.length(w) >= 3) & ~w.isin(voc.STOP_WORDS))


def first_word_matches(a: Column, b: Column, fuzzy: bool = True) -> Column:
    """Whether the first significant words are equal, alike (over 85) or sound alike; true if a side has none."""
    x, y = F.get(significant_words(a), 0), F.get(significant_words(b), 0)
    alike = (x == y) | ((F.length(x) >= 4) & (F.length(y) >= 4) & (phonetic_code(x) == phonetic_code(y)))
    if fuzzy:
        alike = alike | (indel_ratio(x, y) > 85)
    return x.isNull() | y.isNull() | alike


def numeric_features(text: Column) -> Column:
    """Sorted distinct amounts before a unit; a percentage also times ten; X MG Y ML also X / Y."""
    number = lambda x: F.translate(x, ",", ".").cast("double")
    plain = F.transform(F.regexp_extract_all(text, F.lit(rf"\b{_AMOUNT}\s+(?:(?:MG|MCG|G|UI|IU|GR|ML)\b|%)"), 1), number)
    percent = F.transform(F.regexp_extract_all(text, F.lit(rf"\b{_AMOUNT}\s+%"), 1), lambda x: number(x) * 10)
    whole = rf"\b{_AMOUNT}\s+MG\s+{_AMOUNT}\s+ML\b"
    both = F.arrays_zip(F.regexp_extract_all(text, F.lit(whole), 1).alias("mg"), F.regexp_extract_all(text, F.lit(whole), 2).alias("ml"))
    strength = F.transform(F.filter(both, lambda p: number(p["ml"]) > 0), lambda p: number(p["mg"]) / number(p["ml"]))
    return F.array_sort(F.array_distinct(F.concat(plain, percent, strength)))


def features_compatible(a: Column, b: Column) -> Column:
    """1.0 if either side has no amounts or they share one, else 0.0."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0) | F.arrays_overlap(a, b), F.lit(1.0)).otherwise(F.lit(0.0))
