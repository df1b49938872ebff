"""Text expressions.  All stay in the JVM but the two full-Unicode foldings."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import vocabulary as voc


def _latin_folds() -> tuple[str, str]:
    """Accented Latin letters that fold to one letter, and these letters."""
    pairs = []
    for code in [*range(0x80, 0x250), *range(0x1E00, 0x1F00)]:
        folded = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(folded) == 1 and folded != chr(code):
            pairs.append((chr(code), folded))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_FROM, _TO = _latin_folds()
NBSP, BOM = " ", "﻿"
#: White space as Python sees it, for regular expressions that match Unicode classes.
_SPACES = r"(?U)[\s\x1c-\x1f]"
_STRIP = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_ZERO_WIDTH = "[​-‏‪-‮﻿]"
# Fixed value: what counts as a price at the end of a description.
_PRICE = r"[\s \-–—:]*\$?\s*\d{1,3}(?:[.,]\d{3})*(?:[.,]\d+)?\s*$"


def text_or_empty(c: Column | str) -> Column:
    """A missing text is empty."""
    return F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit(""))


def remove_accents(c: Column) -> Column:
    """Latin letters without accents, combining marks dropped; a null is empty."""
    return F.regexp_replace(F.translate(text_or_empty(c), _FROM, _TO), r"\p{M}", "")


@F.pandas_udf(StringType())
def remove_accents_full(s: pd.Series) -> pd.Series:
    """As remove_accents for every script (compatibility decomposition)."""
    return s.fillna("").map(lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)))


@F.pandas_udf(StringType())
def robust_fold(s: pd.Series) -> pd.Series:
    """Compatibility composition (NFKC), single spaces, no white space at the ends, case-folded; a null stays null."""
    return s.map(lambda t: " ".join(unicodedata.normalize("NFKC", t).split()).casefold() if isinstance(t, str) else None)


@F.pandas_udf(StringType())
def casefold(s: pd.Series) -> pd.Series:
    """Case-folded; a null stays null."""
    return s.map(lambda t: t.casefold() if isinstance(t, str) else None)


def collapse_spaces(c: Column) -> Column:
    return F.regexp_replace(c, rf"{_SPACES}+", " ")


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(c, _STRIP, "")


def normalize_description(c: Column) -> Column:
    """Upper case without accents; of other characters only + . % stay; single spaces."""
    kept = F.regexp_replace(remove_accents(F.upper(text_or_empty(c))), r"[^A-Z0-9+.%\s]", " ")
    return F.trim(F.regexp_replace(kept, r"\s+", " "))


def _join_units(c: Column, units: list[str]) -> Column:
    return F.regexp_replace(c, rf"(\d)\s+({'|'.join(units)})\b", "$1$2")


def catalog_key(c: Column) -> Column:
    """Catalog spelling of a product: forms expanded word by word, units joined to numbers."""
    plain = F.upper(remove_accents(c))
    out = plain
    for short, full in voc.CATALOG_FORMS.items():
        out = F.regexp_replace(out, rf"\b{short}\b", full)
    # one pattern spares texts without any form the twelve replacements
    out = F.when(plain.rlike(rf"\b(?:{'|'.join(voc.CATALOG_FORMS)})\b"), out).otherwise(plain)
    return strip(collapse_spaces(_join_units(out, voc.CATALOG_UNITS)))


def standard_text_key(description: Column) -> Column:
    """Cross-reference key of a text, or the review mark if text or unit is missing."""
    clean = F.regexp_replace(F.upper(remove_accents(description)), r"[^A-Z0-9\s.%]", " ")
    clean = F.trim(F.regexp_replace(_join_units(clean, voc.STANDARD_UNITS), r"\s+", " "))
    has_unit = clean.rlike(rf"(?:^|[\s\d])(?:{'|'.join(voc.STANDARD_UNITS)})\b")
    missing = (text_or_empty(description) == "") | (clean == "") | ~has_unit
    return F.when(missing, F.lit(voc.TO_REVIEW)).otherwise(clean)


def key_or_review(key: Column, quantity: Column) -> Column:
    """The key, or the review mark without a quantity."""
    return F.when(quantity.isNull() | (quantity == 0), F.lit(voc.TO_REVIEW)).otherwise(key)


def standard_key(description: Column, quantity: Column) -> Column:
    """Cross-reference key, or the review mark if quantity, text or unit is missing."""
    return key_or_review(standard_text_key(description), quantity)


def _keyword_lab(text: Column) -> Column:
    upper = F.upper(text)
    return F.coalesce(*[F.when(upper.contains(k), F.lit(v)) for k, v in voc.LAB_KEYWORDS.items()], F.lit(voc.NO_LAB))


def _second_part(text: Column) -> Column:
    return F.upper(strip(F.split_part(text, F.lit("|"), F.lit(2))))


def extract_lab(c: Column) -> Column:
    """The part after the first pipe, else the first known name in the text."""
    text = text_or_empty(c)
    part = _second_part(text)
    return F.when(part != "", part).otherwise(_keyword_lab(text))


def extract_lab_canonical(c: Column) -> Column:
    """As extract_lab, with a known name between pipes in its standard spelling."""
    text = text_or_empty(c)
    part = _second_part(text)
    table = F.create_map(*[F.lit(x) for pair in voc.LAB_KEYWORDS.items() for x in pair])
    known = F.coalesce(F.try_element_at(table, part), part)
    return F.when(part != "", known).otherwise(_keyword_lab(text))


def before_pipe(c: Column) -> Column:
    return F.split_part(text_or_empty(c), F.lit("|"), F.lit(1))


def remove_numbers(c: Column) -> Column:
    return F.regexp_replace(c, r"\d+", "")


def strip_labs(c: Column) -> Column:
    """Without laboratory names as whole words."""
    names = "|".join(sorted(voc.LAB_NOISE, key=lambda n: (-len(n), n)))
    return F.regexp_replace(c, rf"(?i)\b({names})\b", "")


def clean_text(c: Column) -> Column:
    """Deep cleaning: first pipe part, no laboratories or accents, numbers apart from words, abbreviations expanded."""
    out = remove_accents(strip_labs(F.split_part(F.upper(text_or_empty(c)), F.lit("|"), F.lit(1))))
    out = F.translate(out, ",", ".")
    out = F.regexp_replace(out, r"(\d)\s*([A-Z%]+)", "$1 $2")
    out = F.regexp_replace(out, r"([A-Z%]+)\s*(\d)", "$1 $2")
    words = F.split(F.regexp_replace(out, r"[^A-Z0-9\s.%]", " "), r"\s+")
    table = F.create_map(*[F.lit(x) for pair in voc.ABBREVIATIONS.items() for x in pair])
    expanded = F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), w))
    return F.array_join(F.filter(expanded, lambda w: w != ""), " ")


def remove_zero_width(c: Column) -> Column:
    return F.regexp_replace(c, _ZERO_WIDTH, "")


def _plain(c: Column) -> Column:
    return F.translate(text_or_empty(c), NBSP + BOM, " ")


def strip_trailing_price(c: Column) -> Column:
    """Without a price-like number at the end, unless the text is nothing else."""
    text = _plain(c)
    cut = F.regexp_replace(F.regexp_replace(text, _PRICE, ""), r"(?U)[\s\x1c-\x1f]+$", "")
    return F.when(text.rlike(rf"^(?:{_PRICE})"), text).otherwise(F.when(text.rlike(_PRICE), cut).otherwise(text))


def key_trim(c: Column) -> Column:
    return strip(_plain(c))


def _ascii(c: Column) -> Column:
    return ~c.rlike(r"[^\x00-\x7F]")


def key_casefold(c: Column) -> Column:
    """Trimmed and case-folded.  ASCII texts, for which this is lower case, stay in the JVM."""
    plain = key_trim(c)
    return F.when(_ascii(plain), F.lower(plain)).otherwise(casefold(F.when(~_ascii(plain), plain)))


def visible(c: Column) -> Column:
    """Without invisible characters."""
    return remove_zero_width(_plain(c))


def visible_robust(plain: Column) -> Column:
    """key_robust() of a text without invisible characters."""
    native = F.lower(strip(collapse_spaces(plain)))
    return F.when(_ascii(plain), native).otherwise(robust_fold(F.when(~_ascii(plain), plain)))


def key_robust(c: Column) -> Column:
    """Folded key that ignores invisible characters, width and runs of white space.  ASCII texts stay in the JVM."""
    return visible_robust(visible(c))
