"""Text cleaning, masking and labelling."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

NOT_REPORTED = "NO_INFORMADO"


def blank_to_null(text: Column) -> Column:
    """Trimmed text, or NULL when nothing but blanks is left."""
    return F.nullif(F.trim(text), F.lit(""))


def is_blank(text: Column) -> Column:
    return blank_to_null(text).isNull()


def or_default(value: Column, default=NOT_REPORTED) -> Column:
    return F.coalesce(value, F.lit(default))


def normalised(text: Column) -> Column:
    return F.upper(F.trim(text))


def folded(text: Column) -> Column:
    """Comparison form: case and trailing blanks do not count."""
    return F.upper(F.rtrim(text))


def matches(text: Column, *values: str) -> Column:
    """Never-NULL membership test on the comparison form."""
    return F.coalesce(folded(text).isin(*values), F.lit(False))


def contains_any(text: Column, *words: str) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.contains(F.upper(text), F.lit(word))
    return F.coalesce(found, F.lit(False))


def mask_name(name: Column) -> Column:
    """First letter and three stars; an absent name gives the stars alone."""
    return F.concat(F.coalesce(F.left(F.trim(name), F.lit(1)), F.lit("")), F.lit("***"))


def mask_document(document: Column, visible: int = 4) -> Column:
    """Star everything but the last characters; short documents are starred whole.

    Trailing blanks do not count towards the length.
    """
    hidden = F.length(F.rtrim(document)) - visible
    starred = F.concat(F.repeat(F.lit("*"), hidden), F.right(document, F.lit(visible)))
    return F.when(hidden <= 0, F.lit("*" * visible)).otherwise(F.coalesce(starred, F.lit("")))


def relabel(code: Column, labels: Mapping[str, str], default: str = NOT_REPORTED) -> Column:
    """Readable label of a code; unknown codes pass through, NULL takes the default."""
    chosen = None
    for known, label in labels.items():
        hit = folded(code) == known
        chosen = F.when(hit, label) if chosen is None else chosen.when(hit, label)
    fallback = or_default(code, default)
    return fallback if chosen is None else chosen.otherwise(fallback)


def flag(condition: Column) -> Column:
    """0/1 integer; NULL conditions count as 0."""
    return F.when(condition, 1).otherwise(0)
