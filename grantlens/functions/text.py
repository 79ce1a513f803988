"""Institution-name cleaning and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Trailing words that do not tell institutions apart.
NAME_SUFFIXES = [
    "DISTRICT",
    "DISTRICTS",
    "INC",
    "LLC",
    "LLP",
    "FOUNDATION",
    "CORPORATION",
    "CORP",
    "COMPANY",
    "CO",
    "LIMITED",
    "LTD",
]
# Leading article, shape of a recipient id, sign for missing text.
LEADING_ARTICLE = r"(?i)^\s*THE\s+"
UEI_SHAPE = "^[A-Z0-9]{12}$"
NO_TEXT = "—"


def squeeze(value: Column) -> Column:
    """Runs of white space become one blank."""
    return F.regexp_replace(value, r"\s+", " ")


def title_case(value: Column) -> Column:
    """Capitalise after every character that is neither letter nor digit.

    Spark's initcap only starts words at white space, so the text is cut into
    word and non-word runs first.
    """
    runs = F.regexp_extract_all(value, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def display_name(name: Column) -> Column:
    return F.trim(squeeze(title_case(name)))


def canonical_name(name: Column, strict: bool = False) -> Column:
    """Grouping key of an institution: no leading article, no legal suffix.

    The suffix may by default start inside a word ('NEW MEXICO' loses its 'CO');
    strict=True only removes whole words.
    """
    edge = r"\b" if strict else ""
    suffix = rf"(?i)\s*[,.]?\s*{edge}(?:{'|'.join(NAME_SUFFIXES)})\.?\s*$"
    bare = F.regexp_replace(F.regexp_replace(name, LEADING_ARTICLE, ""), suffix, "")
    return F.upper(F.trim(squeeze(bare)))


def is_academic(name: Column, keywords: tuple[str, ...]) -> Column:
    """Name contains one of the keywords in any case; NULL names are not academic."""
    found = F.lit(False)
    for word in keywords:
        found = found | name.ilike(f"%{word}%")
    return F.coalesce(found, F.lit(False))


def institution_label(name: Column, state: Column, terminations: Column) -> Column:
    plain = F.format_string(f"%s {NO_TEXT} %s", name, state)
    return F.when(
        terminations > 0,
        F.format_string(f"%s {NO_TEXT} %s (%d terminated)", name, state, terminations),
    ).otherwise(plain)


def text_or_dash(value: Column) -> Column:
    return F.coalesce(value, F.lit(NO_TEXT))
