"""Text normalisation, keys and phrase patterns."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scale import col

# Unicode white space plus the ASCII separators 1C-1F.
BLANKS = r"(?U)[\s\x{1c}-\x{1f}]+"
# A tag, with `>` allowed inside quoted attribute values.
TAG = r"""(?s)<[A-Za-z/!?](?:[^>"']|"[^"]*"|'[^']*')*>"""
HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<template\b.*?</template\s*>|<!--.*?-->"


def collapse_blanks(text: Column | str) -> Column:
    """Every run of blanks becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(col(text), BLANKS, " "))


def normalise_text(text: Column | str) -> Column:
    """Lower case with collapsed blanks."""
    return collapse_blanks(F.lower(col(text)))


def clean_items(items: Column | str) -> Column:
    """Normalised items without blanks or repeats, in first-seen order; NULL gives an empty list."""
    cleaned = F.transform(col(items), normalise_text)
    kept = F.filter(cleaned, lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.array_distinct(kept), F.array().cast("array<string>"))


def split_clean(text: Column | str, separator: str = ",") -> Column:
    """A delimited string as a clean item list."""
    return clean_items(F.split(col(text), separator))


def split_joined(text: Column | str, separator: str = ";", unknown: str = "Unknown") -> Column:
    """Undo a `'; '` join; the unknown label gives an empty list."""
    parts = F.filter(F.transform(F.split(col(text), separator), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(col(text).isNull() | (col(text) == unknown), F.array().cast("array<string>")).otherwise(parts)


def join_items(items: Column | str, separator: str = "; ") -> Column:
    """A list as one string."""
    return F.array_join(col(items), separator)


def item_key(text: Column | str) -> Column:
    """Spelling-insensitive key: letters, digits, `+` and `#` only."""
    return F.regexp_replace(F.lower(col(text)), "[^a-z0-9+#]", "")


def clean_form(text: Column | str) -> Column:
    """Drop leading bullets and trailing punctuation, collapse blanks."""
    headless = F.regexp_replace(F.lower(col(text)), "^[^a-z0-9]+", "")
    return collapse_blanks(F.regexp_replace(headless, "[^a-z0-9+#]+$", ""))


def is_ascii(text: Column | str) -> Column:
    """True when every character is ASCII."""
    return ~col(text).rlike(r"[^\x00-\x7F]")


def parse_itemset(text: Column | str) -> Column:
    """`'b, a'` as a sorted list of distinct items."""
    parts = F.filter(F.transform(F.split(col(text), ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_sort(F.array_distinct(parts))


def form_pattern(forms: Column | str) -> Column:
    """A regex for any of the forms as whole phrases; words may be joined by blanks, hyphens or nothing."""
    words = lambda form: F.filter(F.split(form, r"[\s\-]+"), lambda w: w != "")
    escape = lambda word: F.regexp_replace(word, r"([^a-z0-9])", r"\\$1")
    phrase = lambda form: F.array_join(F.transform(words(form), escape), r"[\s\-]*")
    return F.concat(F.lit("(?<![a-z0-9])(?:"), F.array_join(F.transform(col(forms), phrase), "|"), F.lit(")(?![a-z0-9])"))


def blank_phrases(text: Column | str, pattern: str) -> Column:
    """Replace every match by one space."""
    return F.regexp_replace(col(text), pattern, " ")


@F.pandas_udf(T.StringType())
def _unescape(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def unescape_entities(text: Column | str) -> Column:
    """All named and numeric HTML entities, by the standard library's table."""
    return _unescape(col(text))


def html_to_text(markup: Column | str) -> Column:
    """Visible text of a page: tags separate words, entities are decoded last."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(col(markup), F.lit("")), HIDDEN, " "), TAG, " ")
    return collapse_blanks(unescape_entities(bare))


def normalised_description(text: Column | str) -> Column:
    """Equality key of a description: entities decoded first, then tags dropped."""
    decoded = unescape_entities(F.coalesce(col(text), F.lit("")))
    return normalise_text(F.regexp_replace(decoded, "<[^>]+>", " "))


def masked_template(text: Column | str) -> Column:
    """Links and numbers replaced by placeholders."""
    links = F.regexp_replace(col(text), r"(?U)https?://\S+", "<url>")
    return F.regexp_replace(links, r"(?U)\d+(?:[.,]\d+)*", "<num>")


def pair_key(first: Column | str, second: Column | str) -> Column:
    """`first|second` lower-cased and trimmed; blank when the first part is missing."""
    part = lambda c: F.lower(F.trim(F.coalesce(col(c), F.lit(""))))
    return F.when(col(first).isNull(), F.lit("")).otherwise(F.concat(part(first), F.lit("|"), part(second)))


def text_hash(text: Column | str) -> Column:
    """SHA-256 of the text; blank stays blank."""
    return F.when(F.coalesce(col(text), F.lit("")) == "", F.lit("")).otherwise(F.sha2(col(text), 256))


def values_hash(*values: Column | str) -> Column:
    """SHA-256 of the JSON list of the values; missing values are kept as null."""
    encoded = [F.to_json(F.array(col(v)), {"ignoreNullFields": "false"}) for v in values]
    listed = F.concat_ws(",", *[F.substring(e, F.lit(2), F.length(e) - 2) for e in encoded])
    return F.sha2(F.concat(F.lit("["), listed, F.lit("]")), 256)


def word_count(text: Column | str) -> Column:
    """Number of blank-separated words; 0 for blank text."""
    squeezed = collapse_blanks(F.coalesce(col(text), F.lit("")))
    return F.when(squeezed == "", F.lit(0)).otherwise(F.size(F.split(squeezed, " ")))


def contains_text(query: str, *fields: Column | str) -> Column:
    """Case-folded substring search over several fields."""
    haystack = F.lower(F.concat_ws(" ", *[F.coalesce(col(f), F.lit("")) for f in fields]))
    return haystack.contains(query.lower())


def scrub(text: Column | str, secrets: list[str]) -> Column:
    """Replace each secret by `***`."""
    out = col(text)
    for secret in filter(None, secrets):
        out = F.replace(out, F.lit(secret), F.lit("***"))
    return out
