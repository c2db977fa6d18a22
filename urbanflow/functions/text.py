"""Label, keyword and path expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def label(c: Column | str) -> Column:
    """Canonical label: no outer spaces, upper case."""
    return F.upper(F.trim(_col(c)))


def unquote(c: Column | str) -> Column:
    """Text without embedded double quotes and outer spaces; NULL stays NULL."""
    return F.trim(F.replace(_col(c).cast("string"), F.lit('"'), F.lit("")))


def mentions(c: Column | str, words: Iterable[str]) -> Column:
    """True where the text holds one of the words, in any case; NULL text holds none, and without words none does."""
    words = list(words)
    if not words:
        return F.lit(False)
    pattern = "(?i)" + "|".join(re.escape(w) for w in words)
    return F.coalesce(_col(c), F.lit("")).rlike(pattern)


def mentions_upper(c: Column | str, words: Iterable[str]) -> Column:
    """``mentions`` by upper-casing the text once and testing plain substrings."""
    text = F.upper(F.coalesce(_col(c), F.lit("")))
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(text, F.lit(word.upper()))
    return hit


def path_number(path: Column | str, key: str) -> Column:
    """Integer behind ``key=`` in a file path, NULL where there is none."""
    return F.regexp_extract(_col(path), rf"{re.escape(key)}=([0-9]+)", 1).try_cast("int")


def get_path(c: Column | str, path: str) -> Column:
    """Value at a JSON path of an object held as JSON text."""
    return F.get_json_object(_col(c), path)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
