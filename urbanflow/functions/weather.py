"""Weather-code expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import EXTREME_CODES, EXTREME_GUST
from .text import _col


def code_in(code: Column | str, table: Mapping[int, str]) -> Column:
    """The code itself where the table lists it, else 0."""
    code = _col(code)
    return F.when(code.isin(*table), code.cast("int")).otherwise(F.lit(0))


def code_text(code: Column | str, table: Mapping[int, str], default: str) -> Column:
    """The table's text for the code, else ``default``."""
    code, text = _col(code), F
    for value, name in table.items():
        text = text.when(code == value, F.lit(name))
    return text.otherwise(F.lit(default))


def is_extreme(
    code: Column | str,
    gust: Column | str,
    codes: Sequence[int] = EXTREME_CODES,
    max_gust: float = EXTREME_GUST,
) -> Column:
    """1 for a listed code or a gust above the limit; unknown counts as 0."""
    return F.when(_col(code).isin(*codes) | (_col(gust) > max_gust), 1).otherwise(0)
