"""Least squares in SQL for any number of drivers: centred normal equations, eliminated driver by driver."""

from __future__ import annotations

from collections.abc import Sequence


def least_squares_sql(source: str, y: str, xs: Sequence[str], keys: Sequence[str], name: str, live: str | None = None) -> str:
    """Common table expressions that end in ``name`` (keys, n, my, mx, coef, inverse, sse, syy).

    mx and coef are lists in the order of ``xs``, and inverse is the diagonal
    of the inverse of the centred products.  The intercept is
    ``my - list_inner_product(coef, mx)``.  ``live`` is a column of the source,
    one number for each key: only so many of the first drivers take part, and
    the others have coefficient 0.  ``{name}_p`` holds the state after the
    first p drivers, whose squared error is ``sse_after(name, p)``.
    """
    k, by = len(xs), ", ".join(keys)
    known = " AND ".join(f"{c} IS NOT NULL" for c in (y, *xs))
    centred = [f"({c} - m{i})" for i, c in enumerate((*xs, y))]
    rows = []
    for i in range(k):
        unit = ", ".join(f"CAST({int(i == j)} AS DOUBLE)" for j in range(k))
        sums = [f"SUM({centred[i]} * {c})" for c in centred]
        if live:
            sums = [
                f"CASE WHEN ANY_VALUE({live}) > {max(i, j if j < k else 0)} THEN {c} ELSE {int(i == j)} END" for j, c in enumerate(sums)
            ]
        rows.append("[" + ", ".join(sums) + f", {unit}]")
    means = ", ".join(f"AVG({c}) AS m{i}" for i, c in enumerate((*xs, y)))
    mx = ", ".join(f"ANY_VALUE(m{i})" for i in range(k))
    sxy = [f"SUM({c} * {centred[k]})" for c in centred[:k]]
    if live:
        sxy = [f"CASE WHEN ANY_VALUE({live}) > {i} THEN {c} ELSE 0 END" for i, c in enumerate(sxy)]
    out = f"""
{name}_rows AS (SELECT {by}{f", {live}" if live else ""}, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in dict.fromkeys((y, *xs)))} FROM {source} WHERE {known}),
{name}_means AS (SELECT {by}, {means} FROM {name}_rows GROUP BY {by}),
{name}_0 AS (
  SELECT {by}, COUNT(*) AS n, ANY_VALUE(m{k}) AS my, [{mx}] AS mx, SUM({centred[k]} * {centred[k]}) AS syy,
         [{", ".join(sxy)}] AS sxy,
         [{", ".join(rows)}] AS m
  FROM {name}_rows JOIN {name}_means USING ({by}) GROUP BY {by}),"""
    for p in range(1, k + 1):
        out += f"""
{name}_{p} AS (
  SELECT * EXCLUDE (m, lead_row), list_transform(m, lambda r, i: CASE WHEN i = {p} THEN lead_row
    ELSE list_transform(r, lambda v, j: v - r[{p}] * lead_row[j]) END) AS m
  FROM (SELECT *, list_transform(m[{p}], lambda v: v / m[{p}][{p}]) AS lead_row FROM {name}_{p - 1})),"""
    return f"""{out}
{name} AS (
  SELECT {by}, n, my, mx, syy, syy - list_inner_product(list_transform(m, lambda r: r[{k + 1}]), sxy) AS sse,
         list_transform(m, lambda r: r[{k + 1}]) AS coef, list_transform(m, lambda r, i: r[{k + 1} + i]) AS inverse
  FROM {name}_{k})"""


def sse_after(p: int, k: int) -> str:
    """Squared error after the first p of k drivers, in a row of ``{name}_p``."""
    return f"syy - list_inner_product(list_transform(m[1:{p}], lambda r: r[{k + 1}]), sxy[1:{p}])"


def linear_sql(fit: str, xs: Sequence[str]) -> str:
    """The fitted value of a row that is joined to ``fit``."""
    terms = " + ".join(f"{fit}.coef[{i + 1}] * {x}" for i, x in enumerate(xs))
    return f"{fit}.my - list_inner_product({fit}.coef, {fit}.mx) + {terms}"
