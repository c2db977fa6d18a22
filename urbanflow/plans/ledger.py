"""What a backfill has done: for each month its input files, its output files and its rows.

A commit is appended after the month's files are in place.  A run that ends in
between leaves no commit, or one whose output files differ from what is there,
so the month is done again.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import MONTH_FILE, list_files, month_path

LEDGER = (
    "run bigint, ym string, inputs array<struct<path: string, size: bigint, changed: timestamp>>, "
    "outputs array<struct<path: string, size: bigint>>, rows bigint"
)
Files = dict[str, list[tuple]]


def _address(path: str) -> str:
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", unquote(path)).rstrip("/")


def _listed(spark: SparkSession, folder: str) -> list[tuple]:
    try:
        rows = list_files(spark, folder).collect()  # names and sizes of files, as a scan's plan holds them
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((_address(r["path"]), r["length"], r["modificationTime"]) for r in rows)


def input_files(spark: SparkSession, root: str, months: Iterable[tuple[int, int]], template: str = MONTH_FILE) -> Files:
    """(path, size, time of change) of each month's files; a month is a file or a folder."""
    found = _listed(spark, root)
    out: Files = {}
    for y, m in months:
        at = _address(month_path(root, y, m, template))
        out[f"{y:04d}-{m:02d}"] = [f for f in found if f[0].endswith(at) or at + "/" in f[0]]
    return out


def output_files(spark: SparkSession, table: str) -> Files:
    """(path below the table, size) of each month's files."""
    out: Files = {}
    for path, size, _ in _listed(spark, table):
        found = re.search(r"/year=(\d+)/month=(\d+)/[^/]+$", path)
        if found:
            out.setdefault(f"{int(found[1]):04d}-{int(found[2]):02d}", []).append((found[0], size))
    return {ym: sorted(files) for ym, files in out.items()}


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The last commit of each month."""
    try:
        rows = spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], LEDGER)
    last = rows.groupBy("ym").agg(F.max_by(F.struct("*"), "run").alias("r"))
    return last.select("r.*")


def unchanged_months(spark: SparkSession, ledger: str, inputs: Mapping[str, Sequence], outputs: Mapping[str, Sequence]) -> list[str]:
    """Months committed with just these input and output files."""
    done = []
    for r in read_ledger(spark, ledger).where(F.col("ym").isin(list(inputs))).collect():
        before = [(f["path"], f["size"], f["changed"]) for f in r["inputs"]]
        after = [(f["path"], f["size"]) for f in r["outputs"]]
        if before and before == list(inputs[r["ym"]]) and after == list(outputs.get(r["ym"], [])):
            done.append(r["ym"])
    return sorted(done)


def commit_months(
    spark: SparkSession, ledger: str, inputs: Mapping[str, Sequence], outputs: Mapping[str, Sequence], rows: Mapping[str, int]
) -> None:
    """Append one commit for each month of ``rows``, in one file."""
    last = read_ledger(spark, ledger).agg(F.max("run")).first()[0] or 0
    done = [(last + 1, ym, list(inputs[ym]), list(outputs.get(ym, [])), n) for ym, n in sorted(rows.items())]
    if done:
        spark.createDataFrame(done, LEDGER).coalesce(1).write.mode("append").parquet(ledger)
