"""Readers.  All take explicit schemas; none samples data to infer one."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import quote, unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.project import MissingColumns, conform, missing
from ..schemas import COMPLAINT, TRIP, WEATHER, ZONE_LOOKUP_RAW

log = logging.getLogger(__name__)


class NoMonths(FileNotFoundError):
    """None of the months could be read; ``skipped`` tells why."""

    def __init__(self, skipped: dict[str, str]):
        super().__init__(f"none of the months could be read: {skipped}")
        self.skipped = skipped


MONTH_FILE = "yellow_tripdata_{year:04d}-{month:02d}.parquet"


def month_path(root: str, year: int, month: int, template: str = MONTH_FILE) -> str:
    return f"{root.rstrip('/')}/{template.format(year=year, month=month)}"


def read_month(
    spark: SparkSession,
    root: str,
    year: int,
    month: int,
    schema: T.StructType | None = None,
    template: str = MONTH_FILE,
) -> DataFrame:
    """One month's trips, at the given schema."""
    stored = spark.read.parquet(month_path(root, year, month, template))
    return conform(stored, schema or TRIP)


def read_months(
    spark: SparkSession,
    root: str,
    months: Iterable[tuple[int, int]],
    schema: T.StructType | None = None,
    required: Sequence[str] | None = None,
    on_error: str = "skip",
    ignore_corrupt: bool = False,
    template: str = MONTH_FILE,
    tag: str = "ym",
) -> tuple[DataFrame, dict[str, str]]:
    """Many months as one table with a ``yyyy-MM`` tag, and the skipped months.

    Column types drift between monthly files, so files are grouped by the
    schema in their footers: one scan per distinct schema, conformed and
    unioned, rather than one scan per file.  A month whose file cannot be read
    or lacks a ``required`` column is skipped with its reason, or raises with
    ``on_error="raise"``.  The tag is that of the month's path, a file or a
    folder, as the rows may lie outside the month their file is named after.

    A damaged file fails the job.  ``ignore_corrupt`` reads on past it; the
    rows each month then lacks are counted and returned among the reasons.
    """
    schema = schema or TRIP
    required = list(required if required is not None else schema.fieldNames())
    skipped: dict[str, str] = {}
    by_schema: dict[str, tuple[T.StructType, dict[str, tuple[str, str]]]] = {}
    for year, month in months:
        ym, path = f"{year:04d}-{month:02d}", month_path(root, year, month, template)
        try:
            stored = spark.read.parquet(path)
            lacking = missing(stored, required)
            if lacking:
                raise MissingColumns(f"missing columns: {lacking}")
        except (MissingColumns, PySparkException, Py4JJavaError) as e:
            if on_error != "skip":
                raise
            skipped[ym] = _reason(e)
            log.warning("month %s skipped: %s", ym, skipped[ym])
            continue
        by_schema.setdefault(stored.schema.json(), (stored.schema, {}))[1][path] = (ym, _location(stored, path))
    if not by_schema:
        raise NoMonths(skipped)

    optional = [f.name for f in schema if f.name not in required]
    parts = []
    for stored_schema, paths in by_schema.values():
        reader = spark.read.schema(stored_schema).option("ignoreCorruptFiles", str(ignore_corrupt).lower())
        scan = reader.parquet(*paths)
        if ignore_corrupt:
            skipped |= _short_months(spark, scan, stored_schema, paths)
        tagged = scan.withColumn(tag, _month_of_path(paths.values()))
        wanted = T.StructType([*schema.fields, T.StructField(tag, T.StringType())])
        parts.append(conform(tagged, wanted, optional))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out, skipped


def _location(stored: DataFrame, path: str) -> str:
    """Where Spark finds a path: its full address, up to the path's end."""
    plain = quote(re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", path).rstrip("/"), safe="/=:@!$&'()*+,;~")
    for file in stored.inputFiles():
        at = file.rfind(plain)
        if at >= 0 and file[at + len(plain) : at + len(plain) + 1] in ("", "/"):
            return file[: at + len(plain)]
    return plain


def _month_of_path(months: Iterable[tuple[str, str]]) -> Column:
    """The month whose path a row's file is, or is below; a file of no month fails the job."""
    months = list(months)
    if len(months) == 1:
        return F.lit(months[0][0])
    file = F.col("_metadata.file_path")
    out = None
    for ym, location in months:
        # a row's file address writes an empty authority as one slash or as three
        hit = F.lit(False)
        for address in {location, location.replace(":///", ":/", 1)}:
            hit = hit | (file == address) | F.startswith(file, F.lit(address + "/"))
        out = F.when(hit, ym) if out is None else out.when(hit, ym)
    return out.otherwise(F.raise_error(F.concat(F.lit("file of no month: "), file)).cast("string"))


def _short_months(
    spark: SparkSession, scan: DataFrame, schema: T.StructType, paths: dict[str, tuple[str, str]]
) -> dict[str, str]:
    """Months of which fewer rows can be read than the files' footers state; reads all columns once."""
    month = _month_of_path(paths.values())
    stated = spark.read.schema(schema).parquet(*paths).groupBy(month.alias("ym")).count()
    # the checksum has every column read; a bare count would ask the footers again
    check = F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in schema.fieldNames()])).alias("check")
    read = scan.select("*", month.alias("_ym")).groupBy("_ym").agg(F.count(F.lit(1)).alias("read"), check)
    both = stated.join(read, stated["ym"] == read["_ym"], "left")
    lost = both.where("coalesce(read, 0) < count").collect()  # at most one row for each month
    return {r["ym"]: f"only {r['read'] or 0} of {r['count']} rows could be read" for r in lost}


def _reason(e: Exception) -> str:
    if isinstance(e, Py4JJavaError):
        cause = e.java_exception
        while cause.getCause() is not None:
            cause = cause.getCause()
        return str(cause.getMessage()).splitlines()[0]
    return str(e).splitlines()[0]


def read_csv(spark: SparkSession, glob: str, schema: T.StructType = COMPLAINT, multiline: bool = False) -> DataFrame:
    """CSV files with a header line, whose columns are found by name in any order, file by file.

    A quote inside a quoted field is doubled.  ``multiline`` allows line breaks
    in quoted fields; a file can then not be split among tasks.  A field that
    does not parse is NULL, see ``malformed_fields``; a column the header lacks
    is NULL.  Files with the same header share one scan; a file without any
    line has no rows.
    """
    parts = []
    for text in _csv_texts(spark, glob, multiline):
        stored = {c.lower(): c for c in text.columns}
        parts.append(text.select(*[_parsed(stored, f).alias(f.name) for f in schema]))
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], schema)


def malformed_fields(spark: SparkSession, glob: str, schema: T.StructType = COMPLAINT, multiline: bool = False) -> DataFrame:
    """One row: how many fields of each column hold text that does not parse; columns that no header has are left out."""
    parts = []
    for text in _csv_texts(spark, glob, multiline):
        stored = {c.lower(): c for c in text.columns}
        lost = {f.name: F.count_if(F.col(f"`{stored[f.name.lower()]}`").isNotNull() & _parsed(stored, f).isNull())
                for f in schema if f.name.lower() in stored}
        parts.append(text.agg(F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in lost.items()]))
    if not parts:
        return spark.range(1).select(*[F.lit(0).cast("long").alias(f.name) for f in schema])
    counts = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return counts.agg(*[F.sum(c).alias(c) for c in counts.columns if c != "_rows"])


def _csv_texts(spark: SparkSession, glob: str, multiline: bool) -> list[DataFrame]:
    """The files as text, one scan for each distinct header; only header lines are read here."""

    def reader():
        options = {"header": True, "inferSchema": False, "mode": "PERMISSIVE", "quote": '"', "escape": '"', "multiLine": multiline}
        return spark.read.options(**options)

    files = spark.read.text(glob).inputFiles()
    if not files:
        return []
    with ThreadPoolExecutor(min(16, len(files))) as pool:
        headers = list(pool.map(lambda file: tuple(reader().csv(unquote(file)).columns), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers):
        if header:
            groups.setdefault(header, []).append(unquote(file))
    return [reader().csv(paths) for paths in groups.values()]


def _parsed(stored: dict[str, str], field: T.StructField) -> Column:
    name = stored.get(field.name.lower())
    if name is None:
        return F.lit(None).cast(field.dataType)
    return F.col(f"`{name}`").try_cast(field.dataType)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup: read as text, with the id cast to int (NULL if not a number)."""
    return read_csv(spark, path, ZONE_LOOKUP_RAW).withColumn("LocationID", F.col("LocationID").try_cast("int"))


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Hourly weather whose ``time`` is nanoseconds since the epoch.

    Parquet stores it either as a plain integer or as a nanosecond timestamp;
    Spark reads the latter as an integer only under the setting below, which
    is put back afterwards.
    """
    key = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        stored = spark.read.parquet(path)
        lacking = missing(stored, ["time"])
        if lacking:
            raise MissingColumns(f"missing columns: {lacking}")
        return conform(stored, WEATHER, optional=[f.name for f in WEATHER if f.name != "time"])
    finally:
        spark.conf.set(key, before)


def read_facts(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table written with year/month partition folders; filters on them prune folders."""
    df = spark.read.parquet(path)
    return conform(df, schema) if schema else df


def load_by_name(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.parquet") -> DataFrame:
    """Load files of a pattern into a fixed layout, matching columns by name without case."""
    df = spark.read.option("pathGlobFilter", pattern).option("mergeSchema", True).parquet(path)
    return conform(df, schema, optional=[f.name for f in schema])


def with_path_partitions(df: DataFrame, keys: Sequence[str] = ("year", "month"), source: str = "source_file") -> DataFrame:
    """Add the file each row came from and the ``key=`` numbers in its path.

    Such columns do not prune folders; filter on real partition columns where
    the table has them.
    """
    path = F.col("_metadata.file_path")
    cols = {k: F.regexp_extract(path, rf"{k}=([0-9]+)", 1).try_cast("int") for k in keys}
    return df.withColumns({**cols, source: path})


def file_index(spark: SparkSession, path: str, keys: Sequence[str] = ("year", "month"), pattern: str = "*.parquet") -> DataFrame:
    """(path, length, keys): files below a folder with the ``key=`` numbers of their paths; no file is opened."""
    numbers = [F.regexp_extract("path", rf"{k}=([0-9]+)", 1).try_cast("int").alias(k) for k in keys]
    return list_files(spark, path, pattern).select("path", "length", *numbers)


def read_by_path(
    spark: SparkSession,
    path: str,
    where: Column | str,
    keys: Sequence[str] = ("year", "month"),
    schema: T.StructType | None = None,
    pattern: str = "*.parquet",
    source: str = "source_file",
) -> DataFrame:
    """Rows of the files whose path numbers satisfy ``where``, with these numbers and the file as columns.

    The files are chosen from an index of paths before anything is scanned, so
    numbers in file names prune as well as partition folders do, and files that
    are not wanted are never opened.  Without a matching file the result is
    empty, with the columns of ``schema`` if given.
    """
    chosen = [unquote(r["path"]) for r in file_index(spark, path, keys, pattern).where(where).select("path").collect()]
    if not chosen:
        numbers = [T.StructField(k, T.IntegerType()) for k in keys]
        return spark.createDataFrame([], T.StructType([*(schema.fields if schema else []), *numbers, T.StructField(source, T.StringType())]))
    stored = with_path_partitions(spark.read.option("recursiveFileLookup", "true").parquet(*sorted(chosen)), keys, source)
    if schema is None:
        return stored
    names = {f.name for f in schema}
    wanted = conform(stored, T.StructType([*schema.fields, *(f for f in stored.schema if f.name in (*keys, source) and f.name not in names)]))
    return wanted


def file_inventory(df: DataFrame) -> DataFrame:
    """Files behind a table with their size and row count."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")
    ).agg(F.count(F.lit(1)).alias("rows"))


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below a folder with size and time; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )
