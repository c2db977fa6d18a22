"""One layout for Parquet files whose column types have drifted apart.

Footers are read in tasks, no row is.  The types of a column are folded up a
lattice: whole numbers widen to the widest, decimals to one that holds all
digits, mixed numbers to double, dates to zoneless timestamps, and what has
nothing else in common becomes text.  Files of equal layout share one scan.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The footer reader travels to the tasks, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}  # digits before the point that a decimal then needs
REAL = ("float", "double")
NESTED = re.compile(r"(struct|array|map)<")
DECIMAL = re.compile(r"decimal\((\d+),\s*(\d+)\)$")
FOOTER = "path string, names array<string>, types array<string>, error string"


def widen(a: str, b: str) -> str:
    """The least type that holds the values of both; ``void`` is below every type, ``string`` above."""
    if a == b or b == "void":
        return a
    if a == "void":
        return b
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.get)
    parts = [_digits(t) for t in (a, b)]
    if all(parts):
        before, after = (max(p[i] for p in parts) for i in (0, 1))
        return f"decimal({before + after},{after})" if before + after <= 38 else "double"
    if all(p or t in REAL for p, t in zip(parts, (a, b))):
        return "double"
    if {a, b} == {"date", "timestamp_ntz"}:
        return "timestamp_ntz"
    return "string"


def _digits(t: str) -> tuple[int, int] | None:
    """Digits before and after the point of a whole number or decimal."""
    if t in WHOLE:
        return WHOLE[t], 0
    found = DECIMAL.match(t)
    return (int(found[1]) - int(found[2]), int(found[2])) if found else None


def readable(stored: str, wanted: str) -> bool:
    """Whether Spark's Parquet reader itself turns one type into the other."""
    if stored == wanted:
        return True
    if stored in ("tinyint", "smallint", "int"):
        have = _digits(wanted)
        return wanted in ("smallint", "int", "bigint", "double") or bool(have and have[0] >= WHOLE["int"])
    have, want = _digits(stored), _digits(wanted)
    if DECIMAL.match(stored) and want and have:
        return want[0] >= have[0] and want[1] >= have[1] and wanted not in WHOLE
    return (stored, wanted) in {("float", "double"), ("date", "timestamp_ntz")} or (stored == "bigint" and bool(want) and want[0] >= 20)


def arrow_type(t: pa.DataType, int96: bool = False) -> str:
    """The Spark type of a stored column; raises for one that Spark cannot read."""
    plain = {
        pa.int8(): "tinyint", pa.int16(): "smallint", pa.int32(): "int", pa.int64(): "bigint", pa.uint8(): "smallint",
        pa.uint16(): "int", pa.uint32(): "bigint", pa.uint64(): "decimal(20,0)", pa.float32(): "float",
        pa.float64(): "double", pa.bool_(): "boolean", pa.string(): "string", pa.large_string(): "string",
        pa.binary(): "binary", pa.large_binary(): "binary", pa.date32(): "date", pa.null(): "void",
    }
    if t in plain:
        return plain[t]
    if pa.types.is_dictionary(t):
        return arrow_type(t.value_type)
    if pa.types.is_decimal(t):
        return f"decimal({t.precision},{t.scale})"
    if pa.types.is_timestamp(t):
        if t.unit == "ns" and not int96:
            raise ValueError("nanosecond timestamps are read by read_weather")
        return "timestamp" if int96 or t.tz else "timestamp_ntz"
    if pa.types.is_struct(t):
        return f"struct<{','.join(f'`{f.name}`:{arrow_type(f.type)}' for f in t)}>"
    if pa.types.is_map(t):
        return f"map<{arrow_type(t.key_type)},{arrow_type(t.item_type)}>"
    if pa.types.is_list(t) or pa.types.is_large_list(t) or pa.types.is_fixed_size_list(t):
        return f"array<{arrow_type(t.value_type)}>"
    if pa.types.is_fixed_size_binary(t):
        return "binary"
    raise ValueError(f"type {t} has no Spark counterpart")


def read_footer(path: str) -> tuple[list[str], list[str]]:
    """Names and types of a file's columns, from its footer."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    with store.open_input_file(inner) as f:
        file = pq.ParquetFile(f)
        physical = {c.path: c.physical_type for c in map(file.schema.column, range(len(file.schema)))}
        schema = file.schema_arrow
        return list(schema.names), [arrow_type(c.type, physical.get(c.name) == "INT96") for c in schema]


def _footers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from urllib.parse import unquote

    for batch in batches:
        rows = []
        for path in batch.column(0).to_pylist():
            try:
                rows.append((path, *read_footer(unquote(path)), None))
            except (OSError, ValueError, pa.ArrowException) as e:
                rows.append((path, None, None, f"{type(e).__name__}: {e}"))
        names = pa.list_(pa.string())
        kinds = (pa.string(), names, names, pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["path", "names", "types", "error"])


def footers(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, names, types, error) of every Parquet file below a folder, or of one file.

    A store that only Spark knows leaves an ``error`` here; ``infer`` then asks
    Spark for those files' layouts.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    files = reader.load(path).where("length > 0").select("path")
    each = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return files.repartition(each).mapInArrow(_footers, FOOTER)


@dataclass(frozen=True)
class Inferred:
    """The folded layout, each distinct stored layout with its files, and the columns that drifted."""

    path: str
    schema: T.StructType
    scans: list[tuple[T.StructType, list[str]]]
    conflicts: list[tuple[str, str, int, str, str]]

    def conflict_rows(self, spark: SparkSession) -> DataFrame:
        """One row for each stored type of a drifted column: files that have it, the first of them, the folded type."""
        return spark.createDataFrame(self.conflicts, "column_name string, stored string, files long, first_file string, becomes string")


def infer(spark: SparkSession, path: str, pattern: str = "*.parquet") -> Inferred:
    """The layout of all Parquet files below ``path``, without reading a row.

    Columns are matched without case and stand in the order of their first
    appearance by path.  What reaches the driver is the distinct layouts and
    the files of each, which a scan names anyway.
    """
    found = footers(spark, path, pattern).cache()
    try:
        layouts = []
        for r in found.where("error is null").groupBy("names", "types").agg(F.sort_array(F.collect_list("path")).alias("files")).collect():
            layouts.append((list(zip(r["names"], r["types"])), list(r["files"])))
        for r in found.where("error is not null").collect():  # files in a store that only Spark opens, or damaged ones
            stored = spark.read.parquet(_plain(r["path"])).schema
            layouts.append(([(f.name, f.dataType.simpleString()) for f in stored], [r["path"]]))
    finally:
        found.unpersist()
    if not layouts:
        raise FileNotFoundError(f"no Parquet files below {path}")
    layouts.sort(key=lambda x: x[1][0])

    types: dict[str, dict[str, list]] = {}
    names: dict[str, str] = {}
    for columns, files in layouts:
        for name, kind in columns:
            names.setdefault(name.lower(), name)
            seen = types.setdefault(name.lower(), {}).setdefault(kind, [0, files[0]])
            seen[0], seen[1] = seen[0] + len(files), min(seen[1], files[0])
    folded = {c: reduce(widen, kinds) for c, kinds in types.items()}
    conflicts = [
        (names[c], kind, n, first, folded[c]) for c, kinds in types.items() if len(kinds) > 1 for kind, (n, first) in sorted(kinds.items())
    ]
    groups: dict[tuple, list[str]] = {}
    for columns, files in layouts:
        groups.setdefault(tuple(sorted((n.lower(), k) for n, k in columns)), []).extend(files)
    scans = [(_struct(columns, names), sorted(files)) for columns, files in groups.items()]
    return Inferred(path, _struct(folded.items(), names), scans, conflicts)


def _struct(columns: Iterable[tuple[str, str]], names: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(names[c], T.DataType.fromDDL(k)) for c, k in columns])


def _plain(path: str) -> str:
    from urllib.parse import unquote

    return unquote(path)


def _cast(name: str, stored: T.DataType, wanted: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if wanted == T.StringType() and NESTED.match(stored.simpleString()):
        return F.to_json(c)
    return c.cast(wanted)


def read_drifting(spark: SparkSession, found: Inferred, source: str | None = None) -> DataFrame:
    """All files as one table of the folded layout; one scan for each distinct stored layout.

    A column that a file lacks is NULL.  Folders ``key=value`` become columns
    as usual.  ``source`` names a column with each row's file.
    """
    parts = []
    root = None if found.path.endswith(".parquet") else found.path
    for schema, files in found.scans:
        reader = spark.read.schema(schema)
        scan = (reader.option("basePath", root) if root else reader).parquet(*map(_plain, files))
        stored = {f.name.lower(): f for f in schema}
        folders = [c for c in scan.columns if c.lower() not in stored]
        columns = [
            (_cast(stored[f.name.lower()].name, stored[f.name.lower()].dataType, f.dataType) if f.name.lower() in stored else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in found.schema
            if f.name not in folders
        ]
        extra = [F.col("_metadata.file_path").alias(source)] if source else []
        parts.append(([(c, scan.schema[c].dataType.simpleString()) for c in folders], scan.select(*columns, *[F.col(f"`{c}`") for c in folders], *extra)))
    folders: dict[str, str] = {}
    for own, _ in parts:
        for c, kind in own:
            folders[c] = widen(folders.get(c, "void"), kind)
    aligned = [df.withColumns({c: F.col(f"`{c}`").cast(folders[c]) for c, _ in own}) for own, df in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def register_drifting(spark: SparkSession, name: str, path: str, pattern: str = "*.parquet") -> Inferred:
    """A table over files that stay where they are, of the folded layout.

    Where Spark's reader widens every stored type by itself, this is an
    external table of the catalog, which sees files added later; else a session
    view that unites the scans, to be registered again after files are added.
    """
    found = infer(spark, path, pattern)
    wide = {f.name.lower(): f.dataType.simpleString() for f in found.schema}
    direct = all(readable(f.dataType.simpleString(), wide[f.name.lower()]) for schema, _ in found.scans for f in schema)
    spark.catalog.dropTempView(name.split(".")[-1])
    if not direct or path.endswith(".parquet") or pattern != "*.parquet":
        read_drifting(spark, found).createOrReplaceTempView(name)
        return found
    first_of_each = [files[0] for _, files in found.scans]
    folders = [f for f in spark.read.schema(found.schema).option("basePath", path).parquet(*map(_plain, first_of_each)).schema if f.name.lower() not in wide]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*found.schema, *folders])
    by = f" PARTITIONED BY ({', '.join(f'`{f.name}`' for f in folders)})" if folders else ""
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: its files stay
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{by} LOCATION '{location}'")
    if folders:
        spark.catalog.recoverPartitions(name)
    return found
