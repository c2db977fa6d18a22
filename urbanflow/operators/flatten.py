"""Turn an object column into ordinary columns.

The object is JSON text or a VARIANT.  Its keys become the schema of the
result, so the key list, and only it, comes to the driver.  Keys are taken
literally: dots, quotes and brackets in them mean nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a variant's schema calls types that a column can have; other values stay JSON text.
ATOMIC = r"(BIGINT|DOUBLE|FLOAT|BOOLEAN|STRING|DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|DECIMAL\(\d+,\d+\))"
AS_MAP = "map<string,variant>"


def object_keys(df: DataFrame, col: str) -> DataFrame:
    """Distinct top-level keys, one per row; repeats are removed in the map tasks."""
    if _is_variant(df, col):
        return _entries(df, F.col(col)).select("key").distinct()
    return df.select(F.explode(F.json_object_keys(F.col(col))).alias("key")).distinct()


def key_types(df: DataFrame, col: str) -> DataFrame:
    """(key, type) of the top-level keys: the least type that holds all values of a key.

    Numbers are bigint, decimal or double; a key with values of several kinds,
    with objects, or with nothing but null is string.  Types are combined in
    the map tasks, so a key sends one type from each.  Text that is no JSON
    has no keys.
    """
    types = _entries(df, _as_variant(df, col)).groupBy("key").agg(F.schema_of_variant_agg("value").alias("type"))
    known = F.col("type").rlike(f"^({ATOMIC}|ARRAY<{ATOMIC}>)$")
    return types.withColumn("type", F.lower(F.when(known, F.col("type")).otherwise("string")))


def _entries(df: DataFrame, variant: Column) -> DataFrame:
    """(key, value) of the objects; other values have none."""
    rows = df.select(variant.alias("_object"))
    return rows.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_object").outer())).select("key", "value").where("key is not null")


def name_keys(keys: DataFrame, prefix: str = "v_") -> DataFrame:
    """Column name of each key: lower case; keys equal but for case are numbered from 2 on.

    A number that would give the name of another key is passed over.
    """
    w = Window.partitionBy("key_norm").orderBy("key")
    numbered = keys.withColumn("key_norm", F.lower("key")).withColumn("rn", F.row_number().over(w))
    # all names at hand, as keys are the schema: a second read of the keys would read the rows again
    numbered = numbered.withColumn("_all", F.collect_set("key_norm").over(Window.partitionBy(F.lit(0))))
    taken = F.filter("_all", lambda k: F.startswith(k, F.concat("key_norm", F.lit("_"))))
    free = F.expr("filter(sequence(2, rn + size(_taken)), n -> not array_contains(_taken, concat(key_norm, '_', n)))")
    named = numbered.withColumn("_taken", F.when(F.col("rn") > 1, taken))
    suffix = F.when(F.col("rn") > 1, F.concat(F.lit("_"), F.try_element_at(free, F.col("rn") - 1).cast("string"))).otherwise("")
    return named.withColumn("column_name", F.concat(F.lit(prefix), F.col("key_norm"), suffix)).select(
        *keys.columns, "key_norm", "rn", "column_name"
    )


def discover_keys(df: DataFrame, col: str, prefix: str = "v_", where: Column | None = None, typed: bool = False) -> DataFrame:
    """Keys and their column names, from all rows or from those of ``where``; with ``typed`` also their types."""
    rows = df.filter(where) if where is not None else df
    return name_keys(key_types(rows, col) if typed else object_keys(rows, col), prefix)


def variant_path(key: str) -> str | None:
    """The path of a key; a key with both kinds of quotes has none."""
    if '"' not in key:
        return f'$["{key}"]'
    return f"$['{key}']" if "'" not in key else None


def projection_text(named: DataFrame, col: str = "value", out: str = "projection") -> DataFrame:
    """The select list that flattens the object, as one line of SQL per key.

    ``col`` is the SQL of a VARIANT, such as ``try_parse_json(value)``.  Types
    are those of ``named``, else string.  It lists keys, not rows;
    ``discover_keys`` has reduced them to the schema.
    """
    kind = F.col("type") if "type" in named.columns else F.lit("string")
    key, lit = F.col("key"), F.lit

    def quoted(c: Column) -> Column:
        escaped = F.replace(F.replace(c, lit("\\"), lit("\\\\")), lit("'"), lit("\\'"))
        return F.concat(lit("'"), escaped, lit("'"))

    path = F.when(~F.contains(key, lit('"')), F.concat(lit('$["'), key, lit('"]')))
    path = path.when(~F.contains(key, lit("'")), F.concat(lit("$['"), key, lit("']")))
    plain = F.concat(lit(f"try_variant_get({col}, "), quoted(path), lit(", '"), kind, lit("')"))
    mapped = F.concat(lit(f"try_variant_get(try_variant_get({col}, '$', '{AS_MAP}')["), quoted(key), lit("], '$', '"), kind, lit("')"))
    alias = F.concat(lit(" AS `"), F.replace(F.col("column_name"), lit("`"), lit("``")), lit("`"))
    lines = named.select("key_norm", "rn", F.concat(F.when(path.isNotNull(), plain).otherwise(mapped), alias).alias("line"))
    return lines.agg(F.expr("listagg(line, ',\\n') WITHIN GROUP (ORDER BY key_norm, rn)").alias(out))


def flatten_object(
    df: DataFrame,
    col: str,
    prefix: str = "v_",
    keys: Sequence[tuple[str, ...]] | None = None,
    where: Column | None = None,
    typed: bool = False,
) -> DataFrame:
    """All other columns, then one column per key of the object.

    ``keys`` gives (key, column name) or (key, column name, type); without it
    they are discovered, with ``typed`` their types too.  A key without type
    becomes text.  Each object is parsed once for all keys.  An object that
    lacks a key, a value that its type cannot hold, and text that is no JSON
    give NULL.
    """
    if keys is None:
        named = discover_keys(df, col, prefix, where, typed).orderBy("key_norm", "rn")
        keys = [tuple(r) for r in named.select("key", "column_name", *(["type"] if typed else [])).collect()]
    names = [k[1] for k in keys]
    rest = [c for c in df.columns if c != col]
    lower = [n.lower() for n in [*rest, *names]]
    clash = {n for n in names if lower.count(n.lower()) > 1}
    if clash:
        raise ValueError(f"column names clash: {sorted(clash)}")
    others = [F.col(f"`{c}`") for c in rest]
    if not keys:
        return df.select(*others)
    if not _is_variant(df, col) and all(len(k) == 2 for k in keys):
        return df.select(*others, F.json_tuple(col, *[k for k, _ in keys]).alias(*names))
    whole = df.select(*others, _as_variant(df, col).alias("_object"))
    if any(variant_path(k[0]) is None for k in keys):
        whole = whole.withColumn("_map", F.try_variant_get("_object", "$", AS_MAP))
    columns = []
    for key, name, *kind in keys:
        path, source = variant_path(key), F.col("_object")
        if path is None:
            path, source = "$", F.col("_map")[F.lit(key)]
        columns.append(F.try_variant_get(source, path, *(kind or ["string"])).alias(name))
    return whole.select(*others, *columns)


def rows_to_array(df: DataFrame, keys: Sequence[str], cols: Sequence[str], out: str = "items") -> DataFrame:
    """The rows of each key as a sorted array of structs.

    For groups known to be small, such as the columns of a table; a group is
    held in one task.
    """
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*cols))).alias(out))


def schema_rows(df: DataFrame) -> DataFrame:
    """Name, type and position of each column, one row per column."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(
        rows, "order_id int, column_name string, type string, nullable boolean"
    )


def _is_variant(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.VariantType)


def _as_variant(df: DataFrame, col: str) -> Column:
    return F.col(col) if _is_variant(df, col) else F.try_parse_json(F.col(col))
