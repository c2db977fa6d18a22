import datetime as dt
import decimal
import itertools

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from urbanflow.sources.inference import infer, read_drifting, readable, register_drifting, widen

TYPES = ["void", "tinyint", "int", "bigint", "float", "double", "decimal(9,2)", "decimal(38,10)", "date", "timestamp_ntz", "timestamp", "boolean", "string", "binary", "array<int>"]


def test_lattice():
    for a, b in itertools.product(TYPES, repeat=2):
        assert widen(a, b) == widen(b, a)
        assert widen(a, a) == a
        assert widen(widen(a, b), b) == widen(a, b)
    for a, b, c in itertools.product(TYPES, repeat=3):
        assert widen(widen(a, b), c) == widen(a, widen(b, c)), (a, b, c)
    assert widen("int", "decimal(9,2)") == "decimal(12,2)" and widen("bigint", "float") == "double"
    assert widen("date", "timestamp_ntz") == "timestamp_ntz" and widen("timestamp", "timestamp_ntz") == "string"


def put(folder, name, **columns):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path)


@pytest.fixture
def staged_files(tmp_path):
    put(tmp_path, "year=2023/month=1/a.parquet", id=pa.array([1, None], pa.int32()), zone=pa.array(["x", "y"]), day=pa.array([dt.date(2023, 1, 5)] * 2))
    put(tmp_path, "year=2023/month=2/b.parquet", ID=pa.array([2**40], pa.int64()), zone=pa.array(["z"]), tip=pa.array([1.5], pa.float32()))
    put(tmp_path, "year=2024/month=1/c.parquet", tip=pa.array([2], pa.int16()), id=pa.array([2.5], pa.float64()), zone=pa.array([7], pa.int64()))
    put(tmp_path, "year=2024/month=2/a.parquet", id=pa.array([4], pa.int32()), zone=pa.array(["w"]), day=pa.array([dt.date(2024, 2, 1)]))
    return tmp_path


def test_infer_and_read(spark, staged_files, plan):
    found = infer(spark, str(staged_files))
    assert {f.name: f.dataType.simpleString() for f in found.schema} == {"id": "double", "zone": "string", "day": "date", "tip": "double"}
    assert sorted(len(files) for _, files in found.scans) == [1, 1, 2]
    rows = {(r["column_name"], r["stored"]): (r["files"], r["becomes"]) for r in found.conflict_rows(spark).collect()}
    assert rows == {
        ("id", "int"): (2, "double"), ("id", "bigint"): (1, "double"), ("id", "double"): (1, "double"), ("tip", "float"): (1, "double"),
        ("tip", "smallint"): (1, "double"), ("zone", "string"): (3, "string"), ("zone", "bigint"): (1, "string"),
    }
    df = read_drifting(spark, found, source="file")
    got = sorted((r.year, r.month, r.id is not None, r.id, r.zone, r.day, r.tip) for r in df.collect())
    assert got == [
        (2023, 1, False, None, "y", dt.date(2023, 1, 5), None), (2023, 1, True, 1.0, "x", dt.date(2023, 1, 5), None),
        (2023, 2, True, 2.0**40, "z", None, 1.5), (2024, 1, True, 2.5, "7", None, 2.0), (2024, 2, True, 4.0, "w", dt.date(2024, 2, 1), None),
    ]
    assert all(r.file.endswith(".parquet") for r in df.select("file").collect())
    assert plan(df.where("year = 2024")).count("PartitionFilters: [isnotnull(year") == 3  # folders still prune


def test_no_row_is_read(spark, staged_files):
    """Only footers: a file whose pages are overwritten has the same layout."""
    path = staged_files / "year=2024/month=1/c.parquet"
    raw = bytearray(path.read_bytes())
    size = int.from_bytes(raw[-8:-4], "little")
    raw[4 : len(raw) - 8 - size] = bytes(len(raw) - 12 - size)
    path.write_bytes(raw)
    assert infer(spark, str(staged_files)).schema["id"].dataType.simpleString() == "double"


def test_register_widened_by_the_reader(spark, tmp_path):
    put(tmp_path, "year=2023/a.parquet", n=pa.array([1], pa.int32()), x=pa.array([1.5], pa.float32()), d=pa.array([dt.date(2024, 1, 2)]))
    put(tmp_path, "year=2024/b.parquet", n=pa.array([2**40], pa.int64()), x=pa.array([2.5], pa.float64()), d=pa.array([dt.datetime(2024, 1, 2, 3)], pa.timestamp("us")))
    found = register_drifting(spark, "widened_files", str(tmp_path))
    assert len(found.conflicts) == 6
    assert sorted(map(tuple, spark.table("widened_files").collect())) == [
        (1, 1.5, dt.datetime(2024, 1, 2), 2023), (2**40, 2.5, dt.datetime(2024, 1, 2, 3), 2024),
    ]
    assert spark.catalog.getTable("widened_files").tableType == "EXTERNAL"
    register_drifting(spark, "widened_files", str(tmp_path))  # again, in place of the earlier one
    spark.sql("DROP TABLE widened_files")


def test_register_with_casts(spark, staged_files):
    register_drifting(spark, "mixed_files", str(staged_files))
    row = spark.sql("SELECT count(*) AS n, sum(id) AS s, count_if(year = 2024) AS late FROM mixed_files").first()
    assert tuple(row) == (5, 2.0**40 + 7.5, 2)


def test_every_widening_reads(spark, tmp_path):
    """What `readable` promises, Spark's reader does."""
    values = {
        "tinyint": pa.array([3], pa.int8()), "smallint": pa.array([3], pa.int16()), "int": pa.array([3], pa.int32()), "bigint": pa.array([3], pa.int64()),
        "float": pa.array([3.0], pa.float32()), "double": pa.array([3.0]), "decimal(9,2)": pa.array([decimal.Decimal("3.00")], pa.decimal128(9, 2)),
        "date": pa.array([dt.date(2024, 1, 1)]), "timestamp_ntz": pa.array([dt.datetime(2024, 1, 1)], pa.timestamp("us")), "string": pa.array(["3"]),
    }
    for kind, column in values.items():
        put(tmp_path, f"{kind}.parquet", x=column)
    for a, b in itertools.product(values, repeat=2):
        wide = widen(a, b)
        if readable(a, wide):
            row = spark.read.schema(f"x {wide}").parquet(str(tmp_path / f"{a}.parquet")).first()
            assert row.x == (dt.datetime(2024, 1, 1) if wide == "timestamp_ntz" else dt.date(2024, 1, 1) if wide == "date" else "3" if wide == "string" else 3), (a, wide)


def test_nothing_and_damage(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        infer(spark, str(tmp_path))
    (tmp_path / "bad.parquet").write_bytes(b"not a parquet file")
    with pytest.raises(Exception, match="(?i)parquet"):
        infer(spark, str(tmp_path))
