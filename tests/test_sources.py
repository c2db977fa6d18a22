import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from urbanflow.operators.project import MissingColumns
from urbanflow.operators.quality import expected_months, missing_months
from urbanflow.plans.backfill import audit_months, backfill, backfill_named
from urbanflow.schemas import MASTER, ZONE_FINAL, layout
from urbanflow.sources import catalog
from urbanflow.sources.readers import (
    file_index,
    file_inventory,
    list_files,
    load_by_name,
    malformed_fields,
    month_path,
    read_by_path,
    read_csv,
    read_facts,
    read_lookup,
    read_month,
    read_months,
    read_weather,
    with_path_partitions,
)
from urbanflow.sources.writers import export, save_as, write_fact, write_month, write_table

HEAD = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
AMOUNTS = ("trip_distance", "fare_amount", "total_amount", "tip_amount")


def month_file(root, year, month, zones=(1, 2, 2), zone_type=None, drop=(), pickups=None):
    """A small monthly file; the last pickup lies in the month after."""
    start = dt.datetime(year, month, 3, 8, 15)
    after = dt.datetime(year + month // 12, month % 12 + 1, 1)
    pickups = pickups or [start, start, after]
    data = {
        HEAD[0]: pa.array(pickups, pa.timestamp("us")),
        HEAD[1]: pa.array([p + dt.timedelta(minutes=10) for p in pickups], pa.timestamp("us")),
        "PULocationID": pa.array(zones, zone_type or pa.int32()),
        **{a: pa.array([2.0, 4.0, 6.0], pa.float64()) for a in AMOUNTS},
    }
    pq.write_table(pa.table({k: v for k, v in data.items() if k not in drop}), month_path(str(root), year, month))


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "raw"
    root.mkdir()
    month_file(root, 2023, 11)
    month_file(root, 2023, 12, zone_type=pa.int64())
    month_file(root, 2024, 1)
    month_file(root, 2024, 2, drop=["tip_amount"])
    (root / "yellow_tripdata_2024-03.parquet").write_bytes(b"not a parquet file")
    return str(root)


MONTHS = [(2023, 11), (2023, 12), (2024, 1), (2024, 2), (2024, 3), (2024, 4)]


def test_read_month(spark, landing):
    df = read_month(spark, landing, 2023, 12)
    assert dict(df.dtypes)["PULocationID"] == "int" and df.count() == 3
    with pytest.raises(MissingColumns):
        read_month(spark, landing, 2024, 2)


def test_read_months(spark, landing):
    df, skipped = read_months(spark, landing, MONTHS)
    assert set(skipped) == {"2024-02", "2024-03", "2024-04"} and "tip_amount" in skipped["2024-02"]
    got = {r["ym"]: r["count"] for r in df.groupBy("ym").count().collect()}
    assert got == {"2023-11": 3, "2023-12": 3, "2024-01": 3}
    assert dict(df.dtypes)["PULocationID"] == "int"


def test_read_months_scans_once_per_schema(spark, landing, plan):
    df, _ = read_months(spark, landing, MONTHS[:3])
    assert plan(df).count("FileScan parquet") == 2


def test_read_months_optional_and_strict(spark, landing):
    required = [c for c in (*HEAD, "PULocationID", *AMOUNTS) if c != "tip_amount"]
    df, skipped = read_months(spark, landing, MONTHS[2:4], required=required)
    assert not skipped and df.filter("ym = '2024-02' AND tip_amount IS NULL").count() == 3
    with pytest.raises(MissingColumns):
        read_months(spark, landing, MONTHS[2:4], on_error="raise")
    with pytest.raises(FileNotFoundError):
        read_months(spark, landing, MONTHS[4:])


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "unique_key,created_date,complaint_type,descriptor,borough,latitude,longitude\n"
        "1,2024-01-01T00:05:00.000,Noise,Loud,bronx,40.1,-73.9\n2,oops,,,,,\n"
    )
    got = read_csv(spark, str(tmp_path / "*.csv")).orderBy("unique_key").collect()
    assert got[0]["created_date"] == dt.datetime(2024, 1, 1, 0, 5) and got[0]["latitude"] == 40.1
    assert got[1]["unique_key"] == 2 and got[1]["created_date"] is None


def test_csv_files_in_different_orders(spark, tmp_path):
    """Columns are those of each file's own header."""
    (tmp_path / "a.csv").write_text("id,borough,kind\n1,BRONX,noise\n2,QUEENS,heat\n")
    (tmp_path / "b.csv").write_text('kind,id,borough\nnoise,3,"QUEENS"\nrodent,x,BRONX\n')
    (tmp_path / "c c%.csv").write_text("ID,KIND\n5,parking\n")
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv").write_text("id,borough,kind\n")
    wanted = layout("id int, borough string, kind string")
    got = read_csv(spark, str(tmp_path / "*.csv"), wanted).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, "BRONX", "noise"), (2, "QUEENS", "heat"), (3, "QUEENS", "noise"), (None, "BRONX", "rodent"), (5, None, "parking")], key=str
    )
    assert malformed_fields(spark, str(tmp_path / "*.csv"), wanted).first().asDict() == {"id": 1, "borough": 0, "kind": 0}
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "d.csv").write_text("")
    assert read_csv(spark, str(tmp_path / "none" / "*.csv"), wanted).collect() == []


def test_csv_files_of_one_header_share_a_scan(spark, tmp_path, plan):
    for i in range(5):
        (tmp_path / f"{i}.csv").write_text(f"id,kind\n{i},a\n" if i % 2 else f"kind,id\na,{i}\n")
    df = read_csv(spark, str(tmp_path / "*.csv"), layout("id int, kind string"))
    assert sorted(r["id"] for r in df.collect()) == [0, 1, 2, 3, 4] and plan(df).count("FileScan csv") == 2


def test_files_chosen_by_path(spark, tmp_path):
    """Numbers in file names choose the files; the others are not opened."""
    for y, m in ((2023, 1), (2023, 2), (2024, 1)):
        pq.write_table(pa.table({"v": [y * 100 + m]}), tmp_path / f"part_year={y}_month={m}.parquet")
    (tmp_path / "part_year=2022_month=1.parquet").write_bytes(b"damaged")
    df = read_by_path(spark, str(tmp_path), "year = 2023 AND month = 1")
    assert [f.rsplit("/", 1)[1] for f in df.inputFiles()] == ["part_year%3D2023_month%3D1.parquet"] or len(df.inputFiles()) == 1
    assert [(r["v"], r["year"], r["month"]) for r in df.collect()] == [(202301, 2023, 1)]
    two = read_by_path(spark, str(tmp_path), F.col("year") == 2023, schema=layout("v bigint"))
    assert sorted(r["v"] for r in two.collect()) == [202301, 202302] and len(two.inputFiles()) == 2
    none = read_by_path(spark, str(tmp_path), "year = 1999", schema=layout("v bigint"))
    assert none.columns == ["v", "year", "month", "source_file"] and none.collect() == []
    assert file_index(spark, str(tmp_path)).where("year = 2023").count() == 2


def test_lookup(spark, tmp_path):
    (tmp_path / "z.csv").write_text('LocationID,Borough,Zone,service_zone\n1,EWR,"Newark, Airport",EWR\nx,Unknown,N/A,N/A\n')
    got = [tuple(r) for r in read_lookup(spark, str(tmp_path / "z.csv")).collect()]
    assert got == [(1, "EWR", "Newark, Airport", "EWR"), (None, "Unknown", "N/A", "N/A")]


@pytest.mark.parametrize("stored", [pa.timestamp("ns"), pa.int64()])
def test_weather_nanos(spark, tmp_path, stored):
    nanos = 1704070800_000_000_000
    time = pa.array([nanos], pa.int64()).cast(stored)
    pq.write_table(pa.table({"time": time, "temp": [1.5], "coco": pa.array([8], pa.int32())}), str(tmp_path / "w.parquet"))
    got = read_weather(spark, str(tmp_path / "w.parquet")).first()
    assert (got["time"], got["temp"], got["coco"], got["wpgt"]) == (nanos, 1.5, 8.0, None)
    assert spark.conf.get("spark.sql.legacy.parquet.nanosAsLong") == "false"


@pytest.fixture
def facts(spark):
    data = [(2023, 1, "a"), (2023, 2, "b"), (2024, 1, "c")]
    return spark.createDataFrame(data, "year int, month int, v string")


def test_month_rewrite_replaces_only_its_month(spark, facts, tmp_path):
    path = str(tmp_path / "t")
    write_month(facts, path)
    write_month(facts.filter("year = 2023 AND month = 1").withColumn("v", F.lit("z")), path)
    assert sorted(r["v"] for r in read_facts(spark, path).collect()) == ["b", "c", "z"]


def test_fact_write_replaces_all_and_prunes(spark, facts, tmp_path, plan):
    path = str(tmp_path / "t")
    for cluster in (True, False):
        write_fact(facts, path, cluster=cluster)
        write_fact(facts.filter("year = 2023"), path, cluster=cluster)
        df = read_facts(spark, path)
        assert df.count() == 2
        text = plan(df.filter("year = 2023 AND month = 1"))
        assert "PartitionFilters: [isnotnull(year" in text
    typed = read_facts(spark, path, layout("v string, year bigint"))
    assert typed.dtypes == [("v", "string"), ("year", "bigint")]


def test_plain_writes(spark, facts, tmp_path):
    write_table(facts, str(tmp_path / "a"))
    write_table(facts.limit(1), str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1
    export(facts.coalesce(1), str(tmp_path / "b"), max_rows_per_file=1)
    assert len(list((tmp_path / "b").glob("*.parquet"))) == 3


def test_load_by_name(spark, tmp_path):
    pq.write_table(pa.table({"TRIPS": [3], "Zone": ["q"], "junk": [1]}), str(tmp_path / "x.parquet"))
    (tmp_path / "x.txt").write_text("ignored")
    got = load_by_name(spark, str(tmp_path), ZONE_FINAL)
    assert catalog.schema_differences(got, ZONE_FINAL) == []
    assert got.select("trips", "zone", "borough").first() == (3, "q", None)


def test_lineage_and_inventory(spark, facts, tmp_path):
    path = str(tmp_path / "t")
    write_fact(facts, path)
    raw = spark.read.option("recursiveFileLookup", "true").parquet(path)
    got = with_path_partitions(raw).orderBy("v").collect()
    assert [(r["year"], r["month"], r["v"]) for r in got] == [(2023, 1, "a"), (2023, 2, "b"), (2024, 1, "c")]
    assert all(r["source_file"].endswith(".parquet") for r in got)
    files = file_inventory(spark.read.parquet(path)).collect()
    assert len(files) == 3 and all(f["rows"] == 1 and f["file_size"] > 0 for f in files)
    assert list_files(spark, path, "*.parquet").count() == 3


def test_external_table_sees_new_files_after_refresh(spark, facts, tmp_path):
    path = str(tmp_path / "t")
    write_table(facts, path)
    assert catalog.register_external(spark, "ext_facts", path).count() == 3
    facts.write.mode("append").parquet(path)
    catalog.refresh(spark, "ext_facts")
    assert spark.table("ext_facts").count() == 6
    spark.sql("DROP TABLE ext_facts")


def test_external_partitioned_table(spark, facts, tmp_path):
    path = str(tmp_path / "t")
    write_fact(facts.filter("year = 2023"), path)
    assert catalog.register_external(spark, "ext_parts", path, partitioned=True).count() == 2
    write_month(facts.filter("year = 2024"), path)
    catalog.refresh(spark, "ext_parts", partitioned=True)
    assert spark.table("ext_parts").count() == 3
    spark.sql("DROP TABLE ext_parts")


def test_tables_and_views(spark, facts):
    save_as(facts, "kept_facts")
    save_as(facts.limit(2), "kept_facts", by=["year"])
    assert spark.table("kept_facts").count() == 2 and catalog.exists(spark, "kept_facts")
    catalog.publish_view(facts, "v_facts")
    catalog.publish_sql_view(spark, "sql_facts", "SELECT v FROM kept_facts")
    assert spark.table("v_facts").count() == 3 and spark.table("sql_facts").columns == ["v"]
    names = {r["name"] for r in catalog.list_tables(spark, "*facts").collect()}
    assert {"kept_facts", "v_facts", "sql_facts"} <= names
    catalog.create_table(spark, "typed_master", MASTER)
    assert catalog.schema_differences(spark.table("typed_master"), MASTER) == []
    assert catalog.schema_differences(facts, layout("year bigint, w int")) == [
        "missing w", "extra month", "extra v", "year is int, not bigint",
    ]
    spark.sql("DROP VIEW sql_facts")
    for name in ("kept_facts", "typed_master"):
        spark.sql(f"DROP TABLE {name}")


def test_backfill_is_rerunnable(spark, landing, tmp_path):
    out = str(tmp_path / "zones")
    assert set(backfill(spark, landing, MONTHS[:4], out)) == {"2024-02"}
    first = sorted(map(tuple, read_facts(spark, out).collect()))
    # the third trip of each file lies outside the file's month
    assert sum(r["trips"] for r in read_facts(spark, out).collect()) == 6
    backfill(spark, landing, MONTHS[:4], out)
    backfill(spark, landing, MONTHS[1:2], out)
    assert sorted(map(tuple, read_facts(spark, out).collect())) == first


def test_backfill_in_batches(spark, landing, tmp_path):
    whole, batched = str(tmp_path / "a"), str(tmp_path / "b")
    lost = backfill(spark, landing, MONTHS, whole)
    assert backfill(spark, landing, MONTHS, batched, batch=1) == lost
    assert sorted(map(tuple, read_facts(spark, whole).collect())) == sorted(map(tuple, read_facts(spark, batched).collect()))


def test_audit_and_named_backfill(spark, landing, tmp_path):
    trips, _ = read_months(spark, landing, MONTHS)
    got = {r["ym"]: r for r in audit_months(trips).collect()}
    assert {k: (r["raw_rows"], r["in_scope_rows"], r["kept_rows"], r["group_rows"]) for k, r in got.items()} == {
        m: (3, 2, 2, 2) for m in ("2023-11", "2023-12", "2024-01")
    }
    gaps = missing_months(expected_months(spark, MONTHS), trips, ["ym"])
    assert sorted(r["ym"] for r in gaps.collect()) == ["2024-02", "2024-03", "2024-04"]

    lookup = spark.createDataFrame([("1", "Bronx", "A", "S")], "LocationID string, Borough string, Zone string, service_zone string")
    out = str(tmp_path / "named")
    assert set(backfill_named(spark, landing, MONTHS, lookup, out)) == {"2024-02", "2024-03", "2024-04"}
    rows = spark.read.parquet(out)
    assert rows.agg(F.sum("trips")).first()[0] == 6 and rows.filter("borough IS NULL").count() == 3
    assert set(rows.columns) == set(ZONE_FINAL.fieldNames())
