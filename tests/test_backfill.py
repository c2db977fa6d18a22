import datetime as dt
import os
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Observation

from urbanflow.plans import backfill as module
from urbanflow.plans.backfill import _facts, _funnel, audit_months, audited_groups, backfill
from urbanflow.plans.facts import zone_facts
from urbanflow.plans.ledger import read_ledger
from urbanflow.schemas import TRIP_MEASURES
from urbanflow.sources.readers import month_path, read_months

MONTHS = [(2023, 12), (2024, 1), (2024, 2)]


def month_file(root, year, month, rows=40, zone_type=None, late=3, template=None):
    """Trips of a month: some late, some without time or zone, some out of bounds."""
    start, pickups, zones, fares = dt.datetime(year, month, 2, 5), [], [], []
    for i in range(rows):
        pickups.append(None if i % 11 == 7 else start + dt.timedelta(minutes=17 * i) + dt.timedelta(days=40) * (i < late))
        zones.append(None if i % 9 == 4 else i % 3)
        fares.append(-5.0 if i % 8 == 2 else 10.25 + i)
    data = {
        "tpep_pickup_datetime": pa.array(pickups, pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([p and p + dt.timedelta(minutes=9) for p in pickups], pa.timestamp("us")),
        "PULocationID": pa.array(zones, zone_type or pa.int32()),
        **{c: pa.array(fares) for c in ("fare_amount", "total_amount")},
        "trip_distance": pa.array([1.5] * rows),
        "tip_amount": pa.array([None if i % 5 == 0 else 2.0 for i in range(rows)], pa.float64()),
    }
    path = month_path(str(root), year, month, *([template] if template else []))
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(data), path)
    return path


@pytest.fixture
def raw(tmp_path):
    for i, (y, m) in enumerate(MONTHS):
        month_file(tmp_path / "raw", y, m, rows=40 + i, zone_type=pa.int64() if i else None)
    return str(tmp_path / "raw")


def table(spark, out):
    return sorted(map(tuple, spark.read.parquet(out).select("hour_ts", "PULocationID", "trips", *[m.mean_as for m in TRIP_MEASURES]).collect()))


def test_funnel_equals_the_audit(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    done = backfill(spark, raw, MONTHS, out)
    trips, _ = read_months(spark, raw, MONTHS)
    audit = {r["ym"]: r.asDict() for r in audit_months(trips).collect()}
    rows = {r["ym"]: r.asDict() for r in done.funnel_rows(spark).collect()}
    assert set(rows) == set(audit) == {"2023-12", "2024-01", "2024-02"}
    for ym, row in rows.items():
        assert {c: row[c] for c in audit[ym]} == audit[ym]
        assert row["raw_rows"] > row["in_scope_rows"] > row["kept_rows"] > row["sane_rows"] > 0
    # and the table is that of the plain plan
    plain = zone_facts(module.months_in_scope(trips)).select("hour_ts", "PULocationID", "trips", *[m.mean_as for m in TRIP_MEASURES])
    assert table(spark, out) == sorted(map(tuple, plain.collect()))
    assert sum(r["written_rows"] for r in rows.values()) == plain.count()


def test_one_scan(spark, raw, plan):
    """The plan that writes and counts reads each layout's files once."""
    trips, _ = read_months(spark, raw, MONTHS)
    metrics = [c.alias(n) for n, c in _funnel("ym", "2024-01").items()]
    text = plan(_facts(audited_groups(trips).observe(Observation(), *metrics), TRIP_MEASURES))
    assert text.count("FileScan parquet") == 2  # two layouts
    assert text.count("CollectMetrics") == 1


def test_metrics_reported_twice_are_counted_anew(spark, raw, tmp_path, monkeypatch):
    good = backfill(spark, raw, MONTHS, str(tmp_path / "a")).funnel

    class Twice(Observation):
        @property
        def get(self):
            return {k: v * 2 if isinstance(v, int) else v for k, v in super().get.items()}

    monkeypatch.setattr(module, "Observation", Twice)
    assert backfill(spark, raw, MONTHS, str(tmp_path / "b")).funnel == good


def test_month_that_loses_all_rows(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    backfill(spark, raw, MONTHS, out)
    month_file(raw, 2024, 1, rows=3, late=3)  # none is in its month
    done = backfill(spark, raw, MONTHS, out)
    assert [r["written_rows"] > 0 for r in done.funnel] == [True, False, True]
    assert {(r.year, r.month) for r in spark.read.parquet(out).select("year", "month").distinct().collect()} == {(2023, 12), (2024, 2)}


@pytest.mark.parametrize("template", [None, "m={year:04d}-{month:02d}/part.parquet"])
def test_ledger(spark, raw, tmp_path, template):
    more = {"ledger": str(tmp_path / "ledger")}
    if template:
        raw = str(tmp_path / "folders")
        for y, m in MONTHS:
            month_file(raw, y, m, template=template)
        more["template"] = "m={year:04d}-{month:02d}"
    out = str(tmp_path / "out")
    first = backfill(spark, raw, MONTHS, out, **more)
    assert first == {} and first.unchanged == [] and len(first.funnel) == 3
    whole = table(spark, out)
    names = ["2023-12", "2024-01", "2024-02"]

    again = backfill(spark, raw, MONTHS, out, **more)
    assert again.unchanged == names and again.funnel == []

    # a replaced month
    args = {"template": template} if template else {}
    month_file(raw, 2024, 1, rows=55, **args)
    third = backfill(spark, raw, MONTHS, out, **more)
    assert third.unchanged == ["2023-12", "2024-02"] and [r["ym"] for r in third.funnel] == ["2024-01"]
    assert table(spark, out) != whole
    whole = table(spark, out)

    # a half-written month: files there, one lost, no new commit
    folder = tmp_path / "out" / "year=2024" / "month=2"
    lost = sorted(folder.glob("*.parquet"))[0]
    shutil.copy(lost, folder / "part-extra.parquet")
    lost.unlink()
    fourth = backfill(spark, raw, MONTHS, out, **more)
    assert fourth.unchanged == ["2023-12", "2024-01"] and table(spark, out) == whole

    # a new month and one that is not there
    month_file(raw, 2024, 3, **args)
    fifth = backfill(spark, raw, [*MONTHS, (2024, 3), (2024, 4)], out, **more)
    assert fifth.unchanged == names and [r["ym"] for r in fifth.funnel] == ["2024-03"] and set(fifth) == {"2024-04"}
    rows = {r["ym"]: (r["run"], r["rows"]) for r in read_ledger(spark, more["ledger"]).collect()}
    assert {ym: run for ym, (run, _) in rows.items()} == {"2023-12": 1, "2024-01": 2, "2024-02": 3, "2024-03": 4}
    assert sum(n for _, n in rows.values()) == spark.read.parquet(out).count()


def test_no_commit_before_the_write(spark, raw, tmp_path, monkeypatch):
    ledger, out = str(tmp_path / "ledger"), str(tmp_path / "out")

    def fails(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(module, "write_month", fails)
        with pytest.raises(RuntimeError):
            backfill(spark, raw, MONTHS, out, ledger=ledger)
    assert read_ledger(spark, ledger).count() == 0
    assert backfill(spark, raw, MONTHS, out, ledger=ledger, batch=1).unchanged == []
    assert backfill(spark, raw, MONTHS, out, ledger=ledger).unchanged == ["2023-12", "2024-01", "2024-02"]
