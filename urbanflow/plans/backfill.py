"""Monthly backfill of the zone facts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.times import bucket, with_time_parts
from ..operators.predicates import bounds_predicate
from ..operators.quality import audit_funnel
from ..operators.rollup import mean_of
from ..schemas import NAMED_TRIP_MEASURES, TRIP_BOUNDS, TRIP_MEASURES, Bound, Measure
from ..sources.readers import MONTH_FILE, NoMonths, read_months
from ..sources.writers import write_month, write_table
from .facts import PICKUP, ZONE, named_zone_facts, with_duration
from .ledger import commit_months, input_files, output_files, unchanged_months


def in_own_month(tag: str = "ym") -> Column:
    """Whether a trip's pickup lies in the month its file is named after."""
    named = F.replace(F.col(tag), F.lit("-"), F.lit("")).try_cast("int")
    return F.year(PICKUP) * 100 + F.month(PICKUP) == named


def months_in_scope(trips: DataFrame, tag: str = "ym") -> DataFrame:
    """Trips whose pickup lies in the month their file is named after."""
    return trips.filter(in_own_month(tag)).drop(tag)


def audit_months(trips: DataFrame, tag: str = "ym") -> DataFrame:
    """Row funnel of each monthly file, from its raw rows to the groups they form."""
    return audit_funnel(trips, tag, PICKUP, ZONE, in_own_month(tag))


#: Counts of a month's funnel that are sums over its groups.
FUNNEL_SUMS = ("raw_rows", "null_time_rows", "in_scope_rows", "null_key_rows", "kept_rows", "sane_rows")
FUNNEL = "ym string, " + ", ".join(f"{c} bigint" for c in FUNNEL_SUMS) + (
    ", group_rows bigint, written_rows bigint, min_bucket timestamp_ntz, max_bucket timestamp_ntz"
)


class Backfilled(dict[str, str]):
    """The skipped months with their reasons; ``funnel`` has a row for each month read, ``unchanged`` names those left alone."""

    def __init__(self) -> None:
        super().__init__()
        self.funnel: list[dict] = []
        self.unchanged: list[str] = []

    def funnel_rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(r.values()) for r in self.funnel], FUNNEL)


def _funnel(tag: str, month: str | None = None) -> dict[str, Column]:
    """Aggregates over audited groups: those of one month, or of all rows at hand."""
    own = F.lit(True) if month is None else F.col(tag) == month
    filled = own & (F.col("kept_rows") > 0)
    out = {c: F.coalesce(F.sum(F.when(own, F.col(c))), F.lit(0)) for c in FUNNEL_SUMS}
    out["group_rows"] = F.count_if(filled)
    out["written_rows"] = F.count_if(own & (F.col("trips") > 0))
    out["min_bucket"] = F.min(F.when(filled, F.col("hour_ts")))
    out["max_bucket"] = F.max(F.when(filled, F.col("hour_ts")))
    return out


def audited_groups(
    trips: DataFrame, bounds: Mapping[str, Bound] | None = TRIP_BOUNDS, measures: Iterable[Measure] = TRIP_MEASURES, tag: str = "ym"
) -> DataFrame:
    """Hour x zone groups of each delivery with their facts and the rows that each cleaning step left.

    All rows that are not kept form one group of their delivery.  Rows out of
    bounds are counted but add nothing to the facts.
    """
    scoped = F.coalesce(in_own_month(tag), F.lit(False))
    kept = scoped & F.col(ZONE).isNotNull()
    sane = kept & F.coalesce(bounds_predicate(bounds or {}, [ZONE]), F.lit(False))
    measures = list(measures)
    rows = with_duration(trips)
    hour = bucket(PICKUP)
    rows = rows.select(
        tag,
        F.when(kept, hour).alias("hour_ts"),
        F.when(kept, F.col(ZONE)).alias(ZONE),
        *[F.when(sane, F.col(c)).alias(c) for c in dict.fromkeys(m.source for m in measures)],
        F.col(PICKUP).isNull().alias("_null_time"),
        scoped.alias("_scoped"),
        kept.alias("_kept"),
        sane.alias("_sane"),
    )
    counts = {
        "trips": F.count_if("_sane"),
        "raw_rows": F.count(F.lit(1)),
        "null_time_rows": F.count_if("_null_time"),
        "in_scope_rows": F.count_if("_scoped"),
        "null_key_rows": F.count_if(F.col("_scoped") & ~F.col("_kept")),
        "kept_rows": F.count_if("_kept"),
        "sane_rows": F.count_if("_sane"),
    }
    means = [mean_of(m.source, m.unit, m.digits).alias(m.mean_as) for m in measures]
    return rows.groupBy(tag, "hour_ts", ZONE).agg(*[c.alias(n) for n, c in counts.items()], *means)


def _facts(groups: DataFrame, measures: Iterable[Measure]) -> DataFrame:
    facts = with_time_parts(groups.where("trips > 0"))
    return facts.select("hour_ts", "year", "month", "day", "hour", ZONE, "trips", *[m.mean_as for m in measures])


def write_audited(
    spark: SparkSession,
    trips: DataFrame,
    months: Iterable[str],
    out: str,
    bounds: Mapping[str, Bound] | None = TRIP_BOUNDS,
    measures: Iterable[Measure] = TRIP_MEASURES,
    tag: str = "ym",
) -> list[dict]:
    """Write the zone facts of ``months`` and return their funnels, from one scan of the trips.

    The counts are metrics observed on the groups being written.  A task that
    runs again may report twice, so they are held against the rows that the
    footers of the written files state; if they differ, the groups are counted
    by a query of their own.  A month left without rows loses its old files.
    """
    months, measures = list(months), list(measures)
    groups = audited_groups(trips, bounds, measures, tag)
    seen = Observation()
    metrics = [c.alias(f"{ym}:{name}") for ym in months for name, c in _funnel(tag, ym).items()]
    write_month(_facts(groups.observe(seen, *metrics), measures), out)
    got = seen.get
    funnel = [{"ym": ym} | {name: got[f"{ym}:{name}"] for name in _funnel(tag)} for ym in months]

    clear_months(spark, out, [r["ym"] for r in funnel if not r["written_rows"]])
    if {r["ym"]: r["written_rows"] for r in funnel if r["written_rows"]} != written_rows(spark, out, months):
        recount = groups.groupBy(tag).agg(*[c.alias(name) for name, c in _funnel(tag).items()])
        counted = {r[tag]: r.asDict() for r in recount.collect()}
        funnel = [counted.get(ym, dict.fromkeys(row, 0) | {"ym": ym, "min_bucket": None, "max_bucket": None}) for ym, row in zip(months, funnel)]
        funnel = [{"ym": r[tag]} | {k: v for k, v in r.items() if k != tag} for r in funnel]
        clear_months(spark, out, [r["ym"] for r in funnel if not r["written_rows"]])
    return funnel


def written_rows(spark: SparkSession, out: str, months: Iterable[str]) -> dict[str, int]:
    """Rows of each month that the table's files hold, by their footers."""
    wanted = [int(ym.replace("-", "")) for ym in months]
    try:
        table = spark.read.parquet(out)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return {}
        raise
    ym = (F.col("year") * 100 + F.col("month")).cast("int")
    rows = table.where(ym.isin(wanted)).groupBy("year", "month").count().collect()
    return {f"{r['year']:04d}-{r['month']:02d}": r["count"] for r in rows}


def clear_months(spark: SparkSession, out: str, months: Iterable[str]) -> None:
    """Remove the folders of months that have no rows any more; a write of no rows would leave them."""
    for ym in months:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/year={int(ym[:4])}/month={int(ym[5:])}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def backfill(
    spark: SparkSession,
    root: str,
    months: Iterable[tuple[int, int]],
    out: str,
    bounds: Mapping[str, Bound] | None = TRIP_BOUNDS,
    measures: Iterable[Measure] = TRIP_MEASURES,
    batch: int | None = None,
    template: str = MONTH_FILE,
    ignore_corrupt: bool = False,
    ledger: str | None = None,
) -> Backfilled:
    """(Re)write the hour x zone fact of the given months; returns the skipped ones and the others' row funnels.

    A damaged file fails the job.  With ``ignore_corrupt`` what can be read of
    it is written, and its month is returned with the rows it lacks.

    All months run as one job, or ``batch`` months per job, whose results then
    stay if a later job fails.  Each month replaces its own folder, so a rerun,
    whole or partial, leaves no duplicates and touches no other month.

    ``ledger`` names a folder with a commit for each month written.  A month
    whose input files and written files are those of its last commit is left
    alone; one that is changed, half written or damaged is done again.
    """
    months, done = list(months), Backfilled()
    inputs = input_files(spark, root, months, template) if ledger else {}
    if ledger:
        done.unchanged = unchanged_months(spark, ledger, inputs, output_files(spark, out))
        months = [(y, m) for y, m in months if f"{y:04d}-{m:02d}" not in done.unchanged]
    size = batch or max(len(months), 1)
    for first in range(0, len(months), size):
        some = months[first : first + size]
        try:
            trips, lost = read_months(spark, root, some, template=template, ignore_corrupt=ignore_corrupt)
        except NoMonths as e:
            done |= e.skipped
            continue
        done |= lost
        short = {ym for ym, reason in lost.items() if reason.startswith("only ")}
        read = [ym for ym in (f"{y:04d}-{m:02d}" for y, m in some) if ym not in lost or ym in short]
        funnel = write_audited(spark, trips, read, out, bounds, measures)
        done.funnel += funnel
        if ledger:
            whole = {r["ym"]: r["written_rows"] for r in funnel if r["ym"] not in lost}
            commit_months(spark, ledger, inputs, output_files(spark, out), whole)
    return done


def backfill_named(
    spark: SparkSession,
    root: str,
    months: Iterable[tuple[int, int]],
    lookup: DataFrame,
    out: str,
    measures: Iterable[Measure] = NAMED_TRIP_MEASURES,
    template: str = MONTH_FILE,
    ignore_corrupt: bool = False,
) -> dict[str, str]:
    """Rewrite the hour x zone fact with zone names, of all trips with time and zone.

    The dropoff is not needed, so files without it are read as well.
    """
    required = [PICKUP, ZONE, *[m.source for m in measures]]
    trips, skipped = read_months(spark, root, months, required=required, template=template, ignore_corrupt=ignore_corrupt)
    write_table(named_zone_facts(months_in_scope(trips), lookup, measures=measures), out)
    return skipped
