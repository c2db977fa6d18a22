"""URL filters by dated lists: entries become validity intervals, captures are joined to them as of fetch time.

Only DataFrame functions.  A list says when an entry was added and removed.
Consecutive changes of one entry give the intervals in which it held.  A
capture meets an interval by an equal key, one of the domains above its host
or of the prefixes of its path, and an equal stretch of time; so neither a host
with very many captures nor an entry with a long history is compared row by
row, and Spark can split a large key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400
_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """The host of an absolute URL in lower case, without user, port and final dot; null if there is none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, _AUTHORITY, 1)), r"\.+$", "")
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """The path of an absolute URL without query, fragment and final slashes."""
    return F.regexp_replace(F.regexp_extract(url, _PATH, 1), "/+$", "")


def validity(entries: DataFrame) -> DataFrame:
    """(list, rule, pattern, valid_from, valid_to) from rows (list, rule, pattern, action, at).

    An entry holds from an ``add`` up to its next ``remove``; without one
    valid_to is null.  Of changes at the same instant a removal comes last.
    Repeated additions and removals, and removals of what isn't there, change
    nothing.  Rows with a null in one of the five columns are left out.
    """
    key = ["list", "rule", "pattern"]
    rows = entries.select(*key, "action", "at").dropna().where(F.col("action").isin("add", "remove"))
    order = Window.partitionBy(*key).orderBy("at", "action")
    before = F.lag("action").over(order)
    changes = rows.withColumn("before", before).where((F.col("action") != F.coalesce("before", F.lit("remove"))))
    spans = changes.withColumn("valid_to", F.lead("at").over(order)).where("action = 'add'")
    return spans.select(*key, F.col("at").alias("valid_from"), "valid_to").where("valid_to is null or valid_to > valid_from")


def _keys(host: Column, path: Column, depth: int) -> Column:
    """The keys of a capture: every domain above its host and itself, and host and path up to ``depth`` segments."""
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(F.lit("domain").alias("rule"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")),
    )
    parts = F.slice(F.split(path, "/"), 2, depth) if depth else F.array().cast("array<string>")
    prefixes = F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda i: F.struct(
            F.lit("prefix").alias("rule"),
            F.concat_ws("/", F.array(host), F.slice(parts, 1, i)).alias("pattern"),
        ),
    )
    return F.array_distinct(F.concat(domains, prefixes))


def url_filter(
    captures: DataFrame,
    entries: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    time_col: str = "fetched",
    allow: tuple[str, ...] = ("allow",),
    days: int = 30,
) -> DataFrame:
    """(id_col, url, fetched, host, lists, blocked) for every row of ``captures``.

    ``entries`` has list, rule (``domain``: the host or one below it;
    ``prefix``: host and path, whole segments), pattern (host in lower case, no
    final slash), action (``add`` or ``remove``) and at (timestamp).  lists
    names the lists with an entry that held at fetch time, sorted; a capture is
    blocked if a list other than those in ``allow`` is among them and none of
    ``allow`` is.  A null time, a null URL or one without a host matches
    nothing.  Ids may be null or repeat.  Other columns are ignored.
    """
    rows = captures.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(time_col).cast("timestamp").alias("fetched")
    ).withColumn("host", host_of(F.col("url")))
    spans = validity(entries)
    # two numbers: how deep prefixes go, and when the last capture was
    depth = spans.where("rule = 'prefix'").agg(F.max(F.size(F.split("pattern", "/")))).first()[0] or 1
    last = rows.agg(F.max(F.unix_timestamp("fetched"))).first()[0] or 0

    def stretch(at: Column) -> Column:
        return F.floor(at / (days * DAY)).cast("long")

    until = F.least(F.coalesce(F.unix_timestamp("valid_to"), F.lit(last)), F.lit(last))
    spans = spans.where(F.unix_timestamp("valid_from") <= last)
    spans = spans.withColumn("stretch", F.explode(F.sequence(stretch(F.unix_timestamp("valid_from")), stretch(until))))

    distinct = rows.where("host is not null and fetched is not null").select("url", "host", "fetched").distinct()
    keyed = distinct.withColumn("key", F.explode(_keys(F.col("host"), path_of(F.col("url")), depth - 1)))
    keyed = keyed.select("url", "fetched", "key.rule", "key.pattern", stretch(F.unix_timestamp("fetched")).alias("stretch"))
    met = keyed.join(spans, ["rule", "pattern", "stretch"])
    met = met.where("fetched >= valid_from and (valid_to is null or fetched < valid_to)")
    named = met.groupBy("url", "fetched").agg(F.array_sort(F.collect_set("list")).alias("lists"))

    out = rows.join(named, ["url", "fetched"], "left").withColumn("lists", F.coalesce("lists", F.array().cast("array<string>")))
    allowed = F.array(*[F.lit(x) for x in allow]).cast("array<string>")
    blocked = (F.size(F.array_except("lists", allowed)) > 0) & ~F.arrays_overlap("lists", allowed)
    return out.select(F.col("id").alias(id_col), "url", "fetched", "host", "lists", blocked.alias("blocked"))
