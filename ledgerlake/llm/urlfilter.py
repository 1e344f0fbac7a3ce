"""URL filtering with a temporal list join.

A list is a log of dated entries: on a day, a pattern is put on the list with an action and a
category, or taken off it (action ``remove``).  Entries become validity intervals: an entry holds
from its day until the day before the next entry of the same pattern.  Of several entries of one
pattern on one day the last by ``seq`` counts; an entry that changes nothing is merged into the
one before.

Every capture is judged as of its fetch day: the patterns that can cover its URL (the host, its
parent domains down to two labels, and the host with each leading directory of the path) are
looked up among the intervals, and the most specific pattern that is active decides; with none
active the capture is allowed.

Intervals are cut at multiples of ``bucket_days`` and joined on pattern and bucket, so a capture
meets at most ``bucket_days`` intervals of a pattern, and a host that has a third of all captures
is spread over the buckets; the intervals of one pattern number at most one per day.

Defined cases: a null or unparsable URL has a null host and is allowed, as is a capture without a
fetch day; URLs and patterns are compared in lower case; a null pattern or day makes an entry
void; repeated entries are one, repeated captures are judged alike; empty captures give no rows,
an empty list allows all; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOREVER = 2_000_000  # a day number far beyond any date


def host_of(url: Column) -> Column:
    """The lower-case host, without user, port and closing dot; null if there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([a-z0-9._-]*[a-z0-9_-])", 1)
    return F.nullif(found, F.lit(""))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def patterns_of(host: Column, path: Column, directories: int) -> Column:
    """All patterns that cover host and path, as an array: domains and host/dir/ prefixes.

    Path prefixes go down to so many leading directories, as many as the deepest entry has.
    """
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.when(n >= 2, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.array_join(F.slice(labels, i, n), "."))) \
        .otherwise(F.array(host))
    if directories < 1:
        return F.array_distinct(domains)
    dirs = F.slice(F.split(path, "/"), 2, directories)  # the last part of a path is no directory
    prefixes = F.transform(F.sequence(F.lit(1), F.lit(directories)), lambda i: F.when(
        F.size(F.split(path, "/")) - 2 >= i, F.concat(host, F.lit("/"), F.array_join(F.slice(dirs, F.lit(1), i), "/"), F.lit("/"))))
    return F.array_distinct(F.concat(domains, F.filter(prefixes, lambda p: p.isNotNull())))


def day_number(day: Column) -> Column:
    return F.unix_date(day.cast("date"))


def intervals(entries: DataFrame, pattern: str = "pattern", action: str = "action", category: str = "category",
              day: str = "day", seq: str = "seq") -> DataFrame:
    """(pattern, action, category, first_day, end_day) of every stretch in which a pattern is listed."""
    rows = entries.select(F.lower(F.col(pattern)).alias("pattern"), F.col(action).alias("action"), F.col(category).alias("category"),
                          day_number(F.col(day)).alias("first_day"), F.col(seq).cast("long").alias("seq")) \
        .filter("pattern IS NOT NULL AND first_day IS NOT NULL AND action IS NOT NULL")
    last = (rows.groupBy("pattern", "first_day").agg(F.max(F.struct("seq", "action", "category")).alias("e"))
            .select("pattern", "first_day", "e.action", "e.category"))
    by_day = Window.partitionBy("pattern").orderBy("first_day")
    state = F.struct("action", "category")
    changed = last.withColumn("same", F.coalesce(state.eqNullSafe(F.lag(state).over(by_day)) & (F.row_number().over(by_day) > 1), F.lit(False))) \
        .filter(~F.col("same"))
    return (changed.withColumn("end_day", F.coalesce(F.lead("first_day").over(by_day), F.lit(FOREVER)))
            .filter("action <> 'remove'").select("pattern", "action", "category", "first_day", "end_day"))


def judge(captures: DataFrame, entries: DataFrame, id_col: str, url_col: str, day_col: str, bucket_days: int = 32,
          horizon: tuple[str, str] = ("1990-01-01", "2100-01-01"), **names) -> DataFrame:
    """(id, host, fetch_day, action, pattern, category, listed_since) per capture.

    Fetch days outside the horizon are compared as its ends; entries still in force reach to its end.
    """
    lo, hi = (F.unix_date(F.lit(d).cast("date")) for d in horizon)
    day = F.when(F.col(day_col).isNotNull(), F.least(F.greatest(day_number(F.col(day_col)), lo), hi))
    found = captures.select(
        F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), F.lower(path_of(F.col(url_col))).alias("path"), day.alias("fetch_day"))
    listed = F.split(F.lower(F.col(names.get("pattern", "pattern"))), "/")
    deepest = entries.agg(F.max(F.size(listed) - 2)).first()[0] or 0
    asked = (found.filter("host IS NOT NULL AND fetch_day IS NOT NULL").select("host", "path", "fetch_day").distinct()
             .select("*", F.explode(patterns_of(F.col("host"), F.col("path"), deepest)).alias("pattern"))
             .withColumn("bucket", F.floor(F.col("fetch_day") / bucket_days)))
    valid = intervals(entries, **names)
    first, end = F.greatest("first_day", lo), F.least("end_day", hi + 1)
    # open intervals are cut only as far as there are captures (two numbers)
    least, most = asked.agg(F.min("bucket"), F.max("bucket")).first()
    spread = (valid.withColumn("from", F.greatest(F.floor(first / bucket_days), F.lit(least if least is not None else 0)))
              .withColumn("to", F.least(F.floor((end - 1) / bucket_days), F.lit(most if most is not None else -1)))
              .filter((first < end) & (F.col("from") <= F.col("to")))
              .withColumn("bucket", F.explode(F.sequence("from", "to"))).drop("from", "to"))
    active = asked.join(spread, ["pattern", "bucket"]).filter("first_day <= fetch_day AND fetch_day < end_day")
    best = (active.groupBy("host", "path", "fetch_day")
            .agg(F.max(F.struct(F.length("pattern").alias("n"), "pattern", "action", "category", "first_day")).alias("b"))
            .select("host", "path", "fetch_day", "b.pattern", "b.action", "b.category", F.date_from_unix_date("b.first_day").alias("listed_since")))
    return (found.join(best, ["host", "path", "fetch_day"], "left")
            .select(F.col("id").alias(id_col), "host", F.date_from_unix_date("fetch_day").alias("fetch_day"),
                    F.coalesce("action", F.lit("allow")).alias("action"), "pattern", "category", "listed_since"))
