"""URL filters by a temporal list join.

List entries carry a date. Per pattern the entries of one day come down to the last one, and each day's
entry is valid until the next: a validity interval. A capture asks for all patterns that could cover its
URL (its host, the parent domains, and the host with leading parts of the path), as of the day it was
fetched; of the active entries the longest pattern decides. Intervals are cut by month, so that a pattern
with a long history is looked up in one month only, and a busy host is spread by the join over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.llm.shared import upto

BLOCK, ALLOW, REMOVE = "block", "allow", "remove"


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def path_of(url: Column) -> Column:
    """The path of a URL without the first slash, query and fragment."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^?#]*)", 1)


def patterns_of(url: Column) -> Column:
    """Every pattern that covers the URL: domains of two labels and more, and host/part, host/part/part, ..."""
    labels, parts = F.split(host_of(url), r"\."), F.array_remove(F.split(path_of(url), "/"), "")
    domains = F.transform(upto(1, F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.transform(upto(1, F.size(parts)), lambda i: F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")))
    return F.when(host_of(url) != "", F.array_distinct(F.concat(domains, paths))).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """``pattern``, ``action``, ``since``, ``until`` (exclusive, null if open) from dated entries.

    ``entries`` has ``pattern``, ``action``, ``listed_on`` and ``entry_id``; of several entries of one pattern and
    day the largest id counts. ``remove`` ends what was valid before and is no interval of its own. Rows
    with a null pattern, date or action are left out.
    """
    rows = entries.where("pattern is not null and listed_on is not null and action is not null")
    daily = rows.groupBy("pattern", "listed_on").agg(F.max(F.struct("entry_id", "action")).alias("last"))
    # One row per pattern and day: however many entries a pattern has, its window is as long as the calendar.
    follow = F.lead("listed_on").over(Window.partitionBy("pattern").orderBy("listed_on"))
    spans = daily.select("pattern", F.col("last.action").alias("action"), F.col("listed_on").alias("since"), follow.alias("until"))
    return spans.where(F.col("action") != REMOVE)


def filter_urls(captures: DataFrame, entries: DataFrame, id_column: str = "page_id", url_column: str = "url", day_column: str = "fetched_on") -> DataFrame:
    """One row per capture: id, day, ``verdict`` (block, allow or none), deciding ``pattern`` and ``since``.

    A null or unreadable URL and a null day meet no entry: verdict none. Repeated captures give repeated
    rows if their ids differ; captures that share id, URL and day are one. Other columns are not looked at.
    """
    rows = captures.select(captures[id_column].alias("id"), captures[url_column].alias("url"), captures[day_column].alias("day")).distinct()
    last = rows.agg(F.max("day").alias("day")).first()["day"]
    month = lambda day: (F.year(day) * 12 + F.month(day) - 1).cast("int")
    spans = intervals(entries).where(F.col("since") <= F.lit(last).cast("date"))
    ends = F.least(F.coalesce(F.date_sub("until", 1), F.lit(last).cast("date")), F.lit(last).cast("date"))
    spans = spans.select("pattern", "action", "since", "until", F.explode(F.sequence(month(F.col("since")), month(ends))).alias("month"))
    asked = rows.select("id", "url", "day", F.explode_outer(patterns_of(F.col("url"))).alias("pattern")).withColumn("month", month(F.col("day")))
    met = asked.join(spans, ["pattern", "month"], "left")
    active = (F.col("since") <= F.col("day")) & (F.col("until").isNull() | (F.col("day") < F.col("until")))
    choice = F.max(F.when(active, F.struct(F.length("pattern").alias("size"), "pattern", "action", "since"))).alias("best")
    best = met.groupBy("id", "url", "day").agg(choice)
    return best.select(
        F.col("id").alias(id_column),
        F.col("day").alias(day_column),
        F.coalesce("best.action", F.lit("none")).alias("verdict"),
        F.col("best.pattern").alias("pattern"),
        F.col("best.since").alias("since"),
    )
