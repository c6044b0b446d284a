"""URL filters whose lists change over time.

A list is a log of dated entries: on a day an entry is added to a list or removed from it. The log
becomes validity intervals [from_day, until_day), and an as-of join finds for every capture the
entries that were in force on the day it was fetched.

An entry is a host (``ads.example.com``), which also holds for all hosts below it, or a host with a
path (``example.com/ads``), which holds for that path and all paths below it. A capture is looked up
under its host's suffixes and its host with its first path segments, of all depths that the log's
entries have; so the join is an equi-join on the key plus the day, and no entry is too deep for it.

Hot hosts: captures are dealt over ``salts`` parts of their key and the intervals, which are far fewer,
are repeated for each part. The log is reduced to one event per list, entry and day before the
window over an entry, so an entry's group has one row a day at most.

Only DataFrame functions are used.

Defined results: in urls and in entries scheme and ``www.`` don't matter, the host is lower case, port, user and
fragment are left out, as are repeated and last slashes of a path; a url's query is left out, and an entry with
a query, which names less than a path, is ignored; a url that is null or has no host has host null and is not blocked; a null day of fetching matches
nothing; entries, lists, actions or days that are null, and actions other than add and remove, are ignored; if
an entry is added and removed on one day, it is removed; adding what is in force, or removing what
isn't, changes nothing; repeated captures are answered each; extra columns are ignored; an empty log
blocks nothing, an empty table of captures gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/*([^?#]*)", 1)


def segments_of(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def normal_entry(entry: Column) -> Column:
    """An entry as urls are read; null without a host or with a query."""
    text = F.trim(entry)
    url = F.when(text.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), text).otherwise(F.concat(F.lit("http://"), F.regexp_replace(text, "^//", "")))
    whole = F.array_join(F.concat(F.array(host_of(url)), segments_of(path_of(url))), "/")
    return F.when(host_of(url).isNotNull() & ~F.contains(F.substring_index(url, "#", 1), F.lit("?")), whole)


def depths_of(entries: DataFrame) -> DataFrame:
    """One row: the numbers of labels that the hosts among the entries have, and those of segments of the paths."""
    parts = F.split("entry", "/")
    return entries.agg(
        F.collect_set(F.when(F.size(parts) == 1, F.size(F.split("entry", r"\.")))).alias("label_depths"),
        F.collect_set(F.when(F.size(parts) > 1, F.size(parts) - 1)).alias("segment_depths"),
    )


def keys_of(host: Column, path: Column, label_depths: Column, segment_depths: Column) -> Column:
    """All entries of these depths that could hold for a capture, each once."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.filter(label_depths, lambda n: n <= F.size(labels)),
        lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."),
    )
    segments = segments_of(path)
    prefixes = F.transform(
        F.filter(segment_depths, lambda n: n <= F.size(segments)),
        lambda n: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), n), "/")),
    )
    return F.array_distinct(F.concat(suffixes, prefixes))


def intervals(log: DataFrame) -> DataFrame:
    """(list, entry, from_day, until_day) of the log (list, entry, action, day); until_day is null while in force."""
    known = log.withColumn("entry", normal_entry(F.col("entry"))).where(
        F.col("list").isNotNull() & F.col("entry").isNotNull() & F.col("day").isNotNull() & F.col("action").isin("add", "remove")
    )
    days = known.groupBy("list", "entry", "day").agg(F.bool_and(F.col("action") == "add").alias("on"))
    order = Window.partitionBy("list", "entry").orderBy("day")
    changed = days.withColumn("before", F.coalesce(F.lag("on").over(order), F.lit(False))).where(F.col("on") != F.col("before"))
    return (
        changed.withColumn("until_day", F.lead("day").over(order))
        .where("on")
        .select("list", "entry", F.col("day").alias("from_day"), "until_day")
    )


def evaluate(captures: DataFrame, log: DataFrame, *, id_col: str = "page_id", salts: int = 16) -> DataFrame:
    """One row per capture (id, url, fetched_on): host, blocked, n_entries, lists (comma separated, by name)."""
    same = [F.col(id_col).alias("id"), "url", "fetched_on"]
    once = captures.select(*same).groupBy("id", "url", "fetched_on").agg(F.count("*").alias("times"))
    host = host_of(F.col("url"))
    asked = once.withColumn("host", host)
    salt = F.pmod(F.xxhash64("id", "url", "fetched_on"), F.lit(salts)).cast("int")
    in_force = intervals(log)
    keys = keys_of(F.col("host"), path_of(F.col("url")), F.col("label_depths"), F.col("segment_depths"))
    # the depths are one row
    probes = asked.where("host is not null and fetched_on is not null").crossJoin(F.broadcast(depths_of(in_force))).select(
        "id", "url", "fetched_on", salt.alias("salt"), F.explode(keys).alias("entry")
    )
    spread = in_force.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    held = (F.col("fetched_on") >= F.col("from_day")) & (F.col("until_day").isNull() | (F.col("fetched_on") < F.col("until_day")))
    hits = (
        probes.join(spread, ["entry", "salt"])
        .where(held)
        .groupBy("id", "url", "fetched_on")
        .agg(F.count("*").alias("n_entries"), F.array_join(F.sort_array(F.collect_set("list")), ",").alias("lists"))
        .select(F.col("id").alias("h_id"), F.col("url").alias("h_url"), F.col("fetched_on").alias("h_on"), "n_entries", "lists")
    )
    meet = F.col("id").eqNullSafe(F.col("h_id")) & (F.col("url") == F.col("h_url")) & (F.col("fetched_on") == F.col("h_on"))
    return (
        asked.join(hits, meet, "left")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
        .select(
            F.col("id").alias(id_col),
            "url",
            "fetched_on",
            "host",
            F.col("n_entries").isNotNull().alias("blocked"),
            F.coalesce("n_entries", F.lit(0)).alias("n_entries"),
            F.coalesce("lists", F.lit("")).alias("lists"),
        )
    )


def _number(text: Column, size: int) -> Column:
    return (F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("int") % size).cast("int")


FIRST_DAY = "2024-01-01"


def dated_captures(pages: DataFrame) -> DataFrame:
    """The crawl of the pages: each was fetched on a day of a year that follows from its id."""
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), _number(F.col("page_id").cast("string"), 366))
    return pages.select("page_id", "url", day.alias("fetched_on"))


def dated_lists(pages: DataFrame) -> DataFrame:
    """A log made of the sites that the pages link: sites by what their name says, and one site in six, come
    on a list, most go again and some come back; of one site in five the French part comes on a list of parts."""
    sites = pages.select(host_of(F.col("url")).alias("host")).where("host is not null").distinct()
    site = F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1)
    named = sites.select(F.nullif(site, F.lit("")).alias("site")).where("site is not null").distinct()
    listed = named.select(
        "site",
        F.array_compact(
            F.array(
                F.when(F.col("site").rlike("ads|track"), F.struct(F.lit("ads").alias("list"), F.col("site").alias("entry"))),
                F.when(F.col("site").contains("spam"), F.struct(F.lit("spam").alias("list"), F.col("site").alias("entry"))),
                F.when(F.col("site").contains("adult"), F.struct(F.lit("adult").alias("list"), F.col("site").alias("entry"))),
                F.when(_number(F.concat(F.lit("r"), "site"), 6) == 0, F.struct(F.lit("reported").alias("list"), F.col("site").alias("entry"))),
                F.when(
                    _number(F.concat(F.lit("p"), "site"), 5) == 0,
                    F.struct(F.lit("parts").alias("list"), F.concat("site", F.lit("/fr")).alias("entry")),
                ),
            )
        ).alias("found"),
    ).select(F.explode("found").alias("f")).select("f.list", "f.entry")
    start = _number(F.concat("list", "entry"), 200)
    event = lambda action, after: F.struct(
        F.lit(action).alias("action"), F.date_add(F.lit(FIRST_DAY).cast("date"), start + after).alias("day")
    )
    back = _number(F.concat(F.lit("b"), "entry"), 3) == 0
    events = F.array_compact(F.array(event("add", 0), event("remove", 70), F.when(back, event("add", 110))))
    return listed.select("list", "entry", F.explode(events).alias("e")).select("list", "entry", "e.action", "e.day")
