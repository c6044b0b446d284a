"""Keyed upserts of listings and companies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.lifecycle import blank, instant

FILLED = ("title", "location", "employment_type", "description")


def earliest_per_url(jobs: DataFrame, url: str = "url", order: str = "ord") -> DataFrame:
    """Per address the row seen first (a missing date counts as 2000-01-01), the first in order among equals;
    rows without an address stay."""
    seen = instant(F.coalesce("first_seen_at", "last_seen_at"))
    first = Window.partitionBy(url).orderBy(seen, order)
    with_url = jobs.where(~blank(F.col(url))).withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")
    return with_url.unionByName(jobs.where(blank(F.col(url))))


def merge_jobs(existing: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """Existing and new listings as one, by address and hash of the description; new ones were all seen ``now``.

    A new row of a known (address, hash) touches that listing: seen now, not removed, blank fields filled. One of a known address
    with another hash touches the listing seen first at that address, unless that was first seen after now: then the new
    listing takes its place. Others are added. Of an address only the listing seen first stays; listings without an
    address are told apart by their hash. Both inputs need ``ord``; of existing rows of one key the last counts, at the
    place of the first. Two aggregations do it, so no address or hash is too frequent."""
    fields = [c for c in FILLED if c in existing.columns]
    url, name = F.coalesce("url", F.lit("")), F.coalesce("description_hash", F.lit(""))
    rows = existing.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True))).withColumns({"_url": url, "_hash": name})
    row, old, fresh = F.struct(*existing.columns), ~F.col("_new"), F.col("_new")
    # one row a key
    one = lambda test: F.when(test, F.col("ord"))
    filled = {c: F.min_by(F.nullif(F.col(c), F.lit("")), F.when(fresh & ~blank(F.col(c)), F.col("ord"))) for c in fields}
    keys = rows.groupBy("_url", "_hash").agg(
        F.max_by(row, one(old)).alias("kept"), F.min(one(old)).alias("place"), F.min_by(row, one(fresh)).alias("came"), F.min(one(fresh)).alias("first_new"),
        *(v.alias(f"_f_{c}") for c, v in filled.items()),
    )
    known = F.col("place").isNotNull()
    r = F.when(known, F.col("kept")).otherwise(F.col("came"))
    values = {c: r[c] for c in existing.columns} | {c: F.coalesce(F.nullif(r[c], F.lit("")), F.col(f"_f_{c}")) for c in fields}
    keys = keys.select(
        "_url", "_hash", F.struct(*(v.alias(c) for c, v in values.items())).alias("r"), known.alias("known"), F.col("first_new").isNotNull().alias("hit"),
        F.coalesce("place", "first_new").alias("place"), "first_new", instant(F.coalesce(r["first_seen_at"], r["last_seen_at"])).alias("t"),
    )
    # one row an address; without one, a key is its own
    other = ~F.col("known")
    group = F.when(F.col("_url") == "", F.concat(F.lit("h|"), F.col("_hash"))).otherwise(F.concat(F.lit("u|"), F.col("_url")))
    groups = keys.groupBy(group.alias("_group")).agg(
        F.min_by(F.struct("r", "hit", "t"), F.when(F.col("known"), F.struct("t", "place"))).alias("e"), F.min_by("r", F.when(other, F.col("first_new"))).alias("n"), F.count_if(other).alias("others")
    )
    takes = (F.col("others") > 0) & (F.col("e").isNull() | F.coalesce(instant(now) < F.col("e.t"), F.lit(False)))
    touched = takes | F.coalesce(F.col("e.hit"), F.lit(False)) | (F.col("others") > 0)
    out = groups.select(F.when(takes, F.col("n")).otherwise(F.col("e.r")).alias("r"), touched.alias("touched")).select("r.*", "touched")
    return out.withColumns(
        {"last_seen_at": F.when(F.col("touched"), now).otherwise(F.coalesce("last_seen_at", now)), "removed_at": F.when(~F.col("touched"), F.col("removed_at")), "first_seen_at": F.coalesce("first_seen_at", now)}
    ).select(*existing.columns)


def merge_companies(
    existing: DataFrame, incoming: DataFrame, *, keep_existing: list[str], take_incoming: list[str], signals: str | None = None, order: str = "ord"
) -> DataFrame:
    """Companies matched by domain, whatever its case, else by id; unmatched incoming ones are added.

    Incoming rows come in ``order``, and several may meet one company. ``keep_existing`` columns keep a value that is there, else
    take the first one that came; ``take_incoming`` columns take the last value that came. ``signals`` is an array of structs
    (date, deal_type, ...): new ones are appended, one for each date and deal type. Incoming rows that meet no company are one
    if they have one domain, or one id where they have none. A domain of several existing companies means the last by id."""
    low = lambda c: F.nullif(F.lower(c), F.lit(""))
    by_domain = existing.where(low(F.col("domain")).isNotNull()).groupBy(low(F.col("domain")).alias("_domain")).agg(F.max("id").alias("_by_domain"))
    by_id = existing.select(F.col("id").alias("_by_id"))
    met = incoming.join(by_domain, low(F.col("domain")) == F.col("_domain"), "left").join(by_id, F.col("id") == F.col("_by_id"), "left")
    target = F.coalesce("_by_domain", "_by_id")
    group = F.when(target.isNull(), F.coalesce(F.concat(F.lit("d|"), low(F.col("domain"))), F.concat(F.lit("i|"), F.col("id").cast("string"))))
    first = lambda c: F.min_by(F.col(c), F.when(~blank(F.col(c)), F.col(order))).alias(f"i_{c}")
    last = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"i_{c}")
    more = [F.sort_array(F.collect_list(F.when(F.col(signals).isNotNull(), F.struct(F.col(order).alias("o"), F.col(signals).alias("s"))))).alias("i_signals")] if signals else []
    came = met.groupBy(target.alias("_target"), group.alias("_group")).agg(
        F.min_by("id", order).alias("i_id"), first("domain"), *map(first, keep_existing), *map(last, take_incoming), *more
    )
    both = existing.join(came.where("_target is not null"), F.col("id") == F.col("_target"), "left")
    added = came.where("_target is null")

    def joined(old: Column | None) -> Column:
        """Signals in order, the first of each (date, deal type)."""
        new = F.flatten(F.transform(F.coalesce("i_signals", F.array()), lambda x: x["s"]))
        every = F.concat(F.coalesce(old, F.array().cast(incoming.schema[signals].dataType)), new) if old is not None else new
        same = lambda a, b: a["date"].eqNullSafe(b["date"]) & a["deal_type"].eqNullSafe(b["deal_type"])
        return F.filter(every, lambda x, i: ~F.exists(F.slice(every, F.lit(1), i), lambda y: same(x, y)))

    old = lambda c: F.when(~blank(F.col(c)), F.col(c))
    settled = both.select(
        "id", F.coalesce(old("domain"), F.col("i_domain")).alias("domain"), *(F.coalesce(old(c), F.col(f"i_{c}")).alias(c) for c in keep_existing),
        *(F.coalesce(f"i_{c}", c).alias(c) for c in take_incoming), *([joined(F.col(signals)).alias(signals)] if signals else []),
        F.when(F.col("_target").isNull(), "kept").otherwise("updated").alias("action"),
    )
    names = ["id", "domain", *keep_existing, *take_incoming]
    return settled.unionByName(
        added.select(*(F.col(f"i_{c}").alias(c) for c in names), *([joined(None).alias(signals)] if signals else []), F.lit("added").alias("action"))
    )


def fullest(rows: DataFrame, key: list[str], fields: list[str], order: str = "ord") -> DataFrame:
    """Per key the row with the most filled fields, the first among equals."""
    filled = sum(F.col(c).isNotNull().cast("int") for c in fields)
    w = Window.partitionBy(*key).orderBy(F.desc(filled), order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
