"""Runs, baselines and results against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GATE = 40


def bucket_deltas(before: DataFrame, after: DataFrame, key: str, value: str = "n") -> DataFrame:
    """Counts by bucket in two reports; a bucket that one hasn't counts 0 there, and without any earlier bucket
    the deltas are null."""
    known = before.agg((F.count("*") > 0).alias("known"))
    b = before.select(key, F.col(value).alias("before"))
    a = after.select(key, F.col(value).alias("after"))
    both = a.join(b, key, "full").crossJoin(F.broadcast(known))  # one row
    zero = lambda c: F.coalesce(c, F.lit(0))
    return both.select(key, zero("before").alias("before"), zero("after").alias("after"), F.when(F.col("known"), zero("after") - zero("before")).alias("delta"))


def ship_reasons(delta: Column, regressed: Column) -> Column:
    """Why an expansion isn't shipped; empty if it is."""
    return F.array_compact(F.array(F.when(delta < GATE, F.lit("below_gate")), F.when(regressed > 0, F.lit("regression"))))


def result_outcomes(asked: DataFrame, results: DataFrame, key: str = "id") -> DataFrame:
    """Batch results by id: missing_result where none came, malformed_result where it says nothing."""
    r = results.withColumn("_there", F.lit(True))
    outcome = (
        F.when(F.col("_there").isNull(), "missing_result").when(F.nullif(F.trim("category"), F.lit("")).isNull(), "malformed_result").otherwise("ok")
    )
    return asked.join(r, key, "left").withColumn("outcome", outcome).drop("_there")


def warm_decision(urls: DataFrame) -> DataFrame:
    """Per site of (site, url, before, after, same_hash): what a scrape changed. Nothing to do if no address is new and
    every one that stayed has the hash it had."""
    kept = F.col("before") & F.col("after")
    churn = F.coalesce(F.bool_or(kept & ~F.coalesce("same_hash", F.lit(False))), F.lit(False))
    new = F.count_if(~F.col("before") & F.col("after"))
    return urls.groupBy("site").agg(
        F.count_if(kept).alias("existing"), new.alias("net_new"), F.count_if(F.col("before") & ~F.col("after")).alias("removed"),
        churn.alias("churn"), ((new == 0) & ~churn).alias("no_delta"),
    )


def json_array_of(answer: Column) -> Column:
    """The outermost JSON array in a model's answer, without fences and trailing commas; null if there is none."""
    plain = F.regexp_replace(answer, r"```(?:json)?", "")
    cut = F.regexp_extract(plain, r"(?s)(\[.*\])", 1)
    return F.nullif(F.regexp_replace(cut, r",\s*([\]}])", "$1"), F.lit(""))


def backoff_ms(attempt: Column, base: int = 500) -> Column:
    """Nominal wait before an attempt: it doubles each time."""
    return (F.lit(base) * F.pow(F.lit(2), attempt - 1)).cast("long")


def touched(listings: DataFrame, seen: DataFrame, now: Column) -> DataFrame:
    """Listings (site, url, last_seen_at, removed_at) after a scrape that saw (site, url): what is there again was seen now and isn't
    removed, what is gone is removed now, addresses that are new have no listing yet."""
    s = seen.select("site", "url").distinct().withColumn("_seen", F.lit(True))
    both = listings.withColumn("_old", F.lit(True)).join(s, ["site", "url"], "full")
    again = F.coalesce("_seen", F.lit(False))
    action = F.when(F.col("_old").isNull(), "net_new").when(again, "existing").when(F.col("removed_at").isNull(), "removed").otherwise("gone")
    return both.select(
        "site", "url", action.alias("action"), F.when(again & F.col("_old"), now).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
        F.when(~again, F.coalesce("removed_at", now)).alias("removed_at"),
    )


def labellings(before: DataFrame, after: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(resolver, n, same, changed) of rows that two runs both labelled, by id: a blank label is none, and all fields must agree."""
    plain = lambda c: F.nullif(F.trim(c), F.lit(""))
    a = before.select("id", *(plain(F.col(c)).alias(f"a_{c}") for c in fields))
    b = after.select("id", F.coalesce(plain(F.col("resolver")), F.lit("unknown")).alias("resolver"), *(plain(F.col(c)).alias(f"b_{c}") for c in fields))
    same = F.lit(True)
    for c in fields:
        same &= F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    return a.join(b, "id").groupBy("resolver").agg(F.count("*").alias("n"), F.count_if(same).alias("same"), F.count_if(~same).alias("changed"))
