"""Lifecycle rules of companies and listings as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
LATE_MS = 300_000
DORMANT_AFTER = 3

# The order of the stages, and those that go on without a result.
STAGES = ("wrds_ingest", "profile", "discovery", "fingerprint", "scrape", "extract", "enrich", "categorize", "done")
ADVANCES_WITHOUT_RESULT = ("discovery", "fingerprint", "profile")


def blank(c: Column) -> Column:
    return c.isNull() | (c.cast("string") == "")


def millis(c: Column) -> Column:
    return F.unix_millis(c.cast("timestamp"))


def instant(c: Column) -> Column:
    """Milliseconds of a date that may be missing; a missing one counts as 2000-01-01."""
    return F.coalesce(millis(c), F.lit(946_684_800_000))


def days_live(first: Column, last: Column) -> Column:
    """Whole days between two instants, never negative, 0 where one is missing."""
    return F.coalesce(F.greatest(F.lit(0), F.floor((millis(last) - millis(first)) / F.lit(DAY_MS))), F.lit(0)).cast("int")


def stage_of(ingest: bool = True) -> Column:
    """The stage that a company waits for, from its own columns."""
    c = F.col
    uncategorised = blank(c("category_attempted_at")) & blank(c("climate_tech_category"))
    last = F.when(uncategorised, "categorize").otherwise("done")
    out = F
    rules = [
        (F.lit(ingest) & blank(c("wrds_last_updated")) & blank(c("profile_attempted_at")), F.lit("wrds_ingest")),
        (blank(c("profile_attempted_at")), F.lit("profile")),
        (blank(c("careers_page_discovery_method")), F.lit("discovery")),
        (c("careers_page_reachable").eqNullSafe(F.lit(False)), last),
        (blank(c("fingerprint_attempted_at")), F.lit("fingerprint")),
        (blank(c("last_scraped_at")), F.lit("scrape")),
        (c("last_scrape_outcome").eqNullSafe(F.lit("skipped_signature_match")), last),
        (blank(c("last_extracted_at")), F.lit("extract")),
        (blank(c("last_enriched_at")), F.lit("enrich")),
    ]
    for test, value in rules:
        out = out.when(test, value)
    return out.otherwise(last)


def lane_of(profile_attempted_at: Column) -> Column:
    return F.when(blank(profile_attempted_at), "cold").otherwise("warm")


def next_stage(stage: Column) -> Column:
    """The stage after this one; the last stays, an unknown one has none."""
    at = F.array_position(F.array(*map(F.lit, STAGES)), stage)
    return F.when(at > 0, F.element_at(F.array(*map(F.lit, STAGES)), F.least(at + 1, F.lit(len(STAGES))).cast("int")))


def advances(stage: Column, outcome: Column) -> Column:
    """Whether a company goes on to the next stage after this outcome."""
    return (
        F.when(outcome.isin("success", "skipped"), True)
        .when(outcome == "no_result", stage.isin(*ADVANCES_WITHOUT_RESULT))
        .otherwise(False)
    )
