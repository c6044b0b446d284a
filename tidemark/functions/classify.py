"""Ordered rules over titles, texts and messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import squeeze

# Abbreviations in titles, and the rules by which titles are classed; the first that matches wins.
ABBREVIATIONS = (("Sr", "Senior"), ("Jr", "Junior"), ("Eng", "Engineer"), ("Mgr", "Manager"), ("Dir", "Director"), ("Assoc", "Associate"))
FUNCTIONS = (
    ("strategy", r"chief of staff|strategy\s*&?\s*ops|corporate strategy"),
    ("product", r"product manager|technical product"),
    ("finance", r"fp&a|financial planning|controller|treasurer|corporate accounting|finance manager|cfo"),
    ("legal", r"general counsel|legal counsel|attorney|compliance officer"),
    ("data_science", r"data scientist|data analyst|analytics engineer|ml engineer"),
    ("policy", r"policy|government affairs|regulatory affairs|public affairs"),
    ("marketing", r"marketing|brand|content|communications|pr|public relations|growth"),
    ("sales", r"business development|bd|partnerships|sales ops|account executive|account manager|account rep"),
    ("supply_chain", r"procurement|logistics|materials|supply chain|planning"),
    ("operations", r"program manager|project manager|operations manager|ops manager"),
    ("hr", r"people operations|recruiter|talent|hrbp|hr business|human resources"),
    ("customer_success", r"customer success|customer support|renewals|implementation specialist"),
    ("design", r"product designer|ux|ui designer|visual designer|graphic designer"),
    ("engineering", r"engineer|developer|architect|swe|sde|devops|sre|platform"),
)
SENIORITIES = (
    ("intern", r"intern|internship"),
    ("c_suite", r"ceo|cto|coo|cfo|cpo|chief\s+\w+\s+officer"),
    ("vp", r"vp|vice president"),
    ("director", r"director|head of"),
    ("staff", r"staff|principal"),
    ("senior", r"senior|sr|lead"),
    ("entry", r"junior|jr|associate|entry"),
)
LED_MANAGERS = "people|engineering|product|program|project|general|senior"
EMPLOYMENTS = (("intern", "intern|internship"), ("contract", "contract|contractor|consultant"), ("part_time", "part[- ]time"))
# Functions and levels of high and low relevance.
HIGH = (("strategy", "finance", "product", "legal", "policy"), ("mid", "senior", "staff", "director", "vp", "c_suite"))
LOW = (("engineering", "hr", "customer_success"), ("intern", "entry"))
# What listings that are only examples say.
PLACEHOLDER_TITLES = ("example", "test job", "sample job")
PLACEHOLDER_TEXTS = ("this is a sample description", "truncate it at 500 characters")
# What failure messages say, by class.
FAILURES = (
    ("rate_limit", ("rate limit", "too many requests"), (429,)),
    ("auth", ("unauthorized", "forbidden", "api key"), (401, 403)),
    ("timeout", ("aborterror", "timeout", "timed out"), ()),
    ("transient_network", ("econnreset", "enotfound", "getaddrinfo", "dns", "network error", "socket hang up", "etimedout", "eai_again"), ()),
    ("config", ("prompt unavailable", "missing prompt", "config unavailable", "api key not configured"), ()),
)
PROVIDERS = ("googlegenerativeai", "generativelanguage.googleapis.com", "anthropic", "gemini", "claude")
TRANSIENT = ("transient_network", "rate_limit", "timeout")


def has_word(c: Column, words: str) -> Column:
    """One of the alternatives stands in the text as whole ASCII words."""
    return F.lower(c).rlike(rf"(?<![A-Za-z0-9_])(?:{words})(?![A-Za-z0-9_])")


def _cascade(c: Column, rules) -> Column:
    return reduce(lambda out, rule: out.when(has_word(c, rule[1]), rule[0]), rules, F)


def job_function(title: Column) -> Column:
    return _cascade(title, FUNCTIONS).otherwise(F.lit(None))


def seniority(title: Column) -> Column:
    plain = has_word(title, "manager") & ~has_word(title, rf"(?:{LED_MANAGERS})\s+manager")
    return _cascade(title, SENIORITIES).when(plain, "mid").otherwise("unknown")


def employment(title: Column, description: Column) -> Column:
    both = F.concat_ws(" ", title, description)
    return _cascade(both, EMPLOYMENTS).otherwise("full_time")


def location_kind(location: Column) -> Column:
    text = F.coalesce(location, F.lit(""))
    return (
        F.when(has_word(text, "remote"), "remote").when(has_word(text, "hybrid"), "hybrid").when(F.trim(text) != "", "on_site").otherwise("unknown")
    )


def relevance(function: Column, level: Column) -> Column:
    return (
        F.when(function.isNull() | level.isNull() | (level == "unknown"), F.lit(None))
        .when(function.isin(*HIGH[0]) & level.isin(*HIGH[1]), "high")
        .when(level == "intern", "low")
        .when(function.isin(*LOW[0]) & level.isin(*LOW[1]), "low")
        .otherwise("medium")
    )


def normal_title(title: Column) -> Column:
    """Abbreviations spelt out, a level at the end dropped."""
    out = squeeze(F.coalesce(title, F.lit("")))
    for short, long in ABBREVIATIONS:
        out = F.regexp_replace(out, rf"(?i)(?<![A-Za-z0-9_]){short}\.?(?=\s|\z)", long)
    return squeeze(F.regexp_replace(out, r"(?i) (I{1,3}|IV|VI{0,3}|IX|[1-9])\z", ""))


def is_placeholder(title: Column, description: Column) -> Column:
    """A listing that only shows what one looks like."""
    t, d = F.lower(F.coalesce(title, F.lit(""))), F.lower(F.coalesce(description, F.lit("")))
    return reduce(lambda a, w: a | t.contains(w), PLACEHOLDER_TITLES, reduce(lambda a, w: a | d.contains(w), PLACEHOLDER_TEXTS, F.lit(False)))


def failure_class(stage: Column, status: Column, message: Column) -> Column:
    """Class of a failure by its status, then by what its message says."""
    m = F.lower(message)
    says = lambda *words: reduce(lambda a, w: a | m.contains(w), words, F.lit(False))
    out = F.when(message.isNull() & status.isNull(), F.lit(None))
    for name, words, codes in FAILURES:
        out = out.when(says(*words) | F.coalesce(status.isin(*codes) if codes else F.lit(False), F.lit(False)), name)
    bad = (m.contains("json") & says("parse", "unexpected")) | says("malformed html", "unparseable")
    provider = says(*PROVIDERS)
    billing = says("prepayment", "credit", "billing", "payment", "balance", "quota exceeded")
    denied = says("permission denied") | m.rlike(r"(http|status)\s*(401|403)")
    limited = (m.contains("rate") & m.contains("limit")) | m.contains("429")
    return (
        out.when(bad, "bad_data")
        .when(provider & billing, "unknown")
        .when(provider & denied, "auth")
        .when(provider & limited, "rate_limit")
        .when((stage == "extract") & m.contains("empty"), "bad_data")
        .otherwise("unknown")
    )


def needs_enrichment(*, force: Column, version: Column, current: str, stored_hash: Column, text_hash: Column, required: list[Column]) -> Column:
    """Whether a listing must be looked at again: asked for, of an old version, of another text, or without one of its fields."""
    missing = reduce(lambda a, c: a | c.isNull(), required, F.lit(False))
    return F.coalesce(force, F.lit(False)) | ~version.eqNullSafe(F.lit(current)) | ~stored_hash.eqNullSafe(text_hash) | missing
