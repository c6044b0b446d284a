"""Categories of companies: keyword rule, dictionary cascade, shortlist and lanes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import normalize_keyword, word_set
from tidemark.sources.shared import materialize

FEW = 200_000


def _few(taxonomy: DataFrame) -> DataFrame:
    """A taxonomy's rows, written; broadcast where they are counted to be few, else they meet the others by a shuffle."""
    kept = materialize(taxonomy)
    return F.broadcast(kept) if kept.count() <= FEW else kept


def keyword_rule(company_keywords: DataFrame, taxonomy_keywords: DataFrame) -> DataFrame:
    """(company_id, category, score): the category that shares the most keywords; null where two share as many.

    Inputs are (company_id, keyword) and (category, keyword); equal keywords count once for a company."""
    c = company_keywords.select("company_id", normalize_keyword(F.col("keyword")).alias("keyword")).distinct()
    t = _few(taxonomy_keywords.select("category", normalize_keyword(F.col("keyword")).alias("keyword")).distinct())
    scores = c.join(t, "keyword").groupBy("company_id", "category").agg(F.count("*").alias("score"))
    ends = scores.groupBy("company_id").agg(F.max(F.struct("score", "category")).alias("last"), F.min(F.struct(-F.col("score"), "category")).alias("first"))
    alone = F.col("first.category").eqNullSafe(F.col("last.category"))
    return ends.select("company_id", F.when(alone, F.col("last.category")).alias("category"), F.col("last.score").alias("score"))


def dictionary_cascade(companies: DataFrame, entries: DataFrame, sections: list[tuple[str, str]]) -> DataFrame:
    """Companies with category, hint and the section that decided.

    ``sections`` names, in order, a section of the dictionary and the column of tags (or of one tag) looked up in it; the first tag
    that is there decides, even if its category is null (hint is then true). entries is (section, key, category) and maybe ord: of keys that are equal
    when normalised the last by ord stands. All sections are looked up in one join."""
    kinds = dict(companies.dtypes)
    tags = lambda c: F.col(c) if kinds[c].startswith("array") else F.array(c)
    asked = F.array(*(F.struct(F.lit(i).alias("rank"), F.lit(n).alias("section"), tags(c).alias("tags")) for i, (n, c) in enumerate(sections)))
    asked = companies.select("id", F.explode(asked).alias("a")).select("id", "a.rank", "a.section", F.posexplode("a.tags").alias("pos", "tag"))
    asked = asked.select("id", "rank", "section", "pos", normalize_keyword(F.col("tag")).alias("key"))
    category = F.max_by("category", "ord") if "ord" in entries.columns else F.max("category")
    known = entries.groupBy("section", normalize_keyword(F.col("key")).alias("key")).agg(category.alias("category"))
    first = asked.join(known, ["section", "key"]).groupBy("id").agg(F.min_by(F.struct("category", "section"), F.struct("rank", "pos")).alias("hit"))
    out = companies.join(first, "id", "left")
    return out.withColumns({"category": F.col("hit.category"), "hint": F.col("hit").isNotNull(), "section": F.col("hit.section")}).drop("hit")


def taxonomy_cascade(companies: DataFrame, entries: DataFrame, sections: list[tuple[str, str, str]], company_keywords: DataFrame, taxonomy_keywords: DataFrame) -> DataFrame:
    """(id, category, confidence, resolver, hint) by the dictionary's sections (name, column, confidence) in turn, then by the keyword rule.

    A section that has a tag decides: with no category behind it there is none, and ``hint`` is true. Only companies that no section knows
    take their keywords to the rule; where two categories share as many, nothing resolves."""
    found = dictionary_cascade(companies, entries, [(n, c) for n, c, _ in sections]).select("id", "category", "hint", "section")
    trust = F.element_at(F.create_map(*(F.lit(x) for n, _, t in sections for x in (n, t))), F.col("section"))
    known = F.col("category").isNotNull()
    decided = found.where("hint").select("id", "category", F.when(known, trust).alias("confidence"), F.col("section").alias("resolver"), (~known).alias("hint"))
    open_ids = found.where("NOT hint").select("id")
    rule = keyword_rule(company_keywords.join(open_ids, F.col("company_id") == F.col("id"), "left_semi"), taxonomy_keywords)
    rest = open_ids.join(rule.select(F.col("company_id").alias("id"), "category"), "id", "left")
    high, by_rule = F.when(known, "high"), F.when(known, "rule")
    return decided.unionByName(rest.select("id", "category", high.alias("confidence"), by_rule.alias("resolver"), F.lit(False).alias("hint")))


def shortlist(companies: DataFrame, categories: DataFrame, category_tokens: DataFrame, most: int = 10) -> DataFrame:
    """The categories whose keyword tokens a company's text has most often, in taxonomy order among equals; all of
    them for a company that shares none (that is the feature; such companies have no text to speak of). Companies
    meet it on tokens, so pairs without a common token are never made, except for companies without any.
    Inputs are (id, text), (category, ord) and (category, token), a row for each time that a category's keywords have a token."""
    tokens = companies.select("id", F.explode(word_set(F.col("text"))).alias("token"))
    weights = _few(category_tokens.groupBy("category", "token").agg(F.count("*").alias("w")))
    scored = tokens.join(weights, "token").groupBy("id", "category").agg(F.sum("w").alias("score")).join(_few(categories), "category")
    rank = Window.partitionBy("id").orderBy(F.desc("score"), "ord")
    some = scored.withColumn("rn", F.row_number().over(rank)).where(F.col("rn") <= most).select("id", "category", "ord", "score", "rn")
    known = tokens.join(weights.select("token"), "token", "left_semi").select("id").distinct()
    every = companies.select("id").join(known, "id", "left_anti").crossJoin(categories.select("category", "ord")).select(
        "id", "category", "ord", F.lit(0).cast("long").alias("score"), (F.col("ord") + 1).cast("int").alias("rn")
    )
    return some.unionByName(every)


def lane(companies: DataFrame) -> DataFrame:
    """fast where the dictionary decided, medium with an id and a long description, else cold."""
    long_text = F.length(F.coalesce("description", F.lit(""))) >= 80
    return companies.withColumn(
        "resolver", F.when(F.col("hint"), "wrds_fast").when(F.col("source_id").isNotNull() & long_text, "wrds_medium").otherwise("cold")
    )
