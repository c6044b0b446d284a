"""Tables read from documents: cells to rows, rows to companies, columns by alias."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import nested
from tidemark.functions.text import deterministic_id, slugify
from tidemark.functions.urls import domain_imported
from tidemark.sources.shared import materialize

TOLERANCE = 2.5

# Header patterns of a company's fields, in order of preference.
HEADERS = {
    "name": (r"^company name$", r"^name$", r"companies"),
    "domain": (r"^website$", r"^domain$", r"^url$"),
    "date": (r"^last financing date$", r"financing.d(ate)?", r"last.*date"),
    "deal_type": (r"^last financing deal type$", r"deal.type", r"financing.deal", r"last.*deal"),
    "size": (r"^last financing size$", r"financing.size", r"last.*size", r"round.size"),
    "total": (r"^total raised$", r"total.raised", r"cumulative"),
    "employees": (r"^employees?$", r"^headcount$", r"^num.*employee"),
    "sector": (r"^sector$", r"^industry$", r"primary.*pitchbook"),
    "hq": (r"^hq location$", r"^hq$", r"^location$", r"^headquarters$", r"hq.*"),
}


def group_rows(cells: DataFrame, tolerance: float = TOLERANCE, keys: tuple[str, ...] = ("page",)) -> DataFrame:
    """Cells (page, top, left, text) with the number of their row on the page; a page is what ``keys`` name.

    Cells go down the page; one that lies more than the tolerance under the first cell of the current row begins
    the next. The rule looks back at a row's first cell, which no window can, so a window only sorts the cells and numbers them, and they are
    walked as they stream by. (A window's rows aren't dealt anew where they lie together already.)"""
    kinds = {f.name: f.dataType.simpleString() for f in cells.schema}
    columns = [*keys, "top", "left", "text"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, row = 0.0, 0
        for batch in batches:
            rows = []
            for top, nth in zip(batch["top"].cast(pa.float64()).to_numpy(zero_copy_only=False).tolist(), batch["row"].to_pylist()):
                if nth == 1:
                    anchor, row = top, 1
                elif abs(top - anchor) > tolerance:
                    anchor, row = top, row + 1
                rows.append(row)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in columns), pa.array(rows, pa.int32())], [*columns, "row"])

    down = F.row_number().over(Window.partitionBy(*keys).orderBy("top", "left", "text"))
    return cells.select(*columns, down.alias("row")).mapInArrow(walk, ", ".join(f"{c} {kinds[c]}" for c in columns) + ", row int")


LEVELS = 12  # of a walk through documents, between two writes

# The fields of a reader's objects that are looked at.
PAGE_NAMES = ("pageNum", "page", "page_number")
PLACES = ("y", "top", "x", "left")
ITEMS = f"array<struct<text binary, {', '.join(f'{n} variant' for n in PLACES)}>>"
PAGES = f"array<struct<{', '.join(f'{n} variant' for n in PAGE_NAMES)}, textItems {ITEMS}>>"
ANY = f"struct<{', '.join(f'{n} variant' for n in (*PAGE_NAMES, 'pageIndex', *PLACES))}, text binary, content binary, value binary>"  # bytes: strings, and nothing else


def _known_items(pages: Column) -> Column:
    """[(hint, met)] of the placed items of pages (``PAGES``): hint is the page. Each step makes what the next looks at more than once."""
    first, number, finite, spelled = nested.first_given, nested.number, nested.finite, lambda v: F.trim(nested.string(v))
    named = F.transform(pages, lambda p: F.struct(first(*(p[n] for n in PAGE_NAMES)).alias("v"), p["textItems"].alias("items")))
    named = F.transform(named, lambda p: F.struct(number(p["v"], spelled(p["v"])).alias("page"), p["items"].alias("items")))
    named = F.transform(named, lambda p, i: F.struct(F.when((p["page"] != 0) & finite(p["page"]), p["page"]).otherwise(i + 1.0).alias("page"), p["items"].alias("items")))
    item = lambda p, t: F.struct(p["page"].alias("page"), F.trim(t["text"].cast("string")).alias("text"), first(t["y"], t["top"]).alias("y"), first(t["x"], t["left"]).alias("x"))
    items = F.flatten(F.array_compact(F.transform(named, lambda p: F.transform(p["items"], lambda t: item(p, t)))))
    items = F.transform(F.filter(items, lambda t: t["text"] != ""), lambda t: F.struct(t.alias("t"), spelled(t["y"]).alias("y"), spelled(t["x"]).alias("x")))
    read = lambda t: F.struct(t["t"]["page"].alias("page"), number(t["t"]["y"], t["y"]).alias("top"), number(t["t"]["x"], t["x"]).alias("left"), t["t"]["text"].alias("text"))
    items = F.filter(F.transform(items, read), lambda t: finite(t["top"]) & finite(t["left"]))
    return F.transform(items, lambda t, i: F.struct(t["page"].alias("hint"), F.struct(i.alias("nth"), t["top"].alias("top"), t["left"].alias("left"), t["text"].alias("text")).alias("met")))


def _see_placed(level: DataFrame) -> DataFrame:
    """The nodes that are objects with a text and a place, and the pages that they name."""
    first, f = nested.first_given, lambda n: F.col("f")[n]
    level = level.withColumn("f", F.try_variant_get("node", "$", ANY))
    level = level.select("*", F.coalesce(*(f(n) for n in ("text", "content", "value"))).cast("string").alias("text"), first(*map(f, PAGE_NAMES), f("pageIndex")).alias("p"))
    level = level.select("*", *(F.when(F.col("text") != "", first(f(a), f(b))).alias(a) for a, b in (PLACES[:2], PLACES[2:]))).drop("f")
    level = level.select("*", *(F.trim(nested.string(F.col(c))).alias(f"{c}_text") for c in "pyx"))
    level = level.select("*", *(nested.number(F.col(c), F.col(f"{c}_text")).alias(n) for c, n in (("p", "page"), ("y", "top"), ("x", "left"))))
    met = F.struct(F.lit(None).cast("int").alias("nth"), "top", "left", F.trim("text").alias("text"))
    whole = nested.finite(F.col("top")) & nested.finite(F.col("left"))
    return level.withColumns({"hint": F.when(nested.finite(F.col("page")), F.col("page")).otherwise(F.col("hint")), "met": F.when(whole, met)})


def coordinate_items(docs: DataFrame) -> DataFrame:
    """(doc, page, top, left, text): the texts with a place in documents (doc, json) of a reader of tables; doc names one document.

    The known form is a list of pages with their items. Where a document has none in it, every object at any depth counts that has a text and
    a place; its page is the one that the nearest object around it names (1 without any), and what several objects repeat counts once.
    Both are found as the documents stream by, so a document is made, parsed and walked in one task, and only what is found is written."""
    # the parser takes what stands before further values, so it reads a list of one
    lists = docs.select("doc", F.try_parse_json(F.concat(F.lit("["), "json", F.lit("]"))).alias("v"))
    alone = lists.select("doc", F.when(F.try_variant_get("v", "$[1]", "variant").isNull(), F.col("v")).alias("v"))
    known = alone.select("doc", "v", _known_items(F.try_variant_get("v", "$[0].pages", PAGES)).alias("known"))
    level = known.select("doc", F.when(F.size("known") > 0, F.col("known")).alias("known"), F.when(F.coalesce(F.size("known"), F.lit(0)) <= 0, F.col("v")).alias("v"))
    found = nested.objects(level, "v", ["doc"], hint=F.lit(1.0), see=_see_placed, found="known", places=False, levels=LEVELS)
    page = F.when(F.col("hint") != 0, F.col("hint")).otherwise(1.0)
    # dealt by document: neither what follows nor a grouping by document deals them again; known items have a number, so none of them is left out
    return found.select("doc", page.alias("page"), "met.*").repartition("doc").distinct().drop("nth")


def field(row: Column, patterns: tuple[str, ...]) -> Column:
    """The value of a map whose key matches the first pattern that any key matches."""
    entries = F.map_entries(row)

    def fits(pattern: str):
        return lambda e: F.rlike(F.lower(F.trim(e["key"])), F.lit(pattern)) & e["value"].isNotNull()

    found = [F.try_element_at(F.filter(entries, fits(p)), F.lit(1))["value"] for p in patterns]
    return F.coalesce(*found)


def companies_of(rows: DataFrame, column: str = "cells") -> DataFrame:
    """Companies out of table rows (a map of header to cell). A question mark at the end of a cell marks a doubtful
    reading and is dropped; numbers before a name are row numbers."""
    raw = F.col(column)
    doubtful = F.exists(F.map_values(raw), lambda v: F.coalesce(F.endswith(F.trim(v), F.lit("?")), F.lit(False)))
    clean = F.transform_values(raw, lambda k, v: F.trim(F.regexp_replace(F.trim(v), r"\?+$", "")))
    r = rows.withColumn("_row", clean)
    get = lambda name: field(F.col("_row"), HEADERS[name])
    number = lambda c: F.nullif(F.regexp_replace(c, r"[^0-9.]", "").try_cast("double"), F.lit(0.0))
    name = F.trim(F.regexp_replace(F.coalesce(get("name"), F.lit("unknown")), r"^\d+", ""))
    domain = domain_imported(get("domain"))
    return r.select(
        "*", name.alias("name"), domain.alias("domain"), F.when(domain.isNotNull(), slugify(domain)).otherwise(deterministic_id(name)).alias("id"),
        get("date").alias("date"), get("deal_type").alias("deal_type"), number(get("size")).alias("size_mm"), number(get("total")).alias("total_mm"),
        F.nullif(F.regexp_replace(get("employees"), r"[^0-9]", "").try_cast("long"), F.lit(0)).alias("employees"), get("sector").alias("sector"),
        get("hq").alias("hq"), doubtful.alias("uncertain"),
    ).drop("_row")


def resolve_columns(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """(canonical, actual): for each canonical name the sink's column that has it, else an alias, whatever the case, else
    either without blanks. wanted is (canonical, ord, alias) with the name itself first; present is (name)."""
    bare = lambda c: F.regexp_replace(F.lower(c), r"\s+", "")
    exact = wanted.join(present, F.lower("alias") == F.lower("name")).select("canonical", "name", F.col("ord").alias("rank"))
    loose = wanted.join(present, bare(F.col("alias")) == bare(F.col("name"))).select("canonical", "name", (F.col("ord") + 1000).alias("rank"))
    best = Window.partitionBy("canonical").orderBy("rank", "name")
    found = exact.unionByName(loose).withColumn("rn", F.row_number().over(best)).where("rn = 1").select("canonical", F.col("name").alias("actual"))
    return wanted.select("canonical").distinct().join(found, "canonical", "left")


def warnings_of(name: Column, domain: Column, employees: Column) -> Column:
    """What is odd about an imported company."""
    return F.array_compact(
        F.array(
            F.when(F.coalesce(name, F.lit("")).isin("", "unknown"), F.lit("no_name")),
            F.when(F.coalesce(domain, F.lit("")) == "", F.lit("no_domain")),
            F.when(~F.coalesce(domain.contains("."), F.lit(True)), F.lit("odd_domain")),
            F.when(employees > 1_000_000, F.lit("odd_employees")),
        )
    )


MOST_UNITS, KEPT_UNITS = 1000, 500


def _capped(text: Column) -> Column:
    """A text with its quoted strings of more than 1000 characters cut after 500, with their escapes spelled out."""
    parts = F.regexp_extract_all(text, F.lit(r'("(?:[^"\\]++|\\.)*+"|[^"]++|")'), 1)
    inner = lambda p: F.substring(p, 2, F.length(p) - 2)
    units = lambda p: F.length(F.regexp_replace(inner(p), r"(?s)\\.", "x"))

    def spelled(c: Column) -> Column:
        for raw, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            c = F.replace(c, F.lit(raw), F.lit(written))
        return c

    short = lambda p: F.concat(F.lit('"'), spelled(F.substring(inner(p), 1, KEPT_UNITS)), F.lit('…"'))
    return F.array_join(F.transform(parts, lambda p: F.when(p.startswith('"') & (F.length(p) > 1) & (units(p) > MOST_UNITS), short(p)).otherwise(p)), "")


def recovered(answers: DataFrame) -> DataFrame:
    """(id, form, rows) of answers (id, answer) of a model that was asked for JSON; rows are variants.

    Fences go. What lies between the first opening and the last closing bracket is an array, else between braces an object; a comma before
    a closing bracket is forgiven. Else the answer was cut off or went round in circles: strings that are too long are capped, and the objects that are whole
    by the depth of braces from the first bracket on are taken, of which those that are no JSON are left out. Braces in strings count as any
    others. Without any of these form and rows are null."""
    s = F.trim(F.regexp_replace("answer", "(?i)```[a-z]*", "\n"))
    at = lambda c: F.instr(F.col("s"), c)
    last = lambda c: F.length("s") - F.instr(F.reverse("s"), c) + 1
    between = lambda a, b: F.when((at(a) > 0) & (F.instr(F.reverse("s"), b) > 0) & (last(b) > at(a)), F.substring(F.col("s"), at(a), last(b) - at(a) + 1))
    bare_list = lambda c: F.regexp_replace(F.regexp_replace(c, r",\s*\]", "]"), r",\s*\}", "}")
    bare_object = lambda c: F.regexp_replace(c, r",\s*\}", "}")
    texts = answers.select("id", s.alias("s"))
    texts = texts.select("id", "s", between("[", "]").alias("a"), between("{", "}").alias("o"))
    whole = texts.select(
        "id", "s", F.coalesce(nested.parsed(F.col("a")), nested.parsed(bare_list(F.col("a")))).alias("a"), F.coalesce(nested.parsed(F.col("o")), nested.parsed(bare_object(F.col("o")))).alias("o")
    )
    whole = materialize(whole)

    cut = whole.where("a IS NULL AND o IS NULL").where((at("[") > 0) & (at("{") > 0))
    tail = F.substring(_capped(F.col("s")), F.instr(F.col("s"), "["), F.lit(1 << 30))
    pieces = cut.select("id", F.posexplode(F.regexp_extract_all(tail, F.lit(r"([^{}]++|[{}])"), 1)).alias("pos", "piece"))
    so_far = Window.partitionBy("id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    depth = F.sum(F.when(F.col("piece") == "{", 1).when(F.col("piece") == "}", -1).otherwise(0)).over(so_far)
    pieces = pieces.withColumn("depth", depth)
    opens, closes = (F.col("piece") == "{") & (F.col("depth") == 1), (F.col("piece") == "}") & (F.col("depth") == 0)
    pieces = pieces.withColumn("object", F.sum(opens.cast("int")).over(so_far)).where((F.col("depth") > 0) | closes)
    spelled = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))), lambda x: x["piece"]), "")
    objects = pieces.groupBy("id", "object").agg(F.max(closes).alias("whole"), nested.parsed(spelled).alias("v")).where("whole AND v IS NOT NULL")
    # variants have no order: the rows are gathered under their numbers
    gathered = F.map_from_entries(F.collect_list(F.struct("object", "v")))
    partial = objects.groupBy("id").agg(gathered.alias("m")).select("id", F.transform(F.array_sort(F.map_keys("m")), lambda k: F.col("m")[k]).alias("rows"))
    joined = whole.join(partial, "id", "left")
    form = F.when(F.col("a").isNotNull(), "array").when(F.col("o").isNotNull(), "object").when(F.col("rows").isNotNull(), "partial")
    rows = F.when(F.col("a").isNotNull(), F.try_variant_get("a", "$", nested.ARRAY)).when(F.col("o").isNotNull(), F.array("o")).otherwise(F.col("rows"))
    return joined.select("id", form.alias("form"), rows.alias("rows"))


# What the columns of a table of companies are called; a header names the first or three of them.
COLUMN_NAMES = (r"\bwebsite\b", r"\bhq\b", r"companies", r"\bemployees\b", r"financing", r"total raised")
LEAST_CELLS = 3


def admitted(rows: DataFrame) -> DataFrame:
    """(doc, header, n_rows) of table rows (doc, row, cells): the first row that is a header, and the rows after it that have enough
    cells; without a header, all such rows."""
    filled = F.size(F.filter("cells", lambda c: F.trim(c) != ""))
    names = lambda p: F.exists("cells", lambda c: F.lower(F.trim(c)).rlike(p))
    known = sum(F.coalesce(names(p), F.lit(False)).cast("int") for p in COLUMN_NAMES)
    header = (filled >= LEAST_CELLS) & (F.coalesce(names(COLUMN_NAMES[0]), F.lit(False)) | (known >= 3))
    r = rows.select("doc", "row", (filled >= LEAST_CELLS).alias("enough"), header.alias("is_header"))
    first = r.groupBy("doc").agg(F.min(F.when(F.col("is_header"), F.col("row"))).alias("header"))
    after = F.col("enough") & (F.col("row") > F.coalesce("header", F.lit(-1)))
    return r.join(first, "doc").groupBy("doc", "header").agg(F.count_if(after).alias("n_rows"))


def example_cells(parts: DataFrame) -> DataFrame:
    """Rows of documents out of parts: some are headers by one name, some by three, some lack cells."""
    k = F.col("p_partkey")
    three = k % 7 == 1
    cells = F.array(
        F.when(k % 7 == 0, "Website").when(three, "Employees").otherwise(F.col("p_brand")), F.when(k % 3 == 0, " ").otherwise(F.col("p_type")),
        F.when(three, "HQ location").otherwise(F.col("p_name")), F.when(three, "Total Raised").when(k % 5 == 0, "").otherwise(F.col("p_size").cast("string")),
    )
    return parts.select((k % 50).alias("doc"), k.alias("row"), cells.alias("cells"))


def under_headers(cells: DataFrame, headers: DataFrame, most: float = 40.0) -> DataFrame:
    """(page, row, header, text): cells (page, row, left, text) under the nearest of their page's headers (page, left, name, ord), the first
    among equals, if it is nearer than ``most``; the cells under one header are joined in order. A page has a few headers, which meet
    its cells as one array."""
    few = headers.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("ord", F.col("left").cast("double").alias("left"), "name"))).alias("_h"))
    met = cells.join(few, "page")
    near = F.array_min(F.transform("_h", lambda h: F.struct(F.abs(h["left"] - F.col("left")).alias("d"), h["ord"].alias("ord"), h["name"].alias("name"))))
    kept = met.where(F.trim("text") != "").withColumn("_n", near).where(F.col("_n.d") < most)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("left", F.trim("text").alias("text")))), lambda x: x["text"])
    return kept.groupBy("page", "row", F.col("_n.name").alias("header")).agg(F.array_join(texts, " ").alias("text"))
