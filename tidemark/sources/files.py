"""Folders of files as tables: what they hold, how they are to be read, and which are whole pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Kinds of files, and endings of pages that are kept beside a company's own page.
IMAGES = ("png", "jpg", "jpeg", "webp", "tiff")
BESIDE = (".playwright.html", ".homepage.html", ".careers.html")


def listing(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, folder, name, bytes) of the files under a path; with ``glob`` of those whose name it fits. Contents aren't read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    at = F.col("path")
    return files.select(at, F.regexp_replace(at, "/[^/]*$", "").alias("folder"), F.regexp_extract(at, "([^/]*)$", 1).alias("name"), F.col("length").alias("bytes"))


def ending(name: Column) -> Column:
    """The lower-case ending of a file's name, empty without one; a name that only has a dot in front has none."""
    return F.lower(F.regexp_extract(name, r"[^.]\.([^.]*)$", 1))


def kind(name: Column) -> Column:
    return F.when(F.lower(name).endswith(".pdf"), "pdf").when(ending(name).isin(*IMAGES), "image").otherwise("other")


def input_modes(files: DataFrame, single: bool = False) -> DataFrame:
    """(folder, mode, n_pdf, n_image) of folders of files (folder, name): pdf-dir with at least one PDF, else images; pdf for a
    path that is itself one PDF (``single``)."""
    counts = files.groupBy("folder").agg(F.count_if(kind(F.col("name")) == "pdf").alias("n_pdf"), F.count_if(kind(F.col("name")) == "image").alias("n_image"))
    mode = F.when(F.col("n_pdf") > 0, "pdf" if single else "pdf-dir").otherwise("images")
    return counts.select("folder", mode.alias("mode"), "n_pdf", "n_image")


def canonical_pages(files: DataFrame) -> DataFrame:
    """files (folder, name, ...) that are a company's own page: one dot in the name, not kept beside another, and no answer of the same
    company (its name with .json) in the folder. Column id is the name without its ending."""
    beside = F.lit(False)
    for end in BESIDE:
        beside |= F.col("name").endswith(end)
    pages = files.where(F.col("name").endswith(".html") & ~beside).withColumn("id", F.regexp_replace("name", r"\.html$", ""))
    answers = files.where(F.col("name").endswith(".json")).select("folder", F.regexp_replace("name", r"\.json$", "").alias("id")).distinct()
    return pages.where(~F.col("id").contains(".")).join(answers, ["folder", "id"], "left_anti")
