"""The queries of this subpackage; ``__spark_entry__`` registers them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, licenses, line_labels, media, mixing, near_dedup, packing, quality, repeats, toxicity, trie, url_filters, variants
from tidemark.llm import common


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    common.bound_batches(spark)
    return common.table(spark, sf_dir, name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.3).cast("int").alias("predicted"),
        F.size("toxicity.passages").alias("n_passages"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        quality.held_out("doc_id").alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = line_labels.fit(docs, table(spark, sf_dir, "labels"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share")
    return line_labels.annotate(docs.select("doc_id", "text"), model).select("doc_id", *(f"rules.{c}" for c in base))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        table(spark, sf_dir, "documents"),
        vocabulary=public_tokenizers.path("byte_bpe_50k.json"),
        ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs.select("doc_id", "text"), language.fit(docs)).select(
        "doc_id",
        language.held_out("doc_id").alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media(table(spark, sf_dir, "documents"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = url_filters.evaluate(url_filters.dated_captures(pages), url_filters.dated_lists(pages))
    return found.withColumn("fetched_on", F.col("fetched_on").cast("string"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.fit(docs))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def queries() -> dict:
    found = {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}
    return dict(sorted(found.items(), key=lambda kv: int(kv[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


#: Values of CRC-32's table from its rule; crc(list of bytes) is CRC_START, then a reduction, then CRC_END.
CRC_TABLE = """
g(i, c, k) AS (
  SELECT i, i, 0 FROM (SELECT range::BIGINT AS i FROM range(256))
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM g WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM g WHERE k = 8)"""


def crc_sql(letters: str) -> str:
    """CRC-32 of a list of code points below 2048 as UTF-8, with crc.t in reach."""
    octets = f"flatten(list_transform({letters}, lambda p: CASE WHEN p < 128 THEN [p] ELSE [192 | (p >> 6), 128 | (p & 63)] END))"
    return f"xor(list_reduce([4294967295::BIGINT] || {octets}, lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295)"


ORACLES = {
    "op11_spelling_variants": rf"""
WITH RECURSIVE {CRC_TABLE},
r AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
h AS (SELECT run, n, {crc_sql("list_transform(str_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda x: unicode(x)::BIGINT)")} AS h FROM r, crc),
w AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM h)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (
  SELECT a.word AS x, b.word AS y FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT cut.word, w.word FROM cut JOIN w ON w.word = cut.rest
  UNION SELECT w.word, cut.word FROM cut JOIN w ON w.word = cut.rest),
best AS (
  SELECT x, count(*) AS n_near, first(y ORDER BY w.n DESC, encode(y)) AS y, max(w.n) AS y_n FROM near JOIN w ON w.word = near.y GROUP BY x),
f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN y_n >= 5 * w.n THEN y END AS form, CASE WHEN y_n >= 5 * w.n THEN y_n END AS form_n
  FROM w LEFT JOIN best ON best.x = w.word),
way(word, root, form) AS (
  SELECT word, word, form FROM f UNION ALL SELECT way.word, f.word, f.form FROM way JOIN f ON f.word = way.form)
SELECT f.word, f.form, way.root, f.n, f.n_near, f.form_n FROM f JOIN way ON way.word = f.word AND way.form IS NULL""",
    "op12_prefix_trie": rf"""
WITH RECURSIVE {CRC_TABLE},
t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
v AS (SELECT c, c - c % 5 AS s, {crc_sql("list_transform(str_split(CAST(c AS VARCHAR), ''), lambda x: unicode(x)::BIGINT)")} % 9 AS h FROM (SELECT DISTINCT c FROM t), crc),
u AS (SELECT v.c, 0 AS part, t.k, role, text FROM v JOIN t ON t.c = v.s AND t.k <= v.h
      UNION ALL SELECT v.c, 1, t.k, role, text FROM v JOIN t ON t.c = v.c AND t.k > v.h),
d AS (SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY part, k) AS d FROM u),
p AS (SELECT c, d, text, md5(string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY d)) AS key FROM d
      UNION ALL SELECT c, 0, '', '' FROM v),
q AS (SELECT *, lag(key) OVER (PARTITION BY c ORDER BY d) AS parent, d = max(d) OVER (PARTITION BY c) AS ends FROM p),
n AS (
  SELECT key, min(d) AS depth, min(c) AS conv_id, min(parent) AS parent, count(*) AS n_convs, (count(*) - 1) * max(strlen(text)) AS own,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM q GROUP BY key),
k AS (SELECT parent AS key, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
a AS (SELECT DISTINCT x.key AS top, y.key FROM q x JOIN q y ON x.c = y.c AND x.d <= y.d),
s AS (SELECT a.top, sum(n.own) AS saved, count(*) FILTER (k.key IS NULL) AS n_leaves FROM a JOIN n USING (key) LEFT JOIN k USING (key) GROUP BY a.top)
SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN s ON s.top = n.key LEFT JOIN k ON k.key = n.key LEFT JOIN n m ON m.key = n.parent""",
    "op13_suffix_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
c AS (SELECT r, j, substr(x, 2 * j + 1, 1398) AS y FROM (SELECT r, x, unnest(range(0, n - 199, 500)) AS j FROM d WHERE n >= 200)),
p AS (SELECT r, j + i AS i, md5(substr(y, 2 * i + 1, 400)) AS h FROM (SELECT r, j, y, unnest(range(0, least(500, length(y) // 2 - 199))) AS i FROM c)),
q AS (SELECT r, i FROM p WHERE h IN (SELECT h FROM p GROUP BY h HAVING count(*) > 1)),
s AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS span FROM
      (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM q)),
g AS (SELECT r, span, min(i) AS a, max(i) + 200 AS b FROM s GROUP BY r, span),
k AS (SELECT r, span, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS kept FROM g),
o AS (SELECT d.r, sum(b - a) AS removed, count(*) AS spans, string_agg(substr(x, 2 * kept + 1, 2 * (a - kept)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS x
      FROM k JOIN d USING (r) GROUP BY d.r)
SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(o.x, d.x))) AS kept_sha256
FROM d LEFT JOIN o USING (r)""",
    "op1_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w,
              source_size * 3.0::DOUBLE AS cap FROM s0),
s2 AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS t, sum(w) OVER () AS ws,
              coalesce(sum(cap) OVER p, 0) AS cb, coalesce(sum(w) OVER p, 0) AS wb FROM s1
       WINDOW p AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, cap * (ws - wb) <= (t - cb) * w AS capped FROM s2),
s4 AS (SELECT *, sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS ct,
              sum(CASE WHEN capped THEN w ELSE 0 END) OVER () AS wt FROM s3),
s5 AS (SELECT *, CASE WHEN capped THEN cap WHEN ws > wt THEN (t - ct) / (ws - wt) * w ELSE 0 END AS target FROM s4),
s6 AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
              CAST('0x' || substr(md5('mix|' || coalesce(source, '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM s5),
r AS (SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY size, h, doc_id) AS k FROM d)
SELECT r.doc_id, r.size, s6.source_size, CAST(s6.target AS DOUBLE) AS target,
       CAST((floor(k * rate + u) - floor((k - 1) * rate + u)) * r.size AS BIGINT) AS taken
FROM r JOIN s6 ON r.source IS NOT DISTINCT FROM s6.source""",
    "op5_url_filters": r"""
WITH p AS (
  SELECT page_id, url, nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '^www\.', ''), '') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/*([^?#]*)', 1) AS path,
         DATE '2024-01-01' + CAST(CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 6) AS INT) % 366 AS INT) AS fetched_on FROM pages),
s AS (SELECT DISTINCT nullif(regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1), '') AS site FROM p),
l AS (
  SELECT 'ads' AS list, site AS entry FROM s WHERE regexp_matches(site, 'ads|track')
  UNION ALL SELECT 'spam', site FROM s WHERE contains(site, 'spam')
  UNION ALL SELECT 'adult', site FROM s WHERE contains(site, 'adult')
  UNION ALL SELECT 'reported', site FROM s WHERE CAST('0x' || substr(md5('r' || site), 1, 6) AS INT) % 6 = 0
  UNION ALL SELECT 'parts', site || '/fr' FROM s WHERE CAST('0x' || substr(md5('p' || site), 1, 6) AS INT) % 5 = 0),
d AS (SELECT *, DATE '2024-01-01' + CAST(CAST('0x' || substr(md5(list || entry), 1, 6) AS INT) % 200 AS INT) AS day0,
             CAST('0x' || substr(md5('b' || entry), 1, 6) AS INT) % 3 = 0 AS back FROM l),
i AS (SELECT list, entry, day0 AS a, day0 + 70 AS b FROM d UNION ALL SELECT list, entry, day0 + 110, NULL FROM d WHERE back),
h AS (
  SELECT p.page_id, count(*) AS n, string_agg(DISTINCT i.list, ',' ORDER BY i.list) AS lists FROM p JOIN i
  ON (CASE WHEN contains(i.entry, '/') THEN p.host || '/' || trim(regexp_replace(p.path, '/+', '/', 'g'), '/') = i.entry
                OR starts_with(p.host || '/' || p.path, i.entry || '/')
      ELSE p.host = i.entry OR ends_with(p.host, '.' || i.entry) END)
     AND p.fetched_on >= i.a AND (i.b IS NULL OR p.fetched_on < i.b) GROUP BY p.page_id)
SELECT p.page_id, p.url, CAST(p.fetched_on AS VARCHAR) AS fetched_on, p.host, h.n IS NOT NULL AS blocked, coalesce(h.n, 0)::BIGINT AS n_entries, coalesce(h.lists, '') AS lists
FROM p LEFT JOIN h USING (page_id)""",
}
