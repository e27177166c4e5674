"""Each operator applied to its whole table, and the same rows in SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.llm import (
    decontaminate, hard_negatives, html_text, jaccard_join, language_gru, packing, phrases, sharding, token_counts, topk, toxicity, url_filter, warc,
)
from minutebook.llm.common import ready, staged
from minutebook.session import work_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``."""
    def add(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ready(spark)
            return fn(lambda table: spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet"))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@query("op1_toxicity")
def op1_toxicity(read) -> DataFrame:
    """A toxicity score for every document."""
    docs = read("documents")
    return toxicity.predict(docs, toxicity.fit(docs, read("labels")))


@query("op2_html_text")
def op2_html_text(read) -> DataFrame:
    """The main text of every page."""
    return html_text.extract_text(read("pages"))


@query("op3_token_counts")
def op3_token_counts(read) -> DataFrame:
    """Totals, quantiles and truncated totals of all documents for every context limit."""
    return token_counts.token_counts(read("documents"))


NEAR_SQL = r"""
WITH RECURSIVE texts AS MATERIALIZED (SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
spots AS (SELECT n, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM texts WHERE len(w) > 0),
shingles AS MATERIALIZED (SELECT DISTINCT n, array_to_string(list_slice(w, i, i + 2), ' ') AS s FROM spots),
whole AS (SELECT n, count(*) AS size, string_agg(s, chr(10) ORDER BY s) AS all_s FROM shingles GROUP BY n),
sets AS MATERIALIZED (SELECT min(n) AS k, any_value(size) AS size, list(n) AS members FROM whole GROUP BY all_s),
spread AS (SELECT s, count(*) AS df FROM shingles JOIN sets ON n = k GROUP BY s),
placed AS (SELECT k, size, shingles.s, row_number() OVER (PARTITION BY k ORDER BY df, shingles.s) AS p
  FROM shingles JOIN sets ON n = k JOIN spread ON spread.s = shingles.s),
first AS (SELECT k, size, s FROM placed WHERE p <= size - (90 * size + 99) // 100 + 1),
pairs AS MATERIALIZED (SELECT DISTINCT a.k AS a, b.k AS b, a.size + b.size AS total FROM first a JOIN first b ON a.s = b.s AND a.k < b.k
  AND 100 * a.size >= 90 * b.size AND 100 * b.size >= 90 * a.size),
shared AS (SELECT a, b, total, count(*) AS common FROM pairs JOIN shingles x ON x.n = a JOIN shingles y ON y.n = b AND y.s = x.s GROUP BY a, b, total),
links AS MATERIALIZED (SELECT a, b FROM shared WHERE 100 * common >= 90 * (total - common)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(k, other) AS (SELECT a, b FROM both_ways UNION SELECT k, b FROM reach JOIN both_ways ON other = a),
ids AS (SELECT k, min(doc_id) AS id FROM (SELECT k, unnest(members) AS n FROM sets) JOIN texts USING (n) GROUP BY k),
named AS (SELECT i.k, least(any_value(i.id), min(j.id)) AS id FROM ids i LEFT JOIN reach r ON r.k = i.k LEFT JOIN ids j ON j.k = r.other GROUP BY i.k),
of AS (SELECT unnest(members) AS n, size, id FROM sets JOIN named USING (k))
SELECT t.doc_id, CAST(coalesce(size, 0) AS BIGINT) AS n_shingles, coalesce(id, t.doc_id) AS component_id FROM texts t LEFT JOIN of USING (n)
"""


@query("op4_jaccard_join", NEAR_SQL)
def op4_jaccard_join(read) -> DataFrame:
    """The near-duplicate component of every document."""
    return jaccard_join.near_duplicates(read("documents"))


URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]

URL_SQL = """
WITH rules(r_host, r_path, r_verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rest AS (SELECT row_number() OVER () AS n, page_id,
  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT n, page_id,
  translate(regexp_extract(r, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(r, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (SELECT n, r_host || r_path AS rule, r_verdict,
  row_number() OVER (PARTITION BY n ORDER BY length(r_host || r_path) DESC, length(r_host) DESC) AS k
  FROM parts JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits ON parts.n = fits.n AND k = 1
"""


@query("op5_url_filters", URL_SQL)
def op5_url_filters(read) -> DataFrame:
    """Every page's URL judged by the listed rules."""
    pages = read("pages")
    rules = pages.sparkSession.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(pages, rules)


LEAK_SQL = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
cut AS (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0),
keys AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS k FROM cut),
spots AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, (SELECT DISTINCT size FROM keys) WHERE len(w) >= size),
texts AS (SELECT doc_id, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS k FROM spots),
hits AS (SELECT doc_id, i, size, item_id FROM texts JOIN keys USING (size, k)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
of AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN of USING (doc_id)
"""


@query("op6_decontamination", LEAK_SQL)
def op6_decontamination(read) -> DataFrame:
    """How much of every document repeats benchmark items."""
    return decontaminate.decontaminate(read("documents"), read("benchmark"))


@query("op7_packing")
def op7_packing(read) -> DataFrame:
    """All documents packed into sequences of 2048 tokens, with a checksum of each piece's ids."""
    pieces = packing.cut_documents(read("documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(staged(pieces, "pieces")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query("op8_warc")
def op8_warc(read) -> DataFrame:
    """A capture per page, written to archives, read back and assembled."""
    pages = read("pages")
    spark = pages.sparkSession
    folder = work_folder(spark, "warc")
    warc.write_archives(pages, folder)
    records = warc.read_records(spark, folder)
    digested = records.select(
        "record_type", "record_id", "concurrent_to", "target", "fields", F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("long").alias("stored_bytes"),
        F.regexp_extract("http", r"(?i)Content-Length: *(\d+)", 1).try_cast("long").alias("full_bytes"),
        F.when(F.col("record_type") == "metadata", F.decode("payload", "UTF-8")).alias("about"),
    )
    captures = warc.assemble(digested, ("record_id", "fields", "sha1", "stored_bytes", "full_bytes", "about"))
    whole = F.col("kind") == "response"
    return captures.select(
        F.regexp_extract("metadata.about", r"(?:^|\n)page-id: (-?\d+)", 1).try_cast("long").alias("page_id"),
        F.when(whole, F.col("response.stored_bytes")).otherwise(F.col("response.full_bytes")).alias("payload_bytes"),
        F.when(whole, warc.base32_sha1(F.col("response.sha1")))
        .otherwise(F.substring_index(F.col("response.fields")["warc-payload-digest"], ":", -1)).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.regexp_extract("metadata.about", r"\nrefers-to-page: (-?\d+)", 1).try_cast("long").alias("refers_to"),
    )


TOPK_SQL = """
WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op9_topk_search", TOPK_SQL)
def op9_topk_search(read) -> DataFrame:
    """The five best other vectors of every vector whose id is divisible by 50."""
    vectors = read("embeddings").select("vec_id", topk.whole_components(F.col("embedding")).alias("components"))
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


@query("op10_language_id")
def op10_language_id(read) -> DataFrame:
    """The language of every document."""
    docs = read("documents")
    return language_gru.predict(docs, language_gru.fit(docs))


@query("op11_sharding")
def op11_sharding(read) -> DataFrame:
    """The shard of every document, its place there, and its shard if there were one more."""
    return sharding.document_shards(read("documents"))


PHRASES_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM cut),
sized AS (SELECT lang, w, i, unnest(range(1, least(4, len(w) - i + 1) + 1)) AS m FROM spots),
f AS (SELECT lang, m, list_slice(w, i, i + m - 1) AS p, count(*) AS f FROM sized GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
often AS (SELECT * FROM f WHERE f >= 30),
long AS (SELECT lang, m, p, f, unnest(range(2, m)) AS k FROM often WHERE m > 2),
inner_spots AS (SELECT lang, p, f, k, unnest(range(1, m - k + 2)) AS i FROM long),
inside AS (SELECT lang, list_slice(p, i, i + k - 1) AS p, max(f) AS most FROM inner_spots GROUP BY ALL),
kept AS (SELECT o.* FROM often o LEFT JOIN inside USING (lang, p) WHERE m > 1 AND (most IS NULL OR 100 * most < 80 * o.f)),
cuts AS (SELECT lang, m, p, f AS a, unnest(range(1, m)) AS k FROM kept),
scored AS (SELECT c.lang, c.p, a, x.f AS l, y.f AS r, k, 2000000 * CAST(a AS HUGEINT) // (x.f + y.f) AS score FROM cuts c
  JOIN often x ON x.lang = c.lang AND x.p = list_slice(c.p, 1, k) JOIN often y ON y.lang = c.lang AND y.p = list_slice(c.p, k + 1, c.m)),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
named AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, CAST(score AS BIGINT) AS score FROM worst),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""


@query("op12_phrases", PHRASES_SQL)
def op12_phrases(read) -> DataFrame:
    """The strongest phrases of two to four words of every language."""
    return phrases.collocations(read("documents"))


NEGATIVES_SQL = """
WITH fine AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
  CAST(coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM fine a JOIN fine c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
  row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM scored WHERE same),
ranked AS (SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id
  WHERE k <= 5 AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""


@query("op13_hard_negatives", NEGATIVES_SQL)
def op13_hard_negatives(read) -> DataFrame:
    """Three hard negatives for each of five positives of every vector whose id is divisible by 50."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read("embeddings").select("vec_id", label.alias("label"), topk.whole_components(F.col("embedding")).alias("components"))
    return hard_negatives.mine(rows, "vec_id % 50 = 0")
