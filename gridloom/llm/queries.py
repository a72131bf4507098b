"""Registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from public_tokenizers import path as tokenizer_path

from gridloom.llm.centroids import CentroidSettings, cluster_vectors
from gridloom.llm.decontam import match_benchmark
from gridloom.llm.neardup import near_duplicates
from gridloom.llm.packing import PackSettings, pack_documents, packed_matrix
from gridloom.llm.passages import both_sides, fuzzy_passages
from gridloom.llm.phrases import PhraseSettings, collocations
from gridloom.llm.pii import find_pii
from gridloom.llm.repetition import score_repetition
from gridloom.llm.secretscan import SecretSettings, find_secrets
from gridloom.llm.sitequality import site_quality, sites_of
from gridloom.llm.tokencount import count_tokens
from gridloom.llm.toxicity import ToxicitySettings, score_toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query
def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_tokens(documents(spark, sf), tokenizer_path("word_bpe_49k.json"))


@query
def op5_repetition(spark: SparkSession, sf: str) -> DataFrame:
    return score_repetition(documents(spark, sf))


def byte_pairs(capacity: int, end_id: int, width: int = 4) -> PackSettings:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken")
    return PackSettings(*paths, capacity=capacity, end_id=end_id, width=width)


@query
def op1_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(documents(spark, sf), byte_pairs(1024, 2))


@query
def op6_packed_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Digest of the packed matrix: the checksum of each row of ids beside its segment lists."""
    packed = packed_matrix(documents(spark, sf), byte_pairs(2048, 50256, width=2))
    return packed.withColumn("ids_crc32", F.crc32("input_ids")).drop("input_ids")


@query
def op2_pii(spark: SparkSession, sf: str) -> DataFrame:
    return find_pii(documents(spark, sf))


@query
def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = match_benchmark(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit").cast("long").alias("n_hit"),
        F.size("exact").cast("long").alias("n_items"),
        F.sha2(F.array_join("exact", ","), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"),
        F.size("near").cast("long").alias("n_near"),
        F.sha2(F.array_join("near", ","), 256).alias("near_sha256"),
    )


@query
def op3_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(documents(spark, sf))


@query
def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    return score_toxicity(documents(spark, sf), labels, ToxicitySettings(*paths))


@query
def op8_site_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs, pages, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "pages", "labels"))
    return site_quality(docs, sites_of(docs, pages), labels.select("doc_id", "quality"))


@query
def op10_fuzzy_passages(spark: SparkSession, sf: str) -> DataFrame:
    return both_sides(fuzzy_passages(documents(spark, sf)))


@query
def op11_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return find_secrets(documents(spark, sf), SecretSettings())


@query
def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(documents(spark, sf), PhraseSettings())


@query
def op13_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return cluster_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"), CentroidSettings())


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL["op9_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
k AS (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM k, LATERAL unnest(range(1, len(w) - k + 2)) t(i)
),
dw AS (
  SELECT doc_id, i, n.k, array_to_string(w[i:i + n.k - 1], ' ') AS g
  FROM (SELECT doc_id, w, n.k FROM d, (SELECT DISTINCT k FROM bw) n) n, LATERAL unnest(range(1, len(w) - n.k + 2)) t(i)
),
hits AS (SELECT doc_id, i, dw.k, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
),
place AS MATERIALIZED (SELECT doc_id, unnest(w) AS t, unnest(range(0, len(w))) AS p, len(w) AS n FROM d),
freq AS (SELECT t, count(DISTINCT doc_id) AS n FROM place GROUP BY t),
win AS MATERIALIZED (
  SELECT row_number() OVER () AS id, item_id, k, g FROM (
    SELECT DISTINCT item_id, k, w[i:i + k - 1] AS g FROM k, LATERAL unnest(range(1, len(w) - k + 2)) t(i)
  )
),
term AS MATERIALIZED (SELECT id, item_id, k, unnest(g) AS t, unnest(range(0, k)) AS o FROM win),
anchor AS (
  SELECT term.* FROM term LEFT JOIN freq USING (t)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY coalesce(freq.n, 0), o) <= 3
),
start AS (
  SELECT DISTINCT doc_id, id, p - o AS s FROM anchor JOIN place USING (t) WHERE p - o >= -2
),
near AS (
  SELECT doc_id, item_id FROM start JOIN term USING (id) JOIN place USING (doc_id, t)
  WHERE p BETWEEN s + o - 2 AND s + o + 2
  GROUP BY doc_id, id, item_id, s, k HAVING 10 * count(DISTINCT o) >= 8 * k
),
near_items AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT * FROM near EXCEPT SELECT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated,
  coalesce(near_items.n, 0) AS n_near, sha256(coalesce(near_items.ids, '')) AS near_sha256
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
LEFT JOIN near_items ON d.doc_id = near_items.doc_id
"""

_PIECES = rf"string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')"

SQL["op12_collocations"] = rf"""
WITH p AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest({_PIECES}) AS piece FROM documents)
),
n AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM p, (VALUES (1), (2), (3), (4), (5)) s(k), LATERAL unnest(range(1, len(w) - k + 2)) t(i)
  GROUP BY ALL HAVING count(*) >= 100
),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
inner_parts AS (
  SELECT DISTINCT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM c, LATERAL unnest(range(2, k)) x(m), LATERAL unnest(range(1, k - m + 2)) t(i)
),
cuts AS (
  SELECT c.lang, c.phrase, c.a, n.n, j, l.a AS l, r.a AS r,
    (1000::HUGEINT * c.a * n.n) // (l.a::HUGEINT * r.a) AS score
  FROM c JOIN n USING (lang), LATERAL unnest(range(1, c.k)) t(j)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:c.k], ' ')
),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
kept AS (SELECT * FROM weakest w WHERE NOT EXISTS (
  SELECT 1 FROM inner_parts i WHERE i.lang = w.lang AND i.phrase = w.phrase AND i.a >= w.a
))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase,
  a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000
"""


def _centroid_sql(s: CentroidSettings) -> str:
    """One assignment and one update for each round, with vectors as one row per component."""
    ctes = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({s.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {s.components} AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
)""",
        "x AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS d FROM kept)",
        f"""first AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('{s.salt}' || CAST(vec_id AS VARCHAR))) - 1 AS cluster
  FROM kept QUALIFY cluster < {s.clusters}
)""",
        "c0 AS MATERIALIZED (SELECT cluster, d, x FROM first JOIN x USING (vec_id))",
    ]
    for k in range(s.rounds + 1):
        ctes.append(f"""a{k} AS MATERIALIZED (
  SELECT vec_id, cluster, distance FROM (
    SELECT x.vec_id, c.cluster, sum((x.x - c.x) * (x.x - c.x)) AS distance FROM x JOIN c{k} c USING (d) GROUP BY ALL
  ) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1
)""")
        if k < s.rounds:
            ctes.append(f"""c{k + 1} AS MATERIALIZED (
  SELECT c.cluster, c.d, CAST(coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.x) AS BIGINT) AS x FROM c{k} c LEFT JOIN (
    SELECT cluster, d, sum(x) AS s, count(*) AS n FROM a{k} JOIN x USING (vec_id) GROUP BY ALL
  ) m USING (cluster, d)
)""")
    k = s.rounds
    return f"""WITH {", ".join(ctes)},
sha AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{k} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{k} JOIN sha USING (cluster)
"""


SQL["op13_centroids"] = _centroid_sql(CentroidSettings())
