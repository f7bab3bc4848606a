"""The queries of this package, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import ann_search, bpe, html_text, jaccard_join, kd_search, mixing, quality, suffix_dedup, token_files, toxicity
from .tables import read


def vocabulary() -> str:
    """The vocabulary file that the queries use; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(read(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), vocabulary())


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(read(spark, sf_dir, "documents"), vocabulary())


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.decisions(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight FROM s),
f AS (SELECT *, 3 * source_size * (6 // weight) AS full_at, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(weight) OVER () AS BIGINT) AS all_weight FROM w),
g AS (SELECT *, CAST(coalesce(sum(3 * source_size) OVER o, 0) AS BIGINT) AS filled, CAST(coalesce(sum(weight) OVER o, 0) AS BIGINT) AS gone
      FROM f WINDOW o AS (ORDER BY full_at, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
h AS (SELECT *, (total - filled) * 6 >= full_at * (all_weight - gone) AS is_full, CAST(total - filled AS DOUBLE) / CAST(all_weight - gone AS DOUBLE) AS share FROM g),
t AS (SELECT source, source_size, CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE)
             ELSE weight * (SELECT arg_min(share, gone) FROM h WHERE NOT is_full) END AS target FROM h),
r AS (SELECT d.*, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size * 67108864) AS BIGINT) ELSE 0 END AS rate,
             coalesce(CAST('0x' || substr(md5(d.source), 1, 8) AS BIGINT), 2147483648) % 67108864 AS off,
             row_number() OVER (PARTITION BY d.source ORDER BY size, md5(CAST(doc_id AS VARCHAR)), doc_id) AS place
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * (((place * rate + off) >> 26) - (((place - 1) * rate + off) >> 26)) AS taken,
       CAST(((place * rate + off) >> 26) - (((place - 1) * rate + off) >> 26) AS INTEGER) AS copies, source
FROM r
"""


def op3_kd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_search.top_k(read(spark, sf_dir, "embeddings"))


OP3_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def op5_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_search.search(read(spark, sf_dir, "embeddings"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(read(spark, sf_dir, "pages"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(read(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
      ELSE [array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)] END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.y, r.root FROM r JOIN l ON r.doc_id = l.x)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(root) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_bpe": op2_bpe,
    "op3_kd_search": op3_kd_search,
    "op4_mixing": op4_mixing,
    "op5_ann_search": op5_ann_search,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_token_files": op9_token_files,
    "op10_html_text": op10_html_text,
}

ORACLE_SQL: dict[str, str] = {"op3_kd_search": OP3_SQL, "op4_mixing": OP4_SQL, "op8_jaccard_join": OP8_SQL}
