"""The queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellmart.llm import (
    centroids,
    exact_dedup,
    html_extract,
    langid,
    line_chunks,
    mixing,
    packing,
    quality,
    simhash,
    substring,
    topk,
    vector_codes,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_simhash(spark: SparkSession, d: str) -> DataFrame:
    groups = simhash.near_groups(_table(spark, d, "documents"))
    return groups.select("doc_id", simhash.hex_of().alias("fingerprint"), "component_id")


def op2_source_mix(spark: SparkSession, d: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, d, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    first = F.get("positions", F.lit(0)).alias("position")
    rows = mixed.select("doc_id", "size", "source_size", "target", taken, "source", first)
    return rows.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def op3_html_extract(spark: SparkSession, d: str) -> DataFrame:
    return html_extract.extract(_table(spark, d, "pages"))


def op4_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_table(spark, d, "documents")).drop("mark")


def op5_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = line_chunks.drop_repeated_lines(_table(spark, d, "documents"), repeated=line_chunks.grown_chunks)
    return rows.select("doc_id", "lines", "removed_lines", "text")


def op6_exact_topk(spark: SparkSession, d: str) -> DataFrame:
    return topk.top_k(_table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    decisions = exact_dedup.decide(_table(spark, d, "documents"))
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return decisions.select("doc_id", "keep_id", "group_size", "kept", digest)


def op8_language_id(spark: SparkSession, d: str) -> DataFrame:
    return langid.identify(_table(spark, d, "documents"))


def op9_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return substring.repeated_spans(_table(spark, d, "documents"), within=True).drop("mark")


def op10_warc(spark: SparkSession, d: str) -> DataFrame:
    return warc.archive(_table(spark, d, "pages"))


def op11_vector_codes(spark: SparkSession, d: str) -> DataFrame:
    return vector_codes.compress(_table(spark, d, "embeddings"))


def op12_centroid_clusters(spark: SparkSession, d: str) -> DataFrame:
    return centroids.cluster(_table(spark, d, "embeddings"))


def op13_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.judge(_table(spark, d, "documents"), _table(spark, d, "labels"))


OP6_SQL = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
      AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER best::INTEGER AS rank, vec_id, score
FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 20
"""

OP7_SQL = r"""
WITH named AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM named
WINDOW same AS (PARTITION BY text_sha256)
"""

OP10_SQL = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
grouped AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM grouped
"""

_WHOLE = """embedding IS NOT NULL AND list_count(embedding) = len(embedding)
      AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0"""
_SQUARE = "list_sum(list_transform(range(1, len(a.v) + 1), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i])))::BIGINT"
_MEAN = "((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT"


def _op11_sql(rounds: int = 6) -> str:
    """Every part against every entry, round after round."""
    steps = [
        f"""whole AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE {_WHOLE}
)""",
        """cut AS MATERIALIZED (
    SELECT r, p, list_slice(v, (p * (len(v) // 8) + 1)::BIGINT, ((p + 1) * (len(v) // 8))::BIGINT) AS v FROM whole, range(8) AS t(p)
)""",
        """first AS (SELECT r, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM whole WHERE vec_id IS NOT NULL QUALIFY e < 16)""",
        """b0 AS MATERIALIZED (SELECT p, e, v FROM first JOIN cut USING (r))""",
    ]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
    SELECT a.r, a.p, min({_SQUARE} * 16 + b.e) AS best FROM cut a JOIN b{n} b USING (p) GROUP BY a.r, a.p
)""")
        if n < rounds:
            steps.append(f"""b{n + 1} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM b{n} b LEFT JOIN (
        SELECT p, e, list(mean ORDER BY i) AS v FROM (
            SELECT p, e, i, {_MEAN} AS mean FROM (
                SELECT p, best % 16 AS e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{n} JOIN cut USING (r, p)
            ) GROUP BY p, e, i
        ) GROUP BY p, e
    ) m USING (p, e)
)""")
    return f"""WITH {", ".join(steps)},
named AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds}),
coded AS (
    SELECT r, string_agg(printf('%02x', best % 16), '' ORDER BY p) AS code, sum(best // 16)::BIGINT AS error FROM a{rounds} GROUP BY r
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN whole USING (r), named
"""


def _op12_sql(rounds: int = 3) -> str:
    """Every vector against every centroid, round after round."""
    steps = [
        f"""whole AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) = 64 AND {_WHOLE}
)""",
        """c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM whole WHERE vec_id IS NOT NULL QUALIFY c < 16
)""",
    ]
    for n in range(rounds + 1):
        steps.append(f"a{n} AS MATERIALIZED (SELECT a.r, min({_SQUARE} * 16 + b.c) AS best FROM whole a, c{n} b GROUP BY a.r)")
        if n < rounds:
            steps.append(f"""c{n + 1} AS MATERIALIZED (
    SELECT b.c, coalesce(m.v, b.v) AS v FROM c{n} b LEFT JOIN (
        SELECT c, list(mean ORDER BY i) AS v FROM (
            SELECT c, i, {_MEAN} AS mean FROM (
                SELECT best % 16 AS c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{n} JOIN whole USING (r)
            ) GROUP BY c, i
        ) GROUP BY c
    ) m USING (c)
)""")
    return f"""WITH {", ".join(steps)},
final AS (SELECT r, best % 16 AS c, best // 16 AS distance FROM a{rounds})
SELECT vec_id, c::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(b.v, ',')) AS centroid_sha256
FROM final JOIN whole USING (r) JOIN c{rounds} b USING (c)
"""


QUERIES = (
    op1_simhash, op2_source_mix, op3_html_extract, op4_best_fit_packing, op5_line_dedup, op6_exact_topk, op7_exact_dedup,
    op8_language_id, op9_substring_dedup, op10_warc, op11_vector_codes, op12_centroid_clusters,
    op13_quality,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    """SQL for what it can express; the other queries are tested against brute force, round trips and held-out labels."""
    return {"op6_exact_topk": OP6_SQL, "op7_exact_dedup": OP7_SQL, "op10_warc": OP10_SQL, "op11_vector_codes": _op11_sql(), "op12_centroid_clusters": _op12_sql()}
