"""Queries on near-duplicates and repeated passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymark.llm import minhash, substring, vector_index
from tallymark.llm.registry import query, table


def _components_sql(vertex: str) -> str:
    """CTEs `reach` and `least` over a CTE links(a, b) with both directions."""
    return f"""reach(vertex, other) AS (
    SELECT a, b FROM links UNION SELECT r.vertex, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT vertex AS {vertex}, min(other) AS component FROM reach GROUP BY vertex)"""


# Shared shingles of all pairs: for the small test tables.
OP9_SQL = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM words
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), pairs AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * k >= 85 * (x.n + y.n - k)
), links AS MATERIALIZED (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
{_components_sql('doc_id')}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(component, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(component, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""

# Cosines of all pairs: for the small test tables.
OP8_SQL = f"""
WITH RECURSIVE vectors AS MATERIALIZED (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND list_aggregate(list_transform(embedding, lambda x:
        (x IS NULL OR isnan(x) OR isinf(x))::INT), 'sum') = 0
      AND list_aggregate(list_transform(embedding, lambda x: (x <> 0)::INT), 'sum') > 0
), pairs AS MATERIALIZED (
    SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.vec_id < y.vec_id
    WHERE len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.9
), links AS MATERIALIZED (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a),
{_components_sql('vec_id')}
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(component, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(component, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counts USING (vec_id) LEFT JOIN least USING (vec_id)
"""


@query("op9_minhash", OP9_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), percent=85)


@query("op6_substring")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return substring.repeats(table(spark, folder, "documents"))


@query("op8_vector_index", OP8_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return vector_index.near_vectors(table(spark, folder, "embeddings"))
