"""One query for each operator, over its whole table, and DuckDB SQL where it can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import chats, langid, mixing, neardup, pieces, ppm, repeats, secrets, webp
from .common import table
from .top_k import top_k


def op1_webp_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webp.digest(table(spark, sf_dir, "documents"))


def op2_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.shares(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op3_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = langid.fit(docs.filter(F.coalesce(part, F.lit(0)) != 1))
    held = docs.select("doc_id", "text", F.coalesce(part == 1, F.lit(False)).alias("held_out"))
    return langid.predict(held, model).select("doc_id", "held_out", "lang_pred", "score")


def op6_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    return ppm.score(table(spark, sf_dir, "documents"), F.coalesce(part, F.lit(0)) != 0)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = len(secrets.BASE_RULES)
    found = secrets.scan(docs).select("doc_id", "spans", F.filter("spans", lambda s: s["rule"] < base).alias("base"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    digest = F.sha2(secrets.spelled(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), digest, secrets.spelled(F.col("spans")).alias("spans"))


def op8_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.format_chats(table(spark, sf_dir, "conversations"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_setsketch_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), 85).select("doc_id", "n_shingles", "component_id", "kept")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()} | {"pipeline": corpus_pipeline.run}


_OP9 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, rank, vec_id, score FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs
) WHERE rank <= 5
"""


_OP10 = """
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents WHERE text IS NOT NULL
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 85 * (a.n + b.n - i)
), e AS (
    SELECT x, y FROM links UNION SELECT y, x FROM links
), reach AS (
    SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON reach.r = e.x
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""


_OP4 = """
WITH b AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), windows AS (
    SELECT doc_id, i, hash(substr(x, 2 * i - 1, 800)) AS k FROM (SELECT doc_id, x, unnest(range(1, length(x) // 2 - 398)) AS i FROM b WHERE length(x) >= 800)
), again AS (
    SELECT doc_id, i FROM windows JOIN (SELECT k FROM windows GROUP BY k HAVING count(*) > 1) USING (k)
), marked AS (
    SELECT doc_id, i, sum(CASE WHEN i - before <= 400 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run
    FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM again)
), runs AS (
    SELECT doc_id, min(i) AS low, max(i) + 399 AS high, coalesce(lag(max(i) + 399) OVER (PARTITION BY doc_id ORDER BY min(i)), 0) AS last FROM marked GROUP BY doc_id, run
), words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL
), passages AS (
    SELECT doc_id, hash(array_to_string(w[i:i + 50], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 49)) AS i FROM words WHERE len(w) >= 51)
), told AS (
    SELECT doc_id, count(*) AS n FROM passages JOIN (SELECT k FROM passages GROUP BY k HAVING count(*) > 1) USING (k) GROUP BY doc_id
), cut AS (
    SELECT doc_id, sum(high - low + 1) AS n_removed, count(*) AS n_spans, max(high) AS tail, string_agg(substr(x, 2 * last + 1, 2 * (low - last - 1)), '' ORDER BY low) AS kept
    FROM runs JOIN b USING (doc_id) GROUP BY doc_id
)
SELECT b.doc_id, length(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(tail, 0) + 1))) AS kept_sha256, coalesce(told.n, 0) AS passage_windows
FROM b LEFT JOIN cut USING (doc_id) LEFT JOIN told USING (doc_id)
"""


def _op7() -> str:
    """The spans of every rule by splitting at its matches and summing lengths."""
    q = lambda v: "'" + v.replace("'", "''") + "'"
    parts = []
    for k, r in enumerate(secrets.RULES):
        before = "list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)"
        each = f"unnest(list_transform(range(1, len(m) + 1), lambda i: {{'s': CAST({before} AS BIGINT), 'l': length(m[i]), 'n': length(g[i])}}))"
        found = f"SELECT doc_id, string_split_regex(text, {q(r.pattern)}) AS p, regexp_extract_all(text, {q(r.pattern)}, 0) AS m, regexp_extract_all(text, {q(r.pattern)}, {r.group}) AS g FROM t WHERE regexp_matches(text, {q(r.pattern)})"
        parts.append(f"SELECT doc_id, {k} AS k, x.s AS s, '{r.kind}:' || x.s || ':' || (x.s + x.l) AS v FROM (SELECT doc_id, {each} AS x FROM ({found})) WHERE x.n >= {r.least}")
    count = lambda k, name: f"count(*) FILTER (WHERE k = {k}) AS n_{name}"
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), spans AS ({' UNION ALL '.join(parts)})
SELECT t.doc_id, {count(0, 'assign')}, {count(1, 'access')}, {count(2, 'hex')},
    sha256(coalesce(string_agg(v, ',' ORDER BY s, k) FILTER (WHERE k < {len(secrets.BASE_RULES)}), '')) AS base_sha256, coalesce(string_agg(v, ',' ORDER BY s, k), '') AS spans
FROM t LEFT JOIN spans ON t.doc_id = spans.doc_id GROUP BY t.doc_id"""


def oracle_sql() -> dict[str, str]:
    return {"op4_suffix_dedup": _OP4, "op7_secret_scan": _op7(), "op9_top_k": _OP9, "op10_setsketch_neardup": _OP10}
