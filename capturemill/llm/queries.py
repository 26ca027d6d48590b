"""Registered queries of this subpackage: each operator over its whole table, with the parameters for production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, context_lm, decontaminate, delta_lloyd, fill_middle, html_text, jaccard, langid, mixing, quality, repeats, secrets, sharding
from .common import table

HARD_CASE = "\\### Assistant: </turn> ok"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op2_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.divergence_rules(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.tiled_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.hilbert_shards(table(spark, sf_dir, "documents"), n_shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("h").alias("curve_index"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HARD_CASE).alias("text"))
    return chat.digests(chat.format_conversations(turns.unionByName(hard)))


def op6_suffix_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_lm.score_running_text(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_delta_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_lloyd.cluster(table(spark, sf_dir, "embeddings")).drop("centroid")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_middle(table(spark, sf_dir, "documents")))


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_html_extraction, op2_quality_divergence, op3_decontamination, op4_hilbert_sharding, op5_chat_formatting, op6_suffix_tree_scoring, op7_ngram_jaccard, op8_mixing, op9_secret_scan, op10_language_id, op11_delta_lloyd, op12_fill_middle, op13_suffix_array_dedup, pipeline)}



def _lloyd_sql(rounds: int) -> str:
    """Each round from the round before it, over all vectors."""
    owners = """a{r} AS MATERIALIZED (
            SELECT n, c AS cluster, d AS distance FROM (SELECT v.n, x.c, list_sum(list_transform(list_zip(v.q, x.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{r} x)
            QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, c) = 1)"""
    centroids = """c{s} AS MATERIALIZED (
            SELECT c, coalesce(list(m ORDER BY i) FILTER (WHERE m IS NOT NULL), any_value(q)) AS q FROM (
                SELECT x.c, x.q, f.i, f.m FROM c{r} x LEFT JOIN (
                    SELECT cluster, i, ((s - ((s % k) + k) % k) // k)::BIGINT AS m FROM (
                        SELECT cluster, i, sum(y) AS s, count(*) AS k FROM (SELECT a.cluster, unnest(v.q) AS y, unnest(range(64)) AS i FROM a{r} a JOIN v USING (n)) GROUP BY cluster, i)) f ON f.cluster = x.c)
            GROUP BY c)"""
    steps = ",\n        ".join(f"{owners.format(r=r)},\n        {centroids.format(r=r, s=r + 1)}" for r in range(rounds))
    return f"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS q FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), q) - 1 AS c, q FROM v QUALIFY c < 8),
        {steps},
        {owners.format(r=rounds)}
        SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
            sha256(array_to_string(x.q, ',')) AS centroid_sha256
        FROM a{rounds} JOIN v USING (n) JOIN c{rounds} x ON x.c = cluster"""


ORACLE_SQL = {
    "op11_delta_lloyd": _lloyd_sql(10),
    "op12_fill_middle": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        d AS (SELECT *, len(u) AS n, list_transform([0, 1, 2, 3], lambda i: ('0x' || substr(h, (8 * i + 1)::BIGINT, 8))::BIGINT) AS d FROM t),
        c AS (
            SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS a, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS b,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR d[3] % 100 >= 90 THEN 'plain' WHEN d[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
        x AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
            sha256(prefix || middle || suffix) AS restored_sha256 FROM x""",
    # Windows by their hexadecimal bytes; the covered places as islands; what is left as the pieces between them.
    "op13_suffix_array_dedup": """
        WITH t AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        w AS MATERIALIZED (SELECT r, i, md5_number(substr(x, 2 * i + 1, 400)) AS h FROM (SELECT r, x, unnest(range(len(x) // 2 - 199)) AS i FROM t WHERE len(x) >= 400)),
        s AS (SELECT r, i, CASE WHEN i > 200 + max(i) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS new FROM w SEMI JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)),
        g AS (SELECT r, k, min(i) AS a, max(i) + 200 AS b FROM (SELECT *, sum(new) OVER (PARTITION BY r ORDER BY i) AS k FROM s) GROUP BY r, k),
        p AS (
            SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM g
            UNION ALL SELECT r, 1000000000000, 1000000000000, max(b) FROM g GROUP BY r),
        k AS (SELECT r, sum(b - a)::BIGINT AS removed, count(*) - 1 AS spans, string_agg(substr(x, 2 * before + 1, least(2 * (a - before), 4000000000)), '' ORDER BY a) AS x FROM p JOIN t USING (r) GROUP BY r)
        SELECT doc_id, (len(t.x) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.x, t.x))) AS kept_sha256
        FROM t LEFT JOIN k USING (r)""",
    # Counts and digests from the source rows: equal to what is read back from the formatted output.
    "op5_chat_formatting": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        e AS (
            SELECT *, CASE WHEN contains(role || text, '\') OR contains(role || text, '</turn>') OR contains(role || text, '###') OR contains(role, ':') OR contains(role, chr(10)) THEN 1 ELSE 0 END AS hard FROM t),
        x AS (
            SELECT *, CASE WHEN hard = 1 THEN replace(replace(replace(text, '\', '\s'), '</turn>', '\t'), '###', '\m') ELSE text END AS xt,
                CASE WHEN hard = 1 THEN replace(replace(replace(replace(replace(role, '\', '\s'), '</turn>', '\t'), '###', '\m'), ':', '\c'), chr(10), '\n') ELSE role END AS xr FROM e)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
            sum(length(xr) + length(xt) + 14)::BIGINT AS formatted_chars,
            true AS round_trip
        FROM x GROUP BY conv_id""",
}
