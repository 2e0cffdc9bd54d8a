"""The operators of this subpackage applied to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citygrain.llm import chat, exact_dedup, fingerprints, lsh_forest, mixing, ngram_lm, pieces, quality, token_counts, warc_zip
from citygrain.llm import files, id_files, norm_buckets, vector_codes
from citygrain.llm.registry import ORACLES, QUERIES, register, table

__all__ = ["ORACLES", "QUERIES"]

WORD_SQL = "[^\\x20\\x09-\\x0D]+"
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def fold(modulus: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


@register()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality_model(docs, table(spark, sf_dir, "labels"), fold(4) != 2)
    return quality.score_quality(docs, model).select(
        "doc_id",
        F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@register(
    f"""
    WITH rows AS (SELECT doc_id, sha256({LOWER_SQL}) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, text_sha256
    FROM rows WINDOW same AS (PARTITION BY text_sha256)
    """
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_exact_duplicates(table(spark, sf_dir, "documents"))


@register()
def op3_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_fingerprints(table(spark, sf_dir, "documents"))


@register()
def op4_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], talks.schema)
    return chat.digests(chat.windows(talks.union(extra)))


@register()
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"))


@register()
def op6_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_documents(table(spark, sf_dir, "documents"), order=ngram_lm.ORDER)


@register()
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.similar_documents(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@register(
    """
    WITH rows AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
        FROM pages
    ), firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM rows)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
    FROM firsts
    """
)
def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = warc_zip.with_revisits(table(spark, sf_dir, "pages"))
    archives = warc_zip.write_archives(pages, files.new_folder(spark, "warc"))
    return warc_zip.read_archives(spark, archives, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@register()
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_histogram(token_counts.token_counts(table(spark, sf_dir, "documents")))


def quality_weights(labels: DataFrame) -> DataFrame:
    """Weight 2 for documents labelled good, 0.5 for bad ones; those without a label count as 1."""
    return (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.when(F.avg("quality") >= 0.5, 2.0).otherwise(0.5).alias("weight"))
    )


@register()
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), quality_weights(table(spark, sf_dir, "labels")))


def _book_sql(rounds: int, parts: int, entries: int) -> str:
    """Product codes as SQL: one pair of tables per round, nearest entries and their averages."""
    cut = f"list_transform(range(0, {parts}), lambda p: v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})])"
    steps = [
        f"""whole AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
                   list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS MATERIALIZED (SELECT r, unnest(range(0, {parts})) AS p, unnest({cut}) AS v FROM whole),
        book0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM parts WHERE r <= {entries})"""
    ]
    apart = "list_sum(list_transform(list_zip(parts.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for n in range(rounds + 1):
        steps.append(
            f"""near{n} AS MATERIALIZED (
            SELECT r, p, v, e, d FROM (SELECT r, p, parts.v, e, {apart} AS d FROM parts JOIN book{n} b USING (p))
            QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)"""
        )
        if n < rounds:
            steps.append(
                f"""sums{n} AS MATERIALIZED (
                SELECT p, e, i, sum(x) AS s, count(*) AS c FROM (SELECT p, e, unnest(v) AS x, unnest(range(0, len(v))) AS i FROM near{n})
                GROUP BY p, e, i
            ), means{n} AS MATERIALIZED (SELECT p, e, list(CAST((s - ((s % c + c) % c)) // c AS BIGINT) ORDER BY i) AS v FROM sums{n} GROUP BY p, e),
            book{n + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.v, b.v) AS v FROM book{n} b LEFT JOIN means{n} m USING (p, e))"""
            )
    return f"""WITH {", ".join(steps)},
        hash AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}),
        codes AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY r)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM whole JOIN codes USING (r), hash"""


@register(_book_sql(vector_codes.ROUNDS, vector_codes.PARTS, vector_codes.ENTRIES))
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress_vectors(table(spark, sf_dir, "embeddings"))


@register()
def op12_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = files.new_folder(spark, "ids")
    return id_files.read_ids(id_files.write_ids(table(spark, sf_dir, "documents"), folder), folder)


TERMS_SQL = f"unnest(regexp_extract_all({LOWER_SQL}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term"


@register(
    f"""
    WITH words AS (SELECT doc_id, {TERMS_SQL} FROM documents),
    sizes AS (SELECT doc_id, count(*) AS size FROM words GROUP BY doc_id),
    totals AS (SELECT count(*) AS docs, CAST(sum(size) AS BIGINT) AS terms FROM sizes),
    asked AS (SELECT DISTINCT item_id, {TERMS_SQL} FROM benchmark),
    counts AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
    weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM counts, totals GROUP BY term, docs),
    scores AS (SELECT item_id, doc_id,
            CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * docs) // terms)))) AS BIGINT) AS score
        FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals GROUP BY item_id, doc_id)
    SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
    WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER best <= 10
    """
)
def op13_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_buckets.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
