"""The registered queries of this package and the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import (
    block_naming,
    bpe_recursive,
    byte_cnn,
    entropy_secrets,
    group_jaccard,
    kd_topk,
    licence_dice,
    lpf_dedup,
    pair_bitmaps,
    prefix_free,
    template_decon,
    token_frames,
    warc_merge,
)
from lakemart.session import new_table_path


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written as shards of seekable frames and read back."""
    path = new_table_path(spark, "token_frames")
    token_frames.write_shards(_read(spark, sf_dir, "documents"), path)
    ids = F.col("ids")
    n_tokens = (F.octet_length(ids) / 4).cast("long")
    return token_frames.read_shards(spark, path).select(
        "doc_id", "start", n_tokens.alias("n_tokens"), F.crc32(ids).alias("ids_crc32")
    )


def op2_template_decon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that leak into documents, also with other numbers, names and units."""
    return template_decon.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op3_licence_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that passages of documents name, with their number of different passages and the best likeness."""
    found = licence_dice.scan(_read(spark, sf_dir, "documents"))
    return found.groupBy("doc_id", "licence").agg(F.count("*").alias("n_passages"), F.max("dice").alias("dice"))


OP3_SQL = f"""{licence_dice.scan_sql()}
SELECT doc_id, licence, count(*) AS n_passages, max(dice) AS dice FROM best GROUP BY doc_id, licence"""


def op4_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a network that learns from four fifths of the labelled ones."""
    documents = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 5 == 0
    model = byte_cnn.learn(documents.where(~held_out))
    found = byte_cnn.predict(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_kd_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products for every 50th vector."""
    return kd_topk.top_k(_read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, scale=256.0)


OP5_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE)))
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score
FROM s WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""


def op6_lpf_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 50-byte strings that earlier documents have."""
    cleaned = lpf_dedup.remove_repeats(_read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return cleaned.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_warc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC archives, read back through the merged capture index."""
    path = new_table_path(spark, "warc")
    warc_merge.write_archives(_read(spark, sf_dir, "pages"), path)
    return warc_merge.captures(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP7_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT h, max(page_id) AS last FROM p GROUP BY h)
SELECT page_id, strlen(html) AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('{_BASE32}',
        (1 + ((('0x' || substr(h, (1 + 5 * (i // 4))::INTEGER, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) & 31))::INTEGER,
        1)), '') AS payload_digest,
    CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> last THEN last END AS refers_to
FROM p JOIN m USING (h)"""


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of all documents and what they decode to."""
    found = bpe_recursive.round_trip(_read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _of_kind(kind: int) -> Callable[[Column], Column]:
    """One parameter only: a second one, even with a default, would be given the span's place."""
    return lambda s: s["kind"] == kind


def op9_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document by pattern, and spans of high entropy."""
    scanned = entropy_secrets.scan(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [
        F.size(F.filter("spans", _of_kind(n))).cast("long").alias(f"n_{kind}")
        for n, kind in enumerate(entropy_secrets.KINDS[:3])
    ]
    base = entropy_secrets.span_text(F.filter("spans", lambda s: s["kind"] < 3))
    spans = entropy_secrets.span_text(F.col("spans")).alias("spans")
    return scanned.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), spans)


def op10_group_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles are alike to 90 percent."""
    return group_jaccard.link_components(_read(spark, sf_dir, "documents"))


def op11_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of byte-level and piece tokens of every document, with the corpus-wide counts of its pairs."""
    path = new_table_path(spark, "pair_bitmaps")
    pair_bitmaps.build_index(_read(spark, sf_dir, "documents"), path)
    return pair_bitmaps.score_documents(spark.read.parquet(path))


def op12_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents and the one of each that stays."""
    return block_naming.exact_copies(_read(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(n) AS text_sha256
FROM t WINDOW same AS (PARTITION BY n)
"""


def op13_prefix_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language, counted over a prefix-free parse of all documents."""
    return prefix_free.collocations(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_frames": op1_token_frames,
    "op2_template_decon": op2_template_decon,
    "op3_licence_dice": op3_licence_dice,
    "op4_byte_cnn": op4_byte_cnn,
    "op5_kd_topk": op5_kd_topk,
    "op6_lpf_dedup": op6_lpf_dedup,
    "op7_warc_merge": op7_warc_merge,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_entropy_secrets": op9_entropy_secrets,
    "op10_group_jaccard": op10_group_jaccard,
    "op11_pair_bitmaps": op11_pair_bitmaps,
    "op12_block_naming": op12_block_naming,
    "op13_prefix_free": op13_prefix_free,
}

ORACLE: dict[str, str] = {
    "op2_template_decon": template_decon.leaks_sql(),
    "op3_licence_dice": OP3_SQL,
    "op5_kd_topk": OP5_SQL,
    "op7_warc_merge": OP7_SQL,
    "op12_block_naming": OP12_SQL,
    "op13_prefix_free": prefix_free.collocations_sql(),
}
