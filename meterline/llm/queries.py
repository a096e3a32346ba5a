"""The registered query of each corpus operator: production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, chat, html_crf, langid, neardup_vectors, packing, periodic_runs, pieces_scan, quality, simhash, topk, urlfilter, whitening
from .common import id_crc, read_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


RULES = [urlfilter.Rule("allow", "com", "/"), urlfilter.Rule("block", "example.com", "/en/"), urlfilter.Rule("allow", "www.example.com", "/en/"),
         urlfilter.Rule("block", "net", "/es/"), urlfilter.Rule("block", "net", "/fr/")]


def language_rows(docs: DataFrame) -> DataFrame:
    """The rows that language models may learn from: crc32 of the id mod 5 isn't 0."""
    return docs.where(id_crc("doc_id") % 5 != 0).select("doc_id", "text", "lang")


def quality_rows(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents and labels that the quality classifier may learn from: crc32 of the id mod 4 isn't 2."""
    return docs.select("doc_id", "text"), labels.where(id_crc("doc_id") % 4 != 2).select("doc_id", "quality")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.fit(language_rows(docs))
    found = docs.select("doc_id", F.coalesce(id_crc("doc_id") % 5 == 0, F.lit(False)).alias("held_out"), langid.predict_column(model, "text").alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup_vectors.near_duplicates(read_table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract(read_table(spark, sf_dir, "pages"))


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), TOKENIZER)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(control).alias("text"))
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.read_back(chat.format_turns(turns))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(*quality_rows(docs, read_table(spark, sf_dir, "labels")))
    scored = docs.select("doc_id", F.coalesce(id_crc("doc_id") % 4 == 2, F.lit(False)).alias("held_out"), quality.score_column(model, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.KEEP_AT).cast("int"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_scan.encode(read_table(spark, sf_dir, "documents"), PIECES)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_print(F.col("fp")).alias("fingerprint"), "component_id")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(read_table(spark, sf_dir, "pages"), RULES).withColumnRenamed("id", "page_id")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, "vec_id", "embedding")
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(read_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.components(whitening.whiten(read_table(spark, sf_dir, "embeddings")))
    return found.select(F.col("id").alias("vec_id"), "component", "n", F.col("deviation").try_cast("bigint").alias("deviation"), "whitened", "explained", "identity_error")


def repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): documents whose crc32 of the id ends in 0 repeat a stretch of their own words up to the end."""
    h = id_crc("doc_id")
    words = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("w"))
    sized = words.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    period = sized.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    repeated = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return period.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.detect(repeated_tails(read_table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.select("doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language_id, op2_embedding_near_dedup, op3_html_text, op4_pack, op5_chat_format, op6_quality, op7_sentencepiece, op8_simhash, op9_url_filter, op10_exact_top_k, op11_byte_bpe,
                                     op12_whitening, op13_periodic_runs)}


#: Inner products as SQL: every query row against all rows, with the same floor and tie rule.
TOP_K_SQL = """WITH v AS (SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, q.n AS qn, c.vec_id, c.n, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.n <> c.n)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY qn ORDER BY score DESC, vec_id, n) AS rank FROM s) WHERE rank <= 5"""


def oracle_sql() -> dict[str, str]:
    return {"op9_url_filter": urlfilter.oracle(RULES), "op10_exact_top_k": TOP_K_SQL}
