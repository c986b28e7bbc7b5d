"""The registered queries of the llm operators: each applies one operator, with production parameters, to its whole
table and derives the digest columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, conversations, html_extract, langid, lm, merkle, packing, pii, quality, simhash, suffix_dedup, token_counts
from . import sql
from .common import id_remainder


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 4) == 2
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs, model, [F.col("doc_id"), held_out.alias("held_out")])


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    coded = bpe.encode(docs, tokenizer_path("byte_bpe_50k.json"), [F.col("doc_id")], decoded=True)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(_table(spark, sf_dir, "documents"))

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=50)
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, neighbours=5)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2, window=4096)
    return packing.pack(cut, window=4096)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "reason")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 10) == 0
    model = lm.fit(docs.where(~held_out))
    return lm.score(docs, model, [F.col("doc_id"), held_out.alias("held_out")])


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fields = _table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"]
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))     # a null id is not tampered with
    other = merkle.leaf([F.translate("text", capitals, capitals.lower()) if f == "text" else F.col(f) for f in fields])
    found = merkle.manifest(docs, fields, "source", "doc_id", fan_out=16, keep=[F.when(hit, other).alias("tampered")])
    root = merkle.hex_text(F.col("root"))
    folded = found.select("doc_id", *[merkle.hex_text(F.col(c)).alias(c) for c in ("leaf", "subroot")], root.alias("root"),
                          F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
                          merkle.fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), [F.col("doc_id")])
    return found.withColumn("over_limit", F.col("n_tokens") > 512)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    def text(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    rows = _table(spark, sf_dir, "conversations")
    damage = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    damaged = rows.select("conv_id", "turn", F.when(damage == 4, F.lit("user")).otherwise(text("role")).alias("role"),
                          F.when(damage == 1, F.lit("")).when(damage == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text")).alias("text"),
                          (damage != 0).alias("present"), F.explode(F.sequence(F.lit(1), F.when(damage == 3, 2).otherwise(1))).alias("copy"))
    return conversations.summary(conversations.repair(damaged, present=F.col("present")))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_bpe, op3_pii, op4_suffix_dedup, op5_html_extraction, op6_simhash, op7_ann, op8_packing, op9_quality_rules, op10_lm_scoring,
    op11_merkle_manifest, op12_token_counts, op13_conversation_repair)}
ORACLE_SQL = {"op4_suffix_dedup": sql.REPEATS, "op11_merkle_manifest": sql.MERKLE, "op13_conversation_repair": sql.CONVERSATIONS}
