"""The queries that apply each operator to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foldwise.llm import align, bpe, chat, decontaminate, fingerprint, langid, licenses, lm, neardup, pii, quality, repair, shards
from foldwise.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_chat_windows")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_control(table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.windows(turns)).select(*chat.columns())


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query("op3_pii")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.fit(docs)).select("doc_id", *pii.digests())


@query("op4_minhash_neardup", neardup.ORACLE)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


@query("op5_lm_score")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm.train(docs.where(~lm.held_out()))
    out = lm.score(docs, model, keep=["doc_id"])
    return out.select("doc_id", lm.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op6_byte_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.decode_documents(bpe.encode_documents(docs).drop("text"))
    return out.select("doc_id", *bpe.digests(out))


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, rules).select("doc_id", *quality.BASE, "base_failed", "kept")


@query("op8_training_order")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.report(spark, shards.materialise(table(spark, sf_dir, "documents")))


@query("op9_decontamination", decontaminate.ORACLE)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", *decontaminate.digests(), "contaminated")


@query("op10_license_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.fit(docs)).select("doc_id", *licenses.columns())


@query("op11_merkle_fingerprint")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.against_next(table(spark, sf_dir, "documents"))


@query("op12_conversation_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.damaged_and_repaired(table(spark, sf_dir, "conversations"))


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.summary(table(spark, sf_dir, "documents")).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
