"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookloom.llm import chat, clusters, decontamination, packing, pieces, pii, quality, repair, repeats, secrets, simhash, toxicity, warc
from bookloom.llm.common import load

TOKENIZER, RANKS, PIECES = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
OWN_CONVERSATION = "</s>[INST] ok [/INST]"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def span_list(spans, *, base_only: bool = False):
    """kind:start:end, comma-joined."""
    chosen = F.filter(spans, lambda s: s["base"]) if base_only else spans
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(kind: str):
    return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(OWN_CONVERSATION).alias("text"))
    found = chat.format_conversations(turns.unionByName(own))
    read = found.withColumn("read", chat.read_turns(F.col("formatted"))).withColumn("learned", chat.learned_text(F.col("segments")))
    written = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(written, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(load(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[count_of(k) for k in ("email", "ip", "card", "phone")],
        F.sha2(span_list(F.col("spans"), base_only=True), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is a repository, its source the owner."""
    found = secrets.find_secrets(load(spark, sf_dir, "documents"), owner=F.col("source"))
    return found.select(
        "doc_id", *[count_of(k) for k in secrets.KINDS],
        F.sha2(span_list(F.col("spans"), base_only=True), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["verdict"] == "live")).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: s["verdict"] == "example")).cast("long").alias("n_examples"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive(load(spark, sf_dir, "pages"))
    return warc.read_archive(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(load(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontamination.find_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "score", "start", "end")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = toxicity.train(docs, load(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(load(spark, sf_dir, "documents"), tokenizer_path(), ranks=tokenizer_path(RANKS))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_path(PIECES), "rb") as file:
        model = file.read()
    found = pieces.decode(pieces.encode(load(spark, sf_dir, "documents"), model), model)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clusters.with_inertia(clusters.cluster(load(spark, sf_dir, "embeddings")))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2("centroid", 256).alias("centroid_sha256"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair.repair_conversations(repair.damage(load(spark, sf_dir, "conversations")))
    return found.where("report IS NOT NULL").select("conv_id", "report.*")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in (
    op1_chat_formatting, op2_pii, op3_secrets, op4_simhash, op5_warc, op6_substring_dedup, op7_quality, op8_decontamination,
    op9_toxicity, op10_packing, op11_sentencepiece, op12_centroids, op13_repair, pipeline)}
