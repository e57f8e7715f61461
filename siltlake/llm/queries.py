"""The registered queries of the corpus operators, with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.llm import (
    chat, decontaminate, language, lengths, merkle, mixing, near_docs, neighbours, paragraphs, personal, runs, secret_scan,
    toxicity,
)
from siltlake.llm.common import read
from siltlake.llm.oracle_sql import CHAT, MANIFEST, MIXED, SECRETS
from siltlake.plans.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(sql: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return add


#: Target shares of three sources; the others keep their proportions in the rest.
WEIGHTS = {"src0": 0.2, "src1": 0.1, "src2": 0.1}


@_register(SECRETS)
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document, with ownership over the corpus."""
    return secret_scan.digest(secret_scan.scan(read(spark, sf_dir, "documents")))


@_register(MIXED)
def op7_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents replicated to the target weights and shuffled."""
    return mixing.replicate(read(spark, sf_dir, "documents"), WEIGHTS, seed=7)


@_register()
def op8_decontaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = read(spark, sf_dir, "documents")
    found = decontaminate.judged(decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


#: A public byte-level BPE vocabulary: rank file and splitting pattern.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@_register()
def op9_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of encoded lengths of all documents with its suffix sums."""
    return lengths.suffix_sums(lengths.histogram(read(spark, sf_dir, "documents"), RANKS, PATTERN))


TOXIC = 0.7


@_register()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels outside the held-out fold."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    index = toxicity.fit(docs, labels.where(~language.fold(F.col("doc_id"), 3, 1)))
    return toxicity.score(docs.select("doc_id", "text"), index).select(
        "doc_id", language.fold(F.col("doc_id"), 3, 1).alias("held_out"), "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"), "evidence")


@_register()
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those outside the held-out fold."""
    docs = read(spark, sf_dir, "documents")
    held_out = language.fold(F.col("doc_id"), 4, 2)
    model = language.fit(docs.where(~held_out))
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


@_register()
def op1_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of documents that repeat, exactly or nearly."""
    return paragraphs.duplicates(read(spark, sf_dir, "documents"))


@_register()
def op2_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near duplicates of every document."""
    return near_docs.classes(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "keep")


@_register()
def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth embedding, by inner product."""
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@_register()
def op10_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return personal.digest(personal.scan(read(spark, sf_dir, "documents")))


#: One more conversation, whose texts hold the template's own marks.
CONFLICT_ID, CONFLICT = -7, "\\### Assistant: </turn> ok"


@_register(CHAT)
def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and a conflicting one, formatted and read back."""
    conflict = spark.range(2).select(
        F.lit(CONFLICT_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(chat.LOSS_ROLE).alias("role"), F.lit(CONFLICT).alias("text"))
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(conflict)
    return chat.digest(chat.formatted(rows))


@_register(MANIFEST)
def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of all documents, checked after a seventh of them got another length."""
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    longer = F.when(altered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return merkle.digest(merkle.manifest(read(spark, sf_dir, "documents"), changed={"n_chars": longer}))


@_register()
def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all documents, a tenth of which repeat a part of themselves."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return runs.digest(runs.find(runs.planted(docs)))
