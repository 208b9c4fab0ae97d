"""From documents to token files: each stage works on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import binary_records, decontaminate, language, mixing, ngram_join
from sievework.llm.common import remainder, table, written

# A text whose best language scores below this is rejected like one without letters, unless its code is
# shorter than the second language's by these bits in total: twice as likely, however many bytes say nothing.
LEAST_SCORE = 0.5
LEAST_MARGIN = 1.0
TOKENIZER = "byte_bpe_50k.json"


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: those undetermined or between two languages go."""
    model = language.fit(docs, F.coalesce(remainder("doc_id", 5) != 0, F.lit(True)))
    judged = language.predict_language(docs, model, margin=True)
    clear = (F.col("score") >= LEAST_SCORE) | (F.col("margin") >= LEAST_MARGIN)
    kept = (F.col("lang_pred") != language.UNDETERMINED) & clear
    return judged.filter(kept).select(*docs.columns)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of similar ones; rows repeated under
    that id stay once. Documents without words, or without an id, stay."""
    parts = ngram_join.similar_documents(docs)
    others = parts.filter("doc_id <> component_id").select(F.col("doc_id").alias("_id")).distinct()
    others = written(others, "similar")
    if others.count() <= ngram_join.BROADCAST_IDS:
        others = F.broadcast(others)
    kept = docs.join(others, docs["doc_id"] == others["_id"], "left_anti")
    # only rows under an id that occurs several times can be repeated: the others' texts are not shuffled
    several = docs.groupBy(F.col("doc_id").alias("_id")).count().filter("count > 1").select("_id")
    several = written(several, "repeated-ids")
    n = several.count()
    if not n:
        return kept
    if n <= ngram_join.BROADCAST_IDS:
        several = F.broadcast(several)
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    once = kept.join(several, same, "left_semi").dropDuplicates(docs.columns)
    return kept.join(several, same, "left_anti").unionByName(once)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    drawn = mixing.mix(docs).filter("copies > 0")
    repeated = drawn.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies")))
    return repeated.select(*docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; one row per record, read back from them."""
    tokenizer = binary_records.tokenizer_file(public_tokenizers.path(TOKENIZER))
    manifest = binary_records.write_records(docs, binary_records.record_folder(spark), tokenizer)
    return binary_records.read_records(manifest)


STAGES = [
    ("language", identify),
    ("near_duplicates", keep_one),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_files", token_files),
]
# Models, rounding and token ids have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
