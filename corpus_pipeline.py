"""From raw documents to packed training sequences, in stages that are each written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. Null ids, null and empty texts, repeated
rows and extra columns pass through by the rules of the operators; an empty
table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.llm import decontaminate, langid, packing, simhash, substring_dedup
from ridgeway.llm.common import carried, read, small_batches, stored
from ridgeway.llm.queries import CAPACITY, vocabulary

#: A document is rejected if its language can't be told at all or its probability is below this.
MIN_LANGUAGE_SCORE = 0.3


def _stage(function):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return function(spark, docs, sf_dir)

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    return run


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model can tell; the model learns from the documents' own labels."""
    model = langid.fit(docs, id_col="doc_id")
    told = langid.predict(docs, model, carry=True)
    return told.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("row.*")


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by SimHash at 4 or fewer bits."""
    return simhash.keep_one(docs, simhash.near_duplicates(docs, shingle_words=4, max_bits=4))


@_stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages of 50 words that an earlier document has; n_chars follows the text."""
    left = substring_dedup.remove_repeats(docs, window=50, layout=True)
    cut = F.col("n_removed") > 0
    row = F.col("row").withField("text", F.when(cut, F.col("kept")).otherwise(F.col("row.text")))
    if "n_chars" in docs.columns:
        size = F.length("kept").cast(docs.schema["n_chars"].dataType)
        row = row.withField("n_chars", F.when(cut, size).otherwise(F.col("row.n_chars")))
    return left.select(row.alias("row")).select("row.*")


@_stage
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item's question and answer."""
    leaks = decontaminate.find_leaks(docs, read(spark, sf_dir, "benchmark")).select("doc_id", "version").distinct()
    own = F.col("doc_id").cast("long")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = carried(docs, id=F.coalesce(own, F.lit(0)), no=own.isNull(), version=F.xxhash64(text))
    leaks = leaks.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no"), "version")
    return rows.join(leaks, ["id", "no", "version"], "left_anti").select("row.*")


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every document with their ids and their places in sequences."""
    return packing.pack_documents(docs, vocabulary(), CAPACITY, special_tokens=True)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack),
]

#: Fingerprints, language models and token ids have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
