"""Registered queries of the training-data operators, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, fingerprints, html_text, langid, license_scan, packing, phrases, pieces, quality, simhash, substring_dedup, whitening
from .common import read, small_batches, stored

CAPACITY = 2048


def vocabulary() -> str:
    """Path of the byte-level BPE vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, sf_dir)

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's 4-word SimHash and its component of fingerprints linked at 4 or fewer bits."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents not held out."""
    return langid.fit_and_predict(read(spark, sf_dir, "documents"))


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces and their places in sequences of 2048 tokens."""
    return packing.pack_documents(read(spark, sf_dir, "documents"), vocabulary(), CAPACITY, special_tokens=True)


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document once passages of 50 words that an earlier document has are cut out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    left = substring_dedup.remove_repeats(docs.select("doc_id", "text"), window=50)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op3_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), p AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS win
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS i FROM w)
), m AS (
  SELECT win, min(doc_id) AS least FROM p GROUP BY win
), r AS (
  SELECT DISTINCT p.doc_id, p.i + k.k AS pos FROM p JOIN m USING (win), (SELECT unnest(range(50)) AS k) k
  WHERE m.least < p.doc_id
), x AS (
  SELECT doc_id, pos, word FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM w)
), k AS (
  SELECT x.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY x.pos) AS kept
  FROM x LEFT JOIN r ON r.doc_id = x.doc_id AND r.pos = x.pos WHERE r.pos IS NULL GROUP BY x.doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id
"""


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and test item of which it holds question and answer, with the BM25 share and the overlaps."""
    found = decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "question_overlap", "answer_overlap", "from_word", "to_word")


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline``, one after the other, over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@query
def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how alike they and the next document's are."""
    return fingerprints.compare_with_edits(read(spark, sf_dir, "documents"))


@query
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1 formatted as prefix trees, written, and read back from what was written."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    shards = stored(chat.format_conversations(rows.unionByName(more), vocabulary()), "chat")
    return chat.read_back(shards, vocabulary())


ORACLE["op10_chat_formatting"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS BIGINT)
         AS formatted_chars
FROM c GROUP BY conv_id
"""


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labelled documents not held out."""
    docs = read(spark, sf_dir, "documents")
    return quality.predict(docs, quality.fit(docs, read(spark, sf_dir, "labels")), threshold=0.3)


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's canonical digest, the licence that it is, and the licences whose notices it holds."""
    return license_scan.scan(read(spark, sf_dir, "documents"))


ORACLE["op1_license_scan"] = license_scan.scan_sql()


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The laid-out visible text of every page."""
    return html_text.extract(read(spark, sf_dir, "pages"))


def piece_model() -> str:
    """Path of the SentencePiece model file."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SentencePiece ids with begin and end ids, and the text that they read as."""
    done = pieces.encode_and_decode(read(spark, sf_dir, "documents"), piece_model())
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return done.select("doc_id", "n_tokens", sha("ids").alias("ids_sha256"), sha("decoded").alias("decoded_sha256"))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first four components of its integer form, fitted on all distinct ones."""
    rows = read(spark, sf_dir, "embeddings")
    return whitening.whiten(rows, whitening.fit(rows))


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 strongest phrases of 2 to 4 words."""
    return phrases.collocations(read(spark, sf_dir, "documents"))


ORACLE["op12_phrase_collocations"] = phrases.collocations_sql()
