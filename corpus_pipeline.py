"""A corpus pipeline over ``documents``: language ID, SimHash near-dedup, PII, mixing to target weights, byte-level BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet in the shared folder
and reads back as the next stage's docs.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collabstats.llm import bpe, langid, mixing, pii, simhash
from collabstats.llm.common import crc_is_one, materialize, read
from collabstats.llm.queries import vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents with a known language; a document without a language of its own gets the predicted one.

    Letters of scripts that no language was learned with belong to no language, so texts in such a script are rejected.
    Null and empty texts and texts without letters are rejected; repeated rows and null ids are judged by their text like any
    other; no documents give none; columns beyond those of documents go.
    """
    model = langid.train(docs.where(~crc_is_one(F.col("doc_id"), 3)))
    told = langid.predict(docs, model, keep=COLUMNS)
    kept = told.where(langid.accepted(F.col("lang_pred"), F.col("score") * langid.learned_share(F.col("text"), model)))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash connects: three-word shingles, at most three differing bits.

    Null, empty and wordless texts have fingerprint zero and are one group; the row with the smallest id stays, of equal ids
    the one with the smallest fingerprint, then values; a group of null ids keeps a row with a null id; no documents give none.
    """
    return simhash.deduplicate(docs.select(*COLUMNS), simhash.WORDS, simhash.DISTANCE)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their personal data replaced by its kind; every document stays.

    Null and empty texts stay as they are (n_chars null and 0); repeated rows and null ids are rows like any other.
    """
    hidden = pii.redact(pii.find_pii(docs.select(*COLUMNS)))
    return hidden.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, so that sources meet their target weights.

    Null, empty and wordless texts have no size and are not taken; a null source is a source, the last one; rows equal in
    id, source and text share what they take; no documents give none.
    """
    return mixing.remix(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (packed little-endian unsigned 32-bit integers) and the digest of their decoded bytes.

    Null and empty texts have no ids; every row of the input gives one row; columns beyond id, language and source go.
    """
    ranks, pattern = vocabulary()
    coded = bpe.encode(docs, ranks, pattern, keep=("doc_id", "lang", "source"), decoded=True)
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", bpe.sha256("decoded").alias("decoded_sha256"))


STAGES = [
    ("language ID", languages),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing", mixture),
    ("byte-level BPE", tokens),
]

#: Hash draws, SimHash and BPE have no SQL form; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
