"""The training-corpus pipeline: each stage's rows are written and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, langid, minhash, packing, pii
from ledgerloom.llm.storage import free_name, small_batches, stored

#: A document whose best language has a mean probability below so many times that of a blind guess is no text of any.
LEAST_OVER_CHANCE = 1.2
#: For trial tables alone: with real data the session's ``pii.KEY_SETTING`` has to be given.
PII_KEY = "corpus"


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` but those whose ``doc_id`` is among ``ids`` (one column of that name)."""
    gone = free_name(docs.columns, "gone")
    return docs.join(ids.withColumnRenamed("doc_id", gone), F.col("doc_id") == F.col(gone), "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; texts without letters and unlike any language go.

    The verdict on a row depends on its text alone, so it is taken where the row lies and
    rows with null or repeated ids need no join. Where there is nothing to learn from, no
    text is unlike all languages: those with a letter stay. Null and empty texts go; ties of
    two languages and repeated rows stay or go together; an empty table stays empty; further
    columns pass through.
    """
    small_batches(spark)
    network = langid.fit(langid.sample_of(docs))
    if network is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    least = min(LEAST_OVER_CHANCE / len(network.languages), 0.9)
    lang = free_name(docs.columns, "lang_pred")
    score = free_name(docs.columns, "lang_score")
    marked = langid.labelled(docs, network, lang, score)
    return marked.where((F.col(lang) != "und") & (F.col(score) >= least)).drop(lang, score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity from 0.8 on.

    The smallest id of a group stays. Null and empty texts and null ids are no copies and
    stay; rows that repeat an id stay or go together; an empty table stays empty; further
    columns pass through, whatever their names.
    """
    small_batches(spark)
    gone = minhash.near_duplicates(docs, words=5, percent=80).where(~F.col("kept"))
    return _without(docs, gone.select("doc_id").distinct())


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none and stay, as do null ids; rows that repeat an id go if one
    of them holds an item; empty tables and items leave all; further columns pass through.
    """
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, found.select("doc_id").distinct())


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms; ``n_chars`` follows the text.

    Every row stays, one by one: null texts null, empty ones empty, equal ones equal.
    """
    changed = pii.pseudonymize(docs, spark.conf.get(pii.KEY_SETTING, PII_KEY), found_in=(found := free_name(docs.columns, "found"))).drop(found)
    return changed.withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and the sequences they go to.

    A null or empty text is its end id alone; repeated rows and null ids are packed each for
    itself; an empty table gives no pieces; only ``doc_id`` and ``text`` are read.
    """
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminated", decontaminated),
    ("private", private),
    ("packed", packed),
]

#: Trained networks, hash sketches, keyed digests and subword ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
