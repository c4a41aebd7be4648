"""A corpus pipeline: language, quality, near duplicates, repeated passages, then packing.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return the columns of
``documents``.  Nulls are as the operators define: a document without text has no language and goes at once; a table that is empty
stays empty; rows that repeat id and text are one document, rows that share an id but not the text are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starfold.llm import bpe, jaccard_join, language_mix, packing, pairwise_quality, substring_dedup
from starfold.llm.common import BROADCAST_ROWS, shared_checkpoint, sheltered


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which languages were found that have together enough of the text.

    A null text, or one without a letter, has no language and goes; a table from which nothing can be learned keeps nothing.  Repeated rows
    fare alike, null ids as others; extra columns stay, whatever their names; texts are judged whole.
    """
    names, model = language_mix.learn(language_mix.learnable(docs))
    inner, held = sheltered(docs)
    found = language_mix.predict(inner, names, model, text=held["text"]).filter(language_mix.accepted())
    return found.select(*[F.col(held[c]).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the ranking puts at its threshold or above; all of them where the labels don't have both values.

    A null text counts as empty; repeated rows fare alike, null ids as others; extra columns stay, whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = pairwise_quality.learn(docs.select("doc_id", "text"), labels)
    inner, held = sheltered(docs)
    found = pairwise_quality.score(inner, model, text=held["text"]).filter((F.col("predicted") == 1) | F.lit(model is None))
    return found.select(*[F.col(held[c]).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component of near duplicates (five words, Jaccard index 0.8 or more): one of least id, nulls last.

    Rows are judged by their texts: unlike texts that share an id, or have none, all stay, as do rows without a word.  Of rows that repeat
    both id and text one stays.  Extra columns stay, whatever their names.
    """
    found = jaccard_join.judged(docs.select("doc_id", "text"), size=5, least=(4, 5)).select("__id", "__sig", "label")
    order = F.struct(F.col("__id") == -(2**63), "__id", "__sig")
    least = found.filter("label is not null").groupBy("label").agg(F.min_by(F.struct("__id", "__sig"), order).alias("k"))
    first = shared_checkpoint(least.select("k.*", F.lit(True).alias("__one")).union(found.filter("label is null").select("__id", "__sig", F.lit(False))))
    # keys go to the documents where they are few enough, else both are shuffled
    first = F.broadcast(first) if first.count() <= BROADCAST_ROWS else first
    inner, held = sheltered(docs)
    back = [F.col(held[c]).alias(c) for c in docs.columns]
    kept = jaccard_join.with_keys(inner, held["text"], held["doc_id"]).drop("__text").join(first, ["__id", "__sig"])
    if not kept.filter("__one").groupBy("__id", "__sig").count().filter("count > 1").limit(1).count():
        return kept.select(*back)
    repeated = Window.partitionBy("__id", "__sig").orderBy(*[held[c] for c in ("text", "source", "lang", "n_chars") if c in held])
    return kept.withColumn("__n", F.row_number().over(repeated)).filter("__n = 1 or not __one").select(*back)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 35 words or more that stand anywhere else; documents without one keep their text.

    A null text becomes empty; rows of equal id and text repeat each other; extra columns stay but for ``n_words``, ``n_removed`` and ``spans``.
    """
    found = substring_dedup.substring_dedup(docs)
    found = found.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return found.select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and their place in it; a null text is the end id alone, extra columns are left out."""
    return packing.pack_documents(docs, bpe.default_vocabulary(), bpe.default_vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [("language", language), ("quality", quality), ("near_copies", near_copies), ("passages", passages), ("packing", packed)]

#: SQL can't express the learned models and the packing; tests compare the near-copy and passage stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are kept in the shared folder, as the next one reads them more than once."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = shared_checkpoint(docs)
    return docs
