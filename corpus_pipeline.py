"""From raw documents to token ids: five stages, each an operator of ``linkcat.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkcat.llm import minhash, sentencepiece_viterbi, superkmer, toxicity, wu_manber
from linkcat.llm.registry import query, table
from linkcat.session import durable


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under their language's toxicity threshold; the classifier learns from the given documents that have labels."""
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every group linked by shingles of five words and a similarity of 0.8 or more."""
    return minhash.keep_first(docs, width=5, percent=80)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that also stand earlier; ``n_chars`` follows the text."""
    cut = superkmer.clean(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return wu_manber.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and whether they decode to it."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    both = sentencepiece_viterbi.encode_and_decode(docs, path)
    whole = F.translate(F.coalesce("row.text", F.lit("")), "▁", " ")
    return both.select("row.doc_id", "row.lang", "row.source", "ids", F.size("ids").cast("long").alias("n_ids"), (F.col("decoded") == whole).alias("round_trip"))


STAGES = [
    ("toxicity", reject_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("benchmark_decontamination", reject_contaminated),
    ("sentencepiece", encode),
]

#: The classifier of the first stage has no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = durable(docs)
    return docs
