"""Publishing and archiving as streams of arriving files.

Every micro-batch is written to a folder of its own number and replaces it when retried,
so a batch that runs twice leaves what one run leaves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkcat.config import DEFAULT, Catalog
from linkcat.operators import catalog as lifecycle
from linkcat.operators.media import checksums, new_blobs
from linkcat.sources.readers import parse_manifests

BATCH = "batch_id"
DOCUMENTS = "doc_id string, version string, body variant, published_at timestamp, batch_id bigint"
GRANTS = "namespace string, username string, batch_id bigint"
BLOBS = "sha1_hex string, size bigint, content binary, batch_id bigint"


def _latest_rows(docs: DataFrame) -> DataFrame:
    """Stored documents; of those without a version the row of the latest batch."""
    plain = docs.filter("version is null").select("doc_id", BATCH).groupBy("doc_id").agg(F.max(BATCH).alias(BATCH))
    return docs.filter("version is not null").unionByName(
        docs.filter("version is null").join(plain, ["doc_id", BATCH], "left_semi")).drop(BATCH)


def read_published(spark: SparkSession, store: str) -> DataFrame:
    """The catalog that ``stream_publish`` has stored so far."""
    return _latest_rows(spark.read.schema(DOCUMENTS).parquet(f"{store}/documents"))


def _earlier(spark: SparkSession, path: str, schema: str, batch: int, keep_batch: bool = False) -> DataFrame:
    """What earlier batches stored; nothing before the first."""
    try:
        stored = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], schema)
    earlier = stored.filter(F.col(BATCH) < batch)
    return earlier if keep_batch else earlier.drop(BATCH)


def _replace_batch(df: DataFrame, path: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")


def stream_publish(
    spark: SparkSession,
    inbox: str,
    store: str,
    checkpoint: str,
    maintainers: Callable[[], DataFrame],
    username: str,
    catalog: Catalog = DEFAULT,
) -> StreamingQuery:
    """Publish manifests as they arrive in ``inbox``.

    Below ``store``, every batch adds to ``documents``, ``outcomes``, ``rejects`` (texts that are no JSON) and
    ``maintainers`` (namespaces that went to their first publisher). A stored batch is never rewritten: a document
    without a version is added again, and ``read_published`` takes the row of the latest batch.
    """
    texts = (
        spark.readStream.text(inbox, wholetext=True)
        .select("value", F.col("_metadata.file_path").alias("path"),
                F.col("_metadata.file_modification_time").alias("published_at"))
    )

    def run(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        docs, malformed = parse_manifests(batch)
        submissions = docs.select(
            F.col("path").alias("submission_id"), F.lit(username).alias("username"), "body", "published_at")
        before = _latest_rows(_earlier(session, f"{store}/documents", DOCUMENTS, number, keep_batch=True))
        granted = _earlier(session, f"{store}/maintainers", GRANTS, number)
        known = maintainers().select("namespace", "username").unionByName(granted).distinct()
        result = lifecycle.publish(submissions, before, known, catalog=catalog)
        _replace_batch(result.added.select(*lifecycle.STORED), f"{store}/documents", number)
        _replace_batch(result.outcomes, f"{store}/outcomes", number)
        _replace_batch(malformed, f"{store}/rejects", number)
        _replace_batch(result.maintainers.join(known, ["namespace", "username"], "left_anti"), f"{store}/maintainers", number)

    return (
        texts.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_archive(spark: SparkSession, inbox: str, store: str, checkpoint: str) -> StreamingQuery:
    """Store the bytes of files as they arrive in ``inbox``, each content once."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary").load(inbox)
    )

    def run(batch: DataFrame, number: int) -> None:
        blobs = checksums(batch.select("path", "content", F.col("content").alias("bytes"))).withColumnRenamed(
            "bytes", "content")
        fresh = new_blobs(blobs, _earlier(batch.sparkSession, store, BLOBS, number))
        _replace_batch(fresh.select("sha1_hex", "size", "content"), store, number)

    return (
        files.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
