"""Bronze ingestion as a stream of files: each micro-batch adds the rows not seen before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import RAW_EOD, RAW_LMS
from ..sources.bronze import BUCKETS, EOD_TABLE, write_bronze


def export_stream(
    spark: SparkSession,
    folder: str,
    kind: str,
    file_format: str = "parquet",
    course_key: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New export files of a folder, as raw rows."""
    schema = RAW_EOD if kind == EOD_TABLE else RAW_LMS
    reader = spark.readStream.schema(schema).format(file_format)
    if file_format == "csv":
        # A file whose header is not the schema's fails the batch instead of filling other columns.
        reader = reader.option("header", True).option("enforceSchema", False)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(folder)
    return rows if course_key is None else rows.withColumn("course_key", F.lit(course_key))


def start_bronze(rows: DataFrame, database: str, kind: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Ingest what is there and stop.

    A batch that is run again after a failure adds nothing, because its rows are in the
    table already; no record of batch numbers is needed.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        write_bronze(batch.sparkSession, batch, database, kind, buckets)

    return (
        rows.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
