"""Loading new daily files once each, as a stream over the lake folder."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import RAW_COLUMNS
from ..sources.dayfiles import archive_lines, is_bad, split_lines, text_options, typed, with_file

# The columns of Spark's binaryFile source, which a stream has to be told.
_BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_lines(
    spark: SparkSession, root: str, zipped: bool = False, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New files under the lake folder as the 58 text fields.

    ``max_files_per_trigger`` cuts a backlog into batches of that many files.
    """
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if zipped:
        archives = reader.format("binaryFile").schema(_BINARY_SCHEMA)
        return split_lines(archive_lines(archives.option("pathGlobFilter", "*.export.CSV.zip").load(root)))
    lines = text_options(reader).csv(f"{root.rstrip('/')}/raw/*/*/*/*.export.CSV")
    return with_file(lines).withColumn("file_error", F.lit(None).cast("string"))


def stream_landed(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files of the lines that ``land_lines`` wrote, as the 58 text fields."""
    return stream_lines(spark, root, max_files_per_trigger=max_files_per_trigger)


def load_new_files(
    lines: DataFrame, table_path: str, checkpoint: str, quarantine_path: str | None = None
) -> StreamingQuery:
    """Load every file that this checkpoint has not seen, then stop.

    Without a quarantine path, a value of the wrong type stops the query. With
    one, rows that hold such a value, and unreadable archives, are written there.

    The file sink keeps its own list of files, so a table filled by a stream is
    filled by streams only.
    """
    parsed = typed(lines)
    unusable = is_bad() | F.col("file_error").isNotNull()
    day = F.col("file_date").alias("ingest_date")

    if quarantine_path is None:
        # Raised from a column beside the typed values, not from a filter, which would type every field again.
        stop = F.raise_error(F.concat(F.lit("bad value in "), F.col("file_path"))).cast("date")
        day = F.when(unusable, stop).otherwise(F.col("file_date")).alias("ingest_date")
        return (
            parsed.select(*RAW_COLUMNS, day)
            .writeStream.format("parquet")
            .partitionBy("ingest_date")
            .option("path", table_path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def write(batch: DataFrame, batch_id: int) -> None:
        # Parsed once for both tables; blocks lost with an executor are parsed again.
        batch = batch.persist(StorageLevel.DISK_ONLY)
        # The batch number in the folder makes a repeated batch replace itself.
        good = batch.where(~unusable).select(*RAW_COLUMNS, day).withColumn("batch", F.lit(batch_id))
        bad = batch.where(unusable).withColumn("batch", F.lit(batch_id))
        for rows, path, folders in ((good, table_path, ["ingest_date", "batch"]), (bad, quarantine_path, ["batch"])):
            writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(*folders).parquet(path)
        batch.unpersist()

    return (
        parsed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
