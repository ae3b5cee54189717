"""Incremental append: what has landed since the last run, exactly once.

The checkpoint takes the place of the bookmark.  A run reads the files that are new,
commits their rows and stops, so it can be scheduled like a batch job.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.naming import snake_words
from tidemark.functions.timestamps import day_text
from tidemark.operators.leaves import flatten_known
from tidemark.plans.catalog import TableCatalog
from tidemark.plans.ingest import process_records
from tidemark.sinks.ledger import Settings, commit, create


def landed_stream(
    spark: SparkSession, folder: str, schema: T.StructType | str, max_files: int | None = None, pattern: str | None = None
) -> DataFrame:
    """JSON-lines files of a folder as a stream; `max_files` bounds one micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.json(folder)


def with_day(df: DataFrame, cdc_field: str) -> DataFrame:
    """The partition day of the change field."""
    return df.withColumn("date", day_text(F.col(cdc_field)))


def landed_lines(spark: SparkSession, folder: str, max_files: int | None = None, pattern: str | None = None) -> DataFrame:
    """The lines of a folder's files as a stream of one text column `record`, whatever is in them."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(folder).filter(F.length(F.btrim("value")) > 0).select(F.col("value").alias("record"))


def ingest_available(
    lines: DataFrame,
    target: str,
    checkpoint: str,
    registry: str,
    run_ts: datetime,
    *,
    cdc_field: str = "",
    renames: tuple[Mapping[str, str], ...] = (),
    catalog: TableCatalog | None = None,
    empty_as: str | None = "",
    writer: str | None = None,
    settings: Settings | None = None,
) -> StreamingQuery:
    """Flatten, shape and append the records that have landed since the last run; then stop.

    The whole path from landed text to the table, a micro-batch at a time: leaf paths are those
    `registry` knows, and records that differ extend it; names, types and meta columns are as in
    `process_records`; the batch takes the types of the table's earlier commits and is
    committed once.  `lines` has a text column `record`.  With `catalog=None` types
    are inferred from the batch, and must fit those of the table.
    """
    spark = lines.sparkSession
    name = writer or writer_of(checkpoint)
    create(spark, target, settings or Settings(change=snake_words(cdc_field) or None))

    def take(batch: DataFrame, number: int) -> None:
        # Staged already: finding types and writing read it, not the landed text.
        rows = flatten_known(batch, "record", registry, empty_as=empty_as)
        if not rows.isEmpty():
            shaped, _ = process_records(rows, run_ts, cdc_field=cdc_field, renames=renames, catalog=catalog)
            commit(shaped, target, name, number)

    query = lines.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def writer_of(checkpoint: str) -> str:
    """The name in a table's commits of the stream with a checkpoint."""
    return f"stream-{zlib.crc32(checkpoint.rstrip('/').encode()):08x}"


def append_available(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: tuple[str, ...] = ("date",),
    writer: str | None = None,
    settings: Settings | None = None,
) -> StreamingQuery:
    """Append all that is there now and stop; running it again adds only what is new.

    Each micro-batch is committed once under the number the checkpoint gives it, so one
    that is replayed after a lost driver adds nothing.  The table may be written by
    batch jobs as well.  `writer` names the stream in the table's commits; by
    default it follows from the checkpoint's path.
    """
    spark = stream.sparkSession
    name = writer or writer_of(checkpoint)
    known = create(spark, target, settings or Settings(partition_by))
    if known.settings.partition_by != tuple(partition_by):
        raise ValueError(f"{target} is partitioned by {known.settings.partition_by}")
    rows = transform(stream) if transform else stream
    query = (
        rows.writeStream.foreachBatch(lambda batch, number: commit(batch, target, name, number) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
