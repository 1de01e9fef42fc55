"""Incremental runs over delivered folders, and the first rows of streams.

First rows are found in one of two ways. first_arrivals keeps every batch's
candidates and decides when it is read: no row is ever late, and what is kept
grows with the stream. first_per_window and once_per_key keep state only for
as long as a row may be late by, and write each result once, for good.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsloom import schemas
from newsloom.plans.daily import DOC_TYPES, run_daily
from newsloom.session import scratch_run, spool
from newsloom.sources.readers import CSV_OPTIONS

_DATE = r"^\d{4}-\d{2}-\d{2}$"


def read_inbox(spark: SparkSession, inbox: str, doc_type: str) -> DataFrame:
    """New files ``inbox``/<folder>/<doc_type>.csv as a stream of their records, with the folder's name."""
    stream = (
        spark.readStream.schema(schemas.RAW)
        .options(**CSV_OPTIONS, multiLine=True, recursiveFileLookup=True)
        .csv(f"{inbox}/*/{doc_type}.csv")
    )
    path = F.col("_metadata.file_path")
    folder = F.regexp_extract(path, rf"/([^/]+)/{doc_type}\.csv(/|$)", 1)
    return stream.select(F.url_decode(folder).alias("folder"), path.alias("file"))


def incremental_load(
    spark: SparkSession,
    inbox: str,
    out: str,
    warehouse: str,
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """Run every date that has new files since the last run, oldest first, and stop.

    Scores and topics are defined per date, so a date with a new file is run
    again from its whole folder: a late file gives the tables of ``out`` that
    one complete delivery gives. Files of a folder that is no date are listed
    in ``out``/refused_files. A run that breaks off is repeated for the same
    files and gives the same result.
    """
    stream = read_inbox(spark, inbox, DOC_TYPES[0])
    for doc_type in DOC_TYPES[1:]:
        stream = stream.unionByName(read_inbox(spark, inbox, doc_type))

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        with scratch_run(session, "files"):
            files = spool(batch.distinct(), "files")  # the only reading of the new files' records here
            is_date = F.col("folder").rlike(_DATE) & F.col("folder").try_cast("date").isNotNull()
            refused = files.where(~is_date)
            if not refused.isEmpty():
                refused.write.mode("overwrite").parquet(f"{out}/refused_files/batch={number}")
            dates = files.where(is_date).select("folder").distinct().orderBy("folder").collect()  # a row for each date
        for row in dates:
            run_daily(session, row["folder"], inbox, out, warehouse, **options)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_arrivals(
    stream: DataFrame, out: str, checkpoint: str, keys: tuple[str, ...], event_time: str, width: str
) -> StreamingQuery:
    """Write the first row of each key in each window of event time; read it with read_first.

    First is the earliest event time, then the least other columns. Each
    micro-batch writes its own first rows and the reader takes the first of
    them, so neither the order of arrival nor the cut into batches matters, no
    late row is lost and no state is kept. A batch that runs again replaces
    its folder.
    """
    rest = [c for c in stream.columns if c not in (*keys, event_time)]

    def write(batch: DataFrame, number: int) -> None:
        window = F.window(event_time, width)["start"].alias("window")
        first = F.min(F.struct(event_time, *rest)).alias("first")
        batch.groupBy(*keys, window).agg(first).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_first(spark: SparkSession, out: str, keys: tuple[str, ...]) -> DataFrame:
    """What first_arrivals has found so far."""
    return spark.read.parquet(out).groupBy(*keys, "window").agg(F.min("first").alias("first")).select(*keys, "window", "first.*")


def first_per_window(
    stream: DataFrame, out: str, checkpoint: str, keys: tuple[str, ...], event_time: str, width: str, delay: str
) -> StreamingQuery:
    """Write the first row of each key in each window of event time, when no earlier one can come any more.

    First is the earliest event time, then the least other columns. A window
    is written to ``out`` once the newest event time of finished batches lies
    ``delay`` behind its end; from then on rows of it are late and left out,
    and late_rows tells how many. The state holds the first rows of windows
    that are still open, one for each key, and goes on from ``checkpoint``. Cut into
    batches and order of arrival change nothing as long as no row is late.
    Event times up to 1970 are late from the start. Results are appended as
    Parquet files, each exactly once.
    """
    rest = [c for c in stream.columns if c not in (*keys, event_time)]
    window = F.window(event_time, width)
    first = (
        stream.withWatermark(event_time, delay)
        .groupBy(*keys, window.alias("_window"))
        .agg(F.min(F.struct(event_time, *rest)).alias("first"))
    )
    return _appended(first.select(*keys, F.col("_window.start").alias("window"), "first.*"), out, checkpoint)


def once_per_key(
    stream: DataFrame, out: str, checkpoint: str, keys: tuple[str, ...], event_time: str, delay: str
) -> StreamingQuery:
    """Write each row at once unless its key came before; for deliveries that may come again.

    A key is remembered until the newest event time of finished batches lies
    ``delay`` behind its own: a copy whose event time is within ``delay`` of the
    first one's is always left out. A row older than that is late, is left
    out whether it is a copy or not, and counted by late_rows. The state holds
    the keys of the last ``delay`` of event time, whatever the length of the
    stream. Event times up to 1970 are late from the start.
    """
    return _appended(stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys)), out, checkpoint)


def late_rows(query: StreamingQuery) -> int:
    """Rows that came too late in the batches that ``query`` still reports."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def _appended(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
