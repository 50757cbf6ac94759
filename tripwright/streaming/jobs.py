"""The serving edge as stream jobs: scoring, memo, latency percentiles and live profiles.

State that outlives a batch is a table per batch id in a shared folder. A batch reads the state of
the one before and overwrites its own, so a replayed batch gives what it gave, and losing an
executor or the driver costs a rerun of one batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tripwright.operators import latency, rules, score
from tripwright.operators.model import LinearModel
from tripwright.schemas import PREDICTION, Bounds
from tripwright.session import Scratch
from tripwright.sources import csv_lines


def _state(spark: SparkSession, folder: str, batch_id: int, schema: str) -> DataFrame:
    """State left by the batch before this one; empty at the start."""
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/batch={batch_id - 1}")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _leave_state(frame: DataFrame, folder: str, batch_id: int) -> None:
    """Write a batch's state; of the older ones only the one before it stays, for a replay.

    A first batch starts anew: what another run left in the folder would otherwise pass for the
    newest state.
    """
    spark = frame.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if batch_id == 0:
        files.delete(path, True)
    frame.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
    files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch={batch_id - 2}"), True)


def score_stream(
    requests: DataFrame,
    model: LinearModel,
    version: int,
    folder: str,
    checkpoint: str,
    arrived_at: str | None = None,
) -> DataStreamWriter:
    """Append every scored request to the prediction table in ``folder``, with its latency since ``arrived_at``.

    A stateless projection into the file sink, which writes each batch exactly once.
    """
    scored = score.score(requests, model, version)
    log = score.prediction_log(scored, F.current_timestamp(), arrived_at)
    return (
        log.select(*PREDICTION.names)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
    )


_MEMO = "cache_key string, duration_min double, scored_at timestamp"


def memo_stream(
    requests: DataFrame,
    model: LinearModel,
    version: int,
    request_id: str,
    arrived_at: str,
    folder: str,
    checkpoint: str,
) -> DataStreamWriter:
    """Answer every request, from the memo where its key was computed in the five minutes before it.

    Times are those of ``arrived_at``, so batches may be cut anywhere. Answers go to
    ``folder/answers``, the newest live entry per key to ``folder/memo``; both are keyed by batch.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id == 0:  # answers of another run are none of this one's
            _delete(spark, f"{folder}/answers")
        memo = _state(spark, f"{folder}/memo", batch_id, _MEMO)
        with Scratch(spark) as scratch:
            answers, entries = score.score_by_time(batch, model, version, request_id, arrived_at, memo, scratch)
            answers.write.mode("overwrite").parquet(f"{folder}/answers/batch={batch_id}")
            latest = answers.agg(F.max(F.col(arrived_at).cast("timestamp"))).head()[0]
            live = entries if latest is None else score.live_entries(entries, F.lit(latest).cast("timestamp"))
            _leave_state(live, f"{folder}/memo", batch_id)

    return requests.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def latency_stream(
    samples: DataFrame, key: str, value: str, order: list[str], folder: str, checkpoint: str
) -> DataStreamWriter:
    """Keep the newest 200 samples per key in ``folder``, one state table per batch."""
    columns = list(dict.fromkeys([key, value, *order]))
    types = dict(samples.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in columns)

    def run(batch: DataFrame, batch_id: int) -> None:
        known = _state(batch.sparkSession, folder, batch_id, schema)
        both = known.unionByName(batch.select(*columns))
        newest = latency.newest_per_key(both, key, *order)
        _leave_state(newest, folder, batch_id)

    return samples.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def last_state(spark: SparkSession, folder: str) -> DataFrame:
    """The newest state table written by a stream of this module."""
    try:
        batches = spark.read.parquet(folder).select("batch").distinct().agg(F.max("batch")).head()
    except AnalysisException as error:
        raise LookupError(f"no state in {folder}") from error
    return spark.read.parquet(f"{folder}/batch={batches[0]}")


def profile_stream(
    trips: DataFrame, aggregate: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str
) -> DataStreamWriter:
    """Running group-by over a stream of trips; each batch overwrites the whole small result.

    With ``profile.profile`` as the aggregate, ``profile.Profile`` reads all six results from it, empty
    hours and bins filled in.
    """

    def run(result: DataFrame, _batch_id: int) -> None:
        result.write.mode("overwrite").parquet(folder)

    return (
        aggregate(trips)
        .writeStream.outputMode("complete")
        .foreachBatch(run)
        .option("checkpointLocation", checkpoint)
    )


def read_parquet_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """A growing Parquet table as a stream, with the schema its files have now.

    A file stream takes a plain path for the base folder of a partitioned table and so refuses a
    single file; a pattern matches a file and a folder alike.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def read_csv_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Lines of a growing folder of CSV files; each file arrives whole, in one batch."""
    reader = spark.readStream.option("lineSep", "\n")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).select(
        "value", "_metadata.file_path", "_metadata.file_block_start"
    )


def csv_stream(
    lines: DataFrame, use: Callable[[DataFrame, int], None], checkpoint: str
) -> DataStreamWriter:
    """Call ``use`` with the trip records of each batch of ``read_csv_stream``, and its number.

    Headers are looked up per batch, so a file is read by its own whatever came before. A batch
    without a line is passed over.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            use(csv_lines.parse_files(csv_lines.numbered(batch)), batch_id)

    return lines.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def csv_rule_stream(
    lines: DataFrame, folder: str, checkpoint: str, bounds: Bounds = Bounds()
) -> DataStreamWriter:
    """Records per rule of a stream of CSV lines: a table of at most ten rows per batch in ``folder``."""

    def use(records: DataFrame, batch_id: int) -> None:
        if batch_id == 0:  # counts of another run are none of this one's
            _delete(records.sparkSession, folder)
        totals = rules.rule_totals(rules.with_rule(records, bounds))
        totals.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return csv_stream(lines, use, checkpoint)


def run_to_end(writer: DataStreamWriter) -> None:
    """Process what is available now, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
