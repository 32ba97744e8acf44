"""Change streams with Structured Streaming: runs to the end of what is there, windows, and keyed sinks."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergestone.operators.versions import COUNTER_BITS, VersionedTable
from mergestone.operators.write import split_changes, taken_by
from mergestone.tabledef import all_present


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; under a temporary one where that is unset on a single machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="mergestone-")
    return f"{base.rstrip('/')}/mergestone-stream-{uuid.uuid4().hex}"


def read_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet file or folder as a stream of its files."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isFile():
        # a stream reads folders: the file's own, and in it this file alone
        return reader.option("pathGlobFilter", where.getName()).parquet(where.getParent().toString())
    return reader.parquet(path)


def run_to_end(stream: DataFrame, mode: str = "append") -> DataFrame:
    """What the stream has given once all input there is has been read.

    In append mode the sink is a Parquet folder; results of other modes replace
    what was written, in one batch of the stream each.
    """
    spark = stream.sparkSession
    place = shared_folder(spark)
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{place}/progress").trigger(availableNow=True)
    if mode == "append":
        writer.format("parquet").option("path", f"{place}/out").start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{place}/out")
    table = VersionedTable(spark, f"{place}/out")
    each(writer, lambda batch, number: table.commit(batch, number + 1)).awaitTermination()
    return table.read()


def windows_to_end(stream: DataFrame, time_col: str, delay: str, aggregate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All windows of an aggregate over an event-time stream, each final when the watermark has passed it.

    The query runs in append mode, so state goes with the watermark and rows
    later than ``delay`` are dropped. Once the input has been read to its end a
    closing row of a far time lets the last windows out; its own window never
    comes out.
    """
    spark = stream.sparkSession
    place = shared_folder(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/close")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    closing = spark.readStream.schema(stream.schema).parquet(f"{place}/close")
    counts = aggregate(stream.unionByName(closing).withWatermark(time_col, delay))

    def run() -> None:
        writer = counts.writeStream.outputMode("append").option("checkpointLocation", f"{place}/progress").trigger(availableNow=True)
        writer.format("parquet").option("path", f"{place}/out").start().awaitTermination()

    run()
    far = [F.lit("9000-01-01 00:00:00").cast(f.dataType).alias(f.name) if f.name == time_col else F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema]
    spark.range(1).select(*far).write.mode("append").parquet(f"{place}/close")
    run()
    return spark.read.schema(counts.schema).parquet(f"{place}/out")


def dedup_within(stream: DataFrame, keys: Sequence[Sequence[str]], time_col: str, ttl: str) -> DataFrame:
    """Of rows that share a key within ``ttl`` the first to come, one key after the other; a key with a null is none's equal.

    State is kept for the time to live only.
    """
    out = stream.withWatermark(time_col, ttl)
    for key in keys:
        # a null part gets a value of its own for each row, so such rows never meet
        apart = F.when(~all_present(tuple(key)), F.uuid())
        out = out.withColumn("_apart", apart).dropDuplicatesWithinWatermark([*key, "_apart"]).drop("_apart")
    return out


def each(writer, f: Callable[[DataFrame, int], None]):
    return writer.foreachBatch(f).start()


def apply_stream(
    changes: DataFrame, table: VersionedTable, keys: Sequence[Sequence[str]], sequence: Sequence[str], progress: str, deletes: bool = True, columns: Sequence[str] = (), most_scans: int = 32
) -> None:
    """Applies a changelog stream to a table: each batch is a layer with its last changes, published as one version.

    A batch that was published before a failure is not applied again: its number
    is noted with the version. From ``most_scans`` layers on the table is
    rewritten as one.
    """

    def put(batch: DataFrame, number: int) -> None:
        held = table.manifest()
        if held.get("batch", -1) >= number:
            return
        rows, gone = split_changes(batch, keys, sequence, deletes=deletes)
        names = list(columns) or table.read().columns
        table.add(rows.select(*names), held["version"] + 1, taken_by(rows, gone, keys), held["partition_by"], held["version"], {"batch": number})
        if table.scans() >= most_scans:
            table.compact(held["version"] + 2)

    writer = changes.writeStream.option("checkpointLocation", progress).trigger(availableNow=True)
    each(writer, put).awaitTermination()


def kafka_options(servers: str, topic: str | Sequence[str] = "", pattern: str = "", partitions: dict[str, list[int]] | None = None, group: str = "", start_ms: int | None = None, **more: str) -> dict[str, str]:
    """Options of Spark's Kafka source: topics, a pattern of topics, or partitions by topic; from a time on, else from the earliest."""
    named = [bool(topic), bool(pattern), bool(partitions)]
    if sum(named) != 1:
        raise ValueError("give either topics, a pattern or partitions")
    out = {"kafka.bootstrap.servers": servers, "failOnDataLoss": "true"}
    if topic:
        out["subscribe"] = topic if isinstance(topic, str) else ",".join(topic)
    elif pattern:
        out["subscribePattern"] = pattern
    else:
        out["assign"] = json.dumps(partitions)
    if group:
        out["kafka.group.id"] = group
    if start_ms is None:
        out["startingOffsets"] = "earliest"
    else:
        out |= {"startingTimestamp": str(start_ms), "startingOffsetsByTimestampStrategy": "latest"}
    return out | more


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """(key, value) messages of Kafka as an unbounded stream; the session needs Spark's Kafka package."""
    return spark.readStream.format("kafka").options(**options).load().select("key", "value")


#: How long before a snapshot its change log is read from, in milliseconds.
OVERLAP_MS = 60_000


def start_of_log(snapshot_version: int, override_ms: int | None = None) -> int:
    """The time from which the log is read for a snapshot: a minute before it, or what the caller says."""
    return override_ms if override_ms is not None else (snapshot_version >> COUNTER_BITS) - OVERLAP_MS


def hybrid_stream(table: VersionedTable, log: DataFrame, key: Sequence[str], version: int | None = None) -> tuple[DataFrame, int]:
    """A table's snapshot and then its changes, as one unbounded stream of changelog rows; and the snapshot's version.

    log: a stream of changelog rows with commit_version and ``_change_type``.
    Snapshot rows are inserts at the snapshot's version; of the log what is not
    older counts, so that changes at that version come again and are harmless to
    whoever applies them by key and version. The snapshot is read as a stream of
    the files of a written copy, so the query's checkpoint covers both.
    """
    spark, held = table.spark, table.manifest(version)
    rows = table.read(held["version"])
    columns = [c for c in log.columns if c in rows.columns]
    if set(key) - set(columns):
        raise ValueError("the log lacks columns of the key")
    made = rows.select(*columns, F.lit(held["version"]).cast("long").alias("commit_version"), F.lit("insert").alias("_change_type"), F.lit("SNAPSHOT").alias("source_event"))
    place = f"{shared_folder(spark)}/snapshot"
    made.write.parquet(place)
    first = spark.readStream.schema(made.schema).parquet(place)
    later = log.filter(F.col("commit_version") >= F.lit(held["version"])).select(*columns, "commit_version", "_change_type", F.lit("STREAMING").alias("source_event"))
    return first.unionByName(later), held["version"]


def refuse_limit(rows: DataFrame) -> DataFrame:
    """The rows, unless they are a stream, on which a limit of rows has no meaning."""
    if rows.isStreaming:
        raise ValueError("a stream can't be limited to a number of rows")
    return rows


def snapshot_then_log(snapshot: DataFrame, log: DataFrame, snapshot_version: int, overlap: int = 60_000 << 18) -> DataFrame:
    """Rows of a snapshot and the changes after it, for a log that starts ``overlap`` before it.

    Changes at the snapshot's own version come again; applying them by key and
    version is harmless.
    """
    start = snapshot_version - overlap
    later = log.filter((F.col("commit_version") >= start) & (F.col("commit_version") >= snapshot_version))
    first = snapshot.withColumn("source_event", F.lit("SNAPSHOT"))
    return first.unionByName(later.withColumn("source_event", F.lit("STREAMING")))
