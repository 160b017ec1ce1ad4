"""Request-log operators on streams.

Routing, cost, access and audit parsing are plain column work and run on a
stream as they are (``flowspark.operators.requests``). Here are the ones that
keep state. Verdicts follow event time, so a batch run over the same requests
gives the same answers as long as micro-batches arrive in time order; within a
micro-batch requests are put in order. How many requests of one key meet in a
micro-batch is bounded by the source's own limit (files, bytes or offsets per trigger).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.operators.ordered import ttl_us
from flowspark.session import scratch_path, ship_package
from flowspark.streaming.stateful import Answers, TokenBucket

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_SECONDS = 86_400


def _call_columns(requests: DataFrame, key: str, time_us: str, tie: str, **more: Column) -> DataFrame:
    ship_package(requests.sparkSession)
    return requests.select(
        F.col(key).cast("string").alias("key"), F.col(time_us).alias("t_us"), F.col(tie).cast("bigint").alias("tie"),
        *[c.alias(name) for name, c in more.items()],
    )


def stream_throttle(requests: DataFrame, key: str, time_us: str, tie: str, rpm: Column, keep_seconds: int = DAY_SECONDS) -> DataFrame:
    """(tie, key, ``allowed``, ``retry_after``) per request: token bucket per key. No limit or one of
    zero refuses all. A bucket's state ends ``keep_seconds`` after its last request: then it is full,
    so take more than a minute and more than requests can be late."""
    calls = _call_columns(requests, key, time_us, tie, rpm=F.coalesce(rpm.cast("bigint"), F.lit(0).cast("bigint")))
    return calls.groupBy("key").transformWithStateInPandas(
        TokenBucket(keep_seconds * 1000), "tie BIGINT, key STRING, allowed BOOLEAN, retry_after DOUBLE", "append", "ProcessingTime"
    ).withColumnsRenamed({"tie": tie, "key": key})


def stream_ttl_dedup(
    requests: DataFrame, key: str, time_us: str, tie: str, fills: Column, ttl_seconds: Column | int = 300,
    delay_seconds: int = 600, default_seconds: int = 300, keep_seconds: int = DAY_SECONDS,
) -> DataFrame:
    """(tie, key, ``hit``) per request, however late.

    A late request is judged by the answers that held at its own time, if it is at most
    ``delay_seconds`` behind its key's latest request; later ones by those of them that are
    left. A key's state ends ``keep_seconds`` after its last change.
    """
    calls = _call_columns(requests, key, time_us, tie, fills=F.coalesce(fills, F.lit(False)), ttl=ttl_us(ttl_seconds, default_seconds))
    return calls.groupBy("key").transformWithStateInPandas(
        Answers(keep_seconds * 1000, delay_seconds * 1_000_000), "tie BIGINT, key STRING, hit BOOLEAN", "append", "ProcessingTime"
    ).withColumnsRenamed({"tie": tie, "key": key})


def write_per_minute(
    requests: DataFrame, folder: str, label: str, time_us: str, by: list[str], sums: dict[str, Column], delay_seconds: int = 600
):
    """Start sums per minute (``requests`` and ``sums``) of a stream, with an output of its own for late rows.

    A row is late when it is more than ``delay_seconds`` behind the latest time of all
    earlier micro-batches: a minute that far back counts as done, and its late rows go whole
    to ``folder/late``. All others are added up into ``folder/minutes``. Each micro-batch has its
    own subfolders and overwrites them, so one that is repeated counts once. Sums of both
    outputs together are those of a batch run; see :func:`read_per_minute`.
    """
    spark = requests.sparkSession
    folder = folder.rstrip("/")
    seen_schema = "latest BIGINT"
    spark.createDataFrame([], seen_schema).write.mode("overwrite").parquet(f"{folder}/seen/batch=-1")

    def store(batch: DataFrame, number: int) -> None:
        here = batch.sparkSession
        earlier = here.read.schema(f"{seen_schema}, batch BIGINT").parquet(f"{folder}/seen").filter(F.col("batch") < number)
        latest = earlier.agg(F.max("latest")).first()[0]
        late = F.lit(False) if latest is None else F.coalesce(F.col(time_us) < latest - delay_seconds * 1_000_000, F.lit(False))
        batch = batch.persist()
        try:
            minute_sums(batch.filter(~late), time_us, by, sums).write.mode("overwrite").parquet(f"{folder}/minutes/batch={number}")
            batch.filter(late).write.mode("overwrite").parquet(f"{folder}/late/batch={number}")
            batch.agg(F.max(time_us).alias("latest")).write.mode("overwrite").parquet(f"{folder}/seen/batch={number}")
        finally:
            batch.unpersist()

    return requests.writeStream.foreachBatch(store).trigger(availableNow=True).option("checkpointLocation", f"{folder}/{label}-state").start()


def minute_sums(requests: DataFrame, time_us: str, by: list[str], sums: dict[str, Column]) -> DataFrame:
    minute = F.expr(f"floor(`{time_us}` / 60000000) * 60000000").cast("bigint")
    return requests.groupBy(*by, minute.alias("minute_us")).agg(F.count("*").alias("requests"), *[F.sum(c).alias(n) for n, c in sums.items()])


def read_per_minute(spark: SparkSession, folder: str, time_us: str, by: list[str], sums: dict[str, Column], late: bool = True) -> DataFrame:
    """Sums per minute of what :func:`write_per_minute` has stored, with or without late rows."""
    found = spark.read.parquet(f"{folder.rstrip('/')}/minutes").drop("batch")
    if late:
        found = found.unionByName(minute_sums(spark.read.parquet(f"{folder.rstrip('/')}/late"), time_us, by, sums))
    return found.groupBy(*by, "minute_us").agg(*[F.sum(c).alias(c) for c in ("requests", *sums)])


def stream_source(spark: SparkSession, step: dict, options: dict[str, str]):
    """Reader for a step fed by a message queue: its ``kafkaGroup`` is the consumer group."""
    reader = spark.readStream.format("kafka").options(**options)
    group = step["output"].get("kafkaGroup", "")
    return reader.option("kafka.group.id", group) if group else reader


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """What stateful processors need; a query started in here keeps these settings.

    State that ends by the clock asks for one more batch after every batch, without which
    taking what is there would never be done.
    """
    wanted = {STATE_STORE: ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def run_available(stream: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Process what the source holds now into a parquet sink and read it back. For streams without a watermark."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, label)
    writer = (
        stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", f"{path}-state").option("path", path)
    )
    with state_on_disk(spark):
        query = writer.start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def write_stream_step(stream: DataFrame, target: str, folder: str, label: str, mode: str = "APPEND", **trigger):
    """Start writing a streamed step result to a parquet target, batch by batch.

    Each micro-batch has its own subfolder and overwrites it, so a batch that is
    repeated after a failure leaves no double rows. With ``mode`` REPLACE the target holds
    the rows of the latest micro-batch that had any. ``trigger`` is passed on; by default
    all that is there is taken.
    """
    path = f"{folder.rstrip('/')}/{target}"

    def store(batch: DataFrame, number: int) -> None:
        if mode == "REPLACE" and batch.isEmpty():
            return
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
        if mode == "REPLACE":
            spark = batch.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path
            files = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
            for found in files.listStatus(at(path)):
                name = found.getPath().getName()
                if name.startswith("batch=") and name != f"batch={number}":
                    files.delete(found.getPath(), True)

    if mode not in ("APPEND", "REPLACE"):
        raise ValueError(f"unknown appendType {mode!r}")
    writer = stream.writeStream.foreachBatch(store).trigger(**(trigger or {"availableNow": True}))
    return writer.option("checkpointLocation", f"{folder.rstrip('/')}/{label}-state").start()
