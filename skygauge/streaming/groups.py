"""Groups of messages by size or elapsed time, whichever comes first, from any source.

Each key (a topic partition, say) has a buffer in the state store: the waiting rows, their number, when the first came and which
group is next. A buffer that reaches ``size`` rows leaves as a group ``closed_by`` "size"; what waits for ``delay_ms`` leaves as a group
closed by "time", through a processing-time timer. Less than ``size`` rows of a key are ever held, and a task reads its rows as they come.
A restart finds buffers and timers in the checkpoint: the wait goes on from the first row, not from the restart, and size and delay may
have changed in between.
"""

from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from skygauge.sources.zones import replace_partitions

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: batches without new rows, which timers need; a bounded run would never end with them
IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"
#: what is added to the rows: the group's number in its key, how it was closed, rows in it, how long its first row had waited
GROUP = [StructField("group", LongType()), StructField("closed_by", StringType()), StructField("group_rows", LongType()), StructField("waited_ms", LongType())]


class SizeOrTime(StatefulProcessor):
    def __init__(self, schema: StructType, size: int, delay_ms: int):
        self.schema, self.size, self.delay_ms = schema, size, delay_ms

    def init(self, handle):
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.schema)
        self.buffer = handle.getValueState("buffer", "n long, first long, next long")

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        n, first, number = self.buffer.get() or (0, now, 0)
        fresh = []
        for row in rows:
            fresh.append(tuple(row))
            if n + len(fresh) >= self.size:
                yield from self._group(self._taken(n) + fresh, number, "size", now - first)
                n, first, number, fresh = 0, now, number + 1, []
        if fresh:
            self.waiting.appendList(fresh)
            n += len(fresh)
        if n and now - first >= self.delay_ms:
            yield from self._group(self._taken(n), number, "time", now - first)
            n, number = 0, number + 1
        self.buffer.update((n, first, number))
        self._wake(first + self.delay_ms if n else None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentProcessingTimeInMs()
        n, first, number = self.buffer.get() or (0, now, 0)
        if n and now - first >= self.delay_ms:
            yield from self._group(self._taken(n), number, "time", now - first)
            self.buffer.update((0, now, number + 1))
        elif n:  # the delay has grown since the timer was set
            self.handle.registerTimer(first + self.delay_ms)

    def _taken(self, n):
        held = [tuple(r) for r in self.waiting.get()] if n else []
        self.waiting.clear()
        return held

    def _group(self, rows, number, closed_by, waited):
        names = [*self.schema.names, *(f.name for f in GROUP)]
        make = Row(*names)
        for row in rows:
            yield make(*row, number, closed_by, len(rows), waited)

    def _wake(self, at):
        """The only timer of the key is at ``at``."""
        known = list(self.handle.listTimers())
        for timer in known:
            if timer != at:
                self.handle.deleteTimer(timer)
        if at is not None and at not in known:
            self.handle.registerTimer(at)


def grouped(stream: DataFrame, size: int, delay_ms: int, key="partition") -> DataFrame:
    """The stream's rows with ``GROUP``, once their group is full or has waited. Needs the RocksDB state store (see ``land_groups``)."""
    if size < 1 or delay_ms < 0:
        raise ValueError("size must be at least 1 and delay_ms not negative")
    taken = {f.name for f in GROUP} & set(stream.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are added by the grouping")
    return stream.groupBy(key).transformWithState(SizeOrTime(stream.schema, size, delay_ms), StructType([*stream.schema.fields, *GROUP]), "Append", "ProcessingTime")


def land_groups(stream: DataFrame, path: str, checkpoint: str, trigger: dict, size: int, delay_ms: int, key="partition") -> StreamingQuery:
    """Rows of closed groups to ``path/rows`` by batch number, and a line per group to ``path/log``. A batch that is repeated
    replaces its own. A group leaves in one batch, so it is in one place.

    With the ``once`` trigger rows that neither filled a group nor waited long enough stay in the state for the next run.
    """
    def batch(df, number):
        rows = df.withColumn("batch_id", F.lit(number)).persist()
        try:
            replace_partitions(rows, f"{path}/rows", ["batch_id"])
            line = rows.groupBy(F.col(key).alias("key"), "group", "closed_by", "waited_ms", "batch_id").agg(F.count(F.lit(1)).alias("records"))
            replace_partitions(line, f"{path}/log", ["batch_id"])
        finally:
            rows.unpersist()

    settings = {STORE: ROCKSDB, IDLE: str("processingTime" in trigger).lower()}
    with _settings(stream.sparkSession, settings):
        return (
            grouped(stream, size, delay_ms, key).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(**trigger).foreachBatch(batch).start()
        )


@contextmanager
def _settings(spark: SparkSession, wanted: dict):
    """Settings of the queries started inside; a started query keeps its own copy."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
