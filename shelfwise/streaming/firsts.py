"""First record per key of a growing feed, in feed order, with state for new keys only.

Feed order is the batch a file arrives in, then the order columns, null first. A record is emitted
if its key is neither in the stored table nor in the state; the state holds a key from the batch that emits it
until a later run finds it in the table. Each run

1. folds what an earlier run emitted but did not store into the table, so a run that broke off
   is made up for,
2. streams the new files: rows are reduced to one per key and Arrow batch, rows of stored keys go by an anti
   join with the table (bucketed by the key, so it is not shuffled), and the rest meet the state,
3. folds its own records into the table.

Timers drop state: they fire after `hold_ms` and clear keys of earlier runs, which the table has by then; keys of
the run itself get a new timer. So the clock decides when memory is given back, never which
record is kept. A batch that is replayed finds its records stored, or emits the same ones again.

Rows without a key are left out. The order columns are numbers or texts, unique within a key and a batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfwise.sources.stored import KeyedTable

# Timers by the clock would otherwise call for empty batches without end; they fire with the next batch that has rows.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
HOLD_MS = 3_600_000


def firsts_of_batches(key: str, order: Sequence[str]):
    """Arrow batches -> the first row of each key of a batch: a key with a third of all rows is a row a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = pc.sort_indices(batch, sort_keys=[(o, "ascending") for o in order], null_placement="at_start")
            numbers = pc.dictionary_encode(batch.column(key).take(place)).indices
            at = pa.table({"number": numbers, "place": place}).group_by("number", use_threads=False).aggregate([("place", "first")])
            yield batch.take(at["place_first"].combine_chunks())

    return run


def emit_new(run: int, order: Sequence[str], hold_ms: int):
    """Group state -> the first record of a key that it does not hold; it notes the run that emitted it."""
    by = [part for o in order for part in _parts(o)]

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            if state.get[0] < run:
                state.remove()
            else:
                state.setTimeoutDuration(hold_ms)
            return
        # A frame is an Arrow batch; only the first row of each stays.
        first = min((f.sort_values(by).iloc[0] for f in frames), key=lambda r: tuple(r[c] for c in by))
        if not state.exists:
            state.update((run,))
            yield pd.DataFrame({"record": [first["record"]]})
        state.setTimeoutDuration(hold_ms)

    return step


def _parts(name: str) -> tuple[str, str]:
    return f"_known_{name}", f"_value_{name}"


def _placed(name: str, kind: T.DataType) -> list[Column]:
    """An order column as two that are never null, so that no long turns into a double on its way."""
    known, value = _parts(name)
    c = F.col(name)
    return [c.isNotNull().alias(known), F.coalesce(c, F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind)).alias(value)]


@contextmanager
def stream_settings(spark: SparkSession):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class FirstRecords:
    """First records below `root`: the stored table, records emitted by runs, and the stream's progress."""

    def __init__(
        self, spark: SparkSession, feed_dir: str, schema: T.StructType, key: str, order: Sequence[str], root: str,
        buckets: int | None = None, hold_ms: int = HOLD_MS, files_per_batch: int | None = None,
    ):
        self.spark, self.feed_dir, self.schema, self.key, self.order = spark, feed_dir, schema, key, list(order)
        self.root, self.hold_ms, self.files_per_batch = root.rstrip("/"), max(1, hold_ms), files_per_batch
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = KeyedTable(spark, f"{self.root}/table", schema, key, buckets)
        self.state_rows: list[int] = []

    def advance(self) -> FirstRecords:
        """Take in the files that are new since the last call."""
        self._fold()
        run = len(self.table.versions())
        with stream_settings(self.spark):
            query = (
                self._new_records(run).writeStream.outputMode("append").option("checkpointLocation", f"{self.root}/progress")
                .foreachBatch(lambda batch, number: self.emit(batch, run, number)).trigger(availableNow=True).start())
            try:
                query.awaitTermination()
            finally:
                self.state_rows = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
        self._fold()
        return self

    def read(self) -> DataFrame:
        return self.table.read()

    def emit(self, batch: DataFrame, run: int, number: int) -> None:
        """A replayed batch overwrites its own folder."""
        batch.write.mode("overwrite").parquet(f"{self._emitted(run)}/batch={number}")

    def _new_records(self, run: int) -> DataFrame:
        reader = self.spark.readStream.schema(self.schema)
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        rows = reader.json(self.feed_dir).where(F.col(self.key).isNotNull())
        rows = rows.mapInArrow(firsts_of_batches(self.key, self.order), self.schema)
        unknown = rows.join(self.table.read().select(self.key), self.key, "left_anti").select(*self.schema.names)
        places = [c for o in self.order for c in _placed(o, self.schema[o].dataType)]
        records = unknown.select(F.col(self.key).alias("_key"), *places, F.to_json(F.struct(*self.schema.names)).alias("record"))
        new = records.groupBy("_key").applyInPandasWithState(
            emit_new(run, self.order, self.hold_ms), "record string", "run int", "append", GroupStateTimeout.ProcessingTimeTimeout)
        return new.select(F.from_json("record", self.schema).alias("r")).select("r.*")

    def _emitted(self, run: int) -> str:
        return f"{self.root}/emitted/run={run}"

    def _fold(self) -> None:
        """The next version of the table, if a run emitted records for it. Each run has a version of its own."""
        path = self._emitted(len(self.table.versions()))
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return
        records = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
        self.table.insert_ignore(records, ["batch", *self.order])
