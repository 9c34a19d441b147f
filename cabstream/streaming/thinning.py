"""Live thinning of pings as columns: micro-batches in, kept pings out, one number per vehicle in between."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstream.operators.thinning import THIN_INTERVAL_S, thin_by_interval
from cabstream.session import hadoop_path
from cabstream.sources.sinks import batch_folder

STATE = "taxi_id string, last bigint, newest bigint"


class LiveThinning:
    """``foreachBatch`` target that keeps a ping if it is ``interval_s`` or more away from the last kept one of its vehicle.

    A micro-batch is taken in the order of time, ties by ``order``. Until a
    vehicle has a ping at that distance from the one kept last, before or
    after it, as late pings are compared like any other, its pings go; from
    there on the batch is thinned by itself, as ``thin_by_interval`` does it
    for a history. So there is no loop over rows and no group larger than a
    vehicle's chunk of time.

    State is one row per vehicle, a table written anew with each batch: the
    time kept last and, in every row, the newest time seen. A batch that comes
    again starts from the state before it and replaces its result and state.
    ``drop_late`` drops pings more than ``lateness_s`` seconds behind the newest of
    earlier batches; ``forget_s`` drops the state of vehicles that are so far behind.
    """

    def __init__(self, spark: SparkSession, folder: str, time: str = "timestamp", order: Sequence[str] = (),
                 interval_s: int = THIN_INTERVAL_S, drop_late: bool = False, lateness_s: int = 180,
                 forget_s: int | None = None) -> None:
        self.spark, self.folder, self.time, self.order, self.interval_s = spark, folder, time, list(order), interval_s
        self.drop_late, self.lateness_s, self.forget_s = drop_late, lateness_s, forget_s

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self._state(batch_id)
        t = F.col(self.time).cast("bigint")
        rows = batch
        newest = before.agg(F.max("newest")).first()[0]
        if self.drop_late and newest is not None:
            rows = rows.filter(t >= newest - self.lateness_s)
        last = before.select("taxi_id", "last")
        away = F.col("last").isNull() | (F.abs(t - F.col("last")) >= self.interval_s)
        begins = rows.select("taxi_id", self.time).join(last, "taxi_id", "left").filter(away) \
            .groupBy("taxi_id").agg(F.min(t).alias("_from"))
        due = rows.join(begins, "taxi_id").filter(t >= F.col("_from")).drop("_from").select(*batch.columns)
        kept = thin_by_interval(due, time=self.time, order_by=self.order, interval=self.interval_s)
        kept.write.mode("overwrite").parquet(batch_folder(f"{self.folder}/kept", batch_id))
        stored = self.result(batch_id)
        seen = batch.agg(F.max(t)).first()[0]
        newest = max([n for n in (newest, seen) if n is not None], default=None)
        now = stored.groupBy("taxi_id").agg(F.max(t).alias("_now"))
        after = last.join(now, "taxi_id", "full").select(
            "taxi_id", F.coalesce("_now", "last").alias("last"), F.lit(newest).cast("bigint").alias("newest"))
        if self.forget_s is not None and newest is not None:
            after = after.filter(F.col("last") >= newest - self.forget_s)
        after.write.mode("overwrite").parquet(batch_folder(f"{self.folder}/state", batch_id))
        # Only the last batch can come again, so older states are done with.
        for old in [n for n in self._batches("state") if n < batch_id - 1]:
            files, where = hadoop_path(self.spark, batch_folder(f"{self.folder}/state", old))
            files.delete(where, True)

    def batches(self) -> list[int]:
        """Batches whose result and state are stored, in order."""
        return self._batches("kept")

    def result(self, batch_id: int) -> DataFrame:
        return self.spark.read.parquet(batch_folder(f"{self.folder}/kept", batch_id))

    def results(self, spark: SparkSession | None = None) -> DataFrame:
        return (spark or self.spark).read.parquet(f"{self.folder}/kept").drop("batch_id")

    def _state(self, batch_id: int) -> DataFrame:
        earlier = [n for n in self._batches("state") if n < batch_id]
        if not earlier:
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(batch_folder(f"{self.folder}/state", earlier[-1]))

    def _batches(self, kind: str) -> list[int]:
        files, where = hadoop_path(self.spark, f"{self.folder}/{kind}")
        if not files.exists(where):
            return []
        names = (s.getPath().getName().removeprefix("batch_id=") for s in files.listStatus(where))
        done = [int(n) for n in names if n.lstrip("-").isdigit()]
        return sorted(n for n in done if files.exists(hadoop_path(self.spark, f"{self.folder}/{kind}/batch_id={n}/_SUCCESS")[1]))
