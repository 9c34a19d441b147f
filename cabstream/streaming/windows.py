"""Event-time windows of a stream that are computed once, from all their rows, after they have closed.

Micro-batches only stage rows in a shared folder. A window closes when the
event clock has passed its end by the allowed lateness; then its rows, whatever
files and batches they came in, go through the batch operator, and what later
windows need is carried on as a table. So results don't depend on how the
source cuts its batches, no state lives in one task, and everything survives
the loss of executors and restarts.

Each source (a topic, a partition of it) has an event clock of its own, the
largest event time it has sent. The windows follow the slowest source, so a
source that lags loses no row; one that has sent nothing for ``idle_s`` seconds
of wall time is left out, so a silent source holds nothing back.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstream.session import hadoop_path
from cabstream.sources.sinks import batch_folder

#: Rows of the closed windows and what was carried to them give the result; from the stored
#: result comes what is carried on. The number is the end of the windows in epoch seconds.
Compute = Callable[[DataFrame, "DataFrame | None", int], DataFrame]
Carry = Callable[[DataFrame, DataFrame, "DataFrame | None", int], DataFrame]
NEVER = -(1 << 62)
CLOCKS = "source string, clock bigint, seen_s double"


class StagedWindows:
    """Windows of ``window_s`` seconds of a stream with epoch seconds in column ``time``.

    ``compute`` sees all rows of the windows that close together, or of one
    window at a time if ``stepwise``. Rows of a window that had closed before
    their batch first came are late and kept apart, as are rows without a time.
    ``source`` names the column that tells sources apart (by default there is
    one); it stays in the rows. ``now`` is the wall clock in seconds.
    """

    def __init__(self, spark: SparkSession, folder: str, compute: Compute, carry: Carry | None = None,
                 time: str = "epoch_s", window_s: int = 300, lateness_s: int = 60, stepwise: bool = False,
                 source: str | None = None, idle_s: float = 30, now: Callable[[], float] = time.time) -> None:
        self.spark, self.folder, self.compute, self.carry = spark, folder, compute, carry
        self.time, self.window_s, self.lateness_s, self.stepwise = time, window_s, lateness_s, stepwise
        self.source, self.idle_s, self.now = source, idle_s, now

    def stage(self, batch: DataFrame, batch_id: int) -> None:
        """Store a micro-batch; a batch delivered again replaces itself and is judged as when it first came."""
        bounds = self._numbers("bounds", "_")
        if batch_id not in bounds:
            bounds[batch_id] = [(self._closed() or [NEVER])[-1]]
            self._mark(f"bounds/{batch_id}_{bounds[batch_id][0]}")
            for old in (n for n in bounds if n < batch_id - 1):  # only the last batch can come again
                self._delete(f"bounds/{old}_{bounds[old][0]}")
        start = (F.floor(F.col(self.time) / self.window_s) * self.window_s).cast("bigint")
        rows = batch.withColumn("_window", start).withColumn(
            "_late", F.col("_window").isNull() | (F.col("_window") < bounds[batch_id][0])).withColumn(
            "batch_id", F.lit(batch_id).cast("bigint"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_late", "batch_id").parquet(
            f"{self.folder}/rows")
        self._stage_clocks(batch_id)

    def clocks(self) -> DataFrame:
        """Per source its event clock and the wall time at which a row of it last came."""
        ids = self._numbers("clocks", "=")
        if not ids:
            return self._no_clocks()
        return self.spark.read.schema(CLOCKS).parquet(batch_folder(f"{self.folder}/clocks", max(ids)))

    def _no_clocks(self) -> DataFrame:
        return self.spark.range(0).select(F.lit("").alias("source"), F.lit(0).cast("bigint").alias("clock"), F.lit(0.0).alias("seen_s"))

    def clock(self) -> int | None:
        """The event clock: the smallest of the sources that aren't idle, the largest of all if every one is."""
        alive = F.col("seen_s") > self.now() - self.idle_s
        slowest, largest = self.clocks().agg(F.min(F.when(alive, F.col("clock"))), F.max("clock")).first()
        return largest if slowest is None else slowest

    def close(self, everything: bool = False) -> list[int]:
        """Compute the windows that have closed; all of them at the end of a replay. Returns their ends."""
        rows = self._staged()
        if rows is None:
            return []
        closed = self._closed()
        open_rows = rows.where(F.col("_window") >= closed[-1]) if closed else rows
        first, last = open_rows.agg(F.min("_window"), F.max("_window")).first()
        if last is None:
            return []
        until = last + self.window_s if everything else self._due()
        if until <= first:
            return []
        due = open_rows.where(F.col("_window") < until)
        if self.stepwise:
            ends = [r[0] + self.window_s for r in due.select("_window").distinct().orderBy("_window").collect()]
        else:
            ends = [until]
        for end in ends:
            part = due.where(F.col("_window") == end - self.window_s) if self.stepwise else due
            self._finish(part.drop("_window", "batch_id"), end)
        self._drop_rows(rows, ends[-1])
        return ends

    def ends(self) -> list[int]:
        """Ends of the closed windows whose results are stored, in order; they number the results."""
        return self._closed()

    def result(self, end: int) -> DataFrame:
        """The result with this end, as stored."""
        return self.spark.read.parquet(f"{self.folder}/results/upto={end}")

    def results(self, spark: SparkSession | None = None) -> DataFrame:
        """Rows of all closed windows, as a table of a session."""
        paths = [f"{self.folder}/results/upto={end}" for end in self._closed()]
        return (spark or self.spark).read.parquet(*paths)

    def late(self) -> DataFrame | None:
        """Rows that came after their window had closed."""
        rows = self._rows("true")
        return None if rows is None else rows.drop("_window", "batch_id")

    def _due(self) -> int:
        clock = self.clock()
        return NEVER if clock is None else (clock - self.lateness_s) // self.window_s * self.window_s

    def _finish(self, rows: DataFrame, end: int) -> None:
        closed = self._closed()
        carried = None
        if self.carry is not None and closed:
            carried = self.spark.read.parquet(f"{self.folder}/carried/upto={closed[-1]}")
        where = f"{self.folder}/results/upto={end}"
        result = self.compute(rows, carried, end)
        result.write.mode("overwrite").parquet(where)
        if self.carry is not None:
            stored = self.spark.read.schema(result.schema).parquet(where)
            self.carry(stored, rows, carried, end).write.mode("overwrite").parquet(f"{self.folder}/carried/upto={end}")
        # What was written counts from here on; a step that broke off before is done again.
        self._mark(f"closed/{end}")

    def _staged(self) -> DataFrame | None:
        return self._rows("false")

    def _rows(self, late: str) -> DataFrame | None:
        files, where = hadoop_path(self.spark, f"{self.folder}/rows/_late={late}")
        if not files.exists(where) or not files.listStatus(where):
            return None
        return self.spark.read.parquet(f"{self.folder}/rows/_late={late}").withColumn("batch_id", F.col("batch_id").cast("bigint"))

    def _stage_clocks(self, batch_id: int) -> None:
        """The clocks after a batch: those after the one before, moved on by its rows, late ones too."""
        name = F.coalesce(F.col(self.source).cast("string"), F.lit("")) if self.source else F.lit("")
        found = [rows.where(F.col("batch_id") == batch_id).select(name.alias("source"), F.col(self.time).cast("bigint").alias("clock"))
                 for rows in (self._rows("false"), self._rows("true")) if rows is not None]
        ids = [n for n in self._numbers("clocks", "=") if n < batch_id]
        before = self._no_clocks() if not ids else self.spark.read.schema(CLOCKS).parquet(
            batch_folder(f"{self.folder}/clocks", max(ids)))
        for rows in found:
            before = before.unionByName(rows.withColumn("seen_s", F.lit(float(self.now()))))
        after = before.groupBy("source").agg(F.max("clock").alias("clock"), F.max("seen_s").alias("seen_s"))
        after.coalesce(1).write.mode("overwrite").parquet(batch_folder(f"{self.folder}/clocks", batch_id))
        for old in sorted(ids)[:-1]:
            self._delete(batch_folder("clocks", old))

    def _closed(self) -> list[int]:
        return sorted(self._numbers("closed"))

    def _numbers(self, kind: str, mark: str | None = None) -> dict[int, list[int]]:
        """Numbers that name the files or folders of one kind: ``5``, ``5_7`` (5 with 7) or ``batch_id=5``."""
        files, where = hadoop_path(self.spark, f"{self.folder}/{kind}")
        if not files.exists(where):
            return {}
        names = (s.getPath().getName() for s in files.listStatus(where))
        parts = [n.removeprefix("batch_id=").split("_") if mark else [n] for n in names if not n.startswith((".", "_"))]
        return {int(p[0]): [int(x) for x in p[1:]] for p in parts if all(x.lstrip("-").isdigit() for x in p)}

    def _mark(self, name: str) -> None:
        files, where = hadoop_path(self.spark, f"{self.folder}/{name}")
        files.create(where, True).close()

    def _delete(self, name: str) -> None:
        files, where = hadoop_path(self.spark, f"{self.folder}/{name}")
        files.delete(where, True)

    def _drop_rows(self, rows: DataFrame, end: int) -> None:
        """Delete staged batches of which no row is needed any more; late rows lie apart and stay."""
        done = rows.groupBy("batch_id").agg(F.max("_window").alias("last")).where(F.col("last") < end)
        for row in done.collect():
            self._delete(batch_folder("rows/_late=false", row["batch_id"]))


class CorrectedWindows(StagedWindows):
    """Windows whose results are put right when late rows come: retractions instead of losses.

    ``compute`` must judge each window by its own rows, and ``window_of`` gives
    a result row's place in time in epoch seconds. A late row opens its window
    again for ``keep_s`` seconds of event time; the window is computed anew
    from all its rows, and what changed goes out as rows to delete and rows to
    insert, with a version that grows. In whatever order rows are delivered,
    the results end up as the batch operator has them. Rows that come even later
    change nothing; ``late`` has them, as all rows that came late.
    """

    def __init__(self, *args, window_of: Column | None = None, keep_s: int = 86_400, **options) -> None:
        super().__init__(*args, **options)
        if self.carry is not None or self.stepwise:
            raise ValueError("windows that depend on earlier ones can't be computed again on their own")
        self.window_of = F.unix_timestamp("window_start") if window_of is None else window_of
        self.keep_s = keep_s

    def close(self, everything: bool = False) -> list[int]:
        """Compute the windows that have closed and those that late rows have opened again; returns new versions."""
        parts = [r for r in (self._rows("false"), self._rows("true")) if r is not None]
        if not parts:
            return []
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        rows = rows.where("_window is not null")
        versions = self._versions()
        number = versions[-1][0] + 1 if versions else 0
        bound, seen = versions[-1][1:] if versions else (NEVER, -1)
        last, newest = rows.agg(F.max("_window"), F.max("batch_id")).first()
        if last is None:
            return []
        until = max(bound, last + self.window_s if everything else self._due())
        kept = until - self.keep_s
        fresh = rows.where(F.col("batch_id") > seen) if seen >= 0 else rows
        wanted = fresh.where((F.col("_window") < bound) & (F.col("_window") >= kept)).select("_window")
        wanted = wanted.unionByName(rows.where((F.col("_window") >= bound) & (F.col("_window") < until)).select("_window")).distinct()
        if wanted.isEmpty():
            return []
        path = f"{self.folder}/versions/{number}"
        wanted.write.mode("overwrite").parquet(f"{path}/windows")
        wanted = self.spark.read.parquet(f"{path}/windows")
        due = rows.join(wanted, "_window", "left_semi").drop("_window", "batch_id")
        result = self.compute(due, None, until)
        place = (F.floor(self.window_of / self.window_s) * self.window_s).cast("bigint")
        result.withColumn("_window", place).write.mode("overwrite").parquet(f"{path}/rows")
        new = self.spark.read.parquet(f"{path}/rows")
        changes = new.withColumn("op", F.lit("insert"))
        if versions:
            old = self._current(versions).join(wanted, "_window", "left_semi").select(*new.columns)
            changes = new.exceptAll(old).withColumn("op", F.lit("insert")).unionByName(
                old.exceptAll(new).withColumn("op", F.lit("delete")))
        changes.drop("_window").withColumn("version", F.lit(number)).write.mode("overwrite").parquet(f"{path}/changes")
        self._mark(f"closed/{until}")
        self._mark(f"versions/done/{number}_{until}_{newest}")
        self._drop_rows(rows, kept)
        return [number]

    def ends(self) -> list[int]:
        return [v[0] for v in self._versions()]

    def result(self, end: int) -> DataFrame:
        """The changes of a version: columns of the result, ``op`` (delete or insert) and ``version``."""
        return self.spark.read.parquet(f"{self.folder}/versions/{end}/changes")

    def results(self, spark: SparkSession | None = None) -> DataFrame:
        """The rows as they stand now."""
        return self._current(self._versions(), spark).drop("_window")

    def changes(self) -> DataFrame:
        """All rows to delete and to insert so far; in order of ``version`` they make up the results."""
        return self.spark.read.parquet(*[f"{self.folder}/versions/{v[0]}/changes" for v in self._versions()])

    def _versions(self) -> list[tuple[int, int, int]]:
        """(version, end of the windows closed, last batch seen) of every version that is complete."""
        return sorted((n, *more) for n, more in self._numbers("versions/done", "_").items() if len(more) == 2)

    def _current(self, versions: list[tuple[int, int, int]], spark: SparkSession | None = None) -> DataFrame:
        read = (spark or self.spark).read

        def all_of(kind: str) -> DataFrame:
            found = [read.parquet(f"{self.folder}/versions/{v[0]}/{kind}").withColumn("_version", F.lit(v[0])) for v in versions]
            out = found[0]
            for more in found[1:]:
                out = out.unionByName(more)
            return out

        last = all_of("windows").groupBy("_window").agg(F.max("_version").alias("_version"))
        return all_of("rows").join(last, ["_window", "_version"], "left_semi").drop("_version")
