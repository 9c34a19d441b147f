"""Publishing of stored results, every row once, whatever breaks in between.

Results are stored before anything is published. For each result and each
route (a topic, a folder) the outbox notes when publishing began and when it
was done, both as files in the shared folder. A run that broke off leaves a
route that has begun and isn't done: the next run asks the route what arrived
and sends the rest. So neither a crash between two routes, nor one between
sending and noting it, nor one in the middle of a send loses or repeats a row.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabstream.session import hadoop_path
from cabstream.sources import sinks

#: Column that tells in every published row which result it belongs to.
PUBLISHED_IN = "published_in"
#: Milliseconds by which clocks of the broker and of this machine may differ.
CLOCK_SKEW_MS = 60_000


@dataclass(frozen=True)
class Route:
    """Where part of a result goes.

    ``pick`` takes its rows from a result; ``key`` names columns that tell the
    rows of one result apart. ``send`` publishes rows, each with PUBLISHED_IN.
    ``arrived`` gives the keys of a result that are there already, from the
    result's number, the time in ms at which its publishing began and the types
    of the key; without it the route's ``send`` has to replace what an earlier
    send of that result left.
    """

    pick: Callable[[DataFrame], DataFrame]
    key: Sequence[str]
    send: Callable[[DataFrame], None]
    arrived: Callable[[int, int, T.StructType], DataFrame] | None = None


class Outbox:
    """Publishes results in ascending order of their numbers; may be called again at any time."""

    def __init__(self, spark: SparkSession, folder: str, routes: dict[str, Route]) -> None:
        self.spark, self.folder, self.routes = spark, folder, routes

    def publish(self, numbers: Iterable[int], result: Callable[[int], DataFrame]) -> list[int]:
        """Send what isn't published of the results with these numbers; returns those that had something left to do."""
        done = {name: self._marks(f"done/{name}") for name in self.routes}
        left = sorted(n for n in numbers if any(n not in marks for marks in done.values()))
        for number in left:
            for name, route in self.routes.items():
                if number not in done[name]:
                    self._send(route, name, number, result(number))
        return left

    def _send(self, route: Route, name: str, number: int, result: DataFrame) -> None:
        rows = route.pick(result).withColumn(PUBLISHED_IN, F.lit(number).cast("bigint"))
        began = self._marks(f"begun/{name}")
        if number not in began:
            self._mark(f"begun/{name}", number)
        elif route.arrived is not None:
            kinds = T.StructType([rows.schema[k] for k in route.key])
            there = route.arrived(number, began[number] - CLOCK_SKEW_MS, kinds).select(
                *[F.col(k).alias(f"_{k}") for k in route.key])
            same = [rows[k].eqNullSafe(there[f"_{k}"]) for k in route.key]
            rows = rows.join(there.distinct(), same, "left_anti")
        route.send(rows)
        self._mark(f"done/{name}", number)

    def _marks(self, kind: str) -> dict[int, int]:
        """Numbers noted, with the time in ms of the note."""
        files, where = hadoop_path(self.spark, f"{self.folder}/{kind}")
        if not files.exists(where):
            return {}
        names = (s.getPath().getName().split("_") for s in files.listStatus(where))
        return {int(n[0]): int(n[1]) for n in names if len(n) == 2 and n[0].lstrip("-").isdigit()}

    def _mark(self, kind: str, number: int) -> None:
        files, where = hadoop_path(self.spark, f"{self.folder}/{kind}/{number}_{int(time.time() * 1000)}")
        files.create(where, True).close()


def folder_route(pick: Callable[[DataFrame], DataFrame], key: Sequence[str], path: str) -> Route:
    """Parquet below ``path``, one folder per result; sending again replaces the folder."""

    def send(rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PUBLISHED_IN).parquet(path)

    return Route(pick, key, send)


def topic_route(spark: SparkSession, servers: str, topic: str, pick: Callable[[DataFrame], DataFrame],
                key: Sequence[str]) -> Route:
    """JSON messages to a broker topic; after a crash the topic is read from the time at which publishing began."""
    options = {"kafka.bootstrap.servers": servers}

    def send(rows: DataFrame) -> None:
        sinks.to_json_events(rows, key[0]).write.format("kafka").options(**options).option("topic", topic).save()

    def arrived(number: int, since_ms: int, kinds: T.StructType) -> DataFrame:
        found = spark.read.format("kafka").options(**options).options(
            subscribe=topic, startingTimestamp=str(since_ms), startingOffsetsByTimestampStrategy="latest").load()
        fields = T.StructType([*kinds.fields, T.StructField(PUBLISHED_IN, T.LongType())])
        parsed = found.select(F.from_json(F.col("value").cast("string"), fields).alias("m"))
        return parsed.select("m.*").where(F.col(PUBLISHED_IN) == number)

    return Route(pick, key, send, arrived)
