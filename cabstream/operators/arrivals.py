"""Trip matching in the order of events: a request is served at once, or by the next vehicle that turns up near it.

A request takes the longest idle vehicle of the first zone on its search path
that has one. If none has, it waits: a vehicle that reports in a zone serves
the oldest waiting request that the zone is near to. After the timeout it is
unmatched. Each event depends on all events before it, so taken literally one
task would have to replay a whole city.

Here the time line is cut into slices, and all slices are replayed at once.
What a slice has to know of earlier ones is little: which of the vehicles that
were free before it began, and of the requests that waited then, have been used
or served meanwhile. The first round assumes that none has; slices for which
that turns out otherwise are replayed, until nothing changes. The first slice
that a round gets wrong has only right ones before it, and the next round gets
it right, so the end result is the sequential one. Slices are so long that
every vehicle reports several times in each, so what happened in a slice is
soon forgotten by the next ones, and a few rounds do. Where it isn't, each
round replays runs of slices twice as long as the one before, so the number of
rounds grows with the logarithm of that of the slices at most. A task streams
through its events and holds the free vehicles and waiting requests only.
"""

from __future__ import annotations

import heapq
import math
from collections import deque
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cabstream.functions.labels import is_available
from cabstream.operators.matching import with_eta
from cabstream.session import hadoop_path, ship_package, work_folder
from cabstream.sources.zones import CITY_ZONES, Zone

TIMEOUT_S = 5
#: Events of a slice: at least so many, and so many for each vehicle.
ROWS_PER_SLICE, REPORTS_PER_SLICE = 50_000, 8
SLICE = "slice"
WAITING, POOL, SEEN, ASKED = range(4)


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _discard(*tables: DataFrame) -> None:
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            files, where = hadoop_path(df.sparkSession, path)
            files.delete(where, True)


def reach(zones: Sequence[Zone]) -> tuple[dict[int, list[int]], dict[int, set[int]]]:
    """The search path of each origin, and of each zone the origins whose waiting requests its vehicles serve."""
    paths = {z.zone_id: list(dict.fromkeys((z.zone_id, *z.adjacency))) for z in zones}
    return paths, {z: set(path) for z, path in paths.items()}


def numbered_events(requests: DataFrame, pings: DataFrame, slices: int, pieces: int = 1) -> DataFrame:
    """All events with their number ``at`` in the order of time, cut into ``slices`` of about one size.

    Each slice is put in order in so many ``pieces``, to be no task's alone.

    Of one second vehicles come before requests, then ``seq`` and id decide.

    ``requests``: trip_id, origin_zone, requested_at (epoch seconds); ``pings``: taxi_id, zone_id, epoch_s, lat, lon,
    status; both may have ``seq``. Rows without a time, an id or a zone above 0 are no events. What else a request
    has is kept in ``request``. Of pings of a vehicle with one time, ``seq`` and zone one is an event.
    """
    def seq(df: DataFrame):
        return (F.col("seq") if "seq" in df.columns else F.lit(0)).cast("bigint").alias("seq")

    seen = pings.select(
        F.col("epoch_s").cast("bigint").alias("t"), F.lit(SEEN).alias("kind"), seq(pings),
        F.col("taxi_id").cast("string").alias("id"), F.col("zone_id").cast("int").alias("zone"),
        F.coalesce(is_available("status"), F.lit(False)).alias("available"), "lat", "lon")
    asked = requests.select(
        F.col("requested_at").cast("bigint").alias("t"), F.lit(ASKED).alias("kind"), seq(requests),
        F.col("trip_id").cast("string").alias("id"), F.col("origin_zone").cast("int").alias("zone"),
        F.struct(*[c for c in requests.columns if c not in ("trip_id", "requested_at")]).alias("request"))
    # A ping that is delivered again is no second event; requests are counted row by row.
    seen = seen.dropDuplicates(["t", "seq", "id", "zone"])
    events = seen.unionByName(asked, allowMissingColumns=True).where("t is not null and id != '' and zone > 0")
    order = ["t", "kind", "seq", "id", "zone"]
    return _stored(events.repartitionByRange(slices * pieces, *order).sortWithinPartitions(*order).withColumns(
        {"at": F.monotonically_increasing_id(), SLICE: F.floor(F.spark_partition_id() / pieces).cast("int")}), "arrival-events")


def _slices(events: DataFrame, timeout_s: int) -> DataFrame:
    """Rows of every slice: its events, the vehicles that may be free when it begins and the requests that may wait then."""
    line = events.select(SLICE, "at", F.col("kind").alias("step"), "t", "id", "zone", "available")
    ends = line.groupBy(SLICE).agg(F.min("t").alias("first_t"), F.max("t").alias("last_t"))
    last = ends.agg(F.max(SLICE)).first()[0]
    # Only a vehicle's last event in a slice can leave it free for later ones: one row per vehicle and slice.
    seen = line.where(F.col("step") == SEEN).groupBy(SLICE, "id").agg(
        F.max_by(F.struct("at", "step", "t", "zone", "available"), "at").alias("event"))
    until = F.coalesce(F.lead(SLICE).over(Window.partitionBy("id").orderBy(SLICE)), F.lit(last))
    pool = seen.withColumn("_until", until).where(F.col("event.available") & (F.col("_until") > F.col(SLICE))).select(
        F.explode(F.sequence(F.col(SLICE) + 1, F.col("_until"))).alias(SLICE), "id", "event.*")
    # The last slice that begins before a slice's requests have given up; one row per slice is put in order here.
    marks = ends.select("first_t", F.col(SLICE).alias("_begun"), F.lit(None).cast("int").alias(SLICE)).unionAll(
        ends.select(F.col("last_t") + timeout_s, F.lit(None).cast("int"), SLICE))
    so_far = Window.orderBy("first_t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    spans = marks.withColumn("_until", F.max("_begun").over(so_far)).where(F.col(SLICE).isNotNull())
    near = spans.where(F.col("_until") > F.col(SLICE)).select(
        SLICE, F.explode(F.sequence(F.col(SLICE) + 1, F.col("_until"))).alias("_later"))
    begun = ends.select(F.col(SLICE).alias("_later"), F.col("first_t").alias("_first_t"))
    waiting = line.where(F.col("step") == ASKED).join(near.join(begun, "_later"), SLICE).where(
        F.col("_first_t") <= F.col("t") + timeout_s).withColumn(SLICE, F.col("_later"))
    carried = pool.withColumn("step", F.lit(POOL)).select(*line.columns).unionByName(
        waiting.withColumn("step", F.lit(WAITING)).select(*line.columns))
    return line.unionByName(_stored(carried, "arrival-carried"))


class Replay:
    """The state of a city while the events of consecutive slices go by."""

    def __init__(self, paths: dict[int, list[int]], serves: dict[int, set[int]], timeout_s: int) -> None:
        self.paths, self.serves, self.timeout_s = paths, serves, timeout_s
        self.idle: dict[int, list[tuple[int, str, int]]] = {}
        self.free: dict[str, int] = {}
        self.queued, self.open, self.slice = 0, 0, 0
        #: Waiting requests by origin, the oldest first.
        self.waiting: dict[int, deque[tuple[int, int]]] = {}
        self.served: list[tuple[int, int, int, int, int]] = []

    def appears(self, car: str, zone: int, t: int, at: int) -> None:
        self.free[car] = at
        heapq.heappush(self.idle.setdefault(zone, []), (t, car, at))
        self.queued += 1
        if self.queued > 2 * len(self.free) + 1000:
            self.forget()

    def forget(self) -> None:
        """Take out of the queues what vehicles have reported since."""
        for zone, queue in self.idle.items():
            self.idle[zone] = [entry for entry in queue if self.free.get(entry[1]) == entry[2]]
            heapq.heapify(self.idle[zone])
        self.queued = sum(map(len, self.idle.values()))

    def waits(self, q: int, origin: int, t: int) -> None:
        self.waiting.setdefault(origin, deque()).append((q, t))
        self.open += 1

    def take(self, zone: int) -> int | None:
        """The longest idle vehicle of a zone leaves it."""
        queue = self.idle.get(zone, ())
        while queue:
            _t, car, at = heapq.heappop(queue)
            self.queued -= 1
            if self.free.get(car) == at:
                del self.free[car]
                return at
        return None

    def oldest(self, zone: int, t: int) -> deque[tuple[int, int]] | None:
        """The queue with the oldest request that a vehicle of the zone serves; requests that have given up leave theirs."""
        found = None
        for origin in self.serves.get(zone, (zone,)):
            queue = self.waiting.get(origin, ())
            while queue and queue[0][1] + self.timeout_s < t:
                queue.popleft()
                self.open -= 1
            if queue and (found is None or queue[0] < found[0]):
                found = queue
        return found

    def seen(self, car: str, zone: int, t: int, at: int, available: bool) -> None:
        self.free.pop(car, None)
        if available:
            self.appears(car, zone, t, at)
        while self.open and self.idle.get(zone) and (queue := self.oldest(zone, t)) is not None and (token := self.take(zone)) is not None:
            self.open -= 1
            self.served.append((self.slice, queue.popleft()[0], token, zone, t))

    def asked(self, q: int, origin: int, t: int) -> None:
        for zone in self.paths.get(origin, (origin,)):
            token = self.take(zone)
            if token is not None:
                self.served.append((self.slice, q, token, zone, t))
                return
        self.waits(q, origin, t)

    def event(self, step: int, at: int, t: int, name: str, zone: int, available: bool) -> None:
        if step == SEEN:
            self.seen(name, zone, t, at, available)
        elif step == ASKED:
            self.asked(at, zone, t)
        elif step == POOL:
            self.appears(name, zone, t, at)
        else:
            self.waits(at, zone, t)


def _replayed(due: DataFrame, runs: int, zones: Sequence[Zone], timeout_s: int) -> DataFrame:
    """The requests that runs of slices serve: (slice, q, token, matched_zone, matched_at).

    ``due`` has the number of the ``run`` with each row; each run is streamed through one task, what is there when
    it begins first.
    """
    paths, serves = reach(zones)
    names = [SLICE, "q", "token", "matched_zone", "matched_at"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        city, last = Replay(paths, serves, timeout_s), None
        for batch in batches:
            served = []
            values = (c.to_numpy(zero_copy_only=False).tolist() for c in batch.columns)
            city.served = served
            for run, city_slice, step, at, t, name, zone, available in zip(*values, strict=True):
                if run != last:
                    city, last = Replay(paths, serves, timeout_s), run
                    city.served = served
                city.slice = city_slice
                city.event(step, at, t, name, zone, available)
            columns = list(zip(*served, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    # Of requests the place in the line is enough.
    name = F.when(F.col("step").isin(POOL, SEEN), F.col("id"))
    lined = due.select("run", SLICE, "step", "at", "t", name, "zone", F.coalesce("available", F.lit(False))).repartitionById(
        runs, F.col("run")).sortWithinPartitions("run", F.col("step") > POOL, "at")
    return lined.mapInArrow(streamed, f"{SLICE} int, q bigint, token bigint, matched_zone int, matched_at bigint")


def _gone(slices: DataFrame, claims: DataFrame) -> DataFrame:
    """Of the vehicles and requests carried into a slice those that an earlier slice has used: (slice, step, at)."""
    used = claims.select(F.lit(POOL).alias("step"), F.col("token").alias("at"), F.col(SLICE).alias("_by")).unionAll(
        claims.select(F.lit(WAITING), "q", SLICE))
    first = used.groupBy("step", "at").agg(F.min("_by").alias("_by"))
    return slices.where(F.col("step") <= POOL).join(first, ["step", "at"]).where(F.col("_by") < F.col(SLICE)).select(
        SLICE, "step", "at")


def match_in_order(requests: DataFrame, pings: DataFrame, zones: Sequence[Zone] = CITY_ZONES, timeout_s: int = TIMEOUT_S,
                   rows_per_slice: int | None = None, eta_target: str = "destination") -> DataFrame:
    """One row per request with the vehicle it got, if any, as a replay of all events one by one gives it.

    See ``numbered_events`` for the inputs and the order of events. A vehicle is free in the zone of its last event
    if that is an available one, and comes back with its next event after it was used. A vehicle that reports in
    second ``requested_at + timeout_s`` still serves a waiting request. Ties between vehicles that were last seen in
    one second go by id. Rows that are no events have no row.

    ``rows_per_slice`` is by default so large that every vehicle reports several times in a slice.

    Adds ``taxi_id`` ('' without), ``matched``, ``matched_zone``, ``search_order`` (place of that zone on the search
    path, -1 without), ``matched_at``, ``vehicle_s`` and ``vehicle_seq`` (of the event that showed the vehicle free),
    ``eta_seconds``.
    """
    ship_package(requests.sparkSession)
    rows, vehicles = pings.agg(F.count(F.lit(1)), F.approx_count_distinct("taxi_id")).first()
    rows += requests.count()
    many = rows_per_slice or max(ROWS_PER_SLICE, REPORTS_PER_SLICE * vehicles)
    number = max(1, math.ceil(rows / many))
    events = numbered_events(requests, pings, number, max(1, many // ROWS_PER_SLICE))
    slices = _slices(events, timeout_s)

    def marks(gone: DataFrame) -> dict[int, tuple]:
        rows = gone.groupBy(SLICE).agg(F.bit_xor(F.xxhash64("step", "at")), F.count(F.lit(1))).collect()
        return {r[0]: tuple(r[1:]) for r in rows}

    gone, claims, then, changed, width = None, None, {}, list(range(number)), 1
    while changed:
        # By slice the first one of its run and the number of the run; a run ends with its block of ``width`` slices.
        starts, runs = [-1] * number, [-1] * number
        for i, (block, start) in enumerate({s // width: s for s in reversed(changed)}.items()):
            for s in range(start, min((block + 1) * width, number)):
                starts[s], runs[s] = start, i
        start = F.get(F.lit(starts), F.col(SLICE))
        due = slices.where((start == F.col(SLICE)) | (start >= 0) & (F.col("step") > POOL))
        if gone is not None:
            due = due.join(gone, [SLICE, "step", "at"], "left_anti")
        fresh = _replayed(due.withColumn("run", F.get(F.lit(runs), F.col(SLICE))), max(runs) + 1, zones, timeout_s)
        if claims is not None:
            fresh = fresh.unionByName(claims.where(start < 0))
        before = [df for df in (claims, gone) if df is not None]
        claims = _stored(fresh, "arrival-claims")
        if number == 1:
            break
        gone = _stored(_gone(slices, claims), "arrival-gone")
        now = marks(gone)
        # A run's later slices were replayed from what its first one left, whatever was known of them before.
        changed = [s for s in range(number) if now.get(s) != then.get(s) and starts[s] in (-1, s)]
        then, width = now, 2 * width
        _discard(*before)

    asked = events.where(F.col("kind") == ASKED).select(
        F.col("at").alias("q"), F.col("t").alias("requested_at"), F.col("id").alias("trip_id"), "request.*")
    cars = events.where(F.col("kind") == SEEN).select(
        F.col("at").alias("token"), F.col("id").alias("taxi_id"), F.col("t").alias("vehicle_s"),
        F.col("seq").alias("vehicle_seq"), "lat", "lon")
    used = claims.drop(SLICE).join(cars, "token")
    rows = asked.join(used, "q", "left").withColumnRenamed("destination_zone", "dest_zone")
    lookup = F.expr("map(" + ", ".join(
        f"{z.zone_id}, array({', '.join(map(str, dict.fromkeys((z.zone_id, *z.adjacency))))})" for z in zones) + ")")
    order = F.array_position(F.element_at(lookup, F.col("origin_zone").cast("int")), F.col("matched_zone")) - 1
    out = rows.withColumns({
        "matched": F.col("token").isNotNull(),
        "search_order": F.when(F.col("matched_zone") == F.col("origin_zone"), 0).otherwise(
            F.coalesce(order, F.lit(-1))).cast("int"),
        "matched_zone": F.coalesce("matched_zone", F.lit(0)), "taxi_id": F.coalesce("taxi_id", F.lit(""))})
    return with_eta(out, zones, eta_target).drop("q", "token", "lat", "lon")
