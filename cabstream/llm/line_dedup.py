"""Line de-duplication with levelled sorted runs of line hashes."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstream.llm.common import SPACE, ascii_lower, discard, stored

KEY = ["h1", "h2"]


def split_lines(text: Column) -> Column:
    """Lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(lines: Column) -> Column:
    """Keys of lines: ASCII white space stripped at both ends, A-Z lower-cased."""
    return F.transform(lines, lambda line: ascii_lower(F.btrim(line, F.lit(SPACE))))


def hashes(value: Column) -> list[Column]:
    """128 bits: the value's XXH64 and the one chained to another start."""
    return [F.xxhash64(value).alias("h1"), F.xxhash64(F.lit("line"), value).alias("h2")]


class LineRuns:
    """In how many documents each line was found, as sorted runs in levels.

    A run is a table bucketed and sorted by the line's hash, so that runs merge
    without a shuffle. Each batch adds a run to the lowest level; `fanout` runs
    of a level are merged into one of the next. Lines that a run has settled
    (found in `settled` documents) are left out of later runs. Runs lie in the
    warehouse, which all executors share, and survive the loss of any of them.
    """

    def __init__(self, spark: SparkSession, settled: int, fanout: int = 2):
        self.spark, self.settled, self.fanout = spark, settled, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def add(self, counts: DataFrame) -> None:
        """Add a batch: rows (h1, h2, n), one per line."""
        for run in self._runs():
            done = self.spark.table(run).where(F.col("n") >= self.settled)
            counts = counts.join(done.select(*KEY), KEY, "left_anti")
        self._put(self._write(counts), 0)

    def counts(self) -> DataFrame:
        """Rows (h1, h2, n) over all runs; n is exact below `settled` and at least `settled` beyond."""
        runs = [self.spark.table(r) for r in self._runs()]
        return reduce(DataFrame.unionAll, runs).groupBy(*KEY).agg(F.sum("n").alias("n"))

    def drop(self) -> None:
        """Delete all runs."""
        for run in self._runs():
            self.spark.sql(f"drop table {run}")
        self.levels = []

    def _runs(self) -> list[str]:
        return [r for level in self.levels for r in level]

    def _put(self, run: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            old, self.levels[level] = self.levels[level], []
            merged = reduce(self._merge, [self.spark.table(r) for r in old])
            new = self._write(merged)
            for r in old:
                self.spark.sql(f"drop table {r}")
            self._put(new, level + 1)

    @staticmethod
    def _merge(left: DataFrame, right: DataFrame) -> DataFrame:
        total = F.coalesce(left["n"], F.lit(0)) + F.coalesce(right["n"], F.lit(0))
        return left.join(right, KEY, "full").select(*KEY, total.alias("n"))

    def _write(self, rows: DataFrame) -> str:
        name = f"cabstream_line_run_{uuid.uuid4().hex}"
        (rows.select(*KEY, "n").write.format("parquet").option("compression", "zstd")
         .bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name))
        return name


def document_counts(docs: DataFrame, batch: Column, text_col: str = "text", min_chars: int = 1) -> DataFrame:
    """Rows (batch, h1, h2, n): of each batch the rows of `docs` that hold a line key of at least `min_chars` code points."""
    keys = F.array_distinct(line_keys(split_lines(F.col(text_col))))
    found = docs.select(batch.alias("batch"), F.explode(keys).alias("key")).where(F.length("key") >= min_chars)
    return found.select("batch", *hashes(F.col("key"))).groupBy("batch", *KEY).agg(F.count(F.lit(1)).alias("n"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
                        min_chars: int = 1, batches: int = 4, fanout: int = 2) -> DataFrame:
    """`docs` with `kept_text`, `n_lines` (before) and `n_dropped` added; no row is lost.

    A line is dropped wherever it stands if its key (see `line_keys`) has at
    least `min_chars` code points and is found in at least `min_docs` rows of
    `docs`; a row counts once, repeated rows count each. Other lines stay as
    they are, joined by a line feed. A null or empty text is one empty line; a
    text whose lines all go becomes empty. Rows are counted in `batches` dealt
    by a hash of the id, null ids included, through `LineRuns`. An input column
    called kept_text, n_lines or n_dropped is replaced. An empty table gives no rows.

    What goes from a text depends on the text alone, so dropped positions are
    found and joined per text hash: copies, however many, share one row.
    """
    runs = LineRuns(docs.sparkSession, min_docs, fanout)
    batch = F.pmod(F.xxhash64(id_col), F.lit(batches)).cast("int")
    counts = stored(document_counts(docs, batch, text_col, min_chars), "line-counts")
    for i in range(batches):
        runs.add(counts.where(F.col("batch") == i).drop("batch"))
    discard(counts)
    repeated = stored(runs.counts().where(F.col("n") >= min_docs).select(*KEY), "repeated-lines")
    runs.drop()

    text = F.coalesce(F.col(text_col), F.lit(""))
    marks = [F.xxhash64(text).alias("__t1"), F.xxhash64(F.lit("text"), text).alias("__t2")]
    lines = docs.select(*marks, F.posexplode(line_keys(split_lines(F.col(text_col)))).alias("__at", "__key"))
    lines = lines.where(F.length("__key") >= min_chars).select("__t1", "__t2", "__at", *hashes(F.col("__key")))
    dropped = (lines.join(repeated, KEY, "left_semi").groupBy("__t1", "__t2")
               .agg(F.collect_set("__at").alias("__dropped")))
    # Stored, so that Spark can split the rows of a text that has very many copies.
    dropped = stored(dropped, "dropped-lines")

    rows = docs.drop("kept_text", "n_lines", "n_dropped").select("*", *marks)
    parts, gone = split_lines(F.col(text_col)), F.coalesce("__dropped", F.array().cast("array<int>"))
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone)
    kept = F.when(F.col("__dropped").isNull(), text).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n"))
    return (rows.join(dropped, ["__t1", "__t2"], "left")
            .withColumns({"kept_text": kept, "n_lines": F.size(parts).cast("long"),
                          "n_dropped": F.size(gone).cast("long")})
            .drop("__t1", "__t2", "__dropped"))
