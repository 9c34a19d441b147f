"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator relies on.

    All event times are UTC. Adaptive execution coalesces small shuffle
    partitions, splits skewed join partitions and switches a join to a
    broadcast once the measured size of one side is below Spark's threshold,
    so no operator carries a broadcast hint of its own.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder, seen by every executor, for data that must outlive one.

    Clusters name a shared folder in ``spark.checkpoint.dir``. Where it is unset
    the warehouse is used, which executors have to share as well; a warehouse
    on a local disk will do only where driver and executors are one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and warehouse.startswith(("file:", "/")):
            raise ValueError("executors may not see the warehouse; name a shared folder in spark.checkpoint.dir")
        shared = f"{warehouse}/_work"
    path = f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _made(spark).append(path)
    return path


def _made(spark: SparkSession) -> list[str]:
    context = spark.sparkContext
    if not hasattr(context, "_cabstream_folders"):
        context._cabstream_folders = []
    return context._cabstream_folders


def drop_work(spark: SparkSession) -> None:
    """Delete all folders that ``work_folder`` has given out here, once no result is read any more that lies in them."""
    folders = _made(spark)
    while folders:
        files, where = hadoop_path(spark, folders.pop())
        files.delete(where, True)


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path and the path itself, as the JVM knows them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver found it.

    The package is put as a zip file into the shared folder and added to the
    session once. Call it before a job whose functions run in Python workers.
    """
    context = spark.sparkContext
    if getattr(context, "_cabstream_shipped", False):
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, f"{root.name}/{file.relative_to(root)}")
    path = f"{work_folder(spark, 'package')}/{root.name}.zip"
    files, where = hadoop_path(spark, path)
    stream = files.create(where)
    stream.write(packed.getvalue())
    stream.close()
    context.addPyFile(path)
    context._cabstream_shipped = True
