"""Shared storage used to pin intermediate tables.

Model replies must not be computed twice, and running ids need a fixed row
placement, so both are written to the shared folder the cluster names in
``spark.checkpoint.dir`` and read back.  That survives the loss of executors,
unlike cached blocks.  Where it is unset, a folder below the warehouse serves.
``scratch`` deletes what a job wrote when its results are no longer needed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_UNKNOWN_SIZE = 1 << 60  # Spark's estimate for a table it knows nothing about is larger


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from the session."""
    configured = spark.sparkContext.getConf().get(_SETTING) or spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    active = spark.sparkContext.getCheckpointDir()
    if active:
        return active.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    one_machine = spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master
    if not one_machine and (warehouse.startswith("file:") or ":" not in warehouse):
        raise ValueError(f"set {_SETTING} to a folder all executors share")
    return f"{warehouse}/specflow-tables"


_runs: list[str] = []


def table_path(spark: SparkSession, label: str) -> str:
    """A new, unused location below the shared folder for this application, and for the ``scratch`` run in progress."""
    app = spark.sparkContext.applicationId
    run = f"/{_runs[-1]}" if _runs else ""
    return f"{shared_dir(spark)}/specflow-{app}{run}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Tables written inside are deleted at the end: use or write the results before."""
    run = f"run-{uuid.uuid4().hex}"
    folder = f"{shared_dir(spark)}/specflow-{spark.sparkContext.applicationId}/{run}"
    _runs.append(run)
    try:
        yield folder
    finally:
        _runs.remove(run)
        fs, path = hadoop_path(spark, folder)
        fs.delete(path, True)


def materialize(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Run ``df`` once, keep its rows as Parquet, and continue from the files."""
    spark = df.sparkSession
    path = path or table_path(spark, label)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions_for(df: DataFrame) -> int:
    """How many tasks the bytes behind ``df`` ask for, by the size statistics of its plan.

    One task per ``spark.sql.files.maxPartitionBytes`` of the tables it reads, as their
    scans have, and at least one per core.  (Estimates further up the plan multiply
    the sides of joins and take every text for 20 bytes.)  Where Spark knows no size, the
    session's number of shuffle partitions is used.
    """
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if size >= _UNKNOWN_SIZE:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    each = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return max(spark.sparkContext.defaultParallelism, -(-size // each))


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Hadoop objects."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def paths_like(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders a glob pattern names, on whatever file system, sorted."""
    fs, path = hadoop_path(spark, pattern)
    return sorted(str(status.getPath().toString()) for status in fs.globStatus(path) or [])


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file, or of a folder's first file that has one; little else of the file is read."""
    fs, place = hadoop_path(spark, path)
    if fs.getFileStatus(place).isDirectory():
        inner = sorted(str(s.getPath().toString()) for s in fs.listStatus(place) if s.getPath().getName()[0] not in "._")
        return next((line for p in inner if (line := first_line(spark, p)) is not None), None)
    jvm, stream = spark.sparkContext._jvm, fs.open(place)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(fs.getConf()).getCodec(place)
    text = jvm.java.io.InputStreamReader(stream if codec is None else codec.createInputStream(stream), "UTF-8")
    reader = jvm.java.io.BufferedReader(text, 1 << 13)
    try:
        return reader.readLine()
    finally:
        reader.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file appear complete under a new name; False if the name is taken."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    folder, name = path.rsplit("/", 1)
    fs, draft = hadoop_path(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    fs.mkdirs(draft.getParent())
    writer = jvm.java.io.OutputStreamWriter(fs.create(draft, False), "UTF-8")
    writer.write(text)
    writer.close()
    _, final = hadoop_path(spark, path)
    final = fs.makeQualified(final)
    try:
        rename = gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), fs.getConf()).rename(fs.makeQualified(draft), final, rename)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(error.java_exception.toString()):
            return False
        raise
    return True
