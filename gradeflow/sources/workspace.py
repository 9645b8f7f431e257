"""Intermediate tables in the folder the cluster shares.

A written table cuts lineage and survives the loss of executors; it is also the
only way to measure a frame once and read it column by column afterwards.  A batch
run removes its workspace; what a lazy query landed is removed when Python exits.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from gradeflow.operators.lookup import Size

SETTING = "spark.checkpoint.dir"
# Spark jobs submitted side by side; the cluster's scheduler shares its slots.
SIDE_BY_SIDE = 8
# Of what is written once and read few times; a third less to write than with the session's default.
CODEC = "zstd"

Result = TypeVar("Result")


def side_by_side(tasks: dict[str, Callable[[], Result]]) -> dict[str, Result]:
    """Run independent Spark actions at once, so that small jobs do not queue up."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        futures = {name: pool.submit(inherit(run)) for name, run in tasks.items()}
        return {name: future.result() for name, future in futures.items()}


def literal_frame(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A few known rows as a frame of literals, without a Python worker."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder, which checkpoints go to from now on as well.

    Only a local session, which has no other machines, may leave the setting out.
    """
    context = spark.sparkContext
    root = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local["):
            raise ValueError(f"set {SETTING} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="gradeflow-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


class Workspace:
    """A fresh subfolder of the session's checkpoint folder."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        root = checkpoint_root(spark)
        self.folder = f"{root.rstrip('/')}/gradeflow-{uuid.uuid4().hex}"
        atexit.register(self.remove)

    def remove(self) -> None:
        """Delete the folder; nothing that was landed in it can be read any more."""
        atexit.unregister(self.remove)
        context = self.spark.sparkContext
        if context._jsc is None or context._jsc.sc().isStopped():
            return
        path, system = hadoop_path(self.spark, self.folder)
        system.delete(path, True)

    def land(self, name: str, df: DataFrame) -> DataFrame:
        """Write a frame and read it back."""
        path = f"{self.folder}/{name}"
        df.write.mode("errorifexists").option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def land_sized(self, name: str, df: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, Size]:
        """Write a frame and read it back; and the size of ``columns``, all by default, as it was written.

        The size is observed by the writing tasks, so it takes no job of its own.  Spark
        adds up what a task saw when it first ends well, so a task or a stage that runs
        again counts once.  A frame that Spark knows to be empty has no such tasks.
        """
        seen = Observation()
        landed = self.land(name, df.observe(seen, *text_size(df, columns)))
        found = seen.get
        return landed, to_size(found) if "filas" in found else Size(0, 0)


def shuffled_once(df: DataFrame) -> DataFrame:
    """The same rows for several jobs, which all read what ``df`` shuffled last, in its partitions.

    Nothing is written, and a lost executor's share of the shuffle is made again.
    """
    spark = df.sparkSession
    rows = df._jdf.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, df._jdf.schema(), False), spark)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of queries that have ended.

    It does so when the driver's garbage is collected, by itself as seldom as every half hour.
    """
    spark.sparkContext._jvm.System.gc()


def hadoop_path(spark: SparkSession, path: str):
    """A path qualified by its file system, and that file system."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(path)
    system = path.getFileSystem(context._jsc.hadoopConfiguration())
    return system.makeQualified(path), system


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file unless it is there; whether it was made.

    The file system decides who is first, so of several drivers one succeeds: HDFS and
    stores with conditional writes create a file once, and so does the kernel for a local
    or mounted folder, where Hadoop itself only looks beforehand.
    """
    path, system = hadoop_path(spark, path)
    if path.toUri().getScheme() == "file":
        system.mkdirs(path.getParent())
        try:
            with open(path.toUri().getPath(), "x", encoding="utf-8") as out:
                out.write(text)
        except FileExistsError:
            return False
        return True
    try:
        stream = system.create(path, False)
    except Py4JJavaError:
        # Some file systems report an existing file as a plain I/O error.
        if system.exists(path):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def text_size(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Aggregates that bound the memory of a frame's ``columns``: rows, bytes, widest row.

    Text counts by its length, every cell by a word and every row by a header, as
    in Spark's binary rows.
    """
    columns = df.columns if columns is None else columns
    texts = [f"coalesce(octet_length(cast({c} as string)), 0)" for c in columns]
    row_bytes = " + ".join([f"bigint({8 * (len(columns) + 2)})", *texts])
    return [
        F.expr("count(1) as filas"),
        F.expr(f"coalesce(sum({row_bytes}), 0) as bytes"),
        F.expr(f"coalesce(max({row_bytes}), 0) as mayor"),
    ]


def to_size(row: Row | dict[str, int]) -> Size:
    return Size(row["filas"], row["bytes"], row["mayor"] or 0)


def measure(df: DataFrame) -> Size:
    """Size of a frame, in one pass over it."""
    return to_size(df.agg(*text_size(df)).first())
