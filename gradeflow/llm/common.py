"""What the operators share: tables, landed intermediate results, split labels."""

from __future__ import annotations

import atexit
import math
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but the ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A folder of this session below ``spark.checkpoint.dir``, removed when Python exits.

    Where the setting is absent, a local session gets a folder of its own; a cluster
    has no folder that all machines see, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="gradeflow-")
        spark.sparkContext.setCheckpointDir(root)
    folder = f"{root}/gradeflow-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_remove, spark, folder)
    return folder


_folders: set[str] = set()


def _remove(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's modules to the Python workers, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="gradeflow-"), "gradeflow.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(application)


def landed(df: DataFrame) -> DataFrame:
    """df written once to the shared folder and read back: lost executors cost tasks only."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; ids that are null count as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


#: The values that a hash is taken to be one of when a share of keys is chosen.
STEPS = 1 << 62


def steps_of(share: float) -> int:
    """How many of ``STEPS`` hash values are a share: above 0 for any share above 0."""
    return min(STEPS, math.ceil(share * STEPS)) if share > 0 else 0


def in_share(share: float, *keys: str | Column) -> Column:
    """Whether the keys' hash lies in the first ``share`` of its range; the same keys always agree."""
    return F.pmod(F.xxhash64(*keys), F.lit(STEPS)) < F.lit(steps_of(share))
