"""Row numbers of a source without a one-partition window.

The first record of a table is row 2 (row 1 is the header).  A record's number is
its position within its split plus the number of records in the splits before it.
Only the split totals are ordered: one row per input split, a list the driver
already holds to plan the scan, so it is small next to the data.  The totals are
broadcast where their size, known before, is within the limit; otherwise the rows
are shuffled in parts of much the same size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gradeflow.contract import ROW
from gradeflow.operators.lookup import DEFAULT_LIMITS, ROW_BYTES, Limits, Size

FIRST_ROW = 2
SPLIT = ("_file", "_block")
# Rows of a file that are shuffled together when the list of files is too long to broadcast.
PART = 1 << 20


def tag_splits(df: DataFrame) -> DataFrame:
    """Add where each record came from: file, byte offset of its split, scan order."""
    return df.select(
        *df.columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_scan"),
    )


def split_offsets(tagged: DataFrame) -> DataFrame:
    """Per split: its first scan id and the records in all splits before it."""
    totals = tagged.groupBy(*SPLIT).agg(
        F.min("_scan").alias("_first"), F.count(F.lit(1)).alias("_records")
    )
    in_file = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    files = totals.groupBy("_file").agg(F.sum("_records").alias("_records"))
    # One row per file, no partition key: the driver's own file listing is longer.
    before = W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)
    file_offsets = files.select(
        "_file", F.coalesce(F.sum("_records").over(before), F.lit(0)).alias("_files_before")
    )
    block_offsets = totals.select(
        *SPLIT, "_first", F.coalesce(F.sum("_records").over(in_file), F.lit(0)).alias("_blocks_before")
    )
    return block_offsets.join(file_offsets, "_file").select(
        *SPLIT, (F.col("_files_before") + F.col("_blocks_before") - F.col("_first")).alias("_shift")
    )


def number_tagged(
    tagged: DataFrame, offsets: DataFrame, size: Size, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Turn the tags into row numbers, with the ``split_offsets`` of the same table.

    ``tagged`` must be a written table: scan ids are only stable once stored.  With
    so many splits that their offsets are over the limit the rows are shuffled by
    split, which are of much the same size.
    """
    columns = [c for c in tagged.columns if c not in (*SPLIT, "_scan")]
    if limits.broadcasts(size):
        offsets = F.broadcast(offsets)
    numbered = tagged.join(offsets, list(SPLIT))
    return numbered.select(*columns, (F.col("_scan") + F.col("_shift") + FIRST_ROW).alias(ROW))


def number_parquet(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Row numbers of a Parquet scan, from the row index each file carries.

    Files follow each other by path.  Only the list of files is ordered, one row
    each, which is shorter than what the driver holds to plan the scan.  Counting a
    file's rows takes its footer alone, and the driver knows how long the paths are
    without a job.  Over the limit the rows are shuffled in parts of ``PART`` rows of a
    file, so that a large file is not left to one task.
    """
    columns = df.columns
    located = df.select(
        *columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_position"),
    )
    files = located.groupBy("_file").agg(F.count(F.lit(1)).alias("_records"))
    before = W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)
    offsets = files.select(
        "_file", "_records", F.coalesce(F.sum("_records").over(before), F.lit(0)).alias("_files_before")
    )
    if limits.broadcasts(files_size(df)):
        numbered = located.join(F.broadcast(offsets.drop("_records")), "_file")
    else:
        parts = F.explode(F.sequence(F.lit(0), F.floor((F.col("_records") - 1) / PART))).alias("_part")
        offsets = offsets.select("_file", "_files_before", parts)
        located = located.withColumn("_part", F.floor(F.col("_position") / PART))
        numbered = located.join(offsets, ["_file", "_part"])
    return numbered.select(
        *columns, (F.col("_files_before") + F.col("_position") + FIRST_ROW).alias(ROW)
    )


def dealt_out(rows: DataFrame, scan: DataFrame) -> DataFrame:
    """Numbered rows of a scan, dealt out by number if it has fewer splits than the session cores.

    No more tasks read a file than it has row groups, and what is computed and written
    next would have no more either.  A scan with splits for every core stays as it is;
    the driver knows their number without a job.
    """
    if scan.rdd.getNumPartitions() >= scan.sparkSession.sparkContext.defaultParallelism:
        return rows
    return rows.repartition(ROW)


def files_size(df: DataFrame) -> Size:
    """Size of one row per file of a scan: its path and a number."""
    paths = [len(path.encode()) for path in df.inputFiles()]
    return Size(len(paths), sum(paths) + len(paths) * ROW_BYTES, max(paths, default=0))
