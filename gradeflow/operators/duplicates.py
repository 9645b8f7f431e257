"""Marking repeated natural keys without gathering a key's rows anywhere.

Of the rows that share a complete natural key one stays: the first that breaks no
other rule, or the first of all when none is clean.  A ranking window would send
every copy of a key to one task, and a third of a table may be copies of one row.
So the table is reduced map-side to three numbers per key, keys held once are
dropped, and what is left is looked up again by the rows.

Where those keys would be too many to broadcast, the rows that stay are: a bit each, in
blocks of 32,768 row numbers.  A row then finds its bit without a shuffle.  Row numbers
that are not unique could share a bit, which a count of the rows found tells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeflow.contract import REASON_SEPARATOR, REASONS, ROW, TableContract
from gradeflow.functions.rules import IS_VALID, all_present
from gradeflow.operators.lookup import DEFAULT_LIMITS, Limits, Size, attach, hot_threshold, shuffle_partitions

DUPLICATE = "REGISTRO_DUPLICADO"

# Fixed by Spark's bitmap functions: row numbers of a block; as many bits in words of 32.
BLOCK_ROWS = 32768
BLOCK_WORDS = BLOCK_ROWS // 32
# A block in memory: its words, its number and headers.
BLOCK_BYTES = 4 * BLOCK_WORDS + 256


def _first_rows(flagged: DataFrame, contract: TableContract) -> DataFrame:
    """Complete keys with their copies and the row that stays."""
    first_clean = F.expr(f"min(case when {IS_VALID} then {ROW} end)")
    return (
        flagged.filter(all_present(contract.key))
        .groupBy(*contract.key)
        .agg(
            F.count(F.lit(1)).alias("copias"),
            F.coalesce(first_clean, F.min(ROW)).alias("conserva"),
        )
    )


def repeated_keys(flagged: DataFrame, contract: TableContract) -> DataFrame:
    """Complete keys that occur more than once: copies and the row that stays."""
    return _first_rows(flagged, contract).filter("copias > 1")


def repeated_bound(contract: TableContract, rows: int) -> Size:
    """What the repeated keys of a table may take in memory, texts not counted."""
    widest = 8 * (len(contract.key) + 4)
    return Size(rows // 2, rows // 2 * widest, widest)


def blocks_bound(flagged: DataFrame) -> Size:
    """What a table's blocks may take in memory, from its least and greatest row number."""
    least, most = flagged.agg(F.min(ROW), F.max(ROW)).first()
    blocks = 0 if least is None else (most - least) // BLOCK_ROWS + 2
    return Size(blocks, blocks * BLOCK_BYTES, BLOCK_BYTES)


def staying_rows(flagged: DataFrame, contract: TableContract) -> DataFrame:
    """Per block of row numbers: a bit for every row that stays, and the keys they are of."""
    rows = _first_rows(flagged, contract).filter("conserva is not null").select("conserva")
    # Brought together before the bits are set: a block's bits are not sent once per task.
    blocks = rows.withColumn("bloque", F.expr("bitmap_bucket_number(conserva)")).repartition("bloque").groupBy("bloque")
    bits = blocks.agg(
        F.count(F.lit(1)).alias("claves"),
        F.expr("bitmap_construct_agg(bitmap_bit_position(conserva))").alias("bits"),
    )
    word = "bigint(conv(hex(substring(bits, 4 * i + 1, 4)), 16, 10))"
    signed = f"int(if({word} < 2147483648, {word}, {word} - 4294967296))"
    words = F.expr(f"transform(sequence(0, {BLOCK_WORDS - 1}), i -> {signed})").alias("palabras")
    return bits.select("bloque", "claves", words)


def _with_stays(flagged: DataFrame, blocks: DataFrame) -> DataFrame:
    """Add ``_stays``, whether the bit of the row's number is set; null if it has no number."""
    place = f"bitmap_bit_position({ROW})"
    # The bytes of a word were read from the highest to the lowest.
    bit = f"int(24 - 8 * (({place} div 8) % 4) + {place} % 8)"
    stays = f"coalesce(getbit(palabras[int({place} div 32)], {bit}) = 1, false)"
    looked = flagged.withColumn("bloque", F.expr(f"bitmap_bucket_number({ROW})"))
    looked = looked.join(F.broadcast(blocks.select("bloque", "palabras")), "bloque", "left")
    return looked.selectExpr(*flagged.columns, f"if({ROW} is null, null, {stays}) as _stays")


def blocks_tell(flagged: DataFrame, contract: TableContract, blocks: DataFrame) -> bool:
    """Whether the bits name one row of each key and no other.

    Every key has a row that stays and its bit is set, so as many such rows as keys are just
    these; more mean that row numbers repeat.
    """
    key = [*contract.key, ROW]
    numbered = flagged.filter(all_present(contract.key)).select(*key)
    found = _with_stays(numbered, blocks).filter("_stays").agg(F.count(F.lit(1)).alias("n"))
    keys = blocks.agg(F.coalesce(F.sum("claves"), F.lit(0)).alias("n"))
    return found.first()["n"] == keys.first()["n"]


def mark_by_blocks(flagged: DataFrame, contract: TableContract, blocks: DataFrame) -> DataFrame:
    """``mark_duplicates`` by the bits of ``staying_rows`` where ``blocks_tell``."""
    others = [c for c in flagged.columns if c != REASONS]
    superseded = f"{all_present(contract.key)} and not _stays"
    return _with_stays(flagged, blocks).selectExpr(*others, f"{_with_duplicate(superseded)} as {REASONS}")


def _with_duplicate(superseded: str) -> str:
    return (
        f"concat_ws('{REASON_SEPARATOR}', nullif({REASONS}, ''),"
        f" case when {superseded} then '{DUPLICATE}' end)"
    )


def mark_duplicates(
    flagged: DataFrame,
    contract: TableContract,
    rows: int,
    repeated: DataFrame | None = None,
    size: Size | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Append the duplicate reason to every copy but the one that stays.

    ``rows`` is the measured size of the table.  Its repeated keys may be given with
    their measured ``size`` when they have been written out before.
    """
    key = list(contract.key)
    others = [c for c in flagged.columns if c != REASONS]
    if repeated is None:
        repeated = repeated_keys(flagged, contract)
    threshold = hot_threshold(rows, shuffle_partitions(flagged.sparkSession))
    kept = repeated.select(*key, "conserva")
    # The keys carry their copies, so a filter finds the hot ones' rows; no join has to.
    hot = repeated.filter(F.col("copias") > threshold).select(*key, "conserva")
    looked = attach(flagged, kept, key, "_repeated", size=size, answers=hot, limits=limits)
    merged = _with_duplicate(f"_repeated.conserva <> {ROW}")
    return looked.selectExpr(*others, f"{merged} as {REASONS}")
