"""Sharding along a Hilbert curve, by DataFrame functions alone.

Several metadata dimensions are cut at quantiles into ``2 ** BITS`` steps, a cell's place on the
Hilbert curve through this grid orders the documents, and the order is cut into runs with equal
counts of rows (law ``rows``).  Files of one run then hold few values of each dimension, and a filter
on any of them prunes.

No row is sorted globally.  A cell's rows before it are known from counts of cells; cells are split
into parts of about ``PART_ROWS`` by a hash of the id, whose counts give the rows before each part;
only inside a part are rows numbered.  A cell that holds a third of all rows is thus many parts.

Null dimensions come before all values; null text has no bytes.  Rows with the same id stay side by
side in the order of text checksum and size; ids are taken to be nearly unique.  An empty table gives
an empty result; very long texts are only measured.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from postura.llm.common import checkpointed

BITS = 4
DIMENSIONS = ("source", "lang", "n_chars")
PART_ROWS = 256
OVERHEAD = 16


def ordinal(docs: DataFrame, name: str) -> Column:
    """A number in the order of the values: itself, or the first six bytes of a string."""
    if isinstance(docs.schema[name].dataType, NumericType):
        return F.col(name).cast("double")
    first = F.rpad(F.hex(F.substring(F.col(name).cast("string").cast("binary"), 1, 6)), 12, "0")
    return F.conv(first, 16, 10).cast("double")


def quantile_steps(values: list[Column], bounds: list[list[float]]) -> list[Column]:
    """How many of its dimension's bounds a value exceeds; null exceeds none."""
    return [
        reduce(add, [F.coalesce(v > F.lit(b), F.lit(False)).cast("int") for b in cuts], F.lit(0))
        for v, cuts in zip(values, bounds, strict=True)
    ]


def hilbert_index(grid: DataFrame, axes: list[str], bits: int, name: str) -> DataFrame:
    """``grid`` with each point's place on the curve (after Skilling, 2004).

    Going down the bits, each axis inverts or exchanges low bits of the first axis; a Gray code of
    the transposed bits, interleaved, is the place.
    """
    x = [f"_axis{k}" for k in range(len(axes))]
    grid = grid.withColumns({a: F.col(axis).cast("int") for a, axis in zip(x, axes, strict=True)})
    for bit in range(bits - 1, 0, -1):
        low = F.lit((1 << bit) - 1)
        for a in x:
            is_set = F.col(a).bitwiseAND(1 << bit) != 0
            swap = F.col(x[0]).bitwiseXOR(F.col(a)).bitwiseAND(low)
            first = F.when(is_set, F.col(x[0]).bitwiseXOR(low)).otherwise(F.col(x[0]).bitwiseXOR(swap))
            if a == x[0]:
                grid = grid.withColumn(a, F.when(is_set, F.col(a).bitwiseXOR(low)).otherwise(F.col(a)))
            else:
                other = F.when(is_set, F.col(a)).otherwise(F.col(a).bitwiseXOR(swap))
                grid = grid.withColumns({x[0]: first, a: other})
    for before, a in zip(x, x[1:], strict=False):
        grid = grid.withColumn(a, F.col(a).bitwiseXOR(F.col(before)))
    turn = F.lit(0)
    for bit in range(bits - 1, 0, -1):
        there = F.col(x[-1]).bitwiseAND(1 << bit) != 0
        turn = F.when(there, turn.bitwiseXOR((1 << bit) - 1)).otherwise(turn)
    grid = grid.withColumn("_turn", turn)
    place = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for a in x:
            digit = F.shiftright(F.col(a).bitwiseXOR(F.col("_turn")), bit).bitwiseAND(1)
            place = place * 2 + digit
    return grid.withColumn(name, place).drop(*x, "_turn")


def shard_rows(
    docs: DataFrame,
    shards: int = 40,
    dimensions: tuple[str, ...] = DIMENSIONS,
    bits: int = BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, curve``."""
    steps = 1 << bits
    values = [ordinal(docs, d) for d in dimensions]
    shares = [k / steps for k in range(1, steps)]
    cuts = docs.agg(*[F.percentile_approx(v, shares, 1000).alias(f"c{k}") for k, v in enumerate(values)]).first()
    bounds = [sorted(set(c or [])) for c in cuts]
    axes = [f"axis{k}" for k in range(len(dimensions))]
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + OVERHEAD
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        size.alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
        *[s.alias(a) for s, a in zip(quantile_steps(values, bounds), axes, strict=True)],
    )
    # At most 2 ** (bits * dimensions) cells, in one window and broadcast.
    cells = hilbert_index(rows.groupBy(axes).agg(F.count("*").alias("cell_rows")), axes, bits, "curve")
    along = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    cells = checkpointed(
        cells.withColumns(
            {
                "rows_before": F.coalesce(F.sum("cell_rows").over(along), F.lit(0)),
                "total": F.sum("cell_rows").over(Window.partitionBy()),
                "parts": F.ceil(F.col("cell_rows") / PART_ROWS),
            }
        )
    )
    placed = rows.join(F.broadcast(cells), axes).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    in_cell = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        placed.groupBy("curve", "part")
        .agg(F.count("*").alias("part_rows"))
        .select("curve", "part", F.coalesce(F.sum("part_rows").over(in_cell), F.lit(0)).alias("cell_before"))
    )
    in_part = Window.partitionBy("curve", "part").orderBy("doc_id", "text_crc32", "size")
    ranked = (
        placed.select(
            "doc_id",
            "size",
            "text_crc32",
            "curve",
            "part",
            "total",
            (F.col("rows_before") + F.row_number().over(in_part) - 1).alias("in_curve"),
        )
        .join(parts, ["curve", "part"])
        .withColumn("rank", F.col("in_curve") + F.col("cell_before"))
        .withColumn("shard", F.expr(f"int(rank * {shards} div total)"))
    )
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.expr(f"rank - (shard * total + {shards - 1}) div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
