"""Long to wide with names that are found in the data (R1): column blocks of a bounded width.

The species matrix of the analysis has a column per name.  With names from the
data their number has no bound, so neither the driver nor a row may hold
them all.  The names are numbered in a stored table and dealt into blocks of
``width``; the cells are one row per (unit, block) with an array of the
block's values.  A block turns into named columns only when it is asked for,
which reads its ``width`` names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..store import stored
from .joins import _null_safe_join

#: Columns of a block.
WIDTH = 1000


def numbered(df: DataFrame, order: str, name: str = "number") -> DataFrame:
    """``df`` with row numbers from 0 in the order of a column, NULL last.

    A number is the row's place in its stored range partition plus the rows of
    the partitions before; only partition sizes meet in one task.
    """
    key = F.col(order).asc_nulls_last()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(df.repartitionByRange(parts, key).sortWithinPartitions(key)
                    .withColumn("_place", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("_part", F.shiftright("_place", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return ranged.join(offsets, "_part").select(
        *df.columns, (F.col("_offset") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))).alias(name))


@dataclass
class WideBlocks:
    """A wide table in column blocks.

    ``units``: the distinct units.  ``names``: (block, position, name), names in
    code-point order, NULL last.  ``cells``: (units' columns, block, values) for
    the blocks in which a unit has a row; a block that is not there is all fill.
    """
    id_cols: list[str]
    units: DataFrame
    names: DataFrame
    cells: DataFrame
    fill: object
    n_names: int
    width: int

    @property
    def n_blocks(self) -> int:
        return -(-self.n_names // self.width)

    def columns(self, block: int) -> list[str]:
        """The names of a block, at most ``width``; a missing name is ``NA``."""
        rows = self.names.where(F.col("block") == block).orderBy("position").select(F.coalesce("name", F.lit("NA")).alias("name")).collect()
        return [r["name"] for r in rows]

    def block(self, block: int) -> DataFrame:
        """The units with the columns of a block."""
        names = self.columns(block)
        if taken := sorted(c for c, n in Counter([*names, *self.id_cols]).items() if n > 1):
            raise ValueError(f"names that would be columns twice: {taken}")
        own = self.cells.where(F.col("block") == block).drop("block").withColumnRenamed("values", "_values")
        rows = _null_safe_join(self.units, own, self.id_cols, "left")
        absent = F.col("_values").isNull()
        return rows.select(*self.id_cols, *[F.when(absent, F.lit(self.fill)).otherwise(F.get("_values", F.lit(i))).alias(c)
                                            for i, c in enumerate(names)])


def wide_blocks(df: DataFrame, id_cols: Sequence[str], names_from: str, values_from: str, fill=0, width: int = WIDTH) -> WideBlocks:
    """R1 for any number of names.

    Combinations without a row get ``fill``; a row with a NULL value stays NULL.
    Of several rows of a combination one value is kept, as with ``first``.
    An empty table has no units, names or blocks.
    """
    id_cols = list(id_cols)
    if not 0 < width:
        raise ValueError("a block has at least one column")
    long = df.select(*id_cols, F.col(names_from).cast("string").alias("_name"), F.col(values_from).alias("_value"))
    long = stored(long.groupBy(*id_cols, "_name").agg(F.first("_value").alias("_value")), "long")
    names = numbered(long.select("_name").distinct(), "_name")
    names = stored(names.select(F.floor(F.col("number") / width).cast("long").alias("block"),
                                (F.col("number") % width).cast("int").alias("position"), F.col("_name").alias("name")), "names")
    placed = _null_safe_join(long, names.withColumnRenamed("name", "_name"), ["_name"], "inner")
    # a unit has each name once, so a group has at most ``width`` entries
    held = placed.groupBy(*id_cols, "block").agg(F.map_from_entries(F.collect_list(F.struct("position", "_value"))).alias("_held"))
    value = lambda i: F.when(F.map_contains_key("_held", i), F.element_at("_held", i)).otherwise(F.lit(fill))
    cells = stored(held.select(*id_cols, "block", F.transform(F.sequence(F.lit(0), F.lit(width - 1)), value).alias("values")), "cells")
    return WideBlocks(id_cols, stored(long.select(*id_cols).distinct(), "units"), names, cells, fill, names.count(), width)


def write_wide(wide: WideBlocks, path: str) -> list[str]:
    """Store every block as a table of its own below ``path``; one block's names are held at a time."""
    out = []
    for b in range(wide.n_blocks):
        out.append(f"{path.rstrip('/')}/block-{b:06d}")
        wide.block(b).write.mode("overwrite").parquet(out[-1])
    return out
