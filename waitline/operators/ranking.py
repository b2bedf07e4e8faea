"""Equal-sized tiles over a whole table, without putting it on one task."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

Keep = Callable[[str, DataFrame], DataFrame]


def tile_positions(rows: int, tiles: int) -> list[int]:
    """Where the tiles from 2 on begin, counted from 0: equal sizes, the first ones one larger."""
    size, larger = divmod(rows, tiles)
    begins = [k * size + min(k, larger) for k in range(1, tiles)]
    return [b for b in begins if b < rows]


def tile_starts(
    df: DataFrame, value: str, tie: str, tiles: int, keep: Keep, name: str = "tile_order"
) -> list[Row]:
    """The first (value, tie) of the tiles from 2 on, at most ``tiles - 1`` rows.

    ``value`` and ``tie`` together must be unique and not NULL. The pair is
    range-partitioned and stored with its partition number. The row counts, one
    per partition, tell in which one each tile begins; only those few, each the
    size of one task's share, are read again and ranked.
    """
    ordered = keep(
        name,
        df.select(F.col(value).alias("value"), F.col(tie).alias("tie"))
        .repartitionByRange("value", "tie")
        .withColumn("part", F.spark_partition_id()),
    )
    counts = sorted(ordered.groupBy("part").agg(F.count("*").alias("n")).collect())
    ends = list(accumulate(n for _, n in counts))
    places: dict[int, list[int]] = {}
    for begin in tile_positions(ends[-1] if ends else 0, tiles):
        inside = next(i for i, end in enumerate(ends) if begin < end)
        part, n = counts[inside]
        places.setdefault(part, []).append(begin - (ends[inside] - n) + 1)
    if not places:
        return []
    wanted = F.lit(False)
    for part, ranks in places.items():
        wanted = wanted | ((F.col("part") == part) & F.col("place").isin(ranks))
    in_part = Window.partitionBy("part").orderBy("value", "tie")
    return (
        ordered.filter(F.col("part").isin(list(places)))
        .withColumn("place", F.row_number().over(in_part))
        .filter(wanted)
        .select("value", "tie")
        .collect()
    )


def with_tiles(
    df: DataFrame,
    value: str,
    tie: str,
    keep: Keep,
    tiles: int = 10,
    column: str = "tile",
    name: str = "tile_order",
) -> DataFrame:
    """Number the rows 1 to ``tiles`` by ascending value, ties by ``tie``.

    A row's tile is one more than the number of later tiles whose first row is not
    beyond it. So the table itself is neither sorted nor shuffled.
    """
    tile = F.lit(1)
    for start in tile_starts(df, value, tie, tiles, keep, name):
        reached = (F.col(value) > start.value) | (
            (F.col(value) == start.value) & (F.col(tie) >= start.tie)
        )
        tile = tile + reached.cast("int")
    return df.withColumn(column, tile)
