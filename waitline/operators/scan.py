"""Looking ahead along an order that is cut into pieces, so that no key is one task's work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_next(
    rows: DataFrame, keys: Sequence[str], order: str, pieces: Sequence[str], name: str
) -> DataFrame:
    """Add the next value of ``order`` among the rows of the same keys, NULL for the last.

    ``pieces`` are columns that grow with ``order``, from coarse to fine. The search runs in
    each finest piece alone. The last row of a piece gets what is carried back to it: the first
    value of the piece after it, found in the same way among the first values of the pieces. So a
    task never has more of a key than one piece, or one row for each piece in the next larger
    one. The values of ``order`` must be distinct within the keys; rows whose keys or pieces are
    NULL find only what follows in their own piece.
    """
    *coarse, _ = pieces
    place = [*keys, *pieces]
    # Names of their own on each of the levels, which are joined to each other.
    first, carried = (f"_{role}{len(pieces)}" for role in ("first", "carried"))
    of = {c: f"_of{len(pieces)}_{c}" for c in place}
    in_piece = Window.partitionBy(*place).orderBy(order)
    found = rows.withColumn(name, F.lead(order).over(in_piece))
    firsts = found.groupBy(*place).agg(F.min(order).alias(first))
    if coarse:
        firsts = with_next(firsts, keys, first, coarse, carried)
    else:
        across = Window.partitionBy(*keys).orderBy(first)
        firsts = firsts.withColumn(carried, F.lead(first).over(across))
    ahead = firsts.select(*[F.col(c).alias(of[c]) for c in place], carried)
    same_piece = [F.col(c) == F.col(of[c]) for c in place]
    return found.join(ahead, same_piece, "left").select(
        *[F.col(c) for c in rows.columns], F.coalesce(name, carried).alias(name)
    )
