from __future__ import annotations

import uuid

import pytest

from waitline.operators.ranking import with_tiles


@pytest.mark.parametrize("rows", [3, 10, 997], ids=str)
def test_equals_ntile_over_the_whole_table(spark, store, rows):
    # A third of the rows share one value.
    df = spark.range(rows).selectExpr(
        "(id * 7919) % 10007 AS id", "IF(id % 3 = 0, 5.0D, (id * 31 % 97) / 7) AS v"
    )
    tiled = with_tiles(df, "v", "id", store.keep, 10, "tile", f"order_{uuid.uuid4().hex}")
    df.createOrReplaceTempView("ranked")
    expected = spark.sql("SELECT id, ntile(10) OVER (ORDER BY v, id) AS tile FROM ranked")
    got = {r.id: r.tile for r in tiled.select("id", "tile").collect()}
    assert got == {r.id: r.tile for r in expected.collect()}
    sizes = [list(got.values()).count(t) for t in set(got.values())]
    assert max(sizes) - min(sizes) <= 1
