"""Positions in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.sources.staging import keep

_IN_PARTITION = 33  # bits of a row's place in its partition in monotonically_increasing_id


def ordinals(df: DataFrame, *order: Column, name: str = "ordinal") -> DataFrame:
    """df with each row's position (1, 2, 3 ...) by the order; ties keep the order of the input.

    Rows are dealt to ranges, sorted there, and numbered from the sum of the
    ranges before; only one number a range reaches the driver. Rows that are
    equal in all of the order are told apart by their place in the input, so a
    value that very many rows share is no single range. df is read twice (once to
    find the ranges), so it should be a written table.
    """
    by = [*order, F.col("__seen")]
    rows = df.withColumn("__seen", F.monotonically_increasing_id())
    placed = keep(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("__at", _IN_PARTITION).alias("__part")
    starts, total = [], 0
    for r in sorted(placed.groupBy(part).count().collect()):
        starts.append((r[0], total))
        total += r[1]
    starts = df.sparkSession.createDataFrame(starts, "__part long, __start long")
    place = F.col("__start") + F.col("__at").bitwiseAND(F.lit((1 << _IN_PARTITION) - 1)) + 1
    return placed.withColumn("__part", part).join(F.broadcast(starts), "__part").withColumn(name, place).drop("__seen", "__at", "__part", "__start")
