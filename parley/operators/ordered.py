"""Operators on ordered rows which stay balanced when one key holds most of the rows.

A plain window would put a whole channel (or thread, or user) into one task. Here the order
is cut into slices of about equal size, the window runs inside (key, slice), and the last
value of a slice is carried into the next one through a small table of slice ends. The cut
points decide only who does the work, never the result.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Sequence
from decimal import Decimal

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.session import require_checkpoint_dir

ROWS_PER_SLICE = 2_000_000
_SAMPLES_PER_SLICE = 64
# Window groups of rows without a key, for each slice.
_NULL_GROUPS = 16


def order_bounds(
    df: DataFrame, order: Column, rows_per_slice: int = ROWS_PER_SLICE
) -> list[float]:
    """Cut points which split ``df`` into slices of about ``rows_per_slice`` rows.

    Runs two jobs, so ``df`` should be stored: a count, and a pass that reduces a sample of
    about 64 values per slice to one number per slice. The slices follow the rows.
    """
    values = df.select(order.cast("double").alias("v"))
    rows = values.count()
    slices = max(1, -(-rows // rows_per_slice))
    fraction = min(1.0, slices * _SAMPLES_PER_SLICE / max(rows, 1))
    # The last share is the end of the last slice and no cut.
    shares = [i / slices for i in range(1, slices + 1)]
    cuts = (
        values.where(F.col("v").isNotNull())
        .sample(fraction=fraction, seed=17)
        .agg(F.percentile_approx("v", shares, 20 * slices).alias("cuts"))
        .first()["cuts"]
    )
    return sorted(set((cuts or [])[:-1]))


def with_slice(df: DataFrame, order: Column, bounds: Sequence[float], name: str) -> DataFrame:
    """Number the slice of every row; rows without an order value go to the first slice."""
    low, high = float("-inf"), float("inf")
    # Bucketizer wants a cut; this one leaves the last slice empty.
    bounds = bounds or [sys.float_info.max]
    value = f"{name}_value"
    cutter = Bucketizer(splits=[low, *bounds, high], inputCol=value, outputCol=f"{name}_cut")
    cut = cutter.transform(
        df.withColumn(value, F.coalesce(order.cast("double"), F.lit(low)))
    )
    return cut.withColumn(name, F.col(f"{name}_cut").cast("int")).drop(value, f"{name}_cut")


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Column,
    value: str,
    name: str,
    ties: Sequence[Column] = (),
    bounds: Sequence[float] = (),
) -> DataFrame:
    """Add ``value`` of the previous row of the same key as ``name``.

    Rows of equal key and order must have equal ``value`` (a message id fixes its time);
    ``ties`` only makes their sequence definite. A row with a null key has no previous row:
    such rows are spread over many window groups and get null.
    """
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()

    sliced = with_slice(df.withColumn("_order", order), F.col("_order"), bounds, "_slice")
    sliced = sliced.withColumn(
        "_slice",
        F.when(no_key, -1 - F.pmod(F.xxhash64("_order", *ties), F.lit(_NULL_GROUPS * (len(bounds) + 1))))
        .otherwise(F.col("_slice"))
        .cast("int"),
    )
    group = [*keys, "_slice"]
    inside = Window.partitionBy(*group).orderBy("_order", *ties)
    rows = sliced.withColumn(name, F.lag(value).over(inside))

    before_all = F.lit(Decimal(-(10**31))).cast("decimal(38,6)")
    ends = (
        sliced.where(~no_key)
        .groupBy(*group)
        .agg(F.max_by(value, F.coalesce("_order", before_all)).alias("_end"))
    )
    # At most one row per slice and key is left here.
    carried = ends.withColumn(
        "_carried", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_slice"))
    ).drop("_end")
    rows = (
        rows.withColumn("_first", F.row_number().over(inside) == 1)
        .join(carried, group, "left")
        .withColumn(name, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col(name)))
        .drop("_first", "_carried")
    )
    rows = rows.withColumn(name, F.when(no_key, F.lit(None)).otherwise(F.col(name)))
    return rows.drop("_slice", "_order")


def row_index(
    df: DataFrame, order: Sequence[Column | str], name: str = "index", folder: str | None = None
) -> DataFrame:
    """0-based position in the global order, without a one-task window over the rows.

    The sorted rows are written to ``folder``, with their partition and place in it; a new
    folder under ``spark.checkpoint.dir`` by default, which the caller may delete after use.
    Their sizes are read from these two columns only, and the starts, one row per partition,
    are broadcast.
    """
    spark = df.sparkSession
    folder = folder or f"{require_checkpoint_dir(spark)}/index-{uuid.uuid4().hex}"
    place = F.monotonically_increasing_id()
    placed = df.orderBy(*order).withColumns({"_part": F.shiftright(place, 33), "_place": place.bitwiseAND((1 << 33) - 1)})
    placed.write.mode("overwrite").parquet(folder)
    stored = spark.read.schema(placed.schema).parquet(folder)
    sizes = stored.groupBy("_part").agg((F.max("_place") + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    return (
        stored.join(F.broadcast(starts), "_part")
        .withColumn(name, (F.col("_start") + F.col("_place")).cast("bigint"))
        .drop("_part", "_place", "_start")
    )
