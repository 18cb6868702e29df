"""Dense row numbers and fixed-size chunks without a global window."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presswork.functions.constants import CHUNK_ROWS
from presswork.functions.numbers import int_div
from presswork.sources.shared import Work, materialize

# monotonically_increasing_id() holds the partition above this bit and the row index below it.
_PARTITION_SHIFT = 33


def dense_number(
    df: DataFrame, order_by: list[str], name: str = "SNo", work: Work | None = None
) -> DataFrame:
    """Number rows 1..n in the order of `order_by`, which must be unique per row.

    The call runs a job: it stores the placed rows, in the folder of the flow if `work` is given.

    Rows are range-partitioned, so a hot leading key is split by the later ones, and numbered
    within their partition. The placement is written out before partitions are counted: both
    passes then see the same rows in the same place, also after a lost executor. Pass narrow frames.
    """
    row_id = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    store = work.materialize if work else materialize
    placed = store(ranged.withColumn("_row", row_id), "numbering")
    part = F.shiftright("_row", _PARTITION_SHIFT).alias("_part")
    # One row per partition: this window and the broadcast are bounded by the partition count.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    local = F.col("_row") - F.shiftleft("_part", _PARTITION_SHIFT)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + local + 1)
        .drop("_row", "_part", "_offset")
    )


def chunk_rows(
    df: DataFrame, order_by: list[str], size: int = CHUNK_ROWS, name: str = "chunk_id"
) -> DataFrame:
    """Assign every row to exactly one chunk of `size` rows, 0-based, in the given order."""
    numbered = dense_number(df, order_by, "_index")
    chunk = int_div(F.col("_index") - 1, size)
    return numbered.withColumn(name, chunk).drop("_index")
