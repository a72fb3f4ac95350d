"""Per-key building blocks that stay correct and parallel when one key is hot.

A plain window puts every row of a key into one task. The helpers here first cut
a key's rows into bounded time chunks, work inside the chunks, and then stitch
neighbouring chunks together through one summary row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def id_order(c: Column | str) -> Column:
    """Sort key: digit-only ids in numeric order, every other id after them."""
    c = F.col(c) if isinstance(c, str) else c
    numeric = c.rlike("^[0-9]+$")
    digits = F.ltrim(c, F.lit("0"))
    return F.struct(
        F.when(numeric, 0).otherwise(1).alias("k0"),
        F.when(numeric, F.length(digits)).otherwise(0).alias("k1"),
        F.when(numeric, digits).otherwise(c).alias("k2"),
        c.alias("k3"),
    )


def nulls_last(c: Column | str) -> list[Column]:
    """Two sort-key parts that place NULL after every value."""
    c = F.col(c) if isinstance(c, str) else c
    return [c.isNull(), c]


def order_struct(parts: Sequence[Column]) -> Column:
    return F.struct(*[p.alias(f"o{i}") for i, p in enumerate(parts)])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the smallest by `order`. Map-side combined, so skew-safe."""
    payload = F.struct(*[F.col(c) for c in df.columns])
    picked = df.groupBy(*keys).agg(F.min_by(payload, order_struct(order)).alias("_row"))
    return picked.select("_row.*")


def micros(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def gap_groups(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    row_id: str,
    gap_seconds: int,
    out: str = "group_start",
    tie: Column | None = None,
    chunk_seconds: int = DAY_SECONDS,
) -> DataFrame:
    """Chain rows of a key while the gap to the previous row is <= gap_seconds.

    Adds `out`: the row_id of the first row of the chain. Rows with a NULL ts are
    not expected. Keys may be NULL (NULLs form a key of their own).
    """
    tie = id_order(row_id) if tie is None else tie
    gap = gap_seconds * 1_000_000
    part = [*keys, "_chunk"]
    rows = df.withColumn("_us", micros(ts)).withColumn(
        "_chunk", F.floor(F.col("_us") / F.lit(chunk_seconds * 1_000_000)).cast("long")
    )
    w = Window.partitionBy(*part).orderBy(F.col("_us"), tie)
    rows = rows.withColumn("_prev", F.lag("_us").over(w)).withColumn(
        "_inner", F.when(F.col("_us") - F.col("_prev") > gap, F.col(row_id))
    )
    rows = rows.withColumn(
        "_carry", F.last("_inner", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    heads = rows.groupBy(*part).agg(
        F.min("_us").alias("_first_us"),
        F.max("_us").alias("_last_us"),
        F.min_by(row_id, F.struct("_us", tie)).alias("_first_id"),
        F.max_by("_inner", F.when(F.col("_inner").isNotNull(), F.struct("_us", tie))).alias("_last_inner"),
    )
    cw = Window.partitionBy(*keys).orderBy("_chunk")
    heads = heads.withColumn("_before", F.lag("_last_us").over(cw))
    opens = F.col("_before").isNull() | (F.col("_first_us") - F.col("_before") > gap)
    heads = heads.withColumn("_head", F.when(opens, F.col("_first_id"))).withColumn(
        "_open_after", F.coalesce("_last_inner", "_head")
    )
    heads = heads.withColumn(
        "_group_in",
        F.coalesce(
            "_head",
            F.last("_open_after", ignorenulls=True).over(cw.rowsBetween(Window.unboundedPreceding, -1)),
        ),
    ).select(*[F.col(k).alias(f"_h_{k}") for k in part], "_group_in")
    cond = None
    for k in part:
        c = F.col(k).eqNullSafe(F.col(f"_h_{k}"))
        cond = c if cond is None else cond & c
    joined = rows.join(heads, cond, "left")
    return joined.select(*df.columns, F.coalesce("_carry", "_group_in").alias(out))


def rank_in_key(
    df: DataFrame,
    keys: Sequence[str],
    chunk: Column,
    order: Sequence[Column],
    out: str = "rn",
) -> DataFrame:
    """1-based position of a row within its key.

    `chunk` must be monotone in `order` (for example the day of the timestamp the
    order starts with): positions are counted per chunk and shifted by the number
    of rows in earlier chunks, so a hot key spreads over its chunks.
    """
    rows = df.withColumn("_chunk", chunk)
    w = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    rows = rows.withColumn("_rn", F.row_number().over(w))
    sizes = df.withColumn("_chunk", chunk).groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    sizes = sizes.select(*[F.col(k).alias(f"_s_{k}") for k in [*keys, "_chunk"]], "_before")
    cond = None
    for k in [*keys, "_chunk"]:
        c = F.col(k).eqNullSafe(F.col(f"_s_{k}"))
        cond = c if cond is None else cond & c
    return rows.join(sizes, cond, "left").select(
        *df.columns, (F.col("_rn") + F.col("_before")).cast("long").alias(out)
    )
