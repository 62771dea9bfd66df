"""Exact global ranks and running totals without a single-task window.

A bare ``Window.orderBy`` moves the whole table to one task. Here the rows are range-partitioned
on the full order (score *and* tie-break, so equal scores spread over many tasks), sorted inside
each partition, and written once with their place. Written places are final: range bounds are
sampled, but nothing re-samples them afterwards, whatever is retried. Only one row per partition
then takes part in the global prefix sum, and that small table is broadcast: its size is the
number of partitions, not of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.sources.staging import stage

# monotonically_increasing_id: partition number above, row number in the lower 33 bits.
_ROW_BITS = 33


def _place(df: DataFrame, order: list[Column], partitions: int | None) -> DataFrame:
    """``df`` with ``_bin`` and ``_row`` (0-based), written to a staged table.

    Without a given number, adaptive execution may merge neighbouring ranges that are small; merged
    neighbours are one longer range, sorted as a whole after the merge.
    """
    bounds = [partitions, *order] if partitions else order
    placed = (
        df.repartitionByRange(*bounds)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    return stage(
        placed.select(
            *df.columns,
            F.shiftright("_place", _ROW_BITS).cast("int").alias("_bin"),
            F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1).alias("_row"),
        ),
        "placed",
    )


def _offsets(placed: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Per bin: the total of every measure over the bins before it, and over all bins."""
    per_bin = placed.groupBy("_bin").agg(*[F.sum(m).alias(f"_{n}") for n, m in totals.items()])
    before = Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_bin").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    return per_bin.select(
        "_bin",
        *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}_before") for n in totals],
        *[F.sum(f"_{n}").over(everything).alias(f"_{n}_all") for n in totals],
    )


def number_rows(
    df: DataFrame,
    order: list[Column],
    name: str = "row_number",
    total: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``df`` with its 1-based position in ``order`` (and the row count as ``total``).

    The order should end with a unique column: that makes the numbers reproducible and lets any
    group of equal values be split. Put nulls explicitly (``asc_nulls_last``).
    """
    placed = _place(df, order, partitions)
    offsets = _offsets(placed, {"n": F.lit(1).cast("bigint")})
    numbered = placed.join(F.broadcast(offsets), "_bin")
    columns = [(F.col("_n_before") + F.col("_row") + 1).alias(name)]
    if total:
        columns.append(F.col("_n_all").alias(total))
    return numbered.select(*df.columns, *columns)


def running_totals(
    df: DataFrame, order: list[Column], totals: dict[str, str], partitions: int | None = None
) -> DataFrame:
    """Inclusive running total ``cum_<name>`` and grand total ``all_<name>`` of each measure.

    ``totals`` maps names to integer columns. Rows equal in ``order`` should be collapsed first.
    """
    measures = {name: F.col(column) for name, column in totals.items()}
    placed = _place(df, order, partitions)
    offsets = _offsets(placed, measures)
    inside = Window.partitionBy("_bin").orderBy("_row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    summed = placed.select("*", *[F.sum(m).over(inside).alias(f"_{n}") for n, m in measures.items()])
    summed = summed.join(F.broadcast(offsets), "_bin")
    return summed.select(
        *df.columns,
        *[(F.col(f"_{n}_before") + F.col(f"_{n}")).alias(f"cum_{n}") for n in totals],
        *[F.col(f"_{n}_all").alias(f"all_{n}") for n in totals],
    )


def ntile_bucket(rank: Column, total: Column, buckets: int) -> Column:
    """SQL NTILE: with ``total = buckets * size + extra`` the first ``extra`` buckets get one more."""
    size = F.floor(total / buckets).cast("bigint")
    extra = total % buckets
    head = extra * (size + 1)
    in_head = F.floor((rank - 1) / (size + 1)) + 1
    in_tail = extra + F.floor((rank - 1 - head) / F.greatest(size, F.lit(1))) + 1
    return F.when(rank <= head, in_head).otherwise(in_tail).cast("int")


def quantile_bucket(rank: Column, total: Column, buckets: int) -> Column:
    """Equal-frequency bin of a rank among 1..total: bin k ends at the k-th linear quantile.

    The edges are formed with the same double arithmetic as the usual array quantile (fraction as
    a percentage, then interpolation between neighbouring ranks), so rows on an edge fall alike.
    """
    bucket = F.lit(1)
    for k in range(1, buckets):
        fraction = (k * (1.0 / buckets)) * 100 / 100
        place = (total - 1).cast("double") * F.lit(fraction)
        low = F.floor(place).cast("double")
        part = place - low
        edge = F.when(part < 0.5, (low + 1) + part).otherwise((low + 2) - (1 - part))
        bucket = bucket + (rank > edge).cast("int")
    return bucket


def with_ntile(df: DataFrame, order: list[Column], buckets: int, name: str) -> DataFrame:
    """``df`` with its NTILE bucket in ``order``."""
    numbered = number_rows(df, order, "_rank", "_total")
    bucket = ntile_bucket(F.col("_rank"), F.col("_total"), buckets)
    return numbered.select(*df.columns, bucket.alias(name))


def with_quantile(df: DataFrame, order: list[Column], buckets: int, name: str) -> DataFrame:
    """``df`` with its equal-frequency quantile bin in ``order`` (1 = lowest)."""
    numbered = number_rows(df, order, "_rank", "_total")
    bucket = quantile_bucket(F.col("_rank"), F.col("_total"), buckets)
    return numbered.select(*df.columns, bucket.alias(name))


def with_previous(
    df: DataFrame, keys: list[str], pos: str, columns: list[str], chunk: int = 100_000
) -> DataFrame:
    """``df`` with ``prev_<column>`` of the row before it (by ``pos``) among the rows of its keys.

    ``pos`` counts the rows of a key. A key is cut into chunks of positions, so no window holds
    more than ``chunk`` rows however large the key is; the first row of a chunk takes its
    predecessor from the last row of the nearest earlier chunk, one row per chunk.
    """
    cut = df.withColumn("_chunk", F.floor(F.col(pos) / chunk).cast("bigint"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(pos)
    lagged = cut.select(
        "*",
        F.row_number().over(inside).alias("_nth"),
        F.lag(F.struct(*columns)).over(inside).alias("_before"),
    )
    # Last row of every chunk, handed on to the chunk that follows it.
    seams = cut.groupBy(*keys, "_chunk").agg(F.max_by(F.struct(*columns), pos).alias("_last"))
    seams = seams.select(
        *keys,
        "_last",
        F.lead("_chunk").over(Window.partitionBy(*keys).orderBy("_chunk")).alias("_chunk"),
        F.lit(1).alias("_nth"),
    ).where(F.col("_chunk").isNotNull())
    joined = lagged.join(seams, [*keys, "_chunk", "_nth"], "left")
    before = F.coalesce("_before", "_last")
    return joined.select(*df.columns, *[before[c].alias(f"prev_{c}") for c in columns])
