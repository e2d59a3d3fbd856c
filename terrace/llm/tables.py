"""Shared building blocks: lineage cuts, running totals, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm.words import BATCH_ROWS
from terrace.session import scratch_dir
from terrace.sources.tables import remove_folder

#: folders stored inside the innermost ``scratch`` block; None outside of any
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing.
    The folder stays, unless this is called inside ``scratch``.
    """
    path = scratch_dir(df.sparkSession, name)
    if (made := _made.get()) is not None:
        made.append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Owns what operators leave behind: on the way out the folders stored inside are removed, also after an
    error, and the session's batch size is what it was.

    Results of operators read those folders and are lazy, so write or collect them inside.
    """
    rows, made = spark.conf.get(BATCH_ROWS, None), []
    before = _made.set(made)
    try:
        yield
    finally:
        _made.reset(before)
        spark.conf.unset(BATCH_ROWS) if rows is None else spark.conf.set(BATCH_ROWS, rows)
        for path in made:
            remove_folder(spark, path)


def finished(spark: SparkSession, make: Callable[[], DataFrame], path: str) -> DataFrame:
    """``make()`` written to ``path`` and read back; what it stored on the way is gone."""
    with scratch(spark):
        df = make()
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def range_dealt(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, stored; ``__part`` and ``__at`` give a row's place.

    Sampled range bounds change how rows are dealt, never their order, as
    long as rows that tie in ``order`` are alike.
    """
    return stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            F.spark_partition_id().alias("__part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__at"),
        ),
        name,
    )


def row_numbers(df: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, int]:
    """``df`` plus ``__row``, its global number from 0 in ``order``, and the number of rows.

    No window and no single task: a row's number is its place in its
    partition plus the rows of the partitions before it (one number per
    partition goes through the driver).
    """
    spark = df.sparkSession
    kept = range_dealt(df, order, name)
    starts, total = [], 0
    for part, n in sorted(kept.groupBy("__part").count().collect()):
        starts.append((part, total))
        total += n
    offsets = F.broadcast(spark.createDataFrame(starts, "__part int, __start long"))
    numbered = kept.join(offsets, "__part").withColumn("__row", F.col("__start") + F.col("__at"))
    return numbered.drop("__part", "__at", "__start"), total


def totals_before(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """``df`` plus ``__before``, the total of the long column ``value`` over all rows before it in ``order``."""
    spark = df.sparkSession
    kept = range_dealt(df, order, name)
    starts, total = [], 0
    for part, n in sorted(kept.groupBy("__part").agg(F.sum(value)).collect()):
        starts.append((part, total))
        total += n or 0
    offsets = F.broadcast(spark.createDataFrame(starts, "__part int, __start long"))
    so_far = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.sum(value).over(so_far) - F.col(value)
    out = kept.withColumn("__own", own).join(offsets, "__part")
    return out.withColumn("__before", F.col("__start") + F.col("__own")).drop("__part", "__at", "__start", "__own")


def components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (u, v: long): (node, component), component the smallest node.

    Alternating large-star and small-star rounds, each a min-aggregate and a
    join; nothing but two numbers per round reaches the driver. The stars'
    centres are stored first, so that the join sees two exchanges and a centre
    of very many links can be split by the skew-join rule. Only linked nodes
    are returned.
    """

    def star(pairs: DataFrame, large: bool, tag: str) -> DataFrame:
        if large:
            pairs = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(
            pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{name}-{tag}"
        )
        met = pairs.join(low, "u")
        if large:
            return met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return down.union(low.where("u <> m").select("u", F.col("m").alias("v"))).distinct()

    pairs = stored(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        f"{name}-edges",
    )
    seen = None
    for _ in range(max_rounds):
        mark = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = mark
        big = stored(star(pairs, True, "large"), f"{name}-big")
        pairs = stored(star(big, False, "small"), f"{name}-small")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
