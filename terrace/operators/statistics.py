"""Column statistics that add up: one small row per load and column.

A load's row holds its row count, NULLs, least and greatest value, and two sketches
(HyperLogLog for distinct values, KLL for quantiles). A table's statistics are
merged from those of its loads; no load is read again. Counts and bounds are exact,
the sketches' errors are theirs (about 1.6 % for distinct values, 1.3 % in rank).

Whole numbers and dates are kept as longs, other numbers as doubles (NaN counts as the
greatest value and is left out of the quantiles), everything else as text without quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, FractionalType, IntegralType

KINDS = {"long": "bigint", "double": "double", "text": "string"}


def kind_of(dtype: DataType) -> str:
    if isinstance(dtype, (IntegralType, DateType)):
        return "long"
    return "double" if isinstance(dtype, FractionalType) else "text"


def _value(name: str, dtype: DataType) -> Column:
    if isinstance(dtype, DateType):
        return F.unix_date(F.col(name)).cast("bigint")
    return F.col(name).cast(KINDS[kind_of(dtype)])


def collect(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per column (and per value of ``by``): counts, bounds, sketches. One aggregate, combined map-side."""
    parts = []
    for c in cols:
        dtype, kind = df.schema[c].dataType, kind_of(df.schema[c].dataType)
        value = _value(c, dtype)
        ranked = F.when(~F.isnan(value), value) if kind == "double" else value
        quantiles = {
            "long": lambda: F.kll_sketch_agg_bigint(ranked),
            "double": lambda: F.kll_sketch_agg_double(ranked),
            "text": lambda: F.max(F.lit(None).cast("binary")),
        }[kind]()
        distinct = F.hll_sketch_agg(value.cast("string") if kind == "double" else value)
        parts.append(
            F.struct(
                F.lit(c).alias("col_name"),
                F.lit(kind).alias("kind"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(F.col(c).isNull()).alias("num_nulls"),
                *[
                    (f(value) if k == kind else f(F.lit(None).cast(t))).alias(f"{n}_{k}")
                    for n, f in (("min", F.min), ("max", F.max))
                    for k, t in KINDS.items()
                ],
                distinct.alias("distinct_sketch"),
                quantiles.alias("quantile_sketch"),
            )
        )
    gathered = df.groupBy(*by).agg(F.array(*parts).alias("stats"))
    return gathered.select(*by, F.explode("stats").alias("s")).select(*by, "s.*")


def record(df: DataFrame, cols: Sequence[str], folder: str, load: str) -> None:
    """Note a load's statistics; done again for the same load, they take the place of the earlier."""
    rows = collect(df, cols).withColumn("load", F.lit(load))
    rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(folder)


def recorded(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "false").parquet(folder)


def merge(stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Statistics of many loads as those of one."""
    bounds = [f(f"{n}_{k}").alias(f"{n}_{k}") for n, f in (("min", F.min), ("max", F.max)) for k in KINDS]

    def merged(kind: str, agg) -> DataFrame:
        own = stats.where(F.col("kind") == kind)
        return own.groupBy(*by, "col_name", "kind").agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum("num_nulls").alias("num_nulls"),
            *bounds,
            F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
            agg("quantile_sketch").alias("quantile_sketch"),
        )

    each = [merged("long", F.kll_merge_agg_bigint), merged("double", F.kll_merge_agg_double), merged("text", F.max)]
    return reduce(DataFrame.unionByName, each)


def summary(stats: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Rows for reading: bounds as text, estimated distinct values, estimated quantiles (NULL for text)."""
    bound = lambda n: F.coalesce(*[F.col(f"{n}_{k}").cast("string") for k in KINDS]).alias(f"{n}_value")
    at = F.array(*[F.lit(float(q)) for q in quantiles])
    filled = F.col("num_nulls") < F.col("n_rows")
    some = F.when((F.col("kind") == "long") & filled, F.kll_sketch_get_quantile_bigint("quantile_sketch", at).cast("array<double>"))
    some = some.when((F.col("kind") == "double") & filled, F.kll_sketch_get_quantile_double("quantile_sketch", at))
    extra = [c for c in stats.columns if c not in _OWN]
    return stats.select(
        *extra, "col_name", "n_rows", "num_nulls", bound("min"), bound("max"),
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"), some.alias("quantiles"),
    )


_OWN = {"col_name", "kind", "n_rows", "num_nulls", "distinct_sketch", "quantile_sketch"} | {f"{n}_{k}" for n in ("min", "max") for k in KINDS}
