"""Upsert by business key as a pure DataFrame function, plus storing it.

Semantics: a source row whose key equals a target row's key replaces that
row (every column, load date included); a source row without a match is
inserted; target rows without a source row stay. Keys compare with ``=``,
so a key with a NULL part never matches and such rows are always inserted
(``null_safe=True`` compares with ``<=>`` instead).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from terrace.operators.frames import dedup_latest, duplicate_keys, observed
from terrace.session import scratch_dir
from terrace.sources import tables

#: Stored bytes that a task reads of a batch; staged batches have row groups of that size.
SPLIT_BYTES = 16 * 1024 * 1024
CHANGE = "_change"
INSERT, UPDATE, KEEP = "insert", "update", "keep"


class DuplicateKeyError(ValueError):
    """The source holds more than one row for some key."""


def _any_null(keys: Sequence[str]):
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


SALT = "_salt"


def _salted(df: DataFrame, keys: Sequence[str], null_safe: bool, ignore: Sequence[str] = ()) -> DataFrame:
    """``df`` with one more key part: 0 where the key can match, a hash of the
    row where a part of it is NULL.

    Rows that never match go through the merge join like all others, but the
    hash deals them over all partitions instead of into one, and target and
    source are read once. ``ignore``: columns that are not part of the row's content.
    """
    free = F.lit(0).cast("long")
    content = [c for c in df.columns if c not in ignore]
    return df.withColumn(SALT, free if null_safe else F.when(_any_null(keys), F.xxhash64(*content)).otherwise(free))


def _group_keys(df: DataFrame, keys: Sequence[str], null_safe: bool) -> list[str]:
    """What makes rows one: the keys, and the salt where a key may be NULL."""
    return [*keys, *([SALT] if not null_safe and any(df.schema[k].nullable for k in keys) else [])]


@dataclass
class KeyedSource:
    """A source whose rows are unique per key (NULL keys aside), with its salt."""

    rows: DataFrame

    def whole(self) -> DataFrame:
        return self.rows.drop(SALT)


def _unique_or_fail(salted: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """The rows as they are; a key that repeats fails the job that reads it.

    Counted over a window of the merge join's own keys: its exchange and its sort are
    the join's, so the source is read, shuffled and sorted once, and the rows go to
    the merge untouched. Rows with a NULL key part never match, so they may repeat.
    """
    by = [*keys, *([] if null_safe else [SALT])]
    usable = F.lit(True) if null_safe else ~_any_null(keys)
    text = F.concat(F.lit("source repeats key "), F.to_json(F.struct(*keys)))
    counted = salted.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*by)))
    once = F.when(usable & (F.col("_n") > 1), F.raise_error(text).cast("boolean")).otherwise(F.lit(True))
    return counted.filter(once).drop("_n")


def split_source(
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    null_safe: bool = False,
    drop_columns: Sequence[str] = (),
) -> KeyedSource:
    """Make the source unique per key.

    ``error`` raises :class:`DuplicateKeyError` when a key repeats (keys with
    a NULL part are exempt unless ``null_safe``, since they never match);
    ``latest`` keeps the row with the greatest ``order_by`` values (rows
    whose key has a NULL part are kept once each: de-duplicated exactly);
    ``keep`` passes the source through unchecked. ``drop_columns`` (say, the
    order of arrival) serve ``order_by`` only and are left out of the result.
    """
    if on_duplicate not in ("error", "latest", "keep"):
        raise ValueError(f"on_duplicate must be error, latest or keep, not {on_duplicate!r}")
    keys = list(keys)
    salted = _salted(source, keys, null_safe, drop_columns)
    if on_duplicate == "error":
        dup = duplicate_keys(salted.filter(F.col(SALT) == 0), keys).limit(1).collect()
        if dup:
            raise DuplicateKeyError(f"source repeats key {dup[0].asDict()}")
    elif on_duplicate == "latest":
        salted = dedup_latest(salted, _group_keys(salted, keys, null_safe), order_by)
    return KeyedSource(salted.drop(*drop_columns))


def prepare_source(
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    null_safe: bool = False,
) -> DataFrame:
    """:func:`split_source` as one frame."""
    return split_source(source, keys, on_duplicate, order_by, null_safe).whole()


def merge_changes(
    target: DataFrame, source: DataFrame | KeyedSource, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """The merged table with a ``_change`` column: insert / update / keep.

    One full outer join on the keys does both the merge and the counting. A
    plain frame as source must be unique per key: a repeated key fails the
    job instead of multiplying rows.
    """
    keys = list(keys)
    cols = target.columns
    plain = not isinstance(source, KeyedSource)
    have = source.columns if plain else source.whole().columns
    if sorted(cols) != sorted(have):
        raise ValueError(f"source columns {have} differ from target columns {cols}")
    salted = _unique_or_fail(_salted(source, keys, null_safe), keys, null_safe) if plain else source.rows
    tk = _salted(target, keys, null_safe)
    t = tk.select(*[F.col(c).alias(f"t__{c}") for c in tk.columns], F.lit(True).alias("t__present"))
    s = salted.select(*[F.col(c).alias(f"s__{c}") for c in tk.columns], F.lit(True).alias("s__present"))
    eq = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    parts = [eq(F.col(f"t__{k}"), F.col(f"s__{k}")) for k in keys]
    if not null_safe:
        parts.append(F.col(f"t__{SALT}") == F.col(f"s__{SALT}"))
    j = t.join(s, reduce(lambda a, b: a & b, parts), "full_outer")
    from_source = F.col("s__present").isNotNull()
    in_target = F.col("t__present").isNotNull()
    return j.select(
        *[F.when(from_source, F.col(f"s__{c}")).otherwise(F.col(f"t__{c}")).alias(c) for c in cols],
        F.when(from_source & in_target, F.lit(UPDATE))
        .when(from_source, F.lit(INSERT))
        .otherwise(F.lit(KEEP))
        .alias(CHANGE),
    )


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """The merged table (no bookkeeping column)."""
    return merge_changes(target, source, keys, null_safe).drop(CHANGE)


def change_counts(changes: DataFrame) -> DataFrame:
    """One row: inserted, updated, kept, total."""
    ch = F.col(CHANGE)
    return changes.agg(
        F.count_if(ch == INSERT).alias("inserted"),
        F.count_if(ch == UPDATE).alias("updated"),
        F.count_if(ch == KEEP).alias("kept"),
        F.count(F.lit(1)).alias("total"),
    )


@dataclass
class UpsertResult:
    mode: str  # "first_load" or "merge"
    version: str  # version table now behind the view
    inserted: int
    updated: int
    total: int


HISTORY_SCHEMA = "table_name string, version string, mode string, inserted long, updated long, total long"


def upsert_table(
    source: DataFrame,
    name: str,
    keys: Sequence[str],
    null_safe: bool = False,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    partition_by: list[str] | None = None,
    cluster_files: int = 0,
    stats_columns: Sequence[str] = (),
    history: str | None = None,
    location_root: str | None = None,
    drop_columns: Sequence[str] = (),
) -> UpsertResult:
    """Upsert into the stored table ``name`` (first load when absent or empty).

    The merged rows are written once as a new version; the counts come from
    an ``Observation`` on that same write, so the plan runs exactly once.
    ``cluster_files > 0`` writes the version z-ordered on the keys in that
    many files; ``stats_columns`` are analysed afterwards; ``history`` is a
    folder that gets one row per call (table, version, mode, counts).
    """
    spark = source.sparkSession
    src = split_source(source, keys, on_duplicate, order_by, null_safe, drop_columns)

    def publish(df: DataFrame) -> str:
        version = tables.publish_version(df, name, partition_by, location_root)
        if cluster_files:
            # Cluster from the stored version: the clustering's sampling
            # passes then do not recompute the merge.
            from terrace.operators.layout import zorder

            clustered = zorder(spark.read.table(version), list(keys), cluster_files)
            version = tables.publish_version(clustered, name, partition_by, location_root)
        return version

    if tables.is_empty(spark, name):
        if tables.table_exists(spark, name) and spark.catalog.getTable(name).tableType != "VIEW":
            spark.sql(f"DROP TABLE {name}")  # an empty plain table makes way for the view
        obs = Observation("first_load")
        version = publish(src.whole().observe(obs, F.count(F.lit(1)).alias("n")))
        n = observed(obs, lambda: {"n": 0})["n"]
        result = UpsertResult("first_load", version, n, 0, n)
    else:
        changes = merge_changes(spark.read.table(name), src, keys, null_safe)
        obs = Observation("merge")
        ch = F.col(CHANGE)
        watched = changes.observe(
            obs,
            F.count_if(ch == INSERT).alias("inserted"),
            F.count_if(ch == UPDATE).alias("updated"),
            F.count(F.lit(1)).alias("total"),
        ).drop(CHANGE)
        version = publish(watched)
        m = observed(obs, lambda: {"inserted": 0, "updated": 0, "total": 0})
        result = UpsertResult("merge", version, m["inserted"], m["updated"], m["total"])
    if stats_columns:
        from terrace.operators.layout import analyze_columns

        analyze_columns(spark, result.version, stats_columns)
    if history:
        record_history(spark, history, name, result)
    return result


def record_history(spark, history: str, name: str, result: UpsertResult) -> None:
    """One row per upsert: what was written and the counts."""
    row = [(name, result.version, result.mode, result.inserted, result.updated, result.total)]
    spark.createDataFrame(row, HISTORY_SCHEMA).write.mode("append").parquet(history)


def partition_filter(cols: Sequence[str], tuples: Sequence[tuple]):
    """Exactly the given partitions: a condition on literals, so it prunes
    folders; values are grouped column by column, so it stays small."""

    def is_value(c, values):
        known = sorted(v for v in values if v is not None)
        cond = F.col(c).isin(known) if known else F.lit(False)
        return cond | F.col(c).isNull() if None in values else cond

    if len(cols) == 1:
        return is_value(cols[0], {t[0] for t in tuples})
    below: dict = {}
    for t in tuples:
        below.setdefault(t[0], set()).add(t[1:])
    alike: dict = {}  # first values with the same rest share a branch
    for v, rest in below.items():
        alike.setdefault(frozenset(rest), set()).add(v)
    branches = [is_value(cols[0], vs) & partition_filter(cols[1:], list(rest)) for rest, vs in alike.items()]
    return reduce(lambda a, b: a | b, branches)


@dataclass(frozen=True)
class Buckets:
    """How a table's rows are dealt: by a hash of some key columns, into ``n`` buckets."""

    n: int
    columns: tuple[str, ...]


#: Rows per bucket: a task merges or joins a whole bucket, which AQE cannot split.
ROWS_PER_BUCKET = 500_000


def bucket_count(rows: int, least: int) -> int:
    """Buckets for a table of that many rows: ``least``, and more where a bucket would outgrow a task."""
    return max(least, -(-rows // ROWS_PER_BUCKET))


def buckets_of(spark: SparkSession, name: str) -> Buckets | None:
    """A stored table's buckets; None if it has none or is not there."""
    if not tables.table_exists(spark, name):
        return None
    said = {r.col_name: r.data_type for r in tables.describe(spark, name).filter("col_name in ('Num Buckets', 'Bucket Columns')").collect()}
    if "Num Buckets" not in said:
        return None
    return Buckets(int(said["Num Buckets"]), tuple(re.findall(r"`([^`]+)`", said["Bucket Columns"])))


@contextmanager
def dealt_alike(spark: SparkSession, buckets: Buckets | None) -> Iterator[None]:
    """Shuffles made inside have as many partitions as there are buckets (the caller's, without
    any): their number follows the rows, and with more of them than buckets Spark would
    shuffle the bucketed side as well, after which every task writes into every bucket."""
    if not buckets:
        yield
        return
    with tables.setting(spark, "spark.sql.shuffle.partitions", str(buckets.n)):
        yield


@contextmanager
def co_located(spark: SparkSession, on: bool = True) -> Iterator[None]:
    """Plans made inside keep a bucketed side where it lies: a join on more columns than
    the buckets' is served by them, and the other side is dealt to match."""
    if not on:
        yield
        return
    with tables.setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        yield


def small_splits(spark: SparkSession):
    """Scans of writes made inside give a task no more than :data:`SPLIT_BYTES`: ``latest``
    sorts a split's rows to combine them, and these are 10 to 20 times larger than stored."""
    return tables.at_most(spark, "spark.sql.files.maxPartitionBytes", SPLIT_BYTES)


def upsert_partitions(
    source: DataFrame,
    name: str,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    null_safe: bool = False,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    location: str | None = None,
    drop_columns: Sequence[str] = (),
    history: str | None = None,
    buckets: Buckets | None = None,
    merged: Callable[[DataFrame], None] | None = None,
) -> UpsertResult:
    """Upsert into a table partitioned by columns that are part of the key,
    rewriting only the partitions the source touches.

    The source is computed once, into a staging folder; everything after
    reads that. (A first load by ``latest`` reads it once anyway, for the
    de-duplication's exchange, and is not staged.) A key's rows always live in one partition, so the merge reads
    only the target partitions with exactly the source's value tuples (as
    many literals as folders that will be rewritten; the driver's listing of
    the table holds those anyway), and dynamic partition overwrite replaces
    just those. A NULL partition value is matched with ``IS NULL``:
    otherwise the NULL partition would be replaced by the source's NULL rows
    alone. Rows are written clustered on partition and key, so files cover
    narrow key ranges and a hot partition is split over tasks.

    ``drop_columns`` (say, an order of arrival for ``latest``) are used for
    de-duplication and left out of the table. The first load creates the
    table (at ``location`` when given) or fills an empty one. ``total`` is
    the whole table's row count. ``merged`` is called with the batch once it is in the
    table, before its stage goes: what else is to be known of it is not computed a second time.

    With ``buckets`` the table is created bucketed on part of the key, and a
    table that is bucketed already (whatever is passed) is merged where it lies: the
    source alone is shuffled, once, to the target's buckets (``latest`` is found there), and the merged rows are
    written from there, sorted, one file for each bucket and partition. Shuffles
    have as many partitions as buckets, whatever the session asks for.
    """
    spark = source.sparkSession
    missing = [c for c in partition_cols if c not in keys]
    if missing:
        raise ValueError(f"partition columns {missing} must be part of the key")
    first_load = tables.is_empty(spark, name)
    buckets = buckets_of(spark, name) or buckets
    folder, staged = None, source
    if not first_load or on_duplicate != "latest" or buckets:
        folder = scratch_dir(spark, "upsert-stage")
        with dealt_alike(spark, buckets), tables.compiled(spark):
            source.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", SPLIT_BYTES).parquet(folder)
        staged = spark.read.schema(source.schema).parquet(folder)
    if buckets and (alien := [c for c in buckets.columns if c not in keys]):
        raise ValueError(f"bucket columns {alien} must be part of the key")
    # a key's rows share a bucket, so the latest of them is found where the bucket is merged and written
    by_bucket = bool(buckets) and on_duplicate == "latest"
    rows = staged.repartition(buckets.n, *buckets.columns) if by_bucket else staged
    src = split_source(rows, keys, on_duplicate, order_by, null_safe, drop_columns)
    order = [*partition_cols, *[k for k in keys if k not in partition_cols]]

    def dealt(df: DataFrame, in_place: bool = False) -> DataFrame:
        """Rows by partition and key, or by bucket where the table has some."""
        if buckets:
            return df if in_place else df.repartition(buckets.n, *buckets.columns)
        by = [*[F.col(c) for c in order], F.xxhash64(*df.columns)]
        return df.repartitionByRange(*by).sortWithinPartitions(*by)

    def written(df: DataFrame) -> None:
        with tables.setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)

    if first_load:
        obs = Observation("first_load")
        first = dealt(src.whole(), in_place=by_bucket).observe(obs, F.count(F.lit(1)).alias("n"))
        with dealt_alike(spark, buckets), small_splits(spark), tables.compiled(spark):
            if tables.table_exists(spark, name):
                written(first)
            else:
                w = first.write.format("parquet").partitionBy(*partition_cols)
                if buckets:
                    w = w.bucketBy(buckets.n, *buckets.columns).sortBy(*buckets.columns)
                (w.option("path", location) if location else w).saveAsTable(name)
        n = observed(obs, lambda: {"n": 0})["n"]
        result = UpsertResult("first_load", name, n, 0, n)
    else:
        touched = [tuple(r) for r in staged.select(*partition_cols).distinct().collect()]
        target = spark.table(name)
        here = partition_filter(list(partition_cols), touched) if touched else F.lit(False)
        rest = target.filter(~F.coalesce(here, F.lit(False))).select(*partition_cols)
        target = target.filter(here) if touched else target.limit(0)
        with dealt_alike(spark, buckets), co_located(spark, bool(buckets)), small_splits(spark):
            changes = dealt(merge_changes(target, src, keys, null_safe), in_place=True)
            obs = Observation("merge_partitions")
            ch = F.col(CHANGE)
            # observed after the exchange: the range bounds' sampling pass does not count
            watched = changes.observe(
                obs,
                F.count_if(ch == INSERT).alias("inserted"),
                F.count_if(ch == UPDATE).alias("updated"),
                F.count(F.lit(1)).alias("total"),
            ).drop(CHANGE)
            written(watched)
        m = observed(obs, lambda: {"inserted": 0, "updated": 0, "total": 0})
        spark.catalog.refreshTable(name)
        # the partitions that were not written still hold what they held
        result = UpsertResult("merge_partitions", name, m["inserted"], m["updated"], m["total"] + rest.count())
    if merged:
        merged(staged)
    if folder:
        tables.remove_folder(spark, folder)
    if history:
        record_history(spark, history, name, result)
    return result
