"""Running the layers: the run ledger and its gate, the clean-layer refresh
(one load date → upsert), the reporting refresh, date replay.

The ledger replaces task-to-task values: the raw-layer run appends one row
per feed ``(run_id, feed, rows, load_date)``; ``rows = -1`` marks an
on-demand run that loaded nothing on purpose.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace.operators import layout, upsert
from terrace.operators.frames import load_slice, observed
from terrace.functions import columns as C
from terrace.plans import bronze, medallion, report
from terrace.plans.bronze import ARRIVAL
from terrace.plans.manifest import Manifest
from terrace.session import PACKED_BYTES_PER_PARTITION, scratch_dir, size_shuffle_partitions
from terrace.sources import tables
from terrace.streaming import incremental

# --- fixed values ---
# Time zone whose calendar date is the default run date.
RUN_ZONE = "America/Lima"
# --- end of fixed values ---
ON_DEMAND = -1
#: Staged bytes of the report per clustered file; one task sorts a file's rows, 10 to 20 times larger, in memory.
GOLD_FILE_BYTES = 32 * 1024 * 1024
# Used when a feed's entry cannot be found: assume there is work to do.
MISSING_DEFAULT = 1
#: What both clean tables are partitioned by.
PERIOD = ("mov_year", "mov_month")
LEDGER_SCHEMA = "run_id string, feed string, rows long, load_date date"


class EmptySlice(RuntimeError):
    """The raw table holds no row for the requested load date."""


class NoNewRows(RuntimeError):
    """Every feed reported zero new rows; the clean layer has nothing to do."""


def parse_run_date(text: str) -> _dt.date:
    """``yyyy-MM-dd`` → date; anything else raises ``ValueError``."""
    return _dt.datetime.strptime(text, "%Y-%m-%d").date()


def local_today(zone: str = RUN_ZONE) -> _dt.date:
    """Today's date on the calendar of ``zone`` (one shift, from UTC)."""
    from zoneinfo import ZoneInfo

    return _dt.datetime.now(ZoneInfo(zone)).date()


def record(spark: SparkSession, ledger: str, run_id: str, counts: dict[str, int], load_date) -> None:
    """Append this run's per-feed row counts to the ledger folder."""
    rows = [(run_id, feed, int(n), parse_run_date(str(load_date))) for feed, n in counts.items()]
    spark.createDataFrame(rows, LEDGER_SCHEMA).write.mode("append").parquet(ledger)


def gate(ledger: DataFrame, feeds: tuple[str, ...] = ("members", "holders")) -> DataFrame:
    """Per run: each feed's published count and the decision.

    ``bypass`` when every feed says on-demand, ``skip`` when every feed
    loaded zero rows, else ``run``. A feed missing from a run counts as
    ``MISSING_DEFAULT``.
    """
    wide = ledger.groupBy("run_id").pivot("feed", list(feeds)).agg(F.sum("rows"))
    counts = [F.coalesce(F.col(f), F.lit(MISSING_DEFAULT)).alias(f"{f}_rows") for f in feeds]
    wide = wide.select("run_id", *counts)

    def all_eq(v):
        return reduce(lambda a, b: a & b, [F.col(f"{f}_rows") == v for f in feeds])

    decision = F.when(all_eq(ON_DEMAND), "bypass").when(all_eq(0), "skip").otherwise("run")
    return wide.withColumn("decision", decision)


def should_run(spark: SparkSession, ledger: str, run_id: str) -> bool:
    """The gate for one run; an unreadable ledger means run."""
    try:
        led = spark.read.parquet(ledger).filter(F.col("run_id") == run_id)
    except Exception:  # noqa: BLE001 - missing ledger folder
        return True
    rows = gate(led).select("decision").collect()
    if rows and rows[0]["decision"] == "skip":
        raise NoNewRows(f"run {run_id}: no feed loaded new rows")
    return True


@dataclass
class SilverResult:
    members: upsert.UpsertResult | None  # None: the feed had no raw rows for the date
    holders: upsert.UpsertResult | None
    rejects: dict  # per feed: raw rows, unparseable cells, clean rows that a later row of their key replaced


def refresh_feed(
    spark: SparkSession,
    feed: medallion.Feed,
    raw: DataFrame | None,
    run_date,
    table: str,
    on_duplicate: str | None = None,
    null_safe: bool = False,
    by_period: bool = False,
    table_root: str | None = None,
    stats_columns: tuple[str, ...] = (),
    buckets: int = 0,
    changes: str | None = None,
    **options,
) -> tuple[upsert.UpsertResult | None, dict]:
    """Clean one load date of one feed and upsert it by its key.

    The key is fewer columns than the row, so rows may share a key. By
    default the row that arrived last wins (later run, file, sheet, row), and
    the replaced ones are counted; without the columns of arrival a repeated
    key is an error. ``buckets`` (by period) deals the clean table by policy, so
    that neither its merges nor the report's join shuffle it; ``changes`` is the
    folder that notes the policies of the batch for the report.
    """
    if raw is None:
        return None, {}
    batch = load_slice(raw, run_date)
    if batch.isEmpty():
        return None, {}
    members = feed.name == medallion.MEMBERS.name
    clean = medallion.clean_members if members else medallion.clean_holders
    counts = medallion.member_reject_counts() if members else medallion.holder_reject_counts()
    arrival = tuple(c for c in ARRIVAL if c in raw.columns) if "row_no" in raw.columns else ()
    mode = on_duplicate or ("latest" if arrival else "error")
    seen, kept = Observation(f"raw_{feed.name}"), Observation(f"clean_{feed.name}")
    # "latest" also removes exact duplicates, so the full-row distinct (a shuffle) is skipped
    source = clean(batch, run_date, distinct=mode != "latest", carry=arrival, watch=seen)
    source = source.observe(kept, F.count(F.lit(1)).alias("clean_rows"))
    order = arrival or ("load_date",)
    if by_period:
        # Both keys contain the period, so an upsert rewrites only the
        # periods present in this load instead of the whole table.
        location = f"{table_root.rstrip('/')}/{table}" if table_root else None
        result = upsert.upsert_partitions(
            source, table, feed.keys, PERIOD, null_safe, mode, order, location, drop_columns=arrival,
            history=options.get("history"), buckets=upsert.Buckets(buckets, ("policy_id",)) if buckets else None,
        )
        if stats_columns:
            layout.analyze_columns(spark, table, stats_columns)
    else:
        result = upsert.upsert_table(
            source, table, feed.keys, null_safe, mode, order, stats_columns=stats_columns, location_root=table_root,
            drop_columns=arrival, **options,
        )
    if changes:
        policies = batch.select(C.whole_number_via_decimal("policy_id", C.ID_PRECISION, "bigint").alias("policy_id"))
        report.note_changes(policies, changes, f"{feed.name}-{bronze.new_run()}")
    found = observed(seen, lambda: batch.agg(*counts).first().asDict())
    clean_rows = observed(kept, lambda: {"clean_rows": 0})["clean_rows"]
    found["replaced"] = clean_rows - result.inserted - result.updated
    return result, found


def refresh_silver(
    spark: SparkSession,
    run_date,
    members_raw: DataFrame | None,
    holders_raw: DataFrame | None,
    members_table: str,
    holders_table: str,
    on_duplicate: str | None = None,
    null_safe: bool = False,
    cluster_files: int = 0,
    stats_columns: tuple[str, ...] = (),
    history: str | None = None,
    by_period: bool = False,
    table_root: str | None = None,
    buckets: int = 0,
    changes: str | None = None,
) -> SilverResult:
    """Clean one load date of both feeds and upsert each by its key.

    A feed without raw rows for the date is left as it is; only when both
    have none is that an error. Replaying an older date is the same call with
    that date. ``by_period`` stores the clean tables partitioned by (year,
    month) of movement, clustered on the key, and rewrites only the periods a
    load touches; otherwise each upsert writes a new full version (z-ordered
    on the key when ``cluster_files`` is set).
    """
    if buckets:  # one count for both tables, so that they join where they lie
        sizes = [load_slice(raw, run_date).count() for raw in (members_raw, holders_raw) if raw is not None]
        buckets = upsert.bucket_count(max(sizes, default=0), buckets)
    options = {"history": history} | ({} if by_period else {"cluster_files": cluster_files})
    results, rejects = {}, {}
    for feed, raw, table in (
        (medallion.MEMBERS, members_raw, members_table),
        (medallion.HOLDERS, holders_raw, holders_table),
    ):
        results[feed.name], rejects[feed.name] = refresh_feed(
            spark, feed, raw, run_date, table, on_duplicate, null_safe, by_period, table_root, stats_columns,
            buckets, changes, **options
        )
    if not any(results.values()):
        raise EmptySlice(f"no raw rows for load date {run_date}")
    return SilverResult(results["members"], results["holders"], rejects)


def refresh_gold(
    spark: SparkSession,
    members_table: str,
    holders_table: str,
    gold_table: str,
    files: int = 0,
    table_root: str | None = None,
    cluster: bool = True,
    keep_versions: int = 2,
) -> str:
    """Rebuild the reporting table from the two clean tables, clustered on
    (last digit, document) for lookups. Returns the version table name.

    The join is computed once, into a staging folder; clustering then reads
    that (its sampling passes need two columns only), readers see the
    clustered version or the one before, and the staging folder goes. The
    file count follows the stored size unless ``files`` is set. The last
    ``keep_versions`` versions stay.
    """
    if tables.is_empty(spark, members_table) or tables.is_empty(spark, holders_table):
        raise EmptySlice("a clean table is empty; the reporting table is left as it is")
    joined = medallion.consolidate(spark.read.table(members_table), spark.read.table(holders_table))
    if not cluster:
        version = tables.publish_version(joined, gold_table, location_root=table_root)
    else:
        folder = scratch_dir(spark, "report-stage")
        joined.write.mode("overwrite").option("compression", "zstd").parquet(folder)
        n = files or max(1, -(-tables.stored_bytes(spark, folder) // GOLD_FILE_BYTES))
        stage = spark.read.schema(joined.schema).parquet(folder)
        clustered = layout.zorder(stage, medallion.GOLD_CLUSTER_BY, n)
        version = tables.publish_version(clustered, gold_table, location_root=table_root)
        tables.remove_folder(spark, folder)
    tables.drop_old_versions(spark, gold_table, keep_versions, table_root)
    return version


def replay(raw: DataFrame, load_date, feed: str = "members") -> DataFrame:
    """Clean-up of a past load date of either feed (the on-demand path)."""
    clean = {"members": medallion.clean_members, "holders": medallion.clean_holders}[feed]
    return clean(load_slice(raw, load_date), load_date)


@dataclass
class PipelineConfig:
    members_inbox: str
    holders_inbox: str
    members_raw: str  # raw (bronze) tables: catalog names or folders
    holders_raw: str
    members_table: str  # clean (silver) tables: catalog names
    holders_table: str
    gold_table: str
    ledger: str  # folder
    history: str | None = None  # folder for merge counts
    cluster_files: int = 0  # z-order the clean tables on their keys (full-version mode)
    stats_columns: tuple[str, ...] = ("policy_id",)
    by_period: bool = True  # partition the clean tables by period, rewrite touched periods only
    buckets: int = 0  # deal the clean tables by policy into that many buckets, or more for a large first load (by period only)
    report_parts: int = 0  # keep the report by changed policies, in that many parts (0: build it anew each run)
    table_root: str | None = None  # folder for the clean and reporting tables' files (default: warehouse)
    manifest: str | None = None  # folder of the record of loaded files (None: beside the ledger)
    members_processed: str | None = None  # where loaded files are moved (None: left in the inbox)
    holders_processed: str | None = None
    incremental: bool = False  # raw ingest through the file stream: each file exactly once
    checkpoints: str | None = None  # stream checkpoints (incremental), one folder per feed
    drops: bool = False  # inboxes hold JSON-lines drops that Spark reads itself, not workbooks


@dataclass
class RunOutcome:
    run_id: str
    raw_rows: dict
    silver: SilverResult | None
    gold_version: str | None


def run_all(spark: SparkSession, cfg: PipelineConfig, run_date=None, on_demand: bool = False) -> RunOutcome:
    """Raw ingest of both feeds → ledger → gate → clean upserts → reporting.

    ``on_demand`` replays ``run_date`` from the raw tables without ingesting
    (the ledger records -1 for both feeds). A feed with an empty inbox loads
    0 rows; the clean layer is skipped only when both feeds loaded nothing.
    """
    run_date = parse_run_date(str(run_date)) if run_date else local_today()
    run_id = f"{run_date.isoformat()}-{_dt.datetime.now(_dt.timezone.utc):%H%M%S%f}"
    counts, dates = {}, {run_date.isoformat()}
    changes = cfg.ledger.rstrip("/") + "_changes" if cfg.report_parts else None
    manifest = Manifest(spark, cfg.manifest or cfg.ledger.rstrip("/") + "_files")
    if on_demand:
        counts = {"members": ON_DEMAND, "holders": ON_DEMAND}
    else:
        for feed, inbox, target, done in (
            (medallion.MEMBERS, cfg.members_inbox, cfg.members_raw, cfg.members_processed),
            (medallion.HOLDERS, cfg.holders_inbox, cfg.holders_raw, cfg.holders_processed),
        ):
            counts[feed.name] = 0
            try:
                if cfg.incremental:
                    ckpt = f"{(cfg.checkpoints or cfg.ledger + '_checkpoints').rstrip('/')}/{feed.name}"
                    load = incremental.ingest_new_drops if cfg.drops else incremental.ingest_new_files
                    inc = load(
                        spark, inbox, feed.positions, feed.raw_columns, target, ckpt, run_date,
                        archive_dir=done, manifest=manifest, source=feed.name,
                    )
                    counts[feed.name] = inc.rows
                    dates |= set(inc.dates)  # a replayed batch keeps the date of its first attempt
                else:
                    for res in bronze.ingest_pending(
                        spark, manifest, feed.name, inbox, feed.positions, feed.raw_columns, target, run_date, drop=cfg.drops
                    ):
                        counts[feed.name] += res.rows
                        dates.add(res.load_date)  # so does a run that died and was done again
                        if done:  # only after the append succeeded
                            bronze.archive(spark, res.loaded_files, done, res.run, parents=cfg.drops)
            except bronze.NothingToIngest:
                pass
    record(spark, cfg.ledger, run_id, counts, run_date)
    should_run(spark, cfg.ledger, run_id)
    # Size shuffles from the stored input of each step (metadata only); the
    # caller's setting is put back afterwards.
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    silver, empty = None, None
    try:
        raws = {t: bronze.read_target_or_none(spark, t) for t in (cfg.members_raw, cfg.holders_raw)}
        for date in sorted(dates):
            raw_bytes = sum(
                tables.stored_bytes(spark, f"{tables.location(spark, t).rstrip('/')}/load_date={date}")
                for t, raw in raws.items()
                if raw is not None
            )
            size_shuffle_partitions(spark, raw_bytes, PACKED_BYTES_PER_PARTITION)
            try:
                silver = refresh_silver(
                    spark,
                    date,
                    raws[cfg.members_raw],
                    raws[cfg.holders_raw],
                    cfg.members_table,
                    cfg.holders_table,
                    cluster_files=cfg.cluster_files,
                    stats_columns=cfg.stats_columns,
                    history=cfg.history,
                    by_period=cfg.by_period,
                    table_root=cfg.table_root,
                    buckets=cfg.buckets if cfg.by_period else 0,
                    changes=changes,
                )
            except EmptySlice as none_left:
                empty = none_left
        if silver is None:
            raise empty
        # The stored tables behind the clean names (a version table or the
        # partitioned table itself).
        clean = [r for r in (silver.members, silver.holders) if r]
        size_shuffle_partitions(
            spark,
            sum(tables.stored_bytes(spark, tables.location(spark, r.version)) for r in clean),
            PACKED_BYTES_PER_PARTITION,
        )
        try:
            if changes is None:
                gold = refresh_gold(spark, cfg.members_table, cfg.holders_table, cfg.gold_table, table_root=cfg.table_root)
            elif tables.is_empty(spark, cfg.members_table) or tables.is_empty(spark, cfg.holders_table):
                gold = None
            else:
                place = f"{cfg.table_root.rstrip('/')}/{cfg.gold_table}" if cfg.table_root else None
                report.refresh_changed(
                    spark, cfg.members_table, cfg.holders_table, cfg.gold_table, changes, cfg.report_parts, place
                )
                gold = cfg.gold_table
        except EmptySlice:
            gold = None  # one clean table has no rows yet
    finally:
        spark.conf.set(key, previous)
    return RunOutcome(run_id, counts, silver, gold)
