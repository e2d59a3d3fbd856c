"""Command-line entry points, one per layer plus the whole run.

    python -m terrace run    --root /vol/pipeline [--date 2026-01-15] [--on-demand]
    python -m terrace raw    --root /vol/pipeline --feed members [--date ...]
    python -m terrace clean  --root /vol/pipeline --date 2026-01-15
    python -m terrace report --root /vol/pipeline

``--root`` holds the conventional folders: ``inbox/<feed>``,
``processed/<feed>``, ``raw/<feed>``, ``ledger``, ``history`` and
``tables``; table names get ``--prefix``.
"""

from __future__ import annotations

import argparse
import json
import sys

from terrace.plans import bronze, medallion, runs
from terrace.session import get_session

FEEDS = {"members": medallion.MEMBERS, "holders": medallion.HOLDERS}


def config(root: str, prefix: str = "", incremental: bool = False) -> runs.PipelineConfig:
    root = root.rstrip("/")
    return runs.PipelineConfig(
        members_inbox=f"{root}/inbox/members",
        holders_inbox=f"{root}/inbox/holders",
        members_raw=f"{root}/raw/members",
        holders_raw=f"{root}/raw/holders",
        members_table=f"{prefix}members_clean",
        holders_table=f"{prefix}holders_clean",
        gold_table=f"{prefix}report",
        ledger=f"{root}/ledger",
        history=f"{root}/history",
        table_root=f"{root}/tables",
        members_processed=f"{root}/processed/members",
        holders_processed=f"{root}/processed/holders",
        incremental=incremental,
        checkpoints=f"{root}/checkpoints",
    )


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="terrace")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("run", "raw", "clean", "report"):
        c = sub.add_parser(name)
        c.add_argument("--root", required=True)
        c.add_argument("--prefix", default="")
        c.add_argument("--master", default=None)
        if name != "report":
            c.add_argument("--date", default=None, help="yyyy-MM-dd; default: today in the run zone")
        if name == "run":
            c.add_argument("--on-demand", action="store_true", help="replay --date from the raw tables")
            c.add_argument("--incremental", action="store_true", help="raw ingest through the file stream")
        if name == "raw":
            c.add_argument("--feed", choices=sorted(FEEDS), required=True)
    return p


def main(argv: list[str] | None = None) -> dict:
    args = parser().parse_args(argv)
    spark = get_session(args.master)
    cfg = config(args.root, args.prefix, getattr(args, "incremental", False))
    date = runs.parse_run_date(args.date) if getattr(args, "date", None) else runs.local_today()
    if args.command == "run":
        out = runs.run_all(spark, cfg, date, on_demand=args.on_demand)
        result = {"run_id": out.run_id, "raw_rows": out.raw_rows, "report": out.gold_version}
    elif args.command == "raw":
        feed = FEEDS[args.feed]
        inbox = getattr(cfg, f"{args.feed}_inbox")
        res = bronze.ingest(spark, inbox, feed.positions, feed.raw_columns, getattr(cfg, f"{args.feed}_raw"), date)
        bronze.archive(spark, res.loaded_files, getattr(cfg, f"{args.feed}_processed"), res.run)
        result = {"rows": res.rows, "rejected_sheets": res.rejected_sheets, "unreadable": res.unreadable}
    elif args.command == "clean":
        out = runs.refresh_silver(
            spark,
            date,
            bronze.read_target_or_none(spark, cfg.members_raw),
            bronze.read_target_or_none(spark, cfg.holders_raw),
            cfg.members_table,
            cfg.holders_table,
            stats_columns=cfg.stats_columns,
            history=cfg.history,
            by_period=cfg.by_period,
            table_root=cfg.table_root,
        )
        result = {
            feed: {"inserted": r.inserted, "updated": r.updated, "rejects": out.rejects[feed]}
            for feed, r in (("members", out.members), ("holders", out.holders))
            if r
        }
    else:
        result = {"report": runs.refresh_gold(spark, cfg.members_table, cfg.holders_table, cfg.gold_table,
                                              table_root=cfg.table_root)}
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
