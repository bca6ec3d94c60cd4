"""Command line: the jobs a deployment runs, over the library functions.

    python -m transitlens load-refs --stops DIR --routes DIR --out BASE
    python -m transitlens ingest    --landing DIR --raw DIR --checkpoint DIR [--once]
    python -m transitlens view      --raw DIR (--refs BASE | --database DB) --out DIR --checkpoint DIR [--once]
    python -m transitlens refresh   --raw DIR (--refs BASE | --database DB) --out DIR
    python -m transitlens health    --raw DIR (--refs BASE | --database DB) --out DIR

On a cluster run it with spark-submit; the session comes from the launcher
(``getOrCreate``), so master, memory and ``spark.checkpoint.dir`` are the
cluster's. Stop and route documents are JSON lines: {"line_id", "body"} and
{"line_id", "direction", "body"}, ``body`` being the API response text.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from .operators import health as H
from .session import cluster_conf, footer_table
from .sources import ingest as I
from .sources import refdata as R
from .streaming import live as M

# State store and shuffle settings as in ``session.cluster_conf``; partitions
# and memory are the launcher's.
RUNTIME_CONF = {
    **{k: v for k, v in cluster_conf(1, 1).items() if k != "spark.sql.shuffle.partitions"},
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def session() -> SparkSession:
    spark = SparkSession.builder.appName("transitlens").getOrCreate()
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


def _trigger(args) -> dict:
    return {"availableNow": True} if args.once else {"processingTime": f"{args.every} seconds"}


def load_refs(spark: SparkSession, args) -> dict:
    stations = R.load_stations(spark.read.schema("line_id string, body string").json(args.stops))
    routes = R.load_routes(spark.read.schema("line_id string, direction string, body string").json(args.routes))
    refs = {}
    for name, rows in (("ref_stations", stations), ("ref_line_routes", routes), ("ref_lines", R.load_lines(spark))):
        if args.database:
            R.switch_table(rows, f"{args.database}.{name}", args.out)
            refs[name] = R.stored(spark, f"{args.database}.{name}")
        else:
            R.replace_table(rows, f"{args.out}/{name}")
            refs[name] = R.stored(spark, f"{args.out}/{name}")
    row = R.load_summary(refs["ref_stations"], refs["ref_line_routes"], refs["ref_lines"]).first()
    return {"summary": row["summary"]}


def ingest(spark: SparkSession, args) -> dict:
    options = {"max_files_per_trigger": args.max_files, "clean_source": "archive" if args.archive else None,
               "archive_dir": args.archive, "polls": args.polls}
    if args.once:
        return M.ingest_available(spark, args.landing, args.raw, args.checkpoint, args.strict, **options)
    q = M.start_ingest(spark, args.landing, args.raw, args.checkpoint, _trigger(args), **options)
    M.run_available(q)
    return q.commits.finished()


def _reference(args, name: str) -> str:
    """Where a reference table is: a catalog table of --database, else a folder below --refs."""
    return f"{args.database}.{name}" if args.database else f"{args.refs}/{name}"


def view(spark: SparkSession, args) -> dict:
    M.run_available(M.start_positions(spark, args.raw, _reference(args, "ref_stations"), _reference(args, "ref_lines"), args.out,
                                      args.checkpoint, _trigger(args), unique=args.unique))
    return {"trains": M.read_positions(spark, args.out).count()}


def refresh(spark: SparkSession, args) -> dict:
    return {"rewritten": len(M.refresh(spark, args.raw, _reference(args, "ref_stations"), _reference(args, "ref_lines"),
                                       args.out, unique=args.unique))}


def health(spark: SparkSession, args) -> dict:
    raw = I.read_raw(spark, args.raw)
    max_age = dt.timedelta(minutes=args.max_age_min) if args.max_age_min else None
    pos = M.read_positions(spark, args.out, max_age)
    counts = H.table_counts({
        "RAW_ARRIVALS": I.raw_footers(spark, args.raw),
        **{name.upper(): footer_table(spark, R.stored_folder(spark, _reference(args, name)))
           for name in ("ref_stations", "ref_lines", "ref_line_routes")},
        "TRAIN_POSITIONS": pos,
    })
    fresh = H.stored_freshness(raw, I.raw_days(spark, args.raw)).first()
    return {
        "table_counts": {r["table_name"]: r["row_count"] for r in counts.collect()},
        "rejected": {r["reject_reason"]: r["count"] for r in
                     I.read_rejects(spark, args.raw).groupBy("reject_reason").count().collect()},
        "latest_ingestion": str(fresh["latest_ingestion"]), "lag_seconds": fresh["lag_seconds"],
        "location_types": {r["location_type"]: r["cnt"] for r in H.location_type_counts(pos).collect()},
    }


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="transitlens")
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("load-refs", help="load stations, routes and lines (full replace)")
    a.add_argument("--stops", required=True)
    a.add_argument("--routes", required=True)
    a.add_argument("--out", required=True, help="folder of the reference tables")
    a.add_argument("--database", help="keep them as catalog tables of this database, each replaced by one switch of its location")
    helps = {"ingest": "landing records -> raw table (stream)",
             "view": "raw table -> live positions table (stream)",
             "refresh": "place the rows of older reference versions again",
             "health": "table counts, freshness and location classes"}
    for name in ("ingest", "view"):
        s = sub.add_parser(name, help=helps[name])
        s.add_argument("--raw", required=True)
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--once", action="store_true", help="process what is there and stop")
        s.add_argument("--every", type=int, default=60, help="trigger interval, seconds")
    ing = sub.choices["ingest"]
    ing.add_argument("--landing", required=True)
    ing.add_argument("--strict", action="store_true", help="with --once: fail when rows were rejected (they are kept)")
    ing.add_argument("--polls", action="store_true", help="the landing folder holds numbered poll cycles (cycle=<n>)")
    ing.add_argument("--max-files", type=int)
    ing.add_argument("--archive", help="move processed landing files here")
    for name in ("view", "refresh", "health"):
        s = sub.choices.get(name) or sub.add_parser(name, help=helps[name])
        if name != "view":
            s.add_argument("--raw", required=True)
        at = s.add_mutually_exclusive_group(required=True)
        at.add_argument("--refs", help="folder of the reference tables")
        at.add_argument("--database", help="database of the reference tables, as load-refs --database keeps them")
        s.add_argument("--out", required=True, help="folder of the live positions table")
        if name != "health":
            s.add_argument("--unique", action="store_true")
    sub.choices["health"].add_argument("--max-age-min", type=float, help="leave out vehicles whose latest prediction is older")
    return p


COMMANDS = {"load-refs": load_refs, "ingest": ingest, "view": view, "refresh": refresh, "health": health}


def main(argv: list[str] | None = None) -> dict:
    args = parser().parse_args(argv)
    out = COMMANDS[args.command](session(), args)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
