"""Command line over the stored tables, for ``spark-submit`` or ``python -m cellmart``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame

from cellmart.plans import audit, bi, daily, lookup, upkeep
from cellmart.session import build_session
from cellmart.operators.pit_join import with_validity
from cellmart.schemas import MAIN, TABLES, schema
from cellmart.sources.readers import read_table, read_versions
from cellmart.sources.writers import create_databases, create_tables, ingest_slice, load_drop, publish_keyed, publish_upsert
from cellmart.streaming import jobs


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="cellmart", description="Cell-network jobs over stored tables")
    parser.add_argument("--warehouse", help="folder with one subfolder per table")
    # The default day and month.
    parser.add_argument("--etl-date", default="20251201")
    parser.add_argument("--base-date", default="20251201")
    parser.add_argument("--base-month", default="202507")
    actions = parser.add_subparsers(dest="action", required=True)
    actions.add_parser("batch", help="run one daily transform").add_argument("job", choices=sorted(daily.BATCH))
    actions.add_parser("report", help="show one dashboard query").add_argument(
        "name", choices=("rsrp", "volte", "count", "region")
    )
    mart = actions.add_parser("mart", help="fill one result mart")
    mart.add_argument("name", choices=("rsrp", "volte"))
    mart.add_argument("--run-id", default="manual")
    stream = actions.add_parser("stream", help="run one window job")
    stream.add_argument("job", choices=sorted(jobs.JOBS))
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--lateness", default=jobs.LATENESS)
    stream.add_argument("--max-files", type=int, default=jobs.MAX_FILES)
    stream.add_argument("--versioned", action="store_true", help="stations as they were at each record's time")
    stream.add_argument("--state-partitions", type=int)
    stream.add_argument("--drain", action="store_true", help="stop once all present files are processed")
    actions.add_parser("load", help="load a staged drop").add_argument("staging")
    find = actions.add_parser("lookup", help="show one key; with --date from the dated table")
    find.add_argument("key")
    find.add_argument("--date")
    merge = actions.add_parser("upsert", help="merge a change set into the keyed table, by the catalog")
    merge.add_argument("changes", help="folder with the changes")
    ingest = actions.add_parser("ingest", help="copy one partition, or a whole dimension, of another warehouse")
    ingest.add_argument("source")
    ingest.add_argument("table", choices=sorted(TABLES))
    ingest.add_argument("--value")
    pack = actions.add_parser("compact", help="rewrite a table in fewer files: keyed ones in place, others to --out")
    pack.add_argument("table", choices=sorted(TABLES))
    pack.add_argument("--out")
    actions.add_parser("parity", help="compare a job's sink with the batch result").add_argument("job", choices=sorted(jobs.JOBS))
    actions.add_parser("audit", help="show row counts, eligible rows and newest windows")
    actions.add_parser("create", help="declare databases and tables in the catalog")
    actions.add_parser("analyze", help="refresh metadata and statistics of the declared tables")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments().parse_args(argv)
    spark = build_session(f"cellmart-{args.action}")
    if args.action == "create":
        create_databases(spark)
        create_tables(spark)
        return
    if args.action == "analyze":
        upkeep.analyze(spark)
        return
    tables = daily.Warehouse(spark, args.warehouse)
    if args.action == "batch":
        daily.BATCH[args.job](tables, args.etl_date, args.base_date)
    elif args.action == "report":
        _print(_report(tables, args))
    elif args.action == "mart" and args.name == "rsrp":
        daily.fill_rsrp_mart(tables, args.run_id, args.base_month)
    elif args.action == "mart":
        daily.fill_volte_mart(tables, args.run_id, args.base_date)
    elif args.action == "load":
        load_drop(spark, args.staging, args.warehouse)
    elif args.action == "lookup":
        _print(_find(tables, args))
    elif args.action == "audit":
        _audit(tables, args)
    elif args.action == "stream":
        source, _, sink = jobs.JOBS[args.job]
        if args.versioned and args.job not in jobs.VERSIONED:
            raise SystemExit(f"{args.job} has no versioned form")
        stations = tables.read("bts_master")
        if args.versioned:
            stations = with_validity(read_versions(spark, tables.path("bts_master"), "bts_master"), "cell_id")
        jobs.start(
            spark,
            args.job,
            tables.path(source),
            stations,
            tables.path(sink),
            args.checkpoint,
            lateness=args.lateness,
            max_files=args.max_files,
            available_now=args.drain,
            state_partitions=args.state_partitions,
            versioned=args.versioned,
        ).awaitTermination()
    elif args.action == "upsert":
        _upsert(tables, args)
    elif args.action == "ingest":
        source = read_table(spark, f"{args.source.rstrip('/')}/{args.table}", args.table)
        ingest_slice(spark, source, tables.path(args.table), args.table, args.value)
    elif args.action == "compact" and TABLES[args.table].buckets:
        publish_keyed(_keyed(tables, args.table), _view(args.table), args.table, files=1)
    elif args.action == "compact":
        if not args.out:
            raise SystemExit("--out names the folder to write to")
        upkeep.compact(spark, tables.path(args.table), args.table, args.out)
    elif args.action == "parity":
        source, core, _ = jobs.JOBS[args.job]
        expected = core(tables.read(source), tables.read("bts_master"))
        on = [c for c in expected.columns if c not in ("total_val", "record_cnt")]
        found = jobs.read_sink(spark, args.job, tables.path(jobs.JOBS[args.job][2]))
        _print(audit.parity_summary(args.job, audit.parity(expected, found, on, ["record_cnt"])))


def _view(table: str) -> str:
    """The catalog's pointer to the current version of a keyed table."""
    return f"{MAIN}.{table}_now"


def _keyed(tables: daily.Warehouse, table: str) -> DataFrame:
    """A keyed table through the catalog, so that a key reads one bucket; before its first upsert, its folder."""
    return tables.spark.table(_view(table)) if tables.spark.catalog.tableExists(_view(table)) else tables.read(table)


def _upsert(tables: daily.Warehouse, args: argparse.Namespace) -> None:
    """Merge, then rebuild the table keyed by call from the result."""
    name, spark = "call_quality_kudu", tables.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {MAIN}")
    changes = spark.read.schema(schema(name)).parquet(args.changes)
    order = ["base_date", *[c for c in schema(name).names if c not in ("base_date", "lookup_key")]]
    publish_upsert(spark, _keyed(tables, name), changes, ["lookup_key"], order, _view(name))
    by_call = "call_quality_kudu_by_call"
    publish_keyed(lookup.quality_by_call(spark.table(_view(name))), _view(by_call), by_call)


def _print(rows: DataFrame) -> None:
    """Every row, tab-separated below the column names; one partition at a time reaches the driver."""
    print(*rows.columns, sep="\t")
    for row in rows.toLocalIterator():
        print(*row, sep="\t")


def _report(tables: daily.Warehouse, args: argparse.Namespace):
    if args.name == "rsrp":
        return bi.rsrp_bad_rate(
            tables.read("cdr_mdt_smsng"), tables.read("tbm_gpot25"), tables.read("tbm_bdri"), args.base_month
        )
    if args.name == "volte":
        return bi.volte_drop(
            tables.read("lte_call_fact"), tables.read("contract_dim"), tables.read("product_dim"), args.base_date
        )
    if args.name == "count":
        return bi.partition_count(tables.read("cdr_sgi"), args.name, args.etl_date, args.base_date)
    return bi.region_total(tables.read("cdr_sgi"), tables.read("bts_master"), args.name, args.etl_date)


def _find(tables: daily.Warehouse, args: argparse.Namespace):
    if args.date:
        return lookup.by_key_and_date(tables.read("call_quality_iceberg"), args.key, args.date)
    return lookup.by_key(_keyed(tables, "call_quality_kudu"), args.key)


def _audit(tables: daily.Warehouse, args: argparse.Namespace) -> None:
    raw = {n: tables.read(n) for n in ("cdr_sgi_raw", "cdr_mdt_smsng_raw")}
    counted = {**raw, "bts_master": tables.read("bts_master")}
    expected = tables.spark.createDataFrame([], "tbl string, expected long")
    _print(audit.row_count_audit(counted, expected))
    _print(audit.eligible_counts(raw))
    _print(audit.time_range(raw))


if __name__ == "__main__":
    main()
