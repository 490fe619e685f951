"""Command line: run the job, run it incrementally, or generate landed sales / customer files.

    python -m salesmart run --landing L --out O --customer C --store S --sales-team T [--product P] [--mart-tables]
    python -m salesmart stream --landing L --out O --checkpoint K ... [--archive A] [--max-files N]
    python -m salesmart generate-sales --out O --rows N [--layout base|extra|missing] [--day D | --start D --end D]
    python -m salesmart generate-customers --out O --rows N

Dimension sources are parquet paths, ``table:<name>`` for a catalog table, or
table names read over JDBC when ``--jdbc-url`` is given; ``name@column`` reads a large
one in partitions of equal depth on that column.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession


def _jdbc_properties(args) -> dict[str, str]:
    given = {"user": args.jdbc_user, "password": args.jdbc_password, "driver": args.jdbc_driver}
    return {k: v for k, v in given.items() if v}


def _table_options(args) -> dict | None:
    """K4 — where the aggregate marts go besides their files."""
    if args.mart_jdbc_url:
        return {"url": args.mart_jdbc_url, "properties": _jdbc_properties(args)}
    return {} if args.mart_tables else None


def load_dimension(spark: SparkSession, spec: str, args) -> DataFrame:
    from salesmart.sources.tables import read_table

    if spec.startswith("table:"):
        return spark.table(spec[len("table:"):])
    if args.jdbc_url:
        name, _, column = spec.partition("@")
        parts = {"partition_column": column, "num_partitions": args.jdbc_partitions} if column else {}
        return read_table(spark, name, url=args.jdbc_url, properties=_jdbc_properties(args), **parts)
    return spark.read.parquet(spec)


def _dims(spark, args):
    return (
        load_dimension(spark, args.customer, args),
        load_dimension(spark, args.store, args),
        load_dimension(spark, args.sales_team, args),
        load_dimension(spark, args.product, args) if getattr(args, "product", None) else None,
    )


def _add_dims(p: argparse.ArgumentParser) -> None:
    p.add_argument("--landing", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--customer", required=True)
    p.add_argument("--store", required=True)
    p.add_argument("--sales-team", required=True, dest="sales_team")
    p.add_argument("--jdbc-url", dest="jdbc_url")
    p.add_argument("--jdbc-user", dest="jdbc_user")
    p.add_argument("--jdbc-password", dest="jdbc_password")
    p.add_argument("--jdbc-driver", dest="jdbc_driver")
    p.add_argument("--jdbc-partitions", type=int, default=8, help="partitions of tables given as name@column")
    p.add_argument("--how", choices=["inner", "left"], default="inner")
    p.add_argument("--scope", choices=["store_month", "month"], default="store_month")
    p.add_argument("--ties", choices=["all", "one"], default="all")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="salesmart")
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    sub = ap.add_subparsers(dest="cmd", required=True)

    run = sub.add_parser("run", help="process the landed files once")
    _add_dims(run)
    run.add_argument("--ledger")
    run.add_argument("--strict", action="store_true", help="refuse to run while a previous run is unfinished")
    run.add_argument("--product")
    run.add_argument("--takeover", action="store_true", help="pass over the claim of a job that was killed")
    run.add_argument("--split-files", action="store_true", help="split large CSV files; quoted cells hold no line breaks")
    marts = run.add_mutually_exclusive_group()
    marts.add_argument("--mart-tables", action="store_true", help="write the aggregate marts to catalog tables as well")
    marts.add_argument("--mart-jdbc-url", help="write the aggregate marts over JDBC as well (user, password, driver as above)")

    st = sub.add_parser("stream", help="process newly landed files incrementally")
    _add_dims(st)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--archive")
    st.add_argument("--max-files", type=int, dest="max_files")

    gs = sub.add_parser("generate-sales", help="write a synthetic landed sales CSV folder")
    gs.add_argument("--out", required=True)
    gs.add_argument("--rows", type=int, default=500)
    gs.add_argument("--layout", choices=["base", "extra", "missing"], default="base")
    gs.add_argument("--start", default="2023-03-03")
    gs.add_argument("--end", default="2023-08-20")
    gs.add_argument("--day", help="single sales day (overrides --start/--end)")
    gs.add_argument("--seed", type=int, default=0)

    gc = sub.add_parser("generate-customers", help="write synthetic customer rows")
    gc.add_argument("--out", required=True)
    gc.add_argument("--rows", type=int, default=25)
    gc.add_argument("--format", choices=["csv", "parquet"], default="csv")
    gc.add_argument("--seed", type=int, default=0)
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    from salesmart.session import build_session

    spark = spark or build_session(master=args.master)
    if args.cmd == "run":
        from salesmart.plans.pipeline import run_pipeline

        customer, store, team, product = _dims(spark, args)
        res = run_pipeline(
            spark, args.landing, args.out, customer, store, team, product=product, ledger_path=args.ledger,
            how=args.how, scope=args.scope, ties=args.ties, strict=args.strict, takeover=args.takeover,
            multi_line=not args.split_files, table_options=_table_options(args),
        )
        report = {"run_id": res.run_id, "pending_before": res.pending_before, "accepted_files": res.accepted_files,
                  "rejected_files": res.rejected_files, "retracted_files": res.retracted_files,
                  "landed_lines": res.landed_lines, "accepted_lines": res.accepted_lines,
                  "rejected_lines": res.rejected_lines, "snapshot_version": res.snapshot_version,
                  "paths": res.paths, "timings": res.timings}
    elif args.cmd == "stream":
        from salesmart.streaming.landing import process_landing_stream

        customer, store, team, _ = _dims(spark, args)
        paths = process_landing_stream(
            spark, args.landing, args.out, args.checkpoint, customer, store, team,
            max_files_per_trigger=args.max_files, archive_dir=args.archive,
            how=args.how, scope=args.scope, ties=args.ties,
        )
        report = {"out": paths.out}
    elif args.cmd == "generate-sales":
        from salesmart.operators.synth import synth_sales

        start, end = (args.day, args.day) if args.day else (args.start, args.end)
        df = synth_sales(spark.range(args.rows), start=start, end=end, layout=args.layout, seed=args.seed)
        df.write.mode("overwrite").option("header", True).csv(args.out)
        report = {"out": args.out, "rows": args.rows, "layout": args.layout}
    else:
        from salesmart.operators.synth import synth_customers

        df = synth_customers(spark.range(args.rows), seed=args.seed)
        w = df.write.mode("overwrite")
        (w.option("header", True).csv(args.out) if args.format == "csv" else w.parquet(args.out))
        report = {"out": args.out, "rows": args.rows}
    print(json.dumps(report, default=str))
    return report


if __name__ == "__main__":
    main(sys.argv[1:])
