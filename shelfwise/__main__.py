"""Command line: ``python -m shelfwise run|add|rerun|extras|ask ...`` (see ``--help``)."""

from __future__ import annotations

import argparse
import sys

from shelfwise.session import build_session, scale_settings


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="shelfwise")
    sub = parser.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="stage bronze -> bronze checks -> silver -> gold -> gate")
    run.add_argument("bronze_dir")
    run.add_argument("out_dir")
    run.add_argument("--from", dest="start_at", default="stage",
                     choices=["stage", "check_bronze", "silver", "gold", "gate"],
                     help="resume at this step, reading the tables earlier steps wrote")
    run.add_argument("--master", default=None)
    run.add_argument("--cores", type=int, default=0, help="total executor cores")
    run.add_argument("--input-gb", type=float, default=0.0,
                     help="volume of the bronze tables, local or remote; with --cores, sizes splits and shuffle partitions")
    add = sub.add_parser("add", help="add a folder of new bronze rows to a finished run")
    add.add_argument("bronze_dir")
    add.add_argument("out_dir")
    add.add_argument("--master", default=None)
    rerun = sub.add_parser("rerun", help="replace the inventory snapshots of some dates by those of a bronze folder")
    rerun.add_argument("bronze_dir")
    rerun.add_argument("out_dir")
    rerun.add_argument("dates", nargs="+", help="YYYY-MM-DD")
    rerun.add_argument("--master", default=None)
    extras = sub.add_parser("extras", help="write the extension metrics of a finished run")
    extras.add_argument("out_dir")
    extras.add_argument("--master", default=None)
    ask = sub.add_parser("ask", help="answer the analyst questions over gold")
    ask.add_argument("gold_dir")
    ask.add_argument("--sql", action="store_true", help="run the Spark SQL form of the questions")
    ask.add_argument("--master", default=None)
    args = parser.parse_args(argv)

    extra = None
    if args.cmd == "run" and (args.cores or args.input_gb):
        extra = scale_settings(args.input_gb, args.cores)
    spark = build_session(master=args.master, extra=extra)
    from shelfwise.plans import increments, layers

    if args.cmd in ("run", "add", "rerun"):
        if args.cmd == "run":
            summary = layers.run_layers(spark, args.bronze_dir, args.out_dir, start_at=args.start_at)
        elif args.cmd == "add":
            summary = increments.add_increment(spark, args.bronze_dir, args.out_dir)
        else:
            summary = increments.rerun_dates(spark, args.bronze_dir, args.out_dir, args.dates)
        for table, lines in summary.malformed.items():
            if lines:
                print(f"{table}: {lines} lines with values that don't fit their types")
        for report in summary.silver_rows:
            print(f"{report.table}: {report.before} rows, {report.after} kept, {report.removed} removed")
        print(f"gate: {len(summary.gate_rules)} rules passed")
    elif args.cmd == "extras":
        for name in layers.build_extensions(spark, args.out_dir):
            print(f"wrote {name}")
    else:
        answers = layers.answer_questions(spark, args.gold_dir)  # also registers the gold views
        if args.sql:
            from shelfwise.plans import analyst_sql

            answers = analyst_sql.ask_all(spark)
        for name, df in answers.items():
            print(f"== {name}")
            df.show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
