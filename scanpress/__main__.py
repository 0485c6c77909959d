"""Command line for the three jobs (``python -m scanpress ...`` or ``spark-submit -m``-style launchers).

    python -m scanpress extract <replies> <out_dir> [--existing <articles table>] [--json] [--all-attempts]
    python -m scanpress corpus <html_dir> <out> [--sample N --seed S] [--bad-names <path>] [--partition-by issue]
    python -m scanpress missing <scans_dir> <articles_dir> <out>

Results are written where the arguments say; nothing is collected to the
driver (the missing-scan report is a table, not a printout).
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="scanpress", description="Newspaper scans to an article corpus, on Spark.")
    sub = parser.add_subparsers(dest="command", required=True)

    ext = sub.add_parser("extract", help="model replies -> named article documents, quarantine, cost, summary")
    ext.add_argument("replies")
    ext.add_argument("out_dir")
    ext.add_argument("--existing", help="articles table of an earlier run; new names avoid its names")
    ext.add_argument("--run-id", help="name of this run; repeated, it adds only what it had not committed (default: a new one)")
    ext.add_argument("--json", action="store_true", help="reply records are JSON lines (default Parquet)")
    ext.add_argument("--all-attempts", action="store_true", help="keep articles of every successful attempt, not the first")

    cor = sub.add_parser("corpus", help="folder of article HTML files -> corpus Parquet")
    cor.add_argument("html_dir")
    cor.add_argument("out")
    cor.add_argument("--sample", type=int, default=0, help="keep a deterministic sample of this many files (0 = all)")
    cor.add_argument("--seed", type=int, default=0)
    cor.add_argument("--bad-names", help="where names that break the naming contract are written")
    cor.add_argument("--partition-by", choices=["issue"], help="partition the corpus folders")

    mis = sub.add_parser("missing", help="scans that still have no article, naturally sorted")
    mis.add_argument("scans_dir")
    mis.add_argument("articles_dir")
    mis.add_argument("out")

    args = parser.parse_args(argv)

    from scanpress.session import get_spark

    spark = get_spark(app=f"scanpress-{args.command}")
    if args.command == "extract":
        from scanpress.plans.articles import run_extraction

        paths = run_extraction(
            spark, args.replies, args.out_dir, existing_names_path=args.existing,
            replies_format="json" if args.json else "parquet", first_success_only=not args.all_attempts, run_id=args.run_id,
        )
        print(json.dumps(paths))
    elif args.command == "corpus":
        from scanpress.plans.corpus import build_corpus

        build_corpus(
            spark, args.html_dir, args.out, sample_size=args.sample, seed=args.seed,
            bad_names_path=args.bad_names, partition_by=args.partition_by,
        )
    else:
        from scanpress.plans.missing import missing_scan_report

        missing_scan_report(spark, args.scans_dir, args.articles_dir).write.mode("overwrite").parquet(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
