"""Print the physical operator tree of registered queries (after execution, AQE final plan).

Usage: python scripts/plan_summary.py [sf_dir] [name,name,...] > docs/PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scanpress.plans.queries import QUERIES  # noqa: E402
from scanpress.session import get_spark  # noqa: E402

DEFAULT = ["extract_articles", "article_html", "unique_names", "html_meta", "missing_scans", "cost_by_model",
           "first_success", "sample_n", "natural_sort", "build_requests", "corpus"]
KEEP = re.compile(
    r"(Exchange|Join|Aggregate|Window|ArrowEvalPython|MapInPandas|Generate|Scan|TakeOrdered|Sort |Sort$|Union|"
    r"AQEShuffleRead|WholeStageCodegen|Expand|CollectLimit)"
)


def summary(df) -> list[str]:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = []
    for line in plan.splitlines():
        text = re.sub(r"#\d+L?", "", line)
        text = re.sub(r"\[[^\]]{120,}\]", "[...]", text)
        if KEEP.search(text):
            scan = re.search(r"ReadSchema: (struct<[^>]*>)", line)
            head = text.split(" Batched:")[0][:150].rstrip()
            lines.append(head + (f"  ReadSchema={scan.group(1)[:120]}" if scan else ""))
    return lines


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2].split(",") if len(sys.argv) > 2 else DEFAULT
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `scripts/plan_summary.py` at `{sf}` on local[8] (final adaptive plans, operators that move or")
    print("aggregate data, Python evaluation and scans only; expression lists elided).\n")
    for name in names:
        print(f"## {name}\n\n```")
        print("\n".join(summary(QUERIES[name](spark, sf))))
        print("```\n")
    print("## rank_within with a hot group\n")
    print("The registered inputs have no hot (stem, slug) group, so naming above is one window. Here one group of a")
    print("synthetic table holds half of the rows: it takes the range-split branch (local numbers per range partition,")
    print("offsets from the boundary table, broadcast), the other rows the plain window, and the two are unioned.\n")
    from pyspark.sql import functions as F

    from scanpress.operators.ranking import rank_within

    hot = spark.range(400_000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string")).alias("g"),
        ((F.col("id") * 7919) % 400_009).alias("o"),
    )
    print("```")
    print("\n".join(summary(rank_within(hot, ["g"], ["o"], "r"))))
    print("```")


if __name__ == "__main__":
    main()
