"""Write PLANS.md: the physical plans of the headline queries.

    python tools/plans.py [sf_dir]
"""
from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    text = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    blocks = text.split("\n\n")
    lines = [blocks[0].strip(), ""]
    for b in blocks:
        m = re.match(r"\s*\((\d+)\) Scan parquet", b)
        if not m:
            continue
        filt = re.search(r"PushedFilters: (\[[^\n]*\])", b)
        schema = re.search(r"ReadSchema: ([^\n]*)", b)
        lines.append(f"scan ({m.group(1)}): pushed {filt.group(1) if filt else '[]'}; "
                     f"reads {schema.group(1) if schema else '?'}")
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from salescope.operators import customers as C
    from salescope.operators import ingest
    from salescope.operators import reports as R
    from salescope.plans.consolidate import Ingest
    from salescope.plans.schema_inference import SchemaInference
    from salescope.operators import profile as P
    from salescope.session import get_session
    from salescope.sources.fact import build_fact, sales_fact
    spark = get_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    fact = sales_fact(spark, sf)
    ig = Ingest(spark, sf)
    si = SchemaInference(spark, sf)
    items = [
        ("fact build (joins, clean, dedup, canonical name)", build_fact(spark, sf)),
        ("by_seller", R.by_seller(fact)),
        ("customer_detail", C.customer_detail(fact)),
        ("highlights", R.highlights(fact)),
        ("distinct_dedup over the stacked supplier rows", ingest.distinct_dedup(ig.cleaned())),
        ("profile_columns (content features)", P.content_profile(si.base)),
    ]
    texts = [(t, plan_text(d)) for t, d in items]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    texts.insert(1, ("fact build as planned when no table is under the broadcast size "
                     "(autoBroadcastJoinThreshold = -1, as at scale)",
                     plan_text(build_fact(spark, sf))))
    out = ["# Physical plans of the headline queries", "",
           f"`python tools/plans.py` on {sf}, local[8], AQE on (plans before runtime re-planning;",
           "AQE may still turn sort-merge joins into broadcasts and coalesce partitions).", "",
           "Notes: at sf0.1 every table but lineitem is under the 10 MB broadcast threshold",
           "(measured on file size), so the planner broadcasts them; the second plan shows the",
           "same query when no table qualifies, as at scale: sort-merge joins everywhere except",
           "nation, whose broadcast is requested only after a row-count bound is proven. In the",
           "fact build the canonical-name lookup (right side of the last join) repeats the plan",
           "of the dedup; at run time AQE reuses the shuffle of the joined order tables for it",
           "(`ReusedExchange`), so only the part join and the dedup aggregation run twice.", ""]
    for title, text in texts:
        out += [f"## {title}", "", "```", text, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()
