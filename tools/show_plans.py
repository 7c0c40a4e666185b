"""Run selected queries and write their physical plans to PLANS.md.

Usage: python tools/show_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventloom.plans.catalog import QUERIES  # noqa: E402
from eventloom.session import get_spark  # noqa: E402

DEFAULT = ["events", "sessions", "users", "event_properties", "hour_batches_capped", "events_incremental"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or DEFAULT
    spark = get_spark("local[8]", shuffle_partitions=16)
    out = ["# Physical plans", "",
           f"Generated by `tools/show_plans.py` at `{sf_dir}` on local[8]. These are the plans as "
           "planned before execution (AQE initial plans: static join and aggregation choices; at "
           "runtime AQE may still coalesce partitions, split skewed ones or switch a join to "
           "broadcast). Queries that return an already written table show a plain scan. "
           "Scratch paths are shortened.", ""]
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"file:/[^\]\s,]*/", "…/", plan)
        plan = re.sub(r"#\d+L?", "", plan)
        out += [f"## {name}", "", "```", plan.strip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
