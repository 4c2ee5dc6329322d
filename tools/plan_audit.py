"""Build every registered query and scan its physical plan for patterns that do not scale.

Flags: Cartesian / nested-loop joins (cross joins), single-partition exchanges
(a whole table in one task), Python UDF nodes, and scans without pushed filters
where the query filters.  Usage: python tools/plan_audit.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import local_session  # noqa: E402
from tessera.workloads import load_all  # noqa: E402

PATTERNS = {
    "cross": re.compile(r"CartesianProduct|BroadcastNestedLoopJoin"),
    "single_partition": re.compile(r"Exchange SinglePartition"),
    "python": re.compile(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas"),
}


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = local_session()
    for key, q in load_all().items():
        if keys and key not in keys:
            continue
        try:
            txt = plan_text(q.run(spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            print(f"{key}: ERROR {type(e).__name__}: {str(e)[:200]}")
            continue
        hits = [name for name, rx in PATTERNS.items() if rx.search(txt)]
        n_ex = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning", txt))
        print(f"{key}: exchanges={n_ex} {' '.join(hits)}")


if __name__ == "__main__":
    main()
