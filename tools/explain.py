"""Print the physical plan of a registered query.

Usage: python tools/explain.py <query> [sf_dir] [--run]

Without ``--run`` prints the formatted plan Catalyst chose (queries that
need centers still run their sample and k-means to build it).  With
``--run`` the query is executed and the final adaptive plan is printed, with
the runtime decisions (coalesced shuffles, broadcasts, skew splits).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from postcluster.plans.catalog import QUERIES  # noqa: E402
from postcluster.session import local_session  # noqa: E402


def main(argv: list[str]) -> int:
    run = "--run" in argv
    args = [a for a in argv if a != "--run"]
    if not args or args[0] not in QUERIES:
        print("usage: python tools/explain.py <query> [sf_dir] [--run]", file=sys.stderr)
        print("queries: " + ", ".join(QUERIES), file=sys.stderr)
        return 2
    sf_dir = args[1] if len(args) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    try:
        df = QUERIES[args[0]](spark, sf_dir)
        if run:
            df.write.format("noop").mode("overwrite").save()
            print(df._jdf.queryExecution().executedPlan().toString())
        else:
            df.explain(mode="formatted")
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
