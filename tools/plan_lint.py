"""Physical-plan lint of the registered queries.

usage: python tools/plan_lint.py [sf_dir] [name ...]

Builds each query (no result is collected) and inspects its formatted
physical plan for operators that do not scale: Cartesian products,
nested-loop joins, row-at-a-time or Arrow Python UDF evaluation, and
grouped pandas functions. Prints one line per query and exits non-zero when
any is found.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow", "FlatMapGroupsInArrow", "FlatMapCoGroupsInArrow", "PythonUDF")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def lint(df) -> list[str]:
    text = plan_text(df)
    return [op for op in FORBIDDEN if op in text]


def main() -> int:
    from telco_mart.plans.catalog import QUERIES as qs
    from telco_mart.session import checkpoint_dir, get_spark

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:]
    spark = get_spark(master="local[8]", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false"})
    checkpoint_dir(spark)
    bad = 0
    for name in names or list(qs):
        found = lint(qs[name](spark, sf_dir))
        bad += bool(found)
        print(f"{name}: {'OK' if not found else 'FOUND ' + ', '.join(found)}", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
