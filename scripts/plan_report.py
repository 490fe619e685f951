"""Per-query physical-plan summary (executed, final AQE plan).

usage: python scripts/plan_report.py [sf_dir] [--scale] [name ...]

``--scale`` disables size-estimated broadcasts (autoBroadcastJoinThreshold=-1)
and the bounded dimension probes' hint threshold stays as coded, to show the
plan shape a 100 TB run would get for tables that no longer fit a broadcast.
"""

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesmart.plans.queries import QUERIES  # noqa: E402
from salesmart.session import build_session  # noqa: E402

args = [a for a in sys.argv[1:] if not a.startswith("--")]
scale = "--scale" in sys.argv
sf = args[0] if args else "/root/testdata/sf0.01"
names = args[1:] or list(QUERIES)
conf = {"spark.sql.autoBroadcastJoinThreshold": "-1"} if scale else {}
spark = build_session(master="local[8]", shuffle_partitions=8, extra_conf=conf)

KINDS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobin", "Exchange SinglePartition",
         "ReusedExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "Window", "MapInPandas", "ArrowEvalPython", "BatchEvalPython", "HashAggregate",
         "ObjectHashAggregate", "SortAggregate"]
print(f"{'query':36s} " + " ".join(k.split()[-1][:10].rjust(10) for k in KINDS))
for n in names:
    df = QUERIES[n](spark, sf)
    df.collect()  # runs df's own plan, so the executed plan below is AQE's final plan
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    c = Counter()
    for k in KINDS:
        c[k] = len(re.findall(re.escape(k) + r"\b", plan))
    print(f"{n:36s} " + " ".join(str(c[k]).rjust(10) for k in KINDS))
spark.stop()
