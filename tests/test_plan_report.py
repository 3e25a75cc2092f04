"""The plan-report parser reads a real plan of the fused query."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from plan_report import summarise  # noqa: E402

from gearwatch.plans.catalog import QUERIES  # noqa: E402
from tests.conftest import SF0001  # noqa: E402


def test_summarise_fused_plan(spark):
    plan = QUERIES["fused_alert_windows"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    s = summarise(plan)
    assert s["alert filter"] == "before the join"
    assert "1× hashpartitioning" in s["shuffles"]
    assert "BroadcastHashJoin LeftOuter" in s["joins"] and s["python"] == "no"
    assert "events.parquet: 5 cols" in s["scans"]
