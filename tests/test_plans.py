"""Plan review as a test: the fact-scale queries keep no Cartesian product,
nested-loop join or Python evaluation in their physical plans, and the
parquet scans of the written warehouse read only the columns they need."""

import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from plan_lint import lint, plan_text  # noqa: E402

from conftest import SMALL  # noqa: E402

HEAVY = ["kpi_arpu", "kpi_data_par_region", "snapshot_monthly", "fact_usage", "impute_group_median",
         "plan_point_in_time", "churn_risk"]


@pytest.mark.parametrize("name", HEAVY)
def test_no_unscalable_operators(spark, name):
    import __spark_entry__ as E
    assert lint(E.queries()[name](spark, SMALL)) == []


def test_mart_scan_is_pruned(spark):
    from telco_mart.operators import marts as M
    from telco_mart.plans.warehouse import Warehouse
    from telco_mart.session import scratch_path
    w = Warehouse(spark, SMALL).materialize(scratch_path(spark, f"t_plan_{uuid.uuid4().hex[:8]}"))
    text = plan_text(M.kpi_arpu(w.fact_usage, w.dim_subscriber, w.dim_plan, w.calendar))
    fact_schema = [line for line in text.splitlines() if "ReadSchema" in line and "amount_fcfa" in line]
    assert fact_schema, text
    # the usage scan reads a handful of columns, not the whole fact
    assert all(line.count(":") <= 8 for line in fact_schema), fact_schema
