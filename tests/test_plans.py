"""Shape of the physical plans: what is read, what is shuffled, what is kept out."""

import pytest

from checks.queries import QUERIES
from qaspark.operators import graph, trend
from qaspark.sources import adapters

FOLDER = "/root/testdata/sf0.001"
def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["dedupe_first", "latest_within_ttl", "sample_per_year", "representatives", "top_tags", "top_cotags"])
def test_top_rows_are_cut_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    partial = plan.rindex("WindowGroupLimit")
    assert "Partial" in plan[partial : partial + 400]


def test_only_needed_columns_are_read(spark):
    plan = plan_of(trend.answer_rate_by_language(adapters.questions(spark, FOLDER)))
    assert "ReadSchema: struct<o_orderstatus:string,o_orderpriority:string>" in plan
    plan = plan_of(graph.tag_frequency(adapters.tagged_questions(spark, FOLDER)))
    assert "o_totalprice" not in plan and "o_orderdate" not in plan


def test_filters_reach_the_scan(spark):
    from checks.queries import latest_response, tagged_between

    assert "GreaterThanOrEqual(ts" in plan_of(latest_response(spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in plan_of(tagged_between(spark, FOLDER))


def test_quantiles_read_their_input_twice(spark, monkeypatch):
    """One scan of the orders for counts, rates and sketches, one for the values inside the brackets, over all jobs that run."""
    from qaspark import session
    from qaspark.operators import quantiles

    plans = []

    def watched(df, name="table", **metrics):
        written = session.measured_write(df, name, **metrics)
        plans.append(plan_of(df))
        return written

    monkeypatch.setattr(quantiles, "measured_write", watched)
    df = trend.yearly_counts(adapters.questions(spark, FOLDER))
    df.collect()
    plans.append(plan_of(df).split("== Initial Plan ==")[0])
    scans = [line for plan in plans for line in plan.splitlines() if "FileScan" in line]
    assert sum("orders.parquet" in line or "o_orderkey" in line for line in scans) == 2
    # Each stored table of the way is as small as the number of groups and kept values.
    assert len(plans) >= 4
