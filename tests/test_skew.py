"""Hot keys: one key with a large share of the rows must neither change results nor fill one task."""

import hashlib

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from fixtures import derive
from wayfunnel.operators import evaluation, marts, quality, staging
from wayfunnel.operators.curves import ranked_buckets, score_counts
from wayfunnel.plans.warehouse import build_funnel
from wayfunnel.settings import TARGET


def plan_of(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def skew_settings(spark):
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in values.items():
        spark.conf.set(key, value)
    yield
    for key in values:
        spark.conf.unset(key)


@pytest.fixture(scope="module")
def hot_session(j):
    """The given journey with 40 % of the searches moved into one session."""
    staged = j.staged_tables()
    hot = staged["sessions"].agg(F.min("session_id")).first()[0]
    moved = F.abs(F.xxhash64("search_id")) % 10 < 4
    searches = staged["searches"].withColumn(
        "session_id", F.when(moved, hot).otherwise(F.col("session_id"))
    )
    path = j.area.path("hot_searches")
    searches.repartition(8).write.mode("overwrite").parquet(path)
    return staged | {"searches": j.spark.read.parquet(path)}, hot


def test_session_join_splits_a_hot_session(spark, hot_session, skew_settings):
    staged, hot = hot_session
    funnel = build_funnel(staged)
    assert "skew=true" in plan_of(funnel)
    rows = funnel.where(F.col("session_id") == hot)
    expected = staged["searches"].where(F.col("session_id") == hot).count()
    assert rows.count() == expected > 0.3 * staged["searches"].count()
    assert rows.select("customer_id").distinct().count() == 1


def test_marts_of_a_hot_session(hot_session):
    staged, hot = hot_session
    funnel = build_funnel(staged)
    rows = funnel.select("session_id", "booked_flag").collect()
    booked = {}
    for session, flag in rows:
        booked[session] = max(booked.get(session, 0), flag)
    kpi = marts.kpi_summary(funnel).first()
    assert kpi["sessions"] == len(booked)
    assert kpi["session_conversion_rate_pct"] == pytest.approx(
        100 * sum(booked.values()) / len(booked), abs=0.005
    )


def test_checks_shuffle_one_row_per_key_and_task(hot_session):
    """The ledgers group before they shuffle: the partial aggregate sits below the exchange."""
    staged, _ = hot_session
    plan = plan_of(quality.session_checks(staged["sessions"], staged["searches"]))
    assert "partial_sum" in plan and "Join" not in plan


def lines_with_a_hot_order(spark):
    lineitem = derive.given(spark, SF, "lineitem")
    moved = F.abs(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey")) % 10 < 4
    return lineitem.withColumn("l_orderkey", F.when(moved, 7).otherwise(F.col("l_orderkey")))


def test_hot_order_is_numbered_like_any_other(spark, j):
    numbered = derive.options(lines_with_a_hot_order(spark), j.base).toPandas()
    lines = lines_with_a_hot_order(spark).toPandas().merge(
        j.base.select("k", "d", "dest").toPandas(), left_on="l_orderkey", right_on="k"
    )
    scarce = (lines["dest"] == "Hub A") & lines["d"].between(
        derive.SUPPLY.incident.first, derive.SUPPLY.incident.last
    )
    lines = lines[lines["l_quantity"] > np.where(scarce, 30.0, 10.0)]
    text = [f"{n}-{p}-{s}" for n, p, s in lines[["l_linenumber", "l_partkey", "l_suppkey"]].values]
    lines["digest"] = [hashlib.md5(t.encode()).hexdigest() for t in text]
    lines = lines.sort_values(["digest", "l_quantity", "l_extendedprice", "l_shipdate"])
    lines["pos"] = lines.groupby("k").cumcount() + 1
    lines["rc"] = lines.groupby("k")["pos"].transform("size")
    wanted = lines[["k", "l_partkey", "l_suppkey", "pos", "rc"]].values.tolist()
    assert sorted(numbered[["k", "pk", "sk", "pos", "rc"]].values.tolist()) == sorted(wanted)
    assert (numbered["k"] == 7).sum() > 1000


def test_staged_results_of_a_hot_search(spark, j):
    option_rows = derive.options(lines_with_a_hot_order(spark), j.base)
    results = staging.stage_journey_results(derive.journey_results(option_rows))
    funnel = build_funnel(j.staged_tables() | {"journey_results": results})
    assert funnel.count() == j.raw("searches").count()
    checks = quality.search_checks(j.staged("searches"), results, j.staged("checkout"))
    found = {r["check"]: r["violations"] for r in checks.collect()}
    assert found["one_selection_per_search"] == 0 and found["orphan_results"] == 0


def test_one_score_for_all_rows_is_ranked_in_many_cells(j):
    """The worst tie: every row has the same score."""
    scored = j.dataset.withColumn("score", F.lit(0.3))
    assert score_counts(scored, "score", TARGET).count() == 1
    table = evaluation.decile_analysis(scored, label=TARGET).collect()
    assert sorted(r["searches"] for r in table) == [150] * 10
    cells = ranked_buckets(scored, lambda rank, n: F.floor(rank * 4 / n), label=TARGET)
    assert cells.agg(F.sum("n")).first()[0] == scored.count()


def test_running_totals_do_not_depend_on_partitioning(j):
    scored = derive.formula_score(j.dataset)
    first = evaluation.model_metrics(scored, label=TARGET).first()
    again = evaluation.model_metrics(scored.repartition(3), label=TARGET).first()
    assert first.asDict() == pytest.approx(again.asDict())


@pytest.mark.parametrize(
    "name,scans",
    [
        ("model_metrics", 1),
        ("roc_curve", 1),
        ("decile_analysis_tied", 3),
        ("imputation_values", 2),
        ("dq_model_dataset", 1),
    ],
)
def test_inputs_are_scanned_once_per_level(spark, name, scans):
    """Branches of one operator share their shuffles."""
    from fixtures.registry import queries

    plan = plan_of(queries()[name](spark, SF)).split("== Initial Plan ==")[0]
    assert plan.count("FileScan") <= scans
