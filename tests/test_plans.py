"""Whole stages on written inputs, read back from what they wrote."""

import json
import re
from datetime import datetime

import pytest
from conftest import one
from pyspark.sql import functions as F

from fixtures.derive import CHECKOUT, SPLIT, SUPPLY, scoring_requests
from wayfunnel.operators import evaluation, features, incidents, models, quality
from wayfunnel.plans.investigation import investigate
from wayfunnel.plans.modelling import published, score_batch, train_and_evaluate
from wayfunnel.plans.warehouse import build_warehouse
from wayfunnel.settings import HistogramBoostingParams, ModelParams, SplitDates
from wayfunnel.sources import exports, raw, warehouse, workarea

PREFIX = "wf_test_"


@pytest.fixture(scope="module")
def inputs(j, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    for name, frame in j.raw_tables().items():
        frame.write.parquet(raw.raw_path(folder, name))
    return folder


@pytest.fixture(scope="module")
def built(spark, inputs, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("marts"))
    return build_warehouse(spark, inputs, out, PREFIX), out


def document(spark, path):
    return json.loads(spark.read.text(path).first()[0])


def test_missing_inputs_are_listed(spark, inputs, tmp_path):
    assert raw.missing_inputs(spark, inputs) == []
    spark.range(1).write.parquet(raw.raw_path(str(tmp_path), "sessions"))
    with pytest.raises(FileNotFoundError, match="'searches', 'journey_results'"):
        raw.read_raw(spark, str(tmp_path))


def test_warehouse_writes_checked_marts(spark, j, built):
    written, out = built
    assert len(written) == 10
    for name, frame in written.items():
        exported = spark.read.parquet(f"{out}/{name.replace('.', '_')}.parquet")
        assert exported.count() == frame.count()
        assert warehouse.open_table(spark, name, PREFIX).columns == exported.columns
    assert spark.table("raw_sessions").count() == j.raw("sessions").count()
    files = spark.read.parquet(f"{out}/analytics_search_funnel.parquet").inputFiles()
    assert all(".zstd." in f for f in files)
    summary = document(spark, f"{out}/warehouse_summary.json")
    assert summary["searches"] == 1500
    alerts = written["product.daily_anomaly_alerts"]
    assert summary["anomaly_alert_days"] == alerts.where("alert_flag = 1").count()


def test_build_stops_before_exporting_when_a_check_fails(spark, inputs, j, tmp_path):
    bad, out = tmp_path / "raw", tmp_path / "out"
    for name, frame in j.raw_tables().items():
        frame.write.parquet(raw.raw_path(str(bad), name))
    j.raw("sessions").limit(10).write.mode("overwrite").parquet(raw.raw_path(str(bad), "sessions"))
    with pytest.raises(quality.QualityError, match="orphan_searches"):
        build_warehouse(spark, str(bad), str(out), "wf_bad_")
    assert not out.exists()


def test_build_stops_at_a_row_without_key(spark, j, tmp_path):
    bad, out = tmp_path / "raw", tmp_path / "out"
    for name, frame in j.raw_tables().items():
        if name == "bookings":
            first = F.col("booking_id") != frame.agg(F.min("booking_id")).first()[0]
            frame = frame.withColumn("booking_id", F.when(first, F.col("booking_id")))
        frame.write.parquet(raw.raw_path(str(bad), name))
    with pytest.raises(quality.QualityError, match="'null_key_bookings': 1"):
        build_warehouse(spark, str(bad), str(out), "wf_null_")
    assert not out.exists()


def test_staged_tables_have_names(spark, built, j):
    for name, frame in j.staged_tables().items():
        table = warehouse.open_table(spark, f"staging.{name}", PREFIX)
        assert table.count() == frame.count() and table.columns == frame.columns


def test_investigation_writes_tables_and_summary(spark, built, tmp_path):
    results = investigate(spark, str(tmp_path), PREFIX, SUPPLY, CHECKOUT)
    segments = spark.read.option("header", True).csv(f"{tmp_path}/segment_performance.csv")
    assert segments.count() == results["segment_performance"].count() > 0
    summary = document(spark, f"{tmp_path}/investigation_summary.json")
    assert summary["overall"]["searches"] == 1500
    assert "zero_result_test_p_value" in summary["supply_incident"]
    assert summary["anomaly_alert_days"] == results["anomaly_alert_days"].count()
    assert results["daily_metrics"].count() == built[0]["analytics.daily_funnel"].count()


def test_modelling_stage(spark, j, tmp_path):
    params = ModelParams(histogram=HistogramBoostingParams(rounds=3))
    result = train_and_evaluate(j.dataset, str(tmp_path), SPLIT, params)
    assert result.champion in models.CANDIDATES
    table = spark.read.option("header", True).csv(f"{tmp_path}/test_metrics.csv")
    assert [r["metric"] for r in table.collect()] == list(evaluation.METRICS)
    assert result.tables["feature_importance"].count() == 18
    info = document(spark, f"{tmp_path}/model_info.json")
    assert info["threshold"] == result.threshold and len(info["features"]) == 18
    assert info["best_f1_threshold"] == result.threshold
    rows = info["train_rows"] + info["validation_rows"] + info["test_rows"]
    assert rows == j.dataset.count()
    assert info["ranking"][0] == result.champion and len(info["ranking"]) == 3
    assert len(info["top_features"]) == 10

    requests = scoring_requests(j.dataset)
    assert published(spark, str(tmp_path)) == (result.champion, result.threshold)
    assert published(spark, f"{tmp_path}/nowhere") == ("Unknown", 0.5)
    scored, rejected = score_batch(requests, result.model_path)
    assert scored.count() + rejected.count() == requests.count()
    assert rejected.where("isnan(search_latency_ms)").count() > 0
    bounds = one(scored.agg(F.min("booking_probability"), F.max("booking_probability")))
    assert all(0 <= b <= 1 for b in bounds.values())


def test_saved_tables_can_be_partitioned_and_bucketed(spark, j):
    warehouse.create_layers(spark, PREFIX)
    quarter = j.funnel.where("search_date between '1998-01-01' and '1998-03-31'")
    by_day = warehouse.save_table(quarter, "analytics.by_day", PREFIX, ["search_date"])
    assert by_day.count() == quarter.count()
    assert len(by_day.inputFiles()) == quarter.select("search_date").distinct().count()
    compared = incidents.incident_comparison(by_day, SUPPLY, incidents.SUPPLY)
    plan = compared._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[\(+search_date", plan)
    assert "PushedFilters: [Or(EqualTo(origin_station,Hub A)" in plan

    for name, frame in (("searches", j.staged("searches")), ("sessions", j.staged("sessions"))):
        warehouse.save_table(frame, f"staging.{name}", PREFIX, bucket_by=(4, "session_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table(PREFIX + "staging.searches").join(
            spark.table(PREFIX + "staging.sessions"), "session_id"
        )
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_csv_export_has_one_file_and_a_header(spark, tmp_path):
    numbers = spark.range(100).repartition(8)
    exports.export_csv(numbers, str(tmp_path / "t.csv"), [F.desc("id")])
    (part,) = (tmp_path / "t.csv").glob("part-*")
    assert part.read_text().split() == ["id", *map(str, range(99, -1, -1))]


def test_work_area_follows_the_session_folder_and_input_changes(spark, tmp_path):
    folder = workarea.shared_folder(spark)
    assert folder == spark.conf.get(workarea.CHECKPOINT_DIR, folder).rstrip("/")
    assert workarea.WorkArea(spark, "key").root.startswith(folder)
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    before = workarea.fingerprint(spark, str(tmp_path), ["t"])
    assert before == workarea.fingerprint(spark, str(tmp_path), ["t"])
    spark.range(4).write.mode("overwrite").parquet(str(tmp_path / "t.parquet"))
    assert before != workarea.fingerprint(spark, str(tmp_path), ["t"])


def test_a_failed_rebuild_leaves_the_old_table(spark):
    name = f"{PREFIX}analytics.kept"
    warehouse.create_layers(spark, PREFIX)
    warehouse.save_table(spark.range(10), "analytics.kept", PREFIX)
    late = F.when(F.col("id") == 7, F.raise_error(F.lit("late"))).otherwise(F.col("id"))
    with pytest.raises(Exception, match="late"):
        warehouse.save_table(spark.range(20).select(late.cast("long").alias("id")), "analytics.kept", PREFIX)
    assert spark.table(name).count() == 10
    # a table may be read while it is replaced
    doubled = spark.table(name).unionByName(spark.table(name))
    assert warehouse.save_table(doubled, "analytics.kept", PREFIX).count() == 20
    tables = [t.name for t in spark.catalog.listTables(f"{PREFIX}analytics") if "kept" in t.name]
    assert len(tables) == 2 and "kept" in tables  # the name and its one version
    bucketed = warehouse.save_table(
        spark.table(name).withColumn("day", F.col("id") % 2), "analytics.kept", PREFIX, ["day"]
    )
    assert bucketed.where("day = 1").count() == 10


def test_a_failed_swap_leaves_the_old_table(spark):
    name = f"{PREFIX}analytics.swapped"
    warehouse.create_layers(spark, PREFIX)
    warehouse.save_table(spark.range(3), "analytics.swapped", PREFIX)
    with pytest.raises(Exception, match="no_such"):
        warehouse._show(spark, name, f"{PREFIX}analytics.no_such")
    assert spark.table(name).count() == 3


def test_splits_read_only_the_partitions_of_their_days(spark, j):
    warehouse.create_layers(spark, PREFIX)
    funnel = warehouse.save_table(j.funnel, "analytics.by_day", PREFIX, ["search_date"])
    dataset = features.model_rows(funnel, with_day=True)
    plain = features.temporal_split(features.model_rows(j.funnel), SPLIT)
    for split, same in zip(features.temporal_split(dataset, SPLIT), plain, strict=True):
        plan = split._jdf.queryExecution().executedPlan().toString()
        filters = re.search(r"PartitionFilters: \[(.*?)\]", plan).group(1)
        assert "search_date" in filters and ("<=" in filters or ">=" in filters)
        assert split.drop("search_date").exceptAll(same).count() == 0 and split.count() == same.count()
    moment = datetime(1999, 1, 1, 12)
    early, _, _ = features.temporal_split(dataset, SplitDates(moment, SPLIT.test_from))
    assert early.count() == j.funnel.where(F.col("searched_at") < F.lit(moment.isoformat(" ")).cast("timestamp_ntz")).count()
