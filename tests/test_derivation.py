"""What the derived inputs cost: shuffles, and partitions that grow with the input."""

from pyspark.sql import functions as F

from fixtures import derive, registry
from wayfunnel.operators import models
from wayfunnel.sources import workarea


def initial_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_what_is_stated_per_order_needs_no_shuffle_of_its_own(j):
    for build in (derive.searches, derive.checkout, derive.bookings):
        assert "Exchange" not in initial_plan(build(j.orders))
    assert j.orders.count() == j.base.count()


def test_the_offsets_of_cells_are_those_of_large_orders_only(spark, j, monkeypatch):
    lineitem = derive.given(spark, j.directory, "lineitem")
    plain = derive.options(lineitem, j.base)
    plan = plain._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan
    monkeypatch.setattr(derive, "WHOLE_LINES", 3)
    assert plain.exceptAll(derive.options(lineitem, j.base)).isEmpty()
    monkeypatch.setattr(derive, "WHOLE_LINES", 0)
    assert plain.exceptAll(derive.options(lineitem, j.base)).isEmpty()


def test_lines_are_shuffled_once_where_no_order_is_large(spark, j, monkeypatch):
    lineitem = derive.given(spark, j.directory, "lineitem")
    fresh = derive.Journey(spark, j.directory, "fresh")
    built = {}
    monkeypatch.setattr(fresh.area, "table", lambda name, build: built.setdefault(name, build()))
    plan = fresh.options._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") > 0 and "LeftAnti" not in plan and "LeftSemi" not in plan
    assert sorted(fresh.options.collect()) == sorted(derive.options(lineitem, j.base).collect())
    built.clear()
    monkeypatch.setattr(derive, "WHOLE_LINES", 3)
    assert "LeftAnti" in fresh.options._jdf.queryExecution().optimizedPlan().toString()


def test_large_orders_are_told_from_full_buckets(spark, monkeypatch):
    def lines(*orders):
        columns = ["l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag"]
        rows = spark.createDataFrame([(k, q) for k, q in orders], "l_orderkey long, l_quantity double")
        return rows.select("*", *[F.lit(1).alias(c) for c in columns], F.lit(0).alias("l_shipdate"))

    monkeypatch.setattr(derive, "WHOLE_LINES", 2)
    monkeypatch.setattr(derive, "ORDER_BUCKETS", 1)
    assert not derive.has_large_orders(lines((1, 20.0), (2, 20.0), (2, 20.0), (3, 20.0)))
    assert not derive.has_large_orders(lines((1, 20.0), (1, 20.0), (1, 5.0)))
    assert derive.has_large_orders(lines((1, 20.0), (2, 20.0), (2, 20.0), (2, 20.0)))


def test_written_tables_have_partitions_for_their_input(spark):
    name = workarea.SHUFFLE_PARTITIONS
    before, seen = spark.conf.get(name), []

    def build():
        seen.append(spark.conf.get(name))
        return spark.range(10).groupBy(F.col("id") % 3).count()

    for partitions in (3, 50):
        area = workarea.WorkArea(spark, f"sized-{partitions}", partitions * workarea.PARTITION_BYTES)
        assert area.table("t", lambda: area.table("inner", build).select("*")).count() == 3
        assert spark.conf.get(name) == before
    assert seen == [before, "51"]


def test_candidates_share_one_preparation_and_codes_need_no_more(j, monkeypatch):
    for cached in (registry._preparation, registry._encoding, registry.candidate):
        cached.cache_clear()
    fitted, real = [], models.fit_preparation
    monkeypatch.setattr(models, "fit_preparation", lambda rows: (fitted.append(1), real(rows))[1])
    monkeypatch.setattr(models, "_encoding", lambda: 1 / 0)  # scaling is not for ordinal codes
    codes = registry.queries()["ordinal_encoding"](j.spark, j.directory)
    assert codes.count() == 18 * registry._splits(j)[1].count()
    monkeypatch.setattr(models, "fit_histogram", lambda train, params, prepared: prepared)
    model = registry.candidate(j, models.HISTOGRAM).model
    assert model is registry._preparation(j) and fitted == [1]
    registry.candidate.cache_clear()
