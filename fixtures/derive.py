"""The six input tables of the library, derived from orders, lineitem, customer and nation.

order -> search, customer and year -> session, qualifying line -> journey option, chosen option ->
checkout, completed checkout -> booking, nation -> station. Two incidents are planted: supply
(destination Hub A, March 1998) and checkout (mobile web and Android, June 1998).
``fixtures/oracle.py`` states the same derivation as SQL.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import lru_cache, partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfunnel.operators import features, staging
from wayfunnel.plans.warehouse import build_funnel
from wayfunnel.settings import Incident, Period, Scope, SplitDates
from wayfunnel.sources.together import run_together
from wayfunnel.sources.workarea import WorkArea, fingerprint, stored_bytes

SUPPLY = Incident(
    Scope(stations=("Hub A",)),
    baseline=Period(date(1997, 11, 10), date(1998, 3, 1)),
    incident=Period(date(1998, 3, 2), date(1998, 3, 29)),
)
CHECKOUT = Incident(
    Scope(device_types=("Mobile Web", "Android App")),
    baseline=Period(date(1998, 2, 9), date(1998, 5, 31)),
    incident=Period(date(1998, 6, 1), date(1998, 6, 28)),
)
SPLIT = SplitDates(datetime(1999, 1, 1), datetime(2000, 1, 1))

WHOLE_LINES = 10_000  # lines of an order that one task may number
ORDER_BUCKETS = 262_144  # hash buckets of orders that are searched for such an order
CELL_DIGITS = 2  # hex digits of a line's md5: an order is numbered in up to 256 cells

GIVEN = ["orders", "lineitem", "customer", "nation", "region"]


def given(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def _later(at: str, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.col(at))


def _pick(index: Column, *labels: str) -> Column:
    return F.element_at(F.array(*map(F.lit, labels)), (index + 1).cast("int"))


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def session_id() -> Column:
    return F.concat(F.lit("S"), "ck", F.lit("-"), "yr").alias("session_id")


def base_orders(spark: SparkSession, directory: str) -> DataFrame:
    """Orders with their customer and nation, and the attributes of the search they become."""
    orders = given(spark, directory, "orders")
    customers = given(spark, directory, "customer")
    nations = given(spark, directory, "nation")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey).join(
        nations, customers.c_nationkey == nations.n_nationkey
    )
    k, hub = F.col("k"), F.col("k") % 10
    named = joined.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("ck"),
        F.col("n_name").alias("nation"),
        F.col("c_mktsegment").alias("seg"),
        F.col("c_acctbal").alias("bal"),
        F.col("o_orderstatus").alias("st"),
        F.col("o_orderpriority").alias("prio"),
        F.col("o_orderdate").cast("date").alias("d"),
        F.year("o_orderdate").alias("yr"),
        F.col("o_orderdate").alias("ordered_at"),
    )
    return named.select(
        "*",
        _later("ordered_at", (k * 7919) % 86400).alias("searched_at"),
        session_id(),
        ((F.col("ck") + F.col("yr")) % 4).alias("dev"),
        F.when(hub < 5, "Hub A")
        .when(hub < 8, "Hub B")
        .when(hub < 9, "Hub C")
        .otherwise("Hub D")
        .alias("dest"),
    ).drop("ordered_at")


def _min_quantity() -> Column:
    day = F.col("d")
    scarce = SUPPLY.incident.contains(day) & (F.col("dest") == "Hub A")
    return F.when(scarce, 30.0).otherwise(10.0)


def _lines(lineitem: DataFrame) -> DataFrame:
    """Lines that may qualify, whatever the order."""
    return lineitem.where(F.col("l_quantity") > 10.0).select(
        F.col("l_orderkey").alias("k"),
        F.col("l_partkey").alias("pk"),
        F.col("l_suppkey").alias("sk"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("fare"),
        F.col("l_returnflag").alias("rf"),
        F.col("l_shipdate").alias("shipped"),
    )


def _large_orders(lines: DataFrame) -> DataFrame:
    return lines.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > WHOLE_LINES)


def has_large_orders(lineitem: DataFrame) -> bool:
    """Whether any order has too many lines for one task.

    Lines are counted by a hash of their order, which shuffles a row per bucket and task; orders are
    counted only in buckets that hold enough lines for such an order.
    """
    lines = _lines(lineitem).withColumn("bucket", F.pmod(F.hash("k"), F.lit(ORDER_BUCKETS)))
    counts = lines.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    heavy = counts.where(F.col("n") > WHOLE_LINES).select("bucket")
    if heavy.isEmpty():
        return False
    return not _large_orders(lines.join(heavy, "bucket", "left_semi")).isEmpty()


ORDERED = ["digest", "qty", "fare", "shipped"]
OPTION_COLUMNS = ["k", "d", "st", "pk", "sk", "fare", "rf", "pos", "rc"]


def _qualifying(lines: DataFrame, base: DataFrame) -> DataFrame:
    digest = F.md5(F.concat_ws("-", "line", "pk", "sk").cast("binary"))
    joined = lines.join(base.select("k", "d", "st", "dest"), "k")
    return joined.where(F.col("qty") > _min_quantity()).withColumn("digest", digest)


def _numbered_whole(lines: DataFrame, base: DataFrame) -> DataFrame:
    whole = Window.partitionBy("k")
    numbered = _qualifying(lines, base).withColumns(
        {
            "pos": F.row_number().over(whole.orderBy(*ORDERED)).cast("bigint"),
            "rc": F.count(F.lit(1)).over(whole),
        }
    )
    return numbered.select(*OPTION_COLUMNS)


def whole_options(lineitem: DataFrame, base: DataFrame) -> DataFrame:
    """The same as ``options`` where no order is large: the lines are shuffled once."""
    return _numbered_whole(_lines(lineitem), base)


def options(lineitem: DataFrame, base: DataFrame) -> DataFrame:
    """Qualifying lines with their position in the order and the number of such lines.

    The position is a row number per order, in the order of an md5 of the line. Lines of an order
    with very many are numbered inside cells of their order (the first digits of that md5) and moved
    by the cell's offset, so an order of any size is numbered by many tasks. All others are numbered
    where the join by order has put them, without another shuffle.
    """
    lines = _lines(lineitem)
    large = _large_orders(lines)
    few = _numbered_whole(lines.join(large, "k", "left_anti"), base)
    whole = Window.partitionBy("k")
    many = _qualifying(lines.join(large, "k", "left_semi"), base)
    cells = many.withColumn("cell", F.substring("digest", 1, CELL_DIGITS))
    before = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cells.groupBy("k", "cell")
        .agg(F.count(F.lit(1)).alias("cell_n"))
        .select(
            "k",
            "cell",
            F.coalesce(F.sum("cell_n").over(before), F.lit(0)).alias("offset"),
            F.sum("cell_n").over(whole).alias("rc"),
        )
    )
    inside = Window.partitionBy("k", "cell").orderBy(*ORDERED)
    numbered = (
        cells.withColumn("place", F.row_number().over(inside))
        .join(offsets, ["k", "cell"])
        .withColumn("pos", F.col("offset") + F.col("place"))
    )
    return few.unionByName(numbered.select(*OPTION_COLUMNS))


def sessions(base: DataFrame) -> DataFrame:
    ck, dev = F.col("ck"), F.col("dev")
    system = (
        F.when(dev == 0, _pick(ck % 3, "Windows", "macOS", "Linux"))
        .when(dev == 1, _pick(ck % 2, "iOS", "Android"))
        .when(dev == 2, "iOS")
        .otherwise("Android")
    )
    keys = ["ck", "yr", "dev", "seg", "nation", "bal"]
    return (
        base.groupBy(*keys)
        .agg(F.min("searched_at").alias("session_started_at"))
        .select(
            session_id(),
            F.concat(F.lit("C"), "ck").alias("customer_id"),
            "session_started_at",
            device_type().alias("device_type"),
            system.alias("operating_system"),
            F.col("seg").alias("acquisition_channel"),
            F.when(ck % 8 < 3, "New").otherwise("Returning").alias("customer_type"),
            F.col("nation").alias("country"),
            _flag(F.col("bal") > 2500).alias("is_logged_in"),
        )
    )


def device_type() -> Column:
    return _pick(F.col("dev"), "Desktop Web", "Mobile Web", "iOS App", "Android App")


def _chosen() -> Column:
    return F.col("st").isin("F", "P") & (F.col("pos") == 1 + F.col("k") % F.col("rc"))


def with_options(base: DataFrame, option_rows: DataFrame) -> DataFrame:
    """Every order with the number of its options and the chosen one, if there is one. All that is
    stated per order is a projection of it."""
    kept = option_rows.where((F.col("pos") == 1) | _chosen())
    found = kept.groupBy("k").agg(
        F.max("rc").alias("rc"),
        F.max(_chosen()).alias("chosen"),
        F.max(F.when(_chosen(), F.col("fare"))).alias("fare"),
        F.max(F.when(_chosen(), F.col("sk"))).alias("sk"),
    )
    return base.join(found, "k", "left")


def searches(orders: DataFrame) -> DataFrame:
    k = F.col("k")
    count = F.coalesce("rc", F.lit(0))
    return orders.select(
        F.concat(F.lit("Q"), "k").alias("search_id"),
        "session_id",
        "searched_at",
        F.col("nation").alias("origin_station"),
        F.col("dest").alias("destination_station"),
        F.date_add("d", (k % 61).cast("int")).alias("travel_date"),
        (1 + k % 5).cast("int").alias("passengers"),
        F.when(F.col("prio").isin("1-URGENT", "2-HIGH"), "Single")
        .otherwise("Return")
        .alias("journey_type"),
        _flag(F.col("ck") % 3 == 0).alias("railcard_used"),
        count.cast("int").alias("results_count"),
        (180 + (k * 31) % 1500).cast("int").alias("search_latency_ms"),
        _flag(count == 0).alias("zero_results_flag"),
    )


def journey_results(option_rows: DataFrame) -> DataFrame:
    k, pk = F.col("k"), F.col("pk")
    duration = 20 + pk % 401
    travel = F.date_add("d", (k % 61).cast("int")).cast("timestamp_ntz")
    departs = (5 + pk % 18) * 3600
    return option_rows.withColumn("travel", travel).select(
        F.concat(F.lit("R"), "k", F.lit("-"), "pos").alias("result_id"),
        F.concat(F.lit("Q"), "k").alias("search_id"),
        F.concat(F.lit("Operator "), F.col("sk") % 10).alias("operator"),
        _later("travel", departs).alias("departure_time"),
        _later("travel", departs + duration * 60).alias("arrival_time"),
        duration.cast("int").alias("duration_minutes"),
        (F.col("sk") % 3).cast("int").alias("changes"),
        "fare",
        F.when(F.col("rf") == "A", "Advance")
        .when(F.col("rf") == "N", "Off-Peak")
        .otherwise("Anytime")
        .alias("fare_type"),
        F.col("pos").cast("int").alias("result_position"),
        _flag(_chosen()).alias("selected_flag"),
    )


def _attempts(orders: DataFrame) -> DataFrame:
    """The orders with a chosen option, with their checkout outcome."""
    mobile = F.col("dev").isin(1, 3)
    broken = CHECKOUT.incident.contains(F.col("d")) & mobile & (F.col("k") % 5 == 0)
    error = (F.col("k") % 19 == 0) | broken
    failure = ~error & (F.col("k") % 23 == 0)
    return orders.where("chosen").withColumns(
        {
            "error": error,
            "failure": failure,
            "done": ~error & ~failure & (F.col("st") == "F"),
        }
    )


def checkout(orders: DataFrame) -> DataFrame:
    k = F.col("k")
    reason = _pick(
        (k + F.col("ck")) % 4,
        "Session Timeout",
        "Fare Changed",
        "Inventory Unavailable",
        "Technical Error",
    )
    return _attempts(orders).select(
        F.concat(F.lit("H"), "k").alias("checkout_id"),
        "session_id",
        F.concat(F.lit("Q"), "k").alias("search_id"),
        _later("searched_at", (2 + k % 17) * 60).alias("checkout_started_at"),
        device_type().alias("device_type"),
        _pick(k % 5, "Debit Card", "Credit Card", "Apple Pay", "Google Pay", "PayPal").alias(
            "payment_method"
        ),
        _flag(F.col("error")).alias("checkout_error_flag"),
        F.when(F.col("error"), reason).otherwise("None").alias("error_type"),
        _flag(F.col("failure")).alias("payment_failure_flag"),
        _flag(F.col("done")).alias("checkout_completed_flag"),
    )


def bookings(orders: DataFrame) -> DataFrame:
    k = F.col("k")
    ticket = F.col("fare") * (1 + k % 5)
    fee = F.when(k % 7 == 0, 1.49).otherwise(0.0)
    return (
        _attempts(orders)
        .where("done")
        .select(
            F.concat(F.lit("B"), "k").alias("booking_id"),
            "session_id",
            F.concat(F.lit("Q"), "k").alias("search_id"),
            F.concat(F.lit("H"), "k").alias("checkout_id"),
            _later("searched_at", (3 + k % 17) * 60).alias("booked_at"),
            ticket.alias("ticket_value"),
            fee.alias("booking_fee"),
            (ticket + fee).alias("total_revenue"),
            (1 + k % 5).cast("int").alias("passengers"),
            F.concat(F.lit("Operator "), F.col("sk") % 10).alias("operator"),
            F.col("nation").alias("origin_station"),
            F.col("dest").alias("destination_station"),
        )
    )


def station_reference(nations: DataFrame, regions: DataFrame) -> DataFrame:
    key = F.col("n_nationkey").cast("bigint")
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        F.concat(F.lit("RS"), "n_nationkey").alias("station_code"),
        F.col("n_name").alias("station_name"),
        F.col("r_name").alias("region"),
        (500000 + key * 1000003).alias("annual_entries_exits"),
        (10000 + key * 70001).alias("interchange_volume"),
    )


class Journey:
    """Raw, staged and derived tables of one data directory.

    Raw tables and the funnel are written once into the work area, as a warehouse would;
    everything else stays lazy.
    """

    def __init__(self, spark: SparkSession, directory: str, key: str):
        self.spark, self.directory = spark, directory
        self.area = WorkArea(spark, key, stored_bytes(spark, directory, GIVEN))
        self._prepared = False

    @property
    def base(self) -> DataFrame:
        return self.area.table("base", lambda: base_orders(self.spark, self.directory))

    @property
    def options(self) -> DataFrame:
        lineitem = given(self.spark, self.directory, "lineitem")
        base = self.base
        return self.area.table(
            "options",
            lambda: (options if has_large_orders(lineitem) else whole_options)(lineitem, base),
        )

    @property
    def orders(self) -> DataFrame:
        return self.area.table("orders", lambda: with_options(self.base, self.options))

    def raw(self, name: str) -> DataFrame:
        builders = {
            "sessions": lambda: sessions(self.base),
            "searches": lambda: searches(self.orders),
            "journey_results": lambda: journey_results(self.options),
            "checkout": lambda: checkout(self.orders),
            "bookings": lambda: bookings(self.orders),
            "station_reference": lambda: station_reference(
                given(self.spark, self.directory, "nation"),
                given(self.spark, self.directory, "region"),
            ),
        }
        return self.area.table(f"raw_{name}", builders[name])

    def raw_tables(self) -> dict[str, DataFrame]:
        if not self._prepared:
            self.orders  # noqa: B018  (the others read it)
            run_together(self.spark, {name: partial(self.raw, name) for name in staging.STAGERS})
            self._prepared = True
        return {name: self.raw(name) for name in staging.STAGERS}

    def staged(self, name: str) -> DataFrame:
        return staging.STAGERS[name](self.raw(name))

    def staged_tables(self) -> dict[str, DataFrame]:
        return staging.stage_all(self.raw_tables())

    @property
    def funnel(self) -> DataFrame:
        return self.area.table("search_funnel", lambda: build_funnel(self.staged_tables()))

    @property
    def dataset(self) -> DataFrame:
        return features.model_rows(self.funnel)


@lru_cache(maxsize=16)
def _journey(spark: SparkSession, application: str, directory: str, key: str) -> Journey:
    return Journey(spark, directory, key)


def journey(spark: SparkSession, directory: str) -> Journey:
    """The journey tables of a directory; rebuilt when an input file has changed."""
    key = fingerprint(spark, directory, GIVEN)
    return _journey(spark, spark.sparkContext.applicationId, directory, key)


def formula_score(records: DataFrame) -> DataFrame:
    """A deterministic score for checking the evaluation operators: ties and spread included."""
    points = (
        F.col("search_latency_ms") * 0.0002
        + F.col("results_count") * 0.03
        + F.col("railcard_used") * 0.15
        + F.col("is_logged_in") * 0.05
    )
    return records.withColumn("score", F.least(points, F.lit(0.95)))


def tied_score(records: DataFrame) -> DataFrame:
    """A score that a large share of the rows have in common."""
    points = F.when(F.col("results_count") >= 3, 0.3).otherwise(
        F.col("results_count") * 0.1 + F.col("railcard_used") * 0.05
    )
    return records.withColumn("score", points.cast("double"))


def scoring_requests(dataset: DataFrame) -> DataFrame:
    """Scoring records of which some break rules: long lead times, wrong flags, missing values,
    fractions and NaN."""
    slow = F.col("search_latency_ms")
    return dataset.drop("booked_flag", "searched_at").withColumns(
        {
            "days_before_travel": F.col("days_before_travel") * 7,
            "passengers": F.when(slow % 50 == 0, 0.0)
            .when(slow % 60 == 7, 1.5)
            .otherwise(F.col("passengers").cast("double")),
            "search_latency_ms": F.when(slow % 80 != 9, slow).otherwise(F.lit(float("nan"))),
            "zero_results_flag": F.when(
                slow % 40 == 1, 1 - F.col("zero_results_flag")
            ).otherwise(F.col("zero_results_flag")),
            "country": F.when(slow % 70 != 3, F.col("country")),
        }
    )
