"""Data-quality checks as DataFrames of violation counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfunnel.functions.measures import rows
from wayfunnel.schemas import CONTRACT


class QualityError(RuntimeError):
    """A check found violations."""


def _count_if(condition: Column, alias: str) -> Column:
    return F.count_if(condition).cast("bigint").alias(alias)


def _ledger(key: str, *sides: tuple[DataFrame, dict[str, Column]]) -> DataFrame:
    """One row per key with summed measures of several tables.

    Parent and child tables are stacked and grouped once: counts combine map-side, a hot key costs
    one row per task, no join is needed, and uniqueness and both directions of a reference
    come out of the same shuffle.
    """
    names = [name for _, measures in sides for name in measures]
    stacked = [
        frame.select(key, *[measures.get(name, F.lit(0)).alias(name) for name in names])
        for frame, measures in sides
    ]
    union = reduce(DataFrame.unionByName, stacked)
    return union.groupBy(key).agg(*[F.sum(name).cast("bigint").alias(name) for name in names])


def _orphans(key: str, parents: str, children: str, alias: str) -> Column:
    """Child rows without a parent row; a NULL key never has one."""
    missing = F.col(key).isNull() | (F.col(parents) == 0)
    return F.coalesce(F.sum(F.when(missing, F.col(children))), F.lit(0)).alias(alias)


def _long(totals: DataFrame) -> DataFrame:
    """One row of counts to (check, violations) rows."""
    checks = F.array(
        *[
            F.struct(F.lit(c).alias("check"), F.col(c).cast("bigint").alias("violations"))
            for c in totals.columns
        ]
    )
    return totals.select(F.inline(checks))


def session_checks(sessions: DataFrame, searches: DataFrame) -> DataFrame:
    one = F.lit(1)
    ledger = _ledger("session_id", (sessions, {"parents": one}), (searches, {"children": one}))
    return _long(
        ledger.agg(
            _count_if(F.col("parents") > 1, "duplicate_sessions"),
            _orphans("session_id", "parents", "children", "orphan_searches"),
        )
    )


def search_checks(searches: DataFrame, results: DataFrame, checkout: DataFrame) -> DataFrame:
    """Uniqueness of searches, references to them, consistency of their zero-result flag."""
    one = F.lit(1)
    empty = F.when(F.col("results_count") == 0, 1).otherwise(0)
    inconsistent = F.when(F.col("zero_results_flag") == empty, 0).otherwise(1)
    ledger = _ledger(
        "search_id",
        (searches, {"parents": one, "inconsistent": inconsistent}),
        (results, {"options": one, "selected": F.col("selected_flag")}),
        (checkout, {"attempts": one}),
    )
    return _long(
        ledger.agg(
            _count_if(F.col("parents") > 1, "duplicate_searches"),
            _orphans("search_id", "parents", "options", "orphan_results"),
            _orphans("search_id", "parents", "attempts", "orphan_checkout"),
            F.coalesce(F.sum("inconsistent"), F.lit(0)).alias("zero_flag_consistency"),
            _count_if(F.col("selected") > 1, "one_selection_per_search"),
        )
    )


def checkout_checks(checkout: DataFrame, bookings: DataFrame) -> DataFrame:
    one = F.lit(1)
    ledger = _ledger("checkout_id", (checkout, {"parents": one}), (bookings, {"children": one}))
    return _long(
        ledger.agg(
            _count_if(F.col("parents") > 1, "duplicate_checkouts"),
            _orphans("checkout_id", "parents", "children", "orphan_bookings"),
        )
    )


def duplicate_keys(frame: DataFrame, key: str, check: str) -> DataFrame:
    repeated = frame.groupBy(key).count().agg(_count_if(F.col("count") > 1, check))
    return _long(repeated)


def funnel_checks(funnel: DataFrame) -> DataFrame:
    """A later step without the earlier one, and selections in searches without results."""
    out_of_order = (
        (F.col("selected_flag") > F.col("results_available_flag"))
        | (F.col("checkout_started_flag") > F.col("selected_flag"))
        | (F.col("booked_flag") > F.col("checkout_completed_flag"))
    )
    chosen_nothing = (F.col("zero_results_flag") == 1) & (F.col("selected_flag") == 1)
    return _long(
        funnel.agg(
            _count_if(out_of_order, "invalid_funnel_order"),
            _count_if(chosen_nothing, "zero_result_selected"),
        )
    )


def dq_report(staged: dict[str, DataFrame], funnel: DataFrame) -> DataFrame:
    """(check, violations, status) of every check."""
    parts = [
        session_checks(staged["sessions"], staged["searches"]),
        search_checks(staged["searches"], staged["journey_results"], staged["checkout"]),
        checkout_checks(staged["checkout"], staged["bookings"]),
        duplicate_keys(staged["journey_results"], "result_id", "duplicate_results"),
        duplicate_keys(staged["bookings"], "booking_id", "duplicate_bookings"),
        funnel_checks(funnel),
    ]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL")
    )


def orphan_report(staged: dict[str, DataFrame]) -> DataFrame:
    """Reference violations only: (check, violations) of the four parent-child edges."""
    parts = [
        session_checks(staged["sessions"], staged["searches"]),
        search_checks(staged["searches"], staged["journey_results"], staged["checkout"]),
        checkout_checks(staged["checkout"], staged["bookings"]),
    ]
    return reduce(DataFrame.unionByName, parts).where(F.col("check").startswith("orphan_"))


def foreign_key_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, parent_table, row_count, null_keys, orphans) of every foreign key
    that the contract declares. Orphans are rows whose key has no parent row; a NULL key has none.

    Edges that share a parent key share one ledger: the parent and all its child tables are stacked
    and grouped once.
    """
    by_parent: dict[str, list[tuple[str, str]]] = {}
    for child, dataset in CONTRACT.items():
        for edge in dataset.foreign_keys:
            by_parent.setdefault(edge.parent, []).append((child, edge.column))
    one, parts = F.lit(1), []
    for parent, edges in by_parent.items():
        key = CONTRACT[parent].primary_key
        sides = [
            (tables[child].withColumnRenamed(column, key), {f"rows_{child}": one})
            for child, column in edges
        ]
        ledger = _ledger(key, (tables[parent], {"parents": one}), *sides)
        counted = []
        for child, _ in edges:
            rows_of = F.col(f"rows_{child}")
            lost = F.when(F.col(key).isNull(), rows_of)
            counted += [
                F.coalesce(F.sum(rows_of), F.lit(0)).alias(f"{child}_row_count"),
                F.coalesce(F.sum(lost), F.lit(0)).alias(f"{child}_null_keys"),
                _orphans(key, "parents", f"rows_{child}", f"{child}_orphans"),
            ]
        lines = F.array(
            *[
                F.struct(
                    F.lit(child).alias("table_name"),
                    F.lit(column).alias("column_name"),
                    F.lit(parent).alias("parent_table"),
                    *[
                        F.col(f"{child}_{name}").cast("bigint").alias(name)
                        for name in ("row_count", "null_keys", "orphans")
                    ],
                )
                for child, column in edges
            ]
        )
        parts.append(ledger.agg(*counted).select(F.inline(lines)))
    return reduce(DataFrame.unionByName, parts)


def foreign_key_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """(check, violations) of the declared foreign keys."""
    name = F.concat_ws("_", F.lit("orphan"), "table_name", "column_name")
    return foreign_key_report(tables).select(
        name.alias("check"), F.col("orphans").alias("violations")
    )


def run_checks(report: DataFrame) -> None:
    """Fail the build when any check has violations. The report has one row per check."""
    failures = {
        row["check"]: row["violations"]
        for row in report.where(F.col("violations") != 0).collect()
    }
    if failures:
        raise QualityError(f"quality checks failed: {failures}")


def contract_check(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per contract table: rows, missing and mistyped columns, NULL and repeated keys.

    Column problems come from the schema, key problems from one keyed count per table.
    """
    parts = []
    for name, dataset in CONTRACT.items():
        frame = tables[name]
        actual = {field.name: field.dataType for field in frame.schema}
        missing = [column for column, _ in dataset.columns if column not in actual]
        mistyped = [c for c, kind in dataset.columns if c in actual and actual[c] != kind]
        key = dataset.primary_key
        per_key = frame.groupBy(key).count() if key in actual else frame.groupBy().count()
        null_key = F.col(key).isNull() if key in actual else F.lit(True)
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("count"), F.lit(0)).alias("row_count"),
                F.coalesce(F.sum(F.when(null_key, F.col("count"))), F.lit(0)).alias("null_keys"),
                _count_if(~null_key & (F.col("count") > 1), "duplicate_keys"),
            ).select(
                F.lit(name).alias("table_name"),
                "row_count",
                "null_keys",
                "duplicate_keys",
                F.concat_ws(",", *map(F.lit, missing)).alias("missing_columns"),
                F.concat_ws(",", *map(F.lit, mistyped)).alias("mistyped_columns"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def contract_violations(report: DataFrame) -> DataFrame:
    """(table_name, column, problem) for everything a contract report finds wrong."""
    kinds = {
        "missing_columns": "missing column",
        "mistyped_columns": "wrong type",
    }
    named = [
        report.select(
            "table_name",
            F.explode(F.split(kind, ",")).alias("column"),
            F.lit(problem).alias("problem"),
        ).where(F.col("column") != "")
        for kind, problem in kinds.items()
    ]
    keys = F.create_map(
        *[part for t, d in CONTRACT.items() for part in (F.lit(t), F.lit(d.primary_key))]
    )
    counted = [
        report.where(F.col(kind) > 0).select(
            "table_name", keys[F.col("table_name")].alias("column"), F.lit(problem).alias("problem")
        )
        for kind, problem in (("null_keys", "NULL key"), ("duplicate_keys", "repeated key"))
    ]
    return reduce(DataFrame.unionByName, [*named, *counted])


def null_key_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """(check, violations): rows without a primary key, one column scan per contract table."""
    parts = []
    for name, dataset in CONTRACT.items():
        lost = F.count_if(F.col(dataset.primary_key).isNull())
        counted = tables[name].agg(lost.alias("violations"))
        parts.append(counted.select(F.lit(f"null_key_{name}").alias("check"), "violations"))
    return reduce(DataFrame.unionByName, parts)


def enforce_columns(tables: dict[str, DataFrame]) -> None:
    """Raise on absent tables or columns, from the schemas alone. Narrower types are cast later."""
    problems = [name for name in CONTRACT if name not in tables]
    problems += [
        f"{name}.{column}"
        for name, dataset in CONTRACT.items()
        if name in tables
        for column, _ in dataset.columns
        if column not in tables[name].columns
    ]
    if problems:
        raise QualityError(f"not in the inputs: {problems}")


def require_columns(frame: DataFrame, columns: list[str], what: str) -> None:
    missing = [column for column in columns if column not in frame.columns]
    if missing:
        raise QualityError(f"{what}: missing columns {missing}")


def model_dataset_checks(dataset: DataFrame, key: str = "search_id", target: str = "booked_flag"):
    """Repeated keys and targets other than 0 and 1 in the modelling rows."""
    bad_target = F.sum(F.when(~F.col(target).isin(0, 1), 1).otherwise(0))
    per_key = dataset.groupBy(key).agg(rows("n"), bad_target.alias("bad_target"))
    return _long(
        per_key.agg(
            _count_if(F.col("n") > 1, "duplicate_search_ids"),
            F.coalesce(F.sum("bad_target"), F.lit(0)).alias("target_not_binary"),
        )
    )


def split_checks(labelled: DataFrame, at: str = "searched_at") -> DataFrame:
    """Empty splits and splits that overlap in time, from a frame with a ``split`` column."""

    def edge(function, split: str) -> Column:
        return function(F.when(F.col("split") == split, F.col(at)))

    edges = labelled.agg(
        edge(F.max, "train").alias("train_last"),
        edge(F.min, "validation").alias("validation_first"),
        edge(F.max, "validation").alias("validation_last"),
        edge(F.min, "test").alias("test_first"),
    )

    def flag(condition: Column, alias: str) -> Column:
        return F.when(condition, 1).otherwise(0).alias(alias)

    return _long(
        edges.select(
            flag(F.col("train_last").isNull(), "train_empty"),
            flag(F.col("validation_first").isNull(), "validation_empty"),
            flag(F.col("test_first").isNull(), "test_empty"),
            flag(F.col("train_last") >= F.col("validation_first"), "train_overlaps_validation"),
            flag(F.col("validation_last") >= F.col("test_first"), "validation_overlaps_test"),
        )
    )


def alert_reconciliation(summary: DataFrame, alert_days: DataFrame) -> DataFrame:
    """1 violation when the summary's alert count differs from the rows of the alert report."""
    reported = alert_days.agg(rows("n")).scalar()
    differs = F.col("anomaly_alert_days") != reported
    return summary.select(
        F.lit("alert_count_reconciliation").alias("check"),
        F.when(differs, 1).otherwise(0).cast("bigint").alias("violations"),
    )
