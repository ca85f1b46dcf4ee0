"""Data-quality checks as rows ``(check, value, passed)``.

Nothing here raises on bad data; ``enforce`` is the one action that does.
Scalar checks share one aggregate; checks that need distinct values shrink the
data level by level, so no key, however frequent, ends up whole in one task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weektide.functions.numeric import fixed_mean, rnd
from weektide.functions.text import has_margin_space
from weektide.schema import schema_difference, text_columns


@dataclass(frozen=True)
class Check:
    """A scalar check: an aggregate and the condition its value has to meet.

    Without a condition the check is informative and passes.
    """

    name: str
    aggregate: Column
    passes: Callable[[Column], Column] | None = None
    section: str = ""


def _is_zero(value: Column) -> Column:
    return value == 0


def _run(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All ``checks`` by one aggregate over ``df``, as ``(section, check, value, passed)``."""
    cells = []
    for c in checks:
        value = c.aggregate.cast("double")
        passed = F.lit(True) if c.passes is None else F.coalesce(c.passes(value), F.lit(False))
        cells.append(
            F.struct(
                F.lit(c.section).alias("section"), F.lit(c.name).alias("check"),
                value.alias("value"), passed.alias("passed"),
            )
        )
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def _dimension_checks(df: DataFrame, rows: int | None, columns: int | None) -> list[Check]:
    def equals(wanted):
        return None if wanted is None else lambda value: value == wanted

    return [
        Check("rows", F.count(F.lit(1)), equals(rows), "dimensions"),
        Check("columns", F.max(F.lit(len(df.columns))), equals(columns), "dimensions"),
    ]


def _null_checks(df: DataFrame) -> list[Check]:
    counts = {c: F.count_if(F.col(c).isNull()) for c in df.columns}
    each = [Check(f"nulls_{c}", n, _is_zero, "missing_values") for c, n in counts.items()]
    whole = sum(counts.values(), F.lit(0))
    return [*each, Check("nulls_total", whole, _is_zero, "missing_values")]


def _chronology_checks() -> list[Check]:
    lead = F.datediff("ship_date", "order_date")
    found = {
        "invalid_order_dates": F.col("order_date").isNull(),
        "invalid_ship_dates": F.col("ship_date").isNull(),
        "order_after_ship": F.col("order_date") > F.col("ship_date"),
        "negative_shipping_days": lead < 0,
    }
    return [Check(n, F.count_if(c), _is_zero, "dates") for n, c in found.items()]


def _numeric_checks() -> list[Check]:
    loss = F.count_if(F.col("profit") < 0)
    outside = (F.col("discount") < 0) | (F.col("discount") > 1)
    share = rnd(F.try_divide(loss * 100, F.count(F.lit(1))), 2)
    return [
        Check("sales_non_positive", F.count_if(F.col("sales") <= 0), _is_zero, "numerics"),
        Check("quantity_non_positive", F.count_if(F.col("quantity") <= 0), _is_zero, "numerics"),
        Check("discount_out_of_bounds", F.count_if(outside), _is_zero, "numerics"),
        Check("negative_profit_count", loss, None, "numerics"),
        Check("negative_profit_pct", share, None, "numerics"),
    ]


def _space_checks(columns: list[str]) -> list[Check]:
    return [
        Check(f"whitespace_{c}", F.count_if(has_margin_space(F.col(c))), None, "whitespace")
        for c in columns
    ]


def dimensions(df: DataFrame, rows: int | None = None, columns: int | None = None) -> DataFrame:
    """Row and column counts against what was expected (``None``: not checked)."""
    return _run(df, _dimension_checks(df, rows, columns)).drop("section")


def nulls(df: DataFrame) -> DataFrame:
    """NULL count of every column and their total."""
    return _run(df, _null_checks(df)).drop("section")


def duplicates(
    df: DataFrame, order_col: str = "order_id", product_col: str = "product_id"
) -> DataFrame:
    """Rows beyond the first: of identical rows, of an order, of an order-product pair.

    Identical rows nest in pairs and pairs nest in orders, so each level is
    counted from the one before.
    """
    n = F.count(F.lit(1))
    rows = df.groupBy(*df.columns).agg(n.alias("rows"))
    pairs = rows.groupBy(order_col, product_col).agg(
        F.sum("rows").alias("rows"), n.alias("kinds")
    )
    orders = pairs.groupBy(order_col).agg(
        F.sum("rows").alias("rows"), F.sum("kinds").alias("kinds"), n.alias("pairs")
    )
    all_rows = F.coalesce(F.sum("rows"), F.lit(0))
    kinds, met = F.coalesce(F.sum("kinds"), F.lit(0)), F.coalesce(F.sum("pairs"), F.lit(0))
    checks = [
        Check("full_row_duplicates", all_rows - kinds, _is_zero),
        Check("unique_orders", F.count(order_col)),
        Check("multi_item_order_rows", all_rows - n),
        Check("duplicate_order_product_pairs", all_rows - met),
    ]
    return _run(orders, checks).drop("section")


def duplicate_members(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row whose key occurs more than once.

    Keys are counted first and joined back; a window would hold all rows of a
    frequent key in one task.  ``<=>`` lets NULL keys meet.
    """
    repeated = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select(*[F.col(k).alias(f"__{k}") for k in keys])
    )
    match = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"__{k}"))
        match = same if match is None else match & same
    return df.join(repeated, match, "left_semi")


def chronology(df: DataFrame) -> DataFrame:
    """Missing dates, orders after shipment, negative lead times."""
    return _run(df, _chronology_checks()).drop("section")


def date_profile(df: DataFrame) -> DataFrame:
    """One row: date spans, active days and the spread of lead times.

    Rows are counted per pair of dates first; all figures follow from that small table.
    """
    days = df.groupBy("order_date", "ship_date").agg(F.count(F.lit(1)).alias("n"))
    lead, n = F.datediff("ship_date", "order_date"), F.col("n")
    counted = F.sum(F.when(lead.isNotNull(), n))
    return days.agg(
        F.min("order_date").alias("min_order_date"),
        F.max("order_date").alias("max_order_date"),
        F.min("ship_date").alias("min_ship_date"),
        F.max("ship_date").alias("max_ship_date"),
        F.count_distinct("order_date").alias("unique_order_dates"),
        F.count_distinct("ship_date").alias("unique_ship_dates"),
        F.min(lead).alias("min_lead_days"),
        F.max(lead).alias("max_lead_days"),
        rnd(F.sum(lead * n) / counted, 2).alias("mean_lead_days"),
        F.percentile(lead, 0.25, n).alias("q25_lead_days"),
        F.percentile(lead, 0.5, n).alias("median_lead_days"),
        F.percentile(lead, 0.75, n).alias("q75_lead_days"),
    )


def numeric_bounds(df: DataFrame) -> DataFrame:
    """Sales and quantity above 0, discount in [0, 1]; losses are counted, not failed."""
    return _run(df, _numeric_checks()).drop("section")


def numeric_profile(
    df: DataFrame, columns: tuple[str, ...] = ("sales", "quantity", "discount", "profit")
) -> DataFrame:
    """``(column, min, max, mean)`` of each measure, in one pass."""
    cells = []
    for c in columns:
        cells.append(
            F.struct(
                F.lit(c).alias("column"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
                rnd(fixed_mean(F.col(c)), 2).alias("mean"),
            )
        )
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def domains(
    df: DataFrame, expected: dict[str, list[str]], exact: bool = True
) -> DataFrame:
    """Per column: members outside the domain and domain members never seen.

    ``exact`` asks for equality of the two sets, otherwise for a subset.
    """
    report = domain_differences(df, expected)
    unexpected = F.count_if(F.col("status") == "unexpected")
    missing = F.count_if(F.col("status") == "missing")
    ok = unexpected == 0
    if exact:
        ok = ok & (missing == 0)
    names = [(c,) for c in expected if c in df.columns]
    spine = df.sparkSession.createDataFrame(names, "column string")
    return (
        spine.join(report, "column", "left").groupBy("column")
        .agg(unexpected.alias("unexpected"), missing.alias("missing"), ok.alias("passed"))
    )


def domain_differences(df: DataFrame, expected: dict[str, list[str]]) -> DataFrame:
    """``(column, value, status)`` for each member that is unexpected or missing.

    A NULL is a member outside every domain.
    """
    present = [c for c in expected if c in df.columns]
    observed = (
        df.select(*present).unpivot([], present, "column", "value")
        .distinct().withColumn("seen", F.lit(True))
    )
    wanted = df.sparkSession.createDataFrame(
        [(c, v, True) for c in present for v in expected[c]],
        "column string, value string, wanted boolean",
    )
    status = (
        F.when(F.col("wanted").isNull(), "unexpected").when(F.col("seen").isNull(), "missing")
    )
    return (
        observed.join(wanted, ["column", "value"], "full_outer")
        .select("column", "value", status.alias("status")).filter("status is not null")
    )


def whitespace(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Text columns with values that have stray white space, and how many."""
    chosen = [c for c in (columns or text_columns(df)) if c in df.columns]
    counts = df.agg(*[F.count_if(has_margin_space(F.col(c))).alias(c) for c in chosen])
    return counts.unpivot([], chosen, "column", "rows").filter("rows > 0")


def case_variants(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of text columns as written and in lower case.

    Each column gets a row, also one without values: a NULL that counts nothing stands for it.
    """
    names = F.explode(F.array(*[F.lit(c) for c in columns]))
    spine = df.sparkSession.range(1).select(names.alias("column"), F.lit(None).alias("value"))
    values = (
        df.select(*columns).unpivot([], columns, "column", "value")
        .filter(F.col("value").isNotNull()).distinct()
        .unionByName(spine)
    )
    folded = values.groupBy("column", F.lower("value").alias("folded")).agg(
        F.count("value").alias("spellings")
    )
    distinct, lower = F.sum("spellings"), F.count("folded")
    return folded.groupBy("column").agg(
        distinct.alias("distinct_values"), lower.alias("distinct_lower"),
        (distinct == lower).alias("passed"),
    )


def cardinalities(
    df: DataFrame, columns: list[str], approximate: float | None = None
) -> DataFrame:
    """``(column, distinct_values)``; ``approximate`` gives the allowed relative error."""
    if approximate is not None:
        counts = df.agg(*[F.approx_count_distinct(c, approximate).alias(c) for c in columns])
        return counts.unpivot([], columns, "column", "distinct_values")
    values = df.select(*columns)
    if len({kind for _, kind in values.dtypes}) > 1:
        values = values.select(*[F.col(c).cast("string").alias(c) for c in columns])
    seen = values.unpivot([], columns, "column", "value").distinct()
    return seen.groupBy("column").agg(F.count("value").alias("distinct_values"))


def _schema_checks(df: DataFrame, expected: list[str] | None) -> list[Check]:
    if expected is None:
        return []
    missing, unexpected = schema_difference(df, expected)
    return [
        Check("missing_columns", F.max(F.lit(len(missing))), _is_zero, "schema"),
        Check("unexpected_columns", F.max(F.lit(len(unexpected))), _is_zero, "schema"),
    ]


def _span_checks() -> list[Check]:
    """First and last days (counted from 1970-01-01) and lead times in days."""
    lead = F.datediff("ship_date", "order_date")
    figures = {}
    for name in ("order", "ship"):
        day = F.unix_date(f"{name}_date")
        figures |= {f"first_{name}_day": F.min(day), f"last_{name}_day": F.max(day)}
    figures |= {
        "min_lead_days": F.min(lead), "max_lead_days": F.max(lead),
        "mean_lead_days": rnd(F.avg(lead), 2),
    }
    return [Check(n, c, None, "date_span") for n, c in figures.items()]


def _range_checks() -> list[Check]:
    out = []
    for c in ("sales", "quantity", "discount", "profit"):
        figures = {"min": F.min(c), "max": F.max(c), "mean": rnd(fixed_mean(F.col(c)), 2)}
        out += [Check(f"{c}_{n}", v, None, "ranges") for n, v in figures.items()]
    return out


def report(
    df: DataFrame,
    expected_domains: dict[str, list[str]],
    rows: int | None = None,
    columns: int | None = None,
    expected_columns: list[str] | None = None,
    counted: list[str] | None = None,
) -> DataFrame:
    """All checks as ``(section, check, value, passed)``.

    Passes: one for every scalar check, one for the domains, one for the distinct
    members of the ``counted`` columns, one for the duplicates.
    """
    scalar = _run(
        df,
        [
            *_schema_checks(df, expected_columns), *_dimension_checks(df, rows, columns),
            *_null_checks(df), *_chronology_checks(), *_span_checks(), *_numeric_checks(),
            *_range_checks(), *_space_checks(text_columns(df)),
        ],
    )
    members = cardinalities(df, counted or []).select(
        F.lit("cardinality").alias("section"), F.concat(F.lit("unique_"), "column").alias("check"),
        F.col("distinct_values").cast("double").alias("value"), F.lit(True).alias("passed"),
    ) if counted else scalar.limit(0)
    by_column = domains(df, expected_domains).select(
        F.lit("categoricals").alias("section"),
        F.concat(F.lit("domain_"), "column").alias("check"),
        (F.col("unexpected") + F.col("missing")).cast("double").alias("value"),
        "passed",
    )
    repeated = duplicates(df).withColumn("section", F.lit("duplicates"))
    return (
        scalar.filter((F.col("section") != "whitespace") | (F.col("value") > 0))
        .unionByName(repeated).unionByName(by_column).unionByName(members)
    )


def enforce(checks: DataFrame) -> None:
    """Run the checks and raise ``ValueError`` naming those that failed.

    A report has one row per check, so what reaches the driver is small.
    """
    failed = checks.filter(~F.col("passed")).collect()
    if failed:
        raise ValueError("data quality: " + "; ".join(str(r.asDict()) for r in failed))
