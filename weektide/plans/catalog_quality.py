"""Sources, cleaning and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from weektide.functions import dates, text
from weektide.operators import cleaning, profile, quality, slicing
from weektide.plans import sql as S
from weektide.plans.registry import query, table
from weektide.schema import RAW_HEADERS, canonical_name
from weektide.sources import sinks
from weektide.sources.durable import shared_path
from weektide.sources.files import file_fingerprints, scan_raw_csv, with_calendar
from weektide.sources.star import COLUMNS

# Members of the controlled columns of the star schema.  One member of each list
# is renamed so that both kinds of difference show up.
STAR_DOMAINS = {
    "category": ["STANDARD", "ECONOMY", "PROMO", "MEDIUM", "LARGE", "MINI"],
    "segment": ["MACHINERY", "BUILDING", "AUTOMOBILE", "FURNITURE", "HOUSEHOLD"],
    "region": ["ASIA", "AFRICA", "AMERICA", "EUROPE", "OCEANIA"],
    "ship_mode": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
}

# Raw files are written in one pass up to so many rows, in more beyond; every pass reads the
# tables, so their number is bounded.
PASS_ROWS = 4_000_000
PASSES = 8

_ALL = ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" if c in ("order_date", "ship_date")
    else f"CAST({c} AS DOUBLE) AS {c}" if c in ("sales", "discount", "profit") else c
    for c in COLUMNS
)


@query("scan_transactions", f"{S.WITH_T} SELECT {_ALL} FROM t")
def _(spark, path):
    return table(spark, path)


@query(
    "transactions_calendar",
    f"""{S.WITH_T}
SELECT order_id, product_id, CAST(order_date AS VARCHAR) AS order_date,
       year(order_date) AS year, quarter(order_date) AS quarter, month(order_date) AS month,
       strftime(order_date, '%Y-%m') AS year_month FROM t""",
)
def _(spark, path):
    return with_calendar(table(spark, path, "order_id", "product_id", "order_date"))


@query(
    "parse_dates",
    """SELECT o_orderkey AS order_key, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS parsed
FROM orders""",
)
def _(spark, path):
    # Three spellings side by side, chosen by the order's status.
    day = F.col("o_orderdate").cast("date")
    written = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(day, "M/d/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format(day, "MM-dd-yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    orders = spark.read.parquet(f"{path}/orders.parquet")
    return orders.select(F.col("o_orderkey").alias("order_key"), written.alias("written")).select(
        "order_key", dates.parse_mixed_date(F.col("written")).alias("parsed")
    )


@query(
    "trim_text",
    f"""{S.WITH_T} SELECT order_id, product_id, category, product_name FROM t""",
)
def _(spark, path):
    # Pads the names with blanks, tabs, no-break and em spaces, then trims.
    raw = table(spark, path, "order_id", "product_id", "category", "product_name")
    padded = raw.withColumns(
        {
            "category": F.concat(F.lit(" \t"), "category", F.lit("\n")),
            "product_name": F.concat(F.lit("\u00a0 "), "product_name", F.lit("\u2003")),
        }
    )
    return cleaning.trim_text(padded)


@query(
    "standardize_types",
    f"""{S.WITH_T} SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(order_date AS VARCHAR) AS order_date,
       CAST(ship_date AS VARCHAR) AS ship_date, CAST(sales AS DOUBLE) AS sales, quantity,
       CAST(discount AS DOUBLE) AS discount, CAST(profit AS DOUBLE) AS profit FROM t""",
)
def _(spark, path):
    typed = table(
        spark, path, "order_id", "order_date", "ship_date", "sales", "quantity", "discount",
        "profit",
    )
    as_text = typed.select(*[F.col(c).cast("string").alias(c) for c in typed.columns])
    return cleaning.standardize_types(as_text)


@query(
    "postal_code",
    """SELECT c_custkey AS customer_key,
       CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 5
            THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0')
            ELSE CAST(c_custkey AS VARCHAR) END AS postal_code FROM customer""",
)
def _(spark, path):
    customer = spark.read.parquet(f"{path}/customer.parquet")
    # The key written as a number with a decimal point, as CSV readers leave it.
    return customer.select(
        F.col("c_custkey").alias("customer_key"),
        text.postal_code(F.col("c_custkey").cast("decimal(18,1)")).alias("postal_code"),
    )


@query(
    "slice_filter",
    f"""{S.WITH_T} SELECT order_id, product_id, CAST(order_date AS VARCHAR) AS order_date,
       category, segment, region, CAST(sales AS DOUBLE) AS sales
FROM t WHERE year(order_date) = 1997 AND category = 'PROMO' AND region = 'ASIA'""",
)
def _(spark, path):
    t = table(
        spark, path, "order_id", "product_id", "order_date", "category", "segment", "region",
        "sales",
    )
    return slicing.slice_rows(t, year=1997, category="PROMO", region="ASIA")


@query(
    "filter_domains",
    f"""{S.WITH_T}, m AS (
  SELECT DISTINCT 'year' AS slicer, CAST(year(order_date) AS VARCHAR) AS choice FROM t
  UNION SELECT DISTINCT 'category', category FROM t
  UNION SELECT DISTINCT 'segment', segment FROM t
  UNION SELECT DISTINCT 'region', region FROM t)
SELECT * FROM m UNION ALL SELECT DISTINCT slicer, 'All' FROM m""",
)
def _(spark, path):
    t = table(spark, path, "order_date", "category", "segment", "region")
    names = ("category", "segment", "region")
    return slicing.filter_domains(
        t, {"year": F.year("order_date")} | {n: F.col(n) for n in names}
    )


@query(
    "negative_profit",
    f"""{S.WITH_T} SELECT order_id, product_id, quantity, CAST(profit AS DOUBLE) AS profit
FROM t WHERE profit < 0""",
)
def _(spark, path):
    return slicing.losses(table(spark, path, "order_id", "product_id", "quantity", "profit"))


@query(
    "name_contains",
    "SELECT p_partkey AS part_key, p_name AS name FROM part WHERE contains(p_name, 'ring')",
)
def _(spark, path):
    part = spark.read.parquet(f"{path}/part.parquet")
    named = part.select(F.col("p_partkey").alias("part_key"), F.col("p_name").alias("name"))
    return slicing.name_contains(named, "name", "ring")


@query(
    "dq_dimensions",
    f"""{S.WITH_T} SELECT 'rows' AS "check", CAST(count(*) AS DOUBLE) AS value,
       true AS passed FROM t
UNION ALL SELECT 'columns', {len(COLUMNS)}.0::DOUBLE, true""",
)
def _(spark, path):
    return quality.dimensions(table(spark, path), columns=len(COLUMNS))


_NULLS = " UNION ALL ".join(
    f"SELECT 'nulls_{c}' AS \"check\", CAST(count(*) - count({c}) AS DOUBLE) AS value FROM t"
    for c in COLUMNS
)


@query(
    "dq_nulls",
    f"""{S.WITH_T}, n AS ({_NULLS})
SELECT "check", value, value = 0 AS passed FROM n
UNION ALL SELECT 'nulls_total', sum(value), sum(value) = 0 FROM n""",
)
def _(spark, path):
    return quality.nulls(table(spark, path))


_DUPLICATES = f"""
SELECT 'full_row_duplicates' AS "check",
       CAST((SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS DOUBLE) AS value,
       (SELECT count(*) FROM t) = (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS passed
UNION ALL SELECT 'unique_orders', CAST(count(DISTINCT order_id) AS DOUBLE), true FROM t
UNION ALL SELECT 'multi_item_order_rows',
       CAST(count(*) - count(DISTINCT order_id) AS DOUBLE), true FROM t
UNION ALL SELECT 'duplicate_order_product_pairs',
       CAST(count(*) - count(DISTINCT (order_id, product_id)) AS DOUBLE), true FROM t"""


@query("dq_duplicates", S.WITH_T + _DUPLICATES)
def _(spark, path):
    return quality.duplicates(table(spark, path))


@query(
    "duplicate_pairs",
    f"""{S.WITH_T} SELECT row_id, order_id, product_id, CAST(sales AS DOUBLE) AS sales, quantity
FROM t QUALIFY count(*) OVER (PARTITION BY order_id, product_id) > 1""",
)
def _(spark, path):
    t = table(spark, path, "row_id", "order_id", "product_id", "sales", "quantity")
    return quality.duplicate_members(t, ["order_id", "product_id"]).orderBy(
        "order_id", "product_id", "row_id"
    )


_CHRONOLOGY = """
SELECT "check", CAST(value AS DOUBLE) AS value, value = 0 AS passed FROM (
  SELECT 'invalid_order_dates' AS "check", count(*) - count(order_date) AS value FROM t
  UNION ALL SELECT 'invalid_ship_dates', count(*) - count(ship_date) FROM t
  UNION ALL SELECT 'order_after_ship', count(*) FILTER (order_date > ship_date) FROM t
  UNION ALL SELECT 'negative_shipping_days', count(*) FILTER (ship_date - order_date < 0) FROM t)"""


@query("dq_chronology", S.WITH_T + _CHRONOLOGY)
def _(spark, path):
    return quality.chronology(table(spark, path, "order_date", "ship_date"))


@query(
    "dq_dates",
    f"""{S.WITH_T}, d AS (SELECT *, CAST(ship_date - order_date AS BIGINT) AS lead FROM t)
SELECT CAST(min(order_date) AS VARCHAR) AS min_order_date,
       CAST(max(order_date) AS VARCHAR) AS max_order_date,
       CAST(min(ship_date) AS VARCHAR) AS min_ship_date,
       CAST(max(ship_date) AS VARCHAR) AS max_ship_date,
       count(DISTINCT order_date) AS unique_order_dates,
       count(DISTINCT ship_date) AS unique_ship_dates,
       min(lead) AS min_lead_days, max(lead) AS max_lead_days,
       {S.rnd(S.ratio('sum(lead)', 'count(lead)'))} AS mean_lead_days,
       quantile_cont(CAST(lead AS DOUBLE), 0.25) AS q25_lead_days,
       quantile_cont(CAST(lead AS DOUBLE), 0.5) AS median_lead_days,
       quantile_cont(CAST(lead AS DOUBLE), 0.75) AS q75_lead_days FROM d""",
)
def _(spark, path):
    return quality.date_profile(table(spark, path, "order_date", "ship_date"))


_NUMERIC = f"""
SELECT 'sales_non_positive' AS "check", CAST(count(*) FILTER (sales <= 0) AS DOUBLE) AS value,
       count(*) FILTER (sales <= 0) = 0 AS passed FROM t
UNION ALL SELECT 'quantity_non_positive', CAST(count(*) FILTER (quantity <= 0) AS DOUBLE),
       count(*) FILTER (quantity <= 0) = 0 FROM t
UNION ALL SELECT 'discount_out_of_bounds',
       CAST(count(*) FILTER (discount < 0 OR discount > 1) AS DOUBLE),
       count(*) FILTER (discount < 0 OR discount > 1) = 0 FROM t
UNION ALL SELECT 'negative_profit_count', CAST(count(*) FILTER (profit < 0) AS DOUBLE), true FROM t
UNION ALL SELECT 'negative_profit_pct', {S.pct('count(*) FILTER (profit < 0)', 'count(*)')}, true FROM t"""


@query("dq_numeric", S.WITH_T + _NUMERIC)
def _(spark, path):
    return quality.numeric_bounds(table(spark, path, "sales", "quantity", "discount", "profit"))


@query(
    "dq_profile",
    S.WITH_T + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) AS min,
       CAST(max({c}) AS DOUBLE) AS max, {S.rnd(S.ratio(f'sum({c})', f'count({c})'))} AS mean FROM t"""
        for c in profile.MEASURES
    ),
)
def _(spark, path):
    return quality.numeric_profile(table(spark, path, *profile.MEASURES))


def _domain_sql(column: str, members: list[str]) -> str:
    listed = ", ".join(f"('{m}')" for m in members)
    return f"""SELECT '{column}' AS "column",
  (SELECT count(*) FROM (SELECT DISTINCT {column} FROM t EXCEPT SELECT * FROM (VALUES {listed}))) AS unexpected,
  (SELECT count(*) FROM (SELECT * FROM (VALUES {listed}) EXCEPT SELECT DISTINCT {column} FROM t)) AS missing"""


_DOMAINS = " UNION ALL ".join(_domain_sql(c, m) for c, m in STAR_DOMAINS.items())


@query(
    "dq_domain",
    f"""{S.WITH_T}, d AS ({_DOMAINS})
SELECT *, unexpected = 0 AND missing = 0 AS passed FROM d""",
)
def _(spark, path):
    return quality.domains(table(spark, path, *STAR_DOMAINS), STAR_DOMAINS)


_SUBSET = " UNION ALL ".join(
    f"""SELECT DISTINCT '{c}' AS "column", {c} AS value FROM t
WHERE {c} NOT IN ({', '.join(f"'{m}'" for m in members)})"""
    for c, members in STAR_DOMAINS.items()
)


@query("dq_domain_unexpected", S.WITH_T + _SUBSET)
def _(spark, path):
    found = quality.domain_differences(table(spark, path, *STAR_DOMAINS), STAR_DOMAINS)
    return found.filter("status = 'unexpected'").drop("status")


_TEXTS = [
    "ship_mode", "customer_name", "segment", "state", "region", "category", "sub_category",
    "product_name",
]


@query(
    "dq_whitespace",
    f"""{S.WITH_T} SELECT 'product_name' AS "column", count(*) AS rows FROM t
WHERE quantity > 25""",
)
def _(spark, path):
    t = table(spark, path, *_TEXTS, "quantity")
    padded = F.when(F.col("quantity") > 25, F.concat("product_name", F.lit(" ")))
    return quality.whitespace(
        t.withColumn("product_name", F.coalesce(padded, "product_name")), _TEXTS
    )


@query(
    "dq_case",
    S.WITH_T + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS distinct_values,
       count(DISTINCT lower({c})) AS distinct_lower,
       count(DISTINCT {c}) = count(DISTINCT lower({c})) AS passed FROM t"""
        for c in _TEXTS
    ),
)
def _(spark, path):
    return quality.case_variants(table(spark, path, *_TEXTS), _TEXTS)


_COUNTED = ["order_id", "customer_id", "product_id", "category", "sub_category", "region", "state"]


@query(
    "overview",
    S.WITH_T + """SELECT 'transactions' AS metric, CAST(count(*) AS VARCHAR) AS value FROM t
UNION ALL SELECT 'first_order_date', CAST(min(order_date) AS VARCHAR) FROM t
UNION ALL SELECT 'last_order_date', CAST(max(order_date) AS VARCHAR) FROM t
""" + "".join(
        f" UNION ALL SELECT 'unique_{c}', CAST(count(DISTINCT {c}) AS VARCHAR) FROM t"
        for c in [*_COUNTED, "order_date"]
    ),
)
def _(spark, path):
    members = table(spark, path, *_COUNTED, "order_date")
    return profile.overview(table(spark, path, "order_date"), _COUNTED, members)


def _double_entry(spark, path):
    """Every line entered twice: the second copy under a higher row number and padded."""
    t = table(spark, path)
    again = t.withColumns(
        {
            "row_id": F.col("row_id") + F.lit(10**12),
            "product_name": F.concat("product_name", F.lit(" ")),
        }
    )
    return t.unionByName(again)


@query("dedup", f"{S.WITH_T} SELECT {_ALL} FROM t")
def _(spark, path):
    return cleaning.clean(_double_entry(spark, path))


@query(
    "clean_summary",
    f"""{S.WITH_T} SELECT 2 * count(*) AS raw_rows, count(*) AS cleaned_rows,
       count(*) AS rows_removed, count(*) AS rows_retained,
       CAST({len(COLUMNS)} AS BIGINT) AS columns,
       count(*) FILTER (profit < 0) AS negative_profit_rows_retained,
       'ship_mode,customer_name,segment,state,region,category,sub_category,product_name' AS text_trimmed_columns,
       false AS postal_code_standardized FROM t""",
)
def _(spark, path):
    return cleaning.cleaning_summary(_double_entry(spark, path))


_SPANS = {
    f"{side}_{name}_day": f"CAST(date_diff('day', DATE '1970-01-01', CAST({fn}({name}_date) AS DATE)) AS DOUBLE)"
    for name in ("order", "ship") for side, fn in (("first", "min"), ("last", "max"))
} | {
    "min_lead_days": "CAST(min(ship_date - order_date) AS DOUBLE)",
    "max_lead_days": "CAST(max(ship_date - order_date) AS DOUBLE)",
    "mean_lead_days": S.rnd(S.ratio("sum(ship_date - order_date)", "count(ship_date - order_date)")),
}


@query(
    "dq_report",
    f"""{S.WITH_T}, n AS ({_NULLS}), d AS ({_DOMAINS})
SELECT 'dimensions' AS section, 'rows' AS "check", CAST(count(*) AS DOUBLE) AS value, true AS passed FROM t
UNION ALL SELECT 'dimensions', 'columns', {len(COLUMNS)}.0::DOUBLE, true
UNION ALL SELECT 'missing_values', "check", value, value = 0 FROM n
UNION ALL SELECT 'missing_values', 'nulls_total', sum(value), sum(value) = 0 FROM n
UNION ALL SELECT 'duplicates', * FROM ({_DUPLICATES})
UNION ALL SELECT 'dates', * FROM ({_CHRONOLOGY})
UNION ALL SELECT 'numerics', * FROM ({_NUMERIC})
UNION ALL SELECT 'categoricals', 'domain_' || "column", CAST(unexpected + missing AS DOUBLE),
       unexpected = 0 AND missing = 0 FROM d
UNION ALL SELECT 'schema', 'missing_columns', 0.0::DOUBLE, true
UNION ALL SELECT 'schema', 'unexpected_columns', 0.0::DOUBLE, true
""" + "".join(
        f"UNION ALL SELECT 'date_span', '{n}', {sql}, true FROM t\n"
        for n, sql in _SPANS.items()
    ) + "".join(
        f"UNION ALL SELECT 'ranges', '{c}_{n}', {sql}, true FROM t\n"
        for c in ("sales", "quantity", "discount", "profit")
        for n, sql in (
            ("min", f"CAST(min({c}) AS DOUBLE)"), ("max", f"CAST(max({c}) AS DOUBLE)"),
            ("mean", S.rnd(S.ratio(f"sum({c})", f"count({c})"))),
        )
    ) + "".join(
        f"UNION ALL SELECT 'cardinality', 'unique_{c}', CAST(count(DISTINCT {c}) AS DOUBLE), true FROM t\n"
        for c in _COUNTED
    ),
)
def _(spark, path):
    return quality.report(
        table(spark, path), STAR_DOMAINS, columns=len(COLUMNS),
        expected_columns=list(COLUMNS), counted=_COUNTED,
    )


# The columns that the star schema lacks, so that a raw file has all of its 21: text with
# signs that need quotes and an encoding, and codes that lose their zeros.
def _all_columns(spark, path):
    full = table(spark, path)
    return full.withColumns({
        "country": F.col("region"),
        "city": F.concat(F.lit('Zoë’s €, "'), F.col("state"), F.lit('"')),
        "postal_code": F.col("customer_id") % 100000,
    })


_AS_TEXT = ["order_id", "customer_id", "product_id"]
_READ_BACK = ", ".join(
    [f"CAST({c} AS VARCHAR) AS {c}" for c in _AS_TEXT]
    + [f"CAST({c} AS VARCHAR) AS {c}" for c in ("order_date", "ship_date")]
    + [f"CAST({c} AS DOUBLE) AS {c}" for c in ("sales", "discount", "profit")]
    + [c for c in COLUMNS
       if c not in [*_AS_TEXT, "order_date", "ship_date", "sales", "discount", "profit"]]
    + ["region AS country", "'Zoë’s €, \"' || state || '\"' AS city",
       "lpad(CAST(customer_id % 100000 AS VARCHAR), 5, '0') AS postal_code"]
)


@query("csv_round_trip", f"{S.WITH_T} SELECT {_READ_BACK} FROM t")
def _(spark, path):
    """All transactions as raw Windows-1252 files and back through the raw reader.

    As text they are several times the size of the tables, so they are packed, and written
    in up to ``PASSES`` passes, each with its share of the shuffle files.
    """
    passes = min(PASSES, 1 + table(spark, path, "order_id").count() // PASS_ROWS)
    folder = sinks.write_raw_csv(
        _all_columns(spark, path), shared_path(spark, "raw"), compression="gzip", passes=passes
    )
    return cleaning.standardize_types(scan_raw_csv(spark, folder))


@query(
    "csv_quarantine",
    f"""{S.WITH_T}, d AS (SELECT row_id, order_id, order_id % 60 AS defect FROM t)
SELECT row_id, CASE defect WHEN 0 THEN 'sales' WHEN 10 THEN 'order_date,profit'
                           WHEN 20 THEN 'quantity' ELSE 'record' END AS faults,
       CASE WHEN defect = 30 THEN row_id || ',' || order_id
            WHEN defect = 40 THEN row_id || repeat(',x', 25) END AS corrupt_record
FROM d WHERE defect IN (0, 10, 20, 30, 40)""",
)
def _(spark, path):
    """Raw lines with defects in known places; those that the reader sets apart."""
    full = _all_columns(spark, path)
    defect = F.col("order_id") % 60
    spoiled = {
        "sales": (0, "NaN"), "order_date": (10, "13/45/1999"), "profit": (10, "n/a"),
        "quantity": (20, "2.5"),
    }
    fields = []
    for name in map(canonical_name, RAW_HEADERS):
        value = F.col(name).cast("string")
        if name in spoiled:
            at, written = spoiled[name]
            value = F.when(defect == at, F.lit(written)).otherwise(value)
        fields.append(value.alias(name))
    row = F.col("row_id").cast("string")
    line = (
        F.when(defect == 30, F.concat_ws(",", row, F.col("order_id").cast("string")))
        .when(defect == 40, F.concat(row, F.repeat(F.lit(",x"), 25)))
        .otherwise(F.to_csv(F.struct(*fields), {"quote": '"', "escape": '"'}))
    )
    folder = shared_path(spark, "lines")
    full.select(line.alias("value")).write.text(folder)
    raw = scan_raw_csv(spark, folder, "utf-8", typed=False, header=False, provenance=True)
    _, apart = cleaning.split_readable(raw)
    return apart.select(
        F.col("row_id").cast("bigint").alias("row_id"),
        F.array_join("faults", ",").alias("faults"), "corrupt_record",
    )


@query("file_digests")
def _(spark, path):
    return file_fingerprints(spark, f"{path}/lineitem.parquet")


def _describe_sql(c: str) -> str:
    def q(p):
        return S.rnd(f"quantile_cont(CAST({c} AS DOUBLE), {p})", 4)

    return f"""SELECT '{c}' AS "column", count({c}) AS "count",
       {S.rnd(S.ratio(f'sum({c})', f'count({c})'), 4)} AS mean,
       {S.rnd(f'stddev_samp(CAST({c} AS DOUBLE))', 4)} AS std,
       CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
       CAST(sum({c}) AS DOUBLE) AS sum, count(*) FILTER ({c} < 0) AS negative,
       count(*) FILTER ({c} = 0) AS zero,
       {q(0.25)} AS q25, {q(0.5)} AS median, {q(0.75)} AS q75,
       {S.rnd(f'{q(0.75)} - {q(0.25)}', 4)} AS iqr FROM t"""


@query("numeric_describe", S.WITH_T + " UNION ALL ".join(_describe_sql(c) for c in profile.MEASURES))
def _(spark, path):
    return profile.describe(table(spark, path, *profile.MEASURES))


_COUNTS = ["category", "sub_category", "segment", "region", "ship_mode", "state"]


@query(
    "value_counts",
    S.WITH_T + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS frequency,
       {S.rnd('count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()')} AS percentage FROM t GROUP BY {c}"""
        for c in _COUNTS
    ),
)
def _(spark, path):
    return profile.value_counts(table(spark, path, *_COUNTS), _COUNTS)


