"""SQL fragments shared by the oracle queries."""

from __future__ import annotations

#: CTE ``t``: the transactions view.
T = """t AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS row_id,
         l_orderkey AS order_id,
         CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date,
         o_orderpriority AS ship_mode, o_custkey AS customer_id,
         c_name AS customer_name, c_mktsegment AS segment, n_name AS state, r_name AS region,
         l_partkey AS product_id, p_type AS category,
         p_brand AS sub_category, p_name AS product_name,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2))
              * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
              AS DECIMAL(18,4)) AS sales,
         CAST(l_quantity AS BIGINT) AS quantity,
         CAST(l_discount AS DECIMAL(6,4)) AS discount,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2))
              * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
              - CAST(l_quantity AS DECIMAL(4,0)) * CAST(p_retailprice AS DECIMAL(10,2))
              AS DECIMAL(18,4)) AS profit
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""

WITH_T = f"WITH {T}\n"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def rnd(expr: str, digits: int = 2) -> str:
    """Half-up rounding through a decimal four digits finer."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,{digits + 4})), {digits}) AS DOUBLE)"


def ratio(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0))"


def pct(num: str, den: str, digits: int = 2) -> str:
    return rnd(f"{ratio(num, den)} * 100", digits)


def pct0(num: str, den: str, digits: int = 2) -> str:
    return f"CASE WHEN {den} > 0 THEN {pct(num, den, digits)} ELSE 0.0::DOUBLE END"


def total(column: str) -> str:
    return f"coalesce(CAST(sum({column}) AS DOUBLE), 0.0)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def text(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def _comma(keys: list[str]) -> str:
    return "".join(f"{k}, " for k in keys)


def over(keys: list[str], order: str = "date") -> str:
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    return f"{part}ORDER BY {order}"


def weekly(keys: list[str] | None = None) -> str:
    """CTEs ``t`` … ``w``: the gap-free weekly table."""
    keys = keys or []
    using = ", ".join([*keys, "date"])
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    return f"""{WITH_T}, wk AS (
  SELECT {_comma(keys)}CAST(date_trunc('week', order_date) AS DATE) + 6 AS date,
         CAST(sum(sales) AS DOUBLE) AS sales, CAST(sum(profit) AS DOUBLE) AS profit,
         CAST(sum(quantity) AS BIGINT) AS quantity, count(DISTINCT order_id) AS orders,
         CAST(sum(discount) AS DOUBLE) / count(discount) AS avg_discount
  FROM t GROUP BY {using}
), spine AS (
  SELECT {_comma(keys)}CAST(unnest(generate_series(min(date), max(date), INTERVAL 7 DAY)) AS DATE) AS date
  FROM wk {group}
), w AS (
  SELECT {_comma(keys)}date, coalesce(sales, 0.0) AS sales, coalesce(profit, 0.0) AS profit,
         coalesce(quantity, 0) AS quantity, coalesce(orders, 0) AS orders,
         coalesce(avg_discount, 0.0) AS avg_discount
  FROM spine LEFT JOIN wk USING ({using})
)
"""


CALENDAR = f"""year(date) AS year, quarter(date) AS quarter, month(date) AS month,
         weekofyear(date) AS week_of_year, CASE WHEN month(date) >= 9 THEN 1 ELSE 0 END AS is_q4,
         {rnd('sin(2 * pi() * weekofyear(date) / 52.1775::DOUBLE)', 4)} AS sin_week,
         {rnd('cos(2 * pi() * weekofyear(date) / 52.1775::DOUBLE)', 4)} AS cos_week,
         {rnd('sin(2 * pi() * month(date) / 12.0::DOUBLE)', 4)} AS sin_month,
         {rnd('cos(2 * pi() * month(date) / 12.0::DOUBLE)', 4)} AS cos_month"""

LAGS = [1, 2, 3, 4, 8, 12, 52]


def lag_list(keys: list[str]) -> str:
    return ", ".join(f"lag(sales, {k}) OVER ({over(keys)}) AS sales_lag_{k}" for k in LAGS)


def rolling_list(keys: list[str]) -> str:
    out = []
    for width, stats in ((4, ("mean", "std", "min", "max")), (12, ("mean", "std"))):
        frame = f"({over(keys)} ROWS BETWEEN {width} PRECEDING AND 1 PRECEDING)"
        for stat in stats:
            fn = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}[stat]
            value = rnd(f"{fn}(sales) OVER {frame}", 2)
            out.append(
                f"CASE WHEN count(sales) OVER {frame} = {width} THEN {value} END"
                f" AS sales_rolling_{stat}_{width}"
            )
    return ",\n         ".join(out)


def driver_list(keys: list[str]) -> str:
    o = over(keys)
    return f"""lag(CAST(orders AS DOUBLE)) OVER ({o}) AS orders_lag_1,
         lag(CAST(quantity AS DOUBLE)) OVER ({o}) AS quantity_lag_1,
         {rnd(f'lag(profit) OVER ({o})', 2)} AS profit_lag_1,
         {rnd(f'lag(avg_discount) OVER ({o})', 4)} AS avg_discount_lag_1"""


def features(keys: list[str] | None = None) -> str:
    """CTEs ``t`` … ``f``: the complete rows of the feature table."""
    keys = keys or []
    return f"""{weekly(keys)}, f AS (
  SELECT * FROM (
    SELECT {_comma(keys)}date, sales, {CALENDAR},
         {lag_list(keys)},
         {rolling_list(keys)},
         {driver_list(keys)},
         {rnd('ln(1 + sales)', 4)} AS log_sales
    FROM w
  ) WHERE sales_lag_52 IS NOT NULL AND sales_rolling_mean_12 IS NOT NULL
)
"""


def metrics(y: str = "sales", p: str = "prediction") -> str:
    """The four accuracy measures as a select list."""
    return f"""{rnd(f'avg(abs({y} - {p}))')} AS mae,
         {rnd(f'sqrt(avg(({y} - {p}) * ({y} - {p})))')} AS rmse,
         coalesce({rnd(f'avg(CASE WHEN {y} <> 0 THEN abs(({y} - {p}) / {y}) END) * 100')}, 0.0) AS mape,
         coalesce({rnd(f'sum(abs({y} - {p})) / nullif(sum({y}), 0) * 100')}, 0.0) AS wape"""


def split(test_year: int, keys: list[str] | None = None) -> str:
    """CTEs ``t`` … ``s``: feature rows with their role."""
    return f"""{features(keys)}, s AS (
  SELECT *, CASE WHEN year < {test_year} THEN 'train' ELSE 'test' END AS role
  FROM f WHERE year <= {test_year}
)
"""


def folds(test_year: int, keys: list[str] | None = None, k: int = 5) -> str:
    """CTEs ``t`` … ``cv``: training rows repeated per fold with their side."""
    keys = keys or []
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    return f"""{split(test_year, keys)}, numbered AS (
  SELECT *, row_number() OVER ({over(keys)}) - 1 AS rn, count(*) OVER ({part}) AS n
  FROM s WHERE role = 'train'
), sided AS (
  SELECT * EXCLUDE (role), n // {k + 1} AS block, n - ({k + 1} - fold) * (n // {k + 1}) AS first
  FROM numbered, (SELECT unnest(range(1, {k + 1})) AS fold)
), cv AS (
  SELECT * EXCLUDE (rn, n, block, first),
         CASE WHEN rn < first THEN 'train' ELSE 'val' END AS role
  FROM sided WHERE rn < first + block
)
"""


BASELINE_UNION = """
  SELECT *, 'Naive Baseline' AS model, sales_lag_1 AS prediction FROM {source}
  UNION ALL
  SELECT *, 'Seasonal Naive Baseline' AS model, sales_lag_52 AS prediction FROM {source}
"""


def baselines(source: str) -> str:
    return BASELINE_UNION.format(source=source)
