"""Column names, types and default parameters shared by every operator.

Operators work on one canonical *transactions* table: one row per order line,
snake_case columns, amounts in DOUBLE with at most four decimals.  Sums of amounts
are taken in whole ten-thousandths (``functions.numeric.fixed_sum``), so they are
exact and do not depend on how the rows were partitioned.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

MONEY = T.DoubleType()
RATE = T.DoubleType()

# Decimals kept of every amount and rate.
AMOUNT_DIGITS = 4

# Header row of a raw transaction file, in file order.
RAW_HEADERS = [
    "Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode",
    "Customer ID", "Customer Name", "Segment", "Country", "City",
    "State", "Postal Code", "Region", "Product ID", "Category",
    "Sub-Category", "Product Name", "Sales", "Quantity", "Discount", "Profit",
]

# Allowed members of the four controlled columns.
DOMAINS = {
    "category": ["Furniture", "Office Supplies", "Technology"],
    "segment": ["Consumer", "Corporate", "Home Office"],
    "region": ["Central", "East", "South", "West"],
    "ship_mode": ["First Class", "Same Day", "Second Class", "Standard Class"],
}

# Text columns stripped by default when cleaning.
TRIM_COLUMNS = [
    "order_id", "ship_mode", "customer_id", "customer_name", "segment",
    "country", "city", "state", "region", "product_id", "category",
    "sub_category", "product_name",
]

# Right-closed discount bands and their labels.
DISCOUNT_EDGES = [-0.001, 0.0, 0.20, 0.40, 0.60, 0.80]
DISCOUNT_LABELS = [
    "0% (No Discount)", "0.01% - 20%", "20.01% - 40%",
    "40.01% - 60%", "60.01% - 80%",
]

# Default lag steps of the weekly target, in weeks.
LAG_STEPS = [1, 2, 3, 4, 8, 12, 52]

# Columns of a feature table that are never predictors.
TARGET_COLUMNS = ["date", "sales", "log_sales"]

# Same-week measures that must not appear in a feature table.
SAME_WEEK_COLUMNS = ["profit", "quantity", "orders", "avg_discount", "discount"]


def canonical_name(header: str) -> str:
    """``"Sub-Category"`` -> ``"sub_category"``."""
    return re.sub(r"[^0-9a-z]+", "_", header.strip().lower()).strip("_")


_TYPES = {
    "row_id": T.LongType(),
    "sales": MONEY,
    "profit": MONEY,
    "discount": RATE,
    "quantity": T.LongType(),
    "order_date": T.DateType(),
    "ship_date": T.DateType(),
}

#: Raw file: numbers typed, everything else (dates included) as written.
RAW_SCHEMA = T.StructType(
    [
        T.StructField(
            h,
            T.StringType()
            if canonical_name(h) in ("order_date", "ship_date")
            else _TYPES.get(canonical_name(h), T.StringType()),
        )
        for h in RAW_HEADERS
    ]
)

#: Where a raw row comes from; ``corrupt_record`` is a line that does not fit the header.
PROVENANCE = ["corrupt_record", "file_path", "block_start"]

#: The cleaned, typed transactions table.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField(canonical_name(h), _TYPES.get(canonical_name(h), T.StringType()))
        for h in RAW_HEADERS
    ]
)


def text_columns(df) -> list[str]:
    """Names of the string columns of ``df``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def require_columns(df, names, what: str = "table") -> None:
    """Raise ``ValueError`` when a needed column is absent (no Spark job)."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required columns: {missing}")


def schema_difference(df, expected) -> tuple[list[str], list[str]]:
    """(missing, unexpected) column names, without running a job."""
    present = list(df.columns)
    return (
        [c for c in expected if c not in present],
        [c for c in present if c not in expected],
    )
