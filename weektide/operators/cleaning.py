"""Cleaning: trim, type, deduplicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weektide.functions.dates import parse_mixed_date
from weektide.functions.text import postal_code, strip
from weektide.schema import MONEY, PROVENANCE, TRIM_COLUMNS, text_columns


def trim_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Strip white space from text columns; others and absent names are skipped."""
    chosen, texts = TRIM_COLUMNS if columns is None else columns, text_columns(df)
    return df.withColumns({c: strip(F.col(c)) for c in chosen if c in texts})


def _whole(col: Column) -> Column:
    """A whole number, also where it is written with zeros behind a point; else NULL."""
    value = col.try_cast("decimal(38,6)")
    return F.when(value == F.floor(value), value.try_cast("bigint"))


def _amount(col: Column) -> Column:
    """A finite amount; else NULL, ``NaN`` and infinities included."""
    value = col.try_cast(MONEY)
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def standardize_types(df: DataFrame) -> DataFrame:
    """Give the well-known columns their types; unreadable values become NULL.

    So do amounts that are no finite numbers.  ``unreadable`` counts both, so that they
    can be refused.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for name in ("order_date", "ship_date"):
        if name in kinds:
            is_text = isinstance(kinds[name], T.StringType)
            out[name] = parse_mixed_date(F.col(name)) if is_text else F.col(name).cast("date")
    if "postal_code" in kinds:
        out["postal_code"] = postal_code(F.col("postal_code"))
    for name in AMOUNT_COLUMNS:
        if name in kinds:
            out[name] = _amount(F.col(name))
    for name in ("quantity", "row_id"):
        if name in kinds:
            is_long = isinstance(kinds[name], T.LongType)
            out[name] = F.col(name) if is_long else _whole(F.col(name))
    return df.withColumns(out)


#: Columns with amounts and rates.
AMOUNT_COLUMNS = ["sales", "profit", "discount"]

#: Columns whose values may be unreadable.
TYPED_COLUMNS = ["row_id", "order_date", "ship_date", "sales", "quantity", "discount", "profit"]


def _faults(df: DataFrame, columns: list[str] | None = None) -> dict[str, Column]:
    """Per typed column: the row's value is there but can't be read."""
    chosen = [c for c in (columns or TYPED_COLUMNS) if c in df.columns]
    out = {}
    for c in chosen:
        kind = df.schema[c].dataType
        if isinstance(kind, T.StringType):
            text = strip(F.col(c))
            if c in ("order_date", "ship_date"):
                value = parse_mixed_date(text)
            else:
                value = _whole(text) if c in ("quantity", "row_id") else _amount(text)
            out[c] = F.coalesce((F.length(text) > 0) & value.isNull(), F.lit(False))
        elif isinstance(kind, (T.DoubleType, T.FloatType)) and c in AMOUNT_COLUMNS:
            out[c] = F.col(c).isNotNull() & _amount(F.col(c)).isNull()
    return out


def unreadable(df: DataFrame, columns: list[str] | None = None) -> dict[str, Column]:
    """Aggregates that count, per typed column, values that are there but can't be read.

    ``df`` has the columns as written, where blank text counts as missing, or amounts
    that are numbers already, where ``NaN`` and infinities count.
    """
    return {c: F.count_if(bad) for c, bad in _faults(df, columns).items()}


def split_readable(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(readable, quarantined)`` rows of a raw table, each row in exactly one.

    ``raw`` comes from ``scan_raw_csv(typed=False, provenance=True)``.  Readable rows are
    typed and without provenance.  Quarantined ones stay as written, with ``faults``: the
    columns that can't be read, or ``record`` alone where the line has too few or too
    many fields.
    """
    values = F.array(*[F.when(bad, F.lit(c)) for c, bad in _faults(raw).items()])
    faults = F.when(F.col("corrupt_record").isNotNull(), F.array(F.lit("record"))).otherwise(
        F.array_compact(values)
    )
    judged = raw.withColumn("faults", faults)
    readable = judged.filter(F.size("faults") == 0).drop("faults", *PROVENANCE)
    return standardize_types(readable), judged.filter(F.size("faults") > 0)


def deduplicate(df: DataFrame, surrogate: str = "row_id") -> DataFrame:
    """One row per distinct combination of all columns but the surrogate.

    The lowest surrogate of each group of copies survives.  As every other
    column is part of the key, a plain aggregate rebuilds the row: copies
    collapse before the shuffle, however many of them there are.
    """
    business = [c for c in df.columns if c != surrogate]
    return df.groupBy(*business).agg(F.min(surrogate).alias(surrogate)).select(*df.columns)


def clean(df: DataFrame, trim_columns: list[str] | None = None) -> DataFrame:
    """Trim, type, deduplicate, in this order: spelling variants collapse."""
    return deduplicate(standardize_types(trim_text(df, trim_columns)))


def cleaning_summary(df: DataFrame, trim_columns: list[str] | None = None) -> DataFrame:
    """One row of counters describing what ``clean`` does to ``df``.

    The size of each group of copies gives all counters in one pass.
    """
    typed = standardize_types(trim_text(df, trim_columns))
    business = [c for c in typed.columns if c != "row_id"]
    groups = typed.groupBy(*business).agg(F.count(F.lit(1)).alias("copies"))
    counted = groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_rows"),
        F.count(F.lit(1)).alias("cleaned_rows"),
        F.count_if(F.col("profit") < 0).alias("losses"),
    )
    return _summary(counted, df, trim_columns)


def stored_cleaning_summary(
    raw: DataFrame, raw_rows: int, cleaned: DataFrame, trim_columns: list[str] | None = None
) -> DataFrame:
    """The same row when the cleaned table has been written and the raw rows counted."""
    counted = cleaned.agg(
        F.lit(raw_rows).cast("bigint").alias("raw_rows"),
        F.count(F.lit(1)).alias("cleaned_rows"), F.count_if(F.col("profit") < 0).alias("losses"),
    )
    return _summary(counted, raw, trim_columns)


def _summary(counted: DataFrame, raw: DataFrame, trim_columns: list[str] | None) -> DataFrame:
    texts = text_columns(raw)
    trimmed = [c for c in (trim_columns or TRIM_COLUMNS) if c in texts]
    return counted.select(
        "raw_rows", "cleaned_rows",
        (F.col("raw_rows") - F.col("cleaned_rows")).alias("rows_removed"),
        F.col("cleaned_rows").alias("rows_retained"),
        F.lit(len(raw.columns)).alias("columns"),
        F.col("losses").alias("negative_profit_rows_retained"),
        F.lit(",".join(trimmed)).alias("text_trimmed_columns"),
        F.lit("postal_code" in raw.columns).alias("postal_code_standardized"),
    )
