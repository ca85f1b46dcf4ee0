"""Files out."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weektide.schema import RAW_HEADERS, canonical_name, text_columns
from weektide.sources.durable import released_shuffles
from weektide.sources.files import from_windows
from weektide.sources.publish import publish

#: Rows of a packed file, about 200 MB of a raw one.
FILE_ROWS = 1_000_000


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None
) -> str:
    """Write a result table as Parquet, CSV (with header) or JSON lines."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_raw_csv(
    df: DataFrame,
    path: str,
    encoding: str = "windows-1252",
    compression: str | None = None,
    passes: int = 1,
) -> str:
    """Transactions as raw files with their header, dates month first, absent columns empty.

    Signs that the encoding lacks become ``?``.  For tables that strain the disk,
    ``compression`` packs the files (by a codec that the reader knows from their names), none
    with more than ``FILE_ROWS`` rows, since a packed file is read by one task.  ``passes``
    writes the orders in so many parts of about equal size, one after the other: ``df`` is
    computed for each, and the shuffle files of one are gone before the next.
    """
    windows = encoding.lower() in ("windows-1252", "cp1252")
    texts = text_columns(df)

    def written(name: str):
        if name not in df.columns:
            return F.lit(None).cast("string")
        if name in ("order_date", "ship_date"):
            return F.date_format(name, "M/d/yyyy")
        return from_windows(F.col(name), back=True) if windows and name in texts else F.col(name)

    options = {"header": True, "quote": '"', "escape": '"', "encoding": "iso-8859-1" if windows else encoding}
    if compression:
        options |= {"compression": compression, "maxRecordsPerFile": FILE_ROWS}
    for part in range(passes):
        # Not the hash that shuffles deal by: a part would fill few of their partitions.
        rows = df if passes == 1 else df.filter(F.pmod(F.xxhash64("order_id"), F.lit(passes)) == part)
        out = rows.select(*[written(canonical_name(h)).alias(h) for h in RAW_HEADERS])
        with released_shuffles(df.sparkSession):
            out.write.mode("append" if part else "overwrite").options(**options).csv(path)
    return path


def write_cleaned(df: DataFrame, path: str, date_col: str = "order_date") -> str:
    """Cleaned transactions as Parquet, one folder per order year.

    The rebalance hint lets Spark cut each year into files of the advisory
    partition size: few files for a small year, many tasks for a large one.
    """
    by_year = df.withColumn("order_year", F.year(date_col))
    return write_table(
        by_year.hint("rebalance", "order_year"), path, partition_by=["order_year"]
    )


def publish_cleaned(df: DataFrame, root: str, date_col: str = "order_date") -> int:
    """Cleaned transactions as the next version under ``root``; only years that changed are
    written, and readers see the version before until all are."""
    return publish(df.withColumn("order_year", F.year(date_col)), root, "order_year")


def write_features(df: DataFrame, path: str, keys: list[str] | None = None) -> str:
    """A feature table; ``keys`` become folders, so name low-cardinality keys only."""
    if keys:
        df = df.hint("rebalance", *keys)
    return write_table(df, path, partition_by=keys or None)


def save_models(models: dict[str, PipelineModel], folder: str) -> dict[str, str]:
    """One folder per fitted model, named after it."""
    paths = {}
    for name, model in models.items():
        paths[name] = f"{folder}/{name.lower().replace(' ', '_')}"
        model.write().overwrite().save(paths[name])
    return paths
