"""Tables published version by version: a reader sees the old table or the new one, whole.

Under a root folder lie ``data/run=<run>/<column>=<value>/`` and ``manifest/``.  A version
is one small file in ``manifest/`` that names, for each value of the partition column, the
folder that holds its rows, their number and a digest of them.  That file is written last and
appears by one rename, so a writer lost before it leaves the version before it readable;
what it wrote lies in a folder that no version names.

A new version writes only the values whose rows changed and names the folders of earlier
runs for all others.  The manifest has one row per folder and version, and only it passes
through the driver.  One writer at a time; readers need no lock.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MANIFEST = (
    "version bigint, run string, value string, folder string, rows bigint, "
    "digest string, written boolean, layout string"
)
#: Values of these types make folder names without escapes.
_PLAIN = (T.IntegralType, T.DateType, T.BooleanType)
#: Fixed value: the folder name Spark gives to rows without a value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _digest(columns: list[str]) -> Column:
    """A digest of rows in any order: two sums of hashes that tell NULL from absent.

    Repeated rows count as often as they occur.
    """
    marks = [F.col(f"`{c}`").isNull() for c in columns]
    values = [F.col(f"`{c}`") for c in columns]
    sums = [
        F.sum(F.xxhash64(F.lit(seed), *marks, *values).cast("decimal(38,0)")).cast("string")
        for seed in (1, 2)
    ]
    return F.concat_ws(":", *sums)


def partition_digests(df: DataFrame, column: str) -> DataFrame:
    """``(value, rows, digest)`` of each value of ``column``, NULL as one of them."""
    others = sorted(c for c in df.columns if c != column)
    return df.groupBy(F.col(f"`{column}`").cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("rows"), _digest(others).alias("digest")
    )


def history(spark: SparkSession, root: str) -> DataFrame:
    """All versions under ``root``, one row per folder that a version names.

    ``written`` says whether that version wrote the folder.  An empty version has one row
    without a folder.  A root that was never published raises.
    """
    return spark.read.schema(_MANIFEST).json(f"{root}/manifest")


def _entries(spark: SparkSession, root: str, version: int | None = None) -> list[Row]:
    try:
        rows = history(spark, root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    if version is None:
        rows = rows.filter(F.col("version") == F.lit(rows.agg(F.max("version")).first()[0]))
    else:
        rows = rows.filter(F.col("version") == version)
    return rows.collect()


def _named(column: str, value: str | None) -> str:
    return f"{column}={_NO_VALUE if value is None else value}"


def publish(df: DataFrame, root: str, column: str) -> int:
    """``df`` as the next version under ``root``, one folder per value of ``column``.

    ``column`` holds whole numbers, dates or booleans.  Rows are read once for their digests
    and, where those differ from the current version's, once more to be written: give a
    stored table.  Another schema than the current version's rewrites everything; a table
    that did not change publishes nothing.  Returns the version that now counts.
    """
    if not isinstance(df.schema[column].dataType, _PLAIN):
        raise ValueError(f"{column} has to hold whole numbers, dates or booleans")
    spark, run = df.sparkSession, uuid.uuid4().hex
    # Files keep no promise about NULL, so a table read back has the same layout.
    fields = sorted(
        [f for f in json.loads(df.schema.json())["fields"]], key=lambda f: f["name"] == column
    )
    layout = json.dumps({"type": "struct", "fields": [{**f, "nullable": True} for f in fields]})
    present = _entries(spark, root)
    version = max((e.version for e in present), default=0)
    kept = {(e.value, e.rows, e.digest): e.folder for e in present if e.folder and e.layout == layout}
    found = partition_digests(df, column).collect()
    entries, changed = [], []
    for one in found:
        folder = kept.get((one.value, one.rows, one.digest))
        if folder is None:
            changed.append(one.value)
        entries.append(
            (version + 1, run, one.value, folder or f"run={run}/{_named(column, one.value)}",
             one.rows, one.digest, folder is None, layout)
        )
    same = {e[3] for e in entries} == {e.folder for e in present if e.folder}
    if present and same and not changed and {e.layout for e in present} == {layout}:
        return version
    if changed:
        text = F.col(f"`{column}`").cast("string")
        wanted = text.isin([v for v in changed if v is not None])
        if None in changed:
            wanted = text.isNull() | wanted
        rows = df.filter(F.coalesce(wanted, F.lit(False))).hint("rebalance", column)
        rows.write.partitionBy(column).parquet(f"{root}/data/run={run}")
    entries = entries or [(version + 1, run, None, None, 0, None, False, layout)]
    manifest = spark.createDataFrame(entries, _MANIFEST).coalesce(1)
    manifest.write.mode("append").json(f"{root}/manifest")
    return version + 1


def read_published(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The current (or an earlier) version as one scan, pruned by its partition column."""
    entries = _entries(spark, root, version)
    if not entries:
        raise ValueError(f"nothing published under {root}" + (f" as version {version}" if version else ""))
    schema = T.StructType.fromJson(json.loads(entries[0].layout))
    folders = [f"{root}/data/{e.folder}" for e in entries if e.folder]
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*folders)
    return rows.select(*[F.col(f"`{f.name}`") for f in schema.fields])
