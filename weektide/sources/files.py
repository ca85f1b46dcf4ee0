"""Files in: raw CSV, cleaned tables, feature tables, evaluation tables, models."""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator
from itertools import pairwise
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weektide.functions.dates import parse_mixed_date, year_month
from weektide.schema import RAW_SCHEMA, canonical_name, require_columns, text_columns

#: Bytes of a file that a task may hold as one value, and more than once.
WHOLE = 64 << 20
#: Of names as Spark gives them, with odd signs as %XX.
_SUFFIX = r"\.([A-Za-z0-9_-]+)$"


def scan_raw_csv(
    spark: SparkSession,
    path: str,
    encoding: str = "windows-1252",
    parse_dates: bool = True,
    mode: str = "PERMISSIVE",
    typed: bool = True,
    multi_line: bool = False,
    header: bool = True,
    provenance: bool = False,
) -> DataFrame:
    """Every row of a raw transaction CSV, under canonical names.

    A missing path raises on call.  ``mode='FAILFAST'`` makes an undecodable
    record an error.  ``typed=False`` leaves every column as written.
    ``multi_line`` reads quoted line breaks as part of a value; a file is then read
    by one task.  ``provenance`` adds ``corrupt_record``, the whole line where it has
    too few or too many fields, ``file_path`` and ``block_start``, the offset of the part
    of the file that holds the line.
    """
    windows = encoding.lower() in ("windows-1252", "cp1252")
    schema = RAW_SCHEMA
    if not typed:
        schema = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_SCHEMA.fields])
    if provenance:
        schema = T.StructType([*schema.fields, T.StructField("corrupt_record", T.StringType())])
    raw = (
        spark.read.schema(schema)
        .option("columnNameOfCorruptRecord", "corrupt_record")
        # A parser that skips columns would not see that a line has too few.
        .option("columnPruning", not provenance)
        .option("header", header)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "iso-8859-1" if windows else encoding)
        .option("multiLine", multi_line)
        .option("mode", mode)
        .csv(path)
    )
    origin = []
    if provenance:
        origin = [
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
        ]
    out = raw.select(*[F.col(f"`{c}`").alias(canonical_name(c)) for c in raw.columns], *origin)
    if windows:
        out = out.withColumns({c: from_windows(F.col(c)) for c in text_columns(out) if c != "file_path"})
    if not (parse_dates and typed):
        return out
    return out.withColumns(
        {c: parse_mixed_date(F.col(c)) for c in ("order_date", "ship_date")}
    )


def from_windows(text: Column, back: bool = False) -> Column:
    """Text read byte by byte as ISO-8859-1, as Windows-1252 means it.

    The two differ in the bytes 0x80-0x9F only, of which five have no meaning and stay.
    ``back`` prepares text for being written byte by byte.
    """
    both = [
        (chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0)
    ]
    both = [(a, b) for a, b in both if b]
    read, meant = "".join(a for a, _ in both), "".join(b for _, b in both)
    return F.translate(text, meant, read) if back else F.translate(text, read, meant)


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """Size and SHA-256 of each file under ``path``.

    A digest is one pass over its file by one task.  A file of up to ``WHOLE`` bytes is one
    row there; of a larger one, the task holds a batch of lines at a time, whatever the
    bytes mean.  So no file is too large, but a stretch of it without a line feed must fit
    in a task, and have less than 2 GB.
    """
    files = spark.read.format("binaryFile").load(path)
    whole = min(WHOLE, int(spark.conf.get("spark.sql.sources.binaryFile.maxLength")))
    out = files.filter(F.col("length") <= whole).select(
        "path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256")
    )
    suffixes = {re.search(_SUFFIX, name) for name in files.inputFiles()}
    for suffix in sorted({found[1] if found else "" for found in suffixes}):
        out = out.unionByName(_large_fingerprints(spark, path, suffix, whole))
    return out


def _large_fingerprints(spark: SparkSession, path: str, suffix: str, whole: int) -> DataFrame:
    """The same for the files of over ``whole`` bytes whose names end in ``suffix``.

    Hadoop's codec that changes nothing, declared for the suffix, makes a file one split and
    keeps packed files packed.  It needs a suffix: without one a file may come in many splits,
    which are put in order by a shuffle.
    """
    reader = spark.read.option("lineSep", "\n")
    if suffix:
        codec = "io.compress.passthrough.extension"
        reader = reader.options(**{
            "io.compression.codecs": "org.apache.hadoop.io.compress.PassthroughCodec",
            # Spark's build of Hadoop renames the key.
            codec: f".{suffix}", f"org.apache.hadoop.shaded.{codec}": f".{suffix}",
        })
    file = F.col("_metadata")
    lines = reader.text(path).filter(
        (file["file_size"] > whole) & (F.regexp_extract(file["file_name"], _SUFFIX, 1) == suffix)
    ).select(
        file["file_path"].alias("path"), file["file_size"].alias("size"),
        F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("line"),
        *([] if suffix else [
            file["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("at")
        ]),
    )
    if not suffix:
        lines = lines.repartition("path").sortWithinPartitions("path", "start", "at")
    return lines.select("path", "size", "line").mapInArrow(
        _digests, "path string, size_bytes bigint, sha256 string"
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each file, whose lines lie in order, all with a line feed.

    The size tells whether the last line has one, and whether the reader left out a byte order
    mark, which is found out last: both digests are kept, but for Parquet files.
    """
    current = None
    for batch in batches:
        names = batch.column(0).dictionary_encode()
        codes = names.indices.to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
        lines = batch.column(2).cast(pa.large_binary())
        for begin, end in pairwise(cuts):
            if begin == end:
                continue
            name = names.dictionary[int(codes[begin])].as_py()
            if current is None or current[0] != name:
                if current is not None:
                    yield _digest(*current)
                size = batch.column(1)[begin].as_py()
                heads = [b""] if lines[begin].as_py()[:4] == b"PAR1" else [b"", codecs.BOM_UTF8]
                current = (name, size, [0], [hashlib.sha256(head) for head in heads])
            _, _, read, digests = current
            offsets = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset:]
            part = memoryview(lines.buffers()[2])[offsets[begin]:offsets[end]]
            for digest in digests:
                if read[0]:
                    digest.update(b"\n")
                digest.update(part[:-1])
            read[0] += len(part)
    if current is not None:
        yield _digest(*current)


def _digest(name: str, size: int, read: list[int], digests: list) -> pa.RecordBatch:
    left = size - read[0]
    marked = left in (2, 3)
    if left not in (-1, 0, 2, 3) or marked and len(digests) == 1:
        raise ValueError(f"{name}: {read[0]} bytes read of {size}")
    digest = digests[marked]
    if left in (0, 3):
        digest.update(b"\n")
    row = {"path": [unquote(name)], "size_bytes": [size], "sha256": [digest.hexdigest()]}
    return pa.RecordBatch.from_pydict(row)


def with_calendar(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    """Add ``year``, ``quarter``, ``month`` and ``year_month`` of a date column."""
    day = F.col(date_col)
    return df.withColumns(
        {
            "year": F.year(day),
            "quarter": F.quarter(day),
            "month": F.month(day),
            "year_month": year_month(day),
        }
    )


def load_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned transactions with calendar columns."""
    return with_calendar(spark.read.parquet(path))


def load_features(spark: SparkSession, path: str) -> DataFrame:
    """A stored feature table; ``date`` and ``sales`` must be there."""
    df = spark.read.parquet(path)
    require_columns(df, ["date", "sales"], "feature table")
    return df


def load_evaluation_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The stored evaluation tables that exist under ``folder``."""
    readers = {
        "model_comparison": spark.read.parquet,
        "backtest_folds": spark.read.parquet,
        "worst_forecasts": spark.read.parquet,
        "model_metadata": spark.read.json,
    }
    found = {}
    for name, read in readers.items():
        try:
            found[name] = read(f"{folder}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
