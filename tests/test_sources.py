import gzip
import hashlib
import random
from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from weektide.operators import cleaning
from weektide.operators import features as FE
from weektide.operators import models as M
from weektide.plans import catalog_quality, pipelines
from weektide.plans.registry import QUERIES
from weektide.schema import RAW_HEADERS, TRANSACTION_SCHEMA, schema_difference
from weektide.session import tune
from weektide.sources import files, sinks
from weektide.sources.star import COLUMNS, transactions
from weektide.streaming import weekly

SMALL = "/root/testdata/sf0.001"

LINE = (
    '1,CA-2016-1,11/8/2016,11-11-2016,Second Class,CG-1,"Zoë, ""Z"" Ltd",Consumer,United States,'
    "Henderson,Kentucky,1040,South,P-1,Furniture,Bookcases, Café Case ,261.96,2,0,41.9136\n"
)


@pytest.fixture
def raw_file(tmp_path):
    path = tmp_path / "raw.csv"
    again = LINE.replace("1,CA", "2,CA", 1)
    other = LINE.replace("1,CA-2016-1,", "3,CA-2016-2,", 1)
    path.write_bytes((",".join(RAW_HEADERS) + "\n" + LINE + again + other).encode("latin-1"))
    return str(path)


def test_csv_scan_keeps_every_row_and_the_encoding(spark, raw_file):
    rows = files.scan_raw_csv(spark, raw_file).orderBy("row_id").collect()
    assert len(rows) == 3
    assert rows[0]["customer_name"] == 'Zoë, "Z" Ltd'
    assert (str(rows[0]["order_date"]), str(rows[0]["ship_date"])) == ("2016-11-08", "2016-11-11")
    assert (rows[0]["sales"], rows[0]["quantity"], rows[0]["profit"]) == (261.96, 2, 41.9136)
    unparsed = files.scan_raw_csv(spark, raw_file, parse_dates=False).first()
    assert unparsed["order_date"] == "11/8/2016"


def test_missing_file_is_an_error(spark):
    with pytest.raises(AnalysisException):
        files.scan_raw_csv(spark, "/tmp/there-is-no-such-file.csv")


def test_fingerprint_does_not_change_by_reading(spark, raw_file):
    before = files.file_fingerprints(spark, raw_file).first()
    files.scan_raw_csv(spark, raw_file).count()
    after = files.file_fingerprints(spark, raw_file).first()
    assert before == after and len(before["sha256"]) == 64


def test_fingerprints_of_files_beyond_one_value(spark, tmp_path):
    rng = random.Random(4)
    noise = rng.randbytes(200_000)
    contents = {
        "a.parquet": b"PAR1" + noise, "b c.bin": noise + b"\n\n", "mark.csv": b"\xef\xbb\xbfa,b\r\n" * 900,
        "mark.txt": b"\xef\xbb\xbf" + noise + b".", "zeros.bin": bytes(50_000), "small.csv": b"a\n",
        "packed.gz": gzip.compress(noise), "no_suffix": noise * 5, "é%20.é ü": b"\n" * 70_000,
    }
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    least = {
        "spark.sql.sources.binaryFile.maxLength": "5000", "spark.sql.files.maxPartitionBytes": "30000",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "300",
    }
    before = {name: spark.conf.get(name) for name in least}
    try:
        for name, value in least.items():
            spark.conf.set(name, value)
        rows = files.file_fingerprints(spark, str(tmp_path)).collect()
        one = files.file_fingerprints(spark, f"{tmp_path}/no_suffix").first()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(rows) == len(contents) and one in rows
    got = {r["path"].rpartition("/")[2]: (r["size_bytes"], r["sha256"]) for r in rows}
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items()}
    whole = files.file_fingerprints(spark, str(tmp_path))
    assert sorted(whole.collect()) == sorted(rows)


def test_raw_files_in_passes(spark, tmp_path):
    rows = [
        (i, None if i % 9 == 0 else f"o{i // 3}", date(1999, 1 + i % 12, 3), f"Zoë, \"{i % 7}\"", i / 4)
        for i in range(2000)
    ]
    names = "row_id bigint, order_id string, order_date date, city string, sales double"
    lines = spark.createDataFrame(rows + rows[:50], names)
    # A shuffle, whose files are to go with the pass that made them.
    shuffled = lines.repartition(4, "row_id")
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held() -> set:
        return {b for b in blocks.getAllBlocks().mkString(" ").split() if "shuffle_" in b}

    setting, before = spark.conf.getAll, held()
    path = sinks.write_raw_csv(shuffled, str(tmp_path / "raw"), compression="gzip", passes=3)
    assert held() <= before and spark.conf.getAll == setting
    written = [p for p in (tmp_path / "raw").iterdir() if p.name.startswith("part-")]
    assert written and all(p.name.endswith(".csv.gz") for p in written)
    back = files.scan_raw_csv(spark, path).select("row_id", "order_id", "order_date", "city", "sales")
    assert sorted(map(repr, back.collect())) == sorted(map(repr, lines.collect()))
    sinks.write_raw_csv(lines.limit(5), path)
    assert files.scan_raw_csv(spark, path).count() == 5
    shuffled.write.parquet(str(tmp_path / "kept"))
    assert held() - before


def test_round_trip_takes_passes_and_packed_files(spark, tmp_path, monkeypatch):
    day = datetime(1999, 2, 3)
    tables = {
        "lineitem": (
            "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
            "l_extendedprice double, l_discount double, l_shipdate timestamp",
            [(None if i % 50 == 0 else i // 4, i % 7, i % 4, 2.0, i / 4, 0.05, day) for i in range(600)] * 2,
        ),
        "orders": (
            "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_orderpriority string",
            [(i, i % 5, day, "5-LOW") for i in range(140)],
        ),
        "customer": (
            "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
            [(i, f"C, {i}", i % 2, "BUILDING") for i in range(4)],
        ),
        "part": (
            "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double",
            [(i, f"part \"{i}\"", "B", "PROMO", 9.5) for i in range(6)],
        ),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "A", 0), (1, "B", 0)]),
        "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))

    def round_trip():
        back = QUERIES["csv_round_trip"](spark, str(tmp_path))
        return sorted(map(repr, back.collect())), back.inputFiles()

    one_pass, packed = round_trip()
    assert len(one_pass) == 1200 and all(name.endswith(".gz") for name in packed)
    wrote, write = [], sinks.write_raw_csv
    monkeypatch.setattr(catalog_quality, "PASS_ROWS", 500)
    monkeypatch.setattr(sinks, "write_raw_csv", lambda *a, **o: wrote.append(o) or write(*a, **o))
    assert round_trip()[0] == one_pass
    assert wrote == [{"compression": "gzip", "passes": 3}]


def test_every_byte_of_the_windows_encoding(spark, tmp_path):
    path = tmp_path / "odd.csv"
    signs = bytes(b for b in range(0x80, 0x100) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
    line = LINE.encode("latin-1").replace("Zoë".encode("latin-1"), signs)
    path.write_bytes((",".join(RAW_HEADERS) + "\n").encode() + line)
    row = files.scan_raw_csv(spark, str(path)).first()
    assert row["customer_name"].startswith(signs.decode("cp1252"))


def test_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "breaks.csv"
    path.write_text(",".join(RAW_HEADERS) + "\n" + LINE.replace(" Café Case ", '"Cafe\nCase"'))
    row = files.scan_raw_csv(spark, str(path), multi_line=True).collect()
    assert len(row) == 1 and row[0]["sales"] == 261.96


def test_unreadable_amounts_are_refused(spark, tmp_path):
    path, out = tmp_path / "bad.csv", str(tmp_path / "cleaned")
    head = ",".join(RAW_HEADERS) + "\n"
    path.write_bytes((head + LINE.replace(",2,0,", ",2.0,0,")).encode("latin-1"))
    assert pipelines.run_cleaning(spark, str(path), out).first()["cleaned_rows"] == 1
    assert spark.read.parquet(out).first()["quantity"] == 2
    path.write_bytes((head + LINE.replace("261.96", "abc")).encode("latin-1"))
    with pytest.raises(ValueError, match="unreadable_sales"):
        pipelines.run_cleaning(spark, str(path), out)
    path.write_bytes((head + LINE.replace("Furniture", "")).encode("latin-1"))
    with pytest.raises(ValueError, match="domain_category"):
        pipelines.run_cleaning(spark, str(path), out)
    assert spark.read.parquet(out).first()["sales"] == 261.96  # the good table is still there


@pytest.mark.parametrize("amount", ["NaN", "Infinity", "-Infinity"])
def test_amounts_that_are_no_numbers_are_refused(spark, tmp_path, amount):
    path = tmp_path / "nan.csv"
    head = ",".join(RAW_HEADERS) + "\n"
    path.write_bytes((head + LINE.replace("261.96", amount)).encode("latin-1"))
    with pytest.raises(ValueError, match="unreadable_sales"):
        pipelines.run_cleaning(spark, str(path), str(tmp_path / "c"))
    typed = files.scan_raw_csv(spark, str(path))
    assert typed.agg(cleaning.unreadable(typed)["sales"]).first()[0] == 1
    assert cleaning.standardize_types(typed).first()["sales"] is None


def test_quarantine_takes_each_row_once(spark, tmp_path):
    path = tmp_path / "mixed.csv"
    lines = [
        LINE, LINE.replace("261.96", "abc").replace("11/8/2016", "13/45/2016"), "4,CA-1\n",
        LINE.replace("1,CA", "5,CA", 1).rstrip() + ",more\n", LINE.replace(",2,0,", ",,,"),
    ]
    path.write_bytes((",".join(RAW_HEADERS) + "\n" + "".join(lines)).encode("latin-1"))
    raw = files.scan_raw_csv(spark, str(path), typed=False, provenance=True)
    good, apart = cleaning.split_readable(raw)
    seen = [(r["row_id"], r["quantity"], r["sales"]) for r in good.collect()]
    assert seen == [(1, 2, 261.96), (1, None, 261.96)]
    assert set(good.columns) == set(TRANSACTION_SCHEMA.names)
    rows = apart.orderBy(F.array_join("faults", ","), "row_id").collect()
    assert [r["faults"] for r in rows] == [["order_date", "sales"], ["record"], ["record"]]
    assert rows[0]["sales"] == "abc" and rows[0]["corrupt_record"] is None
    assert rows[1]["corrupt_record"] == "4,CA-1" and rows[2]["corrupt_record"].endswith(",more")
    assert all(r["file_path"].endswith("mixed.csv") and r["block_start"] == 0 for r in rows)
    assert cleaning.split_readable(raw)[1].select("faults").count() == 3


def test_cleaning_pipeline(spark, raw_file, tmp_path):
    out = str(tmp_path / "cleaned")
    summary = pipelines.run_cleaning(spark, raw_file, out).first()
    assert (summary["raw_rows"], summary["cleaned_rows"]) == (3, 2)
    got = files.load_transactions(spark, out)
    row = got.orderBy("row_id").first()
    assert (row["row_id"], row["postal_code"], row["product_name"]) == (1, "01040", "Café Case")
    assert (row["year"], row["quarter"], row["month"], row["year_month"]) == (2016, 4, 11, "2016-11")
    missing, _ = schema_difference(got, TRANSACTION_SCHEMA.names)
    assert missing == []


def test_strict_cleaning_refuses_unknown_members(spark, raw_file, tmp_path):
    with pytest.raises(ValueError, match="domain_region"):
        pipelines.run_cleaning(spark, raw_file, str(tmp_path / "c"), {"region": ["North"]})


def test_view_rows_do_not_depend_on_the_columns(spark):
    whole = transactions(spark, SMALL)
    assert whole.columns == COLUMNS and whole.count() == 6000
    assert transactions(spark, SMALL, ["region"]).count() == 6000
    with pytest.raises(ValueError):
        transactions(spark, SMALL, ["colour"])


def test_view_reads_only_what_is_asked(spark):
    df = transactions(spark, SMALL, ["sales"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert "ReadSchema: struct<l_extendedprice:double,l_discount:double>" in plan


def test_evaluation_tables_are_optional(spark, tmp_path):
    assert files.load_evaluation_tables(spark, str(tmp_path)) == {}
    sinks.write_table(spark.range(1), str(tmp_path / "backtest_folds"))
    assert set(files.load_evaluation_tables(spark, str(tmp_path))) == {"backtest_folds"}


def test_feature_table_must_have_its_columns(spark, tmp_path):
    sinks.write_table(spark.range(1), str(tmp_path / "f"))
    with pytest.raises(ValueError):
        files.load_features(spark, str(tmp_path / "f"))


def test_training_and_forecast_pipelines(spark, tmp_path):
    cleaned, stored, out = (str(tmp_path / n) for n in ("cleaned", "features", "out"))
    sinks.write_table(transactions(spark, SMALL), cleaned)
    assert pipelines.run_features(spark, cleaned, stored).first()["passed"]
    ranking = pipelines.run_training(
        spark, stored, out, 2001, 3, parallelism=8
    ).collect()
    maes = [r["test_mae"] for r in ranking]
    assert len(ranking) == 6 and maes == sorted(maes)
    tables = files.load_evaluation_tables(spark, out)
    assert tables["backtest_folds"].count() == 18
    assert tables["worst_forecasts"].count() == 40
    meta = tables["model_metadata"].first()
    assert meta["feature_count"] == 26 and meta["holdout"]["mae"] in maes
    assert meta["holdout"]["beats_naive"] in ("YES", "NO") and meta["backtest"]["mean_mae"] > 0
    formulas = {r["formula"] for r in spark.read.json(f"{out}/baseline_predictions").collect()}
    assert formulas == {"prediction = sales_lag_1", "prediction = sales_lag_52"}
    assert spark.read.option("header", True).csv(f"{out}/example_forecast").count() > 20
    summary = pipelines.run_forecast(
        spark, stored, f"{out}/models/final_model", str(tmp_path / "forecast"), 3
    ).first()
    back = spark.read.option("header", True).csv(str(tmp_path / "forecast"))
    assert back.count() == 3 and summary["total_sales"] > 0


def test_features_by_key_are_written_by_folder(spark, tmp_path):
    columns = ["region", "order_date", "order_id", "sales", "profit", "quantity", "discount"]
    table = FE.build_features(transactions(spark, SMALL, columns), ["region"])
    path = sinks.write_features(table, str(tmp_path / "f"), ["region"])
    assert spark.read.parquet(path).filter("region = 'ASIA'").count() > 0


def test_shuffle_width_follows_the_data(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        tune(spark, shuffle_bytes=10 * 2**30)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
        tune(spark, shuffle_bytes=1)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stream_of_files_equals_batch(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    lines = transactions(spark, SMALL, ["order_date", "sales", "profit", "quantity", "region"])
    for part in (F.col("order_date") < "1998-01-01", F.col("order_date") >= "1998-01-01"):
        lines.filter(part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(lines.schema).parquet(source)
        weekly.append_closed_weeks(
            weekly.weekly_totals(stream, ["region"]), out, state
        ).awaitTermination()
    got = spark.read.parquet(out)
    batch = weekly.weekly_totals(lines, ["region"])
    newest = got.agg(F.max("date")).first()[0]
    closed = batch.filter(F.col("date") <= F.lit(newest))
    assert got.count() == closed.count() > 900
    assert got.exceptAll(closed).count() == 0
