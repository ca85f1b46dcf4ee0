import datetime

import pytest
from pyspark.sql import functions as F

from weektide.plans import pipelines
from weektide.schema import RAW_HEADERS, canonical_name
from weektide.sources import publish as P
from weektide.sources import sinks
from weektide.sources.star import transactions

SCHEMA = "k bigint, y int, name string, amount double"
ROWS = [(1, 2001, "a", 1.0), (2, 2001, None, 2.0), (2, 2001, None, 2.0), (3, 2002, "", None), (4, None, "d", 4.0)]


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "table")


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def content(df):
    return sorted(map(repr, df.select("k", "y", "name", "amount").collect()))


def written(spark, root, version):
    rows = P.history(spark, root).filter(F.col("version") == version).collect()
    return {r["value"] for r in rows if r["written"]}, {r["value"]: r["folder"] for r in rows}


def test_what_is_published_is_read(spark, root):
    """Repeated rows, NULL values and rows without a value of the partition column too."""
    assert P.publish(table(spark), root, "y") == 1
    assert content(P.read_published(spark, root)) == content(table(spark))
    assert written(spark, root, 1)[0] == {"2001", "2002", None}


def test_only_changed_values_are_written(spark, root):
    P.publish(table(spark), root, "y")
    later = [r for r in ROWS if r[1] != 2002] + [(3, 2002, "new", 3.0), (5, 2003, "e", 5.0)]
    assert P.publish(table(spark, later), root, "y") == 2
    assert content(P.read_published(spark, root)) == content(table(spark, later))
    values, folders = written(spark, root, 2)
    assert values == {"2002", "2003"}
    before = written(spark, root, 1)[1]
    assert folders["2001"] == before["2001"] and folders[None] == before[None]
    assert content(P.read_published(spark, root, 1)) == content(table(spark))


def test_values_that_are_gone(spark, root):
    P.publish(table(spark), root, "y")
    rest = [r for r in ROWS if r[1] == 2001]
    assert P.publish(table(spark, rest), root, "y") == 2
    assert content(P.read_published(spark, root)) == content(table(spark, rest))
    assert written(spark, root, 2)[0] == set()
    assert P.publish(table(spark, []), root, "y") == 3
    assert P.read_published(spark, root).collect() == []
    assert P.read_published(spark, root).columns == ["k", "name", "amount", "y"]
    assert P.publish(table(spark, []), root, "y") == 3


def test_the_same_table_publishes_nothing(spark, root):
    P.publish(table(spark), root, "y")
    assert P.publish(table(spark, ROWS[::-1]), root, "y") == 1
    assert P.publish(P.read_published(spark, root), root, "y") == 1
    assert P.history(spark, root).count() == 3


def test_small_differences_are_changes(spark, root):
    """A NULL is no empty text, a value in another column is another row, counts matter."""
    one = [(1, 2001, "a", 1.0)]
    seen = set()
    for rows in (one, [(1, 2001, None, 1.0)], [(1, 2001, "", 1.0)], one * 2, [(None, 2001, "a", 1.0)]):
        seen.add(P.partition_digests(table(spark, rows), "y").first()["digest"])
    swapped = spark.createDataFrame([(None, "a", 1), ("a", None, 1)], "p string, q string, y int")
    seen |= {
        P.partition_digests(swapped.filter(c), "y").first()["digest"] for c in ("p IS NULL", "q IS NULL")
    }
    assert len(seen) == 7


def test_another_schema_rewrites_everything(spark, root):
    P.publish(table(spark), root, "y")
    wider = table(spark).withColumn("more", F.lit(None).cast("string"))
    assert P.publish(wider, root, "y") == 2
    assert written(spark, root, 2)[0] == {"2001", "2002", None}
    assert P.read_published(spark, root).columns == ["k", "name", "amount", "more", "y"]


def test_a_writer_lost_before_its_manifest(spark, root, monkeypatch):
    """The rows of the new version are there, the old version counts; a later writer wins."""
    P.publish(table(spark), root, "y")
    later = table(spark, [(9, 2001, "z", 9.0)])

    def lost(*args, **options):
        raise RuntimeError("lost")

    monkeypatch.setattr(type(spark), "createDataFrame", lost)
    with pytest.raises(RuntimeError):
        P.publish(later, root, "y")
    monkeypatch.undo()
    assert content(P.read_published(spark, root)) == content(table(spark))
    assert P.publish(later, root, "y") == 2
    assert content(P.read_published(spark, root)) == content(later)


def test_a_filter_prunes_folders(spark, root):
    P.publish(table(spark), root, "y")
    plan = P.read_published(spark, root).filter("y = 2001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan


def test_dates_as_values_and_texts_refused(spark, root):
    days = spark.createDataFrame(
        [(1, datetime.date(2001, 2, 3)), (2, None)], "k int, day date"
    )
    P.publish(days, root, "day")
    assert sorted(map(tuple, P.read_published(spark, root).collect()), key=str) == sorted(
        map(tuple, days.collect()), key=str
    )
    with pytest.raises(ValueError):
        P.publish(table(spark), root + "2", "name")
    with pytest.raises(ValueError):
        P.read_published(spark, root + "3")


def test_a_cleaning_run_by_versions(spark, tmp_path):
    """A corrected raw file: only its year is written, features come from the new version."""
    sales = transactions(spark, "/root/testdata/sf0.001").withColumn("country", F.lit("x"))
    sales = sales.withColumns({
        canonical_name(h): F.lit(None).cast("string")
        for h in RAW_HEADERS if canonical_name(h) not in sales.columns
    }).persist()
    raw, root, out = (str(tmp_path / n) for n in ("raw", "cleaned", "features"))
    years = [str(r[0]) for r in sales.select(F.year("order_date")).distinct().collect()]
    for version, quantity in ((1, F.col("quantity")), (2, F.when(
        F.year("order_date") == int(years[0]), F.lit(1)).otherwise(F.col("quantity")))):
        sinks.write_raw_csv(sales.withColumn("quantity", quantity), raw)
        summary = pipelines.run_cleaning(spark, raw, root, domains=None, strict=False, versioned=True)
        assert summary.first()["cleaned_rows"] == sales.count()
        assert written(spark, root, version)[0] == (set(years) if version == 1 else {years[0]})
    assert not pipelines.run_features(spark, root, out, versioned=True).isEmpty()
    total = P.read_published(spark, root).agg(F.sum("quantity")).first()[0]
    assert total == sales.select(F.sum(quantity)).first()[0]
