"""The text columns that the quality queries look at."""

import ast
from collections import Counter
from pathlib import Path

import pytest

import weektide.plans
from weektide.operators import quality
from weektide.plans.catalog import QUERIES

SMALL = "/root/testdata/sf0.001"
MODULES = sorted(Path(weektide.plans.__file__).parent.glob("*.py"))


@pytest.mark.parametrize("module", MODULES, ids=lambda path: path.stem)
def test_a_name_is_given_once(module):
    """A query reads its module's names when it runs: a second meaning would reach it."""
    given = Counter(
        target.id
        for node in ast.parse(module.read_text()).body if isinstance(node, ast.Assign)
        for target in node.targets if isinstance(target, ast.Name)
    )
    assert [name for name, times in given.items() if times > 1] == []


def test_white_space_is_sought_in_names(spark):
    found = QUERIES["dq_whitespace"](spark, SMALL).collect()
    assert [r["column"] for r in found] == ["product_name"]
    assert found[0]["rows"] > 0


def test_spellings_are_compared_in_all_text_columns(spark):
    found = QUERIES["dq_case"](spark, SMALL).collect()
    assert sorted(r["column"] for r in found) == [
        "category", "customer_name", "product_name", "region", "segment", "ship_mode", "state",
        "sub_category",
    ]


@pytest.mark.parametrize("rows", [[], [(None, "Rome"), (None, "ROME")]])
def test_spellings_of_a_column_without_values_are_a_row(spark, rows):
    df = spark.createDataFrame(rows, "state string, city string")
    found = quality.case_variants(df, ["state", "city"])
    assert {tuple(r) for r in found.collect()} == {
        ("state", 0, 0, True), ("city", 2, 1, False) if rows else ("city", 0, 0, True),
    }
