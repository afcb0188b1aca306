"""The catalogue of the day, against a search over all versions in plain Python."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.operators import as_of
from tests.conftest import plain

START = dt.date(2024, 1, 1)
ROWS = "row_id long, product_id long, batch_date date, quantity int, version string"
VERSIONS = "product_id long, valid_from date, sales_price decimal(10,2), cost_to_make decimal(10,2), stock int"


def case(n=1200, seed=3):
    rng = random.Random(seed)

    def day(most):
        return None if rng.random() < 0.05 else START + dt.timedelta(days=rng.randint(0, most))

    versions = [
        (rng.choice([None, *range(1, 9)]), day(60), Decimal(rng.randint(100, 999)) / 100, Decimal("0.50"), rng.choice([None, 0, 5, 50]))
        for _ in range(60)
    ]
    rows = [(i, 1 if rng.random() < 0.4 else rng.choice([None, *range(1, 12)]), day(70), rng.randint(-2, 60), "mine") for i in range(n)]
    return rows, versions


def searched(row, versions):
    old = lambda day: (day is not None, day or START)
    fits = [v for v in versions if v[0] is not None and v[0] == row[1] and old(v[1]) <= old(row[2])]
    return max(fits, key=lambda v: (old(v[1]), *((x is not None, x) for x in v[2:])), default=None)


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_equals_a_search(spark, blocks, monkeypatch):
    rows, versions = case()
    monkeypatch.setattr(
        as_of, "in_blocks",
        lambda df, group, order: df.repartitionByRange(blocks, *group, *order).withColumn("block", F.spark_partition_id()).cache(),
    )
    frame, catalogue = spark.createDataFrame(rows, ROWS), spark.createDataFrame(versions, VERSIONS)
    found = as_of.as_of(frame.drop("version"), catalogue, "product_id", "batch_date")
    got = {r["row_id"]: r["version"] and tuple(r["version"]) for r in found.collect()}
    want = {r[0]: (lambda v: v and v[2:])(searched(r, versions)) for r in rows}
    assert got == want and len(set(map(bool, got.values()))) == 2


def test_a_hot_product_is_cut_into_blocks(spark, monkeypatch):
    rows, versions = case(4000)
    sizes = []

    def watched(df, group, order):
        cut = df.repartitionByRange(16, *group, *order).withColumn("block", F.spark_partition_id()).cache()
        sizes.extend(r["count"] for r in cut.filter("k = 1").groupBy("block").count().collect())
        return cut

    monkeypatch.setattr(as_of, "in_blocks", watched)
    frame = spark.createDataFrame(rows, ROWS).withColumn("batch_date", F.lit(START).cast("date"))
    as_of.as_of(frame.drop("version"), spark.createDataFrame(versions, VERSIONS), "product_id", "batch_date").count()
    assert len(sizes) > 3 and max(sizes) < 0.5 * sum(sizes)  # all on one day


def test_validated_lines_and_latest_version(spark):
    versions = spark.createDataFrame(
        [(1, START, Decimal("2.00"), Decimal("1.00"), 5), (1, START + dt.timedelta(9), Decimal("3.00"), Decimal("1.50"), 1),
         (2, None, Decimal("1.00"), Decimal("0.10"), None)], VERSIONS)
    lines = spark.createDataFrame(
        [(1, 1, START - dt.timedelta(1), 1), (2, 1, START, 5), (3, 1, START + dt.timedelta(9), 5), (4, 2, START, 1),
         (5, 1, START + dt.timedelta(99), 1), (6, 3, START, 1), (7, 1, START, None)],
        "order_id long, product_id long, batch_date date, quantity int")
    found = as_of.validate_lines_as_of(lines, versions)
    assert plain(found, "order_id", "final_quantity", "line_cents", "profit_cents") == [
        (1, None, None, None), (2, 5, 1000, 500), (3, None, None, None), (4, None, None, None), (5, 1, 300, 150), (6, None, None, None),
    ]
    assert as_of.validate_lines_as_of(lines.limit(0), versions).count() == 0
    assert as_of.validate_lines_as_of(lines, versions.limit(0)).filter("unit_price IS NOT NULL").count() == 0
    assert plain(as_of.latest(versions), "product_id", "stock") == [(1, 1), (2, None)]
    early = as_of.latest(versions, F.lit(START + dt.timedelta(1)))
    assert plain(early, "product_id", "stock") == [(1, 5), (2, None)]
