"""Stock that runs out, against a walk over the lines in plain Python."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.operators import running_stock
from tests.conftest import plain, product

LINES = "batch_date date, order_id long, product_id long, quantity int, row_id long"


def walk(lines, stocks, reload_daily):
    left, out = {}, []
    rows = sorted(lines, key=lambda r: (r[0] is not None, r[0] or dt.date.min, r[1], r[3] or 0, r[4]))
    for day, order, item, quantity, row_id in rows:
        if quantity is None:
            continue
        key = (item, day) if reload_daily else item
        stock = left.setdefault(key, stocks.get(item))
        filled = stock is not None and quantity <= stock
        if filled:
            left[key] = stock - quantity
        out.append((day, order, item, quantity if filled else None, row_id))
    return sorted(out, key=lambda r: r[4])


def case(spark, n, seed=1):
    """Random lines, a third of them of one product, with returns, no quantities, and missing days."""
    rng, start = random.Random(seed), dt.date(2024, 3, 1)
    lines = [
        (
            None if rng.random() < 0.05 else start + dt.timedelta(days=rng.randint(0, 5)), rng.randint(1, n),
            1 if rng.random() < 0.33 else rng.randint(2, 9), rng.choice([None, -7, -2, 0, 1, 2, 3, 5, 9, 30, 500]), row,
        )
        for row in range(n)
    ]
    catalogue = [product(i, stock=s) for i, s in enumerate([200, 0, None, 40, 10**9, -5, 7], 1)]
    products = spark.createDataFrame(catalogue, "product_id long, product_name string, c string, s string, h string, "
                                     "sales_price decimal(10,2), cost_to_make decimal(10,2), stock int")
    return lines, products, {row[0]: row[7] for row in catalogue}


@pytest.mark.parametrize("reload_daily", [False, True])
@pytest.mark.parametrize("most_steps", [4096, 3])
def test_equals_a_walk_over_the_lines(spark, reload_daily, most_steps, monkeypatch):
    lines, products, stocks = case(spark, 1500)
    frame = spark.createDataFrame(lines, LINES).repartition(5)
    monkeypatch.setattr(
        running_stock, "in_blocks",
        lambda df, group, order: df.repartitionByRange(12, *group, *order).withColumn("block", F.spark_partition_id()).cache(),
    )
    found = running_stock.with_filled(frame, products, reload_daily=reload_daily, most_steps=most_steps)
    got = found.select("batch_date", "order_id", "product_id", F.when(F.col("filled"), F.col("quantity")), "row_id")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[4]) == walk(lines, stocks, reload_daily)


def test_a_hot_product_is_in_no_single_task(spark):
    lines, products, stocks = case(spark, 3000, seed=2)
    frame = spark.createDataFrame(lines, LINES).withColumn("quantity", F.col("quantity") % 4)
    sizes = {}
    original = running_stock._filled

    def watched(blocks, group, order):
        for row in blocks.groupBy("product_id", "block").count().collect():
            sizes.setdefault(row["product_id"], []).append(row["count"])
        return original(blocks, group, order)

    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    running_stock._filled = watched
    try:
        found = plain(running_stock.with_filled(frame, products), "row_id", "filled")
    finally:
        running_stock._filled = original
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(sizes[1]) > 1 and max(sizes[1]) < 0.7 * sum(sizes[1])
    rest = lambda q: None if q is None else int(np.fmod(q, 4))
    walked = walk([(*r[:3], rest(r[3]), r[4]) for r in lines], stocks, False)
    assert found == [(r[4], r[3] is not None) for r in walked]


def test_amounts_and_columns_are_those_of_validated_lines(spark, products, validate):
    from daybook import schemas
    from daybook.operators.lines import explode_items, validate_lines
    from tests.conftest import document

    nested = spark.createDataFrame([document(1, (1, 8), (2, 5), (9, 1)), document(2, (1, 3), (1, 2), (4, 1))], schemas.TRANSACTIONS)
    asked = explode_items(nested)
    found = running_stock.validate_running_stock(asked, products)
    assert set(found.columns) == set(validate_lines(asked, products).columns)
    assert plain(found, "order_id", "product_id", "quantity", "final_quantity", "line_cents") == [
        (1, 1, 8, 8, 2000), (1, 2, 5, 5, 495), (1, 9, 1, None, None),
        (2, 1, 2, 2, 500), (2, 1, 3, None, None), (2, 4, 1, None, None),
    ]
    assert running_stock.validate_running_stock(asked.limit(0), products).count() == 0


def test_steps_equal_the_lines_for_every_stock():
    rng = random.Random(4)
    for _ in range(60):
        least, most = rng.choice([(0, 60), (-4, 25)])
        quantities = [rng.randint(-6, 40) for _ in range(rng.randint(0, 40))]
        steps = running_stock.Steps(least, most)
        for q in quantities:
            steps.add(q)
        for stock in range(least, most + 1):
            left = stock
            for q in quantities:
                left -= q if q <= left else 0
            assert steps.after(stock) == left
