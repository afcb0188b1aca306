"""Plans and skew: what must hold when one key owns a third of the rows."""

import contextlib

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from daybook.operators import inventory, lines, orders, running, summary
from daybook.plans import driver_tables as given
from daybook.plans.queries import QUERIES
from daybook.sinks.tables import write_batches
from tests.conftest import plain
from tests.settings import SMALL_DIR

# A cluster in miniature: nothing is small enough to broadcast, and partitions count as skewed
# from a few kilobytes on.
MINIATURE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
}


@contextlib.contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The given lines, with a third of them moved to one order, one day and one product."""
    path = str(tmp_path_factory.mktemp("skewed") / "lines")
    hot = F.pmod(F.xxhash64("row_id"), F.lit(3)) == 0
    moved = given.lines(spark, SMALL_DIR, row_ids=True).withColumns(
        {
            "order_id": F.when(hot, F.lit(7)).otherwise(F.col("order_id")),
            "product_id": F.when(hot, F.lit(49)).otherwise(F.col("product_id")),
            "batch_date": F.when(hot, F.lit("1996-02-29").cast("date")).otherwise(F.col("batch_date")),
        }
    )
    moved.repartition(8).write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df, capsys):
    df.collect()
    capsys.readouterr()
    df.explain()
    plan = capsys.readouterr().out
    return plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan


def test_hot_product_join_is_split(spark, skewed, capsys):
    products = given.products(spark, SMALL_DIR)
    validated = lines.validate_lines(skewed, products)
    expected = plain(summary.daily_summary(validated))
    with settings(spark, MINIATURE):
        again = lines.validate_lines(skewed, products)
        assert "skew=true" in final_plan(again, capsys)
        found = summary.daily_summary(again)
        assert "skew=true" in final_plan(found, capsys)
        assert plain(found) == expected


def test_hot_order_join_is_split_although_the_aggregation_shares_its_key(spark, skewed, capsys):
    headers = given.orders(spark, SMALL_DIR)
    items = skewed.select("order_id", "product_id", "quantity")

    def per_order():
        joined = orders.orders_with_items(headers, items)
        return joined.groupBy("batch_date", "order_id").agg(F.sum("quantity").alias("q"))

    expected = plain(per_order())
    with settings(spark, MINIATURE):
        found = per_order()
        assert "skew=true" in final_plan(found, capsys)
        assert plain(found) == expected


def test_hot_order_semi_join_is_split(spark, skewed, capsys):
    validated = lines.validate_lines(skewed, given.products(spark, SMALL_DIR))
    expected = plain(orders.lines_of_valid_orders(validated))
    with settings(spark, MINIATURE):
        found = orders.lines_of_valid_orders(validated)
        assert "skew=true" in final_plan(found, capsys)
        assert plain(found) == expected


@pytest.mark.parametrize("group", [["product_id"], ["product_id", "batch_date"]])
def test_running_total_cuts_a_hot_group_and_equals_the_plain_window(spark, skewed, group, tmp_path):
    order = [c for c in ("batch_date", "order_id", "quantity", "row_id") if c not in group]
    rows = skewed.filter("quantity > 0").select("product_id", "batch_date", "order_id", "quantity", "row_id")
    copy = (F.col("product_id") == 49) & (F.col("order_id") == 7)
    rows = rows.withColumn("quantity", F.when(copy, F.lit(5)).otherwise(F.col("quantity")))
    window = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    expected = rows.withColumn("total", F.sum("quantity").over(window))
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}):
        found = running.running_total(rows, group, order, "quantity", "total")
        assert plain(found, *expected.columns) == plain(expected)
        ranged = rows.repartitionByRange(*group, *order).withColumn("block", F.spark_partition_id())
        copies = "product_id = 49 and order_id = 7 and quantity = 5"
        blocks = ranged.filter(copies).agg(F.count_distinct("block")).first()[0]
    assert blocks > 1


def test_running_balance_ends_at_the_updated_stock(spark, skewed):
    products = given.products(spark, SMALL_DIR)
    validated = lines.validate_lines(skewed, products).filter("final_quantity > 0")
    balance = inventory.running_inventory(products, validated, "opening_stock")
    last = balance.groupBy("product_id").agg(F.min("remaining_stock").alias("current_stock"))
    levels = inventory.update_inventory(products, validated, "opening_stock")
    assert plain(levels.join(last, "product_id", "left_semi"), "product_id", "current_stock") == plain(last)


def test_hot_day_is_written_as_several_files(spark, skewed, tmp_path):
    path = tmp_path / "lines"
    few = skewed.filter("batch_date <= date'1996-03-10' and batch_date >= date'1996-02-20'")
    with settings(spark, {**MINIATURE, "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}):
        write_batches(few, str(path))
    files = {p.name: len(list(p.glob("part-*"))) for p in path.iterdir() if p.is_dir()}
    assert files.pop("batch_date=1996-02-29") > 1
    assert set(files.values()) == {1}
    assert spark.read.parquet(str(path)).count() == few.count()


def test_quantity_filter_and_column_choice_reach_the_scan(spark, skewed, capsys):
    products = given.products(spark, SMALL_DIR)
    orders.valid_orders(lines.validate_lines(skewed, products)).explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull(quantity)]" in plan
    assert "ReadSchema: struct<order_id:bigint,product_id:bigint,quantity:int,batch_date:date>" in plan


def test_summary_reads_the_lines_once_and_broadcasts_only_by_size(spark, skewed, capsys):
    products = given.products(spark, SMALL_DIR)
    summary.daily_summary(lines.validate_lines(skewed, products)).explain()
    plan = capsys.readouterr().out
    assert plan.count("quantity#") and plan.count("FileScan") == 2 and "BroadcastHashJoin" in plan
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        summary.daily_summary(lines.validate_lines(skewed, products)).explain()
    assert "Broadcast" not in capsys.readouterr().out


def test_the_lines_scan_of_the_summary_reads_no_file_metadata(spark, capsys):
    QUERIES["daily_summary"](spark, SMALL_DIR).explain()
    assert "_metadata" not in capsys.readouterr().out


def test_documents_stay_bounded_and_hold_every_line(spark):
    documents = given.transactions(spark, SMALL_DIR)
    largest = documents.agg(F.max(F.size("items"))).first()[0]
    assert 0 < largest <= given.ROWS_PER_BLOCK
    columns = ["batch_date", "order_id", "customer_id", "product_id", "quantity"]
    exploded = lines.explode_items(documents)
    assert plain(exploded, *columns) == plain(given.lines(spark, SMALL_DIR), *columns)


@pytest.mark.parametrize("name", ["orders_distinct", "empty_batch_schema", "order_line_items", "order_line_items_clean"])
@pytest.mark.parametrize("broadcast", ["64m", "-1"])
def test_stored_headers_and_lines_are_read_instead_of_the_tables(spark, name, broadcast, capsys):
    """What is left to run reads no lineitem: it was read once, when headers or lines were stored."""
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": broadcast}):
        plan = final_plan(QUERIES[name](spark, SMALL_DIR), capsys)
    assert "lineitem" not in plan and "l_orderkey" not in plan


def test_exploded_lines_of_a_hot_order_have_identities(spark, capsys):
    """A document with very many equal items is sorted and summed by many tasks."""
    item = "named_struct('product_id', 1L, 'product_name', 'a', 'qty', 1)"
    documents = spark.range(40).selectExpr(
        "id as transaction_id", "1L as customer_id", "'2024-03-01T10:00:00.000000' as timestamp",
        f"transform(sequence(1, if(id = 7, 4000, 50)), n -> {item}) as items",
    )
    exploded = lines.explode_items(documents)
    assert exploded.select("row_id").distinct().count() == exploded.count() == 39 * 50 + 4000
    rows = exploded.select("product_id", "batch_date", "order_id", "quantity", "row_id")
    total = running.running_total(
        rows.repartition(8), ["product_id"], ["batch_date", "order_id", "quantity", "row_id"], "quantity", "so_far"
    )
    hot = total.filter("order_id = 7")
    assert hot.agg(F.max("so_far") - F.min("so_far")).first()[0] == 3999
    shares = rows.repartitionByRange(8, "product_id", "batch_date", "order_id", "quantity", "row_id")
    sizes = [r["count"] for r in shares.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.3 * sum(sizes)
