"""Lookups that take little room in Parquet and much in the driver are not broadcast."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from daybook.plans import driver_tables as given
from daybook.plans.queries import QUERIES
from daybook.session import tune

CATALOGUE = re.compile(r"p_partkey|sales_price")
FOUND = [
    "src_variant_documents",
    "batch_run_stock",
    "batch_run_dated_catalogue",
    "batch_run_orders",
    "batch_run_summary",
    "batch_run_written",
    "validate_running_stock_daily_reload",
    "src_flat_documents",
    "batch_run",
]


def _tables(spark, path, parts):
    """Three days of orders with three lines each, and a catalogue whose names do not compress."""
    name = F.concat(*(F.sha2(F.concat("id", F.lit(n)), 512) for n in range(3)))
    spark.range(parts).select(
        F.col("id").alias("p_partkey"), name.alias("p_name"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"),
        F.lit(30).alias("p_size"), (F.col("id") % 90 + 10.0).alias("p_retailprice"),
    ).coalesce(1).write.parquet(f"{path}/part.parquet")
    orders = [(n, n % 5, dt.datetime(1996, 1, 1 + n % 3, 9)) for n in range(30)]
    spark.createDataFrame(orders, given.COLUMNS["orders"]).coalesce(1).write.parquet(f"{path}/orders.parquet")
    lines = [(n % 30, n * 7 % parts, 1 + n // 30, 1.0 + n % 40, "N") for n in range(90)]
    spark.createDataFrame(lines, given.COLUMNS["lineitem"]).coalesce(1).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    return _tables(spark, tmp_path_factory.mktemp("parts"), 60_000)


@pytest.fixture
def written(monkeypatch):
    """The plans of all that is written, as they were before it ran."""
    plans = []

    def recording(write):
        def recorded(self, *args, **options):
            plans.append(self._df._jdf.queryExecution().executedPlan())
            return write(self, *args, **options)

        return recorded

    for name in ("parquet", "json", "text", "csv", "save"):
        monkeypatch.setattr(DataFrameWriter, name, recording(getattr(DataFrameWriter, name)))
    return plans


def _broadcasts(plans):
    found, waiting = [], list(plans)
    while waiting:
        node = waiting.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            waiting.append(node.initialPlan())
        elif node.nodeName() == "BroadcastExchange":
            found.append(node.toString())
        waiting += [node.children().apply(n) for n in range(node.children().size())]
    return found


@pytest.mark.parametrize("name", FOUND)
def test_a_large_catalogue_is_not_broadcast(spark, large, written, name):
    tune(spark)
    found = QUERIES[name](spark, large)
    plans = [*written, found._jdf.queryExecution().executedPlan()]
    assert not [x for x in _broadcasts(plans) if CATALOGUE.search(x) and "Join" not in x]
