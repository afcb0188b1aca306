"""Every registered query against its SQL, and sums that must agree between queries."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import differences, duck
from tests.settings import SMALL_DIR, SQL_DIR

ROOT = os.path.dirname(os.path.abspath(entry.__file__))
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SQL_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SQL_DIR), connection, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_whole_rows(spark, name):
    rows = QUERIES[name](spark, SMALL_DIR).collect()
    assert rows and all(value is not None for row in rows for value in row)


def test_entry_is_the_daily_summary(spark):
    assert entry.entry(spark).columns == ["date", "num_orders", "total_sales", "total_profit"]


def test_order_counts_agree_between_queries(spark):
    run = {name: QUERIES[name](spark, SMALL_DIR) for name in ("daily_summary", "valid_orders_having", "orders_distinct")}
    counted = run["daily_summary"].agg(F.sum("num_orders")).first()[0]
    assert counted == run["valid_orders_having"].count() == run["orders_distinct"].count()


def test_stock_stays_between_zero_and_the_start_without_negative_sales(spark):
    balance = QUERIES["running_inventory"](spark, SMALL_DIR)
    assert balance.filter("remaining_stock < 0 or remaining_stock > 499").isEmpty()


def test_python_workers_need_no_copy_of_the_package(tmp_path):
    """Another working folder and no PYTHONPATH, as on executors."""
    script = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as entry
from daybook.session import local_session
spark = local_session(2, "2g")
print("rows", entry.queries()["forecast_seasonal_multi"](spark, {SMALL_DIR!r}).count())
"""
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300
    )
    assert "rows 35" in done.stdout, done.stderr[-2000:]
