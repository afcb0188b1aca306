"""Random dirty documents, computed once by the operators and once by plain Python."""

import collections
import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from daybook import schemas
from daybook.operators import inventory, orders, summary
from daybook.operators.lines import explode_items, validate_lines
from tests.conftest import document, plain, product

CENT = Decimal("0.01")


def _round(value):
    return value.quantize(CENT, ROUND_HALF_UP)


def _order_days(documents):
    return {(dt.date.fromisoformat(moment[:10]), o) for o, _, moment, items in documents if items}


def frame_of(products, documents):
    return products.sparkSession.createDataFrame(documents, schemas.TRANSACTIONS)


@pytest.fixture(scope="module")
def case(spark, validate):
    rng = random.Random(3)
    catalogue = [
        product(i, price=f"{rng.randint(1, 5000) / 100:.2f}", cost=f"{rng.randint(1, 3000) / 100:.2f}",
                stock=rng.choice([None, 0, 3, 8, 40]))
        for i in range(1, 13)
    ]
    documents = []
    for _ in range(400):
        moment = dt.datetime(2024, 3, rng.randint(1, 9), rng.randint(0, 23), 5)
        items = [(rng.randint(1, 15), rng.choice([None, None, -2, 0, 1, 2, 5, 9])) for _ in range(rng.randint(0, 4))]
        documents.append(document(rng.randint(1, 150), *items, moment=moment.isoformat(timespec="microseconds")))
    # One order per day and id: the moment of the first document holds for all of them.
    seen = {}
    documents = [
        (o, c, seen.setdefault((o, moment[:10]), moment), items) for o, c, moment, items in documents
    ]
    frame = spark.createDataFrame(catalogue, schemas.PRODUCTS)
    return catalogue, documents, frame, validate(*documents, catalogue=frame).cache()


def _lines(catalogue, documents):
    known = {row[0]: row for row in catalogue}
    for order_id, _, moment, items in documents:
        for product_id, _, quantity in items:
            if quantity is None:
                continue
            row = known.get(product_id)
            price, cost, stock = row[5:] if row else (None, None, None)
            kept = quantity if stock is not None and quantity <= stock else None
            yield dt.date.fromisoformat(moment[:10]), order_id, product_id, kept, price, cost


def test_everything_against_plain_python(case):
    catalogue, documents, products, validated = case
    lines = list(_lines(catalogue, documents))

    units = collections.Counter()
    for date, order_id, _, kept, *_ in lines:
        units[date, order_id] += kept or 0
    valid = {key for key, total in units.items() if total > 0}
    assert plain(orders.valid_orders(validated), "batch_date", "order_id") == sorted(valid)
    cancelled = sorted(key for key, total in units.items() if total == 0)
    assert plain(orders.cancelled_orders(validated), "batch_date", "order_id") == cancelled
    everything = {key: units.get(key, 0) for key in _order_days(documents)}
    every_line = validate_lines(explode_items(frame_of(products, documents)), products, all_lines=True)
    gone = sorted(key for key, total in everything.items() if total == 0)
    assert plain(orders.cancelled_orders(every_line), "batch_date", "order_id") == gone and len(gone) > len(cancelled)

    days = collections.defaultdict(lambda: [Decimal(0), Decimal(0)])
    for date, order_id, _, kept, price, cost in lines:
        if (date, order_id) in valid and kept and kept > 0:
            days[date][0] += _round(kept * price)
            days[date][1] += _round((price - cost) * kept)
    counted = collections.Counter(date for date, _ in valid)
    expected = sorted((date, counted[date], *amounts) for date, amounts in days.items())
    assert plain(summary.daily_summary(validated)) == expected

    headers = orders.order_headers(validated)
    assert plain(summary.summarise(orders.header_totals(headers))) == expected
    assert plain(orders.orders_of_headers(headers)) == plain(orders.orders_of(validated))

    trading = {date for date, _ in valid}
    items = collections.Counter(
        (date, order_id, product_id, kept) for date, order_id, product_id, kept, *_ in lines if date in trading
    )
    found = orders.items_of(validated).select("batch_date", "order_id", "product_id", "quantity").collect()
    assert collections.Counter(map(tuple, found)) == items

    sold = collections.Counter()
    for _, _, product_id, kept, *_ in lines:
        sold[product_id] += kept or 0
    left = {row[0]: None if row[7] is None else max(row[7] - sold[row[0]], 0) for row in catalogue}
    levels = inventory.update_inventory(products, validated).collect()
    assert {row["product_id"]: row["current_stock"] for row in levels} == left

    assert valid and cancelled and len(days) == 9 and None in left.values() and 0 in left.values()


@pytest.mark.parametrize("reload_daily", [False, True])
def test_running_balance_against_plain_python(case, reload_daily):
    catalogue, documents, products, validated = case
    stock = {row[0]: row[7] for row in catalogue}
    rows = sorted((p, date, o, kept) for date, o, p, kept, *_ in _lines(catalogue, documents) if kept and kept > 0)
    demand, expected = collections.Counter(), []
    for product_id, date, order_id, kept in rows:
        key = (product_id, date) if reload_daily else product_id
        demand[key] += kept
        expected.append((product_id, date, order_id, kept, demand[key], max(stock[product_id] - demand[key], 0)))
    found = inventory.running_inventory(products, validated, reload_daily=reload_daily)
    columns = ["product_id", "batch_date", "order_id", "quantity", "ordered_so_far", "remaining_stock"]
    assert plain(found, *columns) == sorted(expected)
