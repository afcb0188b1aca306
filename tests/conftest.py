import datetime as dt
from decimal import Decimal

import pytest

from daybook import schemas
from daybook.operators.lines import explode_items, validate_lines, with_amounts
from daybook.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "4g")
    yield session
    session.stop()


def product(product_id, price="2.50", cost="1.00", stock=10):
    amounts = [None if a is None else Decimal(a) for a in (price, cost)]
    return (product_id, f"item {product_id}", "cat", "sub", "round", *amounts, stock)


def document(order_id, *items, moment="2024-03-01T09:30:00.000001", customer=1):
    """An order document; items are (product_id, quantity) pairs, None for no items at all."""
    nested = None if items == (None,) else [(p, f"item {p}", q) for p, q in items]
    return (order_id, customer, moment, nested)


@pytest.fixture(scope="session")
def products(spark):
    rows = [
        product(1),
        product(2, price="0.99", cost="0.45", stock=5),
        product(3, price="10.00", cost="4.00", stock=100),
        product(4, stock=None),
        product(5, price=None),
    ]
    return spark.createDataFrame(rows, schemas.PRODUCTS)


@pytest.fixture(scope="session")
def validate(spark, products):
    def run(*documents, catalogue=products):
        nested = spark.createDataFrame(list(documents), schemas.TRANSACTIONS)
        return with_amounts(validate_lines(explode_items(nested), catalogue))

    return run


def day(text):
    return dt.date.fromisoformat(text)


def plain(df, *columns):
    """Rows as a sorted list of tuples, nulls first."""
    rows = [tuple(row) for row in df.select(*(columns or df.columns)).collect()]
    return sorted(rows, key=lambda row: [(value is not None, value) for value in row])


