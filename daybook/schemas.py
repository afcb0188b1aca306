"""Explicit schemas for every table the library reads or writes."""

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
TOTAL = T.DecimalType(18, 2)

# Optional column that tells equal rows apart, so that sorts and running totals can spread them.
ROW_ID = "row_id"

# Fixed value: how order timestamps are written as text.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# How CSV is written and read: header line, doubled quotes inside quoted fields, white space kept,
# and a mark for null, so that an empty text comes back empty.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "timestampNTZFormat": ISO_MICROS,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\\N",
}


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


CUSTOMERS = _struct(
    customer_id=T.LongType(),
    first_name=T.StringType(),
    last_name=T.StringType(),
    email=T.StringType(),
    address=T.StringType(),
    phone=T.StringType(),
)

PRODUCTS = _struct(
    product_id=T.LongType(),
    product_name=T.StringType(),
    product_category=T.StringType(),
    product_subcategory=T.StringType(),
    product_shape=T.StringType(),
    sales_price=MONEY,
    cost_to_make=MONEY,
    stock=T.IntegerType(),
)

ITEM = _struct(product_id=T.LongType(), product_name=T.StringType(), qty=T.IntegerType())

TRANSACTIONS = _struct(
    transaction_id=T.LongType(),
    customer_id=T.LongType(),
    timestamp=T.StringType(),
    items=T.ArrayType(ITEM),
)

ORDERS = _struct(
    batch_date=T.DateType(),
    order_id=T.LongType(),
    customer_id=T.LongType(),
    order_datetime=T.TimestampNTZType(),
)

ORDER_LINE_ITEMS = _struct(
    batch_date=T.DateType(),
    order_id=T.LongType(),
    product_id=T.LongType(),
    quantity=T.IntegerType(),
    unit_price=MONEY,
    line_total=TOTAL,
)

DAILY_SUMMARY = _struct(
    date=T.DateType(), num_orders=T.LongType(), total_sales=TOTAL, total_profit=TOTAL
)

STOCK_LEVELS = _struct(
    product_id=T.LongType(), product_name=T.StringType(), current_stock=T.LongType()
)

FORECAST = _struct(
    date=T.DateType(), forecasted_sales=T.DoubleType(), forecasted_profit=T.DoubleType()
)

FORECAST_METRICS = _struct(series_key=T.StringType(), mae=T.DoubleType(), mse=T.DoubleType())

SUMMARY_BY_DAY = _struct(
    batch_date=T.DateType(),
    date=T.DateType(),
    num_orders=T.LongType(),
    sales=T.LongType(),
    profit=T.LongType(),
    cancelled=T.LongType(),
)

UNITS_BY_DAY = _struct(batch_date=T.DateType(), product_id=T.LongType(), units=T.LongType())
