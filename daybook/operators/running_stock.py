"""Lines checked against what earlier lines have left: stock that runs out.

Whether a line is filled depends on which lines before it were, so no prefix sum gives it. A product's
lines are cut into consecutive blocks. What a block makes of the stock it starts with is a function, and
a step function at that: stock minus a number of units that is the same for ranges of stocks. Each block
of a product with several finds its function on its own; the functions are applied one after the other,
one row a block, which gives every block its stock to start with; then all blocks fill their lines at
the same time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.lines import requested, tie_break, with_line_amounts
from daybook.operators.running import BLOCK, in_blocks
from daybook.session import materialise

#: Steps of a function; a block that needs more is handed on as several functions.
MOST_STEPS = 4096
STOCK, START, FILLED = "stock_of_product", "stock_of_block", "filled"


class Steps:
    """Stock after some lines for any stock before them, between two bounds."""

    def __init__(self, least: int, most: int):
        self.least, self.most = least, most
        self.starts, self.taken = np.array([least], np.int64), np.zeros(1, np.int64)

    def add(self, quantity: int) -> None:
        """One more line, which is filled wherever that much is left."""
        ends = np.r_[self.starts[1:] - 1, self.most]
        least_left, most_left = self.starts - self.taken, ends - self.taken
        whole = least_left >= quantity
        split = ~whole & (most_left >= quantity)
        if split.any():
            at = np.flatnonzero(split)
            self.starts = np.insert(self.starts, at + 1, self.taken[at] + quantity)
            self.taken = np.insert(self.taken, at + 1, self.taken[at])
            whole = np.insert(whole, at + 1, True)
        self.taken = self.taken + np.where(whole, quantity, 0)
        if len(self.taken) > 1:
            new = np.r_[True, self.taken[1:] != self.taken[:-1]]
            self.starts, self.taken = self.starts[new], self.taken[new]

    def after(self, stock: int) -> int:
        return stock - int(self.taken[np.searchsorted(self.starts, stock, "right") - 1])


def _runs(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, int, int]]:
    """Consecutive rows of a batch with equal keys: the keys, the first row and the one after the last."""
    columns = [batch.column(k).to_pylist() for k in keys]
    first = 0
    for n in range(1, batch.num_rows + 1):
        if n == batch.num_rows or any(c[n] != c[first] for c in columns):
            yield tuple(c[first] for c in columns), first, n
            first = n


def _functions(blocks: DataFrame, group: list[str], order: list[str], most_steps: int) -> DataFrame:
    """group, block, stock_of_product, part, starts, taken: the function of each block, in as many parts as
    it needs."""
    kinds = [f for f in blocks.schema if f.name in (*group, BLOCK)]
    kind = T.StructType([
        *(T.StructField(f.name, f.dataType) for f in sorted(kinds, key=lambda f: [*group, BLOCK].index(f.name))),
        T.StructField(STOCK, T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("taken", T.ArrayType(T.LongType())),
    ])
    keys = [*group, BLOCK]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, steps, part, types = None, None, None, 0, None

        def row() -> pa.RecordBatch:
            values = [pa.array([v], types.field(k).type) for k, v in zip(keys, at)]
            values += [pa.array([own], pa.int64()), pa.array([part], pa.int32())]
            values += [pa.array([v.tolist()], pa.list_(pa.int64())) for v in (steps.starts, steps.taken)]
            return pa.RecordBatch.from_arrays(values, [*keys, STOCK, "part", "starts", "taken"])

        for batch in batches:
            types = batch.schema
            quantities = batch.column("quantity").cast(pa.int64()).to_numpy()
            for key, first, last in _runs(batch, keys):
                if key != at:
                    if at is not None:
                        yield row()
                    least, most, own = (batch.column(n)[first].as_py() for n in ("least_stock", "most_stock", STOCK))
                    at, steps, part = key, Steps(least, most), 0
                for quantity in quantities[first:last].tolist():
                    if len(steps.starts) > most_steps:
                        yield row()
                        steps, part = Steps(steps.least, steps.most), part + 1
                    if quantity <= steps.most:  # more is never left
                        steps.add(quantity)
        if at is not None:
            yield row()

    rows = blocks.select(*keys, *(c for c in order if c not in keys and c != "quantity"), "quantity", STOCK, "least_stock", "most_stock")
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(found, kind)


def _starts(functions: DataFrame, group: list[str]) -> DataFrame:
    """group, block, stock_of_block: the stock that each block starts with, functions applied in order.

    A product has a row for each of its blocks, of a bounded number of steps; they are read in a stream.
    """
    keys = [*group, BLOCK]
    kind = T.StructType([*(functions.schema[k] for k in keys), T.StructField(START, T.LongType())])

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, stock, block = None, 0, None
        for batch in batches:
            rows: list[tuple] = []
            columns = [batch.column(k).to_pylist() for k in (*keys, STOCK)]
            starts, taken = batch.column("starts"), batch.column("taken")
            for n, (*key, own) in enumerate(zip(*columns)):
                if key[:-1] != of:
                    of, stock, block = key[:-1], own, None
                if key[-1] != block:
                    block = key[-1]
                    rows.append((*key, stock))
                at = np.searchsorted(starts[n].values.to_numpy(), stock, "right") - 1
                stock -= taken[n].values[int(at)].as_py()
            arrays = [pa.array([r[i] for r in rows], batch.schema.field(k).type) for i, k in enumerate(keys)]
            arrays.append(pa.array([r[-1] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, [*keys, START])

    return functions.repartition(*group).sortWithinPartitions(*keys, "part").mapInArrow(applied, kind)


def _filled(blocks: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Adds ``filled``, whether what the lines before have left covers the line."""
    keys = [*group, BLOCK]
    kind = T.StructType([*blocks.schema.fields, T.StructField(FILLED, T.BooleanType())])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, left = None, 0
        for batch in batches:
            quantities = batch.column("quantity").to_pylist()
            said = []
            for key, first, last in _runs(batch, keys):
                if key != at:
                    at, left = key, batch.column(START)[first].as_py()
                for quantity in quantities[first:last]:
                    covered = quantity <= left
                    said.append(covered)
                    if covered:
                        left -= quantity
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(said, pa.bool_())], [*batch.schema.names, FILLED]
            )

    return blocks.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(fill, kind)


def line_order(lines: DataFrame) -> list[str]:
    """Days, then times and ids of orders, then small quantities first; row ids tell equal lines apart."""
    return ["batch_date", *(["order_datetime"] if "order_datetime" in lines.columns else []), "order_id", "quantity",
            *tie_break(lines)]


def with_filled(
    lines: DataFrame, products: DataFrame, stock: str = "stock", reload_daily: bool = False, most_steps: int = MOST_STEPS
) -> DataFrame:
    """Lines that ask for a quantity, with ``filled``: whether earlier filled lines left enough for it.

    A line of an unknown product, or of one without stock, is not filled. A return (a negative quantity)
    is filled like any line that stock covers and adds to it. ``reload_daily`` starts every day from the
    full stock. However many lines a product has, they are spread over blocks, in order.
    """
    group = ["product_id", "batch_date"] if reload_daily else ["product_id"]
    asked = requested(lines)
    catalogue = products.select("product_id", F.col(stock).cast("bigint").alias(STOCK)).filter(f"{STOCK} IS NOT NULL")
    order = [c for c in line_order(lines) if c not in group]
    known = asked.join(catalogue, "product_id")
    blocks = in_blocks(known, group, order)
    spans = blocks.groupBy(*group, BLOCK).agg(
        F.sum(F.when(F.col("quantity") < 0, -F.col("quantity")).otherwise(0)).cast("bigint").alias("returned"),
        F.first(STOCK).alias(STOCK),
    )
    of_group = materialise(
        spans.groupBy(*group).agg(
            F.min(BLOCK).alias("first_block"), F.max(BLOCK).alias("last_block"), F.first(STOCK).alias(STOCK),
            F.sum("returned").alias("returned"),
        ),
        "stock-of-groups",
    )
    several = of_group.filter("first_block < last_block").withColumns(
        {
            # nothing is filled below zero, and no more is ever there than stock and all returns
            "least_stock": F.least(F.col(STOCK), F.lit(0)),
            "most_stock": F.greatest(F.col(STOCK), F.lit(0)) + F.col("returned"),
        }
    )
    same = _same(group)
    of = several.select(*(F.col(c).alias(f"of_{c}") for c in group), "least_stock", "most_stock")
    functions = materialise(
        _functions(blocks.join(of, same).drop(*(f"of_{c}" for c in group)), group, order, most_steps), "functions"
    )
    starts = _starts(functions, group)
    single = of_group.filter("first_block = last_block").select(
        *group, F.col("first_block").alias(BLOCK), F.col(STOCK).alias(START)
    )
    starts = materialise(starts.unionByName(single), "stock-of-blocks")
    begun = starts.select(*(F.col(c).alias(f"of_{c}") for c in (*group, BLOCK)), START)
    placed = blocks.join(begun, _same([*group, BLOCK])).drop(*(f"of_{c}" for c in (*group, BLOCK)), STOCK)
    checked = _filled(placed, group, order).drop(BLOCK, START)
    unknown = asked.join(catalogue, "product_id", "left_anti").withColumn(FILLED, F.lit(False))
    return checked.unionByName(unknown)


def _same(names: list[str]) -> Column:
    same = F.lit(True)
    for name in names:  # a day may be missing
        same = same & F.col(name).eqNullSafe(F.col(f"of_{name}"))
    return same


def validate_running_stock(
    lines: DataFrame, products: DataFrame, stock: str = "stock", reload_daily: bool = False
) -> DataFrame:
    """The same columns as :func:`daybook.operators.lines.validate_lines`, each line checked against what
    the filled lines before it have left of the product's stock."""
    checked = with_filled(lines, products, stock, reload_daily)
    return with_line_amounts(checked, products, F.col(FILLED)).drop(FILLED)
