"""Results of a run that appear all at once.

A run writes every result into folders of its own and then publishes a manifest, a small file that says
for each table which run holds which day. Publishing is one rename, and readers go by the last manifest,
so whatever a run was doing when it stopped, they see all results of one run or all of the one before.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.schemas import CSV_OPTIONS
from daybook.session import Scratch, remove
from daybook.sinks.tables import MONTH, stored_parts, write_batches, write_csv

MANIFESTS = "_editions"
ALL = "all"  # the part of a table that is written as a whole

Parts = dict[str, dict[str, str]]


def _hadoop(spark: SparkSession, path: str):
    """A path and its file system."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def published(spark: SparkSession, out: str) -> list[int]:
    """The numbers of the editions under ``out``, in order."""
    folder, files = _hadoop(spark, f"{out}/{MANIFESTS}")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.removesuffix(".json").isdigit())


def parts_of(spark: SparkSession, out: str, number: int | None = None) -> Parts:
    """For each table its days (or months, or all) and the run that holds each, in the last edition."""
    numbers = published(spark, out)
    if number is None and not numbers:
        return {}
    path, files = _hadoop(spark, f"{out}/{MANIFESTS}/{numbers[-1] if number is None else number}.json")
    stream = files.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _read(spark: SparkSession, out: str, parts: Parts, name: str, schema: T.StructType, by: str | None, fmt: str) -> DataFrame:
    held = parts.get(name, {})
    if not held:
        return spark.createDataFrame([], schema)
    folders = [f"{out}/{name}/run={run}" + (f"/{by}={part}" if by else "") for part, run in sorted(held.items())]
    reader = spark.read.schema(schema).option("basePath", f"{out}/{name}")
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS).option("multiLine", True)
    return reader.format(fmt).load(folders).select(*schema.fieldNames())


def read_table(
    spark: SparkSession, out: str, name: str, schema: T.StructType, by: str | None = None, fmt: str = "parquet",
    number: int | None = None,
) -> DataFrame:
    """A table of the last edition, or of the one with ``number``. ``by`` names the column of its folders."""
    return _read(spark, out.rstrip("/"), parts_of(spark, out.rstrip("/"), number), name, schema, by, fmt)


class Edition:
    """The results of one run, unseen until :meth:`publish`."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out, self.run = spark, out.rstrip("/"), uuid.uuid4().hex
        numbers = published(spark, self.out)
        self.number = numbers[-1] + 1 if numbers else 1
        self.parts: Parts = parts_of(spark, self.out) if numbers else {}
        self._seen: dict[str, tuple[Observation, int]] = {}

    def _folder(self, name: str) -> str:
        return f"{self.out}/{name}/run={self.run}"

    def _observed(self, name: str, df: DataFrame) -> DataFrame:
        """``df``, the rows of which are counted while they are written."""
        cancelled = F.count_if(F.col("quantity").isNull()) if "quantity" in df.columns else F.lit(0)
        if "cancelled" in df.columns:
            cancelled = F.sum("cancelled")
        seen = Observation()
        self._seen[name] = seen, 0
        return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.coalesce(cancelled, F.lit(0)).cast("bigint").alias("n"))

    def _replaced(self, name: str, column: str, inside) -> None:
        """Takes the parts that were written, and drops those inside the range that were not."""
        new = stored_parts(self.spark, self._folder(name), column)
        kept = {part: run for part, run in self.parts.get(name, {}).items() if not inside(part)}
        self.parts[name] = kept | dict.fromkeys(new, self.run)
        self._seen[name] = self._seen[name][0], len(new)

    def write_days(
        self, name: str, df: DataFrame, first: dt.date, last: dt.date, fmt: str = "parquet", order: Sequence[str] = ()
    ) -> None:
        """Replaces all days from ``first`` to ``last``; ``df`` is computed once."""
        write_batches(self._observed(name, df), self._folder(name), fmt, order)
        self._replaced(name, "batch_date", lambda day: first.isoformat() <= day <= last.isoformat())

    def write_days_in_months(self, name: str, df: DataFrame, first: dt.date, last: dt.date, scratch: Scratch) -> None:
        """The same for a table of few rows a day, stored by month: the other days of the first and the last
        month are read from the edition before and written again."""
        months = f"{first:%Y-%m}", f"{last:%Y-%m}"
        rows = scratch.store(self._observed(name, df), "months")
        old = {name: {m: run for m, run in self.parts.get(name, {}).items() if m in months}}
        if old[name]:
            bounds = F.lit(first.isoformat()).cast("date"), F.lit(last.isoformat()).cast("date")
            kept = _read(self.spark, self.out, old, name, df.schema, MONTH, "parquet")
            rows = rows.unionByName(kept.filter(~F.col("batch_date").between(*bounds)))
        month = F.date_format("batch_date", "yyyy-MM").alias(MONTH)
        rows.select("*", month).hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(self._folder(name))
        self._replaced(name, MONTH, lambda value: months[0] <= value <= months[1])

    def write_whole(self, name: str, df: DataFrame, single_file: bool = False) -> None:
        """Replaces a whole table, stored as CSV."""
        write_csv(self._observed(name, df), self._folder(name), single_file)
        self.parts[name] = {ALL: self.run}

    def read(self, name: str, schema: T.StructType, by: str | None = None, fmt: str = "parquet") -> DataFrame:
        """A table as it will be published."""
        return _read(self.spark, self.out, self.parts, name, schema, by, fmt)

    def written(self) -> DataFrame:
        """table_name, n_rows, n_parts (days or months) and n_cancelled of all that this run wrote, as
        counted by the writes: no job runs for it."""
        rows = [(name, seen.get["n_rows"], parts, seen.get["n"]) for name, (seen, parts) in self._seen.items()]
        return self.spark.createDataFrame(rows, "table_name string, n_rows long, n_parts int, n_cancelled long")

    def publish(self) -> None:
        """Makes all that was written the current results, in one rename."""
        draft, files = _hadoop(self.spark, f"{self.out}/{MANIFESTS}/draft-{self.run}")
        final, _ = _hadoop(self.spark, f"{self.out}/{MANIFESTS}/{self.number}.json")
        stream = files.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(self.parts, sort_keys=True).encode("utf-8")))
        finally:
            stream.close()
        if files.exists(final) or not files.rename(draft, final):
            files.delete(draft, False)
            raise RuntimeError(f"edition {self.number} of {self.out} was published by another run")


def prune(spark: SparkSession, out: str, keep: int = 2) -> None:
    """Removes what no one of the last ``keep`` editions refers to. No run may be writing meanwhile."""
    out, numbers = out.rstrip("/"), published(spark, out.rstrip("/"))
    live: dict[str, set[str]] = {}
    for number in numbers[-keep:]:
        for name, held in parts_of(spark, out, number).items():
            live.setdefault(name, set()).update(held.values())
    tables = {name for number in numbers for name in parts_of(spark, out, number)}
    for name in tables:
        for run, folder in stored_parts(spark, f"{out}/{name}", "run").items():
            if run not in live.get(name, set()):
                remove(spark, folder)
    for number in numbers[:-keep]:
        remove(spark, f"{out}/{MANIFESTS}/{number}.json")
