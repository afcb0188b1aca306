"""URL rules by a sorted sweep over canonical keys.

A rule holds for its host, all subdomains, and paths that start with its path. A host is read from
its last label to its first, so a rule's host is a prefix of every host it fits, and for each such
prefix of a url the rules of that host are intervals of paths: from the rule's path up to the path
followed by a byte that no text holds. Intervals of one host nest or are apart. The sweep goes
through paths in order and keeps the stack of open rules by its top: a rule's start puts the rule on
top, its end gives back the rule around it. A url's rule on that host is the top where it stands.

Urls of one host are dealt to cells, each of which gets all of the host's boundaries, so a host that
owns a third of the urls is swept by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.rows import ascii_lower

# The rules of the registered query, as (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
DEFAULT = "allow"
LEAST_IN_CELL = 64
#: What is known of the rules' hosts is broadcast while the rules take no more bytes than this.
BROADCAST_BYTES = 32 << 20
START, URL = 0, 1
CHUNK = 10_000  # copies of one row that are laid out at once


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    values = [F.struct(*(F.lit(v).alias(n) for v, n in zip(r, ("host", "path", "verdict")))) for r in rules]
    return spark.range(1).select(F.inline(F.array(*values)))


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def n_labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def host_prefixes(host: Column, most: int) -> Column:
    """The reversed hosts, of up to ``most`` labels, of a host and its parent domains."""
    labels = F.slice(F.reverse(F.split(host, r"\.")), 1, max(most, 1))
    sizes = F.sequence(F.lit(1), F.size(labels))
    return F.transform(sizes, lambda n: F.array_join(F.slice(labels, F.lit(1), n), "."))


def boundaries(rules: DataFrame) -> DataFrame:
    """Where the top of the stack changes: key, at, kind, top (length, rule, verdict, or null).

    Repeated rules count once; of two verdicts for one host and path, block wins. Rules with a null
    are left out.
    """
    path = F.encode("path", "utf-8")
    known = (
        rules.filter("host is not null and path is not null and verdict is not null")
        .groupBy(reversed_host(ascii_lower(F.col("host"))).alias("key"), "path")
        .agg(F.max("verdict").alias("verdict"), F.max("host").alias("host"))
    )
    rule = F.concat("host", "path")
    top = F.struct(F.length(rule).alias("length"), rule.alias("rule"), F.col("verdict"))
    own = known.select("key", "path", top.alias("top"))
    shorter = own.select("key", F.col("path").alias("around"), F.col("top").alias("outer"))
    # a path starts with another one of its host only at a length that some path of the host has
    sizes = own.select("key", F.length("path").alias("size")).distinct()
    starts = own.join(sizes, "key").filter(F.col("size") < F.length("path"))
    nested = (
        starts.select("key", "path", F.substring("path", F.lit(1), F.col("size")).alias("around"))
        .join(shorter, ["key", "around"])
        .groupBy("key", "path")
        .agg(F.max("outer").alias("outer"))
    )
    opened = own.select("key", path.alias("at"), F.lit(START).alias("kind"), "top")
    closed = own.join(nested, ["key", "path"], "left").select(
        "key", F.concat(path, F.lit(b"\xff")).alias("at"), F.lit(START).alias("kind"), F.col("outer").alias("top")
    )
    return opened.unionByName(closed)


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``; no other column is read.

    The longest rule that fits wins, by characters of host and path together. A url without rule gets
    ``default``. A null url, or one without ://, has an empty host and path, and fits only rules with
    an empty host. A very long host is looked up by no more labels than the longest rule has, and a very
    long path is one place. Empty tables of either kind are fine. Repeated rows are judged once and come back as often as they were given. Cells of
    a host hold about the square root of its urls, so neither the copies of boundaries nor the cells
    grow as the urls do.
    """
    urls = (
        pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .groupBy("page_id", "host", "path")
        .agg(F.count("*").alias("copies"))
    )
    marks = boundaries(rules)
    taken, labels = rules.agg(
        F.sum(F.octet_length(F.concat("host", "path")) + 64), F.max(n_labels(F.col("host")))
    ).first()
    taken = taken or 0
    few = taken <= BROADCAST_BYTES  # else a shuffled join, whose hot partitions Spark splits
    sized = F.broadcast if few else lambda df: df
    keyed = urls.select("*", F.explode(host_prefixes(F.col("host"), labels or 1)).alias("key"))
    fitting = keyed.join(sized(marks.select("key").distinct()), "key", "left_semi")
    per_host = fitting.groupBy("key").agg(F.count("*").alias("urls"))
    cells = per_host.join(marks.groupBy("key").agg(F.count("*").alias("marks")), "key").select(
        "key",
        F.ceil(F.col("urls") / F.greatest(F.sqrt("urls"), F.col("marks"), F.lit(LEAST_IN_CELL))).alias("cells"),
    )
    dealt = fitting.join(sized(cells), "key").select(
        "key", F.pmod(F.xxhash64("page_id", "host", "path"), F.col("cells")).alias("cell"),
        F.encode("path", "utf-8").alias("at"), F.lit(URL).alias("kind"),
        F.lit(None).cast("struct<length:int,rule:string,verdict:string>").alias("top"),
        F.struct("page_id", "host", "path").alias("url"),
    )
    swept = marks.join(cells, "key").select(
        "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)).alias("cell"),
        "at", "kind", "top",
        F.lit(None).cast(dealt.schema["url"].dataType).alias("url"),
    )
    sweep = Window.partitionBy("key", "cell").orderBy("at", "kind")
    # the last boundary at or before the url; a closed outermost rule leaves a mark without a top
    mark = F.when(F.col("kind") == START, F.struct("top"))
    open_rule = F.last(mark, ignorenulls=True).over(sweep.rowsBetween(Window.unboundedPreceding, 0))
    found = (
        dealt.unionByName(swept)
        .withColumn("open", open_rule["top"])
        .filter((F.col("kind") == URL) & F.col("open").isNotNull())
        .select("url.*", F.col("open").alias("top"), F.lit(0).cast("long").alias("copies"))
    )
    none = F.lit(None).cast("struct<length:int,rule:string,verdict:string>").alias("top")
    judged = (
        urls.select("page_id", "host", "path", none, "copies")
        .unionByName(found)
        .groupBy("page_id", "host", "path")
        .agg(F.max("top").alias("top"), F.sum("copies").alias("copies"))
    )
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / CHUNK))
    left = F.least(F.col("copies") - F.col("chunk") * CHUNK, F.lit(CHUNK)).cast("int")
    columns = ["page_id", "host", "path", "rule", "verdict"]
    return (
        judged.withColumn("rule", F.col("top.rule"))
        .withColumn("verdict", F.coalesce("top.verdict", F.lit(default)))
        .select(*columns, "copies", F.explode(chunks).alias("chunk"))
        .select(*columns, F.explode(F.array_repeat(F.lit(0), left)).alias("copy"))
        .drop("copy")
    )
