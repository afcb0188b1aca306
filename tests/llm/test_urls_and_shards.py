import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.llm import sharding, url_rules
from tests.llm import inputs

PAGES = "page_id bigint, url string, html string"


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    stop = min((path.find(c) for c in "?#" if c in path), default=len(path))
    return host, path[:stop]


def brute(urls, rules, default="allow"):
    out = []
    for page, url in urls:
        host, path = plain_parts(url)
        fits = [
            (len(h) + len(p), h + p, v)
            for h, p, v in rules
            if None not in (h, p, v) and (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        best = max(fits, default=(0, None, default))
        out.append((page, host, path, best[1], best[2]))
    return sorted(out, key=repr)


URLS = [
    "https://www.example.com/en/a", "http://EXAMPLE.com/en/", "https://example.com/en", "https://a.b.example.com/de",
    "https://example.net/es/x?y=/en/", "https://net/fr/#top", "https://x.net", "//net/es/", "no url", "", None,
    "ftp://com/", "https://notexample.com/en/1", "https://Com", "https://com?/", "https://www.example.com/en/a://b/",
    "https://é.example.com/en/ü", "a://b\nc.com/x\ny", "https://com./", "https://.com/", "https://www.example.com/en/a",
]


@pytest.mark.parametrize("few", [True, False])
def test_registered_rules_equal_brute_force(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(url_rules, "BROADCAST_BYTES", 0)
    urls = [(n, u) for n, u in enumerate(URLS)] + [(0, URLS[0]), (None, URLS[0]), (None, None), (0, URLS[1])]
    pages = spark.createDataFrame([(p, u, "<p>") for p, u in urls], PAGES)
    judged = url_rules.judge(inputs.clashing(pages, "key", "host", "rule"), url_rules.rules_table(spark, url_rules.RULES))
    assert inputs.bag(judged) == brute(urls, url_rules.RULES)


def test_very_long_hosts_and_paths(spark):
    """A host of 50,000 labels is looked up by as many labels as a rule has; nested paths may be long."""
    long = "a." * 50_000
    urls = [(1, f"http://{long}www.example.com/en/x"), (2, f"http://{long}net/es/" + "y/" * 50_000), (3, "http://" + long)]
    pages = spark.createDataFrame([(p, u, "<p>") for p, u in urls], PAGES)
    deep = [("net", "/es/" + "y/" * n, "allow") for n in (1, 20, 10_000, 49_999, 60_000)]
    for rules in (url_rules.RULES, url_rules.RULES + deep):
        table = spark.createDataFrame(rules, "host string, path string, verdict string")
        assert inputs.bag(url_rules.judge(pages, table)) == brute(urls, rules)
    assert pages.select(F.size(url_rules.host_prefixes(url_rules.host_of(F.col("url")), 3)).alias("n")).agg(F.max("n")).first()[0] == 3


def test_deeply_nested_rules(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "LEAST_IN_CELL", 5)
    pick = random.Random(2)
    hosts = ["com", "a.com", "b.a.com", "", "org"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/a/b/c", "/ab", "/a/é", "/b", "/b\U0010ffff"]
    rules = list({(h, p): (h, p, pick.choice(["allow", "block"])) for h in hosts for p in paths if pick.random() < 0.7}.values())
    urls = []
    for n in range(300):
        host = pick.choice(["", "x.", "b.a.", "a."]) + pick.choice(hosts)
        urls.append((n, f"https://{host}{pick.choice(paths)}{pick.choice(['', 'b', '/', '/b/c', 'é', '?q'])}"))
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("com", None, "block"), ("com", "/", None)],
                                  "host string, path string, verdict string")
    judged = url_rules.judge(spark.createDataFrame([(n, u, None) for n, u in urls], PAGES), table)
    found = {r.page_id: (r.rule, r.verdict) for r in judged.collect()}
    for page, host, path, rule, verdict in brute(urls, rules):
        assert (found[page][0] is None) == (rule is None), (host, path)
        assert rule is None or len(found[page][0]) == len(rule), (host, path, found[page], rule)
        if rule == found[page][0]:
            assert found[page][1] == verdict
    assert len({v for v in found.values()}) > 10


def test_many_equal_rows_come_back(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "CHUNK", 7)
    pages = spark.range(50).selectExpr("cast(null as bigint) page_id", "'http://a.net/es/' url", "'' html")
    judged = url_rules.judge(pages, url_rules.rules_table(spark, url_rules.RULES)).collect()
    assert len(judged) == 50 and set(judged) == {(None, "a.net", "/es/", "net/es/", "block")}


def test_two_verdicts_for_one_rule_block(spark):
    rules = [("com", "/", "allow"), ("com", "/", "block"), ("COM", "/", "allow")]
    pages = spark.createDataFrame([(1, "http://com/", None)], PAGES)
    judged = url_rules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).first()
    assert judged.verdict == "block"


def test_no_pages_and_no_rules(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, URLS[0], None), (2, None, None)], PAGES)
    assert inputs.bag(url_rules.judge(pages, none)) == brute([(1, URLS[0]), (2, None)], [])
    assert url_rules.judge(pages.limit(0), url_rules.rules_table(spark, url_rules.RULES)).collect() == []


def plain_table(shards, slots):
    """Every shard's whole permutation, and turns over them."""
    number = lambda name, why: int.from_bytes(hashlib.md5(f"{why}:{name}".encode()).digest()[:8], "big")
    orders = [
        iter([(number(s, "start") + k * (number(s, "step") % (slots - 1) + 1)) % slots for k in range(slots)]) for s in shards
    ]
    owner = {}
    while len(owner) < slots:
        for n, order in enumerate(orders):
            if len(owner) < slots:
                owner[next(slot for slot in order if slot not in owner)] = n
    return [owner[k] for k in range(slots)]


def test_lookup_table_equals_turns_over_permutations():
    shards = [f"s{k}" for k in range(7)]
    table = sharding.lookup_table(shards, 101)
    assert table == plain_table(shards, 101)
    assert set(Counter(table).values()) == {14, 15}
    assert sharding.lookup_table(["only"], 2) == [0, 0]


def test_few_slots_move_when_a_shard_goes():
    shards = [f"s{k}" for k in range(20)]
    before, after = sharding.lookup_table(shards, 1009), sharding.lookup_table(shards[:-1], 1009)
    moved = sum(b != a for b, a in zip(before, after) if b != 19)
    assert moved < 0.25 * 1009


@pytest.mark.parametrize("shards, slots", [(["a"], 100), ([], 101), (["a", "a"], 101), (["a", "b", "c"], 2), (["a"], 2**21 + 17)])
def test_bad_tables_are_refused(shards, slots):
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, slots)


def test_every_row_finds_its_shard(spark, edge, empty):
    shards = ["x", "y", "z"]
    df = inputs.clashing(edge, "slot", "Shard", "row")
    placed = sharding.shard(df, shards, 101)
    assert placed.columns == [*edge.columns, "row", "slot", "shard"]
    table = sharding.lookup_table(shards, 101)
    rows = placed.collect()
    assert len(rows) == edge.count() and all(r.shard == shards[table[r.slot]] for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id if r.doc_id is not None else ("text", r.text), set()).add(r.shard)
    assert all(len(s) == 1 for s in by_id.values())
    assert sharding.shard(empty, shards).columns == [*empty.columns, "slot", "shard"]
    assert sharding.shard(empty, shards).collect() == []


def test_documents_spread_evenly(spark):
    ids = spark.range(20000).selectExpr("id as doc_id", "cast(null as string) as text")
    counts = [r["count"] for r in sharding.shard(ids, [f"s{k}" for k in range(16)]).groupBy("shard").count().collect()]
    assert len(counts) == 16 and min(counts) > 1100 and max(counts) < 1400
