"""URL rules against every rule tried on every URL."""

import random

import pytest

from opsloom.llm import urls


def plain(url, rules):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    cut = rest.split("?")[0].split("#")[0]
    raw = cut.split("/")[0]
    host, path = "".join(c.lower() if c.isascii() else c for c in raw), cut[len(raw) :]
    fit = [
        (len(h + p), len(h), h + p, v) for v, h, p in rules
        if None not in (v, h, p) and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fit, default=None)
    return (host, path, best[2], best[3]) if best else (host, path, None, "allow")


def table(spark, rules):
    return spark.createDataFrame(rules, "verdict string, host string, path string")


@pytest.fixture
def many_parts(spark):
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_random_urls_and_rules(spark, many_parts):
    rng = random.Random(1)
    label = lambda: rng.choice(["a", "b", "org", "com", "x-y", "é", ""])
    host = lambda n: ".".join(label() for _ in range(rng.randrange(1, n)))
    step = lambda: rng.choice(["/", "/a", "a", "/b/", "1", "é", "", "/\U0010ffff"])
    path = lambda n: "".join(step() for _ in range(rng.randrange(n)))
    rules = [(rng.choice(["allow", "block"]), host(4), path(4)) for _ in range(150)] + [(None, "a", "/"), ("allow", None, "/")]
    found = [
        rng.choice(["http://", "", "x", "HTTPS://"]) + rng.choice([host(6), host(6).upper()]) + path(6) + rng.choice(["", "?a/b#c", "#x?y", "://z"])
        for _ in range(900)
    ]
    found += [None, "", "://", "a://b", "http://org", "http://org/\nx", "http://" + "a." * 3000 + "org/" + "a" * 5000] + found[:200]
    pages = spark.createDataFrame(list(enumerate(found)), "page_id int, url string").repartition(5)
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, table(spark, rules)).collect()}
    assert out == {i: plain(u, rules) for i, u in enumerate(found)}


def test_nested_rules_over_many_urls(spark, many_parts):
    """Rules that stay open over many parts of the sorted keys."""
    rules = [("block", "org", "/"), ("allow", "a.org", "/x/"), ("block", "a.org", "/x/1"), ("allow", "a.org", "/x/12"), ("allow", "b.org", "")]
    found = [f"http://{h}.org/x/{i}" for i in range(400) for h in ("a", "b", "w.a")] + ["http://a.org/x/1"] * 500
    pages = spark.createDataFrame(list(enumerate(found)), "page_id int, url string").repartition(3)
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, table(spark, rules)).collect()}
    assert out == {i: plain(u, rules) for i, u in enumerate(found)}


def test_edge_tables_and_clashing_columns(spark):
    rows = [(1, "http://a.org/x", "h", 1, 2), (1, "http://a.org/x", "h", 1, 2), (None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, row int, c0 int")
    rules = table(spark, [("allow", "org", "/"), ("block", "org", "/")])
    out = urls.judge(pages, rules)
    assert out.columns == ["page_id", "url", "row", "c0", "host", "path", "rule", "verdict"]
    assert sorted(map(tuple, out.collect()), key=repr) == [
        (1, "http://a.org/x", 1, 2, "a.org", "/x", "org/", "block")] * 2 + [(None, None, None, None, "", "", None, "allow")]
    assert urls.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge(pages, rules.limit(0), no_rule="block").collect()} == {"block"}
    assert {r.verdict for r in urls.judge(pages, urls.rule_table(spark, ())).collect()} == {"allow"}
    assert [tuple(r) for r in urls.rule_table(spark, [("block", "a'b", "/\\")]).collect()] == [("block", "a'b", "/\\")]


def test_no_python_in_the_plan(spark, sf):
    from opsloom.llm.queries import queries

    plan = queries()["op13_url_rules"](spark, sf)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD"))
