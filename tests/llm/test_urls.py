import random

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import ascii_lower, rows
from wardline.llm.queries import URL_RULES
from wardline.llm.urls import Rule, build_cascade, judge_urls

URLS = [
    None, "", "no scheme", "http://", "http://Example.COM", "http://example.com/", "http://example.com/en", "http://example.com/en/x",
    "https://www.example.com/en/1?q=http://x.net/fr/", "http://a.www.example.com/en/1", "http://notexample.com/en/1", "http://com/x",
    "http://net/es/1", "http://m.net/fr/#top", "http://m.net/FR/1", "http://m.org/es/1", "ftp://x.net?/es/", "x://y://z.net/es/",
    "http://a.com.:80/x", "http://.com/x", "http://..net/fr/", "http://ÉXAMPLE.com/en/", "http://" + "a." * 3000 + "net/es/", "http://net/es/1",
    "http://example.com/" + "p" * 50_000,
]


def expected(rules, default="allow"):
    out = []
    for page_id, url in enumerate(URLS):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = ascii_lower(rest[:cut]), rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: (len(r.key), len(r.host)), default=None)
        out.append((page_id, host, path, best and best.key, best.action if best else default))
    return sorted(out, key=repr)


def pages(spark, urls=URLS):
    schema = "page_id long, url string, host string, path string, rule string, verdict string, key string, keys string"
    return spark.createDataFrame([(n, u, *["x"] * 6) for n, u in enumerate(urls)], schema)


MORE = (Rule("block", "net", "/"), Rule("allow", "net", "/e"), Rule("allow", "m.net", "/"), Rule("block", "example.com", "/pppp"))


@pytest.mark.parametrize("rules", [URL_RULES, MORE, URL_RULES[:1]])
def test_verdicts(spark, rules):
    assert rows(judge_urls(pages(spark), rules)) == expected(rules)


def test_no_rules_and_repeated_rows(spark):
    assert rows(judge_urls(pages(spark), (), "block")) == expected((), "block")
    twice = judge_urls(pages(spark).union(pages(spark)), URL_RULES)
    assert rows(twice) == sorted(expected(URL_RULES) * 2, key=repr)


def test_two_actions_for_one_key(spark):
    with pytest.raises(ValueError, match="two actions"):
        judge_urls(pages(spark), (Rule("allow", "a", "/"), Rule("block", "a", "/")))


@pytest.mark.parametrize(("share", "most"), [(0, None), (0.002, None), (0.3, None), (0.9, None), (1, None), (0.3, 1500), (1, 2000)])
def test_the_cascade_is_exact(spark, share, most):
    draw = random.Random(3)
    keys = [f"key{n}" for n in range(5000)] + [""]
    listed = {k for k in keys if draw.random() < share}
    universe = spark.createDataFrame([(k,) for k in keys] + [(None,), ("key1",)], "key string")
    frame = spark.createDataFrame([(k,) for k in sorted(listed)] + [("elsewhere",), (None,)], "key string")
    cascade = build_cascade(universe, frame, most)
    assert (len(cascade.parts) > 1) == (most is not None)
    assert all(level.bits <= (most or 1 << 27) for part in cascade.parts for level in part.levels)
    got = {r["key"] for r in universe.where(cascade.lists(F.col("key"))).collect()}
    assert got - {None} == listed
    bits = sum(level.bits for part in cascade.parts for level in part.levels)
    assert bits < 40 * min(len(listed), len(keys) - len(listed) + 500) + 2000


def test_empty_table(spark):
    assert judge_urls(pages(spark, []), URL_RULES).collect() == []
