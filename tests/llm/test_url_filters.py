import math
import re

import pytest
from pyspark.sql import functions as F

from tableworks.llm import url_filters as uf
from tableworks.llm.queries import RULES

from .conftest import SF

URLS = [
    "http://WWW.Example.NET/en/1?a=1&b=2#x", "https://example.net/EN/", "http://notexample.net/en/", "ftp://example.com/de/x",
    "http://example.com/de", "https://a.org/fr/", "https://a.org/fr", "http://net/x", "http://anet/x", "no scheme", "", None,
    "http://host?q=/en/", "http://host#f", "x://y://z/w", "http://ÉXAMPLE.net/é", "http:///path", "https://a.org/fr/" + "x" * 50_000,
]


def parts(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url[at + 3 :])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]


def ruling(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, u, "old", 1) for k, u in enumerate([*URLS, URLS[0]])]
    return spark.createDataFrame(rows, "page_id long, url string, Host string, `a.b` int")


def test_hosts_paths_and_rules(pages):
    rows = uf.judge_urls(pages, RULES).collect()
    assert len(rows) == len(URLS) + 1
    for row in rows:
        host, path = parts(row["url"])
        rule = ruling(host, path)
        assert (row["host"], row["path"]) == (host, path)
        assert row["rule"] == (rule.name if rule else None)
        if rule:
            assert row["verdict"] == rule.verdict
        assert row["verdict"] in ("allow", "block") and row["a.b"] == 1


def test_lexical_features(pages):
    url = F.col("url")
    rows = pages.select("url", *[c.alias(k) for k, c in uf.lexical(url, uf.host_of(url), uf.path_of(url)).items()]).collect()
    for row in rows:
        url = row["url"] or ""
        assert row["url_chars"] == len(url)
        counts = [url.count(c) / len(url) for c in set(url)] if url else []
        assert row["entropy"] == pytest.approx(-sum(p * math.log2(p) for p in counts), abs=1e-9)
        query = re.search(r"\?([^#]*)", url)
        assert row["parameters"] == (len(re.split("[&;]", query[1])) if query and query[1] else 0)
        assert row["depth"] == len([p for p in parts(url)[1].split("/") if p])


@pytest.mark.parametrize("own_left_out", [False, True])
def test_suffix_statistics(spark, own_left_out):
    hosts = [f"h{k % 5}.site{k % 7}.{('com', 'net')[k % 2]}" for k in range(90)] + ["localhost", "", "a.", "www.site1.net"]
    rows = [(h, [None, 0.0, 1.0][k % 3], k % 4 < 2) for k, h in enumerate(hosts)]
    pages = spark.createDataFrame(rows, "_host string, _label double, _second boolean")
    found = uf.suffix_statistics(pages.withColumn("_domain", uf.suffix(F.col("_host"), 2)), own_left_out)
    held = {r["_domain"]: r for r in found.collect()}

    def domain(host):
        return ".".join(host.split(".")[-2:])

    assert set(held) == set(map(domain, hosts))
    for name, got in held.items():
        same = [r for r in rows if r[0].split(".")[-1] == name.split(".")[-1]]
        own = [r for r in rows if domain(r[0]) == name]
        if own_left_out:
            taught = [[r for r in same if domain(r[0]) != name], []]
        else:
            taught = [[r for r in part if not r[2]] for part in (same, own)]
        shares = [
            (sum(r[1] == 1 for r in part) + uf.PRIOR / 2) / (sum(r[1] is not None for r in part) + uf.PRIOR)
            for part in taught
        ]
        want = [math.log1p(len(same)), shares[0], math.log1p(len(own)), shares[1]]
        assert [got[k] for k in uf.SUFFIX] == pytest.approx(want)


def test_rows_are_joined_by_domain_alone(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    plan = uf.judge_urls(pages, RULES)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_learns_from_labels(spark):
    good = [f"https://site{k % 40}.example.com/page/{k}" for k in range(400)]
    bad = [f"http://x{k % 40}-win-{k}999.example.com/a/b/c/d/{k}?id={k}&s={k}&t=1" for k in range(400)]
    rows = [(u, 0) for u in good] + [(u, 1) for u in bad]
    pages = spark.createDataFrame(rows, "url string, spam int")
    found = uf.judge_urls(pages, [], label="spam")
    right = found.where((F.col("verdict") == "block") == (F.col("spam") == 1)).count()
    assert right >= 0.97 * len(rows)


def test_no_python_in_the_plan(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    plan = uf.judge_urls(pages, RULES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_tables_and_labels(pages):
    assert uf.judge_urls(pages.where(F.lit(False)), RULES).count() == 0
    assert {r["verdict"] for r in uf.judge_urls(pages, []).collect()} == {"allow"}
    blocked = uf.judge_urls(pages, [uf.Rule("block", "net")]).collect()
    assert {r["verdict"] for r in blocked if r["rule"]} == {"block"}
