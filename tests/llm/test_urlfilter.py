from __future__ import annotations

from pseudora.llm import urlfilter

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:at], rest[at:]
    at = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:at]


def rule_of(host, path):
    fits = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.NET/en/x?y#z", "https://example.net/EN/", "ftp://xexample.net/en/",
    "http://example.net", "http://example.net?/en/", "http://ÀB.org/fr/1", "http://org/fr/", "http://a.example.com/de/?q=://b",
    "http://a.com/x\ny", "x://y://z.net/", "http://example.com/de", "http://net.com/", "http://h.net/a#b?c",
]


def test_hosts_paths_and_rules(spark):
    rows = [(k, url, "<p>", "spam") for k, url in enumerate(URLS)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string").drop("host")
    found = urlfilter.filter_urls(df).collect()
    assert len(found) == len(rows)
    for r in found:
        host, path = parts(URLS[r["page_id"]])
        rule, verdict = rule_of(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")


def test_model_learns_labels(spark):
    good = [(f"site{k}.wiki.com", f"/article/{k}", 0) for k in range(150)]
    bad = [(f"cheap-pills{k}.shop.com", f"/buy/{k}", 1) for k in range(150)]
    labelled = spark.createDataFrame(good[:100] + bad[:100], "host string, path string, label int")
    pages = [(k, f"http://{h}{p}") for k, (h, p, _) in enumerate(good[100:] + bad[100:])]
    df = spark.createDataFrame(pages, "page_id long, url string")
    found = {r["page_id"]: r["verdict"] for r in urlfilter.filter_urls(df, labelled=labelled).collect()}
    assert sum(found[k] == ("allow" if k < 50 else "block") for k in range(100)) >= 97


def test_without_labels_the_model_allows(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert urlfilter.filter_urls(df).first()["verdict"] == "allow"
    assert urlfilter.filter_urls(df.limit(0)).count() == 0


def test_scoring_needs_no_shuffle_and_no_python(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    plan = urlfilter.filter_urls(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
