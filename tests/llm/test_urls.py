from __future__ import annotations

from cohortlake.llm import urls

SCHEMA = "page_id long, url string, rule int, Host string"


def brute(url):
    if not url or "://" not in url:
        return "", "", None, "allow"
    rest = url[url.index("://") + 3:]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_hosts_paths_and_rules(spark):
    given = [
        None, "", "no scheme", "HTTP://A.Example.ORG/en/12?x", "x://org", "x://org/", "a\nb://com/fr/x\ny#z", "http://b://com/de/",
        "http://xcom/de/", "http://com?/de/", "http://com/de/" + "x" * 50_000, "http://example.org/es", "http://ÄB.org/es/", "x://.org/a",
    ]
    rows = [(k, u, 1, "h") for k, u in enumerate(given)] + [(None, "x://org/", 1, "h"), (1, "", 1, "h")]
    got = urls.filtered(spark.createDataFrame(rows, SCHEMA), urls.rule_table(spark)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(r["url"])


def test_empty_tables_and_null_rules(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert urls.filtered(none, urls.rule_table(spark)).count() == 0
    rules = spark.createDataFrame([("block", None, "/"), ("block", "com", "/"), ("allow", "com", "/")], "rule_verdict string, rule_host string, rule_path string")
    one = spark.createDataFrame([(1, "x://com/", 1, "h")], SCHEMA)
    assert urls.filtered(one, rules).first()["verdict"] == "block"
    assert urls.filtered(one, rules.where("false")).first()["verdict"] == "allow"
