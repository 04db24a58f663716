import numpy as np
import pytest

from tidelake.llm import urls
from tidelake.llm.registry import URL_RULES

PAGES = "page_id long, url string, host string"


def brute(url, rules, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        at = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at])
        path = rest[at:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    under = lambda h: host == h or host.endswith("." + h)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if host and under(h) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    return host, path, None, "block" if host and any(under(h) and path.startswith(p) for h, p in listed) else "allow"


URLS = [
    "http://a.example.org/es/1", "https://EXAMPLE.org/en/123?x=/y", "http://b.org", "http://b.org?x", "http://b.org/", "http://notexample.org/en/1", "x.org/es/", None, "", "://", "http://",
    "http://a.com/de/7", "http://a.com/fr/#top", "http://spam.net/a", "http://www.spam.net", "http://spam.net.x/a", "http://org/", "http://a.com/dé/ü", "ftp://u:p@h.com:80/fr/x://y/z", "http://b.org/" + "a/" * 5000,
]


def test_against_the_rules_as_written(spark):
    listed = [("spam.net", ""), ("b.org", "/a"), (None, "/x")]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate([*URLS, URLS[0]])], PAGES)
    out = urls.judged(df, spark.createDataFrame(URL_RULES, "host string, path string, verdict string"), spark.createDataFrame(listed, "host string, path string"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert got == {i: brute(u, URL_RULES, [x for x in listed if x[0]]) for i, u in enumerate([*URLS, URLS[0]])}


def test_no_rules_and_no_rows(spark):
    rules, listed = spark.createDataFrame([], "host string, path string, verdict string"), spark.createDataFrame([], "host string, path string")
    df = spark.createDataFrame([(1, "http://a.b/c", None)], PAGES)
    assert [tuple(r) for r in urls.judged(df, rules, listed).collect()] == [(1, "a.b", "/c", None, "allow")]
    assert urls.judged(df.limit(0), rules, listed).count() == 0


def test_array_confirms_strings_where_digests_collide(tmp_path):
    digests = np.array([7, 3, 7, 7, 9], dtype=np.uint64)
    strings = np.array(["a", "b", "c", "a", "d"], dtype=object)
    array = urls.DigestArray(digests, strings, str(tmp_path))
    assert isinstance(array.keys, np.memmap)
    asked, entry = array.find(np.array([7, 7, 3, 8, 9], dtype=np.uint64), np.array(["c", "z", "b", "a", "a"], dtype=object))
    assert sorted(zip(asked.tolist(), entry.tolist())) == [(0, 2), (2, 1)]
    asked, entry = array.find(np.array([7], dtype=np.uint64), np.array(["a"], dtype=object))
    assert sorted(entry.tolist()) == [0, 3]


@pytest.mark.parametrize("n", [1, 1000])
def test_probe_over_buckets(spark, monkeypatch, n):
    monkeypatch.setattr(urls, "BUCKET_ROWS", 10)
    entries = spark.createDataFrame([(f"h{i}/", i) for i in range(n)], "text string, k int")
    asked = spark.createDataFrame([(f"h{i}/",) for i in range(0, 2000, 3)], "text string")
    assert sorted(r.k for r in urls.probe(entries, asked).collect()) == list(range(0, n, 3))
