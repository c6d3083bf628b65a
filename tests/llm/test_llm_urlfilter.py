import duckdb
import pytest

from planpulse.llm import queries, urlfilter

RULES = queries.URL_RULES
URLS = [None, "", "no scheme", "://", "http://", "http://ORG/", "http://Example.ORG/en/1", "https://a.example.org/en/12?x#y",
        "https://a.example.org/en/2", "http://example.org/es/", "http://example.org/es", "http://example.org",
        "http://notexample.org/es/x", "ftp://x.com/de/1", "ftp://com/de/", "x://com/fr/", "x://y.com/de?/de/", "x://y.com#/de/",
        "a://b://c.com/fr/", "http://user@example.org:80/en/1", "http://İ.com/de/ü", "http://..com/de/", "http://com./de/",
        "http://a.org//", "http://a.net/de/\nx", "http://" + "a." * 5000 + "com/fr/" + "p" * 50000]


def brute(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    stop = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:stop])
    path = rest[stop:]
    path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for r in rules:
        h, _, p = r.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r) > len(best)):
            best = r
    return host, path, best, rules[best] if best else default


def frame(spark, urls):
    return spark.createDataFrame([(i if i != 2 else None, u, "x", "y") for i, u in enumerate(urls)],
                                 "page_id bigint, url string, host string, verdict string")


@pytest.mark.parametrize("default", ["allow", "block"])
def test_matches_brute_force(spark, default):
    got = urlfilter.judge(frame(spark, URLS + URLS[:3]), RULES, default).collect()
    want = [(i if i != 2 else None, *brute(u, RULES, default)) for i, u in enumerate(URLS + URLS[:3])]
    assert sorted([tuple(r) for r in got], key=repr) == sorted(want, key=repr)


def test_join_form_agrees(spark):
    rules = spark.createDataFrame(list(RULES.items()), "rule string, verdict string")
    pages = frame(spark, URLS)
    a = urlfilter.judge(pages, RULES).collect()
    b = urlfilter.judge_by_join(pages, rules).collect()
    assert sorted(map(tuple, a), key=repr) == sorted(map(tuple, b), key=repr)


def test_collisions_are_confirmed(tmp_path):
    path = str(tmp_path / "index.bin")
    with open(path, "wb") as f:
        f.write(urlfilter.DigestArray.build({"a/": 0, "b/": 1, "c/": 1}, digest=lambda s: 7))
    index = urlfilter.DigestArray(path)
    found = index.find([b"b/", b"zz/", b"a/"], digest=lambda s: 7)
    assert [index.stored(i) for i in found[[0, 2]]] == [b"b/", b"a/"] and found[1] == -1
    assert index.values[found[0]] == 1


def test_empty_rules_and_tables(spark):
    assert {r.verdict for r in urlfilter.judge(frame(spark, URLS), {}).collect()} == {"allow"}
    assert urlfilter.judge(frame(spark, []), RULES).collect() == []
    with pytest.raises(ValueError):
        urlfilter.split_rule("example.org")


def test_query_matches_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{d}/pages.parquet'")
    want = con.execute(queries.ORACLE_SQL["op6_url_filter"]).fetchall()
    got = queries.op6_url_filter(spark, d).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got)) == sorted(want, key=lambda r: r[0]) or \
        sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)
