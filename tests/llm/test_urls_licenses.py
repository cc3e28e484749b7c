"""URL filters and licence scans against DuckDB on given rows, with odd inputs."""

import duckdb
import pytest

from chargepulse.llm import license_scan, url_filter

URLS = ["http://www.example.com/en/1", "http://example.com/en/x?y#z", "HTTP://A.NET/es/3", "http://net/fr/", "http://net/fr",
        "https://foo.com", "https://foo.com?x=/en/", "https://foo.com/", "no scheme", "", None, "a://b://c.net/es/",
        "http://WWW.Example.COM/en/", "http://www.example.com/EN/", "http://xexample.com/en/", "http://a.b.c.d.net/es/q",
        "http:///en/", "http://com/", "http://example.com.evil.org/en/", "http://x.net/fr/\nnew", "http://u.com/" + "p" * 50_000]


def _pages(spark, urls):
    return spark.createDataFrame([(i, u, "other", 7) for i, u in enumerate(urls)],
                                 "page_id long, url string, verdict string, slices int")


def _rules(spark, rows=url_filter.RULES):
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def _brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut], rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


def test_urls_match_brute_force(spark):
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.filter_urls(_pages(spark, URLS), _rules(spark)).collect()}
    assert got == {i: _brute(u, url_filter.RULES) for i, u in enumerate(URLS)}


def test_nested_rules_on_one_host(spark):
    rules = [("a.org", "/" + "x" * k, "block" if k % 2 else "allow") for k in range(6)] + [("org", "/xx", "allow")]
    urls = [f"http://{h}/{'x' * k}{t}" for h in ("a.org", "b.a.org", "c.org") for k in range(8) for t in ("", "y", "~")]
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.filter_urls(
        _pages(spark, urls), _rules(spark, rules), per_slice=3).collect()}
    assert got == {i: _brute(u, rules) for i, u in enumerate(urls)}


def test_repeated_rows_null_ids_and_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/"), (1, "http://a.com/"), (None, "http://a.net/es/"), (None, None)],
                                  "page_id long, url string")
    rules = _rules(spark, [*url_filter.RULES, ("com", "/", "block"), (None, "/", "block"), ("x", None, "block")])
    got = sorted(map(str, (tuple(r) for r in url_filter.filter_urls(pages, rules).collect())))
    assert got == sorted(map(str, [(1, "a.com", "/", "com/", "allow")] * 2 + [
        (None, "a.net", "/es/", "net/es/", "block"), (None, "", "", None, "allow")]))


def test_empty_tables(spark):
    none = _pages(spark, URLS).limit(0)
    assert url_filter.filter_urls(none, _rules(spark)).count() == 0
    got = url_filter.filter_urls(_pages(spark, URLS), _rules(spark).limit(0), default="block").collect()
    assert len(got) == len(URLS) and {r["verdict"] for r in got} == {"block"}


def test_urls_are_native(spark):
    plan = url_filter.filter_urls(_pages(spark, URLS), _rules(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


TEXTS = ["Released under the MIT License.", "prose\nRELEASED under; the mit license\nmore", None, "", "\n\n", "license",
         "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", "Licensed under CC BY 4.0", "x " * 30_000,
         "released under the mit license " * 3, "Licensed under the Apache License, Version 2.0.\n" * 2]


def test_licenses_match_sql(spark):
    rows = list(enumerate(TEXTS))
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, license string, line int")
    forms = spark.createDataFrame(license_scan.TEMPLATES, "license string, text string")
    got = license_scan.scan_licenses(docs, forms)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute(license_scan.ORACLE).fetchall()
    key = lambda r: (r[0], r[1], r[2], r[3] and round(r[3], 9), r[4])
    assert sorted(map(key, got.collect()), key=str) == sorted(map(key, want), key=str)
    assert {r["doc_id"] for r in got.where("n_matches > 0").collect()} >= {0, 1, 6, 10}


def test_licenses_wrapped_and_inside_lines(spark):
    import textwrap
    mit, isc = (next(t for x, t in license_scan.TEMPLATES if x == name and len(t) > 150) for name in ("MIT", "ISC"))
    more = " ".join(f"word{i}" for i in range(80)) + "."
    texts = ["\n".join(textwrap.wrap(mit, 40)), f"Copyright 2020 foo\n\n{mit}\n\n{more}".replace(", ", ",\n"),
             "This file is part of foo. Released under the MIT License. See COPYING.",
             "a b\n" + "\n".join(textwrap.wrap("One. " + isc + " Two.", 50)) + "\n" + "\n".join(textwrap.wrap(mit + " Three " + more, 60)),
             "see\nthe file. Released under the\nMIT License. It is " + "long " * 60, "prose " * 50 + "under the license of the " * 3,
             "Released under the MIT License.\n" + more]
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[2])], "doc_id long, text string")
    forms = spark.createDataFrame(license_scan.TEMPLATES, "license string, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in license_scan.scan_licenses(docs, forms).collect()}
    assert got[0] == (1, "MIT", 1.0, 0)
    assert got[1][:2] == (1, "MIT") and got[1][2] > 0.95 and got[1][3] == 3
    assert got[2] == got[None] == (1, "MIT", 1.0, 1)
    assert got[3][0] == 2 and got[3][1:] == ("ISC", 1.0, 2)
    assert got[4] == (1, "MIT", 1.0, 2)
    assert got[5] == (0, None, None, None)
    assert got[6] == (1, "MIT", 1.0, 1)


@pytest.mark.parametrize("no_docs", [True, False])
def test_licenses_empty(spark, no_docs):
    docs = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id long, text string")
    forms = spark.createDataFrame(license_scan.TEMPLATES, "license string, text string")
    got = license_scan.scan_licenses(docs.limit(0) if no_docs else docs, forms if no_docs else forms.limit(0)).collect()
    assert [tuple(r) for r in got] == ([] if no_docs else [(1, 0, None, None, None)])


def test_repeated_documents_are_one(spark):
    docs = spark.createDataFrame([(1, TEXTS[0]), (1, TEXTS[0]), (2, "no")], "doc_id long, text string")
    forms = spark.createDataFrame(license_scan.TEMPLATES, "license string, text string")
    got = sorted(tuple(r)[:3] for r in license_scan.scan_licenses(docs, forms).collect())
    assert got == [(1, 1, "MIT"), (2, 0, None)]


def test_repeated_documents_match_no_more_than_one(spark):
    docs = spark.createDataFrame([(1, "Released under the GPL License.")] * 2, "doc_id long, text string")
    forms = spark.createDataFrame(license_scan.TEMPLATES, "license string, text string")
    assert [tuple(r) for r in license_scan.scan_licenses(docs, forms).collect()] == [(1, 0, None, None, None)]
