"""URL filters: parsing and rules against plain Python, and what the template tree rejects."""

import re

from tallyhouse.llm import urls
from tallyhouse.llm.queries import op3_url_filter


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for verdict, rule in rules:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.NET/en/x?y#z", "https://example.net/en", "https://example.net/en/", "x://net/", "x://net", "http://anet/",
    "http://fr.example.com/de/1", "http://example.com/DE/1", "http://w.org/fr/a/b", "http://org/fr/", "http://é.ÀB.net/é/ü", "a://b://c.net/d", "http://h?q=/x",
    "http://h#f/x", "http://h.com/" + "seg/" * 3000, "://net/only", "http://h.com//double//slash", "http://u:p@h.net:80/x\ny",
]


def test_odd_urls(spark):
    rows = [(i, u, "x", 1) for i, u in enumerate(URLS)] + [(None, URLS[4], "x", 1), (4, URLS[4], "x", 1)]
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string, n int")).collect()
    expected = [(str(i), *plain(u, urls.RULES)) for i, u, _, _ in rows]
    assert sorted(map(str, ((str(r.page_id), r.host, r.path, r.rule) for r in got))) == sorted(str(e[:4]) for e in expected)
    for r in got:
        ruled = plain(URLS[r.page_id] if r.page_id is not None else URLS[4], urls.RULES)[3]
        assert r.verdict == (ruled or "allow")


def test_variable_branch_with_blocked_labels_is_rejected(spark):
    """Slugs under /spam are too many to name; those a rule decides are all blocked, so the others are rejected too."""
    names = [chr(97 + i % 2) + "".join(chr(97 + (i * k) % 23) for k in (3, 5, 7, 11)) for i in range(240)]
    rows = [f"http://shop.test/spam/{n}/{i}" for i, n in enumerate(names)]
    rows += [f"http://shop.test/ham/{n}/{i}" for i, n in enumerate(names)] + ["http://other.test/spam/bx/1"]
    rules = (("block", "shop.test/spam/a"), ("allow", "shop.test/ham/a"))
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(df, rules).collect()}
    for i, u in enumerate(rows):
        _, _, rule, ruled = plain(u, rules)
        assert got[i] == (rule, ruled or ("block" if "shop.test/spam" in u else "allow")), u


def test_branches_that_differ_stay_apart(spark):
    """/de is blocked by a rule throughout; /en has no labels and does not join it."""
    rows = [f"http://a.test/{lang}/{i}" for i in range(100) for lang in ("de", "en", "fr")]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge_urls(df, (("block", "a.test/de/"),)).collect()}
    assert all(got[i] == ("block" if "/de/" in u else "allow") for i, u in enumerate(rows))


def test_a_blocked_section_among_many_stays_apart(spark):
    """However many sections a host has: /de is blocked by a rule, the others have no labels, or are allowed but for a few."""
    names = ["de", *(chr(97 + i // 5) + chr(107 + i % 5) for i in range(1, 40))]
    for sections in (3, 25, 40):
        rows = [f"http://a.test/{s}/news/{i}" for i in range(8) for s in names[:sections]]
        df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
        got = {r.page_id: r.verdict for r in urls.judge_urls(df, (("block", "a.test/de/"),)).collect()}
        assert all(got[i] == ("block" if "/de/" in u else "allow") for i, u in enumerate(rows)), sections
    rows = [f"http://a.test/{s}/{k}/{i}" for i in range(20) for s in names[:30] for k in ("x", "y")]
    rules = (("allow", "a.test/"), ("block", "a.test/de/x"))
    df = spark.createDataFrame([*enumerate(rows)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge_urls(df, rules).collect()}
    assert all(got[i] == ("block" if "/de/x" in u else "allow") for i, u in enumerate(rows))


def test_paths_part_at_any_depth(spark):
    deep = "a/b/c/d/e/f/g"
    rows = [f"http://a.test/{deep}/{s}/{i}" for i in range(30) for s in ("de", "en", "fr")]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge_urls(df, (("block", f"a.test/{deep}/de/"),)).collect()}
    assert all(got[i] == ("block" if "/de/" in u else "allow") for i, u in enumerate(rows))


def test_segments(spark):
    paths = ["/a/12/b3.html", "/x/0f8fad5b-d9cb-469f-a165-70867728950e/", "/c/deadbeef01/q", "/1/2/3/4/5/6/7/8", "", "/"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = [r.s for r in df.select(urls.segments("path", 6).alias("s")).collect()]
    assert got == [["a", "<n>", "b<n>.html"], ["x", "<id>"], ["c", "<id>", "q"], ["<n>"] * 6 + ["**"], [], []]


def test_empty_table(spark):
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()}
    for r in op3_url_filter(spark, folder).collect():
        host, path, rule, ruled = plain(pages.pop(r.page_id), urls.RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (ruled or r.verdict)
    assert not pages


def test_native(spark):
    plan = op3_url_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
