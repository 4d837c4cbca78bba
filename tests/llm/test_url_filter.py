import re

from helpers import rows

from logweave.llm import url_filter as u


def brute(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), host)
    best = None
    for r in u.RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (best is None or len(r.rule) > len(best.rule)):
            best = r
    return host, path, best


URLS = [
    None, "", "no scheme", "http://", "https://A.Example.NET/en/1", "https://example.net/en", "https://example.net/en/", "ftp://x.example.com/de/9?x=://b", "http://notexample.com/de/1", "http://a.org/fr/2#top",
    "http://a.org/FR/2", "http://net/x", "http://a.net", "http://a.net?x=/", "http://user@a.com:80/p/q", "http://a.org//fr/", "x://y\n/z", "http://É.net/a",
]


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def labels(spark, pairs):
    return spark.createDataFrame(pairs, "page_id long, bad int")


def test_rules_against_brute_force(spark):
    got = rows(u.judge(pages(spark, URLS), labels(spark, [])), "page_id", "host", "path", "rule", "verdict")
    want = []
    for k, url in enumerate(URLS):
        host, path, r = brute(url)
        want.append((k, host, path, r.rule if r else None, r.verdict if r else "allow"))
    assert got == sorted(want, key=repr)


def test_bad_templates_are_rejected(spark):
    urls = [f"http://spam.example.com/win/{k}.html" for k in range(60)] + [f"http://spam.example.com/about/{k}" for k in range(60)] + [f"http://good.example.com/en/{k}" for k in range(60)]
    marks = [(k, 1) for k in range(0, 60, 2)] + [(k, 0) for k in range(60, 180, 2)]
    got = {r["page_id"]: r for r in u.judge(pages(spark, urls), labels(spark, marks)).collect()}
    assert {got[k]["verdict"] for k in range(60)} == {"block"}
    assert {got[k]["verdict"] for k in range(60, 180)} == {"allow"}
    assert got[0]["template"] == "/win/{n}.html"


def test_variable_segments_become_wildcards(spark):
    urls = [f"http://a.example.com/user/{name}/x" for name in (f"n{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200))]
    got = {r["template"] for r in u.judge(pages(spark, urls), labels(spark, [])).collect()}
    assert got == {"/user/*/x"}


def test_similar_branches_merge_and_different_ones_do_not(spark):
    urls = [f"http://a.example.com/{lang}/{k}" for lang in ("en", "de", "bad") for k in range(100)]
    marks = [(k, int(200 <= k)) for k in range(300)]
    got = {r["page_id"]: (r["template"], r["verdict"]) for r in u.judge(pages(spark, urls), labels(spark, marks), rules=()).collect()}
    assert got[250] == ("/bad/{n}", "block") and got[10][1] == "allow" and got[10][0] != got[250][0]


def test_deep_paths_empty_tables_and_repeats(spark):
    urls = ["http://a.example.com/" + "/".join("x" * 30)] * 3 + URLS
    df = pages(spark, urls)
    got = u.judge(df.selectExpr("*", "'y' AS host", "'y' AS path", "'y' AS n", "'y' AS template"), labels(spark, [(0, None), (999, 1)]))
    assert got.count() == len(urls) and got.where("bad_share is null").count() == 0
    assert u.judge(df.limit(0), labels(spark, [])).count() == 0


def test_small_sections_of_a_large_host_and_deep_paths_are_told_apart(spark):
    urls = [f"http://hot.example.com/main/{k}" for k in range(5000)] + [f"http://hot.example.com/bad/{k}" for k in range(90)]
    urls += [f"http://hot.example.com/s{chr(97 + k % 26)}{chr(97 + k % 60 // 26)}/{k}" for k in range(3000)]
    urls += [f"http://deep.example.com/a/b/c/d/e/f/{'bad' if k % 2 else 'good'}/x/{k}" for k in range(200)]
    bad = {k for k, url in enumerate(urls) if "/bad/" in url}
    got = u.judge(pages(spark, urls), labels(spark, [(k, int(k in bad)) for k in range(len(urls))]), rules=()).collect()
    assert {r["page_id"] for r in got if r["verdict"] == "block"} == bad
    assert {r["template"] for r in got if r["page_id"] in bad} == {"/bad/{n}", "/a/b/c/d/e/f/bad/x/{n}"}


def test_clashing_columns_and_hot_templates(spark):
    urls = [f"http://hot.example.com/main/{k}" for k in range(300)] + URLS
    df, marks = pages(spark, urls), labels(spark, [(k, k % 2) for k in range(100)])
    columns = ("page_id", "host", "path", "rule", "verdict", "template", "bad_share")
    want = rows(u.judge(df, marks), *columns)
    assert rows(u.judge(df, marks, c=u.Config(hot_rows=7)), *columns) == want
    extra = df.selectExpr("*", *[f"'x' AS {c}" for c in ("host", "path", "forms", "part", "parts", "n", "template", "bad", "labelled", "verdict")])
    assert rows(u.judge(extra, marks.selectExpr("*", "'x' AS host", "'x' AS part")), *columns) == want
    assert rows(u.judge(df.union(df), marks), "page_id", "verdict") == sorted(2 * rows(u.judge(df, marks), "page_id", "verdict"), key=repr)


def test_labels_say_how_much_is_smoothed(spark):
    """With labels by chance a template of two bad pages stays; where sections are all bad or all good, two labels decide."""
    few = ["http://x.example.com/odd/1", "http://x.example.com/odd/2"] + [f"http://x.example.com/odd/{k}" for k in range(3, 9)]
    many = [f"http://h{k // 40}.example.com/s{chr(97 + k // 10 % 4)}/{k}" for k in range(1600)]
    chance = labels(spark, [(0, 1), (1, 1)] + [(8 + k, int(k * 7919 % 13 == 0)) for k in range(1600)])
    sure = labels(spark, [(0, 1), (1, 1)] + [(8 + k, int(k // 10 % 4 == 0)) for k in range(1600)])
    df = pages(spark, few + many)
    verdict = lambda marks: {r["page_id"]: r["verdict"] for r in u.judge(df, marks, rules=()).collect()}
    a, b = verdict(chance), verdict(sure)
    assert "block" not in a.values()
    assert all(b[k] == "block" for k in range(8)) and all(b[8 + k] == ("block" if k // 10 % 4 == 0 else "allow") for k in range(1600))


def test_very_long_url(spark):
    urls = ["http://a.example.com/" + "x" * 500_000, "http://" + "h" * 100_000 + "/p", "http://a.example.com/" + "s/" * 300 + "1"]
    got = rows(u.judge(pages(spark, urls), labels(spark, [])), "page_id", "host", "path", "verdict")
    assert got == sorted(((k, brute(x)[0], brute(x)[1], "allow") for k, x in enumerate(urls)), key=repr)
