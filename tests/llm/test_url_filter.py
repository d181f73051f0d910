import random

from plumbline.llm import url_filter as U
from plumbline.llm.url_filter import Rule, UrlTrie, split_url, url_verdicts

RULES = [Rule.of("com/", True), Rule.of("example.com/en/", False), Rule.of("www.example.com/en/", True), Rule.of("net/es/", False), Rule.of("org", False), Rule.of("a.org/x", True)]


def brute(url, rules):
    host, path = split_url(url)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: (r.host.count("."), len(r.path), not r.allow), default=None)


def test_split():
    assert split_url("HTTP://WWW.Ex.com/A?b#c") == ("www.ex.com", "/A")
    assert split_url("x://h#f/y?z") == ("h", "")
    assert split_url("a://b://c/d") == ("b:", "//c/d")
    assert split_url(None) == split_url("no scheme") == ("", "")
    assert split_url("://É.COM") == ("É.com", "")


def test_longest_match_against_brute_force():
    r = random.Random(1)
    hosts = ["com", "example.com", "www.example.com", "m.www.example.com", "net", "x.net", "a.org", "b.a.org", "notcom", "com.", ""]
    paths = ["", "/", "/en", "/en/", "/en/x", "/es/", "/es/y/", "/x", "/xy", "/x/y"]
    for rules in (RULES, RULES + [Rule.of("com/", False)], []):
        t = UrlTrie(rules)
        for _ in range(500):
            url = f"http://{r.choice(hosts)}{r.choice(paths)}{r.choice(['', '?q=/en/', '#f'])}"
            got, want = t.find(*split_url(url)), brute(url, rules)
            assert (got and (got.text, got.verdict)) == (want and (want.text, want.verdict)), url


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "http://a.com/", "p"), (1, "http://a.com/", "q"), (None, None, None), (3, "", "r"), (4, "x://b.net/es/" + "y" * 100_000, "s")]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string")
    got = url_verdicts(df, RULES).collect()
    assert {(g.page_id, g.rule, g.verdict) for g in got} == {(1, "com/", "allow"), (None, None, "allow"), (3, None, "allow"), (4, "net/es/", "block")}
    assert len(got) == 5
    assert url_verdicts(df.limit(0), RULES).count() == 0


def test_long_lists_are_joined(spark, monkeypatch):
    """Above the bound of the broadcast, rules are shuffled, with the same verdicts."""
    r = random.Random(2)
    hosts = ["com", "example.com", "www.example.com", "m.www.example.com", "net", "x.net", "a.org", "b.a.org", "com.", "", "É.com"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/es/", "/x\ny", "/xy", "/x/y"]
    rows = [(i, r.choice([None, "", "no", *[f"HTTP://{r.choice(hosts)}{r.choice(paths)}{r.choice(['', '?q=://a/en/', '#f'])}" for _ in range(9)]]), "x") for i in range(400)]
    df = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, host string")
    rules = [*RULES, Rule.of("com/", False), Rule.of("org/x/", True), Rule("", "/en", False)]
    broadcast = sorted(map(tuple, url_verdicts(df, rules).collect()), key=str)
    monkeypatch.setattr(U, "MOST_RULES", 3)
    joined = url_verdicts(df, rules)
    assert sorted(map(tuple, joined.collect()), key=str) == broadcast and len(broadcast) == 401
    assert joined.columns == ["page_id", "host", "path", "rule", "verdict"]
