"""The automaton against regular expressions, and the judgements against the definition."""

import random
import re

from tablecraft.llm.urlfilter import RULES, Automaton, Rule, judge_urls


def regular(pattern):
    """The glob as a regular expression over bytes."""
    out, host, i = b"", True, 0
    while i < len(pattern):
        c = pattern[i:i + 1]
        if c == b"\\" and i + 1 < len(pattern):
            i += 1
            out += re.escape(pattern[i:i + 1])
        elif c == b"*":
            out += b"[^/]*" if host else b"[\\s\\S]*"
        else:
            out += b"[\\s\\S]" if c == b"?" else re.escape(c)
        host = host and c != b"/"
        i += 1
    return re.compile(out)


def test_automaton_equals_regular_expressions():
    pick = random.Random(8)
    patterns = ["".join(pick.choices("ab/.*?", weights=[4, 4, 2, 2, 3, 1], k=pick.randint(0, 14))).encode() for _ in range(120)]
    patterns += [b"\\*a", b"\\\\", b"*", b"", "é*".encode(), b"a" * 200]
    texts = ["".join(pick.choices("ab/.", k=pick.randint(0, 25))).encode() for _ in range(400)] + [b"*a", b"\\", b"", "éa".encode(), b"a" * 200]
    found = Automaton(patterns).matches(texts)
    for k, p in enumerate(patterns):
        whole = regular(p)
        assert [bool(whole.fullmatch(t)) for t in texts] == found[:, k].tolist(), p


def plain(url):
    if not url or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if c.isascii() else c for c in host), slash + path


def want(url):
    host, path = plain(url)
    fits = [r for r in RULES if r.host and ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.name))
        return host, path, best.name, best.verdict
    blocked = any(regular(r.pattern).fullmatch(f".{host}{path}".encode()) for r in RULES if r.glob)
    return host, path, None, "block" if blocked else "allow"


def test_judgements_equal_definition(spark):
    urls = [None, "", "x", "://", "http://", "http://ORG/", "http://org", "http://a.Example.org/es/1", "http://example.org/es", "http://badexample.org/en/1",
            "https://b.example.org/en/123?x=/", "http://x.com/de/?q", "http://com/fr/#a", "http://x.net/a/login.php", "http://x.net/get.exe",
            "http://x.net/get.exe2", "http://ads.x.net/", "http://x.ads.net/", "http://x.net/wp-admin/a", "http://m.example.net/en/12", "http://m.example.net/en/123",
            "a://b://c/d", "http://É.COM/de/é", "http://x.com:80/de/", "http://x.org\n/a\nb?c", "http://*.org/*", "http://x.net/" + "a/" * 50 + "login"]
    rows = [(i, u, "clash") for i, u in enumerate(urls)] + [(0, None, "again"), (None, "http://x.org/", None)]
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string"), RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        url = "http://x.org/" if r.page_id is None else urls[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == want(url), url


def test_very_long_addresses():
    found = Automaton([r.pattern for r in RULES]).matches([b".x.org/" + b"a" * 200_000, b".x.net/" + b"login" * 40_000])
    assert [found[0].nonzero()[0].tolist(), found[1].nonzero()[0].tolist()] == [[0], [5]]


def test_no_rows_no_rules_and_ties(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(none, RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert [tuple(r)[3:] for r in judge_urls(one, [], "block").collect()] == [(None, "block")]
    tie = [Rule("allow", "a.b", "/"), Rule("block", "b", "/c"), Rule("block", "b", "/cc")]
    assert [tuple(r)[3:] for r in judge_urls(one, tie).collect()] == [("a.b/", "allow")]
