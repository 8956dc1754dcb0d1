"""URL rules against plain Python: the fixed ones, the mined ones and their matching."""

from __future__ import annotations

import random
from itertools import combinations

import pytest

from launchtide.llm import urls
from launchtide.llm.urls import RULES, judge_urls, labelled_pages, mine_url_rules, url_parts, url_tokens

UPPER = {c: c + 32 for c in range(65, 91)}


def parts(url):
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end].translate(UPPER), rest[end:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return host, rest[:end], rest[end:]


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


HOSTS = ["a.example.org", "example.org", "EXAMPLE.org", "notexample.org", "org", "b.com", "x.b.com", "com", "c.net", "c.net:80", "", "é.org"]
PATHS = ["", "/", "/es/", "/es", "/en/1", "/en/12", "/fr/", "/de/x", "/de", "//", "/FR/", "?q=/es/", "#/es/", "/a?b#c?d", "/en/2\n", "/é"]
URLS = [f"{s}{h}{p}" for s in ("http://", "https://", "", "x:y://") for h in HOSTS for p in PATHS]
URLS += [None, "", "://", "a://b://c/d", "no scheme", "http://" + "h" * 100_000 + ".org/" + "p" * 100_000]


def test_fixed_rules(spark):
    pages = spark.createDataFrame([(k // 2, u, "x", 1) for k, u in enumerate(URLS)], "page_id bigint, url string, rule string, host int")
    none = mine_url_rules(spark.createDataFrame([], "url string, label string"))
    found = judge_urls(pages.repartition(3), none).select("page_id", "host", "path", "rule", "verdict")
    wanted = []
    for k, url in enumerate(URLS):
        host, path, _ = parts(url)
        rule, verdict = rule_of(host, path)
        wanted.append((k // 2, host, path, rule, verdict or "allow"))
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(wanted, key=str)
    assert judge_urls(pages.limit(0), none).count() == 0


def test_tokens(spark):
    df = spark.createDataFrame([("http://www.A.com/en/p12.html?x=1&x=2&&y#t3",), (None,), ("http://?",)], "url string")
    found = [row.tokens for row in df.select(url_tokens(*url_parts("url")).alias("tokens")).collect()]
    assert found[0] == ["host:www.a.com", "host:a.com", "host:com", "path:en", "path:p#.html", "key:x", "key:y", "query:x=#", "query:y", "fragment:t#"]
    assert found[1:] == [[], []]


def labelled(rng, n=400):
    rows = []
    for _ in range(n):
        host = rng.choice(["good.net", "spam.net", "mixed.net", "www.spam.net"])
        path = rng.choice(["/en/1", "/de/2", "/promo/3", "/en/promo"])
        bad = 0.9 if "spam" in host else 0.85 if "promo" in path and host == "mixed.net" else 0.1
        rows.append((f"http://{host}{path}", "block" if rng.random() < bad else "allow"))
    return rows


def brute_rules(baskets, least, confidence, lift):
    """``baskets``: (set of tokens, label)."""
    n, sets = len(baskets), {}
    for tokens, label in baskets:
        for size in range(1, len(tokens) + 1):
            for chosen in combinations(sorted(tokens), size):
                of = sets.setdefault(chosen, {})
                of[label] = of.get(label, 0) + 1
    share = {label: sum(x == label for _, x in baskets) for _, label in baskets}
    sure = {}
    for chosen, of in sets.items():
        for label, support in of.items():
            c = support / sum(of.values())
            if support >= least and c >= confidence and c >= lift * share[label] / n:
                sure[chosen, label] = (support, c)
    return {
        (chosen, label): value
        for (chosen, label), value in sure.items()
        if not any(sure.get((tuple(t for t in chosen if t != x), label), (0, 0))[1] >= value[1] for x in chosen)
    }


def test_mined_rules_and_matching(spark):
    rows = labelled(random.Random(1))
    df = spark.createDataFrame(rows + [("http://a.net", None), (None, "allow")], "url string, label string").repartition(3)
    mined = mine_url_rules(df, min_rows=10).collect()
    found = {(tuple(sorted(r.tokens)), r.label): (r.support, r.confidence) for r in mined}
    # By hand: host:spam.net comes alone, host:net with all; both keep their own token.
    of = dict(zip((r[0] for r in rows), (r.tokens for r in spark.createDataFrame(rows, "url string, label string").select(url_tokens(*url_parts("url")).alias("tokens")).collect())))
    baskets = [(set(of[url]), label) for url, label in rows] + [(set(), "allow")]
    # Tokens of the same rows stand for one another.
    places = {}
    for k, (tokens, _) in enumerate(baskets):
        for token in tokens:
            places.setdefault(token, []).append(k)
    first = {}
    for token in sorted(places):
        first.setdefault(tuple(places[token]), token)
    kept = {t for t in first.values() if len(places[t]) >= 10}
    baskets = [(tokens & kept, label) for tokens, label in baskets]
    wanted = brute_rules(baskets, 10, 0.6, 1.2)
    assert wanted and {k: (s, round(c, 12)) for k, (s, c) in found.items()} == {k: (s, round(c, 12)) for k, (s, c) in wanted.items()}
    assert any(label == "block" and "host:spam.net" in tokens for tokens, label in found)

    pages = [(k, url) for k, url in enumerate(sorted(of)) for _ in range(2)] + [(None, None)]
    judged = judge_urls(spark.createDataFrame(pages, "page_id bigint, url string"), spark.createDataFrame(mined), rules=())
    wanted = []
    for page, url in pages:
        fits = [(c, s, label, list(tokens)) for (tokens, label), (s, c) in found.items() if url and set(tokens) <= set(of[url])]
        best = max(fits, default=(None, None, "allow", None))
        wanted.append((page, best[2], best[3], best[0]))
    out = [(r.page_id, r.verdict, r.tokens, r.confidence) for r in judged.collect()]
    assert sorted(out, key=str) == sorted(wanted, key=str)
    assert {v for _, v, _, _ in out} == {"allow", "block"}


@pytest.mark.parametrize("most_rows", [500_000, 300])
def test_hot_url_and_bounds(spark, monkeypatch, most_rows):
    """A URL of very many tokens, on half of all rows, and a bounded sample."""
    long = "http://spam.net/" + "/".join(f"s{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300))
    rows = [(long + ("" if k % 3 else "?z"), "block" if k % 10 else "allow") for k in range(500)]
    rows += [(f"http://h{k % 9}.net/{chr(97 + k % 7)}", "allow") for k in range(500)]
    mined = mine_url_rules(spark.createDataFrame(rows, "url string, label string"), most_rows=most_rows)
    assert 0 < mined.count() < 1 << 12
    judged = judge_urls(spark.createDataFrame([(1, long), (2, "http://h1.net/b")], "page_id bigint, url string"), mined)
    assert {r.page_id: r.verdict for r in judged.collect()} == {1: "block", 2: "allow"}


def test_labels_of_pages(spark, edge_labels):
    pages = spark.createDataFrame(
        [(1, "http://a.net/en/1"), (2, "http://a.net/en/2.html?x"), (3, "http://a.net/7/"), (4, "http://a.net/9"), (5, "http://a.net/11"), (6, "http://a.net/x"), (7, None), (8, "http://a.net/" + "1" * 40)],
        "page_id bigint, url string",
    )
    found = {row.url: row.label for row in labelled_pages(pages, edge_labels).collect()}
    assert found == {"http://a.net/en/1": "allow", "http://a.net/en/2.html?x": "block", "http://a.net/7/": "block", "http://a.net/9": "allow", "http://a.net/11": "allow"}
    assert labelled_pages(pages, edge_labels.limit(0)).count() == 0
