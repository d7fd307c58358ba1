"""Rules, segmentation and the classifier of the url filter against plain versions."""

import itertools
import math
import re

import pytest

from stratus.llm import url_filter as U
from stratus.llm.common import read


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def plain_rule(host, path):
    fits = []
    for verdict, rule in U.RULES:
        own, _, rest = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest):
            fits.append((len(rule), len(own), rule, verdict))
    return max(fits)[2:] if fits else (None, None)


URLS = ["http://Example.COM/en/1", "https://www.example.com/en/x?y", "http://a.www.example.com/en/", "http://example.com/en",
        "http://x.net/es/1#a", "net/es/", "http://net/fr/?q", "http://xnet/fr/", "http://a.net/de/", "http://example.com",
        "http://com/", "ftp://É.COM/en/", "http://", "://a.com/b", "http://a.com?b://c/d", "http://h.org/a://b", None, "", "no",
        "http://a.com/x\ny", "http://user@Host.net:80/fr/", "http://.com/", "http://theword.example.org/en/12"]


def test_parts_and_rules(spark):
    rows = [(i, u, "<p>the word of the web</p>", "clash") for i, u in enumerate(URLS)]
    df = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string, host string")
    got = U.judge(df).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path = plain(URLS[r.page_id])
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    named = next(r for r in got if r.page_id == len(URLS) - 1)
    assert named.host_words[:2] == ["the", "word"]


def test_viterbi_matches_enumeration():
    total, counts = 1000.0, {"the": 90, "word": 20, "thew": 1, "or": 60, "d": 2, "ord": 5}
    run = "theword"
    known = {(i, j): math.log(counts[run[i:j]] / total)
             for i in range(7) for j in range(i + 1, 8) if run[i:j] in counts}
    best = None
    for cuts in itertools.product([0, 1], repeat=6):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [7]
        spans = list(zip([0] + ends[:-1], ends))
        p = sum(known.get(s, math.log(10 / total) - (s[1] - s[0]) * math.log(10)) for s in spans)
        best = max(best or (-1e9, []), (p, [run[a:b] for a, b in spans]))
    assert U.viterbi(run, known, total) == best[1] == ["the", "word"]


def test_judged_as_a_plain_naive_bayes_would(spark):
    pages = read(spark, "/root/testdata/sf0.01", "pages")
    rows = U.judge(pages).collect()
    learnt = {"allow": {}, "block": {}}
    tokens = {}
    for r in rows:
        own = [("host", w) for w in r.host_words] + [
            ("path", "<number>" if t[0].isdigit() else t) for t in re.findall(r"[^\W\d_]+|[0-9]+", r.path.lower())]
        tokens[r.page_id] = own
        if r.rule:
            for t in own:
                learnt[r.verdict][t] = learnt[r.verdict].get(t, 0) + 1
    n = {k: sum(bool(r.rule) and r.verdict == k for r in rows) for k in learnt}
    size = {k: sum(v.values()) + U.FEATURES for k, v in learnt.items()}
    for r in rows:
        odds = math.log(n["block"] / n["allow"]) + sum(
            math.log((learnt["block"].get(t, 0) + 1) / size["block"]) - math.log((learnt["allow"].get(t, 0) + 1) / size["allow"])
            for t in tokens[r.page_id])
        assert r.log_odds == pytest.approx(odds, abs=1e-6)
        if not r.rule:
            assert r.verdict == ("block" if odds > 0 else "allow")


def test_words_are_whole_runs_of_bounded_length(spark):
    texts = ["a" * U.LONGEST_WORD + " " + "b" * (U.LONGEST_WORD + 1) + " <b>tag</b> Word word2word", None, "word " * 50_000, ""]
    df = spark.createDataFrame([(i, None, t) for i, t in enumerate(texts)], "page_id long, url string, html string")
    got = {r.word: r.n for r in U.word_counts(df).collect()}
    assert got == {"a" * U.LONGEST_WORD: 1, "tag": 1, "word": 50_003}


def test_empty_table_and_no_rules(spark):
    schema = "page_id long, url string, html string"
    assert U.judge(spark.createDataFrame([], schema)).count() == 0
    got = U.judge(spark.createDataFrame([(1, "http://a.org/b", None), (2, None, "")], schema), rules=()).collect()
    assert {(r.page_id, r.rule, r.verdict) for r in got} == {(1, None, "allow"), (2, None, "allow")}
