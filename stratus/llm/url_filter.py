"""URL filter: rules, then naive Bayes over segmented host names and path tokens (operator 1).

A rule names a host and the start of a path; it fits the host and its
subdomains, and the longest fitting rule decides. Other urls are judged by
what the rules decided elsewhere: runs of letters in each distinct host are
split into words by unigram Viterbi (word counts from the texts of all pages,
an unknown word costs a factor of ten a letter), and a multinomial naive Bayes
over the host's words and the path's tokens is learnt from the urls with a
rule. Tokens are hashed to 65,536 features, so the model the tasks get has a
fixed size. A word has at most 24 letters (``LONGEST_WORD``): longer runs in
the pages' texts are no words, and host names are split into words of that
length at most.

Words, hosts and features are counted by grouped aggregates; the only join on
a hot key hands each url its host's score, from one row per host, and may be
split by adaptive execution.

Cases: a null url or one without ``://`` has an empty host and path, no rule,
and the prior's verdict; without any url under an allow (or block) rule all
unruled urls get the other verdict, allow if there is neither; equal scores
allow; repeated rows are judged alike; an empty table gives no rows; extra
columns are ignored. Of two fitting rules of equal length the one with the
longer host wins, then the greater string.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.llm.common import written

# The rules of the registered query.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
LONGEST_WORD = 24
FEATURES = 1 << 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, host, path of every url."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring("url", at + 3, F.length("url"))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return pages.select("page_id", host.alias("host"), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"))


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, or null. ``rules`` is a short list."""
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    fits = []
    for verdict, rule in rules:
        own, _, rest = rule.partition("/")
        fit = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        fits.append(F.when(fit, F.struct(F.lit(len(rule)).alias("n"), F.lit(len(own)).alias("h"),
                                         F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    best = F.array_max(F.array_compact(F.array(*fits)))
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n): whole runs of a-z in the lower-cased text of all pages.

    A run longer than ``LONGEST_WORD`` is no word and is not counted, neither
    whole nor in pieces.
    """
    text = F.lower(F.regexp_replace("html", "<[^>]*>", " "))
    words = F.regexp_extract_all(text, F.lit(f"(?<![a-z])[a-z]{{1,{LONGEST_WORD}}}+(?![a-z])"), F.lit(0))
    return pages.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def viterbi(run: str, known: dict[tuple[int, int], float], total: float) -> list[str]:
    """Most probable split of ``run``; ``known``: log probabilities by (start, end)."""
    best, back = [0.0], [0]
    for end in range(1, len(run) + 1):
        options = []
        for start in range(max(0, end - LONGEST_WORD), end):
            p = known.get((start, end))
            if p is None:
                p = math.log(10.0 / max(total, 1.0)) - (end - start) * math.log(10.0)
            options.append((best[start] + p, start))
        p, start = max(options)
        best.append(p)
        back.append(start)
    words, end = [], len(run)
    while end:
        words.append(run[back[end]:end])
        end = back[end]
    return words[::-1]


def segmented(runs: DataFrame, words: DataFrame) -> DataFrame:
    """(run, words) for each distinct run of letters, by the counts ``words`` (word, n)."""
    total = float(words.agg(F.sum("n")).first()[0] or 0)
    starts = F.sequence(F.lit(1), F.length("run"))
    parts = runs.select("run", F.explode(starts).alias("start")).select(
        "run", "start", F.explode(F.sequence(F.lit(1), F.least(
            F.lit(LONGEST_WORD), F.length("run") - F.col("start") + 1))).alias("size"))
    parts = parts.select("run", "start", "size", F.substring("run", F.col("start"), F.col("size")).alias("word"))
    known = (parts.join(words, "word").groupBy("run").agg(F.collect_list(F.struct(
        (F.col("start") - 1).alias("start"), (F.col("start") - 1 + F.col("size")).alias("end"),
        F.log(F.col("n") / max(total, 1.0)).alias("p"))).alias("known")))

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(run: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([viterbi(r, {(k["start"], k["end"]): k["p"] for k in (ks if ks is not None else ())}, total)
                          for r, ks in zip(run, found)])

    return runs.join(known, "run", "left").select("run", split("run", "known").alias("words"))


def path_tokens(path: Column) -> Column:
    """Lower-cased runs of letters, and one token for any number."""
    tokens = F.regexp_extract_all(F.lower(path), F.lit(r"\p{L}+|[0-9]+"), F.lit(0))
    return F.transform(tokens, lambda t: F.when(t.rlike("^[0-9]"), "<number>").otherwise(t))


def _features(tokens: Column, part: str) -> Column:
    return F.transform(tokens, lambda t: F.pmod(F.xxhash64(F.lit(part), t), F.lit(FEATURES)).cast("int"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and the log odds of block for every page."""
    found = longest_rule(F.col("host"), F.col("path"), rules)
    urls = with_parts(pages).withColumn("found", found).select(
        "page_id", "host", "path", "found.rule", F.col("found.verdict").alias("ruled"),
        _features(path_tokens(F.col("path")), "path").alias("features"))
    allow, block = F.count_if(F.col("ruled") == "allow"), F.count_if(F.col("ruled") == "block")
    hosts = written(urls.groupBy("host").agg(allow.alias("allow"), block.alias("block")), "hosts")
    runs = hosts.select("host", F.posexplode(F.regexp_extract_all("host", F.lit("[a-z]+"), F.lit(0))).alias("at", "run"))
    split = segmented(runs.select("run").distinct(), written(word_counts(pages), "words"))
    named = (runs.join(split, "run").groupBy("host").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("words")))
    hosts = written(hosts.join(named, "host", "left").withColumn("words", F.coalesce(
        "words", F.array().cast("array<string>"))).withColumn("features", _features(F.col("words"), "host")), "hosts")
    counted = (hosts.select(F.explode("features").alias("f"), "allow", "block")
               .groupBy("f").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
               .union(urls.where(F.col("ruled").isNotNull()).select(F.explode("features").alias("f"), "ruled")
                          .groupBy("f").agg(allow, block)))
    rows = counted.groupBy("f").agg(F.sum("allow"), F.sum("block")).collect()   # at most FEATURES rows
    n_allow, n_block = (x or 0 for x in hosts.agg(F.sum("allow"), F.sum("block")).first())
    weights, prior = log_odds(rows, n_allow, n_block)
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf(T.DoubleType())
    def score(features: pd.Series) -> pd.Series:
        w = shared.value
        return pd.Series([float(w[np.asarray(f, np.int64)].sum()) for f in features], dtype=float)

    by_host = hosts.select("host", "words", score("features").alias("host_score"))
    odds = F.lit(prior) + F.col("host_score") + score("features")
    return (urls.join(by_host, "host")
                .withColumn("log_odds", odds)
                .select("page_id", "host", "path", "rule", F.coalesce(
                    "ruled", F.when(F.col("log_odds") > 0, "block").otherwise("allow")).alias("verdict"),
                    "log_odds", F.col("words").alias("host_words")))


def log_odds(rows, n_allow: int, n_block: int) -> tuple[np.ndarray, float]:
    """Weights by feature and the prior's log odds, with add-one smoothing."""
    if not n_allow or not n_block:
        return np.zeros(FEATURES), 1.0 if n_block else -1.0
    counts = np.ones((2, FEATURES))
    for f, a, b in rows:
        counts[0, f] += a
        counts[1, f] += b
    logs = np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))
    return logs[1] - logs[0], math.log(n_block / n_allow)
