"""The pipeline's rows against its stages run one by one in plain Python where they can be."""

import corpus_pipeline as P
from stratus.llm import mixing, pii, quality_classifier, sentencepiece_codec, simhash
from stratus.llm.common import read

SF = "/root/testdata/sf0.001"


def test_run_applies_every_stage(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    good = {r.doc_id for r in quality_classifier.score_documents(docs, labels).collect() if r.predicted}
    rows = [r for r in docs.collect() if r.doc_id in good]
    prints = {r.doc_id: simhash.fingerprint(r.text) for r in rows}
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    kept = spark.createDataFrame([r for r in rows if find(r.doc_id) == r.doc_id], docs.schema)
    clean = spark.createDataFrame(pii.pseudonymised(kept).collect(), docs.schema)
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix(clean).collect() if r.size}
    vocabulary = sentencepiece_codec.Vocabulary.load()
    text = {r.doc_id: r.text for r in clean.collect()}
    out = P.run(spark, SF).collect()
    assert sorted(r.doc_id for r in out if r.n_pieces) == sorted(d for d, n in taken.items() for _ in range(n))
    assert all(r.exact and r.ids == vocabulary.encode(text[r.doc_id]) for r in out)


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, __text string, threshold int"
    odd = [(1, None, None, None, None, "x", 1), (1, None, None, None, None, "x", 1), (None, "", "", "", 0, None, None),
           (2, "w " * 30_000, "en", "a", 60_000, "y", 2), (3, "a.b@c.example.org and more words here", "en", "a", 37, "z", 3)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            out.count()
        P.STAGES[-1][1](spark, docs, SF).count()


CLASHES = ["__text", "__nth", "__marked", "__found", "__content", "__moved", "__place", "__copy", "__source", "row", "own",
           "content", "marked", "found", "new", "moved", "place", "copy", "threshold", "whole", "id", "same", "root", "fp",
           "component_id", "pattern", "score", "predicted", "held_out", "statistics", "v", "key"]


def test_columns_of_any_name_keep_their_values(spark):
    """Whatever extra columns are called, every stage hands their values on, row by row."""
    texts = ["the first text holds a good many plain words about rivers and boats " * 6,
             "mail a.b@c.example.org or call 415-555-0132 about the second text " * 3,
             "the first text holds a good many plain words about rivers and boats " * 6, None, "", "Mr. John Smith came. " * 9]
    rows = [(i, t, "en", f"s{i % 2}", None if t is None else len(t), *[f"{c}-{i}" for c in CLASHES])
            for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{c}` string" for c in CLASHES)
    docs = spark.createDataFrame(rows, schema)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        kept = out.collect()
        assert kept, name
        for r in kept:
            assert [r[c] for c in CLASHES] == [f"{c}-{r.doc_id}" for c in CLASHES], name
            assert (r.lang, r.source) == ("en", f"s{r.doc_id % 2}"), name
            if name != "pii_surrogates":
                assert (r.text, r.n_chars) == (texts[r.doc_id], rows[r.doc_id][4]), name
    assert P.STAGES[-1][1](spark, docs, SF).count() == len(rows)
