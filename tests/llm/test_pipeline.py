"""The pipeline's stages, each against a plain version over its own input."""

from collections import Counter

import corpus_pipeline
from logtide.llm import mixing
from logtide.llm.common import documents
from logtide.session import written
from tests.llm import plain


def test_stages(spark, sf):
    docs, seen = documents(spark, sf), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf), name)
        seen.append((name, docs, out))
        if name != "packing":
            assert out.columns == columns and out.dtypes == docs.dtypes
        docs = out
    by = {name: (a.collect(), b.collect()) for name, a, b in seen}
    before, after = by["language_id"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before if any(c.isalpha() for c in r.text or "")}
    before, after = by["near_duplicates"]
    groups = plain.jaccard_components([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(d for d, (_, c) in groups.items() if d == c)
    before, after = by["pii"]
    texts = {r.doc_id: r.text for r in before}
    assert len(after) == len(before)
    for r in after:
        assert r.n_chars == len(r.text)
        if not plain.pii(texts[r.doc_id]):
            assert r.text == texts[r.doc_id]
        else:
            assert not {k for k, *_ in plain.pii(r.text)} & {"email", "phone"}
    before, after = by["mixing"]
    counts = {r.doc_id: r.copies for r in mixing.mix(seen[3][1]).collect()}
    assert Counter(r.doc_id for r in after) == Counter({d: n for d, n in counts.items() if n})
    assert Counter(r.doc_id for r in by["packing"][1] if r.piece == 0) == Counter(r.doc_id for r in after)


def test_stages_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "one two", "en", "a", 7), (3, "one two", None, None, 7), (3, "one two", None, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, ""), "odd")
        assert docs.count() > 0
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        empty = written(stage(spark, empty, ""), "none")
        assert empty.count() == 0
