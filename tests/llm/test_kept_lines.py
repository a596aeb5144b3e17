"""Failing lines leave the texts of kept documents, in the operator and in the pipeline."""

import corpus_pipeline

from churnlab.llm.quality_rules import clean_lines, judge, keep_good, line_fails, quality_rules

from .frames import AWKWARD, frame, random_texts

GOOD = "one two three four five six seven eight nine ten eleven twelve."
BAD = ["home | shop | about | contact", "Licensed under the Apache License, é", "a### b*** c%%%", "WOW!! YES!! no no"]


def rows():
    out = [(100 + i, t) for i, t in random_texts(60)] + [(20, GOOD)]
    for k, bad in enumerate(BAD):
        out += [(30 + k, f"{GOOD}\n{bad}\n\nend é"), (40 + k, f"{bad}\n{GOOD}"), (50 + k, f"{GOOD}\n" + f"{bad}\n" * 9)]
    return out


def test_operator(spark):
    given = rows() + AWKWARD
    got = quality_rules(frame(spark, given)).collect()
    assert sorted((str(r.doc_id), r.kept_text) for r in got if r.kept) == sorted((str(i), clean_lines(t)) for i, t in given if judge(t, 0.5)[-1])
    assert all((r.kept_text is not None) == r.kept for r in got) and {30, 41} <= {r.doc_id for r in got if r.kept}


def test_stage(spark):
    given = rows()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in given], "doc_id long, text string, lang string, source string, n_chars long")
    want = sorted((i, clean_lines(t)) for i, t in given if judge(t, 0.5)[-1])
    out = corpus_pipeline.quality_stage(spark, docs, "")
    got = out.collect()
    assert out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType and out.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in got) == want and all(r.n_chars == len(r.text) for r in got)
    assert sorted(r.text for r in keep_good(docs).collect()) == sorted(t for _, t in want)


def test_whole_table(spark):
    """No kept document has a failing line left."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = [x for r in keep_good(docs).select("text").collect() for x in r.text.encode().split(b"\n")]
    before = [x for r in docs.collect() if judge(r.text, 0.5)[-1] for x in r.text.encode().split(b"\n")]
    assert not [x for x in lines if x.split() and line_fails(x, len(x.split()))]
    assert len([x for x in before if x.split() and line_fails(x, len(x.split()))]) == len(before) - len(lines) > 0
