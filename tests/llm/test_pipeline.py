"""The pipeline, stage by stage, against plain Python."""

import numpy as np
import pytest

import corpus_pipeline
from churnlab.llm.common import with_ids
from churnlab.llm.quality_rules import clean_lines, judge

from .frames import AWKWARD, frame, random_texts
from .test_dedup import brute_components, brute_fp
from .test_packing import want_ids
from .test_suffix_dedup import brute as brute_suffixes


def plain(rows):
    """[(doc_id, text)] after each of the first four stages."""
    out = [[(i, clean_lines(t)) for i, t in rows if judge(t, 0.5)[-1]]]
    last = {t: i for i, t in sorted(out[0])}
    out.append([(i, t) for i, t in out[0] if last[t] == i])
    ids = sorted(out[1])
    roots = brute_components([brute_fp(t, 3) for _, t in ids], 2)
    out.append([r for k, r in enumerate(ids) if roots[k] == k])
    out.append([(i, kept.decode("utf-8", "ignore")) for i, _, _, _, kept in brute_suffixes(out[2], 100)])
    return out


def table(spark, rows, path):
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    return docs


def test_stages(spark, tmp_path):
    rows = [(i, t) for i, t in random_texts(200, 8, words=200, size=60)] + [r for r in AWKWARD if r[0] and r[0] != 9]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    docs = table(spark, rows, tmp_path)
    want = plain(rows)
    for (name, stage), expected in zip(corpus_pipeline.STAGES, want):
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        got = docs.collect()
        assert sorted((r.doc_id, r.text) for r in got) == sorted(expected), name
        assert all(r.n_chars == len(r.text) and r.lang == "en" for r in got), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in want[3]}
    used = {}
    for r in packed:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 1024
    total = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in total) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed)


def near_roots(texts):
    """Smallest position of each text's group of near copies."""
    return brute_components([brute_fp(t, 3) for t in texts], 2)


@pytest.mark.parametrize("rows", [[], AWKWARD])
def test_awkward(spark, tmp_path, rows):
    """Null and repeated ids, null texts and no rows at all: what each stage alone leaves of them."""
    docs = table(spark, AWKWARD, tmp_path).limit(len(rows))
    texts = [t for _, t in rows]
    ordered = [(r._id, r._text) for r in with_ids(docs).orderBy("_id").collect()]
    kept = [t for _, _, _, _, t in brute_suffixes(ordered, 100)]
    sizes = [len(p) for _, p in want_ids(rows, 1024).values()]
    want = {"quality_rules": sorted(clean_lines(t) for t in texts if judge(t, 0.5)[-1]),
            "exact_dedup": sorted({t or "" for t in texts}),
            "simhash_near_dedup": len(set(near_roots(texts))),
            "suffix_dedup": sorted(t.decode("utf-8", "ignore") for t in kept),
            "best_fit_packing": sum(sizes)}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, str(tmp_path)).collect()
        assert (len(got) if isinstance(want[name], int) else sorted(r.text or "" for r in got)) == want[name], name


def test_near_stage_keeps_the_first_of_a_group(spark, tmp_path):
    """Copies that differ in one word of many are one group; other texts stay."""
    base = random_texts(1, 5, words=300, size=400)[0][1] + " end of it all"
    rows = [(k, t) for k, t in enumerate([base, base + " more", base.replace(" end", " END"), "another text " * 5, base])]
    rows += [(100 + i, t) for i, t in random_texts(60, 9, words=300, size=80)]
    got = corpus_pipeline.STAGES[2][1](spark, table(spark, rows, tmp_path), str(tmp_path)).collect()
    roots = near_roots([t for _, t in rows])
    assert sorted(r.doc_id for r in got) == [rows[k][0] for k in sorted(set(roots))]


def test_order_of_repeated_ids(spark):
    """Rows of one id are numbered alike whatever the number of partitions."""
    seen = set()
    for n in (1, 4, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            docs = frame(spark, [(5 if i % 3 else None, f"t{i % 700}") for i in range(2000)])
            seen.add(tuple(r._text for r in with_ids(docs).orderBy("_id").collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(seen) == 1


def test_clean_documents_stay(spark):
    """Of documents labelled good, those that no base rule rejects stay in the first stage."""
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, d).collect()}
    good = spark.read.parquet(f"{d}/labels.parquet").where("quality = 1").join(docs, "doc_id").collect()
    assert np.mean([r.doc_id in kept for r in good if not judge(r.text, 0.5)[-2]]) == 1
