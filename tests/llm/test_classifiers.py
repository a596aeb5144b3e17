"""The two classifiers: held-out accuracy, decoding, awkward rows."""

import itertools
import zlib

import numpy as np
import pytest

from churnlab.llm._trees import fit
from churnlab.llm.common import with_ids
from churnlab.llm.quality_gbt import NAMES, quality_scores, statistics
from churnlab.llm.toxicity import CLASSES, Restorer, decode, language_model, lattice, toxicity_scores

from .frames import AWKWARD, frame

SF = "/root/testdata/sf0.01"


def auc(y, s):
    pairs = [(a > b) + 0.5 * (a == b) for a, b in itertools.product(s[y == 1], s[y == 0])]
    return float(np.mean(pairs))


def tables(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


@pytest.mark.parametrize("score,label,folds,held,least,sf", [
    (quality_scores, "quality", 4, 2, 0.97, SF),
    # a fifth of the labelled documents at sf0.01 has six toxic ones, two of them without a toxic word
    (toxicity_scores, "toxic", 5, 0, 0.97, "/root/testdata/sf0.1")])
def test_held_out(spark, score, label, folds, held, least, sf):
    docs, labels = tables(spark, sf)
    got = score(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) and 0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert auc(np.array([r[label] for r in out]), np.array([r.score for r in out])) >= least
    hit = sum(r[label] == r.predicted for r in out) / len(out)
    assert hit >= 0.95, hit


@pytest.mark.parametrize("score,label", [(quality_scores, "quality"), (toxicity_scores, "toxic")])
def test_held_out_labels_are_not_used(spark, score, label):
    docs, labels = tables(spark, "/root/testdata/sf0.001")
    held = "pmod(crc32(cast(doc_id as string)), 4) = 2" if label == "quality" else "pmod(crc32(cast(doc_id as string)), 5) = 0"
    flipped = labels.selectExpr("doc_id", f"if({held}, 1 - {label}, {label}) as {label}")
    one = {r.doc_id: r.score for r in score(docs, labels).collect()}
    assert one == {r.doc_id: r.score for r in score(docs, flipped).collect()}


@pytest.mark.parametrize("score", [quality_scores, toxicity_scores])
def test_awkward(spark, score):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1), (7, 1, 1), (9, 0, 0), (9, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = score(frame(spark, AWKWARD), labels).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    assert score(frame(spark, AWKWARD).limit(0), labels).count() == 0
    assert score(frame(spark, AWKWARD), labels.limit(0)).count() == len(AWKWARD)


def test_trees():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(4000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    trees = fit(x[:3000], y[:3000])
    assert np.mean((trees.score(x[3000:]) > 0.5) == y[3000:]) > 0.95
    # the arrays against a plain walk
    for row in x[:50]:
        total = trees.base
        for f, t, v in zip(trees.feature, trees.threshold, trees.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > t[node])
            total += v[node - len(f)]
        assert abs(1 / (1 + np.exp(-total)) - trees.score(row[None])[0]) < 1e-12
    assert fit(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]


def test_statistics_of_odd_texts():
    for t in ("", " ", "a", "é\n\n", "x " * 5):
        assert len(statistics(t)) == len(NAMES) and np.isfinite(statistics(t)).all()


def test_viterbi_against_all_readings():
    """The decoder's reading costs as much as the cheapest of all."""
    rnd = np.random.default_rng(3)
    cost = rnd.random((CLASSES,) * 3) * 8

    def price(parts):
        a = b = 0
        c = 0.0
        for text, own in parts:
            c += own
            for ch in text:
                k = ord(ch) - 96 if "a" <= ch <= "z" else 0 if ch == " " else 27
                if k or b:
                    c, a, b = c + cost[a, b, k], b, k
        return c
    for token in ("1d10t", "l.o.5e", "aaab", "m0r0n", "x|y", "sss5"):
        every = [[*p, (" ", 0.0)] for p in itertools.product(*lattice(token))]
        best = min(every, key=price)
        assert decode(token, cost) == "".join(t for t, _ in best).strip()


def test_restoring(spark):
    docs = frame(spark, [(1, "you are an idiot and a moron, a stupid loser. what trash this is. disgusting people " * 30)])
    read = Restorer(language_model(with_ids(docs))).words
    for odd, plain in [("1d10t", "idiot"), ("m0r0n", "moron"), ("stuuupid", "stupid"), ("i d i o t", "idiot"), ("l0s3r!!", "loser"),
                       ("tr@sh", "trash"), ("d-i-s-g-u-s-t-i-n-g", "disgusting"), ("people.", "people"), ("$tupid", "stupid")]:
        assert plain in read(f"well {odd} then"), odd


def test_planted_obfuscations():
    """Every way to hide a word reaches the lattice and is undone, under the language model of the sf0.01 texts."""
    import pyarrow.parquet as pq
    from churnlab.llm import toxicity

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).rename_columns(["_text"])
    counts = list(toxicity._trigrams(iter(texts.to_batches())))

    class Held:  # the counted trigrams, in the place of a frame
        def select(self, *_): return self
        mapInArrow = groupBy = agg = lambda self, *_: self
        def toArrow(self):
            import pyarrow as pa
            return pa.Table.from_batches(counts).group_by("gram").aggregate([("n", "sum")]).rename_columns(["gram", "n"])

    read = Restorer(language_model(Held())).words
    for odd, plain in [("1053r", "loser"), ("m---o---r---o---n", "moron"), ("l***o***s***e***r", "loser"), ("i:d:i:o:t", "idiot"),
                       ("s=c=u=m", "scum"), ("!diot", "idiot"), ("(lown", "clown"), ("iddiott", "idiot"), ("s c u m.", "scum"),
                       ("i d i o t!", "idiot"), ("scumm", "scum"), ("l0s3r", "loser"), ("m.o.r.o.n", "moron"), ("idiot,", "idiot"),
                       ("you-idiot", "idiot"), ("well-known", "known"), ("better", "better")]:
        assert plain in read(f"well {odd} then"), (odd, read(odd))
    assert read("12:30 3.14 2024-01-05 455 km") == ["km"]


def test_language_model_counts_every_text(spark):
    one = language_model(with_ids(frame(spark, [(1, "ab")])))
    many = language_model(with_ids(frame(spark, [(i, "ab") for i in range(50)])))
    assert many[1, 2, 0] < one[1, 2, 0] < np.log2(28)
