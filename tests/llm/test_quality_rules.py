"""Quality rules against a plain restatement, and on labelled documents."""

import re
from collections import Counter

import pytest

from churnlab.llm.quality_rules import clean_lines, judge, keep_good, line_fails, quality_rules

from .frames import AWKWARD, frame, random_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {p for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for p in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside), failed


@pytest.mark.parametrize("rows", [random_texts(150), AWKWARD, [(1, "x y z p q " * 40), (2, "ab cd ef gh ij kl mn op qr st"),
                                                            (3, "a\x85b c \x1c d " * 20)]])
def test_counts(spark, rows):
    got = sorted((tuple(r) for r in quality_rules(frame(spark, rows)).collect()), key=str)
    want = sorted(((i, *base(t)) for i, t in rows), key=str)
    assert [(*r[:6], r[9]) for r in got] == want


@pytest.mark.parametrize("line,fails", [
    ("A plain sentence, with 5% of nothing.", False), ("a### b*** c%%%", True), ("WOW!! YES!! no no", True),
    ("Really? Yes! Fine.", False), ("home | shop | about | contact", True), ("either | or", False),
    ("Licensed under the Apache License, Version 2.0.", True), ("a » b » c » d", True)])
def test_line_rules(line, fails):
    assert line_fails(line.encode(), len(line.split())) is fails


def test_lost_text():
    good = "one two three four five six seven eight nine ten eleven twelve."
    nav = "home | shop | about | contact"
    assert judge(good + "\n" + nav, 0.5)[-1] and not judge(good + "\n" + (nav + "\n") * 1 + "x | y | z | all\n" * 3, 0.5)[-1]
    assert clean_lines(good + "\n" + nav + "\n\nend") == good + "\n\nend"


def test_keep_good(spark):
    docs = frame(spark, AWKWARD + [(20, " ".join(map(str, range(30))))])
    assert keep_good(docs).columns == docs.columns
    assert [r.doc_id for r in keep_good(docs).collect()] == [20]
    assert keep_good(docs.limit(0)).count() == 0


def test_labelled(spark):
    """Documents labelled good stay unless a base rule rejects them; bad ones go."""
    d = "/root/testdata/sf0.01"
    got = quality_rules(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    good = [r for r in got if r.quality == 1 and not r.base_failed]
    bad = [r for r in got if r.quality == 0]
    assert all(r.kept for r in good) and sum(r.kept for r in bad) <= 0.1 * len(bad)
