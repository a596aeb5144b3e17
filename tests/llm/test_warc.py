"""WARC: an exact round trip, with record boundaries inside payloads."""

import glob
import hashlib
from collections import defaultdict

import numpy as np
import pytest

from churnlab.llm.warc import END, MAGIC, chains, exits, parse_head, reachable, read_warc, warc_round_trip


def want(rows, least):
    groups = defaultdict(list)
    for i, _, t in rows:
        if len((t or "").encode()) >= least:
            groups[t].append(i)
    out = []
    for i, _, t in rows:
        raw = (t or "").encode()
        top = max(groups.get(t, [i]))
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if top == i else "revisit", None if top == i else top))
    return sorted(out)


def pages(spark, rows):
    return spark.createDataFrame([(i, u, t, 1, "t") for i, u, t in rows], "page_id long, url string, html string, _id int, type string")


FAKE = f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:x-page:77>\r\nContent-Length: 3\r\n\r\nabc{END}"
ROWS = [(1, "http://a", None), (2, None, ""), (3, "u\r\nx", "short"), (4, "u", "short"), (5, "u", "é" * 600), (6, "u", "é" * 600),
        (7, "u", f"before {FAKE}after"), (8, "u", FAKE), (9, "u", FAKE * 40), (10, "u", FAKE * 40), (11, "u", MAGIC),
        (12, "u", "x" * 200_000), (13, "u", "\r\n\r\n" + MAGIC[:-1]), (14, "u", "WARC/1.1\r"), (15, "u", "é" * 600), (16, "u", MAGIC * 3),
        (17, "u", f"{MAGIC}WARC-Record-ID: <urn:x-page:{10 ** 30}>\r\nContent-Length: 3\r\n\r\nabc{END}"),
        (18, "u", f"{MAGIC}Content-Length: {10 ** 30}\r\n\r\n"), (19, "u", f"{MAGIC}Content-Length: {10 ** 17}\r\n\r\n")]


@pytest.mark.parametrize("split", ["128m", "3000"])
def test_round_trip(spark, split):
    """Also with archives read in splits that begin anywhere."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = warc_round_trip(pages(spark, ROWS).coalesce(2))
        assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        assert sorted(map(tuple, got.collect())) == want(ROWS, 1000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_are_archives(spark, tmp_path):
    warc_round_trip(pages(spark, ROWS).coalesce(1), path=str(tmp_path / "w")).count()
    (file,) = glob.glob(str(tmp_path / "w" / "part-*"))
    raw, at, n = open(file, "rb").read(), 0, 0
    while at < len(raw):
        assert raw[at:].startswith(MAGIC.encode())
        head, fields = parse_head(raw[at + len(MAGIC):at + 5000])
        at += len(MAGIC) + head + int(fields["content-length"]) + len(END)
        assert raw[at - 4:at] == END.encode()
        n += 1
    assert n == len(ROWS)


def test_repeated_and_null_ids(spark):
    rows = [(None, "u", "z" * 2000), (1, "u", "z" * 2000), (1, "u", "z" * 2000), (1, "v", "other")]
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc_round_trip(pages(spark, rows)).collect()), key=str)
    assert got == sorted([(None, "revisit", 1), (1, "revisit", 1), (1, "response", None), (1, "response", None)], key=str)
    assert warc_round_trip(pages(spark, rows).limit(0)).count() == 0


def test_reachable():
    rnd = np.random.default_rng(0)
    for _ in range(200):
        offsets = np.unique(np.append(0, rnd.integers(0, 60, rnd.integers(1, 30))))
        successors = offsets + rnd.integers(1, 15, len(offsets))
        at, seen = 0, set()
        nxt = dict(zip(offsets.tolist(), successors.tolist()))
        while at in nxt:
            seen.add(at)
            at = nxt[at]
        assert [o in seen for o in offsets.tolist()] == reachable(offsets, successors).tolist()


def test_exits():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        offsets = np.unique(rnd.integers(0, 60, rnd.integers(1, 30)))
        successors = offsets + rnd.integers(1, 15, len(offsets))
        nxt, out = dict(zip(offsets.tolist(), successors.tolist())), []
        for at in offsets.tolist():
            while at in nxt:
                at = nxt[at]
            out.append(at)
        assert out == exits(offsets, successors).tolist()


@pytest.mark.parametrize("part_bytes", [1, 7, 50, 10_000])
def test_chains_over_parts(spark, part_bytes):
    """Chains stitched from parts of any size, false candidates in between, one file without a record at 0."""
    rnd, rows, want = np.random.default_rng(2), [], set()
    for file in "abcd":
        offsets = np.unique(np.append(0, rnd.integers(0, 400, 150)))
        if file == "d":
            offsets = offsets[1:]
        # mostly from one candidate to one of the next
        successors = [int(offsets[min(k + int(rnd.integers(1, 4)), len(offsets) - 1)]) if rnd.random() < 0.97 else int(offsets[k]) + 3
                      for k in range(len(offsets))]
        successors[-1] = 10 ** 18
        nxt = dict(zip(offsets.tolist(), successors))
        rows += [(file, a, b) for a, b in nxt.items()]
        at = 0
        while at in nxt:
            want.add((file, at))
            at = nxt[at]
    heads = spark.createDataFrame(rows, "file string, offset long, next long").repartition(3)
    assert sorted((r.file, r.offset) for r in chains(heads, part_bytes).collect()) == sorted(want)


def test_small_parts(spark, tmp_path):
    """Records and payloads with false boundaries over many parts of a file."""
    path = str(tmp_path / "w")
    whole = warc_round_trip(pages(spark, ROWS).coalesce(1), path=path).collect()
    got = read_warc(spark, path, part_bytes=300).select("record", "payload_bytes", "payload_digest", "type", "refers").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole)) == want(ROWS, 1000)
