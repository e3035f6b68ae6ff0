"""Periodic runs, WARC archives and hard negatives against brute force."""

import gzip
import random
from collections import Counter

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from muster.llm import hard_negatives, periodic_runs, queries, warc
from muster.llm.tables import stored
from muster.session import shared_folder
from verification.compare import rows_of_spark

# Periodic runs


@pytest.mark.parametrize("min_words, exponent", [(24, 3), (2, 2), (3, 3), (6, 2), (10, 4)])
def test_runs_of_small_sequences(min_words, exponent):
    draw = random.Random(min_words)
    for _ in range(400):
        words = [draw.randint(1, draw.randint(1, 3)) for _ in range(draw.randint(1, 60))]
        if draw.random() < 0.5:
            p = draw.randint(1, 9)
            words = [words[i % p] if 5 < i < 50 else w for i, w in enumerate(words)]
        expected = plain.periodic_runs(words, min_words, exponent)
        found = periodic_runs.runs_of(words, min_words, exponent).tolist()
        assert sorted(map(tuple, found), key=lambda r: (r[0], r[2])) == expected
        text = pa.array([" ".join(map(str, words))])
        (row,) = periodic_runs._analysed(text, min_words, exponent)
        assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == expected


def _op11(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_periodic_runs_of_documents(spark, folder, given):
    found = _op11(queries.registered()["op11_periodic_runs"](spark, folder))
    assert found == sorted(plain.op11(given), key=str)
    assert sum(r[1] > 0 for r in found) > 5


def test_periodic_runs_of_edge_cases(documents, edges):
    long_ = " ".join(f"w{i % 1000}" for i in range(30_000)) + " end"
    rows = [*edges, (20, long_), (20, long_), (21, "a b " * 12 + "a"), (22, "x" * 200_000), (23, "same " * 24)]
    df = periodic_runs.periodic_runs(documents(rows))
    found = {(r.document.doc_id, r.document.text): r.periods for r in df.collect()}
    assert df.count() == len(rows)
    for i, t in rows:
        words = plain.WORD.findall(t or "")
        got = found[i, t]
        runs = [(30_000, 1000)] if t == long_ else None
        assert got.n_words == len(words)
        if runs:
            assert [(r.length, r.period) for r in got.runs] == runs
            assert got.collapsed == " ".join(f"w{i}" for i in range(1000)) + " end"
        else:
            expected = plain.periodic_runs(words)
            assert [tuple(r) for r in got.runs] == expected
            gone = {x for s, n, q in expected for x in range(s + q, s + n)}
            assert got.collapsed == " ".join(w for x, w in enumerate(words) if x not in gone)
    assert found[23, "same " * 24].strongest.period == 1
    assert found[1, None].runs == [] and found[1, None].strongest is None


def test_ties_between_runs(documents):
    """Two runs of one exponent: the earlier one is the strongest."""
    text = "a b c d e f g h " * 3 + "| " + "p q r s t u v w " * 3
    (row,) = periodic_runs.periodic_runs(documents([(1, text)])).collect()
    assert [tuple(r) for r in row.periods.runs] == [(0, 24, 8), (25, 24, 8)]
    assert tuple(row.periods.strongest) == (0, 24, 8)


# WARC


def _pages(spark, rows):
    clashing = ("key", "payload", "original", "n", "s1", "record_type", "archive")
    schema = "page_id long, url string, html string, " + ", ".join(f"{c} string" for c in clashing)
    return spark.createDataFrame([(*r, *("x" for _ in clashing)) for r in rows], schema).repartition(3)


BIG = "<p>ünï🙂</p>\r\n\r\n" * 100
PAGES = [
    (1, "http://a/", BIG),
    (2, "http://a/b c\r\nX-Key: 9", BIG),
    (3, None, BIG),
    (3, None, BIG),
    (4, "", None),
    (5, "http://b/", ""),
    (6, "http://c/", "short"),
    (7, "http://c/", "short"),
    (None, "http://d/", BIG),
    (None, None, "no key " * 300),
    (None, None, "no key " * 300),
    (8, "http://e/", "x" * 1000),
    (9, "http://e/", "x" * 1000),
    (10, "http://e/", "y" * 999),
    (11, "http://e/", "y" * 999),
    (12, "http://f/", "".join(map(str, range(400_000)))),
    (13, "http://g/", "a" * 3_000_000),
]


@pytest.mark.parametrize("archive_bytes", [1, 1 << 20])
def test_archives_round_trip(spark, archive_bytes):
    place = shared_folder(spark, "test-warc")
    manifest = warc.write_archives(_pages(spark, PAGES), place, archive_bytes=archive_bytes)
    records = warc.resolved(stored(warc.read_archives(manifest), "test-records"))
    last = {}
    for i, _, t in PAGES:
        if i is not None and t and len(t.encode()) >= 1000:
            last[t] = max(last.get(t, i), i)
    expected = Counter()
    for i, _, t in PAGES:
        other = last.get(t)
        again = other is not None and other != i
        n = len((t or "").encode())
        digest = plain.hashlib.sha1((t or "").encode()).hexdigest()
        payload = None if again else (t or "").encode()
        whole = (t or "").encode()
        expected[i, n, digest, "revisit" if again else "response", other if again else None, payload, whole] += 1
    got = Counter()
    for r in records.collect():
        assert r.problem is None
        key = None if r.key is None else int(r.key)
        refers = r.original and int(r.original.key)
        payload = None if r.payload is None else bytes(r.payload)
        whole = bytes(r.original.payload) if r.original else payload
        got[key, r.payload_bytes, r.payload_digest, r.record_type, refers, payload, whole] += 1
    assert got == expected
    listed = manifest.collect()
    assert sum(m.records for m in listed) == len(PAGES)
    assert len(listed) == len(PAGES) if archive_bytes == 1 else len(listed) <= 3


def test_archive_is_gzip_of_records(spark):
    place = shared_folder(spark, "test-warc")
    (one,) = warc.write_archives(_pages(spark, [(1, "http://a/", "text")]), place).collect()
    data = open(one.archive, "rb").read()
    assert len(data) == one.bytes
    text = gzip.decompress(data).decode()
    assert text.count("WARC-Type: ") == 2
    assert text.endswith("Content-Length: 4\r\n\r\ntext\r\n\r\n")
    assert "WARC-Target-URI: http://a/\r\n" in text


def test_no_archives_of_no_pages(spark):
    manifest = warc.write_archives(_pages(spark, []), shared_folder(spark, "test-warc"))
    assert manifest.count() == 0
    assert warc.resolved(stored(warc.read_archives(manifest), "test-records")).count() == 0


def _problems(data):
    return [r.get("problem") for r in warc.Archive(pa.BufferReader(data), True).records()]


def test_broken_archives():
    good = warc.page_record(1, "http://a/", b"text" * 500, None, "d")
    head = [("WARC-Type", "response"), ("WARC-Payload-Digest", warc.label(b"0" * 20))]
    assert _problems(good + good) == [None, None]
    assert _problems(good + good[:-20]) == [None, "TRUNCATED"]
    flipped = bytearray(good)
    flipped[len(good) // 2] ^= 255
    assert _problems(good + bytes(flipped) + good)[1] is not None
    assert _problems(good + b"no gzip") == [None, "INFLATE"]
    assert _problems(warc.member(head, b"block")) == ["PAYLOAD_DIGEST"]
    plain_text = gzip.decompress(good)
    assert _problems(gzip.compress(plain_text.replace(b"texttext", b"textTEXT", 1))) == ["BLOCK_DIGEST"]
    for a, b, problem in (
        (b"Content-Length: 20", b"Content-Length: 30", "CONTENT_LENGTH"),
        (b"WARC/1.1", b"HTTP/1.1", "HEADER"),
        (b"\r\n\r\n", b"\r\n", None),
    ):
        changed = gzip.compress(plain_text.replace(a, b, 1))
        found = _problems(changed)
        assert len(found) == 1 and found[0] is not None and problem in (None, found[0])
    assert _problems(gzip.compress(b"WARC/1.1\r\n" + b"x" * (warc.MAX_HEAD + warc.CHUNK * 2))) == ["HEADER"]
    assert _problems(b"") == []


# Hard negatives


def _mined(rows, anchors, positives=5, negatives=5):
    """Brute force with whole numbers."""
    usable = []
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        row = (i, y, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v))
        usable.append(row)
    out = []
    for i in sorted({r[0] for r in usable if r[0] in anchors}):
        _, y, v = min(r for r in usable if r[0] == i)
        same, other = set(), set()
        for k, z, w in usable:
            if k != i:
                (same if z == y else other).add((-sum(a * b for a, b in zip(v, w)), k))
        for p, k in sorted(same)[:positives]:
            near = [(s, m) for s, m in sorted(other) if 80 * -p <= 100 * -s <= 100 * -p][:negatives]
            out += [(i, k, rank, m, -p, -s) for rank, (s, m) in enumerate(near, 1)]
    return Counter(out)


def _vectors(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, key string, score string, anchor string, wave string"
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], schema).repartition(3)


def _drawn(n, d, seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(10, d))
    rows = []
    for i in range(n):
        y = int(draw.integers(10))
        rows.append((i, (centres[y] * 0.3 + draw.normal(size=d)).astype(np.float32).tolist(), y))
    return rows


@pytest.mark.parametrize("blocks", [False, True])
def test_hard_negatives(spark, monkeypatch, blocks):
    if blocks:
        for name, value in (("ANCHORS", 3), ("FIRST_WAVE", 8), ("GROWTH", 3), ("TILE", 64), ("STEP", 100)):
            monkeypatch.setattr(hard_negatives, name, value)
    rows = _drawn(400, 20, 1)
    rows += [
        (1000, None, 1), (1001, [], 1), (1002, [1.0, None], 1), (1003, [float("nan")] * 20, 1),
        (1004, [float("inf")] * 20, 1), (1005, rows[5][1], None), (None, rows[5][1], 1), (1006, [0.5] * 3, 2),
        (1007, rows[40][1], 3), (1008, rows[40][1], 3), (1008, rows[40][1], 3), (1009, rows[40][1], 4),
        (40, rows[40][1], rows[40][2]),
    ]
    anchors = {i for i in range(0, 400, 40)} | {1001, 1005, 1006}
    df = hard_negatives.hard_negatives(_vectors(spark, rows), F.col("vec_id").isin(*anchors))
    expected = _mined(rows, anchors)
    got = Counter(
        tuple(r) for r in df.select("anchor", "positive", "rank", "negative", "positive_score", "negative_score").collect()
    )
    assert got == expected and len(expected) > 50


def test_hard_negatives_of_copies_and_huge_values(spark):
    """Ties go to the smaller key; values beyond doubles' whole numbers stay exact."""
    rows = [(i, [1.0, 2.0], i % 2) for i in range(40)]
    rows += [(100 + i, [1e6 + i / 16, 3e5], i % 3) for i in range(12)]
    anchors = {0, 1, 100}
    df = hard_negatives.hard_negatives(_vectors(spark, rows), F.col("vec_id").isin(*anchors))
    assert Counter(tuple(r) for r in df.collect()) == Counter(
        {(a, p, r, n, s, t): c for (a, p, r, n, s, t), c in _mined(rows, anchors).items()}
    )
    beyond = [(1, [1e30], 0), (2, [1e30], 0), (3, [1e30], 1), (4, [-1e30], 1)]
    df = hard_negatives.hard_negatives(_vectors(spark, beyond), F.col("vec_id") == 1)
    assert [r.negative for r in df.collect()] == [3]


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1)], [(1, [1.0], 1), (2, [1.0], 2)], [(1, [1.0], 1), (2, [1.0], 1)]])
def test_no_hard_negatives(spark, rows):
    assert hard_negatives.hard_negatives(_vectors(spark, rows), F.col("vec_id") == 1).count() == 0


def test_bounds_hold():
    draw = np.random.default_rng(3)
    codes = draw.integers(-300, 300, size=(60, 32))
    means, deviations = hard_negatives.summaries(codes)
    exact, at = codes @ codes.T, 0
    for count in hard_negatives.LEVELS:
        m, d = means[:, at : at + count], deviations[:, at : at + count]
        assert (np.abs(exact - m @ m.T) <= d @ d.T + 1e-6).all()
        at += count


def test_query_of_hard_negatives_on_the_table(spark, folder):
    df = queries.registered()["op13_hard_negatives"](spark, folder)
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in table]
    expected = _mined(rows, {r[0] for r in rows if r[0] % 100 == 0})
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert Counter(tuple(r[n] for n in names) for r in df.collect()) == expected
    assert rows_of_spark(df).total() == expected.total()
