"""Repeated passages, periodic runs and hard negatives against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sensorstream.llm import entries, negatives, periodic, repeats

SF_DIR = "/root/testdata/sf0.001"
NEAR = "the quick brown fox jumps over the lazy dog and runs away from every hound that follows it "
VECTORS = "vec_id long, embedding array<float>, label int"


# --- repeated passages ----------------------------------------------------------


def plain_spans(texts, length=100):
    """Removed runs of texts in corpus order, position by position."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        covered = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            piece = data[i : i + length]
            if piece in seen:
                covered[i : i + length] = True
            seen.add(piece)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], covered])))
        out.append([tuple(e) for e in edges.reshape(-1, 2).tolist()])
    return out


def spans_of(frame, names, *columns):
    rows = frame.select(*columns, names["n_bytes"], names["spans"], names["kept"]).collect()
    return {
        tuple(r[: len(columns)]): (r[-3], [(s.begin, s.end) for s in r[-2]], bytes(r[-1])) for r in rows
    }


def left_of(text, spans):
    data, ends = (text or "").encode(), [0, *(e for _, e in spans)]
    return b"".join(data[a:b] for a, b in zip(ends, [*(b for b, _ in spans), len(data)]))


def shared_texts(seed, count=60):
    """Texts that share passages cut at arbitrary places, with small changes."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(10, 120))) for _ in range(4)]
    passages += ["x" * 300, "ab" * 200, "ü😀" * 60]
    texts = []
    for _ in range(count):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            cut = p[a : rng.randint(a, len(p))]
            if cut and rng.random() < 0.5:
                k = rng.randrange(len(cut))
                cut = cut[:k] + rng.choice("XY") + cut[k + 1 :]
            parts += [cut, " ".join(word() for _ in range(rng.randint(0, 20)))]
        texts.append(" ".join(parts))
    return texts + texts[:5]


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, documents, seed):
    texts = shared_texts(seed)
    docs = documents([(3 * k - 50, t) for k, t in enumerate(texts)]).repartition(5)
    found, names = repeats.without_repeats(docs)
    assert found.columns[: len(docs.columns)] == docs.columns
    got, want = spans_of(found, names, "doc_id"), plain_spans(texts)
    assert sum(map(len, want)) > 30
    for k, (text, spans) in enumerate(zip(texts, want)):
        assert got[(3 * k - 50,)] == (len(text.encode()), spans, left_of(text, spans))


def test_repeats_when_every_core_counts_as_frequent(spark, documents, monkeypatch):
    monkeypatch.setattr(repeats, "SAMPLE", 1)
    monkeypatch.setattr(repeats, "HOT_ROWS", 2)
    monkeypatch.setattr(repeats, "HOT_SHARE", 0)
    texts = shared_texts(3)
    found, names = repeats.without_repeats(documents(list(enumerate(texts))).repartition(7))
    got = spans_of(found, names, "doc_id")
    assert [got[(k,)][1] for k in range(len(texts))] == plain_spans(texts)


def test_repeats_of_other_lengths(spark, documents):
    texts = shared_texts(4, 25)
    for length in (24, 57, 300):
        found, names = repeats.without_repeats(documents(list(enumerate(texts))), length=length)
        got = spans_of(found, names, "doc_id")
        assert [got[(k,)][1] for k in range(len(texts))] == plain_spans(texts, length)
    with pytest.raises(ValueError):
        repeats.gram_of(23)


def test_repeats_of_odd_rows(spark, documents, odd_rows):
    found, names = repeats.without_repeats(documents(odd_rows))
    rows = found.select("doc_id", "text", names["n_bytes"], names["spans"], names["kept"]).collect()
    assert len(rows) == len(odd_rows)
    by = {}
    for doc_id, text, size, spans, kept in rows:
        spans = [(s.begin, s.end) for s in spans]
        assert size == len((text or "").encode()) and bytes(kept) == left_of(text, spans)
        by.setdefault(doc_id, []).append(spans)
    long = len(odd_rows[9][1])
    # The long text comes first in document 9; 11 repeats it whole, 10 up to its tail.
    assert [by[9][0], by[10][0]] == plain_spans([odd_rows[9][1], odd_rows[10][1]])
    assert by[11] == [[(0, long)]]
    assert by[13] == [[(1, 70_000)]]
    assert all(not spans for k in (1, 2, 3, 4, 5, 6, 7, 8, 12, None) for spans in by[k])
    empty, names = repeats.without_repeats(documents([]))
    assert empty.collect() == [] and names["spans"] in empty.columns


def test_repeated_rows_and_null_ids_come_last(spark, documents):
    text = NEAR * 2
    rows = [(None, text), (7, text), (7, text), (5, "short"), (9, "a" + text[1:])]
    found, names = repeats.without_repeats(documents(rows))
    got = sorted(
        (r.doc_id is None, r.doc_id, len(r[names["kept"]]))
        for r in found.select("doc_id", names["kept"]).collect()
        if r.doc_id != 5
    )
    # One of the rows of document 7 keeps what is new in it; the others lose all but what differs.
    first = plain_spans([text])[0]
    kept = len(left_of(text, first))
    assert got == [(False, 7, 0), (False, 7, kept), (False, 9, 1), (True, None, 0)]


def test_ranges_do_not_depend_on_pieces(monkeypatch):
    texts = [t.encode() for t in shared_texts(5, 20)]
    column = pa.array([None, b"", *texts, b"y" * 5000], pa.binary())

    def starts(piece):
        monkeypatch.setattr(repeats, "PIECE", piece)
        held = repeats.Texts(column, 208)
        out = {}
        for rows, first, last, anchor, names in repeats.ranges_of(held, 100):
            for r, a, b, c, n in zip(rows, first, last, anchor, names):
                out |= {(r, k): (c, n) for k in range(a, b + 1)}
        return out

    whole = starts(1 << 16)
    assert starts(301) == whole
    sizes = [0, 0, *map(len, texts), 5000]
    assert len(whole) == sum(max(0, s - 99) for s in sizes)


def test_op13_equals_brute_force_on_its_table(spark):
    docs = {r.doc_id: r.text for r in entries.table(spark, SF_DIR, "documents").collect()}
    got = {r.doc_id: r for r in entries.op13_suffix_dedup(spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    ids = sorted(docs)
    for k, spans in zip(ids, plain_spans([docs[k] for k in ids])):
        size = len((docs[k] or "").encode())
        removed = sum(e - b for b, e in spans)
        kept = hashlib.sha256(left_of(docs[k], spans)).hexdigest()
        assert tuple(got[k]) == (k, size, removed, len(spans), kept)


# --- periodic runs --------------------------------------------------------------


def plain_runs(words, least=12):
    found = {}
    ids = {w: k for k, w in enumerate(dict.fromkeys(words))}
    w = np.array([ids[x] for x in words], int)
    for q in range(1, len(w) // 2 + 1):
        same = np.concatenate([[False], w[:-q] == w[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2)
        for begin, end in edges.tolist():
            if end - begin + q >= max(least, 2 * q):
                found.setdefault((begin, end + q - begin), q)
    return sorted((s, q, n) for (s, n), q in found.items())


def as_sorted(rows):
    return sorted((s, q, n) for s, n, q in rows.tolist())


def repetitive(rng):
    letters = rng.choice([1, 2, 2, 3, 5, 50])
    text = [rng.randrange(letters) for _ in range(rng.randint(0, 300))]
    for _ in range(rng.randint(0, 4) if text else 0):
        s = rng.randrange(len(text))
        part = text[s : s + rng.randint(1, 150)]
        text = text[:s] + part * rng.randint(1, 4) + part[: rng.randint(0, len(part))] + text[s + len(part) :]
    return text


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [repetitive(rng) for _ in range(150)]
    thue = [0]
    for _ in range(10):
        thue += [1 - x for x in thue]
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    texts += [thue, thue + thue[3:], b, [0] * 2000, ([0] * 300 + [1]) * 5, ([0] * 137 + [1] + [0] * 90 + [2]) * 4]
    for text, rows in zip(texts, periodic.runs_of(texts)):
        assert as_sorted(rows) == plain_runs(text)
    assert any(rows[:, 2].max(initial=0) > 128 for rows in periodic.runs_of(texts))


def test_runs_survive_misleading_hashes(monkeypatch):
    """With equal hashes everywhere, extensions go too far and the words themselves decide."""
    rng = random.Random(9)
    texts = [repetitive(rng) for _ in range(40)]
    monkeypatch.setattr(periodic._Extension, "_equal", lambda self, b, e, q: np.ones(len(b), bool))
    for text, rows in zip(texts, periodic.runs_of(texts)):
        assert set(as_sorted(rows)) <= set(plain_runs(text))


def test_runs_of_many_equal_words_stay_cheap():
    rows = periodic.runs_of([["a"] * 300_000, ["b"] * 11, ["c"] * 12])
    assert [r.tolist() for r in rows] == [[[0, 300_000, 1]], [], [[0, 12, 1]]]


def test_runs_of_odd_rows(spark, documents, odd_rows):
    docs = documents([*odd_rows, (20, "x y " * 6 + "z"), (21, "Ü x " * 9)])
    found, names = periodic.with_runs(docs)
    assert found.columns[: len(docs.columns)] == docs.columns
    rows = found.select("text", names["runs"], names["collapsed"]).collect()
    assert len(rows) == len(odd_rows) + 2
    for text, runs, left in rows:
        words = (text or "").encode().split()
        got = [(r.start, r.period, r.length) for r in runs]
        if len(words) < 5000:
            assert got == plain_runs(words)
        else:
            assert got == [(0, 977, 60_000)]  # alone or before a tail
        dropped = {k for s, q, n in got for k in range(s + q, s + n)}
        assert left.encode() == b" ".join(w for k, w in enumerate(words) if k not in dropped)
    empty, names = periodic.with_runs(documents([]))
    assert empty.collect() == [] and names["runs"] in empty.columns


def plain_op12(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=(None,) * 3)
    dropped = {k for s, q, length in runs for k in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
    left = b" ".join(w for k, w in enumerate(words) if k not in dropped)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    s, q, length = best
    exponent = None if s is None else 1000 * length // q
    return (doc_id, len(runs), s, length, q, exponent, sha(lines.encode()), sha(left))


def test_op12_equals_brute_force_on_its_table(spark):
    got = {r.doc_id: tuple(r) for r in entries.op12_periodic_runs(spark, SF_DIR).collect()}
    docs = entries.table(spark, SF_DIR, "documents").collect()
    assert len(got) == len(docs)
    for r in docs:
        if len(r.text or "") < 60_000:
            assert got[r.doc_id] == plain_op12(r.doc_id, r.text)
    assert sum(row[1] > 0 for row in got.values()) > 10


# --- hard negatives -------------------------------------------------------------


def plain_negatives(rows, anchors, positives=5, count=3, low=50, high=95):
    """(anchor, positive, rank, negative, scores) of (id, label, vector) rows."""
    width = max((len(v) for _, _, v in rows), default=0)
    rows = [(i, lab, [*v, *[0] * (width - len(v))]) for i, lab, v in rows]
    out = []
    for k, (a, label, v) in enumerate(rows):
        if not anchors(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, lab) for j, (i, lab, w) in enumerate(rows) if j != k)
        near = [(i, -s) for s, i, lab in scored if lab == label][:positives]
        for p, ps in near:
            far = [(i, -s) for s, i, lab in scored if lab != label and low * ps <= -100 * s <= high * ps]
            out += [(a, p, rank + 1, i, ps, s) for rank, (i, s) in enumerate(far[:count])]
    return sorted(out)


def vector_rows(seed, count=400, width=6):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(5, width)) * 200
    rows = []
    for k in range(count):
        v = (middles[k % 5] + rng.normal(size=width) * 60).astype(int).tolist()
        rows.append((k, int(rng.integers(0, 4)), v))
    rows += [(count + k, k % 2, rows[0][2]) for k in range(60)]  # copies of one vector
    rows += [(500 + k, 1, [0] * width) for k in range(5)] + [(600, 2, [7, -7]), (601, 2, [])]
    return rows


@pytest.mark.parametrize("cell", [16, 4096])
def test_negatives_equal_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(negatives, "CELL", cell)
    rows = vector_rows(cell)
    frame = spark.createDataFrame(rows, "id long, label long, v array<long>").repartition(6)
    got = negatives.hard_negatives(frame, F.col("id") % 20 == 0).collect()
    want = plain_negatives(rows, lambda i: i % 20 == 0)
    assert sorted(map(tuple, got)) == want and len(want) > 150


def test_negatives_of_odd_rows(spark):
    big = 1 << 61
    rows = [
        (1, 0, [10, 0]),
        (1, 0, [10, 0]),  # the same row again: each is the other's positive
        (2, 1, [9, 0]),
        (3, 1, [8, 1]),
        (4, None, [9, 0]),
        (None, 1, [9, 0]),
        (5, 1, None),
        (6, 1, [9, None]),
        (7, 5, [big, big]),
        (8, 5, [big, big]),
        (9, 6, [-big, -big]),
    ]
    frame = spark.createDataFrame(
        [(*r, "x") for r in rows], "id long, label long, v array<long>, place string"
    ).withColumn("cell", F.lit("clash"))
    got = sorted(map(tuple, negatives.hard_negatives(frame, F.col("id") == 1).collect()))
    one = [(1, 1, 1, 2, 100, 90), (1, 1, 2, 3, 100, 80)]
    assert got == sorted(one + one)
    assert negatives.hard_negatives(frame, F.col("id") == 7).collect() == []
    assert negatives.hard_negatives(frame.limit(0), F.col("id") == 1).collect() == []
    assert negatives.hard_negatives(frame, F.lit(None).cast("boolean")).collect() == []


def test_tree_covers_and_prunes():
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(12, 16)) * 400
    points = (middles[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 16)) * 20).astype(np.int64)
    labels = rng.integers(0, 3, 3000)
    tree = negatives.CoverTree(points, labels, np.arange(3000), np.arange(3000))
    wide = tree.points.astype(float)
    lifted = np.column_stack([wide, np.sqrt(np.maximum(tree.top - (wide * wide).sum(axis=1), 0))])
    for node in range(len(tree.radius)):
        inside = lifted[tree.begin[node] : tree.end[node]]
        middle = np.append(tree.centres[node], np.sqrt(max(tree.top - tree.centres[node] @ tree.centres[node], 0)))
        assert np.sqrt(((inside - middle) ** 2).sum(axis=1)).max() <= tree.radius[node] + 1e-6
        below = tree.below(np.array([node]))
        assert (tree.radius[below] <= tree.radius[node] / 2 + 1e-6).all()
        assert (tree.end[below] - tree.begin[below]).sum() in (0, len(inside))
    computed = []
    plain = tree.scores
    tree.scores = lambda rows, anchor: (computed.append(len(rows)), plain(rows, anchor))[1]
    goal = negatives.Goal(5, 1, True, -np.inf, np.inf)
    tree.search(points[0], {0: goal}.values())
    scores = sorted((-(points[labels == 1] @ points[0])).tolist())[:5]
    assert [s for s, _, _ in goal.best] == scores
    assert sum(computed) < 1500  # most leaves are never looked at


def test_op11_with_vectors_that_take_no_part(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=4).round(2).tolist(), int(k % 3)) for k in range(120)]
    odd = [
        (200, None, 1), (250, [float("nan"), 1.0, 1.0, 1.0], 1), (300, [float("inf"), 1.0, 1.0, 1.0], 1),
        (350, [None, 1.0, 1.0, 1.0], 1), (400, [1.0, 1.0, 1.0, 1.0], None), (None, [1.0] * 4, 1),
    ]
    frame = spark.createDataFrame(rows + odd, VECTORS)
    frame.write.parquet(str(tmp_path / "embeddings.parquet"))
    got = entries.op11_hard_negatives(spark, str(tmp_path)).collect()
    kept = [
        (k, (lab + 1) % 10 if k % 7 == 0 else lab, np.floor(256 * np.float32(v).astype(float)).astype(int).tolist())
        for k, v, lab in rows
    ]
    assert sorted(map(tuple, got)) == plain_negatives(kept, lambda i: i % 50 == 0) != []
