"""Components, SimHash and vectors against brute force."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sensorstream.llm import simhash, vectors
from sensorstream.llm.components import components
from sensorstream.llm.entries import op3_embedding_near_dedup, op9_simhash
from sensorstream.llm.simhash import covering_masks, fingerprint, near_duplicates, near_links
from sensorstream.llm.vectors import near_duplicate_vectors

SF = "/root/testdata/sf0.01"


def roots_of(nodes, links):
    """Least reachable node, by union of sets."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(5, 5), (7, 3), (3, 7)]
    links += [(1000 + k, 1001 + k) for k in range(60)]  # a path
    links += [(2000, 2001 + k) for k in range(60)]  # a star
    frame = spark.createDataFrame([*links, (None, 4)], "a long, b long")
    got = {r.node: r.root for r in components(spark, frame).collect()}
    links = [link for link in links if link[0] != link[1]]
    assert got == roots_of({n for link in links for n in link}, links)


def test_no_links_give_no_components(spark):
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def slow_fingerprint(text):
    import re

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_by_hand():
    for text in (None, "", "  ", "a", "A b", "a b c", "a b c a b c a b c d", "Ä É x\x0by\x1cz", "q w e r t y " * 9):
        assert fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_difference(radius):
    masks = covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for bits in itertools.combinations(range(64), radius):
        flipped = sum(1 << b for b in bits)
        assert any(not flipped & m for m in masks)


@pytest.mark.parametrize("most", [2048, 4])
@pytest.mark.parametrize("radius", [1, 2])
def test_links_connect_what_brute_force_connects(spark, radius, most):
    draw = random.Random(most)
    prints = {0, (1 << 64) - 1}
    for _ in range(40):
        at = draw.getrandbits(64)
        for _ in range(8):  # chains of near prints
            prints.add(at)
            for _ in range(draw.randrange(4)):
                at ^= 1 << draw.randrange(64)
    prints |= {0xABC0 ^ (1 << a) ^ (1 << b) for a in range(6) for b in range(6)}
    near = [(a, b) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= radius]
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    got = components(spark, near_links(spark, frame, radius, most=most))
    got = {r.node: r.root for r in got.collect()}
    wanted = roots_of({signed(p) for p in prints}, [(signed(a), signed(b)) for a, b in near])
    assert {n: got.get(n, n) for n in wanted} == wanted


def check_groups(rows):
    """rows: (doc_id, text, fingerprint, component)"""
    prints = {p for _, _, p, _ in rows}
    near = [(a, b) for a, b in itertools.combinations(sorted(prints), 2) if (a ^ b).bit_count() <= 2]
    root = roots_of(prints, near)
    least = {}
    for doc, _, p, _ in rows:
        if doc is not None:
            least[root[p]] = min(doc, least.get(root[p], doc))
    for doc, text, p, component in rows:
        assert p == slow_fingerprint(text)
        assert component == least.get(root[p])


def test_simhash_of_odd_documents(spark, documents, odd_rows):
    docs = documents(odd_rows)
    got, names = near_duplicates(docs)
    rows = got.select("doc_id", "text", names["fingerprint"], names["component"], names["kept"]).collect()
    check_groups([(r[0], r[1], r[2] % (1 << 64), r[3]) for r in rows])
    assert len(rows) == len(odd_rows)
    kept = [(r[3], r[0]) for r in rows if r[4]]
    assert all(a == b for a, b in kept)  # the least id stays, once
    assert len(kept) == len({(r[3], None if r[3] is not None else r[2]) for r in rows})
    assert got.columns[: len(docs.columns)] == docs.columns
    empty, names = near_duplicates(docs.limit(0))
    assert empty.count() == 0


def test_simhash_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op9_simhash(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(r.fingerprint == f"{int(r.fingerprint, 16):016x}" for r in rows)
    check_groups([(r.doc_id, texts[r.doc_id], int(r.fingerprint, 16), r.component_id) for r in rows])
    assert len({r.component_id for r in rows}) < len(rows)


def slow_links(rows, threshold=0.95):
    """Per row its links and least reachable id, from (id, vector)."""
    usable = []
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable.append(k)
    links = []
    for a, b in itertools.combinations(usable, 2):
        x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
        if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
            links.append((a, b))
    root = roots_of(range(len(rows)), links)
    ids = {}
    for k, (i, _) in enumerate(rows):
        ids.setdefault(root[k], []).append(i)
    out = []
    for k, (i, _) in enumerate(rows):
        known = [j for j in ids[root[k]] if j is not None]
        component = min(known, default=None)
        out.append((i, sum(k in link for link in links), component, i == component))
    return out


def clusters(seed, dimension, count, spread):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(count):
        centre = rng.normal(size=dimension)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((centre + rng.normal(size=dimension) * rng.uniform(0, spread)).astype(np.float32).tolist())
    return [(k, v) for k, v in enumerate(rows)]


ODD_VECTORS = [
    (500, None),
    (501, []),
    (502, [0.0] * 8),
    (503, [1.0, None] + [0.0] * 6),
    (504, [float("nan")] + [1.0] * 7),
    (505, [float("inf")] + [1.0] * 7),
    (506, [1.0] * 8),
    (506, [1.0] * 8),
    (507, [2.0] * 8),
    (None, [3.0] * 8),
    (508, [-0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1e-30]),
    (509, [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1e30]),
    (None, [0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0]),
    (510, [1.0, 1.0]),
    (511, [2.0, 2.0]),
    (512, [-1.0] * 8),
]


@pytest.mark.parametrize("most", [1024, 16])
def test_vectors_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(vectors, "MOST", most)
    rows = clusters(1, 8, 40, 0.4) + ODD_VECTORS
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, node string, n int")
    got = near_duplicate_vectors(frame).collect()
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(slow_links(rows), key=key)


def test_vectors_of_many_dimensions(spark):
    rows = clusters(2, 64, 60, 0.3)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: tuple(r) for r in near_duplicate_vectors(frame).collect()}
    wanted = {r[0]: r for r in slow_links(rows)}
    found = sum(r[1] for r in got.values())
    assert found >= 0.99 * sum(r[1] for r in wanted.values()) > 0
    assert all(got[i][1] <= wanted[i][1] for i in wanted)


def test_caps_find_nearly_all_links_at_the_threshold():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * z
    shared = [bool(set(a) & set(b)) for a, b in zip(vectors.cap_filters(x).tolist(), vectors.cap_filters(y).tolist())]
    assert np.mean(shared) > 0.995


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_duplicate_vectors(frame).count() == 0


def test_vector_query_at_a_size_with_links(spark, tmp_path):
    """Clusters whose members lie on both sides of the threshold, a large group of copies, and vectors far apart."""
    rng = np.random.default_rng(8)
    middles = rng.normal(size=(250, 64))
    middles /= np.linalg.norm(middles, axis=1)[:, None]
    spread = rng.uniform(0.1, 0.35, 250)[:, None, None] / 8
    near = (middles[:, None] + spread * rng.normal(size=(250, 16, 64))).reshape(-1, 64)
    matrix = np.concatenate([near, np.repeat(near[:1], 300, axis=0), rng.normal(size=(1000, 64))]).astype(np.float32)
    ids = np.arange(len(matrix))
    rows = [(int(i), v.tolist(), 0) for i, v in zip(ids, matrix)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    frame.repartition(8).write.parquet(str(tmp_path / "embeddings.parquet"))
    matrix = matrix.astype(float)
    matrix /= np.linalg.norm(matrix, axis=1)[:, None]
    links = matrix @ matrix.T >= 0.95
    wanted = links.sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in op3_embedding_near_dedup(spark, str(tmp_path)).collect()}
    found = np.array([got[int(i)] for i in ids])
    assert (found <= wanted).all()
    assert found.sum() >= 0.995 * wanted.sum() > 20_000


def test_hex_of_prints(spark):
    rows = spark.createDataFrame([(0,), (-1,), (255,)], "p long").select(simhash.hex_of(F.col("p"))).collect()
    assert [r[0] for r in rows] == ["0" * 16, "f" * 16, "00000000000000ff"]
