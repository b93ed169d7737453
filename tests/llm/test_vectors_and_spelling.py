"""Operators 12 and 13 against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SMOKE_DIR
from zoneflow.llm import embeddings, spelling
from zoneflow.llm.common import WorkTables

# -- operator 12 -----------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<{}>, label int, node string, vec string, n string, dim string, bits string"


def brute_vectors(rows, threshold=0.98):
    fine = [k for k, (i, v, lab) in enumerate(rows) if i is not None and lab is not None and v and None not in v
            and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float) != 0)]
    count, least = [0] * len(rows), list(range(len(rows)))
    edges = []
    for a in fine:
        for b in fine:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                    count[a] += 1
                    count[b] += 1
                    edges.append((a, b))
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            low = min(least[a], least[b])
            moved |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    groups = {}
    for k in fine:
        groups.setdefault(least[k], []).append(rows[k][0])
    return sorted([(i, count[k], min(groups[least[k]]) if k in fine else i,
                    (min(groups[least[k]]) if k in fine else i) == i) for k, (i, _, _) in enumerate(rows)], key=repr)


def got_vectors(spark, rows, kind="float"):
    frame = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], VECTORS.format(kind))
    return sorted([tuple(r) for r in embeddings.near_duplicate_vectors(frame).collect()], key=repr)


def clouds(seed, groups, members, dim, spread, lone=20):
    """Near copies around some centres, and vectors of their own; single precision values."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dim))
    made = [c + spread * np.linalg.norm(c) / np.sqrt(dim) * rng.standard_normal(dim) for c in centres for _ in range(members)]
    made += list(rng.standard_normal((lone, dim)))
    return [np.float32(v).astype(float).tolist() for v in made]


@pytest.mark.parametrize("block", [4, 2048])
@pytest.mark.parametrize("spread", [0.05, 0.14])
def test_vectors_in_cells_and_blocks(lspark, monkeypatch, block, spread):
    """Tiny blocks make cells, visits to other cells and cells split by a hash; spread 0.14 lies about the threshold."""
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "STRIP", 7)
    monkeypatch.setattr(embeddings, "AGAIN", 5)
    vectors = clouds(3, 5, 9, 24, spread)
    rows = [(k, v, k % 2) for k, v in enumerate(vectors)] + [(1000 + k, v, k % 3) for k, v in enumerate(vectors[:20])]
    assert got_vectors(lspark, rows) == brute_vectors(rows)


def test_odd_vectors(lspark):
    near = [1.0, 2.0, 3.0]
    rows = [(1, near, 0), (2, [2.0, 4.0, 6.0], 0), (2, [2.0, 4.0, 6.0], 0), (3, None, 0), (4, [], 0), (5, [0.0, 0.0, 0.0], 0),
            (6, [1.0, None, 3.0], 0), (7, [1.0, float("nan"), 3.0], 0), (8, [float("inf"), 2.0, 3.0], 0), (9, near, None),
            (None, near, 0), (10, near, 1), (11, near[:2], 0), (12, [1.0, 2.0, 3.0, 0.0], 0), (13, [-0.0, 1.0, 0.0], 2),
            (14, [0.0, 1.0, -0.0], 2), (15, [-1.0, -2.0, -3.0], 0), (16, [5.0], 3), (17, [0.1], 3), (18, [-0.1], 3)]
    assert got_vectors(lspark, rows) == brute_vectors(rows)
    assert got_vectors(lspark, [(1, [1e200, 2e200], 0), (2, [1e-200, 2e-200], 0)], "double") == [(1, 1, 1, True), (2, 1, 1, False)]
    assert got_vectors(lspark, []) == []


def test_vectors_of_a_table(lspark):
    frame = lspark.read.parquet(f"{SMOKE_DIR}/embeddings.parquet")
    rows = [tuple(r) for r in frame.select("vec_id", "embedding", "label").collect()]
    assert sorted([tuple(r) for r in embeddings.near_duplicate_vectors(frame, 0.9).collect()], key=repr) == brute_vectors(rows, 0.9)


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(1)
    for dim in (3, 64, 1500):
        x, y = embeddings.unit(rng.standard_normal((50, dim))), embeddings.unit(rng.standard_normal((40, dim)))
        (qx, sx, nx, ex), (qy, sy, _, ey) = embeddings.quantised(x), embeddings.quantised(y)
        whole = embeddings.products(qx, qy)
        assert (whole == qx.astype(np.int64) @ qy.astype(np.int64).T).all()
        assert (np.abs(x @ y.T - whole * sx[:, None] * sy[None]) <= nx[:, None] * ey[None] + ex[:, None] + embeddings.ROUNDING).all()


def test_forest_keeps_components():
    rng = np.random.default_rng(2)
    for n in (1, 5, 60):
        i, j = rng.integers(0, n, (2, n // 2))
        nodes, least = embeddings.forest(n, i, j)
        label = np.arange(n)
        for _ in range(n):
            for a, b in zip(i, j, strict=True):
                label[a] = label[b] = min(label[a], label[b])
        want = np.flatnonzero(label != np.arange(n))
        assert nodes.tolist() == want.tolist() and least.tolist() == label[want].tolist()


# -- operator 13 -----------------------------------------------------------------------

def brute_counts(rows, damage=True):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damage and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                total[run] += 1
    return total


def are_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(total, least=2, lead=10):
    words = {w: n for w, n in total.items() if n >= least}
    form, count = {}, {}
    for w in words:
        near = [v for v in words if abs(len(v) - len(w)) < 2 and are_near(v, w)]
        count[w] = len(near)
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= lead * words[w] else None

    def last(w):
        return w if form[w] is None else last(form[w])

    return {w: (form[w], last(w), n, count[w], words.get(form[w])) for w, n in words.items()}


def got_variants(frame, **more):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(frame, **more).collect()}


def test_words_of_a_table(lspark):
    docs = lspark.read.parquet(f"{SMOKE_DIR}/documents.parquet").limit(60)
    total = brute_counts([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    counts = spelling.word_counts(docs, damage=True)
    assert {r.word: r.n for r in counts.collect()} == dict(total)
    assert got_variants(counts) == brute_variants(total)


@pytest.mark.parametrize("crowded", [0, 10, 100_000])
def test_variants_of_crowded_words(lspark, monkeypatch, crowded):
    """Words that share their first or last letters; with a low bound every bucket is dealt further."""
    monkeypatch.setattr(spelling, "CROWDED", crowded)
    rng = random.Random(11)
    words = {"prefixx" + "".join(rng.choice("abé") for _ in range(rng.randrange(5))) for _ in range(80)}
    words |= {"".join(rng.choice("abé") for _ in range(rng.randrange(2, 5))) + "ending" for _ in range(40)}
    words |= {"aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abaaaaa", "baaaaaa", "aaaaaab", "abababab", "babababa", "ababababa"}
    total = {w: rng.choice([1, 2, 3, 30, 400, 5000]) for w in sorted(words)}
    frame = lspark.createDataFrame(list(total.items()), "word string, n long")
    assert got_variants(frame) == brute_variants(total)


def test_near_words_of_any_length(lspark):
    words = ["ab", "abc", "a", "", "abd", "b", "abcd", "xabcd", "abcdx", "axbcd", "é" * 5000, "é" * 4999 + "x", "é" * 5001]
    frame = lspark.createDataFrame([(w,) for w in words], "word string")
    found = {frozenset(r) for r in spelling.near_words(frame, WorkTables(lspark)).collect()}
    long_enough = [w for w in words if len(w) > 1]
    assert found == {frozenset((a, b)) for a in long_enough for b in long_enough if are_near(a, b)}


def test_chains_ties_and_nulls(lspark):
    rows = [("chained", 100_000), ("chaineds", 10_000), ("chainedss", 1000), ("chainedsss", 100), ("xchainedsss", 2),
            ("tiedword", 20), ("tiedworda", 500), ("tiedwordb", 500), (None, 50), ("rareword", 1), ("rarewords", 40)]
    got = got_variants(lspark.createDataFrame(rows, "word string, n long"))
    assert got == brute_variants({w: n for w, n in rows if w})
    assert got["xchainedsss"][:2] == ("chainedsss", "chained") and got["tiedword"][0] == "tiedworda"
    assert got_variants(lspark.createDataFrame([], "word string, n long")) == {}


def test_odd_documents(lspark, odd, empty, documents):
    from tests.llm.conftest import ODD_ROWS

    rows = [*ODD_ROWS, (20, "ÀÉÎõü×÷ÿ StraßenbahnĀ ABCDEFGH abcdefgh x" * 50)]
    assert {r.word: r.n for r in spelling.word_counts(documents(rows), damage=True).collect()} == dict(brute_counts(rows))
    assert {r.word: r.n for r in spelling.word_counts(odd).collect()} == dict(brute_counts(ODD_ROWS, damage=False))
    assert spelling.word_counts(empty).collect() == []
