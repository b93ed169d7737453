"""Operator 5 against brute force over full shingle sets."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.conftest import SMOKE_DIR
from zoneflow.llm import common, setsketch
from zoneflow.llm.components import connected_components


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(rows, size, percent):
    sets = {i: shingles(t, size) for i, t in rows}
    found = {i: i for i in sets}
    changed = True
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            least = min(found[a], found[b])
            if found[a] != least or found[b] != least:
                found[a] = found[b] = least
                changed = True
    return {i: (len(sets[i]), found[i], found[i] == i) for i in sets}


def family(seed, n, words, edits):
    """A text and copies of it with more and more words replaced."""
    rng = random.Random(seed)
    base = [f"{seed}w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for k in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1) if k else 0):
            copy[rng.randrange(words)] = f"e{rng.randrange(10 ** 9)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_matches_brute_force_on_tables(lspark, size):
    docs = lspark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in setsketch.near_duplicates(docs, size).collect()}
    assert got == brute(rows, size, 80)


def test_wide_families_keep_every_link(lspark, documents, monkeypatch):
    """Families whose members are linked only through others, in buckets of several blocks."""
    monkeypatch.setattr(setsketch, "BLOCK", 8)
    texts = [t for seed in range(3) for t in family(seed, 40, 60, 9)]
    rows = [(1000 - k, t) for k, t in enumerate(texts)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in setsketch.near_duplicates(documents(rows), 2).collect()}
    assert got == brute(rows, 2, 80)


def test_odd_rows(odd, empty):
    rows = setsketch.near_duplicates(odd, 2).collect()
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows}
    assert len(rows) == 12
    assert {(2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (1, 9, 1, True), (6, 9, 1, False), (7, 1, 7, True),
            (8, 1, 7, False), (None, 9, None, True), (None, 0, None, True)} <= got
    assert setsketch.near_duplicates(empty, 2).collect() == []


def test_one_of_each_group_stays(odd, empty):
    kept = setsketch.drop_near_duplicates(odd, 5)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [-9, 1, 2, 3, 4, 5, 7]
    assert kept.filter("doc_id is null").count() == 2
    assert setsketch.drop_near_duplicates(empty, 5).count() == 0


def test_registers_merge_by_maximum_and_estimate_similarity():
    rng = np.random.default_rng(5)
    a, b, both = (rng.integers(0, 2 ** 63, n).astype(np.uint64) for n in (200, 300, 700))
    x, y, xy = np.concatenate([a, both]), np.concatenate([b, both]), np.concatenate([a, b, both])
    rx, ry, rxy = (setsketch.registers(s, np.array([0]))[0] for s in (x, y, xy))
    assert (np.maximum(rx, ry) == rxy).all()
    found = setsketch.estimate_similarity(rx[None], ry[None], np.array([900]), np.array([1000]))[0]
    assert abs(found - 700 / 1200) < 0.15


def test_components_of_a_long_chain_and_loops(lspark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, 7), (3, 2), (2, 3), (None, 5)]
    got = dict(map(tuple, connected_components(lspark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{k: 100 for k in range(100, 161)}, 2: 2, 3: 2}
    assert connected_components(lspark.createDataFrame([], "a long, b long")).collect() == []


def test_shingles_of_many_texts_are_made_together(monkeypatch):
    rng = random.Random(8)
    texts = [None, b"", b" \n", b"\t a  B\x0b\x0cc \r", b"one", "X É é x".encode(), b"\xff a\x1cb",
             *(b" ".join(rng.choice([b"a", b"B", b"cc", b"d,"]) for _ in range(rng.randint(0, 40))) for _ in range(300)), b""]
    codes = common.WordCodes(texts)
    for text, a, b in zip(texts, codes.offsets[:-1], codes.offsets[1:], strict=True):
        assert [codes.words[c] for c in codes.codes[a:b]] == common.words_of(text)
    assert len(set(codes.words)) == len(codes.words)
    hashes = codes.hashes()
    for size in (1, 2, 5):
        want = [common.shingle_hashes(codes.codes[a:b], hashes, size) for a, b in zip(codes.offsets[:-1], codes.offsets[1:], strict=True)]
        for block in (7, 1 << 15):
            got = list(common.text_shingles(codes.codes, codes.offsets, hashes, size, block))
            assert len(got) == len(want) and all(np.array_equal(x, y) for x, y in zip(got, want, strict=True))
        assert all(np.array_equal(common.distinct(x), np.unique(x)) for x in want)
    calls = []
    plain = common.shingle_hashes
    monkeypatch.setattr(common, "shingle_hashes", lambda *a: calls.append(len(a[0])) or plain(*a))
    assert sum(map(len, common.text_shingles(codes.codes, codes.offsets, hashes, 2))) > 1000
    assert sum(n >= 2 for n in calls) == 1   # before: once a text
