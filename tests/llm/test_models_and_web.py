"""Operators 2, 6, 7, 8, the registered queries with SQL, and the pipeline."""

from __future__ import annotations

import collections
import math
import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tests.conftest import SMOKE_DIR
from tests.oracle_check import compare, duck
from zoneflow.llm import brown, queries, tiling, toxicity, url_rules, warc
from zoneflow.session import scratch_dir

TABLES = SMOKE_DIR.replace("sf0.001", "sf0.01")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    ok, said = compare(spark, duck(TABLES), TABLES, name, queries.QUERIES[name], queries.ORACLES[name])
    assert ok, said


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


# -- 2: WARC -------------------------------------------------------------------------

def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, segment string, record string")


def test_audit_finds_changed_records_only(lspark):
    rng = random.Random(6)
    rows = [(k * 37 - 500, f"http://a/{k}", "".join(rng.choice("ab\r\n<é") for _ in range(rng.randint(0, 60))), "s", None)
            for k in range(400)] + [(None, None, None, None, None), (5, "u\r\nx", "WARC/1.1\r\n\r\nWARC/1.1\r\n", None, "r")]
    hurt = [(i, u, (h or "") + "!" if i in (-500, 5, 3200) else h, s, r) for i, u, h, s, r in rows]
    made = [warc.read_records(lspark, warc.write_warc(pages(lspark, x), scratch_dir(lspark, "w"))) for x in (rows, hurt, [])]
    assert made[0].count() == len(rows) and made[2].count() == 0
    assert sorted(r.page_id for r in made[0].filter("page_id is not null").collect()) == sorted(r[0] for r in rows if r[0] is not None)
    found = warc.audit(made[0], made[1]).collect()
    assert sorted((r.page_id, r.status) for r in found) == [(-500, "changed"), (5, "changed"), (3200, "changed")]
    assert warc.audit(made[0], made[0]).collect() == []
    assert warc.audit(made[2], made[2]).collect() == []


def differences(spark, one, two):
    made = [warc.read_records(spark, warc.write_warc(pages(spark, x), scratch_dir(spark, "w"))) for x in (one, two)]
    return sorted(((r.page_id, r.status) for r in warc.audit(*made).collect()), key=repr)


def test_lost_and_extra_records_move_no_others(lspark):
    rows = [(k, f"http://a/{k}", f"page {k % 7}" * (k % 40), "s", None) for k in range(300)]
    rows += [(70_000, "u", "far", None, None), (-3, "u", "below", None, None), (None, "a", "one", None, None), (None, "b", "two", None, None)]
    rows += [(100, "again", f"copy {k}", None, None) for k in range(3)] + [(101, "again", "equal", None, None)] * 3
    assert differences(lspark, rows, rows[:3] + rows[4:]) == [(3, "missing")]
    lost = [r for r in rows[:-1] if r[0] not in (0, 250, 70_000, -3) and r[2] not in ("two", "copy 1")]
    lost = [(i, u, "other" if i == 17 else h, s, r) for i, u, h, s, r in lost] + [(9000, "new", "page", None, None)]
    gone = [(k, "missing") for k in (0, 250, 70_000, -3, None, 100, 101)]
    assert differences(lspark, rows, lost) == sorted([*gone, (17, "changed"), (9000, "extra")], key=repr)


def test_records_keep_their_order_and_offsets_over_files(lspark, monkeypatch):
    import gzip
    from pathlib import Path

    rows = [(k, f"http://a/{k}", f"page {k}" * (k % 90 + 1), "s", None) for k in range(60)] + [(7, "long", "é" * 400_000, None, None)]
    monkeypatch.setattr(warc, "PART_BYTES", 2500)
    path = warc.write_warc(pages(lspark, rows), scratch_dir(lspark, "w"))
    found = warc.read_records(lspark, path).orderBy("position").collect()
    assert [r.position for r in found] == list(range(61)) and [r.page_id for r in found] == sorted(r[0] for r in rows)
    assert all(a.offset + a.length + 4 == b.offset for a, b in zip(found, found[1:], strict=False))
    files = sorted(Path(path.replace("file:", "", 1)).rglob("*.txt.gz"), key=lambda f: int(f.parent.name.split("=")[1]))
    assert len(files) > 5
    text = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    for r in found:
        assert hashlib.sha256(text[r.offset:r.offset + r.length]).hexdigest() == r.digest


def test_damaged_gzip_is_read_as_far_as_it_goes():
    import gzip

    whole = gzip.compress(b"a" * 100) + gzip.compress(b"b" * 100)
    assert warc.inflated(whole) == b"a" * 100 + b"b" * 100
    assert warc.inflated(whole[:-20])[:100] == b"a" * 100 and warc.inflated(b"junk") == b""


def test_parser_resynchronises_after_a_wrong_length():
    good = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc"
    bad = b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"
    data = good + warc.GAP + bad + warc.GAP + good + warc.GAP
    assert [(o, n) for o, n, _, _ in warc.parse(data)] == [(0, 34), (38, 34), (76, 34)]


# -- 6: toxicity ----------------------------------------------------------------------

def test_toxicity_on_held_out_rows(lspark):
    sf = SMOKE_DIR.replace("sf0.001", "sf0.1")
    labels = {r.doc_id: r.toxic for r in lspark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.QUERIES["op6_toxicity_kneser_ney"](lspark, sf).collect()
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    bad, good = ([s for s, y in held if y == k] for k in (1, 0))
    assert np.mean([(b > g) + (b == g) / 2 for b in bad for g in good]) > 0.92
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.92


def test_toxicity_of_odd_rows_and_without_labels(lspark, odd, empty, documents):
    nasty = [(k, f"w{k} plain w{k % 7} " + ("grobian snarl" if k % 2 else "gentle words") + f" x{k}") for k in range(120)]
    labels = lspark.createDataFrame([(k, k % 2, None) for k in range(120)] + [(None, 1, "z"), (3, 1, "z"), (500, None, "z")],
                                    "doc_id long, toxic int, fold string")
    model = toxicity.fit(documents(nasty), labels)
    got = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(documents(nasty), model).collect()}
    assert np.mean([got[k] == k % 2 for k in got]) > 0.97
    scores = toxicity.toxicity_scores(odd, model).collect()
    assert len(scores) == 12 and all(0 <= r.score <= 1 for r in scores)
    assert {r.doc_id for r in toxicity.drop_toxic(odd, model).collect()} >= {2, 3, 4}
    assert toxicity.drop_toxic(odd, model).columns == odd.columns
    none = toxicity.fit(odd, labels.limit(0))
    assert {r.predicted for r in toxicity.toxicity_scores(odd, none).collect()} == {0}
    assert toxicity.toxicity_scores(empty, none).collect() == []


# -- 7: urls ------------------------------------------------------------------------------

def naive_glob(glob, text):
    if not glob:
        return not text
    if glob.startswith("**"):
        return any(naive_glob(glob[2:], text[k:]) for k in range(len(text) + 1))
    if glob[0] == "*":
        stop = (text + "/").index("/")
        return any(naive_glob(glob[1:], text[k:]) for k in range(stop + 1))
    return bool(text) and text[0] == glob[0] and naive_glob(glob[1:], text[1:])


def test_automaton_matches_globs_by_definition():
    rng = random.Random(8)
    globs = ["".join(rng.choice(["a", "b", "/", ".", "*", "**"]) for _ in range(rng.randint(0, 9))).replace("***", "**")
             for _ in range(40)]
    texts = ["".join(rng.choice("ab/.") for _ in range(rng.randint(0, 14))) for _ in range(200)]
    found = url_rules.compile_globs(globs).matches([t.encode() for t in texts])
    for i, t in enumerate(texts):
        for k, g in enumerate(globs):
            assert found[i, k] == naive_glob(g, t), (g, t)


def test_url_rules_on_odd_urls(lspark):
    cases = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "example.net/": ("", "", None, "allow"),
        "http://EXAMPLE.net/en/x?q": ("example.net", "/en/x", "example.net/en/", "allow"),
        "http://a.net/b": ("a.net", "/b", "net/", "block"), "http://net": ("net", "", None, "allow"),
        "http://a.net?x=/": ("a.net", "", None, "allow"), "http://internet/x": ("internet", "/x", None, "allow"),
        "x://www.example.com/de/#z": ("www.example.com", "/de/", "example.com/de/", "block"),
        "http://q.org/fr/": ("q.org", "/fr/", "org/fr/", "allow"), "http://s.com/ads/1": ("s.com", "/ads/1", None, "block"),
        "http://s.com/" + "y" * 5000 + ".exe": ("s.com", "/" + "y" * 5000 + ".exe", None, "block"),
        "http://x.com/a\nb.net/": ("x.com", "/a\nb.net/", None, "allow"),
    }
    rows = [(k, u, "rule", "verdict") for k, u in enumerate(cases)] + [(0, None, "rule", "verdict")]
    got = url_rules.judge_urls(lspark.createDataFrame(rows, "page_id long, url string, rule string, host string")).collect()
    want = list(cases.values())
    assert len(got) == len(rows) and all((r.host, r.path, r.rule, r.verdict) == want[r.page_id] for r in got)
    assert url_rules.judge_urls(lspark.createDataFrame([], "page_id long, url string, rule string, host string")).collect() == []


# -- 8: language model --------------------------------------------------------------------

def test_base_scores_are_exact_and_the_model_is_better(lspark, monkeypatch):
    monkeypatch.setattr(brown, "HOT_WORDS", 3000)  # so that rare words go through the join as well
    sf = TABLES
    docs = lspark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in brown.held_out_scores(docs).collect()}
    texts = [(r.doc_id, (r.text or "").encode().lower().split()) for r in docs.collect()]
    counts = collections.Counter()
    for i, words in texts:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(words)
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    for i, words in texts:
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*words, None])
        r = got[i]
        assert (r.n_tokens, r.train_tokens) == (len(words) + 1, n)
        assert r.n_known == sum(counts[w] > 0 for w in [*words, None])
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > 1.02 * sum(r.base_score for r in held)


def test_model_probabilities_sum_to_one(lspark, documents):
    texts = documents([(k, f"a{k % 3} b{k % 5} c{k % 2} d") for k in range(60)])
    model = brown.fit(texts.select("text"), classes=6, sweeps=3)
    assert np.allclose((10 ** model.transitions).sum(1), 1)
    counts = model.counts.toPandas()
    words = model.words.find(counts["word"].to_numpy().view(np.uint64), counts["ending"].to_numpy())
    group = model.symbol_class[words[1]]
    mass = np.bincount(group, counts["n"] + 0.5, 6) + 0.5  # and one unknown word of each class
    assert np.allclose(np.log10(mass), model.emission_base)


def test_scores_of_odd_rows(odd, empty):
    rows = brown.held_out_scores(odd).collect()
    assert len(rows) == 12 and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {1}
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert brown.held_out_scores(empty).collect() == []


def class_of(model):
    """Class of any word by the model's tables."""
    rows = model.counts.collect()
    known = {r.word: r["class"] for r in rows}
    assert len(known) == len(rows) == model.different
    return lambda w: known.get(int(np.uint64(xxhash.xxh3_64_intdigest(w)).view(np.int64)), model.symbol_class[brown.endings([w])[0]]), known


@pytest.mark.parametrize("hot, top", [(40, 6), (brown.HOT_WORDS, brown.TOP_WORDS)])
def test_scores_by_brute_force(lspark, documents, monkeypatch, hot, top):
    monkeypatch.setattr(brown, "HOT_WORDS", hot)
    monkeypatch.setattr(brown, "TOP_WORDS", top)
    rng = random.Random(8)
    texts = [" ".join(f"{'abc'[(j + k) % 3]}{int(rng.expovariate(0.05))}" for j in range(rng.randint(0, 12))) for k in range(150)]
    model = brown.fit(documents(list(enumerate(texts))).select("text"), classes=7, sweeps=4)
    group, known = class_of(model)
    lines = [[6, *(group(w.encode()) for w in t.split()), 6] for t in texts]
    table, own = np.zeros((7, 7)), collections.Counter(w for t in texts for w in t.split())
    for line in lines:
        np.add.at(table, (line[:-1], line[1:]), 1)
    n, v = table.sum(0), np.bincount(list(known.values()), minlength=7)
    want = (table + 5 * ((n + 0.5) / (n.sum() + 3.5))) / (table.sum(1, keepdims=True) + 5)
    assert np.allclose(model.transitions, np.log10(want)) and np.allclose(model.emission_base, np.log10(n + 0.5 * (v + 1)))
    rare = ["", "never seen", "a1 never seen twice b2 never", *(f"a{k} x{k} b{k}" for k in range(90))]
    got = {r.doc_id: r for r in brown.score(documents(list(enumerate(texts + rare))), model).collect()}
    assert len(got) == len(texts + rare)
    for k, text in enumerate(texts + rare):
        words = text.split()
        line = [6, *(group(w.encode()) for w in words), 6]
        score = model.transitions[line[:-1], line[1:]].sum() + sum(
            math.log10(own[w] + 0.5) - model.emission_base[group(w.encode())] for w in words)
        assert math.isclose(got[k].score, score, rel_tol=1e-9)
        assert (got[k].n_tokens, got[k].n_known) == (len(words) + 1, sum(own[w] > 0 for w in words) + 1)


def test_rare_words_have_classes_of_their_own(lspark, documents):
    # 3000 words of one ending, each there twice: neighbours alone tell the two kinds apart
    rows = [t for k in range(1500) for t in (f"the a{k}qqq runs", f"to b{k}qqq now")] * 2
    model = brown.fit(documents(list(enumerate(rows))).select("text"), classes=12, sweeps=6)
    tests = [f"the {x}{k}qqq runs" for k in range(1500) for x in "ab"]
    got = {r.doc_id: r.score for r in brown.score(documents(list(enumerate(tests))), model).collect()}
    assert all(got[k] > got[k + 1] + 1 for k in range(0, 3000, 2))


def test_gains_are_those_of_the_class_bigrams():
    rng = np.random.default_rng(1)
    pairs = rng.poisson(0.6, (30, 30)).astype(float)
    pairs[:, 0] *= rng.integers(0, 60, 30)
    place = rng.integers(0, 5, 30)

    def table(place):
        out = np.zeros((6, 6))
        np.add.at(out, (place[:, None], place[None, :]), pairs)
        return out

    after, before = (np.stack([np.bincount(place, x[w], 6) for w in range(30)]) for x in (pairs, pairs.T))
    gain = brown.Gains(table(place)).gains(after, before, np.diag(pairs), place)
    for w in range(30):
        for c in range(6):
            moved = np.where(np.arange(30) == w, c, place)
            assert math.isclose(gain[w, c] - gain[w, place[w]], brown._information(table(moved)) - brown._information(table(place)), abs_tol=1e-8)


def test_words_of_one_count_are_not_left_out(lspark):
    rows = [(k, k % brown.ENDINGS, 1) for k in range(500)] + [(-1, brown.EDGE, 100)]
    counts = lspark.createDataFrame(rows, "word long, ending int, n long")
    assert len(brown.frequent_words(counts, 100, 20).keys) == 20
    assert len(brown.frequent_words(counts, 1000, 20).keys) == 501


# -- the pipeline ------------------------------------------------------------------------------

def test_stages_decide_as_their_operators_do_by_brute_force(lspark):
    from tests.llm.test_near_duplicates import brute

    docs = lspark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    bench = [tiling.tokens(r.text.encode()) for r in lspark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet").collect()]
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        made = stage(lspark, now, SMOKE_DIR)
        before = {r.doc_id: r.text for r in now.collect()}
        if name == "packing":
            rows = made.collect()
            assert sum(r.n_tokens for r in rows) == sum(len(t.encode().split()) for t in before.values())
            assert {r.doc_id for r in rows} == set(before)
            break
        assert made.columns == docs.columns
        after = {r.doc_id: r.text for r in made.collect()}
        if name == "near_dedup":
            assert set(after) == {i for i, x in brute(list(before.items()), 5, 80).items() if x[2]}
        elif name == "decontamination":
            leaking = {i for i, t in before.items() for item in bench
                       if sum(x[2] for x in tiling.greedy_tiles(item, tiling.tokens(t.encode()))) >= 0.5 * len(item)}
            assert set(after) == set(before) - leaking
        elif name == "line_dedup":
            assert set(after) == set(before)
            assert all(set(after[i].split("\n")) <= set(before[i].split("\n")) | {""} for i in after)
        else:
            assert set(after) <= set(before)
        now = lspark.createDataFrame(made.collect(), docs.schema)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]


def test_near_copies_with_few_equal_lines_keep_one_whole_text(lspark, documents):
    def line(name, n, other=()):
        return " ".join(f"{name}{chr(97 + k % 26)}{chr(97 + k // 26)}" + ("x" if k in other else "") for k in range(n))

    # 50, 70 and 90 of 200 words in equal lines, one word of the third line differs
    rows = []
    for k, n in enumerate((20, 40, 60)):
        texts = ["\n".join([line(f"{x}q", 30), line(x, n), line(f"{x}r", 70 - n + 100, other)])
                 for x, other in ((chr(97 + k), ()), (chr(97 + k), (1,)))]
        rows += [(2 * k, texts[0]), (2 * k + 1, texts[1])]
    docs = documents(rows)
    stages = dict(corpus_pipeline.STAGES)
    stripped = stages["line_dedup"](lspark, docs, SMOKE_DIR)
    assert {r.doc_id: r.text for r in stripped.collect()} == dict(rows)
    kept = stages["near_dedup"](lspark, stripped, SMOKE_DIR).collect()
    assert {r.doc_id: r.text for r in kept} == {i: t for i, t in rows if i % 2 == 0}


def test_pipeline_runs_on_an_empty_table(lspark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        lspark.read.parquet(f"{SMOKE_DIR}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(lspark, str(tmp_path)).collect() == []
