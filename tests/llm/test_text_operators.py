"""Operators 1, 3, 4, 9 and 10: brute force, round trips, odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tests.conftest import SMOKE_DIR
from zoneflow.llm import packing, queries, templates, tiling, token_ids, winnowing
from zoneflow.session import scratch_dir


# -- 1: packing --------------------------------------------------------------------

def naive_best_fit(lengths, capacities, most):
    used, cap, bins = [], [], []
    for n in lengths:
        fits = [b for b in range(len(used)) if cap[b] - used[b] >= n]
        if fits:
            b = min(fits, key=lambda x: cap[x] - used[x])
        else:
            cap.append(min((c for c in capacities if n <= c <= most), key=lambda c: packing.sequence_cost(c) / c))
            used.append(0)
            b = len(used) - 1
        used[b] += n
        bins.append(b)
    return sum(packing.sequence_cost(min(c for c in capacities if c >= u)) for u in used)


def test_best_fit_is_the_cheapest_of_the_naive_packings():
    rng = random.Random(3)
    for _ in range(60):
        capacities = (8, 16, 64)
        lengths = sorted((rng.randint(1, 64) for _ in range(rng.randint(0, 60))), reverse=True)
        bins, sizes = packing.best_fit(lengths, capacities)
        used = [0] * len(sizes)
        for b, n in zip(bins, lengths, strict=True):
            used[b] += n
        assert all(s == min(c for c in capacities if c >= u) for s, u in zip(sizes, used, strict=True))
        options = [naive_best_fit(lengths, capacities, m) for m in capacities if not lengths or m >= lengths[0]]
        assert sum(map(packing.sequence_cost, sizes)) <= min(options, default=0)


def test_pack_places_every_word_once(lspark, odd, empty):
    for docs in (odd, lspark.read.parquet(f"{SMOKE_DIR}/documents.parquet")):
        rows = packing.pack(docs, shard_pieces=50).collect()
        words = sum(len((r.text or "").encode().split()) for r in docs.collect())
        assert sum(r.n_tokens for r in rows) == words
        bins = {}
        for r in rows:
            if r.n_tokens:
                bins.setdefault(r.bin_id, []).append(r)
            else:
                assert r.bin_id is None
        for members in bins.values():
            members.sort(key=lambda r: r.bin_offset)
            assert [r.bin_offset for r in members] == [sum(x.n_tokens for x in members[:k]) for k in range(len(members))]
            total = sum(r.n_tokens for r in members)
            assert {r.capacity for r in members} == {min(c for c in packing.CAPACITIES if c >= total)}
    assert packing.pack(empty).collect() == []


def test_pack_cuts_long_texts(documents):
    rows = packing.pack(documents([(1, "a " * 10_000)])).collect()
    assert sorted((r.piece, r.start, r.n_tokens) for r in rows) == [(0, 0, 4096), (1, 4096, 4096), (2, 8192, 1808)]


# -- 3: token ids --------------------------------------------------------------------

def tokenizer():
    import public_tokenizers as p
    from tokenizers import Tokenizer

    return p.path("word_bpe_49k.json"), Tokenizer.from_file(p.path("word_bpe_49k.json"))


@pytest.mark.parametrize("by_word", [True, False])
def test_ids_round_trip(lspark, odd, by_word):
    path, plain = tokenizer()
    out = token_ids.write_token_ids(odd, scratch_dir(lspark, "ids"), path, by_word=by_word)
    rows = token_ids.with_crc32(token_ids.read_token_ids(lspark, out)).collect()
    want = sorted((-(1 << 63) if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in rows)
    texts = [(-(1 << 63) if r.doc_id is None else r.doc_id, r.text or "") for r in odd.collect()]
    made = []
    for i, t in texts:
        ids = [*plain.encode(t, add_special_tokens=False).ids, 1]
        made.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert want == sorted(made)
    starts = sorted((r.start, r.n_tokens) for r in rows)
    assert [s for s, _ in starts] == [sum(n for _, n in starts[:k]) for k in range(len(starts))]
    by_id = sorted((r.start, r.doc_id) for r in rows if r.doc_id is not None)
    assert [i for _, i in by_id] == sorted(i for _, i in by_id)


def test_words_are_encoded_together_and_stay_apart():
    path, plain = tokenizer()
    texts = ["", " ", "Don't x\x01y \x01 z\x01", "\u0301abc cafe\u0301 I\u0130 <|endoftext|>", "<|ENDOFTEXT|> a.b,c 12ab", "\u00a0 x\u00a0y \u2028 z",
             *(f"word{i} Word{i}, \u00c9t\u00e9{i}" for i in range(2000))]
    made = token_ids.Encoder(path, by_word=True)
    calls = []
    encode = made._plain
    made._plain = lambda some, bare=False: calls.append(len(some)) or encode(some, bare)
    for some in (texts[:2], texts[:5], texts[3:], texts):
        values, at = made.encode([t.encode() for t in some], 1)
        got = [values[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
        assert got == [[*plain.encode(t, add_special_tokens=False).ids, 1] for t in some]
    signs = ["Word's, it's. THE'S! x.y. a..,b?!? \u00c9t\u00e9. e\u0301, 12. .,. ' 'll. don't!?", "abc. abc abc, abc.., .abc <|endoftext|>, 're."]
    assert made.parted
    for some in (signs, signs[::-1]):
        assert token_ids.Encoder(path, by_word=True).encode([t.encode() for t in some], 1)[0].tolist() == [
            x for t in some for x in [*plain.encode(t, add_special_tokens=False).ids, 1]]
    calls.clear()
    made.encode([b" ".join(b"new%d" % i for i in range(4000))], 1)
    assert sum(calls) < 20   # before: one text for each word
    made.mark = 5            # an id that words have
    assert made._word_ids([b"&", b"x y"[:1], b"other"]) == [np.array(plain.encode(w).ids, "<u4").tobytes() for w in ("&", "x", "other")]


def test_ids_of_an_empty_table(lspark, empty):
    out = token_ids.write_token_ids(empty, scratch_dir(lspark, "ids"), tokenizer()[0], by_word=True)
    assert token_ids.read_token_ids(lspark, out).collect() == []


def test_orc_files_have_bloom_filters_and_prune(lspark, scratch):
    docs = lspark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    out = token_ids.write_token_ids(docs, scratch, tokenizer()[0], by_word=True)
    plan = token_ids.read_token_ids(lspark, out).filter("doc_id = 17")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,17)" in plan
    assert token_ids.read_token_ids(lspark, out).filter("doc_id = 17").count() == 1


# -- 4: winnowing --------------------------------------------------------------------

def naive_winnow(text, gram=winnowing.GRAM, window=winnowing.WINDOW):
    points = [ord(c) for c in text]
    gram = min(gram, len(points))
    hashes = []
    for i in range(len(points) - gram + 1 if points else 0):
        v = 0
        for c in points[i:i + gram]:
            v = (v * 0x9E3779B97F4A7C15 + c) % 2 ** 64
        hashes.append(int(winnowing.mix64(np.array([v], np.uint64))[0]) >> 32)
    window = min(window, len(hashes))
    out = []
    for i in range(len(hashes) - window + 1 if hashes else 0):
        least = min(hashes[i:i + window])
        at = max(k for k in range(i, i + window) if hashes[k] == least)
        if not out or out[-1][1] != at:
            out.append((least, at))
    return out


def test_winnow_matches_the_definition():
    rng = random.Random(1)
    for text in ["", "a", "abcdefgh", "a" * 200, "ab" * 90, *("".join(rng.choice("abcé ") for _ in range(n)) for n in (7, 39, 40, 300))]:
        h, p = winnowing.winnow(winnowing.code_points(text))
        assert list(zip(h.tolist(), p.tolist(), strict=True)) == naive_winnow(text)


def test_shared_passage_shares_a_hash():
    rng = random.Random(2)
    guarantee = winnowing.GRAM + winnowing.WINDOW - 1
    common = "".join(rng.choice("abcdefgh") for _ in range(guarantee))
    a, b = (("".join(rng.choice("ijklmnop") for _ in range(200)) + common) for _ in range(2))
    assert set(winnowing.winnow(winnowing.code_points(a))[0]) & set(winnowing.winnow(winnowing.code_points(b + "zzz"))[0])


def test_edited_texts_follow_descending_ids(documents, empty):
    rows = [(i, t) for i, t in ((5, "abcdefghij"), (9, "0123456789" * 30), (2, ""), (7, None), (1, "xyz"), (3, "é😀" * 50))]
    got = {r.doc_id: r for r in winnowing.edited_fingerprints(documents(rows)).collect()}
    order = sorted(rows, reverse=True)
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].edited_fingerprint == winnowing.fingerprint_text(*winnowing.winnow(winnowing.code_points(edited)))
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert winnowing.edited_fingerprints(empty).collect() == []
    one = winnowing.edited_fingerprints(documents([(4, "abcd")])).collect()[0]
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest()


def test_fingerprints_of_odd_rows(odd):
    rows = winnowing.edited_fingerprints(odd).collect()
    assert len(rows) == 12
    assert len({r.fingerprint for r in rows if r.doc_id in (7, 8)}) == 1
    assert {(r.doc_id, len(r.hashes)) for r in winnowing.fingerprints(odd).collect()} >= {(2, 0), (3, 0), (7, 1)}


# -- 9: string tiling ------------------------------------------------------------------

def naive_tiles(item, text, least):
    """Greedy string tiling by definition: mark all longest free matches, again and again."""
    free_a, free_b, out = [True] * len(item), [True] * len(text), 0
    while True:
        best, matches = least - 1, []
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while (i + n < len(item) and j + n < len(text) and free_a[i + n] and free_b[j + n] and item[i + n] == text[j + n]):
                    n += 1
                if n > best:
                    best, matches = n, [(i, j)]
                elif n == best and n >= least:
                    matches.append((i, j))
        if not matches:
            return out
        for i, j in matches:
            if all(free_a[i:i + best]) and all(free_b[j:j + best]):
                out += best
                free_a[i:i + best] = free_b[j:j + best] = [False] * best


def test_tiles_cover_as_much_as_the_definition():
    rng = random.Random(4)
    for _ in range(60):
        item = [rng.randrange(40) for _ in range(rng.randint(5, 40))]
        parts = [item[a:a + rng.randint(3, 15)] for a in (rng.randrange(len(item)) for _ in range(4))]
        text = [x for p in parts for x in [*p, *[rng.randrange(40) for _ in range(rng.randint(0, 4))]]]
        tiles = tiling.greedy_tiles(item, text, 3)
        for i, j, n in tiles:
            assert n >= 3 and item[i:i + n] == text[j:j + n]
        assert len({i + k for i, _, n in tiles for k in range(n)}) == sum(t[2] for t in tiles)
        assert abs(sum(t[2] for t in tiles) - naive_tiles(item, text, 3)) <= 3


def test_rolling_hashes_are_those_of_their_windows(monkeypatch):
    rng = random.Random(4)
    for prime in (tiling.PRIME, 7):   # with a tiny prime most windows collide
        monkeypatch.setattr(tiling, "PRIME", prime)
        codes = [rng.randrange(9) for _ in range(80)]
        free = [rng.random() < 0.9 for _ in codes]
        for length in (1, 3, 8):
            want = [(k, sum(c * pow(tiling.BASE, length - 1 - n) for n, c in enumerate(codes[k:k + length])) % prime)
                    for k in range(len(codes) - length + 1) if all(free[k:k + length])]
            assert list(tiling._windows(codes, free, length)) == want
        item, text = ([rng.choice("abcd") for _ in range(n)] for n in (40, 60))
        for i, j, n in tiling.greedy_tiles(item, text, 3):
            assert item[i:i + n] == text[j:j + n]


def test_tiles_do_not_depend_on_the_hash(monkeypatch):
    rng = random.Random(9)
    pairs = [([rng.choice("abcde") for _ in range(30)], [rng.choice("abcde") for _ in range(90)]) for _ in range(40)]
    usual = [tiling.greedy_tiles(a, b, 4) for a, b in pairs]
    monkeypatch.setattr(tiling, "PRIME", 3)
    assert [tiling.greedy_tiles(a, b, 4) for a, b in pairs] == usual


@pytest.mark.parametrize("limit", [0, 1, 10 ** 9])
def test_both_ways_to_the_candidates_agree_at_the_border(lspark, documents, monkeypatch, limit):
    rng = random.Random(2)
    passage = [f"b{rng.randrange(400)}" for _ in range(40)]
    bench = lspark.createDataFrame([(1, " ".join(passage)), (2, "a b c"), (3, None)], "item_id long, text string")
    seeds = tiling.benchmark_seeds(bench)
    monkeypatch.setattr(tiling, "MAX_SHARED_SEEDS", {0: 0, 1: seeds, 10 ** 9: seeds - 1}[limit])
    rows = [(1, " ".join(["x"] * 9 + passage + ["y"] * 5)), (2, " ".join(passage[20:] + ["z"] + passage[:20])), (3, "q a b c q"), (4, "nothing here")]
    got = {(r.doc_id, r.item_id, r.covered) for r in tiling.leaks(documents(rows), bench).collect()}
    assert got == {(1, 1, 40), (2, 1, 40), (3, 2, 3)}


def test_leaks_found_in_any_order_and_both_ways(lspark, documents):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
    words = item.split()
    swapped = " ".join([*words[8:], "and", *words[:8]])
    rows = [(1, f"Intro, {item.upper()}! End."), (2, f"x {swapped} y"), (3, " ".join(words[:6])), (4, None), (5, ""),
            (6, "nothing here at all to see today"), (None, item), (7, "short one"), (1, f"Intro, {item.upper()}! End.")]
    bench = lspark.createDataFrame([(10, item), (11, "Short, one."), (12, ""), (13, None), (None, item), (10, item)],
                                   "item_id long, text string")
    got = [sorted((r.doc_id or 0, r.item_id, r.covered) for r in tiling.leaks(documents(rows), bench, shared=s).collect())
           for s in (True, False)]
    assert got[0] == got[1] == [(0, 10, 16), (1, 10, 16), (1, 10, 16), (2, 10, 16), (7, 11, 2)]
    kept = tiling.drop_leaks(documents(rows), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]
    assert tiling.leaks(documents(rows), bench.limit(0)).count() == 0


def test_leaks_match_brute_force(lspark, odd, empty):
    docs, bench = (lspark.read.parquet(f"{SMOKE_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, tiling.tokens(r.text.encode())) for r in bench.collect()]
    want = set()
    for r in docs.collect():
        words = tiling.tokens((r.text or "").encode())
        grams = {tuple(words[k:k + 5]) for k in range(len(words) - 4)}
        for i, item in items:
            if any(tuple(item[k:k + 5]) in grams for k in range(len(item) - 4)):
                covered = naive_tiles(item, words, 5) if len(words) < 1500 else len(item)
                if covered >= 0.5 * len(item):
                    want.add((r.doc_id, i))
    assert {(r.doc_id, r.item_id) for r in tiling.leaks(docs, bench).collect()} == want
    assert tiling.leaks(odd, bench).count() == 0 and tiling.leaks(empty, bench).count() == 0


# -- 10: line templates -------------------------------------------------------------------

def test_templates_generalise_variable_fields(documents):
    own = [" ".join(f"t{chr(97 + k)}{chr(97 + j)}" for j in range(20)) for k in range(12)]
    rows = [(k, f"{own[k]}\nPosted by user{k} on monday near {chr(97 + k)}town today friends\n{own[k][::-1]}") for k in range(12)]
    clean = {r.doc_id: r for r in templates.drop_recurring_lines(documents(rows), report=True).collect()}
    for k, _ in rows:
        assert clean[k].text == f"{own[k]}\n{own[k][::-1]}"
        assert (clean[k].lines_before, clean[k].lines_dropped, clean[k].n_chars) == (3, 1, len(clean[k].text))


def test_long_passages_of_two_texts_go_and_copies_stay_whole(documents):
    passage = " ".join(f"p{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
    a, b, c = (" ".join(f"{x}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)) for x in "abc")
    rows = [(1, f"{a}\n{passage}"), (2, f"{passage}\n{b}"), (3, c), (4, c), (5, c + "\nshort end"), (6, None), (7, "")]
    got = {r.doc_id: r.text for r in templates.drop_recurring_lines(documents(rows)).collect()}
    assert got == {1: a, 2: b, 3: c, 4: c, 5: c + "\nshort end", 6: None, 7: ""}


def words(prefix, n):
    return " ".join(f"{prefix}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(n))


def test_short_texts_made_mostly_of_a_shared_passage_lose_it(documents):
    passage = words("p", 60)
    rows = [(k, f"{passage}\n{words(chr(97 + k), 20)}") for k in range(3)] + [(None, f"{passage}\n{words('z', 20)}")]
    got = {r.doc_id: r.text for r in templates.drop_recurring_lines(documents(rows)).collect()}
    assert got == {0: words("a", 20), 1: words("b", 20), 2: words("c", 20), None: words("z", 20)}


def test_rows_of_numbers_recur_only_where_they_are_equal(documents):
    rows = [(k, f"{words(chr(97 + k), 40)}\n{k}1 {k}2 {k}3 {k}4\n" + " ".join(str(100 * k + j) for j in range(30))
             + "\n5 6 7 8") for k in range(12)]
    got = {r.doc_id: r.text for r in templates.drop_recurring_lines(documents(rows)).collect()}
    assert got == {k: t.removesuffix("\n5 6 7 8") for k, t in rows}


def test_frequent_values_of_fields_do_not_split_a_template(documents):
    names, cities = (words(x, 10).split() for x in ("n", "c"))
    rows = [(100 * k + 10 * i + j, f"{words(chr(97 + i) + chr(97 + j) + chr(97 + k), 12)}\n"
             f"Article was posted by {names[i]} in {cities[j]} news") for k in range(2) for i in range(10) for j in range(10)]
    long, own = words("p", 30), [words(x, 40) for x in "abc"]
    rows += [(1000 + k, f"{own[k]}\n{long} {a} {b}") for k, (a, b) in enumerate((("na", "ca"), ("na", "cb"), ("nb", "cb")))]
    got = templates.drop_recurring_lines(documents(rows), report=True).collect()
    assert {r.lines_dropped for r in got} == {1}
    assert {r.text for r in got if r.doc_id >= 1000} == set(own)


def test_passages_broken_into_short_lines_go_from_two_texts(documents):
    verse = "\n".join(words(x, n) for x, n in zip("pqrstu", (8, 20, 20, 1, 5, 2), strict=True))
    few = words("v", 8) + "\n" + words("w", 8)
    rows = [(1, f"{words('a', 60)}\n{verse}\n{words('b', 4)}\n{few}"), (2, f"{few}\n{words('c', 50)}"),
            (3, f"{words('d', 60)}\n\n{verse}\n{words('e', 9)}\n{words('p', 8)}")]
    got = {r.doc_id: r.text for r in templates.drop_recurring_lines(documents(rows)).collect()}
    assert got == {1: f"{words('a', 60)}\n{words('b', 4)}\n{few}", 2: rows[1][1],
                   3: f"{words('d', 60)}\n\n{words('e', 9)}\n{words('p', 8)}"}


def test_lines_of_odd_rows_stay(odd, empty):
    got = templates.drop_recurring_lines(odd)
    assert got.columns == odd.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, ((r.doc_id, r.text) for r in odd.collect())))
    assert templates.drop_recurring_lines(empty).collect() == []


def brute_line_dedup(texts):
    """The rules by definition over all texts at once: text -> what is left of it."""
    from tests.llm.test_near_duplicates import brute

    distinct = sorted({t for t in texts if t})
    classes = {distinct[i]: component for i, (_, component, _) in brute(list(enumerate(distinct)), 5, 80).items()}
    lines = {t: [[(b"<*>" if re.search(rb"[0-9]", w) else w, w) for w in x.encode().split()] for x in t.split("\n")] for t in distinct}

    def own(line):
        masked = tuple(m for m, _ in line)
        return masked if sum(m != b"<*>" for m in masked) / len(masked) >= 0.6 else ("as it is", *(w for _, w in line))

    def enough(n):
        return 2 if n >= 25 else 8

    leaf_of = lambda line: (len(line), tuple(m for m, _ in line[:3]))
    leaf_texts = {}
    for t in distinct:
        for masked in {tuple(m for m, _ in x) for x in lines[t] if len(x) > 1}:
            leaf = (len(masked), masked[:3])
            leaf_texts[leaf] = leaf_texts.get(leaf, 0) + 1
    open_leaves = {leaf for leaf, n in leaf_texts.items() if n >= enough(leaf[0])}
    holders, shape, weight = {}, {}, {}
    for t in distinct:
        seen = set()
        for x in lines[t]:
            if len(x) > 1 and leaf_of(x) in open_leaves:
                name, masked = own(x), tuple(m for m, _ in x)
                holders.setdefault(name, set()).add(classes[t])
                shape[name] = (leaf_of(x), masked)
                # of lines equal but for their variable fields, the first one of a text counts
                if name not in {n for n, _ in seen}:
                    weight.setdefault(name, {})
                    weight[name][classes[t]] = max(weight[name].get(classes[t], 0), int(masked not in {m for _, m in seen}))
                seen.add((name, masked))
    count = {}
    for name, (leaf, masked) in shape.items():
        for position, word in enumerate(masked):
            key = (leaf, position, word)
            count[key] = count.get(key, 0) + sum(weight[name].values())
    templates_of, template_classes = {}, {}
    for name, (leaf, masked) in shape.items():
        docs = [count[leaf, p, w] if w != b"<*>" and count[leaf, p, w] >= enough(leaf[0]) else 0 for p, w in enumerate(masked)]
        found = {("line", name)}
        for level in {d for d in docs if d}:
            constants = frozenset((p, w) for p, (w, d) in enumerate(zip(masked, docs, strict=True)) if d >= level)
            if len(constants) / len(masked) >= 0.6:
                found.add((leaf, constants))
        templates_of[name] = found
        for template in found:
            template_classes.setdefault((template, leaf[0]), set()).update(holders[name])
    recurring = {t for t, c in template_classes.items() if len(c) >= enough(t[1])}
    gone = {name for name, found in templates_of.items() if any((t, shape[name][0][0]) in recurring for t in found)}

    def spans(t):
        full = [k for k, x in enumerate(lines[t]) if x]
        sizes = [len(lines[t][k]) for k in full]
        pairs = {(i, next(j for j in range(i + 1, len(full) + 1) if sum(sizes[i:j]) >= 25))
                 for i in range(len(full)) if sum(sizes[i:]) >= 25}
        pairs |= {(max(i for i in range(j) if sum(sizes[i:j]) >= 25), j) for j in range(1, len(full) + 1) if sum(sizes[:j]) >= 25}
        return {(tuple(own(lines[t][k]) for k in full[i:j]), tuple(full[i:j])) for i, j in pairs if j - i > 1}

    run_classes = {}
    for t in distinct:
        for run, _ in spans(t):
            run_classes.setdefault(run, set()).add(classes[t])
    out = {}
    for t in distinct:
        lost = {k for k, x in enumerate(lines[t]) if x and own(x) in gone}
        lost |= {k for run, at in spans(t) if len(run_classes[run]) > 1 for k in at}
        out[t] = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in lost)
    return out


def test_line_dedup_matches_brute_force(lspark):
    docs = lspark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    want = brute_line_dedup([r.text for r in docs.collect()])
    got = queries.QUERIES["op10_log_template_lines"](lspark, SMOKE_DIR).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sum(r.lines_dropped for r in got) > 50
    for r in got:
        kept = want.get(texts[r.doc_id], texts[r.doc_id]) or ""
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest(), r.doc_id
        assert r.lines_dropped == texts[r.doc_id].count("\n") - kept.count("\n") + (kept == "" and r.lines_dropped == r.lines_before)


def test_query_and_pipeline_drop_the_same_lines(lspark):
    import corpus_pipeline

    docs = lspark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    staged = {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in corpus_pipeline.line_dedup(lspark, docs, SMOKE_DIR).collect()}
    assert staged == {r.doc_id: r.kept_sha256 for r in queries.QUERIES["op10_log_template_lines"](lspark, SMOKE_DIR).collect()}


def test_key_bitmap_flags_every_key(lspark):
    from zoneflow.llm.common import may_hold

    rows = lspark.range(0, 20_000).selectExpr("xxhash64(id) AS key", "id")
    keys = rows.filter("id % 10 = 0").select("key")
    flagged = {r.id for r in may_hold(rows, "key", keys, "flag").filter("flag").collect()}
    assert flagged >= set(range(0, 20_000, 10)) and len(flagged) < 2100
    assert may_hold(rows, "key", keys.limit(0), "flag").filter("flag").isEmpty()
