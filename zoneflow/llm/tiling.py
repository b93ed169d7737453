"""Operator 9: benchmark decontamination by greedy string tiling.

Documents and benchmark items meet through shared seeds of ``MIN_TILE`` tokens.  For
each such pair, running Karp-Rabin matching marks the longest common passages that do
not overlap, again and again, down to ``MIN_TILE`` tokens.  The share of an item's
tokens under tiles is its coverage; tiles may come in any order, so passages whose
parts were swapped are caught too.  Pairs of coverage ``MIN_COVERAGE`` or more leak.

Benchmarks are small: their seeds are counted, and up to ``MAX_SHARED_SEEDS`` they go
to every task, which then needs no shuffle at all (a passage that sits in a third of
all documents is just found there).  A larger benchmark is joined by seed instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import byte_values, chunks, gather, materialise, mix64, row_key

MIN_TILE = 5
MIN_COVERAGE = 0.5
MAX_SHARED_SEEDS = 2_000_000
BASE, PRIME = 1_000_003, (1 << 61) - 1   # of the rolling hash

_SPACES = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def tokens(value: bytes | None) -> list[bytes]:
    """Lower-cased runs of letters and digits (ASCII punctuation separates; other bytes are letters)."""
    if not value:
        return []
    low = value.lower() if value.isascii() else value.decode("utf-8", "replace").lower().encode()
    return low.translate(_SPACES).split()


def greedy_tiles(item: list, text: list, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Tiles ``(item position, text position, length)`` by running Karp-Rabin greedy string tiling.

    ``None`` in ``text`` matches nothing.  An item shorter than ``least`` needs a tile as long as itself.
    """
    least = min(least, len(item))
    if not least:
        return []
    item_free, text_free = [True] * len(item), [x is not None for x in text]
    tiles: list[tuple[int, int, int]] = []
    length = max(least, min(len(item), 20))
    while True:
        longest, matches = _matches(item, text, item_free, text_free, length)
        if longest > 2 * length:
            length = longest
            continue
        for run, i, j in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            # parts that an earlier tile took leave what is left of the match
            k = 0
            while k < run:
                if not (item_free[i + k] and text_free[j + k]):
                    k += 1
                    continue
                end = k
                while end < run and item_free[i + end] and text_free[j + end]:
                    end += 1
                if end - k >= length:
                    tiles.append((i + k, j + k, end - k))
                    for x in range(k, end):
                        item_free[i + x] = text_free[j + x] = False
                k = end
        if length == least:
            if not matches:
                return sorted(tiles)
        elif length > 2 * least:
            length //= 2
        else:
            length = least


def _matches(item: list, text: list, item_free: list, text_free: list, length: int) -> tuple[int, list]:
    """Maximal free matches of ``length`` or more: (greatest length, [(length, item at, text at)])."""
    codes = {token: k for k, token in enumerate(dict.fromkeys(item), 1)}   # other tokens are 0: they match nothing
    starts: dict[int, list[int]] = {}
    for i, key in _windows([codes[t] for t in item], item_free, length):
        starts.setdefault(key, []).append(i)
    longest, found, reached = 0, [], {}
    for j, key in _windows([codes.get(t, 0) for t in text], text_free, length):
        for i in starts.get(key, ()):
            if reached.get(i - j, -1) > j:  # inside a longer match on the same diagonal
                continue
            if item[i:i + length] != text[j:j + length]:  # equal hashes of different windows
                continue
            run = length
            while (i + run < len(item) and j + run < len(text) and item_free[i + run] and text_free[j + run]
                   and item[i + run] == text[j + run]):
                run += 1
            reached[i - j] = j + run - length + 1
            found.append((run, i, j))
            longest = max(longest, run)
            if run > 2 * length:
                return longest, []
    return longest, found


def _windows(codes: list[int], free: list, length: int) -> Iterator[tuple[int, int]]:
    """(start, Karp-Rabin hash) of the free windows; the hash rolls on from one window to the next."""
    oldest = pow(BASE, length, PRIME)
    run, rolling = 0, 0
    for k, x in enumerate(free):
        if not x:
            run, rolling = 0, 0
            continue
        run += 1
        rolling = rolling * BASE + codes[k]
        if run > length:
            rolling -= codes[k - length] * oldest
        rolling %= PRIME
        if run >= length:
            yield k - length + 1, rolling


@dataclass
class Items:
    """Benchmark items as tokens, and the seeds that lead to them (sorted)."""

    ids: list
    words: list[list[bytes]]
    seeds: np.ndarray
    seed_items: np.ndarray   # item number of each seed
    sizes: list[int]         # distinct seed lengths

    def pairs(self, words: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """(item number, tiles) of the items whose seeds ``words`` has."""
        hit: dict[int, list[np.ndarray]] = {}
        hashes = _hashed(words)
        for size in self.sizes:
            seeds = _seeds(hashes, size)
            lo = np.searchsorted(self.seeds, seeds, "left")
            at = np.flatnonzero((lo < len(self.seeds)) & (self.seeds[np.minimum(lo, len(self.seeds) - 1)] == seeds))
            for p in at.tolist():
                k = lo[p]
                while k < len(self.seeds) and self.seeds[k] == seeds[p]:
                    hit.setdefault(int(self.seed_items[k]), []).append((p, size))
                    k += 1
        for number, places in hit.items():
            yield number, tile_pair(self.words[number], words, places)


def tile_pair(item: list[bytes], words: list[bytes], places: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Tiles of one item; of the text only what seeds at ``places`` (position, length) cover can match."""
    text: list = []
    back: list[int] = []
    end = -1
    for p, size in sorted(places):
        if p > end and text:
            text.append(None)
            back.append(-1)
        for x in range(max(p, end), p + size):
            text.append(words[x])
            back.append(x)
        end = max(end, p + size)
    return [(i, back[j], n) for i, j, n in greedy_tiles(item, text)]


def _hashed(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _seeds(hashes: np.ndarray, size: int) -> np.ndarray:
    n = len(hashes) - size + 1
    if n <= 0 or not size:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k:n + k])
    return out


def shared_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Items:
    """The benchmark as one object for all tasks (call only behind a size check)."""
    rows = sorted({(r[0], r[1]) for r in benchmark.select(id_col, text_col).collect() if r[0] is not None},
                  key=lambda r: (r[0], r[1] or ""))
    ids, words, seeds, owners = [], [], [], []
    for item_id, text in rows:
        own = tokens((text or "").encode())
        found = np.unique(_seeds(_hashed(own), min(MIN_TILE, len(own))))
        ids.append(item_id)
        words.append(own)
        seeds.append(found)
        owners.append(np.full(len(found), len(ids) - 1))
    seeds = np.concatenate([np.zeros(0, np.uint64), *seeds])
    owners = np.concatenate([np.zeros(0, np.int64), *owners])
    order = np.argsort(seeds, kind="stable")
    return Items(ids, words, seeds[order], owners[order], sorted({min(MIN_TILE, len(w)) for w in words if w}))


def benchmark_seeds(benchmark: DataFrame, text_col: str = "text") -> int:
    """An upper bound of the benchmark's seeds: its tokens cannot be more than half its bytes."""
    return int(benchmark.select(F.sum(F.octet_length(text_col)) / 2).first()[0] or 0) + benchmark.count()


_PAIR_SCHEMA = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("item_id", pa.int64()),
                          ("item_tokens", pa.int64()), ("covered", pa.int64()), ("coverage", pa.float64()),
                          ("tiles", pa.list_(pa.struct([("item_start", pa.int64()), ("doc_start", pa.int64()),
                                                        ("length", pa.int64())])))])
_PAIR_DDL = ("doc_id long, key long, item_id long, item_tokens long, covered long, coverage double, "
             "tiles array<struct<item_start long, doc_start long, length long>>")


def _pair_row(out: dict[str, list], doc_id, key, item_id, item: list, tiles: list, least: float) -> None:
    covered = sum(t[2] for t in tiles)
    if item and covered >= least * len(item):
        for name, value in (("doc_id", doc_id), ("key", key), ("item_id", item_id), ("item_tokens", len(item)),
                            ("covered", covered), ("coverage", covered / len(item)),
                            ("tiles", [{"item_start": a, "doc_start": b, "length": n} for a, b, n in tiles])):
            out[name].append(value)


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = MIN_COVERAGE, shared: bool | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, key, item_id, item_tokens, covered, coverage, tiles)`` of every leaking pair.

    Token positions count from 0; ``key`` is the 64-bit key of the row's id and text.
    Items without tokens and without an id are ignored, items below ``MIN_TILE`` tokens
    need a tile as long as themselves.  Null and empty texts leak nothing; a row
    repeated in full gives its pairs once each time.  ``shared`` forces one of the two ways
    to find candidates (None: by the benchmark's size); both give the same rows.  Very long texts are
    searched whole, other columns are ignored, and an empty table on either side gives no rows.
    """
    if shared is None:
        shared = benchmark_seeds(benchmark) <= MAX_SHARED_SEEDS
    if not shared:
        return _joined_leaks(docs, benchmark, least, id_col, text_col)
    items = docs.sparkSession.sparkContext.broadcast(shared_items(benchmark))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in _PAIR_SCHEMA}
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, value in enumerate(byte_values(batch.column(2))):
                words = tokens(value)
                for number, tiles in items.value.pairs(words) if words else ():
                    _pair_row(out, ids[i], keys[i], items.value.ids[number], items.value.words[number], tiles, least)
            yield gather(out, _PAIR_SCHEMA)

    return docs.select(F.col(id_col).cast("long"), row_key(id_col, text_col),
                       F.col(text_col).cast("string")).mapInArrow(run, _PAIR_DDL)


def _joined_leaks(docs: DataFrame, benchmark: DataFrame, least: float, id_col: str, text_col: str) -> DataFrame:
    """``leaks`` for a benchmark of any size: seeds of both sides are joined, then texts."""
    seed_schema = pa.schema([("key", pa.int64()), ("seed", pa.int64())])

    def seeds_of(every_size: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, values = batch.column(0).to_pylist(), byte_values(batch.column(1))
                for lo, hi in chunks(values):
                    made_keys, made = [], []
                    for key, value in zip(keys[lo:hi], values[lo:hi], strict=True):
                        words = tokens(value)
                        hashes = _hashed(words)
                        sizes = range(1, MIN_TILE + 1) if every_size else [min(MIN_TILE, len(words))]
                        for size in sizes:
                            found = np.unique(_seeds(hashes, size))
                            made.append(found.view(np.int64))
                            made_keys.append(np.full(len(found), key, np.int64))
                    yield gather({"key": pa.array(np.concatenate([np.zeros(0, np.int64), *made_keys])),
                                  "seed": pa.array(np.concatenate([np.zeros(0, np.int64), *made]))}, seed_schema)
        return run

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("key"),
                        F.col(text_col).cast("string").alias("doc_text"))
    items = benchmark.filter("item_id is not null").select(
        F.col("item_id").cast("long"), F.col("text").cast("string").alias("item_text")).distinct()
    items = items.withColumn("item_key", F.xxhash64("item_id", "item_text"))
    doc_seeds = texts.select("key", "doc_text").mapInArrow(seeds_of(True), "key long, seed long")
    item_seeds = items.select("item_key", "item_text").mapInArrow(seeds_of(False), "key long, seed long")
    pairs = materialise(doc_seeds.join(item_seeds.withColumnRenamed("key", "item_key"), "seed")
                        .select("key", "item_key").distinct(), "leak-pairs")
    joined = pairs.join(items, "item_key").join(texts, "key").select("doc_id", "key", "item_id", "item_text", "doc_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in _PAIR_SCHEMA}
            ids = [batch.column(c).to_pylist() for c in range(3)]
            texts = [byte_values(batch.column(c)) for c in (3, 4)]
            for doc_id, key, item_id, item_text, doc_text in zip(*ids, *texts, strict=True):
                item, words = tokens(item_text), tokens(doc_text)
                size = min(MIN_TILE, len(item))
                own = set(_seeds(_hashed(item), size).tolist())
                places = [(p, size) for p, s in enumerate(_seeds(_hashed(words), size).tolist()) if s in own]
                if places:
                    _pair_row(out, doc_id, key, item_id, item, tile_pair(item, words, places), least)
            yield gather(out, _PAIR_SCHEMA)

    return joined.mapInArrow(run, _PAIR_DDL)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, least: float = MIN_COVERAGE) -> DataFrame:
    """The rows of ``docs`` that leak no benchmark item, all columns kept (null and empty texts stay)."""
    if benchmark_seeds(benchmark) > MAX_SHARED_SEEDS:
        bad = leaks(docs, benchmark, least, shared=False).select(F.col("key").alias("_leak_key")).distinct()
        return docs.join(bad, row_key() == bad["_leak_key"], "left_anti")
    items = docs.sparkSession.sparkContext.broadcast(shared_items(benchmark))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for value in byte_values(batch.column(at)):
                words = tokens(value)
                keep.append(not any(sum(t[2] for t in tiles) >= least * len(items.value.words[number])
                                    for number, tiles in (items.value.pairs(words) if words else ())))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
