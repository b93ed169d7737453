"""Operator 8: language-model scoring with Brown class-based bigrams.

    P(w_i | w_{i-1}) = P(class(w_i) | class(w_{i-1})) * P(w_i | class(w_i))

Exchange clustering assigns words to classes so that class bigrams are as informative
as possible.  Every word of the training part is moved by itself, however rare.  Only a word
that the training part does not hold takes the class that most words of its ending have
(``ENDINGS`` buckets of its last bytes).

Each different pair of neighbours is kept once for either word, in the bucket of the word;
pairs of the edge and of the ``TOP_WORDS`` most frequent words lie with the other word only, so no bucket
grows with one word.  A sweep sums the pairs by the classes of the neighbours: the class
bigrams first, then every word's gain for every class against these counts, and half of
the words move at a time so that they don't chase each other.  The classes of the ``HOT_WORDS`` most
frequent words go to all tasks (a bounded table); another word that moves tells the
buckets of its neighbours.

Word counts are exact for all words.  The few tokens of words that are not hot are joined with the table of
counts and classes.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm.common import WordCodes, byte_values, chunks, crc_mod, distinct, gather, materialise, mix64, shuffle_width

TOP_WORDS = 2048             # their moves are worked out on the driver, their pairs lie in all buckets
ENDINGS = 1024
EDGE = ENDINGS               # the symbol before the first word, and of the end token
FIRST = EDGE + 1             # symbol of the most frequent word; the other hot words follow by frequency
CLASSES = 64                 # the last one holds nothing but the edge
SWEEPS = 10
HOT_WORDS = 1 << 18
SMOOTHING = 0.5              # of emissions, as in the base model
BACKOFF = 5.0                # weight of a class's own share in its transitions
HELD_ENTRIES = 1_500_000     # distinct keys that a task counts before it hands them on
SCORE_BYTES = 1_500_000      # of texts scored at once, as executors hold the workers of the sweeps too
SPLIT = 2                    # buckets of a partition, worked on one after the other
SLICE_ROWS = 1024            # words whose moves are worked out at once
SMALL = 16                   # counts up to this one have their gains looked up, up to TINY as products of matrices
TINY = 2

_END = int(np.uint64(xxhash.xxh3_64_intdigest(b" ")))  # no word has a blank in it
_RARE = np.uint64(1 << 63)   # a word without a symbol is known by its hash with this bit: negative as a signed number


def endings(words: list[bytes]) -> np.ndarray:
    """The symbol of each word's ending."""
    return np.fromiter((xxhash.xxh32_intdigest(w[-3:]) % ENDINGS for w in words), np.int32, len(words))


class Counter64:
    """Counts of 64-bit keys with an attribute, merged now and then; memory is bounded by flushing."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, extra: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, extra, counts))
        self.size += len(keys)
        if self.size > HELD_ENTRIES:
            self.merge()

    def merge(self) -> None:
        if self.parts:
            keys, extra, counts = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            unique, first, at = np.unique(keys, return_index=True, return_inverse=True)
            self.parts = [(unique, extra[first], np.bincount(at, counts, len(unique)).astype(np.int64))]
            self.size = len(unique)

    def full(self) -> bool:
        return self.size > HELD_ENTRIES // 2

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.merge()
        out = self.parts[0] if self.parts else (np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64))
        self.parts, self.size = [], 0
        return out


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, ending, n)``: exact counts of all words of ``texts(text)`` by 64-bit hash, the end token among them."""
    schema = pa.schema([("word", pa.int64()), ("ending", pa.int32()), ("n", pa.int64())])

    def rows(counter: Counter64) -> pa.RecordBatch:
        keys, extra, n = counter.take()
        return gather({"word": pa.array(keys.view(np.int64)), "ending": pa.array(extra), "n": pa.array(n)}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter64()
        for batch in batches:
            values = byte_values(batch.column(0))
            for lo, hi in chunks(values):
                words = WordCodes(values[lo:hi])
                counts = np.bincount(words.codes, minlength=len(words.words)).astype(np.int64)
                counter.add(words.hashes(), endings(words.words), counts)
                counter.add(np.array([_END], np.uint64), np.array([EDGE], np.int32), np.array([hi - lo]))
                if counter.full():
                    counter.merge()
                    if counter.full():
                        yield rows(counter)
        yield rows(counter)

    return texts.select("text").mapInArrow(run, "word long, ending int, n long").groupBy("word").agg(
        F.min("ending").alias("ending"), F.sum("n").alias("n"))


@dataclass
class Words:
    """The frequent words as sorted arrays."""

    keys: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray

    def find(self, hashes: np.ndarray, ending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count or -1, symbol) of words by hash."""
        if not len(self.keys):
            return np.full(len(hashes), -1), ending
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        known = self.keys[at] == hashes
        return np.where(known, self.counts[at], -1), np.where(known, self.symbols[at], ending)

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of frequent words, negative numbers of others."""
        return self.find(hashes, (hashes | _RARE).view(np.int64))[1].astype(np.int64)

    @property
    def symbol_count(self) -> int:
        return max(FIRST, int(self.symbols.max(initial=0)) + 1)


def frequent_words(counts: DataFrame, hot: int | None = None, top: int | None = None) -> Words:
    """At most ``hot`` words, all at or above some count, and the ``top`` most frequent at any rate.

    Their symbols follow their frequency.  This only says where a word's class is kept: all others
    are counted, clustered and scored as well.
    """
    hot, top = HOT_WORDS if hot is None else hot, TOP_WORDS if top is None else top
    level = F.floor(F.log2("n") * 16).cast("int")
    sizes = sorted(map(tuple, counts.groupBy(level.alias("level")).agg(F.count(F.lit(1))).collect()), reverse=True)
    total, least = 0, None  # the histogram has some hundred levels at most
    for at, n in sizes:
        if total + n > hot:
            break
        total, least = total + n, at
    held = counts.filter(level >= least) if least is not None else counts.limit(0)
    if total < top:   # the next level holds more than there is room for
        held = counts.orderBy(F.col("n").desc(), "word").limit(top)
    rows = held.toPandas()
    keys, n, ending = (rows[c].to_numpy() for c in ("word", "n", "ending"))
    symbols = ending.astype(np.int32)
    order = np.lexsort((keys, -n))
    order = order[ending[order] != EDGE]
    symbols[order] = FIRST + np.arange(len(order))
    keys = keys.view(np.uint64)
    order = np.argsort(keys)
    return Words(keys[order], n[order], symbols[order])


def edged(made: WordCodes, values: np.ndarray, edge: int) -> np.ndarray:
    """``values`` of all words in text order with one ``edge`` before, between and after the texts."""
    texts = len(made.offsets) - 1
    line = np.full(len(made.codes) + texts + 1, edge, np.int64)
    at = np.arange(len(made.codes)) + np.repeat(np.arange(texts), np.diff(made.offsets)) + 1
    line[at] = values
    return line


# -- pairs of neighbours --------------------------------------------------------------

def packed(*arrays: np.ndarray) -> bytes:
    """Integer arrays, in as few bytes as their numbers need and compressed with equal bytes of all numbers side by side."""
    small = [x.astype(np.result_type(np.min_scalar_type(x.min()), np.min_scalar_type(x.max()))) if len(x) else x for x in arrays]
    data = pickle.dumps([(x.dtype.str, x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()) for x in small])
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> list[np.ndarray]:
    parts = pickle.loads(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True))
    return [np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel().astype(np.int64)
            for kind, x in parts]


def owner(codes: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(codes.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def on_driver(codes: np.ndarray, top: int) -> np.ndarray:
    """Whether a code is the edge or one of the ``top`` most frequent words."""
    return (codes >= EDGE) & (codes < FIRST + top)


def filled(data: np.ndarray) -> bytes:
    """The places and values of counts that are not 0, packed."""
    at = np.flatnonzero(data)
    return packed(at, data[at].astype(np.int64))


def summed(size: int, *parts: bytes) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for at, n in map(unpacked, parts):
        out[at] += n
    return out


def pair_blocks(texts: DataFrame, words: Words, parts: int, top: int) -> DataFrame:
    """``(part, data)``: the pairs in the texts, once for either word, packed as words without a symbol, word, neighbour, side, n
    and the end of each bucket.

    A word is its symbol, or -1 less its place among those without one.  Side 0 has the neighbour after the
    word, side 1 before it; a text begins and ends at the edge.  A word on the driver has its pairs with such words only.
    """
    shared = texts.sparkSession.sparkContext.broadcast(words)
    schema = pa.schema([("part", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = byte_values(batch.column(0))
            for lo, hi in chunks(values):
                made = WordCodes(values[lo:hi])
                known = len(made.words)
                code = np.append(shared.value.codes(made.hashes()), EDGE)
                line = edged(made, made.codes, known)
                pairs, n = np.unique(line[:-1] * (known + 1) + line[1:], return_counts=True)
                a, b = pairs // (known + 1), pairs % (known + 1)
                wide, bucket = on_driver(code, top), owner(code, parts * SPLIT)
                place = (bucket % parts * SPLIT + bucket // parts).astype(np.uint16 if parts * SPLIT < 1 << 16 else np.int64)
                first, second = ~wide[a] | wide[b], ~wide[b] | wide[a]
                word, near = np.concatenate([a[first], b[second]]), np.concatenate([b[first], a[second]])
                side, n = np.repeat([0, 1], [first.sum(), second.sum()]), np.concatenate([n[first], n[second]])
                to = place[word]
                order = np.argsort(to, kind="stable")
                ends = np.cumsum(np.bincount(to, minlength=parts * SPLIT)).reshape(parts, SPLIT)
                starts = np.append(0, ends[:-1, -1])
                filled_parts = np.flatnonzero(ends[:, -1] > starts)
                found = []
                for q in filled_parts:
                    part = order[starts[q]:ends[q, -1]]
                    ids = code[np.concatenate([word[part], near[part]])]
                    rare, at = np.unique(ids[ids < 0], return_inverse=True)
                    ids[ids < 0] = -1 - at
                    found.append(packed(rare, ids[:len(part)], ids[len(part):], side[part], n[part], ends[q] - starts[q]))
                yield gather({"part": pa.array(filled_parts), "data": found}, schema)

    return texts.select("text").mapInArrow(run, "part long, data binary")


def merged_links(blocks: DataFrame, parts: int, symbols: int) -> DataFrame:
    """``(bucket, data)``: the packed ``Links`` of each bucket."""
    schema = pa.schema([("bucket", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[bytes]] = {}
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.setdefault(part, []).append(data)
        while found:
            part, blocks = found.popitem()
            pieces: list[list[tuple]] = [[] for _ in range(SPLIT)]
            while blocks:
                rare, *columns, ends = unpacked(blocks.pop())
                columns = [x.astype(np.int32) for x in columns]
                for k, (lo, hi) in enumerate(zip(np.append(0, ends), ends, strict=False)):
                    if hi > lo:
                        pieces[k].append((rare, *(x[lo:hi] for x in columns)))
            for k in range(SPLIT):
                mine, pieces[k] = pieces[k], []
                if mine:
                    yield gather({"bucket": [part + k * parts], "data": [packed(*vars(Links.of(mine, symbols)).values())]}, schema)

    return blocks.repartition(parts, "part").mapInArrow(run, "bucket long, data binary")


@dataclass
class Links:
    """The pairs of one bucket, by word.  A word is its symbol, or ``symbols`` and its place in ``rare``."""

    words: np.ndarray   # sorted
    starts: np.ndarray  # of each word's pairs, one more than words
    side: np.ndarray
    near: np.ndarray    # the neighbours
    n: np.ndarray
    rare: np.ndarray    # codes of words and neighbours without a symbol, sorted
    own: np.ndarray     # times that a word follows itself

    @classmethod
    def of(cls, pieces: list[tuple], symbols: int) -> Links:
        codes = [np.concatenate([np.where(x[k] < 0, x[0][-1 - np.minimum(x[k], -1)], x[k]) if len(x[0]) else x[k] for x in pieces]).astype(np.int64)
                 for k in (1, 2)]
        side, n = (np.concatenate([x[k] for x in pieces]) for k in (3, 4))
        rare = distinct(np.concatenate([x[x < 0] for x in codes]))
        for x in codes:
            x[x < 0] = symbols + np.searchsorted(rare, x[x < 0])
        space = symbols + len(rare)
        key = (codes[0] * 2 + side) * space + codes[1]
        del codes, side
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        n, key = np.add.reduceat(n[order], first, dtype=np.int64), key[first]
        row, near = key // (2 * space), key % space
        side = key // space % 2
        starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        words = row[starts]
        again = (row == near) & (side == 0)
        own = np.bincount(np.searchsorted(words, row[again]), n[again], len(words)).astype(np.int64)
        return cls(words, np.append(starts, len(row)), side, near, n, rare, own)

    def codes(self, words: np.ndarray, symbols: int) -> np.ndarray:
        return np.where(words < symbols, words, self.rare[np.maximum(words - symbols, 0)] if len(self.rare) else 0)


# -- exchange clustering -----------------------------------------------------------

class Clusters:
    """Classes of all words of ``texts``, changed by sweeps: of symbols on the driver, of other words in the buckets.

    An element of a bucket is ``(bucket, (kind, data))``: its ``links``, its ``state`` (the classes of the words in ``rare``),
    ``news`` of neighbours that have moved, and ``moved`` symbols, for the driver.  Links and state lie in the same
    partition, so a sweep moves nothing but the news.
    """

    def __init__(self, texts: DataFrame, words: Words, classes: int):
        self.context = texts.sparkSession.sparkContext
        self.parts, self.classes, self.top = shuffle_width(texts.sparkSession), classes, TOP_WORDS
        symbols, start = words.symbol_count, classes - 2

        links = merged_links(pair_blocks(texts, words, self.parts, self.top), self.parts, symbols)
        self.links = links.rdd.map(lambda r: (r[0], ("links", bytes(r[1])))).partitionBy(self.parts, int)
        self.state: RDD | None = None   # all words without a symbol begin in the class of the others
        # the most frequent words begin in a class each, the others together
        self.hot = np.full(symbols, start)
        self.hot[FIRST:FIRST + start] = np.arange(len(self.hot[FIRST:FIRST + start]))
        self.hot[EDGE] = classes - 1

    def rows(self, work) -> RDD:
        """``work(bucket, links, state)`` of every bucket."""
        start = self.classes - 2

        def run(items: Iterator) -> Iterator:
            found: dict[int, dict[str, list]] = {}
            for bucket, (kind, data) in items:
                found.setdefault(bucket, {}).setdefault(kind, []).append(data)
            for bucket, kinds in found.items():
                links = Links(*unpacked(kinds["links"][0]))
                state = unpacked(kinds["state"][0])[0] if "state" in kinds else np.full(len(links.rare), start)
                for data in kinds.get("news", ()):
                    codes, classes = unpacked(data)
                    state[np.searchsorted(links.rare, codes)] = classes
                yield from work(bucket, links, state)

        return (self.links if self.state is None else self.links.union(self.state)).mapPartitions(run)

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The class bigrams (row: first); of the words on the driver the neighbours by ``(word, side, class)`` and the times that they follow themselves."""
        classes, top, hot = self.classes, self.top, self.context.broadcast(self.hot)
        wide = int(on_driver(np.arange(len(self.hot)), top).sum())
        shapes = [(classes, classes), (wide, 2, classes), (wide,)]
        ends = np.cumsum([int(np.prod(x)) for x in shapes])

        def work(bucket: int, links: Links, state: np.ndarray) -> Iterator:
            place = np.concatenate([hot.value, state])
            mine, other, width = place[links.words], place[links.near], np.diff(links.starts)
            # words on the driver come first: their symbols are the least, and so are those neighbours of a word
            first = int(on_driver(links.words, top).sum())
            held = links.starts[first]
            word, side, n = np.repeat(mine, width), links.side, links.n
            key = (np.repeat(links.words[:first] - EDGE, width[:first]) * 2 + side[:held]) * classes + other[:held]
            near = np.bincount(key, n[:held], wide * 2 * classes)
            # pairs of a word on the driver that lie with the other word
            turned = held + np.flatnonzero(links.near[held:] < FIRST + top)
            back = np.bincount(((links.near[turned] - EDGE) * 2 + 1 - side[turned]) * classes + word[turned], n[turned], wide * 2 * classes)
            table = np.bincount((side * classes + word) * classes + other, n, 2 * classes ** 2)[:classes ** 2].reshape(classes, classes)
            np.add.at(table, hot.value[EDGE:EDGE + wide], back.reshape(wide, 2, classes)[:, 0])
            yield filled(np.concatenate([table.ravel(), near + back, np.bincount(links.words[:first] - EDGE, links.own[:first], wide)]))

        def add(x: bytes, y: bytes) -> bytes:
            return filled(summed(int(ends[-1]), x, y))

        found = summed(int(ends[-1]), self.rows(work).treeAggregate(filled(np.zeros(0, np.int64)), add, add)).astype(float)
        return tuple(x.reshape(shape) for x, shape in zip(np.split(found, ends[:-1]), shapes, strict=True))

    def sweep(self, number: int, table: np.ndarray, near_top: np.ndarray, own_top: np.ndarray) -> None:
        """Words of one half (all at first) move to where the class bigrams gain most."""
        classes, buckets, top = self.classes, self.parts * SPLIT, self.top
        hot, gains = self.context.broadcast(self.hot), self.context.broadcast(Gains(table))

        def turn(codes: np.ndarray) -> np.ndarray:
            return (codes + number) % 2 == 0 if number else np.ones(len(codes), bool)

        def work(bucket: int, links: Links, state: np.ndarray) -> Iterator:
            symbols = len(hot.value)
            place = np.concatenate([hot.value, state])
            width, driven = np.diff(links.starts), on_driver(links.words, top)
            chosen = np.flatnonzero(turn(links.codes(links.words, symbols)) & ~driven)
            now = place[links.words]
            mine = now.copy()
            # words with one neighbour on either side gain alike if these are: one of each kind is worked out
            two = chosen[width[chosen] == 2]
            at = links.starts[two]
            _, of_kind, kind = np.unique(((links.n[at] * classes + place[links.near[at]]) * classes + place[links.near[at + 1]]) * classes + mine[two],
                                         return_index=True, return_inverse=True)
            each = np.concatenate([chosen[width[chosen] != 2], two[of_kind]])
            for lo in range(0, len(each), SLICE_ROWS):
                part = each[lo:lo + SLICE_ROWS]
                wide = width[part]
                at = np.repeat(links.starts[part] - np.append(0, np.cumsum(wide)[:-1]), wide) + np.arange(wide.sum())
                key = (np.repeat(np.arange(len(part)), wide) * 2 + links.side[at]) * classes + place[links.near[at]]
                sums = np.bincount(key, links.n[at], len(part) * 2 * classes).reshape(-1, 2, classes)
                now[part] = gains.value.moves(sums[:, 0], sums[:, 1], links.own[part], mine[part])
            now[two] = now[two[of_kind]][kind]
            moved = np.flatnonzero(now != mine)
            seen = moved[links.words[moved] < symbols]
            yield bucket, ("moved", packed(links.words[seen], now[seen]))
            moved = moved[links.words[moved] >= symbols]
            state[links.words[moved] - symbols] = now[moved]
            yield bucket, ("state", packed(state))
            # a pair lies with its neighbour too, unless that is on the driver
            wide = width[moved]
            at = np.repeat(links.starts[moved] - np.append(0, np.cumsum(wide)[:-1]), wide) + np.arange(wide.sum())
            near, row = links.near[at], np.repeat(np.arange(len(moved)), wide)
            to = owner(links.codes(near, symbols), buckets)
            pairs = distinct((to * max(len(moved), 1) + row)[(to != bucket) & ~on_driver(near, top)])
            to, row = pairs // max(len(moved), 1), moved[pairs % max(len(moved), 1)]
            first = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else to
            for x, y in zip(first, np.append(first[1:], len(to)), strict=False):
                yield int(to[x]), ("news", packed(links.codes(links.words[row[x:y]], symbols), now[row[x:y]]))

        made = self.rows(work).partitionBy(self.parts, int)
        after = self.hot.copy()
        wide = np.arange(FIRST, EDGE + len(own_top))
        wide = wide[turn(wide)]
        after[wide] = gains.value.moves(near_top[wide - EDGE, 0], near_top[wide - EDGE, 1], own_top[wide - EDGE], self.hot[wide])
        for symbols, place in map(unpacked, made.filter(lambda x: x[1][0] == "moved").map(lambda x: x[1][1]).collect()):
            after[symbols] = place
        self.hot, self.state = after, made

    def table(self, spark: SparkSession, hot: np.ndarray, state: RDD | None) -> DataFrame:
        """``(code, class)`` of the words without a symbol, in one state."""
        self.hot, self.state = hot, state
        symbols = len(hot)
        schema = pa.schema([("code", pa.int64()), ("class", pa.int32())])

        def work(bucket: int, links: Links, state: np.ndarray) -> Iterator:
            mine = links.words[links.words >= symbols] - symbols
            yield bytearray(packed(links.rare[mine], state[mine])),

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for data in batch.column(0).to_pylist():
                    codes, place = unpacked(data)
                    yield gather({"code": pa.array(codes), "class": pa.array(place.astype(np.int32))}, schema)

        return spark.createDataFrame(self.rows(work), "data binary").mapInArrow(run, "code long, class int")


def cluster(texts: DataFrame, words: Words, classes: int | None = None, sweeps: int | None = None) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """Class of each symbol but the endings, the class bigram counts (row: first), and ``(code, class)`` of the words without a symbol."""
    classes, sweeps = CLASSES if classes is None else classes, SWEEPS if sweeps is None else sweeps
    made, best = Clusters(texts, words, classes), None
    for number in range(sweeps + 1):
        counts, near_top, own_top = made.counts()
        value = _information(counts)
        if best is None or value > best[0]:
            best = value, made.hot, counts, made.state
        if number < sweeps:
            made.sweep(number, counts, near_top, own_top)
    others = materialise(made.table(texts.sparkSession, best[1], best[3]), "classes")
    return best[1], best[2], others


def _plogp(x: np.ndarray) -> np.ndarray:
    x = np.maximum(x, 0)
    return x * np.log(np.maximum(x, 1e-300))


def _information(counts: np.ndarray) -> float:
    return float(_plogp(counts).sum() - _plogp(counts.sum(0)).sum() - _plogp(counts.sum(1)).sum())


class Gains:
    """What the class bigrams ``counts`` gain when words move."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        classes, small = len(counts), np.arange(1, SMALL + 1)[:, None, None]
        # by count and class of the neighbour: gain of a pair with it, for each class of the word
        self.sides = [(x, (_plogp(x + small) - _plogp(x)).reshape(SMALL * classes, classes)) for x in (counts.T, counts)]

    def moves(self, after: np.ndarray, before: np.ndarray, own: np.ndarray, home: np.ndarray) -> np.ndarray:
        """The best class of each word by the counts of the classes after and before it; ``own``: times that it follows itself."""
        if not len(home):
            return home
        gain = self.gains(after, before, own, home)
        gain[:, -1] = -np.inf  # the edge's own class
        best = gain.argmax(1)
        rows = np.arange(len(home))
        return np.where(gain[rows, best] > gain[rows, home] + 1e-9, best, home)

    def gains(self, after: np.ndarray, before: np.ndarray, own: np.ndarray, home: np.ndarray) -> np.ndarray:
        """Of adding each word to each class, once it is taken out of its own."""
        counts, f, rows, classes = self.counts, _plogp, np.arange(len(home)), len(self.counts)
        after, before = np.ascontiguousarray(after), np.ascontiguousarray(before)
        gain, stay = np.zeros(after.shape), np.zeros(len(home))
        for x, (table, looked) in zip((after, before), self.sides, strict=True):
            for n in range(1, TINY + 1):
                gain += (x == n).astype(float) @ looked[(n - 1) * classes:n * classes]
            flat = x.ravel()
            for at, small in ((np.flatnonzero((flat > TINY) & (flat <= SMALL)), True), (np.flatnonzero(flat > SMALL), False)):
                w, n = at // classes, flat[at]
                j = at - w * classes
                each = looked[(n.astype(np.int64) - 1) * classes + j] if small else f(table[j] + n[:, None]) - f(table[j])
                if len(w):
                    first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
                    gain[w[first]] += np.add.reduceat(each, first, axis=0)
            at = np.flatnonzero(flat)
            w, n = at // classes, flat[at]
            h, j = home[w], at - w * classes
            here = table.ravel()[j * classes + h]
            stay += np.bincount(w, np.where(j == h, 0, f(here) - f(here - n)), len(home))
            total, kind = np.unique(x.sum(1), return_inverse=True)
            sums = table.sum(0)
            gain -= (f(sums + total[:, None]) - f(sums))[kind]
            stay -= f(sums[home]) - f(sums[home] - x.sum(1))
        # cells that a word's pairs fill from both sides
        at = np.flatnonzero((after + before > 0) | (own > 0)[:, None])
        at = at[at % classes != home[at // classes]]
        w = at // classes
        c, h, q = at - w * classes, home[w], own[w]
        out_c, in_c, out_h, in_h = after.ravel()[at], before.ravel()[at], after[rows, home][w], before[rows, home][w]
        both, to, back = (counts.ravel()[x] for x in (c * (classes + 1), c * classes + h, h * classes + c))
        gain.ravel()[at] += (f(both + out_c + in_c + q) - f(both + out_c) - f(both + in_c) + f(both)
                             + f(to - in_c + out_h - q) - f(to - in_c) - f(to + out_h) + f(to)
                             + f(back - out_c + in_h - q) - f(back - out_c) - f(back + in_h) + f(back))
        corner = counts[home, home]
        gain[rows, home] = stay + f(corner) - f(corner - after[rows, home] - before[rows, home] + own)
        return gain


# -- the model ----------------------------------------------------------------------

@dataclass
class Model:
    words: Words
    symbol_class: np.ndarray
    transitions: np.ndarray   # log10 P(class | class before)
    emission_base: np.ndarray  # log10 of each class's emission denominator
    tokens: int               # N
    different: int            # V
    end_count: int            # of the end token
    counts: DataFrame | None = None

    @property
    def base_denominator(self) -> float:
        return float(np.log10(self.tokens + SMOOTHING * (self.different + 1)))


def classed(counts: DataFrame, words: Words, place: np.ndarray, others: DataFrame) -> DataFrame:
    """``counts`` with the class of every word."""
    shared = counts.sparkSession.sparkContext.broadcast((words, place))
    schema = pa.schema([("word", pa.int64()), ("ending", pa.int32()), ("n", pa.int64()), ("code", pa.int64()), ("held", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, symbol_class = shared.value
        for batch in batches:
            codes = known.codes(batch.column(0).to_numpy().view(np.uint64))
            held = pa.array(symbol_class[np.maximum(codes, 0)].astype(np.int32), mask=codes < 0)
            yield gather({**{c: batch.column(c) for c in ("word", "ending", "n")}, "code": pa.array(codes), "held": held}, schema)

    rows = counts.select("word", "ending", "n").mapInArrow(run, "word long, ending int, n long, code long, held int")
    found = rows.filter("held is null").join(others, "code")
    return rows.filter("held is not null").select("word", "ending", "n", F.col("held").alias("class")).unionByName(
        found.select("word", "ending", "n", "class"))


def fit(texts: DataFrame, classes: int | None = None, sweeps: int | None = None) -> Model:
    """A model of ``texts(text)``; nothing to learn from gives a model of unknown words only."""
    classes = CLASSES if classes is None else classes
    counted = materialise(word_counts(texts), "word-counts")
    words = frequent_words(counted)
    place, table, others = cluster(texts, words, classes, sweeps)
    counts = materialise(classed(counted, words, place, others), "word-classes")
    n, v = np.zeros(classes), np.zeros(classes)
    by_ending = np.zeros((ENDINGS + 1, classes))
    for row in counts.groupBy("ending", "class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():  # bounded
        n[row["class"]] += row["n"]
        v[row["class"]] += row["v"]
        by_ending[row["ending"], row["class"]] = row["v"]
    by_ending = by_ending[:ENDINGS]
    place = place.copy()
    place[:ENDINGS] = np.where(by_ending.any(1), by_ending.argmax(1), by_ending.sum(0).argmax())
    share = (n + SMOOTHING) / (n.sum() + SMOOTHING * classes)
    transitions = np.log10((table + BACKOFF * share[None, :]) / (table.sum(1, keepdims=True) + BACKOFF))
    return Model(words, place, transitions, np.log10(n + SMOOTHING * (v + 1)), int(n.sum()), int(v.sum()), int(n[classes - 1]), counts)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col, n_tokens, n_known, base_score, score``, log10 probabilities of the whole text.

    A text's tokens are its words and one end; null and empty texts have the end alone.
    Repeated rows are scored alike; other columns are ignored.  Very long texts are scored
    whole; an empty table gives no rows.
    """
    spark = docs.sparkSession
    counts, model.counts = model.counts, None  # a DataFrame can't be broadcast
    shared = spark.sparkContext.broadcast(model)
    model.counts = counts
    edge_class = len(model.transitions) - 1
    rare = pa.list_(pa.struct([("word", pa.int64()), ("class", pa.int32())]))
    numbers = [("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
               ("base_score", pa.float64()), ("score", pa.float64())]
    schema = pa.schema([*numbers, ("rare", rare), ("times", pa.list_(pa.int64())), ("before", pa.list_(pa.int32())), ("after", pa.list_(pa.int32()))])
    done = pa.schema(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            values = byte_values(batch.column(2))
            for lo, hi in chunks(values, SCORE_BYTES):
                made = WordCodes(values[lo:hi])
                hashes = made.hashes()
                count, symbol = m.words.find(hashes, endings(made.words))
                group = m.symbol_class[symbol].astype(np.int64)
                hot = count >= 0
                base = np.where(hot, np.log10(np.maximum(count, 0) + SMOOTHING), 0.0)
                emit = np.where(hot, base - m.emission_base[group], 0.0)
                base = np.where(hot, base - m.base_denominator, 0.0)
                sums = [np.concatenate([[0.0], np.cumsum(x[made.codes])]) for x in (base, emit, hot.astype(float))]
                end = np.log10(m.end_count + SMOOTHING)
                a, b = made.offsets[:-1], made.offsets[1:]
                texts = np.arange(hi - lo)
                # words that are not hot: their class is looked up later, a step beside them is kept as classes and -1 - places
                cold = np.flatnonzero(~hot[made.codes])
                width = max(len(made.words), 1)
                found, at, times = np.unique(np.searchsorted(b, cold, side="right") * width + made.codes[cold], return_inverse=True, return_counts=True)
                bounds = np.searchsorted(found, np.arange(hi - lo + 1) * width)
                codes = found % width
                token = group[made.codes]
                token[cold] = (bounds[found // width] - np.arange(len(found)) - 1)[at]
                line = edged(made, token, edge_class)
                before, after = line[:-1], line[1:]
                open_steps = (before < 0) | (after < 0)
                steps = np.concatenate([[0.0], np.cumsum(np.where(open_steps, 0.0, m.transitions[np.maximum(before, 0), np.maximum(after, 0)]))])
                kept = np.flatnonzero(open_steps)
                # the steps into text i begin at its edge, which is at offset + i
                cuts = pa.array(np.searchsorted(kept, np.append(a + texts, len(before))).astype(np.int32))
                bounds = pa.array(bounds.astype(np.int32))
                yield gather({
                    "row": batch.column(0).slice(lo, hi - lo), "doc_id": batch.column(1).slice(lo, hi - lo),
                    "n_tokens": pa.array(b - a + 1),
                    "n_known": pa.array((sums[2][b] - sums[2][a]).round().astype(np.int64) + (m.end_count > 0)),
                    "base_score": pa.array(sums[0][b] - sums[0][a] + end - m.base_denominator),
                    "score": pa.array(steps[b + texts + 1] - steps[a + texts] + sums[1][b] - sums[1][a]),
                    "rare": pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays(
                        [pa.array(hashes[codes].view(np.int64)), pa.array(group[codes].astype(np.int32))], fields=list(rare.value_type))),
                    "times": pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int64))),
                    "before": pa.ListArray.from_arrays(cuts, pa.array(before[kept].astype(np.int32))),
                    "after": pa.ListArray.from_arrays(cuts, pa.array(after[kept].astype(np.int32)))}, schema)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            rows = batch.num_rows
            lists = batch.column("found")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.cumsum(sizes) - sizes
            place, group, n = (lists.flatten().field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
            of = np.repeat(np.arange(rows), sizes)
            at = starts[of] + place
            classes, count = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            classes[at], count[at] = group, n
            times = batch.column("times").flatten().to_numpy(zero_copy_only=False)
            log = np.log10(count + SMOOTHING)
            wide = pc.list_value_length(batch.column("before")).to_numpy(zero_copy_only=False).astype(np.int64)
            text = np.repeat(np.arange(rows), wide)
            sides = [batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("before", "after")]
            for side in sides:
                side[side < 0] = classes[starts[text[side < 0]] - 1 - side[side < 0]]
            more = {"n_known": np.bincount(of, np.where(count > 0, times, 0), rows).astype(np.int64),
                    "base_score": np.bincount(of, times * (log - m.base_denominator), rows),
                    "score": np.bincount(of, times * (log - m.emission_base[classes]), rows) + np.bincount(text, m.transitions[tuple(sides)], rows)}
            yield gather({c: pc.add(batch.column(c), pa.array(more[c])) if c in more else batch.column(c) for c in done.names}, done)

    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    kinds = "row long, doc_id long, n_tokens long, n_known long, base_score double, score double"
    made = materialise(keyed.mapInArrow(run, f"{kinds}, rare array<struct<word long, class int>>, times array<long>, "
                                             "before array<int>, after array<int>"), "scored")
    rows = made.filter(F.size("rare") > 0).select("row", F.posexplode("rare").alias("k", "x")).select("row", "k", "x.word", F.col("x.class").alias("unseen"))
    known = rows.join(counts.select("word", "n", "class"), "word", "left").groupBy("row").agg(F.collect_list(
        F.struct("k", F.coalesce("class", "unseen").alias("class"), F.coalesce("n", F.lit(0)).alias("n"))).alias("found"))
    closed = made.drop("rare").join(known, "row", "left").mapInArrow(close, kinds)
    return closed.select(F.col("doc_id").alias(id_col), "n_tokens", "n_known", "base_score", "score")


def held_out_scores(docs: DataFrame, rest: int = 1, folds: int = 5) -> DataFrame:
    """Learn from rows whose ``crc32(doc_id as text) mod folds`` is not ``rest`` and score all rows.

    Columns: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity``
    (per token).  Rows without an id are held out.
    """
    fold = crc_mod("doc_id", folds)
    model = fit(docs.filter(fold != rest).select(F.col("text").cast("string").alias("text")))
    return score(docs, model).select(
        "doc_id", F.coalesce(fold == rest, F.lit(True)).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
