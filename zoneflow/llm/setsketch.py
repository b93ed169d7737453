"""Operator 5: near-duplicate documents by SetSketch registers.

1. Every text becomes its set of word shingles and ``m`` SetSketch registers
   ``K_i = floor(1 - log_base(min_x h_i(x)))`` with exponential ``h_i`` of rate
   ``RATE``, truncated to ``0 .. LIMIT + 1``.  Minima merge by maximum of ``K``.
2. Equal sets are one *class* with a 64-bit node number (a digest of the set), so
   copies meet in an aggregate and are never paired.
3. Registers are banded.  With ``BANDS`` bands of ``ROWS`` registers a pair at
   similarity 0.8 is missed with probability ``(1 - 0.8**6)**40 = 5e-6``; unrelated
   texts (similarity 0.05) meet with probability 6e-7.
4. Candidates pass the exact size bound, then the joint likelihood estimate of the
   similarity from the counts of larger, smaller and equal registers (five standard
   errors of slack), then a confirmation on the full sets.
5. A bucket is not expanded into all pairs.  Each member is tested against a pivot
   of its buckets, links are contracted to components, and buckets that lie in one
   component are done.  After ``PIVOT_ROUNDS`` rounds the members outside a bucket's
   largest component are compared with the bucket's other components in blocks of
   bounded size, so no link between different components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import (
    WordCodes,
    WorkTables,
    byte_values,
    chunks,
    distinct,
    gather,
    mix64,
    shingle_hashes,
    text_shingles,
)
from zoneflow.llm.components import connected_components

BASE, RATE, LIMIT = 1.001, 20.0, 65533   # registers fit 16 bits for sets of up to e^60 elements
BANDS, ROWS = 40, 6
REGISTERS = BANDS * ROWS
SLACK = 5.0            # standard errors that an estimate may lie below the threshold
PIVOT_ROUNDS = 3
BLOCK = 256            # members of one side of a block comparison

SKETCH_SCHEMA = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("node", pa.int64()),
                           ("n_shingles", pa.int64()), ("registers", pa.binary())])
_SKETCH_DDL = "doc_id long, text_key long, node long, n_shingles long, registers binary"

_seeds = mix64(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_XOR, _MULTIPLY = _seeds[:REGISTERS], _seeds[REGISTERS:] | np.uint64(1)


# -- registers -------------------------------------------------------------------

def registers(elements: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SetSketch registers (sets x REGISTERS, uint16) of element hashes; set ``i`` begins at ``starts[i]``."""
    out, mixed = np.empty((len(starts), REGISTERS), np.uint64), np.empty_like(elements)
    with np.errstate(over="ignore"):
        for i in range(REGISTERS):
            np.bitwise_xor(elements, _XOR[i], out=mixed)
            np.multiply(mixed, _MULTIPLY[i], out=mixed)
            out[:, i] = np.minimum.reduceat(mixed, starts)
    # the least of the exponential variates -log(1 - u) / RATE is that of the least u
    u = (out.astype(np.float64) + 0.5) / 2.0 ** 64
    return np.clip(np.floor(1 - np.log(-np.log1p(-u) / RATE) / np.log(BASE)), 0, LIMIT + 1).astype(np.uint16)


def estimate_similarity(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray,
                        steps: int = 100) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches whose set sizes are known."""
    above = (left > right).sum(1)[:, None]
    below = (left < right).sum(1)[:, None]
    equal = left.shape[1] - above - below
    u = (n_left / (n_left + n_right))[:, None]
    v = 1 - u
    j = np.minimum(u / v, v / u) * np.linspace(0, 1, steps + 1)[None, :]

    def p(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-12, 1)

    more, less = p(u - v * j), p(v - u * j)
    likelihood = above * np.log(more) + below * np.log(less) + equal * np.log(np.clip(1 - more - less, 1e-12, 1))
    return j[np.arange(len(j)), likelihood.argmax(1)]


def _similar(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray,
             percent: int) -> np.ndarray:
    """Pairs that may reach ``percent``: exact size bound, then the estimate with its slack."""
    t = percent / 100
    ok = 100 * np.minimum(n_left, n_right) >= percent * np.maximum(n_left, n_right)
    if ok.any():
        at = np.flatnonzero(ok)
        low = t - SLACK * np.sqrt(t * (1 - t) / REGISTERS)
        for some in np.array_split(at, len(at) // 2000 + 1):
            ok[some] = estimate_similarity(left[some], right[some], n_left[some], n_right[some]) >= low
    return ok


def sketch(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, text key, class node, set size, registers.

    Texts without words (null, empty, blank) and rows without an id have a null
    node and no registers: they are linked with nothing.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = byte_values(batch.column(2))
            for lo, hi in chunks(values):
                words = WordCodes(values[lo:hi])
                hashes = words.hashes()
                ids = batch.column(0).slice(lo, hi - lo)
                valid = ids.is_valid().to_numpy(zero_copy_only=False)
                sets = [distinct(x) for x in text_shingles(words.codes, words.offsets, hashes, size)]
                full = [i for i, s in enumerate(sets) if len(s) and valid[i]]
                nodes, regs = [None] * len(sets), [None] * len(sets)
                for some in _by_size(full, sets):
                    starts = np.cumsum([0] + [len(sets[i]) for i in some[:-1]])
                    made = registers(np.concatenate([sets[i] for i in some]), starts)
                    for i, row in zip(some, made, strict=True):
                        nodes[i] = int.from_bytes(hashlib.blake2b(sets[i].tobytes(), digest_size=8).digest(),
                                                  "little", signed=True)
                        regs[i] = row.tobytes()
                yield gather({"doc_id": ids, "text_key": batch.column(1).slice(lo, hi - lo), "node": nodes,
                              "n_shingles": [len(s) for s in sets], "registers": regs}, SKETCH_SCHEMA)

    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"),
                        F.col(text_col).cast("string").alias("text"))
    return keyed.mapInArrow(run, _SKETCH_DDL)


def _by_size(which: list[int], sets: list[np.ndarray], most: int = 65536) -> Iterator[list[int]]:
    """Runs of sets with about ``most`` elements together (they fit a cache)."""
    run, size = [], 0
    for i in which:
        if run and size + len(sets[i]) > most:
            yield run
            run, size = [], 0
        run.append(i)
        size += len(sets[i])
    if run:
        yield run


# -- candidates --------------------------------------------------------------------

def band_keys(classes: DataFrame) -> DataFrame:
    """``(band, node)``: one row per class and band; equal bands of registers share the number."""
    schema = pa.schema([("band", pa.int64()), ("node", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = _bands(_matrix(batch.column(1)))
            nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
            yield gather({"band": pa.array(keys.ravel()), "node": pa.array(nodes)}, schema)

    return classes.select("node", "registers").mapInArrow(run, "band long, node long")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _bands(regs: np.ndarray) -> np.ndarray:
    """A 64-bit number per sketch and band."""
    with np.errstate(over="ignore"):
        out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(regs), BANDS))
        for row in range(ROWS):
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + regs[:, row::ROWS].astype(np.uint64))
    return out.view(np.int64)


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sketches allow the similarity."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    one = classes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("registers").alias("ra"))
    two = classes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("registers").alias("rb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = {f: batch.column(f) for f in batch.schema.names}
                ok = _similar(_matrix(x["ra"]), _matrix(x["rb"]), x["na"].to_numpy(), x["nb"].to_numpy(), percent)
                yield gather({"a": x["a"].filter(pa.array(ok)), "b": x["b"].filter(pa.array(ok))}, schema)

    sized = pairs.join(two, "b").join(one, "a").filter(
        F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    return sized.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long")


def _texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(node, z)``: the compressed text of one document for every class in ``wanted``."""
    schema = pa.schema([("rep", pa.int64()), ("text_key", pa.int64()), ("z", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield gather({"rep": batch.column(0), "text_key": batch.column(1),
                          "z": [pack.compress(v or b"") for v in byte_values(batch.column(2))]}, schema)

    packed = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("rep"), F.xxhash64(text_col).alias("text_key"),
        F.col(text_col).cast("string").alias("text")).mapInArrow(run, "rep long, text_key long, z binary")
    return wanted.join(packed, ["rep", "text_key"]).select("node", "z").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach ``percent``."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    both = (pairs.join(texts.select(F.col("node").alias("b"), F.col("z").alias("zb")), "b")
            .join(texts.select(F.col("node").alias("a"), F.col("z").alias("za")), "a").select("a", "b", "za", "zb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        known: dict[int, np.ndarray] = {}

        def elements(node: int, z: bytes) -> np.ndarray:
            if node not in known:
                if len(known) >= 64:
                    known.clear()
                words = WordCodes([unpack.decompress(z)])
                known[node] = distinct(shingle_hashes(words.codes, words.hashes(), size))
            return known[node]

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ok = []
            for k in range(batch.num_rows):
                ok.append(_reaches(elements(a[k], batch.column(2)[k].as_py()),
                                   elements(b[k], batch.column(3)[k].as_py()), percent))
            yield gather({"a": batch.column(0).filter(pa.array(ok, pa.bool_())),
                          "b": batch.column(1).filter(pa.array(ok, pa.bool_()))}, schema)

    return both.mapInArrow(run, "a long, b long")


def _strangers(members: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` between different components of one bucket, found in blocks.

    ``members``: ``(band, node, component)`` of the buckets still open.  Per bucket
    the members outside its largest component form the left side; every member is
    on the right side.  Both are dealt into blocks of about ``BLOCK`` members by a
    hash, and each pair of blocks is one group, so memory is bounded and no pair is
    left out.  A pair that meets in several bands is looked at in the first of them;
    only confirmed links leave a group, and none between members already linked there.
    """
    sizes = (members.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("band")
             .agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n")))
    sizes = sizes.select("band", F.col("top.component").alias("main"),
                         F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks_r"),
                         F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("blocks_l"))
    facts = classes.select("node", "n_shingles", "registers").join(texts, "node")
    rows = members.join(sizes, "band").join(facts, "node")

    def side(frame: DataFrame, own: str, other: str, left: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("node", F.lit(1)), F.col(own)).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        x, y = ("i", "j") if left else ("j", "i")
        return frame.select("band", mine.alias(x), theirs.alias(y), F.lit(left).alias("is_left"), "node",
                            "component", "n_shingles", "registers", "z")

    both = side(rows.filter("component != main"), "blocks_l", "blocks_r", True).unionByName(
        side(rows, "blocks_r", "blocks_l", False))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(group: pa.Table) -> pa.Table:
        lefts = np.flatnonzero(group["is_left"].to_numpy())
        rights = np.flatnonzero(~group["is_left"].to_numpy())
        node, n = (group[c].to_numpy() for c in ("node", "n_shingles"))
        component = group["component"].to_numpy().copy()
        regs = _matrix(group["registers"].combine_chunks())
        bands = _bands(regs)
        here = int((bands[0] == group["band"][0].as_py()).argmax())
        unpack, sets = zstandard.ZstdDecompressor(), {}

        def elements(i: int) -> np.ndarray:
            if i not in sets:
                words = WordCodes([unpack.decompress(group["z"][i].as_py())])
                sets[i] = distinct(shingle_hashes(words.codes, words.hashes(), size))
            return sets[i]

        found = []
        for i in lefts:
            others = rights[component[rights] != component[i]]
            others = others[(bands[others] == bands[i]).argmax(1) == here]
            if not len(others):
                continue
            ok = _similar(np.broadcast_to(regs[i], (len(others), REGISTERS)), regs[others],
                          np.full(len(others), n[i]), n[others], percent)
            for o in others[ok]:
                if component[o] != component[i] and _reaches(elements(i), elements(o), percent):
                    found.append((min(node[i], node[o]), max(node[i], node[o])))
                    component[component == component[o]] = component[i]
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}, schema=schema)

    return both.groupBy("band", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def _reaches(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two full sets (sorted, distinct) reach the similarity."""
    common = len(x) + len(y) - len(distinct(np.concatenate([x, y])))
    return 100 * common >= percent * (len(x) + len(y) - common)


# -- the operator --------------------------------------------------------------------

def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked where ``100 * |A & B| >= percent * |A | B|`` over their sets
    of ``size``-word shingles (shorter texts: the whole sequence is one shingle).
    ``component_id`` is the smallest id reachable, ``kept`` is true for that document.
    Null, empty and blank texts have no shingles, and they as well as rows without an
    id are linked with nothing and kept.  Rows that repeat an id are told apart by
    their texts; rows repeated in full give equal rows.  Other columns are ignored.
    An empty table gives no rows.
    """
    return _near_duplicates(docs, size, percent, id_col, text_col).drop("text_key")


def _near_duplicates(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``near_duplicates`` with the text's key, as a table of its own; the work tables are gone."""
    work = WorkTables(docs.sparkSession)
    sketched = work.keep(sketch(docs, size, id_col, text_col), "sketch")
    classes = work.keep(
        sketched.filter("node is not null").groupBy("node")
        .agg(F.min(F.struct("doc_id", "text_key")).alias("rep"), F.first("n_shingles").alias("n_shingles"),
             F.first("registers").alias("registers"))
        .select("node", F.col("rep.doc_id").alias("rep"), F.col("rep.text_key").alias("text_key"),
                "n_shingles", "registers"), "classes")

    bands = band_keys(classes)
    pivots = bands.groupBy("band").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = work.keep(bands.join(pivots, "band").select("band", "node", "pivot", "n"), "members")
    wanted = classes.join(members.select("node").distinct(), "node").select("node", "rep", "text_key")
    texts = work.keep(_texts(docs, wanted, id_col, text_col), "texts")

    # round 1: every class against the smallest pivot of its buckets
    pairs = members.groupBy("node").agg(F.min("pivot").alias("a")).filter("a != node").select(
        "a", F.col("node").alias("b"))
    state, tested = members.select("node", F.col("node").alias("component")).distinct(), None
    members = members.select("band", "node", "n")
    for turn in range(1, PIVOT_ROUNDS + 1):
        tried = work.keep(_estimated(pairs, classes, percent), "tried")
        tested = tried if tested is None else tested.unionByName(tried)
        state = _merged(work, state, work.keep(_confirmed(tried, texts, size, percent), "links"))
        now = members.join(state, "node")
        open_ = now.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                        F.min_by(F.struct("node", "component"), F.xxhash64("node", F.lit(turn))).alias("pivot"))
        now = work.keep(now.join(open_.filter("lo != hi").select("band", "pivot"), "band"), "open")
        if now.isEmpty():
            break
        if turn < PIVOT_ROUNDS:
            pairs = now.filter("component != pivot.component").select(
                F.least("pivot.node", "node").alias("a"), F.greatest("pivot.node", "node").alias("b")).distinct()
            pairs = pairs.join(tested.select("a", "b").distinct(), ["a", "b"], "left_anti")
        else:  # buckets of two have been tested in full
            rest = now.filter("n > 2").select("band", "node", "component")
            state = _merged(work, state, work.keep(_strangers(rest, classes, texts, size, percent), "links"))

    first = (state.join(classes.select("node", "rep"), "node").groupBy("component")
             .agg(F.min("rep").alias("component_id")))
    grouped = state.join(first, "component").select("node", "component_id")
    named = classes.select("node", "rep").join(grouped, "node", "left").select(
        "node", F.coalesce("component_id", "rep").alias("component_id"))
    out = sketched.select("doc_id", "text_key", "n_shingles", "node").join(named, "node", "left")
    out = out.select("doc_id", "text_key", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return work.result(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "near-duplicates")


def _merged(work: WorkTables, state: DataFrame, links: DataFrame) -> DataFrame:
    """``state`` (node, component) after the links have joined components."""
    named = state.select(F.col("node").alias("a"), F.col("component").alias("x"))
    other = state.select(F.col("node").alias("b"), F.col("component").alias("y"))
    joined = connected_components(links.join(named, "a").join(other, "b").select("x", "y"), "x", "y")
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("joined"))
    return work.keep(state.join(joined, "component", "left").select(
        "node", F.coalesce("joined", "component").alias("component")), "state")


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near copies the smallest id.

    All columns are kept.  A row repeated in full counts as a copy of itself: one
    stays.  Rows without an id all stay.
    """
    found = _near_duplicates(docs, size, percent, "doc_id", "text")
    kept = found.filter("kept and doc_id is not null").select(
        F.col("doc_id").alias("_kept_id"), F.col("text_key").alias("_kept_text")).distinct()
    with_id = docs.filter(F.col("doc_id").isNotNull())
    same = (with_id["doc_id"] == kept["_kept_id"]) & (F.xxhash64(with_id["text"]) == kept["_kept_text"])
    kept_rows = with_id.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept_rows.unionByName(docs.filter(F.col("doc_id").isNull()))
