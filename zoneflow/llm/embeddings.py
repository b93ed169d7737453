"""Operator 12: near-duplicate embeddings by int8 tile products.

1. Vectors that are equal in every component are one *class* with a count, so copies meet in an
   aggregate and are never paired.
2. Every vector has the signs of its projections on orthonormal directions (fixed by a seed).  The
   first ``b`` signs name its cell; ``b`` grows with the label's classes so that a cell holds about
   ``BLOCK`` of them, and larger cells are split by a hash.  Vectors at cosine ``t`` and above are
   at most ``sqrt(2 - 2 t)`` apart, so a vector can only have links in cells whose signs differ from
   its own in directions whose squared projections sum to no more than ``2 - 2 t``.  It is sent there.
3. A tile is a pair of blocks.  Both sides are rounded to int8 with a scale for each vector, one
   matrix product gives all cosines of the rounded vectors, and the norms of the rounding errors
   give a rigorous bound on what each may be off.  Pairs surely below the threshold are done, pairs surely
   above it are links, and only the others are computed again in double precision.
4. A tile hands on the number of links of each vector and a spanning forest of its links, no pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import WorkTables, gather
from zoneflow.llm.components import connected_components

BLOCK = 2048        # classes of one side of a tile
STRIP = 512         # rows of a tile whose products are held at a time
AGAIN = 100_000     # pairs computed again at a time
DIRECTIONS = 30     # signs of a vector at most
ROUNDING = 1e-5     # what single precision may add to the products' error, well above it

_VECTOR_DDL = "vec_id long, label string, dim int, node binary, signs int, vec binary"
_VECTOR_SCHEMA = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("node", pa.binary()),
                            ("signs", pa.int32()), ("vec", pa.binary())])


@lru_cache(maxsize=16)
def directions(dim: int) -> np.ndarray:
    """Orthonormal directions (dim x up to ``DIRECTIONS``), the same in every task."""
    made, _ = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, min(dim, DIRECTIONS))))
    return made


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1 (scaled by their greatest component first, so squares don't overflow)."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as ``(codes, scale, norm, error)``: int8 codes, what one step stands for, the length of the
    rounded vector, and the length of what rounding took away."""
    scale = np.abs(units).max(1) / 127
    codes = np.rint(units / scale[:, None]).astype(np.int8)
    rounded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(rounded, axis=1), np.linalg.norm(units - rounded, axis=1)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows, in single precision (1024 components of 127 squared fit its 24 bits)."""
    out = np.zeros((len(left), len(right)), np.float32)
    for k in range(0, left.shape[1], 1024):
        out += left[:, k:k + 1024].astype(np.float32) @ right[:, k:k + 1024].astype(np.float32).T
    return out


def links(left: np.ndarray, right: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers ``(i, j)`` of the unit vectors at ``threshold`` and above, strip by strip (``same``: ``i < j`` only)."""
    ql, sl, nl, el = quantised(left)
    qr, sr, _, er = (ql, sl, nl, el) if same else quantised(right)
    for at in range(0, len(left), STRIP):
        end = min(at + STRIP, len(left))
        since = at if same else 0    # products with rows before the strip are done
        near = products(ql[at:end], qr[since:]) * sl[at:end, None].astype(np.float32) * sr[None, since:].astype(np.float32)
        # |x.y - rounded| <= |rounded x| * error of y + error of x * |y|
        off = (nl[at:end, None] * er[None, since:] + el[at:end, None] + ROUNDING).astype(np.float32)
        i, j = np.nonzero(near + off >= threshold)
        ok = (near - off)[i, j] >= threshold
        i, j = i + at, j + since
        for some in np.array_split(np.flatnonzero(~ok), max(1, (~ok).sum() // AGAIN)):
            ok[some] = np.einsum("ij,ij->i", left[i[some]], right[j[some]]) >= threshold
        if same:
            ok &= i < j
        yield i[ok], j[ok]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(node, least node)`` of every node of a graph on ``0 .. n-1`` that is not the least of its component."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        np.minimum.at(new, label, new.copy())   # what a node learns holds for its component
        new = new[new]
        if (new == label).all():
            break
        label = new
    others = np.flatnonzero(label != np.arange(n))
    return others, label[others]


def _vectors(rows: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """One row per vector; those that link with nothing have a null ``node``."""
    kind = rows.schema[vec_col].dataType.simpleString()
    values = F.col(f"`{vec_col}`") if kind == "array<float>" else F.col(f"`{vec_col}`").cast("array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, lists = batch.column(0), batch.column(1), batch.column(2)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)   # null components are not a number
            starts = np.cumsum(sizes) - sizes
            known = labels.is_valid().to_numpy(zero_copy_only=False) & ids.is_valid().to_numpy(zero_copy_only=False)
            nodes, signs, vecs = ([None] * len(sizes) for _ in range(3))
            names = labels.to_pylist()
            for dim in np.unique(sizes[known & (sizes > 0)]).tolist():
                at = np.flatnonzero(known & (sizes == dim))
                x = flat[starts[at][:, None] + np.arange(dim)] + 0.0   # no negative zeros
                fine = np.isfinite(x).all(1) & (x != 0).any(1)
                at, x = at[fine], x[fine]
                if not len(at):
                    continue
                bits = (unit(x) @ directions(dim) >= 0).astype(np.int64)
                codes = bits @ (1 << np.arange(bits.shape[1]))
                for k, row, code in zip(at.tolist(), x, codes.tolist(), strict=True):
                    vecs[k] = row.tobytes()
                    nodes[k] = hashlib.blake2b(names[k].encode() + b"\0" + vecs[k], digest_size=16).digest()
                    signs[k] = code
            yield gather({"vec_id": ids, "label": labels, "dim": sizes.astype(np.int32).tolist(), "node": nodes, "signs": signs,
                          "vec": vecs}, _VECTOR_SCHEMA)

    return rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                       values.alias("values")).mapInArrow(run, _VECTOR_DDL)


def _matrix(column, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


def _visits(classes: DataFrame, kind: str, threshold: float) -> DataFrame:
    """``classes`` with ``visits``: the cells in which each may have links, its own among them."""
    names = ["label", "dim", "node", "n", "cell", "bits", "vec"]
    schema = pa.schema([("label", pa.string()), ("dim", pa.int32()), ("node", pa.binary()), ("n", pa.int64()),
                        ("cell", pa.int32()), ("bits", pa.int32()), ("vec", pa.binary()), ("visits", pa.list_(pa.int32()))])
    most = 2 - 2 * threshold + 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = np.stack([batch.column(1).to_numpy(), batch.column(5).to_numpy()], 1) if batch.num_rows else np.zeros((0, 2))
            for dim, bits in np.unique(shapes, axis=0).tolist():
                part = batch.filter(pa.array((shapes == (dim, bits)).all(1)))
                squares = (unit(_matrix(part.column(6), dim, kind)) @ directions(dim)[:, :bits]) ** 2
                row, mask, total = np.arange(len(squares)), np.zeros(len(squares), np.int64), np.zeros(len(squares))
                for k in range(bits):   # every set of signs that may differ, one direction at a time
                    more = total + squares[row, k]
                    ok = more <= most
                    row, mask, total = (np.concatenate([a, b[ok]]) for a, b in
                                        ((row, row), (mask, mask | (1 << k)), (total, more)))
                order = np.argsort(row, kind="stable")
                cells = (part.column(4).to_numpy()[row] ^ mask)[order].astype(np.int32)
                ends = np.cumsum(np.bincount(row, minlength=len(squares)))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(cells))
                yield pa.record_batch([*part.columns, lists], schema=schema)

    return classes.select(*names).mapInArrow(
        run, "label string, dim int, node binary, n long, cell int, bits int, vec binary, visits array<int>")


def _tiles(classes: DataFrame, kind: str, threshold: float) -> DataFrame:
    """``(node, n_links, other)``: links counted (``other`` null) and forest edges (``n_links`` 0) of all tiles."""
    schema = pa.schema([("node", pa.binary()), ("n_links", pa.int64()), ("other", pa.binary())])

    def compare(group: pa.Table) -> pa.Table:
        same = group["lo"][0].as_py() == group["hi"][0].as_py()
        dim = group["dim"][0].as_py()
        left = group.filter(group["is_lo"])
        right = left if same else group.filter(pc.invert(group["is_lo"]))
        nodes, others, counts = [], [], []
        if len(left) and len(right):
            x, y = (unit(_matrix(t["vec"], dim, kind)) for t in (left, right))
            nx, ny = left["n"].to_numpy(), right["n"].to_numpy()
            both = left["node"].to_pylist() + ([] if same else right["node"].to_pylist())
            total, shift = np.zeros(len(both), np.int64), 0 if same else len(x)
            stars_i, stars_j = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for i, j in links(x, y, threshold, same):
                np.add.at(total, i, ny[j])
                np.add.at(total, j + shift, nx[i])
                # the forest so far and the new links, never all links of the tile
                stars_i, stars_j = forest(len(both), np.concatenate([stars_i, i]), np.concatenate([stars_j, j + shift]))
            at = np.flatnonzero(total)
            nodes = [both[k] for k in at] + [both[k] for k in stars_i]
            counts = total[at].tolist() + [0] * len(stars_i)
            others = [None] * len(at) + [both[k] for k in stars_j]
        return pa.table({"node": pa.array(nodes, pa.binary()), "n_links": pa.array(counts, pa.int64()),
                         "other": pa.array(others, pa.binary())}, schema=schema)

    space = ["label", "dim"]
    bits = classes.groupBy(*space).agg(F.count(F.lit(1)).alias("classes")).select(*space, F.least(
        F.greatest(F.ceil(F.log2(F.col("classes") / BLOCK)), F.lit(0)), "dim", F.lit(DIRECTIONS)).cast("int").alias("bits"))
    celled = classes.join(bits, space).withColumn("cell", F.expr("signs & (shiftleft(1, bits) - 1)"))
    parts = celled.groupBy(*space, "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    own = F.col("cell").cast("long") * (1 << 31) + F.pmod(F.xxhash64("node"), F.col("parts"))
    sent = _visits(celled, kind, threshold).join(parts, [*space, "cell"]).select(
        *space, "node", "n", "vec", own.alias("own"), F.explode("visits").alias("cell"))
    sent = sent.join(parts, [*space, "cell"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    there = F.col("cell").cast("long") * (1 << 31) + F.col("part")
    tiles = sent.select(*space, F.least("own", there).alias("lo"), F.greatest("own", there).alias("hi"),
                        (F.col("own") <= there).alias("is_lo"), "node", "n", "vec")
    return tiles.groupBy(*space, "lo", "hi").applyInArrow(compare, "node binary, n_links long, other binary")


def near_duplicate_vectors(rows: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding",
                           label_col: str = "label") -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors are linked where their labels are equal and their cosine, in double precision, is at least
    ``threshold``.  ``n_links`` counts the other vectors linked directly, ``component_id`` is the least id
    reachable, ``kept`` is true for that vector.  Vectors that are null, empty or zero or hold null, infinite or
    undefined components, rows without a label and rows without an id link with nothing and are kept, and
    so do vectors of different length.  A repeated row is a vector like any other and links with its
    copies.  Other columns are ignored.  An empty table gives no rows.
    """
    work = WorkTables(rows.sparkSession)
    kind = "<f4" if rows.schema[vec_col].dataType.simpleString() == "array<float>" else "<f8"
    vectors = work.keep(_vectors(rows, id_col, vec_col, label_col), "vectors")
    classes = work.keep(vectors.filter("node is not null").groupBy("label", "dim", "node", "signs").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("rep"), F.first("vec").alias("vec")), "vector-classes")
    found = work.keep(_tiles(classes, kind, threshold), "tiles")
    counted = found.filter("other is null").groupBy("node").agg(F.sum("n_links").alias("n_links"))
    joined = connected_components(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    joined = work.keep(joined, "vector-components")
    facts = classes.select("node", "n", "rep").join(counted, "node", "left").join(joined, "node", "left").select(
        "node", "rep", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component"))
    facts = work.keep(facts, "vector-facts")
    first = facts.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = facts.join(first, "component").select("node", "n_links", "component_id")
    out = vectors.select("vec_id", "node").join(named, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return work.result(out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))), "near-vectors")
