"""Operator 4: document fingerprints by winnowing.

Every ``GRAM`` code points have a rolling hash; of each window of ``WINDOW`` hashes the
least is chosen, of equal ones the rightmost; hashes chosen by several windows count
once, with their position.  Two texts that share ``GRAM + WINDOW - 1`` code points share
a chosen hash, and no match below ``GRAM`` code points is found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import byte_values, gather, mix64
from zoneflow.llm.ranges import cut_points, first_of_ranges, in_ranges, range_count

GRAM, WINDOW = 8, 32
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)


def winnow(points: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen ``(hashes, positions)`` of code points, in text order.

    A text shorter than ``gram`` is one gram; one with fewer grams than ``window`` is one
    window; an empty one has none.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    gram = min(gram, n)
    values = points.astype(np.uint64)
    rolling = np.zeros(n - gram + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(gram):
            rolling = rolling * _FACTOR + values[k:n - gram + 1 + k]
    # one number to compare: the hash, then the later position first
    least = (mix64(rolling) & ~_LOW) | (_LOW - np.arange(len(rolling), dtype=np.uint64))
    width, window = 1, min(window, len(least))
    while width < window:
        step = min(width, window - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    keep = np.ones(len(least), bool)
    keep[1:] = least[1:] != least[:-1]
    chosen = least[keep]
    return (chosen >> np.uint64(32)).astype(np.uint32), (_LOW - (chosen & _LOW)).astype(np.int64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def fingerprint_text(hashes: np.ndarray, positions: np.ndarray) -> str:
    """Ten hexadecimal digits for each chosen gram: its hash, then its distance from the one before."""
    if not len(hashes):
        return ""
    out = np.empty((len(hashes), 5), np.uint8)
    out[:, :4] = hashes.astype(">u4").view(np.uint8).reshape(-1, 4)
    out[:, 4] = np.diff(positions, prepend=0)
    return out.tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of chosen hashes (given distinct); both empty: 1."""
    if not len(a) and not len(b):
        return 1.0
    both = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id_col, hashes, positions)`` of every row; null and empty texts have empty lists."""
    schema = pa.schema([("doc_id", pa.int64()), ("hashes", pa.list_(pa.int64())), ("positions", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [winnow(code_points((v or b"").decode("utf-8", "replace")), gram, window)
                    for v in byte_values(batch.column(1))]
            yield gather({"doc_id": batch.column(0), "hashes": [h.astype(np.int64) for h, _ in made],
                          "positions": [p for _, p in made]}, schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, hashes array<long>, positions array<long>").withColumnRenamed("doc_id", id_col)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text's last ``n_chars // 2`` code points are replaced by the first as many
    of the next document in descending id order (fewer if it is shorter; after the last
    document the first one).  A null text is empty.  Rows without an id come last, rows
    that share an id are ordered by a hash of their text.  One exchange moves the texts,
    compressed, into id ranges; a task then reads its range as a stream and holds two
    documents at a time.  Other columns are ignored; an empty table gives no rows.
    """
    ranges = range_count(docs)
    cuts = cut_points(docs, id_col, ranges)
    firsts = first_of_ranges(docs, id_col, cuts)
    # the first document of a range (its greatest id) follows the last one of the range above
    extras = {place: firsts[(i + 1) % len(firsts)][0] for i, (_, place) in enumerate(firsts)}
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def row(doc_id, text: str, hashes: np.ndarray, positions: np.ndarray, after: str, after_hashes: np.ndarray) -> tuple:
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        new, places = winnow(code_points(edited))
        own = np.unique(hashes)
        return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                fingerprint_text(hashes, positions), fingerprint_text(new, places), likeness(own, np.unique(new)),
                likeness(own, np.unique(after_hashes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        at, last, out, size = None, None, [], 0
        for batch in batches:
            columns = {n: batch.column(n) for n in ("range", "extra", "doc_id", "z")}
            for i in range(batch.num_rows):
                here, extra = columns["range"][i].as_py(), columns["extra"][i].as_py()
                if here != at:
                    at, last = here, None
                elif last is None:  # only the first extra row of a range counts
                    continue
                if extra and last is None:
                    continue
                text = unpack.decompress(columns["z"][i].as_py()).decode("utf-8", "replace")
                hashes, positions = winnow(code_points(text))
                if last is not None:
                    out.append(row(*last, text, hashes))
                    size += 2 * len(last[1])
                last = None if extra else (columns["doc_id"][i].as_py(), text, hashes, positions)
                if size > 4_000_000:
                    yield gather(dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True)), schema)
                    out, size = [], 0
        if out:
            yield gather(dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True)), schema)

    ordered = in_ranges(docs, cuts, extras, id_col, text_col).sortWithinPartitions(
        "range", "extra", F.col("place").desc(), "text_key")
    return ordered.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double") \
        .withColumnRenamed("doc_id", id_col)
