"""Operator 3: token ids as ORC, in document order.

``write_token_ids`` encodes texts with a public tokenizer and writes one row per
document (``doc_id, file_range, local_start, n_tokens, ids``) in ascending id order:
the files of the folder hold consecutive id ranges, rows inside a file ascend.  The ids
are an integer list, which ORC run-length encodes; row indexes and a Bloom filter on
``doc_id`` let readers skip stripes and row groups, and stripes are read in parallel.
``read_token_ids`` adds each document's start among all ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm.common import gather
from zoneflow.llm.ranges import cut_points, in_ranges, range_count

ORC_OPTIONS = {
    "compression": "zstd",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(32 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
CACHED_WORDS = 1_500_000  # per Python worker, some 300 MB
SIGNS = b".,;:!?"         # what often ends a word
MARK = "\x01"             # between the new words that one call encodes
_ENCODERS: dict[tuple[str, bool], Encoder] = {}


class Encoder:
    """Token ids of texts.  ``by_word``: texts are cut at ASCII white space and each different word
    is encoded once, which is exact for tokenizers that drop white space, never look across it and
    (or else ``parted`` is to be false) cut SIGNS off the ASCII letters before them."""

    def __init__(self, path: str, by_word: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = by_word
        self.known: dict[bytes, bytes] = {}
        # new words are normalised together, and what they become is encoded together, parted by MARK
        self.bare = Tokenizer.from_file(path)
        if self.tokenizer.normalizer is not None:
            self.bare.normalizer = None
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        signs = SIGNS.decode()
        ends = [f"{c}{t}" for c in "abtxZ" for t in (*signs, signs)]
        self.parted = all(whole.tolist() == c.tolist() + t.tolist() for whole, c, t in
                          (self._plain([e, e[0], e[1:]]) for e in ends))
        mark, first, last, both = (self._plain([t])[0].tolist() for t in (MARK, "a", "b", f"a {MARK} b"))
        self.mark = mark[0] if len(mark) == 1 and both == first + mark + last else None

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with ``end_id`` behind it, and where each text begins (one place more than texts)."""
        if not self.by_word:
            made = [np.append(x, np.uint32(end_id)) for x in self._plain([t.decode("utf-8", "replace") for t in texts])]
            return np.concatenate(made).view(np.int32), np.cumsum([0, *map(len, made)])
        cut = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
        coded = cut.flatten().dictionary_encode()
        ids = [*self._word_ids(coded.dictionary.cast(pa.binary()).to_pylist()), np.array([end_id], "<u4").tobytes()]
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]) // 4, pa.int32()),
                                         pa.array(np.frombuffer(b"".join(ids), "<i4")))
        ends = cut.offsets.to_numpy()[1:] - cut.offsets[0].as_py()
        # the end of a text is one more word
        made = lists.take(pa.array(np.insert(coded.indices.to_numpy(), ends, len(ids) - 1)))
        return made.flatten().to_numpy(), made.offsets.to_numpy()[np.append(0, ends + np.arange(1, len(ends) + 1))]

    def _plain(self, texts: list[str], bare: bool = False) -> list[np.ndarray]:
        tokenizer = self.bare if bare else self.tokenizer
        return [np.array(e.ids, "<u4") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, out of those known so far where possible."""
        found = [*map(self.known.get, words)]
        new = [i for i, x in enumerate(found) if x is None]
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known.clear()
        # a word that ends in SIGNS behind a letter has the ids of both parts
        parts = [(words[i][:n], words[i][n:]) if self.parted and (n := len(words[i].rstrip(SIGNS))) < len(words[i])
                 and words[i][n - 1:n].isalpha() else (words[i],) for i in new]
        asked = [w for w in dict.fromkeys(w for ws in parts for w in ws) if w not in self.known]
        for lo in range(0, len(asked), 4096):
            some = asked[lo:lo + 4096]
            made = self._joined(some) or [x.tobytes() for x in self._plain([w.decode("utf-8", "replace") for w in some])]
            self.known.update(zip(some, made, strict=True))
        for i, ws in zip(new, parts, strict=True):
            found[i] = self.known[words[i]] = b"".join([self.known[w] for w in ws])
        return found

    def _joined(self, words: list[bytes]) -> list[bytes] | None:
        """Ids of words that pass the tokenizer as one text; none where they cannot be told apart in it."""
        gap = f" {MARK} "
        whole = gap.encode().join(words).decode("utf-8", "replace")
        if self.mark is None or whole.count(MARK) != len(words) - 1 or any(t in whole for t in self.added):
            return None
        if self.tokenizer.normalizer is not None:
            whole = self.tokenizer.normalizer.normalize_str(whole)
        forms = [f.strip(" ") for f in whole.split(MARK)]   # white space is dropped, see ``by_word``
        if len(forms) != len(words) or any(t in whole for t in self.added):
            return None
        different = [*dict.fromkeys(forms)]
        ids_of: dict[str, bytes] = {}
        for lo in range(0, len(different), 512):
            some = different[lo:lo + 512]
            ids = self._plain([gap.join(some)], bare=True)[0]
            cuts = (np.flatnonzero(ids == self.mark) * 4).tolist()
            if len(cuts) != len(some) - 1:   # a word of its own has the mark's id
                return None
            raw = ids.tobytes()
            ids_of.update(zip(some, (raw[a:b] for a, b in zip([0, *(c + 4 for c in cuts)], [*cuts, len(raw)], strict=True)),
                              strict=True))
        return [ids_of[f] for f in forms]


def encoder(path: str, by_word: bool) -> Encoder:
    """The tokenizer of this Python process, loaded once."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, by_word) not in _ENCODERS:
        _ENCODERS[path, by_word] = Encoder(path, by_word)
    return _ENCODERS[path, by_word]


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, by_word: bool = False, end_id: int = 1,
                    id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode every whole text (null: empty) plus ``end_id`` and write the ORC folder ``path``.

    Rows without an id come first, rows that share an id are ordered by a hash of their
    text.  Other columns are ignored.  An empty table gives a folder without rows.
    ``tokenizer`` must be readable by the executors.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("file_range", pa.int32()), ("local_start", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, at, start = zstandard.ZstdDecompressor(), None, 0
        for batch in batches:
            ranges, ids, packed = (batch.column(c) for c in ("range", "doc_id", "z"))
            lo = 0
            while lo < batch.num_rows:
                texts, size = [], 0
                hi = lo
                while hi < batch.num_rows and (size < 2_000_000 or hi == lo):
                    texts.append(unpack.decompress(packed[hi].as_py()))
                    size += len(texts[-1])
                    hi += 1
                values, ends = encoder(tokenizer, by_word).encode(texts, end_id)
                counts = np.diff(ends).tolist()
                here, starts = ranges.slice(lo, hi - lo).to_pylist(), []
                for k, n in zip(here, counts, strict=True):
                    at, start = k, start if k == at else 0
                    starts.append(start)
                    start += n
                yield gather({"doc_id": ids.slice(lo, hi - lo), "file_range": pa.array(here, pa.int32()),
                              "local_start": starts, "n_tokens": counts,
                              "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))}, schema)
                lo = hi

    cuts = cut_points(docs, id_col, range_count(docs))
    ordered = in_ranges(docs, cuts, None, id_col, text_col).sortWithinPartitions("range", "place", "text_key")
    rows = ordered.mapInArrow(run, "doc_id long, file_range int, local_start long, n_tokens long, ids array<int>")
    rows.write.mode("overwrite").options(**ORC_OPTIONS).orc(path)
    return path


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of a folder written by ``write_token_ids``."""
    rows = spark.read.schema("doc_id long, file_range int, local_start long, n_tokens long, ids array<int>").orc(path)
    totals = sorted(map(tuple, rows.groupBy("file_range").agg(F.sum("n_tokens")).collect()))  # one row per file
    bases, base = [], 0
    for number, n in totals:
        bases.append((number, base))
        base += n
    small = spark.createDataFrame(bases, "file_range int, base long")
    return rows.join(F.broadcast(small), "file_range").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def with_crc32(rows: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)``: the checksum of ids as little-endian unsigned 32-bit numbers."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy().astype("<u4")
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield gather({"doc_id": batch.column(0), "start": batch.column(1), "n_tokens": batch.column(2),
                          "ids_crc32": crc}, schema)

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")
