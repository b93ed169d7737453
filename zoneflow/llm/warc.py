"""Operator 2: Merkle fixity audit of WARC replicas.

``write_warc`` writes pages as gzipped WARC files: a folder for every ``SEGMENT_IDS`` consecutive ids, in it
files of at most about ``PART_BYTES``, records in id order.  ``read_records`` finds the records of a replica with their
offsets and SHA-256.  ``merkle_levels`` hashes runs of ``FANOUT`` neighbouring ids, which are ordered offset ranges,
level by level up to one root.  ``audit`` compares two roots and descends only into ranges whose
hashes differ.  As ranges are cut by id, a record that one replica lost leaves all others in their place.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import WorkTables, byte_values, gather, shuffle_width

SEGMENT_IDS = 2000
PART_BYTES = 256 << 20          # of uncompressed records in a file
FANOUT = 16
DATE = "2020-01-01T00:00:00Z"   # of every record: replicas must not differ by their writing time
GAP = b"\r\n\r\n"               # ends a header block and a record


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(segment, page_id, record)``: WARC resource records as text, without their final empty lines.

    Line breaks in urls become blanks; a null url is empty, a null page has length 0.
    Rows without an id are dealt over segments of their own, -1 to -``SEGMENT_IDS``, by a hash.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    page = F.col(id_col).cast("long")
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page.cast("string"), F.lit("none")), F.lit(">\r\nWARC-Date: " + DATE + "\r\nWARC-Target-URI: "),
        F.translate(F.coalesce(F.col(url_col).cast("string"), F.lit("")), "\r\n", "  "),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"), html)
    alone = -1 - F.pmod(F.xxhash64(html, F.col(url_col)), F.lit(SEGMENT_IDS))
    negative = F.floor(page / SEGMENT_IDS) - SEGMENT_IDS   # below those of rows without an id
    segment = F.when(page.isNull(), alone).when(page < 0, negative).otherwise(F.floor(page / SEGMENT_IDS))
    return pages.select(segment.cast("long").alias("segment"), page.alias("page_id"), record.alias("record"))


def write_warc(pages: DataFrame, path: str, **columns: str) -> str:
    """Write ``path/segment=N/part=M/*.txt.gz`` files; records are in id order (equal ids: by a hash of their text).

    Records are compressed before they are dealt to segments.  A segment's records go to one task, which passes
    them one by one; its files hold about ``PART_BYTES``, or one longer record.
    """
    rows = records(pages, **columns)
    packed = pa.schema([("segment", pa.int64()), ("page_id", pa.int64()), ("tie", pa.int64()), ("size", pa.int64()), ("z", pa.binary())])
    plain = pa.schema([("segment", pa.int64()), ("part", pa.int64()), ("page_id", pa.int64()), ("tie", pa.int64()), ("record", pa.string())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = byte_values(batch.column(3))
            yield gather({"segment": batch.column(0), "page_id": batch.column(1), "tie": batch.column(2),
                          "size": [len(t) for t in texts], "z": [press.compress(t) for t in texts]}, packed)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                yield gather({"segment": some.column(0), "part": some.column(1), "page_id": some.column(2), "tie": some.column(3),
                              "record": pa.array([press.decompress(z) for z in some.column(4).to_pylist()], pa.binary()).cast(pa.string())}, plain)

    dealt = rows.withColumn("tie", F.xxhash64("record")).select("segment", "page_id", "tie", "record").mapInArrow(
        pack, "segment long, page_id long, tie long, size long, z binary").repartition(shuffle_width(pages.sparkSession), "segment")
    before = Window.partitionBy("segment").orderBy("page_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    part = F.floor(F.coalesce(F.sum("size").over(before), F.lit(0)) / PART_BYTES).cast("long")
    texts = dealt.withColumn("part", part).select("segment", "part", "page_id", "tie", "z").mapInArrow(
        unpack, "segment long, part long, page_id long, tie long, record string")
    # a record's text followed by this separator is exactly a WARC record
    texts.sortWithinPartitions("segment", "part", "page_id", "tie").select("segment", "part", "record").write.mode("overwrite").option(
        "lineSep", GAP.decode()).option("compression", "gzip").partitionBy("segment", "part").text(path)
    return path


_LENGTH = re.compile(rb"\r\nContent-Length: *([0-9]+)\r\n", re.I)
_PAGE = re.compile(rb"\r\nWARC-Record-ID: *<urn:page:(-?[0-9]+)>\r\n")


def parse(data: bytes) -> Iterator[tuple[int, int, int | None, str]]:
    """(offset, length, page id, SHA-256) of the records of a WARC file.

    A record whose length is missing or wrong ends where the next record begins.
    """
    at = 0
    while at < len(data):
        head = data.find(GAP, at)
        length = _LENGTH.search(data, at, head + 2) if head >= 0 else None
        end = head + 4 + int(length[1]) if length else -1
        if end < 0 or data[end:end + 4] != GAP:
            following = data.find(GAP + b"WARC/1.1\r\n", at)
            end = following if following >= 0 else len(data) - 4 * data.endswith(GAP)
        page = _PAGE.search(data, at, max(head, at) + 2)
        yield at, end - at, int(page[1]) if page else None, hashlib.sha256(data[at:end]).hexdigest()
        at = end + 4


def read_records(spark: SparkSession, path: str, work: WorkTables | None = None) -> DataFrame:
    """``(segment, position, offset, length, page_id, digest)`` of every record below ``path``.

    Positions and offsets count from the beginning of a segment, its files follow each other in the order of their
    parts and names; offsets are those in the uncompressed text.  A file is read by one task.
    """
    work = work or WorkTables(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.filter(F.col("length") > 0).select(
        F.regexp_extract("path", "segment=(-?[0-9]+)/", 1).cast("long").alias("segment"),
        F.regexp_extract("path", "part=([0-9]+)/", 1).cast("long").alias("part"),
        F.regexp_extract("path", "([^/]*)$", 1).alias("file"), "content")
    schema = pa.schema([("segment", pa.int64()), ("part", pa.int64()), ("file", pa.string()), ("number", pa.int64()), ("offset", pa.int64()),
                        ("length", pa.int64()), ("page_id", pa.int64()), ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, part, file, content in zip(*(batch.column(k) for k in range(4)), strict=True):
                data = content.as_py()
                if data[:2] == b"\x1f\x8b":
                    data = inflated(data)
                found = list(parse(data))
                yield gather({"segment": [segment.as_py()] * len(found), "part": [part.as_py()] * len(found),
                              "file": [file.as_py()] * len(found), "number": list(range(len(found))), "offset": [r[0] for r in found],
                              "length": [r[1] for r in found], "page_id": [r[2] for r in found],
                              "digest": [r[3] for r in found]}, schema)

    rows = work.keep(files.mapInArrow(run, "segment long, part long, file string, number long, offset long, length long, page_id long, "
                                           "digest string"), "warc-records")
    # of each file, what the files of its segment before it hold
    sizes = rows.groupBy("segment", "part", "file").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("offset") + F.col("length") + len(GAP)).alias("bytes"))
    before = Window.partitionBy("segment").orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("segment", "part", "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"),
                        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes"))
    return rows.join(base, ["segment", "part", "file"]).select(
        "segment", (F.col("n") + F.col("number")).alias("position"), (F.col("bytes") + F.col("offset")).alias("offset"),
        "length", "page_id", "digest")


def inflated(data: bytes) -> bytes:
    """The text of a gzip file of any number of members, as far as it can be read."""
    out = []
    while data:
        member = zlib.decompressobj(wbits=31)
        try:
            for at in range(0, len(data), 1 << 16):
                out.append(member.decompress(data[at:at + (1 << 16)]))
                if member.eof:
                    break
        except zlib.error:
            break
        data = member.unused_data + data[at + (1 << 16):] if member.eof else b""
    return b"".join(out)


def _leaves(rows: DataFrame) -> DataFrame:
    """``(kind, node, digest)``: one leaf per id (kind 0); records without an id are leaves of their content (kind 1).

    Several records of one id make one leaf: the sums of their digests, which tasks add up before the exchange.
    """
    quarters = [F.conv(F.substring("digest", 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)") for k in range(4)]
    sums = F.concat_ws(":", F.count(F.lit(1)).cast("string"), *[F.sum(q).cast("string") for q in quarters])
    # most ids have one record: only its digest travels, and the sums of the others are taken from their records
    grouped = keyed(rows).groupBy("kind", "node").agg(F.count(F.lit(1)).alias("n"), F.min(F.unhex("digest")).alias("digest"))
    several = grouped.filter("n > 1").select("kind", "node")
    added = keyed(rows).join(several, ["kind", "node"], "left_semi").groupBy("kind", "node").agg(F.unhex(F.sha2(sums, 256)).alias("digest"))
    return grouped.filter("n = 1").select("kind", "node", "digest").unionByName(added)


def keyed(rows: DataFrame) -> DataFrame:
    """Records with the leaf they belong to: ``kind`` and ``node``."""
    content = F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")
    return rows.withColumns({"kind": F.when(F.col("page_id").isNull(), 1).otherwise(0), "node": F.coalesce("page_id", content)})


def merkle_levels(leaves: DataFrame, height: int, work: WorkTables) -> list[DataFrame]:
    """``(kind, node, digest)`` of each level, leaves first; level ``k`` has a node for every ``FANOUT ** k`` ids, in order.

    A parent hashes its children in order, at most ``FANOUT`` of them; ids of either sign have a top node of their own.
    """
    levels = [work.keep(leaves, "merkle")]
    for _ in range(height):
        group = levels[-1].groupBy("kind", F.floor(F.col("node") / FANOUT).cast("long").alias("parent")).agg(
            F.array_sort(F.collect_list(F.struct("node", "digest"))).alias("children"))
        text = F.array_join(F.transform("children", lambda c: F.concat_ws(":", c["node"].cast("string"), F.hex(c["digest"]))), ",")
        levels.append(work.keep(group.select("kind", F.col("parent").alias("node"), F.unhex(F.sha2(text, 256)).alias("digest")), "merkle"))
    return levels


def audit(first: DataFrame, second: DataFrame, work: WorkTables | None = None) -> DataFrame:
    """Records in which two replicas (tables of ``read_records``) differ.

    Columns: ``page_id, segment, position, offset, length, digest_first, digest_second, status``
    (``changed``, ``missing`` in the second replica, ``extra`` there).  Records are the same by their id; those without
    one, and several of one id, by their content first, and what is left of one id in the order of its records.  Equal
    roots end the audit after one comparison, else each level joins only the children of ranges that
    differ.  Empty replicas are equal.  ``work`` holds the replicas' tables, which go when the result is written.
    """
    work = work or WorkTables(first.sparkSession)
    first, second = keyed(first), keyed(second)
    top = first.select("node").unionByName(second.select("node")).agg(F.max(F.greatest(F.col("node"), -(F.col("node") + 1)))).first()[0]
    height = 0
    while top is not None and FANOUT ** height <= top:
        height += 1
    one, two = (merkle_levels(_leaves(r.drop("kind", "node")), height, work) for r in (first, second))
    suspects = None
    for level in range(height, -1, -1):
        left, right = one[level], two[level]
        if suspects is not None:
            parents = suspects.select(F.col("kind").alias("_k"), F.col("node").alias("_n"))
            below = (F.col("kind") == F.col("_k")) & (F.floor(F.col("node") / FANOUT) == F.col("_n"))
            left, right = (x.join(parents, below, "left_semi") for x in (left, right))
        suspects = work.keep(_differing(left, right), "suspects")
        if suspects.isEmpty():
            break
    found = suspects.select("kind", "node")
    # of the suspects' records, those that both hold drop out; the others pair up in order
    nth = F.row_number().over(Window.partitionBy("kind", "node", "digest").orderBy("segment", "position"))
    a, b = (r.join(found, ["kind", "node"], "left_semi").withColumn("_nth", nth) for r in (first, second))
    same = ["kind", "node", "digest", "_nth"]
    rank = F.row_number().over(Window.partitionBy("kind", "node").orderBy("segment", "position"))
    a, b = (x.join(y.select(*same), same, "left_anti").withColumn("_rank", rank) for x, y in ((a, b), (b, a)))

    def side(rows: DataFrame, name: str, mark: str) -> DataFrame:
        return rows.select("kind", "node", "_rank", F.col("digest").alias(name),
                           F.struct("page_id", "segment", "position", "offset", "length").alias(mark))

    both = side(a, "digest_first", "_a").join(side(b, "digest_second", "_b"), ["kind", "node", "_rank"], "full")
    status = F.when(F.col("digest_second").isNull(), "missing").when(F.col("digest_first").isNull(), "extra").otherwise("changed")
    at = F.coalesce("_a", "_b")
    out = both.select(*[at[c].alias(c) for c in ("page_id", "segment", "position", "offset", "length")],
                      "digest_first", "digest_second", status.alias("status"))
    return work.result(out, "audit")


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    x = left.select("kind", "node", F.col("digest").alias("_a"))
    y = right.select("kind", "node", F.col("digest").alias("_b"))
    return x.join(y, ["kind", "node"], "full").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("kind", "node")
