"""Operator 10: line dedup by a log-template tree.

The tree has a fixed depth: the root splits lines by their number of words, the
levels below by their first ``LEADING`` words (a word that holds a digit is a
variable field there).  Inside a leaf a word is *constant* at its position when
enough documents have it there, in turn for every number of documents that one of the
line's words reaches; every other position is a variable field.  A line whose
constant share reaches ``MIN_CONSTANT`` becomes the template of its constants and
``<*>``; another line stays its own template (below that share of words without
digits: by its unmasked words, so rows of numbers recur only where they are equal).  Templates found in enough documents are
recurring and their lines are dropped.  Enough is ``MIN_DOCS``, but ``LONG_DOCS`` for
lines of ``LONG_WORDS`` words and more, which no two texts share by chance.  Documents
of equal text count once.  Runs of consecutive lines that hold ``LONG_WORDS`` words
together are dropped where ``LONG_DOCS`` holders have them.  Lines of fewer than ``MIN_WORDS`` words go
only within such a run.

Constants are decided by counts, not by the order lines arrive in, so the tree is
grown by aggregates: leaves that too few lines reach are cut before any word is
looked at, equal lines count once with a weight, and no leaf is gathered anywhere.

Holders of a line are classes of near copies (operator 5 over ``COPY_SHINGLE`` words at
``COPY_PERCENT``), so lines that only the copies of one text share do not recur and are
left for document dedup; every text loses the lines that recur between classes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import WorkTables, byte_values, gather, may_hold
from zoneflow.llm.setsketch import near_duplicates

LEADING = 3          # words that pick a leaf, after the word count
MIN_WORDS = 2        # shorter lines are never dropped
MIN_CONSTANT = 0.6   # share of constant positions in a template
MIN_DOCS = 8         # documents that make a template recurring
LONG_WORDS, LONG_DOCS = 25, 2
COPY_SHINGLE, COPY_PERCENT = 5, 80   # near copies, as the pipeline's document dedup has them
VARIABLE = b"<*>"
VARIABLE_HASH = int(np.uint64(xxhash.xxh3_64_intdigest(VARIABLE)).view(np.int64))

_DIGIT = re.compile(rb"[0-9]")


def masked(line: bytes) -> list[bytes]:
    """Words of a line; those that hold a digit are variable fields."""
    words = line.split()
    return [VARIABLE if _DIGIT.search(w) else w for w in words] if _DIGIT.search(line) else words


def _signed(data: bytes) -> int:
    """Signed 64-bit hash."""
    digest = xxhash.xxh3_64_intdigest(data)
    return digest - (1 << 64) if digest >> 63 else digest


def _number(words: list[bytes]) -> int:
    """Signed 64-bit hash of a word sequence."""
    return _signed(b" ".join(words))


def _own(line: bytes, words: list[bytes], number: int) -> int:
    """What a line is counted by when no template fits: its words, unmasked where too few are constant."""
    constant = len(words) - words.count(VARIABLE)
    return number if constant / len(words) >= MIN_CONSTANT else _number(line.split())


def _leaf(words: list[bytes]) -> int:
    return _number([b"%d" % len(words), *words[:LEADING]])


def runs(own: list[int], sizes: list[int]) -> Iterator[tuple[int, int, int]]:
    """``(number, start, end)`` of the shortest runs of two lines and more, from each line on and up to
    each line, that hold ``LONG_WORDS`` words.  A longer run that two texts share is made of these."""
    ends = np.cumsum([0, *sizes]).tolist()
    spans, n = set(), len(own)
    to = 0
    for i in range(n):
        while to < n and ends[to] - ends[i] < LONG_WORDS:
            to += 1
        if ends[to] - ends[i] >= LONG_WORDS:
            spans.add((i, to))
    since = 0
    for j in range(1, n + 1):
        while since + 1 < j and ends[j] - ends[since + 1] >= LONG_WORDS:
            since += 1
        if ends[j] - ends[since] >= LONG_WORDS:
            spans.add((since, j))
    numbers = np.array(own, np.int64).tobytes()
    for i, j in sorted(spans):
        if j - i > 1:
            yield _signed(numbers[8 * i:8 * j]), i, j


def line_table(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(key, line, leaf, size, words, first)``: the distinct lines of each different text (``_own``), their
    word count, the words they make up there (null leaf: too short to be dropped) and whether no
    line before has the same masked words (1 or 0).  The text's ``runs`` are lines of size 0."""
    schema = pa.schema([("key", pa.int64()), ("line", pa.int64()), ("leaf", pa.int64()), ("size", pa.int32()),
                        ("words", pa.int64()), ("first", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [], []
            for key, text in zip(batch.column(0).to_pylist(), byte_values(batch.column(1)), strict=True):
                seen: dict[int, list] = {}
                leading: set[int] = set()
                order, sizes = [], []
                for line in (text or b"").split(b"\n"):
                    words = masked(line)
                    if words:
                        number = _number(words)
                        own = _own(line, words, number)
                        if own not in seen:
                            seen[own] = [own, _leaf(words) if len(words) >= MIN_WORDS else None, len(words), 0,
                                         int(number not in leading)]
                            leading.add(number)
                        seen[own][3] += len(words)
                        order.append(own)
                        sizes.append(len(words))
                for number, _, _ in runs(order, sizes):
                    seen.setdefault(("run", number), [number, None, 0, 0, 0])
                keys += [key] * len(seen)
                found += seen.values()
                if len(keys) > 200_000:
                    yield _line_rows(keys, found, schema)
                    keys, found = [], []
            yield _line_rows(keys, found, schema)

    lines = docs.select(F.xxhash64(text_col).alias("key"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "key long, line long, leaf long, size int, words long, first int")
    return lines.groupBy("key", "line", "size").agg(*[F.first(c).alias(c) for c in ("leaf", "words", "first")])


def _line_rows(keys: list, found: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = ([x[k] for x in found] for k in range(5))
    return gather(dict(zip(schema.names, (keys, *columns), strict=True)), schema)


def enough(size: str) -> Column:
    """Documents that make a template of so many words recurring."""
    return F.when(F.col(size) >= LONG_WORDS, LONG_DOCS).otherwise(MIN_DOCS)


def _packed(texts: DataFrame) -> DataFrame:
    """``(key, z)`` of rows ``(key, text)``: compressed texts, for joins that move few of them."""
    schema = pa.schema([("key", pa.int64()), ("z", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield gather({"key": batch.column(0),
                          "z": [pack.compress(v or b"") for v in byte_values(batch.column(1))]}, schema)

    return texts.select("key", "text").mapInArrow(run, "key long, z binary")


def _line_words(docs: DataFrame, lines: DataFrame, text_col: str) -> DataFrame:
    """``(line, leaf, size, n, held, words)`` of every line in ``lines`` (the same with holder); words as 64-bit hashes.

    Only the texts of holders are moved, compressed.
    """
    wanted = lines.groupBy("holder").agg(F.collect_set("line").alias("lines")).withColumnRenamed("holder", "key")
    texts = docs.select(F.xxhash64(text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    some = may_hold(texts, "key", wanted.select("key"), "_wanted").filter("_wanted")
    packed = _packed(some).join(wanted, "key").dropDuplicates(["key"])
    schema = pa.schema([("line", pa.int64()), ("words", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, known = zstandard.ZstdDecompressor(), {VARIABLE: VARIABLE_HASH}

        def number_of(word: bytes) -> int:
            if word not in known:
                if len(known) >= 200_000:
                    known.clear()
                    known[VARIABLE] = VARIABLE_HASH
                known[word] = _number([word])
            return known[word]

        for batch in batches:
            for z, asked in zip(batch.column(0), batch.column(1), strict=True):
                left, found = set(asked.as_py()), {}
                for line in unpack.decompress(z.as_py()).split(b"\n"):
                    words = masked(line)
                    number = _own(line, words, _number(words)) if words else None
                    if number in left:
                        left.discard(number)
                        found[number] = [number_of(w) for w in words]
                yield gather({"line": list(found), "words": list(found.values())}, schema)

    words = packed.select("z", "lines").mapInArrow(run, "line long, words array<long>")
    return words.join(lines.select("line", "leaf", "size", "n", "held"), "line").select("line", "leaf", "size", "n", "held", "words")


def copy_classes(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(key, class)``: the class of near copies each different text belongs to.

    Texts stand for themselves by their key, so rows without an id have classes too.
    """
    texts = docs.select(F.xxhash64(text_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return near_duplicates(texts, COPY_SHINGLE, COPY_PERCENT).select(
        F.col("doc_id").alias("key"), F.col("component_id").alias("class")).distinct()


def _templates(lines: DataFrame) -> DataFrame:
    """``(line, template)``: the templates a line may recur by, itself among them.

    A word's documents are counted within its leaf and position.  A line has one template for
    each number of documents that one of its words reaches: the words that reach it are
    constant, all others variable fields.  So a field's frequent values, which gather
    documents as the corpus grows, stay fields beside the words that more documents hold.
    """
    words = lines.select("line", "leaf", "size", "n", "held", F.posexplode("words").alias("position", "word"))
    constant = (words.groupBy("leaf", "size", "position", "word").agg(F.sum("n").alias("docs"))
                .filter((F.col("docs") >= enough("size")) & (F.col("word") != VARIABLE_HASH))
                .select("leaf", "position", "word", "docs"))
    least = Window.partitionBy("line").orderBy(F.desc("docs")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # the template's number: its constants, each hashed with its position, in any order
    levels = words.join(constant, ["leaf", "position", "word"]).select(
        "line", "leaf", "size", "held", "docs", F.count(F.lit(1)).over(least).alias("constants"),
        F.bit_xor(F.xxhash64("position", "word")).over(least).alias("shape"))
    levels = levels.filter(F.col("constants") / F.col("size") >= MIN_CONSTANT).select(
        "line", "size", "held", F.xxhash64("leaf", "shape").alias("template")).distinct()
    every = levels.unionByName(lines.select("line", "size", "held", F.col("line").alias("template")))
    # no template is held by more documents than its lines together
    likely = every.groupBy("template", "size").agg(F.sum("held").alias("held")).filter(F.col("held") >= enough("size"))
    return every.join(likely.select("template"), "template").select("line", "template")


def _shared_runs(found: DataFrame, classes: DataFrame, work: WorkTables) -> DataFrame:
    """``(key, passages)``: the runs of each text that ``LONG_DOCS`` classes hold."""
    def shared(frame: DataFrame, holder: str) -> DataFrame:
        both = frame.groupBy("line").agg(F.min(holder).alias("lo"), F.max(holder).alias("hi")).filter("lo != hi")
        return frame.join(both.select("line"), "line")

    texts = shared(found.select("key", "line"), "key").join(classes, "key")
    return shared(work.keep(texts, "runs"), "class").groupBy("key").agg(F.collect_set("line").alias("passages"))


def recurring_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(key, lines, passages)``: the lines and runs (their numbers) to drop from each text that loses some.

    ``key`` is the 64-bit hash of the text.  The result is a table of its own; the work tables are gone.
    """
    work = WorkTables(docs.sparkSession)
    classes = work.keep(copy_classes(docs, text_col), "copy-classes")
    every = work.keep(line_table(docs, text_col), "lines")
    leaves = (every.filter("leaf is not null").groupBy("leaf", "size").agg(F.sum("first").alias("n"))
              .filter(F.col("n") >= enough("size")))
    held = every.join(leaves.select("leaf"), "leaf").select("key", "line", "leaf", "size", "first")
    held = work.keep(held.join(classes, "key"), "leaf-lines")
    lines = (held.groupBy("line", "leaf", "size", "class").agg(F.min("key").alias("holder"), F.max("first").alias("first"))
             .groupBy("line", "leaf", "size").agg(F.sum("first").alias("n"), F.count(F.lit(1)).alias("held"),
                                                 F.min("holder").alias("holder")))
    lines = work.keep(lines, "distinct-lines")
    templates = _templates(work.keep(_line_words(docs, lines, text_col), "line-words"))
    found = work.keep(held.select("key", "class", "line", "size").join(templates, "line"), "template-lines")
    recurring = (found.groupBy("template", "size", "class").agg(F.lit(1).alias("one")).groupBy("template", "size")
                 .agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") >= enough("size")))
    dropped = found.join(recurring.select("template"), "template").groupBy("key").agg(F.collect_set("line").alias("lines"))
    return work.result(dropped.join(_shared_runs(every.filter("size = 0"), classes, work), "key", "full"), "line-drops")


def drop_recurring_lines(docs: DataFrame, text_col: str = "text", report: bool = False) -> DataFrame:
    """``docs`` with the lines of recurring templates taken out of ``text_col``.

    Every row stays and keeps its other columns (``n_chars``, where there is one, is
    the new text's length).  Null and empty texts stay as they are.  With ``report``
    the columns ``lines_before`` and ``lines_dropped`` are added.  Rows of equal text
    count once and lose the same lines; an empty table stays empty.

    Rows that lose nothing stay where they are, but for a few that share a bit with one that does (``may_hold``);
    the others move with their texts compressed.
    """
    drops = recurring_lines(docs, text_col).select(F.col("key").alias("_drop_key"), F.col("lines").alias("_drop"),
                                                   F.col("passages").alias("_runs"))
    mark = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col], F.lit(0).alias("_any")).alias("_row")
    keyed = docs.select(mark, F.col(f"`{text_col}`").cast("string").alias("_text"), F.xxhash64(text_col).alias("_drop_key"))
    flagged = may_hold(keyed, "_drop_key", drops, "_loses")

    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        press = zstandard.ZstdCompressor(level=1)
        return pa.array([None if t is None else press.compress(t) for t in byte_values(texts)], pa.binary())

    made_of = pa.struct([("clean", pa.string()), ("dropped", pa.int64()), ("before", pa.int64())])

    @F.arrow_udf("clean string, dropped long, before long")
    def clean(texts: pa.Array, drop: pa.Array, passages: pa.Array) -> pa.Array:
        press, out = zstandard.ZstdDecompressor(), []
        for z, numbers, shared in zip(texts.to_pylist(), drop, passages, strict=True):
            if z is None:
                out.append((None, 0, 0))
                continue
            lines = press.decompress(z).split(b"\n")
            gone, shared = set(numbers.as_py() or ()), set(shared.as_py() or ())
            at, own, sizes = [], [], []
            for k, line in enumerate(lines if gone or shared else ()):
                if words := masked(line):
                    at.append(k)
                    own.append(_own(line, words, _number(words)))
                    sizes.append(len(words))
            lost = {k for k, number in zip(at, own, strict=True) if number in gone}
            for number, i, j in runs(own, sizes) if shared else ():
                if number in shared:
                    lost.update(at[i:j])
            kept = [x for k, x in enumerate(lines) if k not in lost]
            out.append((b"\n".join(kept), len(lines) - len(kept), len(lines)))
        text, dropped, before = ([row[k] for row in out] for k in range(3))
        return pa.StructArray.from_arrays([pa.array(text, pa.binary()).cast(pa.string()), pa.array(dropped, pa.int64()),
                                           pa.array(before, pa.int64())], fields=list(made_of))

    moved = flagged.filter("_loses").select("_row", "_drop_key", pack("_text").alias("_z")).join(drops, "_drop_key", "left")
    moved = moved.select("_row", clean("_z", "_drop", "_runs").alias("_made")).select(
        "_row", F.col("_made.clean").alias("_text"), F.col("_made.dropped").alias("_dropped"), F.col("_made.before").alias("_before"))
    breaks = F.length("_text") - F.length(F.replace(F.col("_text"), F.lit("\n"), F.lit("")))
    stays = flagged.filter(~F.col("_loses")).select("_row", "_text", F.lit(0).cast("long").alias("_dropped"),
                                                    F.coalesce(breaks + 1, F.lit(0)).cast("long").alias("_before"))
    made = stays.unionByName(moved)
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col("_text").alias(c))
        elif c == "n_chars":
            columns.append(F.length("_text").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"_row.`{c}`").alias(c))
    if report:
        columns += [F.col("_before").alias("lines_before"), F.col("_dropped").alias("lines_dropped")]
    return made.select(*columns)
