"""Operator 13: spelling variants by asymmetric q-chunks.

Two words are *near* when one inserted, deleted or replaced code point turns one into
the other.  The longer word of a pair (of equal ones the greater) contributes two
disjoint chunks of ``length div 2`` code points, its first and its last ones; the
other contributes its positional grams of that size.  One edit leaves one chunk whole and
moves it by one place at most, so a near pair meets at a gram at most one place from a
chunk.  Grams farther from both chunks could not join and are not made.

A gram that very many words share is not expanded into all their pairs: words of such a
bucket are also dealt by the rest of the word with one code point left out, which two near
words with that gram have in common.  Then a bucket holds no more words than there are code
points for one place, and no near pair is lost.  Every pair is verified in the JVM.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import WorkTables, byte_values, gather

SHORTEST = 7           # code points of a word
LEAST = 2              # occurrences of a word
LEAD = 10              # times a word's occurrences that its form must have
DAMAGED = 31           # runs whose hash it divides lose a code point (``damage``)
CROWDED = 100_000      # pairs of one bucket from which on it is dealt further
FLUSH = 400_000        # distinct words that a task holds at most before it hands them on


def word_counts(docs: DataFrame, shortest: int = SHORTEST, damage: bool = False, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``(word, n)``: maximal runs of ``A-Z a-z U+00C0-U+00FF`` of at least ``shortest`` code points, A-Z lower-cased.

    ``damage`` deletes one code point of every run whose crc32 with its document's id
    ``DAMAGED`` divides (a null id counts as empty).  Null and empty texts have no words, rows
    repeated in full count again, other columns are ignored.  Tasks count before the exchange.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    runs = re.compile(f"[a-zÀ-ÿ]{{{shortest},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_values(batch.column(1)), strict=True):
                found = runs.findall(text.lower().decode("utf-8", "replace")) if text else ()
                if damage:
                    seed = zlib.crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id))
                    for word, n in Counter(found).items():
                        h = zlib.crc32(word.encode(), seed)
                        if h % DAMAGED == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                        if len(word) >= shortest:
                            total[word] += n
                else:
                    total.update(found)
                if len(total) >= FLUSH:
                    yield gather({"word": list(total), "n": list(total.values())}, schema)
                    total.clear()
        yield gather({"word": list(total), "n": list(total.values())}, schema)

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _without(text: Column) -> Column:
    """``text`` with each of its code points left out in turn, as ``place:rest``."""
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.concat(
        i.cast("string"), F.lit(":"), F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))


def _chunks(words: DataFrame) -> DataFrame:
    """``(size, side, gram, place, rest, y)``: first and last chunk of each word (``size``: its code points)."""
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    cut = words.select("word", size.alias("size"), half.alias("q"),
                       F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    place = F.when(F.col("side") == 0, 0).otherwise(F.col("size") - F.col("q"))
    return _cut(cut.withColumn("place", place)).withColumnRenamed("word", "y")


def _grams(words: DataFrame) -> DataFrame:
    """The same columns (``x``) of the grams that words have for chunks of words as long as they are or one longer."""
    own = F.length("word")
    sizes = words.select("word", F.explode(F.array(own, own + 1)).alias("size"))
    sizes = sizes.withColumn("q", F.floor(F.col("size") / 2).cast("int"))
    last = F.col("size") - F.col("q")
    near = F.array(*[F.struct(F.lit(side).alias("side"), place.alias("place")) for side, place in (
        (0, F.lit(0)), (0, F.lit(1)), (1, last - 1), (1, last), (1, last + 1))])
    spots = sizes.withColumn("at", F.explode(near)).select("word", "size", "q", "at.side", "at.place")
    return _cut(spots.filter(F.col("place") + F.col("q") <= F.length("word"))).withColumnRenamed("word", "x")


def _cut(spots: DataFrame) -> DataFrame:
    word, place, q = F.col("word"), F.col("place"), F.col("q")
    rest = F.concat(F.substring(word, F.lit(1), place), F.lit("|"), F.substring(word, place + q + 1, F.length(word)))
    return spots.select("word", "size", "side", "place", F.substring(word, place + 1, q).alias("gram"), rest.alias("rest"))


def near_words(words: DataFrame, work: WorkTables) -> DataFrame:
    """``(x, y)``: every pair of near words once (``words``: one row per word, in column ``word``).

    Words of one code point and less have no chunks and are left out.
    """
    key = ["size", "side", "gram"]
    chunks = work.keep(_chunks(words.filter(F.length("word") > 1)), "chunks")
    grams = work.keep(_grams(words.filter(F.length("word") > 1)), "grams")
    counts = chunks.select(*key, F.lit(1).alias("c"), F.lit(0).alias("g")).unionByName(
        grams.select(*key, F.lit(0).alias("c"), F.lit(1).alias("g"))).groupBy(*key).agg(F.sum("c").alias("c"), F.sum("g").alias("g"))
    crowded = work.keep(counts.filter(F.col("c") * F.col("g") > CROWDED).select(*key, F.lit(True).alias("crowded")), "crowded")

    def dealt(frame: DataFrame, word: str, parts: Column) -> DataFrame:
        marked = frame.join(crowded, key, "left")
        part = F.explode(F.when(F.col("crowded"), parts).otherwise(F.array(F.lit(""))))
        return marked.select(*key, "place", word, part.alias("part"))

    left_out = _without(F.col("rest"))
    short = F.array_distinct(F.transform(left_out, lambda v: F.regexp_replace(v, "^[0-9]+", "")))
    x = dealt(grams, "x", F.when(F.length("x") == F.col("size"), left_out).otherwise(F.array(F.concat(F.lit(":"), "rest"))))
    y = dealt(chunks, "y", F.concat(left_out, short)).withColumnRenamed("place", "chunk_place")
    pairs = x.join(y, [*key, "part"]).filter((F.abs(F.col("place") - F.col("chunk_place")) <= 1)
                                             & ((F.length("x") < F.length("y")) | (F.col("x") < F.col("y"))))
    return pairs.filter(F.levenshtein("x", "y", 1) == 1).select("x", "y").distinct()


def roots(forms: DataFrame, work: WorkTables) -> DataFrame:
    """``(word, root)`` of every word in ``forms`` ``(word, form)``: the last of the chain of forms.

    A form has at least ``LEAD`` times its word's occurrences, so chains have no circles and no more
    links than that growth allows; each round doubles the part of the chain that is followed.
    """
    now = work.keep(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        following = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = work.keep(now.join(following, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = joined.select("word", "root")
        if joined.filter("moved").isEmpty():
            return now


def spelling_variants(counts: DataFrame, least: int = LEAST, lead: int = LEAD) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word with at least ``least`` occurrences.

    ``counts`` has columns ``word`` and ``n``, one row per word.  ``form`` is the near word
    with most occurrences (of equal ones the first in code-point order) where it has at least ``lead``
    times the word's, else null.  ``root`` is the last of the chain of forms, the word itself
    where there is no form.  An empty table gives no rows; null words and other columns are ignored.
    """
    work = WorkTables(counts.sparkSession)
    words = work.keep(counts.filter(F.col("word").isNotNull() & (F.col("n") >= least)).select("word", "n"), "words")
    pairs = work.keep(near_words(words.select("word"), work), "near")
    both = pairs.select(F.col("x").alias("word"), F.col("y").alias("near")).unionByName(
        pairs.select(F.col("y").alias("word"), F.col("x").alias("near")))
    best = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"))
    found = words.join(best, "word", "left")
    follows = -F.col("best.order") >= lead * F.col("n")
    found = work.keep(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                   F.when(follows, F.col("best.near")).alias("form"),
                                   F.when(follows, -F.col("best.order")).alias("form_n")), "found")
    last = roots(found.filter("form is not null"), work)
    out = found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    return work.result(out, "spelling")
