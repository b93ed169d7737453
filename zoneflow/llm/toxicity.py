"""Operator 6: toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney models over the characters of words, one of toxic and
one of ordinary texts.  The top order is counted per class; all lower orders are
continuation counts pooled over both classes (with modified discounts for counts of 1,
2 and more), so a rare expression seen in neither
class backs off to the same shared estimate and says nothing, while one that shares
only its beginning with known toxic expressions is still recognised.

    P_y(c | h) = (n_y(hc) - D(n_y(hc)) + sum_d D(n_y(hd)) * P_shared(c | h')) / n_y(h.)

A word counts once for each document that has it, and of near copies in the sample
one counts, so that no single text teaches an expression.
The log-likelihood ratio of a word is the sum over its characters.  A text's score
uses length-normalised ratios: of the whole text, of its most suspicious window of
``WINDOW`` words (a few abusive words in a long text must not be diluted), and of its
second most suspicious word.
A logistic function fitted on labelled rows that the models have not seen maps them
to 0..1.

Learning uses a bounded sample: at most ``SAMPLE_PER_CLASS`` labelled rows of each
class, the ones of least id hash, and at most ``MAX_NGRAMS`` n-grams of each order,
the more frequent ones.  So the model has a bounded size and may be broadcast; scoring is one narrow
pass over the whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import (
    WordCodes,
    byte_values,
    chunks,
    crc_mod,
    gather,
    materialise,
    mix64,
    shingle_hashes,
)

ORDER = 6                    # characters of an n-gram of the top order
DISCOUNT = 0.75              # of the shared orders
WINDOW = 10                  # words
SAMPLE_PER_CLASS = 4000      # labelled rows of each class
MAX_NGRAMS = 1 << 19          # of each order
CACHED_WORDS = 300_000       # per Python worker
FEATURES = 3

_CACHE: dict[str, dict[bytes, float]] = {}


# -- n-grams ----------------------------------------------------------------------

def word_ngrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rolling hashes of every character of the words, end mark included.

    Returns an array (positions x ORDER) whose column ``k`` hashes the ``k`` characters
    before a position and the character itself, the same for the contexts without the
    character, and the word number of each position.
    """
    if not words:
        return np.zeros((0, ORDER), np.uint64), np.zeros((0, ORDER), np.uint64), np.zeros(0, np.int64)
    pad = "\x02" * (ORDER - 1)
    texts = [w.decode("utf-8", "replace") for w in words]
    points = np.frombuffer("".join(f"{pad}{t}\x03" for t in texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    word = np.repeat(np.arange(len(texts)), lengths)
    at = np.arange(len(word)) + (word + 1) * (ORDER - 1)
    char = mix64(points[at] + np.uint64(1 << 32))
    grams, contexts = np.empty((len(at), ORDER), np.uint64), np.empty((len(at), ORDER), np.uint64)
    context = np.full(len(at), 0x51ED27, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(ORDER):
            if k:
                context = mix64(context * np.uint64(0x9E3779B97F4A7C15) + points[at - k])
            contexts[:, k] = context
            grams[:, k] = mix64(context * np.uint64(0xD6E8FEB86659FD93) + char + np.uint64(k))
    return grams, contexts, word


@dataclass
class Model:
    """What scoring needs: ratios of the n-grams and contexts seen, then the logistic weights."""

    name: str
    grams: np.ndarray        # sorted hashes of the top order
    gram_ratio: np.ndarray   # log P_toxic - log P_ordinary
    contexts: np.ndarray     # sorted hashes of their contexts
    context_ratio: np.ndarray  # of unseen characters: the shared part cancels
    weights: np.ndarray

    def word_ratios(self, words: list[bytes]) -> np.ndarray:
        known = _CACHE.setdefault(self.name, {})
        new = [w for w in words if w not in known]
        if new:
            if len(_CACHE) > 1 or len(known) + len(new) > CACHED_WORDS:
                _CACHE.clear()
                known = _CACHE.setdefault(self.name, {})
                new = words
            for lo in range(0, len(new), 20_000):
                some = new[lo:lo + 20_000]
                grams, contexts, word = word_ngrams(some)
                ratio, found = _look_up(self.grams, self.gram_ratio, grams[:, -1])
                other, _ = _look_up(self.contexts, self.context_ratio, contexts[:, -1])
                known.update(zip(some, np.bincount(word, np.where(found, ratio, other), len(some)).tolist(),
                                 strict=True))
        out = np.fromiter((known[w] for w in words), np.float64, len(words))
        if len(known) > CACHED_WORDS:
            known.clear()
        return out

    def features(self, values: list[bytes | None]) -> np.ndarray:
        """Per text and word: ratio of the worst window, of the whole text, of the second worst word
        (no word: zeros)."""
        words = WordCodes(values)
        ratios = self.word_ratios(words.words)[words.codes]
        sums = np.concatenate([[0.0], np.cumsum(ratios)])
        out = np.zeros((len(values), FEATURES))
        for i, (a, b) in enumerate(zip(words.offsets[:-1], words.offsets[1:], strict=True)):
            if b > a:
                w = min(WINDOW, b - a)
                out[i, 0] = (sums[a + w:b + 1] - sums[a:b + 1 - w]).max() / WINDOW
                out[i, 1] = (sums[b] - sums[a]) / (b - a)
                if b > a + 1:
                    out[i, 2] = np.partition(ratios[a:b], b - a - 2)[b - a - 2]
        return out

    def scores(self, values: list[bytes | None]) -> np.ndarray:
        return _sigmoid(self.features(values) @ self.weights[:-1] + self.weights[-1])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    found = keys[at] == wanted
    return np.where(found, values[at], 0.0), found


# -- learning ---------------------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, held_out_rest: int, folds: int,
                    per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """``(doc_id, toxic, fold, text)`` of the bounded sample; fold ``held_out_rest`` never gets in.

    Labels other than 0 and 1 and null ids are ignored; a document that carries both
    labels counts as toxic; of documents that repeat an id one text is taken.
    """
    fold = crc_mod("doc_id", folds).cast("int")
    marked = (labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .withColumn("fold", fold).filter(F.col("fold") != held_out_rest))
    chosen = None
    for y in (0, 1):
        some = marked.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    # at most 2 * per_class small rows: the bound is this function's parameter
    chosen = F.broadcast(chosen.select(F.col("doc_id").cast("long").alias("_id"), "toxic", "fold"))
    sample = (texts.join(chosen, "_id").groupBy(F.col("_id").alias("doc_id"), "toxic", "fold")
              .agg(F.min("text").alias("text")))
    marks = ["mark0", "mark1", "mark2"]
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("fold", pa.int32()), ("text", pa.string()),
                        *[(m, pa.int64()) for m in marks]])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc_id, value in zip(batch.column(0).to_pylist(), byte_values(batch.column(3)), strict=True):
                words = WordCodes([value])
                h = shingle_hashes(words.codes, words.hashes(), 5)
                found.append([int(mix64(h + np.uint64(k)).min().view(np.int64)) if len(h) else doc_id
                              for k in range(len(marks))])
            yield gather({**{c: batch.column(c) for c in ("doc_id", "toxic", "fold", "text")},
                          **{m: [f[k] for f in found] for k, m in enumerate(marks)}}, schema)

    marked = sample.mapInArrow(mark, "doc_id long, toxic int, fold int, text string, mark0 long, mark1 long, mark2 long")
    for m in marks:  # near copies share a least shingle hash: of the rows that share one, the least id stays
        marked = marked.groupBy(m, "toxic").agg(F.min_by(F.struct(*marked.columns), "doc_id").alias("row")).select("row.*")
    return marked.select("doc_id", "toxic", "fold", "text")


def ngram_counts(sample: DataFrame) -> DataFrame:
    """``(k, gram, context, shorter, n1, n0)``: n-grams of every order with the documents whose words have
    them, per class; ``shorter`` is the n-gram without its first character."""
    schema = pa.schema([("toxic", pa.int32()), ("k", pa.int32()), ("gram", pa.int64()), ("context", pa.int64()),
                        ("shorter", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, values = batch.column(0).to_numpy(), byte_values(batch.column(1))
            for y in (0, 1):
                mine = [v for v, t in zip(values, toxic, strict=True) if t == y]
                for lo, hi in chunks(mine):
                    words = WordCodes(mine[lo:hi])
                    counts = np.zeros(len(words.words), np.int64)
                    for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True):
                        counts[np.unique(words.codes[a:b])] += 1
                    grams, contexts, word = word_ngrams(words.words)
                    for k in range(ORDER):
                        keys, first, at = np.unique(grams[:, k], return_index=True, return_inverse=True)
                        n = np.bincount(at, counts[word], len(keys)).astype(np.int64)
                        shorter = grams[first, k - 1] if k else np.zeros(len(keys), np.uint64)
                        yield gather({"toxic": pa.array(np.full(len(keys), y, np.int32)),
                                      "k": pa.array(np.full(len(keys), k, np.int32)),
                                      "gram": pa.array(keys.view(np.int64)),
                                      "context": pa.array(contexts[first, k].view(np.int64)),
                                      "shorter": pa.array(shorter.view(np.int64)), "n": pa.array(n)}, schema)

    made = sample.select("toxic", "text").mapInArrow(
        run, "toxic int, k int, gram long, context long, shorter long, n long")
    return made.groupBy("k", "gram", "context", "shorter").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("n1"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("n0"))


def fit(docs: DataFrame, labels: DataFrame, held_out_rest: int = 0, folds: int = 5,
        per_class: int = SAMPLE_PER_CLASS) -> Model:
    """A model learnt from labelled rows whose ``crc32(doc_id as text) mod folds`` is not ``held_out_rest``.

    The last of the other folds fits the logistic weights, the rest the n-gram models.
    Without labels of both classes the model has no n-grams and scores every text
    alike (below 0.5).
    """
    sample = materialise(labelled_sample(docs, labels, held_out_rest, folds, per_class), "toxic-sample")
    last = (held_out_rest - 1) % folds
    counts = materialise(ngram_counts(sample.filter(F.col("fold") != last)), "toxic-ngrams")
    least = _least_counts(counts)
    tables = []
    for k in range(ORDER):
        rows = counts.filter((F.col("k") == k) & (F.col("n0") + F.col("n1") >= least[k])).select(
            "gram", "context", "shorter", "n0", "n1").toArrow()
        tables.append({c: rows[c].to_numpy() for c in rows.column_names})
    model = _kneser_ney(tables)
    context = docs.sparkSession.sparkContext.broadcast(model)
    held = sample.filter(F.col("fold") == last).select("toxic", "text").mapInArrow(
        lambda batches: _feature_rows(context.value, batches), _FEATURE_DDL).toPandas()
    if held["toxic"].nunique() < 2:
        held = sample.select("toxic", "text").mapInArrow(
            lambda batches: _feature_rows(context.value, batches), _FEATURE_DDL).toPandas()
    model.weights = _logistic(held[["peak", "mean", "second"]].to_numpy(float), held["toxic"].to_numpy(float))
    return model


_FEATURE_DDL = "toxic int, peak double, mean double, second double"


def _least_counts(counts: DataFrame) -> list[int]:
    """Per order the least count that leaves at most ``MAX_NGRAMS`` n-grams (found by a histogram of counts)."""
    rows = counts.groupBy("k", F.least(F.col("n0") + F.col("n1"), F.lit(1000)).alias("n")).agg(
        F.count(F.lit(1)).alias("grams")).collect()
    found = []
    for k in range(ORDER):
        total, least = 0, 1001
        for n, grams in sorted(((r["n"], r["grams"]) for r in rows if r["k"] == k), reverse=True):
            total += grams
            if total > MAX_NGRAMS:
                break
            least = n
        found.append(least)
    return found


def _feature_rows(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("toxic", pa.int32()), *[(f, pa.float64()) for f in ("peak", "mean", "second")]])
    for batch in batches:
        f = model.features(byte_values(batch.column(1)))
        yield gather({"toxic": batch.column(0), "peak": pa.array(f[:, 0]), "mean": pa.array(f[:, 1]),
                      "second": pa.array(f[:, 2])}, schema)


def _kneser_ney(tables: list[dict[str, np.ndarray]]) -> Model:
    """Ratios of the top order, smoothed by the pooled continuation counts of the orders below."""
    shared_keys, shared = np.zeros(0, np.int64), np.zeros(0)
    floor = 1 / (len(tables[0]["gram"]) + 1)
    for k in range(ORDER - 1):
        # continuation count of an n-gram: the different characters seen before it, one order up
        grams, seen = np.unique(tables[k + 1]["shorter"], return_counts=True)
        order = np.argsort(tables[k]["gram"])
        keys = tables[k]["gram"][order]
        count = _look_up(grams, seen.astype(float), keys)[0]
        contexts, at = np.unique(tables[k]["context"][order], return_inverse=True)
        total = np.maximum(np.bincount(at, count, len(contexts)), 1)
        types = np.bincount(at, count > 0, len(contexts))
        if k:
            below, known = _look_up(shared_keys, shared, tables[k]["shorter"][order])
            below = np.where(known, below, floor)
        else:
            below = np.full(len(keys), floor)
        shared = (np.maximum(count - DISCOUNT, 0) + DISCOUNT * types[at] * below) / total[at]
        shared = np.maximum(shared, 1e-9)
        shared_keys = keys
    top = tables[-1]
    order = np.argsort(top["gram"].view(np.uint64))
    top = {c: v[order] for c, v in top.items()}
    below, known = _look_up(shared_keys, shared, top["shorter"])
    below = np.where(known, below, 1e-6)
    contexts, at = np.unique(top["context"].view(np.uint64), return_inverse=True)
    logs, backoffs = [], []
    for n in (top["n1"].astype(float), top["n0"].astype(float)):
        discount = _discounts(n)[np.minimum(n, 3).astype(int)]
        total, taken = np.bincount(at, n, len(contexts)), np.bincount(at, discount, len(contexts))
        seen = total > 0
        weight = np.where(seen, taken / np.maximum(total, 1), 1.0)
        own = np.where(seen[at], (n - discount) / np.maximum(total[at], 1), 0.0)
        logs.append(np.log(own + weight[at] * below))
        backoffs.append(np.log(weight))
    return Model(f"{id(top)}-{len(order)}-{hash(top['gram'].tobytes())}", top["gram"].view(np.uint64),
                 logs[0] - logs[1], contexts, backoffs[0] - backoffs[1], np.array([0.0] * FEATURES + [-1.0]))


def _discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 0, 1, 2 and more, from the counts of counts."""
    times = [max(1.0, float((n == k).sum())) for k in range(1, 5)]
    y = times[0] / (times[0] + 2 * times[1])
    found = [k - (k + 1) * y * times[k] / times[k - 1] for k in (1, 2, 3)]
    return np.array([0.0, *(min(max(d, 0.5 * k), 0.98 * k) for k, d in zip((1, 2, 3), found, strict=True))])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Weights and offset of a lightly penalised logistic regression."""
    if len(np.unique(y)) < 2:
        return np.array([0.0] * FEATURES + [-1.0])
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.diag([ridge] * FEATURES + [ridge / 100])
    for _ in range(steps):
        p = _sigmoid(z @ w)
        gradient = z.T @ (p - y) + penalty @ w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, gradient)
        w = w - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
    return w


# -- scoring ------------------------------------------------------------------------

def toxicity_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score, predicted)`` for every row, over its whole text.

    Null, empty and blank texts have no evidence and get the score of the logistic
    offset alone.  Repeated rows are scored alike; other columns are never read.  Very long
    texts are scored whole; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = byte_values(batch.column(1))
            for lo, hi in chunks(values):
                s = shared.value.scores(values[lo:hi])
                yield gather({"doc_id": batch.column(0).slice(lo, hi - lo), "score": pa.array(s),
                              "predicted": pa.array((s >= 0.5).astype(np.int32))}, schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, score double, predicted int").withColumnRenamed("doc_id", id_col)


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` scored below 0.5, all columns kept; null and empty texts stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = byte_values(batch.column(at))
            for lo, hi in chunks(values):
                keep = np.array([not v for v in values[lo:hi]]) | (shared.value.scores(values[lo:hi]) < 0.5)
                yield batch.slice(lo, hi - lo).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
