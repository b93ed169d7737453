"""Operator 11: conversation structure repair by a grammar-compressed dynamic programme.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``, it holds no blank or
repeated row, and no row ends within a sentence.  Edits have costs (``KEEP`` 0, ``REROLE`` 1, ``DELETE``
2, ``INSERT`` 5, ``TRUNCATED`` 5 more for a truncated row that stays); the cheapest repair counts, of equal ones
the one whose edits' initials (the *audit*) come first in ASCII.

1. Rows are put in order by one range exchange on (conversation, turn), so a conversation of any
   length is dealt over tasks; pieces of at most ``PIECE`` rows become words over nine role/fault symbols.
2. Equal words count once.  Re-Pair replaces the most frequent pairs of symbols by rules, a bounded
   number in each of a few rounds, counted by Spark over all words.
3. A symbol stands for a min-plus matrix over the four states of the automaton; an entry is a cost
   and the audit that reaches it, as a rope.  A rule's matrix is the product of its two symbols' and
   is computed once, bottom-up, for all conversations.  A word's matrix is the product of its rules'.
4. Matrices of a conversation's pieces are multiplied in order, ``FAN`` at a time.  The audit tells
   every row's edit, so repaired rows are a join.

The order of least cost, then least audit, holds under products: audits of equal cost over the same
rows are never prefixes of each other, as edits other than inserts are one a row and inserts cost.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import WorkTables, gather, shuffle_width

PIECE = 4096           # rows of one word
FAN = 64               # matrices multiplied in one group
ROUNDS, RULES = 6, 64  # rounds of Re-Pair, rules made in each
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANKS = " \t\n\v\f\r"

#: kept whole, by role initial; truncated (capitals); to be deleted
SYMBOLS = "suaoSUAOx"
#: states: nothing yet, after s, after u, after a
STATES, ACCEPTING = 4, (0, 3)
NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}


# -- ropes and min-plus matrices -------------------------------------------------

class Rope:
    """A text as a tree whose parts are shared; ``mark`` is a hash of the whole text."""

    __slots__ = ("left", "mark", "right", "size", "text")
    PRIME, BASE = (1 << 61) - 1, 1_000_003

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.size, self.mark = len(text), 0
            for c in text:
                self.mark = (self.mark * self.BASE + ord(c)) % self.PRIME
        else:
            self.size = left.size + right.size
            self.mark = (left.mark * pow(self.BASE, right.size, self.PRIME) + right.mark) % self.PRIME

    def __add__(self, other: Rope) -> Rope:
        if not self.size or not other.size:
            return other if not self.size else self
        return Rope("", self, other)

    def leaves(self) -> Iterator[str]:
        stack = [self]
        while stack:
            node = stack.pop()
            if node.left is None:
                yield node.text
            else:
                stack += [node.right, node.left]

    def __str__(self) -> str:
        return "".join(self.leaves())

    def __lt__(self, other: Rope) -> bool:
        """ASCII order; parts that are equal as a whole are passed over."""
        mine, theirs = [self], [other]
        while mine and theirs:
            a, b = mine.pop(), theirs.pop()
            if a is b or (a.size == b.size and a.mark == b.mark):
                continue
            if a.left is None and b.left is None:
                n = min(a.size, b.size)
                if a.text[:n] != b.text[:n]:
                    return a.text[:n] < b.text[:n]
                mine += [Rope(a.text[n:])] if a.size > n else []
                theirs += [Rope(b.text[n:])] if b.size > n else []
            elif b.left is None or (a.left is not None and a.size >= b.size):
                mine += [a.right, a.left]
                theirs.append(b)
            else:
                mine.append(a)
                theirs += [b.right, b.left]
        return bool(theirs)


Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def least(a: Entry, b: Entry) -> Entry:
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if b[1] < a[1] else a


def times(left: Matrix, right: Matrix) -> Matrix:
    """Min-plus product; audits are concatenated."""
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    for i in range(STATES):
        for j in range(STATES):
            best, ties = None, []
            for k in range(STATES):
                a, b = left[i][k], right[k][j]
                if a is not None and b is not None:
                    cost = a[0] + b[0]
                    if best is None or cost < best:
                        best, ties = cost, [(a[1], b[1])]
                    elif cost == best:
                        ties.append((a[1], b[1]))
            for a, b in ties:
                out[i][j] = least(out[i][j], (best, a + b))
    return out


def inserts() -> Matrix:
    """Least inserts from state to state (none where nothing changes)."""
    out: Matrix = [[(0, Rope()) if i == j else None for j in range(STATES)] for i in range(STATES)]
    for start in range(STATES):
        state, audit = start, ""
        for _ in range(STATES):
            state, audit = NEXT[state][1], audit + "I"
            if out[start][state] is None:
                out[start][state] = (INSERT * len(audit), Rope(audit))
    return out


def symbol_matrix(symbol: str) -> Matrix:
    """One row, with the inserts before it."""
    row: Matrix = [[None] * STATES for _ in range(STATES)]
    for state in range(STATES):
        row[state][state] = (DELETE, Rope("D"))
        if symbol == "x":
            continue
        more = TRUNCATED if symbol.isupper() else 0
        role, after = NEXT[state]
        row[state][after] = least(row[state][after], (REROLE + more, Rope("R")))
        if symbol.lower() == role[0]:
            row[state][after] = least(row[state][after], (KEEP + more, Rope("K")))
        if state == 0 and symbol.lower() == "s":
            row[0][1] = (KEEP + more, Rope("K"))
    return times(inserts(), row)


def cheapest(matrix: Matrix) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    end = times([matrix[0]] + [[None] * STATES] * (STATES - 1), inserts())[0]
    best = None
    for state in ACCEPTING:
        best = least(best, end[state])
    return best[0], str(best[1])


# -- the grammar ---------------------------------------------------------------------

def rewrite(word: Sequence[int], rules: dict[tuple[int, int], int]) -> list[int]:
    """Pairs with a rule replaced, from left to right."""
    out, i, n = [], 0, len(word)
    while i < n:
        made = rules.get((word[i], word[i + 1])) if i + 1 < n else None
        out.append(word[i] if made is None else made)
        i += 1 if made is None else 2
    return out


def grammar(words: DataFrame) -> list[dict[tuple[int, int], int]]:
    """Rules by round: pair of symbols to its number (the nine symbols are 0 to 8).

    ``words`` has a column ``symbols``.  Every round counts the pairs of all words in tasks and
    makes rules of the ``RULES`` most frequent ones, at most; any set of rules gives the same repairs.
    """
    rounds: list[dict[tuple[int, int], int]] = []
    number = len(SYMBOLS)
    schema = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])
    for _ in range(ROUNDS):
        done = list(rounds)

        def pairs(batches: Iterator[pa.RecordBatch], done=done) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                counts: Counter[tuple[int, int]] = Counter()
                for text in batch.column(0).to_pylist():
                    word = encoded(text, done)
                    counts.update(zip(word, word[1:], strict=False))
                yield gather({"a": [p[0] for p in counts], "b": [p[1] for p in counts], "n": list(counts.values())}, schema)

        counts = words.select("symbols").mapInArrow(pairs, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        best = counts.filter("n > 1").orderBy(F.desc("n"), "a", "b").limit(RULES).collect()
        if not best:
            break
        rounds.append({(r["a"], r["b"]): number + k for k, r in enumerate(best)})
        number += len(best)
    return rounds


def encoded(text: str, rounds: Sequence[dict[tuple[int, int], int]]) -> list[int]:
    word = [SYMBOLS.index(c) for c in text]
    for rules in rounds:
        word = rewrite(word, rules)
    return word


def rule_matrices(rounds: Sequence[dict[tuple[int, int], int]]) -> list[Matrix]:
    """The matrix of every symbol and rule, bottom-up."""
    out = [symbol_matrix(c) for c in SYMBOLS]
    for rules in rounds:
        for (a, b), _ in sorted(rules.items(), key=lambda r: r[1]):
            out.append(times(out[a], out[b]))
    return out


# -- conversations -------------------------------------------------------------------

def damage(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """``(conv_id, turn, role, text)`` with one row in five damaged by the crc32 of ``conv_id:turn`` (nulls: one blank)."""
    conv, turn = (F.col(f"`{c}`").cast("long") for c in (id_col, turn_col))
    blank = F.lit(" ")
    named = F.concat(F.coalesce(conv.cast("string"), blank), F.lit(":"), F.coalesce(turn.cast("string"), blank))
    kind = F.crc32(named.cast("binary")) % 20
    rows = rows.select(conv.alias("conv_id"), turn.alias("turn"),
                       F.coalesce(F.col(f"`{role_col}`").cast("string"), blank).alias("role"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), blank).alias("text"), kind.alias("kind"))
    rows = rows.filter("kind != 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times_ = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), times_.alias("_copy")).drop("_copy")


def ordered(rows: DataFrame, work: WorkTables) -> DataFrame:
    """Rows with ``at``, a number that ascends in the order of (conversation, turn, role, text's hash), nulls first."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(shuffle_width(rows.sparkSession), *order).sortWithinPartitions(*order)
    return work.keep(dealt.withColumn("at", F.monotonically_increasing_id()), "turns")


def faults(rows: DataFrame) -> DataFrame:
    """``(conv_id, at, initial, fault)`` of ordered rows: ``blank``, ``duplicate``, ``truncated`` or null, the first that holds."""
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    light = rows.select("conv_id", "at", F.substring("role", 1, 1).alias("letter"), (trimmed == "").alias("blank"),
                        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("open"),
                        F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", F.lit(1), "role").alias("h2"))
    again = light.groupBy("conv_id", "h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).filter("n > 1")
    again = again.select(F.col("conv_id").alias("c"), F.col("h1").alias("k1"), F.col("h2").alias("k2"), "first")
    marked = light.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("at") > F.col("first"), "duplicate").when(F.col("open"), "truncated")
    initial = F.when(F.col("letter").isin("s", "u", "a"), F.col("letter")).otherwise("o")
    return marked.select("conv_id", "at", initial.alias("initial"), fault.alias("fault"))


def pieces(marked: DataFrame) -> DataFrame:
    """``(conv_id, piece, first_at, size, symbols, initials, blank, duplicate, truncated)``: runs of at most ``PIECE`` rows."""
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(
        F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))

    def joined(field: str) -> Column:
        return F.array_join(F.transform(F.col("rows"), lambda r: r[field]), "")

    counts = [F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")]
    grouped = marked.groupBy("conv_id", F.floor(F.col("at") / PIECE).cast("long").alias("piece")).agg(
        F.array_sort(F.collect_list(F.struct("at", symbol.alias("symbol"), "initial"))).alias("rows"), *counts)
    return grouped.select("conv_id", "piece", F.col("rows")[0]["at"].alias("first_at"), F.size("rows").alias("size"),
                          joined("symbol").alias("symbols"), joined("initial").alias("initials"), "blank", "duplicate", "truncated")


def illegal_pairs(parts: DataFrame) -> DataFrame:
    """``(conv_id, illegal)``: neighbours whose initials are not su, ua or au."""
    legal = F.regexp_count("initials", F.lit("(?=su|ua|au)"))
    before = F.lag(F.substring("initials", -1, 1)).over(Window.partitionBy("conv_id").orderBy("piece"))
    border = F.concat("before", F.substring("initials", 1, 1))
    crossing = F.when(F.col("before").isNull() | border.isin("su", "ua", "au"), 0).otherwise(1)
    return parts.select("conv_id", "piece", "initials", before.alias("before")).groupBy("conv_id").agg(
        F.sum(F.length("initials") - 1 - legal + crossing).cast("long").alias("illegal"))


_COSTS, _AUDITS = "costs array<int>", "audits array<string>"
_FLAT = [("costs", pa.list_(pa.int32())), ("audits", pa.list_(pa.string()))]


def _flat(matrix: Matrix) -> tuple[list, list]:
    cells = [cell for row in matrix for cell in row]
    return [c and c[0] for c in cells], [c and str(c[1]) for c in cells]


def _matrix(costs: list, audits: list) -> Matrix:
    cells = [None if c is None else (c, Rope(a)) for c, a in zip(costs, audits, strict=True)]
    return [cells[STATES * k:STATES * (k + 1)] for k in range(STATES)]


def word_matrices(words: DataFrame) -> DataFrame:
    """``(symbols, costs, audits)``: the matrix of every different word, row by row."""
    rounds = grammar(words)
    rules = rule_matrices(rounds)
    schema = pa.schema([("symbols", pa.string()), *_FLAT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text in batch.column(0).to_pylist():
                codes = encoded(text, rounds)
                matrix = rules[codes[0]]
                for code in codes[1:]:
                    matrix = times(matrix, rules[code])
                made.append(_flat(matrix))
            yield gather({"symbols": batch.column(0), "costs": [m[0] for m in made], "audits": [m[1] for m in made]}, schema)

    return words.select("symbols").mapInArrow(run, f"symbols string, {_COSTS}, {_AUDITS}")


def _multiplied(parts: DataFrame, work: WorkTables) -> DataFrame:
    """``(conv_id, costs, audits)``: the product of each conversation's pieces in order, ``FAN`` at a time."""
    schema = pa.schema([("conv_id", pa.int64()), ("rank", pa.int32()), *_FLAT])
    longer = parts.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("conv_id").alias("c"), "n")
    known = parts.join(longer, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    single = known.filter("n is null").select("conv_id", "costs", "audits")
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy("piece")) - 1
    now = work.keep(known.filter("n is not null").select("conv_id", rank.alias("rank"), "costs", "audits"), "matrices")
    most = known.agg(F.max("n")).first()[0] or 1

    def product(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["rank"])
        matrix = _matrix(rows[0]["costs"], rows[0]["audits"])
        for r in rows[1:]:
            matrix = times(matrix, _matrix(r["costs"], r["audits"]))
        costs, audits = _flat(matrix)
        return pa.table({"conv_id": [rows[0]["conv_id"]], "rank": [rows[0]["rank"] // FAN], "costs": [costs], "audits": [audits]}, schema)

    while most > 1:
        made = now.groupBy("conv_id", F.floor(F.col("rank") / FAN)).applyInArrow(product, f"conv_id long, rank int, {_COSTS}, {_AUDITS}")
        now, most = work.keep(made, "matrices"), -(-most // FAN)
    return single.unionByName(now.select("conv_id", "costs", "audits"))


def _edits(found: DataFrame, parts: DataFrame) -> DataFrame:
    """``(conv_id, at, slot, op, role)``: every edit of every row in order; a null ``role`` is the row's own."""
    runs = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("piece", "first_at", "symbols"))).alias("runs"))
    runs = runs.withColumnRenamed("conv_id", "c")
    both = found.join(runs, F.col("conv_id").eqNullSafe(F.col("c"))).select("conv_id", "audit", "runs")
    schema = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("slot", pa.int32()), ("op", pa.string()), ("role", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            for conv, audit, words in zip(*(batch.column(k) for k in range(3)), strict=True):
                conv, edits, state, slot, at = conv.as_py(), iter(audit.as_py()), 0, 0, 0
                for word in words.as_py():
                    for at, symbol in enumerate(word["symbols"], word["first_at"]):
                        for op in edits:
                            role = None
                            if op in "IR":
                                role, state = NEXT[state]
                            elif op == "K":
                                state = 1 if symbol in "sS" else NEXT[state][1]
                            out.append((conv, at, slot, op, role))
                            slot += 1
                            if op != "I":
                                slot = 0
                                break
                        if len(out) >= 100_000:
                            yield gather(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema)
                            out = []
                for slot, op in enumerate(edits, 1):   # inserts after the last row
                    role, state = NEXT[state]
                    out.append((conv, at, slot + STATES, op, role))
        if out:
            yield gather(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema)

    return both.mapInArrow(run, "conv_id long, at long, slot int, op string, role string")


def digests(repaired: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)`` of repaired rows joined as ``role:text`` lines.

    One hash runs over a whole conversation in order, so each is read by one task; rows pass one by one.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    dealt = repaired.repartition(shuffle_width(repaired.sparkSession), "conv_id").sortWithinPartitions("conv_id", "at", "slot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            ids, made = [], []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if state is None or conv != current:
                    if state is not None:
                        ids.append(current)
                        made.append(state.hexdigest())
                    current, state = conv, hashlib.sha256(line)
                else:
                    state.update(b"\n" + line)
            yield gather({"conv_id": ids, "repaired_sha256": made}, schema)
        if state is not None:
            yield gather({"conv_id": [current], "repaired_sha256": [state.hexdigest()]}, schema)

    lines = dealt.select("conv_id", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair(rows: DataFrame, work: WorkTables) -> tuple[DataFrame, DataFrame]:
    """``(conversations, repaired)`` of rows ``(conv_id, turn, role, text)``.

    ``conversations``: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every
    conversation that has rows; ``repaired``: ``conv_id, at, slot, op, role, text``, its rows in order of
    ``(at, slot)``, ``op`` telling K(ept), R(eroled) or I(nserted).  Null roles and texts count as one blank;
    a null turn comes first and has no part in ``gaps``; rows without a ``conv_id`` are one conversation.
    Rows of one turn are taken in the order of role and text's hash; repeated rows are duplicates.
    An empty table gives empty tables; other columns are ignored.
    """
    rows = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    turns = ordered(rows, work)
    parts = work.keep(pieces(faults(turns)), "pieces")
    words = work.keep(parts.select("symbols").distinct(), "words")
    matrices = work.keep(word_matrices(words), "word-matrices")
    whole = _multiplied(parts.join(matrices, "symbols").select("conv_id", "piece", "costs", "audits"), work)
    schema = pa.schema([("conv_id", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [cheapest(_matrix(c, a)) for c, a in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield gather({"conv_id": batch.column(0), "cost": [m[0] for m in made], "audit": [m[1] for m in made]}, schema)

    found = work.keep(whole.mapInArrow(best, "conv_id long, cost long, audit string"), "audits")
    gaps = turns.groupBy("conv_id").agg(F.coalesce(
        F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    sums = parts.groupBy("conv_id").agg(*[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")])
    out = found
    for more in (gaps, sums, illegal_pairs(parts)):
        more = more.withColumnRenamed("conv_id", "c")
        out = out.join(more, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    conversations = out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    edits = _edits(found, parts).filter("op != 'D'")
    own = turns.select(F.col("at").alias("a"), F.col("role").alias("own"), "text")
    kept = edits.filter("op != 'I'").join(own, F.col("at") == F.col("a")).select(
        "conv_id", "at", "slot", "op", F.coalesce("role", "own").alias("role"), "text")
    repaired = kept.unionByName(edits.filter("op = 'I'").withColumn("text", F.lit("")))
    return work.keep(conversations, "conversations"), work.keep(repaired, "repaired")


def repaired_digests(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The conversations of ``repair`` with ``repaired_sha256``, and every ``conv_id`` of ``ids``: those without rows
    have zeros, an empty audit and the hash of an empty text."""
    work = WorkTables(rows.sparkSession)
    conversations, repaired = repair(rows, work)
    every = ids.select(F.col("conv_id").cast("long").alias("id")).distinct()
    hashes = digests(repaired).withColumnRenamed("conv_id", "c")
    facts = conversations.join(hashes, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c").withColumnRenamed("conv_id", "own")
    out = every.join(facts, F.col("id").eqNullSafe(F.col("own")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    none = hashlib.sha256(b"").hexdigest()
    return work.result(out.select(F.col("id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                                  F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256")), "repairs")
