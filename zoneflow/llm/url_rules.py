"""Operator 7: URL rules by a bit-parallel wildcard automaton.

Rules are globs over the canonical url (lower-cased host, then path).  ``*`` stands for
any characters but ``/`` (so it stays inside a host), ``**`` for any characters.  All
globs are packed into one multiword Shift-And automaton: bit ``i`` of a state says that
a glob has matched up to its character ``i``; a wildcard is a bit that keeps itself.
One step per character advances all globs on all urls of a batch together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import byte_values, gather

# --- fixed values: the contract's rules (host, path, verdict) ---------------------
SITE_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
# ----------------------------------------------------------------------------------
#: The method's own globs, for urls that no site rule fits; the first that matches decides.
DEFAULT_GLOBS = (
    ("**/ads/**", "block"),
    ("**/login**", "block"),
    ("**.exe", "block"),
)
DEFAULT_VERDICT = "allow"


def site_globs(host: str, path: str) -> tuple[str, str]:
    """The globs of a rule for a host, its subdomains and a path prefix."""
    return f"{host}{path}**", f"*.{host}{path}**"


@dataclass
class Automaton:
    """Shift-And masks of several globs (words of 64 bits)."""

    step: np.ndarray     # (256, words): bits whose character a byte is
    stay: np.ndarray     # (256, words): bits that keep themselves on a byte
    start: np.ndarray    # (words,)
    ends: list[tuple[int, int]]  # (word, bit) of each glob's last state

    def matches(self, texts: Sequence[bytes]) -> np.ndarray:
        """(texts x globs) booleans."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-lengths, kind="stable")
        state = np.broadcast_to(self.start, (len(texts), len(self.start))).copy()
        flat = np.frombuffer(b"".join(texts), np.uint8)
        begins = np.concatenate([[0], np.cumsum(lengths)])[:-1][order]
        ordered = lengths[order]
        for at in range(int(ordered[0]) if len(texts) else 0):
            live = int(np.searchsorted(-ordered, -at, "left"))  # longer texts come first
            char = flat[begins[:live] + at]
            now = state[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.step[char]) | (now & self.stay[char])
        out = np.empty((len(texts), len(self.ends)), bool)
        for k, (word, bit) in enumerate(self.ends):
            out[order, k] = (state[:, word] >> np.uint64(bit)) & np.uint64(1) != 0
        return out


def compile_globs(globs: Sequence[str]) -> Automaton:
    """One automaton for all globs.  Each takes a start bit and one bit for each literal byte."""
    parsed, bits = [], 0
    for glob in globs:
        states: list[tuple[int | None, str]] = [(None, "")]  # (byte, wildcard that follows)
        rest = glob.encode()
        while rest:
            if rest[:1] == b"*":
                wide = rest[:2] == b"**"
                states[-1] = (states[-1][0], "**" if wide or states[-1][1] == "**" else "*")
                rest = rest[1 + wide:]
            else:
                states.append((rest[0], ""))
                rest = rest[1:]
        parsed.append((bits, states))
        bits += len(states)
    words = max(1, -(-bits // 64))
    step, stay = np.zeros((256, words), np.uint64), np.zeros((256, words), np.uint64)
    start, ends = np.zeros(words, np.uint64), []
    for first, states in parsed:
        for k, (byte, wildcard) in enumerate(states):
            word, bit = divmod(first + k, 64)
            one = np.uint64(1 << bit)
            if byte is None:
                start[word] |= one
            else:
                step[byte, word] |= one
            if wildcard:
                kept = stay[ord("/"), word]
                stay[:, word] |= one
                if wildcard == "*":
                    stay[ord("/"), word] = kept
        ends.append(divmod(first + len(states) - 1, 64))
    return Automaton(step, stay, start, ends)


def url_host(url: str = "url") -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: str = "url") -> Column:
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: str) -> Column:
    c = F.col(url).cast("string")
    at = F.instr(c, "://")
    return F.when(at > 0, F.substring(c, at + 3, F.length(c))).otherwise(F.lit(""))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = SITE_RULES,
               defaults: Sequence[tuple[str, str]] = DEFAULT_GLOBS, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """``(id_col, host, path, rule, verdict)`` of every row.

    A rule fits its host and all subdomains where the path starts with the rule's; the
    longest (of host and path together, then the first given) wins and is named ``rule``.
    Otherwise ``rule`` is null and the first default glob decides, or else the url is
    allowed.  Null urls and those without ``://`` have an empty host and path.
    Repeated rows are judged alike; other columns are ignored; an empty table gives no rows.
    """
    automaton = compile_globs([g for host, path, _ in rules for g in site_globs(host, path)] + [g for g, _ in defaults])
    ranked = sorted(range(len(rules)), key=lambda k: (-len(rules[k][0] + rules[k][1]), k))
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()),
                        ("verdict", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = automaton.matches([h + p for h, p in zip(byte_values(batch.column(1)), byte_values(batch.column(2)),
                                                             strict=True)])
            rule, verdict = [], []
            for row in found:
                best = next((k for k in ranked if row[2 * k] or row[2 * k + 1]), None)
                if best is not None:
                    rule.append(rules[best][0] + rules[best][1])
                    verdict.append(rules[best][2])
                else:
                    rule.append(None)
                    verdict.append(next((v for k, (_, v) in enumerate(defaults) if row[2 * len(rules) + k]),
                                        DEFAULT_VERDICT))
            yield gather({"page_id": batch.column(0), "host": batch.column(1), "path": batch.column(2), "rule": rule,
                          "verdict": verdict}, schema)

    parts = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(url_host(url_col), F.lit("")).alias("host"),
                         F.coalesce(url_path(url_col), F.lit("")).alias("path"))
    return parts.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string") \
        .withColumnRenamed("page_id", id_col)
