"""Wildcard URL rules as one bit-parallel automaton.

All glob rules are laid side by side in a row of 64-bit words, one bit per
state.  Reading a byte advances every state of every rule with one shift, one
mask per byte value and one mask of wildcard loops (Shift-And), for a whole
batch of URLs at a time.  ``*`` stands for any bytes but the border between
host and path, ``**`` for any bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Between host and path of a canonical URL: a byte that UTF-8 text cannot hold.
BORDER = 0xFF
BATCH = 4096


@dataclass(frozen=True)
class Rule:
    """``name`` is reported; ``glob`` runs over ``.`` + host + border + path; of fitting rules the longest name wins."""

    name: str
    verdict: str
    glob: tuple[int | str, ...]


def site_rule(name: str, verdict: str) -> Rule:
    """A rule ``host/path``: the host and its subdomains, paths that start with the rule's."""
    host, slash, path = name.partition("/")
    return Rule(name, verdict, ("*", *f".{host}".encode(), BORDER, *f"{slash}{path}".encode(), "**"))


def glob_rule(name: str, verdict: str) -> Rule:
    """A free glob over host and path: ``*`` and ``**`` are wildcards, the first ``/`` is the border."""
    host, slash, path = name.partition("/")
    parts: list[int | str] = ["*", ord(".")]
    for piece, text in enumerate((host, slash + path)):
        if piece:
            parts.append(BORDER)
        raw, k = text.encode(), 0
        while k < len(raw):
            if raw[k:k + 2] == b"**":
                parts.append("**")
                k += 2
            else:
                parts.append("*" if raw[k] == ord("*") else raw[k])
                k += 1
    return Rule(name, verdict, tuple(parts))


class Automaton:
    """The rules' states packed into words; ``match`` runs a batch of byte strings."""

    def __init__(self, rules: list[Rule]):
        # Longest name first, then by name, so the first accepting rule is the one that wins.
        self.rules = sorted(rules, key=lambda r: (-len(r.name), r.name))
        states = [[x for x in r.glob if not isinstance(x, str)] for r in self.rules]
        total = sum(len(s) + 1 for s in states)
        self.words = (total + 63) // 64
        self.start = np.zeros(self.words, np.uint64)
        self.step = np.zeros((256, self.words), np.uint64)
        self.loop = np.zeros((256, self.words), np.uint64)
        self.accept: list[tuple[int, np.uint64]] = []
        at = 0
        for rule, literals in zip(self.rules, states):
            self._set(self.start, at)
            bit = at
            for part in rule.glob:
                if isinstance(part, str):
                    for value in range(256):
                        if part == "**" or value != BORDER:
                            self._set(self.loop[value], bit)
                else:
                    bit += 1
                    self._set(self.step[part], bit)
            self.accept.append((bit // 64, np.uint64(1) << np.uint64(bit % 64)))
            at += len(literals) + 1

    @staticmethod
    def _set(words: np.ndarray, bit: int) -> None:
        words[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    def match(self, texts: list[bytes]) -> np.ndarray:
        """For each text the index of the winning rule in ``self.rules``, or -1."""
        length = np.array([len(t) for t in texts], np.int64)
        first = np.cumsum(length) - length
        data = np.frombuffer(b"".join(texts), np.uint8)
        state = np.repeat(self.start[None, :], len(texts), axis=0)
        live, at, one, top = np.flatnonzero(length > 0), 0, np.uint64(1), np.uint64(63)
        while len(live):
            value = data[first[live] + at]
            now = state[live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[live] = (moved & self.step[value]) | (now & self.loop[value])
            at += 1
            live = live[length[live] > at]
        found = np.full(len(texts), -1)
        for k in range(len(self.rules) - 1, -1, -1):
            word, mask = self.accept[k]
            found[(state[:, word] & mask) != 0] = k
        return found


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules: list[Rule], otherwise: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url, ...).

    A null url, or one without ``://``, has empty host and path.  Without a
    fitting rule, ``rule`` is null and the verdict is ``otherwise``.  Repeated
    rows are judged each; other columns are not read; no rules judge all alike.
    """
    names, verdicts = pa.array([r.name for r in Automaton(rules).rules]), [r.verdict for r in Automaton(rules).rules]
    verdicts = pa.array(verdicts, pa.string())
    names = names.cast(pa.string())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(rules)
        for whole in batches:
            for k in range(0, whole.num_rows, BATCH):
                batch = whole.slice(k, BATCH)
                hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
                found = automaton.match([
                    b"." + h.encode() + bytes([BORDER]) + p.encode() for h, p in zip(hosts, paths)])
                at = pa.array(found, mask=found < 0)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, names.take(at), verdicts.take(at).fill_null(otherwise)],
                    names=["page_id", "host", "path", "rule", "verdict"])

    split = pages.select(
        F.col("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    kind = split.schema["page_id"].dataType.simpleString()
    return split.mapInArrow(judge, f"page_id {kind}, host string, path string, rule string, verdict string")
