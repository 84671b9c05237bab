"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string exactly one token can be the last one of its
encoding.  It is the longest token that ends there and may follow the last
token of the prefix before it; two tokens may stand next to each other if no
merge across their border comes before the merges that build them.  With the
table of last tokens kept, appended bytes extend it, and an edit recomputes it
only until it agrees with the old table again.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
NEVER = 1 << 60
# Pieces and token pairs a Python worker remembers; longer pieces are encoded each time.
CACHE_PIECES, CACHE_PAIRS, CACHE_LENGTH = 300_000, 400_000, 64
# Prefixes that an edit recomputes between two looks at the old table.
STRIDE = 32
# Texts of a batch that are answered at once.
TEXTS = 256


class Vocabulary:
    """Ranks of byte strings, with the two parts each token is merged from."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = [b""] * (max(self.rank.values()) + 1)
        for text, rank in self.rank.items():
            self.bytes_of[rank] = text
        self.longest = max(map(len, self.rank))
        self.size = [len(text) for text in self.bytes_of]
        # Finds all tokens that end at a position, longest first; bytes are read as the characters of Latin-1.
        self.ending = ahocorasick.Automaton()
        for text, rank in self.rank.items():
            self.ending.add_word(text.decode("latin-1"), rank)
        self.ending.make_automaton()
        self.parts: dict[int, tuple[int, int]] = {}
        self.pairs: dict[int, bool] = {}
        for rank, text in enumerate(self.bytes_of):
            for k in range(1, len(text)):
                a, b = self.rank.get(text[:k], NEVER), self.rank.get(text[k:], NEVER)
                if a < rank and b < rank and self._adjacent(a, b, rank):
                    self.parts[rank] = a, b
                    break

    def _adjacent(self, a: int, b: int, before: int) -> bool:
        """No merge earlier than ``before`` joins bytes of ``a`` with bytes of ``b``.

        Walks down from the two tokens to the bytes at their border.  A part
        lives from its own merge to that of its parent; while two parts meet at
        the border, merging them must not come first.  Of equal merges the left
        one is done first.
        """
        until_a = until_b = before
        while True:
            merged = self.rank.get(self.bytes_of[a] + self.bytes_of[b])
            if merged is not None and merged < until_a and merged <= until_b:
                return False
            made_a = a if a in self.parts else -1
            made_b = b if b in self.parts else -1
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                until_a, a = a, self.parts[a][1]
            else:
                until_b, b = b, self.parts[b][0]

    def extend(self, data: bytes, last: list[int], until: int) -> None:
        """Continue the table of last tokens ``last`` of the prefixes of ``data`` up to the length ``until``."""
        pairs, size, done = self.pairs, self.size, len(last)
        for at, token in self.ending.iter(data[:until].decode("latin-1"), max(0, done - self.longest)):
            if at + 1 < done:
                continue
            begin = at + 1 - size[token]
            if begin:
                pair = last[begin] << 32 | token
                follows = pairs.get(pair)
                if follows is None:
                    if len(pairs) >= CACHE_PAIRS:
                        pairs.clear()
                    follows = pairs[pair] = self._adjacent(last[begin], token, NEVER)
                if not follows:
                    continue
            last.append(token)
            done += 1
        if done <= until:
            raise ValueError("the vocabulary does not cover all bytes")


class PrefixTable:
    """The last token of every prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Exact, at the cost of the new bytes alone."""
        self.data += more
        self.vocabulary.extend(self.data, self.last, len(self.data))

    def edit(self, begin: int, end: int, new: bytes) -> int:
        """Replace bytes and return how many prefixes were recomputed.

        A last token depends on the bytes of one token's length and the last
        tokens there, so the old table holds again once that many entries agree.
        """
        old, shift = self.last, len(new) - (end - begin)
        self.data = self.data[:begin] + new + self.data[end:]
        self.last = old[:begin + 1]
        agree = done = 0
        while len(self.last) <= len(self.data):
            at = len(self.last)
            self.vocabulary.extend(self.data, self.last, min(at + STRIDE - 1, len(self.data)))
            for k in range(at, len(self.last)):
                done += 1
                agree = agree + 1 if k - shift > end and old[k - shift] == self.last[k] else 0
                if agree >= self.vocabulary.longest:
                    self.last[k + 1:] = old[k + 1 - shift:]
                    return done
        return done

    def tokens(self) -> list[int]:
        out, at, sizes = [], len(self.data), self.vocabulary.bytes_of
        while at:
            out.append(self.last[at])
            at -= len(sizes[out[-1]])
        return out[::-1]


class ByteBPE:
    """Encoder and decoder of whole texts: each match of the pattern on its own."""

    def __init__(self, path: str = RANKS, pattern: str = PATTERN):
        self.vocabulary = Vocabulary(path)
        self.split = regex.compile(pattern)
        self.known = _Pieces(self)

    def encode_piece(self, piece: str) -> list[int]:
        data = piece.encode()
        whole = self.vocabulary.rank.get(data)  # a piece that is a token is that token
        return [whole] if whole is not None else PrefixTable(self.vocabulary, data).tokens()

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.split.findall(text))), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids.tolist()))


class _Pieces(dict):
    """Encoded pieces, filled on demand."""

    def __init__(self, coder: ByteBPE):
        super().__init__()
        self.coder = coder

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.coder.encode_piece(piece), "<u4").tobytes()
        if len(piece) <= CACHE_LENGTH:
            self[piece] = ids
        return ids


class EditableText:
    """A text with its pieces' prefix tables, re-encoded near appends and edits only."""

    # No match looks further than a contraction's length beyond its own end.
    REACH = 4

    def __init__(self, coder: ByteBPE, text: str = ""):
        self.coder, self.text = coder, ""
        self.starts: list[int] = []
        self.tables: list[PrefixTable] = []
        self.edit(0, 0, text)

    def append(self, more: str) -> int:
        return self.edit(len(self.text), len(self.text), more)

    def edit(self, begin: int, end: int, new: str) -> int:
        """Replace a span of characters and return how many pieces were encoded anew."""
        keep = max(bisect.bisect_right(self.starts, max(0, begin - self.REACH)) - 1, 0)
        shift = len(new) - (end - begin)
        self.text = self.text[:begin] + new + self.text[end:]
        later = {s + shift: k for k, s in enumerate(self.starts) if s >= end}
        starts, tables = self.starts[:keep], self.tables[:keep]
        at, done = (self.starts[keep] if self.starts else 0), 0
        for match in self.coder.split.finditer(self.text, at):
            old = later.get(match.start())
            # Splitting goes left to right, so from a common start beyond the edit all pieces are the old ones.
            if old is not None and match.start() >= begin + len(new):
                starts += [s + shift for s in self.starts[old:]]
                tables += self.tables[old:]
                break
            data = match.group().encode()
            table = self._reused(match.start(), data, begin)
            starts.append(match.start())
            tables.append(table)
            done += 1
        self.starts, self.tables = starts, tables
        return done

    def _reused(self, start: int, data: bytes, begin: int) -> PrefixTable:
        """A piece that begins before the edit where one did and continues it grows from the old table."""
        k = bisect.bisect_left(self.starts, start)
        if start < begin and k < len(self.starts) and self.starts[k] == start and data.startswith(self.tables[k].data):
            table = self.tables[k]
            table.append(data[len(table.data):])
            return table
        return PrefixTable(self.coder.vocabulary, data)

    def ids(self) -> list[int]:
        rank = self.coder.vocabulary.rank
        out: list[int] = []
        for table in self.tables:
            whole = rank.get(table.data)
            out += [whole] if whole is not None else table.tokens()
        return out


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBPE:
    """One instance per Python worker."""
    return ByteBPE(path, pattern)


def encode_texts(
    documents: DataFrame, path: str = RANKS, pattern: str = PATTERN, with_ids: bool = True,
) -> DataFrame:
    """Ids of every whole text of ``documents`` (doc_id, text, ...), and a check of the way back.

    Columns: doc_id, n_tokens, ids_sha256, decoded_sha256 and, unless
    ``with_ids`` is off, ids (little-endian unsigned 32-bit).  A null text is
    the empty one: no ids.  Repeated rows and null doc_ids give a row each;
    other columns are not read.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for whole in batches:
            for k in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(k, TEXTS)
                ids = [bpe.encode(t or "") for t in batch.column(1).to_pylist()]
                columns = [
                    batch.column(0), pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(i)).hexdigest() for i in ids], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.array([i.tobytes() for i in ids], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return documents.select("doc_id", "text").mapInArrow(rows, schema)


def decode_ids(encoded: DataFrame, path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, text) from the ids of ``encode_texts``; bytes that are no UTF-8 become replacement characters."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for batch in batches:
            texts = [bpe.decode(np.frombuffer(i or b"", "<u4")).decode(errors="replace")
                     for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(rows, f"doc_id {kind}, text string")
