"""Whole texts to token ids through a public word-level tokenizer file, each distinct word encoded once.

The tokenizer lower-cases, drops white space and merges inside words only, so
a text's ids are its words' ids in order.  Texts are cut, in numpy, at ASCII
white space and between letters and ASCII punctuation, where no word of the
tokenizer can continue.  Short words are looked up all at once, by their bytes,
in a table of arrays; the distinct words that are not there go through a
dictionary to the tokenizer.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from martloom.llm.textbytes import SPACE, blocks, hash_spans, mix, spans

# Words a Python worker remembers, in two generations.
CACHE_WORDS = 320_000
# Slots of the table of short words, a power of two, and the ids and bytes a word there has at most.
SLOTS = 1 << 19
SLOT_IDS = 8
SLOT_BYTES = 15

# Words of letters that go through the tokenizer as one text.
JOINED = 256

# Kinds of bytes: letters; ASCII punctuation but the apostrophe, which can start a contraction; white space.
_LETTER, _MARK, _SPACE = 1, 2, 4
_KIND = bytes(
    _LETTER if ord("a") <= b <= ord("z") else
    _MARK if 0x21 <= b < 0x7F and not chr(b).isalnum() and chr(b) != "'" else
    _SPACE if SPACE[b] else 0 for b in range(256))
# Keeps the first k of eight bytes.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], "<u8")
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of lower-cased bytes; no piece crosses a row."""
    kind = np.frombuffer(data.tobytes().translate(_KIND), np.uint8)
    if len(data) > 1:
        letter, mark = kind == _LETTER, kind == _MARK
        # The two-byte letters of Latin-1 (C3 80 to C3 BF without the two signs) end a word as well.
        latin = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        ends_word = letter.copy()
        ends_word[1:] |= latin
        cut = np.flatnonzero((ends_word[:-1] & mark[1:]) | (mark[:-1] & letter[1:])) + 1
        offsets = np.concatenate((offsets, cut))
    return spans(kind != _SPACE, offsets)


def runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[k], first[k] + 1, ..., ``size[k]`` numbers, for every k in turn."""
    stop = np.cumsum(size)
    return np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(first - (stop - size), size)


class ShortWords:
    """Ids of words of at most ``SLOT_BYTES`` bytes and ``SLOT_IDS`` ids, one in a slot; a newer word takes an older one's.

    A slot's two keys are the word's bytes, zeros behind them, and its length, so equal keys are equal words.
    """

    def __init__(self):
        self.slots = SLOTS
        self.keys = np.zeros((2, self.slots), "<u8")
        self.sizes = np.zeros(self.slots, np.int64)
        self.ids = np.zeros(self.slots * SLOT_IDS, "<u4")

    def find(self, raw: bytes, starts: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both keys of every word, its slot, and whether it is there; ``raw`` has seven bytes or more behind the last."""
        eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
        keys = np.empty((2, len(starts)), "<u8")
        keys[0] = eight[starts] & _FIRST[np.minimum(length, 8)]
        keys[1] = length << 56
        longer = np.flatnonzero(length > 8)
        keys[1, longer] |= eight[starts[longer] + 8] & _FIRST[np.minimum(length[longer], SLOT_BYTES) - 8]
        keys[1, length > SLOT_BYTES] = 0xFF << 56  # a length no slot has
        slot = (mix(keys[0] * _SPREAD + keys[1]) & np.uint64(self.slots - 1)).astype(np.int64)
        return keys, slot, (self.keys[0, slot] == keys[0]) & (self.keys[1, slot] == keys[1])

    def put(self, keys: np.ndarray, slot: np.ndarray, ids: np.ndarray, at: np.ndarray, size: np.ndarray) -> None:
        """Keep the words of these keys whose ids are the ``size`` ones from ``at``, if they are short."""
        fits = np.flatnonzero((size <= SLOT_IDS) & (keys[1] >> np.uint64(56) <= SLOT_BYTES))
        slot, first = np.unique(slot[fits], return_index=True)
        fits = fits[first]
        self.keys[:, slot] = keys[:, fits]
        self.sizes[slot] = size[fits]
        self.ids[runs(slot * SLOT_IDS, size[fits])] = ids[runs(at[fits], size[fits])]


class WordTokens:
    """A tokenizer file with a bounded memory of the words seen."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        # Whether an id ends a word.
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[k for token, k in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.short = ShortWords()
        self.now: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def encoded(self, words: list[bytes]) -> list[bytes]:
        """What the tokenizer gives for each word.

        Words of letters, also in lower case, go through it as one text with spaces between.  None of them is without an
        id that ends a word, so if there are as many such ids as words, each has one; else that text's words go one by one.
        """
        out = [b""] * len(words)
        texts = [word.decode() for word in words]
        letters = [k for k, text in enumerate(texts) if text.lower().isalpha()] if self.ends_word.any() else []
        joined = [letters[k:k + JOINED] for k in range(0, len(letters), JOINED)]
        alone = sorted(set(range(len(words))).difference(letters))
        together = [" ".join([texts[k] for k in group]) for group in joined]
        for group, e in zip(joined, self.tokenizer.encode_batch_fast(together, add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            stop = (4 * np.flatnonzero(self.ends_word[ids]) + 4).tolist()
            if len(stop) != len(group):
                alone += group
                continue
            flat = ids.tobytes()
            for k, a, b in zip(group, [0, *stop], stop):
                out[k] = flat[a:b]
        for k, e in zip(alone, self.tokenizer.encode_batch_fast([texts[k] for k in alone], add_special_tokens=False)):
            out[k] = np.array(e.ids, "<u4").tobytes()
        return out

    def ids_of(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each word."""
        found = list(map(self.now.get, words))
        fresh = [k for k, ids in enumerate(found) if ids is None]
        for k in fresh:
            found[k] = self.before.get(words[k])
        missing = [k for k in fresh if found[k] is None]
        for k, ids in zip(missing, self.encoded([words[k] for k in missing])):
            found[k] = ids
        # Only words that are new to a generation fill it.
        if len(self.now) + len(fresh) > CACHE_WORDS // 2:
            self.before, self.now = self.now, dict(zip(words, found))
        else:
            self.now.update((words[k], found[k]) for k in fresh)
        return found

    def encode(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids of all rows, n + 1 offsets) for successive runs of rows of a binary column."""
        for first, end, data, offsets in blocks(column):
            raw = data.tobytes().lower() + bytes(8)
            data = np.frombuffer(raw, np.uint8, len(data))
            starts, ends = pieces(data, offsets)
            keys, slot, known = self.short.find(raw, starts, ends - starts)
            length = self.short.sizes[slot]
            # The others: every distinct one once.
            other = np.flatnonzero(~known)
            _, where, which = np.unique(
                hash_spans(data, starts[other], ends[other]), return_index=True, return_inverse=True)
            one = other[where]
            found = self.ids_of([raw[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist())])
            flat = np.frombuffer(b"".join(found), "<u4")
            size = np.array([len(k) // 4 for k in found], np.int64)
            at = np.cumsum(size) - size
            length[other] = size[which]
            tokens_before = np.concatenate(([0], np.cumsum(length)))
            # Numbers of unknown words' ids lead astray, also beyond the table, and are replaced.
            ids = self.short.ids.take(runs(slot * SLOT_IDS, length), mode="clip")
            ids[runs(tokens_before[other], length[other])] = flat[runs(at[which], length[other])]
            self.short.put(keys[:, one], slot[one], flat, at, size)
            yield first, end, ids, tokens_before[np.searchsorted(starts, offsets)]


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One instance per Python worker."""
    return WordTokens(path)
