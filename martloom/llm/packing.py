"""Packing documents into windows of equal capacity by multiway differencing (Karmarkar-Karp).

Each task packs its own documents in groups: whole windows are cut from long
documents, the rest is cut into pieces, and differencing deals the pieces into
near-equal windows.  If a window comes out above the capacity, the group gets
one window more.  No shuffle; memory is one group.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from martloom.llm.word_tokens import word_tokens

CAPACITY = 2048
# What is left of a document beyond whole windows is cut into pieces of at most this many tokens.
PIECE = 512
# Tokens of a group; its windows are balanced together.
GROUP_TOKENS = 192 * CAPACITY
END_OF_TEXT = 1
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def balanced(sizes: list[int], windows: int) -> list[list[int]]:
    """Deal items into ``windows`` lists with near-equal sums.

    Every item starts as a partition of its own: its size in one window, zero
    in the others.  The two partitions with the largest differences merge, the
    fullest windows of one meeting the emptiest of the other, until one is left.
    """
    if not sizes:
        return [[] for _ in range(windows)]
    # A window's content is a node: an item, or a pair of nodes (left, right); -1 is empty.
    left, right = list(range(len(sizes))), [-1] * len(sizes)
    heap = []
    for k, size in enumerate(sizes):
        heap.append((-size, k, np.array([size], np.int64), np.array([k], np.int64)))
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, others, other_nodes = heapq.heappop(heap)
        # Sums are in falling order, one for each window in use; windows beyond them are empty.
        width = min(windows, len(sums) + len(others))
        back, facing = width - len(others), other_nodes[::-1]
        total, node = np.zeros(width, np.int64), np.empty(width, np.int64)
        total[:len(sums)] = sums
        total[back:] += others[::-1]
        # In [back, len(sums)) a window of one partition meets a window of the other.
        met = len(sums) - back
        left += nodes[back:].tolist()
        right += facing[:met].tolist()
        node[:back], node[len(sums):] = nodes[:back], facing[met:]
        node[back:len(sums)] = np.arange(len(left) - met, len(left))
        order = np.argsort(-total, kind="stable")
        total, node = total[order], node[order]
        spread = total[0] - (total[-1] if width == windows else 0)
        heapq.heappush(heap, (-int(spread), count, total, node))
        count += 1
    nodes = heap[0][3]
    out: list[list[int]] = []
    for node in nodes.tolist():
        items, stack = [], [node]
        while stack:
            k = stack.pop()
            if k < len(sizes):
                items.append(k)
            else:
                stack += [right[k], left[k]]
        out.append(sorted(items))
    return out + [[] for _ in range(windows - len(out))]


def fitted(sizes: list[int], capacity: int) -> list[list[int]]:
    """Balanced windows, as few as differencing can keep within the capacity, starting from the least possible."""
    total = sum(sizes)
    windows = max(1, -(-total // capacity))
    while True:
        dealt = balanced(sizes, windows)
        if all(sum(sizes[k] for k in w) <= capacity for w in dealt):
            return [w for w in dealt if w]
        windows += 1


def plan_group(lengths: list[int], capacity: int, piece: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, start, length) for documents of the given token counts."""
    windows, loose = [], []
    for doc, length in enumerate(lengths):
        whole = length // capacity * capacity
        windows += [[(doc, start, capacity)] for start in range(0, whole, capacity)]
        loose += [(doc, start, min(piece, length - start)) for start in range(whole, length, piece)]
    return windows + [[loose[k] for k in w] for w in fitted([p[2] for p in loose], capacity)] if loose else windows


def pack(
    documents: DataFrame, capacity: int = CAPACITY, piece: int = PIECE, tokenizer: str = TOKENIZER,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of all ``documents`` (doc_id, text, ...) placed in windows of at most ``capacity`` tokens.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and, unless ``with_ids`` is off, ids (little-endian unsigned 32-bit).  A
    document is its text's ids and one end id; a null or empty text is the end
    id alone.  Pieces of a window follow each other from offset 0.  Repeated
    rows and null doc_ids are packed each.  Other columns are not read.
    """
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
              ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.binary())] * with_ids)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(tokenizer)
        sequence = TaskContext.get().partitionId() << 32
        docs: list[tuple[int | None, np.ndarray]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence
            out: list[tuple] = []
            for window in plan_group([len(ids) for _, ids in docs], capacity, piece):
                offset = 0
                for k, start, length in window:
                    doc, ids = docs[k]
                    part = ids[start:start + length].tobytes()
                    row = (doc, start, length, zlib.crc32(part), len(ids), sequence, offset)
                    out.append(row + (part,) * with_ids)
                    offset += length
                sequence += 1
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, end, ids, at in words.encode(batch.column(1)):
                for k in range(first, end):
                    own = ids[at[k - first]:at[k - first + 1]]
                    docs.append((names[k], np.append(own, np.uint32(END_OF_TEXT))))
                    held += len(own) + 1
                    if held >= GROUP_TOKENS:
                        yield flush()
                        docs, held = [], 0
        if docs:
            yield flush()

    kinds = ", ".join(f"{name} long" for name, _ in fields) + ", ids binary" * with_ids
    return documents.select(
        F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(rows, kinds)
