"""Language identification by a byte convolutional network over fixed-length windows.

Filters of several widths slide over the bytes of a window (a byte is a
one-hot input, so a filter is one weight per position and byte), each is pooled
by its maximum over the window, and a softmax layer reads the pooled values.
The network is trained in numpy on a bounded sample of labelled windows; every
text is then cut into windows that cover it whole, and the windows' class
probabilities are averaged by the letters they hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.llm.textbytes import LOWER, blocks

UNKNOWN = "und"
WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 12
# The training sample: at most so many documents of a language and windows of a document.  All languages are learned;
# they share SAMPLE_TOTAL documents, with at least one each.
SAMPLE_DOCUMENTS, SAMPLE_WINDOWS, SAMPLE_TOTAL = 600, 6, 150_000
EPOCHS, BATCH, RATE = 6, 128, 0.02
# Windows taken through the network at once.
CHUNK = 256
# Shortest training window, in bytes: short texts are part of the task.
SHORTEST = 6


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id as text, mod 5, is 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


@dataclass
class Network:
    languages: list[str]
    filters: list[np.ndarray]  # per width: (width, 256, FILTERS)
    weights: np.ndarray  # (pooled, languages)
    bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """For training: maximum of every filter over (n, WINDOW) bytes, and where it was.

        Every filter is read at the places where the widest one fits.
        """
        values, places = [], []
        span = windows.shape[1] - max(WIDTHS) + 1
        for f in self.filters:
            total = f[0][windows[:, :span]]
            for k in range(1, len(f)):
                total += f[k][windows[:, k:k + span]]
            at = total.argmax(axis=1)
            places.append(at)
            values.append(np.take_along_axis(total, at[:, None, :], axis=1)[:, 0])
        return np.maximum(np.concatenate(values, axis=1), 0), places

    def pair_tables(self) -> tuple[np.ndarray, np.ndarray]:
        """All filters as sums over byte pairs: what the first pair adds at a place, and what the second does."""
        tables = []
        for first in range(0, max(WIDTHS), 2):
            parts = []
            for f in self.filters:
                zero = np.zeros_like(f[0])
                a, b = (f[k] if k < len(f) else zero for k in (first, first + 1))
                parts.append((a[:, None, :] + b[None, :, :]).reshape(1 << 16, FILTERS))
            tables.append(np.ascontiguousarray(np.concatenate(parts, axis=1)))
        return tuple(tables)

    def probabilities(self, windows: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Class probabilities of (n, WINDOW) bytes; one table lookup covers two bytes of all filters."""
        bytes_ = windows.astype(np.int32)
        pairs = (bytes_[:, :-1] << 8) | bytes_[:, 1:]
        total = tables[0].take(pairs[:, :-2], axis=0)
        total += tables[1].take(pairs[:, 2:], axis=0)
        return softmax(np.maximum(total.max(axis=1), 0) @ self.weights + self.bias)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Adam:
    def __init__(self, parameters: list[np.ndarray]):
        self.parameters, self.t = parameters, 0
        self.mean = [np.zeros_like(p) for p in parameters]
        self.square = [np.zeros_like(p) for p in parameters]

    def step(self, gradients: list[np.ndarray], rate: float) -> None:
        self.t += 1
        for p, g, m, s in zip(self.parameters, gradients, self.mean, self.square):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(s / (1 - 0.99 ** self.t)) + 1e-6)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Fit the network by Adam on (n, WINDOW) bytes and language numbers; deterministic."""
    random = np.random.default_rng(seed)
    scale = 0.3
    filters = [random.normal(0, scale, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    network = Network(languages, filters, random.normal(
        0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))
    optimizer = Adam([*filters, network.weights, network.bias])
    # Rare languages weigh as much as frequent ones.
    share = np.bincount(labels, minlength=len(languages)).clip(1)
    weight = (len(labels) / (len(languages) * share))[labels].astype(np.float32)
    steps = EPOCHS * -(-len(labels) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(labels))
        for first in range(0, len(order), BATCH):
            at = order[first:first + BATCH]
            batch, wanted = windows[at], labels[at]
            hidden, places = network.pooled(batch)
            error = softmax(hidden @ network.weights + network.bias)
            error[np.arange(len(at)), wanted] -= 1
            error *= weight[at, None] / len(at)
            back = (error @ network.weights.T) * (hidden > 0)
            gradients, column = [], 0
            rows, outs = np.arange(len(at))[:, None], np.arange(FILTERS)[None, :]
            for f, place in zip(network.filters, places):
                g = np.zeros_like(f)
                for k in range(len(f)):
                    np.add.at(g[k], (batch[rows, place + k], outs), back[:, column:column + FILTERS])
                gradients.append(g)
                column += FILTERS
            gradients += [hidden.T @ error + 1e-4 * network.weights, error.sum(axis=0)]
            optimizer.step(gradients, RATE * (1 - step / steps) + 1e-4)
            step += 1
    return network


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (n, WINDOW) that cover every row's bytes, zero-filled at its end, and their rows.

    Neighbours overlap by the widest filter less one, so no place is lost at a border.
    """
    step = WINDOW - max(WIDTHS) + 1
    length = np.diff(offsets)
    count = np.where(length > 0, np.maximum(1, -(-(length - max(WIDTHS) + 1) // step)), 0)
    row = np.repeat(np.arange(len(length)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[row] + nth * step
    index = start[:, None] + np.arange(WINDOW)
    valid = index < offsets[row + 1][:, None]
    return np.where(valid, LOWER[data[np.minimum(index, max(len(data) - 1, 0))]], 0), row


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some windows of each text, spread over its whole length, at lengths from a few bytes to a whole window."""
    for batch in batches:
        langs, codes = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for first, end, data, offsets in blocks(batch.column(0)):
            out, names = [], []
            for k in range(first, end):
                text = data[offsets[k - first]:offsets[k - first + 1]]
                random = np.random.default_rng(codes[k] & (2**63 - 1))
                for _ in range(min(SAMPLE_WINDOWS, 1 + len(text) // WINDOW)):
                    size = WINDOW if random.random() < 0.5 else int(random.integers(SHORTEST, WINDOW))
                    at = int(random.integers(0, max(len(text) - size, 0) + 1))
                    out.append(text[at:at + size].tobytes())
                    names.append(langs[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.binary()), pa.array(names, pa.string())], names=["window", "lang"])


def fit(documents: DataFrame) -> Network | None:
    """Train on ``documents`` (doc_id, text, lang): non-null lang, not held out, a bounded sample of each language.

    The sample of a language is its rows with the smallest hashes of id and
    text, so it is the same on every run, and rows that share an id or have
    none are picked one by one.  Equal rows may take several places, but are
    learned from once.  None if nothing is labelled.
    """
    code = F.xxhash64(F.lit("sample"), "doc_id", "text")
    labelled = documents.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}")
        & F.coalesce(~held_out(F.col("doc_id")), F.lit(True))).withColumn("code", code)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("code"))
    smallest = {r["lang"]: r["codes"] for r in (
        labelled.select("lang", "code").withColumn("at", first).where(F.col("at") <= SAMPLE_DOCUMENTS)
        .groupBy("lang").agg(F.array_sort(F.collect_list("code")).alias("codes")).collect())}
    if not smallest:
        return None
    each = max(1, min(SAMPLE_DOCUMENTS, SAMPLE_TOTAL // len(smallest)))
    bounds = documents.sparkSession.createDataFrame(
        [(lang, codes[:each][-1]) for lang, codes in smallest.items()], "lang string, last long")
    # A row per language, which the network's classes are as well: texts are filtered where they are read.
    sample = (
        labelled.join(F.broadcast(bounds), "lang").where(F.col("code") <= F.col("last"))
        .groupBy("lang", "code").agg(F.first("text").alias("text"))
        .select(F.col("text").cast("binary"), "lang", "code")
        .mapInArrow(_sample_windows, "window binary, lang string").toPandas())
    sample = sample.sort_values(["lang", "window"], kind="stable")
    languages = sorted(smallest)
    data = pa.array(sample["window"].tolist(), pa.binary())
    windows = np.zeros((len(sample), WINDOW), np.uint8)
    for k, text in enumerate(data.to_pylist()):
        windows[k, :len(text)] = LOWER[np.frombuffer(text, np.uint8)]
    numbers = {lang: k for k, lang in enumerate(languages)}
    return train(windows, sample["lang"].map(numbers).to_numpy(), languages)


def _letters(windows: np.ndarray) -> np.ndarray:
    """Letters in each window, nearly: ASCII letters and first bytes of longer characters."""
    return ((windows >= 97) & (windows <= 122) | (windows >= 0xC3)).sum(axis=1)


def predict(documents: DataFrame, network: Network | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every row; only the text is looked at.

    ``und`` with score 0 if the text is null or has no letter, or if there is
    no network.  Ties go to the first language in name order.  Repeated rows
    and null ids get a row each.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.pair_tables() if network else None
        for batch in batches:
            texts, has_letter = batch.column(1), np.array(batch.column(2).to_pylist(), bool)
            names = np.full(batch.num_rows, UNKNOWN, object)
            scores = np.zeros(batch.num_rows)
            for first, end, data, offsets in blocks(texts) if network else ():
                total = np.zeros((end - first, len(network.languages)))
                windows, row = cut(data, offsets)
                for k in range(0, len(windows), CHUNK):
                    part = windows[k:k + CHUNK]
                    weight = _letters(part)[:, None] + 1e-3
                    np.add.at(total, row[k:k + CHUNK], network.probabilities(part, tables) * weight)
                known = np.flatnonzero(has_letter[first:end] & (total.sum(axis=1) > 0))
                share = total[known] / total[known].sum(axis=1, keepdims=True)
                names[first + known] = np.array(network.languages, object)[share.argmax(axis=1)]
                scores[first + known] = share.max(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    text = F.coalesce("text", F.lit(""))
    return documents.select("doc_id", text.cast("binary"), text.rlike(r"\p{L}")).mapInArrow(rows, schema)


def identify(documents: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): fit on the labelled part of ``documents`` and judge all of it."""
    return predict(documents, fit(documents)).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
