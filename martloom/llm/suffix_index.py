"""Removal of long repeated passages by a logarithmic family of sampled suffix arrays.

A suffix array lists suffixes so that equal beginnings are neighbours.  Here the
suffixes that start at *anchors* (``repeats.py``) are listed, about one in sixty
bytes, in the order of two fingerprints: of the first ``gram`` bytes, and of the
whole *segment*, which is all windows of ``length`` bytes that have this anchor.

New documents come in batches.  A batch gets an array of its own and is scanned,
merged with the arrays of all levels, for keys that now occur twice; then levels
of equal size are merged, so that k batches leave at most log2(k) + 1 levels and
an entry is rewritten a logarithmic number of times.  Two kinds of neighbours
matter: a segment that occurs twice is repeated as a whole; where only the gram
occurs in different segments, the single windows are compared.

Every step is an aggregation or an equi-join over all rows; a passage that a
third of the documents share is counted before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.llm import bloom
from martloom.llm.repeats import PIECE, Hashes, anchors, pieces
from martloom.llm.textbytes import blocks, giving_back
from martloom.session import stored, work_dir

# Bytes of a string that may occur only once.
LENGTH = 200
# Bytes an anchor is chosen by; the longer, the rarer by chance, but the more anchors.
GRAM = 64
BATCHES = 4
# Segments with one gram that one task compares; with more, their windows are counted in a shuffle.
GROUP = 2048

SUFFIXES = "gram long, segment long, n long"


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _suffix_rows(length: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("batch", pa.int32()), ("gram", pa.int64()), ("segment", pa.int64()), ("n", pa.int64())])
        for batch in batches:
            number = batch.column(0).to_numpy(zero_copy_only=False)
            for first, _, data, offsets in pieces(batch.column(1), length):
                found = anchors(data, offsets, length, gram)
                if found is None or not len(found.at):
                    continue
                which = number[first + found.row]
                order = np.lexsort((found.segment, found.gram, which))
                which, head, whole = which[order], found.gram[order], found.segment[order]
                new = np.ones(len(order), bool)
                new[1:] = (which[1:] != which[:-1]) | (head[1:] != head[:-1]) | (whole[1:] != whole[:-1])
                at = np.flatnonzero(new)
                yield _batch(schema, which[at], head[at].view(np.int64), whole[at].view(np.int64),
                             np.diff(np.append(at, len(order))))
    return rows


def suffixes(documents: DataFrame, batch, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(batch, gram, segment, n): the sampled suffixes of every text, counted per block of texts."""
    return documents.select(batch.cast("int").alias("batch"), F.col("text").cast("binary")).mapInArrow(
        giving_back(_suffix_rows(length, gram)), f"batch int, {SUFFIXES}")


class SuffixIndex:
    """Levels of suffix arrays in a shared folder, each over a run of batches.

    A level is complete once its success marker exists, and hidden by a complete
    one that covers its batches; so an ``add`` that dies and is done again, or a
    reader meanwhile, counts no batch twice.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, location: str | None = None):
        self.spark, self.location = spark, location or work_dir(spark, "suffix-index")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.location).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def levels(self) -> list[tuple[int, int]]:
        """(first, last) batch of every level, in order."""
        root = self._path(self.location)
        if not self._files.exists(root):
            return []
        names = [entry.getPath() for entry in self._files.listStatus(root)]
        runs = [tuple(map(int, p.getName().split("-")[1:])) for p in names
                if self._files.exists(self._path(p, "_SUCCESS"))]
        return sorted(r for r in runs if not any(o != r and o[0] <= r[0] and r[1] <= o[1] for o in runs))

    def read(self, levels: list[tuple[int, int]]) -> DataFrame:
        empty = self.spark.createDataFrame([], f"{SUFFIXES}, last int")
        return reduce(DataFrame.unionByName, [
            self.spark.read.schema(empty.schema).parquet(self._folder(run)) for run in levels], empty)

    def _folder(self, run: tuple[int, int]) -> str:
        return f"{self.location}/level-{run[0]}-{run[1]}"

    def _write(self, arrays: DataFrame, run: tuple[int, int]) -> DataFrame:
        arrays.sortWithinPartitions("gram", "segment").write.mode("overwrite").parquet(self._folder(run))
        return self.read([run])

    def add(self, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Take in the suffixes of new documents (gram, segment, n).

        Returns what has become a repeat by them, in this batch or an earlier one: (gram, segment) of whole segments,
        and (gram, segments) of grams that begin several segments.
        """
        levels = self.levels()
        number = levels[-1][1] + 1 if levels else 1
        merged, run = [], (number, number)
        while levels[:len(levels) - len(merged)]:
            before = levels[len(levels) - len(merged) - 1]
            if before[1] - before[0] != run[1] - run[0]:
                break
            merged, run = [before, *merged], (before[0], number)
        fresh = batch.select("gram", "segment", "n").withColumn("last", F.lit(number))
        if len(merged) == len(levels):
            scan = self._write(_merged(fresh.unionByName(self.read(levels))), run)
        else:
            self._write(_merged(fresh.unionByName(self.read(merged))), run)
            scan = stored(_merged(fresh.unionByName(self.read(levels))), "merge-scan")
        whole = stored(scan.where((F.col("n") > 1) & (F.col("last") == number)).select("gram", "segment"), "repeated")
        shared = stored(
            scan.groupBy("gram").agg(F.count("*").alias("segments"), F.max("last").alias("last"))
            .where((F.col("segments") > 1) & (F.col("last") == number)).select("gram", "segments"), "shared")
        for old in merged:
            self._files.delete(self._path(self._folder(old)), True)
        return whole, shared


def _merged(arrays: DataFrame) -> DataFrame:
    return arrays.groupBy("gram", "segment").agg(F.sum("n").alias("n"), F.max("last").alias("last"))


MARKS = "key binary, low long, high long, gram long, segment long, bytes binary"


def _mark_rows(length: int, gram: int, met: np.ndarray, shared: np.ndarray):
    """Segments whose gram may have been met again, once per text and task; with bytes, once per task, if other segments may have it."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.binary()), ("low", pa.int64()), ("high", pa.int64()), ("gram", pa.int64()),
                            ("segment", pa.int64()), ("bytes", pa.binary())])
        texts: set[bytes] = set()
        sent: set[tuple[int, int]] = set()
        for batch in batches:
            keys = batch.column(0).to_pylist()
            new = np.zeros(len(keys), bool)
            for k, key in enumerate(keys):
                if key not in texts:
                    texts.add(key)
                    new[k] = True
            for first, base, data, offsets in pieces(batch.column(1), length):
                found = anchors(data, offsets, length, gram)
                if found is None or not len(found.at):
                    continue
                take = np.flatnonzero(new[first + found.row] & bloom.test(met, _code(found.gram)))
                several = bloom.test(shared, _code(found.gram[take]))
                content: list[bytes | None] = [None] * len(take)
                for k in np.flatnonzero(several).tolist():
                    at = take[k]
                    name = int(found.gram[at]), int(found.segment[at])
                    if name not in sent:
                        sent.add(name)
                        content[k] = data[found.low[at]:found.high[at] + length].tobytes()
                row, start = found.row[take], base - offsets[found.row[take]]
                yield _batch(schema, [keys[first + r] for r in row.tolist()], found.low[take] + start,
                             found.high[take] + start, found.gram[take].view(np.int64),
                             found.segment[take].view(np.int64), content)
    return rows


def _code(grams: np.ndarray) -> np.ndarray:
    """Grams are hashes already: they are their own codes in the filters."""
    return grams


def _windows(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, offset in the row, hash) of every window of ``length`` bytes of the rows."""
    rows, places, hashes = [], [], []
    for first, _, data, offsets in blocks(column, PIECE):
        at = np.arange(len(data) - length + 1)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(at)]
        at = at[offsets[1:][row] - at >= length]
        row = row[at]
        rows.append(row + first)
        places.append(at - offsets[row])
        hashes.append(Hashes(data).spans(at, at + length))
    return np.concatenate(rows), np.concatenate(places), np.concatenate(hashes)


COVERED = "key binary, start long, end long"


def _group_matches(length: int):
    """Windows that occur in two segments with one gram; rows come ordered by gram."""
    def matches(table: pa.Table) -> pa.RecordBatch | None:
        table = table.combine_chunks()
        row, place, code = _windows(table.column("bytes").chunk(0), length)
        gram = table.column("gram").to_numpy()[row]
        order = np.lexsort((code, gram))
        same = (gram[order][1:] == gram[order][:-1]) & (code[order][1:] == code[order][:-1])
        twice = np.zeros(len(order), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        alone = ~table.column("whole").to_numpy(zero_copy_only=False)
        hit = np.flatnonzero(twice & alone[row])
        if not len(hit):
            return None
        # Windows come in order; neighbours of one row are one stretch.
        first = np.ones(len(hit), bool)
        first[1:] = (row[hit][1:] != row[hit][:-1]) | (place[hit][1:] != place[hit][:-1] + 1)
        start = np.flatnonzero(first)
        end = np.append(start[1:], len(hit)) - 1
        low = table.column("low").to_numpy()[row[hit]]
        schema = pa.schema([("key", pa.binary()), ("start", pa.int64()), ("end", pa.int64())])
        return _batch(schema, table.column("key").take(pa.array(row[hit][start])).combine_chunks(),
                      (low + place[hit])[start], (low + place[hit])[end] + length)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            grams = batch.column("gram").to_numpy()
            if not len(grams):
                continue
            # All but the last gram of a batch is complete.
            cut = int(np.searchsorted(grams != grams[-1], False)) if grams[0] != grams[-1] else 0
            if grams[0] == grams[-1] and held and held[-1].column("gram")[-1].as_py() != grams[0]:
                out = matches(pa.Table.from_batches(held))
                held = []
                if out:
                    yield out
            if cut:
                out = matches(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
                if out:
                    yield out
            held.append(batch.slice(cut))
        if held:
            out = matches(pa.Table.from_batches(held))
            if out:
                yield out
    return rows


def _window_rows(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.binary()), ("start", pa.int64()), ("gram", pa.int64()),
                            ("window", pa.int64()), ("whole", pa.bool_())])
        for batch in batches:
            if batch.num_rows:
                row, place, code = _windows(batch.column("bytes"), length)
                taken = batch.take(pa.array(row))
                yield _batch(schema, taken.column("key"), taken.column("low").to_numpy() + place,
                             taken.column("gram"), code.view(np.int64), taken.column("whole"))
    return rows


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.int64()))])
    for batch in batches:
        out = []
        for text, stretches in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            text = text or b""
            kept, at, edges = hashlib.sha256(), 0, []
            for start, end in sorted((s["start"], s["end"]) for s in stretches or ()):
                if edges and start <= edges[-1]:
                    edges[-1] = max(edges[-1], end)
                else:
                    edges += [start, end]
            for start, end in zip(edges[::2], edges[1::2]):
                kept.update(text[at:start])
                at = end
            kept.update(text[at:])
            removed = sum(edges[1::2]) - sum(edges[::2])
            out.append((len(text), removed, len(edges) // 2, kept.hexdigest(), edges))
        if out:
            yield _batch(schema, batch.column(0), *zip(*out))


def remove_repeats(
    documents: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES, group: int = GROUP,
    index: SuffixIndex | None = None,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row of ``documents`` (doc_id, text, ...).

    Bytes in a string of ``length`` bytes that also starts elsewhere, in this or another row, are removed; ``spans`` lists the ends of the removed
    runs.  Null texts are empty; texts under ``length`` bytes keep all.  Rows with equal texts repeat each other, so long ones
    lose everything; ids may be null or repeated.  Other columns are not read.  An empty table gives no rows.
    The documents enter the index in ``batches``; all are judged once the last is in.  ``index`` must be a new one.
    """
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    index = index or SuffixIndex(documents.sparkSession)
    arrays = stored(suffixes(texts, F.pmod(F.xxhash64("text"), F.lit(batches)), length, gram), "suffixes")
    found = [index.add(arrays.where(F.col("batch") == b)) for b in range(batches)]
    whole = stored(reduce(DataFrame.unionByName, [w for w, _ in found]).distinct(), "repeated-segments")
    shared = stored(
        reduce(DataFrame.unionByName, [s for _, s in found]).groupBy("gram").agg(F.max("segments").alias("segments")),
        "shared-grams")

    met = whole.select("gram").unionByName(shared.select("gram"))
    met_bits, _ = bloom.hash_filters(met, "gram", bloom.filter_bytes(met.count()))
    shared_bits, _ = bloom.hash_filters(shared, "gram", bloom.filter_bytes(shared.count()))
    key = F.expr("substring(unhex(sha2(text, 256)), 1, 16)").alias("key")
    marks = stored(
        texts.select(key, "text").mapInArrow(giving_back(_mark_rows(length, gram, met_bits, shared_bits)), MARKS)
        .join(whole.withColumn("whole", F.lit(True)), ["gram", "segment"], "left")
        .withColumn("whole", F.coalesce("whole", F.lit(False))), "marks")

    covered = marks.where("whole").select("key", F.col("low").alias("start"), (F.col("high") + length).alias("end"))
    # The segments that begin alike: one row for each, however often it occurs.
    alike = marks.where("bytes is not null").join(shared, "gram").dropDuplicates(["gram", "segment"])
    covered = covered.unionByName(
        alike.where(F.col("segments") <= group).select("key", "low", "gram", "bytes", "whole")
        .repartition("gram").sortWithinPartitions("gram").mapInArrow(giving_back(_group_matches(length)), COVERED))
    if not shared.where(F.col("segments") > group).isEmpty():
        windows = stored(
            alike.where(F.col("segments") > group).select("key", "low", "gram", "bytes", "whole")
            .mapInArrow(_window_rows(length), "key binary, start long, gram long, window long, whole boolean"), "windows")
        twice = windows.groupBy("gram", "window").agg(F.count("*").alias("n")).where("n > 1")
        covered = covered.unionByName(
            windows.where("not whole").join(twice, ["gram", "window"], "left_semi")
            .select("key", "start", (F.col("start") + length).alias("end")))
    stretches = stored(
        covered.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("stretches")), "stretches")

    # Texts that lose nothing pass without a shuffle.
    code = F.xxhash64("key")
    bits, _ = bloom.hash_filters(stretches.select(code.alias("code")), "code", bloom.filter_bytes(stretches.count()))
    tested = texts.select("doc_id", "text", key).withColumn("maybe", bloom.maybe_in(bits, code))
    none = F.lit(None).cast(stretches.schema["stretches"].dataType).alias("stretches")
    rows = tested.where("not maybe").select("doc_id", "text", none).unionByName(
        tested.where("maybe").join(stretches, "key", "left").select("doc_id", "text", "stretches"))
    return rows.mapInArrow(
        giving_back(_kept_rows), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")
