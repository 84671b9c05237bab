"""Token totals by source, language and tokenizer version, kept up to date by signed deltas.

A batch of inserts, deletes and revised counts is turned into signed rows: a
new count is added, the count it replaces is taken back.  The signed rows go to
a ledger, their sums to the totals.  A batch is committed by one marker file,
after all its rows are written; a batch that is already committed changes
nothing, one that stopped half-way is written anew.  Totals are never recounted.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.llm import bloom
from martloom.llm.exact_dedup import normalised
from martloom.session import stored, work_dir

PUT, DELETE = "put", "delete"
GROUP = ["source", "lang", "tokenizer"]
LEDGER = "doc_id long, source string, lang string, tokenizer string, tokens long, sign long"
TOTALS = "source string, lang string, tokenizer string, documents long, tokens long"


@lru_cache(maxsize=4)
def _encoding(name: str) -> tiktoken.Encoding:
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(documents: DataFrame, tokenizer: str) -> DataFrame:
    """``documents`` (doc_id, text, source, lang) with the text replaced by its number of tokens; a null text has none.

    ``tokenizer`` names a rank file of the public tokenizers and is the version counted under.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(tokenizer)
        for batch in batches:
            tokens = pa.array([len(encoding.encode_ordinary(t or "")) for t in batch.column(3).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], tokens], names=["doc_id", "source", "lang", "tokens"])

    return (
        documents.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), "text")
        .mapInArrow(rows, "doc_id long, source string, lang string, tokens long")
        .withColumn("tokenizer", F.lit(tokenizer)))


class TokenRollup:
    """The ledger and the totals in one shared folder."""

    def __init__(self, spark: SparkSession, location: str | None = None):
        self.spark = spark
        self.location = location or work_dir(spark, "token-rollup")

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.location, *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def committed(self) -> list[str]:
        files, folder = self._files(), self._path("commits")
        return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []

    def _read(self, kind: str, schema: str) -> DataFrame:
        """Rows of committed batches only."""
        paths = [f"{self.location}/{kind}/{batch}" for batch in self.committed()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def commit(self, batch: str, changes: DataFrame, every_row: bool = False) -> bool:
        """Apply a batch once; False if it had been applied before.

        ``changes``: op (put or delete), doc_id, tokenizer, and for puts
        source, lang, tokens.  A put inserts a document or replaces its count,
        also under another source or language.  Deleting an unknown document
        changes nothing.  Of several changes of one document and tokenizer in a
        batch the delete counts, else the put with the largest count.  Rows
        without doc_id or tokenizer name no document and are left out.

        With ``every_row`` a doc_id stands for all rows that bear it: every put
        counts, and the puts of a document replace all its earlier rows.  Rows
        without doc_id are added and never replaced or deleted.  Equal rows are
        one ledger row with their number, so a hot id or text is no large group.
        """
        if batch in self.committed():
            return False
        changes = changes.select("op", "doc_id", *GROUP, "tokens").where("tokenizer is not null")
        written, named = (self._every_row if every_row else self._one_per_document)(changes)
        if self.committed():
            known = self.current(named).withColumn("sign", -F.col("sign"))
            written = written.unionByName(known)
        ledger = f"{self.location}/ledger/{batch}"
        written.write.mode("overwrite").parquet(ledger)
        deltas = self.spark.read.schema(LEDGER).parquet(ledger).groupBy(*GROUP).agg(
            F.sum("sign").alias("documents"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens"))
        deltas.write.mode("overwrite").parquet(f"{self.location}/totals/{batch}")
        self._files().create(self._path("commits", batch), True).close()
        return True

    @staticmethod
    def _one_per_document(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(ledger rows of the puts, documents named)."""
        changes = changes.where("doc_id is not null")
        one = changes.groupBy("doc_id", "tokenizer").agg(F.min_by(
            F.struct("op", "source", "lang", "tokens"),
            F.struct("op", -F.coalesce("tokens", F.lit(0)), F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
        ).alias("c")).select("doc_id", "tokenizer", "c.*")
        written = one.where(F.col("op") == PUT).select(
            "doc_id", *GROUP, F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"), F.lit(1).alias("sign"))
        return written, one.select("doc_id", "tokenizer")

    @staticmethod
    def _every_row(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
        gone = changes.where((F.col("op") == DELETE) & F.col("doc_id").isNotNull()).select("doc_id", "tokenizer").distinct()
        puts = (
            changes.where(F.col("op") == PUT)
            .groupBy("doc_id", *GROUP, F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))
            .agg(F.count(F.lit(1)).alias("sign"))
            .join(gone, ["doc_id", "tokenizer"], "left_anti"))
        return puts, puts.select("doc_id", "tokenizer").unionByName(gone)

    def current(self, named: DataFrame | None = None) -> DataFrame:
        """The counts in force, of all documents or of those ``named`` (doc_id, tokenizer); ``sign`` is the number of equal rows.

        A count is in force unless later ledger rows have taken it back.
        """
        rows = self._read("ledger", LEDGER)
        if named is not None:
            rows = rows.join(named, ["doc_id", "tokenizer"], "left_semi")
        return rows.groupBy("doc_id", *GROUP, "tokens").agg(F.sum("sign").alias("sign")).where("sign > 0")

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, documents, tokens): the sum of all committed deltas; empty groups are left out."""
        return (
            self._read("totals", TOTALS).groupBy(*GROUP)
            .agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).where("documents <> 0"))


def corpus_rollup(documents: DataFrame, labels: DataFrame, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """Totals after a corpus is loaded, its low-quality texts revised and its toxic ones deleted.

    Three batches: all documents; new counts, with white space made single, of
    those labelled quality 0; deletes of those labelled toxic.  The deletes are
    sent twice, as after a lost answer, and count once.  Every row counts: also
    those without doc_id, which no label reaches, and all rows of a repeated
    doc_id, which are revised or deleted together.  A null text has no tokens;
    other columns are ignored.
    """
    rollup = TokenRollup(documents.sparkSession)
    rollup.commit("1-load", count_tokens(documents, tokenizer).withColumn("op", F.lit(PUT)), every_row=True)
    # Texts stay where they are read: a filter of the ids picks them, and only their counts meet the labels.
    low = stored(labels.where("quality = 0 and doc_id is not null").select(F.col("doc_id").cast("long")).distinct(), "low")
    bits, _ = bloom.hash_filters(
        low.select(F.xxhash64("doc_id").alias("code")), "code", bloom.filter_bytes(low.count()))
    maybe_low = documents.where(bloom.maybe_in(bits, F.xxhash64(F.col("doc_id").cast("long"))))
    revised = count_tokens(maybe_low.withColumn("text", normalised(F.col("text"))), tokenizer)
    rollup.commit("2-revise", revised.join(low, "doc_id", "left_semi").withColumn("op", F.lit(PUT)), every_row=True)
    gone = labels.where("toxic = 1").select(
        F.lit(DELETE).alias("op"), "doc_id", F.lit(tokenizer).alias("tokenizer"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in (("source", "string"), ("lang", "string"), ("tokens", "long"))])
    for _ in range(2):
        rollup.commit("3-delete", gone, every_row=True)
    return rollup.totals()
