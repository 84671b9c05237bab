"""Joins, duplicates, shards, packing, rollups, vectors, pipeline: against brute force and on hard inputs."""

import re
import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from martloom.llm import (
    bloom, embedding_forest, exact_dedup, jaccard_join, kd_shards, language_id, packing, textbytes, token_rollup)
from martloom.llm import components as components_module
from martloom.llm.components import components
from martloom.llm.queries import llm_oracles, llm_queries
from martloom.llm.word_tokens import WordTokens

SF = "/root/testdata/sf0.001"


def smallest_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a
    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_components(spark):
    pick = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in pick.integers(0, 300, (220, 2))] + [(1000 + k, 1001 + k) for k in range(70)]
    df = spark.createDataFrame([*links, (5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components(df, "a", "b").collect()}
    want = smallest_reachable({n for link in links for n in link}, links)
    assert all(want[n] == r for n, r in got.items())
    assert {n for a, b in links if a != b for n in (a, b)} == set(got)
    assert components(df.limit(0), "a", "b").count() == 0


# --- n-gram Jaccard join ------------------------------------------------------------------------

def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def jaccard_groups(texts, link=75):
    sets = {d: shingles(t) for d, t in texts.items()}
    shared, having = defaultdict(int), defaultdict(list)
    for d, s in sets.items():
        for x in s:
            for other in having[x]:
                shared[other, d] += 1
            having[x].append(d)
    links = [p for p, n in shared.items() if 100 * n >= link * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    roots = smallest_reachable(texts, links)
    return {d: (len(sets[d]), roots[d]) for d in texts}


def family(pick, base, count, edits):
    out = []
    for _ in range(count):
        words = list(base)
        for at in pick.integers(0, len(words), edits):
            words[at] = f"w{pick.integers(0, 10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block", [512, 7])
def test_jaccard_join(spark, docs, monkeypatch, block):
    """Families around a base, chains, passages many texts share; also with regions cut into small blocks."""
    monkeypatch.setattr(jaccard_join, "REGION_BLOCK", block)
    pick = np.random.default_rng(block)
    passage = [f"p{k}" for k in range(60)]
    texts = []
    for size, edits in ((60, 3), (25, 8), (40, 12)):
        texts += family(pick, [f"b{size}x{k}" for k in range(200)], size, edits)
    chain = [f"c{k}" for k in range(150)]
    for step in range(30):
        texts.append(" ".join(chain[step * 3:] + [f"d{step * 3 + k}" for k in range(step * 3)]))
    texts += [" ".join(passage + [f"u{k}x{j}" for j in range(int(pick.integers(5, 90)))]) for k in range(60)]
    texts += ["a b c", "A  b\tc", "a b c d", "x", "", None, " \n ", texts[0].upper(), texts[3] + " ", "w " * 5000]
    rows = dict(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(
        docs(list(rows.items())).withColumn("component_id", F.lit("clash")).repartition(5)).collect()}
    assert got == jaccard_groups(rows)


def test_jaccard_sends_no_table_through_the_driver(spark, docs, monkeypatch):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    found = jaccard_join.jaccard_components(spark.read.parquet(f"{SF}/documents.parquet"))
    assert "SortMergeJoin" in plan(found) and "Broadcast" not in plan(found)
    seen = []
    pulled = components_module._pulled
    monkeypatch.setattr(components_module, "MOST_SENT", 0)
    monkeypatch.setattr(components_module, "_pulled", lambda *a: seen.append(pulled(*a)) or seen[-1])
    links = spark.createDataFrame([(k, k + 1) for k in range(20)], "a long, b long")
    assert {r.root for r in components(links, "a", "b").collect()} == {0}
    assert seen and all("Broadcast" not in plan(df) for df in seen)


def test_jaccard_edges(spark, docs):
    empty = docs([])
    assert jaccard_join.jaccard_components(empty).count() == 0
    rows = jaccard_join.jaccard_components(docs([(4, "q w e r t y"), (4, "q w e r t y"), (None, "q w e r t y"), (9, None)]))
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([(4, 2, 4), (4, 2, 4), (None, 2, None), (9, 0, 9)], key=str)


@pytest.mark.parametrize("link", [30, 60, 75, 90])
def test_window_bound_of_all_sizes(spark, link):
    """No pair of sizes can share fewer shingles in both windows than each of the two needs."""
    for n in range(1, 160):
        shown, needed = map(int, jaccard_join._window(n, link))
        for m in range(n, 100 * n // link + 1):
            both = -(-link * (n + m) // (100 + link))
            if both <= n:
                other, other_needed = map(int, jaccard_join._window(m, link))
                assert min(shown - n, other - m) + both >= max(needed, other_needed), (n, m)
    sizes = spark.range(1, 400).withColumn("n", F.col("id"))
    for r in sizes.select("n", jaccard_join._needed(F.col("n"), link).alias("needed")).collect():
        assert r.needed == jaccard_join._window(r.n, link)[1]


def test_jaccard_nested_sets(spark, docs):
    """Links of exactly 75 % between a text and its continuation, where either window may lack the shared shingles."""
    pick = np.random.default_rng(5)
    rows = {}
    for small, large, pairs in ((3, 4, 60), (6, 8, 60), (15, 20, 1500)):
        for _ in range(pairs):
            words = [f"w{k}" for k in pick.integers(0, 10**9, large + 4)]
            rows[len(rows)] = " ".join(words[:small + 4])
            rows[len(rows)] = " ".join(words)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs(list(rows.items()))).collect()}
    assert got == jaccard_groups(rows)


# --- exact dedup --------------------------------------------------------------------------------

def test_exact_dedup(spark, docs):
    assert not compare(llm_queries()["op5_exact_dedup"](spark, SF), duck(SF), llm_oracles()["op5_exact_dedup"])
    documents = docs([(3, "a  b"), (2, "a\tb"), (5, None), (4, ""), (7, " "), (8, "x"), (None, "a b"), (9, "É"), (1, "é"),
                      (6, "long " * 100_000), (10, "long " * 100_000)])
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(documents).collect()}
    assert got == {3: (2, 3, False), 2: (2, 3, True), None: (2, 3, False), 5: (4, 2, False), 4: (4, 2, True),
                   7: (7, 1, True), 8: (8, 1, True), 9: (9, 1, True), 1: (1, 1, True), 6: (6, 2, True), 10: (6, 2, False)}
    kept = exact_dedup.keep_first(documents.withColumn("again", F.lit(1)))
    assert {r.doc_id for r in kept.collect()} == {2, 4, 7, 8, 9, 1, 6} and "again" in kept.columns
    assert exact_dedup.exact_groups(docs([])).count() == 0
    full = exact_dedup.exact_groups(spark.read.parquet(f"{SF}/documents.parquet"), max_bytes=1 << 15)
    assert full.count() == 200


def test_bloom_finds_every_repeat(spark):
    codes = spark.range(0, 4000, 1, 7).selectExpr("xxhash64(id % 3900) as code")
    once, twice = bloom.hash_filters(codes, "code", 1 << 15)
    all_codes = np.array([r.code for r in codes.distinct().collect()], np.int64).view(np.uint64)
    repeated = np.array([r.code for r in codes.groupBy("code").count().where("count > 1").collect()], np.int64).view(np.uint64)
    assert bloom.test(once, all_codes).all() and bloom.test(twice, repeated).all()
    assert bloom.test(twice, all_codes).mean() < 0.3


# --- sharding -----------------------------------------------------------------------------------

def test_shards(spark, docs):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    hot = "hot " * 2000
    more = documents.unionByName(docs([(10_000 + k, hot) for k in range(60)])).repartition(6)
    sharded = kd_shards.shard(more)
    plan = sharded._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    got, texts = sharded.toPandas(), {r.doc_id: r.text for r in more.collect()}
    assert set(got.doc_id) == set(texts) and set(got.law) == {"bytes"} and got.grown_shard.isna().all()
    for row in got.itertuples():
        raw = (texts[row.doc_id] or "").encode()
        assert (row.size, row.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    for _, mine in got.groupby("shard"):
        assert sorted(mine.slot) == list(range(len(mine)))
    assert got.assign(text=got.doc_id.map(texts)).groupby("text").shard.nunique().max() == 1
    sizes = got.groupby("shard")["size"].sum()
    alone = got[got.doc_id >= 10_000].shard.iloc[0]
    rest = sizes.drop(alone)
    largest = got[got.shard != alone]["size"].max()  # a cut can miss its goal by half of the group it falls on
    assert len(sizes) == 16 and rest.max() - rest.mean() < largest and rest.mean() - rest.min() < largest


def test_shard_edges(spark, docs):
    few = kd_shards.shard(docs([(1, "a"), (2, "a"), (None, None), (4, ""), (4, "")])).toPandas()
    assert len(few) == 5 and few[few.text_crc32 == 0].shard.nunique() == 1 and few.shard.between(0, 15).all()
    assert kd_shards.shard(docs([])).count() == 0


# --- packing ------------------------------------------------------------------------------------

def test_packing_keeps_every_id(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    tokenizer.encode_special_tokens = True
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    edge = docs([(-1, None), (-2, ""), (-3, "It's we'll THE.'s “.x é.é, ×.÷ $5 12,345 <|endoftext|> \x1cа́ Σ.ab İ"),
                 (-4, "word. " * 30_000)], "doc_id long, text string")
    both = documents.unionByName(edge)
    pieces = packing.pack(both.withColumn("length", F.lit("clash"))).toPandas()
    texts = {r.doc_id: r.text or "" for r in both.collect()}
    names = list(texts)
    encoded = dict(zip(names, tokenizer.encode_batch([texts[n] for n in names], add_special_tokens=False)))
    assert set(pieces.doc_id) == set(texts)
    for doc, mine in pieces.sort_values("start").groupby("doc_id"):
        want = np.array([*encoded[doc].ids, 1], "<u4")
        assert b"".join(mine.ids) == want.tobytes() and set(mine.doc_tokens) == {len(want)}
        assert (mine.start == mine.length.cumsum() - mine.length).all()
        assert [zlib.crc32(i) for i in mine.ids] == list(mine.ids_crc32)
    windows = pieces.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert (windows.length.cumsum() - pieces.length == pieces.offset).all()
    total = windows.length.sum()
    assert total.max() <= 2048 and total.sum() / (2048 * len(total)) > 0.97
    assert packing.pack(docs([])).count() == 0


def test_differencing():
    pick = np.random.default_rng(4)
    for _ in range(30):
        sizes = pick.integers(1, 512, int(pick.integers(1, 200))).tolist()
        windows = packing.fitted(sizes, 2048)
        assert sorted(k for w in windows for k in w) == list(range(len(sizes)))
        sums = [sum(sizes[k] for k in w) for w in windows]
        assert max(sums) <= 2048
        if len(sizes) > 8 * len(windows):
            assert max(sums) - min(sums) < 64
    assert packing.balanced([], 3) == [[], [], []]
    assert sorted(map(len, packing.balanced([5, 5, 5, 5], 2))) == [2, 2]


def test_word_memory_is_bounded(monkeypatch):
    from martloom.llm import word_tokens

    monkeypatch.setattr(word_tokens, "CACHE_WORDS", 10)
    words = WordTokens(packing.TOKENIZER)
    first = words.ids_of([b"alpha", b"beta"])
    for k in range(30):
        words.ids_of([f"w{k}".encode()])
    assert words.ids_of([b"alpha", b"beta"]) == first and len(words.now) + len(words.before) < 20


def test_known_words_end_no_generation(monkeypatch):
    """Only new words fill the memory: words met again and again make it forget nothing."""
    from martloom.llm import word_tokens

    monkeypatch.setattr(word_tokens, "CACHE_WORDS", 10)
    words = WordTokens(packing.TOKENIZER)
    some = [b"alpha", b"12,5", "été".encode(), b"x" * 3000]
    first = words.ids_of(some)
    assert first == [
        np.array(words.tokenizer.encode(w.decode(), add_special_tokens=False).ids, "<u4").tobytes() for w in some]
    for _ in range(3):
        assert words.ids_of(some) == first
    assert set(words.now) == set(some) and not words.before


def want_of(words, text):
    return words.tokenizer.encode(text, add_special_tokens=False).ids


def rows_of_ids(words, texts):
    """Token ids of every text, as lists."""
    out = []
    for first, end, ids, at in words.encode(pa.array([t and t.encode() for t in texts], pa.binary())):
        out += [ids[at[k]:at[k + 1]].tolist() for k in range(end - first)]
    return out


def test_short_words_met_again_are_not_looked_up_singly(monkeypatch):
    """Only words that are new, or too long for the table of short words, are taken one by one."""
    words = WordTokens(packing.TOKENIZER)
    texts = ["the cat sat, on 12 mats; THE CAT", None, "", "a\0 a a\0\0 é.é an-extraordinarilylongword x9x8x7x6x5x4"]
    want = [want_of(words, t or "") for t in texts]
    single, ids_of = [], words.ids_of
    monkeypatch.setattr(words, "ids_of", lambda some: single.extend(some) or ids_of(some))
    assert rows_of_ids(words, texts) == want and b"cat" in single and b"a\0" in single
    single.clear()
    assert rows_of_ids(words, texts) == want
    assert set(single) == {b"extraordinarilylongword", b"x9x8x7x6x5x4"}


@pytest.mark.parametrize("slots", [1, 4, 1 << 10])
def test_words_that_share_a_slot(monkeypatch, slots):
    from martloom.llm import word_tokens

    monkeypatch.setattr(word_tokens, "SLOTS", slots)
    monkeypatch.setattr(textbytes.blocks, "__defaults__", (200,))
    words = WordTokens(packing.TOKENIZER)
    pick = np.random.default_rng(8)
    some = [
        *("abcdefghijklmnopqrstuvwxyz"[:k] for k in range(1, 27)), "abcdefgh\0", "abcdefgh\0\0", "\0", "\0" * 8, "\0" * 15,
        "\0" * 16, "ééééééé", "éééééééé", "eéééééééé", "привет", "приветствие", "日本語", "日本語の文章です", "1234567", "123456789",
        "\u00a0", "it's", "\ue000\ue000\ue000\ue000\ue000"]
    texts = [" ".join(some[k] for k in pick.integers(0, len(some), int(pick.integers(0, 60)))) for _ in range(60)]
    want = [e.ids for e in words.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert rows_of_ids(words, texts) == want
    # A long word whose ids are more than the whole table has room for.
    assert rows_of_ids(words, ["a " + "1" * 50_000 + " b"])[0][1:-1] == want_of(words, "1" * 50_000)
    assert rows_of_ids(words, []) == []


def test_words_of_letters_go_together(monkeypatch):
    """Letters that become two words, or join with others, in lower case or normal form change no other word's ids."""
    from martloom.llm import word_tokens

    words = WordTokens(packing.TOKENIZER)
    some = [
        "plain", "İstanbul", "ΑΣ", "ǅ", "ª", "ﬁn", "ᄀ", "ᅡ", "ᆨ", "가", "ʼn", "ŉ", "日本語", "aª", "ß", "x" * 3000, "é", "Å", "e\u0301",
        "\u00a0", "\u00a0x", "it's", "42", "a1", "<|endoftext|>", "</w>", "𐐀𐐨", "क्षि", "ไทย", "\U000323af\u3400"]
    want = [np.array(want_of(words, w), "<u4").tobytes() for w in some]
    for joined in (1, 2, 3, 256):
        monkeypatch.setattr(word_tokens, "JOINED", joined)
        assert words.encoded([w.encode() for w in some]) == want
    calls, tokenizer = [], words.tokenizer

    class Counted:
        def encode_batch_fast(self, texts, **kw):
            calls.extend(texts)
            return tokenizer.encode_batch_fast(texts, **kw)

    words.tokenizer = Counted()
    words.encoded(["İzmir".encode(), *(f"word{chr(97 + k)}".encode() for k in range(20))])
    assert len(calls) == 2 and "İzmir" in calls


# --- token counts -------------------------------------------------------------------------------

def test_rollup_of_the_corpus(spark):
    documents, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    quality = {r.doc_id: (r.quality, r.toxic) for r in labels.collect()}
    encoding, want = token_rollup._encoding("byte_bpe_50k"), defaultdict(lambda: [0, 0])
    for r in documents.collect():
        good, toxic = quality.get(r.doc_id, (1, 0))
        if not toxic:
            text = r.text if good else re.sub(r"[\x20\x09-\x0D]+", " ", r.text)
            cell = want[r.source, r.lang]
            cell[0] += 1
            cell[1] += len(encoding.encode_ordinary(text))
    got = {(r.source, r.lang): [r.documents, r.tokens] for r in llm_queries()["op9_token_counts"](spark, SF).collect()}
    assert got == dict(want)


def test_rollup_counts_every_row(spark, docs):
    """Rows without id, repeated rows and ids, empty and null texts, other columns; a label reaches all rows of its id."""
    documents = docs([(None, "one two", "en", "a"), (None, "one two", "en", "a"), (1, "x", "en", "a"), (1, "x", "en", "a"),
                      (1, "x  y", "en", "a"), (2, "gone", "en", "b"), (2, "gone too", "en", "b"), (3, None, None, "c"),
                      (4, "", "en", "c"), (5, "z" * 300_000, "de", "c")]).withColumn("sign", F.lit(9)).withColumn("op", F.lit("x"))
    labels = spark.createDataFrame(
        [(1, 0, 0), (2, 1, 1), (2, 1, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    size = lambda *texts: sum(len(token_rollup._encoding("byte_bpe_50k").encode_ordinary(t)) for t in texts)
    got = {(r.source, r.lang): (r.documents, r.tokens) for r in token_rollup.corpus_rollup(documents, labels).collect()}
    assert got == {("a", "en"): (5, size("one two", "one two", "x", "x", "x y")), ("c", None): (1, 0), ("c", "en"): (1, 0),
                   ("c", "de"): (1, size("z" * 300_000))}
    assert token_rollup.corpus_rollup(documents.limit(0), labels).count() == 0
    assert token_rollup.corpus_rollup(documents, labels.limit(0)).agg(F.sum("documents")).first()[0] == 10


def test_rollup_batches(spark):
    def batch(*rows):
        return spark.createDataFrame(
            rows, "op string, doc_id long, source string, lang string, tokenizer string, tokens long")
    rollup = token_rollup.TokenRollup(spark)
    totals = lambda: sorted((tuple(r) for r in rollup.totals().collect()), key=str)
    assert totals() == []
    first = batch(("put", 1, "a", "en", "t", 10), ("put", 2, "a", None, "t", 5), ("put", 1, "a", "en", "t2", 7),
                  ("put", None, "a", "en", "t", 99), ("put", 3, None, "en", "t", None))
    assert rollup.commit("b1", first) and not rollup.commit("b1", first)
    start = totals()
    assert start == sorted([("a", "en", "t", 1, 10), ("a", None, "t", 1, 5), ("a", "en", "t2", 1, 7), (None, "en", "t", 1, 0)], key=str)
    assert rollup.commit("b2", batch(("put", 1, "b", "en", "t", 4), ("delete", 2, None, None, "t", None),
                                     ("delete", 77, None, None, "t", None), ("put", 3, "c", "en", "t", 1), ("put", 3, "c", "en", "t", 2)))
    assert totals() == sorted([("b", "en", "t", 1, 4), ("a", "en", "t2", 1, 7), ("c", "en", "t", 1, 2)], key=str)
    # A batch that died before its commit leaves no trace and can be sent again.
    batch(("put", 8, "z", "en", "t", 1)).write.parquet(f"{rollup.location}/totals/b3")
    assert len(totals()) == 3
    assert rollup.commit("b3", batch(("put", 1, "a", "en", "t", 10), ("delete", 3, None, None, "t", None)))
    assert totals() == sorted([("a", "en", "t", 1, 10), ("a", "en", "t2", 1, 7)], key=str)
    assert rollup.commit("b4", batch()) and len(totals()) == 2


# --- vectors ------------------------------------------------------------------------------------

@pytest.mark.parametrize("block", [2048, 60])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_forest, "BLOCK", block)
    pick = np.random.default_rng(block)
    rows = []
    for label in (0, 1, None):
        vectors = pick.normal(size=(700, 16))
        for k in range(150):  # near copies of the first vectors, many of one
            vectors[300 + k] = vectors[k % 20 if k % 2 else 0] + pick.normal(scale=0.03, size=16)
        vectors[500:520] = vectors[0]
        rows += [(v.astype(np.float32).tolist(), label) for v in vectors]
    rows += [(None, 0), ([], 0), ([0.0] * 16, 0), ([float("nan")] * 16, 1), ([1.0, None] * 8, 1), ([float("inf")] * 16, 1),
             ([2.0, 0.0], 1), ([1.0, 0.0], 1)]
    table = spark.createDataFrame([(k, v, x) for k, (v, x) in enumerate(rows)], "vec_id long, embedding array<float>, label int")
    got = embedding_forest.near_vectors(table.withColumn("kept", F.lit("clash")).repartition(4)).toPandas().set_index("vec_id")
    links, counts = [], defaultdict(int)
    for size in (2, 16):
        for label in (0, 1):
            ids = [k for k, (v, x) in enumerate(rows) if x == label and v and len(v) == size and None not in v
                   and np.isfinite(v).all() and np.any(v)]
            if not ids:
                continue
            matrix = np.array([rows[k][0] for k in ids], float)
            matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
            for a, b in zip(*np.nonzero(matrix @ matrix.T >= 0.98)):
                if a != b:
                    links.append((ids[a], ids[b]))
                    counts[ids[a]] += 1
    true, found = sum(counts.values()), int(got.n_links.sum())
    assert all(got.n_links[k] <= counts[k] for k in got.index) and found >= 0.98 * true > 0
    roots = smallest_reachable(range(len(rows)), links)
    assert np.mean([got.component_id[k] == roots[k] for k in got.index]) > 0.99
    assert (got.kept == (got.index == got.component_id)).all()
    assert embedding_forest.near_vectors(table.limit(0)).count() == 0


def test_recall_on_a_made_table(spark):
    pick = np.random.default_rng(12)
    base = pick.normal(size=(700, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    # Each vector has some near ones, at cosines on both sides of the threshold.
    noise = pick.normal(scale=0.02, size=(5, 700, 64)) * pick.uniform(0.2, 1.6, size=(5, 700, 1))
    vectors = np.concatenate([base, *(base + n for n in noise)])
    table = spark.createDataFrame([(k, v.tolist(), 3) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    found = embedding_forest.near_vectors(table).agg(F.sum("n_links")).first()[0]
    matrix = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = int((matrix @ matrix.T >= 0.98).sum()) - len(matrix)
    assert links > 3000
    assert 0.97 * links <= found <= links


# --- pipeline -----------------------------------------------------------------------------------

def test_pipeline_stages(spark, docs):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    broken = docs([(-1, None), (-2, "12 34")]).withColumn("n_chars", F.lit(0).cast("long"))
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "packing"]
    read = documents.unionByName(broken)
    kept = stages["language"](spark, read, SF)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in read.select("doc_id").subtract(kept.select("doc_id")).collect()} == {-1, -2}
    exact = stages["exact"](spark, kept, SF)
    by_text = defaultdict(list)
    for r in kept.collect():
        by_text[re.sub(r"[\x20\x09-\x0D]+", " ", r.text)].append(r.doc_id)
    assert sorted(r.doc_id for r in exact.collect()) == sorted(min(ids) for ids in by_text.values())
    near = stages["near"](spark, exact, SF)
    groups = jaccard_groups({r.doc_id: r.text for r in exact.collect()})
    assert sorted(r.doc_id for r in near.collect()) == sorted(d for d, (_, root) in groups.items() if d == root)
    packed = stages["packing"](spark, near, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in near.collect()}


def test_stages_decide_on_rows(spark, docs):
    """Null and repeated doc_ids: a row that goes takes no other row with it, and one of equal rows stays."""
    stages = dict(corpus_pipeline.STAGES)
    known = spark.read.parquet(f"{SF}/documents.parquet")
    base = [f"and the thing that is with them and was not here {k}" for k in range(12)]
    long = [" ".join(f"w{k}x{j}" for j in range(60)) for k in range(4)]

    def left(stage, rows):
        return sorted(map(tuple, stages[stage](spark, docs(rows), SF).select("doc_id", "text").collect()), key=str)

    rows = [(None, base[0]), (None, "12 34"), (None, None), (-5, base[1]), (-5, "56"), (-5, base[2]), (-6, base[1]), (-6, base[1])]
    broken = docs(rows).withColumn("n_chars", F.lit(0).cast("long"))
    kept = stages["language"](spark, known.unionByName(broken), SF)
    assert kept.columns == known.columns
    got = [tuple(r) for r in kept.where("doc_id is null or doc_id < 0").select("doc_id", "text").collect()]
    assert sorted(got, key=str) == sorted([rows[k] for k in (0, 3, 5, 6, 7)], key=str)

    rows = [(1, base[0]), (None, base[0]), (None, base[1]), (None, base[2]), (None, base[2]), (7, base[3]), (7, base[3]),
            (7, base[0]), (7, base[4]), (None, None), (8, None), (8, None), (9, base[5].replace(" ", "  ")), (9, base[5]), (9, base[5].replace(" ", "\t"))]
    got = left("exact", rows)
    assert sorted([(d, " ".join((t or "").split())) for d, t in got], key=str) == sorted(
        [(1, base[0]), (None, base[1]), (None, base[2]), (7, base[3]), (7, base[4]), (8, ""), (9, base[5])], key=str)

    near = [text + " more" for text in long]
    rows = [(3, long[0]), (None, near[0]), (None, long[1]), (None, near[2]), (None, long[2]), (5, long[3]), (5, near[3]),
            (5, "quite another text than the others are here"), (2, near[0]), (2, long[1] + " again"), (None, "no link to any other text")]
    got = left("near", rows)
    assert len(got) == 6 and {d for d, t in got if t in (near[2], long[2])} == {None}
    assert {(d, t) for d, t in got if t not in (near[2], long[2], long[3], near[3])} == {
        (2, near[0]), (2, long[1] + " again"), (5, rows[7][1]), (None, rows[10][1])}
    assert sum(t in (long[3], near[3]) for d, t in got if d == 5) == 1
    packed = stages["packing"](spark, docs([(None, "a"), (None, "b"), (1, "c"), (1, "c")]), SF)
    assert sorted((str(r.doc_id), r.start) for r in packed.collect()) == [("1", 0), ("1", 0), ("None", 0), ("None", 0)]


def test_pipeline_runs(spark):
    result = corpus_pipeline.run(spark, SF)
    assert result.count() > 0 and "sequence_id" in result.columns
    assert corpus_pipeline.STAGES[0][1](spark, spark.read.parquet(f"{SF}/documents.parquet").limit(0), SF).count() == 0
    assert language_id.UNKNOWN == "und"


def test_long_words_hash_in_pieces():
    """Words around the length of a piece and of a megabyte: equal bytes give equal hashes, one other byte another one."""
    random = np.random.default_rng(5)
    word = random.integers(33, 127, 1 << 20).astype(np.uint8)
    sizes = [1, 255, 256, 257, 511, 512, 513, 1 << 20]
    parts = []
    for size in sizes:
        other = word[:size].copy()
        other[size // 2] ^= 1
        swapped = np.concatenate([word[256:512], word[:256], word[512:size]]) if size >= 512 else word[:size]
        parts += [word[:size], word[:size], other, swapped]
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    h = textbytes.hash_spans(np.concatenate(parts), starts, ends).reshape(-1, 4)
    assert (h[:, 0] == h[:, 1]).all() and (h[:, 0] != h[:, 2]).all()
    assert [bool(a != b) for a, b in zip(h[:, 0], h[:, 3])] == [size >= 512 for size in sizes]
    assert len(set(h[:, 0].tolist())) == len(sizes)


def test_long_words_in_the_join(spark):
    """Texts of few very long words: linked like any others, and without a step for each byte."""
    long = "x" * 3_000_000
    words = [f"{i}{long[:200_000]}" for i in range(12)]
    rows = [(1, long), (2, long.upper()), (3, long + "y"), (4, " ".join(words)), (5, " ".join([*words, "more"])), (6, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6}
