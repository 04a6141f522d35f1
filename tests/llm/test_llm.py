"""Operators of clicktide.llm against brute force, on the sf0.01 tables and on small hostile ones."""

import bisect
import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import compare
import corpus_pipeline
from clicktide.llm import (
    bytegrams, ctw, minhash, mixing, packing, quality, queries, revisits, substrings, syncmers, token_counts, tokens, topk,
    wordhash,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, label int, size int"
VOCABULARY = "the of and to in was he she it on at by from with a lamp river stone light under over".split()


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) + rng.choice(["", "", ","]) for _ in range(n))


@pytest.fixture(scope="module")
def hostile(spark):
    """Nulls, blanks, a long text, near and exact copies, repeated rows, clashing column names."""
    base = prose(120, 1)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    rows = [
        (1, base, "en", "a"), (2, near, "en", "a"), (3, base, None, "b"), (3, base, None, "b"), (4, None, "en", "c"),
        (5, "", "de", None), (6, " \t\n ", "de", None), (7, "word", "de", "b"), (8, "WORD", "de", "b"),
        (None, prose(50, 2), "en", "a"), (9, prose(20_000, 3), "en", "a"), (10, "日本語 テキスト é", "ja", "ü"),
        (11, "x" * 5000, "en", "a"), (12, base + " " + base, "en", "d"), (13, "one two three four", "fr", "d"),
    ]
    return spark.createDataFrame(
        [(i, t, la, s, None if t is None else len(t), "clash", 1, 7) for i, t, la, s in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{compare.TABLES_DIR}/documents.parquet")


def words_of(text):
    return (text or "").encode().split()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    got = queries.queries()[name](spark, compare.TABLES_DIR)
    want, columns = compare.sql_rows(compare.connect(compare.TABLES_DIR), queries.oracle_sql()[name])
    assert sorted(got.columns) == columns
    assert compare.spark_rows(got) == want


# ---- 1, 2: tokens ----------------------------------------------------------------------------------


def test_encoder_equals_tokenizer():
    coder = tokens.encoder(tokens.vocabulary_path())
    for text in ["", " a  b\n\n c", "déjà vu, l'été", "<|endoftext|> x", "日本 é", "a\x1cb\xa0c", "can't we'll 12.5% ", prose(50, 4)]:
        want = coder.tokenizer.encode(text, add_special_tokens=False)
        assert coder.ids(text).tolist() == want.ids
        assert list(zip(*(s.tolist() for s in coder.spans(text)))) == want.offsets


def test_plain_texts_are_cut_by_one_group_to_the_same_ids():
    """The pattern's parts are not tried one by one before its look-ahead, and texts give the ids of the pattern as it is."""
    import public_tokenizers
    import tiktoken

    coder = tokens.encoder(tokens.vocabulary_path())
    assert tokens.grouped(public_tokenizers.PATTERN).startswith("(?:'s|")
    assert coder.fast._pat_str == tokens.grouped(public_tokenizers.PATTERN)
    assert tokens.grouped("a|b") == "(?:a|b)"
    plain = tiktoken.Encoding(
        "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.fast._mergeable_ranks, special_tokens={})
    letters = [chr(c) for c in [*b"\t\n\r", *range(32, 127), *range(0xa1, 0x250)]]
    rng = random.Random(8)
    for k in range(4000):
        text = "".join(rng.choice(letters if k % 2 else " \n\t\r'sdlabé1²._") for _ in range(rng.randrange(40)))
        assert coder._plain(text)
        assert coder.ids(text).tolist() == plain.encode_ordinary(text)


def test_packing_asks_with_the_heaviest_terms_of_a_seed(spark):
    """Terms are put in order for seeds alone, by falling weight and then by number, as one sort of all of them would."""
    rng = np.random.default_rng(9)
    docs = [np.append(rng.zipf(1.3, rng.integers(0, 200)) % 500, 0).astype("<u4") for _ in range(60)]
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=500)
    corpus = packing.Corpus(60, sum(map(len, docs)), df)
    index = packing.Index(docs, corpus)
    assert (np.diff(index.doc[index.of_doc]) >= 0).all() and index.of_doc.max() < len(index.doc)
    for seed, ids in enumerate(docs):
        terms, tf = np.unique(ids, return_counts=True)
        weights = corpus.weights(terms, tf, len(ids))
        asked = [t for _, t in sorted((-w, t) for w, t in zip(weights, terms) if df[t] > 1)][:packing.QUERY_TERMS]
        scores = np.zeros(60)
        for t in asked:
            held = index.term == t
            scores[index.doc[held]] += index.weight[held]
        found = index.neighbours(seed, np.zeros(60, bool))
        assert set(found) <= set(np.flatnonzero(scores))
        assert len(found) == np.count_nonzero(scores)
        assert scores[found] == pytest.approx(-np.sort(-scores[found]))


@pytest.mark.parametrize("shard_bytes", [packing.SHARD_BYTES, 20_000])
def test_packing_is_whole_and_full(hostile, nothing, shard_bytes):
    pieces = packing.pack_documents(hostile, with_ids=True, shard_bytes=shard_bytes).collect()
    again = packing.pack_documents(hostile, with_ids=True, shard_bytes=shard_bytes).collect()
    assert sorted(map(str, pieces)) == sorted(map(str, again))
    coder = tokens.encoder(tokens.vocabulary_path())
    want = Counter()
    for row in hostile.collect():
        ids = coder.tokenizer.encode(row.text or "", add_special_tokens=False).ids + [0]
        want[row.doc_id] += len(ids)
    got, sequences = Counter(), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length and zlib.crc32(p.ids) == p.ids_crc32
        got[p.doc_id] += p.length
        sequences[p.sequence_id].append(p)
    assert got == want
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == parts[0].sequence_length <= 1024 and at & (at - 1) == 0
    assert packing.pack_documents(nothing).count() == 0


def test_packing_joins_neighbours(spark):
    """Documents on one subject share windows more often than chance would have it."""
    rng = random.Random(5)
    subjects = [[f"{chr(97 + s)}term{k}" for k in range(40)] for s in range(8)]
    rows = [(i, " ".join(rng.choice(subjects[i % 8]) for _ in range(60))) for i in range(160)]
    pieces = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    pairs = Counter()
    by_sequence = defaultdict(set)
    for p in pieces:
        by_sequence[p.sequence_id].add(p.doc_id)
    for ids in by_sequence.values():
        for a in ids:
            for b in ids:
                if a < b:
                    pairs[a % 8 == b % 8] += 1
    assert pairs[True] > pairs[False]


def plain_bm25(texts):
    """Best neighbour of every text by all its terms, over the whole corpus."""
    coder = tokens.encoder(tokens.vocabulary_path())
    docs = [Counter([*coder.ids(x).tolist(), 0]) for x in texts]
    df = Counter(t for d in docs for t in d)
    n, mean = len(docs), sum(sum(d.values()) for d in docs) / len(docs)

    def weight(t, d):
        idf = math.log1p((n - df[t] + 0.5) / (df[t] + 0.5))
        return idf * d[t] * 2.2 / (d[t] + 1.2 * (0.25 + 0.75 * sum(d.values()) / mean))

    weights = [{t: weight(t, d) for t in d} for d in docs]
    best = []
    for i, d in enumerate(docs):
        scores = [sum(w.get(t, 0.0) for t in d) if j != i else -1.0 for j, w in enumerate(weights)]
        best.append(max(scores))
        best[-1] = {j for j, s in enumerate(scores) if s > best[-1] * (1 - 1e-9)}
    return docs, weights, best


def test_packing_shards_hold_the_nearest_neighbours(spark):
    """With ten shards and more, documents lie in one shard with their best neighbour of the whole corpus far more often
    than by chance (0.60 against 0.06 when this was written)."""
    rng = random.Random(6)
    names = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    subjects = [rng.sample(names, 4) for _ in range(60)]
    texts = [" ".join(rng.choice(subjects[i % 60]) if rng.random() < 0.4 else rng.choice(VOCABULARY) for _ in range(60))
             for i in range(300)]
    pieces = packing.pack_documents(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), shard_bytes=2500).collect()
    shard = {p.doc_id: p.sequence_id >> 32 for p in pieces}
    assert len(set(shard.values())) >= 10
    docs, weights, best = plain_bm25(texts)
    near = sum(any(shard[j] == shard[i] for j in best[i]) for i in range(300))
    by_chance = sum(Counter(shard.values())[shard[i]] for i in range(300)) / 300 / 300
    assert near / 300 > max(0.5, 6 * by_chance)


def test_packing_weights_and_order_equal_plain_bm25(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choice(VOCABULARY + [f"n{k}" for k in range(30)]) for _ in range(rng.randrange(5, 60))) for _ in range(40)]
    docs, weights, _ = plain_bm25(texts)
    corpus = packing.corpus_of(spark.createDataFrame(list(enumerate(texts)), "doc_id long, _text string").mapInArrow(
        packing._encoded(tokens.vocabulary_path()), packing.ENCODED))
    ids = [np.append(tokens.encoder(tokens.vocabulary_path()).ids(t), np.uint32(0)) for t in texts]
    index = packing.Index(ids, corpus)
    for term, doc, weight in zip(index.term, index.doc, index.weight):
        assert weight == pytest.approx(weights[doc][int(term)])
    used = np.zeros(40, bool)
    used[:3] = True
    query = sorted((t for t in docs[0] if corpus.df[t] > 1), key=lambda t: (-weights[0][t], t))[:packing.QUERY_TERMS]
    scores = {j: sum(weights[j].get(t, 0.0) for t in query) for j in range(3, 40)}
    found = index.neighbours(0, used).tolist()
    assert set(found) == {j for j, s in scores.items() if s > 0}
    assert [round(scores[j], 9) for j in found] == sorted((round(scores[j], 9) for j in found), reverse=True)


def test_token_counts_add_up(hostile, nothing):
    rows = token_counts.count_tokens(hostile).collect()
    coder = tokens.encoder(tokens.vocabulary_path())
    texts = defaultdict(list)
    for row in hostile.collect():
        texts[row.doc_id].append(row.text or "")
    got = Counter()
    for row in rows:
        got[row.doc_id] += row.n_tokens
    for i, own in texts.items():
        assert got[i] == sum(len(coder.tokenizer.encode(t, add_special_tokens=False).ids) for t in own)
    assert token_counts.count_tokens(nothing).count() == 0


def test_tokens_across_boundaries_follow_the_rule(spark):
    text = "alpha beta, déjà vu\ngamma 123456"
    sections = [("x", 0, 8), ("y", 8, 15), ("y2", 12, 16), ("z", 20, 99)]
    column = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(s).alias("start"), F.lit(e).alias("end")) for n, s, e in sections])
    rows = token_counts.count_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string"), column).collect()
    disjoint = [(0, 8), (8, 15), (15, 16), (20, len(text))]
    want = Counter()
    for s, e in tokens.encoder(tokens.vocabulary_path()).tokenizer.encode(text, add_special_tokens=False).offsets:
        shared = [min(e, b) - max(s, a) for a, b in disjoint]
        want[shared.index(max(shared)) if max(shared) > 0 else -1] += 1
    assert {r.section: r.n_tokens for r in rows if r.n_tokens} == dict(want)


# ---- 3, 10: models ---------------------------------------------------------------------------------


def test_byte_grams():
    keys, lengths = bytegrams.keys_of([b"ab", b"", b"c"])
    assert lengths.tolist() == [3, 1, 2]
    full = bytes([255]) * bytegrams.CONTEXT
    want = []
    for text in [b"ab", b"", b"c"]:
        data = full + text + b"\xff"
        for i in range(len(text) + 1):
            context = data[i:i + bytegrams.CONTEXT][::-1]
            want.append(int.from_bytes(context + data[i + bytegrams.CONTEXT:i + bytegrams.CONTEXT + 1], "big"))
    assert keys.tolist() == want


def test_context_tree_by_recursion():
    """Weights and mixtures against the recursion of the method, node by node."""
    texts = [b"abracadabra abra", b"cadabra", b""]
    depth = bytegrams.CONTEXT
    counts = defaultdict(lambda: [0, 0])
    for text in texts:
        data = b"\xff" * depth + text + b"\xff"
        for i in range(depth, len(data)):
            for d in range(depth + 1):
                for k in range(8):
                    counts[data[i - d:i], 1 << k | data[i] >> (8 - k)][data[i] >> (7 - k) & 1] += 1
    children = defaultdict(list)
    for context, prefix in counts:
        if context:
            children[context[1:], prefix].append((context, prefix))

    def log_kt(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(node):
        own = log_kt(*counts[node])
        if len(node[0]) == depth:
            return own
        return np.logaddexp(own, sum(weighted(c) for c in children[node])) + math.log(.5)

    def probability(history, byte):
        total = 1.0
        for k in range(8):
            prefix, bit, p = 1 << k | byte >> (8 - k), byte >> (7 - k) & 1, None
            for d in range(depth, -1, -1):
                node = (history[len(history) - d:], prefix)
                if node not in counts:
                    continue
                estimate = (counts[node][bit] + .5) / (sum(counts[node]) + 1)
                w = 1 if p is None else math.exp(math.log(.5) + log_kt(*counts[node]) - weighted(node))
                p = w * estimate + (1 - w) * (p or 0)
            total *= .5 if p is None else p
        return total

    keys, values = bytegrams.counted(texts)
    levels = ctw.levels_of(keys, values)
    level = levels[2]
    parent = ((level.nodes >> np.uint64(16)) << np.uint64(8)) | (level.nodes & np.uint64(255))
    nodes, where = np.unique(parent, return_inverse=True)
    one = ctw.Level(nodes, np.bincount(where, level.zeros), np.bincount(where, level.ones), level.above(nodes))
    root, where = np.unique(nodes & np.uint64(255), return_inverse=True)
    zero = ctw.Level(root, np.bincount(where, one.zeros), np.bincount(where, one.ones), np.bincount(where, one.log_weighted))
    asked, _ = bytegrams.keys_of([b"abrazzz"])
    got = ctw.log_probabilities(asked, {0: zero, 1: one, **levels})
    data = b"\xff" * depth + b"abrazzz" + b"\xff"
    want = [math.log(probability(data[i - depth:i], data[i])) for i in range(depth, len(data))]
    assert np.allclose(got, want)


def test_scores(hostile, nothing, documents):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    for docs, block_bytes in ((hostile, 30_000), (documents, 500_000)):
        rows = ctw.score_documents(docs, held_out, block_bytes=block_bytes).collect()
        texts = docs.select("doc_id", "text").collect()
        assert len(rows) == len(texts)
        low = {chr(c): chr(c + 32) for c in range(65, 91)}
        split = [(r.doc_id, "".join(low.get(c, c) for c in r.text or "").encode().split() + [b"\xff"]) for r in texts]

        def out(i):
            return i is None or zlib.crc32(str(i).encode()) % 10 == 0

        counts = Counter(w for i, ws in split if not out(i) for w in ws)
        n, v = sum(counts.values()), len(counts)
        want = Counter()
        for i, ws in split:
            base = sum(math.log10((counts[w] + .1) / (n + .1 * (v + 1))) for w in ws)
            want[i, out(i), len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 4)] += 1
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows) == want
        assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
    assert ctw.score_documents(nothing, held_out).count() == 0


def test_kneser_ney_sums_to_one():
    texts = [prose(300, s).encode() for s in range(3)]
    keys, counts = bytegrams.counted(texts)
    orders = quality.orders_of(keys, counts)
    grams, before = np.unique(((orders[2].grams >> np.uint64(16)) << np.uint64(8)) | (orders[2].grams & np.uint64(255)), return_counts=True)
    orders[1] = quality.Order(grams, before.astype(float))
    grams, before = np.unique(grams & np.uint64(255), return_counts=True)
    orders[0] = quality.Order(grams, before.astype(float))
    discounts = {m: quality.discounts_of(o.count_of_counts()) for m, o in orders.items()}
    for context in (keys[5], keys[0], np.uint64(0x123456789A00)):
        every = (context >> np.uint64(8) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert math.isclose(np.exp(quality.log_probabilities(every, orders, discounts)).sum(), 1, rel_tol=1e-9)


def test_classifier_keeps_clean_and_drops_noise(spark, hostile, nothing, documents):
    labels = spark.read.parquet(f"{compare.TABLES_DIR}/labels.parquet")
    rows = {r.doc_id: r for r in quality.classify(documents, labels, block_bytes=700_000).collect()}
    assert len(rows) == documents.count()
    known = {r.doc_id: r for r in labels.collect()}
    clean = [rows[i].kept for i, r in known.items() if r.quality == 1 and r.toxic == 0]
    noise = [rows[i].kept for i, r in known.items() if r.quality == 0]
    assert np.mean(clean) > 0.97 and np.mean(noise) < 0.2
    few = spark.createDataFrame([(1, 1, 0), (2, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.classify(hostile, few).count() == hostile.count()
    assert quality.classify(hostile, few.limit(0)).where("kept").count() == hostile.count()
    assert quality.classify(nothing, few).count() == 0


def plain_limits(rows, quantile, slack):
    """Limits by sorted lists: language and length class, leaning on the wider groups by PRIOR documents."""
    def own(values):
        values = sorted(math.floor(math.log(v) / quality.BIN) for v in values)
        middle, high = ((values[math.ceil(q * len(values)) - 1] + 1) * quality.BIN for q in (0.5, quantile))
        return len(values), middle + slack * (high - middle)

    def leaning(values, wider):
        n, limit = own(values) if values else (0, 0.0)
        return (n * limit + quality.PRIOR * wider) / (n + quality.PRIOR)

    aside = [r for r in rows if r[2]]
    of_all = own([r[3] for r in aside])[1]
    out = {}
    for lang, size in {r[:2] for r in rows}:
        wider = max(leaning([r[3] for r in aside if r[0] == lang], of_all),
                    leaning([r[3] for r in aside if r[1] == size], of_all))
        out[lang, size] = math.exp(leaning([r[3] for r in aside if r[:2] == (lang, size)], wider))
    return out


def test_limits_by_brute_force(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["en", "de", None]), rng.choice([0, 1, 1, 1]), rng.random() < 0.5, math.exp(rng.gauss(1.5, 0.3)))
            for _ in range(400)] + [("xx", 7, False, 3.0), ("yy", 1, True, 9.0)]
    frame = spark.createDataFrame(rows, "lang string, _class int, aside boolean, perplexity double")
    got = {(r.lang, r._1): r.limit for r in quality.limits_of(frame, 0.9, 1.3).withColumnRenamed("_class", "_1").collect()}
    want = plain_limits(rows, 0.9, 1.3)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    none = quality.limits_of(frame.withColumn("aside", F.lit(False)), 0.9, 1.3).collect()
    assert none and all(r.limit is None for r in none)


def test_perplexities_by_plain_model(spark):
    """Perplexity under the model of all trusted rows, computed gram by gram in one place."""
    texts = [prose(40, s) for s in range(24)] + ["", None, "xyz" * 20]
    docs = spark.createDataFrame(
        [(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    trusted = spark.createDataFrame([(i,) for i in range(20)], "doc_id long")
    rows = {r.doc_id: r for r in quality.perplexities(docs, trusted, block_bytes=1500).collect()}
    assert {i for i, r in rows.items() if r.trusted} == set(range(20))
    keys, counts = bytegrams.counted([texts[i].encode() for i in range(20) if not rows[i].aside])
    orders = quality.orders_of(keys, counts)
    grams, before = np.unique(quality._shorter(orders[2].grams), return_counts=True)
    orders[1] = quality.Order(grams, before.astype(float))
    grams, before = np.unique(grams & np.uint64(255), return_counts=True)
    orders[0] = quality.Order(grams, before.astype(float))
    discounts = {m: quality.discounts_of(o.count_of_counts()) for m, o in orders.items()}
    for i, text in enumerate(texts):
        own, _ = bytegrams.keys_of([(text or "").encode()])
        logs = quality.log_probabilities(own, orders, discounts)
        assert rows[i].n_symbols == len(own)
        assert rows[i].perplexity == pytest.approx(math.exp(-logs.mean()), rel=1e-5)


# ---- 4: near-dedup ---------------------------------------------------------------------------------


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for n in (1, 3, 40, 700):
        a = rng.integers(0, 2**63, 4 * n, dtype=np.uint64)
        left, right = a[:3 * n], a[n:]
        same = (minhash.sketch(left) == minhash.sketch(right)).mean()
        assert abs(same - 0.5) < 0.2 and (minhash.sketch(left) == minhash.sketch(left[::-1])).all()


def test_near_duplicates_by_brute_force(spark, hostile, nothing):
    rng = random.Random(9)
    base = prose(400, 8).split()
    rows = [(r.doc_id, r.text) for r in hostile.collect()]
    for i in range(100, 400):  # one large group of near copies, at many similarities
        words = list(base)
        for _ in range(rng.randrange(30)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [(i, shingle_set(t)) for i, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for x, (_, a) in enumerate(sets):
        for y, (_, b) in enumerate(sets[:x]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                group[max(find(x), find(y))] = min(find(x), find(y))
    members = defaultdict(list)
    for x in range(len(rows)):
        members[find(x)].append(rows[x][0])
    want = Counter()
    for x, (i, s) in enumerate(sets):
        ids = [j for j in members[find(x)] if j is not None]
        least = min(ids) if ids and s else (i if not s else None)
        want[i, len(s), least, i == least] += 1
    got = minhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert Counter(map(tuple, got)) == want
    assert minhash.near_duplicates(nothing).count() == 0


def test_one_text_arrives_for_each_set_to_confirm(spark, monkeypatch):
    """Null ids, a shared id and repeated rows bring no text twice into a group."""
    rng = random.Random(13)
    rows = []
    for i in range(40):
        words = prose(80, 100 + i).split()
        changed = [*words[:40], f"w{rng.randrange(10**6)}", *words[41:]]
        rows += [(None, " ".join(words)), (None, " ".join(changed)), (7, prose(60, 300 + i)), (None, " ".join(words))]
    arrived, fetch = [], minhash._with_texts

    def counted(needed, *rest):
        out = fetch(needed, *rest)
        arrived.append((out.count(), needed.count()))
        return out

    monkeypatch.setattr(minhash, "_with_texts", counted)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert arrived and all(a == n for a, n in arrived)
    assert len(got) == len(rows) and len({r.component for r in got}) == 80


def test_only_texts_to_confirm_are_shuffled(spark):
    """Whatever their number: others are left out before the join, and the join has one form at all sizes."""
    texts = spark.range(1000).select(
        F.col("id").alias("row_id"), F.concat(F.lit("text "), F.col("id").cast("string")).cast("binary").alias("_text"))
    ids = spark.range(1000).select((F.col("id") + 5000).alias("node"), F.col("id").alias("rep"))
    needed = spark.createDataFrame([(1, 5003), (1, 5004), (2, 5003)], "gid long, node long")
    for repeated in (False, True):
        found = minhash._with_texts(needed, texts, ids, repeated)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert re.search("BroadcastHashJoin.* LeftSemi", plan) and re.search("SortMergeJoin.* Inner", plan)
        assert plan.count("BroadcastHashJoin") == 1
        got = Counter((r.gid, r.node, bytes(r._text)) for r in found.collect())
        assert got == Counter([(1, 5003, b"text 3"), (1, 5004, b"text 4"), (2, 5003, b"text 3")])


# ---- 5: fingerprints -------------------------------------------------------------------------------


def test_fingerprints(spark, hostile, nothing, documents):
    for docs in (documents, hostile):
        rows = docs.select("doc_id", "text").distinct().collect()
        if docs is documents:
            order = sorted(rows, key=lambda r: -r.doc_id)
            want = {}
            for r, following in zip(order, order[1:] + order[:1]):
                cut = len(r.text) // 3
                want[r.doc_id] = hashlib.sha256((r.text[:len(r.text) - cut] + following.text[:cut]).encode()).hexdigest()
        got = syncmers.fingerprints(docs).collect()
        assert len(got) == docs.count()
        prints = {}
        texts = {(r.doc_id, r.text or "") for r in rows}
        by_id = defaultdict(list)
        for i, t in texts:
            by_id[i].append(t)
        for g in got:
            assert 0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1
            if docs is documents:
                assert g.edited_sha256 == want[g.doc_id]
            text = by_id[g.doc_id][0]
            assert g.n_chars == len(text) and prints.setdefault(text, g.fingerprint) == g.fingerprint
        if docs is documents:
            assert np.mean([g.near_edited for g in got]) > 0.4 and np.mean([g.near_next for g in got]) < 0.05
    assert syncmers.fingerprints(nothing).count() == 0


def test_anchors_do_not_depend_on_their_surroundings(spark):
    passage = prose(80, 6)
    docs = spark.createDataFrame([(passage,), ("head of another text " + passage + " and a tail",)], "text string")
    alone, within = ({a.hash for a in r.a} for r in docs.select(syncmers.anchors(F.col("text")).alias("a")).collect())
    assert len(alone) > 20 and alone <= within


def test_likeness_follows_order_and_all_anchors(spark):
    """The longest common order of matched anchors, by plain Python; shared passages count in long texts too."""
    first, second = prose(150, 21), prose(150, 22)
    passage = " ".join(f"shared{i}" for i in range(100))
    far = [" ".join(f"{side}{i}" for i in range(20_000)) for side in "lr"]
    pairs = [
        (first + " " + second, second + " " + first), (first, first + " inserted " + second), (first, first), ("", ""),
        (first, ""), ("same " * 300, "same " * 200), (far[0] + " " + passage, passage + " " + far[1]), ("one", "one two")]
    docs = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    prints = docs.select("i", syncmers.fingerprint(F.col("a")).alias("a"), syncmers.fingerprint(F.col("b")).alias("b"))
    got = {}
    for r in prints.select("*", syncmers.likeness(F.col("a"), F.col("b")).alias("like")).collect():
        where, seen_a, seen_b, tails = {}, Counter(), Counter(), []
        for x in r.b:
            where[x.hash, seen_b[x.hash]] = x.position
            seen_b[x.hash] += 1
        for x in r.a:
            at = where.get((x.hash, seen_a[x.hash]))
            seen_a[x.hash] += 1
            if at is not None:
                n = bisect.bisect_left(tails, at)
                tails[n:n + 1] = [at]
        total = len(r.a) + len(r.b)
        assert r.like == pytest.approx(len(tails) / (total - len(tails)) if total else 1)
        got[r.i] = r.like
    assert got[0] < 0.6 and got[2] == got[3] == 1 and got[4] == 0 and 0 < got[6] < 0.01


# ---- 6: substrings ---------------------------------------------------------------------------------


def test_cover_is_a_difference_cover():
    for i in range(substrings.PERIOD):
        assert any((i + k) % substrings.PERIOD in substrings.COVER and k % substrings.PERIOD in substrings.COVER
                   for k in range(substrings.PERIOD))


def test_tokens_of_texts():
    texts = [b"", b" A  b\n", b"one", b"\t", "É Z\x85x\xa0 y".encode(), b"a a", b"  lead  TRAIL  "]
    spelled, words, sizes = ctw.tokens_of(texts)
    split = [t.lower().split() for t in texts]
    assert spelled == [b" ".join(s) for s in split]
    assert sizes.tolist() == [len(s) + 1 for s in split]
    named, at = {}, 0
    for own in split:
        for word in [*own, None]:
            assert named.setdefault(word, int(words[at])) == int(words[at])
            at += 1
    assert len(set(named.values())) == len(named) and named[None] == int(ctw.END)
    assert [len(x) for x in ctw.tokens_of([])] == [0, 0, 0]


def test_word_hashes(monkeypatch):
    """Equal exactly for equal words, wherever they stand and however the bytes are cut into stretches."""
    rng = random.Random(12)
    pool = [bytes(rng.choice(b"ab\x85\xa0\xc3\xff\x00\x1f") for _ in range(rng.randrange(1, 9))) for _ in range(200)]
    pool += [b"x" * 5000, b"x" * 5001, b"x" * 4999 + b"y"]
    text = b" \t".join(rng.choice(pool) for _ in range(3000)) + b"\x0b\n"
    found = []
    for stretch in (wordhash.STRETCH, 40):
        monkeypatch.setattr(wordhash, "STRETCH", stretch)
        data = np.frombuffer(text, np.uint8)
        starts, ends = wordhash.words_in(data)
        words = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        assert words == text.split()
        found.append(wordhash.hashes_of(data, starts, ends).tolist())
    assert found[0] == found[1]
    assert len(set(zip(words, found[0]))) == len(set(words)) == len(set(found[0]))
    assert [len(x) for x in wordhash.words_in(np.frombuffer(b" \n", np.uint8))] == [0, 0]


@pytest.mark.parametrize("block_bytes", [substrings.BLOCK_BYTES, 20_000])
def test_repeats_by_brute_force(spark, hostile, nothing, block_bytes):
    passage = prose(50, 11)
    extra = [(20 + k, f"{prose(30 + k, 20 + k)} {passage} {prose(10, 40 + k)}") for k in range(12)]
    rows = [(r.doc_id, r.text) for r in hostile.collect()] + extra
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = Counter(tuple(w[i:i + 35]) for _, t in rows for w in [words_of(t)] for i in range(len(w) - 34))
    want = Counter()
    for i, t in rows:
        w = words_of(t)
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if counts[tuple(w[k:k + 35])] > 1:
                gone[k:k + 35] = [True] * 35
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        want[i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    got = substrings.remove_repeats(docs, block_bytes=block_bytes).collect()
    assert Counter(map(tuple, got)) == want
    assert substrings.remove_repeats(nothing).count() == 0


# ---- 7: mixing -------------------------------------------------------------------------------------


def targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        shares = sum(weight[s] for s in names if s not in capped)
        out = {s: 3 * sizes[s] if s in capped else rest * weight[s] / shares for s in names}
        over = {s for s in names if s not in capped and out[s] > 3 * sizes[s]}
        if not over:
            return out
        capped |= over


@pytest.mark.parametrize("which", ["documents", "hostile"])
def test_mixing(request, nothing, which):
    docs = request.getfixturevalue(which)
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(words_of(r.text))
    want = targets(dict(sizes))
    got = mixing.mix(docs, block_words=16).collect()
    assert Counter(map(str, got)) == Counter(map(str, mixing.mix(docs.repartition(5), block_words=16).collect()))
    assert Counter((g.doc_id, g.size) for g in got) == Counter((r.doc_id, len(words_of(r.text))) for r in rows)
    assert all(0 <= g.taken <= 3 * g.size for g in got)
    by_target = Counter()
    for g in got:
        by_target[g.source_size, round(g.target, 6)] += g.taken
    expected = Counter()
    for s, target in want.items():
        expected[sizes[s], round(target, 6)] += target
    for key, taken in by_target.items():
        assert abs(taken - expected[key]) <= len(want)
    mixed = mixing.mixed_documents(docs, block_words=16)
    assert mixed.columns == docs.columns
    assert sum(len(words_of(r.text)) for r in mixed.collect()) == sum(g.taken for g in got)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


def test_slots_are_made_by_several_tasks(spark):
    sources = spark.createDataFrame(
        [("a", 0, 10_000_000, 9e6), ("b", 1, 10_000_000, 11e6)], "source string, source_no long, source_size long, target double")
    made = mixing.slots(sources).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(made) >= 2 and max(r["count"] for r in made) < 0.7 * sum(r["count"] for r in made)


def test_permutation(spark):
    for n in (1, 2, 7, 100):
        rows = spark.range(n).select("id", mixing.permuted(F.col("id"), F.lit(n), F.lit(3)).alias("p")).withColumn(
            "back", mixing.permuted(F.col("p"), F.lit(n), F.lit(3), inverse=True)).collect()
        assert sorted(r.p for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)


def test_longest_rise_equals_plain_patience(spark):
    rng = random.Random(12)
    orders = [[]]
    for _ in range(200):
        order = list(range(rng.randrange(1, 40)))
        for _ in range(rng.randrange(4)):
            i, j, k = sorted(rng.randrange(len(order) + 1) for _ in range(3))
            order = order[:i] + order[j:k] + order[i:j] + order[k:]
        if rng.random() < .3:
            rng.shuffle(order)
        orders.append(order)
    rows = spark.createDataFrame(list(enumerate(orders)), "i int, ranks array<int>")
    for r in rows.select("i", syncmers._longest_rise(F.col("ranks")).alias("n")).collect():
        tails = []
        for x in orders[r.i]:
            at = bisect.bisect_left(tails, x)
            tails[at:at + 1] = [x]
        assert r.n == len(tails)


def test_long_near_copies_cost_steps_for_their_edits(spark):
    """80 000 words with another first line, and with moved halves and 800 edits: quadratic work would take minutes."""
    rng = random.Random(13)
    base = [f"w{rng.randrange(50_000)}" for _ in range(80_000)]
    edited = [w if i % 100 else f"edit{i}" for i, w in enumerate(base)]
    texts = [base, [f"x{i}" for i in range(8)] + base[8:], edited[20_000:] + edited[:20_000]]
    docs = spark.createDataFrame([(" ".join(texts[0]), " ".join(t)) for t in texts[1:]], "a string, b string")
    started = time.monotonic()
    got = [r[0] for r in docs.select(
        syncmers.fingerprint(F.col("a")).alias("a"), syncmers.fingerprint(F.col("b")).alias("b")
    ).select(syncmers.likeness(F.col("a"), F.col("b"))).collect()]
    assert time.monotonic() - started < 60
    assert got[0] > 0.999 and 0.5 < got[1] < 0.6


# ---- 8: revisits -----------------------------------------------------------------------------------


def test_revisits(spark):
    schema = "record_id long, url string, ts timestamp, status int, headers map<string,string>, digest string, at int"
    t = "2024-01-01 00:00:{:02d}".format
    rows = [
        (1, "http://www.Example.org:80/a/?b=2&a=1#x", t(1), 200, {"etag": '"1"', "content-length": "5"}, "d1"),
        (2, "https://example.org/a?a=1&b=2", t(5), 200, {"etag": '"2"', "vary": "x"}, "d2"),
        (3, "http://user@example.org./a?b=2&a=1", t(4), 304, {"etag": 'W/"1"', "age": "3", "content-length": "0"}, None),
        (4, "http://example.org/a?a=1&b=2", t(9), 304, {"etag": '"1"'}, None),
        (5, "http://example.org/a?a=1&b=2", t(1), 304, {"etag": '"1"'}, None),
        (6, "http://example.org/a?a=1&b=2", t(9), 304, None, None),
        (7, None, t(9), 304, {"etag": '"1"'}, None), (8, "no url", None, 304, {}, None),
        (9, "http://example.org/a?a=1&b=2", t(5), 200, {"last-modified": "m"}, "d9"),
        (10, "http://example.org/a?a=1&b=2", t(8), 304, {"last-modified": "m", "etag": '"7"', "connection": "close"}, None),
    ]
    captures = spark.createDataFrame([(*r, 0) for r in [(*r[:2], None, *r[3:]) for r in rows]], schema)
    times = spark.createDataFrame([(r[0], r[2]) for r in rows], "record_id long, s string")
    captures = captures.drop("ts").join(times, "record_id").withColumn("ts", F.to_timestamp("s"))
    got = {r.record_id: r for r in revisits.resolve(captures).collect()}
    assert {i: (r.outcome, r.response_id, r.digest) for i, r in got.items()} == {
        3: ("resolved", 1, "d1"), 4: ("no_validator", 9, None), 5: ("no_response", None, None), 6: ("no_validator", 9, None),
        7: ("no_response", None, None), 8: ("no_response", None, None), 10: ("resolved", 9, "d9")}
    assert got[3].headers == {"etag": 'W/"1"', "age": "3", "content-length": "5"}
    assert got[10].headers == {"etag": '"7"', "last-modified": "m"}
    assert got[3].url == "example.org/a?a=1&b=2"
    assert revisits.resolve(captures.limit(0)).count() == 0


def test_revisits_in_many_cells(spark, monkeypatch):
    """A hot URL over many cells resolves as in one, and no cell grows with it."""
    rng = random.Random(3)
    rows = [(i, "http://hot/" if i % 3 else f"http://h{i % 7}/", rng.randrange(500), 200 if rng.random() < .3 else 304) for i in range(900)]
    captures = spark.createDataFrame(rows, "record_id long, url string, s long, status int").select(
        "record_id", "url", F.timestamp_seconds("s").alias("ts"), "status",
        F.create_map(F.lit("etag"), F.lit("e")).alias("headers"), F.lit("d").alias("digest"))
    monkeypatch.setattr(revisits, "CELL_ROWS", 40)
    cells = revisits._in_cells(captures.select("url", F.unix_micros("ts").alias("at"))).groupBy("url", "_cell").count()
    hot = cells.where("url = 'http://hot/'").agg(F.count("*"), F.max("count")).first()
    assert hot[0] >= 10 and hot[1] <= 120
    got = {r.record_id: r.response_id for r in revisits.resolve(captures).collect()}
    for i, url, at, status in rows:
        if status == 304:
            before = [(b, j) for j, u, b, s in rows if s == 200 and u == url and b < at]
            assert got[i] == (max(before)[1] if before else None)


def test_revisits_of_one_or_no_record_id(spark):
    """Revisits that share a record_id, or have none, get each the response of their own URL and time."""
    rows = [(1, "http://a/", 1, 200, "1"), (1, "http://b/", 2, 200, "2"), (None, "http://c/", 3, 200, "3"),
            (9, "http://a/", 5, 304, "1"), (9, "http://b/", 5, 304, "2"), (9, "http://b/", 1, 304, "2"),
            (None, "http://a/", 6, 304, "1"), (None, "http://c/", 6, 304, "3")]
    captures = spark.createDataFrame(rows, "record_id long, url string, s long, status int, e string").select(
        "record_id", "url", F.timestamp_seconds("s").alias("ts"), "status",
        F.create_map(F.lit("etag"), F.col("e")).alias("headers"), F.concat(F.lit("d"), "e").alias("digest"))
    got = Counter((r.record_id, r.url, r.response_id, r.outcome, r.digest) for r in revisits.resolve(captures).collect())
    assert got == Counter([
        (9, "a/", 1, "resolved", "d1"), (9, "b/", 1, "resolved", "d2"), (9, "b/", None, "no_response", None),
        (None, "a/", 1, "resolved", "d1"), (None, "c/", None, "resolved", "d3")])


# ---- 9: top-k --------------------------------------------------------------------------------------


@pytest.mark.parametrize("scale", [1.0, 1e7, 1e14])
def test_top_k(spark, monkeypatch, scale):
    rng = np.random.default_rng(2)
    vectors = [(int(i), [float(x) for x in v]) for i, v in enumerate(np.round(rng.normal(size=(400, 8)), 1) * scale)]
    vectors += [(7, vectors[7][1]), (500, None), (501, [1.0, None]), (502, [float("nan")] * 8), (503, [1.0, 2.0]),
                (504, [3.0, 1.0]), (None, vectors[3][1]), (506, []), (507, [float("inf")] * 8)]
    monkeypatch.setattr(topk, "SHARD_ROWS", 150)
    monkeypatch.setattr(topk, "QUERY_ROWS", 10)
    docs = spark.createDataFrame([(i, v, "clash") for i, v in vectors], "vec_id long, embedding array<double>, score string")
    got = defaultdict(list)
    for r in topk.top_k(docs, F.col("vec_id") % 7 == 0, k=5).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    valid = [(i, [math.floor(64 * x) for x in v]) for i, v in vectors
             if v is not None and None not in v and all(map(math.isfinite, v))]
    for q, (i, v) in enumerate(valid):
        if i is None or i % 7:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for c, (j, w) in enumerate(valid)
                        if c != q and len(w) == len(v))[:5]
        want = [(n + 1, None if none else j, -s) for n, (s, none, j) in enumerate(scores)]
        if scale < 1e14:
            assert sum(Counter(got[i]).get(x, 0) for x in want) >= len(want)
    assert topk.top_k(docs.limit(0), F.col("vec_id") % 7 == 0).count() == 0


# ---- pipeline --------------------------------------------------------------------------------------


def test_pipeline_stages(spark, hostile, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "minhash_near_dedup", "substring_dedup", "source_mixing", "retrieval_packing"]
    few = documents.where("doc_id < 150")
    for docs in (few, hostile.select(*documents.columns)):
        stage = docs
        for name, function in corpus_pipeline.STAGES[:-1]:
            before = stage.count()
            stage = function(
                spark, stage, compare.TABLES_DIR)
            rows = stage.collect()
            stage = spark.createDataFrame(rows, documents.schema)
            assert stage.columns == documents.columns
            if name in ("quality_classifier", "minhash_near_dedup"):
                assert len(rows) <= before
            if name == "substring_dedup":
                assert len(rows) == before
        assert corpus_pipeline.retrieval_packing(spark, stage, compare.TABLES_DIR).count() > 0


def test_near_dedup_stage_keeps_one_of_a_group(spark, hostile, documents):
    rows = corpus_pipeline.minhash_near_dedup(spark, hostile.select(*documents.columns), compare.TABLES_DIR).collect()
    ids = Counter(r.doc_id for r in rows)
    assert ids[1] == 1 and not ids[2] and not ids[3]
    assert ids[4] == ids[5] == ids[6] == 1
