"""The pipeline's stages on a small folder against plain Python, each on what its predecessor kept."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clicktide.llm import mixing, quality, tokens

SOURCE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The documents of the smallest tables, some of them null, blank, repeated and copied."""
    path = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{SOURCE}/documents.parquet")
    first = docs.orderBy("doc_id").limit(4)
    more = (
        first.withColumn("doc_id", F.col("doc_id") + 10_000)
        .unionByName(first)
        .unionByName(first.limit(1).withColumns({"doc_id": F.lit(20_000).cast("long"), "text": F.lit(None).cast("string")}))
        .unionByName(first.limit(1).withColumns({"doc_id": F.lit(20_001).cast("long"), "text": F.lit(" \n")})))
    docs.unionByName(more.select(docs.columns)).coalesce(2).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SOURCE}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder):
    """Input of the first stage and every stage's rows."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, folder), name)
        frames.append(docs)
    return frames


def rows_of(frame):
    return Counter((r.doc_id, r.text) for r in frame.select("doc_id", "text").collect())


def test_stages_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "minhash_near_dedup", "substring_dedup", "source_mixing", "retrieval_packing"]
    assert all(frame.columns == stages[0].columns for frame in stages[1:-1])


def test_classifier_stage(spark, folder, stages):
    decided = quality.classify(
        stages[0], spark.read.parquet(f"{folder}/labels.parquet"), block_bytes=corpus_pipeline.QUALITY_BLOCK_BYTES).collect()
    kept = {r.doc_id for r in decided if r.limit is None or r.perplexity <= r.limit}
    assert rows_of(stages[1]) == Counter({k: n for k, n in rows_of(stages[0]).items() if k[0] in kept})
    assert 0 < len(kept) < len({r.doc_id for r in decided})


def shingles(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_dedup_stage(stages):
    rows = sorted(rows_of(stages[1]))
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                group[max(find(i), find(j))] = min(find(i), find(j))
    # The least id of a group stays, once; all rows without words stay.
    want = Counter({rows[i]: rows_of(stages[1])[rows[i]] if not sets[i] else 1
                    for i in range(len(rows)) if not sets[i] or find(i) == i})
    assert rows_of(stages[2]) == want
    assert sum(want.values()) < len(rows)


def test_substring_stage(stages):
    rows = rows_of(stages[2])
    words = {k: (k[1] or "").encode().split() for k in rows}
    seen = Counter()
    for k, n in rows.items():
        for i in range(len(words[k]) - 34):
            seen[tuple(words[k][i:i + 35])] += n
    want = Counter()
    for (doc_id, text), n in rows.items():
        own, gone = words[doc_id, text], set()
        for i in range(len(own) - 34):
            if seen[tuple(own[i:i + 35])] > 1:
                gone |= set(range(i, i + 35))
        kept = b" ".join(w for i, w in enumerate(own) if i not in gone).decode() if gone else text
        want[doc_id, kept] += n
    assert rows_of(stages[3]) == want


def test_mixing_stage(stages):
    before, after = stages[3].collect(), stages[4].collect()
    sizes, taken = Counter(), Counter()
    texts = defaultdict(list)
    for r in before:
        sizes[r.source] += len((r.text or "").encode().split())
        texts[r.doc_id].append(r.text)
    for r in after:
        taken[r.source] += len(r.text.encode().split())
        own = " ".join(r.text.split())
        assert any(r.text == t or own in " ".join((t or "").split()) or len(own.split()) < len((t or "").split())
                   for t in texts[r.doc_id])
    sources = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(sources)}
    total, targets, still = sum(sizes.values()), {}, set(sources)
    while True:
        left = total - sum(targets.values())
        share = left / sum(weights[s] for s in still) if still else 0
        over = {s for s in still if share * weights[s] > 3 * sizes[s]}
        if not over:
            break
        targets |= {s: 3 * sizes[s] for s in over}
        still -= over
    targets |= {s: share * weights[s] for s in still}
    for s in sources:
        assert taken[s] == pytest.approx(targets[s], abs=max(2, 0.01 * targets[s]))


def test_packing_stage_and_run(spark, folder, stages):
    coder = tokens.encoder(tokens.vocabulary_path())
    want = Counter()
    for r in stages[4].collect():
        want[r.doc_id] += len(coder.tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1
    for pieces in (stages[5], corpus_pipeline.run(spark, folder)):
        got, sequences = Counter(), defaultdict(list)
        for p in pieces.collect():
            got[p.doc_id] += p.length
            sequences[p.sequence_id].append((p.offset, p.length))
        assert got == want
        for parts in sequences.values():
            ends = 0
            for offset, length in sorted(parts):
                assert offset == ends
                ends += length
            assert ends <= 1024 and math.log2(ends).is_integer()


def test_run_of_nothing(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SOURCE}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
