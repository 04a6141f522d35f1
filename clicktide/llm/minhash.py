"""MinHash near-dedup with fast similarity sketching, banding and exact verification.

Sketch: T coordinates. In round r < T every shingle is thrown into the bin its r-th hash names; a bin keeps the least
value of the first round that reaches it. Bins still empty after T rounds get all shingles, one bin per round, so
every coordinate is filled. The share of equal coordinates is concentrated around the Jaccard similarity.

Banding: BANDS bands of ROWS coordinates; a pair at similarity 0.75 shares no band with probability
(1 - 0.75 ** 4) ** 32 = 5e-6, no bucket is capped.

1. In every bucket each set is paired with the bucket's least set (a star: linear in the bucket's size).
2. Pairs that the sketches put far below the threshold are dropped (5 standard deviations); the others are confirmed
   on the full shingle sets, and confirmed links are merged to components.
3. Buckets that still hold several components compare, by sketch and in tiles of bounded size, their sets across
   components; what passes is confirmed and merged as before. Sets already connected need no further links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.exchange import WordHashes, mix, small, written

SHINGLE = 5
PERCENT = 75
ROWS, BANDS = 4, 32
T = ROWS * BANDS
# Least equal coordinates for a pair to be confirmed on full sets.
LEAST_EQUAL = int(T * (PERCENT / 100 - 5 * (0.75 * 0.25 / T) ** 0.5))
# Sets of a bucket that one task compares with as many others.
TILE = 1024
MEMBERS_PER_HUB = 64
# Keys of texts to confirm that may be broadcast; joined by shuffle beyond.
BROADCAST_ROWS = 1_500_000
SKETCHED = "doc_id long, row_id long, n_shingles long, node long, bands array<long>, sketch binary"

_ROUND_SEEDS = mix(np.arange(1, 2 * T + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mix(np.arange(100, 100 + SHINGLE, dtype=np.uint64)) | np.uint64(1)
_ROW_FACTORS = mix(np.arange(200, 200 + ROWS, dtype=np.uint64)) | np.uint64(1)
_LOW = np.uint64((1 << 48) - 1)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of five words; of the whole sequence if shorter."""
    words = hashes.of(text.lower().split())
    n = len(words)
    if n == 0:
        return words
    if n < SHINGLE:
        return mix(np.array([np.dot(words, _FACTORS[:n]) + np.uint64(n)], np.uint64))
    total = np.zeros(n - SHINGLE + 1, np.uint64)
    for k in range(SHINGLE):
        total += words[k:n - SHINGLE + 1 + k] * _FACTORS[k]
    return np.unique(mix(total))


def sketch(elements: np.ndarray) -> np.ndarray:
    """T coordinates of a set of one element at least: round in the high bits, value below."""
    out = np.full(T, _EMPTY, np.uint64)
    n = len(elements)
    step = max(1, min(T, 1500 // n))
    for first in range(0, T, step):
        rounds = np.arange(first, min(first + step, T))
        x = mix(elements[None, :] ^ _ROUND_SEEDS[rounds][:, None])
        bins = ((x >> np.uint64(32)) * np.uint64(T)) >> np.uint64(32)
        values = (x & _LOW) | (rounds.astype(np.uint64)[:, None] << np.uint64(48))
        np.minimum.at(out, bins.ravel().astype(np.int64), values.ravel())
        if (out != _EMPTY).all():
            return out
    for b in np.flatnonzero(out == _EMPTY):
        out[b] = (mix(elements ^ _ROUND_SEEDS[T + b]) & _LOW).min() | np.uint64((int(T + b)) << 48)
    return out


def node_of(elements: np.ndarray) -> int:
    """64-bit identity of a set."""
    if not len(elements):
        return 0
    total = int(mix(elements ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) + 0x9E37 * len(elements)
    return int(mix(np.array([total & 0xFFFFFFFFFFFFFFFF], np.uint64)).view(np.int64)[0])


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        sizes, nodes, bands, sketches = [], [], [], []
        for text in batch["_text"].to_pylist():
            elements = shingles(text, hashes)
            sizes.append(len(elements))
            nodes.append(node_of(elements))
            if not len(elements):
                bands.append([])
                sketches.append(b"")
                continue
            values = mix(sketch(elements))
            keys = (values.reshape(BANDS, ROWS) * _ROW_FACTORS).sum(axis=1, dtype=np.uint64)
            keys = mix(keys + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            bands.append(keys.view(np.int64))
            sketches.append((values & np.uint64(255)).astype(np.uint8).tobytes())
        yield pa.record_batch({
            "doc_id": batch["doc_id"], "row_id": batch["row_id"], "n_shingles": pa.array(sizes, pa.int64()),
            "node": pa.array(nodes, pa.int64()), "bands": pa.array(bands, pa.list_(pa.int64())),
            "sketch": pa.array(sketches, pa.binary()),
        })


def row_key(docs: DataFrame) -> object:
    """Hash of a row's id and text; repeated rows share it."""
    return F.xxhash64(docs["doc_id"], F.coalesce(docs["text"], F.lit("")))


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches allow the threshold."""
    for batch in batches:
        left, right = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(-1, T) for c in ("sa", "sb"))
        mask = (left == right).sum(axis=1) >= LEAST_EQUAL
        yield pa.record_batch({"a": batch["a"], "b": batch["b"]}).filter(pa.array(mask))


def alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a = sets.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInArrow(_alike, "a long, b long")


def _confirm(key: tuple, rows: pa.Table) -> pa.Table:
    """Links between a group's hub and its members, on full sets."""
    hashes = WordHashes()
    hub, hub_set, members, links = None, None, [], []
    table = zip(rows["node"].to_pylist(), rows["hub"].to_pylist(), rows["_text"].to_pylist())
    for node, hub_of, text in table:
        elements = shingles(text, hashes)
        if node_of(elements) != node:
            continue  # another row with the same row_id
        if node == hub_of:
            hub, hub_set = node, elements
        else:
            members.append((node, elements))
    for node, elements in members:
        if hub_set is None:
            break
        common = len(np.intersect1d(hub_set, elements, assume_unique=True))
        if 100 * common >= PERCENT * (len(hub_set) + len(elements) - common):
            links.append(node)
    return pa.table({"a": pa.array([hub] * len(links), pa.int64()), "b": pa.array(links, pa.int64())})


def confirmed(pairs: DataFrame, texts: DataFrame, ids: DataFrame, repeated: bool) -> DataFrame:
    """The pairs (a, b) that are links on full sets. Each hub a is copied once per MEMBERS_PER_HUB members."""
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS_PER_HUB).alias("_n"))
    dealt = pairs.join(groups, "a").select(
        "a", "b", F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("_n"))).alias("gid"))
    needed = (dealt.select("gid", F.col("a").alias("hub"), F.col("b").alias("node"))
              .unionByName(dealt.select("gid", F.col("a").alias("hub"), F.col("a").alias("node")).distinct()))
    return _with_texts(needed, texts, ids, repeated).groupBy("gid").applyInArrow(_confirm, "a long, b long").distinct()


def _with_texts(needed: DataFrame, texts: DataFrame, ids: DataFrame, repeated: bool) -> DataFrame:
    """Rows (gid, node, ...), each with one text of the node: that of its smallest row_id."""
    needed = written(needed.join(ids, "node").withColumnRenamed("rep", "_rep"), "to-confirm")
    # Texts that nobody asks for, most of them, are left out before the shuffle.
    wanted = small(needed.select("_rep").distinct(), BROADCAST_ROWS)
    once = texts.select("row_id", "_text").join(wanted, F.col("row_id") == F.col("_rep"), "left_semi")
    if repeated:
        once = once.groupBy("row_id").agg(F.first("_text").alias("_text"))
    # Rows of ``needed`` may hold a tile's partners, so their number says nothing of their size: always by shuffle.
    return once.join(needed.hint("merge"), F.col("row_id") == F.col("_rep")).drop("row_id", "_rep")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node reachable, for every node of a link."""
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_b"))
        .select("node", F.least("node", "_b").alias("label")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("_near")))
        step = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("_old"), F.least("label", "_near").alias("_new"))
        jump = labels.select(F.col("node").alias("_new"), F.col("label").alias("_far"))
        new = written(step.join(jump, "_new").select("node", "_old", F.least("_new", "_far").alias("label")), "labels")
        if not new.where("_old <> label").limit(1).count():
            return new.select("node", "label")
        labels = new.select("node", "label")


_PARTNERS = "gid long, node long, partners array<long>"


def _tiles(key: tuple, rows: pa.Table) -> pa.Table:
    """What to confirm of one tile (left and right parts of a bucket): sets of other components, if sketches allow.

    A pair belongs to the first bucket that it shares, so it comes up in one tile only.
    """
    bucket, p, q = (k.as_py() if hasattr(k, "as_py") else int(k) for k in key)
    node, side, label = (rows[c].to_numpy() for c in ("node", "side", "label"))
    codes = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(-1, T)
    bands = rows["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    within = not len(right)
    partners: dict[int, list[int]] = {}
    for i in left:
        others = left[left > i] if within else right
        others = others[label[others] != label[i]]
        hits = others[(codes[others] == codes[i]).sum(axis=1) >= LEAST_EQUAL]
        if not len(hits):
            continue
        shared = bands[hits] == bands[i]
        first = bands[i][np.argmax(shared, axis=1)]
        hits = hits[shared.any(axis=1) & (first == bucket)]
        if len(hits):
            partners.setdefault(int(node[i]), []).extend(node[hits].tolist())
    for own in list(partners.values()):
        for other in own:
            partners.setdefault(other, [])
    gid = int(mix(np.array([bucket & 0xFFFFFFFFFFFFFFFF ^ (p << 20 | q)], np.uint64)).view(np.int64)[0])
    return pa.table({
        "gid": pa.array([gid] * len(partners), pa.int64()), "node": pa.array(list(partners), pa.int64()),
        "partners": pa.array(list(partners.values()), pa.list_(pa.int64()))})


def _open_tiles(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Of each bucket that holds several components: the sets to confirm, each once per tile with its partners there."""
    labelled = members.join(labels, "node", "left").select(
        "bucket", "node", F.coalesce("label", "node").alias("label"))
    still_open = labelled.groupBy("bucket").agg(
        F.min("label").alias("_low"), F.max("label").alias("_high"), F.ceil(F.count("*") / TILE).alias("_n")
    ).where("_low <> _high")
    rows = (labelled.join(still_open.select("bucket", "_n"), "bucket")
            .join(sets, "node")
            .withColumn("_part", F.pmod(F.xxhash64("node", "bucket"), F.col("_n"))))
    # Part p meets every part q >= p once: as the left side of (p, q) and the right side of (q, p).
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))
    tiles = rows.select("*", other.alias("_other")).select(
        "bucket", "node", "label", "sketch", "bands",
        F.least("_part", "_other").alias("_p"), F.greatest("_part", "_other").alias("_q"),
        F.when(F.col("_part") <= F.col("_other"), 0).otherwise(1).alias("side"))
    return tiles.groupBy("bucket", "_p", "_q").applyInArrow(_tiles, _PARTNERS)


def _confirm_partners(key: tuple, rows: pa.Table) -> pa.Table:
    """Links of one tile on full sets; sets that the tile's links already connect are not compared again."""
    hashes = WordHashes()
    sets: dict[int, np.ndarray] = {}
    group: dict[int, int] = {}

    def find(x: int) -> int:
        while group[x] != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    nodes, texts, partners = (rows[c].to_pylist() for c in ("node", "_text", "partners"))
    for node, text in zip(nodes, texts):
        if node not in sets:
            elements = shingles(text, hashes)
            if node_of(elements) == node:  # else another row with the same row_id
                sets[node], group[node] = elements, node
    links = []
    for node, own in zip(nodes, partners):
        for other in own:
            if node in sets and other in sets and find(node) != find(other):
                a, b = sets[node], sets[other]
                least, most = sorted((len(a), len(b)))
                if 100 * least < PERCENT * most:
                    continue
                common = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * common >= PERCENT * (len(a) + len(b) - common):
                    links.append((node, other))
                    group[find(node)] = find(other)
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: doc_id, row_id, n_shingles, node, component_id, component, kept.

    Words are runs of bytes other than ASCII white space, A-Z in lower case; a row's set are its distinct runs of five
    words, or its one shorter sequence. Rows with 100 * common >= 75 * united shingles are linked; ``component_id``
    is the smallest doc_id that links reach and ``kept`` says whether it is the row's own. Rows without words (null,
    empty or blank text) are linked with nothing. Repeated rows are one set. Null ids count only where a component
    has no other id, and such rows are kept. ``node`` identifies the set, ``component`` the component, ``row_id`` the
    id and text. Other columns are ignored; an empty table gives an empty result.
    """
    texts = docs.select("doc_id", row_key(docs).alias("row_id"), F.coalesce("text", F.lit("")).cast("binary").alias("_text"))
    all_rows = written(texts.mapInArrow(_sketched, SKETCHED), "sketches")
    rows = all_rows.where("n_shingles > 0")
    ids = rows.groupBy("node").agg(F.min("row_id").alias("rep"))
    repeated = rows.groupBy("row_id").count().where("count > 1").limit(1).count() > 0
    sets = written(rows.select("node", "sketch", "bands").dropDuplicates(["node"]), "sets")
    banded = rows.select("node", F.explode("bands").alias("bucket"))
    hubs = (banded.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("_last"))
            .where("hub <> _last").select("bucket", "hub"))
    members = written(banded.join(hubs, "bucket").select("bucket", "node", "hub"), "buckets")
    stars = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = written(confirmed(written(alike(stars, sets), "pairs"), texts, ids, repeated), "confirmed")
    labels = components(links)
    rest = written(_open_tiles(members.select("bucket", "node").distinct(), labels, sets), "tiles")
    if rest.limit(1).count():
        more = _with_texts(rest, texts, ids, repeated).groupBy("gid").applyInArrow(_confirm_partners, "a long, b long")
        links = links.unionByName(written(more, "confirmed"))
        labels = components(links)
    found = all_rows.select("doc_id", "row_id", "n_shingles", "node").join(labels, "node", "left").withColumn(
        "component", F.coalesce("label", "node"))
    least = found.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("_least"))
    return (
        found.join(least, "component", "left")
        .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("_least")).otherwise(F.col("doc_id")))
        .select("doc_id", "row_id", "n_shingles", "node", "component", "component_id",
                F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))
