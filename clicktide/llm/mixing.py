"""Mixing sources to target weights, with DataFrame functions only.

Every source is one stream of words in the order of a hash of its rows, cut into blocks of BLOCK_WORDS. Its target
says how many block slots it fills: whole passes over its blocks and a part of one more, whose last slot is cut so
that the words taken equal the target to the word. Which output shard gets which source is drawn by one pseudorandom
permutation of all slots: every shard's source counts are a multinomial draw, conditioned on the targets being met
over all shards. Within a pass, slot numbers go through the source's own pseudorandom index permutation, and slots and
blocks are joined by (source, index). A permutation is a formula over the index (swap-or-not rounds), so nothing is
sorted or kept, and reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clicktide.llm.exchange import small, written

BLOCK_WORDS = 128
SHARD_SLOTS = 256
WEIGHTS = (1, 2, 3)
MOST = 3  # copies of a source and of a document
SEED = 20260101
ROUNDS = 12
# Rows of a bin of the running sums.
BIN_ROWS = 1000
# Slots are made in chunks, so many a task, in so many tasks at most.
CHUNKS_PER_TASK, MOST_TASKS = 16, 100_000
# Sources (about 100 bytes each) that are broadcast; joined by shuffle beyond.
BROADCAST_SOURCES = 100_000
SPACE = "[ \\t-\\r]+"


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    parts = F.split(text, SPACE)
    edges = F.when(F.element_at(parts, 1) == "", 1).otherwise(0) + F.when(
        (F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return F.coalesce(F.size(parts) - edges, F.lit(0)).cast("long")


def permuted(index: Column, n: Column, seed: Column, inverse: bool = False) -> Column:
    """A pseudorandom permutation of 0 .. n-1: each round pairs every index with one partner and swaps half the pairs."""
    rounds = list(range(ROUNDS))[::-1] if inverse else list(range(ROUNDS))

    def one(at: Column, r: Column) -> Column:
        partner = F.pmod(F.xxhash64(seed, r) - at, n)
        swap = F.xxhash64(seed, r, F.greatest(at, partner), F.lit(SEED)).bitwiseAND(1) == 1
        return F.when(swap, partner).otherwise(at)

    return F.aggregate(F.array(*[F.lit(r) for r in rounds]), index.cast("long"), one)


def source_targets(rows: DataFrame) -> DataFrame:
    """One row per source: number, size, target; targets above MOST sizes are cut and the excess reshared by weight.

    Sources whose cap is least for their weight are cut first: with those before k cut, the others get
    ``(total - their caps) / their weights`` per unit of weight, and k is the first source whose cap is not below that.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.pmod(F.col("source_no"), F.lit(len(WEIGHTS))) + 1).cast("int"))
    numbered = sizes.withColumn("source_no", (F.row_number().over(by_name) - 1).cast("long")).withColumn("weight", weight)
    by_cap = Window.orderBy(F.col("_cap") / F.col("weight"), "source_no")
    everything = Window.partitionBy(F.lit(0))
    shared = (
        numbered.withColumn("_cap", (MOST * F.col("source_size")).cast("double"))
        .withColumn("_before", F.sum("_cap").over(by_cap) - F.col("_cap"))
        .withColumn("_weights", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_total", F.sum(F.col("source_size").cast("double")).over(everything))
        .withColumn("_level", (F.col("_total") - F.col("_before")) / F.col("_weights"))
        .withColumn("_open", F.col("_level") * F.col("weight") <= F.col("_cap"))
        .withColumn("_unit", F.min(F.when(F.col("_open"), F.struct("_before", "_level"))).over(everything)["_level"])
    )
    target = F.least("_cap", F.col("weight") * F.coalesce("_unit", F.lit(float("inf"))))
    return shared.select("source", "source_no", "source_size", target.alias("target"))


def _with_starts(rows: DataFrame) -> DataFrame:
    """First word of every row in its source's stream: sums of bins, then running sums within a bin."""
    n = rows.count()
    bins = max(1, int(n / max(BIN_ROWS, n ** 0.5)))
    binned = rows.withColumn("_bin", F.pmod(F.xxhash64("row_id", F.lit(SEED)), F.lit(bins)))
    of_bin = Window.partitionBy("source_no").orderBy("_bin")
    sums = binned.groupBy("source_no", "_bin").agg(F.sum("size").alias("_words")).withColumn(
        "_first", F.sum("_words").over(of_bin) - F.col("_words")).drop("_words")
    within = Window.partitionBy("source_no", "_bin").orderBy("row_id", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0)
    return binned.withColumn("_own", F.sum("size").over(within) - F.col("size")).join(
        sums, ["source_no", "_bin"]).withColumn("start", F.col("_first") + F.col("_own")).drop("_bin", "_own", "_first")


def slots(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every slot: source_no, block, pass, words (taken from the block's front), shard, slot."""
    length = F.lit(block_words).cast("long")
    size = F.greatest(F.col("source_size"), F.lit(1).cast("long"))  # sources without words get no slots
    plan = (
        sources.withColumn("_words", F.round("target").cast("long"))
        .withColumn("_blocks", F.ceil(size / length).cast("long"))
        .withColumn("_short", size - (F.col("_blocks") - 1) * length)
        .withColumn("_passes", F.floor(F.col("_words") / size).cast("long"))
        .withColumn("_rest", F.col("_words") - F.col("_passes") * size)
        .withColumn("_at", permuted(F.col("_blocks") - 1, F.col("_blocks"), F.xxhash64("source_no", "_passes"), inverse=True))
        .withColumn("_last", F.when(F.col("_rest") <= F.col("_at") * length, F.ceil(F.col("_rest") / length))
                    .when(F.col("_rest") <= F.col("_at") * length + F.col("_short"), F.col("_at") + 1)
                    .otherwise(F.ceil((F.col("_rest") + length - F.col("_short")) / length)).cast("long"))
        .withColumn("_slots", F.col("_passes") * F.col("_blocks") + F.col("_last"))
        .withColumn("_all", F.sum("_slots").over(Window.partitionBy(F.lit(0))))
        .withColumn("_first", F.sum("_slots").over(Window.orderBy("source_no")) - F.col("_slots"))
        .where("_slots > 0")
    )
    chunk = 4096
    # By number, since adaptive execution would merge what a few small rows are dealt to: they grow a thousandfold here.
    total = plan.agg(F.sum(F.floor((F.col("_slots") - 1) / chunk) + 1)).first()[0] or 0
    tasks = min(MOST_TASKS, max(1, -(-int(total) // CHUNKS_PER_TASK)))
    numbers = (
        plan.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_slots") - 1) / chunk))).alias("_chunk"))
        .repartition(tasks, F.col("source_no"), F.col("_chunk"))
        .select("*", F.explode(F.sequence(F.col("_chunk") * chunk, F.least(F.col("_slots"), (F.col("_chunk") + 1) * chunk) - 1)).alias("_j"))
        .withColumn("pass", F.floor(F.col("_j") / F.col("_blocks")).cast("long"))
        .withColumn("_pos", F.col("_j") - F.col("pass") * F.col("_blocks"))
        .withColumn("block", permuted(F.col("_pos"), F.col("_blocks"), F.xxhash64("source_no", "pass")))
        .withColumn("_place", permuted(F.col("_first") + F.col("_j"), F.col("_all"), F.lit(-1)))
    )
    before = F.col("_pos") * length - F.when(F.col("_pos") > F.col("_at"), length - F.col("_short")).otherwise(0)
    words = F.when(F.col("pass") < F.col("_passes"), length).otherwise(F.least(length, F.col("_rest") - before))
    return numbers.select(
        "source_no", "block", "pass", words.alias("words"),
        F.floor(F.col("_place") / SHARD_SLOTS).cast("long").alias("shard"),
        F.pmod(F.col("_place"), F.lit(SHARD_SLOTS)).alias("slot"))


def mixed_rows(docs: DataFrame, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """Rows with their place in their source's stream, and (source_no, start, pass, shard, from, words) of what is taken."""
    rows = written(docs.select(
        "doc_id", "source", F.xxhash64("doc_id", "source", F.coalesce("text", F.lit(""))).alias("row_id"),
        word_count(F.col("text")).alias("size")), "sizes")
    sources = written(source_targets(rows), "sources")
    named = small(sources.withColumnRenamed("source", "_source"), BROADCAST_SOURCES)
    placed = written(_with_starts(rows.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")), "placed")
    length = F.lit(block_words).cast("long")
    end = F.col("start") + F.col("size")
    pieces = placed.where("size > 0").select(
        "source_no", "start", "size",
        F.explode(F.sequence(F.floor(F.col("start") / length), F.floor((end - 1) / length))).alias("block"))
    lower = F.greatest(F.col("start") - F.col("block") * length, F.lit(0).cast("long"))
    upper = F.least(F.col("start") + F.col("size") - F.col("block") * length, F.col("words"))
    # The slots grow with the corpus, however small the table is that they are made from: never broadcast them.
    taken = pieces.join(slots(sources, block_words).hint("merge"), ["source_no", "block"]).where(upper > lower).select(
        "source_no", "start", "pass", "shard", "slot",
        (F.col("block") * length + lower - F.col("start")).alias("from"), (upper - lower).alias("words"))
    return placed, taken


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of ``docs(doc_id, text, source, ...)``: doc_id, size, source_size, target, taken, n_shards.

    Sizes are words (runs of characters other than ASCII white space). Sources in the order of their code points, null
    last and one of its own, weigh 1, 2, 3, 1, ... Together they take as many words as there are; a source takes at
    most three times its size. Rows without words take part with size 0. Repeated rows are documents of their own;
    other columns are ignored; an empty table gives an empty result.
    """
    placed, taken = mixed_rows(docs, block_words)
    sums = taken.groupBy("source_no", "start").agg(
        F.sum("words").alias("taken"), F.count_distinct("shard").alias("n_shards"))
    full = placed.where("size > 0").join(sums, ["source_no", "start"], "left")
    empty = placed.where("size = 0").withColumns({"taken": F.lit(None).cast("long"), "n_shards": F.lit(None).cast("long")})
    zero = F.lit(0).cast("long")
    return full.unionByName(empty).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", zero).alias("taken"),
        F.coalesce("n_shards", zero).alias("n_shards"))


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The columns of ``docs``, one row per document and pass that takes from it.

    A pass that takes a document whole leaves its text as it is; otherwise the text is the taken words joined by one
    space. ``n_chars`` follows the text. Documents not taken, also those without words, are left out.
    """
    placed, taken = mixed_rows(docs, block_words)
    part = F.struct(F.col("from"), F.col("words"))
    copies = taken.groupBy("source_no", "start", "pass").agg(
        F.sort_array(F.collect_list(part)).alias("_parts"), F.sum("words").alias("_taken"))
    chosen = placed.where("size > 0").join(copies, ["source_no", "start"]).select(
        F.col("doc_id").alias("_doc_id"), F.col("row_id").alias("_row_id"), "_parts",
        (F.col("_taken") == F.col("size")).alias("_whole"))
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "source", F.coalesce("text", F.lit(""))))
    if placed.count() != placed.select("doc_id", "row_id").distinct().count():
        keyed = keyed.dropDuplicates(["doc_id", "_key"])  # copies of repeated rows are all in ``chosen``
    joined = keyed.join(chosen, (F.col("_key") == F.col("_row_id")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")))
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    cut = F.transform(F.array(words), lambda ws: F.array_join(F.flatten(F.transform(
        F.col("_parts"), lambda p: F.slice(ws, (p["from"] + 1).cast("int"), p["words"].cast("int")))), " "))[0]
    text = F.when(F.col("_whole"), F.col("text")).otherwise(cut)
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
