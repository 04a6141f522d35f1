"""Document fingerprints from closed syncmers, with DataFrame functions only.

Units are words (cut every UNIT characters, so that text without spaces has units too). Of every run of K = 4 units
the inner runs of S = 2 units are hashed; the run is a closed syncmer if the least of its three inner hashes is its
first or its last. Whether a run is chosen depends on the run alone, so equal passages choose equal anchors wherever
they stand. A fingerprint is all of a text's anchors, each with its position; the likeness of two fingerprints is that
of the anchors that match in consistent order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clicktide.llm.exchange import written

K, S = 4, 2
UNIT = 16
RANGE_ROWS = 20_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once."""
    return F.transform(F.array(value), body)[0]


def _inner(text: Column) -> Column:
    """Hashes of the runs of S units; of the whole text if it has fewer."""
    units = F.regexp_extract_all(text, F.lit(f"[^ \\t-\\r]{{1,{UNIT}}}"), F.lit(0))
    return _let(F.transform(units, lambda u: F.xxhash64(u)), lambda h: F.when(
        F.size(h) >= S, F.transform(F.sequence(F.lit(0), F.size(h) - S), lambda i: F.xxhash64(h[i], h[i + 1]))
    ).otherwise(h))


def anchors(text: Column) -> Column:
    """The closed syncmers of a text with their first unit: array<struct<position:int, hash:bigint>>.

    A text of fewer than K units has one anchor, the whole; one without units has none.
    """
    return _let(_inner(F.coalesce(text, F.lit(""))), lambda s: F.when(
        F.size(s) >= K - S + 1,
        F.filter(
            F.transform(F.sequence(F.lit(0), F.size(s) - (K - S + 1)), lambda i: F.when(
                F.least(s[i], s[i + 2]) <= s[i + 1],
                F.struct(i.alias("position"), F.xxhash64(s[i], s[i + 2]).alias("hash")))),
            lambda a: a.isNotNull()),
    ).otherwise(F.transform(
        F.slice(s, 1, 1), lambda _: F.struct(F.lit(0).alias("position"), F.xxhash64(s).alias("hash")))))


def fingerprint(text: Column) -> Column:
    """All anchors in the order of the text."""
    return anchors(text)


def spelled(fp: Column) -> Column:
    """Each anchor as 16 hexadecimal digits of its hash and its position in hexadecimal, with commas between anchors."""
    return F.array_join(F.transform(fp, lambda a: F.concat(
        F.lpad(F.lower(F.hex(a["hash"])), 16, "0"), F.lower(F.hex(a["position"])))), ",")


def _numbered(fp: Column, side: int) -> Column:
    """Anchors by hash and, among equal hashes, by position: array<struct<hash, nth, side, position>>."""
    return _let(F.sort_array(F.transform(fp, lambda a: F.struct(a["hash"].alias("hash"), a["position"].alias("position")))), lambda s: _let(
        # Where each run of equal hashes starts, and the end.
        F.filter(F.transform(F.sequence(F.lit(0), F.size(s)), lambda i: F.when(
            (i == 0) | (i == F.size(s)), i).when(s[i]["hash"] != s[i - 1]["hash"], i)), lambda i: i.isNotNull()),
        lambda starts: _let(
            F.flatten(F.transform(
                F.sequence(F.lit(0), F.size(starts) - 2),
                lambda j: F.sequence(F.lit(0), starts[j + 1] - starts[j] - 1))),
            lambda nth: F.transform(s, lambda a, i: F.struct(
                a["hash"].alias("hash"), nth[i].alias("nth"), F.lit(side).alias("side"), a["position"].alias("position"))))))


def _matched(a: Column, b: Column) -> Column:
    """Ranks in ``b`` of the anchors of both, in the order of ``a``; the nth of equal hashes matches the nth."""
    pairs = _let(F.sort_array(F.concat(_numbered(a, 0), _numbered(b, 1))), lambda u: F.filter(
        F.transform(F.sequence(F.lit(0), F.size(u) - 2), lambda i: F.when(
            (u[i]["hash"] == u[i + 1]["hash"]) & (u[i]["nth"] == u[i + 1]["nth"]),
            F.struct(u[i + 1]["position"].alias("in_b"), u[i]["position"].alias("in_a")))),
        lambda m: m.isNotNull()))
    ranked = F.transform(F.sort_array(pairs), lambda m, rank: F.struct(m["in_a"].alias("in_a"), rank.alias("rank")))
    return F.transform(F.sort_array(ranked), lambda m: m["rank"])


def _runs(ranks: Column) -> Column:
    """The stretches of ranks that follow each other: array<struct<first:int, length:int>>.

    Matches of a stretch have no other match between them on either side, so a longest rise that holds one holds all.
    """
    return F.when(F.size(ranks) == 0, F.array().cast("array<struct<first:int,length:int>>")).otherwise(_let(
        F.filter(F.transform(F.sequence(F.lit(0), F.size(ranks)), lambda i: F.when(
            (i == 0) | (i == F.size(ranks)), i).when(ranks[i] != ranks[i - 1] + 1, i)), lambda i: i.isNotNull()),
        lambda starts: F.transform(F.sequence(F.lit(0), F.size(starts) - 2), lambda j: F.struct(
            ranks[starts[j]].alias("first"), (starts[j + 1] - starts[j]).alias("length")))))


def _below(stairs: Column, x: Column) -> Column:
    """How many of the rising ``stairs`` have a rank below ``x``, by binary search."""
    def halved(r: Column, _: Column) -> Column:
        middle = F.shiftright(r["low"] + r["high"], 1)
        return F.when(r["low"] >= r["high"], r).when(
            stairs[middle]["rank"] < x, F.struct((middle + 1).alias("low"), r["high"].alias("high"))
        ).otherwise(F.struct(r["low"].alias("low"), middle.alias("high")))

    return F.aggregate(
        F.sequence(F.lit(1), F.ceil(F.log2(F.size(stairs) + 1)).cast("int")),
        F.struct(F.lit(0).alias("low"), F.size(stairs).alias("high")), halved, lambda r: r["low"])


def _longest_rise(ranks: Column) -> Column:
    """Length of the longest rising subsequence of distinct ranks.

    Goes by runs, so a near copy costs steps for its edits, not for its length. ``stairs`` holds the best rises so far,
    by the rank they end at; each is longer than those before it.
    """
    def put(stairs: Column, run: Column) -> Column:
        return _let(F.when(F.size(stairs) == 0, F.lit(0)).otherwise(_below(stairs, run["first"])), lambda n: _let(
            run["length"] + F.when(n == 0, F.lit(0)).otherwise(F.element_at(stairs, n)["best"]),
            lambda best: F.concat(
                F.slice(stairs, F.lit(1), n), F.array(F.struct(run["first"].alias("rank"), best.alias("best"))),
                F.filter(F.slice(stairs, n + 1, F.size(stairs)), lambda s: s["best"] > best))))

    return F.aggregate(
        _let(ranks, _runs), F.array().cast("array<struct<rank:int,best:int>>"), put,
        lambda stairs: F.when(F.size(stairs) == 0, F.lit(0)).otherwise(F.element_at(stairs, -1)["best"]))


def _same_head(a: Column, b: Column) -> Column:
    """How many anchors from the first on have equal hashes; both have anchors."""
    least = F.least(F.size(a), F.size(b))
    return F.coalesce(F.array_min(F.transform(F.sequence(F.lit(0), least - 1), lambda i: F.when(
        a[i]["hash"] != b[i]["hash"], i))), least)


def _in_order(a: Column, b: Column) -> Column:
    """How many anchors match in consistent order."""
    def hashes(x: Column) -> Column:
        return F.transform(x, lambda y: y["hash"])

    def only(x: Column, common: Column) -> Column:
        # A saving alone, taken where the search of a short list is cheaper than a sort: anchors of other hashes match nothing.
        return F.when((F.size(common) <= 64) & (F.size(common) * 8 < F.size(x)), F.filter(
            x, lambda y: F.array_contains(common, y["hash"]))).otherwise(x)

    return _let(F.array_intersect(hashes(a), hashes(b)), lambda common: F.when(F.size(common) == 0, F.lit(0)).otherwise(
        _let(only(a, common), lambda x: _let(only(b, common), lambda y: _longest_rise(_matched(x, y))))))


def likeness(a: Column, b: Column) -> Column:
    """Anchors that match in consistent order, as a share of all of both; 1 for two empty fingerprints."""
    sizes = F.size(a) + F.size(b)
    # The same head matches itself, so only what follows it is searched.
    return F.when(sizes == 0, F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(
        _let(_same_head(a, b), lambda head: _let(
            head + _in_order(F.slice(a, head + 1, F.size(a)), F.slice(b, head + 1, F.size(b))), lambda n: n / (sizes - n))))


def _following(ids: DataFrame, n: int) -> DataFrame:
    """Per document (doc_id, key): the next in descending doc_id; after the last, the first."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("key")]
    parts = max(1, n // RANGE_ROWS)
    ranged = written(ids.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    this = F.struct("doc_id", "key")
    within = Window.partitionBy("_part").orderBy(*order)
    led = ranged.withColumn("_next", F.lead(this).over(within)).withColumn("_n", F.row_number().over(within))
    # One row per range; the next range's first document follows a range's last.
    firsts = led.where("_n = 1").select("_part", this.alias("_first"))
    by_range = Window.orderBy("_part")
    ends = firsts.select("_part", F.coalesce(
        F.lead("_first").over(by_range),
        F.first("_first").over(by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_after"))
    return led.join(ends, "_part").select(
        F.col("doc_id").alias("_of"), F.col("key").alias("_of_key"), (F.col("n_chars") - F.col("n_chars") % 3) / 3,
        F.coalesce("_next", "_after").alias("_next")).toDF("_of", "_of_key", "_cut", "_next").withColumn(
        "_cut", F.col("_cut").cast("int"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint every row of ``docs(doc_id, text, ...)``, its edited text, and compare with the next document.

    The edited text has its last third replaced by as many characters from the start of the next document in
    descending doc_id. Documents of one id follow each other by a hash of their texts; rows with the same id and text
    are one document and get equal results; null ids come last. Null texts are empty. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Other columns are ignored; an empty table
    gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", F.xxhash64("doc_id", text).alias("key"), text.alias("_text"))
    ids = texts.select("doc_id", "key", F.length("_text").alias("n_chars"))
    distinct = ids.distinct()
    n, n_distinct = ids.count(), distinct.count()
    after = written(_following(distinct, n_distinct), "following")
    sent = after.join(
        texts, (F.col("_next.key") == F.col("key")) & F.col("_next.doc_id").eqNullSafe(F.col("doc_id"))
    ).select("_of", "_of_key", "_cut", F.col("_text").alias("_next_text"))
    if n != n_distinct:
        sent = sent.dropDuplicates(["_of", "_of_key"])
    both = texts.join(sent, (F.col("key") == F.col("_of_key")) & F.col("doc_id").eqNullSafe(F.col("_of")))
    edited = both.select(
        "doc_id", F.length("_text").cast("long").alias("n_chars"), "_text", "_next_text",
        F.expr("concat(substring(_text, 1, length(_text) - _cut), substring(_next_text, 1, _cut))").alias("_edited"))
    done = edited.select(
        "doc_id", "n_chars", "_edited", fingerprint(F.col("_text")).alias("_print"),
        fingerprint(F.col("_edited")).alias("_edited_print"), fingerprint(F.col("_next_text")).alias("_next_print"))
    return done.select(
        "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), spelled(F.col("_print")).alias("fingerprint"),
        spelled(F.col("_edited_print")).alias("edited_fingerprint"),
        likeness(F.col("_print"), F.col("_edited_print")).alias("near_edited"),
        likeness(F.col("_print"), F.col("_next_print")).alias("near_next"))
