"""Resolution of not-modified revisits in web archives.

A revisit (status 304) stands for the latest earlier full response (status 200) of the same canonical URL. The as-of
join runs in cells: the captures in the order of URL and time are cut into ranges of about CELL_ROWS rows, and a cell is
what a range holds of a URL, so a URL with a third of all captures is spread over as many tasks as its rows need. What a
cell cannot see is the last response of the URL's earlier cells, carried over as one row per cell. The response found must match the revisit's validators; then the permitted headers of the revisit
replace those of the response (RFC 9111, section 3.2).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clicktide.llm.exchange import written

CELL_ROWS = 500_000
# Headers that a revisit may bring up to date; fields of the connection or the content stay those of the response.
PERMITTED = ("age", "cache-control", "date", "etag", "expires", "last-modified", "vary", "warning")


def canonical_url(url: Column) -> Column:
    """Scheme, user, ``www.``, default port, fragment and closing slashes dropped, host in lower case, query sorted.

    Text that is no ``scheme://`` URL stays as it is, without outer blanks.
    """
    trimmed = F.trim(url)
    pattern = "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)([?][^#]*)?(#.*)?$"
    host = F.regexp_extract(trimmed, pattern, 1)
    for gone in ("^.*@", "^(?i)www[0-9]*[.]", ":(80|443)?$", "[.]$"):
        host = F.regexp_replace(host, gone, "")
    path = F.regexp_replace(F.regexp_extract(trimmed, pattern, 2), "/+$", "")
    query = F.substring(F.regexp_extract(trimmed, pattern, 3), 2, 1 << 30)
    sorted_query = F.when(query == "", "").otherwise(
        F.concat(F.lit("?"), F.array_join(F.array_sort(F.split(query, "&")), "&")))
    return F.when(trimmed.rlike(pattern), F.concat(F.lower(host), F.when(path == "", "/").otherwise(path), sorted_query)
                  ).otherwise(trimmed)


def _strong(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def _in_cells(narrow: DataFrame) -> DataFrame:
    """With the number of its range in ``_cell``; rows of one URL and time are in one cell.

    Written, since the borders of ranges come from a sample and are to be the same wherever the rows are read.
    """
    ranges = max(1, math.ceil(narrow.count() / CELL_ROWS))
    dealt = narrow.repartitionByRange(ranges, "url", "at") if ranges > 1 else narrow
    return written(dealt.withColumn("_cell", F.spark_partition_id() if ranges > 1 else F.lit(0)), "cells")


def resolve(captures: DataFrame) -> DataFrame:
    """One row per revisit of ``captures(record_id, url, ts, status, headers, digest, ...)``.

    Returns record_id, url (canonical), response_id, outcome, digest and headers (merged, null unless resolved).
    Outcomes: ``resolved``; ``mismatch`` if a validator differs; ``no_validator`` if the two have none in common;
    ``no_response`` if there is no earlier full response. An entity tag decides before the modification date; tags
    compare weakly. Earlier means an earlier ``ts``; of several responses at one time the largest record_id counts.
    Header names must be in lower case. Null URLs or times never match; null statuses are neither response nor revisit.
    Repeated revisits are resolved each, of repeated responses one is taken; other columns are ignored; an empty table
    gives an empty result.
    """
    # The row key is written before use, so that it stays the same wherever the rows are read.
    rows = written(captures.select(
        F.monotonically_increasing_id().alias("_row"), "record_id", canonical_url(F.col("url")).alias("url"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "status",
        "headers", "digest"), "captures")
    narrow = rows.where("status IN (200, 304) AND url IS NOT NULL AND at IS NOT NULL").select(
        "_row", "record_id", "url", "at", "status",
        F.xxhash64("digest", F.array_sort(F.map_entries("headers"))).alias("_content"))
    cells = _in_cells(narrow)
    # Of equal times and ids the content decides, so that it does not matter how rows were read; null ids count as least.
    full = F.when(F.col("status") == 200, F.struct("at", "record_id", "_content", "_row"))
    by_cell = Window.partitionBy("url").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = cells.groupBy("url", "_cell").agg(F.max(full).alias("_last")).select(
        "url", "_cell", F.max("_last").over(by_cell).alias("_carried"))
    earlier = Window.partitionBy("url", "_cell").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    matched = (
        cells.withColumn("_near", F.max(full).over(earlier)).where("status = 304").join(carried, ["url", "_cell"])
        .select(F.col("_row").alias("_revisit"), F.coalesce("_near", "_carried").alias("_found"))
        .select("_revisit", F.col("_found.record_id").alias("response_id"), F.col("_found._row").alias("_response"))
    )
    stored = rows.where("status = 200").select(
        F.col("_row").alias("_stored"), F.col("headers").alias("_kept"), F.col("digest").alias("_digest"))
    joined = (rows.where("status = 304").select("_row", "record_id", "url", "headers")
              .join(matched, F.col("_row") == F.col("_revisit"), "left")
              .join(stored, F.col("_response") == F.col("_stored"), "left"))
    tags = _strong(F.col("headers")["etag"]), _strong(F.col("_kept")["etag"])
    dates = F.col("headers")["last-modified"], F.col("_kept")["last-modified"]
    same = F.coalesce(tags[0] == tags[1], dates[0] == dates[1])
    outcome = (F.when(F.col("_response").isNull(), "no_response").when(same.isNull(), "no_validator")
               .when(same, "resolved").otherwise("mismatch"))
    permitted = F.map_filter("headers", lambda name, _: name.isin(*PERMITTED))
    merged = F.map_concat(
        F.map_filter("_kept", lambda name, _: ~F.coalesce(F.array_contains(F.map_keys(permitted), name), F.lit(False))), permitted)
    decided = joined.withColumn("outcome", outcome)
    resolved = F.col("outcome") == "resolved"
    return decided.select(
        "record_id", "url", "response_id", "outcome", F.when(resolved, F.col("_digest")).alias("digest"),
        F.when(resolved, merged).alias("headers"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures as a crawler that comes back leaves them: of every page a full response and, later, a revisit.

    The revisit's URL is spelled differently; its validators are the response's tag, its weak form, another tag, or
    the modification date only, by turns.
    """
    n = F.col("page_id")
    html = F.coalesce("html", F.lit(""))
    tag = F.concat(F.lit('"'), F.md5(html), F.lit('"'))
    modified = F.concat(F.lit("day "), F.length(html).cast("string"))
    first = F.timestamp_seconds(1_700_000_000 + n * 60)
    again = F.timestamp_seconds(1_700_000_030 + n * 60 + F.pmod(n, F.lit(5)) * 36_000)

    def headers(**values: Column) -> Column:
        return F.map_from_arrays(
            F.array(*[F.lit(k.replace("_", "-")) for k in values]), F.array(*values.values()))

    full = pages.select(
        (n * 2).alias("record_id"), "url", first.alias("ts"), F.lit(200).alias("status"),
        headers(etag=tag, last_modified=modified, content_type=F.lit("text/html"),
                content_length=F.octet_length(html).cast("string"), cache_control=F.lit("max-age=60")).alias("headers"),
        F.sha2(html, 256).alias("digest"))
    turn = F.pmod(n, F.lit(4))
    other_tag = F.when(turn == 0, tag).when(turn == 1, F.concat(F.lit("W/"), tag)).when(
        turn == 2, F.concat(F.lit('"'), n.cast("string"), F.lit('"')))
    revisit = pages.select(
        (n * 2 + 1).alias("record_id"), F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again")).alias("url"),
        again.alias("ts"), F.lit(304).alias("status"),
        F.map_filter(headers(etag=other_tag, last_modified=F.when(turn == 3, modified), content_length=F.lit("0"),
                             cache_control=F.lit("max-age=120")), lambda _, v: v.isNotNull()).alias("headers"),
        F.lit(None).cast("string").alias("digest"))
    return full.unionByName(revisit)
