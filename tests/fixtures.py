"""Hand-made events and brute-force answers. Times are seconds after 2024-01-01T00:00:00Z."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from clicktide import schemas

BASE = 1_704_067_200
START = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def click(click_id, user, seconds, product="p1", offset=0):
    return (click_id, user, product, "url", "agent", "ip", float(BASE + seconds), at(seconds), 0, offset, "clicks")


def checkout(checkout_id, user, seconds, product="p1", offset=0):
    return (
        checkout_id, user, product, "Cash", "$1.00", "ship", "bill", "agent", "ip",
        float(BASE + seconds), at(seconds), 0, offset, "checkouts",
    )


def stored_schema(kind):
    from pyspark.sql import types as T

    return T.StructType(schemas.EVENTS[kind].fields + schemas.METADATA.fields)


def frame(spark, kind, rows):
    return spark.createDataFrame(rows, stored_schema(kind)).withColumn("proc_time", F.current_timestamp())


def session_rows(acts, gap, placeholder="null"):
    """Brute force: (user, type, id, second) rows -> session tuples."""
    per_user = defaultdict(list)
    for user, kind, ident, second in acts:
        per_user[user].append((second, kind, ident))
    out = Counter()
    for user, items in per_user.items():
        items.sort()
        groups = [[items[0]]]
        for item in items[1:]:
            if item[0] <= groups[-1][-1][0] + gap:
                groups[-1].append(item)
            else:
                groups.append([item])
        for group in groups:
            def ids(kind):
                tokens = [i if k == kind else placeholder for _, k, i in group]
                return ",".join(t for t in tokens if t is not None)

            out[(
                user, at(group[0][0]), at(group[-1][0] + gap),
                sum(k == "checkout" for _, k, _ in group), ids("checkout"),
                sum(k == "click" for _, k, _ in group), ids("click"),
            )] += 1
    return out


def rows(df):
    return Counter(tuple(r) for r in df.collect())
