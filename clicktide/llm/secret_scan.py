"""Secret scan: patterns of known secrets, and stretches of candidate strings whose characters are too evenly mixed.

A candidate is a maximal run of one character class. Over it slides a window of the class's width; the counts of its
characters are kept packed, a few bits each, in a handful of longs. A step adds the entering character, takes off the
leaving one and changes the sum of c * log2(c) by those two counts alone, so a window costs the same whatever its width:

    entropy = log2(width) - sum / width        (bits per character)

The sum is kept in whole millionths, so equal windows compare equal everywhere. Windows at or above the class's limit
that touch are one span. Candidates that an allow-list names add nothing. DataFrame functions only; no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1_000_000
# Bits of a packed count, and counts in a long.
COUNT_BITS = 6
PACKED = 10
# Matches whose places are added up together.
RUN = 256

# The patterns of known secrets. A match shorter than its least length is dropped; for ``assign`` the
# length is that of the assigned value (group 2), for the others that of the match.
ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
# A run of hex digits is matched whole or not at all, so the least length may stand in its pattern: the same matches
# without one for every short run.
PATTERNS = [("assign", ASSIGN, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]{24,}", 0, 24)]


@dataclass(frozen=True)
class CharacterClass:
    """Characters of a candidate, the window that slides over it, and the least entropy of a secret in bits."""

    name: str
    characters: str
    width: int
    least_bits: float

    @property
    def pattern(self) -> str:
        escaped = "".join("\\" + c if c in "\\]^-[" else c for c in self.characters)
        return f"[{escaped}]{{{self.width},}}"

    @property
    def most_sum(self) -> int:
        """The largest sum of c * log2(c), in millionths, of a window with the least entropy."""
        return math.floor(self.width * (math.log2(self.width) - self.least_bits) * SCALE)


_DIGITS, _UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLASSES = (
    CharacterClass("entropy_hex", _DIGITS + "abcdefABCDEF", 20, 3.0),
    CharacterClass("entropy_base64", _DIGITS + _UPPER + _UPPER.lower() + "+/_=-", 24, 4.0),
)
# Candidates that only look like secrets: plain numbers, UUIDs, integrity digests, alphabets.
ALLOWED = (
    "^[0-9]+$",
    "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    "^sha(256|384|512)-",
    "(?i)0123456789abcdef|abcdefghijklmnopqrstuvwxyz",
)


def weights(width: int) -> list[int]:
    """c * log2(c) in millionths for every count c up to ``width``."""
    return [round(c * math.log2(c) * SCALE) if c else 0 for c in range(width + 1)]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _running(numbers: Column) -> Column:
    """Sums of the first 1, 2, ... numbers; in runs, so that long arrays are not copied once per number."""
    def sums(first: Column, part: Column) -> Column:
        return F.aggregate(
            part, F.array(first), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)))

    def in_runs(own: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(own), F.lit(1)), F.lit(RUN))
        runs = F.transform(starts, lambda at: F.slice(own, at, F.lit(RUN)))
        return let(runs, lambda parts: let(
            sums(F.lit(0), F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x))),
            lambda before: F.flatten(F.transform(
                parts, lambda p, i: F.slice(sums(before[i], p), 2, F.lit(RUN))))))

    return let(numbers, in_runs)


def places(text: Column, pattern: str, group: int = 0, likely: Column | None = None) -> Column:
    """All matches from left to right, in code points: array of (start, end, value); ``value`` is the group's text.

    ``likely`` is a cheap test that every text with a match passes; by default the pattern itself is searched first.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    between = F.split(text, pattern, -1)
    lengths = F.transform(whole, F.length)
    # A match starts after all text between matches so far and all matches before it.
    steps = F.zip_with(
        F.transform(F.slice(between, F.lit(1), F.size(whole)), F.length),
        F.slice(F.concat(F.array(F.lit(0)), lengths), F.lit(1), F.size(whole)), lambda gap, before: gap + before)
    matches = F.zip_with(
        F.arrays_zip(_running(steps).alias("start"), lengths.alias("length")), values,
        lambda place, value: F.struct(
            place["start"].alias("start"), (place["start"] + place["length"]).alias("end"), value.alias("value")))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(F.regexp_like(text, F.lit(pattern)) if likely is None else likely, matches).otherwise(none)


def _even_stretches(candidate: Column, kind: CharacterClass) -> Column:
    """Spans (start, end) of touching windows of a candidate with at least the least entropy."""
    if kind.width >= 1 << COUNT_BITS:
        raise ValueError(f"a window has fewer than {1 << COUNT_BITS} characters")
    table = weights(kind.width)
    # What the sum gains when a count of c becomes c + 1.
    gains = F.array(*[F.lit(b - a) for a, b in zip(table, table[1:])]).cast("array<bigint>")
    longs = math.ceil(len(kind.characters) / PACKED)
    spans = "array<struct<start:int,end:int>>"
    start = F.struct(
        F.array_repeat(F.lit(0).cast("bigint"), longs).alias("counts"),
        F.lit(0).cast("bigint").alias("sum"),
        F.lit(-1).alias("open"), F.lit(-1).alias("end"),
        F.array().cast(spans).alias("closed"),
    )

    def place(code: Column) -> Column:
        return (code % PACKED) * COUNT_BITS

    def count(counts: Column, code: Column) -> Column:
        word = F.element_at(counts, F.floor(code / PACKED).cast("int") + 1)
        return F.call_function("shiftright", word, place(code)).bitwiseAND(F.lit((1 << COUNT_BITS) - 1)).cast("int")

    def changed(counts: Column, code: Column, sign: int) -> Column:
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), place(code)) * sign
        return F.transform(counts, lambda v, k: F.when(k == F.floor(code / PACKED), v + one).otherwise(v))

    def entered(state: Column, code: Column) -> Column:
        return F.struct(
            changed(state["counts"], code, 1).alias("counts"),
            (state["sum"] + gains[count(state["counts"], code)]).alias("sum"))

    def left(state: Column, code: Column) -> Column:
        return F.struct(
            changed(state["counts"], code, -1).alias("counts"),
            (state["sum"] - gains[count(state["counts"], code) - 1]).alias("sum"))

    def step(codes: Column) -> Callable[[Column, Column], Column]:
        def slide(state: Column, i: Column) -> Column:
            both = F.struct(state["counts"].alias("counts"), state["sum"].alias("sum"))
            full = i >= kind.width
            less = F.when(full, left(both, codes[i - kind.width])).otherwise(both)
            moved = let(less, lambda s: entered(s, codes[i]))

            def mark(window: Column) -> Column:
                begins = i - (kind.width - 1)
                even = (begins >= 0) & (window["sum"] <= kind.most_sum)
                joins = (state["open"] >= 0) & (state["end"] >= begins)
                closing = even & ~joins & (state["open"] >= 0)
                done = F.struct(state["open"].alias("start"), state["end"].alias("end"))
                return F.struct(
                    window["counts"].alias("counts"), window["sum"].alias("sum"),
                    F.when(even & ~joins, begins).otherwise(state["open"]).alias("open"),
                    F.when(even, i + 1).otherwise(state["end"]).alias("end"),
                    F.when(closing, F.concat(state["closed"], F.array(done))).otherwise(state["closed"]).alias("closed"))

            return let(moved, mark)

        return slide

    def finish(state: Column) -> Column:
        last = F.array(F.struct(state["open"].alias("start"), state["end"].alias("end")))
        return F.when(state["open"] >= 0, F.concat(state["closed"], last)).otherwise(state["closed"])

    codes = F.transform(F.split(candidate, "", -1), lambda c: F.instr(F.lit(kind.characters), c) - 1)
    return let(codes, lambda own: F.aggregate(
        F.sequence(F.lit(0), F.size(own) - 1), start, step(own), finish))


def _instr_safe(kinds: Sequence[CharacterClass]) -> None:
    for kind in kinds:
        if not kind.characters.isascii() or len(set(kind.characters)) != len(kind.characters):
            raise ValueError(f"{kind.name}: characters are distinct ASCII")


def _likely(text: Column, classes: Sequence[CharacterClass]) -> dict[str, Column]:
    """Cheap tests that texts with a match pass: words looked for as bytes, and one search for any long run."""
    lower = F.lower(text)
    assigned = F.lit(False)
    for word in ("passw", "secret", "token", "api"):
        assigned = assigned | F.contains(lower, F.lit(word))
    shortest = min([24, *(c.width for c in classes)])
    characters = dict.fromkeys("0123456789abcdef" + "".join(c.characters for c in classes))
    run = CharacterClass("run", "".join(characters), shortest, 0).pattern.removesuffix(",}") + "}"
    return {
        "_assign": assigned, "_access": F.contains(text, F.lit("AKIA")), "_run": F.regexp_like(text, F.lit(run))}


def _found(text: Column, classes: Sequence[CharacterClass], patterns: Sequence[str], literals: Sequence[str]) -> tuple:
    """Spans of known patterns, and those the entropy adds: arrays of (start, rank, end, kind)."""
    def span(kind: str, rank: int, start: Column, end: Column) -> Column:
        return F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))

    def pattern_spans(kind: str, rank: int, pattern: str, group: int, least: int) -> Column:
        likely = F.col({"assign": "_assign", "access": "_access"}.get(kind, "_run"))
        long = F.filter(places(text, pattern, group, likely), lambda m: F.length(m["value"]) >= least)
        return F.transform(long, lambda m: span(kind, rank, m["start"], m["end"]))

    def suppressed(value: Column) -> Column:
        out = value.isin(list(literals)) if literals else F.lit(False)
        for pattern in patterns:
            out = out | F.regexp_like(value, F.lit(pattern))
        return out

    def class_spans(kind: CharacterClass, rank: int) -> Column:
        candidates = F.filter(places(text, kind.pattern, likely=F.col("_run")), lambda m: ~suppressed(m["value"]))
        return F.flatten(F.transform(candidates, lambda m: F.transform(
            _even_stretches(m["value"], kind),
            lambda s: span(kind.name, rank, m["start"] + s["start"], m["start"] + s["end"]))))

    known = [pattern_spans(kind, rank, *rest) for rank, (kind, *rest) in enumerate(PATTERNS)]
    added = [class_spans(kind, rank) for rank, kind in enumerate(classes, len(PATTERNS))]
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    return F.array_sort(F.concat(*known)), F.array_sort(F.concat(*added)) if added else empty


def scan(
    docs: DataFrame,
    classes: Sequence[CharacterClass] = CLASSES,
    allowed_patterns: Sequence[str] = ALLOWED,
    allowed: Sequence[str] = (),
) -> DataFrame:
    """Spans of secrets in every row of ``docs(doc_id, text, ...)``.

    Returns doc_id, ``known`` (matches of PATTERNS) and ``added`` (stretches of high entropy, by class), both arrays of
    (start, rank, end, kind) in order; start and end in code points, end exclusive, rank is the kind's place in PATTERNS
    and ``classes``. Matches of a kind are the leftmost ones that do not overlap. ``allowed_patterns`` (searched in a
    candidate) and ``allowed`` (whole candidates) suppress added spans only. Null texts are empty and give no spans;
    repeated rows are scanned each; null ids are kept; other columns, whatever their names, are ignored; an empty table
    gives an empty result.
    """
    _instr_safe(classes)
    known, added = _found(F.col("text"), classes, allowed_patterns, allowed)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns(_likely(F.col("text"), classes))
    return rows.select("doc_id", known.alias("known"), added.alias("added"))


def kinds_of_patterns() -> list[str]:
    return [kind for kind, *_ in PATTERNS]


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined by start, then kind."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
