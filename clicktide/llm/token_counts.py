"""Token counts by offset-mapped attribution: encode a document once, then join token spans to its sections.

Both sides of the join are sorted spans of one document, so two binary searches find the sections that a token meets.
Rule for a token across boundaries: it counts for the section that holds most of its characters, the first of those
if several hold equally many. Tokens outside all sections count for section -1. The counts of a document's sections
therefore add up to the document's tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.llm.tokens import encoder, vocabulary_path

COUNTED = "doc_id long, section long, name string, start long, end long, n_tokens long, doc_tokens long"
SECTIONS = "array<struct<name:string,start:long,end:long>>"


def attributed(starts: np.ndarray, ends: np.ndarray, sections: np.ndarray) -> np.ndarray:
    """Section of every token; ``sections`` are sorted disjoint (start, end)."""
    ends = np.maximum(ends, starts + 1)  # a token within a character counts as that character
    first = np.searchsorted(sections[:, 1], starts, "right")
    last = np.searchsorted(sections[:, 0], ends, "left") - 1
    out = np.where(first <= last, first, -1)
    for token in np.flatnonzero(first < last):
        met = sections[first[token]:last[token] + 1]
        shared = np.minimum(met[:, 1], ends[token]) - np.maximum(met[:, 0], starts[token])
        out[token] = first[token] + int(np.argmax(shared))
    return out


def _lines(text: str) -> list[tuple[str | None, int, int]]:
    out, at = [], 0
    for line in text.split("\n"):
        end = min(len(text), at + len(line) + 1)
        out.append((None, at, end))
        at = end
    return out


def _disjoint(sections: list, n_chars: int) -> list[tuple[str | None, int, int]]:
    """In order of their starts, cut to the text; an overlap belongs to the earlier section."""
    valid = [s for s in sections or [] if s is not None and s["start"] is not None and s["end"] is not None]
    out, at = [], 0
    for s in sorted(valid, key=lambda s: (s["start"], s["end"])):
        start = min(max(s["start"], at), n_chars)
        end = min(max(s["end"], start), n_chars)
        out.append((s["name"], start, end))
        at = end
    return out


def _counter(path: str, given: bool) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_of = encoder(path).spans
        for batch in batches:
            texts = batch["_text"].to_pylist()
            sections = batch["_sections"].to_pylist() if given else [None] * len(texts)
            owners, numbers, names, starts, ends, counts, totals = ([] for _ in range(7))
            for i, (text, own) in enumerate(zip(texts, sections)):
                a, b = spans_of(text)
                parts = _disjoint(own, len(text)) if given else _lines(text)
                # Empty sections meet no token.
                full = [k for k, (_, s, e) in enumerate(parts) if e > s]
                bounds = np.array([parts[k][1:] for k in full], np.int64).reshape(-1, 2)
                where = attributed(a, b, bounds) if len(full) else np.full(len(a), -1)
                of_full = np.bincount(where[where >= 0], minlength=len(full))
                tokens = np.zeros(len(parts), np.int64)
                tokens[full] = of_full
                for k, (name, s, e) in enumerate(parts):
                    owners.append(i), numbers.append(k), names.append(name)
                    starts.append(s), ends.append(e), counts.append(int(tokens[k])), totals.append(len(a))
                outside = int((where < 0).sum())
                if outside or not parts:
                    owners.append(i), numbers.append(-1), names.append(None)
                    starts.append(None), ends.append(None), counts.append(outside), totals.append(len(a))
            yield pa.record_batch({
                "doc_id": batch["doc_id"].take(pa.array(owners, pa.int64())),
                "section": pa.array(numbers, pa.int64()), "name": pa.array(names, pa.string()),
                "start": pa.array(starts, pa.int64()), "end": pa.array(ends, pa.int64()),
                "n_tokens": pa.array(counts, pa.int64()), "doc_tokens": pa.array(totals, pa.int64()),
            })

    return count


def count_tokens(docs: DataFrame, sections: Column | None = None, vocabulary: str | None = None) -> DataFrame:
    """Tokens of every section of every row of ``docs(doc_id, text, ...)``; no shuffle.

    ``sections`` is a column of SECTIONS in characters, by default the lines with their line ends. One row per section
    in order of starts (also without tokens), and section -1 for tokens outside all of them or a text without
    sections. Sections are cut to the text, overlaps belong to the earlier one, those with null bounds are left out.
    Null texts are empty: their only line has no tokens. Repeated rows are counted each, null ids kept; other columns
    are ignored; an empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit("")).alias("_text")
    given = [] if sections is None else [sections.cast(SECTIONS).alias("_sections")]
    return docs.select("doc_id", text, *given).mapInArrow(
        _counter(vocabulary or vocabulary_path(), bool(given)), COUNTED)
