"""Byte-level BPE ids and character spans of whole texts.

The same vocabulary comes as a ``.json`` file for one library and as a ``.tiktoken`` rank file for a faster one. Texts
of PLAIN characters take the fast way; those with others, whose classes could differ between the libraries' Unicode
versions, and those that spell the special token go through the ``.json`` tokenizer, which the ids are defined by.
"""

from __future__ import annotations

import base64
import os
import re
from functools import cached_property
from typing import TYPE_CHECKING

import numpy as np

if TYPE_CHECKING:
    from tokenizers import Tokenizer

SPECIAL = "<|endoftext|>"
# The one part of the pattern that needs a look-ahead, which makes matching slow.
_AHEAD = r"|\s+(?!\S)"
_NOT_PLAIN = re.compile("[^\t\n\r -~¡-ɏ]")


def grouped(pattern: str) -> str:
    """The same pattern with all that it tries before its look-ahead as one group, which is matched at once."""
    before, ahead, rest = pattern.partition(_AHEAD)
    return f"(?:{before}){ahead}{rest}"


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """``path``: the ``.json`` file; the rank file lies beside it."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks already use all cores
        import public_tokenizers
        import tiktoken

        self.path = path
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        # Without any special token the library would look for an empty one at every place of a text.
        self.fast = tiktoken.Encoding(
            "bpe", pat_str=grouped(public_tokenizers.PATTERN), mergeable_ranks=ranks,
            special_tokens={SPECIAL: max(ranks.values()) + 1})
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)  # bytes of every token
        for token, rank in ranks.items():
            self.size[rank] = len(token)

    @cached_property
    def tokenizer(self) -> Tokenizer:
        """Loaded for the first text that needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _plain(self, text: str) -> bool:
        return not _NOT_PLAIN.search(text) and SPECIAL not in text

    def _fast_ids(self, text: str) -> np.ndarray:
        """Of a plain text, without a Python number for every id; SPECIAL is no token here."""
        return self.fast.encode_to_numpy(text, disallowed_special=())

    def ids(self, text: str) -> np.ndarray:
        if self._plain(text):
            return self._fast_ids(text)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last character of every token; parts of a character all span it."""
        if not self._plain(text):
            spans = self.tokenizer.encode(text, add_special_tokens=False).offsets
            both = np.array(spans, np.int64).reshape(-1, 2)
            return both[:, 0], both[:, 1]
        sizes = self.size[self._fast_ids(text)]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        if text.isascii():
            return starts, ends
        begun = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)  # characters begun up to each byte
        return begun[starts] - 1, begun[ends - 1]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
