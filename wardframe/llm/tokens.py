"""Token ids of whole texts by a public byte-level BPE, computed piece by piece in tasks.

Ids are those of ``tokenizers`` with the vocabulary file given. Most text consists of pieces met before, so
ids are kept per piece (word, number, run of marks or spaces); a new piece is merged by ``tiktoken``
from the same vocabulary's rank file. That splits like the tokenizer's own pattern only on characters
listed here; a text with any other character, or with the text of a special token, goes through
``tokenizers`` itself. Both ways give the same ids.
"""

from __future__ import annotations

import base64
import json
import re
import struct
from functools import cached_property

LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
SPACES = " \\t-\\r"
PIECES = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]+| ?[0-9]+| ?[^{SPACES}{LETTERS}0-9]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
OTHER = re.compile(f"[^ -~\\t-\\r{LETTERS}¡-©«-±´¶-¸»¿×÷‐-‧]")
MOST_PIECES = 120_000  # kept per worker: some 30 MB


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder(dict):
    """Maps a piece to its ids as little-endian 32-bit numbers; ``ids`` does so for a text."""

    def __init__(self, tokenizer_file: str, ranks_file: str | None):
        with open(tokenizer_file, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f).get("added_tokens", [])]
        self.file, self.piece = tokenizer_file, None
        if ranks_file:
            import public_tokenizers
            import tiktoken

            with open(ranks_file, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.piece = own.encode_ordinary

    @cached_property
    def whole(self):
        """The tokenizer itself, loaded by the first text that needs it: it takes some 100 MB."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.file)

    def __missing__(self, piece: str) -> bytes:
        ids = self.piece(piece)
        found = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= MOST_PIECES:
            self.clear()
        self[piece] = found
        return found

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.piece is None or OTHER.search(text) or any(s in text for s in self.special):
            ids = self.whole.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(self.__getitem__, PIECES.findall(text)))


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(tokenizer_file: str, ranks_file: str | None = None) -> Encoder:
    """One per worker process and vocabulary."""
    key = (tokenizer_file, ranks_file)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]
