"""The alphabet of byte-level tokenizers: a printable Latin-1 character stands for its own byte, and the
other bytes, in order, for the characters from U+0100 on."""

from __future__ import annotations

_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in set(_SHOWN)]
BYTE_OF = {chr(b): b for b in _SHOWN} | {chr(256 + k): b for k, b in enumerate(_HIDDEN)}


def spelled(token: str) -> bytes:
    """The bytes of a token; a token with other characters spells itself."""
    return bytes(BYTE_OF[c] for c in token) if all(c in BYTE_OF for c in token) else token.encode()
