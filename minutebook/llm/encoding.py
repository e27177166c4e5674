"""Texts to token ids with a public vocabulary file.

Byte-level pair encoding never joins bytes across the border between a character and the space after it, so a text may be cut
there and each part encoded alone; parts repeat, so their ids are kept. Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import base64
from array import array

KEPT_PARTS = 200_000  # parts kept per task; the store is emptied beyond that


def ranks_path() -> str:
    """The file of the vocabulary ``byte_bpe_50k`` as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Token ids of texts, as the ``byte_bpe_50k`` vocabulary gives them."""

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import tiktoken

        with open(path or ranks_path(), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encode = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self._kept: dict[str, list[int]] = {}

    def ids(self, text: str | None) -> array:
        """Unsigned 32-bit ids of a text; none for NULL or an empty text."""
        out = array("I")
        if not text:
            return out
        first, *parts = text.split(" ")
        # Each part must start and end with something other than white space, else the cut is not safe.
        if not first or first[-1].isspace() or not all(parts):
            out.extend(self._encode(text))
            return out
        out.extend(self._encode(first))
        kept = self._kept
        for part in parts:
            ids = kept.get(part)
            if ids is None:
                if part[-1].isspace():
                    return array("I", self._encode(text))
                if len(kept) >= KEPT_PARTS:
                    kept.clear()
                ids = self._encode(" " + part)
                if len(part) <= 32:
                    kept[part] = ids
            out.extend(ids)
        return out
