"""Token ids of whole texts by a public byte-level BPE vocabulary.

Long texts are encoded in pieces, cut before a space or line break that something other than white space follows: the
vocabulary's own pre-tokens never cross such a place, whatever stands on either side, so the pieces' ids can be joined.  The
vocabulary's one added token, ``<|endoftext|>``, gets its own id wherever its string occurs, and white space before it is a
pre-token of its own; so no text is cut right before it.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

# The vocabulary's added token and its id.
ADDED, ADDED_ID = "<|endoftext|>", 50256
CUT = re.compile(r"[ \n](?=\S)(?!<\|endoftext\|>)")
#: Texts go through in pieces of about so many characters.
STEP = 1 << 18


def default_path() -> str:
    """The rank file of the vocabulary whose other form is ``byte_bpe_50k.json``; ids are the same."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Ids of texts as bytes, little-endian unsigned 32-bit; nothing is kept between texts."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={ADDED: ADDED_ID})

    def pieces(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > STEP and (m := CUT.search(text, at + STEP)):
            yield text[at : m.start()]
            at = m.start()
        yield text[at:] if at else text

    def ids(self, text: str) -> bytes:
        """Ids of a whole text, 4 bytes each."""
        return b"".join(self.bpe.encode_to_numpy(p, allowed_special="all").astype("<u4").tobytes() for p in self.pieces(text))

    def count(self, text: str) -> int:
        """Number of ids of a whole text."""
        return sum(len(self.bpe.encode_to_numpy(p, allowed_special="all")) for p in self.pieces(text))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    return Encoder(path)
