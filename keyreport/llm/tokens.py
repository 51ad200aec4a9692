"""Token ids of whole texts under a public byte-level BPE vocabulary.

``ids_bytes`` gives the ids as little-endian unsigned 32-bit bytes, equal to those
of the ``tokenizers`` file. Latin text is cut before single spaces, where the
vocabulary's pattern always cuts too, and each distinct piece is encoded once per
worker (bounded cache); any other text is encoded whole by ``tokenizers``.
"""

from __future__ import annotations

import base64
import re
from array import array

import public_tokenizers

JSON = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
CACHE = 400_000
SEGMENT = 1 << 20

# Characters up to U+024F, whose classes no Unicode version changes, without
# the two non-ASCII spaces among them.
_LATIN = re.compile("[\\x00-\\x84\\x86-\\x9f\\xa1-\\u024f]*")
# A space beside white space on both sides, or a double one: no safe cut.
_UNSAFE = re.compile(r"\s \s|  ")


class _Pieces(dict):
    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        ids = self[piece] = array("I", self.encode(" " + piece)).tobytes()
        return ids


class Encoder:
    def __init__(self, json_path: str | None = None, ranks_path: str | None = None):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path or public_tokenizers.path(RANKS), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.whole = Tokenizer.from_file(json_path or public_tokenizers.path(JSON))
        self.fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={}).encode_ordinary
        self.special = [t for t in self.whole.get_vocab() if t.startswith("<|")]
        self.pieces = _Pieces(self.fast)

    def ids_bytes(self, text: str) -> bytes:
        if not text:
            return b""
        if (not text.isascii() and not _LATIN.fullmatch(text)) or any(s in text for s in self.special):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if "  " in text or _UNSAFE.search(text):
            return array("I", self.fast(text)).tobytes()
        out, a = [], 0
        while a < len(text):
            b = text.find(" ", a + SEGMENT) if len(text) - a > SEGMENT else -1
            head, *rest = text[a:b if b >= 0 else None].split(" ")
            out.append(array("I", self.fast(head)).tobytes())
            out.append(b"".join(map(self.pieces.__getitem__, rest)))
            a = b if b >= 0 else len(text)
        return b"".join(out)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(json_path: str | None = None, ranks_path: str | None = None) -> Encoder:
    """The worker's encoder for these files, loaded once."""
    key = (json_path, ranks_path)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]
