"""Exact token ids of public tokenizers, with per-worker caches.

A tokenizer that drops white space and looks at nothing across it gives a
text the ids of its white-space separated chunks, one after another.  For
such a tokenizer each distinct chunk is encoded once per worker process and
then looked up; texts that hold the start of an added token go through the
library as a whole.  Every other tokenizer encodes whole texts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable

#: Chunks kept per worker process; later chunks are encoded again when met.
CACHE_CHUNKS = 250_000
CACHE_PIECES = 250_000

# The splitting rule, by which a word tokenizer that drops white
# space is recognised, and the same rule over lower-cased ASCII and Latin-1.
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+"
PLAIN_TEXT = r"[\x21-\x7eß-öø-ÿÀ-ÖØ-Þ]*"


def version_digest(path: str) -> str:
    """Digest of the tokenizer's file: its version in the count cache."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _byte_names() -> list[str]:
    """Printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names, extra = {b: chr(b) for b in shown}, 0
    for b in range(256):
        if b not in names:
            names[b] = chr(256 + extra)
            extra += 1
    return [names[b] for b in range(256)]


def drops_white_space(spec: dict) -> bool:
    """Whether a tokenizer file has the rule under which chunks stand alone."""
    try:
        steps = spec["pre_tokenizer"]["pretokenizers"]
        norm = [n["type"] for n in spec["normalizer"]["normalizers"]]
        return (
            spec["model"]["type"] == "BPE"
            and not spec["model"].get("dropout")
            and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and steps[0]["behavior"] == "Removed"
            and steps[0]["invert"]
            and steps[0]["pattern"] == {"Regex": WORD_RULE}
            and not steps[1]["add_prefix_space"]
            and norm == ["NFC", "Replace", "Lowercase"]
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
            and all(t["content"].startswith("<|") for t in spec["added_tokens"])
        )
    except (KeyError, TypeError):
        return False


class ChunkIds(dict):
    """chunk (lower-cased UTF-8, no white space) -> ids as little-endian bytes."""

    def __init__(self, lib):
        super().__init__()
        self.lib, self.model = lib, lib.model
        self.pieces: dict[str, bytes] = {}
        self.names = _byte_names()
        self.split = re.compile(PLAIN_RULE).findall
        self.plain = re.compile(PLAIN_TEXT).fullmatch

    def piece(self, piece: str) -> bytes:
        ids = b"".join(
            t.id.to_bytes(4, "little") for t in self.model.tokenize("".join([self.names[b] for b in piece.encode()]))
        )
        if len(self.pieces) < CACHE_PIECES:
            self.pieces[piece] = ids
        return ids

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        if self.plain(text):
            found = self.pieces.get
            ids = b"".join([found(p) or self.piece(p) for p in self.split(text.lower())])
        else:
            ids = b"".join(i.to_bytes(4, "little") for i in self.lib.encode(text, add_special_tokens=False).ids)
        if len(self) < CACHE_CHUNKS:
            self[chunk] = ids
        return ids


def encoder(path: str) -> Callable[[str], bytes]:
    """text -> ids, unsigned little-endian 32-bit, without added tokens of the
    library's own (begin, end); special strings as the library's default."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: b"".join(i.to_bytes(4, "little") for i in lib.encode(text, num_threads=1))
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(path)
    lib.no_truncation()
    lib.no_padding()

    def whole(text: str) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in lib.encode(text, add_special_tokens=False).ids)

    with open(path, encoding="utf-8") as f:
        if not drops_white_space(json.load(f)):
            return whole
    ids = ChunkIds(lib)

    def by_chunk(text: str) -> bytes:
        if "<|" in text:
            return whole(text)
        return b"".join(map(ids.__getitem__, text.encode("utf-8", "replace").lower().split()))

    return by_chunk
