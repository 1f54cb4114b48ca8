"""Alignment of two tokenizers through inverted pair bitmaps.

Tokenizers A and B cut the same bytes (a space and the text).  Byte offsets
where tokens of both end cut them into groups; every A-B pair of occurrences in
a group is a link.

* Blocks: a task numbers the documents of a block of bounded size.  One pass
  writes a row per document, and the inverted index of the block: for each pair
  of ids the compressed bitmap of the documents that link it (plane 0) and
  multiplicity planes: a document with m links of the pair is in plane k if bit
  k - 1 of m - 1 is set, so it weighs 1 in plane 0 and 2^(k-1) in plane k.  A
  container holds sorted 16-bit ordinals, or a bit for each document where that
  is shorter, and its popcount.
* Counts: containers of a pair lie in disjoint blocks, so their OR is their
  union and its popcount the sum of theirs: one grouping gives the documents,
  and with the planes' weights the links, of each pair; a second the highest
  count of each A id.  Both are bounded by the vocabularies.
* Scores: each posting row returns (count, best) of its pair to the documents
  in its container, summed per block by array operations.

Where no token of either tokenizer can cross a space that follows a visible
character, or join a letter with another kind of character (read from rules and
vocabularies), texts are cut into chunks there and chunks into parts, and each
distinct part is encoded once per task process (in bounded caches); otherwise
whole texts are.  Ids are aligned by array operations, many texts at a time.

Defined results: a text that is NULL or empty, or whose token bytes differ from
a space and the text, has no tokens (zeros, empty digest).  Every row is a
document of its own, rows that repeat included.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import small_enough, staged, worker_cache
from tessera.llm.tokens import _byte_names

#: A block closes at this many documents (16-bit ordinals allow 65,536), or as
#: soon as it holds this many (document, pair) entries.
BLOCK_DOCS = 8192
BLOCK_ENTRIES = 1_500_000
#: Ids (4 bytes each) that are aligned together.
BATCH_BYTES = 2 << 20
#: Groups with more links than this are counted by distinct ids.
WIDE_GROUP = 256
CACHE_CHUNKS = 200_000
CACHE_PARTS = 200_000
#: Scores are broadcast up to this many distinct pairs.
MAX_BROADCAST_PAIRS = 1_000_000
#: Blocks whose sums a scoring task holds at a time.
HELD_BLOCKS = 32
#: Texts are cut into runs of about this many characters (at a chunk's end).
RUN_CHARS = 1 << 18

DOCUMENT = "ordinal int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
POSTING = "a int, b int, plane int, docs int, dense boolean, bits binary"
INDEX = f"block long, {DOCUMENT}, {POSTING}"

# Stand-in of a space in pieces, and where a chunk can end.
SPACE_MARK = "▁"
CHUNK_END = re.compile(r"(?<=\S) (?=.)", re.DOTALL)
# Between a Latin letter and ASCII punctuation, digit or line feed, and back (but
# not behind an apostrophe, which begins short forms, and behind one line feed
# only after a visible character).
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
PART_END = re.compile(rf"(?<=[{LATIN}])(?=[!-@[-`{{-~\n])|(?<=[!-&(-@[-`{{-~])(?=[{LATIN}])|(?<=[!-~{LATIN}]\n)(?=[{LATIN}])")
WORD = re.compile(rf" ?[{LATIN}]+")
UNUSUAL_SPACE = re.compile(r"\A |\s | \Z")


# -- tokenizers ---------------------------------------------------------------


class ByteTokens:
    """A byte-level tokenizer of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.lib.encode_special_tokens = True
        self.names = _byte_names()
        byte_of = {name: b for b, name in enumerate(self.names)}
        self.bytes_of = {
            i: bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
            for token, i in self.lib.get_vocab(with_added_tokens=True).items()
        }
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec.get("pre_tokenizer") or {}
        #: its rule starts a new word at a space behind a visible character
        self.cuts_at_spaces = (
            spec.get("normalizer") is None
            and steps.get("type") == "ByteLevel"
            and bool(steps.get("use_regex"))
            and not steps.get("add_prefix_space")
            and spec["model"]["type"] == "BPE"
            and not spec["model"].get("dropout")
        )

    def encode(self, raw: str) -> list[int]:
        if self.cuts_at_spaces and WORD.fullmatch(raw):
            # one word of the rule: straight to its merges
            names = self.names
            return [t.id for t in self.lib.model.tokenize("".join([names[b] for b in raw.encode()]))]
        return self.lib.encode(raw, add_special_tokens=False).ids


class PieceTokens:
    """A sentencepiece model; it puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.lib.id_to_piece(i) for i in range(self.lib.get_piece_size())]
        self.bytes_of = {
            i: bytes([int(p[3:5], 16)]) if self.lib.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
            for i, p in enumerate(pieces)
        }
        shown = [p for i, p in enumerate(pieces) if not (self.lib.is_byte(i) or self.lib.is_control(i) or self.lib.is_unknown(i))]
        inner = regex.compile(rf"[^{SPACE_MARK}]{SPACE_MARK}|\p{{L}}[^\p{{L}}\p{{M}}]|[^\p{{L}}\p{{M}}{SPACE_MARK}]\p{{L}}|\n")
        same = "a  b ﬁ　c"  # a model that rewrites texts would change these
        self.cuts_at_spaces = (
            not any(inner.search(p) for p in shown)
            and len(self.lib.encode("\n")) == 2
            and b"".join(self.bytes_of[i] for i in self.encode(" " + same)) == (" " + same).encode()
        )

    def encode(self, raw: str) -> list[int]:
        if raw[:1] == " ":
            return self.lib.encode(raw[1:], num_threads=1)
        # no token holds a line feed: two tokens stand for the space and this one
        return self.lib.encode("\n" + raw, num_threads=1)[2:]


def load(path: str):
    return PieceTokens(path) if path.endswith(".model") else ByteTokens(path)


# -- one chunk ----------------------------------------------------------------


class Parts(dict):
    """raw text -> ids of A and of B (unsigned little-endian 32-bit), or None
    where the tokens' bytes differ from the text's."""

    def __init__(self, path_a: str, path_b: str):
        super().__init__()
        self.a, self.b = load(path_a), load(path_b)

    def __missing__(self, raw: str):
        a, b, data = self.a.encode(raw), self.b.encode(raw), raw.encode()
        a_bytes, b_bytes = self.a.bytes_of, self.b.bytes_of
        same = b"".join([a_bytes[t] for t in a]) == data == b"".join([b_bytes[t] for t in b])
        found = (array("I", a).tobytes(), array("I", b).tobytes()) if same else None
        if len(self) < CACHE_PARTS and len(raw) < 32:
            self[raw] = found
        return found


class Chunks(dict):
    """chunk (without the space before it) -> the same, from its parts."""

    def __init__(self, path_a: str, path_b: str):
        super().__init__()
        self.parts = Parts(path_a, path_b)
        self.cuts = self.parts.a.cuts_at_spaces and self.parts.b.cuts_at_spaces
        tables = [t.bytes_of for t in (self.parts.a, self.parts.b)]
        self.lengths = [np.array([len(t.get(i, b"")) for i in range(max(t) + 1)], np.int64) for t in tables]
        # every id with the mark that may follow it in the text of groups
        self.shown = [f"{i}{mark}" for t, marks in zip(self.lengths, (",|", ",;")) for i in range(len(t)) for mark in marks]

    def __missing__(self, chunk: str):
        raw = " " + chunk
        if self.cuts and not chunk.isalpha():
            found = [self.parts[n] for n in PART_END.split(raw)]
            record = None if None in found else (b"".join([f[0] for f in found]), b"".join([f[1] for f in found]))
        else:
            record = self.parts[raw]
        if len(self) < CACHE_CHUNKS and len(chunk) < 64:
            self[chunk] = record
        return record

    def runs(self, text: str) -> Iterator[list[str]]:
        """The chunks of a text, some at a time."""
        if not self.cuts:
            yield [text]
            return
        start = 0
        while start < len(text):
            end = CHUNK_END.search(text, start + RUN_CHARS) if len(text) - start > RUN_CHARS else None
            run = text[start : end.start()] if end else text[start:]
            # a run begins behind the space that its first chunk owns
            yield CHUNK_END.split(run) if UNUSUAL_SPACE.search(run) else run.split(" ")
            start = end.end() if end else len(text)


# -- a block of documents -----------------------------------------------------


class Alignment:
    """Groups of the tokens of many texts, one after the other.

    Token ends are byte offsets from the first text on; both tokenizers end at
    every text's end, so the ends they share cut all texts at once."""

    def __init__(self, a: np.ndarray, b: np.ndarray, chunks: Chunks):
        self.a, self.b, self.chunks = a, b, chunks
        ends = [np.cumsum(n[t]) for n, t in zip(chunks.lengths, (a, b))]
        at = np.searchsorted(ends[1], ends[0])
        last_a = ends[1][at] == ends[0]
        last_b = np.zeros(len(b), bool)
        last_b[at[last_a]] = True
        self.last = (last_a, last_b)
        #: group of each token; tokens of each group
        self.group = [np.cumsum(x) - x for x in self.last]
        self.count = [np.bincount(g) for g in self.group]
        self.first = [np.cumsum(n) - n for n in self.count]

    def shown(self) -> list[int]:
        """Numbers, in the table of ids with marks, of all tokens in the order
        of the text of groups."""
        na, nb = self.count
        start = np.cumsum(na + nb) - (na + nb)
        out = np.empty(len(self.a) + len(self.b), np.int64)
        ga, gb = self.group
        out[start[ga] + np.arange(len(ga)) - self.first[0][ga]] = 2 * self.a + self.last[0]
        out[(start + na)[gb] + np.arange(len(gb)) - self.first[1][gb]] = 2 * (len(self.chunks.lengths[0]) + self.b) + self.last[1]
        return out.tolist()

    def pairs(self, ordinal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, links), sorted and distinct: the key holds the pair and, last,
        the document's ``ordinal`` (given for each token of A)."""
        width = len(self.chunks.lengths[1])
        wide = np.flatnonzero(self.count[0] * self.count[1] > WIDE_GROUP)
        ga = self.group[0]
        use = slice(None) if not len(wide) else ~np.isin(ga, wide)
        ga, a, doc = ga[use], self.a[use], ordinal[use]
        n = self.count[1][ga]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        b = self.b[np.repeat(self.first[1][ga], n) + inside]
        key = np.sort((np.repeat(a, n) * width + b) * BLOCK_DOCS + np.repeat(doc, n))
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        keys, links = [key[first]], [np.diff(np.append(first, len(key)))]
        for g in wide:  # by distinct ids, so repeats do not multiply
            here = [slice(f[g], f[g] + c[g]) for f, c in zip(self.first, self.count)]
            (ids_a, n_a), (ids_b, n_b) = (np.unique(t[h], return_counts=True) for t, h in zip((self.a, self.b), here))
            keys.append(((ids_a[:, None] * width + ids_b[None, :]) * BLOCK_DOCS + ordinal[here[0].start]).ravel())
            links.append((n_a[:, None] * n_b[None, :]).ravel())
        if len(keys) == 1:
            return keys[0], links[0]
        return _summed(np.concatenate(keys), np.concatenate(links))


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of ``n``."""
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


class Block:
    """Documents and their pairs, until the block closes.  Tokens wait until a
    batch of them is aligned together."""

    def __init__(self, chunks: Chunks):
        self.chunks = chunks
        self.clear()

    def clear(self) -> None:
        self.ids: list[int | None] = []
        self.digests: list = []
        self.bad: set[int] = set()
        self.waiting: list[tuple[int, bytes, bytes]] = []
        self.waiting_bytes = 0
        self.sums = np.zeros((4, BLOCK_DOCS), np.int64)
        self.keys: list[np.ndarray] = []
        self.links: list[np.ndarray] = []
        self.entries = 0

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or self.entries >= BLOCK_ENTRIES

    def add(self, doc_id: int | None, text: str | None) -> None:
        ordinal, records = len(self.ids), self.chunks
        self.ids.append(doc_id)
        self.digests.append(None)
        for run in self.chunks.runs(text or ""):
            found = [records[c] for c in run]
            if None in found:
                self.bad.add(ordinal)
                return
            a, b = b"".join([f[0] for f in found]), b"".join([f[1] for f in found])
            self.waiting.append((ordinal, a, b))
            self.waiting_bytes += len(a) + len(b)
            if self.waiting_bytes >= BATCH_BYTES:
                self.align()

    def align(self) -> None:
        if not self.waiting:
            return
        ordinals, texts_a, texts_b = zip(*self.waiting)
        n_a, n_b = (np.array([len(t) // 4 for t in texts], np.int64) for texts in (texts_a, texts_b))
        a, b = (np.frombuffer(b"".join(texts), "<u4").astype(np.int64) for texts in (texts_a, texts_b))
        self.waiting, self.waiting_bytes = [], 0
        found = Alignment(a, b, self.chunks)
        ordinal = np.repeat(np.array(ordinals, np.int64), n_a)
        key, links = found.pairs(ordinal)
        self.keys.append(key)
        self.links.append(links)
        self.entries += len(key)
        # a group belongs to the document of its last token of A
        owner = ordinal[found.last[0]]
        np.add.at(self.sums[0], np.array(ordinals), n_a)
        np.add.at(self.sums[1], np.array(ordinals), n_b)
        np.add.at(self.sums[2], owner, 1)
        np.add.at(self.sums[3], owner, found.count[0] * found.count[1])
        shown, table, at = found.shown(), self.chunks.shown, 0
        for i, n in zip(ordinals, (n_a + n_b).tolist()):
            text = "".join([table[c] for c in shown[at : at + n]])[:-1].encode()
            at += n
            if self.digests[i] is None:
                self.digests[i] = hashlib.sha256(text)
            else:
                self.digests[i].update(b";" + text)

    def tables(self) -> tuple[dict, list[tuple[int, np.ndarray, np.ndarray]]]:
        """Document columns; and per plane (pair, ordinal), sorted by both."""
        self.align()
        n = len(self.ids)
        digests = [None if i in self.bad else d for i, d in enumerate(self.digests)]
        whole = np.array([d is not None for d in digests])
        columns = {"ordinal": np.arange(n, dtype=np.int32), "doc_id": self.ids}
        columns["groups_sha256"] = [d.hexdigest() if d is not None else "" for d in digests]
        columns |= dict(zip(("n_a", "n_b", "n_groups", "n_links"), self.sums[:, :n] * whole))
        if not self.entries:
            return columns, []
        # batches that share a document share its keys
        key, more = _summed(np.concatenate(self.keys), np.concatenate(self.links))
        if self.bad:
            good = whole[key % BLOCK_DOCS]
            key, more = key[good], more[good]
        width = len(self.chunks.lengths[1])
        more = more - 1

        def split(key):
            pair, ordinal = np.divmod(key, BLOCK_DOCS)
            return (pair // width) << 32 | pair % width, ordinal

        out = [(0, *split(key))]
        plane = 1
        while more.any():
            out.append((plane, *split(key[more & 1 == 1])))
            key, more, plane = key[more > 1], more[more > 1] >> 1, plane + 1
        return columns, out


# -- the index ----------------------------------------------------------------

_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
_FIELDS = pa.schema([(n, _ARROW[t]) for n, t in (f.split() for f in INDEX.split(", "))])


def _batch(block: int, n: int, given: dict) -> pa.RecordBatch:
    """Index rows with the given columns; the others are NULL."""
    given = {"block": pa.array(np.full(n, block)), **given}
    return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(n, f.type)) for f in _FIELDS], schema=_FIELDS)


def containers(plane: int, pairs: np.ndarray, ordinals: np.ndarray, n_docs: int) -> Iterator[dict]:
    """Posting columns of one plane: sorted ordinals, or a bitmap if shorter."""
    if not len(pairs):
        return
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    docs = np.diff(np.append(first, len(pairs)))
    width = -(-n_docs // 8)
    dense = 2 * docs > width
    for kind in (False, True):
        rows = np.flatnonzero(dense == kind)
        if not len(rows):
            continue
        if kind:
            bits = np.zeros((len(rows), width * 8), np.uint8)
            for i, r in enumerate(rows):
                bits[i, ordinals[first[r] : first[r] + docs[r]]] = 1
            data, sizes = np.packbits(bits, axis=1, bitorder="little").tobytes(), np.full(len(rows), width)
        else:
            data, sizes = ordinals[np.repeat(~dense, docs)].astype("<u2").tobytes(), 2 * docs[rows]
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        pair = pairs[first[rows]]
        yield {
            "a": pa.array((pair >> 32).astype(np.int32)),
            "b": pa.array((pair & 0xFFFFFFFF).astype(np.int32)),
            "plane": pa.array(np.full(len(rows), plane, np.int32)),
            "docs": pa.array(docs[rows].astype(np.int32)),
            "dense": pa.array(np.full(len(rows), kind)),
            "bits": pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]),
        }


def build_index(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The written index: document rows (``plane`` NULL) and posting rows."""

    def closed(block: Block, number: int) -> Iterator[pa.RecordBatch]:
        columns, planes = block.tables()
        n = len(block.ids)
        yield _batch(number, n, {c: pa.array(v, _FIELDS.field(c).type) for c, v in columns.items()})
        for plane in planes:
            for rows in containers(*plane, n):
                yield _batch(number, len(rows["a"]), rows)
        block.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = Block(worker_cache(f"chunks:{path_a}:{path_b}", lambda: Chunks(path_a, path_b)))
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            ids, texts = b["doc_id"].to_pylist(), b["text"]
            for i, this in enumerate(ids):
                block.add(this, texts[i].as_py())
                if block.full():
                    yield from closed(block, number)
                    number += 1
        if block.ids:
            yield from closed(block, number)

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return staged(rows.mapInArrow(run, INDEX), "pair-index")


def pair_counts(index: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links, best): documents and links of each pair over the
    whole index, and whether no other pair of that A id is in more documents."""
    weight = F.pow(F.lit(2.0), F.greatest(F.col("plane") - 1, F.lit(0))).cast("long")
    counted = index.filter(F.col("plane").isNotNull()).groupBy("a", "b").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("docs")).otherwise(0)).cast("long").alias("n_docs"),
        F.sum(F.col("docs") * weight).cast("long").alias("n_links"),
    )
    highest = F.max("n_docs").over(Window.partitionBy("a"))
    return counted.withColumn("best", F.col("n_docs") == highest)


def _members(dense: bool, n: np.ndarray, bits: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, ordinal) of every document in containers of one kind."""
    data = np.frombuffer(b"".join(bits.to_pylist()), np.uint8)
    if not dense:
        return np.repeat(np.arange(len(n)), n), data.view("<u2").astype(np.int64)
    width = len(data) // max(len(n), 1)
    row, ordinal = np.nonzero(np.unpackbits(data.reshape(len(n), width), axis=1, bitorder="little"))
    return row, ordinal


def _return_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Posting rows with their pair's score -> partial sums of documents."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sums():
        for number, (best, count) in held.items():
            at = np.flatnonzero(count)
            columns = [np.full(len(at), number), at.astype(np.int32), best[at], count[at]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "ordinal", "n_best", "count_sum"])
        held.clear()

    for b in batches:
        blocks, dense = b["block"].to_numpy(), b["dense"].to_numpy(zero_copy_only=False)
        plane = b["plane"].to_numpy().astype(np.int64)
        weight = np.where(plane > 1, np.int64(1) << np.maximum(plane - 1, 0), 1)
        score = weight * b["n_docs"].to_numpy()
        best = weight * b["best"].to_numpy(zero_copy_only=False)
        n = b["docs"].to_numpy()
        for number in np.unique(blocks):
            if number not in held:
                if len(held) >= HELD_BLOCKS:
                    yield from sums()
                held[number] = (np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64))
            for kind in (False, True):
                rows = np.flatnonzero((blocks == number) & (dense == kind))
                if len(rows):
                    row, ordinal = _members(kind, n[rows], b["bits"].take(pa.array(rows)))
                    np.add.at(held[number][0], ordinal, best[rows][row])
                    np.add.at(held[number][1], ordinal, score[rows][row])
    yield from sums()


def align(
    docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text",
    max_broadcast: int = MAX_BROADCAST_PAIRS,
) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256."""
    index = build_index(docs, path_a, path_b, doc_id, text)
    scores = staged(pair_counts(index), "pair-scores").select("a", "b", "n_docs", "best")
    postings = index.filter(F.col("plane").isNotNull()).select("block", "a", "b", "plane", "docs", "dense", "bits")
    if small_enough(scores, max_broadcast):
        scored = postings.join(F.broadcast(scores), ["a", "b"])
    else:  # a pair has at most one row for each block and plane
        scored = postings.join(scores, ["a", "b"]).repartition("block").sortWithinPartitions("block")
    partial = scored.select("block", "plane", "docs", "dense", "bits", "n_docs", "best").mapInArrow(
        _return_scores, "block long, ordinal int, n_best long, count_sum long"
    )
    summed = partial.groupBy("block", "ordinal").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    documents = index.filter(F.col("plane").isNull()).select("block", *[f.split()[0] for f in DOCUMENT.split(", ")])
    return documents.join(summed, ["block", "ordinal"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
        "groups_sha256",
    )
