"""Fill-in-middle documents by secondary sort.

* Plan: from the digest of the doc_id, JVM-side: form, prefix and middle length.
* Pieces: every text is sliced into chunks of at most ``CHUNK`` units (code
  points) of its output, sentinels included, each keyed by its document and its
  position in the output.
* Assembly: pieces are repartitioned by document and sorted within partitions
  by (document, output position), so a task streams them, one at a time, into
  the output and its incremental digest, whatever a document's length.
* Restoration: the streamed output is read for its sentinels; its segments get
  their positions in the original and are sorted again within the partition (no
  further shuffle) and streamed into the second digest.

The document key is (map task, doc_id, two hashes of the text): rows that
repeat give equal pieces, which are assembled once and reported as often.  The
task number spreads rows that repeat without end, and keeps rows of one text
together because a row's pieces come from one task.

Defined results: a NULL text counts as empty, a NULL doc_id as the empty id; an
empty text, a text that holds a sentinel, and a seeded tenth are plain (output
is the text, lengths NULL).  Repeated rows are reported one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT, SPM_PERCENT = 10, 20
CHUNK = 4096
FLUSH_BYTES = 4 << 20

KEY = ["part", "doc_id", "k1", "k2"]
_KEY_SCHEMA = "part int, doc_id long, k1 long, k2 long"
_PLAN_SCHEMA = "n long, form string, prefix_chars long, middle_chars long"
PIECES = f"{_KEY_SCHEMA}, pos long, piece string, {_PLAN_SCHEMA}"
SEGMENTS = f"{_KEY_SCHEMA}, rank int, pos long, piece string, times int, output_sha256 string, {_PLAN_SCHEMA}"
RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def transform_text(text: str, form: str, prefix: int, middle: int) -> str:
    """One whole text (for small uses and tests; the job streams pieces)."""
    if form == "plain":
        return text
    p, m, s = text[:prefix], text[prefix : prefix + middle], text[prefix + middle :]
    return f"{PREFIX}{p}{SUFFIX}{s}{MIDDLE}{m}" if form == "psm" else f"{SUFFIX}{s}{PREFIX}{p}{MIDDLE}{m}"


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, text) of each row."""
    body = F.coalesce(docs[text], F.lit(""))
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(docs[doc_id].cast("long").cast("string"), F.lit(""))), 256)

    def h(i: int) -> Column:
        return F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("long")

    rows = docs.select(
        docs[doc_id].cast("long").alias("doc_id"), body.alias("text"), digest.alias("_digest"),
        F.length(body).cast("long").alias("n"), F.spark_partition_id().alias("part"),
    )
    one, two = h(0) % (F.col("n") + 1), h(1) % (F.col("n") + 1)
    held = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        held = held | F.contains(F.col("text"), F.lit(mark))
    plain = (F.col("n") == 0) | held | (h(2) % 100 >= 100 - PLAIN_PERCENT)
    form = F.when(plain, "plain").when(h(3) % 100 < SPM_PERCENT, "spm").otherwise("psm")
    return rows.select(
        "part", "doc_id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), F.col("text")).alias("k2"), "n",
        form.alias("form"),
        F.when(~plain, F.least(one, two)).alias("prefix_chars"),
        F.when(~plain, F.greatest(one, two) - F.least(one, two)).alias("middle_chars"),
        "text",
    )


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}


class _Rows:
    """Rows for one schema, handed on as record batches of bounded size."""

    def __init__(self, schema: str):
        self.fields = pa.schema([(n, _ARROW[t]) for n, t in (f.split() for f in schema.split(", "))])
        self.columns: list[list] = [[] for _ in self.fields]
        self.held = 0

    def add(self, *row, size: int = 64) -> None:
        for column, value in zip(self.columns, row):
            column.append(value)
        self.held += size

    def batch(self) -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.fields)]
        for column in self.columns:
            column.clear()
        self.held = 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.fields)


def _segments_of(form: str, n: int, prefix: int | None, middle: int | None) -> list[tuple]:
    """Output as a list of (sentinel,) and (start, stop) ranges of the text."""
    if form == "plain":
        return [(0, n)]
    cut = prefix + middle
    p, m, s = (0, prefix), (prefix, cut), (cut, n)
    if form == "psm":
        return [(PREFIX,), p, (SUFFIX,), s, (MIDDLE,), m]
    return [(SUFFIX,), s, (PREFIX,), p, (MIDDLE,), m]


def _emit(chunk: int):
    names = _names(f"{_KEY_SCHEMA}, {_PLAN_SCHEMA}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(PIECES)
        for b in batches:
            rows = zip(*[b[c].to_pylist() for c in names])
            texts = b["text"]
            for i, (*key, n, form, prefix, middle) in enumerate(rows):
                text, position, waiting = texts[i].as_py(), 0, ""
                for segment in _segments_of(form, n, prefix, middle):
                    if len(segment) == 1:
                        waiting += segment[0]
                        continue
                    start, stop = segment
                    while start < stop:
                        # a sentinel shares a piece with what follows it
                        take = min(stop, start + max(1, chunk - len(waiting)))
                        piece = waiting + text[start:take]
                        out.add(*key, position, piece, n, form, prefix, middle, size=len(piece) + 64)
                        position, start, waiting = position + len(piece), take, ""
                        if out.held > FLUSH_BYTES:
                            yield out.batch()
                if waiting or not position:
                    out.add(*key, position, waiting, n, form, prefix, middle)
            if out.held:
                yield out.batch()

    return run


class SentinelReader:
    """Output pieces in order -> (segment rank in the original, text) pieces.

    A sentinel may straddle pieces: the last two characters wait for the next
    piece.  ``close`` gives what waits at the end."""

    def __init__(self, form: str):
        order = {"plain": [], "psm": [PREFIX, SUFFIX, MIDDLE], "spm": [SUFFIX, PREFIX, MIDDLE]}[form]
        self.coming = list(order)
        self.rank = 0
        self.tail = ""

    def feed(self, piece: str) -> Iterator[tuple[int, str]]:
        data = self.tail + piece
        self.tail = ""
        while self.coming:
            mark = self.coming[0]
            at = data.find(mark)
            if at < 0:
                keep = min(len(data), len(mark) - 1)
                data, self.tail = data[: len(data) - keep], data[len(data) - keep :]
                break
            if at:
                yield self.rank, data[:at]
            data = data[at + len(mark) :]
            self.rank = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}[mark]
            self.coming.pop(0)
        if data:
            yield self.rank, data

    def close(self) -> Iterator[tuple[int, str]]:
        if self.coming:
            raise ValueError(f"no {self.coming[0]} in the output")
        if self.tail:
            yield self.rank, self.tail
            self.tail = ""


def restore_text(output: str, form: str) -> str:
    """The text of one whole output."""
    reader, parts = SentinelReader(form), ["", "", ""]
    for rank, piece in [*reader.feed(output), *reader.close()]:
        parts[rank] += piece
    return "".join(parts)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces -> output digests and segment pieces."""
    out = _Rows(SEGMENTS)
    key = digest = reader = meta = None
    position, times, starts = 0, 0, None

    def segments(found):
        for rank, piece in found:
            out.add(*key, rank, starts[rank], piece, None, None, None, None, None, None, size=len(piece) + 96)
            starts[rank] += len(piece)

    def finish():
        segments(reader.close())
        out.add(*key, -1, 0, None, times, digest.hexdigest(), *meta)

    for b in batches:
        columns = [b[c].to_pylist() for c in [*KEY, "pos", "n", "form", "prefix_chars", "middle_chars"]]
        pieces = b["piece"]
        for i, (*this, pos, n, form, prefix, middle) in enumerate(zip(*columns)):
            if this != key:
                if key is not None:
                    finish()
                key, digest, reader = this, hashlib.sha256(), SentinelReader(form)
                meta, position, times, starts = (n, form, prefix, middle), 0, 0, [0, 0, 0]
            if pos == 0:
                times += 1
            if pos != position or (pos == 0 and times > 1):
                continue  # the same piece of a repeated row
            piece = pieces[i].as_py()
            digest.update(piece.encode())
            position += len(piece)
            segments(reader.feed(piece))
            if out.held > FLUSH_BYTES:
                yield out.batch()
    if key is not None:
        finish()
    if out.held:
        yield out.batch()


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segment pieces in the order of the original -> one row per document."""
    out = _Rows(RESULT)
    key = digest = meta = None

    def finish():
        times, output, n, form, prefix, middle = meta
        for _ in range(times):
            out.add(key[1], n, form, prefix, middle, output, digest.hexdigest(), size=256)

    for b in batches:
        names = [*KEY, "rank", "times", "output_sha256", "n", "form", "prefix_chars", "middle_chars"]
        pieces = b["piece"]
        for i, (*this, rank, times, output, n, form, prefix, middle) in enumerate(zip(*[b[c].to_pylist() for c in names])):
            if rank < 0:
                if key is not None:
                    finish()
                key, digest, meta = this, hashlib.sha256(), (times, output, n, form, prefix, middle)
            else:
                digest.update(pieces[i].as_py().encode())
            if out.held > FLUSH_BYTES:
                yield out.batch()
    if key is not None:
        finish()
    if out.held:
        yield out.batch()


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Output pieces of all documents, each keyed by document and position."""
    return plan(docs, doc_id, text).mapInArrow(_emit(chunk), PIECES)


def assemble(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Per document: doc_id, n, form, prefix_chars, middle_chars, output_sha256
    and restored_sha256 (rebuilt from the output and the form)."""
    sorted_pieces = pieces(docs, doc_id, text, chunk).repartition(*KEY).sortWithinPartitions(*KEY, "pos")
    segments = sorted_pieces.mapInArrow(_assemble, SEGMENTS).sortWithinPartitions(*KEY, "rank", "pos")
    return segments.mapInArrow(_restore, RESULT)
