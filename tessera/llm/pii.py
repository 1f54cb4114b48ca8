"""Personal data: exact base spans, and terms that give a person away.

Base spans are four patterns (e-mail, IP address, payment card, phone), found
left to right without overlap per kind; matches that fail their check are
dropped without a second try.

Information-theoretic sanitisation: a term that stands next to a protected
entity in text after text tells which entity is meant, even when the entity
itself is masked.  Over all documents, n(t, e) is the number of documents in
which term t stands within a window around entity e, and n(t) the number of
documents that hold t anywhere.  The disclosure of e by t is
log2(P(e | t) / P(e)) with P(e | t) = n(t, e) / n(t) and P(e) = n(e) / N; its
information share is that over log2(1 / P(e)), all there is to learn about e.
A pair counts if its co-occurrence is no chance: the probability of as many
common documents of independent t and e, bounded by Chernoff for draws without
replacement, stays below ``alpha`` over the number of pairs.  Terms of such
pairs whose information share and P(e | t) reach the thresholds are further
spans, kind ``term``, wherever they stand in any document; the sanitised text
replaces base spans by their kind (generalisation) and removes such terms.

n(t) is counted over every document, but only candidates (pairs that would be
significant if t stood nowhere else) need it: a Bloom filter of fixed size lets
other words through rarely, and exact counts are joined afterwards.  The second
pass over the texts finds the terms in the same way.

Defined results: NULL text is empty and has no span; empty tables give no row;
repeated rows are documents of their own, each with its own spans.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import small_enough, staged

# The patterns of the base spans and the limits of their digits.
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")
CARD_DIGITS = (13, 19)
PHONE_DIGITS = (9, 15)

#: Words on either side of an entity that count as standing next to it.
WINDOW = 6
#: Chance of any pair passing the significance test without a relation.
ALPHA = 0.01
MIN_INFORMATION = 0.75
MIN_SHARE = 0.5
#: Up to this many terms are looked up in a set that every task holds.
MAX_BROADCAST_TERMS = 100_000
#: Size of the Bloom filter of candidate terms (the bound of what is sent to
#: every task); a fuller filter only lets more words through.
BLOOM_BITS = 1 << 23
BLOOM_HASHES = 3

WORD = re.compile(r"[^\W_]+")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def email_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of local part, @ and dotted domain, left to right.

    A match's local part is the run of local characters before its @, so the
    search goes from one @ to the next and stays linear on any text."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append(("email", start, domain.end()))
            last = domain.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", max(last, at + 1))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; code points."""
    out = email_spans(text)
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            n = sum(c.isdigit() for c in m[0])
            if PHONE_DIGITS[0] <= n <= PHONE_DIGITS[1]:
                out.append(("phone", m.start(), m.end()))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def near_terms(text: str, spans: list[tuple[str, int, int]], window: int = WINDOW) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of the words around each base span; the same
    occurrence is listed once per entity."""
    taken = sorted((s, e) for _, s, e in spans)
    out, seen = [], set()
    for kind, start, end in spans:
        entity = f"{kind}:{re.sub(r'[^0-9A-Za-z@.]', '', text[start:end]).lower()}"
        left = list(WORD.finditer(text, max(0, start - 24 * window), start))[-window:]
        right, at = [], end
        while len(right) < window and (m := WORD.search(text, at, min(len(text), end + 24 * window))):
            right.append(m)
            at = m.end()
        for m in left + right:
            if any(s < m.end() and m.start() < e for s, e in taken):
                continue
            key = (entity, m.start())
            if key not in seen:
                seen.add(key)
                out.append((entity, m[0].lower(), m.start(), m.end()))
    return out


def words_of(text: str) -> set[str]:
    """Distinct words in lower case, each folded by itself."""
    return {w.lower() for w in set(WORD.findall(text))}


def near_rows(docs: DataFrame, text: str, window: int) -> DataFrame:
    """(row, near): the terms around the entities of every row that has one;
    written once."""
    near_type = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = []
            for t in b["text"]:
                s = t.as_py() or ""
                spans = base_spans(s)
                if spans:
                    around = {(entity, term) for entity, term, _, _ in near_terms(s, spans, window)}
                    near.append([{"entity": e, "term": t} for e, t in sorted(around)])
            yield pa.RecordBatch.from_arrays([pa.array(near, near_type)], ["near"])

    found = docs.select(docs[text].alias("text")).mapInArrow(run, "near array<struct<entity:string,term:string>>")
    return staged(found.withColumn("row", F.monotonically_increasing_id()), "pii-near")


def marked_rows(docs: DataFrame, doc_id: str, text: str, holds) -> DataFrame:
    """Per row: row number, doc_id, counts, base spans, and every occurrence of
    a word that ``holds()`` tells to be a term; written once."""
    schema = (
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, "
        "held array<struct<term:string,start:int,stop:int>>"
    )
    held_type = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_term = holds()
        for b in batches:
            counts: list[list[int]] = [[], [], [], []]
            base, held = [], []
            for t in b["text"]:
                s = t.as_py() or ""
                spans = base_spans(s)
                n = Counter(k for k, _, _ in spans)
                for c, k in zip(counts, KINDS):
                    c.append(n[k])
                base.append(joined(spans))
                # places are needed only in texts that hold a term
                found = []
                if is_term is not None and any(map(is_term, words_of(s))):
                    covered = bytearray(len(s))
                    for _, lo, hi in spans:
                        covered[lo:hi] = b"\1" * (hi - lo)
                    for m in WORD.finditer(s):
                        w = m[0].lower()
                        if is_term(w) and not any(covered[m.start() : m.end()]):
                            found.append({"term": w, "start": m.start(), "stop": m.end()})
                held.append(found)
            yield pa.RecordBatch.from_arrays(
                [
                    b["doc_id"],
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array(base, pa.string()),
                    pa.array(held, held_type),
                ],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "held"],
            )

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    found = rows.mapInArrow(run, schema)
    return staged(found.withColumn("row", F.monotonically_increasing_id()), "pii-spans")


def _bloom(terms: DataFrame) -> np.ndarray:
    """Bloom filter of the candidate terms; tasks hand on set bit numbers."""
    bits = F.explode(
        F.array(*[F.pmod(F.crc32(F.concat(F.lit(f"{i}:"), F.col("term")).cast("binary")), F.lit(BLOOM_BITS)) for i in range(BLOOM_HASHES)])
    )
    got = terms.select(bits.alias("bit")).distinct().toArrow()
    field = np.zeros(BLOOM_BITS, bool)
    field[got["bit"].to_numpy()] = True
    return np.packbits(field)


def _lookup(field: np.ndarray):
    """Test of words against a Bloom filter, for one task."""

    def make():
        bits, known = np.unpackbits(field).tobytes(), {}

        def hit(w: str) -> bool:
            found = known.get(w)
            if found is None:
                raw = w.encode("utf-8", "replace")
                found = all(bits[zlib.crc32(b"%d:" % i + raw) % BLOOM_BITS] for i in range(BLOOM_HASHES))
                if len(known) < 300_000:
                    known[w] = found
            return found

        return hit

    return make


def _document_counts(docs: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """(term, n): documents of the whole table that hold each candidate."""
    lookup = _lookup(_bloom(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit = lookup()
        for b in batches:
            count: Counter = Counter()
            for t in b["text"]:
                count.update(filter(hit, words_of(t.as_py() or "")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["term", "n"]
            )

    counted = docs.select(docs[text].alias("text")).mapInArrow(run, "term string, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("n")).join(terms, "term", "left_semi")


def log_chance(both: Column, n: Column, rate: Column) -> Column:
    """Upper bound of ln P(at least ``both`` of ``n`` documents hold an entity
    that a share ``rate`` of all documents holds), by Hoeffding: -n KL(both/n | rate)."""
    share = both / n
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    return F.when(share > rate, -n * (share * F.log(share / rate) + rest)).otherwise(0.0)


def revealing_terms(
    docs: DataFrame, text: str, window: int, alpha: float, min_information: float, min_share: float, min_bits: float
) -> DataFrame:
    """(term): words that disclose an entity."""
    rows = near_rows(docs, text, window)
    near = rows.select("row", F.explode("near").alias("x")).select("row", "x.entity", "x.term")
    together = staged(near.groupBy("entity", "term").agg(F.count("*").alias("both")), "pii-together")
    tests = together.count()
    if not tests:
        return together.select("term")
    level = math.log(alpha / tests)
    holds = near.select("row", "entity").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    rate = F.col("n_entity") / F.lit(float(docs.count()))
    pairs = together.join(holds, "entity").withColumn("rate", rate)
    # a term's other documents only make the chance greater
    pairs = staged(pairs.filter((F.col("rate") < 1) & (F.col("both") * F.log("rate") <= level)), "pii-pairs")
    if pairs.isEmpty():
        return pairs.select("term")
    joined_ = pairs.join(_document_counts(docs, text, pairs.select("term").distinct()), "term")
    n = F.greatest("n", "both")
    share = F.col("both") / n
    bits = F.log2(share / F.col("rate"))
    reached = (share >= min_share) & (bits >= min_bits) & (bits >= min_information * -F.log2("rate"))
    return joined_.filter(reached & (log_chance(F.col("both"), n, F.col("rate")) <= level)).select("term").distinct()


def find(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    alpha: float = ALPHA,
    min_information: float = MIN_INFORMATION,
    min_share: float = MIN_SHARE,
    min_bits: float = 0.0,
) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base (spans), spans
    (base ones, then ``term`` ones).  ``min_bits`` is a further limit of the
    disclosure in bits."""
    terms = staged(revealing_terms(docs, text, window, alpha, min_information, min_share, min_bits), "pii-terms")
    few = small_enough(terms, MAX_BROADCAST_TERMS)
    if few:
        known = frozenset(terms.toArrow()["term"].to_pylist())
        rows = marked_rows(docs, doc_id, text, lambda: known.__contains__ if known else None)
        extra = F.col("held")
    else:
        # the filter's rare other words go in the join
        rows = marked_rows(docs, doc_id, text, _lookup(_bloom(terms)))
        held = rows.select("row", F.explode("held").alias("x")).join(terms, F.col("x.term") == terms["term"], "left_semi")
        more = held.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("x.start", "x.stop"))).alias("extra"))
        rows = rows.join(more, "row", "left")
        extra = F.col("extra")
    listed = F.transform(extra, lambda x: F.concat(F.lit("term:"), x["start"], F.lit(":"), x["stop"]))
    listed = F.when(F.size(extra) > 0, F.array_join(listed, ","))
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), listed)
    return rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", spans.alias("spans"))


def sanitise(text: str | None, spans: str) -> str:
    """A text with base spans generalised to their kind and revealing terms
    removed; overlapping spans are replaced together."""
    text = text or ""
    parts = sorted((int(s), int(e), k) for k, s, e in (p.split(":") for p in spans.split(",") if p))
    out, at = [], 0
    for s, e, k in parts:
        if s >= at:
            out.append(text[at:s])
            if k != "term":
                out.append(f"[{k}]")
        at = max(at, e)
    return "".join(out) + text[at:]


def base_digest(base: str) -> str:
    return hashlib.sha256(base.encode()).hexdigest()
