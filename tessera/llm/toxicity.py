"""Toxicity scores of texts restored by a noisy-channel decoder.

* Language model: character trigram counts over every text of the corpus,
  counted in Spark tasks and summed; smoothed by interpolation.
* Channel: a hidden character may be written as itself, as a look-alike
  (leetspeak), several times in a row, or followed by separators.  Every span
  with a character of the channel (a token with a look-alike, an inner separator
  or a repeated letter; single characters set apart by separators) becomes a
  character lattice, and Viterbi finds the likeliest hidden text.
* Classifier: words and word beginnings of the restored texts.  Those that set
  toxic rows apart from clean ones are learned on one half of a bounded sample
  of labelled rows; a logistic model over their weights is fitted on the other.
* Scoring: every text is read whole, its suspicious spans are restored, and
  the logistic model gives the score.

Defined results: NULL and empty texts get the model's score of a text without
any marker; without labelled rows of both classes every score is 0.  Repeated
rows are scored alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged

#: Bounds of the labelled sample (expected numbers of a seeded sample).
SAMPLE_TOXIC = 4000
SAMPLE_CLEAN = 8000
#: A marker occurs in this many toxic sample rows, and this much more often in
#: toxic rows than in clean ones.
MIN_ROWS = 5
MIN_RATIO = 15.0
PREFIXES = (3, 4, 5, 6)

# Look-alike symbols and the letters they stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
SEPARATORS = " .-_*"
ALPHABET = " abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
OTHER = len(ALPHABET)
SYMBOLS = OTHER + 1
#: Longer spans are restored anew each time.
LONGEST_KEPT = 64
#: After so many positions, what all paths share is written out.
SETTLE = 1024

#: A token with a look-alike, a repeated letter or an inner separator.
HINT = re.compile(r"[0-9@$!|+]|([^\W\d_])\1|[^\W_][.\-_*]+(?:[^\W_]|[@$!|+])")
SPACED = re.compile(r"(?<![^\W_])(?:[^\W_]|[@$!|+])(?:[ .\-_*]+(?:[^\W_]|[@$!|+])(?![^\W_])){2,}")
EDGES = ".,;:?\"'()[]"
PUNCTUATION = bytes.maketrans(bytes(range(33, 48)) + bytes(range(58, 65)) + b"[\\]^_`{|}~", b" " * 32)


def symbol_table() -> np.ndarray:
    """Latin-1 byte -> symbol; letters fold to lower case."""
    table = np.full(256, OTHER, np.int32)
    for i, c in enumerate(ALPHABET):
        table[ord(c)] = i
        up = c.upper()
        if len(up) == 1 and ord(up) < 256:
            table[ord(up)] = i
    table[[9, 10, 11, 12, 13]] = 0
    return table


def trigram_counts(docs: DataFrame, text: str) -> np.ndarray:
    """Counts of symbol trigrams over all texts, (SYMBOLS,) * 3.

    Tasks count with numpy and hand on at most SYMBOLS**3 sums each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = symbol_table(), np.zeros(SYMBOLS**3, np.int64)
        for b in batches:
            for t in b["text"]:
                if not t.is_valid:
                    continue
                s = table[np.frombuffer(f" {t.as_py()} ".encode("latin-1", "replace"), np.uint8)]
                for lo in range(0, len(s), 1 << 20):
                    x = s[lo : lo + (1 << 20) + 2]
                    if len(x) > 2:
                        total += np.bincount((x[:-2] * SYMBOLS + x[1:-1]) * SYMBOLS + x[2:], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["gram", "n"])

    found = docs.select(docs[text].alias("text")).mapInArrow(run, "gram long, n long")
    got = found.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SYMBOLS**3)
    out[got["gram"].to_numpy()] = got["n"].to_numpy()
    return out.reshape((SYMBOLS,) * 3)


def log_model(counts: np.ndarray) -> np.ndarray:
    """Interpolated log probabilities of the third symbol after two."""
    uni = counts.sum(axis=(0, 1)) + 0.5
    uni /= uni.sum()
    two = counts.sum(axis=0)
    bi = (two + 20 * uni) / (two.sum(axis=1, keepdims=True) + 20)
    tri = (counts + 20 * bi[None, :, :]) / (counts.sum(axis=2, keepdims=True) + 20)
    return np.log(tri).astype(np.float32)


class Decoder:
    """Viterbi over the character lattice of one span."""

    #: Log probabilities of the channel.
    LOOK_ALIKE, SAME_DIGIT, DROPPED, KEPT, RUN = -2.0, -6.0, -0.7, -0.7, -1.5

    def __init__(self, model: np.ndarray):
        self.model = model
        self.flat = model.ravel().tolist()
        self.index = {c: i for i, c in enumerate(ALPHABET)}
        self.cache: dict[str, str] = {}
        self.words: dict[str, tuple[bytes, ...]] = {}

    def choices(self, span: str) -> Iterator[list[tuple[str, float]]]:
        """Per position of the observed span, hidden strings of up to two
        characters with their channel scores."""
        i = 0
        while i < len(span):
            c, run = span[i], 1
            while i + run < len(span) and (span[i + run] == c or c in SEPARATORS and span[i + run] in SEPARATORS):
                run += 1
            if c in LEET:
                hidden = [(h, self.LOOK_ALIKE) for h in LEET[c]] + [(c, self.SAME_DIGIT)]
            elif c in SEPARATORS:
                # separators in a row hide nothing, or stand for a word's end
                hidden = [("", self.DROPPED), (" ", self.KEPT)]
            else:
                hidden = [(c, 0.0)]
            if run > 1 and c not in SEPARATORS:
                # a run stands for one letter, a double letter, or (short) itself
                hidden = [(h * k, s + self.RUN * (k == 1)) for h, s in hidden for k in (1, 2)]
            yield hidden
            i += run

    def decode(self, span: str) -> str:
        found = self.cache.get(span)
        if found is not None:
            return found
        # state: the last two hidden symbols; value: (score, path), a path
        # being [path before, hidden string]
        model, index, n = self.flat, self.index, SYMBOLS
        root: list = [None, ""]
        states: dict[tuple[int, int], tuple[float, list]] = {(OTHER, 0): (0.0, root)}
        done: list[str] = []
        for at, hidden in enumerate(self.choices(span), 1):
            after: dict[tuple[int, int], tuple[float, list, str]] = {}
            for (a, b), (score, path) in states.items():
                for h, channel in hidden:
                    s, x, y = score + channel, a, b
                    for c in h:
                        z = index.get(c, OTHER)
                        s += model[(x * n + y) * n + z]
                        x, y = y, z
                    old = after.get((x, y))
                    if old is None or s > old[0]:
                        after[x, y] = (s, path, h)
            states = {k: (s, [path, h]) for k, (s, path, h) in after.items()}
            if at % SETTLE == 0:
                done += self.settle([path for _, path in states.values()])
        # a word ends after the span
        best = max(states.items(), key=lambda kv: kv[1][0] + model[(kv[0][0] * n + kv[0][1]) * n])
        text = "".join(done + self.settle([best[1][1]]))
        if len(span) <= LONGEST_KEPT and len(self.cache) < 200_000:
            self.cache[span] = text
        return text

    @staticmethod
    def settle(paths: list[list]) -> list[str]:
        """The strings that all paths share, cut off from them."""
        chains = []
        for path in paths:
            chain = []
            while path is not None:
                chain.append(path)
                path = path[0]
            chains.append(chain[::-1])
        shared = []
        for step in zip(*chains):
            if any(p is not step[0] for p in step):
                break
            shared.append(step[0])
        out = [p[1] for p in shared]
        if shared:
            # the last shared one stays as the new root
            shared[-1][:] = [None, ""]
        return out


def readings(token: str, decoder: Decoder) -> tuple[bytes, ...]:
    """Words of a token's restored forms that it does not show itself; a mark
    at its end may be a letter or punctuation, so both are read."""
    found = decoder.words.get(token)
    if found is None:
        forms = {t for t in (token.strip(EDGES), token.strip(EDGES + "!|+")) if HINT.search(t)}
        shown = set(token.encode("utf-8", "replace").translate(PUNCTUATION).split())
        out: set[bytes] = set()
        for f in forms:
            out.update(decoder.decode(f).encode("utf-8", "replace").translate(PUNCTUATION).split())
        found = tuple(sorted(out - shown))
        if len(token) <= LONGEST_KEPT and len(decoder.words) < 200_000:
            decoder.words[token] = found
    return found


def restored_words(text: str, decoder: Decoder) -> set[str]:
    """Distinct words of a text, together with those of its restored spans."""
    low = text.lower()
    words = set(low.encode("utf-8", "replace").translate(PUNCTUATION).split())
    for m in SPACED.finditer(low):
        words.update(decoder.decode(m[0]).encode("utf-8", "replace").translate(PUNCTUATION).split())
    for token in set(low.split()):
        words.update(readings(token, decoder))
    return words


def markers_of(words: set[bytes]) -> set[str]:
    """Features of a text: whole words and word beginnings."""
    out = set()
    for raw in words:
        w = raw.decode("utf-8", "replace")
        out.add("=" + w)
        out.update([w[:n] for n in PREFIXES if len(w) > n])
    return out


@dataclass
class ToxicityModel:
    weight: dict[str, float] = field(default_factory=dict)
    beta: np.ndarray | None = None
    trigrams: np.ndarray | None = None

    def summary(self, words: set[bytes]) -> tuple[float, float, float]:
        """Strongest marker, number of marked words, and their share."""
        top, hits, get = 0.0, 0, self.weight.get
        for raw in words:
            w = raw.decode("utf-8", "replace")
            best = get("=" + w, 0.0)
            for n in PREFIXES:
                if len(w) > n:
                    best = max(best, get(w[:n], 0.0))
            if best:
                hits += 1
                top = max(top, best)
        return top, np.log1p(hits), 10.0 * hits / (len(words) + 20)

    def score(self, words: set[bytes]) -> float:
        if self.beta is None:
            return 0.0
        z = float(self.beta[0] + np.dot(self.beta[1:], self.summary(words)))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by damped Newton steps with a small ridge."""
    x = np.hstack([np.ones((len(x), 1)), x])
    beta = np.zeros(x.shape[1])
    ridge = np.diag([1e-3] + [0.05] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (p - y) + ridge @ beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge
        beta = beta - np.linalg.solve(hess, grad)
        if np.abs(grad).max() < 1e-6:
            break
    return beta


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str, text: str, label: str) -> DataFrame:
    """(half, toxic, text): seeded rows of both classes within the bounds."""
    marks = labels.select(labels[doc_id].cast("long").alias("doc_id"), labels[label].cast("int").alias("toxic"))
    marks = marks.filter(learn & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = F.when(F.col("toxic") == 1, F.lit(min(1.0, SAMPLE_TOXIC / max(1, n.get(1, 0))))).otherwise(
        F.lit(min(1.0, SAMPLE_CLEAN / max(1, n.get(0, 0))))
    )
    unit = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_000)) / F.lit(1e6)
    # at most the bounds' number of rows in expectation, ids and labels only
    picked = marks.filter(unit < rate).withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int"))
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return staged(rows.join(F.broadcast(picked), "doc_id").select("half", "toxic", "text").repartition(16), "labelled")


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> ToxicityModel:
    """Language model over all texts, markers and logistic model over a bounded
    sample of the labelled rows where ``learn`` (over ``doc_id``) holds."""
    trigrams = log_model(trigram_counts(docs, text))
    sample = labelled_sample(docs, labels, F.lit(True) if learn is None else learn, doc_id, text, label)
    sizes = {(r["half"], r["toxic"]): r["count"] for r in sample.groupBy("half", "toxic").count().collect()}
    if not all(sizes.get((h, t)) for h in (0, 1) for t in (0, 1)):
        return ToxicityModel(trigrams=trigrams)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(trigrams)
        for b in batches:
            count: Counter = Counter()
            for tox, t in zip(b["toxic"].to_pylist(), b["text"]):
                for m in markers_of(restored_words(t.as_py() or "", decoder)):
                    count[m, tox] += 1
            keys = list(count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([count[k] for k in keys], pa.int64()),
                ],
                ["marker", "toxic", "n"],
            )

    seen = sample.filter("half = 0").select("toxic", "text").mapInArrow(emit, "marker string, toxic int, n long")
    sums = seen.groupBy("marker").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"),
    )
    n_bad, n_good = sizes[0, 1], sizes[0, 0]
    ratio = ((F.col("bad") + 0.1) / n_bad) / ((F.col("good") + 0.1) / n_good)
    kept = sums.filter((F.col("bad") >= MIN_ROWS) & (ratio >= MIN_RATIO)).select("marker", F.log(ratio).alias("w"))
    model = ToxicityModel({r["marker"]: float(r["w"]) for r in kept.collect()}, None, trigrams)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(trigrams)
        for b in batches:
            rows = [model.summary(restored_words(t.as_py() or "", decoder)) for t in b["text"]]
            cols = [pa.array([float(r[i]) for r in rows], pa.float64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([b["toxic"], *cols], ["toxic", "a", "b", "c"])

    other = sample.filter("half = 1").select("toxic", "text")
    got = other.mapInArrow(summarise, "toxic int, a double, b double, c double").toArrow()
    x = np.column_stack([got[c].to_numpy() for c in ("a", "b", "c")])
    order = np.lexsort((x[:, 2], x[:, 1], x[:, 0]))
    model.beta = _logistic(x[order], got["toxic"].to_numpy()[order].astype(float))
    return model


def score(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, restored): the score of every whole text, and how many
    of its spans the decoder restored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model.trigrams)
        for b in batches:
            scores = [float(model.score(restored_words(t.as_py() or "", decoder))) for t in b["text"]]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def restore(text: str, model: ToxicityModel) -> str:
    """A text with its suspicious spans decoded (for inspection)."""
    decoder = Decoder(model.trigrams)
    text = SPACED.sub(lambda m: decoder.decode(m[0].lower()), text)
    return re.sub(
        r"\S+",
        lambda m: decoder.decode(m[0].lower()) if HINT.search(m[0].lower()) else m[0],
        text,
    )
