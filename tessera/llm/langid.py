"""Language identification with a byte convolutional network.

Filters of several widths slide over fixed-length byte windows, each filter
keeps its maximum per window (max pooling), and a softmax layer turns the
maxima into language probabilities.  The network is trained in numpy on the
driver, on a bounded sample of labelled rows; it is applied to every window of
every text inside Spark tasks, in batches.

A text's prediction is the language with the highest mean probability over
all its windows.  NULL text and text without any letter give ``und`` with
score 0.  Rows with a NULL label are never learned from; with no usable row
at all, every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
#: Bound of the training sample: labelled rows per language (expected value of
#: a seeded Bernoulli sample) and windows taken from each of them.
TRAIN_ROWS_PER_LANG = 400
TRAIN_WINDOWS_PER_ROW = 4
UNDETERMINED = "und"
#: Texts that a task holds as strings at a time.
TEXTS_AT_ONCE = 256


def _symbols() -> np.ndarray:
    """Byte -> symbol: padding 0, white space 1, digits 2, other ASCII 3,
    letters by lower case, and each byte above 127 for itself."""
    table = np.full(256, 3, np.uint8)
    table[[9, 10, 11, 12, 13, 32]] = 1
    table[48:58] = 2
    table[97:123] = np.arange(4, 30)
    table[65:91] = np.arange(4, 30)
    table[128:256] = np.arange(30, 158)
    return table


SYMBOLS = 158


@dataclass
class ByteCNN:
    """Weights: ``conv[w]`` is (w, SYMBOLS, FILTERS), ``bias[w]`` (FILTERS,),
    ``out`` (features, languages), ``out_bias`` (languages,)."""

    languages: list[str]
    conv: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def pair_tables(self) -> dict:
        """Filter responses for symbol pairs: one lookup covers two positions."""
        c = self.conv

        def pair(a, b):
            return (a[:, None, :] + b[None, :, :]).reshape(-1, FILTERS).astype(np.float32)

        tables = {}
        for w in WIDTHS:
            tables[w] = [pair(c[w][j], c[w][j + 1]) for j in range(0, w - 1, 2)]
            tables[w, "tail"] = c[w][w - 1].astype(np.float32) if w % 2 else None
        return tables


def windows_of(data: bytes, table: np.ndarray) -> np.ndarray:
    """All windows of a text as symbols, (n, WINDOW); the last one is padded."""
    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(data)] = table[np.frombuffer(data, np.uint8)]
    return out.reshape(n, WINDOW)


def pooled(model: ByteCNN, tables: dict, win: np.ndarray) -> np.ndarray:
    """Max-pooled, rectified filter responses of windows, (n, features)."""
    x = np.ascontiguousarray(win.T).astype(np.int32)
    pairs = x[:-1] * SYMBOLS + x[1:]
    n = win.shape[0]
    buf, add = np.empty((n, FILTERS), np.float32), np.empty((n, FILTERS), np.float32)
    parts = []
    for w in WIDTHS:
        best = np.full((n, FILTERS), -np.inf, np.float32)
        for t in range(WINDOW - w + 1):
            np.take(tables[w][0], pairs[t], axis=0, out=buf, mode="clip")
            for j in range(1, len(tables[w])):
                buf += np.take(tables[w][j], pairs[t + 2 * j], axis=0, out=add, mode="clip")
            if tables[w, "tail"] is not None:
                buf += np.take(tables[w, "tail"], x[t + w - 1], axis=0, out=add, mode="clip")
            np.maximum(best, buf, out=best)
        parts.append(np.maximum(best + model.bias[w], 0))
    return np.hstack(parts)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _start(languages: list[str], rng: np.random.Generator) -> ByteCNN:
    conv = {w: rng.normal(0, 0.3, (w, SYMBOLS, FILTERS)) for w in WIDTHS}
    bias = {w: np.zeros(FILTERS) for w in WIDTHS}
    features = FILTERS * len(WIDTHS)
    return ByteCNN(languages, conv, bias, rng.normal(0, 0.1, (features, len(languages))), np.zeros(len(languages)))


def fit_windows(win: np.ndarray, label: np.ndarray, languages: list[str], epochs: int = 12, seed: int = 7) -> ByteCNN:
    """Train on windows (n, WINDOW) and label indices by Adam on the cross
    entropy; gradients reach only the positions that won the pooling."""
    rng = np.random.default_rng(seed)
    m = _start(languages, rng)
    params = [*m.conv.values(), *m.bias.values(), m.out, m.out_bias]
    mom = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    # every language weighs the same, however many rows it has
    weight = 1.0 / np.maximum(np.bincount(label, minlength=len(languages)), 1)[label]
    weight *= len(label) / weight.sum()
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for lo in range(0, len(order), 128):
            take = order[lo : lo + 128]
            x, y, n = win[take], label[take], len(take)
            grads = [np.zeros_like(p) for p in params]
            feats, where = [], []
            for w in WIDTHS:
                span = WINDOW - w + 1
                resp = sum(m.conv[w][j][x[:, j : j + span]] for j in range(w))
                at = resp.argmax(axis=1)
                best = np.take_along_axis(resp, at[:, None, :], axis=1)[:, 0] + m.bias[w]
                feats.append(np.maximum(best, 0))
                where.append(at)
            h = np.hstack(feats)
            p = softmax(h @ m.out + m.out_bias)
            p[np.arange(n), y] -= 1
            p *= weight[take, None] / n
            grads[-2][...] = h.T @ p
            grads[-1][...] = p.sum(axis=0)
            back = (p @ m.out.T) * (h > 0)
            for k, w in enumerate(WIDTHS):
                g = back[:, k * FILTERS : (k + 1) * FILTERS]
                grads[len(WIDTHS) + k][...] = g.sum(axis=0)
                f = np.broadcast_to(np.arange(FILTERS), g.shape)
                for j in range(w):
                    sym = np.take_along_axis(x, where[k] + j, axis=1)
                    np.add.at(grads[k][j], (sym, f), g)
            step += 1
            for prm, g, (m1, m2) in zip(params, grads, mom):
                m1 += 0.1 * (g - m1)
                m2 += 0.001 * (g * g - m2)
                prm -= 0.02 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return m


def sample_rows(docs: DataFrame, text: str, label: str, learn: Column, per_lang: int) -> DataFrame:
    """A seeded sample of labelled rows, ``per_lang`` of each language in
    expectation, whatever the table's size."""
    rows = docs.select(F.col(text).alias("text"), F.col(label).cast("string").alias("label"), learn.alias("learn"))
    rows = rows.filter("learn and label is not null and text is not null and text rlike '\\\\p{L}'")
    counts = rows.groupBy("label").count()
    unit = F.pmod(F.xxhash64("text", F.lit("langid")), F.lit(1_000_000)) / F.lit(1e6)
    # one row per language: the class list of the model, which the driver holds
    return rows.join(F.broadcast(counts), "label").filter(unit < F.lit(float(per_lang)) / F.col("count")).select(
        "label", "text"
    )


def _sampled_windows(per_row: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _symbols()
        for b in batches:
            labels, wins = [], []
            for lab, text in zip(b["label"].to_pylist(), b["text"].to_pylist()):
                win = windows_of(text.encode("utf-8", "replace"), table)
                rng = np.random.default_rng(len(text))
                for w in win[rng.permutation(len(win))[:per_row]]:
                    labels.append(lab)
                    wins.append(w.tobytes())
            yield pa.RecordBatch.from_pydict(
                {"label": pa.array(labels, pa.string()), "win": pa.array(wins, pa.binary())}
            )

    return run


def train(
    docs: DataFrame,
    text: str = "text",
    label: str = "lang",
    learn: Column | None = None,
    per_lang: int = TRAIN_ROWS_PER_LANG,
    per_row: int = TRAIN_WINDOWS_PER_ROW,
    seed: int = 7,
) -> ByteCNN | None:
    """Fit the network on rows where ``learn`` holds (default: all).

    At most about ``per_lang * per_row`` windows of each language reach the
    driver (documented bound of the classifier's sample).  Returns None when
    no row has both a label and a letter.
    """
    rows = sample_rows(docs, text, label, F.lit(True) if learn is None else learn, per_lang)
    got = rows.mapInArrow(_sampled_windows(per_row), "label string, win binary").collect()
    if not got:
        return None
    got = sorted((r["label"], bytes(r["win"])) for r in got)
    languages = sorted({lab for lab, _ in got})
    win = np.frombuffer(b"".join(w for _, w in got), np.uint8).reshape(-1, WINDOW)
    # half of the windows lose their end, so short texts are seen too
    rng = np.random.default_rng(seed)
    win = win.copy()
    for i in np.flatnonzero(rng.random(len(win)) < 0.4):
        win[i, rng.integers(8, WINDOW) :] = 0
    y = np.array([languages.index(lab) for lab, _ in got])
    return fit_windows(win, y, languages, seed=seed)


def score_texts(model: ByteCNN | None, tables: dict | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; windows of many texts go through the
    network together, in blocks of a fixed number of windows."""
    names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if model is None:
        return names, scores
    symbol, block = _symbols(), 4096
    total = np.zeros((len(texts), len(model.languages)))
    count = np.zeros(len(texts))
    pending: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush():
        nonlocal pending, held
        if not pending:
            return
        owner = np.concatenate([np.full(len(w), i) for i, w in pending])
        prob = softmax(pooled(model, tables, np.concatenate([w for _, w in pending])) @ model.out + model.out_bias)
        np.add.at(total, owner, prob)
        np.add.at(count, owner, 1)
        pending, held = [], 0

    for i, t in enumerate(texts):
        if t is None or not any(map(str.isalpha, t)):
            continue
        win = windows_of(t.encode("utf-8", "replace"), symbol)
        for lo in range(0, len(win), block):
            part = win[lo : lo + block]
            pending.append((i, part))
            held += len(part)
            if held >= block:
                flush()
    flush()
    for i in np.flatnonzero(count):
        mean = total[i] / count[i]
        k = int(mean.argmax())
        names[i], scores[i] = model.languages[k], float(mean[k])
    return names, scores


def predict(docs: DataFrame, model: ByteCNN | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.pair_tables() if model else None
        for b in batches:
            names, scores = score_texts(model, tables, b["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: ByteCNN | None, text: str = "text", min_score: float = 0.34) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose language is found
    with at least ``min_score``; the rest (``und`` included) is rejected.  Only
    texts go through Python, a few at a time.
    With no model (nothing labelled), every text with a letter stays."""

    tables: list = []  # made once per task

    @F.arrow_udf("boolean")
    def identified(column: pa.Array) -> pa.Array:
        if model is not None and not tables:
            tables.append(model.pair_tables())
        keep: list[bool] = []
        for at in range(0, len(column), TEXTS_AT_ONCE):
            texts = column.slice(at, TEXTS_AT_ONCE).to_pylist()
            if model is None:
                keep += [t is not None and any(map(str.isalpha, t)) for t in texts]
            else:
                names, scores = score_texts(model, tables[0], texts)
                keep += [n != UNDETERMINED and bool(s >= min_score) for n, s in zip(names, scores)]
        return pa.array(keep, pa.bool_())

    return docs.filter(identified(docs[text]))
