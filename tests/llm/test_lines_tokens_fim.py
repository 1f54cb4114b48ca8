"""Line removal, cross-tokenizer alignment and fill-in-middle, each against a
row-by-row version."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import cross_tokens, fim, line_dedup, queries

A, B = (public_tokenizers.path(n) for n in queries.ALIGNED)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_row(values):
    return sorted(values, key=str)


# -- op11 ---------------------------------------------------------------------


def line_key(line):
    bare = line.strip(" \t\n\x0b\f\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in bare)


def brute_lines(rows, min_docs, min_chars=1):
    count = Counter(k for r in rows for k in {line_key(x) for x in (r[1] or "").split("\n")} if len(k) >= min_chars)
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        stay = [x for x in lines if len(line_key(x)) < min_chars or count[line_key(x)] < min_docs]
        out.append((r[0], len(lines), len(lines) - len(stay), sha("\n".join(stay))))
    return by_row(out)


def line_rows(rows):
    """The odd rows and rows with shared lines in several spellings."""
    rng = random.Random(5)
    shared = ["Cookie NOTICE", "  cookie notice\t", "ÉTÉ", "été", "", " ", "\r", "x", "X", "a\x1cb"]
    own = [f"line {i}" for i in range(40)]
    more = []
    for i in range(60):
        lines = [rng.choice(shared + own) for _ in range(rng.randint(1, 12))]
        more.append((1000 + i, "\n".join(lines), "en", "a", 0))
    more.append((2000, "\n".join(["cookie notice"] * 20_000), "en", "a", 0))
    return rows + more + more[:3]


def run_lines(df, **kw):
    out = line_dedup.drop_lines(df, **kw)
    return by_row(
        tuple(r) for r in out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256)).collect()
    )


@pytest.mark.parametrize("min_docs,min_chars,max_broadcast", [(10, 1, 1000), (3, 1, 1000), (3, 3, 1000), (3, 1, 2), (2, 1, 1)])
def test_lines_against_brute_force(make, rows, min_docs, min_chars, max_broadcast):
    table = line_rows(rows)
    got = run_lines(make(table), min_docs=min_docs, min_chars=min_chars, max_broadcast=max_broadcast)
    assert got == brute_lines(table, min_docs, min_chars)


def test_lines_keep_rows_and_columns(make, rows, no_docs):
    table = line_rows(rows)
    df = make(table)
    out = line_dedup.drop_lines(df, min_docs=10)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    key = ["doc_id", "lang", "source", "key", "kept"]
    assert Counter(map(tuple, out.select(*key).collect())) == Counter(map(tuple, df.select(*key).collect()))
    untouched = out.filter("n_dropped = 0 and text is null").count()
    assert untouched == sum(r[1] is None for r in table)
    assert line_dedup.drop_lines(no_docs).collect() == []
    again = line_dedup.drop_lines(out, min_docs=10)  # its own columns come in again
    assert again.columns == out.columns


def test_hot_line_lookup_separates_equal_first_hashes(spark):
    hot = spark.createDataFrame([(5, 1), (5, 2), (9, 1)], "h1 long, h2 long")
    df = spark.createDataFrame([([5, 5, 9, 9, 1], [2, 3, 1, 2, 1]), ([], []), ([5], [1])], "a array<long>, b array<long>")
    kept = [r[0] for r in df.coalesce(1).select(line_dedup._kept_positions(hot)("a", "b")).collect()]
    assert kept == [[1, 3, 4], [], []]


# -- op12 ---------------------------------------------------------------------


def brute_alignment(rows):
    """Whole texts, byte offsets and dictionaries; the libraries themselves."""
    import sentencepiece
    from tokenizers import Tokenizer

    lib_a, lib_b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    lib_a.encode_special_tokens = True
    shown = {b: chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    rest = [b for b in range(256) if b not in shown]
    byte_of = {v: k for k, v in {**shown, **{b: chr(256 + i) for i, b in enumerate(rest)}}.items()}
    docs, count = [], Counter()
    for r in rows:
        text, found = r[1] or "", None
        if text:
            raw = (" " + text).encode()
            a, b = lib_a.encode(" " + text, add_special_tokens=False).ids, lib_b.encode(text)
            a_bytes = [bytes(byte_of[c] for c in lib_a.id_to_token(t)) for t in a]
            b_bytes = []
            for t in b:
                p = lib_b.id_to_piece(t)
                b_bytes.append(bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode())
            if b"".join(a_bytes) == raw == b"".join(b_bytes):
                groups, ends_a, ends_b = defaultdict(lambda: ([], [])), [], []
                for ends, tokens in ((ends_a, a_bytes), (ends_b, b_bytes)):
                    at = 0
                    for t in tokens:
                        at += len(t)
                        ends.append(at)
                cuts = sorted(set(ends_a) & set(ends_b))
                group_at = {}
                for ends in (ends_a, ends_b):
                    k = 0
                    for e in ends:
                        while cuts[k] < e:
                            k += 1
                        group_at[e] = k
                for t, e in zip(a, ends_a):
                    groups[group_at[e]][0].append(t)
                for t, e in zip(b, ends_b):
                    groups[group_at[e]][1].append(t)
                links = Counter((x, y) for left, right in groups.values() for x in left for y in right)
                shown_groups = ";".join(
                    ",".join(map(str, groups[k][0])) + "|" + ",".join(map(str, groups[k][1])) for k in sorted(groups)
                )
                found = (len(a), len(b), len(groups), links, shown_groups)
                count.update(links.keys())
        docs.append((r[0], found))
    top = Counter()
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for doc, found in docs:
        if found is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, groups = found
        best = sum(m for p, m in links.items() if count[p] == top[p[0]])
        total = sum(m * count[p] for p, m in links.items())
        out.append((doc, n_a, n_b, n_groups, sum(links.values()), best, total, sha(groups)))
    return by_row(out), count


def token_rows(rows):
    more = [
        (3000, "two  spaces   three \n\n newline \t tab\r\n end ", "en", "a", 0),
        (3001, " leading", "en", "a", 0),
        (3002, " ", "en", "a", 0),
        (3003, "holds ▁ the mark", "en", "a", 0),
        (3004, "<s> </s> <unk> <0x41> <|endoftext|> it's we'll", "en", "a", 0),
        (3005, "漢字 かな 🙂🙃  nbsp　wide   line \x85 \x1f x", "en", "a", 0),
        (3006, "a" * 5000 + " " + "é" * 300 + "\n" * 40 + " " * 70 + "x", "en", "a", 0),
        (3007, "nul \0 byte", "en", "a", 0),
        (3008, "123456789 1,234.5 --- ### def f(x):\n    return x\n", "en", "a", 0),
    ]
    return rows + more + more[:2]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def aligned(rows, spark):
    table = token_rows(rows)
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()
    table = table + [tuple(r)[:2] + ("en", "a", 0) for r in real]
    return table, *brute_alignment(table)


@pytest.mark.parametrize("max_broadcast", [10**6, 0])
def test_alignment_against_brute_force(make, aligned, max_broadcast):
    table, want, _ = aligned
    got = cross_tokens.align(make(table), A, B, max_broadcast=max_broadcast).select(*COLUMNS).collect()
    assert by_row(map(tuple, got)) == want


def test_pair_counts_and_link_counts(make, aligned):
    table, want, count = aligned
    pairs = cross_tokens.pair_counts(cross_tokens.build_index(make(table), A, B)).collect()
    assert {(r["a"], r["b"]): r["n_docs"] for r in pairs} == dict(count)
    assert sum(r["n_links"] for r in pairs) == sum(r[4] for r in want)


def documents(block):
    found = block.tables()[0]
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return by_row((r[0], *map(int, r[1:5]), r[5]) for r in zip(*(found[n] for n in names)))


def test_small_batches_and_runs(aligned, monkeypatch):
    table, want, count = aligned
    monkeypatch.setattr(cross_tokens, "RUN_CHARS", 50)
    chunks = cross_tokens.Chunks(A, B)
    assert chunks.cuts
    for r in table:
        if r[1]:
            runs = list(chunks.runs(r[1]))
            assert " ".join(" ".join(run) for run in runs) == r[1]
    monkeypatch.setattr(cross_tokens, "BATCH_BYTES", 400)
    monkeypatch.setattr(cross_tokens, "WIDE_GROUP", 3)
    block = cross_tokens.Block(chunks)
    for r in table:
        block.add(r[0], r[1])
    assert documents(block) == by_row((w[0], *w[1:5], w[7]) for w in want)
    (_, pairs, _), *_ = block.tables()[1]
    assert Counter((int(p) >> 32, int(p) & 0xFFFFFFFF) for p in pairs) == count


def test_alignment_without_chunks_and_of_nothing(no_docs, make, monkeypatch):
    assert cross_tokens.align(no_docs, A, B).collect() == []
    nothing = cross_tokens.align(make([(1, None, None, None, None), (2, "", "en", "a", 0)]), A, B).select(*COLUMNS).collect()
    assert by_row(map(tuple, nothing)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    whole = cross_tokens.Chunks(A, B)
    whole.cuts = False
    cut = cross_tokens.Chunks(A, B)
    text = "It's two  spaces, 漢字 and\n more words"
    one, two = cross_tokens.Block(whole), cross_tokens.Block(cut)
    one.add(1, text)
    two.add(1, text)
    assert documents(one) == documents(two)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 299), st.integers(1, 9)), max_size=300))
def test_containers_round_trip(found):
    """Pairs, ordinals and multiplicities survive bitmaps and planes."""
    links = {(p, o): m for p, o, m in found}
    if not links:
        return
    width, total = 50, Counter()
    block = cross_tokens.Block(SimpleNamespace(lengths=[None, np.ones(width)]))
    block.ids, block.digests = [None] * 300, [hashlib.sha256()] * 300
    keys = sorted(links)
    for part in (keys[::2], keys[1::2], keys[:3]):  # the last batch meets keys again
        block.keys.append(np.array([(p * width + 7) * cross_tokens.BLOCK_DOCS + o for p, o in part], np.int64))
        block.links.append(np.array([links[k] for k in part], np.int64))
    block.entries = len(keys)
    for k in keys[:3]:
        links[k] *= 2
    for plane, pairs, ordinals in block.tables()[1]:
        for rows in cross_tokens.containers(plane, pairs, ordinals, 300):
            n = rows["docs"].to_numpy()
            for kind in (False, True):
                at = np.flatnonzero(rows["dense"].to_numpy(zero_copy_only=False) == kind)
                if len(at):
                    row, ordinal = cross_tokens._members(kind, n[at], rows["bits"].take(pa.array(at)))
                    for r, o in zip(row, ordinal):
                        assert rows["b"][int(at[r])].as_py() == 7
                        total[rows["a"][int(at[r])].as_py(), int(o)] += 1 if plane == 0 else 2 ** (plane - 1)
    assert dict(total) == links


# -- op13 ---------------------------------------------------------------------


def brute_fim(rows):
    out = []
    for doc, text, *_ in rows:
        text = text or ""
        digest = sha(f"1:{'' if doc is None else doc}")
        h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
        n = len(text)
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        p, m, s = text[:a], text[a:b], text[b:]
        if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
            out.append((doc, n, "plain", None, None, sha(text), sha(text)))
        elif h4 % 100 < 20:
            out.append((doc, n, "spm", a, b - a, sha(f"<S>{s}<P>{p}<M>{m}"), sha(text)))
        else:
            out.append((doc, n, "psm", a, b - a, sha(f"<P>{p}<S>{s}<M>{m}"), sha(text)))
    return by_row(out)


def fim_rows(rows):
    more = [(4000 + i, "ab<S"[: i % 5] + "é🙂<" * (i % 7) + "P" * (i % 3) + ">", "en", "a", 0) for i in range(120)]
    more += [(5000, "has <M> in it", "en", "a", 0), (5001, "x<P>", "en", "a", 0), (None, "same", "en", "a", 0)]
    more += [(5002, "repeated row " * 30, "en", "a", 0)] * 7 + [(5002, "other text, same id", "en", "a", 0)]
    more += [(None, "same", "en", "a", 0)] * 2
    return rows + more


FIM_COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


@pytest.mark.parametrize("chunk", [1, 7, 4096])
def test_fill_in_middle_against_brute_force(make, rows, chunk):
    table = fim_rows(rows)
    if chunk < 100:
        table = [r for r in table if len(r[1] or "") < 1000]
    got = fim.assemble(make(table), chunk=chunk).select(*FIM_COLUMNS).collect()
    assert by_row(map(tuple, got)) == brute_fim(table)


def test_fill_in_middle_streams_sorted_pieces(make, rows, no_docs):
    assert fim.assemble(no_docs).collect() == []
    table = fim_rows(rows)
    pieces = fim.pieces(make(table), chunk=50).collect()
    assert max(len(p["piece"]) for p in pieces) <= 50
    plan = fim.assemble(make(table))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(part") == 1  # restoring needs no further shuffle


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="<PSM>ab é", max_size=30), st.integers(0, 30), st.integers(0, 30), st.sampled_from(["psm", "spm"]),
       st.integers(1, 6))
def test_sentinels_are_found_across_pieces(text, x, y, form, step):
    if any(m in text for m in (fim.PREFIX, fim.SUFFIX, fim.MIDDLE)):
        form = "plain"
    a, b = sorted((min(x, len(text)), min(y, len(text))))
    output = fim.transform_text(text, form, a, b - a)
    reader, parts = fim.SentinelReader(form), ["", "", ""]
    for i in range(0, len(output), step):
        for rank, piece in reader.feed(output[i : i + step]):
            parts[rank] += piece
    for rank, piece in reader.close():
        parts[rank] += piece
    assert "".join(parts) == text == fim.restore_text(output, form)
