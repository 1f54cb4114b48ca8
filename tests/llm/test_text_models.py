"""Language ID, toxicity, personal data and HTML extraction."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import html_extract, langid, pii, toxicity
from tessera.llm.common import held_out

SF = "/root/testdata/sf0.01"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_column(spark):
    got = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == held(r["id"]) for r in got)


# -- language ID --------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return langid.train(docs, learn=~held_out(F.col("doc_id")), per_lang=60)


def test_language_id_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(held_out(F.col("doc_id"))).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97


def test_language_id_odd_rows(docs, rows, model):
    got = langid.predict(docs, model).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows if r[0] is not None}
    for r in got:
        if r["doc_id"] is None:
            continue
        letters = any(map(str.isalpha, text[r["doc_id"]] or ""))
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
        assert letters or r["score"] == 0


def test_language_id_without_labels_or_rows(docs, no_docs, model):
    assert langid.predict(no_docs, model).collect() == []
    assert langid.keep_identified(no_docs, model).collect() == []
    assert langid.train(no_docs) is None
    assert {r["lang_pred"] for r in langid.predict(docs, None).collect()} == {"und"}


def test_keep_identified_passes_rows_through(docs, rows, model):
    out = langid.keep_identified(docs, model, min_score=0.0)
    assert out.columns == docs.columns
    want = sorted(str(r[0]) for r in rows if any(map(str.isalpha, r[1] or "")))
    assert sorted(str(r["doc_id"]) for r in out.collect()) == want


def test_pair_tables_equal_direct_convolution(model):
    table = langid._symbols()
    win = langid.windows_of("Žluťoučký kůň, the quick brown fox 123".encode() * 9, table)
    fast = langid.pooled(model, model.pair_tables(), win)
    slow = []
    for w in langid.WIDTHS:
        span = langid.WINDOW - w + 1
        resp = sum(model.conv[w][j][win[:, j : j + span]] for j in range(w))
        slow.append(np.maximum(resp.max(axis=1) + model.bias[w], 0))
    assert np.allclose(fast, np.hstack(slow), atol=1e-4)


def test_every_window_counts(model):
    tables = model.pair_tables()
    whole = langid.score_texts(model, tables, ["the and of that with this from " * 2000])[1][0]
    many = langid.score_texts(model, tables, ["the and of that with this from ", None, "123"] * 50)
    assert 0 < whole <= 1 and many[0][1::3] == ["und"] * 50


# -- toxicity -----------------------------------------------------------------

BAD = ["vileword", "nastyness", "foulmouth"]


@pytest.fixture(scope="module")
def tox_tables(spark):
    rng = random.Random(1)
    clean = [a + b for a in ("mer", "lan", "tor", "vis", "hel", "dra") for b in ("in", "ko", "est", "al")]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        w = [rng.choice(clean) for _ in range(rng.randint(5, 60))]
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    tests = ["v1lew0rd mer in", "n a s t y n e s s lanko", "foulmouuuuth torest", "f.o.u.l.m.o.u.t.h", "merin lanko 2024 10.5 x1", "n@$tyne$$"]
    rows += [(1000 + i, t) for i, t in enumerate(tests)] + [(None, "vileword"), (2000, None), (2001, ""), (2002, "merin " * 50_000)]
    docs = spark.createDataFrame([(*r, "s", 1.0) for r in rows], "doc_id long, text string, score string, toxic double")
    return docs.repartition(3), spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id long, toxic int")


def test_toxicity_held_out_and_obfuscated(tox_tables):
    docs, labels = tox_tables
    m = toxicity.train(docs, labels, ~held_out(F.col("doc_id")))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, m).collect()}
    assert len(got) == docs.count()
    for i in range(600):
        if held(i):
            assert (got[i] >= 0.3) == (i % 5 == 0)
    assert all(got[1000 + i] >= 0.3 for i in (0, 1, 2, 3, 5)) and got[1004] < 0.3
    assert got[None] >= 0.3 and got[2000] == got[2001] < 0.3 and got[2002] < 0.3
    assert "vileword" in toxicity.restore("so v1l3w0rd now", m)


FORMS = ["v_i_l_e_w_o_r_d", "v  i  l  e  w  o  r  d", "vile.word", "vi-lew-ord", "vilew*ord", "nastyne$$", "viileword", "v1leword!"]


def test_every_form_of_the_channel_is_decoded(tox_tables):
    docs, labels = tox_tables
    m = toxicity.train(docs, labels, ~held_out(F.col("doc_id")))
    texts = [f"merin lanko {f} torest helin" for f in FORMS] + ["merin lanko well-known 10.5 hello! all"]
    df = docs.sparkSession.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, m).collect()}
    assert [f for i, f in enumerate(FORMS) if got[i] < 0.3] == [] and got[len(FORMS)] < 0.3


def test_toxicity_without_labels(docs, no_docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    m = toxicity.train(docs, none)
    assert {r["score"] for r in toxicity.score(docs, m).collect()} == {0.0}
    assert toxicity.score(no_docs, toxicity.train(no_docs, none)).collect() == []


def test_trigrams_count_every_character(spark):
    text = "abcab"
    counts = toxicity.trigram_counts(spark.createDataFrame([(text,), (None,), ("",)], "text string"), "text")
    padded = f" {text} "
    assert counts.sum() == len(padded) - 2 and counts[1, 2, 3] == 1 and counts[0, 1, 2] == 1


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(2)
    d = toxicity.Decoder(toxicity.log_model(rng.integers(0, 50, (toxicity.SYMBOLS,) * 3).astype(float)))
    for span in ("l0s3r", "1d10t", "aabb", "s t o p"):
        paths = [("", 0.0)]
        for hidden in d.choices(span):
            paths = [(t + h, s + c) for t, s in paths for h, c in hidden]

        def total(t, s):
            x, y = toxicity.OTHER, 0
            for ch in t + " ":
                z = d.index.get(ch, toxicity.OTHER)
                s += float(d.model[x, y, z])
                x, y = y, z
            return s

        best = max(total(t, s) for t, s in paths)
        got = d.decode(span)
        assert max(total(t, s) for t, s in paths if t == got) == pytest.approx(best, abs=1e-3)


def test_long_spans_are_walked_whole():
    rng = np.random.default_rng(3)
    d = toxicity.Decoder(toxicity.log_model(rng.integers(0, 50, (toxicity.SYMBOLS,) * 3).astype(float)))
    for span in ("ab3x" * 250_000, "d " * 500_000):
        assert len(d.decode(span.strip())) >= 250_000
    assert d.decode("a" * 1_000_000) in ("a", "aa") and not any(len(k) > toxicity.LONGEST_KEPT for k in d.cache)


def test_settled_paths_equal_kept_ones(monkeypatch):
    rng = np.random.default_rng(4)
    model = toxicity.log_model(rng.integers(0, 50, (toxicity.SYMBOLS,) * 3).astype(float))
    span = "".join(rng.choice(list("l0s31t. a")) for _ in range(900))
    want = toxicity.Decoder(model).decode(span)
    monkeypatch.setattr(toxicity, "SETTLE", 3)
    assert toxicity.Decoder(model).decode(span) == want


# -- personal data ------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def brute_spans(t):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = [int(c) for c in m[0] if c.isdigit()]
        odd, even = digits[-1::-2], [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
        if 13 <= len(digits) <= 19 and (sum(odd) + sum(even)) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def test_base_spans_equal_the_patterns(spark):
    rng = random.Random(4)
    for _ in range(20_000):
        t = "".join(rng.choice("ab.@-+12 59()é4") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == brute_spans(t)
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect():
        assert pii.base_spans(r[0]) == brute_spans(r[0])


def test_base_spans_stay_linear():
    for t in ("a" * 300_000, "a@" * 100_000, "1 " * 150_000, "+1" * 100_000, "1." * 100_000):
        pii.base_spans(t)


def test_terms_that_reveal_an_entity(make):
    rng = random.Random(5)
    common = ["meet", "call", "write", "about", "report", "please", "today", "office"]
    rows = []
    for i in range(300):
        text = " ".join(rng.choice(common) for _ in range(12))
        if i % 25 == 0:
            text += " contact Zebulon at zeb@example.org please"
        elif i % 10 == 1:
            text += f" contact someone at user{i}@example.org please"
        rows.append((i, text, None, None, None))
    got = {r["doc_id"]: r for r in pii.find(make(rows), min_bits=3.0).collect()}
    text = {r[0]: r[1] for r in rows}
    for i, r in got.items():
        assert r["base"] == pii.joined(brute_spans(text[i]))
        terms = {text[i][int(s) : int(e)] for k, s, e in (p.split(":") for p in r["spans"].split(",") if p) if k == "term"}
        assert terms == ({"Zebulon"} if i % 25 == 0 else set())
        assert r["spans"].startswith(r["base"])
    assert "Zebulon" not in pii.sanitise(text[0], got[0]["spans"]) and "[email]" in pii.sanitise(text[0], got[0]["spans"])


@pytest.mark.parametrize("few", [True, False])
def test_terms_go_wherever_they_stand(make, monkeypatch, few):
    """Production limits: a rare entity (two documents), a hot one (a fifth of
    all), names far from their entity and in documents without it."""
    if not few:
        monkeypatch.setattr(pii, "MAX_BROADCAST_TERMS", 0)
    rng = random.Random(8)
    common = ["meet", "call", "write", "about", "report", "please", "today", "office", "at"]
    filler = lambda n: " ".join(rng.choice(common) for _ in range(n))
    texts = [filler(20) for _ in range(2500)]
    for i in range(0, 2500, 5):
        texts[i] += f" Hotline at desk@example.org {filler(9)}"
    for i in (1, 2):
        texts[i] += f" Quillon at q.f@example.org {filler(40)} QUILLON again"
    texts[3] += " only quillon here, address masked"
    texts[4] += f" Hotline, {filler(5)}"
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    for r in pii.find(make(rows)).collect():
        text = texts[r["doc_id"]]
        marked = [text[int(s) : int(e)] for k, s, e in (p.split(":") for p in r["spans"].split(",") if p) if k == "term"]
        assert marked == re.findall("quillon|hotline", text, re.I)
        assert not re.search("quillon|hotline", pii.sanitise(text, r["spans"]), re.I)


def test_document_counts_are_exact(make):
    df = make([(i, "alpha beta" if i % 3 else "alpha Gamma, gamma", None, None, None) for i in range(30)])
    terms = df.sparkSession.createDataFrame([("alpha",), ("gamma",)], "term string")
    got = {r["term"]: r["n"] for r in pii._document_counts(df, "text", terms).collect()}
    assert got == {"alpha": 30, "gamma": 10}


def test_personal_data_odd_rows(docs, rows, no_docs):
    got = pii.find(docs).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    assert pii.base_digest("") == hashlib.sha256(b"").hexdigest()
    assert pii.find(no_docs).collect() == []


# -- HTML ---------------------------------------------------------------------


def article(h):
    body = re.search(r"<article>(.*?)</article>", h, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", body.replace("<br>", " "))
    import html

    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def test_articles_of_the_pages_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    got = html_extract.extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_repeated_branches_go_without_any_role(spark):
    rng = random.Random(6)
    pages = []
    for i in range(60):
        story = "".join(f"<p>{' '.join(str(rng.random()) for _ in range(8))}</p>" for _ in range(rng.randint(2, 6)))
        pages.append((i, f"https://a.example/{i}", f"<body><div class=top>Home About Shop</div><div class=story>{story}</div><div class=x9>All rights kept</div></body>"))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    for r in html_extract.extract(df).collect():
        assert "Home" not in r["text"] and "rights" not in r["text"] and r["text"].count("\n\n") >= 1


@pytest.mark.parametrize(
    "source, text",
    [
        (None, ""),
        ("", ""),
        ("just text &amp; more", "just text & more"),
        ("<p>one<p>two</p><script>x='</p>'</script>three", "one\n\ntwo\n\nthree"),
        ("<article><header><h1>T</h1></header><p>a<br>b  c</p><form>q</form></article><header>H</header><aside>s</aside>", "T\n\na b c"),
        ("<main>m<div class='comments'>c</div><ul><li>1<li>2</ul></main><nav>n", "m\n\n1\n\n2"),
        ("<div id=cookie-banner>c</div><style>p{}</style><b>bold</b> x&nbsp;y<!-- no -->", "bold x y"),
        ("<p title='a>b'>ok</p><p class=\"x>unclosed", "ok\n\nunclosed"),
    ],
)
def test_single_pages(spark, source, text):
    df = spark.createDataFrame([(None, None, source, 1), (1, "http://[bad", source, 2)], "page_id long, url string, html string, host int")
    assert [r["text"] for r in html_extract.extract(df).collect()] == [text] * 2


def test_html_long_and_empty(spark):
    df = spark.createDataFrame([(1, "http://h/", "<p>" * 20_000 + "x <" * 20_000)], "page_id long, url string, html string")
    assert html_extract.extract(df).count() == 1
    assert html_extract.extract(df.limit(0)).collect() == []


def test_importance_follows_the_entropies(spark):
    pages = [(i, "http://h/", f"<body><div>same</div><p>text {i}</p></body>") for i in range(8)]
    rows = html_extract.tree_rows(spark.createDataFrame(pages, "page_id long, url string, html string"), "url", "html")
    got = {r["node"]: r["importance"] for r in html_extract.importances(rows, ["host"]).collect()}
    assert got["body>div"] == pytest.approx(0) and got["body>p"] == pytest.approx(1) and 0 < got["body"] < 1
    assert math.isclose(got["body"], 8 / 9, rel_tol=1e-6)


@pytest.mark.parametrize("few", [True, False])
def test_copies_are_no_evidence_of_a_template(spark, monkeypatch, few):
    """A host of copies only, copies with one other page, and another host of
    the same layout: no text goes because rows repeat it."""
    if not few:
        monkeypatch.setattr(html_extract, "MAX_BROADCAST_COPIES", 0)
    page = lambda t: f"<body><div class=story><p>{t} one</p><p>{t} two</p></div></body>"
    pages = [("a.example", "alone")] * 40 + [("b.example", "copied")] * 100 + [("b.example", "other")]
    pages += [("c.example", f"text {i}") for i in range(12)]
    df = spark.createDataFrame([(i, f"https://{h}/{i}", page(t)) for i, (h, t) in enumerate(pages)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df.repartition(3)).collect()}
    assert got == {i: f"{t} one\n\n{t} two" for i, (_, t) in enumerate(pages)}
    held = html_extract.tree_rows(df, "url", "html").filter("host = 'b.example' and kind = 1").collect()
    assert held and {r["n"] for r in held} == {2}


@pytest.mark.parametrize(
    "source, blocks",
    [
        ("<html class=no-menu><body class='sidebar-first menu'><div>long text</div></body></html>", ["long text"]),
        ("<body><form id=aspnetForm><div>long text of the page</div></form></body>", ["long text of the page"]),
        ("<body><form id=f><input><main>text</main><div class=comment-list>c</div></form></body>", ["text"]),
        ("<div class='sidebar'><article class=post>text</article></div>", ["text"]),
        ("<div class=comments><article class=comment>c</article></div><p>text</p>", ["text"]),
        ("<div class=menu-open><div class=search-page><div class=header-fixed>text</div></div></div>", ["text"]),
        ("<div class=footer-links>f</div><div class=nav_menu>n</div><p>text</p>", ["text"]),
        ("<html><head><meta charset=x><title>t</title><script>'<div>'</script><body><p>text</p>", ["text"]),
        ("<html><head><title>t</title><p>text</p>", ["text"]),
        ("<p>a</p><svg viewBox='0'/><p>b</p><svg><path><p>c</p>", ["a", "b", "c"]),
        ("<p>a <svg><text>s</text></svg> b</p>", ["a b"]),
        ("<nav><article>n</article></nav><article><header>h</header>text</article>", ["h", "text"]),
    ],
)
def test_wrappers_and_open_elements_keep_the_page(source, blocks):
    assert html_extract.main_text(source, set()) == "\n\n".join(blocks)
    assert html_extract.main_text(source, {"html.no-menu>body.sidebar-first"}) == "\n\n".join(blocks)
