"""Main-text extraction with a site style tree.

* Every page becomes a DOM of block elements; a node's style is its tag with
  class and id.  Pages of one host merge into one tree: nodes with equal style
  paths are the same node of the site.
* Content nodes: a text block is a feature of its leaf.  With m pages that
  hold the leaf and k of them that hold the feature, the feature's entropy is
  log k / log m; the leaf's importance is one minus the mean entropy.
* Presentation nodes: the importance of an inner node is the entropy (base m)
  of its sequences of child styles.
* Composite importance weighs both by the number of styles, as the tree's
  inventors do.  A host with few pages leans on the same node over all hosts.
* Pass two removes each branch whose importance is low, and branches whose
  role says that they are not the article (navigation, footer, advert, form,
  reader comments, ...).  Inside an article or main element plain text blocks
  always stay, however often a site repeats them.

Text of a page: blocks in page order, character references decoded, white
space inside a block turned into one space, joined by two line feeds.

Defined results: NULL and empty html give an empty text; a page whose url has
no host belongs to the site of the empty host; repeated rows have results of
their own, but rows of one host with equal html are one page of its tree;
malformed markup is closed where the next block begins.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import join_bounded, staged

THRESHOLD = 0.7
GAMMA = 0.9
#: Pages of evidence that the tree over all hosts is worth.
PRIOR_PAGES = 10
#: Pages' worth of belief that a branch matters, before any evidence: two pages
#: that repeat each other are no proof of a site's design.
BELIEF_PAGES = 5
MAX_BROADCAST_HOSTS = 50_000
MAX_BROADCAST_COPIES = 200_000

# Element names by their part in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img br input".split()
)
NOT_TEXT = ("script", "style", "noscript", "template", "iframe", "textarea")
#: Without their end tag, these end where the page's body or a block begins.
ENDS_AT_BLOCK = ("title", "svg", "math", "object", "canvas")
NOISE_TAGS = frozenset("nav footer aside form button select menu dialog".split())
MAIN_TAGS = frozenset(("article", "main"))
NOISE_ROLES = frozenset(
    "navigation banner contentinfo search complementary menu menubar ad ads advert adverts advertisement banner-ad "
    "sidebar side-bar side widget menus nav navbar navigation breadcrumb breadcrumbs cookie cookies consent notice "
    "notices alert popup modal overlay newsletter subscribe subscription promo promotion sponsor sponsored social "
    "share sharing comment comments reply replies respond disqus footer header masthead toolbar pagination pager "
    "related recommended tags login signup".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul li dt dd".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(NOT_TEXT) + r")\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<empty>svg|math)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>(?<=/>)"
    r"|<(?P<part>" + "|".join(ENDS_AT_BLOCK) + r")\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r"(?:(?:(?!<(?P=part)\b).)*?</(?P=part)\s*>|.*?(?=</head\b|</?body\b|<(?:" + "|".join(sorted(CLOSES_P)) + r")\b|\Z))"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>"  # a tag with a stray quote
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Words that make a compound of a role word that role's part of a page.
ROLE_PARTS = frozenset(
    "area bar banner block body box button buttons container content form icons item items link links list logo "
    "menu message nav notice popup post posts article articles section signup slot text unit widget widgets "
    "wrap wrapper inner top bottom".split()
)


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").removeprefix("www.")
    except ValueError:
        return ""


def role_word(word: str) -> bool:
    """Whether a class token names a noise role: as a whole, or as a compound
    of a role and one of its parts.  States and layouts of a page that begin
    with a role word ('menu-open', 'sidebar-first') are none."""
    if word in NOISE_ROLES:
        return True
    parts = [w for w in re.split(r"[-_]+", word) if w]
    return len(parts) > 1 and parts[0] in NOISE_ROLES and all(w in ROLE_PARTS or w in NOISE_ROLES for w in parts[1:])


NONE, BY_NAME, BY_TAG = 0, 1, 2


def style_of(tag: str, attributes: str) -> tuple[str, int]:
    """(style, noise): tag with class and id, and what makes it noise, if
    anything: a class, an id or the form tag, or its role itself."""
    noise, style = BY_TAG if tag in NOISE_TAGS and tag != "form" else NONE, tag
    if attributes and attributes.strip():
        for m in ATTRIBUTE.finditer(attributes):
            value = (m[2] or m[3] or m[4] or "").lower()
            words = value.split()
            if any(map(role_word, words)):
                noise = max(noise, BY_TAG if m[1].lower() == "role" else BY_NAME)
            if m[1].lower() != "role" and words:
                # numbers in class and id names differ from page to page
                style += (".", "#")[m[1].lower() == "id"] + re.sub(r"\d+", "0", words[0])
    return style, NONE if tag in ("html", "body") else noise


class Page:
    """Blocks of a page: (style path, noise, in main, text), and the child
    styles of every inner node."""

    def __init__(self, source: str):
        self.blocks: list[tuple[tuple[str, ...], bool, bool, str]] = []
        self.children: list[tuple[tuple[str, ...], list[str]]] = []
        # all elements: number of the parent, tag, noise
        self.elements: list[tuple[int, str, int]] = []
        # found blocks: style path, number of the element, text
        self.found: list[tuple[tuple[str, ...], int, str]] = []
        # open elements: tag, style, number
        self.open: list[tuple[str, str, int]] = []
        self.text: list[str] = []
        at = 0
        for m in TOKEN.finditer(source):
            if m.start() > at:
                self.text.append(source[at : m.start()])
            at = m.end()
            close, tag, attributes = (m[4], m[5], m[6]) if m[5] else (m[7], m[8], m[9])
            if tag is None:
                if m[1] or m[2] or m[3]:
                    self.text.append(" ")
                continue
            tag = tag.lower()
            if tag in ("br", "img", "input"):
                self.text.append(" ")
            elif tag in INLINE:
                continue
            elif tag == "head":
                # what stands in a head is no text, and its end tag may be missing
                self.flush()
            else:
                self.flush()
                self.end(tag) if close else self.start(tag, attributes)
        self.text.append(source[at:])
        self.flush()
        self.judge()

    def path(self) -> tuple[str, ...]:
        return tuple(e[1] for e in self.open)

    def flush(self) -> None:
        if self.text:
            text = " ".join(entities.unescape("".join(self.text)).split())
            self.text = []
            if text:
                self.found.append((self.path(), self.open[-1][2] if self.open else -1, text))

    def start(self, tag: str, attributes: str) -> None:
        if tag in VOID or attributes.rstrip().endswith("/") and tag not in CLOSES_P:
            return
        if tag in CLOSES_P:
            self.pop_implied("p", ("article", "section", "div", "td", "th", "li", "body", "blockquote"))
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            same = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
            stop = ("ul", "ol", "menu") if tag == "li" else ("dl",) if tag in ("dt", "dd") else ("table", "tr", "select")
            for s in same:
                self.pop_implied(s, stop)
        style, noise = style_of(tag, attributes)
        above = self.open[-1][2] if self.open else -1
        if self.open:
            self.children[above][1].append(style)
        self.open.append((tag, style, len(self.children)))
        self.elements.append((above, tag, noise))
        self.children.append((self.path(), []))

    def judge(self) -> None:
        """Tell noise and main text apart, once the whole page is known: a
        branch that holds an article or main element, or a form that holds most
        of the page's text, is no noise by its name or form tag."""
        n = len(self.elements)
        # of an element and all above it; the last entry stands above the page
        certain, inside = [False] * (n + 1), [False] * (n + 1)
        for i, (above, tag, noise) in enumerate(self.elements):
            # the header of an article belongs to it; a page's header does not
            certain[i] = certain[above] or noise == BY_TAG or tag == "header" and not inside[above]
            inside[i] = inside[above] or tag in MAIN_TAGS
        chars, holds = [0] * (n + 1), [False] * (n + 1)
        for _, at, text in self.found:
            if not certain[at]:
                chars[at] += len(text)
        for i in range(n - 1, -1, -1):
            above, tag, noise = self.elements[i]
            holds[i] |= not certain[i] and (tag == "main" or tag == "article" and noise == NONE)
            holds[above] |= holds[i]
            chars[above] += chars[i]
        noisy, main = [False] * (n + 1), [False] * (n + 1)
        for i, (above, tag, noise) in enumerate(self.elements):
            if noise == NONE and tag == "form" and 2 * chars[i] <= chars[n]:
                noise = BY_NAME
            own = noise == BY_TAG or noise == BY_NAME and not holds[i] or tag == "header" and not main[above]
            noisy[i] = noisy[above] or own
            main[i] = (main[above] or tag in MAIN_TAGS) and not own
        self.blocks = [(path, noisy[at], main[at], text) for path, at, text in self.found]

    def pop_implied(self, tag: str, stop: tuple[str, ...]) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return
            if self.open[k][0] in stop:
                return

    def end(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return


CONTENT, PRESENCE, PRESENTATION = 0, 1, 2


def features(page: Page) -> set[tuple[int, str, str]]:
    """What a page adds to the tree: (kind, node, feature), each once."""
    out = set()
    for path, _, _, text in page.blocks:
        node = ">".join(path)
        out.add((CONTENT, node, text))
    for path, children in page.children:
        if children:
            # a run of equal children is one style, as the number of
            # paragraphs is content rather than presentation
            runs = [c for i, c in enumerate(children) if not i or c != children[i - 1]]
            out.add((PRESENTATION, ">".join(path), " ".join(runs)))
    out |= {(PRESENCE, node, "") for _, node, _ in out}
    return out


def hosted(rows: DataFrame) -> DataFrame:
    """Add ``host`` to rows that have ``url``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts = pa.array([host_of(u) for u in b["url"].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, hosts], [*b.schema.names, "host"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("host", T.StringType())]))


def tree_rows(pages: DataFrame, url: str, source: str) -> DataFrame:
    """(host, kind, node, feature, pages): the merged trees of all hosts, each
    distinct html of a host counted once."""
    rows = pages.select(
        pages[url].alias("url"),
        pages[source].alias("html"),
        F.sha2(F.coalesce(pages[source], F.lit("")).cast("binary"), 256).alias("digest"),
    )
    # only digests meet; n copies of a page weigh 1/n each
    copies = hosted(rows.select("url", "digest")).groupBy("host", "digest").agg(F.count("*").alias("copies"))
    copies = staged(copies.filter("copies > 1"), "page-copies")
    weighed = join_bounded(hosted(rows), copies, ["host", "digest"], "left", MAX_BROADCAST_COPIES)
    weighed = weighed.select("host", "html", (F.lit(1.0) / F.coalesce("copies", F.lit(1))).alias("weight"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count: Counter = Counter()
            for host, h, weight in zip(b["host"].to_pylist(), b["html"], b["weight"].to_pylist()):
                for kind, node, feature in features(Page(h.as_py() or "")):
                    count[host, kind, node, feature] += weight
            keys = list(count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([k[2] for k in keys], pa.string()),
                    pa.array([k[3] for k in keys], pa.string()),
                    pa.array([count[k] for k in keys], pa.float64()),
                ],
                ["host", "kind", "node", "feature", "n"],
            )

    found = weighed.mapInArrow(run, "host string, kind int, node string, feature string, n double")
    # features are compared by digest; equal ones of a task are one row
    found = found.withColumn("feature", F.xxhash64("feature"))
    # the weights of a page's copies add up to one but for rounding
    whole = F.round(F.sum("n")).cast("long").alias("n")
    return staged(found.groupBy("host", "kind", "node", "feature").agg(whole), "style-tree")


def importances(rows: DataFrame, by: list[str]) -> DataFrame:
    """Importance of every branch of the trees named by ``by`` (+ node):
    (by.., node, pages, importance)."""
    merged = rows.groupBy(*by, "kind", "node", "feature").agg(F.sum("n").alias("k"))
    pages = merged.filter(F.col("kind") == PRESENCE).select(*by, "node", F.col("k").alias("m"))
    feats = merged.filter(F.col("kind") != PRESENCE).join(pages, [*by, "node"])
    log_m = F.log("m")
    entropy = F.when(F.col("m") > 1, F.least(F.lit(1.0), F.log("k") / log_m)).otherwise(0.0)
    share = F.col("k") / F.col("m")
    spread = F.when(F.col("m") > 1, -share * F.log(share) / log_m).otherwise(0.0)
    node = feats.groupBy(*by, "node").agg(
        F.max("m").alias("m"),
        F.sum(F.when(F.col("kind") == CONTENT, 1 - entropy)).alias("content"),
        F.count(F.when(F.col("kind") == CONTENT, 1)).alias("contents"),
        F.sum(F.when(F.col("kind") == PRESENTATION, spread)).alias("presentation"),
        F.count(F.when(F.col("kind") == PRESENTATION, 1)).alias("styles"),
    )
    # a branch holds the content of all leaves below it
    steps = F.split("node", ">")
    branch = F.explode(F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), ">")))
    below = node.select(*by, branch.alias("node"), "content", "contents").groupBy(*by, "node").agg(
        F.sum("content").alias("content"), F.sum("contents").alias("contents")
    )
    joined = below.join(node.select(*by, "node", "m", "presentation", "styles"), [*by, "node"], "left")
    leaf = F.col("content") / F.col("contents")
    weight = F.pow(F.lit(GAMMA), F.coalesce("styles", F.lit(0)))
    composite = (1 - weight) * F.least(F.lit(1.0), F.coalesce("presentation", F.lit(0.0))) + weight * leaf
    # presentation can only add: one layout with changing content is an article
    importance = F.when(F.col("contents") > 0, F.greatest(composite, leaf)).otherwise(F.lit(1.0))
    return joined.select(*by, "node", F.coalesce("m", F.lit(1)).alias("pages"), importance.alias("importance"))


def low_branches(rows: DataFrame, threshold: float) -> DataFrame:
    """(host, low): the branches of each host's tree that are to go."""
    own = importances(rows, ["host"])
    everywhere = importances(rows, []).select(
        "node", F.col("pages").alias("all_pages"), F.col("importance").alias("all_importance")
    )
    # evidence of other hosts counts as far as there is any
    worth = F.least(F.lit(float(PRIOR_PAGES)), F.col("all_pages") - 1)
    m = F.col("pages") - 1
    seen = m * F.col("importance") + worth * F.col("all_importance")
    both = own.join(everywhere, "node").withColumn("blended", (seen + BELIEF_PAGES) / (m + worth + BELIEF_PAGES))
    # node paths are part of a site's design, so a host has few of them
    low = both.filter(F.col("blended") < threshold)
    return low.groupBy("host").agg(F.sort_array(F.collect_set("node")).alias("low"))


def main_text(source: str, low: set[str]) -> str:
    """The page's text without low-importance branches and noise roles."""
    out = []
    for path, noise, main, text in Page(source).blocks:
        if noise:
            continue
        if not main and low:
            node, gone = "", False
            for step in path:
                node = f"{node}>{step}" if node else step
                if node in low and re.split(r"[.#]", step, maxsplit=1)[0] not in ("html", "body"):
                    gone = True
                    break
            if gone or node in low:
                continue
        elif main and low:
            # below article or main, generic containers may still go
            node, inside, gone = "", False, False
            for step in path:
                node = f"{node}>{step}" if node else step
                tag = re.split(r"[.#]", step, maxsplit=1)[0]
                if inside and tag in ("div", "section") and node in low:
                    gone = True
                    break
                inside |= tag in MAIN_TAGS
            if gone:
                continue
        out.append(text)
    return "\n\n".join(out)


def extract(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    source: str = "html",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    low = staged(low_branches(tree_rows(pages, url, source), threshold), "low-branches")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for h, branches in zip(b["html"], b["low"]):
                texts.append(main_text(h.as_py() or "", set(branches.as_py() or ())))
            yield pa.RecordBatch.from_arrays(
                [b["page_id"], b["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        pages[page_id].cast("long").alias("page_id"), pages[url].alias("url"), pages[source].alias("html")
    )
    joined = join_bounded(hosted(rows), low, "host", "left", MAX_BROADCAST_HOSTS)
    return joined.select("page_id", "url", "html", "low").mapInArrow(run, "page_id long, url string, text string, n_chars long")
