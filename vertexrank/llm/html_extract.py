"""Main-text extraction: a linear-chain random field over DOM leaf blocks.

A page is cut into leaf blocks, runs of text without a block-level boundary;
each block has features of its ancestors (tags, words of class, id and role)
and of its text (length, links, punctuation, place). A two-state linear-chain
conditional random field labels the blocks by Viterbi; blocks labelled main
are joined in page order by one space. Character references are decoded, white
space inside a block becomes one space, and nothing else is dropped. Scripts,
styles, markup, controls of forms and the document head are never text.

Training: a bounded sample of pages (``SAMPLE_PAGES``, smallest hashes of the
id) gives texts; labelled pages are made from them by laying out their article
blocks and foreign texts in ``LAYOUTS`` of known structure (menus, headers,
sidebars, notices, adverts, forms, comments around and inside the article),
besides the sampled pages themselves where they mark up an article. Labels are
read from the layout, features only from what the parser sees.

Defined cases: null or empty html gives empty text; unclosed, misnested and cut
off markup is read as a browser would roughly do (a head left open ends at the
first tag or text that may not stand in it); formulas and the fallback text of
embedded parts count as text; text without any markup is one block; where no page
can be learned from, the blocks of ``article`` and ``main``, or else all, that no
named menu, notice or the like holds are the text; equal pages get equal results;
other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map
from .crf import Crf, train, viterbi

SAMPLE_PAGES = 200
SAMPLE_BYTES = 1 << 20  # of a page that may be in the sample
VARIANTS = 4

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style)\b(?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"""(class|id|role|itemprop|aria-label|data-y)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr"
    " math mi mn mo ms mtext mrow msub msup msubsup mfrac msqrt mroot mover munder semantics annotation svg tspan canvas object audio video".split()
)
# not shown, or controls of a form; the text of formulas and fallback text is the article's
SKIP = frozenset("head title template iframe select textarea button option datalist".split())
IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SAME = {"li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "td", "th": "th", "option": "option"}

# tags and words that are features of the blocks below them
TAGS = "article main section p h1 h2 h3 ul ol li table td nav header footer aside form blockquote pre figure details dialog address a".split()
WORDS = {
    "content": "content article post entry story prose articlebody maincontent",
    "body": "main body text primary",
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs pager pagination toc tabs sitemap skip",
    "head": "header masthead topbar logo branding tagline",
    "foot": "footer foot colophon copyright legal disclaimer",
    "side": "sidebar aside side widget widgets related recommended recommendations trending popular rail secondary complementary",
    "notice": "cookie cookies consent notice alert popup modal gdpr overlay toast warning dialog paywall announcement privacy",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted adsbygoogle adslot adbox banner",
    "comment": "comment comments commentlist reply replies disqus discussion respond reader responses feedback",
    "form": "form login signup signin register search subscribe newsletter contact",
    "social": "share sharing social follow tags tag byline author meta",
}
_BIT = {t: 1 << k for k, t in enumerate(TAGS)}
_BIT["ol"] = _BIT["ul"]
_WORD_BIT = {w: 1 << (len(TAGS) + k) for k, ws in enumerate(WORDS.values()) for w in ws.split()}
PATH_BITS = len(TAGS) + len(WORDS)
_LABEL = 1 << 62


def _path_bits(tag: str, attrs: str, cache: dict) -> int:
    key = (tag, attrs)
    if key not in cache:
        bits = _BIT.get(tag, 0)
        for m in _ATTR.finditer(attrs):
            value = m[2] or m[3] or m[4] or ""
            if m[1].lower() == "data-y":
                bits |= _LABEL
                continue
            for w in _WORD.findall(value):
                bits |= _WORD_BIT.get(w.lower(), 0)
        if len(cache) > 50_000:
            cache.clear()
        cache[key] = bits
    return cache[key]


def blocks(page: str, cache: dict | None = None) -> list[tuple[str, int, int]]:
    """(text, ancestor bits, characters inside links) of every leaf block."""
    cache = {} if cache is None else cache
    out: list[tuple[str, int, int]] = []
    stack: list[tuple[str, int, bool]] = [("", 0, False)]
    parts: list[str] = []
    linked, in_link, path = 0, 0, 0

    def flush():
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                out.append((text, path, linked))
            parts.clear()
        linked = 0

    def say(text: str):
        nonlocal linked, path
        if stack[-1][0] == "head" and not text.isspace():  # text ends a head left open
            pop_to(len(stack) - 1)
        if not stack[-1][2] and text:
            parts.append(text)
            if not text.isspace():
                path = stack[-1][1]
                if in_link:
                    linked += len(text)

    def pop_to(k: int):
        nonlocal in_link
        in_link -= sum(1 for t, _, _ in stack[k:] if t == "a")
        del stack[k:]

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "br":
            say(" ")
            continue
        if not m["end"] and stack[-1][0] == "head" and tag not in IN_HEAD:  # so does what may not stand in it
            pop_to(len(stack) - 1)
        inline = tag in INLINE
        if not inline:
            flush()
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    pop_to(k)
                    break
            continue
        if tag in VOID:
            continue
        if tag in CLOSES_P or tag in SAME:
            names = {"p"} if tag in CLOSES_P else {tag, SAME[tag]}
            for k in range(len(stack) - 1, 0, -1):
                t = stack[k][0]
                if t in names:
                    pop_to(k)
                    break
                if t in CLOSES_P or t in ("table", "td", "th"):
                    break
        if tag == "body":  # whatever a head left open ends here
            pop_to(1)
        attrs = m["attrs"] or ""
        if not attrs.endswith("/") or not inline:
            top = stack[-1]
            stack.append((tag, top[1] | _path_bits(tag, attrs, cache), top[2] or tag in SKIP))
            in_link += tag == "a"
    if at < len(page):
        say(page[at:])
    flush()
    return out


TEXT_FEATURES = 16


def features(page_blocks: list[tuple[str, int, int]]) -> np.ndarray:
    n = len(page_blocks)
    x = np.zeros((n, PATH_BITS + TEXT_FEATURES + 1))
    masks = np.array([b[1] & ~_LABEL for b in page_blocks], np.uint64)
    x[:, :PATH_BITS] = (masks[:, None] >> np.arange(PATH_BITS, dtype=np.uint64)[None]) & np.uint64(1)
    for i, (text, _, linked) in enumerate(page_blocks):
        size = len(text)
        count = text.count(" ") + 1
        last = text[-1]
        x[i, PATH_BITS:-1] = (
            np.log1p(size),
            np.log1p(count),
            min(1.0, linked / size),
            last in ".!?…\"”»",
            last == ":",
            "©" in text,
            min(1.0, 10 * (text.count(",") + text.count(";")) / size),
            min(1.0, 10 * (text.count("|") + text.count("·") + text.count("»") + text.count("/")) / size),
            count <= 3,
            count >= 15,
            text[0].isupper(),
            text.isupper(),
            i / n,
            i == 0,
            i == n - 1,
            n <= 2,
        )
    x[:, -1] = 1
    return x


# layouts of labelled pages: {x} is filled with blocks; data-y marks the article for the labels
ARTICLES = (
    "<article data-y=1>{x}</article>",
    "<main><article class='post' data-y=1>{x}</article></main>",
    "<main data-y=1>{x}</main>",
    "<div class='content' data-y=1>{x}</div>",
    "<div id='main-content' data-y=1>{x}</div>",
    "<div class='post-body' data-y=1>{x}</div>",
    "<div class='wrap'><div class='entry-content' data-y=1>{x}</div></div>",
    "<section class='story' data-y=1>{x}</section>",
    "<div role='main' data-y=1><div class='article-body'>{x}</div></div>",
    "<div itemprop='articleBody' data-y=1>{x}</div>",
    "<div class='page'><div class='col' data-y=1>{x}</div></div>",
)
BEFORE = (
    "<nav><ul>{links}</ul></nav>",
    "<div class='menu'>{links}</div>",
    "<ul class='navbar'>{links}</ul>",
    "<div class='breadcrumbs'>{line}</div>",
    "<header><p>{line}</p><div>{links}</div></header>",
    "<div class='header'><span>{short}</span></div>",
    "<div id='masthead'><h2>{short}</h2><p>{line}</p></div>",
    "<div class='cookie-notice'><p>{text}</p></div>",
    "<div id='consent' role='dialog'>{text}</div>",
    "<div class='alert notice'>{line}</div>",
    "<div class='ad'>{text}</div>",
    "<div class='advert'><p>{text}</p></div>",
    "<form class='search'><label>{short}</label><p>{line}</p></form>",
)
AFTER = (
    "<footer>&copy; {short} &middot; {line}</footer>",
    "<footer><p>{text}</p><ul>{links}</ul></footer>",
    "<div class='footer'><p>{text}</p></div>",
    "<div class='copyright'>{line}</div>",
    "<aside><h3>{short}</h3><p>{text}</p></aside>",
    "<div class='sidebar'><p>{text}</p><p>{text}</p></div>",
    "<div class='widget related'><ul>{links}</ul><p>{line}</p></div>",
    "<section class='comments'><h3>{short}</h3><div class='comment'><p>{text}</p></div><div class='comment'><p>{line}</p><p>{text}</p></div></section>",
    "<div id='comments'><article class='comment'><p>{text}</p></article><article class='comment'><p>{line}</p></article></div>",
    "<ol class='commentlist'><li>{text}</li><li>{line}</li></ol>",
    "<div class='newsletter'><form><p>{text}</p></form></div>",
    "<form><h3>{short}</h3><p>{text}</p></form>",
    "<div class='share'>{links}</div>",
    "<div class='sponsored'><p>{text}</p></div>",
)
INSIDE = (
    "<div class='ad'>{text}</div>",
    "<aside><p>{text}</p></aside>",
    "<div class='promo sponsored'><p>{line}</p></div>",
    "<div class='related'><ul>{links}</ul></div>",
    "<form class='subscribe'><p>{line}</p></form>",
    "<div class='notice'><p>{text}</p></div>",
    "<nav>{links}</nav>",
    "<section class='comments'><p>{text}</p><p>{text}</p></section>",
)


def labelled_pages(pages: list[str], variants: int = VARIANTS, seed: int = 7) -> list[str]:
    """Laid-out training pages from the texts of sampled pages."""
    rng = np.random.default_rng(seed)
    articles, texts = [], []
    for page in pages:
        found = [t for t, bits, _ in blocks(page) if bits & (_BIT["article"] | _BIT["main"])] or [t for t, _, _ in blocks(page)]
        if found:
            articles.append(found)
            texts += found
    if not texts:
        return []
    short = lambda: " ".join(texts[rng.integers(len(texts))].split()[: int(rng.integers(1, 4))])
    line = lambda: " ".join(texts[rng.integers(len(texts))].split()[: int(rng.integers(3, 14))])
    text = lambda: " ".join(texts[rng.integers(len(texts))].split()[: int(rng.integers(10, 90))])
    links = lambda: "".join(f"<li><a href='/x'>{entities.escape(short())}</a></li>" for _ in range(int(rng.integers(2, 7))))

    def fill(layout: str) -> str:
        out = re.sub(r"\{(short|line|text)\}", lambda m: entities.escape({"short": short, "line": line, "text": text}[m[1]]()), layout)
        return re.sub(r"\{links\}", lambda m: links(), out)

    some = lambda options, most: [fill(options[k]) for k in rng.permutation(len(options))[: int(rng.integers(0, most + 1))]]
    out = []
    for found in articles:
        for _ in range(variants):
            body = []
            for k, t in enumerate(found):
                t = entities.escape(t)
                kind = rng.integers(6)
                body.append(f"<h1>{t}</h1>" if k == 0 and kind < 4 else f"<li>{t}</li>" if kind == 0 else f"<blockquote>{t}</blockquote>" if kind == 1 else f"<div>{t}</div>" if kind == 2 else f"<p>{t}</p>")
            for extra in some(INSIDE, 2):
                body.insert(int(rng.integers(1, len(body) + 1)), extra)
            article = ARTICLES[rng.integers(len(ARTICLES))].replace("{x}", "".join(body))
            out.append("<html><body>" + "".join(some(BEFORE, 4)) + article + "".join(some(AFTER, 4)) + "</body></html>")
    return out


_NOT_MAIN = sum(_BIT[t] for t in ("nav", "header", "footer", "aside", "form"))
for _k, _name in enumerate(WORDS):
    if _name not in ("content", "body"):
        _NOT_MAIN |= 1 << (len(TAGS) + _k)


def labels(page_blocks: list[tuple[str, int, int]], mark: int) -> np.ndarray:
    """1 for blocks below the marked article that no named part inside it holds."""
    return np.array([int(bool(bits & mark) and not bits & _NOT_MAIN) for _, bits, _ in page_blocks], np.int64)


def _named(page_blocks: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return [b for b in page_blocks if b[1] & (_BIT["article"] | _BIT["main"])]


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Crf | None:
    """The field fitted on the ``sample_pages`` pages of smallest id hash (one each
    of repeated ids) among those of at most ``SAMPLE_BYTES``; none without text."""
    rows = pages.select("page_id", "html").where(F.octet_length("html").between(1, SAMPLE_BYTES) & F.col("page_id").isNotNull())
    chosen = rows.groupBy(F.col("page_id").alias("s_id")).agg(F.min(F.xxhash64("html")).alias("s_hash"))
    chosen = chosen.orderBy(F.xxhash64("s_id"), "s_id").limit(sample_pages)
    # at most sample_pages rows of two numbers; whole pages leave the tasks only for these
    here = (F.col("page_id") == F.col("s_id")) & (F.xxhash64("html") == F.col("s_hash"))
    rows = rows.join(F.broadcast(chosen), here).dropDuplicates(["page_id"])
    rows = rows.select(F.xxhash64("page_id").alias("h"), "page_id", "html").collect()
    sampled = [r["html"] for r in sorted(rows, key=lambda r: (r["h"], r["page_id"]))]
    x, y, size = [], [], []
    for page, mark in [(p, _LABEL) for p in labelled_pages(sampled)] + [(p, _BIT["article"]) for p in sampled]:
        found = blocks(page)
        if found and (mark == _LABEL or any(b[1] & mark for b in found)):
            x.append(features(found))
            y.append(labels(found, mark))
            size.append(len(found))
    if not x:
        return None
    return train(np.concatenate(x), np.concatenate(y), np.append(0, np.cumsum(size)), steps=120)


def extract_text(pages: list[str | None], model: Crf | None) -> list[str]:
    cache: dict = {}
    found = [blocks(p or "", cache) for p in pages]
    size = np.array([len(b) for b in found], np.int64)
    ranges = np.append(0, np.cumsum(size))
    if not ranges[-1]:
        return [""] * len(pages)
    if model is None:  # nothing to learn from: by the names of the parts alone
        return [" ".join(t for t, bits, _ in (_named(b) or b) if not bits & _NOT_MAIN) for b in found]
    x = np.concatenate([features(b) for b in found if b])
    state = viterbi(model.scores(x), model.transition, ranges)
    return [" ".join(t for (t, _, _), s in zip(b, state[a:z], strict=True) if s) for b, a, z in zip(found, ranges[:-1], ranges[1:], strict=True)]


def extract(pages: DataFrame, model: Crf | None = None, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``."""
    model = model or fit(pages, sample_pages)

    def make(part: pa.RecordBatch) -> dict:
        text = extract_text(part.column("html").to_pylist(), model)
        return {"page_id": part.column("page_id"), "url": part.column("url"), "text": text, "n_chars": [len(t) for t in text]}

    return arrow_map(pages.select("page_id", "url", "html"), "html", make, "page_id long, url string, text string, n_chars long")
