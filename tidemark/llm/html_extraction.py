"""HTML main-text extraction by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into *leaf blocks*: stretches of text between the boundaries of block elements, in page order,
each with its open ancestors. A block's features are the tags and the class and id words of its
ancestors, and facts of its text (length, share of links, punctuation, place in the page, share of the text
of its container). A chain of two labels, content and other, with weights for features and for
neighbouring labels (by whether both blocks share a parent), is trained by maximum likelihood
(forward-backward in numpy, Adam, L2) and decoded by Viterbi. The text of a page is its content blocks.

Labelled pages. Pages whose mark-up names its article (one ``article`` or ``main`` element) are labelled by it:
blocks inside are content, unless an element between says otherwise (menus, asides, forms, footers). Each
is also *re-dressed*: its blocks are put into other layouts (``LAYOUTS``: divisions and tables named by
class and id, with menus, notices, adverts, side columns, reader comments and forms around and inside
the article), labelled by construction. So the model does not rest on one element name.

Bounds. The fit reads at most ``PAGES`` pages of at most ``PAGE_BYTES`` bytes, those with the smallest hash of page
id (one row of each id), and ``DRESSES`` re-dressed copies of each. Every page of the table is
extracted whole, inside the tasks, with the weights (some thousand numbers) broadcast.

Defined cases. Null and empty pages, and pages without content blocks, give an empty text; null urls and ids are
kept. Pages without any mark-up are one block per text; what is unclosed at the end of a cut page ends there.
Pages of any length are read whole. Repeated rows are handled row by row. Without a page that names its
article the field is trained on layouts filled with the pages' longest texts; on an empty table
there are no rows. Extra columns are ignored.
"""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

PAGES = 300
PAGE_BYTES = 1 << 16
DRESSES = 4
STEPS = 300
DIM = 1 << 14

# Element names of HTML. Their boundaries end a block.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav
ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul""".split())
# Their text is never shown as text of the page, or is the text of a control.
SILENT_TAGS = frozenset("""script style template noscript title textarea iframe object noembed noframes svg math canvas
audio video select option optgroup button head xmp datalist""".split())
# Raw text up to their own end tag.
RAW_TAGS = frozenset("script style title textarea xmp iframe noembed noframes".split())
# Elements without an end.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# A start of the key closes an open element of the values, up to the nearest of the barriers.
PARAGRAPH_ENDERS = BLOCK_TAGS - frozenset("body button caption frameset head html legend option optgroup select summary tbody td tfoot th thead tr".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
          "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Block:
    """A leaf block: text, open ancestors (outermost first) as (tag, words of class, id and role, number of the
    element), and the number of characters inside links."""

    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple, linked: int):
        self.text, self.path, self.linked = text, path, linked


def name_words(attributes: str) -> tuple[str, ...]:
    """Lower-case words of the class, id and role attributes."""
    if "=" not in attributes:
        return ()
    return tuple(w.lower() for m in _NAMES.finditer(attributes) for w in _WORD.findall(m[2] or m[3] or m[4] or ""))


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page that have text: white space collapsed, references decoded."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], int]] = []
    held: list[str] = []
    linked = silent = links = number = at = 0

    def text(raw: str):
        nonlocal linked
        if raw and not silent:
            held.append(raw)
            if links:
                linked += len(raw)

    def flush():
        nonlocal linked, held
        if held:
            line = " ".join(html.unescape("".join(held)).split())
            if line:
                out.append(Block(line, tuple(e for e in stack if e[0] in BLOCK_TAGS or e[1]), min(linked, len(line))))
            held, linked = [], 0

    def pop():
        nonlocal silent, links
        tag = stack.pop()[0]
        silent -= tag in SILENT_TAGS
        links -= tag == "a"

    def pop_to(tags, barriers):
        """Close the innermost open element of ``tags`` unless a barrier lies inside it."""
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                while len(stack) > k:
                    pop()
                return True
            if stack[k][0] in barriers:
                return False
        return False

    while True:
        m = _MARKUP.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if tag in BLOCK_TAGS:
            flush()
        elif tag == "br":
            text(" ")
        if m[1] or m[4]:
            if tag == "p" and not any(e[0] == "p" for e in stack):
                continue
            pop_to({tag}, {"table"} if tag not in ("table", "body", "html") and tag not in ("div", "article", "section", "main") else ())
            continue
        if tag in PARAGRAPH_ENDERS:
            pop_to({"p"}, {"button", "td", "th", "table", "div", "article", "section", "body", "li"})
        if tag in CLOSES:
            while pop_to(*CLOSES[tag]):
                pass
        attributes = m[3] if m[2] else m[6]
        if tag in VOID_TAGS or attributes.endswith("/") and tag not in BLOCK_TAGS:
            continue
        if tag in RAW_TAGS:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        number += 1
        stack.append((tag, name_words(attributes), number))
        silent += tag in SILENT_TAGS
        links += tag == "a"
    flush()
    return out


# ---- features ----------------------------------------------------------------------------------

def _id(feature: str) -> int:
    return zlib.crc32(feature.encode()) % DIM


_ids: dict[str, int] = {}


def feature_id(feature: str) -> int:
    """Number of a feature; names come from a page's mark-up, so the memory of them is kept small."""
    got = _ids.get(feature)
    if got is None:
        if len(_ids) > 20000:
            _ids.clear()
        got = _ids[feature] = _id(feature)
    return got


def features(found: list[Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block of each feature, feature, kind of the step to each block: 0 first, 1 same parent, 2 other) of a page."""
    sizes = [len(b.text) for b in found]
    total = sum(sizes) or 1
    inside: dict[int, int] = {}
    for b, n in zip(found, sizes):
        for e in b.path:
            inside[e[2]] = inside.get(e[2], 0) + n
    headed = False
    rows, cols, steps = [], [], []
    parent = None
    for k, (b, n) in enumerate(zip(found, sizes)):
        own = b.path[-1] if b.path else ("", (), 0)
        words = b.text.count(" ") + 1
        names = {f"a:{e[0]}" for e in b.path}
        for e in b.path:
            names.update([f"n:{w}" for w in e[1]])
        names.update([f"o:{w}" for w in own[1]])
        container = next((e for e in reversed(b.path) if e[0] not in ("p", "li", "ul", "ol", "b", "span", "a")), own)
        headed |= own[0] in ("h1", "h2")
        names.update((
            "bias", f"p:{own[0]}", f"len:{n.bit_length()}", f"words:{words.bit_length()}",
            f"link:{round(4 * b.linked / n)}", f"stop:{min(3, sum(map(b.text.count, '.!?')))}",
            f"end:{b.text[-1] if not b.text[-1].isalnum() and b.text[-1].isascii() else 'w'}",
            f"share:{round(8 * inside.get(container[2], total) / total)}", f"headed:{headed}",
            f"edge:{min(k, 2)}", f"tail:{min(len(found) - 1 - k, 2)}"))
        if "©" in b.text:
            names.add("copyright")
        cols += map(feature_id, names)
        rows += [k] * len(names)
        same = parent is not None and own[2] and (own[2] == parent[0] or (b.path[-2][2] if len(b.path) > 1 else 0) == parent[1])
        steps.append(0 if k == 0 else 1 if same else 2)
        parent = (own[2], b.path[-2][2] if len(b.path) > 1 else 0)
    return np.array(rows, np.int64), np.array(cols, np.int64), np.array(steps, np.int64)


# ---- the field ---------------------------------------------------------------------------------

class Field:
    """Weights: ``w`` score the label content by feature; ``t[kind, before, after]`` score neighbours."""

    def __init__(self, w: np.ndarray, t: np.ndarray):
        self.w, self.t = w, t

    def decode(self, found: list[Block]) -> np.ndarray:
        """Labels of the blocks of a page, by Viterbi."""
        n = len(found)
        if not n:
            return np.zeros(0, bool)
        rows, cols, steps = features(found)
        score = np.bincount(rows, self.w[cols], n).tolist()
        t = self.t.tolist()
        no, yes, back = 0.0, score[0], []
        for k in range(1, n):
            step = t[steps[k]]
            a, b, c, d = no + step[0][0], yes + step[1][0], no + step[0][1], yes + step[1][1]
            back.append((b > a, d > c))
            no, yes = max(a, b), max(c, d) + score[k]
        out = np.zeros(n, bool)
        label = yes > no
        out[-1] = label
        for k in range(n - 2, -1, -1):
            label = back[k][label]
            out[k] = label
        return out


def fit(pages: list[tuple[list[Block], np.ndarray]], steps: int = STEPS, rate: float = 0.1, decay: float = 2e-4) -> Field:
    """The field of maximum likelihood (with an L2 penalty) over labelled pages, by Adam. Pages run
    side by side: one numpy step of forward-backward per block position."""
    pages = sorted((p for p in pages if p[0]), key=lambda p: -len(p[0]))
    w, t = np.zeros(DIM), np.zeros((3, 2, 2))
    if not pages:
        return Field(w, t)
    many, longest = len(pages), len(pages[0][0])
    lengths = np.array([len(b) for b, _ in pages])
    alive = [int((lengths > k).sum()) for k in range(longest)]
    where, cols = [], []
    kind, gold = np.zeros((longest, many), np.int64), np.zeros((longest, many), np.int64)
    for j, (found, labels) in enumerate(pages):
        r, c, s = features(found)
        where.append(r * many + j)
        cols.append(c)
        kind[:len(s), j], gold[:len(s), j] = s, labels
    where, cols = np.concatenate(where), np.concatenate(cols)
    used = np.zeros((longest, many), bool)
    for k, n in enumerate(alive):
        used[k, :n] = True
    blocks_ = int(used.sum())
    gold_t = np.zeros((3, 2, 2))
    for k in range(1, longest):
        n = alive[k]
        np.add.at(gold_t, (kind[k, :n], gold[k - 1, :n], gold[k, :n]), 1)
    m, v = np.zeros(DIM + 12), np.zeros(DIM + 12)
    for step in range(1, steps + 1):
        s = np.bincount(where, w[cols], longest * many).reshape(longest, many)
        forward, back = np.zeros((longest, many, 2)), np.zeros((longest, many, 2))
        forward[0, :, 1] = s[0]
        for k in range(1, longest):
            n = alive[k]
            f = np.logaddexp.reduce(forward[k - 1, :n, :, None] + t[kind[k, :n]], axis=1)
            f[:, 1] += s[k, :n]
            forward[k, :n] = f
        z = np.logaddexp(*forward[lengths - 1, np.arange(many)].T)
        grad_t = -gold_t
        for k in range(longest - 2, -1, -1):
            n = alive[k + 1]
            after = back[k + 1, :n].copy()
            after[:, 1] += s[k + 1, :n]
            both = t[kind[k + 1, :n]] + after[:, None, :]
            np.add.at(grad_t, kind[k + 1, :n], np.exp(forward[k, :n, :, None] + both - z[:n, None, None]))
            back[k, :n] = np.logaddexp.reduce(both, axis=2)
        p = np.where(used, np.exp(forward[:, :, 1] + back[:, :, 1] - z), 0)
        grad = np.append(np.bincount(cols, (p - gold).ravel()[where], DIM), grad_t.ravel()) / blocks_
        grad += decay / 10 * np.append(w, t.ravel())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, t = w - move[:DIM], t - move[DIM:].reshape(3, 2, 2)
    return Field(w, t)


# ---- labelled pages ----------------------------------------------------------------------------

OTHER_TAGS = frozenset("nav aside footer form menu dialog search".split())


def labels_by_markup(found: list[Block]) -> np.ndarray | None:
    """Labels of a page that names its article: content is inside the one ``article`` (or else ``main``) element and
    not in an element of `OTHER_TAGS` inside it. None if there is no such element, or several."""
    for tag in ("article", "main"):
        named = {e[2] for b in found for e in b.path if e[0] == tag}
        if len(named) == 1:
            out = np.zeros(len(found), bool)
            for k, b in enumerate(found):
                tags = [e[0] for e in b.path]
                out[k] = tag in tags and not OTHER_TAGS & set(tags[tags.index(tag):])
            return out
    return None


# How other sites dress a page: element paths ("tag.class#id") of its parts. One of each is drawn for a page.
LAYOUTS = {
    "outer": ["", "", "div.page", "div#wrapper", "div.container>div.row", "table>tr>td", "div#root>div.layout", "form#aspnet"],
    "head": ["header>div.site-title", "div#header", "div.masthead", "div.top-bar", "header", "div.banner-top", "header.site-header>p",
             "header>h1", "div.header>h1", "div#branding", "td.header"],
    "menu": ["nav>ul>li>a", "div.menu>ul>li>a", "div#navbar>a", "ul.navigation>li>a", "nav.breadcrumbs>a", "div.nav>span>a",
             "ol.breadcrumb>li>a", "div.topnav>ul>li>a", "div[role=navigation]>ul>li>a", "td.menu>a", "nav>a", "div.toolbar>a"],
    "advert": ["div.ad", "div.advert", "div.banner", "div.sponsored", "aside.promo", "div#ad-top", "div.ads>p", "div.advertisement>p",
               "section.promotion>p", "div.sponsor>a", "ins.adsbygoogle>div", "div.promo-box>p", "td.ad"],
    "notice": ["div.cookie-notice", "div#cookie-banner>p", "div.notice>p", "div.alert", "div.newsletter>p", "div#consent>p",
               "div.gdpr", "div.subscribe>p", "div.paywall>p", "div.disclaimer", "section.notice>p", "div.warning>p", "div.message",
               "div.popup>p", "dialog>p", "div[role=alert]>p", "p.notice", "div.modal>p", "div.privacy-notice"],
    "article": ["article", "article", "main", "main>article", "div.content", "div#content", "div.post", "div.entry-content", "div.article-body",
                "section.story", "div#main", "td.content", "div.text", "main#content>div", "div.post>div.entry", "div[role=main]",
                "article.post", "article>div.body", "div.article>div.text", "main>div.article", "section#article", "div.story-body", ""],
    "content": ["p"] * 14 + ["h2", "h3", "ul>li", "ol>li", "blockquote>p", "blockquote", "pre", "div", "p>em", "p>strong", "section>p",
                             "figure>figcaption", "table>tr>td", "dl>dd", "div>p", "p>b", "p>span"],
    "heading": ["h1", "h1", "header>h1", "h1.title", "h2.headline", "div.title>h1", "header.entry-header>h1"],
    "share": ["div.share>a", "div.social>a", "ul.share-buttons>li>a", "div.related>ul>li>a", "div.tags>a", "aside.related>p",
              "div.meta>a", "section.related>h3", "nav.pagination>a", "div.related>h3", "div.read-more>a"],
    "side": ["aside>p", "div.sidebar>p", "div#sidebar>ul>li>a", "aside.widget>h3", "div.right-column>p", "section.widget>ul>li>a",
             "td.side>a", "aside>ul>li>a", "aside>h3", "div.sidebar>div.widget>p", "aside>div>p", "div[role=complementary]>p"],
    "comment": ["div.comments>div.comment>p", "section.comments>article.comment>p", "ol.comment-list>li>p", "div#comments>div>p",
                "div#disqus>p", "ul.comments>li>div.comment-body>p", "section#comments>h2", "div.discussion>p", "div.replies>div.reply>p",
                "section.comments>p", "section.comments>div>p", "div.comments>ul>li", "section.reader-comments>p", "div.responses>div>p",
                "div.comments>h3", "div.comment", "div.comment>p", "section.comments>ol>li>p"],
    "form": ["form>label", "form.search>p", "div.search>form>label", "form#login>div", "form.contact>fieldset>legend", "form>p", "form>div>label",
             "form>fieldset>p", "form.newsletter>p", "div.signup>form>p"],
    "foot": ["footer", "div#footer", "div.footer>p", "footer>div.copyright", "div.colophon", "footer>ul>li>a", "div.bottom>p", "td.footer",
             "footer>p", "div.legal>p", "div[role=contentinfo]>p", "footer.site-footer>div>p"],
}


def _opened(path: str) -> tuple[str, str]:
    """(start tags, end tags) of a path such as ``div.menu>ul>li``."""
    start, end = "", ""
    for part in path.split(">") if path else []:
        tag = re.match(r"[a-z0-9]+", part)[0]
        cls = " ".join(re.findall(r"\.([\w-]+)", part))
        ident = "".join(re.findall(r"#([\w-]+)", part))
        role = "".join(re.findall(r"\[role=(\w+)\]", part))
        start += f"<{tag}" + (f' class="{cls}"' if cls else "") + (f' id="{ident}"' if ident else "") + (f' role="{role}"' if role else "") + ">"
        end = f"</{tag}>" + end
    return start, end


def dressed(content: list[str], other: list[str], seed: int) -> tuple[str, list[bool]]:
    """A page of another layout with the given content blocks and texts of other blocks around and between, and the label
    of every block in order."""
    rng = np.random.default_rng(seed)
    out, labels = [], []

    def draw(part: str) -> str:
        return LAYOUTS[part][rng.integers(len(LAYOUTS[part]))]

    def put(path: str, text: str, label: bool):
        if text.strip():
            start, end = _opened(path)
            out.append(f"{start}{html.escape(text)}{end}")
            labels.append(label)

    def words(low: int, high: int) -> str:
        """Some words of the other texts (or of the content), as a title or a line."""
        source = (other or content)[rng.integers(len(other or content))] if rng.random() < 0.7 or not content else content[rng.integers(len(content))]
        return " ".join(source.split()[:int(rng.integers(low, high + 1))])

    def sentences() -> str:
        """Running text as readers, notices and adverts have it."""
        return content[rng.integers(len(content))][:int(rng.integers(20, 600))] if content else words(3, 30)

    def several(part: str, low: int, high: int, make):
        path = draw(part)
        group, _, item = path.rpartition(">") if rng.random() < 0.7 else ("", "", path)
        # items without a block element run together into one block
        apart = any(re.match(r"[a-z0-9]+", x)[0] in BLOCK_TAGS for x in item.split(">"))
        texts = [x for x in (make() for _ in range(int(rng.integers(low, high + 1)))) if x.strip()]
        start, end = _opened(group) if texts else ("", "")
        out.append(start)
        for k, x in enumerate(texts):
            put(item, x, False)
            if k and not apart:
                labels.pop()
                out.insert(-1, " ")
        out.append(end)

    def maybe(chance: float, *args):
        if rng.random() < chance:
            several(*args)

    outer = _opened(draw("outer"))
    out.append("<html><head><title>x</title></head><body>" + outer[0])
    maybe(0.6, "head", 1, 2, lambda: words(1, 9))
    maybe(0.7, "menu", 2, 8, lambda: words(1, 2))
    maybe(0.4, "notice", 1, 2, sentences)
    maybe(0.5, "advert", 1, 2, sentences)
    maybe(0.2, "form", 1, 3, lambda: words(1, 4))
    maybe(0.2, "side", 1, 4, lambda: words(1, 20))
    start, end = _opened(draw("article"))
    out.append(start)
    plain = rng.random() < 0.4  # paragraphs only
    for k, text in enumerate(content):
        put(draw("heading") if k == 0 and rng.random() < 0.7 else "p" if plain else draw("content"), text, True)
        if rng.random() < 0.06:
            several(("advert", "share", "notice", "form", "side")[rng.integers(5)], 1, 3, sentences if rng.random() < 0.5 else lambda: words(1, 6))
    maybe(0.3, "share", 1, 4, lambda: words(1, 6))
    inside = rng.random() < 0.4
    if inside:
        maybe(0.6, "comment", 1, 5, sentences)
    out.append(end)
    if not inside:
        maybe(0.5, "comment", 1, 6, sentences)
    maybe(0.3, "form", 1, 3, lambda: words(1, 4))
    maybe(0.4, "side", 1, 5, lambda: sentences() if rng.random() < 0.4 else words(1, 20))
    maybe(0.2, "notice", 1, 1, sentences)
    maybe(0.8, "foot", 1, 3, lambda: words(2, 16))
    out.append(outer[1] + "</body></html>")
    return "".join(out), labels


def labelled(pages: list[tuple[int, str]], dresses: int = DRESSES) -> list[tuple[list[Block], np.ndarray]]:
    """Labelled pages out of (number, html): those that name their article, and re-dressed copies."""
    out, parts = [], []
    for number, page in pages:
        found = blocks(page)
        labels = labels_by_markup(found)
        if labels is not None:
            out.append((found, labels))
        else:  # the longest texts can stand for content in a layout; the page itself stays unlabelled
            labels = np.array([len(b.text) > 80 for b in found], bool)
        parts.append((number, [b.text for b, y in zip(found, labels) if y], [b.text for b, y in zip(found, labels) if not y]))
    for number, content, other in parts:
        for k in range(dresses if content else 0):
            page, labels = dressed(content, other, zlib.crc32(f"{number}/{k}".encode()))
            found = blocks(page)
            if len(found) == len(labels):  # not where mark-up cannot nest, as a table in a paragraph
                out.append((found, np.array(labels, bool)))
    return out


def train(pages: DataFrame, limit: int = PAGES, page_bytes: int = PAGE_BYTES, dresses: int = DRESSES, id_col: str = "page_id",
          html_col: str = "html") -> Field:
    """The field fitted on a bounded sample of the pages; see the module docstring."""
    rows = (pages.select(pages[id_col].cast("long").alias("id"), pages[html_col].cast("string").alias("html"))
            .where((F.octet_length("html") <= page_bytes) & F.col("id").isNotNull()))
    ids = rows.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(limit)
    # at most ``limit`` ids of 8 bytes; of several rows of an id the one with the smallest hash
    first = F.min(F.struct(F.xxhash64("html").alias("h"), F.col("html").alias("html"))).alias("first")
    sample = rows.join(F.broadcast(ids), "id").groupBy("id").agg(first).select("id", "first.html").collect()
    return fit(labelled([(r.id, r.html) for r in sorted(sample, key=lambda r: r.id)], dresses))


# ---- the operator ------------------------------------------------------------------------------

def main_text(page: str, field: Field) -> str:
    """The content blocks of a page, one per line."""
    found = blocks(page)
    return "\n".join(b.text for b, y in zip(found, field.decode(found)) if y)


def extract(pages: DataFrame, field: Field, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text`` of every row of ``pages``."""
    shared = pages.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        for b in slices(batches):
            text = [main_text(p, shared.value) if p else "" for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string())], ["id", "url", "text"])

    return (pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"),
                         pages[html_col].cast("string").alias("html"))
            .mapInArrow(run, "id long, url string, text string"))


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, train(pages)).select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
