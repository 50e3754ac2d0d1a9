"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is read into leaf blocks: runs of text that no block-level tag interrupts, each with the tags, classes and ids that
are open around it. Features of a block are its ancestors' tags and name parts, its own tag, its share of linked text, its
length and its punctuation. The field has two labels (main text or not), a weight for each feature, and one for each pair of
neighbouring labels. It is trained on labelled pages by Adam on the exact log-likelihood (forward and backward sums in
numpy), and pages are decoded by Viterbi.

No labelled pages come with the data, so labelled_pages() writes some: SAMPLE pages of random words in many layouts whose
parts are known, with broken markup too. train() takes any others of the same form.

Null and empty pages, and pages without main text, give an empty string. Scripts, styles, comments, the title and form fields
are no blocks; the text of formulas, drawings and unknown tags stands where it is. Markup that the page's end cuts off is
dropped; an open comment or script takes the rest of the page with it. Rows are read one by one, so repeated rows give equal
texts, ids may be null or repeated, and columns that aren't kept may have any name; a label's tie goes to "not main text". A
table without rows gives none. Time and memory grow with the page, however deep its tags are.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import small_batches

SAMPLE, EPOCHS = 600, 120
TAG = re.compile(r"""<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|$)|[!?/][^>]*+(?:>|$))""")
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SILENT = {"script", "style", "noscript", "template", "title", "textarea", "iframe", "select"}
END = {t: re.compile(rf"</{t}\b[^>]*>?", re.I) for t in SILENT}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
#: Tags that end a block; all others stand within one, formulas, drawings and unknown tags too.
BLOCKS = set("html head body address article aside blockquote button center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li legend main menu nav ol optgroup option p pre search section summary table caption colgroup thead tbody tfoot tr td th ul".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li".split())
PARTS = {"ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "banner", "nav", "navbar", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar", "side", "aside", "widget", "related", "share", "social", "comment", "comments", "reply", "replies", "cookie", "consent", "notice", "popup", "modal", "newsletter", "subscribe", "signup", "login", "search", "form", "copyright", "legal", "content", "article", "post", "entry", "main", "body", "story", "text", "page"}


class Node:
    """An open tag. What its blocks say of their ancestors is shared with the parent where it is the same, so depth costs nothing."""

    __slots__ = ("after", "known", "name", "parent", "parts", "tags")

    def __init__(self, parent: Node | None, name: str, parts: frozenset[str]):
        self.parent, self.name, self.known = parent, name, None
        none = frozenset()
        tags, all_parts, after = (parent.tags, parent.parts, parent.after) if parent else (none, none, None)
        self.tags = tags if name in tags else tags | {name}
        self.parts = all_parts if parts <= all_parts else all_parts | parts
        if name in ("article", "main"):
            self.after = none
        else:
            self.after = after if after is None or name in after else after | {name}

    def around(self) -> tuple[str, ...]:
        """Features of a block's ancestors."""
        if self.known is None:
            found = {f"in:{t}" for t in self.tags} | {f"name:{p}" for p in self.parts} | {f"within:{t}" for t in self.after or ()}
            found |= {f"own:{self.name}", f"up:{self.parent.name if self.parent else ''}"}
            self.known = tuple(sorted(found))
        return self.known


class Block:
    __slots__ = ("linked", "node", "pieces", "text")

    def __init__(self, node: Node | None):
        self.node, self.pieces, self.linked, self.text = node, [], 0, ""


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order, empty ones left out."""
    out: list[Block] = []
    node: Node | None = None
    depth = Counter()  # open tags by name
    block = None
    links = at = 0
    end = len(page)

    def say(piece: str) -> None:
        nonlocal block
        if block is None:
            if piece.isspace():
                return
            block = Block(node)
        block.pieces.append(piece)
        if links:
            block.linked += len(piece)

    def close() -> None:
        nonlocal block
        if block is not None:
            block.text = " ".join(html.unescape("".join(block.pieces)).split())
            if block.text:
                out.append(block)
            block = None

    while at < end:
        m = TAG.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        if m[1]:
            stop = page.find("-->", m.end() - 2)
            at = end if stop < 0 else stop + 3
            continue
        name = (m[3] or m[6] or "").lower()
        if not name:
            continue
        closing = bool(m[2] or m[5])
        if name in SILENT:
            if not closing and not (m[4] or m[7] or "").endswith("/"):
                stop = END[name].search(page, at)
                at = stop.end() if stop else end
                if name not in ("script", "style", "noscript", "template"):
                    close()
            continue
        if name not in BLOCKS:
            if name == "br":
                say(" ")
            elif name == "a":
                links = max(0, links - 1) if closing else 1
            continue
        close()
        if closing:
            while depth[name]:  # up to the tag that it closes
                depth[node.name] -= 1
                closed, node = node.name, node.parent
                if closed == name:
                    break
        elif name not in VOID:
            if node and (node.name == "p" and name in CLOSES_P or node.name == name and name in ("li", "td", "th", "tr", "dt", "dd")):
                depth[node.name] -= 1
                node = node.parent
            attrs = m[4] or m[7] or ""
            parts = frozenset({p.lower() for x in NAMES.findall(attrs) for p in PART.findall("".join(x))} & PARTS) if "=" in attrs else frozenset()
            links = 0
            depth[name] += 1
            node = Node(node, name, parts)
    close()
    return out


COPYRIGHT = re.compile(r"©|\(c\)|copyright|all rights reserved|cookie|subscribe|sign up", re.I)


def features(b: Block) -> list[str]:
    n = len(b.text)
    size = "0" if n < 12 else "1" if n < 30 else "2" if n < 80 else "3" if n < 250 else "4"
    share = b.linked / max(1, sum(map(len, b.pieces)))
    link = "0" if share == 0 else "1" if share < 0.4 else "2" if share < 0.9 else "3"
    end = "1" if b.text[-1] in ".!?:;\"'”»…" else "0"
    out = [*(b.node.around() if b.node else ("own:", "up:")), "size:" + size, "link:" + link, "end:" + end, f"size:{size}:{link}"]
    if n < 400 and COPYRIGHT.search(b.text):
        out.append("says:legal")
    return out


class Field:
    """Weights for label 1 against label 0: a dictionary of features, and of the pairs of labels."""

    def __init__(self, weights: dict[str, float], pairs: list[list[float]], first: float):
        self.weights, self.pairs, self.first = weights, pairs, first

    def decode(self, found: list[list[str]]) -> list[int]:
        """Viterbi."""
        if not found:
            return []
        get = self.weights.get
        (aa, ab), (ba, bb) = self.pairs
        zero, one, back = 0.0, self.first, []
        for i, f in enumerate(found):
            if i:
                back.append((aa + zero < ba + one, ab + zero < bb + one))
                zero, one = max(aa + zero, ba + one), max(ab + zero, bb + one)
            one += sum([get(x, 0.0) for x in f])
        label = int(one > zero)
        out = [label]
        for b in reversed(back):
            label = int(b[label])
            out.append(label)
        return out[::-1]


def train(pages: list[tuple[str, list[int]]], epochs: int = EPOCHS) -> Field:
    """Fit a Field to (page, labels of its blocks)."""
    rows = [([features(b) for b in blocks(p)], y) for p, y in pages]
    rows = [(x, y) for x, y in rows if x and len(x) == len(y)]
    names = {f: i for i, f in enumerate(sorted({f for x, _ in rows for b in x for f in b}))}
    long = max((len(x) for x, _ in rows), default=1)
    design = np.zeros((len(rows), long, len(names)), np.float32)
    mask, label = np.zeros((len(rows), long)), np.zeros((len(rows), long), np.int64)
    for i, (x, y) in enumerate(rows):
        mask[i, : len(x)], label[i, : len(y)] = 1, y
        for j, b in enumerate(x):
            design[i, j, [names[f] for f in b]] = 1
    w = np.zeros(len(names) + 5)
    step, square = np.zeros_like(w), np.zeros_like(w)
    gold = np.zeros_like(w)
    gold[: len(names)] = np.einsum("ntf,nt->f", design, mask * label)
    for a in (0, 1):
        for b in (0, 1):
            gold[len(names) + 2 * a + b] = ((label[:, :-1] == a) & (label[:, 1:] == b) & (mask[:, 1:] > 0)).sum()
    gold[-1] = label[:, 0].sum()
    for t in range(1, epochs + 1):
        score = np.zeros((len(rows), long, 2))
        score[..., 1] = design @ w[: len(names)].astype(np.float32)
        score[:, 0, 1] += w[-1]
        pair = w[-5:-1].reshape(2, 2)
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for j in range(1, long):
            new = np.logaddexp(ahead[:, j - 1, :1] + pair[0], ahead[:, j - 1, 1:] + pair[1]) + score[:, j]
            ahead[:, j] = np.where(mask[:, j, None] > 0, new, ahead[:, j - 1])
        for j in range(long - 2, -1, -1):
            nxt = score[:, j + 1] + behind[:, j + 1]
            new = np.logaddexp(pair[:, 0] + nxt[:, :1], pair[:, 1] + nxt[:, 1:])
            behind[:, j] = np.where(mask[:, j + 1, None] > 0, new, 0)
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        p = np.exp(ahead + behind - total[:, None, None]) * mask[..., None]
        want = np.zeros_like(w)
        want[: len(names)] = np.einsum("ntf,nt->f", design, p[..., 1].astype(np.float32))
        for a in (0, 1):
            for b in (0, 1):
                both = ahead[:, :-1, a] + pair[a, b] + score[:, 1:, b] + behind[:, 1:, b] - total[:, None]
                want[len(names) + 2 * a + b] = (np.exp(both) * mask[:, 1:]).sum()
        want[-1] = p[:, 0, 1].sum()
        grad = (want - gold) / max(1, len(rows)) + 0.002 * w
        step += 0.1 * (grad - step)
        square += 0.01 * (grad * grad - square)
        w -= 0.15 * (step / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    return Field({f: float(w[i]) for f, i in names.items()}, w[-5:-1].reshape(2, 2).tolist(), float(w[-1]))


def labelled_pages(n: int = SAMPLE, seed: int = 17) -> list[tuple[str, list[int]]]:
    """Pages of random words in many layouts, each with the labels of its blocks."""
    r = random.Random(seed)
    syllables = ["".join(x) for x in ((a, b) for a in "bcdfglmnprstv" for b in "aeiou")]

    def word():
        return "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))

    def text(low, high, stop="."):
        return (" ".join(word() for _ in range(r.randint(low, high)))).capitalize() + stop

    def page():
        out, labels = [], []

        def put(markup, *y):
            out.append(markup)
            labels.extend(y)

        def wrap(tag, names, body):
            attr = r.choice([f' class="{r.choice(names)}"', f' id="{r.choice(names)}"', f" class='x {r.choice(names)}'"]) if names else ""
            out.append(f"<{tag}{attr}>")
            body()
            out.append(f"</{tag}>")

        def links(k):
            out.append("<ul>")
            for _ in range(k):
                put(f'<li><a href="/{word()}">{text(1, 3, "")}</a></li>', 0)
            out.append("</ul>")

        def paragraph(y):
            t = text(1, 4) if r.random() < 0.15 else text(6, 90)
            if r.random() < 0.25:
                t = t.replace(" ", f' <a href="#">{word()}</a> ', 1)
            if r.random() < 0.1:
                t = f'<a href="#">{t}</a>'
            put(r.choice(["<p>{}</p>"] * 5 + ["<p><b>{}<br>", "<p>{}", "<p><em>{}</em></p>", "<p>{}&amp;&quot;</p>"]).format(t), y)

        def aside():
            kind = r.choice(["ad", "side", "comment", "form", "notice", "related", "share"])
            if kind == "ad":
                wrap(r.choice(["div", "aside", "section"]), ["ad", "ads", "advert", "ad-slot", "sponsored", "promo", "banner"], lambda: put(r.choice(["{}", "<p>{}</p>"]).format(text(3, 25)), 0))
            elif kind == "side":
                def body():
                    put(f"<h3>{text(1, 4, '')}</h3>", 0)
                    if r.random() < 0.5:
                        links(r.randint(2, 5))
                    else:
                        put(f"<p>{text(5, 40)}</p>", 0)

                wrap(*r.choice([("aside", []), ("aside", ["sidebar"]), ("div", ["sidebar", "side", "widget"])]), body)
            elif kind == "comment":
                def body():
                    if r.random() < 0.6:
                        put(f"<h2>{text(1, 2, '')}</h2>", 0)
                    for _ in range(r.randint(1, 4)):
                        t = text(3, 50)
                        put(r.choice([f"<p>{t}</p>", f'<div class="comment">{t}</div>', f"<li>{t}</li>"]), 0)

                wrap(r.choice(["section", "div", "ol"]), ["comments", "comment-list", "comments-area", "replies"], body)
            elif kind == "form":
                def body():
                    put(f"<p>{text(2, 12)}</p>", 0) if r.random() < 0.6 else None
                    put(f"<label>{text(1, 2, '')}</label><input name='q'>", 0)
                    put(f"<button>{text(1, 2, '')}</button>", 0)

                wrap("form", r.choice([[], ["search", "newsletter", "login", "subscribe"]]), body)
            elif kind == "notice":
                wrap("div", ["cookie", "cookie-banner", "notice", "consent", "popup", "modal"], lambda: put(f"<p>{r.choice(['', 'We use cookies. ', ''])}{text(4, 30)}</p>", 0))
            elif kind == "related":
                wrap("div", ["related", "related-posts"], lambda: links(r.randint(2, 4)))
            else:
                wrap("div", ["share", "social"], lambda: put(f'<a href="#">{word()}</a> <a href="#">{word()}</a>', 0))

        def article():
            if r.random() < 0.15:
                wrap("header", [], lambda: put(f"<h1>{text(2, 12, r.choice(['', '.']))}</h1>", 1))
            elif r.random() < 0.9:
                put(f"<h1>{text(2, 12, r.choice(['', '.']))}</h1>", 1)
            for _ in range(r.randint(1, 12)):
                x = r.random()
                if x < 0.72:
                    paragraph(1)
                elif x < 0.8:
                    put(f"<h{r.choice('2234')}>{text(1, 8, '')}</h2>", 1)
                elif x < 0.85:
                    out.append("<ul>")
                    for _ in range(r.randint(1, 4)):
                        put(f"<li>{text(1, 15, r.choice(['', '.']))}</li>", 1)
                    out.append("</ul>")
                elif x < 0.88:
                    put(f"<blockquote><p>{text(5, 30)}</p></blockquote>", 1)
                elif x < 0.9:
                    put(f"<table><tr><td>{text(1, 3, '')}</td><td>{text(1, 3, '')}</td></tr></table>", 1, 1)
                elif x < 0.92:
                    put(f"<pre>{text(2, 20, '')}</pre>", 1)
                else:
                    aside()

        out.append("<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>")
        if r.random() < 0.3:
            def top():
                put(r.choice([f"<h1>{text(1, 3, '')}</h1>", f'<a href="/">{word()}</a>', f"<div>{text(1, 4, '')}</div>"]), 0)
                put(f"<p>{text(2, 10)}</p>", 0) if r.random() < 0.4 else None

            wrap("header", r.choice([[], ["header", "masthead"]]), top)
        if r.random() < 0.8:
            wrap(*r.choice([("nav", []), ("nav", ["menu"]), ("div", ["nav", "menu", "navbar"])]), lambda: links(r.randint(2, 7)))
        for _ in range(r.choice([0, 1, 1, 2])):
            aside()
        wrap(*r.choice([("article", [])] * 4 + [("article", ["post", "entry", "story"]), ("main", []), ("main", ["content"]), ("div", ["content", "article-body", "post-content", "entry", "main", "story"])]), article)
        for _ in range(r.choice([0, 0, 1, 2])):
            aside()
        if r.random() < 0.85:
            t = r.choice([f"&copy; {word()}.example.com &middot; {text(2, 9)}", text(2, 20), f'<a href="/x">{word()}</a> {text(1, 4)}', f"Copyright {word()}"])
            wrap(*r.choice([("footer", [])] * 3 + [("div", ["footer", "copyright", "legal"])]), lambda: put(r.choice(["{}", "<p>{}</p>"]).format(t), 0))
        out.append(r.choice(["</body></html>", "", "</html>"]))
        return "".join(out), labels

    return [page() for _ in range(n)]


@functools.lru_cache(1)
def default_field() -> Field:
    return train(labelled_pages())


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page or "")
    return " ".join(b.text for b, y in zip(found, field.decode([features(b) for b in found]), strict=True) if y)


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html", field: Field | None = None) -> DataFrame:
    """(keep..., text, n_chars) of each row; no shuffle."""
    sent = pages.sparkSession.sparkContext.broadcast(field or default_field())  # one weight a feature of the training pages
    names = [*keep, "text", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for b in small_batches(batches):
            found = [main_text(p, own) for p in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], names)

    kinds = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keep)
    return pages.select(*keep, F.col(html_col)).mapInArrow(run, f"{kinds}, text string, n_chars long")
