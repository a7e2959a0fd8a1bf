"""Main-text extraction: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks (text between block-level boundaries) with their ancestor tags; each block gets ancestor-tag, attribute-word
and text features; the chain's two labels (main text or not) are decoded by Viterbi. The field is trained on the driver from labelled
pages; where none are given, from ``labelled_pages``, a generated set of page layouts.

Cases: null or empty html gives an empty text; text outside any element is a block of the page; unclosed and stray tags are repaired
as far as block boundaries need it; a page is read whole, in time linear in its length; repeated rows give equal results; other columns don't matter;
an empty table gives no row.
"""

from __future__ import annotations

import html as htmllib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

EXTRACTED = "page_id long, url string, text string, n_chars long"
# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr svg math".split())
RAW = frozenset("script style template iframe title textarea select".split())  # content that isn't seen
ENDLESS = frozenset("script style title textarea".split())  # these run to the end of the page where their end tag is missing
EMBEDDED = frozenset("object canvas audio video noscript".split())  # may stand in a paragraph
FOREIGN = frozenset("svg math".split())
FLOW = frozenset("address article aside blockquote body button datalist dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol optgroup option p pre section table tbody td tfoot th thead tr ul".split())  # end drawings and formulas
CLOSES = {  # an opening tag ends these open elements
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "thead": {"tr", "td", "th"}, "tfoot": {"tr", "td", "th", "tbody"}, "body": {"head"},
}
BARRIER = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}, "option": {"select", "datalist", "optgroup"}}
DEPTH = 256  # elements nested deeper count as the deepest one's content, as browsers have it (at 512)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_IN_TAG = re.compile(r">|=\s*+([\"'])")
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")


class Block:
    """A leaf block: its text, the open elements around it as (tag, attribute words), and the letters inside links."""

    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple, linked: int):
        self.text, self.path, self.linked = text, path, linked


class _TagEnds:
    """Where tags end, in time linear in the page: a value's quote that is never closed is an ordinary sign, and is looked for once."""

    def __init__(self, page: str):
        self.page, self.last = page, {q: page.rfind(q) for q in "\"'"}

    def after(self, at: int) -> tuple[int, int]:
        """(end of the attributes, place behind the tag) of a tag whose name ends at ``at``."""
        while True:
            m = _IN_TAG.search(self.page, at)
            if not m:
                return len(self.page), len(self.page)
            if m[0] == ">":
                return m.start(), m.end()
            at = m.end()
            if at <= self.last[m[1]]:
                at = self.page.index(m[1], at) + 1


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order; scripts, styles and other unseen content left out."""
    page = page or ""
    ends = _TagEnds(page)
    over: dict[str, int] = {}  # open elements beyond DEPTH
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = links = 0
    at = 0
    foreign = False
    endless: set[str] = set()

    def text(raw: str) -> None:
        nonlocal linked
        if raw:
            plain = htmllib.unescape(raw) if "&" in raw else raw
            parts.append(plain)
            if links:
                linked += len(plain)

    def close() -> None:
        nonlocal linked
        if parts:
            joined = " ".join("".join(parts).split())
            if joined:
                out.append(Block(joined, tuple(x for x in stack if x[0] not in INLINE), linked))
            parts.clear()
        linked = 0

    def pop_to(names, barrier=()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in barrier:
                return
            if stack[i][0] in names:
                close()
                del stack[i:]
                return

    while True:
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        stop, at = ends.after(at)
        said = page[m.end() : stop]
        if foreign:
            first = next((i for i, x in enumerate(stack) if x[0] in FOREIGN), None)
            foreign = first is not None
            if foreign and tag in FLOW and not m[1]:
                del stack[first:]
                foreign = False
            elif foreign and tag not in FLOW and tag not in INLINE and tag not in RAW:
                parts.append(" " if tag == "text" else "")
                continue
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            if over.get(tag):
                over[tag] -= 1
                close() if tag not in INLINE else None
            elif tag in INLINE:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        del stack[i]
                        break
                    if stack[i][0] not in INLINE:
                        break
            else:
                close()
                pop_to({tag})
            continue
        if tag in RAW:
            close() if tag not in ("script", "template") and not foreign else None
            if not said.rstrip().endswith("/") and tag not in endless:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                if end:
                    at = end.end()
                elif tag in ENDLESS:
                    at = len(page)
                else:
                    endless.add(tag)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                links += 1
            if tag not in VOID and not (tag in FOREIGN and said.rstrip().endswith("/")):
                if len(stack) >= DEPTH and tag not in FOREIGN:
                    over[tag] = over.get(tag, 0) + 1
                    continue
                stack.append((tag, ()))
                foreign = foreign or tag in FOREIGN
            continue
        close()
        if tag not in EMBEDDED:
            pop_to({"p"}, {"table", "td", "th", "li", "blockquote", "article", "section", "div", "main", "aside", "button"})
        if tag in CLOSES:
            while any(x[0] in CLOSES[tag] for x in stack):
                n = len(stack)
                pop_to(CLOSES[tag], BARRIER.get(tag, ()))
                if len(stack) == n:
                    break
        links = 0 if tag in ("p", "li", "div", "article", "section") and not any(x[0] == "a" for x in stack) else links
        if tag not in VOID and len(stack) >= DEPTH:
            over[tag] = over.get(tag, 0) + 1
        elif tag not in VOID:
            words: list[str] = []
            for a in _ATTR.finditer(said):
                words += _NAME.findall((a[2] or a[3] or a[4] or "").lower())
            stack.append((tag, tuple(words)))
    close()
    return out


def features(found: list[Block]) -> list[list[str]]:
    """Feature names of each block."""
    out = []
    for i, b in enumerate(found):
        tags = [t for t, _ in b.path]
        names = {f"in:{t}" for t in tags} | {f"word:{w}" for _, words in b.path for w in words}
        names.add(f"parent:{tags[-1] if tags else '-'}")
        names.add("deep" if len(tags) > 6 else "flat")
        n = len(b.text)
        names.add(f"len:{min(7, n.bit_length())}")
        share = b.linked / max(n, 1)
        names.add("links:most" if share > 0.6 else "links:some" if share > 0.1 else "links:none")
        first = b.text[:1]
        names.add("start:sign" if not first.isalnum() else "start:word")
        names.add("end:stop" if b.text[-1:] in ".!?:;…\"”»" else "end:none")
        if "©" in b.text:
            names.add("copyright")
        words = b.text.count(" ") + 1
        names.add("words:1" if words == 1 else "words:few" if words < 8 else "words:many")
        names.add("first" if i == 0 else "last" if i == len(found) - 1 else "middle")
        out.append(sorted(names))
    return out


def same_parent(found: list[Block]) -> list[int]:
    """1 where a block has the same surrounding elements (without its own) as the one before it."""
    return [0] + [int(a.path[:-1] == b.path[:-1]) for a, b in zip(found, found[1:], strict=False)]


class Field:
    """Weights of features for label 1, and of label pairs for siblings and for others."""

    def __init__(self, weights: dict[str, float], steps: np.ndarray):
        self.weights, self.steps = weights, steps

    def decode(self, found: list[Block]) -> list[int]:
        """The most likely labels, by Viterbi; equal paths prefer main text."""
        if not found:
            return []
        get = self.weights.get
        gain = [get("bias", 0.0) + sum(get(f, 0.0) for f in names) for names in features(found)]
        s0, s1, back = 0.0, gain[0], []
        for g, kind in zip(gain[1:], same_parent(found)[1:], strict=True):
            (a00, a01), (a10, a11) = self.steps[kind].tolist()
            from0, from1 = s1 + a10 >= s0 + a00, s1 + a11 >= s0 + a01
            back.append((from0, from1))
            s0, s1 = max(s0 + a00, s1 + a10), max(s0 + a01, s1 + a11) + g
        label = int(s1 >= s0)
        labels = [label]
        for b in reversed(back):
            label = int(b[label])
            labels.append(label)
        return labels[::-1]


def fit(pages: list[tuple[str, list[int]]], rounds: int = 150, rate: float = 0.3, decay: float = 1e-3) -> Field:
    """A field by full-batch gradient steps on the exact log likelihood of labelled pages (html, label of each block)."""
    parsed = [(blocks(page), labels) for page, labels in pages]
    parsed = [(b, y) for b, y in parsed if b]
    if any(len(b) != len(y) for b, y in parsed):
        raise ValueError("a label for each block is needed")
    names = sorted({f for b, _ in parsed for x in features(b) for f in x})
    place = {f: i for i, f in enumerate(names)}
    n, most = len(parsed), max(len(b) for b, _ in parsed)
    rows, cols = [], []
    on = np.zeros((n, most), bool)
    gold, kind = np.zeros((n, most), int), np.zeros((n, most), int)
    for i, (b, y) in enumerate(parsed):
        on[i, : len(b)], gold[i, : len(b)], kind[i, : len(b)] = True, y, same_parent(b)
        for t, x in enumerate(features(b)):
            rows += [i * most + t] * len(x)
            cols += [place[f] for f in x]
    rows, cols = np.array(rows), np.array(cols)
    w, bias, steps = np.zeros(len(names)), 0.0, np.zeros((2, 2, 2))
    gw, gs = np.full(len(names), 1e-6), np.full((2, 2, 2), 1e-6)
    for _ in range(rounds):
        unary = np.zeros((n, most, 2))
        unary[..., 1] = (np.bincount(rows, w[cols], n * most) + bias).reshape(n, most)
        fore, aft = np.zeros((n, most, 2)), np.zeros((n, most, 2))
        fore[:, 0] = unary[:, 0]
        for t in range(1, most):
            step = np.logaddexp.reduce(fore[:, t - 1, :, None] + steps[kind[:, t]], axis=1) + unary[:, t]
            fore[:, t] = np.where(on[:, t, None], step, fore[:, t - 1])
        for t in range(most - 2, -1, -1):
            step = np.logaddexp.reduce(steps[kind[:, t + 1]] + (unary[:, t + 1] + aft[:, t + 1])[:, None, :], axis=2)
            aft[:, t] = np.where(on[:, t + 1, None], step, 0.0)
        total = np.logaddexp.reduce(fore[:, -1], axis=1)
        single = np.exp(fore + aft - total[:, None, None])[..., 1] * on
        miss = (single - gold) * on
        grad = np.bincount(cols, miss.ravel()[rows], len(names)) / n + decay * w
        pair = np.zeros((2, 2, 2))
        for t in range(1, most):
            both = np.exp(fore[:, t - 1, :, None] + steps[kind[:, t]] + (unary[:, t] + aft[:, t])[:, None, :] - total[:, None, None])
            both[np.arange(n), gold[:, t - 1], gold[:, t]] -= 1
            both *= on[:, t, None, None]
            for k in (0, 1):
                pair[k] += both[kind[:, t] == k].sum(0)
        pair = pair / n + decay * steps
        gw += grad * grad
        gs += pair * pair
        w -= rate * grad / np.sqrt(gw)
        steps -= rate * pair / np.sqrt(gs)
        bias -= rate * miss.sum() / n / 10
    return Field({"bias": float(bias)} | dict(zip(names, w.tolist(), strict=True)), steps)


def labelled_pages(n: int = 300, seed: int = 11) -> list[tuple[str, list[int]]]:
    """Generated pages of many layouts with a label for each block: 1 for the article's blocks."""
    rng = random.Random(seed)
    syllables = "ba ce di fo gu la me ni po ru sa te vi wo za ör ñu éa".split()

    def word() -> str:
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    def phrase(a: int, b: int) -> str:
        return " ".join(word() for _ in range(rng.randint(a, b))).capitalize()

    def prose(a: int, b: int) -> str:
        said = " ".join(phrase(2, 14) + rng.choice(".....!?,") for _ in range(rng.randint(a, b)))
        return said.replace(" ", " &amp; ", 1) if rng.random() < 0.1 else said

    out = []
    for _ in range(n):
        parts: list[str] = []
        labels: list[int] = []

        def add(markup: str, *said: int, parts=parts, labels=labels) -> None:
            parts.append(markup)
            labels.extend(said)

        def menu(k: int) -> tuple[str, int]:
            return "<ul>" + "".join(f'<li><a href="/{word()}">{phrase(1, 2)}</a></li>' for _ in range(k)) + "</ul>", k

        def ad(add=add) -> None:
            kind = rng.choice(["ad", "ads", "advert", "banner", "promo", "sponsored"])
            add(rng.choice(["", f"<!-- {kind} -->"]) + f'<div class="{kind}">{prose(1, 3)}</div>', 0)

        def notice(add=add) -> None:
            add(f'<div class="{rng.choice(["cookie", "cookie-banner", "notice", "consent", "newsletter", "alert", "popup"])}">{rng.choice(["<p>", ""])}{prose(1, 3)}</div>', 0)
            if rng.random() < 0.2:
                add(f"<noscript>{prose(1, 2)}</noscript>", 0)

        if rng.random() < 0.5:
            notice()
        if rng.random() < 0.5:
            add(f"<header>{rng.choice(['<div>', '<h1>', '<p>'])}{phrase(1, 5)}" + rng.choice(["</header>"]), 0)
        if rng.random() < 0.8:
            items, k = menu(rng.randint(2, 8))
            tag = rng.choice(["nav", "nav", 'div class="menu"', 'div id="navigation"'])
            add(f"<{tag}>{items}</{tag.split()[0]}>", *[0] * k)
        if rng.random() < 0.6:
            ad()
        if rng.random() < 0.4:
            add(f"<form action='/s'><label>{phrase(1, 2)}</label><input name=q><button>{phrase(1, 1)}</button></form>", *[0, 0])
            parts[-1] = f"<form action='/s'><div>{phrase(1, 2)}</div><input name=q><button>{phrase(1, 1)}</button></form>"
        if rng.random() < 0.3:
            add(f'<div class="sidebar"><h3>{phrase(1, 3)}</h3><p>{prose(1, 3)}</p></div>', 0, 0)
        shell = rng.choice(["article", "article", "article", "main", "main", 'div class="content"', 'div id="article"', 'div class="post"', "section", ""])
        parts.append(f"<{shell}>" if shell else "")
        if rng.random() < 0.8:
            level = rng.choice(["h1", "h1", "h2"])
            add(f"<{level}>{phrase(1, 10)}{rng.choice(['.', '', '', '###'])}</{level}>", 1)
        for k in range(rng.randint(1, 12)):
            kind = rng.random()
            if kind < 0.5:
                add(f"<p>{prose(1, 8)}" + rng.choice(["</p>", "</p>", ""]), 1)
            elif kind < 0.6:
                add(f"<p><b>{prose(1, 4)}<br>" + rng.choice(["", "</b>", "</b></p>"]), 1)
            elif kind < 0.66:
                add(f"<p>{phrase(1, 3)}.</p>", 1)
            elif kind < 0.72:
                add(f"<p>{prose(1, 3)} <a href='/x'>{phrase(1, 4)}</a> {prose(1, 2)}</p>", 1)
            elif kind < 0.78:
                add(f"<h2>{phrase(1, 5)}</h2>", 1)
            elif kind < 0.84:
                m = rng.randint(2, 4)
                add("<ul>" + "".join(f"<li>{prose(1, 2)}</li>" for _ in range(m)) + "</ul>", *[1] * m)
            elif kind < 0.88:
                add(f"<blockquote>{rng.choice(['', '<p>'])}{prose(1, 3)}</blockquote>", 1)
            elif kind < 0.91:
                add(f"<table><tr><td>{phrase(1, 3)}</td><td>{phrase(1, 3)}</td></tr></table>", 1, 1)
            elif kind < 0.94:
                add(f"<pre>{phrase(2, 9)}</pre>", 1)
            elif k:
                ad()
        if shell:
            parts.append(f"</{shell.split()[0]}>")
        if rng.random() < 0.5:
            where = rng.choice(["aside", 'div class="sidebar"', 'div class="related"', 'aside class="side"'])
            if rng.random() < 0.5:
                items, k = menu(rng.randint(2, 5))
                add(f"<{where}><h3>{phrase(1, 3)}</h3>{items}</{where.split()[0]}>", *[0] * (k + 1))
            else:
                add(f"<{where}><h3>{phrase(1, 3)}</h3><p>{prose(1, 4)}</p></{where.split()[0]}>", 0, 0)
        if rng.random() < 0.5:
            m = rng.randint(1, 5)
            box = rng.choice(['div class="comments"', 'section id="comments"', 'div id="disqus" class="comment-list"', 'ol class="comments"'])
            add(f"<{box}>" + "".join(f'<div class="comment"><p>{prose(1, 4)}</p></div>' for _ in range(m)) + f"</{box.split()[0]}>", *[0] * m)
        if rng.random() < 0.4:
            ad()
        if rng.random() < 0.85:
            tag = rng.choice(["footer", "footer", 'div class="footer"', 'div id="footer"'])
            add(f"<{tag}>{rng.choice(['&copy; ', '', 'Copyright '])}{phrase(1, 3)}{rng.choice([' &middot; ', ' | ', ' '])}{prose(1, 2)}</{tag.split()[0]}>", 0)
        head = f"<!DOCTYPE html><html><head><title>{phrase(1, 6)}</title><style>p{{margin:0}}</style><script>var a='<p>';</script></head><body>"
        out.append((head + "".join(parts) + rng.choice(["</body></html>", ""]), labels))
    return out


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page)
    return "\n\n".join(b.text for b, label in zip(found, field.decode(found), strict=True) if label)


def extract(pages: DataFrame, field: Field | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """EXTRACTED: the main text of every page."""
    field = field or fit(labelled_pages())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, 2):
            texts = [main_text(x, field) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string")).mapInArrow(run, EXTRACTED)
