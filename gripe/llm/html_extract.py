"""Main-text extraction with a linear-chain conditional random field over the leaf blocks of a page.

A page becomes the sequence of its leaf blocks (runs of text between block
tags).  Each block has features of its ancestors (tags, words of class, id and
role) and of its text (length, link share, punctuation).  The field's weights
are trained on labelled pages by gradient ascent on the conditional
likelihood (forward-backward), and Viterbi decoding chooses the blocks that
belong to the article.

Pages are independent: one scan, no shuffle.  Training uses a fixed, small set
of labelled pages (``labelled_pages.PAGES`` or the caller's own).

Defined cases: null or empty html gives an empty text; nothing is capped,
whatever the page's length; broken markup is read as far as it goes (an
unclosed script or comment reaches to the end); equal rows give equal texts;
an empty table gives an empty result.

Scripts, styles, templates, ``iframe`` fallbacks and the graphics of ``svg``
are no text; what ``math``, ``object``, ``noscript`` and custom elements hold
is.  ``<svg/>`` and ``<iframe/>`` are empty.  A graphic that is not closed ends
at the next HTML tag, and an ``iframe`` that is not closed is empty, so neither
takes the rest of the page with it.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled_pages import PAGES

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <(script|style)(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)
      | <(/?)([a-zA-Z][a-zA-Z0-9-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
      | <(/?)([a-zA-Z][a-zA-Z0-9-]*)([^>]*)>
      | <[!?][^>]*>""", re.S | re.I | re.X)
_TEMPLATE = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <(script|style)(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)
      | <(/?)(template)(?=[\s/>])[^>]*>""", re.S | re.I | re.X)
_GRAPHIC = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <!\[CDATA\[.*?(?:\]\]>|\Z)
      | <(/?)([a-zA-Z][a-zA-Z0-9-]*)(?=[\s/>])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>
      | <(/?)([a-zA-Z][a-zA-Z0-9-]*)(?=[\s/>])[^>]*>""", re.S | re.I | re.X)
_IFRAME = re.compile(r"<(/?)iframe(?=[\s/>])[^>]*>", re.I)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+|[0-9]+")
_BLANKS = re.compile(r"\s+")
_KEEP = re.compile(r"\bdata-keep\b")

#: Tags that end a run of text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup "
    "option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split())
_VOID = frozenset(("hr",))
#: HTML tags that cannot stand in a graphic and end it, closed or not.
_NO_GRAPHIC = BLOCK_TAGS - {"title"} | frozenset(
    "b big br code em embed font i img listing meta nobr ruby s small span strike strong sub sup tt u var".split())
#: An opening tag that closes an open one of these kinds first, unless one of the fences lies between.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",)}
_FENCE = frozenset(("ul", "ol", "menu", "dl", "table", "select"))


@dataclass
class Block:
    text: str
    links: int  # characters inside links
    tags: tuple[str, ...]
    names: tuple[str, ...]  # words of class, id and role of all ancestors
    keep: bool = False


def _template_end(page: str, at: int) -> int:
    """The end of the template opened before ``at``; templates nest."""
    depth = 1
    for m in _TEMPLATE.finditer(page, at):
        if m[3]:
            depth += -1 if m[2] else 1
            if not depth:
                return m.end()
    return len(page)


def _graphic_end(page: str, at: int, depth: int) -> tuple[int, int]:
    """Where ``depth`` nested graphics, open at ``at``, end or come to a ``foreignObject`` (HTML); and how many stay open."""
    links = 0
    for m in _GRAPHIC.finditer(page, at):
        tag, closing = (m[2] or m[4] or "").lower(), m[1] or m[3]
        step = -1 if closing else 0 if m[0].endswith("/>") else 1
        if tag == "svg":
            depth += step
            if not depth:
                return m.end(), 0
        elif tag == "a":
            links += step
            if links < 0:  # closes a link around the graphic
                return m.start(), 0
        elif tag == "foreignobject":
            if step > 0:
                return m.end(), depth
        elif tag in _NO_GRAPHIC:
            return m.start(), 0
    return len(page), 0


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in page order, white space squeezed, character references decoded."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], bool]] = []
    parts: list[str] = []
    linked: list[str] = []
    link_at = -1  # depth at which the open link began
    graphics: list[int] = []  # nested graphics around each open foreignObject

    def flush() -> None:
        if parts:
            text = _BLANKS.sub(" ", htmllib.unescape("".join(parts))).strip()
            if text:
                names = tuple(w for _, ws, _ in stack for w in ws)
                out.append(Block(text, len(_BLANKS.sub(" ", "".join(linked)).strip()),
                                 tuple(t for t, _, _ in stack), names, bool(stack) and stack[-1][2]))
            parts.clear()
            linked.clear()

    at = 0
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            parts.append(page[at:m.start()])
            if link_at >= 0:
                linked.append(parts[-1])
        at = m.end()
        tag = m[3] or m[6]
        if tag is None:
            continue
        tag = tag.lower()
        closing, attrs = m[2] or m[5], m[4] or m[7] or ""
        if tag not in BLOCK_TAGS:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                link_at = -1 if closing else len(stack)
            elif attrs and not attrs[0].isspace() and attrs[0] != "/":
                continue  # another name, as in svg:rect
            elif tag == "foreignobject" and closing and graphics or tag == "svg" and not closing and not attrs.endswith("/"):
                at, still = _graphic_end(page, at, graphics.pop() if closing else 1)
                if closing or still:
                    parts.append(" ")
                if still:
                    graphics.append(still)
            elif tag == "template" and not closing:
                at = _template_end(page, at)
            elif tag == "iframe" and not closing and not attrs.endswith("/"):
                end = _IFRAME.search(page, at)
                if end and end[1]:
                    at = end.end()
            continue
        flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        else:
            if stack and stack[-1][0] == "p":
                stack.pop()
            for k in range(len(stack) - 1, -1, -1):
                if tag not in _CLOSES or stack[k][0] in _FENCE:
                    break
                if stack[k][0] in _CLOSES[tag]:
                    del stack[k:]
                    break
            if tag not in _VOID:
                names = tuple(_WORD.findall(" ".join(a or b or c for a, b, c in _NAMES.findall(attrs)).lower())) if attrs else ()
                stack.append((tag, names, bool(_KEEP.search(attrs))))
        if link_at > len(stack):
            link_at = -1
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


def features(b: Block) -> list[str]:
    """Ancestor-tag and text features of a block."""
    own = b.tags[-1] if b.tags else "none"
    n = len(b.text)
    size = "xs" if n < 20 else "s" if n < 60 else "m" if n < 150 else "l" if n < 400 else "xl"
    share = b.links / n
    link = "no" if share == 0 else "few" if share < 0.3 else "half" if share < 0.8 else "all"
    sentence = b.text[-1] in ".!?…»”\"'"
    out = ["bias", "own=" + own, "size=" + size, "link=" + link, "sentence" if sentence else "phrase",
           f"{own}:{link}", "comma" if "," in b.text else "plain"]
    out += {"in=" + t for t in b.tags}
    out += {"name=" + w for w in b.names}
    if "©" in b.text or "opyright" in b.text or "ights reserved" in b.text:
        out.append("rights")
    return out


@dataclass
class Field:
    """Weights: per feature the score of ``main`` over ``other``; ``step[i, j]`` for label i followed by j."""

    weights: dict[str, float]
    step: np.ndarray
    start: np.ndarray

    def decode(self, page: list[Block]) -> list[bool]:
        """Viterbi over the two labels (other, main); of equal scores ``other``."""
        if not page:
            return []
        w, (s00, s01), (s10, s11) = self.weights, self.step[0].tolist(), self.step[1].tolist()
        back: list[tuple[int, int]] = []
        a = b = 0.0
        for k, blk in enumerate(page):
            e = sum(w.get(f, 0.0) for f in features(blk))
            if k == 0:
                a, b = float(self.start[0]), float(self.start[1]) + e
                continue
            back.append((int(b + s10 > a + s00), int(b + s11 > a + s01)))
            a, b = max(a + s00, b + s10), max(a + s01, b + s11) + e
        label = int(b > a)
        out = [label]
        for pair in reversed(back):
            label = pair[label]
            out.append(label)
        return [bool(v) for v in reversed(out)]


def train(pages: tuple[str, ...] = PAGES, rounds: int = 100, rate: float = 0.3, penalty: float = 0.02) -> Field:
    """Gradient ascent (AdaGrad) on the penalised conditional log likelihood of pages labelled by ``data-keep``."""
    labelled = [bs for bs in map(blocks, pages) if bs]
    number: dict[str, int] = {}
    feats = [[number.setdefault(f, len(number)) for f in features(b)] for bs in labelled for b in bs]
    flat, size = np.concatenate(feats), np.array([len(f) for f in feats])
    first = np.cumsum(size) - size
    # pages side by side, padded to the longest; ``cell`` is the place of each block
    lens = np.array([len(bs) for bs in labelled])
    page, n, width = np.repeat(np.arange(len(lens)), lens), len(lens), lens.max()
    cell = page * width + np.arange(len(page)) - np.repeat(np.cumsum(lens) - lens, lens)
    gold = np.full((n, width), -1)
    gold.ravel()[cell] = [int(b.keep) for bs in labelled for b in bs]
    here = gold >= 0
    pairs = np.array([[((gold[:, :-1] == i) & (gold[:, 1:] == j)).sum() for j in (0, 1)] for i in (0, 1)])

    w, step, start = np.zeros(len(number)), np.zeros((2, 2)), np.zeros(2)
    sums = [np.full_like(x, 1e-6) for x in (w, step, start)]
    for _ in range(rounds):
        emit = np.zeros((n, width, 2))
        main = np.zeros(n * width)
        main[cell] = np.add.reduceat(w[flat], first)
        emit[..., 1] = main.reshape(n, width)
        fwd, bwd = np.zeros((n, width, 2)), np.zeros((n, width, 2))
        fwd[:, 0] = start + emit[:, 0]
        for k in range(1, width):
            new = np.logaddexp(fwd[:, k - 1, :1] + step[0], fwd[:, k - 1, 1:] + step[1]) + emit[:, k]
            fwd[:, k] = np.where(here[:, k, None], new, fwd[:, k - 1])
        for k in range(width - 2, -1, -1):
            after = emit[:, k + 1] + bwd[:, k + 1]
            new = np.logaddexp(step[:, 0] + after[:, :1], step[:, 1] + after[:, 1:])
            bwd[:, k] = np.where(here[:, k + 1, None], new, 0.0)
        z = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
        p = np.exp(fwd + bwd - z[:, None, None])
        miss = (gold - p[..., 1]).ravel()[cell]
        g_w = np.bincount(flat, np.repeat(miss, size), len(number)) - penalty * w
        both = np.exp(fwd[:, :-1, :, None] + step + (emit + bwd)[:, 1:, None, :] - z[:, None, None, None])
        g_step = pairs - (both * here[:, 1:, None, None]).sum(axis=(0, 1)) - penalty * step
        g_start = np.bincount(gold[:, 0], minlength=2) - p[:, 0].sum(axis=0) - penalty * start
        for x, g, q in zip((w, step, start), (g_w, g_step, g_start), sums):
            q += g * g
            x += rate * g / np.sqrt(q)
    return Field({f: float(w[i]) for f, i in number.items()}, step, start)


def main_text(page: str | None, field: Field) -> str:
    bs = blocks(page or "")
    return "\n".join(b.text for b, keep in zip(bs, field.decode(bs)) if keep)


def extract(pages: DataFrame, field: Field | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    field = field or train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(p.as_py(), field) for p in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return src.mapInArrow(run, "page_id long, url string, text string, n_chars long")
