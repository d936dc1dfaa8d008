"""Complaint extraction from raw web pages.

The crawler drove a browser and read DOM nodes; here the same decisions are
taken on the stored HTML.  Nested elements, "first match" and character
references need a document tree, which no column expression gives, so one
Arrow pass per page (:func:`read_pages`) parses the page once and returns the
few texts; everything after that (candidate order, gates, cleaning, dates,
link resolution, tags) is column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicons as L
from ..functions import dom
from ..functions import text as TX
from ..functions.dates import date_or_now, month_to_tr
from ..session import ship

# Whitespace as Python's ``str.split``/``re`` ``\s`` sees it (Unicode), written
# with ``\x{..}`` escapes that Java and RE2 both read.
UWS = (r"\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")

# The same characters as a plain string (exactly the 29 characters for which
# Python's ``str.isspace`` is true), for character trimming.
UWS_CHARS = ("\t\n\x0b\f\r \x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
             + "\u2028\u2029\u202f\u205f\u3000")

URL_RE = r"^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)"


def _col(c: "Column | str") -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- the one pass over the page ------------------------------------------------

@dataclass(frozen=True)
class Selectors:
    """Where a site keeps its parts.

    ``blocks`` names the text candidates in their order: ``share`` (a marked
    block inside an article that holds a marked paragraph), ``third`` (the third
    ``div`` of the first article, the site's absolute path), ``parent`` (the
    parent of the first marked paragraph), ``article`` (the first article).
    ``paragraph`` is the class part that marks a paragraph ("" = any paragraph);
    ``card`` the tag whose first anchor is a listing link; ``dates`` the date
    candidates in order: ``toned``, ``header``, ``any``, ``label``.
    """

    blocks: tuple[str, ...] = ("share", "third", "parent")
    paragraph: str = L.PARAGRAPH_CLASS
    share: str = L.SHARE_CLASS
    card: str = "article"
    dates: tuple[str, ...] = ("header", "any")


#: Company pages, category pages, and the plain pages of the test tables.
COMPANY_PAGES = Selectors()
CATEGORY_PAGES = Selectors(blocks=("share", "parent"), dates=("toned", "header", "label"))
PLAIN_PAGES = Selectors(blocks=("article",), paragraph="", card="li")

PAGE_SCHEMA = ("blocks array<string>, paras array<string>, date_label string, date_text string, has_date boolean, "
               "links array<string>")


def _marked(sel: Selectors):
    return lambda n: n.tag == "p" and n.has_class(sel.paragraph)


def _block(page: dom.Node, kind: str, sel: Selectors) -> "dom.Node | None":
    marked = _marked(sel)
    if kind == "share":
        return page.find(lambda n: n.tag == "div" and n.has_class(sel.share) and n.inside("article") and n.find(marked) is not None)
    if kind == "parent":
        p = page.find(lambda n: marked(n) and n.parent.tag == "div")
        return p.parent if p is not None else None
    article = page.find(lambda n: n.tag == "article")
    if kind == "article" or article is None:
        return article
    divs = [c for c in article.children if isinstance(c, dom.Node) and c.tag == "div"]
    return divs[2] if len(divs) > 2 else None


def _date(page: dom.Node, kind: str) -> "dom.Node | None":
    def span(n: dom.Node) -> bool:
        if n.tag != "span":
            return False
        if kind == "label":
            return "base-ui-" in (n.attrs.get("id") or "") and ":" in (n.attrs.get("aria-label") or "")
        if L.DATE_ATTRIBUTE not in n.attrs:
            return False
        if kind == "toned":
            return n.inside("article") and L.DATE_CLASS in (n.attrs.get("class") or "").split()
        return kind == "any" or (n.inside("header") and n.inside("article"))

    return page.find(span)


def _read(html: str | None, sel: Selectors) -> tuple:
    page = dom.parse(html)
    blocks, paras = [], []
    for kind in sel.blocks:
        b = _block(page, kind, sel)
        blocks.append(b.text() if b is not None else None)
        paras.append(" ".join(" ".join(n.text().split()) for n in b.walk() if _marked(sel)(n)).strip() if b is not None else None)
    when = next((d for d in (_date(page, k) for k in sel.dates) if d is not None), None)
    links = []
    for card in page.walk():
        if card.tag == sel.card:
            a = card.find(lambda n: n.tag == "a")
            if a is not None and a.attrs.get("href") is not None:
                links.append(a.attrs["href"])
    return (blocks, paras, when.attrs.get("aria-label") if when is not None else None,
            when.text() if when is not None else None, when is not None, links)


def read_pages(pages: DataFrame, sel: Selectors = COMPANY_PAGES, page_id: str = "page_id", url: str = "url",
               html: str = "html") -> DataFrame:
    """``page_id, url`` and, parsed once per page: the candidate blocks' texts, their marked paragraphs, the date
    element, and the listing links (hrefs as written, references decoded)."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = pa.list_(pa.string())
        for b in batches:
            cols = list(zip(*(_read(h, sel) for h in b.column(2).to_pylist()))) or [()] * 6
            kinds = (texts, texts, pa.string(), pa.string(), pa.bool_(), texts)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             ["page_id", "url", "blocks", "paras", "date_label", "date_text", "has_date", "links"])

    src = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return src.mapInArrow(run, f"page_id long, url string, {PAGE_SCHEMA}")


# --- text -----------------------------------------------------------------------

def py_strip(c: "Column | str") -> Column:
    """Python ``str.strip()``: Unicode whitespace at both ends (a character trim, no regex)."""
    return F.btrim(_col(c), F.lit(UWS_CHARS))


def squeeze_unicode_ws(c: "Column | str") -> Column:
    """``re.sub(r'\\s+', ' ', s).strip()`` with Unicode whitespace."""
    return F.trim(F.regexp_replace(_col(c), f"[{UWS}]+", " "))


def choose_text(block: "Column | str", paras: "Column | str", markers: Sequence[str] = L.CORPORATE_MARKERS) -> Column:
    """Paragraph text when the block holds a corporate-reply marker, else the stripped block (P10)."""
    b = _col(block)
    hit = F.lit(False)
    for m in markers:
        hit = hit | b.contains(m)
    return F.when(hit, _col(paras)).otherwise(py_strip(b))


def pick_candidate(candidates: Sequence[tuple[Column, Column]], good: int = L.GOOD_TEXT_CHARS,
                   reject: int = L.REJECT_TEXT_CHARS) -> Column:
    """Ordered candidates ``(block_text, paragraph_text)``; first good one wins.

    A candidate is tried when its stripped text has more than ``good``
    characters; it wins when the chosen text has more than ``good`` too.
    Without a winner, the last tried candidate's text stays.  A final text
    shorter than ``reject`` characters is rejected (null).
    """
    tried = [F.char_length(py_strip(b)) > good for b, _ in candidates]
    chosen = [choose_text(b, p) for b, p in candidates]
    win = None
    for t, c in zip(tried, chosen):
        cond = t & (F.char_length(c) > good)
        win = F.when(cond, c) if win is None else win.when(cond, c)
    last = None
    for t, c in reversed(list(zip(tried, chosen))):
        last = F.when(t, c) if last is None else last.when(t, c)
    text = F.coalesce(win.otherwise(F.lit(None)), last.otherwise(F.lit("")))
    return F.when(F.char_length(text) >= reject, text)


def clean_page_text(c: "Column | str", junk: Sequence[str] = L.PAGE_JUNK) -> Column:
    """Junk strings removed, whitespace squeezed and stripped."""
    return squeeze_unicode_ws(TX.replace_all(c, junk))


def main_text(sel: Selectors = COMPANY_PAGES) -> Column:
    """Complaint text from ``blocks`` and ``paras``, or null when no candidate is good enough (X1+X3)."""
    return clean_page_text(pick_candidate(
        [(F.coalesce(F.get("blocks", F.lit(k)), F.lit("")), F.coalesce(F.get("paras", F.lit(k)), F.lit("")))
         for k in range(len(sel.blocks))]))


def paragraphs() -> Column:
    """The marked paragraphs of the first block that exists, joined by a blank."""
    return F.coalesce(F.get(F.filter("paras", lambda p: p.isNotNull()), F.lit(0)), F.lit(""))


def page_date(now: "Column | str | None" = None) -> Column:
    """Date text of the complaint: ``aria-label`` before the element's text; the current time as ``dd MMMM HH:mm``
    when missing or without a digit; month names in Turkish, white space squeezed (X4, F10, F11)."""
    label = F.nullif(F.col("date_label"), F.lit(""))
    text = F.nullif(py_strip("date_text"), F.lit(""))
    found = F.when(F.col("has_date"), F.coalesce(label, text))
    return squeeze_unicode_ws(month_to_tr(date_or_now(found, now)))


# --- links ----------------------------------------------------------------------

def url_parts(url: "Column | str") -> tuple[Column, Column]:
    """(scheme, host) of an absolute URL; empty strings when not absolute."""
    u = _col(url)
    return F.regexp_extract(u, URL_RE, 1), F.regexp_extract(u, URL_RE, 2)


def drop_dot_segments(url: "Column | str") -> Column:
    """``.`` and ``..`` segments of the path taken out as RFC 3986 (5.2.4) says; authority, query and fragment stay.

    URLs without an authority (``mailto:``) stay as they are."""
    u = _col(url)
    shape = r"(?s)^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)(/[^?#]*)(.*)$"
    steps = F.slice(F.split(F.regexp_extract(u, shape, 2), "/"), 2, 1 << 30)  # behind the leading slash
    kept = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda done, s: F.when(s == ".", done)
        .when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.array_append(done, s)))
    # a path that ends in a dot segment ends in a slash
    last = F.element_at(steps, -1).isin(".", "..")
    path = F.concat(F.lit("/"), F.array_join(F.when(last, F.array_append(kept, F.lit(""))).otherwise(kept), "/"))
    return F.when(u.rlike(shape), F.concat(F.regexp_extract(u, shape, 1), path, F.regexp_extract(u, shape, 3))).otherwise(u)


def resolve_href(href: "Column | str", base_url: "Column | str") -> Column:
    """Absolute link for an ``href`` relative to the page URL (what ``.get_attribute('href')`` returns).

    RFC 3986 (5.2): absolute, scheme-relative (``//host``), root-relative (``/path``), query-only (``?q``),
    fragment-only, empty and document-relative references; dot segments are taken out."""
    h, b = _col(href), _col(base_url)
    scheme, host = url_parts(b)
    page = F.regexp_replace(b, r"(?s)#.*$", "")
    file = F.regexp_replace(page, r"(?s)[?].*$", "")
    folder = F.when(file.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*$"), F.concat(file, F.lit("/"))).otherwise(
        F.regexp_replace(file, r"[^/]*$", ""))
    return (F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), drop_dot_segments(h))
            .when(h.startswith("//"), drop_dot_segments(F.concat(scheme, F.lit(":"), h)))
            .when(h.startswith("/"), drop_dot_segments(F.concat(scheme, F.lit("://"), host, h)))
            .when((h == "") | h.startswith("#"), F.concat(page, h))
            .when(h.startswith("?"), F.concat(file, h))
            .otherwise(drop_dot_segments(F.concat(folder, h))))


def page_links(pages: DataFrame, sel: Selectors = COMPANY_PAGES, page_id: str = "page_id", url: str = "url",
               html: str = "html") -> DataFrame:
    """One row per listing card: (page_id, pos, href, link), the card's first anchor with ``link`` resolved."""
    e = read_pages(pages, sel, page_id, url, html).select("page_id", "url", F.posexplode("links").alias("pos", "href"))
    return e.select("page_id", (F.col("pos") + 1).alias("pos"), "href", resolve_href("href", "url").alias("link"))


def tag_company(url: "Column | str", targets: Sequence[tuple[str, str]] = L.CRAWL_TARGETS) -> Column:
    """Company of a URL from the crawl targets (longest matching prefix), else null.

    ``targets`` holds (company, url) pairs; (company, category, url) triples
    of the category crawl are accepted too.
    """
    u = _col(url)
    out = None
    pairs = [(t[0], t[-1]) for t in targets]
    for name, prefix in sorted(pairs, key=lambda t: -len(t[1])):
        cond = u.startswith(prefix)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def tag_category(url: "Column | str", targets=L.CATEGORY_TARGETS) -> Column:
    """Category of a URL from the category crawl targets (company, category, url), else null."""
    u = _col(url)
    out = None
    for _, category, prefix in sorted(targets, key=lambda t: -len(t[2])):
        cond = u.startswith(prefix)
        out = F.when(cond, F.lit(category)) if out is None else out.when(cond, F.lit(category))
    return out


def extract_records(pages: DataFrame, company: "Column | None" = None, now: "Column | None" = None,
                    sel: Selectors = COMPANY_PAGES) -> DataFrame:
    """Pages → crawl records (company, date, link, content, crawl_timestamp); rejected pages dropped."""
    from .complaints import make_record

    comp = company if company is not None else F.coalesce(tag_company("url"), url_parts("url")[1])
    out = read_pages(pages, sel).select("url", comp.alias("company"), page_date(now).alias("date"),
                                        main_text(sel).alias("content"))
    out = out.filter(F.col("content").isNotNull() & (F.col("content") != "") & ~F.col("content").startswith(L.ERROR_PREFIX))
    return make_record(out, "company", "date", "url", "content", now)
