"""Main text of web pages by line-block distribution.

Markup is stripped and every block becomes a line. The text lengths over a
sliding window of lines make the distribution; where a window rises to the
surge length, text begins, where it falls to nothing, text ends, and what
stands between such points is kept.

A line weighs its characters outside links. Text of menus, headers, footers,
sidebars, notices, adverts, forms and reader comments, known by element or by
words of their class, id or role, weighs nothing, so the distribution is flat
there. Class and id names are judged one by one: a name is boilerplate if its
first or last word is such a word and none is a word of page settings. Where
that leaves no window of text and less than ``LEAST_SHARE`` of what the page has
without it, names of classes do not count: the distribution overrules a
container that holds nearly all text. Inside ``article`` or ``main`` (unless its class or a container is
boilerplate) a character weighs ``MAIN_WEIGHT`` times as much; link text weighs
there too if it is all there is. A window must reach ``SURGE_CHARS`` (or the
page's fullest window, if that is less) on every page, which leaves stray
labels out. Windows and regions end where ``article`` or ``main`` begins or
ends. Boilerplate ends a region outside of them; inside, it is passed over.

Defined results: a null, empty or text-free page gives an empty string and 0;
repeated rows each give their row; an empty table gives no rows; further input
columns are ignored; pages of any length are read whole.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlens.llm.common import map_arrow, slices

WINDOW_LINES = 3
SURGE_CHARS = 86
#: Weight of a character inside article or main.
MAIN_WEIGHT = 8

# Element names of the HTML standard by their role here.
_BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu
    nav ol optgroup option p pre section select summary table tbody td template tfoot th thead title tr ul""".split())
_RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp svg math template".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BOILER = frozenset("nav aside footer form menu button select dialog head".split())
_BOILER_WORDS = frozenset("""ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored promo
    promotion banner cookie cookies consent notice notices alert popup modal overlay newsletter subscribe signup login
    nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside rail widget widgets footer masthead share
    sharing social comment comments commentlist disqus replies respond related recommended""".split())
#: Words of a class name that make it a setting of the page (comments-open, no-sidebar).
_SETTINGS = frozenset("has no with without open opened closed enabled disabled none on off left right".split())
_MAIN = ("article", "main")
_BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog".split())

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote opens a value right after "=" only.
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>", re.S)
#: A comment, CDATA section or declaration that nothing ends.
_UNCLOSED = re.compile(r"<!--.*|<!\[CDATA\[.*|<[!?][^>]*\Z", re.S)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in _RAW}
_WORD = re.compile(r"[a-z]+")
_HREF = re.compile(r"(?:^|\s)href\s*=", re.I)


def _boiler(name: str, attributes: str, in_main: bool, by_class: bool = True) -> bool:
    if name in _BOILER or (name == "header" and not in_main):
        return True
    if not attributes or name in ("body", "html"):
        return False
    for key, *values in _NAMED.findall(attributes):
        names = re.sub(r"([a-z])([A-Z])", r"\1-\2", "".join(values)).lower().split()
        role = key.lower() == "role"
        for words in map(_WORD.findall, names if role or by_class else ()):
            if role and not _BOILER_ROLES.isdisjoint(words):
                return True
            if not role and words and _SETTINGS.isdisjoint(words) and not _BOILER_WORDS.isdisjoint((words[0], words[-1])):
                return True
    return False


def page_lines(page: str, by_class: bool = True) -> list[tuple[str, int, bool, bool]]:
    """Blocks of a page in order as (text, weight, boilerplate, in article or main).

    The weight is what the block counts in the distribution: 0 for boilerplate.
    Unclosed elements end with their parent, as browsers do it; a link ends with
    the block around it at the latest, and an ``a`` without ``href`` is none.
    Time is linear in the page, whatever its markup.
    """
    lines: list[tuple[str, bool, int, bool]] = []  # text, boilerplate, characters in links, in main
    text: list[str] = []
    links = 0
    stack: list[tuple[str, bool, bool]] = []  # open elements other than inline ones; boilerplate or not, main or not
    boiler, main, in_link = 0, 0, 0
    opened: Counter = Counter()  # how many elements of each name are on the stack
    last = page.rfind(">") + 1  # no tag ends behind it

    def end_block():
        nonlocal text, links, in_link
        in_link = 0
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            if line:
                lines.append((line, boiler > 0, links, main > 0))
            text, links = [], 0

    def add(raw: str):
        nonlocal links
        if raw:
            text.append(raw)
            if in_link:
                links += len(raw.strip())

    def leave(name: str):
        nonlocal boiler, main
        if not opened[name]:
            return
        while stack:
            open_, is_boiler, is_main = stack.pop()
            opened[open_] -= 1
            boiler -= is_boiler
            main -= is_main
            if open_ == name:
                return

    at = 0
    while True:
        piece = _PIECE.search(page, at, last) or _UNCLOSED.search(page, max(at, last))
        if piece is None:
            add(page[at:])
            break
        add(page[at:piece.start()])
        at = piece.end()
        name = (piece[2] or "").lower() if piece.re is _PIECE else ""
        if not name:
            continue
        if piece[1]:
            if name == "a":
                in_link = 0
            if name in _BLOCKS or opened[name]:
                end_block()
                leave(name)
        elif name in _RAW:
            if name == "title":
                end_block()
            if not piece[3].endswith("/"):
                end = _RAW_END[name].search(page, at)
                at = end.end() if end else len(page)
        elif name == "br":
            add(" ")
        elif name == "a":
            in_link = int(_HREF.search(piece[3]) is not None)
        else:
            is_boiler = _boiler(name, piece[3], main > 0, by_class)
            if name in _BLOCKS or is_boiler:
                end_block()
                if name in _VOID or piece[3].endswith("/"):
                    continue
                if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
                    leave(name)
                elif stack and stack[-1][0] == "p":
                    leave("p")
                boiler += is_boiler
                is_main = name in _MAIN and not boiler
                stack.append((name, is_boiler, is_main))
                opened[name] += 1
                main += is_main
    end_block()
    plain = any(inside and not out and linked < len(line) for line, out, linked, inside in lines)
    return [(line, 0 if out else (MAIN_WEIGHT if inside else 1) * (len(line) - min(linked, len(line)) * (plain or not inside)),
             out, inside) for line, out, linked, inside in lines]


#: Share of a page's text that stays outside of containers judged by class, below which these are looked at again.
LEAST_SHARE = 0.1


def _largest_window(blocks: list[tuple[str, int, bool, bool]], window: int) -> int:
    total = np.cumsum([0, *(weight for _, weight, *_ in blocks)])
    wide = min(window, len(blocks))
    return int((total[wide:] - total[:len(total) - wide]).max())


def main_text(page: str | None, window: int = WINDOW_LINES, surge_chars: int = SURGE_CHARS) -> str:
    """The text between surge and dive points, blocks joined by one line feed."""
    blocks = page_lines(page or "")
    if _largest_window(blocks, window) < surge_chars:
        plain = page_lines(page or "", by_class=False)
        if _largest_window(plain, window) >= surge_chars and (
                sum(w for _, w, *_ in blocks) < LEAST_SHARE * sum(w for _, w, *_ in plain)):
            blocks = plain
    # Boilerplate inside article or main is passed over; each run of lines inside or outside of them has windows of its own.
    lines = [(line, weight, inside) for line, weight, out, inside in blocks if not (out and inside)]
    if not any(w for _, w, _ in lines):
        return ""
    weight = np.array([w for _, w, _ in lines])
    side = np.array([inside for *_, inside in lines])
    total = np.concatenate(([0], np.cumsum(weight)))
    borders = np.append(np.flatnonzero(side[1:] != side[:-1]) + 1, len(lines))
    at = np.arange(len(lines))
    ends = np.minimum(at + window, borders[np.searchsorted(borders, at, "right")])
    block = total[ends] - total[:-1]  # text from a line over the window
    threshold = min(surge_chars, block.max())
    kept, inside = [], False
    for i, (line, w, main) in enumerate(lines):
        if inside and (main != lines[i - 1][2] or block[i] == 0 or (w == 0 and not main)):
            inside = False  # dive
        if not inside:
            inside = (w > 0 or main) and block[i] >= threshold  # surge
        if inside:
            kept.append(line)
    return "\n".join(kept)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, ``text`` and ``n_chars`` (its code points) for every page."""
    schema = (f"id {df.schema[id_col].dataType.simpleString()}, url {df.schema[url_col].dataType.simpleString()}, "
              "text string, n_chars long")

    def run(batches):
        for batch in slices(batches, 500):
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return map_arrow(pages, run, schema).withColumnsRenamed({"id": id_col, "url": url_col})
