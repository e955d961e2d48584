"""Main text of web pages by block rules in two passes.

Pass one cuts the page in blocks and classifies each by stop-word density, length and link density. Menus, footers,
forms and the like are known by their markup and take no part; ``article`` and ``main`` only move the thresholds: text
inside needs fewer stop words, text beside them more. Pass two gives ambiguous short blocks the label of the nearest
decided neighbours. Reading takes time in proportion to the page, also where tags or quotes never end.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Content that is never text.
SILENT = {"script", "style", "noscript", "template", "head", "title", "svg", "iframe", "object", "canvas", "math"}
#: What an open head may hold; anything else closes it, as its end tag may be left out.
IN_HEAD = {"base", "basefont", "bgsound", "head", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
#: Elements around the main text: menus, headers, footers, sidebars, forms.
AROUND = {"nav", "footer", "aside", "form", "button", "select", "option", "textarea", "dialog", "menu"}
BLOCKS = set(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 "
    "header hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
#: An open paragraph or list item ends where one of these begins.
ENDS_PARAGRAPH = BLOCKS | AROUND
#: Words of a class, id or role that mark text around the article.
OUTSIDE = re.compile(
    r"(?:^|[\s_-])(ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|header|login|masthead|menu|"
    r"modal|nav\w*|newsletter|notice|notification|pagination|popup|promo\w*|related|share|sharing|sidebar|signup|social|"
    r"sponsor\w*|subscribe|toolbar|widget|alert|search|complementary|contentinfo)(?:$|[\s_-])"
)
TAG = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
#: What ends a tag or hides its end.
TAG_MARK = re.compile("[>\"']")
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements nested deeper are read, but not kept open, as in browsers.
DEPTH = 512
#: One attribute of a tag, name and value together; stray quoted text is passed over.
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|"[^"]*"|'[^']*'""")
#: Between the entries of a menu written as one line.
MENU_MARK = re.compile(r"\s[|·•»›/]\s")
RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "textarea", "title", "noscript", "iframe")}
SPACE = re.compile(r"\s+")
#: Short function words of the languages the pages use.
STOP_WORDS = frozenset(
    "the of and to a in is that it for was on are as with be by this from at or an have not but they his her you we "
    "der die das und ist von zu den mit ein eine nicht auf für im dem des sich auch als an es war bei aus wie "
    "le la les de des et est un une du en que qui pour dans sur pas par au avec plus ne se ce il elle "
    "el los las y en que del por con una para su no al lo como más pero sus es".split()
)


@dataclass
class Block:
    """One run of text between block tags, and what decided its label."""

    text: str
    linked: int
    inside: bool
    outside: bool
    heading: bool = False
    label: str = ""
    rule: str = ""


class Tags:
    """The tags of a page in order, each ``(start, end, name, attributes, closing)``; name "" for comments and the like.

    A tag whose quotes never close ends at the next ``>``, and so do all after it; without a ``>`` the rest is text.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self.quoted = True

    def end_of(self, at: int) -> int:
        """Place of the ``>`` that ends the tag open at ``at``; -1 if there is none."""
        begin = at
        while self.quoted:
            m = TAG_MARK.search(self.page, at)
            if m is None:
                break
            if m[0] == ">":
                return m.start()
            at = self.page.find(m[0], m.end()) + 1
            if not at:
                self.quoted = False
        return self.page.find(">", begin)

    def after(self, at: int) -> tuple[int, int, str, str, bool] | None:
        """The first tag at or after ``at``."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(page), "", "", False
            m = TAG.match(page, start)
            if m is None and not page.startswith(("<!", "<?"), start):
                at = start + 1
                continue
            end = self.end_of(m.end()) if m else page.find(">", start)
            if end < 0:
                return None
            if m is None:
                return start, end + 1, "", "", False
            return start, end + 1, m[1].lower(), page[m.end() : end], page[start + 1] == "/"
        return None


def blocks_of(page: str) -> list[Block]:
    """The page's blocks in order, white space folded; unclosed and stray tags are tolerated."""
    out: list[Block] = []
    parts: list[str] = []
    links: list[str] = []
    # (name, silent, outside, inside, link) of open elements, flags hold for all below; then the place of the nearest
    # element that no start tag closes, and whether a paragraph is open above it.
    stack: list[tuple[str, bool, bool, bool, bool, int, bool]] = [("", False, False, False, False, 0, False)]
    opened: Counter[str] = Counter()

    def leave(k: int) -> None:
        """Closes the elements from place ``k`` on."""
        opened.subtract(s[0] for s in stack[k:])
        del stack[k:]

    def close_block() -> None:
        text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            linked = len(SPACE.sub(" ", html.unescape("".join(links))).strip())
            heading = any(s[0] in HEADINGS for s in stack[-3:])
            out.append(Block(text, linked, stack[-1][3], stack[-1][2], heading))
        parts.clear()
        links.clear()

    def write(text: str) -> None:
        if stack[-1][0] == "head" and text.strip():
            leave(len(stack) - 1)
        if text and not stack[-1][1]:
            parts.append(text)
            if stack[-1][4]:
                links.append(text)

    at, n = 0, len(page)
    tags = Tags(page)
    while at < n:
        tag = tags.after(at)
        if tag is None:
            write(page[at:])
            break
        start, end, name, attributes, closing = tag
        write(page[at:start])
        at = end
        if not name:
            continue
        if closing:
            if name in ENDS_PARAGRAPH or name in SILENT:
                close_block()
            for k in range(len(stack) - 1 if opened[name] else 0, 0, -1):
                if stack[k][0] == name:
                    leave(k)
                    break
                if name not in ENDS_PARAGRAPH and stack[k][0] in ENDS_PARAGRAPH:
                    break
            continue
        if stack[-1][0] == "head" and name not in IN_HEAD:
            leave(len(stack) - 1)
        if name == "br":
            write(" ")
            continue
        if name in ENDS_PARAGRAPH or name in SILENT:
            close_block()
            if name in ENDS_PARAGRAPH:
                if stack[-1][6]:
                    # An open paragraph ends here, with the inline elements in it.
                    leave(stack[-1][5] + 1)
                if name == "li" and stack[-1][0] == "li":
                    leave(len(stack) - 1)
        if name in VOID or attributes.rstrip().endswith("/") or len(stack) > DEPTH:
            continue
        _, silent, outside, inside, link, firm, paragraph = stack[-1]
        marks: dict[str, str] = {}
        for a in ATTRIBUTE.finditer(attributes):
            if a[1]:
                marks.setdefault(a[1].lower(), (a[2] or a[3] or a[4] or "").lower())
        if "hidden" in marks or marks.get("aria-hidden") == "true" or "display:none" in marks.get("style", "").replace(" ", ""):
            silent = True
        if name in AROUND or (name == "header" and not inside):
            outside = True
        if name not in ("body", "html", "article", "main") and any(OUTSIDE.search(marks.get(k, "")) for k in ("class", "id", "role")):
            outside = True
        if name in ("article", "main") or marks.get("role") == "main":
            # An article among reader comments or in a sidebar stays outside.
            inside = True
        if name != "p" and (name in ENDS_PARAGRAPH or name in SILENT):
            firm, paragraph = len(stack), False
        stack.append(
            (name, silent or name in SILENT, outside, inside, link or name == "a", firm, paragraph or name == "p")
        )
        opened[name] += 1
        if name in RAW:
            end = RAW[name].search(page, at)
            stop = end.start() if end else n
            write(page[at:stop])
            at = stop
    close_block()
    return out


def classify(blocks: list[Block], long_text: int = 200, short_text: int = 70, linked: float = 0.5) -> None:
    """Labels every block "good" or "bad" in place and names the rule.

    Thresholds of stop-word density by place: inside ``article`` or ``main`` 0.05, or none for long text; beside them
    0.3 and long; on pages without them 0.3, or 0.15 for long text.
    """
    framed = any(b.inside and not b.outside for b in blocks)
    for b in blocks:
        words = b.text.lower().split()
        density = sum(w.strip(".,;:!?") in STOP_WORDS for w in words) / max(1, len(words))
        size = len(b.text)
        entries = MENU_MARK.split(b.text)
        if b.outside:
            b.label, b.rule = "bad", "markup"
        elif b.linked > linked * size:
            # A linked heading goes with what it heads.
            b.label, b.rule = ("", "") if b.heading and b.inside else ("bad", "links")
        elif not b.inside and len(entries) > 2 and density == 0 and all(len(e.split()) < 4 for e in entries):
            b.label, b.rule = "bad", "menu"
        elif size < short_text:
            continue
        elif b.inside:
            if size >= long_text or density >= 0.05:
                b.label, b.rule = "good", "density" if density >= 0.05 else "length"
        elif framed:
            dense = size >= long_text and density >= 0.3
            b.label, b.rule = ("good" if dense else "bad"), "density"
        elif density >= 0.3 or (size >= long_text and density >= 0.15):
            b.label, b.rule = "good", "density"
        elif density < 0.1:
            b.label, b.rule = "bad", "density"
    for inside in (True, False):
        inherit([b for b in blocks if not b.outside and b.inside == inside], inside)


def inherit(region: list[Block], inside: bool) -> None:
    """Ambiguous blocks take the label of the nearest block of their region that pass one decided.

    A heading takes that of the next one. At equal distance, and where none is decided, text inside ``article`` or
    ``main`` stays and other text goes.
    """
    far = len(region) + 1
    ahead: list[tuple[int, str]] = []
    distance, label = far, ""
    for b in reversed(region):
        distance, label = (0, b.label) if b.label else (distance + 1, label)
        ahead.append((distance, label))
    ahead.reverse()
    distance, label = far, ""
    for b, (to_next, following) in zip(region, ahead, strict=True):
        if b.label:
            distance, label = 0, b.label
            continue
        distance += 1
        own = "good" if inside else "bad"
        if b.heading and following:
            b.label = following
        elif label and following:
            b.label = label if label == following or distance < to_next else following if to_next < distance else own
        else:
            b.label = label or following or own
        b.rule = "neighbours" if label or following else "place"


def main_text(page: str | None) -> str:
    """Main text of one page; empty for NULL, empty or all-boilerplate pages."""
    blocks = blocks_of(page or "")
    classify(blocks)
    return " ".join(b.text for b in blocks if b.label == "good")


def extract(pages: DataFrame, html_col: str = "html", id_cols: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The id columns, ``text`` and ``n_chars`` (code points) of every page; repeated pages stay repeated rows."""
    source = pages.select(*id_cols, F.col(html_col).alias("_html"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column("_html")]
            columns = [batch.column(i) for i in range(len(id_cols))]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*id_cols, "text", "n_chars"])

    fields = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in id_cols)
    return source.mapInArrow(rows, f"{fields}, text string, n_chars long")
