"""A forgiving reader of HTML: elements and blocks of text, as flat lists.

Only what text extraction needs: which block elements are open, which text
stands in them, and how much of it is link text.  It accepts any string:
unclosed, crossed or stray tags, comments and quotes, and cut-off pages.
"""

from __future__ import annotations

import html
import re

#: Fixed values of HTML: elements that start a new block of text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup: it ends at their own end tag only.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: Elements whose text is never shown, or is shown inside a control.
UNSEEN = frozenset(
    "head script style noscript template iframe object svg math canvas audio video noembed noframes xmp title "
    "select option optgroup datalist textarea button".split()
)
#: A start tag ends these open elements, unless one of the second stands between.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "option": (("option",), ("select",)),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_RAW_END = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")


class Page:
    """``tag[i]``, ``attributes[i]`` and ``parent[i]`` of each element, in page
    order, element 0 being the page; ``blocks`` of (element, text, code points
    of link text), white space collapsed, none of them empty."""

    def __init__(self, source: str) -> None:
        self.tag: list[str] = ["#page"]
        self.attributes: list[dict[str, str]] = [{}]
        self.parent: list[int] = [-1]
        self.blocks: list[tuple[int, str, int]] = []
        self._open = [0]
        self._text: list[str] = []
        self._linked = self._links = 0
        self._read(source)
        self._flush()

    def _read(self, s: str) -> None:
        at, n = 0, len(s)
        closes: dict[str, bool] = {}  # quotes that may still come
        while at < n:
            lt = s.find("<", at)
            if lt < 0:
                return self._add(s[at:])
            name = _NAME.match(s, lt + 1)
            end = not name and s.startswith("/", lt + 1) and _NAME.match(s, lt + 2)
            if not name and not end:
                if s.startswith("<!--", lt):
                    self._add(s[at:lt])
                    # "<!-->" and "<!--->" are whole comments
                    to = s.find("-->", lt + 2)
                    at = n if to < 0 else to + 3
                elif s.startswith(("<!", "<?", "</"), lt):
                    self._add(s[at:lt])
                    to = s.find(">", lt)
                    at = n if to < 0 else to + 1
                else:  # a plain "<"
                    self._add(s[at : lt + 1])
                    at = lt + 1
                continue
            self._add(s[at:lt])
            tag = (name or end)[0].lower()
            to = body = (name or end).end()
            while True:  # the end of the tag, outside of quotes
                gt = s.find(">", to)
                if gt < 0:
                    return
                quote = next((i for i in range(to, gt) if s[i] in "\"'" and s[i - 1 : i] in "= \t\n\r"), -1)
                if quote < 0:
                    break
                shut = s.find(s[quote], quote + 1) if closes.get(s[quote], True) else -1
                if shut < 0:
                    closes[s[quote]] = False
                    break
                to = shut + 1
                if shut > gt and s.find("<", quote + 1, shut) >= 0 and s.find("=", quote + 1, shut) < 0:
                    break  # the quote was never closed
            if quote >= 0 and to <= gt:
                pass
            elif quote >= 0:
                gt = s.find(">", body)
            at = gt + 1
            if end:
                self._end(tag)
                continue
            self._start(tag, s[body:gt])
            if tag in RAW and not s.startswith("/", gt - 1):
                shut = _RAW_END[tag].search(s, at)
                if not shut:
                    return
                at = shut.start()

    def _add(self, text: str) -> None:
        if text:
            self._text.append(text)
            if self._links:
                self._linked += len(text)

    def _flush(self) -> None:
        if self._text:
            text = " ".join(html.unescape("".join(self._text)).split())
            if text:
                self.blocks.append((self._open[-1], text, min(self._linked, len(text))))
            self._text, self._linked = [], 0

    def _start(self, tag: str, rest: str) -> None:
        if tag == "br":
            self._add(" ")
        if tag == "a":
            self._links = 1
        if tag in VOID and tag != "hr":
            return
        if tag not in BLOCK and tag not in UNSEEN or tag in RAW:
            return  # inline, or skipped where it stands
        self._flush()
        if tag == "hr":
            return
        if tag in BLOCK:
            self._close(("p",), ("table", "td", "th", "button"))
        if tag in ENDS:
            self._close(*ENDS[tag])
        found = {
            k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(rest) if k != "/"
        } if rest and not rest.isspace() else {}
        self.tag.append(tag)
        self.attributes.append(found)
        self.parent.append(self._open[-1])
        if not (rest.endswith("/") and tag in UNSEEN):
            self._open.append(len(self.tag) - 1)

    def _close(self, tags: tuple[str, ...], within: tuple[str, ...]) -> None:
        for k in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[k]]
            if tag in tags:
                del self._open[k:]
                if tags != ("tr", "td", "th"):
                    return
            elif tag in within:
                return

    def _end(self, tag: str) -> None:
        if tag == "a":
            self._links = 0
        if tag not in BLOCK and tag not in UNSEEN or tag in RAW:
            return
        self._flush()
        for k in range(len(self._open) - 1, 0, -1):
            own = self.tag[self._open[k]]
            if own == tag:
                del self._open[k:]
                self._links = 0
                return
            if tag == "p" and own in ("article", "section", "div", "td", "body", "li", "main"):
                return

    def under(self, marks: list[bool]) -> list[bool]:
        """Which elements are marked or stand in a marked one."""
        out = list(marks)
        for i in range(1, len(out)):
            out[i] = out[i] or out[self.parent[i]]
        return out


def visible_text(source: str | None) -> str:
    """All text that a page shows, a line for each block."""
    if not source:
        return ""
    page = Page(source)
    unseen = page.under([t in UNSEEN for t in page.tag])
    return "\n".join(text for i, text, _ in page.blocks if not unseen[i])
