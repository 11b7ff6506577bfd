"""Main text of web pages by consensus host paths (operator 5).

1. Each page's containers are scored: the text in them that is neither link
   nor boilerplate, raised for elements and class names that mark articles.
2. Pages of a host are made by one template, so containers vote: by host,
   Spark adds up the scores of each generalised path (tags and class names
   from the top, digits generalised, classes that look generated left out).
   On a page a path votes once, with its best container, so that halves of a
   text don't outvote the element around them.
   A page also votes on every path that holds a block of its text: does it stand
   inside the page's own best container, or outside?
3. Each page is extracted again from all containers on its host's winning path,
   in page order, and from its own best container, whatever that holds besides:
   a page that differs from its host's template loses nothing.  Only blocks on
   paths that more pages of the host have outside than inside are left out there,
   as parts of the template that outweigh the article on some page.

Left out of the text: menus, headers (but headings in them), footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments, told
by element, role and class or id names.  A name counts as a whole (``sidebar``,
``sidebar-left``, ``cookie-notice``, but not ``no-sidebar`` or ``related-work``),
not on headings and paragraphs, and not as the id that a section has from its
heading.  No name removes an element that holds most of a page's text that is
not linked, unless main text is marked apart from it (article, main); a form or
an element with such a role stays if its heading or article is in it as well.

Character references are decoded, white space in a block is one space, blocks
are joined in page order by an empty line.

Votes are added with partial sums, so a host with a third of all pages is no
hot spot.  The winners are a row per host; they are broadcast where their added
lengths prove them small (``SMALL``), else joined by host (Spark splits hot hosts).

Defined cases: null or empty html has no text; a page without any text has
the empty text; pages without a host in their url are extracted from their own
best container; ties go to the path that sorts first, and on a page to the
first element; repeated rows each vote and are each extracted; null keys and
urls are carried; an empty table gives an empty table; other columns are left
out; long pages are read whole.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_columns, read, written
from tidemark.llm.markup import HEADINGS, UNSEEN, Page

#: Elements, roles and names (whole words of class and id) of boilerplate.
BOILERPLATE_TAGS = frozenset("nav header footer aside form dialog menu search fieldset".split())
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split()
)
BOILERPLATE_NAMES = frozenset(
    "nav navbar navigation menu submenu topbar header masthead footer sidebar aside rail widget widgets ad ads adv advert "
    "adverts advertisement advertisements adsense adslot adbox adbanner banner promo promotion promoted sponsor sponsored "
    "sponsors cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription paywall signup signin login register share sharing social related recommended recommendations "
    "breadcrumb breadcrumbs pagination pager comment comments commentlist discussion disqus respond replies reply "
    "search searchform toolbar skip hidden".split()
)
#: Names of reader comments, and what may stand before and after a name.
COMMENTS = frozenset("comment comments commentlist discussion disqus respond replies reply".split())
BEFORE = frozenset("site page main global primary secondary top bottom left right sticky fixed floating mobile desktop".split())
AFTER = frozenset(
    "box area wrap wrapper container list bar block blocks inner outer left right top bottom primary secondary link links "
    "button buttons btn icon icons item items panel posts articles stories form section slot unit zone thread".split()
)
#: Names that mark the main text.
ARTICLE_NAMES = frozenset("article articlebody content main post entry story text body prose".split())
CONTAINERS = frozenset("article main section div td body center blockquote #page".split())
#: Winners up to so many bytes, or nearly, are broadcast.
SMALL = 1 << 24
#: A path votes with its best container, if that has this share of the best score.
VOTES = 0.5

_PART = re.compile(r"[a-z]+")


def _names(attributes: dict[str, str]) -> set[str]:
    told = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    if not told.strip():
        return set()
    told = re.sub(r"([a-z])([A-Z])", r"\1 \2", told).lower()
    return set(_PART.findall(told)) | {w.replace("-", "").replace("_", "") for w in told.split()}


def _noisy(told: str) -> set[str]:
    """The names of boilerplate that the words of a class or an id are."""
    out = set()
    for word in re.sub(r"([a-z])([A-Z])", r"\1-\2", told).lower().split():
        parts = [x for x in (re.sub(r"\d+$", "", p) for p in re.split(r"[^a-z0-9]+", word)) if x and not x[0].isdigit()]
        while len(parts) > 1 and parts[0] in BEFORE:
            del parts[0]
        if "".join(parts) in BOILERPLATE_NAMES:
            out.add("".join(parts))
            continue
        while len(parts) > 1 and parts[-1] in AFTER:
            del parts[-1]
        if parts and BOILERPLATE_NAMES.issuperset(parts):
            out |= {*parts}
    return out


def _slug(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "-", re.sub(r"^\s*(?:\d+\.)+\d*\s", "", text).lower()).strip("-")


def _is_hidden(a: dict[str, str]) -> bool:
    return "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "")


class Scored:
    """A page with its boilerplate marked and its containers scored."""

    def __init__(self, source: str) -> None:
        page = self.page = Page(source)
        n = len(page.tag)
        unseen = page.under([t in UNSEEN or _is_hidden(a) for t, a in zip(page.tag, page.attributes, strict=True)])
        self.blocks = [(i, text, linked) for i, text, linked in page.blocks if not unseen[i]]
        self.paths: dict[int, str] = {}
        names = [_names(a) if a else set() for a in page.attributes]
        whole = self._held(n, [len(text) - linked for _, text, linked in self.blocks])
        core = [t in ("h1", "article", "main") for t in page.tag]
        for i in range(n - 1, 0, -1):
            core[page.parent[i]] |= core[i]
        by_rule = [
            t in BOILERPLATE_TAGS or a.get("role") in BOILERPLATE_ROLES for t, a in zip(page.tag, page.attributes, strict=True)
        ]
        # the frame around a page's text is not boilerplate, whatever its role
        for i, t in enumerate(page.tag):
            if by_rule[i] and (t not in BOILERPLATE_TAGS or t in ("form", "fieldset")) and core[i] and 2 * whole[i] > whole[0]:
                by_rule[i] = False
        named = self._named(by_rule, whole, core)
        self.noise = [x or y for x, y in zip(by_rule, named, strict=True)]
        inside = page.under(self.noise)
        held = self._held(n, [0 if inside[i] else len(text) - linked for i, text, linked in self.blocks])
        self.held = held
        self.score = [0.0] * n
        for i, tag in enumerate(page.tag):
            if tag in CONTAINERS and held[i]:
                a = page.attributes[i]
                raised = 1.3 if tag == "article" else 1.2 if tag == "main" or a.get("role") == "main" else 1.0
                if not ARTICLE_NAMES.isdisjoint(names[i]) or a.get("itemprop") == "articleBody":
                    raised *= 1.1
                self.score[i] = held[i] * raised * (0.9 if tag in ("body", "#page") else 1.0)

    def _named(self, by_rule: list[bool], whole: list[int], core: list[bool]) -> list[bool]:
        """Which elements are boilerplate by their names."""
        page, n = self.page, len(self.page.tag)
        classes, ids = ([_noisy(a[k]) if a.get(k) else set() for a in page.attributes] for k in ("class", "id"))
        # an id that is made of the heading that begins its element, where nothing else tells of boilerplate
        begins: list[tuple[int, str] | None] = [None] * n
        for i, text, _ in self.blocks:
            k = i
            while k >= 0 and begins[k] is None:
                begins[k], k = (i, text), page.parent[k]
        told = [bool(c) or t == "form" for c, t in zip(classes, page.tag, strict=True)]
        for i in range(n - 1, 0, -1):
            told[page.parent[i]] |= told[i]
        for i, first in enumerate(begins):
            if ids[i] and first and page.tag[first[0]] in HEADINGS and not told[i]:
                if _slug(first[1]) == _slug(page.attributes[i]["id"]):
                    ids[i] = set()
        names = [
            set() if t in HEADINGS or t == "p" else c | d for t, c, d in zip(page.tag, classes, ids, strict=True)
        ]
        most = [i for i in range(n) if names[i] and 2 * whole[i] > whole[0]]
        if most:
            marked = page.under(
                [t in ("article", "main") or a.get("role") == "main" or a.get("itemprop") == "articleBody"
                 for t, a in zip(page.tag, page.attributes, strict=True)]
            )
            left_out = page.under([x or bool(w) for x, w in zip(by_rule, names, strict=True)])
            main = self._held(
                n, [len(text) - linked if marked[i] and not left_out[i] else 0 for i, text, linked in self.blocks]
            )
            for i in most:
                apart = main[0] > main[i] and (not marked[i] or names[i] <= COMMENTS)
                if core[i] or not apart:
                    names[i] = set()
        return [bool(w) for w in names]

    def _held(self, n: int, sizes: list[int]) -> list[int]:
        held = [0] * n
        for (i, _, _), size in zip(self.blocks, sizes, strict=True):
            held[i] += size
        for i in range(n - 1, 0, -1):
            held[self.page.parent[i]] += held[i]
        return held

    def path(self, i: int) -> str:
        """Tags and generalised class names from the top to an element."""
        if i <= 0:
            return ""
        if i not in self.paths:
            classes = sorted({re.sub(r"\d+", "#", c.lower()) for c in self.page.attributes[i].get("class", "").split()})
            kept = [c for c in classes if not re.search(r"#.*[a-z].*#|[a-z]#[a-z]", c)]
            above = self.path(self.page.parent[i])
            self.paths[i] = f"{above}>{'.'.join([self.page.tag[i], *kept])}".lstrip(">")
        return self.paths[i]

    def best(self) -> int | None:
        """The container with the best score; the deepest of equals."""
        top = max(self.score)
        return max((i for i, s in enumerate(self.score) if s == top), default=None) if top else None

    def votes(self) -> list[tuple[str, float, int, int]]:
        """(path, score, inside, outside): a path's vote for its container, and
        whether blocks on it stand inside or outside the own best one."""
        top = max(self.score)
        # of nested elements around the same text only the innermost votes, and
        # nothing around the own best one, which is worth less as a whole
        outer = {self.page.parent[i] for i in range(1, len(self.held)) if self.held[i] == self.held[self.page.parent[i]]}
        own = self.best()
        if own is None:
            return []
        i = self.page.parent[own]
        while i >= 0:
            outer.add(i)
            i = self.page.parent[i]
        best: dict[str, float] = {}
        for i, s in enumerate(self.score):
            if s >= VOTES * top and (i not in outer or i == own):
                path = self.path(i)
                best[path] = max(best.get(path, 0.0), s / top)
        inside = {self.path(i) for i, _ in self._inside([own])}
        outside = {self.path(i) for i, _ in self._inside([0])} - inside
        return [(p, best.get(p, 0.0), int(p in inside), int(p in outside)) for p in {*best, *inside, *outside}]

    def text(self, winner: str | None, template: list[str] | None = None) -> str:
        """``template``: paths of the host that hold no text of an article."""
        own = self.best()
        if own is None:
            return ""
        shown = {i for i, _ in self._inside([own]) if not template or self.path(i) not in template}
        if winner is not None:
            last = winner.rpartition(">")[2].partition(".")[0]
            on_path = [i for i, tag in enumerate(self.page.tag) if tag == last and self.held[i] and self.path(i) == winner]
            shown |= {i for i, _ in self._inside(on_path)}
        return "\n\n".join(text for i, text, _ in self.blocks if i in shown)

    def _inside(self, chosen: list[int]):
        """Blocks of containers without their boilerplate."""
        parent, tag = self.page.parent, self.page.tag
        state: dict[int, bool | None] = dict.fromkeys(chosen, True)  # None: in a header, headings only

        def of(i: int) -> bool | None:
            chain = []
            while i not in state and i > 0:
                chain.append(i)
                i = parent[i]
            now = state.get(i, False)
            for k in reversed(chain):
                if now is True and self.noise[k]:
                    now = None if tag[k] == "header" else False
                elif now is None and self.noise[k]:
                    now = False
                elif now is None and tag[k] in HEADINGS:
                    now = True
                state[k] = now
            return now

        return ((i, text) for i, text, _ in self.blocks if of(i) is True)


def host_of(url) -> F.Column:
    """Host of a url without www; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?(?:[wW]{3}\.)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def votes(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path, score, inside, outside): the votes of all pages, added up."""
    schema = T.StructType(
        [T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("score", T.DoubleType()),
         T.StructField("inside", T.LongType()), T.StructField("outside", T.LongType())]
    )

    def make():
        def step(columns):
            if columns is not None:
                told = [(h, *v) for h, source in zip(*columns, strict=True) for v in Scored(source).votes()]
                yield [[x[k] for x in told] for k in range(5)]

        return step

    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    rows = rows.where("host is not null and html is not null")
    return map_columns(rows, schema, make).groupBy("host", "path").agg(*[F.sum(c).alias(c) for c in schema.names[2:]])


def winners(votes: DataFrame) -> DataFrame:
    """(host, winner, template): the path with most votes of each host, and the
    paths that some page has inside its own container and more have outside;
    scores are rounded so that the order in which they were added can't decide."""
    best = F.max(F.when(F.col("score") > 0, F.struct(F.round("score", 3).alias("score"), F.length("path").alias("l"), "path")))
    contested = F.when((F.col("inside") > 0) & (F.col("outside") > F.col("inside")), F.col("path"))
    return votes.groupBy("host").agg(best.alias("b"), F.collect_list(contested).alias("template")).select(
        "host", F.col("b.path").alias("winner"), "template"
    )


def extract(pages: DataFrame, winners: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every page."""
    winners = written(winners, "winners")
    size = F.length("host") + F.length("winner") + F.length(F.array_join("template", "")) + 64
    small = (winners.agg(F.sum(size)).first()[0] or 0) <= SMALL
    rows = pages.select(F.col(key), F.col(url), F.col(html).alias("_html"), host_of(F.col(url)).alias("host"))
    rows = rows.join(F.broadcast(winners) if small else winners, "host", "left").select(key, url, "_html", "winner", "template")
    schema = T.StructType(
        [*rows.schema.fields[:2], T.StructField("text", T.StringType(), False), T.StructField("n_chars", T.LongType(), False)]
    )

    def make():
        def step(columns):
            if columns is not None:
                keys, urls, sources, paths, templates = columns
                texts = [Scored(s).text(p, t) if s else "" for s, p, t in zip(sources, paths, templates, strict=True)]
                yield [keys, urls, texts, [*map(len, texts)]]

        return step

    return map_columns(rows, schema, make)


def q_op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every row of ``pages``."""
    pages = read(spark, sf_dir, "pages")
    return extract(pages, winners(votes(pages)))


QUERIES = {"op5_html_extraction": q_op5_html_extraction}
