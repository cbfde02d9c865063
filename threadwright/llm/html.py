"""Main text of web pages by consensus of the pages of a host.

Every page scores its containers (text of paragraphs counts for the container around them, less
for those further up; link text counts against it). From each of the best ones it climbs to the
article or main around it, or else as long as more text outside of links, or the title before it,
comes in; text outside any container belongs to a root container with the empty path. It votes for
the generalised tag-class paths found so. A class or id that sounds like page furniture only marks
its element: the mark does not count on a page where elements of that name hold most of the text
outside of links or one of its main articles, nor around the winning container. Names of comments, notices
and advertisements are held to more: however long what they hold is, they count unless it holds the page's main element or title
and no article lies outside of it. Posts of readers are also told by structure: blocks of one
class beside each other after other text, each with an author and a date and without a heading. Votes are summed per host and path in Spark, with map-side combining, so a
host with a third of all pages is only a few sums per task. Each page is then read again with
its host's winning path; a page without that path falls back on its own best container.

Defined results: a null or empty page has the empty text. A null url counts as host ''. Equal votes
go to the path that sorts first. Repeated rows vote as often as they occur. Unclosed and stray tags
are tolerated. Other columns are passed through; one named like an added column is replaced.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, text_chunks

# --- fixed values: roles of elements in the HTML standard and usual names of page furniture ---
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROPPED = {
    "script", "style", "noscript", "template", "head", "title", "nav", "footer", "aside", "form", "button", "select",
    "textarea", "iframe", "svg", "canvas", "object", "dialog", "menu", "audio", "video",
}
CONTAINERS = {"html", "body", "main", "article", "section", "div", "td", "center", "header", "figure", "details"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
    "ruby", "rt", "rp",
}
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = {
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3",
    "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul",
}
_FURNITURE = (
    r"(?:ads?|adverts?|advertisements?|adsense|sponsor(?:ed)?|promo(?:tions?)?|banners?|side-?bars?|comments?|replies|responses|"
    r"respond|feedback|disqus|"
    r"cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|overlays?|newsletters?|subscribe|subscription|signup|share|sharing|social|"
    r"related|recommended|breadcrumbs?|menus?|nav(?:bar|igation)?|footers?|mastheads?|toolbars?|widgets?|pagination|pager|"
    r"login|search|copyright|site-?header|page-?header|topbar|skip-?link)"
)
FURNITURE = re.compile(rf"(?:^|[-_ ]){_FURNITURE}(?:$|[-_ 0-9])")
WORDS = re.compile(rf"{_FURNITURE}(?:[-_ #]+{_FURNITURE})*[-_ #]*")
_APART = (
    r"(?:ads?|adverts?|advertisements?|adsense|sponsor(?:ed)?|comments?|replies|responses|respond|feedback|disqus|cookies?|consent|gdpr|"
    r"notices?|newsletters?|subscribe|subscription|signup|related|recommended)"
)
APART = re.compile(rf"(?:^|[-_ ]){_APART}(?:$|[-_ #])")
LAYOUT = re.compile(r"(?:^|[-_ ])(?:no|not|has|have|with|without|open|closed|enabled|disabled|layout|single|hide|show|is)(?:$|[-_ #])")
AUTHOR = re.compile(r"(?:^|[-_ ])(?:author|by|byline|user|username|nick|nickname|avatar|commenter|member|poster)(?:$|[-_ #])")
DATE = re.compile(r"(?:^|[-_ ])(?:date|datetime|time|timestamp|posted|published|ago)(?:$|[-_ #])")
DATED_LINE = re.compile(
    r"\b(?:\d{4}-\d\d-\d\d|\d{1,2}[./]\d{1,2}[./](?:\d\d){1,2}|\d+ (?:minute|hour|day|week|month|year)s? ago|"
    r"(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]* \d{1,2},? \d{4}|\d{1,2} (?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]* \d{4})\b",
    re.IGNORECASE,
)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
CLOSES = {tag: SELF_CLOSING.get(tag, set()) | ({"p"} if tag in ENDS_P else set()) for tag in {*SELF_CLOSING, *ENDS_P}}
NEARLY = 0.95  # share of an ancestor's text that need not be climbed for
MOST = 0.5  # share of a page's text that no name alone can hide
PLAIN_MOST = 0.75  # the same for names of nothing but furniture words, like "comments"
FADE = 0.4  # share of a paragraph's score that goes one container further up
FAVOURED = {"article": 1.5, "main": 1.4}
HEADINGS, PLAIN = {"h1": 1, "h2": 2}, 3
SIGNED_BY, SIGNED_AT, TITLED = 1, 2, 4
SIGNATURE = 80  # characters of a line that names an author and a date
LEFT_OVER = 60  # characters beside the posts of a discussion, like its title
VOTES = 3


@lru_cache(maxsize=1 << 16)
def described(classes: str, own_id: str) -> tuple[str, str, tuple[str, ...], int]:
    """Generalised classes and id of an element, those that sound like furniture, whether they sign a post."""
    names, own = [re.sub(r"\d+", "#", c) for c in sorted(classes.split())], re.sub(r"\d+", "#", own_id)
    signs = sum(flag for flag, words in ((SIGNED_BY, AUTHOR), (SIGNED_AT, DATE)) if any(words.search(c) for c in (*names, own)))
    return "".join(f".{c}" for c in names), own, tuple(c for c in (*names, own) if FURNITURE.search(c)), signs


class Page(HTMLParser):
    """One pass over a page: blocks of text with the open containers, each container with its path."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int, int]] = []  # tag, hidden, container number or -1 for none, mark or -1
        self.paths: list[str] = [""]  # the root holds what is in no container
        self.parents: list[int] = [-1]
        self.marks: list[tuple[int, frozenset[str]]] = []  # elements named like furniture: the mark around, the names
        self.around: list[int] = [-1]  # innermost mark at each container
        self.signs: list[int] = [0]  # whether an author and a date stand in each container
        self.pieces: list[tuple[int, list[list], int]] = []  # container, [mark, data, characters of link text], level of heading
        self.steps: list[str] = []
        self.text: list[list] = []
        self.mark = -1
        self.hidden = self.links = 0
        self.feed(html)
        self.close()
        self.flush()
        self.drop_discussions()
        self.own = self.counted()
        self.counts = self.spread(self.own)
        self.blocks = self.read(self.counts)  # container, text, characters of link text, level of heading

    def container(self) -> int:
        return next((number for _, _, number, _ in reversed(self.stack) if number >= 0), 0)

    def updatepos(self, i: int, j: int) -> int:
        """Lines are not counted."""
        return j

    def flush(self) -> None:
        if not self.text:
            return
        if any(not data.isspace() for _, data, _ in self.text):
            level = next((HEADINGS[tag] for tag, *_ in self.stack if tag in HEADINGS), PLAIN)
            at = self.container()
            self.pieces.append((at, self.text, level))
            if sum(len(data) for _, data, _ in self.text) <= 2 * SIGNATURE:
                line = " ".join("".join([data for _, data, _ in self.text]).split())
                if len(line) <= SIGNATURE and any(c.isalpha() for c in DATED_LINE.sub("", line)) and DATED_LINE.search(line):
                    self.signs[at] |= SIGNED_BY | SIGNED_AT
        self.text = []

    def drop_discussions(self) -> None:
        """Leave out posts of readers: blocks of one class beside each other, each with an author and a date.

        They follow other text and hold no heading of the first three levels, as teasers of articles do. What holds them and little else goes with them.
        """
        signs = self.signs[:]
        for at in range(len(self.paths) - 1, 0, -1):
            signs[self.parents[at]] |= signs[at]
        groups: dict[tuple[int, str], list[int]] = defaultdict(list)
        for at, both in enumerate(signs):
            if both == SIGNED_BY | SIGNED_AT and self.parents[at] >= 0 and "." in self.paths[at].rsplit("/", 1)[-1]:
                groups[self.parents[at], self.paths[at]].append(at)
        if all(len(some) < 2 for some in groups.values()):
            return
        amounts, titled, firsts = [0] * len(self.paths), [False] * len(self.paths), [len(self.pieces)] * len(self.paths)
        start = len(self.pieces)  # first text that is not a link and not marked
        for k, (at, pieces, level) in enumerate(self.pieces):
            worth = sum(max(len(" ".join(data.split())) - 2 * linked, 0) for _, data, linked in pieces)
            amounts[at] += worth
            titled[at] |= level < PLAIN
            firsts[at] = min(firsts[at], k)
            if worth and pieces[0][0] < 0:
                start = min(start, k)
        for at in range(len(self.paths) - 1, 0, -1):
            amounts[self.parents[at]] += amounts[at]
            titled[self.parents[at]] |= titled[at]
            firsts[self.parents[at]] = min(firsts[self.parents[at]], firsts[at])
        posts: set[int] = set()
        for (parent, _), some in groups.items():
            if len(some) < 2 or firsts[some[0]] <= start:
                continue
            posts.update(some)
            size = sum(amounts[at] for at in some)
            while parent > 0 and not titled[parent] and self.kind(parent) not in ("html", "body", "article", "main"):
                if amounts[parent] - size > LEFT_OVER or firsts[parent] <= start:
                    break
                posts.add(parent)
                parent, size = self.parents[parent], amounts[parent]
        within = self.inside(posts)
        left = [piece for piece in self.pieces if not within[piece[0]]]
        if any(mark < 0 and not data.isspace() for _, pieces, _ in left for mark, data, _ in pieces):
            self.pieces = left

    def read(self, counts: list[bool]) -> list[tuple[int, str, int, int]]:
        """Blocks of the pieces whose mark does not count; the last entry is for no mark."""
        out = []
        for at, pieces, level in self.pieces:
            text = " ".join("".join([data for mark, data, _ in pieces if not counts[mark]]).split())
            if text:
                out.append((at, text, sum(linked for mark, _, linked in pieces if not counts[mark]), level))
        return out

    def counted(self) -> list[bool]:
        """Whether each mark makes its element furniture on this page."""
        if not self.marks:
            return []
        names: list[frozenset[str]] = []  # of the mark and those around it
        for outer, own in self.marks:
            names.append(own | names[outer] if outer >= 0 else own)
        articles = [i for i in range(len(self.paths)) if self.kind(i) in FAVOURED]
        within = self.inside(set(articles))
        sums, by_name = [0, 0], (defaultdict(int), defaultdict(int))  # outside and inside of articles
        amounts, clear = [0] * len(self.paths), False
        for at, pieces, _ in self.pieces:
            for mark, data, linked in pieces:
                worth = max(len(" ".join(data.split())) - 2 * linked, 0)
                sums[within[at]] += worth
                amounts[at] += worth
                clear |= mark < 0 and within[at] and worth > 0
                for name in names[mark] if mark >= 0 else ():
                    by_name[within[at]][name] += worth
        holding = {name for at in articles if self.kind(at) == "main" and self.around[at] >= 0 for name in names[self.around[at]]}
        title = False
        for _, pieces, level in self.pieces:
            if level == HEADINGS["h1"]:
                title |= pieces[0][0] < 0
                holding.update(names[pieces[0][0]] if pieces[0][0] >= 0 else ())

        def may_hold_all(name: str) -> bool:
            """However long they are, comments and notices are none of the text; a layout that has them may hold it."""
            if not APART.search(name):
                return True
            return not clear and (bool(LAYOUT.search(name)) or (name in holding and not title))

        lifted = set()
        for name in by_name[0].keys() | by_name[1].keys():
            inside, outside = by_name[1][name], by_name[0][name]
            if WORDS.fullmatch(name) and clear:  # beside a clear article, what is called a comment is one
                if inside > PLAIN_MOST * sums[1]:
                    lifted.add(name)
            elif inside + outside > (PLAIN_MOST if WORDS.fullmatch(name) else MOST) * sum(sums):
                lifted.add(name)
        for at in range(len(self.paths) - 1, 0, -1):
            amounts[self.parents[at]] += amounts[at]
        largest = max((amounts[i] for i in articles), default=0)
        for i in articles:
            if self.around[i] >= 0 and 0 < largest <= 2 * amounts[i]:
                lifted |= names[self.around[i]]
        lifted = {name for name in lifted if may_hold_all(name)}
        own = [mine.isdisjoint(lifted) for _, mine in self.marks]
        counts = self.spread(own)
        if all(counts[mark] for _, pieces, _ in self.pieces for mark, data, _ in pieces if not data.isspace()):
            own = [False] * len(own)  # there is nothing else on the page
        return own

    def spread(self, own: list[bool]) -> list[bool]:
        """The same with what lies inside; the last entry is for no mark."""
        out: list[bool] = []
        for (outer, _), mine in zip(self.marks, own, strict=True):  # outer marks come first
            out.append(mine or (outer >= 0 and out[outer]))
        return [*out, False]

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in VOID:
            if tag in ("br", "hr"):
                self.add(" ", 0)
            return
        closes = CLOSES.get(tag)
        if closes:
            for depth in range(len(self.stack) - 1, -1, -1):
                name = self.stack[depth][0]
                if name in closes:
                    self.pop_to(depth)
                    break
                if name not in INLINE and name != "p":
                    break
        if tag not in INLINE:
            self.flush()
        furniture = tag in DROPPED or (tag == "header" and not any(name in ("article", "main") for name, *_ in self.stack))
        classes, own_id, named, signs = "", "", (), 0
        if attrs and not furniture and not self.hidden:
            names = {k: (v or "").lower() for k, v in attrs}
            furniture = names.get("role") in ROLES or "hidden" in names or names.get("aria-hidden") == "true"
            classes, own_id, sounds, signs = described(names.get("class", ""), names.get("id", ""))
            if not furniture and tag not in ("html", "body", "article", "main"):
                named = sounds
        self.hidden += furniture
        self.links += tag == "a"
        number = mark = -1
        if named:
            mark = len(self.marks)
            self.marks.append((self.mark, frozenset(named)))
            self.mark = mark
        if tag in CONTAINERS and not self.hidden:
            step = tag + classes
            if own_id in named:
                step += "#" + own_id
            parent = self.container()
            number = len(self.paths)
            self.paths.append((self.paths[parent] + "/" if parent else "") + step)
            self.parents.append(parent)
            self.around.append(self.mark)
            self.signs.append(0)
        signs |= SIGNED_AT * (tag == "time") | TITLED * (tag in ("h1", "h2", "h3"))
        if signs and not self.hidden:
            self.signs[number if number >= 0 else self.container()] |= signs
        self.stack.append((tag, furniture, number, mark))

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "path", "use") and self.stack and self.stack[-1][0] == tag:
            self.pop_to(len(self.stack) - 1)

    def pop_to(self, depth: int) -> None:
        if depth == len(self.stack) - 1:  # the usual case
            tag, furniture, _, mark = self.stack[-1]
            if tag not in INLINE:
                self.flush()
            self.hidden -= furniture
            self.links -= tag == "a"
            if mark >= 0:
                self.mark = self.marks[mark][0]
            self.stack.pop()
            return
        if any(tag not in INLINE for tag, *_ in self.stack[depth:]):
            self.flush()
        for tag, furniture, _, _ in self.stack[depth:]:
            self.hidden -= furniture
            self.links -= tag == "a"
        first = next((mark for *_, mark in self.stack[depth:] if mark >= 0), -1)
        if first >= 0:
            self.mark = self.marks[first][0]
        del self.stack[depth:]

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, -1, -1):
            name = self.stack[depth][0]
            if name == tag:
                self.pop_to(depth)
                return
            if tag in INLINE and name in CONTAINERS:
                return  # a stray inline end tag does not close a container

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.add(data, len(data.strip()) if self.links else 0)

    def add(self, data: str, linked: int) -> None:
        if self.text and self.text[-1][0] == self.mark:
            self.text[-1][1] += data
            self.text[-1][2] += linked
        else:
            self.text.append([self.mark, data, linked])

    def kind(self, container: int) -> str:
        return self.paths[container].rsplit("/", 1)[-1].split(".")[0]

    def scores(self) -> dict[int, float]:
        """Score of every container: text not in links, passed up with loss."""
        out: dict[int, float] = defaultdict(float)
        for at, text, linked, _ in self.blocks:
            worth = max(len(text) - 2 * linked, 0) + 1.0
            while at >= 0:
                out[at] += worth
                worth *= FADE
                at = self.parents[at]
        return {i: s * FAVOURED.get(self.kind(i), 1.0) for i, s in out.items()}

    def sums(self) -> tuple[list[int], list[int]]:
        """For each container, its text outside of links and its first block."""
        amounts, firsts = [0] * len(self.paths), [len(self.blocks)] * len(self.paths)
        for k, (at, text, linked, _) in enumerate(self.blocks):
            amounts[at] += max(len(text) - 2 * linked, 0)
            firsts[at] = min(firsts[at], k)
        for at in range(len(self.paths) - 1, 0, -1):  # parents come before their children
            parent = self.parents[at]
            amounts[parent] += amounts[at]
            firsts[parent] = min(firsts[parent], firsts[at])
        return amounts, firsts

    def whole(self, best: int, amounts: list[int], firsts: list[int]) -> int:
        """The container to take for one of the best: the whole article that it is part of."""
        chain = [best]
        while self.parents[chain[-1]] >= 0:
            chain.append(self.parents[chain[-1]])
        marked = [k for k, at in enumerate(chain) if self.kind(at) in FAVOURED]
        at, above = chain[marked[-1] if marked else 0], chain[marked[-1] + 1 if marked else 1 :]
        if marked:  # articles of another kind beside this one
            level = min(self.levels(at), default=PLAIN)
            more = [i for i, p in enumerate(self.parents) if p == above[0] and self.kind(i) in FAVOURED and self.paths[i] != self.paths[at]]
            if sum(amounts[i] for i in more) > (1 - NEARLY) * amounts[above[0]]:
                return above[0]
            if level < PLAIN:
                return at
        for outer in above:
            more = not marked and amounts[at] < NEARLY * amounts[outer]
            before = self.blocks[firsts[outer] : firsts[at]]
            title = min((level for _, text, linked, level in before if len(text) > 2 * linked), default=PLAIN)
            if more or title < min(self.levels(at), default=PLAIN):
                at = outer
        return at

    def levels(self, container: int) -> list[int]:
        inside = self.inside({container})
        return [level for at, _, _, level in self.blocks if inside[at]]

    def votes(self) -> list[tuple[str, float]]:
        scores = self.scores()
        best = sorted(scores, key=lambda i: (-scores[i], i))[:VOTES]
        total = sum(scores[i] for i in best)
        sums = self.sums()
        out: dict[str, float] = defaultdict(float)
        for i in best:
            out[self.paths[self.whole(i, *sums)]] += scores[i] / total
        return sorted(out.items(), key=lambda vote: (-vote[1], vote[0]))

    def inside(self, chosen: set[int]) -> list[bool]:
        out: list[bool] = []
        for number, parent in enumerate(self.parents):  # parents come before their children
            out.append(number in chosen or (parent >= 0 and out[parent]))
        return out

    def under(self, chosen: set[int]) -> str:
        """Blocks inside the chosen containers, in page order; marks around those do not count."""
        inside, opened = self.inside(chosen), set()
        for mark in {self.around[i] for i in chosen}:
            while mark >= 0:
                opened.add(mark)
                mark = self.marks[mark][0]
        blocks = self.blocks
        if any(self.own[mark] for mark in opened):
            blocks = self.read(self.spread([own and mark not in opened for mark, own in enumerate(self.own)]))
        return " ".join(text for at, text, _, _ in blocks if inside[at])

    def main_text(self, path: str | None) -> str:
        found = {i for i, p in enumerate(self.paths) if p == path}
        if path == "" and all(at for at, *_ in self.blocks):
            found = set()  # nothing stands outside the containers of this page
        for some in ({i for i in found if not self.counts[self.around[i]]}, found):
            text = self.under(some)
            if text:
                return text
        scores = self.scores()
        if not scores:
            return ""
        return self.under({self.whole(min(scores, key=lambda i: (-scores[i], i)), *self.sums())})


def host_of(url_col: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The winning container path of every host."""

    def vote(batches):
        for batch in text_chunks(batches, html_col):
            sums: dict[tuple[str, str], float] = defaultdict(float)
            for host, html in zip(batch.column("__host").to_pylist(), batch.column(html_col).to_pylist(), strict=True):
                for path, weight in Page(html).votes() if html else ():
                    sums[host, path] += weight
            keys = list(sums)
            yield pa.RecordBatch.from_pydict(
                {"__host": pa.array([k[0] for k in keys], pa.string()), "__path": pa.array([k[1] for k in keys], pa.string()), "votes": pa.array([sums[k] for k in keys], pa.float64())}
            )

    cast = pages.select(host_of(url_col).alias("__host"), html_col).mapInArrow(vote, "__host string, __path string, votes double")
    summed = cast.groupBy("__host", "__path").agg(F.round(F.sum("votes"), 6).alias("votes"))
    order = Window.partitionBy("__host").orderBy(F.desc("votes"), "__path")
    return summed.withColumn("__n", F.row_number().over(order)).filter("__n = 1").select("__host", "__path")


def extract_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", columns: list[str] | None = None) -> DataFrame:
    """The listed columns (default: all but the html) with ``text`` and ``n_chars``."""
    kept = [c for c in pages.columns if c != html_col] if columns is None else columns
    kept = [c for c in kept if c not in ("text", "n_chars")]
    schema = T.StructType([pages.schema[c] for c in kept]).add("text", "string").add("n_chars", "long")
    winners = staged(host_paths(pages, url_col, html_col), "host-paths")

    def extract(batches):
        for batch in text_chunks(batches, html_col):
            texts = [
                Page(html).main_text(path) if html else ""
                for html, path in zip(batch.column(html_col).to_pylist(), batch.column("__path").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names
            )

    named = pages.select(*dict.fromkeys([*kept, html_col]), host_of(url_col).alias("__host"))
    return named.join(winners, "__host", "left").drop("__host").mapInArrow(extract, schema)
