"""Main text of web pages by union-free wrappers, inferred for each host.

A page is a stream of tags and texts, held as a tree. The streams of a host are aligned
in order, one after another: what they share stays, a group that some lack becomes
optional, neighbours that come again become a repeated group (one tag, or a sequence such
as dt dd), and differing texts become a text slot. The result, the host's wrapper, is a
regular expression without unions, kept as a tree of groups. A group is known by its tag
and by those class, id and role tokens that a good part of the host's different pages
share; what only a page or two have (a slug, a category) is no part of the template, so
a wrapper is as large as the template, however many pages the host has. Wrappers of parts
of a host are aligned with each other in the same way, so a host's pages are never
gathered in one task. Equal pages of a host count once.

A page is read by running its host's wrapper over it: every element takes the group that
matches it in order. The wrapper shows where a host's pages hold their article: in all
article and main elements, or else in the innermost group with all of the text that is no
boilerplate. Groups of menus, headers, footers, forms and the like, and slots with a
short text that the different pages share, are left out.

All walks keep their own stacks, so pages may be nested to any depth.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

# Kinds of HTML elements, and names that mark boilerplate.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q",
          "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
SPACES = {"br", "img", "wbr"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}}  # a start tag ends an open element of these
P_ENDS = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
          "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
DROPPED = {"head", "title", "script", "style", "noscript", "template", "nav", "header", "footer", "aside", "form", "button", "select", "iframe",
           "svg", "menu", "dialog", "textarea"}
BOILERPLATE = (r"ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|header|masthead|footer|foot|sidebar|aside|"
               r"related|recommend\w*|share|social|comments?|replies|respond|disqus|notice|alert|cookies?|consent|newsletter|subscribe|popup|"
               r"modal|widget|login|signup|search|pagination|pager|copyright")
MARKS = re.compile(rf"(^|[-_ ])({BOILERPLATE}|side|legal)($|[-_ ])", re.I)
INSIDE = re.compile(rf"(^|[-_ ])({BOILERPLATE})($|[-_ ])", re.I)   # within an article
# a tag ends at the first > outside the quotes of its attributes' values
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<[/!?a-zA-Z](?>=\s*(?:"[^"]*"|'[^']*')|[^>])*+(?:>|\Z)|[^<]+|<""", re.S | re.I)
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
NAMED = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
DIGITS = re.compile(r"[0-9]+")
TEXT = "#"
SHARED = 0.75     # a text that this part of a host's different pages share (two at least), and none has otherwise, is no article text
SHARED_CHARS = 200
ALIKE = 0.5       # pages that share this part of their article's text are near copies, not one template
TOKEN_PAGES = 0.1   # of a host's different pages have a token that belongs to the template (two pages at least)
PERIOD = 4        # elements of a repeated sequence at most
WRAPPER_NODES = 4000   # groups of a wrapper; of more, those that most pages have. What a wrapper lacks is text like any other
LONG_LISTS = 400_000   # cells of an alignment table; longer lists of parts are aligned by their next equal keys
KEPT_HOSTS = 2000  # wrappers that a task holds at once
BROADCAST_CHARS = 16_000_000   # of what is known of all hosts, sent to all tasks at most; more is joined by host and salt


# --- pages --------------------------------------------------------------------------

class Element:
    __slots__ = ("name", "marks", "parts")

    def __init__(self, name: str, marks: tuple[str, ...] = ()) -> None:
        self.name, self.marks = name, marks
        self.parts: list = []   # texts and elements


def parse(source: str) -> Element:
    """A page's tree. Marks are the tokens of class, id and role in lower case, without digits."""
    root = Element("")
    stack = [root]
    for m in TOKEN.finditer(source):
        t = m[0]
        if t[0] != "<" or len(t) == 1:
            stack[-1].parts.append(t)
            continue
        tag = TAG.match(t)
        if not tag or not t.endswith(">"):
            continue  # comments, declarations, a tag that the page's end cuts off
        name = tag[2].lower()
        if tag[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
            continue
        if name in ("script", "style"):
            continue
        ends = ENDS.get(name, set()) | ({"p"} if name in P_ENDS else set())
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                open_name = stack[i].name
                if open_name in ends:
                    del stack[i:]
                    break
                if open_name not in INLINE and open_name not in ("thead", "tbody", "tfoot"):
                    break
        element = Element(name, _marks(t) if "=" in t else ())
        stack[-1].parts.append(element)
        if name not in VOID and not t.endswith("/>"):
            stack.append(element)
    return root


def _marks(tag: str) -> tuple[str, ...]:
    values = " ".join(a or b or c for a, b, c in NAMED.findall(tag))
    return tuple(dict.fromkeys(DIGITS.sub("", values).lower().split()))


def _plain(text: str) -> str:
    return " ".join(html.unescape(text).split())


def key_of(name: str, marks: tuple[str, ...], known: set[str] | None) -> str:
    """The tag with those of its marks that belong to the template (all, if that is not known)."""
    kept = [m for m in marks if known is None or m in known]
    return f"{name} {' '.join(kept)}" if kept else name


def dropped(name: str, marks: tuple[str, ...], inside: bool) -> bool:
    return name in DROPPED or (bool(marks) and name not in ("article", "main", "body", "html") and bool((INSIDE if inside else MARKS).search(" ".join(marks))))


def is_article(name: str, marks: tuple[str, ...]) -> bool:
    return name in ("article", "main") or "main" in marks or "article" in marks


# --- skeletons: what a wrapper needs of a page -----------------------------------------

def skeleton(root: Element) -> list:
    """The page in one flat list: an element opens as [name, marks], closes as 0; a text is its length and itself, if it is short."""
    out: list = []
    todo: list = [iter(root.parts)]
    while todo:
        part = next(todo[-1], None)
        if part is None:
            todo.pop()
            if todo:
                out.append(0)
        elif isinstance(part, str):
            text = _plain(part)
            if text:
                out.append([len(text), text if len(text) <= SHARED_CHARS else ""])
        else:
            out.append([part.name, list(part.marks)])
            todo.append(iter(part.parts))
    return out


# --- wrappers ---------------------------------------------------------------------------

class Group:
    """A wrapper's group: key (the tag and its marks; "" for a repeated sequence), pages with it, pages with own texts in
    it, characters of these, the one text they share ("" for several), parts in order, flags."""

    __slots__ = ("key", "pages", "said", "chars", "text", "parts", "optional", "repeated")

    def __init__(self, key: str, pages: int = 1) -> None:
        self.key, self.pages, self.said, self.chars, self.text = key, pages, 0, 0, None
        self.parts: list[Group] = []
        self.optional = self.repeated = False

    @property
    def name(self) -> str:
        return self.key.partition(" ")[0]

    @property
    def marks(self) -> tuple[str, ...]:
        return tuple(self.key.split()[1:])


def wrap(page: list | Element, known: set[str] | None = None) -> Group:
    """The wrapper of one page, given as its skeleton or tree."""
    page = skeleton(page) if isinstance(page, Element) else page
    root = Group("")
    stack, said = [root], [[]]

    def close() -> None:
        g, own = stack.pop(), said.pop()
        g.parts = collapsed(g.parts)
        if own:
            g.said, g.chars = 1, sum(n for n, _ in own)
            whole = " ".join(t for _, t in own) if all(t for _, t in own) else ""
            g.text = whole if len(whole) <= SHARED_CHARS else ""
    for part in page:
        if part == 0:
            close()
        elif isinstance(part[0], int):
            said[-1].append(part)
        else:
            g = Group(key_of(part[0], tuple(part[1]), known))
            stack[-1].parts.append(g)
            stack.append(g)
            said.append([])
    close()
    return root


def collapsed(parts: list[Group]) -> list[Group]:
    """Neighbours that come again, alone or as a sequence of up to PERIOD, as one repeated group."""
    for period in range(1, PERIOD + 1):
        if len(parts) < 2 * period:
            break
        out: list[Group] = []
        i = 0
        while i < len(parts):
            block = parts[i:i + period]
            keys = [g.key for g in block]
            j = i + period
            while len(block) == period and [g.key for g in parts[j:j + period]] == keys and "" not in keys:
                j += period
            if j == i + period or len(block) < period:
                out.append(parts[i])
                i += 1
                continue
            if period == 1:
                one = block[0]
            else:
                one = Group("")
                one.parts = block
            for k in range(i + period, j, period):
                if period == 1:
                    other = parts[k]
                else:
                    other = Group("")
                    other.parts = parts[k:k + period]
                one = align(one, other, same_page=True)
            one.repeated = True
            out.append(one)
            i = j
        parts = out
    return parts


def _pairs(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """The places of a longest common subsequence; for very long lists of one that takes the next equal key."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    head, tail = [(i, i) for i in range(lo)], [(len(a) - hi + i, len(b) - hi + i) for i in range(hi)]
    x, y = a[lo:len(a) - hi], b[lo:len(b) - hi]
    middle: list[tuple[int, int]] = []
    if x and y and len(x) * len(y) <= LONG_LISTS:
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x) - 1, -1, -1):
            row, below = best[i], best[i + 1]
            for j in range(len(y) - 1, -1, -1):
                row[j] = below[j + 1] + 1 if x[i] == y[j] else max(below[j], row[j + 1])
        i = j = 0
        while i < len(x) and j < len(y):
            if x[i] == y[j]:
                middle.append((lo + i, lo + j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
    elif x and y:
        places: dict[str, list[int]] = {}
        for j in range(len(y) - 1, -1, -1):
            places.setdefault(y[j], []).append(j)
        after = -1
        for i, k in enumerate(x):
            while places.get(k) and places[k][-1] <= after:
                places[k].pop()
            if places.get(k):
                after = places[k].pop()
                middle.append((lo + i, lo + after))
    return head + middle + tail


def _sequenced(parts: list[Group], other: list[Group]) -> list[Group]:
    """``parts`` with the sequences that are one repeated group on the other side taken together."""
    for g in other:
        if g.key:
            continue
        keys = [p.key for p in g.parts]
        out: list[Group] = []
        i = 0
        while i < len(parts):
            if [p.key for p in parts[i:i + len(keys)]] == keys:
                one = Group("", max(p.pages for p in parts[i:i + len(keys)]))
                one.parts = parts[i:i + len(keys)]
                out.append(one)
                i += len(keys)
            else:
                out.append(parts[i])
                i += 1
        parts = out
    return parts


def _signature(g: Group) -> str:
    return g.key or "(" + " ".join(p.key for p in g.parts) + ")"


def align(a: Group, b: Group, same_page: bool = False) -> Group:
    """The wrapper of both: parts are aligned in order, a group that one lacks becomes optional, differing texts a slot.

    On one page (a group that comes again) pages count once."""
    root = Group(a.key, 0)
    todo = [(a, b, root)]
    while todo:
        x, y, g = todo.pop()
        if same_page:
            g.pages, g.said = max(x.pages, y.pages), max(x.said, y.said)
        else:
            g.pages, g.said = x.pages + y.pages, x.said + y.said
        g.chars = x.chars + y.chars
        g.optional, g.repeated = x.optional or y.optional, x.repeated or y.repeated
        g.text = y.text if x.text is None else x.text if y.text in (None, x.text) else ""
        left, right = _sequenced(x.parts, y.parts), _sequenced(y.parts, x.parts)
        i = j = 0

        def alone(p: Group) -> None:
            p.optional = True
            g.parts.append(p)
        for m, n in [*_pairs([_signature(p) for p in left], [_signature(p) for p in right]), (len(left), len(right))]:
            for p in [*left[i:m], *right[j:n]]:
                alone(p)
            if m < len(left):
                g.parts.append(Group(left[m].key, 0))
                todo.append((left[m], right[n], g.parts[-1]))
            i, j = m + 1, n + 1
    return root


def nodes_of(g: Group) -> Iterator[tuple[int, Group]]:
    """(depth, group) in the order of the expression."""
    todo = [(0, g)]
    while todo:
        depth, x = todo.pop()
        yield depth, x
        todo.extend((depth + 1, p) for p in reversed(x.parts))


def pruned(g: Group) -> Group:
    """A wrapper of WRAPPER_NODES groups at most: those that most pages have, earlier ones first."""
    every = [x for _, x in nodes_of(g)]
    if len(every) > WRAPPER_NODES:
        keep = {id(every[i]) for i in sorted(range(len(every)), key=lambda i: (-every[i].pages, i))[:WRAPPER_NODES]}
        for x in every:
            x.parts = [p for p in x.parts if id(p) in keep]
    return g


def dumped(g: Group) -> str:
    return json.dumps([[d, x.key, x.pages, x.said, x.chars, x.text, int(x.optional) + 2 * int(x.repeated)] for d, x in nodes_of(g)])


def loaded(text: str) -> Group:
    stack: list[Group] = []
    for depth, key, pages, said, chars, shared, flags in json.loads(text):
        g = Group(key, pages)
        g.said, g.chars, g.text, g.optional, g.repeated = said, chars, shared, bool(flags & 1), bool(flags & 2)
        del stack[depth:]
        if stack:
            stack[-1].parts.append(g)
        stack.append(g)
    return stack[0]


def expression(g: Group) -> str:
    """The wrapper as a regular expression: # is a text slot, ( )? an optional and ( )+ a repeated group."""
    out: list[str] = []
    todo: list = [g]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        flags = ("+" if x.repeated else "") + ("?" if x.optional else "")
        text = TEXT if x.text == "" else x.text or ""
        begin, end = (f"<{x.key}>", f"</{x.name}>") if x.key else ("", "")
        bare = not flags
        todo += [("" if bare else f"){flags}"), end, *reversed(x.parts), text, begin, "" if bare else "("]
    return "".join(out)


# --- the article ---------------------------------------------------------------------

class Reading:
    """What a wrapper says about its host's pages: the groups of the article, sums over subtrees, shared texts."""

    def __init__(self, wrapper: Group) -> None:
        self.wrapper, self.pages = wrapper, wrapper.pages
        order, parent, inside = [], {}, {}
        todo: list[tuple[Group, Group | None, bool]] = [(wrapper, None, False)]
        while todo:   # groups that are not dropped, parents first
            g, up, within = todo.pop()
            within = within or is_article(g.name, g.marks)
            order.append(g)
            parent[id(g)], inside[id(g)] = up, within
            todo += [(p, g, within) for p in reversed(g.parts) if not dropped(p.name, p.marks, within)]
        self.total, self.shared = {}, {}
        for g in reversed(order):
            self.total[id(g)] = g.chars + sum(self.total.get(id(p), 0) for p in g.parts)
            self.shared[id(g)] = (g.chars if self.is_shared(g) else 0) + sum(self.shared.get(id(p), 0) for p in g.parts)
        self.roots = {id(g) for g in order if is_article(g.name, g.marks) and not (parent[id(g)] is not None and inside[id(parent[id(g)])])}
        if not self.roots:
            self.roots = {id(self._innermost())}
        chosen = [g for g in order if id(g) in self.roots]
        total, shared = (sum(x[id(g)] for g in chosen) for x in (self.total, self.shared))
        self.varies = shared < ALIKE * total   # near copies of one page are no template

    def is_shared(self, g: Group) -> bool:
        """Is the text of this slot short, and the same on nearly all of the host's different pages?"""
        return g.said >= max(2, SHARED * self.pages) and bool(g.text) and len(g.text) <= SHARED_CHARS

    def _innermost(self) -> Group:
        """The innermost group beside which there is nothing but boilerplate: dropped groups and texts that the host's pages share."""
        g = self.wrapper
        if self.shared[id(g)] >= ALIKE * self.total[id(g)]:
            return g
        while True:
            own = [p for p in g.parts if id(p) in self.total and self.shared[id(p)] < self.total[id(p)]]
            if g.text is not None and not self.is_shared(g) or len(own) != 1:
                return g   # no group inside, or several, hold text that differs from page to page
            inner = own[0]
            if inner.repeated or not inner.key or inner.name in INLINE or inner.name in ("p", "li", "td", "tr"):
                return g
            g = inner


def matched(root: Element, wrapper: Group, known: set[str] | None) -> dict[int, Group]:
    """The wrapper's group of every element that it describes, by running it over the page: an element takes the next
    group with its key, or the first one where a repeated group begins again."""
    out = {id(root): wrapper}
    todo = [root]
    while todo:
        e = todo.pop()
        places: dict[str, list[tuple[int, Group]]] = {}
        n = 0
        for g in out[id(e)].parts:
            for x in (g,) if g.key else g.parts:
                places.setdefault(x.key, []).append((n, x))
                n += 1
        at = 0
        for part in e.parts:
            if isinstance(part, str):
                continue
            found = places.get(key_of(part.name, part.marks, known))
            if found:
                at, g = next((f for f in found if f[0] >= at), found[0])
                out[id(part)] = g
                todo.append(part)
    return out


def blocks(root: Element, groups: dict[int, Group], reading: Reading) -> list[str]:
    """The blocks of text of the article's elements, in page order. Texts that the host's pages share go, but headings.

    Inline elements go with the text around them only. Of a header inside an article the headings stay."""
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = _plain("".join(run))
        run.clear()
        if text:
            out.append(text)

    # what is to be done: an element (is it in the article, is the text around it left out), a text, or the end of a block
    todo: list = [(root, False, True)]
    while todo:
        step = todo.pop()
        if step is None:
            close()
            continue
        if isinstance(step, str):
            run.append(step)
            continue
        e, within, around = step
        g = groups.get(id(e))
        begins = not within and g is not None and id(g) in reading.roots
        if begins:
            within = around = True
        skip = reading.varies and g is not None and reading.is_shared(g) and e.name not in HEADINGS
        if e.name in INLINE:
            skip = skip and around
        below: list = [None] if begins else []
        for part in e.parts:
            if isinstance(part, str):
                if within and not skip:
                    below.append(part)
            elif dropped(part.name, part.marks, within):
                if part.name not in INLINE:
                    below.append(None)
                    if within and HEADER & {part.name, *part.marks}:
                        below += [x for h in _headings(part) for x in ((h, True, False), None)]
            elif part.name in SPACES:
                if within:
                    below.append(" ")
            else:
                end = [None] if part.name not in INLINE else []
                below += [*end, (part, within, skip or (g is not None and g.text is None)), *end]
        if begins:
            below.append(None)
        todo.extend(reversed(below))
    close()
    return out


HEADER = {"header", "masthead", "article-header", "entry-header", "post-header"}


def _headings(e: Element) -> list[Element]:
    """The headings inside a header."""
    out: list[Element] = []
    todo = [e]
    while todo:
        x = todo.pop()
        if x.name in HEADINGS:
            out.append(x)
        elif x.name not in ("nav", "form", "aside"):
            todo.extend(p for p in reversed(x.parts) if isinstance(p, Element))
    return out


def main_text(source: str, wrapper: Group | Reading | None, known: set[str] | None = None) -> str:
    """The article's blocks, joined by blank lines. A page that lacks the groups of its host's article is read by a wrapper of its own."""
    root = parse(source)
    if wrapper is not None:
        reading = wrapper if isinstance(wrapper, Reading) else Reading(wrapper)
        groups = matched(root, reading.wrapper, known)
        if any(id(g) in reading.roots for g in groups.values()):
            return "\n\n".join(blocks(root, groups, reading))
    reading = Reading(wrap(skeleton(root)))
    return "\n\n".join(blocks(root, matched(root, reading.wrapper, None), reading))


# --- hosts --------------------------------------------------------------------------------

def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))


def _skeletons(batches):
    """(host, digest of the whole content, skeleton, its tokens)."""
    for pdf in batches:
        rows = []
        for host, source in zip(pdf.host, pdf.html):
            root = parse(source)
            flat = skeleton(root)
            digest = hashlib.md5(json.dumps(flat).encode("utf-8", "replace"))
            for m in TOKEN.finditer(source):   # texts too long for the skeleton tell pages apart as well
                if m[0][0] != "<" and len(m[0]) > SHARED_CHARS:
                    digest.update(m[0].encode("utf-8", "replace"))
            tokens = sorted({m for x in flat if x and isinstance(x[0], str) for m in x[1]})
            rows.append((host, digest.hexdigest(), json.dumps(flat), tokens))
        yield pd.DataFrame(rows, columns=["host", "digest", "page", "tokens"], dtype=object)


def _partial(salts: int):
    """One wrapper for each host of a task, or more where a task has very many hosts."""
    def run(batches):
        from pyspark import TaskContext

        salt, kept = TaskContext.get().partitionId() % salts, {}

        def rows():
            return pd.DataFrame([(h, salt, dumped(pruned(w)), t) for h, (w, t) in kept.items()], columns=["host", "salt", "wrapper", "tokens"], dtype=object)

        for pdf in batches:
            for host, page, tokens in zip(pdf.host, pdf.page, pdf.known):
                one = wrap(json.loads(page), set(tokens))
                kept[host] = (pruned(align(kept[host][0], one)) if host in kept else one, tokens)
                if len(kept) >= KEPT_HOSTS:
                    yield rows()
                    kept.clear()
        yield rows()
    return run


def by_host(rows: DataFrame, known: DataFrame, host: str, salts: int) -> DataFrame:
    """``rows`` with the columns of ``known``, which has a row for each host; no host's rows are gathered in one task."""
    texts = [F.length(F.to_json(F.struct(c))) for c in known.columns]
    size = known.agg(F.sum(sum(texts[1:], texts[0]))).first()[0]
    if (size or 0) <= BROADCAST_CHARS:
        return rows.join(F.broadcast(known), host)
    dealt = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    copies = known.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return dealt.join(copies, [host, "_salt"]).drop("_salt")


def salts_of(df: DataFrame) -> int:
    return max(1, round(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) ** 0.5))


def _merged(pdf: pd.DataFrame) -> pd.DataFrame:
    parts = [loaded(w) for w in sorted(pdf.wrapper)]
    whole = parts[0]
    for p in parts[1:]:
        whole = pruned(align(whole, p))
    return pd.DataFrame([(pdf.host.iloc[0], int(pdf.salt.iloc[0]), dumped(whole), pdf.tokens.iloc[0])], columns=["host", "salt", "wrapper", "tokens"], dtype=object)


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, html) -> (host, wrapper, tokens): one wrapper a host, merged first by salt and then as a whole, and the tokens of its template.

    Only skeletons are shuffled, without the long texts, and those of equal pages once."""
    found = pages.mapInPandas(_skeletons, "host string, digest string, page string, tokens array<string>").dropDuplicates(["host", "digest"])
    found = materialise(found, "skeletons")
    # a token of TOKEN_PAGES of the pages or more: at most 1 / TOKEN_PAGES times as many as a page has
    sizes = found.groupBy("host").agg(F.count("*").alias("pages"))
    tokens = (found.select("host", F.explode("tokens").alias("token")).groupBy("host", "token").agg(F.count("*").alias("n")).join(sizes, "host")
              .where((F.col("pages") == 1) | (F.col("n") >= F.greatest(F.lit(2.0), F.col("pages") * TOKEN_PAGES)))
              .groupBy("host").agg(F.array_sort(F.collect_list("token")).alias("known")))
    tokens = materialise(sizes.select("host").join(tokens, "host", "left").withColumn("known", F.coalesce("known", F.array().cast("array<string>"))), "tokens")
    salts = salts_of(pages)
    schema = "host string, salt int, wrapper string, tokens array<string>"
    parts = by_host(found.select("host", "page"), tokens, "host", salts).select("host", "page", "known").mapInPandas(_partial(salts), schema).groupBy("host", "salt").applyInPandas(_merged, schema)
    return parts.groupBy("host").applyInPandas(_merged, schema).select("host", "wrapper", "tokens")


def extract_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The columns of ``pages`` with text (the article's blocks, joined by blank lines; empty if none) and n_chars (its code points).

    Null html counts as empty, null urls as one host. Unclosed tags, any depth of nesting and pages cut off
    anywhere are read as far as they go. Repeated rows stay; columns named like the
    two new ones are replaced. An empty table gives no rows.
    """
    sources = pages.select(host_of(F.col(url_col)).alias("host"), F.coalesce(html_col, F.lit("")).alias("html"))
    known = materialise(wrappers(sources), "wrappers").select(F.col("host").alias("_host"), F.col("wrapper").alias("_wrapper"), F.col("tokens").alias("_tokens"))

    @F.pandas_udf("string")
    def text(source: pd.Series, wrapper: pd.Series, tokens: pd.Series) -> pd.Series:
        read: dict[str, tuple[Reading, set]] = {}
        out = []
        for s, w, t in zip(source, wrapper, tokens):
            if w not in read:
                if len(read) >= KEPT_HOSTS:
                    read.clear()
                read[w] = Reading(loaded(w)), set(t)
            out.append(main_text(s or "", *read[w]))
        return pd.Series(out, dtype=object)

    joined = by_host(pages.withColumn("_host", host_of(F.col(url_col))), known, "_host", salts_of(pages))
    return (joined.withColumn("text", text(F.col(html_col), F.col("_wrapper"), F.col("_tokens"))).withColumn("n_chars", F.length("text").cast("long"))
            .drop("_host", "_wrapper", "_tokens"))
