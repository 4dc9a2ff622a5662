"""Operator 10: main text of web pages by wrappers, union-free expressions inferred per host.

A page becomes a nested expression: elements with their bodies, and text slots.  Pages of
one host are aligned one after another.  Where two expressions agree they stay; an
element that only one of them has becomes optional; neighbours that repeat, alone or as a
group, become one repeated element; differing strings are text slots anyway.  No choice
between two forms is ever needed, so the expression stays union-free, and merging is the
same work wherever it happens: partial wrappers of a host are merged in map tasks, then
by host and salt, then by host.

Every page is matched against the expression of its host, which puts each block into one
text slot, and the slots decide.  Slots below an article or main element are main text;
those below menus, notices and the like never are.  On a page that has no block in the
former, the other slots count, without the blocks that the host repeats there: a text that
stands in one slot on most of the pages without main element.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate, groupby

import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import Scratch, columns, map_rows
from claimloom.llm.url_rules import split_url

#: Elements that break text into blocks.
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead"
    " title tr ul".split()
)
#: Elements whose content is never main text.  Raw text ends at its end tag or with
#: the page; hidden elements are left out of the text around them; end tags in inert ones end nothing outside.
RAW = ["script", "style", "textarea", "iframe"]
HIDDEN = {"noscript", "template", "svg", "foreignobject", "object", "select", "button"}
INERT = {"noscript", "template"}
LEFT_OUT = {"head", "title", "nav", "footer", "aside", "form", "menu", "dialog"}
#: Words in class, id or role that mark what is not main text.
MARKS = set(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice"
    " popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs share sharing social related"
    " comment comments replies respond disqus newsletter subscribe subscription footer masthead toolbar contentinfo"
    " complementary search".split()
)
MAIN = {"article", "main"}
#: An element that opens closes these, if they are still open, up to the nearest of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, {"html"}),
}
#: Elements nested deeper than this count as their ancestor, unless they tell what is main text;
#: their text stays whole and their end tags end them alone.
MAX_DEPTH = 120
SALTS = 32
HELD_HOSTS = 500
#: Shapes of pages a task remembers to have merged; results stay the same.
KNOWN_SHAPES = 10_000
#: A text is repeated by its host if it stands in one slot on so many of the plain pages at least, and this share of them:
#: that two pages agree proves nothing, and a page or two without it disprove nothing.
LEAST_PAGES, LEAST_SHARE = 3, 2 / 3
#: One word that a slot holds beside others, like the label of a section, is no repeated text unless it fills this share.
FILLS_SLOT = 0.9
#: A needed place counts this much and one, so most places come first.
WEIGHT = 1 << 20
#: Sequences of labels a level keeps the places of; results stay the same.
KNOWN_SEQUENCES = 100
KNOWN_LENGTH = 200

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-z][^>]*+>|<[!?][^>]*+>",
    re.S | re.I,
)
_MARKED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")

# An expression is a list of [label, quantifier, body]; quantifiers are 1, ?, + and *.
Expression = list


def _label(name: str, rest: str) -> str:
    """The element's name, marked if it or its attributes say that it is not main text."""
    marked = name in LEFT_OUT
    if not marked and rest:
        for groups in _MARKED.findall(rest):
            words = _WORD.findall(" ".join(groups).lower())
            if name not in MAIN and name not in ("body", "html"):
                marked |= not MARKS.isdisjoint(words)
    return f"-{name}" if marked else name


def _tells(label: str, path: str) -> bool:
    """Whether a label below a path tells more than the path if text is main text."""
    if "/-" in path or label in path.split("/"):
        return False
    return label in MAIN or label == "header" or label.startswith("-")


def _unclosed(tokens: list[tuple[re.Match, str]]) -> set[int]:
    """Where hidden elements start that no end tag of theirs follows."""
    opened: dict[str, list[int]] = {name: [] for name in HIDDEN}
    for token, name in tokens:
        if name not in HIDDEN or name == "svg" and token["rest"].endswith("/"):
            continue
        if not token["close"]:
            opened[name].append(token.start())
        elif opened[name]:
            opened[name].pop()
    return {start for starts in opened.values() for start in starts}


def blocks_of(page: str, folded: bool = True) -> tuple[list[tuple[str, str]], Expression]:
    """Blocks of a page, (path, text) in page order, and its expression, folded.

    If it is not to be folded, its text slots hold the numbers of their blocks.  A hidden element is left out up to its end tag or that of an element around it; one that
    has no end tag, up to the next block.
    """
    blocks: list[tuple[str, str]] = []
    root: Expression = []
    stack: list[tuple[str, str, Expression]] = [("", "", root)]  # name, path, body
    open_at: dict[str, list[int]] = {name: [] for name in BLOCKS}  # where in the stack elements are open
    levels = 0  # open elements that do not count as their ancestor
    held: list[str] = []
    hidden: list[tuple[str, bool]] = []  # open hidden elements and blocks in them: name, has no end tag

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            _, path, body = stack[-1]
            if not body or body[-1][0] != "#":
                body.append(["#", "1", []])
            if not folded:
                body[-1][2].append(len(blocks))
            blocks.append((path, text))

    def close_to(depth: int) -> None:
        nonlocal levels
        while len(stack) > depth:
            name, _, body = stack.pop()
            open_at[name].pop()
            if body is not stack[-1][2]:
                levels -= 1
                if folded:
                    body[:] = fold(body)

    def open_names(names: set[str], until: set[str]) -> int | None:
        """The depth of the outermost open element of ``names`` within the nearest of ``until``."""
        nearest = max((open_at[name][-1] for name in until if open_at[name]), default=0)
        within = (bisect_right(open_at[name], nearest) for name in names)
        return min((open_at[name][k] for name, k in zip(names, within) if k < len(open_at[name])), default=None)

    def leave(name: str) -> bool:
        """End the innermost hidden element, or block in one, of this name."""
        for depth in range(len(hidden) - 1, -1, -1):
            if hidden[depth][0] == name:
                del hidden[depth:]
                return True
        return False

    def still_hidden(name: str, close: str) -> bool:
        """Whether a tag of a block is left out too; if not, no hidden element is open any more."""
        for depth, (_, alone) in enumerate(hidden):
            if alone:
                del hidden[depth:]
                break
        if close:
            if not hidden or leave(name) or any(outer in INERT for outer, _ in hidden):
                return bool(hidden)
            if open_at[name]:
                hidden.clear()
            return bool(hidden)
        while hidden and hidden[-1][0] == "svg" and name != "title":  # a block ends a drawing
            hidden.pop()
        if hidden and name != "hr":
            hidden.append((name, False))
        return bool(hidden)

    at = 0
    tokens = [(token, (token["name"] or "").lower()) for token in _TOKEN.finditer(page)]
    unclosed = _unclosed(tokens)
    for token, name in tokens:
        if token.start() > at and not hidden:
            held.append(html.unescape(page[at : token.start()]))
        at = token.end()
        if name == "br" and not hidden:
            held.append(" ")
        if name in HIDDEN:
            alone = token.start() in unclosed
            if token["close"]:
                leave(name)
            elif not (token["rest"].endswith("/") and (alone or name == "svg")):
                hidden.append((name, alone))
            continue
        if name not in BLOCKS or hidden and still_hidden(name, token["close"]):
            continue
        flush()
        if token["close"]:
            if open_at[name]:
                close_to(open_at[name][-1])
            continue
        depth = len(stack) - 1 if stack[-1][0] == "p" else None  # any block ends a paragraph
        if depth is None and name in CLOSES:
            depth = open_names(*CLOSES[name])
        if depth is not None:
            close_to(depth)
        if name == "hr":
            continue
        label = _label(name, token["rest"] or "")
        _, path, body = stack[-1]
        open_at[name].append(len(stack))
        if levels >= MAX_DEPTH and not _tells(label, path):
            stack.append((name, path, body))
            continue
        levels += 1
        last = path.rpartition("/")[2]
        inner: Expression = []
        body.append([label, "1", inner])
        stack.append((name, path if last == label else f"{path}/{label}", inner))
    if at < len(page) and not hidden:
        held.append(html.unescape(page[at:]))
    flush()
    close_to(1)
    return blocks, fold(root) if folded else root


def _quantifier(optional: bool, many: bool) -> str:
    return "*" if optional and many else "?" if optional else "+" if many else "1"


def _together(a: list, b: list, many: bool) -> list:
    """One element for two of one label; ``many`` if they are neighbours."""
    optional = a[1] in "?*" and b[1] in "?*" if many else a[1] in "?*" or b[1] in "?*"
    return [a[0], _quantifier(optional, many or a[1] in "+*" or b[1] in "+*"), align(a[2], b[2])]


def fold(items: Expression) -> Expression:
    """Neighbours that repeat, alone or in groups of up to four, as one repeated element."""
    single: Expression = []
    for item in items:
        if single and single[-1][0] == item[0]:
            single[-1] = _together(single[-1], item, True)
        else:
            single.append(item)
    out: Expression = []
    at = 0
    while at < len(single):
        for size in (2, 3, 4):
            unit = [x[0] for x in single[at : at + size]]
            end = at + size
            while len(unit) == size and [x[0] for x in single[end : end + size]] == unit:
                end += size
            if end > at + size:
                body = single[at : at + size]
                for start in range(at + size, end, size):
                    body = align(body, single[start : start + size])
                out.append(["()", "+", body])
                at = end
                break
        else:
            out.append(single[at])
            at += 1
    return out


def align(a: Expression, b: Expression) -> Expression:
    """The expression of both: the longest common run of labels, the rest optional."""
    if a == b:
        return a
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            same = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else 0
            best[i][j] = max(same, best[i + 1][j], best[i][j + 1])
    out: Expression = []
    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i][0] == b[j][0] and best[i][j] == best[i + 1][j + 1] + 1:
            out.append(_together(a[i], b[j], False))
            i, j = i + 1, j + 1
            continue
        if j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            label, quantifier, body = a[i]
            i += 1
        else:
            label, quantifier, body = b[j]
            j += 1
        out.append([label, _quantifier(True, quantifier in "+*"), body])
    return fold(out)


class Level:
    """One level of an expression: its places in order, groups dissolved, each with its body.

    ``kinds`` gets what each text slot is by the labels it lies below; a slot's number is its place there.

    A place is (label, last place from which it is reached, weight).  Anything may be
    skipped; from within a repeated group its other places are reached again.
    """

    def __init__(self, items: Expression, kinds: list[str], path: str = ""):
        self.bodies: list[Level | int] = []  # the level below or, of a text slot, its number
        self._places: list[tuple[str, int, int]] = []
        self._by_label: dict[str, list[int]] = {}
        self._known: dict[tuple[str, ...], list[int | None]] = {}
        self._path = path
        self._add(items, kinds, True)
        for place, (label, _, _) in enumerate(self._places):
            self._by_label.setdefault(label, []).append(place)

    def _add(self, items: Expression, kinds: list[str], needed: bool) -> None:
        for label, quantifier, body in items:
            must = needed and quantifier in "1+"
            first = len(self._places)
            if label == "()":
                self._add(body, kinds, must)
                last = len(self._places) - 1
                self._places[first:] = [(name, last, weight) for name, _, weight in self._places[first:]]
                continue
            if label == "#":
                self.bodies.append(len(kinds))
                kinds.append(kind_of(self._path))
            else:
                self.bodies.append(Level(body, kinds, f"{self._path}/{label}"))
            self._places.append((label, first if quantifier in "+*" else first - 1, WEIGHT + must))

    def places(self, labels: tuple[str, ...]) -> list[int | None]:
        """The place of each label of a page's sequence: most of them placed, needed places first."""
        found = self._known.get(labels)
        if found is None:
            if len(self._known) >= KNOWN_SEQUENCES:
                self._known.clear()
            found = self._best(labels)
            if len(labels) <= KNOWN_LENGTH:
                self._known[labels] = found
        return found

    def _best(self, labels: tuple[str, ...]) -> list[int | None]:
        none = (0, None)
        best: list[tuple] = [(-1, None)] * len(self._places)  # by last place: score, (label's number, place, before)
        for number, label in enumerate(labels):
            reached = self._by_label.get(label)
            if not reached:
                continue
            up_to = list(accumulate(best, lambda a, b: b if b[0] > a[0] else a, initial=none))
            for place in reached:
                _, last, weight = self._places[place]
                score, before = up_to[last + 1]
                if score + weight > best[place][0]:
                    best[place] = (score + weight, (number, place, before))
        found: list[int | None] = [None] * len(labels)
        _, chain = max([none, *best], key=lambda state: state[0])
        while chain is not None:
            number, place, chain = chain
            found[number] = place
        return found


class Slots:
    """The text slots of an expression, numbered in its order."""

    def __init__(self, expression: Expression | None):
        self.kinds: list[str] = []
        self._top = Level(expression or [], self.kinds)

    def of(self, tree: Expression) -> dict[int, int]:
        """The slot of each block of a page; blocks in elements the expression lacks have none."""
        found: dict[int, int] = {}

        def match(items: Expression, level: Level) -> None:
            runs = [(label, [body for _, _, body in same]) for label, same in groupby(items, key=lambda item: item[0])]
            for (label, bodies), place in zip(runs, level.places(tuple(label for label, _ in runs))):
                if place is None:
                    continue
                below = level.bodies[place]
                for body in bodies:
                    if label == "#":
                        found.update(dict.fromkeys(body, below))
                    else:
                        match(body, below)

        match(tree, self._top)
        return found


def _hash(text: str) -> str:
    return xxhash.xxh3_128_hexdigest(text.encode("utf-8", "surrogatepass"))


class Wrapper:
    """What is known of a host: its expression, the number of its pages, and of the plain ones among them.

    Plain pages are those with text, but with none below an article or main element.
    """

    def __init__(self, expression: Expression | None = None, pages: int = 0, plain: int = 0):
        self.expression = expression
        self.pages = pages
        self.plain = plain
        self._known: set[str] = set()

    @classmethod
    def read(cls, text: str) -> Wrapper:
        found = json.loads(text)
        return cls(found["expression"], found["pages"], found["plain"])

    def write(self) -> str:
        return json.dumps({"expression": self.expression, "pages": self.pages, "plain": self.plain})

    def add_page(self, page: str) -> None:
        """Learn the expression of a page."""
        blocks, expression = blocks_of(page)
        shape = _hash(json.dumps(expression))
        if shape not in self._known:
            if len(self._known) >= KNOWN_SHAPES:
                self._known.clear()
            self._join(expression)
            self._known.add(shape)
        self.pages += 1
        self.plain += is_plain(blocks)

    @property
    def slots(self) -> list[str]:
        """What each text slot of the expression is: main, open or never."""
        return Slots(self.expression).kinds

    def merge(self, other: Wrapper) -> None:
        if other.expression is not None:
            self._join(other.expression)
        self.pages += other.pages
        self.plain += other.plain

    def _join(self, expression: Expression) -> None:
        known = self.expression
        self.expression = expression if known is None else align(known, expression)


def texts_in_slots(page: str, slots: Slots) -> list[tuple[int, str, int, int]]:
    """(slot, hash of a text, words in it, how often it stands there) of a page if it is plain."""
    blocks, tree = blocks_of(page, folded=False)
    if not is_plain(blocks):
        return []
    found: dict[tuple[int, str], list[int]] = {}
    for number, slot in slots.of(tree).items():
        if slots.kinds[slot] == "open":
            text = blocks[number][1]
            found.setdefault((slot, _hash(text)), [text.count(" ") + 1, 0])[1] += 1
    return [(slot, text, words, times) for (slot, text), (words, times) in found.items()]


def is_plain(blocks: list[tuple[str, str]]) -> bool:
    return bool(blocks) and not any(below_main(path) for path, _ in blocks)


def below_main(path: str) -> bool:
    return "/-" not in path and not MAIN.isdisjoint(path.split("/"))


def may_be_main(path: str) -> bool:
    return "/-" not in path and "header" not in path.split("/")


def kind_of(path: str) -> str:
    return "main" if below_main(path) else "open" if may_be_main(path) else "never"


def main_text(page: str, slots: Slots | None = None, repeated: frozenset[tuple[int, str]] = frozenset()) -> str:
    """The blocks in main slots, else those in open ones that the host does not repeat there, a line each.

    A page that has nothing but repeated text is judged alone, as is one without ``slots``;
    a block that has no slot counts by the elements it lies below.
    """
    blocks, tree = blocks_of(page, folded=False)
    of = slots.of(tree) if slots else {}
    kinds = [slots.kinds[of[k]] if k in of else kind_of(path) for k, (path, _) in enumerate(blocks)]
    chosen = [text for kind, (_, text) in zip(kinds, blocks) if kind == "main"]
    if not chosen:
        outside = [(of.get(k), text) for k, (kind, (_, text)) in enumerate(zip(kinds, blocks)) if kind == "open"]
        own = [text for slot, text in outside if not repeated or (slot, _hash(text)) not in repeated]
        chosen = own or [text for _, text in outside]
    return "\n".join(chosen)


def _with_html(pages: DataFrame) -> DataFrame:
    host, _ = split_url(pages["url"])
    return columns(pages, host=host, html="html").filter("html IS NOT NULL")


def infer(pages: DataFrame) -> DataFrame:
    """host, wrapper (JSON) for every host of ``pages``, its expression inferred from all its pages with html.

    Map tasks merge the pages they read and hand on one wrapper per host, so a host with
    a third of all pages is merged by as many tasks as read it, then by ``SALTS`` tasks.
    """

    def partial(rows: Iterable[tuple]) -> Iterator[tuple]:
        salt, known = TaskContext.get().partitionId() % SALTS, {}
        for host, page in rows:
            if host not in known and len(known) >= HELD_HOSTS:
                yield from ((h.decode(), salt, w.write()) for h, w in known.items())
                known = {}
            known.setdefault(host, Wrapper()).add_page(page.decode("utf-8", "replace"))
        yield from ((h.decode(), salt, w.write()) for h, w in known.items())

    def merge(rows: Iterable[tuple]) -> Iterator[tuple]:
        for key, same in groupby(rows, key=lambda row: row[:-1]):
            wrapper = Wrapper()
            for row in same:
                wrapper.merge(Wrapper.read(row[-1].decode()))
            yield key[0].decode(), *key[1:], wrapper.write()

    parts = map_rows(_with_html(pages), partial, "host string, salt int, wrapper string", rows=100)
    salted = parts.repartition("host", "salt").sortWithinPartitions("host", "salt", "wrapper")
    parts = map_rows(salted, merge, "host string, salt int, wrapper string", rows=100)
    by_host = parts.select("host", "wrapper").repartition("host").sortWithinPartitions("host", "wrapper")
    return map_rows(by_host, merge, "host string, wrapper string", rows=100)


def repeated_texts(pages: DataFrame, expressions: DataFrame, scratch: Scratch) -> DataFrame:
    """host, repeated: the texts (slot, hash) that a host repeats in its open slots.

    Texts are counted per host, slot and hash by all tasks that read the host; what is left
    is no more than a few texts for each slot, as each stands on most of the plain pages.
    """
    crowded = expressions.filter(F.col("plain") >= LEAST_PAGES)
    rows = _with_html(pages).join(crowded, "host").select("host", "html", "expression")

    def texts(rows: Iterable[tuple]) -> Iterator[tuple]:
        known: dict[bytes, Slots] = {}
        for host, page, expression in rows:
            for found in texts_in_slots(page.decode("utf-8", "replace"), _slots(known, expression)):
                yield host.decode(), *found

    each = map_rows(rows, texts, "host string, slot bigint, text string, words bigint, times bigint", rows=5000)
    counted = each.groupBy("host", "slot", "text").agg(
        F.count(F.lit(1)).alias("pages"), F.max("words").alias("words"), F.sum("times").alias("times")
    )
    counts = scratch.land(counted, "counts")
    filled = counts.groupBy("host", "slot").agg(F.sum("times").alias("filled"))
    most = F.greatest(F.lit(LEAST_PAGES), F.col("plain") * LEAST_SHARE)
    often = counts.join(crowded.select("host", "plain"), "host").filter(F.col("pages") >= most)
    own = often.join(filled, ["host", "slot"]).filter((F.col("words") > 1) | (F.col("times") >= F.col("filled") * FILLS_SLOT))
    return own.groupBy("host").agg(F.to_json(F.collect_list(F.struct("slot", "text"))).alias("repeated"))


def _slots(known: dict[bytes, Slots], expression: bytes) -> Slots:
    if expression not in known:
        if len(known) >= HELD_HOSTS:
            known.clear()
        known[expression] = Slots(json.loads(expression))
    return known[expression]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages``.

    NULL or empty html gives empty text; pages without a host share one wrapper.  Texts are
    whole: white space within a block is one blank, blocks are joined by line feeds in
    page order.  Repeated rows are pages of their own; other columns are ignored; an empty
    table gives no rows.  Expressions and repeated texts are landed, one row per host; Spark
    broadcasts them if their files are small, else joins by host and splits a hot one.
    """

    def each(rows: Iterable[tuple]) -> Iterator[tuple]:
        for host, wrapper in rows:
            found = Wrapper.read(wrapper.decode())
            yield host.decode(), json.dumps(found.expression), found.plain

    scratch = Scratch(pages.sparkSession, "wrappers")
    schema = "host string, expression string, plain bigint"
    expressions = scratch.land(map_rows(infer(pages), each, schema, rows=100), "expressions")
    repeated = scratch.land(repeated_texts(pages, expressions, scratch), "repeated")
    scratch.drop("counts")
    host, _ = split_url(pages["url"])
    rows = columns(pages, page_id="page_id", url="url", html="html", host=host)
    rows = rows.join(expressions, "host", "left").join(repeated, "host", "left")

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        known: dict[bytes, Slots] = {}
        texts: dict[bytes, frozenset] = {}
        for page_id, url, page, expression, found in rows:
            slots = None if expression is None else _slots(known, expression)
            if found is not None and found not in texts:
                if len(texts) >= HELD_HOSTS:
                    texts.clear()
                texts[found] = frozenset((t["slot"], t["text"]) for t in json.loads(found))
            text = main_text((page or b"").decode("utf-8", "replace"), slots, texts.get(found, frozenset()))
            yield page_id, None if url is None else url.decode("utf-8", "replace"), text, len(text)

    schema = "page_id bigint, url string, text string, n_chars bigint"
    return map_rows(rows.select("page_id", "url", "html", "expression", "repeated"), run, schema, rows=500)
