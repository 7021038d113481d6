"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of a host."""
from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.words import ready
from tallywatch.session import settle

# Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea title svg math object select".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
               "main menu nav ol p pre section table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
          "thead": {"tbody", "thead", "tfoot"}, "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
OUTSIDE = set("nav footer aside form header head button dialog menu".split())
#: Words of class, id and role that mark what isn't main text.
MARKS = set("nav navbar navigation menu topbar header masthead banner footer sidebar aside complementary contentinfo breadcrumb breadcrumbs pagination pager "
            "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion notice cookie cookies consent gdpr alert popup modal "
            "dialog newsletter subscribe signup search form login social share sharing related recommended widget comment comments commentlist disqus respond replies".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


@dataclass
class Node:
    """An element with its text blocks (str) and child elements (Node) in page order."""
    label: str
    name: str
    parts: list = field(default_factory=list)

    def nodes(self) -> list[Node]:
        return [p for p in self.parts if not isinstance(p, str)]


def _marked(name: str, marks: str) -> bool:
    return name in OUTSIDE or any(w in MARKS for w in re.split(r"[^a-z]+", marks))


def parse(page: str) -> Node:
    """The page's repaired token stream as a tree: omitted end tags are supplied, inline elements melt into their block's text."""
    root = Node("root", "root")
    stack, pending = [root], []
    at, n = 0, len(page)

    def flush() -> None:
        if pending:
            text = " ".join(entities.unescape("".join(pending)).split())
            pending.clear()
            if text:
                stack[-1].parts.append(text)

    while at < n:
        next_tag = page.find("<", at)
        if next_tag < 0:
            pending.append(page[at:])
            break
        if next_tag > at:
            pending.append(page[at:next_tag])
        token = TOKEN.match(page, next_tag)
        if not token:
            pending.append("<")
            at = next_tag + 1
            continue
        at = token.end()
        name = (token[2] or "").lower()
        if not name or not token[4]:
            continue
        attributes = token[3]
        if token[1]:
            if name in INLINE and not any(x.name == name for x in stack):
                continue
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if depth:
                flush()
                del stack[depth:]
            elif name in CLOSES_P:
                flush()
            continue
        if name == "br":
            pending.append(" ")
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            at = n if not close else max(page.find(">", close.start()) + 1, close.end())
            if name not in ("script", "style"):
                pending.append(" ")
            continue
        marks = " ".join(next(filter(None, a[1:]), "") for a in ATTRIBUTE.findall(attributes)).lower() if "=" in attributes else ""
        if name in INLINE and not (marks and _marked(name, marks)):
            continue
        flush()
        if name in CLOSES_P:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == "p"), 0)
            if depth:
                del stack[depth:]
        elif name in CLOSES:
            while len(stack) > 1 and stack[-1].name in CLOSES[name] | {"p"}:
                stack.pop()
        node = Node(f"{name}.{re.sub(r'[0-9]+', '0', marks)}" if marks else name, name)
        stack[-1].parts.append(node)
        stack.append(node)
    flush()
    return root


# A wrapper item is [labels, many, optional, seen, text, chars, items]. labels: one label, or those of a repeated group; text: None, a
# text that was the same wherever seen, or True for a slot; items: the regular expression of what lies inside (for a group: of a round).
LABELS, MANY, OPTIONAL, SEEN, TEXT, CHARS, ITEMS = range(7)


def _flat(step):
    """Runs a recursive function written as a generator (`yield` of a generator is the call) on a stack of its own, so that pages may
    nest as deep as they like."""
    stack, value = [step], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as end:
            stack.pop()
            value = end.value
    return value


def shape(node: Node) -> list:
    """The wrapper of one page's element."""
    return _flat(_shape(node))


def combine(a: list, b: list) -> list:
    """One item for two aligned ones: texts that differ become a slot."""
    return _flat(_combine(a, b))


def _shape(node: Node):
    texts = [p for p in node.parts if isinstance(p, str)]
    text = " ".join(texts) if texts else None
    inner = []
    for x in node.nodes():
        inner.append((yield _shape(x)))
    return [[node.label], False, False, 1, text if text is None or len(text) <= 80 else True, sum(map(len, texts)), (yield _squares(inner))]


def _squares(items: list):
    """Repeats next to each other become one repeated item (x x -> x+) or group (x y x y -> (x y)+)."""
    for period in (1, 2, 3):
        out: list = []
        i = 0
        while i < len(items):
            run = items[i:i + period]
            names = [x[LABELS] for x in run]
            rounds = 1
            while len(run) == period and [x[LABELS] for x in items[i + rounds * period:i + (rounds + 1) * period]] == names:
                rounds += 1
            if rounds == 1:
                out.append(items[i])
                i += 1
                continue
            if period == 1:
                merged = items[i]
                for x in items[i + 1:i + rounds]:
                    merged = yield _combine(merged, x)
                merged[MANY], merged[SEEN] = True, 1
                out.append(merged)
            else:
                inner = run
                for r in range(1, rounds):
                    inner = yield _align(inner, items[i + r * period:i + (r + 1) * period])
                out.append([[n for names_ in names for n in names_], True, False, 1, None, 0, inner])
            i += rounds * period
        items = out
    return items


def same(a: list, b: list) -> bool:
    try:
        return a == b
    except RecursionError:
        todo = [(a, b)]
        while todo:
            for x, y in zip(*(pair := todo.pop())):
                if x[:ITEMS] != y[:ITEMS] or len(x[ITEMS]) != len(y[ITEMS]):
                    return False
                todo.append((x[ITEMS], y[ITEMS]))
            if len(pair[0]) != len(pair[1]):
                return False
        return True


def _combine(a: list, b: list):
    text = a[TEXT] if a[TEXT] == b[TEXT] else True
    items = a[ITEMS] if same(a[ITEMS], b[ITEMS]) else (yield _align(a[ITEMS], b[ITEMS]))
    return [a[LABELS], a[MANY] or b[MANY], a[OPTIONAL] or b[OPTIONAL], a[SEEN] + b[SEEN], text, a[CHARS] + b[CHARS], items]


def grouped(items: list, groups: list) -> list:
    """Wraps a run that is one round of a group known from the other side."""
    for g in groups:
        k, out, i = len(g[ITEMS]), [], 0
        while i < len(items):
            if len(items[i][LABELS]) == 1 and [n for x in items[i:i + k] for n in x[LABELS]] == g[LABELS]:
                out.append([g[LABELS], True, False, items[i][SEEN], None, 0, items[i:i + k]])
                i += k
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def _align(a: list, b: list):
    """Longest common subsequence of both sides' labels; what stands on one side only becomes optional."""
    a, b = grouped(a, [x for x in b if len(x[LABELS]) > 1]), grouped(b, [x for x in a if len(x[LABELS]) > 1])
    if [x[LABELS] for x in a] == [x[LABELS] for x in b]:
        both = []
        for x, y in zip(a, b):
            both.append((yield _combine(x, y)))
        return both
    out = []
    for x, y in matched(a, b):
        if x is not None and y is not None:
            out.append((yield _combine(x, y)))
        else:
            lone = list(x if x is not None else y)
            lone[OPTIONAL] = True
            out.append(lone)
    # Optional items may now stand beside their like.
    merged: list = []
    for x in out:
        if merged and merged[-1][LABELS] == x[LABELS]:
            merged[-1] = yield _combine(merged[-1], x)
            merged[-1][MANY] = True
        else:
            merged.append(x)
    return merged


def matched(a: list, b: list) -> list[tuple]:
    rows, columns = len(a), len(b)
    best = [[0] * (columns + 1) for _ in range(rows + 1)]
    for i in reversed(range(rows)):
        for j in reversed(range(columns)):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][LABELS] == b[j][LABELS] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < rows or j < columns:
        if i < rows and j < columns and a[i][LABELS] == b[j][LABELS]:
            out.append((a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == columns or i < rows and best[i + 1][j] >= best[i][j + 1]:
            out.append((a[i], None))
            i += 1
        else:
            out.append((None, b[j]))
            j += 1
    return out


def dump(wrapper: list) -> str:
    """JSON of the items in page order, each with the number of items in it: flat, however deep the wrapper."""
    out, todo = [], [wrapper]
    while todo:
        x = todo.pop()
        out.append([*x[:ITEMS], len(x[ITEMS])])
        todo += reversed(x[ITEMS])
    return json.dumps(out)


def load(text: str) -> list:
    done: list = []
    for *x, n in reversed(json.loads(text)):
        x.append([done.pop() for _ in range(n)])
        done.append(x)
    return done[0]


def _outside(label: str, inner: list | None, in_article: bool) -> bool:
    name, _, marks = label.partition(".")
    if name in ("article", "main", "body", "html", "root"):
        return False
    if in_article and (name == "header" or "header" in marks) and inner is not None and any("h1" in x[LABELS] for x in inner):
        return False
    return _marked(name, marks)


def choose(wrapper: list) -> tuple[list[list], list[list], list[list], set[str]]:
    """Items whose text may be main text: articles, main elements, the innermost item that holds most of the varying text. And the
    texts that are the same on all pages."""
    def find(kind: str) -> list[list]:
        found, todo = [], wrapper[ITEMS][::-1]
        while todo:
            x = todo.pop()
            label = x[LABELS][0] if len(x[LABELS]) == 1 else "group"
            name, _, marks = label.partition(".")
            if name == kind or kind == "main" and re.search(r"\bmain\b", marks) and name in ("div", "section"):
                found.append(x)
            elif not _outside(label, x[ITEMS], False):
                todo += reversed(x[ITEMS])
        return found

    mass: dict[int, int] = {}

    def weigh(item: list):
        total = item[CHARS] if item[TEXT] is True or item[SEEN] < 3 else 0
        for x in item[ITEMS]:
            if not _outside(x[LABELS][0], x[ITEMS], False):
                total += yield weigh(x)
        mass[id(item)] = total
        return total

    item, whole = wrapper, _flat(weigh(wrapper))
    fixed, todo = set(), [wrapper]
    while todo:
        x = todo.pop()
        if isinstance(x[TEXT], str) and x[SEEN] >= 3:
            fixed.add(x[TEXT])
        todo += x[ITEMS]
    while True:
        inner = [(mass[id(x)], i) for i, x in enumerate(item[ITEMS]) if not _outside(x[LABELS][0], x[ITEMS], False)]
        heavy = max(inner, default=(0, 0))
        if not inner or heavy[0] * 10 < whole * 8 or item[ITEMS][heavy[1]][MANY]:
            return find("article"), find("main"), [item], fixed
        item = item[ITEMS][heavy[1]]


def extract(root: Node, wrapper: list, kinds: tuple[list[list], list[list], list[list], set[str]]) -> str:
    """The page's main text, by the first kind of places that holds text on this page: articles, unless they hold less than half of
    what varies in the wider place (teasers), main elements, the heaviest item; else all that is not left out by element or class."""
    *places, fixed = kinds
    weigh = lambda blocks: sum(len(b) for b in blocks if b not in fixed)
    articles, mains, heavy = (aligned(root, wrapper, x) if x else [] for x in places)
    wider = mains or heavy
    if articles and weigh(articles) * 2 >= weigh(wider):
        return "\n".join(articles)
    return "\n".join(wider or articles or aligned(root, wrapper, [wrapper]))


def aligned(root: Node, wrapper: list, main: list[list]) -> list[str]:
    """Blocks of the page's elements that align with the wrapper's main items, or lie inside one."""
    blocks: list[str] = []
    chosen = {id(x) for x in main}

    def emit(node: Node) -> None:
        todo = [node]
        while todo:
            part = todo.pop()
            if isinstance(part, str):
                blocks.append(part)
            elif part is node or not _outside(part.label, [[[x.label]] for x in part.nodes()], True):
                todo += reversed(part.parts)

    todo = [(root, wrapper)]
    while todo:
        node, item = todo.pop()
        if id(item) in chosen:
            emit(node)
            continue
        found, cursor, by_place = [], 0, list(enumerate(item[ITEMS]))
        for child in node.nodes():
            hit = next(((i, x) for i, x in by_place[cursor:] + by_place[:cursor] if child.label in x[LABELS]), None)
            if hit:
                i, x = hit
                cursor = i if x[MANY] else i + 1
                if len(x[LABELS]) > 1 and id(x) not in chosen:
                    # A group's elements align with its own items.
                    x = next(y for y in x[ITEMS] if child.label in y[LABELS])
                found.append((child, x))
        todo += reversed(found)
    return blocks


def host_of(url: str = "url"):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[^/?#]*?://([^/?#]*)", 1)), F.lit(""))


HOSTS_HELD = 2000


def infer(pages: DataFrame) -> DataFrame:
    """host, wrapper (JSON), pages: one wrapper per host, from all its pages.

    Each task folds its pages of a host into one wrapper; these are folded in up to 32 groups per host, then per host. So a hot
    host's pages never meet in one task, only wrappers do, whose size follows the template. Wrappers are folded in the order of
    their text, so that a task run again gives the same result.
    """
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([dump(w) for w in held.values()], pa.string())], ["host", "wrapper"])
            held.clear()
            return batch

        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html")):
                own = shape(parse(page.as_py() or ""))
                held[host] = combine(held[host], own) if host in held else own
                if len(held) > HOSTS_HELD:
                    yield out()
        if held:
            yield out()

    def merge(table: pa.Table) -> pa.Table:
        wrapper = None
        for text in sorted(table["wrapper"].to_pylist()):
            wrapper = combine(wrapper, load(text)) if wrapper else load(text)
        return pa.table([pa.array([table["host"][0].as_py()]), pa.array([dump(wrapper)])], ["host", "wrapper"])

    folded = pages.select(host_of().alias("host"), "html").mapInArrow(fold, "host string, wrapper string")
    salted = folded.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(32)))
    some = salted.groupBy("host", "salt").applyInArrow(merge, "host string, wrapper string")
    return some.groupBy("host").applyInArrow(merge, "host string, wrapper string")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text: the main text of every page.

    Method: for every host a union-free regular expression is inferred by aligning its pages' token streams: elements on one side
    only become optional, adjacent repeats become repeated items or groups, texts that differ become slots. The wrapper tells
    where main text may lie (articles, main elements, the innermost item with most of the varying text); each page's elements are
    aligned with it, and the page's text is that of the first kind that it has, teaser articles aside. Menus, headers, footers, sidebars, notices, adverts, forms and comments are left out
    by element and class. Within a block white space becomes one space; blocks are joined by a line feed.

    Null or empty html: empty text. Null url or no ://: the pages of that kind share a wrapper. Repeated rows: each is extracted.
    Truncated pages: what is there. Empty table: no rows. Other columns are not looked at.
    """
    ready(pages.sparkSession)
    # Settled wrappers are small files whose size the planner knows: it broadcasts them or, beyond its threshold, joins by host,
    # where a hot host's pages are split (AQE).
    wrappers = settle(infer(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in batches:
            out = []
            for page, text in zip(batch.column("html"), batch.column("wrapper").to_pylist()):
                if text not in known:
                    if len(known) > HOSTS_HELD:
                        known.clear()
                    wrapper = load(text)
                    known[text] = (wrapper, choose(wrapper))
                out.append(extract(parse(page.as_py() or ""), *known[text]))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of().alias("host")).join(wrappers, "host")
    return rows.select("page_id", "url", "html", "wrapper").mapInArrow(run, "page_id long, url string, text string")
