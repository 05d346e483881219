"""Main texts of web pages, by wrappers inferred from all pages of their host.

A wrapper is a union-free regular expression over the tokens that a host's pages have in
common: block elements, literal texts, optional groups ``(...)?``, repeated groups
``(...)+`` and text slots ``#``. It is inferred by aligning the pages' token streams one
after the other. Where they differ,

* another text makes a literal a slot,
* another number of equal neighbours makes them a repeated group,
* an element of some pages only becomes optional,
* elements that come again and again in other numbers become a repeated group of optional
  ones, as in ``(<h2>#</h2>? <p>#</p>?)+``,
* more than ``MOST_CLASSES`` classes of sibling elements of one name, as in ``post-812``,
  make the class of the rarer ones a slot: ``<div.#>``.

Alignment merges two wrappers into one of bounded size, so tasks align their own pages
first and send one wrapper per host; these are aligned in a tree over the tasks, so that
a host with a third of all pages is no large group anywhere. Every slot counts its pages,
characters and characters in links, and every literal the smallest digests of its distinct
pages: of the digests that are smallest on the whole host, the share that a literal has
estimates its share of the host's distinct pages, exactly so up to ``SKETCH`` of them.

From the wrapper follows what is the article: elements that are no content by their name,
class, id or role are left out; then the article or main element with the most text, or
without one the element below which most of the text is; less what is the same on nearly
all distinct pages of the host, of which there must be ``SAME_ON``, within a marked article
``SAME_ON_MARKED``: copies of a page count once. The page is aligned with its host's wrapper once more, and the texts of its blocks
are read; where that leaves nothing, the page is read by its own wrapper.

The tree of a page has at most ``DEEPEST`` levels. Elements that are open below that are
kept, but stand in the order of their texts beside each other in the innermost element
above, as many pieces as others interrupt them, and are no content if an element around
them is not. Articles there hold what is in them, up to ``DEEPEST_ARTICLES`` in each other.

A wrapper's size is bounded by its depth and the names, marks and classes that siblings can
have, whatever the number of pages. A null page has the text ''. A null or unreadable url is
the host ''. Repeated rows are extracted each, a host with one page by its own wrapper; of
articles with equally much text the first is taken. An empty table gives no rows. Pages of
any length are read whole.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clicktide.llm.common import few_rows_a_batch, small_batches, written

FAN_IN = 64  # wrappers that one task aligns
HOSTS_HELD = 2000  # of one task before it sends their wrappers
LITERAL_CHARS = 80
SAME_ON = 3  # distinct pages from which on an unchanged text can be the template's
SAME_ON_MARKED = 10  # the same within an element that the page itself marks as the article
MOST_CLASSES = 8  # of sibling elements of one name, before the rarer ones become a slot
NEARLY_ALL = 0.9  # of the host's distinct pages that a text of the template stands on
SKETCH = 32  # digests of pages that stand for all
DEEPEST = 64  # levels of the tree; what is deeper stands beside, not inside, its parent
DEEPEST_ARTICLES = 16  # more levels, of articles only
SHARE = 0.6  # of an element's text that a child must have to be looked into

# Element names of HTML and the usual names of page parts.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
NO_CONTENT = frozenset("head nav footer aside form dialog menu button select option label title".split())
PARTS = frozenset(
    "ad ads adv advert advertisement adverts advertising adbox adslot banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay toast menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar aside widget widgets footer toolbar share sharing social "
    "related recommended recommendations comment comments commentlist replies disqus respond newsletter subscribe "
    "subscription signup login search form pagination pager skip".split()
)
HEADERS = frozenset({"header", "masthead", "topbar"})  # content in an article only
NOT_A_PART = frozenset({"has", "with", "without", "no"})  # as in has-sidebar
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"},
}
SCOPES = frozenset("table ul ol dl body article section div td main html".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>?"
    r"|[^<]+|<",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.S)
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)")

Page = list  # [label, children, chars in links] of an element, [None, text, chars in links] of a text
# [label, repeated, optional, pages, chars, link chars, children or literal or None, seen]: seen are digests of the
# pages of a literal or a whole page, and once the host is complete, 1 for a text of the template, 2 for one that is so
# in marked articles too, else 0
Wrapper = list
GROUP, TEXT, SLOT = "()", "#", ".#"
LABEL, REPEATED, OPTIONAL, PAGES, CHARS, LINKS, INSIDE, SEEN = range(8)


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


# Pages


def _label(name: str, attributes: str) -> str:
    """The element's name and class, after ``!`` if its attributes say that it is no content,
    or ``~`` if they say that it is a header."""
    if not attributes.strip():
        return name
    classes, is_main, words, hidden = "", "", set(), False
    for key, a, b, c, bare in _ATTRIBUTE.findall(attributes):
        value = a or b or c
        key = key.lower()
        if bare or key == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
        elif key in ("class", "id"):
            words.update(w.lower() for w in _NAME_WORDS.findall(value))
            if key == "class":
                classes = "." + " ".join(sorted(set(value.split())))
        elif key == "role":
            hidden |= value.lower() in ROLES
            is_main = "@main" if value.lower() == "main" else ""
    kept = is_main + classes
    if name in ("html", "body", "article", "main"):
        return name + kept
    named = words if not words & NOT_A_PART else frozenset()
    mark = "!" if hidden or named & PARTS else "~" if named & HEADERS else ""
    return mark + name + kept


def _name(label: str) -> str:
    return re.split(r"[.@]", label.lstrip("!~"), maxsplit=1)[0]


def _base(label: str) -> str:
    """The label without its class."""
    return label.split(".", 1)[0]


def _below(label: str, outer: str) -> str:
    """The label of an element that stands beside, not inside, the one with the outer label."""
    if outer.startswith("!") or _name(outer) in NO_CONTENT:
        return "!" + label.lstrip("!~")
    if (outer.startswith("~") or _name(outer) == "header") and not label.startswith("!"):
        return "~" + label.lstrip("~")
    return label


def parse(html: str) -> Page:
    """The block elements of a page and the texts between them; inline elements leave their text."""
    root: Page = ["html", [], 0]
    # the open elements: where their texts go, their names, and the element that what they hold is put in, with its level
    stack, names, holders = [root], ["html"], [(root, 1)]
    opened: Counter[str] = Counter()
    text: list[str] = []
    in_link = linked = 0
    at, tokens = 0, _TOKEN.scanner(html)

    def flush() -> None:
        nonlocal linked
        if text:
            if joined := " ".join("".join(text).split()):
                element, beside = stack[-1], holders[-1][0][1]
                if element is not holders[-1][0] and beside[-1] is not element:  # goes on after another one
                    element = stack[-1] = [element[0], [], 0]
                    beside.append(element)
                element[1].append([None, joined, min(linked, len(joined))])
            text.clear()
        linked = 0

    def close(first: int) -> None:
        opened.subtract(names[first:])
        del stack[first:], names[first:], holders[first:]

    while (token := tokens.match()) is not None:
        at = token.end()
        name = token[2] or token[5]
        if name is None:
            piece = token[0]
            if piece[0] != "<" or piece == "<":
                piece = unescape(piece)
                text.append(piece)
                if in_link:
                    linked += len(piece)
            continue
        name, closing = name.lower(), bool(token[1] or token[4])
        if name == "a":
            in_link = 0 if closing else 1
        elif name == "br":
            text.append(" ")
        elif name in RAW and not closing:
            if not (token[3] or token[6] or "").rstrip().endswith("/") or name not in ("svg", "math"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
                tokens = _TOKEN.scanner(html, end.end() if end else len(html))
        elif name in BLOCKS:
            flush()
            in_link = 0
            if closing:
                if opened[name]:
                    close(next(k for k in range(len(names) - 1, 0, -1) if names[k] == name))
                continue
            if name in ("html", "body"):
                if name == "html" or opened["body"]:
                    continue
            if opened["p"]:  # a block ends an open paragraph
                for k in range(len(names) - 1, 0, -1):
                    if names[k] == "p":
                        close(k)
                        break
                    if names[k] in SCOPES:
                        break
            if ends := CLOSED_BY.get(name):
                for k in range(len(names) - 1, 0, -1):
                    if not any(opened[end] for end in ends):
                        break
                    if names[k] in ends:
                        close(k)
                    elif names[k] in SCOPES:
                        break
            element: Page = [_label(name, token[3] or token[6] or ""), [], 0]
            holder, level = holders[-1]
            if stack[-1] is not holder:
                element[0] = _below(element[0], stack[-1][0])
            holder[1].append(element)
            if name not in VOID:
                holds = level < DEEPEST or _is_article(element) and level < DEEPEST + DEEPEST_ARTICLES
                stack.append(element)
                names.append(name)
                opened[name] += 1
                holders.append((element, level + 1) if holds else (holder, level))
    flush()
    return root


# Wrappers


def wrapper_of(page: Page) -> Wrapper:
    seen = [int.from_bytes(blake2b(json.dumps(page).encode(), digest_size=6).digest(), "big")]
    return [*_wrapper_of(page, seen)[:SEEN], seen]


def _wrapper_of(page: Page, seen: list[int]) -> Wrapper:
    label, inside, links = page
    if label is None:
        literal = inside if len(inside) <= LITERAL_CHARS else blake2b(inside.encode(), digest_size=8).hexdigest()
        return [TEXT, 0, 0, 1, len(inside), links, literal, seen]
    children = [_wrapper_of(child, seen) for child in inside]
    return [label, 0, 0, 1, sum(c[CHARS] for c in children), sum(c[LINKS] for c in children), children, None]


def _seen(a: list[int] | None, b: list[int] | None) -> list[int] | None:
    """The smallest digests of both."""
    if a is None or b is None or a == b:
        return a
    return sorted({*a, *b})[:SKETCH]


def _runs(nodes: list[Wrapper]) -> list[list[Wrapper]]:
    runs: list[list[Wrapper]] = []
    for node in nodes:
        if runs and runs[-1][0][LABEL] == node[LABEL]:
            runs[-1].append(node)
        else:
            runs.append([node])
    return runs


def _merged(a: Wrapper, b: Wrapper) -> Wrapper:
    if a[LABEL] == TEXT:
        inside = a[INSIDE] if a[INSIDE] == b[INSIDE] else None
    else:
        inside = aligned(a[INSIDE], b[INSIDE], a[PAGES], b[PAGES])
    return [
        a[LABEL], a[REPEATED] | b[REPEATED], a[OPTIONAL] | b[OPTIONAL], a[PAGES] + b[PAGES],
        a[CHARS] + b[CHARS], a[LINKS] + b[LINKS], inside, None if inside is None else _seen(a[SEEN], b[SEEN]),
    ]


def _repeated(nodes: list[Wrapper], pages: int) -> Wrapper:
    one = nodes[0]
    for other in nodes[1:]:
        one = _merged(one, other)
    return [one[LABEL], 1, min(n[OPTIONAL] for n in nodes), pages, *one[CHARS:]]


def _grouped(nodes: list[Wrapper]) -> Wrapper:
    """(a? b? ...)+ of the distinct labels among the nodes and in their groups."""
    members: dict[str, list[Wrapper]] = {}
    for node in nodes:
        for part in node[INSIDE] if node[LABEL] == GROUP else [node]:
            members.setdefault(part[LABEL], []).append(part)
    inside = []
    for same in members.values():
        one = _repeated(same, max(n[PAGES] for n in same))
        one[OPTIONAL] = 1
        inside.append(one)
    pages = max(n[PAGES] for n in nodes)
    return [GROUP, 1, 0, pages, sum(n[CHARS] for n in nodes), sum(n[LINKS] for n in nodes), inside, None]


def _labels_of(node: Wrapper) -> set[str]:
    return {n[LABEL] for n in node[INSIDE]} if node[LABEL] == GROUP else {node[LABEL]}


def _folded(nodes: list[Wrapper], labels: set[str]) -> list[Wrapper]:
    """The nodes from the first to the last of these labels as one group."""
    places = [i for i, node in enumerate(nodes) if _labels_of(node) & labels]
    if not places:
        return nodes
    first, last = places[0], places[-1]
    return [*nodes[:first], _grouped(nodes[first : last + 1]), *nodes[last + 1 :]]


def _classes_by_name(nodes: list[Wrapper]) -> dict[str, dict[str, int]]:
    """Of each label without class the labels that it has here, with their pages."""
    found: dict[str, dict[str, int]] = {}
    for node in nodes:
        for part in node[INSIDE] if node[LABEL] == GROUP else [node]:
            labels = found.setdefault(_base(part[LABEL]), {})
            labels[part[LABEL]] = labels.get(part[LABEL], 0) + part[PAGES]
    return found


def _strays(a: list[Wrapper], b: list[Wrapper]) -> set[str]:
    """Labels whose class is to become a slot, as their name has too many classes here."""
    in_a, in_b = _classes_by_name(a), _classes_by_name(b)
    strays: set[str] = set()
    for base in in_a.keys() | in_b.keys():
        of_a, of_b, slot = in_a.get(base, {}), in_b.get(base, {}), base + SLOT
        if slot in of_a or slot in of_b:
            strays |= (of_a.keys() ^ of_b.keys()) - {slot}
        elif len(of_a.keys() | of_b.keys()) > MOST_CLASSES:
            pages = Counter(of_a) + Counter(of_b)
            strays |= set(sorted(pages, key=lambda label: (-pages[label], label))[MOST_CLASSES // 2 :])
    return strays


def _with_slots(nodes: list[Wrapper], strays: set[str], pages: int) -> list[Wrapper]:
    """The nodes of so many pages with slots for these classes. Neighbours that become alike and
    are on no more pages than there are stand for each other, and are one."""
    result: list[Wrapper] = []
    for node in nodes:
        if node[LABEL] in strays:
            node = [_base(node[LABEL]) + SLOT, *node[REPEATED:]]
        elif node[LABEL] == GROUP and strays & _labels_of(node):
            group = _grouped([[*node[:INSIDE], _with_slots(node[INSIDE], strays, 0), None]])
            node = [*node[:INSIDE], group[INSIDE], None]
        before = result[-1] if result else None
        if before and before[LABEL] == node[LABEL] and node[LABEL].endswith(SLOT):
            if not before[REPEATED] and not node[REPEATED] and before[PAGES] + node[PAGES] <= pages:
                one = _merged(before, node)
                one[OPTIONAL] = int(one[PAGES] < pages)
                result[-1] = one
                continue
        result.append(node)
    return result


def aligned(a: list[Wrapper], b: list[Wrapper], pages_a: int, pages_b: int) -> list[Wrapper]:
    """One list of wrappers for what both lists, of so many pages, match."""
    if strays := _strays(a, b):
        a, b = _with_slots(a, strays, pages_a), _with_slots(b, strays, pages_b)
    in_groups = set().union(*(_labels_of(n) for n in (*a, *b) if n[LABEL] == GROUP))
    while in_groups:  # what one page has in a group, the other's nodes belong to
        a, b = _folded(a, in_groups), _folded(b, in_groups)
        grown = set().union(*(_labels_of(n) for n in (*a, *b) if n[LABEL] == GROUP))
        if grown == in_groups:
            break
        in_groups = grown
    runs_a, runs_b = _runs(a), _runs(b)
    labels_a, labels_b = [r[0][LABEL] for r in runs_a], [r[0][LABEL] for r in runs_b]
    if labels_a != labels_b:
        often = {x for labels in (labels_a, labels_b) for x in labels if labels.count(x) > 1}
        if often:
            return aligned(_folded(a, often), _folded(b, often), pages_a, pages_b)
    result: list[Wrapper] = []
    steps = [("equal", 0, len(labels_a), 0, len(labels_b))]
    if labels_a != labels_b:
        steps = SequenceMatcher(None, labels_a, labels_b, autojunk=False).get_opcodes()
    for step, a0, a1, b0, b1 in steps:
        if step != "equal":
            for run in (*runs_a[a0:a1], *runs_b[b0:b1]):
                result += [[*node[:OPTIONAL], 1, *node[PAGES:]] for node in run]
            continue
        for left, right in zip(runs_a[a0:a1], runs_b[b0:b1], strict=True):
            if left[0][LABEL] == GROUP:
                result.append(_grouped([*left, *right]))
                result[-1][PAGES] = left[0][PAGES] + right[0][PAGES]
            elif len(left) == len(right) and not any(n[REPEATED] for n in (*left, *right)):
                result += map(_merged, left, right)
            else:
                pages = max(n[PAGES] for n in left) + max(n[PAGES] for n in right)
                result.append(_repeated([*left, *right], pages))
    return result


def align(a: Wrapper | None, b: Wrapper) -> Wrapper:
    return b if a is None else _merged(a, b)


def finished(host: Wrapper) -> Wrapper:
    """The wrapper of a whole host, its texts marked as the template's or not."""
    pages = frozenset(host[SEEN])

    def judged(wrapper: Wrapper) -> Wrapper:
        *rest, inside, seen = wrapper
        if wrapper[LABEL] != TEXT:
            return [*rest, [judged(child) for child in inside], None]
        if inside is None or len(pages.intersection(seen)) < NEARLY_ALL * len(pages):
            return [*rest, inside, 0]
        return [*rest, inside, (len(seen) >= SAME_ON) + (len(seen) >= SAME_ON_MARKED)]

    return judged(host)


def expression(wrapper: Wrapper) -> str:
    """The wrapper as a regular expression."""
    label, inside = wrapper[LABEL], wrapper[INSIDE]
    if label == TEXT:
        text = TEXT if inside is None else inside
    elif label == GROUP:
        text = " ".join(map(expression, inside))
    else:
        text = f"<{label}>{''.join(map(expression, inside))}</{_name(label)}>"
    mark = "+" * wrapper[REPEATED] + "?" * wrapper[OPTIONAL]
    return f"({text}){mark}" if mark else text


# What is the article


def _content(wrapper: Wrapper, in_article: bool) -> bool:
    label = wrapper[LABEL]
    if label.startswith("!") or _name(label) in NO_CONTENT:
        return False
    return in_article or not (label.startswith("~") or _name(label) == "header")


def _of_template(wrapper: Wrapper, marked: bool) -> bool:
    """Whether a text of a finished wrapper belongs to the template."""
    return isinstance(wrapper[SEEN], int) and wrapper[SEEN] >= (2 if marked else 1)


def _mass(wrapper: Wrapper, in_article: bool = False) -> int:
    """Characters of content outside links, without texts of the template."""
    if wrapper[LABEL] == TEXT:
        if _of_template(wrapper, False):
            return 0
        return max(0, wrapper[CHARS] - 2 * wrapper[LINKS])
    if not _content(wrapper, in_article):
        return 0
    inside = in_article or _is_article(wrapper)
    return sum(_mass(child, inside) for child in wrapper[INSIDE])


def _is_article(wrapper: Wrapper) -> bool:
    return _name(wrapper[LABEL]) in ("article", "main") or "@main" in wrapper[LABEL]


def _articles(wrapper: Wrapper) -> Iterator[Wrapper]:
    if wrapper[LABEL] == TEXT or not _content(wrapper, False):
        return
    if _is_article(wrapper):
        within = [x for child in wrapper[INSIDE] if child[LABEL] != TEXT for x in _articles(child)]
        whole = _mass(wrapper, True)
        best = max(within, key=lambda x: _mass(x, True), default=None)
        yield best if best is not None and _mass(best, True) >= SHARE * whole else wrapper
        return
    for child in wrapper[INSIDE]:
        if child[LABEL] != TEXT:
            yield from _articles(child)


def article_of(wrapper: Wrapper) -> tuple[Wrapper, bool]:
    """The node that holds the article, and whether it is marked as such."""
    marked = max(_articles(wrapper), key=lambda x: _mass(x, True), default=None)
    if marked is not None and marked[CHARS]:
        return marked, True
    node = wrapper
    while True:
        whole = _mass(node)
        best = max((c for c in node[INSIDE] if c[LABEL] != TEXT), key=_mass, default=None)
        if best is None or _mass(best) < SHARE * whole or not whole or best[REPEATED]:
            return node, False
        node = best


def _paired(children: list[Page], wrappers: list[Wrapper]) -> Iterator[tuple[Page, Wrapper | None]]:
    """Each child of a page's element with the wrapper that stands for it."""
    flat: list[Wrapper] = []
    group_of: dict[str, Wrapper] = {}
    for w in wrappers:
        if w[LABEL] == GROUP:
            group_of.update({x[LABEL]: x for x in w[INSIDE]})
        else:
            flat.append(w)
    of = {}
    known = {w[LABEL] for w in flat} | group_of.keys()
    named = [c[0] or TEXT for c in children]
    named = [x if x in known or _base(x) + SLOT not in known else _base(x) + SLOT for x in named]
    page_runs: list[list[int]] = []
    for i, label in enumerate(named):
        if label in group_of:
            continue
        if page_runs and named[page_runs[-1][0]] == label and page_runs[-1][-1] == i - 1:
            page_runs[-1].append(i)
        else:
            page_runs.append([i])
    runs = _runs(flat)
    labels = [named[r[0]] for r in page_runs]
    expected = [r[0][LABEL] for r in runs]
    blocks = [(0, 0, len(labels))]
    if labels != expected:
        blocks = SequenceMatcher(None, labels, expected, autojunk=False).get_matching_blocks()
    for a, b, size in blocks:
        for k in range(size):
            nodes = runs[b + k]
            for nth, i in enumerate(page_runs[a + k]):
                of[i] = nodes[min(nth, len(nodes) - 1)]
    for i, child in enumerate(children):
        yield child, of.get(i, group_of.get(named[i]))


def _texts(page: Page, wrapper: Wrapper | None, in_article: bool, marked: bool) -> Iterator[str]:
    label, inside, _ = page
    if label is None:
        if wrapper is None or not _of_template(wrapper, marked):
            yield inside
        return
    if not _content([label], in_article):
        return
    for child, of in _paired(inside, wrapper[INSIDE] if wrapper else []):
        yield from _texts(child, of, in_article, marked)


def _found(page: Page, wrapper: Wrapper, article: Wrapper) -> Iterator[tuple[Page, Wrapper]]:
    """The page's elements that stand at the article's place."""
    if wrapper is article:
        yield page, wrapper
        return
    for child, of in _paired(page[1], wrapper[INSIDE]):
        if of is not None and child[0] is not None:
            yield from _found(child, of, article)


def extract(page: Page, wrapper: Wrapper) -> str:
    article, marked = article_of(wrapper)
    places = list(_found(page, wrapper, article))
    texts = [t for place, of in places for t in _texts(place, of, marked, marked)]
    if not texts:  # nothing there but the template: judge the page by itself
        own = wrapper_of(page)
        article, marked = article_of(own)
        texts = [t for place, of in _found(page, own, article) for t in _texts(place, of, marked, marked)]
    return "\n\n".join(texts)


# Tables of pages


_SENT = pa.schema([("host", pa.string()), ("place", pa.int64()), ("wrapper", pa.string())])


def _sent(wrappers: dict[str, Wrapper], place: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(wrappers), pa.string()),
            pa.array([place] * len(wrappers), pa.int64()),
            pa.array([json.dumps(w, separators=(",", ":")) for w in wrappers.values()], pa.string()),
        ],
        schema=_SENT,
    )


def _align_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    place, wrappers = TaskContext.get().partitionId(), {}
    for batch in small_batches(batches, "html"):
        for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            host = host_of(url)
            wrappers[host] = align(wrappers.get(host), wrapper_of(parse(html)))
            if len(wrappers) >= HOSTS_HELD:
                yield _sent(wrappers, place)
                wrappers = {}
    if wrappers:
        yield _sent(wrappers, place)


def _align_wrappers(table: pa.Table) -> pa.Table:
    one, host, place = None, table["host"][0].as_py(), table["place"][0].as_py()
    for text in sorted(table["wrapper"].to_pylist()):
        one = align(one, json.loads(text))
    return pa.Table.from_batches([_sent({host: one}, place)])


def _finish_wrappers(table: pa.Table) -> pa.Table:
    aligned_all = _align_wrappers(table)
    whole = finished(json.loads(aligned_all["wrapper"][0].as_py()))
    return pa.Table.from_batches([_sent({aligned_all["host"][0].as_py(): whole}, aligned_all["place"][0].as_py())])


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``host`` and ``wrapper`` (JSON) of every host, from all its pages."""
    few_rows_a_batch(pages.sparkSession)
    layout = "host string, place long, wrapper string"
    rows = pages.select("url", "html").where(F.col("html").isNotNull())
    sent = written(rows.mapInArrow(_align_pages, layout), "html-wrappers")
    places = (sent.agg(F.max("place")).first()[0] or 0) + 1
    while True:
        places = -(-places // FAN_IN)
        sent = sent.withColumn("place", F.floor(F.col("place") / FAN_IN))
        sent = sent.groupBy("host", "place").applyInArrow(_finish_wrappers if places <= 1 else _align_wrappers, layout)
        if places <= 1:
            return written(sent.select("host", "wrapper"), "html-wrappers")
        sent = written(sent, "html-wrappers")


def extract_main_text(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Per row: the key, ``url``, ``text`` of the article, and ``wrapper``, its host's expression."""
    wrappers = infer_wrappers(pages).select(F.col("host").alias("of_host"), "wrapper")
    # the same host as host_of gives
    authority = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.col(key).alias("key"), "url", "html")
    kind = rows.schema["key"].dataType.simpleString()
    joined = rows.join(wrappers, F.coalesce(authority, F.lit("")) == F.col("of_host"), "left")

    def extract_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[Wrapper, str]] = {}
        for batch in small_batches(batches, "html"):
            texts, expressions = [], []
            for html, wrapper in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if html is None:
                    texts.append("")
                    expressions.append(None)
                    continue
                page = parse(html)
                if wrapper not in known:
                    if len(known) > HOSTS_HELD:
                        known = {}
                    tree = json.loads(wrapper) if wrapper else wrapper_of(page)
                    known[wrapper] = tree, expression(tree)
                texts.append(extract(page, known[wrapper][0]))
                expressions.append(known[wrapper][1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()), pa.array(expressions, pa.string())],
                ["key", "url", "text", "wrapper"],
            )

    return joined.select("key", "url", "html", "wrapper").mapInArrow(
        extract_rows, f"key {kind}, url string, text string, wrapper string"
    ).withColumnRenamed("key", key)
