"""HTML to trees and blocks, and simple tree matching, for wrapper induction."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from zlib import crc32

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table "
    "tbody td tfoot th thead title tr ul".split())
#: Elements that a start tag closes when they are open, and where the search for them ends.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
# Elements, roles and class or id words that are no main text.
OUTSIDE = frozenset(
    "script style noscript template nav footer aside form button select option textarea input iframe svg canvas object dialog menu "
    "head title audio video map datalist".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
OUTSIDE_WORDS = frozenset(
    "ad ads advert advertisement adsense sponsor sponsored promo cookie cookies consent notice notification gdpr menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar widget footer comment comments disqus reply replies share sharing social related "
    "recommended newsletter subscribe popup modal login signup toolbar pagination pager masthead banner".split())
HEADER_WORDS = frozenset({"header"})
#: Words that may stand beside those in a class or id (``site-footer``); with any other word it is another name (``has-sidebar``).
PLACE_WORDS = frozenset(
    "site page global main primary secondary top bottom left right inner outer wrap wrapper container box bar block area section "
    "list links link item items button buttons icon icons row".split())
PART_WORDS = PLACE_WORDS | {"post", "entry", "article"}
MAIN = frozenset({"article", "main"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of OUTSIDE (and header) that may hold the main text; no other may.
SPARED = frozenset("nav footer aside form menu head".split())
# Why an element may be outside: by its kind, or only by its name.
KIND, NAME = 1, 2


@dataclass(slots=True)
class Node:
    tag: str
    label: str = ""
    outside: bool = False
    doubt: int = 0  # KIND or NAME: outside, unless ``settle`` finds the main text below
    children: list = field(default_factory=list)  # nodes and runs of text


def attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)}


def named(token: str, words: frozenset[str], beside: frozenset[str]) -> bool:
    """Whether a class or id consists of ``words`` and words that may stand beside them."""
    parts = {w for w in re.split(r"[^a-z]+", token) if w}
    return bool(parts & words) and parts <= words | beside


def element(tag: str, raw: str, in_main: bool) -> Node:
    """A node labelled by tag and classes; outside the main text by element, role or words."""
    node = Node(tag, tag, tag in OUTSIDE - SPARED)
    by_kind, by_name = tag in SPARED - {"form"} or (tag == "header" and not in_main), tag == "form"
    if raw and not raw.isspace():
        a = attributes(raw)
        node.label = f"{tag}.{'.'.join(sorted(set(a.get('class', '').split())))}" if a.get("class") else tag
        if tag not in ("html", "body", *MAIN):
            tokens = f"{a.get('class', '')} {a.get('id', '')}".lower().split()
            by_name |= any(named(t, OUTSIDE_WORDS, PART_WORDS) or (not in_main and named(t, HEADER_WORDS, PLACE_WORDS)) for t in tokens)
        by_kind |= a.get("role", "").lower() in OUTSIDE_ROLES
        node.outside |= "hidden" in a or a.get("aria-hidden", "").lower() == "true"
        node.outside |= "display:none" in a.get("style", "").replace(" ", "").lower()
    node.doubt = KIND if by_kind else NAME if by_name else 0
    return node


def settle(root: Node) -> None:
    """Decide on the elements in doubt.  One is not outside if it holds an
    article or main element with text, or, outside only by name, more than half
    of the text around it; unless an article or main element beside it has text.
    The text around is that of the next article, main or such element above, or
    of the page; text in links does not count."""
    nodes, parents, text, todo = [], [], [], [(root, 0, False)]
    while todo:
        node, parent, link = todo.pop()
        if node.outside:
            continue
        link = link or node.tag == "a"
        at = len(nodes)
        nodes.append(node)
        parents.append(parent)
        text.append(0 if link else sum(len("".join(c.split())) for c in node.children if isinstance(c, str)))
        todo.extend((c, at, link) for c in reversed(node.children) if not isinstance(c, str))
    mains, clear = [0] * len(nodes), [0] * len(nodes)  # below; below and not in an element in doubt
    for i in range(len(nodes) - 1, 0, -1):
        p, is_main = parents[i], nodes[i].tag in MAIN and text[i] > 0
        text[p] += text[i]
        mains[p] += mains[i] + is_main
        if not nodes[i].doubt:
            clear[p] += clear[i] + is_main
    around = [0] * len(nodes)
    for i in range(1, len(nodes)):
        node, s = nodes[i], around[parents[i]]
        if node.doubt:
            node.outside = clear[s] > 0 or not (mains[i] or (node.doubt == NAME and 2 * text[i] > text[s]))
        around[i] = i if node.tag in MAIN or (node.doubt and not node.outside) else s


def parse(page: str) -> Node:
    """The page's tree.  Start tags close what HTML lets them close, end tags
    without a partner are dropped, and what is open at the end is closed."""
    root = Node("#root", "#root")
    stack, at = [root], 0
    while True:
        m = TOKEN.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text:
            stack[-1].children.append(html.unescape(text) if "&" in text else text)
        if not m:
            settle(root)
            return root
        at = m.end()
        if m["name"] is None:
            continue
        tag = m["name"].lower()
        if m["close"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag not in BLOCK and stack[k].tag in BLOCK:
                    break
            continue
        if tag in CLOSES:
            names, stop = CLOSES[tag]
        else:
            names, stop = ({"p"}, {"div", "article", "section", "main", "td", "th", "li", "body", "blockquote"}) if tag in BLOCK else ((), ())
        for k in range(len(stack) - 1, 0, -1) if names else ():
            if stack[k].tag in names:
                del stack[k:]
                break
            if stack[k].tag in stop:
                break
        node = element(tag, m["attrs"], any(n.tag in MAIN for n in stack))
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not m["attrs"].endswith("/"):
            stack.append(node)


@dataclass(slots=True)
class Slot:
    """A node of the collapsed tree: neighbours with one label are one slot."""

    label: str
    text: int  # digest of the text below
    size: int  # its length
    children: list
    id: int = -1

    def flat(self) -> list:
        """The tree in preorder as [label, text, size, count of children]."""
        out, todo = [], [self]
        while todo:
            s = todo.pop()
            out.append([s.label, s.text, s.size, len(s.children)])
            todo.extend(reversed(s.children))
        return out


@dataclass(slots=True)
class Block:
    text: str
    slot: Slot
    main: bool
    linked: int  # characters inside links
    links: int = 0  # how many have text in the block
    heading: bool = False


def squeeze(text: str) -> str:
    return " ".join(text.split())


def read(page: str) -> tuple[Slot, list[Block]]:
    """The collapsed tree of the page and its text blocks that are not outside."""
    blocks: list[Block] = []
    parts: list[str] = []
    links: set[int] = set()
    linked = 0

    def flush(slot: Slot, main: bool, tag: str = "") -> None:
        nonlocal linked
        text = squeeze("".join(parts))
        if text:
            blocks.append(Block(text, slot, main, linked, len(links), tag in HEADINGS))
        parts.clear()
        links.clear()
        linked = 0

    # depth first, without recursion: pages may nest deeply
    root_slot = Slot("#root", 0, 0, [])
    texts: dict[int, list[str]] = {}
    todo: list[tuple] = [("open", parse(page), root_slot, False, False, 0)]  # the last: the link's identity, or 0
    while todo:
        step, node, slot, main, outside, link = todo.pop()
        if step == "text":
            texts.setdefault(id(slot), []).append(node)
            if not outside:
                parts.append(node)
                if link and node.strip():
                    linked += len(node.strip())
                    links.add(link)
            continue
        is_block = node.tag in BLOCK
        if step == "shut":
            if is_block:
                flush(slot, main, node.tag)
            continue
        if node.tag in ("br", "hr", "wbr"):
            parts.append("" if node.tag == "wbr" else " ")
        main, outside, link = main or node.tag in MAIN, outside or node.outside, link or (id(node) if node.tag == "a" else 0)
        later, last = [], None
        for child in node.children:
            if isinstance(child, str):
                later.append(("text", child, slot, main, outside, link))
                continue
            if child.tag in VOID:
                later.append(("open", child, slot, main, outside, link))
                continue
            if child.tag in BLOCK:
                if last is None or last.label != child.label:
                    last = Slot(child.label, 0, 0, [])
                    slot.children.append(last)
                if not outside:
                    later.append(("shut", Node("p"), slot, main, outside, link))
                later.append(("open", child, last, main, outside, link))
                later.append(("shut", child, last, main or child.tag in MAIN, outside, link))
            else:
                later.append(("open", child, slot, main, outside, link))
        todo.extend(reversed(later))
    flush(root_slot, False)

    def digest(slot: Slot) -> None:
        order, todo = [], [slot]
        while todo:
            s = todo.pop()
            order.append(s)
            todo.extend(s.children)
        for s in reversed(order):
            own = squeeze("".join(texts.get(id(s), ())))
            s.size = len(own) + sum(c.size for c in s.children)
            s.text = crc32(f"{own}|{','.join(str(c.text) for c in s.children)}".encode())

    digest(root_slot)
    return root_slot, blocks


def tree(plain: list) -> Slot:
    label, text, size, children = plain
    return Slot(label, text, size, [tree(c) for c in children])


def unflat(rows: list) -> Slot:
    """The tree of ``Slot.flat``, numbered in preorder."""
    top = Slot("", 0, 0, [])
    todo = [(top, 1)]
    for i, (label, text, size, n) in enumerate(rows):
        while not todo[-1][1]:
            todo.pop()
        parent, left = todo.pop()
        todo.append((parent, left - 1))
        slot = Slot(label, text, size, [], i)
        parent.children.append(slot)
        todo.append((slot, n))
    return top.children[0]


def number(slot: Slot) -> int:
    """Give ids in preorder; the count of slots."""
    n, todo = 0, [slot]
    while todo:
        s = todo.pop()
        s.id = n
        n += 1
        todo.extend(reversed(s.children))
    return n


def match(a: Slot, b: Slot) -> tuple[int, list[tuple[Slot, Slot]]]:
    """Simple tree matching: the greatest number of slots of ``a`` and ``b`` that
    pair up with equal labels, parents and order kept, and the pairs."""
    if a.label != b.label:
        return 0, []
    counts: dict[tuple[int, int], int] = {}  # of pairs that both have children

    def count(x: Slot, y: Slot) -> int:
        if x.label != y.label:
            return 0
        return counts[id(x), id(y)] if x.children and y.children else 1

    def table(x: Slot, y: Slot) -> list[list[int]]:
        best = [[0] * (len(y.children) + 1)]
        for c in x.children:
            above, row = best[-1], [0]
            for j, d in enumerate(y.children):
                row.append(max(above[j + 1], row[j], above[j] + count(c, d)))
            best.append(row)
        return best

    todo = [(a, b, False)]
    while todo:
        x, y, ready = todo.pop()
        if ready:
            counts[id(x), id(y)] = 1 + table(x, y)[-1][-1]
            continue
        todo.append((x, y, True))
        inner = [d for d in y.children if d.children]
        todo.extend((c, d, False) for c in x.children if c.children for d in inner if c.label == d.label)
    pairs, later = [], [(a, b)]
    while later:
        x, y = later.pop()
        pairs.append((x, y))
        if not x.children or not y.children:
            continue
        best, i, j = table(x, y), len(x.children), len(y.children)
        while i and j:
            c, d = x.children[i - 1], y.children[j - 1]
            n = count(c, d)
            if n and best[i][j] == best[i - 1][j - 1] + n:
                later.append((c, d))
                i, j = i - 1, j - 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return count(a, b), pairs


def sizes(slot: Slot) -> dict[int, int]:
    """The count of slots of every subtree, by the identity of its top."""
    order, todo, out = [], [slot], {}
    while todo:
        s = todo.pop()
        order.append(s)
        todo.extend(s.children)
    for s in reversed(order):
        out[id(s)] = 1 + sum(out[id(c)] for c in s.children)
    return out


def by_place(x: list[Slot], y: list[Slot]) -> list[tuple[Slot, Slot]]:
    """Pairs of children in linear time: equal ones at both ends, then the k-th
    of a label with the k-th of that label."""
    equal = lambda c, d: (c.label, c.text, c.size) == (d.label, d.text, d.size)
    least = min(len(x), len(y))
    i = next((k for k in range(least) if not equal(x[k], y[k])), least)
    j = next((k for k in range(least - i) if not equal(x[-1 - k], y[-1 - k])), least - i)
    pairs = [*zip(x[:i], y[:i], strict=True), *zip(x[len(x) - j:], y[len(y) - j:], strict=True)]
    waiting: dict[str, list[Slot]] = {}
    for d in reversed(y[i:len(y) - j]):
        waiting.setdefault(d.label, []).append(d)
    return pairs + [(c, waiting[c.label].pop()) for c in x[i:len(x) - j] if waiting.get(c.label)]


def align(a: Slot, b: Slot, most: int) -> list[tuple[Slot, Slot]]:
    """Pairs of slots of two trees.  Subtrees with at most ``most`` * ``most``
    pairs of slots are matched as ``match`` does; the children of larger ones are
    paired by label and place, level by level."""
    if a.label != b.label:
        return []
    of_a, of_b = sizes(a), sizes(b)
    pairs, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        if of_a[id(x)] * of_b[id(y)] <= most * most:
            pairs += match(x, y)[1]
        else:
            pairs.append((x, y))
            todo.extend(by_place(x.children, y.children))
    return pairs
