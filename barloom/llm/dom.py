"""Pages to small DOM trees, and trees to each other: helpers of wrapper induction.

A page becomes blocks of text in page order, each in a node of a tree of block-level elements. Nodes are labelled by
tag, classes, id and role (words without digits). Equal siblings that follow each other share one node, so that a
tree's size follows the layout and not the text: text elements always, containers when three or more of one structure
stand in a row; beyond WIDE children all of one label share a node; below DEEP levels everything is its ancestor's.
"""

from __future__ import annotations

import html
import re

#: Children of a node, levels of a tree.
WIDE, DEEP = 64, 48

# Elements by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("iframe noembed noframes noscript script style template textarea title xmp".split())
TEXT_TAGS = set("blockquote dd dt figcaption h2 h3 h4 h5 h6 li option p pre td th tr".split())
BLOCKS = TEXT_TAGS | set(
    "address article aside body button caption center details dialog dir div dl fieldset figure footer form h1 header hgroup hr legend main menu nav "
    "ol optgroup search section select summary svg table tbody tfoot thead ul".split()
)
UNSEEN = set("html head body".split())
#: Elements that an opening one ends, as far as they are open below its container.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}), "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
}
SIDE_TAGS = set("aside button dialog fieldset footer form legend menu nav search select svg".split())
SIDE_ROLES = set("alert alertdialog banner complementary contentinfo dialog form navigation search".split())
SIDE_WORDS = set(
    "ad ads adbox adslot advert advertisement advertising adverts aside banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright discussion "
    "disqus footer form gdpr login masthead menu menubar modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promotion "
    "recommendations recommended register related replies reply respond search share sharing sidebar signin signup social sponsor sponsored subscribe subscription "
    "toast topbar widget widgets".split()
)
MAIN_WORDS = set("article content entry main post story".split())
# End of fixed values.

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
TOKEN = re.compile(r"\S+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """An element: label, children, places of its own blocks."""

    __slots__ = ("tag", "label", "kids", "own")

    def __init__(self, tag: str, label: str):
        self.tag, self.label, self.kids, self.own = tag, label, [], []

    def structure(self, levels: int = 6) -> str:
        """Labels of some levels below, equal neighbours once."""
        forms = [k.structure(levels - 1) for k in self.kids] if levels else []
        return self.label + "(" + ",".join(f for f, before in zip(forms, [None, *forms]) if f != before) + ")"


def label_of(tag: str, attributes: str) -> str:
    """tag, then .class words, @role, #id words, ! if hidden. Words with digits say nothing about the layout."""
    if not attributes.strip():
        return tag
    found = {}
    for name, *values in ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), "".join(values))
    label = tag
    for mark, name in ((".", "class"), ("@", "role"), ("#", "id")):
        tokens = [t for t in TOKEN.findall(html.unescape(found.get(name, ""))) if not any(c.isdigit() for c in t)]
        words = sorted({w.lower() for t in tokens for w in WORD.findall(t)})
        label += "".join(mark + w for w in words)
    if "hidden" in found or HIDDEN.search(found.get("style", "")) or found.get("aria-hidden", "").lower() == "true":
        label += "!"
    return label


def parse(page: str) -> tuple[Node, list[tuple[str, int]]]:
    """Root and blocks (text, characters of it in links) of a page; blocks are in page order."""
    root = Node("", "")
    stack, blocks = [root], []
    buffer: list[str] = []
    linked: list[str] = []
    state = {"link": False}
    lower = None

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                stack[-1].own.append(len(blocks))
                blocks.append((text, min(len(text), len(" ".join("".join(linked).split())))))
            buffer.clear()
            linked.clear()

    def close(k: int) -> None:
        flush()
        del stack[k:]
        state["link"] = False

    def say(raw: str) -> None:
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            buffer.append(text)
            if state["link"]:
                linked.append(text)

    at, end, pattern = 0, len(page), TAG
    while at < end:
        open_at = page.find("<", at)
        if open_at < 0:
            say(page[at:])
            break
        say(page[at:open_at])
        following = page[open_at + 1 : open_at + 2]
        if following in ("!", "?"):
            if page.startswith("<!--", open_at):
                close_at = page.find("-->", open_at + 2)
                at = end if close_at < 0 else close_at + 3
            else:
                close_at = page.find(">", open_at)
                at = end if close_at < 0 else close_at + 1
            continue
        found = pattern.match(page, open_at)
        if found is None and pattern is TAG and (following.isalpha() or following == "/"):
            found = LOOSE.match(page, open_at)  # a quote that is never closed: later ones neither
            if found is not None:
                pattern = LOOSE
        if found is None:
            if following == "/" or following.isascii() and following.isalpha():  # no end: not text
                close_at = page.find(">", open_at)
                at = end if close_at < 0 else close_at + 1
            else:
                say("<")
                at = open_at + 1
            continue
        at = found.end()
        ends, tag = found[1], found[2].lower()
        if tag in RAW:
            if not ends and not found[3].endswith("/"):
                lower = page.lower() if lower is None else lower
                close_at = lower.find("</" + tag, at) if len(lower) == end else re.compile("</" + tag, re.I).search(page, at)
                close_at = close_at.start() if isinstance(close_at, re.Match) else -1 if close_at is None else close_at
                at = end if close_at < 0 else close_at
            continue
        if tag in UNSEEN:
            continue
        if tag not in BLOCKS:
            if tag == "br":
                say(" ")
            elif tag == "a":
                state["link"] = not ends
            continue
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
            continue
        flush()
        if stack[-1].tag == "p":
            close(len(stack) - 1)
        if tag in ENDS:
            closed, scope = ENDS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in closed:
                    close(k)
                    break
                if stack[k].tag in scope:
                    break
        if tag in VOID:
            continue
        node = Node(tag, label_of(tag, found[3]))
        stack[-1].kids.append(node)
        if not found[3].endswith("/") or tag != "svg":
            stack.append(node)
    flush()
    return root, blocks


def _runs(kids: list[Node]) -> list[list[Node]]:
    """Children that share a slot, when their parent stands alone in its own."""
    runs: list[list[Node]] = []
    for k in kids:
        if runs and runs[-1][0].label == k.label:
            runs[-1].append(k)
        else:
            runs.append([k])
    found = []
    for run in runs:
        if run[0].tag in TEXT_TAGS or len(run) == 1:
            found.append(run)
            continue
        start = 0
        for k in range(1, len(run) + 1):
            if k == len(run) or run[k].structure() != run[start].structure():
                found += [run[start:k]] if k - start >= 3 else [[x] for x in run[start:k]]
                start = k
    return found


def _alike(kids: list[Node], key: str) -> list[list[Node]]:
    groups: dict[str, list[Node]] = {}
    for k in kids:
        groups.setdefault(getattr(k, key), []).append(k)
    return list(groups.values())


def slots_of(root: Node, n_blocks: int) -> tuple[list, list[int]]:
    """(tree, slot of each block): tree as [label, children], slots numbered in its preorder."""
    at, count = [0] * n_blocks, 0

    def build(group: list[Node], level: int) -> list:
        nonlocal count
        me = count
        count += 1
        for node in group:
            for b in node.own:
                at[b] = me
        kids = [k for node in group for k in node.kids]
        if level == DEEP:
            while kids:
                below = kids.pop()
                kids += below.kids
                for b in below.own:
                    at[b] = me
        groups = _runs(kids) if len(group) == 1 else _alike(kids, "label")
        if len(groups) > WIDE:
            groups = _alike(kids, "label")
        if len(groups) > WIDE:
            groups = _alike(kids, "tag")
        return [group[0].label, [build(g, level + 1) for g in groups]]

    return build([root], 0), at


def match(a: list, b: list) -> tuple[int, list]:
    """Simple tree matching of [label, children, …]: size of the largest order-keeping match of two trees whose roots carry one label, and the pairs of matched nodes."""
    if a[0] != b[0]:
        return 0, []
    left, right = a[1], b[1]
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    held = {}
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            size = 0
            if x[0] == y[0]:
                held[i, j] = match(x, y)
                size = held[i, j][0]
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + size)
    pairs, i, j = [], len(left), len(right)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs += held[i, j][1]
    return best[-1][-1] + 1, [(a, b), *pairs]


def words_of(label: str) -> tuple[str, set[str], str]:
    """(tag, class and id words, role) of a label."""
    tag = re.match(r"[^.@#!]*", label)[0]
    return tag, set(re.findall(r"[.#]([a-z]+)", label)), "".join(re.findall(r"@([a-z]+)", label))
