"""Main text of web pages by wrapper induction.

Pages of one host are made by few layouts. Each page is parsed to a tree of slots (dom.py); trees of one host and
shape are counted together, and the shapes of a host are aligned by simple tree matching into one template, in rounds
of groups of at most FAN trees, so that no task sees all shapes of a large host. A slot whose text is the same on
pages that differ otherwise is template; a slot whose text varies is content, unless its element or one around it
says that it is a menu, form, notice, advert, sidebar, header, footer or comment. Article and main elements, where a
shape has them, bound the content; elsewhere the container with most of the host's varying text does.

Null and empty html give no text. Pages without a host (null or odd url) count as one host; a host of a single page,
or of copies of one, has no template, and only the elements' meaning decides. Equal rows give equal results each. Texts
are whole, however long. Blocks are block-level elements' runs of text; a line break is white space. Other columns
are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dom import MAIN_WORDS, SIDE_ROLES, SIDE_TAGS, SIDE_WORDS, TEXT_TAGS, match, parse, slots_of, words_of
from .frames import kept_table

#: Trees aligned by one task at a time.
FAN = 64
#: Share of a container's varying text that one child must hold to stand for it.
MOST = 0.7
#: Pages that show that a container inside an article is template.
SURE = 4
#: Decisions are broadcast up to so many bytes, joined beyond.
BROADCAST_BYTES = 16 << 20

HOST = re.compile(r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", re.I)
#: Per slot: pages, least and greatest text hash, least and greatest page hash, characters, of them in links.
STATS = ("n", "lo", "hi", "page_lo", "page_hi", "chars", "links")

PARSED = (
    "page_id long, url string, host string, shape string, tree string, page long, "
    "slots array<struct<slot:int,hash:long,chars:long,links:long>>, blocks array<struct<slot:int,text:string>>"
)
_PARSED = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("shape", pa.string()), ("tree", pa.string()), ("page", pa.int64()),
    ("slots", pa.list_(pa.struct([("slot", pa.int32()), ("hash", pa.int64()), ("chars", pa.int64()), ("links", pa.int64())]))),
    ("blocks", pa.list_(pa.struct([("slot", pa.int32()), ("text", pa.string())]))),
])


def hash64(text: str) -> int:
    """64-bit hash as a signed number."""
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def host_of(url: str | None) -> str:
    found = HOST.match(url or "")
    return found[1].lower() if found else ""


def parsed_page(page_id: int | None, url: str | None, page: str | None) -> tuple:
    """One row of PARSED."""
    root, blocks = parse(page or "")
    tree, at = slots_of(root, len(blocks))
    held: dict[int, list] = {}
    for (text, links), slot in zip(blocks, at):
        own = held.setdefault(slot, [[], 0, 0])
        own[0].append(text)
        own[1] += len(text)
        own[2] += links
    stats = [(slot, hash64("\n".join(texts)), chars, links) for slot, (texts, chars, links) in sorted(held.items())]
    text = json.dumps(tree, separators=(",", ":"))
    whole = hash64("\n".join(f"{s[0]} {s[1]}" for s in stats))
    return page_id, url, host_of(url), xxhash.xxh3_128_hexdigest(text.encode()), text, whole, stats, [(slot, b[0]) for slot, b in zip(at, blocks)]


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, held = [], 0
        for row in zip(*(b[c] for c in ("page_id", "url", "html"))):
            rows.append(parsed_page(*(x.as_py() for x in row)))
            held += len(row[2].as_py() or "")
            if held > 4 << 20:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows)]
    for k, names in ((6, ("slot", "hash", "chars", "links")), (7, ("slot", "text"))):
        columns[k] = [[dict(zip(names, x)) for x in row] for row in columns[k]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PARSED)], schema=_PARSED)


def parsed_pages(pages: DataFrame) -> DataFrame:
    """PARSED for every page, lazily."""
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return plain.mapInArrow(_parse_batches, PARSED)


def shapes_of(parsed: DataFrame) -> DataFrame:
    """(host, shape, tree, n, stats) for every shape of a host, stats being an array of (slot, STATS): counted before anything of a host meets."""
    slot = F.col("s")
    by_slot = parsed.select("host", "shape", "page", F.explode("slots").alias("s")).groupBy("host", "shape", slot["slot"].alias("slot")).agg(
        F.count(F.lit(1)).alias("n"), F.min(slot["hash"]).alias("lo"), F.max(slot["hash"]).alias("hi"), F.min("page").alias("page_lo"), F.max("page").alias("page_hi"),
        F.sum(slot["chars"]).alias("chars"), F.sum(slot["links"]).alias("links"),
    )
    stats = by_slot.groupBy("host", "shape").agg(F.collect_list(F.struct("slot", *STATS)).alias("stats"))
    trees = parsed.groupBy("host", "shape").agg(F.first("tree").alias("tree"), F.count(F.lit(1)).alias("pages"))
    return trees.join(stats, ["host", "shape"], "left")


def template_of(tree: str, stats: list[dict] | None) -> list:
    """[label, children, stats or None] of a shape."""
    by_slot = {s["slot"]: [s[k] for k in STATS] for s in stats or []}
    count = iter(range(1 << 62))

    def build(node: list) -> list:
        me = next(count)
        return [node[0], [build(k) for k in node[1]], by_slot.get(me)]

    return build(json.loads(tree))


def added(a: list | None, b: list | None) -> list | None:
    """Stats of two slots that are one."""
    if a is None or b is None:
        return a or b
    return [a[0] + b[0], min(a[1], b[1]), max(a[2], b[2]), min(a[3], b[3]), max(a[4], b[4]), a[5] + b[5], a[6] + b[6]]


def align(template: list, tree: list) -> None:
    """Merge a tree into a template: matched slots add up, others are put in after the sibling matched before them."""
    twin = {id(y): x for x, y in match(template, tree)[1]}

    def merge(into: list, node: list) -> None:
        into[2] = added(into[2], node[2])
        at = 0
        for k in node[1]:
            if id(k) in twin:
                merge(twin[id(k)], k)
                at = next(n for n, x in enumerate(into[1]) if x is twin[id(k)]) + 1
            else:
                into[1].insert(at, k)
                at += 1

    if template[0] == tree[0]:
        merge(template, tree)


def templates(shapes: DataFrame) -> DataFrame:
    """(host, template): all shapes of a host aligned, those of most pages first, in rounds of about FAN trees a task."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [json.dumps(template_of(t, s), separators=(",", ":")) for t, s in zip(b["tree"].to_pylist(), b["stats"].to_pylist())]
            yield pa.RecordBatch.from_arrays([b["host"], b["pages"], pa.array(made, pa.string())], names=["host", "pages", "template"])

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["pages"].to_pylist(), table["template"].to_pylist()), key=lambda r: (-r[0], r[1]))
        whole = json.loads(rows[0][1])
        for _, more in rows[1:]:
            align(whole, json.loads(more))
        return pa.table({"host": [key[0].as_py()], "pages": [sum(r[0] for r in rows)], "template": [json.dumps(whole, separators=(",", ":"))]})

    parts = shapes.mapInArrow(first, "host string, pages long, template string")
    most = shapes.groupBy("host").count().agg(F.max("count")).first()[0] or 1
    while True:
        fold = -(-most // FAN)
        parts = parts.groupBy("host", F.pmod(F.xxhash64("template"), F.lit(fold)).alias("part")).applyInArrow(merged, "host string, pages long, template string")
        if fold == 1:
            return parts
        parts, most = kept_table(parts, "templates"), fold


def role_of(label: str) -> str:
    """side, main, header, hint (a class that says main), text or plain."""
    tag, words, role = words_of(label)
    if label.endswith("!") or tag in SIDE_TAGS or role in SIDE_ROLES or words & SIDE_WORDS:
        return "side"
    if tag in ("article", "main") or role in ("main", "article"):
        return "main"
    if tag == "header" or "header" in words:
        return "header"
    return "hint" if words & MAIN_WORDS else "text" if tag in TEXT_TAGS or tag == "h1" else "plain"


class Judge:
    """Roles and statistics of a tree's nodes."""

    def __init__(self, tree: list, stats: dict[int, list | None]):
        self.stats = stats
        self.roles: dict[int, str] = {}
        self._look(tree)

    def _look(self, node: list) -> None:
        self.roles[id(node)] = role_of(node[0])
        for k in node[1]:
            self._look(k)

    def role(self, node: list) -> str:
        return self.roles[id(node)]

    def unwrap(self, node: list) -> bool:
        """Whether a main element is below or here; what wraps one then names a layout, not a side part."""
        below = any([self.unwrap(k) for k in node[1]])
        if below and self.role(node) == "side" and not node[0].endswith("!"):
            self.roles[id(node)] = "plain"
        return below or self.role(node) == "main"

    def mains(self, node: list) -> list[list]:
        """Articles; an element marked main that has one below stands back for it."""
        if self.role(node) == "side":
            return []
        below = [m for k in node[1] for m in self.mains(k)]
        return [node] if self.role(node) == "main" and (not below or words_of(node[0])[0] == "article") else below

    def constant(self, node: list, least: int) -> bool:
        """The same text on `least` pages or more that differ otherwise."""
        s = self.stats.get(id(node))
        return s is not None and s[0] >= least and s[1] == s[2] and s[3] != s[4]

    def in_article(self, node: list) -> list[list]:
        """Nodes of an article that hold its text."""
        if self.role(node) == "side":
            return []
        gone = self.role(node) in ("plain", "hint", "header") and self.constant(node, SURE)
        return [node] * (not gone) + [x for k in node[1] for x in self.in_article(k)]

    def varies(self, node: list) -> bool:
        """Neither template nor mostly links."""
        s = self.stats.get(id(node))
        return s is not None and not self.constant(node, 2) and 2 * s[6] <= s[5]

    def varying(self, node: list) -> int:
        """Characters outside links of the varying text here and below."""
        if self.role(node) in ("side", "header"):
            return 0
        s = self.stats.get(id(node))
        return (s[5] - s[6] if self.varies(node) else 0) + sum(self.varying(k) for k in node[1])

    def in_layout(self, node: list) -> list[list]:
        """Nodes with varying text, without marked articles: where one container holds MOST of it, the containers beside it are side parts; text elements beside it (titles, leads) stay."""
        if self.role(node) in ("side", "header"):
            return []
        found = [node] * self.varies(node)
        total = self.varying(node)
        inner = [k for k in node[1] if k[1] and _wraps(k) and self.varying(k) >= MOST * total > 0]
        hinted = [k for k in node[1] if self.role(k) == "hint" and self.varying(k)]
        inner = inner or (hinted if len(hinted) == 1 else [])
        return found + [x for k in node[1] if not inner or k is inner[0] or not _wraps(k) for x in self.in_layout(k)]


def _wraps(node: list) -> bool:
    """A container of the layout, by its tag."""
    return words_of(node[0])[0] in ("", "center", "details", "div", "section", "summary", "table", "tbody", "td", "tr")


def content_slots(tree: list, template: list) -> list[int]:
    """Slots of a shape ([label, children]) that hold content, judged by the host's template."""
    pairs = match(template, tree)[1]
    judge = Judge(tree, {id(y): x[2] for x, y in pairs})
    chosen = judge.mains(tree)
    if not chosen and judge.unwrap(tree):
        chosen = judge.mains(tree)
    if chosen:
        kept = {id(x) for m in chosen for x in judge.in_article(m)}
    else:
        whole = Judge(template, {id(x): x[2] for x, _ in pairs})
        layout = {id(x) for x in whole.in_layout(template)}
        kept = {id(y) for x, y in pairs if id(x) in layout}

    def number(node: list) -> Iterator[list]:
        yield node
        for k in node[1]:
            yield from number(k)

    return [n for n, node in enumerate(number(tree)) if id(node) in kept]


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    parsed = kept_table(parsed_pages(pages), "pages", compression="zstd")
    shapes = kept_table(shapes_of(parsed), "shapes")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [content_slots(json.loads(t), json.loads(w)) for t, w in zip(b["tree"].to_pylist(), b["template"].to_pylist())]
            yield pa.RecordBatch.from_arrays([b["own_host"], b["own_shape"], pa.array(kept, pa.list_(pa.int32()))], names=["own_host", "own_shape", "kept"])

    whole = templates(shapes.select("host", "shape", "tree", "pages", "stats"))
    judged = shapes.select(F.col("host").alias("own_host"), F.col("shape").alias("own_shape"), "tree").join(whole, F.col("own_host") == F.col("host"))
    kept = kept_table(judged.select("own_host", "own_shape", "tree", "template").mapInArrow(decide, "own_host string, own_shape string, kept array<int>"), "kept")
    size = kept.agg(F.sum(F.length("own_host") + F.length("own_shape") + 4 * F.size("kept") + 40)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        kept = F.broadcast(kept)
    blocks = F.filter("blocks", lambda b: F.array_contains("kept", b["slot"]))
    text = F.array_join(F.transform(blocks, lambda b: b["text"]), "\n")
    joined = parsed.join(kept, (F.col("host") == F.col("own_host")) & (F.col("shape") == F.col("own_shape")), "left")
    result = joined.select("page_id", "url", F.coalesce(text, F.lit("")).alias("text"))
    return result.withColumn("n_chars", F.char_length("text").cast("long"))
