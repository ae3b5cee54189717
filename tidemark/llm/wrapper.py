"""Main text of web pages by wrapper induction over the pages of a host."""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
BROKEN = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
# Elements by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
MAIN = frozenset("article main".split())
# What an element's tag, or a whole class, id or role, says it is; headers are content within an article.
SIDE_TAGS = frozenset("nav footer aside form head svg math button select object menu dialog canvas audio video".split())
SIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo banner sidebar menu navbar nav navigation breadcrumb breadcrumbs footer cookie cookies cookie-notice consent gdpr notice notices "
    "popup modal newsletter subscribe share sharing social related comment comments commentlist comment-list replies disqus pagination pager widget toolbar login search complementary contentinfo".split()
)
HEADERS = frozenset("header masthead".split())
# A start of one of these ends an open element of the others.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
Tree = list[list]


@lru_cache(maxsize=64)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(f"</{re.escape(tag)}[\\s/>]", re.I)


def markup(page: str) -> Iterator[tuple[str, str, str, str]]:
    """The page's pieces in order: (text, '', '', '') or ('', slash, tag, attributes).

    Nothing is looked through twice: past the last `>` there is no more markup, and a
    tag whose quotes do not close ends at its next `>`.
    """
    at, size, last = 0, len(page), page.rfind(">")
    while at < size:
        start = page.find("<", at)
        while 0 <= start < last and not (page[start + 1].isalpha() or page[start + 1] in "/!?"):
            start = page.find("<", start + 1)
        if start < 0 or start > last:
            # A comment or declaration that is never closed holds all that follows.
            cut = next((m.start() for m in re.finditer(r"<[!?]", page[at:])), None)
            yield (page[at:] if cut is None else page[at : at + cut]), "", "", ""
            return
        if start > at:
            yield page[at:start], "", "", ""
        if found := OTHER.match(page, start):
            at = found.end()
            continue
        found = TAG.match(page, start) or BROKEN.match(page, start)
        if not found:
            yield "<", "", "", ""
            at = start + 1
            continue
        at = found.end()
        tag = found[2].lower()
        yield "", found[1], tag, found[3]
        if tag in RAW and not found[1]:
            end = _end_of(tag).search(page, at)
            at = size if not end else (page.find(">", end.start()) + 1 or size)


def parse(page: str) -> tuple[Tree, list[tuple[int, str, bool, bool]]]:
    """The page's folded tree, [parent, label] per node, and its blocks: (node, text, side, main).

    The tree has all elements but inline ones and those that hold no markup.  Siblings with one
    label (tag and first class) are one node, a repeated slot.  `main` says that a block
    stands in an article or main element, `side` that the tag or a whole class, id or role
    of an element around it says it is no content; an element that holds an article, or
    most of the page's text, is never taken at its word.  Open paragraphs end at the
    next block; an end tag ends what is open above its element, and one that ends
    nothing is ignored.
    """
    tree: Tree = [[-1, ""]]
    below: list[dict[str, int]] = [{}]
    # Of each element: parent, whether its names say side, header or main.
    parents, says, mains = [-1], [""], [False]
    stack: list[tuple[str, int, int]] = [("", 0, 0)]
    opened: Counter[str] = Counter()
    found: list[tuple[int, int, str]] = []
    words: list[str] = []

    def flush() -> None:
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            words.clear()
            if text:
                found.append((stack[-1][1], stack[-1][2], text))

    def close() -> None:
        opened[stack.pop()[0]] -= 1

    for text, slash, tag, attributes in markup(page):
        if not tag:
            words.append(text)
            continue
        if tag in INLINE:
            continue
        if tag == "br":
            words.append(" ")
            continue
        flush()
        if slash:
            if opened[tag]:
                while stack[-1][0] != tag:
                    close()
                close()
            continue
        if tag in VOID or tag in RAW:
            continue
        if stack[-1][0] == "p":
            close()
        if tag in ENDS and stack[-1][0] in ENDS[tag]:
            close()
            if tag == "tr" and stack[-1][0] == "tr":
                close()
        names: dict[str, list[str]] = {}
        for kind, value in NAMES.findall(attributes) if "=" in attributes else ():
            names.setdefault(kind.lower(), value.strip("\"'").lower().split())
        own = {n for values in names.values() for n in values}
        node, element = stack[-1][1], stack[-1][2]
        label = f"{tag}.{names['class'][0]}" if names.get("class") else tag
        child = below[node].get(label)
        if child is None:
            child = below[node][label] = len(tree)
            tree.append([node, label])
            below.append({})
        parents.append(element)
        mains.append(mains[element] or tag in MAIN)
        is_main = tag in MAIN or tag in ("html", "body")
        says.append("" if is_main else "side" if tag in SIDE_TAGS or not SIDE_NAMES.isdisjoint(own) else "header" if tag in HEADERS or not HEADERS.isdisjoint(own) else "")
        stack.append((tag, child, len(parents) - 1))
        opened[tag] += 1
    flush()
    chars, holds = [0] * len(parents), [False] * len(parents)
    for _, element, text in found:
        chars[element] += len(text)
    for element in range(len(parents) - 1, 0, -1):
        up = parents[element]
        chars[up] += chars[element]
        holds[up] = holds[up] or holds[element] or (mains[element] and not mains[up])
    side = [False] * len(parents)
    for element in range(1, len(parents)):
        said = says[element] == "side" or (says[element] == "header" and not mains[element])
        side[element] = side[parents[element]] or (said and not holds[element] and 2 * chars[element] <= chars[0])
    return tree, [(node, text, side[element], mains[element]) for node, element, text in found]


def _children(tree: Tree) -> list[list[int]]:
    below: list[list[int]] = [[] for _ in tree]
    for i, (parent, _) in enumerate(tree):
        if parent >= 0:
            below[parent].append(i)
    return below


def _in_order(pairs: list[tuple[int, int, int]], width: int) -> tuple[int, list[tuple[int, int]]]:
    """Of pairs (row, column, score), row by row, the best choice that keeps the order of both: (its score, its pairs)."""
    # A tree of maxima over columns: the best choice that ends at or before a column.
    best: list[tuple[int, int]] = [(0, -1)] * (width + 1)
    scores, back = [0] * len(pairs), [-1] * len(pairs)
    k = 0
    while k < len(pairs):
        end = k
        while end < len(pairs) and pairs[end][0] == pairs[k][0]:
            end += 1
        for n in range(k, end):
            total, before, at = 0, -1, pairs[n][1]
            while at > 0:
                if best[at][0] > total:
                    total, before = best[at]
                at -= at & -at
            scores[n], back[n] = total + pairs[n][2], before
        for n in range(k, end):
            at = pairs[n][1] + 1
            while at <= width:
                if scores[n] > best[at][0]:
                    best[at] = (scores[n], n)
                at += at & -at
        k = end
    at = max(range(len(pairs)), key=scores.__getitem__, default=-1)
    top, chosen = (scores[at] if at >= 0 else 0), []
    while at >= 0:
        chosen.append(pairs[at][:2])
        at = back[at]
    return top, chosen[::-1]


def align(page: Tree | str, template: Tree | str) -> list[int]:
    """Simple tree matching: for each node of `page` its node of `template`, or -1; trees may be JSON text.

    Two nodes match if their labels do and their parents match; of their children those are
    matched that, keeping order on both sides, give most matched nodes below.  Pairs that
    can match are listed from the root down and scored from the leaves up.
    """
    page, template = (json.loads(t) if isinstance(t, str) else t for t in (page, template))
    if page == template:
        return list(range(len(page)))
    below_a, below_b = _children(page), _children(template)
    pairs, place = [(0, 0)], {(0, 0): 0}
    for i, j in pairs:
        if below_a[i] and below_b[j]:
            by_label: dict[str, list[int]] = {}
            for b in below_b[j]:
                by_label.setdefault(template[b][1], []).append(b)
            for a in below_a[i]:
                for b in by_label.get(page[a][1], ()):
                    place[a, b] = len(pairs)
                    pairs.append((a, b))
    score, chosen = [1] * len(pairs), [()] * len(pairs)
    for k in range(len(pairs) - 1, -1, -1):
        i, j = pairs[k]
        columns = {b: y for y, b in enumerate(below_b[j])}
        meet = [(x, columns[b], score[place[a, b]]) for x, a in enumerate(below_a[i]) for b in below_b[j] if (a, b) in place] if below_a[i] and below_b[j] else []
        if meet:
            total, kept = _in_order(meet, len(columns))
            score[k] += total
            chosen[k] = [(below_a[i][x], below_b[j][y]) for x, y in kept]
    found = [-1] * len(page)
    todo = [(0, 0)]
    while todo:
        i, j = todo.pop()
        found[i] = j
        todo += chosen[place[i, j]]
    return found


def grown(template: Tree, page: Tree) -> Tree:
    """The template with the nodes of `page` that it lacks, each after the sibling it follows; nodes in preorder."""
    found = align(page, template)
    if -1 not in found:
        return template
    below_a, below_b = _children(page), _children(template)
    extra: dict[int, list[list]] = {}
    out: Tree = []
    # What is copied: a template node (with the page node it matches, or -1), or a page node alone.
    todo = [(-1, 0, 0)]
    while todo:
        parent, j, i = todo.pop()
        at = len(out)
        out.append([parent, template[j][1] if j >= 0 else page[i][1]])
        if j < 0:
            todo += [(at, -1, a) for a in reversed(below_a[i])]
            continue
        matched = {found[a]: a for a in below_a[i]} if i >= 0 else {}
        after: dict[int, list[int]] = {}
        previous = -1
        for a in below_a[i] if i >= 0 else ():
            if found[a] >= 0:
                previous = found[a]
            else:
                after.setdefault(previous, []).append(a)
        order = [(at, -1, a) for a in after.get(-1, ())]
        for b in below_b[j]:
            order.append((at, b, matched.get(b, -1)))
            order += [(at, -1, a) for a in after.get(b, ())]
        todo += reversed(order)
    return out


def _key(tree: Tree) -> tuple[str, bytes]:
    text = json.dumps(tree, separators=(",", ":"))
    return text, hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


BLOCK = "struct<node:int,text:string,side:boolean,main:boolean>"


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, tree (text), tree_id, blocks of every row."""
    block = pa.struct([("node", pa.int32()), ("text", pa.string()), ("side", pa.bool_()), ("main", pa.bool_())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, trees, ids = [], [], []
            for page in batch.column("html").to_pylist():
                tree, found = parse(page or "")
                text, key = _key(tree)
                trees.append(text)
                ids.append(key)
                blocks.append([{"node": n, "text": t, "side": s, "main": m} for n, t, s, m in found])
            columns = [batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(trees, pa.string()), pa.array(ids, pa.binary()), pa.array(blocks, pa.list_(block))]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "host", "tree", "tree_id", "blocks"])

    host = F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), "^[^:/?#]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(read, f"page_id long, url string, host string, tree string, tree_id binary, blocks array<{BLOCK}>")


def _dealt(trees: DataFrame, together: int) -> DataFrame:
    """Add `lot`: a host's trees in lots of about `together`."""
    lots = trees.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / together).alias("lots"))
    return trees.join(lots, "host").withColumn("lot", F.pmod(F.xxhash64("tree_id"), F.col("lots")).cast("long"))


def templates(trees: DataFrame, together: int = 128) -> DataFrame:
    """host, tree: the union of a host's trees, grown by matching one after the other.

    Lots of a host's trees become partial templates, lots of these larger ones, and so on, so
    that no task holds more than about `together` trees, however many a host has.
    """

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        whole: Tree = [[-1, ""]]
        for text in group.sort_values("tree")["tree"]:
            whole = grown(whole, json.loads(text))
        text, key = _key(whole)
        return pd.DataFrame({"host": [group["host"].iloc[0]], "tree_id": [key], "tree": [text]})

    level = trees.select("host", "tree_id", "tree")
    while True:
        level = staged(_dealt(level, together).groupBy("host", "lot").applyInPandas(merge, "host string, tree_id binary, tree string"), "templates")
        if level.groupBy("host").count().filter("count > 1").isEmpty():
            return level.select("host", "tree")


def slots(trees: DataFrame, templates: DataFrame, together: int = 128) -> DataFrame:
    """host, tree_id, slots: for each node of a tree its node of the host's template."""
    schema = "host string, tree_id binary, slots array<int>"

    def place(group: pd.DataFrame, template: pd.DataFrame) -> pd.DataFrame:
        if not len(group):
            return pd.DataFrame({"host": [], "tree_id": [], "slots": []})
        whole = json.loads(template["tree"].iloc[0])
        return pd.DataFrame({"host": group["host"], "tree_id": group["tree_id"], "slots": [align(json.loads(t), whole) for t in group["tree"]]})

    lots = staged(_dealt(trees, together), "tree-lots")
    whole = lots.select("host", "lot").distinct().join(templates, "host").toDF("of_host", "of_lot", "tree")
    return lots.groupBy("host", "lot").cogroup(whole.groupBy("of_host", "of_lot")).applyInPandas(place, schema)


def main_text(pages: DataFrame, share: float = 0.6) -> DataFrame:
    """Per row of `pages` (page_id, url, html): page_id, url, text, n_chars.

    A host's template is the union of the trees of all its pages, grown by simple tree
    matching; each page's nodes are matched with it, which gives every block its slot.  A text
    that stands in a slot on two or more of the host's different pages, and on at least `share`
    of those that fill the slot, is constant: template.  What varies is content, unless
    an element around it says by its tag or a whole class, id or role that it is none
    (see `parse`).  Where articles or main elements hold most of what is left, that is the
    text.  Where constants would take most of an article it is repeated as such, and kept; a page
    that would lose all for them keeps all.  Pages of equal blocks count as one, so copies
    make nothing constant.

    Only distinct trees are matched, in lots; counts are combined before they are
    shuffled and grouped by (host, slot, text), so a host may hold any share of the pages.

    A null html is empty and gives an empty text; pages without a host form one group;
    rows that repeat a page_id are read each; other columns are ignored; an empty table
    gives an empty result.
    """
    rows = staged(parsed(pages), "pages")
    trees = staged(rows.groupBy("host", "tree_id").agg(F.any_value("tree").alias("tree")), "trees")
    placed = staged(slots(trees, templates(trees)), "slots")
    key = lambda b: F.struct(b["node"].alias("node"), F.xxhash64(b["text"]).alias("hash"))
    seen = rows.select("host", "tree_id", F.array_sort(F.array_distinct(F.transform("blocks", key))).alias("keys")).distinct().join(placed, ["host", "tree_id"])
    at = F.transform("keys", lambda k: F.struct(F.get("slots", k["node"]).alias("slot"), k["hash"].alias("hash")))
    counts = seen.select("host", F.explode(at).alias("k")).groupBy("host", "k.slot", "k.hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    filled = seen.select("host", F.explode(F.array_distinct(F.transform(at, lambda k: k["slot"]))).alias("slot")).groupBy("host", "slot").agg(F.count(F.lit(1)).alias("pages"))
    # At most 1 / share texts of a slot are constant.
    constant = staged(counts.join(filled, ["host", "slot"]).filter(F.col("n") >= F.col("pages") * share).select("host", "slot", "hash"), "constants")
    nodes = placed.select("host", "tree_id", F.posexplode("slots").alias("node", "slot")).join(constant, ["host", "slot"])
    constants = staged(nodes.groupBy("host", "tree_id").agg(F.collect_list(F.struct("node", "hash")).alias("constants")), "tree-constants")
    told = rows.drop("tree").join(constants, ["host", "tree_id"], "left")

    def size(blocks: Column) -> Column:
        return F.aggregate(blocks, F.lit(0).cast("long"), lambda n, b: n + F.length(b["text"]))

    none = F.array().cast(f"array<{BLOCK}>")
    varies = lambda blocks: F.filter(blocks, lambda b: ~F.coalesce(F.array_contains("constants", key(b)), F.lit(False)))
    told = told.withColumn("content", F.filter("blocks", lambda b: ~b["side"])).withColumn("main", F.filter("content", lambda b: b["main"]))
    told = told.withColumn("kept", varies(F.col("content"))).withColumn("kept_main", varies(F.col("main")))
    repeated = (F.size("main") > 0) & (size(F.col("kept_main")) * 2 < size(F.col("main"))) & (size(F.col("main")) * 2 > size(F.col("content")))
    mostly = size(F.col("kept_main")) * 2 >= size(F.col("kept"))
    chosen = F.when(repeated, F.col("main")).when((F.size("kept_main") > 0) & mostly, F.col("kept_main")).when(F.size("kept") > 0, F.col("kept")).otherwise(F.col("content"))
    text = F.array_join(F.transform(F.coalesce(chosen, none), lambda b: b["text"]), " ")
    return told.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
