"""Main text of pages by wrapper induction.

A page's tree has its elements as nodes; paragraphs and other items in a row of
one kind are one node. The pages of a host are grouped by layout (the kinds of
their uppermost blocks; layouts with fewer than ``MIN_PAGES`` pages share one
group). One page of each group (by hash of its key) is its reference; the tree
of every page of the group is aligned with it by simple tree matching, exact at
every size and depth. For each node of the reference the texts that the pages
have there are counted over all pages of the group: a text that at least half
of them share is template, what varies is content. Trees are short strings with
hashes for texts, so pages themselves move once, to meet the list of their
template slots. Large groups are split into parts of about ``PART_PAGES`` pages
that each meet a copy of the reference.

Content are the varying slots: of the article or main element where a page has
one, else of the body without blocks of links. Elements and names that say
menu, header, footer, sidebar, notice, advert, form or comment never are, but
for a name on an element that holds most of the varying text and looks like an
article. Several article elements with less than half of the text are teasers.
Where all text of a page is template (its host's pages are copies), the
template is content.

Defined cases: a null html gives an empty text; a null url belongs to no host
and, like a host with fewer than ``MIN_PAGES`` pages, has no template; equal
rows give equal texts, one each; pages of any length are read whole; an empty
table gives no rows; names of further columns don't matter.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm import dom
from sluice.llm import text as tx
from sluice.session import scratch_path

# Marks among the attributes (no name in a page has a space): elements whose
# name doesn't count, articles that are teasers.
HOLDER, TEASER = " holder", " teaser"
MIN_PAGES = 3
SHARE = 0.5
PART_PAGES = 64             # pages that meet one copy of their reference
LINK_SHARE = 0.6            # of a block's text, from which on it is a block of links

# What is never content.
DROPPED = set("head nav footer aside form button select menu dialog object canvas audio video map".split()) | dom.RAW
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|notification|alert|sidebar|"
    r"side|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|comments?|replies|respond|disqus|share|sharing|"
    r"social|related|recommended|newsletter|subscribe|signup|login|popup|modal|overlay|widget|pagination|pager|toolbar|"
    r"copyright|legal|search|skip)(?:$|[\s_-])", re.I)
READERS = re.compile(r"(?:^|[\s_-])(?:comments?|replies|respond|disqus)(?:$|[\s_-])", re.I)
STATES = re.compile(r"(?:^|(?<=\s))(?:has|no|with|without|is|hide|hidden)[_-]\S+|\S+[_-](?:with|without|has|no)[_-]\S+", re.I)


def dropped(node: dom.Node, in_article: bool) -> bool:
    a = node.attributes
    if node.tag in DROPPED or (node.tag == "header" and not in_article):
        return True
    if TEASER in a:
        return True
    if not a or node.tag in ("html", "body", "article", "main") and "comment" not in (a.get("class") or ""):
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none", a.get("style", ""), re.I):
        return True
    return named(node) and not node.attributes.get(HOLDER)


def named(node: dom.Node) -> bool:
    """Has a name that is never content; what a name says an element has or
    lacks (``no-sidebar``) is not its own."""
    a = node.attributes
    return any(NAMES.search(STATES.sub(" ", a[k])) for k in ("class", "id") if a.get(k))


def mark_holders(root: dom.Node, template: set[int]) -> None:
    """Elements that hold most of a page's varying text and look like an article
    (a first heading or three paragraphs) are content whatever their name,
    unless it names comments of readers."""
    weight: dict[int, list[int]] = {}       # own and lower text, first headings, paragraphs
    order, todo = [], [(root, False)]
    while todo:
        node, silent = todo.pop()
        order.append(node)
        silent = silent and node.tag in dom.INLINE or id(node) in template
        texts = 0 if silent else sum(len(c.strip()) for c in node.children if isinstance(c, str))
        weight[id(node)] = [texts, node.tag == "h1", node.tag == "p"]
        todo += [(c, silent) for c in node.children if isinstance(c, dom.Node) and c.tag not in DROPPED]
    for node in reversed(order):
        if node.parent is not None:
            for k, w in enumerate(weight[id(node)]):
                weight[id(node.parent)][k] += w
    total = weight[id(root)][0]
    for node in order:
        held, headings, paragraphs = weight[id(node)]
        if 2 * held > total and (headings or paragraphs >= 3) and named(node) and not any(
                READERS.search(node.attributes.get(k) or "") for k in ("class", "id")):
            node.attributes[HOLDER] = "1"


def blocks(nodes: list[dom.Node], template: set[int], links: bool) -> list[str]:
    """Texts of the blocks below the nodes, in page order. ``template`` has the
    ids of nodes whose own text is left out; ``links`` leaves out link blocks."""
    out: list[str] = []
    now: list[str] = []
    linked = [0]

    def flush():
        whole = " ".join("".join(now).split())
        if whole and not (links and linked[0] >= LINK_SHARE * len(whole)):
            out.append(whole)
        now.clear()
        linked[0] = 0

    END = object()
    todo: list = [(n, False, n.tag in ("article", "main"), False) for n in reversed(nodes)]
    while todo:
        item, in_link, in_article, silent = todo.pop()
        if item is END:
            flush()
        elif isinstance(item, str):
            if not silent:
                now.append(item)
                linked[0] += len(item) if in_link else 0
        elif item.tag == "br":
            now.append("\n")
        elif not dropped(item, in_article):
            block = item.tag not in dom.INLINE
            if block:
                flush()
                silent = id(item) in template
                todo.append((END, False, False, False))
            in_article = in_article or item.tag in ("article", "main")
            todo += [(c, in_link or item.tag == "a", in_article, silent) for c in reversed(item.children)]
        elif item.tag not in dom.INLINE:
            flush()
    flush()
    return out


def _articles(root: dom.Node) -> list[dom.Node]:
    """The outermost article and main elements that may be content."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        for c in reversed(node.children):
            if isinstance(c, dom.Node):
                todo.append(c)
        if node.tag in ("article", "main"):
            del todo[len(todo) - sum(isinstance(c, dom.Node) for c in node.children):]
            if not dropped(node, False):
                found.append(node)
        elif node is not root and dropped(node, False):
            del todo[len(todo) - sum(isinstance(c, dom.Node) for c in node.children):]
    return found


def main_text(source: str | None, template_slots: list[int]) -> str:
    root = dom.parse(source or "")
    template: set[int] = set()
    if template_slots:
        wanted, todo = set(template_slots), [dom.collapse(root)]
        while todo:
            slot = todo.pop()
            if slot.number in wanted:
                template.update(map(id, slot.nodes))
            todo += slot.children
    articles = _articles(root)
    if not articles:
        mark_holders(root, template)
    elif len(articles) > 1 and all(a.tag == "article" for a in articles):
        held, whole = (sum(map(len, blocks(n, template, True))) for n in (articles, [root]))
        if 2 * held < whole:            # teasers beside the main text
            for a in articles:
                a.attributes[TEASER] = ""
            articles = []
            mark_holders(root, template)
    for leave in ([template, set()] if template else [template]):
        for nodes, links in ((articles, False), ([root], True), ([root], False)):
            if nodes:
                got = blocks(nodes, leave, links)
                if got:
                    return " ".join(got)
    return ""


def flat_tree(source: str | None) -> tuple[list[str], list[int], list[int]]:
    """Kind, parent (-1: none) and hash of the own text (0: none) of the slots of
    a page in preorder."""
    kinds, parents, texts = [], [], []
    todo = [(dom.collapse(dom.parse(source or "")), -1)]
    while todo:
        slot, parent = todo.pop()
        kinds.append(slot.kind), parents.append(parent)
        own = dom.own_text(slot)
        texts.append(xxhash.xxh3_64_intdigest(own) >> 1 if own else 0)
        todo += [(c, slot.number) for c in reversed(slot.children)]
    return kinds, parents, texts


def layout(kinds: list[str], parents: list[int]) -> int:
    """Number of a page's layout: the kinds from the root down to the first node
    below the body (or root) with several kinds of children, and these kinds."""
    children: dict[int, list[int]] = {}
    for node, parent in enumerate(parents):
        children.setdefault(parent, []).append(node)
    here = next((n for n, k in enumerate(kinds) if k.split(".")[0] == "body"), 0)
    path = [kinds[here]]
    while len(children.get(here, ())) == 1:
        here = children[here][0]
        path.append(kinds[here])
    return xxhash.xxh3_64_intdigest("\n".join([*path, "", *sorted({kinds[c] for c in children.get(here, ())})])) >> 1


def tree(flat: tuple[list[str], list[int], list[int]]) -> str:
    """A flat tree as JSON: distinct kinds, their numbers, parents, texts."""
    kinds, parents, texts = flat
    number: dict[str, int] = {}
    codes = [number.setdefault(k, len(number)) for k in kinds]
    return json.dumps([list(number), codes, parents, texts], separators=(",", ":"), ensure_ascii=False)


def read_tree(stored: str) -> tuple[list[str], list[int], list[int]]:
    names, codes, parents, texts = json.loads(stored)
    return [names[c] for c in codes], parents, texts


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def template_slots(pages: DataFrame) -> DataFrame:
    """``key, host, slots``: numbers of the template slots of the pages ``key,
    host, html`` that have some."""
    def read(batches):
        for batch in tx.slices(batches, "html"):
            flat = [flat_tree(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("host"), pa.array([layout(k, p) for k, p, _ in flat], pa.int64()),
                 pa.array([tree(f) for f in flat], pa.string())], ["key", "host", "layout", "tree"])

    trees = _written(pages.select("key", "host", "html").filter("host <> ''")
                     .mapInArrow(read, "key long, host string, layout long, tree string"), "trees")
    # Layouts with too few pages for a template share one group of their host.
    # A group is split into parts of bounded size, each with its own copy of the
    # reference.
    group = F.when(F.col("count") >= MIN_PAGES, F.col("layout")).otherwise(F.lit(-1)).alias("group")
    sizes = trees.groupBy("host", "layout").count().select("host", "layout", "count", group)
    sizes = sizes.withColumn("pages", F.sum("count").over(Window.partitionBy("host", "group"))).filter(f"pages >= {MIN_PAGES}")
    parts = F.ceil(F.col("pages") / PART_PAGES)
    placed = trees.join(sizes.drop("count"), ["host", "layout"]).withColumn("part", F.pmod("key", parts))
    # The references: cut to one row a group before the shuffle.
    nth = F.row_number().over(Window.partitionBy("host", "group").orderBy("key"))
    references = placed.withColumn("nth", nth).filter("nth = 1").select(
        "host", "group", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), F.col("tree").alias("reference"))

    def compare(batches):
        for batch in batches:
            keys, hosts, groups, at, theirs, slots = [], [], [], [], [], []
            for key, host, group, own, reference in zip(
                    *(batch.column(c).to_pylist() for c in ("key", "host", "group", "tree", "reference"))):
                kinds, parents, texts = read_tree(own)
                for a, b in dom.align((kinds, parents), read_tree(reference)[:2]):
                    if texts[a]:
                        keys.append(key), hosts.append(host), groups.append(group)
                        at.append(b), theirs.append(texts[a]), slots.append(a)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(hosts, pa.string()), pa.array(groups, pa.int64()), pa.array(at, pa.int32()),
                 pa.array(theirs, pa.int64()), pa.array(slots, pa.int32())], ["key", "host", "group", "node", "text", "slot"])

    aligned = _written(placed.join(references, ["host", "group", "part"]).select("key", "host", "group", "tree", "reference").mapInArrow(
        compare, "key long, host string, group long, node int, text long, slot int"), "aligned")
    common = (aligned.groupBy("host", "group", "node", "text").count().filter(f"count >= {MIN_PAGES}")
              .join(sizes.select("host", "group", "pages").distinct(), ["host", "group"])
              .filter(F.col("count") >= SHARE * F.col("pages")).select("host", "group", "node", "text"))
    return (aligned.join(common, ["host", "group", "node", "text"])
            .groupBy("key", "host").agg(F.collect_set("slot").alias("slots")))


def main_texts(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``row`` (the input row without its html) and ``text``."""
    others = [F.col(f"`{c}`") for c in pages.columns if c != html]
    source = F.col(f"`{html}`").cast("string")
    rows = pages.select(F.struct(*others).alias("row"), F.col(f"`{url}`").cast("string").alias("url"), source.alias("html"),
                        F.xxhash64(*others, source).alias("key"))       # equal rows have equal slots
    rows = rows.withColumn("host", F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)))
    joined = rows.join(template_slots(rows), ["key", "host"], "left").select("row", "html", "slots")
    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType())])

    def run(batches):
        for batch in tx.slices(batches, "html"):
            texts = [main_text(h, s) for h, s in zip(batch.column("html").to_pylist(), batch.column("slots").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    return joined.mapInArrow(run, schema)


def op4_wrapper_induction(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return main_texts(pages).select(F.col("row.page_id").alias("page_id"), F.col("row.url").alias("url"), "text",
                                    F.length("text").cast("long").alias("n_chars"))
