"""Near-duplicate classes by ProbMinHash.

A document is the weighted set of its shingles of five words, the weight being
the count. Every shingle is a Poisson process whose rate is its weight; each of
its arrivals goes to one of ``BANDS * ROWS`` registers, and a register keeps the
shingle that arrives first. Two documents agree in a register with the
probability Jaccard similarity of their weighted sets. Arrivals are seeded by
the shingle alone. A document stops (early termination) at a time by which all
registers are full with high probability - the time goes down with its total
weight, so long documents draw about as many arrivals as short ones - and the
few documents with an empty register go on to twice the time.

Documents with the same words are one node (the least doc_id of them). Nodes
that share a band are candidates. The members of a bucket that fits one block
(``BLOCK_BYTES``) are compared in a task, all with all: similarities as matrices,
of which a spanning forest of the links is emitted. Buckets with the same members
are compared once. Links give classes by connected components.

A larger bucket is first led by the member with the least hash, a hash of the
node alone, so that the buckets of a group have the same leader; its members are
verified against it, and those in no leader's class go on with another hash as
long as more of them are left than a block holds and a turn has joined a quarter
of them. Then all nodes of the large buckets that still hold two classes are
compared with all others of their bucket: they stand in blocks bounded by their
bytes, and a task gets two blocks and emits the forest between them. Blocks that
hold one and the same class are not paired. No table has a row for a pair of
nodes but for the pairs with a leader, nearly one a node. The class id is the
least doc_id.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a text of one to
four words is one shingle; a null or empty text has none and is a class of its
own; texts are handled whole; rows with equal doc_id are one document, of which
the text with the least hash of its words counts; a null doc_id takes the class
of an equal text, else null; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm import graph
from sluice.llm import text as tx
from sluice.session import scratch_path

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5         # a pair at 0.8 shares no band with a chance of 7e-5
BLOCK_BYTES = 4 << 20       # of the shingles of a block, about
NODE_BYTES = 4 << 10        # that a node counts besides its shingles: at most 1,024 nodes in a block, about
COLUMNS = 1 << 12           # shingles of a matrix at a time
HASH_BITS = 44              # of a shingle in a signature; the rest of 64 bits names the text in a slice
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of the splitmix64 generator."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(w: tx.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and 64-bit hash of each shingle, and the hash of each word."""
    words = tx.hashes(w.distinct)[w.codes] if len(w.codes) else np.zeros(0, np.uint64)
    doc = tx.owners(w.offsets)
    n = np.diff(w.offsets)
    size = np.where(n >= SHINGLE, SHINGLE, n)
    starts = np.arange(len(words)) + size[doc] <= w.offsets[1:][doc]
    out = np.zeros(len(words), np.uint64)
    for s in range(1, SHINGLE + 1):
        if (size == s).any():
            own = size[doc] == s
            out[own] = tx.gram_hashes(words, s)[own]
    return doc[starts], out[starts], words


def weighted(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash (``HASH_BITS``) and count of the distinct shingles of each text."""
    keys = np.sort((doc.astype(np.uint64) << np.uint64(HASH_BITS)) | (hashes >> np.uint64(64 - HASH_BITS)))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    count = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return ((keys >> np.uint64(HASH_BITS)).astype(np.int64), keys & np.uint64((1 << HASH_BITS) - 1), count)


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    """Shingle in each register of each text; -1 for a text without shingles."""
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    stop = registers * (math.log(registers) + 4) / np.maximum(total, 1)
    out = np.full((n_docs, registers), np.iinfo(np.uint64).max, np.uint64)
    todo = total > 0
    while todo.any():
        own = np.flatnonzero(todo[doc])
        time = np.zeros(len(own))
        base = _mix(element[own] + GOLDEN)
        best = np.full(n_docs * registers, np.inf)
        slots, times, who = [], [], []
        step = 0
        while len(own):
            step += 1
            with np.errstate(over="ignore"):
                random = _mix(base + np.uint64(2 * step) * GOLDEN)
                place = _mix(base + np.uint64(2 * step + 1) * GOLDEN)
            uniform = ((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
            time = time - np.log(uniform) / weight[own]
            going = time <= stop[doc[own]]
            own, time, base, place = own[going], time[going], base[going], place[going]
            slot = doc[own] * registers + ((place >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
            np.minimum.at(best, slot, time)
            first = best[slot] == time              # others can't be the first of their register
            slots.append(slot[first])
            times.append(time[first])
            who.append(own[first])
        slots, times, who = map(np.concatenate, (slots, times, who))
        first = best[slots] == times
        full = np.isfinite(best).reshape(n_docs, registers).all(axis=1)
        flat = out.reshape(-1)
        flat[slots[first]] = element[who[first]]
        stop = stop * 2
        todo = todo & ~full
    return out


def bands(signature: np.ndarray, n_bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(signature), n_bands), np.uint64)
    for k in range(n_bands):
        key = np.full(len(signature), k + 1, np.uint64)
        for r in range(rows):
            with np.errstate(over="ignore"):
                key = _mix(key * GOLDEN + signature[:, k * rows + r])
        out[:, k] = key
    return out.view(np.int64)


def contents(data: bytes, offsets: np.ndarray) -> list[bytes | None]:
    """Hash of the words of each text, None without words."""
    return [xxhash.xxh3_128_digest(data[8 * a:8 * b]) if b > a else None
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def signed(docs: DataFrame, n_bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, content`` (hash of the words, null without words), ``buckets``
    and ``size`` (shingles, repeats included) of ``doc_id, text``."""
    def run(batches):
        for batch in tx.slices(batches, "text"):
            w = tx.words(batch.column("text"))
            n_docs = len(w.offsets) - 1
            doc, hashes, words = shingles(w)
            sig = signatures(*weighted(doc, hashes), n_docs, n_bands * rows)
            keys = bands(sig, n_bands, rows)
            data = words.tobytes()
            content = contents(data, w.offsets)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n_docs + 1, dtype=np.int32) * n_bands), pa.array(keys.reshape(-1)))
            size = np.bincount(doc, minlength=n_docs)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(content, pa.binary()), lists, pa.array(size)],
                                             ["doc_id", "content", "buckets", "size"])

    return docs.mapInArrow(run, "doc_id long, content binary, buckets array<long>, size long")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``node``, its ``content`` and its sorted 64-bit shingle hashes (each as
    often as the shingle) of ``doc_id, text``."""
    def run(batches):
        for batch in tx.slices(batches, "text"):
            w = tx.words(batch.column("text"))
            doc, hashes, words = shingles(w)
            order = np.lexsort((hashes, doc))
            cut = np.searchsorted(doc[order], np.arange(len(w.offsets)))
            data = hashes[order].astype("<u8").tobytes()
            sets = [data[8 * a:8 * b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(contents(words.tobytes(), w.offsets), pa.binary()),
                 pa.array(sets, pa.binary())], ["node", "content", "shingles"])

    return docs.mapInArrow(run, "node long, content binary, shingles binary")


def similarity(a: bytes, b: bytes) -> float:
    """Exact probability Jaccard similarity of two multisets of shingles:
    the sum, over shared i, of 1 / sum_j max(x_j / x_i, y_j / y_i)."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    if not len(x) or not len(y):
        return 0.0
    both, side = np.unique(np.concatenate([x, y]), return_inverse=True)
    cx = np.bincount(side[:len(x)], minlength=len(both))
    cy = np.bincount(side[len(x):], minlength=len(both))
    shared = (cx > 0) & (cy > 0)
    if cx.max() == 1 and cy.max() == 1:
        return float(shared.sum()) / len(both)
    # Shingles with equal counts in both are alike.
    kinds, sizes = np.unique(np.stack([cx, cy], axis=1), axis=0, return_counts=True)
    own = kinds[(kinds > 0).all(axis=1)]
    if not len(own):
        return 0.0
    count = sizes[(kinds > 0).all(axis=1)]
    total = np.maximum(kinds[None, :, 0] / own[:, None, 0], kinds[None, :, 1] / own[:, None, 1]) @ sizes
    return float((count / total).sum())


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The labels ``u, v`` of the pairs ``node, label, leader, leader_label``
    that are near. The sets of the nodes move to their leaders; AQE splits a
    leader of very many."""
    mine = pairs.join(sets, "node").withColumnRenamed("shingles", "own")
    both = mine.join(sets.withColumnRenamed("node", "leader"), "leader")

    def run(batches):
        for batch in batches:
            near = [similarity(a, b) >= least for a, b in zip(batch.column("own").to_pylist(), batch.column("shingles").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("leader_label")],
                                             ["u", "v"]).filter(pa.array(near, pa.bool_()))

    return both.select("label", "leader_label", "own", "shingles").mapInArrow(run, "u long, v long")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _led(members: DataFrame, turn: int) -> DataFrame:
    """``node, label, leader, leader_label`` of the members ``bucket, node,
    label`` that have not the label of the leader of one of their buckets."""
    order = F.struct(F.xxhash64("node", F.lit(turn)).alias("o"), "node", "label")
    leaders = (members.groupBy("bucket").agg(F.min(order).alias("first"), F.min("label").alias("a"), F.max("label").alias("b"))
               .filter("a <> b").select("bucket", F.col("first.node").alias("leader"), F.col("first.label").alias("leader_label")))
    # Written, so that AQE can split the join where a bucket has very many members.
    led = members.join(_written(leaders, "leaders"), "bucket").filter("label <> leader_label")
    return _written(led.select("node", "label", "leader", "leader_label").distinct(), "led")


def _renamed(df: DataFrame, new: DataFrame, *columns: str) -> DataFrame:
    """Labels of the columns replaced by those that ``new`` (``node, label``) gives them."""
    for c in columns:
        now = new.select(F.col("node").alias(c), F.col("label").alias("now"))
        df = df.join(now, c, "left").withColumn(c, F.coalesce("now", c)).select(*df.columns)
    return df


def _labels(labels: DataFrame | None, new: DataFrame) -> DataFrame:
    if labels is None:
        return new
    return _written(_renamed(labels, new, "label").union(new.join(labels, "node", "left_anti")), "labels")


def blocks(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The members ``bucket, node, label, size`` of buckets with two or more
    labels, in blocks of about ``BLOCK_BYTES``: ``bucket, owner, part, rows``
    (label and shingles). A label with half a block or more has blocks of its
    own, which it owns; the others of a bucket share theirs."""
    cost = F.sum(F.col("size") * 8 + NODE_BYTES)
    own = members.groupBy("bucket", "label").agg(cost.alias("cost"))
    small = F.col("cost") <= BLOCK_BYTES // 2
    buckets = own.groupBy("bucket").agg(F.count("*").alias("labels"), F.sum(F.when(small, F.col("cost"))).alias("shared"))
    layout = own.join(buckets.filter("labels > 1"), "bucket").select(
        "bucket", "label", F.when(~small, F.col("label")).alias("owner"),
        F.ceil(F.when(small, F.col("shared")).otherwise(F.col("cost")) / BLOCK_BYTES).alias("parts"))
    # Written, so that AQE can split the join where a label has very many members.
    placed = members.join(_written(layout, "layout"), ["bucket", "label"]).select(
        "bucket", "owner", "node", "label",
        F.expr("pmod(xxhash64(if(owner is null, label, node)), parts)").alias("part"))
    return (placed.join(sets, "node").groupBy("bucket", "owner", "part")
            .agg(F.collect_list(F.struct("label", "shingles")).alias("rows")))


def block_pairs(table: DataFrame) -> DataFrame:
    """``rows, others`` of every two blocks of a bucket that can hold unlike
    labels, and of each shared block alone (``others`` null)."""
    a = table.select("bucket", "owner", F.struct("owner", "part").alias("key"), "rows")
    b = table.select("bucket", F.col("owner").alias("owner2"), F.struct("owner", "part").alias("key2"), F.col("rows").alias("others"))
    alike = F.coalesce(F.col("owner") == F.col("owner2"), F.lit(False))
    return a.join(b, "bucket").filter((F.col("key") <= F.col("key2")) & ~alike).select(
        "rows", F.when(F.col("key") != F.col("key2"), F.col("others")).alias("others"))


class Nodes:
    """The nodes of a block: labels, and distinct shingles with their counts as
    flat arrays."""

    def __init__(self, rows):
        self.sets = rows.field("shingles").to_pylist()
        self.labels = rows.field("label").to_numpy(zero_copy_only=False)
        lengths = np.array([len(x) // 8 for x in self.sets], np.int64)
        flat = np.frombuffer(b"".join(self.sets), "<u8")
        owner = np.repeat(np.arange(len(self.sets)), lengths)
        first = np.flatnonzero(np.concatenate([[True], (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])])) if len(flat) else np.zeros(0, int)
        self.token, self.owner = flat[first], owner[first]
        self.count = np.diff(np.append(first, len(flat)))
        self.total = lengths
        self.single = np.bincount(self.owner, weights=self.count > 1, minlength=len(self.sets)) == 0


def shared_weights(x: Nodes, y: Nodes) -> tuple[np.ndarray, np.ndarray]:
    """For each node of ``x`` and of ``y`` the weight, in ``x`` and in ``y``,
    of the shingles that both have."""
    both = np.intersect1d(x.token, y.token)
    in_x, in_y = np.zeros((len(x.sets), len(y.sets))), np.zeros((len(x.sets), len(y.sets)))

    def placed(n):
        at = np.searchsorted(both, n.token)
        at[at == len(both)] = 0
        found = both[at] == n.token if len(both) else np.zeros(len(n.token), bool)
        order = np.argsort(at[found], kind="stable")
        return at[found][order], n.owner[found][order], n.count[found][order]

    px, py = placed(x), placed(y)
    weights = not (x.single.all() and y.single.all())
    for start in range(0, len(both), COLUMNS):
        def matrix(p, n):
            a, b = np.searchsorted(p[0], [start, start + COLUMNS])
            has = np.zeros((len(n.sets), min(COLUMNS, len(both) - start)), np.float32)
            has[p[1][a:b], p[0][a:b] - start] = 1
            if not weights:
                return has, has
            weight = np.zeros_like(has)
            weight[p[1][a:b], p[0][a:b] - start] = p[2][a:b]
            return has, weight
        (has_x, weight_x), (has_y, weight_y) = matrix(px, x), matrix(py, y)
        in_x += weight_x @ has_y.T
        in_y = in_x if not weights else in_y + has_x @ weight_y.T
    return in_x, in_y


def forest(x: Nodes, y: Nodes | None, least: float) -> list[tuple[int, int]]:
    """Links between unlike labels of the nodes of two blocks (or within one)
    that connect all labels which any links connect.

    With P and Q the shares of two nodes' weights in shingles of both, the
    similarity is at most 1 / (1/P + 1/Q - 1), and that where no shingle is
    repeated."""
    alone = y is None
    y = x if alone else y
    in_x, in_y = shared_weights(x, y)
    with np.errstate(divide="ignore", invalid="ignore"):
        bound = 1 / (x.total[:, None] / in_x + y.total[None, :] / in_y - 1)
    near = (bound >= least - 1e-9) & (in_x > 0) & (x.labels[:, None] != y.labels[None, :])
    i, j = np.nonzero(np.triu(near, 1) if alone else near)
    order = np.argsort(-bound[i, j], kind="stable")
    i, j = i[order], j[order]
    parent: dict[int, int] = {}

    def root(k):
        while parent.setdefault(k, k) != k:
            parent[k] = k = parent[parent[k]]
        return k

    out: list[tuple[int, int]] = []
    single = x.single[i] & y.single[j]
    shared = in_x[i, j]
    jaccard = shared / (x.total[i] + y.total[j] - shared)
    for a, b, u, v, exact, value in zip(i.tolist(), j.tolist(), x.labels[i].tolist(), y.labels[j].tolist(), single.tolist(),
                                        jaccard.tolist()):
        ru, rv = root(u), root(v)
        if ru != rv and (value if exact else similarity(x.sets[a], y.sets[b])) >= least:
            parent[ru] = rv
            out.append((u, v))
    return out


def block_links(pairs: DataFrame, least: float) -> DataFrame:
    """The forests ``u, v`` of all pairs of blocks. A pair is one row; Arrow
    batches are bounded by their bytes."""
    def run(batches):
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                rows, others = batch.column("rows")[k], batch.column("others")[k]
                out += forest(Nodes(rows.values), Nodes(others.values) if others.is_valid else None, least)
            u, v = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return pairs.mapInArrow(run, "u long, v long")


def small_links(members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The forests ``u, v`` of nodes of all buckets ``bucket, node`` that fit a
    block; of buckets with the same members one is compared."""
    lists = members.groupBy("bucket").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    once = lists.groupBy("nodes").agg(F.min("bucket").alias("bucket"))
    rows = once.select("bucket", F.explode("nodes").alias("node")).join(sets, "node")
    table = rows.groupBy("bucket").agg(F.collect_list(F.struct(F.col("node").alias("label"), "shingles")).alias("rows"))
    return block_links(table.select("rows", F.lit(None).cast(table.schema["rows"].dataType).alias("others")), least)


def with_labels(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("label", F.col("node"))
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def linked(nodes: DataFrame, sets_of, least: float) -> DataFrame | None:
    """``node, label`` of the nodes that have a link, of ``node, content,
    buckets, size``. ``sets_of`` gives the shingles of nodes."""
    every = nodes.select("node", "size", F.explode("buckets").alias("bucket"))
    cost = F.sum(F.col("size") * 8 + NODE_BYTES)
    shared = every.groupBy("bucket").agg(F.count("*").alias("n"), (cost > BLOCK_BYTES).alias("large")).filter("n > 1").drop("n")
    members = _written(every.join(_written(shared, "shared"), "bucket"), "members")
    sets = _written(sets_of(nodes.join(members.select("node").distinct(), "node", "left_semi")), "shingles")
    new = graph.components(small_links(members.filter("not large"), sets, least))
    labels = None if new is None else _written(new, "labels")
    large = members.filter("large").drop("large")
    if large.isEmpty():
        return labels
    large = _written(with_labels(large, labels), "large")
    open_rows, was = large, None
    for turn in itertools.count():
        pairs = _led(open_rows, turn)
        new = graph.components(verified(pairs, sets, least))
        if new is not None:
            labels = new if labels is None else _labels(labels, new)
            pairs = _renamed(pairs, new, "label", "leader_label")
            large = _written(_renamed(large, new, "label"), "large")
        left = _written(pairs.filter("label <> leader_label").select("node").distinct(), "left")
        open_rows = large.join(left, "node")
        most = open_rows.groupBy("bucket").agg(cost.alias("cost")).agg(F.max("cost")).first()[0] or 0
        is_now = left.count()
        if most <= BLOCK_BYTES or was is not None and is_now > 0.75 * was:
            break
        was = is_now
    table = _written(blocks(large, sets), "blocks")
    new = graph.components(block_links(block_pairs(table), least))
    return labels if new is None else new if labels is None else _labels(labels, new)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id`` of each document, and of each row without doc_id."""
    return _classes(docs, doc_id, text, least).select("doc_id", "class_id")


def _classes(docs: DataFrame, doc_id: str, text: str, least: float) -> DataFrame:
    """Besides, the number of ``rows`` that the document has."""
    plain = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    sign = _written(signed(plain), "signatures")
    of_id = (sign.filter("doc_id is not null").groupBy("doc_id")
             .agg(F.min("content").alias("content"), F.count("*").alias("rows")))
    without = sign.filter("doc_id is null").select("doc_id", "content", F.lit(1).cast("long").alias("rows"))
    chosen = _written(of_id.unionByName(without), "contents")
    # Buckets and size depend on the content alone.
    by_content = (sign.filter("content is not null").groupBy("content")
                  .agg(F.first("buckets").alias("buckets"), F.first("size").alias("size")))
    least_id = chosen.filter("content is not null").groupBy("content").agg(F.min("doc_id").alias("node")).filter("node is not null")
    nodes = _written(least_id.join(by_content, "content"), "nodes")

    def sets_of(wanted: DataFrame) -> DataFrame:
        wanted = wanted.select(F.col("node").alias("doc_id"))
        sets = shingle_sets(plain.join(wanted, "doc_id", "left_semi").select("doc_id", "text"))
        # Of several texts the one that counts.
        return sets.filter("content is not null").groupBy("node").agg(F.min_by("shingles", "content").alias("shingles"))

    labels = linked(nodes, sets_of, least)
    of_content = nodes.select("content", F.col("node").alias("class_id"))
    if labels is not None:
        of_content = nodes.select("content", "node").join(labels, "node", "left").select(
            "content", F.coalesce("label", "node").alias("class_id"))
    return chosen.join(of_content, "content", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), "rows")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The documents that give their class its id, one row each (of several
    that with the least text, then the least other columns); rows without
    doc_id stay."""
    kept = _written(_classes(docs, doc_id, text, least).filter("doc_id = class_id").select(
        F.col("doc_id").alias(doc_id), (F.col("rows") > 1).alias("__repeated")), "kept")
    found = docs.join(kept.filter("not __repeated").select(doc_id), doc_id, "left_semi")
    if not kept.filter("__repeated").isEmpty():
        again = docs.join(kept.filter("__repeated").select(doc_id), doc_id, "left_semi")
        others = [F.col(f"`{f.name}`").asc_nulls_first() for f in docs.schema.fields
                  if f.name not in (doc_id, text) and isinstance(f.dataType, T.AtomicType)]
        order = Window.partitionBy(F.col(f"`{doc_id}`")).orderBy(F.col(f"`{text}`").asc_nulls_first(), *others)
        again = again.withColumn("__place", F.row_number().over(order)).filter("__place = 1").drop("__place")
        found = found.select(*docs.columns).union(again.select(*docs.columns))
    return found.select(*docs.columns).union(docs.filter(F.col(f"`{doc_id}`").isNull()))


def op10_probminhash_classes(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return classes(docs)
