"""N-gram Jaccard join: fixed MinHash bands in place of an LSH forest, then exact verification.

Documents are sets of five-word shingles. Documents with one set form a node, so copies never meet
each other. Nodes meet if they agree in all MinHash values of one of 36 bands. There are no sorted
prefix trees and nothing adapts to the data: the length of a band, called the depth, is the longest at
which the chance of meeting, at the threshold, reaches the target recall, worked out once. Nodes that meet are compared by short sketches, in blocks; what may be
similar is gathered into groups, within which shingle sets are compared exactly, in blocks as well.
No pairs are written: a block gives the number of links of its nodes and a spanning forest of them.

Defined results: a null text is an empty one, and empty texts are copies of each other; a text of
fewer than five words is one shingle; letters A-Z count as a-z; a class is named by its smallest id
(null ids count as the largest); rows that repeat an id are told apart by their texts; an empty table
gives an empty result; further columns don't matter, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citygrain.llm.columns import plain_names
from citygrain.llm.components import components
from citygrain.llm.words import MinHash, lowered, shingle_hashes, slices, text_bytes, word_hashes
from citygrain.session import staged

THRESHOLD = 0.8
TARGET_RECALL = 0.9995
TREES = 36
DEPTH = 12

#: Sketch of a node: so many places of one byte. So many must agree to go on that a pair at the
#: threshold is lost by it in SKETCH_LOSS of all cases at most.
SKETCH = 128
SKETCH_LOSS = 1e-8

#: Nodes of a prefix, and shingles of a group, that are compared in one block.
BLOCK_NODES = 2048
BLOCK_SHINGLES = 1 << 21
MOST_GROUP_NODES = 512

#: Rows of a list that is broadcast at most, about 50 bytes each.
BROADCAST_ROWS = 200_000


def matched_depth(trees: int = TREES, depth: int = DEPTH, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> int:
    """The longest prefix at which two sets of that similarity meet in some tree with that chance."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def least_agreeing(threshold: float) -> int:
    """Places of a sketch that must agree: fewer do, at that similarity, in SKETCH_LOSS of all cases at most."""
    share, lost = min(1.0, max(0.0, threshold)), 0.0
    for places in range(SKETCH + 1):
        lost += comb(SKETCH, places) * share**places * (1 - share) ** (SKETCH - places)
        if lost > SKETCH_LOSS:
            return places
    return SKETCH


def nodes_of(column: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Place, node (digest of the shingle set) and sorted shingle set of every text."""
    data, offsets = text_bytes(column)
    for low, high in slices(offsets):
        words, first = word_hashes(lowered(data[offsets[low] : offsets[high]]), offsets[low : high + 1] - offsets[low])
        shingles, begins = shingle_hashes(words, first)
        for text in range(high - low):
            own = np.unique(shingles[begins[text] : begins[text + 1]])
            yield low + text, hashlib.blake2b(own.tobytes(), digest_size=16).digest(), own


def signed_nodes(docs: DataFrame, depth: int) -> DataFrame:
    """(doc_id, node, prefixes, sketch): the key in every tree and the sketch of every text's set."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(max(SKETCH, TREES * depth), seed=23)
        factors = np.random.default_rng(5).integers(1, 1 << 62, depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            nodes, prefixes, sketches = [], [], []
            for _, node, own in nodes_of(batch.column("text")):
                minima = hasher.signature(own)
                nodes.append(node)
                keys = (minima[: TREES * depth].reshape(TREES, depth).astype(np.uint64) * factors).sum(axis=1, dtype=np.uint64)
                prefixes.append(keys.view(np.int64))
                sketches.append(((minima[:SKETCH] * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes())
            if nodes:
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(nodes) + 1) * TREES, pa.int32()), pa.array(np.concatenate(prefixes))
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(nodes, pa.binary()), lists, pa.array(sketches, pa.binary())],
                    ["doc_id", "node", "prefixes", "sketch"],
                )

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(signed, "doc_id long, node binary, prefixes array<long>, sketch binary")


def _forest(pairs: np.ndarray, count: int) -> np.ndarray:
    """Spanning forest, as rows of ``pairs``, of the graph on 0..count-1."""
    parent = list(range(count))
    kept = []
    for place, (one, two) in enumerate(pairs.tolist()):
        while parent[one] != one:
            parent[one] = parent[parent[one]]
            one = parent[one]
        while parent[two] != two:
            parent[two] = parent[parent[two]]
            two = parent[two]
        if one != two:
            parent[one] = two
            kept.append(place)
    return pairs[kept]


def _alike(left: np.ndarray, right: np.ndarray, same: bool, least: int) -> np.ndarray:
    """Index pairs of sketches that agree in at least so many places; ``same``: of one block with itself."""
    found = []
    for row in range(len(left)):
        begin = row + 1 if same else 0
        agreed = (left[row][None, :] == right[begin:]).sum(axis=1)
        hits = np.flatnonzero(agreed >= least) + begin
        if len(hits):
            found.append(np.stack([np.full(len(hits), row), hits], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)


def _in_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows with equal keys together, from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in keys]
        rows = list(zip(*columns, strict=True))
        begin = 0
        for row in range(len(rows) + 1):
            if row == len(rows) or rows[row] != last:
                if row > begin:
                    held.append(batch.slice(begin, row - begin))
                if row < len(rows):
                    if held:
                        yield pa.Table.from_batches(held)
                    held, last, begin = [], rows[row], row
    if held:
        yield pa.Table.from_batches(held)


def _blocked(frame: DataFrame, group: str, place: str, size: str) -> DataFrame:
    """Rows for every pair of blocks of a group that a row takes part in, with its ``side``.

    ``place`` numbers the rows of a group and ``size`` is how many make a block; a group of one
    block stays one row each.
    """
    blocks = F.ceil(F.col("_count") / F.col(size)).cast("int")
    own = F.floor(F.col(place) / F.col(size)).cast("int")
    return (
        frame.withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumns({"_own": own, "low": F.least(own, F.col("_other")), "high": F.greatest(own, F.col("_other"))})
        .withColumn("side", F.when(F.col("_own") == F.col("low"), 0).otherwise(1))
    )


def _candidate_edges(nodes: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) that connect, within every prefix of every tree, the numbers of nodes whose sketches agree."""
    met = nodes.select("number", F.posexplode("prefixes").alias("tree", "prefix"))
    met = met.select("number", F.xxhash64("tree", "prefix").alias("key"))
    shared = staged(met.groupBy("key").agg(F.count(F.lit(1)).alias("_count")).where("_count > 1"), "prefixes")
    few = shared.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    members = met.join(F.broadcast(shared) if few else shared, "key")
    # A hash of the node spreads a large prefix over its blocks; no row number is needed.
    members = members.join(nodes.select("number", "sketch"), "number")
    members = members.withColumns(
        {
            "_place": F.pmod(F.xxhash64("number", "key"), F.col("_count")),
            "_block": F.lit(BLOCK_NODES),
        }
    )
    blocked = _blocked(members, "key", "_place", "_block").select("key", "low", "high", "side", "number", "sketch")

    least = least_agreeing(threshold)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = [], []
        for run in _in_runs(batches, ["key", "low", "high"]):
            names = run.column("number").to_pylist()
            sketches = np.frombuffer(b"".join(run.column("sketch").to_pylist()), dtype=np.uint8).reshape(len(names), SKETCH)
            if run.column("low")[0] == run.column("high")[0]:
                pairs = _alike(sketches, sketches, True, least)
            else:
                side = run.column("side").to_numpy()
                one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                pairs = _alike(sketches[one], sketches[two], False, least)
                pairs = np.stack([one[pairs[:, 0]], two[pairs[:, 1]]], axis=1)
            for a, b in _forest(pairs, len(names)).tolist():
                left.append(names[a])
                right.append(names[b])
            if len(left) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])
                left, right = [], []
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    keyed = blocked.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return keyed.mapInArrow(compared, "a long, b long")


def _verify(sets: list[np.ndarray], side: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets whose exact Jaccard similarity reaches the threshold, and that similarity; with sides, across them.

    Shared shingles are counted through an inverted list: every shingle gives the rows that hold it,
    and rows of counts are summed row by row, so memory stays at one row of counts per set.
    """
    sizes = np.array([len(item) for item in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, place = np.unique(np.concatenate(sets), return_inverse=True) if len(owner) else (np.zeros(0), np.zeros(0, dtype=np.int64))
    order = np.argsort(place, kind="stable")
    lists = owner[order]
    begins = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(values)))]).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    found, shares = [], []
    for row in range(len(sets)):
        own = place[ends[row] : ends[row + 1]]
        low, count = begins[own], begins[own + 1] - begins[own]
        shared = np.zeros(len(sets), dtype=np.int64)
        for at in range(0, len(own), 1 << 14):  # a set at a time, a run of its shingles at a time
            first, many = low[at : at + (1 << 14)], count[at : at + (1 << 14)]
            index = np.repeat(first - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            shared += np.bincount(lists[index], minlength=len(sets))
        union = sizes[row] + sizes - shared
        hit = np.where(union > 0, shared >= threshold * union, True)
        hit[: row + 1] = False
        if side is not None:
            hit &= side != side[row]
        others = np.flatnonzero(hit)
        if len(others):
            found.append(np.stack([np.full(len(others), row), others], axis=1))
            shares.append(np.where(union[others] > 0, shared[others] / np.maximum(union[others], 1), 1.0))
    if not found:
        return np.zeros((0, 2), dtype=np.int64), np.zeros(0)
    return np.concatenate(found), np.concatenate(shares)


def _with_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (node, doc_id, ...) with the shingle set of each node, from the text of that document."""
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    listed = wanted.withColumnRenamed("doc_id", "_listed")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    met = ids.join(F.broadcast(listed) if few else listed, ids["doc_id"].eqNullSafe(F.col("_listed"))).drop("_listed", "doc_id")
    others = [name for name in met.columns if name != "text"]
    schema = met.select(*others).schema.add("shingles", "binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, sets = [], []
            listed_nodes = batch.column("node").to_pylist()
            for place, node, own in nodes_of(batch.column("text")):
                if node == listed_nodes[place]:  # else another text under a repeated id
                    keep.append(place)
                    sets.append(own.tobytes())
            rows = batch.select(others).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(sets, pa.binary())], names=schema.names)

    return met.select(*others, "text").mapInArrow(cut, schema)


def similar_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, n_links, node and component.

    n_links is the number of other rows with a Jaccard similarity of at least ``threshold``; a class
    joins everything that such links connect. Rows with the same node have the same shingle set; the
    component tells classes apart also where all ids are null.
    """
    depth = matched_depth(threshold=threshold)
    signed = staged(signed_nodes(docs, depth), "signatures")
    facts = linked_nodes(docs, signed, threshold)
    return signed.select("doc_id", "node").join(facts, "node").select("doc_id", "class_id", "n_links", "node", "component")


def linked_nodes(docs: DataFrame, signed: DataFrame, threshold: float) -> DataFrame:
    """One row per node of ``signed``: node, component, class_id, n_links and near.

    Nodes that share a prefix are compared, by whatever signature the prefixes were made. near is the
    linked other node of the smallest id, as (missing, id, jaccard), null if there is none.
    """
    signature = (F.first("prefixes").alias("prefixes"), F.first("sketch").alias("sketch"))
    nodes = signed.groupBy("node").agg(F.count(F.lit(1)).alias("_rows"), F.min("doc_id").alias("doc_id"), *signature)
    # Nodes are numbered once, where they are written: numbers are joined and compared faster than digests.
    nodes = staged(nodes.withColumn("number", F.monotonically_increasing_id()), "nodes")
    groups = components(_candidate_edges(nodes, threshold)).select(F.col("node").alias("number"), F.col("component").alias("group"))
    nodes = nodes.drop("prefixes", "sketch")
    groups = staged(groups.join(nodes, "number").withColumn("_least", F.col("doc_id")), "groups")
    sets = staged(_with_sets(docs, groups).withColumn("_n", F.octet_length("shingles") / 8), "sets")
    sizes = sets.groupBy("group").agg(F.count(F.lit(1)).alias("_count"), F.max("_n").alias("_most"))
    sizes = sizes.withColumn(
        "_block", F.greatest(F.lit(8), F.least(F.lit(MOST_GROUP_NODES), F.floor(BLOCK_SHINGLES / F.greatest(F.col("_most"), F.lit(1))))).cast("int")
    )
    placed = sets.join(sizes, "group").withColumn("_place", F.pmod(F.xxhash64("number"), F.col("_count")))
    blocked = _blocked(placed, "group", "_place", "_block").select("group", "low", "high", "side", "number", "_rows", "_least", "shingles")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _in_runs(batches, ["group", "low", "high"]):
            names, weights = run.column("number").to_pylist(), run.column("_rows").to_numpy()
            if len(set(names)) < len(names):  # rows that repeat id and text
                keep = sorted({name: place for place, name in enumerate(names)}.values())
                run = run.take(pa.array(keep))
                names, weights = run.column("number").to_pylist(), run.column("_rows").to_numpy()
            sets = [np.frombuffer(item, dtype=np.uint64) for item in run.column("shingles").to_pylist()]
            within = run.column("low")[0] == run.column("high")[0]
            pairs, shares = _verify(sets, None if within else run.column("side").to_numpy(), threshold)
            links = np.zeros(len(names), dtype=np.int64)
            np.add.at(links, pairs[:, 0], weights[pairs[:, 1]])
            np.add.at(links, pairs[:, 1], weights[pairs[:, 0]])
            tree = _forest(pairs, len(names))
            linked = np.flatnonzero(links)
            least = run.column("_least").to_pylist()
            one, two, share = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]]), np.concatenate([shares, shares])
            rank = np.empty(len(names), dtype=np.int64)  # by id, null ids last
            rank[sorted(range(len(names)), key=lambda i: (least[i] is None, least[i] or 0))] = np.arange(len(names))
            order = np.lexsort((rank[two], one))
            firsts = order[np.flatnonzero(np.diff(one[order], prepend=-1))]  # one of each linked node, in their order
            near = [{"missing": least[i] is None, "id": least[i], "jaccard": float(value)} for i, value in zip(two[firsts], share[firsts], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[a] for a in tree[:, 0]] + [names[i] for i in linked], pa.int64()),
                    pa.array([names[b] for b in tree[:, 1]] + [None] * len(linked), pa.int64()),
                    pa.array([None] * len(tree) + links[linked].tolist(), pa.int64()),
                    pa.array([None] * len(tree) + near, pa.struct([("missing", pa.bool_()), ("id", pa.int64()), ("jaccard", pa.float64())])),
                ],
                ["a", "b", "links", "near"],
            )

    spread = blocked.repartition("group", "low", "high").sortWithinPartitions("group", "low", "high")
    schema = "a long, b long, links long, near struct<missing: boolean, id: long, jaccard: double>"
    found = staged(spread.mapInArrow(verified, schema), "links")
    counts = found.where("links is not null").groupBy(F.col("a").alias("number")).agg(F.sum("links").alias("links"), F.min("near").alias("near"))
    classes = components(found.where("links is null").select("a", "b")).withColumnRenamed("node", "number")
    named = staged(nodes.join(classes, "number", "left").withColumn("component", F.coalesce("component", "number")), "named")
    least = named.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    facts = (
        named.join(least, "component")
        .join(counts, "number", "left")
        .select("node", "component", "class_id", (F.col("_rows") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"), "near")
    )
    return staged(facts, "classes")


def with_nodes(docs: DataFrame) -> DataFrame:
    """All columns, and ``_node``: the digest of the shingle set of the row's text."""
    place = docs.columns.index("text")
    schema = docs.select("*").schema.add("_node", "binary")

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [node for _, node, _ in nodes_of(batch.column(place))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.binary())], names=schema.names)

    return docs.mapInArrow(marked, schema)


def drop_similar_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of every class of ``docs``, that of the smallest id, with all its columns.

    If rows repeat that id, the one with the smallest node stays; of rows that repeat id and text, one.
    """
    docs, restored = plain_names(docs, ("doc_id", "text"))
    found = similar_documents(docs, threshold).select(F.col("doc_id").alias("_id"), F.col("node").alias("_set"), "component")
    best = F.min(F.struct(F.col("_id").isNull().alias("missing"), F.col("_id").alias("id"), F.col("_set").alias("node")))
    found = staged(found.groupBy("_id", "_set", "component").agg(F.count(F.lit(1)).alias("_n")), "similar")
    tops = found.groupBy("component").agg(best.alias("_top"))
    judged = found.join(tops, "component")
    stays = F.col("_id").eqNullSafe(F.col("_top.id")) & (F.col("_set") == F.col("_top.node"))
    judged = staged(judged.select("_id", "_set", "_n", stays.alias("_stays")), "judged")
    marked = with_nodes(docs)

    def meets(frame: DataFrame, how: str) -> DataFrame:
        few = frame.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        other = F.broadcast(frame) if few else frame
        return marked.join(other, marked["doc_id"].cast("long").eqNullSafe(F.col("_id")) & (F.col("_node") == F.col("_set")), how)

    gone = judged.where(~F.col("_stays")).select("_id", "_set")
    repeated = judged.where(F.col("_stays") & (F.col("_n") > 1)).select("_id", "_set")
    if repeated.isEmpty():
        return restored(meets(gone, "left_anti"))
    once = meets(repeated, "left_semi").dropDuplicates(["doc_id", "_node"])
    return restored(meets(gone.union(repeated), "left_anti").union(once))
