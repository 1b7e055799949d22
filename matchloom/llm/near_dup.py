"""MinHash near-duplicates by an LSH forest.

Each distinct shingle set gets a signature. The forest is ``TREES`` sorted orders of all
signatures, each order starting with other hash functions; in every order a row's
candidates are the next rows that share at least ``DEPTH`` leading values with it, nearest
first, so the prefix that candidates share is short where signatures are sparse and long
where they are dense. A sketch of the signature sorts out hopeless candidates; every other
one is confirmed on the full sets.

Where a region has more rows than neighbours reach, likenesses may remain unseen. Such
regions, joined over all orders, form clusters; members that the links so far do not tie to
their cluster's largest component are held, in tiles of bounded size, against all its members.

An order is one range-partitioned sort. No task holds a whole region: a large region of
like signatures spreads over partitions, and the few rows at partition edges are compared
in a second, small step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bits import bit_filter, passes
from .columns import free
from .store import discard, tasks, written
from .words import U64, mixed, shingle_hashes, word_hashes
from .workers import tidy

TREES = 16
DEPTH = 3  # leading values of an order that candidates share at least
LEVELS = 8  # values of an order that are sorted on
NEXT = 8  # following rows of an order that are candidates
KEEP = 2 * NEXT  # rows carried from batch to batch: enough to see that a region is large
QUERIES, MEMBERS = 1 << 18, 1 << 19  # shingles of a tile's rows, on average
HASHES = TREES * DEPTH
#: Of 48 four-bit values, true links of similarity 0.8 agree in 39 with a deviation of 2.7.
LEAST_AGREEING = 24
JUMPS = 3  # times that labels follow their own labels before the links are contracted

_MULTIPLY = (mixed(np.arange(1, HASHES + 1, dtype=U64)) | U64(1)).astype(np.uint32)
_ADD = mixed(np.arange(1001, HASHES + 1001, dtype=U64)).astype(np.uint32)
_EQUAL_NIBBLES = np.array([(x >> 4 == 0) + (x & 15 == 0) for x in range(256)], np.uint8)


def _bytes_of(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def sets_of(texts: list[bytes | None], n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(index, sorted distinct shingle hashes) of each text, A-Z taken as a-z."""
    for k, words in word_hashes([(t or b"").lower() for t in texts]):
        yield k, np.unique(shingle_hashes(words, n))


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value under each hash function."""
    x = (shingles >> U64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    out = np.empty(HASHES, np.uint32)
    for at in range(0, len(x), 4096):
        part = (x[None, at : at + 4096] * _MULTIPLY[:, None] + _ADD[:, None]).min(axis=1)
        out = part if at == 0 else np.minimum(out, part)
    return out


def profiles(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """Per row: id, n_shingles, node (a digest of the set), sig (binary)."""

    def run(batches):
        for batch in batches:
            texts = _bytes_of(batch.column(1))
            rows = [(0, None, None)] * len(texts)
            for k, shingles in sets_of(texts, n):
                if len(shingles):
                    rows[k] = (len(shingles), node_of(shingles), signature(shingles).tobytes())
            size, node, sig = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(node, pa.int64()), pa.array(sig, pa.binary())], names=["id", "n_shingles", "node", "sig"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("body"))
    return source.mapInArrow(tidy(run), "id long, n_shingles long, node long, sig binary")


def forest_rows(nodes: DataFrame) -> DataFrame:
    """A row for each set and order: the order's sort key, sketch, size, node."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, HASHES)
            low = (sig & 15).astype(np.uint8)
            sketch = [x.tobytes() for x in low[:, 0::2] << 4 | low[:, 1::2]]
            for tree in range(TREES):
                order = (tree * DEPTH + np.arange(LEVELS)) % HASHES
                values = np.ascontiguousarray(sig[:, order].astype(">u4"))
                keys = [bytes([tree]) + x.tobytes() for x in values]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sketch, pa.binary()), batch.column("n_shingles").cast(pa.int32()), batch.column("node")], names=["key", "sketch", "size", "node"])

    return nodes.select("sig", "n_shingles", "node").mapInArrow(tidy(run), "key binary, sketch binary, size int, node long")


_NEIGHBOUR_SCHEMA = "a long, b long, step int, key binary, sketch binary, size int, part int"


def _neighbours(least_share: tuple[int, int], edges: bool):
    """For rows in the order of their keys: pairs of rows close to each other, pairs of the
    first and each further row of a region that neighbours don't cover (step 0) and, if edges,
    the first and last rows of the partition."""
    num, den = least_share

    def pairs(keys, sketch, size, node):
        head = np.frombuffer(b"".join(k[: 1 + 4 * DEPTH] for k in keys), np.uint8).reshape(len(keys), -1)
        marks = np.frombuffer(b"".join(sketch), np.uint8).reshape(len(keys), -1)
        found = []
        for step in range(1, min(NEXT, len(keys) - 1) + 1):
            small, large = np.minimum(size[:-step], size[step:]), np.maximum(size[:-step], size[step:])
            at = np.flatnonzero((head[:-step] == head[step:]).all(axis=1) & (node[:-step] != node[step:]) & (den * small >= num * large))
            at = at[_EQUAL_NIBBLES[marks[at] ^ marks[at + step]].sum(axis=1, dtype=np.int32) >= LEAST_AGREEING]
            a, b = node[at], node[at + step]
            found.append((np.minimum(a, b), np.maximum(a, b), np.full(len(at), step, np.int32)))
        same = np.flatnonzero((head[:-1] == head[1:]).all(axis=1))
        if len(same):
            run = np.cumsum(np.diff(same, prepend=-2) != 1)
            first = same[np.searchsorted(run, run)]
            large = np.bincount(run)[run] > NEXT
            found.append((node[first[large]], node[same[large] + 1], np.zeros(large.sum(), np.int32)))
        return found

    def out(a, b, step, keys, sketch, size, part):
        n, none = max(len(a), len(keys)), pa.nulls
        if len(keys):
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), none(n, pa.int64()), none(n, pa.int32()), pa.array(keys, pa.binary()), pa.array(sketch, pa.binary()), pa.array(size, pa.int32()), pa.array([part] * n, pa.int32())], names=_COLUMNS)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(step, pa.int32()), none(n, pa.binary()), none(n, pa.binary()), none(n, pa.int32()), none(n, pa.int32())], names=_COLUMNS)

    def run(batches):
        keys, sketch, size, node = [], [], np.empty(0, np.int32), np.empty(0, np.int64)
        fresh, part = True, TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = keys[-KEEP:] + batch.column(0).to_pylist()
            sketch = sketch[-KEEP:] + batch.column(1).to_pylist()
            size = np.concatenate([size[-KEEP:], batch.column(2).to_numpy()])
            node = np.concatenate([node[-KEEP:], batch.column(3).to_numpy()])
            for a, b, step in pairs(keys, sketch, size, node):
                if len(a):
                    yield out(a, b, step, [], [], [], 0)
            if edges and fresh:
                yield out(node[:KEEP], [], [], keys[:KEEP], sketch[:KEEP], size[:KEEP], part)
            fresh = False
        if edges and keys:
            yield out(node[-KEEP:], [], [], keys[-KEEP:], sketch[-KEEP:], size[-KEEP:], part)

    return run


_COLUMNS = ["a", "b", "step", "key", "sketch", "size", "part"]


def candidates(nodes: DataFrame, least_share: tuple[int, int]) -> DataFrame:
    """Distinct pairs (a, b, step) of nodes that are neighbours in some order."""
    spark = nodes.sparkSession
    dealt = forest_rows(nodes).repartitionByRange(tasks(spark), "key", "node").sortWithinPartitions("key", "node")
    found = written(dealt.mapInArrow(tidy(_neighbours(least_share, True)), _NEIGHBOUR_SCHEMA), "neighbours")
    # At most 2 * KEEP rows of each partition: few whatever the input.
    rim = found.where("key is not null").select("key", "sketch", "size", F.col("a").alias("node")).distinct().coalesce(1).sortWithinPartitions("key", "node")
    across = rim.mapInArrow(tidy(_neighbours(least_share, False)), _NEIGHBOUR_SCHEMA)
    pairs = found.where("b is not null").unionByName(across).groupBy("a", "b", F.when(F.col("step") == 0, 0).otherwise(1).alias("kind")).agg(F.min("step").alias("step"))
    pairs = written(pairs.drop("kind"), "candidates")
    discard(found)
    return pairs


def full_sets(docs: DataFrame, id_col: str, text_col: str, n: int, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted (node, id), from the texts."""
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(wanted, "id"))

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(passes(bits.value, batch.column(0).to_numpy())))
            ids, texts = batch.column(0).to_pylist(), _bytes_of(batch.column(1))
            rows = [(ids[k], node_of(s), s.view(np.int64)) for k, s in sets_of(texts, n) if len(s)]
            for at in range(0, len(rows), 500):
                i, node, shingles = zip(*rows[at : at + 500], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(node, pa.int64()), pa.array(shingles, pa.list_(pa.int64()))], names=["id", "node", "shingles"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("body")).where("id is not null")
    rows = source.mapInArrow(tidy(run), "id long, node long, shingles array<long>")
    return rows.join(wanted, ["id", "node"], "left_semi").dropDuplicates(["node"]).select("node", "shingles")


def confirmed(pairs: DataFrame, sets: DataFrame, least_share: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    num, den = least_share
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("shared", F.size(F.array_intersect("sa", "sb")).cast("long"))
    return both.where(F.col("shared") * den >= (F.size("sa") + F.size("sb") - F.col("shared")) * num).select("a", "b")


def forest(links: DataFrame) -> DataFrame:
    """Links (a, b), a < b, that connect what the given ones do; of each batch of rows only as
    many as it has nodes, each tied to the least node that it reaches in the batch."""

    def run(batches):
        for batch in batches:
            ends, pairs = np.unique(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]), return_inverse=True)
            up = list(range(len(ends)))
            for x, y in pairs.reshape(2, -1).T.tolist():
                _unite(up, x, y)
            top = np.array([_top(up, x) for x in range(len(ends))], np.int64)
            tied = np.flatnonzero(top != np.arange(len(ends)))
            yield pa.RecordBatch.from_arrays([pa.array(ends[top[tied]], pa.int64()), pa.array(ends[tied], pa.int64())], names=["a", "b"])

    return links.select("a", "b").mapInArrow(tidy(run), "a long, b long").distinct()


def _top(up: list[int], x: int) -> int:
    while up[x] != x:
        up[x] = up[up[x]]
        x = up[x]
    return x


def _unite(up: list[int], x: int, y: int) -> bool:
    """Joins the sets of x and y under the lesser top; False if they are one set already."""
    x, y = _top(up, x), _top(up, y)
    up[max(x, y)] = min(x, y)
    return x != y


def _followed(table: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """The table with the column's node replaced by its label, where it has one."""
    label = labels.select(F.col("node").alias(column), F.col("root").alias("label"))
    return table.join(label, column, "left").withColumn(column, F.coalesce("label", column)).drop("label")


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, root) of every linked node; root is the least node that can be reached.

    Every node takes the least of its neighbours and itself as its label, follows labels a few
    times, and the links are contracted to the labels, until no link is left: links become
    fewer with each round. ``known`` are components of links found before, to which these are
    added. Whether links are left is all that the driver sees.
    """
    if known is not None:
        links = _followed(_followed(links.select("a", "b"), "a", known), "b", known).where("a <> b")
    links, levels = written(forest(links), "links"), []
    while not links.isEmpty():
        ends = links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select("b", "a"))
        labels = first = written(ends.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("root")), "labels")
        for _ in range(JUMPS):
            labels = _followed(labels, "root", first)
        levels.append(written(labels.select("node", "root"), "labels"))
        fewer = _followed(_followed(links, "a", levels[-1]), "b", levels[-1]).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        fewer = written(fewer.distinct(), "links")
        discard(links, first)
        links = fewer
    roots = levels[-1] if levels else links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for labels in reversed(levels[:-1]):
        roots = _followed(labels, "root", roots)
    if known is not None:
        roots = _followed(known, "root", roots).unionByName(roots.join(known, "node", "left_anti"))
    roots = written(roots.select("node", "root"), "roots")
    discard(links, *levels)
    return roots


def leftovers(clusters: DataFrame, roots: DataFrame, sizes: DataFrame, sets: DataFrame, least_share: tuple[int, int]) -> DataFrame | None:
    """Links between components that lie in a cluster (node, root) and that ``roots`` doesn't
    connect yet. sizes: (node, n_shingles).

    Members outside the cluster's largest component are the queries. Queries and members are
    dealt into blocks by their shingles, and each pair of blocks is a tile of its own. A tile
    gives no more links than it takes to connect its components.
    """
    num, den = least_share
    member = clusters.withColumnRenamed("root", "cluster").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(sizes, "node")
    by_root = member.groupBy("cluster", "root").agg(F.sum("n_shingles").alias("n"))
    split = by_root.groupBy("cluster").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("members"), F.count("*").alias("parts")).where("parts > 1")
    blocks = split.select("cluster", F.col("main.root").alias("main"), F.ceil(F.col("members") / MEMBERS).alias("mb"), F.ceil((F.col("members") - F.col("main.n")) / QUERIES).alias("qb"))
    member = written(member.join(blocks, "cluster"), "split")
    if member.isEmpty():
        return None
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    queries = member.where("root <> main").select("cluster", "node", "root", F.lit(True).alias("query"), block("qb").alias("q"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("mb") - 1)).alias("m"))
    others = member.select("cluster", "node", "root", F.lit(False).alias("query"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("qb") - 1)).alias("q"), block("mb").alias("m"))

    def tile(rows: pa.Table) -> pa.Table:
        node, query = (rows.column(c).to_numpy() for c in ("node", "query"))
        root = np.unique(rows.column("root").to_numpy(), return_inverse=True)[1]
        up = list(range(len(root)))
        shingles = [np.asarray(x.values) for x in rows.column("shingles").combine_chunks()]
        size, at = np.array([len(x) for x in shingles]), np.flatnonzero(~query.astype(bool))
        flat = np.concatenate([shingles[k] for k in at]) if len(at) else np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(at)), size[at])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        found = []
        for k in np.flatnonzero(query):
            low, high = np.searchsorted(flat, shingles[k], "left"), np.searchsorted(flat, shingles[k], "right")
            n = high - low
            hits = owner[np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
            shared = np.bincount(hits, minlength=len(at))
            near = at[(shared * den >= (size[k] + size[at] - shared) * num) & (root[at] != root[k])]
            found += [(node[k], node[x]) for x in near.tolist() if _unite(up, root[k], root[x])]
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = queries.unionByName(others).join(sets, "node")
    return written(rows.groupBy("cluster", "q", "m").applyInArrow(tile, "a long, b long"), "links")


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, least_share: tuple[int, int] = (80, 100)) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Null and wordless texts have the empty set and are linked with nothing, as are rows
    without an id: they are components of their own. Rows with equal sets, texts of one id
    included, are one node of the graph. component_id is the least id of the component;
    kept says whether the row has it. Other columns of ``docs`` are not read.
    """
    num, den = least_share
    prof = written(profiles(docs, id_col, text_col, n), "profiles")
    nodes = written(prof.where("node is not null and id is not null").groupBy("node").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")), "nodes")
    near = candidates(nodes, least_share)
    clusters = components(near.where("step = 0"))
    ends = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    sets = written(full_sets(docs, id_col, text_col, n, nodes.join(ends, "node", "left_semi").select("id", "node")), "sets")
    links = written(confirmed(near.where("step = 1"), sets, least_share), "links")
    roots = components(links)
    # What adjacent rows have linked already needs no further look.
    side = lambda at: roots.select(F.col("node").alias(at), F.col("root").alias(f"root_{at}"))
    rest = near.where("step > 1").join(side("a"), "a", "left").join(side("b"), "b", "left").where("root_a is null or root_b is null or root_a <> root_b")
    further = written(confirmed(rest, sets, least_share), "links")
    roots = components(further, known=roots)
    unseen = leftovers(clusters, roots, nodes.select("node", "n_shingles"), sets, least_share)
    if unseen is not None:
        roots = components(unseen, known=roots)
        discard(unseen)
    discard(near, links, further, clusters, sets)
    member = nodes.select("node", "id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = member.groupBy("root").agg(F.min("id").alias("component_id"))
    of_node = member.join(least, "root").select("node", "component_id")
    out = prof.select("id", "n_shingles", "node").join(of_node, "node", "left").withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")))
    return out.select("id", "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, least_share: tuple[int, int] = (80, 100)) -> DataFrame:
    """The rows of ``docs``, all columns, without those that are linked, over any number of
    links, with a smaller id. Rows without an id and repeated rows of one id stay."""
    name = free(docs, "__gone")
    gone = linked(docs, id_col, text_col, n, least_share).where("not kept").select(F.col("id").alias(name)).distinct()
    return docs.join(gone, F.col(id_col).cast("long") == F.col(name), "left_anti")
