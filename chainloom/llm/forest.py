"""MinHash near duplicates with an LSH forest, confirmed on full shingle sets.

Documents with equal sets are one class, and the class's smallest id stands for it. Every tree of the forest
has its own sequence of minimum hashes, written as a key; the classes in the order of their keys are the tree,
and the longest common prefix with the classes before and after says how near they are. The classes that
share a prefix are a region, and every class takes its shallowest prefix whose region is small enough:
a short one where few share it, a longer one where many do. Where the region of the forest's own prefix
length is too large for a task, its classes also go to a deeper forest, with longer prefixes and as many
more trees as those need, so that a pair at the threshold is missed with a probability of about e^-23 at every
depth. Inside a region, neighbours whose signatures agree often enough are joined; the groups that come out of all
regions hold every pair that can be over the threshold. Full sets then decide inside each group.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.llm.graph import components
from chainloom.llm.shared import kept
from chainloom.llm.words import Groups, Words, mix, runs, slices


@dataclass(frozen=True)
class Forest:
    """percent: pairs with 100 * intersection >= percent * union are linked.

    depths: prefix lengths of the first forest and of those that take its large regions; keys go on for `further`
    hashes, but for the last forest. region: most classes of a region or of a group that one task compares. few: most
    classes of a region with a shorter prefix. group_shingles: most shingles of such a group.
    """

    width: int = 5
    percent: int = 85
    depths: tuple[int, ...] = (4, 8, 12, 16)
    further: int = 4
    few: int = 128
    region: int = 2_048
    group_shingles: int = 4_000_000
    broadcast_rows: int = 500_000

    def length(self, depth: int) -> int:
        """Hashes of a key."""
        return depth if depth == self.depths[-1] else depth + self.further

    def trees(self, depth: int) -> int:
        return math.ceil(23 / -math.log(1 - (self.percent / 100) ** depth))

    def agreeing(self, n: int) -> int:
        """Equal hashes of n that nearly every pair at the threshold has: the mean less 5.3 deviations."""
        p = self.percent / 100
        return math.floor(n * (p - 5.3 * math.sqrt(p * (1 - p) / n)))


def shingles(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; one of the whole text where it has fewer words."""
    words = Words(texts, lower=True)
    hashes = words.hashes()
    windows, fits = words.windows(hashes, width)
    out = []
    for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
        if b - a >= width:
            out.append(np.unique(windows[a:b][fits[a:b]]))
        elif b > a:
            seed = np.frombuffer(hashlib.sha256(hashes[a:b].tobytes()).digest()[:8], np.uint64)
            out.append(seed)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _functions(depth: int, hashes: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.arange(1, 2 * hashes + 1, dtype=np.uint64)
    seeds = mix(n + np.uint64(depth) * np.uint64(0x51_7CC1_B727_2202))
    return seeds[::2], seeds[1::2] | np.uint64(1)


def signature(shingle_set: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The minimum of the set under every hash function, in blocks of functions."""
    out = np.empty(len(functions[0]), np.uint64)
    step = max(1, 200_000 // max(1, len(shingle_set)))
    for at in range(0, len(out), step):
        flip, times = (f[at : at + step, None] for f in functions)
        out[at : at + step] = ((shingle_set[None, :] ^ flip) * times).min(axis=1)
    return out


def fingerprints(docs: DataFrame, forest: Forest, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, digest): the size of a document's set and a 128-bit digest of it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                sets = shingles(texts, forest.width)
                digests = [hashlib.sha256(s.tobytes()).digest()[:16] for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(map(len, sets), pa.int64()), pa.array(digests, pa.binary())],
                    names=["id", "n_shingles", "digest"],
                )

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(task, "id long, n_shingles long, digest binary")


def orders(docs: DataFrame, forest: Forest, depth: int) -> DataFrame:
    """(node, bits, keys) of documents (node, text): a byte of the first minimum hashes, and every tree's key, one
    after the other. A key is the tree's number in 2 bytes and 4 bytes of each hash, so keys of one tree that share
    a prefix stand together in the order of bytes."""
    trees, length = forest.trees(depth), forest.length(depth)
    functions = _functions(depth, length * trees)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = np.arange(trees, dtype=">u2").view(np.uint8).reshape(trees, 2)
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                bits, keys = [], []
                for s in shingles(texts, forest.width):
                    low = signature(s, functions)
                    bits.append((low[: depth * trees] >> np.uint64(32)).astype(np.uint8).tobytes())
                    hashes = np.ascontiguousarray((low >> np.uint64(32)).reshape(length, trees).T.astype(">u4"))
                    keys.append(np.hstack([tree, hashes.view(np.uint8).reshape(trees, 4 * length)]).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(bits, pa.binary()), pa.array(keys, pa.binary())],
                    names=["node", "bits", "keys"],
                )

    return docs.select("node", "text").mapInArrow(task, "node long, bits binary, keys binary")


def prefix(key: Column, hashes: Column | int) -> Column:
    """A name of a key's first hashes in its tree."""
    return F.xxhash64(key.substr(F.lit(1), F.lit(2) + 4 * (F.lit(hashes) if isinstance(hashes, int) else hashes)))


def common(keys: np.ndarray) -> np.ndarray:
    """Hashes that each of some sorted keys shares with the one before it, from the second key on."""
    hashes = np.ascontiguousarray(keys[:, 2:]).view(">u4")
    same = (hashes[1:] == hashes[:-1]) & (keys[1:, :2] == keys[:-1, :2]).all(axis=1)[:, None]
    return np.cumprod(same, axis=1).sum(axis=1)


def adaptive(lcp: np.ndarray, length: int, depth: int, few: int, region: int) -> np.ndarray:
    """The region of each of some sorted keys, named by its first key: that of the shallowest prefix which at most
    `few` share, or `region` from `depth` hashes on. Keys that share it all find the same one."""
    out = np.full(len(lcp) + 1, -1)
    for d in range(1, length + 1):
        starts = np.concatenate([[0], np.flatnonzero(lcp < d) + 1])
        sizes = np.diff(np.append(starts, len(out)))
        take = (out < 0) & np.repeat(sizes <= (region if d >= depth else min(few, region)), sizes)
        out[take] = np.repeat(starts, sizes)[take]
    return out


def _neighbours(forest: Forest, depth: int):
    """Of rows (region, node, key, bits) in the order of keys: join classes whose signatures agree among the
    neighbours by common prefix; a star of edges for every group."""
    agree, length = forest.agreeing(depth * forest.trees(depth)), forest.length(depth)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for region in runs(batches):
            nodes = region.column(1).to_numpy()
            keys = np.frombuffer(b"".join(region.column(2).to_pylist()), np.uint8).reshape(len(nodes), -1)
            bits = np.frombuffer(b"".join(region.column(3).to_pylist()), np.uint8).reshape(len(nodes), -1)
            start = adaptive(common(keys), length, depth, forest.few, forest.region)
            end = np.searchsorted(start, start, side="right")
            groups = Groups(len(nodes))
            for i in range(len(nodes) - 1):
                close = np.flatnonzero((bits[i + 1 : end[i]] == bits[i]).sum(axis=1) >= agree)
                for j in close:
                    groups.join(i, i + 1 + int(j))
            for i in range(len(nodes)):
                if (r := groups.root(i)) != i:
                    a.append(nodes[i])
                    b.append(nodes[r])
            if len(a) >= 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return task


def _texts_of(docs: DataFrame, nodes: DataFrame, forest: Forest, id_col: str, text_col: str, n: int) -> DataFrame:
    """The texts of some nodes, with the other columns of nodes.

    Up to broadcast_rows nodes go to every executor; beyond that both sides are shuffled.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(nodes) if n <= forest.broadcast_rows else nodes, "node")


def candidates(docs: DataFrame, nodes: DataFrame, forest: Forest, id_col: str, text_col: str) -> DataFrame:
    """Edges (a, b) between classes such that every pair over the threshold is in one connected group."""
    edges = []
    for depth in forest.depths:
        n = nodes.count()
        if not n:
            break
        rows = kept(orders(_texts_of(docs, nodes, forest, id_col, text_col, n), forest, depth), "forest")
        length, key = forest.length(depth), F.col("key")
        width = 2 + 4 * length
        each = F.transform(F.sequence(F.lit(0), F.lit(forest.trees(depth) - 1)), lambda t: F.col("keys").substr(t * width + 1, F.lit(width)))
        flat = rows.select("node", F.explode(each).alias("key")).withColumn("region", prefix(key, 1))
        sizes = flat.groupBy("region").agg(F.count("*").alias("n")).where("n > 1")
        placed = kept(flat.join(sizes, "region").select("region", "node", "key", "n"), "regions")
        # Where many share the first hash: the sizes of all longer prefixes at once, and the shortest that a task can take.
        dense = placed.where(F.col("n") > forest.region).select("node", "key", F.explode(F.sequence(F.lit(2), F.lit(length))).alias("length"))
        dense = dense.withColumn("region", prefix(key, F.col("length")))
        longer = dense.groupBy("region").agg(F.count("*").alias("n"), F.min("node").alias("hub"))
        fits = F.when(F.col("n") <= forest.region, F.struct("length", "region", "n"))
        cut = dense.join(longer, "region").groupBy("node", "key").agg(
            F.min(fits).alias("fit"), F.max(F.when(F.col("length") == depth, F.col("n"))).alias("n"), F.max_by("hub", "length").alias("hub")
        )
        cut = kept(cut, "depths")
        small = placed.where(F.col("n") <= forest.region).select("region", "node", "key")
        small = small.union(cut.where("fit.n > 1").select("fit.region", "node", "key"))
        regions = small.join(rows.select("node", "bits"), "node").select("region", "node", "key", "bits")
        edges.append(
            regions.repartition("region").sortWithinPartitions("region", "key", "node").mapInArrow(_neighbours(forest, depth), "a long, b long")
        )
        if depth == forest.depths[-1]:
            edges.append(cut.where("fit is null").select(F.col("node").alias("a"), F.col("hub").alias("b")).where("a <> b"))
        nodes = kept(cut.where(F.col("n") > forest.region).select("node").distinct(), "large")
    if not edges:
        return docs.sparkSession.createDataFrame([], "a long, b long")
    return kept(reduce(DataFrame.union, edges).distinct(), "candidates")


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(x), len(y)))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (small + large - both)


def link(sets: list[np.ndarray], asks: list[bool], percent: int) -> Groups:
    """Groups of linked sets. Pairs of two sets that do not ask are left out.

    Candidates share one of the rarest shingles of the larger set: of a set of n, any set over the threshold
    has one among its n - ceil(n * percent / 100) + 1 rarest. Pairs already in one group are not compared.
    """
    groups = Groups(len(sets))
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    holders: dict[int, list[int]] = {}
    for i in order:
        n = len(sets[i])
        if not n:
            continue
        rank = counts[np.searchsorted(values, sets[i])]
        rare = sets[i][np.lexsort((sets[i], rank))][: n - -(-n * percent // 100) + 1]
        met: set[int] = set()
        for shingle in rare.tolist():
            met.update(holders.get(shingle, ()))
            holders.setdefault(shingle, []).append(i)
        for j in met:
            if (asks[i] or asks[j]) and groups.root(i) != groups.root(j) and _linked(sets[i], sets[j], percent):
                groups.join(i, j)
    return groups


def _confirm(forest: Forest):
    """Links inside every group (key, node, asks, text), as a star of edges for every linked part."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches):
            nodes, asks = group.column(1).to_pylist(), group.column(2).to_pylist()
            sets = []
            for chunk in group.column(3).chunks:
                for _, texts in slices(chunk):
                    sets += shingles(texts, forest.width)
            groups = link(sets, asks, forest.percent)
            for i in range(1, len(nodes)):
                if nodes[i] == nodes[i - 1]:
                    groups.join(i, i - 1)
            roots = [nodes[groups.root(i)] for i in range(len(nodes))]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], names=["a", "b"])

    return task


def confirmed(docs: DataFrame, groups: DataFrame, forest: Forest, id_col: str, text_col: str) -> DataFrame:
    """Edges (a, b) that connect exactly the classes that are connected by links on full sets.

    groups: (node, n_shingles, component). A group that fits a task is compared there. In a larger one every
    class is first compared with the group's middle (the class met in most regions); those not linked to it
    ask the whole group, block by block, each block pair in a task of its own.
    """
    of = groups.groupBy("component").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("total"), F.max_by("node", F.struct("met", -F.col("node"))).alias("middle")
    )
    blocks = F.greatest(F.ceil(2 * F.col("n") / forest.region), F.ceil(2 * F.col("total") / forest.group_shingles))
    sized = kept(groups.join(of.withColumn("blocks", blocks.cast("int")), "component"), "groups")
    fits = (F.col("n") <= forest.region) & (F.col("total") <= forest.group_shingles)
    runs_in = [sized.where(fits).select(F.xxhash64("component").alias("key"), "node", F.lit(True).alias("asks"))]
    large = sized.where(~fits)
    n_large = large.count()
    found = []

    def compare(parts: DataFrame, n: int) -> DataFrame:
        texts = _texts_of(docs, parts, forest, id_col, text_col, n).select("key", "node", "asks", "text")
        return texts.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_confirm(forest), "a long, b long")

    if n_large:
        part = F.pmod(F.xxhash64("node"), F.col("blocks"))
        alone = F.col("node") == F.col("middle")
        others = large.where(~alone).select(F.xxhash64("component", part, F.lit("star")).alias("key"), "node", F.lit(False).alias("asks"))
        middles = large.where(alone).select(
            F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.xxhash64("component", b.cast("long"), F.lit("star")))).alias("key"),
            "node",
            F.lit(True).alias("asks"),
        )
        star = kept(compare(others.union(middles), n_large), "star")
        found.append(star)
        # What is left after the star: no link to the middle. Its blocks meet every block of the group.
        near = star.where("a <> b").select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("near", F.lit(True))
        rest = large.join(near, "node", "left").withColumn("asks", F.col("near").isNull())
        asking = rest.where("asks").select("component", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("row")).distinct()
        asked = rest.where("asks").join(asking.groupBy("component").agg(F.collect_set("row").alias("rows")), "component")
        everyone = rest.join(asking.groupBy("component").agg(F.collect_set("row").alias("rows")), "component")
        meets = everyone.withColumn("column", F.pmod(F.xxhash64("node"), F.col("blocks"))).select(
            "component", "node", "asks", "column", F.explode("rows").alias("row")
        ).where("row >= column or not asks")
        columns = F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)
        rows = asked.withColumn("row", F.pmod(F.xxhash64("node"), F.col("blocks"))).select(
            "component", "node", "asks", F.explode(columns).alias("column"), "row"
        )
        tiles = meets.select("component", "node", "asks", "column", "row").union(rows.select("component", "node", "asks", "column", "row")).distinct()
        tiles = kept(tiles.select(F.xxhash64("component", "row", "column").alias("key"), "node", "asks"), "tiles")
        found.append(compare(tiles, tiles.count()))
    parts = kept(runs_in[0], "small")
    found.append(compare(parts, parts.count()))
    return kept(reduce(DataFrame.union, found).where("a <> b").distinct(), "links")


def near_duplicates(docs: DataFrame, forest: Forest = Forest(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of documents; ids are whole numbers.

    Null and empty texts have no shingles and link with nothing. Rows that repeat an id count as one
    document, whose texts are all linked; each row is returned. A row without an id is linked with nothing
    and kept. An empty table gives no rows; other columns are not read.
    """
    marks = kept(fingerprints(docs, forest, id_col, text_col), "fingerprints")
    named = marks.where("id is not null and n_shingles > 0")
    classes = named.groupBy("digest").agg(F.min("id").alias("node"), F.first("n_shingles").alias("n_shingles"))
    nodes = kept(classes.groupBy("node").agg(F.max("n_shingles").alias("n_shingles")), "nodes")
    twice = kept(named.groupBy("id").agg(F.count("*").alias("n"), F.count_distinct("digest").alias("sets")).where("n > 1"), "twice")
    if twice.head(1):
        docs = kept(docs.select(id_col, text_col).distinct(), "documents")
    edges = candidates(docs, nodes.select("node"), forest, id_col, text_col)
    met = edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("met"))
    coarse = components(edges).withColumnRenamed("id", "node")
    groups = coarse.join(nodes, "node").join(met, "node")
    links = confirmed(docs, groups, forest, id_col, text_col)
    copies = named.join(classes.select("digest", "node"), "digest").where("id <> node").select(F.col("id").alias("a"), F.col("node").alias("b"))
    # Copies point to their class straight away, so only ids that stand in two classes need the graph.
    links = links.union(copies.join(twice.where("sets > 1"), copies["a"] == twice["id"], "left_semi"))
    final = components(links).select(F.col("id").alias("node"), "component")
    member = classes.select("digest", "node").join(final, "node", "left")
    of = member.select("digest", F.coalesce("component", "node").alias("component"))
    out = marks.join(of, "digest", "left")
    whole = F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.coalesce("component", "id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        whole.alias("component_id"),
        F.coalesce(F.col("id") == whole, F.col("id").isNull()).alias("kept"),
    )


def one_of_each(docs: DataFrame, forest: Forest = Forest(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their columns, with one document of every near-duplicate group: the smallest id.

    Of rows that repeat an id one stays; rows without an id stay.
    """
    marks = kept(near_duplicates(docs, forest, id_col, text_col).select("doc_id", "kept"), "marks")
    gone = marks.where("not kept").select(F.col("doc_id").alias("_id")).distinct()
    small = gone.limit(forest.broadcast_rows + 1).count() <= forest.broadcast_rows
    stay = docs.join(F.broadcast(gone) if small else gone, docs[id_col] == gone["_id"], "left_anti")
    if marks.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").head(1):
        named = stay.where(F.col(id_col).isNotNull()).dropDuplicates([id_col])
        stay = named.union(stay.where(F.col(id_col).isNull()))
    return stay
