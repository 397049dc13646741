"""SimHash near-duplicates through a Gray-ordered hierarchical Hamming index.

Fingerprints are grouped under *masked patterns*: with at most ``d`` differing
bits, two of ``d + 2`` equal blocks agree, so each fingerprint hangs under one
upper node for each pair of blocks. A node that holds too many fingerprints is
divided again on its free bits by the same rule; after three levels at most 256
fingerprints can share a node, so no task ever holds an unbounded group.
Within a node the fingerprints lie in Gray order, where neighbours share long
bit patterns. Those patterns are factored into parents, a search adds up the
differences on the way down and drops a whole subtree when they exceed ``d``.

:func:`one_of_each` keeps one document of each group of near copies by the
similarity of their word shingles: the same index gives candidates at a wider
distance, and each is checked by the exact Jaccard similarity. What the index
leaves out, as fingerprints are no measure of that similarity, is found by a
prefix join: similar sets share one of their rarest shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keys, raw, settled, slices, unused
from .graph import connected_components

#: Children of a node in the in-memory index.
FANOUT = 16
#: A node with more fingerprints is divided on further bits.
NODE_LIMIT = 1024
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 15
#: Near copies: words in a shingle, and the least Jaccard similarity of the sets of shingles.
SHINGLE, SIMILARITY = 5, 0.8
#: Candidates of near copies lie under two of ``BLOCKS`` blocks, differ in at most ``REACH`` bits of the fingerprint and
#: ``SECOND`` of a second one. Texts at the least similarity differ in about 10 of 64 bits (standard deviation 3).
BLOCKS, REACH, SECOND = 10, 14, 16
#: Pairs that a node's search looks at together.
PAIRS = 1 << 20
#: Most texts whose keys or roots are broadcast (16 bytes each).
BROADCAST_TEXTS = 1_000_000
#: Shingles that ``COMMON_DOCS`` documents of one in ``SAMPLE`` hold count as common, the ``COMMON`` most frequent ones (16 bytes
#: each). They come last in the order of all shingles; any such choice gives the same links, it only keeps groups small.
SAMPLE, COMMON_DOCS, COMMON = 32, 3, 1_000_000


def shingles(text: bytes, size: int) -> Iterator[bytes]:
    """The word shingles of a text, repeats included: the whole word sequence if that is shorter, none without words.

    A-Z are lower-cased, words are runs of bytes other than ASCII white space.
    """
    words = text.lower().split()
    if not words:
        return iter(())
    joined = b" ".join(words)
    size = min(size, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return (joined[a:b] for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()))


def majority(hashes: np.ndarray) -> np.ndarray:
    """Bits that are set in over half of the hashes (rows of bytes), as signed 64-bit words."""
    ones = np.zeros(8 * hashes.shape[1], np.int64)
    for at in range(0, len(hashes), BLOCK):
        ones += np.unpackbits(hashes[at : at + BLOCK], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of one text, as a signed integer; 0 for a text without words."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles(text, shingle), repeat(seed)), np.uint64)
    return int(majority(hashes.view(np.uint8).reshape(-1, 8))[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, k1, k2, fp) for every row; a null text counts as empty, a null id stays null.

    k1 and k2 stand for the row's id and text, to find the row again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = pa.array([fingerprint(t, shingle) for t in raw(batch.column(3))], pa.int64())
            yield pa.record_batch([*batch.columns[:3], found], ["doc_id", "k1", "k2", "fp"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = picked.select("doc_id", *keys(F.col("doc_id"), F.col("text")), "text")
    return keyed.mapInArrow(run, "doc_id long, k1 long, k2 long, fp long")


def gray_rank(fp: Column) -> Column:
    """Position of a 64-bit word in Gray order, as a sortable signed long."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def node_masks(parent: int, distance: int) -> list[int]:
    """Masks of the nodes below one with this mask: all pairs of ``distance + 2`` blocks of free bits."""
    free = [b for b in range(64) if not parent >> b & 1]
    blocks = [sum(1 << int(b) for b in part) for part in np.array_split(free, distance + 2)]
    return [parent | x | y for x, y in combinations(blocks, 2)]


class GrayIndex:
    """A static tree over fingerprints in Gray order.

    Each node keeps the ones and zeros that all fingerprints below it share and
    that its parent does not already hold.
    """

    def __init__(self, fps: np.ndarray):
        self.fps = fps
        ones, zeros = fps, ~fps
        levels = [(ones, zeros)]
        while len(levels[-1][0]) > FANOUT:
            at = np.arange(0, len(levels[-1][0]), FANOUT)
            ones, zeros = (np.bitwise_and.reduceat(x, at) for x in levels[-1])
            levels.append((ones, zeros))
        self.levels = [levels[-1]]
        for (up_ones, up_zeros), (ones, zeros) in zip(levels[:0:-1], levels[-2::-1]):
            up = np.arange(len(ones)) // FANOUT
            self.levels.append((ones & ~up_ones[up], zeros & ~up_zeros[up]))

    def near(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query position, fingerprint position) within ``distance``."""
        top = len(self.levels[0][0])
        q = np.repeat(np.arange(len(queries)), top)
        node = np.tile(np.arange(top), len(queries))
        spent = np.zeros(len(q), np.int64)
        for depth, (ones, zeros) in enumerate(self.levels):
            if depth:
                q, spent = np.repeat(q, FANOUT), np.repeat(spent, FANOUT)
                node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                real = node < len(ones)
                q, spent, node = q[real], spent[real], node[real]
            word = queries[q]
            spent = spent + np.bitwise_count((ones[node] & ~word) | (zeros[node] & word))
            kept = spent <= distance
            q, node, spent = q[kept], node[kept], spent[kept]
        return q, node


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links (position, position) that connect all of a node's fingerprints within ``distance``: a spanning forest."""
    index, root, links = GrayIndex(fps), np.arange(len(fps)), []
    for at in range(0, len(fps), 256):
        q, other = index.near(fps[at : at + 256], distance)
        q = q + at
        fresh = root[q] != root[other]
        for a, b in zip(q[fresh].tolist(), other[fresh].tolist()):
            if root[a] != root[b]:
                links.append((a, b))
                root[root == root[a]] = root[b]
    return links


def _within(distance: int):
    """Search of a node for :func:`_linked`: a forest over all links within ``distance``."""
    return lambda rows: _forest(rows[:, 0].view(np.uint64), distance)


def _likely(similarity: float):
    """Search of a node for :func:`_linked`: a forest over the pairs that can be so similar, the closest pairs first.

    Rows are (fingerprint, second fingerprint, number of different shingles).
    """

    def search(rows: np.ndarray) -> list[tuple[int, int]]:
        fps, second, sizes = rows[:, 0].view(np.uint64), rows[:, 1].view(np.uint64), rows[:, 2]
        index, root, links = GrayIndex(fps), np.arange(len(fps)), []
        step = max(1, PAIRS // len(fps))
        for at in range(0, len(fps), step):
            q, other = index.near(fps[at : at + step], REACH)
            q = q + at
            apart = np.bitwise_count(second[q] ^ second[other])
            good = (q < other) & (apart <= SECOND) & (np.minimum(sizes[q], sizes[other]) >= similarity * np.maximum(sizes[q], sizes[other]))
            q, other, apart = q[good], other[good], apart[good]
            order = np.argsort(apart + np.bitwise_count(fps[q] ^ fps[other]), kind="stable")
            for a, b in zip(q[order].tolist(), other[order].tolist()):
                if root[a] != root[b]:
                    links.append((a, b))
                    root[root == root[a]] = root[b]
        return links

    return search


def _linked(search):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (mask, pattern, fp, ...) come sorted by node; a node ends where (mask, pattern) changes."""
        held: list[np.ndarray] = []

        def links(rows: np.ndarray) -> pa.RecordBatch:
            cut = np.flatnonzero((rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])) + 1
            edges = np.concatenate(([0], cut, [len(rows)]))
            wide = np.flatnonzero(np.diff(edges) > 1)
            a, b = [], []
            for k in wide.tolist():
                node = np.ascontiguousarray(rows[edges[k] : edges[k + 1], 2:])
                for x, y in search(node):
                    a.append(int(node[x, 0]))
                    b.append(int(node[y, 0]))
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.ascontiguousarray(np.stack([c.to_numpy() for c in batch.columns], axis=1))
            last = np.flatnonzero((rows[:, 0] != rows[-1, 0]) | (rows[:, 1] != rows[-1, 1]))
            at = int(last[-1]) + 1 if len(last) else 0
            same = held and held[-1][-1, 0] == rows[-1, 0] and held[-1][-1, 1] == rows[-1, 1]
            if at == 0 and (same or not held):
                held.append(rows)
                continue
            yield links(np.concatenate([*held, rows[:at]]))
            held = [rows[at:]]
        if held:
            yield links(np.concatenate(held))

    return run


def _node_links(fps: DataFrame, blocks: int, search, node_limit: int, levels: int) -> DataFrame:
    """Edges (a, b) that ``search`` finds in the nodes of different fingerprints (column ``fp``, further longs for the search)."""
    spark, columns = fps.sparkSession, fps.columns
    below, found = fps.select(F.lit(0).cast("long").alias("up"), *columns), None
    parents = [0]
    for level in range(levels):
        masks = [(_signed(p), _signed(m)) for p in parents for m in node_masks(p, blocks - 2)]
        parents = sorted({m % (1 << 64) for _, m in masks})
        table = spark.createDataFrame(masks, "up long, mask long")
        if level:
            nodes = below.join(F.broadcast(table), "up")  # the table has (blocks over 2) ** level rows
        else:
            nodes = below.select(*columns, F.explode(F.array(*[F.lit(m).cast("long") for _, m in masks])).alias("mask"))
        nodes = nodes.select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("pattern"), *columns)
        sizes = nodes.groupBy("mask", "pattern").count().where("count > 1")
        last = level == levels - 1
        sizes = sizes if last else settled(sizes)
        full = sizes if last else sizes.where(F.col("count") <= node_limit)
        # By a hash of the node, not by the columns of the join: Spark leaves out a repartition that the join's own shuffle
        # gives already, and then may read that shuffle by map tasks or split its large partitions, which tears nodes apart.
        edges = (
            nodes.join(full.drop("count"), ["mask", "pattern"])
            .repartition(F.xxhash64("mask", "pattern"))
            .sortWithinPartitions("mask", "pattern", gray_rank(F.col("fp")))
            .mapInArrow(_linked(search), "a long, b long")
        )
        found = edges if found is None else found.union(edges)
        if last or sizes.where(F.col("count") > node_limit).isEmpty():
            break
        heavy = sizes.where(F.col("count") > node_limit).drop("count")
        below = settled(nodes.join(heavy, ["mask", "pattern"]).select(F.col("mask").alias("up"), *columns).distinct())
    return found


def hamming_links(fps: DataFrame, distance: int = 2, node_limit: int = NODE_LIMIT, levels: int = 3) -> DataFrame:
    """Edges (a, b) among distinct fingerprints (column ``fp``) that keep every connection at ``distance``.

    Not every close pair is listed: inside a node a spanning forest is enough
    to keep all components. Exact: no link between fingerprints is lost.
    """
    return _node_links(fps.select("fp"), distance + 2, _within(distance), node_limit, levels)


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int, distance: int) -> DataFrame:
    """(doc_id, k1, k2, fp, root, component_id); root is a fingerprint that stands for the component."""
    marked = settled(fingerprints(docs, id_col, text_col, shingle))
    distinct = settled(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(hamming_links(distinct.select("fp"), distance))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    Documents are linked when their fingerprints differ in at most ``distance``
    bits; ``component_id`` is the least doc_id that can be reached. Null or
    empty texts have fingerprint 0 and are linked like any other. Rows with a
    null id take part and get their component's least id (null if the component
    has none). Repeated rows are all returned. Other columns are ignored.
    """
    return _components(docs, id_col, text_col, shingle, distance).select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _digests(text: bytes, shingle: int) -> np.ndarray:
    """128-bit hashes of the shingles of a text, repeats included, as rows of bytes."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, shingles(text, shingle))), np.uint8).reshape(-1, 16)


def _distinct(digests: np.ndarray) -> np.ndarray:
    """The different shingles by 64 bits of their hashes, ascending."""
    return np.unique(np.ascontiguousarray(digests[:, :8]).view(np.int64))


def _common(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are frequent in a sample of the documents, ascending, and how often they are there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            held = [_distinct(_digests(t, shingle)) for t in raw(batch.column(0))]
            yield pa.record_batch([pa.array(np.concatenate([np.zeros(0, np.int64), *held]))], ["h"])

    text = F.col(text_col).cast("string")
    some = docs.where(F.pmod(F.xxhash64(F.col(id_col).cast("long"), text), F.lit(SAMPLE)) == 0).select(text.alias("text"))
    found = some.mapInArrow(run, "h long").groupBy("h").count().where(F.col("count") >= COMMON_DOCS)
    table = found.orderBy(F.desc("count"), "h").limit(COMMON).toArrow()
    h, count = (table[c].to_numpy() for c in ("h", "count"))
    order = np.argsort(h)
    return h[order], count[order]


def _rarest(held: np.ndarray, similarity: float, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """As many of a text's different shingles, the rarest first, that every text of this similarity has one of them among its own."""
    size = len(held) - math.ceil(similarity * len(held) - 1e-9) + 1 if len(held) else 0
    known, counts = common
    if len(known):
        at = np.minimum(np.searchsorted(known, held), len(known) - 1)
        held = held[np.argsort(np.where(known[at] == held, counts[at], 0), kind="stable")]
    return held[:size]


def _texts(docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """(uid, k1, k2, best, fp, second, n, rare): one row for each different word sequence.

    k1 and k2 stand for id and text of one of its rows, the one with the least
    id (``best`` orders them); n counts the different shingles, rare are the
    rarest of them.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_common(docs, id_col, text_col, shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, rare = np.zeros((batch.num_rows, 5), np.int64), []
            for k, text in enumerate(raw(batch.column(3))):
                hashes = _digests(text, shingle)
                held = _distinct(hashes)
                whole = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(text.lower().split())), np.int64)
                rows[k] = (*whole, *majority(hashes), len(held))
                rare.append(_rarest(held, similarity, sent.value))
            lists = pa.array(rare, pa.list_(pa.int64()))
            yield pa.record_batch([*batch.columns[:3], *map(pa.array, rows.T), lists], ["doc_id", "k1", "k2", "t1", "t2", "fp", "second", "n", "rare"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = picked.select("doc_id", *keys(F.col("doc_id"), F.col("text")), "text")
    rows = keyed.mapInArrow(run, "doc_id long, k1 long, k2 long, t1 long, t2 long, fp long, second long, n long, rare array<long>")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")).alias("best")
    each = rows.groupBy("t1", "t2").agg(best, *(F.min(c).alias(c) for c in ("fp", "second", "n")), F.any_value("rare").alias("rare"))
    return settled(each.select(F.monotonically_increasing_id().alias("uid"), "best.k1", "best.k2", "best", "fp", "second", "n", "rare"))


def _apart(rooted: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b: uids) that can be so similar, of texts (uid, root, n, rare) with different roots: no such pair is left out.

    Of two sets in one order of shingles, the first that both hold is among
    the rarest of each. The k-th that they share bounds all: k, and the
    shorter rest that follows. So do all that are shared among the rarest, and
    what either holds beyond those. Shingles of texts with one root, most of
    all those of a single text, go before rows are joined.
    """
    rows = rooted.select("uid", "root", "n", F.posexplode("rare").alias("at", "h"))
    whole = Window.partitionBy("h")
    met = rows.withColumns({"lo": F.min("root").over(whole), "hi": F.max("root").over(whole)}).where("lo <> hi").drop("lo", "hi")
    met = settled(met.withColumn("rest", F.col("n") - F.col("at") - 1))
    ours, theirs = (met.select("h", *(F.col(c).alias(f"{c}_{x}") for c in ("uid", "root", "n", "rest"))) for x in "ab")
    pairs = ours.join(theirs, "h").where((F.col("uid_a") < F.col("uid_b")) & (F.col("root_a") != F.col("root_b")))
    rest, beyond = F.least("rest_a", "rest_b"), F.ceil(similarity * F.greatest("n_a", "n_b") - 1e-9) - 1
    found = pairs.groupBy("uid_a", "uid_b").agg(
        F.count("*").alias("k"), F.max(rest).alias("first"), F.min(rest).alias("last"), F.min(beyond).alias("beyond"),
        F.min((F.col("n_a") + F.col("n_b")) * (similarity / (1 + similarity)) - 1e-6).alias("least"),
    )
    likely = found.where("first + 1 >= least and k + last >= least and k + beyond >= least")
    return likely.select(F.col("uid_a").alias("a"), F.col("uid_b").alias("b"))


def _similar(docs: DataFrame, texts: DataFrame, edges: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """The edges (a, b: uids) whose texts' sets of shingles are so similar, by exact counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            sets = [np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles(t, shingle)), np.uint64)).view(np.int64) for t in raw(batch.column(2))]
            yield pa.record_batch([*batch.columns[:2], pa.array(sets, pa.list_(pa.int64()))], ["k1", "k2", "held"])

    ends = edges.select(F.explode(F.array("a", "b")).alias("uid")).distinct()
    wanted = settled(texts.join(ends, "uid").select("uid", "k1", "k2"))
    some = wanted.select("k1", "k2")
    text = F.col(text_col).cast("string")
    rows = docs.select(*keys(F.col(id_col).cast("long"), text), text.alias("text"))
    rows = rows.join(F.broadcast(some) if some.count() <= BROADCAST_TEXTS else some, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    sets = settled(rows.mapInArrow(run, "k1 long, k2 long, held array<long>").join(wanted, ["k1", "k2"]).select("uid", "held"))
    met = edges.join(sets.toDF("a", "ours"), "a").join(sets.toDF("b", "theirs"), "b")
    common = F.size(F.array_intersect("ours", "theirs"))
    return met.where(common >= similarity * (F.size("ours") + F.size("theirs") - common)).select("a", "b")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY,
    node_limit: int = NODE_LIMIT,
) -> DataFrame:
    """One row of each group of near copies of ``docs``, with all its columns: the row with the least id.

    Texts are near copies if their sets of word shingles have a Jaccard
    similarity of ``similarity`` or more; groups are connected by such links.
    Equal word sequences (A-Z lower-cased) always are; so are all texts without
    words, null or empty. Candidates come from the index over fingerprints of
    the same shingles, which finds nearly all links, and every one is checked
    exactly, so no row goes without a link. Within a node candidates are a
    forest of closest pairs, never all pairs. Texts that the index leaves in
    different groups then meet under their rarest shingles, and what can be
    similar is checked in the same way, so that no link is lost. Rows with a
    null id stay only where their group has no other; among equal ids the text
    decides, among equal rows any one stays.
    """
    texts = _texts(docs, id_col, text_col, shingle, similarity)
    prints = texts.groupBy("fp").agg(F.min(F.struct("uid", "second", "n")).alias("least")).select("fp", "least.*")
    found = _node_links(prints.select("fp", "second", "n"), BLOCKS, _likely(similarity), node_limit, 3).distinct()
    uids = prints.select("fp", "uid")
    far = found.join(uids.toDF("a", "ua"), "a").join(uids.toDF("b", "ub"), "b").select(F.col("ua").alias("a"), F.col("ub").alias("b"))
    same = texts.select("fp", F.col("uid").alias("b")).join(uids.withColumnRenamed("uid", "a"), "fp").where("a <> b").select("a", "b")
    links = _similar(docs, texts, settled(far.union(same)), id_col, text_col, shingle, similarity)
    roots = connected_components(links).withColumnRenamed("node", "uid")
    few = roots.count() <= BROADCAST_TEXTS  # else the rarest shingles are shuffled once more
    rooted = texts.join(F.broadcast(roots) if few else roots, "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    more = _similar(docs, texts, settled(_apart(rooted, similarity)), id_col, text_col, shingle, similarity)
    of = rooted.select("uid", "root")
    joined = connected_components(more.join(of.toDF("a", "ra"), "a").join(of.toDF("b", "rb"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    rooted = rooted.join(joined.toDF("root", "top"), "root", "left").select(F.coalesce("top", "root").alias("root"), "best")
    return _rows_of(docs, rooted.groupBy("root").agg(F.min("best").alias("best")).select("best.k1", "best.k2"), id_col, text_col)


def _rows_of(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row of ``docs`` for each pair of keys of id and text."""
    names = unused(docs, 2)
    k1, k2 = keys(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    keyed = docs.withColumns(dict(zip(names, (k1, k2))))
    return keyed.join(found.toDF(*names), names, "left_semi").dropDuplicates(names).drop(*names)
