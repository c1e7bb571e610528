"""N-gram Jaccard join by a count-vector R-tree.

A document is its set of word shingles. Shingles are hashed into groups; the counts by group
are the document's point, and the sum of the coordinates' minima of two points (or of the
upper corners of two boxes) bounds the overlap of their sets from above.

The tree, from the root:

1. Cells. A set's shingles are dealt to groups by hash, to more groups than the set and one it
   links to can have shingles that differ. What a group holds is a piece; the two sets differ in
   no more pieces than in shingles, so they share one of their first pieces in any order that is
   the same for all sets, if each shows as many as may differ, plus one. A set enters the cells
   of those. A piece has several shingles, so texts that share one only, or a passage, seldom
   meet. The order is by the rarest word of a piece: by counters of word hashes over all
   documents, which are never less than the number of documents that have the piece. The
   counters steer the order, not the result. The number of groups goes by bands of size
   (`bands`); a set that may link to smaller ones of the band before enters cells of both.
2. Boxes. The sets of a cell are cut into boxes of near points, of a bounded number of sets
   each, and box pairs of one cell are joined where the corners' bound allows a link.
3. Points. Pairs of sets that pass the points' bound are verified on their shingles.

Before step 2 each set of a cell is compared with one set of it only (by points, then
shingles); sets that are connected by then need no further comparison. For the cells that are
not, this is done twice: with their first set, then with the most typical one. For the second
time, shingles that only one set of these cells has are found; no link can use them. A set
leaves that has too many of them to link to anything, the others' points count their other
shingles only, so that the bounds see what can be shared, and the set with the fewest is the
typical one. Equal sets are one node throughout, so copies cost a row each and no pairs.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import columns_of, id_text, stored, table, words_of

GROUPS = 64
COUNTERS = 1 << 20
BOX_SETS = 128
MAX_SHINGLES = 1 << 40
_SEEN = 1 << 18
FILTER_BITS = 1 << 24
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(h: np.ndarray, by: np.uint64) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * by
    return h ^ (h >> np.uint64(29))


def _word_hashes(text: str) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _ngrams(h: np.ndarray, n: int) -> np.ndarray:
    size = min(n, len(h))
    out = np.full(len(h) - size + 1, np.uint64(size))
    for i in range(size):
        out = _mixed(out, _M1) + h[i:len(h) - size + 1 + i]
    return _mixed(out, _M2)


def shingles(text: str, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; of the whole if there are fewer words."""
    h = _word_hashes(text)
    return np.unique(_ngrams(h, n)) if len(h) else h


def differing(size: int, percent: int) -> int:
    """The most shingles that are in one only of a set of this size and another that it links to."""
    return size * (100 - percent) // percent


def bands(percent: int) -> tuple[list[int], list[int]]:
    """Bounds of the bands of sizes, and the number of groups of each: band i holds the sizes from
    bounds[i] up to, but not including, bounds[i + 1].

    A set links to sets of its own band and of the next ones to it only. Smaller sets than
    bounds[0] link to equal ones only.
    """
    bounds = [-(-percent // max(100 - percent, 1))]
    while bounds[-1] < MAX_SHINGLES:
        bounds.append(max(bounds[-1] * 3 // 2, bounds[-1] * 100 // percent + 1))
    most = [differing(b - 1, percent) + 1 for b in bounds[1:]]
    return bounds, [m + max(1, m // 5) for m in most]


def _pieces(found: np.ndarray, rarest: np.ndarray, groups: int, shown: int) -> np.ndarray:
    """Hashes of the first `shown` pieces of a set's shingles that are dealt to `groups` groups."""
    deal = _mixed(found, _M1)
    of = ((deal >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    held = np.bincount(of, minlength=groups)
    ends = np.cumsum(held)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mixed(deal, _M2)[order], dtype=np.uint64)))
    key = np.arange(groups, dtype=np.uint64) + (np.uint64(groups) << np.uint64(32))
    key = _mixed(_mixed(key, _M1) + sums[ends] - sums[ends - held], _M2)
    least = np.full(groups, 1 << 32, np.int64)
    full = np.flatnonzero(held)
    least[full] = np.minimum.reduceat(rarest[order], (ends - held)[full])
    return key[np.lexsort((key, -held, least))[:shown]]


def set_and_cells(text: str, n: int, percent: int, counts: np.ndarray,
                  of_size: tuple[list[int], list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """A text's shingles, and its cells: its first pieces by the count of their rarest word, in the
    groups of its band and, if a set of the band before may link to it, of that one."""
    h = _word_hashes(text)
    if not len(h):
        return h, h
    found, first = np.unique(_ngrams(h, n), return_index=True)
    bounds, groups = of_size
    size = len(found)
    band = bisect_right(bounds, size) - 1
    if band < 0:
        return found, found[:0]
    of = counts[(h & np.uint64(COUNTERS - 1)).astype(np.int64)]
    words = min(n, len(h))
    rarest = of[:len(h) - words + 1]
    for i in range(1, words):
        rarest = np.minimum(rarest, of[i:len(h) - words + 1 + i])
    rarest = rarest[first].astype(np.int64)
    cells = _pieces(found, rarest, groups[band], differing(size, percent) + 1)
    if band and size * percent <= (bounds[band] - 1) * 100:
        # of a pair, the smaller set bounds what differs
        cells = np.concatenate((cells, _pieces(found, rarest, groups[band - 1],
                                               differing(bounds[band] - 1, percent) + 1)))
    return found, cells


def _counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts (part, counts) of a task's counters of word hashes."""
    counts = np.zeros(COUNTERS, np.int64)
    for (texts,) in columns_of(batches, "text", rows=512):
        h = np.concatenate([_word_hashes(t) for t in texts])
        counts += np.bincount((h & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
    parts = counts.astype(np.uint32).reshape(-1, 1 << 14)
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
        ["part", "counts"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of one part's counters over all tasks, read as a stream."""
    total, part = np.zeros(1 << 14, np.int64), 0
    for parts, counts in columns_of(batches, "part", "counts"):
        part = parts[0]
        for x in counts:
            total += np.frombuffer(x, np.uint32)
    yield pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "counts"])


def word_counts(texts: DataFrame) -> np.ndarray:
    """COUNTERS counts (4 MB) whatever the number of words; words of one slot share a count."""
    parts = texts.select("text").mapInArrow(_counters, "part int, counts binary").groupBy(
        "part").applyInArrow(_summed, "part int, counts binary").collect()
    counts = np.zeros((COUNTERS >> 14, 1 << 14), np.int64)
    for r in parts:
        counts[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return np.minimum(counts.ravel(), (1 << 32) - 1).astype(np.uint32)


def point(s: np.ndarray) -> np.ndarray:
    return np.bincount((_mixed(s, _M2) >> np.uint64(58)).astype(np.int64), minlength=GROUPS)


def _digest(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _longs(a: np.ndarray) -> list[int]:
    return a.view(np.int64)


def _sets(n: int, percent: int, counts):
    """Rows (doc_id, node, n_shingles, cells); an empty set has a null node and no cells. Of equal
    sets that a task meets, the first has the cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_size, seen = bands(percent), set()
        for ids, texts in columns_of(batches, "doc_id", "text", rows=512):
            nodes, sizes, cells = [], [], []
            for t in texts:
                s, c = set_and_cells(t, n, percent, counts.value, of_size)
                nodes.append(_digest(s) if len(s) else None)
                sizes.append(len(s))
                cells.append(None if nodes[-1] in seen else _longs(c))
                seen.add(nodes[-1])
            if len(seen) > _SEEN:
                seen.clear()
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(nodes, pa.int64()),
                pa.array(sizes, pa.int64()), pa.array(cells, pa.list_(pa.int64()))],
                ["doc_id", "node", "n_shingles", "cells"])
    return run


def _wanted(n: int, bitmap, column: str):
    """Rows (node, n, point) or (node, shingles) of the texts whose slot the bitmap may hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for slots, texts in columns_of(batches, "slot", "text", rows=512):
            own = [t for i, t in zip(slots, texts, strict=True) if bits[i >> 3] >> (i & 7) & 1]
            for at in range(0, len(own), 256):
                sets = [s for t in own[at:at + 256] if len(s := shingles(t, n))]
                nodes = pa.array([_digest(s) for s in sets], pa.int64())
                if column == "point":
                    yield pa.RecordBatch.from_arrays([
                        nodes, pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([point(s) for s in sets], pa.list_(pa.int32()))], ["node", "n", "point"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [nodes, pa.array([_longs(s) for s in sets], pa.list_(pa.int64()))], ["node", "shingles"])
    return run


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, shingles, own) to (node, n, shared, point): the point of the shingles but its own."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            nodes, n, shared, points = [], [], [], []
            for node, s, own in zip(*(part.column(i) for i in range(3)), strict=True):
                s = s.values.to_numpy()
                left = s if own.as_py() is None else np.setdiff1d(s, own.values.to_numpy(), assume_unique=True)
                nodes.append(node.as_py())
                n.append(len(s))
                shared.append(len(left))
                points.append(point(left.view(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(n, pa.int64()), pa.array(shared, pa.int64()),
                 pa.array(points, pa.list_(pa.int32()))], ["node", "n", "shared", "point"])


def points_of(sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, shared, point) of the sets (node, shingles) that can link to another one.

    `shared` is the number of shingles that another of the sets has as well; a link of J
    percent needs that of a hundred. The shingles of one set only are few columns, found by
    combined minima: no shingle, however common, gathers its sets.
    """
    owners = sets.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(
        F.min("node").alias("node"), F.max("node").alias("last")).where("node = last")
    own = owners.groupBy("node").agg(F.collect_list("shingle").alias("own"))
    points = sets.join(own, "node", "left").select("node", "shingles", "own").mapInArrow(
        _points, "node long, n long, shared long, point array<int>")
    return points.where(100 * F.col("shared") >= percent * F.col("n"))


class Texts:
    """Texts with the first document of each node, read again for the nodes that are asked for."""

    def __init__(self, texts: DataFrame, found: DataFrame, n: int):
        self.texts, self.n = texts.withColumn("slot", _slot("doc_id")), n
        self.ids = found.where("node is not null").select("doc_id", "node")

    def of(self, nodes: DataFrame, column: str) -> DataFrame:
        """(node, n, point) or (node, shingles), one row a node. A filter of fixed size picks the
        texts, so a few others come along; a join on the node leaves them behind."""
        nodes = stored(nodes)
        ids = self.ids.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
        bitmap = self.texts.sparkSession.sparkContext.broadcast(
            _bitmap(ids.select((_slot("doc_id") + 1).alias("slot"))))
        kind = "node long, n long, point array<int>" if column == "point" else "node long, shingles array<long>"
        read = self.texts.mapInArrow(_wanted(self.n, bitmap, column), kind)
        return stored(read.join(nodes, "node", "left_semi").dropDuplicates(["node"]))


def bound_allows(a: Column, b: Column, size_a: Column, size_b: Column, percent: int) -> Column:
    """Whether the summed minima of two points or corners leave an overlap that links."""
    overlap = F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y).cast("long")), F.lit(0).cast("long"),
                          lambda x, y: x + y)
    return (100 + percent) * overlap >= percent * (size_a + size_b)


def _bitmap(slots: DataFrame) -> bytes:
    """A filter of FILTER_BITS bits whatever the number of rows; built map-side in parts."""
    parts = slots.groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    out = bytearray(FILTER_BITS // 8 + 4096)
    for r in parts:  # part 1 holds the slots from 1
        at = (r["part"] - 1) * 4096
        out[at:at + len(r["bits"])] = r["bits"]
    return bytes(out)


def _slot(column: str) -> Column:
    return (F.xxhash64(column) % FILTER_BITS + FILTER_BITS) % FILTER_BITS


def _verified(pairs: DataFrame, points: DataFrame, sets: Texts | DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) the linked ones: by points first, the rest by their shingles, which
    come from (node, shingles) or are read from the texts."""
    def both(rows: DataFrame, of: DataFrame, *cols: str) -> DataFrame:
        for side in ("a", "b"):
            rows = rows.join(of.select(F.col("node").alias(side),
                                       *[F.col(c).alias(f"{c}_{side}") for c in cols]), side)
        return rows

    sizes = both(pairs, points.select("node", "n"), "n").where(
        (100 * F.col("n_a") >= percent * F.col("n_b")) & (100 * F.col("n_b") >= percent * F.col("n_a")))
    near = stored(both(sizes, points, "point").where(bound_allows(
        F.col("point_a"), F.col("point_b"), F.col("n_a"), F.col("n_b"), percent)).select(
        "a", "b", "n_a", "n_b").distinct())
    nodes = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    sets = sets.of(nodes, "shingles") if isinstance(sets, Texts) else sets.join(nodes, "node", "left_semi")
    overlap = F.size(F.array_intersect("shingles_a", "shingles_b"))
    return both(near, sets, "shingles").where(
        (100 + percent) * overlap >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for the nodes of the edges (a, b).

    Alternating stars: every node's larger neighbours, then its smaller ones, are hung on its
    smallest neighbour, until nothing changes. All steps are joins and combined minima.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = e  # a > b: the smaller neighbours of a
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("_a"), F.least("a", "m").alias("m"))
        hung = both.join(least, F.col("a") == F.col("_a"))
        if large:
            return hung.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return hung.select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("_a").alias("a"), F.col("m").alias("b"))).where("a <> b")

    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = stored(e)
    before = None
    while True:
        e = stored(star(star(e, True).where("a <> b").distinct(), False).distinct())
        # sums wrap in decimals no more than in longs; equal edges have equal sums of hashes
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select(F.col("b"), F.col("b"))).distinct()


def _boxes(residual: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one cell and different roots that the tree's bounds let through.

    residual: (cell, node, root, n, point). A box holds the points of one tile (steps of size and of the first two
    coordinates); a tile with more than BOX_SETS points is dealt to several boxes by hash, all
    compared with each other. Boxes are joined on their corners, then points of the surviving
    boxes on theirs.
    """
    tile = F.struct(F.floor(F.log(F.col("n").cast("double")) * 20).alias("size"),
                    F.floor(F.sqrt(F.col("point")[0].cast("double")) * 2).alias("x"),
                    F.floor(F.sqrt(F.col("point")[1].cast("double")) * 2).alias("y"))
    rows = residual.withColumn("tile", tile)
    counts = rows.groupBy("cell", "tile").agg(F.count("*").alias("in_tile"))
    rows = stored(rows.join(counts, ["cell", "tile"]).withColumn("box", F.xxhash64(
        "tile", F.pmod(F.xxhash64("node"), F.ceil(F.col("in_tile") / BOX_SETS).cast("long")))).select(
        "cell", "box", "node", "root", "n", "point"))
    corners = rows.groupBy("cell", "box").agg(
        F.min("n").alias("n"), F.min("root").alias("r0"), F.max("root").alias("r1"),
        *[F.max(F.col("point")[i]).alias(f"x{i}") for i in range(GROUPS)]).select(
        "cell", "box", "n", "r0", "r1", F.array(*[F.col(f"x{i}") for i in range(GROUPS)]).alias("corner"))
    one, two = corners.alias("one"), corners.alias("two")
    pairs = one.join(two, (F.col("one.cell") == F.col("two.cell")) & (F.col("one.box") <= F.col("two.box"))
                     & ~((F.col("one.r0") == F.col("one.r1")) & (F.col("two.r0") == F.col("two.r1"))
                         & (F.col("one.r0") == F.col("two.r0")))
                     & bound_allows(F.col("one.corner"), F.col("two.corner"), F.col("one.n"),
                                    F.col("two.n"), percent)).select(
        F.col("one.cell").alias("cell"), F.col("one.box").alias("box_a"), F.col("two.box").alias("box_b"))
    left = rows.select("cell", F.col("box").alias("box_a"), F.col("node").alias("a"), F.col("root").alias("ra"),
                       F.col("n").alias("na"), F.col("point").alias("pa"))
    right = rows.select("cell", F.col("box").alias("box_b"), F.col("node").alias("b"), F.col("root").alias("rb"),
                        F.col("n").alias("nb"), F.col("point").alias("pb"))
    apart = (F.col("ra") != F.col("rb")) & bound_allows(
        F.col("pa"), F.col("pb"), F.col("na"), F.col("nb"), percent)
    met = pairs.join(left, ["cell", "box_a"]).join(right, ["cell", "box_b"]).where(apart)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, node.

    Two documents link when 100 * intersection >= percent * union of their sets of distinct
    word n-grams (lower-case A-Z; the whole text if it has fewer words). component_id is the
    smallest doc_id that links reach. Every link between different sets is in the result's
    components; `node` is the set's hash, the same for equal sets and null for an empty one.

    Null or blank texts have n_shingles 0 and are their own component, also if there are
    many. Repeated rows stay, in one component. Null ids sort after all others. An empty
    table gives an empty result.
    """
    return _labelled(*_found_and_roots(id_text(docs, id_col, text_col), n, percent))


def _found_and_roots(texts: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, node, n_shingles, cells) of all texts, and (node, root) of the linked nodes."""
    spark = texts.sparkSession
    counts = spark.sparkContext.broadcast(word_counts(texts))
    found = stored(texts.mapInArrow(
        _sets(n, percent, counts), "doc_id long, node long, n_shingles long, cells array<long>"))
    # dealt once: the cells are counted and joined where their rows lie
    members = found.where("node is not null").select(F.explode("cells").alias("cell"), "node").repartition("cell")
    shared = members.groupBy("cell").agg(F.min("node").alias("first"), F.max("node").alias("last")).where(
        "first <> last").select("cell", F.col("first").alias("centre"))
    members = stored(members.join(shared, "cell").distinct())
    own = Texts(texts, found, n)
    points = own.of(members.select("node").distinct(), "point")
    roots = stored(components(_verified(_spokes(members), points, own, percent)))
    members = stored(_apart(members, roots))

    sets = own.of(members.select("node").distinct(), "shingles")
    points = stored(points_of(sets, percent))
    members = members.join(points.select("node", "n", "shared"), "node")
    # Typical: the fewest shingles of its own, of as many the smallest set, then the smallest node.
    typical = F.min(F.struct((F.col("n") - F.col("shared")).alias("own"), "n", "node"))
    centres = members.groupBy("cell").agg(typical.alias("of")).select(
        "cell", F.col("of.node").alias("centre"))
    members = stored(members.select("cell", "node").join(centres, "cell"))
    roots = _merged(roots, stored(_verified(_spokes(members), points, sets, percent)))

    residual = _apart(members, roots).join(points.select("node", "n", "point"), "node")
    return found, _merged(roots, stored(_verified(_boxes(residual, percent), points, sets, percent)))


def _spokes(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of each set of a cell and the cell's centre."""
    return stored(members.where("centre <> node").select(
        F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct())


def _apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(cell, node, root) of the cells whose sets are not connected yet. A cell's centre has been
    compared with all of them, and leaves."""
    rooted = members.where("node <> centre").join(roots, "node", "left").select("cell", "node", F.coalesce("root", "node").alias("root"))
    several = rooted.groupBy("cell").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where(
        "r0 <> r1").select("cell")
    return rooted.join(several, "cell")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) with more links (a, b) between nodes."""
    if links.isEmpty():
        return roots
    joined = links
    for side in ("a", "b"):
        joined = joined.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"r{side}")), side, "left")
    upper = stored(components(joined.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))))
    extra = upper.join(roots.select("node"), "node", "left_anti")
    return stored(roots.select("node", F.col("root").alias("_r")).join(
        upper.select(F.col("node").alias("_r"), F.col("root").alias("_top")), "_r", "left").select(
        "node", F.coalesce("_top", "_r").alias("root")).union(extra))


def _least_ids(found: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, least, root): the least id of each node."""
    return found.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least")).join(
        roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))


def _labelled(found: DataFrame, roots: DataFrame) -> DataFrame:
    full = found.where("node is not null").select("doc_id", "n_shingles", "node")
    least = _least_ids(found, roots)
    tops = least.groupBy("root").agg(F.min("least").alias("component_id"))
    by_node = least.join(tops, "root").select("node", "component_id")
    return full.join(by_node, "node").select("doc_id", "n_shingles", "component_id", "node").union(
        found.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "node"))


def op3_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90).select(
        "doc_id", "n_shingles", "component_id")


def _with_nodes(n: int, text_col: str, names: list[str]):
    """The rows with their node; blank ones with a hash of the text, and whether they are blank."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                nodes, blank = [], []
                for t in part.column(part.schema.get_field_index(text_col)).to_pylist():
                    s = shingles(t or "", n)
                    blank.append(not len(s))
                    nodes.append(_digest(s) if len(s) else -1 if t is None else xxhash.xxh3_64_intdigest(
                        t.encode("utf-8", "surrogatepass")) >> 1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(nodes, pa.int64()), pa.array(blank, pa.bool_())], [*part.schema.names, *names])
    return run


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, all columns: that of the least doc_id (null ids last), of
    those the least node. Rows of one id with unlike texts are in components of their own, and
    each stays; so do null ids. Of rows equal in id and node one stays, the same in any order of
    the rows. Blank texts stay, but for rows equal in id and text. Other columns may have any name.
    """
    mark = "_"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    null, key, node, blank, first_, row_ = (mark + c for c in ("null", "key", "node", "blank", "first", "row"))
    least = _least_ids(*_found_and_roots(id_text(docs), n, percent))
    first = stored(least.groupBy("root").agg(
        F.min(F.struct(F.col("least").isNull().alias(null), F.coalesce("least", F.lit(0)).alias(key),
                       F.col("node").alias(node))).alias("of")).select("of.*", F.lit(True).alias(first_)))
    nodes = T.StructType([*docs.schema.fields, T.StructField(node, T.LongType()), T.StructField(blank, T.BooleanType())])
    rows = docs.mapInArrow(_with_nodes(n, "text", [node, blank]), nodes)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # one shuffle of the texts: combined by task, then joined where they lie
    one = rows.withColumn(null, F.col("doc_id").isNull()).withColumn(
        key, F.coalesce(F.col("doc_id").cast("long"), F.lit(0))).groupBy(null, key, node).agg(
        F.min_by(row, F.xxhash64(F.to_json(row))).alias(row_), F.max(blank).alias(blank))
    return one.join(first, [null, key, node], "left").where(F.col(blank) | F.col(first_)).select(f"{row_}.*")


ORACLE_OP3 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(words) = 0 THEN []
    WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i+2], ' ')) END)) AS s
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))),
r AS (
  SELECT a, b FROM l
  UNION
  SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles,
       least(w.doc_id, coalesce(m.m, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id
LEFT JOIN (SELECT a, min(b) AS m FROM r GROUP BY a) m ON m.a = w.doc_id
"""
