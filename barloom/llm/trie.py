"""Trie of conversation prefixes: members, children, leaves and shared text of every node.

Turns become digests where they are read; texts go no further. A prefix digest is a polynomial
of its turns' digests in two lanes modulo 2**64, so prefixes of a conversation that is cut into
ranges of turns are put together from sums. Distinct digests of a shard get slots from a
minimal perfect hash, whose keys are compared at every use; counts are scattered into flat
arrays and accumulate from the deepest level up through the array of parent slots.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table

# Conversations share their head with the first of their block; heads are shorter than HEADS turns.
BLOCK, HEADS = 100, 6
# A node is heavy if its members are more than one in so many of all (node, member) pairs:
# there are fewer heavy nodes than this, and a light subtree has no more members than that share.
HEAVY_NODES = 1 << 16
# Rows that a task takes to build the light subtrees of a bucket.
BUCKET_ROWS = 1 << 20
# Ids of a heavy node that end there are joined in pieces of so many id values.
PIECE_IDS = 1 << 16

# Odd multipliers of the two lanes, and their inverses modulo 2**64.
_R = tuple(np.array([x], np.uint64) for x in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95))
_INVERSE = tuple(np.array([pow(int(r[0]), -1, 1 << 64)], np.uint64) for r in _R)
_U = np.uint64
_POWERS = [[pow(int(r[0]), i, 1 << 64) for i in range(HEADS)] for r in _R]


def _powers(r: np.ndarray, e: np.ndarray) -> np.ndarray:
    """r ** e modulo 2**64, for each exponent."""
    out, factor, left = np.ones(len(e), _U), r.copy(), e.astype(_U)
    while left.any():
        out *= np.where(left & _U(1), factor, _U(1))
        factor = factor * factor
        left >>= _U(1)
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class PerfectHash:
    """A minimal perfect hash of distinct keys (depth, lane, lane): slots 0 to n - 1.

    On each level the keys that meet no other one take their places; the others go on.
    """

    def __init__(self, keys: tuple[np.ndarray, ...]):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, n = np.arange(len(keys[0])), 0
        while len(left):
            if len(self.levels) > 200:
                raise ValueError("keys are not distinct")
            at = self._places(tuple(k[left] for k in keys), len(self.levels), max(16, 2 * len(left)))
            alone = np.bincount(at, minlength=max(16, 2 * len(left))) == 1
            self.levels.append((alone, n + np.cumsum(alone) - 1))
            n += int(alone.sum())
            left = left[~alone[at]]

    @staticmethod
    def _places(keys, level: int, size: int) -> np.ndarray:
        depth, a, b = keys
        seed = _mix(np.array([level + 1], _U) * _U(0x9E3779B97F4A7C15))
        h = _mix(_mix(a ^ seed) + _mix(b + seed) * _U(3) + depth.astype(_U))
        return (h % _U(size)).astype(np.int64)

    def slots(self, keys: tuple[np.ndarray, ...]) -> np.ndarray:
        """Slot of each key; a key that is not of the set gets any slot, or -1."""
        out, left = np.full(len(keys[0]), -1, np.int64), np.arange(len(keys[0]))
        for level, (alone, ranks) in enumerate(self.levels):
            at = self._places(tuple(k[left] for k in keys), level, len(alone))
            hit = alone[at]
            out[left[hit]] = ranks[at[hit]]
            left = left[~hit]
        return out


class NodeTable:
    """Flat arrays over the slots of the distinct nodes among (depth, lane, lane) rows."""

    def __init__(self, keys: tuple[np.ndarray, ...]):
        order = np.lexsort(keys[::-1])
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
        distinct = tuple(k[order[new]] for k in keys)
        self.hash = PerfectHash(distinct)
        at = self.hash.slots(distinct)
        self.keys = tuple(np.empty_like(k) for k in distinct)
        for mine, k in zip(self.keys, distinct, strict=True):
            mine[at] = k
        self.size = len(at)

    def slots(self, keys: tuple[np.ndarray, ...], all_known: bool = True) -> np.ndarray:
        """Slot of each key, compared with the key that owns the slot; -1 for others."""
        at = self.hash.slots(keys)
        same = at >= 0
        for mine, k in zip(self.keys, keys, strict=True):
            same[same] = mine[at[same]] == k[same]
        if all_known and not same.all():
            raise ValueError("a key is not in the table")
        return np.where(same, at, -1)

    def accumulate(self, parents: np.ndarray, *values: np.ndarray) -> None:
        """Add every node's values to its parent's, deepest level first, in place."""
        depth = self.keys[0]
        order = np.argsort(depth, kind="stable")
        cuts = np.flatnonzero(np.diff(depth[order])) + 1
        for level in reversed(np.split(order, cuts)):
            level = level[parents[level] >= 0]
            for v in values:
                np.add.at(v, parents[level], v[level])


# Parts of the sorted turns ------------------------------------------------------------

@dataclass
class Edge:
    """What a range of turns in order (block, conversation, turn) ends with."""

    conv: int | None = None  # its last conversation: turns so far, their lanes, the first ones
    turns: int = 0
    lanes: list[int] = field(default_factory=lambda: [0, 0])
    heads: list[list[int]] = field(default_factory=list)  # [lane, lane, chars]
    block: int | None = None  # its last block: the first turns of the block's own conversation
    base: list[list[int]] = field(default_factory=list)

    def then(self, first: int, later: Edge) -> Edge:
        """The edge after both ranges; `first` is the conversation that `later` starts with."""
        if later.conv is None:
            return self
        base = (self.base + later.base)[:HEADS - 1] if self.block == later.block else later.base
        if not first == later.conv == self.conv:
            return Edge(later.conv, later.turns, later.lanes, later.heads, later.block, base)
        shift = [int(_powers(r, np.array([self.turns]))[0]) for r in _R]
        lanes = [(s + x * f) % (1 << 64) for s, x, f in zip(self.lanes, later.lanes, shift, strict=True)]
        return Edge(later.conv, self.turns + later.turns, lanes, (self.heads + later.heads)[:HEADS - 1],
                    later.block, base)


@dataclass
class Turns:
    """A range of turns as arrays."""

    conv: np.ndarray
    block: np.ndarray
    lanes: tuple[np.ndarray, np.ndarray]
    chars: np.ndarray

    @classmethod
    def of(cls, data: pa.Table | pa.RecordBatch) -> Turns:
        column = {n: data.column(n) for n in ("conv_id", "block", "item", "chars")}
        items = column["item"].combine_chunks() if isinstance(data, pa.Table) else column["item"]
        raw = np.frombuffer(b"".join(items.to_pylist()), ">u8").astype(_U)
        return cls(column["conv_id"].to_numpy(), column["block"].to_numpy(), (raw[0::2], raw[1::2]),
                   column["chars"].to_numpy())

    def heads(self, lo: int, hi: int) -> list[list[int]]:
        hi = min(hi, lo + HEADS - 1)
        return [[int(self.lanes[0][i]), int(self.lanes[1][i]), int(self.chars[i])] for i in range(lo, hi)]

    def edge(self) -> Edge:
        """The edge of this range taken by itself."""
        n = len(self.conv)
        last = int(self.conv[-1])
        lo = int(np.flatnonzero(self.conv != last)[-1]) + 1 if (self.conv != last).any() else 0
        lanes = [int((x[lo:] * _powers(r, np.arange(n - lo))).sum()) for x, r in zip(self.lanes, _R, strict=True)]
        block = int(self.block[-1])
        base = np.flatnonzero(self.conv == block)
        return Edge(last, n - lo, lanes, self.heads(lo, n), block,
                    self.heads(int(base[0]), int(base[-1]) + 1) if len(base) else [])


def _sorted_parts(convs: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows (part, ord, conv_id, block, item, chars) in ranges by block, conversation and turn,
    and one row (part, edge) of each range, written."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    conv = F.col(conv_col).cast("long")
    turns = convs.where(conv.isNotNull()).select(
        conv.alias("conv_id"), (conv - conv % BLOCK).alias("block"), F.col(turn_col).cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("item"),
        F.char_length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("copy"))
    # The block's own conversation comes first. The last column deals copies of one turn.
    by = [F.col("block"), F.col("conv_id") != F.col("block"), F.col("conv_id"), F.col("turn"), F.col("item"), F.col("copy")]
    ranged = turns.repartitionByRange(*by).sortWithinPartitions(*by).drop("turn", "copy")

    names = ["part", "ord", *ranged.columns, "edge"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, first, end = TaskContext.get().partitionId(), 0, None, Edge()
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            turns = Turns.of(batch)
            start = int(turns.conv[0])
            first = start if first is None else first
            end = end.then(start, turns.edge())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n)), *batch.columns,
                 pa.nulls(n, pa.string())], names)
            at += n
        if first is not None:
            row = [[part], [None], [None], [None], [None], [None], [json.dumps([first, asdict(end)])]]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types, strict=True)], names)

    return stored(ranged.mapInArrow(
        run, "part int, ord long, conv_id long, block long, item binary, chars long, edge string"))


def _carried(parts: DataFrame) -> dict[int, tuple[Edge, bool]]:
    """For each range: the edge of all ranges before it, and whether its last conversation goes on
    in the next one. One short row a range passes the driver."""
    rows = parts.where("edge IS NOT NULL").select("part", "edge").collect()
    edges = [(r["part"], *json.loads(r["edge"])) for r in sorted(rows, key=lambda r: r["part"])]
    out, before = {}, Edge()
    for i, (part, first, end) in enumerate(edges):
        out[part] = (before, i + 1 < len(edges) and edges[i + 1][1] == end["conv"])
        before = before.then(first, Edge(**end))
    return out


PATHS = ("part int, depth int, a long, b long, pa long, pb long, conv_id long, chars long, member int, ends int")


def _lanes(items: list[list[int]]) -> list[int]:
    """Lanes of the prefix that these items are."""
    return [sum(x[lane] * f for x, f in zip(items, fs)) % (1 << 64) for lane, fs in enumerate(_POWERS)]


def head_turns(conv: int) -> int:
    return zlib.crc32(str(conv).encode()) % HEADS


def _paths(turns: Turns, part: int, carry: Edge, goes_on: bool) -> pa.Table:
    """The nodes on the paths of a range's rebuilt conversations, one row a conversation and depth.

    The nodes of a shared head come with the range that a conversation starts in, the end of a
    path with the range that its conversation ends in.
    """
    n = len(turns.conv)
    starts = np.flatnonzero(np.r_[True, turns.conv[1:] != turns.conv[:-1]])
    stops = np.r_[starts[1:], n]
    offsets = np.zeros(len(starts), np.int64)
    joins = carry.conv is not None and carry.conv == int(turns.conv[0])
    if joins:
        offsets[0] = carry.turns
    of = np.repeat(np.arange(len(starts)), stops - starts)
    pos = np.arange(n) - starts[of] + offsets[of]
    head, kept = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    shared, own = np.zeros((2, len(starts)), _U), np.zeros((2, len(starts)), _U)
    extra: list[tuple] = []
    base = carry.base if carry.block is not None and carry.block == int(turns.block[0]) else []
    block, way = (carry.block if base else None), [_lanes(base[:d]) for d in range(len(base) + 1)]
    for s, (lo, hi) in enumerate(zip(starts.tolist(), stops.tolist(), strict=True)):
        conv, here = int(turns.conv[lo]), int(turns.block[lo])
        mine = turns.heads(lo, hi)
        if here != block:
            block, base, way = here, [], [[0, 0]]
        if conv == block:  # stays as it is; the head of those that follow
            base = (base + mine)[:HEADS - 1]
            way = [_lanes(base[:d]) for d in range(len(base) + 1)]
            h = k = 0
        else:
            h = head_turns(conv)
            k = min(h, len(base))
        begun = s == 0 and joins
        first = (carry.heads + mine)[:HEADS - 1] if begun else mine
        head[s], kept[s] = h, k
        shared[:, s], own[:, s] = way[k], _lanes(first[:h])
        ended = not (goes_on and s == len(starts) - 1)
        turns_all = int(offsets[s]) + hi - lo
        at_head = int(ended and turns_all <= h)  # nothing is left of its own
        for d in range(k + 1):
            ends = at_head if d == k else 0
            if not begun or ends:
                extra.append((d, *way[d], *way[max(0, d - 1)], conv, base[d - 1][2] if d else 0, int(not begun), ends))
    prefix, previous = [], []
    for lane, r in enumerate(_R):
        term = turns.lanes[lane] * _powers(r, pos)
        total = np.cumsum(term, dtype=_U)
        before = np.r_[_U(0), total][starts]
        if joins:
            before[:1] -= np.array([carry.lanes[lane]], _U)
        # Turns of one's own after the head move from place `head` to place `kept`.
        moved = (total - before[of] - own[lane][of]) * _powers(_INVERSE[lane], head - kept)[of]
        prefix.append(shared[lane][of] + moved)
        previous.append(prefix[-1] - term * _powers(_INVERSE[lane], head - kept)[of])
    keep = pos >= head[of]
    depth = pos - head[of] + kept[of] + 1
    ends = np.zeros(n, np.int64)
    ends[stops - 1] = 1
    if goes_on:
        ends[-1] = 0
    cols = list(zip(*extra, strict=True)) if extra else [()] * 9
    mine = [depth, *prefix, *previous, turns.conv, turns.chars, np.ones(n, np.int64), ends]
    out = []
    for i, (x, y) in enumerate(zip(cols, mine, strict=True)):
        kind = _U if 1 <= i <= 4 else np.int64
        both = np.r_[np.array(x, kind), y[keep].astype(kind)]
        out.append(both.view(np.int64))
    size = len(out[0])
    small = [pa.array(out[i].astype(np.int32)) for i in (0, 7, 8)]
    return pa.Table.from_arrays(
        [pa.array(np.full(size, part, np.int32)), small[0], *map(pa.array, out[1:7]), *small[1:]],
        [x.split()[0] for x in PATHS.split(", ")])


# Nodes --------------------------------------------------------------------------------

NODES = ("depth int, a long, b long, pa long, pb long, conv_id long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends binary")


def _scattered(depth, a, b, pa_, pb, conv, chars, members, below=None) -> dict[str, np.ndarray]:
    """Node arrays of path rows. `below`: (depth, a, b, children, leaves, saved) of subtrees built
    elsewhere, by the node they hang from."""
    keys = (depth, a, b)
    nodes = NodeTable(keys)
    at = nodes.slots(keys)
    n_convs, smallest = np.zeros(nodes.size, np.int64), np.full(nodes.size, np.iinfo(np.int64).max)
    last, up_a, up_b = np.empty(nodes.size, np.int64), np.empty(nodes.size, _U), np.empty(nodes.size, _U)
    np.add.at(n_convs, at, members)
    np.minimum.at(smallest, at, conv)
    last[at], up_a[at], up_b[at] = chars, pa_, pb
    if (last[at] != chars).any() or (up_a[at] != pa_).any() or (up_b[at] != pb).any():
        raise ValueError("two prefixes have one digest")
    parents = nodes.slots((nodes.keys[0] - 1, up_a, up_b), all_known=False)
    children, leaves = np.zeros(nodes.size, np.int64), np.zeros(nodes.size, np.int64)
    saved = (n_convs - 1) * last
    np.add.at(children, parents[parents >= 0], 1)
    if below is not None:
        hung = nodes.slots(below[:3])
        for mine, more in zip((children, leaves, saved), below[3:], strict=True):
            np.add.at(mine, hung, more)
    leaves[children == 0] = 1
    nodes.accumulate(parents, leaves, saved)
    return {"table": nodes, "at": at, "depth": nodes.keys[0], "a": nodes.keys[1], "b": nodes.keys[2], "pa": up_a,
            "pb": up_b, "conv_id": smallest, "parent": parents, "n_convs": n_convs, "n_children": children,
            "n_leaves": leaves, "saved_tokens": saved}


def _ends(at: np.ndarray, conv: np.ndarray, size: int) -> list[bytes | None]:
    """SHA-256 of the sorted ids that end in each slot."""
    out: list[bytes | None] = [None] * size
    order = np.lexsort((conv, at))
    at, conv = at[order], conv[order]
    for group in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at)) + 1):
        if len(group):
            out[at[group[0]]] = hashlib.sha256(",".join(map(str, conv[group].tolist())).encode()).digest()
    return out


def _node_rows(nodes: dict, ends: list[bytes | None]) -> pa.Table:
    parents = nodes["parent"]
    named = pa.array(np.where(parents >= 0, nodes["conv_id"][parents], 0), mask=parents < 0)
    lanes = [pa.array(nodes[c].view(np.int64)) for c in ("a", "b", "pa", "pb")]
    return pa.Table.from_arrays(
        [pa.array(nodes["depth"].astype(np.int32)), *lanes, pa.array(nodes["conv_id"]), named,
         *[pa.array(nodes[c]) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
         pa.array(ends, pa.binary())], [x.split()[0] for x in NODES.split(", ")])


def _numbers(data: pa.Table, *names: str) -> list[np.ndarray]:
    """Columns as arrays, lanes without a sign."""
    return [np.ascontiguousarray(data.column(c).to_numpy().astype(np.int64)).view(_U if c in ("a", "b", "pa", "pb") else np.int64)
            for c in names]


_ROW = ("depth", "a", "b", "pa", "pb", "conv_id", "chars", "member")


def _light(data: pa.Table) -> pa.Table:
    """The nodes of the light subtrees among path rows."""
    rows = _numbers(data, *_ROW)
    nodes = _scattered(*rows)
    ended = _numbers(data, "ends")[0] > 0
    return _node_rows(nodes, _ends(nodes["at"][ended], rows[5][ended], nodes["table"].size))


def _heavy(data: pa.Table) -> pa.Table:
    """The heavy nodes, with what the light subtrees below them add (rows with `children`)."""
    is_node = data.column("children").is_null().to_numpy()
    rows, hung = data.filter(pa.array(is_node)), data.filter(pa.array(~is_node))
    nodes = _scattered(*_numbers(rows, *_ROW), below=_numbers(hung, "depth", "a", "b", "children", "leaves", "saved"))
    return _node_rows(nodes, [None] * nodes["table"].size)


def _streamed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (depth, a, b, piece) sorted by node to (depth, a, b, sha): one digest is open at a time."""
    key, sha, done = None, None, []

    def flush() -> pa.RecordBatch:
        cols = list(zip(*done, strict=True)) if done else [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
            ["depth", "a", "b", "sha"])

    for batch in batches:
        for *k, piece in zip(*(batch.column(n).to_pylist() for n in ("depth", "a", "b", "piece")), strict=True):
            if k == key:
                sha.update(b",")
            else:
                if key is not None:
                    done.append((*key, sha.digest()))
                key, sha = k, hashlib.sha256()
            sha.update(piece.encode())
    if key is not None:
        done.append((*key, sha.digest()))
    yield flush()


def prefix_trie(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", heavy_nodes: int = HEAVY_NODES) -> DataFrame:
    """One row a node of the trie of the rebuilt conversations' turns (role, text).

    Conversation c takes the first crc32(c) % 6 turns of conversation c - c % 100 (as many as
    there are) in place of as many of its own first turns. Columns: conv_id (smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 (of the
    ids whose turns end here).

    Turns are ordered by number, null first; turns of one number by a digest of role and text.
    Null roles and texts are empty. Repeated rows are turns of their own. Rows without a
    conversation id belong to none and are left out. An empty table has no nodes.

    Turns are dealt in ranges, so a conversation of any length spreads over tasks, each of which
    gets the state at its start (one short row a range passes the driver). Nodes with more than
    one in `heavy_nodes` of all pairs of a node and a member, fewer than `heavy_nodes`, are
    counted by Spark's partial sums and built in one task. The light subtrees below them have no
    more members than that, and go to buckets of about BUCKET_ROWS rows; a task holds one bucket.
    """
    spark = convs.sparkSession
    parts = _sorted_parts(convs, conv_col, turn_col, role_col, text_col)
    carried = spark.sparkContext.broadcast(_carried(parts))

    def paths_of(data: pa.Table) -> pa.Table:
        part = data.column("part")[0].as_py()
        before, goes_on = carried.value[part]
        return _paths(Turns.of(data.sort_by("ord")), part, before, goes_on)

    paths = stored(parts.where("edge IS NULL").groupBy("part").applyInArrow(paths_of, PATHS))
    node = ["depth", "a", "b"]
    total = paths.agg(F.coalesce(F.sum("member"), F.lit(0))).first()[0]
    heavy = stored(paths.groupBy(*node).agg(
        F.sum("member").alias("member"), F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"),
        F.max("pa").alias("pa"), F.max("pb").alias("pb")).where(F.col("member") > total // heavy_nodes))
    marked = paths.join(F.broadcast(heavy.select(*node, F.lit(True).alias("heavy"))), node, "left")
    light = marked.where("heavy IS NULL").drop("heavy")

    # Where the light part of each conversation's path starts. Conversations over several
    # ranges, at most one a range, are looked up by broadcast: the others fit a range.
    roots = light.groupBy("conv_id").agg(F.min(F.struct(*node)).alias("root"), F.min("part").alias("from"),
                                         F.max("part").alias("to"))
    wide = F.broadcast(roots.where(F.col("from") < F.col("to")).select("conv_id", F.col("root").alias("wide")))
    narrow = roots.where(F.col("from") == F.col("to")).select("conv_id", "root", F.lit(0).cast("long").alias("deal"))
    dealt = light.join(wide, "conv_id", "left").withColumn(
        "deal", F.when(F.col("wide").isNotNull(), 1 + F.col("depth").cast("long")).otherwise(F.lit(0).cast("long")))
    rooted = dealt.join(narrow, ["conv_id", "deal"], "left").withColumn("root", F.coalesce("wide", "root"))
    buckets = -(-total // BUCKET_ROWS) or 1
    small = stored(rooted.withColumn("bucket", F.pmod(F.xxhash64("root"), F.lit(buckets))).select(
        "bucket", *_ROW, "ends").groupBy("bucket").applyInArrow(_light, NODES))

    top = small.where("parent_conv_id IS NULL AND depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    tall = heavy.unionByName(top, allowMissingColumns=True).groupBy(F.lit("all")).applyInArrow(_heavy, NODES)
    pieces = marked.where("heavy AND ends > 0").groupBy(*node, F.expr(f"conv_id DIV {PIECE_IDS}").alias("piece_no")).agg(
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string"))).alias("piece"))
    ended = pieces.repartition(*node).sortWithinPartitions(*node, "piece_no").mapInArrow(
        _streamed_ends, "depth int, a long, b long, sha binary")
    tall = tall.join(F.broadcast(ended), node, "left").withColumn("ends", F.col("sha")).drop("sha")

    above = F.broadcast(heavy.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
                                     F.col("conv_id").alias("above")))
    hung = small.where("parent_conv_id IS NULL").join(above, ["depth", "pa", "pb"], "left").withColumn(
        "parent_conv_id", F.col("above")).drop("above")
    nothing = hashlib.sha256(b"").hexdigest()
    columns = [F.col("conv_id"), F.col("depth").cast("long").alias("depth"), *map(F.col, (
        "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.coalesce(F.lower(F.hex("ends")), F.lit(nothing)).alias("ends_sha256")]
    return small.where("parent_conv_id IS NOT NULL").unionByName(hung).unionByName(tall).select(*columns)


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


# Unsigned crc32 of each conversation's number in decimals, character by character.
_CRC = """RECURSIVE bits(i, x, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, k + 1 FROM bits WHERE k < 8),
crcs AS (SELECT list(x ORDER BY i) AS t FROM bits WHERE k = 8),
run(conv_id, s, i, x) AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR), 1, 4294967295::BIGINT FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL SELECT conv_id, s, i + 1, xor(x // 256, t[xor(x, ascii(s[i])) % 256 + 1]) FROM run, crcs WHERE i <= length(s)),
hashed AS (SELECT conv_id, xor(x, 4294967295) AS crc FROM run WHERE i = length(s) + 1)"""


ORACLE_OP12 = f"""
WITH {_CRC},
original AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
headed AS (SELECT *, crc % 6 AS h FROM original JOIN hashed USING (conv_id)),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
  FROM headed c LEFT JOIN original b ON b.conv_id = c.conv_id - c.conv_id % 100),
paths AS (SELECT conv_id, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM rebuilt),
keyed AS (SELECT conv_id, depth, n, turns[1:depth] AS key FROM paths),
nodes AS (
  SELECT key, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN any_value(depth) > 0 THEN (count(*) - 1) * length(any_value(key)[-1].t) ELSE 0 END AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM keyed GROUP BY key),
linked AS (SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.key = n.key[1:n.depth - 1]),
children AS (SELECT key[1:depth - 1] AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT l.*, coalesce(c.n_children, 0) AS n_children FROM linked l LEFT JOIN children c USING (key)),
upward AS (SELECT unnest(range(depth + 1)) AS up, key, saved, (n_children = 0)::INT AS leaf FROM counted),
subtrees AS (SELECT key[1:up] AS key, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM upward GROUP BY ALL)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM counted JOIN subtrees USING (key)"""
