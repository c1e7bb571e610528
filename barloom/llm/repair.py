"""Conversation structure repair: faults of damaged conversations and their cheapest edits.

Turns are one of twelve codes (role initial, fault). The costs of all four places in the grammar
`(s?(ua)+)?` from a turn to the end form a vector; going back over a turn is a product in
(min, +), and vectors are kept less their minimum. Chunks of turns start from a speculative
vector, all at once. Fix-up passes rerun a chunk whose end vector turns out otherwise by more
than a constant, until none does; then the vectors agree but for constants, which are added
up. The edits are traced forward through them, least letter first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table

# Turns of a chunk.
CHUNK = 1 << 16
# Rows and characters of a batch that leaves a task.
_ROWS, _CHARS = 2000, 1 << 24

# Places in the grammar: nothing yet, after `s`, after `u`, after `a`.
_PLACES = range(4)
# Where a kept initial leads from each place, and where the one that fits there leads.
_KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_FITS = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
_INITIALS = "sua"
LEGAL = frozenset(("su", "ua", "au"))
SOUND, TRUNCATED, GONE = 0, 1, 2
# Costs of edits, by the contract.
DELETE, INSERT, REROLE, MEND = 4, 3, 3, 3
# Costs to the end from each place after the last turn, inserting what is missing.
END = (0, 2 * INSERT, INSERT, 0)
# What chunks start from before the turns after them are known.
UNKNOWN = (0, 0, 0, 0)
_SPACE = " \t\n\v\f\r"

Vector = tuple[int, int, int, int]


def code(initial: str, fault: int) -> int:
    role = _INITIALS.index(initial) if initial and initial in _INITIALS else len(_INITIALS)
    return 3 * role + fault


def _edits(place: int, turn: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next place) of the edits that a turn allows, by letter."""
    initial, fault = (_INITIALS + "?")[turn // 3], turn % 3
    out = [("D", DELETE, place)]
    if fault != GONE:
        mend = MEND * (fault == TRUNCATED)
        if (place, initial) in _KEPT:
            out.append(("K", mend, _KEPT[place, initial]))
        out.append(("R", mend + REROLE, _FITS[place]))
    return out


@lru_cache(maxsize=1 << 16)
def _back(after: Vector, turn: int) -> tuple[Vector, int]:
    """Costs before a turn from those after it: less their minimum, and the minimum."""
    v = [min(cost + after[to] for _, cost, to in _edits(p, turn)) for p in _PLACES]
    for _ in _PLACES:
        v = [min(v[p], INSERT + v[_FITS[p]]) for p in _PLACES]
    least = min(v)
    return tuple(x - least for x in v), least


@lru_cache(maxsize=1 << 16)
def _choice(after: Vector, turn: int, place: int) -> tuple[str, int, tuple[int, ...]]:
    """The cheapest edits at a turn, least letters first: letters, next place, places of the
    rows that stand for it, inserted ones first."""
    before, least = _back(after, turn)
    letters, rows = "", []
    while True:
        want = before[place] + least
        options = _edits(place, turn)
        if INSERT + before[_FITS[place]] + least == want:
            options.insert(1, ("I", INSERT, _FITS[place]))
        for letter, cost, to in options:
            if letter == "I" or cost + after[to] == want:
                break
        letters += letter
        if letter != "D":
            rows.append(to)
        place = to
        if letter != "I":
            return letters, place, tuple(rows)


def backward(turns: bytes, end: Vector) -> tuple[list[Vector], Vector, int]:
    """For a chunk and the costs after it: the costs after each turn, before the first, and
    the constant taken off."""
    after, total, v = [], 0, end
    for turn in reversed(turns):
        after.append(v)
        v, least = _back(v, turn)
        total += least
    after.reverse()
    return after, v, total


def forward(turns: bytes, after: list[Vector], place: int) -> Iterator[tuple[str, int, tuple[int, ...]]]:
    for turn, v in zip(turns, after, strict=True):
        step = _choice(v, turn, place)
        yield step
        place = step[1]


def rank_convergence(chunks: list[bytes]) -> tuple[list[list[Vector]], int]:
    """Costs after each turn of every chunk of one conversation, and its whole cost.

    All chunks but the last start from UNKNOWN; a chunk whose end is not what it started from
    is run again from its end, as far as its vectors change.
    """
    if not chunks:
        return [], 0
    ends = [UNKNOWN] * (len(chunks) - 1) + [END]
    done = [backward(c, e) for c, e in zip(chunks, ends, strict=True)]
    stale = True
    while stale:
        stale = False
        for i in range(len(chunks) - 1):
            if done[i + 1][1] != ends[i]:
                stale, ends[i] = True, done[i + 1][1]
                done[i] = _fixed(chunks[i], done[i], ends[i])
    return [d[0] for d in done], sum(d[2] for d in done) + done[0][1][0]


def _fixed(turns: bytes, done: tuple[list[Vector], Vector, int], end: Vector) -> tuple[list[Vector], Vector, int]:
    after, first, total = done
    v = end
    for i in range(len(turns) - 1, -1, -1):
        if after[i] == v:
            return after, first, total
        old, after[i] = after[i], v
        v, least = _back(v, turns[i])
        total += least - _back(old, turns[i])[1]
    return after, v, total


def fault_of(text: str) -> int | None:
    """SOUND, TRUNCATED, or None for a blank text."""
    bare = text.rstrip(_SPACE)
    return None if not bare else SOUND if bare[-1] in ".!?" else TRUNCATED


def line(place: int, role: str, text: str, kept: bool) -> str:
    return f"{role if kept else _ROLE[place]}:{text}"


def _lines(steps, rows) -> Iterator[str]:
    """Repaired rows from the steps of a trace and its (role, text) rows."""
    for (letters, _, places), (role, text) in zip(steps, rows, strict=True):
        last = len(places) - (letters[-1] != "D")
        for i, p in enumerate(places):
            yield line(p, role, text, letters[-1] == "K") if i == last else f"{_ROLE[p]}:"


_CLOSING = {0: (), 1: (2, 3), 2: (3,), 3: ()}


def repair(rows: list[tuple[int | None, str, str]], chunk: int = CHUNK) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) of one conversation's
    damaged (turn, role, text) rows, in order."""
    seen: set[tuple[str, str]] = set()
    counts, codes, illegal, before = [0, 0, 0], bytearray(), 0, None
    for _, role, text in rows:
        fault = fault_of(text)
        blank, again = fault is None, (role, text) in seen
        seen.add((role, text))
        counts[0] += blank
        counts[1] += again and not blank
        counts[2] += fault == TRUNCATED and not again
        codes.append(code(role[:1], GONE if blank or again else fault))
        illegal += before is not None and before + role[:1] not in LEGAL
        before = role[:1]
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    chunks = [bytes(codes[i:i + chunk]) for i in range(0, len(codes), chunk)]
    after, cost = rank_convergence(chunks)
    audit, sha, place, joined = [], hashlib.sha256(), 0, False
    for i, (c, a) in enumerate(zip(chunks, after, strict=True)):
        steps = list(forward(c, a, place))
        place = steps[-1][1]
        audit += [s[0] for s in steps]
        for text in _lines(steps, ((r, t) for _, r, t in rows[i * chunk:(i + 1) * chunk])):
            sha.update((("\n" if joined else "") + text).encode("utf-8", "surrogatepass"))
            joined = True
    for p in _CLOSING[place]:
        audit.append("I")
        sha.update((("\n" if joined else "") + f"{_ROLE[p]}:").encode())
        joined = True
    return gaps, *counts, illegal, cost, "".join(audit), sha.hexdigest()


# The damaged table --------------------------------------------------------------------

def damaged(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text, gone): conv is the id as text, one space if it is null.

    Null turns, roles and texts are one space as well (a null turn stays null for the order).
    Repeated rows stay rows of their own, and other columns are left out.
    By crc32 of `conv:turn` modulo 20 a row goes (it stays with `gone`, so that its
    conversation is known), or its text goes, or its sentence ends, or it occurs twice, or its role is user.
    """
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col, role_col, text_col))
    rows = convs.select(
        conv.alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        (F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20).alias("k"))
    k = F.col("k")
    return rows.select(
        "conv", "turn", F.when(k == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(k == 1, "").when(k == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (k == 0).alias("gone"),
        F.explode(F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("twin")).drop("twin")


_RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
_PART = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
         "repaired_sha256 string, part int, ord long, turn long, role string, text string, gone boolean")
_KINDS = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(),
          pa.string(), pa.bool_()]
_NAMES = [c.split()[0] for c in _PART.split(", ")]


def _batch(rows: list[tuple], kinds, names) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _per_range(chunk: int):
    """Sorted turns of a range to the results of the conversations within, and the rows of its
    first and last one, which may go on in other ranges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        chars = at = 0
        first, conv, rows = True, None, []

        def row(at, turn, role, text, gone) -> tuple:
            return (conv, *[None] * 8, part, at, turn, role, text, gone)

        for batch in batches:
            for c, *r in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if c != conv and conv is not None:
                    if first:
                        out += [row(*x) for x in rows]
                    else:
                        live = [(t, role, text) for _, t, role, text, gone in rows if not gone]
                        out.append((conv, *repair(live, chunk), *[None] * 6))
                    first, rows = False, []
                conv = c
                rows.append((at, *r))
                chars += len(r[2])
                at += 1
                if len(out) >= _ROWS or out and chars > _CHARS:
                    yield _batch(out, _KINDS, _NAMES)
                    out, chars = [], 0
        out += [row(*x) for x in rows]
        for lo in range(0, len(out), _ROWS):
            yield _batch(out[lo:lo + _ROWS], _KINDS, _NAMES)
    return run


_CHUNK_KEY = ["conv", "part", "sub"]
_CHUNKS = ("conv string, part int, sub long, turns binary, first string, last string, blank long, duplicate long, "
           "truncated long, illegal long")


def _chunk(data: pa.Table) -> pa.Table:
    """One row of a chunk's turns: codes, counts, and the initials at its ends."""
    data = data.sort_by("ord")
    codes, counts, illegal, initials = bytearray(), [0, 0, 0], 0, []
    for role, text, first in zip(*(data.column(c).to_pylist() for c in ("role", "text", "first")), strict=True):
        fault = fault_of(text)
        blank, again = fault is None, not first
        counts[0] += blank
        counts[1] += again and not blank
        counts[2] += fault == TRUNCATED and not again
        codes.append(code(role[:1], GONE if blank or again else fault))
        initials.append(role[:1])
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    key = [data.column(c)[0].as_py() for c in _CHUNK_KEY]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.string(), pa.string(), *[pa.int64()] * 4]
    return pa.Table.from_batches([_batch(
        [(*key, bytes(codes), initials[0], initials[-1], *counts, illegal)], kinds, [c.split()[0] for c in _CHUNKS.split(", ")])])


_COSTS = "conv string, part int, sub long, turns binary, final boolean, after array<long>, before array<long>, taken long"


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs the chunks whose costs are not known for their end."""
    names = [c.split()[0] for c in _COSTS.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
    for batch in batches:
        rows = []
        for *key, turns, final, after, before, taken in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            if before is None:
                _, before, taken = backward(turns, tuple(after))
            rows.append((*key, turns, final, after, list(before), taken))
        yield _batch(rows, kinds, names)


def _converged(chunks: DataFrame) -> DataFrame:
    """The chunks with the costs at their ends, all of them true but for constants."""
    order = Window.partitionBy("conv").orderBy("part", "sub")
    unknown, end = (F.array(*[F.lit(x).cast("long") for x in v]) for v in (UNKNOWN, END))
    nothing = F.lit(None)
    begun = chunks.select(*_CHUNK_KEY, "turns", F.lead(F.lit(True)).over(order).isNull().alias("final")).select(
        "*", F.when(F.col("final"), end).otherwise(unknown).alias("after"), nothing.cast("array<long>").alias("before"),
        nothing.cast("long").alias("taken"))
    costs = stored(begun.mapInArrow(_costs, _COSTS))
    while True:
        next_costs = F.when(F.col("final"), F.col("after")).otherwise(F.lead("before").over(order))
        seen = costs.withColumn("true", next_costs).withColumn("stale", F.col("true") != F.col("after"))
        if seen.where("stale").isEmpty():
            return costs
        rerun = seen.select(
            *_CHUNK_KEY, "turns", "final", F.col("true").alias("after"),
            F.when(~F.col("stale"), F.col("before")).alias("before"), F.when(~F.col("stale"), F.col("taken")).alias("taken"))
        costs = stored(rerun.mapInArrow(_costs, _COSTS))


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where the least edits of a chunk lead to from each place."""
    for batch in batches:
        rows = []
        for *key, turns, after in zip(*(batch.column(n).to_pylist() for n in (*_CHUNK_KEY, "turns", "after")), strict=True):
            vectors = backward(turns, tuple(after))[0]
            out = []
            for place in _PLACES:
                for _, place, _ in forward(turns, vectors, place):  # noqa: B020
                    pass
                out.append(place)
            rows.append((*key, out))
        yield _batch(rows, [pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int64())], [*_CHUNK_KEY, "exits"])


def _entries(data: pa.Table) -> pa.Table:
    """The place in which each chunk of a conversation is entered; one short row a chunk."""
    data = data.sort_by([("part", "ascending"), ("sub", "ascending")])
    place, places = 0, []
    for exits in data.column("exits").to_pylist():
        places.append(place)
        place = exits[place]
    return data.drop_columns("exits").append_column("entry", pa.array(places, pa.int64()))


def _piece(rows: pa.Table, chunk: pa.Table) -> pa.Table:
    """Audit and repaired text of a chunk."""
    rows = rows.sort_by("ord")
    (one,) = chunk.to_pylist()
    steps = list(forward(one["turns"], backward(one["turns"], tuple(one["after"]))[0], one["entry"]))
    lines = list(_lines(steps, zip(rows.column("role").to_pylist(), rows.column("text").to_pylist(), strict=True)))
    audit = "".join(s[0] for s in steps)
    if one["final"]:
        closing = _CLOSING[steps[-1][1]]
        audit += "I" * len(closing)
        lines += [f"{_ROLE[p]}:" for p in closing]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string()]
    return pa.Table.from_batches([_batch([(*(one[c] for c in _CHUNK_KEY), audit, "\n".join(lines) if lines else None)],
                                         kinds, [*_CHUNK_KEY, "audit", "body"])])


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by conversation to (conv, audit, sha256): one digest is open at a time."""
    conv, audit, sha, joined = None, [], None, False

    def done() -> pa.RecordBatch:
        rows = [] if conv is None else [(conv, "".join(audit), sha.hexdigest())]
        return _batch(rows, [pa.string()] * 3, ["conv", "audit", "repaired_sha256"])

    for batch in batches:
        for c, letters, body in zip(*(batch.column(n).to_pylist() for n in ("conv", "audit", "body")), strict=True):
            if c != conv:
                if conv is not None:
                    yield done()
                conv, audit, sha, joined = c, [], hashlib.sha256(), False
            audit.append(letters)
            if body is not None:
                sha.update((("\n" if joined else "") + body).encode("utf-8", "surrogatepass"))
                joined = True
    yield done()


def _across_ranges(edges: DataFrame, chunk: int) -> DataFrame:
    """Results of the conversations at the ends of ranges."""
    live = edges.where("NOT gone").withColumn("sub", F.expr(f"ord DIV {chunk}"))
    same = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    firsts = live.groupBy("conv", same.alias("same")).agg(F.min(F.struct("part", "ord")).alias("f")).select(
        "conv", "f.part", "f.ord", F.lit(True).alias("first"))
    typed = live.join(firsts, ["conv", "part", "ord"], "left").select(
        *_CHUNK_KEY, "ord", "role", "text", F.coalesce("first", F.lit(False)).alias("first"))
    chunks = stored(typed.groupBy(*_CHUNK_KEY).applyInArrow(_chunk, _CHUNKS))
    costs = _converged(chunks)
    entries = costs.select(*_CHUNK_KEY, "turns", "after").mapInArrow(
        _exits, "conv string, part int, sub long, exits array<long>").groupBy("conv").applyInArrow(
        _entries, "conv string, part int, sub long, entry long")
    entered = costs.select(*_CHUNK_KEY, "turns", "final", "after").join(entries, _CHUNK_KEY)
    pieces = live.select(*_CHUNK_KEY, "ord", "role", "text").groupBy(*_CHUNK_KEY).cogroup(
        entered.groupBy(*_CHUNK_KEY)).applyInArrow(_piece, "conv string, part int, sub long, audit string, body string")
    traced = pieces.repartition("conv").sortWithinPartitions(*_CHUNK_KEY).mapInArrow(
        _streamed, "conv string, audit string, repaired_sha256 string")

    order = Window.partitionBy("conv").orderBy("part", "sub")
    joint = F.concat(F.lag("last").over(order), F.col("first"))
    counts = chunks.withColumn("joint", (~joint.isin(*LEGAL)).cast("long")).groupBy("conv").agg(
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"),
        (F.sum("illegal") + F.coalesce(F.sum("joint"), F.lit(0))).alias("illegal"))
    cost = costs.groupBy("conv").agg(
        (F.sum("taken") + F.get(F.min_by("before", F.struct("part", "sub")), F.lit(0))).alias("cost"))
    gaps = live.where("turn IS NOT NULL").groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("one")).alias("gaps"))
    found = edges.select("conv").distinct()
    for part in (gaps, counts, cost, traced):
        found = found.join(part, "conv", "left")
    return found.select("conv", *[F.coalesce(c, F.lit(0)).alias(c) for c in _RESULT[:6]],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def repair_conversations(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Faults, cost, least audit and digest of the repair of each conversation.

    rows: (conv, turn, role, text, gone), as `damaged` gives them; conversations whose rows are
    all gone have zeros, an empty audit and the empty text's digest. Turns are ordered by
    number, null first, those of one number by role and a digest of the text. Empty and very
    long texts are texts like others; an empty table gives an empty result.

    Rows are dealt in ranges of (conversation, turn), so a conversation of any length spreads
    over tasks. Conversations within a range are repaired there, in chunks of `chunk` turns.
    The first and last one of a range go on as rows: their duplicates are found by grouping,
    their chunks run apart and rerun until the costs at their ends agree; a chunk is bounded by
    `chunk` and by its range. Only the digest of a repaired conversation is one stream of
    bytes, in one task, a chunk at a time. The audit of a conversation is one value.
    """
    by = ["conv", "turn", "role", F.md5(F.col("text").cast("binary")), F.monotonically_increasing_id()]
    keyed = rows.select("conv", "turn", "role", "text", "gone", by[3].alias("tie"), by[4].alias("copy"))
    order = ["conv", "turn", "role", "tie", "copy"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie", "copy")
    done = stored(ranged.mapInArrow(_per_range(chunk), _PART))
    edges = done.where("part IS NOT NULL").select("conv", "part", "ord", "turn", "role", "text", "gone")
    whole = done.where("part IS NULL").select("conv", *_RESULT)
    return whole.unionByName(_across_ranges(edges, chunk))


def op13_structure_repair(spark, sf_dir: str) -> DataFrame:
    convs = table(spark, sf_dir, "conversations")
    found = repair_conversations(damaged(convs))
    kind = dict(convs.dtypes)["conv_id"]
    return found.select(F.when(F.col("conv") != " ", F.col("conv")).cast(kind).alias("conv_id"), *_RESULT)
