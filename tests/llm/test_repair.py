from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import pytest

from barloom.llm import repair

CONVS = "conv_id long, turn long, role string, text string, conv string, part int, first boolean, gone string"
GOOD = re.compile(r"(s?(ua)+)?")


def convs_of(spark, rows):
    """Turns with extra columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, "x", 1, True, "y") for r in rows], CONVS)


def text_or_space(x):
    return " " if x is None else str(x)


def damaged(rows):
    """conv_id to its damaged (turn, role, text) rows in order."""
    out = defaultdict(list)
    for c, t, role, text in rows:
        k = zlib.crc32(f"{text_or_space(c)}:{text_or_space(t)}".encode()) % 20
        role, text = text_or_space(role), text_or_space(text)
        role = "user" if k == 4 else role
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out[c] += [(t is not None, t or 0, role, hashlib.md5(text.encode()).hexdigest(), t, text)] * (0 if k == 0 else 1 + (k == 3))
    return {c: [(t, role, text) for *_, role, _, t, text in sorted(v, key=lambda x: x[:4])] for c, v in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+", "", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, audit) by comparing whole audits, over prefixes of role initials that the grammar allows."""
    allowed = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last, inserted):
        out = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        if inserted < 2:
            for x in set(allowed[last]) & set("ua"):
                cost, audit, done = best(i, x, inserted + 1)
                out.append((cost + 3, "I" + audit, ((x, None), *done)))
        if i < len(rows):
            cost, audit, done = best(i + 1, last, 0)
            out.append((cost + 4, "D" + audit, done))
            if found[i] in ("", "truncated"):
                for x in allowed[last]:
                    ways = [(0, "K")] if rows[i][1][:1] == x else []
                    ways += [(3, "R")] if x in "ua" else []
                    for c, letter in ways:
                        cost, audit, done = best(i + 1, x, 0)
                        out.append((cost + c + 3 * (found[i] == "truncated"), letter + audit, ((x, (i, letter)), *done)))
        return min(out, key=lambda o: o[:2]) if out else (10**9, "", ())

    sys.setrecursionlimit(20_000)
    return best(0, "", 0)


def brute_force(rows):
    found = faults(rows)
    cost, audit, done = cheapest(rows, found)
    names = {"u": "user", "a": "assistant"}
    lines = []
    for initial, source in done:
        if source is None:
            lines.append(f"{names[initial]}:")
        else:
            i, letter = source
            lines.append(f"{rows[i][1] if letter == 'K' else names[initial]}:{rows[i][2]}")
    assert GOOD.fullmatch("".join(x[:1] for x in lines))
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, found.count("blank"), found.count("duplicate"),
            found.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversation(rng, n):
    roles = ["user", "assistant"] * 3 + ["system", "s", "tool", "", "a"]
    texts = ["Fine.", "Why?", "cut", " \t\x0b", "", "é!", "\x1c", "again. \n", "x" * 9 + "."]
    return [(rng.choice([i, i, i + 1, None]), rng.choice(roles), rng.choice(texts) + rng.choice(["", str(i) + "."])) for i in range(n)]


@pytest.mark.parametrize("chunk", [1, 2, 5, 1 << 16])
def test_repair_equals_brute_force(chunk):
    rng = random.Random(chunk)
    for _ in range(400):
        rows = conversation(rng, rng.randint(0, 14))
        assert repair.repair(rows, chunk) == brute_force(rows)


def test_chunks_converge_to_the_costs_of_one_run():
    rng = random.Random(2)
    for _ in range(100):
        turns = bytes(rng.choice([rng.randrange(12), 2, 5, 11]) for _ in range(rng.randint(1, 300)))
        for size in (1, 3, 50):
            chunks = [turns[i:i + size] for i in range(0, len(turns), size)]
            after, cost = repair.rank_convergence(chunks)
            whole, first, total = repair.backward(turns, repair.END)
            assert [v for a in after for v in a] == whole and cost == total + first[0]
    assert repair.rank_convergence([]) == ([], 0)


def table(seed):
    rng = random.Random(seed)
    rows = []
    for c in [None, *rng.sample(range(-500, 500), 120)]:
        for i in range(rng.randint(1, 9)):
            rows.append((c, rng.choice([i, i, i, None]), rng.choice(["user", "assistant", "system", None, "tool"]),
                         rng.choice(["Yes.", "no", None, "", "Well? é", f"turn {i}."])))
    rows += [(9999, t, ("user", "assistant")[t % 2], f"Line {t % 40}.") for t in range(600)]
    rows += [(8888, None, "user", "Same.")] * 200
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk", [3, 1 << 16])
def test_table_equals_brute_force(spark, chunk):
    rows = table(chunk)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many small ranges
    try:
        got = repair.repair_conversations(repair.damaged(convs_of(spark, rows).repartition(6)), chunk).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = Counter((text_or_space(c), *brute_force(v)) for c, v in damaged(rows).items())
    assert Counter(tuple(r) for r in got) == want


def test_query_and_empty_table(spark, monkeypatch):
    rows = table(7)
    monkeypatch.setattr(repair, "table", lambda *_: convs_of(spark, rows))
    got = repair.op13_structure_repair(spark, "")
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == Counter((c, *brute_force(v)) for c, v in damaged(rows).items())
    monkeypatch.setattr(repair, "table", lambda *_: convs_of(spark, []))
    assert repair.op13_structure_repair(spark, "").count() == 0


def test_whole_small_table_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = Counter(tuple(r) for r in repair.op13_structure_repair(spark, sf).collect())
    assert got == Counter((c, *brute_force(v)) for c, v in damaged(rows).items())
