from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barloom.llm import fingerprint, html, jaccard, langid, lm, mixing, packing, quality, rules, tokencount

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, token string"


def frame(spark, texts, lang=None, source="s"):
    """Documents with extra columns whose names clash with the operators' own."""
    rows = [(i, t, lang[i] if lang else "en", source if isinstance(source, str) else source[i], 0, 1.0, "x", "y")
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    words = ["".join(rng.choice(["th", "er", "on", "an", "é", "in", "ß"]) for _ in range(rng.randint(1, 4)))
             for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", ",", ".\n", "'s"]) for _ in range(n))

    out = [prose(rng.randint(1, 400)) for _ in range(40)]
    near = out[0].split(" ")
    out += [out[0], " ".join([*near[:-1], "zz"]), None, "", "   \n\t", "one", "one two", prose(30_000)]
    out += ["Σίσυφος ΟΔΟΣ <|endoftext|> x", "日本語 テキスト \x1c  a\u0085b", "İstanbul DON'T", "é" * 300, "a  b   c \n  d "]
    return out


def words(t):
    return WORD.findall((t or "").encode().lower().decode())


def shingle_sets(texts, n):
    out = []
    for t in texts:
        w = words(t)
        size = min(n, len(w))
        out.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if w else set())
    return out


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_components_equal_brute_force(spark, texts, n, percent):
    rng = random.Random(1)
    base = texts[3].split(" ")
    some = [*texts, *(" ".join(w if rng.random() > 0.02 else "q" for w in base) for _ in range(20))]
    sets = shingle_sets(some, n)
    root = list(range(len(some)))
    for i in range(len(some)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    got = jaccard.jaccard_components(frame(spark, some), n, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {
        i: (len(s), root[i]) for i, s in enumerate(sets)}
    kept = jaccard.keep_one(frame(spark, some), n, percent)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root)) and kept.columns[-1] == "token"


def test_keep_one_keeps_unlike_texts_of_null_and_repeated_ids(spark):
    rng = random.Random(13)
    unlike = [" ".join(f"w{rng.getrandbits(40):x}" for _ in range(60)) for _ in range(13)]
    rows = [(None, t) for t in unlike[:5]] + [(7, t) for t in unlike[5:8]] + [(i, t) for i, t in enumerate(unlike[8:])]
    want = [*rows, (None, "  "), (None, None), (7, ""), (8, "")]
    more = [(None, unlike[0]), (9, unlike[5]), (7, unlike[5]), (None, unlike[8] + " z"), (7, unlike[5].upper()),
            (None, "  "), (8, "")]
    some = want + more

    def kept(order):
        docs = spark.createDataFrame([(i, t, "s") for i, t in order], "doc_id long, text string, source string")
        return Counter(map(tuple, jaccard.keep_one(docs.repartition(5)).collect()))

    got = kept(some)
    assert got == kept(some[::-1])
    assert Counter((i, (t or "").lower(), t is None) for i, t, _ in got.elements()) == Counter(
        (i, (t or "").lower(), t is None) for i, t in want)


def groups_of(texts, n, percent):
    """Least position of each text's component, by comparing all pairs."""
    sets = shingle_sets(texts, n)
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(texts))]


def test_jaccard_group_of_near_copies_loses_no_link(spark):
    # Near copies around the threshold, of two bases, and copies of some of them.
    rng = random.Random(17)
    some = []
    for base in range(2):
        words_ = [f"b{base}w{i}" for i in range(150)]
        for _ in range(70):
            rate = rng.choice([0.005, 0.015, 0.02, 0.03])
            some.append(" ".join(w if rng.random() > rate else f"x{rng.getrandbits(30)}" for w in words_))
    some += rng.choices(some, k=40) + ["b0w1 b0w2 b0w3", ""]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(frame(spark, some), 3, 90).collect()}
    want = groups_of(some, 3, 90)
    assert [got[i] for i in range(len(some))] == want
    assert 4 < len(set(want)) < 150


def test_jaccard_many_copies_under_a_null_id(spark):
    rng = random.Random(18)
    w = [f"w{i}" for i in range(200)]
    one, two = " ".join(w), " ".join([*w[:199], "z"])
    rows = [(None, one)] * 600 + [(None, two)] * 600 + [(3, " ".join(rng.sample(w, 150))), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs, 3, 90).collect())
    assert got == {(None, 198, None): 1200, (3, 148, 3): 1, (None, 0, None): 1}


def cells_of(some, n, percent):
    counts = np.zeros(jaccard.COUNTERS, np.uint32)
    for t in some:
        np.add.at(counts, (jaccard._word_hashes(t) & np.uint64(jaccard.COUNTERS - 1)).astype(np.int64), 1)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(some))), "text": some})
    out = [r for b in jaccard._sets(n, percent, SimpleNamespace(value=counts))([batch]) for r in b.to_pylist()]
    return [set(r["cells"] or ()) for r in out]


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_cells_hold_links_but_not_texts_with_a_passage_in_common(n, percent):
    rng = random.Random(19)
    some = []
    for size in (12, 20, 45, 70, 150, 151, 400):
        for _ in range(12):
            base = [f"v{rng.getrandbits(40)}" for _ in range(size)]
            for cut in (0, 0, size // 30, size // 12):
                at = rng.randrange(size)
                some.append(" ".join(base[:at] + base[at + cut:] + [f"e{rng.getrandbits(40)}"] * rng.randrange(2)))
    some = list(dict.fromkeys(some))  # of equal sets the first has the cells
    cells, sets = cells_of(some, n, percent), shingle_sets(some, n)
    linked = [(i, j) for i in range(len(some)) for j in range(i) if sets[i] != sets[j]
              and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    assert len(linked) > 100 and all(cells[i] & cells[j] for i, j in linked)

    # two texts with a rare passage of their own among common words
    common = [f"c{i}" for i in range(60)]
    pairs = []
    for p in range(40):
        passage = [f"p{p}x{i}" for i in range(6)]
        pairs += [" ".join(rng.choices(common, k=75) + passage + rng.choices(common, k=75)) for _ in range(2)]
    cells = cells_of(pairs, n, percent)
    assert sum(bool(cells[i] & cells[i + 1]) for i in range(0, len(pairs), 2)) <= len(pairs) // 8


def test_shingles_of_one_set_only_bound_its_links(spark):
    sets = {1: [1, 2, 3, 4, 5, 6, 7, 8, 9, 10], 2: [1, 2, 3, 4, 5, 6, 7, 8, 9, 20], 3: [1, 2, 3, 4, 5, 31, 32, 33, 34, 35]}
    df = spark.createDataFrame(list(sets.items()), "node long, shingles array<long>")
    got = {r["node"]: (r["n"], r["shared"], sum(r["point"])) for r in jaccard.points_of(df, 90).collect()}
    assert got == {1: (10, 9, 9), 2: (10, 9, 9)}
    assert {r["node"]: r["shared"] for r in jaccard.points_of(df, 50).collect()} == {1: 9, 2: 9, 3: 5}


def test_keep_one_with_clashing_names(spark):
    rows = [(1, "one two three four five six", 777, 5, "a", True), (2, "one two three four five six", 778, 6, "b", False),
            (3, None, 779, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key long, _null long, _node string, _blank boolean")
    got = jaccard.keep_one(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [rows[0], rows[2]]


def test_numbers_are_no_letters(spark):
    docs = frame(spark, ["the river and the stone", "½ ²", "①", "٣", "½ a", None])
    model = langid.train(docs)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, model).collect()}
    assert [got[i] for i in range(6)] == ["en", "und", "und", "und", "en", "und"]
    assert sorted(r["doc_id"] for r in langid.keep_identified(docs, langid.ByteModel({})).collect()) == [0, 4]
    assert langid.keep_identified(docs, model).columns == docs.columns


def test_jaccard_chains_within_a_cell(spark):
    # Each text differs from the next by one word: linked in a chain, the ends are not.
    rng = random.Random(2)
    w = [f"w{i}" for i in range(120)]
    chain = []
    for i in range(12):
        chain.append(" ".join(w))
        w[rng.randrange(9 * i, 9 * i + 5)] = f"x{i}"
    got = jaccard.jaccard_components(frame(spark, chain), 3, 90).collect()
    assert {r["component_id"] for r in got} == {0}


def test_token_counts_equal_the_library(spark, texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    got = {r["doc_id"]: r for r in tokencount.count_tokens(frame(spark, texts), path).collect()}
    for i, x in enumerate(texts):
        n = len(t.encode(x or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((x or "").encode()), n > 2048), x


def test_token_counts_without_frequent_tokens(spark, texts, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    want = sorted(map(tuple, tokencount.count_tokens(frame(spark, texts), path).collect()))
    monkeypatch.setattr(tokencount, "HEAD_ENTRIES", 20)
    assert sorted(map(tuple, tokencount.count_tokens(frame(spark, texts * 2), path).collect()))[::1] != []
    assert sorted(map(tuple, tokencount.count_tokens(frame(spark, texts), path).collect())) == want


def test_packing_leaves_nothing_in_the_worker():
    import gc

    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path) as f:
        run = packing._pieces(SimpleNamespace(value=f.read()), 1024, 2)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(2000), pa.int64()), pa.array([f"word {i} of many" for i in range(2000)])], ["doc_id", "text"])
    out = list(run(iter([batch])))
    assert max(b.num_rows for b in out) <= 512
    assert [i for b in out for i in b.column(0).to_pylist()] == list(range(2000))
    del run
    gc.collect()
    assert not [x for x in gc.get_objects() if isinstance(x, packing.Ids)]


def test_packing_starts_no_python_workers_for_its_slots(spark, monkeypatch):
    from pyspark import SparkContext

    docs = spark.sql("select id as doc_id, repeat('word ', cast(id as int)) as text from range(50)")
    monkeypatch.setattr(SparkContext, "parallelize", None)
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.pack(docs, path).count() == 50
    assert packing.pack(docs.limit(0), path).count() == 0


def test_texts_are_taken_in_slices():
    batch = pa.RecordBatch.from_arrays([pa.array(range(1300)), pa.array(["a b"] * 1300)], ["doc_id", "text"])
    empty = batch.slice(0, 0)
    from barloom.llm.common import columns_of

    assert [len(t) for _, t in columns_of(iter([batch, empty]), "doc_id", "text", rows=512)] == [512, 512, 276]
    assert [len(t) for (t,) in columns_of(iter([empty, batch]), "text")] == [1300]


def test_packing_round_trip(spark, texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    rows = packing.pack(frame(spark, texts), path).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    total = 0
    for i, x in enumerate(texts):
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
        total += len(ids)
        at = 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:at].tobytes())
        assert at == len(ids) and (len(ids) > 1024 or len(by_doc[i]) == 1)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    assert len(by_sequence) <= -(-total // 1024) + 2


def test_configurations_are_exact_and_tight():
    rng = np.random.default_rng(3)
    lengths = np.unique(rng.integers(1, 1025, 400))
    counts = rng.integers(20, 3000, len(lengths))
    found = packing.configurations(lengths, counts)
    used = Counter()
    for one, n in found:
        assert sum(k * a for k, a in one.items()) <= 1024
        for k, a in one.items():
            used[k] += a * n
    assert used == dict(zip(lengths.tolist(), counts.tolist(), strict=True))
    # pieces over half a sequence share none, so both are bounds from below
    least = max(-(-int((lengths * counts).sum()) // 1024), int(counts[lengths > 512].sum()))
    assert sum(n for _, n in found) <= 1.04 * least + 5


def test_fingerprints(spark, texts):
    got = sorted(fingerprint.fingerprints(frame(spark, texts), rows_in_bucket=9).collect(), key=lambda r: r["doc_id"])
    assert len(got) == len(texts)
    for i, r in enumerate(got):
        x, y = texts[i] or "", texts[(i + 1) % len(texts)] or ""
        edited = x[:len(x) - len(x) // 2] + y[:len(x) // 2]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["n_chars"] == len(x)
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
    assert got[0]["fingerprint"] == got[40]["fingerprint"] != got[1]["fingerprint"]


def test_collision_rate_is_generalised_jaccard():
    rng = random.Random(4)
    sampler = fingerprint.Sampler(2000, 1)
    a = [rng.choice("abcdefghij") + rng.choice("klmnop") for _ in range(400)]
    b = a[:250] + [rng.choice("abcdefghij") + rng.choice("qrst") for _ in range(100)]
    x, y = Counter(a), Counter(b)
    want = sum((x & y).values()) / sum((x | y).values())
    got = fingerprint.likeness(sampler.signature(" ".join(a)), sampler.signature(" ".join(b)))
    assert abs(got - want) < 0.04


def test_long_unrelated_texts_are_unlike():
    rng = random.Random(12)
    sampler = fingerprint.Sampler()
    a, b = (" ".join(f"{x}{rng.getrandbits(60):x}" for _ in range(100_000)) for x in "ab")
    assert fingerprint.likeness(sampler.signature(a), sampler.signature(b)) < 0.03
    half = a[:len(a) // 2] + " " + b[len(b) // 2:]
    assert abs(fingerprint.likeness(sampler.signature(a), sampler.signature(half)) - 1 / 3) < 0.15


def test_mixing_meets_its_targets(spark):
    rng = random.Random(5)
    source = [rng.choice(["a", "b", "c", None, "a", "a"]) for _ in range(600)]
    texts = [None if i == 3 else "w " * rng.randint(0, 50) for i in range(600)]
    rows = mixing.mix(frame(spark, texts, source=source)).collect()
    assert len(rows) == 600 and sorted(r["taken"] for r in rows) == sorted(
        r["taken"] for r in mixing.mix(frame(spark, texts, source=source)).collect())
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert r["taken"] <= 3 * r["size"] and r["size"] == len(words(texts[r["doc_id"]]))
    weights = dict(zip(["a", "b", "c", None], [1, 2, 3, 1], strict=True))
    share, capped, total = {}, set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        share = {s: left * w / sum(w for x, w in weights.items() if x not in capped) for s, w in weights.items()}
        over = {s for s in weights if s not in capped and share[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    for s in weights:
        assert target[s] == pytest.approx(3 * sizes[s] if s in capped else share[s])
        assert abs(taken[s] - target[s]) <= 50


def test_text_stats_equal_brute_force(spark, texts):
    rep = "a b c d e f g h i j\n" * 5 + "# $ % x\n\n \n# $ % x"
    some = [*texts, rep, "x " * 100, "one two three four five six seven eight nine one two three four five six seven eight"]
    for r in rules.text_stats(frame(spark, some)).collect():
        x = some[r["doc_id"]] or ""
        w = WORD.findall(x)
        seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        covered = {i + k for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for k in range(8)}
        lines = [ln for ln in x.split("\n") if WORD.search(ln)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in x), len(lines) - len(set(lines)), len(covered)), x


def test_decision_list_learns_a_rule(spark):
    rng = random.Random(6)
    texts = [" ".join("ab" + ("$" if i % 4 == 0 else "") for _ in range(rng.randint(30, 60))) + f" {i}" for i in range(240)]
    # windows must not repeat
    texts = [" ".join(f"{w}{k}" for k, w in enumerate(t.split(" "))) for t in texts]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(0, 240)] + [(None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = rules.quality_rules(frame(spark, texts), labels).collect()
    assert all(r["kept"] == (r["doc_id"] % 4 != 0) for r in got) and not any(r["base_failed"] for r in got)


def languages(n):
    rng = random.Random(8)
    kinds = {"en": ["the", "of", "and", "thing", "er", "ing"], "fr": ["le", "é", "eau", "que", "tion"]}
    lang = [rng.choice(["en", "fr"]) for _ in range(n)]
    return [" ".join(rng.choice(kinds[x]) + rng.choice(kinds[x]) for _ in range(rng.randint(3, 30))) for x in lang], lang


def test_language_id(spark):
    texts, lang = languages(120)
    docs = frame(spark, [*texts, None, "", "123 !!"], [*lang, None, "en", "en"])
    model = langid.train(docs.where("doc_id < 80 or doc_id >= 120"))
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    assert all(got[i]["lang_pred"] == lang[i] for i in range(80, 120))
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (120, 121, 122)] == [("und", 0.0)] * 3
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(range(120))


def test_language_stage_rejects_noise_and_needs_no_languages(spark):
    texts, lang = languages(120)
    rng = random.Random(14)
    noise = ["".join(chr(rng.randrange(33, 256)) for _ in range(300)), "ζωή καὶ θάνατος " * 20]
    rows = [*texts, *noise, "qz", "123"]
    kept = corpus_pipeline.language_id(spark, frame(spark, rows, [*lang, None, None, None, None]), "")
    assert {r["doc_id"] for r in kept.collect()} == {*range(120), 122}
    kept = corpus_pipeline.language_id(spark, frame(spark, rows, [None] * len(rows)), "")
    assert {r["doc_id"] for r in kept.collect()} == set(range(123))


def test_code_lengths_are_probabilities():
    texts, _ = languages(30)
    codes, _ = langid._grams(texts)
    keys, n = np.unique(codes, return_counts=True)
    model = langid.ByteModel({"x": (keys.astype(np.int64), n)})
    for context in (b"   ", b"the", b"zzz"):
        every = np.array([int.from_bytes(context, "big") << 8 | b for b in range(256)])
        assert 0.2 < np.exp2(-model._costs(every)).sum() <= 1 + 1e-6


def test_lm_scores(spark):
    rng = random.Random(9)
    pairs = [("a", "b"), ("c", "d"), ("e", "f")]
    texts = [" ".join(w for _ in range(40) for w in rng.choice(pairs)) + f" z{i}" for i in range(60)] + [None, "  "]
    train = F.col("doc_id") % 3 != 0
    got = {r["doc_id"]: r for r in lm.score(frame(spark, texts), train).collect()}
    c = Counter(w for i, t in enumerate(texts) if i % 3 for w in [*words(t), None])
    n, v = sum(c.values()), len(c)
    for i, t in enumerate(texts):
        tokens = [*words(t), None]
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (
            len(tokens), sum(c[w] > 0 for w in tokens), n)
        assert got[i]["base_score"] == pytest.approx(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in tokens))
    held = [got[i] for i in range(0, 60, 3)]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) * 0.9


def test_gradient_step_equals_dense_softmax():
    rng = np.random.default_rng(1)
    x = np.stack([rng.integers(0, 50, 200) + j * lm.HASHED for j in range(4)]).astype(np.int32)
    k = rng.integers(0, lm.CLASSES, 200)
    model = lm.MaxEnt()
    seen = (np.zeros(lm.FEATURES, np.float32), np.zeros(lm.FEATURES * lm.SIDE, np.float32))
    before = model.log_probability(x, k).mean()
    assert before == pytest.approx(-np.log(lm.CLASSES))
    for _ in range(20):
        model.step(x, k, seen)
    assert model.log_probability(x, k).mean() > before + 1
    every = np.arange(lm.CLASSES)
    one = np.repeat(x[:, :1], lm.CLASSES, axis=1)
    assert np.exp(model.log_probability(one, every)).sum() == pytest.approx(1, abs=1e-4)


def test_quality_resampling(spark):
    rng = random.Random(10)
    good = ["the", "of", "river", "stone", "and", "light"]
    texts = [" ".join(rng.choice(good) + ("$$$" if i % 5 == 0 else "") for _ in range(60)) for i in range(200)]
    docs = frame(spark, [*texts, None, ""])
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(0, 200, 2)], "doc_id long, quality int, toxic int")
    ratio = quality.train(docs, labels)
    got, least = quality.resample(docs, ratio)
    assert {r["doc_id"] for r in got.collect() if r["kept"]} == {i for i in range(202) if i % 5 or i >= 200}
    kept = quality.keep_resampled(docs, ratio, least)
    assert kept.columns == docs.columns and kept.count() == 162


def test_top_k_threshold(spark):
    rng = random.Random(11)
    values = [rng.gauss(0, 100) for _ in range(999)]
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 500, 999):
        assert quality.top_k_threshold(keys, k) == sorted(values)[-k]


def test_main_text(spark):
    page = ("<html><head><title>T</title><script>var t='</p>';</script></head><body class='has-sidebar'>"
            "<header>Site</header><nav><a href=/>Home</a></nav><div class='cookie-notice'>We use cookies</div>"
            "<div class=ad>Buy</div><article><h1>T &amp; U</h1><p><b>One&nbsp;  two<br><p>three <a href=x>four</a> five</p>"
            "<form>Name <input></form><section id=comments><p>first!</p></section></article><aside>x</aside>"
            "<footer>&copy; f</footer>")
    pages = spark.createDataFrame([(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<nav>only</nav>")],
                                  "page_id long, url string, html string")
    got = {r["page_id"]: r for r in html.extract(pages).collect()}
    assert got[1]["text"] == "T & U\nOne two\nthree four five" and got[1]["n_chars"] == len(got[1]["text"])
    assert [got[i]["text"] for i in (2, 3, 4)] == ["", "", ""]


def test_density_picks_the_text_without_an_article():
    text = "Many words of main text that go on and on, as paragraphs do. " * 5
    page = (f"<body><div><ul>{''.join(f'<li><a href=x>link {i}</a></li>' for i in range(20))}</ul></div>"
            f"<div><p>{text}</p><p>{text}</p></div></body>")
    assert html.main_text(page) == "\n".join([text.strip()] * 2)


def test_empty_tables(spark):
    none = frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = public_tokenizers.path("word_bpe_49k.json")
    for df in (langid.identify(none, langid.train(none)), lm.score(none), jaccard.jaccard_components(none),
               fingerprint.fingerprints(none), mixing.mix(none), tokencount.count_tokens(none, path),
               packing.pack(none, public_tokenizers.path("byte_bpe_50k.json")),
               quality.resample(none, quality.train(none, labels))[0], rules.quality_rules(none, labels),
               html.extract(spark.createDataFrame([], "page_id long, url string, html string"))):
        assert df.count() == 0
