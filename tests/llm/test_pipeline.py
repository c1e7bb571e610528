from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest

from barloom.llm import langid, quality
from test_operators import groups_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _noise double, _key long, taken string"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(23)
    words = {"en": ["the", "river", "and", "stone", "light", "of"], "de": ["der", "fluss", "und", "stein", "licht", "vom"]}
    out = []
    for i in range(150):
        lang = "en" if i % 3 else "de"
        text = " ".join(rng.choice(words[lang]) + rng.choice(["", f"{rng.randrange(50)}", "."]) for _ in range(rng.randint(20, 90)))
        out.append([i, text, lang, "hot" if i % 3 else rng.choice(["a", "b", None])])
    for i in range(0, 30):
        out.append([200 + i, out[i][1] + (" end" if i % 2 else ""), out[i][2], out[i][3]])
    out += [[300, None, None, "a"], [301, "", "en", "b"], [302, "½ 12 ---", "en", None], [303, "\x00\x07" * 400, None, "a"]]
    out += [[None, out[3][1], "en", "hot"], [None, "the river of light and the stone of the river", "en", None]]
    out += [[7, "the light of the stone and the river and the stone", "en", "a"]] * 2
    return [(*r, 1, 0.5, 9, "t") for r in out]


def plain(df):
    return Counter(map(tuple, df.collect()))


def after_language(rows):
    """The stage, text by text, over a model counted in this process."""
    grams = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        if text is not None and lang is not None:
            raw = text.encode()
            padded = langid._grams([text])[0]
            assert len(padded) == len(raw)
            grams[lang].update(padded.tolist())
    model = langid.ByteModel({lang: (np.array(sorted(c)), np.array([c[k] for k in sorted(c)])) for lang, c in grams.items()})
    own = defaultdict(list)
    judged = {}
    for r in rows:
        (name,), score, rate = model.predict([r[1]])
        judged[r[1]] = (name, score[0], rate[0])
        if name == r[2]:
            own[name].append(rate[0])
    limits = {n: 2 * sorted(v)[int(np.ceil(0.99 * len(v))) - 1] for n, v in own.items()}
    return Counter(r for r in rows for n, s, b in [judged[r[1]]] if n != "und" and s >= 0.5
                   and (b - limits.get(n, 1e9)) * len(r[1].encode()) <= langid.SLACK_BITS)


def test_stages_equal_brute_force(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    labels = [(i, int(i % 4 > 0), int(i % 9 == 0)) for i in range(0, 150, 2)]
    label_table = spark.createDataFrame(labels, LABELS)
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, name: {"documents": docs, "labels": label_table}[name])

    first = corpus_pipeline.language_id(spark, docs, "")
    want = after_language(rows)
    assert first.columns == docs.columns and plain(first) == want and 300 not in {r[0] for r in want}

    second = corpus_pipeline.quality_classifier(spark, first, "")
    kept = sorted(want.elements(), key=str)
    good = {i for i, q, t in labels if q and not t}
    raw, target = np.ones(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for r in kept:
        h = np.bincount(quality._hashes(r[1]), minlength=quality.BUCKETS)
        raw += h
        target += h * (r[0] in good)
    raw /= raw.sum()
    ratio = (target + quality.PRIOR) / (target.sum() * raw + quality.PRIOR)
    lr = np.log(ratio) - np.log((raw * ratio).sum())
    noise = {r["doc_id"]: r["g"] for r in spark.createDataFrame(kept, DOCS).select("doc_id", quality.gumbel().alias("g")).collect()}
    scores = [lr[quality._hashes(r[1])].sum() for r in kept]
    keys = [s + noise[r[0]] for s, r in zip(scores, kept, strict=True)]
    k = sum(s >= -quality.MARGIN for s in scores)
    least = sorted(keys, reverse=True)[k - 1]
    want = Counter(r for r, x in zip(kept, keys, strict=True) if x >= least - 1e-9)
    assert second.columns == docs.columns and plain(second) == want

    third = corpus_pipeline.near_duplicates(spark, second, "")
    got = plain(third)
    known = sorted(want, key=lambda r: (r[0] is None, r[0] or 0))
    tops = groups_of([r[1] for r in known], 5, 80)
    chosen = [known[i] for i in range(len(known)) if tops[i] == i]
    assert third.columns == docs.columns and sum(got.values()) == len(set(tops))
    by_id = Counter(r[0] for r in got if r[0] is not None)
    assert by_id == Counter(r[0] for r in chosen if r[0] is not None)

    fourth = corpus_pipeline.mix_sources(spark, third, "")
    copies = plain(fourth)
    assert fourth.columns == docs.columns and set(copies) <= set(got) and max(copies.values()) <= 3
    size = {r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in got}
    total = sum(size.values())
    assert abs(sum(size[r] * n for r, n in copies.items()) - total) <= 3 * max(size.values()) * len({r[3] for r in got})

    pieces = corpus_pipeline.pack_sequences(spark, fourth, "").collect()
    fill = defaultdict(list)
    for p in pieces:
        fill[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in fill.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert Counter(p["doc_id"] for p in pieces if p["piece"] == 0) == Counter(r[0] for r in copies.elements())

    ran = corpus_pipeline.run(spark, "")
    assert ran.columns == corpus_pipeline.pack_sequences(spark, fourth, "").columns and ran.count() == len(pieces)


def test_empty_tables_run_through(spark, monkeypatch):
    tables = {"documents": spark.createDataFrame([], DOCS), "labels": spark.createDataFrame([], LABELS)}
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, name: tables[name])
    assert corpus_pipeline.run(spark, "").count() == 0
