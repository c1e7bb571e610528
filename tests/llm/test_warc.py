from __future__ import annotations

import glob
import gzip
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barloom.llm import warc

PAGES = "page_id long, url string, html string, page string, digest string, first long, hot boolean"


def pages_of(spark, rows):
    """Pages with extra columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, "x", "y", 0, False) for r in rows], PAGES)


def wanted(rows):
    first = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and page is not None:
            first[body] = min(page, first.get(body, page))
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        refers = first.get(body) if first.get(body) != page else None
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "response" if refers is None else "revisit", refers))
    return Counter(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = ["".join(rng.choice("<p>é \r\nWARC/1.0abc") for _ in range(n)) for n in (99, 100, 101, 5000, 300_000)]
    same = "<html>" + "copy " * 40
    out = [(i, f"http://x/{i}", rng.choice(texts)) for i in range(300, 0, -1)]
    out += [(i, "http://x/ y\r\nWARC-Type: none", same) for i in range(1000, 1400)]
    out += [(None, None, same), (None, "u", "z" * 200), (None, "u", "z" * 200), (7, None, None), (8, "", ""), (9, "u", "short")]
    out += [(1000, "u", same), (1, None, "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n" * 9)]
    return out


def test_round_trip_equals_brute_force(spark, rows, monkeypatch, tmp_path):
    from barloom.llm import warc as module

    monkeypatch.setattr(module, "table", lambda *_: pages_of(spark, rows).repartition(5))
    got = module.op11_warc(spark, "")
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(tuple(r) for r in got.collect()) == wanted(rows)
    monkeypatch.setattr(module, "table", lambda *_: pages_of(spark, []))
    assert module.op11_warc(spark, "").count() == 0


def test_archives_are_gzip_files_with_whole_payloads(spark, rows, tmp_path):
    folder = str(tmp_path / "a")
    warc.write_archives(pages_of(spark, rows), folder)
    plain = tmp_path / "plain"
    plain.mkdir()
    for i, f in enumerate(glob.glob(f"{folder}/part-*")):
        raw = gzip.decompress(open(f, "rb").read())
        (plain / f"part-{i}.warc").write_bytes(raw)
    want = Counter((r[0], (r[2] or "").encode()) for r in rows)
    for path in (folder, str(plain)):
        read = warc.read_archives(spark, path, files="part-*")
        assert read.where("gap IS NOT NULL").count() == 0
        full = read.alias("a").join(read.where("record_type = 'response'").dropDuplicates(["payload_digest"]).select(
            "payload_digest", F.col("payload").alias("whole")), "payload_digest")
        got = Counter((int(r["record_id"][11:]) if r["record_id"] != "urn:x-page:" else None, bytes(r["whole"]))
                      for r in full.collect())
        assert got == want


def chain(n, zipped, size=400):
    rng = random.Random(n)
    recs = []
    for i in range(n):
        body = bytes(rng.choice(b"abc <>\r\n") for _ in range(size))
        recs.append(warc.record(str(i), f"u{i}", body, hashlib.sha256(body).hexdigest(), None, False))
    return [warc._member(r) for r in recs] if zipped else recs


def read(data):
    good, gaps = [], []
    for start, end, r in warc.salvage(data):
        if isinstance(r, str):
            gaps.append((start, end, r))
        else:
            good.append(int(r.headers["warc-record-id"][12:-1]))
    return good, gaps


@pytest.mark.parametrize("zipped", [True, False])
def test_damage_costs_only_the_records_it_hits(zipped):
    rng = random.Random(5)
    for trial in range(150):
        parts = chain(12, zipped)
        hit = rng.sample(range(12), rng.randint(1, 4))
        starts, data, lost = [], b"", []
        for i, p in enumerate(parts):
            if i in hit:
                p = bytearray(p)
                kind = rng.choice(["flip", "cut", "junk", "head"])
                # Nothing guards the headers of a plain record: leave its id as it is.
                at = rng.randrange(20 if zipped else p.index(b"WARC-Date"), len(p) - 12)
                if kind == "flip":
                    p[at] ^= 1 + rng.randrange(255)
                elif kind == "cut":
                    del p[at:]
                elif kind == "junk":
                    p[at:at] = bytes(rng.randrange(256) for _ in range(50))
                else:
                    p[0] ^= 255
                p = bytes(p)
            starts.append(len(data))
            data += p
        good, gaps = read(data)
        sound = set(range(12)) - set(hit)
        assert sound <= set(good) and len(good) == len(set(good))
        damaged = set(range(12)) - set(good)
        for i in damaged:  # the bytes of a lost record are all in gaps
            end = starts[i + 1] if i < 11 else len(data)
            assert any(a <= starts[i] and end <= b for a, b, _ in gaps)
        assert sum(b - a for a, b, _ in gaps) <= sum(
            (starts[i + 1] if i < 11 else len(data)) - starts[i] for i in damaged) + 600 * (not zipped) * len(hit)


def test_reasons_and_edges():
    good = chain(3, False)
    wrong = good[1].replace(b"sha256:", b"sha256:0", 1)
    assert read(good[0] + wrong + good[2])[1][0][2] == "payload has another digest"
    assert read(b"") == ([], []) and read(b"junk") == ([], [(0, 4, "no version line")])
    assert read(warc.EMPTY_MEMBER * 3) == ([], [])
    two = warc._member(good[0] + good[1])
    assert read(two)[0] == [0, 1] and read(two + good[2])[0] == [0, 1, 2]
    assert read(warc._member(good[0] + b"tail"))[0] == [0]
    assert read(warc._member(good[0])[:-9])[1][0][2] == "member is cut off"
    assert read(good[0][:-2] + good[1])[0] == [1]


def test_gaps_are_logged(spark, tmp_path):
    parts = chain(6, True)
    data = b"".join(parts[:2]) + b"lost bytes" + b"".join(parts[2:4]) + parts[4][:40] + parts[5]
    (tmp_path / "a.warc.gz").write_bytes(data)
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    got = warc.read_archives(spark, str(tmp_path), files="*.warc.gz")
    assert got.where("gap IS NULL").count() == 5
    assert warc.log_gaps(got, str(tmp_path / "gaps")) == 50
    logged = spark.read.json(str(tmp_path / "gaps")).orderBy("start").collect()
    assert [r["end"] - r["start"] for r in logged] == [10, 40] and logged[0]["archive"].endswith("a.warc.gz")
