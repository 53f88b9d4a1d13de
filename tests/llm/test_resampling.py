"""Importance resampling against a plain version."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import pytest

from admosaic.llm import resampling

from .cases import documents, plain, texts, words


def runs(text, most):
    w = plain(text)
    return [" ".join(w[i : i + k]) for k in range(1, most + 1) for i in range(len(w) - k + 1)]


def brute(rows, target, most=1, buckets=10_000, seed=2024, percent=10, least=20):
    def bucket(x):
        return zlib.crc32(x.encode()) % buckets

    own = Counter(bucket(x) for _, t in rows for x in runs(t, most))
    wanted = Counter(bucket(x) for t in target for x in runs(t, most))
    s, t = sum(own.values()), sum(wanted.values())
    out = []
    for row, (i, text) in enumerate(rows):
        found = runs(text, most)
        gains = [math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((own[b] + 1) * (t + buckets)))) for b in map(bucket, found)]
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = sum(gains) + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(plain(text)), len(found), sum(gains), score, None, row])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[6]))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = rank
    return sorted((tuple(r[:6]) for r in out), key=str)


def rows_of(frame):
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_features", "weight", "score", "rank")) for r in frame.collect()), key=str)


@pytest.mark.parametrize(("most", "buckets", "percent", "piece"), [(1, 10_000, 10, 1 << 21), (1, 7, 60, 50), (3, 500, 100, 200), (2, 1000, 33, 1)])
def test_draws_are_exact(spark, monkeypatch, most, buckets, percent, piece):
    rng = random.Random(5)
    rows = texts()
    rows += [(900, "tie " * 30)] * 7 + [(901 + k, "w1 " * 25 + "x" * 200) for k in range(5)]
    target = [" ".join(words(rng, 40, 30)) for _ in range(20)] + [None, ""]
    wanted = brute(rows, target, most, buckets, percent=percent)
    monkeypatch.setattr(resampling, "PIECE", piece)
    monkeypatch.setattr(resampling, "FIRST_MARGIN", 0.0001)
    table = spark.createDataFrame([(k, t, "s") for k, t in enumerate(target)], "item_id long, text string, score string")
    found = resampling.resampled(documents(spark, rows), table, most=most, buckets=buckets, percent=percent)
    assert rows_of(found) == wanted


def test_target_texts_are_drawn_first(spark):
    rng = random.Random(6)
    rows = [(k, " ".join(words(rng, 60)) if k % 10 else " ".join(f"t{rng.randrange(50)}" for _ in range(60))) for k in range(300)]
    target = spark.createDataFrame([(" ".join(f"t{rng.randrange(50)}" for _ in range(80)),) for _ in range(30)], "text string")
    found = resampling.resampled(documents(spark, rows), target).where("rank IS NOT NULL")
    assert sorted(r["doc_id"] for r in found.collect()) == list(range(0, 300, 10))


def test_bracket_is_widened_until_it_holds_the_place(spark, monkeypatch):
    monkeypatch.setattr(resampling, "SKETCH", 8)
    monkeypatch.setattr(resampling, "FIRST_MARGIN", 1e-9)
    rng = random.Random(7)
    scores = [rng.randrange(2000) for _ in range(3000)] + [5] * 1500
    table = spark.createDataFrame([(k, k if k % 11 else None, s) for k, s in enumerate(scores)], "row long, id long, score long")
    order = sorted(range(len(scores)), key=lambda k: (-scores[k], k % 11 == 0, k))
    for wanted in (1, 2, 450, 3100, 4499, 4500):
        assert resampling.last_drawn(table, wanted, len(scores))["row"] == order[wanted - 1]


def test_empty_tables(spark):
    none = documents(spark, [])
    assert resampling.resampled(none, none).collect() == []
    rows = [(k, "word " * 25) for k in range(20)]
    assert rows_of(resampling.resampled(documents(spark, rows), none)) == brute(rows, [])
