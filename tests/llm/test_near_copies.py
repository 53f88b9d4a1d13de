"""The Jaccard join and components against plain versions."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from admosaic.llm import jaccard
from admosaic.llm.components import components
from admosaic.llm.shingles import shingle_sets
from admosaic.llm.textops import process_cache

from .cases import documents, spaced, texts, words


def shingles(text, width):
    w = spaced(text)
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(rows, width, percent):
    """The smallest row each row reaches."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sets, [find(k) for k in range(len(rows))]


def hot_family(rng, n):
    """Many copies of one text, from nearly equal to half changed, and a chain that drifts away from it."""
    base = words(rng, 60)
    out = []
    for k in range(n):
        copy = list(base)
        for _ in range(rng.choice((0, 1, 1, 2, 3, 6, 12))):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(9)}"
        out.append((5_000 + k, " ".join(copy)))
    drift = list(base)
    for k in range(12):
        drift[5 * k : 5 * k + 1] = [f"d{k}"]
        out.append((6_000 + k, " ".join(drift)))
    return out


@pytest.mark.parametrize(("width", "percent", "group"), [(3, 90, 512), (3, 90, 5), (5, 80, 7), (1, 60, 6)])
def test_components_are_exact(spark, monkeypatch, width, percent, group):
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "QUERIES_A_TASK", 9)
    rows = texts() + hot_family(random.Random(8), 90)
    got = jaccard.similar_components(documents(spark, rows), width=width, percent=percent).collect()
    sets, roots = brute(rows, width, percent)
    least = {}
    for (i, _), s, r in zip(rows, sets, roots, strict=True):
        if s and i is not None:
            least[r] = min(i, least.get(r, i))
    want = Counter((i, len(s), least.get(r) if s else i) for (i, _), s, r in zip(rows, sets, roots, strict=True))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want


def test_one_of_each_group_stays(spark):
    rows = texts() + hot_family(random.Random(9), 40)
    docs = documents(spark, rows)
    kept = jaccard.without_near_copies(docs)
    assert kept.schema == docs.schema
    sets, roots = brute(rows, 5, 80)
    groups, want = {}, set()
    for (i, t), s, r in zip(rows, sets, roots, strict=True):
        if s:
            groups.setdefault(r, []).append((i is None, i or 0, i))
        else:
            want.add((i, t))
    got = kept.collect()
    assert len(got) == len(groups) + len(want)
    assert {r["doc_id"] for r in got} == {min(g)[2] for g in groups.values()} | {i for i, _ in want}
    assert jaccard.without_near_copies(docs.limit(0)).count() == 0


def test_size_classes_meet():
    for percent in (60, 80, 90):
        rule = jaccard.Threshold(percent)
        for a in range(1, 600):
            for b in range(a, 100 * a // percent + 1):
                if rule.most_apart(a, b) >= 1:
                    shared = set(rule.classes(a)) & set(rule.classes(b))
                    assert any(rule.most_apart(high, high) >= rule.most_apart(a, b) for _, high in shared), (percent, a, b)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(5, 5), (1, 2), (2, 1), (3, 2)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in got}
    assert len(roots) == len(got) == 61 + 61 + 3
    assert {roots[k] for k in range(100, 161)} == {100} and {roots[k] for k in range(200, 260)} == {7}
    assert [roots[k] for k in (1, 2, 3)] == [1, 1, 1] and 5 not in roots
    assert components(spark.createDataFrame([], "a long, b long")).where(F.lit(True)).count() == 0


def test_sets_of_many_texts_take_little_memory():
    rng = random.Random(4)
    many = [" ".join(words(rng, 600, 1 << 20)).encode() for _ in range(700)]
    assert sum(map(len, many)) > 1 << 21
    tracemalloc.start()
    sizes = [len(s) for s in shingle_sets(many, 5)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(sizes) == len(many) and peak < 32 << 20


def test_signatures_are_dealt_to_lists():
    rng = random.Random(5)
    many = [" ".join(words(rng, n, 1 << 20)) for n in (0, 3, 30, 300, 900)]
    none = pa.array([0] * len(many), pa.int64())
    batch = pa.RecordBatch.from_arrays([none, none, none, none, pa.array(many)], ["row", "id", "t1", "t2", "text"])
    (out,) = jaccard._sets_of(5, 80)(iter([batch]))
    dealt = [[out.column(f"{c}{k}").to_pylist() for k in range(2)] for c in jaccard._SLICES]
    for row, s in enumerate(shingle_sets([t.encode() for t in many], 5)):
        schemes = jaccard.signatures(s, jaccard.Threshold(80))
        for k in range(2):
            want = schemes[k][1].view(np.int64).tolist() if k < len(schemes) else []
            assert sorted(x for d in dealt for x in d[k][row]) == sorted(want)
    total = sum(len(x) for d in dealt for k in d for x in k)
    for d in dealt:
        assert 0 < sum(len(x) for k in d for x in k) < total // 2
    seen = [{x for k in d for r in k for x in r} for d in dealt]
    assert len(set.union(*seen)) == sum(map(len, seen))


def test_other_steps_caches_are_freed():
    process_cache("byte-bpe")["file"] = "encoder"
    process_cache("part-counts")[0] = 1
    assert list(jaccard._sets_of(5, 80)(iter([]))) == []
    assert process_cache("byte-bpe") == {} and process_cache("part-counts").pop(0) == 1
