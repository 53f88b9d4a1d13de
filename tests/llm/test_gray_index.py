"""SimHash components against a comparison of all fingerprints."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from admosaic.llm import gray_index

from .cases import documents, spaced, texts, words


def plain_fingerprint(text, width):
    w = spaced(text)
    runs = [" ".join(w[k : k + width]) for k in range(max(1, len(w) - width + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_roots(codes, most):
    """For each distinct code the smallest one that it reaches."""
    codes = np.array(sorted(codes), np.uint64)
    linked = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= most
    root = np.arange(len(codes))
    while True:
        new = np.where(linked, root[None, :], len(codes)).min(axis=1)
        if (new == root).all():
            return {int(c): int(codes[r]) for c, r in zip(codes, root, strict=True)}
        root = new


def small(monkeypatch, block=40, fan=3, top=4):
    for name, value in (("BLOCK", block), ("RUNS", (12, 4)), ("FAN", fan), ("TOP", top), ("VISITORS", 50), ("TESTED", 256), ("MANY", 5)):
        monkeypatch.setattr(gray_index, name, value)


def family(rng, n):
    """Copies of one text with ever more words changed."""
    base = words(rng, 120)
    out = []
    for k in range(n):
        copy = list(base)
        for _ in range(rng.choice((0, 0, 1, 1, 2, 4, 9))):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(50)}"
        out.append((7_000 + k, " ".join(copy)))
    return out


@pytest.mark.parametrize(("width", "most"), [(3, 2), (1, 4)])
def test_components_are_exact(spark, monkeypatch, width, most):
    small(monkeypatch)
    monkeypatch.setattr(gray_index, "PIECE", 30)
    rows = texts() + family(random.Random(8), 150)
    codes = [plain_fingerprint(t, width) for _, t in rows]
    roots = plain_roots(set(codes), most)
    least = {}
    for (i, _), c in zip(rows, codes, strict=True):
        if i is not None:
            least[roots[c]] = min(i, least.get(roots[c], i))
    found = gray_index.near_copies(documents(spark, rows), width=width, most=most).collect()
    got = sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in found), key=str)
    assert got == sorted(((i, c, least.get(roots[c])) for (i, _), c in zip(rows, codes, strict=True)), key=str)


@pytest.mark.parametrize(("block", "fan", "top"), [(64, 5, 2), (65536, 256, 2048), (50, 256, 4000)])
def test_links_of_dense_and_loose_fingerprints(spark, monkeypatch, block, fan, top):
    rng = random.Random(block)
    codes = {rng.getrandbits(64) for _ in range(400)} | {0, 2**64 - 1}
    for centre in list(codes)[:6]:
        for _ in range(150):
            code = centre
            for _ in range(rng.choice((1, 2, 3, 5, 8))):
                code ^= 1 << rng.randrange(64)
            codes.add(code)
    if block < 65536:
        small(monkeypatch, block, fan, top)
    table = spark.createDataFrame([(c - 2**64 if c >= 2**63 else c,) for c in codes], "fp long").repartition(3)
    links = [(r["a"] % 2**64, r["b"] % 2**64) for r in gray_index.near_links(table).collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in links)
    root = {c: c for c in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert {c: find(c) for c in codes} == plain_roots(codes, 2)


def test_gray_rank_and_patterns(spark):
    table = spark.range(64).select(F.col("id").bitwiseXOR(F.shiftright("id", 1)).alias("code"), "id")
    assert all(r[0] == r[1] - 2**63 for r in table.select(gray_index.gray_rank(F.col("code")), "id").collect())
    codes = np.array([0b1100, 0b1110, 0b0001], np.uint64)
    masks, values = gray_index.pattern(codes, np.array([0, 2]))
    assert [int(m) for m in masks] == [2**64 - 1 - 0b10, 2**64 - 1] and [int(v) for v in values] == [0b1100, 1]
    mask, value = gray_index._shared_pattern(masks, values)
    assert int(mask) == 2**64 - 1 - 0b1111 and int(value) == 0


def test_equal_to_sparks_hash(spark):
    rows = [(k, t) for k, t in enumerate(["a b c", "Ä Ö ü", "one two", "x" * 100 + " y z"])]
    found = {r["doc_id"]: r["fp"] for r in gray_index.near_copies(documents(spark, rows)).collect()}
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert found == {r[0]: r[1] for r in documents(spark, rows).select("doc_id", F.xxhash64(lower)).collect()}


def test_empty_tables_and_wordless_texts(spark):
    assert gray_index.near_copies(documents(spark, [])).collect() == []
    rows = [(None, None), (3, ""), (2, " \n"), (9, "word")]
    found = {(r["doc_id"], r["component_id"]) for r in gray_index.near_copies(documents(spark, rows)).collect()}
    assert found == {(None, 2), (3, 2), (2, 2), (9, 9)}
