"""Quality rules, decontamination, secrets and licenses against plain versions in Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest

from admosaic.llm import decontaminate, licenses, quality, secrets

from .cases import SCHEMA, documents, plain, spaced, texts


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, texts())


def test_quality_counts(docs):
    got = quality.quality_report(docs).collect()
    assert len(got) == len(texts())
    want = Counter()
    for i, t in texts():
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        win = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        n = Counter(win)
        rep = {k + d for k, x in enumerate(win) if n[x] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        base_failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
        want[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep), base_failed] += 1
    keys = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[k] for k in keys) for r in got) == want
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_quality_keeps_columns_and_empty_tables(docs, spark):
    kept = quality.keep_good(docs)
    assert kept.schema == docs.schema
    assert quality.keep_good(docs.limit(0)).count() == 0
    good = [(1, "the house of the old man is on the hill and it was for him to be there " * 1 + " ".join(f"word{k} of" for k in range(40)))]
    assert quality.keep_good(documents(spark, good)).count() == 1


def brute_contamination(rows, items):
    windows = {}
    for item, t in items:
        w = plain(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(str(item))
    sizes = {len(k) for k in windows}
    out = Counter()
    for i, t in rows:
        w, hit, found = plain(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= got
        out[i, len(w), len(hit), tuple(sorted(found))] += 1
    return out


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today again"),
    (2, None), (3, ""), (4, "short item"), (10, "ß É"), (5, "the the the the the the the the the the the"), (4, "short item"),
]


def test_contamination(spark):
    rows = [
        *texts()[:60],
        (900, "so THE quick brown fox, jumps over the lazy dog near the river bank today again it said"),
        (901, "quick brown fox jumps over the lazy dog near the"),
        (902, "a short-item and short item " * 50), (902, "a short-item and short item " * 50), (903, "the " * 25), (904, "É ß É"), (905, "ß é"),
    ]
    docs = documents(spark, rows)
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    got = decontaminate.contamination(docs, items).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got) == brute_contamination(rows, ITEMS)
    assert all(r["contaminated"] == (r["n_hit"] > 0) and r["near_items"] >= len(r["items"]) for r in got)
    clean = decontaminate.clean_documents(docs, items)
    assert clean.schema == docs.schema
    want = sorted(str(k[0]) for k, n in brute_contamination(rows, ITEMS).items() for _ in range(n) if not k[2])
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == want


def test_contamination_of_nothing(spark):
    docs = documents(spark, texts()[:20])
    items = spark.createDataFrame([], "item_id int, text string")
    assert decontaminate.contamination(docs, items).where("contaminated").count() == 0
    assert decontaminate.contamination(docs.limit(0), spark.createDataFrame(ITEMS, "item_id int, text string")).count() == 0


BASE = (
    ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)


def test_secrets(spark):
    copied = "c0ffee" * 6
    rows = [
        *texts()[:40],
        (700, f"😀 é Password = \"abcdef\" passwd:abc token: token: abcdefgh api_key='{copied}' AKIA{'A1' * 9} AKIAAKIA {'0a' * 11}"),
        (701, f"token={copied}"), (702, f"token={copied}"), (703, f"token={copied}"), (704, "secret = live-value-1"), (704, "secret = live-value-1"),
        (705, "ghp_" + "aB3" * 12 + " " + "Ab1/" * 12),
    ]
    docs = documents(spark, rows)
    got = secrets.secret_report(docs).collect()
    want = Counter()
    for i, t in rows:
        found = []
        for order, (kind, pattern, group, least) in enumerate(BASE):
            found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(t or "") if len(m.group(group)) >= least]
        digest = hashlib.sha256(",".join(x for _, _, x in sorted(found)).encode()).hexdigest()
        want[i, *(sum(o == k for _, o, _ in found) for k in range(3)), digest] += 1
    assert Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got) == want
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[701]["n_example"] == 2 and by_id[701]["n_live"] == 0
    assert by_id[704]["n_live"] == 1
    assert "vendor:0:40" in by_id[705]["spans"] and "blob:" in by_id[705]["spans"]
    done = secrets.redacted(docs, length_col="n_chars")
    assert done.schema == docs.schema and done.count() == len(rows)
    text = {r["doc_id"]: r["text"] for r in done.collect()}
    assert text[704] == "[SECRET]" and text[701] == f"token={copied}" and text[1] is None


def test_licenses_of_one_family_are_told_apart(spark):
    told = [
        ("It is licensed under the GNU General Public License, version 3.", "gpl-3"),
        ("It is licensed under the GNU General Public License, version 2 or later.", "gpl-2"),
        ("version License 2 licensed GNU the under Public General 3", ""),
        ("Licensed under CC BY 4.0.", "cc-by"), ("Licensed under CC BY-SA 4.0.", "cc-by-sa"), ("Licensed under CC BY-ND 4.0.", "cc-by-nd"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("Licensed under CC BY-NC-SA 4.0.", "cc-by-nc,cc-by-nc-sa"),
        ("Licensed under CC BY-NC-ND 4.0.", "cc-by-nc,cc-by-nc-nd"), ("we have rights to all reserved seats", ""),
        ("Copyright 2020. All rights reserved.", "all-rights-reserved"), ("Mozilla Public License, version 2.0", "mpl-2"),
        ("Licensed under the Apache License, Version 2.0", "apache-2"), ("Redistribution and use in source and binary forms", "bsd"),
        ("Permission is hereby granted, free of charge, to any person", "mit"), ("all rights reserv\u212aed; released under the \u212amit license", ""),
        ("licensed under the gnu general public license version 3 " * 3 + "x " * 30 + "licensed under cc by 4 0", "cc-by,gpl-3"),
    ]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(told)], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.license_report(docs).collect()}
    assert [got[k] for k in range(len(told))] == [labels for _, labels in told]


def test_licenses(spark):
    rows = [
        *texts()[:40],
        (800, "Released under the MIT License. Apache License, Version 2.0; cc-by-nc CC BY NC under the mit license"),
        (801, "This work is licensed under the GNU General Public License, version 3."), (802, "under the mit\nlicense"),
        (802, "under the mit\nlicense"), (803, "x " * 37 + "All rights reserved" + " y" * 50),
    ]
    docs = documents(spark, rows)
    got = licenses.license_report(docs).collect()
    longest = max(len(t.split()) for t, _ in licenses.TEMPLATES)
    want = Counter()
    for i, t in rows:
        w = plain(t)
        base = [(k, label) for p, label in licenses.PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        labels = {x for _, x in base}
        for s in range(0, max(len(w), 1), longest):
            block, run = set(w[s : s + 2 * longest]), f" {' '.join(w[s : s + 2 * longest])} "
            near = [(p, x) for p, x in licenses.TEMPLATES if 100 * len(set(p.split()) & block) >= licenses.PERCENT * len(set(p.split()))]
            labels |= {x for p, x in near if f" {licenses.DECIDING[p]} " in run}
        at = [k for k, _ in base]
        want[i, len(w), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted(labels))] += 1
    keys = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    assert Counter(tuple(r[k] for k in keys) for r in got) == want
    assert all(0 <= r["score"] <= 1 for r in got)
    assert licenses.license_report(docs.limit(0)).count() == 0
    assert docs.schema.simpleString() == spark.createDataFrame([], SCHEMA).schema.simpleString()
