"""Small tables that hold the hard cases: nulls, empty and long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import random
import re

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, k1 string, term string, spans string, id string"


def spaced(text):
    return SPACED.findall((text or "").translate(UPPER))


def plain(text):
    return PLAIN.findall((text or "").translate(UPPER))


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary):x}" for _ in range(n)]


def texts(seed=3):
    """Ids and texts: odd ones, then families of near copies of differing closeness."""
    rng = random.Random(seed)
    out = [
        (None, "a row without an id " * 20), (1, None), (2, ""), (3, " \t\n\r "), (4, "one"), (5, "one two"), (5, "one two"),
        (6, "É É é K ß ſİ İ\x01\x02\x03   \x85 \xa0 𝔘 😀"), (7, " ".join(words(rng, 20_000))), (8, "ab " * 300),
        (9, "line one\nline one\n\n  \nline one\n"), (10, "x" * 5_000),
    ]
    number = 11
    for _ in range(25):
        base = words(rng, rng.choice((9, 12, 30, 80, 150)))
        out.append((number, " ".join(base)))
        number += 1
        for _ in range(rng.choice((0, 1, 3, 12))):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 12))):
                copy[rng.randrange(len(copy))] = rng.choice(words(rng, 3))
            out.append((number, " ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy)))
            number += 1
    return out


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 4}", len(t or ""), 7, "k", "t", "s", "i") for i, t in rows], SCHEMA)
