"""Byte-level BPE and token files against the libraries; the class model against plain counts."""

from __future__ import annotations

import base64
import hashlib
import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from admosaic.llm import bpe, brown, token_files

from .cases import documents, spaced, texts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
ROWS = [*texts()[:40], (300, "naïve 😀😀 ===== !!!!\t\n  \r\n x'll 's 漢字 ٣٤ <|endoftext|> é " * 3)]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_round_trip(spark, library):
    docs = documents(spark, ROWS)
    got = bpe.token_digests(docs, RANKS).collect()
    want = Counter()
    for i, t in ROWS:
        ids = library.encode_ordinary(t or "")
        packed, text = np.array(ids, "<u4").tobytes(), (t or "").encode()
        want[i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    encoded = bpe.encode(docs, RANKS)
    back = Counter((r["doc_id"], r["text"]) for r in bpe.decode(encoded, RANKS).collect())
    assert back == Counter((i, t or "") for i, t in ROWS)
    for r in encoded.where("doc_id = 300").collect():
        text = dict(ROWS)[300]
        assert r["starts"] == sorted(r["starts"]) and max(r["starts"]) < len(text) and r["n_split"] > 0
    assert bpe.encode(docs.limit(0), RANKS).count() == 0


def test_split_characters(spark):
    half = bpe.encode(documents(spark, [(1, "😀")]), RANKS).select("doc_id", F.slice("ids", 1, 1).alias("ids"))
    assert "�" in bpe.decode(half, RANKS).first()["text"]


def test_blocks():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 4096, 4097, 9001):
        for high in (1, 2, 300, 50_257, 2**32):
            ids = rng.integers(0, high, n).astype(np.uint32)
            ids[:: max(1, n // 5)] = high - 1
            starts, payload = token_files.pack(ids)
            assert (token_files.unpack(starts, payload) == ids).all()
            last = token_files.unpack_block(payload[starts[-1] :])
            assert (last == ids[token_files.BLOCK * (len(starts) - 1) :]).all()


def test_token_files(spark):
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    rows = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    files = token_files.write_token_files(documents(spark, ROWS), JSON)
    want, before = Counter(), 0
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want[i, before, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        before += len(ids)
    got = token_files.read_token_files(files, digests=True).collect()
    assert Counter((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    whole = {r["doc_id"]: r["ids"] for r in token_files.read_token_files(files).collect()}
    assert whole[2] == [0] and library.decode(whole[300][:-1], skip_special_tokens=False) == dict(ROWS)[300]
    assert token_files.write_token_files(documents(spark, []), JSON).count() == 0


def test_token_files_match_added_tokens_as_the_library_does(spark, tmp_path):
    from admosaic.llm import queries

    rows = [*ROWS, (400, "see <|endoftext|> here"), (401, "<|endoftext|><|endoftext|>"), (402, "see <|endoftext| > here")]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    library = Tokenizer.from_file(JSON)
    assert library.encode("see <|endoftext|> here", add_special_tokens=False).ids == [3826, 220, 50256, 994]
    want, before = Counter(), 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want[i, before, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        before += len(ids)
    got = queries.op8_token_files(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == want


def test_class_model(spark):
    rows = texts()
    docs = documents(spark, rows)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    got = brown.perplexities(docs, held).collect()

    def out(i):
        return i is not None and zlib.crc32(str(i).encode()) % 7 == 2

    counts = Counter(w for i, t in rows if not out(i) for w in [*spaced(t), None])
    total, distinct = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in rows:
        tokens = [*spaced(t), None]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        want[i, out(i), len(tokens), sum(counts[w] > 0 for w in tokens), total, round(base, 4)] += 1
    keys = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    assert Counter((*(r[k] for k in keys), round(r["base_score"], 4)) for r in got) == want
    assert all(r["score"] < 0 and r["perplexity"] > 1 for r in got)
    assert brown.perplexities(docs.limit(0), held).count() == 0
    nothing = brown.perplexities(docs, F.lit(True)).collect()
    assert len(nothing) == len(rows) and all(r["n_known"] == 0 for r in nothing)


def trained(spark, docs):
    """The model of texts, and the class of each exchanged word by its hash."""
    counts = brown.word_counts(docs).cache()
    rows = docs.select(F.col("doc_id").alias("id"), "text", F.lit(False).alias("held_out"))
    model = brown.train(brown.numbered(rows, counts), counts)
    of = {r["item"]: r["class"] for r in model.now.collect()}
    slices = list(brown.word_slices(counts))
    named = {int(w): of[part.first + k] for part in slices for k, w in enumerate(part.words)}
    assert len(named) == len(of) == model.n_words
    return model, named


def hash_of(word):
    return int(next(brown.token_runs([word.encode()]))[0].view(np.int64)[0])


def test_exchange_finds_classes(spark):
    rng = np.random.default_rng(2)
    nouns, verbs = [f"n{k}" for k in range(30)], [f"v{k}" for k in range(30)]
    rows = [(k, " ".join(str(rng.choice(nouns if j % 2 else verbs)) for j in range(80))) for k in range(120)]
    docs = documents(spark, rows)
    _, by_hash = trained(spark, docs)
    of_nouns, of_verbs = ({by_hash[hash_of(w)] for w in part} for part in (nouns, verbs))
    assert not of_nouns & of_verbs
    scored = [r for r in brown.perplexities(docs, F.col("doc_id") % 7 == 2).collect() if r["held_out"]]
    assert sum(r["score"] for r in scored) > sum(r["base_score"] for r in scored)


def test_every_frequent_word_is_exchanged_and_scored_by_its_class(spark, monkeypatch):
    rng = np.random.default_rng(4)
    kinds = [[f"{c}{k:04d}" for k in range(1300)] for c in "nv"]
    rows = [(k, " ".join(kinds[j % 2][rng.integers(1300)] for j in range(400))) for k in range(180)]
    rows += [(900, "seen twice"), (901, "seen twice n0001"), (902, "never v0007 n0003 n0004 never"), (903, None)]
    docs = documents(spark, rows)
    counts = Counter(w for _, t in rows[:-2] for w in spaced(t))
    frequent = {w for w, n in counts.items() if n >= brown.EXCHANGE_COUNT}
    assert len(frequent) > 2_100
    held = F.col("doc_id") >= 902
    whole, class_of = trained(spark, docs.where(~held))
    assert set(class_of) == {hash_of(w) for w in frequent}
    steps = whole.steps
    hashes = {w: hash_of(w) for w in counts}

    def classes(text):
        out = [brown.CLASSES + brown.FORMS]
        for w in spaced(text):
            form = int(next(brown.token_runs([w.encode()]))[1][0]) + brown.CLASSES
            out.append(class_of.get(hashes.get(w), form))
        return [*out, brown.CLASSES + brown.FORMS]

    def plain_score(text):
        found = classes(text)
        total = sum(math.log10(n + 1) for n in [*(counts[w] for w in spaced(text)), len(rows) - 2])
        return total + sum(steps[a, b] for a, b in zip(found, found[1:], strict=False))

    # Transitions are of the final classes, counted here text by text.
    pairs = Counter(p for _, t in rows[:-2] for p in zip(classes(t), classes(t)[1:], strict=False))
    joint = np.array([[pairs[a, b] for b in range(brown.EVERY)] for a in range(brown.EVERY)], float)
    frequency = (joint.sum(axis=0) / joint.sum() + 1e-9) / (joint.sum(axis=0) / joint.sum() + 1e-9).sum()
    smooth = (joint + brown.TRANSITION_WEIGHT * frequency) / (joint.sum(axis=1, keepdims=True) + brown.TRANSITION_WEIGHT)
    assert np.allclose(whole.transitions, np.log10(smooth))

    want = {i: plain_score(t) for i, t in rows}
    monkeypatch.setattr(brown, "train", lambda *_: whole)
    # Numbers and classes looked up at once, or slice by slice with the words of a text in several slices.
    for most in (brown.SLICE_WORDS, 700):
        monkeypatch.setattr(brown, "SLICE_WORDS", most)
        assert {r["doc_id"]: r["score"] for r in brown.perplexities(docs, held).collect()} == pytest.approx(want)


def test_classes_do_not_depend_on_slices(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(k, " ".join(f"{'nv'[j % 2]}{rng.integers(40)}" for j in range(80))) for k in range(90)]
    docs = documents(spark, rows)
    held = F.col("doc_id") % 7 == 2
    found, scores = [], []
    for most in (brown.SLICE_WORDS, 30):
        monkeypatch.setattr(brown, "SLICE_WORDS", most)
        found.append(trained(spark, docs)[1])
        scored = brown.perplexities(docs, held).collect()
        assert sum(r["score"] for r in scored) > sum(r["base_score"] for r in scored)
        scores.append({r["doc_id"]: (r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in scored})
    assert found[0] == found[1] and len(found[0]) == 80
    assert scores[0] == scores[1]


def test_tasks_hold_little_of_the_texts(spark):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.3, 300) % 50_000) for _ in range(4_000)]
    batch = pa.RecordBatch.from_arrays([pa.array([*texts, None, ""])], ["text"])
    want = Counter(w for t in texts for w in t.split())
    tracemalloc.start()
    try:
        got = Counter()
        for part in brown._word_counts(iter([batch])):
            for word, n in zip(part.column("word").to_pylist(), part.column("n").to_pylist(), strict=True):
                got[word] += n
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got == {hash_of(w): n for w, n in want.items()} | {brown.END_WORD: len(texts) + 2}
    assert peak < 60e6  # 111e6 when all texts of a batch were counted at once, 21e6 since
    before = spark.conf.get(brown.BATCH_ROWS)
    with pytest.raises(ZeroDivisionError), brown.small_batches(spark):
        sizes = spark.range(5_000, numPartitions=1).mapInArrow(lambda batches: (b for b in batches if b.num_rows > brown.ROWS), "id long")
        assert sizes.count() == 0
        raise ZeroDivisionError
    assert spark.conf.get(brown.BATCH_ROWS) == before


def test_words_counted_early_are_counted_whole(monkeypatch):
    texts = [" ".join(f"w{(k * j) % 700}" for j in range(300)) for k in range(60)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[at : at + 20])], ["text"]) for at in range(0, 60, 20)]
    want = Counter({hash_of(w): n for w, n in Counter(w for t in texts for w in t.split()).items()}) + Counter({brown.END_WORD: 60})
    for most in (brown.HELD_WORDS, 100):
        monkeypatch.setattr(brown, "HELD_WORDS", most)
        got, forms = Counter(), {}
        for part in brown._word_counts(iter(batches)):
            for r in part.to_pylist():
                got[r["word"]] += r["n"]
                assert forms.setdefault(r["word"], r["form"]) == r["form"]
        assert got == want
        assert forms[hash_of("w7")] == int(next(brown.token_runs([b"w7"]))[1][0]) and forms[brown.END_WORD] == -1


def test_a_task_hands_over_one_row_a_word():
    rng = np.random.default_rng(7)
    codes = np.append(rng.integers(-3, 40, 5_000), brown.END_CODE)
    classes = np.where(codes < 0, brown.CLASSES - 1 - codes, codes % 5).astype(np.int8)
    cuts = np.array([0, len(codes)])
    batch = pa.RecordBatch.from_arrays([brown._lists(cuts, codes.astype(np.int32)), brown._lists(cuts, classes)], ["codes", "classes"])
    want = {(r["item"], r["home"], r["cell"]): r["n"] for part in brown._neighbours(1)(iter([batch])) for r in part.to_pylist()}
    rows = [r for part in brown._by_word(brown._neighbours(1)(iter([batch]))) for r in part.to_pylist()]
    assert [r["item"] for r in rows] == sorted({item for item, _, _ in want})
    assert len(want) > 5 * len(rows)
    assert {(r["item"], r["home"], c): n for r in rows for c, n in zip(r["cells"], r["n"], strict=True)} == want
    # A word met by two tasks moves as one whose numbers were added up before.
    joint = np.random.default_rng(9).integers(0, 500, (brown.EVERY, brown.EVERY)).astype(float)
    kind = pa.list_(pa.struct([("cells", pa.list_(pa.int16())), ("n", pa.list_(pa.int64()))]))

    def moves(arounds):
        arrays = [pa.array([r[k] for r in rows]) for k in ("item", "home")]
        given = pa.RecordBatch.from_arrays([*arrays, pa.array(arounds, kind)], ["item", "home", "around"])
        return [r for part in brown._exchange(joint)(iter([given])) for r in part.to_pylist()]

    twice = moves([[{"cells": r["cells"], "n": r["n"]}] * 2 for r in rows])
    assert twice == moves([[{"cells": r["cells"], "n": [2 * n for n in r["n"]]}] for r in rows])
    assert twice[-1]["item"] is None and any(r["moved"] != w["home"] for r, w in zip(twice, rows, strict=False))


def test_neighbours_are_counted_whole_when_handed_over_early(monkeypatch):
    rng = np.random.default_rng(6)
    codes = np.append(rng.integers(-3, 40, 500), brown.END_CODE)
    classes = np.where(codes < 0, brown.CLASSES - 1 - codes, codes % 5).astype(np.int8)
    cuts = np.array([0, len(codes)])
    batch = pa.RecordBatch.from_arrays([brown._lists(cuts, codes.astype(np.int32)), brown._lists(cuts, classes)], ["codes", "classes"])
    want = Counter()
    chain = [brown.END_CODE, *codes.tolist()]
    kinds = [brown.END_CLASS, *classes.tolist()]
    for a, b, x, y in zip(chain, chain[1:], kinds, kinds[1:], strict=False):
        if a >= 0 and a % brown.TURNS == 1:
            want[a, x, y] += 1
        if b >= 0 and b % brown.TURNS == 1:
            want[b, y, brown.EVERY + x] += 1
    for most in (brown.HELD_CELLS, 20):
        monkeypatch.setattr(brown, "HELD_CELLS", most)
        monkeypatch.setattr(brown, "PIECE", 64)
        got = Counter()
        for part in brown._neighbours(1)(iter([batch, batch])):
            for r in part.to_pylist():
                got[r["item"], r["home"], r["cell"]] += r["n"]
        assert got == Counter({k: 2 * n for k, n in want.items()})
