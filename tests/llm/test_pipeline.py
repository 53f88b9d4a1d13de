"""The pipeline against the same stages in plain Python."""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from admosaic.llm import quality

from .cases import SCHEMA, documents, plain, texts
from .test_filters import ITEMS, brute_contamination
from .test_near_copies import brute

STOPS = quality.STOP_WORDS


def passes(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    win = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    n = Counter(win)
    repeated = len({k + d for k, x in enumerate(win) if n[x] > 1 for d in range(3)})
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    if len(w) < 50 or 2 * repeated > len(w):
        return False
    per_word = lambda x: 100 * x / len(w)
    per_line = lambda x: 100 * x / len(lines)
    return (
        200 <= per_word(sum(map(len, w))) <= 1500
        and per_word(len(re.findall(r"[#*$%&|<>]", text))) <= 30
        and per_word(sum(x.lower() in STOPS for x in w)) >= 3
        and per_line(len(lines) - len(set(lines))) <= 50
        and per_line(sum(bool(re.search(r"(\.\.\.|…)[\x20\x09-\x0D]*$", x)) for x in lines)) <= 50
        and per_line(sum(bool(re.match(r"[\x20\x09-\x0D]*[-*•]", x)) for x in lines)) <= 90
    )


SECRET = (
    (re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 6),
    (re.compile(r"(AKIA[A-Z0-9]+)"), 20), (re.compile(r"([0-9a-f]+)"), 24),
)


def without_secrets(rows):
    owners, found = defaultdict(set), []
    for i, t, source in rows:
        spans = sorted({(m.start(), m.end(), m.group(1)) for p, least in SECRET for m in p.finditer(t) if len(m.group(1)) >= least})
        found.append((i, t, spans))
        for _, _, value in spans:
            owners[value].add(source)
    for i, t, spans in found:
        at, out = 0, ""
        for a, b, value in spans:
            if len(owners[value]) < 3:
                if a >= at:
                    out += t[at:a] + "[SECRET]"
                at = max(at, b)
        yield i, out + t[at:]


def corpus():
    rng = random.Random(4)
    stops = ["the", "of", "and", "is"]
    out = [(i, t) for i, t in texts() if i is not None and i != 5]
    number = 2_000
    shared = "0123456789abcdef" * 2
    for k in range(40):
        w = [rng.choice(stops) if rng.random() < 0.3 else f"word{rng.randrange(3000)}" for _ in range(rng.randrange(60, 200))]
        if k % 6 == 0:
            w[20:20] = ITEMS[0][1].split()
        if k % 5 == 0:
            w.insert(10, f"token={shared}")
        if k % 7 == 0:
            w.insert(30, f"password: live{k}key")
        for c in range(1 + 3 * (k % 4 == 0)):
            copy = [f"n{rng.randrange(99)}" if c and rng.random() < 0.01 else x for x in w]
            out.append((number, " ".join(copy)))
            number += 1
    rng.shuffle(out)
    return out


def test_run_and_stages(spark, tmp_path):
    rows = corpus()
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    left = [(i, t) for i, t in rows if passes(t)]
    _, roots = brute(left, 5, 80)
    least = {}
    for (i, _), r in zip(left, roots, strict=True):
        least[r] = min(i, least.get(r, i))
    left = [(i, t) for (i, t), r in zip(left, roots, strict=True) if least[r] == i]
    hit = {k[0] for k in brute_contamination(left, ITEMS) if k[2]}
    left = [(i, t, f"src{i % 4}") for i, t in left if i not in hit]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for i, t in without_secrets(left):
        ids = library.encode_ordinary(t)
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == want
    assert len(got) == len(want) > 20 and plain(ITEMS[0][1])


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    spark.createDataFrame(ITEMS, "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([], SCHEMA)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "secret_scans", "byte_level_bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.schema == docs.schema and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0


def test_stages_take_every_row(spark, tmp_path):
    spark.createDataFrame(ITEMS, "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark, texts())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() <= len(texts())
