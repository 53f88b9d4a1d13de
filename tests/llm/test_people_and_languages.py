"""Surrogates and language identification."""

from __future__ import annotations

import hashlib
import math
import re
import time
from collections import Counter

import pytest

from admosaic.llm import langid, pii

from .cases import documents, texts

PRIVATE = (
    "Mr. Smith met Mrs. Anna Smith and Frau Анна Петрова; Mr. Smith wrote a.b@mail.example.org, A.B@mail.example.org. "
    "Call +1 (609) 555-7932 or +16095557932, pay 4111 1111 1111 1111 or 4111111111111112 from 192.168.0.77."
)


def test_surrogates(spark):
    many = [(1000 + k, f"write to user.{k}@mail{k % 3}.example.com or +1 (200) 555-{k:04d} at 10.0.{k // 250}.{k % 250}") for k in range(900)]
    rows = [*texts()[:40], (900, PRIVATE), (900, PRIVATE), (901, "\x01\x02\x03 no one here 12.5.2024 v1.2.3"), *many]
    docs = documents(spark, rows)
    done = pii.with_surrogates(docs, key="k")
    assert done.columns == [*docs.columns, "found"] and done.count() == len(rows)
    found = [(r["doc_id"], r["text"], r["found"]) for r in done.collect()]
    text = {i: t for i, t, _ in found}
    untouched = {i: t for i, t in rows if i != 900 and (i or 0) < 1000}
    assert all(text[i] == t for i, t in untouched.items())
    out = text[900]
    for part in ("Smith", "Анна", "a.b@mail", "609", "4111 1111", "4111111111111112", "192.168.0.77"):
        assert part not in out
    names = re.findall(r"(?:Mr\.|Mrs\.|Frau) [^ ;]+(?: \w+)?", out)
    assert names[0].split()[1] == re.findall(r"Mr\. (\w+)", out)[1]
    assert re.search(r"Frau [А-Яа-я]+ [А-Яа-я]+", out) and re.search(r"Mrs\. [A-Za-z]+ [A-Za-z]+", out)
    mails = re.findall(r"[\w.]+@[\w.]+\.org", out)
    assert len(mails) == 2 and mails[0] == mails[1]
    phone = re.search(r"\+(\d) \((\d{3})\) (\d{3})-(\d{4}) or \+(\d{11})", out)
    assert "".join(phone.groups()[:4]) == phone.group(5)
    cards = re.search(r"(\d{4} \d{4} \d{4} \d{4}) or (\d{16})", out).groups()
    assert [luhn(c.replace(" ", "")) for c in cards] == [True, luhn("4111111111111112")]
    new = {re.search(r"to (\S+) or (\+.*) at (\S+)", text[i]).groups() for i, _ in many}
    for part in range(3):
        assert len({x[part] for x in new}) == len(many)
    old = {re.search(r"at (\S+)", t).group(1) for _, t in many}
    assert not old & {x[2] for x in new}
    other = pii.with_surrogates(docs.where("doc_id = 900"), key="other").first()["text"]
    assert other != out
    assert pii.with_surrogates(docs.limit(0), key="k").count() == 0


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


SYLLABLES = {s: w.split() for s, w in pii._SYLLABLES.items()}


def plain_carried(codes, norm):
    """The code at the place of surrogates' codes, or None."""
    if codes.kind == "name":
        last = norm.split(" ")[-1]
        for words in SYLLABLES.values():
            parts = re.findall("|".join(words), last)
            if "".join(parts) == last and len(parts) == codes.width:
                return sum(words.index(p) * 16 ** (codes.width - 1 - k) for k, p in enumerate(parts))
        return None
    if codes.kind == "ip":
        octets = [int(x) for x in norm.split(".")]
        return octets[1] * 65536 + octets[2] * 256 + octets[3] if octets[0] == 10 else None
    signs = norm
    if codes.kind == "email":
        signs = re.sub("[^a-z0-9]", "", norm[: norm.rindex(".") + 1])
        signs = signs.translate(str.maketrans("bdfghklmnp", "0123456789"))
    if codes.kind == "card":
        signs = norm[:-1]
    end = signs[-codes.width :]
    return int(end) if re.fullmatch("[0-9]+", end) and len(end) == codes.width else None


def plain_surrogates(entities, key):
    """Codes of all entities by sorting and counting, in plain Python."""
    out = {}
    for kind in {k for k, _ in entities}:
        norms = sorted({n for k, n in entities if k == kind}, key=lambda n: (hashlib.sha256(f"{key}\x1f{kind}\x1f{n}".encode()).hexdigest(), n))
        codes = pii.Codes(kind, len(norms), key)
        taken = {plain_carried(codes, n) for n in norms}
        drawn = ((i * codes.factor + codes.shift) % codes.count for i in range(2 * len(norms)))
        free = [c for c in drawn if c not in taken]
        out |= {(kind, n): (codes, c) for n, c in zip(norms, free)}
    return out


def shape(text):
    return re.sub("[a-z]", "a", re.sub("[0-9]", "0", text))


def test_surrogates_against_plain_python(spark):
    entities = [("email", f"user{k}.x@mail{k % 7}.example.org") for k in range(300)]
    entities += [("email", f"{a}@{b}.co") for a in "abcdefghiklmnopr" for b in "abcdefghiklmnopr"]
    entities += [("phone", f"1609555{k:04d}") for k in range(200)] + [("phone", str(k)) for k in range(10, 60)]
    entities += [("card", f"4111111111{k:06d}") for k in range(200)] + [("card", f"37828224{k:07d}") for k in range(50)]
    entities += [("ip", f"10.0.{k}.{k}") for k in range(200)] + [("ip", "192.168.0.7")]
    entities += [("name", f"mr. {a}{b}") for a in SYLLABLES["latin"] for b in SYLLABLES["latin"]]
    entities += [("name", "frau анна петрова"), ("name", "mr. νίκος παπάς"), ("name", "mrs. anna o'neil-smith")]
    rows = spark.createDataFrame(entities + entities[:50], "kind string, norm string")
    forms = {(r["kind"], r["norm"]): r["form"] for r in pii.draw_surrogates(rows, "k").collect()}
    want = plain_surrogates(entities, "k")
    assert forms.keys() == want.keys() == set(entities)
    assert len({(k, f) for (k, _), f in forms.items()}) == len(entities)
    assert not set(entities) & {(k, f) for (k, _), f in forms.items()}
    for (kind, norm), (codes, code) in want.items():
        form = forms[kind, norm]
        assert plain_carried(codes, form) == code, (kind, norm, form)
        if kind == "email":
            assert shape(form).endswith(shape(norm)[-6:]) and (len(norm) < 8 or shape(form) == shape(norm))
        elif kind == "phone":
            assert form[0] == norm[0] and len(form) == max(len(norm), codes.width + 1)
        elif kind == "card":
            assert form[0] == norm[0] and len(form) == len(norm) and luhn(form) == luhn(norm)
        elif kind == "ip":
            assert form.startswith("10.") and len(form.split(".")) == 4
        else:
            assert form.split(" ")[0] == norm.split(" ")[0] and len(form.split(" ")) == len(norm.split(" "))
            assert bool(re.search("[а-я]", form)) == bool(re.search("[а-я]", norm))
            assert bool(re.search("[α-ω]", form)) == bool(re.search("[α-ω]", norm))
    assert pii.draw_surrogates(rows.limit(0), "k").count() == 0


def test_full_spaces_end():
    for kind, many in (("email", 10**9), ("phone", 4 * 10**9), ("card", 10**10), ("name", 10**9), ("ip", 2**23), ("ip", 2**31)):
        codes = pii.Codes(kind, many, "k")
        assert codes.count >= 2 * many
        start = [(i * codes.factor + codes.shift) % codes.count for i in range(1000)]
        assert len(set(start)) == 1000
    with pytest.raises(ValueError):
        pii.Codes("ip", 2**31 + 1, "k")


def test_whole_names_and_plain_numbers_go(spark):
    text = "Mr. McDonald, Mrs. O'Neil-Smith and Mr. Νίκος Παπάς: 555-123-4567, 3782 822463 10005, 12-555-123-4567 1999-555-123-45678"
    out = pii.with_surrogates(spark.createDataFrame([(1, text)], "doc_id long, text string"), key="k").first()
    for part in ("Donald", "Neil", "Smith", "Νίκος", "Παπάς", " 555-123-4567,", "822463"):
        assert part not in out["text"]
    assert re.search("Mr\\. [Α-ώ]+ [Α-ώ]+:", out["text"]) and out["text"].endswith("12-555-123-4567 1999-555-123-45678")
    assert out["found"] == ["name", "name", "name", "phone", "card"]


def test_languages(spark):
    sample = {"en": "the house of the old man is on the hill ", "de": "das haus des alten mannes steht auf dem hügel ", "fr": "la maison du vieil homme est sur la colline "}
    rows = [(k, text * 3, lang) for k, (lang, text) in enumerate(list(sample.items()) * 4)] + [(99, None, None), (98, "", "en")]
    labelled = spark.createDataFrame(rows, "id long, text string, lang string")
    languages, table = langid.train(labelled, "text", "lang")
    assert languages == ["de", "en", "fr"]
    pages = spark.createDataFrame(
        [
            (1, "https://a.example.de/x", "<html lang='de'><script>var the = 'the of'</script><p>haus des mannes</p>", "q"),
            (2, "https://a.example.de/y", "<html><p>das haus</p>", "q"), (3, "https://b.example.fr", "<html></html>", "q"),
            (4, None, None, "q"), (5, "http://user@a.example.de:80/z", "<html lang=en><b>the house of the old man is on the hill", "q"),
            (5, "http://user@a.example.de:80/z", "<html lang=en><b>the house of the old man is on the hill", "q"), (6, "no address", "", "q"),
        ],
        "page_id int, url string, html string, label string",
    )
    got = langid.identify(langid.page_records(pages), languages, table).collect()
    lang = {r["id"]: r["lang"] for r in got}
    assert len(got) == 7 and [lang[k] for k in (1, 2, 3, 5)] == ["de", "de", "fr", "en"]
    assert all(0 < r["probability"] <= 1 for r in got)
    assert {r["id"]: r["host"] for r in got}[5] == "a.example.de"
    assert langid.identify(langid.page_records(pages.limit(0)), languages, table).count() == 0
    assert langid.train(labelled.limit(0), "text", "lang")[0] == []
    assert langid.identify(langid.page_records(pages), *langid.train(labelled.limit(0), "text", "lang")).where("lang IS NULL").count() == 7


def plain_grams(text):
    data = b" " + bytes(b | 32 if 65 <= b <= 90 else b for b in text.encode()) + b" "
    return [(int.from_bytes(data[k : k + 3], "big") * 2654435761 % (1 << 32)) >> 16 for k in range(len(data) - 2)]


def test_fused_scores_against_plain_python(spark):
    learnt = [("the old house on the hill was for them", "en"), ("das alte Haus auf dem Berg war ihres", "de"), ("la vieja casa de la colina era suya", "es")]
    learnt = [*learnt, learnt[0], (None, "de"), ("no language", None)]
    languages, table = langid.train(spark.createDataFrame(learnt, "text string, lang string"), "text", "lang")
    assert languages == ["de", "en", "es"]
    records = [
        (1, "the hill and the house", None, "en", "a.example.uk"), (2, "the hill and the house", None, "en", "a.example.uk"),
        (3, "das Haus", "de", "de", "a.example.uk"), (4, None, None, None, "a.example.uk"), (5, "", "fil", "fil", "b.example.de"),
        (6, "casa de la colina " * 9_000, None, None, "b.example.de"), (7, "casa", None, "es", "forum"), (7, "casa", None, "es", "forum"),
        (8, "haus", None, None, None), (9, "x", None, "de", "de"), (10, "ä世", "es", "es", "c.example.mx"),
    ]
    grams = {x: Counter() for x in languages}
    for text, lang in learnt:
        if lang:
            grams[lang].update(plain_grams(text or ""))
    weight = {x: sum(grams[x].values()) + langid.BUCKETS for x in languages}
    labels = Counter(r[3] for r in records if r[3])

    def suffix(host):
        return host.rsplit(".", 1)[1] if host and "." in host else None

    def plain(record):
        _, text, declared, label, host = record
        out = []
        for x in languages:
            n = Counter(plain_grams(text)) if text else {}
            value = langid.TEMPER * sum(k * math.log((grams[x][g] + 1) / weight[x]) for g, k in n.items())
            held = Counter(r[3] for r in records if host and r[4] == host and r[3] in languages)
            near = Counter(r[3] for r in records if suffix(host) and suffix(r[4]) == suffix(host) and r[3] in languages)
            for of, key in ((held, host), (near, suffix(host))):
                # A record's own label is left out wherever it counts; without a host there is nothing to leave it out of.
                if label in languages and key:
                    of[label] -= 1
            everywhere = (labels[x] + 1) / (sum(labels.values()) + len(languages))
            prior = (near[x] + langid.GLOBAL_WEIGHT * everywhere) / (sum(near.values()) + langid.GLOBAL_WEIGHT)
            prior = (held[x] + langid.SUFFIX_WEIGHT * prior) / (sum(held.values()) + langid.SUFFIX_WEIGHT)
            value += math.log(prior)
            national = next((lang for lang, of in langid.LANGUAGE_SUFFIXES.items() if suffix(host) in of), None)
            for stated, right in ((declared, langid.DECLARED_RIGHT), (national, langid.SUFFIX_RIGHT)):
                if stated in languages:
                    value += math.log(right if stated == x else (1 - right) / 2)
            out.append(value)
        best = max(out)
        return languages[out.index(best)], 1 / sum(math.exp(v - best) for v in out)

    frame = spark.createDataFrame(records, "id long, text string, declared string, label string, host string")
    got = sorted((r["id"], r["lang"], r["probability"]) for r in langid.identify(frame, languages, table).collect())
    want = sorted((r[0], *plain(r)) for r in records)
    assert [(i, x) for i, x, _ in got] == [(i, x) for i, x, _ in want]
    assert [p for *_, p in got] == pytest.approx([p for *_, p in want], rel=1e-4)


def test_broken_pages_are_read_once_through(spark):
    pages = [
        (1, "https://a.example.org/x", "<html lang='fil'><script>one</script>two<style>three</style>four"),
        (2, None, "<html lang=deu><p>x</p><script>" * 1 + "<script>" * 60_000),
        (3, "https://a.example.org", "<" * 60_000), (4, "broken", None), (5, None, "<HTML xml:lang=\"pt-BR\">a < b <!-- c " + "<!--" * 60_000),
    ]
    frame = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, host string")
    began = time.time()
    got = {r["id"]: r for r in langid.page_records(frame).collect()}
    assert time.time() - began < 30
    assert [got[k]["declared"] for k in range(1, 6)] == ["fil", "de", None, None, "pt"]
    assert got[1]["text"].split() == ["two", "four"] and got[2]["text"].split() == ["x"] and got[5]["text"].split() == ["a", "<", "b"]
    assert got[3]["text"] == "<" * 60_000 and got[4]["text"] == "" and got[4]["host"] is None
