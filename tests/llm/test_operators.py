"""Each operator against a brute-force version on small texts that hold nulls,
empty texts, repeated rows, ties and columns with clashing names; and on an
empty table."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from tracelake.llm import decontam, licenses, linededup, neardup, packing, quality, repeats, secrets, sharding, toxicity

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "re", "so") for b in ("ten", "bar", "dol", "fin", "gum", "hat", "jet")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, spans int, pos string, items int, grams int"


def _texts():
    rnd = random.Random(7)

    def prose(n):
        return " ".join(rnd.choice(WORDS) for _ in range(n))

    base = prose(80)
    passage = prose(60)
    texts = [None, "", "   \n\n", "One", base, base, base.replace("ka", "Ka", 1)]
    for i in range(6):
        w = base.split()
        w[10 * i] = "zzz"
        texts.append(" ".join(w))
    texts += [prose(30) + "\n" + passage + "\n" + prose(20) for _ in range(5)]
    texts += [f"{prose(12)}\nsame line here\nsame line here\n{prose(9)}" for _ in range(3)]
    texts += ["the " * 200, "É À\tñ x " * 12, prose(3000)]
    line = prose(12).split()
    texts += ["\n".join([" ".join(line), " ".join(line[:5] + line[6:]), " ".join(line[:7] + ["new"] + line[8:]), " ".join(line[::-1])])]
    return texts


TEXTS = _texts()
ROWS = [(i, t, None, "s", 0, "k", 1, "p", 2, 3) for i, t in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_near_duplicates(docs, empty):
    sets = {}
    for i, t in enumerate(TEXTS):
        w = (t or "").encode().lower().split()
        sets[i] = ({tuple(w)} if 0 < len(w) < 5 else {tuple(w[j : j + 5]) for j in range(len(w) - 4)}) if w else set()
    group = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    # the second and third reach the drawn star rounds and the large buckets
    for way in ({}, {"rounds": 3, "cross": 0}, {"rounds": 0, "large": 1}):
        got = _by_id(neardup.near_duplicates(docs, **way))
        assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {
            i: (len(s), group[i], group[i] == i) for i, s in sets.items()
        }
    assert neardup.near_duplicates(empty).count() == 0


def test_odd_sketch_estimates_similarity():
    hasher = neardup.Hasher()
    a = neardup.shingles(" ".join(f"w{i}" for i in range(1000)).encode())
    b = neardup.shingles(" ".join(f"w{i}" for i in range(140, 1140)).encode())
    x, y = (hasher.sketch(hasher.samples(s)) for s in (a, b))
    differ = sum(bin((int(p) ^ int(q)) & (1 << 64) - 1).count("1") for p, q in zip(x, y, strict=True))
    assert 130 < differ < neardup.MAX_XOR  # similarity 0.755


def test_repeats(docs, empty):
    data = [(t or "").encode() for t in TEXTS]
    count = Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    want = {}
    for n, b in enumerate(data):
        gone = [False] * len(b)
        for i in range(len(b) - 199):
            if count[b[i : i + 200]] > 1:
                gone[i : i + 200] = [True] * 200
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        want[n] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    for hot in (repeats.HOT, 1):
        got = _by_id(repeats.digest(*repeats.remove_repeats(docs, hot=hot)))
        assert {i: tuple(r)[1:] for i, r in got.items()} == want
    assert repeats.digest(*repeats.remove_repeats(empty)).count() == 0


def test_deep_shallow_sorts():
    rnd = random.Random(3)
    strings = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(60))) for _ in range(300)]
    strings += [b"x" * 40 + bytes([c]) for c in (3, 1, 2, 1)] + [b"x" * 40, b""]
    for shallow in (0, 8, 24):
        assert [strings[i] for i in repeats.deep_shallow(strings, shallow)] == sorted(strings)


def test_line_dedup(docs, empty):
    first, seen = {}, []
    for d, t in enumerate(TEXTS):
        for i, line in enumerate((t or "").split("\n")):
            w = tuple(x for x in re.split(r"[ \t\x0b\f\r]+", line.lower()) if x)
            if w:
                seen.append((d, i, w))
                first.setdefault(w, (d, i))

    def alike(a, b):
        if min(len(a), len(b)) < 8 or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
        short, long = sorted((a, b), key=len)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    gone = {w for w, p in first.items() if any(q < p and alike(w, v) for v, q in first.items())}
    want = {}
    for d, i, w in seen:
        want.setdefault(d, []).extend([i] if (d, i) != first[w] or w in gone else [])
    got = _by_id(linededup.dropped_lines(docs))
    assert {i: r["dropped"] for i, r in got.items()} == want
    kept = {r["doc_id"]: r for r in linededup.drop_lines(docs).collect()}
    n_lines = Counter(d for d, _, _ in seen)
    assert set(kept) == {d for d in range(len(TEXTS)) if d not in want or len(want[d]) < n_lines[d]}
    assert kept[0]["text"] is None and kept[4]["key"] == "k"
    assert linededup.dropped_lines(empty).count() == 0


def test_decontamination(spark, docs, empty):
    items = [(1, TEXTS[4]), (2, "ONE"), (3, None), (None, "the the the"), (5, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    windows = {}
    for item, t in items:
        w = words(t)
        for i in range(max(0, len(w) - min(10, len(w)) + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + min(10, len(w))]), set()).add(item)
    want = {}
    for d, t in enumerate(TEXTS):
        w, hit, found = words(t), set(), set()
        for win, ids in windows.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    found |= ids - {None}
        names = ",".join(sorted(map(str, found)))
        want[d] = (len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit))
    for block in (decontam.BLOCK_BYTES, 64):  # one block, several
        got = _by_id(decontam.digest(decontam.scan(docs, bench, block_bytes=block)))
        assert {i: tuple(r)[1:] for i, r in got.items()} == want
    clean = decontam.decontaminate(docs, bench)
    assert {r["doc_id"] for r in clean.collect()} == {d for d, x in want.items() if not x[4]} and clean.columns == docs.columns
    cut = _by_id(decontam.decontaminate(docs, bench, drop=False))
    assert cut[3]["text"] == "" and cut[4]["text"] == ""
    assert decontam.scan(empty, bench).count() == 0 and decontam.decontaminate(docs, bench.limit(0)).count() == len(TEXTS)


def test_packing(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    size = 256
    rows = packing.pack(packing.pieces(docs, size=size, keep_ids=True), size=size).collect()
    parts, places = {}, {}
    for r in rows:
        parts.setdefault(r["doc_id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        data = b"".join(i.to_bytes(4, "little") for i in r["ids"])
        assert r["length"] == len(r["ids"]) and zlib.crc32(data) == r["ids_crc32"]
    for d, t in enumerate(TEXTS):
        own = sorted(parts[d], key=lambda r: r["start"])
        ids = [i for r in own for i in r["ids"]]
        assert ids == whole.encode(t or "", add_special_tokens=False).ids + [2]
        assert [r["start"] for r in own] == list(range(0, len(ids), size)) and {r["doc_tokens"] for r in own} == {len(ids)}
    assert sorted(places) == list(range(len(places)))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= size
    assert packing.pack(packing.pieces(empty)).count() == 0


def test_sharding(docs, empty):
    rows = sharding.shard(docs, shards=4).collect()
    texts = [(t or "").encode() for t in TEXTS]
    assert all(r["size"] == len(texts[r["doc_id"]]) + 8 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) for r in rows)
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(rows) == len(TEXTS) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.digest(sharding.shard(empty)).count() == 0


def test_shards_are_even_with_a_hot_text(spark):
    text = "F".join(["copy"] * 50)
    rows = [(i, text if i % 3 == 0 else f"{i} " * (20 + i % 50)) for i in range(6000)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=6).groupBy("shard").sum("size").collect()
    loads = [r[1] for r in got]
    assert len(loads) == 6 and max(loads) < 1.02 * sum(loads) / 6


def _jwt():
    import base64
    import json

    parts = [json.dumps(x).encode() for x in ({"alg": "HS256", "typ": "JWT"}, {"sub": "1"})] + [b"0123456789"]
    return ".".join(base64.urlsafe_b64encode(p).decode().rstrip("=") for p in parts)


def _der_key():
    number = b"\x02\x09" + bytes(range(1, 10))
    body = b"\x02\x01\x00" + 8 * number
    return b"\x30" + bytes([len(body)]) + body


def test_secrets(spark, empty):
    import base64

    key = base64.b64encode(_der_key()).decode()
    ssh = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b""))
    ssh += (1).to_bytes(4, "big") + b"".join(len(x).to_bytes(4, "big") + x for x in (b"p" * 20, b"s" * 20))
    texts = [
        None, "", 'é PassWord = "abc123x" token=short api-key=abcdefgh APIKEY: zzzzzz', "AKIA" + "B" * 16 + " AKIA" + "C" * 15,
        "x" + "0a" * 12 + "g " + "f" * 23, f"see {_jwt()} and {_jwt().replace('e', 'f', 1)}", f"k {key} {key[:-8]}",
        _der_key().hex(), base64.b64encode(ssh).decode(), base64.b64encode(key.encode()).decode(), "a.b.c " + "A" * 60,
        "-----BEGIN RSA PRIVATE KEY-----\n" + key[:40] + "\n" + key[40:] + "\n-----END RSA PRIVATE KEY-----",
    ]
    got = _by_id(secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    kinds = [[s["kind"] for s in got[i]["spans"]] for i in range(len(texts))]
    assert kinds == [[], [], ["assign", "assign"], ["access"], ["hex"], ["jwt"], ["der_key"], ["hex", "der_key"],
                     ["openssh_key"], ["der_key"], [], ["der_key"]]
    assert [(s["start"], s["end"]) for s in got[2]["spans"]] == [(2, 21), (texts[2].index("APIKEY"), len(texts[2]))]
    digest = _by_id(secrets.digest(secrets.scan(empty.sparkSession.createDataFrame([(1, texts[2])], "doc_id long, text string"))))
    spans = ",".join(f"assign:{s['start']}:{s['end']}" for s in got[2]["spans"])
    assert digest[1]["spans"] == spans and digest[1]["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
    assert secrets.scan(empty).count() == 0


def test_toxicity_swaps_and_scores(spark):
    filler = ["the day was fine and long", "we met friends in town today", "a neutral neighbour came by"]
    insults = ["idiot", "scum", "loser", "clown", "trash", "moron"]
    rows = [(i, f"{filler[i % 3]} number{i % 7}") for i in range(60)]
    rows += [(100 + i, f"{filler[i % 3]} {insults[i % 6]} muslim number{i % 7}") for i in range(60)]
    rows += [(200, None), (201, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in rows[:120]] + [(7, None), (None, 1)], "doc_id long, toxic int")
    free, tied = (toxicity.fit(docs, labels, swap_weight=w) for w in (0.0, 100.0))

    def gap(m):
        return abs(m.word("muslim") - m.word("christian"))

    assert gap(free) > 0.5 and gap(tied) < 0.5 * gap(free)
    got = _by_id(toxicity.score(docs, tied))
    assert max(got[i]["score"] for i in range(60)) < min(got[100 + i]["score"] for i in range(60))
    assert got[200]["score"] == got[201]["score"]
    none = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score(docs.limit(0), none).count() == 0


def test_quality(spark, docs, empty):
    for t in TEXTS:
        own = (t or "").encode().split()
        count = Counter(tuple(own[i : i + 8]) for i in range(len(own) - 7))
        hit = {j for i in range(len(own) - 7) if count[tuple(own[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        chars = len(re.sub(r"[\x20\x09-\x0D]", "", t or ""))
        marks = len(re.findall(r"[#*$%&|<>]", t or ""))
        assert quality.base_counts(t or "") == (len(own), chars, marks, len(lines) - len(set(lines)), len(hit))
    rnd = random.Random(1)
    good = [(i, "\n".join(" ".join(rnd.choice(WORDS) for _ in range(12)) + "." for _ in range(4))) for i in range(40)]
    bad = [(100 + i, "\n".join(" | ".join(rnd.choice(WORDS) for _ in range(9)) for _ in range(4))) for i in range(40)]
    texts = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in good + bad], "doc_id long, quality int")
    got = _by_id(quality.judge(texts, quality.fit(texts, labels)))
    assert all(got[i]["kept"] for i, _ in good) and not any(got[i]["kept"] for i, _ in bad)
    blank = quality.Field([[0.0, 0.0]] * quality.N_FEATURES, [0.0, 0.0], [[0.0, 0.0]] * 2)
    assert all(r["kept"] != r["base_failed"] for r in quality.judge(docs, blank).collect())
    assert quality.judge(empty, blank).count() == 0


def test_viterbi_is_the_best_path():
    from itertools import product

    rnd = random.Random(5)
    emit = [[rnd.uniform(-2, 2) for _ in range(2)] for _ in range(quality.N_FEATURES)]
    field = quality.Field(emit, [0.3, -0.2], [[0.5, -0.7], [-0.4, 0.9]])
    lines = [[rnd.randrange(quality.N_FEATURES) for _ in range(4)] for _ in range(7)]

    def value(path):
        total = field.start[path[0]] + sum(emit[f][s] for fs, s in zip(lines, path, strict=True) for f in fs)
        return total + sum(field.move[a][b] for a, b in zip(path, path[1:]))

    assert tuple(field.viterbi(lines)) == max(product((0, 1), repeat=7), key=value)


def test_licenses(spark, docs):
    texts = ["plain words\nReleased under the MIT License.\nmore", "Licensed under the Apache License, Version 2.0.", None, "",
             "All rights reserved.", "licence to write many plain words"]
    rows = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    model = licenses.fit(docs.select("doc_id", "text").union(rows), sample=200)
    got = _by_id(licenses.digest(licenses.scan(rows, model)))
    assert {i: r["places"] for i, r in got.items()} == {1000: "1:mit", 1001: "0:apache", 1004: "0:proprietary", 1005: ""}
    assert licenses.scan(rows.limit(0), model).count() == 0


@pytest.fixture(scope="module")
def license_model(docs):
    return licenses.fit(docs.select("doc_id", "text"), sample=200)


WRAPPED = {
    "gpl": "# This program is free software: you can redistribute it and/or modify\n"
    "# it under the terms of the GNU General Public License as published by\n"
    "# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.",
    "lgpl": " * This library is free software; you can redistribute it and/or\n"
    " * modify it under the terms of the GNU Lesser General Public\n"
    " * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) any later version.",
    "bsd": "Redistribution and use in source and binary forms, with or without\n"
    "modification, are permitted provided that the following conditions are met:",
}


def test_wrapped_licenses(spark, license_model):
    texts = [f"plain words\nand more\n\n{t}\n\nimport os" for t in WRAPPED.values()]
    texts += ["\n".join(re.sub("[#*]", "", t).split()) for t in WRAPPED.values()]  # a word a line
    texts += [f"{t}\n\nplain\n\n{t}" for t in WRAPPED.values()]
    texts += ["\n\n".join(WRAPPED["bsd"].split("\n"))]  # a blank line ends a paragraph
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = _by_id(licenses.digest(licenses.scan(rows, license_model)))
    assert [got[i]["places"] for i in range(3)] == [f"3:{f}" for f in WRAPPED]
    assert [got[i]["families"] for i in range(3, 6)] == list(WRAPPED)
    again = [t.count("\n") + 4 for t in WRAPPED.values()]
    assert [got[i]["places"] for i in range(6, 9)] == [f"0:{f},{n}:{f}" for f, n in zip(WRAPPED, again, strict=True)]
    assert got[9]["places"] == ""


def test_decontamination_holds_one_block_at_a_time(spark, docs, monkeypatch):
    from pyspark.core.broadcast import Broadcast

    texts = [t for t in TEXTS if t and len(t.split()) > 12]
    items = [(f"i{i}", t[: 400 + i]) for i, t in enumerate(texts)] + [("same", texts[0])] * 50 + [(None, texts[1])]
    bench = spark.createDataFrame(items, "item_id string, text string")
    gone = []
    destroy = Broadcast.destroy
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: (gone.append(self), destroy(self, *a)))
    whole = sorted(map(str, decontam.scan(docs, bench).collect()))
    assert gone == []
    _, blocks = decontam.blocks_of(bench, "item_id", "text", 3000)
    parts = sorted(map(str, decontam.scan(docs, bench, block_bytes=3000).collect()))
    assert blocks > 2 and len(gone) == blocks - 1 and parts == whole


def test_license_gates_change_no_result(spark, license_model, monkeypatch):
    rnd = random.Random(5)
    notices = [t.split() for texts in licenses.TEMPLATES.values() for t in texts]
    texts = []
    for i in range(400):
        lines = []
        for _ in range(rnd.randint(1, 5)):
            w = rnd.choice(notices)
            a = rnd.randint(0, len(w) - 1)
            w = w[a : a + rnd.randint(1, len(w))]
            if i % 3:
                w = [x for x in w if rnd.random() < 0.9] + rnd.choices(WORDS, k=rnd.randint(0, 4))
            lines.append(rnd.choice([" ", "\n"]).join(w) if i % 2 else " ".join(w))
        texts.append("\n".join(lines))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).cache()
    gated = sorted(map(str, licenses.scan(rows, license_model).collect()))
    words = sorted({w for row in licenses._template_rows() for w in row["words"]})
    monkeypatch.setattr(licenses.Model, "gate", lambda self: None)
    monkeypatch.setattr(licenses, "run_gate", lambda: words)
    assert license_model.gate() is None
    every = licenses.scan(rows, license_model).collect()
    assert gated == sorted(map(str, every))
    assert sum(len(r["licenses"]) > 0 for r in every) > 100


def test_license_sample_has_no_cap_on_lines(spark):
    rows = [(i, "\n".join(" ".join(f"w{i}x{j}x{k}" for k in range(3)) for j in range(4))) for i in range(50)]
    rows += [(100, " ".join(f"long{k}" for k in range(5000))), (101, None), (102, "...\n\n")] + [(200 + i, "same line of words") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    every = licenses.drawn(licenses.id_text(docs), 1000).collect()
    assert len(every) == 202 and max(len(r["words"]) for r in every) == licenses.MAX_WORDS
    assert any(r["words"][0].startswith("long") for r in every)
    assert licenses.drawn(licenses.id_text(docs), 20).count() == 20
    assert licenses.drawn(licenses.id_text(docs.limit(0)), 20).count() == 0


def test_licenses_are_fitted_on_every_paragraph(spark):
    rows = [(i, "\n".join(f"word{i}x{j} under a blue sky" for j in range(20))) for i in range(400)]
    rows += [(500, " ".join(f"long{k}" for k in range(300)) + " prior written"), (501, "same line\n\nsame line"), (502, "Released under the MIT License.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    positive, ordinary = licenses.training(licenses.id_text(docs))
    sets = {tuple(r["features_of"]): r["n"] for r in ordinary.collect()}
    assert sets == {("a", "under", "under a"): 8000, ("prior", "prior written", "written"): 1, (): 1}
    assert {r["family"] for r in positive.collect()} == set(licenses.TEMPLATES)
    model = licenses.fit(docs)
    got = _by_id(licenses.digest(licenses.scan(docs, model)))
    assert sum(r["n_predicted"] for i, r in got.items() if i < 502) <= 8 and got[502]["places"] == "0:mit"


def test_license_cutoff_counts_every_paragraph(spark):
    scored = spark.createDataFrame([(99_890, 0.1), (100, 0.7), (9, 0.8), (1, 1.0)], "n long, p double")
    assert 0.7 < licenses._cutoff(scored) < 0.71
    assert 0.1 < licenses._cutoff(scored.where("p != 0.7")) < 0.11
    assert licenses._cutoff(scored.limit(0)) == 0.0


def _wrap(text, width, end="\n"):
    return end.join(text[i : i + width] for i in range(0, len(text), width))


def test_secrets_over_line_ends():
    import base64
    import json

    number = b"\x02\x81\x81" + bytes(range(1, 130))
    body = b"\x02\x01\x00" + 8 * number
    data = b"\x30\x82" + len(body).to_bytes(2, "big") + body
    key = base64.b64encode(data).decode()
    ssh = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b""))
    ssh += (1).to_bytes(4, "big") + b"".join(len(x).to_bytes(4, "big") + x for x in (b"p" * 90, b"s" * 200))
    ssh = base64.b64encode(ssh).decode()
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{_wrap(key, 64)}\n-----END RSA PRIVATE KEY-----\n"

    def found(text):
        return [(secrets.KINDS[k], text[a:b]) for a, k, b in secrets.confirmed_spans(text)]

    for text in (json.dumps({"key": pem}), json.dumps(json.dumps({"key": pem.replace("\n", "\r\n")})), json.dumps(pem).replace("/", "\\/")):
        [(kind, span)] = found(text)
        assert kind == "der_key" and span.startswith("-----BEGIN") and span.endswith("-----")
    twice = base64.b64encode(key.encode()).decode()
    for kind, body in (("der_key", key), ("der_key", data.hex()), ("der_key", data.hex().upper()), ("openssh_key", ssh), ("der_key", twice)):
        for width in (16, 64, 76):
            for end in ("\n", "\r\n", "\n    ", "\\n", "\\r\\n", "\\\\n", '",\n  "', "\n# "):
                wrapped = _wrap(body, width, end)
                for text in (wrapped, f"the key:\n{wrapped}\nend of it", f'{{"k": "{wrapped}"}}', f"K={wrapped}\\n", f"a\\n{wrapped}\\nend"):
                    assert found(text) == [(kind, wrapped)], (width, end, text[:40])
    assert found(_wrap(key[:-80], 64)) == [] and found(_wrap(key[4:], 64)) == []
    assert found(f"a\\n{key}\\nb") == [("der_key", key)]
    assert found(f"{_wrap(key, 64)}\n{_wrap(ssh, 64)}")[0] == ("der_key", _wrap(key, 64))


def test_licenses_judges_each_row_by_itself(spark, license_model):
    mit, apache, plain = "Released under the MIT License.", "x y\nLicensed under the Apache License, Version 2.0.", "a few plain words"
    rows = [(None, mit), (None, mit), (None, apache), (None, plain), (5, mit), (5, mit), (5, apache), (5, plain), (6, mit), (7, None), (8, "")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), license_model).collect()
    alone = {t: licenses.scan(spark.createDataFrame([(1, t)], "doc_id long, text string"), license_model).first() for t in (mit, apache, plain)}
    want = Counter((i, *map(str, alone[t][1:])) for i, t in rows if t)
    assert Counter((r["doc_id"], *map(str, r[1:])) for r in got) == want
    assert [x["family"] for x in alone[mit]["licenses"]] == ["mit"] and [x["line"] for x in alone[apache]["licenses"]] == [1]
    assert alone[plain]["licenses"] == [] and alone[mit]["n_predicted"] == 1


def test_line_dedup_of_rows_that_share_an_id(spark):
    rows = [(None, f"same head\nunique line {i}\nlast one {i}") for i in range(4)] + [(None, "same head\nsame head"), (None, None), (None, None)]
    rows += [(3, "alone three\nsame head"), (3, "other three\nown text"), (4, "twice here"), (4, "twice here")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, n int").repartition(3)
    kept = {r["n"]: r["text"] for r in linededup.drop_lines(docs).collect()}
    assert kept[5] is None and kept[6] is None and kept[7] == "alone three" and kept[8] == rows[8][1]
    assert sorted(set(kept) & {9, 10}) in ([9], [10])
    assert all(f"unique line {i}\nlast one {i}" in kept[i] for i in range(4))
    assert sum((t or "").count("same head") for t in kept.values()) == 1
    got = linededup.dropped_lines(docs).collect()
    assert len(got) == 9 and sum(r["n_lines"] for r in got) == 20 and sum(r["n_dropped"] for r in got) == 7
