"""Every stage of the pipeline, each on its own input, and ``run`` as a whole,
against brute-force versions on small tables with planted cases."""

import random
import re
import tempfile
import zlib

import pytest

import corpus_pipeline
from tracelake.llm import toxicity

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "re", "so", "ti") for b in ("ten", "bar", "dol", "fin", "gum", "hat", "jet")]
INSULTS = ["idiots", "vermin", "scum", "filth"]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def _tables():
    rnd = random.Random(11)

    def prose(n, extra=()):
        return " ".join(rnd.choice([*WORDS, *extra]) for _ in range(n))

    texts = [prose(40) for _ in range(40)]
    texts += [prose(30, INSULTS * 4) for _ in range(40)]
    near = prose(200).split()
    for i in range(3):  # two words changed: no line within one edit, a similarity over 0.75
        w = list(near)
        w[20 * i + 3], w[20 * i + 9] = f"one{i}", f"two{i}"
        texts.append(" ".join(w))
    passage = prose(25)
    texts += [f"{prose(20)}\nthe same line here\n{prose(15)}" for _ in range(4)]
    texts += [prose(30) + "\n" + " ".join(passage.split()[4:18]) + " " + prose(8), texts[0], None, "", "the same line here"]
    documents = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    labels = [(i, 1, int(40 <= i < 80)) for i in range(80)]
    return documents, labels, [(1, passage), (2, None), (3, "")]


DOCUMENTS, LABELS, BENCHMARK = _tables()


@pytest.fixture(scope="module")
def sf_dir(spark):
    path = tempfile.mkdtemp(prefix="tracelake-pipeline-")
    spark.createDataFrame(DOCUMENTS, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def _without_lines(rows):
    first, own = {}, []
    for d, t, *rest in sorted(rows):
        lines = (t or "").split("\n")
        words = [tuple(x for x in re.split(r"[ \t\x0b\f\r]+", line.lower()) if x) for line in lines]
        own.append((d, t, lines, words, rest))
        for i, w in enumerate(words):
            if w:
                first.setdefault(w, (d, i))

    def alike(a, b):
        if min(len(a), len(b)) < 8 or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
        short, long = sorted((a, b), key=len)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    gone = {w for w, p in first.items() if any(q < p and alike(w, v) for v, q in first.items())}
    kept = []
    for d, t, lines, words, rest in own:
        stay = [not w or (first[w] == (d, i) and w not in gone) for i, w in enumerate(words)]
        if all(stay):
            kept.append((d, t, *rest))
        elif any(s for s, w in zip(stay, words, strict=True) if w):
            kept.append((d, "\n".join(x for x, s in zip(lines, stay, strict=True) if s), *rest))
    return kept


def _first_of_classes(rows):
    sets = {}
    for d, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    group = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    return [r for r in rows if group[r[0]] == r[0]]


def _clean(rows):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())

    windows = {tuple(w[i : i + 10]) for _, t in BENCHMARK for w in [words(t)] for i in range(len(w) - 9)}
    return [r for r in rows if not any(tuple(words(r[1])[i : i + 10]) in windows for i in range(len(words(r[1])) - 9))]


def test_every_stage_and_run(spark, sf_dir):
    import public_tokenizers
    from tokenizers import Tokenizer

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    want = [r for r in DOCUMENTS if model.score(r[1] or "") < toxicity.THRESHOLD]
    assert {r[0] for r in DOCUMENTS} - {r[0] for r in want} == set(range(40, 80))  # the toxic ones and no other
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    after = {"line_dedup": _without_lines, "near_dedup": _first_of_classes, "decontamination": _clean}
    docs, sizes = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        want = after[name](want) if name in after else want
        assert docs.columns == documents.columns
        got = sorted(map(tuple, docs.collect()))
        assert got == sorted(want), name
        sizes.append(len(got))
        docs = spark.createDataFrame(got, COLUMNS)
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3]  # every stage's decisions take effect

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: whole.encode(t or "", add_special_tokens=False).ids + [2] for d, t, *_ in want}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    seen, ends = {d: 0 for d in ids}, {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["start"] == seen[r["doc_id"]] and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in own))
        seen[r["doc_id"]] += r["length"]
    assert seen == {d: len(x) for d, x in ids.items()}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 4096 and sorted(ends) == list(range(len(ends)))
