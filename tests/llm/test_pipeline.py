"""The pipeline against a brute-force version of every stage, on a small table and on an odd one."""

import re
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lexforge.llm import toxicity

SMALL = "/root/testdata/sf0.001"


def keep_clean(rows, labels):
    learned = {i: y for i, y in labels if i is not None and y in (0, 1) and zlib.crc32(str(i).encode()) % 3 != 1}
    chosen = sorted((i, t or "") for i, t in rows if i in learned)
    share = sum(learned.values()) / len(learned) if learned else 0.0
    model = toxicity.ToxicityModel([i for i, _ in chosen], [t for _, t in chosen], [learned[i] for i, _ in chosen], share)
    return [(i, t) for i, t in rows if model.score(t or "")[0] < 0.7]


def keep_last_of_equal(rows):
    best = {}
    for i, t in rows:
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
    return [(i, t) for i, t in rows if i == best[t or ""]]


def keep_first_of_near(rows):
    grams = {}
    for i, t in rows:
        w = re.findall(r"\w+", (t or "").lower())
        grams[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in grams}

    def top(x):
        return x if parent[x] == x else top(parent[x])

    for a in sorted(grams):
        for b in sorted(grams):
            if a < b and grams[a] and grams[b] and len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b]) - 1e-9:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return [(i, t) for i, t in rows if top(i) == i]


def cut_repeats(rows):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        keep = np.ones(len(raw), bool)
        for s in range(len(raw) - 99):
            w = raw[s : s + 100]
            if w in seen:
                keep[s : s + 100] = False
            seen.add(w)
        out.append((i, None if t is None else bytes(np.frombuffer(raw, np.uint8)[keep]).decode("utf-8", "ignore")))
    return out


def pieces(rows):
    lib, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), set()
    for i, t in rows:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        a, b, k = 0, (len(ids) - 1) % 1024 + 1, 0
        while a < len(ids):
            out.add((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
            a, b, k = b, b + 1024, k + 1
    return out


def check(spark, docs, folder, monkeypatch):
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for step in (lambda x: keep_clean(x, labels), keep_last_of_equal, keep_first_of_near, cut_repeats):
        rows = step(rows)
    monkeypatch.setattr(corpus_pipeline, "table", lambda spark_, dir_, name: docs)
    got = corpus_pipeline.run(spark, folder).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == pieces(rows) and len(got) == len(pieces(rows))
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in bins.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024


def test_pipeline_is_its_stages_by_brute_force(spark, monkeypatch):
    real = corpus_pipeline.table
    docs = real(spark, SMALL, "documents")
    labels = real(spark, SMALL, "labels")
    monkeypatch.setattr(corpus_pipeline.toxicity, "fit", lambda d, _, fit=toxicity.fit: fit(d, labels))
    check(spark, docs, SMALL, monkeypatch)


def test_pipeline_on_an_odd_table(spark, monkeypatch):
    labels = corpus_pipeline.table(spark, SMALL, "labels")
    monkeypatch.setattr(corpus_pipeline.toxicity, "fit", lambda d, _, fit=toxicity.fit: fit(d, labels))
    word = lambda i: f"từ{i % 97}x{i % 89}"
    long = " ".join(map(word, range(60_000)))  # longer than the slices that long texts are worked on by
    rows = [(0, None), (1, ""), (2, "a b"), (3, "a b"), (4, long), (5, long + " hết"), (6, "A" * 700), (7, "x " * 300), (8, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, i, "y") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, _gone long, class_id string")
    check(spark, docs, SMALL, monkeypatch)
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: docs.where(F.lit(False)))
    assert corpus_pipeline.run(spark, SMALL).collect() == []
