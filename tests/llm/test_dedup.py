import hashlib
import random
import time
from collections import defaultdict

from lexforge.llm import exact_dedup, line_dedup, ngram_join, suffix_dedup
from lexforge.llm.mphf import MinimalPerfectHash, digest_keys
import numpy as np


def near_docs(spark, seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    passage = " ".join(word() for _ in range(40))
    rows = []
    for g in range(6):
        base = [word() for _ in range(60)]
        for _ in range(9):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = word()
            rows.append(" ".join(w))
    rows += [rows[0], rows[0], passage, "x y", "x y", "", " "] + [" ".join([*(word() for _ in range(20)), passage, *(word() for _ in range(20))]) for _ in range(8)]
    rng.shuffle(rows)
    return spark.createDataFrame([*enumerate(rows), (900, None), (None, rows[0])], "doc_id long, text string")


def unions(pairs, ids):
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def test_perfect_hash():
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(5000)), np.uint8).reshape(-1, 32)
    slots = MinimalPerfectHash(digest_keys(digests)).slots(digest_keys(digests))
    assert sorted(slots.tolist()) == list(range(5000))
    index = exact_dedup.DigestIndex(digests[:100], np.arange(100), np.ones(100, np.int64))
    assert (index.find(digests[100:]) == -1).all() and (index.digests[index.find(digests[:100])] == digests[:100]).all()


def test_exact(spark, odd_docs, no_docs):
    for docs in (odd_docs, near_docs(spark)):
        groups = defaultdict(list)
        rows = [(r.doc_id, r.text or "") for r in docs.collect()]
        for i, t in rows:
            groups[t].append(i)
        got = exact_dedup.exact_dedup(docs).collect()
        assert len(got) == len(rows)
        keep = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
        want = sorted(((i, keep[t], len(groups[t]), i == keep[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in rows), key=repr)
        assert sorted(map(tuple, got), key=repr) == want
        kept = exact_dedup.drop_repeats(docs)
        assert kept.columns == docs.columns and kept.select("text").distinct().count() == docs.selectExpr("coalesce(text, '') t").distinct().count()
    assert exact_dedup.exact_dedup(no_docs).collect() == []
    first, second = near_docs(spark).where("doc_id < 30"), near_docs(spark).where("doc_id >= 30")
    assert exact_dedup.exact_dedup(second, first).count() == second.count()


def test_ngram_join(spark, odd_docs, no_docs):
    for docs, block in ((near_docs(spark), 1024), (near_docs(spark), 4), (odd_docs, 1024)):
        rows = {r.doc_id: ngram_join.WORD.findall((r.text or "").lower()) for r in docs.collect() if r.doc_id is not None}
        sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in rows.items()}
        pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
        classes = unions(pairs, sets)
        got = ngram_join.ngram_join(docs, block=block).collect()
        assert len(got) == docs.count()
        for r in got:
            if r.doc_id is None:
                assert r.class_id is None and r.n_links == 0
            else:
                assert r.class_id == classes[r.doc_id] and r.n_links == sum(r.doc_id in p for p in pairs)
    assert ngram_join.ngram_join(no_docs).collect() == []


def test_suffix_dedup(spark, odd_docs, no_docs):
    for docs, hot in ((near_docs(spark), 16_384), (near_docs(spark), 2), (odd_docs, 16_384)):
        seen, want = set(), {}
        for i, t in sorted({(r.doc_id, r.text or "") for r in docs.collect() if r.doc_id is not None}):
            raw = t.encode()
            covered = bytearray(len(raw))
            for s in range(len(raw) - 99):
                w = raw[s : s + 100]
                if w in seen:
                    covered[s : s + 100] = b"\1" * 100
                seen.add(w)
            want[i] = (len(raw), sum(covered), sum(covered[p] and not (p and covered[p - 1]) for p in range(len(raw))), hashlib.sha256(bytes(x for x, c in zip(raw, covered) if not c)).hexdigest())
        got = suffix_dedup.suffix_dedup(docs, hot_runs=hot).collect()
        assert len(got) == docs.count()
        for r in got:
            assert (r.n_removed == 0) if r.doc_id is None else tuple(r)[1:] == want[r.doc_id]
        stripped = suffix_dedup.strip_repeats(docs)
        assert stripped.columns == docs.columns and stripped.count() == docs.count()
    assert suffix_dedup.suffix_dedup(no_docs).collect() == []


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(2)
    for _ in range(3000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 9))) for _ in range(2))
        for k in range(4):
            assert line_dedup.within(a, b, k) == (edit_distance(a, b) <= k)


def test_line_dedup(spark, odd_docs, no_docs):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdef ") for _ in range(30)).strip() + "xyz" for _ in range(15)]

    def change(x):
        x = list(x)
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(x))
            x[i : i + 1] = rng.choice([[], ["z"], [x[i], "q"]])
        return "".join(x)

    rows = [(i, "\n".join(change(rng.choice(base)) if rng.random() < 0.7 else rng.choice(["", "short", " "]) for _ in range(5))) for i in range(40)] + [(99, None), (None, base[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = sorted({x for i, t in rows if t and i is not None for x in t.split("\n") if x.strip()})
    pairs = [(a, b) for a in lines for b in lines if a < b and min(len(a), len(b)) >= 20 and edit_distance(a, b) <= 2]
    classes, seen, want = unions(pairs, lines), set(), {}
    for i, t in rows:
        want[i] = []
        for n, x in enumerate((t or "").split("\n")):
            if x.strip() and i is not None:
                if classes[x] in seen:
                    want[i].append(n)
                seen.add(classes[x])
    for block in (2048, 4):
        got = line_dedup.line_dedup(docs, block=block).collect()
        assert len(got) == len(rows) and all(r.removed_lines == want[r.doc_id] for r in got)
    assert line_dedup.line_dedup(odd_docs).count() == odd_docs.count()
    assert line_dedup.line_dedup(no_docs).collect() == []


def shuffled(spark):
    """Bytes of shuffle files written so far."""
    time.sleep(1)  # the store is brought up to date every 100 ms
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()


def test_lines_without_partners_move_little(spark):
    """Index entries move once and packed, texts only to be written; before, entries moved twice and all lines with them."""
    rng = random.Random(6)
    rows = [(i, "\n".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=200)) for _ in range(20))) for i in range(200)]
    docs, at = spark.createDataFrame(rows, "doc_id long, text string"), shuffled(spark)
    got = line_dedup.line_dedup(docs).collect()
    moved = (shuffled(spark) - at) / sum(len(t) for _, t in rows)
    assert all(r.n_removed == 0 for r in got) and moved < 2.4, moved
