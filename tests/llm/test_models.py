import math
import re
import zlib

import numpy as np
import pyarrow.parquet as pq

from lexforge.llm import ann, langid, toxicity

DATA = "/root/testdata/sf0.01"


def test_toxicity(spark, odd_docs, no_docs):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, model).collect()}
    assert len(got) == 1000
    truth = {r.doc_id: r.toxic for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    hit = [i for i in truth if got[i].predicted]
    assert sum(truth[i] for i in hit) >= 0.9 * len(hit) and sum(truth[i] for i in hit) >= 0.6 * sum(truth.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 for i, r in got.items())
    assert toxicity.toxicity_scores(odd_docs, model).count() == odd_docs.count()
    assert toxicity.drop_toxic(odd_docs, model).columns == odd_docs.columns
    nothing = toxicity.fit(no_docs, labels.limit(0))
    assert {r.score for r in toxicity.toxicity_scores(odd_docs, nothing).collect()} == {0.0}


def test_only_similar_examples_are_near_copies():
    words = [f"word{i:05d}longer" for i in range(4000)]
    shared = min(words, key=toxicity.xxhash.xxh64_intdigest)
    texts = [" ".join([shared, *words[i * 50 : i * 50 + 50]]) for i in range(40)]
    assert toxicity.copy_groups([*texts, texts[3] + " more", "", " "]).tolist() == [*range(40), 3, 41, 41]


def test_a_clean_text_never_hides_a_toxic_one():
    body = [" ".join(f"body{i}x{j}longer" for j in range(50)) for i in range(8)]
    texts = [*body, *(b + " slur" for b in body)]
    model = toxicity.ToxicityModel(list(range(16)), texts, [0] * 8 + [1] * 8)
    assert "slur" in model.terms


def test_equal_cosines_do_not_go_by_label():
    texts = [f"{toxicity.xxhash.xxh64_hexdigest(str(i))} plain" for i in range(200)]
    model = toxicity.ToxicityModel(list(range(200)), texts, [0] * 100 + [1] * 100)
    assert 0 < model.labels[model.score("plain else")[1]].sum() < 15
    assert model.score("of words that no example holds")[0] == model.prior == 0.5


def test_nearest_examples_are_those_of_the_texts(spark):
    """Brute force: TF-IDF vectors of whole texts made here, all cosines, copies of the text left out."""
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}

    def unit(text):
        tf = {}
        for w in re.findall(r"\w+", text.lower()):
            t = next((x for x in (w, *(w[:n] + "*" for n in toxicity.PREFIXES if len(w) > n)) if x in model.terms), None)
            if t:
                tf[t] = tf.get(t, 0) + 1
        v = {t: model.idf[model.terms[t]] * (1 + math.log(n)) for t, n in tf.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    examples = [unit(texts[i]) for i in model.ids.tolist()]
    words = {w for i in model.ids.tolist() for w in re.findall(r"\w+", texts[i].lower())}
    assert all(model.term(w) >= 0 for w in words) and len(examples) > 200  # no word is left out
    scored = {}
    for i in sorted(texts)[:150]:
        v = unit(texts[i])
        cosines = sorted((c for c in (sum(x * e.get(t, 0) for t, x in v.items()) for e in examples) if 0 < c < 1 - 1e-9), reverse=True)[:15]
        scored[i], near, got = model.score(texts[i])
        assert np.allclose(got, cosines)
    assert len({round(s, 9) for s in scored.values()}) > 0.5 * len(scored)  # hardly two texts have the same evidence


def test_a_text_does_not_vote_on_itself():
    texts = [f"w{i} x{i} shared{i % 3}" for i in range(60)]
    model = toxicity.ToxicityModel(list(range(60)), texts, [int(i % 2) for i in range(60)])
    for i in range(60):
        assert i not in model.ids[model.score(texts[i])[1]].tolist()


def test_language(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = langid.fit(docs)
    got = {r.doc_id: r for r in langid.language_id(docs, model).collect()}
    held = [r for r in docs.collect() if got[r.doc_id].held_out]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.98 * len(held)
    odd = langid.language_id(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and {r.lang_pred for r in odd if r.doc_id in (0, 1, 100)} == {"und"}
    assert {r.lang_pred for r in langid.language_id(odd_docs, langid.fit(no_docs)).collect()} == {"und"}


def test_margins_are_those_of_the_kernel_route(spark):
    """Presence kernels of the texts' n-grams with every landmark, the Nyström map and the ridge weights, all from sets."""
    rows = spark.read.parquet(f"{DATA}/documents.parquet").where("lang is not null").orderBy("doc_id").limit(120).collect()
    texts, langs = [r.text or "" for r in rows[:90]], [r.lang for r in rows[:90]]
    m = langid.LanguageModel(texts, langs, landmarks=20)

    def grams(text):
        flat = "".join(c if c.isalpha() else " " for c in text.lower())
        return {flat[i : i + n] for n in (1, 2, 3) for i in range(len(flat) - n + 1)}

    mark = langid.Marker()
    hashed = lambda text: set(mark.grams(text).tolist())
    marks = [hashed(texts[i]) for i in m.chosen]
    asked = [r.text or "" for r in rows[90:]] + ["ß", "Ελληνικά γράμματα", "日本語の文"]
    for text, got in zip(asked, m.margins(asked, mark)):
        mine = hashed(text)
        assert 0.98 * len(grams(text)) <= len(mine) <= len(grams(text))  # hardly any n-grams share a hash
        kernel = np.array([len(mine & x) / math.sqrt(len(mine) * len(x)) for x in marks])
        assert np.allclose(kernel @ m.root @ m.ridge[:-1] + m.ridge[-1], got, atol=1e-4)


def test_scripts_beyond_latin():
    texts = ["это русский текст и слова", "ещё один русский текст", "这是中文文本和词语", "另一个中文的句子", "これは日本語の文です", "もう一つの日本語の文", "이것은 한국어 문장", "또 다른 한국어 글"]
    langs = ["ru", "ru", "zh", "zh", "ja", "ja", "ko", "ko"]
    m = langid.LanguageModel(texts, langs)
    assert m.predict(["русские слова", "中文词语", "日本語です", "한국어 글", "123 !", ""], langid.Marker())[0] == ["ru", "zh", "ja", "ko", "und", "und"]


def test_neighbours(spark):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    t = pq.read_table(f"{DATA}/embeddings.parquet")
    ids, v = t["vec_id"].to_numpy(), np.array(t["embedding"].to_pylist())
    got = ann.nearest_neighbours(df).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for q, rows in by.items():
        exact = v @ v[ids == q][0]
        order = sorted((-s, i) for s, i in zip(exact.tolist(), ids.tolist()) if i != q)[:20]
        hits += len({i for _, i in order} & {r.vec_id for r in rows})
        assert [r.rank for r in sorted(rows, key=lambda r: r.rank)] == list(range(1, 21))
        assert all(abs(r.score - exact[ids == r.vec_id][0]) < 1e-12 for r in rows)
    assert hits >= 0.9 * 20 * len(by)


def recall(folder, sigma):
    """Share of the exact neighbours found in one block, on vectors scaled by lognormal lengths."""
    t = pq.read_table(f"/root/testdata/{folder}/embeddings.parquet").slice(0, ann.BLOCK_ROWS)
    ids, v = t["vec_id"].to_numpy(), np.array(t["embedding"].to_pylist(), float)
    v *= np.random.default_rng(5).lognormal(0, sigma, len(v))[:, None]
    asked = np.flatnonzero(ids % 20 == 0)[:100]
    hits = 0
    for i, (_, found, _) in zip(asked.tolist(), ann.search_block(ids, v, ids[asked], v[asked], 20)):
        order = [j for j in np.argsort(-(v @ v[i]), kind="stable").tolist() if j != i][:20]
        hits += len(set(ids[order].tolist()) & set(found.tolist()))
    return hits / (20 * len(asked))


def test_neighbours_of_small_tables():
    assert recall("sf0.001", 0) == 1


def test_neighbours_of_unequal_lengths(monkeypatch):
    assert recall("sf0.1", 0) == 1 and recall("sf0.1", 1) == 1
    monkeypatch.setattr(ann, "WHOLE", 500)  # forests; neighbours in so small a table are far, harder to find than in large ones
    assert recall("sf0.1", 0) >= 0.75 and recall("sf0.1", 1) >= 0.9


def test_forest_recall_on_a_larger_table():
    rng = np.random.default_rng(4)
    v = rng.standard_normal((20_000, 48))
    ids = np.arange(len(v))
    for v in (v, v / np.linalg.norm(v, axis=1)[:, None]):
        hits = 0
        for i, (_, found, _) in enumerate(ann.search_block(ids, v, ids[:100], v[:100], 20)):
            order = [j for j in np.argsort(-(v @ v[i])).tolist() if j != i][:20]
            hits += len(set(order) & set(found.tolist()))
        assert hits >= 0.9 * 20 * 100


def test_forest_asks_for_a_part_of_the_rows(monkeypatch):
    v = np.random.default_rng(2).standard_normal((12_000, 48))
    found = [len(c) for c in ann.PrefixForest(v).candidates(v[:100], int(ann.SHARE * len(v)))]
    assert np.mean(found) < 0.2 * len(v) and min(found) >= ann.SHARE * len(v)


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [5.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [1.0]), (None, [1.0, 1.0]), (20, [1.0, 0.0]), (7, [None, 1.0]), (40, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id) for r in ann.nearest_neighbours(df).collect())
    assert got == [(0, 1, 2), (0, 2, 1), (0, 3, 20), (20, 1, 2), (20, 2, 0), (20, 3, 1), (40, 1, 6)]
    twice = df.union(df).union(spark.createDataFrame([(20, [9.0, 0.0])], "vec_id long, embedding array<float>"))  # the smallest vector of an id counts
    assert sorted((r.query_id, r.rank, r.vec_id) for r in ann.nearest_neighbours(twice).collect()) == got
    assert ann.nearest_neighbours(df.limit(0)).collect() == []
