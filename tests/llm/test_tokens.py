import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lexforge.llm.bpe import bpe_round_trip, encoder
from lexforge.llm.packing import best_fit_pack, fullest, plan_bins
from lexforge.llm.token_count import counter, token_counts

BPE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("table", ["odd", "data"])
def test_round_trip_is_the_librarys(spark, odd_docs, table):
    docs = odd_docs if table == "odd" else spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lib, want = Tokenizer.from_file(BPE), {}
    for i, t in texts_of(docs):
        ids = lib.encode(t, add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = bpe_round_trip(docs).collect()
    assert len(got) == docs.count() and all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == want[r.doc_id] for r in got)


def test_any_mixture_is_the_librarys():
    rng, lib, e = random.Random(3), Tokenizer.from_file(BPE), encoder(BPE)
    signs = "aé×\n'1. \tüÀß日-_*x2\u00a0\u3000İ÷\x00\x1c\x7f"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(4_000)]
    texts += ["ab\n\n\ncd\n\nEf\n", "tail ", " lead", "", "ab\n\ncd ef\n\n gh", "x " * 50_000, "<|endoftext|>" * 3, "w" * 100_000, "it's he'll 'ABC'"]
    for part in (texts, texts[::-1]):  # the second time from the table
        ids, bounds = e.encode_column(pa.array(part, pa.string()))
        got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
        assert got == [x.ids for x in lib.encode_batch(part, add_special_tokens=False)]
    e.table.clear()
    e.table.bits = 6  # a table that is soon full
    e.table.clear()
    ids, bounds = e.encode_column(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [x.ids for x in lib.encode_batch(texts, add_special_tokens=False)]
    e.table.bits = 20
    e.table.clear()


def test_automaton_finds_the_longest_token_at_each_place():
    e = encoder(BPE)
    tokens = set(e.bytes_of)
    text = "The   quick brúwn—fox jumps; antidisestablishmentarianism 日本 12345\n\n  return self.__init__()".encode()
    state, match = np.zeros(1, np.int32), np.zeros(1, np.int32)
    names = [e.bytes_of[i] for i in e.ids]
    for end in range(1, len(text) + 1):
        state, match = e.step(state, match, np.array([text[end - 1]], np.uint8))
        found = names[int(e.last_tokens(state, match)[0])]
        assert found == next(text[a:end] for a in range(end) if text[a:end] in tokens)
        shorter = int(e.shorter[e.last_tokens(state, match)[0]])
        rest = [found[a:] for a in range(1, len(found)) if found[a:] in tokens]
        assert (names[shorter] if shorter >= 0 else None) == (rest[0] if rest else None)


def test_every_token_is_its_own_encoding():
    e = encoder(BPE)
    words = [e.bytes_of[i] for i in e.ids]
    assert [np.frombuffer(x, "<u4").tolist() for x in e.encode_words(words)] == [[i] for i in e.ids]


@pytest.mark.parametrize("table", ["odd", "data"])
def test_counts_are_the_librarys(spark, odd_docs, table):
    docs = odd_docs if table == "odd" else spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lib = Tokenizer.from_file(WORD)
    want = {i: (len(t.encode()), len(lib.encode(t, add_special_tokens=False).ids)) for i, t in texts_of(docs)}
    assert all((r.n_bytes, r.n_tokens) == want[r.doc_id] and r.over_limit == (r.n_tokens > 2048) for r in token_counts(docs).collect())
    assert counter(WORD).merge_count(b"") == 0


def test_packing(spark, odd_docs):
    lib = Tokenizer.from_file(BPE)
    for docs in (odd_docs, spark.read.parquet("/root/testdata/sf0.001/documents.parquet")):
        want = {}
        for i, t in texts_of(docs):
            ids = [*lib.encode(t, add_special_tokens=False).ids, 2]
            a, b, k = 0, (len(ids) - 1) % 1024 + 1, 0
            while a < len(ids):
                want[i, k] = (a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
                a, b, k = b, b + 1024, k + 1
        rows = best_fit_pack(docs).collect()
        assert all(want[r.doc_id, r.piece] == (r.start, r.length, r.ids_crc32) for r in rows) and {(r.doc_id, r.piece) for r in rows} == set(want)
        bins = {}
        for r in rows:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for pieces in bins.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= 1024
        assert len(bins) <= -(-sum(r.length for r in rows) // 1024) * 1.05 + 1


def test_fullest_combination():
    assert fullest({7: 1, 5: 2, 3: 1}, 10) == {7: 1, 3: 1}
    runs = plan_bins({6: 2, 4: 3}, 10)
    assert max(r[3] for r in runs) == 2


def test_empty_tables(no_docs):
    assert bpe_round_trip(no_docs).collect() == token_counts(no_docs).collect() == best_fit_pack(no_docs).collect() == []
