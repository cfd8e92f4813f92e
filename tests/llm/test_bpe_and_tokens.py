import base64
import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from feedlake.llm import bpe, token_count


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path(bpe.RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def hostile_texts(n=1500):
    rnd = random.Random(5)
    pieces = [*"ab'stmdrevl 1\n\t é中²,.!\x00\x1c　́", "'s", "'re", "'ll", " '", "\r\n", "😀", "  ", "the ", "ing"]
    made = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    wild = ["".join(chr(rnd.choice([rnd.randint(0, 0x2FFF), rnd.randint(32, 126)])) for _ in range(30)) for _ in range(n // 5)]
    return [*made, *wild, "", "a" * 3000, " " * 999, "x  ", "  x", "'s's'sabc", "don'tx", '"\'s', "'r'rx"]


def test_codec_equals_library_and_round_trips(reference):
    coder, texts = bpe.codec(bpe.RANKS), hostile_texts()
    for text, packed in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == reference.encode_ordinary(text)
        assert coder.decode(packed) == text.encode()
        assert coder.offsets(packed)[-1] == len(text.encode())


@pytest.mark.parametrize("window", [4, 7, 16, 61])
def test_windows_of_a_long_text_change_nothing(reference, monkeypatch, window):
    monkeypatch.setattr(bpe, "WINDOW", window)
    monkeypatch.setattr(bpe, "DECODED", 5)
    coder, texts = bpe.codec(bpe.RANKS), hostile_texts(300)
    for text, packed in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == reference.encode_ordinary(text)
        assert coder.decode(packed) == text.encode()
        assert coder.decoded_sha256(packed) == hashlib.sha256(text.encode()).hexdigest()


def test_memory_of_a_long_text_is_its_tokens_and_a_window():
    coder = bpe.codec(bpe.RANKS)
    words = [f"word{i % 5000} said " for i in range(40_000)]
    peaks = []
    for times in (8, 32):
        text = "".join(words) * times
        coder.encode([text[: 1 << 21]])
        tracemalloc.start()
        coder.decoded_sha256(coder.encode([text])[0])
        peaks.append((tracemalloc.get_traced_memory()[1], len(text)))
        tracemalloc.stop()
    grown = (peaks[1][0] - peaks[0][0]) / (peaks[1][1] - peaks[0][1])
    assert grown < 4  # bytes a character: the ids, twice while they are joined


def test_heap_and_side_by_side_merging_agree():
    coder = bpe.codec(bpe.RANKS)
    rnd = random.Random(3)
    pieces = [bytes(rnd.choice(b"theingronsa \xc3\xa9") for _ in range(rnd.randint(1, bpe.SHORT_BYTES))) for _ in range(500)]
    for size in range(1, bpe.SHORT_BYTES + 1):
        group = [p for p in pieces if len(p) == size]
        if group:
            assert coder.merge_short(group) == [coder.merge_long(p) for p in group]


def test_scan_equals_step_by_step():
    first, table, from_fresh, _ = bpe.automaton()
    symbols = np.random.default_rng(1).integers(0, 9, 5000)
    state, want = bpe.FRESH, []
    for s in symbols:
        state = bpe._step(state, int(s))
        want.append(state)
    assert from_fresh[bpe.scan(first[symbols], table)].tolist() == want


def test_documents_with_nulls_repeats_and_clashing_columns(docs_of, spark):
    docs = docs_of([(1, None), (1, None), (None, "a b"), (2, "")])
    docs = docs.withColumnRenamed("lang", "n_tokens")
    rows = bpe.round_trip(docs).collect()
    assert sorted((r.doc_id is None, r.n_tokens) for r in rows) == [(False, 0), (False, 0), (False, 0), (True, 2)]
    out = bpe.decode_documents(bpe.encode_documents(docs.withColumn("token_ids", docs.text))).collect()
    assert sorted(bytes(r.decoded) for r in out) == [b"", b"", b"", b"a b"]
    assert bpe.round_trip(docs.limit(0)).collect() == []


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(public_tokenizers.path(token_count.MODEL))


def test_counts_equal_library(model):
    texts = hostile_texts(600) + ["a <|endoftext|> b<|startoftext|>c", "İstanbul ſ́ ΑΣ"]
    want = [len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)]
    assert token_count.Counter(model).count(texts) == want


def test_overlapping_chunks_resynchronise(model):
    rnd = random.Random(2)
    words = ["the", "ofthe", "naïve", "x", "don't", "<|endoftext|>", "a" * 40, "é́", "1234", "?!"]
    text = "".join(rnd.choice(words) + rnd.choice([" ", "  ", "\n", "\t "]) for _ in range(3000))
    glued = text[:2000] + "ab" * 900 + text[2000:4000] + " ".join(["word"] * 400) + text[4000:6000]
    for sample in (text, glued, "q" * 3000, " " * 3000, "é" * 2500):
        counter = token_count.Counter(model, huge=200, chunk=256, overlap=16)
        want = len(model.encode(sample, add_special_tokens=False).ids)
        assert counter.count([sample]) == [want]
    counter = token_count.Counter(model, huge=200, chunk=256, overlap=16)
    counter.count([glued])
    assert counter.widened > 0  # the glued runs have no boundary in a first overlap


def test_cache_turnover_keeps_counts(model, monkeypatch):
    monkeypatch.setattr(token_count, "CACHE_PIECES", 50)
    counter = token_count.Counter(model)
    for _ in range(3):
        texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(4)]
        assert counter.count(texts) == [len(model.encode(t, add_special_tokens=False).ids) for t in texts]


def test_token_count_query_rows(docs_of):
    docs = docs_of([(1, None), (2, "é b"), (2, "é b"), (3, "w " * 2049)]).withColumnRenamed("lang", "n_tokens")
    rows = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_count.token_counts(docs).collect())
    assert rows == [(1, 0, 0, False), (2, 4, 2, False), (2, 4, 2, False), (3, 4098, 2049, True)]
