from __future__ import annotations

import itertools
import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from facetrank.llm import tokencount, tokenfile
from facetrank.session import scratch_path
from tests.llm.fixtures import documents, odd_texts, prose, tuples

DEFINITION = Path(public_tokenizers.path("word_bpe_49k.json")).read_text("utf-8")
MODEL = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
TOKENIZER = Tokenizer.from_str(DEFINITION)
ENCODER = tokenfile.WordEncoder(DEFINITION)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_ids_of_words_are_ids_of_the_text(text):
    assert np.frombuffer(ENCODER.encode([text.encode()])[0], "<u2").tolist() == ids_of(text)


@pytest.mark.parametrize(
    "text",
    ["<|endoftext|> a<|ENDOFTEXT|>", "don't DON'T. it's,", "İstanbul, ΣΑΣ. é. é É.", "a b c\x85d", "가가."],
)
def test_ids_of_special_texts(text):
    assert np.frombuffer(ENCODER.encode([text.encode()])[0], "<u2").tolist() == ids_of(text)


def test_files_give_back_all_ids(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(80))) for i in range(300)] + odd_texts()
    rng.shuffle(rows)
    path = scratch_path(spark, "tokens")
    tokenfile.write(documents(spark, rows, clashing=True), path, DEFINITION)
    got = tokenfile.digests(spark, path).orderBy("start").collect()
    truth = [(d, [*ids_of(t), 1]) for d, t in rows]
    assert sorted(
        ((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr
    ) == sorted(((d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in truth), key=repr)
    before = 0
    for r in got:
        assert r.start == before
        before += r.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)
    assert sorted(((r.doc_id, list(r.ids)) for r in tokenfile.read(spark, path).collect()), key=repr) == sorted(truth, key=repr)


def test_files_follow_an_order_that_is_given(spark):
    rng = random.Random(9)
    rows = [(i // 3 if i % 50 else None, f"text {i // 3}") for i in range(900)]
    path = scratch_path(spark, "tokens")
    key = F.when(F.col("n") % 90 != 0, F.col("n"))
    numbered = [(i, t, rng.randrange(500)) for i, t in rows]
    docs = spark.createDataFrame(numbered, "doc_id bigint, text string, n bigint")
    tokenfile.write(docs, path, DEFINITION, order=key, words_kept=3)
    got = tokenfile.digests(spark, path).orderBy("start").collect()
    first = lambda x: (x is not None, x or 0)
    expected = sorted(numbered, key=lambda r: (first(r[2] if r[2] % 90 else None), first(r[0])))
    assert [r.doc_id for r in got] == [i for i, _, _ in expected]
    before = 0
    for r in got:
        assert r.start == before
        before += r.n_tokens


def test_short_documents_are_read_alone_and_use_the_dictionary(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, 30)) for i in range(600)]
    path = scratch_path(spark, "tokens")
    tokenfile.write(documents(spark, rows), path, DEFINITION)
    dictionary = spark.read.parquet(f"{path}/dictionary").first()
    assert len(dictionary.dictionary) > 0
    data = bytes(spark.read.parquet(f"{path}/shards").orderBy("bucket", "shard").first().file)
    shard = tokenfile.Shard(data, bytes(dictionary.dictionary))
    texts = dict(rows)
    for i in (shard.count - 1, 0):
        assert shard.ids(i).tolist() == [*ids_of(texts[shard.doc_ids[i]]), 1]
    with pytest.raises(ValueError, match="another dictionary"):
        tokenfile.Shard(data, b"other")


def test_files_of_an_empty_table(spark):
    path = scratch_path(spark, "tokens")
    tokenfile.write(documents(spark, []), path, DEFINITION)
    assert tokenfile.digests(spark, path).count() == 0


def greedy(first, inner, word):
    at, count, pieces = 0, 0, first
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 1
        at, count, pieces = end, count + 1, inner
    return count


def test_automaton_is_greedy_longest_match():
    rng = random.Random(0)
    for _ in range(60):
        pool = ["".join(p) for n in (1, 2, 3, 4) for p in itertools.product("abc", repeat=n)]
        first, inner = set(rng.sample(pool, 12)), set(rng.sample(pool, 12))
        automaton = tokencount.Automaton(first, inner)
        for n in range(7):
            for letters in itertools.product("abc", repeat=n):
                word = "".join(letters)
                assert automaton.count(word) == greedy(first, inner, word), (first, inner, word)


def test_counts_of_texts(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, 40) + " Überraschung naïve 日本 x\u0000y") for i in range(50)] + odd_texts()
    first, inner = tokencount.pieces_of(MODEL)
    truth = []
    for doc_id, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        truth.append((doc_id, len(words), sum(greedy(first, inner, w) for w in words)))
    got = tokencount.token_counts(documents(spark, rows, clashing=True), MODEL)
    assert tuples(got, "doc_id", "n_words", "n_tokens") == sorted(truth, key=repr)
    assert tokencount.token_counts(documents(spark, []), MODEL).count() == 0
