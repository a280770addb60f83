"""Each stage of the corpus pipeline on its own input, and the whole of it."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from facetrank.llm.mixing import mix
from tests.llm.fixtures import documents, prose, tuples

STAGES = dict(corpus_pipeline.STAGES)


def noise(rng, n):
    return " ".join(rng.choice(["###", "@@!!", "|||", "0x0 0x0", "$$ $$"]) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Good prose, noise, near copies and a text made of a benchmark item."""
    rng = random.Random(21)
    item = prose(rng, 60)
    texts = {i: prose(rng, rng.randint(80, 140)) for i in range(120)}
    texts |= {200 + i: noise(rng, rng.randint(60, 120)) for i in range(60)}
    copies = texts[5].split()
    for i in range(300, 306):
        words = list(copies)
        words[i % len(words)] = "changed"
        texts[i] = " ".join(words)
    texts[400] = item + " " + prose(rng, 20)
    texts[401], texts[402] = None, ""
    rows = sorted(texts.items())
    folder = str(tmp_path_factory.mktemp("corpus"))
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    labels = [(i, int(i < 200), 0) for i, _ in rows if i < 260]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    return folder, dict(rows)


def ids(df) -> set:
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_quality_drops_noise_and_keeps_prose(spark, corpus):
    folder, texts = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = STAGES["quality"](spark, docs, folder)
    assert kept.columns == corpus_pipeline.COLUMNS
    assert set(range(120)) <= ids(kept)
    assert not ids(kept) & set(range(200, 260))


def test_near_duplicates_keep_the_first_of_a_group(spark, corpus):
    folder, texts = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 200 or doc_id >= 300")
    kept = STAGES["near_duplicates"](spark, docs, folder)
    assert kept.columns == corpus_pipeline.COLUMNS
    assert ids(docs) - ids(kept) == set(range(300, 306))


def test_decontamination_drops_what_holds_an_item(spark, corpus):
    folder, texts = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = STAGES["decontamination"](spark, docs, folder)
    assert ids(docs) - ids(kept) == {400}


def test_mixing_repeats_as_the_operator_says(spark, corpus):
    folder, texts = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    mixed = STAGES["mixing"](spark, docs, folder)
    assert mixed.columns == corpus_pipeline.COLUMNS
    assert tuples(mixed, "doc_id") == tuples(mix(docs), "doc_id")
    assert {i: t for i, t in tuples(mixed, "doc_id", "text")}.items() <= texts.items()


def test_rows_without_an_id_and_repeated_rows_are_kept_together(spark, corpus):
    folder, _ = corpus
    rows = [(None, "no id"), (None, None), (7, prose(random.Random(1), 90)), (8, None), (8, None)]
    docs = documents(spark, rows, clashing=True)
    for name in ("near_duplicates", "decontamination"):
        kept = STAGES[name](spark, docs, folder)
        assert kept.columns == corpus_pipeline.COLUMNS
        assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _ in rows)
    assert all(STAGES[n](spark, docs.limit(0), folder).count() == 0 for n in ("near_duplicates", "mixing"))


def test_the_whole_is_its_stages_one_after_another(spark, corpus):
    folder, texts = corpus
    got = corpus_pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    assert Counter(r.doc_id for r in got) == Counter(i for (i,) in tuples(docs, "doc_id"))
    # Places follow one another without gaps.
    end = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == end
        end += r.n_tokens
    assert {r.ids_crc32 for r in got if texts[r.doc_id] in (None, "")} <= {
        zlib.crc32((1).to_bytes(4, "little"))
    }


def test_token_files_keep_the_order_of_the_mix(spark, corpus, tmp_path):
    folder, texts = corpus
    rows = [(i, f"text {i}") for i in range(100) for _ in range(8)]
    random.Random(4).shuffle(rows)
    documents(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/mix")
    got = STAGES["token_files"](spark, spark.read.parquet(f"{tmp_path}/mix"), folder)
    assert [r.doc_id for r in got.orderBy("start").collect()] == [i for i, _ in rows]
