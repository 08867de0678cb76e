from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm.decontaminate import shingles_of, words_of
from tests.llm.fixtures import DOCS, edited, odd_table
from tests.llm.test_langid import text_of


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    texts = [text_of(lang, i, 40 + i) for i, lang in enumerate(["aa", "bb", "cc"] * 25)]
    texts += [edited(texts[0], i, 0.01) for i in range(9)] + [texts[3]] * 4  # near and exact copies
    items = [(i, text_of("bb", 900 + i, 20)) for i in range(4)]
    texts += [texts[5 + i] + " " + t + " " + texts[6 + i] for i, t in items]
    texts += [f"{text_of('cc', 777, 60)} mail me at some.one@mail.example.com or 10.1.2.3", "12 345 !!", "", None]
    rows = [(i, t, ["aa", "bb", "cc"][i % 3] if i < 75 else None, "s", len(t) if t else None) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def brute(rows, items):
    """Ids that stay after each of the first three stages."""
    spoken = {i: t for i, t in rows if t and any(map(str.isalpha, t))}
    sets = {}
    for i, t in spoken.items():
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
    group = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if a < b and group[a] != group[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    least = min(group[a], group[b])
                    old = {group[a], group[b]}
                    group = {i: least if g in old else g for i, g in group.items()}
                    changed = True
    unique = {i: spoken[i] for i in spoken if group[i] == i}
    clean = {}
    for i, t in unique.items():
        own = shingles_of(words_of(t))
        if not any(100 * len(shingles_of(words_of(x)) & own) >= 80 * len(shingles_of(words_of(x))) for _, x in items):
            clean[i] = t
    return [set(spoken), set(unique), set(clean)]


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = brute(rows, items)
    assert len(want[0]) > len(want[1]) > len(want[2]) > 60
    given, columns = dict(rows), docs.columns
    for (name, stage), ids in zip(corpus_pipeline.STAGES[:3], want, strict=False):
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        assert {r.doc_id: r.text for r in docs.collect()} == {i: given[i] for i in ids}, name
    private = corpus_pipeline.stored(corpus_pipeline.private(spark, docs, sf_dir), "private")
    assert private.columns == columns
    texts = {r.doc_id: r.text for r in private.collect()}
    changed = [i for i in texts if texts[i] != given[i]]
    assert len(changed) == 1 and "some.one@" not in texts[changed[0]] and "10.1.2.3" not in texts[changed[0]]
    assert private.where("n_chars != length(text)").count() == 0
    pieces = corpus_pipeline.packed(spark, private, sf_dir).toPandas()
    assert set(pieces.doc_id) == want[2]
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()
    whole = corpus_pipeline.run(spark, sf_dir).toPandas()
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole[key].values)) == sorted(map(tuple, pieces[key].values))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    odd = odd_table(spark).withColumn("lang", F.lit("en"))
    for docs in (odd, odd.limit(0)):
        got = stage(spark, docs, sf_dir)
        rows = got.collect()
        if name != "packed":
            assert got.columns == docs.columns
            assert len(rows) <= docs.count()


def test_near_copies_of_any_order_leave_one(spark, sf_dir):
    base = text_of("aa", 1, 120).split(" ")
    ids = list(range(12))
    random.Random(2).shuffle(ids)
    rows = [(i, " ".join([*base[: 9 * i], f"new{i}", *base[9 * i + 1 :]] if i % 2 else base), "aa", "s", 1) for i in ids]
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, DOCS), sf_dir).collect()
    assert [r.doc_id for r in got] == [0]


def test_language_stage_with_nothing_or_much_to_learn(spark):
    none = spark.createDataFrame([(1, "some text", None, "s", 9), (2, "12 !?", None, "s", 5), (3, None, None, "s", None)], DOCS)
    assert [r.doc_id for r in corpus_pipeline.language(spark, none, "").collect()] == [1]
    many = [f"l{k:02d}" for k in range(24)]
    rows = [(i, text_of("aa", 7, 3) + f" {many[i % 24] * 30}", many[i % 24], "s", 1) for i in range(240)]
    kept = corpus_pipeline.language(spark, spark.createDataFrame(rows, DOCS), "").count()
    assert kept > 200  # no text is lost because there are many languages


@pytest.mark.parametrize("stage", [corpus_pipeline.language, corpus_pipeline.near_dedup])
def test_stages_bound_batches_by_their_bytes(spark, sf_dir, stage):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(setting)
    stage(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
    long = spark.range(200).repartition(1).select(F.repeat(F.lit("some words "), 10_000).alias("text"))  # 22 MB

    def size(parts):
        for part in parts:
            yield pa.RecordBatch.from_arrays([pa.array([part.num_rows], pa.int32())], ["n"])

    assert long.mapInArrow(size, "n int").count() >= 4
