"""What stored steps and word batches leave on disk and hold in memory."""

import time
import tracemalloc

from ledgerloom.llm import storage, words


def _exchange_files(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = (blocks.apply(i).name() for i in range(blocks.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_a_stored_step_leaves_no_files_of_its_exchanges(spark):
    before, setting = _exchange_files(spark), storage._CLEANUP_SETTING
    rows = spark.range(1000).selectExpr("id", "id % 7 as k")
    kept = storage.stored(rows.repartition(4, "k").groupBy("k").count(), "brief")
    assert {r["k"]: r["count"] for r in kept.collect()} == {k: 143 if k < 6 else 142 for k in range(7)}
    until = time.time() + 20
    while _exchange_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _exchange_files(spark) - before
    assert spark.conf.get(setting, None) is None


def test_a_choice_of_the_session_about_exchanges_stays(spark):
    setting = storage._CLEANUP_SETTING
    spark.conf.set(setting, "false")
    try:
        assert storage.stored(spark.range(3), "own").count() == 3
        assert spark.conf.get(setting) == "false"
    finally:
        spark.conf.unset(setting)


def test_sets_of_many_texts_are_made_in_little_memory():
    texts = [" ".join(f"w{(i * 37 + j * 11) % 5003}" for j in range(300)) for i in range(2000)]
    words._powers.cache_clear()
    tracemalloc.start()
    count = sum(len(s) for s in words.shingle_sets(texts, 5, words.SPACED))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count == sum(len({tuple(w[i : i + 5]) for i in range(296)}) for w in map(str.split, texts))
    assert peak < 32 << 20
