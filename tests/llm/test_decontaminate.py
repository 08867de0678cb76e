from __future__ import annotations

from ledgerloom.llm import decontaminate as D
from tests.llm.fixtures import docs, empty, odd_table, prose, rows  # noqa: F401

ITEMS = "item_id long, text string, text_ string"


def test_against_brute_force(spark, docs):  # noqa: F811
    long = prose(902, 20_000).split(" ")
    items = [(i, " ".join(long[50 * i : 50 * i + 9 + i]), "x") for i in range(60)]
    # four fifths of an item, and a little less
    items += [(100, " ".join(long[7000:7024]) + " q w e r t", "x"), (101, " ".join(long[7000:7024]) + " q w e r t y", "x")]
    items += [(200, None, "x"), (201, "", "x"), (202, "One two", "x"), (203, "über", "x"), (None, prose(3, 12), "x"), (5, "one", "x"), (5, "one", "x")]
    got = sorted(map(tuple, D.contaminated(docs, spark.createDataFrame(items, ITEMS)).collect()), key=str)
    want = []
    for doc, text, *_ in rows():
        for item, t, _ in items:
            own = D.shingles_of(D.words_of(t))
            if own:
                words = D.words_of(text)
                k = len(next(iter(own)))
                held = len(own & {tuple(words[i : i + k]) for i in range(len(words) - k + 1)})
                if 100 * held >= 80 * len(own):
                    want.append((doc, item, len(own), held, held / len(own)))
    assert got == sorted(want, key=str)
    assert {r[1] for r in got} >= {0, 59, 100, 202, 203, None, 5} and 101 not in {r[1] for r in got}


def test_blocks_of_items(spark, docs, monkeypatch):  # noqa: F811
    items = spark.createDataFrame([(i, prose(i, 12 + i), "x") for i in range(7)], ITEMS)
    whole = sorted(map(tuple, D.contaminated(docs, items).collect()))
    monkeypatch.setattr(D, "ITEMS_A_PASS", 3)
    assert sorted(map(tuple, D.contaminated(docs, items).collect())) == whole


def test_odd_and_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b", "x")], ITEMS)
    assert [tuple(r) for r in D.contaminated(odd_table(spark), items).collect()] == [(7, 1, 1, 1, 1.0)]
    assert D.contaminated(empty(spark), items).collect() == []
    assert D.contaminated(odd_table(spark), items.limit(0)).collect() == []
