from __future__ import annotations

import itertools
from pathlib import Path

import pytest

from ledgerloom.llm import minhash, storage
from ledgerloom.llm.components import components
from tests.llm.fixtures import docs, edited, empty, odd_table, prose, rows  # noqa: F401


def brute(table, words, percent):
    def shingles(text):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
        k = min(words, len(w))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()

    sets = {i: shingles(t) for i, t, *_ in table}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets.items())


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_against_all_pairs(docs, words, percent):  # noqa: F811
    assert sorted(map(tuple, minhash.near_duplicates(docs, words, percent).collect())) == brute(rows(), words, percent)


def test_links_of_members_apart_from_their_leader(spark):
    # copies of a copy share the changes that part them from the first document
    base = prose(1, 150)
    far = edited(base, 77, 0.05)
    table = [(0, base)] + [(i, edited(far if i % 2 else base, i, 0.015)) for i in range(1, 60)]
    got = minhash.near_duplicates(spark.createDataFrame(table, "doc_id long, text string"), 3, 85).collect()
    want = brute(table, 3, 85)
    assert sorted(map(tuple, got)) == want
    assert 1 < sum(kept for *_, kept in want) < 60


def test_odd_rows(spark):
    got = sorted(map(tuple, minhash.near_duplicates(odd_table(spark)).collect()), key=str)
    assert got == sorted(
        [(5, 0, 5, True)] * 2 + [(7, 1, 7, True)] + [(8, 36, 8, True)] * 2 + [(None, 1, None, True)], key=str
    )
    assert minhash.near_duplicates(empty(spark)).collect() == []


def test_nul_is_part_of_a_word(spark):
    got = minhash.near_duplicates(spark.createDataFrame([(1, "a\0b c d"), (2, "a b c d"), (3, "\0 a \0")], "doc_id long, text string"), 3, 85)
    assert sorted((r.doc_id, r.n_shingles) for r in got.collect()) == [(1, 1), (2, 2), (3, 1)]


def test_groups_end_in_the_rounds_before_the_search_for_every_link(spark, monkeypatch):
    # a chain of copies of copies, and a group of near copies: one component each
    texts, seen = [prose(31, 400)], []
    for i in range(1, 40):
        texts.append(edited(texts[-1], i, 0.01))
    texts += [edited(prose(32, 300), i, 0.004) for i in range(60)]
    table = list(enumerate(texts))
    apart = minhash._links_apart_from_leader
    monkeypatch.setattr(minhash, "_links_apart_from_leader", lambda met, percent: seen.append(met.count()) or apart(met, percent))
    got = minhash.near_duplicates(spark.createDataFrame(table, "doc_id long, text string"), 3, 85)
    assert sorted(map(tuple, got.collect())) == brute(table, 3, 85)
    assert sum(seen) < 100


def test_low_thresholds_are_refused(docs):  # noqa: F811
    with pytest.raises(ValueError):
        minhash.near_duplicates(docs, percent=60)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(7, 7), (None, 3)]
    got = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert sorted(map(tuple, got)) == [(i, 0) for i in range(1, 41)] + [(x, 100) for x in range(101, 130)]


def test_wide_steps_go_and_later_rounds_move_the_texts_that_are_left(spark, monkeypatch):
    # twenty groups of near copies, done in the rounds before; one group that goes on
    base = prose(1, 150)
    far = edited(base, 77, 0.05)
    texts = [base, *(edited(far if i % 2 else base, i, 0.015) for i in range(1, 40))]
    texts += [edited(prose(100 + g, 200), i, 0.002) for g in range(20) for i in range(4)]
    table, kept, moved = list(enumerate(texts)), [], []
    write, met = storage.stored_in, minhash._met

    def noted(df, label, *rest):
        got = write(df, label, *rest)
        kept.append((label, got[1]))
        return got

    def counted(pairs, nodes, texts, *rest):
        moved.append((nodes.count(), texts.count()))
        return met(pairs, nodes, texts, *rest)

    monkeypatch.setattr(storage, "stored_in", noted)
    monkeypatch.setattr(minhash, "stored_in", noted)
    monkeypatch.setattr(minhash, "_met", counted)
    got = minhash.near_duplicates(spark.createDataFrame(table, "doc_id long, text string"), 3, 85)
    assert sorted(map(tuple, got.collect())) == brute(table, 3, 85)
    there = [label for label, path in kept if Path(path.removeprefix("file:")).exists()]
    assert not {"signatures", "nodes"} & {*there}
    assert there.count("sketches") == there.count("texts") == 1
    assert moved[0][0] > 60 and all(n <= 40 and t <= 40 for n, t in moved[minhash.ROUNDS :])
