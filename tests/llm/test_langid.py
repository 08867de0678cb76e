from __future__ import annotations

import random

import numpy as np
import pytest

from ledgerloom.llm import langid
from tests.llm.fixtures import DOCS, empty, odd_table


def text_of(lang: str, seed: int, words: int = 60) -> str:
    draw = random.Random(seed)
    parts = {"aa": ["tor", "ben", "lum", "é"], "bb": ["shi", "ka", "no", "ü"], "cc": ["xx", "qu", "zz", "y"]}[lang]
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="module")
def table():
    return [(i, text_of(lang, i), lang, "s", 1) for i, lang in enumerate(["aa", "bb", "cc"] * 60)]


def test_gradients_are_those_of_differences():
    draw = np.random.default_rng(0)
    net = langid.Network.fresh(["a", "b"], seed=1)
    for name in ("inputs", "gates", "states"):
        setattr(net, name, [w.astype(np.float64) for w in getattr(net, name)])
    net.output = net.output.astype(np.float64)
    data, labels, mask = draw.integers(97, 103, (6, 4)), np.array([0, 1, 1, 0]), np.ones((6, 4))

    def loss():
        return -np.log(net.positions(data)[:, labels, np.arange(4)]).mean()

    grads = net.gradients(data, labels, mask)
    for weight, grad in zip(net.weights(), grads, strict=True):
        for at in [np.unravel_index(np.abs(grad).argmax(), grad.shape)]:
            kept, step = weight[at], 1e-2
            weight[at] = kept + step
            up = loss()
            weight[at] = kept - step
            down = loss()
            weight[at] = kept
            assert abs((up - down) / (2 * step) - grad[at]) < 0.05 * abs(grad[at]) + 2e-3


def test_held_out_accuracy(spark, table):
    docs = spark.createDataFrame(table + [(1000, None, "aa", "s", 1), (1001, "12 !?", "aa", "s", 1), (1002, "", None, "s", 1)], DOCS)
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert len(got) == len(table) + 3
    assert all(tuple(got[i])[2:] == ("und", 0.0) for i in (1000, 1001, 1002))
    held = [(i, lang) for i, _, lang, *_ in table if got[i].held_out]
    assert 20 < len(held) < 80
    assert np.mean([got[i].lang_pred == lang for i, lang in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_whole_texts_count_and_windows_do_not_matter(table):
    net = langid.fit([(lang, text) for _, text, lang, *_ in table])
    long = langid.folded(text_of("aa", 5, 20) + " " + text_of("bb", 6, 8000))
    assert net.languages[int(langid.pooled(net, [b"", long])[1].argmax())] == "bb"
    several = langid.pooled(net, [langid.folded(t) for _, t, *_ in table[:50]])
    alone = np.concatenate([langid.pooled(net, [langid.folded(t)]) for _, t, *_ in table[:50]])
    assert np.allclose(several, alone, atol=1e-5) and np.allclose(several.sum(axis=1), 1, atol=1e-4)


def test_odd_rows(spark):
    assert len(langid.identify(odd_table(spark)).collect()) == 6
    assert langid.identify(empty(spark)).collect() == []
    unlabelled = spark.createDataFrame([(1, "some text", None, "s", 1)], DOCS)
    assert tuple(langid.identify(unlabelled).first())[2:] == ("und", 0.0)


def test_samples_are_bounded_whatever_the_ids_and_languages(spark):
    rows = [(i, f"text {i}", f"l{i % 250}", "s", 1) for i in range(2000)] + [(4, f"again {i}", "l4", "s", 1) for i in range(500)]
    docs = spark.createDataFrame(rows, DOCS)
    got = langid.sample_of(docs, per_language=3)
    assert len({lang for lang, _ in got}) == 250 and len(got) <= 750
    assert [t for lang, t in got if lang == "l4" and not t.startswith("text")] in ([], ["again 0"])
    few = langid.sample_of(docs, per_language=3, most=300)
    assert len(few) == 250 and len({lang for lang, _ in few}) == 250
    assert len(langid.sample_of(docs, most=40)) == 40


def test_learning_starts_no_python_on_executors(spark, monkeypatch):
    """Rows that the driver hands over are made in Python workers, which then stay beside those of the prediction."""
    rows = [(i, f"text {i}", lang) for i in range(40) for lang in ("aa", "bb")]
    table = spark.createDataFrame([*rows, *rows[:4], (None, "none", "aa"), (7, None, "aa"), (7, "none", None)], "doc_id long, text string, lang string").persist()
    table.count()
    monkeypatch.setattr(type(spark), "createDataFrame", None)
    found = langid.sample_of(table, per_language=8, most=10)
    assert len(found) == 10 and {lang for lang, _ in found} == {"aa", "bb"}
    assert not any(t == "none" for _, t in found)
    table.unpersist()
