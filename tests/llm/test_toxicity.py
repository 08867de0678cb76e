from __future__ import annotations

import random

from ledgerloom.llm import toxicity as X
from tests.llm.fixtures import DOCS, empty, odd_table

BAD = ["grobbelhut", "grobbelig", "snerk", "pfuiwort"]


def table(n: int = 900):
    rows, labels = [], []
    for i in range(n):
        draw = random.Random(i)
        words = [f"{draw.choice('abcdefgh')}{draw.choice('aeiou')}{draw.choice('lmnrst')}{draw.randint(0, 40)}" for _ in range(60)]
        toxic = int(i % 6 == 0)
        for _ in range(toxic * 2):
            words.insert(draw.randint(0, 60), draw.choice(BAD).upper() + ",")
        rows.append((i, " ".join(words) + ".", "en", "s", 1))
        labels.append((i, 1, toxic))
    return rows, labels


def run(spark, rows, labels):
    return X.score_toxicity(
        spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    ).collect()


def test_held_out_documents(spark):
    rows, labels = table()
    extra = [(5001, None, "en", "s", 1), (5002, "", "en", "s", 1), (5003, "You are a snerk!", "en", "s", 1), (5004, "x " * 30_000 + "grobbelhaft", "en", "s", 1)]
    got = {r.doc_id: r for r in run(spark, rows + extra, labels + [(1, 1, None), (None, 1, 1), (9999, 1, 1)])}
    toxic = {i: t for i, _, t in labels}
    held = [r for i, r in got.items() if r.held_out and i in toxic]
    assert len(held) > 150 and all(r.predicted == toxic[r.doc_id] for r in held)
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())
    assert [got[i].predicted for i in (5001, 5002, 5003, 5004)] == [0, 0, 1, 1]


def kinds(text, lexicon):
    tokens = X._TOKEN.findall(text.lower())
    symbols = X.Symbols(lexicon)
    return [k for k, _ in X.matches(bytes(map(symbols.__getitem__, tokens)), tokens, lexicon)]


def test_grammar():
    lexicon = X.Lexicon({"snerk": 1.0})
    assert kinds("such a snerk", lexicon) == ["insult"]
    assert kinds("you are a snerk", lexicon) == ["insult_aimed"]
    assert kinds("you. are a snerk", lexicon) == ["insult"]
    assert kinds("he is not a snerk", lexicon) == ["insult_negated"]
    assert kinds("not one of them was ever a snerk", lexicon) == ["insult"]
    assert kinds("she said he was ever so much a snerk", lexicon) == ["insult_reported"]
    assert kinds("i will hurt you", lexicon) == ["threat_aimed"]
    assert kinds("snerk and snerk; kill", lexicon) == ["insult", "insult", "threat"]


def test_negation_and_report_reach_through_the_clause():
    lexicon = X.Lexicon({"snerk": 1.0})
    assert kinds("i will not kill you", lexicon) == ["threat_negated"]
    assert kinds("he wrote that i will kill you", lexicon) == ["threat_reported"]
    assert kinds("i will kill you, she said", lexicon) == ["threat_reported"]
    assert kinds("she said: you are a snerk. you are a snerk", lexicon) == ["insult_reported", "insult_aimed"]
    assert kinds("she said:\nyou are a snerk", lexicon) == ["insult_reported"]
    assert kinds("no: you are a snerk", lexicon) == ["insult_aimed"]
    assert kinds("he is not by any stretch of the imagination a snerk; a snerk", lexicon) == ["insult_negated", "insult"]
    assert kinds("you are if i may say so a snerk", lexicon) == ["insult_aimed"]


def test_composed_marks_are_those_of_the_parts():
    draw = random.Random(3)
    parts = [X.Transducer.of(f, s) for f, s in ((X._target, False), (X._negation, X._FIRST), (X._report, 0))]
    whole = parts[0].beside(parts[1]).beside(parts[2])
    for _ in range(50):
        symbols = bytes(draw.randint(0, X.INSULT) for _ in range(40))
        alone = [p.read(symbols) for p in parts]
        assert whole.read(symbols) == [a + b + c for a, b, c in zip(*alone, strict=True)]


def test_clauses_add_up_and_denials_do_not():
    model = X.fit([], [])
    score = lambda text: model.score(X.features(text, X.Symbols(model.lexicon)))
    assert score("I will not kill you.") < X.THRESHOLD and score("He wrote that I will kill you.") < X.THRESHOLD
    assert score("kill kill you") == score("kill you") < score("kill you. kill you.")


def test_near_copies_do_not_make_a_lexicon():
    # one document and its many near copies, toxic for another reason
    draw = random.Random(1)
    base = [f"word{draw.randint(0, 999)}" for _ in range(80)]
    copies = [" ".join(base[:k] + [f"new{k}"] + base[k + 1 :]) for k in range(40)]
    other = [" ".join(f"word{draw.randint(1000, 1999)}" for _ in range(80)) for _ in range(300)]
    lexicon = X.learn_lexicon(copies, other)
    assert not any(w in lexicon.words for w in base)


def test_distinct_texts_of_one_vocabulary_all_stay():
    # each text shares minima with many others, but with none of them half of its own
    draw = random.Random(7)
    vocabulary = [f"word{i}" for i in range(600)]
    texts = [" ".join(draw.sample(vocabulary, 60)) for _ in range(X.SAMPLE)]
    assert len(X._different(texts)) == len(texts)
    copy = texts[5].replace(" ", " new ", 1)
    assert len(X._different([*texts[:9], copy])) == 9


def test_odd_rows(spark):
    labels = spark.createDataFrame([(8, 1, 1)], "doc_id long, quality int, toxic int")
    assert len(X.score_toxicity(odd_table(spark), labels).collect()) == 6
    assert len(X.score_toxicity(odd_table(spark), labels.limit(0)).collect()) == 6
    assert X.score_toxicity(empty(spark), labels).collect() == []


def test_chance_is_the_share_of_draws():
    from itertools import combinations

    draws = [sum(x < 4 for x in c) for c in combinations(range(11), 5)]
    for hits in range(6):
        assert abs(X._chance(hits, 5, 4, 11) - sum(d >= hits for d in draws) / len(draws)) < 1e-9


def test_nothing_is_learned_from_labels_that_tell_nothing():
    draw = random.Random(12)
    texts = [" ".join(f"w{draw.randint(0, 4000)}" for _ in range(60)) for _ in range(700)]
    learned = X.learn_lexicon(texts[:120], texts[120:])
    assert len(learned.words) + len(learned.stems) <= 1
    insulting = [t + " snerk" if i % 2 else t + " grobbelig" for i, t in enumerate(texts[:120])]
    learned = X.learn_lexicon(insulting, texts[120:])
    assert {"snerk", "grobbelig"} <= set(learned.words) and len(learned.words) <= 3


def test_one_text_of_an_id_that_is_repeated(spark):
    docs = spark.createDataFrame([(1, f"t{i}", "en", "s", 1) for i in range(50)] + [(4, "x", "en", "s", 1)], DOCS)
    tags = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    assert X.sample_of(docs, tags) == (["t0"], ["t0", "x"])
