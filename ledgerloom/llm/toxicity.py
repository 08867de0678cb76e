"""Toxic documents by a weighted finite-state grammar over clauses.

Words become symbols: insult (with a learned weight), threat, target, negation, reported
speech, end of clause, colon, other. Five small transducers read these symbols: one marks
the ends of clauses, one opens at an insult or threat, one carries a target to it, one a
negation, one reported speech; composed, they rewrite a clause into matches with a kind.
Texts are scored by their matched clauses, not by single words. What counts as an insult, and how much each kind of match weighs, is learned
from labelled documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled documents of each label that are learned from, spread by hash.
SAMPLE = 3000
#: Stems are prefixes of so many letters; whole words count too.
STEMS = (4, 5, 6, 7)
#: A learned word or stem occurs in so many different toxic documents of the sample at least
#: and in so few others for each of these, at equal numbers of both. Such a share of
#: what is learned may be owed to chance (all words of three documents of either kind are trials).
LEAST_DOCS, MOST_OTHERS, BY_CHANCE = 3, 0.02, 0.1
THRESHOLD = 0.3
_REPEATS = 64

# Everyday words of four languages that the grammar knows.
TARGETS = "you your u ya du dich dir euch ihr tu toi te vous ton ta votre tú usted vosotros ustedes ti te eres".split()
NEGATIONS = "not no never isn't aren't don't nicht kein keine nie pas jamais ne nunca jamás tampoco".split()
REPORTS = "said says wrote called quoted claimed sagte schrieb nannte dit écrit appelé dijo escribió llamó".split()
THREATS = "kill hurt destroy punch töten schlagen vernichten tuer frapper détruire matar golpear destruir".split()

_TOKEN = re.compile(r"[^\W_]+(?:'[^\W_]+)?|[.!?;:\n]+")
OTHER, END, COLON, TARGET, NEGATION, REPORT, THREAT, INSULT = range(8)
#: Kinds of match: an insult or a threat, plain or aimed, negated, reported.
KINDS = tuple(f"{what}{how}" for what in ("insult", "threat") for how in ("", "_aimed", "_negated", "_reported"))
#: Words over which a negation reaches that opens its clause; any other reaches to the clause's end.
REACH = 3


@dataclass
class Lexicon:
    """Learned words and stems with weights, beside the fixed classes."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)

    def weight(self, word: str) -> float:
        found = [self.words.get(word, 0.0)]
        found += [self.stems.get(word[:n], 0.0) for n in STEMS if len(word) > n]
        return max(found)


class Symbols(dict):
    """Tokens to symbols, remembered up to a bound."""

    BOUND = 500_000

    def __init__(self, lexicon: Lexicon) -> None:
        super().__init__()
        self.lexicon = lexicon
        self.fixed = {w: c for c, ws in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)) for w in ws}

    def __missing__(self, token: str) -> int:
        if self.lexicon.weight(token) > 0:
            symbol = INSULT
        elif token in self.fixed:
            symbol = self.fixed[token]
        else:
            symbol = OTHER if token[0].isalnum() else COLON if not token.strip(":\n") and ":" in token else END
        if len(self) < self.BOUND:
            self[token] = symbol
        return symbol


@dataclass(frozen=True)
class Transducer:
    """States are numbers from 0 on, which is the first; a row for each gives (state, mark) by symbol."""

    rows: tuple[tuple[tuple[int, tuple], ...], ...]

    @staticmethod
    def of(step, start) -> Transducer:
        """All states that ``step`` (state and symbol to state and mark) reaches from ``start``."""
        states, rows = [start], []
        for state in states:  # grows while it is read
            row = []
            for symbol in range(INSULT + 1):
                after, mark = step(state, symbol)
                if after not in states:
                    states.append(after)
                row.append((states.index(after), mark))
            rows.append(tuple(row))
        return Transducer(tuple(rows))

    def beside(self, other: Transducer) -> Transducer:
        """The composed machine: both read the same symbols, and their marks are joined."""

        def step(pair, symbol):
            (a, x), (b, y) = self.rows[pair[0]][symbol], other.rows[pair[1]][symbol]
            return (a, b), x + y

        return Transducer.of(step, (0, 0))

    def read(self, symbols: bytes) -> list[tuple]:
        state, marks = 0, []
        for symbol in symbols:
            state, mark = self.rows[state][symbol]
            marks.append(mark)
        return marks


def _clause(state: int, symbol: int):
    """Marks the ends of clauses."""
    return 0, (symbol in (END, COLON),)


def _match(state: int, symbol: int):
    """Marks what opens a match."""
    return 0, ("insult" if symbol == INSULT else "threat" if symbol == THREAT else "",)


def _target(state: bool, symbol: int):
    """Marks words after a target of their clause."""
    return symbol not in (END, COLON) and (state or symbol == TARGET), (state,)


def _report(state: int, symbol: int):
    """Marks words after reported speech; a colon carries it into the clause that is quoted."""
    if symbol == END or symbol == COLON and not state:
        return 0, (False,)
    return int(state or symbol == REPORT), (bool(state),)


#: States of the negation: at the clause's first word, without one, in force to the end; or words since, below these.
_FIRST, _NONE, _FORCE = 100, 101, 102


def _negation(state: int, symbol: int):
    """Marks words under a negation: a few after one that opens the clause ("not one of them ..."), else all that follow."""
    mark = (state == _FORCE or state < _FIRST,)
    if symbol in (END, COLON):
        return _FIRST, mark
    if symbol == NEGATION:
        return 0 if state == _FIRST else _FORCE, mark
    if state == _FORCE:
        return state, mark
    return state + 1 if state < REACH else _NONE, mark


#: Read forwards.
GRAMMAR = (
    Transducer.of(_clause, 0)
    .beside(Transducer.of(_match, 0))
    .beside(Transducer.of(_target, False))
    .beside(Transducer.of(_report, 0))
    .beside(Transducer.of(_negation, _FIRST))
)
#: Read backwards: a target may also follow the match in its clause, and so may "..., she said".
BEHIND = Transducer.of(_target, False).beside(
    Transducer.of(lambda state, symbol: (int(symbol not in (END, COLON) and (state or symbol == REPORT)), (bool(state),)), 0)
)


def clauses(symbols: bytes, tokens: list[str], lexicon: Lexicon) -> Iterator[list[tuple[str, float]]]:
    """For each clause with matches of the grammar their kinds and weights."""
    found: list[tuple[str, float]] = []
    behind = BEHIND.read(symbols[::-1])[::-1]
    for i, (end, what, target, report, negation) in enumerate(GRAMMAR.read(symbols)):
        if what:
            how = "_reported" if report or behind[i][1] else "_negated" if negation else "_aimed" if target or behind[i][0] else ""
            found.append((what + how, lexicon.weight(tokens[i]) if what == "insult" else 1.0))
        elif end and found:
            yield found
            found = []
    if found:
        yield found


def matches(symbols: bytes, tokens: list[str], lexicon: Lexicon) -> Iterator[tuple[str, float]]:
    """Kind and weight of each match of the grammar."""
    for clause in clauses(symbols, tokens, lexicon):
        yield from clause


def features(text: str | None, symbols: Symbols) -> np.ndarray | None:
    """By kind the sums over clauses of the weightiest match, the largest that is neither negated nor reported, and a one; None without a match."""
    tokens = _TOKEN.findall((text or "").lower())
    read = bytes(map(symbols.__getitem__, tokens))
    if INSULT not in read and THREAT not in read:
        return None
    found = np.zeros(len(KINDS) + 2)
    for clause in clauses(read, tokens, symbols.lexicon):
        best: dict[str, float] = {}
        for kind, weight in clause:
            best[kind] = max(best.get(kind, 0.0), weight)
            if kind in ("insult", "insult_aimed"):
                found[-2] = max(found[-2], weight)
        for kind, weight in best.items():
            found[KINDS.index(kind)] += weight
    found[: len(KINDS)] = np.log1p(found[: len(KINDS)])
    found[-1] = 1
    return found


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    none: float  # score of a text without a match

    def score(self, found: np.ndarray | None) -> float:
        if found is None:
            return self.none
        return float(1 / (1 + np.exp(-np.clip(found @ self.weights, -30, 30))))


def _different(texts: list[str]) -> list[set[str]]:
    """Word sets of the texts, without near copies: a text goes if half of its smallest word hashes are those of one kept text."""
    minima = np.empty((len(texts), _REPEATS), np.uint64)
    odd = np.arange(3, 2 * _REPEATS + 3, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    kept: list[set[str]] = []
    for text in texts:
        words = set(_TOKEN.findall(text.lower()))
        if words:
            # a fixed hash, unlike Python's own
            codes = np.array([int.from_bytes(w.encode()[:8].ljust(8, b"\0"), "little") ^ len(w) for w in words], np.uint64)
            own = np.array([(codes * k >> np.uint64(7)).min() for k in odd])
            if not len(kept) or (minima[: len(kept)] == own).sum(axis=1).max() < _REPEATS // 2:
                minima[len(kept)] = own
                kept.append(words)
    return kept


def _chance(hits: int, drawn: int, bad: int, every: int) -> float:
    """How likely ``drawn`` of ``every`` documents, taken blindly, hold ``hits`` of the ``bad`` ones or more."""
    ways = lambda n, k: lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)
    several = range(max(hits, drawn - (every - bad)), min(drawn, bad) + 1)
    return sum(exp(ways(bad, k) + ways(every - bad, drawn - k) - ways(every, drawn)) for k in several)


def learn_lexicon(toxic: list[str], other: list[str]) -> Lexicon:
    """Words and stems that different toxic documents share and others hardly have."""
    bad, good = _different(toxic), [set(_TOKEN.findall(t.lower())) for t in other]
    lexicon = Lexicon()
    if not bad:
        return lexicon
    share = len(bad) / max(1, len(good))

    def weigh(parts, into: dict[str, float]) -> None:
        in_bad, in_good = Counter(), Counter()
        for words, counts in ((bad, in_bad), (good, in_good)):
            for some in words:
                counts.update(parts(some))
        total = in_bad + in_good
        trials = sum(n >= LEAST_DOCS for n in total.values())
        found = {p: n for p, n in in_bad.items() if n >= LEAST_DOCS and in_good[p] * share <= MOST_OTHERS * n}
        chance = {p: _chance(n, total[p], len(bad), len(bad) + len(good)) if good else 0.0 for p, n in found.items()}
        # of all that are no less striking than one that is taken, so large a part at most is owed to chance
        ranked = sorted(chance.values())
        most = max((c for rank, c in enumerate(ranked, 1) if c * trials <= BY_CHANCE * rank), default=-1.0)
        for part, n in found.items():
            if chance[part] <= most:
                # less for what few documents have: the lower end of what they tell
                into[part] = float(np.log((n + 0.5) / (in_good[part] * share + 0.5)) / 3)

    weigh(lambda some: {w for w in some if len(w) > 1}, lexicon.words)
    weigh(lambda some: {w[:n] for w in some for n in STEMS if len(w) > n}, lexicon.stems)
    return lexicon


def fit(toxic: list[str], other: list[str]) -> Model:
    """Lexicon first, then weights of the kinds by logistic regression with a penalty."""
    lexicon = learn_lexicon(toxic, other)
    symbols = Symbols(lexicon)
    rows, labels = [], []
    silent = [0, 0]
    for label, texts in ((1, toxic), (0, other)):
        for text in texts:
            found = features(text, symbols)
            if found is None:
                silent[label] += 1
            else:
                rows.append(found)
                labels.append(label)
    weights = np.zeros(len(KINDS) + 2)
    # where no document says otherwise, what is negated or reported does not count
    weights[: len(KINDS)] = [not kind.endswith(("_negated", "_reported")) for kind in KINDS]
    weights[-2] = 1.0
    weights[-1] = -1.0
    if rows and 0 < sum(labels) < len(labels) + silent[0]:
        # two made-up documents keep it steady where one label has no match at all
        x, y = np.array(rows), np.array(labels, float)
        prior = weights.copy()
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            step = x.T @ (p - y) + 0.5 * (weights - prior)
            curve = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(weights))
            weights = weights - np.linalg.solve(curve, step)
    none = min(0.29, (silent[1] + 0.5) / (sum(silent) + 10))
    return Model(lexicon, weights, float(none))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample_of(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> tuple[list[str], list[str]]:
    """At most ``size`` texts with label 1 and with label 0, not held out, spread by hash.

    One text of each chosen id is fetched, however often the id is repeated.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where(
        ~held_out() & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
    )
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(size)).alias("slot")
    picked = known.groupBy("toxic", slot).agg(F.min("doc_id").alias("doc_id")).select("doc_id", "toxic").collect()
    chosen = docs.sparkSession.createDataFrame(picked, "doc_id long, toxic int")  # at most 2 * size rows
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .where("text is not null")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    pick = lambda label: sorted({r["text"] for r in rows if r["toxic"] == label})
    return pick(1), pick(0)


def _scored(model: Model):
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(model.lexicon)
        for part in parts:
            scores = [model.score(features(t, symbols)) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return work


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Learns from ``labels.toxic`` of documents that are not held out (the CRC-32 of the id as
    text leaves 2 when divided by 4), at most :data:`SAMPLE` of each label, and scores from
    the text alone. Null and empty texts, and texts without a match, get the share of toxic
    documents among sampled ones without a match, below the threshold. Without labelled
    documents the fixed classes alone count. Rows with a null id are not held out. Labels
    other than 0 and 1, and other columns, are ignored.
    """
    model = fit(*sample_of(docs, labels))
    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scored(model), "doc_id long, score double")
    return found.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
