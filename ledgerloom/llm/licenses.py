"""Licence statements in texts, by a positional index of rare words.

How rare a licence word is follows from the documents: one pass counts in how many each
occurs. Each template is posted under its rarest words with their places. A file's rare
words are looked up, and postings that agree on where the template would begin are
intersected; where enough of them meet, the template's mandatory phrases are verified word
by word. Single phrases are templates of their own that must stand in full.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that a template is posted under, the rarest first.
POSTED = 6
#: Share of a template's posted words that have to agree on its place, and how far they may be off.
LEAST_SHARE, SLACK = 0.6, 2

# Phrases and labels of the base report.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Opening sentences by which licences are known, with mandatory phrases.
TEMPLATES = {
    "apache-2.0": ("licensed under the apache license version 2.0", ["apache license", "version 2 0"]),
    "mit": ("released under the mit license", ["mit license"]),
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        ["permission is hereby granted", "free of charge"],
    ),
    "gpl-3.0": (
        "this work is licensed under the gnu general public license version 3",
        ["gnu general public license", "version 3"],
    ),
    "gpl-2.0": (
        "this work is licensed under the gnu general public license version 2",
        ["gnu general public license", "version 2"],
    ),
    "lgpl": ("gnu lesser general public license", ["gnu lesser general public license"]),
    "agpl": ("gnu affero general public license", ["gnu affero general public license"]),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted",
        ["redistribution and use in source and binary forms"],
    ),
    "mpl-2.0": ("subject to the terms of the mozilla public license v 2.0", ["mozilla public license"]),
    "cc-by-4.0": ("licensed under cc by 4.0", ["cc by 4 0"]),
    "cc-by-sa-4.0": ("licensed under cc by sa 4.0", ["cc by sa 4 0"]),
    "cc-by-nc-4.0": ("licensed under cc by nc 4.0", ["cc by nc 4 0"]),
    "cc0": ("cc0 1.0 universal public domain dedication", ["cc0 1 0"]),
    "unlicense": ("this is free and unencumbered software released into the public domain", ["unencumbered software"]),
}

#: A-Z in lower case; white space for all that is no ASCII letter or digit and not beyond ASCII.
_FOLD = bytes((b + 32 if 65 <= b < 91 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    mandatory: tuple[tuple[bytes, ...], ...]
    base: bool


def templates() -> list[Template]:
    phrase = lambda t: tuple(words_of(t))
    base = [Template(label, phrase(p), (phrase(p),), True) for p, label in PHRASES.items()]
    return base + [
        Template(label, phrase(t), tuple(map(phrase, must)), False) for label, (t, must) in TEMPLATES.items()
    ]


class Index:
    """Postings from rare words to the templates and places they stand at."""

    def __init__(self, found: list[Template], seen_in: dict[bytes, int], documents: int) -> None:
        self.templates = found
        self.posted: list[int] = []
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        idf = lambda w: math.log((documents + 1) / (seen_in.get(w, 0) + 1))
        for k, template in enumerate(found):
            # the rarest words; of equals the first in the template
            places = sorted(range(len(template.words)), key=lambda i: (-idf(template.words[i]), i))
            # a base phrase has one anchor: every place of it is a place of the phrase
            places = places[: 1 if template.base else POSTED]
            self.posted.append(len(places))
            for i in places:
                self.postings[template.words[i]].append((k, i))

    def scan(self, words: list[bytes]) -> tuple[list[int], set[str], set[str], float]:
        """Starts of base phrases, base labels, the method's labels, and a score."""
        starts: list[int] = []
        base: set[str] = set()
        labels: set[str] = set()
        score = 0.0
        postings = self.postings
        votes: dict[int, Counter] = defaultdict(Counter)
        for at, word in enumerate(words):
            if word in postings:
                for k, i in postings[word]:
                    template, begin = self.templates[k], at - i
                    if not template.base:
                        votes[k][begin] += 1
                    elif begin >= 0 and tuple(words[begin : begin + len(template.words)]) == template.words:
                        starts.append(begin)
                        base.add(template.label)
                        score = 1.0
        for k, counts in votes.items():
            for begin, n in counts.items():
                near = sum(counts[begin + d] for d in range(-SLACK, SLACK + 1) if d) + n
                share = min(1.0, near / self.posted[k])
                if share >= LEAST_SHARE and self._verified(words, self.templates[k], begin):
                    labels.add(self.templates[k].label)
                    score = max(score, share)
        return starts, base, labels, score

    @staticmethod
    def _verified(words: list[bytes], template: Template, begin: int) -> bool:
        window = words[max(0, begin - SLACK) : max(0, begin + len(template.words) + SLACK)]
        return all(
            any(tuple(window[i : i + len(p)]) == p for i in range(len(window) - len(p) + 1)) for p in template.mandatory
        )


def _counted(vocabulary: frozenset[bytes]):
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for part in parts:
            for text in part.column(0).to_pylist():
                seen.update(vocabulary.intersection(words_of(text)))
                seen[b""] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"]
        )

    return work


def index_of(docs: DataFrame) -> Index:
    """The index with word counts over all of ``docs``; a task sends one row for each template word at most."""
    found = templates()
    vocabulary = frozenset(w for t in found for w in t.words)
    counts = docs.select("text").mapInArrow(_counted(vocabulary), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    seen = {r["word"].encode(): r["n"] for r in counts.collect()}  # at most the words of the templates
    return Index(found, seen, seen.get(b"", 0))


def _scanned(index: Index):
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for text in part.column(1).to_pylist():
                words = words_of(text)
                starts, base, labels, score = index.scan(words)
                rows.append(
                    (
                        len(words),
                        len(starts),
                        min(starts, default=None),
                        max(starts, default=None),
                        ",".join(sorted(base)),
                        ",".join(sorted(base | labels)),
                        score,
                    )
                )
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [
                pa.array([], k) for k in kinds
            ]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], [str(i) for i in range(8)])

    return work


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: words, places of the base phrases, labels and a score.

    ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and ``last_word`` (their
    smallest and largest start in words from 0, else null), ``base_labels`` and ``labels``
    (distinct, sorted, joined by commas; empty without any), ``score`` (1 for a base phrase,
    else the largest share of a verified template's rare words in place). Words are lower-case ASCII letters and digits
    and characters beyond ASCII. A null text is empty. Null and repeated ids, and other
    columns, change nothing.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(
        _scanned(index_of(docs)),
        "doc_id long, n_words long, n_base long, first_word long, last_word long,"
        " base_labels string, labels string, score double",
    )
