from __future__ import annotations

import re

from ledgerloom.llm import licenses
from tests.llm.fixtures import DOCS, docs, empty, odd_table, prose, rows  # noqa: F401

LINES = [
    "All rights reserved.",
    "all RIGHTS, reserved; all rights reserved",
    "Licensed under CC BY-NC 4.0.",
    "cc\nby and the General-Public License",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the Apache License, Version 2.0.",
    "Released under the MIT License.",
    "apache 2.0 version of a license that is licensed under nothing",
    "rights all reserved. general public éLicense",
]


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = [
        (i, label)
        for phrase, label in licenses.PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    places = [i for i, _ in found]
    return (len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found})))


def test_base_columns_against_brute_force(spark):
    table = rows() + [(1000 + i, prose(i, i) + " " + line + " " + prose(i, 3), "en", "s", 1) for i, line in enumerate(LINES)]
    got = licenses.scan_licenses(spark.createDataFrame(table, DOCS).repartition(3)).collect()
    assert {r.doc_id: tuple(r)[1:6] for r in got} == {i: brute(t) for i, t, *_ in table}
    by_line = {r.doc_id - 1000: r for r in got if r.doc_id >= 1000}
    labels = [by_line[i].labels for i in range(len(LINES))]
    assert labels == ["reserved", "reserved", "cc-by,cc-by-nc-4.0", "cc-by,gpl", "gpl,gpl-3.0", "apache-2.0", "mit", "", ""]
    assert all((r.score > 0) == (r.labels != "") and 0 <= r.score <= 1 for r in got)


def test_odd_rows(spark):
    got = licenses.scan_licenses(odd_table(spark)).collect()
    assert sorted((r.doc_id, r.n_words) for r in got if r.doc_id) == [(5, 0), (5, 0), (7, 2), (8, 40), (8, 40)]
    assert licenses.scan_licenses(empty(spark)).collect() == []
