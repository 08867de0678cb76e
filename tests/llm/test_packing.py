from __future__ import annotations

import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import packing
from tests.llm.fixtures import docs, empty, odd_table, rows  # noqa: F401

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def test_cut():
    assert packing.cut(0) == []
    assert packing.cut(2048) == [(0, 2048)]
    assert packing.cut(2049) == [(0, 2048), (2048, 1)]
    found = packing.cut(5000)
    assert sum(n for _, n in found) == 5000 and max(n for s, n in found if s >= 4096) <= 512


@pytest.mark.parametrize("windows", [1, 2, 5, 40])
def test_difference_keeps_all_and_evens_out(windows):
    sizes = np.random.default_rng(windows).integers(1, 500, 40 * windows)
    packed = packing.difference(sizes, windows)
    sums = [int(sizes[w].sum()) for w in packed]
    assert sorted(i for w in packed for i in w) == list(range(len(sizes)))
    assert len(packed) == windows and max(sums) - min(sums) <= 25


def test_round_trip(docs):  # noqa: F811
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(PATH).encode
    got = packing.pack(docs, PATH, with_ids=True).toPandas()
    by_doc = dict(tuple(got.groupby("doc_id")))
    for doc, text, *_ in rows():
        want = [*encode(text or "", add_special_tokens=False).ids, 1]
        own = by_doc[doc].sort_values("start")
        assert [i for ids in own.ids for i in ids] == want
        assert (own.start + own.length).tolist() == [*own.start[1:].tolist(), len(want)]
        assert set(own.doc_tokens) == {len(want)}
    for row in got.itertuples():
        assert row.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
    ordered = got.sort_values(["sequence_id", "offset"])
    filled = ordered.groupby("sequence_id").length
    assert (filled.cumsum() - ordered.length == ordered.offset).all()
    assert filled.sum().max() <= packing.WINDOW
    assert filled.sum().sum() > 0.97 * packing.WINDOW * (filled.ngroups - 1)


def test_words_one_by_one_are_the_text():
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(PATH).encode
    for text in ["It's  a\tTEST, isn't it?!\n\nYes...", "Ünï cödé ΑΣ Σ. x y\x1cz", "a,b .c, ''s 12,345. <|endoftext|> <|endoftext|>,", "é ́a İ,", ",", "...", "日本語, 中文."]:
        ids = np.frombuffer(packing.encode(text, PATH), "<u4").tolist()
        assert ids == [*encode(text, add_special_tokens=False).ids, 1]


def test_many_texts_at_once_and_a_full_memory(monkeypatch):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(PATH).encode
    texts = ["one  two", None, "", "日本語, 中文.", "\u00a0Two\x0bone\u00a0", " x\x1cy ", "a\x85b", "one " * 300, "<|endoftext|>"]
    texts += [f"wort{i} und{i % 7}, {i}" for i in range(200)]
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    monkeypatch.setattr(packing, "AT_ONCE", 500)
    monkeypatch.setattr(packing, "_known", {})
    column = pa.array(["cut off", *texts], pa.string()).slice(1)
    found = []
    for first, rows in packing._slices(column):
        ids, ends = packing.encode_all(column.slice(first, rows), PATH)
        found += [part.tolist() for part in np.split(ids, ends[:-1])]
    assert found == [[*encode(text or "", add_special_tokens=False).ids, 1] for text in texts]
    known = packing._known[PATH]
    assert max(len(known), len(known.older)) <= 20


def test_each_usual_character_is_the_text():
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(PATH).encode
    texts = [f"{c}A{c}b.{c} {c}. x{c}, A{c}!?{c} don't{c}. 1{c}" for c in map(chr, range(0x260))]
    ids, ends = packing.encode_all(pa.array(texts), PATH)
    assert [part.tolist() for part in np.split(ids, ends[:-1])] == [[*encode(text, add_special_tokens=False).ids, 1] for text in texts]


def test_odd_rows(spark):
    got = packing.pack(odd_table(spark), PATH).toPandas()
    assert len(got) == 6 and got.doc_id.isna().sum() == 1
    assert got[got.doc_id == 5].doc_tokens.tolist() == [1, 1]
    assert packing.pack(empty(spark), PATH).collect() == []


def test_a_worker_holds_little_after_its_task():
    # in a process of its own, as workers are; 4,000 texts of 300 words, most words new
    code = f"""
import re
import pyarrow as pa
from ledgerloom.llm import packing
from tests.llm.fixtures import prose

def held():
    return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

def part(i):
    texts = [prose(j, 40) + " " + " ".join(f"q{{(j * 1009 + k) % 700001}}x" for k in range(260)) for j in range(i, i + 1000)]
    return pa.RecordBatch.from_arrays([pa.array(range(i, i + 1000)), pa.array(texts)], ["doc_id", "text"])

for i in range(0, 4000, 1000):
    sum(p.num_rows for p in packing._pieces({PATH!r}, False)(iter([part(i)])))
print(held())
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2])
    assert float(done.stdout) < 190
