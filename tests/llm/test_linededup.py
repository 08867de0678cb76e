from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import linededup as L
from tests.llm.fixtures import DOCS, empty, odd_table

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line: str) -> str:
    return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(UP)


def plain(rows: list[tuple], least: int) -> list[tuple]:
    texts = [(i, (t or "").split("\n")) for i, t in rows]
    held = Counter(k for _, lines in texts for k in {key(x) for x in lines} if k)
    out = []
    for i, lines in texts:
        kept = [x for x in lines if not key(x) or held[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def rows() -> list[tuple]:
    draw = random.Random(11)
    common = ["Cookies here", " cookies HERE\t", "ÄRGER über Zeilen", "ärger über Zeilen", "İstanbul", "a\0b", "A\0B ", "\x85x", "x ", ""]
    out = [(i, "\n".join(draw.choice([*common, f"own line {i}", f"of pairs {i // 2}"]) for _ in range(draw.randint(0, 9)))) for i in range(120)]
    out += [(500 + i, "same text\nhere\r\nCookies here") for i in range(40)]  # copies
    out += [(900, None), (901, ""), (902, "\n\n"), (None, "Cookies here\nnull id"), (None, None), (5, "again"), (5, "again")]
    out += [(903, "\n".join(f"long {j % 7000}" for j in range(60_000))), (904, "z" * 400_000)]
    return out + [(1000 + i, f"nine\nten{'' if i < 9 else 's'}\nEleven") for i in range(11)]


@pytest.mark.parametrize("batches,fan", [(6, 3), (1, 2), (7, 2)])
def test_against_plain_loops(spark, batches, fan):
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows()], DOCS).repartition(4)
    got = L.without_frequent_lines(table, 10, batches, fan)
    want = plain(rows(), 10)
    assert sorted(map(tuple, got.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=str) == want
    assert any(r[2] for r in want) and any(r[3] == "" and r[2] for r in want)


def test_runs_of_arriving_batches(spark):
    runs = L.LineRuns(spark, least=4, fan=2, buckets=3)
    held, sizes = Counter(), []
    for batch in range(7):
        docs = spark.createDataFrame([(i, f"always\nsome {i % 3}\nbatch {batch}\nown {batch} {i}") for i in range(3)], "doc_id long, text string")
        runs.add(L.counted_lines(docs))
        held.update(k for r in docs.collect() for k in set(r.text.split("\n")))
        sizes.append([len(level) for level in runs.levels])
    hashed = {r.h: k for k in held for r in spark.range(1).select(F.xxhash64(F.lit(k)).alias("h")).collect()}
    assert {hashed[r.key] for r in runs.frequent().collect()} == {k for k, n in held.items() if n >= 4}
    assert sizes == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1], [0, 1, 1], [1, 1, 1]]
    # what was known to be frequent was left out of later runs: "always" is in the two merged runs only
    newest = spark.table(runs.levels[0][0])
    assert {hashed[r.key] for r in newest.collect()} == {"batch 6", "own 6 0", "own 6 1", "own 6 2"}
    paths = newest.inputFiles()
    assert len(paths) <= 3
    runs.drop()
    assert runs.levels == [[]]
    with pytest.raises(Exception, match="FILE|exist"):
        spark.read.schema("key long, n long").parquet(*paths).count()
    with pytest.raises(ValueError, match="two runs"):
        L.LineRuns(spark, 10, fan=1)


def test_runs_are_joined_where_they_lie(spark):
    runs = L.LineRuns(spark, least=2, fan=9, buckets=4)
    docs = spark.createDataFrame([(i, f"x\ny {i}") for i in range(5)], "doc_id long, text string")
    runs.add(L.counted_lines(docs))
    fresh = L.counted_lines(docs).repartition(4, "key")
    run = spark.table(runs.levels[0][0]).where("n >= 2").select("key").hint("merge")
    plan = fresh.join(run, "key", "left_anti")._jdf.queryExecution().executedPlan().toString()
    right = plan[plan.index("SortMergeJoin") :].split("FileScan")[1:]
    assert "SelectedBucketsCount: 4 out of 4" in plan or "Bucketed: true" in plan
    assert right
    runs.drop()


def test_odd_and_empty_tables(spark):
    odd = odd_table(spark)
    got = sorted(map(tuple, L.without_frequent_lines(odd, 2, 2).collect()), key=str)
    assert got == plain([(r.doc_id, r.text) for r in odd.collect()], 2)
    assert L.without_frequent_lines(empty(spark)).collect() == []
