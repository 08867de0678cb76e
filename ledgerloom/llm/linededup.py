"""Lines that many documents share, found with levelled sorted runs of line hashes.

A batch of documents is reduced to its line keys and the number of documents that hold each.
A run is such a table in hash buckets, sorted within each. A new batch goes to the same
buckets, leaves out by merge joins what the runs already know to be frequent, and is added
as a run of its own. When a level holds ``fan`` runs they are added up to one run of the next
level, so a corpus of any number of batches has few runs. In the end every line whose key is
frequent goes, in all documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.storage import removed, stored
from ledgerloom.operators.skew import hot_keys, skew_join
from ledgerloom.sources.workspace import session_folder

_WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_keys(text: Column) -> Column:
    """Hash of each line's key: without ASCII white space at its ends, A-Z in lower case; null for an empty key."""
    bare = F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(_WHITE)))
    # lower() is quick, and right where all characters are ASCII
    ascii_only = lambda line: F.length(line) == F.octet_length(line)
    fold = lambda line: F.when(ascii_only(line), F.lower(line)).otherwise(F.translate(line, _UPPER, _LOWER))
    return F.transform(F.transform(bare, fold), lambda key: F.when(key != "", F.xxhash64(key)))


def _distinct_keys(text: Column) -> Column:
    return F.array_compact(F.array_distinct(line_keys(text)))


def counted_lines(docs: DataFrame, by: dict[str, Column] | None = None) -> DataFrame:
    """``key, n``: in how many rows of ``docs`` each line key occurs; ``by`` names further groups."""
    by = by or {}
    keys = docs.select(*[c.alias(n) for n, c in by.items()], F.explode(_distinct_keys(F.col("text"))).alias("key"))
    return keys.groupBy(*by, "key").agg(F.count(F.lit(1)).alias("n"))


class LineRuns:
    """Sorted runs of ``key, n`` in hash buckets below the shared folder.

    ``least`` documents make a key frequent. ``fan`` runs of a level become one of the next;
    the files of merged runs are removed once their successor is written. ``buckets`` should
    suit the corpus that is to come, as ``spark.sql.shuffle.partitions`` does, its default.
    """

    def __init__(self, spark: SparkSession, least: int, fan: int = 3, buckets: int | None = None) -> None:
        if fan < 2 or least < 1:
            raise ValueError("a level needs two runs, a frequent key one document")
        self.spark, self.least, self.fan = spark, least, fan
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self._folder = session_folder(spark, "llm", f"runs-{uuid.uuid4().hex}")

    def add(self, counted: DataFrame) -> None:
        """Add the keys of a batch, as :func:`counted_lines` gives them."""
        fresh = counted.repartition(self.buckets, "key")
        for run in self._runs():
            frequent = run.where(F.col("n") >= self.least).select("key").hint("merge")
            fresh = fresh.join(frequent, "key", "left_anti")
        self._write(fresh, 0)
        level = 0
        while len(self.levels[level]) >= self.fan:
            merged, self.levels[level] = self.levels[level], []
            self._write(self._summed([self.spark.table(name) for name in merged]), level + 1)
            for name in merged:
                self._drop(name)
            level += 1

    def frequent(self) -> DataFrame:
        """``key, n`` of the frequent keys; ``n`` leaves out batches that came after a key was known."""
        return self._summed(self._runs()).where(F.col("n") >= self.least)

    def drop(self) -> None:
        """Remove all runs."""
        for name in [n for level in self.levels for n in level]:
            self._drop(name)
        self.levels = [[]]

    def _runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def _summed(self, runs: list[DataFrame]) -> DataFrame:
        rows = self.spark.createDataFrame([], "key long, n long")
        for run in runs:
            rows = rows.unionByName(run)
        return rows.repartition(self.buckets, "key").groupBy("key").agg(F.sum("n").alias("n"))

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = rows.select("key", "n").write.format("parquet").bucketBy(self.buckets, "key").sortBy("key")
        writer.option("path", f"{self._folder}/{name}").saveAsTable(name)
        self.levels += [[] for _ in range(level + 1 - len(self.levels))]
        self.levels[level].append(name)

    def _drop(self, name: str) -> None:
        self.spark.sql(f"drop table if exists {name}")
        removed(self.spark, f"{self._folder}/{name}")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop the lines whose key is among the document's frequent ones."""
    for batch in batches:
        n_lines, n_dropped, texts = [], [], []
        for text, keys, frequent in zip(*(batch.column(c).to_pylist() for c in ("text", "keys", "frequent")), strict=True):
            lines = text.split("\n")
            kept = lines
            if frequent:
                gone = set(frequent)
                kept = [line for line, key in zip(lines, keys, strict=True) if key not in gone]
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
            texts.append("\n".join(kept))
        columns = [batch.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_lines", "n_dropped", "text"])


def without_frequent_lines(docs: DataFrame, least: int = 10, batches: int = 6, fan: int = 3) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text``: each document without the lines that ``least`` documents share.

    Reads ``doc_id`` and ``text``; other columns do not matter. Every row is a document, also
    one with a null id or one that repeats another. A null or empty text is one empty line;
    empty keys are never frequent, so empty lines stay. Lines of a long text are hashed in
    the JVM and looked up in a set, so the work is linear in its length. An empty table gives
    no rows. Keys meet as 64-bit hashes: in a corpus with 10**9 frequent keys a rare line is
    lost to a collision once in some 10**10 lines.

    Documents go to ``batches`` batches by hash, all counted in one pass over the texts. A
    line that a third of the documents hold is one row of each task after counting, and is
    cut into slices where documents look up their lines.
    """
    spark = docs.sparkSession
    row = F.xxhash64("doc_id", "text")
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = stored(counted_lines(base, {"batch": F.pmod(row, F.lit(batches)).cast("int")}), "line-counts", ["batch"])
    runs = LineRuns(spark, least, fan)
    for batch in range(batches):
        runs.add(counted.where(F.col("batch") == batch).select("key", "n"))
    frequent = stored(runs.frequent().select("key"), "frequent-lines")
    runs.drop()

    # rows of one hash share their frequent keys; a key of another row that a row does not hold does no harm
    lines = base.select(row.alias("row"), F.explode(_distinct_keys(F.col("text"))).alias("key"))
    found = skew_join(lines, frequent, ["key"], hot_keys(counted, ["key"], "n"), ["row"])
    of_row = found.groupBy("row").agg(F.collect_set("key").alias("frequent"))
    marked = base.withColumn("row", row).join(of_row, "row", "left")
    keys = F.when(F.col("frequent").isNotNull(), line_keys(F.col("text")))
    kind = base.schema["doc_id"].dataType.simpleString()
    return marked.select("doc_id", "text", keys.alias("keys"), "frequent").mapInArrow(
        _without, f"doc_id {kind}, n_lines long, n_dropped long, text string"
    )


SQL = rf"""
with docs as (
    select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
), lines as (
    select r, unnest(lines) as line, unnest(range(1, len(lines) + 1)) as place from docs
), keyed as (
    select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') as key from lines
), frequent as (
    select key from keyed where key <> '' group by key having count(distinct r) >= 10
), kept as (
    select r, string_agg(line, chr(10) order by place) as text, count(*) as n from keyed
    where key not in (select key from frequent) group by r
)
select doc_id, len(lines)::bigint as n_lines, (len(lines) - coalesce(n, 0))::bigint as n_dropped,
    sha256(coalesce(text, '')) as kept_sha256
from docs left join kept using (r)
"""
