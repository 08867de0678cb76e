"""Benchmark items inside documents: size-partitioned MinHash containment search.

Items are grouped by the size of their shingle set, and each group has sketches of its own
length: the smallest hash values of an item, one more than an item at the threshold may
lack. An item that is contained far enough thus shares at least one sketch value with the
document, however long that is. A document's shingles are looked up in the postings of all
sketches; items whose sketch is present in a fitting share are verified on exact shingles.

The benchmark is the query set: it is read in blocks of a fixed number of items, so that
what a task holds does not grow with it. Documents are not shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import ALPHANUMERIC, batches, shingle_hashes, word_hashes

SHINGLE = 5
#: Percent of an item's shingles that a document must hold.
PERCENT = 80
#: Items that are searched for in one pass over the documents.
ITEMS_A_PASS = 20_000
#: Bounds of the size groups, in shingles, grow by this factor.
SIZE_STEP = 1.5

_SEPARATORS = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words: runs of ASCII letters and digits and of all characters beyond ASCII."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_SEPARATORS).split()


def shingles_of(words: list[bytes]) -> set[tuple[bytes, ...]]:
    size = min(SHINGLE, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()


def allowed_misses(size: int, percent: int) -> int:
    return size * (100 - percent) // 100


class Sketches:
    """Postings from sketch values to items, in size groups."""

    def __init__(self, items: list[tuple[int | None, str | None]], percent: int) -> None:
        self.percent, self.ids, self.sets, self.needed = percent, [], [], []
        values: list[np.ndarray] = []
        for item, text in items:
            words = words_of(text)
            if not words:
                continue  # nothing to find
            found = shingles_of(words)
            # the upper bound of the size group gives the sketch length that all its items share
            bound = 1.0
            while bound < len(found):
                bound *= SIZE_STEP
            length = allowed_misses(int(bound), percent) + 1
            hashes, _ = word_hashes([b" ".join(words)], ALPHANUMERIC)
            sketch = np.unique(shingle_hashes(hashes, SHINGLE))[:length]
            # a document at the threshold lacks so many of the sketch at most
            self.needed.append(max(1, len(sketch) - allowed_misses(len(found), percent)))
            self.ids.append(item)
            self.sets.append(found)
            values.append(sketch)
        flat = np.concatenate(values) if values else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(values)), [len(v) for v in values])
        order = np.argsort(flat, kind="stable")
        self.values, self.owners = flat[order], owner[order]
        #: A filter of the low 20 bits spares most searches.
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.values & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def candidates(self, shingles: np.ndarray) -> list[int]:
        """Items of which enough sketch values are among a document's shingles."""
        maybe = shingles[self.filter[(shingles & np.uint64((1 << 20) - 1)).astype(np.int64)]]
        if not len(maybe):
            return []
        maybe = np.unique(maybe)
        low = np.searchsorted(self.values, maybe, "left")
        high = np.searchsorted(self.values, maybe, "right")
        hits = Counter(int(o) for a, b in zip(low, high, strict=True) for o in self.owners[a:b])
        return sorted(i for i, n in hits.items() if n >= self.needed[i])

    def found_in(self, text: str, shingles: np.ndarray) -> Iterator[tuple[int | None, int, int]]:
        """Item id, its shingles, and those of them that the text holds."""
        candidates = self.candidates(shingles)
        if candidates:
            words = words_of(text)
            for i in candidates:
                own = self.sets[i]
                size = len(next(iter(own)))
                held = len(own.intersection(tuple(words[j : j + size]) for j in range(len(words) - size + 1)))
                if 100 * held >= self.percent * len(own):
                    yield self.ids[i], len(own), held


def _search(items: list[tuple[int | None, str | None]], percent: int):
    short = sorted({len(w) for _, t in items if 0 < len(w := words_of(t)) < SHINGLE})

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches = Sketches(items, percent)
        for part in parts:
            ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            lowered = [(t or "").lower() for t in texts]
            rows: list[tuple] = []
            at = 0
            for batch in batches(lowered):
                hashes, firsts = word_hashes(batch, ALPHANUMERIC)
                for k in range(len(batch)):
                    words = hashes[firsts[k] : firsts[k + 1]]
                    # items shorter than a shingle are looked for in runs of their own length
                    runs = [shingle_hashes(words, n) for n in (*short, SHINGLE) if len(words) >= n]
                    if runs:
                        shingles = np.concatenate(runs) if short else runs[0]
                        rows += [(ids[at], *hit) for hit in sketches.found_in(lowered[at], shingles)]
                    at += 1
            columns = zip(*rows, strict=True) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64()) for c in columns], ["doc_id", "item_id", "item_shingles", "found"]
            )

    return work


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """A row for each document and item it holds: ``doc_id``, ``item_id``, ``item_shingles``, ``found``, ``containment``.

    A document holds an item if at least ``percent`` of the item's distinct shingles of
    five words occur in it. Words are lower-case runs of ASCII letters and digits and of
    characters beyond ASCII. An item with fewer words is one shingle of them all; items without
    words, and null texts, are never found. Null ids stay null; repeated rows on either side
    give repeated rows. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null")
    kind = "doc_id long, item_id long, item_shingles long, found long"
    found = None
    rows = items.toLocalIterator()
    while True:
        block = [tuple(row) for _, row in zip(range(ITEMS_A_PASS), rows, strict=False)]
        if not block and found is not None:
            break
        part = docs.mapInArrow(_search(block, percent), kind)
        found = part if found is None else found.unionByName(part)
        if len(block) < ITEMS_A_PASS:
            break
    return found.withColumn("containment", F.col("found") / F.col("item_shingles"))
