"""What each order of quality filters removes, from decision diagrams of failure masks.

Every document gets a mask of the filters it fails. Documents are counted by part and mask,
so the orders are worked out on at most ``2 ** filters`` counts a part, whatever the corpus.
A part's counts become a decision diagram: one level for each filter, a pass and a fail
branch at each node, counts at the leaves, equal nodes shared. Swapping two adjacent levels
in turn leads through all orders, and the path on which everything passes reads off what
each step keeps and removes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.storage import stored

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT = 200, 50, 2
_CAPITALS, _SIGNS = bytes(range(65, 91)), b"#$%&*|"
_WHITE = re.compile(rb"[\x20\x09-\x0D]")
#: Texts are cut at white space after so many bytes, so that only distinct words are held.
_PIECE = 1 << 20

Weights = tuple[int, int, int]


def _pieces(text: bytes) -> Iterator[bytes]:
    start = 0
    while len(text) - start > _PIECE and (cut := _WHITE.search(text, start + _PIECE)):
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


def text_mask(text: bytes, points: int) -> int:
    """Bits 0 to 3: too few words, too few distinct ones, too many capitals, a sign of markup."""
    words, distinct = 0, set()
    for piece in _pieces(text):
        found = piece.split()  # bytes split at ASCII white space
        words += len(found)
        distinct.update(found)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    failed = (
        words < LEAST_WORDS,
        100 * len(distinct) < LEAST_DISTINCT_PERCENT * words,
        100 * capitals > MOST_CAPITALS_PERCENT * points,
        len(text.translate(None, _SIGNS)) < len(text),
    )
    return sum(bit << i for i, bit in enumerate(failed))


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        points = pc.utf8_length(texts).to_pylist()
        raw = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()).to_pylist()
        masks = pa.array(map(text_mask, raw, points), pa.int32())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "part", "digest")), masks], names=["doc_id", "part", "digest", "mask"])


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part and mask of failed filters: ``part, mask, n, good, toxic``.

    Reads ``doc_id, text, source`` of ``docs`` and ``doc_id, quality, toxic`` of ``labels``;
    other columns do not matter. A null text is empty, a null source the part ``''``. Every
    row is a document, also one that repeats another; of rows with equal texts those with
    the smallest id pass the last filter. A null id is smaller than none and has no label.
    An id is good, or toxic, if any of its labels says so. Texts meet as SHA-256 digests.
    """
    bare = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    kind = bare.schema["doc_id"].dataType.simpleString()
    seen = bare.mapInArrow(_masked, f"doc_id {kind}, part string, digest binary, mask int")
    rows = stored(seen, "audit-masks").groupBy("digest", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    # one row of each (text, id): a group of copies is spread by its ids
    named, nameless = rows.where("doc_id is not null"), rows.where("doc_id is null")
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    says = lambda c: F.coalesce(F.max(F.coalesce(F.col(c) == 1, F.lit(False))), F.lit(False)).alias(c)
    tags = labels.where("doc_id is not null").groupBy("doc_id").agg(says("quality"), says("toxic"))
    later = F.when(F.col("first"), 0).otherwise(1 << (len(FILTERS) - 1))
    marked = (
        named.join(first, ["digest", "doc_id"], "left")
        .join(tags, "doc_id", "left")
        .select("part", (F.col("mask") + later).alias("mask"), "n", "quality", "toxic")
        .unionByName(nameless.select("part", "mask", "n"), allowMissingColumns=True)
    )
    share = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return (
        marked.groupBy("part", "mask")
        .agg(F.sum("n").alias("n"), share("quality"), share("toxic"))
        .withColumnRenamed("quality", "good")
        .select("part", "mask", "n", "good", "toxic")
    )


def adjacent_swaps(n: int) -> list[int]:
    """Places ``i``: swapping ``i`` and ``i + 1`` in turn passes once through all ``n!`` orders.

    The last item sweeps to and fro through every order of the others, which make one swap
    of their own between sweeps.
    """
    if n < 2:
        return []
    others, swaps = adjacent_swaps(n - 1), []
    for turn in range(len(others) + 1):
        swaps += range(n - 1) if turn % 2 else range(n - 2, -1, -1)
        swaps += [others[turn] + (1 - turn % 2)] if turn < len(others) else []
    return swaps


class Diagram:
    """The diagram of one part. Nodes are shared, never changed, and know the weight below them."""

    def __init__(self, filters: str, counts: dict[int, Weights]) -> None:
        self.order = list(filters)
        self._ids: dict[tuple, int] = {}
        self.nodes: list[tuple] = []
        self.weights: list[Weights] = []
        level = [self._leaf(counts.get(mask, (0, 0, 0))) for mask in range(1 << len(filters))]
        # bit i of a mask is filter i; the last filter's level is made first
        for i in reversed(range(len(filters))):
            level = [self._node(filters[i], level[m], level[m + (1 << i)]) for m in range(1 << i)]
        self.root = level[0]

    def _shared(self, node: tuple, weight: Weights) -> int:
        if node not in self._ids:
            self._ids[node] = len(self.nodes)
            self.nodes.append(node)
            self.weights.append(weight)
        return self._ids[node]

    def _leaf(self, weight: Weights) -> int:
        return self._shared(("", weight), weight)

    def _node(self, name: str, passed: int, failed: int) -> int:
        below = tuple(a + b for a, b in zip(self.weights[passed], self.weights[failed], strict=True))
        return self._shared((name, passed, failed), below)

    def swap(self, place: int) -> None:
        """Exchange the levels ``place`` and ``place + 1``."""
        done: dict[int, int] = {}

        def turned(node: int, depth: int) -> int:
            if node not in done:
                name, passed, failed = self.nodes[node]
                if depth:
                    done[node] = self._node(name, turned(passed, depth - 1), turned(failed, depth - 1))
                else:
                    (lower, both, second), (_, first, neither) = self.nodes[passed], self.nodes[failed]
                    done[node] = self._node(lower, self._node(name, both, first), self._node(name, second, neither))
            return done[node]

        self.root = turned(self.root, place)
        self.order[place : place + 2] = self.order[place + 1], self.order[place]

    def steps(self) -> Iterator[tuple[str, Weights, Weights]]:
        """Each filter in order with the weights of what it keeps and removes."""
        node = self.root
        for name in self.order:
            _, node, failed = self.nodes[node]
            yield name, self.weights[node], self.weights[failed]


def audit_part(filters: str, counts: dict[int, Weights]) -> list[tuple]:
    """Rows ``filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley`` of all orders."""
    diagram = Diagram(filters, counts)
    failing = {f: sum(w[0] for m, w in counts.items() if m >> i & 1) for i, f in enumerate(filters)}
    alone = {f: counts.get(1 << i, (0, 0, 0))[0] for i, f in enumerate(filters)}
    shapley, rows = dict.fromkeys(filters, 0), []
    for place in [None, *adjacent_swaps(len(filters))]:
        if place is not None:
            diagram.swap(place)
        order = "".join(diagram.order)
        for step, (name, kept, gone) in enumerate(diagram.steps(), 1):
            shapley[name] += gone[0]
            rows.append((order, step, kept[0], gone[0], failing[name] - gone[0], alone[name], gone[1], gone[2]))
    return [(*row, shapley[row[0][row[1] - 1]]) for row in rows]


_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)


def audit_orders(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every order of the filters, step by step, for each part of :func:`failure_masks`.

    The rows of a part are at most ``2 ** len(filters)`` and become one row before any Python
    runs; there are ``len(filters)!`` orders, so keep filters few. No parts give no rows.
    """
    names = SCHEMA.replace(",", "").split()[::2]

    def audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = {c["mask"]: (c["n"], c["good"], c["toxic"]) for c in row["counts"]}
                out = [(row["part"], *r) for r in audit_part(filters, counts)]
                kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * len(_COUNTS)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    return parts.mapInArrow(audited, SCHEMA)


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """:func:`audit_orders` of :func:`failure_masks`: 600 rows a part, zeros included."""
    return audit_orders(failure_masks(docs, labels))


_NONE_OF = " and ".join(f"not (list_contains({{}}, {i + 1}) and fails[{i + 1}])" for i in range(len(FILTERS)))
_ORDERS = ", ".join(f"letters l{i}" for i in range(5))
_APART = " and ".join(f"l{i}.i <> l{j}.i" for i in range(5) for j in range(i))

SQL = rf"""
with rows as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
    from documents
), firsts as (
    select t, min(doc_id) as first_id from rows group by t
), tags as (
    select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id
), marked as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, [
        len(words) < 200,
        100 * len(list_distinct(words)) < 50 * len(words),
        100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t),
        regexp_matches(t, '[#$%&*|]'),
        coalesce(doc_id > first_id, false)] as fails
    from rows join firsts using (t) left join tags using (doc_id)
), counted as (
    select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from marked group by part, fails
), letters as (
    select unnest(['A', 'B', 'C', 'D', 'E']) as l, unnest([1, 2, 3, 4, 5]) as i
), orders as (
    select {" || ".join(f"l{i}.l" for i in range(5))} as filter_order, [{", ".join(f"l{i}.i" for i in range(5))}] as places
    from {_ORDERS} where {_APART}
), steps as (
    select filter_order, step::int as step, places[step] as f, places[1:step - 1] as earlier, places[1:step] as so_far
    from orders, unnest([1, 2, 3, 4, 5]) as s(step)
), audited as (
    select part, filter_order, step, any_value(f) as f,
        coalesce(sum(n) filter ({_NONE_OF.format(*["so_far"] * 5)}), 0) as kept,
        coalesce(sum(n) filter (fails[f] and {_NONE_OF.format(*["earlier"] * 5)}), 0) as removed,
        coalesce(sum(n) filter (fails[f]), 0) as failing,
        coalesce(sum(n) filter (fails[f] and len(list_filter(fails, lambda x: x)) = 1), 0) as unique_fails,
        coalesce(sum(good) filter (fails[f] and {_NONE_OF.format(*["earlier"] * 5)}), 0) as good_lost,
        coalesce(sum(toxic) filter (fails[f] and {_NONE_OF.format(*["earlier"] * 5)}), 0) as toxic_lost
    from counted, steps group by part, filter_order, step
)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, (failing - removed)::bigint as redundant,
    unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
    (sum(removed) over (partition by part, f))::bigint as shapley
from audited
"""
