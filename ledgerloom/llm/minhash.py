"""Near-duplicate documents: MinHash bands, checked signatures, exact sets, star components.

Documents with equal shingle sets form a class, and one of them stands for it from then on.
Classes that share a band bucket are candidates. A bucket never becomes all its pairs: its
members are compared with a leader, the one that shares most buckets with others, as the
origin of a group of copies does. Two members linked to the leader are in one component.
Links of a member that is not linked to it are found by what it has and lacks against the
leader: such links need shared differences, which an index of prefixes finds exactly.
Members far from the leader go on with further leaders until none are left. All this is
for buckets whose members are not in one component yet: a few rounds of one leader a bucket
come first.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.storage import removed, stored, stored_in
from ledgerloom.llm.words import SPACED, mix, shingle_sets

#: Minima of a band, and bands: a pair of similarity 0.8 shares no bucket once in 300,000 pairs.
ROWS, BANDS = 5, 32
#: A signature may fall short of the threshold by so much (over six deviations) before sets are compared.
SLACK = 0.2
#: Members from this similarity to the leader on are done after one comparison (``_NEAR``).
#: As 1 - similarity is a metric, all their links are to members from ``_APART`` on.
_NEAR, _APART = 0.75, 0.55
#: Members of a bucket that all its others meet in one further round.
FEW = 16
#: Rounds that look for components before the search for every link.
ROUNDS = 2
_SALT = np.uint64(0xD6E8FEB86659FD93)
_SEEDS = np.random.default_rng(7919).integers(1, 1 << 62, (2, ROWS * BANDS), dtype=np.uint64)
_FACTORS, _SHIFTS = _SEEDS[0] * np.uint64(2) + np.uint64(1), _SEEDS[1]
_BAND_SALTS = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def minima(shingles: np.ndarray) -> np.ndarray:
    """For each universal hash function ``x * factor + shift`` its smallest value over the set."""
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 256):
        np.minimum(least, (shingles[i : i + 256, None] * _FACTORS + _SHIFTS).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    key = _BAND_SALTS.copy()
    for column in least.reshape(BANDS, ROWS).T:
        key = mix(key * _SALT + column)
    return key.view(np.int64)


def _signatures(words: int, table: np.ndarray):
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes, low, high, bands, sketches = [], [], [], [], []
            for found in shingle_sets(part.column(1).to_pylist(), words, table):
                sizes.append(len(found))
                low.append(int(mix(found).sum(dtype=np.uint64).astype(np.int64)))
                high.append(int(mix(found ^ _SALT).sum(dtype=np.uint64).astype(np.int64)))
                if len(found):
                    least = minima(found)
                    bands.append(band_keys(least))
                    sketches.append((least >> np.uint64(56)).astype(np.uint8).tobytes())
                else:
                    bands.append(None)
                    sketches.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(low, pa.int64()),
                    pa.array(high, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                ["doc_id", "n_shingles", "low", "high", "bands", "sketch"],
            )

    return work


def signatures(docs: DataFrame, words: int = 5, table: np.ndarray = SPACED) -> DataFrame:
    """A row per row of ``docs`` (``doc_id`` long, ``text``): size, class, band keys and sketch of its set."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _signatures(words, table),
        "doc_id long, n_shingles long, low long, high long, bands array<long>, sketch binary",
    )


def _alike(least: float):
    """Pairs whose sketches agree in a share of ``least`` of all places."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                a, b = (
                    np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                    for i in (2, 3)
                )
                yield part.select([0, 1]).filter(pa.array((a == b).mean(axis=1) >= least))

    return work


def _compared(words: int, table: np.ndarray, percent: int, least: float):
    """Documents against their leader on full sets, with what they lack and have beyond it.

    Of a pair with similarity from ``least`` on, one row: whether it is ``near``, whether it
    is ``linked``, the leader's size, the weight ``100 * lacking + percent * added`` and the
    differing shingles, added before lacking, each by hash.
    """

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for part in parts:
            rows = []
            # Rows come sorted by leader, so that its set is made once.
            for node, leader, text, model in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                if leader != last:
                    last, held = leader, next(shingle_sets([model], words, table))
                own = next(shingle_sets([text], words, table))
                added = np.setdiff1d(own, held, assume_unique=True)
                lacking = np.setdiff1d(held, own, assume_unique=True)
                both, union = len(own) - len(added), len(held) + len(added)
                if both < least * union:
                    continue
                weight = 100 * len(lacking) + percent * len(added)
                rows.append(
                    (
                        node,
                        leader,
                        both >= _NEAR * union,
                        100 * both >= percent * union,
                        len(held),
                        weight,
                        np.concatenate([added, lacking]).view(np.int64),
                    )
                )
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["node", "leader", "near", "linked", "size", "weight", "diff"],
            )

    return work


def _met(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, table, percent: int, least: float = _APART) -> DataFrame:
    """The ``pairs`` (node, leader) compared: by size, then by signature, then on full sets, from similarity ``least`` on."""
    side = lambda x, n: nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n{n}"), F.col("sketch").alias(f"s{n}"))
    maybe = (
        pairs.join(side("node", 1), "node")
        .join(side("leader", 2), "leader")
        .where(F.least("n1", "n2") >= F.greatest("n1", "n2") * least)
        .select("node", "leader", "s1", "s2")
        .mapInArrow(_alike(least - SLACK), "node long, leader long")
    )
    return (
        maybe.join(texts, "node")
        .join(texts.select(F.col("node").alias("leader"), F.col("text").alias("model")), "leader")
        .select("node", "leader", "text", "model")
        .mapInArrow(
            _compared(words, table, percent, least),
            "node long, leader long, near boolean, linked boolean, size long, weight long, diff array<long>",
        )
    )


def _links_apart_from_leader(met: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of one leader, at least one of which is not linked to it.

    With the leader's size n, and lacking and added shingles of two members counted in their
    weights w, the pair is linked exactly if (100 + percent) * shared differences
    >= w1 + w2 - (100 - percent) * n =: need. A member that is not linked to the leader has
    a positive excess = w1 - (100 - percent) * n, so its partner shares more than
    w2 / (100 + percent) differences with it, and it shares excess / 100 at least with any
    partner. In one common order of shingles the first shared one therefore lies in the
    first part of both, and what follows it on either side bounds how many are shared.
    Pairs without a ``far`` member have been looked at before and are left out, and so are
    pairs of one component (``root``): one of the two is outside of the leader's, then, and
    only such members look for partners. A leader whose members are all in its component,
    as in most groups of near copies, has no rows here at all.
    """
    both = 100 + percent
    outside = F.col("root") != F.col("leader_root")
    several = met.groupBy("leader").agg(F.max(outside).alias("any"), F.max("far").alias("far")).where("any and far")
    excess = F.col("weight") - F.col("size") * (100 - percent)
    of = (
        met.join(several.select("leader"), "leader")
        .withColumn("length", F.size("diff"))
        .withColumn("apart", F.greatest(F.ceil(excess / 100), F.lit(1)))
    )
    shared = F.greatest(F.floor(F.col("weight") / both) + 1, F.col("apart"))
    first = lambda least: F.slice("diff", F.lit(1), F.greatest(F.lit(0), F.col("length") - least + 1).cast("int"))
    index = of.select(
        F.col("leader"),
        F.col("node").alias("b"),
        F.col("root").alias("b_root"),
        F.col("far").alias("b_far"),
        F.col("weight").alias("w2"),
        F.col("length").alias("l2"),
        F.posexplode(first(shared)).alias("j", "e"),
    )
    probe = of.where(outside).select(
        F.col("leader"),
        "leader_root",
        F.col("node").alias("a"),
        F.col("root").alias("a_root"),
        F.col("far").alias("a_far"),
        excess.alias("x1"),
        F.col("length").alias("l1"),
        F.posexplode(first(F.col("apart"))).alias("i", "e"),
    )
    need = F.col("x1") + F.col("w2")
    maybe = (
        probe.join(index, ["leader", "e"])
        .where((F.col("a_root") != F.col("b_root")) & ((F.col("b_root") == F.col("leader_root")) | (F.col("b") < F.col("a"))) & (F.col("a_far") | F.col("b_far")))
        .where(need <= F.least(F.col("l1") - F.col("i"), F.col("l2") - F.col("j")) * both)
        .select("leader", "a", "b", need.alias("need"))
        .distinct()
    )
    side = lambda x, d: of.select("leader", F.col("node").alias(x), F.col("diff").alias(d))
    return (
        maybe.join(side("a", "d1"), ["leader", "a"])
        .join(side("b", "d2"), ["leader", "b"])
        .where(F.size(F.array_intersect("d1", "d2")) * both >= F.col("need"))
        .select("a", "b")
    )


def _gathered(live: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, table, percent: int) -> tuple[DataFrame, DataFrame]:
    """Members of buckets that hold several components, and the components (node, root), after some cheap rounds.

    In each round the members of a bucket that are not in its leader's component are compared
    with the leader, and that is all: as many comparisons as members at most. Leaders follow
    one order of all nodes a round, so that a node meets few: first by what they share with
    others (``rank``), then by hashes. What is asked for are
    components, so a bucket whose members are all in one is done, whatever links are
    left in it; that is where groups of near copies end.
    """
    roots = live.select("node", F.col("node").alias("root")).limit(0)
    live = live.withColumn("root", F.col("node"))
    for turn in range(ROUNDS):
        order = F.xxhash64("node", F.lit(turn)) if turn else F.col("rank")
        first = F.min(F.struct(order, F.col("node"), F.col("root"))).alias("l")
        leaders = live.groupBy("bucket").agg(first).select("bucket", F.col("l.node").alias("leader"), F.col("l.root").alias("leader_root"))
        pairs = live.join(leaders, "bucket").where("root != leader_root").select("node", "leader").distinct()
        met = stored(_met(pairs, nodes, texts, words, table, percent, percent / 100).where("linked").select("node", "leader"), "met")
        if met.isEmpty():
            continue
        links = met.unionByName(roots.select("node", F.col("root").alias("leader")))
        roots = components(links, "node", "leader", "gathered")
        rooted = live.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        several = rooted.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("bucket")
        live = stored(rooted.join(several, "bucket").select("bucket", "node", "rank", "root"), "buckets")
        if live.isEmpty():
            break
    return live, roots


def _of(live: DataFrame, rows: DataFrame) -> DataFrame:
    """The ``rows`` of nodes that are in ``live`` buckets."""
    return rows.join(live.select("node").distinct(), "node")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, table: np.ndarray = SPACED) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Two documents are linked if 100 * |A & B| >= ``percent`` * |A | B| for their sets of
    distinct ``words``-word shingles (of the whole word sequence where it is shorter). The
    component is named by its smallest ``doc_id``, whose row is kept. Null or empty texts
    have empty sets and are linked with nothing. Rows with a null ``doc_id`` are linked with
    nothing and kept, with a null component. ``doc_id`` names a document: rows that repeat
    it are kept or dropped together. Other columns are ignored.
    """
    if percent < 80:
        raise ValueError("the bands are made for similarities from 0.8 on")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark = docs.sparkSession
    # bands, sketches and texts are most of what is written, and go when no later step reads them
    full, full_at = stored_in(signatures(docs, words, table), "signatures")
    marked = stored(full.select("doc_id", "n_shingles", "low", "high"), "sizes")
    classes = stored(
        marked.where("n_shingles > 0 and doc_id is not null").groupBy("low", "high").agg(F.min("doc_id").alias("node")),
        "classes",
    )
    banded, banded_at = stored_in(
        full.join(classes, ["low", "high"]).where("doc_id = node").select("node", "n_shingles", "bands", "sketch"),
        "nodes",
    )
    removed(spark, full_at)
    members = banded.select("node", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    sized = stored(members.join(shared, "bucket"), "sized")
    # the most central ones come first
    ranks = sized.groupBy("node").agg((-F.sum("size")).alias("rank"))
    live = stored(sized.select("bucket", "node").join(ranks, "node"), "buckets")
    nodes, nodes_at = stored_in(_of(live, banded.drop("bands")), "sketches")
    removed(spark, banded_at)
    texts, texts_at = stored_in(_of(live, docs.withColumnRenamed("doc_id", "node")), "texts")

    live, roots = _gathered(live, nodes, texts, words, table, percent)
    # few are left as a rule, and each further round moves all sketches and texts it is given
    nodes, texts = stored(_of(live, nodes), "sketches"), stored(_of(live, texts), "texts")
    removed(spark, nodes_at)
    removed(spark, texts_at)
    root_of = stored(live.select("node", "root").distinct(), "roots")
    leader_root = root_of.select(F.col("node").alias("leader"), F.col("root").alias("leader_root"))
    links, slots = [roots.select(F.col("node").alias("a"), F.col("root").alias("b"))], 1
    live = live.select("bucket", "node", "rank", F.lit(True).alias("far"))
    while not live.isEmpty():
        # few members without a leader become leaders all at once
        few = live.where("far").groupBy("bucket").agg((F.count("*") <= FEW).alias("few"))
        slot = F.when(F.col("few") & F.lit(slots > 1), F.col("node")).otherwise(F.pmod(F.xxhash64("node"), F.lit(slots)))
        leaders = (
            live.where("far")
            .join(few, "bucket")
            .groupBy("bucket", slot.alias("slot"))
            .agg(F.min_by("node", F.struct("rank", "node")).alias("leader"))
            .select("bucket", "leader")
        )
        pairs = live.join(leaders, "bucket").where("node != leader").select("node", "leader").distinct()
        met = stored(_met(pairs, nodes, texts, words, table, percent), "met")
        if slots == 1:
            marked_far = met.withColumn("far", F.lit(True))
        else:
            far = live.where("far").select("node").distinct().withColumn("far", F.lit(True))
            marked_far = met.join(far, "node", "left").fillna(False, ["far"])
        apart = _links_apart_from_leader(marked_far.join(root_of, "node").join(leader_root, "leader"), percent)
        direct = met.where("linked").select(F.col("node").alias("a"), F.col("leader").alias("b"))
        links.append(stored(direct.unionByName(apart), "links"))
        # All links of a near member are to members that its leader has met, so it is done in
        # this bucket, as the leader is.
        seen = met.select("node", "leader", "near").join(leaders, "leader")
        done = seen.where("near").select("bucket", "node").unionByName(leaders.select("bucket", F.col("leader").alias("node")))
        rest = live.join(done, ["bucket", "node"], "left_anti")
        if slots == 1:
            # Pairs that the first leader has met both of are done. What is left has a far
            # member, so further leaders are taken from those, and meet all others again.
            met_first = seen.select("bucket", "node", F.lit(True).alias("met"))
            rest = rest.join(met_first, ["bucket", "node"], "left").select("bucket", "node", "rank", F.col("met").isNull().alias("far"))
        rest = stored(rest, "rest")
        open_ = rest.groupBy("bucket").agg(F.count("*").alias("n"), F.max("far").alias("far")).where("n > 1 and far")
        live = stored(rest.join(open_.select("bucket"), "bucket"), "buckets")
        slots = min(slots * 16, 256)

    if len(links) > 1:
        roots = components(reduce(DataFrame.unionByName, links), "a", "b", "near")
    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return (
        marked.select("doc_id", "n_shingles", "low", "high")
        .join(named.select("low", "high", "root"), ["low", "high"], "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")))
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )
