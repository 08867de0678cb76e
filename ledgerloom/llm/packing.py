"""Packing of token pieces into windows by Karmarkar-Karp multiway differencing.

A document's tokens are cut into whole windows, which stand alone, and a rest of a few
shorter pieces. Blocks of such pieces, of a bounded size and made by hashing, are packed
independently: partial partitions of the block are merged, largest imbalance first, the
fullest windows of one meeting the emptiest of the other. The windows come out nearly
equal; if one exceeds the capacity, the block is packed again with one window more.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.storage import stored

WINDOW = 2048
#: The rest of a document is cut into equal pieces of at most so many tokens: several to a window even out best.
PIECE = 512
#: Pieces that are packed together.
BLOCK = 1500
#: Entries of a generation of a worker's memory of words.
REMEMBERED = 150_000
#: Bytes of text that are encoded together.
AT_ONCE = 16 << 20
END_ID = 1


#: How the vocabulary's own pattern splits lower-case text: contractions, letters, digits, the rest.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
#: Marks after a word's last letter are a part of their own.
_APART = r"(\pL)([.,;:!?]+)(\s|$)", r"\1 \2\3"
#: Texts with other characters, or with one that two libraries fold or split in two ways, go to the library whole.
_UNUSUAL = "[^\\x00-\\x1b\\x20-\\x{84}\\x{86}-\\x{12f}\\x{131}-\\x{24f}]|<\\|"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
    others = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + others.index(b)) for b in range(256)]


class _Words(dict):
    """Folded words, and what else stands between white space, to their ids as bytes.

    What was asked for of late is kept, in two generations of ``REMEMBERED`` keys.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.older: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encoded(self, key: str) -> bytes:
        if key.isalpha():  # one word: straight to the merges
            mapped = key if key.isascii() else "".join([self.letters[b] for b in key.encode()])
            return np.array([t.id for t in self.model.tokenize(mapped)], "<u4").tobytes()
        parts = _PARTS.findall(key)
        return b"".join([self[part] for part in parts]) if len(parts) > 1 else self.whole(key)

    def __missing__(self, key: str) -> bytes:
        ids = self.older.get(key)
        if ids is None:
            ids = self._encoded(key)
        if len(key) < 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[key] = ids
        return ids


_known: dict[str, _Words] = {}


def encode_all(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in one row, each with the end id, and where each text's ids end.

    The vocabulary folds case, drops white space and never joins what its pattern parts, so
    a text's ids are those of its chunks between white space, or before closing marks, one after
    another. The different chunks of all texts are looked up once each, and their ids are
    gathered by place.
    """
    known = _known.get(path)
    if known is None:
        known = _known[path] = _Words(path)
    end = END_ID.to_bytes(4, "little")
    texts = texts.fill_null("")
    unusual = pc.match_substring_regex(texts, _UNUSUAL)
    folded = pc.utf8_lower(pc.if_else(unusual, "", texts))
    chunks = pc.utf8_split_whitespace(pc.replace_substring_regex(folded, *_APART))
    named = chunks.flatten().dictionary_encode()
    ids = [*map(known.__getitem__, named.dictionary.to_numpy(zero_copy_only=False)), end]
    closing = np.full(len(texts), len(ids) - 1)
    for i in np.flatnonzero(unusual.to_numpy(zero_copy_only=False)):
        closing[i] = len(ids)
        ids.append(known.whole(texts[i].as_py()) + end)
    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    row, first = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(lengths) - lengths
    bounds = chunks.offsets.to_numpy()[1:] - chunks.offsets[0].as_py()
    index = np.insert(named.indices.to_numpy(), bounds, closing)
    ends = np.cumsum(lengths[index])[bounds + np.arange(len(texts))]
    found = np.empty(ends[-1] if len(ends) else 0, "<u4")
    done = 0
    for i in range(0, len(index), 1 << 18):  # what is held besides the ids has a bound
        some = index[i : i + (1 << 18)]
        count = lengths[some]
        after = np.cumsum(count)
        at = np.repeat(first[some] - (after - count), count) + np.arange(after[-1])
        found[done : done + len(at)] = row[at]
        done += len(at)
    return found, ends


def encode(text: str | None, path: str) -> bytes:
    """The ids of a text, little-endian in four bytes each, with the end id."""
    return encode_all(pa.array([text], pa.string()), path)[0].tobytes()


def cut(tokens: int, window: int = WINDOW, piece: int = PIECE) -> list[tuple[int, int]]:
    """Starts and lengths: whole windows, then the rest in nearly equal pieces."""
    whole, rest = divmod(tokens, window)
    found = [(i * window, window) for i in range(whole)]
    parts = -(-rest // piece)
    bounds = [whole * window + rest * i // parts for i in range(parts + 1)] if parts else []
    return found + [(a, b - a) for a, b in zip(bounds, bounds[1:], strict=False)]


def difference(sizes: np.ndarray, windows: int) -> list[list[int]]:
    """Indices of ``sizes`` in ``windows`` lists of nearly equal sums.

    A partial partition holds its windows as sums in falling order; windows that it leaves
    empty are not stored. The two with the largest spread are merged until one is left.
    """
    heap = [(-int(s), i, np.array([s], np.int64), [[i]]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, name, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        both = max(0, len(a) + len(b) - windows)  # so many windows are filled from both sides
        own, other = len(a) - both, len(b) - both
        sums = np.concatenate([a[:own], a[own:] + b[other:][::-1], b[:other]])
        lists = [*in_a[:own], *(x + y for x, y in zip(in_a[own:], in_b[other:][::-1], strict=True)), *in_b[:other]]
        order = np.argsort(-sums, kind="stable")
        sums, lists = sums[order], [lists[i] for i in order]
        spread = int(sums[0] - (sums[-1] if len(sums) == windows else 0))
        heapq.heappush(heap, (-spread, name, sums, lists))
    return heap[0][3] if heap else []


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """First rows and numbers of rows of parts of some ``AT_ONCE`` bytes; a longer text is one of its own."""
    part = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) // AT_ONCE
    bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    return ((a, b - a) for a, b in zip(bounds, bounds[1:], strict=False))


def _pieces(path: str, with_ids: bool):
    def pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            for first, rows in _slices(part.column(1)):
                found: list[tuple] = []
                ids: list[np.ndarray] = []
                tokens, ends = encode_all(part.column(1).slice(first, rows), path)
                begin = 0
                for doc, end in zip(part.column(0).slice(first, rows).to_pylist(), ends.tolist(), strict=True):
                    for start, length in cut(end - begin):
                        own = tokens[begin + start : begin + start + length]
                        found.append((doc, start, length, zlib.crc32(own), end - begin))
                        if with_ids:
                            ids.append(own.view("<i4"))
                    begin = end
                columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from pieces(parts)
        # the worker goes on to tasks of other stages, without what arrays of this one have held
        pa.default_memory_pool().release_unused()

    return work


def _windows(table: pa.Table) -> pa.Table:
    """The pieces of one block with the sequences they go to."""
    table = table.sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32", "length")])
    sizes = table.column("length").to_numpy()
    windows = -(-int(sizes.sum()) // WINDOW)
    packed = difference(sizes, windows)
    while max(int(sizes[w].sum()) for w in packed) > WINDOW:
        windows += 1
        packed = difference(sizes, windows)
    sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    first = table.column("block")[0].as_py() << 20
    for i, members in enumerate(packed):
        sequence[members] = 2 * (first + i)
        offset[members] = np.cumsum(sizes[members]) - sizes[members]
    return (
        table.drop_columns(["block"])
        .append_column("sequence_id", pa.array(sequence))
        .append_column("offset", pa.array(offset))
    )


def pack(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``WINDOW`` tokens.

    Columns: ``doc_id``, ``start`` and ``length`` in the document's tokens, ``ids_crc32``,
    ``doc_tokens`` (with the end id), ``sequence_id``, ``offset`` in the sequence, and
    ``ids`` if asked for. ``path`` names the vocabulary file, which each machine has. A null
    or empty text is the end id alone; a null ``doc_id`` stays null; repeated rows are
    packed each for itself; no rows give none. Other columns are ignored. Sequence ids are
    unique but have gaps.
    """
    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    pieces = stored(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pieces(path, with_ids), kind), "pieces"
    )
    # The stored files fix this number, whatever task is run again.
    numbered = pieces.withColumn("number", F.monotonically_increasing_id())
    whole = numbered.where(F.col("length") == WINDOW).select(
        *pieces.columns, (F.col("number") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    blocks = -(-pieces.where(F.col("length") < WINDOW).count() // BLOCK)
    rest = (
        numbered.where(F.col("length") < WINDOW)
        .withColumn("block", F.pmod(F.xxhash64("number"), F.lit(max(1, blocks))))
        .select(*pieces.columns, "block")
        .groupBy("block")
        .applyInArrow(_windows, f"{kind}, sequence_id long, offset long")
    )
    return whole.unionByName(rest)
