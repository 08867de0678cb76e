"""Language identification by a bidirectional gated recurrent network over bytes.

The network is small and trained here, in numpy, by backpropagation through time on a
bounded sample of labelled windows. It labels every byte of a text; a document's
probabilities are the means over its bytes. Texts are read in windows of fixed length, so
that the cost per byte is constant and long texts need no more memory than short ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a window, and hidden units of each direction.
WINDOW, HIDDEN = 48, 8
#: Labelled documents that are used for each language, windows of each, and passes.
SAMPLE_DOCS, SAMPLE_WINDOWS, EPOCHS = 300, 4, 14
#: Labelled documents of all languages together.
MOST_DOCS = 60_000
_BATCH = 192
#: Windows that are read at a time.
_READ = 2048


@dataclass
class Network:
    """Weights by direction: input (a column for each byte), recurrent, and output with bias.

    States run along the last axis, one entry for each window, so that every step works on
    contiguous numbers. Gates and candidates are piecewise linear: ``clip(x + 1/2, 0, 1)``
    and ``clip(x, -1, 1)``.
    """

    languages: list[str]
    inputs: list[np.ndarray]  # 2 x [3H, 256]: update, reset, candidate
    gates: list[np.ndarray]  # 2 x [2H, H]
    states: list[np.ndarray]  # 2 x [H, H]
    output: np.ndarray  # [languages, 2H + 1]

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 11) -> Network:
        draw = np.random.default_rng(seed).normal
        make = lambda *shape: draw(0, 0.2, shape).astype(np.float32)
        h = HIDDEN
        return cls(
            languages,
            [make(3 * h, 256) for _ in range(2)],
            [make(2 * h, h) for _ in range(2)],
            [make(h, h) for _ in range(2)],
            make(len(languages), 2 * h + 1),
        )

    def weights(self) -> list[np.ndarray]:
        return [*self.inputs, *self.gates, *self.states, self.output]

    def _run(self, data: np.ndarray, side: int, tape: list | None = None) -> np.ndarray:
        """Hidden states [T, H, B] of one direction over ``data`` [T, B]."""
        steps, width = data.shape
        h, states = HIDDEN, np.empty((steps, HIDDEN, width), np.float32)
        inputs, gates, candidate = self.inputs[side], self.gates[side], self.states[side]
        state = np.zeros((h, width), np.float32)
        x = np.empty((3 * h, width), np.float32)
        for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
            np.take(inputs, data[t], axis=1, out=x, mode="clip")
            zr = gates @ state
            zr += x[: 2 * h]
            zr += 0.5
            np.clip(zr, 0, 1, out=zr)
            z, r = zr[:h], zr[h:]
            reset = r * state
            n = candidate @ reset
            n += x[2 * h :]
            np.clip(n, -1, 1, out=n)
            if tape is not None:
                tape.append((t, state, z, r, reset, n))
            new = np.subtract(n, state, out=states[t])
            new *= z
            new += state
            state = new
        return states

    def positions(self, data: np.ndarray) -> np.ndarray:
        """Probabilities [T, languages, B] of every position."""
        h = HIDDEN
        scores = np.matmul(self.output[:, :h], self._run(data, 0))
        scores += np.matmul(self.output[:, h:-1], self._run(data, 1))
        scores += self.output[:, -1:]
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    def gradients(self, data: np.ndarray, labels: np.ndarray, mask: np.ndarray) -> list[np.ndarray]:
        """Of the weighted mean cross-entropy of all positions; ``mask`` [T, B] has the weights."""
        h = HIDDEN
        tapes: list[list] = [[], []]
        hidden = [self._run(data, side, tapes[side]) for side in (0, 1)]
        scores = np.matmul(self.output[:, :h], hidden[0]) + np.matmul(self.output[:, h:-1], hidden[1])
        scores += self.output[:, -1:]
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        scores[:, labels, np.arange(data.shape[1])] -= 1
        scores *= (mask / mask.sum())[:, None, :]
        d_out = np.concatenate(
            [np.einsum("tlb,thb->lh", scores, x, optimize=True) for x in hidden] + [scores.sum(axis=(0, 2))[:, None]], axis=1
        )
        d_in, d_gates, d_states = [], [], []
        for side in (0, 1):
            grad = np.matmul(self.output[:, side * h : (side + 1) * h].T, scores)
            dx = np.zeros((256, 3 * h), np.float32)
            dg, ds = np.zeros_like(self.gates[side]), np.zeros_like(self.states[side])
            back = np.zeros(hidden[side].shape[1:], np.float32)
            for t, state, z, r, reset, n in reversed(tapes[side]):
                total = grad[t] + back
                dn = total * z * (np.abs(n) < 1)
                ds += dn @ reset.T
                d_reset = self.states[side].T @ dn
                dzr = np.concatenate([total * (n - state) * ((z > 0) & (z < 1)), d_reset * state * ((r > 0) & (r < 1))])
                dg += dzr @ state.T
                back = total * (1 - z) + d_reset * r + self.gates[side].T @ dzr
                np.add.at(dx, data[t], np.concatenate([dzr, dn]).T)
            d_in.append(dx.T)
            d_gates.append(dg)
            d_states.append(ds)
        return [*d_in, *d_gates, *d_states, d_out.astype(np.float32)]


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes [n, WINDOW] padded with 0, the text that each window is of, and its bytes."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], np.int64)
    data = np.zeros((int(counts.sum()), WINDOW), np.uint8)
    flat, at = data.reshape(-1), 0
    for text, count in zip(texts, counts, strict=True):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
        at += int(count) * WINDOW
    owner = np.repeat(np.arange(len(texts)), counts)
    filled = np.full(len(data), WINDOW, np.int64)
    ends = np.cumsum(counts)[counts > 0] - 1
    filled[ends] = [len(t) - (c - 1) * WINDOW for t, c in zip(texts, counts, strict=True) if c]
    return data, owner, filled


def folded(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def fit(sample: list[tuple[str, str]], seed: int = 5) -> Network | None:
    """Train on (language, text) pairs by Adam; None without any."""
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None
    draw = np.random.default_rng(seed)
    data, labels, masks = [], [], []
    for lang, text in sorted(sample):
        found, _, filled = windows([folded(text)])
        for i in draw.permutation(len(found))[:SAMPLE_WINDOWS]:
            data.append(found[i])
            labels.append(languages.index(lang))
            masks.append(np.arange(WINDOW) < filled[i])
    net = Network.fresh(languages)
    if not data:
        return net
    all_data, all_labels = np.stack(data), np.array(labels)
    all_masks = np.stack(masks).astype(np.float32)
    # rare languages count as much as frequent ones
    share = np.bincount(all_labels, minlength=len(languages))
    all_masks *= (len(all_labels) / (len(languages) * np.maximum(1, share[all_labels])))[:, None]
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    step = 0
    for epoch in range(EPOCHS):
        order = draw.permutation(len(all_data))
        for i in range(0, len(order), _BATCH):
            pick = order[i : i + _BATCH]
            step += 1
            rate = 0.02 * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            grads = net.gradients(np.ascontiguousarray(all_data[pick].T), all_labels[pick], all_masks[pick].T)
            for weight, grad, m, v in zip(net.weights(), grads, first, second, strict=True):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                weight -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return net


def pooled(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities [texts, languages]; zeros for empty texts."""
    data, owner, filled = windows(texts)
    total = np.zeros((len(texts), len(net.languages)))
    for i in range(0, len(data), _READ):
        found = net.positions(np.ascontiguousarray(data[i : i + _READ].T))
        found *= (np.arange(WINDOW)[:, None] < filled[i : i + _READ])[:, None, :]
        sums = found.sum(axis=0)
        for k in range(total.shape[1]):
            total[:, k] += np.bincount(owner[i : i + _READ], sums[k], len(texts))
    return total / np.maximum(1, np.array([len(t) for t in texts]))[:, None]


def verdicts(net: Network | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text; ``und`` and 0 without a letter or without a network."""
    langs, scores = [], []
    for i in range(0, len(texts), 200):
        some = texts[i : i + 200]
        known = [bool(net) and bool(t) and any(map(str.isalpha, t)) for t in some]
        found = pooled(net, [folded(t) if k else b"" for t, k in zip(some, known, strict=True)]) if net else None
        for k, ok in enumerate(known):
            best = int(found[k].argmax()) if ok else 0
            langs.append(net.languages[best] if ok else "und")
            scores.append(float(min(1.0, found[k][best])) if ok else 0.0)
    return langs, scores


def _predict(net: Network | None, text: int):
    """Batches with two more columns; the text is in column ``text``."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            langs, scores = verdicts(net, part.column(text).to_pylist())
            columns = [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [str(i) for i in range(len(columns))])

    return work


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample_of(docs: DataFrame, per_language: int = SAMPLE_DOCS, most: int = MOST_DOCS) -> list[tuple[str, str]]:
    """At most ``per_language`` labelled texts of each language, spread by hash, and ``most`` of all.

    With so many languages that these would be more, each has fewer documents, down to one.
    The ids are chosen first, in one aggregation of numbers; then one text of each chosen id
    and language is fetched, however often the id is repeated.
    """
    labelled = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", "text"
    )
    languages = labelled.agg(F.countDistinct("lang")).first()[0]
    slots = max(1, min(per_language, most // max(1, languages)))
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(slots)).alias("slot")
    picked = labelled.groupBy("lang", slot).agg(F.min("doc_id").alias("doc_id")).select("lang", "doc_id")
    # rows made on the driver would start Python workers of their own kind on all executors
    chosen = picked.orderBy(F.xxhash64("lang", "doc_id")).limit(most)
    rows = labelled.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect()
    return sorted({(r["lang"], r["text"]) for r in rows})


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``lang_pred``, ``score``.

    Learns from ``text`` and non-null ``lang`` of the documents that are not held out (the
    CRC-32 of the id as text leaves 2 when divided by 4), at most :data:`SAMPLE_DOCS` a
    language and :data:`MOST_DOCS` in all, and predicts from the text alone. ``lang_pred`` is ``und`` and the score 0 for
    a null text, a text without a letter, and if there is nothing to learn from. Rows with a
    null id are not held out, but not learned from. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    found = labelled(docs.select("doc_id", "text"), fit(sample_of(docs)))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def labelled(docs: DataFrame, net: Network | None, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``docs``, in place, and then language and score of the text.

    ``lang`` and ``score`` name these; they must be free.
    """
    kept = docs.schema.fields
    # Arrow sees the columns by position, whatever their names are
    plain = docs.toDF(*(str(i) for i in range(len(kept))))
    schema = T.StructType(
        [T.StructField(str(i), f.dataType) for i, f in enumerate(kept)]
        + [T.StructField(str(len(kept)), T.StringType()), T.StructField(str(len(kept) + 1), T.DoubleType())]
    )
    marked = plain.mapInArrow(_predict(net, docs.columns.index("text")), schema)
    return marked.toDF(*docs.columns, lang, score)
