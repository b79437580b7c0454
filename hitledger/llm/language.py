"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are cut into windows of ``WINDOW`` bytes, the last one shorter. A forward and a backward GRU
read each window; a softmax over both states labels every byte. A document's probabilities are the
mean over all its bytes, whole texts included. Windows of many documents run side by side as
numpy lanes, the longest first, so long texts need no long loops and padding is rare. Gates and
candidates are softsigns, x / (1 + |x|), which numpy computes several times faster than tanh.

The network is trained here, in numpy, by backpropagation through time with Adam, on a bounded
sample: of each language, for each of ``SAMPLE`` hash buckets the document with the smallest hash,
``PIECES`` windows at most, spread over its whole text. Training is seeded, so reruns agree.

Defined results: null text and text without a letter get ``und`` and score 0; so does everything if
there is no labelled row; repeated rows get equal results; texts of any length are read whole; an
empty table gives an empty result; columns named ``lang_pred`` or ``score`` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm import textkeys as tk
from hitledger.llm.common import in_fold, text_or_empty

WINDOW, HIDDEN, LANES = 128, 16, 512
SAMPLE, PIECES = 256, 8
STEPS, BATCH, RATE = 300, 192, 0.01
PAD = 256
UNKNOWN = "und"


@dataclass
class Gru:
    """One direction: inputs by byte (257 x 3H), recurrent weights (H x 3H), candidate bias (H).

    Gates stand in the order update, reset, candidate.
    """

    inputs: np.ndarray
    recurrent: np.ndarray
    bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.bias]


@dataclass
class Network:
    languages: list[str]
    forward: Gru
    backward: Gru
    output: np.ndarray
    shift: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [*self.forward.parts(), *self.backward.parts(), self.output, self.shift]


def new_network(languages: list[str], seed: int = 0) -> Network:
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    def gru() -> Gru:
        return Gru(normal(257, 3 * HIDDEN, scale=0.5), normal(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5), np.zeros(HIDDEN, np.float32))

    return Network(
        languages, gru(), gru(), normal(2 * HIDDEN, len(languages), scale=0.3), np.zeros(len(languages), np.float32)
    )


def softsign(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """x / (1 + |x|) in place."""
    np.abs(x, out=spare)
    spare += 1
    x /= spare
    return x


def gate(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """A softsign between 0 and 1, in place."""
    softsign(x, spare)
    x *= 0.5
    x += 0.5
    return x


def states(gru: Gru, codes: np.ndarray, real: np.ndarray | None = None, keep: list | None = None) -> np.ndarray:
    """Hidden states (T x lanes x H) along ``codes`` (T x lanes).

    Where ``real`` is false the state stays 0: that is how a backward run passes the padding.
    ``keep`` collects what the backward pass needs.
    """
    lanes, h2 = codes.shape[1], 2 * HIDDEN
    h = np.zeros((lanes, HIDDEN), np.float32)
    out = np.empty((*codes.shape, HIDDEN), np.float32)
    for t in range(len(codes)):
        given = gru.inputs[codes[t]]
        from_state = h @ gru.recurrent
        gates = given[:, :h2] + from_state[:, :h2]
        gate(gates, np.empty_like(gates))
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        q = from_state[:, h2:] + gru.bias
        n = given[:, h2:] + r * q
        softsign(n, np.empty_like(n))
        new = n + z * (h - n)
        if real is not None:
            new *= real[t][:, None]
        if keep is not None:
            keep.append((h, z, r, q, n))
        h = new
        out[t] = h
    return out


def gradients(gru: Gru, codes: np.ndarray, real: np.ndarray | None, keep: list, wanted: np.ndarray) -> list[np.ndarray]:
    """Backpropagation through time: gradients of the parts, given those of the states."""
    given = np.empty((*codes.shape, 3 * HIDDEN), np.float32)
    recurrent, bias = np.zeros_like(gru.recurrent), np.zeros_like(gru.bias)
    carry = np.zeros(wanted.shape[1:], np.float32)
    for t in range(len(codes) - 1, -1, -1):
        h, z, r, q, n = keep[t]
        d = wanted[t] + carry
        if real is not None:
            d = d * real[t][:, None]
        d_n = d * (1 - z) * (1 - np.abs(n)) ** 2
        d_q = d_n * r
        d_z = d * (h - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
        d_r = d_n * q * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
        d_state = np.concatenate([d_z, d_r, d_q], axis=1)
        recurrent += h.T @ d_state
        bias += d_q.sum(axis=0)
        carry = d * z + d_state @ gru.recurrent.T
        given[t] = np.concatenate([d_z, d_r, d_n], axis=1)
    flat = codes.reshape(-1)
    order = np.argsort(flat, kind="stable")
    found, starts = np.unique(flat[order], return_index=True)
    inputs = np.zeros_like(gru.inputs)
    inputs[found] = np.add.reduceat(given.reshape(len(flat), -1)[order], starts, axis=0)
    return [inputs, recurrent, bias]


def position_probabilities(network: Network, codes: np.ndarray) -> np.ndarray:
    """(languages x T x lanes) for ``codes`` (T x lanes) padded with PAD at the end.

    What ``states`` computes, for both directions at once: gates, candidates and states are blocks
    of their own, so every step runs over whole buffers that are reused.
    """
    steps, lanes = codes.shape
    codes = codes.astype(np.intp)
    both = (network.forward, network.backward)
    shape = (2, 3, lanes, HIDDEN)
    tables = [np.ascontiguousarray(g.inputs.reshape(257, 3, HIDDEN).transpose(1, 0, 2)) for g in both]
    recurrent = np.stack([g.recurrent.reshape(HIDDEN, 3, HIDDEN).transpose(1, 0, 2) for g in both])
    bias = np.stack([g.bias for g in both])[:, None]
    padded = codes[-1].max() == PAD
    given, carried = np.empty(shape, np.float32), np.empty(shape, np.float32)
    spare = np.empty((2, 2, lanes, HIDDEN), np.float32)
    out = np.empty((steps, 2, lanes, HIDDEN), np.float32)
    h = np.zeros((2, lanes, HIDDEN), np.float32)
    for t in range(steps):
        for side, at in enumerate((t, steps - 1 - t)):
            for part in range(3):
                tables[side][part].take(codes[at], axis=0, out=given[side, part], mode="clip")
        np.matmul(h[:, None], recurrent, out=carried)
        gates = given[:, :2]
        gates += carried[:, :2]
        gate(gates, spare)
        q, n = carried[:, 2], given[:, 2]
        q += bias
        q *= gates[:, 1]
        n += q
        softsign(n, spare[:, 0])
        np.subtract(h, n, out=q)
        q *= gates[:, 0]
        h = np.add(n, q, out=out[t])
        if padded:
            # the state stays 0 while the backward run passes the padding
            h[1] *= (codes[steps - 1 - t] != PAD)[:, None]
    ahead = out[:, 0].reshape(-1, HIDDEN)
    behind = out[::-1, 1].reshape(-1, HIDDEN)
    found = network.output[:HIDDEN].T @ ahead.T
    found += network.output[HIDDEN:].T @ behind.T
    found += network.shift[:, None]
    found -= found.max(axis=0)
    np.exp(found, out=found)
    found /= found.sum(axis=0)
    return found.reshape(-1, steps, lanes)


def train(network: Network, windows: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = 0) -> Network:
    """Fits on (n x T) byte windows, PAD behind their ends; languages weigh alike."""
    rng = np.random.default_rng(seed)
    parts = network.parts()
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    weights = 1.0 / np.bincount(labels, minlength=len(network.languages)).clip(1)[labels]
    weights /= weights.sum()
    for step in range(1, steps + 1):
        chosen = rng.choice(len(windows), BATCH, p=weights)
        codes = np.ascontiguousarray(windows[chosen].T)
        real = (codes != PAD).astype(np.float32)
        ahead, behind = [], []
        front = states(network.forward, codes, keep=ahead)
        back = states(network.backward, codes[::-1], real[::-1], keep=behind)[::-1]
        both = np.concatenate([front, back], axis=2)
        logits = both @ network.output + network.shift
        logits -= logits.max(axis=2, keepdims=True)
        wrong = np.exp(logits)
        wrong /= wrong.sum(axis=2, keepdims=True)
        wrong[:, np.arange(BATCH), labels[chosen]] -= 1
        wrong *= (real / real.sum())[:, :, None]
        wanted = wrong @ network.output.T
        grads = [
            *gradients(network.forward, codes, None, ahead, wanted[..., :HIDDEN]),
            *gradients(network.backward, codes[::-1], real[::-1], behind, wanted[::-1, :, HIDDEN:]),
            both.reshape(-1, 2 * HIDDEN).T @ wrong.reshape(-1, len(network.languages)),
            wrong.sum(axis=(0, 1)),
        ]
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for part, grad, m, v in zip(parts, grads, first, second):
            grad = grad * np.float32(min(1.0, 1.0 / (norm + 1e-9)))
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            part -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return network


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all rows: (n x WINDOW codes with PAD behind the ends, row of each)."""
    counts = -(-np.diff(offsets) // WINDOW)
    row = np.repeat(np.arange(len(counts)), counts)
    number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (offsets[row] + number * WINDOW)[:, None] + np.arange(WINDOW)
    inside = at < offsets[row + 1][:, None]
    codes = np.full(at.shape, PAD, np.int16)
    codes[inside] = data[at[inside]]
    return codes, row


def document_probabilities(network: Network, column: pa.Array) -> np.ndarray:
    """(rows x languages): the mean over all bytes of each text; zeros for empty texts."""
    sums = np.zeros((len(column), len(network.languages)))
    for start, stop in tk.slices(column, 1 << 20):
        data, offsets = tk.string_parts(column.slice(start, stop - start))
        # long rows pass in pieces of a million bytes, cut between windows
        for low in range(0, len(data), WINDOW << 13):
            near = np.clip(offsets, low, low + (WINDOW << 13)) if len(offsets) == 2 else offsets
            codes, row = windows_of(data, near)
            lengths = (codes != PAD).sum(axis=1)
            longest = np.argsort(-lengths, kind="stable")
            for lane in range(0, len(codes), LANES):
                chosen = longest[lane : lane + LANES]
                part = np.ascontiguousarray(codes[chosen, : lengths[chosen[0]]].T)
                found = position_probabilities(network, part)
                if lengths[chosen[-1]] < len(part):
                    found *= part != PAD
                totals = found.sum(axis=1)
                for k in range(len(totals)):
                    sums[start:stop, k] += np.bincount(row[chosen], totals[k], stop - start)
            if len(offsets) != 2:
                break
        sums[start:stop] /= np.maximum(np.diff(offsets), 1)[:, None]
    return sums


def training_sample(labelled: DataFrame, lang: str, text: str, sample: int = SAMPLE) -> DataFrame:
    """(lang, text): of each language, at most ``sample`` documents, by the smallest text hashes."""
    hashed = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and length(text) > 0")
    hashed = hashed.withColumn("hash", F.xxhash64("text")).withColumn("bucket", F.pmod("hash", F.lit(sample)))
    least = hashed.groupBy("lang", "bucket").agg(F.min("hash").alias("hash")).select("lang", "hash")
    return hashed.select("lang", "text", "hash").join(F.broadcast(least), ["lang", "hash"]).dropDuplicates(["lang", "hash"])


def spread_windows(text: Column, pieces: int = PIECES) -> Column:
    """At most ``pieces`` of a text's windows of WINDOW bytes, evenly spread over all of it."""
    data = text.cast("binary")
    last = F.ceil(F.octet_length(data) / WINDOW) - 1
    numbers = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda k: F.floor(k * last / (pieces - 1)))
    return F.transform(F.array_distinct(numbers), lambda n: F.substring(data, (n * WINDOW + 1).cast("int"), F.lit(WINDOW)))


def fit(labelled: DataFrame, *, lang: str = "lang", text: str = "text") -> Network:
    """Trains on the bounded sample of labelled rows."""
    sample = training_sample(labelled, lang, text)
    rows = sample.select("lang", "hash", spread_windows(F.col("text")).alias("windows")).orderBy("lang", "hash").collect()
    languages = sorted({r["lang"] for r in rows})
    network = new_network(languages)
    if not languages:
        return network
    pieces, labels = [], []
    for r in rows:
        for window in r["windows"]:
            codes = np.full(WINDOW, PAD, np.int16)
            codes[: len(window)] = np.frombuffer(bytes(window), np.uint8)
            pieces.append(codes[None])
            labels.append(languages.index(r["lang"]))
    return train(network, np.concatenate(pieces), np.array(labels))


def identifier(network: Network):
    """Column function: text -> struct of language and score."""

    @F.arrow_udf("lang string, score double")
    def identify(texts: pa.Array) -> pa.Array:
        found = document_probabilities(network, texts)
        best = found.argmax(axis=1)
        names = pa.array([network.languages[k] for k in best], pa.string())
        return pa.StructArray.from_arrays([names, pa.array(np.clip(found[np.arange(len(best)), best], 0.0, 1.0))], ["lang", "score"])

    return identify


def identify(docs: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to every document."""
    if not network.languages:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    lettered: Column = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    found = docs.withColumn("__found", identifier(network)(text_or_empty(text)))
    return found.withColumns(
        {
            "lang_pred": F.when(lettered, F.col("__found")["lang"]).otherwise(UNKNOWN),
            "score": F.when(lettered, F.col("__found")["score"]).otherwise(0.0),
        }
    ).drop("__found")


def op7_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = in_fold("doc_id", 0)
    network = fit(docs.where(~held_out).select("lang", "text"))
    return identify(docs.select("doc_id", held_out.alias("held_out"), "text"), network).drop("text")
