"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text, in windows, forwards and
backwards, with gated recurrent units; at every byte both states give the
probabilities of the learned languages, and a document's probabilities are
their mean over all its bytes. It is trained in numpy by backpropagation
through time on the label of every position, on a bounded sample: for each
language at most ``per_language`` distinct texts, those of the least hashes, and
``windows`` stretches of each. Prediction runs over whole texts, a task's
documents at a time, and nothing but the text goes into it.

Nulls and odd rows: a null text or one without a letter is ``und`` with score
0; null languages and null texts are not learned from; a null doc_id counts as
the empty string in the split; ties go to the language that sorts first; rows
that share a doc_id are predicted each on its own. With nothing to learn from
all is ``und``; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.base import lean, read, ship, unused

UNKNOWN = "und"
PAD = 256
WINDOW = 128
PARTS = 64


# -- the network ---------------------------------------------------------------

def init(languages: int, hidden: int, rng) -> dict[str, np.ndarray]:
    """Weights of both directions (f, b) and of the output."""
    w = {}
    for d in "fb":
        w[f"E{d}"] = rng.normal(0, 0.3, (PAD + 1, 3 * hidden))  # byte -> inputs of r, z, n
        w[f"U{d}"] = rng.normal(0, hidden ** -0.5, (2 * hidden, hidden))  # state -> r, z
        w[f"N{d}"] = rng.normal(0, hidden ** -0.5, (hidden, hidden))  # r * state -> n
        w[f"V{d}"] = rng.normal(0, hidden ** -0.5, (languages, hidden))
    w["c"] = np.zeros((languages, 1))
    w = {k: v.astype(np.float32) for k, v in w.items()}
    for d in "fb":  # at a pad the update gate is shut: the state stays
        w[f"E{d}"][PAD] = 0
        w[f"E{d}"][PAD, hidden:2 * hidden] = 1e3
    return w


def _step(w, d: str, x: np.ndarray, h: np.ndarray):
    """One unit step for a column of bytes; returns gates, candidate and state."""
    size = h.shape[0]
    e = np.take(w[f"E{d}"], x, axis=0).T
    gates = w[f"U{d}"] @ h
    gates += e[:2 * size]
    gates *= 0.2
    gates += 0.5
    np.maximum(gates, 0, out=gates)
    np.minimum(gates, 1, out=gates)
    n = w[f"N{d}"] @ (gates[:size] * h)
    n += e[2 * size:]
    np.tanh(n, out=n)
    new = h - n
    new *= gates[size:]
    new += n
    return gates, n, new


def _softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(axis=0)
    np.exp(z, out=z)
    z /= z.sum(axis=0)
    return z


def position_sums(w, x: np.ndarray) -> np.ndarray:
    """Language probabilities (languages, windows), added up over the bytes of
    each window; x: bytes (positions, windows), padded at the end."""
    steps, count = x.shape
    size = w["Uf"].shape[1]
    h = np.zeros((size, count), np.float32)
    forward = np.empty((steps, len(w["c"]), count), np.float32)
    for t in range(steps):
        _, _, h = _step(w, "f", x[t], h)
        np.matmul(w["Vf"], h, out=forward[t])
    h = np.zeros((size, count), np.float32)
    total = np.zeros((len(w["c"]), count), np.float32)
    for t in range(steps - 1, -1, -1):
        _, _, h = _step(w, "b", x[t], h)
        z = forward[t]
        z += w["Vb"] @ h
        z += w["c"]
        total += _softmax(z) * (x[t] != PAD)
    return total


def gradients(w, x: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over all positions, and its gradient by backpropagation
    through time in both directions."""
    steps, count = x.shape
    size, languages = w["Uf"].shape[1], len(w["c"])
    real = x != PAD
    weight = (real / max(1, real.sum())).astype(np.float32)
    kept: dict[str, list] = {}
    logits = np.repeat(w["c"][None], steps, axis=0).repeat(count, axis=2).astype(np.float32)
    for d, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
        h, rows = np.zeros((size, count), np.float32), [None] * steps
        for t in order:
            gates, n, new = _step(w, d, x[t], h)
            rows[t] = (h, gates, n, new)
            logits[t] += w[f"V{d}"] @ new
            h = new
        kept[d] = rows
    z = logits - logits.max(axis=1, keepdims=True)
    p = np.exp(z)
    p /= p.sum(axis=1, keepdims=True)
    at = np.arange(count)
    loss = float(-(np.log(np.maximum(p[:, labels, at], 1e-9)) * weight).sum())
    out = p
    out[:, labels, at] -= 1
    out *= weight[:, None]
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    grad["c"] = out.sum(axis=(0, 2))[:, None]
    for d, order in (("f", range(steps - 1, -1, -1)), ("b", range(steps))):
        back = np.zeros((size, count), np.float32)
        inputs = np.empty((steps, 3 * size, count), np.float32)
        for t in order:
            h, gates, n, new = kept[d][t]
            r, u = gates[:size], gates[size:]
            grad[f"V{d}"] += out[t] @ new.T
            back = back + w[f"V{d}"].T @ out[t]
            dn = back * (1 - u) * (1 - n * n)
            dm = w[f"N{d}"].T @ dn
            grad[f"N{d}"] += dn @ (r * h).T
            dg = np.concatenate([dm * h, back * (h - n)])
            dg *= 0.2 * ((gates > 0) & (gates < 1))
            grad[f"U{d}"] += dg @ h.T
            inputs[t, :2 * size], inputs[t, 2 * size:] = dg, dn
            back = back * u + dm * r + w[f"U{d}"].T @ dg
        for k in range(3 * size):
            grad[f"E{d}"][:, k] = np.bincount(x.ravel(), inputs[:, k].ravel(), PAD + 1)
        grad[f"E{d}"][PAD] = 0
    return loss, grad


def train(samples: list[tuple[bytes, int]], languages: int, *, hidden: int = 8, steps: int = 400,
          batch: int = 96, rate: float = 0.02, seed: int = 1) -> dict[str, np.ndarray]:
    """Adam over random batches in which each language has an equal share."""
    rng = np.random.default_rng(seed)
    w = init(languages, hidden, rng)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    by = [[s for s, y in samples if y == k] for k in range(languages)]
    for i in range(1, steps + 1):
        labels = np.arange(batch) % languages
        x = pad([by[y][rng.integers(len(by[y]))] for y in labels])
        _, grad = gradients(w, x, labels)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        now = rate * min(1.0, 2 * (1 - (i - 1) / steps))
        for k, g in grad.items():
            g *= min(1.0, 1 / max(norm, 1e-9))
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            w[k] -= (now * (first[k] / (1 - 0.9 ** i))
                     / (np.sqrt(second[k] / (1 - 0.99 ** i)) + 1e-6)).astype(np.float32)
    return w


def pad(windows: list[bytes]) -> np.ndarray:
    """(positions, windows) of byte values, PAD behind each window's end."""
    steps = max(map(len, windows))
    x = np.full((steps, len(windows)), PAD, np.int64)
    for j, s in enumerate(windows):
        x[:len(s), j] = np.frombuffer(s, np.uint8)
    return x


def document_probabilities(w, texts: list[bytes], block: int = 2048) -> np.ndarray:
    """(documents, languages): the mean over all bytes of each text (none: zeros)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    total = np.zeros((len(texts), len(w["c"])))
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.int16)  # room for PAD
    begins = np.cumsum(sizes) - sizes
    parts = -(-sizes // WINDOW)
    doc = np.repeat(np.arange(len(texts)), parts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = begins[doc] + nth * WINDOW
    length = np.minimum(sizes[doc] - nth * WINDOW, WINDOW)
    order = np.argsort(length, kind="stable")
    for i in range(0, len(order), block):
        own = order[i:i + block]
        at = np.arange(length[own[-1]])[:, None]
        inside = at < length[own]
        x = np.where(inside, data[np.where(inside, start[own] + at, 0)], PAD)
        np.add.at(total, doc[own], position_sums(w, x).T)
    return total / np.maximum(sizes, 1)[:, None]


# -- on Spark --------------------------------------------------------------------

def held_out(key: Column) -> Column:
    """Whether crc32 of the id as text leaves the remainder 2 when divided by 4."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 4 == 2


def learn(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
          per_language: int = 500, windows: int = 4, **training) -> tuple[list[str], dict]:
    """(languages, weights) from the labelled documents that are not held out.

    The driver gets at most ``per_language`` times ``windows`` stretches of each
    language, however large the table is and however often a text stands in it.
    Every language with a text that is not empty is learned.
    """
    rows = docs.where(~held_out(F.col(key)) & F.col(text).isNotNull() & (F.col(text) != "") & F.col(lang).isNotNull()) \
        .select(F.col(text).cast("string").alias("t"), F.col(lang).alias("y")).withColumn("draw", F.xxhash64("t"))
    size = 2 * WINDOW  # in characters; cut to bytes below
    room = F.greatest(F.char_length("t") - size, F.lit(0))
    cuts = F.array(*(F.substring("t", (F.floor(room * F.pmod(F.xxhash64("t", F.lit(i)), F.lit(1000)) / 1000)
                                       + 1).cast("int"), F.lit(size)) for i in range(windows)))
    # the least hashes of each language, first in parts of them, so that no task
    # sorts a whole language; copies of a text are one hash
    hashes = rows.select("y", "draw").distinct()
    part = Window.partitionBy("y", "part").orderBy("draw")
    whole = Window.partitionBy("y").orderBy("draw")
    parts = hashes.withColumn("part", F.pmod(F.hash("draw"), F.lit(PARTS)))
    least = (parts.withColumn("nth", F.row_number().over(part)).where(F.col("nth") <= per_language)
             .withColumn("nth", F.row_number().over(whole)).where(F.col("nth") <= per_language).select("y", "draw"))
    some = (rows.join(F.broadcast(least), ["y", "draw"]).groupBy("y", "draw")
            .agg(F.min(cuts).alias("cuts")))
    taken = sorted(some.collect(), key=lambda r: (r["y"], r["draw"]))
    names = sorted({r["y"] for r in taken})
    number = {y: k for k, y in enumerate(names)}
    samples = [(raw, number[r["y"]]) for r in taken for c in r["cuts"] if (raw := c.encode()[:WINDOW])]
    if not names:
        return [], {}
    return names, train(samples, len(names), **training)


def predict(docs: DataFrame, model: tuple[list[str], dict], *, text: str = "text",
            names_as: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of ``docs``, and language and score (named ``names_as``, in place
    of columns of these names): one pass, no shuffle."""
    names, weights = model
    ship(docs.sparkSession)

    @lean
    def run(batches):
        for b in batches:
            texts = [t.as_py() for t in b.column(text)]
            known = [bool(t and names and any(map(str.isalpha, t))) for t in texts]
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            at = [i for i, k in enumerate(known) if k]
            # some megabytes at a time, so that memory does not follow the batch
            while at:
                size, n = 0, 0
                while n < len(at) and (not n or size < 4_000_000):
                    size += len(texts[at[n]])
                    n += 1
                now, at = at[:n], at[n:]
                p = document_probabilities(weights, [texts[i].encode() for i in now])
                for i, row in zip(now, p):
                    k = int(row.argmax())
                    lang[i], score[i] = names[k], min(1.0, float(row[k]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score)],
                                             names=[*b.schema.names, *names_as])

    kept = docs.drop(*names_as)
    schema = T.StructType([*kept.schema.fields, T.StructField(names_as[0], T.StringType()),
                           T.StructField(names_as[1], T.DoubleType())])
    return kept.mapInArrow(run, schema)


def of_known_language(docs: DataFrame) -> DataFrame:
    """The documents that have a predicted language, whatever its score: not ``und``.
    A null lang is filled in; all columns are kept."""
    lang, score = unused(docs, "_lang", "_score")
    out = predict(docs, learn(docs), names_as=(lang, score))
    return (out.where(F.col(lang) != UNKNOWN)
            .withColumn("lang", F.coalesce("lang", lang)).select(*docs.columns))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text of ``documents``, learned from the others'."""
    docs = read(spark, sf_dir, "documents")
    model = learn(docs)
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
