"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages, its UTF-8 bytes cut every `passage` bytes. Each passage is encoded by the shares of its
byte bigrams (hashed to `BINS` bins, square roots), by the shares of character classes, and by how concentrated its
bigrams are, through a learned tanh layer. Gated attention (tanh times sigmoid, softmax over the passages of the document)
weighs the passages, the weighted representation is scored by a logistic unit. Only the document has a label; which
passages speak for it is learned from the labels.

Training is numpy on the driver over at most `fit_rows` labelled rows, chosen by a hash of their ids, each entering with
at most `fit_passages` passages drawn evenly over the text; scoring is a map over all rows and all passages. Held out:
rows whose crc32(id as text) mod 4 is 2. Labels, lang, source and ids are never inputs of a score.

Defined cases: null and empty texts are one empty passage and are scored like any other; rows with a null label teach
nothing; with no labelled row of either class, every score is the share of label 1 among the learned rows (0.5 if none);
rows with equal texts score alike; a null id is scored, never learned from, held_out false.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlink.llm.common import crc_mod4, ship, table
from leadlink.llm.registry import query

ship(__name__)

BINS = 256
#: Upper-case letters, lower-case letters, digits, spaces, line ends, stops, other ASCII signs, bytes of other characters.
_CLASS = np.array([
    0 if 65 <= b <= 90 else 1 if 97 <= b <= 122 else 2 if 48 <= b <= 57 else 3 if b == 32 else 4 if b < 32 else 5 if b in b".,;:?!'\"" else 6 if b < 128 else 7
    for b in range(256)
], np.int64)
WIDTH = BINS + 8 + 3


def cut(texts: list[bytes], passage: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(all bytes, owner, start and size of each passage); an empty text has one empty passage."""
    sizes = np.array([len(t) for t in texts], np.int64)
    n = np.maximum(1, -(-sizes // passage))
    owner = np.repeat(np.arange(len(texts)), n)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = (np.cumsum(sizes) - sizes)[owner] + nth * passage
    return np.frombuffer(b"".join(texts), np.uint8), owner, start, np.minimum(passage, sizes[owner] - nth * passage)


def features(texts: list[bytes], passage: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, features) of every passage."""
    data, owner, start, size = cut(texts, passage)
    of = np.repeat(np.arange(len(size)), size)
    wide = data.astype(np.int64)
    pair = (wide[:-1] * 31 + wide[1:] * 131 + (wide[:-1] ^ wide[1:]) * 17) % BINS if len(wide) > 1 else wide[:0]
    inside = of[:-1] == of[1:]
    grams = np.bincount(of[:-1][inside] * BINS + pair[inside], minlength=len(size) * BINS).reshape(len(size), BINS)
    kinds = np.bincount(of * 8 + _CLASS[data], minlength=len(size) * 8).reshape(len(size), 8)
    share = grams / np.maximum(grams.sum(axis=1, keepdims=True), 1)
    parts = kinds / np.maximum(size, 1)[:, None]
    word = 1 / (parts[:, 3] + parts[:, 4] + 0.02) / 50
    more = np.stack([np.sqrt((share**2).sum(axis=1)), word, np.log1p(size) / 7], axis=1)
    return owner, np.concatenate([np.sqrt(share), parts, more], axis=1).astype(np.float32)


def new_model(width: int, hidden: int, attention: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
    return {"enc": draw(width, hidden), "enc0": np.zeros(hidden), "v": draw(hidden, attention), "u": draw(hidden, attention),
            "w": draw(attention, 1), "out": draw(hidden, 1), "out0": np.zeros(1)}


def forward(m, x: np.ndarray, owner: np.ndarray, bags: int):
    """Probability per bag and everything the way back needs; `owner` ascends."""
    h = np.tanh(x @ m["enc"] + m["enc0"])
    t, s = np.tanh(h @ m["v"]), 1 / (1 + np.exp(-np.clip(h @ m["u"], -30, 30)))
    raw = (t * s @ m["w"])[:, 0]
    top = np.full(bags, -np.inf)
    np.maximum.at(top, owner, raw)
    e = np.exp(raw - top[owner])
    a = e / np.bincount(owner, weights=e, minlength=bags)[owner]
    z = np.zeros((bags, h.shape[1]))
    np.add.at(z, owner, a[:, None] * h)
    p = 1 / (1 + np.exp(-np.clip(z @ m["out"] + m["out0"], -30, 30)))[:, 0]
    return p, (h, t, s, a, z)


def gradients(m, x, owner, label, decay: float = 1e-4):
    """(mean loss, gradient) of the bags' labels."""
    bags = len(label)
    p, (h, t, s, a, z) = forward(m, x, owner, bags)
    loss = -np.mean(label * np.log(p + 1e-12) + (1 - label) * np.log(1 - p + 1e-12)) + 0.5 * decay * sum((m[k] ** 2).sum() for k in ("enc", "out"))
    d = ((p - label) / bags)[:, None]
    dz = d @ m["out"].T
    g = {"out": z.T @ d + decay * m["out"], "out0": d.sum(axis=0)}
    da = (dz[owner] * h).sum(axis=1)
    draw = a * (da - np.bincount(owner, weights=a * da, minlength=bags)[owner])
    g["w"] = (t * s).T @ draw[:, None]
    dts = draw[:, None] @ m["w"].T
    dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
    g["v"], g["u"] = h.T @ dt, h.T @ ds
    dh = a[:, None] * dz[owner] + dt @ m["v"].T + ds @ m["u"].T
    dh *= 1 - h * h
    g["enc"], g["enc0"] = x.T @ dh + decay * m["enc"], dh.sum(axis=0)
    return loss, g


def train(bags: list[np.ndarray], label: np.ndarray, hidden: int = 24, attention: int = 16, epochs: int = 12, batch: int = 64,
          rate: float = 0.005, seed: int = 5) -> dict[str, np.ndarray]:
    """Standardises the features and fits by Adam; the scale is folded into the model."""
    x = np.concatenate(bags).astype(np.float64)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    m = new_model(x.shape[1], hidden, attention, seed)
    first, second = ({k: np.zeros_like(v) for k, v in m.items()} for _ in range(2))
    rng, step = np.random.default_rng(seed), 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for k in range(0, len(order), batch):
            part = order[k : k + batch]
            step += 1
            xs = (np.concatenate([bags[j] for j in part]) - mean) / scale
            _, g = gradients(m, xs, np.repeat(np.arange(len(part)), [len(bags[j]) for j in part]), label[part])
            for key, v in g.items():
                first[key] = 0.9 * first[key] + 0.1 * v
                second[key] = 0.999 * second[key] + 0.001 * v * v
                m[key] = m[key] - rate * (first[key] / (1 - 0.9**step)) / (np.sqrt(second[key] / (1 - 0.999**step)) + 1e-8)
    m["enc0"] = m["enc0"] - (mean / scale) @ m["enc"]
    m["enc"] = m["enc"] / scale[:, None]
    return {k: v.astype(np.float32) for k, v in m.items()}


def _bags(passage: int, most: int):
    """Features of labelled rows, a bounded number of passages of each, spread evenly over the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 128):
                few = batch.slice(k, 128)
                owner, x = features([(t or "").encode() for t in few.column("text").to_pylist()], passage)
                bags = [x[owner == j] for j in range(few.num_rows)]
                bags = [b[np.unique(np.linspace(0, len(b) - 1, min(most, len(b))).astype(int))].tobytes() for b in bags]
                yield pa.RecordBatch.from_arrays([few.column("id"), few.column("label"), pa.array(bags, pa.binary())], names=["id", "label", "bag"])

    return run


def fit(docs: DataFrame, labels: DataFrame, passage: int, fit_rows: int, fit_passages: int):
    """(model, share of label 1): the model is None unless both classes were seen."""
    known = labels.where(F.col("label").isNotNull() & F.col("id").isNotNull() & (crc_mod4(F.col("id")) != 2)).select("id", "label").distinct()
    rows = docs.select("id", F.xxhash64("text").alias("h"), "text")
    # A row is chosen by id and text, so the bound holds for rows whatever ids repeat; equal rows count once.
    chosen = rows.select("id", "h").distinct().join(known, "id").orderBy(F.xxhash64("id"), "id", "h", "label").limit(fit_rows)
    kind = docs.schema["id"].dataType.simpleString()
    rows = (
        rows.join(F.broadcast(chosen), ["id", "h"]).groupBy("id", "h", "label").agg(F.first("text").alias("text")).select("id", "label", "text")
        .mapInArrow(_bags(passage, fit_passages), f"id {kind}, label int, bag binary").orderBy("id", "label", "bag").collect()
    )
    label = np.array([r.label for r in rows], np.float64)
    share = float(label.mean()) if len(label) else 0.5
    if len(set(label.tolist())) < 2:
        return None, share
    return train([np.frombuffer(r.bag, np.float32).reshape(-1, WIDTH) for r in rows], label), share


def _scorer(model, share: float, passage: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 128):
                few = batch.slice(k, 128)
                if model is None:
                    score = np.full(few.num_rows, share)
                else:
                    owner, x = features([(t or "").encode() for t in few.column("text").to_pylist()], passage)
                    score = np.clip(forward(model, x, owner, few.num_rows)[0].astype(np.float64), 0, 1)
                yield pa.RecordBatch.from_arrays([few.column("id"), few.column("held_out"), pa.array(score)], names=["id", "held_out", "score"])

    return run


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          threshold: float = 0.7, passage: int = 512, fit_rows: int = 4000, fit_passages: int = 16) -> DataFrame:
    """(id, held_out, score, predicted) for every row of docs."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    model, share = fit(rows, known, passage, fit_rows, fit_passages)
    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.select("id", F.coalesce(crc_mod4(F.col("id")) == 2, F.lit(False)).alias("held_out"), "text").mapInArrow(
        _scorer(model, share, passage), f"id {kind}, held_out boolean, score double"
    )
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)).withColumnRenamed("id", id_col)


@query("op6_quality")
def op6_quality(spark, sf_dir):
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
