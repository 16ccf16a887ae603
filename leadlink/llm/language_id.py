"""Language identification by a bidirectional gated recurrent network over bytes.

The UTF-8 bytes of a whole text are cut into windows of `width` bytes. In each window one gated recurrent unit reads
forwards and one backwards; at every byte a softmax over both states gives the probability of each language, and a
document's probabilities are the mean over all of its bytes. Training is plain numpy on the driver: backpropagation
through time over random windows of at most `per_language` documents of each language, chosen by a hash of their ids, and
of each at most `SNIPPETS` snippets of `SNIPPET` bytes spread evenly over the whole text, so the work and memory of
training are bounded whatever the corpus holds. Prediction is a map over all rows with a model of a few kB.

Never used for a prediction: lang, source, id. Held out from training: rows whose crc32(id as text) mod 4 is 2.

Defined cases: `und` with score 0 for a null text, a text without a letter, or when no labelled row could be learned
from; rows that repeat are predicted alike; a null id is never learned from, its row is predicted, held_out false. The
bound of the training sample holds for rows: a row is chosen by its id and its text, equal rows count once.

As a filter (`accepted`) nothing is learned from the sample alone, which only gives the weights and the optimizer's state
that training goes on from. Every window of every learnable row, copies too, then counts in one of `SHARES` further steps:
a step's gradient is the sum over all rows of its share, each language with equal weight, added up by Spark, so that the
number, order and contents of the partitions do not matter. The letters that were learned are those of all learnable rows.
The network knows nothing of other characters, so a document's score is multiplied by the share of its letters that were
learned. It goes where the product is below half of the lowest score of a learnable document, or where it has no letter.
Where nothing could be learned, every document with a letter stays.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlink.llm.common import crc_mod4, per_worker, ship, stored, table
from leadlink.llm.registry import query

ship(__name__)

SNIPPETS, SNIPPET = 48, 240
SHARES = 8
LETTER = regex.compile(r"\p{L}")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)
    return x


def new_model(languages: int, hidden: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Per direction: table (3H x 256) of what a byte adds to the gates, recurrent weights, candidate bias."""
    rng = np.random.default_rng(seed)
    m = {"out": rng.normal(0, 0.3, (languages, 2 * hidden)), "bias": np.zeros((languages, 1))}
    for d in "fb":
        m |= {f"{d}in": rng.normal(0, 0.3, (3 * hidden, 256)), f"{d}rec": rng.normal(0, 0.4, (3 * hidden, hidden)), f"{d}cand": np.zeros((hidden, 1))}
    return {k: v.astype(np.float32) for k, v in m.items()}


def _step(m, d: str, h: np.ndarray, x: np.ndarray):
    """One unit's step for a batch: (new state, gates z and r, recurrent candidate part, candidate)."""
    n = h.shape[0]
    a, u = m[d + "in"].take(x, axis=1), m[d + "rec"] @ h
    zr = _sigmoid(a[: 2 * n] + u[: 2 * n])
    part = u[2 * n :]
    part += m[d + "cand"]
    c = zr[n:] * part
    c += a[2 * n :]
    c *= 2
    c = _sigmoid(c)
    c *= 2
    c -= 1  # tanh
    new = h - c
    new *= zr[:n]
    new += c
    return new, zr, part, c


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=0)
    np.exp(x, out=x)
    x /= x.sum(axis=0)
    return x


def window_sums(m, x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sum of the language probabilities over the bytes of each window; x: (width x windows) bytes, size: valid bytes."""
    hidden, (width, n) = m["frec"].shape[1], x.shape
    forward = np.empty((width, hidden, n), np.float32)
    h = np.zeros((hidden, n), np.float32)
    for t in range(width):
        h = _step(m, "f", h, x[t])[0]
        forward[t] = h
    h = np.zeros((hidden, n), np.float32)
    total = np.zeros((m["out"].shape[0], n), np.float32)
    for t in range(width - 1, -1, -1):
        valid = t < size
        h = _step(m, "b", h, x[t])[0]
        h *= valid  # a short window's backward reading starts at its last byte
        p = _softmax(m["out"][:, :hidden] @ forward[t] + m["out"][:, hidden:] @ h + m["bias"])
        p *= valid
        total += p
    return total


def gradients(m, x: np.ndarray, label: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss over all positions of full windows and its gradient, by backpropagation through time. With a weight for
    each window the gradient is that of the weighted sum of the windows' mean losses."""
    hidden, (width, n) = m["frec"].shape[1], x.shape
    states, kept = {}, {}
    for d, times in (("f", range(width)), ("b", range(width - 1, -1, -1))):
        h = np.zeros((hidden, n), m["frec"].dtype)
        states[d], kept[d] = np.empty((width, hidden, n), h.dtype), [None] * width
        for t in times:
            before = h
            h, zr, part, c = _step(m, d, h, x[t])
            states[d][t], kept[d][t] = h, (before, zr, part, c)
    both = np.concatenate([states["f"], states["b"]], axis=1)
    logits = np.einsum("ch,thn->ctn", m["out"], both) + m["bias"][:, :, None]
    p = _softmax(logits.reshape(len(logits), -1)).reshape(logits.shape)
    at = (label[None, :].repeat(width, 0), np.arange(width)[:, None], np.arange(n)[None, :])
    loss = float(-np.log(p[at] + 1e-12).mean())
    p[at] -= 1
    if weight is None:
        p /= width * n
    else:
        p *= weight / width
    g = {"out": np.einsum("ctn,thn->ch", p, both), "bias": p.sum(axis=(1, 2))[:, None]}
    back = np.einsum("ch,ctn->thn", m["out"], p)
    for d, times, part_of in (("f", range(width - 1, -1, -1), slice(0, hidden)), ("b", range(width), slice(hidden, None))):
        dh = np.zeros((hidden, n), back.dtype)
        da = np.empty((width, 3 * hidden, n), back.dtype)
        g[d + "rec"], g[d + "cand"] = np.zeros_like(m[d + "rec"]), np.zeros_like(m[d + "cand"])
        for t in times:
            before, zr, part, c = kept[d][t]
            z, r = zr[:hidden], zr[hidden:]
            dh = dh + back[t, part_of]
            dz = dh * (before - c) * z * (1 - z)
            dc = dh * (1 - z) * (1 - c * c)
            dr = dc * part * r * (1 - r)
            du = np.concatenate([dz, dr, dc * r])
            da[t] = np.concatenate([dz, dr, dc])
            g[d + "rec"] += du @ before.T
            g[d + "cand"] += (dc * r).sum(axis=1, keepdims=True)
            dh = dh * z + m[d + "rec"].T @ du
        flat, rows = x.ravel(), da.transpose(1, 0, 2).reshape(3 * hidden, -1)
        g[d + "in"] = np.stack([np.bincount(flat, weights=row, minlength=256) for row in rows])
    return loss, g


def _descend(m, mean, square, g, step: int, speed: float) -> None:
    """One step of Adam, in place."""
    norm = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
    for k, v in g.items():
        v = v / max(1.0, norm)
        mean[k] = 0.9 * mean[k] + 0.1 * v
        square[k] = 0.99 * square[k] + 0.01 * v * v
        m[k] = (m[k] - speed * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)


def started(samples: list[tuple[bytes, int]], languages: int, hidden: int = 8, width: int = 48, steps: int = 500, batch: int = 192,
            rate: float = 0.02, seed: int = 7) -> tuple[dict, dict, dict]:
    """(model, Adam's means and squares) after steps over random windows; each step takes the languages in equal shares."""
    rng = np.random.default_rng(seed)
    m = new_model(languages, hidden, seed)
    by = [[np.frombuffer(s.ljust(width), np.uint8) for s, k in samples if k == lang] for lang in range(languages)]
    mean, square = ({k: np.zeros(v.shape) for k, v in m.items()} for _ in range(2))
    for step in range(1, steps + 1):
        label = rng.integers(0, languages, batch)
        rows = []
        for lang in label:
            s = by[lang][rng.integers(len(by[lang]))]
            k = rng.integers(len(s) - width + 1)
            rows.append(s[k : k + width])
        _, g = gradients(m, np.stack(rows, axis=1), label)
        _descend(m, mean, square, g, step, rate * min(1.0, 2 * (1 - step / (steps + 1))))
    return m, mean, square


def train(samples: list[tuple[bytes, int]], languages: int, hidden: int = 8, steps: int = 500) -> dict[str, np.ndarray]:
    return started(samples, languages, hidden, steps=steps)[0]


def pooled(m, texts: list[bytes], width: int, block: int = 2048) -> np.ndarray:
    """Mean language probabilities of each non-empty text over all of its bytes."""
    sizes = np.array([len(t) for t in texts], np.int64)
    windows = -(-sizes // width)
    owner = np.repeat(np.arange(len(texts)), windows)
    nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    valid = np.minimum(width, sizes[owner] - nth * width)
    data = np.frombuffer(b"".join(texts) + bytes(width), np.uint8)
    start = (np.cumsum(sizes) - sizes)[owner] + nth * width
    total = np.zeros((len(texts), m["out"].shape[0]))
    for k in range(0, len(owner), block):
        part = slice(k, k + block)
        x = data[start[part] + np.arange(width)[:, None]]
        sums = window_sums(m, x, valid[part])
        for lang, row in enumerate(sums):
            total[:, lang] += np.bincount(owner[part], weights=row, minlength=len(texts))
    return total / np.maximum(sizes, 1)[:, None]


def judged(m, names: list[str], width: int, texts: list) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text."""
    known = [j for j, t in enumerate(texts) if names and t and LETTER.search(t)]
    lang, score = ["und"] * len(texts), np.zeros(len(texts))
    if known:
        p = pooled(m, [texts[j].encode() for j in known], width)
        for j, row in zip(known, p, strict=True):
            lang[j], score[j] = names[int(row.argmax())], min(1.0, float(row.max()))
    return lang, score


def _predictor(m, names: list[str], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                few = batch.slice(k, 256)
                lang, score = judged(m, names, width, few.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([few.column("id"), few.column("held_out"), pa.array(lang), pa.array(score)], names=["id", "held_out", "lang_pred", "score"])

    return run


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def familiar(alphabet: np.ndarray, texts: list) -> np.ndarray:
    """Share of each text's letters that are in the alphabet (code points); 0 without letters."""
    letter = per_worker("letters", _letters)
    known = np.zeros(len(letter), bool)
    known[alphabet] = True
    share = np.zeros(len(texts))
    for j, text in enumerate(texts):
        seen = np.bincount(_points(text)) if text else np.zeros(1, np.int64)
        at = np.flatnonzero(seen)
        at = at[letter[at]]
        share[j] = seen[at][known[at]].sum() / seen[at].sum() if len(at) else 0.0
    return share


def windows(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, the start of each window in them and its text; together the windows hold every byte. A text's last window ends
    with the text, a text shorter than a window is filled with blanks."""
    whole = [t.ljust(width) for t in texts]
    sizes = np.array([len(t) for t in whole], np.int64)
    count = -(-sizes // width)
    owner = np.repeat(np.arange(len(whole)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = (np.cumsum(sizes) - sizes)[owner] + np.minimum(nth * width, sizes[owner] - width)
    return np.frombuffer(b"".join(whole), np.uint8), start, owner


def _slopes(m, names: list[str], each: dict[str, float], width: int, block: int = 512):
    """Sums over a task's rows (lang, text): entries of the gradient, and its letters as entries without a value. All that
    backpropagation keeps of a block takes some 50 kB a window; a worker holds it until it ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: k for k, w in enumerate(names)}
        heavy = np.array([each.get(w, 0.0) for w in names], np.float32)
        total = {k: np.zeros(v.shape) for k, v in m.items()}
        seen: set[str] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                few = batch.slice(at, 256)
                texts = few.column(1).to_pylist()
                seen.update(*texts)
                label = np.array([place[w] for w in few.column(0).to_pylist()])
                data, start, owner = windows([t.encode() for t in texts], width)
                for k in range(0, len(owner), block):
                    of = label[owner[k : k + block]]
                    x = data[start[k : k + block] + np.arange(width)[:, None]]
                    for name, v in gradients(m, x, of, heavy[of])[1].items():
                        total[name] += v
        if not seen:
            return
        for name, v in total.items():
            yield pa.RecordBatch.from_pydict({"part": [name] * v.size, "at": np.arange(v.size, dtype=np.int32), "value": v.ravel()})
        letters = sorted(ord(c) for c in seen if c.isalpha())
        yield pa.RecordBatch.from_pydict({"part": ["letter"] * len(letters), "at": pa.array(letters, pa.int32()), "value": np.zeros(len(letters))})

    return run


def _learnable(lang: Column, ident: Column, text: Column) -> Column:
    """Whether a row may be learned from."""
    return F.coalesce(lang.isNotNull() & text.rlike(r"\p{L}") & ident.isNotNull() & (crc_mod4(ident) != 2), F.lit(False))


def learned(rows: DataFrame, per_language: int, hidden: int = 8, steps: int = 500, rate: float = 0.01, width: int = 48):
    """(model, language names, code points of the letters) from every learnable row of (id, text, lang)."""
    few = sample(rows, F.col("lang"), per_language)
    names = sorted({r.lang for r in few})
    if not names:
        return None, [], np.zeros(0, np.int64)
    m, mean, square = started([(bytes(r.snippet), names.index(r.lang)) for r in few], len(names), hidden, steps=steps)
    share = F.pmod(F.xxhash64("id", "text"), F.lit(SHARES))
    usable = rows.where(_learnable(F.col("lang"), F.col("id"), F.col("text"))).select(share.alias("share"), "lang", "text")
    counts: dict[int, dict[str, int]] = {}
    n_windows = F.greatest(F.ceil(F.octet_length("text") / width), F.lit(1))
    for r in usable.groupBy("share", "lang").agg(F.sum(n_windows).alias("n")).collect():
        counts.setdefault(r.share, {})[r.lang] = r.n
    letters: set[int] = set()
    for k, nth in enumerate(sorted(counts)):
        each = {w: 1 / (n * len(counts[nth])) for w, n in counts[nth].items()}
        sums = usable.where(F.col("share") == nth).select("lang", "text").mapInArrow(_slopes(m, names, each, width), "part string, at int, value double")
        g = {name: np.zeros(v.shape) for name, v in m.items()}
        for r in sums.groupBy("part", "at").agg(F.sum("value").alias("value")).collect():
            if r.part == "letter":
                letters.add(r.at)
            else:
                g[r.part].flat[r.at] = r.value
        _descend(m, mean, square, g, steps + k + 1, rate * (1 - k / len(counts)))
    return m, names, np.array(sorted(letters))


def _with_letter(text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([bool(t and LETTER.search(t)) for t in batch.column(text_at).to_pylist()], pa.bool_()))

    return run


def _scored(m, names: list[str], width: int, alphabet: np.ndarray):
    """Rows (sha, learned, text) with the score in place of the text; null without a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                few = batch.slice(k, 256)
                texts = few.column("text").to_pylist()
                lang, score = judged(m, names, width, texts)
                score = pa.array(score * familiar(alphabet, texts), mask=np.array([w == "und" for w in lang], bool))
                yield pa.RecordBatch.from_arrays([few.column("sha"), few.column("learned"), score], names=["sha", "learned", "score"])

    return run


def _snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, part = [], []
        for name, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            raw = text.encode()
            n = min(SNIPPETS, -(-len(raw) // SNIPPET))
            at = np.linspace(0, max(0, len(raw) - SNIPPET), n).astype(int).tolist()
            part += [raw[k : k + SNIPPET] for k in at]
            lang += [name] * n
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(part, pa.binary())], names=["lang", "snippet"])


def sample(docs: DataFrame, lang: Column, per_language: int) -> list:
    """(lang, snippet) of at most `per_language` learnable documents of each language."""
    rows = docs.where(_learnable(lang, F.col("id"), F.col("text"))).select("id", lang.alias("lang"), F.xxhash64("text").alias("h"), "text")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "h")
    chosen = rows.select("id", "lang", "h").distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_language).drop("r")
    texts = rows.join(F.broadcast(chosen), ["id", "lang", "h"]).groupBy("id", "lang", "h").agg(F.first("text").alias("text"))
    return texts.select("lang", "text").mapInArrow(_snippets, "lang string, snippet binary").orderBy("lang", "snippet").collect()


def _learn(rows: list, hidden: int = 8, steps: int = 500):
    names = sorted({r.lang for r in rows})
    if not names:
        return None, []
    return train([(bytes(r.snippet), names.index(r.lang)) for r in rows], len(names), hidden, steps=steps), names


def fit(docs: DataFrame, lang_col: str = "lang", per_language: int = 200, hidden: int = 8, steps: int = 500):
    """(model, language names)"""
    return _learn(sample(docs, F.col(lang_col), per_language), hidden, steps)


def predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", width: int = 96) -> DataFrame:
    """(id, held_out, lang_pred, score) for every row; learns from the same table."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model, names = fit(rows, "lang")
    kind = rows.schema["id"].dataType.simpleString()
    said = rows.select("id", F.coalesce(crc_mod4(F.col("id")) == 2, F.lit(False)).alias("held_out"), "text").mapInArrow(
        _predictor(model, names, width), f"id {kind}, held_out boolean, lang_pred string, score double"
    )
    return said.withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, per_language: int = 200, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", width: int = 96,
             few: int = 200_000) -> DataFrame:
    """The rows whose text is in a learned language, with all their columns. The scores of all rows are written under digests
    of their texts, as the least score that stays is known after the last one only. Up to `few` texts that go are broadcast,
    which leaves the rows where they are, more are met by a shuffle."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model, names, alphabet = learned(rows, per_language)
    if not names:
        return docs.mapInArrow(_with_letter(docs.columns.index(text_col)), docs.schema)
    may = _learnable(F.col(lang_col), F.col(id_col), F.col(text_col))
    sha = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    said = docs.select(sha.alias("sha"), may.alias("learned"), F.col(text_col).alias("text"))
    said = stored(said.mapInArrow(_scored(model, names, width, alphabet), "sha binary, learned boolean, score double"), "language-scores")
    least = said.where("learned").agg(F.min("score")).first()[0] or 0.0
    stays = F.coalesce(F.col("score") >= least / 2, F.lit(False))
    gone = stored(said.where(~stays).select(F.col("sha").alias("_gone_sha")).distinct(), "other-languages")
    return docs.join(F.broadcast(gone) if gone.count() <= few else gone.hint("shuffle_hash"), sha == gone["_gone_sha"], "left_anti")


@query("op9_language_id")
def op9_language_id(spark, sf_dir):
    return predict(table(spark, sf_dir, "documents"))
