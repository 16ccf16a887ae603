"""Token counts of whole texts by a two-tier lookup on the map side; no pre-token is ever shuffled.

Tier one is a broadcast table of frequent pre-tokens and their token counts, `table_size` entries at most (a few MB),
gathered from about `sample_docs` documents: it only saves work, every count is exact whatever it holds. Tier two is
a bounded cache in each Python worker, filled by encoding the pre-tokens that tier one misses. Texts with characters or
strings that the splitting rule doesn't cover are encoded whole by the tokenizers library.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); a text that contains a special token's string counts it
as the library's default does; rows that repeat stay as they are; null ids stay null; an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlink.llm.bpe import Coder, coder
from leadlink.llm.common import per_worker, ship, table
from leadlink.llm.registry import query

ship(__name__)


def _frequent(path: str, size: int):
    """Counts of the commonest pre-tokens of a task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                count.update(coder(path).pieces(text or "") or ())
        top = count.most_common(size)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"])

    return run


def frequent_lengths(docs: DataFrame, path: str, table_size: int, sample_docs: int) -> dict[str, int]:
    """Pre-token -> token count for the commonest pre-tokens of a bounded sample."""
    share = min(1.0, sample_docs / max(1, docs.count()))  # a limit would send that many rows of each partition to one task
    some = docs.select("text").where("text IS NOT NULL").sample(share, 7)
    rows = some.mapInArrow(_frequent(path, table_size), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    pieces = [r.piece for r in rows.orderBy(F.desc("n"), "piece").limit(table_size).collect()]
    return dict(zip(pieces, Coder(path).lengths(pieces), strict=True)) if pieces else {}


class _Lengths:
    """Both tiers of one worker."""

    def __init__(self, path: str, cache: int):
        self.coder, self.limit, self.seen = coder(path), cache, {}

    def counts(self, texts: list[str], frequent: dict[str, int]) -> list[int]:
        out = []
        for k in range(0, len(texts), 256):
            cut = [self.coder.pieces(t) for t in texts[k : k + 256]]
            wanted = set().union(*(p for p in cut if p is not None)) - frequent.keys()
            missing = list(wanted - self.seen.keys())
            if len(self.seen) + len(missing) > self.limit:
                self.seen, missing = {}, list(wanted)
            for j in range(0, len(missing), 20_000):
                part = missing[j : j + 20_000]
                self.seen.update(zip(part, self.coder.lengths(part), strict=True))
            for text, parts in zip(texts[k : k + 256], cut, strict=True):
                if parts is None:
                    out.append(len(self.coder.tokenizer.encode(text, add_special_tokens=False).ids))
                else:
                    first = [frequent.get(p) for p in parts]
                    if None in first:
                        first = [self.seen[p] if n is None else n for n, p in zip(first, parts, strict=True)]
                    out.append(sum(first))
        return out


def _counter(path: str, frequent, cache: int, id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiers = per_worker(("lengths", path), lambda: _Lengths(path, cache))
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                texts = [t or "" for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("n_bytes"), pa.array(tiers.counts(texts, frequent.value), pa.int64())],
                    names=[id_col, "n_bytes", "n_tokens"],
                )

    return run


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 1024,
                 table_size: int = 1 << 16, sample_docs: int = 4096, cache: int = 400_000) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text")
    )
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(rows, path, table_size, sample_docs))
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(_counter(path, frequent, cache, id_col), f"`{id_col}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > max_tokens)


@query("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
