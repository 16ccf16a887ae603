"""Lexical retrieval packing: related documents share training sequences.

1. Every text is encoded once; the ids (two bytes each where the vocabulary allows) go to the shared folder.
2. Document frequencies of all token ids over all documents: one row per id, bounded by the vocabulary.
3. Documents are range-partitioned by (lexical key, id), so that texts with the same rare token meet and a key shared by
   many documents is still split between tasks. Inside a task, runs of at most `shard_docs` documents and about
   `shard_tokens` ids form a shard with a BM25 inverted index over token ids, built with the global frequencies.
4. Each sequence has a seed document. All its terms query the shard's index; the unused documents that share one follow
   the seed, best first, until the sequence is full or none is left. The document cut at the end seeds the next sequence, so sequences have no gaps. What
   is left open at the end of a shard goes on in the next shard of the task, and what a task has left at its very end
   is cut into sequences of powers of two, which need no padding. There is no padding at all.

Defined cases: a null text counts as empty and is its end id alone; rows with equal ids are packed one by one (their
pieces are told apart by their places); a null id is packed and stays null; a text of any length is cut freely; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlink.llm.bpe import coder
from leadlink.llm.common import ship, table
from leadlink.llm.registry import query
from leadlink.session import fresh_path

ship(__name__)

FIELDS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _tokeniser(path: str, end_id: int, kind: str, vocabulary: int):
    spread = np.random.default_rng(11).permutation(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                few = batch.slice(k, 1024)
                ids = [np.frombuffer(x + end, "<u4") for x in coder(path).encode([t or "" for t in few.column("text").to_pylist()])]
                rare = [x[x >= vocabulary // 2] for x in ids]
                keys = [int(spread[r if len(r) else x].min()) for r, x in zip(rare, ids, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [few.column("id"), pa.array(keys, pa.int32()), pa.array([x.astype(kind).tobytes() for x in ids], pa.binary())], names=["id", "key", "ids"]
                )

    return run


def _frequencies(kind: str, vocabulary: int):
    """(term, documents with it) of a task's documents; term -1 counts documents, term -2 ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, docs, ids = np.zeros(vocabulary, np.int64), 0, 0
        for batch in batches:
            for raw in batch.column("ids").to_pylist():
                x = np.sort(np.frombuffer(raw, kind), kind="stable")  # a radix sort for two-byte ids
                seen[x[np.flatnonzero(x[1:] != x[:-1])]] += 1
                seen[x[-1]] += 1  # the end id makes sure of one
                docs, ids = docs + 1, ids + len(x)
        terms = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-1, -2], terms]).astype(np.int32)), pa.array(np.concatenate([[docs, ids], seen[terms]]))], names=["term", "n"]
        )

    return run


class Shard:
    """BM25 inverted index over the documents of one shard.

    A term of `dense` of the documents or more has no list: the scores that such terms give to all pairs of documents are one
    matrix product, made when the shard is built. Rarer terms are looked up in their lists for each seed.
    """

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float, terms: int | None = None, k1: float = 1.2, b: float = 0.75,
                 dense: float = 0.15):
        sizes = np.array([len(d) for d in docs])
        code = np.repeat(np.arange(len(docs), dtype=np.uint64), sizes) * np.uint64(len(idf)) + np.concatenate(docs)
        if len(docs) * len(idf) < 1 << 32:
            code = code.astype(np.uint32)
        pair, tf = np.unique(code, return_counts=True)
        doc, term = (pair // len(idf)).astype(np.int64), (pair % len(idf)).astype(np.int64)
        weight = idf[term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * sizes[doc] / mean_length))
        self.terms, self.idf, self.common = terms, idf, None
        if terms is None:
            count = np.bincount(term, minlength=len(idf))
            column = np.cumsum(often := count >= max(2, dense * len(docs))) - 1
            inside = often[term]
            if inside.any():
                held = np.zeros((len(docs), int(often.sum())), np.float32)
                gives = held.copy()
                held[doc[inside], column[term[inside]]] = 1
                gives[doc[inside], column[term[inside]]] = weight[inside]
                self.common = held @ gives.T  # (seed, document)
            doc, term, weight = doc[~inside], term[~inside], weight[~inside]
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order].astype(np.float64)
        self.begin = np.searchsorted(term[order], np.arange(len(idf) + 1))
        self.count = np.diff(self.begin)
        self.unused = np.ones(len(docs), bool)
        self.least, self.held, self.asked = 1, len(docs), 0
        self.term, self.first = term, np.searchsorted(doc, np.arange(len(docs) + 1))

    def _drop_used(self) -> None:
        """Take used documents out of the lists."""
        live = self.unused[self.doc]
        self.doc, self.weight = self.doc[live], self.weight[live]
        self.begin = np.concatenate([[0], np.cumsum(live)])[self.begin]
        self.count, self.least, self.held = np.diff(self.begin), 0, int(self.unused.sum())

    def neighbours(self, seed: int, most: int | None = None) -> list[int]:
        """Unused documents that share terms with the seed, best first; all of them, or the best `most`."""
        return list(islice(self.ranked(seed), most))

    def ranked(self, seed: int) -> Iterator[int]:
        """The same one by one, sorted in pieces: a seed seldom needs more than a few."""
        self.asked += 1
        if self.asked % 16 == 0 and self.unused.sum() < 0.85 * self.held:
            self._drop_used()
        own = self.term[self.first[seed] : self.first[seed + 1]]
        own = own[self.count[own] > self.least]  # the seed itself is in the lists until used documents are dropped
        if self.terms is not None and len(own) > self.terms:
            own = own[np.argpartition(self.idf[own], len(own) - self.terms)[-self.terms :]]
        score = np.zeros(len(self.unused)) if self.common is None else self.common[seed].astype(np.float64)
        if len(own):
            parts = [slice(a, z) for a, z in zip(self.begin[own].tolist(), self.begin[own + 1].tolist(), strict=True)]
            score += np.bincount(np.concatenate([self.doc[p] for p in parts]), np.concatenate([self.weight[p] for p in parts]), len(self.unused))
        found = np.flatnonzero(self.unused & (score > 0))
        score = score[found]
        while len(found):
            near = score >= -np.partition(-score, 31)[31] if len(found) > 64 else np.ones(len(found), bool)
            yield from found[near][np.argsort(-score[near], kind="stable")].tolist()
            found, score = found[~near], score[~near]


class Packer:
    """Fills one sequence after the other; rows are (doc, start, length, crc, doc tokens, sequence, offset)."""

    def __init__(self, limit: int, first: int):
        self.limit, self.sequence, self.at, self.rows = limit, first, 0, []

    def put(self, doc, ids: np.ndarray, start: int) -> int:
        """Place ids[start:] as far as the sequence goes; where the rest starts."""
        n = min(self.limit - self.at, len(ids) - start)
        piece = ids[start : start + n].astype("<u4").tobytes()
        self.rows.append((doc, start, n, zlib.crc32(piece), len(ids), self.sequence, self.at))
        self.at += n
        if self.at == self.limit:
            self.sequence, self.at = self.sequence + 1, 0
        return start + n

    def close(self, ids_of) -> None:
        """Cut the open sequence into sequences of powers of two; ids_of: pieces of it by (start, length)."""
        open_rows = [r for r in self.rows if r[5] == self.sequence]
        self.rows = [r for r in self.rows if r[5] != self.sequence]
        left, room, at = self.at, 0, 0
        sequence = self.sequence - 1
        for doc, start, n, _, total, _, _ in open_rows:
            ids = ids_of.pop(0)
            done = 0
            while done < n:
                if room == 0:
                    room = 1 << (left.bit_length() - 1)
                    left, at, sequence = left - room, 0, sequence + 1
                take = min(room, n - done)
                self.rows.append((doc, start + done, take, zlib.crc32(ids[done : done + take].astype("<u4").tobytes()), total, sequence, at))
                done, room, at = done + take, room - take, at + take
        self.sequence, self.at = sequence + 1, 0


def pack_shard(packer: Packer, open_ids: list, names: list, docs: list[np.ndarray], shard: Shard) -> None:
    """Pack every document of a shard; open_ids: the ids of the pieces in the sequence that is still open."""

    def put(k: int, start: int) -> int:
        end = packer.put(names[k], docs[k], start)
        if packer.at == 0:
            open_ids.clear()
        else:
            open_ids.append(docs[k][start:end])
        return end

    for k in range(len(docs)):
        if not shard.unused[k]:
            continue
        seed, start = k, 0
        while seed is not None:
            shard.unused[seed] = False
            start = put(seed, start)
            while start < len(docs[seed]):  # a long document fills sequences alone
                start = put(seed, start)
            rest = None
            if packer.at:
                for other in shard.ranked(seed):
                    shard.unused[other] = False
                    end = put(other, 0)
                    if packer.at == 0:
                        rest = (other, end) if end < len(docs[other]) else None
                        break
            seed, start = rest if rest is not None else (None, 0)


def _packer(kind: str, idf: np.ndarray, mean_length: float, limit: int, shard_docs: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer, open_ids = Packer(limit, TaskContext.get().partitionId() << 40), []
        names, docs, held, seen_type = [], [], 0, None

        def settle():
            pack_shard(packer, open_ids, names, docs, Shard(docs, idf, mean_length))
            names.clear()
            docs.clear()

        def out(rows):
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], seen_type), *(pa.array(c, pa.int64()) for c in columns[1:])], names=["id", *FIELDS])

        for batch in batches:
            seen_type = batch.column("id").type
            for name, raw in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                names.append(name)
                docs.append(np.frombuffer(raw, kind))
                held += len(docs[-1])
                if len(docs) >= shard_docs or held >= shard_tokens:
                    settle()
                    held = 0
                    done = [r for r in packer.rows if r[5] != packer.sequence]
                    packer.rows = [r for r in packer.rows if r[5] == packer.sequence]
                    if done:
                        yield out(done)
        if docs:
            settle()
        packer.close(open_ids)
        if packer.rows:
            yield out(packer.rows)

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, limit: int = 2048, shard_docs: int = 2048, shard_tokens: int = 4_000_000,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece."""
    spark = docs.sparkSession
    with open(tokenizer) as f:
        spec = json.load(f)
    vocabulary = 1 + max(end_id, *spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"]))
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    key_type = rows.schema["id"].dataType.simpleString()
    path = fresh_path(spark, "tokens")
    schema = f"id {key_type}, key int, ids binary"
    rows.mapInArrow(_tokeniser(tokenizer, end_id, kind, vocabulary), schema).write.option("compression", "zstd").parquet(path)
    coded = spark.read.schema(schema).parquet(path)
    counts = dict(coded.select("ids").mapInArrow(_frequencies(kind, vocabulary), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect())
    total, ids = counts.pop(-1, 0), counts.pop(-2, 0)
    seen = np.zeros(vocabulary)
    seen[list(counts)] = list(counts.values())
    idf = np.log(1 + (total - seen + 0.5) / (seen + 0.5)).astype(np.float32)
    work = _packer(kind, idf, ids / max(total, 1), limit, shard_docs, shard_tokens)
    ordered = coded.repartitionByRange("key", "id").sortWithinPartitions("key", "id", "ids").select("id", "ids")
    return ordered.mapInArrow(work, f"id {key_type}, " + ", ".join(f"{c} long" for c in FIELDS)).withColumnRenamed("id", id_col)


@query("op5_packing")
def op5_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
