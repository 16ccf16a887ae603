"""Token counts, token files, packing: against the tokenizers library text by text."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from brute import ROWS, frame
from leadlink.llm import packing, token_counts, token_orc
from leadlink.llm.bpe import Coder
from leadlink.session import fresh_path
from tokenizers import Tokenizer

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_cached_ids_are_the_library_s(path):
    rng = random.Random(3)
    signs = " \t\n  \r\x0b\x1c\x1f\x85\xa0abcXYZ'strevml012½²Àßéÿıİſŉ–—’“”€…•.,!?$%|<>中한́　Σσς"
    coder, plain = Coder(path, cache=200), Tokenizer.from_file(path)
    texts = ["".join(rng.choice(signs[: 60 if k % 2 else None]) for _ in range(rng.randint(0, 40))) + "<|endoftext|>" * (k % 40 == 0) for k in range(3000)]
    texts += ["it's we'll I'd 'S 'quoted' don't", "   a   b  ", "\n\n x\n", "A" * 5000, "x " * 3000]
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert coder.encode(texts) == want


def test_words_met_again_stay_known():
    """Fresh words fill the cache over and over; those of every text are encoded once, and all ids are the library's."""
    coder, rng, plain = Coder(WORD, cache=1000), random.Random(4), Tokenizer.from_file(WORD)
    asked, encode = Counter(), coder.words.encode_words
    coder.words.encode_words = lambda words: asked.update(words.split(" ") if isinstance(words, str) else words) or encode(words)
    common = ["".join(rng.choices("abcdeéß", k=9)) for _ in range(500)]
    for _ in range(14):
        words = common + ["".join(rng.choices("fghijklmnoÿ", k=12)) for _ in range(700)]
        rng.shuffle(words)
        text = " ".join(words)
        assert coder.encode([text]) == [np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
    assert max(asked[w] for w in common) == 1


def test_every_latin_byte_ends_a_word():
    signs = [chr(c) for c in range(1, 256)]
    texts = [" ".join(a + b + c for b in signs) for a in "xé7¿" for c in ("", "y", "÷", "®")] + ["w" * 256 + " v", "w" * 257 + " v", ""]
    plain = Tokenizer.from_file(WORD)
    assert Coder(WORD).encode(texts) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_counts(spark):
    got = token_counts.count_tokens(frame(spark), BYTE, max_tokens=30, table_size=5, cache=20).collect()
    want = sorted((repr(i), len((t or "").encode()), n := len(ids_of(BYTE, t)), n > 30) for i, t, _ in ROWS)
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_counts_of_nothing(spark):
    assert token_counts.count_tokens(frame(spark, []), BYTE).collect() == []


def orc_want(rows, end):
    at = 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*ids_of(WORD, t), end]
        yield (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_orc_round_trip(spark):
    path = fresh_path(spark, "orc")
    token_orc.write(frame(spark), path, WORD, 2)
    for small in (0, 100):
        got = token_orc.checksums(token_orc.read(spark, path, small)).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(orc_want([r[:2] for r in ROWS], 2), key=repr)
    assert [r.n_tokens for r in token_orc.lookup(spark, path, [8]).collect()] == [len(ids_of(WORD, "short text")) + 1]


def test_orc_keeps_order_indexes_and_bloom_filters(spark, sf):
    path = fresh_path(spark, "orc")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one file
    try:
        token_orc.write(spark.read.parquet(f"{sf}/documents.parquet"), path, WORD, 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    names = sorted(f.getPath().toString() for f in root.getFileSystem(conf).listStatus(root) if f.getPath().getName().endswith(".orc"))
    highest, kinds = -1, set()
    for name in names:
        reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(name), jvm.org.apache.orc.OrcFile.readerOptions(conf))
        ids = reader.getStatistics()[1]  # of the first column
        assert ids.getMinimum() > highest
        highest = ids.getMaximum()
        rows = reader.rows()
        kinds |= {s.getKind().toString() for s in rows.readStripeFooter(reader.getStripes()[0]).getStreamsList()}
        rows.close()
    assert len(names) > 1 and {"ROW_INDEX", "BLOOM_FILTER_UTF8"} <= kinds
    plan = token_orc.lookup(spark, path, [3])._jdf.queryExecution().toString()
    assert "PushedFilters: [In(doc_id" in plan or "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id" in plan


def test_orc_of_nothing(spark):
    path = fresh_path(spark, "orc")
    token_orc.write(frame(spark, []), path, WORD, 2)
    assert token_orc.checksums(token_orc.read(spark, path)).collect() == []


def check_pieces(got, rows, end, limit):
    """Every id in exactly one piece; sequences without gaps, full or a power of two long."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
        documents[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == limit or at & (at - 1) == 0
    want = defaultdict(list)
    for i, t in rows:
        want[i].append(np.array([*ids_of(WORD, t), end], "<u4"))
    assert set(documents) == set(want)
    for i, pieces in documents.items():
        left = sorted(pieces)
        for ids in want[i]:  # rows with equal ids are told apart by following the pieces
            at = 0
            while at < len(ids):
                n = next(n for s, n, crc, total in left if s == at and total == len(ids) and crc == zlib.crc32(ids[at : at + n].tobytes()))
                left.remove((at, n, zlib.crc32(ids[at : at + n].tobytes()), len(ids)))
                at += n
        assert not left


def test_packing(spark):
    for shard_docs in (3, 2048):
        got = packing.pack(frame(spark), WORD, 1, limit=64, shard_docs=shard_docs).collect()
        check_pieces(got, [r[:2] for r in ROWS], 1, 64)
    assert packing.pack(frame(spark, []), WORD, 1).collect() == []


def test_neighbours_are_ranked_by_bm25():
    docs = [np.array(d) for d in ([5, 6, 7], [5, 9], [6, 7, 7, 8], [1, 2], [5, 6, 7, 8, 9, 9, 9])]
    seen = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=10)
    idf = np.log(1 + (5 - seen + 0.5) / (seen + 0.5))
    mean = np.mean([len(d) for d in docs])
    shard = packing.Shard(docs, idf, mean, terms=24)

    def score(d):
        return sum(idf[t] * (f := (d == t).sum()) * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(d) / mean)) for t in (5, 6, 7))

    shard.unused[0] = False
    want = sorted((k for k in (1, 2, 4)), key=lambda k: -score(docs[k]))
    assert shard.neighbours(0, 16) == want
    shard.unused[want[0]] = False
    assert shard.neighbours(0, 1) == want[1:2]


def test_related_documents_share_sequences(spark):
    topics = [[f"{a}{k}" for k in range(40)] for a in ("alpha", "beta", "gamma", "delta")]
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choices(topics[k % 4], k=30)), "en") for k in range(200)]
    got = packing.pack(frame(spark, rows), WORD, 1, limit=256).collect()
    mates = defaultdict(set)
    for r in got:
        mates[r.sequence_id].add(r.doc_id % 4)
    assert np.mean([len(m) for m in mates.values()]) < 2


def test_short_neighbours_fill_the_window():
    """Two kinds alternate in key order; the 99 others of the seed's kind come before the first of the other kind."""
    docs = [np.array([5, 6 + k % 2, 9]) for k in range(200)]
    packer = packing.Packer(256, 0)
    packing.pack_shard(packer, [], list(range(200)), docs, packing.Shard(docs, np.ones(10), 3.0))
    order = [r[0] % 2 for r in packer.rows]
    assert sum(a != b for a, b in zip(order, order[1:], strict=False)) == 1


def test_every_term_of_a_long_seed_counts():
    """Two documents share a seed's common terms, one more of them; a third only has one rare term of it."""
    docs = [np.arange(100), np.arange(40, 100), np.arange(50, 100), np.array([0, 200])]
    idf = np.full(300, 1.0)
    idf[:40] = 2.0
    shard = packing.Shard(docs, idf, 50.0)
    shard.unused[0] = False
    assert shard.neighbours(0)[:2] == [1, 2] and sorted(shard.neighbours(0)) == [1, 2, 3]


def test_a_shard_gives_all_neighbours_in_order():
    docs = [np.array([5, *range(10, 10 + k % 7)]) for k in range(60)]
    shard = packing.Shard(docs, np.full(30, 1.0), 4.0)
    shard.unused[0] = False
    got = shard.neighbours(0)
    assert sorted(got) == list(range(1, 60)) and got == sorted(got, key=lambda k: (len(docs[k]), k))


def test_lists_without_used_documents_rank_alike():
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 200, rng.integers(5, 60)) for _ in range(300)]
    idf = rng.random(200) + 0.1
    shard, whole = packing.Shard(docs, idf, 30.0), packing.Shard(docs, idf, 30.0)
    for seed in rng.permutation(300)[:250].tolist():
        shard.unused[seed] = whole.unused[seed] = False
        whole.asked = 0
        assert shard.neighbours(seed) == whole.neighbours(seed)
    assert shard.held < whole.held == 300
