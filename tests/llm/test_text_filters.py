"""Decontamination and pseudonyms, against brute force."""

import datetime
import hashlib
import itertools
import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
from brute import ROWS, contaminated, frame, tokens
from leadlink.llm import common, decontaminate, pii


def items(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], "item_id long, text string, id string, t string, no string")


def test_masks_hit_every_pattern_of_substitutions():
    for size, bad in ((15, 3), (20, 4)):
        for wrong in itertools.combinations(range(size), bad):
            wrong = set(wrong)
            assert any(all(p + o not in wrong for o in m) for m in decontaminate.MASKS for p in range(size - m[-1]))


def cases(seed=4):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 300)}"
    tests = [(k, " ".join(word() for _ in range(rng.randint(5, 60)))) for k in range(12)] + [(50, None), (51, ""), (52, "a b c d e f g h i j k")]
    docs = []
    for k in range(120):
        body = [word() for _ in range(rng.randint(0, 60))]
        if k % 3:
            piece = tokens(rng.choice(tests[:12])[1])
            if k % 4 == 0:
                piece = piece[rng.randrange(len(piece)) :]
            for _ in range(rng.randint(0, len(piece) // 4)):
                piece[rng.randrange(len(piece))] = word()
            at = rng.randint(0, len(body))
            body[at:at] = piece
        docs.append((k, rng.choice([" ", ", ", "\n"]).join(body).title(), "en"))
    return docs, tests


def test_overlaps(spark):
    docs, tests = cases()
    tests.append((99, tests[0][1]))  # the same item again
    want = contaminated([d[:2] for d in docs], tests)
    for small in (10**6, 0):
        got = decontaminate.overlaps(frame(spark, docs), items(spark, tests), small=small).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) > 40
    kept = {r.doc_id for r in decontaminate.remove(frame(spark, docs), items(spark, tests)).collect()}
    assert kept == {d[0] for d in docs} - {d for d, _ in want}


def test_overlaps_defined_cases(spark):
    tests = [(1, " ".join(ROWS[0][1].split()[3:20])), (2, None), (3, "too short")]
    for small in (10**6, 0):
        got = decontaminate.overlaps(frame(spark), items(spark, tests), small=small).collect()
        assert sorted([(r.doc_id, r.item_id) for r in got], key=repr) == [(1, 1), (2, 1), (3, 1), (None, 1)]
    assert decontaminate.overlaps(frame(spark, []), items(spark, tests)).collect() == []
    assert decontaminate.overlaps(frame(spark), items(spark, [])).collect() == []


def test_remove_leaves_texts_where_they_are(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = [(1, item, "en"), (2, "other " * 12, "en"), (None, item, "en"), (None, "kept " * 12, "en"), (1, None, "en")]
    for few, moved in ((200_000, False), (0, True)):
        rest = decontaminate.remove(frame(spark, docs), items(spark, [(1, item)]), few=few)
        assert ("LeftAnti" in (plan := rest._jdf.queryExecution().executedPlan().toString())) and ("Exchange hashpartitioning" in plan) == moved
        assert sorted((r.doc_id or 0, r.text or "") for r in rest.collect()) == [(0, "kept " * 12), (1, ""), (2, "other " * 12)]


def test_remove_takes_only_contaminated_texts(spark):
    item = " ".join(f"q{k}" for k in range(20))
    hit, clean = f"before {item} after", "some clean words " * 10
    docs = [(None, hit), (None, clean), (None, None), (1, hit), (1, clean), (2, clean), (3, hit), (3, hit), (None, clean)]
    for small in (10**6, 0):
        got = decontaminate.remove(frame(spark, [(*d, "en") for d in docs]), items(spark, [(1, item)]), small=small).collect()
        assert sorted([(r.doc_id, r.text) for r in got], key=repr) == sorted([d for d in docs if d[1] != hit], key=repr)


KEY = "k1"


def part(kind, r, x):
    return int(hashlib.sha256(f"{KEY}|{kind}|{r}|{x}".encode()).hexdigest()[:12], 16)


def feistel(kind, x, y, a, b):
    for r in range(8):
        if r % 2 == 0:
            x = (x + part(kind, r, y)) % a
        else:
            y = (y + part(kind, r, x)) % b
    return x, y


def unfeistel(kind, x, y, a, b):
    for r in reversed(range(8)):
        if r % 2 == 0:
            x = (x - part(kind, r, y)) % a
        else:
            y = (y - part(kind, r, x)) % b
    return x, y


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else int(c) * 2 % 10 + int(c) // 5 for k, c in enumerate(reversed(digits))) % 10 == 0


def mod97(iban):
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def masked(spark, texts):
    rows = spark.createDataFrame([(k, t, "x", "x") for k, t in enumerate(texts)], "doc_id long, text string, found string, new string").repartition(3)
    return [(r.text, r.n_masked) for r in pii.mask(rows, KEY).orderBy("doc_id").collect()]


def test_cards_validate_and_can_be_inverted(spark):
    rng = random.Random(2)
    cards = []
    while len(cards) < 60:
        c = "".join(rng.choices("0123456789", k=rng.choice([13, 15, 16, 19])))
        if luhn(c):
            cards.append(c)
    out = masked(spark, [f"card {c}, again {c}!" for c in cards])
    news = []
    for c, (text, n) in zip(cards, out, strict=True):
        a, b = re.findall(r"\d+", text)
        assert a == b and luhn(a) and len(a) == len(c) and n == 2 and a != c
        h = (len(c) - 1) // 2
        x, y = unfeistel("card", int(a[:h]), int(a[h:-1]), 10**h, 10 ** (len(c) - 1 - h))
        assert f"{x:0{h}d}{y:0{len(c) - 1 - h}d}" == c[:-1]
        news.append(a)
    assert len(set(news)) == len(set(cards))


def test_formats(spark):
    out = masked(spark, [
        "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111111", "1.2.3.4 and 255.255.0.1. not 256.1.1.1 nor 1.2.3.4.5", "SSN 123-45-6789, 000-12-3456, 666-12-3456",
        "+1 (017) 555-7713 (017) 555-7713 017-555-7713", "GB82 WEST 1234 5698 7654 32, DE89370400440532013000, DE88370400440532013000",
        "2024-02-29 29.02.2024 29/2/2024 2/29/2024 2023-02-29 1899-12-31", "Ab.c9@Mail7.example.com ab.c9@mail7.example.com", "4111111111111112 a1b2 12345 3.14", "", None,
    ])
    digits = lambda s: re.sub(r"\D", "", s)
    cards, n = out[0]
    assert n == 3 and cards[4] == cards[9] == cards[14] == " " and cards[24] == "-" and digits(cards[:19]) == digits(cards[20:39]) == cards[40:] and luhn(cards[40:])
    ip, n = out[1]
    x, y = feistel("ip", 258, 772, 65536, 65536)
    assert n == 2 and ip.startswith(f"{x >> 8}.{x & 255}.{y >> 8}.{y & 255} and ") and ip.endswith("not 256.1.1.1 nor 1.2.3.4.5")
    ssn, n = out[2]
    assert n == 1 and ssn.endswith("000-12-3456, 666-12-3456") and re.match(r"SSN \d{3}-\d\d-\d{4}, ", ssn) and "123-45-6789" not in ssn
    phone, n = out[3]
    assert n == 3 and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4} \(\d{3}\) \d{3}-\d{4} \d{3}-\d{3}-\d{4}", phone)
    assert digits(phone)[1:11] == digits(phone)[11:21] == digits(phone)[21:] != "0175557713"
    iban, n = out[4]
    a, b, c = iban.split(", ")
    assert n == 2 and mod97(a) == mod97(b) == 1 and a[:2] == "GB" and a[5:9] == "WEST" and c == "DE88370400440532013000"
    dates, n = out[5]
    order = (datetime.date(2024, 2, 29) - datetime.date(1900, 1, 1)).days
    x, y = feistel("date", order // 229, order % 229, 319, 229)
    d = datetime.date(1900, 1, 1) + datetime.timedelta(x * 229 + y)
    assert n == 4 and dates.split()[0] == d.isoformat() and dates.split()[1] == d.strftime("%d.%m.%Y") and dates.endswith(" 2023-02-29 1899-12-31")
    assert dates.split()[2:4] == [f"{d:%d}/{d.month}/{d.year}", f"{d.month}/{d:%d}/{d.year}"]
    mail, n = out[6]
    one, two = mail.split()
    assert n == 2 and one.lower() == two and re.fullmatch(r"[A-Z][a-z]\.[a-z]\d@[A-Z][a-z]{3}\d\.[a-z]{7}\.com", one) and two != "ab.c9@mail7.example.com"
    assert out[7] == ("4111111111111112 a1b2 12345 3.14", 0) and out[8] == ("", 0) and out[9] == (None, 0)


def test_mask_leaves_all_else(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.mask(docs).collect():
        if r.n_masked == 0:
            assert r.text == before[r.doc_id]
        else:
            assert re.sub(r"[A-Za-z0-9]", "", r.text) == re.sub(r"[A-Za-z0-9]", "", before[r.doc_id]) or "@" in r.text or re.search(r"\d\.\d", r.text)


def test_mask_defined_cases(spark):
    got = pii.mask(frame(spark)).collect()
    assert sorted([(r.doc_id, r.text) for r in got], key=repr) == sorted([r[:2] for r in ROWS], key=repr)
    assert pii.mask(frame(spark, [])).collect() == []


def test_adjacent_values(spark):
    bban = "WEST 1234 5698 7654 32"
    unlisted = f"XX{98 - mod97('XX00' + bban):02d} {bban}"
    values = [
        "a@b.example", "12@b.example", "190.137.223.204", "2024-05-01", "29.02.2024", "2/29/2024", "123-45-6789", "+1 (826) 555-4081", "+18265554081", "+1 555 0199",
        "+33 6 12 34 56 78", "+44 (0)20 7946 0958", "+49 30 1234567", "+49 30 4946 0958", "(017) 555-7713", "017-555-7713", "4111 1111 1111 1111", "4111111111111111", "3782 822463 10005",
        "AT611904300234573201", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "NO93 8601 1117 947", unlisted,
    ]
    alone = dict(zip(values, masked(spark, values), strict=True))
    assert all(n == 1 and t != v for v, (t, n) in alone.items())
    pairs = [(a, sep, b) for a in values for b in values for sep in (" ", ", ", "\n", ",", ";", "|", "\t")]
    out = masked(spark, ["".join(p) for p in pairs])
    wrong = [(p, got) for p, got in zip(pairs, out, strict=True) if got != (alone[p[0]][0] + p[1] + alone[p[2]][0], 2)]
    assert not wrong
    tails = [(v, t) for v in ("+1 (826) 555-4081", "+33 6 12 34 56 78", "AT611904300234573201", "GB82 WEST 1234 5698 7654 32", unlisted) for t in (" 2024", " 12 345", " ABCD", " PART 12")]
    out = masked(spark, [v + t for v, t in tails])
    assert [(v, t, o) for (v, t), o in zip(tails, out, strict=True) if o != (alone[v][0] + t, 1)] == []


def test_hostile_texts_do_not_overflow(spark):
    texts = ["x@" + "a." * 200_000 + "com", "x@" + "a-" * 200_000, "+1" + " 555" * 100_000, "1." * 300_000, "4111 " * 100_000, "AT61 " * 100_000, "a@b." * 100_000]
    assert len(masked(spark, texts)) == len(texts)
    assert masked(spark, ["5,190.1.2.3"])[0][1] == 1


def test_scans_of_texts_keep_little_outside_the_heap(spark, tmp_path):
    """No buffer outside the heap is as large as the texts of a row group, and a batch holds few rows."""
    rng = random.Random(3)
    item = "nine words of a small benchmark item for this test"
    texts = [rng.randbytes(100_000).hex() for _ in range(320)] + [f"before {item} after"]
    (tmp_path / "documents.parquet").mkdir()
    rows = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts})
    pq.write_table(rows, tmp_path / "documents.parquet/0.parquet", compression="none", use_dictionary=False, row_group_size=len(texts))
    (tmp_path / "benchmark.parquet").mkdir()
    pq.write_table(pa.table({"item_id": ["i"], "text": [item]}), tmp_path / "benchmark.parquet/0.parquet")

    def outside() -> int:
        beans = spark._jvm.java.lang.management.ManagementFactory.getPlatformMXBeans(spark._jvm.java.lang.Class.forName("java.lang.management.BufferPoolMXBean"))
        return next(b.getMemoryUsed() for b in beans if b.getName() == "direct")

    for key in (*common.TEXT_BATCHES, common.RANGES):
        spark.conf.unset(key)
    before = outside()
    got = decontaminate.op4_decontaminate(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [(320, "i", 1, 10, 10)]
    assert outside() - before < 40_000_000
    assert {key: int(spark.conf.get(key)) for key in common.TEXT_BATCHES} == common.TEXT_BATCHES
    for key in (*common.TEXT_BATCHES, common.RANGES):
        spark.conf.unset(key)
