"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

#: Every awkward row: null and empty texts, no letters, few words, ties, repeated rows, a null id, a very long text.
LONG = " ".join(f"w{k % 977} the house of {k % 31}" for k in range(40_000))
STORY = "the quick brown fox jumps over the lazy dog while seven old wizards watch from a quiet hill near the sea and sing about rivers of gold"
ROWS = [
    (1, STORY, "en"), (2, STORY, "en"), (2, STORY, "en"), (3, STORY.replace("fox", "cat"), None), (4, None, "en"), (5, "", "en"), (6, " \t\n ", None),
    (7, "1234 ... !!", "de"), (8, "short text", "en"), (9, "short  text", "de"), (None, STORY, "en"), (None, None, None), (10, LONG, "en"),
    (11, LONG + " end", "en"), (12, "中文 texte mêlé ‘ΣΑΣ’ <|endoftext|> \x1c x", None), (13, "a a a a a a a a a a a a a a a a a a", "en"),
]
#: Names that the operators use inside themselves.
EXTRA = ["id", "sha", "key", "n", "t", "h", "p", "label", "first", "component", "class_id", "kept", "_gone", "_gone_id", "ids", "found"]


def frame(spark, rows=ROWS):
    extra = ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame([(*r, *["x"] * len(EXTRA)) for r in rows], f"doc_id long, text string, lang string, {extra}")


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def grams(text, width=5):
    words = re.findall(r"\w+", (text or "").lower())
    width = min(width, len(words))
    return Counter(tuple(words[k : k + width]) for k in range(len(words) - width + 1)) if words else Counter()


def jaccard(a, b):
    common = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - common
    return common / total if total else 0.0


def near_classes(rows, threshold=0.8):
    """Smallest id of the class of each (id, text) with an id."""
    sets = [(i, grams(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    places = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        for j in {j for g in s for j in places[g]}:
            if jaccard(s, sets[j][1]) >= threshold:
                a, b = root(i), root(sets[j][0])
                parent[max(a, b)] = min(a, b)
        for g in s:
            places[g].append(k)
    return {i: root(i) for i in parent}


def tokens(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def contaminated(docs, items, share=0.8, window=20):
    """(doc, item) whose best aligned window is equal enough, by trying every diagonal; items of nine tokens or more."""
    out = set()
    for i, text in docs:
        d = tokens(text)
        for item, t in items:
            b = tokens(t)
            if len(b) < 9 or len(d) < 9:
                continue
            w = min(window, len(b))
            for s in range(-len(b) + 1, len(d)):
                eq = [int(b[k] == d[s + k]) for k in range(max(0, -s), min(len(b), len(d) - s))]
                if max(sum(eq[k : k + w]) for k in range(max(1, len(eq) - w + 1))) * 1000 >= round(share * w * 1000):
                    out.add((i, item))
                    break
    return out
