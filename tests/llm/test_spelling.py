"""Spelling variants against comparing every pair of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from zonewise.llm import spelling as S

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_words(docs, every):
    for doc_id, text in docs:
        for run in LETTERS.findall(text or ""):
            word = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if every and h % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            yield word


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    forms, out = {}, {}
    for w, n in counts.items():
        others = [v for v in counts if v != w and abs(len(v) - len(w)) < 2 and near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * n else None
        out[w] = len(others)
    rows = set()
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.add((w, forms[w], root, n, out[w], counts[forms[w]] if forms[w] else None))
    return rows


def found(spark, docs, every=S.ERROR_EVERY, **bounds):
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    vocab = S.vocabulary(S.occurrences(df, "doc_id", "text", every), **bounds)
    rows = S.variants(vocab).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len(set(map(tuple, rows)))
    return set(map(tuple, rows))


@pytest.mark.parametrize("every", [None, 3, 97])
def test_against_all_pairs(spark, every):
    rng = random.Random(11)
    base = ["".join(rng.choice("abcàÿ") for _ in range(rng.randrange(3, 9))) for _ in range(60)]

    def edited(w):
        i = rng.randrange(len(w) + 1)
        return rng.choice([w, w, w[:i] + w[i + 1 :], w[:i] + rng.choice("abcà") + w[i:], w[:i] + rng.choice("abÿ") + w[i + 1 :]])

    texts = [" ".join(rng.choice([w, w.upper(), w.title()]) for w in (edited(rng.choice(base)) for _ in range(300))) for _ in range(12)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (3, None), (4, ""), (5, "1 2 _"), (0, texts[0])]
    counts = Counter(w for w in brute_words(docs, every) if len(w) >= 4)
    want = brute({w: n for w, n in counts.items() if n >= 2})
    assert found(spark, docs, every, min_length=4, min_count=2) == want
    assert sum(r[4] for r in want) > 100


def test_runs_of_one_character_meet_once(spark):
    docs = [(1, "aaaaa " * 9 + "aaaaaa " * 3 + "aaabaa " * 3 + "aabaa " * 4)]
    got = found(spark, docs, None)
    assert got == brute(dict(Counter(docs[0][1].split())))


def test_chain_of_forms(spark):
    words = ["abcdefgh", "abcdefgx", "abcdefyx", "abcdezyx", "abcdwzyx"]
    text = " ".join(w for i, w in enumerate(words) for _ in range(3 << i))
    got = {r[0]: r[2] for r in found(spark, [(1, text)], None)}
    assert got == dict.fromkeys(words, words[-1])


def test_ties_take_the_least_word(spark):
    text = "bbbbb " * 3 + "bbbbc " * 6 + "bbbba " * 6 + "bbbbà " * 6
    rows = {r[0]: r for r in found(spark, [(1, text)], None)}
    assert rows["bbbbb"][1:] == ("bbbba", "bbbba", 3, 3, 6)


def test_very_long_words(spark):
    rng = random.Random(1)
    word = "".join(rng.choice("abcde") for _ in range(3000))
    docs = [(1, f"{word} " * 8 + f"{word[:2000]}x{word[2001:]} " * 4 + f"{word[:64]} " * 3 + f"{word[:65]} " * 9 + f"{word[1:65]} " * 3)]
    assert found(spark, docs, None) == brute(dict(Counter(docs[0][1].split())))


def test_empty_table(spark):
    assert found(spark, []) == set()
