"""Encoding by shared chunks against the library on whole texts."""

from __future__ import annotations

import random

import public_tokenizers
import pytest

from zonewise.llm import bpe_chunks as B

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def work():
    return B.encoder(PATH)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    words = ["don't", "we'Re", "café", "été", "<|endoftext|>", "<|start", "of", "text|>", "İ", "İx", "ΣΣ", "12", "!?", "中文",
             "각", "²", "x" * 40, "\n", " ", "́", "≠"]
    mixed = ["".join(rng.choice(words) + rng.choice(["", " ", "\t"]) for _ in range(rng.randrange(900))) for _ in range(25)]
    shared = "".join(rng.choice("abcdefghij ,.") for _ in range(9000))
    around = [f"{rng.random()} {shared[rng.randrange(99):]} {rng.random()}" for _ in range(6)]
    return [*mixed, *around, "a" * 6000, " " * 5000, "e" + "́" * 1500, "<|startoftext|>" * 400, "中" * 5000, "", "x", " "]


def ids_of(work, texts):
    return [e.ids for e in work.library.encode_batch(texts, add_special_tokens=False)]


def test_words_are_cut_like_the_library(work, texts):
    assert [e.ids.tolist() for e in work.encode(texts)] == ids_of(work, texts)


@pytest.mark.parametrize("share", [0.0, 0.5, 1.0])
def test_joins_are_repaired(work, texts, share):
    rng = random.Random(7)
    ends = [B.cuts(t) for t in texts]
    known = []
    for text, cut in zip(texts, ends):
        made = work.encode([text[a:b] for a, b in zip([0, *cut], cut)])
        made = [work.unpack(m.pack(work.packed_kind)) for m in made]
        known.append([m if rng.random() < share else None for m in made])
    assert [i.tolist() for i in work.documents(texts, ends, known)] == ids_of(work, texts)


def test_cuts_follow_the_content(texts):
    for text in texts:
        ends = B.cuts(text)
        sizes = [b - a for a, b in zip([0, *ends], ends)]
        assert sum(sizes) == len(text) and all(0 < s <= B.GREATEST for s in sizes)
    shared = texts[25][20:]
    a, b = ({t[x:y] for x, y in zip([0, *B.cuts(t)], B.cuts(t))} for t in (f"one {shared}", f"another beginning {shared}"))
    assert len(a & b) > len(a) / 2


def test_tables(spark, work, texts):
    rows = [(i, t, "k", i) for i, t in enumerate(texts)] + [(7, texts[26], None, None)] * 3 + [(None, None, "k", 1), (None, "Hello", "", 2)]
    docs = spark.createDataFrame(rows, "id int, `a.text` string, x_group string, ids int")
    done = B.decode(B.encode(docs, PATH, text_col="a.text", group_bytes=20_000), PATH)
    assert done.columns == ["id", "a.text", "x_group", "ids", "decoded"]
    want = []
    for i, t, g, _ in rows:
        ids = ids_of(work, [t or ""])[0]
        want.append((i, t, g, ids, work.library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(tuple, done.collect()), key=repr) == sorted(want, key=repr)
    both = B.encode(docs, PATH, text_col="a.text", decoded="decoded")
    assert sorted(map(tuple, both.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert B.decode(B.encode(empty, PATH), PATH).count() == 0


def test_decoding(spark, work):
    df = spark.createDataFrame([([0, 49406, 320, 49407],), ([],), (None,)], "ids array<int>")
    got = [r.decoded for r in B.decode(df, PATH).select("decoded").collect()]
    assert got == [work.library.decode([0, 49406, 320, 49407], skip_special_tokens=False), "", None]
