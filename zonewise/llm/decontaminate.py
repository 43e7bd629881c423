"""Benchmark decontamination with one Aho-Corasick automaton over the normalised test items.

Texts are normalised byte by byte: A-Z to lower case, every other ASCII character that is neither
letter nor digit to a space.  Words are what lies between spaces.  A window is ``size`` consecutive
words of an item (an item of fewer words, but not none, is one window).  The automaton holds every
window, with a space at both ends, and reads each whole text once; the byte positions of the
normalised text are those of the original, so hits are reported as character spans of the original.

Null and blank texts have no words and no hits; items without words have no windows; equal items
share windows and are all reported.  A null item id is reported as ``null``.  Added columns replace
input columns of the same name.

The benchmark is measured before it is sent to the executors: at most ``block_bytes`` of windows go
into one automaton, and a larger benchmark is read in blocks, one scan and one automaton each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.llm.common import field, map_rows, materialize

WINDOW = 10
BLOCK_BYTES = 16 << 20
HIT_TYPE = "array<struct<first:int, last:int, items:array<string>>>"

_MAP = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """The normalised words of a text."""
    return text.encode("utf-8", "replace").translate(_MAP).split() if text else []


def _windows(size: int):
    def start():
        def work(batch):
            out = []
            for text in batch.column(batch.schema.get_field_index("x_text")).to_pylist():
                words = words_of(text)
                count = max(1, len(words) - size + 1) if words else 0
                out.append(list({b" ".join(words[i : i + size]) for i in range(count)}))
            return [out]

        return work

    return start


def windows(benchmark: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``x_window, x_items``: every distinct window and the items that hold it."""
    items = benchmark.select(
        F.coalesce(field(id_col).cast("string"), F.lit("null")).alias("x_item"), field(text_col).alias("x_text")
    )
    held = map_rows(items, _windows(size), {"x_windows": "array<binary>"}, drop=("x_text",))
    rows = held.select("x_item", F.explode("x_windows").alias("x_window"))
    return rows.groupBy("x_window").agg(F.sort_array(F.collect_set("x_item")).alias("x_items"))


def _blocks(table: DataFrame, block_bytes: int) -> list[list]:
    """The windows in blocks of bounded size.  Windows are dealt to blocks by hash."""
    size = F.length("x_window") + F.aggregate("x_items", F.lit(0), lambda n, x: n + F.length(x) + 8)
    total = table.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    count = max(1, -(-int(total) // block_bytes))
    block = F.pmod(F.xxhash64("x_window"), F.lit(count))
    return [table.filter(block == b) for b in range(count)]


def _scan(shared, text_col: str):
    """One pass over the texts: ``x_hits`` gains the occurrences of this automaton's windows."""

    def start():
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for window, items in shared.value:
            automaton.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, items))
        ready = len(automaton) > 0
        if ready:
            automaton.make_automaton()

        def occurrences(text):
            words = words_of(text)
            if not ready or not words:
                return len(words), []
            line = f" {b' '.join(words).decode('latin-1')} "
            found = list(automaton.iter(line))
            if not found:
                return len(words), []
            spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
            ends = np.searchsorted(spaces, np.array([e for e, _ in found])) - 1
            return len(words), [
                {"first": int(end) - n + 1, "last": int(end), "items": items} for end, (_, (n, items)) in zip(ends, found)
            ]

        def work(batch):
            counts, hits = [], []
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            before = batch.column(batch.schema.get_field_index("x_hits")).to_pylist()
            for text, old in zip(texts, before):
                n, new = occurrences(text)
                counts.append(n)
                hits.append(old + new)
            return [counts, hits]

        return work

    return start


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words`` and ``hits``: word positions (first, last) of each window found, and its items."""
    spark = docs.sparkSession
    table = materialize(windows(benchmark, size, item_id, item_text))
    blocks = _blocks(table, block_bytes)
    out = docs.withColumn("x_hits", F.expr(f"cast(array() AS {HIT_TYPE})"))
    for i, block in enumerate(blocks):
        shared = spark.sparkContext.broadcast([(bytes(r[0]), list(r[1])) for r in block.toLocalIterator()])
        out = map_rows(out, _scan(shared, text_col), {"n_words": "long", "x_hits": HIT_TYPE})
        if i + 1 < len(blocks):
            out = materialize(out)
    if "hits" in out.columns:
        out = out.drop("hits")
    return out.withColumnRenamed("x_hits", "hits")


def hit_words(hits: Column) -> Column:
    """How many words lie inside any occurrence."""
    merged = F.aggregate(
        F.array_sort(F.transform(hits, lambda h: F.struct(h["first"].alias("first"), h["last"].alias("last")))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("end")),
        lambda s, h: F.struct(
            (s["n"] + F.greatest(F.lit(0), h["last"] - F.greatest(h["first"], s["end"] + 1) + 1)).cast("long").alias("n"),
            F.greatest(s["end"], h["last"]).alias("end"),
        ),
    )
    return merged["n"]


def items_of(hits: Column) -> Column:
    """The items with windows in the text, sorted."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(hits, lambda h: h["items"]))))


def _character_spans(text_col: str):
    def start():
        def spans(text, hits):
            if not hits:
                return []
            data = text.encode("utf-8", "replace")
            flat = np.frombuffer(data.translate(_MAP), np.uint8) != 32
            edge = np.diff(np.concatenate(([0], flat.view(np.int8), [0])))
            starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            # Character number of each byte: bytes that continue a character do not count.
            number = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
            return [
                {"start": int(number[starts[h["first"]]]), "end": int(number[ends[h["last"]]]), "items": h["items"]}
                for h in hits
            ]

        def work(batch):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            hits = batch.column(batch.schema.get_field_index("hits")).to_pylist()
            return [[spans(t, h) for t, h in zip(texts, hits)]]

        return work

    return start


def spans(found: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``spans``: start (included) and end (excluded) of each occurrence, in characters of the original text."""
    return map_rows(found, _character_spans(text_col), {"spans": "array<struct<start:int, end:int, items:array<string>>>"})


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs, columns unchanged."""
    packed = docs.select(F.struct("*").alias("x_row"), field(text_col).alias("x_text"))
    return find(packed, benchmark, size, "x_text").filter(F.size("hits") == 0).select("x_row.*")
