"""BPE encoding that reuses content-defined chunks, and decoding.

A rolling hash over the last 32 characters says where a text is cut, so a passage that many documents share is
cut alike in all of them, wherever it stands.  Chunks that occur more than once are encoded once, by the group
of documents that owns them; their ids are sent once to each other group that holds the chunk.  What occurs
once is encoded where it stands.

A chunk's ids are right except near its ends, where the cut may split a word, a special token or a character
and its accents.  Each join is therefore encoded again in a window around it, which must come to agree with
the chunk on either side: a word that begins at the same character in both, far enough from the cut that what
was cut off cannot have changed it.  A tokenizer that cuts words from left to right goes on alike from such a
place.  Where a window and a chunk do not agree the window grows, in the end over the whole chunk and
on into its neighbours, so the result is that of the library for the whole text.

    1  ``_dealt``: texts are cut and dealt into groups of about 4 MB by a hash of the row (one shuffle, of
       compressed texts, read by all later steps)
    2  ``_shared``: digests of chunks are counted (pre-aggregated by group); those met twice have an owner
    3  ``_encoded_chunks``: owners encode their chunks
    4  ``encode``: each group gets the ids of its shared chunks and puts its documents together

One key's rows never meet: a chunk that a third of all documents hold is one row for each group.

Defined results: a null or empty text has no tokens.  Repeated rows come out as often as they went in, any other
column is carried as it is, and of an empty table nothing comes out.  A document is one row, so its text and
ids are held by one task, whatever their length.
"""

from __future__ import annotations

import os
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonewise.llm.common import map_rows

#: Characters that the rolling hash looks at; least, usual and greatest length of a chunk.
WINDOW = 32
LEAST, USUAL, GREATEST = 128, 512, 4096
#: Bytes of text in a group of documents.
GROUP_BYTES = 4 << 20
#: Characters beside a join that are encoded again at first, and those before a cut that it may have changed.
REACH, CLEAR = 48, 16

#: Texts that are decoded, and windows that are encoded, in one call of the library.
DECODED_AT_ONCE, ENCODED_AT_ONCE = 64, 256
#: Words whose ids a task keeps; beyond that it begins anew.  New words that are encoded in one call.
KEPT_WORDS, NEW_AT_ONCE = 250_000, 4096
# Fixed value: how the vocabulary cuts words: letters, a digit, an English ending, or other signs.
WORDS = r"[^\W\d_]+|\d|'(?:s|t|re|ve|m|ll|d)|(?:[^\s\w]|_)+"

_BLOCK = 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BASE, _WORD = 0xD6E8FEB86659FD93, (1 << 64) - 1
_DIGEST = 16


# ---------------------------------------------------------------- cutting


def _marks(codes: np.ndarray) -> np.ndarray:
    """The positions after which the rolling hash of the last ``WINDOW`` characters asks for a cut."""
    found = []
    for at in range(0, len(codes), _BLOCK):
        low = max(at - WINDOW + 1, 0)
        h = codes[low : at + _BLOCK].astype(np.uint64) * _FACTOR
        h ^= h >> np.uint64(29)
        power, span = _BASE, 1
        while span < WINDOW:  # the hash of twice as many characters from two of the hash so far
            longer = h.copy()
            longer[span:] += np.uint64(power) * h[:-span]
            h, power, span = longer, power * power & _WORD, span * 2
        asked = np.flatnonzero((h >> np.uint64(40)) % np.uint64(USUAL) == 0) + low + 1
        found.append(asked[asked > at])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def cuts(text: str) -> list[int]:
    """Ends of the chunks of a text; the last is its length."""
    if len(text) <= LEAST:
        return [len(text)] if text else []
    ends, start = [], 0
    for mark in _marks(np.frombuffer(text.encode("utf-32-le"), np.uint32)).tolist():
        while mark - start > GREATEST:
            start += GREATEST
            ends.append(start)
        if mark - start >= LEAST:
            ends.append(mark)
            start = mark
    while len(text) - start > GREATEST:
        start += GREATEST
        ends.append(start)
    if start < len(text):
        ends.append(len(text))
    return ends


# ---------------------------------------------------------------- encoding


@cache
def _composing() -> frozenset[str]:
    """Characters that normalisation may join to the one before them."""
    pairs = (unicodedata.decomposition(chr(c)).split() for c in range(0x20000))
    hangul = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    return frozenset(chr(int(p[1], 16)) for p in pairs if len(p) == 2 and "<" not in p[0]) | hangul


def _begins(char: str) -> bool:
    """Does a character stand for itself, whatever is before it?"""
    return char < "\u0300" or not (unicodedata.combining(char) or char in _composing())


class Encoded:
    """Ids of a stretch of text, and where words near its ends begin: ``starts`` in characters, ``tokens`` in ids."""

    __slots__ = ("ids", "starts", "tokens")

    def __init__(self, ids: np.ndarray, starts: np.ndarray, tokens: np.ndarray):
        self.ids, self.starts, self.tokens = ids, starts, tokens

    def pack(self, kind: type) -> bytes:
        head = np.array([len(self.ids), len(self.starts)], np.uint32)
        return head.tobytes() + self.ids.astype(kind).tobytes() + self.starts.astype(np.uint16).tobytes()


class ChunkEncoder:
    """A tokenizer whose words are told apart by an end-of-word suffix.

    Words come again and again, so their ids are kept.  A stretch of text is cut into words here where each of its
    characters is one that the library, asked once about it, lower-cases and cuts like ``WORDS``, and that
    no normalisation joins to another; else the library encodes the stretch.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        if not suffix:
            raise ValueError("needs a tokenizer with an end-of-word suffix")
        added = self.library.get_added_tokens_decoder()
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.names = [""] * size
        #: Does a word end with this id?
        self.ends = np.zeros(size, bool)
        for token, i in self.library.get_vocab(with_added_tokens=True).items():
            self.names[i] = token
            self.ends[i] = i in added or token.endswith(suffix)
        self.packed_kind = np.uint16 if size <= 1 << 16 else np.uint32
        #: A special token may begin this many characters before a cut that splits it.
        self.special = [t.content for t in added.values()]
        self.clear = max([CLEAR, *map(len, self.special)])
        self.words: dict[str, tuple[int, ...]] = {}
        self.plain: set[str] = set()
        self.odd: set[str] = set()
        self.cut = re.compile(WORDS)

    def _is_plain(self, char: str) -> bool:
        """Does the library treat a character as this class does?"""
        if unicodedata.normalize("NFC", char) != char or not _begins(char) or char == "Σ":  # lower-cased by what follows
            return False
        lower = self.library.normalizer.normalize_str(char)
        if re.fullmatch(r"\s", char):
            return lower == " "
        if lower != char.lower() or len(lower) != 1:
            return False
        cut = self.library.pre_tokenizer.pre_tokenize_str
        return all(len(cut(beside + lower)) == len(self.cut.findall(beside + lower)) for beside in ("a", "1", "!", "'"))

    def _lowered(self, text: str) -> str | None:
        """The text in lower case if it may be cut here."""
        found = set(text)
        for char in found - self.plain - self.odd:
            (self.plain if self._is_plain(char) else self.odd).add(char)
        if found & self.odd or any(t in text for t in self.special):
            return None
        return text.lower()

    def _words(self, ids: np.ndarray) -> np.ndarray:
        """Indices of the ids that begin a word, near both ends."""
        if not len(ids):
            return np.zeros(0, np.int64)
        found = np.flatnonzero(np.concatenate([[True], self.ends[ids[:-1]]]))
        return found if len(found) <= 2 * REACH else np.concatenate([found[:REACH], found[-REACH:]])

    def _by_words(self, text: str, words: list[str]) -> Encoded:
        new = [w for w in set(words) if w not in self.words]
        if new:
            if len(self.words) > KEPT_WORDS:
                self.words.clear()
                new = list(set(words))
            # White space divides words, so new ones are encoded as one text; each ends with an id that ends words.
            for at in range(0, len(new), NEW_AT_ONCE):
                part = new[at : at + NEW_AT_ONCE]
                made = self.library.encode(" ".join(part), add_special_tokens=False).ids
                ends, start = (np.flatnonzero(self.ends[made]) + 1).tolist(), 0
                for word, end in zip(part, ends, strict=True):
                    self.words[word] = tuple(made[start:end])
                    start = end
        ids = np.fromiter(chain.from_iterable(map(self.words.__getitem__, words)), np.int64)
        starts, at = [], 0
        for word in words[: REACH if len(words) > 2 * REACH else None]:
            at = text.index(word, at)
            starts.append(at)
            at += len(word)
        if len(words) > 2 * REACH:
            last, at = [], len(text)
            for word in reversed(words[-REACH:]):
                at = text.rindex(word, 0, at)
                last.append(at)
            starts += last[::-1]
        return Encoded(ids, np.array(starts, np.int64), self._words(ids))

    def encode(self, texts: list[str]) -> list[Encoded]:
        out: list[Encoded | None] = []
        for text in texts:
            lower = self._lowered(text)
            out.append(None if lower is None else self._by_words(lower, self.cut.findall(lower)))
        odd = [i for i, made in enumerate(out) if made is None]
        for at in range(0, len(odd), ENCODED_AT_ONCE):
            part = odd[at : at + ENCODED_AT_ONCE]
            for i, made in zip(part, self.library.encode_batch([texts[i] for i in part], add_special_tokens=False)):
                ids = np.array(made.ids, np.int64)
                tokens = self._words(ids)
                starts = [made.token_to_chars(k)[0] for k in tokens.tolist()]
                out[i] = Encoded(ids, np.array(starts, np.int64), tokens)
        return out

    def unpack(self, packed: bytes) -> Encoded:
        n, words = np.frombuffer(packed, np.uint32, 2).tolist()
        ids = np.frombuffer(packed, self.packed_kind, n, 8).astype(np.int64)
        starts = np.frombuffer(packed, np.uint16, words, 8 + ids.size * self.packed_kind().itemsize).astype(np.int64)
        return Encoded(ids, starts, self._words(ids))

    def decode(self, ids: list[int]) -> str:
        """As the library's ``decode(ids, skip_special_tokens=False)``."""
        if self.library.decoder is None:
            return " ".join([self.names[i] for i in ids])
        return self.library.decode(ids, skip_special_tokens=False)

    def documents(self, texts: list[str], ends: list[list[int]], known: list[list[Encoded | None]]) -> list[np.ndarray]:
        """Ids of whole texts; ``known`` has what is known of each chunk, ``ends`` where it ends."""
        work = [_Repair(self, *row) for row in zip(texts, ends, known, strict=True)]
        open_ = [w for w in work if w.text]
        while open_:
            asked = [(w, window) for w in open_ for window in w.missing()]
            for (w, window), made in zip(asked, self.encode([w.text[slice(*window)] for w, window in asked])):
                w.made[window] = made
            open_ = [w for w in open_ if not w.settled()]
        return [w.result() for w in work]


class _Repair:
    """One text: known chunks, and windows that cover the joins and everything unknown."""

    def __init__(self, encoder: ChunkEncoder, text: str, ends: list[int], known: list[Encoded | None]):
        self.encoder, self.text = encoder, text
        self.made: dict[tuple[int, int], Encoded] = {}
        self.chunks, start, wanted = [], 0, []
        for end, entry in zip(ends, known, strict=True):
            if entry is None:
                wanted.append((start, end))
            else:
                self.chunks.append((start, end, entry))
                wanted += [(start, start)] * (start > 0)
            start = end
        # Around joins of known chunks and around what is unknown; a text's own ends are no joins.
        n = len(text)
        self._merged([(max(a - REACH, 0), min(b + REACH, n)) for a, b in wanted])
        self.agreed: dict[tuple[int, int], tuple[int, int]] = {}

    def _merged(self, windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for low, high in sorted(windows):
            if out and low <= out[-1][1]:
                out[-1] = out[-1][0], max(out[-1][1], high)
            else:
                out.append((low, high))
        self.lows = [low for low, _ in out]
        self.windows = out
        # A known chunk is of use only if it reaches out of the windows.
        self.chunks = [c for c in self.chunks if (w := self._over(c[0])) is None or c[1] > w[1]]
        return out

    def _over(self, place: int) -> tuple[int, int] | None:
        """The window that covers a character, its end included."""
        i = bisect_right(self.lows, place) - 1
        return self.windows[i] if i >= 0 and place <= self.windows[i][1] else None

    def missing(self) -> list[tuple[int, int]]:
        return [w for w in self.windows if w not in self.made]

    def _common(self, window: tuple[int, int], chunk: tuple[int, int, Encoded], low: int, high: int, last: bool) -> int | None:
        """A character in ``low..high`` where a word begins both in the window and in the chunk."""
        made, (start, _, entry) = self.made[window], chunk
        a = made.starts + window[0]
        b = entry.starts + start
        both = np.intersect1d(a[(a >= low) & (a <= high)], b[(b >= low) & (b <= high)])
        places = both[::-1] if last else both
        return next((int(s) for s in places if _begins(self.text[s])), None)

    def settled(self) -> bool:
        """Look for agreement at both ends of each window; where there is none, let the window grow."""
        clear, grown, n = self.encoder.clear, [], len(self.text)
        before: dict[tuple[int, int], tuple] = {}
        after: dict[tuple[int, int], tuple] = {}
        for chunk in self.chunks:
            after[self._over(chunk[0])] = chunk
            if chunk[1] < n:
                before[self._over(chunk[1])] = chunk
        self.agreed = {}
        for w in self.windows:
            left, right = before.get(w), after.get(w)
            low, high = w
            begin, end = 0, n
            if left and w[0] > 0:
                begin = self._common(w, left, w[0], left[1] - clear, False)
                if begin is None:
                    low = max(w[0] - 2 * (left[1] - w[0]), left[0]) if w[0] > left[0] else max(left[0] - REACH, 0)
            if right and w[1] < n:
                end = self._common(w, right, right[0], w[1] - clear, True)
                if end is None:
                    high = min(w[1] + 2 * (w[1] - right[0]), right[1]) if w[1] < right[1] else min(right[1] + REACH, n)
            if (low, high) != w:
                grown.append((low, high))
            else:
                grown.append(w)
                self.agreed[w] = begin, end
        # A chunk is right from where its left window agrees to where its right one does: in this order.
        for chunk in self.chunks:
            left, right = self._over(chunk[0]), self._over(chunk[1])
            if left in self.agreed and right in self.agreed and left != right and self.agreed[left][1] > self.agreed[right][0]:
                grown.append((left[0], right[1]))
        settled = self.windows
        return self._merged(grown) == settled

    def result(self) -> np.ndarray:
        if not self.text:
            return np.zeros(0, np.int64)
        begins = {w: self.agreed[w][0] for w in self.windows}
        pieces = []
        for start, end, entry in self.chunks:
            left = self._over(start)
            right = self._over(end) if end < len(self.text) else None
            low = self.agreed[left][1] if left else 0
            high = begins[right] if right else len(self.text)
            pieces.append((low, self._slice(entry, start, low, high)))
        for w in self.windows:
            low, high = self.agreed[w]
            pieces.append((low, self._slice(self.made[w], w[0], low, high)))
        return np.concatenate([ids for _, ids in sorted(pieces, key=lambda p: p[0])])

    def _slice(self, made: Encoded, at: int, low: int, high: int) -> np.ndarray:
        """Ids from the word that begins at ``low`` up to the one at ``high``, which are places of agreement or ends."""
        first, last = 0, len(made.ids)
        if low > 0:
            first = int(made.tokens[np.searchsorted(made.starts, low - at)])
        if high < len(self.text):
            last = int(made.tokens[np.searchsorted(made.starts, high - at)])
        return made.ids[first:last]


@cache
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


# ---------------------------------------------------------------- steps


def _dealt(docs: DataFrame, text_col: str, groups: int) -> DataFrame:
    """Rows as ``c0, c1, ...`` with ``x_group``, the compressed text and its chunks, dealt by group."""
    at = docs.columns.index(text_col)
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    plain = rows.select(
        F.pmod(F.xxhash64(*rows.columns), F.lit(groups)).cast("int").alias("x_group"),
        F.coalesce(F.col(f"c{at}").cast("string"), F.lit("")).alias("x_text"),
        *[F.col(c) for i, c in enumerate(rows.columns) if i != at],
        F.col(f"c{at}").isNull().alias("x_null"),
    )

    def start():
        pack = zstandard.ZstdCompressor(level=1).compress

        def work(batch):
            texts, ends, digests = [], [], []
            for text in batch.column(batch.schema.get_field_index("x_text")).to_pylist():
                found = cuts(text)
                texts.append(pack(text.encode()))
                ends.append(np.array(found, np.int32).tobytes())
                digests.append(b"".join(xxhash.xxh3_128_digest(text[a:b].encode()) for a, b in zip([0, *found], found)))
            return [texts, ends, digests]

        return work

    cut = map_rows(plain, start, {"x_packed": "binary", "x_ends": "binary", "x_digests": "binary"}, drop=("x_text",))
    return cut.repartition("x_group")


def _shared(dealt: DataFrame) -> DataFrame:
    """``digest, owner, holders``: chunks met more than once, and the groups that hold them."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[int, bytes], int] = {}
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("x_group", "x_digests")]
            for group, digests in zip(*columns):
                for i in range(0, len(digests), _DIGEST):
                    key = group, digests[i : i + _DIGEST]
                    counts[key] = counts.get(key, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([g for g, _ in counts], pa.int32()),
                    pa.array([d for _, d in counts], pa.binary()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["x_group", "digest", "n"],
            )

    # All columns are taken, so that every step reads the one shuffle of ``dealt``.
    parts = dealt.mapInArrow(met, "x_group int, digest binary, n long")
    by_group = parts.groupBy("digest", "x_group").agg(F.sum("n").alias("n"))
    total = by_group.groupBy("digest").agg(
        F.sum("n").alias("n"), F.min("x_group").alias("owner"), F.collect_list("x_group").alias("holders")
    )
    return total.filter("n > 1").select("digest", "owner", "holders")


def _text_rows(table: pa.Table) -> Iterator[tuple[str, list[int], bytes]]:
    unpack = zstandard.ZstdDecompressor().decompress
    columns = [table.column(c).to_pylist() for c in ("x_packed", "x_ends", "x_digests")]
    for packed, ends, digests in zip(*columns):
        yield unpack(packed).decode() if ends else "", np.frombuffer(ends, np.int32).tolist(), digests


def _encoded_chunks(dealt: DataFrame, shared: DataFrame, path: str) -> DataFrame:
    """``holders, digest, packed``: each shared chunk encoded once, by its owner."""
    schema = "holders array<int>, digest binary, packed binary"

    def run(rows: pa.Table, owned: pa.Table) -> pa.Table:
        wanted, texts = {d: i for i, d in enumerate(owned.column("digest").to_pylist())}, {}
        if wanted:
            for text, ends, digests in _text_rows(rows):
                for i, (a, b) in enumerate(zip([0, *ends], ends)):
                    digest = digests[i * _DIGEST : (i + 1) * _DIGEST]
                    if digest in wanted:
                        texts.setdefault(digest, text[a:b])
        made = encoder(path).encode(list(texts.values())) if texts else []
        holders = owned.column("holders").take(pa.array([wanted[d] for d in texts], pa.int64())).cast(pa.list_(pa.int32()))
        packed = pa.array([m.pack(encoder(path).packed_kind) for m in made], pa.binary())
        return pa.table({"holders": holders, "digest": pa.array(list(texts), pa.binary()), "packed": packed})

    right = shared.withColumnRenamed("owner", "x_group").groupBy("x_group")
    return dealt.groupBy("x_group").cogroup(right).applyInArrow(run, schema)


def encode(
    docs: DataFrame, path: str, text_col: str = "text", into: str = "ids", decoded: str | None = None, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """Add the array of token ids of each whole text, as the library gives them, and under ``decoded`` the text they decode to."""
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _dealt(docs, text_col, max(least, -(-size // group_bytes)))
    owned = _encoded_chunks(dealt, _shared(dealt), path)
    sent = owned.select(F.explode("holders").alias("x_group"), "digest", "packed")

    at = docs.columns.index(text_col)
    added = [into] + ([decoded] if decoded else [])
    kept = [(i, f) for i, f in enumerate(docs.schema.fields) if f.name.lower() not in {n.lower() for n in added}]
    fields = [T.StructField(f"c{i}", f.dataType) for i, f in kept] + [T.StructField("x_ids", T.ArrayType(T.IntegerType()))]
    schema = T.StructType(fields + ([T.StructField("x_decoded", T.StringType())] if decoded else []))

    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        work = encoder(path)
        entries = {d: work.unpack(p) for d, p in zip(known.column("digest").to_pylist(), known.column("packed").to_pylist())}
        texts, ends, have = [], [], []
        for text, cut, digests in _text_rows(rows):
            texts.append(text)
            ends.append(cut)
            have.append([entries.get(digests[i : i + _DIGEST]) for i in range(0, len(digests), _DIGEST)])
        ids = work.documents(texts, ends, have)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        null = rows.column("x_null").to_pylist()
        columns = {}
        for i, _ in kept:
            if i == at:
                columns[f"c{i}"] = pa.array([None if gone else t for t, gone in zip(texts, null)], pa.string())
            else:
                columns[f"c{i}"] = rows.column(f"c{i}")
        columns["x_ids"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
        if decoded:
            columns["x_decoded"] = pa.array([work.decode(x.tolist()) for x in ids], pa.string())
        return pa.table(columns)

    done = dealt.groupBy("x_group").cogroup(sent.groupBy("x_group")).applyInArrow(run, schema)
    return done.toDF(*[f.name for _, f in kept], *added)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the text of each array of ids, special tokens included; null for null."""

    def start():
        text_of = encoder(path).decode

        def work(batch):
            lists, out = batch.column(batch.schema.get_field_index(ids_col)), []
            for start in range(0, len(lists), DECODED_AT_ONCE):
                part = lists.slice(start, DECODED_AT_ONCE).to_pylist()
                out.append(pa.array([None if x is None else text_of(x) for x in part], pa.string()))
            return [pa.chunked_array(out, pa.string()).combine_chunks()]

        return work

    return map_rows(rows, start, {into: "string"})
