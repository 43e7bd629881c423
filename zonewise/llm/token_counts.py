"""Token counts of every prefix by dynamic programming, for a byte-pair model of word pieces.

A piece sequence is the model's own output exactly if each two neighbours are the model's output for
their joined text.  So the last piece of a prefix is the piece ``t`` ending there that may follow the
last piece of the prefix before ``t``, and ``count[i] = count[i - len(t)] + 1``.  One pass over a text
gives the exact number of tokens of *every* prefix; budgets and truncation points are then looked up,
without encoding again.

No piece runs from a word into the white space after it, so the pass restarts at every run of spaces and
repeated words share one table.  Characters outside the vocabulary count one token per UTF-8 byte.
Null and empty texts have no tokens.  The model must keep texts as they are but for spaces (identity
normalisation); others are refused.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from zonewise.llm.common import map_rows

SPACE = "▁"
CACHE_WORDS = 500_000
LONGEST_CACHED = 64
_CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class PrefixCounter:
    """Counts for one model file; one object for each Python worker."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        if model.normalize("a  bﬁ ") != f"{SPACE}a{SPACE}{SPACE}bﬁ{SPACE}":
            raise ValueError("the model changes texts before it encodes them")
        self.model = model
        skip = [model.is_byte, model.is_control, model.is_unknown, model.is_unused]
        names = ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))
        self.pieces = {piece: i for i, piece in names if not any(test(i) for test in skip)}
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("pieces of the model join words")
        # Every end of a piece: a text that is none of these ends no piece, and no longer one does.
        self.ends = {p[i:] for p in self.pieces for i in range(len(p))}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words: dict[str, int] = {}

    def _follows(self, left: str, right: str) -> bool:
        """May ``right`` stand after ``left``?  Asked of the model once for each pair of pieces."""
        known = self.pairs.get((left, right))
        if known is None:
            # A line feed merges with nothing; behind it the text is encoded as it stands.
            known = self.model.encode("\n" + left + right, out_type=str)[2:] == [left, right]
            self.pairs[left, right] = known
        return known

    def chunk(self, text: str) -> tuple[int, ...]:
        """Tokens of each prefix of a run of spaces and the word after it."""
        counts, last = [0], [""]
        pieces, ends, pairs = self.pieces, self.ends, self.pairs
        for end in range(1, len(text) + 1):
            for start in range(end - 1, -1, -1):
                piece = text[start:end]
                if piece not in ends:
                    start = -1
                    break
                if piece in pieces:
                    before = last[start]
                    fits = not before or pairs.get((before, piece))
                    if fits is None:
                        fits = self._follows(before, piece)
                    if fits:
                        break
            else:
                start = -1
            if start < 0:
                # Not in the vocabulary: its bytes; nothing merges across it.
                counts.append(counts[end - 1] + len(text[end - 1].encode("utf-8", "replace")))
                last.append("")
            else:
                counts.append(counts[start] + 1)
                last.append(piece)
        return tuple(counts)

    def _size(self, text: str) -> int:
        """Tokens of a chunk.  Words come again and again, so their totals are kept."""
        size = self.chunk(text)[-1]
        if len(text) <= LONGEST_CACHED:
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            self.words[text] = size
        return size

    def chunks(self, text: str) -> list[str]:
        return _CHUNK.findall(SPACE + text.replace(" ", SPACE))

    def total(self, text: str | None) -> int:
        """Tokens of the whole text: the last entry of each chunk's table, summed."""
        if not text:
            return 0
        known, size = self.words.get, self._size
        return sum([known(c) or size(c) for c in self.chunks(text)])

    def prefixes(self, text: str | None) -> list[int]:
        """Tokens of ``text[:i]`` for i from 0 to its length."""
        if not text:
            return [0]
        out, before = [], 0
        for chunk in self.chunks(text):
            table = self.chunk(chunk)
            out.extend(before + n for n in table[1:])
            before += table[-1]
        out[0] = 0  # the space that the model puts before a text is no text
        return out


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(model_path: str) -> PrefixCounter:
    if model_path not in _COUNTERS:
        _COUNTERS[model_path] = PrefixCounter(model_path)
    return _COUNTERS[model_path]


def _column(batch, name):
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def count_tokens(docs: DataFrame, model_path: str, text_col: str = "text", into: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of each whole text."""

    def start():
        count = counter(model_path)
        return lambda batch: [[count.total(t) for t in _column(batch, text_col)]]

    return map_rows(docs, start, {into: "long"})


def prefix_counts(docs: DataFrame, model_path: str, text_col: str = "text", into: str = "prefix_tokens") -> DataFrame:
    """Add an array: entry i is the number of tokens of the first i characters."""

    def start():
        count = counter(model_path)
        return lambda batch: [[count.prefixes(t) for t in _column(batch, text_col)]]

    return map_rows(docs, start, {into: "array<int>"})


def fitting(docs: DataFrame, model_path: str, budget: int, text_col: str = "text", into: str = "fit_chars") -> DataFrame:
    """Add the length of the longest prefix of at most ``budget`` tokens, in characters.

    Counts may fall when a character completes a longer piece, so all prefixes are looked at.
    """

    def longest(table: list[int]) -> int:
        return max(i for i, n in enumerate(table) if n <= budget)

    def start():
        count = counter(model_path)
        return lambda batch: [[longest(count.prefixes(t)) for t in _column(batch, text_col)]]

    return map_rows(docs, start, {into: "int"})

