"""Repair of the structure of conversations: faulty rows go or stay, roles come to alternate, at the least cost.

A repaired conversation has the role initials ``(s?(ua)+)?``.  A row may be kept, get the other role, or be deleted,
which blank and repeated rows must be; rows with an empty text may be inserted anywhere.  Costs, symbols, Re-Pair and
the min-plus matrices are in ``repair_grammar``.

Rows of a conversation are taken by turn, null turns first, rows of equal turn by role and then text.  Conversations of
common size are sorted side by side and repaired as they stream through a task, some ten thousand rows at a time under
one grammar, so what recurs among them is worked out once.  A conversation of more than ``LONG_ROWS`` rows or
``LONG_BYTES`` bytes is cut: equal rows are counted first, the rest is sorted by ranges, and every part gives one matrix
per conversation.  Folding the matrices of a conversation's parts gives its cost, its edits and the state in which each
part begins and ends; the parts are then repaired side by side.  Only the digest of the repaired text reads a long
conversation in one stream, as SHA-256 demands, in blocks of about 1 MB that are not kept.

Defined results: null roles and texts count as one space.  Rows that only name their conversation (``present`` false)
take no part.  A null conversation id is a conversation; one without rows has zeros, no edits and the digest of an empty
text.  Repeated rows are duplicates.  Roles and texts may be empty; other columns are not read.  Of an empty table
nothing comes out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonewise.llm import repair_grammar as G
from zonewise.llm.common import field, materialize
from zonewise.operators.ordered import lookback, span_segment

#: A conversation beyond either is repaired in parts.
LONG_ROWS, LONG_BYTES = 20_000, 32 << 20
#: Rows that are repaired under one grammar, at least.
GRAMMAR_ROWS = 10_000
#: Characters in a block of repaired text.
BLOCK = 1 << 20
#: Turns in a segment of the search for repeated rows of a long conversation.
TURNS_PER_SEGMENT = 4096

#: White space of the contract, and ends of sentences.
_SOLID = re.compile(r"[^\x20\x09-\x0D]")
_ENDS = ".!?"
_SPACE = "".join(map(chr, (0x20, *range(0x09, 0x0E))))

_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_LEGAL = ("su", "ua", "au")


def damage(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", every: int = 20
) -> DataFrame:
    """``conv, turn, role, text, present``: one row in ``every`` is dropped, one emptied, and so on, by a hash of its place."""
    name = [F.coalesce(field(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col)]
    kind = F.crc32(F.concat(name[0], F.lit(":"), name[1]).cast("binary")) % every
    text, role = (F.coalesce(field(c), F.lit(" ")) for c in (text_col, role_col))
    return (
        rows.select(
            field(conv_col).alias("conv"),
            field(turn_col).alias("turn"),
            F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
            F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, _ENDS, "")).otherwise(text).alias("text"),
            (kind != 0).alias("present"),
            F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("x_copies"),
        )
        .withColumn("x_copies", F.explode("x_copies"))
        .drop("x_copies")
    )


# ---------------------------------------------------------------- one conversation


def _fault(text: str, seen: bool) -> str:
    """``b``, ``d``, ``t`` or nothing: the first fault of a row."""
    if not _SOLID.search(text):
        return "b"
    if seen:
        return "d"
    return "" if text.rstrip(_SPACE)[-1] in _ENDS else "t"


class _Run:
    """Equal rows of a conversation, in order: ``n`` copies of which the first has ``fault``."""

    __slots__ = ("turn", "role", "text", "n", "fault")

    def __init__(self, turn: int | None, role: str, text: str, n: int, seen: bool):
        self.turn, self.role, self.text, self.n = turn, role, text, n
        self.fault = _fault(text, seen)

    def sequence(self, grammar: G.Grammar) -> list[int]:
        state = {"": G.OK, "t": G.CUT}.get(self.fault, G.GONE)
        first = [G.symbol(self.role[:1], state)]
        return first + grammar.power(G.symbol(self.role[:1], G.GONE), self.n - 1) if self.n > 1 else first


class _Facts:
    """Counts of rows in order that can be put together with those that follow."""

    def __init__(self) -> None:
        self.n = self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.first_turn = self.last_turn = None
        self.first = self.last = None  # initials

    def add(self, run: _Run) -> None:
        initial = run.role[:1]
        self._next(initial, run.turn, run.turn)
        if run.n > 1:
            self.illegal += run.n - 1  # an initial beside itself
        self.n += run.n
        if run.turn is not None and (self.high is None or run.turn != self.last_turn):
            self.turns += 1
        self._span(run.turn, run.turn)
        self.last, self.last_turn = initial, run.turn
        self.blank += run.n if run.fault == "b" else 0
        self.duplicate += run.n if run.fault == "d" else (run.n - 1 if run.fault != "b" else 0)
        self.truncated += run.fault == "t"

    def _next(self, initial: str, turn: int | None, _: int | None) -> None:
        if self.n and self.last + initial not in _LEGAL:
            self.illegal += 1
        if not self.n:
            self.first, self.first_turn = initial, turn

    def _span(self, low: int | None, high: int | None) -> None:
        if low is not None:
            self.low = low if self.low is None else min(self.low, low)
            self.high = high if self.high is None else max(self.high, high)

    def append(self, other: _Facts) -> None:
        if not other.n:
            return
        self._next(other.first, other.first_turn, None)
        same = self.high is not None and other.low is not None and self.last_turn == other.low
        self._span(other.low, other.high)
        self.turns += other.turns - same
        for name in ("n", "blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        self.last, self.last_turn = other.last, other.last_turn

    def gaps(self) -> int:
        return 0 if self.high is None else self.high - self.low + 1 - self.turns

    def row(self) -> list:
        return [self.n, self.turns, self.blank, self.duplicate, self.truncated, self.illegal, self.low, self.high,
                self.first_turn, self.last_turn, self.first, self.last]

    @classmethod
    def of(cls, row: list) -> _Facts:
        out = cls()
        (out.n, out.turns, out.blank, out.duplicate, out.truncated, out.illegal, out.low, out.high,
         out.first_turn, out.last_turn, out.first, out.last) = row
        return out


def _lines(runs: Iterable[_Run], edits: str, state: int) -> Iterator[str]:
    """The repaired rows as ``role:text`` for edits that begin in ``state``."""
    rows = ((r.role, r.text) for r in runs for _ in range(r.n))
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == G.USER else "user"
        state = {"s": G.SYSTEM, "u": G.USER}.get(role[0], G.ASSISTANT)
        yield f"{role}:{text}"


def _streamed(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names])


def _by_conversation(rows: Iterator[tuple]) -> Iterator[tuple[object, list[tuple]]]:
    held, key, first = [], None, True
    for row in rows:
        if not first and row[0] != key:
            yield key, held
            held = []
        key, first = row[0], False
        held.append(row)
    if not first:
        yield key, held


def _repaired(batch: list[tuple[object, list[_Run], _Facts]], keep_text: bool) -> Iterator[tuple]:
    """Result rows of whole conversations, under one grammar."""
    grammar = G.Grammar()
    sequences = [[s for r in runs for s in r.sequence(grammar)] for _, runs, _ in batch]
    distinct = {tuple(s): i for i, s in enumerate(dict.fromkeys(map(tuple, sequences)))}
    short = grammar.compress(list(distinct))
    best = [grammar.best(s) for s in short]
    for (conv, runs, facts), sequence in zip(batch, sequences):
        cost, edits = best[distinct[tuple(sequence)]]
        text = "\n".join(_lines(runs, edits, G.START))
        digest = hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()
        yield (conv, facts.gaps(), facts.blank, facts.duplicate, facts.truncated, facts.illegal, cost, edits, digest,
               *([text] if keep_text else []))


def _runs(rows: list[tuple]) -> list[_Run]:
    """Rows ``conv, turn, role, text`` of one whole conversation in order as runs of equal rows."""
    out: list[_Run] = []
    seen: set[tuple[str, str]] = set()
    for _, turn, role, text in rows:
        if out and (out[-1].turn, out[-1].role, out[-1].text) == (turn, role, text):
            out[-1].n += 1
        else:
            out.append(_Run(turn, role, text, 1, (role, text) in seen))
            seen.add((role, text))
    return out


# ---------------------------------------------------------------- steps


def _schema(conv: T.DataType, keep_text: bool) -> T.StructType:
    fields = [T.StructField("conv", conv)] + [T.StructField(c, T.LongType()) for c in _COUNTS]
    texts = ["audit", "repaired_sha256"] + (["repaired"] if keep_text else [])
    return T.StructType(fields + [T.StructField(c, T.StringType()) for c in texts])


def _batches(rows: Iterator[tuple], schema: T.StructType, size: int = 2000) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, held = to_arrow_schema(schema), []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield made()
            held = []
    if held:
        yield made()


def _common(rows: DataFrame, schema: T.StructType, keep_text: bool) -> DataFrame:
    """Conversations of common size: sorted side by side, each repaired by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            waiting, n = [], 0
            for conv, held in _by_conversation(_streamed(batches, ["conv", "turn", "role", "text", "present"])):
                runs = _runs([r[:4] for r in held if r[4]])
                facts = _Facts()
                for r in runs:
                    facts.add(r)
                waiting.append((conv, runs, facts))
                n += len(held)
                if n >= GRAMMAR_ROWS:
                    yield from _repaired(waiting, keep_text)
                    waiting, n = [], 0
            yield from _repaired(waiting, keep_text)

        return _batches(results(), schema)

    ordered = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return ordered.mapInArrow(run, schema)


_PART = "conv {conv}, part int, facts array<string>, entries array<struct<i:int, j:int, cost:bigint, edits:string>>"


def _parts(sorted_rows: DataFrame, conv: str) -> DataFrame:
    """One row for each conversation and part: its counts and its matrix."""
    schema = T._parse_datatype_string(_PART.format(conv=conv))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            names = ["conv", "part", "turn", "role", "text", "n", "seen"]
            for conv, held in _by_conversation(_streamed(batches, names)):
                runs, facts, grammar = [_Run(*r[2:]) for r in held], _Facts(), G.Grammar()
                for r in runs:
                    facts.add(r)
                matrix = grammar.total(grammar.compress([[s for r in runs for s in r.sequence(grammar)]])[0])
                entries = [{"i": i, "j": j, "cost": c, "edits": G.flat(e)} for (i, j), (c, e) in matrix.items()]
                yield conv, held[0][1], [None if v is None else str(v) for v in facts.row()], entries

        return _batches(results(), schema, 16)

    return sorted_rows.mapInArrow(run, schema)


_FOLDED = "conv {conv}, part int, state int, after int, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, tail string"


def _folded(parts: DataFrame, conv: str) -> DataFrame:
    """Rows with the states of each part, and one row (``part`` null) with the counts and edits of a conversation."""
    schema = T._parse_datatype_string(_FOLDED.format(conv=conv))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            for conv, held in _by_conversation(_streamed(batches, ["conv", "part", "facts", "entries"])):
                facts = _Facts()
                ways: dict[int, tuple[G.Entry, tuple | None]] = {G.START: ((0, ""), None)}
                for _, _, counted, entries in held:
                    numbers = [None if v is None else int(v) for v in counted[:10]]
                    facts.append(_Facts.of([*numbers, *counted[10:]]))
                    new: dict[int, tuple[G.Entry, tuple | None]] = {}
                    for e in entries:
                        if e["i"] in ways:
                            (cost, edits), path = ways[e["i"]]
                            entry = cost + e["cost"], G.joined(edits, e["edits"])
                            if G.better(entry, new.get(e["j"], (None,))[0]):
                                new[e["j"]] = entry, (e["i"], path)
                    ways = new
                (cost, edits), state = G.finish({(G.START, k): entry for k, (entry, _) in ways.items()})
                end, path = state, ways[state][1]
                for _, part, _, _ in reversed(held):
                    start, path = path
                    yield conv, part, start, end, *[None] * 8
                    end = start
                edits = G.flat(edits)
                tail = edits[len(G.flat(ways[state][0][1])) :]  # inserts after the last row
                yield (conv, None, state, None, facts.gaps(), facts.blank, facts.duplicate, facts.truncated, facts.illegal,
                       cost, edits, tail)

        return _batches(results(), schema, 16)

    return parts.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(run, schema)


_BLOCKS = "conv {conv}, part int, block int, lines string"


def _blocks(sorted_rows: DataFrame, conv: str) -> DataFrame:
    """The repaired rows of each part in blocks."""
    schema = T._parse_datatype_string(_BLOCKS.format(conv=conv))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            names = ["conv", "part", "state", "after", "turn", "role", "text", "n", "seen"]
            for conv, held in _by_conversation(_streamed(batches, names)):
                _, part, start, end = held[0][:4]
                runs, grammar = [_Run(*r[4:]) for r in held], G.Grammar()
                matrix = grammar.total(grammar.compress([[s for r in runs for s in r.sequence(grammar)]])[0])
                lines, size, block = [], 0, 0
                for line in _lines(runs, G.flat(matrix[start, end][1]), start):
                    lines.append(line)
                    size += len(line)
                    if size >= BLOCK:
                        yield conv, part, block, "\n".join(lines)
                        lines, size, block = [], 0, block + 1
                if lines:
                    yield conv, part, block, "\n".join(lines)

        return _batches(results(), schema, 4)

    return sorted_rows.mapInArrow(run, schema)


def _digests(blocks: DataFrame, conv: str, keep_text: bool) -> DataFrame:
    """``conv, repaired_sha256``: blocks of a conversation in order, one after the other."""
    schema = T._parse_datatype_string(f"conv {conv}, repaired_sha256 string, repaired string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            key, digest, texts = None, None, []
            for conv, lines in _streamed(batches, ["conv", "lines"]):
                if digest is not None and conv == key:
                    digest.update(b"\n")
                else:
                    if digest is not None:
                        yield key, digest.hexdigest(), "\n".join(texts) if keep_text else None
                    key, digest, texts = conv, hashlib.sha256(), []
                digest.update(lines.encode("utf-8", "replace"))
                if keep_text:
                    texts.append(lines)
            if digest is not None:
                yield key, digest.hexdigest(), "\n".join(texts) if keep_text else None

        return _batches(results(), schema, 4)

    return blocks.repartition("conv").sortWithinPartitions("conv", "part", "block").mapInArrow(run, schema)


def _long(rows: DataFrame, keep_text: bool) -> DataFrame:
    """Long conversations, in parts."""
    conv = rows.schema["conv"].dataType.simpleString()
    equal = rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    before = lookback(
        equal, ["conv", "role", "text"], ["turn"], span_segment("turn", TURNS_PER_SEGMENT), {"x_before": lambda w: F.lag(F.lit(True)).over(w)}
    )
    runs = before.withColumn("seen", F.coalesce("x_before", F.lit(False)))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = ["conv", "turn", "role"]
    ranged = runs.repartitionByRange(n, *place, F.substring("text", 1, 64)).sortWithinPartitions(*place, "text")
    # Kept, so that the parts stay as they are cut.
    kept = materialize(ranged).withColumn("part", F.spark_partition_id())
    folded = materialize(_folded(_parts(kept, conv), conv))
    # One row for each part and long conversation at most: bounded by the number of partitions and of rows / LONG_ROWS.
    states = folded.filter("part IS NOT NULL").select(F.col("conv").alias("x_conv"), F.col("part").alias("x_part"), "state", "after")
    same = F.col("conv").eqNullSafe(F.col("x_conv")) & (F.col("part") == F.col("x_part"))
    told = kept.join(F.broadcast(states), same).drop("x_conv", "x_part")
    whole = folded.filter("part IS NULL")
    last = whole.filter("tail <> ''").select(
        "conv", F.lit(None).cast("int").alias("part"), F.lit(0).alias("block"), "state", F.length("tail").alias("x_n")
    )
    # Inserts after the last row: assistant after a user, else user and assistant.
    added = F.when(F.col("x_n") == 1, F.lit("assistant:")).otherwise(F.lit("user:\nassistant:"))
    ends = last.select("conv", F.lit(2**31 - 1).alias("part"), "block", added.alias("lines"))
    digests = _digests(_blocks(told, conv).unionByName(ends), conv, keep_text).withColumnRenamed("conv", "x_conv")
    joined = whole.join(digests, F.col("conv").eqNullSafe(F.col("x_conv")), "left")
    empty = hashlib.sha256(b"").hexdigest()
    out = joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(empty)))
    texts = [F.coalesce("repaired", F.lit("")).alias("repaired")] if keep_text else []
    return out.select("conv", *_COUNTS, "audit", "repaired_sha256", *texts)


def repair(rows: DataFrame, keep_text: bool = False, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """Per conversation of ``conv, turn, role, text, present``: counts of faults, least cost, its edits, and the digest of
    the repaired rows; with ``keep_text`` those rows too, as ``repaired``.
    """
    present = F.coalesce(F.col("present"), F.lit(False)) if "present" in rows.columns else F.lit(True)

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)

    rows = rows.select("conv", F.col("turn").cast("long").alias("turn"), text("role"), text("text"), present.alias("present"))
    schema = _schema(rows.schema["conv"].dataType, keep_text)
    size = rows.groupBy("conv").agg(F.count_if("present").alias("n"), F.sum(F.octet_length("text")).alias("size"))
    # At most one id for each LONG_ROWS rows or LONG_BYTES bytes.
    long_ones = materialize(size.filter((F.col("n") > long_rows) | (F.col("size") > long_bytes)).select(F.col("conv").alias("x_conv")))
    if long_ones.isEmpty():
        return _common(rows, schema, keep_text)
    same = F.col("conv").eqNullSafe(F.col("x_conv"))
    common = _common(rows.join(F.broadcast(long_ones), same, "left_anti"), schema, keep_text)
    long_rows_ = rows.join(F.broadcast(long_ones), same, "left_semi").filter("present")
    none = rows.join(F.broadcast(long_ones), same, "left_semi").filter("NOT present")
    # Those long only by rows that are not present still have a row.
    nothing = none.select("conv").distinct().join(
        long_rows_.select(F.col("conv").alias("x_there")).distinct(), F.col("conv").eqNullSafe(F.col("x_there")), "left_anti"
    )
    bare = nothing.select(
        "conv",
        *[F.lit(0).cast("long").alias(c) for c in _COUNTS],
        F.lit("").alias("audit"),
        F.lit(hashlib.sha256(b"").hexdigest()).alias("repaired_sha256"),
        *([F.lit("").alias("repaired")] if keep_text else []),
    )
    return common.unionByName(_long(long_rows_, keep_text)).unionByName(bare)
