"""N-gram Jaccard join with PartEnum signatures.

A document is the set of its distinct word n-grams.  Two documents link when
``den * |A & B| >= num * |A | B|``.

Sets are put into bands of similar size.  Linked sets of a band differ in at most ``k`` elements, a
number that follows from the threshold and the band.  The domain of n-grams (their 64-bit hashes) is cut
into first-level parts, each part into two, and each choice of one of the two is a signature.  One
differing element in a part spoils one of its signatures, two can spoil both; with ``k // 2 + 1`` parts
linked sets share a signature.  A set also signs for the next band if it is large enough to link into it.

Half as many parts again are added to those, and a set leaves out its weakest signatures: those that cover few
elements, and so are shared by chance (two sets without any element in a range agree there).  Signatures have
a weight, which is the same for all sets that share them: the elements covered, ties by hash.  A set keeps the
weights from the largest ``t`` at which spoiling all that it keeps takes more than ``k`` elements.
No link is lost: of two linked sets, the one with the larger ``t`` is sure to share a signature of weight ``t``
or more, and the other keeps that too.

Sets that share a signature are candidates, and each link is decided by counting.  Many meet by chance or in a passage
that both hold.  In a bucket of up to ``PAIRED`` members each two are therefore held against each other by their sketches
first: one bit for each of some ranges of the hash, whether an odd number of elements is in it.  Each differing element turns
one bit, so two sets differ in no fewer elements than their sketches in bits, and those that differ in too many do not link.
Members of larger buckets are not paired with each other, as a group of near copies would give its square; they all
hang together.  Sets connected in one of these ways form a cluster, and each member is compared with one of them, the pivot.  A set's *difference*
to the pivot is then enough: two sets differ in ``|D(x)| + |D(y)| - 2 |D(x) & D(y)|`` elements.  If two sets
link without a common element in their differences, both link with the pivot.  All other linked pairs share
an element among the rarest of each difference (prefix filter), and those that do are counted in full.

Words are what lies between characters of ``[\\x20\\x09-\\x0D]`` after lower-casing A-Z.  A text of fewer
than ``size`` words is one n-gram of all its words; a null or blank text has none, and links with nothing.
Equal sets are one node with their copies as members (sets are told apart by 64 bits of their hash).
Rows that repeat an id are rows of their own.  A component is named by its smallest non-null id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonewise.llm import bloom
from zonewise.llm.common import field, map_rows, materialize, stored
from zonewise.llm.components import components

NUM, DEN = 90, 100
SIZE = 3
PIECES = 2
#: Bands widen by the largest power of the threshold up to this factor.
BAND = 1.4
#: One part in so many is added to those that the method needs.
SPARE = 2
#: Members of a bucket up to which each two are compared by their sketches.
PAIRED = 8
#: Bits left out of a signature: 44 are enough to tell apart, and take less room.
CUT = np.uint64(20)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_KNOWN_WORDS = 300_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct n-gram hashes of a text."""

    def __init__(self, size: int):
        import xxhash

        self.size, self.hash, self.known = size, xxhash.xxh3_64_intdigest, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "replace").lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > _KNOWN_WORDS:
            self.known.clear()
        known, digest, hashes = self.known, self.hash, []
        for word in words:
            value = known.get(word)
            if value is None:
                value = known[word] = digest(word)
            hashes.append(value)
        words = np.array(hashes, np.uint64)
        width = min(self.size, len(words))
        # The width starts the hash: a short text is no n-gram of a longer one.
        value = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            value = mix(value * _ODD + words[i : i + len(value)])
        return np.unique(value)


class Signer:
    """PartEnum signatures for a threshold of ``num / den``."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        # Wide bands waste elements, as the cuts follow the largest set; narrow ones need more signatures.
        self.power = max(1, int(math.log(BAND) / math.log(den / num))) if num < den else 1
        self.uppers: list[int] = [0]
        self.parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def band(self, size: int) -> int:
        """The band of a set size.  Bands widen by a power of the threshold, by 1 at least."""
        while self.uppers[-1] < size:
            low = self.uppers[-1] + 1
            self.uppers.append(max(low, low * self.den**self.power // self.num**self.power))
        return int(np.searchsorted(self.uppers, size))

    def reach(self, size: int) -> int:
        """The largest set that can link with one of this size."""
        return size * self.den // self.num

    def apart(self, band: int) -> int:
        """In how many elements linked sets that sign for the band can differ."""
        return 2 * self.uppers[band] * (self.den - self.num) // (self.den + self.num)

    def _cuts(self, band: int):
        """Borders of the pieces of all parts, and a number for each signature of the band."""
        if band not in self.parts:
            k = self.apart(band)
            least = k // 2 + 1
            cells = PIECES * (least + least // SPARE + 1) if k else 1
            edges = np.array([(i << 64) // cells for i in range(1, cells)], np.uint64)
            names = mix((np.arange(cells, dtype=np.uint64) + np.uint64(1)) * _ODD + np.uint64(band))
            self.parts[band] = edges, names
        return self.parts[band]

    def _sign(self, elements: np.ndarray, sums: np.ndarray, band: int) -> np.ndarray:
        edges, names = self._cuts(band)
        at = np.concatenate(([0], np.searchsorted(elements, edges), [len(elements)]))
        cells = sums[at[1:]] - sums[at[:-1]]
        if len(cells) == 1:
            return mix(cells + names)
        pieces, counts = cells.reshape(-1, PIECES), np.diff(at).reshape(-1, PIECES)
        signs = mix((pieces.sum(axis=1, dtype=np.uint64)[:, None] - pieces).ravel() + names).reshape(-1, PIECES)
        held = (counts.sum(axis=1)[:, None] - counts).astype(np.uint64)
        weight = (held << np.uint64(44)) | (signs >> np.uint64(20))
        # It takes one different element to spoil one signature of a part, two to spoil both.
        worth = np.concatenate((weight.max(axis=1), weight.min(axis=1)))
        at_least = len(worth) - self.apart(band) - 1
        return signs[weight >= np.partition(worth, at_least)[at_least]]

    def __call__(self, elements: np.ndarray) -> np.ndarray:
        if not len(elements):
            return elements
        band = self.band(len(elements))
        self.band(self.reach(len(elements)))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(elements + _ODD), dtype=np.uint64)))
        out = [self._sign(elements, sums, band)]
        if self.reach(len(elements)) > self.uppers[band]:
            self.band(self.uppers[band] + 1)
            out.append(self._sign(elements, sums, band + 1))
        return np.concatenate(out) >> CUT


def sketch(elements: np.ndarray) -> bytes:
    """For each value of the low bits, is the number of elements odd?  As many bits as elements or up to twice that, 64 at least."""
    if not len(elements):
        return b""
    bits = 1 << max(6, (len(elements) - 1).bit_length())
    odd = np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_apart(a: bytes, b: bytes) -> int:
    """In how many elements the sets of two sketches differ at least."""
    a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(a) < len(b):
        a, b = b, a
    if len(a) > len(b):
        a = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0)
    return int(np.bitwise_count(a ^ b).sum())


def _signed(values: list[np.ndarray]) -> pa.Array:
    """Arrays of unsigned numbers as one Arrow list column of longs."""
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.uint64).view(np.int64)))


def _texts(batch, name="x_text"):
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _key(elements: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(elements.tobytes())).view(np.int64)) if len(elements) else 0


def _describe(size: int, num: int, den: int):
    def start():
        shingler, signer = Shingler(size), Signer(num, den)

        def work(batch):
            sets = [shingler(t) for t in _texts(batch)]
            return [[len(s) for s in sets], [_key(s) for s in sets], [sketch(s) for s in sets], _signed([signer(s) for s in sets])]

        return work

    return start


def _collect_sets(size: int):
    def start():
        shingler = Shingler(size)

        def work(batch):
            sets = [shingler(t) for t in _texts(batch)]
            return [[len(s) for s in sets], [_key(s) for s in sets], [s.tobytes() for s in sets]]

        return work

    return start


def _overlap():
    def work(batch):
        left, right = _texts(batch, "x_left"), _texts(batch, "x_right")
        out = []
        for a, b in zip(left, right):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = np.concatenate((a, b))
            both.sort()
            out.append(int((both[1:] == both[:-1]).sum()))
        return [out]

    return work


def _least_apart():
    def work(batch):
        return [[least_apart(a, b) for a, b in zip(_texts(batch, "x_left"), _texts(batch, "x_right"))]]

    return work


def _difference():
    def work(batch):
        sizes, items = [], []
        for a, b in zip(_texts(batch, "x_left"), _texts(batch, "x_right")):
            apart = np.setxor1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True)
            sizes.append(len(apart))
            items.append(apart)
        return [sizes, _signed(items)]

    return work


def describe(docs: DataFrame, id_col: str, text_col: str, size: int = SIZE, num: int = NUM, den: int = DEN) -> DataFrame:
    """``x_id, x_n, x_key, x_sketch, x_sigs`` for every row, stored: size of the set, its key, its sketch, its signatures."""
    rows = docs.select(field(id_col).alias("x_id"), field(text_col).alias("x_text"))
    added = {"x_n": "long", "x_key": "long", "x_sketch": "binary", "x_sigs": "array<long>"}
    return stored(map_rows(rows, _describe(size, num, den), added, drop=("x_text",)))


def buckets(described: DataFrame) -> DataFrame:
    """``sig, key, size, after``: the members of every signature that two or more different sets share, stored.

    ``after`` holds the members with larger keys, all of them in buckets of up to ``PAIRED`` members and none in others.
    """
    signed = described.select(F.explode("x_sigs").alias("sig"), F.col("x_key").alias("key"))
    # Counts compress better than keys; signatures that only copies of one set share go afterwards.
    often = signed.groupBy("sig").agg(F.count(F.lit(1)).alias("often"))
    shared = materialize(often.filter("often > 1").select("sig"))
    words = bloom.words_for(shared.count())
    table = materialize(bloom.members(shared, F.xxhash64("sig"), words))
    likely = bloom.probe(signed, F.xxhash64("sig"), table, words, "x_maybe").filter("x_maybe").drop("x_maybe")
    bucket = Window.partitionBy("sig")
    after = F.collect_list("key").over(bucket.orderBy("key").rowsBetween(1, PAIRED - 1))
    sized = likely.distinct().select("*", F.count(F.lit(1)).over(bucket).alias("size"), after.alias("after")).filter("size > 1")
    return stored(sized.withColumn("after", F.when(F.col("size") <= PAIRED, F.col("after"))))


def _near_by_sketch(members: DataFrame, described: DataFrame, num: int, den: int) -> DataFrame:
    """``a, b``, stored: the pairs of small buckets that may link."""
    pairs = stored(members.select(F.col("key").alias("a"), F.explode("after").alias("b")).distinct())
    ends = pairs.select(F.explode(F.array("a", "b")).alias("x_key")).distinct()
    facts = stored(described.select("x_key", "x_n", "x_sketch").join(ends, "x_key", "left_semi").dropDuplicates(["x_key"]))
    left = facts.select(F.col("x_key").alias("a"), F.col("x_n").alias("n_a"), F.col("x_sketch").alias("x_left"))
    right = facts.select(F.col("x_key").alias("b"), F.col("x_n").alias("n_b"), F.col("x_sketch").alias("x_right"))
    near = F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num
    held = map_rows(pairs.join(left, "a").join(right, "b").filter(near), lambda: _least_apart(), {"least": "long"}, drop=("x_left", "x_right"))
    return stored(held.filter(F.col("least") * (den + num) <= (F.col("n_a") + F.col("n_b")) * (den - num)).select("a", "b"))


def clusters(members: DataFrame, described: DataFrame, num: int, den: int) -> DataFrame:
    """``key, root``, stored: sets that may link with others, and the pivot of their cluster."""
    # A member that meets many others is as a rule the text that the others were made from.  Large buckets are tied
    # together at such members, which are the same in many buckets, and one of them is the pivot.
    met = stored(members.groupBy("key").agg(F.sum("size").alias("met")))
    ranked = members.filter(F.col("size") > PAIRED).select("sig", "key").join(met, "key")
    centres = stored(ranked.groupBy("sig").agg(F.max(F.struct("met", "key")).alias("m")).select("sig", F.col("m.key").alias("a")))
    tied = ranked.join(centres, "sig").filter("a <> key").select("a", F.col("key").alias("b"))
    found = components(_near_by_sketch(members, described, num, den).unionByName(tied))
    central = found.join(met, "key").groupBy("root").agg(F.max(F.struct("met", "key")).alias("m"))
    central = stored(central.select("root", F.col("m.key").alias("pivot")))
    return stored(found.join(central, "root").select("key", F.col("pivot").alias("root")))


def _sets(docs, described, needed, id_col, text_col, size) -> DataFrame:
    """``key, n, elements, root`` of the needed sets (``key, root``), stored.  Only texts that may be needed are read again in full."""
    ids = materialize(described.join(needed.select(F.col("key").alias("x_key")), "x_key", "left_semi").select("x_id"))
    words = bloom.words_for(ids.count())
    rows = docs.select(field(id_col).alias("x_id"), field(text_col).alias("x_text"))
    table = bloom.members(ids, F.xxhash64("x_id"), words)
    likely = bloom.probe(rows, F.xxhash64("x_id"), table, words, "x_maybe").filter("x_maybe").select("x_text")
    found = map_rows(likely, _collect_sets(size), {"n": "long", "key": "long", "elements": "binary"}, drop=("x_text",))
    one = found.groupBy("key").agg(F.first("n").alias("n"), F.first("elements").alias("elements"))
    return materialize(one.join(needed, "key"))


def _verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (``a``, ``b``) that link."""
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("elements").alias("x_left"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("elements").alias("x_right"))
    full = pairs.join(right, "b").join(left, "a")
    counted = map_rows(full, lambda: _overlap(), {"both": "long"}, drop=("x_left", "x_right"))
    linked = F.col("both") * den >= (F.col("n_a") + F.col("n_b") - F.col("both")) * num
    return counted.filter(linked).select("a", "b")


def _differences(sets: DataFrame) -> DataFrame:
    """``root, key, n, n_p, d, items``, stored: how each member of a cluster differs from its pivot."""
    pivots = sets.filter("key = root").select("root", F.col("n").alias("n_p"), F.col("elements").alias("x_right"))
    of = sets.withColumnRenamed("elements", "x_left").join(pivots, "root")
    found = map_rows(of, lambda: _difference(), {"d": "long", "items": "array<long>"}, drop=("x_left", "x_right"))
    return materialize(found)


def _near_pairs(apart: DataFrame, linked, num: int, den: int) -> DataFrame:
    """``a, b``: pairs of a cluster whose differences share one of their rarest elements, and that are not
    both linked with the pivot."""
    # Linked sets x, y differ in at most k elements, so the difference of x is at most k larger than that of y.
    # The smaller difference must share one of its first k/2 + 1 elements with the first k + 1 of the larger.
    reach = F.floor(F.col("n") * den / num) + F.col("n")
    apart = apart.withColumn("k", F.floor(reach * (den - num) / (den + num))).withColumn("linked", linked)
    items = apart.select("root", "key", F.explode("items").alias("item"))
    often = materialize(items.groupBy("root", "item").agg(F.count(F.lit(1)).alias("often")))
    ranked = items.join(often, ["root", "item"]).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("often", "item"))).alias("ranked"))
    first = apart.drop("items").join(ranked, "key")
    spread = first.select("root", "key", "n", "d", "k", "linked", F.posexplode(F.slice("ranked", 1, (F.col("k") + 1).cast("int"))).alias("at", "r"))
    spread = materialize(spread.filter("r.often > 1").withColumn("item", F.col("r.item")).drop("r"))
    names = ("key", "n", "d", "at", "linked")
    small = spread.filter("at <= floor(k / 2)").select("root", "item", *[F.col(c).alias(f"{c}_a") for c in names])
    large = spread.select("root", "item", *[F.col(c).alias(f"{c}_b") for c in names])
    order = (F.col("d_a") < F.col("d_b")) | ((F.col("d_a") == F.col("d_b")) & (F.col("key_a") < F.col("key_b")))
    near = (F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num) & ~(F.col("linked_a") & F.col("linked_b"))
    # If this is the first common element, no more can be common than stand from here on.
    rest = F.least(F.col("d_a") - F.col("at_a"), F.col("d_b") - F.col("at_b"))
    enough = (F.col("d_a") + F.col("d_b") - 2 * rest) * (den + num) <= (F.col("n_a") + F.col("n_b")) * (den - num)
    return small.join(large, ["root", "item"]).filter(order & near & enough).select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct()


def links(docs: DataFrame, described: DataFrame, id_col: str, text_col: str, size: int = SIZE, num: int = NUM, den: int = DEN) -> DataFrame:
    """``a, b``, stored: links between different sets.  They connect what is linked; a link between two sets
    that both link with the same pivot is left out."""
    members = buckets(described)
    sets = _sets(docs, described, clusters(members, described, num, den), id_col, text_col, size)
    apart = _differences(sets)
    linked = F.col("d") * (den + num) <= (F.col("n") + F.col("n_p")) * (den - num)
    to_pivot = apart.filter(linked & F.expr("key <> root")).select(F.col("root").alias("a"), F.col("key").alias("b"))
    pairs = stored(_near_pairs(apart, linked, num, den))
    return materialize(to_pivot.unionByName(_verify(pairs, sets, num, den)))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, num: int = NUM, den: int = DEN) -> DataFrame:
    """One row per input row: the id, ``n_shingles`` and ``component_id`` (the smallest id reachable by links)."""
    described = describe(docs, id_col, text_col, size, num, den)
    found = components(links(docs, described, id_col, text_col, size, num, den))
    facts = described.select("x_id", "x_n", "x_key")
    rooted = facts.filter("x_n > 0").join(found.withColumnRenamed("key", "x_key"), "x_key", "left")
    rooted = materialize(rooted.select("x_id", "x_n", F.coalesce("root", "x_key").alias("root")))
    names = materialize(rooted.groupBy("root").agg(F.min("x_id").alias("component_id")))
    full = rooted.join(names, "root").select("x_id", "x_n", "component_id")
    empty = facts.filter("x_n = 0").select("x_id", "x_n", F.col("x_id").alias("component_id"))
    return full.unionByName(empty).select(F.col("x_id").alias(id_col), F.col("x_n").alias("n_shingles"), "component_id")
