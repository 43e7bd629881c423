"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every word is predicted from the words on both of its sides: their vectors, one table for each place in the
window, are added and pass through tanh; a two-level softmax gives the probability of the word's class and of
the word within its class.  The sum of the log-probabilities of all words is the score of a document.

The vocabulary is all words of all documents, counted into a stored table that grows with them.  Its ``WORDS - BUCKETS``
most frequent words are tokens of the network; the others share ``BUCKETS`` tokens by a hash, and the probability of such a word is
that of its bucket in the context times that of the word in its bucket, ``n / (N + T)``: ``n`` mentions of the word, ``N`` of
all ``T`` words of the bucket.  A word never counted has the bucket's share ``T / (N + T)`` times that of its spelling, any
byte or the end being one of 257.  The counts of up to ``CACHED`` words, the most frequent, go to the tasks; those of all others
come by a join on the word, so none is left out.

Training reads all documents, each in one of ``ROUNDS`` rounds (by a hash of the
text): in a round each task starts from the current network and runs through its texts by minibatch gradient
descent in numpy; the networks are averaged, weighted by their tokens, as one distributed sum for each
parameter.  What the driver holds is one network, totals for each bucket and the cached words.

A null text, or one without words, has 0 tokens, score 0 and a null mean.  Words are runs of characters
other than ASCII white space, lower-cased.  With no words in the corpus every text scores as under a uniform network and
by the spelling of its words.
Added columns replace input columns of the same name.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonewise.llm.common import field, stored

WORDS = 1024
BUCKETS = 256
CLASSES = 32
SPAN = 2
WIDTH = 12
ROUNDS = 4
BATCH = 4096
RATE = 10.0
BLOCK = 32768
CACHED = 1 << 17
#: Words of one task counted together.
COUNTED = 1 << 18
#: Words beyond the listed ones whose place a task remembers.
MET = 300_000
SPELLING = float(np.log(257))


@dataclass
class Network:
    """``around``: (2 x span, words + 1, width); the last word is the edge of the text."""

    around: np.ndarray
    to_class: np.ndarray  # width + 1, classes
    to_word: np.ndarray  # classes, width + 1, words of a class

    def parameters(self) -> list[np.ndarray]:
        return [self.around, self.to_class, self.to_word]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()])

    def filled(self, values: np.ndarray) -> Network:
        out, at = [], 0
        for p in self.parameters():
            out.append(values[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Network(*out)


def new_network(words: int = WORDS, classes: int = CLASSES, span: int = SPAN, width: int = WIDTH, seed: int = 5) -> Network:
    rng = np.random.default_rng(seed)
    around = rng.normal(0, 0.3, (2 * span, words + 1, width)).astype(np.float32)
    return Network(around, np.zeros((width + 1, classes), np.float32), np.zeros((classes, width + 1, words // classes), np.float32))


def hidden(net: Network, ids: np.ndarray, edge: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The state for each place of ``ids``, with a constant 1, and the context ids it was made from.

    ``ids`` holds texts one after another, each followed by as many edge marks as the window is wide.
    """
    span = len(net.around) // 2
    padded = np.concatenate((np.full(span, edge, np.int32), ids, np.full(span, edge, np.int32)))
    places = [k for k in range(2 * span + 1) if k != span]
    contexts = [padded[k : k + len(ids)] for k in places]
    state = np.take(net.around[0], contexts[0], axis=0)
    for table, context in zip(net.around[1:], contexts[1:]):
        state += np.take(table, context, axis=0)
    return np.concatenate((np.tanh(state, out=state), np.ones((len(ids), 1), np.float32)), axis=1), contexts


def _levelled(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``scores``, changed in place to have 0 as their largest in each row, and the logarithms of their normalisers."""
    # A maximum along short rows is slow.
    scores -= np.ascontiguousarray(scores.T).max(axis=0)[:, None]
    return scores, np.log(np.exp(scores).sum(axis=1))


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores, whole = _levelled(scores)
    scores -= whole[:, None]
    return np.exp(scores, out=scores)


def _log_share(scores: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The logarithm of the softmax at the place ``of`` of each row."""
    scores, whole = _levelled(scores)
    return scores[np.arange(len(of)), of] - whole


def log_probabilities(net: Network, ids: np.ndarray, edge: int) -> np.ndarray:
    """Log-probability of each word given the words around it; 0 for edge marks."""
    state, _ = hidden(net, ids, edge)
    real = np.flatnonzero(ids != edge)
    out, classes = np.zeros(len(ids)), net.to_class.shape[1]
    of_class, state = ids[real] % classes, state[real]
    level = _log_share(state @ net.to_class, of_class).astype(float)
    order = np.argsort(of_class, kind="stable")
    cuts = np.searchsorted(of_class[order], np.arange(classes + 1))
    for c in range(classes):
        rows = order[cuts[c] : cuts[c + 1]]
        if len(rows):
            level[rows] += _log_share(state[rows] @ net.to_word[c], ids[real[rows]] // classes)
    out[real] = level
    return out


def train_step(net: Network, ids: np.ndarray, edge: int, rate: float) -> None:
    """One step of gradient descent on a stretch of text, in place."""
    state, contexts = hidden(net, ids, edge)
    real = np.flatnonzero(ids != edge)
    if not len(real):
        return
    classes, words = net.to_class.shape[1], ids[real]
    of_class, seen = words % classes, state[real]
    share = _softmax(seen @ net.to_class)
    share[np.arange(len(real)), of_class] -= 1
    back = share @ net.to_class[:-1].T
    scale = np.float32(rate / len(real))
    order = np.argsort(of_class, kind="stable")
    cuts = np.searchsorted(of_class[order], np.arange(classes + 1))
    for c in range(classes):
        rows = order[cuts[c] : cuts[c + 1]]
        if len(rows):
            part = _softmax(seen[rows] @ net.to_word[c])
            part[np.arange(len(rows)), words[rows] // classes] -= 1
            back[rows] += part @ net.to_word[c, :-1].T
            net.to_word[c] -= scale * (seen[rows].T @ part)
    net.to_class -= scale * (seen.T @ share)
    slope = (back * (1 - seen[:, :-1] ** 2)).astype(np.float32)
    columns = np.ascontiguousarray(slope.T, dtype=float)
    for table, context in zip(net.around, contexts):
        places = context[real].astype(np.int64)
        for k, column in enumerate(columns):
            table[:, k] -= scale * np.bincount(places, column, minlength=len(table)).astype(np.float32)


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").split() if text else []


class Encoder:
    """Words to places: of the ``listed`` words by rank, frequent words first, then of the buckets."""

    def __init__(self, listed: bytes, words: int, buckets: int):
        import xxhash

        self.known = {w: i for i, w in enumerate(listed.split())}
        self.first, self.buckets, self.hash, self.edge = words - buckets, buckets, xxhash.xxh64_intdigest, words
        self.seen = dict(self.known)
        rare = [self.first + self.bucket(w) for w in list(self.known)[self.first :]]
        # Tokens of the network; frequent words are dealt over the classes.
        self.tokens = np.concatenate((np.arange(min(self.first, len(self.known))), rare, self.first + np.arange(buckets))).astype(np.int32)

    def bucket(self, word: bytes) -> int:
        return self.hash(word) % self.buckets

    def places(self, words: list[bytes]) -> np.ndarray:
        try:
            return np.fromiter(map(self.seen.get, words), np.int32, len(words))
        except TypeError:  # a word that was not met before
            if len(self.seen) > len(self.known) + MET:
                self.seen = dict(self.known)
            seen, size = self.seen, len(self.known)
            for word in words:
                if word not in seen:
                    seen[word] = size + self.bucket(word)
            return np.fromiter(map(seen.get, words), np.int32, len(words))

    def __call__(self, text: str | None) -> np.ndarray:
        return self.tokens[self.places(words_of(text))]


@dataclass
class Model:
    """``counts``: word, n of all words.  ``listed``: the most frequent words, at least those that are tokens.

    ``inner``: log-probability of a listed word in its bucket; for words of a bucket that are not listed, the part without ``n``.
    ``unseen``: for each bucket the logarithm of ``T``.
    """

    net: Network
    listed: bytes
    inner: np.ndarray
    unseen: np.ndarray
    counts: DataFrame


def _count(words: int, buckets: int):
    def run(batches):
        import pyarrow as pa

        encode, seen = Encoder(b"", words, buckets), Counter()

        def rows():
            names = [w.decode() for w in seen]
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([encode.bucket(w) for w in seen], pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["word", "bucket", "n"]
            )

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(words_of(text))
                if len(seen) >= COUNTED:
                    yield rows()
                    seen.clear()
        if seen:
            yield rows()

    return run


def count_words(docs: DataFrame, text_col: str, words: int, buckets: int) -> DataFrame:
    """``word, bucket, n`` of all words of all documents, stored."""
    counted = docs.select(field(text_col).cast("string").alias("x_text")).mapInArrow(_count(words, buckets), "word string, bucket int, n long")
    return stored(counted.groupBy("word", "bucket").agg(F.sum("n").alias("n")))


def _listed(counts: DataFrame, size: int, cached: int) -> list:
    """Rows of the ``size`` most frequent words, ties in the order of the words, and of others as common as ``cached`` allows."""
    top = counts.orderBy(F.desc("n"), "word").limit(size).collect()
    # Levels of the counts; those are listed that fit as a whole.
    level = F.floor(16 * F.log2("n"))
    cut, total = None, 0
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        total += r["count"]
        if total > cached:
            break
        cut = r["level"]
    names = {r["word"] for r in top}
    rest = [] if cut is None else [r for r in counts.filter(level >= cut).collect() if r["word"] not in names]
    return top + sorted(rest, key=lambda r: (-r["n"], r["word"]))


def _stretches(texts, encode: Encoder, span: int, size: int):
    """Texts as numbers with edge marks between, in stretches of about ``size`` words."""
    waiting, length = [], 0
    gap = np.full(span, encode.edge, np.int32)
    for text in texts:
        ids = encode(text)
        for at in range(0, len(ids), size):
            waiting += [ids[at : at + size], gap]
            length += len(waiting[-2])
            if length >= size:
                yield np.concatenate(waiting)
                waiting, length = [], 0
    if waiting:
        yield np.concatenate(waiting)


def _train_round(shared, rate: float):
    def run(batches):
        import pyarrow as pa

        net, listed, size, buckets = shared.value
        net, encode, tokens = net.filled(net.flat()), Encoder(listed, size, buckets), 0
        texts = (t for batch in batches for t in batch.column(0).to_pylist())
        for ids in _stretches(texts, encode, len(net.around) // 2, BATCH):
            train_step(net, ids, encode.edge, rate)
            tokens += int((ids != encode.edge).sum())
        if tokens:
            values = net.flat().astype(float) * tokens
            for at in range(0, len(values), BLOCK):
                part = values[at : at + BLOCK]
                places = pa.array(np.arange(at, at + len(part)))
                yield pa.RecordBatch.from_arrays([places, pa.array(part), pa.array(np.full(len(part), tokens, np.int64))], names=["place", "value", "tokens"])

    return run


def train(
    docs: DataFrame, text_col: str = "text", words: int = WORDS, buckets: int = BUCKETS, rounds: int = ROUNDS, rate: float = RATE, cached: int = CACHED
) -> Model:
    """The network and the word counts, both of all documents."""
    spark = docs.sparkSession
    counts = count_words(docs, text_col, words, buckets)
    rows = _listed(counts, words - buckets, cached)
    top = b" ".join(r["word"].encode() for r in rows[: words - buckets])
    net = new_network(words)
    turn = F.pmod(F.xxhash64(field(text_col)), F.lit(rounds))
    texts = docs.select(field(text_col).alias("x_text"), turn.alias("x_turn")).filter("x_text IS NOT NULL")
    for number in range(rounds):
        shared = spark.sparkContext.broadcast((net, top, words, buckets))
        pace = rate * (1 - 0.8 * number / rounds)
        trained = texts.filter(F.col("x_turn") == number).select("x_text").mapInArrow(_train_round(shared, pace), "place long, value double, tokens long")
        # A sum for each parameter over all tasks, combined on the map side.
        means = trained.groupBy("place").agg((F.sum("value") / F.sum("tokens")).alias("value")).collect()
        if means:
            values = net.flat().astype(float)
            values[np.array([r["place"] for r in means])] = [r["value"] for r in means]
            net = net.filled(values)
        shared.unpersist()
    mentions, types = np.zeros(buckets), np.zeros(buckets)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).collect():
        mentions[r["bucket"]], types[r["bucket"]] = r["n"], r["types"]
    for r in rows[: words - buckets]:
        mentions[r["bucket"]] -= r["n"]
        types[r["bucket"]] -= 1
    whole = np.log(np.maximum(mentions + types, 1))
    rare = [np.log(r["n"]) - whole[r["bucket"]] for r in rows[words - buckets :]]
    inner = np.concatenate((np.zeros(min(len(rows), words - buckets)), rare, -whole))
    return Model(net, b" ".join(r["word"].encode() for r in rows), inner, np.log(np.maximum(types, 1)), counts.select("word", "n"))


def _score(shared):
    """For each text a row with its tokens and what the network and the listed words give, and one for each other word.

    ``times`` is how often the word stands there; ``unseen`` the logarithm that stands for ``n`` if it was never counted.
    """

    def run(batches):
        import pyarrow as pa

        net, listed, size, buckets, inner, unseen = shared.value
        encode, span, unseen = Encoder(listed, size, buckets), len(net.around) // 2, unseen.tolist()
        gap, known = np.full(span, encode.edge, np.int32), len(encode.known)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            sums, counts = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            rows, names, times, logs = [], [], [], []
            waiting, owners, length = [], [], 0

            def flush():
                nonlocal waiting, owners, length
                if waiting:
                    ids, of = np.concatenate(waiting), np.concatenate(owners)
                    np.add.at(sums, of, log_probabilities(net, ids, encode.edge))
                waiting, owners, length = [], [], 0

            for i, text in enumerate(texts):
                words = words_of(text)
                if not words:
                    continue
                places = encode.places(words)
                counts[i] = len(words)
                sums[i] += inner[places].sum()
                waiting += [encode.tokens[places], gap]
                owners.append(np.full(len(words) + span, i))
                length += len(words)
                rare = np.flatnonzero(places >= known).tolist()
                if rare:
                    found = Counter([words[k] for k in rare])
                    rows += [i] * len(found)
                    names += [w.decode() for w in found]
                    times += found.values()
                    logs += [unseen[encode.seen[w] - known] - (len(w) + 1) * SPELLING for w in found]
                if length >= BLOCK:
                    flush()
            flush()
            # No word has a space, so this row meets no count.
            heads = [f" {key}" for key in batch.column(0).to_pylist()]
            keys = [pa.concat_arrays([batch.column(k), batch.column(k).take(pa.array(rows, pa.int64()))]) for k in (0, 1)]
            none, n = [0] * len(texts), len(rows)
            rest = [pa.array(heads + names, pa.string()), pa.array(none + times, pa.int64()), pa.array(none + logs, pa.float64())]
            rest += [pa.array([*counts.tolist(), *[None] * n], pa.int64()), pa.array([*sums.tolist(), *[None] * n], pa.float64())]
            yield pa.RecordBatch.from_arrays(keys + rest, names=["x_lm_row", "x_lm_of", "word", "times", "unseen", "tokens", "value"])

    return run


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return _hashable(kind.elementType) if isinstance(kind, T.ArrayType) else isinstance(kind, T.AtomicType) and "variant" not in kind.typeName()


def score(docs: DataFrame, model: Model, text_col: str = "text", words: int = WORDS, buckets: int = BUCKETS) -> DataFrame:
    """Add ``lm_tokens``, ``log_likelihood`` (natural logarithm, summed) and ``mean_log_likelihood``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.net, model.listed, words, buckets, model.inner, model.unseen))
    # Rows of one key have the same text, so that equal rows need no telling apart; copies with other ids spread over the tasks.
    whole = [field(f.name) for f in docs.schema if _hashable(f.dataType)]
    keys = [F.xxhash64(*whole).alias("x_lm_row"), F.xxhash64(field(text_col)).alias("x_lm_of")]
    found = docs.select(*keys, field(text_col).cast("string").alias("x_text")).mapInArrow(
        _score(shared), "x_lm_row long, x_lm_of long, word string, times long, unseen double, tokens long, value double"
    )
    value = F.col("times") * F.coalesce(F.log("n"), "unseen")
    # Equal rows give their words as often as they stand.
    scored = found.join(model.counts, "word", "left").groupBy("x_lm_row", "x_lm_of").agg(
        F.max("tokens").alias("x_lm_tokens"), (F.max("value") + F.sum(value) / F.count("tokens")).alias("x_lm_total")
    )
    both = docs.select("*", *keys).join(scored, ["x_lm_row", "x_lm_of"])
    added = {
        "lm_tokens": F.col("x_lm_tokens"),
        "log_likelihood": F.col("x_lm_total"),
        "mean_log_likelihood": F.when(F.col("x_lm_tokens") > 0, F.col("x_lm_total") / F.col("x_lm_tokens")),
    }
    return both.select(*[field(c) for c in docs.columns if c.lower() not in added], *[c.alias(name) for name, c in added.items()])
