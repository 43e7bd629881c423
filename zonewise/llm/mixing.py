"""Mixing to target weights with soft membership.

A classifier learned from a labelled table gives each document a probability for every domain.  Each
document gets a rate, how often it counts in the mix: rates are not negative, and the expected tokens of a domain,
the sum of rate x tokens x probability over all documents, should match the domain's target.  Rates minimise

    sum over domains of (expected - target)^2 / total^2  +  ridge * (sum of tokens x (rate - 1)^2) / total

by accelerated projected gradient descent.  A document's gradient depends on the others only through the
residual of each domain.  So a step is one distributed sum over all documents, and what returns to the driver is one
number for each domain; the rates themselves are never stored but follow from the list of residuals, worked out
batch by batch.

Learning uses at most about ``SAMPLE_ROWS`` labelled rows, chosen by a hash of the id; rows with a null label are left
out.  Without labelled rows, or with one domain, all rates are the same.  A null or empty text has no tokens; its rate
follows from its probabilities like others', and weighs nothing.  Targets are shares of all tokens; a domain without a
target has target 0; the shares are scaled to sum to 1.  Added columns replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.llm.common import field, map_rows, materialize
from zonewise.llm.ngrams import fit_classes, softmax, word_counts

SAMPLE_ROWS = 4000
FEATURES = 4096
STEPS = 40
RIDGE = 1e-3
TOLERANCE = 1e-4
SHARPNESS = 1.0


@dataclass
class DomainModel:
    domains: list[str]
    weights: np.ndarray
    offset: np.ndarray

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        return softmax(SHARPNESS * (x @ self.weights + self.offset).astype(np.float64))


def _features(size: int):
    def start():
        table: dict = {}

        def work(batch):
            texts = batch.column(batch.schema.get_field_index("x_text")).to_pylist()
            return [[word_counts(t, size, table).astype(np.float16).tobytes() for t in texts]]

        return work

    return start


def train(
    docs: DataFrame,
    labels: DataFrame,
    domain: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = SAMPLE_ROWS,
    features: int = FEATURES,
) -> DomainModel:
    """Learn the domains of ``labels`` (``domain`` is an expression over its columns)."""
    known = labels.select(field(id_col).alias("x_id"), domain.cast("string").alias("x_domain")).filter("x_domain IS NOT NULL AND x_id IS NOT NULL")
    known = materialize(known.groupBy("x_id").agg(F.min("x_domain").alias("x_domain")))
    sizes = {r[0]: r[1] for r in known.groupBy("x_domain").count().collect()}
    if not sizes:
        return DomainModel(["all"], np.zeros((features, 1), np.float32), np.zeros(1, np.float32))
    # Rare domains are taken whole, as far as an even share of the sample goes.
    each, steps = max(1, rows // len(sizes)), 1 << 20
    limits = F.create_map(*[F.lit(x) for k, n in sorted(sizes.items()) for x in (k, min(steps, steps * each // n + 1))])
    chosen = materialize(known.filter(F.pmod(F.xxhash64("x_id"), F.lit(steps)) < F.element_at(limits, F.col("x_domain"))))
    # About ``rows`` rows of two columns, so their size is bounded.
    texts = docs.select(field(id_col).alias("x_id"), field(text_col).alias("x_text")).join(F.broadcast(chosen), "x_id")
    got = map_rows(texts, _features(features), {"x_features": "binary"}, drop=("x_text",)).collect()
    got.sort(key=lambda r: (str(r["x_id"]), r["x_domain"], bytes(r["x_features"])))
    domains = sorted(sizes)
    if len(domains) < 2 or not got:
        return DomainModel(domains, np.zeros((features, len(domains)), np.float32), np.zeros(len(domains), np.float32))
    x = np.array([np.frombuffer(r["x_features"], np.float16) for r in got], np.float32)
    of = np.array([domains.index(r["x_domain"]) for r in got])
    weights, offset = fit_classes(x, of, len(domains))
    # In training the domains weigh the same; the offsets are put back to the shares of the labelled table.
    prior = np.array([sizes[d] for d in domains], float)
    return DomainModel(domains, weights, (offset + np.log(prior / prior.sum())).astype(np.float32))


def _posteriors(shared, text_col: str):
    def start():
        model, table = shared.value, {}
        size = model.weights.shape[0]

        def work(batch):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            x = np.array([word_counts(t, size, table) for t in texts], np.float32).reshape(len(texts), size)
            counts = [len(t.split()) if t else 0 for t in texts]
            return [counts, list(model.posteriors(x)) if len(texts) else []]

        def in_parts(batch):
            # A few hundred rows of features at a time.
            parts = [work(batch.slice(i, 256)) for i in range(0, batch.num_rows, 256)]
            return [sum((p[k] for p in parts), []) for k in range(2)]

        return in_parts

    return start


def memberships(docs: DataFrame, model: DomainModel, text_col: str = "text") -> DataFrame:
    """Add ``n_tokens`` (words) and ``posteriors`` (one probability for each domain, in the model's order)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_rows(docs, _posteriors(shared, text_col), {"n_tokens": "long", "posteriors": "array<double>"})


def rates(posteriors: np.ndarray, history: list, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """The rates after the steps so far, and the points ahead of them where the next gradient is taken."""
    now = ahead = np.ones(len(posteriors))
    for residual, pull in history:
        new = np.maximum(0, ahead - (posteriors @ np.array(residual) + ridge * (ahead - 1)) / (1 + ridge))
        now, ahead = new, new + pull * (new - now)
    return now, ahead


def _matrix(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(width: int, history: list, ridge: float, at_rates: bool):
    """For each batch one row for each domain: its expected tokens."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            p = _matrix(batch.column(1), width)
            rate = rates(p, history, ridge)[0 if at_rates else 1]
            sums = (batch.column(0).to_numpy() * rate) @ p
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(sums)], names=["domain", "tokens"])

    return run


@dataclass
class Mix:
    model: DomainModel
    history: list[tuple[list[float], float]]
    ridge: float
    targets: dict[str, float]
    expected: dict[str, float]

    def rated(self, members: DataFrame) -> DataFrame:
        """``members`` with the column ``rate``."""
        width, history, ridge = len(self.model.domains), self.history, self.ridge

        def start():
            return lambda batch: [rates(_matrix(batch.column(batch.schema.get_field_index("posteriors")), width), history, ridge)[0]]

        return map_rows(members, start, {"rate": "double"})


def solve(members: DataFrame, model: DomainModel, targets: dict[str, float], steps: int = STEPS, ridge: float = RIDGE) -> Mix:
    """Fit the rates to the targets over ``members`` (``n_tokens, posteriors``), which should be stored."""
    width = len(model.domains)
    share = np.array([max(0.0, targets.get(d, 0.0)) for d in model.domains])
    share = share / share.sum() if share.sum() > 0 else np.full(width, 1.0 / width)
    total = members.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    history: list[tuple[list[float], float]] = []

    def expected(at_rates: bool) -> np.ndarray:
        parts = members.select("n_tokens", "posteriors").mapInArrow(_sums(width, list(history), ridge, at_rates), "domain long, tokens double")
        found = {r[0]: r[1] for r in parts.groupBy("domain").agg(F.sum("tokens")).collect()}
        return np.array([found.get(i, 0.0) for i in range(width)]) / max(total, 1)

    momentum = 1.0
    for _ in range(steps if total and width > 1 else 0):
        residual = expected(False) - share
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        history.append((residual.tolist(), (momentum - 1) / following))
        momentum = following
        if np.abs(residual).max() < TOLERANCE:
            break
    reached = expected(True) * total
    return Mix(model, history, ridge, dict(zip(model.domains, share * total)), dict(zip(model.domains, reached)))


def mixed(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` in the mix: rows with rate 0 go, the others stand ``copies`` times, numbered by ``copy_no``.

    ``rate`` is the document's rate and ``weight`` the rate of each copy, so that weights sum to rates; a
    rate's fraction is settled by a hash of the id, and a document with a positive rate stands once at least.
    """
    members = memberships(docs.select(F.struct("*").alias("x_row"), field(text_col).alias("x_text")), mix.model, "x_text")
    rated = mix.rated(members.select("x_row", "posteriors")).filter("rate > 0")
    fraction = F.pmod(F.xxhash64(F.col("x_row").getField(id_col), F.lit("copies")), F.lit(1 << 20)) / F.lit(1 << 20)
    copies = F.greatest(F.lit(1), F.floor("rate").cast("int") + (fraction < F.col("rate") - F.floor("rate")).cast("int"))
    counted = rated.withColumn("copies", copies)
    added = {"rate": F.col("rate"), "copies": F.col("copies"), "copy_no": F.explode(F.sequence(F.lit(1), F.col("copies"))), "weight": F.col("rate") / F.col("copies")}
    kept = [F.col("x_row").getField(c).alias(c) for c in docs.columns if c.lower() not in added]
    return counted.select(*kept, *[c.alias(n) for n, c in added.items()])
