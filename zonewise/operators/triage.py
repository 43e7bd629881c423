"""Judging breaches: rule triagers, parsed model answers, history, gate."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zonewise.functions import triage as T
from zonewise.functions.once import once
from zonewise.operators.ordered import MILLIS_PER_SEGMENT, asof_join, lookback, span_segment
from zonewise.operators.similarity import best_in_parts
from zonewise.session import materialize

HISTORY_DAYS = 90
HISTORY_SIZE = 5
DAY_MS = 86_400_000

Triager = Callable[[DataFrame], DataFrame]


def _judged(verdict: Column) -> Triager:
    def triage(breaches: DataFrame) -> DataFrame:
        return breaches.withColumn("__v", verdict).select(
            *breaches.columns, F.col("__v.alert").alias("alert"), F.col("__v.severity").alias("severity")
        )

    return triage


def baseline(breaches: DataFrame) -> DataFrame:
    """Adds ``alert`` and ``severity`` by the static thresholds."""
    return _judged(T.baseline())(breaches)


def rubric(breaches: DataFrame) -> DataFrame:
    """Adds ``alert`` and ``severity`` by the rubric."""
    return _judged(T.rubric())(breaches)


def run_triager(breaches: DataFrame, triager: Triager) -> DataFrame:
    """Run any triager; a label, if present, is withheld from it."""
    return triager(breaches.drop("label"))


# ---------------------------------------------------------------- model answers


def backoff_seconds(attempt: int, base: float = 0.5, cap: float = 10.0) -> float:
    """Doubling delay with a small repeating jitter."""
    return min(cap, base * 2**attempt) * (1 + 0.1 * (attempt % 3) / 2)


def _error_code(error: Exception) -> str:
    answer = getattr(error, "response", None)
    code = answer.get("Error", {}).get("Code") if isinstance(answer, dict) else None
    name = type(error).__name__
    return name if name in T.THROTTLE_ERRORS or not code else code


def model_triager(
    ask: Callable[[str], str],
    attempts: int = 5,
    sleep: Callable[[float], None] = time.sleep,
) -> Triager:
    """A triager that asks a model for each row's ``request`` text.

    Adds ``raw`` (the answer) and ``error_code``.  Throttled calls are repeated with
    backoff; whatever still fails becomes a row with its code, never a failed task.
    """

    def answer(request: str) -> tuple[str | None, str | None]:
        code = None
        for attempt in range(attempts):
            try:
                return ask(request), None
            except Exception as error:
                code = _error_code(error)
                if code not in T.THROTTLE_ERRORS:
                    break
                if attempt + 1 < attempts:
                    sleep(backoff_seconds(attempt))
        return None, code

    def batches(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            answers = [answer(request) for request in chunk["request"]]
            yield chunk.assign(raw=[a for a, _ in answers], error_code=[c for _, c in answers])

    def triage(breaches: DataFrame) -> DataFrame:
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in breaches.schema]
        return breaches.mapInPandas(batches, ", ".join([*fields, "raw string", "error_code string"]))

    return triage


def parse_decisions(answers: DataFrame, raw: str = "raw", breach: str = "breach") -> DataFrame:
    """Model answers as normalised decisions: adds ``decision`` (struct) and ``decision_error``.

    The answer may be a JSON object or text around one.  The decision follows from the
    severity, whatever the answer claims.  Unusable answers get an error and no decision.
    """
    direct = F.try_parse_json(F.col(raw))
    recovered = F.try_parse_json(T.first_json_object(raw))
    read = answers.withColumn("__a", once(F.coalesce(direct, recovered)))
    answer = F.col("__a")
    severity = F.upper(F.try_variant_get(answer, "$.severity", "string"))
    is_object = F.schema_of_variant(answer).startswith("OBJECT")
    error = (
        F.when(answer.isNull(), "analyzer output is not JSON")
        .when(~is_object, "analyzer output is not a JSON object")
        .when(~F.coalesce(severity.isin(*T.SEVERITIES), F.lit(False)), "unknown severity")
    )
    context = F.col(breach)
    decision = F.struct(
        T.decision_of(F.col("__severity")).alias("decision"),
        F.col("__severity").alias("severity"),
        T.answer_text(answer, "$.reason").alias("reason"),
        T.clamp_confidence(F.try_variant_get(answer, "$.confidence", "double")).alias("confidence"),
        T.answer_text(answer, "$.recommendedAction").alias("recommendedAction"),
        T.answer_text(answer, "$.historicalPattern").alias("historicalPattern"),
        *[context[c].alias(c) for c in ("vehicleId", "zoneId", "zoneName", "zoneKind", "breachType", "location")],
        context["timestamp"].alias("eventTime"),
    )
    return (
        read.withColumn("__severity", severity)
        .withColumn("decision_error", error)
        .withColumn("decision", F.when(F.col("decision_error").isNull(), decision))
        .drop("__a", "__severity")
    )


def gate(decisions: DataFrame) -> DataFrame:
    """Only alerts of deliverable severity go on."""
    return decisions.where(T.passes_gate(F.col("decision.decision"), F.col("decision.severity")))


# ---------------------------------------------------------------- history


def history_rows(decisions: DataFrame) -> DataFrame:
    """What is remembered of each decision, keyed by vehicle."""
    return decisions.where(F.col("decision").isNotNull()).select(
        F.col("decision.vehicleId").alias("vehicleId"),
        F.col("decision.eventTime").alias("eventTime"),
        F.col("breach"),
        F.struct("decision.severity", "decision.reason", "decision.eventTime").alias("decision"),
    )


def last_decisions(
    history: DataFrame, k: int = HISTORY_SIZE, tie: str = "seq", span_ms: int = MILLIS_PER_SEGMENT
) -> DataFrame:
    """Adds ``prior``: the up to ``k`` decisions of the vehicle before each one, newest last."""
    rest = [c for c in history.columns if c != "vehicleId"]
    return lookback(
        history,
        ["vehicleId"],
        ["eventTime", tie],
        span_segment("eventTime", span_ms),
        {"prior": lambda w: F.collect_list(F.struct(*rest)).over(w.rowsBetween(-k, -1))},
        depth=k,
    )


def with_history(
    breaches: DataFrame,
    history: DataFrame,
    k: int = HISTORY_SIZE,
    days: int = HISTORY_DAYS,
    tie: str = "seq",
    span_ms: int = MILLIS_PER_SEGMENT,
) -> DataFrame:
    """Adds ``history``: the up to ``k`` decisions before each breach that have not expired.

    Every history row first learns its own last ``k`` rows; each breach then needs only the
    newest history row before it, an as-of join.
    """
    rest = [c for c in history.columns if c != "vehicleId"]
    runs = lookback(
        history,
        ["vehicleId"],
        ["eventTime", tie],
        span_segment("eventTime", span_ms),
        {"run": lambda w: F.collect_list(F.struct(*rest)).over(w.rowsBetween(-(k - 1), 0))},
        depth=max(k - 1, 1),
    ).select("vehicleId", "eventTime", tie, "run")
    found = asof_join(
        breaches,
        runs,
        ["vehicleId"],
        "timestamp",
        "eventTime",
        "__h",
        tie=tie,
        allow_exact=False,
        span=span_ms,
    )
    oldest = F.col("timestamp") - days * DAY_MS
    live = F.filter(F.col("__h.run"), lambda h: h["eventTime"] >= oldest)
    return found.withColumn("history", F.coalesce(live, F.array())).drop("__h")


def request_texts(rows: DataFrame, breach: list[str], history: str = "history", into: str = "request") -> DataFrame:
    """Add the request text of each row: its ``breach`` columns, then its ``history``."""
    event = StructType([rows.schema[c] for c in breach])
    return rows.withColumn(into, T.request_text(F.struct(*breach), event, F.col(history), rows.schema[history].dataType))


def similar_history(history: DataFrame, query: list[float], owner: str, vector: str, item: str, k: int) -> DataFrame:
    """The ``k`` history items of every owner most similar to a query vector (cosine).

    The ranking limit is applied on both sides of the shuffle, so an owner sends no more
    than ``k`` rows per task.
    """
    from pyspark.sql import Window

    asked = F.array(*[F.lit(float(x)) for x in query])
    norm = sum(x * x for x in query) ** 0.5

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)

    dot = total(F.zip_with(F.col(vector), asked, lambda a, b: a.cast("double") * b))
    length = F.sqrt(total(F.transform(F.col(vector), lambda a: a.cast("double") * a.cast("double"))))
    scored = history.select(owner, item, F.try_divide(dot, length * norm).alias("similarity"))
    rank = F.row_number().over(Window.partitionBy(owner).orderBy(F.desc("similarity"), F.asc(item)))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


#: Cells of the coarse index, cells looked into for each question, and rows that the cells are learned from.
CELLS, PROBES, CELL_SAMPLE = 64, 8, 20_000


def _dot(a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (x, y) -> x * y), 0D, (s, x) -> s + x)"


def _with_length(rows: DataFrame, vector: str) -> DataFrame:
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    return rows.withColumn("__v", doubles).withColumn("__n", F.expr(f"sqrt({_dot('__v', '__v')})"))


def coarse_cells(history: DataFrame, vector: str, cells: int = CELLS, sample: int = CELL_SAMPLE, seed: int = 1) -> list[list[float]]:
    """Directions that divide the vectors into cells (k-means by cosine), learned from about ``sample`` rows."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    usable = _with_length(history, vector).where("__n > 0")
    n = usable.count()
    drawn = usable.sample(min(1.0, sample / n), seed) if n else usable
    rows = materialize(drawn.select(array_to_vector("__v").alias("features")))
    if rows.isEmpty():
        return []
    model = KMeans(k=cells, seed=seed, distanceMeasure="cosine", maxIter=10).fit(rows)
    return [[float(x) for x in center] for center in model.clusterCenters()]


def similar_to_each(
    asked: DataFrame,
    history: DataFrame,
    owner: str,
    vector: str,
    item: str,
    k: int,
    ask: str = "ask_id",
    cells: list[list[float]] | None = None,
    probes: int = PROBES,
) -> DataFrame:
    """``ask, owner, item, similarity, rank``: for each question the ``k`` most similar history items of its owner (cosine).

    Without ``cells`` a question meets every item of its owner, in blocks (``similarity``): exact.  With ``cells`` (``coarse_cells``) each item lies in the cell of
    the nearest direction, and a question meets those in its ``probes`` nearest cells; similarities are exact, an item in
    another cell is missed.  Items are joined by owner and cell, where adaptive execution splits a cell that holds too many,
    and of each question only ``k`` rows leave a task.  Vectors without length are similar to nothing.
    """
    from pyspark.sql import Window

    left = _with_length(asked, vector).where("__n > 0").select(ask, owner, "__v", "__n")
    right = _with_length(history, vector).where("__n > 0").select(owner, item, "__v", "__n")
    if not cells:
        scored = best_in_parts(left, right, ask, owner, item, k).withColumn("similarity", F.round("similarity", 9))
    else:
        left = left.withColumnsRenamed({"__v": "__a", "__n": "__an"})
        centers = F.from_json(F.lit(json.dumps(cells)), "array<array<double>>")

        def near(frame: DataFrame, v: str, n: int) -> DataFrame:
            held = frame.withColumn("__c", centers)
            order = F.expr(f"slice(sort_array(transform(__c, (c, i) -> struct(-{_dot('c', v)} / sqrt({_dot('c', 'c')}) AS d, i AS cell))), 1, {n})")
            return held.withColumn("__o", F.explode(order)).withColumn("__cell", F.col("__o.cell")).drop("__c", "__o")

        similarity = F.round(F.expr(f"{_dot('__a', '__v')} / (__an * __n)"), 9)
        pairs = near(left, "__a", probes).join(near(right, "__v", 1), [owner, "__cell"])
        scored = pairs.select(ask, owner, item, similarity.alias("similarity"))
    rank = F.row_number().over(Window.partitionBy(ask).orderBy(F.desc("similarity"), F.asc(item)))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)
