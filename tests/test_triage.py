"""Rule triagers on the labelled events, decision parsing, history, model calls."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonewise.functions import triage as T
from zonewise.operators import evaluation as E
from zonewise.operators import triage as ops
from zonewise.schemas import BREACH
from zonewise.sources.fixed import local_table

AT = 1782458400000
# Vehicle, kind, type, distance, duration, accuracy, other signals, label, baseline, rubric.
LABELLED = [
    ("veh-001", "containment", "exit", 300.0, 120, 3.0, {}, "genuine", "CRITICAL", "CRITICAL"),
    ("veh-002", "exclusion", "entry", 0.0, 45, 4.0, {"speed": 30.0}, "genuine", "HIGH", "HIGH"),
    ("veh-003", "exclusion", "entry", 0.0, 40, 5.0, {}, "genuine", "HIGH", "HIGH"),
    ("veh-004", "containment", "exit", 150.0, 90, 6.0, {"doorOpen": True, "speed": 50.0}, "genuine", "CRITICAL", "CRITICAL"),
    ("veh-011", "containment", "exit", 22.0, 16, 18.0, {"doorOpen": True, "speed": 55.0}, "genuine", "LOW", "CRITICAL"),
    ("veh-005", "exclusion", "entry", 5.0, 5, 25.0, {}, "false_positive", "LOW", "LOW"),
    ("veh-006", "exclusion", "entry", 3.0, 3, 30.0, {}, "false_positive", "LOW", "LOW"),
    ("veh-007", "dwell", "entry", 0.0, 10, 4.0, {}, "false_positive", "LOW", "LOW"),
    ("veh-008", "dwell", "exit", 0.0, 25, 5.0, {}, "false_positive", "LOW", "LOW"),
    ("veh-009", "containment", "exit", 8.0, 4, 20.0, {}, "false_positive", "LOW", "LOW"),
    ("veh-010", "exclusion", "entry", 10.0, 8, 18.0, {}, "false_positive", "LOW", "LOW"),
    ("veh-012", "exclusion", "entry", 30.0, 25, 24.0, {"speed": 15.0}, "false_positive", "HIGH", "LOW"),
]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [
        {
            "vehicleId": v,
            "zoneId": "z",
            "zoneName": "Z",
            "zoneKind": kind,
            "breachType": edge,
            "timestamp": AT,
            "location": {"latitude": 51.0, "longitude": -114.0, "accuracy": accuracy},
            "distanceOutsideM": distance,
            "durationInStateS": duration,
            "vehicle": {"speed": 45.0, "ignition": True, "doorOpen": False} | signals,
        }
        for v, kind, edge, distance, duration, accuracy, signals, *_ in LABELLED
    ]
    return local_table(spark, rows, BREACH)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(r[0], AT, r[7]) for r in LABELLED], "vehicleId string, timestamp long, label string")


def test_verdicts(labelled):
    for triager, column in ((ops.baseline, 8), (ops.rubric, 9)):
        got = {r.vehicleId: (r.severity, r.alert) for r in triager(labelled).collect()}
        assert got == {r[0]: (r[column], r[column] != "LOW") for r in LABELLED}


def test_scores(labelled, labels):
    base = E.evaluate(labelled, labels, ops.baseline).first()
    assert (base.tp, base.fn, base.fp, base.tn) == (4, 1, 1, 6)
    assert base.false_positive_suppression == pytest.approx(6 / 7) and base.genuine_retention == 0.8
    assert base.precision == base.recall == 0.8 and base.f1 == pytest.approx(0.8)
    best = E.evaluate(labelled, labels, ops.rubric).first()
    assert (best.tp, best.tn, best.f1) == (5, 7, 1.0)
    row = E.compare(labelled, labels, ops.rubric, "rubric").first()
    assert row.delta_genuine_retention == pytest.approx(0.2) and row.delta_false_positive_suppression == pytest.approx(1 / 7)
    assert row.subject_n == row.baseline_n == 12


def test_score_counts_and_empty_input(spark):
    schema = "label string, alert boolean, cost double"
    rows = [("genuine", True, 0.01), ("genuine", False, 0.01), ("false_positive", True, 0.02), ("false_positive", False, None)]
    one = E.score(spark.createDataFrame(rows, schema)).first()
    assert (one.tp, one.fn, one.fp, one.tn, one.precision, one.recall, one.f1) == (1, 1, 1, 1, 0.5, 0.5, 0.5)
    assert one.cost_total == pytest.approx(0.04) and one.cost_per_event == pytest.approx(0.01)
    none = E.score(spark.createDataFrame([], schema)).first()
    assert (none.n, none.precision, none.recall, none.f1, none.false_positive_suppression, none.cost_per_event) == (0, 1, 1, 1, 1, 1)
    missed = E.score(spark.createDataFrame([("genuine", False, 0.0), ("false_positive", True, 0.0)], schema)).first()
    assert missed.f1 == 0.0


def test_label_is_withheld(labelled, labels):
    seen = []

    def triager(df):
        seen.append("label" in df.columns)
        return ops.baseline(df)

    ops.run_triager(E.join_labels(labelled, labels), triager).collect()
    assert seen == [False]


def _decide(spark, *answers):
    breach = {"vehicleId": "veh-1", "zoneId": "z", "zoneKind": "exclusion", "breachType": "entry", "timestamp": AT}
    one = local_table(spark, [breach], BREACH)
    texts = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "n int, raw string")
    both = texts.join(one.select(F.struct("*").alias("breach")))
    return ops.parse_decisions(both).orderBy("n").collect()


def test_decisions(spark):
    low, medium, high, critical, lower = _decide(
        spark,
        '{"decision":"ALERT","severity":"LOW"}',
        '{"severity":"MEDIUM","confidence":5}',
        '{"severity":"HIGH","confidence":"bogus","reason":"\\n padded "}',
        '{"decision":"NO_ALERT","severity":"CRITICAL","confidence":-2}',
        '{"severity":"high","confidence":"0.25"}',
    )
    assert [r.decision.decision for r in (low, medium, high, critical, lower)] == ["NO_ALERT", "NO_ALERT", "ALERT", "ALERT", "ALERT"]
    assert [r.decision.confidence for r in (low, medium, high, critical, lower)] == [0.0, 1.0, 0.0, 0.0, 0.25]
    assert high.decision.reason == "padded" and lower.decision.severity == "HIGH"
    assert high.decision.vehicleId == "veh-1" and high.decision.eventTime == AT and high.decision.zoneName is None


def test_recovered_and_useless_answers(spark):
    rows = _decide(
        spark,
        'Sure: ```json\n{"severity":"HIGH","reason":"a {b} c"}\n``` ok',
        "not json",
        "[1,2,3]",
        '{"severity":"SEVERE"}',
        "{}",
        None,
        'open { {"severity":"HIGH"}',
    )
    assert rows[0].decision.severity == "HIGH" and rows[0].decision.reason == "a {b} c"
    assert [r.decision for r in rows[1:]] == [None] * 6 and all(r.decision_error for r in rows[1:])


def test_first_json_object(spark):
    texts = {'x {"a":{"b":1}} y}': '{"a":{"b":1}}', "{": None, "none": None, "}{}": "{}", '{"a":"}"}': '{"a":"}'}
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(T.first_json_object("text")).collect()] == list(texts.values())


def test_gate(spark):
    rows = [("ALERT", s) for s in T.SEVERITIES] + [("NO_ALERT", "HIGH"), (None, None)]
    df = spark.createDataFrame(rows, "d string, s string")
    got = [r[0] for r in df.select(T.passes_gate(F.col("d"), F.col("s"))).collect()]
    assert got == [False, False, True, True, False, False]


def test_history_before_each_breach(spark):
    history = spark.createDataFrame(
        [("v", 1000 + i * 10, i, f"s{i}") for i in range(12)] + [("w", 5, 0, "other")],
        "vehicleId string, eventTime long, seq long, severity string",
    )
    breaches = spark.createDataFrame([("v", 1000), ("v", 1035), ("v", 1110), ("v", 9999), ("x", 50)], "vehicleId string, timestamp long")
    for span in (1, 25, 10**6):
        found = ops.with_history(breaches, history, span_ms=span)
        got = {(r.vehicleId, r.timestamp): [h.severity for h in r.history] for r in found.collect()}
        assert got == {
            ("v", 1000): [],
            ("v", 1035): ["s0", "s1", "s2", "s3"],
            ("v", 1110): ["s6", "s7", "s8", "s9", "s10"],
            ("v", 9999): ["s7", "s8", "s9", "s10", "s11"],
            ("x", 50): [],
        }
    old = ops.with_history(spark.createDataFrame([("v", 1000 + 90 * ops.DAY_MS + 95)], "vehicleId string, timestamp long"), history)
    assert [h.severity for h in old.first().history] == ["s10", "s11"]


def test_request_text_has_sorted_keys_at_every_level(spark):
    df = spark.sql("""SELECT struct(array(struct(2 AS z, map('q', 1, 'b', cast(null as int)) AS a)) AS list, cast(null as struct<y:int, x:int>) AS gone,
                   struct('v' AS y, 1 AS x) AS b) AS b, cast(array() AS array<struct<s:string>>) AS h""")
    text = df.select(T.request_text(F.col("b"), df.schema["b"].dataType, F.col("h"), df.schema["h"].dataType)).first()[0]
    assert text.splitlines()[1] == '{"b":{"x":1,"y":"v"},"gone":null,"list":[{"a":{"b":null,"q":1},"z":2}]}'


def test_request_text(spark):
    df = spark.sql("SELECT struct('v' AS vehicleId, cast(null as int) AS n) AS b, array(struct('HIGH' AS severity)) AS h")
    text = df.select(T.request_text(F.col("b"), df.schema["b"].dataType, F.col("h"), df.schema["h"].dataType)).first()[0]
    assert text == 'Breach event:\n{"n":null,"vehicleId":"v"}\n\nVehicle history (1 prior record(s), newest last):\n{"severity":"HIGH"}'
    none = df.select(T.request_text(F.col("b"), df.schema["b"].dataType, F.expr("array_remove(h, h[0])"), df.schema["h"].dataType)).first()[0]
    assert none.endswith("Vehicle history: none on record.")


class ThrottlingException(Exception):
    pass


def test_model_triager_retries_throttles_only(spark):
    requests = spark.createDataFrame([("ok",), ("throttled",), ("broken",)], "request string").coalesce(1)

    def ask(request):
        if request == "throttled":
            raise type("ThrottlingException", (Exception,), {})("busy")
        if request == "broken":
            raise ValueError("no")
        return '{"severity":"HIGH"}'

    triager = ops.model_triager(ask, attempts=3, sleep=lambda s: None)
    rows = {r.request: (r.raw, r.error_code) for r in ops.run_triager(requests, triager).collect()}
    assert rows == {
        "ok": ('{"severity":"HIGH"}', None),
        "throttled": (None, "ThrottlingException"),
        "broken": (None, "ValueError"),
    }


def test_retry_attempts_and_backoff():
    waits, calls = [], []

    def ask(request):
        calls.append(request)
        if len(calls) < 3:
            raise ThrottlingException()
        return "answer"

    triager = ops.model_triager(ask, sleep=waits.append)
    batches = triager.__closure__  # the per-batch function runs without Spark
    run = next(c.cell_contents for c in batches if callable(c.cell_contents))
    import pandas as pd

    (out,) = run(iter([pd.DataFrame({"request": ["r"]})]))
    assert out["raw"].tolist() == ["answer"] and len(calls) == 3
    assert waits == [ops.backoff_seconds(0), ops.backoff_seconds(1)]
    assert [ops.backoff_seconds(n) for n in (0, 1, 2)] == [0.5, pytest.approx(1.05), pytest.approx(2.2)]
    assert ops.backoff_seconds(9) <= 11


def test_similar_history_of_each_question(spark):
    """The exact mode is brute force; the index finds nine of ten and compares few."""
    rng = np.random.default_rng(4)
    places = rng.normal(size=(40, 16))
    vectors = np.concatenate([places[rng.integers(40, size=3000)] + rng.normal(size=(3000, 16)) * 0.25, np.zeros((1, 16))])
    owners = rng.integers(2, size=len(vectors))
    rows = [(i, int(o), [float(x) for x in v]) for i, (o, v) in enumerate(zip(owners, vectors))]
    history = spark.createDataFrame([*rows, (9001, 0, None)], "item bigint, owner int, vector array<float>")
    asked = history.where("item % 50 = 0").withColumnRenamed("item", "ask_id")

    def top(**kw):
        out = {}
        for r in ops.similar_to_each(asked, history, "owner", "vector", "item", 5, **kw).collect():
            out.setdefault(r.ask_id, []).append((r["rank"], r.item))
        return {a: [i for _, i in sorted(found)] for a, found in out.items()}

    unit = vectors.astype(np.float32).astype(float)
    length = np.linalg.norm(unit, axis=1)
    want = {}
    for a in range(0, 3000, 50):
        with np.errstate(invalid="ignore", divide="ignore"):
            score = np.round(unit @ unit[a] / (length * length[a]), 9)
        same = [i for i in range(3000) if owners[i] == owners[a]]
        want[a] = sorted(same, key=lambda i: (-score[i], i))[:5]
    assert top() == want
    cells = ops.coarse_cells(history, "vector", cells=24, sample=1500)
    found = top(cells=cells, probes=4)
    recall = sum(len(set(found.get(a, [])) & set(w)) for a, w in want.items()) / sum(map(len, want.values()))
    assert recall >= 0.9, recall
    assert top(cells=cells, probes=len(cells)) == want


def test_similarity_in_blocks_is_that_of_all_pairs(spark, monkeypatch):
    """Ties, copies, rows that cannot be compared, and parts smaller than an owner: as the SQL over every pair, without forming it."""
    from zonewise.operators import similarity

    monkeypatch.setattr(similarity, "PART_ROWS", 64)
    rng = np.random.default_rng(5)
    rows = [(i, f"o{i % 3}" if i % 5 else "big", [float(x) for x in rng.integers(-2, 3, size=4)]) for i in range(400)]
    rows += [(i, "big", [1.0, 2.0, 0.0, 1.0]) for i in range(390, 450)]  # copies; ids occur twice
    rows += [(500, "big", [1.0, 2.0]), (501, "big", [1.0, None, 0.0, 1.0]), (502, None, [1.0] * 4), (503, "big", [float("nan")] * 4)]
    rows += [(None, "big", [1.0, 2.0, 0.0, 1.0]), (505, "few", [3.0, 1.0]), (506, "few", [1.0, 2.0, 3.0]), (507, "big", [1.0, 2.0, 1e-10, 1.0])]
    history = spark.createDataFrame(rows, "item bigint, owner string, vector array<float>")
    asked = history.where("item % 7 = 0 OR item >= 500").withColumnRenamed("item", "ask_id")
    found = ops.similar_to_each(asked, history, "owner", "vector", "item", 5)
    # With a single cell the SQL forms every pair.
    pairs = ops.similar_to_each(asked, history, "owner", "vector", "item", 5, cells=[[1.0] * 4], probes=1)

    def values(frame):
        return sorted(repr(tuple(r)) for r in frame.select("ask_id", "owner", "item", "similarity", "rank").collect())

    assert values(found) == values(pairs)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().executedPlan().toString()
