"""URL filtering: rules first, and gradient-boosted trees on lexical features for the rest.

The trees learn from labelled URLs (``url, blocked``); the urls that a rule decides are such labels.  Features:
lengths, depth, labels of the host, digit ratio, entropy of the characters, parameters, and how often urls with the
same last one or two labels of the host are blocked among all labelled rows.

The trees are fitted on at most about ``MAX_ROWS`` labelled rows, chosen by a hash of the url; shares and counts are those of
all.  If all labelled rows are of one kind every other url gets that verdict; if there are none, ``allow``.  If no
row is chosen, as there are few different urls, the overall share decides.  A null url, or one without ``://``, has an empty host
and path, no rule, and goes to the trees with features of 0.  Added columns replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.llm.common import ascii_lower, field, materialize

MAX_ROWS = 1_000_000
TREES, DEPTH, RATE = 20, 4, 0.3
SUFFIX_PRIOR = 20.0
FEATURES = [
    "f_length", "f_host", "f_path", "f_depth", "f_labels", "f_digits", "f_entropy", "f_params", "f_fragment", "f_hyphens",
    "f_secure", "f_one_rate", "f_one_seen", "f_two_rate", "f_two_seen",
]


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains and a start of the path."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _part(url: Column, number: int) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", number), F.lit(""))


def host_of(url: Column) -> Column:
    return ascii_lower(_part(url, 1))


def path_of(url: Column) -> Column:
    return _part(url, 2)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """``text, verdict`` of the longest rule that fits, or null."""
    best = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        hit = F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))
        best = F.when(fits & F.startswith(path, F.lit(rule.path)), hit).otherwise(best)
    return best


def _entropy(text: Column) -> Column:
    size = F.greatest(F.char_length(text), F.lit(1)).cast("double")
    share = lambda c: (F.char_length(text) - F.char_length(F.replace(text, c, F.lit("")))) / size
    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda sum_, c: sum_ - F.when(share(c) > 0, share(c) * F.log2(share(c))).otherwise(0.0))


def _lexical(rows: DataFrame) -> DataFrame:
    """Features of ``x_url, x_host, x_path``, and the last one and two labels of the host."""
    url, host, path = F.coalesce("x_url", F.lit("")), F.col("x_host"), F.col("x_path")
    size = F.char_length(url).cast("double")
    count = lambda pattern, text: F.regexp_count(text, F.lit(pattern)).cast("double")
    rest = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return rows.select(
        "*",
        size.alias("f_length"),
        F.char_length(host).cast("double").alias("f_host"),
        F.char_length(path).cast("double").alias("f_path"),
        count("/", path).alias("f_depth"),
        count(r"\.", host).alias("f_labels"),
        (count("[0-9]", url) / F.greatest(size, F.lit(1.0))).alias("f_digits"),
        _entropy(url).alias("f_entropy"),
        count("=", rest).alias("f_params"),
        F.contains(url, F.lit("#")).cast("double").alias("f_fragment"),
        count("-", host).alias("f_hyphens"),
        F.startswith(url, F.lit("https")).cast("double").alias("f_secure"),
        F.substring_index(host, ".", -1).alias("x_one"),
        F.substring_index(host, ".", -2).alias("x_two"),
    )


def _suffixes(rows: DataFrame, share: float) -> list[DataFrame]:
    """How often the last label and the last two labels are blocked among all labelled rows, drawn towards the overall share."""
    n, b = F.sum("x_n"), F.sum("x_b")
    # The last label is part of the last two.
    pairs = materialize(rows.groupBy("x_one", "x_two").agg(F.count(F.lit(1)).alias("x_n"), F.sum("x_blocked").alias("x_b")))

    def table(name: str, prefix: str) -> DataFrame:
        rate = ((b + SUFFIX_PRIOR * share) / (n + SUFFIX_PRIOR)).alias(f"f_{prefix}_rate")
        return materialize(pairs.groupBy(F.col(name).alias(f"{name}_of")).agg(rate, F.log1p(n.cast("double")).alias(f"f_{prefix}_seen")))

    return [table("x_one", "one"), table("x_two", "two")]


def _with_suffixes(rows: DataFrame, model: UrlModel) -> DataFrame:
    for name, prefix, table in (("x_one", "one", model.one), ("x_two", "two", model.two)):
        rows = rows.join(table, F.col(name) == F.col(f"{name}_of"), "left").drop(f"{name}_of")
        rows = rows.fillna({f"f_{prefix}_rate": model.share, f"f_{prefix}_seen": 0.0})
    return rows


@dataclass
class UrlModel:
    share: float
    one: DataFrame | None = None
    two: DataFrame | None = None
    trees: object = None


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked", max_rows: int = MAX_ROWS) -> UrlModel:
    """Learn from urls with a label of 0 or 1; rows with a null label or url are left out."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    url = field(url_col)
    rows = labelled.filter(url.isNotNull() & field(label_col).isNotNull()).select(
        url.alias("x_url"), host_of(url).alias("x_host"), path_of(url).alias("x_path"), field(label_col).cast("double").alias("x_blocked")
    )
    count, share = rows.agg(F.count(F.lit(1)), F.avg("x_blocked")).first()
    if share is None or share in (0.0, 1.0):
        return UrlModel(share or 0.0)
    rows = _lexical(rows)
    chosen = rows
    if count > max_rows:
        draw = F.pmod(F.xxhash64("x_url"), F.lit(1 << 30))
        chosen = rows.filter(draw < int((1 << 30) * max_rows / count))
    model, chosen = UrlModel(share, *_suffixes(rows, share)), materialize(chosen)
    if chosen.isEmpty():
        return model
    ready = VectorAssembler(inputCols=FEATURES, outputCol="x_features").transform(_with_suffixes(chosen, model))
    learner = GBTClassifier(featuresCol="x_features", labelCol="x_blocked", maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=1)
    model.trees = learner.fit(ready.select("x_features", "x_blocked"))
    return model


def judge(rows: DataFrame, model: UrlModel, rules: list[Rule], url_col: str = "url") -> DataFrame:
    """Add ``host, path, rule, verdict`` and ``block_score`` (null where a rule decides)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    url = field(url_col)
    packed = rows.select(F.struct("*").alias("x_row"), url.alias("x_url"), host_of(url).alias("x_host"), path_of(url).alias("x_path"))
    packed = packed.withColumn("x_rule", rule_for(F.col("x_host"), F.col("x_path"), rules))
    if model.trees is None:
        scored = packed.withColumn("x_score", F.lit(float(model.share)))
    else:
        ready = VectorAssembler(inputCols=FEATURES, outputCol="x_features").transform(_with_suffixes(_lexical(packed), model))
        scored = model.trees.transform(ready).withColumn("x_score", vector_to_array("probability")[1])
    by_trees = F.when(F.col("x_score") >= 0.5, "block").otherwise("allow")
    added = {
        "host": F.col("x_host"),
        "path": F.col("x_path"),
        "rule": F.col("x_rule.text"),
        "verdict": F.coalesce(F.col("x_rule.verdict"), by_trees),
        "block_score": F.when(F.col("x_rule").isNull(), F.col("x_score")),
    }
    kept = [F.col("x_row").getField(c).alias(c) for c in rows.columns if c.lower() not in added]
    return scored.select(*kept, *[c.alias(n) for n, c in added.items()])
