"""Quality classifier by Bradley-Terry ranking: scores learned from which document is preferred.

A document labelled good is preferred to one labelled bad. The probability of a preference is the
logistic function of the difference of the two scores, a score being linear in measures of the text;
so the weights come from a logistic fit on differences of features. The threshold is a quantile of the
scores of the labelled documents: that which leaves the labelled share of good ones above it. Scores
are then shifted so that the threshold reads ``CUT``.

The measures of all documents are one pass of DataFrame expressions. The fit takes every labelled document:
those of the larger class are numbered and cut into teams, each beside a team as large that goes through
the smaller class in turn, and all preferences between two teams count. A Newton step is one pass over
the teams that adds up slopes and curvatures; only these sums reach the driver. The quantile is exact.

Defined cases: null and empty texts have zero measures and a score like any other; labels that are
null or of unknown documents are not used; without both labels every score is 0.5; equal texts get
equal scores; repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import matches
from tickloom.llm.weak_rules import measures
from tickloom.operators.aggregate import exact_ranks
from tickloom.operators.skew import attach, with_row_index
from tickloom.session import stage

CUT = 0.7
#: SQL over the measures ``m`` of a text and two counts beside them
FEATURES = {
    "size": "ln(1 + m.n_words)",
    "short": "case when m.n_words < 20 then 1 else 0 end",
    "word_length": "m.word_chars / greatest(m.n_words, 1)",
    "odd_length": "abs(m.word_chars / greatest(m.n_words, 1) - 5)",
    "symbols": "ln(1 + 10 * m.n_symbols / greatest(m.n_words, 1))",
    "dup_lines": "m.n_dup_lines / greatest(m.n_lines, 1)",
    "repeats": "m.n_repeat_words / greatest(m.n_words, 1)",
    "distinct": "m.n_distinct / greatest(m.n_words, 1)",
    "shouted": "m.n_shouted / greatest(m.n_words, 1)",
    "marks": "ln(1 + 10 * n_marks / greatest(m.n_words, 1))",
    "digits": "ln(1 + 10 * n_digits / greatest(m.n_words, 1))",
}


TEAM = 16


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    threshold: float


def _teams(labelled: DataFrame, counts: dict[int, int]) -> DataFrame:
    """A row for each team: ``good`` and ``bad``, the measures of as many documents of either class, end to end."""
    keyed = labelled.select("label", "x", F.xxhash64("doc_id", "x", "label").alias("mixed"))
    placed = with_row_index(keyed, ["mixed"], ["label"], "place")
    many = max(counts, key=lambda c: (counts[c], c))
    few = placed.filter(F.col("label") != many).select(F.col("place").alias("turn"), F.col("x").alias("other"))
    turns = placed.filter(F.col("label") == many).withColumn("turn", F.col("place") % counts[1 - many])
    pairs = attach(turns.select("place", "turn", "x"), stage(few, "ranking-few"), ["turn"])
    teams = pairs.groupBy(F.expr(f"place div {TEAM}").alias("team")).agg(F.array_sort(F.collect_list(F.struct("place", "x", "other"))).alias("m"))
    good, bad = ("x", "other") if many == 1 else ("other", "x")
    return stage(teams.select(*[F.flatten(F.col(f"m.{c}")).alias(n) for c, n in ((good, "good"), (bad, "bad"))]), "ranking-teams")


def _step(teams: DataFrame, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Number of preferences, and the sums of the slopes and curvatures of their losses."""
    size = len(weights)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + size + size * size)
        for batch in batches:
            for good, bad in zip(batch.column("good"), batch.column("bad")):
                first, second = (side.values.to_numpy().reshape(-1, size) for side in (good, bad))
                difference = (first[:, None] - second[None]).reshape(-1, size)
                p = 1 / (1 + np.exp(np.clip(difference @ weights, -500, 500)))
                curve = (difference * (p * (1 - p))[:, None]).T @ difference
                total += np.concatenate([[len(p)], -difference.T @ p, curve.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([total])], ["sums"])

    parts = teams.mapInArrow(add_up, "sums array<double>")
    sums = parts.agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(1 + size + size * size)]).alias("s")).first()["s"]
    return sums[0], np.array(sums[1 : 1 + size]), np.array(sums[1 + size :]).reshape(size, size)


def _raw(weights: np.ndarray) -> str:
    return " + ".join(f"x[{i}] * {w!r}D" for i, w in enumerate(weights.tolist()))


def fit(labelled: DataFrame, ridge: float = 1e-3, rounds: int = 50) -> Model | None:
    """Newton steps on the mean logistic loss of feature differences, good minus bad, of all rows ``(doc_id, x, label)``."""
    counts = {int(r["label"]): r["count"] for r in labelled.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    size = len(FEATURES)
    spread = np.array(labelled.agg(*[F.stddev_pop(F.col("x")[i]) for i in range(size)]).first()) + 1e-9
    teams, weights = _teams(labelled, counts), np.zeros(size)
    for _ in range(rounds):
        n, slopes, curves = _step(teams, weights / spread)
        slope = ridge * weights + slopes / spread / n
        curve = curves / np.outer(spread, spread) / n + ridge * np.eye(size)
        step = np.linalg.solve(curve, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-7:
            break
    weights = np.round(weights, 9) / spread
    raw = labelled.select(F.lit(0).alias("all"), F.expr(_raw(weights)).alias("raw"))
    share = counts[0] / (counts[0] + counts[1])
    return Model(weights, exact_ranks(raw, ["all"], "raw", [(share, str(counts[0]))]).first()["at"][0])


def score(docs: DataFrame, labels: DataFrame, train: Column, text: str = "text", label: str = "quality") -> DataFrame:
    """``doc_id``, ``train`` and ``score`` of every row; ``train`` says, by ``doc_id``, whose labels are used.

    Labels other than 0 and 1 are left out; each of several labels of one document is an example.
    """
    content = docs[f"`{text}`"]
    counts = [F.size(matches(content, pattern)).alias(name) for name, pattern in (("n_marks", "[!?]"), ("n_digits", "[0-9]+"))]
    measured = docs.select("doc_id", measures(content).alias("m"), *counts)
    vectors = [f"cast({sql} as double)" for sql in FEATURES.values()]
    rows = stage(measured.selectExpr("doc_id", f"array({', '.join(vectors)}) as x"), "quality-features")
    known = labels.filter(train & F.col(label).isin(0, 1)).select("doc_id", F.col(label).alias("label"))
    labelled = stage(rows.join(known, "doc_id").select("doc_id", "x", "label"), "labelled-features")
    model = fit(labelled)
    held = rows.select("doc_id", "x", F.coalesce(train, F.lit(False)).alias("train"))
    if model is None:
        return held.select("doc_id", "train", F.lit(0.5).alias("score"))
    shift = float(np.log(CUT / (1 - CUT)))
    return held.select("doc_id", "train", F.expr(f"1 / (1 + exp(-(({_raw(model.weights)}) - {model.threshold!r}D + {shift!r}D)))").alias("score"))
