"""A quality classifier of sparse rules (RuleFit: Friedman and Popescu, 2008).

Small trees are grown on statistics of labelled texts. Every path from a root to a node is a rule, a
conjunction of bounds on statistics. Rules are weighted by a logistic regression with an L1
penalty, which leaves a few of them, and those are compiled into one Spark column expression over the
statistics, which a Python pass over the texts has counted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger.llm.common import stored
from finledger.llm.textstats import RATIOS, text_statistics, with_statistics

FEATURES = tuple(RATIOS)
HELD_OUT = 5  # every fifth document by checksum of its id is kept from the training
CUTOFF = 0.3

Rule = tuple[tuple[int, bool, float], ...]  # (feature, above, bound), all of which hold


@dataclass(frozen=True)
class Settings:
    sample: int = 20_000  # labelled rows for the fit, those of the smallest hash of their id
    trees: int = 60
    depth: int = 3
    features_per_split: int = 5
    bounds_per_feature: int = 32
    leaf: int = 20
    penalty: float = 0.01  # share of the smallest penalty that leaves no rule
    steps: int = 400
    seed: int = 7


@dataclass(frozen=True)
class Ensemble:
    base: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for rule, weight in self.rules:
            z += weight * holds(rule, x)
        return 1 / (1 + np.exp(-z))

    def column(self) -> Column:
        """The score over the feature columns."""
        z = F.lit(float(self.base))
        for rule, weight in self.rules:
            met = None
            for feature, above, bound in rule:
                one = F.col(FEATURES[feature])
                one = one > F.lit(bound) if above else one <= F.lit(bound)
                met = one if met is None else met & one
            z = z + F.when(met, F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    met = np.ones(len(x), dtype=bool)
    for feature, above, bound in rule:
        met &= (x[:, feature] > bound) if above else (x[:, feature] <= bound)
    return met


def grow(x: np.ndarray, y: np.ndarray, settings: Settings, rng: np.random.Generator) -> list[Rule]:
    """The paths of one tree on squared error, root excluded."""
    paths: list[Rule] = []

    def split(rows: np.ndarray, path: Rule) -> None:
        if path:
            paths.append(path)
        if len(path) == settings.depth or len(rows) < 2 * settings.leaf:
            return
        target = y[rows]
        total, best = target.sum(), (1e-9, None)
        for feature in rng.choice(x.shape[1], min(settings.features_per_split, x.shape[1]), False):
            values = x[rows, feature]
            at = np.linspace(0, 1, settings.bounds_per_feature + 2)[1:-1]
            bounds = np.unique(np.quantile(values, at))
            slot = np.searchsorted(bounds, values)  # values <= bounds[k] have a slot <= k
            n = np.cumsum(np.bincount(slot, minlength=len(bounds) + 1))[:-1]
            s = np.cumsum(np.bincount(slot, target, len(bounds) + 1))[:-1]
            m = len(rows) - n
            fit = (n >= settings.leaf) & (m >= settings.leaf)
            if not fit.any():
                continue
            gain = np.where(fit, s**2 / np.maximum(n, 1) + (total - s) ** 2 / np.maximum(m, 1), 0)
            gain = gain - total**2 / len(rows)
            k = int(np.argmax(np.where(fit, gain, -np.inf)))
            if gain[k] > best[0]:
                best = (gain[k], (int(feature), float(bounds[k])))
        if best[1] is None:
            return
        feature, bound = best[1]
        low = x[rows, feature] <= bound
        split(rows[low], (*path, (feature, False, bound)))
        split(rows[~low], (*path, (feature, True, bound)))

    split(rng.integers(0, len(x), len(x)), ())
    return paths


def lasso_logistic(
    r: np.ndarray, y: np.ndarray, penalty: float, steps: int
) -> tuple[float, np.ndarray]:
    """Base and weights by accelerated proximal gradient steps; the base is not penalised.

    ``penalty`` is a share of the smallest one at which all weights are zero.
    """
    n, k = r.shape
    r, y = np.asarray(r, np.float32), np.asarray(y, np.float32)  # one type: no copies of the rules
    rate = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    base, w = float(np.log(rate / (1 - rate))), np.zeros(k, np.float32)
    if k == 0:
        return base, w
    strength = np.float32(penalty * np.abs((y - np.float32(rate)) @ r).max() / n)
    v = np.ones(k, np.float32)
    for _ in range(20):  # largest curvature, by power iteration
        v = (r @ v) @ r
        v /= max(float(np.linalg.norm(v)), 1e-12)
    size = np.float32(1 / (0.25 * (float(np.linalg.norm(r @ v)) ** 2 / n + 1) + 1e-9))
    ahead_w, ahead_b, t = w, base, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-np.clip(r @ ahead_w + np.float32(ahead_b), -30, 30))) - y
        new_w = ahead_w - size * (error @ r) / np.float32(n)
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - size * strength, 0)
        new_b = ahead_b - float(size) * float(error.mean())
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum = (t - 1) / new_t
        ahead_w = new_w + np.float32(momentum) * (new_w - w)
        ahead_b = new_b + momentum * (new_b - base)
        w, base, t = new_w, new_b, new_t
    return base, w


def fit(x: np.ndarray, y: np.ndarray, settings: Settings = Settings()) -> Ensemble:
    """An ensemble for labels 0 and 1. Without rows the score is a half, with one kind of label its
    (smoothed) share."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    if len(y) == 0 or y.min() == y.max():
        return Ensemble(float(np.log(share / (1 - share))), ())
    rng = np.random.default_rng(settings.seed)
    found: dict[bytes, Rule] = {}
    for _ in range(settings.trees):
        for rule in grow(x, y, settings, rng):
            met = holds(rule, x)
            if 0 < met.sum() < len(x):  # rules that hold for the same rows are one rule
                found.setdefault(np.packbits(met).tobytes(), rule)
    rules = list(found.values())
    r = np.empty((len(x), len(rules)), dtype=np.float32)
    for i, rule in enumerate(rules):
        r[:, i] = holds(rule, x)
    base, weights = lasso_logistic(r, y.astype(np.float32), settings.penalty, settings.steps)
    kept = tuple((rule, float(w)) for rule, w in zip(rules, weights, strict=True) if w != 0)
    return Ensemble(base, kept)


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and the feature columns of every whole text."""
    stats = text_statistics(docs, key, text)
    return stats.select("key", *[F.expr(sql).alias(name) for name, sql in RATIOS.items()])


def checksum_rest(key: Column) -> Column:
    """crc32 of the key as text, modulo ``HELD_OUT``; a null key is an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % HELD_OUT


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality", settings: Settings = Settings(),
) -> Ensemble:
    """Fits on labels outside the held-out fifth, ``settings.sample`` of them at most.

    The sample is drawn from the labels alone, so only its documents are read for statistics; its
    bounded list of keys is what the join with the documents may broadcast.
    """
    known = labels.select(
        F.col(key).cast("bigint").alias("key"), F.col(label).cast("int").alias("label")
    ).where(F.col("label").isin(0, 1) & (checksum_rest(F.col("key")) != 0))
    known = stored(
        known.orderBy(F.xxhash64("key"), "key", "label").limit(settings.sample), "quality-labels"
    )
    mine = docs.selectExpr(f"CAST(`{key}` AS BIGINT) AS key", f"`{text}` AS text").join(
        F.broadcast(known.select("key").distinct()), "key", "left_semi"
    )
    order = [F.xxhash64("key"), "key", "label", *FEATURES]
    sample = (
        features(mine, "key", "text").join(known, "key").orderBy(*order).limit(settings.sample)
        .select("label", *FEATURES)
    )

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.array([c.to_numpy(zero_copy_only=False) for c in b.columns], np.float64) for b in rows]
        table = np.concatenate(parts, axis=1).T if parts else np.zeros((0, 1 + len(FEATURES)))
        model = fit(table[:, 1:], table[:, 0], settings)
        yield pa.RecordBatch.from_arrays(
            [pa.array([json.dumps([model.base, model.rules])])], names=["model"]
        )

    # the sample is one partition of bounded size: it is fitted in a task, the driver gets the rules
    found = sample.mapInArrow(run, "model string").first()
    if found is None:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0), settings)
    base, rules = json.loads(found["model"])
    return Ensemble(base, tuple(
        (tuple((int(f), bool(above), float(bound)) for f, above, bound in rule), float(w))
        for rule, w in rules
    ))


def score_documents(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    settings: Settings = Settings(), cutoff: float = CUTOFF,
) -> DataFrame:
    """The key, held_out, score (0 to 1, higher: better) and predicted (1 at the cutoff or above).

    Inputs are statistics of the text alone. Labels other than 0 and 1 and labels of unknown
    documents say nothing; several labels of a document count each; a null or empty text is
    scored by its (zero) statistics, equal rows alike; a null key counts as an empty text for the
    checksum. An empty table gives no rows; without labels every score is a half. Other columns
    are not read.
    """
    score = train(docs, labels, key, text, settings=settings).column()
    return features(docs, key, text).select(
        F.col("key").alias(key), (checksum_rest(F.col("key")) == 0).alias("held_out"),
        score.alias("score"),
    ).withColumn("predicted", (F.col("score") >= F.lit(cutoff)).cast("int"))


def keep_good(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    settings: Settings = Settings(), cutoff: float = CUTOFF,
) -> DataFrame:
    """The documents whose score reaches the cutoff, with all their columns: a filter by row."""
    score = train(docs, labels, key, text, settings=settings).column()
    rows = with_statistics(docs, text)
    # a generator stands between the ratios and the filter: a filter that can be moved below the
    # projection would have every ratio written out again in every condition of every rule
    ratios = F.struct(*[F.expr(sql).alias(name) for name, sql in RATIOS.items()])
    rows = rows.select("__row", F.explode(F.array(ratios)).alias("__ratios")).select("__row", "__ratios.*")
    return rows.where(score >= F.lit(cutoff)).select("__row.*")
