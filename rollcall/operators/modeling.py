"""Training, scoring and model comparison with Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators.boosting import Models, Spec, fit_many, score_many
from rollcall.operators.ordering import Permutations, exact_quantiles, ranked
from rollcall.operators.quality import calibration, roc_auc
from rollcall.schema import FEATURE_COLUMNS
from rollcall.session import materialize, scratch_path, ship_package

CATEGORICAL = ("hour", "weekday")
NUMERIC = tuple(c for c in FEATURE_COLUMNS if c not in (*CATEGORICAL, "missed"))

# The grid of the periodic training.
ITERATIONS = (200, 300, 500)
LEARNING_RATES = (0.01, 0.05, 0.1)


def model_input(features: DataFrame, numeric: Sequence[str] = NUMERIC) -> DataFrame:
    """Numeric label and no missing numbers (Spark's trees do not take any)."""
    out = features.withColumn("label", (F.col("missed") == "missed").cast("double"))
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c in numeric})


def labelled(features: DataFrame) -> DataFrame:
    """Numeric label; missing numbers stay missing, as histogram boosting takes them."""
    return features.withColumn("label", (F.col("missed") == "missed").cast("double"))


def group_folds(
    df: DataFrame, group: str, label: str = "label", k: int = 5, out: str = "fold"
) -> DataFrame:
    """Add a fold number: one fold per patient, classes spread evenly.

    Patients sorted by positives and rows are dealt out back and forth.
    """
    sizes = df.groupBy(group).agg(
        F.sum(F.col(label).cast("long")).alias("_positives"), F.count(F.lit(1)).alias("_rows")
    )
    order = [F.col("_positives").desc(), F.col("_rows").desc(), F.col(group)]
    dealt = ranked(sizes, order, "_rank")
    turn = F.pmod(F.col("_rank"), F.lit(2 * k))
    fold = F.when(turn < k, turn).otherwise(2 * k - 1 - turn).cast("int")
    return df.join(dealt.select(group, fold.alias(out)), group)


def greedy_fold_plan(
    classes: Sequence[tuple[int, int, int]], k: int
) -> list[list[tuple[int, int, list[int]]]]:
    """Folds of groups, chosen one group after the other so that class shares are spread least over folds.

    ``classes``: (positives, rows, groups) of the kinds of groups. Groups go by the spread of their two class counts, widest
    first, then in the order of ``classes``; each joins the fold that leaves the least mean spread (over both classes) of the
    folds' shares of a class, of equal ones the fold with the fewest rows, then the first.

    Returns per class its stretches (first, groups, folds): the group numbered ``first + i`` joins ``folds[i % len(folds)]``.
    Once k groups of a class in a row have joined k different folds, the folds stand to each other as before, so the same turn repeats
    for the rest of the class: the work grows with the kinds of groups, not with the groups.
    """
    totals = np.maximum(1, [sum((n - p) * m for p, n, m in classes), sum(p * m for p, n, m in classes)])
    held = np.zeros((k, 2), np.int64)
    plan: list[list[tuple[int, int, list[int]]]] = [[] for _ in classes]

    def choose(counts: np.ndarray) -> int:
        tried = np.repeat(held[None], k, axis=0)
        tried[np.arange(k), np.arange(k)] += counts
        spread = np.std(tried / totals, axis=1).mean(axis=1)
        near = np.flatnonzero(spread <= spread.min() + 1e-9)
        return int(near[held[near].sum(axis=1).argmin()])

    for i in sorted(range(len(classes)), key=lambda i: (-abs(classes[i][1] - 2 * classes[i][0]), i)):
        positives, rows, groups = classes[i]
        counts, done, turn = np.array([rows - positives, positives]), 0, []
        while done < groups:
            turn.append(choose(counts))
            held[turn[-1]] += counts
            plan[i].append((done, 1, turn[-1:]))
            done += 1
            if len(set(turn[-k:])) == k:
                rest = groups - done
                held += counts * (rest // k)
                held[turn[-k:][: rest % k]] += counts
                if rest:
                    plan[i].append((done, rest, turn[-k:]))
                break
    return plan


def stratified_folds(df: DataFrame, group: str, label: str = "label", k: int = 5, out: str = "fold") -> DataFrame:
    """Add a fold number: one fold per group, with the folds of :func:`greedy_fold_plan`.

    The greedy choice needs the number of groups of each kind (positives, rows) only; groups of a kind are numbered by a
    distributed ranking and find their fold by their number. Groups with equal counts go by their value. Missing labels count
    as negative, a missing group is a group.
    """
    positives = F.sum(F.coalesce(F.col(label).cast("long"), F.lit(0)))
    sizes = df.groupBy(group).agg(positives.alias("_positives"), F.count(F.lit(1)).alias("_rows"))
    numbered = ranked(sizes, [F.col(group)], "_rank", by=["_positives", "_rows"])
    # One row per kind of group.
    kinds = numbered.groupBy("_positives", "_rows").agg(F.count(F.lit(1)).alias("n")).orderBy("_positives", "_rows").collect()
    plan = greedy_fold_plan([tuple(r) for r in kinds], k)
    stretches = [
        (r[0], r[1], first, first + n, folds) for r, own in zip(kinds, plan, strict=True) for first, n, folds in own
    ]
    table = df.sparkSession.createDataFrame(
        stretches, "_positives long, _rows long, _first long, _end long, _folds array<int>"
    )
    inside = (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end"))
    turn = F.pmod(F.col("_rank") - F.col("_first"), F.size("_folds")).cast("int")
    folds = numbered.join(table, ["_positives", "_rows"]).where(inside).select(
        F.col(group).alias("_of"), F.get(F.col("_folds"), turn).alias(out)
    )
    return df.join(folds, F.col(group).eqNullSafe(F.col("_of"))).drop("_of")


def boosted_trees(
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    max_iter: int = 300,
    step: float = 0.05,
    max_bins: int = 64,
    seed: int = 42,
) -> Pipeline:
    """Boosted trees; hour and weekday go in as categories, not numbers."""
    indexers = [
        StringIndexer(
            inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep", stringOrderType="alphabetAsc"
        )
        for c in categorical
    ]
    assembler = VectorAssembler(
        inputCols=[*numeric, *[f"{c}_idx" for c in categorical]], outputCol="features"
    )
    trees = GBTClassifier(
        labelCol="label", maxIter=max_iter, stepSize=step, maxBins=max_bins, seed=seed
    )
    return Pipeline(stages=[*indexers, assembler, trees])


@dataclass(frozen=True)
class GridResult:
    model: PipelineModel
    params: list[dict]
    auc: list[float]
    precision: list[float]
    recall: list[float]


def train_grid(
    train: DataFrame,
    iterations: Sequence[int] = ITERATIONS,
    rates: Sequence[float] = LEARNING_RATES,
    fold: str = "fold",
    k: int = 5,
    parallelism: int = 4,
    pipeline: Pipeline | None = None,
) -> GridResult:
    """Grid search over given folds, refitted on the best mean AUC.

    Each candidate is scored by AUC, precision and recall, averaged over the held-out folds. A fold without a
    defined precision or recall counts as 0, one without AUC as missing.
    """
    pipeline = pipeline or boosted_trees()
    trees = pipeline.getStages()[-1]
    grid = [
        {"maxIter": n, "stepSize": rate} for n in iterations for rate in rates
    ]

    def metrics(params: dict) -> tuple[float, float, float]:
        candidate = pipeline.copy({trees.maxIter: params["maxIter"], trees.stepSize: params["stepSize"]})
        row = fold_metrics(train, candidate, fold, k).agg(
            F.avg("auc").alias("auc"),
            F.avg(F.coalesce("precision", F.lit(0.0))).alias("precision"),
            F.avg(F.coalesce("recall", F.lit(0.0))).alias("recall"),
        ).first()
        return row["auc"], row["precision"], row["recall"]

    with ThreadPoolExecutor(parallelism) as pool:
        found = list(pool.map(metrics, grid))
    best = max(range(len(grid)), key=lambda i: (found[i][0] is not None, found[i][0] or 0.0, -i))
    chosen = pipeline.copy({trees.maxIter: grid[best]["maxIter"], trees.stepSize: grid[best]["stepSize"]})
    return GridResult(chosen.fit(train), grid, *(list(x) for x in zip(*found, strict=True)))


def held_out_evaluation(train: DataFrame, test: DataFrame, n_bins: int = 10, **grid) -> DataFrame:
    """Grid search on ``train`` (with folds), then the chosen model on ``test``: a row per calibration bin, each with
    the chosen parameters and the AUC of all of ``test``."""
    model = train_grid(train, **grid).model
    scored = materialize(score(model, test).select("label", "prediction"), "held-out")
    auc = roc_auc(scored, "prediction", "label").first()["auc"]
    trees = model.stages[-1]
    return calibration(scored, "prediction", "label", n_bins).select(
        F.lit(trees.getMaxIter()).alias("max_iter"),
        F.lit(trees.getStepSize()).alias("step"),
        F.lit(auc).cast("double").alias("test_auc"),
        "bucket",
        "prob_pred",
        "prob_true",
        "n",
    )


def fold_metrics(
    df: DataFrame, estimator: Pipeline, fold: str = "fold", k: int = 5
) -> DataFrame:
    """AUC, precision and recall (threshold one half) of each held-out fold."""
    parts = []
    for i in range(k):
        model = estimator.fit(df.where(F.col(fold) != i))
        parts.append(score(model, df.where(F.col(fold) == i)))
    whole = _union(parts)
    chosen = F.col("prediction") > 0.5
    counts = whole.groupBy(fold).agg(
        F.try_divide(
            F.count(F.when(chosen & (F.col("label") == 1), 1)), F.count(F.when(chosen, 1))
        ).alias("precision"),
        F.try_divide(
            F.count(F.when(chosen & (F.col("label") == 1), 1)),
            F.count(F.when(F.col("label") == 1, 1)),
        ).alias("recall"),
    )
    return roc_auc(whole, "prediction", "label", [fold]).join(counts, fold)


def score(model: PipelineModel | BaselineModel, features: DataFrame) -> DataFrame:
    """Add ``prediction``: the probability of a missed appointment."""
    out = model.transform(features)
    probability = vector_to_array("probability")[1]
    return out.select(*features.columns, probability.alias("prediction"))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


# --- logistic baseline ------------------------------------------------------

KNOTS = 5


@dataclass(frozen=True)
class BaselineModel:
    """Fitted scaling and knots, and the logistic pipeline on top of them."""

    limits: dict[str, tuple[float, float, float, float]]
    pipeline: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(with_splines(df, self.limits))


def spline_limits(
    df: DataFrame, columns: Sequence[str]
) -> dict[str, tuple[float, float, float, float]]:
    """Per column: median, interquartile range, and scaled minimum and maximum."""
    quartiles = [exact_quantiles(df, c, [0.25, 0.5, 0.75]).first()["edges"] for c in columns]
    ends = df.agg(
        *[F.min(c).alias(f"a_{c}") for c in columns], *[F.max(c).alias(f"b_{c}") for c in columns]
    ).first()
    limits = {}
    for c, (q1, median, q3) in zip(columns, quartiles):
        width = (q3 - q1) or 1.0
        limits[c] = (
            median,
            width,
            (ends[f"a_{c}"] - median) / width,
            (ends[f"b_{c}"] - median) / width,
        )
    return limits


def spline_basis(spot: Column) -> Column:
    """Cubic spline weights at a place in [0, 4] between evenly spaced knots.

    Only the four splines around the place are non-zero; the array is padded with
    zeros to its fixed length.
    """
    piece = F.least(F.floor(spot), F.lit(KNOTS - 2)).cast("int")
    u = spot - piece
    v = 1 - u
    weights = F.array(
        v * v * v / 6,
        ((3 * u - 6) * u * u + 4) / 6,
        ((3 * v - 6) * v * v + 4) / 6,
        u * u * u / 6,
    )
    zero = F.lit(0.0)
    return F.concat(
        F.array_repeat(zero, piece), weights, F.array_repeat(zero, F.lit(KNOTS - 2) - piece)
    )


def with_splines(df: DataFrame, limits: dict) -> DataFrame:
    """Add the spline basis of all columns as one vector, constant outside the
    fitted range."""
    parts = []
    for c, (median, width, low, high) in limits.items():
        scaled = (F.col(c) - median) / width
        step = (high - low) / (KNOTS - 1) or 1.0
        spot = F.least(F.greatest((scaled - low) / step, F.lit(0.0)), F.lit(float(KNOTS - 1)))
        parts.append(spline_basis(spot))
    return df.withColumn("splines", array_to_vector(F.concat(*parts)))


def logistic_baseline(
    train: DataFrame,
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    max_iter: int = 100,
) -> BaselineModel:
    """Robust scaling, cubic splines, one-hot categories, unpenalized logistic."""
    limits = spline_limits(train, numeric)
    indexers = [
        StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in categorical
    ]
    encoder = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in categorical],
        outputCols=[f"{c}_hot" for c in categorical],
        handleInvalid="keep",
        dropLast=False,
    )
    assembler = VectorAssembler(
        inputCols=["splines", *[f"{c}_hot" for c in categorical]], outputCol="features"
    )
    logistic = LogisticRegression(labelCol="label", regParam=0.0, maxIter=max_iter)
    stages = [*indexers, *([encoder] if categorical else []), assembler, logistic]
    fitted = Pipeline(stages=stages).fit(with_splines(train, limits))
    return BaselineModel(limits, _stored(fitted, train))


def _stored(model: PipelineModel, df: DataFrame) -> PipelineModel:
    """The model as saved and loaded again.

    A fresh logistic model keeps its training summary, which holds the session and
    cannot be sent to executors once the session has observed a metric.
    """
    path = scratch_path(df.sparkSession, "model")
    model.save(path)
    return PipelineModel.load(path)


# --- comparisons over groups ------------------------------------------------

def group_values(df: DataFrame, group: str) -> list:
    """The groups to loop over, one fit each: the caller decides what to group by."""
    return sorted(row[0] for row in df.select(group).distinct().collect())


def leave_one_group_out(
    df: DataFrame, group: str, fit: Callable[[DataFrame], object]
) -> DataFrame:
    """AUC of each group under a model trained on all other groups."""
    parts = [
        score(fit(df.where(F.col(group) != value)), df.where(F.col(group) == value))
        for value in group_values(df, group)
    ]
    return roc_auc(_union(parts), "prediction", "label", [group])


def auc_mean_std(per_group: DataFrame) -> DataFrame:
    return per_group.agg(
        F.avg("auc").alias("mean_auc"),
        F.stddev_pop("auc").alias("std_auc"),
        F.count(F.lit(1)).alias("groups"),
    )


def per_group_models(
    df: DataFrame, group: str, fit: Callable[[DataFrame], object]
) -> DataFrame:
    """Score every row by the model of its own group."""
    parts = []
    for value in group_values(df, group):
        rows = df.where(F.col(group) == value)
        parts.append(score(fit(rows), rows))
    return _union(parts)


# --- many boosted models at once ----------------------------------------------


def candidate_scores(
    train: DataFrame,
    iterations: Sequence[int] = ITERATIONS,
    rates: Sequence[float] = LEARNING_RATES,
    fold: str = "fold",
    k: int = 5,
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
) -> DataFrame:
    """Every row under each candidate's model of the other folds: (label, fold, step, max_iter, prediction).

    One model per (rate, fold) with the most rounds; fewer rounds are read off it.
    """
    names = {f"{rate!r} {i}": (rate, i) for rate in rates for i in range(k)}
    specs = [Spec(n, F.col(fold) != i, rate, max(iterations)) for n, (rate, i) in names.items()]
    models = fit_many(train, specs, numeric, categorical)
    asked = [(n, iterations, F.col(fold) == i) for n, (_, i) in names.items()]
    scored = score_many(models, train, ["label", fold], asked)
    step = F.split("model", " ")[0].cast("double")
    return scored.select("label", fold, step.alias("step"), F.col("rounds").alias("max_iter"), "prediction")


def scored_metrics(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """AUC, precision and recall (threshold one half) of scored rows per group; an undefined one is missing."""
    chosen = F.col("prediction") > 0.5
    both = F.count(F.when(chosen & (F.col("label") == 1), 1))
    counts = scored.groupBy(*by).agg(
        F.try_divide(both, F.count(F.when(chosen, 1))).alias("precision"),
        F.try_divide(both, F.count(F.when(F.col("label") == 1, 1))).alias("recall"),
    )
    return roc_auc(scored, "prediction", "label", list(by)).join(counts, list(by))


def candidate_metrics(scored: DataFrame, fold: str = "fold") -> DataFrame:
    """(max_iter, step, auc, precision, recall): a candidate's means over the held-out folds.

    A fold without a defined precision or recall counts as 0, one without AUC as missing.
    """
    per_fold = scored_metrics(materialize(scored, "candidates"), ["max_iter", "step", fold])
    return per_fold.groupBy("max_iter", "step").agg(
        F.avg("auc").alias("auc"),
        F.avg(F.coalesce("precision", F.lit(0.0))).alias("precision"),
        F.avg(F.coalesce("recall", F.lit(0.0))).alias("recall"),
    )


def evaluated_choice(
    train: DataFrame,
    test: DataFrame,
    iterations: Sequence[int] = ITERATIONS,
    rates: Sequence[float] = LEARNING_RATES,
    n_bins: int = 10,
    **inputs,
) -> DataFrame:
    """The candidate with the best mean AUC (of equal ones the first of the grid), fitted on all of ``train``, on ``test``.

    A row per calibration bin, each with the chosen parameters and the AUC of all of ``test``.
    """
    found = candidate_metrics(candidate_scores(train, iterations, rates, **inputs))
    # One row per candidate.
    order = [F.col("auc").desc_nulls_last(), "max_iter", "step"]
    best = found.orderBy(*order).select("max_iter", "step").first()
    columns = {c: inputs[c] for c in ("numeric", "categorical") if c in inputs}
    spec = Spec("chosen", F.lit(True), best["step"], best["max_iter"])
    models = fit_many(train, [spec], columns.get("numeric", NUMERIC), columns.get("categorical", CATEGORICAL))
    scored = materialize(score_many(models, test, ["label"], [("chosen", None, F.lit(True))]), "held-out")
    auc = roc_auc(scored, "prediction", "label").first()["auc"]
    return calibration(scored, "prediction", "label", n_bins).select(
        F.lit(best["max_iter"]).alias("max_iter"),
        F.lit(best["step"]).alias("step"),
        F.lit(auc).cast("double").alias("test_auc"),
        "bucket",
        "prob_pred",
        "prob_true",
        "n",
    )


def group_models(
    df: DataFrame,
    group: str,
    keep: Sequence[str],
    others: bool = False,
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    rounds: int = 300,
) -> DataFrame:
    """Every row under the model of its own group, or of all other groups: (keep..., prediction)."""
    values = group_values(df, group)
    own = [F.col(group) == v for v in values]
    specs = [Spec(str(k), ~c if others else c, rounds=rounds) for k, c in enumerate(own)]
    models = fit_many(df, specs, numeric, categorical)
    scored = score_many(models, df, keep, [(s.name, None, c) for s, c in zip(specs, own, strict=True)])
    return scored.drop("model", "rounds")


# --- importances ------------------------------------------------------------

#: Receiving rows of a block, at least and at most, and how many blocks are enough for the least.
EXCHANGE_ROWS, EXCHANGE_BLOCKS = (1 << 13, 1 << 16), 64
GIFT = np.dtype([("variant", "<u2"), ("place", "<u2"), ("bin", "u1")])


def permutation_importance(
    model: PipelineModel | BaselineModel,
    df: DataFrame,
    features: Sequence[str],
    key: str,
    repeats: int = 10,
    seed: int = 42,
) -> DataFrame:
    """Loss of accuracy per feature when its values are exchanged between rows.

    The rows are put in one seeded random order; shifting that order by a
    different step per repeat exchanges the values.  All features of a repeat are
    scored in a single pass, without a loop over data.
    """
    rows = df.select(key, "label", *features)
    placed = ranked(rows, [F.xxhash64(F.col(key), F.lit(seed)), F.col(key)], "_rank")
    n = placed.count()
    right = (F.col("probability_1") > 0.5) == (F.col("label") == 1)

    def accuracy(frame: DataFrame, *by: str) -> DataFrame:
        scored = model.transform(frame).withColumn(
            "probability_1", vector_to_array("probability")[1]
        )
        return scored.groupBy(*by).agg(F.avg(right.cast("double")).alias("accuracy"))

    base = accuracy(placed).select(F.col("accuracy").alias("_base")).first()[0]
    parts = []
    for repeat in range(repeats):
        step = 1 + (repeat * 7919 + seed) % max(n - 1, 1)
        donors = placed.select(
            F.pmod(F.col("_rank") + step, F.lit(n)).alias("_rank"),
            *[F.col(c).alias(f"_d_{c}") for c in features],
        )
        mixed = placed.join(donors, "_rank")
        variants = F.array(
            *[
                F.struct(
                    F.lit(f).alias("feature"),
                    *[F.col(f"_d_{c}" if c == f else c).alias(c) for c in features],
                )
                for f in features
            ]
        )
        unfolded = mixed.select("label", F.explode(variants).alias("_v")).select("label", "_v.*")
        parts.append(accuracy(unfolded, "feature").withColumn("repeat", F.lit(repeat)))
    return (
        _union(parts)
        .groupBy("feature")
        .agg(
            F.avg(F.lit(base) - F.col("accuracy")).alias("importance"),
            F.stddev_pop(F.lit(base) - F.col("accuracy")).alias("std"),
        )
    )


def exchange_importance(
    models: Models, df: DataFrame, key: str, name: str, repeats: int = 10, seed: int = 42
) -> DataFrame:
    """(feature, importance, std): loss of accuracy when a feature's values are exchanged between rows.

    Every feature and repeat has a random permutation of its own. A row hands the bin of each of its values on to the row that the
    permutation names: three bytes and the variant's number, packed by blocks of receiving rows. All variants of a block are
    scored by one task.
    """
    spark, bins, forest = df.sparkSession, models.bins, models.forests[name]
    ship_package(spark)
    features = bins.names
    placed = ranked(df.select(key, F.col("label").cast("double").alias("label"), *bins.columns()), [F.col(key)], "_rank")
    n = placed.count()
    size = EXCHANGE_ROWS[0]
    while size < EXCHANGE_ROWS[1] and n > EXCHANGE_BLOCKS * size:
        size *= 2
    variants = [(f, repeat) for f in features for repeat in range(repeats)]
    sent = spark.sparkContext.broadcast((forest, Permutations(n, [f"{seed} {repeat} {f}" for f, repeat in variants])))

    def hand_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permutations = sent.value[1]
        for batch in batches:
            if not batch.num_rows:
                continue
            x, ranks = bins.of(batch), batch.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
            label = pc.equal(batch.column("label"), 1.0).cast(pa.int8()).fill_null(-1).to_numpy(zero_copy_only=False)
            given = np.empty((len(variants), len(ranks)), GIFT)
            given["variant"] = np.arange(len(variants))[:, None]
            block = np.empty(given.shape, np.int64)
            for k in range(len(variants)):
                block[k], given["place"][k] = np.divmod(permutations.receivers(k, ranks), size)
                given["bin"][k] = x[:, k // repeats]
            own = np.empty(len(ranks), np.dtype([("place", "<u2"), ("label", "i1"), ("bins", "u1", x.shape[1])]))
            at, own["place"] = np.divmod(ranks, size)
            own["label"], own["bins"] = label, x
            mine, given = _by_block(at, own), _by_block(block.ravel(), given.ravel())
            told = sorted({*mine, *given})
            yield pa.RecordBatch.from_arrays(
                [pa.array(told, pa.int64()), *[pa.array([x.get(k, b"") for k in told], pa.binary()) for x in (mine, given)]],
                names=["block", "own", "given"],
            )

    def judged(rows: pa.Table) -> pa.Table:
        own = np.frombuffer(
            b"".join(v.as_buffer() for v in rows.column("own")),
            np.dtype([("place", "<u2"), ("label", "i1"), ("bins", "u1", len(features))]),
        )
        columns = np.empty((len(features), len(own)), np.uint8)
        columns[:, own["place"]] = own["bins"].T
        label = np.empty(len(own), np.int8)
        label[own["place"]] = own["label"]
        changed = np.empty((len(variants), len(own)), np.uint8)
        for part in rows.column("given"):
            given = np.frombuffer(part.as_buffer(), GIFT)
            changed[given["variant"], given["place"]] = given["bin"]
        plain, exchanged = sent.value[0].raw_exchanged(columns, changed.reshape(len(features), repeats, -1))
        known = label >= 0
        right = [
            ((1 / (1 + np.exp(-raw)) > 0.5) == (label == 1))[known].sum()
            for raw in (plain, *exchanged.reshape(len(variants), -1))
        ]
        told = [np.arange(-1, len(variants)), np.array(right), np.full(len(right), known.sum())]
        return pa.table([pa.array(v.astype(np.int64)) for v in told], names=["variant", "right", "rows"])

    packed = placed.drop(key).mapInArrow(hand_on, "block long, own binary, given binary")
    counted = (
        packed.repartition(-(-n // size) or 1, "block")
        .groupBy("block")
        .applyInArrow(judged, "variant long, right long, rows long")
        .groupBy("variant")
        .agg((F.sum("right") / F.sum("rows")).alias("accuracy"))
    )
    # One row per feature and repeat.
    accuracy = {r["variant"]: r["accuracy"] for r in counted.collect()}
    losses = [
        (*variants[k], None if right is None else accuracy[-1] - right) for k, right in accuracy.items() if k >= 0
    ]
    drops = spark.createDataFrame(losses, "feature string, repeat int, loss double")
    return drops.groupBy("feature").agg(F.avg("loss").alias("importance"), F.stddev_pop("loss").alias("std"))


def _by_block(block: np.ndarray, rows: np.ndarray) -> dict[int, bytes]:
    """Packed rows of each block."""
    order = block.argsort(kind="stable")
    rows, block = rows[order], block[order]
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    return {int(block[a]): rows[a:b].tobytes() for a, b in zip(starts, [*starts[1:], len(block)], strict=True)}


def tree_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Impurity importances by input name; one row per model input."""
    assembler, trees = model.stages[-2], model.stages[-1]
    names = assembler.getInputCols()
    values = trees.featureImportances.toArray().tolist()
    schema = T.StructType(
        [T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())]
    )
    return df.sparkSession.createDataFrame(list(zip(names, values)), schema)
