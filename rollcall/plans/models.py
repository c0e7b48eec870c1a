"""Training and model comparison on the feature table of the orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.operators import boosting, features, modeling, ordering
from rollcall.plans import bases as b
from rollcall.operators.quality import roc_auc
from rollcall.plans.registry import query
from rollcall.session import materialize

KEY = "_key"
MODEL = "model"

# Rounds and rate of the production model.
ROUNDS, RATE = 300, 0.05


def _feature_rows(spark, sf_dir):
    table = b.features(spark, sf_dir, ["hoofdagenda", "status"]).withColumnRenamed("APP_ID", KEY)
    return table.select(KEY, "pseudo_id", "start", "hoofdagenda", "status", *features.FEATURE_COLUMNS)


def training_rows(spark, sf_dir):
    """Label and features of every cleaned appointment, written once: fits iterate. Missing numbers stay missing."""
    return materialize(modeling.labelled(_feature_rows(spark, sf_dir)), "training")


@query(
    "group_folds",
    b.with_ctes(
        """SELECT pseudo_id, (CASE WHEN r % 10 < 5 THEN r % 10 ELSE 9 - r % 10 END)::INTEGER
        AS fold, n FROM (SELECT pseudo_id, n,
        row_number() OVER (ORDER BY pos DESC, n DESC, pseudo_id) - 1 AS r FROM (
        SELECT pseudo_id, sum((missed = 'missed')::INTEGER) AS pos, count(*) AS n
        FROM features GROUP BY 1))""",
        "features",
    ),
)
def group_folds(spark, sf_dir):
    rows = modeling.model_input(b.features(spark, sf_dir, []))
    folded = modeling.group_folds(rows, "pseudo_id")
    return folded.groupBy("pseudo_id", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("stratified_group_folds")
def stratified_group_folds(spark, sf_dir):
    """The fold of every patient in the training's cross-validation."""
    folded = modeling.stratified_folds(modeling.labelled(b.features(spark, sf_dir, [])), "pseudo_id")
    return folded.groupBy("pseudo_id", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("train_grid")
def train_grid(spark, sf_dir):
    """The whole grid of the periodic training: nine candidates, five folds."""
    rows = materialize(modeling.stratified_folds(training_rows(spark, sf_dir), "pseudo_id"), "folds")
    return modeling.candidate_metrics(modeling.candidate_scores(rows))


@query("cross_validated_metrics")
def cross_validated_metrics(spark, sf_dir):
    rows = materialize(modeling.stratified_folds(training_rows(spark, sf_dir), "pseudo_id"), "folds")
    scored = modeling.candidate_scores(rows, [ROUNDS], [RATE])
    return modeling.scored_metrics(materialize(scored, "cross-validated"), ["fold"])


@query("score")
def score(spark, sf_dir):
    """Train on the first 80 %, score the planned appointments of the rest."""
    split = ordering.temporal_split(training_rows(spark, sf_dir), ["start", KEY])
    model = fitted(split.where(~F.col("is_test")))
    planned = F.col("is_test") & (F.col("status") == "planned")
    return boosting.score_many(model, split, [KEY, "start"], [(MODEL, None, planned)]).drop("model", "rounds")


def fitted(rows, categorical=modeling.CATEGORICAL):
    """One model of the production settings."""
    spec = boosting.Spec(MODEL, F.lit(True), RATE, ROUNDS)
    return boosting.fit_many(rows, [spec], modeling.NUMERIC, categorical)


@query("held_out_evaluation")
def held_out_evaluation(spark, sf_dir):
    """The whole grid on the first 80 %, AUC and calibration of its choice on the rest; planned ones have no outcome."""
    rows = training_rows(spark, sf_dir).where(F.col("status").isNull() | (F.col("status") != "planned"))
    split = ordering.temporal_split(rows, ["start", KEY])
    train = materialize(modeling.stratified_folds(split.where(~F.col("is_test")), "pseudo_id"), "folds")
    return modeling.evaluated_choice(train, split.where("is_test"))


@query("logistic_baseline")
def logistic_baseline(spark, sf_dir):
    rows = materialize(modeling.model_input(_feature_rows(spark, sf_dir)), "training")
    model = modeling.logistic_baseline(rows)
    return modeling.score(model, rows).select(KEY, "label", "prediction")


@query("leave_one_group_out")
def leave_one_group_out(spark, sf_dir):
    """AUC of each clinic under a model of all other clinics."""
    rows = training_rows(spark, sf_dir)
    scored = modeling.group_models(rows, "hoofdagenda", ["hoofdagenda", "label"], others=True, rounds=ROUNDS)
    return roc_auc(scored, "prediction", "label", ["hoofdagenda"])


@query("per_clinic_models")
def per_clinic_models(spark, sf_dir):
    """Scores by clinic models next to those of one model with clinic as category."""
    rows = training_rows(spark, sf_dir)
    separate = modeling.group_models(rows, "hoofdagenda", [KEY, "hoofdagenda"], rounds=ROUNDS)
    shared = fitted(rows, (*modeling.CATEGORICAL, "hoofdagenda"))
    joint = boosting.score_many(shared, rows, [KEY], [(MODEL, None, F.lit(True))])
    return separate.withColumnRenamed("prediction", "own_model").join(
        joint.select(KEY, F.col("prediction").alias("with_clinic")), KEY
    )


@query(
    "permuted_ranks",
    f"""WITH RECURSIVE sized AS (
      SELECT count(*) AS n, ceil(sqrt(count(*)))::BIGINT AS side,
             ceil(count(*) / ceil(sqrt(count(*))))::BIGINT AS height FROM customer),
    ranked AS (SELECT c_custkey, c_mktsegment AS key, row_number() OVER (ORDER BY c_custkey) - 1 AS r FROM customer),
    walk AS (
      SELECT c_custkey, key, r, r AS x, false AS moved FROM ranked
      UNION ALL
      SELECT c_custkey, key, r, r4 * side + l3 AS x, true FROM (
        SELECT *, (r2 + ('0x' || md5(key || ':3:' || l3)[:8])::BIGINT) % height AS r4 FROM (
        SELECT *, (l1 + ('0x' || md5(key || ':2:' || r2)[:8])::BIGINT) % side AS l3 FROM (
        SELECT *, (x // side + ('0x' || md5(key || ':1:' || l1)[:8])::BIGINT) % height AS r2 FROM (
        SELECT *, (x % side + ('0x' || md5(key || ':0:' || (x // side))[:8])::BIGINT) % side AS l1
        FROM walk, sized WHERE NOT moved OR x >= n)))))
    SELECT c_custkey, r::BIGINT AS rank, x::BIGINT AS receiver FROM walk, sized WHERE moved AND x < n""",
)
def permuted_ranks(spark, sf_dir):
    """A permutation of all customers per market segment, as far as the segment's own rows need it."""
    rows = ordering.ranked(b.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), [F.col("c_custkey")])
    receiver = ordering.permuted(F.col("rank"), rows.count(), F.col("c_mktsegment"))
    return rows.select("c_custkey", "rank", receiver.alias("receiver"))


@query("permutation_importance")
def permutation_importance(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    return modeling.exchange_importance(fitted(rows), rows, KEY, MODEL)


@query("tree_importance")
def tree_importance(spark, sf_dir):
    model = fitted(training_rows(spark, sf_dir))
    return spark.createDataFrame(boosting.split_gains(model, MODEL), "feature string, importance double")
