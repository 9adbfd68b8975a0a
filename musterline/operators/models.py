"""Models on MLlib: tier classifier, rate, risk and salary models, segments and their projection."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import PCA, IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import shared_dir
from . import clusters
from . import features as FE

# The features of each model.
TIER_FEATURES = (
    "total", "nationals", "non_nationals", "rate", "sector_encoded", "size_encoded", "region_encoded",
    "avg_salary", "female_ratio", "permanent_ratio", "department_diversity", "job_title_diversity",
    "nationality_diversity",
)
RATE_FEATURES = (
    "total", "sector_encoded", "size_encoded", "region_encoded", "avg_salary", "female_ratio", "permanent_ratio",
    "department_diversity", "job_title_diversity", "remote_ratio",
)
RISK_FEATURES = (
    "total", "nationals", "non_nationals", "rate", "sector_encoded", "size_encoded", "avg_salary", "salary_std",
    "female_ratio", "permanent_ratio", "department_diversity", "total_alerts",
)
SALARY_CATEGORIES = ("sector", "size", "region", "contract_type", "gender")
# Open lists, which may have very many values: coded by a hash, so no list of them is gathered anywhere.
SALARY_OPEN = ("nationality", "job_title", "department")
SEGMENT_FEATURES = (
    "total", "rate", "avg_salary", "female_ratio", "permanent_ratio", "department_diversity", "total_alerts",
)
ENCODED = ("sector", "size", "region")
#: Pooled rows of a task when a model is fitted; a level of a tree takes some 50 ms over them.
ROWS = 50_000


@dataclass(frozen=True)
class Fitted:
    """A fitted pipeline, its predictions on the test rows and the names of its features.

    The codes of categories are part of the pipeline, so a row's score does not depend on what else is scored.
    """

    model: PipelineModel
    tested: DataFrame
    features: tuple[str, ...]
    given: tuple[str, ...]

    def score(self, table: DataFrame) -> DataFrame:
        """Predictions for any table with the columns the model was fitted on."""
        return self.model.transform(_filled(table, self.given))

    def importances(self) -> DataFrame:
        """Features by importance, highest first."""
        tree = next(s for s in self.model.stages if hasattr(s, "featureImportances"))
        rows = [(f, float(v)) for f, v in zip(self.features, tree.featureImportances.toArray())]
        spark = self.tested.sparkSession
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def _filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Feature columns as doubles, unknown as 0."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})


def pooled(rows: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """One row per distinct ``keys``: the mean of ``label`` and, as ``weight``, the number of rows.

    A tree can only part rows whose features differ, so for squared errors it grows the same from these as from the rows.
    """
    return rows.groupBy(*keys).agg(F.avg(F.col(label).cast("double")).alias(label), F.count(F.lit(1)).cast("double").alias("weight"))


def _fit(
    marked: DataFrame,
    features: Sequence[str],
    stages: Sequence,
    codes: Sequence[str] = (),
    suffix: str = "_encoded",
    pool: str | None = None,
) -> Fitted:
    """Fit on the rows not marked as test; iterative trainers checkpoint to the shared folder.

    ``codes`` are categories whose codes are learnt as the first stage; a value not seen then has a code of its own.
    ``pool`` names the label of a regressor that reads ``weight``: rows are then ``pooled`` if that at least halves them.
    """
    context = marked.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(marked.sparkSession))
    made = [f"{c}{suffix}" for c in codes]
    given = tuple(f for f in features if f not in made)
    first = [FE.indexer(codes, suffix)] if codes else []
    filled = _filled(marked, given)
    kept = (pooled(filled.filter(~F.col("is_test")), [*codes, *given], pool) if pool else filled).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        assembler = VectorAssembler(inputCols=list(features), outputCol="features")
        groups, rows = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum("weight"), F.lit(0.0))).first() if pool else (0, 0)
        if pool and rows >= 2 * groups:
            # Every level of every tree is a job: no more tasks than the pooled rows are worth.
            train = kept.coalesce(max(1, math.ceil(groups / ROWS)))
        elif pool:
            # Hardly any features are equal: the rows themselves.
            kept.unpersist()
            kept = filled.withColumn("weight", F.lit(1.0)).persist(StorageLevel.MEMORY_AND_DISK)
            train = kept.filter(~F.col("is_test"))
        else:
            train = kept.filter(~F.col("is_test"))
        model = Pipeline(stages=[*first, assembler, *stages]).fit(train)
    finally:
        kept.unpersist()
    tested = model.transform(_filled(marked.filter("is_test"), given))
    return Fitted(model, tested, tuple(features), given)


def fit_tier_model(table: DataFrame, trees: int = 100, depth: int = 10, seed: int = 42) -> Fitted:
    """Random forest for the tier, balanced by class weights, on a stratified split."""
    # A classifier has few classes; their weights become a CASE instead of a join on a hot key.
    weights = {r["tier"]: r["balanced_weight"] for r in FE.class_weights(table, "tier").collect()}
    marked = FE.stratified_split(table, "org_id", "tier", seed=seed).withColumn(
        "weight", C.map_values(F.col("tier"), {t: w for t, w in weights.items() if t is not None}, 1.0)
    )
    labels = StringIndexer(inputCol="tier", outputCol="label", stringOrderType="alphabetAsc").fit(marked)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, weightCol="weight", labelCol="label")
    names = IndexToString(inputCol="prediction", outputCol="predicted_tier", labels=labels.labels)
    return _fit(marked, TIER_FEATURES, [labels, forest, names], ENCODED)


def fit_rate_model(table: DataFrame, trees: int = 100, depth: int = 5, step: float = 0.1, seed: int = 42) -> Fitted:
    """Boosted trees for the rate."""
    marked = FE.split(table.filter(F.col("rate").isNotNull()), "org_id", seed=seed)
    boosted = GBTRegressor(labelCol="rate", maxIter=trees, maxDepth=depth, stepSize=step, seed=seed)
    return _fit(marked, RATE_FEATURES, [boosted], ENCODED)


def fit_risk_model(table: DataFrame, trees: int = 100, depth: int = 5, step: float = 0.1, seed: int = 42) -> Fitted:
    """Boosted trees for the risk label; the risky class weighs as much as the rest together."""
    marked = FE.split(table, "org_id", seed=seed)
    weights = {r["at_risk"]: r["rest_ratio"] for r in FE.class_weights(marked.filter(~F.col("is_test")), "at_risk").collect()}
    weighted = marked.withColumn("weight", F.when(F.col("at_risk") == 1, float(weights.get(1, 1.0))).otherwise(1.0))
    boosted = GBTClassifier(
        labelCol="at_risk", weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=step, seed=seed
    )
    return _fit(weighted, RISK_FEATURES, [boosted], ENCODED[:2])


def risk_probabilities(fitted: Fitted, table: DataFrame) -> DataFrame:
    """Probability of risk for every organisation."""
    return fitted.score(table).select("org_id", "sector", vector_to_array("probability")[1].alias("risk_probability"))


def held_back_probabilities(fitted: Fitted) -> DataFrame:
    """Probability of risk and actual label of the organisations held back from fitting."""
    return fitted.tested.select("org_id", "at_risk", vector_to_array("probability")[1].alias("risk_probability"))


def fit_salary_model(
    people: DataFrame, orgs: DataFrame, trees: int = 100, depth: int = 8, step: float = 0.1, seed: int = 42
) -> Fitted:
    """Boosted trees for the salary of a person from job, person and organisation.

    All features are codes, so many people share theirs; every level of every tree reads each such group once.
    """
    org = orgs.select("org_id", "sector", "size", "region")
    joined = people.filter(F.col("salary").isNotNull()).join(C.unaligned(org), "org_id")
    marked = FE.split(FE.hash_codes(joined, SALARY_OPEN, "_enc"), "person_id", seed=seed)
    boosted = GBTRegressor(labelCol="salary", weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=step, seed=seed)
    names = [f"{c}_enc" for c in (*SALARY_OPEN, *SALARY_CATEGORIES)]
    return _fit(marked, [*names, "is_remote"], [boosted], SALARY_CATEGORIES, "_enc", pool="salary")


def regression_report(fitted: Fitted, label: str) -> DataFrame:
    """Errors on the test rows: mean squared, its root, mean absolute and the share of variance explained."""
    y, p = F.col(label).cast("double"), F.col("prediction")
    sums = fitted.tested.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg((y - p) * (y - p)).alias("mse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.var_pop(y).alias("variance"),
    )
    r2 = F.lit(1.0) - F.try_divide(F.col("mse"), F.col("variance"))
    return sums.select("rows", "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2"))


def confusion(fitted: Fitted, label: str = "label") -> DataFrame:
    """Test rows per actual and predicted class."""
    return fitted.tested.groupBy(F.col(label).cast("double").alias("actual"), "prediction").agg(
        F.count(F.lit(1)).alias("rows")
    )


def classification_report(fitted: Fitted, label: str = "label") -> DataFrame:
    """Precision, recall, F1 and support per class, with the overall accuracy on every row."""
    pairs = confusion(fitted, label)
    hit = F.when(F.col("actual") == F.col("prediction"), F.col("rows")).otherwise(0)
    # Each pair counts once for its actual and once for its predicted class.
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("class"), F.col("rows").alias("support"), F.lit(0).alias("named"), hit.alias("hits")),
                F.struct(F.col("prediction").alias("class"), F.lit(0).alias("support"), F.col("rows").alias("named"), F.lit(0).alias("hits")),
            )
        )
    )
    per_class = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "named", "hits")])
    accuracy = pairs.agg(F.sum(hit) / F.sum("rows")).scalar()
    precision = F.coalesce(F.try_divide(F.col("hits"), F.col("named")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("hits"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    return per_class.select(
        "class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support", accuracy.alias("accuracy")
    )


@dataclass(frozen=True)
class Segments:
    """K-means over standardised features: the chosen centres, rows with their cluster, cost per k."""

    centres: clusters.Centres
    rows: DataFrame
    elbow: dict[int, float]


def standardise(table: DataFrame, columns: Sequence[str] = SEGMENT_FEATURES) -> DataFrame:
    """Add ``scaled``: the columns centred and divided by their standard deviation."""
    filled = _filled(table, columns)
    stages = [
        VectorAssembler(inputCols=list(columns), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="scaled", withMean=True, withStd=True),
    ]
    return Pipeline(stages=stages).fit(filled).transform(filled)


def segment(table: DataFrame, k: int = 4, elbow: Sequence[int] = range(2, 8), restarts: int = 10, seed: int = 42) -> Segments:
    """Cluster the organisations: the best of several restarts for ``k`` and, for the elbow, for every other k.

    All restarts of all sizes are moved by the same passes over one persisted input.
    """
    scaled = standardise(table).withColumn("features", vector_to_array("scaled"))
    points = scaled.select("features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = clusters.fit_all(points, sorted({k, *elbow}), restarts, seed)
    finally:
        points.unpersist()
    best = {size: min((c for c in found if c.k == size), key=lambda c: c.cost) for size in {k, *elbow}}
    rows = scaled.withColumn("cluster", clusters.nearest(F.col("features"), best[k].places))
    return Segments(best[k], rows, {size: best[size].cost for size in elbow})


def segment_profiles(rows: DataFrame) -> DataFrame:
    """Size and averages of every cluster."""
    return rows.groupBy("cluster").agg(
        F.round(F.avg("total"), 2).alias("avg_total"),
        F.round(F.avg("rate"), 2).alias("avg_rate"),
        F.round(F.avg("avg_salary"), 2).alias("avg_salary"),
        F.round(F.avg("total_alerts"), 2).alias("avg_alerts"),
        F.count("org_id").alias("orgs"),
    )


def elbow_costs(spark: SparkSession, found: Segments) -> DataFrame:
    """Cost per number of clusters."""
    return spark.createDataFrame(sorted((k, float(v)) for k, v in found.elbow.items()), "k int, cost double")


def cluster_table(rows: DataFrame, column: str) -> DataFrame:
    """Organisations per cluster and value of a column."""
    return rows.groupBy("cluster", column).agg(F.count(F.lit(1)).alias("orgs"))


def risk_by_sector(probabilities: DataFrame) -> DataFrame:
    """Mean probability of risk per sector, highest first."""
    mean = F.round(F.avg("risk_probability"), 4).alias("mean_risk")
    return probabilities.groupBy("sector").agg(mean, F.count(F.lit(1)).alias("orgs")).orderBy(F.desc("mean_risk"), "sector")


def project2d(rows: DataFrame) -> DataFrame:
    """Two principal components of the standardised features."""
    model = PCA(k=2, inputCol="scaled", outputCol="components").fit(rows)
    parts = vector_to_array("components")
    return model.transform(rows).withColumns({"pc1": parts[0], "pc2": parts[1]})
