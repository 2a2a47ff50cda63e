"""Fitted claim models: logistic, Poisson and Gamma regression, constants."""

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright import vocabulary as V
from claimwright.functions.measures import effect
from claimwright.operators.features import Design


@dataclass
class FittedModel:
    """A design matrix and the Spark ML model fitted on it.

    `kind` tells where the score is: the probability of class 1, or the prediction.
    """

    design: Design
    fitted: LogisticRegressionModel | GeneralizedLinearRegressionModel
    kind: str = "mean"

    def score(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        scored = self.fitted.transform(self.design.features(df))
        if self.kind == "probability":
            value = vector_to_array(F.col("probability"))[1]
        else:
            value = F.col("prediction")
        return scored.select(*df.columns, value.alias(output))

    def coefficients(self, effect_name: str) -> DataFrame:
        """One row per feature, by absolute coefficient."""
        values = self.fitted.coefficients.toArray().tolist()
        table = self.design.categories.sparkSession.createDataFrame(
            list(enumerate(values)), "position bigint, Coefficient double").join(
                self.design.names(), "position")
        return coefficient_table(
            table.select(F.col("name").alias("Feature"), "Coefficient"), effect_name)

    def gradient(self, train: DataFrame, target: str, weight: str | None, penalty: float) -> DataFrame:
        """(Feature, Gradient): the derivative of the penalised mean loss at the fitted
        coefficients; all zeros where the loss is least. `penalty` is that of half the sum of
        squares, beside the mean loss."""
        y, w, m = F.col(target).cast("double"), F.lit(1.0), F.col("_m")
        w = F.col(weight).cast("double") if weight else w
        gamma = self.kind == "mean" and self.fitted.getOrDefault("family") == "gamma"
        residual = w * ((1.0 - y / m) if gamma else (m - y))
        values = vector_to_array("features")
        rows = self.design.features(self.score(train, "_m")).select(
            residual.alias("_r"), w.alias("_w"), values.alias("_x"))
        width = self.design.width()
        sums = rows.agg(F.sum("_w"), *[F.sum(F.col("_r") * F.col("_x")[i]) for i in range(width)]).first()
        slopes = [sums[i + 1] / sums[0] + penalty * float(b)
                  for i, b in enumerate(self.fitted.coefficients.toArray())]
        return self.design.categories.sparkSession.createDataFrame(
            list(enumerate(slopes)), "position bigint, Gradient double").join(
                self.design.names(), "position").select(F.col("name").alias("Feature"), "Gradient")

    def save(self, path: str) -> None:
        self.design.save(f"{path}/design")
        self.fitted.write().overwrite().save(f"{path}/model")
        self.design.categories.sparkSession.createDataFrame([(self.kind,)], "kind string").coalesce(
            1).write.mode("overwrite").parquet(f"{path}/kind")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FittedModel":
        kind = spark.read.parquet(f"{path}/kind").first()["kind"]
        reader = (
            LogisticRegressionModel if kind == "probability" else GeneralizedLinearRegressionModel)
        return cls(Design.load(spark, f"{path}/design"), reader.load(f"{path}/model"), kind)


def coefficient_table(features: DataFrame, effect_name: str) -> DataFrame:
    """(Feature, Coefficient) with the multiplicative effect, largest coefficient first."""
    return features.select(
        "Feature", "Coefficient", effect(F.col("Coefficient")).alias(effect_name),
        F.abs("Coefficient").alias("AbsoluteCoefficient"),
    ).orderBy(F.desc("AbsoluteCoefficient"), "Feature")


def _fitted(design: Design, estimator, train: DataFrame, kind: str = "mean") -> FittedModel:
    """The estimator fitted on the matrix; its rows are read often, so they are kept while
    it runs."""
    wanted = ["features", estimator.getOrDefault("labelCol")]
    if estimator.isDefined("weightCol"):
        wanted.append(estimator.getOrDefault("weightCol"))
    rows = design.features(train).select(*wanted).persist()
    try:
        return FittedModel(design, estimator.fit(rows), kind)
    finally:
        rows.unpersist()


def fit_logistic(
    train: DataFrame, numbers=V.OCCURRENCE_NUMBERS, texts=V.MODEL_TEXTS, target="HasClaim",
    inverse_penalty: float = 1.0, iterations: int = 2_000, tolerance: float = 1e-6,
) -> FittedModel:
    """L2 logistic regression; the penalty is per sample, hence divided by the rows."""
    design = Design.fit(train, numbers, texts)
    rows = train.count()
    estimator = LogisticRegression(
        featuresCol="features", labelCol=target, regParam=1.0 / (inverse_penalty * rows),
        elasticNetParam=0.0, standardization=False, maxIter=iterations, tol=tolerance)
    return _fitted(design, estimator, train, "probability")


def _fit_glm(train, family, label, weight, penalty, numbers, texts) -> FittedModel:
    design = Design.fit(train, numbers, texts)
    estimator = GeneralizedLinearRegression(
        featuresCol="features", labelCol=label, weightCol=weight, family=family, link="log",
        regParam=penalty, maxIter=200, tol=1e-10)
    rows = train.withColumn(weight, F.col(weight).cast("double"))
    return _fitted(design, estimator, rows)


def fit_poisson(
    train: DataFrame, alpha: float = 1e-4, numbers=V.RATE_NUMBERS, texts=V.MODEL_TEXTS
) -> FittedModel:
    """L2 Poisson regression of the claim rate, weighted by exposure.

    Spark scales the penalty by the label, so it is divided by the weighted mean rate.
    """
    mean = train.agg(F.sum("ClaimNb") / F.sum("Exposure")).first()[0]
    return _fit_glm(train, "poisson", "ClaimFrequency", "Exposure", alpha / mean, numbers, texts)


def fit_gamma(
    train: DataFrame, alpha: float = 1e-4, numbers=V.RATE_NUMBERS, texts=V.MODEL_TEXTS
) -> FittedModel:
    """L2 Gamma regression of the average claim, weighted by claims."""
    return _fit_glm(train, "gamma", "AverageClaimSeverity", "ClaimNb", alpha, numbers, texts)


def claim_rate(train: DataFrame, target: str = "HasClaim") -> float:
    """Share of training policies with a claim."""
    return train.agg(F.avg(F.col(target).cast("double"))).first()[0]


def portfolio_frequency(train: DataFrame) -> float:
    """Training claims over training exposure."""
    return train.agg(F.sum("ClaimNb") / F.sum("Exposure")).first()[0]


def mean_severity(train: DataFrame) -> float:
    """Claim-weighted mean of the training severities."""
    row = train.agg(
        F.sum(F.col("AverageClaimSeverity") * F.col("ClaimNb")) / F.sum("ClaimNb")).first()
    return row[0]


def strongest(coefficients: DataFrame, positive: bool, rows: int = 15) -> DataFrame:
    """The largest positive, or the most negative, coefficients."""
    value = F.col("Coefficient")
    if positive:
        return coefficients.filter(value > 0).orderBy(value.desc(), "Feature").limit(rows)
    return coefficients.filter(value < 0).orderBy(value.asc(), "Feature").limit(rows)
