"""Model samples, and the fitted design matrix: sums, a table of categories, and joins."""

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright import vocabulary as V
from claimwright.functions.bands import claim_count_stratum
from claimwright.functions.casting import strict_truth
from claimwright.operators.contracts import require_none
from claimwright.operators.ranking import accumulate, in_ranges, medians, offsets, with_decile
from claimwright.session import stage


def with_missing_label(df: DataFrame, columns: list[str] = V.MODEL_TEXTS) -> DataFrame:
    """Missing categories become the category 'Missing'."""
    return df.withColumns({c: F.coalesce(c, F.lit("Missing")) for c in columns})


def _eligible(policy: DataFrame, flag: str) -> DataFrame:
    return policy.filter(strict_truth(policy, flag))


def occurrence_sample(policy: DataFrame) -> DataFrame:
    """Eligible policies with features and the 0/1 target."""
    return _eligible(policy, "FrequencyModelEligible").select(
        "IDpol", "Exposure", "Area", "VehPower", "VehAge", "DrivAge", "BonusMalus",
        "VehBrand", "VehGas", "Density", "Region",
        F.col("HasClaim").cast("int").alias("HasClaim"),
        F.log("Exposure").alias("LogExposure"),
        F.log1p("Density").alias("LogDensity"),
    )


def frequency_sample(policy: DataFrame) -> DataFrame:
    """Eligible policies with the claim rate, its weight and the claim-count stratum."""
    return with_missing_label(
        _eligible(policy, "FrequencyModelEligible").select(
            "IDpol", "Exposure", "ClaimNb", "Area", "VehPower", "VehAge", "DrivAge",
            "BonusMalus", "VehBrand", "VehGas", "Density", "Region",
            F.log1p("Density").alias("LogDensity"),
            (F.col("ClaimNb") / F.col("Exposure")).alias("ClaimFrequency"),
            claim_count_stratum(F.col("ClaimNb")).alias("ClaimCountStratum"),
        )
    )


def severity_policies(policy: DataFrame) -> DataFrame:
    """Policies with complete positive losses and their average claim."""
    return with_missing_label(
        _eligible(policy, "SeverityModelEligible").select(
            "IDpol", "ClaimNb", "Exposure", "Area", "VehPower", "VehAge", "DrivAge",
            "BonusMalus", "VehBrand", "VehGas", "Density", "Region",
            "CompleteTotalClaimAmount", "CompleteAverageClaimAmount",
            (F.col("CompleteTotalClaimAmount") / F.col("ClaimNb")).alias("AverageClaimSeverity"),
            F.log1p("Density").alias("LogDensity"),
        )
    )


def severity_sample(rows: DataFrame) -> DataFrame:
    """severity_policies with the severity decile 0-9 as split stratum."""
    ranked = with_decile(rows, "AverageClaimSeverity", "IDpol", "_decile")
    return ranked.withColumn("SeverityStratum", F.col("_decile") - 1).drop("_decile")


# Conditions that make a sample unfit, by name.
OCCURRENCE_PROBLEMS = {
    "target_not_zero_or_one": "NOT coalesce(HasClaim IN (0, 1), false)",
    "exposure_missing_or_not_positive": "NOT coalesce(Exposure > 0, false)",
    "density_negative": "Density < 0",
}
FREQUENCY_PROBLEMS = {
    "exposure_missing_or_not_positive": "NOT coalesce(Exposure > 0, false)",
    "claims_missing_or_negative": "NOT coalesce(ClaimNb >= 0, false)",
    "density_negative": "Density < 0",
}
SEVERITY_PROBLEMS = {
    "claims_missing_or_not_positive": "NOT coalesce(ClaimNb > 0, false)",
    "total_missing_or_not_positive": "NOT coalesce(CompleteTotalClaimAmount > 0, false)",
    "average_missing_or_not_positive": "NOT coalesce(CompleteAverageClaimAmount > 0, false)",
    "density_negative": "Density < 0",
    "average_does_not_reconcile": (
        "abs(AverageClaimSeverity - CompleteAverageClaimAmount)"
        " > 1e-6 + 1e-8 * abs(CompleteAverageClaimAmount)"),
}


def check_occurrence(sample: DataFrame) -> DataFrame:
    return require_none(sample, OCCURRENCE_PROBLEMS, "The occurrence sample")


def check_frequency(sample: DataFrame) -> DataFrame:
    return require_none(sample, FREQUENCY_PROBLEMS, "The frequency sample")


def check_severity(sample: DataFrame) -> DataFrame:
    return require_none(sample, SEVERITY_PROBLEMS, "The severity sample")


def category_places(df: DataFrame, texts: list[str]) -> DataFrame:
    """(c, v, n, place, size): every value of every text column, its rows, its place from 0
    in the order of values, and how many values there are. Written once; the places come
    from ranges of the values, so no task and no list on the driver holds them all."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in texts
    ])).alias("p")).select("p.*").filter("v IS NOT NULL")
    counts = in_ranges(pairs.groupBy("c", "v").agg(F.count("*").alias("n")), "c", "v")
    one = {"k": F.lit(1)}
    placed = accumulate(counts, offsets(counts, one, ["c"]), ["v"], one, ["c"])
    return stage(placed.select(
        "c", "v", "n", F.col("k_before").cast("bigint").alias("place"),
        F.col("k_all").cast("bigint").alias("size")), "categories")


@dataclass
class Design:
    """A fitted design matrix: imputed, standardised numbers and one-hot texts.

    Numbers take their exact median where missing and are scaled by the population
    deviation. Texts take their most frequent value where missing (the smallest on a
    tie); the first category is the reference and an unknown one is all zeros. The categories
    are a table that rows are joined to, and a row's vector is sparse, so there may be many.
    """

    numbers: dict[str, tuple[float, float, float]]
    texts: dict[str, tuple[str, int]]
    categories: DataFrame

    @classmethod
    def fit(cls, df: DataFrame, numbers: list[str], texts: list[str]) -> "Design":
        middle = medians(df, numbers)
        filled = {c: F.coalesce(F.col(c), F.lit(middle.get(c))).cast("double") for c in numbers}
        row = df.agg(*[
            F.struct(F.avg(x).alias("m"), F.stddev_pop(x).alias("s")).alias(c)
            for c, x in filled.items()
        ]).first()
        categories = category_places(df, texts)
        # One row for each text column.
        usual = {r["c"]: (r["u"]["v"], r["size"]) for r in categories.groupBy("c").agg(
            F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("u"),
            F.max("size").alias("size")).collect()}
        return cls(
            {c: (middle[c], row[c]["m"], row[c]["s"] or 1.0) for c in numbers},
            {c: usual[c] for c in texts if c in usual}, categories)

    def _one_hot(self) -> list[str]:
        """The texts that have a category beside the reference."""
        return [c for c, (_, size) in self.texts.items() if size > 1]

    def width(self) -> int:
        return len(self.numbers) + sum(self.texts[c][1] - 1 for c in self._one_hot())

    def names(self) -> DataFrame:
        """(position, name) of every column of the matrix."""
        spark = self.categories.sparkSession
        first = spark.createDataFrame(
            [(i, f"numeric__{c}") for i, c in enumerate(self.numbers)], "position bigint, name string")
        start, base = len(self.numbers), F
        for c in self._one_hot():
            base = base.when(F.col("c") == c, F.lit(start))
            start += self.texts[c][1] - 1
        if base is F:
            return first
        rest = self.categories.filter(F.col("c").isin(self._one_hot()) & (F.col("place") > 0)).select(
            (base.otherwise(0) + F.col("place") - 1).cast("bigint").alias("position"),
            F.concat(F.lit("categorical__"), "c", F.lit("_"), "v").alias("name"))
        return first.unionByName(rest)

    def features(self, df: DataFrame) -> DataFrame:
        """The rows with their vector in `features`."""
        out, places, sizes = df, {}, []
        for i, c in enumerate(self._one_hot()):
            usual, size = self.texts[c]
            # The encoder leaves the last place out: the reference and unknown values have it.
            own = self.categories.filter(F.col("c") == c).select(
                F.col("v").alias(f"_v{i}"),
                F.when(F.col("place") == 0, size - 1).otherwise(F.col("place") - 1).alias(f"_p{i}"))
            out = out.join(
                own, F.coalesce(F.col(c).cast("string"), F.lit(usual)) == F.col(f"_v{i}"), "left")
            places[f"_p{i}"] = F.coalesce(f"_p{i}", F.lit(size - 1)).cast("double")
            sizes.append(float(size - 1))
        out = out.withColumns(places)
        scaled = {f"_x{i}": (F.coalesce(F.col(c), F.lit(m)) - F.lit(mean)) / F.lit(scale)
                  for i, (c, (m, mean, scale)) in enumerate(self.numbers.items())}
        out = out.withColumns(scaled)
        parts = list(scaled)
        if sizes:
            spark = df.sparkSession
            largest = spark.createDataFrame([tuple(sizes)], ", ".join(f"{p} double" for p in places))
            encoded = [f"_e{i}" for i in range(len(sizes))]
            out = OneHotEncoder(inputCols=list(places), outputCols=encoded).fit(largest).transform(out)
            parts += encoded
        out = VectorAssembler(inputCols=parts, outputCol="features").transform(out)
        return out.select(*df.columns, "features")

    def frame(self, df: DataFrame, *keep: str) -> DataFrame:
        """The matrix as named columns, for matrices of few columns."""
        names = [r["name"] for r in self.names().orderBy("position").collect()]
        values = vector_to_array("features")
        return self.features(df).select(
            *keep, *[values[i].alias(n) for i, n in enumerate(names)])

    def save(self, path: str) -> None:
        spark = self.categories.sparkSession
        spark.createDataFrame(
            [(i, c, *x) for i, (c, x) in enumerate(self.numbers.items())],
            "place int, name string, median double, mean double, scale double"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/numbers")
        spark.createDataFrame(
            [(i, c, *x) for i, (c, x) in enumerate(self.texts.items())],
            "place int, name string, usual string, size bigint"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/texts")
        self.categories.write.mode("overwrite").parquet(f"{path}/categories")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Design":
        numbers = spark.read.parquet(f"{path}/numbers").orderBy("place").collect()
        texts = spark.read.parquet(f"{path}/texts").orderBy("place").collect()
        return cls({r["name"]: (r["median"], r["mean"], r["scale"]) for r in numbers},
                   {r["name"]: (r["usual"], r["size"]) for r in texts},
                   spark.read.parquet(f"{path}/categories"))
