"""Rating by age, and player clusters."""

from __future__ import annotations

from decimal import Decimal, localcontext

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.expressions import age_days, scaled_age, scaled_rating, settle_rating
from touchline.operators.folds import ORDER

CLUSTERS = 5
FEATURES = ["fouls", "goals", "own_goals", "pass_acc", "shot_acc", "matches"]


def training_frame(rated: DataFrame, players: DataFrame, scope: str = "latest_per_player") -> DataFrame:
    """Age in days at the match and rating after it, for roster players.

    "latest_per_player" keeps each player's newest row, "last_match" the rows of the newest match,
    "all" every row.
    """
    if scope not in ("latest_per_player", "last_match", "all"):
        raise ValueError("scope is 'latest_per_player', 'last_match' or 'all'")
    rows = rated.filter("on_roster").select("player_id", *ORDER, "match_date", "rating")
    if scope == "latest_per_player":
        rows = latest_per_player(rows)
    elif scope == "last_match":
        last = rows.agg(F.max(F.struct(*ORDER)).alias("m")).select("m.match_id")
        rows = rows.join(F.broadcast(last), "match_id", "left_semi")
    born = players.select(F.col("Id").alias("player_id"), "birthDate")
    return rows.join(born, "player_id").select(
        "player_id",
        *ORDER,
        age_days(F.col("match_date"), F.col("birthDate")).alias("diff"),
        F.coalesce("rating", F.lit(0.0)).alias("rating"),
    )


def latest_per_player(rows: DataFrame) -> DataFrame:
    """Newest row of each player; an aggregate, so a hot player is reduced before the shuffle."""
    rest = [c for c in rows.columns if c != "player_id"]
    newest = rows.groupBy("player_id").agg(F.max_by(F.struct(*rest), F.struct(*ORDER)).alias("r"))
    return newest.select("player_id", "r.*")


def replace_history(saved: DataFrame, new: DataFrame) -> DataFrame:
    """Saved rows of players without a new one, and the new rows."""
    return saved.join(new.select("player_id"), "player_id", "left_anti").unionByName(new)


def _scaled(frame: DataFrame) -> DataFrame:
    return frame.withColumn("new_diff", scaled_age(F.col("diff"))).withColumn(
        "new_rating", scaled_rating(F.col("rating"))
    )


def fit_rating(
    frame: DataFrame, weight_col: str | None = None, split: float | None = None, seed: int = 0
) -> LinearRegressionModel:
    """Least squares of rating on age. `split` fits on that share of the rows, seeded."""
    data = _scaled(frame)
    if split is not None:
        data = data.randomSplit([split, 1.0 - split], seed=seed)[0]
    data = VectorAssembler(inputCols=["new_diff"], outputCol="features").transform(data)
    options = {"featuresCol": "features", "labelCol": "new_rating"}
    if weight_col is not None:
        options["weightCol"] = weight_col
    return LinearRegression(**options).fit(data)


def rating_line(frame: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The same fit as one aggregate: slope and intercept, per group if asked."""
    data = _scaled(frame)
    line = [
        F.regr_slope("new_rating", "new_diff").alias("slope"),
        F.regr_intercept("new_rating", "new_diff").alias("intercept"),
        F.count("*").alias("n"),
    ]
    return data.groupBy(*by).agg(*line) if by else data.agg(*line)


def line_sums(before: DataFrame, now: DataFrame) -> dict[str, Decimal]:
    """What the sums behind the rating line change by if rows of the training frame give way to others.

    Age and rating are taken as decimals of 17 places, so that a row taken away leaves no rounding behind.
    """
    rows = before.withColumn("__n", F.lit(-1)).unionByName(now.withColumn("__n", F.lit(1)))
    x = (F.col("diff").cast("decimal(10,0)") / F.lit(1000).cast("decimal(4,0)")).cast("decimal(10,3)")
    y = scaled_rating(F.col("rating")).cast("decimal(20,17)")
    rows = rows.filter("diff IS NOT NULL").select("__n", x.alias("x"), y.alias("y"))
    terms = {"n": F.lit(1), "x": F.col("x"), "y": F.col("y"), "xx": F.col("x") * F.col("x"), "xy": F.col("x") * F.col("y")}
    signed = [F.sum(F.when(F.col("__n") > 0, v).otherwise(-v)).cast("decimal(38,18)").alias(k) for k, v in terms.items()]
    found = rows.agg(*signed).first().asDict()
    return {k: v or Decimal(0) for k, v in found.items()}


def line_of_sums(spark: SparkSession, sums: dict[str, str]) -> DataFrame:
    """Slope and intercept from the sums: the mean where all ages are equal, NULL without rows."""
    n, x, y, xx, xy = (Decimal(sums.get(k, "0")) for k in ("n", "x", "y", "xx", "xy"))
    with localcontext(prec=80):
        spread = n * xx - x * x
        slope = ((n * xy - x * y) / spread if spread else Decimal(0)) if n else None
        intercept = (y - slope * x) / n if n else None
    values = [F.lit(None if v is None else float(v)).cast("double") for v in (slope, intercept)]
    return spark.range(1).select(values[0].alias("slope"), values[1].alias("intercept"))


def model_line(spark: SparkSession, model: LinearRegressionModel) -> DataFrame:
    return spark.range(1).select(
        F.lit(float(model.coefficients[0])).alias("slope"),
        F.lit(float(model.intercept)).alias("intercept"),
    )


def save_model(model: LinearRegressionModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> LinearRegressionModel:
    return LinearRegressionModel.load(path)


def predicted(line: DataFrame, rows: DataFrame, on: Column, birth: Column) -> DataFrame:
    """Add `predicted` to every row from the one-row `line`. No line, no prediction."""
    fit = line.agg(F.first(F.struct("slope", "intercept"))).scalar()
    raw = fit["intercept"] + fit["slope"] * scaled_age(age_days(on, birth))
    return rows.withColumn("predicted", settle_rating(raw))


def predict_rating(line: DataFrame, players: DataFrame, on: Column) -> DataFrame:
    rows = players.select("Id", "birthDate", on.alias("date"))
    out = predicted(line, rows, F.col("date"), F.col("birthDate"))
    return out.select(F.col("Id").alias("player_id"), "date", "predicted")


def _features(profile: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(profile)


def fit_clusters(profile: DataFrame, k: int = CLUSTERS, seed: int = 0) -> KMeansModel:
    return KMeans(k=k, seed=seed).fit(_features(profile).select("features"))


def cluster_players(profile: DataFrame, k: int = CLUSTERS, seed: int = 0) -> DataFrame:
    model = fit_clusters(profile, k, seed)
    return model.transform(_features(profile)).select(
        "player_id", F.col("prediction").alias("cluster")
    )


def misplaced(profile: DataFrame, k: int = CLUSTERS, seed: int = 0) -> DataFrame:
    """One row: clusters, players, and how many players stand nearer to another center than to their own."""
    model = fit_clusters(profile, k, seed)
    assigned = model.transform(_features(profile))
    spots = [[float(x) for x in c] for c in model.clusterCenters()]
    place = vector_to_array("features")
    gaps = F.array(*[F.aggregate(F.zip_with(place, F.array(*map(F.lit, c)), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, d: a + d) for c in spots])
    return assigned.select("prediction", gaps.alias("gaps")).agg(
        F.count_distinct("prediction").alias("clusters"),
        F.count("*").alias("players"),
        F.count_if(F.get("gaps", F.col("prediction")) > F.array_min("gaps") + 1e-9).alias("misplaced"),
    )


def silhouette(profile: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row per cluster of (player_id, cluster): its size, and the silhouette of the whole clustering.

    Distances are squared; the evaluator works from sums per cluster, not from pairs of players.
    """
    assigned = _features(profile).join(clusters.select("player_id", F.col("cluster").cast("int").alias("prediction")), "player_id")
    value = ClusteringEvaluator().evaluate(assigned)
    sizes = assigned.groupBy(F.col("prediction").alias("cluster")).agg(F.count("*").alias("size"))
    return sizes.withColumn("silhouette", F.lit(value))


def cluster_quality(profile: DataFrame, k: int = CLUSTERS, seed: int = 0) -> DataFrame:
    """One row per cluster: size, center and the silhouette of the whole clustering."""
    data = _features(profile)
    model = fit_clusters(profile, k, seed)
    assigned = model.transform(data)
    silhouette = ClusteringEvaluator().evaluate(assigned)
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    named = profile.sparkSession.createDataFrame(centers, "cluster int, center array<double>")
    sizes = assigned.groupBy(F.col("prediction").alias("cluster")).agg(F.count("*").alias("size"))
    return sizes.join(F.broadcast(named), "cluster").withColumn("silhouette", F.lit(silhouette))
