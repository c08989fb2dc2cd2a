"""k-means categories of articles.

Two ways in: Lloyd rounds on dense vectors held as arrays (or Spark ML, with
random seeds), and on the sparse article-term matrix, whose vocabulary has no
bound and is never made dense.
"""

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.functions.scores import rank_key
from broadsheet.plans.skew import salted_join
from broadsheet.plans.storage import stored
from broadsheet.settings import CLUSTER_DELTA, CLUSTER_STEPS, CLUSTERS, RANK_DIGITS

# --- dense vectors --------------------------------------------------------------


def seed_order(key: str) -> list[Column]:
    """An order that is as good as random, but the same in every run."""
    return [F.md5(F.col(key).cast("string")), F.col(key)]


def seeds(vectors: DataFrame, key: str = "vec_id", k: int = CLUSTERS) -> DataFrame:
    """``k`` rows as first centres, numbered from 0."""
    picked = vectors.orderBy(*seed_order(key)).limit(k)
    order = Window.orderBy(*seed_order(key))
    return picked.withColumn("cluster", F.row_number().over(order) - 1)


def _mean_vectors(assigned: DataFrame, width: int) -> DataFrame:
    """Mean vector of each cluster, all dimensions in one aggregate."""
    sums = [F.avg(F.get("embedding", F.lit(d)).cast("double")).alias(f"d{d}") for d in range(width)]
    means = assigned.groupBy("cluster").agg(*sums)
    return means.select("cluster", F.array(*[f"d{d}" for d in range(width)]).alias("embedding"))


def lloyd(
    vectors: DataFrame, k: int = CLUSTERS, steps: int = CLUSTER_STEPS, delta: float = CLUSTER_DELTA, key: str = "vec_id"
) -> DataFrame:
    """Centres (cluster, embedding) after at most ``steps`` rounds from fixed seeds.

    A round sends the ``k`` centres to the rows and sums vectors in one
    aggregate, so only sums are shuffled. Rounds end early when no centre moved
    further than ``delta``; a cluster without members keeps its centre.
    """
    width = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    doubles = F.col("embedding").cast("array<double>").alias("embedding")
    now = stored(seeds(vectors, key, k).select("cluster", doubles), "centres")
    for _ in range(steps if width else 0):
        means = _mean_vectors(assign(vectors, now), width).withColumnRenamed("embedding", "mean")
        squares = F.zip_with("embedding", "mean", lambda x, m: F.pow(x - m, F.lit(2.0)))
        moved = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, s: total + s))
        after = now.join(means, "cluster", "left").select(
            "cluster", F.coalesce("mean", "embedding").alias("embedding"), F.coalesce(moved, F.lit(0.0)).alias("moved")
        )
        after = stored(after, "centres")
        now = after.select("cluster", "embedding")
        if after.agg(F.max("moved")).first()[0] <= delta:
            break
    return now


def fit(
    vectors: DataFrame, k: int = CLUSTERS, steps: int = CLUSTER_STEPS,
    delta: float = CLUSTER_DELTA, seed: int = 42,
) -> KMeansModel:
    """Centres trained by Spark ML; random seeds, Euclidean distance."""
    prepared = vectors.select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    return KMeans(k=k, maxIter=steps, tol=delta, initMode="random", seed=seed).fit(prepared)


def assign_with(model: KMeansModel, vectors: DataFrame) -> DataFrame:
    prepared = vectors.select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    return model.transform(prepared).select("vec_id", F.col("prediction").alias("cluster"))


def assign(vectors: DataFrame, centres: DataFrame) -> DataFrame:
    """The nearest centre of each row; every row is kept.

    The ``k`` centres come along as one array, so rows stay where they are.
    """
    packed = centres.agg(
        F.array_sort(F.collect_list(F.struct("cluster", F.col("embedding").alias("centre"))))
    ).scalar()

    def distance(centre: Column) -> Column:
        squares = F.zip_with(
            "embedding",
            centre,
            lambda x, c: F.pow(x.cast("double") - c.cast("double"), F.lit(2.0)),
        )
        return F.aggregate(squares, F.lit(0.0), lambda total, s: total + s)

    nearest = F.array_min(
        F.transform(
            F.col("centres"),
            lambda c: F.struct(
                rank_key(distance(c["centre"])).alias("distance"), c["cluster"].alias("cluster")
            ),
        )
    )
    return (
        vectors.withColumn("centres", packed)
        .withColumn("nearest", nearest)
        .select(
            "vec_id",
            "embedding",
            "nearest.cluster",
            (F.col("nearest.distance") / 10.0**RANK_DIGITS).alias("distance"),
        )
    )


def centres(assigned: DataFrame) -> DataFrame:
    """Mean vector per cluster, one row per dimension."""
    return (
        assigned.select("cluster", F.posexplode("embedding").alias("dim", "value"))
        .groupBy("cluster", "dim")
        .agg(F.avg(F.col("value").cast("double")).alias("mean"))
    )


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_members"))


# --- sparse article-term matrix ---------------------------------------------------


def _columns(k: int) -> list[str]:
    return [f"c{i}" for i in range(k)]


def seed_centres(matrix: DataFrame, k: int = CLUSTERS) -> DataFrame:
    """First centres: ``k`` articles, one column per centre, one row per term."""
    articles = matrix.select("news_id").distinct()
    picked = F.broadcast(
        seeds(articles, "news_id", k)  # k rows
    )
    cells = matrix.join(picked, "news_id")
    return cells.groupBy("term").agg(
        *[
            F.sum(F.when(F.col("cluster") == i, F.col("n")).otherwise(0)).cast("double").alias(c)
            for i, c in enumerate(_columns(k))
        ]
    )


def nearest_centres(matrix: DataFrame, centre: DataFrame, k: int = CLUSTERS) -> DataFrame:
    """The nearest centre of every article, by |c|² − 2 x·c.

    |x|² is the same for all centres of an article and left out. A centre that
    is zero never had an article (there were fewer than ``k``) and takes none.
    """
    names = _columns(k)
    norms = centre.agg(F.array(*[F.sum(F.col(c) * F.col(c)) for c in names])).scalar()
    terms = matrix.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    met = salted_join(matrix, centre, "term", terms, "df", ["news_id"], "left")
    dots = met.groupBy("news_id").agg(
        F.array(
            *[F.coalesce(F.sum(F.col("n") * F.col(c)), F.lit(0.0)) for c in names]
        ).alias("dots")
    )
    compared = F.transform(
        F.arrays_zip(F.col("norms"), F.col("dots")),
        lambda z, i: F.when(
            z["norms"] > 0,
            F.struct(rank_key(z["norms"] - 2 * z["dots"]).alias("d"), i.alias("cluster")),
        ),
    )
    return dots.withColumn("norms", norms).select(
        "news_id", F.array_min(compared)["cluster"].alias("cluster")
    )


def mean_centres(
    matrix: DataFrame, assigned: DataFrame, centre: DataFrame, k: int = CLUSTERS
) -> DataFrame:
    """Mean count of each term in each cluster; one without members stays where it was.

    ``was0``, ``was1``, … are the centres before, from the same aggregate, so
    that how far they moved needs no join.
    """
    names = _columns(k)
    sizes = assigned.agg(
        F.array(*[F.count_if(F.col("cluster") == i) for i in range(k)])
    ).scalar()
    zero = F.lit(0.0)
    members = matrix.join(assigned, "news_id").select(
        "term",
        *[
            F.when(F.col("cluster") == i, F.col("n").cast("double")).otherwise(zero).alias(c)
            for i, c in enumerate(names)
        ],
        *[zero.alias(f"was{i}") for i in range(k)],
    )
    before = centre.select(
        "term", *[zero.alias(c) for c in names], *[F.col(c).alias(f"was{i}") for i, c in enumerate(names)]
    )
    columns = [*names, *[f"was{i}" for i in range(k)]]
    sums = members.unionByName(before).groupBy("term").agg(*[F.sum(c).alias(c) for c in columns])
    return sums.withColumn("sizes", sizes).select(
        "term",
        *[
            F.when(F.col("sizes")[i] > 0, F.col(c) / F.col("sizes")[i]).otherwise(F.col(f"was{i}")).alias(c)
            for i, c in enumerate(names)
        ],
        *[f"was{i}" for i in range(k)],
    )


def _largest_move(moved: DataFrame, k: int) -> float:
    """How far the centre that moved most went."""
    names = _columns(k)
    squares = moved.agg(
        *[F.sum(F.pow(F.col(c) - F.col(f"was{i}"), F.lit(2.0))).alias(c) for i, c in enumerate(names)]
    )
    largest = F.greatest(*names) if k > 1 else F.col(names[0])
    distance = squares.select(F.sqrt(largest).alias("d")).first()["d"]
    return 0.0 if distance is None else distance


def cluster_articles(
    matrix: DataFrame, k: int = CLUSTERS, steps: int = CLUSTER_STEPS, delta: float = CLUSTER_DELTA
) -> DataFrame:
    """Categories of articles from their (article, term, count) cells.

    An assignment is stored, as the sizes and the sums both need it, and so are
    the centres, so that the plan does not grow with the steps. Steps end early
    when no centre moves further than ``delta``.
    """
    centre = stored(seed_centres(matrix, k), "centres")
    for _ in range(steps):
        assigned = stored(nearest_centres(matrix, centre, k), "assigned")
        moved = stored(mean_centres(matrix, assigned, centre, k), "centres")
        centre = moved.select("term", *_columns(k))
        if _largest_move(moved, k) <= delta:
            break
    return nearest_centres(matrix, centre, k)
