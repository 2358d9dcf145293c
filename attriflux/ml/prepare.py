"""Feature cleaning, reproducible splits and scaling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attriflux.functions.columns import clean_number, key_fraction

TEST_SHARE = 0.2
SEED = 42
BUCKETS = 10_000              # of a draw, and of each of these again


def clean_features(df: DataFrame, features: list[str]) -> DataFrame:
    """Missing, NaN and infinite feature values become 0."""
    return df.withColumns({c: clean_number(F.col(c).cast("double")) for c in features})


def business_key(df: DataFrame) -> list[str]:
    return [c for c in ("source", "campaign_name", "c_date", "id") if c in df.columns]


def _draw(df: DataFrame, seed: int) -> Column:
    return key_fraction(F.lit(seed), *business_key(df))


def split_random(df: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Add ``split`` (train or test) from a hash of the row's key: no shuffle, same result on every run."""
    return df.withColumn("split", F.when(_draw(df, seed) < test_share, "test").otherwise("train"))


def _bucket_of_rank(counts: DataFrame, rank: Column) -> DataFrame:
    """(_class, _in, _rank): per class the bucket that holds the rank, and the rank inside it."""
    upto = F.sum("_n").over(Window.partitionBy("_class").orderBy("_in"))
    ranked = counts.withColumns({"_upto": upto, "_whole": F.sum("_n").over(Window.partitionBy("_class"))})
    ranked = ranked.withColumn("_wanted", rank)
    found = ranked.filter((F.col("_upto") >= F.col("_wanted")) & (F.col("_upto") - F.col("_n") < F.col("_wanted")))
    return found.select("_class", "_in", (F.col("_wanted") - F.col("_upto") + F.col("_n")).alias("_rank"))


def cuts(drawn: DataFrame, share: float) -> DataFrame:
    """(_class, _cut): the draw of the last of the first ceil(share x rows) rows of each class, exactly.

    Rows are counted per class and bucket of their draw, the rows of the bucket
    with the rank in finer buckets, and those of the finer bucket, one row in
    10^8, are put in order. Shuffled are counts, with partial sums first.
    """
    drawn = drawn.withColumn("_fine", F.floor(F.col("_draw") * F.lit(float(BUCKETS * BUCKETS))))
    drawn = drawn.withColumn("_coarse", F.floor(F.col("_fine") / BUCKETS))

    def inside(rows: DataFrame, places: DataFrame, bucket: str) -> DataFrame:
        at = places.select(F.col("_class").alias("_of"), "_in", "_rank")         # one row per class
        return rows.join(F.broadcast(at), F.col("_class").eqNullSafe(F.col("_of")) & (F.col(bucket) == F.col("_in")))

    coarse = drawn.groupBy("_class", F.col("_coarse").alias("_in")).agg(F.count(F.lit(1)).alias("_n"))
    rows = inside(drawn, _bucket_of_rank(coarse, F.ceil(F.lit(share) * F.col("_whole"))), "_coarse")
    fine = rows.groupBy("_class", F.col("_fine").alias("_in"), "_rank").agg(F.count(F.lit(1)).alias("_n"))
    rows = inside(drawn, _bucket_of_rank(fine, F.col("_rank")), "_fine")
    nth = F.row_number().over(Window.partitionBy("_class").orderBy("_draw"))
    return rows.withColumn("_nth", nth).filter(F.col("_nth") == F.col("_rank")).select("_class", F.col("_draw").alias("_cut"))


def split_stratified(df: DataFrame, target: str, test_share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Like ``split_random``, with the cut placed per class so that each class keeps its share.

    Of every class the first ceil(test_share x rows) draws are the test part.
    """
    drawn = df.withColumn("_draw", _draw(df, seed))
    last = cuts(drawn.select(F.col(target).alias("_class"), "_draw"), test_share)
    joined = drawn.join(F.broadcast(last), F.col(target).eqNullSafe(F.col("_class")), "left")     # one row per class
    return joined.withColumn("split", F.when(F.col("_draw") <= F.col("_cut"), "test").otherwise("train")).select(
        *df.columns, "split")


def train_part(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split") == "train")


def test_part(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split") == "test")


def split_stats(df: DataFrame, value: str) -> DataFrame:
    """Size and mean of the target (the anomaly rate, or mean ROAS) per split."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.avg(value).alias("mean_value"))


@dataclass(frozen=True)
class Scaler:
    """Means and population standard deviations; a constant feature is only centred."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]

    @classmethod
    def fit(cls, df: DataFrame, features: list[str]) -> Scaler:
        """One aggregation; two numbers per feature come back."""
        row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in features],
                     *[F.stddev_pop(c).alias(f"s_{c}") for c in features]).first()
        return cls(tuple(features), tuple(float(row[f"m_{c}"] or 0.0) for c in features),
                   tuple(float(row[f"s_{c}"] or 0.0) or 1.0 for c in features))

    def columns(self) -> list[Column]:
        return [((F.col(c) - F.lit(m)) / F.lit(s)).alias(c)
                for c, m, s in zip(self.features, self.means, self.scales)]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(dict(zip(self.features, self.columns())))

    def assemble(self, df: DataFrame, out: str = "features") -> DataFrame:
        """Scaled features as one vector column."""
        return df.withColumn(out, array_to_vector(F.array(*self.columns())))


def standard_scale(df: DataFrame, features: list[str]) -> DataFrame:
    """Scale by the statistics of the training rows."""
    return Scaler.fit(train_part(df), features).transform(df)
