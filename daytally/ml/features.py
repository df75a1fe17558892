"""Feature vectors, category codes, scaling and the train/holdout split."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler, VectorIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.names import qcol
from daytally.operators.daily import TOTAL
from daytally.operators.series import MEASURES

SEED = 42
MAX_CATEGORIES = 4
TRAIN_SHARE = 0.7


def assembler(inputs: list[str] = MEASURES, output: str = "features") -> VectorAssembler:
    """Rows with a null input are left out of the result."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid="skip")


def labelled(df: DataFrame, label: str = TOTAL) -> DataFrame:
    return df.withColumn("label", qcol(label).cast("double"))


def feature_frame(df: DataFrame, day: str = "date", inputs: list[str] = MEASURES, label: str = TOTAL) -> DataFrame:
    """``(day, label, features)``; the day stays with its row all the way."""
    return assembler(inputs).transform(labelled(df, label)).select(day, "label", "features")


def cluster_frame(df: DataFrame, day: str = "date") -> DataFrame:
    """Seven-dimensional vectors: the measures and the total."""
    return feature_frame(df, day, [*MEASURES, TOTAL])


def category_indexer(max_categories: int = MAX_CATEGORIES) -> VectorIndexer:
    """Features with few distinct values become category codes; unseen values stay scorable."""
    return VectorIndexer(
        inputCol="features", outputCol="indexedFeatures", maxCategories=max_categories, handleInvalid="keep"
    )


def scale_to_unit_deviation(df: DataFrame, source: str = "features", output: str = "scaled") -> tuple[StandardScalerModel, DataFrame]:
    """Divide by the sample standard deviation; means are not moved."""
    model = StandardScaler(inputCol=source, outputCol=output, withStd=True, withMean=False).fit(df)
    return model, model.transform(df)


def split_bound(share: float = TRAIN_SHARE) -> str:
    """The share as eight hexadecimal digits: digests below it are on the training side."""
    if not 0 < share < 1:
        raise ValueError(f"share must be between 0 and 1, got {share}")
    return f"{int(share * 2**32):08x}"


def in_train(key: Column, share: float = TRAIN_SHARE, seed: int = SEED) -> Column:
    """True for the rows of the training part.

    The side depends on a digest of the row's key alone, so a recomputed task
    puts every row where it was before, and other engines can tell the sides too.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    return F.substring(digest, 1, 8) < F.lit(split_bound(share))


def split(df: DataFrame, key: str = "date", share: float = TRAIN_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Training and holdout part."""
    train = in_train(qcol(key), share, seed)
    return df.filter(train), df.filter(~train)
