"""Feature columns for the two classification data sets."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Feature order, flag letters and levels, and the stand-in for a missing age.
CABIN_LETTERS = ("A", "B", "C", "D", "E", "F", "T", "G")
PORTS = ("S", "C", "Q")
MISSING_AGE = 45.0
PASSENGER_FEATURES = (
    "isMan", "age", "noAge", "hasHelper", "hasDependent", "dependentCount", "hasFamily",
    "inUnknownCabin", "moreThanOneCabin",
    *(f"isCabin{c}" for c in CABIN_LETTERS),
    *(f"isEmbark{c}" for c in PORTS),
    "pClass", "fare",
)
OUTLOOKS = ("sunny", "rainy", "overcast")
TEMPERATURES = ("hot", "mild", "cool")
HUMIDITIES = ("high", "normal")
WEATHER_FEATURES = (
    *(f"outlook_{v}" for v in OUTLOOKS),
    "temp",
    *(f"temp_{v}" for v in TEMPERATURES),
    *(f"humidity_{v}" for v in HUMIDITIES),
    "windy",
)


def flag(condition: Column) -> Column:
    """1.0 where the condition holds, 0.0 where it does not or is null."""
    return F.when(condition, 1.0).otherwise(0.0)


def passenger_features(df: DataFrame) -> DataFrame:
    """Add the passenger features from ``sex, age, sibSp, parch, cabin, embarked, pclass, fare``."""
    age = F.col("age").try_cast("double")
    siblings, dependents = F.col("sibSp").try_cast("double"), F.col("parch").try_cast("double")
    cabin = F.col("cabin")
    columns = {
        "isMan": flag(F.col("sex") == "male"),
        "age": F.coalesce(age, F.lit(MISSING_AGE)),
        "noAge": flag(age.isNull()),
        "hasHelper": flag(siblings > 0),
        "hasDependent": flag(dependents > 0),
        "dependentCount": dependents,
        "hasFamily": flag(siblings + dependents > 0),
        "inUnknownCabin": flag(cabin.isNull() | (cabin == "")),
        "moreThanOneCabin": flag(cabin.contains(" ")),
        **{f"isCabin{c}": flag(cabin.contains(c)) for c in CABIN_LETTERS},
        **{f"isEmbark{c}": flag(F.col("embarked") == c) for c in PORTS},
        "pClass": F.col("pclass").try_cast("double"),
        "fare": F.col("fare").try_cast("double"),
    }
    given = {"age", "fare", "pclass", "sex", "sibSp", "parch", "cabin", "embarked"}
    kept = [c for c in df.columns if c not in given]
    return df.select(*kept, *[columns[name].alias(name) for name in PASSENGER_FEATURES])


def weather_features(df: DataFrame) -> DataFrame:
    """Add the weather features and ``label`` from the declared weather columns."""
    columns = {
        **{f"outlook_{v}": flag(F.col("outlook") == v) for v in OUTLOOKS},
        "temp": F.col("temp").try_cast("double"),
        **{f"temp_{v}": flag(F.col("tempEnum") == v) for v in TEMPERATURES},
        **{f"humidity_{v}": flag(F.col("humidityEnum") == v) for v in HUMIDITIES},
        "windy": flag(F.col("windyFlag").try_cast("boolean")),
    }
    given = {"outlook", "temp", "tempEnum", "humidity", "humidityEnum", "windyFlag", "playFlag"}
    kept = [c for c in df.columns if c not in given]
    return df.select(
        *kept,
        *[columns[name].alias(name) for name in WEATHER_FEATURES],
        flag(F.col("playFlag") == "yes").alias("label"),
    )


def with_vector(
    df: DataFrame, features: tuple[str, ...], keep: tuple[str, ...], fill: float | None = None
) -> DataFrame:
    """``keep`` columns and a ``features`` vector of every row.

    A missing number is an error when the rows are read, unless ``fill`` gives
    what stands in for it; then each feature gets another behind all of them
    that is 1 where it was missing.
    """
    columns = list(features)
    if fill is not None:
        missing = {f"{c}_missing": flag(F.col(c).isNull()) for c in features}
        df = df.withColumns(missing).withColumns({c: F.coalesce(F.col(c), F.lit(fill)) for c in features})
        columns += list(missing)
    assembler = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="error")
    return assembler.transform(df).select(*keep, "features")
