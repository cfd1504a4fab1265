"""Running counts and sums over streams."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.parse import explode_tokens
from ..storage import use_rocksdb
from .tables import ResultTable

# executors get the functions below with the plan and need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def word_counts(lines: DataFrame, column: str = "value", lower: bool = True) -> DataFrame:
    """Running ``(word, n)`` counts; counts are combined before the shuffle."""
    return explode_tokens(lines, column, lower).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def batch_word_counts(lines: DataFrame, column: str = "value") -> ResultTable:
    """Word counts of each micro-batch alone, with its ``batch_id``."""

    def count(batch: DataFrame) -> DataFrame:
        return word_counts(batch, column)

    return ResultTable(lines, "append", transform=count)


def _combine(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        counts = pdf["word"].value_counts()
        yield pd.DataFrame({"word": counts.index, "n": counts.to_numpy()})


class _Counts(StatefulProcessor):
    """A count for each word of a bucket, each a value of its own in state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "word string", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh: dict[str, int] = {}
        for pdf in rows:
            for word, n in zip(pdf["word"].tolist(), pdf["n"].tolist()):
                fresh[word] = fresh.get(word, 0) + n
        out = []
        for word, n in fresh.items():
            known = self.counts.getValue((word,)) if self.counts.containsKey((word,)) else None
            total = n + (known[0] if known else 0)
            self.counts.updateValue((word,), (total,))
            out.append((word, total))
        yield pd.DataFrame(out, columns=["word", "n"], dtype=object)

    def close(self) -> None:
        pass


def word_counts_by_state(lines: DataFrame, column: str = "value", buckets: int = 1024) -> DataFrame:
    """Running counts by explicit keyed state that never expires, for update mode.

    Each Arrow batch is combined to counts before the shuffle, so a frequent
    word reaches its state as a few rows.  ``buckets`` says how many calls a batch
    is at most, as words of one bucket share a call; each word has a value of its
    own in state, and only those of words that came are written.  Such state needs RocksDB,
    which the session is told to use.
    """
    use_rocksdb(lines.sparkSession)
    words = explode_tokens(lines, column).mapInPandas(_combine, "word string, n long")
    bucket = F.pmod(F.xxhash64("word"), F.lit(buckets))
    return words.withColumn("bucket", bucket).groupBy("bucket").transformWithStateInPandas(
        _Counts(), "word string, n long", "Update", "None"
    )


def exact_sum(price: str) -> Column:
    """The sum of prices as decimals of nine places, as a double: the same in whatever order rows come."""
    return F.sum(F.col(price).cast("decimal(28,9)")).cast("double")


def ticker_sums(messages: DataFrame) -> DataFrame:
    """Running sum and average of price by ticker and receiver."""
    total = exact_sum("price")
    return messages.groupBy("ticker", "destUser").agg(
        total.alias("total_price"), (total / F.count("price")).alias("avg_price")
    )


def entity_counts(rows: DataFrame, keys: list[str], prefix: str) -> dict[str, ResultTable]:
    """One live count table per key column, each polled by SQL as view ``prefix_key``."""
    return {
        key: ResultTable(
            rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "complete", name=f"{prefix}_{key}"
        )
        for key in keys
    }
