"""A training corpus from raw documents: each stage works on all that the one before kept."""

from __future__ import annotations

from loomwork.llm import decontaminate, mixing, quality_rules, token_files
from loomwork.llm import near_copies as copies
from loomwork.llm.queries import TOKENIZER
from loomwork.llm.texts import bound_batches
from loomwork.storage import cut_lineage, release_shuffles


def _begin(spark):
    """Bounds batches of texts, and lets go of what the stage before has moved."""
    bound_batches(spark)
    release_shuffles(spark)


def quality(spark, docs, sf_dir):
    """Lines that fail a rule go, and documents that lose too much or are too short or repetitive.

    Null or empty texts have too few words and go; of repeated rows each is judged alike.
    """
    _begin(spark)
    return quality_rules.clean(docs)


def near_copies(spark, docs, sf_dir):
    """One document of each group stays: near copies share four fifths or more of their five-word
    shingles, and groups are what links between them connect.

    SimHash fingerprints and vantage-point trees retrieve pairs, and MinHash bands those that differ
    more.  The smallest id stays, null ids last; see ``drop_near_copies`` for ties and repeated rows.
    """
    _begin(spark)
    return copies.drop_near_copies(docs)


def benchmark(spark, docs, sf_dir):
    """Documents that hold too much of the benchmark go; an empty benchmark takes none."""
    _begin(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark, docs, sf_dir):
    """Whole and partial repetitions of documents, so that sources meet their targets.

    Null sources are a source of their own; rows with equal ids and texts take any order.
    """
    _begin(spark)
    return mixing.sample(docs)


def tokens(spark, docs, sf_dir):
    """Token files, and from them each document's place, number of tokens and check sum.

    Null ids come first; a null text has the end token only.
    """
    _begin(spark)
    read = token_files.round_trip(docs, TOKENIZER)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality_rules", quality),
    ("near_copies", near_copies),
    ("decontaminate", benchmark),
    ("mix", mix),
    ("token_files", tokens),
]


def run(spark, sf_dir):
    """All stages over ``documents``, each result written and read again; no documents give no rows.

    Columns beside those of ``documents`` go through all stages but the last as they are.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# SQL has neither XXH64 nor the tokenizer; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES = {}
