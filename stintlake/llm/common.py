"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def small_batches(spark: SparkSession, rows: int = 256, megabytes: int = 8) -> None:
    """Bound the Arrow batches of this session: texts are whole, so a batch of the default 10,000 rows has no useful bound."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as it takes for no column of ``df`` to begin with it."""
    while any(c.lower().startswith(name) for c in df.columns):
        name += "_"
    return name


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: Column | str, folds: int = 5) -> Column:
    """crc32 of the key written as text, modulo ``folds``; null keys are in no fold."""
    return F.crc32(F.encode(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), "UTF-8")) % folds


def held_out(key: Column | str) -> Column:
    """Whether a row belongs to the part that nothing is learnt from; a null key does, as nothing may be learnt from it."""
    return F.coalesce(fold(key) == 0, F.lit(True))


def bpe_path() -> str:
    """The byte-level BPE tokenizer file of the public tokenizers on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_path() -> str:
    """The piece vocabulary file of the public tokenizers on this machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
