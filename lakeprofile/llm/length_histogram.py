"""Token counts from an exact histogram of encoded lengths.

Each whole text is encoded once; documents are counted by encoded length, summed
in the map tasks first.  With the histogram in hand, sums from the long end
answer for *every* context limit at once how many documents are longer, how many
tokens they hold, how many tokens stay when each document is cut at the limit,
and which quantile the limit is.  Lengths are dealt by ``length div width``;
sums inside such a class and the totals of the classes above it make the suffix
sums, so no task needs the whole histogram.

Null text counts as empty and has length 0; an empty table gives an empty
histogram.  Only ``text`` is read; ids, equal rows and other columns do not
matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import small_batches, whole


@lru_cache(maxsize=2)
def byte_encoding(path: str):
    """The ranks of a .tiktoken file as an encoding; read once per worker."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoded_lengths(docs: DataFrame, tokenizer: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """``length`` of every document in tokens."""
    small_batches(docs.sparkSession)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = byte_encoding(vocabulary(tokenizer))
        for batch in batches:
            n = [len(encoding.encode_ordinary(text.as_py())) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], ["length"])

    return docs.select(whole("text").alias("text")).mapInArrow(lengths, "length long")


def length_histogram(docs: DataFrame, tokenizer: str = "byte_bpe_50k.tiktoken", width: int = 1024) -> DataFrame:
    """One row per encoded length, read as a context limit.

    ``n_docs``, ``n_tokens`` of that length; ``docs_longer``, ``tokens_longer``
    beyond it; ``truncated_tokens``: tokens left when all documents are cut at
    it; ``share``: part of the documents that fit.
    """
    counts = cut_lineage(encoded_lengths(docs, tokenizer).groupBy("length").agg(F.count(F.lit(1)).alias("n_docs")))
    rows = counts.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"), F.floor(F.col("length") / width).alias("_class"))
    classes = rows.groupBy("_class").agg(F.sum("n_docs").alias("_docs"), F.sum("n_tokens").alias("_tokens"))
    above = Window.orderBy(F.desc("_class")).rowsBetween(Window.unboundedPreceding, -1)  # as many rows as the longest text has ``width``s
    offsets = classes.select("_class", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("_docs", "_tokens")])
    longer = Window.partitionBy("_class").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    total = counts.agg(F.sum("n_docs").alias("n")).scalar()
    docs_longer = F.coalesce(F.sum("n_docs").over(longer), F.lit(0)) + F.col("_docs_above")
    tokens_longer = F.coalesce(F.sum("n_tokens").over(longer), F.lit(0)) + F.col("_tokens_above")
    joined = rows.join(offsets, "_class").select("length", "n_docs", "n_tokens", docs_longer.alias("docs_longer"), tokens_longer.alias("tokens_longer"))
    all_tokens = counts.agg(F.sum(F.col("length") * F.col("n_docs")).alias("n")).scalar()
    return joined.select("*", (all_tokens - F.col("tokens_longer") + F.col("docs_longer") * F.col("length")).alias("truncated_tokens"), ((total - F.col("docs_longer")) / total).alias("share"))


def quantile(histogram: DataFrame, part: float) -> DataFrame:
    """Least length that ``part`` of the documents do not exceed."""
    return histogram.where(F.col("share") >= part).agg(F.min("length").alias("length"))


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """Tokens left when every document is cut at ``limit``, whether or not a document has that length."""
    kept = F.when(F.col("length") <= limit, F.col("n_tokens")).otherwise(F.col("n_docs") * limit)
    return histogram.agg(F.coalesce(F.sum(kept), F.lit(0)).alias("tokens"))
