"""Documents packed into training sequences of bounded size by vector best-fit.

Every whole text is encoded once and ends with the end id.  A document longer
than a sequence is cut into pieces of exactly one sequence's length (the last may
be shorter); no other is cut.  A piece takes three things from the sequence that
holds it: its tokens, one place among the documents, and its attention cost (the
square of its length).  A sequence has a capacity for each, and a piece fits only
where all three suffice.  Among the sequences it fits, a piece takes

* ``rule="norm"``: the one whose residual capacities, once it is in, have the
  least weighted norm (best fit: the tightest one);
* ``rule="dot"``: the one whose residual capacities have the largest weighted dot
  product with what the piece needs (the one most like it in shape).

All amounts are shares of their capacity; larger pieces go first; of equal
sequences the older one is taken; where none fits, a new one is opened.

Pieces are dealt by a hash to groups of about ``group_pieces``, each packed in one
task.  The sequences a group fills least (below ``closed``) are opened again and
their pieces, at most one in ``fan_in`` of the group's, packed together with those
of other groups, round after round, until one group holds what is left.  So no
task sees more than a group, and the loss to groups is the last round's.

The capacities for documents and attention default to what a full sequence can
hold at most, so they bind only when lowered; a piece that needs more than a whole
capacity on its own is an error, as no sequence could take it.

Null text counts as empty and gives one piece, the end id; null and repeated ids
are rows like all others; other columns are not read; an empty table gives no
pieces.  Very long texts are encoded whole, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import doc_rows, small_batches
from .repair_tokens import text_ids, word_tokenizer

END_ID = 1
KEPT_PIECES = 200_000  # encoded pieces a worker remembers from one run of texts to the next, about 100 MB; only speed depends on it
PIECES = "key long, doc_id long, piece int, start long, length long, ids binary"
PLACED = "key long, length long, sequence_id long, offset long, open boolean"


def write_pieces(docs: DataFrame, path: str, tokens: int = 4096, tokenizer: str = "word_bpe_49k.json", end_id: int = END_ID) -> None:
    """Encode all documents and write their pieces; ``ids`` are little-endian unsigned 32-bit integers.

    ``key`` numbers the pieces: the writing task above, its own count below.  The
    table is written once and read from then on, so the numbers do not change.
    """
    small_batches(docs.sparkSession)
    width = 4 * tokens

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        end = np.uint32(end_id).astype("<u4").tobytes()
        for batch in batches:
            sizes = np.asarray(pc.binary_length(batch.column(1)), dtype=np.int64)
            part = (np.cumsum(sizes) - sizes) >> 22  # about 4 MB of text at a time
            edges = np.flatnonzero(np.r_[True, np.diff(part) > 0, True])
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                found, count = text_ids(batch.column(1).slice(low, high - low), tokenizer)
                known = word_tokenizer(tokenizer)[2]
                if len(known) > KEPT_PIECES:
                    known.clear()
                data, ends = memoryview(found.astype("<u4").tobytes()), 4 * np.cumsum(count)
                keys, doc_ids, pieces, starts, lengths, ids = [], [], [], [], [], []
                for doc, stop, n in zip(batch.column(0).slice(low, high - low).to_pylist(), ends.tolist(), count.tolist(), strict=True):
                    whole = bytes(data[stop - 4 * n : stop]) + end
                    for i, at in enumerate(range(0, len(whole), width)):
                        ids.append(whole[at : at + width])
                        keys.append(number)
                        doc_ids.append(doc)
                        pieces.append(i)
                        starts.append(at // 4)
                        lengths.append(len(ids[-1]) // 4)
                        number += 1
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                columns = [pa.array(v, t) for v, t in zip([keys, doc_ids, pieces, starts, lengths, ids], kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in PIECES.split(", ")])

    rows = doc_rows(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows.mapInArrow(encode, PIECES).write.mode("errorifexists").parquet(path)


def best_fit(lengths: np.ndarray, capacity: Sequence[float], weights: Sequence[float], rule: str) -> np.ndarray:
    """Sequence number of each piece; ``lengths`` descend."""
    lengths = np.asarray(lengths, np.int64)
    needs = np.stack([lengths, np.ones_like(lengths), lengths * lengths], axis=1)  # whole numbers: capacities are exact
    limit, scale = np.floor(np.asarray(capacity, np.float64)).astype(np.int64), np.asarray(weights, np.float64) / np.square(np.asarray(capacity, np.float64))
    if len(needs) and (needs > limit).any():
        raise ValueError("a piece needs more than a sequence can hold")
    left = np.empty((len(lengths), 3), np.int64)
    number = np.arange(len(lengths))  # of the bins that still take something
    used = opened = 0
    out = np.empty(len(lengths), np.int64)
    smallest = needs[-1] if len(needs) else None
    for i, need in enumerate(needs):
        rest = left[:used] - need
        fits = np.flatnonzero((rest >= 0).all(axis=1))
        if len(fits):
            if rule == "dot":
                at = int(fits[np.argmax(left[fits] @ (scale * need))])
            else:
                at = int(fits[np.argmin(np.square(rest[fits].astype(np.float64)) @ scale)])
        else:
            at, left[used], number[used] = used, limit, opened
            used, opened = used + 1, opened + 1
        left[at] -= need
        out[i] = number[at]
        if (left[at] < smallest).any():  # nothing else will fit: later pieces are no smaller than the last
            left[at : used - 1] = left[at + 1 : used]
            number[at : used - 1] = number[at + 1 : used]
            used -= 1
    return out


def place(
    pieces: DataFrame, tokens: int = 4096, documents: int | None = None, attention: float | None = None, weights: Sequence[float] = (1.0, 0.01, 0.01),
    rule: str = "norm", group_pieces: int = 2048, fan_in: int = 16, closed: float = 0.995,
) -> DataFrame:
    """``sequence_id`` and ``offset`` of every row of ``key`` and ``length``, which must be on disk."""
    if rule not in ("norm", "dot"):
        raise ValueError(rule)
    capacity = (tokens, documents or tokens, attention or float(tokens) ** 2)

    def packed(level: int, last: bool):
        def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values(["length", "key"], ascending=[False, True]).reset_index(drop=True)
            length = frame["length"].to_numpy(np.int64)
            bins = best_fit(length, capacity, weights, rule)
            order = np.argsort(bins, kind="stable")
            ends = np.cumsum(length[order])
            first = np.flatnonzero(np.r_[True, np.diff(bins[order]) > 0])
            per_bin = np.diff(np.r_[first, len(order)])
            offset = np.empty(len(order), np.int64)
            offset[order] = ends - length[order] - np.repeat((ends - length[order])[first], per_bin)
            again = np.zeros(len(per_bin), bool)
            if not last:  # least filled first, while their pieces are few enough
                full = np.bincount(bins, weights=length)
                poor = np.argsort(full, kind="stable")
                poor = poor[(full[poor] < closed * tokens) & (np.cumsum(per_bin[poor]) <= max(1, group_pieces // fan_in))]
                again[poor] = True
            return pd.DataFrame({"key": frame["key"], "length": length, "sequence_id": (level << 58) + (int(key[0]) << 20) + bins, "offset": offset, "open": again[bins]})

        return run

    rows, level, done = pieces.select("key", "length"), 0, []
    groups = max(1, ceil(rows.count() / group_pieces))
    while True:
        dealt = rows.withColumn("_group", F.pmod(F.xxhash64("key", F.lit(level)), F.lit(groups)))
        met = cut_lineage(dealt.groupBy("_group").applyInPandas(packed(level, groups == 1), PLACED))
        done.append(met.where("not open"))
        if groups == 1:
            break
        rows, level, groups = met.where("open"), level + 1, ceil(groups / fan_in)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("key", "sequence_id", "offset")


def pack(docs: DataFrame, path: str, tokens: int = 4096, tokenizer: str = "word_bpe_49k.json", end_id: int = END_ID, **settings: object) -> None:
    """Write ``pieces`` (with their ids) and ``places`` below ``path``; ``settings`` as of ``place``."""
    spark = docs.sparkSession
    write_pieces(docs, f"{path}/pieces", tokens, tokenizer, end_id)
    placed = place(spark.read.schema(PIECES).parquet(f"{path}/pieces"), tokens, **settings)
    placed.write.mode("errorifexists").parquet(f"{path}/places")


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Every stored piece with its sequence and its offset there; keys are unique on both sides of the join."""
    pieces = spark.read.schema(PIECES).parquet(f"{path}/pieces").withColumn("ids_crc32", F.crc32("ids"))
    places = spark.read.schema("key long, sequence_id long, offset long").parquet(f"{path}/places")
    return pieces.join(places, "key").drop("key")


def sequences(spark: SparkSession, path: str) -> DataFrame:
    """One row per sequence: its ids end to end, and where each document in it begins."""
    rows = read_pieces(spark, path).select("sequence_id", F.struct("offset", "doc_id", "piece", "ids").alias("p"))
    grouped = rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list("p")).alias("p"))  # at most as many as a sequence has tokens
    joined = F.aggregate("p", F.lit(b""), lambda found, p: F.concat(found, p["ids"]))
    return grouped.select("sequence_id", joined.alias("ids"), F.transform("p", lambda p: p["offset"]).alias("offsets"), F.transform("p", lambda p: p["doc_id"]).alias("doc_ids"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
