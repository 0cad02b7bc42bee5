"""SimHash near-duplicates found in the space of segment bit counts.

Fingerprint: a bit is 1 if it is set in over half of the 64-bit digests of all
word shingles of the whole text.

Join: a fingerprint is embedded as the vector of its bit counts over two-bit
segments.  The Manhattan distance of two vectors never exceeds the number of
differing bits, so all linked fingerprints lie within ``max_bits`` of each other
there.  The axes are dealt into ``blocks``; points that close agree on at least
``blocks - max_bits`` whole blocks, so filing every point under the grid cells
of all such block choices (coordinates are whole numbers, cells of side one)
brings every close pair into a common cell.  Inside a cell the Manhattan
distance is checked first, then the bits themselves.

Copies: equal fingerprints are one point.  In a cell, a walk that starts at one
point and takes away all points it links reports a spanning forest instead of
all pairs, so a dense group costs little more than its size; the union over the
cells has the same components as the full graph.  Cells with more than
``cell_rows`` points are dealt by blocks of points, every two blocks meeting in a
task of their own, so no task holds an unbounded cell.

Null text counts as empty; texts without words have fingerprint 0 and link to
each other; a null ``doc_id`` gets the least id of its component, null if it has
none; equal rows are copies; an empty table gives an empty result.  Only
``doc_id`` and ``text`` are read.  What stays is one row per component, also where
ids are null or shared by different texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from ..session import cut_lineage, ship_package
from .common import doc_rows, shuffle_tasks, small_batches, split_words, text_key, whole
from .components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shingle_digests(words: Column, shingle: int) -> Column:
    """64-bit digests (seed 42) of all shingles in order, repeats included."""
    n = F.size(words)
    many = F.transform(F.sequence(F.lit(0), n - shingle), lambda i: F.xxhash64(F.concat_ws(" ", *[words[i + k] for k in range(shingle)])))
    few = F.array(F.xxhash64(F.array_join(words, " ")))
    return F.when(n >= shingle, many).when(n > 0, few).otherwise(F.array().cast("array<bigint>"))


def majority(digests: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive groups of digests, by counting byte values."""
    n, sizes = len(offsets) - 1, np.diff(offsets)
    owner = np.repeat(np.arange(n, dtype=np.int64) * 256, sizes)
    digests = digests.view(np.uint64)
    bits = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)
    out = np.zeros(n, dtype=np.uint64)
    for byte in range(8):
        value = ((digests >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64)
        counts = np.bincount(owner + value, minlength=n * 256).reshape(n, 256) @ bits
        set_bits = (2 * counts > sizes[:, None]).astype(np.uint64) << np.arange(8, dtype=np.uint64)
        out |= set_bits.sum(axis=1, dtype=np.uint64) << np.uint64(8 * byte)
    return out


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id``, ``_key`` (digest of the text) and 64-bit ``fingerprint`` (as a signed long) of every whole text."""
    small_batches(docs.sparkSession)
    words = doc_rows(docs).select("doc_id", text_key(F.col("text")).alias("_key"), split_words(F.translate("text", UPPER, LOWER)).alias("words"))
    kind = words.schema["doc_id"].dataType.simpleString()

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            offsets = np.asarray(lists.offsets, dtype=np.int64)
            values = np.asarray(lists.values, dtype=np.int64)[offsets[0] : offsets[-1]]
            prints = []
            step = 2_000  # documents per counting table
            for a in range(0, len(lists), step):
                part = offsets[a : a + step + 1]
                prints.append(majority(values[part[0] - offsets[0] : part[-1] - offsets[0]], part - part[0]))
            joined = np.concatenate(prints) if prints else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(joined.view(np.int64))], ["doc_id", "_key", "fingerprint"])

    digests = words.select("doc_id", "_key", shingle_digests(F.col("words"), shingle).alias("digests"))
    return digests.mapInArrow(vote, f"doc_id {kind}, _key long, fingerprint long")


def cells(fingerprint: Column, blocks: int, max_bits: int) -> tuple[Column, Column]:
    """Coordinates of the embedded point, one number per block, and the grid cells of each choice of ``blocks - max_bits``
    of them, as digests of the array ``_blocks``."""
    edges = [64 * b // blocks for b in range(blocks + 1)]
    place = []
    for low, high in zip(edges, edges[1:], strict=False):
        code = F.lit(0).cast("long")
        for at in range(low, high, 2):
            width = min(2, high - at)
            count = F.bit_count(F.shiftrightunsigned(fingerprint, at).bitwiseAND(F.lit(2**width - 1).cast("long")))
            code = code * (width + 1) + count
        place.append(code)
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - max_bits)):
        keys.append(F.xxhash64(F.lit(number), *[F.col("_blocks")[b] for b in chosen]))
    return F.array(*place), F.array(*keys)


def links_in_cell(points: np.ndarray, counts: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the points (distinct, uint64) of one cell; ``counts``: their bit counts per byte."""
    out: list[tuple[int, int]] = []
    left = np.arange(len(points))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            i = queue.pop()
            near = np.abs(counts[left] - counts[i]).sum(axis=1) <= max_bits  # Manhattan distance, a lower bound
            near[near] = np.bitwise_count(points[left[near]] ^ points[i]) <= max_bits
            taken = left[near]
            out.extend((int(i), int(j)) for j in taken)
            queue.extend(taken)
            left = left[~near]
    return out


def links(points: DataFrame, max_bits: int = 4, blocks: int = 7, cell_rows: int = 4096) -> DataFrame:
    """Edges (u, v) between distinct fingerprints whose graph has the components of the full graph of links."""
    spark = points.sparkSession
    ship_package(spark)
    place, keys = cells(F.col("fingerprint"), blocks, max_bits)
    filed = points.select("fingerprint", place.alias("_blocks")).select("fingerprint", F.explode(keys).alias("cell"))
    large = filed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell_rows)
    parts = F.coalesce(F.ceil(F.col("n") / cell_rows), F.lit(1)).cast("int")
    dealt = filed.join(large, "cell", "left").select("cell", "fingerprint", parts.alias("parts"))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    met = dealt.select("cell", "fingerprint", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    pairs = met.select("cell", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "fingerprint")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def search(key: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
            size = np.diff(np.r_[start, len(key)])
            points = prints.view(np.uint64)
            us, vs = [], []
            two = start[size == 2]  # most cells with company hold two
            if len(two):
                a, b = points[two], points[two + 1]
                near = np.abs(byte_counts(a) - byte_counts(b)).sum(axis=1) <= max_bits
                near &= np.bitwise_count(a ^ b) <= max_bits
                us.append(prints[two[near]])
                vs.append(prints[two[near] + 1])
            for s, n in zip(start[size > 2], size[size > 2], strict=True):
                found = links_in_cell(points[s : s + n], byte_counts(points[s : s + n]), max_bits)
                if found:
                    ends = np.array(found) + s
                    us.append(prints[ends[:, 0]])
                    vs.append(prints[ends[:, 1]])
            u = np.concatenate(us) if us else np.zeros(0, np.int64)
            v = np.concatenate(vs) if vs else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], ["u", "v"])

        for batch in batches:
            key = np.stack([np.asarray(batch.column(i)).astype(np.int64) for i in range(3)], axis=1)
            prints = np.asarray(batch.column(3)).astype(np.int64)
            if rest is not None:
                key, prints = np.concatenate([rest[0], key]), np.concatenate([rest[1], prints])
            same = (key == key[-1]).all(axis=1)
            cut = len(key) - int(np.argmin(same[::-1])) if not same.all() else 0  # the last cell may go on
            rest = (key[cut:], prints[cut:])
            if cut:
                yield search(key[:cut], prints[:cut])
        if rest is not None and len(rest[0]):
            yield search(*rest)

    tasks = shuffle_tasks(spark)
    grouped = pairs.repartition(tasks, "cell", "p", "q").sortWithinPartitions("cell", "p", "q", "fingerprint")
    return grouped.mapInArrow(walk, "u long, v long").distinct()


def byte_counts(points: np.ndarray) -> np.ndarray:
    """Bit counts of the eight bytes of every point."""
    return np.bitwise_count(points.view(np.uint8).reshape(len(points), 8)).astype(np.int8)


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, blocks: int = 7, cell_rows: int = 4096) -> DataFrame:
    """``doc_id``, ``_key`` (digest of the text), ``fingerprint`` (long), ``root`` (least linked fingerprint), ``component_id`` (least
    linked id) and ``copies`` (rows with the fingerprint)."""
    prints = cut_lineage(fingerprints(docs, shingle))
    points = cut_lineage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")))
    found = components(links(points.select("fingerprint"), max_bits, blocks, cell_rows)).withColumnRenamed("node", "fingerprint")
    joined = points.join(found, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    grouped = cut_lineage(joined)
    roots = cut_lineage(grouped.groupBy("root").agg(F.min("first_id").alias("component_id")))
    classes = grouped.join(roots, "root").select("fingerprint", "root", "component_id", "copies")
    return lookup_join(prints, cut_lineage(classes), "fingerprint", spread=["doc_id", "_key"])


def keep_one(docs: DataFrame, **settings: int) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id (nulls last) and text digest; all columns."""
    found = near_duplicates(docs, **settings)
    least = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key")).alias("s"))
    stays = least.select(F.col("s.doc_id").alias("_doc"), F.col("s._key").alias("_text_key"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_id"), text_key(whole("text")).alias("_key"))
    left = rows.join(stays, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_text_key")), "left_semi")
    order = Window.partitionBy("_id", "_key").orderBy(F.to_json("_row"))  # rows that differ in other columns only
    return left.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("_row.*")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
