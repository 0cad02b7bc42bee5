"""Token ids as grammar-compressed files with random access.

``write_tokens`` encodes every whole text, appends the end id, and writes the ids
in ascending order of ``doc_id``: the range of ids is dealt to shards, a shard is
a run of blocks of about ``block_tokens`` ids (whole documents), and each block is
compressed by replacing frequent pairs of neighbouring symbols by a new symbol,
again and again.  A block holds

* ``rules``: the pair behind every new symbol; ``lengths``: how many ids it
  stands for, so positions are found without expanding anything;
* ``symbols``: what is left of the sequence; ``marks``: the id position of every
  ``MARK``-th symbol, where decoding can begin;
* ``doc_ids`` and ``doc_tokens`` in order, and ``first_token`` in its shard.

The files are Parquet, written by Spark with its commit protocol, so a lost
executor leaves no half a shard.  ``read_tokens`` decodes them again.

A text is cut at blanks and after Latin letters before a mark, where the
tokenizer's own rules end a piece in any case; different pieces are encoded once
per batch by the library and put together by position.

Null text counts as empty (the end id alone); null ids come first; rows with the
same id follow in the order of their texts; an empty table gives no blocks and an
empty result.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import doc_rows, shuffle_tasks, small_batches, text_key

END_ID = 2
MARK = 1024
LETTER_MARK = r"([a-zA-ZÀ-ÖØ-öø-ÿ])([.,!?;:#$%&*()])"
SEPARATOR = "\x01"  # no blank, no letter: a piece of its own, one id
CACHED_PIECES = 400_000  # of a worker, about 80 MB; only speed depends on it

BLOCK = (
    "shard int, block int, first_token long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
    "rules binary, lengths binary, symbols binary, wide boolean, marks binary"
)


@lru_cache(maxsize=2)
def word_tokenizer(name: str):
    """The tokenizer, the id of the separator, and the ids of pieces seen so far in this worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many workers as there are cores
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    (separator,) = tokenizer.encode(SEPARATOR, add_special_tokens=False).ids
    return tokenizer, separator, {}


def piece_ids(pieces: list[str], name: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of different pieces without blanks, end to end, and how many each has."""
    tokenizer, separator, known = word_tokenizer(name)
    found = list(map(known.get, pieces))
    fresh = [i for i, ids in enumerate(found) if ids is None]
    plain = []
    for i in fresh:
        if SEPARATOR in pieces[i]:
            found[i] = np.array(tokenizer.encode(pieces[i], add_special_tokens=False).ids, np.uint32).tobytes()
        else:
            plain.append(i)
    for at in range(0, len(plain), 20_000):
        part = plain[at : at + 20_000]
        lines = [f" {SEPARATOR} ".join([pieces[i] for i in part[k : k + 50]]) + f" {SEPARATOR}" for k in range(0, len(part), 50)]
        encoded = tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.array(list(chain.from_iterable(e.ids for e in encoded)), np.uint32)
        data, low = ids.tobytes(), 0
        for i, end in zip(part, (4 * np.flatnonzero(ids == separator)).tolist(), strict=True):
            found[i] = data[low:end]
            low = end + 4
    if len(known) < CACHED_PIECES:
        known.update((pieces[i], found[i]) for i in fresh)
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    return np.frombuffer(b"".join(found), np.uint32), sizes


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``values[s : s + n]`` of all (s, n), end to end."""
    total = np.cumsum(sizes)
    if not len(total) or not total[-1]:
        return values[:0]
    steps = np.ones(total[-1], np.int64)
    full = sizes > 0
    begin, first = (total - sizes)[full], starts[full]
    steps[begin] = np.r_[first[0], first[1:] - (first[:-1] + sizes[full][:-1] - 1)]
    return values[np.cumsum(steps)]


def text_ids(texts: pa.Array, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, and the number of ids of each."""
    split = pc.ascii_split_whitespace(texts)
    per_text = np.diff(np.asarray(split.offsets, dtype=np.int64))
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary
    if not len(words):
        return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
    # the tokenizer's special tokens ("<|endoftext|>") are matched before it lower-cases
    same = pc.and_(pc.string_is_ascii(words), pc.invert(pc.match_substring(words, "<|")))
    lowered = pc.if_else(same, pc.ascii_lower(words), words)
    cut = pc.ascii_split_whitespace(pc.replace_substring_regex(lowered, LETTER_MARK, r"\1 \2"))
    pieces = cut.flatten().dictionary_encode()
    ids, sizes = piece_ids(pieces.dictionary.to_pylist(), name)
    starts = np.cumsum(sizes) - sizes
    which = np.asarray(pieces.indices)
    word_ids = gather(ids, starts[which], sizes[which])
    # ids per word: sums over its pieces
    piece_ends = np.r_[0, np.cumsum(sizes[which])]
    bounds = np.asarray(cut.offsets, dtype=np.int64)
    word_sizes = piece_ends[bounds[1:]] - piece_ends[bounds[:-1]]
    word_starts = np.cumsum(word_sizes) - word_sizes
    codes = np.asarray(coded.indices)
    all_ids = gather(word_ids, word_starts[codes], word_sizes[codes])
    ends = np.r_[0, np.cumsum(word_sizes[codes])]
    text_ends = np.r_[0, np.cumsum(per_text)]
    return all_ids, ends[text_ends[1:]] - ends[text_ends[:-1]]


def compress(ids: np.ndarray, rounds: int, pairs: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Symbols, rules, expansion lengths and the first new symbol of a run of ids."""
    first = int(ids.max()) + 1 if len(ids) else 0
    symbols, rules, lengths = ids.astype(np.int64), np.zeros((0, 2), np.int64), np.ones(0, np.int64)
    bins = 1 << 18
    for _ in range(rounds):
        if len(symbols) < 2:
            break
        left, right = symbols[:-1], symbols[1:]
        slot = (left * 0x9E3779B1 + right * 0x85EBCA6B) & (bins - 1)
        hot = np.bincount(slot, minlength=bins) >= least
        at = np.flatnonzero(hot[slot])
        base = first + len(rules)
        keys = left[at] * base + right[at]
        found, back, counts = np.unique(keys, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")[:pairs]
        order = order[counts[order] >= least]
        if not len(order):
            break
        number = np.full(len(found), -1)
        number[order] = np.arange(len(order))
        new = number[back]
        at, new = at[new >= 0], new[new >= 0]
        # of places that overlap in a run, every second one stays
        run = np.flatnonzero(np.r_[True, np.diff(at) > 1])
        inside = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
        at, new = at[inside % 2 == 0], new[inside % 2 == 0]
        symbols = symbols.copy()
        symbols[at] = base + new
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols = symbols[keep]
        pair = np.stack([found[order] // base, found[order] % base], axis=1)
        rules = np.concatenate([rules, pair])
        size = lambda s, known=lengths: np.where(s < first, 1, known[np.maximum(s - first, 0)] if len(known) else 1)
        lengths = np.concatenate([lengths, size(pair[:, 0]) + size(pair[:, 1])])
    return symbols, rules, lengths, first


def expansions(rules: np.ndarray, first: int) -> list[np.ndarray]:
    """Ids behind every new symbol, in order."""
    out: list[np.ndarray] = []
    for a, b in rules.tolist():
        out.append(np.concatenate([np.array([s]) if s < first else out[s - first] for s in (a, b)]))
    return out


class Block:
    """A stored block: decodes itself, or any range of its ids."""

    def __init__(self, rules: bytes, lengths: bytes, symbols: bytes, wide: bool, marks: bytes):
        head = np.frombuffer(rules, np.uint32).astype(np.int64)
        self.first, self.rules = int(head[0]), head[1:].reshape(-1, 2)
        self.lengths = np.frombuffer(lengths, np.uint32).astype(np.int64)
        self.symbols = np.frombuffer(symbols, np.uint32 if wide else np.uint16).astype(np.int64)
        self.marks = np.frombuffer(marks, np.uint64).astype(np.int64)
        own = np.arange(self.first)
        self.table = np.concatenate([own, *expansions(self.rules, self.first)]).astype(np.uint32)
        self.size = np.concatenate([np.ones(self.first, np.int64), self.lengths])
        self.start = np.cumsum(self.size) - self.size

    def ids(self) -> np.ndarray:
        return gather(self.table, self.start[self.symbols], self.size[self.symbols])

    def part(self, low: int, high: int) -> np.ndarray:
        """Ids ``low`` to ``high`` (exclusive), from the nearest mark on."""
        mark = max(int(np.searchsorted(self.marks, low, "right")) - 1, 0)
        begin = int(self.marks[mark]) if len(self.marks) else 0
        end_mark = int(np.searchsorted(self.marks, high, "left"))
        part = self.symbols[mark * MARK : end_mark * MARK]
        return gather(self.table, self.start[part], self.size[part])[low - begin : high - begin]


def pack(ids: np.ndarray, rounds: int, pairs: int, least: int) -> list[object]:
    """rules, lengths, symbols, wide, marks of a block."""
    symbols, rules, lengths, first = compress(ids, rounds, pairs, least)
    wide = first + len(rules) > 1 << 16
    size = np.concatenate([np.ones(first, np.int64), lengths])[symbols]
    marks = (np.cumsum(size) - size)[::MARK]
    head = np.r_[first, rules.ravel()].astype(np.uint32)
    return [head.tobytes(), lengths.astype(np.uint32).tobytes(), symbols.astype(np.uint32 if wide else np.uint16).tobytes(), wide, marks.astype(np.uint64).tobytes()]


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = END_ID, block_tokens: int = 1 << 20, rounds: int = 5, pairs: int = 1024, least: int = 64
) -> None:
    """Encode all documents and write the compressed blocks below ``path``."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = doc_rows(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_first(), text_key(F.col("text"))]
    sorted_rows = rows.repartitionByRange(shuffle_tasks(spark), *order).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, begun = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        sizes: list[int] = []
        held = 0

        def block() -> pa.RecordBatch:
            run = np.concatenate(ids)
            row = [shard, number, begun, len(run), doc_ids, sizes, *pack(run, rounds, pairs, least)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.bool_(), pa.binary()]
            names = [field.split()[0] for field in BLOCK.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)

        for batch in batches:
            lengths = np.asarray(pc.binary_length(batch.column(1)), dtype=np.int64)
            part = (np.cumsum(lengths) - lengths) >> 23  # about 8 MB of text at a time
            edges = np.flatnonzero(np.r_[True, np.diff(part) > 0, True])
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                found, count = text_ids(batch.column(1).slice(low, high - low), tokenizer)
                ends = np.cumsum(count)
                for i, doc in enumerate(batch.column(0).slice(low, high - low).to_pylist()):
                    own = found[ends[i] - count[i] : ends[i]]
                    ids += [own, np.array([end_id], np.uint32)]
                    doc_ids.append(doc)
                    sizes.append(len(own) + 1)
                    held += len(own) + 1
                    if held >= block_tokens:
                        yield block()
                        number, begun = number + 1, begun + held
                        ids, doc_ids, sizes, held = [], [], [], 0
        if sizes:
            yield block()

    sorted_rows.mapInArrow(blocks, BLOCK).write.mode("errorifexists").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32``, from the files."""
    ship_package(spark)
    stored = spark.read.schema(BLOCK).parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = Block(row["rules"], row["lengths"], row["symbols"], row["wide"], row["marks"]).ids().astype("<u4").tobytes()
                sizes = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(sizes)
                view = memoryview(data)
                sums = [zlib.crc32(view[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(ends - sizes + row["first_token"]), pa.array(sizes), pa.array(sums, pa.int64()), pa.array([row["shard"]] * len(sizes), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "in_shard", "n_tokens", "ids_crc32", "shard"])

    decoded = stored.mapInArrow(decode, "doc_id long, in_shard long, n_tokens long, ids_crc32 long, shard int")
    totals = stored.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    offsets = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    joined = decoded.join(F.broadcast(offsets), "shard")  # as many rows as the writing job had tasks
    return joined.select("doc_id", (F.col("offset") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32")
