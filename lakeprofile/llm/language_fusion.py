"""Language identification by Bayesian evidence fusion.

For every text the posterior over languages is proportional to

* the likelihood of the text under byte-trigram models, tempered to the weight of
  at most ``evidence`` trigrams, since neighbouring trigrams depend on each other;
* the likelihood of the language declared in the markup, and of the address
  suffix, both counted over the corpus against what the texts alone say;
* the prior of the host, smoothed by the prior of its domain, which is smoothed
  by the prior of the corpus (``strength`` pseudo-rows each), all by grouped
  counts.

A further class, ``und``, spreads its likelihood evenly over all trigrams: texts
in no known language end there.  A text too short for a trigram is left to its
prior.  A row is rejected if its text holds no letter, if ``und`` wins, or if the
best posterior is below ``least``.

The models are fitted on a bounded sample of each language: of its different
labelled texts those whose digest falls below ``train_rows / texts``, so all of
them up to ``train_rows`` and about that many beyond, and each once however often
it is copied.  Languages with fewer than ``least_rows`` labelled rows in the whole
table are left out; the size of the table and of the other languages plays no
part.  Counts for priors and declarations cover all rows.

Null text counts as empty (rejected); null hosts, declarations and suffixes give
no evidence of their own; equal rows get equal results; an empty table gives an
empty result, and without labels all rows are ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from ..session import cut_lineage
from .byte_grams import pieces, plain_bytes, slots, text_bytes
from .common import small_batches, text_key, whole

BITS = 16
UNKNOWN = "und"
TAGS = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*+>"
DECLARED = r"""(?i)<html\b[^>]*?\slang=["']?([a-z]{2,3})"""


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all trigrams of plain bytes with at most one blank, where those of each text begin and end, and its letters."""
    raw, offsets = text_bytes(texts)
    plain = plain_bytes()[raw]
    code = slots(plain, 3, BITS)
    blank = plain == 32
    keep = (blank[:-2].astype(np.int8) + blank[1:-1] + blank[2:] <= 1) if len(plain) > 2 else np.zeros(0, bool)
    for inner in offsets[1:-1].tolist():  # a trigram does not reach into the next text
        keep[max(inner - 2, 0) : inner] = False
    before = np.r_[0, np.cumsum(keep)]
    cut = before[np.minimum(offsets, len(keep))]
    letters = np.r_[0, np.cumsum(~blank)][offsets]
    return code[keep], cut[:-1], cut[1:], np.diff(letters)


def sampled(rows: DataFrame, train_rows: int, least_rows: int) -> tuple[list[str], DataFrame]:
    """Languages with ``least_rows`` labelled rows, in order, and (``text``, ``language``: its number) of their sample."""
    known = rows.where(F.col("label").isNotNull()).select("text", "label", F.xxhash64("text").alias("digest"))
    texts = known.groupBy("label", "digest").agg(F.count(F.lit(1)).alias("copies"))
    found = texts.groupBy("label").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("texts")).where(F.col("n") >= least_rows)
    shares = sorted((r.label, train_rows / r.texts) for r in found.collect())  # one row per language
    numbered = [(label, i, share) for i, (label, share) in enumerate(shares)]
    table = rows.sparkSession.createDataFrame(numbered, "label string, language int, share double")
    place = F.pmod(F.xxhash64("label", "digest"), F.lit(1 << 30)) / float(1 << 30)
    drawn = known.join(F.broadcast(table), "label").where(place < F.col("share"))
    return [label for label, _ in shares], drawn.groupBy("language", "digest").agg(F.min("text").alias("text"))


def train(rows: DataFrame, train_rows: int = 8_000, least_rows: int = 5, smooth: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log-probability of every slot for each, the unknown one last; ``rows``: text, label."""
    small_batches(rows.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, np.ndarray] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for number, table in tables.items():
                at = np.flatnonzero(table)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), number, np.int32)), pa.array(at.astype(np.int32)), pa.array(table[at])], ["language", "slot", "n"])
            tables.clear()

        for batch in pieces(batches, 0):
            code, low, high, _ = trigrams(batch.column(0))
            for i, number in enumerate(batch.column(1).to_pylist()):
                if number not in tables and len(tables) == 64:  # half a MB each
                    yield from counted()
                table = tables.setdefault(number, np.zeros(1 << BITS, np.int64))
                table += np.bincount(code[low[i] : high[i]], minlength=1 << BITS)
        yield from counted()

    languages, sample = sampled(rows, train_rows, least_rows)
    counts = sample.select("text", "language").mapInArrow(count, "language int, slot int, n long")
    # at most 2 ** BITS slots per language
    table = counts.groupBy("language", "slot").agg(F.sum("n").alias("n")).toPandas()
    model = np.full((len(languages) + 1, 1 << BITS), -BITS * np.log(2.0))
    for i in range(len(languages)):
        own = table[table.language == i]
        numbers = np.full(1 << BITS, smooth)
        numbers[own.slot.to_numpy()] += own.n.to_numpy()
        model[i] = np.log(numbers / numbers.sum())
    return [*languages, UNKNOWN], model.astype(np.float32)


def text_evidence(rows: DataFrame, model: np.ndarray, evidence: int) -> DataFrame:
    """``key``, ``host``, ``domain``, ``declared``, ``suffix``, ``grams``, ``letters`` and tempered log-likelihoods ``likely``; ``rows`` has a text, too."""
    narrow = ["key", "host", "domain", "declared", "suffix"]
    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in narrow]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, len(narrow)):
            code, low, high, letters = trigrams(batch.column(len(narrow)))
            grams = high - low
            sums = np.empty((len(grams), len(model)))
            for i, table in enumerate(model):
                total = np.r_[0.0, np.cumsum(table[code], dtype=np.float64)]
                sums[:, i] = total[high] - total[low]
            likely = sums / np.maximum(grams, 1)[:, None] * np.minimum(grams, evidence)[:, None]
            lists = pa.ListArray.from_arrays(np.arange(0, likely.size + 1, len(model), dtype=np.int32), pa.array(likely.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(narrow)], pa.array(grams), pa.array(letters), lists], [*narrow, "grams", "letters", "likely"])

    return rows.select(*narrow, "text").mapInArrow(score, ", ".join([*kinds, "grams long", "letters long", "likely array<double>"]))


def votes(rows: DataFrame, key: str, n: int, name: str) -> DataFrame:
    """Rows per language for every value of ``key``."""
    sums = [F.sum(F.when(F.col("vote") == i, F.col("n")).otherwise(0)) for i in range(n)]
    return rows.groupBy(key).agg(F.array(*sums).alias(name))


def smoothed(counts: Column, prior: Column, strength: float) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, c: a + c)
    return F.zip_with(counts, prior, lambda c, p: (c + strength * p) / (total + strength))


def evidence_table(scored: DataFrame, n: int, strength: float, smooth: float) -> DataFrame:
    """``place`` (host, domain, declared, suffix) and the log of all evidence beside the text, one row per combination."""
    best = F.array_max("likely")
    vote = F.when(F.col("grams") > 0, F.array_position("likely", best) - 1).otherwise(n - 1).cast("int")
    keys = ["host", "domain", "declared", "suffix"]
    cast = cut_lineage(scored.groupBy(*keys, vote.alias("vote")).agg(F.count(F.lit(1)).alias("n")))
    sums = cast.agg(*[F.coalesce(F.sum(F.when(F.col("vote") == i, F.col("n"))), F.lit(0)) for i in range(n)]).first()
    whole_table = F.array(*[F.lit(int(c)) for c in sums])
    corpus = F.array(*[F.lit((c + 1.0) / (sum(sums) + n)) for c in sums])
    none = F.array_repeat(F.lit(0).cast("bigint"), n)
    places = cast.select(*keys).distinct()
    for key in keys:
        table = votes(cast.where(F.col(key).isNotNull()), key, n, f"_{key}").withColumnRenamed(key, f"_of_{key}")
        places = places.join(table, F.col(key) == F.col(f"_of_{key}"), "left").drop(f"_of_{key}")
    counts = {key: F.coalesce(f"_{key}", none) for key in keys}
    prior = smoothed(counts["host"], smoothed(counts["domain"], corpus, strength), strength)
    logs = F.transform(prior, lambda p: F.log(p))
    for key in ("declared", "suffix"):
        # share of the value among the rows of a language
        share = F.zip_with(counts[key], whole_table, lambda c, a: F.log((c + smooth) / (a + 2.0 * smooth)))
        logs = F.when(F.col(key).isNull(), logs).otherwise(F.zip_with(logs, share, lambda a, b: a + b))
    place = F.xxhash64(*keys, *[F.col(k).isNull() for k in keys])
    return places.select(place.alias("place"), logs.alias("beside"))


def identify(rows: DataFrame, languages: list[str], model: np.ndarray, evidence: int = 200, strength: float = 20.0, smooth: float = 1.0, least: float = 0.5) -> DataFrame:
    """``key``, ``language``, ``posterior`` and ``kept``; ``rows``: key, text, host, domain, declared, suffix."""
    n = len(languages)
    scored = cut_lineage(text_evidence(rows, model, evidence))
    keys = ["host", "domain", "declared", "suffix"]
    table = cut_lineage(evidence_table(scored, n, strength, smooth))
    placed = scored.withColumn("place", F.xxhash64(*keys, *[F.col(k).isNull() for k in keys])).select("key", "letters", "likely", "place")
    joined = lookup_join(placed, table, "place", spread=["key"])
    sums = joined.select("key", "letters", F.zip_with("likely", "beside", lambda a, b: a + b).alias("logs"))
    top = F.array_max("logs")
    total = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    best = F.element_at(F.array(*[F.lit(x) for x in languages]), F.array_position("logs", top).cast("int"))
    named = sums.select("key", F.when(F.col("letters") > 0, best).otherwise(UNKNOWN).alias("language"), F.when(F.col("letters") > 0, 1.0 / total).otherwise(0.0).alias("posterior"))
    return named.withColumn("kept", (F.col("language") != UNKNOWN) & (F.col("posterior") >= least))


def from_documents(docs: DataFrame, key: Column) -> DataFrame:
    """Documents as evidence: text and, for a host, the source."""
    nothing = F.lit(None).cast("string")
    return docs.select(key.alias("key"), whole("text").alias("text"), F.col("source").alias("host"), nothing.alias("domain"), nothing.alias("declared"), nothing.alias("suffix"))


def from_pages(pages: DataFrame, key: Column) -> DataFrame:
    """Web pages as evidence: visible text, host, its domain, declared language and address suffix."""
    html = whole("html")
    address = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*+://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    host = F.nullif(F.regexp_replace(address, r"^www\.", ""), F.lit(""))
    domain = F.nullif(F.regexp_extract(F.coalesce(host, F.lit("")), r"([^.]+\.[^.]+)$", 1), F.lit(""))
    suffix = F.nullif(F.regexp_extract(F.coalesce(host, F.lit("")), r"\.([^.0-9]+)$", 1), F.lit(""))
    declared = F.nullif(F.lower(F.regexp_extract(html, DECLARED, 1)), F.lit(""))
    return pages.select(key.alias("key"), F.regexp_replace(html, TAGS, " ").alias("text"), host.alias("host"), domain.alias("domain"), declared.alias("declared"), suffix.alias("suffix"))


def labelled(docs: DataFrame) -> DataFrame:
    return docs.select(whole("text").alias("text"), F.col("lang").alias("label"))


def identify_documents(docs: DataFrame, **settings: float) -> DataFrame:
    """``doc_id``, ``_key`` (digest of the text), ``source``, ``language``, ``posterior``, ``kept``."""
    languages, model = train(labelled(docs))
    key = F.struct(F.col("doc_id"), text_key(whole("text")).alias("text"), F.col("source"))
    found = identify(from_documents(docs, key), languages, model, **settings)
    return found.select("key.doc_id", F.col("key.text").alias("_key"), F.col("key.source").alias("source"), "language", "posterior", "kept")


def keep_identified(docs: DataFrame, **settings: float) -> DataFrame:
    """Documents whose language was identified; all columns."""
    gone = identify_documents(docs, **settings).where(~F.col("kept")).select(F.col("doc_id").alias("_doc"), "_key", F.col("source").alias("_source")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    same = F.col("_row.doc_id").eqNullSafe(F.col("_doc")) & (text_key(whole(F.col("_row.text"))) == F.col("_key")) & F.col("_row.source").eqNullSafe(F.col("_source"))
    return rows.join(gone, same, "left_anti").select("_row.*")
