"""Information-theoretic sanitisation of personal data.

Two kinds of spans are found in every whole text:

* identifiers (email, ip, card, phone) by their form;
* terms that give an identifier away.  Over the whole corpus the documents that
  hold an identifier e, a term t, and both are counted, wherever in the text they
  stand; what is written inside an identifier is no term.  The share of e's
  information content that t discloses is
  ``PMI(e; t) / IC(e) = 1 - ln(df(t) / df(e, t)) / ln(N / df(e))``.
  From ``generalise_at`` on, t is replaced by its class; from ``remove_at`` on it
  is taken out.  A pair counts as evidence only if it was seen in
  ``min_contexts`` different surroundings (``reach`` characters on either side of
  the identifier and the terms beside the term), so copies of one text prove
  nothing.

A term that discloses any identifier is marked wherever it occurs, in documents
without the identifier, too.  No pair is left out but those whose counts alone
show that the share stays below ``generalise_at``: it cannot be reached by a term
of more than ``df(e) * (N / df(e)) ** (1 - generalise_at)`` documents.  Counted
terms travel to the documents while there are at most ``broadcast_terms`` of
them; beyond that both sides are joined by shuffle.  Both ways give the same rows.

Null text counts as empty; a null ``doc_id`` is an id like any other; equal rows
get equal results; an empty table gives an empty result.  Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join, probe_join
from ..session import cut_lineage, remove_path, work_path
from .common import doc_rows, text_key
from .spans import SPAN, blanked, count_kind, listed, match_spans, none, replaced

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "general", "removed")

# The same matches as the plain forms, without their backtracking: a match begins where a run of its characters
# begins, or where the last match ended, and runs are never given back.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"[\p{L}\p{N}]+"
NO_TERM = r"[^\p{L}\p{N}]+"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def is_ip(value: Column) -> Column:
    parts = F.split(value, r"\.")
    return F.forall(parts, lambda part: F.coalesce(F.ltrim(part, F.lit("0")).try_cast("int"), F.when(part.rlike("^0+$"), 0).otherwise(256)) <= 255)


def is_card(value: Column) -> Column:
    number = digits(value)
    return F.length(number).between(13, 19) & F.call_function("luhn_check", number)


def is_phone(value: Column) -> Column:
    return F.length(digits(value)).between(9, 15)


def identifiers(text: Column) -> Column:
    """All identifier spans of a text that is not null."""
    return F.concat(
        F.when(text.contains("@"), match_spans(text, EMAIL, "email")).otherwise(none()),
        match_spans(text, IP, "ip", is_ip),
        match_spans(text, CARD, "card", is_card),
        F.when(text.contains("+"), match_spans(text, PHONE, "phone", is_phone)).otherwise(none()),
    )


def entity(span: Column) -> Column:
    """The identifier itself, however it is written."""
    return F.concat(span["kind"], F.lit(":"), F.when(span["kind"].isin("card", "phone"), digits(span["value"])).otherwise(F.lower(span["value"])))


def with_identifiers(docs: DataFrame, reach: int) -> DataFrame:
    """One row per document: ``row`` (its number), ``doc_id``, ``_key``, ``base`` spans, ``bare`` (the text with blanks for
    identifiers) and ``entities`` with a digest of their surroundings."""
    found = doc_rows(docs).withColumn("base", identifiers(F.col("text")))
    text = F.col("text")
    mention = F.transform(
        "base",
        lambda s: F.struct(
            entity(s).alias("entity"),
            F.xxhash64(
                F.substring(text, F.greatest(s["start"] - reach, F.lit(0)) + 1, F.least(s["start"], F.lit(reach))),
                F.substring(text, s["end"] + 1, F.lit(reach)),
            ).alias("context"),
        ),
    )
    bare = F.when(F.size("base") > 0, blanked(text, F.col("base"))).otherwise(text)
    return found.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_key(text).alias("_key"), "base", bare.alias("bare"), mention.alias("entities"))


def term_digests(text: Column) -> Column:
    """64-bit digests of the terms of a text in order."""
    return F.transform(F.filter(F.split(text, NO_TERM), lambda t: t != ""), lambda t: F.xxhash64(F.lower(t)))


def held_terms(rows: DataFrame) -> DataFrame:
    """``row`` and ``digest`` of every term of every text, once a text."""
    return rows.select("row", F.explode(F.array_distinct(term_digests(F.col("bare")))).alias("digest"))


def with_terms(held: DataFrame, terms: DataFrame, broadcast_terms: int, spread: str = "row") -> DataFrame:
    """Rows of ``held`` whose ``digest`` is among ``terms`` (one row per digest), with its columns."""
    if terms.count() <= broadcast_terms:
        return held.join(F.broadcast(terms), "digest")
    return lookup_join(held, terms, "digest", "inner", spread=[spread])


def disclosing_terms(rows: DataFrame, min_contexts: int, generalise_at: float, broadcast_terms: int) -> DataFrame:
    """(digest, disclosed): terms that disclose at least ``generalise_at`` of an entity, and the most they disclose."""
    total = rows.count()
    mention = rows.where(F.size("entities") > 0).select("row", F.explode("entities").alias("e"))
    mention = cut_lineage(mention.groupBy("row", F.xxhash64("e.entity").alias("entity")).agg(F.min("e.context").alias("context")))
    entities = mention.groupBy("entity").agg(F.count(F.lit(1)).alias("df_entity"))
    # an entity of all documents has no information to disclose
    entities = cut_lineage(entities.where((F.col("df_entity") >= min_contexts) & (F.col("df_entity") < total)))
    most = F.col("df_entity") * F.pow(total / F.col("df_entity"), F.lit(1 - generalise_at)) * (1 + 1e-9)
    known = lookup_join(mention, entities, "entity", "inner", spread=["row"]).withColumn("most", most)
    each = F.struct("entity", "context", "df_entity", "most")
    evident = cut_lineage(known.groupBy("row").agg(F.collect_list(each).alias("es"), F.max("most").alias("most")))
    limit = evident.agg(F.max("most").alias("m")).first()["m"]
    held = held_terms(rows).groupBy("digest").agg(F.count(F.lit(1)).alias("df_term"))
    held = cut_lineage(held.where(F.col("df_term") >= min_contexts))
    counted, common = held.where(F.col("df_term") <= F.lit(limit)), held.where(F.col("df_term") > F.lit(limit)).select("digest")
    # the terms of every text with an identifier, whether that recurs or not, straight from the table: the work grows with
    # the texts, and neither they nor their identifiers move with the terms
    own = F.col("own")
    beside = F.transform(own, lambda t, i: F.struct(t.alias("digest"), F.xxhash64(F.get(own, i - 1), F.get(own, i + 1)).alias("beside")))
    told = rows.where(F.size("entities") > 0).select("row", term_digests(F.col("bare")).alias("own"))
    placed = told.select("row", F.explode(beside).alias("t")).select("row", "t.digest", "t.beside")
    if counted.count() <= broadcast_terms:
        fit = placed.join(F.broadcast(counted), "digest")
    else:
        if common.count() <= broadcast_terms:  # most terms of a text are among them, and stay where they are
            placed = placed.join(F.broadcast(common), "digest", "left_anti")
        fit = probe_join(placed, counted, "digest", "inner")
    fit = probe_join(fit, evident, "row", "inner").where(F.col("df_term") <= F.col("most"))
    pairs = fit.select("row", "digest", "df_term", "beside", F.explode("es").alias("e")).where(F.col("df_term") <= F.col("e.most"))
    names = [F.col("e.entity").alias("entity"), "digest", F.col("e.df_entity").alias("df_entity"), "df_term"]
    keys = ["entity", "digest", "df_entity", "df_term"]
    per_doc = pairs.groupBy(*names, "row").agg(F.min(F.xxhash64("e.context", "beside")).alias("context"))
    per_context = per_doc.groupBy(*keys, "context").agg(F.count(F.lit(1)).alias("n"))
    seen = per_context.groupBy(*keys).agg(F.sum("n").alias("df_pair"), F.count(F.lit(1)).alias("contexts")).where(F.col("contexts") >= min_contexts)
    share = 1 - F.log(F.col("df_term") / F.col("df_pair")) / F.log(total / F.col("df_entity"))
    return seen.select("digest", share.alias("disclosed")).where(F.col("disclosed") >= generalise_at).groupBy("digest").agg(F.max("disclosed").alias("disclosed"))


def find_personal_data(
    docs: DataFrame, reach: int = 80, min_contexts: int = 2, generalise_at: float = 0.6, remove_at: float = 0.9, broadcast_terms: int = 1_000_000
) -> DataFrame:
    """``doc_id``, ``_key`` (digest of the text) and ``spans`` of every document."""
    spark, path = docs.sparkSession, work_path(docs.sparkSession, "identifiers")
    with_identifiers(docs, reach).write.parquet(path)  # compressed, and read by column; the row numbers are fixed from here on
    rows = spark.read.parquet(path)
    telling = cut_lineage(disclosing_terms(rows, min_contexts, generalise_at, broadcast_terms))
    removed = F.collect_list(F.when(F.col("disclosed") >= remove_at, F.col("digest"))).alias("removed")
    hits = with_terms(held_terms(rows), telling, broadcast_terms).groupBy("row").agg(F.collect_list("digest").alias("marked"), removed)
    keyed = hits.join(rows.select("row", "doc_id", "_key"), "row").dropDuplicates(["doc_id", "_key"])  # equal rows have equal terms
    keyed = cut_lineage(keyed.select(F.col("doc_id").alias("_doc"), F.col("_key").alias("_hit"), "marked", "removed"))
    remove_path(spark, path)  # the texts are read from their own table below, so they lie on disk once at any time
    texts = with_identifiers(docs, reach).drop("row", "entities")
    joined = texts.join(keyed, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_hit")), "left")
    digest_of = lambda value: F.xxhash64(F.lower(value))
    found = match_spans(F.col("bare"), TERM, "general", lambda t: F.array_contains("marked", digest_of(t)))
    kind = lambda t: F.when(F.array_contains("removed", digest_of(t["value"])), "removed").otherwise("general")
    added = F.transform(found, lambda t: F.struct(kind(t).alias("kind"), t["start"], t["end"], t["value"])).cast(f"array<{SPAN}>")
    return joined.select("doc_id", "_key", F.when(F.col("marked").isNull(), F.col("base")).otherwise(F.concat("base", added)).alias("spans"))


def term_class(span: Column) -> Column:
    """What stands for a generalised term."""
    value = span["value"]
    return F.when(value.rlike("[0-9]"), "[NUMBER]").when(value.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[TERM]")


def sanitise(docs: DataFrame, **settings: float) -> DataFrame:
    """Documents with all columns, every span of ``text`` generalised or removed."""
    spans = find_personal_data(docs, **settings).dropDuplicates(["doc_id", "_key"]).select(F.col("doc_id").alias("_doc"), F.col("_key").alias("_span_key"), F.col("spans").alias("_spans"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    on = F.col("_row.doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64(F.coalesce("_row.text", F.lit(""))) == F.col("_span_key"))
    label = lambda s: F.when(s["kind"] == "removed", "").when(s["kind"] == "general", term_class(s)).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    joined = rows.join(spans.where(F.size("_spans") > 0), on, "left")
    clean = F.when(F.col("_spans").isNull(), F.col("_row.text")).otherwise(replaced(F.col("_row.text"), F.col("_spans"), label))
    return joined.select(F.col("_row").withField("text", clean).alias("_row")).select("_row.*")


def digest(found: DataFrame) -> DataFrame:
    """Counts, digest of the identifier spans, and all spans as text."""
    base = listed(F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS)), BASE_KINDS)
    return found.select(
        "doc_id", *[count_kind(F.col("spans"), k).alias(f"n_{k}") for k in BASE_KINDS], F.sha2(base, 256).alias("base_sha256"), listed(F.col("spans"), KINDS).alias("spans"),
        (count_kind(F.col("spans"), "general") + count_kind(F.col("spans"), "removed")).alias("n_terms"),
    )
