"""Multipart credential linking.

Strong parts (keyword assignments, access identifiers, long hex strings) are
always reported.  Weak parts (account names, random-looking or short secrets,
endpoints) prove little alone: each belongs to a class (identifier, secret,
endpoint) and is reported only when a part of a complementary class stands
within ``scope`` characters, weak or strong.  A secret completes an identifier
or an endpoint and the other way round.

The linking is an interval join inside one text: with all parts of a text in
order, the nearest part of a class before a part is a running maximum of ends,
and the nearest one after it a running minimum of starts, so no pairs are made
however many parts a text has.

Null text counts as empty; a null ``doc_id`` is an id like any other; equal rows
get equal results; an empty table gives an empty result.  Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import doc_rows, text_key
from .spans import SPAN, count_kind, listed, match_spans, none, overlaps

BASE_KINDS = ("assign", "access", "hex")
WEAK_KINDS = ("id", "secret", "endpoint")
KINDS = (*BASE_KINDS, *WEAK_KINDS)

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9+/_.=-]++"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
ACCOUNT = r"""(?i:\b(?:user(?:name|_?id)?|login|account|client_?id|access_?(?:key_?)?id))["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9@._-]{3,}+"""
SHORT_SECRET = r"""(?i:\b(?:pass|pwd|passphrase|password|passwd|secret|token|api_?key|credential))["']?\x20*+[:=]\x20*+["']?[^\x20\x09-\x0D"']{4,}+"""
RANDOM = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[a-z0-9+/_=-]*+[A-Z])(?=[A-Z0-9+/_=-]*+[a-z])[A-Za-z0-9+/_=-]{20,}+"
ENDPOINT = r"""\b[a-z][a-z0-9+.-]{1,20}+://[^\x20\x09-\x0D"'<>]++|\b(?i:host|endpoint|server)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9.-]{3,}+(?::[0-9]++)?+"""

#: Classes of the parts, and which classes complete a class.
CLASS = {"access": "id", "id": "id", "assign": "secret", "hex": "secret", "secret": "secret", "endpoint": "endpoint"}
COMPLETED_BY = {"id": ("secret",), "secret": ("id", "endpoint"), "endpoint": ("secret",)}


def strong_parts(text: Column) -> Column:
    return F.concat(
        match_spans(text, ASSIGN, "assign", lambda v: F.length(F.regexp_extract(v, ASSIGN_VALUE, 1)) >= 12),
        F.when(text.contains("AKIA"), match_spans(text, ACCESS, "access")).otherwise(none()),
        match_spans(text, HEX, "hex"),
    )


def weak_parts(text: Column) -> Column:
    return F.concat(match_spans(text, ACCOUNT, "id"), match_spans(text, SHORT_SECRET, "secret"), match_spans(text, RANDOM, "secret"), match_spans(text, ENDPOINT, "endpoint"))


def linked(rows: DataFrame, scope: int) -> DataFrame:
    """(doc_id, _key, span) of the weak parts that a complementary part confirms."""
    strong = F.transform("base", lambda s: F.struct(s.alias("span"), F.lit(False).alias("weak")))
    weak = F.transform(F.filter("weak", lambda s: ~overlaps(s, F.col("base"))), lambda s: F.struct(s.alias("span"), F.lit(True).alias("weak")))
    part = rows.where(F.size("weak") > 0).dropDuplicates(["doc_id", "_key"]).select("doc_id", "_key", F.explode(F.concat(strong, weak)).alias("p"))
    part = part.select("doc_id", "_key", F.col("p.span").alias("span"), F.col("p.weak").alias("weak"))
    group = F.element_at(F.create_map(*[F.lit(x) for pair in CLASS.items() for x in pair]), F.col("span.kind"))
    part = part.select("*", F.col("span.start").alias("start"), F.col("span.end").alias("end"), group.alias("class"))
    text = Window.partitionBy("doc_id", "_key")
    upto = text.orderBy("start", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = text.orderBy(F.desc("start"), F.desc("end")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = {}
    for c in COMPLETED_BY:
        before = F.max(F.when(F.col("class") == c, F.col("end"))).over(upto)
        after = F.min(F.when(F.col("class") == c, F.col("start"))).over(onward)
        near[c] = F.coalesce(F.col("start") - before <= scope, F.lit(False)) | F.coalesce(after - F.col("end") <= scope, F.lit(False))
    marked = part.select("*", *[near[c].alias(f"near_{c}") for c in near])
    confirmed = F.lit(False)
    for c, others in COMPLETED_BY.items():
        for other in others:
            confirmed = confirmed | ((F.col("class") == c) & F.col(f"near_{other}"))
    return marked.where(F.col("weak") & confirmed).select("doc_id", "_key", "span")


def find_secrets(docs: DataFrame, scope: int = 200) -> DataFrame:
    """``doc_id``, ``_key`` (digest of the text) and ``spans`` of every document."""
    text = F.col("text")
    found = doc_rows(docs).select("doc_id", text_key(text).alias("_key"), strong_parts(text).alias("base"), weak_parts(text).alias("weak"))
    rows = cut_lineage(found)
    added = linked(rows, scope).groupBy(F.col("doc_id").alias("_doc"), F.col("_key").alias("_added_key")).agg(F.collect_set(F.col("span").cast(SPAN)).alias("added"))
    joined = rows.where(F.size("weak") > 0).join(added, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_added_key")), "left")
    full = joined.select("doc_id", "_key", F.concat("base", F.coalesce("added", none())).alias("spans"))
    return full.unionByName(rows.where(F.size("weak") == 0).select("doc_id", "_key", F.col("base").alias("spans")))


def digest(found: DataFrame) -> DataFrame:
    """Counts, digest of the strong spans, and all spans as text."""
    base = listed(F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS)), BASE_KINDS, start_first=True)
    weak = sum((count_kind(F.col("spans"), k) for k in WEAK_KINDS[1:]), count_kind(F.col("spans"), WEAK_KINDS[0]))
    return found.select(
        "doc_id", *[count_kind(F.col("spans"), k).alias(f"n_{k}") for k in BASE_KINDS], F.sha2(base, 256).alias("base_sha256"),
        listed(F.col("spans"), KINDS, start_first=True).alias("spans"), weak.alias("n_linked"),
    )
