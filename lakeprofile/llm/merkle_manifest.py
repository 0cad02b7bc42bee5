"""Merkle manifest of a dataset: one root over all rows, and a proof for each.

A row is a leaf: the SHA-256 (lowercase hex) of its columns, each written as ``-``
if null, else its UTF-8 byte count, ``:`` and its value.  Per source, leaves ascend
by ``doc_id`` (null first; rows with one id follow by their leaf).  While several
nodes remain, each three in a row become the hash of their hex digests end to end;
the last run may be shorter.  What remains is the source's subroot, and the
subroots, ordered by source (null first, by bytes), are hashed in the same way
into the root.

Leaves are numbered by a range-partitioned running count, so a source with most
rows is spread over many tasks, and cut into aligned blocks of ``3 ** LEVELS``.  A
block keeps each of its levels as one hex string: fixed-width substrings of three
digests are hashed into the next level's string, and the substrings on either side
of a digest in its run are that level's siblings in the proof.  The block's last
node is a leaf of the next round, which deals with the block roots in the same
way, until every source is down to one.  Proofs are put together on the way back:
a block's members take the path of the block, joined by (group, block), which is
unique on both sides.  No task sees more than a block.

Equal rows have equal leaves, each with its own place and proof.  An empty table
gives no rows.  Empty texts differ from null ones.  Very long texts are hashed
whole, in one expression; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import running_totals
from ..session import cut_lineage

RUN = 3  # nodes hashed together
HEX = 64
LEVELS = 5  # of a block: 243 leaves, 15,552 hex digits
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def cut(level: Column) -> Column:
    """The runs of a level's string: three digests each, the last one fewer."""
    runs = F.ceil(F.length(level) / F.lit(RUN * HEX)).cast("int")
    return F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.substring(level, i * (RUN * HEX) + 1, F.lit(RUN * HEX)))


def siblings(run: Column, place: Column) -> Column:
    """The digests of a run before and after the one at ``place``."""
    at = place * HEX
    return F.struct(F.substring(run, F.lit(1), at).alias("before"), F.substring(run, at + HEX + 1, F.lit(RUN * HEX)).alias("after"))


def blocks_of(nodes: DataFrame) -> DataFrame:
    """Nodes (``group``, ``at``, ``hash``, ``member``) to blocks with the runs of each level and their root.

    The level above a block's root belongs to the next round.  A first block that
    is not full is its group's only one and stops at a single node; every other
    one goes through all levels, as its group does.
    """
    size = RUN**LEVELS
    member = F.struct((F.col("at") % size).cast("int").alias("i"), F.col("hash"), F.col("member"))
    found = nodes.groupBy("group", F.floor(F.col("at") / size).alias("block")).agg(F.array_sort(F.collect_list(member)).alias("members"))
    rows = found.withColumn("_s0", F.array_join(F.transform("members", lambda m: m["hash"]), ""))
    lone = F.col("block") == 0
    none = F.array().cast("array<string>")
    for k in range(LEVELS):
        # a level is left out where its group has come down to one node
        done = (lone & (F.size("members") < size) & (F.length(f"_s{k}") == HEX)) if k else (lone & (F.size("members") == 1))
        rows = rows.withColumn(f"_r{k}", F.when(done, none).otherwise(cut(F.col(f"_s{k}"))))
        above = F.array_join(F.transform(f"_r{k}", lambda run: F.sha2(run, 256)), "")
        rows = rows.withColumn(f"_s{k + 1}", F.when(F.size(f"_r{k}") == 0, F.col(f"_s{k}")).otherwise(above))
    return rows.select("group", "block", "members", F.array(*[f"_r{k}" for k in range(LEVELS)]).alias("runs"), F.col(f"_s{LEVELS}").alias("_root"))


def climb(nodes: DataFrame, top: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``group``, ``at``, ``member`` and the ``path`` of every node, with the columns that ``top`` gives to each group.

    ``top`` takes (``group``, ``subroot``) and returns the columns ``group``, ``path`` and others.
    """
    blocks = cut_lineage(blocks_of(nodes))
    if blocks.where("block > 0").isEmpty():
        above = top(blocks.select("group", F.col("_root").alias("subroot"))).withColumn("block", F.lit(0).cast("long"))
    else:
        up = blocks.select("group", F.col("block").alias("at"), F.col("_root").alias("hash"), F.lit(None).cast("string").alias("member"))
        above = climb(up, top).withColumnRenamed("at", "block").drop("member", "hash")
    above = above.withColumnRenamed("group", "_group").withColumnRenamed("block", "_block").withColumnRenamed("path", "_above")
    joined = blocks.drop("_root").join(above, F.col("group").eqNullSafe(F.col("_group")) & (F.col("block") == F.col("_block")))

    def own_path(m: Column) -> Column:
        level = lambda runs, k: F.struct(
            (F.floor(m["i"] / F.pow(F.lit(RUN), k)) % RUN).cast("int").alias("place"),
            F.get(runs, F.floor(m["i"] / F.pow(F.lit(RUN), k + 1)).cast("int")).alias("run"),
        )
        found = F.filter(F.transform("runs", level), lambda x: x["run"].isNotNull())
        return F.transform(found, lambda x: siblings(x["run"], x["place"]))

    others = [c for c in above.columns if c not in ("_group", "_block", "_above")]
    at = lambda m: F.col("block") * RUN**LEVELS + m["i"]
    each = F.transform("members", lambda m: F.struct(at(m).alias("at"), m["hash"].alias("hash"), m["member"].alias("member"), F.concat(own_path(m), F.col("_above")).alias("path")))
    return joined.select("group", *others, F.explode(each).alias("_m")).select("group", *others, "_m.*")


def manifest(docs: DataFrame, other: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``leaf``, ``subroot``, ``root`` and ``proof``.

    ``proof`` lists, level by level from the leaf to the root, the digests
    ``before`` and ``after`` the node on the way.  ``other`` is the text of
    another copy of the row to be checked against this manifest; its leaf is
    carried along as ``other_leaf``.
    """
    values = [F.col(c) for c in FIELDS]
    checked = F.lit(None).cast("string") if other is None else leaf_hash([*values[:-1], other])
    rows = docs.select("doc_id", "source", leaf_hash(values).alias("leaf"), checked.alias("other_leaf"))
    numbered = running_totals(rows, [F.col("doc_id").asc_nulls_first(), F.col("leaf")], "_n", partition_by=["source"])
    member = F.struct("doc_id", "other_leaf")
    leaves = numbered.select(F.col("source").alias("group"), (F.col("_n") - 1).alias("at"), F.col("leaf").alias("hash"), member.alias("member"))

    def over_sources(subroots: DataFrame) -> DataFrame:
        ranked = running_totals(subroots, [F.col("group").asc_nulls_first()], "_n")
        member = F.struct(F.col("group").alias("source"), "subroot")
        nodes = ranked.select(F.lit(0).alias("group"), (F.col("_n") - 1).alias("at"), F.col("subroot").alias("hash"), member.alias("member"))
        found = climb(nodes, lambda last: last.select("group", F.col("subroot").alias("root"), no_path().alias("path")))
        return found.select(F.col("member.source").alias("group"), "member.subroot", "root", "path")

    found = climb(leaves, over_sources)
    out = found.select("member.doc_id", F.col("group").alias("source"), F.col("hash").alias("leaf"), "subroot", "root", F.col("path").alias("proof"), "member.other_leaf")
    return out if other is not None else out.drop("other_leaf")


def no_path() -> Column:
    return F.array().cast("array<struct<before:string,after:string>>")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def proof_hash(proof: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def tampered_text() -> Column:
    """The text without its line feeds where 2 divides the CRC-32 of the decimal id; a null id is left alone."""
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def digest(docs: DataFrame) -> DataFrame:
    """The manifest, and which rows of a copy with line feeds lost still agree with it."""
    found = manifest(docs, tampered_text()).withColumn("folded_root", folded(F.col("other_leaf"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def oracle() -> str:
    """The same for DuckDB, node by node: one row per node and level instead of strings."""
    byte_steps = "list_reduce([xor(c, ascii(ch))] || range(8), lambda v, _: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)"
    crc = f"xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT), lambda c, b: {byte_steps.replace('ascii(ch)', 'b')}), 4294967295)"
    part = lambda c, v: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({v}::VARCHAR)::VARCHAR || ':' || {v}::VARCHAR END"
    columns = lambda text: " || ".join(part(c, text if c == "text" else c) for c in FIELDS)
    nodes = lambda first: f"""
      SELECT {first} UNION ALL
      SELECT level + 1, grp, pos // 3, sha256(string_agg(hash, '' ORDER BY pos)), any_value(n + 2) // 3 FROM {{name}} WHERE n > 1 GROUP BY level, grp, pos // 3"""  # noqa: E731
    siblings = lambda name, below: f"""
      SELECT b.rid, c.level + {{offset}} AS level, string_agg(s.hash, '' ORDER BY s.pos) FILTER (s.pos < c.pos) AS bef,
             string_agg(s.hash, '' ORDER BY s.pos) FILTER (s.pos > c.pos) AS aft
      FROM {below} b JOIN {name} c ON c.grp = b.grp AND c.n > 1 AND c.pos = b.pos // (3 ** c.level)::BIGINT
      JOIN {name} s ON s.grp = c.grp AND s.level = c.level AND s.pos // 3 = c.pos // 3 GROUP BY ALL"""  # noqa: E731
    return f"""
    WITH RECURSIVE changed AS (
      SELECT *, {crc} AS crc FROM documents),
    docs AS (
      SELECT row_number() OVER () AS rid, doc_id, coalesce('s' || source, '') AS grp, sha256({columns('text')}) AS leaf,
             sha256({columns("(CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END)")}) AS other
      FROM changed),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM docs),
    low AS ({nodes("0 AS level, grp, pos, leaf AS hash, n FROM placed").format(name="low")}),
    tops AS (SELECT grp AS source, hash, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
    high AS ({nodes("0 AS level, 0 AS grp, pos, hash, n FROM tops").format(name="high")}),
    own AS ({siblings("low", "placed").format(offset=0)}),
    owner AS (SELECT p.rid, 0 AS grp, t.pos FROM placed p JOIN tops t ON t.source = p.grp),
    beyond AS ({siblings("high", "owner").format(offset=100)}),
    path AS (SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY level) AS step, coalesce(bef, '') AS bef, coalesce(aft, '') AS aft FROM (FROM own UNION ALL FROM beyond)),
    proof AS (SELECT rid, sha256(string_agg(bef || aft, '' ORDER BY step)) AS proof FROM path GROUP BY rid),
    fold AS (
      SELECT rid, 0 AS step, other AS hash FROM docs UNION ALL
      SELECT f.rid, p.step, sha256(p.bef || f.hash || p.aft) FROM fold f JOIN path p ON p.rid = f.rid AND p.step = f.step + 1),
    folded AS (SELECT rid, arg_max(hash, step) AS hash FROM fold GROUP BY rid)
    SELECT p.doc_id, p.leaf, t.hash AS subroot, (SELECT hash FROM high WHERE n = 1) AS root, coalesce(q.proof, sha256('')) AS proof_sha256, f.hash AS folded_root,
           f.hash = (SELECT hash FROM high WHERE n = 1) AS verified
    FROM placed p JOIN tops t ON t.source = p.grp JOIN folded f ON f.rid = p.rid LEFT JOIN proof q ON q.rid = p.rid"""
