"""Cheapest repair of the role order of conversations, by a Viterbi search that emits as it goes.

A conversation is its rows by turn (null first; rows of one turn follow by role,
then by a digest of their text).  The first fault of a row counts: ``blank`` (no
character but blanks), ``duplicate`` (role and text occurred earlier in the
conversation), ``truncated`` (the last character that is no blank does not end a
sentence).  A repair keeps a row, gives it the role user or assistant, deletes it
(blank and duplicate rows always are), or inserts an empty row of either role
anywhere; a truncated row that stays costs extra.  The initials of the repaired
roles have to read ``(s?(ua)+)?``.  The cheapest repair is taken; of equal ones,
that whose edit initials (K, R, D, I) come first.

The search (``Search``) holds one survivor for each state of that pattern.  The
edits of all survivors form a tree of back pointers (a stretch without a fork is
one node); a node counts its references (children and survivors) and goes when the
last one does.  Where the root is left
with a single child and no survivor of its own, all survivors share that edit: it
is emitted and the child becomes the root.  So memory is the unresolved part only:
a few edits as a rule; where the first edit hangs on the last row (user rows alone:
one is deleted if their number is odd) all edits of that stretch, as they must be.
A survivor goes as soon as another is cheaper by more than any ending could make up
for (``slack``): without that, "nothing kept so far" would survive to the end.
Equal costs are decided on the complete unresolved edits from the common ancestor
on; equal costs with one a beginning of the other cannot be, as edits that take no
row cost something.

Spark does everything beside that search: equal rows of a conversation become one
row with a count; they are numbered by a range-partitioned running count, so a
conversation that holds most rows is spread over many tasks; faults follow from
the least number of each (role, text).  A row then is one letter, and up to
``CHUNK`` rows of a conversation are one string.  The strings of a conversation
pass in order, as a stream, through one task, which holds one string and the
unresolved edits.  The edits are joined back to the rows by number, unique on both
sides.

A null role, text, turn or conversation is an ordinary value: role and text count
as one space, null turns come first, rows without ``conv_id`` are one
conversation.  A role other than those that begin with s, u or a (the empty one
too) cannot be kept.  Very long texts are read in the JVM and only to find their
faults.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator, Sequence
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import running_totals
from ..session import cut_lineage
from .common import BLANKS, shuffle_tasks, small_batches

CHUNK = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after system, after user, after assistant.  A repaired conversation ends in the first or the last.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
OPEN = {state: "a" if state == USER else "u" for state in range(4)}  # the one role besides system that may follow
#: Edits as they are stored: the role given or inserted shows.  The audit shows the initial of the edit alone.
SHOWN, AUDIT = "uaUA", "RRII"
AUDITED = str.maketrans(SHOWN, AUDIT)
#: A row as one letter: role (system, user, assistant, other) by fault (none, truncated, to be deleted).
LETTERS = {letter: (role, fault) for letter, (role, fault) in zip("suaoSUAO1234", [(r, f) for f in range(3) for r in "suao"], strict=True)}

FOUND = (("chunk", pa.int64()), ("edits", pa.list_(pa.string())), ("cost", pa.int64()), ("illegal", pa.int64()))


class Node:
    """A run of edits in a survivor's history: a back pointer and a count of what refers to it."""

    __slots__ = ("children", "edits", "parent", "refs")

    def __init__(self, parent: Node | None, edits: list[str]):
        self.parent, self.edits, self.refs, self.children = parent, edits, 0, set()
        if parent is not None:
            parent.children.add(self)
            parent.refs += 1


def differ(a: str, b: str) -> tuple[str, str]:
    """What is left of two texts after their common beginning, up to the first difference."""
    if a and b and a[0] != b[0]:
        return a[0], b[0]
    same = len(commonprefix((a, b)))
    a, b = a[same:], b[same:]
    return (a[0], b[0]) if a and b else (a, b)


class Search:
    """Survivors of one conversation; ``out`` has each edit as soon as it is certain.

    ``left[x, y]`` is what is left of the unresolved edits of survivors x and y, as
    the audit shows them, after their common beginning.  It grows with them, so a
    tie is decided on the complete edits without walking them.
    """

    def __init__(self, costs: Sequence[int] = (KEEP, REROLE, DELETE, INSERT, TRUNCATED)):
        self.keep, self.rerole, self.delete, self.insert, self.extra = costs
        if self.insert <= 0:
            raise ValueError("an inserted row must cost something")
        drop, close = max(0, self.delete - min(self.keep, self.rerole)), self.insert
        #: slack[x, y]: what any ending of a survivor in state x costs more, at most, once it is bent to one in state y,
        #: by deleting a row that stood or by inserting the rows that close a pair.
        self.slack = {
            (SYSTEM, START): 0, (USER, START): drop, (ASSISTANT, START): 0,
            (START, SYSTEM): max(drop, 2 * close), (USER, SYSTEM): drop + 2 * close, (ASSISTANT, SYSTEM): 2 * close,
            (START, USER): max(2 * drop, close), (SYSTEM, USER): drop, (ASSISTANT, USER): max(drop, close),
            (START, ASSISTANT): drop, (SYSTEM, ASSISTANT): 0, (USER, ASSISTANT): drop,
        }
        self.root = Node(None, [])
        self.root.refs = 1
        self.tips: list[tuple[int, Node] | None] = [(0, self.root), None, None, None]
        self.left = {(START, START): ("", "")}
        self.out: list[str] = []
        self.nodes = self.most = 1
        self.fill()

    def before(self, x: int, edit: str, y: int, other: str) -> bool:
        """Whether the edits of survivor x and ``edit`` come before those of y and ``other``."""
        a, b = self.left[x, y]
        return a + edit.translate(AUDITED) < b + other.translate(AUDITED)

    def release(self, node: Node) -> None:
        """One reference fewer; a node without any goes, and its parent loses one."""
        node.refs -= 1
        while not node.refs and node is not self.root:
            parent = node.parent
            parent.children.discard(node)
            parent.refs -= 1
            self.nodes -= 1
            node = parent

    def grow(self, node: Node, edit: str) -> Node:
        child = Node(node, [edit])
        child.refs = 1  # the survivor
        self.nodes += 1
        return child

    def fill(self) -> None:
        """Inserted rows between two rows, as long as one makes a state cheaper."""
        changed = True
        while changed:
            changed = False
            for state in range(4):
                tip = self.tips[state]
                if tip is None:
                    continue
                role = OPEN[state].upper()
                to, cost = NEXT[state, OPEN[state]], tip[0] + self.insert
                held = self.tips[to]
                if held is not None and (cost > held[0] or (cost == held[0] and not self.before(state, role, to, ""))):
                    continue
                self.tips[to] = (cost, self.grow(tip[1], role))
                if held is not None:
                    self.release(held[1])
                for z in range(4):
                    if z != to and self.tips[z] is not None:
                        a, b = differ(self.left[state, z][0] + "I", self.left[state, z][1])
                        self.left[to, z], self.left[z, to] = (a, b), (b, a)
                self.left[to, to] = ("", "")
                changed = True

    def step(self, letter: str, times: int = 1) -> None:
        """Take one row, or ``times`` equal rows that have to go."""
        role, fault = LETTERS[letter]
        best: list[tuple[int, int, str] | None] = [None] * 4
        extra = self.extra if fault == 1 else 0
        for state, tip in enumerate(self.tips):
            if tip is None:
                continue
            ways = [(state, self.delete * times, "D" * times)]
            if fault != 2:
                to = NEXT.get((state, role))
                if to is not None:
                    ways.append((to, self.keep + extra, "K"))
                ways.append((NEXT[state, OPEN[state]], self.rerole + extra, OPEN[state]))
            for to, more, edit in ways:
                cost, held = tip[0] + more, best[to]
                if held is None or cost < held[0] or (cost == held[0] and self.before(state, edit, held[1], held[2])):
                    best[to] = (cost, state, edit)
        self.follow(best)
        self.fill()
        self.prune()
        self.most = max(self.most, self.nodes)
        self.settle()

    def follow(self, best: list[tuple[int, int, str] | None]) -> None:
        """Make the best way into each state its survivor; a node that has just one heir is continued by it."""
        heirs = Counter(b[1] for b in best if b is not None)
        tips: list[tuple[int, Node] | None] = [None] * 4
        for to, b in enumerate(best):
            if b is not None:
                node = self.tips[b[1]][1]
                if heirs[b[1]] == 1 and node.refs == 1 and node is not self.root:
                    node.edits.append(b[2])
                    node.refs += 1
                    tips[to] = (b[0], node)
                else:
                    tips[to] = (b[0], self.grow(node, b[2]))
        left = {}
        for x, a in enumerate(best):
            for y, b in enumerate(best):
                if a is not None and b is not None and x <= y:
                    r, s = self.left[a[1], b[1]]
                    r, s = ("", "") if x == y else differ(r + a[2].translate(AUDITED), s + b[2].translate(AUDITED))
                    left[x, y], left[y, x] = (r, s), (s, r)
        old, self.tips, self.left = self.tips, tips, left
        for tip in old:
            if tip is not None:
                self.release(tip[1])

    def prune(self) -> None:
        """Let go of survivors that cannot be part of a cheapest repair, not even of an equal one."""
        for (x, y), more in self.slack.items():
            worse, other = self.tips[x], self.tips[y]
            if worse is not None and other is not None and other[0] + more < worse[0]:
                self.tips[x] = None
                self.release(worse[1])

    def settle(self) -> None:
        """Emit what all survivors share."""
        while self.root.refs == 1 and len(self.root.children) == 1:
            (child,) = self.root.children
            self.out += child.edits
            child.parent, child.edits, self.root = None, [], child
            self.nodes -= 1

    def finish(self) -> int:
        """Emit the rest of the cheapest complete repair; its cost."""
        ends = [state for state in (START, ASSISTANT) if self.tips[state] is not None]
        best = min(ends, key=lambda state: self.tips[state][0])
        if len(ends) == 2 and self.tips[START][0] == self.tips[ASSISTANT][0]:
            best = START if self.before(START, "", ASSISTANT, "") else ASSISTANT
        for state, tip in enumerate(self.tips):
            if tip is not None and state != best:
                self.release(tip[1])
        self.settle()
        return self.tips[best][0]


class Stream:
    """Chunks of one conversation in, their edits out as soon as every edit of a chunk is certain."""

    def __init__(self, costs: Sequence[int]):
        self.search, self.waiting, self.part, self.items = Search(costs), [], "", 0
        self.last, self.illegal = "", 0

    def take(self, chunk: int, letters: str, copies: dict[int, int]) -> Iterator[tuple[int, list[str]]]:
        steps = []
        self.waiting.append((chunk, steps, []))
        for i, letter in enumerate(letters):
            role, fault = LETTERS[letter]
            again = copies.get(i, 0)
            self.illegal += again + (self.last + role not in ("", "su", "ua", "au") and self.last != "")
            self.last = role
            gone = "1234"["suao".index(role)]
            if fault == 2:
                self.search.step(gone, again + 1)
            else:
                self.search.step(letter)
                if again:
                    self.search.step(gone, again)
            steps.append(2 if fault != 2 and again else 1)
        yield from self.settled()

    def settled(self) -> Iterator[tuple[int, list[str]]]:
        """Chunks whose last row is decided; an inserted row goes with the row after it."""
        for edit in self.search.out:
            self.part += edit
            if edit in ("U", "A"):
                continue
            while len(self.waiting[0][2]) == len(self.waiting[0][1]):  # another chunk has begun
                chunk, _, done = self.waiting.pop(0)
                yield chunk, done
            _, steps, done = self.waiting[0]
            self.items += 1
            if self.items == steps[len(done)]:
                done.append(self.part)
                self.part, self.items = "", 0
        self.search.out.clear()

    def finish(self) -> tuple[list[tuple[int, list[str]]], int]:
        """The chunks still held, rows inserted at the end going with the last row, and the cost."""
        cost = self.search.finish()
        left = list(self.settled())
        chunk, _, done = self.waiting[0]
        done[-1] += self.part
        return [*left, (chunk, done)], cost


def damage(rows: DataFrame) -> DataFrame:
    """Lose, empty, clip, repeat or mislabel rows by a hash of conversation and turn; nulls count as one space."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.pmod(F.crc32(name.cast("binary")), F.lit(20))
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    hit = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("_kind")).where("_kind != 0")
    text = F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return hit.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_copy")).drop("_copy")


def messages(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``key`` and ``text``; the key is a 128-bit digest of the text."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return rows.select("conv_id", "turn", role.alias("role"), F.md5(text).alias("key"), text.alias("text"))


def diagnose(rows: DataFrame) -> DataFrame:
    """Rows of a conversation that are equal, as one: ``n`` (its number there), ``copies``, ``fault`` of the first, its ``letter``.

    All copies but the first of a row that is neither blank nor a duplicate are duplicates.
    """
    found = messages(rows)
    end = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    cells = found.select("conv_id", "turn", "role", "key", end.alias("_end")).groupBy("conv_id", "turn", "role", "key").agg(F.count(F.lit(1)).alias("copies"), F.first("_end").alias("_end"))
    numbered = cut_lineage(running_totals(cells, [F.col("turn").asc_nulls_first(), F.col("role"), F.col("key")], "n", partition_by=["conv_id"]))
    first = numbered.groupBy("conv_id", "role", "key").agg(F.min("n").alias("_n"))
    first = first.select(F.col("conv_id").alias("_conv"), "_n", F.lit(True).alias("_first"))
    marked = numbered.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("n") == F.col("_n")), "left")
    fault = F.when(F.col("_end") == "", "blank").when(F.col("_first").isNull(), "duplicate").when(~F.col("_end").isin(".", "!", "?"), "truncated").otherwise("")
    initial = F.instr(F.lit("sua"), F.substring("role", 1, 1))
    place = F.when((initial == 0) | (F.col("role") == ""), 4).otherwise(initial)
    letters = F.when(F.col("fault") == "", F.lit("suao")).when(F.col("fault") == "truncated", F.lit("SUAO")).otherwise(F.lit("1234"))
    faulted = marked.select("conv_id", "turn", "role", "key", "n", "copies", fault.alias("fault"))
    return cut_lineage(faulted.withColumn("letter", F.substring(letters, place, F.lit(1))))


def search(cells: DataFrame, costs: Sequence[int] = (KEEP, REROLE, DELETE, INSERT, TRUNCATED)) -> DataFrame:
    """``conv_id``, ``chunk`` and ``edits`` of its rows; the last chunk of a conversation has its ``cost`` and its ``illegal`` pairs."""
    spark = cells.sparkSession
    small_batches(spark)
    one = F.struct("n", "letter", "copies")
    grouped = cells.groupBy("conv_id", F.floor((F.col("n") - 1) / CHUNK).alias("chunk")).agg(F.array_sort(F.collect_list(one)).alias("r"))  # CHUNK rows at most
    several = F.filter(F.transform("r", lambda r, i: F.struct(i.alias("i"), (r["copies"] - 1).alias("more"))), lambda r: r["more"] > 0)
    chunks = grouped.select("conv_id", "chunk", F.array_join(F.transform("r", lambda r: r["letter"]), "").alias("letters"), several.alias("several"))
    kind = cells.schema["conv_id"].dataType.simpleString()
    shape = f"conv_id {kind}, chunk long, edits array<string>, cost long, illegal long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, stream, rows, held = None, None, [], 0

        def put(chunk: int, edits: list[str], cost: int | None = None, illegal: int | None = None) -> None:
            nonlocal held
            rows.append({"conv_id": now, "chunk": chunk, "edits": edits, "cost": cost, "illegal": illegal})
            held += len(edits)

        def close() -> None:
            left, cost = stream.finish()
            for chunk, edits in left[:-1]:
                put(chunk, edits)
            put(*left[-1], cost, stream.illegal)

        for batch in batches:
            fields = pa.schema([("conv_id", batch.schema.field(0).type), *FOUND])
            for conv, chunk, letters, several in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if stream is None or conv != now:
                    if stream is not None:
                        close()
                    now, stream = conv, Stream(costs)
                for done in stream.take(chunk, letters, {s["i"]: s["more"] for s in several}):
                    put(*done)
                if held > 100_000:
                    yield pa.RecordBatch.from_pylist(rows, fields)
                    rows, held = [], 0
        if stream is not None:
            close()
            yield pa.RecordBatch.from_pylist(rows, fields)

    ordered = chunks.repartition(shuffle_tasks(spark), "conv_id").sortWithinPartitions("conv_id", "chunk")
    return cut_lineage(ordered.mapInArrow(run, shape))


def edited(cells: DataFrame, found: DataFrame) -> DataFrame:
    """``cells`` with ``edits``: what is done to each of the equal rows, and which rows are inserted around them."""
    each = found.select(F.col("conv_id").alias("_conv"), "chunk", F.posexplode("edits").alias("_i", "edits"))
    each = each.select("_conv", (F.col("chunk") * CHUNK + F.col("_i") + 1).alias("_n"), "edits")
    return cells.join(each, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("n") == F.col("_n"))).drop("_conv", "_n")


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``n`` and ``place`` (their order), ``role`` and ``text``."""
    kept = edits.where(F.col("edits").rlike("[^D]"))
    texts = messages(rows).dropDuplicates(["conv_id", "turn", "role", "key"])
    same = [kept[c].eqNullSafe(texts[c]) for c in ("conv_id", "turn", "role", "key")]
    joined = kept.join(texts, same).select(kept["conv_id"], kept["n"], kept["role"], texts["text"], kept["edits"])
    letters = F.filter(F.split("edits", ""), lambda e: ~e.isin("D", ""))
    role = lambda e: F.when(e == "K", F.col("role")).when(F.lower(e) == "u", F.lit("user")).otherwise(F.lit("assistant"))
    line = F.transform(letters, lambda e: F.struct(role(e).alias("role"), F.when(e.isin("U", "A"), F.lit("")).otherwise(F.col("text")).alias("text")))
    return joined.select("conv_id", "n", F.posexplode(line).alias("place", "_line")).select("conv_id", "n", "place", "_line.role", "_line.text")


def hashes(lines: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines.

    The digest of a conversation has to read its lines in order: they pass through one task as a stream, one batch at a time.
    """
    spark = lines.sparkSession
    small_batches(spark)
    kind = lines.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            fields = pa.schema([("conv_id", batch.schema.field(0).type), ("repaired_sha256", pa.string())])
            done = []
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if digest is not None and conv == now:
                    digest.update(b"\n")
                else:
                    if digest is not None:
                        done.append({"conv_id": now, "repaired_sha256": digest.hexdigest()})
                    now, digest = conv, hashlib.sha256()
                digest.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_pylist(done, fields)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": now, "repaired_sha256": digest.hexdigest()}], fields)

    ordered = lines.repartition(shuffle_tasks(spark), "conv_id").sortWithinPartitions("conv_id", "n", "place")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def digest(original: DataFrame) -> DataFrame:
    """Damage, diagnosis, cost, audit and digest of the repair of every conversation."""
    rows = damage(original)
    cells = diagnose(rows)
    found = search(cells)
    copies = F.col("copies")
    ok = lambda fault: F.col("fault") == fault
    again = F.when(ok("blank"), 0).when(ok("duplicate"), copies).otherwise(copies - 1)
    turns = cells.groupBy("conv_id", "turn").agg(
        F.sum(F.when(ok("blank"), copies).otherwise(0)).alias("blank"), F.sum(again).alias("duplicate"), F.sum(F.when(ok("truncated"), 1).otherwise(0)).alias("truncated"),
    )
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    counts = turns.groupBy("conv_id").agg(gaps.alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    part = F.translate(F.array_join("edits", ""), SHOWN, AUDIT)
    # one string per conversation is what the audit is; chunks are joined as they are
    audits = found.groupBy("conv_id").agg(F.max("cost").alias("cost"), F.max("illegal").alias("illegal"), F.array_sort(F.collect_list(F.struct("chunk", part.alias("part")))).alias("_parts"))
    audits = audits.select("conv_id", "cost", "illegal", F.array_join(F.transform("_parts", lambda p: p["part"]), "").alias("audit"))
    parts = [original.select("conv_id").distinct(), counts, audits, hashes(repaired(rows, edited(cells, found)))]
    united = parts[0]
    for more in parts[1:]:
        united = united.unionByName(more, allowMissingColumns=True)
    number = [F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return united.groupBy("conv_id").agg(*number, F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256"))
