"""Merkle manifest, conversation repair and sequence packing against brute force."""

import hashlib
import math
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from compare import compare, connect
from tokenizers import Tokenizer

from lakeprofile.llm import best_fit_packing, conversation_repair, merkle_manifest
from lakeprofile.llm.queries import QUERIES
from lakeprofile.session import work_path
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash string, member string, root string, at int"


# Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(leaves):
    """The root, and each leaf's siblings by level."""
    paths, owners, level = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(level) > 1:
        above, own = [], []
        for at in range(0, len(level), 3):
            run = level[at : at + 3]
            for i in range(len(run)):
                for leaf in owners[at + i]:
                    paths[leaf].append((run[:i], run[i + 1 :]))
            above.append(sha(*run))
            own.append([x for o in owners[at : at + 3] for x in o])
        level, owners = above, own
    return level[0], paths


def brute_manifest(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    subs = []
    for name in names:
        sources[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        subs.append(tree([leaf_of(r) for r in sources[name]]))
    root, tops = tree([s for s, _ in subs])
    out = []
    for name, (sub, paths), top in zip(names, subs, tops, strict=True):
        for row, path in zip(sources[name], paths, strict=True):
            doc_id, source, lang, n, text = row
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node, every = leaf_of((doc_id, source, lang, n, text)), []
            for before, after in path + top:
                node = sha(*before, node, *after)
                every += before + after
            out.append((doc_id, leaf_of(row), sub, root, sha(*every), node, node == root))
    return sorted(out, key=repr)


def manifest_rows(df):
    return sorted((tuple(r) for r in merkle_manifest.digest(df).collect()), key=repr)


@pytest.fixture(scope="module")
def leaves(spark):
    rng, rows = random.Random(3), []
    for source, n in [(None, 4), ("", 1), ("b", 2), ("a", 3), ("é", 5), ("Z", 9), ("z", 10), ("m", 28), ("k", 82), ("q", 1)]:
        for _ in range(n):
            text = rng.choice([None, "", "\n", "one\ntwo", "é\n" * 3, "x", f"t{rng.randrange(9)}\n"])
            rows.append((rng.choice([None, 1, 2, 2, rng.randrange(10**6), -5]), source, rng.choice([None, "en"]), rng.choice([None, 0, 7]), text))
    rows += [(7, "a", "en", 1, "same\n")] * 3 + [(8, "a", None, None, "é" * 100_000 + "\n")]
    frame = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], "x", "y", "z", 1) for r in rows], DOCS)
    return rows, frame


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_manifest(leaves, monkeypatch, levels):
    monkeypatch.setattr(merkle_manifest, "LEVELS", levels)
    rows, frame = leaves
    assert manifest_rows(frame) == brute_manifest(rows)


def test_manifest_does_not_depend_on_partitions(leaves):
    rows, frame = leaves
    assert manifest_rows(frame.repartition(13)) == manifest_rows(frame.coalesce(1))


def test_manifest_sql(spark):
    ok, note = compare("op11", QUERIES["op11_merkle_manifest"](spark, SF), connect(SF), merkle_manifest.oracle())
    assert ok, note


def test_manifest_odd(spark, leaves):
    _, frame = leaves
    assert merkle_manifest.digest(frame.limit(0)).collect() == []
    (only,) = merkle_manifest.digest(spark.createDataFrame([(3, "a\nb", None, None, None, "", "", "", 0)], DOCS)).collect()
    assert only.leaf == only.subroot == only.root and only.proof_sha256 == sha("")
    same = merkle_manifest.manifest(frame)
    assert same.columns == ["doc_id", "source", "leaf", "subroot", "root", "proof"]
    assert same.where(merkle_manifest.folded(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0


# conversation repair

TURNS = "conv_id long, turn long, role string, text string, n int, edits string, key string"
NEXT = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("A", "u"): "U", ("U", "a"): "A"}


def cheapest(rows, costs):
    """(cost, audit, edits) over all repairs of (initial, fault) rows; whole strings are compared."""
    keep, rerole, delete, insert, extra = costs

    @lru_cache(None)
    def best(i, state, inserted):
        found = []
        if i == len(rows) and state in "EA":
            found.append((0, "", ""))
        for role in "ua" if inserted < 3 else "":
            if (state, role) in NEXT and (rest := best(i, NEXT[state, role], inserted + 1)):
                found.append((insert + rest[0], "I" + rest[1], role.upper() + rest[2]))
        if i < len(rows):
            initial, fault = rows[i]
            if rest := best(i + 1, state, 0):
                found.append((delete + rest[0], "D" + rest[1], "D" + rest[2]))
            if fault < 2:
                if (state, initial) in NEXT and (rest := best(i + 1, NEXT[state, initial], 0)):
                    found.append((keep + fault * extra + rest[0], "K" + rest[1], "K" + rest[2]))
                for role in "ua":
                    if (state, role) in NEXT and (rest := best(i + 1, NEXT[state, role], 0)):
                        found.append((rerole + fault * extra + rest[0], "R" + rest[1], role + rest[2]))
        return min(found) if found else None

    return best(0, "E", 0)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute_repair(rows):
    rows = sorted(rows, key=lambda m: (m[1] is not None, m[1] or 0, m[2], hashlib.md5(m[3].encode()).hexdigest()))
    seen, faults, names = set(), [], []
    for _, _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        names.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        faults.append({"": 0, "truncated": 1}.get(names[-1], 2))
        seen.add((role, text))
    first = [m[2][:1] for m in rows]
    cost, audit, edits = cheapest(tuple(zip(first, faults, strict=True)), (0, 1, 2, 5, 5))
    lines, at = [], iter(rows)
    for edit in edits:
        _, _, role, text = next(at) if edit not in "UA" else (0, 0, "", "")
        if edit != "D":
            lines.append(({"u": "user", "a": "assistant"}.get(edit.lower(), role)) + ":" + text)
    turns = [m[1] for m in rows if m[1] is not None]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[names.count(k) for k in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False)), cost, audit, sha("\n".join(lines)),
    )


def brute_conversations(rows):
    held = {row[0]: [] for row in rows}
    for row in damaged(rows):
        held[row[0]].append(row)
    return sorted(((c, *brute_repair(m)) for c, m in held.items()), key=repr)


def repaired(df):
    return sorted((tuple(r) for r in conversation_repair.digest(df).collect()), key=repr)


def with_clashes(spark, rows):
    return spark.createDataFrame([(*r, 1, "e", "k") for r in rows], TURNS)


@pytest.mark.parametrize("chunk", [4096, 3])
def test_repair(spark, monkeypatch, chunk):
    monkeypatch.setattr(conversation_repair, "CHUNK", chunk)
    rng, rows = random.Random(5), []
    for conv in range(150):
        for i in range(rng.randrange(1, 14)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "s"])
            text = rng.choice(["Hi.", "Hi", "Yes?", "a b", "  ", "", None, "Long text here!  \n", f"x{rng.randrange(20)}."])
            rows.append((conv if rng.random() < 0.97 else None, rng.choice([i, i, i, None, rng.randrange(15)]), role, text))
    assert repaired(with_clashes(spark, rows)) == brute_conversations(rows)


def test_repair_given_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    assert repaired(df) == brute_conversations([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_repair_odd(spark):
    assert repaired(with_clashes(spark, [])) == []
    rows = [(1, None, None, None), (None, None, None, None), (2, 0, "user", "é" * 200_000), (2, 1, "assistant", "w " * 100_000 + ".")] + [(3, 1, "user", "Same.")] * 100
    assert repaired(with_clashes(spark, rows)) == brute_conversations(rows)


def test_repair_of_a_hot_conversation(spark):
    """One conversation over several chunks; its edits come out chunk by chunk."""
    rng = random.Random(9)
    rows = [(5, i, rng.choice(["user", "assistant"]), f"Row {i}" + rng.choice([".", ".", ".", ""])) for i in range(9_000)] + [(6, 0, "user", "Hi."), (6, 1, "assistant", "Yes.")]
    got = {r.conv_id: r for r in conversation_repair.digest(with_clashes(spark, rows)).collect()}
    hot = sorted((m for m in damaged(rows) if m[0] == 5), key=lambda m: m[1])
    search = conversation_repair.Search()
    seen = set()
    for _, _, role, text in hot:
        fault = 2 if not text or (role, text) in seen else 0 if text[-1] == "." else 1
        seen.add((role, text))
        search.step({v: k for k, v in conversation_repair.LETTERS.items()}[role[0], fault])
    cost = search.finish()
    assert (got[5].cost, got[5].audit) == (cost, "".join(search.out).translate(conversation_repair.AUDITED))
    assert len(got[5].audit) == len(hot)


@pytest.mark.parametrize("costs", [(0, 1, 2, 5, 5), (0, 1, 2, 1, 1), (0, 1, 1, 1, 0), (0, 2, 2, 1, 3), (1, 1, 1, 1, 1)])
def test_search(costs):
    """Every cost and audit as over all repairs, also where inserted rows are cheap."""
    for seed in range(400):
        rng = random.Random(seed)
        rows = [(rng.choice("suao"), rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randrange(0, 12))]
        search = conversation_repair.Search(costs)
        for role, fault in rows:
            search.step({v: k for k, v in conversation_repair.LETTERS.items()}[role, fault])
        cost = search.finish()
        assert (cost, "".join(search.out).translate(conversation_repair.AUDITED)) == cheapest(tuple(rows), costs)[:2], (seed, rows)


def test_search_holds_the_unresolved_part_only():
    rng = random.Random(1)
    search = conversation_repair.Search()
    for _ in range(50_000):
        search.step(rng.choice("ua"))
    assert search.most < 20 and len(search.out) > 49_000
    for _ in range(50_000):  # the number of rows decides about the first one
        search.step("u")
    assert search.most < 20
    search.step("1", 10**6)
    search.finish()
    assert sum(map(len, search.out)) >= 100_000 + 10**6


# packing


def packed(spark, df, **settings):
    path = work_path(spark, "packing")
    best_fit_packing.pack(df, path, **settings)
    return path, best_fit_packing.read_pieces(spark, path)


def check_sequences(pieces, tokens):
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for members in by_sequence.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= tokens
    return by_sequence


@lru_cache(None)
def ids_of(text, tokenizer=Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("tokens, settings", [(4096, {}), (64, {"group_pieces": 64, "fan_in": 4}), (64, {"rule": "dot"}), (64, {"documents": 3}), (64, {"attention": 4096 * 0.6, "documents": 5})])
def test_packing(spark, tokens, settings):
    texts = [(i, t) for i, t in enumerate(["", None, "one", "\n \t", "é" * 50, "w " * 20_000, "A b. c!" * 40])]
    texts += [(7, "same text"), (7, "same text"), (None, "no id"), (None, None)] + [(100 + i, "word " * (i * 37 % 90)) for i in range(300)]
    if "attention" in settings:  # a whole sequence would cost too much
        texts = [(i, t) for i, t in texts if len(ids_of(t)) <= 40]
    df = spark.createDataFrame([(i, t, "key", 5) for i, t in texts], "doc_id long, text string, key string, length int")
    path, found = packed(spark, df, tokens=tokens, **settings)
    pieces = found.collect()
    sequences = check_sequences(pieces, tokens)
    for members in sequences.values():
        assert len(members) <= settings.get("documents", tokens)
        assert sum(p.length**2 for p in members) <= settings.get("attention", tokens**2)
    want = sorted((repr(i), k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())) for i, t in texts for ids in [ids_of(t)] for k, at in enumerate(range(0, len(ids), tokens)) for part in [ids[at : at + tokens]])
    assert sorted((repr(p.doc_id), p.piece, p.start, p.length, p.ids_crc32) for p in pieces) == want
    for row in best_fit_packing.sequences(spark, path).collect():
        members = sorted(sequences[row.sequence_id], key=lambda p: p.offset)
        assert bytes(row.ids) == b"".join(bytes(p.ids) for p in members) and row.offsets == [p.offset for p in members] and row.doc_ids == [p.doc_id for p in members]
    least = math.ceil(sum(p.length for p in pieces) / tokens)
    if "documents" not in settings:
        assert len(sequences) <= least * 1.02 + 1, (len(sequences), least)


def test_packing_given_table(spark):
    rows = QUERIES["op13_best_fit_packing"](spark, SF)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = rows.collect()
    sequences = check_sequences(rows, 4096)
    assert len(sequences) == math.ceil(sum(r.length for r in rows) / 4096)


def test_best_fit_takes_the_tightest():
    bins = lambda lengths, **kw: best_fit_packing.best_fit(np.array(lengths), kw.get("capacity", (10, 10, 100)), kw.get("weights", (1, 0, 0)), kw.get("rule", "norm")).tolist()
    assert bins([7, 6, 3]) == [0, 1, 0]
    assert bins([7, 6, 3], rule="dot") == [0, 1, 1]
    assert bins([2, 2, 2], capacity=(10, 2, 100)) == [0, 0, 1]
    assert bins([5, 5], capacity=(10, 10, 40)) == [0, 1]
    assert bins([]) == []
    with pytest.raises(ValueError):
        bins([9], capacity=(10, 10, 80))


def test_packing_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    path, found = packed(spark, df)
    assert found.collect() == [] and best_fit_packing.sequences(spark, path).collect() == []
