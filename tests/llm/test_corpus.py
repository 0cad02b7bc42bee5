"""The other operators against brute force on small fixtures."""

import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from compare import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from lakeprofile.llm import components, language_fusion, length_histogram, line_rules, nbsvm, pivotal_mix, popcount_simhash, repair_tokens, spaced_seeds
from lakeprofile.llm.queries import QUERIES
from lakeprofile.session import work_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, fingerprint string, size int, key int, root int"
FULL = "Nothing said. " * 30
ODD = [(None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three"), (6, "one two three four five"), (6, "one two three four five"), (7, "é" * 30_000), (8, "w " * 30_000), (9, FULL)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, None, None, "clash", "clash", 1, 2, 3) for i, t in ODD]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def empty(df):
    return df.limit(0)


# line rules


def test_line_rules_odd(spark, odd):
    got = sorted((r.doc_id or 0, r.n_words, r.n_repeat_words, r.kept) for r in line_rules.measure_lines(odd).collect())
    assert got[:3] == [(0, 0, 0, False), (1, 0, 0, False), (2, 0, 0, False)]
    assert (8, 30_000, 30_000, False) in got and (4, 1, 0, False) in got
    assert line_rules.measure_lines(empty(odd)).count() == 0


def test_line_rules_verdicts(spark):
    body = "\n".join(" ".join(f"word{12 * i + k}" for k in range(12)) + "." for i in range(8))
    nav = " | ".join(["Home"] * 30)
    rows = [(1, body), (2, body + "\n" + "All rights reserved."), (3, nav + " |\n" + nav + " Start |\n" + body[:80]), (4, "\n".join(["BUY!! NOW!! THIS!! " * 9 + str(i) for i in range(9)]))]
    got = {r.doc_id: r for r in line_rules.measure_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept and got[1].n_removed_lines == 0 and got[1].clean_text == body
    assert got[2].kept and got[2].clean_text == body
    assert not got[3].kept and not got[4].kept


def test_line_rules_sql(spark):
    ok, note = compare("op2", QUERIES["op2_line_rules"](spark, SF), connect(SF), line_rules.oracle())
    assert ok, note


# classifier


def test_quality_held_out(spark, docs):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op3_nbsvm"](spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    test = got[got.held_out]
    assert (test.predicted == test.quality).mean() > 0.95 and ((got.score >= 0.5) == (got.predicted == 1)).all()
    assert got.score.between(0, 1).all()


def test_quality_odd(spark, odd, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", F.lit("clash").alias("text"))
    assert nbsvm.score_quality(odd, labels).count() == len(ODD)
    assert nbsvm.score_quality(empty(odd), labels).count() == 0
    assert {r.score for r in nbsvm.score_quality(odd, empty(labels)).collect()} == {0.5}


def test_dual_coordinate_descent():
    """The fit reaches the optimum of the primal problem that plain subgradient steps approach."""
    luck = np.random.default_rng(0)
    rows = [np.unique(luck.integers(0, 12, 5)) + (0 if i % 2 else 6) for i in range(60)]
    good = np.array([i % 2 for i in range(60)])
    weight, bias = nbsvm.fit(rows, good, cost=0.1, passes=400)
    ratio = nbsvm.log_ratios(rows, good, 1.0)
    x = np.zeros((60, nbsvm.SLOTS))
    for i, s in enumerate(rows):
        x[i, s] = ratio[s]
    used = np.flatnonzero(np.abs(x).sum(axis=0))
    x, y = np.c_[x[:, used], np.ones(60)], np.where(good == 1, 1.0, -1.0)
    bound = 0.1 * 60 / 60

    def loss(v):
        return 0.5 * v @ v + bound * np.maximum(0, 1 - y * (x @ v)).sum()

    mine = np.r_[np.divide(weight[used], ratio[used], out=np.zeros(len(used)), where=ratio[used] != 0), bias]
    v, best = np.zeros(x.shape[1]), np.inf
    for t in range(1, 20_000):
        v = v - (v - bound * x.T @ (y * (y * (x @ v) < 1))) / (t + 10)
        best = min(best, loss(v))
    assert loss(mine) <= best * 1.01


# SimHash


def plain_print(text):
    table = str.maketrans(popcount_simhash.UPPER, popcount_simhash.LOWER)
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", (text or "").translate(table)) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    digests = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in digests) > len(digests))


def plain_components(points, least, bits=4):
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in points:
        for b in points:
            if a < b and (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    ids = {}
    for p in points:
        ids.setdefault(find(p), []).append(least[p])
    return {p: min((i for i in ids[find(p)] if i is not None), default=None) for p in points}


def test_simhash(spark, docs, odd):
    both = docs.select("doc_id", "text").union(odd.select(F.col("doc_id") + 10**6, "text"))
    got = popcount_simhash.digest(popcount_simhash.near_duplicates(both)).collect()
    want = {}
    rows = both.collect()
    for r in rows:
        want.setdefault(plain_print(r.text), []).append(r.doc_id)
    least = {p: min((i for i in ids if i is not None), default=None) for p, ids in want.items()}
    groups = plain_components(list(want), least)
    expected = sorted((r.doc_id or -1, f"{plain_print(r.text):016x}", groups[plain_print(r.text)]) for r in rows)
    assert sorted((r.doc_id or -1, r.fingerprint, r.component_id) for r in got) == expected
    assert popcount_simhash.near_duplicates(empty(odd)).count() == 0


@pytest.mark.parametrize("cell_rows", [4096, 20])
def test_links_of_dense_and_sparse_points(spark, cell_rows):
    """Chains, a dense cluster and noise; small cells force the dealing by blocks."""
    luck = random.Random(1)
    points = {luck.getrandbits(64) for _ in range(300)}
    centre = luck.getrandbits(64)
    for _ in range(300):
        p = centre
        for b in luck.sample(range(64), luck.randint(0, 5)):
            p ^= 1 << b
        points.add(p)
    chain = luck.getrandbits(64)
    for step in range(15):
        points.add(chain)
        for b in luck.sample(range(64), 4):
            chain ^= 1 << b
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in points]
    edges = popcount_simhash.links(spark.createDataFrame(signed, "fingerprint long"), cell_rows=cell_rows)
    roots = {r.node: r.root for r in components.components(edges).collect()}
    want = plain_components(list(points), {p: p for p in points})
    sign = lambda p: p - (1 << 64) if p >> 63 else p
    mine, theirs = {}, {}
    for p in points:
        mine.setdefault(roots.get(sign(p), sign(p)), set()).add(p)
        theirs.setdefault(want[p], set()).add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_keep_one(spark, odd):
    kept = popcount_simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == sorted({r.component_id for r in popcount_simhash.near_duplicates(odd).collect()})


def test_keep_one_per_component(spark):
    """Null ids and ids that are shared by different texts lose no component."""
    luck = random.Random(4)
    text = lambda: " ".join(luck.choice("abcdefghijklmnop") * luck.randint(1, 9) for _ in range(40))
    texts = [text() for _ in range(12)]
    rows = [(None, t, "x") for t in texts[:6]] + [(None, texts[0], "x"), (None, texts[0], "y"), (5, texts[1], "x"), (5, texts[7], "x"), (5, texts[8], "x"), (4, texts[8], "x"), (9, texts[9], "x")]
    kept = popcount_simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    want = [(None, texts[i]) for i in (0, 2, 3, 4, 5)] + [(5, texts[1]), (5, texts[7]), (4, texts[8]), (9, texts[9])]
    assert sorted(((r.doc_id or 0, r.text) for r in kept.collect())) == sorted((i or 0, t) for i, t in want)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(100, 105), (105, 101)], "u long, v long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(71)}, 100: 100, 101: 100, 105: 100}


# tokens


@pytest.mark.parametrize("texts", [[t for _, t in ODD] + ["Don't stop. it's,we'll!x <|endoftext|>. a\x01b \x01", "H̱i. ΑΣ. É.é̇. é.", "1,234.5% a.b.c $$$..,", "foo​.bar ſ.ß. İ.ı, ŉ."]])
def test_tokens_round_trip(spark, docs, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = list(enumerate(texts)) + [(100 + r.doc_id, r.text) for r in docs.collect()]
    path = work_path(spark, "tokens")
    repair_tokens.write_tokens(spark.createDataFrame(rows[::-1], "doc_id long, text string"), path, block_tokens=5_000, least=4)
    got = {r.doc_id: r for r in repair_tokens.read_tokens(spark, path).collect()}
    at = 0
    for i, text in rows:
        ids = np.array([*own.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes())), text
        at += len(ids)
    stored = spark.read.parquet(path).collect()
    assert sum(len(r.symbols) for r in stored) < 2 * at
    for row in stored[:3]:
        block = repair_tokens.Block(row.rules, row.lengths, row.symbols, row.wide, row.marks)
        whole = block.ids()
        for low, high in ((0, 10), (1_000, 4_000), (len(whole) - 3, len(whole)), (7, 7), (0, len(whole))):
            assert (block.part(low, high) == whole[low:high]).all()


def test_special_tokens_keep_their_case():
    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["<|ENDOFTEXT|>", "a <|EndOfText|> b", "x<|StartOfText|>Y.", "<|endoftext|> <|ENDOFTEXT|>", "PLAIN <| Words|>", "<|STARTOFTEXT|>"]
    ids, sizes = repair_tokens.text_ids(pa.array(texts), "word_bpe_49k.json")
    want = [own.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_tokens_empty(spark, odd):
    path = work_path(spark, "tokens")
    repair_tokens.write_tokens(empty(odd), path)
    assert repair_tokens.read_tokens(spark, path).count() == 0


def test_equal_rows_are_dealt_to_many_chunks(spark):
    """Half of all rows are equal (null id, one text); no chunk holds them all and the target is met as before."""
    equal = spark.range(20_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'a' AS source", "'two words' AS text")
    other = spark.range(20_000).selectExpr("id AS doc_id", "if(id % 2 = 0, 'a', 'b') AS source", "concat_ws(' ', 'w', 'x', id) AS text")
    docs = equal.unionAll(other)
    got = pivotal_mix.drawn(docs, chunk_rows=1_000)
    assert got.count() == 40_000
    copies = got.where("doc_id IS NULL").groupBy("copies").count().collect()
    assert sum(r["count"] for r in copies) == 20_000 and len(copies) <= 2
    for r in got.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r["taken"] - r["target"]) <= 3
    again = pivotal_mix.drawn(docs.repartition(3), chunk_rows=1_000)
    assert got.exceptAll(again).isEmpty() and again.exceptAll(got).isEmpty()


# decontamination


def test_spaced_seeds_of_long_items_and_long_texts(spark):
    """An item of 20,000 words with a copy, a text of 60,000 words with a short overlap, both ways; work is linear in either."""
    words = [f"w{i * 7919 % 1000003}" for i in range(60_000)]
    replaced = [w if i % 50 else "other" for i, w in enumerate(words[:20_000])]
    docs = spark.createDataFrame([(1, " ".join(replaced)), (2, " ".join(words))], "doc_id long, text string")
    bench = spark.createDataFrame([("long", " ".join(words[:20_000])), ("short", " ".join(words[50_000:50_040]))], "item_id string, text string")
    for broadcast_seeds in (0, 1_000_000):
        got = {(r.doc_id, r.item_id): (r.matched_words, r.first_word) for r in spaced_seeds.contaminated(docs, bench, broadcast_seeds=broadcast_seeds).collect()}
        assert got == {(1, "long"): (19_600, 1), (2, "long"): (20_000, 0), (2, "short"): (40, 50_000)}


def test_spaced_seeds_of_two_texts_under_one_item_id(spark):
    first, second = (" ".join(f"{c}{i}" for i in range(20)) for c in "ab")
    bench = spark.createDataFrame([("x", first), ("x", second), (None, first)], "item_id string, text string")
    docs = spark.createDataFrame([(1, first), (2, second), (None, first), (None, first)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.item_id or "", r.matched_words) for r in spaced_seeds.contaminated(docs, bench).collect())
    assert got == [(0, "", 20), (0, "x", 20), (1, "", 20), (1, "x", 20), (2, "x", 20)]


def test_spaced_seeds(spark):
    luck = random.Random(2)
    word = lambda: "".join(luck.choice("abcdefgh") for _ in range(5))
    item = [word() for _ in range(30)]
    other = [word() for _ in range(30)]
    noise = lambda n: [word() for _ in range(n)]
    edited = list(item)
    for i in (5, 13, 21):
        edited[i] = "changed"
    rows = [
        (1, noise(50) + item + noise(50)), (2, noise(20) + edited + noise(5)), (3, noise(200)), (4, noise(10) + item[:9] + noise(10)),
        (5, [w.upper() + "," for w in item]), (6, noise(5) + item[10:24] + noise(9)), (7, item[:14] + noise(3) + other), (8, []),
    ]
    docs = spark.createDataFrame([(i, " ".join(w), 1, 2) for i, w in rows] + [(None, None, 1, 2)], "doc_id long, text string, words int, at int")
    bench = spark.createDataFrame([(10, " ".join(item), 1), (11, " ".join(other), 1), (12, "too short", 1), (13, None, 1)], "item_id long, text string, words int")
    for broadcast_seeds in (1_000_000, 0):
        got = {(r.doc_id, r.item_id): (r.matched_words, r.overlap_words) for r in spaced_seeds.contaminated(docs, bench, broadcast_seeds=broadcast_seeds).collect()}
        assert got == {(1, 10): (30, 30), (2, 10): (27, 30), (5, 10): (30, 30), (6, 10): (14, 14), (7, 10): (14, 14), (7, 11): (30, 30)}
    kept = spaced_seeds.decontaminate(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {None, 3, 4, 8}
    assert spaced_seeds.contaminated(docs, empty(bench)).count() == 0 and spaced_seeds.contaminated(empty(docs), bench).count() == 0


def test_more_copied_text_hides_nothing(spark):
    """A stretch that is caught alone is caught behind a shorter one with a higher score, too."""
    item = [f"i{k}" for k in range(40)]
    edited = item[:9] + ["x"] * 3 + item[12:17] + ["x"] + item[18:23]
    close = item[:9] + ["x"] * 2 + item[11:16] + ["x"] + item[17:20] + ["x"] + item[21:23] + ["x"] * 9
    rows = [(1, edited), (2, edited[12:]), (3, edited[:12]), (4, close)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: (r.matched_words, r.overlap_words, r.first_word) for r in spaced_seeds.contaminated(docs, bench).collect()}
    assert got == {1: (10, 11, 12), 2: (10, 11, 0), 4: (19, 23, 0)}
    assert {r.doc_id for r in spaced_seeds.decontaminate(docs, bench).collect()} == {3}


def test_short_items_and_scripts_without_blanks(spark):
    """Items shorter than every mask match whole; Chinese and Japanese texts match by their letters."""
    chinese, japanese = "长江是亚洲最长的河流全长约六千三百公里", "富士山は日本で一番高い山です"
    rows = [
        (1, "so what is the capital of France they asked"), (2, "what is the capital of Spain"), (3, "of France"), (4, "The answer: forty-two!"),
        (5, f"据说{chinese}。"), (6, f"{japanese}とても"), (7, "长江很长"), (8, ""), (9, "什么是人"),
    ]
    items = [(20, "What is the capital of France?"), (21, "forty two"), (22, chinese), (23, japanese), (24, "什么是"), (25, "..."), (26, "of france")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for broadcast_seeds in (1_000_000, 0):
        got = {(r.doc_id, r.item_id): (r.matched_words, r.first_word) for r in spaced_seeds.contaminated(docs, bench, broadcast_seeds=broadcast_seeds).collect()}
        assert got == {(1, 20): (6, 1), (1, 26): (2, 5), (3, 26): (2, 0), (4, 21): (2, 2), (5, 22): (len(chinese), 2), (6, 23): (len(japanese), 0), (9, 24): (3, 0)}
    assert {r.doc_id for r in spaced_seeds.decontaminate(docs, bench).collect()} == {2, 7, 8}


# token counts


def test_length_histogram(spark, docs, odd):
    both = docs.select("text").union(odd.select("text"))
    encoding = length_histogram.byte_encoding(length_histogram.vocabulary("byte_bpe_50k.tiktoken"))
    lengths = [len(encoding.encode_ordinary(r.text or "")) for r in both.collect()]
    table = length_histogram.length_histogram(both, width=64)
    for r in table.collect():
        assert r.n_docs == lengths.count(r.length)
        assert r.docs_longer == sum(n > r.length for n in lengths) and r.tokens_longer == sum(n for n in lengths if n > r.length)
        assert r.truncated_tokens == sum(min(n, r.length) for n in lengths)
    assert length_histogram.truncated_total(table, 333).first()[0] == sum(min(n, 333) for n in lengths)
    middle = length_histogram.quantile(table, 0.5).first()[0]
    assert sum(n <= middle for n in lengths) * 2 >= len(lengths) > sum(n < middle for n in lengths) * 2
    assert length_histogram.length_histogram(empty(odd)).count() == 0


# mixing


def brute_targets(sizes, weights, most):
    """Shares by weight, full sources taken out again and again."""
    full = {}
    while True:
        free = [i for i in range(len(sizes)) if i not in full]
        level = (sum(sizes) - sum(full.values())) / sum(weights[i] for i in free) if free else 0.0
        above = [i for i in free if level * weights[i] > most * sizes[i] * (1 + 1e-12)]
        if not above:
            return [full.get(i, level * weights[i]) for i in range(len(sizes))]
        full.update({i: most * sizes[i] for i in above})


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 50, 1000, 3], [5, 5, 900, 2, 700, 1, 1], [0, 10, 10]])
def test_targets(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
    rows = spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, size long")
    got = {r.source: r.target for r in pivotal_mix.targets(rows).collect()}
    want = brute_targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))], 3.0)
    assert [got[n] for n in names] == pytest.approx(want)


def test_mix(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first, again = (pivotal_mix.drawn(docs.repartition(n), chunk_rows=20, fan_in=3).toPandas() for n in (3, 5))
    assert sorted(map(tuple, first.to_numpy().tolist())) == sorted(map(tuple, again.to_numpy().tolist()))
    assert len(first) == 1000 and first.copies.between(0, 3).all()
    for _, own in first.groupby("source"):
        rate = own.target.iloc[0] / own["size"].sum()
        assert abs(own.copies.sum() - rate * len(own)) < 1  # the fractions add up
        assert abs((own.copies * own["size"]).sum() - own.target.iloc[0]) < 3 * own["size"].max()
    mixed = pivotal_mix.mix(odd)
    drawn = pivotal_mix.drawn(odd)
    assert mixed.columns == odd.columns and mixed.count() == drawn.agg(F.sum("copies")).first()[0]
    assert drawn.count() == len(ODD) and pivotal_mix.mix(empty(odd)).count() == 0


def test_pivot_keeps_expectations():
    chance = np.array([0.2, 0.5, 0.7, 0.9, 0.3, 0.4])
    total = np.zeros(6)
    for seed in range(4_000):
        luck = np.random.default_rng(seed).random(6)
        out = pivotal_mix.pivot(chance, luck)
        assert abs(out.sum() - chance.sum()) < 1e-9 and ((out > 0) & (out < 1)).sum() <= 1
        total += out
    assert np.abs(total / 4_000 - chance).max() < 0.04


# languages


def test_languages(spark, docs, odd):
    got = {r.doc_id: r for r in language_fusion.identify_documents(docs).collect()}
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert sum(got[i].language == lang[i] for i in lang) > 0.97 * len(lang)
    kept = language_fusion.keep_identified(docs.withColumn("text", F.when(F.col("doc_id") == 0, "#### 123").otherwise(F.col("text"))))
    assert kept.columns == docs.columns and kept.where("doc_id = 0").count() == 0 and kept.count() >= docs.count() - 3
    assert language_fusion.identify_documents(odd).count() == len(ODD) and not any(r.kept for r in language_fusion.identify_documents(odd).collect())
    assert language_fusion.identify_documents(empty(odd)).count() == 0


def test_evidence_beside_the_text(spark):
    """A text too short to tell follows its host; declarations outweigh a weak text."""
    pages = spark.createDataFrame(
        [(i, f"http://www.a{i % 3}.example.de/x", '<html lang="de"><p>der die und nicht das ist') for i in range(60)]
        + [(100 + i, f"http://b{i % 3}.example.fr/x", '<html lang="fr"><p>le la et les des est') for i in range(60)]
        + [(500, "http://a0.example.de/y", "<html><p>x y"), (501, "http://b0.example.fr/y", "<html><p>x y"), (502, None, None)],
        "page_id long, url string, html string",
    )
    train = spark.createDataFrame([("der die und nicht das ist", "de"), ("le la et les des est", "fr")] * 40, "text string, label string")
    languages, model = language_fusion.train(train)
    assert languages == ["de", "fr", "und"]
    got = {r.key: r for r in language_fusion.identify(language_fusion.from_pages(pages, F.col("page_id")), languages, model).collect()}
    assert got[500].language == "de" and got[501].language == "fr" and not got[502].kept


def test_languages_at_every_size(spark):
    """Five labelled rows among many of another language are enough, and copies do not crowd out other texts."""
    rows = spark.range(40_000).select(F.concat(F.lit("the and of that in "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("label"))
    few = spark.createDataFrame([(f"der die und nicht das ist {w}", "de") for w in ("ein", "zwei", "drei", "vier", "auch")] + [("le la et les", "fr")] * 4, rows.schema)
    copied = spark.range(20_000).select(F.lit("il che di la e non").alias("text"), F.lit("it").alias("label"))
    languages, sample = language_fusion.sampled(rows.union(few).union(copied), 1_000, 5)
    assert languages == ["de", "en", "it"]
    drawn = {r.language: r["count"] for r in sample.groupBy("language").count().collect()}
    assert (drawn[0], drawn[2]) == (5, 1) and 800 < drawn[1] < 1_200
    languages, model = language_fusion.train(rows.union(few).union(copied))
    assert languages == ["de", "en", "it", "und"] and model.shape[0] == 4
    texts = [("der die und nicht", "de"), ("the and of that", "en"), ("il che di la", "it")]
    asked = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "key long, text string")
    asked = asked.select("*", *[F.lit(None).cast("string").alias(c) for c in ("host", "domain", "declared", "suffix")])
    got = {r.key: r.language for r in language_fusion.identify(asked, languages, model).collect()}
    assert [got[i] for i in range(3)] == [t[1] for t in texts]


# pipeline


def test_pipeline_stages(spark):
    """Every stage against what its operator says about the stage's own input."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = work_path(spark, f"test-{name}")
        stage(spark, frames[-1], "/root/testdata/sf0.01").write.parquet(path)
        frames.append(spark.read.parquet(path))
    assert all(f.columns == docs.columns for f in frames[:-1])
    ids = [sorted(r[0] for r in f.select("doc_id").collect()) for f in frames]
    texts = {r.doc_id: r.text for r in docs.collect()}
    least = {}
    for i in ids[1]:
        p = plain_print(texts[i])
        least[p] = min(least.get(p, i), i)
    assert ids[2] == sorted(set(plain_components(list(least), least).values()))
    grams = set()
    for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect():
        words = re.findall(r"[^\W_]+", r.text.lower())
        grams |= {tuple(words[i : i + 10]) for i in range(len(words) - 9)}
    left = [re.findall(r"[^\W_]+", texts[i].lower()) for i in ids[3]]
    assert not any(tuple(w[i : i + 10]) in grams for w in left for i in range(len(w) - 9))
    assert len(ids[3]) >= len(ids[2]) - 40 and set(ids[4]) <= set(ids[3])
    assert ids[5] == ids[4]
    assert sorted(ids[5]) == sorted(r.doc_id for r in corpus_pipeline.run(spark, "/root/testdata/sf0.01").collect())
