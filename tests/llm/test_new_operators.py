"""Conversation trie, quality classifier and vector codes against plain versions, and on awkward tables."""

import hashlib
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from stintlake.llm import boosted_quality, prefix_trie, queries, vector_codes
from tests.compare import connect, difference

SF = "/root/testdata/sf0.01"
TURNS = "conv_id long, turn int, role string, text string"


@pytest.mark.parametrize("name", ["op11_conversation_trie", "op13_vector_codes"])
def test_query_equals_sql_on_the_larger_tables(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) is None


# -- trie ----------------------------------------------------------------------


def _plain_trie(rows, every, most):
    """Nodes by prefixes as tuples, and subtrees by comparing prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        built[c] = own.get(c - int(np.fmod(c, every)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = set()
    for prefix, convs in members.items():
        d = len(prefix)
        below = [q for q in members if q[:d] == prefix]
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == d)
        out.add(
            (
                min(convs),
                d,
                min(members[prefix[:-1]]) if d else None,
                len(convs),
                sum(len(q) == d + 1 for q in below),
                sum(not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below) for q in below),
                sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return out


def _trie(spark, rows, **how):
    found = prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS), **how)
    return [tuple(r) for r in found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()]


@pytest.mark.parametrize("seed, longest", [(1, 3), (2, 9), (3, 40)])
def test_trie_against_compared_prefixes(spark, seed, longest):
    chance = random.Random(seed)
    rows = []
    for conv in chance.sample(range(-30, 400), 60):
        for turn in range(chance.randint(1, longest)):
            rows.append((conv, chance.choice([turn, turn, turn, None]), chance.choice(["user", "a", None]), chance.choice(["", "x", "é\U0001f600", None])))
    chance.shuffle(rows)
    got = _trie(spark, rows, every=10, most=6)
    assert len(got) == len(set(got)) and set(got) == _plain_trie(rows, 10, 6)


def test_one_long_conversation_many_copies_and_turnless_ones(spark):
    rows = [(0, i, "user", f"t{i % 7}") for i in range(300)]
    rows += [(c, i, "user", f"t{i % 7}") for c in range(1, 60) for i in range(c % 9 + 1)]
    rows += [(c, None, "user", "alone") for c in (701, 702, 703, 704, 705, 706)]  # no conversation 700 to open with
    got = _trie(spark, rows)
    assert set(got) == _plain_trie(rows, 100, 6) and max(r[1] for r in got) == 300
    assert any(r[1] == 0 and r[7] != prefix_trie._NOTHING for r in got)


def test_trie_on_awkward_and_empty_tables(spark, messy, nothing):
    odd = messy.select(F.col("doc_id").alias("conv_id"), F.col("n_chars").alias("turn"), F.col("lang").alias("role"), "text", "part", "p", "id")
    rows = [tuple(r) for r in odd.select("conv_id", "turn", "role", "text").collect()]
    found = prefix_trie.conversation_trie(odd)
    got = {tuple(r) for r in found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()}
    assert got == _plain_trie(rows, 100, 6)
    empty = prefix_trie.conversation_trie(spark.createDataFrame([], TURNS))
    assert empty.collect() == [] and empty.schema == found.schema


def test_ends_in_several_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    ends = spark.range(-40, 60).select(F.lit(1).cast("long").alias("node"), (F.col("id") % 3).alias("p"), F.col("id").alias("conv"))
    got = {(r.node, r.p): r.sha for r in prefix_trie._line_digests(ends).collect()}
    ids = defaultdict(list)
    for c in range(-40, 60):
        ids[1, int(np.fmod(c, 3))].append(c)
    assert got == {k: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for k, v in ids.items()}


# -- vector codes --------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 2, 8, 64])
def test_transform_is_walsh_hadamard_in_sequency_order(size):
    basis = vector_codes.transform(np.eye(size, dtype=np.int64)).T
    assert (basis @ basis.T == size * np.eye(size)).all()
    assert [(np.diff(row) != 0).sum() for row in basis] == list(range(size))


@pytest.mark.parametrize("kind, width, spread", [(np.int64, 16, 40), (np.int64, 5, 3), (np.int64, 1, 9), (object, 6, 10**30)])
def test_nearest_against_all_distances(kind, width, spread):
    chance = random.Random(width)
    draw = lambda n: np.array([[chance.randint(-spread, spread) for _ in range(width)] for _ in range(n)], kind)
    entries = draw(40)
    rows = np.concatenate([draw(1500 if kind is not object else 60), entries[:20], np.zeros((3, width), kind)])
    index, distance = vector_codes.nearest(rows, entries)
    for row, i, d in zip(rows, index, distance):
        plain = [sum((int(a) - int(b)) ** 2 for a, b in zip(row, e)) for e in entries]
        assert (i, d) == (plain.index(min(plain)), min(plain))


def _plain_codes(rows, parts, entries, rounds, scale):
    """(id, code, error, label error) of every kept row, by whole numbers and all distances."""
    ok = [(i, v, g) for i, v, g in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    part = -(-max((len(v) for _, v, _ in ok), default=0) // parts)
    whole = [[Fraction(x) * scale // 1 for x in v] + [0] * (part * parts - len(v)) for _, v, _ in ok]
    starts = {}
    for (i, v, _), w in zip(ok, whole):
        if i is not None and (i not in starts or v < starts[i][0]):
            starts[i] = (v, w)
    first = [starts[i][1] for i in sorted(starts)[:entries]]
    books = [[w[k * part : (k + 1) * part] for w in first] for k in range(parts)]

    def assign():
        got = []
        for w in whole:
            choice = []
            for k, book in enumerate(books):
                d = [sum((a - b) ** 2 for a, b in zip(w[k * part : (k + 1) * part], e)) for e in book]
                choice.append((d.index(min(d)), min(d)))
            got.append(choice)
        return got

    for _ in range(rounds):
        chosen = assign()
        for k in range(parts):
            for e in range(len(books[k])):
                mine = [w[k * part : (k + 1) * part] for w, c in zip(whole, chosen) if c[k][0] == e]
                if mine:
                    books[k][e] = [sum(x) // len(mine) for x in zip(*mine)]
    chosen, sums = assign(), defaultdict(int)
    errors = [sum(d for _, d in c) for c in chosen]
    for (_, _, g), e in zip(ok, errors):
        sums[g] += e
    line = ",".join(str(x) for book in books for e in book for x in e)
    fit = lambda x: x if x < 2**63 else None
    digest = hashlib.sha256(line.encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{e:02x}" for e, _ in c), fit(err), fit(sums[g]), digest) for (i, _, g), c, err in zip(ok, chosen, errors)), key=repr
    )


def _codes(spark, rows, kind="float", **how):
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").withColumn("code", F.lit("clash")).repartition(3)
    return sorted((tuple(r) for r in vector_codes.compress(table, **how).collect()), key=repr)


@pytest.mark.parametrize("width", [8, 10, 2])
def test_codes_against_all_distances(spark, width):
    chance = random.Random(width)
    rows = [(i // 2, [float(np.float32(chance.gauss(0, 0.01))) for _ in range(width)], chance.choice([1, 2, None])) for i in range(200)]
    rows += [(7, rows[3][1], 1)] * 30 + [(500, None, 1), (501, [None] * width, 1), (502, [float("nan")] * width, 2), (503, [float("-inf")] * width, 2)]
    rows += [(None, rows[5][1], None), (504, rows[6][1][:-1], 2), (505, [], 2)]
    how = {"parts": 4, "entries": 12, "rounds": 3, "scale": 1024}
    assert _codes(spark, rows, **how) == _plain_codes(rows, **how)


def test_codes_of_huge_components_and_of_nothing(spark):
    chance = random.Random(5)
    rows = [(i, [chance.uniform(-1, 1) * 10.0 ** chance.randint(-5, 38) for _ in range(4)], i % 2) for i in range(40)]
    how = {"parts": 2, "entries": 5, "rounds": 2, "scale": 1024}
    assert _codes(spark, rows, "double", **how) == _plain_codes(rows, **how)
    assert _codes(spark, [(1, None, 1)]) == [] and _codes(spark, []) == []
    assert [r[:4] for r in _codes(spark, [(None, [1.0, 2.0], 3)])] == [(None, "", 0, 0)]


# -- quality -------------------------------------------------------------------


def _area(score, label):
    order = score.rank().to_numpy()
    good = label.to_numpy() == 1
    return (order[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = boosted_quality.quality(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert found["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2).all()
    good = found["quality"] == 1
    assert 0.5 < good.mean() < 0.95 and _area(found["score"], found["quality"]) > 0.99
    assert (found["predicted"] == (found["score"] >= 0.7)).all()
    assert found.loc[good, "predicted"].mean() > 0.97 and found.loc[~good, "predicted"].mean() < 0.1


def test_forest_walk_against_a_walk_by_node(spark):
    random_ = np.random.default_rng(3)
    x = random_.integers(0, 9, (400, 4)).astype(float)
    label = ((x[:, 0] > 4) ^ (x[:, 2] > 6)).astype(np.int64)
    forest = boosted_quality.train(x, label, np.ones(400), trees=15, depth=3)
    got = forest.scores(x)
    for row, score in zip(x, got):
        odds = forest.start
        for feature, threshold, value in zip(forest.feature, forest.threshold, forest.value):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            odds += value[node - len(feature)]
        assert score == pytest.approx(1 / (1 + np.exp(-odds)), abs=1e-6)
    assert ((got > 0.5) == (label == 1)).all()


def test_first_cut_of_a_tree_is_the_best_one():
    random_ = np.random.default_rng(4)
    x, label = random_.random((200, 3)), random_.integers(0, 2, 200)
    x[:, 1] += label * 0.4
    forest = boosted_quality.train(x, label, np.ones(200), trees=1, depth=1)
    p = label.mean()
    g, h = p - label, np.full(200, p * (1 - p))
    gain = lambda m: g[m].sum() ** 2 / (h[m].sum() + boosted_quality.RIDGE)
    cuts = [(f, t) for f in range(3) for t in np.quantile(x[:, f], np.arange(1, 64) / 64, method="lower")]
    best = max(gain(x[:, f] <= t) + gain(x[:, f] > t) for f, t in cuts if min(h[x[:, f] <= t].sum(), h[x[:, f] > t].sum()) >= 2)
    m = x[:, forest.feature[0, 0]] <= forest.threshold[0, 0]
    assert gain(m) + gain(~m) == pytest.approx(best)


def test_statistics_by_hand():
    got = dict(zip(boosted_quality.STATISTICS, boosted_quality.statistics("Ab cd! Ab cd!\n\n12 ##\n12 ##")))
    assert got["upper_share"] == 2 / 26 and got["symbol_share"] == 4 / 26 and got["digit_share"] == 4 / 26 and got["line_share"] == 3 / 26
    assert got["distinct_words"] == 4 / 8 and got["commonest_word"] == 2 / 8 and got["repeated_pairs"] == 4 / 7
    assert got["repeated_lines"] == 1 / 3 and got["letterless_lines"] == 2 / 3 and got["ended_lines"] == 1 / 3
    assert boosted_quality.statistics(None) == boosted_quality.statistics("") == [0.0] * len(boosted_quality.STATISTICS)


def test_quality_on_awkward_tables(spark, messy, nothing):
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, None), (None, 1), (5, 0), (8, 1), (99, 1), (1, 0), (6, 7)], "doc_id long, quality int")
    for given in (labels, labels.limit(0)):
        found = boosted_quality.quality(messy, given)
        rows = found.collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in messy.select("doc_id").collect())
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
        assert all(r.held_out for r in rows if r.doc_id is None)
        assert boosted_quality.quality(nothing, given).collect() == []


def test_labels_of_held_out_rows_change_nothing(spark, messy):
    labels = spark.range(0, 9).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [sorted(map(str, boosted_quality.quality(messy, t).collect())) for t in (labels, turned)]
    assert labels.where(out).count() and scores[0] == scores[1]
