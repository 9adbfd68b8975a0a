"""Near-duplicates, repeated strings and embeddings against brute force."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brute import AWKWARD, DOCS, repeats, roots, simhash  # noqa: E402
from compare import connect, differences  # noqa: E402

from musterline.llm import common, gsaca, imi, queries, simhash as S  # noqa: E402
from musterline.llm import repeats as R  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(100, 160)] + [(300, 301), (301, 302), (302, 300), (5, 5)]
    random.Random(1).shuffle(pairs)
    got = dict(map(tuple, common.components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    want = roots(pairs, {n for p in pairs for n in p})
    assert got == want
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def check_simhash(rows, got, distance=4):
    prints = [simhash(t) for _, t in rows]
    n = range(len(rows))
    root = roots([(i, j) for i in n for j in n if i < j and (prints[i] ^ prints[j]).bit_count() <= distance], n)
    least = {}
    for i in n:
        ids = [x for x in (least.get(root[i]), rows[i][0]) if x is not None]
        least[root[i]] = min(ids, default=None)
    want = sorted(((rows[i][0], f"{prints[i]:016x}", least[root[i]]) for i in n), key=str)
    assert sorted(map(tuple, got.select("doc_id", "fingerprint", "component_id").collect()), key=str) == want
    return set(root.values())


def test_simhash_of_the_smallest_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check_simhash(rows, queries.op1_simhash(spark, SMALL))


def test_simhash_of_awkward_rows(spark):
    docs = spark.createDataFrame(AWKWARD, DOCS).withColumn("simhash", F.lit("clash")).withColumn("root", F.lit(1))
    groups = check_simhash([(i, t) for i, t, *_ in AWKWARD], S.near_duplicates(docs))
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert {1, 2, 7} <= {r["doc_id"] for r in kept.collect()}
    assert S.near_duplicates(docs.limit(0)).count() == 0 and S.keep_one(docs.limit(0)).count() == 0


@pytest.mark.parametrize("blocks", [5, 6, 8])
def test_links_connect_what_is_close_in_large_slices(spark, monkeypatch, blocks):
    monkeypatch.setattr(S, "CELL", 16)
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**62), 2**62, 40)
    values = {int(b) for b in base}
    for _ in range(300):
        v = int(base[0]) if rng.random() < 0.5 else int(rng.choice(base))
        for bit in rng.integers(0, 62, rng.integers(1, 6)):
            v ^= 1 << int(bit)
        values.add(v)
    values = sorted(values)
    close = [(a, b) for a in values for b in values if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    prints = spark.createDataFrame([(v,) for v in values], "simhash long")
    found = [tuple(r) for r in S.links(prints, 4, blocks).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in found)
    assert roots(found, values) == roots(close, values)


def test_suffix_array_by_grouping():
    rng = random.Random(1)
    for _ in range(1500):
        symbols = [rng.randint(1, rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.3:
            symbols = symbols[:4] * rng.randint(1, 9)
        symbols.append(0)
        assert gsaca.suffix_array(np.array(symbols)).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_repeated_windows_of_segments():
    rng = random.Random(1)
    for _ in range(200):
        width, letters = rng.choice([20, 24, 33]), rng.choice([b"a", b"ab", b"abcdef\0"])
        texts = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 120))) for _ in range(rng.randint(1, 5))]
        for _ in range(3):
            part = rng.choice(texts)[rng.randint(0, 60) :][: rng.randint(0, 80)]
            texts.append(bytes(rng.choice(letters) for _ in range(rng.randint(0, 30))) + part)
        classes = {}
        for i, t in enumerate(texts):
            for mh, p, n, _ in R.segments(t, width) if len(t) >= width else ():
                for a, b, c in zip(mh.tolist(), p.tolist(), n.tolist(), strict=True):
                    classes.setdefault((a, t[b : b + c + width - 1]), []).append((i, b))
        got = [np.zeros(len(t), dtype=bool) for t in texts]
        if classes:
            keys = sorted(classes)
            marks = R.repeated_windows([k[1] for k in keys], [min(2, len(classes[k])) for k in keys], [k[0] for k in keys], width)
            for k, mark in zip(keys, marks, strict=True):
                for r in R.ranges(mark):
                    for i, p in classes[k]:
                        got[i][p + r["a"] : p + r["b"] - 1 + width] = True
        assert all((a == b).all() for a, b in zip(got, repeats(texts, width), strict=True))


def check_repeats(rows, got):
    from hashlib import sha256

    data = [(t or "").encode() for _, t in rows]
    want = []
    for (i, _), b, m in zip(rows, data, repeats(data, 200), strict=True):
        runs = int((np.diff(np.r_[0, m.astype(int)]) == 1).sum())
        want.append((i, len(b), int(m.sum()), runs, sha256(np.frombuffer(b, np.uint8)[~m].tobytes()).hexdigest()))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_repeats_of_the_smallest_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check_repeats(rows, queries.op3_suffix_array(spark, SMALL))


def test_repeats_of_awkward_rows(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    passage = "".join(rng.choice("abc é") for _ in range(400))
    more = [(100 + i, f"{i} {rng.random()} {passage} {rng.random()}", "en", "s", 1) for i in range(30)]
    short = [r for r in AWKWARD if len(r[1] or "") < 1000]
    docs = spark.createDataFrame(short + more + [(8, "x" * 3000, "en", "a", 1)], DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    check_repeats([(r[0], r[1]) for r in docs.collect()], queries.op3_suffix_array(spark, str(tmp_path)))
    clash = docs.withColumn("cut", F.lit(1)).withColumn("spans", F.lit(2)).withColumn("th", F.lit(3))
    kept = R.without_repeats(clash)
    assert kept.columns == clash.columns and kept.count() == docs.count()
    assert kept.where("text is null").count() == 1
    assert all(r["n_chars"] == len(r["text"]) for r in kept.where("text is not null").collect())
    assert R.without_repeats(clash.limit(0)).count() == 0


def test_cells_of_one_gram_are_sorted_apart(spark, tmp_path, monkeypatch):
    """A frequent phrase in many contexts is cut into cells that follow each other in one task; what stands once stays."""
    monkeypatch.setattr(R, "SLICE", 8)
    rng = random.Random(6)
    line = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    # A phrase of so small a hash that every window around it belongs to it.
    many = np.frombuffer(line(200_000).encode(), np.uint8)
    at = int(R.gram_hashes(many).argmin())
    phrase = many[at : at + R.GRAM].tobytes().decode()
    data = [(i, f"{line(150)}{phrase}{line(150)}") for i in range(40)]
    data += [(100 + i, f"{i}{data[0][1][20:280]}{i}") for i in range(2)]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        check_repeats(data, queries.op3_suffix_array(spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def vectors(n, labels, seed=2):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, 16))
    rows = []
    for i in range(n):
        v = base[i % len(base)] + rng.normal(size=16) * rng.choice([0.0, 0.03, 0.06, 1.0])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(0, labels))))
    return rows


ODD = [
    (900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [float("nan")] + [1.0] * 15, 1), (904, [None] + [1.0] * 15, 1),
    (905, [1.0] * 16, None), (906, [2.0] * 16, 1), (907, [3.0] * 16, 1), (907, [3.0] * 16, 1), (None, [5.0] * 16, 1),
    (908, [float("inf")] * 16, 1), (909, [1.0, 2.0], 1), (910, [2.0, 4.0], 1), (911, [1.0] * 16, 2),
]


def check_links(rows, got):
    n = len(rows)
    unit = {}
    for i, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            unit[i] = np.array(v) / np.linalg.norm(v)
    linked = [
        (i, j) for i in unit for j in unit
        if i < j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98
    ]
    root = roots(linked, range(n))
    least = {}
    for i in range(n):
        ids = [x for x in (least.get(root[i]), rows[i][0]) if x is not None]
        least[root[i]] = min(ids, default=None)
    count = np.bincount([x for p in linked for x in p], minlength=n)
    want = sorted(((rows[i][0], int(count[i]), least[root[i]]) for i in range(n)), key=str)
    assert sorted(map(tuple, got.select("vec_id", "n_links", "component_id").collect()), key=str) == want
    return len(linked)


def test_embeddings_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(imi, "SLICE", 16)
    rows = vectors(400, 3) + ODD
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("uid", F.lit("clash"))
    got = imi.near_duplicates(frame, words=4)
    assert check_links(rows, got) > 100
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.where("component_id is not null").collect())
    assert imi.near_duplicates(frame.limit(0)).count() == 0


def test_recall_of_the_index_alone(spark):
    """One direction of the search at the lowest cosine, without the help of the other direction."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    grid = imi.fit(x[:1000], 16, 0.98, 0.998)
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    assert (grid.beyond(x, grid.cells(y)[0]) <= grid.limit).mean() > 0.98
    d, e = grid.distances(x[:1])
    visited = imi.multi_sequence(d[0], e[0], grid.limit)
    total = (d[0][:, None] + e[0][None, :]).ravel()
    near = np.flatnonzero(total <= total.min() + grid.limit)
    assert sorted(visited) == near.tolist() and (np.diff(total[visited]) >= 0).all()


def test_embedding_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert differences(queries.op7_embeddings(spark, folder), connect(folder), queries.OP7_SQL) == []


def test_components_of_a_long_chain_have_a_small_plan(spark):
    rng = random.Random(3)
    nodes = list(range(3000))
    rng.shuffle(nodes)
    edges = spark.createDataFrame(list(zip(nodes, nodes[1:])), "a long, b long")
    got = common.components(edges)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 4
    assert {tuple(r) for r in got.collect()} == {(n, 0) for n in nodes}
