"""Language model, prefix trie and whitening: against brute force, and on awkward rows."""

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brute import AWKWARD, DOCS  # noqa: E402

from musterline.llm import ngrams, prefixes, queries, whitening  # noqa: E402
from musterline.llm.eliasfano import EliasFano, Trie  # noqa: E402

SMALL = "/root/testdata/sf0.001"


# --- Elias-Fano sequences and tries


@pytest.mark.parametrize("most", [0, 1, 5, 1000, 10**12])
def test_elias_fano_reads_back_and_finds_successors(most):
    rng = np.random.default_rng(3)
    values = np.sort(rng.integers(0, most + 1, 700))
    ef = EliasFano.build(values)
    assert (ef.get(np.arange(700)) == values).all()
    asked = np.r_[values, rng.integers(0, most + 2, 300), most + 1]
    assert (ef.successor(asked) == np.searchsorted(values, asked)).all()
    again = EliasFano.opened(ef.arrays())
    assert (again.get(np.arange(700)) == values).all()
    assert EliasFano.build(np.zeros(0, dtype=np.int64)).successor(np.array([4])).tolist() == [0]


def test_trie_finds_what_it_holds_and_nothing_else():
    rng = random.Random(4)
    rows = sorted({(rng.randrange(9), rng.randrange(40), rng.randrange(10**6)) for _ in range(3000)})
    columns = [np.array(c, dtype=np.int64) for c in zip(*rows)]
    trie = Trie.build(columns, np.arange(len(rows), dtype=np.uint16), np.arange(len(rows), dtype=np.uint64)).mapped()
    assert (trie.find(columns) == np.arange(len(rows))).all()
    other = [(rng.randrange(11), rng.randrange(42), rng.randrange(10**6)) for _ in range(3000)] + [(a, b, c + 1) for a, b, c in rows]
    place = {r: i for i, r in enumerate(rows)}
    got = trie.find([np.array(c, dtype=np.int64) for c in zip(*other)])
    assert got.tolist() == [place.get(r, -1) for r in other]


def test_packed_arrays_come_back():
    arrays = [np.array([], dtype=np.uint16), np.arange(5, dtype=np.uint64) << np.uint64(40), np.array([7], dtype=np.uint32)]
    assert [a.tolist() for a in ngrams.unpacked(ngrams.packed(*arrays))] == [a.tolist() for a in arrays]
    assert ngrams.unpacked(ngrams.packed()) == []


# --- Scores


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) + ["\n"]


def brute_scores(texts, order):
    """(learn, text) rows to (n_tokens, n_known, N, base, score)."""
    counts = [Counter() for _ in range(order + 1)]
    for learn, text in texts:
        if learn:
            w = [" "] * (order - 1) + words_of(text)
            for i in range(order - 1, len(w)):
                for n in range(1, order + 1):
                    counts[n][tuple(w[i - n + 1 : i + 1])] += 1
            for n in range(1, order):
                counts[n][(" ",) * n] += 1
    starts = sum(1 for learn, _ in texts if learn)
    total = sum(counts[1].values()) - (starts if order > 1 else 0)
    distinct = len(counts[1]) - (1 if order > 1 and starts else 0)
    out = []
    for _, text in texts:
        w = [" "] * (order - 1) + words_of(text)
        base = score = 0.0
        known = 0
        for i in range(order - 1, len(w)):
            c = counts[1][(w[i],)]
            p = (c + 1) / (total + distinct + 1)
            base += math.log10(p)
            known += c > 0
            for n in range(2, order + 1):
                above = counts[n - 1][tuple(w[i - n + 1 : i])]
                if above:
                    m = ngrams.PRIOR[n]
                    p = (counts[n][tuple(w[i - n + 1 : i + 1])] + m * p) / (above + m)
            score += math.log10(p)
        out.append((len(w) - order + 1, known, total, base, score))
    return out


@pytest.mark.parametrize(("order", "part", "batch"), [(1, 50, 400), (2, 50, 400), (3, 40, 300), (3, 2_000_000, 8 << 20), (4, 30, 500)])
def test_scores_equal_brute_force(spark, order, part, batch):
    rng = random.Random(order)
    rows = [(i, " ".join(rng.choice(["the", "The", "a", "of", "cat", f"w{rng.randrange(30)}"]) for _ in range(rng.randrange(40)))) for i in range(120)]
    rows += [(1000 + i, "of the cat " * 60) for i in range(20)]
    rows += [(i, t) for i, t, *_ in AWKWARD]
    docs = spark.createDataFrame([(i, t, "mine") for i, t in rows], "doc_id long, text string, learn string").repartition(5)
    learn = F.col("doc_id") % 3 != 1
    got = ngrams.score(docs, learn, order, part=part, batch=batch).collect()
    want = brute_scores([(i is not None and i % 3 != 1, t) for i, t in rows], order)
    expected = defaultdict(list)
    for (i, _), row in zip(rows, want):
        expected[i].append(row)
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base, score = next(
            w for w in expected[r.doc_id] if (w[0], w[1]) == (r.n_tokens, r.n_known) and abs(w[3] - r.base_score) < 1e-6 * max(1, -w[3])
        )
        assert r.train_tokens == total and abs(score - r.score) <= 0.0006 * order * n
        assert r.learn == (r.doc_id is not None and r.doc_id % 3 != 1)


def test_scores_without_rows_or_learning_texts(spark):
    empty = spark.createDataFrame([], DOCS)
    assert ngrams.score(empty, F.lit(True)).collect() == []
    docs = spark.createDataFrame(AWKWARD, DOCS)
    got = ngrams.score(docs, F.lit(None).cast("boolean")).collect()
    assert len(got) == len(AWKWARD)
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and r.score == 0 for r in got)


def test_trigrams_beat_single_words_on_texts_held_out(spark):
    got = queries.op11_lm(spark, SMALL).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.97 * got[1] and got[0] < 0


# --- Prefix trie


def test_perfect_hash_gives_every_key_its_own_slot():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, (5000, 2), dtype=np.uint64)
    table = prefixes.PerfectHash(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(5000))
    others = rng.integers(0, 1 << 63, (5000, 2), dtype=np.uint64)
    assert (table.slots(others) == -1).all()
    assert prefixes.PerfectHash(keys[:0]).slots(others).tolist() == [-1] * 5000
    with pytest.raises(ValueError):
        prefixes.PerfectHash(np.r_[keys, keys[:1]])


def brute_nodes(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in turns.items()}
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(own.get(c - c % 20, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    nodes = set(members)
    kids = Counter(k[:-1] for k in nodes if k)
    leaves, saved = Counter(), Counter()
    for k in nodes:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(members[k]) - 1) * words
    return sorted(
        (
            min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), kids[k], leaves[k], saved[k],
            hashlib.sha256(",".join(str(c) for c in sorted(m) if len(paths[c]) == len(k)).encode()).hexdigest(),
        )
        for k, m in members.items()
    )


CONVERSATIONS = "conv_id long, turn long, role string, text string, path string"


def found_nodes(spark, rows, parts=3):
    table = spark.createDataFrame([(*r, "mine") for r in rows], CONVERSATIONS).repartition(parts)
    done = prefixes.nodes(prefixes.rebuilt(prefixes.turn_rows(table)))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in done.select(*columns).collect())


@pytest.mark.parametrize("parts", [1, 7])
def test_trie_equals_brute_force(spark, parts):
    rng = random.Random(9)
    rows = []
    for c in range(150):
        for t in range(rng.randrange(1, 8)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["hello there you", "yes", "", "a b\tc"])))
    rows += [(1000 + c, t, "user", "the same hot text") for c in range(5000) for t in range(3)]
    rows += [(7, None, None, None), (7, None, "user", None), (None, 1, "user", "nobody"), (31, 50, "user", "x" * 50_000)]
    rows += [(8000, t, "user", "deep") for t in range(600)]
    assert found_nodes(spark, rows, parts) == brute_nodes(rows)


def test_trie_of_nothing_and_of_conversations_without_turns(spark):
    assert found_nodes(spark, []) == []
    # Conversation 7 loses its only turn and gets none, as 0 is absent.
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 0)
    assert found_nodes(spark, [(lone, 0, "user", "gone")]) == [(lone, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


# --- Whitening


def test_rank_one_updates_keep_an_eigendecomposition():
    rng = np.random.default_rng(2)
    spectrum, other = whitening.Spectrum(12), whitening.Spectrum(12)
    x = rng.integers(-5, 6, (300, 12)).astype(float)
    x[:, 3] = x[:, 4]
    x[:20] = x[0]
    for row in x[:170]:
        spectrum.add(row)
    for row in x[170:]:
        other.add(row)
    spectrum.merge(other)
    want = np.cov(x.T, bias=True) * 300
    got = spectrum.vectors @ np.diag(spectrum.values) @ spectrum.vectors.T
    assert spectrum.n == 300 and np.allclose(got, want, atol=1e-8 * abs(want).max())
    assert np.allclose(spectrum.vectors.T @ spectrum.vectors, np.eye(12), atol=1e-10)
    assert np.allclose(spectrum.mean, x.mean(axis=0))


def brute_whitening(vectors):
    sound = {k: v for k, v in vectors.items() if v and all(c is not None and math.isfinite(c) for c in v)}
    whole = {k: [math.floor(256 * c) for c in v] for k, v in sound.items()}
    fit = np.array(sorted(set(map(tuple, whole.values()))))
    values, axes = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True))
    return whole, fit, values[::-1], axes[:, ::-1]


def test_whitening_equals_an_eigendecomposition(spark):
    rng = np.random.default_rng(6)
    vectors = {i: (rng.normal(size=8) * [3, 2, 1.5, 1, 0.5, 0.4, 0.3, 0.2]).tolist() for i in range(400)}
    vectors |= {1000 + i: vectors[0] for i in range(300)}
    vectors |= {2000: None, 2001: [1.0, None, *[0.0] * 6], 2002: [float("nan")] * 8, 2003: [float("inf")] * 8, 2004: []}
    odd = {3000: [1.0, 2.0]}
    rows = [(k, v, 1) for k, v in (vectors | odd).items()] + [(5, vectors[5], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int").repartition(20)
    got = whitening.whiten(table).collect()
    whole, fit, values, axes = brute_whitening(vectors)
    n, sums = len(fit), fit.sum(axis=0)
    assert len(got) == 4 * (len(whole) + 1)
    sign = {}
    for r in got:
        x = np.array(whole[r.vec_id])
        assert r.n == n and r.deviation == int(((n * x - sums) ** 2).sum())
        i = r.component - 1
        want = (x - sums / n) @ axes[:, i] / math.sqrt(values[i])
        sign.setdefault(i, 1 if want * r.whitened > 0 else -1)
        assert abs(sign[i] * r.whitened - want) < 1e-7
        assert abs(r.explained - values[i] / values.sum()) < 1e-10 and r.identity_error < 1e-9


def test_whitening_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    # One distinct vector has no variance; two have one axis.
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    got = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (None, [2.0, 2.0]), (3, [2.0, 2.0])], schema)).collect()
    assert sorted((r.component, r.n, round(abs(r.whitened), 9), r.explained) for r in got) == [(1, 2, 1.0, 1.0)] * 3
