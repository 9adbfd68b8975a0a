"""Tokens, packing, fingerprints: against the library, by exact round trips and on awkward rows."""

import random
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brute import AWKWARD, DOCS  # noqa: E402

from musterline.llm import bpe, ctph, packing, queries  # noqa: E402

PIECES = [
    "a", "b", "E", "é", "é", "Σ", "ΑΣ", "'s", "'S", "'ll", "<|endoftext|>", "<|startoftext|>", "<|", "1", "23", " ", "  ", "\n",
    " \n", "\t", "!", "??", "\x1c", "\x85", "　", "日本", "😀", "aaaaaa", "the", "ING",
]


def mixtures(n):
    rng = random.Random(5)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(n)] + [t or "" for _, t, *_ in AWKWARD]


def test_word_bpe_equals_the_library():
    library, own = Tokenizer.from_file(queries.WORD_BPE), bpe.load(queries.WORD_BPE)
    texts = mixtures(3000) + [f"a{chr(c)}b" for c in range(0x80, 0x3000)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<i4").tolist() for b in own.encode(texts)] == want
    back = own.decode(pa.array(want, pa.list_(pa.int32()))).to_pylist()
    assert back == [library.decode(ids, skip_special_tokens=False) for ids in want]


def test_merges_only_use_what_earlier_merges_made():
    """Merging the lowest pair everywhere at once equals merging one place after the other only then."""
    own = bpe.load(queries.WORD_BPE)
    born = np.zeros(own.size, dtype=np.int64)
    born[own.into[np.argsort(own.ranks)][::-1]] = np.sort(own.ranks)[::-1] + 1
    left, right = own.keys // own.size, own.keys % own.size
    assert (born[left] <= own.ranks).all() and (born[right] <= own.ranks).all()


def test_byte_bpe_equals_the_library():
    library, own = Tokenizer.from_file(queries.BYTE_BPE), packing.tokens(queries.BYTE_BPE)
    texts = mixtures(3000)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)] == want


def test_encode_keeps_rows_and_replaces_its_column(spark):
    docs = spark.createDataFrame(AWKWARD, DOCS).withColumn("ids", F.lit("mine")).withColumn("decoded", F.lit(1))
    got = bpe.decode(bpe.encode(docs, queries.WORD_BPE), queries.WORD_BPE).collect()
    assert len(got) == len(AWKWARD)
    assert [r["ids"] for r in got if not (r["text"] or "").strip()] == [[]] * 3
    assert bpe.encode(docs.limit(0), queries.WORD_BPE).count() == 0


@pytest.mark.parametrize("rows", [AWKWARD, [], AWKWARD[1:2]])
def test_packing_places_every_token_once(spark, rows):
    docs = spark.createDataFrame(rows, DOCS).withColumn("sequence_id", F.lit("clash"))
    got = packing.pack_documents(docs.coalesce(1), queries.BYTE_BPE, length=64).collect()
    encoder = packing.tokens(queries.BYTE_BPE)
    want = sorted(next(iter(encoder.encode([t or ""]))) + b"\0\0\0\0" for _, t, *_ in rows)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r["ids"]) == 4 * r["length"]
        by_doc[r["doc_id"], r["doc_tokens"]].append((r["start"], bytes(r["ids"])))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    lengths = []
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        lengths.append(at)
    assert all(n == 64 or n & (n - 1) == 0 and n < 64 for n in lengths)
    assert sum(lengths) == sum(len(w) // 4 for w in want)
    whole = sorted(b"".join(b for _, b in sorted(p)) for k, p in by_doc.items() if k[0] in (1, 3, 5, 8, 9))
    assert all(w in want for w in whole)


def test_sum_of_squares_placement():
    packer = packing.Packer(10, 0)
    for size in (7, 7, 3, 3, 4):
        packer.add(1, bytes(4 * size))
    # Both 3s complete a 7; the 4 opens a window of its own.
    assert packer.level[4] == 1 and packer.level.sum() == 1 and packer.next == 2


def test_open_windows_stay_bounded(monkeypatch):
    monkeypatch.setattr(packing, "OPEN", 8)
    packer = packing.Packer(10, 0)
    for i in range(200):
        packer.add(i, bytes(4 * 6))
        assert packer.level.sum() <= 8
    packer.finish()
    assert sum(r[2] for r in packer.rows) == 1200
    assert len({r[4] for r in packer.rows}) == 120


def test_crc_is_of_little_endian_ids(spark):
    got = queries.op9_packing(spark, "/root/testdata/sf0.001").where("start = 0").first()
    piece = packing.pack_documents(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), queries.BYTE_BPE)
    ids = piece.where(f"doc_id = {got['doc_id']} and start = 0").first()["ids"]
    assert got["ids_crc32"] == zlib.crc32(bytes(ids))


def test_fingerprints_read_back_and_likeness():
    rng = random.Random(2)
    text = " ".join(str(rng.random()) for _ in range(300))
    other = " ".join(str(rng.random()) for _ in range(300))
    for t in ("", "a", "ab" * 40_000, text):
        sig = ctph.signature(t)
        assert ctph.written(ctph.read(ctph.written(sig))) == ctph.written(sig)
        assert all(len(s) <= ctph.MOST for s in sig[1])
        assert ctph.likeness([sig], [ctph.signature(t)])[0] == 1.0
    near = text[: len(text) * 3 // 4] + other[: len(text) // 4]
    a, b, c = map(ctph.signature, (text, near, other))
    assert ctph.likeness([a], [b])[0] > 0.6 and ctph.likeness([a], [c])[0] < 0.2


def test_common_subsequence_against_the_table():
    rng = np.random.default_rng(1)
    for _ in range(50):
        x, y = (rng.integers(0, 4, rng.integers(0, 65)).astype(np.int16) for _ in range(2))
        table = np.zeros((len(x) + 1, len(y) + 1), dtype=int)
        for i in range(len(x)):
            for j in range(len(y)):
                table[i + 1, j + 1] = table[i, j] + 1 if x[i] == y[j] else max(table[i, j + 1], table[i + 1, j])
        assert ctph.common_lengths([x], [y])[0] == table[-1, -1]


@pytest.mark.parametrize("buckets", [1, 3, 7])
def test_edits_take_the_next_document(spark, buckets):
    docs = spark.createDataFrame(AWKWARD, DOCS).withColumn("key", F.lit("clash")).repartition(3)
    got = ctph.compare_with_edits(docs, buckets=buckets)
    order = sorted(((i is not None, i or 0, t or "") for i, t, *_ in AWKWARD))
    want = []
    for k, (_, _, text) in enumerate(order):
        after = order[(k + 1) % len(order)][2]
        cut = len(text) // 4
        want.append((len(text), text[: len(text) - cut] + after[:cut]))
    from hashlib import sha256

    found = sorted((r["n_chars"], r["edited_sha256"]) for r in got.collect())
    assert found == sorted((n, sha256(e.encode()).hexdigest()) for n, e in want)
    assert ctph.compare_with_edits(docs.limit(0)).count() == 0


def test_long_runs_of_blanks_are_encoded_as_the_library_does():
    library, own = Tokenizer.from_file(queries.BYTE_BPE), packing.tokens(queries.BYTE_BPE)
    rng = random.Random(8)
    blanks = [" ", "\n", "\t", " \n", "　", "\xa0 "]
    texts = ["".join(rng.choice(["a", "B.", "é", "<|endoftext|>", "1", "\x1c", *[b * 9 for b in blanks], *blanks]) for _ in range(12)) for _ in range(1500)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    # With a small limit every run of nine counts as long.
    assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts, long=6)] == want


@pytest.mark.parametrize("blank", [" ", "\n"])
def test_five_million_blanks_are_packed(spark, blank):
    docs = spark.createDataFrame([(1, "a" + blank * 5_000_000 + "b"), (2, blank * 5_000_000)], "doc_id long, text string")
    got = packing.pack_documents(docs, queries.BYTE_BPE).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    one = packing.tokens(queries.BYTE_BPE)
    for r in got.collect():
        assert r.n == r["all"]
    tail = list(one.encode(["a" + blank * 100_000 + "b"]))[0]
    assert len(tail) // 4 == len(Tokenizer.from_file(queries.BYTE_BPE).encode("a" + blank * 100_000 + "b", add_special_tokens=False).ids)
