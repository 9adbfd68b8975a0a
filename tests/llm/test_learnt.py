"""Classifiers by held-out accuracy, chat and personal data by exact results, and the pipeline."""

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import corpus_pipeline  # noqa: E402
from brute import AWKWARD, DOCS, private  # noqa: E402
from compare import connect, differences  # noqa: E402

from musterline.llm import chat, gbt, labelled, pii, queries, textcnn  # noqa: E402

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


def test_fold_is_the_crc_of_the_id_as_text(spark):
    got = spark.range(300).select("id", labelled.held_out("id").alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in got)
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS id").select(labelled.held_out("id")).first()[0] is False


@pytest.mark.parametrize("query, label, limit", [("op6_quality", "quality", 0.97), ("op8_toxicity", "toxic", 0.94)])
def test_held_out_accuracy(spark, query, label, limit):
    got = queries.all_queries()[query](spark, MIDDLE)
    truth = spark.read.parquet(f"{MIDDLE}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    rows = got.where("held_out").join(truth, "doc_id").select("y", "score", "predicted").toPandas()
    assert (rows.y == rows.predicted).mean() > limit
    assert rows.score.between(0, 1).all()
    assert got.count() == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()


def test_scores_of_awkward_rows_and_no_labels(spark):
    docs = spark.createDataFrame(AWKWARD, DOCS).withColumn("y", F.lit("clash")).withColumn("codes", F.lit(1))
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (7, 1, 1), (None, 1, 1), (3, None, None), (9, 5, 5)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        scored = gbt.score(docs, gbt.fit(docs, some))
        assert scored.count() == len(AWKWARD) and scored.where("score between 0 and 1").count() == len(AWKWARD)
        net = textcnn.fit(docs, some)
        toxic = textcnn.flagged(textcnn.score(docs, net), net)
        assert toxic.where("score between 0 and 1 and flagged is not null").count() == len(AWKWARD)
    assert gbt.accepted(docs, labels.limit(0)).columns == docs.columns
    assert gbt.accepted(docs, labels.limit(0)).count() == len(AWKWARD)
    assert gbt.score(docs.limit(0), gbt.fit(docs, labels)).count() == 0


@pytest.mark.parametrize("y, kept", [(0, 0), (1, 4)])
def test_labels_of_one_class_decide(spark, y, kept):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(4)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i in range(3)], "doc_id long, quality int")
    assert gbt.accepted(docs, labels).count() == kept


def test_score_depends_on_the_text_alone(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    forest = gbt.fit(docs, labels)
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy"))
    assert gbt.score(docs, forest).select("score").collect() == gbt.score(other, forest).select("score").collect()


def test_forest_walk_equals_single_steps():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    y = (x[:, 0] + (x[:, 1] > 0) > 0.3).astype(float)
    forest = gbt.grow(x, y, trees=10, depth=3)
    slow = []
    for row in x:
        total = forest.base
        for t in range(len(forest.feature)):
            at = 0
            for _ in range(forest.depth):
                at = 2 * at + 1 + int(row[forest.feature[t, at]] > forest.threshold[t, at])
            total += forest.value[t, at - 7]
        slow.append(total)
    assert np.allclose(forest.margin(x), slow)
    assert ((forest.score(x) > 0.5) == (y > 0)).mean() > 0.95


def test_pooling_takes_the_largest_window_of_the_whole_text():
    net = textcnn.train([textcnn.word_codes("good words here"), textcnn.word_codes("bad idiot words")] * 20, np.array([0.0, 1.0] * 20))
    codes = textcnn.word_codes("filler " * 40_000 + "bad idiot words")
    best, where = net.pooled(codes)
    rows = textcnn.rows_of(codes)
    e = net.embed[rows[0]] + net.embed[rows[1]]
    assert np.allclose(best[:8], (e @ net.filters[0][0]).max(axis=0), atol=1e-5)
    assert net.margin(codes) > net.margin(textcnn.word_codes("filler " * 40_000))
    assert net.pooled(textcnn.word_codes(""))[1].max() == -1


def test_chat_query_equals_sql(spark):
    assert differences(queries.op2_chat(spark, SMALL), connect(SMALL), queries.OP2_SQL) == []


MESSAGES = [
    (1, 1, None, "user", "q\\<|im_end|>\n%", 0.0), (1, 2, 1, "assistant", "a<", 1.0), (1, 3, 1, "ass\n<|is%3C", "b\\", 5.0),
    (1, 4, 2, "user", None, 2.0), (1, 4, 2, "user", None, 2.0), (2, 1, 2, "x", "on a cycle", 0.0), (2, 2, 1, "x", "too", 0.0),
    (2, 3, 2, "x", "below it", 0.0), (None, 7, 99, "user", "parent unknown", None), (5, None, None, "user", "no node", 1.0),
    *[(3, i, i - 1 if i else None, "user" if i % 2 else "assistant", f"t{i}", 1.0) for i in range(37)],
]
SCHEMA = "tree long, node long, parent long, role string, text string, score double"


def test_reply_trees(spark):
    messages = spark.createDataFrame(MESSAGES, SCHEMA).withColumn("leaf", F.lit("clash"))
    done = chat.format_trees(messages)
    got = {
        (r["tree"], r["leaf"]): r
        for r in done.select("*", chat.read_back(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    }
    assert set(got) == {(None, 7), (1, 3), (1, 4), (3, 36)}
    assert got[1, 3]["rank"] == 1 and got[1, 4]["rank"] == 2
    assert [tuple(t) for t in got[1, 3]["turns"]] == [("user", "q\\<|im_end|>\n%"), ("ass\n<|is%3C", "b\\")]
    assert [tuple(t) for t in got[1, 4]["turns"]] == [("user", "q\\<|im_end|>\n%"), ("assistant", "a<"), ("user", "")]
    assert got[1, 4]["loss"] == "a<" and got[3, 36]["loss"] == "".join(f"t{i}" for i in range(0, 37, 2))
    assert got[3, 36]["n_turns"] == 37
    assert {(r["tree"], r["rank"]) for r in chat.format_trees(messages, top=1).collect()} == {(None, 1), (1, 1), (3, 1)}
    assert chat.format_trees(messages.limit(0)).count() == 0


def test_escapes_are_reversible(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["<", "|", "\\", "im_end", ">", "\n", "%", "3C", "25", "a"]) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = df.select("t", chat.escape(F.col("t")).alias("e"), chat.escape_role(F.col("t")).alias("r"))
    back = both.select("t", "e", chat.unescape(F.col("e")).alias("a"), chat.unescape_role(F.col("r")).alias("b")).collect()
    assert all(r["t"] == r["a"] == r["b"] and "<|" not in r["e"] for r in back)


def test_private_spans_against_plain_patterns(spark):
    rng = random.Random(3)
    parts = ["1", "2", "255", "256", ".", ".", "@", "a", "b.c", "-", "+", " ", "(", "1234", "4111111111111111", "a@b.co", "é", "_", "9"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    texts += [t for _, t, *_ in AWKWARD] + ["1" * 50_000, "1." * 20_000, "+1" + " 2" * 9_000, "a@" * 5_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("hits", F.lit(1)).withColumn("gaps", F.lit(1))
    got = {r["doc_id"]: r["w"] for r in pii.find(df, pii.Trees(0.0)).select("doc_id", pii.written(F.col("spans")).alias("w")).collect()}
    assert all(got[i] == ",".join(private(t)) for i, t in enumerate(texts))


def test_base_spans_stay_and_added_ones_do_not_touch_them(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = pii.fit(docs)
    assert model.trees
    model.thresholds = dict.fromkeys(range(4), 0.0)
    for row in pii.find(docs.where("doc_id < 300"), model).select("text", "spans").collect():
        base = [s for s in row["spans"] if s["base"]]
        assert [f"{pii.KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in base] == private(row["text"])
        assert not any(a["start"] < b["end"] and b["start"] < a["end"] for a in row["spans"] if not a["base"] for b in base)


def test_thresholds_come_from_all_documents(spark):
    """Neither a kind that is rare in the sample nor one beside very many numbers loses its learnt spans."""
    rng = random.Random(8)
    rows = []
    for i in range(1200):
        numbers = ", ".join(str(rng.randint(10**9, 10**10 - 1)) for _ in range(10))
        rows.append((i, f"list {numbers}; mail u{i}@b.co now" + (f", host 10.0.{i % 200}.7 up" if i % 20 == 0 else "")))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(docs, sample=400, documents=200)
    assert model.trees and {pii.KINDS[k] for k in model.thresholds} == {"email", "ip"}


def test_redaction_of_awkward_rows(spark):
    docs = spark.createDataFrame(AWKWARD, DOCS).withColumn("spans", F.lit("clash"))
    got = pii.redact(docs, pii.fit(docs))
    assert got.columns == docs.columns and got.count() == len(AWKWARD)
    text = got.where("doc_id = 7").first()
    assert text["text"] == "mail <EMAIL> or <PHONE>, card <CARD>, host <IP>" and text["n_chars"] == len(text["text"])
    assert got.where("doc_id = 2").first()["text"] is None
    assert pii.redact(docs.limit(0), pii.fit(docs.limit(0))).count() == 0


def test_plans_of_native_operators_run_no_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for df in (pii.find(docs, pii.fit(docs)), chat.format_trees(spark.createDataFrame(MESSAGES, SCHEMA))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_pipeline_stages_keep_columns_and_survive_awkward_rows(spark, tmp_path):
    good = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    for name, docs in (("awkward", spark.createDataFrame(AWKWARD, DOCS).unionByName(good)), ("empty", good.limit(0))):
        folder = f"{tmp_path}/{name}"
        docs = docs.withColumn("score", F.lit("clash"))
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
        step = spark.read.parquet(f"{folder}/documents.parquet")
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, step, folder)
            if k + 1 < len(corpus_pipeline.STAGES):
                assert out.columns == docs.columns
            out.write.parquet(f"{folder}/{k}")
            step = spark.read.parquet(f"{folder}/{k}")
        assert (step.count() > 0) == (name == "awkward")


def test_pipeline_against_its_parts(spark):
    """Every stage's decisions, made again in plain Python on what the stage before kept."""
    from brute import repeats, roots, simhash

    from musterline.llm.packing import tokens

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").where(~labelled.held_out())
    forest = gbt.fit(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    scores = forest.score(gbt.statistics_of(list(texts.values())))
    kept = {i: t for (i, t), s in zip(texts.items(), scores, strict=True) if s >= 0.7}
    prints = {i: simhash(t) for i, t in kept.items()}
    root = roots([(i, j) for i in kept for j in kept if i < j and (prints[i] ^ prints[j]).bit_count() <= 4], kept)
    kept = {i: t for i, t in kept.items() if root[i] == i}
    data = [t.encode() for t in kept.values()]
    cut = [np.frombuffer(b, np.uint8)[~m].tobytes().decode(errors="ignore") for b, m in zip(data, repeats(data, 200), strict=True)]
    kept = dict(zip(kept, cut, strict=True))
    for i, t in kept.items():
        spans = sorted(tuple(map(int, s.split(":")[1:])) + (s.split(":")[0],) for s in private(t))
        out, at = [], 0
        for a, b, kind in spans:
            if a >= at:
                out.append(t[at:a] + f"<{kind.upper()}>")
            at = max(at, b)
        kept[i] = "".join(out) + t[at:]
    want = sorted((i, len(b) // 4 + 1) for i, b in zip(kept, tokens(queries.BYTE_BPE).encode(list(kept.values())), strict=True))
    pieces = corpus_pipeline.run(spark, SMALL)
    got = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert sorted((r["doc_id"], r["n"]) for r in got) == want and all(r["n"] == r["t"] for r in got)
