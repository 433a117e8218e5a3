"""run() against a version of its stages on plain rows."""

import hashlib
import zlib

import numpy as np
import pytest

import corpus_pipeline
from tokenizers import Tokenizer

from emberline.llm import mixing, packing, quality_ranker, secret_scan
from pyspark.sql import functions as F
from test_operators import brute_classes, prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    good = [prose(60 + i % 30) + (" token = abcdef123456" if i % 9 == 0 else "") for i in range(120)]
    texts = good + [good[3], good[4] + " more"] + [" ".join(w.upper() + "!!" for w in prose(50).split()) for _ in range(30)] + [None, ""]
    rows = [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 122), 0) for i in range(152) if i % 2], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_do_what_they_say(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, folder).cache()
        kept[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    before, after = kept["quality"]
    scores = {r.doc_id: r.predicted for r in quality_ranker.classify(before, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    assert {r.doc_id for r in after.collect()} == {d for d, p in scores.items() if p}
    assert {r.doc_id for r in after.collect()} >= set(range(120))
    before, after = kept["near_duplicates"]
    classes = brute_classes([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for d, _, c in classes if d == c)
    before, after = kept["secrets"]
    scanner = secret_scan.Scanner()
    assert before.count() == after.count() and not any(scanner.found(r.text) for r in after.collect())
    before, after = kept["mixing"]
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in before.collect())
    before, after = kept["packing"]
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    texts = {r.doc_id: r.text for r in before.collect()}
    ids = {d: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for d, t in texts.items()}
    for r in after.collect():
        part = (ids[r.doc_id] + np.array([0], "<u4").tobytes())[4 * r.start : 4 * (r.start + r.length)]
        assert zlib.crc32(part) == r.ids_crc32
    assert {r.doc_id for r in after.collect()} == set(texts)


@pytest.fixture(scope="module")
def stored(spark, folder, tmp_path_factory):
    """What each stage returns, as a table that the next one reads."""
    path = str(tmp_path_factory.mktemp("stages"))
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{path}/{name}")
        docs = out[name] = spark.read.parquet(f"{path}/{name}")
    return out


def test_run_is_the_stages_in_turn(spark, folder, stored):
    got = corpus_pipeline.run(spark, folder)
    assert got.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, stored["packing"].collect())) == sorted(map(tuple, got.collect())) and stored["packing"].count() > 0


def test_the_mix_decides_where_pieces_go(spark, folder, tmp_path):
    """Sequences follow the stream of the mix; packed without it they come in another order."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("text IS NOT NULL")
    long = docs.selectExpr("doc_id", "repeat(text, 40) AS text", "lang", "source", "n_chars")  # a sequence holds few
    long.repartition(3, "source").write.parquet(f"{tmp_path}/long")
    docs = spark.read.parquet(f"{tmp_path}/long")
    corpus_pipeline.mix(spark, docs, folder).write.parquet(f"{tmp_path}/mixed")
    slots = {r.doc_id: r._slot for r in mixing.schedule(docs).collect()}
    number = lambda d: {r.doc_id: r.n for r in corpus_pipeline.pack(spark, d, folder).groupBy("doc_id").agg(F.min("sequence_id").alias("n")).collect()}
    mixed, plain = number(spark.read.parquet(f"{tmp_path}/mixed")), number(docs)
    ids = sorted(slots)
    along = lambda n: np.corrcoef([slots[d] for d in ids], [n[d] for d in ids])[0, 1]
    assert mixed != plain and along(mixed) > 0.7 > along(plain)


CLASHING = ["_slot", "_source", "_slots", "_scheduled", "_n0", "_key", "_tie", "_weight", "_bucket", "_rank", "_rank_in_source", "_id", "_hash", "n", "stays", "_quality_score", "score", "score_0", "node", "set", "part", "_part", "_row", "row", "length", "sequence_id"]


def test_extra_columns_of_any_name(spark, folder, tmp_path, stored):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = docs.select("*", *[(F.col("doc_id") * 100 + k).alias(c) for k, c in enumerate(CLASHING)])
    for name, stage in corpus_pipeline.STAGES:
        before, docs = odd, stored[name]
        stage(spark, odd, folder).write.parquet(f"{tmp_path}/odd-{name}")
        odd = spark.read.parquet(f"{tmp_path}/odd-{name}")
        if name != "packing":
            assert odd.columns == before.columns
            assert sorted((r.doc_id, r.text) for r in odd.collect()) == sorted((r.doc_id, r.text) for r in docs.collect())
            assert odd.where(" OR ".join(f"`{c}` <> doc_id * 100 + {k}" for k, c in enumerate(CLASHING))).count() == 0
    assert odd.count() == docs.count()


def test_empty_corpus(spark, folder, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{t}.parquet").where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert hashlib.sha256(b"").hexdigest()
