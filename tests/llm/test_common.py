import subprocess
import sys
import zlib

from pyspark.sql import functions as F

from wardline.llm import arrays
from wardline.llm.common import ascii_lower, bounded_sample, fold


def test_sample_of_hot_and_rare_labels(spark):
    rows = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 20, "rare").otherwise("other").alias("label"))
    got = {r.label: r.n for r in bounded_sample(rows, "label", 500, "id").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert got == {"hot": 500, "other": 500, "rare": 13}
    assert bounded_sample(rows.limit(0), "label", 5, "id").count() == 0


def test_folds_and_lower_case(spark):
    ids = [0, 1, -5, 2**62, None]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select(fold(F.col("doc_id"), 5)).collect()
    assert [r[0] for r in got] == [zlib.crc32(("" if i is None else str(i)).encode()) % 5 for i in ids]
    assert spark.range(1).select(ascii_lower(F.lit("AZÉİé"))).first()[0] == "azÉİé"


def test_words_and_blocks_of_texts():
    texts = ["a Bc\t\x0bD", "", " \n", "é x", "long " * 200_000, "end"]
    w = arrays.words(arrays.encode(texts))
    assert [w.first[i + 1] - w.first[i] for i in range(len(texts))] == [3, 0, 0, 2, 200_000, 1]
    assert w.hashes[1] == arrays.words([b"bC"]).hashes[0] and w.hashes[0] != w.hashes[1]
    parts = list(arrays.encoded(texts))
    assert [x for _, _, p in parts for x in p] == arrays.encode(texts) and parts[0][0] == 0 and parts[-1][1] == len(texts)
    assert list(arrays.encoded([])) == [] and list(arrays.encoded([None]))[0][2] == [b""]


def test_nothing_else_imports_the_operators():
    code = "import sys; sys.path.insert(0, '.'); import wardline.plans.queries, wardline.jobs; print([m for m in sys.modules if m.startswith('wardline.llm')])"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=__file__.rsplit("/tests/", 1)[0])
    assert out.stdout.strip() == "[]", out.stderr
