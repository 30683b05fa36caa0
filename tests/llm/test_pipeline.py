import re

import corpus_pipeline as C
import pytest
from odd import ODD
from test_decontaminate import brute as hits
from test_near_dup import brute as groups

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    """Each stage's rows, from its own input, by plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns
        before, out_rows = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()}
        pairs = [(d, r.text) for d, r in before.items()]
        if name == "language":
            assert set(out_rows) == {d for d, r in before.items() if any(c.isalpha() for c in r.text)}
        elif name == "near_duplicates":
            assert set(out_rows) == {g[0] for g in groups(pairs) if g[3]}
        elif name == "decontamination":
            assert set(out_rows) == {h[0] for h in hits(pairs, items) if not h[5]}
        else:
            secret = re.compile(r"(?i:token)[\"']? *[:=] *[\"']?[A-Za-z0-9+/_.=-]{12,}|[0-9a-f]{16,}")
            assert set(out_rows) == set(before) and not any(secret.search(r.text) for r in out_rows.values())
            assert all(r.text == before[d].text for d, r in out_rows.items() if not secret.search(before[d].text))
            assert all(r.n_chars == len(r.text) for r in out_rows.values())
        docs = spark.createDataFrame(out.collect(), out.schema)
    packed = C.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_in_every_stage(spark, documents, empty):
    docs = documents(ODD, ["en", None, "en", None, "en", "fr", "fr", "en", "ja", "en"])
    docs = docs.limit(0) if empty else docs
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
    ids = [r.doc_id for r in docs.collect()]
    assert ids == [] if empty else sorted(ids, key=str) == [1, 5, 6, 7, None]
    C.STAGES[-1][1](spark, docs, SF).collect()


def test_other_languages_go(spark):
    """The prediction decides, not the label: documents of a language that is not kept go, and those of too low a score."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = C.language(spark, docs, SF, keep=("en", "fr"))
    left = {r.doc_id: r.lang for r in kept.collect()}
    lettered = {r.doc_id: r.lang for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    wanted = {d for d, lang in lettered.items() if lang in ("en", "fr")}
    assert 0 < len(wanted) < len(lettered) and len(wanted ^ set(left)) <= 0.02 * len(lettered)
    wrong = docs.withColumn("lang", C.F.when(C.F.col("doc_id") == min(wanted), "de").otherwise(C.F.col("lang")))  # one label is wrong
    assert min(wanted) in {r.doc_id for r in C.language(spark, wrong, SF, keep=(lettered[min(wanted)],)).collect()}
    assert C.language(spark, docs, SF, least_score=1.1).count() == 0


def test_order():
    assert [n for n, _ in C.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "packing"]


def test_rows_are_judged_by_their_own_text(spark, documents):
    """Rows without an id are rejected like others; of one id's two texts only the bad one goes."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").select("text").orderBy("item_id").first().text
    near = " ".join(f"common{i} words" for i in range(40))
    own = {i: " ".join(f"own{i} thing{j} stays" for j in range(20)) for i in range(8)}
    rows = [(1, near), (2, near + " end"), (2, own[2]), (None, near + " last"), (None, own[0]), (None, "123 ### 456"), (3, "99 !!"), (3, own[3]),
            (None, f"{own[4]} {item}"), (5, f"{own[5]} {item}"), (5, own[6]), (None, own[7]), (None, own[7])]
    docs = documents(rows, "en")
    for _, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    got = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
    assert got == sorted([(1, near), (2, own[2]), (None, own[0]), (3, own[3]), (5, own[6]), (None, own[7])], key=str)
