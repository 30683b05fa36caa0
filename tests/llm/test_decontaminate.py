import hashlib
import random
import re

from odd import ODD

from wardline.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            wins.setdefault(tuple(w[k : k + 10]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(k) for k in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit |= set(range(k, k + n))
                    ids |= wins[tuple(w[k : k + n])]
        ids = sorted(str(i) for i in ids if i is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id long, text string, key string, n long")


def test_equal_to_brute_force(spark, documents):
    rng = random.Random(5)
    bag = ["The", "of", "É", "x1", "rare", "WORD", "and", "to"]
    items = [(i, " ".join(rng.choices(bag, k=rng.choice([3, 9, 10, 14, 30])))) for i in range(25)]
    items += [(3, items[3][1]), (99, items[4][1]), (None, items[5][1]), (50, None), (51, "..."), (52, "solo")]
    docs = [(100 + i, " ".join(rng.choices(bag, k=40)) + ", " + rng.choice(items[:20])[1].upper().replace("É", "É") + "; " + " ".join(rng.choices(bag, k=9))) for i in range(40)]
    docs += [*ODD, (300, "solo"), (301, "Solo! solo " + items[1][1])]
    got = D.decontaminate(documents(docs), frame(spark, items))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([(d, t) for d, t in docs], items)


def test_proximity(spark, documents):
    items = frame(spark, [(1, "alpha beta gamma delta")])
    docs = documents([(1, "x alpha beta gamma delta"), (2, "delta then gamma so beta and alpha"), (3, "alpha beta")])
    wins = D.windows(items)
    freq = D.frequencies(docs, wins.selectExpr("explode(terms) AS term").distinct(), 4)
    looked = D.anchors(wins, freq)
    postings = D.build_index(docs, looked.select("term"), 1)
    got = {(r.doc_id, r.exact) for r in D.matches(postings, looked, 1, proximity=True).collect()}
    assert got == {(1, True), (2, False)}


def test_proximity_counts_a_term_as_often_as_the_window(spark, documents):
    wins = D.windows(frame(spark, [(1, "a a b")]))
    docs = documents([(1, "a x b"), (2, "b a x a"), (3, "a a b"), (4, "b b a")])
    looked = D.anchors(wins, D.frequencies(docs, wins.selectExpr("explode(terms) AS term").distinct(), 2))
    postings = D.build_index(docs, looked.select("term"), 1)
    assert {(r.doc_id, r.exact) for r in D.matches(postings, looked, 1, proximity=True).collect()} == {(2, False), (3, True)}


def test_rows_that_share_or_lack_an_id(spark, documents):
    item = "one two three four five six seven eight nine ten"
    docs = [(None, "clean words here"), (None, f"x {item} y"), (5, item), (5, "other text"), (5, item), (None, None), (6, item.upper())]
    got = D.decontaminate(documents(docs), frame(spark, [(1, item)]))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, [(1, item)])


def test_empty(spark, documents):
    none = frame(spark, [(1, "x")]).limit(0)
    assert [r.n_hit for r in D.decontaminate(documents([(1, "x y")]), none).collect()] == [0]
    assert D.decontaminate(documents([(1, "x")]).limit(0), frame(spark, [(1, "x")])).count() == 0
