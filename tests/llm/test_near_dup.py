import random

import numpy as np
from odd import ODD

from wardline.llm import near_dup as N


def sets(rows):
    out = []
    for d, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in __import__("re").split("[ \t-\r]+", low) if x]
        out.append((d, {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()))
    return out


def brute(rows):
    s = sets(rows)
    up = list(range(len(s)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(s)):
        for j in range(i):
            both = len(s[i][1] & s[j][1])
            if None in (s[i][0], s[j][0]):
                continue
            if s[i][0] == s[j][0] and s[i][1] and s[j][1] or both and 100 * both >= 75 * (len(s[i][1]) + len(s[j][1]) - both):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(s):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(x), least[find(i)] if d is not None else None, d is None or least[find(i)] == d) for i, (d, x) in enumerate(s)), key=str)


def planted(rng):
    """Hubs with copies that resemble them but not each other, chains, exact copies and shared passages."""
    rows, bag, passage = [], [f"w{i}" for i in range(4000)], " ".join(f"p{i}" for i in range(30))
    for h in range(12):
        hub = rng.choices(bag, k=rng.choice([8, 40, 300]))
        rows.append(hub)
        for _ in range(rng.choice([1, 3, 30])):
            copy = list(hub)
            for i in rng.sample(range(len(copy)), max(1, len(copy) // 45)):
                copy[i] = rng.choice(bag)
            rows.append(copy)
        rows.append(list(hub))
    rows += [rng.choices(bag, k=60) + passage.split() for _ in range(60)]
    rows = [" ".join(r) for r in rows]
    rng.shuffle(rows)
    return list(enumerate(rows, 1000))


def test_equal_to_brute_force(spark, documents):
    rows = [*ODD, *planted(random.Random(4)), (900, "one two three"), (901, "One TWO three"), (902, "one two three four"),
            (903, "an id on two texts that differ"), (903, "and on this one that has a twin"), (904, "and on this one that has a twin")]
    want = brute(rows)
    for region, chunk in ((N.REGION, N.CHUNK), (8, 8)):  # whole regions, or nearly all of them dealt out in chunks
        got = N.near_duplicates(documents(rows), region, chunk)
        assert sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str) == want


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(259, 300), (5, 300), (9, 8)]
    got = {r.node: r.root for r in N.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {**dict.fromkeys(range(100, 141), 100), **dict.fromkeys([*range(200, 260), 300, 7, 5], 5), 8: 8, 9: 8}
    assert N.components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for share in (0.75, 0.9):
        x = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2)
        both = int(2000 * 2 * share / (1 + share))
        a, b = np.sort(x[:2000]), np.sort(np.concatenate([x[:both], x[2000 : 4000 - both]]))
        s = N.signatures([a, b])
        assert abs((s[0] == s[1]).mean() - share) < 0.16


def test_empty(spark, documents):
    assert N.near_duplicates(documents([(1, "x")]).limit(0)).count() == 0
    assert [r.kept for r in N.near_duplicates(documents([(1, None), (2, "")])).collect()] == [True, True]


def test_deepened_regions_lose_no_link(spark, documents):
    """Regions of one tree that are all deepened, by recall against brute force over many near copies."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(150):
        copy = list(base)
        for j in rng.sample(range(80), rng.choice([0, 1, 2, 3])):
            copy[j] = f"n{rng.randrange(9)}"
        rows.append((i, " ".join(copy)))
    rows += [(500 + i, " ".join(base[:30] + [f"o{i}x{j}" for j in range(40)])) for i in range(60)]
    want = brute(rows)
    got = N.near_duplicates(documents(rows), 16, 16)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str) == want
