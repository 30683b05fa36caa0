from odd import ODD

from wardline.llm import license_scan as L


def files(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, path string, text string, license string, of long")


def test_headers_and_inheritance(spark):
    rows = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c/x.txt", "some words"), (3, "a/b/y.txt", "text\nLicensed under the Apache License, Version 2.0.\nmore"),
            (4, "z/w.txt", "no license, all in all; version 2"), (5, "a/b/LICENSE", "Licensed under CC BY-NC 4.0."), (6, "top.txt", None), (7, None, "words"), (8, "a", "words")]
    got = {r.doc_id: (r.license, r.inherited_from) for r in L.scan(files(spark, rows)).collect()}
    assert got == {1: ("MIT", None), 2: ("CC-BY-NC-4.0", "a/b"), 3: ("Apache-2.0", None), 4: (None, None), 5: ("CC-BY-NC-4.0", None),
                   6: (None, None), 7: (None, None), 8: (None, None)}


def test_passed_over_lines_cannot_reach_the_threshold():
    idf = dict.fromkeys(["", *L.VOCABULARY], 1.0) | {"license": 5.0, "the": 0.2}
    m = L.Matcher(idf)
    every = L.Matcher(idf)
    every.any = __import__("re").compile("")
    for line in ["released under the", "the the the work is", "mit", "all rights", "all rights reserved", "this file is subject to the terms", "gnu general public license", "version 2.0"]:
        assert m.line(line) == every.line(line)
    for name, text in L.TEMPLATES.items():
        assert m.line(text.lower())[1] == name


def test_odd_rows(spark):
    rows = [(d, f"s/{d}", t) for d, t in ODD]
    assert L.scan(files(spark, rows)).count() == len(ODD)
    assert L.scan(files(spark, rows).limit(0)).count() == 0


def wrapped(text, mark="", width=70):
    import textwrap

    return "\n".join(mark + line for line in textwrap.wrap(" ".join(text.split()), width))


def test_whole_texts_and_headers_are_told_apart(spark):
    rows, want = [], {}
    for i, (name, texts) in enumerate(sorted(L.LONG.items())):
        for k, text in enumerate(texts):
            at, own, other = 100 * i + 10 * k, f"d{i}x{k}", "plain words that hold nothing\n" * 40
            title = f"{name} License\n\nCopyright (c) 2020 Some One\n\n" if k == 0 else ""
            rows += [(at, f"{own}/LICENSE", title + wrapped(text)), (at + 1, f"{own}/src/a.c", other), (at + 2, "else/b.c", f"{wrapped(text, ' * ', 60)}\n{other}")]
            want |= {at: (name, None), at + 1: (name, own), at + 2: (name, None)}
    got = {r.doc_id: (r.license, r.inherited_from) for r in L.scan(files(spark, rows)).collect()}
    assert got == want


def test_windows_equal_brute_force():
    """No window that reaches the threshold is passed over."""
    import random
    from collections import Counter

    rng = random.Random(2)
    idf = dict.fromkeys(["", *L.VOCABULARY], 9.0) | {"the": 1.1, "of": 1.2, "and": 1.2, "software": 4.0, "license": 3.0}
    m = L.Matcher(idf)
    for name in ("MIT", "ISC", "GPL-3.0", "CC-BY-SA-4.0"):
        lines = [*["some other words here"] * 3, *wrapped(L.LONG[name][0]).lower().split("\n"), "the end of it"]
        for _ in range(4):
            kept = [" ".join(w for w in x.split() if rng.random() < 0.8) for x in lines]
            want = []
            for other, u, size, _ in m.long:
                for b in range(len(kept)):
                    e, words = b, []
                    while e < len(kept) and len(words) < size:
                        words += L.pieces(kept[e])
                        e += 1
                    v, norm = m.weights(Counter(words))
                    cosine = sum(x * v.get(t, 0.0) for t, x in u.items()) / norm
                    if L.pieces(kept[b]) and cosine >= m.least:
                        want.append((other, b, e, round(cosine, 9)))
            assert [(n, b, e, round(c, 9)) for c, n, b, e in m.windows(kept)] == want
            assert want
