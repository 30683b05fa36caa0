import hashlib
import random
import re
import zlib

import numpy as np

from wardline.llm import conversation as C

SCHEMA = "conv_id long, turn long, role string, text string, roles string, piece long, of long, state int"
NEXT, FULL = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}
EMPTY = hashlib.sha256(b"").hexdigest()


def script(rows, i=0, last="", inserted=0):
    """Cost and audit of the cheapest edits, the least audit among them, by trying all (no more than two inserts in a row pay)."""
    ways = [(0, "")] if i == len(rows) and last in ("", "a") else []
    if i < len(rows):
        role, _, must, cut = rows[i]
        ways.append((4, "D", i + 1, last, 0))
        if not must:
            if role[:1] == NEXT[last] or (role[:1], last) == ("s", ""):
                ways.append((3 * cut, "K", i + 1, role[0], 0))
            ways.append((3 + 3 * cut, "R", i + 1, NEXT[last], 0))
    if inserted < 2:
        ways.append((3, "I", i, NEXT[last], inserted + 1))
    found = [w if len(w) == 2 else (w[0] + rest[0], w[1] + rest[1]) for w in ways if len(w) == 2 or (rest := script(rows, *w[2:]))]
    return min(found, default=None)


def forward(rows):
    """The same by rows from the last one on (for long conversations)."""
    g = {"": (0, ""), "a": (0, ""), "u": (3, "I"), "s": (6, "II")}
    for role, _, must, cut in reversed(rows):
        base = {}
        for q in g:
            ways = [(4 + g[q][0], "D" + g[q][1])]
            if not must:
                to = NEXT[q]
                ways.append((3 + 3 * cut + g[to][0], "R" + g[to][1]))
                if role[:1] == to or (role[:1], q) == ("s", ""):
                    ways.append((3 * cut + g[role[0]][0], "K" + g[role[0]][1]))
            base[q] = min(ways)
        ins = lambda q: (3 + base[q][0], "I" + base[q][1])
        g = {"u": min(base["u"], ins("a")), "a": min(base["a"], ins("u"))}
        g |= {q: min(base[q], (3 + g["u"][0], "I" + g["u"][1])) for q in ("", "s")}
    return g[""]


def judged(rows):
    """(role, text, must go, truncated) of rows in order, and the counts."""
    seen, out, counts = set(), [], [0, 0, 0]
    for role, text in rows:
        core = text.strip(" \t\n\v\f\r")
        kind = 0 if not core else 1 if (role, text) in seen else 2 if core[-1] not in ".!?" else None
        seen.add((role, text))
        if kind is not None:
            counts[kind] += 1
        out.append((role, text, kind in (0, 1), kind == 2))
    return out, counts


def repaired(rows, audit):
    last, out, rest = "", [], iter(rows)
    for letter in audit:
        row = next(rest) if letter != "I" else None
        if letter == "D":
            continue
        last = row[0][:1] if letter == "K" else NEXT[last]
        out.append(f"{row[0]}:{row[1]}" if letter == "K" else f"{FULL[last]}:{row[1] if row else ''}")
    return "\n".join(out), "".join(x[0] for x in out)


def expected(conv):
    """A conversation's digest, from rows (turn, role, text) after damage."""
    conv = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    rows, counts = judged([r[1:] for r in conv])
    turns = [t for t, *_ in conv if t is not None]
    cost, audit = forward(rows)
    text, initials = repaired(rows, audit)
    assert re.fullmatch("(s?(ua)+)?", initials)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(conv, conv[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def digests(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1, 1, 1) for r in rows], SCHEMA)
    return {r.conv_id: tuple(r)[1:] for r in C.digest(*C.repair(frame)).collect()}


ROLES, TEXTS = ["user", "assistant", "system", "tool", "", None, "user", "assistant"], ["Yes.", "No", "", None, " \t", "What?", "well ", "so!"]


def test_tables_equal_all_scripts():
    """Every conversation of up to five symbols, by trying all scripts."""
    rng = random.Random(3)
    for _ in range(300):
        rows = tuple((rng.choice(["user", "assistant", "system", "x"]), "t", rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(6)))
        symbols = np.array([0 if m else 1 + 2 * max(("sua".find(r[0])), -1) + c if r[0] in "sua" else 7 + c for r, _, m, c in rows], np.int64)
        edits, state = C.trace(symbols, 0, C.START)
        tail = C.Tables.tail(state)
        got = sum(e[2] for e in edits) + 3 * len(tail), "".join(e[0] for e in edits) + "I" * len(tail)
        assert got == script(rows) == forward(rows)


def test_a_summed_up_piece_equals_its_rows():
    rng = np.random.default_rng(4)
    for n in (1, 3, 4, 5, 17):
        symbols = rng.integers(0, C.SYMBOLS, n)
        vectors, leads = C.summary(symbols)
        t = C.tables()
        for v in range(len(t.vectors)):
            at = v
            for s in symbols[::-1]:
                at = t.to[1][at, s]
            assert vectors[v] == at
            for q in range(4):
                assert leads[v] >> 2 * q & 3 == C.trace(symbols, v, q)[1]


def test_small_conversations(spark):
    rng = random.Random(1)
    convs = {c if c else None: [(rng.choice([None, 1, 2, 3, 7, 9]), rng.choice(ROLES), rng.choice(TEXTS)) for _ in range(rng.randrange(1, 14))] for c in range(150)}
    for rows in convs.values():  # rows of one turn: by role, then text's first characters
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, " " if r[1] is None else r[1], " " if r[2] is None else r[2]))
    got = digests(spark, [(c, *r) for c, rows in convs.items() for r in rows])
    assert got == {c: expected(rows) for c, rows in convs.items()}


def test_a_conversation_over_many_partitions(spark):
    """One holds most rows and crosses partitions; its repeated rows lie far apart."""
    rng = random.Random(2)
    hot = [(i // 2 if i % 50 else None, rng.choice(["user", "assistant", "system", "tool"]), f"{'a' * (i % 3)} text {rng.randrange(900)}{rng.choice(['.', ''])}") for i in range(6000)]
    hot = list({(t, r): (t, r, x) for t, r, x in hot}.values())
    convs = {7: hot, 8: [(1, "user", "Hi."), (2, "assistant", "Ho.")], 3: [(1, "assistant", "Ho")]}
    got = digests(spark, [(c, *r) for c, rows in convs.items() for r in rows])
    assert got == {c: expected(rows) for c, rows in convs.items()}


def test_damage_and_dropped_conversations(spark):
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["user", "assistant"]), f"Text {c} {t}! ok.") for c in range(200) for t in range(rng.randrange(1, 3))]
    rows += [(None, None, None, None), (99, None, "user", "No turn.")]
    frame = spark.createDataFrame([(*r, "x", 1, 1, 1) for r in rows], SCHEMA)
    got = {r.conv_id: tuple(r)[1:] for r in C.digest(*C.repair(C.damage(frame))).collect()}
    convs = {c: [] for c, *_ in rows}
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if k == 1 else re.sub("[.!?]", "", x or " ") if k == 2 else x
        convs[c] += [(t, "user" if k == 4 else r, x)] * (0 if k == 0 else 2 if k == 3 else 1)
    assert any(not r for r in convs.values())
    assert got == {c: expected(r) for c, r in convs.items()}
    assert all(v == (0, 0, 0, 0, 0, 0, "", EMPTY) for c, v in got.items() if not convs[c])


def test_rows_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, 1, "assistant", "Well.", "x", 1, 1, 1), (1, 2, "user", "So.", "x", 1, 1, 1)], SCHEMA)
    rows = C.repaired_rows(*C.repair(frame)).orderBy("piece", "place").collect()
    assert [(r.role, r.text) for r in rows] == [("user", ""), ("assistant", "Well."), ("user", "So."), ("assistant", "")]
    assert C.digest(*C.repair(frame.limit(0))).collect() == []
