"""Conversation structure repair: the cheapest edits to a legal order of roles, by Four-Russians block tables.

A conversation is a row of symbols: its rows in order, each with the initial of its role
and its first fault. The edits are Keep (0), Rerole to user or assistant (3), Delete (4; a
must for blank and duplicate rows) and Insert of an empty user or assistant row (3); a
truncated row that stays costs 3 more. What they must give is ``(s?(ua)+)?``: a machine of
four states. The cost vector holds, for each state, the least cost of all that follows; it is
computed from the last row to the first. Less its least entry, it can take only a few values,
so a step is a table of (vector, symbol), and a block of ``BLOCK`` symbols is one look-up in
a table of all vectors and blocks, made once. The table also holds where each state leads.

The edits are traced from the first row on: a block is expanded backward from the vector
behind it, which gives the exact cost to go at each of its rows, and of the edits that
reach it the letter that is least in ASCII order (D, I, K, R) is taken. So of all cheapest
scripts the least is found, whatever the ties.

Conversations are sorted over all partitions and cut into pieces of at most ``ROWS`` rows
(or ``TEXT`` bytes), so that one of any length spreads over many tasks. A conversation of one piece,
as nearly all are, is solved where it lies. Of the others each piece is summed up as a map
from the vector behind it to the vector before it, and from the state before it to the one
behind it. A pass from the last piece on hands out vectors, one from the first on states,
each over one small row a piece; what was seen in earlier pieces is found by a minimum
over hashes of the rows. A conversation's text is hashed piece after piece, as a stream.

Defined results: a null role or text counts as one space; null ids form one conversation,
null turns come first; rows of one turn are ordered by role, then text (its first 64
characters, then a hash); rows flagged ``gone`` only keep their conversation in the result;
a conversation without rows gives zeros and the empty string's hash; roles that begin with
neither s, u nor a must be reroled or deleted; other columns are not read; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Batches, broadcast_if_small, in_order, map_batches, materialise

#: Rows and bytes of a piece, symbols of a block.
ROWS, TEXT, BLOCK = 4096, 4 << 20, 4

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
INITIALS, FULL = "sua", {"u": "user", "a": "assistant"}
BLANKS = " \t\n\x0b\x0c\r"
#: States: nothing yet, after s, after u, after a. Where u or a leads, and what it is.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT, GIVES = (AFTER_U, AFTER_U, AFTER_A, AFTER_U), "uuau"
#: Symbol 0 must be deleted; 1 + 2 * role + truncated, the roles being s, u, a and any other.
SYMBOLS = 9


# ---------------------------------------------------------------- tables


def _keeps(state: int, role: int) -> int | None:
    """Where keeping a row of a role leads."""
    if role == 0:
        return AFTER_S if state == START else None
    return NEXT[state] if role < 3 and GIVES[state] == INITIALS[role] else None


def _closed(cost: list[float]) -> tuple[int, ...]:
    """The costs once rows may be inserted first."""
    for _ in range(3):
        cost = [min(c, INSERT + cost[NEXT[q]]) for q, c in enumerate(cost)]
    return tuple(cost)


def _edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """The edits of a row as (letter, cost, state after it), by letter."""
    out = [("D", DELETE, state)]
    if symbol:
        role, rest = divmod(symbol - 1, 2)
        kept = _keeps(state, role)
        if kept is not None:
            out.append(("K", KEEP + TRUNCATED * rest, kept))
        out.append(("R", REROLE + TRUNCATED * rest, NEXT[state]))
    return out


def step(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """The costs before a row, from those after it."""
    return _closed([min(c + after[to] for _, c, to in _edits(symbol, q)) for q in range(4)])


LAST = _closed([0, float("inf"), float("inf"), 0])


def _normal(cost: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    least = min(cost)
    return tuple(c - least for c in cost), least


class Tables:
    """All vectors that occur, and the step of every block up to ``BLOCK`` symbols."""

    def __init__(self, block: int = BLOCK):
        first = _normal(LAST)[0]
        self.vectors, at = [first], {first: 0}
        steps: list[list[int]] = []
        for v in self.vectors:  # grows while it is read
            row = []
            for s in range(SYMBOLS):
                to, _ = _normal(step(s, v))
                if to not in at:
                    at[to] = len(self.vectors)
                    self.vectors.append(to)
                row.append(at[to])
            steps.append(row)
        n = len(self.vectors)
        #: What a state does before and at a row: (edits, rows given: (initial, or K for a kept one), cost, state after).
        self.trace = [[[self._traced(s, v, q) for q in range(4)] for s in range(SYMBOLS)] for v in range(n)]
        self.to = {0: np.arange(n, dtype=np.int16).reshape(n, 1), 1: np.array(steps, np.int16)}
        leads = np.array([[[self.trace[v][s][q][3] for q in range(4)] for s in range(SYMBOLS)] for v in range(n)], np.int8)
        self.leads = {0: np.broadcast_to(np.arange(4, dtype=np.int8), (n, 1, 4)), 1: leads}
        for k in range(2, block + 1):  # a symbol before each block of k - 1
            rest = self.to[k - 1]
            self.to[k] = np.stack([self.to[1][rest, s] for s in range(SYMBOLS)], axis=1).reshape(n, -1)
            self.leads[k] = np.stack([np.take_along_axis(self.leads[k - 1], self.leads[1][rest, s], axis=2)
                                      for s in range(SYMBOLS)], axis=1).reshape(n, -1, 4)

    def _traced(self, symbol: int, after: int, state: int) -> tuple[str, tuple[str, ...], int, int]:
        """From a state, the edits up to and with a row's: of the cheapest the least letter each time."""
        cost_after = self.vectors[after]
        before, edits, given, cost = step(symbol, cost_after), "", [], 0
        while True:
            ways = [w for w in _edits(symbol, state) if w[1] + cost_after[w[2]] == before[state]]
            if INSERT + before[NEXT[state]] == before[state]:
                ways.append(("I", INSERT, NEXT[state]))
            letter, c, to = min(ways)
            edits, cost = edits + letter, cost + c
            if letter in "IR":
                given.append((letter, GIVES[state]))
            elif letter == "K":
                given.append(("K", ""))
            state = to
            if letter != "I":
                return edits, tuple(given), cost, state

    @staticmethod
    def tail(state: int) -> list[str]:
        """The rows inserted behind the last one."""
        out = []
        while state not in (START, AFTER_A):
            out.append(GIVES[state])
            state = NEXT[state]
        return out


@lru_cache(1)
def tables() -> Tables:
    return Tables()


def blocks(symbols: np.ndarray) -> list[tuple[int, int, int]]:
    """The piece cut into blocks, as (first row, rows, code): the first is the short one."""
    n = len(symbols)
    out = []
    at = 0
    while at < n:
        size = (n - at) % BLOCK or BLOCK
        code = 0
        for s in symbols[at:at + size].tolist():
            code = code * SYMBOLS + s
        out.append((at, size, code))
        at += size
    return out


def summary(symbols: np.ndarray) -> tuple[list[int], list[int]]:
    """Of a piece: the vector before it for every vector behind it, and where the four states lead then (two bits each)."""
    t = tables()
    every = np.arange(len(t.vectors))
    vector, leads = every, np.broadcast_to(np.arange(4), (len(every), 4))
    for _, size, code in reversed(blocks(symbols)):
        through = t.leads[size][vector, code]
        leads = np.take_along_axis(leads, through.astype(np.int64), axis=1)
        vector = t.to[size][vector, code].astype(np.int64)
    return vector.tolist(), (leads << np.array([0, 2, 4, 6])).sum(axis=1).tolist()


def trace(symbols: np.ndarray, behind: int, state: int):
    """Of each row (edits, rows given, cost), given the vector behind the piece and the state before it; last, the state behind it."""
    t = tables()
    cut = blocks(symbols)
    vectors = [behind]
    for _, size, code in reversed(cut):
        vectors.append(int(t.to[size][vectors[-1], code]))
    vectors.reverse()  # vectors[j + 1] is behind block j
    out = []
    for j, (at, size, _) in enumerate(cut):
        row = symbols[at:at + size].tolist()
        after = [vectors[j + 1]]
        for s in reversed(row[1:]):
            after.append(int(t.to[1][after[-1], s]))
        for s, v in zip(row, reversed(after), strict=True):
            edits, given, cost, state = t.trace[v][s][state]
            out.append((edits, given, cost))
    return out, state


# ---------------------------------------------------------------- rows


def damage(conversations: DataFrame) -> DataFrame:
    """The rows, some made faulty by a hash of their place; dropped ones stay, flagged ``gone``."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    k = F.col("kind")
    twice = F.when(k == 3, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(k == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(k == 1, "").when(k == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                       (k == 0).alias("gone"), F.explode(twice).alias("copy")).drop("copy")


PIECES = "conv_id long, piece long, turns array<long>, roles array<string>, texts array<string>"
_PIECES = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())),
                     ("texts", pa.list_(pa.string()))])


def pieces(rows: DataFrame) -> DataFrame:
    """The sorted conversations in pieces of bounded size, numbered in their order, written."""
    def cut(batches: Batches) -> Batches:
        number = TaskContext.get().partitionId() << 33
        held = None
        for batch in batches:
            done = []
            for conv, turn, role, text, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or held["conv_id"] != conv or len(held["turns"]) == ROWS or size >= TEXT:
                    if held is not None:
                        done.append(held)
                        number += 1
                    held, size = {"conv_id": conv, "piece": number, "turns": [], "roles": [], "texts": []}, 0
                if not gone:
                    held["turns"].append(turn)
                    held["roles"].append(role)
                    held["texts"].append(text)
                    size += len(text)
            yield pa.RecordBatch.from_pylist(done, _PIECES)
        if held is not None:
            yield pa.RecordBatch.from_pylist([held], _PIECES)

    blank = F.lit(" ")
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"),
                        F.coalesce("text", blank).alias("text"), F.coalesce(gone, F.lit(False)).alias("gone"))
    ordered = in_order(plain, "conv_id", "turn", "role", F.substring("text", 1, 64), F.xxhash64("text"))
    return materialise(map_batches(ordered, cut, PIECES), "conversation-pieces")


def _key(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()


def faults(roles: list[str], texts: list[str], earlier: set[bytes]) -> tuple[np.ndarray, list[int]]:
    """The symbols of a piece's rows, and how many are blank, duplicate and truncated."""
    symbols, counts, seen = np.zeros(len(roles), np.int64), [0, 0, 0], set()
    for i, (role, text) in enumerate(zip(roles, texts, strict=True)):
        core = text.strip(BLANKS)
        again = (role, text) in seen or bool(earlier) and _key(role, text) in earlier
        seen.add((role, text))
        if not core:
            counts[0] += 1
        elif again:
            counts[1] += 1
        else:
            rest = core[-1] not in ".!?"
            counts[2] += rest
            at = INITIALS.find(role[:1]) if role else -1
            symbols[i] = 1 + 2 * (at if at >= 0 else 3) + rest
    return symbols, counts


def _illegal(one: str, two: str) -> bool:
    return one[:1] + two[:1] not in ("su", "ua", "au")


SOLVED = ("conv_id long, piece long, least long, most long, turns long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, n_rows long, first string, last string, roles array<string>, texts array<string>")
_SOLVED = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), *((c, pa.int64()) for c in (
    "least", "most", "turns", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("n_rows", pa.int64()),
    ("first", pa.string()), ("last", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])


def solved(found: DataFrame) -> DataFrame:
    """Pieces repaired: counts, edits, rows. ``earlier``, ``behind`` and ``state`` are null for a conversation of one piece."""
    def work(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for p in batch.to_pylist():
                roles, texts, turns = p["roles"], p["texts"], [t for t in p["turns"] if t is not None]
                symbols, counts = faults(roles, texts, set(p["earlier"] or ()))
                edits, state = trace(symbols, p["behind"] or 0, p["state"] or START)
                new_roles, new_texts = [], []
                for i, (_, given, _) in enumerate(edits):
                    for letter, initial in given:
                        new_roles.append(FULL[initial] if initial else roles[i])
                        new_texts.append("" if letter == "I" else texts[i])
                for initial in Tables.tail(state) if p["ends"] else ():
                    edits.append(("I", (), INSERT))
                    new_roles.append(FULL[initial])
                    new_texts.append("")
                out.append({
                    "conv_id": p["conv_id"], "piece": p["piece"], "least": min(turns, default=None), "most": max(turns, default=None),
                    "turns": len(set(turns)), "blank": counts[0], "duplicate": counts[1], "truncated": counts[2],
                    "illegal": sum(map(_illegal, roles, roles[1:])), "cost": sum(e[2] for e in edits), "audit": "".join(e[0] for e in edits),
                    "n_rows": len(roles), "first": roles[0] if roles else None, "last": roles[-1] if roles else None,
                    "roles": new_roles, "texts": new_texts})
            yield pa.RecordBatch.from_pylist(out, _SOLVED)

    return map_batches(found.select("conv_id", "piece", "turns", "roles", "texts", "earlier", "behind", "state", "ends"), work, SOLVED)


# ---------------------------------------------------------------- conversations of several pieces


def _spread(held: DataFrame) -> DataFrame:
    """Pieces of conversations that have several: of each, what earlier pieces hold, the vector behind it, the state before it."""
    def keys(batches: Batches) -> Batches:
        for batch in batches:
            rows = [{"of": of, "piece": piece, "key": k} for of, piece, roles, texts in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                    for k in {_key(r, t) for r, t in zip(roles, texts, strict=True)}]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("of", pa.int64()), ("piece", pa.int64()), ("key", pa.binary())]))

    shown = materialise(map_batches(held.select("of", "piece", "roles", "texts"), keys, "of long, piece long, key binary"), "conversation-keys")
    first = shown.groupBy("of", "key").agg(F.min("piece").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # a piece has at most ROWS keys
    earlier = materialise(shown.join(first, ["of", "key"]).where("piece > first").groupBy("piece").agg(F.collect_list("key").alias("earlier")), "conversation-seen")

    def maps(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for of, piece, roles, texts, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                vectors, leads = summary(faults(roles, texts, set(seen or ()))[0])
                out.append({"of": of, "piece": piece, "vectors": vectors, "leads": leads})
            yield pa.RecordBatch.from_pylist(out, _MAPS)

    summed = materialise(map_batches(held.join(earlier, "piece", "left").select("of", "piece", "roles", "texts", "earlier"), maps, MAPS), "conversation-maps")

    def backward(batches: Batches) -> Batches:
        of = vector = None
        for batch in batches:
            out = []
            for p in batch.to_pylist():
                end = p["of"] != of
                if end:
                    of, vector = p["of"], 0
                out.append({"of": of, "piece": p["piece"], "behind": vector, "lead": p["leads"][vector], "ends": end})
                vector = p["vectors"][vector]
            yield pa.RecordBatch.from_pylist(out, _BEHIND)

    def forward(batches: Batches) -> Batches:
        of = state = None
        for batch in batches:
            out = []
            for p in batch.to_pylist():
                if p["of"] != of:
                    of, state = p["of"], START
                out.append({"piece": p["piece"], "behind": p["behind"], "state": state, "ends": p["ends"]})
                state = p["lead"] >> 2 * state & 3
            yield pa.RecordBatch.from_pylist(out, _PLACED)

    # one small row a piece
    behind = map_batches(summed.repartition("of").sortWithinPartitions("of", F.col("piece").desc()), backward, BEHIND)
    placed = materialise(map_batches(behind.repartition("of").sortWithinPartitions("of", "piece"), forward, PLACED), "conversation-states")
    return placed.join(earlier, "piece", "left")


MAPS = "of long, piece long, vectors array<int>, leads array<int>"
_MAPS = pa.schema([("of", pa.int64()), ("piece", pa.int64()), ("vectors", pa.list_(pa.int32())), ("leads", pa.list_(pa.int32()))])
BEHIND = "of long, piece long, behind int, lead int, ends boolean"
_BEHIND = pa.schema([("of", pa.int64()), ("piece", pa.int64()), ("behind", pa.int32()), ("lead", pa.int32()), ("ends", pa.bool_())])
PLACED = "piece long, behind int, state int, ends boolean"
_PLACED = pa.schema([("piece", pa.int64()), ("behind", pa.int32()), ("state", pa.int32()), ("ends", pa.bool_())])


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repaired pieces (:data:`SOLVED`): those that are a whole conversation, and those of conversations
    with several (``of`` names the conversation's first piece)."""
    cut = pieces(rows)
    several = cut.groupBy("conv_id").agg(F.min("piece").alias("of"), F.count(F.lit(1)).alias("n")).where("n > 1")
    several = materialise(several, "conversations-cut")
    few = broadcast_if_small(several, several.count(), 32)
    light = cut.select("conv_id", "piece").join(few, cut["conv_id"].eqNullSafe(several["conv_id"])).select("piece", "of")
    parts = materialise(light, "pieces-of-several")
    n = parts.count()
    if not n:
        return solved(_alone(cut)), solved(_alone(cut.limit(0))).withColumn("of", F.lit(0).cast("long"))
    whole = solved(_alone(cut.join(broadcast_if_small(parts.select("piece"), n, 16), "piece", "left_anti")))
    held = materialise(cut.join(broadcast_if_small(parts, n, 16), "piece"), "conversation-held")
    placed = solved(held.join(_spread(held), "piece"))
    return whole, placed.join(broadcast_if_small(parts, n, 16), "piece")


def _alone(cut: DataFrame) -> DataFrame:
    return cut.withColumns({"earlier": F.lit(None).cast("array<binary>"), "behind": F.lit(None).cast("int"), "state": F.lit(None).cast("int"), "ends": F.lit(True)})


DIGEST = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_DIGEST = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                     ("audit", pa.string()), ("repaired_sha256", pa.string())])


class _Whole:
    """A conversation's result, piece by piece."""

    def __init__(self):
        self.hash, self.some, self.audit = hashlib.sha256(), False, []
        self.least = self.most = self.last = None
        self.turns, self.counts = 0, dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)

    def add(self, p: dict) -> None:
        for k in self.counts:
            self.counts[k] += p[k]
        if p["n_rows"]:
            self.counts["illegal"] += self.last is not None and _illegal(self.last, p["first"])
            self.last = p["last"]
        if p["least"] is not None:
            self.turns += p["turns"] - (p["least"] == self.most)  # pieces are in the order of turns
            self.least = p["least"] if self.least is None else self.least
            self.most = p["most"]
        self.audit.append(p["audit"])
        for role, text in zip(p["roles"], p["texts"], strict=True):
            self.hash.update((("\n" if self.some else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            self.some = True

    def result(self, conv_id: int | None) -> dict:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return {"conv_id": conv_id, "gaps": gaps, **self.counts, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest()}


def digest(whole: DataFrame, parts: DataFrame) -> DataFrame:
    """One row a conversation, of what :func:`repair` gives."""
    def single(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for p in batch.to_pylist():
                w = _Whole()
                w.add(p)
                out.append(w.result(p["conv_id"]))
            yield pa.RecordBatch.from_pylist(out, _DIGEST)

    def joined(batches: Batches) -> Batches:
        of = conv_id = w = None
        for batch in batches:
            out = []
            for p in batch.to_pylist():
                if p["of"] != of:
                    if w is not None:
                        out.append(w.result(conv_id))
                    of, conv_id, w = p["of"], p["conv_id"], _Whole()
                w.add(p)
            yield pa.RecordBatch.from_pylist(out, _DIGEST)
        if w is not None:
            yield pa.RecordBatch.from_pylist([w.result(conv_id)], _DIGEST)

    ordered = parts.repartition("of").sortWithinPartitions("of", "piece")
    return map_batches(whole, single, DIGEST).unionByName(map_batches(ordered, joined, DIGEST))


def repaired_rows(whole: DataFrame, parts: DataFrame) -> DataFrame:
    """The repaired conversations as rows: conv_id, piece, place in the piece, role, text."""
    both = whole.unionByName(parts.drop("of"))
    return both.select("conv_id", "piece", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "row")) \
        .select("conv_id", "piece", "place", F.col("row.roles").alias("role"), F.col("row.texts").alias("text"))


def _least(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


def _way(letter: str, cost: str, after: str, given: str = "") -> str:
    row = f"list_prepend({given}, {after}.t)" if given else f"{after}.t"
    return f"{{'c': {cost} + {after}.c, 'a': '{letter}' || {after}.a, 't': {row}}}"


def _before(state: str, after: str, full: str, keeps: dict[str, str]) -> str:
    """SQL for the best of a row's edits from a state; ``after`` is the state behind a row of role ``full``."""
    far = "{'c': 1000000, 'a': '', 't': CAST([] AS VARCHAR[])}"
    kept = " ".join(f"WHEN r = '{r}' THEN {_way('K', 'pen', to, 'line')}" for r, to in keeps.items())
    given = f"'{full}:' || text"
    return _least(_way("D", "4", state), f"CASE WHEN del THEN {far} {kept} ELSE {far} END",
                  f"CASE WHEN del THEN {far} ELSE {_way('R', '3 + pen', after, given)} END")


def _inserted(base: str, after: str, full: str) -> str:
    given = f"'{full}:'"
    return _least(base, _way("I", "3", after, given))


ORACLE = rf"""
WITH RECURSIVE bits(b, k, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT b, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8),
hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ord(c) AS BIGINT))),
      lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS BIGINT) + 1])), CAST(4294967295 AS BIGINT)) % 20 AS k
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed, range(2) WHERE k <> 0 AND (range = 0 OR k = 3)),
placed AS (
  SELECT *, trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS core,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS r, role || ':' || text AS line, core = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    right(core, 1) NOT IN ('.', '!', '?') AS cut, left(role, 1) || lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS pair FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
    count(*) FILTER (WHERE again AND NOT blank) AS duplicate, count(*) FILTER (WHERE cut AND NOT again AND NOT blank) AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM judged GROUP BY conv_id),
cost(conv_id, i, g0, gs, gu, ga) AS (
  SELECT conv_id, n, {{'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])}}, {{'c': 6, 'a': 'II', 't': ['user:', 'assistant:']}},
    {{'c': 3, 'a': 'I', 't': ['assistant:']}}, {{'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])}} FROM counted
  UNION ALL
  SELECT conv_id, i - 1, {_inserted("b0", "u", "user")}, {_inserted("bs", "u", "user")}, u, {_inserted("ba", "bu", "user")}
  FROM (SELECT *, {_inserted("bu", "ba", "assistant")} AS u FROM (
    SELECT conv_id, i, {_before("g0", "gu", "user", {"s": "gs", "u": "gu"})} AS b0, {_before("gs", "gu", "user", {"u": "gu"})} AS bs,
      {_before("gu", "ga", "assistant", {"a": "ga"})} AS bu, {_before("ga", "gu", "user", {"u": "gu"})} AS ba
    FROM (SELECT cost.*, r, line, text, blank OR again AS del, CASE WHEN cut THEN 3 ELSE 0 END AS pen
      FROM cost JOIN judged ON judged.conv_id IS NOT DISTINCT FROM cost.conv_id AND judged.i = cost.i))))
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(g0.c, 0) AS BIGINT) AS cost, coalesce(g0.a, '') AS audit, sha256(coalesce(array_to_string(g0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN cost ON cost.conv_id IS NOT DISTINCT FROM o.conv_id AND cost.i = 0"""
