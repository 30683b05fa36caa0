"""Secret scan over a trigram inverted index, in DataFrame operations only.

Each rule is a Java regular expression. ``trigram_query`` derives from it a
Boolean query: an AND of groups, each an OR of alternatives, each an AND of
three-letter strings that every match must contain (lower-cased). The index
holds postings (trigram, doc_id) for the trigrams that any rule asks for; a
document is a candidate of a rule when its postings meet every group. Candidates
are verified with the whole rule; rules that have no mandatory trigram scan all
documents.

Spans count code points, ends exclusive. A null text is an empty one and has no
spans. A null doc_id is not indexed, so such rows are verified for every rule.
Repeated rows give repeated results; an empty table gives an empty one; extra
columns are ignored.
"""

from __future__ import annotations

import itertools
from re import _constants as rc
from re import _parser as rp
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import broadcast_if_small, materialise


class Rule(NamedTuple):
    kind: str
    pattern: str
    #: Matches are kept if this group of them (0: all) has at least ``least`` characters.
    group: int = 0
    least: int = 0


#: The base rules first, in the order in which their spans are listed. Fixed values.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Rules that the method adds; formats of public token kinds. Fixed values.
ADDED_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    # with the key itself, to its end line or the end of the text
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?(?:-----END [A-Z ]*PRIVATE KEY-----|(?![\s\S]))"),
)
RULES = BASE_RULES + ADDED_RULES

Group = frozenset[frozenset[str]]  # alternatives, each a set of trigrams that must all occur


def _grams(s: str) -> frozenset[str]:
    return frozenset(s[i : i + 3] for i in range(len(s) - 2))


def _strings(item, most: int) -> list[str] | None:
    """The finite set of (lower-cased) strings that an item matches, or None."""
    op, av = item
    if op is rc.LITERAL:
        return [chr(av).lower()]
    if op is rc.IN:
        out = []
        for kind, x in av:
            if kind is rc.LITERAL:
                out.append(chr(x).lower())
            elif kind is rc.RANGE and x[1] - x[0] < most:
                out += [chr(c).lower() for c in range(x[0], x[1] + 1)]
            else:
                return None
        return sorted(set(out)) if len(set(out)) <= most else None
    if op is rc.SUBPATTERN:
        return _sequence_strings(av[3], most)
    if op is rc.BRANCH:
        parts = [_sequence_strings(b, most) for b in av[1]]
        return None if None in parts else sorted({s for p in parts for s in p})
    if op is rc.MAX_REPEAT and av[1] <= 3:
        one = _sequence_strings(av[2], most)
        if one is None:
            return None
        out = {"".join(p) for n in range(av[0], av[1] + 1) for p in itertools.product(one, repeat=n)}
        return sorted(out) if len(out) <= most else None
    return None


def _sequence_strings(seq, most: int) -> list[str] | None:
    out = [""]
    for item in seq:
        s = _strings(item, most)
        if s is None or len(out) * len(s) > most:
            return None
        out = [a + b for a in out for b in s]
    return out


def trigram_query(pattern: str, most: int = 64) -> list[Group]:
    """The Boolean trigram query of a pattern; empty if nothing is mandatory (scan everything)."""
    groups: list[Group] = []

    def flush(strings: list[str]) -> None:
        sets = {_grams(s) for s in strings}
        if all(sets):  # an alternative without a trigram makes the group always true
            groups.append(frozenset(a for a in sets if not any(b < a for b in sets)))  # b absorbs a

    def walk(seq) -> None:
        run = [""]
        for item in seq:
            strings = _strings(item, most)
            if strings is not None and len(run) * len(strings) <= most:
                run = [a + b for a in run for b in strings]
                continue
            flush(run)
            run = strings if strings is not None else [""]
            op, av = item
            if strings is None and op is rc.SUBPATTERN:
                walk(av[3])
            elif strings is None and op is rc.MAX_REPEAT and av[0] >= 1:
                walk(av[2])
        flush(run)

    walk(rp.parse(pattern))
    return sorted(set(groups), key=sorted_key)


def sorted_key(group: Group) -> list[list[str]]:
    return sorted(sorted(a) for a in group)


def build_index(docs: DataFrame, rules=RULES) -> DataFrame:
    """Postings (trigram, doc_id) of every whole text, for the trigrams of the rules' queries.

    The lists are cut by document, as the scan deals them, so no list lies in one task.
    """
    grams = sorted({t for r in rules for g in trigram_query(r.pattern) for a in g for t in a})
    low = F.col("low")
    found = F.array(*[F.when(low.contains(t), F.lit(t)) for t in grams]) if grams else F.array().cast("array<string>")
    # lower-cased in a projection of its own, or every probe would do it again
    lowered = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.lower("text").alias("low"))
    return lowered.select("doc_id", F.explode(F.array_compact(found)).alias("trigram"))


def candidates(postings: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, kinds): the rules whose Boolean query a document's postings meet."""
    spark = postings.sparkSession
    rows = [(r.kind, g, a, t, len(alt)) for r in rules for g, group in enumerate(trigram_query(r.pattern))
            for a, alt in enumerate(sorted(group, key=sorted)) for t in sorted(alt)]
    clauses = spark.createDataFrame(rows, "kind string, grp int, alt int, trigram string, n_trigrams int")
    sizes = spark.createDataFrame([(r.kind, len(q)) for r in rules if (q := trigram_query(r.pattern))],
                                  "kind string, n_groups int")
    met = (postings.distinct().join(F.broadcast(clauses), "trigram")  # a few rows for each rule
           .groupBy("doc_id", "kind", "grp", "alt")
           .agg(F.count(F.lit(1)).alias("n"), F.first("n_trigrams").alias("of"))
           .where("n = of"))
    return (met.groupBy("doc_id", "kind").agg(F.countDistinct("grp").alias("n"))
            .join(F.broadcast(sizes), "kind").where("n = n_groups")
            .groupBy("doc_id").agg(F.collect_set("kind").alias("kinds")))


def spans(text: Column, rule: Rule) -> Column:
    """array<struct<start, end>> of a rule's leftmost non-overlapping matches.

    The pieces between matches and the matches alternate, so that running sums of
    their lengths give the places.
    """
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    pieces = F.split(text, rule.pattern, -1)
    triples = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(whole)).alias("gap"), whole.alias("hit"), part.alias("part"))
    start = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<struct<start:bigint,end:bigint>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.char_length(x["gap"])
        end = begin + F.char_length(x["hit"])
        kept = F.char_length(x["part"]) >= rule.least
        new = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(kept, F.concat(acc["out"], new)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(triples, start, step, lambda acc: acc["out"])


def _labelled(order: int, kind: str):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("ord"), F.lit(kind).alias("kind"),
                              s["end"].alias("end"))


def scan(docs: DataFrame, rules=RULES, whole_rows: bool = False) -> DataFrame:
    """(doc_id, spans): one row per document; spans by start, then in the rules' order.

    With ``whole_rows`` a column ``row`` holds all columns of the document.
    """
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole_rows else []
    docs = docs.select("doc_id", "text", *row)
    postings = materialise(build_index(docs, rules), "trigram-postings")
    # written, so that its size is known before the join is planned
    found = materialise(candidates(postings, rules), "secret-candidates")
    marked = docs.join(broadcast_if_small(found, found.count(), 64), "doc_id", "left")
    text = F.coalesce(F.col("text"), F.lit(""))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    lists = []
    for i, r in enumerate(rules):
        hit = spans(text, r)
        # a rule without mandatory trigrams scans every text, once where nothing is found
        maybe = F.col("doc_id").isNull() | F.array_contains("kinds", r.kind) if trigram_query(r.pattern) else text.rlike(r.pattern)
        hit = F.when(maybe, hit).otherwise(empty)
        lists.append(F.transform(hit, _labelled(i, r.kind)))
    return marked.select("doc_id", F.array_sort(F.concat(*lists)).alias("spans"), *(["row"] if whole_rows else []))


def redact(docs: DataFrame, rules=RULES, mask: str = "[SECRET]") -> DataFrame:
    """The documents, with every span of their texts masked; overlapping spans are masked once.

    A column n_chars, if there is one, is counted anew. A null text stays null.
    """
    found = scan(docs, rules, whole_rows=True)
    text = F.col("row.text")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], gap, F.lit(mask))).otherwise(acc["out"]).alias("out"))

    rest = F.aggregate("spans", start, step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.char_length(text))))
    clean = F.when(F.size("spans") > 0, rest).otherwise(text)
    out = found.select("row", clean.alias("clean"))
    kinds = dict(docs.dtypes)
    new = {"text": F.col("clean"), "n_chars": F.char_length("clean").cast(kinds.get("n_chars", "long"))}
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def digest(found: DataFrame, rules=RULES) -> DataFrame:
    """The columns of the registered query, from ``scan``'s rows."""
    def listed(keep):
        return F.array_join(F.transform(keep, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["ord"] < len(BASE_RULES))
    return found.select("doc_id", *[count(r.kind) for r in BASE_RULES],
                        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


ORACLE_BASE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT doc_id, 0 AS o, 'assign' AS kind, regexp_extract_all(t, p, 0) AS hits, regexp_extract_all(t, p, 2) AS parts,
         string_split_regex(t, p) AS gaps, 12 AS least
  FROM d, (SELECT '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' AS p)
  UNION ALL
  SELECT doc_id, 1, 'access', regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+'),
         string_split_regex(t, 'AKIA[A-Z0-9]+'), 18 FROM d
  UNION ALL
  SELECT doc_id, 2, 'hex', regexp_extract_all(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+'),
         string_split_regex(t, '[0-9a-f]+'), 16 FROM d),
u AS (SELECT doc_id, o, kind, least, unnest(hits) AS hit, unnest(parts) AS part, unnest(gaps[1:len(hits)]) AS gap,
             unnest(range(len(hits))) AS i FROM m),
s AS (SELECT doc_id, o, kind, least, part, length(hit) AS n,
             sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, o ORDER BY i) AS e FROM u),
k AS (SELECT doc_id, o, kind, CAST(e - n AS BIGINT) AS b, CAST(e AS BIGINT) AS e FROM s WHERE length(part) >= least)
"""
#: No document of the given tables holds a match of the added rules; their patterns are listed all the same.
ORACLE = ORACLE_BASE + r""",
g AS (SELECT doc_id, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access,
             count(*) FILTER (o = 2) AS n_hex,
             string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, o) AS spans FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""
