"""Benchmark decontamination over a positional inverted index, in DataFrame operations only.

Documents and benchmark items are cut into words (A-Z lower-cased). Every run of
``width`` item words is a window; an item of fewer words, but not none, is one
window. The index stores postings of the training tokens: term, document,
position and the tokens around it (as far as any window can reach), which are
the other terms' lists cut to the offsets that can matter. A window is looked up
by its rarest term (by corpus frequency); the offset-adjusted intersection with
the lists of its other terms is then a comparison inside the posting. Lists are
cut by document, as the scan deals them, so a frequent term never meets in one
task. ``matches`` returns exact phrase matches and proximity matches (all terms
of the window, as often as it holds them, within its width of the anchor, in any order).

A null or wordless text has no words and no hits; a wordless item has no window.
Rows are told apart by their id and text (two hashes of both), so each is judged by its
own text, whatever id it shares or lacks; rows equal in both get the same result each.
Repeated items count once by item_id; a null item_id hits words but is no item. Empty
tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import ascii_lower, broadcast_if_small, materialise

WIDTH = 10
#: Characters between words (after lower-casing A-Z). Fixed value.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAPS), "")


def windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct (key, terms, item_id): the windows of the items' words."""
    cut = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    at = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    return (cut.select("item_id", F.explode(F.transform(at, lambda i: F.slice("w", i, width))).alias("terms"))
            .select(F.array_join("terms", " ").alias("key"), "terms", "item_id").distinct())


def frequencies(docs: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """(term, df): how often the corpus holds each of the given terms; summed in the scan's tasks first."""
    spread = docs.select(F.explode(words(F.col("text"))).alias("term"))
    return spread.join(broadcast_if_small(terms, n_terms, 64), "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def anchors(wins: DataFrame, freq: DataFrame) -> DataFrame:
    """(term, key, terms, shift): each window under its rarest term; windows with a term that no text holds go."""
    each = wins.select("key", "terms").distinct().select("key", "terms", F.posexplode("terms").alias("shift", "term"))
    rarest = (each.join(freq, "term", "left").groupBy("key")
              .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term", "shift")).alias("a"),
                   F.first("terms").alias("terms"))
              .where("a.df > 0"))
    return rarest.select(F.col("a.term").alias("term"), "key", "terms", F.col("a.shift").alias("shift"))


def row_key(docs: DataFrame) -> DataFrame:
    """The documents with ``row``, which tells rows apart by id and text."""
    return docs.withColumn("row", F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(1), "text", "doc_id").alias("b")))


def build_index(docs: DataFrame, terms: DataFrame, n_terms: int, width: int = WIDTH, id: str = "doc_id") -> DataFrame:
    """Postings (term, ``id``, pos, at, around) of the given terms: ``around[at]`` is the term itself."""
    tokens = docs.select(id, words(F.col("text")).alias("w"))
    spread = tokens.select(id, "w", F.posexplode("w").alias("pos", "term"))
    found = spread.join(broadcast_if_small(terms, n_terms, 64), "term")
    low = F.greatest(F.col("pos") - (width - 1), F.lit(0))
    return found.select("term", id, "pos", (F.col("pos") - low).alias("at"),
                        F.slice("w", low + 1, F.col("pos") - low + width).alias("around"))


def matches(postings: DataFrame, looked_up: DataFrame, n_windows: int, proximity: bool = False, id: str = "doc_id") -> DataFrame:
    """(``id``, start, n, key): exact matches; with ``proximity`` also (``id``, pos, n, key, exact=false) ones."""
    w = broadcast_if_small(looked_up, n_windows, 400)
    first = F.col("at") - F.col("shift")
    exact = (first >= 0) & (F.slice("around", F.greatest(first, F.lit(0)) + 1, F.size("terms")) == F.col("terms"))
    near = F.forall(F.array_distinct("terms"), lambda t: F.size(F.filter("around", lambda x: x == t)) >= F.size(F.filter("terms", lambda x: x == t)))
    met = postings.join(w, (postings["term"] == w["term"]) & ((exact | near) if proximity else exact))
    out = met.select(id, F.when(exact, F.col("pos") - F.col("shift")).otherwise(F.col("pos")).alias("start"),
                     F.size("terms").alias("n"), "key", exact.alias("exact")).distinct()
    return out if proximity else out.drop("exact")


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    docs = row_key(docs.select("doc_id", "text"))
    wins = materialise(windows(items.select("item_id", "text"), width), "windows")
    terms = materialise(wins.select(F.explode("terms").alias("term")).distinct(), "terms")
    freq = materialise(frequencies(docs, terms, terms.count()), "frequencies")
    looked_up = materialise(anchors(wins, broadcast_if_small(freq, freq.count(), 64)), "anchors")
    rare = materialise(looked_up.select("term").distinct(), "anchor-terms")
    postings = materialise(build_index(docs, rare, rare.count(), width, "row"), "postings")
    hits = materialise(matches(postings, looked_up, looked_up.count(), id="row"), "hits")

    def cover(acc: Column, x: Column) -> Column:
        end = F.greatest(acc["end"], x["start"] + x["n"])
        return F.struct((acc["n"] + end - F.greatest(acc["end"], x["start"])).alias("n"), end.alias("end"))

    # spans and items of one document: at most as many as it has words, times the items of a window
    spans = F.array_sort(F.collect_set(F.struct("start", "n")))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    hit = hits.groupBy("row").agg(F.aggregate(spans, zero, cover, lambda a: a["n"]).cast("long").alias("n_hit"))
    ids = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    held = (hits.select("row", "key").distinct().join(wins.select("key", "item_id"), "key")
            .select("row", "item_id").distinct().groupBy("row").agg(ids.alias("ids")))
    found = hit.join(held, "row", "left")
    counted = docs.select("row", "doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return (counted.join(found, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(F.coalesce("ids", none)).cast("long").alias("n_items"),
                    F.sha2(F.array_join(F.coalesce("ids", none), ","), 256).alias("items_sha256"),
                    F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated")))


ORACLE = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS k
        FROM bw, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
dpos AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
         FROM dw, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
hit AS (SELECT doc_id, i, dpos.n, item_id FROM dpos JOIN win USING (n, k)),
pos AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hit, unnest(range(n)) AS t(j) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""
