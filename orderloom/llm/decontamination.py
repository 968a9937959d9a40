"""Benchmark decontamination: short test items inside long documents, by size-partitioned MinHash.

An item is contained in a document if at least ``percent`` of its distinct five-word shingles
occur there. Of the item's k shingles, o must then occur and at most k - o are missing; so of its
k - o + r smallest hashes, at least r occur. Those smallest hashes are the item's MinHash sketch.
Items are partitioned by the power of two of their size; the partition sets r (larger items
ask for more hits, which keeps chance hits out) and the least size of a document worth a look.
The sketch search loses no contained item. What it finds is verified exactly on the words
themselves.

An item of fewer than five words is one shingle of all its words, and is contained where they stand in a row.
Null, empty and wordless texts have no shingles and match nothing; empty tables give no rows. A repeated document or item row
counts once per id: the union of its texts' shingles. Texts of any length are read whole. Columns besides the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm._shared import BROADCAST_ROWS, small, stored, words

WORDS, PERCENT = 5, 80


def _windows(rows: DataFrame, key: str, tokens: Column, join, n: int, shorter: list[int] | None = None) -> DataFrame:
    """key, shingles: distinct ``n``-word shingles, and those of the shorter lengths; where these are None, of fewer
    words the whole sequence.

    The tokens are a column of their own, so they are made once and not at each place.
    """
    token, none = F.col("_tokens"), F.array()
    shingle = lambda i, n: join(*(F.get(token, i + k) for k in range(n)))

    def windows(n: int) -> Column:
        places = F.sequence(F.lit(0), F.size("_tokens") - n)
        return F.when(F.size("_tokens") >= n, F.array_distinct(F.transform(places, lambda i: shingle(i, n)))).otherwise(none)

    found = windows(n)
    if shorter is None:
        for k in range(1, n):
            found = F.when(F.size("_tokens") == k, F.array(shingle(F.lit(0), k))).otherwise(found)
    elif shorter:
        found = F.concat(found, *map(windows, shorter))
    return rows.select(key, tokens.alias("_tokens")).select(key, found.alias("shingles"))


def _each(array: str) -> Column:
    """The elements as rows. The outer form: for the plain one, a test on the array would be
    inferred and pushed below the columns it is made of, which are then made again at each place.
    Joins and filters drop the null that stands for an empty array."""
    return F.explode_outer(array)


def hashed_shingles(rows: DataFrame, key: str, n: int = WORDS, shorter: list[int] | None = None) -> DataFrame:
    hashed = F.transform(words(F.col("text")), lambda word: F.xxhash64(word))
    return _windows(rows, key, hashed, F.xxhash64, n, shorter)


def exact_shingles(rows: DataFrame, key: str, n: int = WORDS, shorter: list[int] | None = None) -> DataFrame:
    return _windows(rows, key, words(F.col("text")), lambda *parts: F.concat_ws(" ", *parts), n, shorter)


def short_lengths(items: DataFrame, n: int) -> list[int]:
    """Numbers of words below ``n`` that items have: documents are cut into shingles of these lengths too."""
    count = F.size(words(F.col("text"))).alias("count")
    return sorted(r["count"] for r in items.select(count).filter(F.col("count").between(1, n - 1)).distinct().collect())


def sketches(items: DataFrame, percent: int, n: int) -> DataFrame:
    """item_id, hash, hits (how many of the sketch must occur), least (shingles a document must have)."""
    hashed = hashed_shingles(items, "item_id", n).select("item_id", _each("shingles").alias("hash")).dropna().distinct()
    sized = hashed.groupBy("item_id").agg(F.array_sort(F.collect_list("hash")).alias("hashes"))
    size = F.size("hashes")
    needed = F.floor((size * percent + 99) / 100).cast("int")
    band = F.floor(F.log2(size))
    hits = F.least(F.greatest(F.lit(1), F.floor(F.pow(F.lit(2.0), band) / 32).cast("int")), needed)
    return sized.withColumns({"needed": needed, "hits": hits}).select(
        "item_id",
        F.explode(F.slice("hashes", F.lit(1), F.size("hashes") - F.col("needed") + F.col("hits"))).alias("hash"),
        "hits",
        F.col("needed").alias("least"),
    )


def contained_items(docs: DataFrame, items: DataFrame, percent: int = PERCENT, n: int = WORDS) -> DataFrame:
    """doc_id, item_id, n_item_shingles, n_shared: every item of which a document holds ``percent`` or more."""
    items = items.select("item_id", "text")
    docs = docs.select("doc_id", "text")
    sketch, shorter = stored(sketches(items, percent, n)), short_lengths(items, n)
    hashed = hashed_shingles(docs, "doc_id", n, shorter).select(
        "doc_id", F.size("shingles").alias("size"), _each("shingles").alias("hash")
    )
    found = stored(
        hashed.join(small(sketch), "hash")
        .filter(F.col("size") >= F.col("least"))
        .groupBy("doc_id", "item_id", "hits")
        .agg(F.count_distinct("hash").alias("seen"))
        .filter("seen >= hits")
        .select("doc_id", "item_id")
    )
    # Exact verification, on the words of the candidates only.
    rows = found.count()
    known = exact_shingles(items, "item_id", n).select("item_id", _each("shingles").alias("shingle")).dropna().distinct()
    wanted = found.select("doc_id").distinct()
    texts = docs.join(F.broadcast(wanted) if rows <= BROADCAST_ROWS else wanted, "doc_id", "left_semi")
    own = exact_shingles(texts, "doc_id", n, shorter)
    asked = found.join(known.groupBy("item_id").agg(F.collect_list("shingle").alias("item_shingles")), "item_id")
    shared = (
        own.join(asked, "doc_id")
        .select(
            "doc_id",
            "item_id",
            F.size("item_shingles").alias("size"),
            F.array_intersect("item_shingles", "shingles").alias("both"),
        )
        .select("doc_id", "item_id", "size", _each("both").alias("shingle"))
        .groupBy("doc_id", "item_id", "size")
        .agg(F.count_distinct("shingle").alias("n_shared"))
    )
    return shared.filter(F.col("n_shared") * 100 >= F.col("size") * percent).select(
        "doc_id", "item_id", F.col("size").cast("long").alias("n_item_shingles"), "n_shared"
    )


def decontaminate(docs: DataFrame, items: DataFrame, percent: int = PERCENT, n: int = WORDS) -> DataFrame:
    """The documents that contain no item, all columns kept."""
    hit = stored(contained_items(docs, items, percent, n).select("doc_id").distinct())
    return docs.join(small(hit), "doc_id", "left_anti")


ORACLE_SQL = """
WITH doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
lengths AS (SELECT DISTINCT least(len(w), 5) AS k FROM item_words WHERE len(w) > 0 UNION SELECT 5),
doc_shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) AS s
  FROM doc_words, lengths WHERE len(w) >= k),
item_shingles AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i+4], ' '))) AS s
  FROM item_words WHERE len(w) > 0),
sizes AS (SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id)
SELECT doc_id, item_id, n AS n_item_shingles, count(*) AS n_shared
FROM doc_shingles JOIN item_shingles USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n HAVING count(*) * 100 >= n * 80
"""
