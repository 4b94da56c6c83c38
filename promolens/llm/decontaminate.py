"""Benchmark decontamination: prefix-filtered containment of benchmark windows in documents.

A window of an item is 13 consecutive words (all words of a shorter item). Full containment needs every
word of the window, so one necessary prefix word is enough to find all candidates: the word of the
window that is rarest in the whole corpus. Documents report the places of prefix words together with the
few words around each place; a join on the prefix word, the bounds of position and length and an exact
comparison of the words decide. The texts themselves are never shuffled or joined.

Scale: two scans of the texts (counts of benchmark words, then places). The prefix words go into the
scan as a literal set of at most ``block`` words; more of them make more scans, one for each block.
All else is proportional to places found. Benchmark tables join by Spark's own choice.

Nulls: a null text has no words; an item without words has no window; a null ``item_id`` still hits but
is not listed. Empty tables, repeated rows (each row is judged by itself) and extra columns are fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.session import Workspace

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK = 20_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP), "")


def item_windows(benchmark: DataFrame, width: int) -> DataFrame:
    """Distinct windows as (win, length, items)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w")).where("size(w) > 0")
    items = items.select("item", "w", F.least(F.size("w"), F.lit(width)).alias("length"))
    at = F.explode(F.expr("sequence(1, size(w) - length + 1)")).alias("at")
    spread = items.select("item", "w", "length", at).select("item", "length", F.expr("slice(w, at, length)").alias("win"))
    return spread.groupBy("win", "length").agg(F.collect_set("item").alias("items"))


def rarest_words(docs: DataFrame, windows: DataFrame, work: Workspace) -> DataFrame:
    """Adds the prefix (word, offset) of each window: its rarest word in the corpus, the first of equals."""
    vocabulary = work.keep(windows.select(F.explode("win").alias("word")).distinct(), "vocabulary")
    # Counts only order the words, so full lower-casing, which is cheaper than translate, will do here.
    seen = docs.select(F.explode(F.split(F.lower(F.col("text")), GAP)).alias("word")).join(vocabulary, "word")
    counts = work.keep(seen.groupBy("word").agg(F.count("*").alias("n")), "counts")
    spread = windows.select("*", F.posexplode("win").alias("offset", "word")).join(counts, "word", "left")
    rank = F.struct(F.coalesce("n", F.lit(0)), "offset", "word")
    best = spread.groupBy("win", "length").agg(F.first("items").alias("items"), F.min(rank).alias("best"))
    return best.select("win", "length", "items", F.col("best.word").alias("word"), F.col("best.offset").alias("offset"))


def _places(docs: DataFrame, prefix_words: list[str], width: int) -> DataFrame:
    """Per document its number of words and, for each place of a prefix word, the words around it."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.md5("text").alias("mark"), words_of(F.col("text")).alias("w"))
    found = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get(F.col("w"), i).isin(prefix_words)) if prefix_words else F.array().cast("array<int>")
    rows = rows.select("*", F.when(F.size("w") > 0, found).otherwise(F.array().cast("array<int>")).alias("at"))
    side = width - 1
    around = F.transform("at", lambda i: F.struct(
        i.alias("at"), F.least(i, F.lit(side)).alias("left"),
        F.slice(F.col("w"), F.greatest(i - side, F.lit(0)) + 1, F.least(i, F.lit(side)) + width).alias("near")))
    return rows.select("row", "doc_id", "mark", F.size("w").cast("long").alias("n_words"), around.alias("places"))


def _judged(docs: DataFrame, benchmark: DataFrame, width: int, share: int, block: int, work: Workspace) -> DataFrame:
    windows = work.keep(item_windows(benchmark, width), "windows")
    prefixes = work.keep(rarest_words(docs, windows, work), "prefixes")
    # The benchmark's prefix words, in order, taken a block at a time.
    words = [r.word for r in prefixes.select("word").distinct().orderBy("word").toLocalIterator()]
    blocks = [words[i : i + block] for i in range(0, len(words), block)] or [[]]
    scans = [work.keep(_places(docs, b, width), f"places{i}") for i, b in enumerate(blocks)]
    hits = None
    for scan in scans:
        near = scan.where(F.size("places") > 0).select("row", F.explode("places").alias("p")).select("row", "p.*")
        near = near.select("*", F.get("near", F.col("left")).alias("word"))
        part = near.join(prefixes, "word").where(F.expr("`left` >= offset AND slice(near, `left` - offset + 1, length) = win"))
        part = part.select("row", (F.col("at") - F.col("offset")).alias("start"), "length", "items")
        hits = part if hits is None else hits.unionByName(part)
    spans = F.sort_array(F.collect_set(F.struct("start", "length")))
    per = hits.groupBy("row").agg(spans.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("spans", none, lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0), x["start"] + x["length"] - F.greatest(a["end"], x["start"]))).cast("long").alias("n"),
        F.greatest(a["end"], x["start"] + x["length"]).alias("end")), lambda a: a["n"])
    per = per.select("row", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("ids"))
    # The first scan counts the words of every document.
    out = scans[0].select("row", "doc_id", "mark", "n_words").join(per, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        "doc_id", "mark", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"), ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 13, share: int = 20, block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (share * n_hit >= n_words, some hit)."""
    return _judged(docs, benchmark, width, share, block, Workspace(docs.sparkSession)).drop("mark")


def clean_documents(docs: DataFrame, benchmark: DataFrame, width: int = 13, share: int = 20, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, all columns, without contaminated ones, which are known by the digest of their text."""
    work = Workspace(docs.sparkSession)
    found = work.keep(_judged(docs, benchmark, width, share, block, work).where("contaminated").select("mark").distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("row"), F.md5("text").alias("mark"))
    return rows.join(found, "mark", "left_anti").select("row.*")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
il AS (SELECT item_id, w, least(len(w), 13) AS k FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, w[p:p + k - 1] AS win FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM il)),
lens AS (SELECT DISTINCT k FROM win),
dw AS (SELECT r, k, p, w[p:p + k - 1] AS win FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, lens WHERE len(w) >= k)),
occ AS (SELECT dw.r, dw.p, dw.k, win.item_id FROM dw JOIN win ON dw.k = win.k AND dw.win = win.win),
hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + k)) AS q FROM occ) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
       FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM occ WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""
