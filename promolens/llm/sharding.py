"""Sharding by sampled splitters: near-equal bytes, records range-partitioned by text hash and doc_id.

Equal texts are neighbours in key order, so a group of copies stays together unless a shard boundary falls
into it; a group larger than a shard is cut by doc_id. A round draws a size-weighted sample of keys (a
record's chance is its share of the bytes times ``sample``, so a few thousand keys whatever the input),
takes ``ranges`` quantile splitters, and counts the exact bytes and rows of each range. A range that holds
a shard boundary and more than ``exact_rows`` records is overfull and is sampled and divided again; in the
others the records are put in order and the boundary falls between two of them. Sizes of shards so differ
by one record at most. Slots are numbered by hash buckets whose number grows with the rows.

Driver: the sample and the ranges of a round, both bounded by the parameters. Nothing is broadcast.

Nulls: a null text has no bytes (size 1, crc32 0); a null ``doc_id`` sorts as ''. Repeated rows are separate
records next to each other; which of two equal rows lies on which side of a boundary is open, the result as
a set of rows is not. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.session import Workspace

TOP = "~"  # above any key: keys start with hex digits


def _branch(key: Column, bounds: list[str], low: int = 0) -> Column:
    """Number of bounds at or below the key, as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(low)
    m = len(bounds) // 2
    return F.when(key < bounds[m], _branch(key, bounds[:m], low)).otherwise(_branch(key, bounds[m + 1 :], low + m + 1))


def _splitters(rows: DataFrame, total: int, sample: int, ranges: int) -> list[str]:
    """Quantile keys of a size-weighted sample; each sampled key stands for size over chance bytes."""
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(sample / total))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("draw"), "key")), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
    drawn = rows.where(draw < chance).select("key", (F.col("size") / chance).alias("weight")).orderBy("key").collect()
    step, seen, out = sum(r.weight for r in drawn) / ranges, 0.0, []
    for r in drawn:
        seen += r.weight
        if seen >= step * (len(out) + 1) and (not out or out[-1] < r.key):
            out.append(r.key)
    return out


def _cut_ranges(rows: DataFrame, total: int, n: int, shards: int, sample: int, ranges: int, exact_rows: int) -> list[tuple[str, str, int, int]]:
    """Ranges (low, high, bytes before, bytes within) that hold a shard boundary and few enough records."""
    todo, done = [("", TOP, 0, total, n)], []
    while todo:
        low, high, base, size, n = todo.pop()
        if n <= exact_rows:
            done.append((low, high, base, size))
            continue
        part = rows.where((F.col("key") >= low) & (F.col("key") < high))
        bounds = [b for b in _splitters(part, size, sample, ranges) if low < b]
        if not bounds:  # one key repeated: nothing left to divide by
            done.append((low, high, base, size))
            continue
        counted = {r.r: r for r in part.groupBy(_branch(F.col("key"), bounds).alias("r")).agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()}
        edges = [low, *bounds, high]
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            if i in counted:
                s = counted[i].s
                if min(shards - 1, base * shards // total) != min(shards - 1, (base + s) * shards // total):
                    todo.append((a, b, base, s, counted[i].n)) if counted[i].n < n else done.append((a, b, base, s))
                base += s
    return sorted(done)


def shard(docs: DataFrame, shards: int = 8, sample: int = 4096, ranges: int = 128, exact_rows: int = 100_000, slot_rows: int = 20_000) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null under the law ``bytes``)."""
    work = Workspace(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.concat(F.md5(text), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = work.keep(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), key.alias("key")), "keys")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    cuts = _cut_ranges(rows, total, n, shards, sample, ranges, exact_rows) if n else []
    # Keys between two cut ranges lie in one shard; keys of a cut range are put in order.
    bounds = [x for low, high, _, _ in cuts for x in (low, high)]
    place = _branch(F.col("key"), bounds)
    plain = [0 if not n else min(shards - 1, before * shards // total) for before in [0, *[b + s for _, _, b, s in cuts]]]
    rows = rows.select("*", place.alias("place"))
    outside = rows.where("place % 2 = 0").select("*", F.get(F.array(*[F.lit(s) for s in plain]), (F.col("place") / 2).cast("int")).alias("shard"))
    base = F.get(F.array(*[F.lit(b).cast("long") for _, _, b, _ in cuts] or [F.lit(0).cast("long")]), ((F.col("place") - 1) / 2).cast("int"))
    upto = base + F.sum("size").over(Window.partitionBy("place").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    middle = F.floor((2 * upto - F.col("size")) * F.lit(shards) / F.lit(2 * max(total, 1)))
    inside = rows.where("place % 2 = 1").select("*", F.least(middle, F.lit(shards - 1)).cast("int").alias("shard"))
    mark = F.md5("key")
    put = work.keep(outside.unionByName(inside).select("doc_id", "size", "text_crc32", "key", "shard", mark.alias("mark")), "placed")
    digits = 1
    while n > slot_rows * shards * 16**digits:
        digits += 1
    bucket = F.substring("mark", 1, digits)
    counts = put.groupBy("shard", bucket.alias("bucket")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
    starts = work.keep(counts.select("shard", "bucket", before.alias("start")), "starts")
    at = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("mark", "key")) - 1
    out = put.select("*", bucket.alias("bucket")).join(starts, ["shard", "bucket"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + at).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


# crc32 has no SQL function there: bytes are folded over a table that follows from the polynomial.
SQL = """
WITH tab AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size, coalesce(text, '') AS text, md5(coalesce(text, '')) || coalesce(doc_id::VARCHAR, '') AS key FROM documents),
k AS (
  SELECT text, xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(text)), lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM (SELECT DISTINCT text FROM d), tab),
c AS (SELECT *, sum(size) OVER (ORDER BY key ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total FROM d),
s AS (SELECT *, least(7, (2 * upto - size) * 8 // (2 * total))::INTEGER AS shard FROM c)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(key), key) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM s JOIN k USING (text)
"""
