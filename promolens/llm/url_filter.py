"""URL filters by a cascade of Bloom filters: exact membership over all keys that the corpus can ask for.

A list entry is ``host/path`` (or a bare host). A url asks for every suffix of its host with every prefix of its path
whose length occurs in the list; these keys, over all urls, are the universe. Level 0 of a cascade encodes the
listed keys, level 1 the unlisted keys of the universe that level 0 lets pass, level 2 the listed ones that
level 1 lets pass, and so on until nothing passes wrongly. A key belongs to the side of the first level that
misses it, so the answer for every key of the corpus is exact and urls are judged in the scan, without a join.

Level 0 errs at |listed| / (1.41 |unlisted|), so all levels together hold a few bytes per listed key and not per key
of the corpus. Keys are dealt into blocks by hash when more than ``block_keys`` are listed; each block has its own
cascade and pass, and only one block's bits are held at a time.

A second cascade over the listed keys tells blocking entries from allowing ones. The longest fitting rule wins, the
longer host on equal length, blocking on the same key; bare hosts count after all rules; a url that nothing
fits is allowed.

Nulls: a null url, or one without ``://``, has an empty host and path and is allowed. Null entries are ignored,
repeated entries and rows are fine, an empty list allows everything, an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.ids import as_long, as_text
from promolens.session import Workspace

from .token_index import _mix

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Bloom:
    def __init__(self, n: int, error: float, level: int):
        self.hashes = max(1, round(math.log2(1 / error)))
        self.size, self.level = max(64, math.ceil(n * self.hashes / math.log(2))), level
        self.words = np.zeros(self.size // 64 + 1, np.uint64)

    def places(self, h: np.ndarray) -> np.ndarray:
        """Bit numbers of each key (rows of two 64-bit hashes)."""
        with np.errstate(over="ignore"):
            step = np.arange(self.hashes, dtype=np.uint64)[None, :] * (_mix(h[:, 1], self.level) | np.uint64(1))[:, None]
            return (_mix(h[:, 0], self.level)[:, None] + step) % np.uint64(self.size)

    def passes(self, h: np.ndarray) -> np.ndarray:
        at = self.places(h)
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


def in_cascade(levels: list[Bloom], h: np.ndarray) -> np.ndarray:
    """Membership of keys (rows of two hashes): the parity of the first level that misses the key."""
    out, open_ = np.full(len(h), len(levels) % 2 == 1), np.arange(len(h))
    for i, level in enumerate(levels):
        hit = level.passes(h[open_])
        out[open_[~hit]] = i % 2 == 1
        open_ = open_[hit]
    return out


def _hashes(pdf: pd.DataFrame) -> np.ndarray:
    return pdf[["h1", "h2"]].to_numpy(np.int64).view(np.uint64)


def fill_bloom(keys: DataFrame, bloom: Bloom) -> Bloom:
    """The filter with all keys in it: tasks set bits, Spark joins the words."""

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = np.zeros_like(bloom.words)
        for pdf in batches:
            at = bloom.places(_hashes(pdf)).ravel()
            np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        used = np.flatnonzero(words)
        yield pd.DataFrame({"word": used, "bits": words[used].view(np.int64)})

    joined = keys.mapInPandas(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    bloom.words[joined["word"].to_numpy(np.int64)] = joined["bits"].to_numpy(np.int64).view(np.uint64)
    return bloom


def build_cascade(keys: DataFrame, work: Workspace, name: str) -> list[Bloom]:
    """Levels over keys (h1, h2, listed)."""
    inside, outside = keys.where("listed").select("h1", "h2"), keys.where("NOT listed").select("h1", "h2")
    n_in, n_out, levels = inside.count(), outside.count(), []
    while n_in:
        error = min(0.5, max(1e-9, n_in / (math.sqrt(2) * max(n_out, 1)))) if not levels else 0.5
        bloom = fill_bloom(inside, Bloom(n_in, error, len(levels)))
        levels.append(bloom)

        def passing(batches: Iterator[pd.DataFrame], bloom: Bloom = bloom) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pdf[bloom.passes(_hashes(pdf))]

        wrong = work.keep(outside.mapInPandas(passing, "h1 long, h2 long"), f"{name}{len(levels)}")
        inside, outside, n_in, n_out = wrong, inside, wrong.count(), n_in
    return levels


def url_parts(pages: DataFrame) -> DataFrame:
    """(page_id, host, path)."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rows = pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest"))
    return rows.select("page_id", F.translate(F.regexp_extract("rest", r"^[^/?#]*", 0), UPPER, LOWER).alias("host"), F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"))


def with_keys(parts: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds the keys a url asks for, best first."""
    cuts = F.filter(F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>"), lambda n: n <= F.length("path"))
    suffixes = F.transform(F.sequence(F.lit(1), F.size("labels")), lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))
    key = lambda s, n: F.struct((n > 0).alias("rule"), (F.length(s) + n).alias("size"), F.length(s).alias("host"), F.concat(s, F.substr(F.col("path"), F.lit(1), n)).alias("key"))
    rows = parts.select("*", F.split("host", r"\.").alias("labels")).select("*", cuts.alias("cuts"), suffixes.alias("suffixes"))
    asked = F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.sort_array(F.flatten(F.transform("suffixes", lambda s: F.transform("cuts", lambda n: key(s, n)))), asc=False)["key"])
    rows = rows.select("page_id", "host", "path", asked.alias("keys"))
    return rows.select("*", F.transform("keys", lambda k: F.xxhash64(k)).alias("h1"), F.transform("keys", lambda k: F.xxhash64(k, F.lit(1))).alias("h2"))


def judge(pages: DataFrame, entries: DataFrame, block_keys: int = 10_000_000) -> DataFrame:
    """Per page: page_id, host, path, rule and verdict, under entries (key, verdict)."""
    work = Workspace(pages.sparkSession)
    path_length = F.when(F.instr("key", "/") > 0, F.length("key") - F.instr("key", "/") + 1).otherwise(0)
    entries = entries.where("key IS NOT NULL AND verdict IS NOT NULL").groupBy("key").agg(F.max(F.col("verdict") == "block").alias("block"))
    lengths = sorted(r.n for r in entries.select(path_length.alias("n")).distinct().collect())
    rows = work.keep(with_keys(url_parts(pages), lengths), "asked")
    universe = rows.select(F.explode("keys").alias("key")).distinct().join(entries.withColumn("listed", F.lit(True)), "key", "left")
    universe = universe.select(F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit(1)).alias("h2"), F.coalesce("listed", F.lit(False)).alias("listed"), "block")
    universe = work.keep(universe, "universe")
    blocks = max(1, math.ceil(universe.where("listed").count() / block_keys))
    rows = as_text(rows, "page_id").select("*", F.transform("keys", lambda k: F.lit(0)).alias("found"))
    for b in range(blocks):
        own = universe.where(F.pmod("h1", F.lit(blocks)) == b)
        levels = build_cascade(own, work, f"listed{b}_")
        blocking = build_cascade(own.where("listed").select("h1", "h2", F.col("block").alias("listed")), work, f"block{b}_")
        shipped = pages.sparkSession.sparkContext.broadcast((levels, blocking))

        def look(batches: Iterator[pd.DataFrame], b: int = b, shipped=shipped) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                sizes = pdf["keys"].map(len).to_numpy()
                if sizes.sum():
                    h = np.stack([np.concatenate([np.asarray(x, np.int64) for x in pdf[c]]) for c in ("h1", "h2")], axis=1)
                    found = np.concatenate([np.asarray(x, np.int64) for x in pdf["found"]])
                    mine = np.flatnonzero(h[:, 0] % blocks == b)
                    h = h[mine].view(np.uint64)
                    here = in_cascade(shipped.value[0], h)
                    found[mine[here]] = 1 + in_cascade(shipped.value[1], h[here])
                    pdf = pdf.assign(found=np.split(found, np.cumsum(sizes)[:-1]))
                if len(pdf):
                    yield pdf.astype({"page_id": object, "host": object, "path": object})

        rows = rows.mapInPandas(look, "page_id string, host string, path string, keys array<string>, h1 array<long>, h2 array<long>, found array<int>")
        rows = work.keep(rows, f"judged{b}") if b + 1 < blocks else rows
    first = F.coalesce(F.get("found", F.array_position(F.transform("found", lambda f: F.least(f, F.lit(1))), 1).cast("int") - 1), F.lit(0))
    rows = rows.select("page_id", "host", "path", F.get("keys", F.array_position(F.transform("found", lambda f: F.least(f, F.lit(1))), 1).cast("int") - 1).alias("key"), first.alias("f"))
    return as_long(rows, "page_id").select("page_id", "host", "path", F.when(F.instr("key", "/") > 0, F.col("key")).alias("rule"), F.when(F.col("f") == 2, "block").otherwise("allow").alias("verdict"))


RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
BLOCKED_NAMES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
BLOCKED = [f"{name}.example.{top}" for name in BLOCKED_NAMES for top in ("com", "net", "org")]

_HOSTS = ", ".join(f"('{h}')" for h in BLOCKED)
_RULES = ", ".join(f"('{k}', '{k.split('/')[0]}', '/{k.split('/', 1)[1]}', '{v}')" for k, v in RULES)
SQL = f"""
WITH r AS (SELECT row_number() OVER () AS i, page_id, CASE WHEN url LIKE '%://%' THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT i, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
rules(rule, rhost, rpath, verdict) AS (VALUES {_RULES}),
hosts(h) AS (VALUES {_HOSTS}),
fit AS (
  SELECT i, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM p JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY i),
bad AS (SELECT DISTINCT i FROM p JOIN hosts ON host = h OR ends_with(host, '.' || h))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN bad.i IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN fit USING (i) LEFT JOIN bad USING (i)
"""
