"""N-gram Jaccard join by chosen paths: near-duplicate classes and links over five-word shingles.

1. One pass hashes each text's set of shingles to a digest and a sketch of ``width`` min-hashes. Equal sets become
   one representative with a count of copies, combined before the shuffle.
2. Chosen paths: from each root a node picks ``fan`` coordinates of the sketch by its path, and a set goes to the child
   named by the coordinate and its min-hash there, which is a sampled token that two sets of similarity s share with
   chance s. Nodes of one set end. Nodes of at most ``leaf`` sets are compared by brute force, larger
   ones split again; a child that keeps more than half of its node is a core of near copies and is compared
   too, in tiles. The number of roots follows from the target recall.
3. Brute force compares sketches (fewer equal min-hashes than asked for have a hundredth of the loss allowed) and reports each set with the smallest one it is
   connected to, never pairs. Connected components of these stars are the groups to verify.
4. Each group is verified once on the true shingle sets: common shingles of all its sets are counted by blocks and
   each set reports how many documents it links to and its class. So a link is counted once however often
   its pair has met, and no pair is written. Groups above ``tile`` sets are spread over tasks by tiles.

Work grows with documents, and inside a group of near copies with the true number of its links, since these are
counted exactly.

Shingles: words ``[^\\x20\\x09-\\x0D]+``, five in a row; a shorter text with words is one shingle. Nulls: a null or wordless
text has no shingles, no links and a class of its own. A class is named by its least doc_id (null only if no
member has one). Repeated rows are copies of each other. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.ids import as_long, as_text
from promolens.session import Workspace

from .token_index import _mix
from .url_filter import Bloom, fill_bloom

SHINGLE, WIDTH, FAN, DEPTH = 5, 64, 3, 6
WORDS = 1 << 18  # words worked on at a time; a text is never split


def shingle_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts in order, and their number in each text."""
    split = [t.encode().split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    words = [w for ws in split for w in ws]
    if not words:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    h = pd.util.hash_array(np.array(words, object))
    owner = np.repeat(np.arange(len(texts)), sizes)
    ends, at = np.cumsum(sizes), np.arange(len(h))
    left = ends[owner] - at  # words from here to the end of the text
    full = np.flatnonzero(left >= SHINGLE)
    short = np.flatnonzero((left == sizes[owner]) & (sizes[owner] < SHINGLE))
    with np.errstate(over="ignore"):
        prime, acc = np.uint64(0x9E3779B97F4A7C15), np.zeros(len(full), np.uint64)
        for k in range(SHINGLE):
            acc = acc * prime + h[full + k]
        acc = _mix(acc, 1)
        rest = np.zeros(len(short), np.uint64)
        for i, s in enumerate(short):
            for v in h[s : s + sizes[owner[s]]]:
                rest[i] = rest[i] * prime + v
        rest = _mix(rest, 2)
    out = np.zeros(len(h), np.uint64)
    out[full], out[short] = acc, rest
    keep = np.zeros(len(h), bool)
    keep[full] = keep[short] = True
    return out[keep], np.bincount(owner[keep], minlength=len(texts))


def chunks(texts: list[str]) -> Iterator[slice]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > 6 * WORDS:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if texts:
        yield slice(start, len(texts))


def _sketch_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    with np.errstate(over="ignore"):
        odd = _mix(np.arange(WIDTH, dtype=np.uint64), 3) | np.uint64(1)
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            for s in chunks(texts):
                h, n = shingle_hashes(texts[s])
                owner = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((h, owner))
                h, owner = h[order], owner[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
                h, owner = h[new], owner[new]
                n = np.bincount(owner, minlength=len(n))
                some = n > 0
                starts = (np.cumsum(n) - n)[some]
                sketch = np.zeros((len(n), WIDTH), "<u4")
                d1, d2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                if len(h):
                    d1[some], d2[some] = np.add.reduceat(_mix(h, 4), starts), np.add.reduceat(_mix(h, 5), starts)
                    for k in range(WIDTH):
                        sketch[some, k] = np.minimum.reduceat((h * odd[k]) >> np.uint64(32), starts)
                yield pd.DataFrame({
                    "doc_id": pdf["doc_id"].iloc[s].to_numpy(), "mark": pdf["mark"].iloc[s].to_numpy(), "n": n,
                    "d1": d1.view(np.int64), "d2": d2.view(np.int64), "sketch": [r.tobytes() for r in sketch]})


def _children(paths: np.ndarray, sketches: np.ndarray) -> np.ndarray:
    """Rows x FAN paths of the children; the coordinates follow from the path."""
    rows, out = np.arange(len(paths)), np.zeros((len(paths), FAN), np.uint64)
    for k in range(FAN):
        # Coordinates of one node are distinct: steps of an odd width through a power of two.
        at = ((_mix(paths, 6) + np.uint64(k) * (_mix(paths, 7) | np.uint64(1))) % np.uint64(WIDTH)).astype(np.int64)
        out[:, k] = _mix(_mix(paths + at.astype(np.uint64), 8) ^ sketches[rows, at].astype(np.uint64), 9)
    return out


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u4").reshape(-1, WIDTH)


def _equal_chances(similarity: float) -> list[float]:
    """Chance of each number of equal min-hashes in the sketches of a pair."""
    return [math.comb(WIDTH, c) * similarity**c * (1 - similarity) ** (WIDTH - c) for c in range(WIDTH + 1)]


def least_equal(similarity: float, recall: float) -> int:
    """Equal min-hashes below which a pair is not verified: fewer have a hundredth of 1 - recall at the threshold at most."""
    chances = _equal_chances(similarity)
    return max(c for c in range(WIDTH + 1) if sum(chances[:c]) <= (1 - recall) / 100)


def pair_loss(similarity: float, recall: float, runs: int) -> float:
    """Chance that a pair at the threshold is lost: its sketches differ too much, or it meets under none of the roots.

    A node loses it if all its coordinates differ or its children lose it; all roots use one sketch, so this follows from its equal min-hashes.
    """
    chances, least = _equal_chances(similarity), least_equal(similarity, recall)
    total = sum(chances[:least])
    for c in range(least, WIDTH + 1):
        lost = 0.0
        for _ in range(DEPTH):
            lost = (1 - c / WIDTH + c / WIDTH * lost) ** FAN
        total += chances[c] * lost**runs
    return total


def runs_needed(similarity: float, recall: float) -> int:
    """Roots for the recall of a pair at the threshold."""
    runs = 1
    while pair_loss(similarity, recall, runs) > 1 - recall:
        runs += 1
    return runs


def groups_of(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of rows that come in order of their keys."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        values = pdf[keys].to_numpy()
        cuts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1), len(pdf)]
        for a, b in zip(cuts, cuts[1:]):
            part = pdf.iloc[a:b]
            if held and (held[-1][keys].iloc[0].to_numpy() != values[a]).any():
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _roots(linked: np.ndarray) -> np.ndarray:
    """Least member of each row's component in a symmetric matrix of links."""
    label = np.arange(len(linked))
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label)))
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _tiled(rows: DataFrame, group: str, size: str, limit: int) -> DataFrame:
    """Deals groups above the limit to pairs of tiles: adds tile (0 for small groups) and side (0 left, 1 right, 2 both)."""
    tiles = F.ceil(F.col(size) / limit).cast("int")
    own = F.pmod(F.xxhash64("rep", F.lit(11)), tiles).cast("int")
    rows = rows.select("*", tiles.alias("tiles"), own.alias("own"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    rows = rows.select("*", other)
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return rows.select("*", (low * F.col("tiles") + high).alias("tile"), side.alias("side")).drop("tiles", "own", "other")


def _leaf_stars(threshold: float, recall: float) -> Callable:
    least = least_equal(threshold, recall)

    def stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out_a, out_b = [], []
        for pdf in groups_of(batches, ["path", "tile"]):
            s, rep, side = _matrix(pdf["sketch"]), pdf["rep"].to_numpy(), pdf["side"].to_numpy()
            if len(rep) < 2:
                continue
            equal = np.zeros((len(rep), len(rep)), np.uint8)
            for k in range(WIDTH):
                equal += s[:, k][:, None] == s[:, k][None, :]
            linked = equal >= least
            if (side != 2).any():
                linked &= side[:, None] != side[None, :]
            root = _roots(linked)
            far = root != np.arange(len(rep))
            out_a.append(rep[far])
            out_b.append(rep[root[far]])
            if len(out_a) > 1000:
                yield pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})
                out_a, out_b = [], []
        if out_a:
            yield pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    return stars


def chosen_paths(reps: DataFrame, threshold: float, recall: float, leaf: int, work: Workspace) -> DataFrame:
    """Edges (a, b) from sets to the least set that they are connected to in a leaf."""
    roots = _mix(np.arange(runs_needed(threshold, recall), dtype=np.uint64), 10)

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            s, rep = _matrix(pdf["sketch"]), pdf["rep"].to_numpy()
            for root in roots:
                paths = _children(np.full(len(rep), root), s)
                for k in range(FAN):
                    yield pd.DataFrame({"rep": rep, "path": paths[:, k].view(np.int64), "above": np.int64(0)})

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            paths = _children(pdf["path"].to_numpy().view(np.uint64), _matrix(pdf["sketch"]))
            for k in range(FAN):
                yield pd.DataFrame({"rep": pdf["rep"], "path": paths[:, k].view(np.int64), "above": pdf["size"]})

    row, sketches, leaves = "rep long, path long, above long", reps.select("rep", "sketch"), None
    nodes = work.keep(reps.select("rep", "sketch").mapInPandas(first, row), "nodes0")
    for depth in range(1, DEPTH + 1):
        sizes = nodes.groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
        held = work.keep(nodes.join(sizes, "path"), f"held{depth}")
        done = (F.col("size") <= leaf) | ((F.col("above") > 0) & (2 * F.col("size") > F.col("above"))) | F.lit(depth == DEPTH)
        part = held.where(done)
        leaves = part if leaves is None else leaves.unionByName(part)
        large = held.where(~done)
        if large.isEmpty():
            break
        nodes = work.keep(large.join(sketches, "rep").mapInPandas(split, row), f"nodes{depth}")
    # Tiles are dealt before the sketches are fetched, and whole nodes meet by path and tile.
    dealt = _tiled(leaves.select("rep", "path", "size"), "path", "size", leaf).join(sketches, "rep")
    dealt = dealt.select("path", "tile", "side", "rep", "sketch").repartition("path", "tile").sortWithinPartitions("path", "tile", "rep")
    return work.keep(dealt.mapInPandas(_leaf_stars(threshold, recall), "a long, b long").distinct(), "stars")


def components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """(node, label): the least node of each component, by least neighbours and pointer jumps."""
    both = work.keep(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}_edges")
    labels = work.keep(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), f"{name}_0")
    step = 0
    while True:
        step += 1
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("low"))
        moved = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", "label", F.least("label", "low").alias("low"))
        jump = moved.select(F.col("node").alias("low"), F.col("low").alias("next"))
        new = work.keep(moved.join(jump, "low").select("node", F.col("label").alias("old"), F.least("low", "next").alias("label")), f"{name}_{step}")
        if new.where("old != label").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def _common(codes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Number of common shingles of all pairs of n sets."""
    out = np.zeros((n, n), np.float32)
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    step, at = max(1, (1 << 22) // n), 0
    while at < len(codes):
        to = int(np.searchsorted(codes, codes[at] + step, "left"))
        block = np.zeros((n, step), np.float32)
        block[owner[at:to], codes[at:to] - codes[at]] = 1
        out += block @ block.T
        at = to
    return out


def _verified(threshold: float) -> Callable:
    share = Fraction(threshold).limit_denominator(1000)

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in groups_of(batches, ["group", "tile"]):
            pdf = pdf.drop_duplicates("rep")
            rep, side, copies = pdf["rep"].to_numpy(), pdf["side"].to_numpy(), pdf["copies"].to_numpy()
            h, n = shingle_hashes(pdf["text"].tolist())
            owner = np.repeat(np.arange(len(n)), n)
            pairs = np.unique(np.stack([h, owner.astype(np.uint64)]), axis=1) if len(h) else np.zeros((2, 0), np.uint64)
            codes, owner = pd.factorize(pairs[0])[0], pairs[1].astype(np.int64)
            n = np.bincount(owner, minlength=len(rep))
            met = np.bincount(codes)
            often = met[codes] > 1
            codes, owner = pd.factorize(codes[often])[0], owner[often]
            common = _common(codes, owner, len(rep)).astype(np.int64)
            linked = share.denominator * common >= share.numerator * (n[:, None] + n[None, :] - common)
            np.fill_diagonal(linked, False)
            if (side != 2).any():
                linked &= side[:, None] != side[None, :]
            yield pd.DataFrame({"rep": rep, "links": linked @ copies, "root": rep[_roots(linked)]})

    return verify


def _maybe_members(rows: DataFrame, members: DataFrame, work: Workspace, most: int = 50_000_000) -> DataFrame:
    """Rows whose text hash a Bloom filter of the members lets pass, so that the join moves few other texts.

    The filter has about ten bits a member; above ``most`` members all rows go to the join, which decides exactly anyway.
    """
    n = members.count()
    if n > most:
        return rows
    marks = members.select(F.col("mark").alias("h1"), F.xxhash64("mark").alias("h2"))
    shipped = rows.sparkSession.sparkContext.broadcast(fill_bloom(marks, Bloom(max(n, 1), 0.01, 0)))

    @F.pandas_udf("boolean")
    def passes(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(shipped.value.passes(np.stack([h1.to_numpy(), h2.to_numpy()], axis=1).view(np.uint64)))

    return rows.where(passes("mark", F.xxhash64("mark")))


def _classes(docs: DataFrame, threshold: float, recall: float, leaf: int, tile: int, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """The sketched rows, and per distinct set (d1, d2, doc_id, mark of its first copy, copies, class_id, n_links)."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    sketched = as_text(rows).mapInPandas(_sketch_rows, "doc_id string, mark long, n long, d1 long, d2 long, sketch binary")
    sketched = work.keep(as_long(sketched), "sketches")
    sets = sketched.where("n > 0").groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "mark", "sketch")).alias("first"), F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    reps = work.keep(sets.select(F.monotonically_increasing_id().alias("rep"), "d1", "d2", "first.*", "least", "copies"), "reps")
    groups = components(chosen_paths(reps, threshold, recall, leaf, work), work, "groups")
    sizes = groups.groupBy("label").agg(F.count("*").alias("size"))
    members = reps.select("rep", "doc_id", "mark", "copies").join(groups.select(F.col("node").alias("rep"), F.col("label").alias("group")), "rep")
    members = work.keep(members.join(sizes.withColumnRenamed("label", "group"), "group"), "members")
    rows = _maybe_members(rows, members, work)
    same = rows["doc_id"].eqNullSafe(members["doc_id"]) & (rows["mark"] == members["mark"])
    texts = rows.join(members, same).select("group", "size", "rep", "copies", "text")
    texts = _tiled(texts, "group", "size", tile).select("group", "tile", "side", "rep", "copies", "text")
    texts = texts.repartition("group", "tile").sortWithinPartitions("group", "tile", "rep")
    found = work.keep(texts.mapInPandas(_verified(threshold), "rep long, links long, root long"), "verified")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    if members.where(F.col("size") > tile).isEmpty():
        classes = found.select(F.col("rep").alias("node"), F.col("root").alias("label"))
    else:
        classes = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), work, "classes")
    linked = links.join(classes.withColumnRenamed("node", "rep"), "rep")
    named = linked.join(reps.select("rep", "least"), "rep").groupBy("label").agg(F.min("least").alias("class_id"))
    linked = linked.join(named, "label").select("rep", "links", "label", "class_id")
    reps = reps.drop("sketch").join(linked, "rep", "left")
    return sketched, work.keep(reps.select(
        "d1", "d2", "doc_id", "mark", "copies", F.coalesce("label", "rep").alias("label"),
        F.when(F.col("links").isNull(), F.col("least")).otherwise(F.col("class_id")).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classed")


def join(docs: DataFrame, threshold: float = 0.8, recall: float = 0.99999, leaf: int = 2048, tile: int = 2048) -> DataFrame:
    """Per document: doc_id, class_id and n_links (other documents of similarity ``threshold`` or more), with n_shingles."""
    sketched, sets = _classes(docs, threshold, recall, leaf, tile, Workspace(docs.sparkSession))
    out = sketched.select("doc_id", "n", "d1", "d2")
    some = out.where("n > 0").join(sets.select("d1", "d2", "class_id", "n_links"), ["d1", "d2"]).select("doc_id", "class_id", "n_links", F.col("n").alias("n_shingles"))
    none = out.where("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("n").alias("n_shingles"))
    return some.unionByName(none)


def one_of_each(docs: DataFrame, threshold: float = 0.8, recall: float = 0.99999, leaf: int = 2048, tile: int = 2048) -> DataFrame:
    """The rows of ``docs``, all columns, with the one of least doc_id (then text hash) left of each class; wordless rows stay."""
    work = Workspace(docs.sparkSession)
    sketched, sets = _classes(docs, threshold, recall, leaf, tile, work)
    best = work.keep(sets.groupBy("label").agg(F.min(F.struct("doc_id", "mark")).alias("best")).select("best.*"), "best")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("i"), F.xxhash64("text").alias("m"), F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("words"))
    left = rows.where("words").join(best, rows["i"].eqNullSafe(best["doc_id"]) & (rows["m"] == best["mark"])).select("row", "i", "m")
    if not sketched.where("n > 0").groupBy("doc_id", "mark").count().where("count > 1").isEmpty():
        left = left.dropDuplicates(["i", "m"])
    return left.select("row").unionByName(rows.where("NOT words").select("row")).select("row.*")


SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, hash(w[p:p + 4]) AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
e AS MATERIALIZED (
  SELECT p.a, p.b FROM (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.r <> y.r GROUP BY 1, 2) p
  JOIN n m ON m.r = p.a JOIN n o ON o.r = p.b WHERE 5 * c >= 4 * (m.n + o.n - c)),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
c AS (SELECT reach.a AS r, min(d.doc_id) AS class_id FROM reach JOIN d ON d.r = reach.b GROUP BY 1),
l AS (SELECT a AS r, count(*) AS n_links FROM e GROUP BY 1)
SELECT doc_id, class_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(n, 0)::BIGINT AS n_shingles
FROM d JOIN c USING (r) LEFT JOIN l USING (r) LEFT JOIN n USING (r)
"""
