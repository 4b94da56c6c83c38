"""Target-distribution importance resampling: documents whose n-grams look like the target's are drawn first.

Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. A feature is a run of 1 to ``ngrams``
words; its bucket is the crc32 of its bytes modulo ``buckets``. Arrow kernels do the work inside a task: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode`` turn a block of texts into word numbers; numbers shifted by
one form the pairs of a longer gram, and a crc32 is taken once for each distinct word or pair, continued from that of the
shorter gram. Gains are taken by bucket and summed over each document's segment.

Scale: two scans of the texts, each a block of ``block`` bytes at a time whatever a batch holds. The first sends one row
for each bucket and task, the gains (``buckets`` numbers, a parameter) go to the second in the task itself. The draw ranks
rows without their texts: ranges of (score, doc_id), each about as large as any other, are numbered from their counts.

Nulls: a null text has no words; a null ``doc_id`` draws its noise as '' and comes last among ties. Repeated rows are
rows of their own; equal rows follow each other. Texts are taken whole. Without documents there are no rows, without a
benchmark T is 0. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.session import Workspace

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK = 4 << 20


def blocks_of(texts: pa.Array, block: int) -> Iterator[pa.Array]:
    """Consecutive slices of about ``block`` bytes; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto, at = np.cumsum(sizes), 0
    while at < len(texts):
        done = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + block, side="right")))
        yield texts.slice(at, end - at)
        at = end


def gram_crcs(texts: pa.Array, ngrams: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words per text and, for each gram length, (text, crc32) of all its grams in order of the texts."""
    pieces = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), GAP)
    coded = pc.list_flatten(pieces).dictionary_encode()
    word, owner = coded.indices.to_numpy(), pc.list_parent_indices(pieces).to_numpy()
    vocabulary = [w.encode() for w in coded.dictionary.to_pylist()]
    filled = np.array([len(w) > 0 for w in vocabulary], bool)[word]  # a gap at either end leaves an empty piece
    word, owner = word[filled], owner[filled]
    counts = np.bincount(owner, minlength=len(texts))
    crc = np.fromiter((zlib.crc32(w) for w in vocabulary), np.uint32, len(vocabulary))
    gram, of_gram, out = word.astype(np.int64), crc, [(owner, crc[word])]
    for n in range(2, ngrams + 1):
        inside = owner[n - 1:] == owner[: len(owner) - n + 1]
        shorter, last = gram[: len(owner) - n + 1], word[n - 1:]
        pairs, at = np.unique(shorter * len(vocabulary) + last, return_inverse=True)
        heads, tails = np.divmod(pairs, max(len(vocabulary), 1))
        of_gram = np.fromiter((zlib.crc32(b" " + vocabulary[t], int(of_gram[h])) for h, t in zip(heads, tails)), np.uint32, len(pairs))
        gram = at
        out.append((owner[: len(gram)][inside], of_gram[at][inside]))
    return counts, out


def bucket_counts(texts: DataFrame, ngrams: int, buckets: int, block: int) -> DataFrame:
    """(bucket, n): features of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in blocks_of(batch.column(0), block):
                for _, crcs in gram_crcs(part, ngrams)[1]:
                    total += np.bincount(crcs % buckets, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["bucket", "n"])

    return texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains_of(docs: DataFrame, benchmark: DataFrame, ngrams: int, buckets: int, block: int) -> np.ndarray:
    """floor(1000 ln) of every bucket's share in the target over its share in the documents, both smoothed by one."""
    source = bucket_counts(docs, ngrams, buckets, block).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
    target = bucket_counts(benchmark, ngrams, buckets, block).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    held = source.unionByName(target).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).toArrow()
    s, t = np.zeros(buckets), np.zeros(buckets)
    at = held["bucket"].to_numpy()
    s[at], t[at] = held["s"].to_numpy(), held["t"].to_numpy()
    ratio = ((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, gains: np.ndarray, ngrams: int, block: int) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight (its features' gains summed)."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in blocks_of(batch.column(1), block):
                counts, grams = gram_crcs(part, ngrams)
                features, weight = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
                for owner, crcs in grams:
                    per_text = np.bincount(owner, minlength=len(part))
                    upto = np.concatenate([[0], np.cumsum(gains[crcs % len(gains)])])
                    ends = np.cumsum(per_text)
                    features += per_text
                    weight += upto[ends] - upto[ends - per_text]
                ids = batch.column(0).slice(done, len(part))
                done += len(part)
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(v, pa.int64()) for v in (counts, features, weight)]], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int) -> Column:
    """floor(1000 times a Gumbel draw) that follows from the seed and doc_id."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(mark, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def drawn(scored: DataFrame, percent: int, min_words: int, work: Workspace) -> DataFrame:
    """Adds ``rank`` to the highest ``percent`` of the documents with enough words; the others have none."""
    fit = scored.where(F.col("n_words") >= min_words)
    # Equal rows are told apart by their place in the written table, so that no range has to hold them all.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc()]
    placed = fit.withColumn("place", F.xxhash64(F.monotonically_increasing_id()))
    placed = work.keep(placed.repartitionByRange(*order, "place").withColumn("part", F.spark_partition_id()), "ranges")
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")  # a row for each range
    starts = placed.groupBy("part").agg(F.count("*").alias("n")).select("part", before.alias("start"))
    limit = placed.agg(F.floor(percent * F.count("*") / 100).alias("most")).select("most").scalar()
    at = F.row_number().over(Window.partitionBy("part").orderBy(*order, "place"))
    ranked = placed.withColumn("at", at).join(starts, "part").withColumn("rank", (F.col("start") + F.col("at")).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = ranked.select(*columns, F.when(F.col("rank") <= limit, F.col("rank")).alias("rank"))
    return ranked.unionByName(scored.where(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(
    docs: DataFrame, benchmark: DataFrame, ngrams: int = 1, buckets: int = 10_000, percent: int = 10, min_words: int = 20,
    seed: int = 2024, block: int = BLOCK,
) -> DataFrame:
    """Per document: doc_id, n_features, weight, score, rank (1 for the highest of the drawn ones, null if undrawn)."""
    work = Workspace(docs.sparkSession)
    gains = gains_of(docs, benchmark, ngrams, buckets, block)
    scored = weights(docs, gains, ngrams, block).withColumn("score", (F.col("weight") + noise(seed)).cast("long"))
    return drawn(work.keep(scored, "scored"), percent, min_words, work)


# crc32 has no SQL function there: bytes are folded over a table that follows from the polynomial.
SQL = r"""
WITH tab AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
i AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
dw AS (SELECT r, unnest(w) AS word FROM d),
dn AS (SELECT word, count(*) AS n FROM dw GROUP BY word),
bn AS (SELECT word, count(*) AS n FROM i GROUP BY word),
v AS (SELECT word FROM dn UNION SELECT word FROM bn),
k AS (SELECT word, (xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(word)), lambda p: ('0x' || substr(hex(encode(word)), 2 * p + 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000)::BIGINT AS bucket FROM v, tab),
b AS (SELECT bucket, sum(coalesce(dn.n, 0)) AS s, sum(coalesce(bn.n, 0)) AS t FROM k LEFT JOIN dn USING (word) LEFT JOIN bn USING (word) GROUP BY bucket),
a AS (SELECT bucket, s, t, sum(s) OVER () AS ss, sum(t) OVER () AS tt FROM b),
g AS (SELECT bucket, floor(1000 * ln(((t::DOUBLE + 1) * (ss::DOUBLE + 10000)) / ((s::DOUBLE + 1) * (tt::DOUBLE + 10000))))::BIGINT AS gain FROM a),
wt AS (SELECT r, sum(gain)::BIGINT AS weight FROM dw JOIN k USING (word) JOIN g USING (bucket) GROUP BY r),
sc AS (SELECT r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
       FROM d LEFT JOIN wt USING (r)),
o AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id ASC NULLS LAST, n_features) END AS place,
        count(*) FILTER (WHERE n_features >= 20) OVER () AS fit FROM sc)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * fit // 100 THEN place END::BIGINT AS rank FROM o
"""
