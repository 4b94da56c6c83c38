"""Substring dedup with repeated-phrase automata: words of a passage that an earlier document has already are removed.

A window is ``width`` consecutive words; a word goes if a window over it also starts in a document with a smaller ``doc_id``.
The texts are dealt once into blocks, kept as compressed rows. First, recurring windows are confirmed: every block sends the 80-bit keys of its different
windows, each with the smallest document that holds it, to the bucket of the key, and learns by one bit for each whether an
earlier document elsewhere holds it. Then every block compiles its confirmed phrases into Aho-Corasick automata (a shard holds at most
``shard`` phrases) and streams all its documents through them; each occurrence covers words of the documents after the owner.
Windows of a passage overlap, so a passage enters an automaton by its first and last window and one of every ``width`` between, chosen
by their keys alone; any two neighbours of these touch.

Scale: one scan and one write of the texts, which are never shuffled; the keys (10 to 12 bytes a window) are shuffled once.
The answers are bits, kept in the shared folder by the part of the table they belong to and read by the task that reads this part. A passage that a third of all documents share is one key in each block. A block holds about
``block`` bytes (or one longer text), a bucket about ``bucket`` windows; both are worked on whole in one task. The number of buckets follows from the
words counted; with more buckets than windows in a block, raise both. Nothing is collected or broadcast.

Two different windows have equal keys with a chance of 2^-80; inside a block the automata compare the words themselves.
Nulls: a null text has no words; a null ``doc_id`` is later than all others and not earlier than itself. Rows of one ``doc_id`` do not
remove each other's words. Texts of fewer than ``width`` words stay. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import xxhash
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.session import Workspace

GAP = r"[\x20\x09-\x0D]+"
BLOCK, BUCKET, SHARD = 2 << 20, 3_000_000, 25_000
BASE = 64
TEXTS = "block long, n_words long, packed binary"
ROWS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("words", pa.string())])
KEYS = "bucket int, block long, keys binary, tags binary, docs array<long>, owners binary"
ANSWERS = "block long, bucket int, mask binary"
CLEAN = "doc_id long, n_words long, n_removed long, spans array<struct<start: int, end: int>>, kept string"


def _schema(fields: str) -> pa.Schema:
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
             "array<struct<start: int, end: int>>": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))}
    split = [f.strip().split(" ", 1) for f in fields.replace("start: int, end", "start: int; end").split(",")]
    return pa.schema([(n, types[t.replace(";", ",")]) for n, t in split])


def _packed(block: int, rows: pa.Table) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, ROWS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows.combine_chunks())
    return pa.RecordBatch.from_pydict({"block": [block], "n_words": [pc.sum(rows["n_words"]).as_py()], "packed": [sink.getvalue().to_pybytes()]}, schema=_schema(TEXTS))


def _unpacked(packed: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(packed.as_buffer()).read_all().combine_chunks()


def blocked(docs: DataFrame, block: int) -> DataFrame:
    """The documents' words, one space between two, packed into blocks of about ``block`` bytes; one row for each block."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, parts = TaskContext.get().partitionId() << 32, 0, []
        for batch in batches:
            words = pc.ascii_trim(pc.replace_substring_regex(pc.fill_null(batch.column(1), ""), GAP, " "), " ")
            counts = pc.add(pc.count_substring(words, " "), pc.cast(pc.greater(pc.binary_length(words), 0), pa.int32())).cast(pa.int64())
            rows, start = pa.Table.from_arrays([batch.column(0), counts, words], schema=ROWS), 0
            for at, size in enumerate(pc.binary_length(words).to_pylist()):
                if held and held + size > block:
                    parts.append(rows.slice(start, at - start))
                    yield _packed(number, pa.concat_tables(parts))
                    number, held, parts, start = number + 1, 0, [], at
                held += size
            parts.append(rows.slice(start))
        if sum(p.num_rows for p in parts):
            yield _packed(number, pa.concat_tables(parts))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(deal, TEXTS)


@dataclass
class Windows:
    """The different windows of neighbouring documents, in the order of their keys.

    ``word`` numbers every word, ``document`` says whose it is, ``order`` ranks the documents by id. ``place`` is where each window
    starts, ``group`` which one it is; ``keys``, ``tags`` and ``owner`` (rank of the smallest document) are by group.
    """

    ids: list
    order: np.ndarray
    counts: np.ndarray
    word: np.ndarray
    document: np.ndarray
    vocabulary: int
    place: np.ndarray
    key_at: np.ndarray
    group: np.ndarray
    keys: np.ndarray
    tags: np.ndarray
    owner: np.ndarray


def windows_of(doc_ids: pa.Array, words: pa.Array, counts: np.ndarray, width: int) -> Windows:
    ids = sorted({i for i in doc_ids.to_pylist() if i is not None}) + [None]
    rank = {i: k for k, i in enumerate(ids)}
    order = np.array([rank[i] for i in doc_ids.to_pylist()], np.int64)
    filled = pc.filter(words, pa.array(counts > 0))
    coded = pc.list_flatten(pc.split_pattern(filled, " ")).dictionary_encode()
    word = coded.indices.to_numpy().astype(np.int64)
    document = np.repeat(np.arange(len(counts)), counts)
    digests = [xxhash.xxh3_128_intdigest(w) for w in coded.dictionary.to_pylist()]
    low = np.array([d & (2**64 - 1) for d in digests], np.uint64)
    high = np.array([d >> 64 for d in digests], np.uint64)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(word))  # words to the end of the document
    place = np.flatnonzero(left >= width)
    key_at, tag_at = np.zeros(len(place), np.uint64), np.zeros(len(place), np.uint64)
    for j in range(width):
        at = word[place + j]
        key_at += low[at] * np.uint64(xxhash.xxh3_64_intdigest(f"key {j}") | 1)
        tag_at += high[at] * np.uint64(xxhash.xxh3_64_intdigest(f"tag {j}") | 1)
    # The low bits of a sum of odd multiples are weak; the high bits are folded in.
    key_at = (key_at ^ (key_at >> np.uint64(32))) * np.uint64(xxhash.xxh3_64_intdigest("fold") | 1)
    key_at ^= key_at >> np.uint64(29)
    tags_at = (tag_at >> np.uint64(48)).astype(np.uint16)
    by = np.argsort(key_at, kind="stable")
    if ((key_at[by][1:] == key_at[by][:-1]) & (tags_at[by][1:] != tags_at[by][:-1])).any():
        by = np.lexsort((tags_at, key_at))
    k, t = key_at[by], tags_at[by]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])])[: len(k)]
    starts = np.flatnonzero(new)
    group = np.empty(len(place), np.int64)
    group[by] = np.cumsum(new) - 1
    owner = np.minimum.reduceat(order[document[place]][by], starts) if len(starts) else np.zeros(0, np.int64)
    return Windows(ids, order, counts, word, document, len(digests), place, key_at, group, k[starts], t[starts], owner)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def pack_keys(keys: np.ndarray, bucket: int, buckets: int) -> bytes:
    """Ascending keys of a bucket as steps from its lower end, each of as many bytes as the longest needs."""
    low = np.uint64(-(-(bucket << 32) // buckets) << 32)
    steps = np.diff(np.concatenate([[low], keys]))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_keys(packed: bytes, n: int, bucket: int, buckets: int) -> np.ndarray:
    steps = np.zeros((n, 8), np.uint8)
    steps[:, : len(packed) // n] = np.frombuffer(packed, np.uint8).reshape(n, -1)
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64) + np.uint64(-(-(bucket << 32) // buckets) << 32)


def pack_owners(ids: list, owner: np.ndarray) -> tuple[list, bytes]:
    """Document ids by window: a list and places in it, or (smallest id alone) distances from it where that is shorter."""
    docs, at = np.unique(owner, return_inverse=True)
    held = [ids[d] for d in docs]
    kind = np.uint16 if len(docs) <= 65_536 else np.uint32
    if len(docs) > 1 and None not in held and held[-1] - held[0] < 2**32 and 8 * len(docs) > (4 - kind().itemsize) * len(at):
        return held[:1], (np.array(held, np.int64) - held[0]).astype(np.uint32)[at].tobytes()
    return held, at.astype(kind).tobytes()


def unpack_owners(docs: pa.Array, owners: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(id, is null) by window."""
    ids, null = docs.fill_null(0).to_numpy(), docs.is_null().to_numpy(zero_copy_only=False)
    at = np.frombuffer(owners, np.uint16 if len(owners) == 2 * n else np.uint32)
    if len(ids) == 1:
        return ids[0] + at.astype(np.int64), np.full(n, null[0])
    return ids[at], null[at]


def _windows(rows: pa.Table, width: int) -> Windows:
    return windows_of(rows["doc_id"].chunk(0), rows["words"].chunk(0), rows["n_words"].to_numpy(), width)


def window_keys(texts: DataFrame, width: int, buckets: int) -> DataFrame:
    """For each block and bucket its different windows with the smallest document that holds each."""
    schema = _schema(KEYS)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column(0), batch.column(1)):
                w = _windows(_unpacked(packed), width)
                numbers, starts = np.unique(bucket_of(w.keys, buckets), return_index=True)
                out = {name: [] for name in schema.names}
                for number, a, b in zip(numbers.tolist(), starts.tolist(), [*starts[1:].tolist(), len(w.keys)]):
                    docs, owners = pack_owners(w.ids, w.owner[a:b])
                    values = (number, block.as_py(), pack_keys(w.keys[a:b], number, buckets), w.tags[a:b].tobytes(), docs, owners)
                    for name, value in zip(out, values):
                        out[name].append(value)
                if numbers.size:
                    yield pa.RecordBatch.from_pydict(out, schema=schema)

    return texts.select("block", "packed").mapInArrow(send, KEYS)


def _confirm(rows: pa.Table, buckets: int) -> pa.Table:
    """One bit for each window of a bucket: does an earlier document elsewhere hold it?"""
    tags = np.concatenate([np.frombuffer(b, np.uint16) for b in rows["tags"].to_pylist()])
    sizes = np.array([len(b) // 2 for b in rows["tags"].to_pylist()])
    number, ends = rows["bucket"][0].as_py(), np.cumsum(sizes)
    key, doc, null = np.zeros(len(tags), np.uint64), np.zeros(len(tags), np.int64), np.zeros(len(tags), bool)
    for n, end, keys, docs, owners in zip(sizes, ends, rows["keys"].to_pylist(), rows["docs"], rows["owners"].to_pylist()):
        key[end - n:end] = unpack_keys(keys, n, number, buckets)
        doc[end - n:end], null[end - n:end] = unpack_owners(docs.values, owners, n)
    by = np.argsort(key)
    same = key[by][1:] == key[by][:-1]
    twice = np.sort(by[np.concatenate([[False], same]) | np.concatenate([same, [False]])])
    by = twice[np.lexsort((doc[twice], null[twice], tags[twice], key[twice]))]
    new = np.concatenate([[True], (key[by][1:] != key[by][:-1]) | (tags[by][1:] != tags[by][:-1])])[: len(by)]
    first = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
    later = ~null[first] & (null[by] | (doc[by] > doc[first]))
    hit = np.zeros(len(key), bool)
    hit[by[later]] = True
    held = [i for i, (n, end) in enumerate(zip(sizes, ends)) if hit[end - n:end].any()]
    masks = [np.packbits(hit[ends[i] - sizes[i]:ends[i]]).tobytes() for i in held]
    return rows.select(["block", "bucket"]).take(pa.array(held, pa.int64())).append_column("mask", pa.array(masks, pa.binary()))


def _chosen(run: np.ndarray, keys: np.ndarray, width: int) -> np.ndarray:
    """Places in runs of recurring windows that stand for the whole run: its ends and the least key of any ``width`` neighbours."""
    ends = np.concatenate([[True], run[1:] != run[:-1], [True]])
    out = ends[:-1] | ends[1:]
    if len(run) >= width:
        inside = np.flatnonzero(run[width - 1:] == run[: len(run) - width + 1])
        for part in np.array_split(inside, len(inside) * width // 4_000_000 + 1):
            out[part + np.argmin(keys[part[:, None] + np.arange(width)], axis=1)] = True
    return out


def _letters(words: np.ndarray, digits: int) -> str:
    """Words as letters, ``digits`` for each from alphabets of their own, so a match can only start with a word."""
    powers = BASE ** np.arange(digits)
    return (words[:, None] // powers % BASE + np.arange(digits) * BASE + 256).astype("<u4").tobytes().decode("utf-32-le")


def covered_words(w: Windows, outside: np.ndarray, width: int, shard: int) -> np.ndarray:
    """True for words to remove. ``outside`` marks groups that an earlier document elsewhere holds."""
    # The documents after this rank lose the words of the group's windows.
    after = np.where(outside, -1, w.owner)
    rank = w.order[w.document[w.place]]
    hit = np.flatnonzero(rank > after[w.group])
    change = np.zeros(len(w.word) + 1, np.int64)
    if not len(hit):
        return change[:-1] > 0
    at = w.place[hit]
    run = np.cumsum(np.concatenate([[0], (np.diff(at) > 1) | (np.diff(w.document[at]) > 0)]))
    hit = hit[_chosen(run, w.key_at[hit], width)]
    _, one_each = np.unique(w.group[hit], return_index=True)
    phrases = hit[one_each]
    digits = 1
    while BASE**digits < w.vocabulary:
        digits += 1
    text = _letters(w.word, digits)
    ends = np.cumsum(w.counts)
    streams = [(text[(e - n) * digits:e * digits], int(e - n), int(o)) for e, n, o in zip(ends, w.counts, w.order) if n >= width]
    for part in range(0, len(phrases), shard):
        automaton = ahocorasick.Automaton()
        for p, limit in zip(w.place[phrases[part:part + shard]].tolist(), after[w.group[phrases[part:part + shard]]].tolist()):
            automaton.add_word(text[p * digits:(p + width) * digits], limit)
        automaton.make_automaton()
        starts = [begin + (end + 1) // digits - width for stream, begin, order in streams for end, limit in automaton.iter(stream) if order > limit]
        np.add.at(change, starts, 1)
        np.add.at(change, np.asarray(starts, np.int64) + width, -1)
    return np.cumsum(change)[:-1] > 0


class Answers:
    """The answers to the blocks of one table part, read from the shared folder when its first block comes."""

    def __init__(self, folder: str):
        self.folder, self.source, self.of_block = folder, None, {}

    def masks(self, block: int) -> list[tuple[int, bytes]]:
        if block >> 32 != self.source:
            self.source, self.of_block = block >> 32, defaultdict(list)
            fs, path = FileSystem.from_uri(f"{self.folder}/source={self.source}")
            if fs.get_file_info(path).type == FileType.Directory:
                files = [f.path for f in fs.get_file_info(FileSelector(path)) if f.base_name.endswith(".parquet")]
                for rows in (pq.read_table(f, filesystem=fs, columns=["block", "bucket", "mask"], partitioning=None) for f in files):
                    for number, bucket, mask in zip(*[c.to_pylist() for c in rows.columns]):
                        self.of_block[number].append((bucket, mask))
        return self.of_block[block]


def _clean(rows: pa.Table, masks: list[tuple[int, bytes]], width: int, shard: int, buckets: int) -> pa.Table:
    """One block: its documents without the words covered. A bucket without an answer has nothing in common with other blocks."""
    w = _windows(rows, width)
    outside, bucket = np.zeros(len(w.keys), bool), bucket_of(w.keys, buckets)
    for number, mask in masks:
        low, high = np.searchsorted(bucket, [number, number + 1])
        outside[low:high] = np.unpackbits(np.frombuffer(mask, np.uint8), count=high - low).astype(bool)
    return _kept(rows, w, covered_words(w, outside, width, shard))


def _kept(part: pa.Table, w: Windows, gone: np.ndarray) -> pa.Table:
    ends = np.cumsum(w.counts)
    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    # A span ends with its document.
    last = np.zeros(len(gone) + 1, bool)
    last[ends] = True
    inner = last[1:-1] & gone[:-1] & gone[1:] if len(gone) else np.zeros(0, bool)
    starts = np.sort(np.concatenate([np.flatnonzero(edge == 1), np.flatnonzero(inner) + 1]))
    stops = np.sort(np.concatenate([np.flatnonzero(edge == -1), np.flatnonzero(inner) + 1]))
    whose = w.document[starts]
    offset = (ends - w.counts)[whose]
    lists = np.concatenate([[0], np.cumsum(np.bincount(whose, minlength=len(ends)))])
    spans = pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(starts - offset, pa.int32()), pa.array(stops - offset, pa.int32())], ["start", "end"]))
    removed = np.concatenate([[0], np.cumsum(gone)])
    removed = removed[ends] - removed[ends - w.counts]
    kept = []
    for text, n, end, r in zip(part["words"].to_pylist(), w.counts, ends, removed):
        kept.append(text if not r else "" if r == n else " ".join(compress(text.split(" "), (~gone[end - n:end]).tolist())))
    return pa.table([part["doc_id"].combine_chunks(), pa.array(w.counts, pa.int64()), pa.array(removed, pa.int64()), spans, pa.array(kept, pa.string())],
                    schema=_schema(CLEAN))


def remove_repeats(docs: DataFrame, width: int = 13, block: int = BLOCK, bucket: int = BUCKET, shard: int = SHARD) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, spans (word places removed, end excluded), kept (the words left, one space between two)."""
    work = Workspace(docs.sparkSession)
    texts = work.keep(blocked(docs, block), "texts")
    words = texts.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    buckets = max(1, -(-words // bucket))

    def confirm(rows: pa.Table) -> pa.Table:
        return _confirm(rows, buckets)

    answers = window_keys(texts, width, buckets).groupBy("bucket").applyInArrow(confirm, ANSWERS).withColumn("source", F.shiftright("block", 32))
    work.keep(answers.repartition("source"), "answers", ["source"])
    folder = f"{work.folder if '://' in work.folder else 'file://' + work.folder.removeprefix('file:')}/answers"

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Answers(folder)
        for batch in batches:
            for number, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield from _clean(_unpacked(packed), found.masks(number), width, shard, buckets).to_batches()

    return texts.select("block", "packed").mapInArrow(clean, CLEAN)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, doc_id, p, md5(array_to_string(w[p:p + 12], ' ')) AS k FROM (SELECT *, unnest(range(1, len(w) - 11)) AS p FROM d WHERE len(w) >= 13)),
own AS (SELECT k, min(doc_id) AS o FROM win GROUP BY k),
hit AS (SELECT DISTINCT r, unnest(range(p, p + 13)) AS q FROM win JOIN own USING (k) WHERE o < doc_id OR (doc_id IS NULL AND o IS NOT NULL)),
tok AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS words FROM tok ANTI JOIN hit USING (r, q) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
