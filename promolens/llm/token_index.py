"""Token ids as raw shards with a minimal perfect hash index for keyed access.

``write_tokens`` range-partitions the documents by doc_id, and each task encodes its documents and writes
one shard: ``.bin`` holds all ids as little-endian unsigned integers in ascending doc_id order, of 16 bits where
the vocabulary fits and else of 32, ``.idx`` the doc_ids, the number of ids of each document and the index. The index places each distinct
doc_id without collision: on a level every key hashes to one bit of a table, keys alone on their bit are
placed, the rest go to the next level; the rank of a key's bit is its slot. A slot keeps a 32-bit
fingerprint, the first row and the number of rows of its key. An absent key fails the fingerprint (but for
one in four billion), a present one is found in constant time.

A task names its files by itself and reports them in a manifest row that Spark commits, so a retried or
doubled task leaves files nobody refers to. A shard is as large as a range partition; more data makes more
shards. The writing library takes any folder that its file systems know (file, s3, gs, hdfs).

Encoding splits a text at ASCII white space, which the vocabulary's pre-tokenizer drops and never joins, and
keeps the ids of ``cache`` words and as many pieces of words per worker. A new word is normalised, split by the
pattern of the vocabulary's file and given to the library's model; unusual words go through the whole library.

Nulls: a null text is empty and has the end id only; rows with a null doc_id come first and have no index
entry. Rows of one doc_id are ordered by text hash and share a slot. An empty table gives no shards and no
rows. Other columns are ignored.
"""

from __future__ import annotations

import io
import json
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promolens.llm.ids import as_text
from promolens.session import Workspace

MANIFEST = "shard int, n_docs long, n_tokens long, low long, high long, n_null long, width int, bin string, idx string"
PART = 1 << 22  # ids read at a time


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser with shifts and odd multipliers."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit keys; ``slots`` maps keys to 0 .. n-1, absent ones anywhere."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes.astype(np.int64), bits
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, levels = keys, [], []
        while len(left):
            size = 2 * len(left)
            at = (_mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at]]
        return cls(np.array(sizes), np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.zeros(len(keys), np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = self.starts[level] + (_mix(keys[left], level) % np.uint64(size)).astype(np.int64)
            here = self.bits[at]
            out[left[here]] = self.rank[at[here]]
            left = left[~here]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 10**6) >> np.uint64(32)).astype(np.uint32)


def build_index(docs: np.ndarray, lengths: np.ndarray, n_null: int) -> bytes:
    """The .idx file of ascending ``docs``, the first ``n_null`` of which have no key."""
    keys, first, rows = np.unique(docs[n_null:], return_index=True, return_counts=True)
    table = PerfectHash.build(keys)
    slot = table.slots(keys)
    marks, firsts, counts = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    marks[slot], firsts[slot], counts[slot] = fingerprints(keys), first + n_null, rows
    out = io.BytesIO()
    np.savez(out, docs=docs, lengths=lengths, n_null=n_null, sizes=table.sizes, bits=np.packbits(table.bits), n_bits=len(table.bits), marks=marks, firsts=firsts, counts=counts)
    return out.getvalue()


class Shard:
    """One shard opened for sequential and keyed reading."""

    def __init__(self, bin_uri: str, idx_uri: str, width: int):
        self.width = width
        fs, path = _place(idx_uri)
        with fs.open_input_file(path) as f:
            z = np.load(io.BytesIO(f.read()))
            self.docs, self.lengths, self.n_null = z["docs"], z["lengths"].astype(np.int64), int(z["n_null"])
            self.table = PerfectHash(z["sizes"], np.unpackbits(z["bits"])[: int(z["n_bits"])].astype(bool))
            self.marks, self.firsts, self.counts = z["marks"], z["firsts"], z["counts"]
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.fs, self.path = _place(bin_uri)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows of each key; (-1, 0) where the fingerprint says that it is absent."""
        if not len(self.marks):
            return np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        slot = self.table.slots(keys)
        there = self.marks[slot] == fingerprints(keys)
        return np.where(there, self.firsts[slot], -1), np.where(there, self.counts[slot], 0)

    def ids(self, key: int) -> list[np.ndarray]:
        """The ids of each document with this key, read from its place."""
        (row,), (n,) = self.find(np.array([key], np.int64))
        with self.fs.open_input_file(self.path) as f:
            return [np.frombuffer(f.read_at(int(self.lengths[r]) * self.width, int(self.starts[r]) * self.width), f"<u{self.width}") for r in range(row, row + n)]


def _place(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where it prints, else the next one above 255."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(plain))
    return letters


class Recent(dict):
    """What ``made`` gives for a key, kept for at most ``limit`` keys; the full newer half replaces the older, and keys asked for again move back."""

    def __init__(self, limit: int):
        self.half, self.older = max(1, limit // 2), {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.made(key)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Pieces(Recent):
    """Ids of the pieces that the pre-tokenizer makes, as bytes."""

    def __init__(self, model, kind: str, limit: int):
        super().__init__(limit)
        self.model, self.code, self.letters = model, "H" if kind == "<u2" else "I", _byte_letters()

    def made(self, piece: str) -> bytes:
        text = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.model.tokenize(text)]
        return struct.pack(f"<{len(ids)}{self.code}", *ids)


class Words(Recent):
    """Ids of words without ASCII white space, as bytes; a new word is encoded on first use."""

    def __init__(self, path: str, limit: int):
        import regex
        from tokenizers import Tokenizer

        super().__init__(limit)
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        settings = json.loads(self.tokenizer.to_str())
        steps = (settings.get("pre_tokenizer") or {}).get("pretokenizers") or []
        forms = [n["type"] for n in (settings.get("normalizer") or {}).get("normalizers") or []]
        # Only this chain is taken apart: lower-casing, a split by pattern, bytes as letters, merges.
        known = [x["type"] for x in steps] == ["Split", "ByteLevel"] and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]
        self.simple = known and forms == ["NFC", "Replace", "Lowercase"] and settings["model"]["type"] == "BPE"
        self.split = regex.compile(steps[0]["pattern"]["Regex"]) if self.simple else None
        self.pieces = Pieces(self.tokenizer.model, self.kind, limit)

    def made(self, word: bytes) -> bytes:
        if self.simple and word.isalpha():
            return self.pieces[word.lower().decode()]
        text = word.decode()
        if not self.simple or "<|" in text or not text.isprintable():
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        # Up to U+00FF, the bytes below C4, every character is composed and lower-cased by itself.
        text = text.lower() if max(word) < 0xC4 else self.tokenizer.normalizer.normalize_str(text)
        if text.isalpha():
            return self.pieces[text]
        if text[:-1].isalpha():
            return self.pieces[text[:-1]] + self.pieces[text[-1]]
        return b"".join([self.pieces[p] for p in self.split.findall(text)])


_ENCODERS: dict[tuple[str, int], Words] = {}


def encoder(path: str, cache: int) -> Words:
    """The worker's words of this vocabulary."""
    if (path, cache) not in _ENCODERS:
        _ENCODERS[path, cache] = Words(path, cache)
    return _ENCODERS[path, cache]


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, shards: int | None = None, cache: int = 400_000) -> DataFrame:
    """Writes the shards below ``folder`` and returns the manifest, one row per shard, from its written table."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    rows = (rows.repartitionByRange(shards, *order) if shards else rows.repartitionByRange(*order)).sortWithinPartitions(*order)
    rows = as_text(rows)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, name, out = encoder(tokenizer, cache), uuid.uuid4().hex, None
        end, width = np.array([end_id], words.kind).tobytes(), np.dtype(words.kind).itemsize
        keys, lengths, n_null = [], [], 0
        for pdf in batches:
            if not len(pdf):
                continue
            if out is None:
                fs, path = _place(f"{folder}/{name}.bin")
                fs.create_dir(posixpath.dirname(path), recursive=True)
                out = fs.open_output_stream(path)
            for text in pdf["text"]:
                ids = b"".join(map(words.__getitem__, text.encode().split())) + end
                lengths.append(len(ids) // width)
                out.write(ids)
            n_null += int(pdf["doc_id"].isna().sum())
            keys.append(np.array([0 if i is None else int(i) for i in pdf["doc_id"]], np.int64))
        if out is not None:
            out.close()
            all_keys, n = np.concatenate(keys), np.array(lengths, np.uint32)
            with fs.open_output_stream(path[:-3] + "idx") as f:
                f.write(build_index(all_keys, n, n_null))
            low, high = (int(all_keys[n_null]), int(all_keys[-1])) if n_null < len(all_keys) else (None, None)
            yield pd.DataFrame([(TaskContext.get().partitionId(), len(n), int(n.sum()), low, high, n_null, width, f"{folder}/{name}.bin", f"{folder}/{name}.idx")],
                               columns=[c.split()[0] for c in MANIFEST.split(", ")]).astype({"low": "Int64", "high": "Int64"})

    return Workspace(spark).keep(rows.mapInPandas(write, MANIFEST), "manifest")


def read_digests(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it), n_tokens, ids_crc32."""
    before = F.sum("n_tokens").over(Window.orderBy("shard")) - F.col("n_tokens")
    shards = manifest.select("shard", "bin", "idx", "width", before.alias("base"))
    shards = shards.repartition(max(1, manifest.count()))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for s in pdf.itertuples():
                shard = Shard(s.bin, s.idx, s.width)
                keys = shard.docs[shard.n_null :]
                first, n = shard.find(keys)
                run = np.arange(len(keys)) - np.searchsorted(keys, keys, "left")
                if len(keys) and (first < 0).any() | (run >= n).any():
                    raise ValueError(f"index and rows disagree in {s.idx}")
                row = np.concatenate([np.arange(shard.n_null), first + run]).astype(np.int64)
                with shard.fs.open_input_file(shard.path) as f:
                    at = 0
                    while at < len(row):
                        to = max(at + 1, int(np.searchsorted(shard.starts, shard.starts[at] + PART, "right")) - 1)
                        raw = f.read_at(int(shard.starts[to] - shard.starts[at]) * s.width, int(shard.starts[at]) * s.width)
                        ids = memoryview(np.frombuffer(raw, f"<u{s.width}").astype("<u4").tobytes())
                        a = (shard.starts[row[at:to]] - shard.starts[at]) * 4
                        crc = [zlib.crc32(ids[i : i + 4 * k]) for i, k in zip(a.tolist(), shard.lengths[row[at:to]].tolist())]
                        doc = pd.array(shard.docs[at:to], "Int64")
                        doc[: max(0, shard.n_null - at)] = pd.NA
                        yield pd.DataFrame({"doc_id": doc, "start": s.base + shard.starts[row[at:to]], "n_tokens": shard.lengths[row[at:to]], "ids_crc32": crc})
                        at = to

    return shards.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(manifest: DataFrame, key: int) -> list[np.ndarray]:
    """The ids of every document with this key, by the shards whose range holds it."""
    held = manifest.where((F.col("low") <= key) & (F.col("high") >= key)).orderBy("shard").collect()
    return [ids for s in held for ids in Shard(s.bin, s.idx, s.width).ids(key)]


def folder_for(spark: SparkSession) -> str:
    return Workspace(spark).folder + "/tokens"
