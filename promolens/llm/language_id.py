"""Language identification by interpolated Kneser-Ney character models, one per language.

Texts are lower-cased; every run of other characters than letters is one boundary. Four code points make the
64-bit hash of a four-gram. Four-grams are counted by language over all documents to learn from: each task
merges its own counts, Spark sums them. The model is one sorted array of hashes with the log-probability of
each four-gram under each language beside it; four-grams not in it back off to sorted arrays of shorter ones.
A text gets the language of the lowest cross-entropy per character. The score is the softmax of the
cross-entropies times the text's length, its temperature fitted on all documents to learn from; a text whose
cross-entropy lies above all but ``tail`` of those of its language, to a bin of 1/1024, is marked rejected.

All four-grams stay in the model. Up to ``max_grams`` of them it is collected and shipped once; a larger one gives the same
log-probabilities from blocks of at most about ``max_grams`` entries, made by Spark and read one at a time.

Nulls: a null text, or one without letters, is ``und`` with score 0. Rows with a null text, lang or doc_id are not learnt
from; a null doc_id is not held out. With nothing to learn from all is ``und``. Repeated rows count each.
Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.ids import as_long, as_text
from promolens.session import Workspace

CHUNK = 1 << 20  # characters worked on at a time; a text is never split
SPREAD = 65521  # a prime, so that all characters of a key have a part in its block
EDGE = np.uint16(32)
HEATS, BINS = 12, 1024  # temperatures 1, 2, 4 and so on; bins in a unit of cross-entropy
OUT = "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean"
_SYMBOLS: list[np.ndarray] = []


def _symbols() -> np.ndarray:
    """16 bits for each code point: no letter is EDGE, a letter above U+FFFF has a place that no letter of the basic plane has.

    Letters of neighbouring code points keep places of their own, so a script of some thousand letters has no two alike.
    """
    if not _SYMBOLS:
        letter = np.array([chr(i).isalpha() for i in range(0x110000)])
        free = np.flatnonzero(~letter[: 1 << 16])
        free, wide = free[free > EDGE], np.flatnonzero(letter)
        wide = wide[wide >= 1 << 16]
        table = np.full(len(letter), EDGE)
        table[: 1 << 16][letter[: 1 << 16]] = np.flatnonzero(letter[: 1 << 16])
        table[wide] = free[wide % len(free)]
        _SYMBOLS.append(table)
    return _SYMBOLS[0]


def letter_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Four-gram hashes of the texts in order, and the number of them in each text (0 without letters)."""
    return _grams(texts, lambda codes: _symbols()[codes])


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The same with all code points above U+FFFF as one letter. No model uses it, its test does."""
    return _grams(texts, lambda codes: np.where((codes > 0xFFFF) | (_symbols()[codes] != EDGE), np.minimum(codes, 0xFFFF).astype(np.uint16), EDGE))


def _grams(texts: list[str], symbols: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer("\0".join(["", *texts, ""]).lower().encode("utf-32-le", "replace"), "<u4")
    stops = np.flatnonzero(codes == 0)
    if len(stops) != len(texts) + 1:  # a text holds the separator itself
        return _grams([t.replace("\0", " ") for t in texts], symbols)
    low = symbols(codes)
    keep = low != EDGE
    at = np.ones(len(low), bool)
    at[1:] = keep[1:] | keep[:-1]  # one boundary for each run
    at[stops] = False
    low = low[at]
    owner = np.repeat(np.arange(len(texts)), np.diff(np.cumsum(at)[stops]))
    x = np.full(len(low) + 3 * len(texts), EDGE)
    spot = np.arange(len(low)) + 3 * (owner + 1)  # three boundaries stand before each text
    x[spot] = low
    wide = x.astype(np.uint64)
    grams = ((wide[:-3] << np.uint64(48)) | (wide[1:-2] << np.uint64(32)) | (wide[2:-1] << np.uint64(16)) | wide[3:])[spot - 3] if len(spot) else np.zeros(0, np.uint64)
    some = np.bincount(owner, weights=low != EDGE, minlength=len(texts)) > 0
    mine = some[owner] if len(owner) else np.zeros(0, bool)
    return grams[mine], np.bincount(owner[mine], minlength=len(texts))


def chunks(texts: list[str]) -> Iterator[slice]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if texts:
        yield slice(start, len(texts))


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (lang, text)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for pdf in batches:
            for lang, part in pdf.groupby("lang"):
                texts = part["text"].tolist()
                for s in chunks(texts):
                    code, gram = pd.factorize(letter_grams(texts[s])[0])
                    n = np.bincount(code, minlength=len(gram)).astype(np.int64)
                    if lang in held:
                        gram, n = np.concatenate([held[lang][0], gram]), np.concatenate([held[lang][1], n])
                        code, gram = pd.factorize(gram)
                        n = np.bincount(code, weights=n, minlength=len(gram)).astype(np.int64)
                    held[lang] = gram, n
            if sum(len(g) for g, _ in held.values()) > 4 * CHUNK:
                yield from flush(held)
                held = {}
        yield from flush(held)

    def flush(held) -> Iterator[pd.DataFrame]:
        for lang, (gram, n) in held.items():
            yield pd.DataFrame({"lang": lang, "gram": gram.view(np.int64), "n": n})

    return docs.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out, at = np.unique(keys, return_inverse=True)
    return out, np.bincount(at, weights=n, minlength=len(out))


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values at the wanted keys of a sorted array, 0 where there is none."""
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


class KneserNey:
    """Interpolated Kneser-Ney model of one language, orders 4 to 1 as sorted hash arrays."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, alphabet: int):
        self.levels, self.alphabet = [], alphabet
        keys, n = _sums(grams, counts)
        for order in (4, 3, 2, 1):
            once, twice = (n == 1).sum(), (n == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            context, total = _sums(keys >> np.uint64(16), n)
            kinds = _sums(keys >> np.uint64(16), np.ones(len(keys)))[1]
            self.levels.append((order, keys, np.maximum(n - discount, 0), context, total, discount * kinds))
            if order > 1:  # a shorter gram counts the characters seen before it
                keys, n = _sums(keys & np.uint64((1 << 16 * (order - 1)) - 1), np.ones(len(keys)))

    def log_probability(self, grams: np.ndarray) -> np.ndarray:
        p = np.full(len(grams), 1.0 / self.alphabet)
        for order, keys, mass, context, total, spare in reversed(self.levels):
            g = grams & np.uint64((1 << 16 * order) - 1)
            h = g >> np.uint64(16)
            seen = _look(context, total, h)
            own = (_look(keys, mass, g) + _look(context, spare, h) * p) / np.maximum(seen, 1)
            p = np.where(seen > 0, own, p)
        return np.log(p)


class Models:
    """The models of all languages over one sorted array of four-grams."""

    def __init__(self, table: pd.DataFrame):
        self.langs = sorted(table["lang"].unique())
        grams = table["gram"].to_numpy().view(np.uint64)
        alphabet = len(np.unique(grams & np.uint64(0xFFFF))) + 1
        rows = [(table["lang"] == lang).to_numpy() for lang in self.langs]
        self.models = [KneserNey(grams[r], table["n"].to_numpy(np.float64)[r], alphabet) for r in rows]
        self.keys = np.unique(grams)
        self.logs = np.stack([m.log_probability(self.keys) for m in self.models], axis=1).astype(np.float32) if self.langs else None
        self.heat, self.limits = 1.0, np.full(len(self.langs), np.inf)

    def log_probabilities(self, kinds: np.ndarray) -> np.ndarray:
        """Four-grams x languages."""
        at = np.minimum(np.searchsorted(self.keys, kinds), len(self.keys) - 1)
        logs, new = self.logs[at], self.keys[at] != kinds
        if new.any():
            logs[new] = np.stack([m.log_probability(kinds[new]) for m in self.models], axis=1)
        return logs

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character (texts x languages) and the number of characters."""
        grams, n = letter_grams(texts)
        code, kinds = pd.factorize(grams)
        logs = self.log_probabilities(kinds)
        ends = np.cumsum(n)
        out = np.zeros((len(texts), len(self.langs)))
        some = n > 0
        if some.any():
            for k in range(len(self.langs)):
                out[some, k] = -np.add.reduceat(logs[:, k].astype(np.float64)[code], (ends - n)[some])
        return out / np.maximum(n, 1)[:, None], n

    def scores(self, h: np.ndarray, n: np.ndarray, heat: float) -> np.ndarray:
        gap = (h - h.min(axis=1, keepdims=True)) * n[:, None] / heat
        e = np.exp(-np.minimum(gap, 700))
        return e / e.sum(axis=1, keepdims=True)

    def evidence(self, h: np.ndarray, n: np.ndarray, truth: np.ndarray) -> Counter:
        """Sums that add up over texts: (-1, heat) the log-likelihood of the true languages, (language, bin) the number of cross-entropies."""
        rows = np.arange(len(truth))
        found = Counter({(-1, t): float(np.log(np.maximum(self.scores(h, n, 2.0**t)[rows, truth], 1e-12)).sum()) for t in range(HEATS)})
        places, counts = np.unique(np.stack([truth, np.floor(h[rows, truth] * BINS).astype(np.int64)]), axis=1, return_counts=True)
        for (k, at), c in zip(places.T.tolist(), counts.tolist()):
            found[k, at] += c
        return found


def _block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    return keys.view(np.int64) % SPREAD % blocks


def _opened(block):
    """A shipped block; its copy in this process goes with the caller's."""
    value = block.value
    if getattr(block, "_path", None) is not None:
        block.__dict__.pop("_value", None)
    return value


class BlockModels(Models):
    """The same models in blocks by key, for more four-grams than one process holds.

    Orders 1 to 4 have a table of grams (count less discount) and one of contexts (total, spare mass); a block has sorted keys and values per language.
    """

    def __init__(self, counts: DataFrame, langs: list[str], most: int, work: Workspace):
        self.langs, self.most = langs, most
        self.heat, self.limits = 1.0, np.full(len(langs), np.inf)
        number = F.create_map(*[x for k, lang in enumerate(langs) for x in (F.lit(lang), F.lit(k))])
        level, self.tables = work.keep(counts.select(number[F.col("lang")].alias("k"), F.col("gram").alias("key"), "n"), "level4"), {}
        for order in (4, 3, 2, 1):
            few = {r["k"]: (r["once"], r["twice"]) for r in level.groupBy("k").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).collect()}
            discounts = [once / (once + 2 * twice) if once and twice else 0.5 for once, twice in (few[k] for k in range(len(langs)))]
            discount = F.create_map(*[x for k, d in enumerate(discounts) for x in (F.lit(k), F.lit(d))])[F.col("k")]
            context = level.groupBy("k", F.shiftrightunsigned("key", 16).alias("key")).agg(F.sum("n").cast("double").alias("a"), (discount * F.count("*")).alias("b"))
            own = level.select("k", "key", F.greatest(F.col("n") - discount, F.lit(0.0)).alias("a"))
            self.tables[order] = self._blocks(own, ["a"], work, f"own{order}"), self._blocks(context, ["a", "b"], work, f"context{order}")
            if order > 1:
                low = F.col("key").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1))
                level = work.keep(level.groupBy("k", low.alias("key")).agg(F.count("*").alias("n")), f"level{order - 1}")
        self.alphabet = level.select("key").distinct().count() + 1

    def _blocks(self, table: DataFrame, values: list[str], work: Workspace, name: str) -> list:
        context, table = table.sparkSession.sparkContext, work.keep(table, f"{name}_rows")
        blocks = max(1, -(-table.count() // self.most))
        place = F.pmod(F.pmod("key", F.lit(SPREAD)), F.lit(blocks)).cast("int")
        if blocks > 1:
            table = work.keep(table.select("*", place.alias("block")).repartition("block").sortWithinPartitions("block"), f"{name}_blocks")
        out = []
        for b in range(blocks):
            pdf = (table.where(F.col("block") == b) if blocks > 1 else table).select("k", "key", *values).toPandas()
            parts = {}
            for k, part in pdf.groupby("k"):
                keys = part["key"].to_numpy().view(np.uint64)
                order = np.argsort(keys)
                parts[int(k)] = (keys[order], *[part[v].to_numpy(np.float64)[order] for v in values])
            out.append(context.broadcast(parts))
        return out

    def _values(self, blocks: list, wanted: np.ndarray, n: int) -> list[np.ndarray]:
        out = [np.zeros((len(wanted), len(self.langs))) for _ in range(n)]
        place = _block_of(wanted, len(blocks))
        for b, block in enumerate(blocks):
            mine = np.flatnonzero(place == b)
            if len(mine):
                for k, (keys, *values) in _opened(block).items():
                    for o, v in zip(out, values):
                        o[mine, k] = _look(keys, v, wanted[mine])
        return out

    def log_probabilities(self, kinds: np.ndarray) -> np.ndarray:
        step = max(1, 4 * CHUNK // len(self.langs))
        if len(kinds) > step:
            return np.concatenate([self.log_probabilities(kinds[i : i + step]) for i in range(0, len(kinds), step)])
        p = np.full((len(kinds), len(self.langs)), 1.0 / self.alphabet)
        for order in (1, 2, 3, 4):
            g = kinds & np.uint64((1 << 16 * order) - 1)
            (mass,), (seen, spare) = self._values(self.tables[order][0], g, 1), self._values(self.tables[order][1], g >> np.uint64(16), 2)
            p = np.where(seen > 0, (mass + spare * p) / np.maximum(seen, 1), p)
        return np.log(p).astype(np.float32)

    @property
    def value(self) -> BlockModels:
        return self  # its blocks are shipped already


def shipped_form(spark, models: Models):
    return models if isinstance(models, BlockModels) else spark.sparkContext.broadcast(models)


def held_out(fold: int = 2, folds: int = 4) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of each language, the frequent ones; a hash decides between equal counts. No model uses it, its test does.

    Rows are binned by count and hash, and the bins give the place of the cut, so no language is sorted in one task.
    """
    rows = counts.select("*", (F.col("n") * 1024 + F.pmod(F.xxhash64("gram"), F.lit(1024))).alias("bin"))
    bins = rows.groupBy("lang", "bin").agg(F.count("*").alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("lang").orderBy(F.col("bin").desc()))
    cuts = bins.select("lang", "bin", upto.alias("upto")).where(F.col("upto") <= most).groupBy("lang").agg(F.min("bin").alias("cut"))
    return rows.join(cuts, "lang").where("bin >= cut").select("lang", "gram", "n")


def train(rows: DataFrame, max_grams: int, tail: float) -> Models:
    """Models from all rows of (doc_id, lang, text)."""
    work = Workspace(rows.sparkSession)
    counts = work.keep(count_grams(rows.select("lang", "text")), "grams")
    sizes = counts.groupBy("lang").count().collect()
    if sum(r["count"] for r in sizes) > max_grams:
        models = BlockModels(counts, sorted(r["lang"] for r in sizes), max_grams, work)
    else:
        models = Models(counts.toPandas())
    if not models.langs:
        return models
    shipped = shipped_form(rows.sparkSession, models)

    def evidence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, total = {lang: k for k, lang in enumerate(shipped.value.langs)}, Counter()
        for pdf in batches:
            texts, truth = pdf["text"].tolist(), pdf["lang"].map(number).to_numpy(np.int64)
            for s in chunks(texts):
                h, n = shipped.value.entropies(texts[s])
                some = n > 0
                total.update(shipped.value.evidence(h[some], n[some], truth[s][some]))
        if total:
            yield pd.DataFrame([(k, at, v) for (k, at), v in total.items()], columns=["k", "at", "v"])

    sums = work.keep(rows.select("lang", "text").mapInPandas(evidence, "k int, at long, v double").groupBy("k", "at").agg(F.sum("v").alias("v")), "evidence")
    heats = {r["at"]: r["v"] for r in sums.where("k < 0").collect()}
    if heats:
        models.heat = 2.0 ** max(sorted(heats), key=heats.get)
    # The bins of a language are bounded by its range of cross-entropies, so they are summed in order in one place.
    upto, whole = F.sum("v").over(Window.partitionBy("k").orderBy("at")), F.sum("v").over(Window.partitionBy("k"))
    bins = sums.where("k >= 0").select("k", "at", upto.alias("upto"), whole.alias("whole"))
    for r in bins.where(F.col("upto") >= F.lit(1 - tail) * F.col("whole")).groupBy("k").agg(F.min("at").alias("at")).collect():
        models.limits[r["k"]] = (r["at"] + 1) / BINS
    return models


def identify(docs: DataFrame, max_grams: int = 2_000_000, tail: float = 0.01) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, cross_entropy, rejected."""
    spark = docs.sparkSession
    learn = docs.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL").where(~held_out()).select("doc_id", "lang", "text")
    shipped = shipped_form(spark, train(learn, max_grams, tail))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = shipped.value
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            for s in chunks(texts):
                part = texts[s]
                out = pd.DataFrame({"doc_id": pdf["doc_id"].iloc[s].to_numpy(), "lang_pred": "und", "score": 0.0, "cross_entropy": np.nan, "rejected": True})
                if models.langs:
                    h, n = models.entropies(part)
                    best, some = h.argmin(axis=1), n > 0
                    low = h[np.arange(len(part)), best]
                    out["lang_pred"] = np.where(some, np.array(models.langs, object)[best], "und")
                    out["score"] = np.where(some, models.scores(h, n, models.heat).max(axis=1), 0.0)
                    out["cross_entropy"] = np.where(some, low, np.nan)
                    out["rejected"] = ~some | (low > models.limits[best])
                yield out

    found = as_long(as_text(docs.select("doc_id", "text")).mapInPandas(predict, OUT.replace("doc_id long", "doc_id string")))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
