"""Quality rules with line sequence labelling: a linear-chain conditional random field over lines.

Lines carry a handful of discrete signs (words, symbols, capitals, end of sentence, repeats, place). The
field has a weight for each sign and label and for each pair of neighbouring labels; Viterbi decoding marks
the lines of a document as content or boilerplate, and a document whose share of words in content lines is
below ``share`` is not kept. Base rules on repeated five-word windows and length come first.

Training: a sample of at most ``sample`` labelled documents, chosen by hash from all labels; lines of good
documents are content, lines of bad ones boilerplate. After a first fit the lines of bad documents that the
field takes for content are labelled anew (their worst line stays boilerplate) and the field is fitted again. Only
signs of the sample's lines, small integers, come to the driver. All documents are judged where they are read.

Nulls: a null text has no words and fails the base rules. Without labelled documents of both kinds every line
counts as content. Repeated label rows: the lowest quality counts; repeated documents are judged each.
Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.ids import as_long, as_text

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
MARKS = str.maketrans("", "", SYMBOLS + "!")
SIGNS = 9  # per line
LEVELS = 10  # values of a sign
OUT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"


def _level(x: float, steps: tuple[float, ...]) -> int:
    return sum(x >= s for s in steps)


def repeated_words(words: list[bytes]) -> int:
    """Words inside a five-word window that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(windows)) == len(windows):
        return 0
    count, end, total = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if count[w] > 1:
            total += i + 5 - max(i, end)
            end = i + 5
    return total


def line_signs(text: str) -> tuple[list[int], list[int], int]:
    """Signs of the lines with a word (SIGNS to a line, flat), their words, and the number of repeated lines."""
    lines = [(x, w) for x in text.split("\n") if (w := x.encode().split())]
    seen, signs, sizes, again = set(), [], [], 0
    for i, (line, words) in enumerate(lines):
        n, dup = len(words), line in seen
        again += dup
        seen.add(line)
        marks = (len(line) - len(line.translate(MARKS))) / n
        signs += (
            min(n.bit_length(), 9),
            _level(marks, (0.02, 0.1, 0.3, 0.6, 1.0)),
            int(line.isupper()),
            int(words[-1][-1:] in (b".", b"!", b"?", b":", b";")),
            int(dup),
            _level(len(set(words)) / n, (0.2, 0.4, 0.6, 0.8)),
            (i == 0) + 2 * (i == len(lines) - 1),
            _level(len(line) / n, (3, 4, 5, 6, 7, 8, 10, 14)),
            _level(line.count("|") / n, (0.05, 0.2, 0.4)),
        )
        sizes.append(n)
    return signs, sizes, again


def _scores(signs: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Lines x labels: sums of the weights of a line's signs."""
    return weights[np.arange(SIGNS), signs.reshape(-1, SIGNS)].sum(axis=1)


def viterbi(scores: list[tuple[float, float]], pair: list[list[float]]) -> list[int]:
    """Best labels (1 content, 0 boilerplate; content on ties) of one document's lines."""
    if not scores:
        return []
    (a, b), back = scores[0], []
    (t00, t01), (t10, t11) = pair
    for x, y in scores[1:]:
        from0, from1 = b + t10 >= a + t00, b + t11 >= a + t01
        a, b = x + (b + t10 if from0 else a + t00), y + (b + t11 if from1 else a + t01)
        back.append((from0, from1))
    label = int(b >= a)
    out = [label]
    for step in reversed(back):
        label = int(step[label])
        out.append(label)
    return out[::-1]


def fit(docs: list[np.ndarray], labels: list[np.ndarray], rounds: int = 150, rate: float = 0.2, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the signs and of label pairs that maximise the likelihood of whole label sequences."""
    order = sorted(range(len(docs)), key=lambda i: -len(labels[i]))
    docs, labels = [docs[i] for i in order], [labels[i] for i in order]
    n, lens = len(docs), np.array([len(x) for x in labels])
    live = [int((lens > t).sum()) for t in range(lens[0] if n else 0)]  # documents with a line t, the first ones
    starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
    flat, gold = np.concatenate(docs).reshape(-1, SIGNS), np.concatenate(labels)
    weights, pair = np.zeros((SIGNS, LEVELS, 2)), np.zeros((2, 2))
    size_w, size_p = np.zeros_like(weights), np.zeros_like(pair)
    true_pair = np.zeros((2, 2))
    for t in range(1, len(live)):
        at = starts[: live[t]] + t
        np.add.at(true_pair, (gold[at - 1], gold[at]), 1)
    for _ in range(rounds):
        e = _scores(flat, weights)
        forward, backward, part = np.zeros_like(e), np.zeros_like(e), np.zeros((2, 2))
        forward[starts] = e[starts]
        for t in range(1, len(live)):
            at = starts[: live[t]] + t
            forward[at] = np.logaddexp.reduce(forward[at - 1][:, :, None] + pair, axis=1) + e[at]
        z = np.logaddexp.reduce(forward[starts + lens - 1], axis=1)
        zs = np.repeat(z, lens)
        for t in range(len(live) - 1, 0, -1):
            at = starts[: live[t]] + t
            ahead = e[at] + backward[at]
            backward[at - 1] = np.logaddexp.reduce(pair + ahead[:, None, :], axis=2)
            part += np.exp(forward[at - 1][:, :, None] + pair + ahead[:, None, :] - z[: live[t], None, None]).sum(axis=0)
        miss = np.eye(2)[gold] - np.exp(forward + backward - zs[:, None])
        grad = np.zeros_like(weights)
        for k in range(SIGNS):
            np.add.at(grad[k], flat[:, k], miss)
        grad, grad_p = grad / n - decay * weights, (true_pair - part) / n - decay * pair
        size_w, size_p = size_w + grad**2, size_p + grad_p**2
        weights, pair = weights + rate * grad / (np.sqrt(size_w) + 1e-9), pair + rate * grad_p / (np.sqrt(size_p) + 1e-9)
    return weights, pair


def train(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray]:
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    halves = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2) for q in (0, 1)]
    quality = {r.doc_id: r.quality for r in halves[0].unionByName(halves[1]).collect()}
    none = np.zeros((SIGNS, LEVELS, 2)), np.zeros((2, 2))
    if len(set(quality.values())) < 2:
        return none

    def signs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "signs": [line_signs(t)[0] for t in pdf["text"]]})

    picked = docs.where(F.col("doc_id").isin(list(quality)) & F.col("text").isNotNull()).select("doc_id", "text")
    rows = picked.mapInPandas(signs, "doc_id long, signs array<int>").groupBy("doc_id").agg(F.min("signs").alias("signs")).where("size(signs) > 0").orderBy("doc_id").collect()
    x = [np.array(r.signs) for r in rows]
    y = [np.full(len(r.signs) // SIGNS, quality[r.doc_id]) for r in rows]
    if len({int(v[0]) for v in y}) < 2:
        return none
    weights, pair = fit(x, y)
    for i, (a, b) in enumerate(zip(x, y)):
        if not b[0]:
            e = _scores(a, weights)
            found = np.array(viterbi([tuple(s) for s in e], pair.tolist()))
            found[np.argmin(e[:, 1] - e[:, 0])] = 0
            y[i] = found
    return fit(x, y)


def judge(docs: DataFrame, labels: DataFrame, share: float = 0.5, sample: int = 4000) -> DataFrame:
    """Per document the base features, base_failed, kept and content_share (of words; null without words)."""
    weights, pair = train(docs, labels, sample)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist()):
                text = text or ""
                words = text.encode().split()
                n, repeated = len(words), repeated_words(words)
                signs, sizes, again = line_signs(text)
                marks = viterbi(_scores(np.array(signs, int), weights).tolist(), pair.tolist()) if sizes else []
                good = sum(s for s, m in zip(sizes, marks) if m) / n if n else None
                failed = n < 10 or 100 * repeated > 20 * n
                chars = len(text) - sum(text.count(c) for c in SPACES)
                out.append((doc_id, n, chars, sum(text.count(c) for c in SYMBOLS), again, repeated, failed, not failed and good >= share, good))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])

    return as_long(as_text(docs.select("doc_id", "text")).mapInPandas(rows, OUT.replace("doc_id long", "doc_id string")))
