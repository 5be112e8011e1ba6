"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (hashed), a window of words the
average of its words' embeddings, and a softmax layer on it separates the
classes; embeddings and layer are trained jointly in numpy.  A document is as
toxic as its worst window, in training (the worst window carries the label) and
in scoring, so a few bad words in a long text count.  Misspelled words share
most of their n-grams with the words seen in training.

After training, each n-gram's share of a logit is one number, and that table
(BUCKETS floats) is all that tasks need.

Cases: null and empty texts, and texts without words, score by the bias alone.
Without labels of both classes every score is the share of label 1.  Every row
gives one row, repeated ones too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.labelled import fold, labelled_texts, logistic, probability, with_scores

WORD = re.compile(r"[^\W_]+")
BUCKETS, DIMS = 1 << 17, 16
GRAMS = (3, 4, 5)
WINDOW, STRIDE = 24, 12
#: Words whose logit shares a task keeps.
CACHE_WORDS = 400_000
#: Words whose n-grams are made at a time.
PART_WORDS = 16_384


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket ids of all n-grams of ``<word>``, and the offsets at which each word's begin.

    Every word has at least one n-gram: with its brackets it has three characters.
    """
    if len(words) > PART_WORDS:  # the same, with room for one part's arrays only
        parts = [grams(words[i : i + PART_WORDS]) for i in range(0, len(words), PART_WORDS)]
        before = np.cumsum([0] + [len(ids) for ids, _ in parts[:-1]])
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([offsets + b for (_, offsets), b in zip(parts, before, strict=True)])
    chars = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words])
    ends = np.cumsum(lengths)
    room = np.repeat(ends, lengths) - np.arange(len(chars))
    owner = np.repeat(np.arange(len(words)), lengths)
    ids, owners, h = [], [], np.zeros(len(chars), dtype=np.uint64)
    for n in range(1, max(GRAMS) + 1):
        shifted = np.zeros_like(chars)
        shifted[: max(0, len(chars) - n + 1)] = chars[n - 1 :]
        h = h * np.uint64(0x100000001B3) + shifted + np.uint64(n)
        if n in GRAMS:
            whole = room >= n
            mixed = (h[whole] ^ (h[whole] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            ids.append((mixed >> np.uint64(64 - 17)).astype(np.int32))
            owners.append(owner[whole])
    ids, owners = np.concatenate(ids), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return ids[order], np.searchsorted(owners[order], np.arange(len(words)))


def windows(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the windows over ``n`` words; together they cover all."""
    starts = np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE)
    return starts, np.minimum(starts + WINDOW, n)


def window_means(values: np.ndarray) -> np.ndarray:
    if not len(values):
        return np.zeros(1)
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    starts, ends = windows(len(values))
    return (sums[ends] - sums[starts]) / (ends - starts)


def _word_shares(ids: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    sizes = np.diff(np.append(offsets, len(ids)))
    return np.add.reduceat(table[ids], offsets) / sizes


def _log_odds(docs: list[np.ndarray], ids: np.ndarray, offsets: np.ndarray, y: np.ndarray, learn: np.ndarray, prior: float = 2.0) -> np.ndarray:
    """Smoothed log odds that a document with this n-gram has label 1."""
    with_gram, total = np.zeros((2, BUCKETS)), np.bincount(y[learn], minlength=2)[:2]
    ends = np.append(offsets[1:], len(ids))
    for d in learn:
        words = np.unique(docs[d])
        with_gram[y[d], np.unique(np.concatenate([ids[offsets[w] : ends[w]] for w in words]))] += 1
    rate = (with_gram + prior) / (total[:, None] + 2 * prior)
    both = np.log(rate[1] / rate[0]) - np.log((prior / (total[1] + 2 * prior)) / (prior / (total[0] + 2 * prior)))
    return both.astype(np.float32)


def train(texts: list[str], y: np.ndarray, share: float, epochs: int = 8, rate: float = 0.1, floor: float = 1e-8, batch: int = 64, seed: int = 7) -> dict:
    """The model: ``table`` (each n-gram's share of the logit), ``bias``, and the calibration."""
    rng = np.random.default_rng(seed)
    if len(set(y.tolist())) < 2:
        return {"table": np.zeros(BUCKETS, dtype=np.float32), "bias": 0.0, "line": logistic(np.zeros(len(y)), y, share)}
    number: dict[str, int] = {}
    docs = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], dtype=np.int64) for t in texts]
    usable = np.array([len(d) > 0 for d in docs])
    ids, offsets = grams(list(number))
    sizes = np.diff(np.append(offsets, len(ids)))
    held = rng.random(len(docs)) < 0.2
    learn = np.flatnonzero(usable & ~held)
    # Both layers start on one axis, n-grams at their documents' log odds: the first worst windows are then worth learning from.
    axis = np.full(DIMS, DIMS**-0.5, dtype=np.float32)
    vectors = rng.normal(0, 0.02, (BUCKETS, DIMS)).astype(np.float32) + _log_odds(docs, ids, offsets, y, learn)[:, None] * axis
    layer, bias = np.stack([-axis, axis]), np.zeros(2, dtype=np.float32)
    seen_v, seen_l, seen_b = np.full(BUCKETS, floor, dtype=np.float32), np.full((2, DIMS), 1e-3), np.full(2, 1e-3)
    balance = np.array([1.0, (y[learn] == 0).sum() / max(1, (y[learn] == 1).sum())])
    for epoch in range(epochs):
        shares = _word_shares(ids, offsets, vectors @ (layer[1] - layer[0]))
        chosen, target = [], []
        for d in learn:
            starts, ends = windows(len(docs[d]))
            worst, chance = int(np.argmax(window_means(shares[docs[d]]))), int(rng.integers(len(starts)))
            for at in {worst} if y[d] else {worst, chance}:
                chosen.append(docs[d][starts[at] : ends[at]])
                target.append(y[d])
        target = np.array(target)
        order = rng.permutation(len(chosen))
        step = rate * (1 - epoch / epochs)
        for lo in range(0, len(order), batch):
            pick = order[lo : lo + batch]
            tokens = np.concatenate([chosen[i] for i in pick])
            lengths = np.array([len(chosen[i]) for i in pick])
            of_window = np.repeat(np.arange(len(pick)), lengths)
            n = sizes[tokens]
            spot = np.repeat(offsets[tokens] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            gram, of_token = ids[spot], np.repeat(np.arange(len(tokens)), n)
            weight = (1 / (n[of_token] * lengths[of_window[of_token]])).astype(np.float32)
            row = of_window[of_token]
            starts = np.searchsorted(row, np.arange(len(pick)))
            hidden = np.add.reduceat(vectors[gram] * weight[:, None], starts, axis=0)
            z = hidden @ layer.T + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            t = target[pick]
            p[np.arange(len(pick)), t] -= 1
            p *= balance[t][:, None] / len(pick)
            d_layer, d_bias, d_hidden = p.T @ hidden, p.sum(axis=0), p @ layer
            uniq, where = np.unique(gram, return_inverse=True)
            d_v = np.zeros((len(uniq), DIMS), dtype=np.float32)
            grad = d_hidden.astype(np.float32)[row] * weight[:, None]
            for k in range(DIMS):
                d_v[:, k] = np.bincount(where, weights=grad[:, k], minlength=len(uniq))
            seen_v[uniq] += (d_v**2).mean(axis=1)
            vectors[uniq] -= step * d_v / np.sqrt(seen_v[uniq])[:, None]
            seen_l += d_layer**2
            layer -= (step * d_layer / np.sqrt(seen_l)).astype(np.float32)
            seen_b += d_bias**2
            bias -= (step * d_bias / np.sqrt(seen_b)).astype(np.float32)
    table, offset = (vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0])
    shares = _word_shares(ids, offsets, table)
    check = np.flatnonzero(held) if len(set(y[held].tolist())) == 2 else np.arange(len(docs))
    x = np.array([window_means(shares[docs[d]]).max() for d in check]) + offset
    return {"table": table, "bias": offset, "line": logistic(x, y[check], share)}


def scorer(model: dict):
    """A function from a batch of texts to their scores, with a bounded cache of word shares."""
    cache: dict[str, float] = {}

    def score(texts: pd.Series) -> np.ndarray:
        x = np.empty(len(texts))
        for i, text in enumerate(texts):
            words = words_of(text)
            new = [w for w in set(words) if w not in cache]
            if new:
                if len(cache) + len(new) > CACHE_WORDS:
                    cache.clear()
                    new = list(set(words))
                cache.update(zip(new, _word_shares(*grams(new), model["table"]).tolist(), strict=True))
            values = np.fromiter(map(cache.__getitem__, words), dtype=np.float64, count=len(words))
            x[i] = window_means(values).max() + model["bias"]
        return probability(x, *model["line"])

    return score


def fit(texts: DataFrame, share: float) -> dict:
    """:func:`train` on the bounded sample ``texts`` (doc_id, text, y) in a task, by doc_id; only the model comes to the driver."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc_id", ignore_index=True)
        model = train(part["text"].tolist(), part["y"].to_numpy(int), share)
        return pd.DataFrame({"shares": [model["table"].tobytes()], "bias": [model["bias"]], "line": [list(model["line"])]})

    fitted = texts.groupBy(F.lit(0).alias("one")).applyInPandas(run, "shares binary, bias double, line array<double>").first()
    if fitted is None:  # nothing to learn from
        return train([], np.zeros(0, dtype=int), share)
    return {"table": np.frombuffer(fitted["shares"], dtype=np.float32), "bias": fitted["bias"], "line": tuple(fitted["line"])}


def score_toxicity(docs: DataFrame, labelled: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0) -> DataFrame:
    """``docs`` with held_out, score and predicted.

    ``labelled`` holds the texts that ``labels`` (doc_id, toxic) speak of; rows
    of fold ``held_fold`` are never learned from.
    """
    model = fit(*labelled_texts(labelled, labels, "toxic", fold(F.col("doc_id"), folds) != held_fold))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats, whatever the table's size

    @F.pandas_udf("double")
    def toxicity(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = scorer(shared.value)
        for texts in parts:
            yield pd.Series(score(texts))

    return with_scores(docs, fold(F.col("doc_id"), folds) == held_fold, toxicity(F.col("text")))
