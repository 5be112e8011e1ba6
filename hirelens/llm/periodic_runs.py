"""Periodic runs in word sequences: block convolution at dyadic scales.

A run is a stretch of words with smallest period q that repeats at least four
times and can't be extended.  For periods q in [B, 2B), B a power of two, every
run holds an aligned block of B words, and that block occurs again q words later
within the run.  So at each scale the text is cut into blocks of B words, and the
squared differences of a block and every place of its following window of 2B - 1
words are computed at once by a number-theoretic transform: where they sum to
zero, the block occurs without a mismatch, and the distance is a seed.  Seeds are
extended word by word to both sides, so what is reported is exact.

The transform is exact integer arithmetic modulo two primes.  Words are numbered
densely per batch, so the sum of squared differences stays below their product
for any batch of less than a million different words and blocks up to half a
million words; beyond that the extension still checks every seed.

Blocks that can't occur in their window (one of their words doesn't) and blocks
deep inside a run of a shorter period (every distance would be a multiple of that
period) are left out before the transform; neither can give a new run.

A document is one row's work and needs no shuffle.  Documents are handled in
slices of a bounded number of characters, so memory doesn't grow with the table;
one longer text makes a slice of its own.

Cases: null and empty texts have no words, no runs and the hash of the empty
string.  Every row gives one row, repeated ones too.  A row without doc_id keeps
its words as they are (there is nothing to plant by).  An empty table gives an
empty result.  Only doc_id and text are read; other columns don't matter.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Primes 15 * 2**27 + 1 and 7 * 2**26 + 1 with a primitive root each.
PRIMES = ((2013265921, 31), (469762049, 3))
MIN_LENGTH, MIN_EXPONENT = 6, 4
SLICE_CHARS = 4_000_000
#: Elements of a transform done at a time.
ELEMENTS = 1 << 18

SCHEMA = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def _powers(root: int, n: int, p: int) -> np.ndarray:
    """root**0 .. root**(n-1) modulo p, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(root, len(out), p)) % np.uint64(p)])
    return out[:n]


def transform(x: np.ndarray, p: int, g: int) -> np.ndarray:
    """Number-theoretic transform of each row (a power of two long), in bit-reversed order."""
    m, n = x.shape
    prime, size = np.uint64(p), n
    while size > 1:
        w = _powers(pow(g, (p - 1) // size, p), size // 2, p)
        x = x.reshape(m, n // size, 2, size // 2)
        a, b = x[:, :, 0], x[:, :, 1]
        x = np.stack([(a + b) % prime, (a + (prime - b)) % prime * w % prime], axis=2)
        size //= 2
    return x.reshape(m, n)


def inverse(x: np.ndarray, p: int, g: int) -> np.ndarray:
    """Inverse of :func:`transform`."""
    m, n = x.shape
    prime, size = np.uint64(p), 2
    while size <= n:
        w = _powers(pow(pow(g, (p - 1) // size, p), p - 2, p), size // 2, p)
        x = x.reshape(m, n // size, 2, size // 2)
        a, b = x[:, :, 0], x[:, :, 1] * w % prime
        x = np.stack([(a + b) % prime, (a + (prime - b)) % prime], axis=2)
        size *= 2
    return x.reshape(m, n) * np.uint64(pow(n, p - 2, p)) % prime


def zero_mismatch(ids: np.ndarray, squares: list[np.ndarray], at: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) of all occurrences of the blocks of ``b`` words at ``at`` within distances [b, 2b).

    ``ids`` must reach 3b words beyond the last block; ``squares`` holds prefix
    sums of the squared ids modulo each prime.
    """
    starts, distances = [], []
    step = max(1, ELEMENTS // (2 * b))
    for lo in range(0, len(at), step):
        x = at[lo : lo + step]
        block = ids[x[:, None] + np.arange(b)].astype(np.uint64)
        window = ids[x[:, None] + b + np.arange(2 * b - 1)].astype(np.uint64)
        zero = np.ones((len(x), b), dtype=bool)
        for (p, g), s in zip(PRIMES, squares, strict=True):
            prime = np.uint64(p)
            f = np.zeros((len(x), 2 * b), dtype=np.uint64)
            w = np.zeros((len(x), 2 * b), dtype=np.uint64)
            f[:, :b], w[:, : 2 * b - 1] = block[:, ::-1] % prime, window % prime
            # A reversed block makes the product a correlation; what wraps around falls on the first b - 2 places.
            products = inverse(transform(f, p, g) * transform(w, p, g) % prime, p, g)[:, b - 1 : 2 * b - 1]
            own = s[x + b] - s[x]
            there = s[x[:, None] + 2 * b + np.arange(b)] - s[x[:, None] + b + np.arange(b)]
            zero &= (own[:, None] + there) % p == (2 * products.astype(np.int64)) % p
        row, off = np.nonzero(zero)
        starts.append(x[row])
        distances.append(off + b)
    return (np.concatenate(starts), np.concatenate(distances)) if starts else (np.empty(0, np.int64), np.empty(0, np.int64))


def _agree(ids: np.ndarray, i: int, j: int, step: int) -> int:
    """How many places from i and j on (towards ``step``) hold equal words."""
    n, chunk = 0, 32
    while True:
        if step > 0:
            c = min(chunk, len(ids) - max(i, j))
            same = ids[i : i + c] == ids[j : j + c]
        else:
            c = min(chunk, min(i, j) + 1)
            same = ids[i - c + 1 : i + 1][::-1] == ids[j - c + 1 : j + 1][::-1]
        if c <= 0:
            return n
        if not same.all():
            return n + int(np.argmin(same))
        n, i, j, chunk = n + c, i + step * c, j + step * c, chunk * 2


class _Places:
    """Where each word occurs: sorted (word, place) pairs as single numbers."""

    def __init__(self, ids: np.ndarray):
        self.n = len(ids) + 1
        order = np.argsort(ids, kind="stable")
        self.pairs = ids[order] * self.n + order
        self.count = np.bincount(ids)

    def within(self, ids: np.ndarray, at: np.ndarray, near: int, far: int) -> np.ndarray:
        """Does the word at each place of ``at`` occur again at a distance in [near, far)?"""
        base = ids[at] * self.n + at
        k = np.searchsorted(self.pairs, base + near)
        return np.where(k < len(self.pairs), self.pairs[np.minimum(k, len(self.pairs) - 1)] < base + far, False)


def find_runs(ids: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of ``ids`` whose length is at most ``longest``.

    ``ids`` are dense numbers; documents in one array must share no number.
    """
    n = len(ids)
    if longest < MIN_LENGTH or n < MIN_LENGTH:
        return []
    top = 1
    while 8 * top <= longest:
        top *= 2
    fresh = int(ids.max()) + 1
    padded = np.concatenate([ids, fresh + np.arange(4 * top)]).astype(np.int64)
    squares = [np.concatenate([[0], np.cumsum(padded % p * (padded % p) % p)]) for p, _ in PRIMES]
    places = _Places(ids)
    often = places.count >= MIN_EXPONENT
    reach = np.zeros(n, dtype=np.int64)
    runs: list[tuple[int, int, int]] = []
    b = 1
    while MIN_EXPONENT * b <= longest:
        at = np.arange(0, max(0, n - 3 * b), b)
        at = at[often[ids[at]] & (reach[at] < at + 3 * b)]
        for off in dict.fromkeys((0, b - 1, b // 2)):
            at = at[places.within(ids, at + off, b, 2 * b)]
        step = max(1, ELEMENTS // b)
        at = np.concatenate([at[:0]] + [
            c[places.within(ids, (c[:, None] + np.arange(b)).ravel(), b, 2 * b).reshape(len(c), b).all(axis=1)]
            for c in (at[i : i + step] for i in range(0, len(at), step))])
        x, d = zero_mismatch(padded, squares, at, b)
        # The first block of a run meets its first word three times more; and a region within a shorter period's run is that run's.
        ok = (x + 3 * d < n) & (reach[x] < x + b + d)
        x, d = x[ok], d[ok]
        ok = (ids[x] == ids[x + 2 * d]) & (ids[x] == ids[x + 3 * d])
        x, d = x[ok], d[ok]
        found, seen, until = [], 0, 0
        for k in np.lexsort((x, d)).tolist():
            start, q = int(x[k]), int(d[k])
            if q == seen and start + b + q <= until:
                continue
            right = _agree(ids, start, start + q, 1)
            left = _agree(ids, start - 1, start + q - 1, -1) if start else 0
            seen, until = q, start + right + q
            length = left + right + q
            if length >= max(MIN_LENGTH, MIN_EXPONENT * q):
                found.append((start - left, length, q))
        for s, length, _ in found:
            np.maximum(reach[s : s + length], s + length, out=reach[s : s + length])
        runs += found
        b *= 2
    return sorted(runs, key=lambda r: (r[0], r[2]))


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(first place, period) of the repetition that the contract plants in some documents."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def slice_rows(ids: list, texts: pa.Array, plant: bool) -> dict[str, list]:
    """Results of some documents."""
    trimmed = pc.ascii_trim(pc.fill_null(texts, ""), characters=" \t\n\x0b\x0c\r")
    words = pc.ascii_split_whitespace(trimmed)
    empty = pc.equal(pc.binary_length(trimmed), 0).to_numpy(zero_copy_only=False)
    sizes = np.where(empty, 0, pc.list_value_length(words).to_numpy(zero_copy_only=False))
    flat = words.filter(pa.array(~empty)).flatten()
    ends = np.cumsum(sizes)
    begins = ends - sizes
    total = int(sizes.sum())
    take = np.arange(total, dtype=np.int64)
    if plant:
        for i, doc in enumerate(ids):
            if (spot := planted(doc, int(sizes[i]))) is not None:
                a, p = spot
                tail = np.arange(int(sizes[i]) - a)
                take[begins[i] + a : ends[i]] = begins[i] + a + tail % p
    keep = np.ones(total, dtype=bool)
    of_doc: dict[int, list[tuple[int, int, int]]] = {}
    if total:
        code = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[take]
        doc = np.repeat(np.arange(len(ids)), sizes)
        dense = np.unique(doc * (int(code.max()) + 1) + code, return_inverse=True)[1]
        for s, length, q in find_runs(dense, int(sizes.max())):
            of_doc.setdefault(int(doc[s]), []).append((s - int(begins[doc[s]]), length, q))
            keep[s + q : s + length] = False
        kept = np.add.reduceat(np.append(keep, False).astype(np.int64), np.minimum(begins, total)) * (sizes > 0)
        flat = flat.take(pa.array(take[keep]))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(kept)]), pa.int32()), flat)
        collapsed = pc.binary_join(lists, " ").cast(pa.binary()).to_pylist()
    else:
        collapsed = [b""] * len(ids)
    out: dict[str, list] = {k.split()[0]: [] for k in SCHEMA.split(", ")}
    for i, doc_id in enumerate(ids):
        runs = of_doc.get(i, [])
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None, None, None)
        out["doc_id"].append(doc_id)
        out["n_words"].append(int(sizes[i]))
        out["n_runs"].append(len(runs))
        out["start"].append(best[0])
        out["length"].append(best[1])
        out["period"].append(best[2])
        out["exponent_milli"].append(1000 * best[1] // best[2] if runs else None)
        out["runs_sha256"].append(_sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()))
        out["collapsed_sha256"].append(_sha(collapsed[i]))
    return out


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    lo, chars = 0, 0
    for i, c in enumerate(sizes.tolist()):
        if i > lo and chars + c > SLICE_CHARS:
            yield lo, i
            lo, chars = i, 0
        chars += c
    if len(sizes) > lo:
        yield lo, len(sizes)


def periodic_runs(docs: DataFrame, plant: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its runs and the hash of what is left without their repeats.

    ``plant`` writes a repetition into the documents that the contract names; without it texts are taken as they are.
    """
    fields = [f.split() for f in SCHEMA.split(", ")]
    schema = pa.schema([(name, pa.int64() if kind == "long" else pa.string()) for name, kind in fields])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            for lo, hi in _slices(sizes):
                part = slice_rows(batch.column(0)[lo:hi].to_pylist(), texts[lo:hi], plant)
                yield pa.RecordBatch.from_pydict(part, schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(rows, SCHEMA)
