"""Periodic runs of words, found in a Re-Pair grammar of each text.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and a length of at least
``max(12, 2 * q)`` that no neighbouring word extends. The word ids of a text are compressed by Re-Pair: the most frequent pair of
neighbouring symbols becomes a nonterminal, until no pair occurs twice. The boundary between the two halves of a nonterminal is looked
at once, in one of its copies: runs across it start from equal three-word pieces on its two sides and are measured by comparing the text
forwards and backwards. What is found holds at every position that the nonterminal derives. What is left of the text after the last
replacement is joined by a balanced tree, whose boundaries are treated alike. A run lies whole in the lowest node that holds it, across that
node's boundary; what other nodes see of it is a part, which the last step merges into the maximal interval.

A run of 12 words or more has 6 words that are equal to those a period later, so 3 of them lie on one side of the boundary: the three-word
pieces miss nothing. Work is about linear in the words of a text, times the logarithm for texts of few words.

One narrow pass over the documents; a text is held whole in one task.

Defined cases: null and empty texts have no words and no runs; a null id is never rewritten; rows that repeat are treated alike, each
for itself; an empty table gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 12

Run = tuple[int, int, int]  # start, end (exclusive), period


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a tenth of the documents, chosen by id, with a repetition written over their end."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    piece = words[a : a + p]
    return words[:a] + (piece * ((n - a) // p + 1))[: n - a]


def re_pair(ids: np.ndarray, groups: list[np.ndarray]) -> tuple[list[tuple[int, list[int]]], list[int]]:
    """The rules of a text as (words in the left half, all text positions they derive), words before parts; and the starts of what is left.

    ``groups``: the positions of each pair of neighbours that occurs more than once. All copies of a rule have one length, the
    start of the part after the rule's own, so a rule is (length of left half, length, positions).
    """
    n = len(ids)
    sym = ids.tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    length = [1] * (int(ids.max()) + 1 if n else 0)
    where = {(sym[g[0]], sym[g[0] + 1]): g.tolist() for g in groups}
    heap = [(-len(v), k) for k, v in where.items()]
    heapify(heap)
    rules = []
    while heap:
        count, pair = heappop(heap)
        a, b = pair
        at, used = [], -1
        for p in where.pop(pair):
            if sym[p] == a and p != used:
                q = after[p]
                if q < n and sym[q] == b:
                    at.append(p)
                    if a == b:
                        used = q
        if len(at) < 2:
            continue
        if len(at) < -count and heap and -heap[0][0] > len(at):
            where[pair] = at
            heappush(heap, (-len(at), pair))
            continue
        new, fresh = len(length), defaultdict(list)
        length.append(length[a] + length[b])
        rules.append((length[a], length[new], at))
        for p in at:
            q = after[p]
            r, left = after[q], before[p]
            sym[p], sym[q], after[p] = new, -1, r
            if r < n:
                before[r] = p
                fresh[new, sym[r]].append(p)
            if left >= 0:
                fresh[sym[left], new].append(left)
        for key, found in fresh.items():
            if len(found) > 1:
                found.sort()
                where[key] = found
                heappush(heap, (-len(found), key))
    starts, p = [], 0
    while p < n:
        starts.append(p)
        p = after[p]
    return rules, starts


class _Text:
    """Word ids of a text with the means to compare its parts."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.n = ids, len(ids)
        self.raw = ids.astype(np.int32).tobytes()
        base = int(ids.max()) + 1
        pair, self.pairs = _grouped(ids[:-1].astype(np.int64) * base + ids[1:])
        three, groups = _grouped(pair[:-1].astype(np.int64) * base + ids[2:])
        # Positions of each three-word piece that repeats, and the number of its group; -1 for the others.
        self.same = [g.tolist() for g in groups]
        self.group = np.full(self.n + 1, -1, np.int64)
        for k, g in enumerate(groups):
            self.group[g] = k

    def forwards(self, i: int, j: int, most: int) -> int:
        """How many words from ``i`` on equal those from ``j`` on."""
        raw, k, step = self.raw, 0, 8
        while k < most:
            w = min(step, most - k)
            if raw[4 * (i + k) : 4 * (i + k + w)] == raw[4 * (j + k) : 4 * (j + k + w)]:
                k += w
                step *= 2
            elif w == 1:
                return k
            else:
                most = k + w
                step = w // 2
        return k

    def backwards(self, i: int, j: int, most: int) -> int:
        """How many words before ``i`` equal those before ``j``."""
        raw, k, step = self.raw, 0, 8
        while k < most:
            w = min(step, most - k)
            if raw[4 * (i - k - w) : 4 * (i - k)] == raw[4 * (j - k - w) : 4 * (j - k)]:
                k += w
                step *= 2
            elif w == 1:
                return k
            else:
                most = k + w
                step = w // 2
        return k

    def _distances(self, at: int, low: int, high: int) -> list[int]:
        """How far from ``at`` its three-word piece occurs again between ``low`` and ``high``."""
        if at < low or at + 3 > high or self.group[at] < 0:
            return []
        same = self.same[self.group[at]]
        return [abs(p - at) for p in same[bisect_left(same, low) : bisect_right(same, high - 3)]]

    def across(self, low: int, cut: int, high: int) -> list[Run]:
        """Runs inside ``low`` .. ``high`` with words on both sides of ``cut``, as far as they reach there."""
        found: list[Run] = []
        for q in sorted({*self._distances(cut, low, high), *self._distances(cut - 3, low, high)}):
            if not 0 < q <= (high - low) // 2:
                continue
            need = max(MIN_WORDS, 2 * q)
            # Inside a run whose period divides q, q would give that run once more.
            known = [(start, end) for start, end, p in found if q % p == 0]
            if cut + q <= high and not any(cut + q <= end for _, end in known):
                ahead = self.forwards(cut, cut + q, high - cut - q)
                back = self.backwards(cut, cut + q, cut - low)
                if back and q + ahead + back >= need:
                    found.append((cut - back, cut + q + ahead, q))
            if cut - q >= low and not any(cut - q >= start for start, _ in known):
                ahead = self.forwards(cut, cut - q, high - cut)
                back = self.backwards(cut, cut - q, cut - q - low)
                if ahead and q + ahead + back >= need:
                    found.append((cut - q - back, cut + ahead, q))
        return found


def _grouped(codes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Small numbers for ``codes``, and the ascending positions of each code that occurs more than once."""
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    new = np.ones(len(codes), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(codes), np.int64)
    number[order] = np.cumsum(new) - 1
    starts = np.append(np.flatnonzero(new), len(codes))
    several = np.flatnonzero(np.diff(starts) > 1)
    return number, [order[starts[k] : starts[k + 1]] for k in several.tolist()]


def _merged(pieces: set[Run]) -> list[Run]:
    """Maximal intervals by start, then period; an interval counts for its smallest period."""
    out: dict[tuple[int, int], int] = {}
    at = None
    for start, end, q in sorted(pieces, key=lambda r: (r[2], r[0], -r[1])):
        if at is not None and at[1] == q and end <= at[0]:
            continue  # a part of the interval before
        at = (end, q)
        out.setdefault((start, end), q)
    return sorted(((s, e, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def find_runs(words: list[bytes]) -> list[Run]:
    """All runs of a text as (start, end, period), by start, then period."""
    n = len(words)
    if n < MIN_WORDS:
        return []
    number: dict[bytes, int] = {}
    text = _Text(np.array([number.setdefault(w, len(number)) for w in words], np.int64))
    rules, starts = re_pair(text.ids, text.pairs)
    pieces: set[Run] = set()
    for half, length, at in rules:
        if length >= MIN_WORDS:
            first = at[0]
            for start, end, q in text.across(first, first + half, first + length):
                pieces.update((start - first + p, end - first + p, q) for p in at)
    # The rest: boundary i of the balanced tree lies in a node of 2 ** (trailing zeros of i) symbols to each side.
    edge = np.array([*starts, n], np.int64)
    i = np.arange(1, len(starts), dtype=np.int64)
    reach = i & -i
    low, cut, high = edge[i - reach], edge[i], edge[np.minimum(i + reach, len(starts))]
    look = (high - low >= MIN_WORDS) & ((text.group[cut] >= 0) | ((cut >= 3) & (text.group[np.maximum(cut - 3, 0)] >= 0)))
    for a, b, c in zip(low[look].tolist(), cut[look].tolist(), high[look].tolist(), strict=True):
        pieces.update(text.across(a, b, c))
    return _merged(pieces)


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words outside all runs, and the first period of each run where no other run drops it."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, end, q in runs:
        drop[start + q] += 1
        drop[end] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]


_OUT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def periodic_runs(docs: DataFrame, plant: bool = False, runs_column: str | None = None) -> DataFrame:
    """One row per document: number of runs, the longest one, and digests of all runs and of the text without repetitions.

    ``plant`` first writes a repetition over the end of a tenth of the texts (``planted``). ``runs_column`` names a further
    column with all runs as (start, length, period).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, every = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = (text or b"").split()
                if plant:
                    words = planted(words, doc_id)
                runs = find_runs(words)
                best = max(((e - s, -s, -q) for s, e, q in runs), default=None)
                top = (None,) * 4 if best is None else (-best[1], best[0], -best[2], 1000 * best[0] // -best[2])
                listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
                digests = [hashlib.sha256(x).hexdigest() for x in (listed.encode(), b" ".join(collapsed(words, runs)))]
                out.append((doc_id, len(runs), *top, *digests))
                every.append([{"start": s, "length": e - s, "period": q} for s, e, q in runs])
            columns = list(zip(*out, strict=True)) or [()] * 8
            arrays = [pa.array(c, pa.string() if k > 5 else pa.int64()) for k, c in enumerate(columns)]
            names = [c.split()[0] for c in _OUT.split(", ")]
            if runs_column:
                arrays.append(pa.array(every, pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))))
                names.append(runs_column)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = _OUT + (f", `{runs_column}` array<struct<start: long, length: long, period: long>>" if runs_column else "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, schema)
