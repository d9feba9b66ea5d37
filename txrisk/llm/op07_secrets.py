"""Secrets by fixed patterns and by grammars inferred from labelled credentials.

The base patterns label what they match with its kind. From a bounded sample of these, per kind, a prefix tree over character
classes is built, and states whose outgoing frequencies agree within a Hoeffding bound are merged into a probabilistic automaton; one
more is built from ordinary long tokens. Every long token of every text outside the base spans is then scored: if its likelihood
under some credential grammar is far above that under the ordinary one, it is added as a span of kind ``format``.

At scale: texts are scanned once where they are read; their base spans and candidates are kept, and scored from there. The sample
of each label is that with the smallest hashes over all texts (each task keeps as many at most); only it reaches the driver.

Defined cases: a null text is empty and has no spans; offsets are code points, ends exclusive; repeated rows give repeated
results; without labelled credentials nothing is added; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import kept

# Fixed patterns. A match that is too short still takes its place in the text.
KINDS = ("assign", "access", "hex", "format")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # greedy runs, so the same as all runs and then those of 32 or more
_TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_ORDINARY = "ordinary"

# Digits and letters by class; other characters stand for themselves.
_CLASSES = str.maketrans(
    {**{chr(c): "9" for c in range(48, 58)}}
    | {c: "a" for c in "abcdef"}
    | {chr(c): "g" for c in range(ord("g"), ord("z") + 1)}
    | {c: "A" for c in "ABCDEF"}
    | {chr(c): "G" for c in range(ord("G"), ord("Z") + 1)}
)
_END = ""


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, credential) in order of start, then kind."""
    found = [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


class Grammar:
    """A probabilistic automaton from merged prefix-tree states."""

    FLOOR = math.log(1e-4)  # of a transition that the sample doesn't have

    def __init__(self, samples: list[str], alpha: float = 0.05):
        self.bound = math.sqrt(math.log(2 / alpha) / 2)
        self.counts: list[dict[str, int]] = [defaultdict(int)]
        self.next: list[dict[str, int]] = [{}]
        for sample in samples:
            state = 0
            for c in sample.translate(_CLASSES):
                self.counts[state][c] += 1
                if c not in self.next[state]:
                    self.next[state][c] = len(self.counts)
                    self.counts.append(defaultdict(int))
                    self.next.append({})
                state = self.next[state][c]
            self.counts[state][_END] += 1
        self._merge()
        self.log = [{c: math.log(n / sum(k.values())) for c, n in k.items()} for k in self.counts]

    def _agree(self, a: int, b: int) -> bool:
        """Whether frequencies of two states, and of all that follow, differ by chance at most."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            n, m = sum(self.counts[a].values()), sum(self.counts[b].values())
            limit = self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            for c in self.counts[a].keys() | self.counts[b].keys():
                if abs(self.counts[a].get(c, 0) / n - self.counts[b].get(c, 0) / m) > limit:
                    return False
            stack += [(t, self.next[b][c]) for c, t in self.next[a].items() if c in self.next[b] and t != self.next[b][c]]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add what the tree below ``b`` has seen to ``a``."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            for c, n in self.counts[b].items():
                self.counts[a][c] += n
            for c, t in self.next[b].items():
                if c in self.next[a]:
                    stack.append((self.next[a][c], t))
                else:
                    self.next[a][c] = t

    def _merge(self) -> None:
        kept_states = [0]
        while True:
            # The next tree state below the kept ones, the most frequent first.
            blue = [(-sum(self.counts[t].values()), s, c, t) for s in kept_states for c, t in self.next[s].items() if t not in kept_states]
            if not blue:
                return
            _, parent, c, state = min(blue)
            for other in kept_states:
                if self._agree(other, state):
                    self.next[parent][c] = other
                    self._fold(other, state)
                    break
            else:
                kept_states.append(state)

    def score(self, token: str) -> float:
        """Log likelihood of the token's classes and of its end."""
        state, total = 0, 0.0
        for c in [*token.translate(_CLASSES), _END]:
            total += self.log[state].get(c, self.FLOOR)
            state = self.next[state].get(c, state)
        return total


_SCANNED = "row int, doc_id long, n_assign long, n_access long, n_hex long, base string, starts array<int>, tokens array<string>, label string, hash long"


def _scan(docs: DataFrame, train_limit: int) -> DataFrame:
    """Row kind 0: a document with base spans and candidates; kind 1: a token for training with its label and hash."""
    names = [f.split()[0] for f in _SCANNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        smallest: dict[str, dict[str, int]] = defaultdict(dict)

        def offer(label: str, token: str) -> None:
            own = smallest[label]
            own[token] = xxhash.xxh64_intdigest(token) >> 1
            if len(own) >= 4 * train_limit:
                smallest[label] = dict(heapq.nsmallest(train_limit, own.items(), key=lambda x: (x[1], x[0])))

        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                kinds = [k for _, k, _, _ in base]
                starts, tokens = [], []
                for _, k, _, token in base:
                    offer(KINDS[k], token)
                for m in _TOKEN.finditer(text):
                    if not any(m.start() < end and start < m.end() for start, _, end, _ in base):
                        starts.append(m.start())
                        tokens.append(m[0])
                        offer(_ORDINARY, m[0])
                rows.append((*(kinds.count(k) for k in range(3)), ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in base), starts, tokens))
            n = len(rows)
            columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 6
            kinds_of = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.int32()), pa.list_(pa.string())]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds_of, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([0] * n, pa.int32()), batch.column(0), *arrays, pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())], names=names)
        for label, own in smallest.items():
            items = heapq.nsmallest(train_limit, own.items(), key=lambda x: (x[1], x[0]))
            n = len(items)
            nulls = [pa.nulls(n, pa.int64())] * 4 + [pa.nulls(n, pa.string()), pa.nulls(n, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([1] * n, pa.int32()), *nulls, pa.array([[t] for t, _ in items], pa.list_(pa.string())), pa.array([label] * n), pa.array([h for _, h in items], pa.int64())], names=names
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, _SCANNED)


def find_secrets(docs: DataFrame, train_limit: int = 400, min_ratio: float = math.log(1e3)) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_format of every document.

    ``train_limit`` bounds the sample of each label, ``min_ratio`` is the log likelihood ratio from which a token is added.
    """
    scanned = kept(_scan(docs, train_limit), "secrets")
    samples = scanned.where("row = 1").select("label", "hash", F.col("tokens")[0].alias("token")).distinct()
    drawn = {
        label: [r.token for r in samples.where(F.col("label") == label).orderBy("hash", "token").limit(train_limit).collect()]
        for label in (*KINDS[:3], _ORDINARY)
    }
    ordinary = Grammar(drawn.pop(_ORDINARY)) if drawn[_ORDINARY] else None
    grammars = [Grammar(tokens) for tokens in drawn.values() if tokens]

    def is_secret(token: str) -> bool:
        if not grammars:
            return False
        against = ordinary.score(token) if ordinary else len(token) * Grammar.FLOOR
        return max(g.score(token) for g in grammars) - against >= min_ratio

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, *counts, bases, starts, tokens = batch.columns
            base, spans, added = [], [], []
            for text, at, words in zip(bases.to_pylist(), starts.to_pylist(), tokens.to_pylist(), strict=True):
                base.append(hashlib.sha256(text.encode()).hexdigest())
                own = [f"format:{s}:{s + len(w)}" for s, w in zip(at, words, strict=True) if is_secret(w)]
                both = [*(text.split(",") if text else []), *own]
                spans.append(",".join(sorted(both, key=lambda s: (int(s.split(":")[1]), KINDS.index(s.split(":")[0])))))
                added.append(len(own))
            yield pa.RecordBatch.from_arrays(
                [doc_ids, *counts, pa.array(base, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format"],
            )

    rows = scanned.where("row = 0").select("doc_id", "n_assign", "n_access", "n_hex", "base", "starts", "tokens")
    return rows.mapInArrow(add, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long")
