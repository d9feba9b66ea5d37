"""Exact BM25 top k by block-max pruning over an inverted index in shards.

Every partition of the documents becomes one or more shards of at most ``shard_text`` characters (or one longer text): an index file with the
postings of its documents in order of term. Statistics (number and mean length of documents, documents per term) are global. In a shard, the
terms of more than one in ``WIDE`` documents also have a dense matrix of impacts and its maxima over blocks of ``BLOCK`` documents. A query adds up
the postings of its narrow terms, and bounds each block by the block maxima of its wide terms; blocks below the k-th best score of the
shards before are left out. In the others a product with the matrix bounds each document, and what reaches the k-th best
is scored in full precision, term by term in the same order everywhere. The best k of all tasks are merged; as weights are global, the result is exact.

At scale: postings are never shuffled, only (term, documents) counts of each shard and the best k of each query and task. A task
holds a block of at most ``query_rows`` queries and goes through its group of shards, one at a time, so its memory depends on neither the table
nor its partitions; there are as many groups as the cluster has cores twice, whatever the number of shards, so the candidates grow with the queries.
Queries from the corpus grow with it, so the work of that use grows with the square of the corpus.

Defined cases: terms are lower-case runs between white space; a query without known terms has no results; documents without terms
are never found; equal scores are in order of doc_id, null last; repeated rows are found each; an empty table gives no rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import kept, new_path
from txrisk.llm.files import read_file, write_file

BLOCK, K1, B = 64, 0.9, 0.4
POSTINGS = 1 << 18
WIDE = 16  # a term in more than one of so many documents of a shard is wide
QUERY_TERMS = 1 << 21  # of a block of queries


def terms_of(text: str) -> np.ndarray:
    """64-bit hashes of the terms of a text, in order."""
    own = text.lower().encode("utf-8", "surrogatepass").split()
    return (np.fromiter(map(xxhash.xxh64_intdigest, own), np.uint64, len(own)) >> np.uint64(1)).astype(np.int64)


def _save(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _counted(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The distinct terms of each text and how often it has them."""
    found = (np.unique(terms_of(t), return_counts=True) for t in texts)
    return [(term, count.astype(np.int32)) for term, count in found]


def _index(doc_ids: list[int | None], found: list[tuple[np.ndarray, np.ndarray]]) -> dict[str, np.ndarray]:
    """Postings (document, frequency) by term; terms are sorted, and documents within a term."""
    lengths = np.array([count.sum() for _, count in found], np.int64)
    term = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
    order = np.argsort(term, kind="stable")
    term = term[order]
    first = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
    names, first = term[first], np.append(first, len(term))
    doc = np.repeat(np.arange(len(found), dtype=np.int32), [len(f[0]) for f in found])[order]
    count = (np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int32))[order]
    ids = np.array([d if d is not None else np.iinfo(np.int64).max for d in doc_ids], np.int64)
    return {"terms": names, "first": first, "doc": doc, "count": count, "lengths": lengths, "ids": ids}


def _shards(batches: Iterator[pa.RecordBatch], shard_text: int) -> Iterator[dict[str, np.ndarray]]:
    """The indexes of the documents (doc_id, text) of a task; texts go as soon as their terms are counted."""
    ids, found, size = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if ids and size + len(text) > shard_text:
                    yield _index(ids, found)
                    ids, found, size = [], [], 0
                ids.append(doc_id)
                found += _counted([text])
                size += len(text)
    if ids:
        yield _index(ids, found)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The numbers of all ranges lo .. hi - 1, one range after the other."""
    size = hi - lo
    return np.repeat(lo - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


def _portions(size: np.ndarray) -> Iterator[slice]:
    """Neighbours with at most ``POSTINGS`` postings together, one at least."""
    total, at = np.cumsum(size), 0
    while at < len(size):
        end = max(at + 1, int(np.searchsorted(total, POSTINGS + (total[at - 1] if at else 0), "right")))
        yield slice(at, end)
        at = end


Best = tuple[np.ndarray, np.ndarray]  # scores and ids, the best first


class Shard:
    def __init__(self, data: bytes, mean_length: float):
        with np.load(io.BytesIO(data)) as a:
            self.terms, self.first, self.doc, count, lengths, self.ids = (a[k] for k in ("terms", "first", "doc", "count", "lengths", "ids"))
        # In place where it can be: a shard has millions of postings.
        self.impact = count.astype(float)
        del count
        whole = (K1 * (1 - B + B * lengths / mean_length))[self.doc]
        whole += self.impact
        self.impact *= K1 + 1
        self.impact /= whole
        del whole
        n, df = len(lengths), np.diff(self.first)
        self.blocks = -(-n // BLOCK)
        # Postings by document, in order of term, for scores in full precision.
        order = np.argsort(self.doc.astype(np.uint16) if n <= 1 << 16 else self.doc, kind="stable")
        self.term_of, self.impact_of = np.repeat(np.arange(len(df), dtype=np.int32), df)[order], self.impact[order]
        del order
        # Wide terms have their impacts by document, in at most four numbers for each posting of the shard, and the greatest by block.
        wide = np.argsort(-df, kind="stable")[: 4 * len(self.doc) // max(1, self.blocks * BLOCK)]
        wide = np.sort(wide[df[wide] * WIDE > n])
        self.wide = np.full(len(df), -1, np.int32)
        self.wide[wide] = np.arange(len(wide))
        self.dense = np.zeros((len(wide), self.blocks, BLOCK), np.float32)
        for own, lo, hi in zip(self.dense.reshape(len(wide), self.blocks * BLOCK), self.first[wide], self.first[wide + 1], strict=True):
            own[self.doc[lo:hi]] = self.impact[lo:hi]
        self.most = self.dense.max(2) if self.blocks else np.zeros((len(wide), 0), np.float32)
        # What a sum in single precision may be too low or too high by.
        self.slack = 1 + (len(wide) + 4) * 2.0**-23 + 1e-9
        self.doc_first = np.append(0, np.cumsum(np.bincount(self.doc, minlength=n)))
        self.weight = np.zeros(len(df))

    def add(self, queries: list[tuple[np.ndarray, np.ndarray]], found: list[Best], k: int) -> None:
        """Put the documents here among the k best ``found`` so far for each query (terms, weights)."""
        step = max(1, min(64, (1 << 21) // max(1, self.blocks * BLOCK)))
        for at in range(0, len(queries), step):
            found[at : at + step] = self._best(queries[at : at + step], found[at : at + step], k)

    def _best(self, queries: list[tuple[np.ndarray, np.ndarray]], found: list[Best], k: int) -> list[Best]:
        least = np.array([scores[-1] if len(scores) == k else 0.0 for scores, _ in found])
        total = np.zeros((len(queries), self.blocks, BLOCK), np.float32)
        heavy = np.zeros((len(queries), len(self.dense)), np.float32)
        known = []
        for i, (terms, weights) in enumerate(queries):
            at = np.searchsorted(self.terms, terms)
            here = at < len(self.terms)
            here[here] = self.terms[at[here]] == terms[here]
            at, weights = at[here], weights[here]
            known.append((at, weights))
            number = self.wide[at]
            narrow = number < 0
            heavy[i, number[~narrow]] = weights[~narrow]
            lo, hi, weights = self.first[at[narrow]], self.first[at[narrow] + 1], weights[narrow]
            sums = np.zeros(self.blocks * BLOCK)
            for part in _portions(hi - lo):
                post = _ranges(lo[part], hi[part])
                sums += np.bincount(self.doc[post], np.repeat(weights[part], hi[part] - lo[part]) * self.impact[post], len(sums))
            total[i] = sums.reshape(self.blocks, BLOCK)
        # Blocks that no query can find better documents in are left out.
        bound = (heavy @ self.most + total.max(2)) * self.slack if self.blocks else total.sum(2)
        open_ = np.flatnonzero(((bound >= least[:, None]) & (bound > 0)).any(0))
        if not len(open_):
            return found
        dense = self.dense
        if len(open_) < self.blocks:
            total, dense = total[:, open_], dense[:, open_]
        total = total.reshape(len(queries), len(open_) * BLOCK)
        total += heavy @ dense.reshape(len(dense), len(open_) * BLOCK)
        out = []
        for own, (at, weights), before, low in zip(total, known, found, least.tolist(), strict=True):
            if len(own) > k:
                low = max(low, float(np.partition(own, -k)[-k]) * (2 - self.slack))
            chosen = np.flatnonzero((own * self.slack >= low) & (own > 0))
            out.append(self._scored(open_[chosen // BLOCK] * BLOCK + chosen % BLOCK, at, weights, before, low, k))
        return out

    def _scored(self, docs: np.ndarray, at: np.ndarray, weights: np.ndarray, found: Best, least: float, k: int) -> Best:
        """``found`` with those of ``docs`` that belong there; equal scores in order of id."""
        self.weight[at] = weights
        scores, ids = found
        size = self.doc_first[docs + 1] - self.doc_first[docs]
        for part in _portions(size):
            own = docs[part]
            post = _ranges(self.doc_first[own], self.doc_first[own + 1])
            score = np.bincount(np.repeat(np.arange(len(own)), size[part]), self.weight[self.term_of[post]] * self.impact_of[post])
            some = np.flatnonzero((score >= least) & (score > 0))
            scores, ids = np.concatenate([scores, score[some]]), np.concatenate([ids, self.ids[own[some]]])
            best = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[best], ids[best]
            least = max(least, float(scores[-1])) if len(scores) == k else least
        self.weight[at] = 0
        return scores, ids


def search(docs: DataFrame, queries: DataFrame, k: int = 10, query_rows: int = 4096, shard_text: int = 1 << 24) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents for each (query_id, text) of ``queries``."""
    spark, folder = docs.sparkSession, new_path(docs.sparkSession, "search")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index in _shards(batches, shard_text):
            path = write_file(folder, ".npz", _save(**index))
            head = [pa.array([path]), pa.array([0]), pa.array([len(index["ids"])]), pa.array([int(index["lengths"].sum())])]
            yield pa.RecordBatch.from_arrays(head, names=["path", "term", "n", "length"])
            df = np.diff(index["first"])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(df), pa.string()), pa.array(index["terms"]), pa.array(df), pa.nulls(len(df), pa.int64())], names=["path", "term", "n", "length"])

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    built = kept(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(build, "path string, term long, n long, length long"), "index")
    shards = built.where("path is not null")
    total = shards.agg(F.sum("n").alias("n"), F.sum("length").alias("length")).first()
    schema = "query_id long, doc_id long, score double"
    if not total.n or not total.length:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    n, mean = total.n, total.length / total.n

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                terms, count = np.unique(terms_of(own), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([query] * len(terms), pa.int64()), pa.array(terms), pa.array(count)], names=["query_id", "term", "count"])

    asked = queries.select(F.col("query_id").cast("long").alias("query_id"), text).mapInArrow(split, "query_id long, term long, count long")
    df = built.where("path is null").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.col("count") * F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    asked = kept(asked.join(df, "term").groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", weight.alias("weight")))).alias("terms")), "asked")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, at = batch.column(1).value_lengths().to_numpy(), 0
            while at < batch.num_rows:
                rows = max(1, int(np.searchsorted(np.cumsum(size[at : at + query_rows]), QUERY_TERMS, "right")))
                part = batch.slice(at, rows)
                at += part.num_rows
                flat = part.column(1).flatten()
                cut = np.append(0, np.cumsum(part.column(1).value_lengths().to_numpy()))
                path = write_file(folder, ".npz", _save(ids=np.array(part.column(0).to_pylist(), np.int64), cut=cut, terms=flat.field(0).to_numpy(), weights=flat.field(1).to_numpy()))
                yield pa.RecordBatch.from_pydict({"asked": [path]})

    blocks = kept(asked.coalesce(max(1, -(-asked.count() // query_rows))).mapInArrow(save, "asked string"), "queries")
    # Names only: there is one for a block of queries and one for a shard.
    names = spark.sparkContext.broadcast([r.asked for r in blocks.collect()])
    groups = max(1, min(2 * spark.sparkContext.defaultParallelism, shards.count()))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = [path for batch in batches for path in batch.column(0).to_pylist()]
        for asked_path in names.value:
            dealt = [paths[g::groups] for g in range(groups) if paths[g::groups]]
            yield pa.RecordBatch.from_arrays([pa.array([asked_path] * len(dealt), pa.string()), pa.array(dealt, pa.list_(pa.string()))], names=["asked", "paths"])

    pairs = shards.select("path").coalesce(1).mapInArrow(meet, "asked string, paths array<string>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for asked_path, paths in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with np.load(io.BytesIO(read_file(asked_path))) as a:
                    ids, cut, terms, weights = (a[x] for x in ("ids", "cut", "terms", "weights"))
                asked = [(terms[lo:hi], weights[lo:hi]) for lo, hi in zip(cut, cut[1:], strict=False)]
                found = [(np.zeros(0), np.zeros(0, np.int64))] * len(asked)
                for path in paths:
                    Shard(read_file(path), mean).add(asked, found, k)  # one shard at a time
                query = np.repeat(ids, [len(scores) for scores, _ in found])
                scores, docs = (np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(list(zip(*found, strict=True)) or [(), ()], (float, np.int64), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(docs), pa.array(scores)], names=["query_id", "doc_id", "score"])

    size = max(1, min(4096, groups * len(names.value)))
    best = pairs.repartition(size).mapInArrow(run, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    best = best.withColumn("rank", rank).where(F.col("rank") <= k)
    no_id = F.lit((1 << 63) - 1)  # stands for a null id in the index
    return best.select("query_id", "rank", F.nullif("doc_id", no_id).alias("doc_id"), "score")
