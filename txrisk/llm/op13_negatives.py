"""Hard negatives by threshold joins over inverted indexes whose lists leave out what norms already bound.

Each anchor wants the best rows of its own label, and for each of those a window of scores in which the best rows of other labels are wanted.
Both are threshold joins: all rows with a score of at least t, t high at first and lowered for the windows that aren't full until they are,
or until t has reached their lower end.

One join. A task indexes its rows in chunks, dimension by dimension, those of greatest weight first. A row's entry is left out of the
lists from the dimension on at which the norm of the rest of the row, times that of any anchor of the block, stays below t: such a rest
alone cannot reach t. The lists of the indexed dimensions add up partial scores; a pair goes when its partial score and the product of both remaining
norms stay below t; what is left is completed from the rows. Blocks of dimensions stand for single ones, and the rows of a list are a range of the
chunk, so the sums are products of matrices.

At scale: rows stay where Spark reads them and are never shuffled. Anchors, a table in the shared folder, stream through every task block by
block, so neither grows with the other in memory. A chunk gives at most the wanted number of rows for each window of an anchor, however
many tie. Nothing reaches the driver but the greatest norm and whether windows are still open.

Scores are sums of integers in doubles: exact up to 2 ** 53.

Defined cases: rows without id, label or vector, or with a component that is null or not finite take no part; shorter vectors count as
filled up with zeros; rows that repeat an id are rows of their own, and an anchor that repeats gives its result again; an anchor's own id is never its positive;
a negative positive score makes an empty window; equal scores go by the smaller id; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import full_uri, kept, new_path

CHUNK, BLOCK, DIMS = 32_768, 256, 8  # rows of one index, anchors of one block, dimensions of one list
FIRST = (0.6, 0.3, None)  # thresholds of the search for positives, as shares of the greatest possible score; None: all rows
LATER = (1 / 16, 1 / 4, 1.0)  # how far into a window the search for negatives goes
_FOUND = "anchor long, slot int, id long, score double"


def _matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Lists of numbers as rows, short ones filled up with zeros; ``width`` columns at least."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(sizes.max(initial=0)))
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _rest(vectors: np.ndarray) -> np.ndarray:
    """For each row the norms of what is left from each dimension on, and 0 at the end."""
    out = np.zeros((len(vectors), vectors.shape[1] + 1))
    out[:, :-1] = np.sqrt(np.cumsum(vectors[:, ::-1] ** 2, 1)[:, ::-1])
    return out


class Index:
    """The rows of one chunk, dimensions of greatest weight first."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.order = np.argsort(-(vectors**2).sum(0), kind="stable")
        self.ids, self.labels, self.vectors = ids, labels, np.ascontiguousarray(vectors[:, self.order])
        self.rest = _rest(self.vectors)

    def above(self, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs (anchor, row) with a score of at least ``least`` of the anchor, and the scores."""
        anchors = np.ascontiguousarray(anchors[:, self.order])
        d, rest = anchors.shape[1], _rest(anchors)
        # Scores are integers: half of one is room for rounding in the norms.
        least = least - 0.5
        # Where each row's entries end in the lists, in whole blocks of dimensions.
        covered = self.rest * rest.max(0) < least.min()
        covered[:, -1] = True
        ends = np.minimum(-(-covered.argmax(1) // DIMS) * DIMS, d)
        rows = np.argsort(-ends, kind="stable")
        ends, vectors = ends[rows], self.vectors[rows]
        partial = np.zeros((len(anchors), len(rows)))
        for j in range(0, d, DIMS):
            listed = int(np.searchsorted(-ends, -j))  # rows with an end after j come first
            if not listed:
                break
            partial[:, :listed] += anchors[:, j : j + DIMS] @ vectors[:listed, j : j + DIMS].T
        found = []
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(ends)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if low == high:
                continue
            end, sums = int(ends[low]), partial[:, low:high]
            while True:
                open_ = sums + rest[:, end, None] * self.rest[rows[low:high], end] >= least[:, None]
                if end >= d or np.count_nonzero(open_) * 8 < open_.size:
                    break
                sums = sums + anchors[:, end : end + DIMS] @ vectors[low:high, end : end + DIMS].T
                end = min(end + DIMS, d)
            a, r = np.nonzero(open_)
            scores = sums[a, r]
            for at in range(0, len(a) if end < d else 0, 65_536):
                part = slice(at, at + 65_536)
                scores[part] += np.einsum("ij,ij->i", anchors[a[part], end:], vectors[low + r[part], end:])
            found.append((a, rows[low + r], scores))
        a, r, scores = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 3
        keep = scores >= least[a]
        return a[keep], r[keep], scores[keep]


def _best(index: Index, batch: pa.RecordBatch, same_label: bool, wanted: int) -> pa.RecordBatch:
    """(anchor, slot, id, score): for every window of the anchors the first ``wanted`` rows of the chunk."""
    width = index.vectors.shape[1]
    anchors = _matrix(batch.column("vector"), width)
    if anchors.shape[1] > width:
        # Dimensions that no row of the chunk has add nothing.
        anchors = anchors[:, :width]
    windows = batch.column("windows")
    of = np.repeat(np.arange(batch.num_rows), np.diff(windows.offsets.to_numpy()))
    slot, low, high = (windows.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(3))
    least = np.full(batch.num_rows, np.inf)
    np.minimum.at(least, of, low)
    a, r, scores = index.above(anchors, least)
    labels, ids = batch.column("label").to_numpy(zero_copy_only=False), batch.column("id").to_numpy(zero_copy_only=False)
    if same_label:
        keep = (index.labels[r] == labels[a]) & (index.ids[r] != ids[a])
    else:
        keep = index.labels[r] != labels[a]
    a, r, scores = a[keep], r[keep], scores[keep]
    order = np.lexsort((index.ids[r], -scores, a))
    a, r, scores = a[order], r[order], scores[order]
    out = []
    numbers = batch.column("anchor").to_numpy(zero_copy_only=False)
    # Windows of one anchor by turns, so each turn has at most one of every anchor.
    turn = np.arange(len(of)) - np.searchsorted(of, of)
    for k in range(int(turn.max(initial=-1)) + 1):
        own = np.flatnonzero(turn == k)
        lo, hi, named = np.full(batch.num_rows, np.inf), np.full(batch.num_rows, -np.inf), np.zeros(batch.num_rows, np.int32)
        lo[of[own]], hi[of[own]], named[of[own]] = low[own], high[own], slot[own]
        inside = np.flatnonzero((scores >= lo[a]) & (scores <= hi[a]))
        mine = a[inside]
        first = inside[np.arange(len(mine)) - np.searchsorted(mine, mine) < wanted]
        out.append((numbers[a[first]], named[a[first]], index.ids[r[first]], scores[first]))
    columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0)] * 4
    types = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["anchor", "slot", "id", "score"])


def _join(rows: DataFrame, anchors: DataFrame, same_label: bool, wanted: int) -> DataFrame:
    """One threshold join; ``anchors``: anchor, id, label, vector, windows (slot, low, high). Best first, at most ``wanted`` for a window."""
    path = new_path(rows.sparkSession, "anchors")
    anchors.select("anchor", "id", "label", "vector", "windows").write.parquet(path)
    uri = full_uri(path)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= CHUNK:
                yield pa.Table.from_batches(held)
                held, n = [], 0
        if n:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            index = Index(*(chunk.column(k).to_numpy() for k in range(2)), _matrix(chunk.column(2)))
            system, folder = fs.FileSystem.from_uri(uri)
            for batch in ds.dataset(folder, filesystem=system, format="parquet").to_batches(batch_size=BLOCK):
                if batch.num_rows:
                    yield _best(index, batch, same_label, wanted)

    found = rows.select("id", "label", "vector").mapInArrow(run, _FOUND)
    place = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= wanted)


def _until_full(rows: DataFrame, anchors: DataFrame, windows: DataFrame, levels: list, same_label: bool, wanted: int) -> DataFrame:
    """(anchor, slot, id, score, rank) for ``windows`` (anchor, slot, low, high, further columns that ``levels`` need).

    ``levels`` are columns of thresholds, falling to the lower end of the window. Only windows that aren't full go on to the next.
    """
    done = []
    for k, level in enumerate(levels):
        lists = windows.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", level.alias("low"), "high"))).alias("windows"))
        found = kept(_join(rows, anchors.join(lists, "anchor"), same_label, wanted), "negatives")
        if k == len(levels) - 1:
            done.append(found)
            break
        full = found.where(F.col("rank") == wanted).select("anchor", "slot")
        done.append(found.join(full, ["anchor", "slot"], "left_semi"))
        windows = kept(windows.join(full, ["anchor", "slot"], "left_anti"), "open")
        if windows.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def usable(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", scale: float = 256) -> DataFrame:
    """id, label, vector of the rows that take part, components scaled and floored."""
    vector = F.col(vector_column).cast("array<double>")
    out = rows.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"), vector.alias("vector"))
    number = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    out = out.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & number)
    whole = float(2**52)  # from here on doubles are whole numbers, and the long integers of floor() end

    def floor(x: Column) -> Column:
        y = x * F.lit(float(scale))
        return F.when(F.abs(y) < whole, F.floor(y).cast("double")).otherwise(y)

    return out.withColumn("vector", F.transform("vector", floor))


def hard_negatives(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: id, label, vector (``usable``). Anchors are rows whose id is divisible by ``every``; the negatives of a positive are the first
    rows of other labels with a score of ``low`` to ``high`` percent of the positive's.
    """
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    greatest = rows.agg(F.max(norm)).first()[0] or 0.0
    anchors = kept(rows.where(F.col("id") % every == 0).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    ends = {"low": float("-inf"), "high": float("inf")}
    whole = anchors.select("anchor", F.lit(0).alias("slot"), *(F.lit(v).alias(k) for k, v in ends.items()), norm.alias("norm"))
    levels = [F.col("low") if share is None else F.lit(share * greatest) * F.col("norm") for share in FIRST]
    best = kept(_until_full(rows, anchors, whole, levels, True, positives), "positives")
    # Scores are integers, and so are the ends: 100 * negative from low * positive to high * positive.
    score = best.where("score >= 0").withColumn("score", F.col("score").cast("long"))
    windows = score.select("anchor", F.col("rank").alias("slot"), F.expr(f"double(({low} * score + 99) div 100)").alias("low"), F.expr(f"double({high} * score div 100)").alias("high"))
    windows = kept(windows.where("low <= high"), "windows")
    levels = [F.greatest("low", F.col("high") - (F.col("high") - F.col("low")) * share) if share < 1 else F.col("low") for share in LATER]
    found = _until_full(rows, anchors, windows, levels, False, negatives)
    named = best.select("anchor", F.col("rank").alias("slot"), F.col("id").alias("positive_id"), F.col("score").cast("long").alias("positive_score"))
    named = named.join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
    return found.join(named, ["anchor", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").cast("long").alias("negative_score")
    )
