"""N-gram Jaccard join over an R-tree of count vectors.

Each text is the set of its word shingles. Shingles are hashed into groups, and the counts per group make a text a point whose coordinates
add up to the size of its set. The overlap of two sets is at most the sum of the smaller coordinate in each group; with the greatest
coordinates of a node in place of a point's, the same sum bounds whole nodes. A pair is linked only if the bound reaches the overlap
that the threshold asks for: ``percent / (100 + percent)`` of both sizes.

The tree, from its root down:

1. Space is first cut by single coordinates of the finest grid, one shingle each. Two linked sets of which the larger has n shingles share at
   least ``percent`` % of n, so their first n - that + 1 coordinates, in any order common to all sets, have one with a minimum above 0: a
   node per coordinate holds the points that have it among those. Rare coordinates come first, by a histogram of all shingles
   whose cells grow with the documents, so a passage that a third of all texts share is in nobody's first coordinates but its own copies'.
   Of a node of few points, those stay that have another one of a size, and with enough left of both after their places of the coordinate, to be linked.
2. A node of many unlike points is cut again by a second such coordinate: linked sets share two among their first n - that + 2.
3. Below, points are packed in order of size and leading coordinates, ``FAN`` to a node, and pairs of nodes are followed from the root as
   long as their bound allows, down to pairs of points. What survives on a coarse grid is packed once more on a fine one.

What survives is verified on the full sets. Links join components; a first run over the coordinates with the smallest hashes, which near copies
share whatever was changed in them, finds most of them, and the full run leaves out nodes, at every level of the tree, whose points are all of
one component. No link between different sets is lost: every bound is a true upper bound.

At scale: equal sets are one point from the start. Nodes are dealt in blocks of ``leaf`` points; where all but few points of a
node are of one component, only these few meet every block. Groups are linear in their points, no pair is written, and links leave as
spanning forests. Only points of a group are fetched while their numbers can be sent to every executor. The driver gets the histogram
(``MOST_CELLS`` bytes at most), a bit map of nodes (2 ** ``MOST_BITS`` bits at most) and counts.

Defined cases: null and empty texts, and texts of white space, are empty sets and linked with nothing; a text with fewer words than a
shingle is one shingle; rows without id stay alone and without component; rows that repeat an id are documents of their own; an empty
table gives no rows; texts are read whole; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import KEYS, kept, settled, small
from txrisk.llm.components import components, smallest_linked
from txrisk.llm.op06_near_dedup import _LOWER, _M2, _dealt, _groups, _joined, _links, _mix, _sid

CELLS = 1 << 16
MOST_CELLS = 1 << 22
SLICE = 1 << 12  # cells whose counts are a row
MOST_BITS = 28
FAN = 8
WIDTH = 64  # groups of a small set
FEW_POINTS = 64  # of a node in which each point is held against the others
_PAIR_BYTES = 1 << 23
_NODE_ROWS = "node long, vid long, comp long, size int, place int"


def shingles_of(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles of some texts, one text after the other, and where each text starts; A-Z count as a-z."""
    own = [text.encode("utf-8", "surrogatepass").translate(_LOWER).split() for text in texts]
    n = np.array([len(w) for w in own], np.int64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(own)), np.uint64, n.sum())
    k = np.minimum(n, words)
    many = np.where(n > 0, n - k + 1, 0)
    starts = np.append(0, np.cumsum(many))
    # The first word of each shingle; shingles of short texts are added up apart.
    at = np.arange(starts[-1]) + np.repeat(np.cumsum(n) - n - starts[:-1], many)
    total = np.repeat(k, many).astype(np.uint64)
    short = np.flatnonzero(total < words)
    for j in range(words):
        if j == 0 or not len(short):
            total = _mix(total ^ hashed[at + j if j else at]) * _M2
        else:
            own_k = np.repeat(k, many)
            part = np.flatnonzero(own_k > j)
            total[part] = _mix(total[part] ^ hashed[at[part] + j]) * _M2
    return total, starts


def sets_of(texts: list[str], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    done = 0
    while done < len(texts):
        # About a megabyte of text at a time.
        end, size = done, 0
        while end < len(texts) and size < 1 << 20:
            size += len(texts[end])
            end += 1
        total, starts = shingles_of(texts[done:end], words)
        for lo, hi in zip(starts.tolist(), starts[1:].tolist(), strict=False):
            part = np.sort(total[lo:hi])
            yield part[np.append(True, part[1:] != part[:-1])] if hi - lo > 1 else part
        done = end


def _width(n: int, fine: bool) -> int:
    """Groups of a set of ``n`` shingles, a power of two: one for one or two shingles; on the fine grid two to four for each."""
    return max(WIDTH, 2 << n.bit_length() if fine else 1 << n.bit_length() >> 1)


def group_counts(shingles: np.ndarray) -> np.ndarray:
    """The point of a set on the fine grid, in the smallest type that holds its coordinates."""
    bits = _width(len(shingles), True).bit_length() - 1
    return _least_type(np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits))


def _least_type(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.uint8 if counts.max() < 1 << 8 else np.uint16 if counts.max() < 1 << 16 else np.uint32)


def on_grid(counts: np.ndarray, width: int) -> np.ndarray:
    """A point with its coordinates added up to ``width`` of them."""
    return counts if len(counts) == width else counts.reshape(width, -1).sum(1, dtype=np.uint32)


def first_coordinates(shingles: np.ndarray, level: np.ndarray, percent: int) -> np.ndarray:
    """The coordinates under which a set is found, rare ones first, and one more if there is one."""
    n = len(shingles)
    most = n - -(-n * percent // 100) + 2
    rank = level[shingles & np.uint64(len(level) - 1)].astype(np.uint64) << np.uint64(56) | shingles >> np.uint64(8)
    return shingles[np.argsort(rank, kind="stable")[:most]]


def _cells(documents: int) -> int:
    """Cells of the histogram, a power of two that grows with the documents: in a full cell a frequent shingle doesn't stand out."""
    return min(max(CELLS, 1 << (4 * documents).bit_length()), MOST_CELLS)


def _levels(docs: DataFrame, words: int) -> np.ndarray:
    """How frequent the shingles of each cell are, in steps of a quarter power of two."""
    cells = _cells(docs.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, np.uint32)
        for batch in batches:
            for own in sets_of(batch.column(0).to_pylist(), words):
                np.add.at(counts, (own & np.uint64(cells - 1)).astype(np.int64), np.uint32(1))
        parts = counts.reshape(-1, SLICE)
        some = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([_least_type(parts[k]).tobytes() for k in some], pa.binary())], names=["part", "counts"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(raw, f"u{len(raw) // SLICE}").astype(np.int64)
        level = [np.floor(4 * np.log2(own + 1)).astype(np.uint8).tobytes() for own in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(level, pa.binary())], names=["part", "level"])

    sums = docs.select("text").mapInArrow(run, "part long, counts binary").repartition("part").mapInArrow(added, "part long, level binary")
    level = np.zeros((cells // SLICE, SLICE), np.uint8)
    for part, own in sums.collect():
        level[part] = np.frombuffer(own, np.uint8)
    return level.reshape(-1)


def _points(docs: DataFrame, words: int, percent: int, level: np.ndarray, few: int) -> DataFrame:
    """doc_id, n (size of the set), sid (128 bits that name the set; null for an empty one), some (``few`` coordinates), firsts, and counts (the point on the fine
    grid)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, rest = [], []
            for own in sets_of(batch.column(1).to_pylist(), words):
                n.append(len(own))
                if not len(own):
                    rest.append((None,) * 4)
                    continue
                fine = group_counts(own)
                rest.append((_sid(own), *(x.tobytes() for x in (own[:few], first_coordinates(own, level, percent), fine))))
            columns = [pa.array(c, pa.binary()) for c in zip(*rest, strict=True)] if rest else [pa.array([], pa.binary())] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *columns], names=["doc_id", "n", "sid", "some", "firsts", "counts"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, sid binary, some binary, firsts binary, counts binary")


def _coarse(points: DataFrame) -> DataFrame:
    """(vid, n, counts) with the points on the coarse grid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for n, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                fine = np.frombuffer(raw, f"u{len(raw) // _width(n, True)}")
                made.append(_least_type(on_grid(fine, _width(n, False))).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary())], names=["vid", "n", "counts"])

    return points.select("vid", "n", "counts").mapInArrow(run, "vid long, n long, counts binary")


def _distinct(every: DataFrame) -> DataFrame:
    """One row of ``every`` (of different vid) for each set, that of the smallest doc_id. Only names and numbers are shuffled, unless very many repeat a set."""
    rows = every.where("doc_id is not null and sid is not null")
    best = rows.groupBy(F.col("sid").alias("of_sid")).agg(F.min(F.struct("doc_id", "vid")).alias("best"), F.count("*").alias("k")).where("k > 1")
    names = rows.select("sid", "vid").join(best, F.col("sid") == F.col("of_sid"))
    again = kept(names.where(F.col("vid") != F.col("best.vid")).select("vid"), "repeated-sets")
    return rows.join(small(again, KEYS), "vid", "left_anti")


def _need(n: np.ndarray, percent: int) -> np.ndarray:
    """The overlap that a set of ``n`` has with every set of at most its size that it is linked with."""
    return -(-n * percent // 100)


def _bit_map(nodes: DataFrame) -> np.ndarray:
    """64 bits a word, some of them set for ``nodes``, a kept table: 32 to 64 bits for each node, or 2 ** ``MOST_BITS`` in all.

    The order of coordinates goes by their lowest and highest bits, so these are no guide here.
    """
    size = 1 << min(max((32 * nodes.count()).bit_length(), 16), MOST_BITS)
    bit = F.shiftright("node", 24).bitwiseAND(F.lit(size - 1))
    words = nodes.select(F.shiftright(bit, 6).alias("word"), bit.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    found = words.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toArrow()
    out = np.zeros(size >> 6, np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint64)
    return out


def _in_map(words: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Which nodes may be those of the bit map: all of them, and few others."""
    bit = node.astype(np.uint64) >> np.uint64(24) & np.uint64(64 * len(words) - 1)
    return (words[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def _rows_in_map(rows: DataFrame, words: np.ndarray) -> DataFrame:
    """The rows (node, vid, comp, size, place) of nodes in the bit map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_in_map(words, batch.column(0).to_numpy(zero_copy_only=False))))

    return rows.select("node", "vid", "comp", "size", "place").mapInArrow(run, _NODE_ROWS)


def _under(points: DataFrame, coordinates: str, percent: int, words: np.ndarray | None = None) -> DataFrame:
    """(node, vid, comp, size, place): each point in the nodes of its ``coordinates``, the column ``some`` or ``firsts``; size is that of its set, and
    ``place`` of its coordinates come before the node's. With ``words``, only nodes in that bit map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy(zero_copy_only=False)
            raw = batch.column(3).to_pylist()
            size = np.array([len(f) // 8 for f in raw], np.int64)
            # A further one of the first coordinates is only for nodes that are cut again.
            use = np.minimum(n - _need(n, percent) + 1, size) if coordinates == "firsts" else size
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            node = np.frombuffer(b"".join(raw), np.int64)
            keep = np.flatnonzero(place < np.repeat(use, size))
            if words is not None:
                keep = keep[_in_map(words, node[keep])]
            of = pa.array(np.repeat(np.arange(len(n)), size)[keep])
            node = node[keep]
            columns = [pa.array(node), batch.column(0).take(of), batch.column(1).take(of), batch.column(2).take(of).cast(pa.int32()), pa.array(place[keep].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "vid", "comp", "size", "place"])

    return points.select("vid", "comp", "n", coordinates).mapInArrow(run, _NODE_ROWS)


def _under_second(rows: DataFrame, points: DataFrame) -> DataFrame:
    """(node, vid, comp, size, place): the points of nodes that are cut again, by each coordinate that follows the node's own; place is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, of = [], []
            for i, (node, raw) in enumerate(zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                firsts = np.frombuffer(raw, np.int64)
                after = firsts[int(np.flatnonzero(firsts == node)[0]) + 1 :]
                nodes.append(_mix(_mix(after.astype(np.uint64)) ^ np.uint64(node % (1 << 64))).astype(np.int64))
                of += [i] * len(after)
            at = pa.array(of, pa.int64())
            columns = [pa.array(np.concatenate(nodes) if nodes else np.zeros(0, np.int64)), *(batch.column(c).take(at) for c in (1, 2, 4)), pa.array(np.zeros(len(of), np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "vid", "comp", "size", "place"])

    of_rows = rows.join(points.select("vid", "firsts", F.col("n").cast("int").alias("size")), "vid")
    return of_rows.select("node", "vid", "comp", "firsts", "size").mapInArrow(run, _NODE_ROWS)


def _with_partner(rows: DataFrame, percent: int) -> DataFrame:
    """(node, vid, comp, n, alike): the points that may be linked with another one of their node, n and alike without the others.

    The first coordinate that two sets share has no shared one before it, so their overlap is at most what is left of either from there.
    Linked sets have that bound in the node of that coordinate.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches):
            node, vid, comp, size, place = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(5))
            rest = size - place
            near, keep = np.arange(len(node)), np.zeros(len(node), bool)
            for d in range(1, len(node)):
                # Nodes are contiguous: rows whose node ended stay out.
                near = near[near < len(node) - d]
                near = near[node[near] == node[near + d]]
                if not len(near):
                    break
                a = near[comp[near] != comp[near + d]]
                a = a[(100 + percent) * np.minimum(rest[a], rest[a + d]) >= percent * (size[a] + size[a + d])]
                keep[a] = keep[a + d] = True
            node, vid, comp = node[keep], vid[keep], comp[keep]
            if not len(node):
                continue
            starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            many = np.diff(np.append(starts, len(node)))
            alike = np.bitwise_xor.reduceat(_mix(_mix(vid.astype(np.uint64)) * _M2), starts).astype(np.int64)
            columns = [node, vid, comp, np.repeat(many, many), np.repeat(alike, many)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "vid", "comp", "n", "alike"])

    ordered = rows.select("node", "vid", "comp", "size", "place").repartition("node").sortWithinPartitions("node")
    return ordered.mapInArrow(run, "node long, vid long, comp long, n long, alike long")


def _open_nodes(rows: DataFrame, percent: int, again: Callable[[np.ndarray], DataFrame] | None = None) -> DataFrame:
    """(node, vid, comp, n, alike) of the nodes with points of several components; n is the number of points, alike names the set of them.

    In nodes of at most ``FEW_POINTS`` points, those that cannot be linked with another one are left out. ``again`` makes the rows of nodes in a bit map
    anew: most rows are alone in their node, and none of them is shuffled but for its name.
    """
    spark, at = rows.sparkSession, F.col("node") == F.col("of_node")
    ends = rows.groupBy("node").agg(F.count("*").alias("n"), (F.min("comp") != F.max("comp")).alias("open"))
    names = settled(spark, "node-names", lambda: ends.where((F.col("n") > FEW_POINTS) | F.col("open")))
    words = _bit_map(names.where("open"))
    rows = kept(again(words) if again else _rows_in_map(rows, words), "node-rows")
    many = small(kept(names.where(F.col("n") > FEW_POINTS).withColumnRenamed("node", "of_node"), "large-nodes"))
    large = kept(rows.join(many.where("open"), at).select("node", "vid", "comp", "n"), "large-node-rows")
    alike = kept(large.groupBy(F.col("node").alias("of_node")).agg(F.bit_xor(F.xxhash64("vid")).alias("alike")), "alike")
    large = large.join(alike, at).select("node", "vid", "comp", "n", "alike")
    return kept(large.unionByName(_with_partner(rows.join(many, at, "left_anti"), percent)), "open-nodes")


def _blocks(rows: DataFrame, leaf: int, complete: bool) -> DataFrame:
    """(grp, vid, comp): open nodes as groups of at most 2 * ``leaf`` points; nodes of the same points are one."""
    one = rows.select(F.xxhash64("n", "alike").alias("node"), F.col("vid").alias("sid"), "comp", "n").distinct()
    return _dealt(one, leaf, complete).withColumnRenamed("sid", "vid")


def _some_groups(points: DataFrame, percent: int, leaf: int) -> DataFrame:
    """(grp, vid, comp): points that share one of ``some`` coordinates, large nodes dealt at random."""
    under = partial(_under, points, "some", percent)
    return _blocks(_open_nodes(under(), percent, under), leaf, False)


def _all_groups(points: DataFrame, percent: int, leaf: int) -> DataFrame:
    """(grp, vid, comp): the groups in which points are compared; every linked pair of two components shares one."""
    under = partial(_under, points, "firsts", percent)
    rows = _open_nodes(under(), percent, under)
    large = rows.where(F.col("n") > leaf)
    counts = large.groupBy("node", "n", "comp").agg(F.count("*").alias("k"))
    others = counts.groupBy(F.col("node").alias("of_node")).agg((F.max("n") - F.max("k")).alias("others"))
    cut = others.where(F.col("others") > leaf).select("of_node")
    cut = kept(cut, "cut-nodes")
    again = _open_nodes(_under_second(large.join(cut, F.col("node") == F.col("of_node"), "left_semi"), points), percent)
    whole = rows.join(cut, F.col("node") == F.col("of_node"), "left_anti")
    return _blocks(whole.unionByName(again), leaf, True)


class _Tree:
    """Points packed into nodes, level by level; level 0 are the points. Each group is a tree of its own."""

    def __init__(self, group: np.ndarray, comp: np.ndarray, n: np.ndarray, points: np.ndarray):
        # Neighbours in a node are alike in size and in their coarse coordinates.
        coarse = points.reshape(len(points), 8, -1).sum(2, dtype=np.int64)
        self.order = np.lexsort((*(coarse[:, k] for k in range(7, -1, -1)), n, group))
        self.levels = [self._level(group[self.order], n[self.order], n[self.order], comp[self.order], points[self.order])]
        while len(np.unique(group := self.levels[-1]["group"])) < len(group):
            below = self.levels[-1]
            place = np.arange(len(group)) - np.searchsorted(group, group)
            starts = np.flatnonzero(place % FAN == 0)
            comps = below["comp"]
            one = np.minimum.reduceat(comps, starts) == np.maximum.reduceat(comps, starts)
            comp_of = np.where(one & ~np.logical_or.reduceat(comps == self.MIXED, starts), comps[starts], self.MIXED)
            least, most = np.minimum.reduceat(below["least"], starts), np.maximum.reduceat(below["most"], starts)
            self.levels.append(self._level(group[starts], least, most, comp_of, np.maximum.reduceat(below["high"], starts, axis=0)) | {"first": np.append(starts, len(group))})

    MIXED = np.iinfo(np.int64).min

    @staticmethod
    def _level(group: np.ndarray, least: np.ndarray, most: np.ndarray, comp: np.ndarray, high: np.ndarray) -> dict[str, np.ndarray]:
        return {"group": group, "least": least, "most": most, "comp": comp, "high": high}

    def _bounded(self, level: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Which pairs of nodes may hold linked points of two components."""
        least, most, comp, high = level["least"], level["most"], level["comp"], level["high"]
        keep = (100 * most[a] >= percent * least[b]) & (100 * most[b] >= percent * least[a]) & ((comp[a] != comp[b]) | (comp[a] == self.MIXED))
        at = np.flatnonzero(keep)
        step = max(1, _PAIR_BYTES // high[0].nbytes) if len(high) else 1
        for lo in range(0, len(at), step):
            i = at[lo : lo + step]
            overlap = np.minimum(high[a[i]], high[b[i]]).sum(1, dtype=np.int64)
            keep[i] = (100 + percent) * overlap >= percent * (least[a[i]] + least[b[i]])
        return keep

    def pairs(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of points, as numbers of the rows given, whose bound reaches the threshold."""
        top = self.levels[-1]
        a = b = np.arange(len(top["group"]))
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            if k == 0:
                apart = a != b
                a, b = a[apart], b[apart]
            keep = self._bounded(level, a, b, percent)
            a, b = a[keep], b[keep]
            if k:
                first = level["first"]
                wide, high = first[b + 1] - first[b], first[a + 1] - first[a]
                many = wide * high
                of = np.repeat(np.arange(len(a)), many)
                place = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
                a, b = first[a[of]] + place // wide[of], first[b[of]] + place % wide[of]
                half = a <= b  # a pair of one node with itself meets each pair of its parts once
                a, b = a[half], b[half]
        return self.order[a], self.order[b]


def _surviving(rows: DataFrame, percent: int, fine: bool) -> DataFrame:
    """(cluster, vid, comp): points of one group joined by pairs that survive the tree. ``rows``: grp, vid, comp, n, counts on one of the grids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches):
            group, vid, comp, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            raw = batch.column(4)
            root = np.arange(len(vid))
            # Sizes by powers of two, each with those of the one below that are near enough; all points of a tree have one width.
            octave = np.frexp(n.astype(float))[1]
            for c in np.unique(octave).tolist():
                own = np.flatnonzero((octave == c) | (octave == c - 1) & (100 * n >= percent * 2 ** (c - 1)))
                own = own[np.argsort(group[own], kind="stable")]
                several = np.bincount(np.unique(group[own], return_inverse=True)[1])
                own = own[np.repeat(several > 1, several)]
                if not len(own):
                    continue
                width = _width(1 << c >> 2, fine)
                # Whole groups by turns, so that not all points of a batch are unfolded at once.
                turns = np.cumsum(several[several > 1]) * width // (1 << 22)
                for turn in np.split(own, np.cumsum(several[several > 1])[np.flatnonzero(np.diff(turns))]):
                    own_width = [_width(int(n[i]), fine) for i in turn]
                    stored = [raw[int(i)].as_py() for i in turn]
                    points = _least_type(np.array([on_grid(np.frombuffer(p, f"u{len(p) // w}"), width) for p, w in zip(stored, own_width, strict=True)]))
                    a, b = _Tree(group[turn], comp[turn], n[turn], points).pairs(percent)
                    root = _joined(root, [turn[a]], [turn[b]])
            size = np.bincount(root, minlength=len(root))
            members = np.flatnonzero(size[root] > 1)
            members = members[np.lexsort((vid[members], root[members]))]
            if not len(members):
                continue
            starts = np.flatnonzero(np.append(True, np.diff(root[members]) != 0))
            # The same cluster from several groups has one name.
            names = [xxhash.xxh3_64_intdigest(part.tobytes()) - (1 << 63) for part in np.split(vid[members], starts[1:])]
            clusters = np.repeat(np.array(names, np.int64), np.diff(np.append(starts, len(members))))
            yield pa.RecordBatch.from_arrays([pa.array(clusters), pa.array(vid[members]), pa.array(comp[members])], names=["cluster", "vid", "comp"])

    ordered = rows.repartition("grp").sortWithinPartitions("grp")
    return ordered.select("grp", "vid", "comp", "n", "counts").mapInArrow(run, "cluster long, vid long, comp long").distinct()


def _verified(clusters: DataFrame, points: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Edges (a, b) of points: a spanning forest of the links inside each cluster, found on the full sets."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            full = list(sets_of(batch.column(2).to_pylist(), words))
            # An id that repeats may bring other texts; the name of the set tells them apart.
            right = [i for i, (own, sid) in enumerate(zip(full, batch.column(1).to_pylist(), strict=True)) if _sid(own) == sid]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(right, pa.int64())), pa.array([full[i].tobytes() for i in right], pa.binary())], names=["vid", "full"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches):
            cluster, vid = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
            full = batch.column(2)
            left, right = [], []
            cuts = np.flatnonzero(np.concatenate([[True], np.diff(cluster) != 0, [True]])).tolist()
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                # A point whose text is in the table more than once comes more than once.
                own = lo + np.unique(vid[lo:hi], return_index=True)[1]
                if len(own) > 1:
                    a, b = _links([np.frombuffer(full[int(i)].as_py(), np.uint64) for i in own], percent)
                    root = smallest_linked(len(own), a, b)
                    moved = np.flatnonzero(root != np.arange(len(own)))
                    left.append(vid[own[moved]])
                    right.append(vid[own[root[moved]]])
            ends = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in ends], names=["a", "b"])

    ids = kept(points.join(clusters.select("vid").distinct(), "vid").select("doc_id", "vid", "sid"), "ids")
    full = docs.join(small(ids), "doc_id").select("vid", "sid", "text").mapInArrow(sets, "vid long, full binary")
    rows = clusters.join(full, "vid").select("cluster", "vid", "full")
    return rows.repartition("cluster").sortWithinPartitions("cluster").mapInArrow(run, "a long, b long").distinct()


def overlap_join(docs: DataFrame, words: int = 5, percent: int = 80, leaf: int = 512, few: int = 3) -> DataFrame:
    """doc_id, n_shingles and component_id for every document.

    Documents with 100 * intersection >= ``percent`` * union of their shingle sets are linked. The first run uses ``few`` coordinates of each point.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return settled(docs.sparkSession, "overlap-join", lambda: _overlap_join(source, words, percent, leaf, few))


def _in_groups(groups: DataFrame, points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``groups``, a kept table, and ``points`` for a join in which points outside of them are not shuffled, unless too many are inside."""
    sent = small(groups)
    if sent is groups:
        vids = kept(groups.select("vid").distinct(), "group-points")
        points = points.join(F.broadcast(vids), "vid", "left_semi") if vids.count() <= KEYS else points
    return sent, points


def _survivors(groups: DataFrame, points: DataFrame, percent: int, fine: bool) -> DataFrame:
    groups, own = _in_groups(groups, points.select("vid", "n", "counts"))
    return _surviving(groups.join(own if fine else _coarse(own), "vid"), percent, fine)


def _clusters(groups_of: Callable[..., DataFrame], labelled: DataFrame, points: DataFrame, percent: int, leaf: int) -> DataFrame:
    # Shuffles of a step give their disk back before the next one.
    groups = settled(points.sparkSession, "groups", partial(groups_of, labelled, percent, leaf))
    for fine in (False, True):
        groups = settled(points.sparkSession, "clusters", partial(_survivors, groups, points, percent, fine)).withColumnRenamed("cluster", "grp")
    return groups.select(F.col("grp").alias("cluster"), "vid")


def _all_links(clusters: DataFrame, points: DataFrame, source: DataFrame, words: int, percent: int, edges: DataFrame | None) -> DataFrame:
    found = _verified(clusters, points, source, words, percent)
    return found if edges is None else found.unionByName(edges)


def _overlap_join(source: DataFrame, words: int, percent: int, leaf: int, few: int) -> DataFrame:
    spark = source.sparkSession
    rows = kept(_points(source, words, percent, _levels(source, words), few).withColumn("vid", F.monotonically_increasing_id()), "points")
    points = _distinct(rows)
    edges, labels = None, None
    for groups_of in (_some_groups, _all_groups):
        # Each point is a component of its own at first.
        labelled = points.withColumn("comp", F.col("vid")) if labels is None else points.join(small(labels), "vid", "left").withColumn("comp", F.coalesce("root", "vid"))
        clusters = settled(spark, "clusters", partial(_clusters, groups_of, labelled, points, percent, leaf))
        edges = settled(spark, "links", partial(_all_links, clusters, points, source, words, percent, edges))
        labels = components(edges).withColumnRenamed("vertex", "vid")
    named = points.select("sid", "doc_id", "vid").join(labels, "vid", "left").withColumn("comp", F.coalesce("root", "vid"))
    least = named.groupBy(F.col("comp").alias("of_comp")).agg(F.min("doc_id").alias("component_id"))
    sets = kept(named.join(least, F.col("comp") == F.col("of_comp")).select("sid", "component_id"), "named-points")
    linked = rows.where("doc_id is not null").select("doc_id", "n", "sid").join(sets, "sid").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where("doc_id is null or sid is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
