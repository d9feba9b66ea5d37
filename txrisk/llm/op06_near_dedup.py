"""Near duplicates by a chosen-path set similarity join.

Each document is the set of its word shingles, stood for by ``WIDTH`` minwise tokens. A tree sends a document down the branches of one
or two of these tokens (1 / threshold on average), chosen by the node it is in; two documents stay together in a tree with a chance that only
falls with depth as 1 / (depth + 1) when they are as similar as the threshold. Nodes of at most ``leaf`` documents are compared exhaustively,
larger ones branch again. Independent trees bring recall to its target: with 16 trees a pair right at the threshold is missed with
a chance of 1e-7 in nodes that needn't branch and under 1e-3 three levels down; what is more similar is missed less.

Comparing in a node uses the tokens and only yields groups that may hold links (well below the threshold); links are then confirmed
on the full shingle sets, and components joined from them. After some trees, groups that lie within one component are dropped
before their sets are fetched.

At scale: equal sets are one vertex from the start, whatever their number. Nodes that stay large to the end hold documents that are
alike; they are dealt in blocks, and when most of a node is one component, only the others meet all of it. Groups are linear
in their documents and no pair of a group is written; links leave a group as a spanning forest. Nothing reaches the driver but counts.

Defined cases: texts without words are empty sets and linked with nothing; rows without id are kept, alone and without
component; rows that repeat an id are documents of their own; an empty table gives no rows; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import KEYS, kept, new_path, remove, settled, small, written
from txrisk.llm.components import components

WIDTH = 128
# How many of the two half bytes of each byte are 0.
_ZEROS = np.array([(not x & 15) + (not x >> 4) for x in range(256)], np.uint8)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SEEDS = np.random.default_rng(20240607).integers(0, 1 << 63, (2, WIDTH), dtype=np.uint64)
_A, _B = _SEEDS[0] * np.uint64(2) + np.uint64(1), _SEEDS[1]
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text; A-Z count as a-z, words end at ASCII white space."""
    own = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not own:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, own), np.uint64, len(own))
    k = min(words, len(own))
    total = np.full(len(own) - k + 1, k, np.uint64)
    for j in range(k):
        total = _mix(total ^ hashed[j : len(hashed) - k + 1 + j]) * _M2
    return np.unique(total)


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The 32-bit minwise tokens of a set."""
    least = np.full(WIDTH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        np.minimum(least, (shingles[at : at + 4096, None] * _A + _B).min(0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def low_bits(tokens: np.ndarray) -> np.ndarray:
    """The lowest four bits of each token, two to a byte: different tokens agree in them once in 16."""
    low = tokens.astype(np.uint8) & 15
    return low[: WIDTH // 2] | low[WIDTH // 2 :] << 4


def _sid(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, sid (128 bits that name the set; null for an empty one), the minwise tokens, and their low bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sids, tokens, short = [], [], [], []
            for text in batch.column(1).to_pylist():
                own = shingle_set(text, words)
                least = minwise(own) if len(own) else None
                n.append(len(own))
                sids.append(_sid(own) if len(own) else None)
                tokens.append(None if least is None else least.tobytes())
                short.append(None if least is None else low_bits(least).tobytes())
            columns = [batch.column(0), batch.column(2), pa.array(n, pa.int64()), *(pa.array(c, pa.binary()) for c in (sids, tokens, short))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n_shingles", "sid", "tokens", "short"])

    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return docs.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, sid binary, tokens binary, short binary")


def _tokens_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, WIDTH)


def _branches(nodes: np.ndarray, tokens: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row the one or two child nodes of its node: row numbers and nodes."""
    pick, second = _mix(nodes ^ _M1), _mix(nodes ^ _M2)
    coordinate = (pick % np.uint64(WIDTH)).astype(np.int64)
    # Two different tokens are chosen with such a chance that 1 / threshold are on average.
    twice = np.flatnonzero((second >> np.uint64(32)).astype(np.float64) / 2**32 < 1 / threshold - 1)
    other = (coordinate[twice] + 1 + (second[twice] % np.uint64(WIDTH - 1)).astype(np.int64)) % WIDTH
    rows = np.concatenate([np.arange(len(nodes)), twice])
    chosen = np.concatenate([coordinate, other])
    values = tokens[rows, chosen].astype(np.uint64)
    return rows, _mix(_mix(nodes[rows] + np.uint64(1) + chosen.astype(np.uint64)) ^ values)


_BRANCHES = "node long, sid binary, comp long"


def _children(batch: pa.RecordBatch, nodes: np.ndarray, tokens: np.ndarray, threshold: float) -> pa.RecordBatch:
    """One batch of ``_BRANCHES``; ``batch`` starts with sid and comp."""
    at, children = _branches(nodes, tokens, threshold)
    at = pa.array(at)
    return pa.RecordBatch.from_arrays([pa.array(children.astype(np.int64)), batch.column(0).take(at), batch.column(1).take(at)], names=["node", "sid", "comp"])


def _first_level(vertices: DataFrame, trees: range, threshold: float) -> DataFrame:
    """The branches at the roots."""
    roots = _mix(np.array(trees, np.uint64) + np.uint64(1) << np.uint64(20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = _tokens_of(batch.column(2))
            for root in roots:
                yield _children(batch, np.full(len(tokens), root), tokens, threshold)

    return vertices.select("sid", "comp", "tokens").mapInArrow(run, _BRANCHES)


def _next_level(rows: DataFrame, threshold: float) -> DataFrame:
    """The branches of (node, sid, comp, tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                nodes = batch.column(3).to_numpy(zero_copy_only=False).astype(np.uint64)
                yield _children(batch, nodes, _tokens_of(batch.column(2)), threshold)

    return rows.select("sid", "comp", "tokens", "node").mapInArrow(run, _BRANCHES)


def _open_nodes(level: DataFrame) -> DataFrame:
    """The rows of ``level`` in nodes of several components, with n, the documents of their node."""
    rows = kept(level, "branches")
    sizes = rows.groupBy(F.col("node").alias("of_node")).agg(F.count("*").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
    return rows.join(sizes, F.col("node") == F.col("of_node")).select("node", "sid", "comp", "n")


def _nodes(labelled: DataFrame, vertices: DataFrame, trees: range, threshold: float, leaf: int, depth: int) -> DataFrame:
    """(node, sid, comp, n) of the nodes at which the trees end; n is their number of documents.

    Nodes whose documents are of one component have nothing to find, and go at once.
    """
    level, ended = _first_level(labelled, trees, threshold), []
    for k in range(depth):
        rows = settled(vertices.sparkSession, "nodes", partial(_open_nodes, level))
        if k == depth - 1:
            ended.append(rows)
            break
        large = rows.where(F.col("n") > leaf)
        if large.isEmpty():
            ended.append(rows)
            break
        # A large node ends as well if few of its documents are outside its largest component: only they have much to meet.
        counts = large.groupBy("node", "n", "comp").agg(F.count("*").alias("k"))
        others = counts.groupBy(F.col("node").alias("of_node")).agg((F.max("n") - F.max("k")).alias("others"))
        cut = kept(others.where(F.col("others") > leaf).select("of_node"), "cut-nodes")
        at = F.col("node") == F.col("of_node")
        ended.append(rows.join(cut, at, "left_anti"))
        level = _next_level(large.join(cut, at, "left_semi").join(vertices.select("sid", "tokens"), "sid"), threshold)
    out = ended[0]
    for more in ended[1:]:
        out = out.unionByName(more)
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches that hold whole groups; ``batches`` are in order of their first column."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        keys = batch.column(0)
        keys = keys.to_numpy(zero_copy_only=False)
        at = int(np.flatnonzero(keys == keys[-1])[0])
        if at:
            yield batch.slice(0, at)
        rest = batch.slice(at)
    if rest is not None:
        yield rest


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number in the component of each of 0 .. n-1 under the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _joined(root: np.ndarray, left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """``root`` after the links between ``left`` and ``right`` have joined its components."""
    if not left:
        return root
    return _roots(len(root), root[np.concatenate(left)], root[np.concatenate(right)])[root]


def _candidates(rows: DataFrame, at_least: float) -> DataFrame:
    """(cluster, sid) of documents in one group whose tokens agree enough; linear in the documents.

    ``rows``: grp, sid, comp, short (the low bits of the tokens). Pairs within one component are left out.
    """
    needed = int(np.ceil(at_least * WIDTH))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches):
            n = batch.num_rows
            group = batch.column(0).to_numpy(zero_copy_only=False)
            sids = batch.column(1).to_pylist()
            comp = batch.column(2).to_numpy(zero_copy_only=False)
            short = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, WIDTH // 2)
            near, root = np.arange(n), np.arange(n)
            left, right, waiting = [], [], 0
            for d in range(1, n):
                # Groups are contiguous: rows whose group ended stay out.
                near = near[near < n - d]
                near = near[group[near] == group[near + d]]
                if not len(near):
                    break
                # Within a cluster another pair adds nothing.
                i = near[(comp[near] != comp[near + d]) & (root[near] != root[near + d])]
                for part in np.array_split(i, len(i) // 20_000 + 1):
                    like = part[_ZEROS[short[part] ^ short[part + d]].sum(1) >= needed]
                    left.append(like)
                    right.append(like + d)
                    waiting += len(like)
                # Pairs are joined soon, so a group of near copies never holds more than a few for each document.
                if waiting > n:
                    root = _joined(root, left, right)
                    left, right, waiting = [], [], 0
            root = _joined(root, left, right)
            size = np.bincount(root, minlength=n)
            members = np.flatnonzero(size[root] > 1)
            if not len(members):
                continue
            names: dict[int, list[int]] = {}
            for m in members.tolist():
                names.setdefault(int(root[m]), []).append(m)
            clusters, out = [], []
            for own in names.values():
                # The same cluster from several trees has one name.
                name = xxhash.xxh3_64_intdigest(b"".join(sorted(sids[m] for m in own))) - (1 << 63)
                clusters += [name] * len(own)
                out += [sids[m] for m in own]
            yield pa.RecordBatch.from_arrays([pa.array(clusters, pa.int64()), pa.array(out, pa.binary())], names=["cluster", "sid"])

    ordered = rows.repartition("grp").sortWithinPartitions("grp")
    return ordered.select("grp", "sid", "comp", "short").mapInArrow(run, "cluster long, sid binary").distinct()


def _links(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs among full sets."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        common = np.array([[0, len(np.intersect1d(*sets, assume_unique=True))], [0, 0]])
    else:
        every, column = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(len(sets)), sizes)
        # A shingle of one set is in no intersection.
        shared = np.bincount(column, minlength=len(every)) > 1
        number = np.cumsum(shared) - 1
        keep = shared[column]
        row, column, width = row[keep], number[column[keep]], int(shared.sum())
        common = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for at in range(0, width, 8192):
            lo, hi = np.searchsorted(column, [at, at + 8192])
            part = np.zeros((len(sets), min(8192, width - at)), np.float32)
            part[row[lo:hi], column[lo:hi] - at] = 1
            common += part @ part.T
        common = common.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    a, b = np.nonzero(np.triu(100 * common >= percent * union, 1))
    return a, b


def _confirmed(clusters: DataFrame, vertices: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Edges (a, b) of sids: a spanning forest of the links inside each cluster, found on full sets."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            full = {}
            for text in batch.column(0).to_pylist():
                own = shingle_set(text, words)
                if len(own) and (sid := _sid(own)) not in seen:
                    seen.add(sid)
                    full[sid] = own.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(list(full), pa.binary()), pa.array(list(full.values()), pa.binary())], names=["sid", "full"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches):
            cluster = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(cluster)) + 1).tolist(), len(cluster)]
            sids, full = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            left, right = [], []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                a, b = _links([np.frombuffer(f, np.uint64) for f in full[lo:hi]], percent)
                root = _roots(hi - lo, a, b)
                for i in np.flatnonzero(root != np.arange(hi - lo)).tolist():
                    left.append(sids[lo + i])
                    right.append(sids[lo + int(root[i])])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])

    # Only documents that stand for a set in a cluster are read again. An id that repeats may bring other texts as well; the
    # name of the set, made anew, tells them apart.
    ids = kept(vertices.select("sid", "doc_id").join(clusters.select("sid").distinct(), "sid").select("doc_id"), "ids")
    full = docs.join(small(ids, KEYS), "doc_id", "left_semi").select("text").mapInArrow(sets, "sid binary, full binary")
    rows = clusters.join(full, "sid").select("cluster", "sid", "full")
    return rows.repartition("cluster").sortWithinPartitions("cluster").mapInArrow(run, "a binary, b binary").distinct()


def _dealt(nodes: DataFrame, leaf: int, complete: bool) -> DataFrame:
    """(grp, sid, comp): groups of bounded size in which documents are to be compared.

    Nodes over ``leaf`` are dealt to blocks; with ``complete``, blocks of the documents outside the node's largest component meet
    all blocks, so every pair of two components shares a group.
    """
    small = nodes.where(F.col("n") <= leaf).select(F.col("node").alias("grp"), "sid", "comp")
    large = nodes.where(F.col("n") > leaf)
    dice = F.xxhash64("sid", "node")

    def blocks(count: Column) -> Column:
        return F.ceil(count / F.lit(leaf)).cast("long")

    if not complete:
        block = F.pmod(dice, blocks(F.col("n")))
        return small.unionByName(large.select(F.xxhash64("node", block).alias("grp"), "sid", "comp"))
    counts = large.groupBy("node", "comp").agg(F.count("*").alias("k"))
    largest = counts.groupBy(F.col("node").alias("of_node")).agg(F.max(F.struct("k", "comp")).alias("top"))
    rows = large.join(largest, F.col("node") == F.col("of_node")).select(
        "node", "sid", "comp", (F.col("comp") == F.col("top.comp")).alias("major"), blocks(F.col("top.k")).alias("majors"), blocks(F.col("n") - F.col("top.k")).alias("rests")
    )
    number = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    own = F.pmod(dice, F.when(F.col("major"), F.col("majors")).otherwise(F.col("rests")))
    rows = rows.withColumn("own", own)
    meets = rows.withColumn("other", F.explode(F.when(F.col("major"), number("rests")).otherwise(number("majors"))))
    pair = F.when(F.col("major"), F.xxhash64("node", "own", "other", F.lit("m"))).otherwise(F.xxhash64("node", "other", "own", F.lit("m")))
    rest = rows.where(~F.col("major")).withColumn("other", F.explode(number("rests")))
    among = F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"), F.lit("r"))
    return small.unionByName(meets.select(pair.alias("grp"), "sid", "comp")).unionByName(rest.select(among.alias("grp"), "sid", "comp"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, trees: int = 16, first_trees: int = 2, leaf: int = 512, depth: int = 6, slack: float = 0.11) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document; text_hash tells rows of one id apart.

    Documents with 100 * intersection >= ``percent`` * union of their shingle sets are linked. ``slack`` is how far below the
    threshold the tokens may put a pair that is still confirmed on its full sets (three standard deviations at 128 tokens).
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return settled(docs.sparkSession, "near-duplicates", lambda: _near_duplicates(source, words, percent, (range(first_trees), range(first_trees, trees)), leaf, depth, slack))


def _clusters(labelled: DataFrame, vertices: DataFrame, trees: range, threshold: float, leaf: int, depth: int, slack: float, complete: bool) -> DataFrame:
    dealt = _dealt(_nodes(labelled, vertices, trees, threshold, leaf, depth), leaf, complete)
    return _candidates(dealt.join(vertices.select("sid", "short"), "sid"), threshold - slack)


def _all_links(clusters: DataFrame, vertices: DataFrame, source: DataFrame, words: int, percent: int, edges: DataFrame | None) -> DataFrame:
    found = _confirmed(clusters, vertices, source, words, percent)
    return found if edges is None else found.unionByName(edges)


def _near_duplicates(source: DataFrame, words: int, percent: int, runs: tuple[range, ...], leaf: int, depth: int, slack: float) -> DataFrame:
    spark, path = source.sparkSession, new_path(source.sparkSession, "shingle-sets")
    sets = written(_sets(source, words), path)
    best = F.min(F.struct("doc_id", "tokens", "short")).alias("best")
    vertices = kept(sets.where("doc_id is not null and sid is not null").groupBy("sid").agg(best).select("sid", "best.*"), "vertices")
    rows = kept(sets.select("doc_id", "n_shingles", "text_hash", "sid"), "rows")
    remove(spark, path)  # the tokens are in ``vertices``, once for each set
    # Each set is a component of its own at first. A component is told by a hash of its smallest set.
    labelled, edges = vertices.withColumn("comp", F.xxhash64("sid")), None
    for chosen in runs:
        if not len(chosen):
            continue
        if edges is not None:
            found = labels.select(F.col("vertex").alias("sid"), "root")
            labelled = vertices.join(small(found), "sid", "left").withColumn("comp", F.xxhash64(F.coalesce("root", "sid"))).drop("root")
        clusters = settled(spark, "clusters", partial(_clusters, labelled, vertices, chosen, percent / 100, leaf, depth, slack, edges is not None))
        edges = settled(spark, "links", partial(_all_links, clusters, vertices, source, words, percent, edges))
        labels = components(edges)
    # Component of each set, then the smallest id of each component.
    own = rows.where("doc_id is not null and sid is not null")
    tagged = own.join(labels.withColumnRenamed("vertex", "sid"), "sid", "left")
    tagged = tagged.select("doc_id", "n_shingles", "text_hash", F.coalesce("root", "sid").alias("root"))
    least = tagged.groupBy(F.col("root").alias("of_root")).agg(F.min("doc_id").alias("component_id"))
    linked = tagged.join(least, F.col("root") == F.col("of_root")).select("doc_id", "n_shingles", "component_id", "text_hash")
    alone = rows.where("doc_id is null or sid is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_hash")
    out = linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", "kept", "text_hash")


def without_near_duplicates(docs: DataFrame, **options: int) -> DataFrame:
    """The rows of ``docs`` that have the smallest id of their component, and those without id.

    Rows that repeat both id and text are one document and stay or go together.
    """
    found = near_duplicates(docs, **options).where("not kept").select(F.col("doc_id").alias("dropped_id"), F.col("text_hash").alias("dropped_text")).distinct()
    text = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(found, (docs["doc_id"].cast("long") == F.col("dropped_id")) & (text == F.col("dropped_text")), "left_anti")
