"""Conflict-constrained best-fit packing of documents into training sequences.

A bin holds at most one piece of a source and of a duplicate cluster. Bins are ordered by what is left in them, and each carries
a bitmap of its sources and one of its clusters; a piece goes to the tightest bin that has room and no bit in common with it,
found by searching upwards from its size. Longest pieces first. A document longer than a bin becomes full pieces and a rest.

At scale: documents are dealt by a hash of all their columns to shards of about ``shard_rows`` rows, packed independently; only ids,
lengths and keys are shuffled, no text. A source or cluster that owns a third of all rows is spread over all shards.

Defined cases: a null source or cluster never conflicts; a document without words is a piece of length 0; repeated rows are packed
each; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SCHEMA = "bin_id long, doc_id long, piece int, offset long, n_tokens long"


def best_fit(items: Iterable[tuple[int, int, int]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) for each (length, source bit, cluster bit) in turn; a bit is 0 where nothing conflicts."""
    room: list[tuple[int, int]] = []  # (left, bin) of bins that aren't full, in order
    sources: list[int] = []
    clusters: list[int] = []
    placed = []
    for length, source, cluster in items:
        at = bisect_left(room, (length, -1))
        while at < len(room) and (sources[room[at][1]] & source or clusters[room[at][1]] & cluster):
            at += 1
        if at < len(room):
            left, number = room.pop(at)
        else:
            left, number = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        placed.append((number, capacity - left))
        sources[number] |= source
        clusters[number] |= cluster
        if left > length or not length:
            insort(room, (left - length, number))
    return placed


def pack(docs: DataFrame, capacity: int = 2048, shard_rows: int = 4096) -> DataFrame:
    """Pack (doc_id, source, cluster, n_tokens): one row per piece with its bin, its place there and its length."""
    shards = max(1, -(-docs.count() // shard_rows))

    def pack_shard(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id", kind="stable")
        bits = []
        for key in ("source", "cluster"):
            codes = pd.factorize(rows[key], use_na_sentinel=True)[0].tolist()
            bits.append([1 << c if c >= 0 else 0 for c in codes])
        pieces = []
        for row, total in enumerate(rows["n_tokens"].tolist()):
            pieces += [(-min(capacity, total - at), row, k) for k, at in enumerate(range(0, max(total, 1), capacity))]
        pieces.sort()
        placed = best_fit(((-n, bits[0][row], bits[1][row]) for n, row, _ in pieces), capacity)
        order = [row for _, row, _ in pieces]
        return pd.DataFrame(
            {
                "bin_id": [(int(rows["shard"].iloc[0]) << 32) + number for number, _ in placed],
                "doc_id": rows["doc_id"].iloc[order].array,
                "piece": [k for _, _, k in pieces],
                "offset": [offset for _, offset in placed],
                "n_tokens": [-n for n, _, _ in pieces],
            }
        )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("cluster").cast("long").alias("cluster"),
        F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("n_tokens"),
    )
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "source"), F.lit(shards)))
    # A null id would turn the column into floats in pandas; the nullable type keeps 64 bits.
    return rows.groupBy("shard").applyInPandas(lambda p: pack_shard(p.convert_dtypes(convert_floating=False)), _SCHEMA)


def with_lengths(docs: DataFrame) -> DataFrame:
    """doc_id, source, cluster (copies of one text share it; without text null) and n_tokens (words) of documents."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.when(text != "", F.xxhash64(text)).alias("cluster"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_tokens"),
    )
