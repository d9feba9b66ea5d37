"""Benchmark passages in documents, by SimHash fingerprints of item-sized windows.

A window has as many word shingles as the item that it is held against. Windows and items get 64-bit SimHash fingerprints of their
shingles, weighted by how often each occurs. Fingerprints are cut into 8 blocks; an item is listed under every value of a block
that differs from its own in at most 2 bits. If two fingerprints differ in at most 23 bits, some block differs in at most 2, so the index
finds all of them. (At a similarity of 0.8 the expected difference is 9.7 bits with a deviation of 2.9.) Candidates are then
verified by the exact weighted Jaccard similarity of their shingles.

Only windows that can reach the similarity are fingerprinted: those that hold enough of an item's shingles. The best window of an
alignment starts between its first and last diagonal (place in the document less place in the item), so these starts suffice.

At scale: documents are read, cut into shingles and probed against the shingles of the items where they are read; the table of
those is broadcast if it has at most ``broadcast_rows`` rows, and joined by a shuffle otherwise. What comes out grows with the
passages found, not with the corpus. All of it is DataFrame functions.

Defined cases: null and empty texts match nothing; an item of fewer than five words is one shingle of all its words, which only a
document of just these words has; words are runs of letters and digits in lower case; equal items are found each; rows without id
are compared like others; rows that repeat an id are told apart by their text; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import kept

BLOCKS, NEAR = 8, 2
RADIUS = BLOCKS * (NEAR + 1) - 1
_MASKS = [sum(1 << b for b in bits) for k in range(NEAR + 1) for bits in combinations(range(8), k)]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once, however often the optimiser repeats or moves the expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hashed_words(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingles(text: Column, k: int) -> Column:
    """Hashes of all word shingles of a text in order; one of all words where they are fewer than ``k``."""

    def of_words(words: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(*(words[i + j] for j in range(k))))
        whole = F.array(F.aggregate(words, F.lit(17).cast("long"), lambda h, w: F.xxhash64(h, w)))
        return F.when(F.size(words) >= k, every).when(F.size(words) > 0, whole).otherwise(F.array().cast("array<bigint>"))

    return _let(_hashed_words(text), of_words)


def fingerprint(shingles: Column) -> Column:
    """64-bit SimHash; a shingle that occurs n times weighs n."""

    def of_shingles(every: Column) -> Column:
        def add(total: Column, b: Column) -> Column:
            ones = F.aggregate(every, F.lit(0).cast("long"), lambda n, x: n + F.call_function("shiftright", x, b).bitwiseAND(F.lit(1)))
            own = F.call_function("shiftleft", F.lit(1).cast("long"), b)
            return total.bitwiseOR(F.when(2 * ones > F.size(every), own).otherwise(F.lit(0).cast("long")))

        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), add)

    return _let(shingles, of_shingles)


def _block(value: Column, number: Column) -> Column:
    return F.call_function("shiftrightunsigned", value, number * 8).bitwiseAND(F.lit(255))


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of the smaller over sum of the larger counts of all shingles."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    common = F.size(F.array_intersect(a, b))

    def count(values: Column, x: Column) -> Column:
        return F.size(F.filter(values, lambda y: y == x))

    least = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(count(a, x), count(b, x)))
    shared = F.when(plain, common).otherwise(least)
    total = F.size(a) + F.size(b) - shared
    return F.when(total > 0, shared / total).otherwise(F.lit(0.0))


def contaminated(docs: DataFrame, benchmark: DataFrame, words: int = 5, percent: int = 80, broadcast_rows: int = 2_000_000) -> DataFrame:
    """(doc_id, item_id, start, distance, similarity, text_hash) of every document and item it holds: the best window, by its first shingle."""
    items = kept(benchmark.select("item_id", _shingles(F.col("text"), words).alias("shingles")), "item-shingles")
    items = items.where(F.size("shingles") > 0).select("item_id", "shingles", F.size("shingles").alias("n"), fingerprint(F.col("shingles")).alias("item_print"))
    items = kept(items, "items")
    share = percent / 100

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _shingles(F.col("text"), words).alias("shingles"))
    places = items.select("item_id", "n", F.posexplode("shingles").alias("item_at", "shingle"))
    if places.count() <= broadcast_rows:
        places = F.broadcast(places)
    # The outer form keeps the optimiser from computing the shingles twice, to test first whether there are any.
    hits = rows.select("doc_id", "text_hash", F.posexplode_outer("shingles").alias("at", "shingle")).join(places, "shingle")
    # Repeated rows give the same hits; one of each is enough.
    groups = hits.groupBy("doc_id", "text_hash", "item_id", "n").agg(F.array_sort(F.collect_set(F.struct("at", "item_at"))).alias("hits"))
    enough = F.size(F.array_distinct(F.transform("hits", lambda h: h["item_at"]))) >= F.col("n") * share
    groups = groups.where(enough).select("doc_id", "text_hash", "n", "hits")

    # Starts on a diagonal, and between neighbours that are too near for an insertion to rule out a match.
    diagonals = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["at"] - h["item_at"])))
    starts = F.flatten(
        F.transform(
            F.col("diagonals"),
            lambda d, i: F.when(
                (i + 1 < F.size("diagonals")) & (F.get(F.col("diagonals"), i + 1) - d <= F.ceil(F.col("n") * (1 - share) * 1.5)),
                F.sequence(d, F.get(F.col("diagonals"), i + 1)),
            ).otherwise(F.array(d)),
        )
    )
    windows = groups.withColumn("diagonals", diagonals).withColumn("start", F.explode(F.array_distinct(starts)))
    inside = F.filter("hits", lambda h: (h["at"] >= F.col("start")) & (h["at"] < F.col("start") + F.col("n")))
    windows = windows.where(F.size(F.array_distinct(F.transform(inside, lambda h: h["item_at"]))) >= F.col("n") * share)
    windows = kept(windows.select("doc_id", "text_hash", "n", F.greatest("start", F.lit(0)).alias("start")).distinct(), "windows")

    # Only documents with such a window are cut into shingles once more.
    again = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    again = again.join(windows.select("text_hash").distinct(), "text_hash", "left_semi").dropDuplicates(["doc_id", "text_hash"])
    again = again.select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"), _shingles(F.col("text"), words).alias("shingles"))
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_text"))
    windows = windows.join(again, same).select("doc_id", "text_hash", "n", "start", F.slice("shingles", F.col("start") + 1, F.col("n")).alias("window"))
    windows = kept(windows.withColumn("window_print", fingerprint(F.col("window"))), "fingerprints")

    numbers = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    index = items.withColumn("block", F.explode(numbers)).withColumn("mask", F.explode(F.array(*map(F.lit, _MASKS))))
    index = index.select("item_id", "n", "item_print", "shingles", "block", _block(F.col("item_print"), F.col("block")).bitwiseXOR(F.col("mask")).alias("value"))
    probes = windows.withColumn("block", F.explode(numbers)).withColumn("value", _block(F.col("window_print"), F.col("block")))
    distance = F.bit_count(F.col("window_print").bitwiseXOR(F.col("item_print")))
    found = probes.join(index.drop("shingles"), ["n", "block", "value"]).withColumn("distance", distance).where(F.col("distance") <= RADIUS)
    # A pair that several blocks yield counts at the first of them, which needs no shuffle.
    matching = F.filter(numbers, lambda k: F.bit_count(_block(F.col("window_print").bitwiseXOR(F.col("item_print")), k)) <= NEAR)
    found = found.where(F.col("block") == matching[0])
    found = found.join(items.select(F.col("item_id").alias("of_item"), "shingles"), F.col("item_id").eqNullSafe(F.col("of_item")))
    found = found.withColumn("similarity", weighted_similarity(F.col("window"), F.col("shingles"))).where(F.col("similarity") >= share - 1e-12)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), (-F.col("distance")).alias("closer"))).alias("best")
    found = found.groupBy("doc_id", "item_id", "text_hash").agg(best)
    return found.select("doc_id", "item_id", (-F.col("best.before")).alias("start"), (-F.col("best.closer")).alias("distance"), "best.similarity", "text_hash")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    found = contaminated(docs, benchmark, **options).select(F.col("text_hash").alias("contaminated_text")).distinct()
    return docs.join(found, F.xxhash64(docs["text"]) == F.col("contaminated_text"), "left_anti")
