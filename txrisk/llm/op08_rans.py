"""Token ids in files coded with a static range asymmetric numeral system.

One frequency table, counted over all tokens, serves all files. A file holds documents in ascending order of id, as blocks of up to
``BLOCK`` tokens. A block is coded by itself in up to ``LANES`` interleaved lanes, token i in lane i mod lanes, and has a
checkpoint in the file's head (where it starts, how many words, how many tokens, its checksum), so blocks decode in parallel. The
table is a file beside the others, named in every head with its checksum, so any process can read a set from its paths alone.

At scale: texts are tokenised where they are read; only ids (two bytes each, for vocabularies that allow it) are shuffled,
once, by ranges of id. The table has one entry per token of the vocabulary; that is all that is gathered.

Defined cases: a null text is empty; every document ends with ``END``, so none is without tokens; a null id comes first; repeated
ids are kept, ordered by their tokens; an empty table gives no file and no rows; a document longer than a block spans blocks.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import kept, new_path
from txrisk.llm.files import read_file, write_file, write_named

SCALE, LANES, BLOCK, END = 20, 2048, 1 << 18, 0
_LOW = np.uint64(1 << 31)
_MAGIC = b"TXRANS01"
_CACHE = 64 << 20  # bytes of words and ids that a Python worker remembers for all its tasks
_SLICE = 16 << 20  # bytes of text that are cut into words at once
_MISSED = 20_000  # new words that are tokenised at once
_TABLE = "frequencies"  # the file of a set that holds the table of all others


def quantise(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2^SCALE, at least 1 for every symbol that occurs."""
    total = int(counts.sum())
    if not total:
        return np.zeros(len(counts), np.uint64)
    size = 1 << SCALE
    if np.count_nonzero(counts) > size:
        raise ValueError(f"more than {size} different symbols")
    freq = np.where(counts > 0, np.maximum(1, np.floor(counts / total * size)), 0).astype(np.int64)
    while (left := size - int(freq.sum())) != 0:
        # The most frequent symbols give or take the rest, in proportion, so that none falls below 1.
        order = np.argsort(-freq, kind="stable")
        if left > 0:
            freq[order[0]] += left
        else:
            take = np.minimum(freq[order] - 1, np.ceil(-left * (freq[order] - 1) / max(1, int((freq - (freq > 0)).sum()))).astype(np.int64))
            take = np.clip(take, 0, None)
            over = np.cumsum(take) + left
            take = np.where(over > 0, np.maximum(0, take - over), take)
            freq[order] -= take
    return freq.astype(np.uint64)


def encode_block(ids: np.ndarray, freq: np.ndarray, start: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Lanes, their states, and the words in the order in which decoding takes them."""
    lanes = int(max(1, min(LANES, len(ids) // 64)))
    x = np.full(lanes, _LOW, np.uint64)
    words = []
    f_all, c_all = freq[ids], start[ids]
    for at in range((len(ids) - 1) // lanes * lanes, -1, -lanes):
        f, c = f_all[at : at + lanes], c_all[at : at + lanes]
        s = x[: len(f)]
        full = s >= f << np.uint64(63 - SCALE)
        words.append(s[full].astype(np.uint32))
        s = np.where(full, s >> np.uint64(32), s)
        q = s // f
        x[: len(f)] = (q << np.uint64(SCALE)) + (s - q * f) + c
    return lanes, x, np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)


def decode_block(n: int, x: np.ndarray, words: np.ndarray, freq: np.ndarray, start: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    out, lanes, taken = np.empty(n, symbols.dtype), len(x), 0
    x, wide = x.copy(), words.astype(np.uint64)
    for at in range(0, n, lanes):
        s = x[: min(lanes, n - at)]
        slot = s & np.uint64((1 << SCALE) - 1)
        symbol = symbols[slot]
        out[at : at + len(s)] = symbol
        s = freq[symbol] * (s >> np.uint64(SCALE)) + slot - start[symbol]
        low = np.flatnonzero(s < _LOW)
        s[low] = s[low] << np.uint64(32) | wide[taken : taken + len(low)]
        taken += len(low)
        x[: len(s)] = s
    return out


def encode_file(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, freq: np.ndarray, place: tuple[int, int] = (0, 0)) -> bytes:
    """The bytes of a file of whole documents; ``place`` orders the files of a set."""
    start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    blocks, body, at = [], [], 0
    for first in range(0, len(ids), BLOCK):
        part = ids[first : first + BLOCK]
        lanes, states, words = encode_block(part, freq, start)
        data = states.astype("<u8").tobytes() + words.astype("<u4").tobytes()
        blocks.append([at, lanes, len(words), len(part), zlib.crc32(part.astype("<u4").tobytes())])
        body.append(data)
        at += len(data)
    index = zlib.compress(np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array(lengths, "<u4").tobytes() + bytes(d is None for d in doc_ids))
    table = {"file": _TABLE, "crc32": zlib.crc32(freq.astype("<u8").tobytes())}
    head = json.dumps({"scale": SCALE, "place": place, "docs": len(doc_ids), "ids": len(ids), "index": len(index), "table": table, "blocks": blocks}).encode()
    return b"".join([_MAGIC, struct.pack("<I", len(head)), head, index, *body])


def head_size(data: bytes) -> int:
    """How long the head of a file is, which follows the first 12 bytes, ``data``."""
    if data[:8] != _MAGIC:
        raise ValueError("not a file of token ids")
    return struct.unpack_from("<I", data, 8)[0]


def encode_table(freq: np.ndarray) -> bytes:
    """The bytes of the file that holds the frequency table."""
    return zlib.compress(freq.astype("<u8").tobytes())


def decode_table(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<u8")


def decode_file(data: bytes, freq: np.ndarray, symbols: np.ndarray) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Ids of the documents, their lengths, and all tokens; every block is held against its checksum."""
    size = head_size(data)
    head = json.loads(data[12 : 12 + size])
    if head["table"]["crc32"] != zlib.crc32(freq.astype("<u8").tobytes()):
        raise ValueError("the file was written with another frequency table")
    index, n = zlib.decompress(data[12 + size : 12 + size + head["index"]]), head["docs"]
    nulls = index[12 * n :]
    doc_ids = [None if gone else d for d, gone in zip(np.frombuffer(index, "<i8", n).tolist(), nulls, strict=True)]
    start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    body, out = 12 + size + head["index"], []
    for at, lanes, n_words, n_ids, checksum in head["blocks"]:
        x = np.frombuffer(data, "<u8", lanes, body + at)
        words = np.frombuffer(data, "<u4", n_words, body + at + 8 * lanes)
        ids = decode_block(n_ids, x, words, freq, start, symbols)
        if zlib.crc32(ids.astype("<u4").tobytes()) != checksum:
            raise ValueError("a block doesn't fit its checksum")
        out.append(ids)
    return doc_ids, np.frombuffer(index, "<u4", n, 8 * n), np.concatenate(out) if out else symbols[:0]


class _Words:
    """Ids of texts by their distinct words, each with the space before it; line feeds stay at the word after them.

    Byte-level pre-tokenisation always cuts before a single white space that a word follows, so words have the same ids alone as
    in their text, and many words are tokenised as one text and cut apart again. Texts with words that begin or end with other white
    space, or with the name of a special token, are coded as a whole.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # A byte-level vocabulary writes the space as this letter.
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(self.size)])
        self.line_feed = self.ids("\n")
        self.forget()
        parts = json.loads(self.tokenizer.to_str())
        pre = parts.get("pre_tokenizer") or {}
        by_word = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not parts.get("normalizer")
        self.by_word = by_word and len(self.line_feed) == 1

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)

    def forget(self) -> None:
        """Start with no word known."""
        self.words, self.lengths, self.table = pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, self.kind)

    def _tokenised(self, words: list[str], before: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``before`` and a word, for each of ``words``, and how many they are."""
        text = "".join(before + w for w in words)
        flat = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
        starts = np.flatnonzero(self.spaced[flat] if before else flat == self.line_feed[0])
        if len(starts) == len(words):
            return flat, np.diff(starts, append=len(flat))
        alone = [self.ids(before + w) for w in words]
        return np.concatenate(alone), np.array([len(a) for a in alone])

    def _looked_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word, with the space before it where it doesn't begin with a line feed: the place of its ids in a table, their number
        (0 for words that can't stand alone); and the table."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().copy()
        known, lengths, table = self.words, self.lengths, self.table
        if len(missing := np.flatnonzero(at < 0)):
            missed = words.take(pa.array(missing)).to_pylist()
            kinds: tuple[list[int], ...] = ([], [], [])
            for i, w in enumerate(missed):
                apart = not w or w[-1].isspace() or w[w[0] == "\n"].isspace()
                kinds[2 if apart else w[0] == "\n"].append(i)
            more, many = [], []
            for before, own in zip((" ", ""), kinds[:2], strict=True):
                for lo in range(0, len(own), _MISSED):
                    flat, n = self._tokenised([missed[i] for i in own[lo : lo + _MISSED]], before)
                    more.append(flat)
                    many.append(n)
            missing = missing[np.array([*kinds[0], *kinds[1], *kinds[2]])]
            at[missing] = len(known) + np.arange(len(missing))
            known = pa.concat_arrays([known, words.take(pa.array(missing))])
            lengths, table = np.concatenate([lengths, *many, np.zeros(len(kinds[2]), np.int64)]), np.concatenate([table, *more])
            if known.nbytes + lengths.nbytes + table.nbytes <= _CACHE:
                self.words, self.lengths, self.table = known, lengths, table
        return (np.cumsum(lengths) - lengths)[at], lengths[at], table

    def documents(self, texts: pa.Array) -> list[bytes]:
        """The ids of every text and ``END``, as bytes."""
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        turns = np.flatnonzero(np.diff(np.cumsum(sizes) // _SLICE)) + 1
        out = []
        for lo, hi in zip([0, *turns.tolist()], [*turns.tolist(), len(texts)], strict=True):
            out += self._slice(texts.slice(lo, hi - lo))
        return out

    def _slice(self, texts: pa.Array) -> list[bytes]:
        if not len(texts):
            return []
        whole = np.full(len(texts), not self.by_word)
        for name in self.special:
            whole |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        # Every text begins on a line of its own: its first word is known as one after a line feed, whose id goes again.
        lines = pc.replace_substring(pc.binary_join_element_wise(pa.scalar(""), texts, "\n"), "\n", " \n")
        parts = pc.split_pattern(lines, " ")
        coded = parts.flatten().dictionary_encode()
        of_word = coded.indices.to_numpy()
        # Nothing stands before the space of the first line.
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy())])
        first, many, table = self._looked_up(coded.dictionary)
        bad = (many == 0)[of_word]
        bad[starts[:-1]] = False
        whole |= np.add.reduceat(bad, starts[:-1]) > 0
        first, many = first[of_word], many[of_word]
        ends = np.cumsum(many)
        flat = table[np.repeat(first - (ends - many), many) + np.arange(ends[-1])]
        # In place of the line feed that begins a text, the text before it ends.
        last = np.concatenate([[0], ends])[starts]
        end = np.array([END], self.kind)
        shifted = np.concatenate([flat[1:], end])
        closed = last[1:][last[1:] > last[:-1]] - 1
        shifted[closed] = END
        return [
            (np.concatenate([self.ids(texts[i].as_py()), end]) if alone else shifted[lo:hi]).tobytes()
            for i, (alone, lo, hi) in enumerate(zip(whole.tolist(), last[:-1].tolist(), last[1:].tolist(), strict=True))
        ]


_WORDS: dict[str, _Words] = {}


def _words(tokenizer_file: str) -> _Words:
    """Those of this Python worker, which outlives its tasks."""
    if tokenizer_file not in _WORDS:
        _WORDS[tokenizer_file] = _Words(tokenizer_file)
    return _WORDS[tokenizer_file]


def tokenise(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """Rows of kind 0: doc_id, n tokens and their ids; of kind 1: a token id in ``doc_id`` and how often this task saw it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer_file)
        kind, size = words.kind, words.size
        counts = np.zeros(size, np.int64)
        for batch in batches:
            coded = words.documents(batch.column(1))
            flat = np.frombuffer(b"".join(coded), kind)
            counts += np.bincount(flat, minlength=size)
            n = [len(c) // kind.itemsize for c in coded]
            columns = [pa.array([0] * len(n), pa.int32()), batch.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "doc_id", "n", "ids"])
        seen = np.flatnonzero(counts)
        columns = [np.ones(len(seen), np.int32), seen.astype(np.int64), counts[seen]]
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.nulls(len(seen), pa.binary())], names=["kind", "doc_id", "n", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "kind int, doc_id long, n long, ids binary")


def write_token_files(docs: DataFrame, tokenizer_file: str, file_tokens: int = 4 << 20) -> DataFrame:
    """Write the tokens of all documents in order of id, and the frequency table beside them. Returns the paths of the files,
    which are all that reading needs."""
    spark = docs.sparkSession
    coded = kept(tokenise(docs, tokenizer_file), "token-ids")
    # One row per token of the vocabulary.
    seen = coded.where("kind = 1").groupBy("doc_id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max([r.doc_id + 1 for r in seen], default=1), np.int64)
    for r in seen:
        counts[r.doc_id] = r.n
    if not len(seen):
        return spark.createDataFrame([], "path string")
    freq, folder = quantise(counts), new_path(spark, "token-files")
    kind = _words(tokenizer_file).kind
    shared = spark.sparkContext.broadcast(freq)

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            write_named(folder, _TABLE, encode_table(shared.value))
            yield batch

    # By a task, since the driver may see the shared folder by another path; the file is the same however often it is written.
    spark.range(1).coalesce(1).mapInArrow(save, "id long").count()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        doc_ids, coded_ids, size = [], [], 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(coded_ids), kind)
            data = encode_file(doc_ids, [len(c) // kind.itemsize for c in coded_ids], ids, shared.value, (part, number))
            return pa.RecordBatch.from_pydict({"path": [write_file(folder, ".tokens", data)]})

        for batch in batches:
            for doc_id, n, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc_ids.append(doc_id)
                coded_ids.append(ids)
                size += n
                if size >= 2 * file_tokens:
                    yield close()
                    doc_ids, coded_ids, size, number = [], [], 0, number + 1
        if doc_ids:
            yield close()

    parts = max(1, int(counts.sum()) // file_tokens, spark.sparkContext.defaultParallelism)
    # Ids that repeat are spread by what they hold.
    rows = coded.where("kind = 0").select("doc_id", "n", "ids")
    rows = rows.withColumn("tie", F.xxhash64("ids")).repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    return kept(rows.mapInArrow(write, "path string"), "token-file-list")


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of every document, from the files at the paths in ``files``."""

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                size = head_size(read_file(path, 0, 12))
                found.append(json.loads(read_file(path, 12, size)))
            columns = [batch.column(0), *(pa.array([h["place"][k] for h in found], pa.int32()) for k in range(2)), pa.array([h["ids"] for h in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "part", "number", "tokens"])

    n = min(4096, max(1, files.count()))
    spread = files.select("path").repartition(n)
    # A row per file of millions of tokens: few enough for one task.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = spread.mapInArrow(heads, "path string, part int, number int, tokens long")
    placed = placed.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                beside = f"{path.rsplit('/', 1)[0]}/{_TABLE}"
                if beside not in tables:
                    freq = decode_table(read_file(beside))
                    tables[beside] = freq, np.repeat(np.arange(len(freq), dtype=np.uint16 if len(freq) <= 1 << 16 else np.uint32), freq.astype(np.int64))
                doc_ids, lengths, ids = decode_file(read_file(path), *tables[beside])
                data, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(lengths.astype(np.int64))
                starts = ends - lengths
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [pa.array(doc_ids, pa.int64()), pa.array(starts + first), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
