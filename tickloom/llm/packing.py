"""Packing by minimum bin slack over the counts of remaining lengths.

A document is the ids of its text and an end id.  Its whole windows of
``capacity`` ids are sequences of their own; what remains is one piece, never
cut again.  Only the number of pieces of each length matters for the plan, so
the driver sees at most ``capacity`` counts whatever the corpus:

* The longest remaining length opens a window.  A bitset subset-sum dynamic
  programme over the remaining lengths and their counts finds the filling
  closest to capacity (or to a power of two, which isn't padded, if nothing
  fits exactly); backtracking gives the multiset, which is used as often as the
  counts allow.
* A piece gets its place from its rank among the pieces of its length.  Ranks
  are counted within salts of each length, as many as its count fills, and
  shifted by the salts' totals, so that a length shared by a third of all rows
  isn't one task.

Edge cases: null and empty texts are the end id alone.  A repeated row is a
document of its own; rows that tie are alike and may swap places.  An empty
table gives no rows, and extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.runtime import plain
from tickloom.llm.textwords import RAW, chunks, dictionary_hashes, split_words
from tickloom.storage import stored

#: Pieces of one length that are ranked in one group, and the share of all pieces that is.
SALT_ROWS = 100_000
SHARES = 256
#: Words whose ids a worker keeps; it starts anew beyond them.
CACHE_WORDS = 2_000_000
#: Words given to the tokenizer at a time; each takes about a kilobyte until its ids are read.
ENCODE_WORDS = 4096

_CACHES: dict[str, _WordIds] = {}


class _WordIds:
    """Ids of blank-separated words, kept per worker as flat arrays.

    The tokenizer drops white space, no pattern of it crosses one and none of
    its special strings holds one, so a text's ids are those of its words in turn.
    """

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.forget()

    def forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.starts = np.empty(0, np.int32)
        self.sizes = np.empty(0, np.int32)
        self.ids = np.empty(0, np.uint32)

    def lookup(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The first index in ``ids`` and the number of ids of each word."""
        keys = dictionary_hashes(words)
        at = np.searchsorted(self.keys, keys)
        found = (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == keys) if len(self.keys) else np.zeros(len(keys), bool)
        if not found.all():
            if len(self.keys) > CACHE_WORDS:
                self.forget()
                found[:] = False
            sizes, ids = self._encoded(words.filter(pa.array(~found)))
            starts = (len(self.ids) + np.cumsum(sizes) - sizes).astype(np.int32)
            # new keys go in between; the words of a dictionary are all different
            order = np.argsort(keys[~found])
            fresh = keys[~found][order]
            place = np.searchsorted(self.keys, fresh)
            self.keys = np.insert(self.keys, place, fresh)
            self.starts = np.insert(self.starts, place, starts[order])
            self.sizes = np.insert(self.sizes, place, sizes[order])
            self.ids = np.concatenate([self.ids, ids])
            at = np.searchsorted(self.keys, keys)
        return self.starts[at], self.sizes[at]


    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        sizes, ids = [], []
        for low in range(0, len(words), ENCODE_WORDS):
            lists = [e.ids for e in self.tokenizer.encode_batch(words.slice(low, ENCODE_WORDS).to_pylist(), add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, lists), np.int32, len(lists)))
            ids.append(np.fromiter((i for one in lists for i in one), np.uint32, int(sizes[-1].sum())))
        return np.concatenate(sizes), np.concatenate(ids)


def document_ids(texts: pa.Array, tokenizer: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, each closed by the end id, and their bounds."""
    cache = _CACHES.get(tokenizer)
    if cache is None:
        cache = _CACHES[tokenizer] = _WordIds(tokenizer)
    words = split_words(texts, RAW)
    starts, sizes = cache.lookup(words.dictionary)
    starts, sizes = starts[words.codes].astype(np.int64), sizes[words.codes].astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    n = len(words.bounds) - 1
    bounds = upto[words.bounds] + np.arange(n + 1)
    total = int(upto[-1])
    source = np.repeat(starts - upto[:-1], sizes) + np.arange(total)
    out = np.full(total + n, end_id, np.uint32)
    body = np.ones(total + n, bool)
    body[bounds[1:] - 1] = False
    out[body] = cache.ids[source]
    return out, bounds


def _pieces(tokenizer: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            ids, bounds = document_ids(batch.column("text"), tokenizer, end_id)
            raw = memoryview(ids.astype("<u4").tobytes())
            sizes = np.diff(bounds)
            pieces = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), pieces)
            start = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
            length = np.minimum(sizes[owner] - start, capacity)
            first = (bounds[:-1][owner] + start) * 4
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(first.tolist(), (first + 4 * length).tolist(), strict=True)]
            yield pa.record_batch(
                [batch.column("doc_id").take(pa.array(owner)), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(sizes[owner], pa.int64())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return run


def _fill(counts: dict[int, int], lengths: list[int], room: int, used: int) -> list[tuple[int, int]]:
    """The multiset of lengths that leaves the least padding in ``room``; ``used`` is filled already."""
    reach, goal, stages = 1, 1 << room, []
    for length in lengths:
        if length > room or not counts[length]:
            continue
        before, times = reach, min(counts[length], room // length)
        step = 1
        while times:  # doubling: any number of copies up to times
            step = min(step, times)
            reach |= reach << (step * length)
            times -= step
            step *= 2
        reach &= (goal << 1) - 1
        stages.append((length, before))
        if reach & goal:
            break
    if reach & goal:
        total = room
    else:
        total = reach.bit_length() - 1
        bare = [p - used for p in (1 << k for k in range(room.bit_length() + 1, 0, -1)) if 0 <= p - used <= room and reach >> (p - used) & 1]
        total = bare[0] if bare else total
    out = []
    for length, before in reversed(stages):
        times = 0
        while not before >> (total - times * length) & 1:
            times += 1
        if times:
            out.append((length, times))
            total -= times * length
    return out


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Fillings (lengths with their times) and how often each is used; every piece is used once."""
    counts = {k: v for k, v in counts.items() if v}
    lengths = sorted(counts, reverse=True)
    out = []
    for longest in lengths:
        while counts[longest]:
            counts[longest] -= 1
            filling = dict(_fill(counts, lengths, capacity - longest, longest))
            counts[longest] += 1
            filling[longest] = filling.get(longest, 0) + 1
            often = min(counts[k] // v for k, v in filling.items())
            for k, v in filling.items():
                counts[k] -= often * v
            out.append((sorted(filling.items(), reverse=True), often))
        lengths = [k for k in lengths if counts[k]]
    return out


def _slots(fillings: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """length, first rank, times a sequence, first sequence, offset: one row per length of a filling."""
    rows, ranks, sequence = [], {}, 0
    for filling, often in fillings:
        offset = 0
        for length, times in filling:
            rows.append((length, ranks.get(length, 0), times, sequence, offset))
            ranks[length] = ranks.get(length, 0) + times * often
            offset += length * times
        sequence += often
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(slots, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(slots.value, np.int64).reshape(-1, 5)
        first = np.searchsorted(table[:, 0], np.arange(capacity + 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            order = np.lexsort((rank, length))
            at = np.empty(len(order), np.int64)
            for value in np.unique(length):
                here = order[np.searchsorted(length[order], value) : np.searchsorted(length[order], value, side="right")]
                low, high = first[value], first[value + 1]
                at[here] = low + np.searchsorted(table[low:high, 1], rank[here], side="right") - 1
            base = rank - table[at, 1]
            times = table[at, 2]
            yield pa.record_batch(
                [*(batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")), pa.array(table[at, 3] + base // times), pa.array(table[at, 4] + base % times * length)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return run


def pack(documents: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 2, capacity: int = 4096) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` names a file of the installed public vocabularies.
    """
    spark = documents.sparkSession
    rows = plain(documents, doc_id="long", text="string")
    pieces = stored(rows.mapInArrow(_pieces(tokenizer, end_id, capacity), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"), "pieces")
    # at most ``capacity`` rows
    lengths = stored(pieces.groupBy("length").agg(F.count("*").alias("pieces")), "piece-lengths")
    of_length = {r.length: r.pieces for r in lengths.collect()}
    slots = spark.sparkContext.broadcast(_slots(plan(of_length, capacity)).tobytes())
    most = max(1, min(SALT_ROWS, sum(of_length.values()) // SHARES))
    salts = lengths.select("length", F.ceil(F.col("pieces") / most).alias("salts"))
    salted = pieces.join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("salts")))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("pieces"))
    shift = counts.select("length", "salt", (F.sum("pieces").over(Window.partitionBy("length").orderBy("salt")) - F.col("pieces")).alias("shift"))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32"))
    ranked = salted.withColumn("own", own).join(shift, ["length", "salt"]).withColumn("rank", F.col("shift") + F.col("own") - 1)
    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(_place(slots, capacity), out)
