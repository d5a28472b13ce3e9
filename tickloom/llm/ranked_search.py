"""Ranked lexical search by Fagin's threshold algorithm over shards of an impact index.

1. One pass over the texts writes the forward index: each document's length and its
   frequencies of the query terms.  Document and term counts come from it by SQL.
2. A task reads documents of the forward index in shards of bounded size.  In each
   shard it sorts every query term's list by impact, falling, and for every item
   reads its lists in turn, a step of each at a time.  Documents met for the first
   time are looked up in the forward index and scored whole.
3. The threshold is the sum of the impacts last read: no document unseen scores
   more.  An item is done when its threshold is strictly below the k-th best score
   (documents that tie with it may still have a smaller doc_id), or at the lists'
   ends.  The best k go along from shard to shard of a task, so that later shards
   stop after a few steps.
4. The best k of all tasks' best k are the result, cut before and after one shuffle.

Items are taken in blocks of at most ``BLOCK_BYTES`` of text (or one item), a pass
each, and only a block's terms and weights are sent to the tasks.

Edge cases: null, empty or wordless texts and items have no terms; such documents
don't count among N and are never found, such items have no rows.  Every row of
``documents`` is a document; rows that repeat an id are ranked one by one, and a
missing doc_id loses ties.  An item that repeats with its text counts once; items
that share an id but not the text have a ranking each.  Terms that no document holds
score nothing.  Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.runtime import plain
from tickloom.llm.textwords import ALNUM, chunks, split_words
from tickloom.storage import stored

#: Text of the items whose terms are held by a task at a time.
BLOCK_BYTES = 8 << 20
#: Postings of a shard.
SHARD_POSTINGS = 1 << 20
#: Postings that are first read of each list; doubled at each turn.
FIRST_STEP = 32

_FORWARD = "doc_id long, n long, terms array<int>, times array<int>"
_BEST = "item long, doc_id long, score long"


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each item."""
    for batch in chunks(batches):
        words = split_words(batch.column("text"), ALNUM)
        owner, code = np.unique(np.stack([words.owner(), words.codes]), axis=1)
        yield pa.record_batch({"item": batch.column("item").take(pa.array(owner)), "term": words.dictionary.take(pa.array(code)).cast(pa.string())})


def _forward(vocabulary: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(vocabulary.value, pa.large_string())
        size = max(len(terms), 1)
        for batch in chunks(batches):
            words = split_words(batch.column("text"), ALNUM)
            known = np.asarray(pc.fill_null(pc.index_in(words.dictionary, value_set=terms), -1).to_numpy(zero_copy_only=False), np.int64)
            at = known[words.codes]
            held = at >= 0
            pair, times = np.unique(words.owner()[held] * size + at[held], return_counts=True)
            ends = np.searchsorted(pair, np.arange(batch.num_rows + 1) * size).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (pair % size, times)]
            rows = pa.record_batch([batch.column("doc_id"), pa.array(words.counts, pa.int64()), *lists], ["doc_id", "n", "terms", "times"])
            yield rows.filter(pa.array(words.counts > 0))

    return run


def impacts(weight: np.ndarray, times: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to the score of a document of a length that holds it so many times; all in 64-bit integers."""
    m = 50 + 50 * lengths * n_docs // n_terms
    return weight * (1_000_000_000 * times // (1000 * times + 20 * m))


def best_first(score: np.ndarray, doc: np.ndarray, missing: np.ndarray, k: int) -> np.ndarray:
    """The places of the k best: highest score, then smallest id, missing ids last."""
    return np.lexsort((doc, missing, -score))[:k]


class Shard:
    """Documents in CSR form: the forward index by row, and the lists of each term by falling impact."""

    def __init__(self, ends: np.ndarray, terms: np.ndarray, impact: np.ndarray, size: int):
        self.ends, self.terms, self.impact = ends, terms, impact
        order = np.lexsort((-impact, terms))
        self.rows = (np.searchsorted(ends, order, side="right") - 1).astype(np.int32)
        self.sorted = impact[order]
        self.starts = np.searchsorted(terms[order], np.arange(size + 1))
        self.seen = np.zeros(len(ends) - 1, bool)
        self.asked = np.zeros(size, bool)

    def look_up(self, rows: np.ndarray) -> np.ndarray:
        """The whole scores of documents for the terms that are asked."""
        low, counts = self.ends[rows], self.ends[rows + 1] - self.ends[rows]
        first = np.cumsum(counts) - counts
        at = np.repeat(low - first, counts) + np.arange(counts.sum())
        # every row asked for holds a term
        return np.add.reduceat(np.where(self.asked[self.terms[at]], self.impact[at], 0), first)

    def search(self, terms: np.ndarray, k: int, floor_score: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of all documents that can be among the k best, given the k-th best score so far (0: none)."""
        low, high = self.starts[terms], self.starts[terms + 1]
        found, scores, kth, depth, step = [], [], floor_score, 0, FIRST_STEP
        self.asked[terms] = True
        while True:
            upto = np.minimum(low + depth + step, high)
            counts = np.maximum(upto - (low + depth), 0)
            first = np.cumsum(counts) - counts
            at = np.repeat(low + depth - first, counts) + np.arange(counts.sum())
            met = np.unique(self.rows[at])
            met = met[~self.seen[met]]
            if len(met):
                self.seen[met] = True
                score = self.look_up(met)
                good = score >= max(kth, 1)
                found.append(met[good])
                scores.append(score[good])
                every = np.concatenate(scores)
                if len(every) >= k:
                    kth = max(kth, int(np.partition(every, len(every) - k)[len(every) - k]))
            depth, step = depth + step, 2 * step
            more = upto < high
            threshold = int(self.sorted[upto[more] - 1].sum())
            if not more.any() or (kth and threshold < kth):
                break
        self.asked[terms] = False
        self.seen[:] = False
        empty = np.empty(0, np.int64)
        return np.concatenate(found or [empty]), np.concatenate(scores or [empty])


def _searched(query: Broadcast, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, items, lists, n_docs, n_terms = query.value
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

        def settle(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            column = {name: table.column(name).chunk(0) for name in table.column_names}
            ends = np.asarray(column["terms"].offsets, np.int64)
            terms, times = (np.asarray(column[c].flatten(), np.int64) for c in ("terms", "times"))
            counts = np.diff(ends)
            impact = impacts(weight[terms], times, np.repeat(np.asarray(column["n"]), counts), n_docs, n_terms)
            shard = Shard(ends - ends[0], terms, impact, len(weight))
            ids, missing = np.asarray(column["doc_id"].fill_null(0)), np.asarray(column["doc_id"].is_null())
            for i, asked in enumerate(lists):
                before = best.get(i)
                full = before is not None and len(before[0]) == k
                rows, scores = shard.search(asked, k, int(before[0][-1]) if full else 0)
                if not len(rows):
                    continue
                now = scores, ids[rows], missing[rows]
                both = now if before is None else tuple(np.concatenate(p) for p in zip(before, now, strict=True))
                keep = best_first(*both, k)
                best[i] = tuple(x[keep] for x in both)

        held, size = [], 0
        for batch in batches:
            for start, stop in _slices(np.asarray(pc.list_value_length(batch.column("terms")))):
                part = batch.slice(start, stop - start)
                here = int(pc.sum(pc.list_value_length(part.column("terms"))).as_py() or 0)
                if held and size + here > SHARD_POSTINGS:
                    settle(held)
                    held, size = [], 0
                held.append(part)
                size += here
        if size:
            settle(held)
        for i, (scores, ids, missing) in best.items():
            yield pa.record_batch({"item": pa.array(np.full(len(scores), items[i])), "doc_id": pa.array(ids, mask=missing), "score": pa.array(scores)})

    return run


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most a shard's postings, or one row."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + SHARD_POSTINGS, side="right")))
        yield start, stop
        start = stop


def _blocks(asked: DataFrame) -> int:
    """Into how many blocks items are dealt so that each has at most ``BLOCK_BYTES`` of terms, or one item."""
    n = 1
    while True:
        sizes = asked.groupBy(F.pmod("item", F.lit(n)).alias("block")).agg(F.sum(F.octet_length("term")).alias("bytes"), F.count_distinct("item").alias("items"))
        if sizes.where((F.col("bytes") > BLOCK_BYTES) & (F.col("items") > 1)).limit(1).count() == 0:
            return n
        n *= 2


def _search_block(texts: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """item, doc_id, score: each task's best k of a block of items (item, term)."""
    context = texts.sparkSession.sparkContext
    # at most a block's bytes
    pairs = asked.orderBy("item", "term").collect()
    terms = sorted({r.term for r in pairs})
    place = {term: i for i, term in enumerate(terms)}
    forward = stored(texts.mapInArrow(_forward(context.broadcast(terms)), _FORWARD), "forward")
    n_docs, n_terms = forward.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = np.zeros(len(terms), np.int64)
    for term, df in forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weight[term] = floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))
    lists: dict[int, list[int]] = {}
    for r in pairs:
        lists.setdefault(r.item, []).append(place[r.term])
    query = context.broadcast((weight, list(lists), [np.array(x) for x in lists.values()], n_docs, max(n_terms, 1)))
    return forward.where(F.size("terms") > 0).mapInArrow(_searched(query, k), _BEST)


def search(documents: DataFrame, benchmark: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k highest-scoring documents with a score above 0."""
    texts = plain(documents, doc_id="long", text="string")
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).withColumn("item", F.xxhash64("item_id", "text")).dropDuplicates(["item"])
    items = stored(items, "items")
    asked = stored(items.select("item", "text").mapInArrow(_item_terms, "item long, term string"), "item-terms")
    blocks = _blocks(asked)
    parts = [_search_block(texts, asked.where(F.pmod("item", F.lit(blocks)) == b), k) for b in range(blocks)]
    best = reduce(DataFrame.union, parts)
    by_score = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
