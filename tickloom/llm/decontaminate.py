"""Benchmark decontamination by a distributed positional inverted index.

A window is ``width`` consecutive words of a test item (the whole item if it is
shorter).  The index keeps, for the terms asked of it, one posting per
occurrence in the training texts: term, document, position and, for lead terms,
the hashes of the words around it.

1. One pass over the training texts counts every test term.
2. Each window names its two rarest terms; only their postings are stored.
3. The two lists are adjusted by the terms' offsets and intersected; what is
   left is compared with the whole window by the stored context.

The test vocabulary and the probes are broadcast while they are at most
``VOCABULARY_BYTES`` each; beyond that every training term is counted and
posted, and joins pick the wanted ones.

Edge cases: null, empty or wordless texts have no words, no windows and no hit.
Items without an id are named by the empty string; an id that repeats counts
once.  Rows may lack a doc_id or share one: they are told apart by id and text.
Empty tables give no matches; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.runtime import plain
from tickloom.llm.textwords import ALNUM, chunks, dictionary_hashes, split_words
from tickloom.storage import stored

VOCABULARY_BYTES = 32 << 20


def _windows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            words = split_words(batch.column("text"), ALNUM)
            hashes = words.hashes()
            terms = words.dictionary.to_pylist()
            items, grams, lists = [], [], []
            for item, start, end in zip(batch.column("item_id").to_pylist(), words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
                for at in range(start, max(end - width, start) + 1 if end > start else start):
                    stop = min(at + width, end)
                    items.append(item)
                    grams.append(hashes[at:stop].tobytes())
                    lists.append([terms[c] for c in words.codes[at:stop]])
            yield pa.record_batch({"item_id": pa.array(items, pa.string()), "gram": pa.array(grams, pa.binary()), "terms": pa.array(lists, pa.list_(pa.string()))})

    return run


def _known(dictionary: pa.Array, terms: pa.Array | None) -> np.ndarray:
    """The place of each word among the terms, or -1."""
    if terms is None:
        return np.arange(len(dictionary))
    return np.asarray(pc.fill_null(pc.index_in(dictionary, value_set=terms), -1).to_numpy(zero_copy_only=False), np.int64)


def _unpacked(blob) -> pa.Array | None:
    return None if blob is None else pa.ipc.open_stream(blob.value).read_all().column(0).combine_chunks()


def _packed(spark, words: list[str] | None, *more: list):
    if words is None:
        return None
    sink = pa.BufferOutputStream()
    arrays = [pa.array(words, pa.large_string()), *(pa.array(m) for m in more)]
    rows = pa.record_batch(arrays, [str(i) for i in range(len(arrays))])
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_batch(rows)
    return spark.sparkContext.broadcast(sink.getvalue().to_pybytes())


def _counts(blob):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _unpacked(blob)
        total = np.zeros(0 if terms is None else len(terms), np.int64)
        for batch in chunks(batches):
            words = split_words(batch.column("text"), ALNUM)
            times = np.bincount(words.codes, minlength=len(words.dictionary))
            if terms is None:
                yield pa.record_batch({"term": words.dictionary.cast(pa.string()), "times": pa.array(times, pa.int64())})
            else:
                at = _known(words.dictionary, terms)
                total[at[at >= 0]] += times[at >= 0]
        if terms is not None and total.any():
            yield pa.record_batch({"term": terms.filter(pa.array(total > 0)).cast(pa.string()), "times": pa.array(total[total > 0])})

    return run


_POSTINGS = "key long, doc_id long, n_words long, term string, place int, context binary"


def _postings(blob, width: int):
    """One row per document (term null) and one per posting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _unpacked(blob)
        leads = None if blob is None else np.asarray(pa.ipc.open_stream(blob.value).read_all().column(1).combine_chunks().to_numpy(zero_copy_only=False), bool)
        names = ["key", "doc_id", "n_words", "term", "place", "context"]
        for batch in chunks(batches):
            words = split_words(batch.column("text"), ALNUM)
            n = batch.num_rows
            yield pa.record_batch([batch.column("key"), batch.column("doc_id"), pa.array(words.counts, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
            at = _known(words.dictionary, terms)
            spots = np.flatnonzero(at[words.codes] >= 0)
            step = 1 << 17
            for low in range(0, len(spots), step):
                here = spots[low : low + step]
                owner = np.searchsorted(words.bounds, here, side="right") - 1
                term = at[words.codes[here]]
                lead = np.ones(len(here), bool) if leads is None else leads[term]
                # the words around each lead; beyond the text's ends, zero
                around = here[lead][:, None] + np.arange(1 - width, width)
                inside = (around >= words.bounds[owner[lead]][:, None]) & (around < words.bounds[owner[lead] + 1][:, None])
                codes = words.codes[np.where(inside, around, 0)]
                used, back = np.unique(codes, return_inverse=True)
                hashed = dictionary_hashes(words.dictionary.take(pa.array(used)))[back.reshape(codes.shape)] if len(used) else np.zeros(codes.shape, np.uint64)
                rows = np.ascontiguousarray(np.where(inside, hashed, np.uint64(0)))
                size = rows.shape[1] * 8
                contexts = np.empty(len(here), object)
                contexts[lead] = [r.tobytes() for r in rows] if len(rows) else []
                assert size == (2 * width - 1) * 8
                k = len(here)
                keys = np.asarray(batch.column("key"))[owner]
                yield pa.record_batch(
                    [pa.array(keys), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), words.dictionary.take(pa.array(words.codes[here])).cast(pa.string()), pa.array((here - words.bounds[owner]).astype(np.int32)), pa.array(contexts.tolist(), pa.binary())],
                    names,
                )

    return run


class PositionalIndex:
    """Postings of the training texts for the windows of a benchmark (item_id, text)."""

    def __init__(self, documents: DataFrame, benchmark: DataFrame, width: int = 13, vocabulary_bytes: int = VOCABULARY_BYTES):
        spark = documents.sparkSession
        self.width, self.vocabulary_bytes = width, vocabulary_bytes
        texts = plain(documents, doc_id="long", text="string")
        texts = texts.withColumn("key", F.xxhash64("doc_id", "text"))
        items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text"))
        rows = stored(items.mapInArrow(_windows(width), "item_id string, gram binary, terms array<string>"), "test-windows")
        #: gram, item_id
        self.items = rows.select("gram", "item_id").distinct()
        grams = rows.select("gram", "terms").dropDuplicates(["gram"])
        spread = grams.select("gram", F.posexplode("terms").alias("offset", "term"))
        words = spread.select("term").distinct()
        size = words.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0
        whole = size > vocabulary_bytes
        vocabulary = None if whole else _packed(spark, [r.term for r in words.collect()])
        counts = texts.select("text").mapInArrow(_counts(vocabulary), "term string, times long").groupBy("term").agg(F.sum("times").alias("times"))
        # one row a term of the vocabulary, which is within its bytes unless it is whole; a frequent term isn't one task then
        ranked = spread.join(counts if whole else F.broadcast(counts), "term", "left").groupBy("gram").agg(F.count("*").alias("n"), F.min(F.coalesce("times", F.lit(0))).alias("least"), F.min(F.struct("times", "term", "offset")).alias("one"), F.array_sort(F.collect_list(F.struct("times", "term", "offset"))).alias("all"))
        two = F.coalesce(F.try_element_at("all", F.lit(2)), F.col("one"))
        #: gram, n, and the two rarest terms with their offsets; windows with an unseen term can't occur
        self.probes = stored(ranked.where("least > 0").select("gram", "n", F.col("one.term").alias("term"), F.col("one.offset").alias("offset"), two["term"].alias("term2"), two["offset"].alias("offset2")), "test-probes")
        if whole:
            blob = None
        else:
            asked = self.probes.select("term", F.lit(True).alias("lead")).unionByName(self.probes.select(F.col("term2").alias("term"), F.lit(False).alias("lead"))).groupBy("term").agg(F.max("lead").alias("lead")).collect()
            blob = _packed(spark, [r.term for r in asked], [r.lead for r in asked] or pa.array([], pa.bool_()))
        index = stored(texts.mapInArrow(_postings(blob, width), _POSTINGS), "postings")
        #: key, doc_id, n_words
        self.documents = index.where("term is null").select("key", "doc_id", "n_words")
        #: term, key, place, context
        self.postings = index.where("term is not null").select("term", "key", "place", "context")

    def _probes(self) -> DataFrame:
        """The probes, broadcast while they are small, so that one frequent term isn't one task."""
        small = self.probes.count() * (8 * self.width + 120) <= self.vocabulary_bytes
        return F.broadcast(self.probes) if small else self.probes

    def near(self, slop: int = 0) -> DataFrame:
        """Where a window's two rarest terms lie as far apart as in it, give or take ``slop``: gram, n, key, start, gap, context."""
        lead = self.postings.join(self._probes(), "term").select("gram", "n", "key", (F.col("place") - F.col("offset")).alias("start"), "place", "context", "offset", "term2", "offset2")
        other = self.postings.select(F.col("term").alias("term2"), F.col("key"), F.col("place").alias("place2"))
        gap = F.col("place2") - F.col("offset2") - F.col("start")
        if slop == 0:
            other = other.withColumn("adjusted", F.col("place2"))
            lead = lead.withColumn("adjusted", F.col("start") + F.col("offset2"))
            both = lead.join(other, ["term2", "key", "adjusted"])
        else:
            both = lead.join(other, ["term2", "key"]).where(F.abs(gap) <= slop)
        return both.select("gram", "n", "key", "start", gap.alias("gap"), "context", "offset")

    def phrases(self) -> DataFrame:
        """Every place of every window: gram, n, key, start."""
        found = self.near().where(F.expr(f"substring(context, ({self.width - 1} - offset) * 8 + 1, n * 8) = gram"))
        return found.select("gram", F.col("n").cast("int").alias("n"), "key", "start").distinct()

    def judged(self, share: int = 20) -> DataFrame:
        """Each document's hit words and items; contaminated if a ``share``-th of its words is hit."""
        phrases = stored(self.phrases(), "test-phrases")
        by_start = Window.partitionBy("key").orderBy("start", "n")
        before = F.max(F.col("start") + F.col("n")).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
        end = F.col("start") + F.col("n")
        hits = phrases.select("key", "start", "n").distinct().select("key", F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(before, F.lit(0)))).alias("new"))
        hits = hits.groupBy("key").agg(F.sum("new").cast("long").alias("n_hit"))
        names = phrases.select("key", "gram").distinct().join(self.items, "gram").groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
        out = self.documents.join(hits.join(names, "key"), "key", "left")
        n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
        items = F.coalesce("items", F.array().cast("array<string>"))
        return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"), ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"), "key")
