"""Language identification of words, spans and documents.

* Scripts: each word has the script of its letters, by fixed code point ranges.
  A language keeps the scripts that make up ``SCRIPT_SHARE`` of its words at
  least; a word's candidates are the languages that keep its script, or all if
  none does, as for letters of a script that isn't listed.
* Word scores: the mean log probability of a word's byte n-grams and of the
  word itself under each language, times its length.  The counts behind them
  come from all documents that may be learnt from, added up in a table of
  fixed size per language.
* Viterbi: the labels of a text's words maximise their scores less ``SWITCH``
  for every change of language.  All texts of a chunk advance together.

A text's language is the one that labels most of its letters; its score is that
language's share of them.

Edge cases: a text that is null or has no letter is ``und`` with score 0.  Null
languages and texts teach nothing; rows without doc_id are judged like others.
Ties go to the language that sorts first.  Without any example all is ``und``.
Repeated rows are judged alike; a very long text is one text; an empty table gives
no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.runtime import merge_sketches, plain, sketch_rows
from tickloom.llm.textwords import ALNUM, chunks, dictionary_hashes, mixed, split_words, text_bytes

# First code points of the scripts' ranges, in order; 0 is no letter of any listed script.
SCRIPT_STARTS = (0x0, 0x41, 0x5B, 0x61, 0x7B, 0xC0, 0x250, 0x370, 0x400, 0x530, 0x590, 0x600, 0x750, 0x900, 0x980, 0xE00, 0xE80, 0x10A0, 0x1100, 0x1200, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD7B0)
SCRIPT_NAMES = ("", "Latin", "", "Latin", "", "Latin", "", "Greek", "Cyrillic", "", "Hebrew", "Arabic", "", "Devanagari", "", "Thai", "", "Georgian", "Hangul", "", "Latin", "Greek", "", "Kana", "", "Han", "", "Hangul", "")
SCRIPTS = tuple(dict.fromkeys(SCRIPT_NAMES))

CELLS = 1 << 16
WIDTH = CELLS + 64
GRAMS = (1, 2, 3, 4)
SMOOTHING = 0.1
SCRIPT_SHARE = 0.001
SWITCH = 12.0
UNKNOWN = "und"


def word_scripts(words: pa.Array) -> np.ndarray:
    """The script of each word: an index of SCRIPTS, the highest one of its letters."""
    points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.asarray(pc.utf8_length(words), np.int64)
    index = np.array([SCRIPTS.index(n) for n in SCRIPT_NAMES])
    script = index[np.searchsorted(SCRIPT_STARTS, points, side="right") - 1]
    out = np.zeros(len(sizes), np.int64)
    filled = sizes > 0
    if filled.any():
        out[filled] = np.maximum.reduceat(script, (np.cumsum(sizes) - sizes)[filled])
    return out


def word_cells(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The cells of all n-grams of all words and of the words themselves, and the word of each."""
    marked = pc.binary_join_element_wise(pa.scalar("^", pa.large_string()), words, pa.scalar("$", pa.large_string()), pa.scalar("", pa.large_string()))
    offsets, data = text_bytes(marked)
    n = len(data)
    word = np.repeat(np.arange(len(words)), np.diff(offsets))
    end = offsets[1:][word]
    place = np.arange(n)
    value = np.zeros(n, np.uint64)
    cells, owners = [], []
    for k in range(1, max(GRAMS) + 1):
        value = value[: n - k + 1] * np.uint64(257) + data[k - 1 :].astype(np.uint64) + np.uint64(1)
        if k in GRAMS:
            inside = place[: n - k + 1] + k <= end[: n - k + 1]
            cells.append((mixed(value[inside] + np.uint64(k << 48)) & np.uint64(CELLS - 1)).astype(np.int64))
            owners.append(word[: n - k + 1][inside])
    cells.append((mixed(dictionary_hashes(words)) & np.uint64(CELLS - 1)).astype(np.int64))
    owners.append(np.arange(len(words)))
    return np.concatenate(cells), np.concatenate(owners)


def have_letters(words: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.match_substring_regex(words, r"\pL"), False).to_numpy(zero_copy_only=False), bool)


@dataclass
class LanguageModel:
    """Per language: log probabilities of cells, and whether it keeps each script."""

    names: list[str]
    logs: np.ndarray
    scripts: np.ndarray

    @classmethod
    def of_counts(cls, names: list[str], counts: np.ndarray) -> LanguageModel:
        grams, scripts = counts[:, :CELLS].astype(float), counts[:, CELLS : CELLS + len(SCRIPTS)].astype(float)
        logs = np.log((grams + SMOOTHING) / (grams.sum(axis=1, keepdims=True) + SMOOTHING * CELLS))
        return cls(names, logs.astype(np.float32), scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1))

    def scores(self, words: pa.Array) -> np.ndarray:
        """The score of each word in each language, relative to its best; -inf where its script rules it out."""
        cells, owner = word_cells(words)
        held = np.bincount(owner, minlength=len(words))
        out = np.stack([np.bincount(owner, weights=row[cells], minlength=len(words)) for row in self.logs], axis=1)
        out *= (np.asarray(pc.utf8_length(words), float) / np.maximum(held, 1))[:, None]
        out -= out.max(axis=1, keepdims=True)
        script = word_scripts(words)
        fits = self.scripts[:, script].T
        fits[~fits.any(axis=1)] = True
        out[~fits] = -np.inf
        out[~have_letters(words)] = 0.0
        out -= out.max(axis=1, keepdims=True)
        return out


def viterbi(codes: np.ndarray, bounds: np.ndarray, scores: np.ndarray, switch: float) -> np.ndarray:
    """The best label of every word; ``scores`` has a row for each code."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    starts, sizes = bounds[:-1][order], sizes[order]
    labels = np.zeros(len(codes), np.int16)
    if not len(order):
        return labels
    n = scores.shape[1]
    scores = np.maximum(scores, -1e6)
    longest = int(sizes[0])
    # texts still running at each step: a prefix, as they are sorted by length
    running = len(sizes) - np.searchsorted(sizes[::-1], np.arange(longest), side="right")
    came = np.empty((len(codes), n), bool)
    source = np.empty(len(codes), np.int16)
    value = scores[codes[starts]]
    last = np.empty((len(sizes), n))
    for at in range(1, longest):
        k = running[at]
        if k < len(value):
            last[k : len(value)] = value[k:]
            value = value[:k]
        word = starts[:k] + at
        best = value.argmax(axis=1)
        bar = value[np.arange(k), best][:, None] - switch
        came[word] = value < bar
        source[word] = best
        value = np.maximum(value, bar) + scores[codes[word]]
    last[: len(value)] = value
    label = last.argmax(axis=1)
    for at in range(longest - 1, -1, -1):
        k = running[at]
        word = starts[:k] + at
        labels[word] = label[:k]
        if at:
            label[:k] = np.where(came[word, label[:k]], source[word], label[:k])
    return labels


def _counts(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), WIDTH), np.uint64)
        for batch in chunks(batches):
            words = split_words(batch.column("text"), ALNUM)
            lower = pc.utf8_lower(words.dictionary.cast(pa.large_string()))
            lang = np.asarray(pc.index_in(batch.column("lang"), value_set=pa.array(names)), np.int64)
            cells, owner = word_cells(lower)
            script = word_scripts(lower)
            taught = lang[words.owner()]
            for k in np.unique(taught):
                times = np.bincount(words.codes[taught == k], minlength=len(lower)).astype(float)
                total[k, :CELLS] += np.bincount(cells, weights=times[owner], minlength=CELLS).astype(np.uint64)
                total[k, CELLS:] += np.bincount(script, weights=times, minlength=WIDTH - CELLS).astype(np.uint64) * (np.arange(WIDTH - CELLS) > 0).astype(np.uint64)
        yield sketch_rows(total.ravel(), len(names))

    return run


def train(documents: DataFrame, learnable: Column | None = None) -> LanguageModel:
    """A model from all rows of (text, lang) that ``learnable`` allows."""
    if learnable is not None:
        documents = documents.where(learnable)
    rows = plain(documents, text="string", lang="string").dropna()
    names = sorted(r.lang for r in rows.select("lang").distinct().collect())
    if not names:
        return LanguageModel([], np.empty((0, CELLS), np.float32), np.empty((0, len(SCRIPTS)), bool))
    counts = np.zeros((len(names), WIDTH), np.uint64)
    for part, cells in merge_sketches(rows.mapInArrow(_counts(names), "part int, cells binary"), len(names), "uint64").collect():
        counts[part] = np.frombuffer(zlib.decompress(cells), np.uint64)
    return LanguageModel.of_counts(names, counts)


def label(documents: DataFrame, model: LanguageModel, switch: float = SWITCH, with_spans: bool = True) -> DataFrame:
    """doc_id, lang_pred, score, and spans: array of (first word, end word, lang)."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.names, UNKNOWN], object)
        for batch in chunks(batches):
            texts = batch.column("text")
            words = split_words(texts, ALNUM)
            lower = pc.utf8_lower(words.dictionary.cast(pa.large_string()))
            n = len(texts)
            letters = have_letters(texts) & bool(known.names)
            if known.names:
                labels = viterbi(words.codes, words.bounds, known.scores(lower), switch)
                weight = np.where(have_letters(lower), np.asarray(pc.utf8_length(lower), np.int64), 0)[words.codes]
                # words without letters count only if nothing else does
                votes = np.bincount(words.owner() * len(known.names) + labels, weights=weight + 1e-6, minlength=n * len(known.names)).reshape(n, -1)
                best = np.where(letters, votes.argmax(axis=1), len(known.names))
                score = np.where(letters, votes.max(axis=1) / np.maximum(votes.sum(axis=1), 1e-9), 0.0)
            else:
                labels, best, score = np.zeros(len(words.codes), np.int16), np.zeros(n, np.int64), np.zeros(n)
            columns = [batch.column("doc_id"), pa.array(names[best].tolist(), pa.string()), pa.array(score)]
            if with_spans:
                new = np.ones(len(labels), bool)
                new[1:] = labels[1:] != labels[:-1]
                new[words.bounds[:-1][words.counts > 0]] = True
                first = np.flatnonzero(new)
                end = np.append(first[1:], len(labels))
                owner = np.searchsorted(words.bounds, first, side="right") - 1
                shift = words.bounds[owner]
                flat = pa.StructArray.from_arrays([pa.array((first - shift).astype(np.int32)), pa.array((end - shift).astype(np.int32)), pa.array(names[labels[first]].tolist(), pa.string())], fields=list(span))
                columns.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(first, words.bounds), pa.int32()), flat))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "spans"][: len(columns)])

    schema = "doc_id long, lang_pred string, score double" + ", spans array<struct<start:int,end:int,lang:string>>" * with_spans
    return plain(documents, doc_id="long", text="string").mapInArrow(run, schema)


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold
