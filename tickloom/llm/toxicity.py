"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples (P) and unlabelled text (U) train a logistic model.
Its risk is  prior * loss(P, +) + max(0, loss(U, -) - prior * loss(P, -)):
the second term is what the negatives cost, corrected for the positives hidden
in U; where it turns negative, the step goes back on it instead of down.

* Logistic loss on a linear logit makes this risk convex; max(0, x) is smoothed
  as s * log(1 + exp(x / s)).  It is minimised by L-BFGS steps on the driver, which
  holds one number a feature; the unlabelled side is summed anew at each step over
  all documents that may be learnt from.  The ridge shrinks as P grows, as the
  sampling error of P's means does, which the risk would otherwise fit.  A score
  of 0.5 is the risk's own boundary.
* prior: the share of toxic rows among all labels that may be learnt from, but
  no more than the mixture allows: U holds toxic texts' share of any set of texts
  at least, so the prior is at most the share of U with a feature over that of P.
* Features are the lower-cased words of a text and their first 3 to 6 letters: that
  a text holds one, and that it holds it often, twice at least and once in ``OFTEN``
  words, as what stands once in a long text may be there by chance.  Candidates are those that occur in at least ``SUPPORT`` of P, so there
  are at most 1 / SUPPORT times as many as a toxic text has features on average;
  their document counts come from every document that isn't held out.  A feature
  is kept if toxic texts hold it more often than all texts, by the exact binomial
  tail under control of the false-discovery rate over all candidates, so few toxic
  texts suffice where they agree.
* P is a sample, by a hash of doc_id, of at most about ``MAX_TOXIC`` labelled rows.

Edge cases: null and empty texts have no features and get the model's base
score, which is the prior if nothing sets toxic texts apart.  Labels that are
null don't count; of repeated labels the largest does.  Rows without doc_id are
held out.  Without any toxic example every score is 0.  A very long text is one
text: its features count once each.  A repeated row is scored again; an empty
table gives no rows; extra columns are passed on, but for ``score`` and
``predicted``, which are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tickloom.llm.runtime import key_bits, key_cells, plain
from tickloom.llm.textwords import ALNUM, chunks, dictionary_hashes, mixed, split_words
from tickloom.storage import stored

MAX_TOXIC = 20_000
#: A feature occurs in so many toxic texts at least, and in such a share of them.
MIN_TEXTS = 3
SUPPORT = 0.01
#: The rate of false discoveries among the features kept, and the share of texts with a feature that must be toxic.
FALSE_RATE = 0.01
TOXIC_SHARE = 0.75
#: A text holds a feature often if it does so twice and once in as many words.
OFTEN = 256
PREFIXES = (3, 4, 5, 6)
#: The ridge as a share of the prior over the square root of the number of toxic texts.
RIDGE = 0.1
#: The smoothing of max(0, x) as a share of the prior.
SMOOTH = 0.01
#: L-BFGS steps at most; fewer if the risk falls no more.
STEPS = 60


@dataclass
class ToxicityModel:
    """features: sorted hashes; a text's logit is bias + the weights of those it holds."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def logits(self, texts: pa.Array) -> np.ndarray:
        doc, at = held_features(texts, self.features)
        return self.bias + np.bincount(doc, weights=self.weights[at], minlength=len(texts))


def word_features(words: pa.Array) -> np.ndarray:
    """Hashes of each word and its prefixes; 0 where a word is no longer than the prefix."""
    words = pc.utf8_lower(words.cast(pa.large_string()))
    sizes = np.asarray(pc.utf8_length(words), np.int64)
    columns = [dictionary_hashes(words)]
    for k in PREFIXES:
        coded = pc.utf8_slice_codeunits(words, 0, k).dictionary_encode()
        hashes = dictionary_hashes(coded.dictionary, k)[np.asarray(coded.indices, np.int64)]
        columns.append(np.where(sizes > k, hashes, np.uint64(0)))
    return np.stack(columns, axis=1)


def twin(hashes: np.ndarray) -> np.ndarray:
    """The feature that a text holds another one often."""
    return mixed(hashes + np.uint64(0x9E3779B97F4A7C15))


def _often(times: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (times >= 2) & (OFTEN * times >= words)


def _places(features: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(features, hashes), len(features) - 1)
    return at, features[at] == hashes


def held_features(texts: pa.Array, features: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, feature) pairs; features are places in ``features``, in the order of texts, or hashes."""
    words = split_words(texts, ALNUM)
    hashes = word_features(words.dictionary)
    size = max(len(words.dictionary), 1)
    if features is None:
        pairs, times = np.unique(words.owner() * size + words.codes, return_counts=True)
        values = hashes[pairs % size]
        doc, times, values = np.repeat(pairs // size, values.shape[1]), np.repeat(times, values.shape[1]), values.ravel()
        keep = values != 0
        doc, times, values = doc[keep], times[keep], values[keep]
        order = np.lexsort((values, doc))
        doc, times, values = doc[order], times[order], values[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])
        total = np.add.reduceat(times, np.flatnonzero(new)) if len(doc) else times
        doc, values = doc[new], values[new]
        often = _often(total, words.counts[doc])
        return np.append(doc, doc[often]), np.append(values, twin(values[often]))
    if not len(features) or not len(hashes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    (at, known), (at_twin, known_twin) = _places(features, hashes), _places(features, twin(hashes))
    known_twin &= hashes != 0
    # most words hold none of the features; a text's other words count once
    held = np.flatnonzero((known | known_twin).any(axis=1)[words.codes])
    pairs, times = np.unique((np.searchsorted(words.bounds, held, side="right") - 1) * size + words.codes[held], return_counts=True)
    doc, code = pairs // size, pairs % size
    n, out, often, counts = len(features), [], [], []
    for k in range(known.shape[1]):
        here = known[code, k]
        out.append(doc[here] * n + at[code[here], k])
        here = known_twin[code, k]
        often.append(doc[here] * n + at_twin[code[here], k])
        counts.append(times[here])
    pairs, back = np.unique(np.concatenate(often), return_inverse=True)
    total = np.bincount(back, weights=np.concatenate(counts), minlength=len(pairs))
    pairs = np.unique(np.concatenate([*out, pairs[_often(total, words.counts[pairs // n])]]))
    return pairs // n, pairs % n


def binomial_tails(times: np.ndarray, n: int, share: np.ndarray) -> np.ndarray:
    """The chance of so many of n, or more, where each has the share: by the sum of its terms, largest first."""
    logs = np.cumsum(np.log(np.maximum(np.arange(n + 1), 1)))
    share = np.clip(share, 1e-12, 1 - 1e-12)
    k = times.astype(np.int64)
    term = np.exp(logs[n] - logs[k] - logs[n - k] + k * np.log(share) + (n - k) * np.log1p(-share))
    # so far below the mean that the first term vanishes, the sum is 1
    total, odds = np.where((term == 0) & (k < n * share), 1.0, 0.0), share / (1 - share)
    going = term > 0
    while going.any():
        total[going] += term[going]
        term = term * np.maximum(n - k, 0) / (k + 1) * odds
        k = k + 1
        # beyond the mean the terms fall at least like this
        going = (k <= n) & (term > 1e-9 * total) & going
    return np.minimum(total, 1.0)


def discoveries(tails: np.ndarray, rate: float) -> np.ndarray:
    """The largest tail kept so that so many of those kept are false, by Benjamini and Hochberg."""
    order = np.sort(tails)
    good = np.flatnonzero(order <= rate * np.arange(1, len(order) + 1) / max(len(order), 1))
    return tails <= (order[good[-1]] if len(good) else -1.0)


def _toxic_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        _, values = held_features(batch.column("text"), None)
        feature, times = np.unique(values, return_counts=True)
        yield pa.record_batch({"feature": pa.array(feature.view(np.int64)), "times": pa.array(times, pa.int64())})


def _all_counts(blob):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = np.frombuffer(blob.value, np.uint64)
        total = np.zeros(len(features), np.int64)
        for batch in chunks(batches):
            total += np.bincount(held_features(batch.column("text"), features)[1], minlength=len(features))
        found = np.flatnonzero(total)
        yield pa.record_batch({"place": pa.array(found, pa.int64()), "times": pa.array(total[found])})

    return run


def _held(blob):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = np.frombuffer(blob.value, np.uint64)
        for batch in chunks(batches):
            doc, at = held_features(batch.column("text"), features)
            bounds = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(at.astype(np.int32)))
            yield pa.record_batch([lists], ["held"])

    return run


def loss_sums(row: np.ndarray, at: np.ndarray, times: np.ndarray, theta: np.ndarray, sign: int) -> tuple[float, np.ndarray]:
    """The logistic loss of texts against ``sign``, each counted ``times``, and its slope; (row, at) are the features held."""
    z = sign * (theta[-1] + np.bincount(row, weights=theta[at], minlength=len(times)))
    slope = sign * times / (1 + np.exp(np.clip(z, -700, 700)))
    return float((times * np.logaddexp(0, -z)).sum()), -np.append(np.bincount(at, weights=slope[row], minlength=len(theta) - 1), slope.sum())


def non_negative_risk(theta: np.ndarray, toxic: tuple[np.ndarray, np.ndarray, int], negative: tuple[float, np.ndarray], prior: float) -> tuple[float, np.ndarray]:
    """The risk and its slope; ``negative`` is the mean loss of U against the negative label, and its slope."""
    row, at, n = toxic
    ones = np.ones(n)
    plus, minus = loss_sums(row, at, ones, theta, 1), loss_sums(row, at, ones, theta, -1)
    smooth = SMOOTH * prior
    rest = (negative[0] - prior * minus[0] / n) / smooth
    share = 1 / (1 + np.exp(np.clip(-rest, -700, 700)))
    weights = np.append(theta[:-1], 0.0)
    ridge = RIDGE * prior / np.sqrt(n)
    value = prior * plus[0] / n + smooth * float(np.logaddexp(0, rest)) + ridge * float(weights @ weights) / 2
    return value, prior * plus[1] / n + share * (negative[1] - prior * minus[1] / n) + ridge * weights


def minimise(function: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int = STEPS, settled: float = 1e-6, memory: int = 10) -> np.ndarray:
    """L-BFGS with halved steps; ends where a step gains less than ``settled`` of the value."""
    x, (value, slope), past = start, function(start), []
    for _ in range(steps):
        way, shares = slope.copy(), []
        for s, y in reversed(past):
            shares.append(s @ way / (s @ y))
            way -= shares[-1] * y
        way *= past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1]) if past else 1 / max(np.abs(slope).max(), 1e-12)
        for (s, y), share in zip(past, reversed(shares), strict=True):
            way += s * (share - y @ way / (s @ y))
        if slope @ way <= 0:
            way, past = slope.copy(), []
        length = 1.0
        while True:
            new = x - length * way
            new_value, new_slope = function(new)
            if new_value <= value - 1e-4 * length * (slope @ way):
                break
            length /= 2
            if length < 1e-4:
                return x
        if (new - x) @ (new_slope - slope) > 1e-14:
            past = [*past, (new - x, new_slope - slope)][-memory:]
        gain, x, value, slope = value - new_value, new, new_value, new_slope
        if gain <= settled * abs(value):
            return x
    return x


def fit(toxic: list[np.ndarray], unlabelled: Callable[[np.ndarray], tuple[float, np.ndarray]], prior: float, size: int) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk; ``unlabelled`` gives the mean loss of U against the negative label and its slope."""
    row, at = np.repeat(np.arange(len(toxic)), [len(r) for r in toxic]), np.concatenate([*toxic, np.empty(0, np.int64)]).astype(np.int64)
    start = np.zeros(size + 1)
    start[-1] = np.log(prior / (1 - prior))
    theta = minimise(lambda t: non_negative_risk(t, (row, at, len(toxic)), unlabelled(t), prior), start)
    return theta[:-1], float(theta[-1])


def _unlabelled_loss(patterns: DataFrame, total: int, size: int) -> Callable[[np.ndarray], tuple[float, np.ndarray]]:
    """The mean loss of all texts against the negative label and its slope, summed where the patterns are."""
    context = patterns.sparkSession.sparkContext

    def mean(theta: np.ndarray) -> tuple[float, np.ndarray]:
        shared = context.broadcast(theta.tobytes())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = np.frombuffer(shared.value)
            loss, slope = 0.0, np.zeros(size + 1)
            for batch in batches:
                lists = batch.column("held")
                row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
                more = loss_sums(row, np.asarray(lists.flatten(), np.int64), np.asarray(batch.column("times"), np.float64), own, -1)
                loss, slope = loss + more[0], slope + more[1]
            found = np.flatnonzero(slope)
            yield pa.record_batch({"place": pa.array(np.append(found, -1), pa.int32()), "value": pa.array(np.append(slope[found], loss))})

        out, loss = np.zeros(size + 1), 0.0
        for place, value in patterns.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value")).collect():
            if place < 0:
                loss = value
            else:
                out[place] = value
        shared.unpersist()
        return loss / total, out / total

    return mean


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


def _sample(doc_id: Column, share: float) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit(7)), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))


def train(documents: DataFrame, labels: DataFrame, learnable: Column | None = None) -> ToxicityModel:
    """A model from (doc_id, text) and (doc_id, toxic); ``learnable`` says which rows may teach it."""
    spark = documents.sparkSession
    rows = plain(documents, doc_id="long", text="string")
    labels = plain(labels, doc_id="long", toxic="int").dropna()
    if learnable is not None:
        rows, labels = rows.where(learnable), labels.where(learnable)
    labels = stored(labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxic-labels")
    n_labels, n_toxic = labels.agg(F.count("*"), F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0))).first()
    nothing = ToxicityModel(np.empty(0, np.uint64), np.empty(0), -np.inf)
    if not n_toxic:
        return nothing
    prior = min(n_toxic / n_labels, 0.99)
    chosen = labels.where("toxic = 1").where(_sample(F.col("doc_id"), MAX_TOXIC / n_toxic)).select("doc_id")
    bits = spark.sparkContext.broadcast(key_bits(chosen, 1 << 24).tobytes())

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("doc_id")))
            cell = key_cells(np.asarray(batch.column("doc_id")), 8 * len(wanted))
            yield batch.filter(pa.array((wanted[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0))

    toxic = stored(rows.mapInArrow(marked, "doc_id long, text string").join(chosen, "doc_id").select("text"), "toxic-texts")
    bits.unpersist()
    n_known = toxic.count()
    if not n_known:
        return nothing
    counted = toxic.mapInArrow(_toxic_counts, "feature long, times long").groupBy("feature").agg(F.sum("times").alias("times"))
    found = counted.where(F.col("times") >= max(MIN_TEXTS, SUPPORT * n_known)).collect()
    order = np.argsort(np.array([r.feature for r in found], np.int64).view(np.uint64))
    candidates = np.array([r.feature for r in found], np.int64).view(np.uint64)[order]
    of_toxic = np.array([r.times for r in found], np.float64)[order]
    blob = spark.sparkContext.broadcast(candidates.tobytes())
    of_all = np.zeros(len(candidates))
    for place, times in rows.select("text").mapInArrow(_all_counts(blob), "place long, times long").groupBy("place").agg(F.sum("times")).collect():
        of_all[place] = times
    blob.unpersist()
    n_all = rows.count()
    # toxic texts against all texts: whether chance can do it, and how many of those with a feature are toxic
    p, u = of_toxic / n_known, np.maximum(of_all, of_toxic * n_known / max(n_toxic, 1)) / max(n_all, 1)
    good = np.flatnonzero(discoveries(binomial_tails(of_toxic, n_known, u), FALSE_RATE) & (p > u) & (prior * p > TOXIC_SHARE * u))
    features = candidates[good]
    blob = spark.sparkContext.broadcast(features.tobytes())
    known = [np.array(r.held, np.int64) for r in toxic.mapInArrow(_held(blob), "held array<int>").collect()]
    # texts with the same features count as one pattern; a pattern's texts are summed before they move
    patterns = stored(rows.select("text").mapInArrow(_held(blob), "held array<int>").groupBy("held").agg(F.count("*").alias("times")), "toxic-patterns")
    blob.unpersist()
    with_any = patterns.where("size(held) > 0").agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0] / n_all
    most = with_any / max(np.mean([len(k) > 0 for k in known]), 1e-12) if len(features) else 1.0
    prior = min(prior, most)
    weights, bias = fit(known, _unlabelled_loss(patterns, n_all, len(features)), prior, len(features))
    return ToxicityModel(features, weights, bias)


def score(documents: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """All columns of ``documents`` but ``score`` and ``predicted``, which are added."""
    spark = documents.sparkSession
    blob = spark.sparkContext.broadcast((model.features.tobytes(), model.weights.tobytes(), model.bias))
    kept = documents.drop("score", "predicted")
    schema = StructType([*kept.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights, bias = blob.value
        own = ToxicityModel(np.frombuffer(features, np.uint64), np.frombuffer(weights), bias)
        for batch in chunks(batches):
            value = 1 / (1 + np.exp(-np.clip(own.logits(batch.column("text")), -700, 700)))
            value = np.where(np.isneginf(own.bias), 0.0, value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value), pa.array((value >= threshold).astype(np.int32))], [*batch.schema.names, "score", "predicted"])

    return kept.mapInArrow(run, schema)
