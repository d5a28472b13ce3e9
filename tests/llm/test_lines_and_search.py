"""Line dedup, importance resampling and ranked search against plain versions."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.common import FOLD, SCHEMA, alnum_words, corpus, frame
from tickloom.llm import ngram_resampling, ranked_search
from tickloom.llm.line_dedup import drop_common_lines
from tickloom.llm.ngram_resampling import resample
from tickloom.llm.ranked_search import search

BLANK = " \t\n\x0b\x0c\r"
ITEMS = "item_id long, text string, doc_id string, score int"


def line_rows():
    """Lines shared by many texts, in other cases and white space, a text of one line many times, nulls, blanks and repeated rows."""
    texts = [None, "", "\n", " \n\t\n", "Menu\nMENU\n menu \r\nown line", "menu", "ǅ menu\n menu ", "a\n" * 5000 + "menu"]
    for i in range(12):
        texts.append(f"own {i}\n  Cookie Policy\x0b\nown {i} again\n\nÜBER uns\n{'über uns' if i % 2 else 'x'}\nMENU")
    texts += [f"line {i % 9}\nsome text {i}" for i in range(90)]
    rows = [(i, t, None, "s", 0, 7, "k", 1, 0.5) for i, t in enumerate(texts)]
    return rows + [(None, "menu\nnameless", None, None, None, 7, "k", 1, 0.5), (None, None, None, None, None, 7, "k", 1, 0.5)] + [rows[9]] * 3


def plain_lines(rows, least_docs, least_chars):
    held = defaultdict(set)
    key = lambda line: line.strip(BLANK).translate(FOLD)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add((i, t))
    gone = {k for k, docs in held.items() if len(k) >= least_chars and len(docs) >= least_docs}
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("least_docs,least_chars", [(10, 1), (2, 5), (1, 1), (10, 0)])
def test_common_lines_go(spark, least_docs, least_chars):
    rows = line_rows()
    got = drop_common_lines(frame(spark, rows), least_docs, least_chars)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_lines(rows, least_docs, least_chars)


def test_one_line_in_a_third_of_all_rows(spark):
    """A hot line and a hot row, over many partitions, without broadcast joins."""
    rows = [(i if i % 3 else 0, "hot\nx" if i % 3 == 0 else f"hot\nline {i}\nhot") for i in range(6000)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = drop_common_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(16)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert Counter(map(tuple, got)) == Counter((i, t.count("\n") + 1, t.count("hot"), "\n".join(x for x in t.split("\n") if x != "hot")) for i, t in rows)


def grams(words):
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain_draw(rows, items, percent, least_words, buckets=10_000):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (Counter(bucket(g) for text in texts for g in grams(alnum_words(text))) for texts in ([r[1] for r in rows], items))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, text, *_ in rows:
        found = grams(alnum_words(text))
        weight = sum(gain(bucket(g)) for g in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(alnum_words(text)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    may = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = may[: percent * len(may) // 100]
    rank = defaultdict(list)
    for k, r in enumerate(drawn, 1):
        rank[id(r)] = k
    return sorted((tuple(r) + (rank.get(id(r)),) for r in out), key=str)


@pytest.mark.parametrize("percent", [5, 60])
def test_resampling_equals_a_plain_draw(spark, monkeypatch, percent):
    monkeypatch.setattr(ngram_resampling, "COPIES", 3)
    rows = corpus(3)
    rows += [rows[12]] * 8 + [(None, rows[13][1], *rows[13][2:]), (None, None, *rows[0][2:]), (3, rows[14][1], *rows[14][2:])]
    items = [rows[20][1], "kara Loten mivol", None, "", rows[20][1]]
    bench = spark.createDataFrame([(1, t, "x", 2) for t in items], ITEMS)
    got = resample(frame(spark, rows), bench, percent=percent)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert all(kind == "bigint" for _, kind in got.dtypes)
    assert sorted(map(tuple, got.collect()), key=str) == plain_draw(rows, items, percent, 20)


def test_resampling_of_empty_tables(spark):
    none, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], ITEMS)
    assert resample(none, items).collect() == []
    rows = corpus(4)
    assert sorted(map(tuple, resample(frame(spark, rows), items).collect()), key=str) == plain_draw(rows, [], 5, 20)


def plain_search(rows, items, k):
    docs = [(i, Counter(w), len(w)) for i, t, *_ in rows if (w := alnum_words(t))]
    n_docs, n_terms = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c, n in docs:
            m = 50 + 50 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(alnum_words(text)) if c[t])
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("k,postings,block", [(50, 1 << 20, 1 << 20), (3, 40, 60), (7, 1, 1)])
def test_search_equals_scoring_everything(spark, monkeypatch, k, postings, block):
    """One shard or many, one block of items or one for each, with ties, missing and repeated ids."""
    monkeypatch.setattr(ranked_search, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", block)
    monkeypatch.setattr(ranked_search, "FIRST_STEP", 2)
    rows = corpus(5)
    rows += [rows[12]] * 5 + [(None, rows[13][1], *rows[13][2:])] * 2 + [(3, rows[14][1], *rows[14][2:])]
    items = [(1, "kara loten mivol kara"), (1, "zuS éxra"), (2, rows[20][1]), (3, None), (4, ""), (5, "unheard of"), (None, "one two"), (2, rows[20][1])]
    got = search(frame(spark, rows), spark.createDataFrame([(*r, "x", 2) for r in items], ITEMS), k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_search(rows, items, k)


def test_search_of_empty_tables(spark):
    none, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], ITEMS)
    assert search(none, items).collect() == []
    assert search(frame(spark, corpus(1)), items).collect() == []
    assert search(none, spark.createDataFrame([(1, "a b", "", 1)], ITEMS)).collect() == []


def test_threshold_stops_early_but_not_on_a_tie():
    """Reading ends while lists go on, and never before documents that tie with the k-th are met."""
    n = 5000
    rng = np.random.default_rng(1)
    impact = np.concatenate([np.full(40, 1000), rng.integers(1, 500, n - 40)])
    rng.shuffle(impact)
    shard = ranked_search.Shard(np.arange(n + 1), np.zeros(n, np.int64), impact, 1)
    rows, scores = shard.search(np.array([0]), 10, 0)
    assert set(np.flatnonzero(impact == 1000)) <= set(rows)
    assert len(rows) < 200 and (scores == impact[rows]).all()
    # a k-th score from elsewhere ends it after one step
    assert not len(shard.search(np.array([0]), 10, 5000)[0])
