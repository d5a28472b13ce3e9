"""Cases in which an operator did less than its whole job, against brute force."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import linked, plain_components, shingles
from tickloom.llm import ngram_join, substring_dedup, topk_search
from tickloom.llm.ngram_join import JaccardJoin


def test_links_between_components_that_lead_in_different_ngrams(spark):
    """Chains x2-x-y-y2: half of what x and y share is mostly held by x's side, half by y's."""
    rng = random.Random(5)
    texts = []
    for chain in range(120):
        base = [f"c{chain}w{i}" for i in range(204)]
        places = rng.sample(range(10, 194, 9), 10)

        def edited(words, at, mark, chain=chain):
            return [f"c{chain}{mark}{i}" if i in at else w for i, w in enumerate(words)]

        y = edited(base, places[:2], "y")
        texts += [" ".join(t) for t in (edited(base, places[2:6], "p"), base, y, edited(y, places[6:], "q"))]
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    near = [(a, b) for first in range(0, len(texts), 4) for a, b in linked({i: sets[i] for i in range(first, first + 4)})]
    got = {r.doc_id: r.component_id for r in JaccardJoin(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).components().collect()}
    assert got == plain_components(sets, near)


@pytest.mark.parametrize("spread", [0.0, 0.02])
def test_top_k_where_ids_repeat(spark, monkeypatch, spread):
    """Every id several times, as copies or with vectors that differ: still k different neighbours, the best ones."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 6))
    vectors = []
    for i in range(150):
        v = centres[i % 5] * 0.4 + rng.normal(size=6) * 0.05
        vectors += [(i, (v + rng.normal(size=6) * spread).tolist()) for _ in range(1 + 7 * (i % 3))]
    # a query is one vector of its id
    vectors = [(i, v, False) for i, v in vectors if i % 10] + [(i, v, True) for i, v in {i: v for i, v in vectors if i % 10 == 0}.items()]
    monkeypatch.setattr(topk_search, "GROUP_QUERIES", 4)
    monkeypatch.setattr(topk_search, "SALT_ROWS", 300)
    df = spark.createDataFrame([(i, v) for i, v, _ in vectors], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in topk_search.top_k(df, F.col("vec_id") % 10 == 0, 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in vectors]
    queries = {i: v for (i, v), (_, _, asked) in zip(whole, vectors, strict=True) if asked}
    for q, v in queries.items():
        best = {}
        for i, w in whole:
            if i != q:
                best[i] = max(best.get(i, -math.inf), sum(a * b for a, b in zip(v, w, strict=True)))
        assert got[q] == [(n + 1, i, s) for n, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:5])]


def test_clean_rows_that_share_an_id_stay(spark, tmp_path):
    """A near copy or a contaminated row doesn't take others of its id along."""
    text = " ".join(f"w{i}" for i in range(80))
    item = " ".join(f"b{i}" for i in range(20))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, text), (2, text.replace("w40", "y")), (2, "a clean text of id two"), (3, item), (3, "a clean text of id three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for stage in (corpus_pipeline.ngram_join, corpus_pipeline.decontamination):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text"]
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == [rows[0], rows[2], rows[4]]


@pytest.mark.parametrize("hot", [3, 20_000])
def test_one_ngram_in_half_of_all_sets(spark, monkeypatch, hot):
    """A greeting that half of the sets begin with, dealt over salts or not: the same components, and no task has the n-gram's rows."""
    monkeypatch.setattr(ngram_join, "HOT", hot)
    rng = random.Random(11)
    # short texts post the greeting, as they have few other n-grams
    greeting, texts = "dear sir or madam please", []
    for i in range(240):
        own = [f"g{i % 40}w{k}" for k in range(6)] if i % 2 else [*greeting.split(), f"a{rng.randrange(30)}", f"b{rng.randrange(9)}"]
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(6)
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    join = JaccardJoin(docs, percent=30)
    got = {r.doc_id: r.component_id for r in join.components().collect()}
    near = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 30 * len(sets[a] | sets[b])]
    assert got == plain_components(sets, near)
    led = join._led()
    salts = led.groupBy("gram").agg(F.max("salts").alias("salts"), F.count("*").alias("n"), F.countDistinct(F.pmod(F.xxhash64("cls"), F.col("salts").cast("long"))).alias("dealt")).orderBy(F.desc("n")).first()
    assert (salts.salts > 4 and salts.dealt > 4) if hot == 3 else salts.salts == 1


def test_a_row_that_fills_the_table(spark, monkeypatch):
    """A million rows without id and text, and a long text as a third of all other rows: no task holds them, all come back."""
    monkeypatch.setattr(substring_dedup, "COPIES", 100)
    text = " ".join(f"w{i}" for i in range(50))
    hot = [(1, text)] * 700
    rest = [(i, f"own {i} text {i}") for i in range(2, 1400)]
    docs = spark.createDataFrame(hot + rest, "doc_id long, text string").repartition(7).unionByName(spark.range(1_000_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "CAST(NULL AS STRING) AS text"))
    got = substring_dedup.remove_repeats(docs, with_text=False, cells=1 << 20)
    counts = {tuple(r)[:4]: r.n for r in got.groupBy("doc_id", "n_words", "n_removed", "kept_sha256").agg(F.count("*").alias("n")).where("doc_id is null or doc_id < 3").collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert counts == {(None, 0, 0, empty): 1_000_000, (1, 50, 50, empty): 700, (2, 4, 0, hashlib.sha256(b"own 2 text 2").hexdigest()): 1}
    assert got.count() == 1_000_000 + len(hot) + len(rest)
