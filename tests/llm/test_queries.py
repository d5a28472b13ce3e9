"""The registered corpus queries and the pipeline over the small tables."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.common import alnum_words, blank_words
from tests.llm.test_operators import linked, plain_components, plain_spans, shingles
from tests.oracle import connect, same
from tickloom.llm import queries, toxicity
from tickloom.llm.runtime import table
from tickloom.storage import stored

COLUMNS = {
    "op1_secret_scans": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op2_ngram_join": ["doc_id", "n_shingles", "component_id"],
    "op3_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op4_benchmark_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op5_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op6_url_filters": ["page_id", "host", "path", "rule", "verdict"],
    "op7_topk_search": ["query_id", "rank", "vec_id", "score"],
    "op8_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op9_token_counts": ["doc_id", "n_words", "n_tokens"],
    "op10_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op11_target_resampling": ["doc_id", "n_features", "weight", "score", "rank"],
    "op12_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op13_ranked_search": ["item_id", "rank", "doc_id", "score"],
}


def test_names():
    assert set(COLUMNS) == set(queries.queries())
    assert set(entry.queries()) >= {*COLUMNS, "pipeline"}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, data, name):
    same(spark, connect(data), data, queries.queries()[name], queries.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(queries.oracle_sql())))
def test_query_runs(spark, data, name):
    df = queries.queries()[name](spark, data)
    assert df.columns == COLUMNS[name]
    assert df.count() >= table(spark, data, "pages" if "url" in name else "documents").count()


def test_held_out_folds(spark, data):
    for name, folds, fold in (("op3_toxicity", 5, 0), ("op5_language_id", 4, 2)):
        for r in queries.queries()[name](spark, data).collect():
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold)


def test_language_accuracy(spark, data):
    truth = table(spark, data, "documents").select("doc_id", "lang")
    rows = queries.op5_language_id(spark, data).join(truth, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def plain_toxic(spark, docs, folder):
    """The rows that the stage's model rejects, word by word."""
    model = toxicity.train(docs, table(spark, folder, "labels"), ~toxicity.held_out(F.col("doc_id")))
    weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    out = set()
    for r in docs.collect():
        words = [w.lower() for w in alnum_words(r.text)]
        held = Counter((w[:k], k) for w in words for k in toxicity.PREFIXES if len(w) > k)
        held += Counter((w, 0) for w in words)
        logit = model.bias
        for (w, k), times in held.items():
            name = xxhash.xxh64_intdigest(w.encode(), k)
            logit += weight.get(name, 0.0)
            if times >= 2 and toxicity.OFTEN * times >= len(words):
                logit += weight.get(int(toxicity.twin(np.array([name], np.uint64))[0]), 0.0)
        if logit >= 0:
            out.add(r.doc_id)
    return out


def plain_contaminated(docs, items):
    windows = {tuple(w[k : k + 13]) for w in map(alnum_words, items) for k in range(max(len(w) - 12, 1) if w else 0)}
    out = set()
    for r in docs:
        w, hit = alnum_words(r.text), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit.update(range(k, k + size))
        if hit and 20 * len(hit) >= len(w):
            out.add(r.doc_id)
    return out


def plain_redacted(text):
    out, at = [], 0
    for start, _, end in plain_spans(text):
        if start >= at:
            out += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_pipeline(spark):
    """Each stage against a plain version, on a table where each has something to do."""
    data = "/root/testdata/sf0.01"
    docs = table(spark, data, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, data), f"test-{name}")
        was = before.collect()
        if name == "packing":
            assert {r.doc_id for r in docs.select("doc_id").collect()} == {r.doc_id for r in was}
            continue
        assert docs.columns == columns
        assert docs.schema == before.schema
        now = {r.doc_id: r for r in docs.collect()}
        gone = {r.doc_id for r in was} - set(now)
        if name == "toxicity":
            assert gone == plain_toxic(spark, before, data)
        if name == "ngram_join":
            sets = {r.doc_id: shingles(r.text) for r in was}
            assert set(now) == {i for i, c in plain_components(sets, linked(sets)).items() if i == c}
        if name == "decontamination":
            assert gone == plain_contaminated(was, [r.text for r in table(spark, data, "benchmark").collect()])
        if name == "secrets":
            assert not gone
            changed = {r.doc_id for r in was if r.text != now[r.doc_id].text}
            assert changed
            for r in was:
                assert now[r.doc_id].text == plain_redacted(r.text)
                assert now[r.doc_id].n_chars == len(now[r.doc_id].text)
        else:
            assert gone
            assert len(now) > 500


def test_dedup_query_hashes_words(spark, data):
    first = queries.op10_substring_dedup(spark, data).where("n_removed = 0").first()
    text = table(spark, data, "documents").where(f"doc_id = {first.doc_id}").first().text
    assert first.kept_sha256 == hashlib.sha256(" ".join(blank_words(text)).encode()).hexdigest()


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls, repeated rows, near copies and columns with clashing names; and no rows at all."""
    text = " ".join(f"w{i}" for i in range(80))
    lost = " ".join(f"v{i}" for i in range(70))
    rows = [
        (1, text), (1, text), (2, text.replace("w40", "y")), (None, text.replace("w41", "y")), (3, None), (None, "lost"), (None, lost), (None, lost), (None, lost.replace("v9 ", "z ")),
        (None, None), (None, None), (None, " "), (4, ""), (5, "key password=abcdef0123456789"),
    ]
    names = ["key", "score", "predicted", "secrets", "text_", "base_", "row", "n", "component", "__row__", "__own_2__"]
    schema = ", ".join(["doc_id long", "text string", *(f"`{n}` int" for n in names)])
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    full = spark.createDataFrame([(*r, *range(7, 7 + len(names))) for r in rows], schema)
    for docs, whole in ((full, True), (spark.createDataFrame([], schema), False)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, str(tmp_path)), f"odd-{name}")
            if name == "packing":
                continue
            assert docs.columns == ["doc_id", "text", *names]
            got = docs.collect()
            # the caller's columns come through as they were
            assert all(list(r)[2:] == list(range(7, 7 + len(names))) for r in got)
            if not whole:
                assert not got
            elif name == "toxicity":
                assert len(got) == len(rows)
            else:
                assert sorted(r.doc_id for r in got if r.doc_id is not None) == [1, 3, 4, 5]
                # one row of each group without ids stays, and everything without words
                nameless = sorted(str(r.text) for r in got if r.doc_id is None)
                assert nameless[:4] == [" ", "None", "None", "lost"] and len(nameless) == 5 and nameless[4] in (lost, lost.replace("v9 ", "z "))
            if name == "secrets" and whole:
                assert {r.doc_id: r.text for r in got if r.doc_id}[5] == "key [secret]"
        assert docs.count() == (9 if whole else 0)


def test_a_run_deletes_only_its_own_tables(spark, tmp_path):
    """An unread result of another call outlives a pipeline run; the run's own stages don't."""
    text = " ".join(f"w{i}" for i in range(40))
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, text)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, text), (2, "other words")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    unread = queries.op4_benchmark_decontamination(spark, str(tmp_path))
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == {2}
    assert {r.doc_id: r.contaminated for r in unread.collect()} == {1: True, 2: False}
