"""Exact top-k by inner product: a Voronoi kNN join.

1. Pivots are fitted on a sample of at most ``SAMPLE`` vectors; every vector
   joins the cell of its nearest pivot p, at distance d.  A cell's summary is
   its number of vectors and of queries, its largest distance, and the k + 1
   different ids of the smallest distances.
2. Each query is solved within its own cell.  The k-th score found there is a
   floor under its k-th score overall.  For x in a cell, q.p - |q| d <= q.x <=
   q.p + |q| d, so the summaries give a second floor: the (k+1)-th largest lower
   bound of different ids, whether or not q itself is among them.
3. Queries are grouped by pivots.  For each group and cell the larger floors give
   the least distance at which a vector can still matter to any of the group's
   queries; only such vectors are replicated to the group.  Groups of more than
   ``GROUP_QUERIES`` queries are cut into blocks; blocks and salts of the data
   are solved locally, and vectors of a cell meet only the queries that they can
   still matter to.

Nothing is approximate: bounds have a margin for rounding, and scores are
integers.  A task holds at most ``GROUP_QUERIES`` queries, and the summaries'
size is fixed by ``PIVOTS`` and k.  Where distances tell nothing, as for vectors
without clusters in many dimensions, every vector goes to every group.

Edge cases: vectors that are null or hold null or non-finite components take no
part, nor do rows without id.  Shorter vectors count as padded with zeros.  A
repeated row counts once; ids that repeat with different vectors count with
the better score, and ask with the smallest of their vectors.  Ties go to the
smaller id.  An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.runtime import plain
from tickloom.storage import stored

#: One pivot for so many vectors, and at most so many pivots.
CELL_ROWS = 400
PIVOTS = 1024
GROUP_QUERIES = 2048
SAMPLE = 8192
SALT_ROWS = 8192


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, padded with zeros."""
    lists = column.cast(pa.list_(pa.int64()))
    sizes = np.diff(np.asarray(lists.offsets))
    out = np.zeros((len(lists), width), np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    flat = np.asarray(lists.flatten())
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (rows**2).sum(axis=1)[:, None] - 2 * rows @ pivots.T + (pivots**2).sum(axis=1)
    return np.sqrt(np.maximum(square, 0))


def fit_pivots(sample: np.ndarray, count: int, rounds: int = 5) -> np.ndarray:
    """Centres of a few Lloyd rounds, from evenly spaced rows of the sample."""
    if not len(sample):
        return np.zeros((0, sample.shape[1]))
    at = np.unique(np.linspace(0, len(sample) - 1, min(count, len(sample))).astype(int))
    pivots = sample[at].astype(float)
    for _ in range(rounds):
        near = _distances(sample, pivots).argmin(axis=1)
        held = np.bincount(near, minlength=len(pivots))
        sums = np.zeros_like(pivots)
        np.add.at(sums, near, sample)
        pivots = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], pivots)
    return pivots


def _scores(data: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by floating point where that is exact."""
    largest = int(np.abs(data).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(data.shape[1], 1)
    if largest < 1 << 53:
        return (data.astype(float) @ queries.astype(float).T).astype(np.int64)
    return data @ queries.T


def _best(query: np.ndarray, item: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best different items of each query."""
    order = np.lexsort((-score, item, query))
    query, item, score = query[order], item[order], score[order]
    first = np.ones(len(query), bool)
    first[1:] = (query[1:] != query[:-1]) | (item[1:] != item[:-1])
    query, item, score = query[first], item[first], score[first]
    order = np.lexsort((item, -score, query))
    query, item, score = query[order], item[order], score[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return query[rank < k], item[rank < k], score[rank < k]


def _different(names: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest value of each row of ``values``, where columns of one name count once; -inf if names are fewer."""
    order = np.argsort(names, kind="stable")
    starts = np.flatnonzero(np.append(True, names[order][1:] != names[order][:-1])) if len(names) else np.empty(0, np.int64)
    if len(starts) < k:
        return np.full(len(values), -np.inf)
    if len(starts) < len(names):
        values = np.maximum.reduceat(values[:, order], starts, axis=1)
    return np.partition(values, -k, axis=1)[:, -k]


_KEY = ("grp", "block", "salt")


def _solve(k: int, width: int, shared):
    """Queries (role 0, with their floors) of a group, block and salt, then its data (role 1) by cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        now, ids, queries, floors, best, known = None, [], [], [], None, None

        def result() -> Iterator[pa.RecordBatch]:
            if best is not None and len(best[0]):
                yield pa.record_batch([pa.array(np.concatenate(ids)[best[0]]), pa.array(best[1]), pa.array(best[2])], ["query_id", "vec_id", "score"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [np.asarray(batch.column(c), np.int64) for c in (*_KEY, "role", "cell")]
            away = np.asarray(batch.column("d"))
            edge = np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in keys], axis=0)))
            for start, end in zip(edge, np.append(edge[1:], batch.num_rows), strict=True):
                key, role, cell = tuple(c[start] for c in keys[:3]), keys[3][start], keys[4][start]
                if now != key:
                    yield from result()
                    now, ids, queries, floors, best, known = key, [], [], [], None, None
                vec, rows = np.asarray(batch.column("vec_id"))[start:end], _matrix(batch.column("v").slice(start, end - start), width)
                if role == 0:
                    ids.append(vec)
                    queries.append(rows)
                    floors.append(np.asarray(batch.column("floor"), np.float64)[start:end])
                    continue
                if known is None:
                    asked = np.concatenate(queries)
                    known = np.concatenate(ids), asked, np.sqrt((asked.astype(float) ** 2).sum(axis=1)), np.concatenate(floors), asked.astype(float) @ centres.T
                own, asked, size, floor, dots = known
                for low in range(start, end, 2048):
                    here = slice(low - start, min(low + 2048, end) - start)
                    # the queries to which something of this cell can still matter
                    able = np.flatnonzero(dots[:, cell] + size * away[low : low + 2048][: here.stop - here.start].max() >= floor)
                    if not len(able):
                        continue
                    item, score = vec[here], _scores(rows[here], asked[able])
                    # an id that repeats counts once, by its best score
                    order = np.argsort(item, kind="stable")
                    starts = np.flatnonzero(np.append(True, item[order][1:] != item[order][:-1]))
                    if len(starts) < len(item):
                        item, score = item[order][starts], np.maximum.reduceat(score[order], starts, axis=0)
                    # what can't be among the k best of these ids is left out; one more than k for the query itself
                    bar = np.partition(score, -k - 1, axis=0)[-k - 1] if len(item) > k + 1 else np.full(len(able), np.iinfo(np.int64).min)
                    at, query = np.nonzero((score >= bar) & (score >= floor[able]))
                    keep = item[at] != own[able[query]]
                    at, query = at[keep], query[keep]
                    found = (able[query], item[at], score[at, query])
                    if best is not None:
                        found = tuple(np.concatenate(pair) for pair in zip(best, found, strict=True))
                    best = _best(*found, k)
        yield from result()

    return run


def _solved(queries: DataFrame, data: DataFrame, k: int, width: int, shared) -> DataFrame:
    """The k best (query_id, vec_id, score) of each query, from (grp, block, salt, cell, d, vec_id, v) and queries' floors."""
    both = queries.withColumn("role", F.lit(0)).unionByName(data.withColumns({"role": F.lit(1), "floor": F.lit(0.0)}))
    both = both.repartition(*_KEY).sortWithinPartitions(*_KEY, "role", "cell")
    local = both.mapInArrow(_solve(k, width, shared), "query_id long, vec_id long, score long")
    best = local.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k)


def _pivots(rows: DataFrame, total: int, width: int) -> np.ndarray:
    sample = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / total) * (1 << 30))).select("vec_id", "v").orderBy("vec_id").limit(2 * SAMPLE).collect()
    if not sample:
        sample = rows.select("vec_id", "v").orderBy("vec_id").limit(SAMPLE).collect()
    fitted = np.zeros((len(sample), width))
    for at, row in enumerate(sample):
        fitted[at, : len(row.v)] = row.v
    return fit_pivots(fitted, min(PIVOTS, -(-total // CELL_ROWS)))


def _assign(width: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2048):
                part = batch.slice(low, 2048)
                away = _distances(_matrix(part.column("v"), width).astype(float), shared.value)
                cell = away.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(away[np.arange(len(cell)), cell])], ["vec_id", "v", "asked", "cell", "d"])

    return run


def _summary(cells: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """cell, id and distance of the k + 1 ids of the smallest distances of each cell; partial sorts of salts come first."""
    by_salt = Window.partitionBy("cell", "salt").orderBy("d")
    by_cell = Window.partitionBy("cell").orderBy("d")
    # an id has one salt, and its least distance in the cell counts
    near = cells.groupBy("cell", "vec_id").agg(F.min("d").alias("d")).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(32))).withColumn("r", F.row_number().over(by_salt)).where(F.col("r") <= k + 1)
    near = near.withColumn("r", F.row_number().over(by_cell)).where(F.col("r") <= k + 1).select("cell", "vec_id", "d").collect()
    return np.array([r.cell for r in near], np.int64), np.array([r.vec_id for r in near], np.int64), np.array([r.d for r in near])


def _floors(k: int, width: int, shared, summary):
    """Queries with the larger of their two floors, less a margin for rounding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, (cell, name, away) = shared.value, summary.value
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                q = _matrix(part.column("v"), width).astype(float)
                dots = q @ centres.T
                floor = _different(name, dots[:, cell] - np.sqrt((q**2).sum(axis=1))[:, None] * away, k + 1)
                found = np.asarray(part.column("found").cast(pa.float64()).fill_null(-np.inf))
                floor = np.maximum(floor, found)
                floor = floor - 1e-9 * (np.abs(floor) + np.abs(dots).max(axis=1) + 1) - 1
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("vec_id", "v", "cell", "d", "grp")), pa.array(np.where(np.isnan(floor), -np.inf, floor))], ["vec_id", "v", "cell", "d", "grp", "floor"])

    return run


def _reach(width: int, shared):
    """The least distance in each cell at which a vector can matter to a query of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, least = shared.value, {}
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                q = _matrix(part.column("v"), width).astype(float)
                size = np.sqrt((q**2).sum(axis=1))[:, None]
                with np.errstate(divide="ignore", invalid="ignore"):
                    reach = np.where(size > 0, (np.asarray(part.column("floor"))[:, None] - q @ centres.T) / size, -np.inf)
                for g in np.unique(grp := np.asarray(part.column("grp"))):
                    own = reach[grp == g].min(axis=0)
                    least[g] = np.minimum(least[g], own) if g in least else own
        for g, reach in least.items():
            yield pa.record_batch([pa.array(np.full(len(reach), g, np.int32)), pa.array(np.arange(len(reach), dtype=np.int32)), pa.array(reach)], ["grp", "cell", "least"])

    return run


def _dealt(rows: DataFrame, number: Column, name: str) -> DataFrame:
    """Rows with one of ``number`` places by their id."""
    return rows.withColumn(name, F.pmod(F.xxhash64("vec_id"), number).cast("int"))


def _each(rows: DataFrame, number: Column, name: str) -> DataFrame:
    """Rows once for each of ``number`` places."""
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0), (number - 1).cast("int"))))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of (vec_id, embedding) nearest to each query by integer inner product."""
    spark = vectors.sparkSession
    rows = plain(vectors, vec_id="long", embedding="array<double>").where("vec_id is not null and embedding is not null")
    rows = rows.where(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    rows = rows.select("vec_id", F.transform("embedding", lambda x: F.floor(x * scale).cast("long")).alias("v"), is_query.alias("asked"))
    total, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    if not total or width is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots = _pivots(rows, total, width)
    shared = spark.sparkContext.broadcast(pivots)
    cells = stored(rows.mapInArrow(_assign(width, shared), "vec_id long, v array<long>, asked boolean, cell int, d double"), "voronoi-cells")
    one = F.min(F.struct("v", "cell", "d")).alias("one")
    queries = stored(cells.where("asked").groupBy("vec_id").agg(one).select("vec_id", "one.*"), "voronoi-queries")
    summary = spark.sparkContext.broadcast(_summary(cells, k))

    # neighbouring pivots share a group; tables of at most PIVOTS rows from here on
    n_queries = queries.count()
    group_of = _distances(pivots, fit_pivots(pivots, max(1, -(-n_queries // GROUP_QUERIES)))).argmin(axis=1)
    of_cell = spark.createDataFrame([(i, int(g)) for i, g in enumerate(group_of)], "cell int, grp int")
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / GROUP_QUERIES))
    salts = lambda n: F.greatest(F.lit(1), F.ceil(n / SALT_ROWS))
    sizes = stored(cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("d").alias("widest")).join(queries.groupBy("cell").agg(F.count("*").alias("asking")), "cell", "left"), "voronoi-sizes")

    # each query in its own cell
    plan = F.broadcast(sizes.where("asking > 0").select("cell", blocks(F.col("asking")).alias("blocks"), salts(F.col("n")).alias("salts")))
    columns = ("grp", "block", "salt", "cell", "d", "vec_id", "v")
    asked = _each(_dealt(queries.join(plan, "cell"), F.col("blocks"), "block"), F.col("salts"), "salt").withColumns({"grp": F.col("cell"), "floor": F.lit(float("-inf"))})
    data = _each(_dealt(cells.join(plan, "cell"), F.col("salts"), "salt"), F.col("blocks"), "block").withColumn("grp", F.col("cell"))
    own = _solved(asked.select(*columns, "floor"), data.select(*columns), k, width, shared)
    own = own.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("found"))

    # the groups, and what can matter to them
    known = queries.join(own, "vec_id", "left").join(F.broadcast(of_cell), "cell").select("vec_id", "v", "cell", "d", "grp", "found")
    known = stored(known.mapInArrow(_floors(k, width, shared, summary), "vec_id long, v array<long>, cell int, d double, grp int, floor double"), "voronoi-floors")
    reach = known.select("v", "grp", "floor").mapInArrow(_reach(width, shared), "grp int, cell int, least double").groupBy("grp", "cell").agg(F.min("least").alias("least"))
    # at most PIVOTS rows a group; whether it is broadcast is left to its size
    reach = stored(reach.join(F.broadcast(sizes.select("cell", "widest")), "cell").where("least <= widest").select("grp", "cell", "least"), "voronoi-reach")
    sent = cells.select("vec_id", "v", "cell", "d").join(reach, "cell").where("d >= least")
    plan = sent.groupBy("grp").agg(salts(F.count("*")).alias("salts")).join(known.groupBy("grp").agg(blocks(F.count("*")).alias("blocks")), "grp")
    plan = F.broadcast(stored(plan, "voronoi-plan"))
    asked = _each(_dealt(known.join(plan, "grp"), F.col("blocks"), "block"), F.col("salts"), "salt")
    data = _each(_dealt(sent.join(plan, "grp"), F.col("salts"), "salt"), F.col("blocks"), "block")
    return _solved(asked.select(*columns, "floor"), data.select(*columns), k, width, shared).select("query_id", "rank", "vec_id", "score")
