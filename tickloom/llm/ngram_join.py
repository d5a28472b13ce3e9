"""N-gram Jaccard join: rare-first prefixes, filters, one verification a pair.

A document's set holds its distinct word n-grams.  Two sets link when their
Jaccard similarity reaches ``percent`` hundredths.  Documents with equal sets
form a class and are handled as one.

1. One pass counts every document's n-grams into a sketch of fixed size and
   finds the class of each document.  The sketch gives a total order of
   n-grams, rarest first, ties by hash; any total order is exact, a rare-first
   one keeps frequent n-grams out of the prefixes.
2. A set of n n-grams posts its first n - ceil(percent * n / 100) + 1; linked
   sets share at least one posted n-gram.  Postings are grouped by n-gram; the
   ones that the sketch calls hot are dealt out over salts and their salts'
   leaders meet in a second grouping.
3. Rounds of verification.  In a leader round each class is compared with the
   leader that shares most of its posted n-grams, so a group of g near copies
   costs g comparisons.  The last round compares what is left, in blocks: every
   class that shares enough posted n-grams with a class of another component,
   if the length and suffix filters let it.  No link between components is lost, hence
   they are exact.  ``links()`` lists every linked pair instead.

Edge cases: null, empty and blank texts have an empty set, no class and no
link.  A row without doc_id takes part like any other and names no component.
Texts of fewer than ``width`` words have one n-gram, the whole sequence.
Repeated rows and ties share a class; ids decide nothing but the name of a
component.  An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.graph import components
from tickloom.llm.runtime import collect_sketch, key_bits, key_cells, merge_sketches, plain, sketch_rows
from tickloom.llm.textwords import FOLDED, chunks, rolling, split_words
from tickloom.storage import stored

SKETCH_WIDTH = 1 << 20
SKETCH_PARTS = 8
#: Postings of one n-gram in a group; a hotter n-gram is dealt out over more.
HOT = 20_000
#: Members that one task compares with a leader at a time.
FAN = 512
#: Sets, and n-grams in them, that one block compares with all that may link.
BLOCK = 1024
BLOCK_GRAMS = 1 << 21
#: Classes that pass one copy of a block; more go past further copies of it.
PASSING = 2048
#: Cells of the histogram behind the suffix filter.
CELLS = 48


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    words = split_words(texts, FOLDED)
    hashes = words.hashes()
    runs = rolling(hashes, width)
    out = []
    bounds = words.bounds.tolist()
    for start, end in zip(bounds, bounds[1:], strict=False):
        if end - start >= width:
            one = np.sort(runs[start : end - width + 1])
            if len(one) > 1:
                one = one[np.concatenate(([True], one[1:] != one[:-1]))]
        elif end > start:
            one = np.array([xxhash.xxh64_intdigest(hashes[start:end].tobytes(), end - start)], np.uint64)
        else:
            one = np.empty(0, np.uint64)
        out.append(one)
    return out


def class_of(one: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(one.tobytes()) - (1 << 63)


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of a set of n with any set that links with it."""
    return -(-percent * n // 100)


def _histogram(one: np.ndarray) -> bytes:
    return np.minimum(np.bincount((one >> np.uint64(40)).astype(np.int64) % CELLS, minlength=CELLS), 65535).astype("<u2").tobytes()


def _profile(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(SKETCH_WIDTH, np.uint32)
        names = ["doc_id", "row", "n", "cls", "shape", "part", "cells"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
        for batch in chunks(batches):
            sets = shingle_sets(batch.column("text"), width)
            if sum(map(len, sets)):
                cells += np.bincount((np.concatenate(sets) & np.uint64(SKETCH_WIDTH - 1)).astype(np.int64), minlength=SKETCH_WIDTH).astype(np.uint32)
            k = len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([_histogram(s) if len(s) else None for s in sets], pa.binary()),
                    pa.nulls(k, pa.int32()),
                    pa.nulls(k, pa.binary()),
                ],
                names,
            )
        rows = sketch_rows(cells, SKETCH_PARTS)
        k = rows.num_rows
        if k:
            yield pa.RecordBatch.from_arrays([*(pa.nulls(k, t) for t in types[:5]), *rows.columns], names)

    return run


def _postings(width: int, percent: int, sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.frombuffer(sketch.value, np.uint32)
        usual = int(counts.mean()) + 1
        seen: set[int] = set()
        for batch in chunks(batches):
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for one in shingle_sets(batch.column("text"), width):
                n = len(one)
                if not n or (c := class_of(one)) in seen:
                    continue
                seen.add(c)
                estimate = counts[(one & np.uint64(SKETCH_WIDTH - 1)).astype(np.int64)]
                first = np.argsort(estimate, kind="stable")[: n - int(needed(np.int64(n), percent)) + 1]
                k = len(first)
                for column, values in zip(
                    out,
                    (one[first].view(np.int64), np.full(k, c, np.int64), np.full(k, n, np.int32), np.arange(k, dtype=np.int32), (1 + np.maximum(estimate[first].astype(np.int64) - 2 * usual, 0) // HOT).astype(np.int32)),
                    strict=True,
                ):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["gram", "cls", "n", "pos", "salts"])

    return run


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Sorted batches with no run of equal keys cut in two."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = {name: np.asarray(batch.column(name)) for name in batch.schema.names}
        if held is not None:
            now = {k: np.concatenate([held[k], v]) for k, v in now.items()}
        last = np.ones(len(now[keys[0]]), bool)
        for k in keys:
            last &= now[k] == now[k][-1]
        cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
        held = {k: v[cut:] for k, v in now.items()}
        if cut:
            yield {k: v[:cut] for k, v in now.items()}
    if held is not None:
        yield held


def _starts(rows: dict[str, np.ndarray], keys: list[str]) -> np.ndarray:
    new = np.zeros(len(rows[keys[0]]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= rows[k][1:] != rows[k][:-1]
    return np.flatnonzero(new)


def _lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of two classes or more, each row with the first of its group; tasks may have posted a class several times."""
    for rows in _runs(batches, ["gram", "salt"]):
        once = _starts(rows, ["gram", "salt", "cls"])
        rows = {k: v[once] for k, v in rows.items()}
        starts = _starts(rows, ["gram", "salt"])
        sizes = np.diff(np.append(starts, len(rows["gram"])))
        lead = np.repeat(starts, sizes)
        last = np.repeat(starts + sizes - 1, sizes)
        # alone in its salt, a class may still meet those of other salts
        keep = (rows["cls"][lead] != rows["cls"][last]) | (rows["salts"] > 1)
        if keep.any():
            out = {k: v[keep] for k, v in rows.items() if k != "salt"}
            out |= {f"lead_{k}": rows[k][lead][keep] for k in ("cls", "n", "pos")}
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in out.items()})


_LED = "gram long, cls long, n int, pos int, salts int, lead_cls long, lead_n int, lead_pos int"


def _led(postings: DataFrame) -> DataFrame:
    dealt = postings.withColumn("salt", F.when(F.col("salts") > 1, F.pmod(F.xxhash64("cls"), F.col("salts").cast("long"))).otherwise(F.lit(0)).cast("int"))
    return dealt.repartition("gram", "salt").sortWithinPartitions("gram", "salt", "cls").mapInArrow(_lead, _LED)


def _possible(percent: int, n: Column, pos: Column, n2: Column, pos2: Column) -> Column:
    """The length and positional filters for two sets that share an n-gram at these ranks."""
    most = F.least(pos, pos2) + 1 + F.least(n - pos, n2 - pos2) - 1
    return (100 * F.least(n, n2) >= percent * F.greatest(n, n2)) & ((100 + percent) * most >= percent * (n + n2))


def _least_shared(percent: int, n: Column, n2: Column) -> Column:
    """How many posted n-grams two linked sets of these sizes share at least.

    With an overlap of o, the k-th shared n-gram has a rank below k + n - o in
    either set, so it is posted by both while that is within both prefixes.
    """
    overlap = F.ceil(percent * (n + n2) / (100 + percent))
    return F.greatest(F.lit(1), overlap - F.ceil(percent * F.greatest(n, n2) / 100) + 1)


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams shared by several components; rows outside the last of them, in the order of sizes, are loose."""
    for rows in _runs(batches, ["gram"]):
        once = _starts(rows, ["gram", "cls"])
        rows = {k: v[once] for k, v in rows.items()}
        grams = _starts(rows, ["gram"])
        last = np.repeat(np.append(grams[1:], len(rows["gram"])) - 1, np.diff(np.append(grams, len(rows["gram"]))))
        loose = rows["component"] != rows["component"][last]
        keep = np.repeat(rows["component"][grams] != rows["component"][last[grams]], np.diff(np.append(grams, len(last))))
        if keep.any():
            yield pa.RecordBatch.from_pydict({k: pa.array(rows[k][keep]) for k in ("gram", "cls", "n", "pos", "lead_cls", "place", "component")} | {"loose": pa.array(loose[keep])})


_MIXED = "gram long, cls long, n int, pos int, lead_cls long, place long, component long, loose boolean"


def _mixed_hot(rows: DataFrame) -> DataFrame:
    """The same for n-grams that are dealt over salts: their ends are found by partial aggregates, and joined salt by salt."""
    order = F.struct("place", "component")
    ends = rows.groupBy("gram").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.max("salts").alias("of")).where("first.component <> last.component")
    ends = ends.select("gram", F.col("last.component").alias("above"), F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("salt"))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("cls"), F.col("salts").cast("long")).cast("int")).join(ends, ["gram", "salt"])
    out = dealt.select("gram", "cls", "n", "pos", "lead_cls", "place", "component", (F.col("component") != F.col("above")).alias("loose"))
    return out.dropDuplicates(["gram", "cls"])


def _suffix(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, CELLS) for c in ("shape", "shape2"))
                n, n2 = (np.asarray(batch.column(c)) for c in ("n", "n2"))
                least = np.minimum(a, b)
                # a full cell stands for any number
                most = np.where((least == 65535).any(axis=1), np.minimum(n, n2), least.sum(axis=1, dtype=np.int64))
                keep = (100 + percent) * most >= percent * (n + n2)
                yield batch.filter(pa.array(keep)).select(["a", "b"])

    return run


def _filtered(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The suffix filter: sets differ at least by what their histograms differ."""
    one = classes.select(F.col("cls").alias("a"), "n", "shape")
    two = classes.select(F.col("cls").alias("b"), F.col("n").alias("n2"), F.col("shape").alias("shape2"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "n", "n2", "shape", "shape2").mapInArrow(_suffix(percent), "a long, b long")


def _verify(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        leader, key = None, None

        def pieces() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    yield batch.slice(start, 256)

        for batch in pieces():
            texts = pa.array([unpack(x) for x in batch.column("packed").to_pylist()], pa.large_binary())
            plain = pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("salt"), batch.column("cls"), batch.column("role"), texts], ["grp", "salt", "cls", "role", "text"])
            for part in chunks(iter([plain])):
                a, b = [], []
                rows = zip(part.column("grp").to_pylist(), part.column("salt").to_pylist(), part.column("role").to_pylist(), part.column("cls").to_pylist(), shingle_sets(part.column("text"), width), strict=True)
                for grp, salt, role, cls, one in rows:
                    if role == 0:
                        leader, key = one, (grp, salt)
                    elif key == (grp, salt) and len(one) and len(leader):
                        small, large = (one, leader) if len(one) <= len(leader) else (leader, one)
                        at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                        both = int((large[at] == small).sum())
                        if 100 * both >= percent * (len(one) + len(leader) - both):
                            a.append(grp)
                            b.append(cls)
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _blocks(width: int, percent: int):
    """Linked components: each block's sets (role 0) against what streams past them (role 1).

    Two sets are compared where the one of the smaller component is held, so
    nowhere twice.  A link joins two components; further links between what is
    joined already are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        now, parts, sets, shapes, known = None, [], [], None, None
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (above := parent.setdefault(x, x)) != x:
                parent[x] = parent[above]
                x = above
            return x

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    texts = pa.array([unpack(x) for x in part.column("packed").to_pylist()], pa.large_binary())
                    names = ["grp", "salt", "role", "place", "component", "cls", "failed"]
                    plain = pa.RecordBatch.from_arrays([*map(part.column, names), texts], [*names, "text"])
                    for small in chunks(iter([plain])):
                        yield from zip(*(small.column(c).to_pylist() for c in names), shingle_sets(small.column("text"), width), strict=True)

        a: list[int] = []
        b: list[int] = []
        for grp, salt, role, place, component, cls, failed, one in rows():
            if (grp, salt) != now:
                now, parts, sets, shapes, known = (grp, salt), [], [], None, None
                parent.clear()
            if role == 0:
                parts.append((place, component, cls, failed))
                sets.append(one)
                continue
            if known is None:
                n = np.array([len(s) for s in sets])
                shapes = np.stack([np.frombuffer(_histogram(s), "<u2") for s in sets]).astype(np.int64)
                flat = np.concatenate(sets)
                order = np.argsort(flat, kind="stable")
                known, holder = flat[order], np.repeat(np.arange(len(sets)), n)[order]
            need = -(-percent * (n + len(one)) // (100 + percent))
            shape = np.frombuffer(_histogram(one), "<u2").astype(np.int64)
            most = np.minimum(shapes, shape).sum(axis=1) if len(one) < 65535 else np.minimum(n, len(one))
            mine = root(component)
            near = np.flatnonzero((np.minimum(most, np.minimum(n, len(one))) >= need) | (n >= 65535)).tolist()
            open_sets = [k for k in near if parts[k][:2] < (place, component) and root(parts[k][1]) != mine and parts[k][2] != failed and parts[k][3] != cls]
            if not open_sets:
                continue
            low, high = np.searchsorted(known, one), np.searchsorted(known, one, side="right")
            times = high - low
            at = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
            both = np.bincount(holder[at], minlength=len(sets))
            for k in open_sets:
                if 100 * both[k] >= percent * (n[k] + len(one) - both[k]) and root(parts[k][1]) != root(component):
                    parent[root(parts[k][1])] = root(component)
                    a.append(parts[k][1])
                    b.append(component)
            if len(a) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The linked pairs among (a, b), each compared once.

    The leader a is held as one set; its members stream past it, at most about
    FAN to a task.
    """
    fans = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(FAN)).cast("int").alias("fans"))
    members = pairs.join(fans, "a").select(F.col("b").alias("cls"), F.col("a").alias("grp"), F.pmod(F.xxhash64("b"), F.col("fans").cast("long")).cast("int").alias("salt"), F.lit(1).alias("role"))
    leaders = fans.select(F.col("a").alias("cls"), F.col("a").alias("grp"), F.explode(F.sequence(F.lit(0), F.col("fans") - 1)).alias("salt"), F.lit(0).alias("role"))
    rows = members.unionByName(leaders).join(texts, "cls").select("cls", "grp", "salt", "role", "packed")
    return rows.repartition("grp", "salt").sortWithinPartitions("grp", "salt", "role").mapInArrow(_verify(width, percent), "a long, b long")


def _packed(bits):
    """Rows whose bit is set, with their texts packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        wanted = np.frombuffer(bits.value, np.uint8)

        def marked() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cell = key_cells(np.asarray(batch.column("row")), 8 * len(wanted))
                yield batch.filter(pa.array((wanted[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0))

        for part in chunks(marked()):
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array([None if x is None else pack(x) for x in part.column("text").cast(pa.large_binary()).to_pylist()], pa.binary())], ["row", "packed"])

    return run


class JaccardJoin:
    """The join of ``documents`` (doc_id, text) with itself."""

    def __init__(self, documents: DataFrame, width: int = 5, percent: int = 75):
        # rows are told apart by id and text, as either may be missing or repeat
        self.documents = plain(documents, doc_id="long", text="string").withColumn("row", F.xxhash64("doc_id", "text"))
        self.width, self.percent = width, percent
        profile = stored(self.documents.mapInArrow(_profile(width), "doc_id long, row long, n long, cls long, shape binary, part int, cells binary"), "jaccard-profile")
        #: doc_id, row, n (size of its set), cls (its class, null if the set is empty)
        self.members = profile.where("part is null").select("doc_id", "row", "n", "cls")
        #: cls, n, shape, doc_id (the smallest of the class), row (one of its texts)
        self.classes = profile.where("cls is not null").groupBy("cls").agg(F.min("n").alias("n"), F.min("shape").alias("shape"), F.min("doc_id").alias("doc_id"), F.min("row").alias("row"))
        self._sketch = collect_sketch(merge_sketches(profile.where("part is not null").select("part", "cells"), SKETCH_PARTS, "uint32"), SKETCH_WIDTH, SKETCH_PARTS, "uint32")

    def _led(self) -> DataFrame:
        """Postings of shared n-grams with their leaders."""
        sketch = self.documents.sparkSession.sparkContext.broadcast(self._sketch.tobytes())
        postings = self.documents.select("text").mapInArrow(_postings(self.width, self.percent, sketch), "gram long, cls long, n int, pos int, salts int")
        out = stored(_led(postings), "jaccard-postings")
        sketch.unpersist()
        return out

    def _texts(self, classes: DataFrame) -> DataFrame:
        """The packed text of one document of each of the classes (cls); the other texts stay where they are."""
        wanted = stored(classes.distinct().join(self.classes, "cls").select("cls", "row"), "jaccard-wanted")
        bits = wanted.sparkSession.sparkContext.broadcast(key_bits(wanted.select("row")).tobytes())
        out = stored(self.documents.select("row", "text").mapInArrow(_packed(bits), "row long, packed binary").join(wanted, "row").dropDuplicates(["cls"]).select("cls", "packed"), "jaccard-texts")
        bits.unpersist()
        return out

    def _checked(self, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The linked ones of the pairs, and the pairs that were compared."""
        pairs = stored(_filtered(pairs, self.classes, self.percent), "jaccard-pairs")
        texts = self._texts(pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))))
        return _verified(pairs, texts, self.width, self.percent), pairs

    def _leader_round(self, led: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Linked pairs, and compared ones, of each class and the leader that shares most of its n-grams.

        Counts are of n-grams that have this leader, so a pair below the least
        number may still be linked; the last round looks at it again.
        """
        # leaders of the salts of hot n-grams, with the leader of them all
        salts = led.where("salts > 1").select("gram", F.col("lead_cls").alias("cls"), F.col("lead_n").alias("n"), F.col("lead_pos").alias("pos"), F.lit(1).alias("salts")).distinct()
        shared = led.unionByName(_led(salts)).where("cls <> lead_cls").where(_possible(self.percent, F.col("n"), F.col("pos"), F.col("lead_n"), F.col("lead_pos")))
        votes = shared.groupBy(F.col("lead_cls").alias("a"), F.col("cls").alias("b")).agg(F.count("*").alias("count"), F.min("n").alias("n"), F.min("lead_n").alias("lead_n"))
        votes = votes.where(F.col("count") >= _least_shared(self.percent, F.col("n"), F.col("lead_n")))
        return self._checked(votes.groupBy("b").agg(F.max_by("a", F.struct("count", "a")).alias("a")).select("a", "b"))

    def _pairs(self, led: DataFrame) -> DataFrame:
        """Linked pairs of all classes that share enough posted n-grams."""
        rows = led.select("gram", "cls", "n", "pos").distinct()
        two = rows.select("gram", *(F.col(c).alias(f"{c}2") for c in ("cls", "n", "pos")))
        pairs = rows.join(two, "gram").where(F.col("cls") < F.col("cls2"))
        pairs = pairs.where(_possible(self.percent, F.col("n"), F.col("pos"), F.col("n2"), F.col("pos2")))
        pairs = pairs.groupBy(F.col("cls").alias("a"), F.col("cls2").alias("b")).agg(F.count("*").alias("count"), F.min("n").alias("n"), F.min("n2").alias("n2"))
        return self._checked(pairs.where(F.col("count") >= _least_shared(self.percent, F.col("n"), F.col("n2"))).select("a", "b"))[0]

    def _rest(self, led: DataFrame, labels: DataFrame, failed: DataFrame) -> DataFrame:
        """Linked pairs (a, b) of components whose classes share enough posted n-grams.

        Components are ordered by size, then name.  In each n-gram's group the
        classes outside the last component are loose, so of two classes of
        different components the one of the smaller is loose in every n-gram
        that they share.  Loose classes of one family and nearly one size form
        blocks; a class of a larger component passes a block if it shares as
        many n-grams with the block's loose classes as a link with a set of its
        sizes takes.  A pair that failed in the leader round (cls, failed) isn't
        compared again.  So a pair is compared once, and a group costs rows by the
        number of blocks, not of pairs.
        """
        sized = labels.join(labels.groupBy("component").agg(F.count("*").alias("size")), "component").withColumnRenamed("node", "cls")
        rows = led.select("gram", "cls", "n", "pos", "salts", "lead_cls").join(sized, "cls", "left").withColumns({"component": F.coalesce("component", "cls"), "size": F.coalesce("size", F.lit(1))})
        # the order in one number, as far as it goes; components that tie in it are told apart by name
        place = F.shiftleft(F.least("size", F.lit(32767)), 48) + F.shiftrightunsigned("component", 16)
        rows = rows.withColumn("place", place).drop("size")
        usual = rows.where("salts = 1").repartition("gram").sortWithinPartitions("gram", "place", "component", "cls").mapInArrow(_mixed, _MIXED)
        rows = stored(usual.unionByName(_mixed_hot(rows.where("salts > 1"))), "jaccard-rest")
        own = [F.min(c).alias(c) for c in ("n", "place", "component")]
        step = F.floor(F.log("n") / float(np.log(1.05)))
        loose = rows.where("loose").groupBy("cls").agg(F.min("lead_cls").alias("family"), *own).withColumn("step", step)
        heaps = loose.groupBy("family", "step").agg(F.ceil(F.greatest(F.count("*") / F.lit(BLOCK), F.sum("n") / F.lit(BLOCK_GRAMS))).cast("int").alias("heaps"), F.min("n").alias("low"), F.max("n").alias("high"))
        heap = F.pmod(F.xxhash64("cls"), F.col("heaps").cast("long")).cast("int")
        held = stored(loose.join(heaps, ["family", "step"]).select("cls", "place", "component", F.xxhash64("family", "step", heap).alias("grp"), "low", "high"), "jaccard-blocks")
        sizes = [F.min("low").alias("low"), F.max("high").alias("high")]
        ranks = [F.max("pos").alias("before"), F.max(F.col("n") - F.col("pos")).alias("after")]
        asked = rows.where("loose").select("gram", "cls", "n", "pos").join(held, "cls").groupBy("gram", "grp").agg(*sizes, *ranks, F.min("place").alias("first"))
        passing = rows.select("gram", "cls", "n", "pos", "place", "component").join(asked, "gram").where((F.col("place") >= F.col("first")) & (100 * F.col("n") >= self.percent * F.col("low")) & (100 * F.col("high") >= self.percent * F.col("n")))
        # the positional filter, for the block's set that it leaves most to
        most = F.least(F.col("pos"), F.col("before")) + F.least(F.col("n") - F.col("pos"), F.col("after"))
        passing = passing.where((100 + self.percent) * most >= self.percent * (F.col("n") + F.col("low")))
        passing = passing.groupBy("grp", "cls").agg(F.count("*").alias("count"), *own, *sizes)
        # the least number falls towards either end of the block's sizes; one less allows for rounding
        least = F.least(_least_shared(self.percent, F.col("low"), F.col("n")), _least_shared(self.percent, F.col("high"), F.col("n"))) - 1
        passing = passing.where(F.col("count") >= least).select("grp", "cls", "place", "component")
        # a block that only its own single class passes has nothing to compare
        met = passing.select("grp", "cls").unionByName(held.select("grp", "cls")).groupBy("grp").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).where("a <> b").select("grp")
        passing = stored(passing.join(met, "grp", "left_semi"), "jaccard-passing")
        copies = passing.groupBy("grp").agg(F.ceil(F.count("*") / F.lit(PASSING)).cast("int").alias("copies"))
        texts = self._texts(passing.select("cls").unionByName(held.join(copies, "grp", "left_semi").select("cls")))
        copy = F.pmod(F.xxhash64("cls"), F.col("copies").cast("long")).cast("int")
        dealt = passing.join(copies, "grp").select("grp", copy.alias("salt"), F.lit(1).alias("role"), "cls", "place", "component")
        blocks = held.join(copies, "grp").select("grp", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"), F.lit(0).alias("role"), "cls", "place", "component")
        named = dealt.unionByName(blocks).join(failed, "cls", "left").join(texts, "cls").select("grp", "salt", "role", "place", "component", "cls", "failed", "packed")
        return named.repartition("grp", "salt").sortWithinPartitions("grp", "salt", "role").mapInArrow(_blocks(self.width, self.percent), "a long, b long").distinct()

    def links(self) -> DataFrame:
        """Every linked pair of different classes, by their smallest documents: (doc_id, other_id)."""
        found = self._pairs(self._led())
        name = self.classes.select("cls", "doc_id")
        found = found.join(name.withColumnRenamed("cls", "a"), "a").join(name.select(F.col("cls").alias("b"), F.col("doc_id").alias("second")), "b")
        return found.select(F.least("doc_id", "second").alias("doc_id"), F.greatest("doc_id", "second").alias("other_id"))

    def components(self) -> DataFrame:
        """doc_id, n (size of the set), component_id (smallest document reachable by links), row (the hash of id and text), component (its key; null for empty sets)."""
        led = self._led()
        linked, compared = self._leader_round(led)
        first = stored(linked, "jaccard-links")
        # a class is compared with one leader, so there is one failed pair of it at most
        failed = compared.join(first, ["a", "b"], "left_anti").select(F.col("b").alias("cls"), F.col("a").alias("failed"))
        labels = components(first)
        named = self.classes.select("cls", "doc_id").join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        second = stored(self._rest(led, labels, failed), "jaccard-links")
        if second.limit(1).count():
            above = components(second).select(F.col("node").alias("component"), F.col("component").alias("above"))
            named = named.join(above, "component", "left").withColumn("component", F.coalesce("above", "component"))
        smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
        names = named.join(smallest, "component").select("cls", "component_id", "component")
        return self.members.join(names, "cls", "left").select("doc_id", "n", F.coalesce("component_id", "doc_id").alias("component_id"), "row", "component")
