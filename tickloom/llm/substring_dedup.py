"""Substring dedup: a count-min prefilter, then exact grouping of what it lets through.

A window is ``width`` consecutive words of one document.  Every word covered by
a window whose word sequence also starts anywhere else is removed.

1. Each window has an anchor: the leftmost smallest 8-word hash inside it.
   Equal windows have equal anchors at equal distances, so two places of a
   window are two places of its anchor.  Partition sketches count the anchors'
   places in two rows of counters, as far as two: merged, they never say once of a
   window that is there twice.
2. Windows whose estimate is two are grouped exactly, by a 96-bit hash.
   A window seen twice in one chunk is known to repeat at once: its places are
   kept as ranges, and one representative goes on, so that a passage in a third
   of all documents sends a row per chunk, not per copy.
3. A last pass joins each document with suspect windows with its repeated places and
   drops the words; the others pass it spread evenly.  Rows with equal id and text are
   one document, sent once by a task along with how many they are.

The sketch's size is fixed (``cells`` bits a row).  On corpora far larger than
that it lets more windows through; none is ever lost.

Edge cases: null, empty and blank texts have no words and keep the hash of the
empty string.  Texts shorter than a window keep all words.  A repeated row
repeats all its windows.  Rows may lack a doc_id or share one.  An empty table
gives no rows, and extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.runtime import plain
from tickloom.llm.textwords import RAW, Words, chunks, mixed, rolling, split_words

GRAM = 8
PLACE_BITS = 24
PARTS = 64
FLUSH = 4_000_000
#: Copies of a row that come back from one array.
COPIES = 4096
_PLACE = np.uint64(PLACE_BITS)


def _smallest(values: np.ndarray, span: int) -> np.ndarray:
    """The minimum of every ``span`` consecutive values."""
    reach, out = 1, values
    while 2 * reach <= span:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = span - reach
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def anchors(hashes: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A 40-bit anchor for each place of an anchor, and the place that each window start uses."""
    span = width - GRAM + 1
    grams = rolling(hashes, GRAM)
    found, use, base = [], np.empty(len(starts), np.int64), 0
    piece = (1 << PLACE_BITS) - span
    for low in range(0, len(grams) - span + 1, piece):
        part = grams[low : low + piece + span - 1]
        packed = ((part >> _PLACE) << _PLACE) | np.arange(len(part), dtype=np.uint64)
        least = _smallest(packed, span)
        here = slice(*np.searchsorted(starts, [low, low + len(least)]))
        own = least[starts[here] - low]
        if not len(own):
            continue
        new = np.ones(len(own), bool)
        new[1:] = own[1:] != own[:-1]
        use[here] = base + np.cumsum(new) - 1
        found.append(own[new] >> _PLACE)
        base += int(new.sum())
    return (np.concatenate(found) if found else np.empty(0, np.uint64)), use


def _cells(anchor: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64(cells - 1)
    return anchor & low, mixed(anchor) & low


def _starts(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Window starts and the text of each."""
    counts = np.maximum(words.counts - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    first = words.bounds[:-1] - (np.cumsum(counts) - counts)
    return first[owner] + np.arange(len(owner)), owner


def _count(width: int, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            step = cells // PARTS
            parts, blobs = [], []
            for row, cell in enumerate(_cells(np.concatenate(held), cells)):
                cell, times = np.unique(cell, return_counts=True)
                cuts = np.searchsorted(cell, np.arange(0, cells + 1, step, dtype=np.uint64))
                for k in range(PARTS):
                    if cuts[k] < cuts[k + 1]:
                        one = slice(cuts[k], cuts[k + 1])
                        at = (cell[one] - np.uint64(k * step)).astype("<u4")
                        parts.append(row * PARTS + k)
                        blobs.append(zlib.compress(np.diff(at, prepend=np.uint32(0)).astype("<u4").tobytes() + np.minimum(times[one], 2).astype(np.uint8).tobytes(), 1))
            held.clear()
            yield pa.record_batch({"part": pa.array(parts, pa.int32()), "places": pa.array(blobs, pa.binary())})

        for batch in chunks(batches):
            words = split_words(batch.column("text"), RAW)
            starts, _ = _starts(words, width)
            held.append(anchors(words.hashes(), starts, width)[0])
            if sum(map(len, held)) > FLUSH:
                yield from flush()
        yield from flush()

    return run


def _merge(cells: int):
    step = cells // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = zlib.decompress(blob)
                n = len(raw) // 5
                at = np.cumsum(np.frombuffer(raw, "<u4", n)).astype(np.int64)
                total = sums.setdefault(part, np.zeros(step, np.uint8))
                total[at] = np.minimum(total[at] + np.frombuffer(raw, np.uint8, n, 4 * n), 2)
        if sums:
            keys = sorted(sums)
            yield pa.record_batch({"part": pa.array(keys, pa.int32()), "bits": pa.array([zlib.compress(np.packbits(sums[k] > 1, bitorder="little").tobytes(), 1) for k in keys], pa.binary())})

    return run


def _estimate(bits: bytes, anchor: np.ndarray, cells: int) -> np.ndarray:
    """Whether the sketch counts an anchor twice or more."""
    table = np.frombuffer(bits, np.uint8).reshape(2, cells // 8)
    out = np.ones(len(anchor), bool)
    for row, cell in zip(table, _cells(anchor, cells), strict=True):
        cell = cell.astype(np.int64)
        out &= (row[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0
    return out


def _ranges(owner: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of runs of consecutive places of one text."""
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1] + 1) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(place)))


_WINDOWS = "gram long, more int, times int, key long, place int, length int"


def _suspects(width: int, cells: int, sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = zlib.decompress(sketch.value)
        for batch in chunks(batches):
            words = split_words(batch.column("text"), RAW)
            hashes = words.hashes()
            starts, owner = _starts(words, width)
            anchor, use = anchors(hashes, starts, width)
            keep = _estimate(bits, anchor, cells)[use] if len(starts) else np.empty(0, bool)
            if not keep.any():
                continue
            starts, owner = starts[keep], owner[keep]
            gram = rolling(hashes, width)[starts]
            more = rolling(mixed(hashes), width, 2)[starts].astype(np.uint32).view(np.int32)
            key = np.asarray(batch.column("key"))[owner]
            place = (starts - words.bounds[:-1][owner]).astype(np.int32)
            order = np.lexsort((more, gram))
            same = np.zeros(len(order) + 1, bool)
            same[1:-1] = (gram[order][1:] == gram[order][:-1]) & (more[order][1:] == more[order][:-1])
            times = np.ones(len(order), np.int32)
            # the first place of each repeated window goes on for all of its chunk
            times[order] = np.where(same[:-1], 0, np.where(same[1:], 2, 1))
            known = np.zeros(len(order), bool)
            known[order] = same[:-1] | same[1:]
            sent = times > 0
            k = int(sent.sum())
            yield pa.record_batch([pa.array(x) for x in (gram[sent].view(np.int64), more[sent], times[sent], key[sent], place[sent], np.ones(k, np.int32))], ["gram", "more", "times", "key", "place", "length"])
            if known.any():
                own, at, names = owner[known], place[known], key[known]
                first, length = _ranges(own, at)
                # rows with equal id and text have equal ranges
                once = np.unique(np.stack([names[first], at[first], length]), axis=1, return_index=True)[1]
                first, length = first[once], length[once]
                k = len(first)
                spread = mixed(names[first].view(np.uint64) + at[first].astype(np.uint64)).view(np.int64)
                yield pa.record_batch([pa.array(x) for x in (spread, np.zeros(k, np.int32), np.zeros(k, np.int32), names[first], at[first], length.astype(np.int32))], ["gram", "more", "times", "key", "place", "length"])

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by window: those of windows with two places, and all ranges known to repeat.

    Only the last row and whether its window has repeated are held.
    """
    held: pa.RecordBatch | None = None
    open_key, open_twice = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        gram, more, times = (np.asarray(batch.column(c)) for c in ("gram", "more", "times"))
        n = len(gram)
        edge = np.ones(n + 1, bool)
        edge[1:-1] = (gram[1:] != gram[:-1]) | (more[1:] != more[:-1]) | (times[1:] == 0) | (times[:-1] == 0)
        first = np.flatnonzero(edge[:-1])
        sizes = np.diff(np.append(first, n))
        twice = (sizes > 1) | (times[first] > 1)
        goes_on = open_key == (gram[0], more[0]) and times[0] > 0
        if goes_on:
            twice[0] = True
        if held is not None and goes_on and not open_twice:
            yield held
        held = None
        keep = np.repeat(twice, sizes) | (times == 0)
        open_key = (gram[-1], more[-1]) if times[-1] > 0 else None
        open_twice = bool(twice[-1])
        if open_key is not None and not keep[-1]:
            held = batch.slice(n - 1, 1).select(["key", "place", "length"])
        yield batch.filter(pa.array(keep)).select(["key", "place", "length"])


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


_TEXTS = "key long, doc_id long, place int, length int, n_words long, packed binary, sha string, kept string, copies int"


def _texts(width: int, cells: int, sketch, with_text: bool):
    """Whole results of documents without suspects; of the others packed words, or how many more of them a chunk has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        bits = zlib.decompress(sketch.value)
        sent: set[int] = set()
        so_far = 0
        for batch in chunks(batches):
            texts = batch.column("text").cast(pa.large_binary())
            words = split_words(texts, RAW)
            starts, owner = _starts(words, width)
            anchor, use = anchors(words.hashes(), starts, width)
            suspect = np.zeros(len(texts), bool)
            if len(starts):
                suspect[owner[_estimate(bits, anchor, cells)[use]]] = True
            key = np.asarray(batch.column("key"))
            # results need no other row, so they go anywhere
            route = np.where(suspect, key, mixed((np.arange(len(key)) + so_far).astype(np.uint64) ^ key.view(np.uint64)).view(np.int64))
            so_far += len(key)
            times: dict[int, list[int]] = {}
            rows, packed, shas, kept, copies = [], [], [], [], []
            for i, (text, held) in enumerate(zip(texts.to_pylist(), suspect.tolist(), strict=True)):
                name = int(key[i])
                if held and name in times:
                    times[name][0] += 1
                    continue
                rows.append(i)
                one = b"" if held else b" ".join((text or b"").split())
                packed.append(pack(text) if held and name not in sent else None)
                shas.append(None if held else hashlib.sha256(one).hexdigest())
                kept.append(one.decode() if with_text and not held else None)
                copies.append(times.setdefault(name, [1]) if held else [1])
            sent.update(times)
            n, at = len(rows), pa.array(rows, pa.int64())
            yield pa.record_batch(
                [pa.array(route[rows]), batch.column("doc_id").take(at), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.array(words.counts[rows], pa.int64()), pa.array(packed, pa.binary()), pa.array(shas, pa.string()), pa.array(kept, pa.string()), pa.array([c[0] for c in copies], pa.int32())],
                ["key", "doc_id", "place", "length", "n_words", "packed", "sha", "kept", "copies"],
            )

    return run


def _cut(width: int, with_text: bool):
    """The text of a key, then its repeated places; held are one text and a number a word of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        out: list[tuple] = []
        now, text, copies, edges = None, None, 0, np.empty(0, np.int64)

        def close() -> None:
            if text is None:
                return
            doc_id, n, packed = text
            words = unpack(packed).split()
            gone = np.cumsum(edges[:n]) > 0
            left = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            out.append((doc_id, n, int(gone.sum()), _digest(left), b" ".join(left).decode() if with_text else None, copies))

        def result() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "copies"])
            out.clear()
            return done

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.asarray(batch.column("key"))
            is_text = np.asarray(batch.column("place").is_null())
            bounds = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if now != key[start]:
                    close()
                    now, text, copies = key[start], None, 0
                k = int(is_text[start:end].sum())
                for doc_id, n, packed, sha, kept, times in zip(*(batch.column(c).slice(start, k).to_pylist() for c in ("doc_id", "n_words", "packed", "sha", "kept", "copies")), strict=True):
                    if sha is not None:
                        out.append((doc_id, n, 0, sha, kept, 1))
                        continue
                    copies += times
                    if packed is not None and text is None:
                        text, edges = (doc_id, n, packed), np.zeros(n + 1, np.int64)
                if start + k < end:
                    place, length = (np.asarray(batch.column(c).slice(start + k, end - start - k), np.int64) for c in ("place", "length"))
                    np.add.at(edges, place, 1)
                    np.add.at(edges, np.minimum(place + length + width - 1, len(edges) - 1), -1)
            if len(out) >= 2000 or with_text and out:
                yield result()
        close()
        if out:
            yield result()

    return run


def remove_repeats(documents: DataFrame, width: int = 35, cells: int = 1 << 26, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept text, one row per row of (doc_id, text)."""
    spark = documents.sparkSession
    rows = plain(documents, doc_id="long", text="string")
    # rows are told apart by id and text, as either may be missing or repeat
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    counted = rows.select("text").mapInArrow(_count(width, cells), "part int, places binary")
    merged = counted.repartition(PARTS, "part").mapInArrow(_merge(cells), "part int, bits binary")
    bits = np.zeros((2 * PARTS, cells // PARTS // 8), np.uint8)
    for part, blob in merged.collect():
        bits[part] = np.frombuffer(zlib.decompress(blob), np.uint8)
    sketch = spark.sparkContext.broadcast(zlib.compress(bits.tobytes(), 1))
    suspects = rows.select("key", "text").mapInArrow(_suspects(width, cells, sketch), _WINDOWS)
    repeated = suspects.repartition("gram", "more").sortWithinPartitions("gram", "more").mapInArrow(_repeated, "key long, place int, length int")
    texts = rows.mapInArrow(_texts(width, cells, sketch, with_text), _TEXTS)
    both = texts.unionByName(repeated, allowMissingColumns=True)
    order = ["key", F.col("place").asc_nulls_first(), F.col("packed").asc_nulls_last()]
    cut = both.repartition("key").sortWithinPartitions(*order).mapInArrow(_cut(width, with_text), f"{_RESULT}, copies long")
    # a row for each copy, an array of them at a time
    blocks = cut.withColumn("block_", F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {COPIES}"))))
    rows = blocks.withColumn("copy_", F.explode(F.sequence(F.lit(1), F.least(F.lit(COPIES), F.col("copies") - COPIES * F.col("block_")))))
    return rows.drop("copies", "block_", "copy_")
