"""Repeated substrings of ``LENGTH`` bytes, by suffix sorting around shared anchors.

A byte is removed if some string of ``LENGTH`` bytes that covers it starts anywhere else too.  Sorting
every suffix of the corpus would move each byte hundreds of times, so only suffixes that start at
anchors are sorted.  An anchor is a position whose k-gram has the smallest hash of all k-grams in some
string of ``LENGTH`` bytes.  Equal strings have the same smallest k-gram at the same offset, so two
occurrences of a string share an anchor, and each string is compared at it:

1. Anchors are hashed and counted over the corpus; a bitmap of bounded size marks those seen twice.
   Other anchors can't lie in a repeated string.  A bit that is set by chance only costs a comparison.
2. The surroundings of marked anchors (all strings that contain them) are counted, equal ones once.
3. Surroundings with the same k-gram are suffix-sorted to the right of the anchor and, reversed, to
   its left: a merge sort whose comparisons find the common extension by binary search over
   polynomial prefix hashes.  Neighbours are then compared byte by byte, which gives exact common
   extensions and tells a hash collision.  Two strings that start d bytes before their anchors are
   equal if the right sides share LENGTH - d bytes and the left sides share d.
4. The spans go back to their documents.

An anchor with more than ``crowd`` different surroundings is not sorted in one task: its strings are
hashed (128 bits), counted by hash over the cluster, and those seen twice looked up again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from firegrid.llm.common import map_batches
from firegrid.operators.joins import hot_lookup
from firegrid.session import cut, cut_counted

LENGTH = 200
GRAM = 48
CROWD = 20_000
CHUNK_ROWS = 20_000
CHUNK_BYTES = 1 << 20
MAX_BITMAP_BITS = 28
_PAGE = 32_768
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Finds anchors of byte strings; keeps the powers it needs."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, gram
        size = CHUNK_BYTES + length
        self.up, self.down = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
        self.low = np.uint64((1 << (size.bit_length())) - 1)

    def find(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Positions and k-gram hashes of the anchors of ``data``, ascending."""
        if len(data) < self.length:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        whole = np.frombuffer(data, np.uint8)
        at, hashes = [], []
        for start in range(0, len(data) - self.length + 1, CHUNK_BYTES):
            a, h = self._chunk(whole[start:start + CHUNK_BYTES + self.length - 1])
            at.append(a + start)
            hashes.append(h)
        if len(at) == 1:
            return at[0], hashes[0]
        places, first = np.unique(np.concatenate(at), return_index=True)
        return places, np.concatenate(hashes)[first]

    def _chunk(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(data), self.gram
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        h = (sums[k:] - sums[:-k]) * self.down[:n - k + 1]
        h ^= h >> np.uint64(31)
        h *= _MIX
        h ^= h >> np.uint64(29)
        # Smallest of every run of w hashes; the position in the low bits makes the leftmost win.
        w, m = self.length - k + 1, len(h)
        packed = np.full(-(-m // w) * w, np.iinfo(np.uint64).max, np.uint64)
        packed[:m] = (h & ~self.low) | np.arange(m, dtype=np.uint64)
        blocks = packed.reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        best = (np.minimum(behind[:m - w + 1], ahead[w - 1:m]) & self.low).astype(np.int64)
        at = best[np.r_[True, best[1:] != best[:-1]]]
        return at, h[at]


def _prefix_hashes(rows: np.ndarray) -> np.ndarray:
    """hashes[j, i]: polynomial hash of the first j bytes of row i."""
    out = np.zeros((rows.shape[1] + 1, rows.shape[0]), np.uint64)
    for j, column in enumerate(np.ascontiguousarray(rows.T)):
        out[j + 1] = out[j] * _BASE + column + np.uint64(1)
    return out


def _common(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows a[i] and b[i], by binary search over their prefix hashes."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), hashes.shape[0] - 1)
    for _ in range((hashes.shape[0] - 1).bit_length()):
        mid = (low + high + 1) >> 1
        same = hashes[mid, a] == hashes[mid, b]
        low, high = np.where(same, mid, low), np.where(same, high, np.maximum(low, mid - 1))
    return low


def _less(rows: np.ndarray, hashes: np.ndarray, a: np.ndarray, b: np.ndarray, ties: bool) -> np.ndarray:
    """Row a[i] before row b[i]; equal rows count as before if ``ties``."""
    n = _common(hashes, a, b)
    at = np.minimum(n, rows.shape[1] - 1)
    return np.where(n == rows.shape[1], ties, rows[a, at] < rows[b, at])


def suffix_sort(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): the sorted order of the rows of a byte matrix and the common prefix of each with the one before.

    Bottom-up merge sort; the place of an element in the run it is merged with is found by binary
    search.  Neighbours are verified byte by byte: a hash collision shows as a wrong order, and then
    the rows are sorted as plain strings.
    """
    m = len(rows)
    order = np.arange(m)
    if m > 1:
        hashes = _prefix_hashes(rows)
        width = 1
        while width < m:
            place = np.arange(m)
            start = place // (2 * width) * (2 * width)
            left = place - start < width
            other = np.where(left, np.minimum(start + width, m), start)
            size = np.where(left, np.minimum(start + 2 * width, m), np.minimum(start + width, m)) - other
            low, high = np.zeros(m, np.int64), size.copy()
            while (low < high).any():
                mid = (low + high) >> 1
                open_ = np.flatnonzero(low < high)
                theirs, own = order[other[open_] + mid[open_]], order[open_]
                # Stable: an equal element of the left run comes first.
                before = np.where(left[open_], _less(rows, hashes, theirs, own, False), _less(rows, hashes, theirs, own, True))
                low[open_] = np.where(before, mid[open_] + 1, low[open_])
                high[open_] = np.where(before, high[open_], mid[open_])
            own = np.where(left, place - start, place - start - width)
            merged = np.empty(m, np.int64)
            merged[start + own + low] = order
            order = merged
            width *= 2
        common, sorted_ = _neighbours(rows, order)
        if sorted_:
            return order, common
        keys = [r.tobytes() for r in rows]
        order = np.array(sorted(range(m), key=keys.__getitem__))
    return order, _neighbours(rows, order)[0]


def _neighbours(rows: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, bool]:
    a, b = rows[order[:-1]], rows[order[1:]]
    differ = a != b
    some = differ.any(axis=1)
    first = differ.argmax(axis=1)
    line = np.arange(len(a))
    common = np.zeros(len(order), np.int64)
    common[1:] = np.where(some, first, rows.shape[1])
    return common, bool((~some | (a[line, first] < b[line, first])).all())


def _matrix(rows: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), width)


def lone_offsets(around: list[bytes], left: np.ndarray, copies: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """``repeated_offsets`` of surroundings that share their anchor with no others: all strings of a copy are repeated."""
    right = np.fromiter(map(len, around), np.int64, len(around)) - left
    first = np.maximum(0, length - right)
    found = (copies > 1) & (first <= left)
    return np.where(found, first, -1), np.where(found, left, -1)


def repeated_offsets(
    around: list[bytes], left: np.ndarray, copies: np.ndarray, length: int = LENGTH, gram: int = GRAM,
) -> tuple[np.ndarray, np.ndarray]:
    """(first, last): smallest and largest d such that the string from d bytes before the anchor is repeated; -1 without any.

    ``around`` are different surroundings of anchors, ``left`` the bytes before the anchor in each,
    ``copies`` how often each occurs.
    """
    m, reach = len(around), length - gram
    # Padding may equal real bytes; strings are only compared where both sides are long enough.
    right_side = _matrix([t[n:n + length].ljust(length, b"\0") for t, n in zip(around, left.tolist())], length)
    left_side = _matrix([t[:n][::-1].ljust(reach, b"\0") for t, n in zip(around, left.tolist())], reach)
    right = np.fromiter(map(len, around), np.int64, m) - left
    r_order, r_common = suffix_sort(right_side)
    l_order, l_common = suffix_sort(left_side)
    first, last = np.full(m, -1), np.full(m, -1)
    r_class, l_class = np.empty(m, np.int64), np.empty(m, np.int64)
    for d in range(reach + 1):
        r_class[r_order] = np.cumsum(r_common < length - d)
        l_class[l_order] = np.cumsum(l_common < d)
        fits = np.flatnonzero((left >= d) & (right >= length - d))
        if not len(fits):
            continue
        key = r_class[fits] * (m + 1) + l_class[fits]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        hit = copies[fits] > 1
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        found = fits[hit]
        first[found] = np.where(first[found] < 0, d, first[found])
        last[found] = d
    return first, last


_AROUND = "doc_id {kind}, row_key bigint, at bigint, before int, d1 bigint, d2 bigint"


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows are told apart by doc_id and a hash of both; equal rows have equal results."""
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))


def _anchor_hashes(rows: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length, gram)
        for batch in batches:
            found = [finder.find(t)[1] for t in batch.column(0).to_pylist()]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["h"])

    return rows.select("text").mapInArrow(run, "h bigint")


def _bitmap(hashes: DataFrame, n: int) -> np.ndarray:
    """Bits of the hashes' low ends: 8 bits or more per hash, at most 2^MAX_BITMAP_BITS bits."""
    bits = min(MAX_BITMAP_BITS, max(15, (8 * n).bit_length()))
    slot = F.col("h").bitwiseAND(F.lit((1 << bits) - 1)) + 1
    pages = hashes.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in pages.toLocalIterator():
        start = (r.page - 1) * (_PAGE // 8)
        piece = np.frombuffer(bytes(r.bits), np.uint8)
        out[start:start + len(piece)] |= piece[:len(out) - start]
    return out


def _marked(finder: Anchors, bitmap: np.ndarray, text: bytes) -> np.ndarray:
    at, h = finder.find(text)
    slot = h & np.uint64(8 * len(bitmap) - 1)
    return at[bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1 == 1]


def _surroundings(rows: DataFrame, shared, length: int, gram: int) -> DataFrame:
    """(around, before, n): surroundings of marked anchors, equal ones of a batch counted together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length, gram)
        for batch in batches:
            held: dict[tuple[bytes, int], int] = {}
            for text in batch.column(0).to_pylist():
                for at in _marked(finder, shared.value, text).tolist():
                    lo = max(0, at - (length - gram))
                    key = (text[lo:at + length], at - lo)
                    held[key] = held.get(key, 0) + 1
                if len(held) >= CHUNK_ROWS:
                    yield _counted(held)
                    held = {}
            if held:
                yield _counted(held)

    return rows.select("text").mapInArrow(run, "around binary, before int, n bigint")


def _counted(held: dict[tuple[bytes, int], int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in held], pa.binary()), pa.array([k[1] for k in held], pa.int32()), pa.array(list(held.values()), pa.int64())],
        names=["around", "before", "n"])


def _digest(around: bytes, before: int) -> tuple[int, int]:
    h = xxhash.xxh128_intdigest(around, before)
    return (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)


def _places(rows: DataFrame, kind: str, shared, length: int, gram: int) -> DataFrame:
    """(doc_id, row_key, at, before, d1, d2): every marked anchor with the digest of its surroundings."""
    target = rows.sparkSession.createDataFrame([], _AROUND.format(kind=kind)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(target)
        finder = Anchors(length, gram)
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for doc, key, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for at in _marked(finder, shared.value, text).tolist():
                    lo = max(0, at - (length - gram))
                    for column, value in zip(out, (doc, key, at, at - lo, *_digest(text[lo:at + length], at - lo))):
                        column.append(value)
                if len(out[0]) >= CHUNK_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)
                    out = [[] for _ in range(6)]
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return rows.mapInArrow(run, target)


_OFFSETS = "d1 bigint, d2 bigint, first int, last int, n bigint"


def _offset_batch(around: list[bytes], before: list[int], n: list[int], first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    digests = [_digest(a, b) for a, b in zip(around, before)]
    keep = np.flatnonzero(first >= 0)
    return pa.RecordBatch.from_arrays([
        pa.array([digests[i][0] for i in keep], pa.int64()), pa.array([digests[i][1] for i in keep], pa.int64()),
        pa.array(first[keep], pa.int32()), pa.array(last[keep], pa.int32()), pa.array([n[i] for i in keep], pa.int64()),
    ], names=["d1", "d2", "first", "last", "n"])


def _sorted_groups(unique: DataFrame, n_rows: int, length: int, gram: int) -> DataFrame:
    """Offsets of surroundings (around, before, n, anchor), whole anchors at a time."""

    def solve(around: list[bytes], before: list[int], n: list[int], anchors: list[int]) -> pa.RecordBatch:
        left, copies, own = np.array(before, np.int64), np.array(n, np.int64), np.array(anchors, np.int64)
        first, last = lone_offsets(around, left, copies, length)
        shared = np.zeros(len(own), bool)
        shared[1:] = own[1:] == own[:-1]
        shared[:-1] |= shared[1:]
        some = np.flatnonzero(shared)
        if len(some):
            first[some], last[some] = repeated_offsets([around[i] for i in some.tolist()], left[some], copies[some], length, gram)
        return _offset_batch(around, before, n, first, last)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, int, int, int]] = []
        current = None
        for batch in batches:
            for around, before, n, anchor in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if anchor != current and len(held) >= CHUNK_ROWS:
                    yield solve(*map(list, zip(*held)))
                    held = []
                current = anchor
                held.append((around, before, n, anchor))
        if held:
            yield solve(*map(list, zip(*held)))

    parts = max(1, -(-n_rows // CHUNK_ROWS))
    return unique.select("around", "before", "n", "anchor").repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(run, _OFFSETS)


def _counted_strings(unique: DataFrame, length: int, gram: int) -> DataFrame:
    """Offsets for crowded anchors: strings hashed, counted by hash, and looked up again."""

    def explode(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in ("d1", "d2", "n", "d", "s1", "s2")}
        for around, before, n in zip(cols["around"], cols["before"], cols["n"]):
            d1, d2 = _digest(around, before)
            for d in range(max(0, length - (len(around) - before)), min(before, length - gram) + 1):
                s1, s2 = _digest(around[before - d:before - d + length], d)
                for c, v in zip(out, (d1, d2, n, d, s1, s2)):
                    out[c].append(v)
        return out

    strings = map_batches(unique.select("around", "before", "n"), explode, "d1 bigint, d2 bigint, n bigint, d int, s1 bigint, s2 bigint")
    twice = cut(strings.groupBy("s1", "s2").agg(F.sum("n").alias("total"), F.count("*").alias("n_rows")).where("total > 1"))
    found = hot_lookup(strings, twice, ["s1", "s2"], "n_rows", "d1").where("total IS NOT NULL")
    return found.groupBy("d1", "d2").agg(F.min("d").alias("first"), F.max("d").alias("last"), F.max("n").alias("n"))


def find_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """(doc_id, row_key, spans): for documents with repeated strings, all their spans (start, end) in bytes, not yet merged.

    One row per different (doc_id, text).
    """
    rows = _keyed(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    spark = docs.sparkSession
    twice, n_twice = cut_counted(_anchor_hashes(rows, length, gram).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    shared = spark.sparkContext.broadcast(_bitmap(twice, n_twice))
    unique = _surroundings(rows, shared, length, gram).groupBy("around", "before").agg(F.sum("n").alias("n"))
    anchor = F.xxhash64(F.substring("around", F.col("before") + 1, F.lit(gram)))
    unique, n_unique = cut_counted(unique.withColumn("anchor", anchor))
    crowded = cut(unique.groupBy("anchor").agg(F.count("*").alias("_m")).where(F.col("_m") > crowd).select("anchor"))
    plain = unique.join(crowded, "anchor", "left_anti")
    offsets = _sorted_groups(plain, n_unique, length, gram)
    if not crowded.isEmpty():
        offsets = offsets.unionByName(_counted_strings(unique.join(crowded, "anchor", "left_semi"), length, gram))
    places = _places(rows, kind, shared, length, gram)
    found = hot_lookup(places, cut(offsets), ["d1", "d2"], "n", "row_key").where("first IS NOT NULL")
    span = F.struct((F.col("at") - F.col("last")).alias("start"), (F.col("at") + length - F.col("first")).alias("end"))
    return found.select("doc_id", "row_key", span.alias("s")).groupBy("doc_id", "row_key").agg(F.collect_set("s").alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs: spans that overlap or touch become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, with_kept: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept_sha256[, kept]) per row of ``docs``.

    ``spans`` are the maximal removed runs (start, end) in bytes of the text's UTF-8, ``kept`` the rest.
    Null and empty texts have no bytes; texts shorter than ``length`` keep all.  Every occurrence is
    removed, the first included.  Repeated rows count as occurrences of each other and get equal
    results; other columns are ignored; an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = find_spans(docs, length, gram, crowd).select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"), "spans")
    rows = _keyed(docs)
    joined = rows.join(found, rows["doc_id"].eqNullSafe(F.col("_id")) & (F.col("row_key") == F.col("_key")), "left").select("doc_id", "text", "spans")

    def run(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": cols["doc_id"]} | {c: [] for c in ("n_bytes", "n_removed", "spans", "kept_sha256", *["kept"] * with_kept)}
        for text, spans in zip(cols["text"], cols["spans"]):
            runs = merged([(s["start"], s["end"]) for s in spans or []])
            ends = [0, *(e for _, e in runs)]
            kept = b"".join(text[a:b] for a, b in zip(ends, [*(s for s, _ in runs), len(text)]))
            out["n_bytes"].append(len(text))
            out["n_removed"].append(len(text) - len(kept))
            out["spans"].append([{"start": a, "end": b} for a, b in runs])
            if with_kept:
                out["kept"].append(kept)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        return out

    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string"
    return map_batches(joined, run, schema + ", kept binary" * with_kept)
