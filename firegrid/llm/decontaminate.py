"""Benchmark decontamination: windows of benchmark words, looked up in the training documents.

The windows of the benchmark are a small set of hashes that is broadcast after its size has been
checked (``max_windows``); a larger benchmark is looked up in several passes over the documents, one
per block of windows, whose hits are combined per document.  A hash hit only counts after the
words themselves agree.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, functions as F

from firegrid.llm.common import keep_rows, map_batches, unused
from firegrid.session import cut

WINDOW = 13
MAX_WINDOWS = 500_000
# Letters A-Z are lower case by now; every other ASCII character but a-z and 0-9 parts words.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MULT = np.uint64(0x9E3779B97F4A7C15)
_BITMAP_BITS = 22


def words_of(text: bytes | None) -> list[bytes]:
    return _WORD.findall((text or b"").lower())


def item_windows(words: list[bytes], window: int = WINDOW) -> set[bytes]:
    """Windows as words joined by a space, which no word contains."""
    if len(words) < window:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i:i + window]) for i in range(len(words) - window + 1)}


class WindowIndex:
    """Windows of one block: by length a bitmap of hashes, then the windows themselves."""

    def __init__(self, windows: dict[bytes, frozenset[str]]):
        self.windows = windows
        self.bitmaps: dict[int, np.ndarray] = {}
        by_length = defaultdict(list)
        for w in windows:
            by_length[w.count(b" ") + 1].append(w.split(b" "))
        for n, group in by_length.items():
            bits = np.zeros(1 << _BITMAP_BITS, bool)
            for w in group:
                bits[self._slot(self._hashes(w), n)] = True
            self.bitmaps[n] = bits

    @staticmethod
    def _hashes(words) -> np.ndarray:
        # Python's own hash of bytes: kept inside one process, where both sides are made.
        return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)

    @staticmethod
    def _slot(h: np.ndarray, n: int) -> np.ndarray:
        size = len(h) - n + 1
        acc = np.zeros(size, np.uint64)
        for i in range(n):
            acc = acc * _MULT + h[i:i + size]
        return acc >> np.uint64(64 - _BITMAP_BITS)

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word ranges (start, end) inside window occurrences, and the items they come from."""
        if not words:
            return [], set()
        h = self._hashes(words)
        found: list[tuple[int, int]] = []
        items: set[str] = set()
        for n, bits in self.bitmaps.items():
            if len(words) >= n:
                for i in np.flatnonzero(bits[self._slot(h, n)]).tolist():
                    ids = self.windows.get(b" ".join(words[i:i + n]))
                    if ids is not None:
                        found.append((i, i + n))
                        items |= ids
        return merged(found), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, window: int, max_windows: int) -> list[dict[bytes, frozenset[str]]]:
    """The benchmark's windows in blocks of at most ``max_windows``, read block by block."""

    def explode(cols: dict[str, list]) -> dict[str, list]:
        out = {"window": [], "item_id": []}
        for item, text in zip(cols["item_id"], cols["text"]):
            for w in item_windows(words_of(text), window):
                out["window"].append(w)
                out["item_id"].append(item)
        return out

    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("binary").alias("text"))
    rows = cut(map_batches(named, explode, "window binary, item_id string").distinct())
    n = -(-max(rows.count(), 1) // max_windows)
    blocks = []
    for k in range(n):
        block = defaultdict(set)
        for r in rows.where(F.pmod(F.xxhash64("window"), F.lit(n)) == k).toLocalIterator():
            block[bytes(r.window)].add(r.item_id)
        blocks.append({w: frozenset(ids) for w, ids in block.items()})
    return blocks


def _scan(docs: DataFrame, block: dict, extra: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)
    state: dict[str, WindowIndex] = {}

    def run(cols: dict[str, list]) -> dict[str, list]:
        if "index" not in state:
            state["index"] = WindowIndex(shared.value)
        index = state["index"]
        out = {c: cols[c] for c in extra} | {"n_words": [], "ranges": [], "items": []}
        for text in cols["text"]:
            words = words_of(text)
            ranges, items = index.hits(words)
            out["n_words"].append(len(words))
            out["ranges"].append([{"start": a, "end": b} for a, b in ranges])
            out["items"].append(sorted(items))
        return out

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in extra)
    schema = f"{kinds}, n_words bigint, ranges array<struct<start:int,end:int>>, items array<string>"
    return map_batches(docs.select(*extra, F.col("text").cast("binary").alias("text")), run, schema)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS, with_hash: bool = False,
) -> DataFrame:
    """(doc_id, n_words, n_hit, ranges, items): per row of ``docs`` the words inside benchmark windows.

    ``ranges`` are merged word ranges, end exclusive, ``items`` the ids (as sorted strings) whose
    windows occur.  Null and wordless texts have no words and no hits.  Items without id are listed as
    the empty string.  Repeated rows stay repeated, other columns are ignored, an empty benchmark
    hits nothing.  With more than one block (a benchmark beyond ``max_windows``) rows are matched by
    doc_id and a hash of the text (``_h``, returned if ``with_hash``), so repeated rows still come out
    once each.
    """
    blocks = _blocks(benchmark, window, max_windows)
    hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"]).alias("n_hit")
    if len(blocks) == 1:
        found = _scan(docs.select("doc_id", "text", F.xxhash64("text").alias("_h")), blocks[0], ["doc_id", "_h"])
        return found.select("doc_id", *["_h"] * with_hash, "n_words", hit, "ranges", "items")
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"))
    parts = [cut(_scan(keyed, b, ["doc_id", "_h"])).withColumn("_block", F.lit(k)) for k, b in enumerate(blocks)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    # Sets of whole lists: repeated rows add nothing, so a group holds one list per block.
    out = every.groupBy("doc_id", "_h", "n_words").agg(
        F.flatten(F.collect_set("ranges")).alias("ranges"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.count(F.when(F.col("_block") == 0, 1)).alias("_rows"),
    ).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))))

    def merge(cols: dict[str, list]) -> dict[str, list]:
        ranges = [merged([(r["start"], r["end"]) for r in rs or []]) for rs in cols["ranges"]]
        return {k: cols[k] for k in ("doc_id", "_h", "n_words", "items")} | {"ranges": [[{"start": a, "end": b} for a, b in rs] for rs in ranges]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = map_batches(out.drop("_copy", "_rows"), merge, f"doc_id {kind}, _h bigint, n_words bigint, ranges array<struct<start:int,end:int>>, items array<string>")
    return out.select("doc_id", *["_h"] * with_hash, "n_words", hit, "ranges", "items")


def contaminated(n_hit, n_words):
    """A document is contaminated if at least a twentieth of its words are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """The rows of ``docs`` that are not contaminated; all columns stay.

    With one block of windows each row is judged where it lies, without a shuffle.  With more, rows
    are matched by doc_id (null matches null) and text.
    """
    blocks = _blocks(benchmark, window, max_windows)
    if len(blocks) == 1:
        shared = docs.sparkSession.sparkContext.broadcast(blocks[0])
        state: dict[str, WindowIndex] = {}

        def keep(texts: list) -> list[bool]:
            if "index" not in state:
                state["index"] = WindowIndex(shared.value)
            out = []
            for text in texts:
                words = words_of(None if text is None else text.encode())
                n_hit = sum(b - a for a, b in state["index"].hits(words)[0])
                out.append(not (n_hit > 0 and 20 * n_hit >= len(words)))
            return out

        return keep_rows(docs, "text", keep)
    found = find_contamination(docs, benchmark, window, max_windows, with_hash=True)
    bad_id, bad_h = unused(docs, "_bad"), unused(docs, "_bad_h")
    bad = found.where(contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("doc_id").alias(bad_id), F.col("_h").alias(bad_h)).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col(bad_id)) & (F.xxhash64(docs["text"]) == F.col(bad_h)), "left_anti")
