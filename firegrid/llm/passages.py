"""Substring dedup by hashing units: lines, and inside long lines their sentences.

Every unit is normalised (lower case, single spaces) and hashed.  A unit is a repeat if a document of
smaller id, or an earlier place of the same document, has it.  Repeats are removed where they make
up whole lines of at least ``min_line_words`` words or runs of at least ``min_run_words`` words, so
that a phrase two authors happen to share stays.  Sentences without an end for more than
``long_unit`` words are cut at words chosen by their own hash.

Beside these units the words of the whole text, whatever its lines and sentences, are cut into pieces
at places chosen by the words around them.  A passage has the same inner pieces in every surrounding,
so one that lies in foreign sentences is found too; runs of repeated pieces of ``min_run_words`` go.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from firegrid.llm.common import map_batches, unused
from firegrid.operators.joins import hot_lookup
from firegrid.session import cut

MIN_LINE_WORDS = 5
MIN_RUN_WORDS = 16
LONG_UNIT = 32
CUT_ONE_IN = 8
# A piece begins where the hash of SPAN words is the smallest of those REACH words to either side.
SPAN = 2
REACH = 4
PIECE_LINE = -1

_UNIT = re.compile(r"\n|[^.!?\n]+[.!?]*|[.!?]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SIGN = 1 << 63


def units_of(text: str | None) -> list[tuple[int, int, int, int, int]]:
    """(line, start, end, words, digest) of every unit that has a word; code points, end exclusive."""
    out = []
    line = 0
    for m in _UNIT.finditer(text or ""):
        piece = m[0]
        if piece == "\n":
            line += 1
            continue
        words = piece.lower().split()
        if not words:
            continue
        if len(words) <= LONG_UNIT:
            out.append((line, m.start(), m.end(), len(words), xxhash.xxh64_intdigest(" ".join(words)) - _SIGN))
            continue
        first = None
        held: list[str] = []
        for w in _WORD.finditer(piece):
            first = w.start() if first is None else first
            held.append(w[0].lower())
            if xxhash.xxh32_intdigest(held[-1]) % CUT_ONE_IN == 0:
                out.append((line, m.start() + first, m.start() + w.end(), len(held), xxhash.xxh64_intdigest(" ".join(held)) - _SIGN))
                first, held = None, []
        if held:
            out.append((line, m.start() + first, m.end(), len(held), xxhash.xxh64_intdigest(" ".join(held)) - _SIGN))
    return out


def _pieces(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Starts, ends, words and unsigned digests of the pieces of ``pieces_of``."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    inside = np.zeros(len(points) + 2, np.int8)
    inside[1:-1] = (points != 32) & ((points < 9) | (points > 13))
    turns = np.flatnonzero(np.diff(inside))
    starts, ends = turns[::2], turns[1::2]
    n = len(starts)
    if n <= REACH:
        return starts[:0], ends[:0], starts[:0], []
    words = text.lower().split() if text.isascii() else []
    if len(words) != n:
        words = [text[a:b].lower() for a, b in zip(starts.tolist(), ends.tolist())]
    spans = [*map(" ".join, zip(*(words[k:] for k in range(SPAN)))), *(" ".join(words[i:]) for i in range(max(n - SPAN + 1, 0), n))]
    # The hashes, with the largest number on either side; the smallest of REACH neighbours by doubling.
    padded = np.full(n + 2 * REACH, np.iinfo(np.uint64).max, np.uint64)
    padded[REACH:-REACH] = h = np.fromiter(map(xxhash.xxh64_intdigest, spans), np.uint64, n)
    least, width = padded, 1
    while width < REACH:
        step = min(width, REACH - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    first = (h < least[:n]) & (h <= least[REACH + 1 :][:n])
    first[0] = True
    begin = np.flatnonzero(first)
    stop = np.append(begin[1:], n)
    at = begin.tolist()
    return starts[begin], ends[stop - 1], stop - begin, [xxhash.xxh64_intdigest(" ".join(words[a:b])) for a, b in zip(at, [*at[1:], n])]


def pieces_of(text: str | None) -> list[tuple[int, int, int, int]]:
    """(start, end, words, digest) of the pieces between places chosen by content, all lines and sentences as one."""
    start, end, words, digest = _pieces(text or "")
    return [(a, b, n, h - _SIGN) for a, b, n, h in zip(start.tolist(), end.tolist(), words.tolist(), digest)]


def _lists(n: np.ndarray, columns: dict[str, np.ndarray]) -> pa.ListArray:
    """Lists of structs of the lengths ``n``."""
    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(c) for c in columns.values()], list(columns)))


def removed_spans(
    doc: np.ndarray, at: np.ndarray, line: np.ndarray, start: np.ndarray, end: np.ndarray, words: np.ndarray, edge: np.ndarray,
    min_line_words: int = MIN_LINE_WORDS, min_run_words: int = MIN_RUN_WORDS,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, end) of the spans to remove, overlapping ones as one, from different repeated units; edge 1: begins its line, 2: ends it."""
    if not len(doc):
        return doc, start, end
    piece = line == PIECE_LINE
    order = np.lexsort((edge, words, end, start, line, at, piece, doc))
    doc, at, line, start, end, words, edge, piece = (x[order] for x in (doc, at, line, start, end, words, edge, piece))

    def groups(fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = np.flatnonzero(fresh)
        return first, np.append(first[1:], len(fresh)) - 1, np.add.reduceat(words, first)

    fresh = np.ones(len(doc), bool)
    fresh[1:] = (np.diff(doc) != 0) | (piece[1:] != piece[:-1]) | (np.diff(at) != 1)
    first, last, total = groups(fresh)
    run = total >= min_run_words
    # In a shorter run only whole lines: the first unit has flag 1, the last flag 2.
    short = ~run[np.cumsum(fresh) - 1]
    fresh[1:] |= np.diff(line) != 0
    begin, stop, total = groups(fresh)
    whole = short[begin] & (edge[begin] & 1 > 0) & (edge[stop] & 2 > 0) & (total >= min_line_words)
    first, last = np.concatenate([first[run], begin[whole]]), np.concatenate([last[run], stop[whole]])
    doc, start, end = doc[first], start[first], end[last]
    order = np.lexsort((end, start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    wide = int(end.max()) + 1
    reach = np.maximum.accumulate(doc * wide + end)
    fresh = np.ones(len(doc), bool)
    fresh[1:] = doc[1:] * wide + start[1:] >= reach[:-1]
    return doc[fresh], start[fresh], (reach - doc * wide)[np.append(np.flatnonzero(fresh)[1:], len(doc)) - 1]


_UNITS = "array<struct<at:int,line:int,start:int,end:int,words:int,edge:int,digest:bigint,again:boolean>>"
_SPANS = "array<struct<start:int,end:int>>"


def _scan(cols: dict[str, list]) -> dict[str, list]:
    """Per text: its length, how many units it has, and units and pieces one behind the other."""
    units = [units_of(text) for text in cols["text"]]
    pieces = [_pieces(text or "") for text in cols["text"]]
    n = np.array([[len(u) for u in units], [len(p[3]) for p in pieces]], np.int64)
    rows = [u for some in units for u in some]
    line, start, end, words, digest = (np.fromiter(c, np.int64, len(rows)) for c in (zip(*rows) if rows else [()] * 5))
    at = np.arange(len(rows)) - np.repeat(np.cumsum(n[0]) - n[0], n[0])
    last = (at == np.repeat(n[0], n[0]) - 1) | (np.diff(line, append=PIECE_LINE) != 0)
    edge = ((at == 0) | np.roll(last, 1)) + 2 * last
    # Behind the units of all texts the pieces of all texts; then text by text.
    total = int(n[1].sum())
    hashed = np.fromiter((h for p in pieces for h in p[3]), np.uint64, total)
    none = np.zeros(total, np.int64)
    own = np.tile(np.arange(n.shape[1]), 2).repeat(n.ravel())
    order = np.argsort(own, kind="stable")
    small = {
        "at": (at, np.arange(total) - np.repeat(np.cumsum(n[1]) - n[1], n[1])), "line": (line, none + PIECE_LINE),
        **{k: (x, *(p[i] for p in pieces)) for i, (k, x) in enumerate((("start", start), ("end", end), ("words", words)))}, "edge": (edge, none)}
    made = {k: np.concatenate(v).astype(np.int32)[order] for k, v in small.items()}
    made["digest"] = np.concatenate([digest, (hashed ^ np.uint64(_SIGN)).view(np.int64)])[order]
    # Again: not the first among the equal digests of the text's units, or of its pieces.
    part, own = made["line"] == PIECE_LINE, own[order]
    by = np.lexsort((made["digest"], part, own))
    made["again"] = np.zeros(len(by), bool)
    made["again"][by[1:]] = (np.diff(own[by]) == 0) & (part[by[1:]] == part[by[:-1]]) & (np.diff(made["digest"][by]) == 0)
    return {"doc_id": cols["doc_id"], "n_units": pa.array(n[0]), "n_chars_all": [len(t or "") for t in cols["text"]], "units": _lists(n.sum(0), made)}


def packed_units(scanned: DataFrame) -> DataFrame:
    """(doc_id, digest, size, tag, span) of every unit: two numbers in one column each, as all of them are exchanged."""
    wide = F.lit(1 << 32)
    u = lambda name: F.col(f"u.{name}").cast("long")
    return scanned.select("doc_id", F.explode("units").alias("u")).select(
        "doc_id", "u.digest", (u("at") * wide + u("words")).alias("size"), (u("line") * 8 + u("edge") * 2 + u("again")).alias("tag"),
        (u("start") * wide + u("end")).alias("span"))


def find_repeats(
    docs: DataFrame, min_line_words: int = MIN_LINE_WORDS, min_run_words: int = MIN_RUN_WORDS,
) -> DataFrame:
    """(doc_id, n_units, n_chars_all, spans): per row of ``docs`` the spans that repeat earlier text.

    The earliest occurrence, by doc_id and then place, is kept.  Rows with the same doc_id count as
    one document and get the same spans; rows without doc_id rank last and together.  Null, empty
    and blank texts have no units.  Other columns are ignored; an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    scanned = cut(map_batches(docs.select("doc_id", "text"), _scan, f"doc_id {kind}, n_units bigint, n_chars_all bigint, units {_UNITS}"))
    units = packed_units(scanned)
    # Digests that two documents share, with the smallest id: counted on both sides of the shuffle.
    shared = units.groupBy("digest").agg(
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.count("*").alias("n_rows"),
        F.count("doc_id").alias("n_named"),
    ).where("first_doc <> last_doc OR (first_doc IS NOT NULL AND n_named < n_rows)")
    shared = cut(shared.select("digest", "first_doc", "n_rows"))
    # Every unit is looked up under its own hash; the few that own many rows are broadcast.
    found = hot_lookup(units, shared, ["digest"], "n_rows", "doc_id")
    later = F.col("first_doc").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first_doc")))
    again = F.col("tag").bitwiseAND(F.lit(1)) == 1
    repeats = found.where(again | later).select("doc_id", F.struct("size", F.shiftright("tag", 1).alias("tag"), "span").alias("u"))
    per_doc = repeats.groupBy("doc_id").agg(F.collect_set("u").alias("u"))

    def merge(cols: dict[str, pa.Array]) -> dict[str, pa.Array]:
        n = pc.list_value_length(cols["u"]).to_numpy(zero_copy_only=False)
        size, tag, span = (x.to_numpy(zero_copy_only=False) for x in cols["u"].flatten().flatten())
        low = (1 << 32) - 1
        doc, start, end = removed_spans(
            np.repeat(np.arange(len(n)), n), size >> 32, tag >> 2, span >> 32, span & low, size & low, tag & 3, min_line_words, min_run_words)
        spans = _lists(np.bincount(doc, minlength=len(n)), {"start": start.astype(np.int32), "end": end.astype(np.int32)})
        return {"_id": cols["doc_id"], "spans": spans}

    spans = map_batches(per_doc, merge, f"_id {kind}, spans {_SPANS}", as_lists=False)
    base = scanned.select("doc_id", "n_units", "n_chars_all")
    return base.join(spans, base["doc_id"].eqNullSafe(spans["_id"]), "left").select(
        "doc_id", "n_units", "n_chars_all", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"))


def n_removed(spans) -> F.Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])


def without_repeats(docs: DataFrame, min_line_words: int = MIN_LINE_WORDS, min_run_words: int = MIN_RUN_WORDS) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; ``_removed`` has the spans in the original text, in place of a column of that name."""
    found = find_repeats(docs, min_line_words, min_run_words)
    docs = docs.drop("_removed")
    same = unused(docs, "_id")
    found = found.select(F.col("doc_id").alias(same), F.col("spans").alias("_removed")).distinct()
    joined = docs.join(found, docs["doc_id"].eqNullSafe(F.col(same)), "left").drop(same)
    parts = F.aggregate(
        "_removed", F.struct(F.lit("").alias("kept"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(F.concat(acc["kept"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])).alias("kept"), s["end"].alias("at")),
        lambda acc: F.concat(acc["kept"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))),
    )
    return joined.withColumn("text", F.when(F.col("text").isNotNull(), parts))
