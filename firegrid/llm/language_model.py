"""Scores of texts under an n-gram model of the corpus, kept as Elias-Fano tries (``ngram_trie``).

Texts are taken in pieces of bounded size.  What pieces and shards tell each other are packed arrays, one
row per piece and shard, so nothing is exploded into a row per word:

1. a piece sends its different words, counted, to shards by the word's hash; a word shard adds them up and
   answers with their ids (frequent words first) and corpus counts;
2. the piece sums up the unigram scores, and sends its triples of words to shards by context;
3. a context shard counts the training triples, builds a trie for one part of its contexts after the other, and
   answers all triples of a piece with one sum per document, in whole codes, so that the order of adding does
   not matter;
4. the piece adds the sums of its documents up.

A context is a word, whatever the size of the corpus.  What follows a word of more than ``CROWD`` occurrences
would fill a shard, so its pairs and triples, each counted once per piece, are spread by their own hash: pairs by
both words, triples by the word and the one before it or, where that is as frequent, by all three.  Their
shards answer with corpus counts, the numbers of different successors are added up over the shards, and the
piece works the same probabilities out (``_crowded``, ``_counted``, ``_told_apart``).  So no word, phrase or start
of a text fills a shard, and the limit leaves no trace in the scores.

A caller can ask for another model, in which words above ``heavy`` occurrences have several classes of contexts:
the class is a hash of the words further back, as far as these are heavy as well, and of the document where the
history ends.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from firegrid.llm.common import _pieces
from firegrid.llm.ngram_trie import DISCOUNT, STEP, Trie, code_of
from firegrid.session import cut

# Bytes of text of a piece, bytes of all texts for one shard of words, and the least and most for one of contexts: these
# grow with the corpus before there are more than SHARDS of them, so that a piece sends few rows.  A shard is
# worked on in parts of PART bytes, so that a task holds one small trie at a time.
PIECE, WORD_SHARD, SHARD, MOST_SHARD, SHARDS, PART = 8 << 20, 16 << 20, 4 << 20, 16 << 20, 48, 2 << 20
# Occurrences of a word whose successors one shard holds; the limit grows so that at most MAX_CROWDED words exceed it.
CROWD, MAX_CROWDED = 1 << 20, 2000
# Words of history that decide the class of a heavy context, before the document itself does.
HISTORY = 8
CLASS_BITS = 20
UNKNOWN = -1
# Every text ends with this token; no word is empty.
END = b""


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: whole numbers in the fewest bytes, the bytes of a place together, compressed."""
    out = []
    for a in arrays:
        if a.dtype.kind in "iu" and len(a):
            a = a.astype(np.min_scalar_type(min(int(a.min()), -1 - int(a.max())) if a.min() < 0 else int(a.max())))
        wide = a.dtype.itemsize > 1
        out.append((a.dtype.str, (a.view(np.uint8).reshape(-1, a.dtype.itemsize).T if wide else a).tobytes()))
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(out))


def unpack(packed: bytes) -> list[np.ndarray]:
    out = []
    for kind, raw in pickle.loads(zstandard.ZstdDecompressor().decompress(packed)):
        size = np.dtype(kind).itemsize
        a = np.frombuffer(raw, np.uint8).reshape(size, -1).T
        a = np.ascontiguousarray(a).view(kind).ravel()
        out.append(a.astype(np.int64) if a.dtype.kind in "iu" else a)
    return out


def _sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of runs of ``values`` of the lengths ``n``, each at least 1."""
    return np.add.reduceat(values, np.cumsum(n) - n) if len(n) else np.zeros(0, values.dtype)


def _mix(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Next state of a hash of whole numbers."""
    z = (h ^ x.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return z ^ (z >> np.uint64(31))


def _frame(columns: dict[str, tuple[list, pa.DataType]]) -> pa.Table:
    return pa.table({k: pa.array(v, t) for k, (v, t) in columns.items()})


def _rows(piece: list[int], shard: list[int], payload: list[bytes]) -> pa.Table:
    return _frame({"piece": (piece, pa.int64()), "shard": (shard, pa.int64()), "payload": (payload, pa.binary())})


class Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


ROWS = "piece bigint, shard bigint, payload binary"


def _halves(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks as bytes of two-byte numbers, whose repeated phrases compress, and what the largest of these leave over."""
    return np.minimum(ranks, 0xFFFF).astype("<u2").view(np.uint8), ranks[ranks >= 0xFFFF] - 0xFFFF


def _ranks(halves: np.ndarray, over: np.ndarray) -> np.ndarray:
    """The ranks that ``_halves`` packed."""
    ranks = halves.astype(np.uint8).view("<u2").astype(np.int64)
    ranks[ranks == 0xFFFF] += over
    return ranks


def _tokenised(piece: int, ids: list, texts: list, learns: list, n_shards: int) -> pa.RecordBatch:
    """The piece's texts as numbers of its words (shard -1), and its words with their training counts by shard."""
    # The texts to learn from come first: their number tells which these are.
    order = sorted(range(len(texts)), key=lambda k: not learns[k])
    ids, texts, learns = ([x[k] for k in order] for x in (ids, texts, learns))
    words, n = [], []
    for t in texts:
        own = t.encode().lower().split() if t else []  # bytes: A-Z only, ASCII white space only
        words += own
        words.append(END)
        n.append(len(own) + 1)
    seen = Numbers()
    as_seen = np.fromiter(map(seen.__getitem__, words), np.int64, len(words))
    shards: dict[int, list[bytes]] = {}
    for w in seen:
        shards.setdefault(zlib.crc32(w) % n_shards, []).append(w)
    shards = {k: sorted(shards[k]) for k in sorted(shards)}
    distinct = [w for some in shards.values() for w in some]
    place = np.empty(len(distinct), np.int64)
    place[np.fromiter(map(seen.__getitem__, distinct), np.int64, len(distinct))] = np.arange(len(distinct))
    tokens = place[as_seen]
    n = np.array(n, np.int64)
    learns = np.array([bool(x) for x in learns], bool)
    counts = np.bincount(tokens[np.repeat(learns, n)], minlength=len(distinct))
    # Frequent words get small numbers, which ``_sent`` finds out from the counts.
    often = np.bincount(tokens, minlength=len(distinct))
    rank = np.empty(len(often), np.int64)
    rank[np.argsort(-often, kind="stable")] = np.arange(len(often))
    own = pack(
        np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids], np.uint8), learns.astype(np.uint8), n, often, *_halves(rank[tokens]))
    out = [(piece, -1, own)]
    stop = 0
    for shard, some in shards.items():
        start, stop = stop, stop + len(some)
        packed = zstandard.ZstdCompressor(level=6).compress(b"\n".join(some))
        out.append((piece, shard, pickle.dumps((packed, pack(counts[start:stop])))))
    return _rows(*map(list, zip(*out))).combine_chunks().to_batches()[0]


def _numbered(table: pa.Table, n_shards: int) -> pa.Table:
    """Ids and corpus counts of the words of one shard, for every piece that sent some, plus the shard's totals on its first row."""
    words, counts, n = [], [], []
    for raw in table["payload"].to_pylist():
        packed, some = pickle.loads(raw)
        own = zstandard.ZstdDecompressor().decompress(packed).split(b"\n")
        words += own
        n.append(len(own))
        counts.append(unpack(some)[0])
    coded = pa.array(words, pa.binary()).dictionary_encode()
    at = coded.indices.to_numpy().astype(np.int64)
    total = np.bincount(at, np.concatenate(counts), len(coded.dictionary)).astype(np.int64)
    names = coded.dictionary.to_pylist()
    order = sorted(range(len(names)), key=lambda k: (-total[k], names[k]))
    ids = np.empty(len(names), np.int64)
    shard = table["shard"][0].as_py()
    ids[order] = np.arange(len(names)) * n_shards + shard
    ids[total == 0] = UNKNOWN
    stop = np.cumsum(n)
    payload = [pack(ids[at[e - k : e]], total[at[e - k : e]]) for e, k in zip(stop, n)]
    rest = [0] * (len(n) - 1)
    totals = {"n": ([int(total.sum()), *rest], pa.int64()), "v": ([int((total > 0).sum()), *rest], pa.int64()),
              "top": ([int(ids.max()), *rest], pa.int64()), "most": ([int(total.max()), *rest], pa.int64())}
    return _frame({"piece": (table["piece"].to_pylist(), pa.int64()), "shard": ([shard] * len(n), pa.int64()), "payload": (payload, pa.binary()), **totals})


def contexts(ids: np.ndarray, c: np.ndarray, n: np.ndarray, doc: np.ndarray, end: int, c_end: int, heavy: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(key, u) of every token: its context, from the words before it, and the word before those.

    ``ids`` and ``c`` are the tokens' ids and corpus counts, ``n`` the tokens of each document, ``doc`` a
    number per document that tells documents apart, ``end`` and ``c_end`` the id and count of the end token,
    which also stands before every document.  A key is word << CLASS_BITS | class; unknown words have a negative one.
    Without ``heavy`` every class is 0.
    """
    start = np.repeat(np.cumsum(n) - n, n)
    at = np.arange(len(ids))
    doc = np.repeat(doc, n).astype(np.uint64)

    def back(k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inside = at - k >= start
        place = np.maximum(at - k, 0)
        return np.where(inside, ids[place], end), np.where(inside, c[place], c_end), inside

    v, c_v, inside = back(1)
    u, _, _ = back(2)
    if heavy is None:
        return np.where(v >= 0, v << CLASS_BITS, UNKNOWN), u
    # Only tokens behind a heavy word go on; each round looks one word further back.
    h = np.zeros(len(ids), np.uint64)
    go = np.flatnonzero(c_v > heavy)
    now_inside = inside
    for k in range(2, HISTORY + 2):
        last = k == HISTORY + 1
        ended = go[~now_inside[go]] if not last else go
        h[ended] = _mix(h[ended], doc[ended])
        go = go[now_inside[go]] if not last else go[:0]
        if not len(go):
            break
        word, count, now_inside = back(k)
        h[go] = _mix(h[go], word[go])
        go = go[count[go] > heavy]
    classes = np.minimum((c_v + heavy - 1) // heavy, 1 << CLASS_BITS)
    cls = np.where(c_v > heavy, (h % np.maximum(classes, 1).astype(np.uint64)).astype(np.int64), 0)
    return np.where(v >= 0, v << CLASS_BITS | cls, UNKNOWN), u


def unigram(c: np.ndarray, n: int, v: int) -> np.ndarray:
    return (c + 0.5) / (n + 0.5 * (v + 1))


def _groups(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the group of each row, a row of each group): rows that agree in all columns, in sorted order."""
    order = np.lexsort(columns[::-1])
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for c in columns:
        fresh[1:] |= np.diff(c[order]) != 0
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(fresh) - 1
    return number, order[fresh]


def _count(at: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(at, n, size).astype(np.int64)


def _crowded(at: np.ndarray, tokens: np.ndarray, start: np.ndarray, doc: np.ndarray, learns: np.ndarray,
             word_ids: np.ndarray, word_c: np.ndarray, n_shards: int, crowd: int) -> tuple[bytes, list[tuple[int, bytes]]]:
    """(what the piece keeps, payload by shard) for its tokens ``at`` behind crowded words.

    Sent are the different pairs (v, w) and triples (v, u, w) with their training counts; kept is where in the
    answers a triple of a document finds its numbers.
    """
    end, size = tokens[-1], len(word_ids)
    v, u = (np.where(at - k >= start[at], tokens[np.maximum(at - k, 0)], end) for k in (1, 2))
    pairs, pair = np.unique(v * size + tokens[at], return_inverse=True)
    triples, triple = np.unique(pair * size + u, return_inverse=True)
    v, w = pairs // size, pairs % size
    of, u = triples // size, triples % size
    learnt = learns[doc[at]].astype(np.int64)
    n_pair, n_triple = _count(pair, learnt, len(pairs)), _count(triple, learnt, len(triples))
    both = word_c[u] > crowd
    h_v = _mix(np.zeros(len(v), np.uint64), word_ids[v])
    h_u = _mix(h_v[of], word_ids[u])
    shard_p = (_mix(h_v, word_ids[w]) % np.uint64(n_shards)).astype(np.int64)
    shard_t = (np.where(both, _mix(h_u, word_ids[w[of]]), h_u) % np.uint64(n_shards)).astype(np.int64)
    by_p, by_t = np.argsort(shard_p, kind="stable"), np.argsort(shard_t, kind="stable")
    # How often a crowded predecessor and the context follow each other is the count of another pair of the piece;
    # in front of a document stands the end, as often as there are documents.
    inner = both & (v[of] != end)
    back = np.where(inner, np.searchsorted(pairs, np.where(inner, u * size + v[of], 0)), -1)
    place_p, place_t = np.empty(len(pairs), np.int64), np.empty(len(triples), np.int64)
    place_p[by_p], place_t[by_t] = np.arange(len(pairs)), np.arange(len(triples))
    back = np.where(inner, place_p[np.maximum(back, 0)], -1)
    each, first = _groups(doc[at], place_t[triple])
    kept = pack(
        doc[at][first], place_t[triple][first], np.bincount(each), word_ids[v][by_p], word_c[v][by_p], word_c[w][by_p],
        place_p[of][by_t], np.where(both, word_ids[u], 0)[by_t], both[by_t].astype(np.uint8), back[by_t], np.array([word_c[end]]))
    sent = []
    for s in np.unique(np.concatenate([shard_p, shard_t])).tolist():
        p, t = by_p[shard_p[by_p] == s], by_t[shard_t[by_t] == s]
        sent.append((s, pack(word_ids[v[p]], word_ids[w[p]], n_pair[p], word_ids[v[of[t]]], word_ids[u[t]], word_ids[w[of[t]]], n_triple[t],
                             both[t].astype(np.uint8))))
    return kept, sent


def _counted(table: pa.Table) -> pa.Table:
    """The corpus counts that the pieces asked one shard for, and in a row of piece -1 how many successors words and pairs have here."""
    shard, pieces = table["shard"][0].as_py(), table["piece"].to_pylist()
    asked = [unpack(raw) for raw in table["payload"].to_pylist()]
    pv, pw, pn, v, u, w, n, both = (np.concatenate([a[k] for a in asked]) for k in range(8))
    g, first = _groups(pv, pw)
    n_pair = _count(g, pn, len(first))
    words, many_words = np.unique(pv[first][n_pair > 0], return_counts=True)
    t, at = _groups(v, u, w)
    n_triple = _count(t, n, len(at))
    c, top = _groups(v[at], u[at])
    n_pred, many = _count(c, n_triple, len(top)), _count(c, n_triple > 0, len(top))
    # Behind two crowded words this is but a part: it is added up over the shards.
    spread = both[at][top] > 0
    part = spread & (many > 0)
    stats = pack(
        np.concatenate([np.full(len(words), -1), u[at][top][part]]), np.concatenate([words, v[at][top][part]]), np.concatenate([many_words, many[part]]))
    n_pred, many = np.where(spread, 0, n_pred), np.where(spread, 0, many)
    of = c[t]
    out, stop_p, stop_t = [stats], 0, 0
    for a in asked:
        start_p, stop_p, start_t, stop_t = stop_p, stop_p + len(a[0]), stop_t, stop_t + len(a[3])
        p, s = slice(start_p, stop_p), slice(start_t, stop_t)
        out.append(pack(n_pair[g[p]], n_triple[t[s]], n_pred[of[s]], many[of[s]]))
    return _rows([-1, *pieces], [shard] * len(out), out)


def successors(counted: DataFrame, universe: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, numbers): how many words follow crowded words (key: the word) and pairs of them (key: (u + 1) * universe + v), at most
    MAX_CROWDED words and as many squared pairs.
    """
    def listed(batches):
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                u, v, many = unpack(raw)
                yield pa.record_batch({"key": (u + 1) * universe + v, "many": many})

    rows = counted.where("piece < 0").select("payload").mapInArrow(listed, "key bigint, many bigint")
    found = rows.groupBy("key").agg(F.sum("many").alias("many")).orderBy("key").toArrow()
    return found["key"].to_numpy(), found["many"].to_numpy()


def _told_apart(kept: bytes, answers: list[bytes], total: int, vocabulary: int, universe: int, known: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """(document, sum of codes) of the triples behind crowded words: the probabilities of ``Trie.pack`` from corpus counts."""
    keys, numbers = known
    n_pair, n_triple, n_pred, many = (np.concatenate(a) for a in zip(*map(unpack, answers)))
    doc, triple, times, v, c_v, c_w, of, u, both, back, c_end = unpack(kept)

    def after(key: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, numbers[at], 0)

    p1 = unigram(c_w, total, vocabulary)
    backoff = DISCOUNT * after(v) / c_v
    p2 = np.where(n_pair > 0, (n_pair - DISCOUNT) / c_v, 0.0) + backoff * p1
    code = np.where(n_pair > 0, code_of(p2), code_of(p1) + code_of(backoff))[of]
    two = both > 0
    many = np.where(two, after((u + 1) * universe + v[of]), many)
    n_pred = np.where(two, np.where(back >= 0, n_pair[np.maximum(back, 0)], c_end[0]), n_pred)
    seen = many > 0
    backoff = np.where(seen, DISCOUNT * many / np.maximum(n_pred, 1), 1.0)
    deep = n_triple > 0
    p3 = np.where(deep, (n_triple - DISCOUNT) / np.maximum(n_pred, 1) + backoff * p2[of], 1.0)
    code = np.where(deep, code_of(p3), code + code_of(backoff))
    return [doc, times * code[triple]]


def _packed_triples(key: np.ndarray, u: np.ndarray, w: np.ndarray, c: np.ndarray, doc: np.ndarray, times: np.ndarray, n_learns: int) -> bytes:
    """Triples in order of their keys and predecessors: what rises is sent as steps, and a word's count once."""
    keys, first, n_key = np.unique(key, return_index=True, return_counts=True)
    step = np.diff(u, prepend=0)
    step[first] = u[first] + 1  # an unknown word has -1
    some, at, of = np.unique(w, return_index=True, return_inverse=True)
    return pack(np.diff(keys, prepend=0), n_key, step, of, doc, times, np.array([n_learns]), np.diff(some, prepend=0), c[at])


def _triples(packed: bytes) -> tuple[np.ndarray, ...]:
    """(key, u, w, count of w, document, times, whether it is learnt) as they were packed."""
    keys, n_key, step, of, doc, times, n_learns, some, known = unpack(packed)
    first = np.cumsum(n_key) - n_key
    u = np.cumsum(step)
    u -= np.repeat(u[first] - step[first], n_key) + 1
    return np.repeat(np.cumsum(keys), n_key), u, np.cumsum(some)[of], known[of], doc, times, doc < n_learns[0]


def _sent(table: pa.Table, total: int, vocabulary: int, n_shards: int, heavy: int | None, crowd: int, n_crowded: int) -> pa.Table:
    """Unigram sums of a piece (in a shard of its own, below 0) and its triples by shard of their context."""
    piece = table["piece"][0].as_py()
    rows = sorted(zip(table["shard"].to_pylist(), table["payload"].to_pylist()), key=lambda r: r[0])
    doc_id, is_null, learns, n, often, *halves = unpack(rows[0][1])
    tokens = np.argsort(-often, kind="stable")[_ranks(*halves)]
    answers = [unpack(r) for _, r in rows[1:]]
    word_ids, word_c = (np.concatenate([a[k] for a in answers]) for k in (0, 1))
    ids, c = word_ids[tokens], word_c[tokens]
    p1 = unigram(word_c, total, vocabulary)
    base = _sums(np.log10(p1)[tokens], n)
    q1 = code_of(p1)[tokens]
    end, c_end = (int(x[tokens[-1]]) for x in (word_ids, word_c))  # every document ends with it
    doc_hash = _mix(np.full(len(doc_id), 1, np.uint64), doc_id)
    key, u = contexts(ids, c, n, doc_hash, end, c_end, heavy)
    doc = np.repeat(np.arange(len(n)), n)
    # Behind an unknown word there is nothing to look up.
    lost = key < 0
    here = np.bincount(doc[lost], q1[lost], len(n)).astype(np.int64)
    own = pack(doc_id, is_null, learns, n, _sums((c > 0).astype(np.int64), n), here)
    start = np.repeat(np.cumsum(n) - n, n)
    at = np.arange(len(ids))
    crowded = ~lost & (np.where(at > start, c[np.maximum(at - 1, 0)], c_end) > crowd) if heavy is None else np.zeros(len(ids), bool)
    kept, sent = None, []
    if crowded.any():
        kept, sent = _crowded(np.flatnonzero(crowded), tokens, start, doc, learns, word_ids, word_c, n_crowded, crowd)
    out = [(piece, -1 - piece, pickle.dumps((own, base.tobytes(), kept))), *[(piece, n_shards + s, raw) for s, raw in sent]]
    keep = np.flatnonzero(~lost & ~crowded)
    # Keys by shard; triples by key, then by the ids of their words, then by document.
    keys, of_key = np.unique(key[keep], return_inverse=True)
    shard_of = (_mix(np.zeros(len(keys), np.uint64), keys) % np.uint64(n_shards)).astype(np.int64)
    by_shard = np.lexsort((keys, shard_of))
    rank = np.empty(len(keys), np.int64)
    rank[by_shard] = np.arange(len(keys))
    universe = int(word_ids.max()) + 2
    left, right = rank[of_key] * universe + u[keep] + 1, (ids[keep] + 1) * len(n) + doc[keep]
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    fresh = np.ones(len(keep), bool)
    fresh[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    first = np.flatnonzero(fresh)
    times = np.diff(first, append=len(keep))
    at = keep[order[first]]
    key, u, w, doc, c, shard = key[at], u[at], ids[at], doc[at], c[at], shard_of[by_shard][left[first] // universe]
    starts = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
    n_learns = int(learns.sum())
    for s, e in zip(starts, [*starts[1:], len(shard)]):
        out.append((piece, int(shard[s]), _packed_triples(key[s:e], u[s:e], w[s:e], c[s:e], doc[s:e], times[s:e], n_learns)))
    return _rows(*map(list, zip(*out)))


def _scored(table: pa.Table, total: int, vocabulary: int, top: int, n_shards: int, n_parts: int) -> pa.Table:
    """Per piece, the sum of the codes of its triples for each document; a piece's own sums go through."""
    shard = table["shard"][0].as_py()
    if shard < 0:
        return table
    if shard >= n_shards:
        return _counted(table)
    pieces = table["piece"].to_pylist()
    # All triples of the shard in small numbers, with the place of their document's sum.
    word, count = (np.int32 if most < 1 << 31 else np.int64 for most in (top, total))
    kinds = (np.int64, word, word, count, np.int32, np.int32, bool)
    columns: list[list[np.ndarray]] = [[] for _ in kinds]
    docs: list[np.ndarray] = []
    n_sums = 0
    for raw in table["payload"].to_pylist():
        *own, doc, times, learnt = _triples(raw)
        some, at = np.unique(doc, return_inverse=True)
        for column, x, kind in zip(columns, (*own, n_sums + at, times, learnt), kinds):
            column.append(x.astype(kind))
        docs.append(some)
        n_sums += len(some)
    sums = np.zeros(n_sums, np.int64)
    whole = []
    while columns:
        whole.append(np.concatenate(columns.pop(0)))
    of = _mix(np.ones(len(whole[0]), np.uint64), whole[0]) % np.uint64(n_parts)
    for k in range(n_parts):
        here = np.flatnonzero(of == k)
        key, u, w, c, at, times = (x[here].astype(np.int64) for x in whole[:-1])
        seen = whole[-1][here]
        p1 = unigram(c, total, vocabulary)
        trie = Trie.mapped(Trie.pack(key[seen], u[seen], w[seen], times[seen], p1[seen], top + 1))
        np.add.at(sums, at, trie.codes(key, u, w, code_of(p1)) * times)
    stops = np.cumsum([len(some) for some in docs])
    return _rows(pieces, [shard] * len(pieces), [pack(np.diff(some, prepend=0), sums[e - len(some) : e]) for some, e in zip(docs, stops)])


RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _summed(table: pa.Table, total: int, vocabulary: int, top: int, n_shards: int, known: tuple[np.ndarray, np.ndarray] | None) -> pa.Table:
    rows = sorted(zip(table["shard"].to_pylist(), table["payload"].to_pylist()), key=lambda r: r[0])
    packed, base, kept = pickle.loads(rows[0][1])
    doc_id, is_null, learns, n, n_known, codes = unpack(packed)
    codes = codes.copy()
    for _, raw in [r for r in rows[1:] if r[0] < n_shards]:
        docs, sums = unpack(raw)
        codes[np.cumsum(docs)] += sums
    if kept is not None:
        np.add.at(codes, *_told_apart(kept, [raw for s, raw in rows if s >= n_shards], total, vocabulary, top + 1, known))
    return pa.table({
        "doc_id": pa.array(doc_id, mask=is_null.astype(bool)), "held_out": pa.array(learns == 0), "n_tokens": pa.array(n),
        "n_known": pa.array(n_known), "train_tokens": pa.array(np.full(len(n), total, np.int64)),
        "base_score": pa.array(np.frombuffer(base, np.float64)), "score": pa.array(-codes / STEP)})


def score(docs: DataFrame, held_out: Column, piece: int = PIECE, word_shard: int = WORD_SHARD, shard: int | None = None, heavy: int | None = None,
          crowd: int = CROWD, part: int = PART) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    The model learns from the rows where ``held_out`` is not true, and scores all of them.  Tokens are the
    words of the lower-cased (A-Z) text and one end.  ``n_known`` tokens occur in training, which has
    ``train_tokens``; ``base_score`` is the smoothed unigram log10 probability, ``score`` that of the model of
    order three (see ``ngram_trie``), the sum of codes of 1 / 4096 decade.  Words not learnt share one place of
    the vocabulary.

    Null and empty texts are one token, the end.  Repeated rows and rows with null or equal ids are scored,
    and learnt, one by one; other columns are ignored; without anything to learn every token has
    probability one; an empty table gives no rows.  The sizes in bytes and ``crowd`` bound memory; only ``heavy`` is a
    parameter of the model, which does without it.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    shard = shard or min(max(SHARD, size // SHARDS), MOST_SHARD)
    n_word_shards, n_shards = 1 + size // word_shard, 1 + size // shard
    n_parts = 1 + min(size, shard) // part
    named = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.coalesce(~held_out, F.lit(True)))

    def tokenise(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in _pieces(batch, piece):
                yield _tokenised(number, *(part.column(k).to_pylist() for k in range(3)), n_word_shards)
                number += 1

    told = cut(named.mapInArrow(tokenise, ROWS))
    numbered = cut(told.where("shard >= 0").groupBy("shard").applyInArrow(
        lambda t: _numbered(t, n_word_shards), ROWS + ", n bigint, v bigint, top bigint, most bigint"))
    sums = numbered.agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.max("top").alias("top"), F.max("most").alias("most")).first()
    total, vocabulary, top = sums.n or 0, sums.v or 0, max(sums.top or 0, 0)
    limit, n_crowded = max(crowd, total // MAX_CROWDED), 1 + size // (4 * min(shard, SHARD))
    whole = told.where("shard < 0").unionByName(numbered.select("piece", "shard", "payload"))
    sent = whole.groupBy("piece").applyInArrow(lambda t: _sent(t, total, vocabulary, n_shards, heavy, limit, n_crowded), ROWS)
    scored = sent.groupBy("shard").applyInArrow(lambda t: _scored(t, total, vocabulary, top, n_shards, n_parts), ROWS)
    known = None
    if heavy is None and (sums.most or 0) > limit:
        scored = cut(scored)
        known = successors(scored, top + 1)
        scored = scored.where("piece >= 0")
    return scored.groupBy("piece").applyInArrow(lambda t: _summed(t, total, vocabulary, top, n_shards, known), RESULT)


def every_fifth(doc_id: Column) -> Column:
    """Held-out rows of the registered query: crc32 of the id in decimal leaves 1 when divided by 5."""
    return F.crc32(doc_id.cast("string")) % 5 == 1
