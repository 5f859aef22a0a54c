"""Alignment of two tokenizers: which tokens end at the same byte of a text.

A is a byte-level BPE (``tokenizers``), B a BPE over pieces (``sentencepiece``).  Their spans, character
offsets of A and spans of B's proto, are coarse cuts: they are byte positions as long as a stretch of text
is ASCII; where a character has several bytes, tokens share it or fall back to bytes, and the decoded
bytes of the tokens give the exact ends.  Ends that both tokenizers have cut the text into groups.

Texts are encoded in stretches that start with a space after a character that is none: no token of
either vocabulary crosses such a place (A splits there before merging, no piece of B has a space behind
another character, which is looked up), so equal stretches are encoded once per batch.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from firegrid.llm.common import PIECE_BYTES, _pieces
from firegrid.session import cut

A_FILE, B_FILE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
STRETCH = re.compile(r" [^ ]*+(?:(?<=\s) [^ ]*+)*+")
BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>\Z")
# Different stretches whose tokens a worker keeps; beyond it starts anew.  Bounds memory, not results.
KEPT = 500_000


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


@dataclass
class Tokens:
    """Tokens of many stretches, one after the other: ids and lengths in bytes, and where each stretch starts."""

    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    lens: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))

    def append(self, ids: list[int], ends: list[int], n: list[int]) -> None:
        """Stretches of ``n`` tokens each: all their ids, and where each token ends in its stretch."""
        stop = np.cumsum(np.array(n, np.int64))
        lens = np.diff(np.array(ends, np.int32), prepend=0)
        first = (stop - n)[np.array(n) > 0]
        lens[first] = np.array(ends, np.int32)[first]
        self.ids, self.lens = np.concatenate([self.ids, np.array(ids, np.int32)]), np.concatenate([self.lens, lens])
        self.starts = np.concatenate([self.starts, self.starts[-1] + stop])

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, lens, number of tokens per stretch) of the stretches ``which``, in that order."""
        n = self.starts[which + 1] - self.starts[which]
        at = np.arange(int(n.sum())) + np.repeat(self.starts[which] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        return self.ids[at], self.lens[at], n


class Numbers(dict):
    """Stretches numbered as they come."""

    def __missing__(self, stretch: str) -> int:
        self[stretch] = n = len(self)
        return n


class Pair:
    """Both tokenizers, the bytes of their tokens, and the stretches seen so far."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        alphabet = byte_alphabet()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes.fromhex(m[1]) if self.b.is_byte(i) and (m := BYTE_PIECE.match(p)) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_len, self.b_len = [len(t) for t in self.a_bytes], [len(t) for t in self.b_bytes]
        self.space = self.b.piece_to_id("▁")
        form = json.loads(a_file)
        split = form["normalizer"] is None and (form["pre_tokenizer"] or {}).get("type") == "ByteLevel" and form["pre_tokenizer"].get("use_regex", True)
        self.in_stretches = bool(split) and not any(re.search("[^▁]▁", p) for p in pieces)
        a_names = np.array([str(i) for i in range(len(self.a_bytes))], object)
        b_names = np.array([str(i) for i in range(len(self.b_bytes))], object)
        self.a_names, self.b_names = (a_names + ",", a_names + "|"), (b_names + ",", b_names + ";")
        self.forget()

    def forget(self) -> None:
        self.index = Numbers()
        self.a_tokens, self.b_tokens = Tokens(), Tokens()
        self.exact = np.zeros(0, bool)

    def stretches(self, text: str) -> list[str]:
        return STRETCH.findall(" " + text) if self.in_stretches else [" " + text]

    def learn(self, new: list[str]) -> None:
        a_ids, a_ends, a_n, b_ids, b_ends, b_n = [], [], [], [], [], []
        # The spans of the proto, as plain tuples; B adds the space itself, so they start behind it.
        mapped = self.b.encode([s[1:] for s in new], return_type="offset_mapping", num_threads=1)
        for s, e, m in zip(new, self.a.encode_batch(new, add_special_tokens=False), mapped):
            ids, other = e.ids, m["ids"] if len(s) > 1 else [self.space]
            a_ids += ids
            a_n.append(len(ids))
            b_ids += other
            b_n.append(len(other))
            if s.isascii():  # one byte per character: spans are byte positions
                a_ends += [end for _, end in e.offsets]
                b_ends += [end + 1 for _, end in m["offsets"]] if len(s) > 1 else [1]
            else:
                a_ends += accumulate([self.a_len[i] for i in ids])
                b_ends += accumulate([self.b_len[i] for i in other])
        self.a_tokens.append(a_ids, a_ends, a_n)
        self.b_tokens.append(b_ids, b_ends, b_n)
        exact, raw = np.ones(len(new), bool), [s.encode() for s in new]
        for ids, n, table in ((a_ids, a_n, self.a_bytes), (b_ids, b_n, self.b_bytes)):
            back = [table[i] for i in ids]
            sizes = _ends(np.array([len(t) for t in back]), np.array(n))
            if b"".join(back) != b"".join(raw) or sizes.tolist() != [len(r) for r in raw]:
                stop = np.cumsum(n).tolist()
                exact &= np.array([b"".join(back[e - k : e]) == r for r, e, k in zip(raw, stop, n)], bool)
        self.exact = np.concatenate([self.exact, exact])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(stretch numbers of all texts, how many each text has); none for texts that either tokenizer does not give back."""
        if len(self.index) > KEPT:
            self.forget()
        known, out = len(self.index), []
        for t in texts:
            out.append(np.fromiter(map(self.index.__getitem__, self.stretches(t) if t else ()), np.int64))
        if len(self.index) > known:
            self.learn(list(islice(self.index, known, None)))
        for k, (text, which) in enumerate(zip(texts, out)):
            # The bytes of a whole text are those of its stretches: only where one differs is the whole compared.
            if not self.exact[which].all() and not self.gives_back(text, which):
                out[k] = which[:0]
        return np.concatenate([np.zeros(0, np.int64), *out]), np.array([len(which) for which in out], np.int64)

    def gives_back(self, text: str, which: np.ndarray) -> bool:
        raw = (" " + text).encode()
        sides = ((self.a_tokens, self.a_bytes), (self.b_tokens, self.b_bytes))
        return all(b"".join(table[i] for i in tokens.take(which)[0]) == raw for tokens, table in sides)


_PAIRS: dict[str, Pair] = {}


def _pair(files: tuple[bytes, bytes]) -> Pair:
    key = hashlib.md5(files[0] + files[1]).hexdigest()
    if key not in _PAIRS:
        _PAIRS[key] = Pair(*files)
    return _PAIRS[key]


def _ends(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of runs of ``starts`` of the lengths ``n``."""
    total = np.concatenate([[0], np.cumsum(starts)])
    last = np.cumsum(n)
    return total[last] - total[last - n]


def _lists(values: np.ndarray, n: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]), pa.array(values))


def _aligned(pair: Pair, texts: list[str | None], with_tokens: bool) -> dict[str, pa.Array | list | np.ndarray]:
    """The columns of ``align`` for some texts, but for the corpus counts."""
    which, n_stretches = pair.encode(texts)
    sides = []
    for tokens in (pair.a_tokens, pair.b_tokens):
        ids, lens, n = tokens.take(which)
        # Token ends as bytes from the start of the batch: texts lie one after the other.
        sides.append((ids, np.cumsum(lens, dtype=np.int64), _ends(n, n_stretches)))
    (a, a_end, n_a), (b, b_end, n_b) = sides
    n_bytes = int(a_end[-1]) if len(a_end) else 0
    cut_a, cut_b = np.zeros(n_bytes + 1, bool), np.zeros(n_bytes + 1, bool)
    cut_a[a_end], cut_b[b_end] = True, True
    ends_a, ends_b = cut_b[a_end], cut_a[b_end]
    a_last, b_last = np.flatnonzero(ends_a), np.flatnonzero(ends_b)
    text_end = np.concatenate([[0], a_end])[np.cumsum(n_a)]
    n_groups = _ends(ends_a, n_a)

    # Group texts: the tokens of A in a group, then those of B, in one sequence of names.
    names = np.empty(len(a) + len(b), object)
    a_group, b_group = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    b_before = np.concatenate([[0], b_last + 1])[:-1]
    names[np.arange(len(a)) + (b_before[a_group] if len(a) else 0)] = np.where(ends_a, pair.a_names[1][a], pair.a_names[0][a])
    names[np.arange(len(b)) + (a_last[b_group] + 1 if len(b) else 0)] = np.where(ends_b, pair.b_names[1][b], pair.b_names[0][b])
    stops = np.cumsum(n_a + n_b).tolist()
    joined = ["".join(names[s:e].tolist())[:-1] for s, e in zip([0, *stops], stops)]

    # Links: one pair of ids per common end; equal ones of a text as one, with their number.
    code = a[a_last].astype(np.int64) * len(pair.b_bytes) + b[b_last]
    n_codes = len(pair.a_bytes) * len(pair.b_bytes)
    code = np.sort(np.repeat(np.arange(len(texts)), n_groups) * n_codes + code)
    first = np.diff(code, prepend=-1) != 0
    code, of_text = code % n_codes, code // n_codes
    at = np.flatnonzero(first)
    times = np.diff(np.concatenate([at, [len(code)]]))
    n_pairs = np.bincount(of_text[at], minlength=len(texts))
    out = {
        "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_groups,
        "groups_sha256": [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in joined],
        "pairs": _lists(code[at], n_pairs), "times": _lists(times, n_pairs),
    }
    if with_tokens:
        start = np.concatenate([[0], text_end[:-1]]) if len(texts) else text_end
        out |= {
            "a_ids": _lists(a, n_a), "a_ends": _lists(a_end - np.repeat(start, n_a), n_a),
            "b_ids": _lists(b, n_b), "b_ends": _lists(b_end - np.repeat(start, n_b), n_b)}
    return out


def possible_pairs(files: tuple[bytes, bytes]) -> int:
    """How many id pairs can be linked at all: two tokens that end together, one's bytes being the other's last bytes."""
    pair = _pair(files)
    total = 0
    for mine, other in ((pair.a_bytes, pair.b_bytes), (pair.b_bytes, pair.a_bytes)):
        n: dict[bytes, int] = {}
        for t in other:
            n[t] = n.get(t, 0) + 1
        # Proper suffixes both ways; equal tokens once.
        total += sum(n.get(t[k:], 0) for t in mine for k in range(1 if mine is pair.b_bytes else 0, len(t)))
    return total


def align(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, with_tokens: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs``.

    A encodes a space and the text, B the text, to which it adds the space.  A link is a token of each
    that end at the same byte; a link's count is how many links of the whole corpus have its two ids.
    ``n_best`` are the links with the highest count of their B id, ties included; ``count_sum`` adds the
    counts up.  ``groups_sha256`` hashes the ids between common ends, ``a1,a2|b1;a3|b2``.  With
    ``with_tokens`` the ids and the ends in bytes (of the space and the text) follow as arrays.

    Texts null, empty or not given back byte by byte by both tokenizers have no tokens: zeros and ''.
    Every row is its own, repeated rows and null ids too; other columns are ignored; an empty table gives none.

    The counts are one number per pair of ids that occurs.  Linked tokens end together, so one is the end of the
    other: the vocabularies alone bound their number (``possible_pairs``: 324 302 for the given files),
    whatever the corpus; that table goes to the workers.
    """
    spark = docs.sparkSession
    # Read on the driver: executors need not have the files.
    files = (Path(a_file).read_bytes(), Path(b_file).read_bytes())
    shared = spark.sparkContext.broadcast(files)
    pair = _pair(files)
    n_b = len(pair.b_bytes)
    code_type = "int" if len(pair.a_bytes) * n_b < 1 << 31 else "bigint"
    more = ["a_ids", "a_ends", "b_ids", "b_ends"] if with_tokens else []
    counts = ["n_a", "n_b", "n_groups", "n_links"]
    schema = ", ".join(["doc_id bigint", *[f"{c} bigint" for c in counts], "groups_sha256 string", f"pairs array<{code_type}>", "times array<int>",
                        *[f"{c} array<int>" for c in more]])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = pa.list_(pa.int32() if code_type == "int" else pa.int64())
        both, ints = _pair(shared.value), pa.list_(pa.int32())
        types = {c: pa.int64() for c in ("doc_id", *counts)} | {"groups_sha256": pa.string(), "pairs": code, "times": ints} | {c: ints for c in more}
        for batch in batches:
            for piece in _pieces(batch, PIECE_BYTES):
                out = {"doc_id": piece.column(0)} | _aligned(both, piece.column(1).to_pylist(), with_tokens)
                columns = [c.cast(types[k]) if isinstance(c := out[k], pa.Array) else pa.array(c, types[k]) for k in types]
                yield pa.RecordBatch.from_arrays(columns, names=list(types))

    found = cut(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(first, schema))
    pairs = found.select(F.inline(F.arrays_zip("pairs", "times"))).groupBy("pairs").agg(F.sum("times").alias("n")).toArrow()
    codes, n = pairs["pairs"].to_numpy().astype(np.int64), pairs["n"].to_numpy().astype(np.int64)
    order = np.argsort(codes)
    codes, n = codes[order], n[order]
    best = np.zeros(n_b, np.int64)
    np.maximum.at(best, codes % n_b, n)
    table = spark.sparkContext.broadcast((codes, n, n == best[codes % n_b]))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, is_best = table.value
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("pairs"))
            times = batch.column(batch.schema.get_field_index("times")).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(codes, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            n_pairs = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            out = {name: batch.column(batch.schema.get_field_index(name)) for name in ("doc_id", *counts)}
            out["n_best"] = pa.array(_ends(times * is_best[at], n_pairs), pa.int64())
            out["count_sum"] = pa.array(_ends(times * n[at], n_pairs), pa.int64())
            out |= {name: batch.column(batch.schema.get_field_index(name)) for name in ("groups_sha256", *more)}
            yield pa.RecordBatch.from_pydict(out)

    result = ", ".join(["doc_id bigint", *[f"{c} bigint" for c in (*counts, "n_best", "count_sum")], "groups_sha256 string", *[f"{c} array<int>" for c in more]])
    return found.mapInArrow(second, result)
