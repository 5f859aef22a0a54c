"""Personal data: fixed patterns, and terms that give a protected entity away.

Protected entities are the values that the patterns find (an address, a card number ...).  A term
discloses an entity if it hardly ever occurs away from it: with document frequencies over the whole
corpus, the point-wise mutual information of term and entity comes within ``slack`` bits of the
entity's own information content (at 0 bits the entity is certain once the term is seen).  The pair
must be seen in ``support`` documents whose surroundings differ, so copies of one text are no
evidence.  Disclosing terms are spans of kind ``term`` wherever they occur.

Three passes over the texts: one gathers the terms around entities, one counts the documents of
those candidates, one finds the patterns and the disclosing terms.  The later passes know their terms
as a bitmap of fixed size, which may let foreign terms through but misses none; an exact join follows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from firegrid.llm.common import map_batches
from firegrid.operators.joins import hot_lookup
from firegrid.session import cut

KINDS = ("email", "ip", "card", "phone")
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}
CONTEXT_WORDS = 6
SUPPORT = 3
SLACK_BITS = 1.0
BITMAP_BITS = 23
CACHE = 200_000
_PAGE = 32_768  # bits in one row of Spark's bitmap aggregate

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Possessive runs: a run that fails can only fail again when given back in part.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: from each @, left over the local part and right over the domain, in linear time."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    return out


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind, then start."""
    if not text:
        return []
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def entity_name(kind: str, value: str) -> str:
    return f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else _NOT_DIGIT.sub('', value)}"


def term_of(word: str) -> str | None:
    """The word in lower case without punctuation around it; only words of three letters or more count."""
    t = word.lower()
    if not t.isalpha():
        t = _EDGE.sub("", t)
    return t if len(t) >= 3 and t.isalpha() else None


def _around(text: str, spans: list[tuple[str, int, int]], n: int) -> list[tuple[str, str, int]]:
    """(entity, term, hash of the surroundings) for the ``n`` words before and after each span, its line only."""
    out = []
    for kind, a, b in spans:
        left, right = text.rfind("\n", 0, a) + 1, text.find("\n", b)
        # A bounded piece of text is enough for a bounded number of words of usual length.
        before = text[max(left, a - 40 * n):a].split()[-n:]
        after = text[b:min(right if right >= 0 else len(text), b + 40 * n)].split()[:n]
        terms = [t for t in map(term_of, before + after) if t]
        seen = xxhash.xxh64_intdigest(" ".join(terms)) - (1 << 63)
        name = entity_name(kind, text[a:b])
        out += [(name, t, seen) for t in dict.fromkeys(terms)]
    return out


def candidates(docs: DataFrame, context_words: int = CONTEXT_WORDS, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """Stored tables (entity, term, n_both) with enough support, and (entity, n_entity): document counts."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"entity": [], "term": [], "seen": [], "first": []}
        for text in cols["text"]:
            spans = base_spans(text)
            rows = [(e, None, 0) for e in dict.fromkeys(entity_name(k, text[a:b]) for k, a, b in spans)]
            known: set[tuple[str, str]] = set()
            for e, t, s in rows + list(dict.fromkeys(_around(text, spans, context_words))):
                out["entity"].append(e)
                out["term"].append(t)
                out["seen"].append(s)
                # The document counts once for a pair, however often the pair occurs in it.
                out["first"].append(int((e, t) not in known))
                known.add((e, t))
        return out

    rows = cut(map_batches(docs.select("text"), run, "entity string, term string, seen bigint, first int"))
    entities = cut(rows.where("term IS NULL").groupBy("entity").agg(F.count("*").alias("n_entity")))
    per_seen = rows.where("term IS NOT NULL").groupBy("entity", "term", "seen").agg(F.sum("first").alias("n"))
    pairs = per_seen.groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("n_seen")).where(F.col("n_seen") >= support)
    return cut(pairs.select("entity", "term", "n_both")), entities


def _bitmap(terms: DataFrame, bits: int) -> np.ndarray:
    """One bit per hash of a term: at most 2^bits / 8 bytes come to the driver."""
    slot = F.xxhash64("term").bitwiseAND(F.lit((1 << bits) - 1)) + 1
    pages = terms.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in pages.toLocalIterator():
        piece = np.frombuffer(bytes(r.bits), np.uint8)
        start = (r.page - 1) * (_PAGE // 8)
        out[start:start + len(piece)] |= piece[:len(out) - start]
    return out


class _Terms:
    """Which words may be a term of a bitmap; what a word gives is kept in a bounded cache."""

    def __init__(self, bitmap: np.ndarray):
        self.bitmap, self.mask = bitmap, 8 * len(bitmap) - 1
        self.known: dict[str, str | None] = {}

    def term(self, word: str) -> str | None:
        if word not in self.known:
            if len(self.known) >= CACHE:
                self.known.clear()
            t = term_of(word)
            slot = xxhash.xxh64_intdigest(t, 42) & self.mask if t else 0
            self.known[word] = t if t and self.bitmap[slot >> 3] >> (slot & 7) & 1 else None
        return self.known[word]

    def among(self, text: str) -> set[str]:
        return {t for t in map(self.term, set(_WORD.findall(text))) if t}

    def places(self, text: str) -> list[tuple[str, int, int]]:
        if not self.among(text):
            return []
        out = []
        for m in _WORD.finditer(text):
            t = self.term(m[0])
            if t:
                a = m.start() + m[0].lower().find(t)
                out.append((t, a, a + len(t)))
        return out


def document_counts(docs: DataFrame, terms: DataFrame, bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """(term, n_term): documents that have the term; added up inside each batch before the shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(terms, bitmap_bits))
    state: dict[str, _Terms] = {}

    def run(cols: dict[str, list]) -> dict[str, list]:
        if "terms" not in state:
            state["terms"] = _Terms(shared.value)
        n: Counter[str] = Counter()
        for text in cols["text"]:
            n.update(state["terms"].among(text or ""))
        return {"term": list(n), "n": list(n.values())}

    counted = map_batches(docs.select("text"), run, "term string, n bigint", piece_bytes=None).groupBy("term").agg(F.sum("n").alias("n_term"))
    return counted.join(terms, "term", "left_semi")


def disclosing_terms(
    docs: DataFrame, context_words: int = CONTEXT_WORDS, support: int = SUPPORT, slack: float = SLACK_BITS, bitmap_bits: int = BITMAP_BITS,
) -> DataFrame:
    """Stored table (term): terms whose information about some entity comes within ``slack`` bits of the entity's own."""
    pairs, entities = candidates(docs, context_words, support)
    terms = cut(pairs.select("term").distinct())
    if terms.isEmpty():
        return terms
    n_docs = F.lit(float(docs.count()))
    information = F.log2(n_docs / F.col("n_entity"))
    mutual = F.log2(n_docs * F.col("n_both") / (F.col("n_term") * F.col("n_entity")))
    known = pairs.join(entities, "entity").join(document_counts(docs, terms, bitmap_bits), "term")
    return cut(known.where((information > slack) & (mutual >= information - slack)).select("term").distinct())


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_spans(
    docs: DataFrame, context_words: int = CONTEXT_WORDS, support: int = SUPPORT, slack: float = SLACK_BITS,
    bitmap_bits: int = BITMAP_BITS, keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, base, terms[, keep...]): arrays of (kind, start, end) per row of ``docs``, code points, end exclusive.

    ``base`` has the patterns by kind and start, ``terms`` the disclosing terms by start; a term that
    overlaps a base span is left out.  Null and empty texts have no spans.  Repeated rows stay
    repeated.  Columns not in ``keep`` are ignored.  An empty table gives an empty result.
    """
    terms = disclosing_terms(docs, context_words, support, slack, bitmap_bits)
    shared = docs.sparkSession.sparkContext.broadcast(None if terms.isEmpty() else _bitmap(terms, bitmap_bits))
    state: dict[str, _Terms] = {}

    def run(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: v for k, v in cols.items() if k != "text"} | {"base": [], "found": []}
        if shared.value is not None and "terms" not in state:
            state["terms"] = _Terms(shared.value)
        for text in cols["text"]:
            base = base_spans(text)
            found = state["terms"].places(text) if text and state else []
            out["base"].append([{"kind": k, "start": a, "end": b} for k, a, b in base])
            found = [(t, a, b) for t, a, b in found if not any(a < y and x < b for _, x, y in base)] if base else found
            out["found"].append([{"term": t, "start": a, "end": b} for t, a, b in found])
        return out

    carried = ["doc_id", *keep]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)
    schema = f"{kinds}, base {_SPANS}, found array<struct<term:string,start:int,end:int>>"
    scanned = map_batches(docs.select(*carried, "text"), run, schema)
    if shared.value is None:
        return scanned.select(*carried, "base", F.array().cast(_SPANS).alias("terms"))
    # A stored row number: repeated rows are told apart and a lost task gives the same numbers.
    scanned = cut(scanned.withColumn("_row", F.monotonically_increasing_id()))
    seen = scanned.select("_row", F.explode("found").alias("f")).select("_row", "f.*")
    chosen = cut(seen.groupBy("term").agg(F.count("*").alias("n_rows")).join(terms, "term", "left_semi").withColumn("hit", F.lit(True)))
    places = hot_lookup(seen, chosen, ["term"], "n_rows", "_row").where("hit")
    # One row per document: its own occurrences, no more than its words.
    by_row = places.groupBy(F.col("_row").alias("_r")).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("p"))
    named = by_row.select("_r", F.transform("p", lambda x: F.struct(F.lit("term").alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("terms"))
    return scanned.join(named, scanned["_row"] == named["_r"], "left").select(
        *carried, "base", F.coalesce("terms", F.array().cast(_SPANS)).alias("terms"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """``text`` with every span replaced by its kind; overlapping spans become one, named by the first."""
    if not text or not spans:
        return text
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], LABELS[kind]]
        at = max(at, b)
    out.append(text[at:])
    return "".join(out)


def sanitise(docs: DataFrame, n_chars: str | None = "n_chars", **options) -> DataFrame:
    """``docs`` with personal data and disclosing terms generalised to their kind, all columns as they are.

    ``n_chars``, where ``docs`` has that column, becomes the length of the new text.  Null texts stay null.
    """
    names = docs.columns
    packed = docs.select("doc_id", "text", F.struct(*[F.col(c) for c in names]).alias("_row_data"))
    found = find_spans(packed, keep=("_row_data",), **options)
    flat = found.select("base", "terms", *[F.col("_row_data")[c].alias(f"_c{i}") for i, c in enumerate(names)])
    text_at = f"_c{names.index('text')}"

    def run(cols: dict[str, list]) -> dict[str, list]:
        cols[text_at] = [
            redact(t, [(s["kind"], s["start"], s["end"]) for s in [*b, *m]]) for t, b, m in zip(cols[text_at], cols.pop("base"), cols.pop("terms"))
        ]
        return cols

    schema = ", ".join(f"_c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    out = map_batches(flat, run, schema).toDF(*names)
    if n_chars in names:
        out = out.withColumn(n_chars, F.when(F.col("text").isNotNull(), F.length("text")).cast(docs.schema[n_chars].dataType))
    return out
