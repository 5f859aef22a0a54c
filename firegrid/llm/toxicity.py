"""Toxicity by a noisy channel: undo disguises of letters, then score the restored words.

A disguised word is read as a lattice.  Each written character stands for itself, for a letter it
resembles, for one more repetition of the letter before it, or for nothing; a run of single characters
may also have word boundaries in its gaps.  A Viterbi search finds the reading that is likeliest under a letter
model (trigrams inside words) times the cost of the disguise.  The letter model is counted on all
words of the corpus.

The score is a noisy or over words and word beginnings of the restored text.  They are learnt from a
sample of labelled rows, at most ``MAX_TRAIN`` of them: the words whose link to the label can't be
chance (``MIN_G2``), each judged by the rows that those before it leave unexplained.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from firegrid.llm.common import SPACE_RUN, keep_rows, map_batches
from firegrid.session import cut

MAX_TRAIN = 40_000
FOLDS = 5
PREFIXES = (4, 5, 6)
MIN_G2 = 25.0
# For words that others explain already: by the number of different surroundings, and nearly always with label 1.
MIN_G2_REPEATED = 40.0
MIN_SHARE = 0.96
# Features whose rows are read at a time, and features that every task may know; further ones are joined.
MAX_FEATURES = 5_000
MAX_SHARED = 200_000
MAX_LETTERS = 48
# Characters of tokens and of what they give that a task keeps at a time; a token counts OVERHEAD more.
CACHE_CHARS, OVERHEAD = 8 << 20, 100
# Bytes of text whose features are added up before they are sent on.
COUNT_BYTES = 8 << 20

# What a written character may stand for besides itself, with the log cost of that disguise.
LOOKS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
MASKS = {"*": "aeiou", "#": "aeiou"}
KEEP, LOOK, MASK, REPEAT, DROP, LOSE, BREAK = 0.0, -1.0, -2.0, -1.5, -3.0, -15.0, -4.0
# Readings that are less likely than the best by no more than this are kept too.
MARGIN = 6.0

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_RUN = re.compile(r"([^\W\d_])\1\1")
_DOUBLE = re.compile(r"(.)\1+", re.S)
_LONG_RUN = re.compile(r"(.)\1{3,}", re.S)
_LETTERS = re.compile(r"[^\W\d_]+")


class LetterModel:
    """Log probability of a letter after two others inside a word; letter 0 is the word's edge, the last one any other letter."""

    def __init__(self, trigrams: Iterable[tuple[str, int]]):
        rows = [(g, n) for g, n in trigrams if n]
        by_letter: dict[str, int] = {}
        for g, n in rows:
            if g[2] != "_":
                by_letter[g[2]] = by_letter.get(g[2], 0) + n
        common = sorted(by_letter, key=lambda c: (-by_letter[c], c))[:MAX_LETTERS]
        self.index = {"_": 0} | {c: i + 1 for i, c in enumerate(common)}
        self.other = len(common) + 1
        size = self.other + 1
        counts = np.zeros((size, size, size))
        for g, n in rows:
            counts[self.code(g[0]), self.code(g[1]), self.code(g[2])] += n
        two = counts.sum(0)
        one = two.sum(0) + 1.0
        p1 = one / one.sum()
        p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
        p3 = (counts + 5 * p2[None]) / (counts.sum(2, keepdims=True) + 5)
        self.table = np.log(p3).tolist()

    def code(self, letter: str) -> int:
        return self.index.get(letter, self.other)


def readings(ch: str) -> list[tuple[str, float]]:
    """Letters that a written character may stand for; '' is nothing."""
    out = []
    if ch.isalpha():
        out.append((ch, KEEP))
    else:
        out.append(("", LOSE if ch in LOOKS or ch in MASKS else DROP if ch.isalnum() else KEEP))
    out += [(c, LOOK) for c in LOOKS.get(ch, "")]
    out += [(c, MASK) for c in MASKS.get(ch, "")]
    return out


def restore(token: str, model: LetterModel) -> list[str]:
    """Words of the likeliest readings of a lower-case token; a space in it is a gap between single letters.

    The search keeps the best reading for each pair of last letters; of those, all within ``MARGIN`` of the best count.
    """
    token = _LONG_RUN.sub(r"\1\1\1", token)
    # State: the last two letters; value: (log probability, letters so far).
    states: dict[tuple[str, str], tuple[float, str]] = {("_", "_"): (0.0, "")}

    def put(out: dict, state: tuple[str, str], value: float, text: str) -> None:
        if state not in out or value > out[state][0]:
            out[state] = (value, text)

    def step(state: tuple[str, str], letter: str) -> float:
        return model.table[model.code(state[0])][model.code(state[1])][model.code(letter)]

    previous = ""
    for ch in token:
        out: dict[tuple[str, str], tuple[float, str]] = {}
        for state, (value, text) in states.items():
            if ch == " ":
                put(out, state, value, text)
                if state[1] != "_":
                    put(out, ("_", "_"), value + BREAK + step(state, "_"), text + " ")
                continue
            for letter, cost in readings(ch):
                if letter:
                    put(out, (state[1], letter), value + cost + step(state, letter), text + letter)
                else:
                    put(out, state, value + cost, text)
            if ch == previous and state[1] != "_":
                put(out, state, value + REPEAT, text)
        states = out
        previous = ch if ch != " " else previous
    ends = [(v + (step(s, "_") if s[1] != "_" else 0.0), t) for s, (v, t) in states.items()]
    best = max((v for v, _ in ends), default=0.0)
    return list(dict.fromkeys(w for v, t in sorted(ends, reverse=True) if v >= best - MARGIN for w in t.split()))


def disguised(core: str) -> bool:
    """A token with letters and look-alikes or signs between them, or with a letter three times in a row."""
    if core.isalpha():
        return _RUN.search(core) is not None
    return any(c.isalpha() for c in core)


def single(token: str) -> str:
    """The letter, digit or look-alike that a token consists of, without punctuation around it; '' for other tokens."""
    if len(token) == 1:
        return token if token.isalnum() or token in LOOKS or token in MASKS else ""
    core = _EDGE.sub("", token)
    if not core:
        core = "".join(c for c in token if c in LOOKS or c in MASKS)
    return core if len(core) == 1 else ""


def spaced_runs(tokens: list[str], one: Callable[[str], str] = single) -> list[str]:
    """Runs of single characters, whatever the gaps between them, with three letters or look-alikes and a true letter.

    ``one`` tells the character of a token, as ``single`` does.
    """
    out: list[str] = []
    run: list[str] = []
    for token in [*tokens, ""]:
        c = "" if len(token) > 1 and token.isalpha() else one(token)
        if c:
            run.append(c)
        elif run:
            if len(run) >= 3 and any(map(str.isalpha, run)) and sum(x.isalpha() or x in LOOKS or x in MASKS for x in run) >= 3:
                out.append(" ".join(run))
            run = []
    return out


class Restorer:
    """Restored words of texts; what a token gives is kept, up to ``CACHE_CHARS``, and goes with the task."""

    def __init__(self, model: LetterModel, keep: Callable[[Iterable[str]], Iterable[str]] = tuple):
        self.model, self.keep = model, keep
        self.known: dict[str, tuple[str, ...]] = {}
        self.ones: dict[str, str] = {}
        self.room = CACHE_CHARS

    def take(self, *kept: str) -> None:
        """Room for a token and what it gives; without any left, all that is kept goes."""
        size = OVERHEAD + sum(map(len, kept))
        if size > self.room:
            self.known.clear()
            self.ones.clear()
            self.room = CACHE_CHARS
        self.room -= size

    def one(self, token: str) -> str:
        """``single`` of a token."""
        got = self.ones.get(token)
        if got is None:
            got = single(token)
            self.take(token)
            self.ones[token] = got
        return got

    def readings(self, word: str) -> list[str]:
        """Words of a lower-case token: its letters as written, and the restored reading of a disguised one."""
        if word.isalpha():
            if not _DOUBLE.search(word):
                return [word]
            got = [word, _DOUBLE.sub(r"\1", word)]
            return got + restore(word, self.model) if _RUN.search(word) else got
        core = _EDGE.sub("", word)
        got = [core] if core.isalpha() else _LETTERS.findall(core)
        if disguised(core):
            got += restore(core, self.model)
        # A sign at the edge may be a letter too ("$tupid"); runs of signs are decoration.
        edge = word.strip(".,;:?\"'()[]{}")
        if core and edge != core and len(edge) - len(core) <= 2 and (edge[0] in LOOKS or edge[-1] in LOOKS):
            got += restore(edge, self.model)
        return got

    def of(self, word: str) -> tuple[str, ...]:
        """``keep`` of the readings of one lower-case token."""
        got = self.known.get(word)
        if got is None:
            got = tuple(self.keep(self.readings(word)))
            self.take(word, *got)
            self.known[word] = got
        return got

    def words(self, text: str | None) -> set[str]:
        """``keep`` of the readings of all tokens and of all runs of single characters."""
        tokens = (text or "").lower().split()
        out: set[str] = set()
        for word in set(tokens):
            out.update(self.of(word))
        for run in spaced_runs(tokens, self.one):
            out.update(self.keep(restore(run, self.model)))
        return out


def features(words: Iterable[str]) -> set[str]:
    """Words and word beginnings (marked by ``-``)."""
    out = set()
    for w in words:
        if len(w) >= 3:
            out.add(w)
            out.update(w[:n] + "-" for n in PREFIXES if len(w) > n)
    return out


def letter_trigrams(docs: DataFrame) -> list[tuple[str, int]]:
    """(trigram, count) over all words of ``docs``, ``_`` at the edges: words are counted first, then their letters.

    Letters beyond the ``MAX_LETTERS`` commonest are folded into one, so the list has a fixed bound.
    """
    text = F.lower(F.coalesce(F.col("text"), F.lit("")))
    plain = F.regexp_replace(text, "[^\\p{L} \\x09-\\x0D]+", "")
    words = docs.select(F.explode(F.split(plain, SPACE_RUN)).alias("word")).where("word <> ''")
    counted = cut(words.groupBy("word").agg(F.count("*").alias("n")))
    letters = counted.select("n", F.explode(F.split("word", "")).alias("c")).where("c <> ''").groupBy("c").agg(F.sum("n").alias("n"))
    top = {r.c for r in letters.orderBy(F.desc("n"), "c").limit(MAX_LETTERS).collect()}
    rare = F.regexp_replace("word", "[^" + "".join(sorted(top)) + "]", "?") if top else F.col("word")
    padded = counted.select("n", F.concat(F.lit("__"), rare, F.lit("_")).alias("p"))
    grams = F.transform(F.sequence(F.lit(1), F.length("p") - 2), lambda i: F.substring("p", i, F.lit(3)))
    table = padded.select("n", F.explode(grams).alias("g")).groupBy("g").agg(F.sum("n").alias("n"))
    return [(r.g, r.n) for r in table.collect()]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


class Model:
    """Letter model, the probability without any feature, and each feature's own: all of fixed size."""

    def __init__(self, letters: LetterModel, prior: float, weights: dict[str, float]):
        self.letters, self.prior, self.weights = letters, prior, weights
        self.heads = {f[:3] for f in weights}
        self.restorer = Restorer(letters, self.weighted)

    def __getstate__(self):
        return self.letters, self.prior, self.weights

    def __setstate__(self, state):
        self.__init__(*state)

    def weighted(self, words: list[str]) -> list[str]:
        return [f for f in features(w for w in words if w[:3] in self.heads) if f in self.weights]

    def score(self, text: str | None) -> float:
        """Probability of label 1: every feature may cause it on its own, and so may what no feature explains."""
        clean = 1.0 - self.prior
        for f in sorted(self.restorer.words(text)):
            clean *= 1.0 - self.weights[f]
        return 1.0 - clean


def g2(n1: float, n0: float, base: float) -> float:
    """Likelihood ratio of the label's share among the rows with a feature against its share in all rows."""
    n = n1 + n0
    return 2 * sum(seen * math.log(seen / (n * share)) for seen, share in ((n1, base), (n0, 1 - base)) if seen)


Batch = tuple[dict[str, tuple[int, int]], dict[str, set[int]]]


def cover(batches: Iterable[Batch], base: float) -> tuple[list[str], set[int]]:
    """Features that explain label 1, the strongest first, and the rows they explain.

    Each next feature is judged by the rows that none before it explains.  So words that copies of
    one text merely share with its toxic word are not learnt.  A batch has the counts of features and
    their rows with label 1; batches come by falling ``g2``, and the next one is read as soon as it may have
    the strongest feature.
    """
    rest = iter(batches)
    heap: list[tuple[float, str]] = []
    counts: dict[str, tuple[int, int]] = {}
    marked: dict[str, set[int]] = {}
    # No unread feature is stronger than this.
    floor: float | None = math.inf
    chosen: list[str] = []
    done: set[int] = set()

    def gain(f: str) -> float:
        left, n0 = len(marked[f] - done), counts[f][1]
        return g2(left, n0, base) if left > base * (left + n0) else 0.0

    while True:
        if floor is not None and (not heap or -heap[0][0] <= floor):
            # What lies below the limit never comes back: a gain can only fall.
            for f in [f for f in marked if gain(f) < MIN_G2]:
                del marked[f], counts[f]
            heap = [x for x in heap if x[1] in marked]
            got = next(rest, None)
            if got is None:
                floor = None
            else:
                counts.update(got[0])
                marked.update(got[1])
                heap += [(-g2(len(rows), got[0][f][1], base), f) for f, rows in got[1].items() if rows]
                floor = min((g2(*n, base) for n in got[0].values()), default=0.0)
            heapq.heapify(heap)
            continue
        if not heap or -heap[0][0] < MIN_G2:
            return chosen, done
        _, f = heapq.heappop(heap)
        now = -gain(f)
        if heap and now > heap[0][0] or floor is not None and -now <= floor:
            if -now >= MIN_G2:
                heapq.heappush(heap, (now, f))
        elif -now >= MIN_G2:
            chosen.append(f)
            done |= marked[f]


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Letter model from all of ``docs``; weights from labelled rows outside the held-out fold.

    At most ``max_train`` labelled documents are used, those with the smallest hash of the id, so the
    choice is the same on every run.  Labels other than 0 and 1 and null ids are ignored.
    """
    spark = docs.sparkSession
    letters = LetterModel(letter_trigrams(docs))
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    rows = cut(docs.select("doc_id", "text").join(cut(chosen), "doc_id").select("toxic", "text", F.monotonically_increasing_id().alias("row")))
    shared = spark.sparkContext.broadcast(letters)
    state: dict[str, Restorer] = {}

    def count(cols: dict[str, list]) -> dict[str, list]:
        """Rows with each feature, by label, added up inside a piece of the batch."""
        if "r" not in state:
            state["r"] = Restorer(shared.value, features)
        n = (Counter(), Counter())
        for text, toxic in zip(cols["text"], cols["toxic"]):
            n[toxic].update(state["r"].words(text))
            n[toxic][""] += 1
        every = list(n[0].keys() | n[1].keys())
        return {"feature": every, "n1": [n[1][f] for f in every], "n0": [n[0][f] for f in every]}

    found = map_batches(rows.select("toxic", "text"), count, "feature string, n1 bigint, n0 bigint", piece_bytes=COUNT_BYTES)
    counts = cut(found.groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).where("n1 >= 3"))
    total = counts.where("feature = ''").first()
    if total is None or not total.n0:
        return Model(letters, 0.5 if total is None else 0.9, {})
    t1, t0 = total.n1, total.n0
    base = t1 / (t1 + t0)
    strength = F.col("n1") * F.log(F.col("n1") / ((F.col("n1") + F.col("n0")) * base))
    strong = cut(counts.where((F.col("feature") != "") & (F.col("n1") > 2 * base * (F.col("n1") + F.col("n0"))) & (2 * strength >= MIN_G2)))
    few = strong.limit(MAX_SHARED + 1).count() <= MAX_SHARED
    candidates = spark.sparkContext.broadcast(frozenset(r.feature for r in strong.select("feature").collect()) if few else None)

    def mark(cols: dict[str, list]) -> dict[str, list]:
        """Candidates in each row, with hashes of the words beside them."""
        if "r" not in state:
            state["r"] = Restorer(shared.value, features)
        out: dict[str, list] = {"row": [], "feature": [], "beside": []}
        for row, text in zip(cols["row"], cols["text"]):
            tokens = ["", *(text or "").lower().split(), ""]
            words = state["r"].words(text)
            found = {f: 0 for f in (words if candidates.value is None else words & candidates.value)}
            for i in range(1, len(tokens) - 1):
                for f in state["r"].of(tokens[i]):
                    if found.get(f) == 0:
                        found[f] = xxhash.xxh32_intdigest(f"{tokens[i - 1]} {tokens[i + 1]}")
            out["row"] += [row] * len(found)
            out["feature"] += found
            out["beside"] += found.values()
        return out

    # Only rows of the sample with label 1, and only the features above.
    marks = cut(map_batches(rows.where("toxic = 1").select("row", "text"), mark, "row bigint, feature string, beside bigint").join(strong, "feature"))
    # Features with the same rows explain the same: the first by name stands for all, the shortest beginning of a word.
    summary = cut(marks.groupBy("feature").agg(
        F.first("n1").alias("n1"), F.first("n0").alias("n0"), F.count_distinct("beside").alias("n_around"),
        F.bit_xor(F.xxhash64("row")).alias("rows_a"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("rows_b"),
    ))
    alike = summary.groupBy("rows_a", "rows_b", "n1", "n0").agg(F.min("feature").alias("feature"))
    value = 2 * (strength + F.when(F.col("n0") > 0, F.col("n0") * F.log(F.col("n0") / ((F.col("n1") + F.col("n0")) * (1 - base)))).otherwise(0.0))
    judged = cut(alike.select("feature", "n1", "n0", value.alias("value")).where(F.col("value") >= MIN_G2 - 1e-6))

    def batches() -> Iterator[Batch]:
        """All of ``judged``, the strongest first, ``MAX_FEATURES`` at a time."""
        rest = judged
        while True:
            top = cut(rest.orderBy(F.desc("value"), "feature").limit(MAX_FEATURES))
            last = top.orderBy("value", F.desc("feature")).first()
            if last is None:
                return
            found = {r.feature: (r.n1, r.n0) for r in top.collect()}
            by_row: dict[str, set[int]] = {f: set() for f in found}
            for r in marks.select("feature", "row").join(top.select("feature"), "feature", "left_semi").toLocalIterator():
                by_row[r.feature].add(r.row)
            yield found, by_row
            if len(found) < MAX_FEATURES:
                return
            rest = judged.where((F.col("value") < last.value) | (F.col("value") == last.value) & (F.col("feature") > last.feature))

    chosen, explained = cover(batches(), base)
    # A word of its own stands in ever new surroundings; words that copies share stand in one or two.
    wide = summary.where(((F.col("n1") + 0.5) / (F.col("n1") + F.col("n0") + 1.0) >= MIN_SHARE) & (F.col("n_around") >= 2)).collect()
    by_feature = {r.feature: (r.n1, r.n0) for r in wide if g2(r.n_around, r.n0, base) >= MIN_G2_REPEATED}
    if chosen:
        by_feature |= {r.feature: (r.n1, r.n0) for r in summary.join(spark.createDataFrame([(f,) for f in chosen], "feature string"), "feature").collect()}
    chosen += sorted(by_feature.keys() - set(chosen))
    share = {f: (n1 + 0.5) / (n1 + n0 + 1.0) for f, (n1, n0) in by_feature.items()}
    weights = {f: share[f] for f in chosen}
    return Model(letters, (t1 - len(explained) + 0.5) / (t1 - len(explained) + t0 + 1.0), weights)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per row of ``docs``.  Null and empty texts get the prior; repeated rows stay repeated; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(cols: dict[str, list]) -> dict[str, list]:
        return {"doc_id": cols["doc_id"], "score": [shared.value.score(t) for t in cols["text"]]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; without usable labels every score is 0.5 or the labels' share."""
    scored = scores(docs, train(docs, labels, max_train))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs`` with a score below 0.5, all columns as they are, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_train))
    return keep_rows(docs, "text", lambda texts: [shared.value.score(t) < 0.5 for t in texts])
