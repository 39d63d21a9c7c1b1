"""Language identification by cross-parsing entropy (operator 2).

For each label a bounded sample of labelled texts is turned into a suffix automaton. A text is cut greedily
into longest phrases that occur in the sample; the number of phrases times log2 of the sample's length, per
character, estimates how many bits the text costs given that language. The cheapest language wins.

The model is fitted on at most ``SAMPLE_ROWS`` distinct texts and ``SAMPLE_CHARS`` characters of each label, and on
``SAMPLE_TOTAL`` characters in all, which labels share evenly. So do the texts of a label, where short texts leave their
rest to long ones; a long text is read from a place its hash picks. That bounds the driver's work and the broadcast.
Every learned label can be predicted. Transitions are kept sparsely, in one hashed table,
or, while they are few, with every step written out; both give the same steps.

Prediction covers whole texts: they are case-folded, and runs of anything but letters count as one blank. A task
parses many segments of ``SEGMENT`` characters in step. A segment first starts afresh; then it is run again from the
state in which its predecessor ended, next to its first run, until both are in the same state, and so on until
no segment's entry changes. The number of phrases is that of one parse from the text's start to its end.

Defined results: text that is null or has no letters is ``und`` with score 0; so is every text when there are
no labelled rows; equally cheap languages go to the first in order; a row with null doc_id is not held out
and not learned from; repeated texts count once in the sample. Score is 1 - best / second best (1 if there is
only one language). Predictions read the columns doc_id, text and lang only; others may have any name.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from fluxsieve.llm.common import as_row

SAMPLE_ROWS, SAMPLE_CHARS, SAMPLE_TOTAL = 24, 1 << 14, 1 << 20
SEGMENT = 1024
#: Pairs of a language and a segment that are parsed in step at a time.
IN_STEP = 1 << 16
#: A text whose phrases are shorter than 1 / REJECT letters on average is in none of the languages.
REJECT = 0.75
UNKNOWN = "und"
#: A table entry is a key above and the next state in this many bits (states are at most twice the sample).
STATE_BITS = 23
#: Up to this many pairs of a state and a symbol every step is written out, which is faster; beyond, the table is hashed.
CELLS = 1 << 23
_STATE = (1 << STATE_BITS) - 1
#: Multiplier of the hashed table (2**64 / golden ratio).
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def shares(lengths: list[int], total: int) -> list[int]:
    """``total`` divided evenly; who needs less leaves the rest to the others."""
    out, left = [0] * len(lengths), total
    for rank, i in enumerate(sorted(range(len(lengths)), key=lengths.__getitem__)):
        out[i] = min(lengths[i], left // (len(lengths) - rank))
        left -= out[i]
    return out


def sample(docs: DataFrame) -> list[tuple[str, list[str]]]:
    """(label, texts) of all labels; texts are picked by the order of their hashes."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    labels = rows.agg(F.countDistinct("lang")).first()[0]
    size = max(1, min(SAMPLE_CHARS, SAMPLE_TOTAL // max(1, labels)))
    h = F.xxhash64("text")
    start = F.pmod(h, F.greatest(F.length("text") - size, F.lit(0)) + 1) + 1
    cut = rows.select("lang", h.alias("h"), F.col("text").substr(start.cast("int"), F.lit(size)).alias("text"))
    order = Window.partitionBy("lang").orderBy("h")
    picked = cut.select("lang", "h").distinct().withColumn(
        "place", F.row_number().over(order)).where(F.col("place") <= SAMPLE_ROWS)
    texts = cut.join(picked, ["lang", "h"]).groupBy("lang", "place").agg(F.min("text").alias("text"))
    out: dict[str, list[str]] = {}
    for row in texts.orderBy("lang", "place").collect():
        out.setdefault(row["lang"], []).append(row["text"])
    return [(name, [t[:n] for t, n in zip(found, shares(list(map(len, found)), size))])
            for name, found in sorted(out.items())]


def letter_classes(texts: list[str]) -> np.ndarray:
    """Class of every code point: 0 no letter, 1 letter that no sample holds, from 2 the letters of the samples."""
    seen = sorted({c.lower()[0] for text in texts for c in text if c.isalpha()})
    place = {c: i + 2 for i, c in enumerate(seen)}
    return np.fromiter((place.get(c.lower()[0], 1) if (c := chr(i)).isalpha() else 0 for i in range(0x110000)),
                       np.int32, 0x110000)


def letters(text: str, classes: np.ndarray) -> np.ndarray:
    """Classes of a text's letters, with one 0 for every run of other characters."""
    found = classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != 0) | (found[:-1] != 0)
    return found[keep]


def suffix_automaton(symbols) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts every substring (Blumer et al. 1985); state 0 is the start."""
    moves, link, length, last = [{}], [-1], [0], 0
    for symbol in symbols:
        state = len(moves)
        moves.append({}), link.append(0), length.append(length[last] + 1)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = state
            at = link[at]
        if at >= 0:
            to = moves[at][symbol]
            if length[to] != length[at] + 1:
                copy = len(moves)
                moves.append(dict(moves[to])), link.append(link[to]), length.append(length[at] + 1)
                while at >= 0 and moves[at].get(symbol) == to:
                    moves[at][symbol] = copy
                    at = link[at]
                link[to] = copy
                to = copy
            link[state] = to
        last = state
    return moves


class Model:
    """Automata of all languages in one hashed table from (state, symbol) to state.

    The symbols that can begin a phrase stand in ``begin``: next state and, above it, the phrases such a step ends.
    """

    def __init__(self, texts: list[tuple[str, list[str]]]):
        self.names = [name for name, _ in texts]
        self.classes = letter_classes([t for _, own in texts for t in own])
        self.width = int(self.classes.max()) + 1
        keys, states, roots, self.bits, at = [], [], [], [], 0
        for _, own in texts:
            symbols = np.concatenate([np.append(letters(t, self.classes), 0) for t in own])
            moves = suffix_automaton(symbols.tolist())
            count = sum(map(len, moves))
            keys.append(np.fromiter(((at + i) * self.width + c for i, out in enumerate(moves) for c in out), np.int64, count))
            states.append(np.fromiter((at + to for out in moves for to in out.values()), np.int64, count))
            roots.append(at)
            self.bits.append(math.log2(max(2, len(symbols))))
            at += len(moves)
        self.roots = np.array(roots, np.int64)
        self._fill(np.concatenate([*keys, np.zeros(0, np.int64)]), np.concatenate([*states, np.zeros(0, np.int64)]))
        own = np.repeat(self.roots, self.width)
        to = self._move(own, np.tile(np.arange(self.width), len(roots)))
        self.begin = np.where(to < 0, own | 1 << STATE_BITS, to)
        self.steps = None
        if 0 < at * self.width <= CELLS:
            language = np.repeat(np.arange(len(roots)), np.diff([*roots, at]))
            self.steps = np.concatenate([self._written(np.arange(i, min(i + 4096, at)), language) for i in range(0, at, 4096)])
            self.table = None  # every step is written out

    def _written(self, states: np.ndarray, language: np.ndarray) -> np.ndarray:
        """Next state and, above it, ended phrases of every symbol in each of the states."""
        own = np.repeat(states, self.width)
        to, ended = self._step(own, language[own], np.tile(np.arange(self.width), len(states)))
        return (to | ended << STATE_BITS).astype(np.int32)

    def _fill(self, keys: np.ndarray, states: np.ndarray) -> None:
        """Open addressing with at least three of four slots free."""
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.table = np.full(1 << bits, -1, np.int64)
        entries, slot = keys << STATE_BITS | states, self._slot(keys)
        while len(entries):
            free = self.table[slot] < 0
            self.table[slot[free]] = entries[free]  # of several that want a slot the last one gets it
            left = self.table[slot] != entries
            entries, slot = entries[left], (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _SPREAD) >> self.shift).view(np.int64)

    def _move(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Next states, -1 where there is none."""
        wanted = state * self.width + symbol
        slot = self._slot(wanted)
        found = self.table[slot]
        rest = np.flatnonzero((found >> STATE_BITS != wanted) & (found >= 0))
        while len(rest):
            slot[rest] += 1
            slot[rest] &= self.mask
            found[rest] = other = self.table[slot[rest]]
            rest = rest[(other >> STATE_BITS != wanted[rest]) & (other >= 0)]
        return np.where(found >= 0, found & _STATE, -1)

    def _step(self, state: np.ndarray, number: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states in the languages ``number``, and the number of phrases each step ended.

        A symbol that no sample of the language holds is a phrase of its own.
        """
        if self.steps is not None:
            entry = self.steps[state * self.width + symbol]
            return entry & _STATE, entry >> STATE_BITS
        to, steps = self._move(state, symbol), np.zeros(len(state), np.int64)
        stuck = np.flatnonzero(to < 0)
        own = number[stuck]
        fresh = self.begin[own * self.width + symbol[stuck]]
        steps[stuck] = (state[stuck] != self.roots[own]) + (fresh >> STATE_BITS)
        to[stuck] = fresh & _STATE
        return to, steps

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of each text in each language: (languages, texts)."""
        out = np.zeros((len(self.roots), len(texts)), np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        symbols = np.concatenate([*texts, np.zeros(0, np.int32)])
        first = np.cumsum(sizes) - sizes
        pieces = -(-sizes // SEGMENT)
        roots = self.roots
        group = np.cumsum(pieces) // max(1, IN_STEP // max(1, len(roots)))
        for g in np.unique(group):
            own = np.flatnonzero(group == g)
            several = max(1, IN_STEP // max(1, int(pieces[own].sum())))
            for k in range(0, len(roots), several):
                out[k:k + several, own] = self._parse(symbols, first[own], sizes[own], np.arange(len(roots))[k:k + several])
        return out

    def _parse(self, symbols: np.ndarray, first: np.ndarray, sizes: np.ndarray, languages: np.ndarray) -> np.ndarray:
        """Number of phrases of the texts that begin at ``first``, for each of the languages."""
        pieces = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(sizes)), pieces)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        many, n = len(languages), len(owner)
        start = np.tile(first[owner] + inner * SEGMENT, many)
        length = np.tile(np.minimum(SEGMENT, sizes[owner] - inner * SEGMENT), many)
        follows, number = np.tile(inner > 0, many), np.repeat(languages, n)
        root = self.roots[number]
        count, ended, entry = np.zeros(many * n, np.int64), root.copy(), root.copy()
        order = np.argsort(-length, kind="stable")
        begin, longest, own, state = start[order], length[order], number[order], root[order]
        phrases = np.zeros(many * n, np.int64)
        active = np.searchsorted(-longest, -np.arange(SEGMENT), side="left")  # segments longer than the step
        for step in range(int(longest[0]) if many * n else 0):
            k = active[step]
            state[:k], ends = self._step(state[:k], own[:k], symbols[begin[:k] + step])
            phrases[:k] += ends
        count[order], ended[order] = phrases, state
        before = np.roll(ended, 1)
        while len(again := np.flatnonzero(follows & (before != entry))):
            old, new = entry[again], before[again]
            entry[again] = new
            step, live = 0, np.arange(len(again))
            while len(live):  # until both runs meet, or to the segment's end
                at = again[live]
                symbol = symbols[start[at] + step]
                old[live], less = self._step(old[live], number[at], symbol)
                new[live], more = self._step(new[live], number[at], symbol)
                count[at] += more - less
                step += 1
                over = length[at] == step
                apart = old[live] != new[live]
                ended[at[over & apart]] = new[live[over & apart]]
                live = live[apart & ~over]
            before = np.roll(ended, 1)
        last = np.tile(np.append(inner[1:] == 0, True)[:n], many)
        count += last & (ended != root)  # a phrase that is open at the text's end
        out = np.zeros((len(sizes), many), np.int64)
        np.add.at(out, (np.tile(owner, many), np.repeat(np.arange(many), n)), count)
        return out.T

    def predict(self, texts) -> pd.DataFrame:
        """lang, score, rate (phrases per letter) of each text."""
        parsed = [letters(t or "", self.classes) for t in texts]
        some = [i for i, p in enumerate(parsed) if p.any() and self.names]
        out = pd.DataFrame({"lang": UNKNOWN, "score": 0.0, "rate": 1.0}, index=range(len(parsed)))
        if some:
            own = [parsed[i] for i in some]
            count = self.phrases(own)
            cost = count * np.array(self.bits)[:, None]
            best = cost.argmin(axis=0)
            ranked = np.sort(cost, axis=0)
            score = 1 - ranked[0] / ranked[1] if len(ranked) > 1 else np.ones(len(some))
            out.loc[some, "lang"] = np.array(self.names, object)[best]
            out.loc[some, "score"] = score
            out.loc[some, "rate"] = count[best, np.arange(len(some))] / np.array([len(p) for p in own])
        return out


def predictor(docs: DataFrame):
    """Column function text -> struct(lang, score, rate), learned from the rows of ``docs`` not held out."""
    learned = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    model = docs.sparkSession.sparkContext.broadcast(Model(sample(learned)))

    @F.pandas_udf("lang string, score double, rate double")
    def predict(text: pd.Series) -> pd.DataFrame:
        return model.value.predict(text)

    return predict


def predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predictor(docs)("text").alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are in one of the languages, unchanged."""
    rows = as_row(docs, predictor(docs)("text").alias("p"))
    return rows.where((F.col("p.lang") != UNKNOWN) & (F.col("p.rate") <= REJECT)).select("row.*")
