"""Alignment of two tokenizers' tokens by diagonal run skipping (operator 12).

Every text is encoded by a byte-level BPE (A) and a piece model (B); both token sequences spell the same bytes, so
each is an array of byte ends. From a common boundary the arrays are compared at the current index shift in blocks of
4, 8, 16, ... tokens: while blocks are equal the tokens stand one to one and are jumped over; the block that differs
is halved down to the first difference. There the smaller end moves on, side by side, until both ends meet: an
irregular group, after which the index shift is another. Groups are what lies between common boundaries. Within a
group ends differ, so each end of the union marks exactly one overlap: a link of an A and a B token. A unit (see
``Pair``) begins a token of both, so no group crosses its start: a long text is encoded and aligned in portions that
begin with a unit, with the groups of the whole text.

Pair counts cover the whole corpus. A task gathers documents into blocks of ``LINKS`` links, and a block's distinct
id pairs with their counts are its only rows that are shuffled by pair. The counts come back to the block by its
number, in chunks of ``CHUNK`` places of its own pair list, and are added up there for each of its documents. A block ends with the
text that brings it to ``LINKS`` links, so a row is bounded by that and one text.

Defined results: texts that are null, empty, or that the tokens of A or B do not spell byte for byte have no tokens,
zeros and an empty digest; ids may be null or repeated, each row is aligned on its own; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from fluxsieve.llm.common import stored

#: Links after which a block ends, characters that are encoded at once, and units whose tokens a worker holds.
LINKS, PORTION, UNITS = 1 << 17, 1 << 18, 1 << 18
#: Places of a block's pair list whose counts are gathered at once.
CHUNK = 1 << 10
#: Units that are encoded in one call.
GROUP = 64
#: Tokens of the first block that is compared.
PROBE = 4
# Fixed value: how the byte-level vocabulary cuts a text before it merges.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where units begin.
UNIT = re.compile(r"(?<=\S)(?= \S)")
#: An id pair is one long: the A id above, the B id below this many bits.
SHIFT = 32
#: What follows an id within a side, after the A side, and after a group.
MARKS = ",|;"


def byte_of_symbol() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, the bytes of their tokens, and the tokens of the units met last.

    A blank between two characters that are no white space starts a token of A, and of B too, as no piece holds a
    blank after another character. So the units between such blanks are encoded each by itself, once while they are held.
    """

    def __init__(self, bpe: str, pieces: str):
        import sentencepiece
        import tiktoken

        symbol = byte_of_symbol()
        with open(bpe, encoding="utf-8") as file:
            published = json.load(file)
        vocabulary, special = published["model"]["vocab"], {t["id"] for t in published.get("added_tokens", [])}
        a_bytes = {i: bytes(map(symbol.__getitem__, t)) for t, i in vocabulary.items() if set(t) <= symbol.keys()}
        # ids of this vocabulary are the ranks of its merges
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, special_tokens={},
                                   mergeable_ranks={t: i for i, t in a_bytes.items() if i not in special})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        # an id without bytes gets one that no text holds
        self.spelled = [[a_bytes.get(i, b"\xff") for i in range(max(a_bytes) + 1)],
                        [self._piece(i) for i in range(self.b.get_piece_size())]]
        self.length = [np.array(list(map(len, side)), np.int64) for side in self.spelled]
        self.ids_above = max(map(len, self.spelled))
        self.name = [f"{i}{mark}" for mark in MARKS for i in range(self.ids_above)]
        self.apart = not any(b" " in x.lstrip(b" ") for x in self.spelled[1])
        self.clear()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("\u2581", " ").encode()

    def clear(self) -> None:
        self.unit: dict[str, int] = {}
        self.whole = np.zeros(0, bool)
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.first = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def learn(self, units: list[str]) -> None:
        """Encode the units that are not held yet. A unit begins with the blank that B adds.

        Units without more white space at their ends stand in any text as they do in the next one, so they are
        encoded ``GROUP`` at a time and cut at their bytes; those of a group that is not spelled follow singly.
        """
        new = [u for u in dict.fromkeys(units) if u not in self.unit]
        joins = [u for u in new if self.apart and u[1:] == u[1:].strip()]
        missed = self.hold([joins[i:i + GROUP] for i in range(0, len(joins), GROUP)])
        alone = dict.fromkeys(new).keys() - self.unit.keys() if missed or len(joins) < len(new) else ()
        left = [u for [u] in self.hold([[u] for u in new if u in alone])]
        self.unit.update(zip(left, range(len(self.unit), len(self.unit) + len(left))))
        self.whole = np.concatenate([self.whole, np.zeros(len(left), bool)])
        self.first = [np.append(first, np.full(len(left), first[-1])) for first in self.first]

    def hold(self, groups: list[list[str]]) -> list[list[str]]:
        """Keep the tokens of the groups that both sides spell, and return the others."""
        if not groups:
            return []
        texts = list(map("".join, groups))
        raw = list(map(str.encode, texts))
        sides = [list(map(self.a.encode_ordinary, texts)), self.b.encode([t[1:] for t in texts], num_threads=1)]
        same = [all(b"".join([x[i] for i in ids]) == r for x, ids in zip(self.spelled, both)) for r, *both in zip(raw, *sides)]
        kept = list(chain.from_iterable(g for g, good in zip(groups, same) if good))
        ends = np.cumsum(np.fromiter(map(len, map(str.encode, kept)), np.int64, len(kept)))
        for k, found in enumerate(sides):
            ids = np.fromiter(chain.from_iterable(ids for ids, good in zip(found, same) if good), np.int32)
            self.ids[k] = np.concatenate([self.ids[k], ids])
            after = np.searchsorted(np.cumsum(self.length[k][ids]), ends) + 1
            self.first[k] = np.concatenate([self.first[k], self.first[k][-1] + after])
        self.unit.update(zip(kept, range(len(self.unit), len(self.unit) + len(kept))))
        self.whole = np.concatenate([self.whole, np.ones(len(kept), bool)])
        return [g for g, good in zip(groups, same) if not good]

    def portions(self, text: str):
        """The text in portions of about ``PORTION`` characters that begin with a unit, without its blank."""
        start = 0
        while self.apart and len(text) - start > PORTION and (unit := UNIT.search(text, start + PORTION)):
            yield text[start:unit.start()]
            start = unit.start() + 1
        yield text[start:]

    def written(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3`` of all groups: ids, and the token numbers at which groups end."""
        of_a, of_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
        place_a = np.arange(len(a)) + np.repeat(end_b - of_b, of_a)
        place_b = np.arange(len(b)) + np.repeat(end_a, of_b)
        name = np.empty(len(a) + len(b), np.int64)
        name[place_a], name[place_b] = a, b
        name[place_a[end_a - 1]] += self.ids_above
        name[place_b[end_b - 1]] += 2 * self.ids_above
        return "".join(map(self.name.__getitem__, name.tolist()))[:-1]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Ids and byte ends of A, then of B, for each text; all empty if either does not spell the text."""
        if len(self.unit) > UNITS or max(map(len, self.ids)) > 4 * UNITS:
            self.clear()
        split = [(UNIT.split(" " + t) if self.apart else [" " + t]) if t else [] for t in texts]
        units = list(chain.from_iterable(split))
        self.learn(units)
        at = np.fromiter(map(self.unit.__getitem__, units), np.int64, len(units))
        stop, out, i = np.cumsum(list(map(len, split))), [], 0
        for j in stop:
            own, i = at[i:j], j
            if not self.whole[own].all():
                own = own[:0]
            sides = []
            for ids, first, length in zip(self.ids, self.first, self.length):
                count = first[own + 1] - first[own]
                end = np.cumsum(count)
                found = ids[np.repeat(first[own] - end + count, count) + np.arange(end[-1] if len(end) else 0)]
                sides += [found, np.cumsum(length[found])]
            out.append(tuple(sides))
        return out


@lru_cache(1)
def pair(bpe: str, pieces: str) -> Pair:
    return Pair(bpe, pieces)


def runs(a: list[int], b: list[int]) -> list[tuple[int, int, int, int, bool]]:
    """Stretches (from A, to A, from B, to B, whether one to one) of two arrays of ends whose last ends are equal.

    A stretch that is one to one holds a group for each token; any other is one group.
    """
    out, i, j, n = [], 0, 0, len(a)
    while i < n:
        p, q, step = i, j, PROBE
        while p + step <= n and a[p:p + step] == b[q:q + step]:
            p, q, step = p + step, q + step, 2 * step
        while step > 1:
            step //= 2
            if p + step <= n and a[p:p + step] == b[q:q + step]:
                p, q = p + step, q + step
        if p > i:
            out.append((i, p, j, q, True))
            i, j = p, q
            if i == n:
                break
        end_a, end_b = a[p], b[q]
        while end_a != end_b:
            if end_a < end_b:
                p += 1
                end_a = a[p]
            else:
                q += 1
                end_b = b[q]
        out.append((i, p + 1, j, q + 1, False))
        i, j = p + 1, q + 1
    return out


def group_ends(found: list[tuple[int, int, int, int, bool]]) -> tuple[np.ndarray, np.ndarray]:
    """A and B token numbers at which groups end: all of a stretch that is one to one, else its last."""
    from_a, to_a, from_b, to_b, plain = np.array(found, np.int64).reshape(-1, 5).T
    n = np.where(plain, to_a - from_a, 1)
    left = np.repeat(np.cumsum(n), n) - np.arange(1, n.sum() + 1)
    return np.repeat(to_a, n) - left, np.repeat(to_b, n) - left


def links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A and B token numbers of all overlaps: ends within a group differ, so each end of the union marks one."""
    at_a, at_b = np.zeros((2, (a[-1] if len(a) else 0) + 1), bool)
    at_a[a] = at_b[b] = True
    ends = np.flatnonzero(at_a | at_b)
    return tuple(np.cumsum(at[ends]) - at[ends] for at in (at_a, at_b))


_DOC = "struct<id:{kind},n_a:long,n_b:long,n_groups:long,n_links:long,groups_sha256:string>"


def together(rows: list[tuple], most: int):
    """The rows (row number, portion, whether its last) in lists of about ``most`` characters."""
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += len(row[1])
        if held >= most:
            yield out
            out, held = [], 0
    yield out


class Document:
    """What is known of a text after some of its portions."""

    def __init__(self):
        self.spelled, self.sums, self.digest, self.codes = True, np.zeros(4, np.int64), hashlib.sha256(), []

    def add(self, both: Pair, a_ids: np.ndarray, a: np.ndarray, b_ids: np.ndarray, b: np.ndarray) -> None:
        if not (self.spelled and len(a)):
            self.spelled, self.codes = False, []
            return
        end_a, end_b = group_ends(runs(a.tolist(), b.tolist()))
        of_a, of_b = links(a, b)
        self.digest.update((";" if self.sums[0] else "").encode() + both.written(a_ids, b_ids, end_a, end_b).encode())
        self.codes.append(a_ids[of_a].astype(np.int64) << SHIFT | b_ids[of_b])
        self.sums += [len(a), len(b), len(end_a), len(of_a)]

    def row(self) -> tuple:
        return (*map(int, self.sums), self.digest.hexdigest()) if self.spelled else (0, 0, 0, 0, "")


def documents(both: Pair, texts):
    """A document of each text, in order."""
    doc, at = Document(), 0
    for some in together(((k, part) for k, text in enumerate(texts) for part in both.portions(text)), PORTION):
        for (k, _), sides in zip(some, both.encode([part for _, part in some])):
            if k > at:
                yield doc
                doc, at = Document(), k
            doc.add(both, *sides)
    yield doc


def blocks(docs: DataFrame, bpe: str, pieces: str, size: int = LINKS) -> DataFrame:
    """block, docs (each document's counts and digest), pairs and counts (distinct id pairs), at (pair of each link)."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        both, number, held, codes, total, id_type = pair(bpe, pieces), 0, [], [], 0, None

        def block():
            distinct, at, counts = np.unique(np.concatenate([*codes, np.zeros(0, np.int64)]), return_inverse=True, return_counts=True)
            ids, n_a, n_b, n_groups, n_links, digests = zip(*held)
            fields = pa.StructArray.from_arrays(
                [pa.array(ids, id_type), *[pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups, n_links)], pa.array(digests, pa.string())],
                ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            return pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() << 32 | number]), one(fields), one(pa.array(distinct)), one(pa.array(counts)),
                 pa.array([at.astype(np.int32).tobytes()], pa.binary())], ["block", "docs", "pairs", "counts", "at"])

        for batch in batches:
            id_type = batch.column("id").type
            ids = batch.column("id").to_pylist()
            for i, doc in zip(ids, documents(both, (t.as_py() or "" for t in batch.column("text")))):
                held.append((i, *doc.row()))
                codes += doc.codes
                total += int(doc.sums[3]) if doc.spelled else 0
                if total >= size:
                    yield block()
                    number, total = number + 1, 0
                    held.clear()
                    codes.clear()
        if held:
            yield block()
        both.clear()  # the worker lives on

    return docs.select(F.col("doc_id").alias("id"), "text").mapInArrow(
        run, f"block long, docs array<{_DOC.format(kind=kind)}>, pairs array<long>, counts array<long>, at binary")


def pair_counts(found: DataFrame) -> DataFrame:
    """pair, n (links that hold it) and best (no pair of its B id has more) over the whole corpus."""
    each = found.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).groupBy("p.pairs").agg(
        F.sum("p.counts").alias("n")).select(F.col("pairs").alias("pair"), "n")
    counted = stored(each.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))), "pair-counts")
    most = counted.groupBy("b").agg(F.max("n").alias("most"))
    return counted.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, bpe: str, pieces: str, size: int = LINKS) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    kind = dict(docs.dtypes)["doc_id"]
    found = stored(blocks(docs, bpe, pieces, size), "alignment")
    asked = found.select("block", F.posexplode("pairs").alias("place", "pair"))
    # twice the count, plus one if it is the best; chunks keep what a task gathers small
    known = asked.join(pair_counts(found), "pair").select(
        "block", "place", (F.col("n") * 2 + F.col("best").cast("long")).alias("known"))
    chunks = known.repartition("block").groupBy("block", F.floor(F.col("place") / CHUNK).alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("place", "known"))).alias("known"))
    back = chunks.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("chunk", F.col("known.known").alias("known")))).alias("known")).select(
        "block", F.flatten("known.known").alias("known"))
    fields = [f"{c} long" for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                own = batch.column("docs")[row].values
                at = np.frombuffer(batch.column("at")[row].as_py(), np.int32)
                known = batch.column("known")[row].values
                known = np.zeros(0, np.int64) if known is None else known.to_numpy()
                stop = np.cumsum(own.field("n_links").to_numpy())
                sums = [np.concatenate([[0], np.cumsum(x[at])]) for x in (known & 1, known >> 1)]
                totals = [np.diff(s[np.concatenate([[0], stop])]) for s in sums]
                yield pa.RecordBatch.from_arrays(
                    [*[own.field(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")], *map(pa.array, totals),
                     own.field("groups_sha256")],
                    ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return found.select("block", "docs", "at").join(back, "block", "left").select("docs", "at", "known").mapInArrow(
        run, f"id {kind}, {', '.join(fields)}, groups_sha256 string")
