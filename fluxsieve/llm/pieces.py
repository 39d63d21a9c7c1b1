"""SentencePiece encoding by forward-filtering backward-sampling, and lossless decoding (operator 4).

A text's pieces form a lattice over its characters. Forward filtering gives every position the log-sum of the
weights of all paths that reach it; backward sampling then draws the last piece of the rest, from the end to
the start, each with its exact posterior chance. A draw is a hash of (seed, row key, position), so a row gets
the same segmentation on any machine and in any batch, and rows differ.

A piece's log-weight is its score times ``SHARPNESS``. No piece of the model runs over the end of a run of
letters into a blank, so the lattice falls apart at blanks (and line feeds, which no piece holds); units between
them are filtered once per task and draws for all units of a batch are made together. A model with pieces that
cross blanks is handled as one unit per text.

The text gets one blank in front, which decoding removes. Characters without a piece, and the literal blank
mark of the model, become byte pieces, so decode(encode(text)) == text for every text.

Defined results: null text has null pieces; the empty text has none; a null id is a key like any other; rows
repeated with the same id and text get the same pieces; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

SHARPNESS, SEED = 1e-3, 42
#: Largest number of lattice edges a task keeps for units it has met; beyond it the task starts afresh.
EDGES = 8_000_000
MARK = "▁"


class Vocabulary:
    """Pieces of a model file, with blanks for the blank mark; as large as the model, whatever the input."""

    def __init__(self, path: str, sharpness: float = SHARPNESS):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.place, self.byte_id, self.bytes = {}, {}, []
        count = model.get_piece_size()
        scores = np.array([model.get_score(i) for i in range(count)])
        #: Scores below -1e6 mark pieces the model's own training never scored; they count as the least frequent.
        self.weight = sharpness * np.maximum(scores, scores[scores > -1e6].min())
        for i in range(count):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:-1], 16)
                self.byte_id[value] = i
                self.bytes.append(bytes([value]))
                continue
            usable = not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
            text = model.id_to_piece(i).replace(MARK, " ") if usable else ""
            self.bytes.append(text.encode())
            if usable:
                self.place[text] = i
        crossing = any(" " in t.lstrip(" ") or "\n" in t and t != "\n" for t in self.place)
        self.unit = re.compile(r"(?s).+" if crossing else r"\n| *[^ \n]+| +")
        self._build_trie()

    def _build_trie(self) -> None:
        """Every beginning of a piece is a node; steps are sorted by node and character, for searching."""
        node = {t[:k]: 0 for t in self.place for k in range(len(t) + 1)}
        for i, beginning in enumerate(sorted(node)):  # the empty one is node 0
            node[beginning] = i
        letters = sorted({c for t in self.place for c in t})
        self.letter = np.full(0x110000, -1, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(len(letters))
        self.width = len(letters)
        steps = sorted((node[t[:-1]] * self.width + int(self.letter[ord(t[-1])]), n) for t, n in node.items() if t)
        self.step, self.child = np.array([k for k, _ in steps], np.int64), np.array([n for _, n in steps], np.int64)
        self.piece_at = np.full(len(node), -1, np.int64)
        self.piece_at[[node[t] for t in self.place]] = list(self.place.values())

    def edges(self, units: list[str]) -> tuple[np.ndarray, ...]:
        """Start, end, piece of all edges, and start of the unit, by position in the joined units.

        -1 - code point stands for the piece of a character that has none.
        """
        code = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.fromiter(map(len, units), np.int64, len(units))
        stop = np.repeat(np.cumsum(size), size)
        letter, at = self.letter[code], np.arange(len(code))
        node, found, depth = np.zeros(len(code), np.int64), [], 0
        while len(at):
            own = letter[at + depth]
            wanted = node * self.width + own
            place = np.minimum(np.searchsorted(self.step, wanted), len(self.step) - 1)
            known = (own >= 0) & (self.step[place] == wanted)
            at, node = at[known], self.child[place[known]]
            piece = self.piece_at[node]
            hit = piece >= 0
            if depth == 0:
                bare = np.ones(len(code), bool)
                bare[at[hit]] = False
                lost = np.flatnonzero(bare)
                found.append((lost, lost + 1, -1 - code[lost].astype(np.int64)))
            depth += 1
            found.append((at[hit], at[hit] + depth, piece[hit]))
            more = at + depth < stop[at]
            at, node = at[more], node[more]
        start, end, piece = (np.concatenate(x) for x in zip(*found))
        return start, end, piece, (stop - np.repeat(size, size))[start]


class Lattice:
    """Filtered lattices of the units a task has met, as flat arrays of edges sorted by the node they end at.

    The end of a unit after k characters is node first_node[unit] + k - 1, whose edges begin at first_edge of it. An
    edge carries the chance of the node's edges before it: a draw takes the last edge whose chance is not above it.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.first_node: dict[str, int] = {}
        self.before, self.piece, self.back = np.zeros(0, np.float32), np.zeros(0, np.int32), np.zeros(0, np.uint16)
        self.first_edge, self.nodes = np.zeros(1, np.int64), 0

    def learn(self, units: list[str]) -> None:
        """Filter the units not met so far, all of them in step from their starts."""
        first, new = self.nodes, [u for u in dict.fromkeys(units) if u not in self.first_node]
        if not new:
            return
        for unit in new:
            self.first_node[unit] = self.nodes
            self.nodes += len(unit)
        start, end, piece, unit_start = self.vocabulary.edges(new)
        weight = np.where(piece >= 0, self.vocabulary.weight[np.maximum(piece, 0)], 0.0)
        step, begin = end - unit_start, np.where(start > unit_start, start, 0)
        order = np.lexsort((start, end, step))  # by step, then the node the edge ends at
        mass, before = np.zeros(self.nodes - first + 1), np.zeros(len(end))
        rounds = np.searchsorted(step[order], np.arange(1, step.max() + 2))
        for low, high in zip(rounds[:-1], rounds[1:]):
            at = order[low:high]
            own = end[at]
            heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            width = np.diff(np.append(heads, len(at)))
            value = mass[begin[at]] + weight[at]
            top = np.maximum.reduceat(value, heads)
            chance = np.exp(value - np.repeat(top, width))
            total = np.add.reduceat(chance, heads)
            run = np.cumsum(chance) - chance
            before[at] = (run - np.repeat(run[heads], width)) / np.repeat(total, width)
            mass[own[heads]] = top + np.log(total)
        by_node = np.lexsort((start, end))
        self.before = np.concatenate([self.before, before[by_node].astype(np.float32)])
        self.piece = np.concatenate([self.piece, piece[by_node].astype(np.int32)])
        self.back = np.concatenate([self.back, (end - start)[by_node].astype(np.uint16)])
        self.first_edge = np.concatenate([self.first_edge, self.first_edge[-1] + np.cumsum(
            np.bincount(end - 1, minlength=self.nodes - first))])

    def draw(self, node: np.ndarray, chance: np.ndarray) -> np.ndarray:
        """The edge of each node that a number in [0, 1) falls on."""
        edge, last = self.first_edge[node], self.first_edge[node + 1] - 1
        live = np.flatnonzero(edge < last)
        while len(live):
            further = edge[live] + 1
            live = live[self.before[further] <= chance[live]]
            edge[live] += 1
            live = live[edge[live] < last[live]]
        return edge


def uniform(key: np.ndarray, position: np.ndarray) -> np.ndarray:
    """A number in [0, 1) for each (row key, position)."""
    x = key + (position.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def sample(texts: list[str], keys: np.ndarray, lattice: Lattice) -> tuple[np.ndarray, np.ndarray]:
    """Sampled piece ids of all texts, one after another, and the number of pieces of each text."""
    if len(lattice.piece) > EDGES:
        lattice.clear()
    find = lattice.vocabulary.unit.findall
    units, owners = [], []
    for text in texts:
        own = find(" " + text) if text else []
        units += own
        owners.append(len(own))
    lattice.learn(units)
    node = np.fromiter(map(lattice.first_node.__getitem__, units), np.int64, len(units))
    length = np.fromiter(map(len, units), np.int64, len(units))
    owner = np.repeat(np.arange(len(texts)), owners)
    ends = np.cumsum(length)
    text_start = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(owners)[:-1]]).astype(np.int64)]
    left, live, drawn = length.copy(), np.arange(len(units)), []
    while len(live):
        at = node[live] + left[live] - 1
        position = ends[live] - length[live] + left[live] - text_start[owner[live]]
        edge = lattice.draw(at, uniform(keys[owner[live]], position))
        drawn.append((live, lattice.piece[edge]))
        left[live] -= lattice.back[edge]
        live = live[left[live] > 0]
    count = np.zeros(len(units), np.int64)
    for units_drawn, _ in drawn:
        count[units_drawn] += 1
    stop = np.cumsum(count)
    out = np.zeros(stop[-1] if len(stop) else 0, np.int32)
    for back, (units_drawn, pieces) in enumerate(drawn):
        out[stop[units_drawn] - 1 - back] = pieces
    per_text = np.bincount(owner, count, len(texts)).astype(np.int64)
    return _with_bytes(out, per_text, lattice.vocabulary)


def _with_bytes(pieces: np.ndarray, per_text: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Put byte pieces in place of the characters that have no piece (written as -1 - code point)."""
    lost = np.flatnonzero(pieces < 0)
    if not len(lost):
        return pieces, per_text
    encoded = [chr(-1 - p).encode("utf-8", "surrogatepass") for p in pieces[lost]]
    repeat = np.ones(len(pieces), np.int64)
    repeat[lost] = [len(e) for e in encoded]
    text = np.repeat(np.arange(len(per_text)), per_text)
    out, start = np.repeat(pieces, repeat), np.cumsum(repeat) - repeat
    for at, some in zip(start[lost], encoded):
        out[at:at + len(some)] = [vocabulary.byte_id[b] for b in some]
    return out, np.bincount(text, repeat, len(per_text)).astype(np.int64)


def decode(ids, vocabulary: Vocabulary) -> str:
    return b"".join(map(vocabulary.bytes.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


def encoded(docs: DataFrame, model: str, sharpness: float = SHARPNESS, seed: int = SEED) -> DataFrame:
    """id, ids (sampled pieces), n_pieces, decoded_sha256, lossless (decoding gives the text) of every row."""
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary(model, sharpness))

    def run(batches):
        vocabulary = shared.value
        lattice = Lattice(vocabulary)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            keys = batch.column("key").to_numpy().view(np.uint64)
            flat, per_text = sample([t or "" for t in texts], keys, lattice)
            ends = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)
            null = np.array([t is None for t in texts], bool)
            plain, hashes, lossless = flat.tolist(), [], []
            for i, text in enumerate(texts):
                back = None if text is None else decode(plain[ends[i]:ends[i + 1]], vocabulary)
                hashes.append(None if back is None else hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
                lossless.append(back == text)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=pa.array(null))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), ids, pa.array(per_text, mask=null), pa.array(hashes, pa.string()),
                 pa.array(lossless)], ["id", "ids", "n_pieces", "decoded_sha256", "lossless"])

    key = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("key")
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select(F.col("doc_id").alias("id"), key, "text").mapInArrow(
        run, f"id {kind}, ids array<int>, n_pieces long, decoded_sha256 string, lossless boolean")
