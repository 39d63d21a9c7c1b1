"""SimHash near-dedup over a byte-position inverted index with count filtering (operator 9).

A fingerprint has eight positional bytes. Two fingerprints that differ in at most two bits share at least six
of them, and of four blocks of two bytes at least two whole blocks. So the index is kept by pairs of blocks
(four positional bytes), which shortens the posting lists of single bytes by a factor of 2**24 and loses no
pair. A pair from a posting list is tallied: it stays if six or more positional bytes agree, and is verified
by its differing bits.

Posting lists of more than ``LIST`` fingerprints (a large group of near copies) never become pairs: each of
their fingerprints names itself and its one-bit neighbours. Two fingerprints name a common point exactly if
they differ in at most two bits, so linking each to the smallest that named the point gives the same
components with linear output.

Near copies that are similar rather than almost equal (five-word shingles, similarity of 0.8) differ in about 15%
of all bits, so no whole byte is guaranteed to survive and two bits are far too few. ``similar`` therefore gives
every document ``SEEDS`` fingerprints of its distinct shingles from differently mixed hashes and keeps the index by
``KEYS`` triples of positional bytes, drawn from the bytes of all fingerprints. A posting list is first counted, with
its smallest and largest member, on the map side; these pairs give components. Only lists of three members and more
are made again, behind a filter of fixed size, and every pair of a list of up to ``CROWD`` members whose components
differ is made. No failed check drops another pair.

A large group of versions of one text, many of them too far apart for a link, would fill longer lists with pairs that
are none. Members of those lists meet as the family of the list's largest component instead, once, however many lists
they share. Each is compared with up to ``REFS`` documents of the component. Others are found by their rarest shingles:
of two sets ordered alike, as similar as asked for, the first few members of both have one in common. Rare is what few
of these documents hold, so that versions meet over words they share with each other, not over the words of all.

A candidate pair's shared positional bytes are tallied: it stays if it reaches ``SHARED``, the least number that a similar
pair has but for 3 deviations, and if few enough bits differ. Pairs far on the similar side are links; of the others
those that would join two components are decided by the Jaccard similarity of the two shingle sets.

Defined results: null or blank text has fingerprint zero; null ids never are a component's name unless all
its ids are null; rows repeated with one id and text come out once; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fluxsieve.llm.common import identity, only
from fluxsieve.llm.decontaminate import bloom, may_hold
from fluxsieve.operators.graph import component_labels
from fluxsieve.session import cut

DISTANCE = 2
LEAST_BYTES = 8 - DISTANCE
LIST = 24
#: Fingerprints of a document in ``similar``, triples of their bytes in the index, jobs the index is made in, further
#: bytes that divide a long list, and how often.
SEEDS, KEYS, ROUNDS, FURTHER, LEVELS = 8, 315, 5, 16, 3
#: Members up to which a list of ``similar`` is paired outright; documents of a component a family is compared with, and
#: the factor between the sizes of sets that are looked up together.
CROWD, REFS, BAND = 8, 32, 1.02
#: Larger sets are no references.
REF_SIZE = 1 << 14
PARITIES = [f"x{i}" for i in range(8)]
#: Shared positional bytes a pair of ``similar`` must reach. At a similarity of 0.8 the mean is 17 of 64, the deviation 3.6.
SHARED = 6
#: Pairs of ``similar`` stay for the comparison of their sets up to this share of differing bits. At a similarity of 0.8
#: the mean is 0.1515 with a deviation of 0.0158 over 512 bits: the bounds are six deviations above it and four below.
#: Below the second one, documents of that many distinct shingles or more need no comparison.
BITS, SURE_BITS, SURE_SHINGLES = 0.25, 0.088, 64
SALTS = np.array([seed * 0x9E3779B97F4A7C15 % (1 << 64) for seed in range(SEEDS)], np.uint64)
NAMES = ["fp", *[f"fp{i}" for i in range(1, SEEDS)]]
SLICE = 1 << 16
BLOCKS = ((0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words, or of all words if there are fewer."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return np.empty(0, np.uint64)
    size = min(size, len(words))
    hashed = map(partial(xxhash.xxh64_intdigest, seed=42), map(b" ".join, zip(*[words[i:] for i in range(size)])))
    return np.fromiter(hashed, np.uint64, len(words) - size + 1)


def fingerprint(text: str | None, size: int, seeds: int = 1, once: bool = False) -> list[int]:
    """Bit i is set if it is set in over half of the shingles' hashes; later seeds mix the hashes anew.

    With ``once``, a repeated shingle counts once.
    """
    all_hashes = shingles(text, size)
    return majority(np.unique(all_hashes) if once else all_hashes, seeds)


def majority(all_hashes: np.ndarray, seeds: int) -> list[int]:
    """Fingerprints of hashes, one for each seed."""
    count, ones = len(all_hashes), np.zeros((seeds, 64), np.int64)
    for start in range(0, count, SLICE):
        some = all_hashes[start:start + SLICE]
        for seed in range(seeds):
            own = some if seed == 0 else _mixed(some + SALTS[seed])
            bits = np.unpackbits(own.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            ones[seed] += bits.sum(axis=0, dtype=np.int64)
    return [int.from_bytes(np.packbits(2 * row > count).tobytes(), "big") for row in ones]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(docs: DataFrame, size: int, seeds: int = 1, once: bool = False, counted: bool = False) -> DataFrame:
    """id, text_key, fp, fp1, ... (64 bits each, as longs) of every row; with ``counted`` the number of ``shingles`` too."""
    names = ["fp", *[f"fp{i}" for i in range(1, seeds)], *(["shingles"] if counted else [])]

    def run(batches):
        for batch in batches:
            table = np.zeros((len(names), batch.num_rows), np.int64)
            for row, text in enumerate(batch.column("text")):
                hashes = shingles(text.as_py(), size)
                hashes = np.unique(hashes) if once else hashes
                table[:seeds, row] = np.array(majority(hashes, seeds), np.uint64).view(np.int64)
                table[seeds:, row] = len(hashes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), *map(pa.array, table)], ["id", "text_key", *names])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select(*identity(), F.col("text")).mapInArrow(
        run, f"id {kind}, text_key long, " + ", ".join(f"{n} long" for n in names))


def _block(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))


def shared_bytes(a: Column, b: Column) -> Column:
    """Number of byte positions at which two fingerprints agree."""
    x = a.bitwiseXOR(b)
    return sum((F.when(F.shiftrightunsigned(x, 8 * i).bitwiseAND(F.lit(0xFF)) == 0, 1).otherwise(0)
                for i in range(8)), F.lit(0))


def postings(points: DataFrame) -> DataFrame:
    """The index: (slot, bytes) of every pair of blocks, with the fingerprint."""
    slots = F.array(*[F.struct(F.lit(k).alias("slot"), F.shiftleft(_block(F.col("fp"), i), 16).bitwiseOR(
        _block(F.col("fp"), j)).alias("bytes")) for k, (i, j) in enumerate(BLOCKS)])
    return points.select("fp", F.explode(slots).alias("s")).select("fp", "s.slot", "s.bytes")


def links(points: DataFrame) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs that differ in at most two bits."""
    index = postings(points)
    lists = index.groupBy("slot", "bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = cut(index.join(lists, ["slot", "bytes"]))
    short, key = held.where(F.col("n") <= LIST), ["slot", "bytes"]
    a, b = short.select(*key, F.col("fp").alias("a")), short.select(*key, F.col("fp").alias("b"))
    tallied = a.join(b, key).where(F.col("a") < F.col("b")).where(
        shared_bytes(F.col("a"), F.col("b")) >= LEAST_BYTES)
    pairs = tallied.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE).select("a", "b")
    crowded = held.where(F.col("n") > LIST).select("fp").distinct()
    near = F.explode(F.concat(F.array("fp"), F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))))
    named = crowded.select("fp", near.alias("point"))
    first = named.groupBy("point").agg(F.min("fp").alias("a"), F.max("fp").alias("top")).where("a < top")
    stars = named.join(first.select("point", "a"), "point").where("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def components(docs: DataFrame, size: int) -> DataFrame:
    """id, text_key, fp, component_id of every row; component_id is the smallest id of its component."""
    found = cut(fingerprints(docs, size))
    points = cut(found.groupBy("fp").agg(F.min("id").alias("least")))
    labels = component_labels(links(points.select("fp"))).withColumnRenamed("node", "fp")
    labelled = points.join(labels, "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    names = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    return found.join(labelled.select("fp", "label").join(names, "label").select("fp", "component_id"), "fp").select(
        "id", "text_key", "fp", "component_id")


def _triples() -> np.ndarray:
    """``KEYS`` triples of the positional bytes of all fingerprints, the same in every run; bytes occur equally often."""
    rng, each = np.random.default_rng(9), 8 * SEEDS // 3
    drawn = [rng.permutation(8 * SEEDS)[:3 * each].reshape(each, 3) for _ in range(-(-KEYS // each))]
    return np.concatenate(drawn)[:KEYS].astype(np.int64)


def _bytes(batch: pa.RecordBatch) -> np.ndarray:
    """The positional bytes of all fingerprints, one row each."""
    table = np.stack([batch.column(n).to_numpy() for n in NAMES], axis=1)
    return np.ascontiguousarray(table).view(np.uint8).reshape(len(table), 8 * SEEDS).astype(np.int64)


def _index(points: DataFrame, slots: range, asked=None) -> DataFrame:
    """node, key of every point and each of these triples; ``asked`` is a filter of the keys that are wanted."""
    triples = _triples()[slots.start:slots.stop]

    def run(batches):
        for batch in batches:
            own = _bytes(batch)
            keys = own[:, triples[:, 0]] << 16 | own[:, triples[:, 1]] << 8 | own[:, triples[:, 2]]
            keys = (keys | np.arange(slots.start, slots.stop)[None, :] << 24).ravel()
            node = np.repeat(batch.column("node").to_numpy(), len(triples))
            if asked is not None:
                wanted = may_hold(asked.value, _mixed(keys.astype(np.uint64)))
                node, keys = node[wanted], keys[wanted]
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(keys)], ["node", "key"])

    return points.select("node", *NAMES).mapInArrow(run, "node long, key long")


def _divided(points: DataFrame, members: DataFrame, level: int) -> DataFrame:
    """The members of lists, once for each of ``FURTHER`` bytes outside the list's triple; ``key`` becomes that of the part.

    Each level draws other bytes for a list.
    """
    triples = _triples()

    def run(batches):
        for batch in batches:
            own, key, slot = _bytes(batch), batch.column("key").to_numpy(), batch.column("slot").to_numpy()
            node, label, slot_out = (np.repeat(batch.column(c).to_numpy(), FURTHER) for c in ("node", "label", "slot"))
            order = {k: np.random.default_rng([9, k]).permutation(np.setdiff1d(np.arange(8 * SEEDS), triples[k])) for k in np.unique(slot)}
            places = np.array([order[k][level * FURTHER:(level + 1) * FURTHER] for k in slot], np.int64).reshape(len(slot), FURTHER)
            part = _mixed(_mixed(key.astype(np.uint64))[:, None] ^ (places << 8 | np.take_along_axis(own, places, 1)).astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.ravel().view(np.int64)), pa.array(slot_out), pa.array(node), pa.array(label)], ["key", "slot", "node", "label"])

    return members.join(points.select("node", *NAMES), "node").select("key", "slot", "node", "label", *NAMES).mapInArrow(
        run, "key long, slot long, node long, label long")


def _across(points: DataFrame, members: DataFrame, level: int = 0) -> DataFrame:
    """All pairs (a, b) of a list's members (key, node, label; ``slot``, the triple, too beyond level 0) whose labels differ.

    A list with more than ``LIST`` members outside its largest component is divided first, ``LEVELS`` times if it has
    to be; members that share all those bytes too are paired whatever their number.
    """
    each = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
    tops = cut(each.groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("top"),
                                       (F.sum("c") - F.max("c")).alias("outside")).where("outside > 0"))
    held = cut(members.join(tops, "key"))
    short = held.where(F.col("outside") <= LIST) if level < LEVELS else held
    outside = short.where("label <> top").select("key", F.col("node").alias("b"), F.col("label").alias("other"))
    pairs = short.join(outside, "key").where("label <> other AND (label = top OR node < b)").select(
        F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    slot = F.col("slot") if level else F.shiftright("key", 24).alias("slot")
    long = held.where(F.col("outside") > LIST).select("key", slot, "node", "label")
    if level == LEVELS or long.isEmpty():
        return pairs
    return pairs.unionByName(_across(points, cut(_divided(points, long, level)), level + 1)).distinct()


def _near(points: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that pass the tally of shared positional bytes and the bits, and whether they are ``sure``."""
    side = lambda c: points.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_shingles"), *[
        F.col(n).alias(f"{c}_{n}") for n in NAMES])
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    tally = sum((shared_bytes(F.col(f"a_{n}"), F.col(f"b_{n}")) for n in NAMES), F.lit(0))
    differing = sum((F.bit_count(F.col(f"a_{n}").bitwiseXOR(F.col(f"b_{n}"))) for n in NAMES), F.lit(0))
    sure = (differing <= int(SURE_BITS * 64 * SEEDS)) & (F.least("a_shingles", "b_shingles") >= SURE_SHINGLES)
    return both.where((tally >= SHARED) & (differing <= int(BITS * 64 * SEEDS))).select("a", "b", sure.alias("sure"))


def _sets(docs: DataFrame, points: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """node, own: the shingle sets of these nodes' documents, as sorted 32-bit hashes."""

    def sets_of(batches):
        for batch in batches:
            sets = [np.unique(shingles(t.as_py(), size).astype(np.uint32)).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "own"])

    nodes = nodes.join(points.select("node", "text_key"), "node")
    texts = docs.select(F.xxhash64("text").alias("text_key"), "text").join(nodes, "text_key").mapInArrow(
        sets_of, "node long, own binary")
    return cut(texts.groupBy("node").agg(F.first("own").alias("own")))


def first_shingles(own: np.ndarray, refs: list[np.ndarray], bands: list[tuple[int, int, int, int]], similarity: float) -> np.ndarray:
    """Keys of a set: its band, the other set's band and a shingle, for all shingles that may be the first in common.

    Shingles of few of the ``refs`` come first. ``bands``: number, least and largest size of the sets there are, and how many.
    Sets of n and m members that are similar enough share s / (1 + s) * (n + m), so the first they share is not among the
    last of both. A band of few sets is looked up whole, without a shingle.
    """
    count, band = len(own), _band(len(own))
    order = np.lexsort((own, sum((np.isin(own, r, assume_unique=True).astype(np.int8) for r in refs), np.zeros(count, np.int8))))
    here = next(held for number, _, _, held in bands if number == band)
    keys = [np.empty(0, np.int64)]
    for other, least, most, held in bands:
        if similarity * count <= most and similarity * least <= count:
            common = math.ceil(similarity / (1 + similarity) * (count + max(least, similarity * count)) - 1e-6)
            first = np.zeros(1, np.int64) if min(here, held) <= CROWD else own[order[:max(0, count - common + 1)]].astype(np.int64)
            keys.append(band << 43 | other << 32 | first)
    return np.concatenate(keys)


def _mirrored(key: Column) -> Column:
    """The key under which the sets of the other band are found."""
    band = lambda shift: F.shiftright(key, shift).bitwiseAND(F.lit(0x7FF))
    return F.shiftleft(band(32), 43).bitwiseOR(F.shiftleft(band(43), 32)).bitwiseOR(key.bitwiseAND(F.lit(0xFFFFFFFF)))


def parities(own: np.ndarray) -> np.ndarray:
    """512 bits, each the parity of the shingles dealt to it: two sets differ by at least as many shingles as bits."""
    bits = np.bincount((_mixed(own.astype(np.uint64)) & np.uint64(511)).astype(np.int64), minlength=512) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _band(size: int) -> int:
    return int(math.log(max(size, 1)) / math.log(BAND))


def _families(docs: DataFrame, points: DataFrame, family: DataFrame, size: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Links to a family's references, and pairs (a, b) of a family's members, whose labels differ, that may be similar.

    ``family``: top, the label the family is named by, and node, label of its members. No similar pair is left out.
    """

    def sized(batches):
        for batch in batches:
            sizes = [len(o.as_py()) // 4 for o in batch.column("own")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array(map(_band, sizes), pa.int64())],
                                             [*batch.schema.names, "size", "band"])

    def described(batches):
        for batch in batches:
            links, keys, bits = [], [], np.empty((batch.num_rows, len(PARITIES)), np.int64)
            for row, (own, refs, bands) in enumerate(zip(*(batch.column(c) for c in ("own", "refs", "bands")))):
                own, refs = np.frombuffer(own.as_py(), np.uint32), refs.as_py() or []
                sets = [np.frombuffer(r["own"], np.uint32) for r in refs]
                common = [len(np.intersect1d(own, r, assume_unique=True)) for r in sets]
                links.append(next((r["node"] for r, s, c in zip(refs, sets, common) if c >= similarity * (len(own) + len(s) - c)), None))
                keys.append(first_shingles(own, sets, [tuple(b.values()) for b in bands.as_py()], similarity))
                bits[row] = parities(own)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("top", "node", "label", "size")), pa.array(links, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), *map(pa.array, bits.T.copy())], ["top", "node", "label", "size", "ref", "keys", *PARITIES])

    sets = _sets(docs, points, family.select("node").distinct(), size).mapInArrow(
        sized, "node long, own binary, size long, band long")
    rows = cut(family.join(sets, "node"))
    some = rows.where((F.col("label") == F.col("top")) & (F.col("size") <= REF_SIZE)).groupBy("top", F.pmod(F.xxhash64("node"), F.lit(REFS)).alias("part")).agg(
        F.min(F.struct("node", "own")).alias("r"))
    refs = some.groupBy("top").agg(F.collect_list("r").alias("refs"))
    bands = rows.groupBy("top", "band").agg(F.min("size").alias("least"), F.max("size").alias("most"), F.count(F.lit(1)).alias("held")).groupBy(
        "top").agg(F.collect_list(F.struct("band", "least", "most", "held")).alias("bands"))
    found = cut(rows.join(bands.join(refs, "top", "left"), "top").select("top", "node", "label", "size", "own", "refs", "bands").mapInArrow(
        described, "top long, node long, label long, size long, ref long, keys array<long>, " + ", ".join(f"{n} long" for n in PARITIES)))
    links = found.where("label <> top AND ref IS NOT NULL").select(F.col("ref").alias("a"), F.col("node").alias("b"))
    label = F.when(F.col("ref").isNotNull(), F.col("top")).otherwise(F.col("label")).alias("label")
    asked = cut(found.select("top", F.explode("keys").alias("key"), "node", label, "size", *PARITIES))
    outside = asked.where("label <> top").select("top", _mirrored(F.col("key")).alias("key"), F.col("node").alias("b"), F.col("label").alias("other"), F.col(
        "size").alias("b_size"), *[F.col(n).alias(f"b_{n}") for n in PARITIES])
    differing = sum((F.bit_count(F.col(n).bitwiseXOR(F.col(f"b_{n}"))) for n in PARITIES), F.lit(0))
    allowed = (F.col("size") + F.col("b_size")) * F.lit((1 - similarity) / (1 + similarity)) + F.lit(1e-6)
    pairs = asked.join(outside, ["top", "key"]).where("label <> other AND (label = top OR node < b)").where(differing <= allowed).select(
        F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    return links, pairs


def _alike(docs: DataFrame, points: DataFrame, pairs: DataFrame, size: int, similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes whose documents' shingle sets have at least that Jaccard similarity."""

    def compare(batches):
        for batch in batches:
            alike = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_py(), np.uint32) for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                alike.append(common >= similarity * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    sets = _sets(docs, points, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), size)
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("own").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("own").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def _links(docs: DataFrame, points: DataFrame, pairs: DataFrame, known: DataFrame, size: int, similarity: float) -> DataFrame:
    """Edges whose components are those of the ``known`` links and of those among candidate pairs.

    Only pairs that join two components are compared by their sets. Found components come back as stars, so that later
    calls contract few edges in few rounds.
    """
    near = cut(_near(points, pairs))
    label = component_labels(known.unionByName(near.where("sure").select("a", "b")))
    side = lambda c: label.select(F.col("node").alias(c), F.col("label").alias(f"of_{c}"))
    open_pairs = cut(near.where("NOT sure").join(side("a"), "a", "left").join(side("b"), "b", "left").where(
        F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b"))
    stars = label.where("node <> label").select(F.col("label").alias("a"), F.col("node").alias("b"))
    return cut(stars.unionByName(_alike(docs, points, open_pairs, size, similarity)))


def similar(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """id, text_key, fp, component_id of every row, by links between similar documents.

    Equal ids of different texts are different documents, each with its own component; texts of any length count whole.
    """
    found = cut(fingerprints(docs, size, SEEDS, once=True, counted=True))
    if "shingles" not in found.columns:  # fingerprints that come without the count leave every pair to the sets
        found = found.withColumn("shingles", F.lit(0))
    points = cut(found.groupBy(*NAMES).agg(F.min("id").alias("least"), F.min(F.struct("text_key", "shingles")).alias("t")).select(
        *NAMES, "least", "t.*").withColumn("node", F.monotonically_increasing_id()))
    pairs, longer = [], []
    for k in range(ROUNDS):
        lists = cut(_index(points, range(k * KEYS // ROUNDS, (k + 1) * KEYS // ROUNDS)).groupBy("key").agg(
            F.count(F.lit(1)).alias("n"), F.min("node").alias("a"), F.max("node").alias("b")).where("n > 1"))
        pairs.append(lists.select("a", "b"))
        longer.append(lists.where("n > 2").select("key"))
    none = points.sparkSession.createDataFrame([], "a long, b long")
    links = _links(docs, points, cut(reduce(DataFrame.unionByName, pairs).distinct()), none, size, similarity)
    keys = reduce(DataFrame.unionByName, longer)
    label = component_labels(links)
    asked = docs.sparkSession.sparkContext.broadcast(bloom(_hashed(keys)))
    members = cut(_index(points, range(KEYS), asked).join(keys, "key").join(label, "node", "left").select(
        "key", "node", F.coalesce("label", "node").alias("label")))
    lists = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("key").agg(
        F.max_by("label", F.struct("c", "label")).alias("top"), F.sum("c").alias("n"), F.max("c").alias("most")).where("most < n")
    held = cut(members.join(lists.select("key", "top", "n"), "key"))
    pairs = _across(points, held.where(F.col("n") <= CROWD).select("key", "node", "label"))
    family = cut(held.where(F.col("n") > CROWD).select("top", "node", "label").distinct())
    if not family.isEmpty():
        near, more = _families(docs, points, family, size, similarity)
        links, pairs = links.unionByName(near), pairs.unionByName(more).distinct()
    links = _links(docs, points, cut(pairs), links, size, similarity)
    labelled = points.join(component_labels(links), "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    return found.join(labelled.join(least, "label").select(*NAMES, "component_id"), NAMES).select(
        "id", "text_key", "fp", "component_id")


def _hashed(keys: DataFrame) -> DataFrame:
    """Hashes ``h`` of keys, as the filter takes them."""

    def run(batches):
        for batch in batches:
            h = _mixed(batch.column("key").to_numpy().astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h)], ["h"])

    return keys.mapInArrow(run, "h long")


def survivors(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each component of similar documents the one with the smallest id."""
    same = similar(docs).where(F.col("id").eqNullSafe(F.col("component_id")))
    kept = same.groupBy("id", "text_key", "fp").agg(F.count(F.lit(1)).alias("copies"))
    by_id, by_text = kept.where("id IS NOT NULL").groupBy("id"), kept.where("id IS NULL").groupBy("id", "fp")
    best = F.min(F.struct("text_key", "copies")).alias("k")
    return only(docs, by_id.agg(best).unionByName(by_text.agg(best).drop("fp")).select("id", "k.text_key", "k.copies"))
