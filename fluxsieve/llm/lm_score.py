"""Cross-entropy difference of two n-gram models (operator 10).

The target model counts the texts labelled good, the background model counts all texts. Both hold every word and every
pair of neighbouring words of the whole corpus, which is their one shared vocabulary; nothing is cut off, so the models
grow with the input. The loss of a token is the mean of its loss under the unigram and under the bigram estimate, each
with added counts over the shared vocabulary of its order. A document's score is the mean over its tokens of target
loss minus background loss, in nats: the lower, the more it looks like the target.

A task gathers documents into blocks of ``BLOCK`` tokens and counts each n-gram once per document there. n-grams are
64-bit hashes; the top bits deal a block's sorted hashes into buckets, and a bucket's pieces of all blocks meet in one
task, which knows every count of its n-grams then and adds up what they cost, per block and document. A frequent n-gram is
one entry per block in its bucket, so no bucket is much larger than another, and their number grows with the corpus. The
sums go back to their blocks. Texts are read once, and nothing of the models passes through the driver but five totals.

Defined results: texts without a token (null, empty, blank) have score 0 and n_tokens 0; labels repeated for one
id count as good if any is; without labels the target model is flat; ids that are null are scored and counted in the
background; rows repeated count each.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from fluxsieve.llm.common import identity, stored

#: Tokens after which a block ends, characters of text for each bucket, and good ids that may be broadcast.
BLOCK, BUCKET, BROADCAST = 1 << 20, 1 << 25, 1_000_000
#: What is added to each count of a word and of a pair.
ADDED = (1.0, 0.1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngrams(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the unigrams and of the bigrams that end at each token; a text starts after the hash 0.

    The lowest bit tells the orders apart.
    """
    before = np.concatenate([np.zeros(1, np.uint64), words[:-1]]) if len(words) else words
    return words & ~np.uint64(1), _mixed(before * _MIX + words) | np.uint64(1)


def _entries(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, how many owners each has, and those owners with their counts; owners come in order."""
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    new_key = np.concatenate([[True], keys[1:] != keys[:-1]])
    starts = np.flatnonzero(new_key | np.concatenate([[True], owner[1:] != owner[:-1]]))
    n = np.diff(np.concatenate([starts, [len(keys)]]))
    first = np.flatnonzero(new_key[starts])
    return keys[starts][first], np.diff(np.concatenate([first, [len(starts)]])), owner[starts], n


def _small(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest takes."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _numbers(data, count: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // count}").astype(np.int32)


_PIECE = ("bucket long, block long, keys binary, owners binary, owner binary, n binary, good binary, "
          "ids array<{kind}>, text_keys array<long>, tokens array<long>")


def pieces(docs: DataFrame, bits: int, size: int = BLOCK) -> DataFrame:
    """For each block a row per bucket with its n-grams, and one (a negative bucket of its own) with its documents.

    ``docs``: id, text_key, text, good.
    """

    def run(batches):
        import xxhash

        number, held, words = 0, [], []
        digest = partial(xxhash.xxh3_64_intdigest, seed=10)

        def block():
            name = TaskContext.get().partitionId() << 32 | number
            ids, text_keys, good = zip(*held)
            lengths = np.array(list(map(len, words)), np.int64)
            both = [ngrams(w) for w in words]
            owner = np.tile(np.repeat(np.arange(len(words), dtype=np.int32), lengths), 2)
            flags = np.packbits(np.array(good, bool)).tobytes()
            empty = lambda kind: pa.array([None], kind)
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            binary = lambda value: pa.array([value], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1 - name]), pa.array([name]), *[empty(pa.binary())] * 4, binary(flags), one(pa.array(ids, id_type)),
                 one(pa.array(text_keys, pa.int64())), one(pa.array(lengths))], names)
            if not lengths.sum():
                return
            keys, owners, owner, n = _entries(np.concatenate([b[k] for k in (0, 1) for b in both]), owner)
            ends = np.concatenate([[0], np.cumsum(owners)])
            cut = np.searchsorted(keys >> np.uint64(64 - bits) if bits else keys * np.uint64(0), np.arange((1 << bits) + 1, dtype=np.uint64))
            for bucket, (a, b) in enumerate(zip(cut, cut[1:])):
                if a < b:
                    p, q = ends[a], ends[b]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([bucket]), pa.array([name]), binary(keys[a:b].tobytes()), binary(_small(owners[a:b])),
                         binary(_small(owner[p:q])), binary(_small(n[p:q])), binary(flags),
                         *[empty(pa.list_(t)) for t in (id_type, pa.int64(), pa.int64())]], names)

        names = ["bucket", "block", "keys", "owners", "owner", "n", "good", "ids", "text_keys", "tokens"]
        total, id_type = 0, pa.int64()
        for batch in batches:
            id_type = batch.column("id").type
            for row, text in zip(zip(*(batch.column(c).to_pylist() for c in ("id", "text_key", "good"))), batch.column("text")):
                own = tokens(text.as_py())
                words.append(np.fromiter(map(digest, own), np.uint64, len(own)))
                held.append(row)
                total += len(own)
                if total >= size:
                    yield from block()
                    number, total = number + 1, 0
                    held.clear()
                    words.clear()
        if held:
            yield from block()

    kind = dict(docs.dtypes)["id"]
    return docs.mapInArrow(run, _PIECE.format(kind=kind))


_SUMS = ("block long, background binary, target binary, distinct array<long>, tokens array<long>, "
         "ids array<{kind}>, text_keys array<long>, good binary")


def sums(found: DataFrame, kind: str) -> DataFrame:
    """A row per bucket and block: each document's sum of log counts under both models; documents pass through."""
    schema = _SUMS.format(kind=kind)

    def run(table: pa.Table) -> pa.Table:
        same = [table.schema.field(c).type for c in ("tokens", "ids", "text_keys")]
        out_schema = pa.schema(list(zip(["block", "background", "target", "distinct", "tokens", "ids", "text_keys", "good"], [
            pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), *same, pa.binary()])))
        count = table.num_rows
        if table["bucket"][0].as_py() < 0:
            empty = [pa.nulls(count, t) for t in (pa.binary(), pa.binary(), pa.list_(pa.int64()))]
            return pa.table([table["block"], *empty, *[table[c] for c in ("tokens", "ids", "text_keys", "good")]], schema=out_schema)
        held = lambda c, i: table[c][i].as_buffer()
        keys = [np.frombuffer(held("keys", i), np.uint64) for i in range(count)]

        def entries(i):
            """Owners of each key, and the documents and counts of all of them, of one block."""
            owners = _numbers(held("owners", i), len(keys[i]))
            size = int(owners.sum())
            return owners, _numbers(held("owner", i), size), _numbers(held("n", i), size)

        totals = [[], []]
        for i in range(count):
            owners, owner, n = entries(i)
            starts = np.cumsum(owners) - owners
            good = np.unpackbits(np.frombuffer(held("good", i), np.uint8))[owner]
            totals[0].append(np.add.reduceat(n, starts))
            totals[1].append(np.add.reduceat(n * good, starts))
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        at = at.astype(np.int32)
        order = (distinct & np.uint64(1)).astype(np.int8)
        sizes = [[int((order == 0).sum()), int((order == 1).sum())]] + [[0, 0]] * (count - 1)  # once for the bucket
        added = np.array(ADDED)[order]
        del distinct, order
        logs = [np.log(np.bincount(at, np.concatenate(t), len(added)) + added) for t in totals]
        del totals, added
        out, a = [], 0
        for i in range(count):
            owners, owner, n = entries(i)
            own = np.repeat(at[a:a + len(owners)], owners)
            a += len(owners)
            out.append([np.bincount(owner, n * log[own]).tobytes() for log in logs])
        nothing = [pa.nulls(count, t) for t in (*same, pa.binary())]
        return pa.table([table["block"], pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.binary()),
                         pa.array(sizes, pa.list_(pa.int64())), *nothing], schema=out_schema)

    return found.groupBy("bucket").applyInArrow(run, schema)


def scores(docs: DataFrame, labels: DataFrame, size: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """id, text_key, n_tokens, target_loss, background_loss, score of every row.

    ``labels``: doc_id, quality; quality 1 marks the target.
    """
    kind = dict(docs.dtypes)["doc_id"]
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("id")).distinct().withColumn("is", F.lit(True))
    few = good.limit(BROADCAST + 1).count() <= BROADCAST  # beyond that Spark joins by shuffling
    rows = docs.select(*identity(), F.col("text")).join(F.broadcast(good) if few else good, "id", "left").select(
        "id", "text_key", "text", F.coalesce("is", F.lit(False)).alias("good"))
    chars = docs.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    bits = max(0, (-(-chars // bucket) - 1).bit_length()) if chars else 0
    found = stored(sums(pieces(rows, bits, size), kind), "lm-sums")
    totals = found.select(F.col("distinct")).where("distinct IS NOT NULL").agg(
        F.sum(F.col("distinct")[0]), F.sum(F.col("distinct")[1])).first()
    counted = _token_totals(found)
    vocabulary = [totals[0] or 0, totals[1] or 0]
    level = [sum(np.log(max(n, 0) + a * v) / 2 if n + a * v > 0 else 0.0 for a, v in zip(ADDED, vocabulary)) for n in counted]
    names = ["id", "text_key", "n_tokens", "target_loss", "background_loss"]

    def final(table: pa.Table) -> pa.Table:
        head = table.filter(pc.is_valid(table["ids"]))
        n = head["tokens"][0].values.to_numpy()
        out = []
        for column, at in (("target", level[1]), ("background", level[0])):
            total = np.zeros(len(n))
            for value in table[column]:
                if value.is_valid:
                    part = np.frombuffer(value.as_py())
                    total[:len(part)] += part
            out.append(np.where(n > 0, at - total / (2 * np.maximum(n, 1)), 0.0))
        return pa.table([head["ids"][0].values, head["text_keys"][0].values, n, *out], names=names)

    schema = f"id {kind}, text_key long, n_tokens long, target_loss double, background_loss double"
    return found.groupBy("block").applyInArrow(final, schema).withColumn("score", F.col("target_loss") - F.col("background_loss"))


def _token_totals(found: DataFrame) -> tuple[int, int]:
    """Tokens of all documents and of the good ones."""

    def run(batches):
        for batch in batches:
            for good, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                flags = np.unpackbits(np.frombuffer(good, np.uint8))[:len(n)]
                yield pa.RecordBatch.from_arrays([pa.array([sum(n)], pa.int64()), pa.array([int(np.dot(flags, n))], pa.int64())], ["n", "g"])

    row = found.where("ids IS NOT NULL").select("good", "tokens").mapInArrow(run, "n long, g long").agg(F.sum("n"), F.sum("g")).first()
    return row[0] or 0, row[1] or 0
