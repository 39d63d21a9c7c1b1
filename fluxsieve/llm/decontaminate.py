"""Benchmark decontamination by winnowing (operator 8).

A document's words are hashed; of every ``SPAN`` - ``GRAM`` + 1 consecutive hashes of ``GRAM`` words the
smallest is kept (the rightmost of equal ones), so every span of ``SPAN`` words that a document and an item
share puts a common fingerprint into both. Fingerprints join (distinct, on their hash); each hit is extended
to the windows of ``SPAN`` words around it, and these join the distinct windows of the benchmark.

Before anything is shuffled, a Bloom filter of fixed size (``BLOOM_BITS``, whatever the benchmark's size)
removes fingerprints and windows that the benchmark does not have; the joins then decide exactly on 64-bit
hashes. Items shorter than a window are windows themselves, below the length winnowing vouches for: for each
such length (nine at most) every run of that many document words is tested the same way.

Defined results: null text has no words and is never contaminated, and such an item never occurs; items with
one id are one item; an empty benchmark hits nothing; repeated rows are decided each on its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fluxsieve.llm.common import identity, only
from fluxsieve.session import cut

SPAN, GRAM = 10, 5
BLOOM_BITS = 1 << 26
#: Bytes to words: A-Z lower-cased, word bytes kept, all other ASCII bytes blank.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))
_ODD = np.random.default_rng(8).integers(1 << 62, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(text: str | None) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode().translate(_WORD_BYTES).split()
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, with the size in it."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total += words[i:i + n] * _ODD[i]
    return mixed(total)


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """Positions of the rightmost smallest hash of every ``width`` consecutive hashes."""
    if len(grams) < width:
        return np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(grams, width)[:, ::-1]
    return np.unique(np.arange(len(windows)) + width - 1 - windows.argmin(axis=1))


def bloom(hashes: DataFrame) -> np.ndarray:
    """Fixed-size filter over column ``h`` as bytes; Spark gathers the bits in words, at most BLOOM_BITS / 64 rows."""
    bits = hashes.select(F.explode(F.array(
        F.col("h").bitwiseAND(F.lit(BLOOM_BITS - 1)),
        F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(BLOOM_BITS - 1)))).alias("bit"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(F.lit(63)).cast("int"))
    held = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(BLOOM_BITS // 64, "<i8")
    out[held["word"].to_numpy()] = held["bits"].to_numpy()
    return out.view(np.uint8)


def may_hold(filter_bytes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    found, mask = np.ones(len(hashes), bool), np.uint64(BLOOM_BITS - 1)
    for at in (hashes & mask, (hashes >> np.uint64(32)) & mask):
        byte = filter_bytes[(at >> np.uint64(3)).astype(np.int64)]
        found &= (byte >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


ITEM = "item {kind}, size int, h long, grams array<long>"


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item, size, h of every window of every item, and the winnowed fingerprints of the item."""

    def run(batches):
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1)):
                words = word_hashes(text.as_py())
                size = min(SPAN, len(words))
                if not size:
                    continue
                h = np.unique(runs(words, size))
                grams = runs(words, GRAM)
                kept = grams[winnow(grams, SPAN - GRAM + 1)] if size == SPAN else np.zeros(0, np.uint64)
                empty = pa.array([[]] * (len(h) - 1), pa.list_(pa.int64()))
                first = pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), _long(np.sort(kept)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item.as_py()] * len(h), item.type), pa.array([size] * len(h), pa.int32()), _long(h),
                     pa.concat_arrays([first, empty])], ["item", "size", "h", "grams"])

    kind = dict(benchmark.dtypes)["item_id"]
    return cut(benchmark.select("item_id", "text").mapInArrow(run, ITEM.format(kind=kind)))


def candidates(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """id, text_key, n_words and the surviving candidates (start, size, gram, h) of every row.

    gram is the fingerprint that led to the window; it is null for windows of short items.
    """
    grams = windows.select(F.explode("grams").alias("h"))
    context = docs.sparkSession.sparkContext
    filters = context.broadcast((bloom(grams), bloom(windows.select("h"))))
    short = sorted(r["size"] for r in windows.where(F.col("size") < SPAN).select("size").distinct().collect())

    def run(batches):
        gram_filter, window_filter = filters.value
        for batch in batches:
            n_words, rows = [], [[], [], [], [], []]  # row, start, size, gram, h

            def add(row, start, size, gram, h):
                for column, values in zip(rows, (np.full(len(start), row), start, np.full(len(start), size), gram, h)):
                    column.append(values)

            for row, text in enumerate(batch.column("text")):
                words = word_hashes(text.as_py())
                n_words.append(len(words))
                grams = runs(words, GRAM)
                at = winnow(grams, SPAN - GRAM + 1)
                at = at[may_hold(gram_filter, grams[at])]
                if len(at):  # extend each hit to the windows that hold it
                    full = runs(words, SPAN)
                    start = (at[:, None] - np.arange(SPAN - GRAM + 1)[None, :]).ravel()
                    gram = np.repeat(grams[at], SPAN - GRAM + 1)
                    inside = (start >= 0) & (start < len(full))
                    start, gram = start[inside], gram[inside]
                    passed = may_hold(window_filter, full[start])
                    add(row, start[passed], SPAN, gram[passed], full[start[passed]])
                for size in short:
                    all_runs = runs(words, size)
                    start = np.flatnonzero(may_hold(window_filter, all_runs))
                    add(row, start, size, np.zeros(len(start), np.uint64), all_runs[start])
            row, start, size, gram, h = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in rows]
            order = np.argsort(row, kind="stable")
            ends = np.searchsorted(row[order], np.arange(len(n_words) + 1)).astype(np.int32)
            fields = pa.StructArray.from_arrays(
                [pa.array(start[order].astype(np.int32)), pa.array(size[order].astype(np.int32)),
                 _long(gram[order]), _long(h[order])], ["start", "size", "gram", "h"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), pa.array(n_words, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), fields)], ["id", "text_key", "n_words", "found"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select(*identity(), F.col("text")).mapInArrow(
        run, f"id {kind}, text_key long, n_words long, found array<struct<start:int,size:int,gram:long,h:long>>")


def decisions(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """id, text_key, n_words, n_hit, items (sorted as strings) of every row of ``docs``."""
    windows = item_windows(benchmark)
    rows = cut(candidates(docs, windows).withColumn("row", F.monotonically_increasing_id()))
    some = rows.where(F.size("found") > 0).select("row", F.explode("found").alias("f")).select("row", "f.*")
    grams = windows.select(F.explode("grams").alias("gram")).distinct()
    led = some.where(F.col("size") == SPAN).join(grams, "gram", "left_semi").select("row", "start", "size", "h")
    short = some.where(F.col("size") < SPAN).select("row", "start", "size", "h")
    hits = cut(led.unionByName(short).distinct().join(windows.select("size", "h").distinct(), ["size", "h"], "left_semi"))
    before = Window.partitionBy("row").orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    fresh = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0))))
    n_hit = hits.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    items = hits.select("row", "size", "h").distinct().join(
        windows.select("size", "h", F.col("item").cast("string").alias("item")), ["size", "h"]).groupBy("row").agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    none = F.array().cast("array<string>")
    return rows.select("row", "id", "text_key", "n_words").join(n_hit, "row", "left").join(items, "row", "left").select(
        "id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any window of the benchmark."""
    kept = decisions(docs, benchmark).where("n_hit = 0").groupBy("id", "text_key").agg(
        F.count(F.lit(1)).alias("copies"))
    return only(docs, kept)
