"""CSV scans that split files whose cells hold line breaks, with differing headers in one scan.

A line break inside quotes does not end a record, so where a record ends depends on every quote before it. Only the
parity of their number matters: each split of a file counts the quotes of its own lines, a running sum over the splits
gives the parity at every split's start, and from there each task knows for its own lines which of them begin a record.
Lines that go on are joined where they stand. Only the pieces of records that lie across a split's edge are shuffled, two
for each split at most. So a file of any size is read by many tasks, whatever its cells hold.

Besides the file listing a scan has anyway, the driver holds one number per split.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fluxsieve.operators.validation import Refused
from fluxsieve.session import cut

QUOTE = '"'
#: Reader options under which a cell is the text that was written: doubled quotes, no nulls but missing cells.
CELLS = {"escape": QUOTE, "nullValue": "\x00", "emptyValue": "", "multiLine": "true", "mode": "PERMISSIVE"}
MARK = "﻿"


def text_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, block (start of the split), value of every physical line, in file order within a split."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def quotes_in(value: Column) -> Column:
    """Number of quotes in a text."""
    return F.length(value) - F.length(F.replace(value, F.lit(QUOTE), F.lit("")))


def block_parity(lines: DataFrame) -> DataFrame:
    """file, block, parity (of all quotes of the file before the split), after (parity at its end): one row for each split."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counted = lines.groupBy("file", "block").agg(F.sum(quotes_in(F.col("value"))).alias("quotes"))
    sums = counted.withColumn("_before", F.coalesce(F.sum("quotes").over(before), F.lit(0)))
    return sums.select("file", "block", (F.col("_before") % 2).cast("int").alias("parity"),
                       ((F.col("_before") + F.col("quotes")) % 2).cast("int").alias("after"))


def split_parities(lines: DataFrame) -> tuple[dict[tuple[str, int], int], bool]:
    """Parity at the start of each (file, block), and whether any split ends inside a record."""
    rows = list(block_parity(lines).toLocalIterator())
    return {(r["file"], r["block"]): r["parity"] for r in rows}, any(r["after"] for r in rows)


def records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, block, place, record: every record of every file as text, line breaks in cells kept.

    (block, place) orders the records of a file. Lines that are empty outside quotes are no records.
    """
    lines = text_lines(spark, paths)
    return records_of(lines, *split_parities(lines))


def records_of(lines: DataFrame, at_start: dict[tuple[str, int], int], torn: bool, first: int | None = None) -> DataFrame:
    """The records of ``lines``; unless any is ``torn`` by a split's edge, one pass over them is enough.

    ``first``: only so many records from each split's beginning, and none that the split's end cuts.
    """
    known = lines.sparkSession.sparkContext.broadcast(at_start)

    def run(batches):
        # split, open quote, lines of the record, begun here, number, records that count
        here, odd, held, whole, place, met = None, 0, [], True, 0, 0
        out = []

        def flush(ends: bool):
            nonlocal held, place, met
            if held:
                record = "\n".join(held)
                out.append((*here, place, record, whole, ends))
                held, place, met = [], place + 1, met + (record.removesuffix("\r") != "")

        for batch in batches:
            for file, block, value in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value"))):
                if (file, block) != here:
                    if here:
                        flush(not odd)
                    here, place, met = (file, block), 0, 0
                    odd = known.value[here]
                    whole = not odd
                if met == first:
                    continue
                held.append(value)
                if value.count(QUOTE) % 2:
                    odd = 1 - odd
                if not odd:
                    flush(True)
                    whole = True
            if len(out) >= 4096:
                yield batch_of(out)
                out.clear()
        if here:
            flush(not odd)
        yield batch_of(out)

    def batch_of(rows):
        columns = list(zip(*rows)) or [()] * 6
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          ["file", "block", "place", "record", "begins", "ends"])

    pieces = lines.mapInArrow(run, "file string, block long, place long, record string, begins boolean, ends boolean")
    inside = pieces.where("begins AND ends").select("file", "block", "place", "record")
    if first is not None or not torn:
        return _bare(inside)
    # the pieces of one record: a beginning and all that follow up to the next beginning
    order = Window.partitionBy("file").orderBy("block", "place")
    edge = pieces.where("NOT (begins AND ends)").withColumn("n", F.sum(F.col("begins").cast("int")).over(order))
    across = edge.groupBy("file", "n").agg(
        F.min(F.struct("block", "place")).alias("at"),
        F.array_sort(F.collect_list(F.struct("block", "place", "record"))).alias("parts"))
    joined = across.select("file", "at.block", "at.place", F.array_join(
        F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    return _bare(inside.unionByName(joined))


def _bare(found: DataFrame) -> DataFrame:
    """Records without the carriage return at their end; empty ones are left out."""
    return found.withColumn("record", F.regexp_replace("record", "\r$", "")).where(F.col("record") != "")


def headers(found: DataFrame, skip: int = 0) -> DataFrame:
    """file, record of each file's header: its record number ``skip``."""
    first = Window.partitionBy("file").orderBy("block", "place")
    top = found.where("block = 0").withColumn("n", F.row_number().over(first)).where(F.col("n") <= skip + 1)
    return top.where(F.col("n") == skip + 1).select("file", "block", "place", "record")


def cells(record: str, width: int, exactly: str | None = None) -> Column:
    """Array of the cells of a record, ``width`` of them; blank and missing ones are null.

    ``exactly``: what to say when a record has more or fewer cells; it is refused then.
    """
    schema = ", ".join(f"c{i} string" for i in range(width)) + ", _torn string"
    parsed = F.from_csv(F.col(record), F.lit(schema), {**CELLS, "columnNameOfCorruptRecord": "_torn"})
    out = F.array(*[parsed[f"c{i}"] for i in range(width)])
    if exactly is None:
        return out
    return F.when(parsed["_torn"].isNull(), out).otherwise(F.raise_error(F.concat(
        F.lit(f"{exactly}: a row has not {width} cells: "), F.substring(record, 1, 80))))


def header_names(found: DataFrame, width: int) -> DataFrame:
    """file, block, place, names: trimmed header cells without a byte-order mark."""
    plain = F.transform(cells("record", width), lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), MARK, "")))
    return found.select("file", "block", "place", plain.alias("names"))


def read_split(spark: SparkSession, paths: str | list[str], columns, what: str, *, others: bool = False, exactly: bool = False,
               skip: int = 0) -> DataFrame:
    """Named columns of CSV files as text in one scan; each file's own header says where they are.

    ``_file`` is a row's path and ``_at`` its place in the file.

    ``others``: all other columns too, null where a file has none. ``exactly``: the header holds these columns and no others, and
    each row as many cells; otherwise rows are cut or filled. ``skip`` records stand before the header. A file whose
    header lacks a column or holds one twice is refused. Cells are empty text where blank, as they were otherwise.
    """
    lines = text_lines(spark, paths)
    at_start, torn = split_parities(lines)
    found = records_of(lines, at_start, torn)
    # headers stand in the first splits; only where one of them goes on beyond its split are all records looked through
    head = cut(headers(records_of(lines.where("block = 0"), at_start, torn, skip + 1), skip))
    if head.count() < len({file for file, _ in at_start}):
        head = cut(headers(found, skip))
    widest = head.agg(F.max(F.length("record") - F.length(F.replace("record", F.lit(","), F.lit(""))) + 1)).first()[0]
    if widest is None:
        raise Refused(f"{what} has no header line")
    named = header_names(head, widest)
    wanted = list(columns)
    if others:  # as many names as headers have cells
        wanted += sorted({r["name"] for r in named.select(F.explode("names").alias("name")).distinct().collect()} - {*columns, ""})
    place = lambda c: F.array_position("names", c)
    held = F.array_remove("names", "")
    known = F.array(*map(F.lit, columns))
    faults = {"lacks": F.array_except(known, "names"), "others": F.array_except(held, known)}
    bad = named.select("file", *[v.alias(k) for k, v in faults.items()], (F.size(held) != F.size(F.array_distinct(held))).alias("twice"),
                       F.size(held).alias("cells"))
    blank = F.lit(exactly) & ((F.size("others") > 0) | (F.col("cells") != F.lit(widest)))
    broken = bad.where((F.size("lacks") > 0) | F.col("twice") | blank).first()
    if broken:
        raise Refused(f"{what}: {broken['file']} lacks columns {broken['lacks']}"
                      + (f", holds others {broken['others']}" if exactly else "") + (", holds one twice" if broken["twice"] else ""))
    map_of = named.select("file", F.struct("block", "place").alias("head"), *[
        place(c).cast("int").alias(f"p{i}") for i, c in enumerate(wanted)])
    body = found.join(map_of, "file").where(F.struct("block", "place") > F.col("head")).withColumn(
        "cells", cells("record", widest, what if exactly else None))
    out = [F.coalesce(F.get("cells", F.col(f"p{i}") - 1), F.lit("")).alias(c) if c in columns
           else F.when(F.col(f"p{i}") > 0, F.coalesce(F.get("cells", F.col(f"p{i}") - 1), F.lit(""))).alias(c)
           for i, c in enumerate(wanted)]
    return body.select(*out, F.col("file").alias("_file"), F.struct("block", "place").alias("_at"))
