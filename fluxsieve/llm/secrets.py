"""Secret scan: fixed patterns, and character Markov models compared by log-likelihood ratio (operator 5).

All of it is DataFrame expressions. Pattern matches get code-point positions from the lengths of the pieces
between them. Runs of identifier characters that overlap a pattern's match are labelled random strings, all
other runs ordinary identifiers; the two first-order character models are trained on every run of the table.
A run that no pattern found is added as ``markov`` if its log-likelihood ratio per transition reaches
``LEAST_RATIO``. Ratios are whole thousandths, so sums do not depend on the order of rows.

The model is a table of (alphabet size) squared numbers whatever the input's size, so it travels as a constant.

Work grows with a text's length: runs are cut into characters once, and positions come from sums by chunks.

Defined results: null text counts as empty and has no spans; without labelled random strings every ratio is
zero and no span is added; rows repeated each get their own result; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from fluxsieve.llm.common import identity, stored

# Fixed values of the contract: kinds in order, their patterns, and the least length of what must be that long.
KINDS = ("assign", "access", "hex")
_KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = ("(" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in _KEYWORDS)
          + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
PATTERNS = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]{32,}"}
LEAST = {"assign": 8, "access": 16, "hex": 32}

#: Runs the models judge, and their characters.
RUN = "[A-Za-z0-9+/_-]{16,}"
CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
LEAST_RATIO = 500
#: Elements whose lengths are added up together on the way to positions.
CHUNK = 256
_SIZE = len(CHARACTERS)


def matches(text: Column, pattern: str, value: int = 0) -> Column:
    """Struct of the pieces between the matches of a pattern, the matches, and the lengths of one group."""
    none = F.array().cast("array<string>")
    has = text.rlike(pattern)
    found = lambda group: F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(none)
    return F.struct(F.when(has, F.split(text, pattern, -1)).otherwise(none).alias("between"),
                    found(0).alias("whole"), found(value).alias("value"))


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def running(lengths: Column) -> Column:
    """Sum of all earlier elements, for each element of an array: sums of whole chunks first, then within a chunk."""
    total = lambda some: F.aggregate(some, F.lit(0), lambda a, b: a + b)
    whole = lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / CHUNK).cast("int")),
                                  lambda c: total(F.slice(x, c * CHUNK + 1, CHUNK)))
    before = lambda sums: F.transform(F.sequence(F.lit(0), F.size(sums) - 1), lambda c: total(F.slice(sums, F.lit(1), c)))

    def within(x, heads):
        return F.transform(x, lambda _, i: F.get(heads, F.floor(i / CHUNK).cast("int"))
                           + total(F.slice(x, i - i % CHUNK + 1, i % CHUNK)))

    return let(lengths, lambda x: let(let(whole(x), before), lambda heads: within(x, heads)))


def positions(found: Column) -> Column:
    """Array of (start, end, text, value) in code points, from ``matches``."""
    kind = "array<struct<start:int,end:int,text:string,value:string>>"

    def placed(parts):
        gap = let(parts["between"], lambda b: F.transform(F.slice(b, F.lit(1), F.size(parts["whole"])), lambda x: F.length(x)))
        steps = F.zip_with(gap, parts["whole"], lambda g, w: g + F.length(w))
        starts = F.zip_with(running(steps), gap, lambda at, g: at + g)
        texts = F.arrays_zip(starts.alias("start"), parts["whole"].alias("text"), parts["value"].alias("value"))
        return F.transform(texts, lambda m: F.struct(
            m["start"].alias("start"), (m["start"] + F.length(m["text"])).alias("end"), m["text"].alias("text"), m["value"].alias("value")))

    return F.when(F.size(found["whole"]) > 0, let(found, placed)).otherwise(F.array().cast(kind))


def _long_enough(found: Column, least: int) -> Column:
    return F.filter(found, lambda s: F.length(s["value"]) >= least)


def _ranked(found: Column, rank: int) -> Column:
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))


def scan(docs: DataFrame) -> DataFrame:
    """id, text_key, base spans (kind, start, end) and judged runs (start, end, text, labelled) of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = {k: matches(text, p, 2 if k == "assign" else 0) for k, p in PATTERNS.items()}
    raw = docs.select(*identity(), matches(text, RUN).alias("run"), *[m.alias(k) for k, m in parts.items()])
    placed = raw.select("id", "text_key", positions(F.col("run")).alias("run"),
                        *[_long_enough(positions(F.col(k)), LEAST[k]).alias(k) for k in KINDS])
    base = F.concat(*[_ranked(F.col(k), i) for i, k in enumerate(KINDS)])
    based = placed.select("id", "text_key", "run", F.array_sort(base).alias("base"))
    label = lambda r: F.struct(
        r["start"].alias("start"), r["end"].alias("end"), r["text"].alias("text"),
        F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])).alias("labelled"))
    return based.select("id", "text_key", "base", F.transform("run", label).alias("runs"))


def ratios(scanned: DataFrame) -> list[int]:
    """Log-likelihood ratio of each transition in thousandths, row by row of the alphabet."""
    runs = scanned.select(F.explode("runs").alias("r")).select("r.labelled", "r.text")
    pairs = runs.select("labelled", F.explode(neighbours(F.split("text", ""), lambda a, b: F.concat(a, b))).alias("pair"))
    counts: dict[tuple[bool, str], int] = {(r["labelled"], r["pair"]): r["n"] for r in pairs.groupBy(
        "labelled", "pair").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 2 * _SIZE ** 2 rows
    if not any(labelled for labelled, _ in counts):
        return [0] * _SIZE ** 2
    totals = {(s, a): sum(counts.get((s, a + b), 0) for b in CHARACTERS) for s in (True, False) for a in CHARACTERS}
    chance = lambda s, a, b: (counts.get((s, a + b), 0) + 1) / (totals[s, a] + _SIZE)
    return [round(1000 * math.log(chance(True, a, b) / chance(False, a, b))) for a in CHARACTERS for b in CHARACTERS]


def neighbours(items: Column, joined) -> Column:
    """``joined`` of each element and the next."""
    return let(items, lambda x: F.zip_with(F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1), joined))


def ratio(text: Column, model: list[int]) -> Column:
    """Sum of the transitions' ratios over a run, which is cut into characters once."""
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<int>")  # folds into an array literal
    places = F.transform(F.split(text, ""), lambda c: F.call_function("locate", c, F.lit(CHARACTERS)) - 1)
    each = neighbours(places, lambda a, b: F.get(table, a * _SIZE + b).cast("long"))
    return F.aggregate(each, F.lit(0).cast("long"), lambda total, x: total + x)


def spans(docs: DataFrame) -> DataFrame:
    """id, text_key, base and all spans (start, rank, end) of every row; rank len(KINDS) is ``markov``."""
    scanned = stored(scan(docs), "secrets")
    model = ratios(scanned)
    judged = F.filter("runs", lambda r: ~r["labelled"] & (
        ratio(r["text"], model) >= LEAST_RATIO * (F.length(r["text"]) - 1)))
    added = _ranked(judged, len(KINDS))
    return scanned.select("id", "text_key", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def named(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in (*KINDS, "markov")])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")
