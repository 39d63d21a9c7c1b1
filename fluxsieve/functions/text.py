"""Text expressions: blanks, names, keys and labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fluxsieve import fixed

# In a Spark regular expression \b needs ASCII letters only here: every input is upper-cased.


def blank_to_null(c: Column) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def collapse(c: Column) -> Column:
    """Runs of white space become one blank; ends are trimmed; null becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))


def number(c: Column) -> Column:
    """Double from text that may carry thousands commas; null when it is not a number."""
    return F.regexp_replace(F.trim(c), ",", "").try_cast("double")


def number_text(c: Column, places: int = 6) -> Column:
    """Whole numbers without a decimal point, other values in shortest form."""
    v = F.bround(c, places)
    return F.when(v == F.floor(v), v.cast("bigint").cast("string")).otherwise(v.cast("string"))


def sheet_safe(c: Column) -> Column:
    """Prefix a quote where a spreadsheet would evaluate the text as a formula."""
    return F.when(c.rlike(fixed.FORMULA_START), F.concat(F.lit("'"), c)).otherwise(c)


def _words(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def poi_key(c: Column) -> Column:
    """Comparable substation name of a point of interconnection."""
    s = F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), fixed.POI_PARENTHETICAL, " ")
    s = F.regexp_replace(s, fixed.POI_GLUED_WORD, "$1 $2")
    s = F.regexp_replace(s, fixed.POI_PUNCTUATION, " ")
    s = F.regexp_replace(s, fixed.POI_KV_TOKEN, " ")
    words = F.transform(_words(s), lambda w: F.btrim(w, F.lit(".")))
    kept = F.filter(
        words,
        lambda w: (w != "") & ~w.isin(*fixed.POI_STOPWORDS) & ~w.rlike(fixed.PLAIN_NUMBER),
    )
    return F.array_join(kept, " ")


def endpoint_name(c: Column) -> Column:
    """Normalized endpoint name of a line filing or a mapped line."""
    s = F.trim(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), fixed.PARENTHETICAL_OPEN, " "))
    bare = F.regexp_replace(s, fixed.DESIGNATOR, "")
    s = F.when(F.trim(bare) != "", bare).otherwise(s)
    for pattern in (fixed.CIRCUIT, fixed.NAME_PUNCTUATION, fixed.KV_TOKEN, fixed.FACILITY_WORD):
        s = F.regexp_replace(s, pattern, " ")
    expand = F.create_map(*[F.lit(x) for kv in fixed.NAME_ABBREVIATIONS.items() for x in kv])
    s = F.array_join(F.transform(_words(s), lambda w: F.coalesce(expand[w], w)), " ")
    return F.regexp_replace(s, fixed.TRAILING_KV, "")


def endpoint_key(c: Column) -> Column:
    """Endpoint name with blanks removed, the value joins compare."""
    return F.replace(endpoint_name(c), F.lit(" "), F.lit(""))


def is_placeholder(c: Column) -> Column:
    return F.upper(collapse(c)).rlike(fixed.NAME_PLACEHOLDER)


def name_token(c: Column) -> Column:
    """A line's endpoint name as evidence for a bus name; generic names carry none."""
    return F.when(~F.upper(F.coalesce(c, F.lit(""))).isin(*fixed.GENERIC_NAMES), c)


def is_numbered_placeholder(c: Column) -> Column:
    return F.upper(c).rlike(fixed.NUMBERED_PLACEHOLDER)


def element_class(monitored: Column) -> Column:
    """ln / xfmr / multi / blank / other, from the first word of the monitored element."""
    head = F.split(monitored, " ")[0]
    return (
        F.when(F.coalesce(monitored, F.lit("")) == "", "blank")
        .when(monitored == fixed.MULTI_ELEMENT, "multi")
        .when(head.isin("LN", "XFMR"), F.lower(head))
        .otherwise("other")
    )


def line_ends(monitored: Column) -> Column:
    """'LN B - A' -> 'A - B': endpoint order does not matter."""
    rest = F.regexp_replace(monitored, r"^[^ ]* ", "")
    ends = F.transform(F.split(rest, " - "), lambda e: F.trim(e))
    return F.array_join(F.array_sort(ends), " - ")


def element_key(monitored: Column) -> Column:
    """Comparable monitored element: lines ignore endpoint order."""
    return F.when(
        monitored.startswith("LN "), F.concat(F.lit("LN "), line_ends(monitored))
    ).otherwise(monitored)


def facility_key(element: Column, monitored: Column, constraint_name: Column) -> Column:
    """Corridor key of a monitored element."""
    return (
        F.when(element == "ln", F.concat(F.lit("LN "), line_ends(monitored)))
        .when(element == "multi", F.concat_ws(" ", monitored, constraint_name))
        .otherwise(monitored)
    )


def contingency_owner(facility: Column) -> Column:
    """Owner codes before the first colon, '' when the text has another shape."""
    head = F.trim(F.split(facility, ":")[0])
    shaped = (facility != "BASE") & facility.contains(":") & head.rlike(fixed.OWNER_CODES)
    return F.when(shaped, head).otherwise("")


def contingency_kv(facility: Column) -> Column:
    """Third colon field when it is a plain number, else ''."""
    third = F.trim(F.get(F.split(facility, ":"), F.lit(2)))
    shaped = (facility != "BASE") & third.rlike(fixed.PLAIN_NUMBER)
    return F.when(shaped, third).otherwise("")
