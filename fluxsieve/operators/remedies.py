"""What the evidence says about a flowgate and which remedies it leaves open."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fluxsieve import fixed
from fluxsieve.functions import text


def base_case(contingency_name: Column, facility: Column, contingency_line: Column) -> Column:
    """True: binds with everything in service. False: after an outage. Null: unknown."""
    named = F.coalesce(text.blank_to_null(contingency_name), text.blank_to_null(facility))
    return F.when(named.isNotNull(), named == "BASE").when(
        contingency_line.isNotNull(), F.lit(False)).otherwise(F.lit(None).cast("boolean"))


def branch_outage(base: Column, facility: Column, contingency_line: Column) -> Column:
    """For an outage flowgate, whether the outaged element is a branch; null otherwise."""
    f = F.trim(F.coalesce(facility, F.lit("")))
    second = F.trim(F.get(F.split(f, ":"), F.lit(1)))
    two_words = F.size(F.filter(F.split(second, r"\s+"), lambda w: w != "")) >= 2
    prefixed = f.startswith("LN") | f.startswith("DBL") | f.startswith("XF")
    return F.when(base == F.lit(False), F.when(contingency_line.isNotNull(), True)
                  .when(f.contains(":"), two_words).otherwise(prefixed))


def corridor(line: Column, facility: Column, constraint_id: Column) -> Column:
    """The unit a remedy is deployed on: the line, else the named facility, else the flowgate."""
    return F.coalesce(text.blank_to_null(line), text.blank_to_null(facility), constraint_id)


def evidence_class(ctype: Column, base: Column, radial: Column, months: Column) -> Column:
    in_service = F.coalesce(base, F.lit(False))
    return (
        F.when(ctype.isin("loopflow", "interface"), ctype)
        .when(ctype == "transformer",
              F.when(in_service, "transformer_base").otherwise("transformer_n1"))
        .when(F.coalesce(radial, F.lit(False)), "line_radial")
        .when(in_service, "line_base")
        .when(months <= 1, "line_n1_episodic")
        .otherwise("line_n1"))


def recommend(ctype: Column, radial: Column, persistence: Column, loading: Column,
              loading_seen: Column, breached: Column, base: Column, branch: Column) -> Column:
    """The remedy the evidence points to."""
    heavy = F.when(loading_seen, loading >= fixed.HEAVY_AT).otherwise(
        F.coalesce(breached >= 1, F.lit(False)))
    both = heavy & (persistence >= fixed.PERSISTENT_AT)
    looped = F.coalesce((base == F.lit(False)) & branch, F.lit(False))
    rates_itself = F.when(loading_seen, (ctype == "thermal") & F.coalesce(radial, F.lit(False))).otherwise(
        (ctype != "transformer") & ~looped)
    return (F.when(ctype == "loopflow", fixed.TOPOLOGY).when(ctype == "interface", fixed.FLOW_CONTROL)
            .when(both, fixed.COMBINATION).when(rates_itself, fixed.RATING).otherwise(fixed.FLOW_CONTROL))


def open_remedies(ctype: Column, radial: Column, loading_seen: Column, pick: Column) -> Column:
    """Remedies not ruled out, in fixed order; the rule's pick is always among them."""
    stub = (ctype == "thermal") & F.coalesce(radial, F.lit(False))
    rating, control, topology = (ctype != "transformer"), ~stub, ~stub
    is_open = {fixed.RATING: rating, fixed.FLOW_CONTROL: control, fixed.TOPOLOGY: topology,
               fixed.COMBINATION: rating & control}
    listed = F.array_compact(F.array(*[
        F.when(is_open[r] | (pick == r), F.lit(r)) for r in fixed.REMEDY_ORDER]))
    return F.when(loading_seen, F.array(pick)).otherwise(listed)


def remedy_label(remedies: Column) -> Column:
    """The one remedy, or the short names of all that are open: 'A, B or C'."""
    names = F.create_map(*[F.lit(x) for kv in fixed.REMEDY_SHORT.items() for x in kv])
    short = F.transform(remedies, lambda r: names[r])
    head = F.array_join(F.slice(short, F.lit(1), F.greatest(F.size(short) - 1, F.lit(0))), ", ")
    return F.when(F.size(remedies) == 1, F.get(remedies, F.lit(0))).otherwise(
        F.concat(head, F.lit(" or "), F.element_at(short, -1)))


def same_station(facility: Column) -> Column:
    """A monitored line whose two ends carry the same name."""
    ends = F.split(F.regexp_replace(facility, "^LN ", ""), " - ", 2)
    return F.coalesce(facility.startswith("LN ") & facility.contains(" - ")
                      & (F.trim(F.get(ends, F.lit(0))) == F.trim(F.get(ends, F.lit(1)))), F.lit(False))


def basis_text(ctype: Column, radial: Column, loading_seen: Column, breached: Column,
               base: Column, branch: Column, pick: Column, facility: Column) -> Column:
    """One line on what the rule could see."""
    t = {k: F.lit(v) for k, v in fixed.BASIS_TEXT.items()}
    flag = F.when(radial, "radial=True").otherwise("radial=False")
    screened = F.concat_ws(
        "; ", F.concat(F.lit("ctype="), ctype),
        F.when(radial.isNull(), t["radial_meshed"]).otherwise(flag), t["heavy_screen"])
    heavy = F.when(breached.isNull(), t["heavy_unobserved"]).otherwise(F.concat(
        F.lit("heavy=DA breached hours ("), text.number_text(breached), F.lit(" h)")))
    contingency = (F.when(base, t["base"]).when(~base & F.coalesce(branch, F.lit(False)), t["branch"])
                   .when(~base, t["not_branch"]).otherwise(t["contingency_unknown"]))
    others = (F.when(pick == fixed.COMBINATION, t["combination"])
              .when(ctype == "transformer", t["transformer"])
              .when((ctype == "thermal") & (pick == fixed.FLOW_CONTROL), t["flow_control"])
              .when((ctype == "thermal") & (pick == fixed.RATING), t["rating"]))
    market = F.concat_ws(
        "; ", F.concat(F.lit("ctype="), ctype),
        F.when(radial.isNull(), F.lit("radial=unknown")).otherwise(flag), heavy, contingency, others,
        F.when((ctype == "thermal") & same_station(facility), t["caution"]))
    return F.when(loading_seen, screened).otherwise(market)
