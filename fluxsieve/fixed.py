"""Word lists, tables, patterns and formats that results depend on.

Everything below is data that must hold these exact values for results to agree with the
published outputs; no logic lives here.
"""

# --- geometry -------------------------------------------------------------------
EARTH_RADIUS_M = 6_371_008.8
METRES_PER_MILE = 1609.344
STUB_METRES = 1.0

# --- line features ----------------------------------------------------------------
LINE_REASONS = (
    "bad_id", "duplicate_id", "dc", "inactive", "under_construction",
    "unknown_kv", "below_min_kv", "bad_geometry",
)
EXCLUDED_STATUS = {"INACTIVE": "inactive", "UNDER CONSTRUCTION": "under_construction"}
NUMBERED_PLACEHOLDER = r"^(TAP|UNKNOWN|RISER|DEADEND)\d+$"
GENERIC_NAMES = ("", "TAP", "UNKNOWN", "RISER", "DEADEND", "NOT AVAILABLE", "NONE")

# --- line filings -----------------------------------------------------------------
FILING_DROP_ORDER = ("no_voltage", "no_length", "missing_endpoint")
AGGREGATE_FLAGS = ("same_endpoints", "aggregate_name")
NOMINAL_SYSTEM_KV = (
    2.4, 4.16, 4.8, 6.9, 8.32, 12.0, 12.47, 13.2, 13.8, 20.78, 22.86, 23.0, 24.94,
    34.5, 46.0, 69.0, 115.0, 138.0, 161.0, 230.0, 345.0, 500.0, 765.0,
)
AGGREGATE_NAME = (
    r"^(SUB ?TOTAL|TOTAL|SUMMARY|GROUPED|LESS THAN|LESS |VARIOUS|ALL \d|ROUNDING)"
    r"|\bKV (LINES|SYSTEM)\b"
)
PARENTHETICAL_OPEN = r"\([^)]*\)?"
DESIGNATOR = r"^(TL[\d-]+[A-Z]?|\d+[A-Z]?)(\s+|-(?=[A-Z]))"
CIRCUIT = r"\b(LINE|LN|CKT|CIRCUIT)\s*#?\s*\d+[A-Z]?\b"
NAME_PUNCTUATION = r"[^A-Z0-9 ]+"
KV_TOKEN = r"\b\d+(\.\d+)?\s*KV\b"
FACILITY_WORD = (
    r"\b(POWER PLANT|POWER STATION|SUBSTATION|SUB|SWITCHING|SWITCHYARD|SWYD"
    r"|STATION|STA|SW|PLANT)\b"
)
TRAILING_KV = r"\s(69|115|138|161|230|345|500|765)$"
NAME_ABBREVIATIONS = {
    "CO": "COUNTY", "CK": "CREEK", "CRK": "CREEK", "JCT": "JUNCTION",
    "NW": "NORTHWEST", "NE": "NORTHEAST", "SE": "SOUTHEAST",
}
NAME_PLACEHOLDER = r"^((TAP|UNKNOWN)\s*\d*|NOT AVAILABLE|NONE|N/?A|)$"

# --- points of interconnection ------------------------------------------------------
POI_PARENTHETICAL = r"\([^)]*\)"
POI_GLUED_WORD = r"(\d)(KV|LINE|SUBSTATION|SWITCHING|STATION|SUB|BUS)\b"
POI_PUNCTUATION = r"[^A-Z0-9.]+"
POI_KV_TOKEN = r"\b\d+(?:\.\d+)?\s*KV\b"
POI_STOPWORDS = (
    "SUBSTATION", "SUBSTA", "SUB", "SWITCHING", "SWITCHINGSTATION", "SWITCH",
    "STATION", "SWITCHYARD", "BUS", "KV",
)
PLAIN_NUMBER = r"^\d+(?:\.\d+)?$"
OWNER_CODES = r"^[A-Z][A-Z0-9&_]*(?: [A-Z][A-Z0-9&_]*)*$"

# --- market files -----------------------------------------------------------------
BINDING_COLUMNS = (
    "Interval", "GMTIntervalEnd", "Constraint Name", "Constraint Type", "State",
    "Shadow Price", "Monitored Facility", "Contingent Facility", "Contingency Name",
)
DOLLAR_COLUMNS = ("Date", "Constraint Name", "Monitored Facility", "Contingency Name", "Sum")
SETTLED_COLUMNS = ("Constraint Name", "DA Collected", "Month")
QUEUE_COLUMNS = (
    "Generation Interconnection Number", "State", "TO at POI", "Capacity",
    "Generation Type", "Fuel Type", "Substation or Line", "Date Withdrawn", "Status",
)
MARKET_TIME = "MM/dd/yyyy HH:mm:ss"
HOURLY_TIME = "MM/dd/yyyy hh:mm:ss a"
MULTI_ELEMENT = "Multi-Element Constraint"
PHASE_SHIFTER_MARK = "PHSHFT"
MONTH_RATIO_BAND = (0.8, 2.0)
MONTH_RATIO_VS_MEDIAN = (0.8, 1.5)
JOIN_SHARE_FLOOR = 0.95

# --- balancing-authority hours --------------------------------------------------------
DEMAND_COLUMNS = ("Demand (MW) (Adjusted)", "Demand (MW)")
NET_GENERATION_COLUMNS = ("Net Generation (MW) (Adjusted)", "Net Generation (MW)")
WIND_COLUMN_GROUPS = (
    ("Net Generation (MW) from Wind (Adjusted)",),
    ("Net Generation (MW) from Wind",),
    ("Net Generation (MW) from Wind without Integrated Battery Storage",
     "Net Generation (MW) from Wind with Integrated Battery Storage"),
)
OPERATING_CODES = ("OP", "SB")

# --- snapshot ---------------------------------------------------------------------
SNAPSHOT_TABLES = (
    "buses", "hifld_lines", "eia_lines", "ferc1_lines",
    "constraints", "congestion", "planning", "queue", "load_930",
)
COVERAGE_LEVELS = ("observed", "partial", "unobserved")
PER_COLUMN_STAMPED = (
    "monthly_cost_musd", "hours_binding", "shadow_price_sum_usd_per_mw",
    "breached_hours", "months_binding", "rent_musd", "max_month_cost_musd",
)

# --- quality ----------------------------------------------------------------------
NOMINAL_VOLTAGES = (69.0, 115.0, 138.0, 161.0, 230.0, 345.0, 500.0, 765.0)
PROVIDER_ORDER = ("hifld", "eia", "ferc1")
CONFIDENCE_LADDER = ("low", "medium", "high")
FIELD_CONFIDENCE = {
    "voltage_kv": "medium", "conductor": "medium",
    "thermal_limit_mw": "medium", "cost_usd": "high",
}
DOWNGRADE_FLAGS = (
    "source_divergence", "voltage_implausible", "conductor_voltage_mismatch", "imputed",
)

# --- network ----------------------------------------------------------------------
MVA_BASE = 100.0
OHM_PER_MILE = 0.8
REACTANCE_BAND = (0.7, 1.3)
TYPICAL_RATING_MW = (
    (69.0, 70.0), (115.0, 150.0), (138.0, 220.0), (161.0, 300.0),
    (230.0, 500.0), (345.0, 1200.0), (500.0, 2000.0), (765.0, 3500.0),
)

# --- ranges -----------------------------------------------------------------------
FORWARD_BAND = (0.6, 1.5)
HOURS_BAND = (0.8, 1.2)
PLAN_COST_BAND = (0.8, 1.4)
RATING_MW_UNOBSERVED = (100.0, 250.0, 1200.0)
HOURS_PER_YEAR = 8760.0
LOGNORMAL_SPAN = 2 * 1.645
ABSENT_SPREAD = 0.05
PLAN_PROVIDER = {"ITP": "spp_itp", "FCA": "spp_fca"}

# --- signals and scoring ------------------------------------------------------------
SIGNALS = (
    "rent", "loading", "persistence", "demand_pressure", "planning", "cost_of_inaction",
)
DEFAULT_WEIGHTS = {
    "rent": 0.25, "loading": 0.20, "persistence": 0.15, "demand_pressure": 0.15,
    "planning": 0.15, "cost_of_inaction": 0.10,
}
DEFAULT_REFERENCES = {
    "rent_ref_musd": 50.0, "persist_ref_hours": 600.0, "demand_ref_mw": 1000.0,
    "planning_cost_ref_musd": 200.0, "coi_ref_musd": 2.5, "loading_ref": 1.0,
}
DEFAULT_DRAWS = 10_000
DEFAULT_TOP_FRACTION = 0.25
DEFAULT_SEED = 20260630
PERSISTENT_AT = 0.6
HEAVY_AT = 1.0

# --- remedies -----------------------------------------------------------------------
NO_REMEDY = "No cost-effective GET"
RATING = "Dynamic Line Rating"
FLOW_CONTROL = "Advanced Power Flow Control"
TOPOLOGY = "Topology Optimization"
COMBINATION = "Combination"
SINGLE_REMEDIES = (RATING, FLOW_CONTROL, TOPOLOGY)
REMEDY_ORDER = (RATING, FLOW_CONTROL, TOPOLOGY, COMBINATION)
REMEDY_SHORT = {RATING: "DLR", FLOW_CONTROL: "APFC", TOPOLOGY: "TO", COMBINATION: "Combination"}
REMEDY_SLUG = {NO_REMEDY: "none", RATING: "dlr", FLOW_CONTROL: "apfc",
               TOPOLOGY: "to", COMBINATION: "c"}
EVIDENCE_CLASSES = (
    "line_base", "line_n1", "line_n1_episodic", "line_radial",
    "transformer_base", "transformer_n1", "interface", "loopflow",
)

# --- backtest ---------------------------------------------------------------------
MONTH_SPLITS = {
    "H1->H2": ((1, 2, 3, 4, 5, 6), (7, 8, 9, 10, 11, 12)),
    "H2->H1": ((7, 8, 9, 10, 11, 12), (1, 2, 3, 4, 5, 6)),
    "odd->even": ((1, 3, 5, 7, 9, 11), (2, 4, 6, 8, 10, 12)),
    "even->odd": ((2, 4, 6, 8, 10, 12), (1, 3, 5, 7, 9, 11)),
}
PREDICTORS = ("annual", "months_binding_share")
QUANTILE_POINTS = (0.0, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)

# --- panel ------------------------------------------------------------------------
MARKETS = ("DA", "RT")
HISTORY_COLUMNS = (
    "constraint_id", "market", "period", "hours_binding", "shadow_price_max",
    "shadow_price_mean", "congestion_cost_usd", "monitored_facility", "contingent_facility",
)
COVERAGE_COLUMNS = ("market", "period", "days_expected", "days_covered", "raw_refs")
FOOTPRINT_COLUMNS = (
    "element_id", "element_kind", "constraint_id", "corridor_id", "match_status",
    "evidence", "evidence_refs", "reviewed_by", "reviewed_on",
)
ELEMENT_KINDS = (
    "settlement_location", "resource", "site", "county", "owner", "corridor", "constraint",
)
MATCH_STATUSES = ("verified", "uncertain", "unmatched")
PERIOD_PATTERN = r"^[0-9]{4}-(0[1-9]|1[0-2])$"
NUMBER_PATTERN = r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"
COUNT_PATTERN = r"^[0-9]+$"
DST_EXTRA_HOURS = 1.0
FORMULA_START = r"^[=+\-@\t\r]"

# --- explanation texts ----------------------------------------------------------------
BASIS_TEXT = {
    "radial_meshed": "radial=unknown(treated meshed)",
    "heavy_screen": "heavy=DC screen",
    "heavy_unobserved": "heavy=unobserved (no DA breach record)",
    "base": "contingency=BASE (binds with all elements in service; mesh unknown)",
    "branch": "contingency=N-1 (branch outage: the outaged branch shares a loop with this element)",
    "not_branch": "contingency=N-1 (outaged element is not a branch: mesh unknown)",
    "contingency_unknown": "contingency=unknown",
    "combination": "rule=breached and persistent",
    "transformer": "not_applicable=DLR (rates overhead conductors, not transformers); also=TO",
    "flow_control": "also=DLR (raises the post-contingency rating if the conductor limits), "
                    "TO (post-contingency switching)",
    "rating": "also=APFC or TO (need a parallel path or switching options; topology not public)",
    "caution": "caution=both ends carry the same station name (a bus tie or an intra-station "
               "segment, where no GET may apply; element identity is CEII)",
}
UNOBSERVED_TEXT = {
    "rent": "no observed congestion $ for this flowgate",
    "congestion": "congestion data not obtained",
    "loading": "monitored element not on public topology; DC screen cannot see it",
    "location": "constraint location unknown, so nearby queue MW cannot be summed",
    "queue": "interconnection queue not obtained",
    "planning": "planning (ITP) items not obtained",
    "recurring": "recurring rent needs monthly congestion $, not in this row",
}
