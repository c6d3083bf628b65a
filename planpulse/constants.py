"""Fixed values.

These must equal the values the original reports use for results to match;
they are listed as plain text, in their original order.  Every operator takes
them as parameters, so a deployment can pass its own.
"""

# --- fixed values ---------------------------------------------------------
# Lead sources dropped from plans, visits and lapsed entities.
EXCLUDED_SOURCES = ("CSR", "Existing Client", "Offline-Webinar", "NVF")
# Assignment status that does not count as live.
EXPIRED_STATUS = "Expired"
# Staff roles pivoted into one column each.
STAFF_ROLES = ("Psychologist", "Psychiatrist", "Counsellor")
# Visit statuses that count as a completed visit.
COMPLETED_VISIT_STATUSES = (1, 5)
# Lead sources that make a session's entity "Corporate".
CORPORATE_SOURCES = ("Kellton", "Tata Aia", "TATA AIA", "Primus")
# Entity types of a plan by lead source: always corporate, always CSR, CSR if the amount is 0.
CORPORATE_PLAN_SOURCE = "Corporate"
CSR_PLAN_SOURCE = "NTPC"
ZERO_AMOUNT_CSR_SOURCES = ("CSR", "Existing Client")
# Constant entity kind of the lapsed table.
ENTITY_KIND = "Regular"
# Days after the previous due date that still count as a (late) renewal.
GRACE_DAYS = 45
# Text that means "no value" after trimming (compared lower-case).
BLANK_TOKENS = ("", "none", "nan")
# Characters trimmed from each element of a JSON text list.
LIST_TRIM_CHARS = " \n\t\r"
# Separator for joined text lists.
LIST_SEPARATOR = ", "
# Lead-source normalisation: brand word, variant word and their labels.
SOURCE_BRAND_WORD = "practo"
SOURCE_VARIANT_WORD = "insta"
SOURCE_BRAND_LABEL = "Practo"
SOURCE_VARIANT_LABEL = "Practo-Insta"
UNKNOWN_LABEL = "Unknown"
# Lead sources always shown in the source mix, in this order.
SOURCE_ORDER = (
    "Practo", "GMB", "1 MG", "Website", "Referral", "Organic", "Google/ IVR Leads",
    "Whatsapp", "Internal Referral", "Client Referral", "TATA AIA", "Primus", "Walk-in",
    "Facebook", "Digital Leads", "Docgenie", "Instagram", "Practo-Insta", "Team Referral",
)
# Plan durations (months) listed first in the duration mix, in this order.
PREFERRED_DURATIONS = (1, 2, 3, 6, 9, 12)
# Report categories, in report order.
CATEGORIES = (
    "New OPDs", "F/U OPDs", "New Plan", "Renewals", "Revivals",
    "Inactive", "Active", "Assessments", "Suggest RPP", "NO2P %",
)
REVERSED_CATEGORIES = ("Inactive",)
RATIO_CATEGORIES = ("NO2P %",)
AMOUNT_CATEGORIES = ("New OPDs", "F/U OPDs", "New Plan", "Renewals", "Revivals", "Assessments")
REVENUE_LABEL = "Revenue"
OVERALL_LABEL = "Overall"
TOTAL_LABEL = "Total"
# Visit amount used when the recorded amount is missing or zero.
DEFAULT_VISIT_AMOUNT = 1500
# Share of last month's active count used as the renewal target.
RENEWAL_TARGET_SHARE = 0.75
# Headers of the assessments table (lower-cased), first present wins.
ASSESSMENT_DATE_HEADERS = ("date",)
ASSESSMENT_CENTER_HEADERS = ("center",)
ASSESSMENT_COUNT_HEADERS = ("assesment's no.", "assessment's no.", "assesments no.", "assessments no.")
ASSESSMENT_COST_HEADERS = ("cost",)
# Keys tried, in order, to print a nested feed object.
FEED_NAME_KEYS = ("name", "title", "packageName", "label")
# Metrics of the branch table.
GRAPH_METRICS = ("New OPDs", "F/U OPDs", "Suggest RPP", "New Plan", "Renewals", "Revivals",
                 "Assessments", "Active", "Inactive")
# Plan/visit history window (months) and the change below which a move is flat.
HISTORY_MONTHS = 12
FLAT_CHANGE = 0.05
# --------------------------------------------------------------------------

# --- fixed values: display headings of the written reports ---------------
STAFF_HEADINGS = (
    ("staff", "Therapist"), ("new_visits", "NEW OPD"), ("followup_visits", "F/U OPD"),
    ("total_visits", "Total OPD Done"), ("suggested", "RPP Suggested"),
    ("conversions", "Convergation"), ("sessions", "Sessions Done"),
    ("active", "Active Client"), ("inactive", "Inactive Client"),
)
TARGET_HEADINGS = (
    ("metric", "Category"), ("target", "Total Target"), ("prorated_target", "MTD-1 Target"),
    ("best_value", "Best Month"), ("achieved", "Achieved"),
)
SOURCE_HEADINGS = (
    ("source", "Lead Source"), ("new_visits", "New OPD"), ("old_visits", "OLD OPD"),
    ("total_visits", "Total OPD"), ("suggested", "Suggest RPP"), ("new_plans", "Plan"),
    ("renewals", "Total Renewal"), ("revivals", "Revival"), ("conversion_pct", "NO2P %"),
)
# Scorecard period headings; days and months are filled in.
PERIOD_HEADINGS = (("yesterday", "Yesterday ({d2}-{m2})"), ("mtd", "MTD-1 ({d1}-{d2} {m2})"),
                   ("last_month", "Last Month ({d1}-{d2} {m1})"))
DURATION_HEADINGS = (("duration_label", "New Plan Duration"), ("plan_count", "Count"), ("amount", "Amount"))
# --------------------------------------------------------------------------
