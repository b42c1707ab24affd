"""Values that must equal those of the jobs being re-expressed."""

# ---- fixed values: labels, bounds, patterns and defaults -------------------
RATING_STEPS = [(4.5, "Excellent"), (4.0, "Good")]
RATING_REST = "Average"

GRADE_REST = "Regular"
GRADE_NULL = "Sem Avaliacao"

TIER_REST = "Tier 3 - Standard"

AMOUNT_STEPS = [(150.0, "High"), (75.0, "Medium")]
AMOUNT_REST = "Low"
AMOUNT_NULL = "Unknown"

WEEKDAYS = {1: "Sun", 2: "Mon", 3: "Tue", 4: "Wed", 5: "Thu", 6: "Fri", 7: "Sat"}

PHONE_MARKS = r"[()\-+]"
PHONE_MARKS_AND_SPACES = r"[()\s\-]"

CUISINE_DEFAULT = "UNKNOWN"
FILL_DEFAULTS = {"cuisine_type": "Unknown", "phone": "N/A"}

ALL_LABEL = "** ALL **"
GRAND_TOTAL_LABEL = "** GRAND TOTAL **"
# ----------------------------------------------------------------------------

# The same ladders on part prices (900.00 to 999.90): the cuts are the second and
# third quartile of that column, so each label holds a share like the original's.
PRICE_STEPS = [(975.0, "Excellent"), (950.0, "Good")]
