"""Values that must equal the source system's for results to match.

FIXED VALUES — these are data, not logic: patterns, formats, sentinels,
lookup maps and constant columns as the source system defines them.  They are
listed plainly and in their natural order; every function in ``kiln`` takes
them as arguments with these as defaults.
"""

# --- FIXED VALUES: text patterns -------------------------------------------
# A whole-string run of digits: a valid numeric id.
NUMERIC_ID_PATTERN = r"^[0-9]+$"
# An optionally negative decimal number written in plain digits.
NUMERIC_TEXT_PATTERN = r"^-?\d+(\.\d+)?$"
# A leading weekday name and comma, as in "Tuesday, July 01, 2025".
WEEKDAY_PREFIX_PATTERN = r"^[A-Za-z]+,\s*"
# The text inside the first pair of parentheses, e.g. the pack size "(60g)".
PARENTHESISED_PATTERN = r"\(([^)]+)\)"

# --- FIXED VALUES: date formats seen in the landing files ------------------
# Mutually exclusive, so the order of attempts does not change any result.
DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "dd/MM/yyyy",
    "dd-MM-yyyy",
    "MMMM dd, yyyy",
)

# --- FIXED VALUES: sentinels for ids that are not numeric ------------------
BAD_CUSTOMER_ID = "999999"
BAD_PRODUCT_ID = "9999999"

# --- FIXED VALUES: customer city spelling fixes and allowed cities ---------
CITY_FIXES = {
    "bengaluruu": "Bengaluru",
    "bengalore": "Bengaluru",
    "NewDelhi": "New Delhi",
    "NewDheli": "New Delhi",
    "NewDelhee": "New Delhi",
    "Hyderabadd": "Hyderabad",
    "Hyderbad": "Hyderabad",
}
ALLOWED_CITIES = ("Bengaluru", "New Delhi", "Hyderabad")

# --- FIXED VALUES: per-customer city corrections ----------------------------
CITY_CORRECTIONS = {
    "789101": "Bengaluru",
    "789403": "New Delhi",
    "789520": "Bengaluru",
    "789521": "Hyderabad",
    "789603": "Hyderabad",
    "789420": "Bengaluru",
}

# --- FIXED VALUES: product spelling fix and category -> division ------------
PRODUCT_TYPO = ("(?i)protien", "Protein")
CATEGORY_TO_DIVISION = {
    "Protien Bars": "Nutrition Bars",
    "Energy Bars": "Nutrition Bars",
    "Granola & Cereals": "Breakfast Foods",
    "Recovery Dairy": "Dairy and Recovery",
    "Healthy Snacks": "Healthy Snacks",
    "Electrolyte Mix": "Hydrations",
}

# --- FIXED VALUES: constant columns of the acquired company's customers -----
# The parent table spells the market "India" (the child notebook wrote
# "india"); the parent's spelling is the default.
CUSTOMER_MARKET = "India"
CUSTOMER_PLATFORM = "Sports Bar"
CUSTOMER_CHANNEL = "Acquisition"
UNKNOWN_CITY = "unknown"
