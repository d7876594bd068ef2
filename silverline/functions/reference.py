"""Fixed reference values.

These must equal the studied work's seeds and rules for results to agree, so
they are stated plainly, in their natural order.
"""

# --- fixed values: US state, territory and military postal codes, in the
# --- order of the reference seed file (62 codes).
STATE_CODES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "DC", "FL", "GA", "HI", "ID",
    "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO",
    "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA",
    "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "AS",
    "GU", "MP", "PR", "VI", "FM", "MH", "PW", "AA", "AE", "AP",
)

# --- fixed values: military state codes excluded from the ZIP/state check.
MILITARY_STATES = ("AA", "AE", "AP")

# --- fixed values: products of the generated orders.
REFERENCE_PRODUCTS = ("bread", "brioche", "cookie", "croissant", "donut", "drink")

# --- fixed values: the same contract for the driver tables, whose products
# --- are the six part types (lower-cased) and quantities 1 to 50.
DRIVER_PRODUCTS = ("economy", "large", "medium", "promo", "small", "standard")
DRIVER_QUANTITIES = tuple(range(1, 51))

# --- fixed values: accepted sex codes and boolean flags.
SEX_CODES = ("F", "M")
BOOLEAN_VALUES = (True, False)

# --- fixed values: address line-2 patterns (city and state/zip tail).
CITY_PATTERN = r"^(.+), [A-Z]{2} [0-9]{5}$"
STATE_ZIP_PATTERN = r"([A-Z]{2}) ([0-9]{5})$"
UUID_PATTERN = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"

# --- fixed values: reference date of the age-group report.
AGE_REFERENCE_DATE = "2020-01-01"
