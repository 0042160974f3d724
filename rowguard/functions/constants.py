"""Fixed values that must equal the published requirement set."""

# State and territory codes accepted as valid origin states
# (the 57 two-letter codes of the US aviation state list, in published order).
STATE_CODES = [
    "AL", "KY", "OH", "AK", "LA", "OK", "AZ", "ME", "OR", "AR", "MD", "PA",
    "AS", "MA", "PR", "CA", "MI", "RI", "CO", "MN", "SC", "CT", "MS", "SD",
    "DE", "MO", "TN", "DC", "MT", "TX", "FL", "NE", "TT", "GA", "NV", "UT",
    "GU", "NH", "VT", "HI", "NJ", "VA", "ID", "NM", "VI", "IL", "NY", "WA",
    "IN", "NC", "WV", "IA", "ND", "WI", "KS", "MP", "WY",
]

# US civil aircraft registration ("tail number") pattern.
TAIL_NUMBER_PATTERN = r"^N(?:[1-9]\d{0,4}|[1-9]\d{0,3}[A-Z]|[1-9]\d{0,2}[A-Z]{2})$"

# An age of eleven 365-day years expressed in minutes.
ELEVEN_YEARS_MINUTES = 11 * 365 * 24 * 60
