"""Lookup tables, thresholds and weights that results depend on."""
from __future__ import annotations

# State -> census region.
REGION_STATES: dict[str, list[str]] = {
    "Northeast": ["CT", "MA", "ME", "NH", "NJ", "NY", "PA", "RI", "VT"],
    "Midwest": ["IA", "IL", "IN", "KS", "MI", "MN", "MO", "ND", "NE", "OH", "SD", "WI"],
    "South": [
        "AL", "AR", "DC", "DE", "FL", "GA", "KY", "LA", "MD", "MS", "NC", "OK", "SC", "TN", "TX",
        "VA", "WV",
    ],
    "West": ["AK", "AZ", "CA", "CO", "HI", "ID", "MT", "NM", "NV", "OR", "UT", "WA", "WY"],
}
STATE_REGION = {state: region for region, states in REGION_STATES.items() for state in states}

# First three digits of a postal key, inclusive range -> state.
PREFIX_RANGES: list[tuple[int, int, str]] = [
    (10, 27, "MA"), (28, 29, "RI"), (30, 38, "NH"), (39, 49, "ME"), (50, 59, "VT"),
    (60, 69, "CT"), (70, 89, "NJ"), (100, 149, "NY"), (150, 196, "PA"), (197, 199, "DE"),
    (200, 205, "DC"), (206, 219, "MD"), (220, 246, "VA"), (247, 269, "WV"), (270, 289, "NC"),
    (290, 299, "SC"), (300, 319, "GA"), (320, 349, "FL"), (350, 369, "AL"), (370, 385, "TN"),
    (386, 399, "MS"), (400, 427, "KY"), (430, 459, "OH"), (460, 479, "IN"), (480, 499, "MI"),
    (500, 529, "IA"), (530, 549, "WI"), (550, 567, "MN"), (570, 579, "SD"), (580, 589, "ND"),
    (590, 599, "MT"), (600, 629, "IL"), (630, 659, "MO"), (660, 679, "KS"), (680, 699, "NE"),
    (700, 715, "LA"), (716, 729, "AR"), (730, 749, "OK"), (750, 799, "TX"), (800, 819, "CO"),
    (820, 831, "WY"), (832, 839, "ID"), (840, 849, "UT"), (850, 869, "AZ"), (870, 884, "NM"),
    (885, 888, "PR"), (889, 899, "NV"), (900, 961, "CA"), (962, 966, "PR"), (967, 968, "HI"),
    (969, 969, "PR"), (970, 979, "OR"), (980, 994, "WA"), (995, 999, "AK"),
]

# States outside the continental scope.
NON_CONTINENTAL = ["AK", "HI", "PR", "GU", "VI", "AS", "MP"]

# Thresholds.
DESERT_MILES = 50.0
RURAL_PEOPLE_PER_KM2 = 100.0
RISK_THRESHOLD = 0.5
SWEEP_THRESHOLDS = [0.3, 0.4, 0.5, 0.6, 0.7]
HEAT_DAY_C = 35.0
HEAVY_PRECIP_MM = 20.0
DAYS_PER_YEAR = 365.25
KM2_PER_SQUARE_MILE = 2.58999
SQUARE_METERS_PER_KM2 = 1_000_000.0

# Income bands, upper ends inclusive.
INCOME_BANDS: list[tuple[str, float | None]] = [
    ("<40k", 40_000.0), ("40-60k", 60_000.0), ("60-80k", 80_000.0), ("80-100k", 100_000.0),
    ("100k+", None),
]

# Siting.
COVERAGE_MILES = 25.0
MIN_DISTANCE_REDUCTION = 25.0
TOP_N_SCENARIOS = [100, 500, 1000]
OFFSET_DEGREES = 0.03
SCORE_WEIGHTS = {"gap": 0.28, "need": 0.33, "population": 0.12, "equity": 0.15, "market": 0.12}
WEIGHT_GRID = [(0.30, 0.42, 0.08, 0.20), (0.35, 0.38, 0.10, 0.17), (0.25, 0.50, 0.05, 0.20)]

# Coverage labels.
DESERT_LABEL = "Charging Desert"
ADEQUATE_LABEL = "Adequate Coverage"
UNKNOWN_LABEL = "Unknown"
NO_NETWORK_LABEL = "Unknown / Non-networked"
