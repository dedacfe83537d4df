"""Names and values of the certificate register.

Fixed values: they have to be exactly these for the results to be right, so they are listed as they
are. Everything that can be derived from another list is derived.
"""

# --- fixed values: columns kept from a raw file -------------------------------------------------
REQUIRED_COLUMNS = [
    "UPRN",
    "LODGEMENT_DATE",
    "CURRENT_ENERGY_RATING",
    "POTENTIAL_ENERGY_RATING",
    "PROPERTY_TYPE",
    "CURRENT_ENERGY_EFFICIENCY",
    "POTENTIAL_ENERGY_EFFICIENCY",
]

NUMERIC_INPUTS = [
    "CURRENT_ENERGY_EFFICIENCY",
    "TOTAL_FLOOR_AREA",
    "NUMBER_HABITABLE_ROOMS",
    "NUMBER_HEATED_ROOMS",
    "CO2_EMISS_CURR_PER_FLOOR_AREA",
    "CO2_EMISSIONS_CURRENT",
    "ENERGY_CONSUMPTION_CURRENT",
    "HEATING_COST_CURRENT",
    "HOT_WATER_COST_CURRENT",
    "LIGHTING_COST_CURRENT",
    "EXTENSION_COUNT",
    "FIXED_LIGHTING_OUTLETS_COUNT",
    "MULTI_GLAZE_PROPORTION",
    "LOW_ENERGY_LIGHTING",
]

COMPONENT_RATINGS = [
    "WALLS_ENERGY_EFF",
    "ROOF_ENERGY_EFF",
    "FLOOR_ENERGY_EFF",
    "WINDOWS_ENERGY_EFF",
    "MAINHEAT_ENERGY_EFF",
    "HOT_WATER_ENERGY_EFF",
    "LIGHTING_ENERGY_EFF",
    "MAINHEATC_ENERGY_EFF",
]

NOMINAL_INPUTS = [
    "PROPERTY_TYPE",
    "BUILT_FORM",
    "TENURE",
    "MAINS_GAS_FLAG",
    "TRANSACTION_TYPE",
    "WALL_TYPE",
]

POTENTIAL_SIDE_NUMBERS = [
    "CO2_EMISSIONS_POTENTIAL",
    "ENERGY_CONSUMPTION_POTENTIAL",
    "HEATING_COST_POTENTIAL",
]

OTHER_TEXT_COLUMNS = ["CONSTRUCTION_AGE_BAND", "WALLS_DESCRIPTION", "REGION", "COUNTRY"]

# Columns that define or give away the label; never a model input.
LEAKING_COLUMNS = [
    "POTENTIAL_ENERGY_EFFICIENCY",
    "POTENTIAL_ENERGY_RATING",
    "EFFICIENCY_GAP",
    "RETROFIT_POTENTIAL",
]

# --- fixed values: domains ----------------------------------------------------------------------
RATINGS_BEST_FIRST = ["A", "B", "C", "D", "E", "F", "G"]
LOW_RATINGS = ["D", "E", "F", "G"]
PROPERTY_TYPES = ["House", "Flat", "Maisonette", "Bungalow", "Park home"]
COMPONENT_LEVELS = ["N/A", "Very Poor", "Poor", "Average", "Good", "Very Good"]
SCORE_RANGE = (1, 100)
GAP_THRESHOLD = 20
AGE_PREFIX = "England and Wales: "

# Band name, first year, last year, midpoint used as a number.
AGE_BANDS = [
    ("before 1900", -1, 1899, 1880),
    ("1900-1929", 1900, 1929, 1915),
    ("1930-1949", 1930, 1949, 1940),
    ("1950-1966", 1950, 1966, 1958),
    ("1967-1975", 1967, 1975, 1971),
    ("1976-1982", 1976, 1982, 1979),
    ("1983-1990", 1983, 1990, 1987),
    ("1991-1995", 1991, 1995, 1993),
    ("1996-2002", 1996, 2002, 1999),
    ("2003-2006", 2003, 2006, 2005),
    ("2007-2011", 2007, 2011, 2009),
    ("2012 onwards", 2012, 3000, 2015),
]

# Texts that a pandas CSV reader takes as missing (its documented default list).
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Columns of the correlation table.
CORRELATION_COLUMNS = [
    "CURRENT_ENERGY_EFFICIENCY", "TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS", "CO2_EMISS_CURR_PER_FLOOR_AREA",
    "CO2_EMISSIONS_CURRENT", "HEATING_COST_CURRENT", "ENERGY_CONSUMPTION_CURRENT", "NUMBER_HEATED_ROOMS",
    "MULTI_GLAZE_PROPORTION", "LOW_ENERGY_LIGHTING", "RETROFIT_POTENTIAL",
]

# Outcome -> number of example rows shown.
EXAMPLE_QUOTAS = {"correct_positive": 3, "correct_negative": 3, "error": 2}

# Threshold grids, in hundredths so that no float drift enters.
SWEEP_HUNDREDTHS = [50, 45, 40, 35, 30, 25, 20, 15]
TUNING_HUNDREDTHS = range(5, 55)
DEFAULT_HUNDREDTHS = 50

# --- derived ------------------------------------------------------------------------------------
NON_NEGATIVE_COLUMNS = list(NUMERIC_INPUTS)
# The preparation step checks the same list without the score, which has its own range check.
NON_NEGATIVE_RAW = [c for c in NUMERIC_INPUTS if c != "CURRENT_ENERGY_EFFICIENCY"]
NUMBER_COLUMNS = NUMERIC_INPUTS + ["POTENTIAL_ENERGY_EFFICIENCY"] + POTENTIAL_SIDE_NUMBERS
RATINGS_WORST_FIRST = RATINGS_BEST_FIRST[::-1]
RAW_NOMINAL = [c for c in NOMINAL_INPUTS if c != "WALL_TYPE"]
WANTED_COLUMNS = list(
    dict.fromkeys(
        REQUIRED_COLUMNS
        + RAW_NOMINAL
        + OTHER_TEXT_COLUMNS
        + NUMERIC_INPUTS
        + POTENTIAL_SIDE_NUMBERS
        + COMPONENT_RATINGS
    )
)
CORRELATION_LABELS = {c: c.replace("_", " ").lower() for c in CORRELATION_COLUMNS}
AGE_BAND_ORDER = [name for name, *_ in AGE_BANDS]
AGE_MIDPOINTS = {AGE_PREFIX + name: mid for name, _, _, mid in AGE_BANDS}
