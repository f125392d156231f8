"""Fixed values of the racing domain: word lists, bin edges and rates.

These decide results, so they are stated as plain text and never derived.
"""

# --- fixed values: weather descriptions -------------------------------------
RAINY = [
    "pochmurno, przel deszcz",
    "pochmurno, deszcz",
    "pochm z przej, przel deszcz",
    "pochmurno, przelotny deszcz",
    "deszcz",
    "pochmurno, opady deszczu",
    "pochmurno, przelotne opady deszczu",
    "pochmurno, przel opady",
    "pochmurno z przejaśnieniami, przelotny deszcz",
    "burzowo",
    "deszczowo",
]
SUNNY = ["pogodnie", "słonecznie", "pogodnie, słonecznie"]
HOT = ["upalnie"]
CLOUDY = [
    "pochmurno",
    "pochm z przej",
    "pochmurno z przejaśnieniami",
    "pochmurno z przejasnieniami",
    "pochmurno z przej",
]
FOGGY = ["mgliście", "mgła", "mglisto"]
WEATHER_FLAGS = {
    "is_rainy": RAINY,
    "is_sunny": SUNNY,
    "is_hot": HOT,
    "is_cloudy": CLOUDY,
    "is_foggy": FOGGY,
}

# --- fixed values: track surfaces (label -> column suffix) -------------------
SURFACES = {
    "lekko elastyczny": "lekko_elastyczny",
    "elastyczny": "elastyczny",
    "mocno elastyczny": "mocno_elastyczny",
    "lekki": "lekki",
    "dobry": "dobry",
    "miękki": "miekki",
    "ciężki": "ciezki",
}
# The first feature version also keeps the hard surface as its own category.
SURFACE_CATEGORIES = [*SURFACES, "twardy"]

# --- fixed values: winning style, hardest (1) to easiest (8) -----------------
STYLE_EASE = {
    "w walce": 1,
    "po walce": 2,
    "silnie wysyłany": 3,
    "wysyłany": 4,
    "pewnie": 5,
    "łatwo": 6,
    "lekko": 6,
    "bardzo łatwo": 7,
    "dowolnie": 8,
}

# --- fixed values: one-hot vocabularies --------------------------------------
SEXES = {"STALLION": "is_stallion", "MARE": "is_mare", "GELDING": "is_gelding"}
BREEDS = {
    "THOROUGHBRED": "breed_thoroughbred",
    "ARABIAN": "breed_arabian",
    "STANDARDBRED": "breed_standardbred",
    "ANGLO_ARABIAN": "breed_anglo_arabian",
}
COLORS = ["gniada", "siwa", "kasztanowata", "ciemnogniada", "skarogniada", "kara"]
RACE_GROUPS = {
    "GROUP_I": "group_I",
    "GROUP_II": "group_II",
    "GROUP_III": "group_III",
    "GROUP_IV": "group_IV",
    "GROUP_NONE": "group_NONE",
    "SLED": "group_SLED",
    "HURDLE": "group_HURDLE",
    "STEEPLECHASE": "group_STEEPLECHASE",
    "TRIAL": "group_TRIAL",
}
# Country is stored as alpha-3, so the flag accepts both spellings.
POLAND_CODES = ["PL", "POL"]
WARSAW = "Warsaw"

# --- fixed values: distance bands in metres (suffix -> inclusive low, high) --
RACE_BANDS = {
    "l1200": (None, 1200),
    "1200_1799": (1201, 1799),
    "1800_2399": (1800, 2399),
    "2400_3000": (2400, 3000),
    "m3000": (3001, None),
}
# Jockey bands put exactly 1200 m in the second band; trainers use RACE_BANDS.
JOCKEY_BANDS = {**RACE_BANDS, "l1200": (None, 1199), "1200_1799": (1200, 1799)}

# --- fixed values: first feature version's bins ------------------------------
DISTANCE_BUCKETS = {
    "very_long": (2901, None),
    "long": (2300, 2900),
    "medium": (1700, 2299),
    "short": (1100, 1699),
    "very_short": (None, 1099),
}
TEMP_RANGE = (-50.0, 50.0)
MAX_JOCKEY_WEIGHT = 100.0
# Upper edge -> label. An edge of 0 means "exactly nothing won".
PRIZE_BUCKETS = [
    (1200, "p_1_1200"),
    (1800, "p_1201_1800"),
    (2400, "p_1801_2400"),
    (3200, "p_2401_3200"),
    (7000, "p_3201_7000"),
    (12000, "p_7001_12000"),
    (16000, "p_12001_16000"),
]
# Days are below the edge; the last edge is inclusive.
REST_BUCKETS = [
    (7, "rest_0_7"),
    (14, "rest_7_14"),
    (21, "rest_14_21"),
    (28, "rest_21_28"),
    (60, "rest_28_60"),
    (180, "rest_60_180"),
    (366, "rest_180_365"),
]

# --- fixed values: payout codes in the payment text --------------------------
PAYOUT_CODES = ["ZWC", "PDK", "DWJ", "TRJ", "CZW"]

# --- fixed values: exchange rates to PLN -------------------------------------
FX_TO_PLN = {
    "pln": 1.0,
    "zł": 1.0,
    "zl": 1.0,
    "eur": 4.25,
    "€": 4.25,
    "Kč": 0.18,
    "czk": 0.18,
    "Skr": 0.42,
    "Ft": 0.011,
    "huf": 0.011,
    "AED": 1.16,
    "aed": 1.16,
    "$": 4.0,
}

# --- fixed values: letters that have no decomposed form ----------------------
STROKE_LETTERS, STROKE_PLAIN = "łŁ", "lL"
