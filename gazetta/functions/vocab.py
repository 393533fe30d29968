"""Word lists and patterns that decide results. Any change changes answers."""

from __future__ import annotations

# Suffixes, prefixes and descriptors, each list applied in order.
JURISDICTION_SUFFIXES = [
    (r"\s+County$", "County"),
    (r"\s+Township$", "Township"),
    (r"\s+Twp\.?$", "Township"),
    (r"\s+Parish$", "Parish"),
    (r"\s+Borough$", "Borough"),
    (r"\s+Co\.?$", "County"),
]
DIRECTIONS = ["north", "south", "east", "west", "northeast", "northwest", "southeast", "southwest"]
LEADING_PHRASES = [
    r"^(?:north|south|east|west|northeast|northwest|southeast|southwest)\s+of\s+",
    r"^near\s+",
    r"^(?:rural|suburban)\s+",
]
UNFILTERED_PREFIX = r"^territory\s+of\s+"
JURISDICTION_PREFIXES = ["County", "Parish", "Borough", "Township", "Town", "City", "District", "Village", "State", "Province"]
TRAILING_DESCRIPTORS = [
    r"\s+(?:area|district|community|region|vicinity|neighborhood)$",
    r"\s+R\.?\s?D\.?\s*\d*$",
    r"\s+Route\s+\d+$",
    r"\s+R\.?\s?R\.?\s*\d*$",
]
COMPOUND = (r"Washington\s*,\s*(?:D\.?\s*C\.?\s*(?:,\s*District\s+of\s+Columbia)?|District\s+of\s+Columbia)", "Washington D.C.")
CARDINAL_PREFIX = r"^(?:(?:upper|lower)\s+)?(?:north|south|east|west|northeast|northwest|southeast|southwest)\s+"
NOISE = r"^(?:Route|Rt\.?|R\.?\s?D\.?|R\.?\s?R\.?)\s*\d*$"
PREFIX_SWAPS = [("Saint", "St"), ("Fort", "Ft"), ("Mount", "Mt")]
SPACING_PREFIXES = ["De", "La", "Le", "Du", "Van", "Del", "Los", "Las", "San"]
PLACE_PREFIX = r"^(?:fort|ft\.?|mount|mt\.?|saint|st\.?|lake|port|cape)\s+"
SPATIAL_PREPOSITIONS = ["near", "from", "outside", "at", "in", "to"]
SEGMENT_STOPWORDS = [*SPATIAL_PREPOSITIONS, "of", "the", "a", "an", "and"]
# Traces of text decoded with the wrong code page.
CORRUPTION = "[ΓG]Ç|\\+¦|[─-╿]|Γ[\u0080-ÿ]|[ÃÂ][\u0080-¿]"

# Words for kinds of places.
JURISDICTION_WORDS = ["county", "township", "parish", "borough", "town", "city", "district", "village", "state", "province", "twp", "co", "ward", "precinct", "municipality", "municipio", "prov"]
FEATURE_WORDS = [
    "station", "church", "cemetery", "farm", "home", "residence", "hospital", "river", "creek", "lake", "island", "beach",
    "hill", "valley", "mountain", "park", "area", "place", "community", "camp", "mission", "school", "hotel", "depot",
    "mine", "bridge", "road", "street", "avenue", "junction", "crossing", "landing", "corner", "center", "centre", "grove",
]
APPELLATIVES = [*JURISDICTION_WORDS, *FEATURE_WORDS]
PREFERRED_JURISDICTIONS = ["City", "Town", "Borough", "Village", "Comune", "Kommune", "Municipality"]
FILTERED_JURISDICTIONS = ["Township", "County", "Municipio", "Parish", "District", "Arrondissement"]

# Abbreviations of states and provinces, and what they stand for.
ABBREVIATIONS = {
    "al": ["Alabama"], "ak": ["Alaska"], "az": ["Arizona"], "ar": ["Arkansas"], "ca": ["California"], "co": ["Colorado"],
    "ct": ["Connecticut"], "de": ["Delaware"], "fl": ["Florida"], "ga": ["Georgia"], "hi": ["Hawaii"], "id": ["Idaho"],
    "il": ["Illinois"], "in": ["Indiana"], "ia": ["Iowa"], "ks": ["Kansas"], "ky": ["Kentucky"], "la": ["Louisiana"],
    "me": ["Maine"], "md": ["Maryland"], "ma": ["Massachusetts"], "mi": ["Michigan"], "mn": ["Minnesota"],
    "ms": ["Mississippi"], "mo": ["Missouri"], "mt": ["Montana"], "ne": ["Nebraska"], "nv": ["Nevada"],
    "nh": ["New Hampshire"], "nj": ["New Jersey"], "nm": ["New Mexico"], "ny": ["New York"], "nc": ["North Carolina"],
    "nd": ["North Dakota"], "oh": ["Ohio"], "ok": ["Oklahoma"], "or": ["Oregon"], "pa": ["Pennsylvania"],
    "ri": ["Rhode Island"], "sc": ["South Carolina"], "sd": ["South Dakota"], "tn": ["Tennessee"], "tx": ["Texas"],
    "ut": ["Utah"], "vt": ["Vermont"], "va": ["Virginia"], "wa": ["Washington"], "wv": ["West Virginia"],
    "wi": ["Wisconsin"], "wy": ["Wyoming"], "dc": ["Washington D.C."],
    "pr": ["Puerto Rico"], "gu": ["Guam"], "vi": ["Virgin Islands"], "as": ["American Samoa"],
    "ala": ["Alabama"], "cal": ["California"], "calif": ["California"], "colo": ["Colorado"], "conn": ["Connecticut"],
    "del": ["Delaware"], "fla": ["Florida"], "ill": ["Illinois"], "ind": ["Indiana"], "kan": ["Kansas"], "kas": ["Kansas"],
    "kans": ["Kansas"], "ken": ["Kentucky"], "mass": ["Massachusetts"], "minn": ["Minnesota"], "miss": ["Mississippi"],
    "neb": ["Nebraska"], "nebr": ["Nebraska"], "nev": ["Nevada"], "okla": ["Oklahoma"], "ore": ["Oregon"],
    "oreg": ["Oregon"], "penn": ["Pennsylvania"], "penna": ["Pennsylvania"], "tenn": ["Tennessee"], "tex": ["Texas"],
    "vir": ["Virginia"], "wash": ["Washington"], "wis": ["Wisconsin"], "wisc": ["Wisconsin"], "wyo": ["Wyoming"],
    "ab": ["Alberta"], "mb": ["Manitoba"], "nb": ["New Brunswick"], "ns": ["Nova Scotia"], "on": ["Ontario"],
    "pe": ["Prince Edward Island"], "qc": ["Quebec"], "sk": ["Saskatchewan"], "nt": ["Northwest Territories"],
    "nu": ["Nunavut"], "yt": ["Yukon"],
    "nsw": ["New South Wales"], "qld": ["Queensland"], "vic": ["Victoria"], "tas": ["Tasmania"],
    "act": ["Australian Capital Territory"],
    "ags": ["Aguascalientes"], "bcs": ["Baja California Sur"], "camp": ["Campeche"], "chis": ["Chiapas"],
    "chih": ["Chihuahua"], "coah": ["Coahuila de Zaragoza"], "col": ["Colima"], "dgo": ["Durango"], "gto": ["Guanajuato"],
    "gro": ["Guerrero"], "hgo": ["Hidalgo"], "jal": ["Jalisco"], "mex": ["Mexico"], "mor": ["Morelos"], "nay": ["Nayarit"],
    "oax": ["Oaxaca"], "pue": ["Puebla"], "qro": ["Queretaro de Arteaga"], "qroo": ["Quintana Roo"],
    "slp": ["San Luis Potosi"], "sin": ["Sinaloa"], "son": ["Sonora"], "tab": ["Tabasco"], "tamps": ["Tamaulipas"],
    "tlax": ["Tlaxcala"], "ver": ["Veracruz-Llave"], "yuc": ["Yucatan"], "zac": ["Zacatecas"],
    "bc": ["British Columbia", "Baja California"],
    "mich": ["Michigan", "Michoacan de Ocampo"],
    "nl": ["Newfoundland and Labrador", "Nuevo Leon"],
}
COUNTRIES = {
    "us": "USA", "u.s.": "USA", "u.s.a.": "USA", "united states": "USA", "united states of america": "USA",
    "uk": "United Kingdom", "u.k.": "United Kingdom", "great britain": "United Kingdom", "gb": "United Kingdom",
}

# What an outcome is worth, and how a candidate was found.
CONFIDENCE = {
    "mnt_full_string": "high", "chain_verified": "high", "single_term": "high", "parent_resolved": "high",
    "freq_resolved": "medium", "chain_verified_proximity": "medium", "single_amb": "low", "chain_amb": "low",
    "parent_amb": "low", "parent_rejected": "low", "low_evidence": "low", "illegible": "none",
}
KIND = {"single_amb": "tie", "chain_amb": "tie", "parent_amb": "tie", "parent_rejected": "suspect", "low_evidence": "suspect"}
METHOD = {
    "mnt": "verbatim", "exact": "verbatim", "abbrev": "normalized", "variant": "normalized", "transform": "normalized",
    "transform_variant": "normalized", "cardinal_strip": "normalized", "preposition": "normalized",
    "ascii_fold": "normalized", "spelling": "fuzzy", "fs": "external",
}
LEVEL_LABELS = {1: "Street", 2: "Neighborhood", 3: "Borough", 4: "City", 5: "County", 6: "State", 7: "Country Region", 8: "Country", 9: "Region", 10: "Kingdom", 11: "Continent"}
BANDS = ["head", "mid", "low", "tail"]

# Limits.
MIN_SPELLING_LENGTH = 5
MAX_CANDIDATES = 5
PROXIMITY_KM = 50.0
EARTH_KM = 6371.0
FREQUENCY_LEAST, FREQUENCY_RATIO = 10, 5
CHAIN_HOPS, SCOPE_HOPS = 10, 15
LEVEL_LEAST, LEVEL_MOST = 3, 10
CONTAINER_LEVEL = 6
SPAN_WORDS, INPUT_WORDS, TAIL_LEVEL = 6, 12, 6
