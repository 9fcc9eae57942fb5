"""Lookup tables used by the column functions.

They are plain data so a caller can pass another mapping (for example a
FIPS-keyed one) to any function that takes ``mapping=``.
"""

from __future__ import annotations

# --- fixed values: must equal the reference's lookup tables -----------------
# Country code -> world region (82 codes).  Anything else (and NULL) is "Other".
REGION_BY_COUNTRY = {
    "US": "North America", "CA": "North America", "MX": "North America", "GT": "North America",
    "HN": "North America", "NI": "North America", "CR": "North America", "PA": "North America",
    "CU": "North America",
    "BR": "South America", "AR": "South America", "CO": "South America", "PE": "South America",
    "CL": "South America", "VE": "South America", "EC": "South America", "BO": "South America",
    "PY": "South America", "UY": "South America", "GY": "South America", "SR": "South America",
    "GB": "Europe", "DE": "Europe", "FR": "Europe", "IT": "Europe", "ES": "Europe", "PT": "Europe",
    "NL": "Europe", "BE": "Europe", "PL": "Europe", "SE": "Europe", "NO": "Europe", "FI": "Europe",
    "DK": "Europe", "IE": "Europe", "AT": "Europe", "CH": "Europe", "GR": "Europe", "RO": "Europe",
    "CZ": "Europe", "HU": "Europe", "UA": "Europe", "RU": "Europe",
    "CN": "Asia", "JP": "Asia", "KR": "Asia", "IN": "Asia", "PK": "Asia", "BD": "Asia",
    "ID": "Asia", "PH": "Asia", "VN": "Asia", "TH": "Asia", "MY": "Asia", "SG": "Asia",
    "TW": "Asia", "AF": "Asia", "IR": "Asia", "IQ": "Asia", "SA": "Asia", "AE": "Asia",
    "IL": "Asia", "TR": "Asia",
    "EG": "Africa", "NG": "Africa", "ZA": "Africa", "KE": "Africa", "ET": "Africa", "GH": "Africa",
    "TZ": "Africa", "UG": "Africa", "DZ": "Africa", "MA": "Africa", "TN": "Africa", "LY": "Africa",
    "SD": "Africa", "CM": "Africa", "CI": "Africa", "SN": "Africa",
    "AU": "Oceania", "NZ": "Oceania", "FJ": "Oceania",
}

# Country code -> continent (23 codes).
CONTINENT_BY_COUNTRY = {
    "US": "North America", "CA": "North America", "MX": "North America",
    "BR": "South America", "AR": "South America", "CO": "South America",
    "GB": "Europe", "DE": "Europe", "FR": "Europe", "IT": "Europe", "ES": "Europe", "RU": "Europe",
    "UA": "Europe",
    "CN": "Asia", "JP": "Asia", "IN": "Asia", "KR": "Asia",
    "EG": "Africa", "NG": "Africa", "ZA": "Africa", "KE": "Africa",
    "AU": "Oceania", "NZ": "Oceania",
}

# Three-letter actor type prefix -> label.
ACTOR_TYPE_LABELS = {
    "GOV": "Government", "MIL": "Military", "REB": "Rebel",
    "OPP": "Opposition", "PTY": "Political Party", "JUD": "Judiciary",
    "BUS": "Business", "EDU": "Education", "MED": "Media",
    "REL": "Religious", "NGO": "NGO", "IGO": "IGO",
    "CVL": "Civilian", "REF": "Refugee", "CRM": "Criminal",
    "DEV": "Development", "ELI": "Elite", "LAB": "Labor",
    "SPY": "Intelligence", "UNK": "Unknown",
}

# Continent of a GKG document from its Locations text: the first rule whose
# country code appears as ",XX," wins, in this order.
LOCATION_CONTINENT_RULES = [
    ("North America", ["US", "CA"]),
    ("South America", ["BR"]),
    ("Europe", ["GB", "DE", "FR"]),
    ("Asia", ["CN", "IN", "JP"]),
    ("Africa", ["NG", "ZA", "EG"]),
]

# QuadClass groups.
CONFLICT_CLASSES = (3, 4)
DIPLOMATIC_CLASSES = (1, 2)

# Field values read as missing by the delimited scan (besides the empty field).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# --- end of fixed values -------------------------------------------------------

OTHER = "Other"

