"""Fixed values of the common classification and of the supported source layouts.

Everything here is data, not logic: code lists, label texts, lookup rows and
constants that must be exactly these for results to be right.
"""

from __future__ import annotations

# --- Fixed values: common classification -----------------------------------

REST_OF_WORLD = "ROW"

# Not of the classification: the industry of value that has no weights.
UNWEIGHTED = "UNWEIGHTED"

COUNTRIES = (
    "AT", "AU", "BE", "BG", "BR", "CA", "CH", "CN", "CY", "CZ", "DE", "DK",
    "EE", "ES", "FI", "FR", "GB", "GR", "HR", "HU", "ID", "IE", "IN", "IT",
    "JP", "KR", "LT", "LU", "LV", "MT", "MX", "NL", "NO", "PL", "PT", "RO",
    "ROW", "RU", "SE", "SI", "SK", "TR", "US", "ZA",
)

INDUSTRIES = (
    "A01T02", "A03", "BZ", "C10T12", "C13T15", "C16", "C17T18", "C19", "C20",
    "C21", "C22", "C23", "C24", "C25", "C26", "C27", "C28", "C29", "C30", "CM",
    "D35", "EZ", "FZ", "GZ", "H49", "H50", "H51", "H52", "H53", "IZ", "JA",
    "J61", "JC", "KZ", "LZ", "MZ", "NZ", "OZ", "PZ", "QZ", "RZ", "SZ", "TZ",
    "UZ",
)

VALUE_ADDED_COMPONENTS = ("TLS", "VA")

DEMAND_COMPONENTS = ("P3_S13", "P3_S14", "P3_S15", "P51G", "P5M")

# --- Fixed values: crosswalk -------------------------------------------------

# Aggregate regions of the matrix source that are folded into REST_OF_WORLD.
REST_REGIONS = ("WA", "WL", "WE", "WF", "WM", "TW")

# Column names of the one-hot crosswalk file.
CROSSWALK_COUNTRY = "Pays"
CROSSWALK_SOURCE = "Lib"
CROSSWALK_UNUSED = ("vrai_code", "ExioCode", "PaysLib")

# The one source label whose raw industry is overridden, and its override.
EXTRATERRITORIAL_LABEL = "Extra-territorial organizations and bodies"
EXTRATERRITORIAL_CODE = "D99"

# (one-hot column, common industry, flat-file codes)
INDUSTRY_MAP = (
    ("D01T02", "A01T02", ("A01", "A02")),
    ("D03", "A03", ("A03",)),
    ("D05T06", "BZ", ("B",)),
    ("D07T08", "BZ", ("B",)),
    ("D10T12", "C10T12", ("C10T12",)),
    ("D13T15", "C13T15", ("C13T15",)),
    ("D16", "C16", ("C16",)),
    ("D17T18", "C17T18", ("C17", "C18")),
    ("D19", "C19", ("C19",)),
    ("D20", "C20", ("C20",)),
    ("D21", "C21", ("C21",)),
    ("D22", "C22", ("C22",)),
    ("D23", "C23", ("C23",)),
    ("D24", "C24", ("C24",)),
    ("D25", "C25", ("C25",)),
    ("D26", "C26", ("C26",)),
    ("D27", "C27", ("C27",)),
    ("D28", "C28", ("C28",)),
    ("D29", "C29", ("C29",)),
    ("D30", "C30", ("C30",)),
    ("D31T33", "CM", ("C31_32", "C33")),
    ("D35", "D35", ("D35",)),
    ("D36T39", "EZ", ("E36", "E37T39")),
    ("D41T43", "FZ", ("F",)),
    ("D45T47", "GZ", ("G45", "G46", "G47")),
    ("D49", "H49", ("H49",)),
    ("D50", "H50", ("H50",)),
    ("D51", "H51", ("H51",)),
    ("D52", "H52", ("H52",)),
    ("D53", "H53", ("H53",)),
    ("D55T56", "IZ", ("I",)),
    ("D58T60", "JA", ("J58", "J59_60")),
    ("D61", "J61", ("J61",)),
    ("D62T63", "JC", ("J62_63",)),
    ("D64T66", "KZ", ("K64", "K65", "K66")),
    ("D68", "LZ", ("L",)),
    ("D69T75", "MZ", ("M69_70", "M71", "M72", "M73", "M74_75")),
    ("D77T82", "NZ", ("N77", "N78", "N79", "N80T82")),
    ("D84", "OZ", ("O84",)),
    ("D85", "PZ", ("P85",)),
    ("D86T88", "QZ", ("Q86", "Q87_88")),
    ("D90T93", "RZ", ("R90T92", "R93")),
    ("D94T96", "SZ", ("S94", "S95", "S96")),
    ("D97T98", "TZ", ("T",)),
    ("D99", "UZ", ("U",)),
)

# --- Fixed values: wide table source ------------------------------------------

# Sections whose divisions collapse into "<letter>Z".
COLLAPSED_SECTIONS = (
    "B", "E", "F", "G", "I", "K", "L", "M", "N", "O", "P", "Q", "R", "S", "T", "U",
)

# Remaining wide-table codes that differ from the common code.
WIDE_INDUSTRY_CODES = {
    "A01_02": "A01T02",
    "C17_18": "C17T18",
    "C31T33": "CM",
    "D": "D35",
    "J58T60": "JA",
    "J62_63": "JC",
}

WIDE_TOTAL = "OUT"
WIDE_VALUE_ADDED_ROWS = ("VA", "TLS")
WIDE_DEMAND_CODES = ("HFCE", "NPISH", "GGFC", "GFCF", "INVNT", "DPABR")
WIDE_DEMAND_COMPONENTS = {
    "GGFC": "P3_S13",
    "HFCE": "P3_S14",
    "NPISH": "P3_S15",
    "GFCF": "P51G",
}
WIDE_DEMAND_OTHER = "P5M"
WIDE_EMISSIONS_SCOPE = "S1"
WIDE_EMISSIONS_FACTOR = 1000000
WIDE_EMISSIONS_FILE = "DF_SCOPE.csv"
WIDE_FILE_PATTERN = "SML"

# --- Fixed values: flat file source --------------------------------------------

FLAT_VALUE_ADDED_ROWS = ("D21X31", "OP_RES", "OP_NRES", "D1", "D29X39", "B2A3G")
FLAT_TAX_ROW = "D21X31"
FLAT_DEMAND_PATTERN = "P3|P5"
FLAT_EMISSIONS_FACTOR = 1000
FLAT_FILE_PATTERNS = ("ind-by-ind", "csv", "flatfile")
FLAT_EMISSIONS_PATTERN = "greenhouse"
REFERENCE_FLAT_PATTERN = "flatfile_eu-ic-io_ind-by-ind"
REFERENCE_EDITION = "24ed"

# --- Fixed values: matrix source -------------------------------------------------

MATRIX_TAX_LABEL = "Taxes less subsidies on products purchased: Total"
MATRIX_DEMAND_COMPONENTS = {
    "Final consumption expenditure by government": "P3_S13",
    "Final consumption expenditure by households": "P3_S14",
    "Final consumption expenditure by non-profit organisations serving households (NPISH)": "P3_S15",
    "Gross fixed capital formation": "P51G",
    "Changes in inventories": "P5M",
    "Changes in valuables": "P5M",
}
#: What the label columns of a matrix are called in a label line.
MATRIX_LABEL_NAMES = ("category", "component", "country", "extension", "industry", "region", "sector", "stressor", "unit")
MATRIX_EMISSIONS_DIVISOR = 1000
MATRIX_FILES = {
    "flows": "Z.txt",
    "demand": "Y.txt",
    "factors": "factor_inputs/F.txt",
    "emissions": "air_emissions/F.txt",
    "units": "air_emissions/unit.txt",
}

# Global warming potentials (IPCC AR5): a unit that is already CO2 equivalent,
# then the gas named in the stressor; the first match wins, others count 0.
CO2_EQUIVALENT_UNIT = "kg CO2-eq"
GWP_BY_GAS = (("CO2", 1), ("CH4", 28), ("N2O", 265), ("SF6", 23500))

# --- Fixed values: exchange rates and account files ---------------------------------

RATE_LOCATION = "EU27_2020"

ACCOUNT_SEPARATOR = ";"
ACCOUNT_ENCODING = "ISO-8859-1"
ACCOUNT_NULL = "NA"
COMPARISON_FOLDER = "COMPARISON"
