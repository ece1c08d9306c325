"""Fixed values of the listing domain.

Everything in the block below must equal what the source listing pipeline
uses, or results differ. They are stated plainly, in their natural order.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference behaviour exactly)
# ---------------------------------------------------------------------------

# Non-residential categories, keyed on the listing's category name.
EXCLUDED_CATEGORIES = ("Commercial Property", "Land")

# The closed set of category names the listing source emits.
ALLOWED_CATEGORIES = ("Apartment / Condominium", "House", "Room", "Commercial Property", "Land")

# Text decorations added when a listing item is flattened, and removed again by cleaning.
RENT_PREFIX = "RM "
RENT_SUFFIX = " per month"
SIZE_SUFFIX = " sq.ft."
CATEGORY_SUFFIX = ", For rent"
COUNTRY = "Malaysia"

# Availability re-check cadence: (age in days strictly below, interval in days); None = catch-all.
RECHECK_DECAY = [(7, 1), (21, 3), (None, 7)]

# Format of ad_expiry (Spark datetime pattern for "%Y-%m-%d %H:%M:%S").
AD_EXPIRY_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Format of scrape / check dates (only the first 10 characters count).
DAY_FORMAT = "yyyy-MM-dd"

# Output format of the published date.
PUBLISHED_OUT_FORMAT = "MM/dd/yyyy"

# Listing statuses.
STATUS_ACTIVE = "active"
STATUS_RENTED = "rented"
STATUS_EXPIRED = "expired"
TERMINAL_STATUSES = (STATUS_RENTED, STATUS_EXPIRED)

# Standard property type for anything unmapped.
DEFAULT_STANDARD_TYPE = "Other"

# Marker in the file name of combined per-state snapshots (not re-processed).
COMBINED_MARKER = "_ALL_"

# Search page size and the depth after which the source returns nothing.
PAGE_SIZE = 200
OFFSET_CAP = 9984

# Raw property type -> standard type, in file order (duplicates: last wins).
TYPE_MAPPING = [
    ("Condominium", "Condominium"),
    ("Service Residence", "Condominium"),
    ("Apartment", "Apartment"),
    ("Apartment / Flat", "Apartment"),
    ("Flat", "Apartment"),
    ("Studio", "Apartment"),
    ("Duplex", "Apartment"),
    ("Townhouse Condo", "Condominium"),
    ("Condo / Services residence / Penthouse / Townhouse", "Condominium"),
    ("2-storey Terraced House", "Terraced House"),
    ("1-storey Terraced House", "Terraced House"),
    ("3-storey Terraced House", "Terraced House"),
    ("2.5-storey Terraced House", "Terraced House"),
    ("1.5-storey Terraced House", "Terraced House"),
    ("3.5-storey Terraced House", "Terraced House"),
    ("Terraced House", "Terraced House"),
    ("Semi-Detached House", "Semi-Detached"),
    ("Bungalow House", "Bungalow"),
    ("Link Bungalow", "Bungalow"),
    ("Zero-Lot Bungalow", "Bungalow"),
    ("Twin Courtyard Villa", "Bungalow"),
    ("Twin Villas", "Bungalow"),
    ("Townhouse", "Townhouse"),
    ("Cluster House", "Cluster House"),
    ("Houses", "House"),
    ("Residential", "House"),
    ("Shoplot", "Shoplot"),
    ("Shop lot", "Shoplot"),
    ("Sharing a house / Flat", "Room"),
    ("Others", "Other"),
]

# State slug -> source region code.
REGION_CODES = {
    "johor": "12",
    "kedah": "2",
    "kelantan": "4",
    "kuala-lumpur": "9",
    "labuan": "17",
    "melaka": "11",
    "negeri-sembilan": "10",
    "pahang": "7",
    "penang": "3",
    "perak": "6",
    "perlis": "1",
    "putrajaya": "16",
    "sabah": "14",
    "sarawak": "13",
    "selangor": "8",
    "terengganu": "5",
}

# Residential property type id -> name (the slices pulled per state).
RESIDENTIAL_PROPERTY_TYPE_IDS = {
    1: "Condominium",
    2: "Apartment",
    3: "Others",
    4: "Flat",
    5: "Service Residence",
    6: "Studio",
    7: "Duplex",
    8: "Townhouse Condo",
    11: "Bungalow House",
    12: "1-storey Terraced House",
    13: "2-storey Terraced House",
    14: "2.5-storey Terraced House",
    15: "3-storey Terraced House",
    16: "Semi-Detached House",
    17: "Others",
    18: "Townhouse",
    19: "1.5-storey Terraced House",
    41: "Condo / Services residence / Penthouse / Townhouse",
    42: "Apartment / Flat",
    43: "Houses",
    44: "Shoplot",
    45: "Sharing a house / Flat",
    46: "Others",
    111: "Link Bungalow",
    112: "Zero-Lot Bungalow",
    113: "Cluster House",
    114: "Terraced House",
    115: "Twin Villas",
    117: "3.5-storey Terraced House",
}

# Fields every listing item of a healthy page carries on at least one row.
REQUIRED_FIELDS = [
    "list_id", "monthly_rent", "price_label", "property_type_name", "property_type_id",
    "category_name", "region_name", "subarea_name", "rooms_name", "bathroom_name",
    "size", "adview_url", "ad_expiry", "date",
]

# Column set compared by the content-duplicate delete.
CONTENT_DEDUP_COLUMNS = [
    "monthly_rent", "property_type", "state", "region", "rooms", "bathroom", "size",
    "address", "publishedDatetime",
]

# Texts a pandas CSV read turns into missing values (pandas' documented defaults).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

# Chosen here: a rough bounding box of the country, for the coordinate sanity check.
BBOX_LAT = (0.5, 7.5)
BBOX_LON = (99.5, 119.5)
