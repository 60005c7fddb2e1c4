"""Fixed values of the data model: column orders, controlled words, thresholds and patterns."""

from __future__ import annotations

# --- fixed values: source snapshot ------------------------------------------------------------

SOURCE_COLUMNS = (
    "id",
    "ident",
    "type",
    "name",
    "latitude_deg",
    "longitude_deg",
    "elevation_ft",
    "continent",
    "iso_country",
    "iso_region",
    "municipality",
    "scheduled_service",
    "gps_code",
    "icao_code",
    "iata_code",
    "local_code",
    "home_link",
    "wikipedia_link",
    "keywords",
)

PLACE_TYPES = (
    "large_airport",
    "medium_airport",
    "small_airport",
    "heliport",
    "seaplane_base",
    "balloonport",
    "closed",
)
CONTINENTS = ("AF", "AN", "AS", "EU", "NA", "OC", "SA")
SCHEDULED_VALUES = ("yes", "no")
TARGET_TYPES = ("large_airport", "medium_airport")

MIN_ROWS = 50_000
MIN_LARGE = 1_000
ERROR_TEXT_LIMIT = 2000

# --- fixed values: names and archive ----------------------------------------------------------

NAME_COLUMNS = (
    "id",
    "ident",
    "type",
    "iata_code",
    "icao_code",
    "name",
    "name_zh",
    "name_zh_source",
    "name_zh_status",
    "municipality",
    "municipality_zh",
    "municipality_zh_source",
    "municipality_zh_status",
    "location_zh",
    "location_zh_source",
)
ARCHIVE_COLUMNS = ("id", "ident", "name", "name_zh", "source")
ATTACHED_NAME_COLUMNS = (
    "name_zh",
    "name_zh_source",
    "municipality_zh",
    "municipality_zh_source",
    "location_zh",
    "location_zh_source",
)
RESOLVED = "resolved"
UNRESOLVED = "unresolved"

# --- fixed values: matching and labels --------------------------------------------------------

EARTH_RADIUS_KM = 6371.0088
MAX_DISTANCE_KM = 25.0
AMBIGUITY_KM = 1.0
CODE_PROPERTIES = {"P238": "iata_code", "P239": "icao_code"}

LABEL_LANGUAGES = ("zh-cn", "zh-hans", "zh", "zh-hant", "zh-tw", "zh-hk")
TRADITIONAL_LANGUAGES = ("zh-hant", "zh-tw", "zh-hk")
CJK_PATTERN = r"[\x{4e00}-\x{9fff}]"
LATIN_RUN_PATTERN = r"[A-Za-z]{4,}"
POINT_PATTERN = r"Point\(([-0-9.eE]+)\s+([-0-9.eE]+)\)"
MAX_NAME_LENGTH = 40
REPLY_BATCH_SIZE = 100

SETTLEMENT_HINTS = (
    "populated places",
    "populated place",
    "cities",
    "city",
    "towns",
    "town",
    "municipalities",
    "municipality",
    "villages",
    "village",
    "census-designated places",
    "districts",
    "district",
    "neighborhoods",
    "suburbs",
    "boroughs",
    "communes",
    "settlements",
    "counties",
)

KIND_ZH = {
    "seaplane base": "水上飞机基地",
    "air force base": "空军基地",
    "air base": "空军基地",
    "heliport": "直升机场",
    "airfield": "机场",
    "aerodrome": "机场",
    "airpark": "机场",
    "airstrip": "简易机场",
    "landing strip": "简易机场",
    "airport": "机场",
}
NAME_MODIFIERS = (
    "International",
    "Regional",
    "Municipal",
    "National",
    "Public",
    "County",
    "City",
    "Provincial",
    "Civil",
    "Domestic",
    "Military",
    "Private",
)

# --- fixed values: explore and publish --------------------------------------------------------

DEFAULT_TYPES = ("large_airport", "medium_airport", "seaplane_base", "balloonport")
COARSE_TYPES = ("large_airport", "medium_airport", "seaplane_base", "balloonport")
BASEMAPS = ("satellite", "street", "wireframe")
HAYSTACK_COLUMNS = (
    "name",
    "name_zh",
    "ident",
    "iata_code",
    "icao_code",
    "gps_code",
    "local_code",
    "municipality",
    "municipality_zh",
    "location_zh",
    "keywords",
    "iso_country",
)
PUBLISHED_FIELDS = SOURCE_COLUMNS + ATTACHED_NAME_COLUMNS
PUBLISHED_NUMBERS = ("id", "latitude_deg", "longitude_deg", "elevation_ft")
PUBLISHED_REQUIRED = ("id", "ident", "type", "name", "latitude_deg", "longitude_deg")
SCHEMA_VERSION = 1
TOP_COUNTRIES = 80

# --- fixed values: globe and grid -------------------------------------------------------------

GLOBE_RADIUS = 100.0
POINT_ALTITUDE = 0.012
FACING_FACTOR = 0.92
CELL_SIZE = 0.5
PICK_RINGS = (1, 2, 4)
METRES_PER_FOOT = 0.3048

# --- fixed values: boundary layers ------------------------------------------------------------

# layer, level, tolerance, smallest outer area, decimals
LEVEL_SPECS = (
    ("countries", "coarse", 0.02, 2.0, 2),
    ("countries", "medium", 0.01, 0.05, 3),
    ("countries", "fine", 0.003, 0.002, 4),
    ("provinces", "medium", 0.01, 0.05, 3),
    ("provinces", "fine", 0.008, 0.02, 4),
    ("districts", "fine", 0.004, 0.004, 4),
)
LAYER_ALTITUDE = {"countries": 0.004, "provinces": 0.0035, "districts": 0.003}
ISO_PROPERTIES = ("ISO_A2", "iso_a2", "ADM0_A3", "adm0_a3", "SOV_A3")
NAME_PROPERTIES = ("NAME", "name", "NAME_ZH", "NAME", "ADMIN", "adm1_name")
BOUNDARY_ATTRIBUTION = "Natural Earth (public domain)"

# --- fixed values: current-state table --------------------------------------------------------

STATE_COLUMNS = SOURCE_COLUMNS + (
    "name_zh",
    "municipality_zh",
    "name_zh_source",
    "name_zh_updated_at",
    "row_hash",
    "is_active",
    "first_seen_at",
    "last_seen_at",
    "deactivated_at",
    "updated_at",
    "source_snapshot_at",
    "municipality_zh_source",
    "location_zh",
    "location_zh_source",
)
ACTIVE_VIEW_COLUMNS = SOURCE_COLUMNS + (
    "name_zh",
    "municipality_zh",
    "name_zh_source",
    "name_zh_updated_at",
    "first_seen_at",
    "last_seen_at",
    "updated_at",
    "source_snapshot_at",
    "municipality_zh_source",
    "location_zh",
    "location_zh_source",
)

# --- fixed values: white space ----------------------------------------------------------------

# Code point ranges that count as white space, ends included.
WHITESPACE_RANGES = (
    (0x09, 0x0D),
    (0x1C, 0x20),
    (0x85, 0x85),
    (0xA0, 0xA0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
)
WHITESPACE = "".join(
    chr(code) for first, last in WHITESPACE_RANGES for code in range(first, last + 1)
)
SPACE_PATTERN = (
    "["
    + "".join(rf"\x{{{first:x}}}-\x{{{last:x}}}" for first, last in WHITESPACE_RANGES)
    + "]"
)
