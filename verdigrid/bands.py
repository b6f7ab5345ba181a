"""Band and channel layout."""

# The optical band codes and the names they get, in order.
S2_CODES = ["B1", "B2", "B3", "B4", "B5", "B6", "B7", "B8", "B8A", "B9", "B11", "B12"]
S2_BANDS = ["coastal", "blue", "green", "red", "red_edge1", "red_edge2", "red_edge3", "nir",
            "red_edge4", "water_vapor", "swir1", "swir2"]
S1_CODES = ["VV", "VH"]
S1_BANDS = ["vv", "vh"]

BANDS = S2_BANDS + S1_BANDS
MONTHS = list(range(1, 13))
FILL_BAND = "FILL_MASK"

# Channel groups of the model input, their channel names, and which ones are supplied.
CHANNEL_GROUPS = [
    ("S1", ["vv", "vh"], True),
    ("S2_RGB", ["red", "green", "blue"], True),
    ("S2_Red_Edge", ["red_edge1", "red_edge2", "red_edge3"], True),
    ("S2_NIR_10m", ["nir"], True),
    ("S2_NIR_20m", ["red_edge4"], True),
    ("S2_SWIR", ["swir1", "swir2"], True),
    ("ERA5", ["era5_0", "era5_1"], False),
    ("SRTM", ["srtm_0", "srtm_1"], False),
    ("NDVI", ["ndvi"], True),
]
STATIC_GROUP = "SRTM"
CHANNELS = [c for _, names, _ in CHANNEL_GROUPS for c in names]
ABSENT_CHANNELS = [c for _, names, given in CHANNEL_GROUPS if not given for c in names]
SERIES_CHANNELS = [c for c in CHANNELS if c not in ABSENT_CHANNELS]
MODEL_BANDS = [c for c in SERIES_CHANNELS if c != "ndvi"]
CHANNEL_MASK = [1 if c in ABSENT_CHANNELS else 0 for c in CHANNELS]

# Dynamic World has classes 0..8, and 9 stands for missing.
DYNAMIC_WORLD_MISSING = 9

# Cloud and cirrus bits of the QA60 band, scene cloud limit, season start.
CLOUD_BIT = 10
CIRRUS_BIT = 11
MAX_CLOUD_PCT = 10
SEASON_START_MONTH = 9

# The land-cover class that is scored, and the nodata label of a prediction grid.
CROPLAND_CLASS = 4
NODATA_LABEL = 0

# Nodata code by mask type; any other type is taken for a float.
NODATA_BY_DTYPE = {"uint8": 0, "int8": -128, "uint16": 0, "int16": -32768, "uint32": 0, "int32": -2147483648}
NODATA_FLOAT = -9999


def wide_name(month: int, band: str) -> str:
    return f"M{month:02d}_{band}"


WIDE_BANDS = [wide_name(m, b) for m in MONTHS for b in BANDS]
