"""Fixed values that must equal the reference application's for identical results.

Everything here is a plain value table; the logic that uses it lives in operators/ and plans/.
"""

# --- fixed values: load behaviour -------------------------------------------------------------
PEAK_HOURS = (7, 8, 9, 16, 17, 18, 19)
MAX_SPEED_MPH = 80               # anomaly threshold: speed strictly above
MAX_TIP_PERCENTAGE = 100         # anomaly threshold: tip percentage strictly above
VALID_RATE_CODES = (1, 2, 3, 4, 5, 6)
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss",)

# --- fixed values: query behaviour ------------------------------------------------------------
EXCLUDED_ZONE_IDS = (264, 265)
EXCLUDED_ZONE_NAMES = ("Unknown", "N/A")
HARD_FLAG_TYPES = ("BAD_DATETIME", "DROPOFF_BEFORE_PICKUP")
POST_FLAG_TYPES = ("HIGH_SPEED", "HIGH_TIP_PCT", "ZERO_DIST_POS_FARE")
MIN_ZONE_TRIPS = 10
TOP_ZONES_DEFAULT_LIMIT, TOP_ZONES_MAX_LIMIT = 20, 100
ANOMALY_LIST_DEFAULT_LIMIT, ANOMALY_LIST_MAX_LIMIT = 50, 200

# --- fixed values: payment labels ---------------------------------------------------------------
PAYMENT_LABELS = {
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided Trip",
}
PAYMENT_LABEL_DEFAULT = "Unknown"

# --- fixed values: short notes shown next to flagged rows ---------------------------------------
FLAG_NOTES = {
    "DROPOFF_BEFORE_PICKUP": "dropoff < pickup time",
    "ZERO_DIST": "distance = 0",
    "LARGE_DIST": "distance > 100mi",
    "NEG_FARE": "negative fare",
    "NEG_TOTAL": "negative total",
    "NEG_TIP": "negative tip",
    "ZERO_PASS": "zero passengers",
    "HIGH_PASS": "passengers > 8",
    "BAD_RATE_CODE": "invalid rate code",
    "HIGH_SPEED": "speed > 80mph",
    "HIGH_TIP_PCT": "tip > 100% fare",
    "ZERO_DIST_POS_FARE": "no distance + fare",
}

# --- fixed values: flag legend (label, description, action) -------------------------------------
FLAG_META = {
    "ZERO_PASS": ("ZERO_PASS", "Trip recorded with zero passengers. Kept in dataset — driver may have forgotten to update the meter.", "retained"),
    "HIGH_PASS": ("HIGH_PASS", "Passenger count exceeds 8. Kept — likely a data entry error, but the fare data is still valid.", "retained"),
    "ZERO_DIST": ("ZERO_DIST", "Trip distance recorded as zero or negative. Kept — could be a GPS failure or very short fare.", "retained"),
    "LARGE_DIST": ("LARGE_DIST", "Trip distance exceeds 100 miles. Kept — extreme outlier but may be a legitimate airport/long-haul ride.", "retained"),
    "NEG_FARE": ("NEG_FARE", "Fare amount is negative. Kept — possibly a refund or meter reversal; revenue calculations use absolute values.", "retained"),
    "NEG_TOTAL": ("NEG_TOTAL", "Total charge is negative. Kept — same as NEG_FARE; often accompanies a dispute or void.", "retained"),
    "NEG_TIP": ("NEG_TIP", "Tip amount is negative. Kept — this skews the average tip percentage; tip_pct is set to null for these rows.", "retained"),
    "BAD_RATE_CODE": ("BAD_RATE_CODE", "RatecodeID is outside the standard range (1–6). Kept — the TLC defines six valid codes; anything else is a metering anomaly.", "retained"),
    "HIGH_SPEED": ("HIGH_SPEED", "Computed average speed exceeds 80 mph. Kept — almost certainly a GPS or datetime error rather than an actual speed.", "retained"),
    "HIGH_TIP_PCT": ("HIGH_TIP_PCT", "Tip percentage exceeds 100% of the fare. Kept — can happen with preset tip buttons on very cheap fares.", "retained"),
    "ZERO_DIST_POS_FARE": ("ZERO_DIST_POS_FARE", "Distance is zero but a fare was still charged. Kept — contradictory data; could be a stationary fare (e.g. waiting time).", "retained"),
    "BAD_DATETIME": ("BAD_DATETIME", "Pickup or dropoff datetime could not be parsed. Excluded — without valid timestamps, duration and speed are impossible to compute.", "excluded"),
    "DROPOFF_BEFORE_PICKUP": ("DROPOFF_BEFORE_PICKUP", "Dropoff time is earlier than or equal to pickup time. Excluded — negative durations make all derived features nonsensical.", "excluded"),
}

# --- fixed values: boroughs in the dashboard's display order ----------------------------------------
BOROUGH_ORDER = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "EWR")

# --- fixed values: source projection of the zone polygons (US survey feet, Lambert conformal conic) --
LCC_2263 = {
    "lat_1": 41.03333333333333,
    "lat_2": 40.66666666666667,
    "lat_0": 40.16666666666666,
    "lon_0": -74.0,
    "x_0": 300000.0000000001,     # metres
    "y_0": 0.0,
    "a": 6378137.0,               # GRS80
    "rf": 298.257222101,
    "to_meter": 0.3048006096012192,
}

# --- fixed values: columns of the trip file ---------------------------------------------------------
RAW_TRIP_COLUMNS = (
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
    "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type", "fare_amount",
    "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
    "congestion_surcharge",
)
