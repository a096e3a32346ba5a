"""Fixed values of the oracle, stated on their own: nothing here comes from the code it checks."""

import math

# --- fixed values: must equal the application's ------------------------------------------------------
EXCLUDED_ZONE_IDS = (264, 265)
EXCLUDED_ZONE_NAMES = ('Unknown', 'N/A')
HARD_FLAG_TYPES = ('BAD_DATETIME', 'DROPOFF_BEFORE_PICKUP')
MAX_SPEED_MPH = 80
MAX_TIP_PERCENTAGE = 100
PEAK_HOURS = (7, 8, 9, 16, 17, 18, 19)
PAYMENT_LABELS = {1: 'Credit Card', 2: 'Cash', 3: 'No Charge', 4: 'Dispute', 5: 'Unknown', 6: 'Voided Trip'}
FLAG_NOTES = {'DROPOFF_BEFORE_PICKUP': 'dropoff < pickup time',
 'ZERO_DIST': 'distance = 0',
 'LARGE_DIST': 'distance > 100mi',
 'NEG_FARE': 'negative fare',
 'NEG_TOTAL': 'negative total',
 'NEG_TIP': 'negative tip',
 'ZERO_PASS': 'zero passengers',
 'HIGH_PASS': 'passengers > 8',
 'BAD_RATE_CODE': 'invalid rate code',
 'HIGH_SPEED': 'speed > 80mph',
 'HIGH_TIP_PCT': 'tip > 100% fare',
 'ZERO_DIST_POS_FARE': 'no distance + fare'}
FLAG_META = {'ZERO_PASS': ('ZERO_PASS',
               'Trip recorded with zero passengers. Kept in dataset — driver may have forgotten to update the meter.',
               'retained'),
 'HIGH_PASS': ('HIGH_PASS', 'Passenger count exceeds 8. Kept — likely a data entry error, but the fare data is still valid.', 'retained'),
 'ZERO_DIST': ('ZERO_DIST', 'Trip distance recorded as zero or negative. Kept — could be a GPS failure or very short fare.', 'retained'),
 'LARGE_DIST': ('LARGE_DIST',
                'Trip distance exceeds 100 miles. Kept — extreme outlier but may be a legitimate airport/long-haul ride.',
                'retained'),
 'NEG_FARE': ('NEG_FARE',
              'Fare amount is negative. Kept — possibly a refund or meter reversal; revenue calculations use absolute values.',
              'retained'),
 'NEG_TOTAL': ('NEG_TOTAL', 'Total charge is negative. Kept — same as NEG_FARE; often accompanies a dispute or void.', 'retained'),
 'NEG_TIP': ('NEG_TIP',
             'Tip amount is negative. Kept — this skews the average tip percentage; tip_pct is set to null for these rows.',
             'retained'),
 'BAD_RATE_CODE': ('BAD_RATE_CODE',
                   'RatecodeID is outside the standard range (1–6). Kept — the TLC defines six valid codes; anything else is a metering '
                   'anomaly.',
                   'retained'),
 'HIGH_SPEED': ('HIGH_SPEED',
                'Computed average speed exceeds 80 mph. Kept — almost certainly a GPS or datetime error rather than an actual speed.',
                'retained'),
 'HIGH_TIP_PCT': ('HIGH_TIP_PCT',
                  'Tip percentage exceeds 100% of the fare. Kept — can happen with preset tip buttons on very cheap fares.',
                  'retained'),
 'ZERO_DIST_POS_FARE': ('ZERO_DIST_POS_FARE',
                        'Distance is zero but a fare was still charged. Kept — contradictory data; could be a stationary fare (e.g. '
                        'waiting time).',
                        'retained'),
 'BAD_DATETIME': ('BAD_DATETIME',
                  'Pickup or dropoff datetime could not be parsed. Excluded — without valid timestamps, duration and speed are impossible '
                  'to compute.',
                  'excluded'),
 'DROPOFF_BEFORE_PICKUP': ('DROPOFF_BEFORE_PICKUP',
                           'Dropoff time is earlier than or equal to pickup time. Excluded — negative durations make all derived features '
                           'nonsensical.',
                           'excluded')}
RAW_TRIP_COLUMNS = ('VendorID',
 'tpep_pickup_datetime',
 'tpep_dropoff_datetime',
 'passenger_count',
 'trip_distance',
 'RatecodeID',
 'store_and_fwd_flag',
 'PULocationID',
 'DOLocationID',
 'payment_type',
 'fare_amount',
 'extra',
 'mta_tax',
 'tip_amount',
 'tolls_amount',
 'improvement_surcharge',
 'total_amount',
 'congestion_surcharge')
TRIP_COLUMNS = ('row_num',
 'vendor',
 'pickup_time',
 'dropoff_time',
 'passengers',
 'distance',
 'rate_id',
 'store_fwd',
 'pickup_zone',
 'dropoff_zone',
 'payment_type',
 'fare',
 'extra',
 'tax',
 'tip',
 'tolls',
 'surcharge',
 'total',
 'congestion',
 'duration_min',
 'speed_mph',
 'money_per_min',
 'tip_pct',
 'cost_per_mile',
 'hour_of_day',
 'day_of_week',
 'is_peak')

# a leading whole number, and a leading decimal number, of a text
INT_PREFIX = r"^\s*([+-]?\d+)"
FLOAT_PREFIX = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"

# source projection of the zone polygons: parallels, origin, false easting, GRS80, US survey foot
_P1, _P2, _P0, _LON0 = 41.03333333333333, 40.66666666666667, 40.16666666666666, -74.0
_X0, _Y0, _A, _RF, _FOOT = 300000.0000000001, 0.0, 6378137.0, 298.257222101, 0.3048006096012192
LAT_ITERATIONS = 6


class LCC:
    """Constants of the conic (Snyder 1987, 15-8 to 15-11)."""
    _f = 1 / _RF
    e = math.sqrt(_f * (2 - _f))
    to_meter, x0, y0, lon0 = _FOOT, _X0, _Y0, math.radians(_LON0)


def _m(lat: float) -> float:
    s = math.sin(math.radians(lat))
    return math.cos(math.radians(lat)) / math.sqrt(1 - LCC.e**2 * s * s)


def _t(lat: float) -> float:
    phi, s = math.radians(lat), LCC.e * math.sin(math.radians(lat))
    return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (LCC.e / 2)


LCC.n = (math.log(_m(_P1)) - math.log(_m(_P2))) / (math.log(_t(_P1)) - math.log(_t(_P2)))
LCC.aF = _A * _m(_P1) / (LCC.n * _t(_P1) ** LCC.n)
LCC.rho0 = LCC.aF * _t(_P0) ** LCC.n
