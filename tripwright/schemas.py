"""Message schemas, stored-table layouts and code lists."""

from __future__ import annotations

# Message keys, field names, column names and codes of the wire
# format. They have to be spelled exactly like this for existing data to parse.
MICROTRIP_KEY = "sf-microtrip"
TRIP_KEY = "sf-trip"
EVENT_KEY = "sf-event"
SCORE_KEY = "sf-score"

MICROTRIP_MESSAGE = """
data struct<microTripId string, tripId string, sensorId string, vehicleId string, date string,
            ts bigint, payload string, deviceType string, createdTime string, companyId string>,
msgType string
"""

TRIP_MESSAGE = """
data struct<tripId string, vehicleId string, userId string, sensorId string, companyId string,
            startTs string, startDt string, endTs string, endDt string, deviceType string,
            createdTime string, payload string, updated string>,
latestTrip array<struct<deviceType string, id string>>,
msgType string
"""

EVENT_MESSAGE = """
data struct<deviceType string, eventId string, companyId string, ty string, payload string,
            createdTime string, tripId string, vehicleId string, eventDt string, eventTs string,
            userId string, sensorId string>,
msgType string
"""

SAMPLE_PAYLOAD = (
    "array<struct<lon double, lat double, clt bigint, sp int, em int, ldw int, fcw int>>"
)

# Devices write edlat/edlon, older documents name the fields endlat/endlon: both are read.
TRIP_PAYLOAD = """
tid int, dis int, stlat double, stlon double,
endlat double, endlon double, edlat double, edlon double
"""

# dtcc stays a variant so that only a JSON string counts as a fault code.
EVENT_PAYLOAD = """
dtcc variant, wbv int, wid int, ldw int, fcw int,
dclon double, dclat double, plat double, plon double
"""

# Stored tables: name -> (row key, DDL).
TABLES = {
    "sf_microtrip": (
        "key1",
        "key1 string, micro_trip_id string, vehicle_id string, trip_id string, sensor_id string, "
        "created_time string, date string, device_type string, payload string, ts bigint",
    ),
    "sf_trip": (
        "key1",
        "key1 string, vehicle_id string, trip_id string, sensor_id string, created_time string, "
        "date string, device_type string, end_dt string, end_ts string, start_dt string, "
        "start_ts string, payload string, spark_idx string, updated string, user_id string",
    ),
    "sf_event": (
        "key1",
        "key1 string, vehicle_id string, trip_id string, event_id string, company_id string, "
        "ty string, sensor_id string, created_time string, event_dt string, event_ts string, "
        "payload string, device_type string, user_id string",
    ),
}

TRIP_INDEX = "spark_index1"

DEVICE_PRIORITY = ("OBD", "ADAS", "GPS", "BLACKBOX")
SATELLITE_DEVICES = ("GPS", "BLACKBOX")

# Bit i of the abnormal-driving mask sets the i-th counter.
MASK_COUNTERS = ("start", "lturn", "rturn", "uturn", "deaccel", "accel", "stop")
LANE_CODES = {"lldw": 31, "rldw": 32}
COLLISION_CODES = {"fcw1": 31, "fcw2": 32}
COUNTERS = (*MASK_COUNTERS, *LANE_CODES, *COLLISION_CODES, "overlimit", "distance")
TEXTS = ("dtcc", "cwdrv", "cwprk", "bw", "bbxwn")

DRIVING_EVENT_CODES = {"start": 1, "accel": 2, "deaccel": 3, "stop": 4, "overlimit": 5}

# Per category: from-speed, change, to-speed in km/h; "-" means no bound.
SPEED_RULES = {
    "taxi": {"start": "5,8,-", "accel": "-,8,-", "stop": "-,-14,5", "deaccel": "-,-14,-"},
    "bus": {"start": "5,6,-", "accel": "-,6,-", "stop": "-,-9,5", "deaccel": "-,-9,-"},
    "truck": {"start": "5,5,-", "accel": "-,5,-", "stop": "-,-8,5", "deaccel": "-,-8,-"},
    "etas": {"start": "0,11,-", "accel": "-,11,-", "stop": "-,-7.5,0", "deaccel": "-,-7.5,-"},
}
DEFAULT_CATEGORY = "taxi"

# Score settings: minimum, maximum and weight per measure (counts, and metres for distance).
SCORE_SPEC = {
    "accel": (0, 10, 0.36),
    "deaccel": (0, 10, 0.36),
    "overlimit": (0, 5, 0.39),
    "distance": (10000, 320000, 0.25),
}

EARTH_RADIUS_KM = 6371
SPEED_WINDOW = 5
MIN_MOVE_MS = 900
MIN_TRACK_POINTS = 3
# End of the list of fixed values.
