"""Record schemas, as StructTypes.

JSON field names follow the public feeds: snake_case for the bike-share feeds,
lowerCamelCase for the JSON rendering of the transit feed (protobuf JSON
renders 64-bit integers as strings and enums by name).
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _I, _L, _F, _D, _B = (T.StringType(), T.IntegerType(), T.LongType(),
                          T.FloatType(), T.DoubleType(), T.BooleanType())

# --- bike-share feeds -------------------------------------------------------

STATION_STATUS = _struct(
    station_id=_S, num_bikes_available=_I, num_bikes_disabled=_I, num_docks_available=_I,
    num_docks_disabled=_I, is_installed=_I, is_renting=_I, is_returning=_I)
STATION_INFO = _struct(station_id=_S, name=_S, lat=_F, lon=_F, capacity=_I)

STATUS_FEED = _struct(ttl=_I, data=_struct(stations=T.ArrayType(STATION_STATUS)))
INFO_FEED = _struct(ttl=_I, data=_struct(stations=T.ArrayType(STATION_INFO)))

#: Feed name -> topic name of the fields that change on the way to the topic.
STATUS_RENAMES = {"station_id": "stationId"}
INFO_RENAMES = {"station_id": "stationId", "lat": "latitude", "lon": "longitude"}


def _renamed(schema: T.StructType, names: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(names.get(f.name, f.name), f.dataType) for f in schema])


STATUS_VALUE = _renamed(STATION_STATUS, STATUS_RENAMES)
INFO_VALUE = _renamed(STATION_INFO, INFO_RENAMES)

# --- topics -----------------------------------------------------------------

#: Without a ``partition`` a topic counts as one of a single partition.
TOPIC_ROW = _struct(key=_S, value=_S, timestamp=T.TimestampType(), partition=_I, offset=_L)

# --- ticks, posts, logs, messages -------------------------------------------

POST_JSON = _struct(id=_I, userId=_I, title=_S, body=_S)
POST_FORM = _struct(title=_S, body=_S, date=_S, author=_S, action=_S)
MANIFEST = _struct(s3_path=_S, body=_S)
LOG_RECORD = _struct(tag=_S, ts=T.TimestampType(), record=_S)

# --- transit feed, JSON rendering -------------------------------------------

TIME_RANGE = _struct(start=_S, end=_S)
TRANSLATED_STRING = _struct(translation=T.ArrayType(_struct(text=_S, language=_S)))
POSITION = _struct(latitude=_F, longitude=_F, bearing=_F, odometer=_D, speed=_F)
VEHICLE_DESCRIPTOR = _struct(id=_S, label=_S, licensePlate=_S)

# Operator extensions appear in JSON under their bracketed full name.
TRIP_EXTENSION = "[nyct_trip_descriptor]"
STOP_EXTENSION = "[nyct_stop_time_update]"
HEADER_EXTENSION = "[nyct_feed_header]"

TRIP_DESCRIPTOR = T.StructType(
    _struct(tripId=_S, routeId=_S, directionId=_I, startTime=_S, startDate=_S,
            scheduleRelationship=_S).fields
    + [T.StructField(TRIP_EXTENSION, _struct(trainId=_S, isAssigned=_B, direction=_S))])
STOP_TIME_EVENT = _struct(delay=_I, time=_S, uncertainty=_I)
STOP_TIME_UPDATE = T.StructType(
    _struct(stopSequence=_I, stopId=_S, arrival=STOP_TIME_EVENT, departure=STOP_TIME_EVENT,
            scheduleRelationship=_S).fields
    + [T.StructField(STOP_EXTENSION, _struct(scheduledTrack=_S, actualTrack=_S))])
TRIP_UPDATE = _struct(
    trip=TRIP_DESCRIPTOR, vehicle=VEHICLE_DESCRIPTOR,
    stopTimeUpdate=T.ArrayType(STOP_TIME_UPDATE), timestamp=_S, delay=_I)
VEHICLE_POSITION = _struct(
    trip=TRIP_DESCRIPTOR, vehicle=VEHICLE_DESCRIPTOR, position=POSITION,
    currentStopSequence=_I, stopId=_S, currentStatus=_S, timestamp=_S,
    congestionLevel=_S, occupancyStatus=_S)
ENTITY_SELECTOR = _struct(
    agencyId=_S, routeId=_S, routeType=_I, trip=TRIP_DESCRIPTOR, stopId=_S)
ALERT = _struct(
    activePeriod=T.ArrayType(TIME_RANGE), informedEntity=T.ArrayType(ENTITY_SELECTOR),
    cause=_S, effect=_S, url=TRANSLATED_STRING, headerText=TRANSLATED_STRING,
    descriptionText=TRANSLATED_STRING)
FEED_ENTITY = _struct(id=_S, isDeleted=_B, tripUpdate=TRIP_UPDATE, vehicle=VEHICLE_POSITION,
                      alert=ALERT)
FEED_HEADER = T.StructType(
    _struct(gtfsRealtimeVersion=_S, incrementality=_S, timestamp=_S).fields
    + [T.StructField(HEADER_EXTENSION, _struct(
        nyctSubwayVersion=_S,
        tripReplacementPeriod=T.ArrayType(_struct(routeId=_S, replacementPeriod=TIME_RANGE))))])
FEED_MESSAGE = _struct(header=FEED_HEADER, entity=T.ArrayType(FEED_ENTITY))
