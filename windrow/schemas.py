"""One fixed schema per layer; nothing is inferred at read time."""

from pyspark.sql import types as T

from windrow import fixed

_TEXT = {"event_id", "airport", "_kafka_topic", "_ingested_at_utc", "_source_object", "label_source"}
_OTHER = {
    "timestamp_utc": T.TimestampType(),
    "event_date": T.DateType(),
    "_kafka_partition": T.IntegerType(),
    "_kafka_offset": T.LongType(),
    "hour_of_day": T.IntegerType(),
    "day_of_week": T.IntegerType(),
    "month": T.IntegerType(),
}


def _field(name: str) -> T.StructField:
    if name in _TEXT:
        return T.StructField(name, T.StringType())
    return T.StructField(name, _OTHER.get(name, T.DoubleType()))


def _struct(names) -> T.StructType:
    return T.StructType([_field(n) for n in names])


#: An event on the wire: the time is text.
EVENT = T.StructType(
    [T.StructField(n, T.StringType()) if n == "timestamp_utc" else _field(n) for n in fixed.EVENT_COLUMNS]
)
#: An event as stored in the raw zone, with where it was delivered from.
RAW = T.StructType([*EVENT.fields, *_struct(fixed.DELIVERY_COLUMNS).fields])
#: Fields of a record that the schema does not know: plain values as text, nested ones as JSON.
REST = T.StructField("_rest", T.MapType(T.StringType(), T.StringType()))
BRONZE = _struct(fixed.BRONZE_COLUMNS)
SILVER = T.StructType(
    [*BRONZE.fields, *_struct(("weather_rule_label", "risk_score_proxy", "label", "label_source")).fields]
)
GOLD = _struct(fixed.GOLD_COLUMNS)
STATIONS = "code string, name string, lat double, lon double"
RUNS = (
    "run_id string, run_name string, logged_at timestamp, "
    "params map<string,string>, metrics map<string,double>"
)
