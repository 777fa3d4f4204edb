"""Table schemas (snake_case; surrogate ids dropped, natural keys used)."""

from pyspark.sql import types as T

LOCATION = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

# inbound message as decoded from the wire, plus our arrival order
POSITIONS_RAW = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("location", LOCATION),
    T.StructField("speed", T.DoubleType()),
    T.StructField("engine_temp", T.DoubleType()),
    T.StructField("gas_tank_level", T.DoubleType()),
    T.StructField("obd2_error_code", T.StringType()),
    T.StructField("arrival_seq", T.LongType()),
])

CAR_POSITIONS = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("engine_temp", T.DoubleType()),
    T.StructField("gas_tank_level", T.DoubleType()),
    T.StructField("obd2_error_code", T.StringType()),
    T.StructField("processed", T.BooleanType()),
    T.StructField("arrival_seq", T.LongType()),
])

CURRENT_TRIPS = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("trip_start_timestamp", T.LongType()),
    T.StructField("last_update_timestamp", T.LongType()),
    T.StructField("start_lat", T.DoubleType()),
    T.StructField("start_lon", T.DoubleType()),
    T.StructField("last_lat", T.DoubleType()),
    T.StructField("last_lon", T.DoubleType()),
    T.StructField("total_distance_meters", T.DoubleType()),
    T.StructField("average_speed_kph", T.DoubleType()),
    T.StructField("max_speed_kph", T.DoubleType()),
    T.StructField("total_readings", T.IntegerType()),
])

COMPLETED_TRIPS = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("trip_start_timestamp", T.LongType()),
    T.StructField("trip_end_timestamp", T.LongType()),
    T.StructField("start_lat", T.DoubleType()),
    T.StructField("start_lon", T.DoubleType()),
    T.StructField("end_lat", T.DoubleType()),
    T.StructField("end_lon", T.DoubleType()),
    T.StructField("total_distance_meters", T.DoubleType()),
    T.StructField("average_speed_kph", T.DoubleType()),
    T.StructField("max_speed_kph", T.DoubleType()),
    T.StructField("total_readings", T.IntegerType()),
    T.StructField("duration_minutes", T.LongType()),
])

SPEED_ALERTS = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("computed_speed_kph", T.DoubleType()),
    T.StructField("speed_limit_kph", T.DoubleType()),
])

CURRENT_TRIP_COLUMNS = [f.name for f in CURRENT_TRIPS.fields]
COMPLETED_TRIP_COLUMNS = [f.name for f in COMPLETED_TRIPS.fields]
SPEED_ALERT_COLUMNS = [f.name for f in SPEED_ALERTS.fields]


def empty(spark, schema):
    return spark.createDataFrame([], schema)
