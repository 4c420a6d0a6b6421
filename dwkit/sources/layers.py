"""Declared schemas of the four layers and typed, lazy loading against them (A1).

Every table has a ``StructType`` whose fields carry a comment (column glossary), the length of text
columns and whether nulls are allowed.  CSV files are read as text in the declared column order without
a job; one projection maps missing-value tokens to null and casts each value.  A row with a value that
does not fit its column (type, length, missing where required) or with the wrong number of columns goes
to the table's rejected rows, with the reasons and its text; text codes keep their leading zeros.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import parse_date, parse_timestamp
from .io import NA_TOKENS, _exists

# Description of each column of the studied tables.
GLOSSARY = {
    "FL_DATE": "Date of flight",
    "DEP_HOUR": "Departure hour (0-23)",
    "MKT_UNIQUE_CARRIER": "Marketing Carrier Unique Code -> Carrier.Code",
    "MKT_CARRIER_FL_NUM": "Marketing Carrier Flight Number",
    "OP_UNIQUE_CARRIER": "Operating Carrier Unique Code -> Carrier.Code",
    "OP_CARRIER_FL_NUM": "Operating Carrier Flight Number",
    "TAIL_NUM": "FAA N-Number/Registration -> Aircraft.Tail_Num",
    "ORIGIN": "Origin airport code -> Station.Airport",
    "DEST": "Destination airport code -> Station.Airport",
    "DEP_TIME": "Actual departure timestamp",
    "CRS_DEP_TIME": "Scheduled departure timestamp (CRS)",
    "TAXI_OUT": "Taxi-out time (in minutes)",
    "DEP_DELAY": "Departure delay (in minutes; negative = early)",
    "AIR_TIME": "Wheels-off to wheels-on time (in minutes)",
    "DISTANCE": "Flight distance (in miles)",
    "CANCELLED": "Cancellation status -> Cancellation.Status",
    "WIND_DIR": "Wind direction (degrees)",
    "WIND_SPD": "Wind speed (in kt)",
    "WIND_GUST": "Wind gust speed (in kt)",
    "VISIBILITY": "Visibility (in miles)",
    "TEMPERATURE": "Temperature (in Celsius)",
    "DEW_POINT": "Dew point (in Celsius)",
    "REL_HUMIDITY": "Relative humidity (percentage)",
    "ALTIMETER": "Altimeter setting (in Hg)",
    "LOWEST_CLOUD_LAYER": "Height of lowest cloud layer (in ft)",
    "N_CLOUD_LAYER": "Number of cloud layers",
    "LOW_LEVEL_CLOUD": "Low-level cloud present (height below 6500 ft)",
    "MID_LEVEL_CLOUD": "Mid-level cloud present (between 6500 and 20000 ft)",
    "HIGH_LEVEL_CLOUD": "High-level cloud present (height above 20000 ft)",
    "CLOUD_COVER": "Cloud cover value",
    "ACTIVE_WEATHER": "Active weather condition -> Active_Weather.Status",
    "YEAR_OF_MANUFACTURE": "Year aircraft was manufactured",
    "MANUFACTURER": "Aircraft manufacturer name",
    "ICAO_TYPE": "ICAO aircraft type designator",
    "RANGE": "Encoded range category (Short/Medium/Long Range)",
    "WIDTH": "Aircraft body type (Narrow Body or Wide Body)",
    "AIRPORT_ID": "Internal numeric airport ID",
    "AIRPORT": "PK - Airport code (e.g., JFK)",
    "DISPLAY_AIRPORT_NAME": "Full airport name",
    "DISPLAY_AIRPORT_CITY_NAME_FULL": "Full city name",
    "AIRPORT_STATE_NAME": "Full state name",
    "AIRPORT_STATE_CODE": "State abbreviation",
    "LATITUDE": "Latitude coordinate",
    "LONGITUDE": "Longitude coordinate",
    "ELEVATION": "Elevation (in ft)",
    "ICAO": "ICAO airport code (UNIQUE)",
    "IATA": "IATA airport code (UNIQUE)",
    "FAA": "FAA identifier",
    "MESONET_STATION": "Mesonet station code (UNIQUE)",
    "STATUS": "Primary Key of the status",
    "WEATHER_DESCRIPTION": "Description of active weather condition",
    "CANCELLATION_REASON": "Reason for cancellation",
    "CODE": "PK - Carrier unique code",
    "DESCRIPTION": "Full carrier name or status description",
}

# Tables, columns, types and lengths of the layers; "!" marks a column that must not be null.
_RECONCILED = {
    "Aircrafts": "tail_num varchar(20)!, year_of_manufacture int, manufacturer varchar(100), icao_type varchar(20), range varchar(50), width varchar(50)",
    "Carriers": "code varchar(10)!, description varchar(150)",
    "Active_Weather": "status int!, weather_description varchar(200)",
    "Cancellation": "status int!, cancellation_reason varchar(100)",
    "Stations": "airport varchar(10)!, airport_id int, display_airport_name varchar(150), display_airport_city_name_full varchar(150), "
                "airport_state_name varchar(100), airport_state_code varchar(10), latitude double, longitude double, elevation int, icao varchar(10), "
                "iata varchar(10), faa varchar(10), mesonet_station varchar(10)",
    "Weather_Observations": "obs_id bigint!, origin_airport varchar(10), obs_date date, obs_hour smallint, wind_dir double, wind_spd double, wind_gust double, "
                            "visibility double, temperature double, dew_point double, rel_humidity double, altimeter double, lowest_cloud_layer double, "
                            "n_cloud_layer double, low_level_cloud double, mid_level_cloud double, high_level_cloud double, cloud_cover double, "
                            "active_weather_status double",
    "Flights": "flight_id bigint!, fl_date date, dep_hour smallint, mkt_unique_carrier varchar(10), mkt_carrier_fl_num int, op_unique_carrier varchar(10), "
               "op_carrier_fl_num int, tail_num varchar(20), origin varchar(10), dest varchar(10), dep_time timestamp, crs_dep_time timestamp, taxi_out double, "
               "dep_delay int, air_time double, distance double, cancelled int, weather_observation_id bigint",
}
_WEATHER = ("wind_dir double, wind_spd double, wind_gust double, visibility double, temperature double, dew_point double, rel_humidity double, altimeter double, "
            "lowest_cloud_layer double, n_cloud_layer double, low_level_cloud double, mid_level_cloud double, high_level_cloud double, cloud_cover double, "
            "active_weather double")
_ORIGINAL = {
    "CompleteData": "fl_date date, dep_hour smallint, mkt_unique_carrier varchar(10), mkt_carrier_fl_num int, op_unique_carrier varchar(10), op_carrier_fl_num int, "
                    "tail_num varchar(20), origin varchar(10), dest varchar(10), dep_time timestamp, crs_dep_time timestamp, taxi_out double, dep_delay int, "
                    "air_time double, distance double, cancelled int, latitude double, longitude double, elevation int, mesonet_station varchar(10), "
                    "year_of_manufacture int, manufacturer varchar(100), icao_type varchar(20), range varchar(50), width varchar(50), " + _WEATHER,
    "ActiveWeather": _RECONCILED["Active_Weather"], "Cancellation": _RECONCILED["Cancellation"], "Carriers": _RECONCILED["Carriers"], "Stations": _RECONCILED["Stations"],
}
_WAREHOUSE = {
    "DIM_FL_DATES": "fl_date_id bigint!, fl_date date!, day_of_week varchar(10), is_holiday boolean, month smallint, quarter smallint, year smallint, load_timestamp timestamp",
    "DIM_DEP_HOURS": "dep_hour_id bigint!, dep_hour smallint, time_band varchar(20), load_timestamp timestamp",
    "DIM_STATIONS": "station_id bigint!, airport_code varchar(4)!, airport_name varchar(150), city varchar(100), state varchar(50), latitude decimal(9,6), "
                    "longitude decimal(9,6), load_timestamp timestamp",
    "DIM_CARRIERS": "carrier_id bigint!, description varchar(100)!, load_timestamp timestamp",
    "DIM_JUNK": "junk_id bigint!, cancellation_reason varchar(60), weather_description varchar(150), load_timestamp timestamp",
    "DIM_AIRCRAFTS": "aircraft_id bigint!, tail_num varchar(10)!, manufacturer varchar(50), aircraft_age smallint, load_timestamp timestamp",
    "FLIGHTS": "flight_id bigint!, fl_date_id bigint!, dep_hour_id bigint!, origin_station_id bigint!, dest_station_id bigint!, mkt_carrier_id bigint!, "
               "op_carrier_id bigint!, aircraft_id bigint!, junk_id bigint!, wind_spd decimal(5,1), wind_gust decimal(5,1), visibility decimal(5,1), "
               "temperature decimal(5,2), cloud_cover decimal(5,1), dep_delay decimal(6,1), taxi_out decimal(6,1), air_time decimal(6,1), distance decimal(7,1), "
               "load_timestamp timestamp",
}
_KINDS = {"bigint": T.LongType(), "int": T.IntegerType(), "smallint": T.ShortType(), "double": T.DoubleType(), "date": T.DateType(),
          "timestamp": T.TimestampNTZType(), "boolean": T.BooleanType()}


def declared(columns: str) -> T.StructType:
    """``name type[!], ...`` as a StructType; ``varchar(n)`` is text with its length as metadata."""
    fields = []
    for part in columns.replace(", ", "\n").split("\n"):
        name, kind = part.split(" ", 1)
        required, kind = kind.endswith("!"), kind.rstrip("!")
        meta = {"comment": GLOSSARY[name.upper()]} if name.upper() in GLOSSARY else {}
        if kind.startswith("varchar"):
            data_type = T.StringType()
            meta["length"] = int(kind[8:-1])
        elif kind.startswith("decimal"):
            data_type = T.DecimalType(*map(int, kind[8:-1].split(",")))
        else:
            data_type = _KINDS[kind]
        fields.append(T.StructField(name, data_type, not required, meta))
    return T.StructType(fields)


#: layer -> table -> schema
LAYERS: dict[str, dict[str, T.StructType]] = {
    "original": {t: declared(c) for t, c in _ORIGINAL.items()}, "reconciled": {t: declared(c) for t, c in _RECONCILED.items()},
    "cleaned": {t: declared(c) for t, c in _RECONCILED.items()}, "dw": {t: declared(c) for t, c in _WAREHOUSE.items()}}


@dataclass(frozen=True)
class Loaded:
    """A table's rows in its declared types, the rows that don't fit: (table_name, reasons, record), and the numbers of both
    from one pass: (n_rows, n_rejected)."""
    rows: DataFrame
    rejected: DataFrame
    counts: DataFrame


def _value(text: Column, kind: T.DataType) -> Column:
    """``text`` as ``kind``; null if it can't be read.  Whole numbers may be written with a fraction of zeros."""
    if isinstance(kind, T.DateType):
        return parse_date(text)
    if isinstance(kind, T.TimestampNTZType):
        return parse_timestamp(text).cast("timestamp_ntz")
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.IntegralType):  # no pattern is sought in a text without a point
        return F.when(F.contains(text, F.lit(".")), F.regexp_replace(F.trim(text), r"\.0*$", "")).otherwise(F.trim(text)).try_cast(kind)
    if isinstance(kind, T.DecimalType):  # rounded to the declared scale, not refused for more digits
        return F.round(text.try_cast("decimal(38,12)"), kind.scale).try_cast(kind)
    return text.try_cast(kind)


def typed(raw: DataFrame, table: str, schema: T.StructType, na_values=NA_TOKENS, corrupt: str | None = None) -> Loaded:
    """Rows of text columns against a declared schema, in one projection."""
    text = {f.name: F.when(~F.trim(F.col(f"`{f.name}`")).isin(list(na_values)), F.col(f"`{f.name}`")) for f in schema.fields}
    faults, values = [], []
    for f in schema.fields:
        t, v = text[f.name], _value(text[f.name], f.dataType)
        values.append(v.alias(f.name, metadata=f.metadata))
        if not isinstance(f.dataType, T.StringType):
            faults.append((t.isNotNull() & v.isNull(), f"{f.name}: not {f.dataType.simpleString()}"))
        elif "length" in f.metadata:
            faults.append((t.isNotNull() & (F.length(t) > f.metadata["length"]), f"{f.name}: longer than {f.metadata['length']}"))
        if not f.nullable:
            faults.append((t.isNull(), f"{f.name}: missing"))
    if corrupt:
        # A higher-order function keeps its projection out of whole-stage code, where all columns are one method: with ten columns
        # or more that is too long for the JIT (8,000 bytes).  Outside, every column has its own method.
        faults = [(F.exists(F.array(F.col(corrupt).isNotNull()), lambda x: x), "record: wrong number of columns"), *faults]
    unfit = reduce(or_, [fault for fault, _ in faults], F.lit(False))  # never null: a missing text is neither misread nor too long
    judged = raw.select("*", unfit.alias("_unfit"))
    reasons = F.array_compact(F.array(*[F.when(fault, F.lit(reason)) for fault, reason in faults]).cast("array<string>"))
    record = F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields]))
    rejected = judged.where("_unfit").select(F.lit(table).alias("table_name"), reasons.alias("reasons"), record.alias("record"))
    counts = judged.agg(F.count_if(~F.col("_unfit")).alias("n_rows"), F.count_if("_unfit").alias("n_rejected"))
    return Loaded(judged.where("NOT _unfit").select(*values), rejected, counts)


def read_typed(spark: SparkSession, path: str, table: str, schema: T.StructType, na_values=NA_TOKENS) -> Loaded:
    """A CSV file (or folder of files) with a header in the declared order; no job runs here."""
    corrupt = "_corrupt_record"
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(corrupt, T.StringType())])
    raw = spark.read.schema(as_text).csv(path, header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt, escape='"')
    return typed(raw, table, schema, na_values, corrupt)


def load_layer(spark: SparkSession, layer: str, folder: str) -> dict[str, Loaded]:
    """Every table of a named layer that has a file ``<table>.csv`` in ``folder``; an unknown layer is a ValueError."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; known are {', '.join(LAYERS)}")
    paths = {t: f"{folder.rstrip('/')}/{t}.csv" for t in LAYERS[layer]}
    return {t: read_typed(spark, p, t, LAYERS[layer][t]) for t, p in paths.items() if _exists(spark, p)}


def write_typed(df: DataFrame, path: str, schema: T.StructType) -> None:
    """The declared columns, in order, as CSV with a header.  Nulls are empty, empty text is quoted."""
    df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) for f in schema.fields]).write.mode("overwrite").csv(
        path, header=True, escape='"', emptyValue='""', nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def described(df: DataFrame) -> DataFrame:
    """``df`` with the glossary's comment as metadata of every column that has none; it survives projections."""
    for f in df.schema.fields:
        if "comment" not in f.metadata and f.name.upper() in GLOSSARY:
            df = df.withMetadata(f.name, {**f.metadata, "comment": GLOSSARY[f.name.upper()]})
    return df
