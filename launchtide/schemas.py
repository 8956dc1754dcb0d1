"""Table schemas, band tables and labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The labels and fill text of the segment table.
NOT_DETECTED = "Not Detected"
PLATFORM = "android"
QUARTER = "202109"
ADOPTION_TYPE = "samsung_high_end_phones"
BRAND = "Samsung"


@dataclass(frozen=True)
class Band:
    """One adoption band: deltas from ``lo`` to ``hi``, ``None`` for an open end."""

    segment: str
    segment_id: str
    lo: int | None
    hi: int | None


# Segment names, ids and day limits.
MY_BANDS = (
    Band("Innovator", "SEG_TEL_NS_00008", None, 6),
    Band("Early_Adopter", "SEG_TEL_NS_00009", 7, 108),
    Band("Early_Majority", "SEG_TEL_NS_00010", 109, 194),
    Band("Late_Majority", "SEG_TEL_NS_00011", 195, 341),
    Band("Laggard", "SEG_TEL_NS_00012", 342, None),
)
ID_DOCUMENTED = (
    Band("Innovator", "SEG_TEL_NS_00013", None, 22),
    Band("Early_Adopter", "SEG_TEL_NS_00014", 23, 128),
    Band("Early_Majority", "SEG_TEL_NS_00015", 129, 332),
    Band("Late_Majority", "SEG_TEL_NS_00016", 333, 469),
    Band("Laggard", "SEG_TEL_NS_00017", 470, None),
)
# These overlap: a user at 22, 128, 129, 332, 333 or 470 days is in two segments.
ID_AS_CODED = (
    Band("Innovator", "SEG_TEL_NS_00013", None, 22),
    Band("Early_Adopter", "SEG_TEL_NS_00014", 22, 129),
    Band("Early_Majority", "SEG_TEL_NS_00015", 128, 333),
    Band("Late_Majority", "SEG_TEL_NS_00016", 332, 470),
    Band("Laggard", "SEG_TEL_NS_00017", 470, None),
)


@dataclass(frozen=True)
class Labels:
    """Constant columns of the segment table."""

    quarter: str = QUARTER
    adoption_type: str = ADOPTION_TYPE
    device_brand: str = BRAND


PROFILE = T.StructType(
    [
        T.StructField("ifa", T.StringType()),
        T.StructField(
            "device",
            T.StructType(
                [
                    T.StructField("platform", T.StringType()),
                    T.StructField("device_model", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "app",
            T.ArrayType(T.StructType([T.StructField("first_seen", T.TimestampType())])),
        ),
    ]
)

DEVICE_LOOKUP = T.StructType(
    [
        T.StructField("Retail Branding", T.StringType()),
        T.StructField("Marketing Name", T.StringType()),
        T.StructField("Model", T.StringType()),
    ]
)

LAUNCHES = T.StructType(
    [
        T.StructField("Name", T.StringType()),
        T.StructField("Release_Date", T.StringType()),
    ]
)

DELTAS = T.StructType(
    [
        T.StructField("ifa", T.StringType()),
        T.StructField("first_seen", T.TimestampType()),
        T.StructField("name", T.StringType()),
        T.StructField("launch", T.DateType()),
        T.StructField("delta", T.IntegerType()),
    ]
)

STATE = T.StructType(
    [
        T.StructField("ifa", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("launch", T.DateType()),
        T.StructField("first_seen", T.TimestampType()),
    ]
)

HISTOGRAM = T.StructType(
    [
        T.StructField("delta", T.IntegerType()),
        T.StructField("count", T.LongType()),
        T.StructField("month", T.IntegerType()),
    ]
)

USER_SETS = T.StructType(
    [
        T.StructField("delta", T.IntegerType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("users", T.BinaryType()),
        T.StructField("month", T.IntegerType()),
    ]
)

CODES = T.StructType(
    [
        T.StructField("ifa", T.StringType()),
        T.StructField("code", T.LongType()),
    ]
)

DATAMART = T.StructType(
    [
        T.StructField("quarter", T.StringType(), False),
        T.StructField("adoption_type", T.StringType(), False),
        T.StructField("ifa", T.StringType(), False),
        T.StructField("segment_id", T.StringType(), False),
        T.StructField("segment", T.StringType(), False),
        T.StructField("device_brand", T.StringType(), False),
        T.StructField("device_name", T.StringType()),
        T.StructField("launch_date", T.DateType()),
        T.StructField("first_seen", T.TimestampType()),
        T.StructField("delta", T.IntegerType()),
    ]
)

_TIMES = (T.TimestampType, T.TimestampNTZType)


def _matches(found: T.DataType, wanted: T.DataType) -> bool:
    if isinstance(wanted, T.StructType):
        return isinstance(found, T.StructType) and not _problems(found, wanted)
    if isinstance(wanted, T.ArrayType):
        return isinstance(found, T.ArrayType) and _matches(found.elementType, wanted.elementType)
    if isinstance(wanted, T.TimestampType):
        return isinstance(found, _TIMES)
    return type(found) is type(wanted)


def _problems(found: T.StructType, wanted: T.StructType) -> list[str]:
    types = {field.name: field.dataType for field in found}
    return [
        f"{field.name} {field.dataType.simpleString()}"
        for field in wanted
        if field.name not in types or not _matches(types[field.name], field.dataType)
    ]


def require(found: T.StructType, wanted: T.StructType, what: str) -> None:
    """Raise unless ``found`` holds the members of ``wanted``; others may be there too.

    Timestamps with and without time zone both pass.
    """
    problems = _problems(found, wanted)
    if problems:
        raise ValueError(f"{what} lacks: {', '.join(problems)}; it has {found.simpleString()}")
