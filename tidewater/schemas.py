"""Record schemas used by the jobs.

Field names and types are fixed values: the text parsers, the JSON sinks and the
display functions depend on them.
"""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

EVENT = _struct(("userID", STRING), ("eventTime", STRING), ("eventType", STRING), ("productID", INT))
BROWSE_LOG = _struct(
    ("userID", STRING), ("eventTime", STRING), ("eventType", STRING), ("productID", STRING), ("productPrice", INT)
)
CLICK_LOG = _struct(("userID", STRING), ("eventTime", STRING), ("eventType", STRING), ("pageID", STRING))
USER_INFO = _struct(("userID", STRING), ("userName", STRING), ("userAge", INT))
ENRICHED_EVENT = T.StructType(EVENT.fields + USER_INFO.fields[1:])
BEHAVIOR = _struct(("userId", LONG), ("behavior", STRING), ("product", STRING))
ACTION = _struct(("product", STRING), ("action", STRING), ("user", STRING))
PV = _struct(("event", STRING), ("pv", LONG))
PV_WINDOW = _struct(
    ("key", STRING), ("windowStart", STRING), ("windowEnd", STRING), ("count", LONG), ("sum", LONG)
)
HOST_METRICS = _struct(
    ("timeStamp", LONG),
    ("os_name", STRING),
    ("os_arch", STRING),
    ("os_version", DOUBLE),
    ("total_cup", INT),
    ("cup_ratio", STRING),
    ("total_memory", STRING),
    ("memory_ratio", STRING),
    ("java_version", STRING),
    ("java_vm_vendo", STRING),
    ("eventTime", LONG),
    ("reservedTime", STRING),
)
WORD_COUNT = _struct(("word", STRING), ("frequency", LONG))
