"""Declared schemas. Nothing in the package infers a schema from data."""

from pyspark.sql import types as T

# Field names and types of the chat export format.
RAW_MESSAGE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("from", T.StringType()),
    T.StructField("from_id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("reply_to_message_id", T.LongType()),
    T.StructField("reactions", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
])

#: Fields of flat messages that have another name than in the export, and those left behind.
RENAMED = {"id": "message_id", "from": "sender"}
LEFT_OUT = ["type"]


def holds_map(kind: T.DataType) -> bool:
    """Maps have no order, so rows that hold one cannot be compared."""
    return "map<" in kind.simpleString()


#: A flat message: its own id, its chat, and the declared fields; what holds a map is JSON text.
MESSAGE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("chat_id", T.LongType()),
    T.StructField("chat_name", T.StringType()),
    *(
        T.StructField(RENAMED.get(f.name, f.name), T.StringType() if holds_map(f.dataType) else f.dataType)
        for f in RAW_MESSAGE if f.name not in LEFT_OUT
    ),
])

CHAT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("messages", T.ArrayType(RAW_MESSAGE)),
])

EXPORT = T.StructType([
    T.StructField("chats", T.StructType([T.StructField("list", T.ArrayType(CHAT))])),
])

USERS = T.StructType([
    T.StructField("telegram_id", T.StringType()),
    T.StructField("display_name", T.StringType()),
])

# DDL forms, for from_json / cast / mapInArrow result types.
REACTIONS = "array<struct<emoji:string,count:bigint>>"
RAW_REACTIONS = "array<map<string,string>>"
TRIPLETS = "array<struct<subject:string,predicate:string,object:string,context:string>>"
TAXONOMY_UPDATE = "array<struct<domain:string,topics:array<string>>>"
# Field names of the summary packet.
PACKET = (
    "struct<overarching_theme:string,decisions_and_rationale:array<string>,"
    "cross_domain_relationships:array<string>,reasoning_patterns:array<string>,"
    "open_threads:array<string>>"
)
