"""Transcripts, reactions and large threads."""

import json

import pytest
from pyspark.sql import functions as F

from threadloom.functions.reactions import parse_reactions, top_reactions
from threadloom.operators.rollups import nested_participants, participants, reaction_summary
from threadloom.operators.transcripts import (
    gold_threads,
    messages_json,
    rich_threads,
    typed,
)

SCHEMA = (
    "id string, message_id bigint, chat_id bigint, chat_name string, date string, sender string, "
    "from_id string, text string, reactions string, reply_to_message_id bigint, "
    "date_unixtime bigint, week_id string, root_id bigint, is_root boolean"
)
T0 = 1_700_000_000  # 2023-11-14 22:13:20 UTC


def message(m, at, sender="Ann", text="hi", reactions=None, chat=1, from_id="u1", root=1):
    return (
        f"{chat}_{m}", m, chat, "Club", "x", sender, from_id, text, reactions,
        None if m == root else root, at, "2023-46", root, m == root,
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rx(*pairs):
    return json.dumps([{"emoji": e, "count": c} for e, c in pairs], ensure_ascii=False)


def test_basic_transcript(spark):
    rows = [
        message(1, T0, reactions=rx(("👍", "9"), ("🔥", "10"), ("❤", "1"))),
        message(3, T0 + 59, sender=None, text="same second b"),
        message(2, T0 + 59, text="same second a", reactions=rx(("👍", 1)), from_id="u2"),
    ]
    got = gold_threads(frame(spark, rows)).first()
    assert got["transcript"] == (
        "### CONVERSATION THREAD: Club\n### METADATA: 3 msgs | 0 mins duration\n### TRANSCRIPT: \n"
        "[2023-11-14 22:13] Ann: hi {rxn: 🔥10 👍9}\n"
        "[2023-11-14 22:14] Ann: same second a {rxn: 👍1}\n"
        "[2023-11-14 22:14] Unknown: same second b"
    )
    assert (got["message_count"], got["participant_count"]) == (3, 2)
    assert (got["start_unixtime"], got["end_unixtime"]) == (T0, T0 + 59)


@pytest.mark.parametrize("seconds,minutes", [(0, 0), (59, 0), (60, 1), (119, 1)])
def test_minutes_are_truncated(spark, seconds, minutes):
    got = gold_threads(frame(spark, [message(1, T0), message(2, T0 + seconds)])).first()
    assert f"2 msgs | {minutes} mins duration" in got["transcript"]


def test_threads_left_out(spark):
    rows = [message(1, T0, chat=1), message(1, T0, chat=2), message(2, None, chat=2)]
    assert gold_threads(frame(spark, rows)).count() == 0


def test_rich_transcript(spark):
    rows = [
        message(1, T0, reactions=rx(("👍", 2), ("🔥", 2))),
        message(2, T0 + 120, sender="Bob", from_id="u2", reactions=rx(("❤", 5), ("😂", 1))),
        message(1, T0, chat=2), message(2, T0 + 1, chat=2),
    ]
    got = {r["thread_id"]: r for r in rich_threads(frame(spark, rows)).collect()}
    assert got["1_1"]["transcript"] == (
        "### CONVERSATION THREAD: Club \n"
        "### METADATA: 2 msgs | 2 participants | 2 mins duration | thread_id: 1_1\n"
        "### SENTIMENT/REACTIONS: ❤(5) 👍(2) 🔥(2)\n### TRANSCRIPT: \n"
        "[2023-11-14-22-13-20] Ann: hi {rxn: 👍2 🔥2}\n"
        "[2023-11-14-22-15-20] Bob: hi {rxn: ❤5 😂1}"
    )
    assert got["1_1"]["velocity"] == 1.0
    assert "### SENTIMENT: Neutral \n" in got["2_1"]["transcript"]


def test_large_thread_in_parts_is_whole(spark):
    """A thread over the limit is several rows that join to the whole transcript."""
    rows = [message(1, T0)] + [
        message(m, T0 + (m * 37) % 500, text=f"m{m}") for m in range(2, 400)
    ] + [message(m, T0 + m, chat=2) for m in (1, 2)]
    whole = {
        r["thread_id"]: r for r in gold_threads(frame(spark, rows)).collect()
    }
    parts = gold_threads(frame(spark, rows), part_chars=1500).collect()
    big = sorted((r for r in parts if r["thread_id"] == "1_1"), key=lambda r: r["part_no"])
    assert len(big) > 10 and {r["part_count"] for r in big} == {len(big)}
    assert [r["part_no"] for r in big] == list(range(len(big)))
    assert "\n".join(r["transcript"] for r in big) == whole["1_1"]["transcript"]
    assert [m for r in big for m in r["messages"]] == whole["1_1"]["messages"]
    assert {r["message_count"] for r in big} == {399}
    assert {r["participant_count"] for r in big} == {1}
    (small,) = [r for r in parts if r["thread_id"] == "2_1"]
    assert small == whole["2_1"]


def test_payload_json(spark):
    rows = [message(1, T0, reactions="not json"), message(2, T0 + 5, reactions=rx(("é", 3)))]
    got = messages_json(gold_threads(frame(spark, rows))).first()
    payload = json.loads(got["messages_json"])
    assert [m["message_id"] for m in payload] == [1, 2]
    assert payload[0]["reactions"] == []
    assert payload[1]["reactions"] == [{"emoji": "é", "count": 3}]
    assert "date_timestamp" not in payload[0]


def test_reaction_parsing(spark):
    raw = json.dumps([
        {"type": "custom", "count": 4, "recent": [{"x": 1}]}, {"emoji": "🔥"}, {"count": "bad"},
        {"emoji": "👍", "count": "10"}, {"emoji": "❤", "count": 9},
    ])
    df = spark.createDataFrame([(raw,), (None,), ("{",)], "r string")
    got = [r[0] for r in df.select(parse_reactions(F.col("r"))).collect()]
    assert [tuple(x) for x in got[0]] == [("custom", 4), ("🔥", 0), ("?", 0), ("👍", 10), ("❤", 9)]
    assert got[1] == [] and got[2] == []
    top = df.select(top_reactions(parse_reactions(F.col("r")))).first()[0]
    assert [x["emoji"] for x in top] == ["👍", "❤"]


def test_summary_and_participants(spark):
    rows = [
        message(1, T0, reactions=rx(("👍", 2)), from_id="u1", sender="Old"),
        message(2, T0 + 9, reactions=rx(("👍", 3), ("🔥", 1)), from_id="u1", sender="New"),
        message(3, T0 + 20, from_id="u1", sender=None),
        message(4, T0 + 5, from_id="u2", sender=None), message(5, T0 + 6, from_id=None),
    ]
    attached = typed(frame(spark, rows))
    summary = reaction_summary(attached).first()
    assert (summary["total_count"], summary["unique_emojis"]) == (6, ["👍", "🔥"])
    assert summary["emoji_counts"] == {"👍": 5, "🔥": 1}
    got = {r["from_id"]: r["display_name"] for r in participants(attached).collect()}
    assert got == {"u1": "New", "u2": None}
    nested = nested_participants(attached).collect()
    assert sorted(i for r in nested for i in r["participant_ids"]) == ["u1", "u2"]
