"""One large export document, read by many tasks.

The file is cut at closing braces into byte ranges, which Spark's text reader hands
to different tasks, several to a task if they are small. A range does not know whether it
begins inside a string, nor which containers are open there. So every range is scanned twice.
First for both answers to the one question: what it closes, what it leaves open, and whether it
ends in a string. These summaries, one small row per range, are put together per file in order.
Then with its beginning known: messages are cut out of the text, and so are the chats' own fields.
Chats that lie in one range are complete. What a range border cuts is joined afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.lineage import cut, settings
from threadloom.schemas import RAW_MESSAGE

# Keys and kinds of the containers from the document down to a message.
PATH = (("", "{"), ("chats", "{"), ("list", "["), ("", "{"), ("messages", "["), ("", "{"))
CHAT_DEPTH, MESSAGE_DEPTH = 4, 6

RANGE_BYTES = 64 << 20
#: Bytes of a chat's messages that a task holds until it has read the chat's own fields.
HELD_BYTES = 1 << 20
#: Summaries that a task gives at a time.
ROWS = 1000
#: Tasks per core, unless the ranges are fewer or a task would read more than Spark's own reader gives to one.
TASKS_PER_CORE = 4

# What a byte is: a quote, a bracket by what it adds to the depth, or neither.
QUOTE = 2
SIGNS = bytes({ord('"'): QUOTE, ord("{"): 1, ord("["): 1, ord("}"): 255, ord("]"): 255}.get(i, 0) for i in range(256))

SUMMARY = "file string, start long, assumed boolean, ends_inside boolean, closed int, opened array<struct<key:string,kind:string,at:string>>"
BEGINNING = "file string, start long, inside boolean, depth int, on_path int, chat string, message string"
PIECES = "file string, chat string, message string, start long, text string, own string, texts array<string>"


class Text:
    """A piece of a document: its quotes, and its brackets by whether a string is open before the piece."""

    def __init__(self, text: bytes):
        self.text = text
        if b"\\" in text:  # escaped signs are none, the offsets stay
            text = text.replace(b"\\\\", b"__").replace(b'\\"', b"__")
        signs = np.frombuffer(text.translate(SIGNS), np.int8)
        at = np.flatnonzero(signs != 0)
        signs = signs[at]
        is_quote = signs == QUOTE
        self.quotes, self._at, self._signs, self._before = at[is_quote], at[~is_quote], signs[~is_quote], np.cumsum(is_quote)[~is_quote]

    def brackets(self, inside: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(offset, +1 or -1, number of quotes before) of the brackets outside strings."""
        chosen = (self._before & 1) == inside
        return self._at[chosen], self._signs[chosen], self._before[chosen]

    def ends_inside(self, inside: bool) -> bool:
        return inside != bool(len(self.quotes) & 1)

    def key(self, at: int, quotes_before: int) -> str:
        """The key of the container that opens at an offset; none in an array, and none of which a border cuts off a part."""
        if quotes_before < 2:
            return ""
        first, last = self.quotes[quotes_before - 2 : quotes_before].tolist()
        return self.text[first + 1 : last].decode(errors="replace") if self.text[last + 1 : at].strip() == b":" else ""

    def kind(self, at: int) -> str:
        return chr(self.text[at])


class Scan:
    """Reads a range piece by piece; ``opened`` are the containers left open, ``closed`` counts those closed that it has not opened."""

    def __init__(self, inside: bool, start: int):
        self.inside, self.start, self.read, self.closed, self.opened = inside, start, 0, 0, []

    def add(self, piece: Text) -> None:
        at, signs, before = piece.brackets(self.inside)
        if len(at):
            depth = np.cumsum(signs, dtype=np.int64)
            closed = max(0, -int(depth.min()))
            lowest_after = np.minimum.accumulate(depth[::-1])[::-1]
            left_open = (signs > 0) & (lowest_after == depth)
            opened = [(piece.key(a, n), piece.kind(a), f"{self.start}:{self.read + a}") for a, n in zip(at[left_open].tolist(), before[left_open].tolist())]
            self.closed, self.opened = _after(self.closed, self.opened, closed, opened)
        self.inside = piece.ends_inside(self.inside)
        self.read += len(piece.text)


def _after(closed: int, opened: list, more_closed: int, more_opened: list) -> tuple[int, list]:
    """What two neighbours close and leave open together."""
    return closed + max(0, more_closed - len(opened)), [*opened[: max(0, len(opened) - more_closed)], *more_opened]


class Cutter:
    """Cuts a range whose beginning is known: rows of PIECES without the file.

    A chat that begins and ends here is ``own``, its own fields, with ``texts``, its messages. Of other
    chats ``texts`` are the messages that are whole; the rest is pieces of one message, or of
    the own fields where ``message`` is NULL.
    """

    def __init__(self, start: int, inside: bool, depth: int, on_path: int, chat: str | None, message: str | None):
        #: on_path: how many of the open containers are on the way to a message.
        self.start, self.inside, self.depth, self.on_path, self.read = start, inside, depth, on_path, 0
        self.chat, self.message = chat, message
        self.whole_chat = self.whole_message = False
        self.own: list[bytes] = []
        self.part: list[bytes] = []
        self.texts: list[bytes] = []
        self.held = 0
        self.rows: list[tuple] = []

    def add(self, piece: Text) -> None:
        text = piece.text
        at, signs, before = piece.brackets(self.inside)
        after = self.depth + np.cumsum(signs, dtype=np.int64)
        # What is deeper than messages are changes nothing.
        low = after - np.minimum(signs, 0) <= MESSAGE_DEPTH
        depth, on_path, last = min(self.depth, MESSAGE_DEPTH), self.on_path, 0
        for a, sign, n in zip(at[low].tolist(), signs[low].tolist(), before[low].tolist()):
            if sign > 0:
                if depth == on_path and (piece.key(a, n) if PATH[depth][0] else "", piece.kind(a)) == PATH[depth]:
                    on_path += 1
                if depth == CHAT_DEPTH and self.chat is not None:
                    # A container in a chat stands for nothing in the chat's own fields.
                    self.own += (text[last:a], b"null")
                depth += 1
                if depth == on_path == CHAT_DEPTH:
                    self.chat, self.whole_chat, last = f"{self.start}:{self.read + a}", True, a
                elif depth == on_path == MESSAGE_DEPTH:
                    self.message, self.whole_message, last = f"{self.start}:{self.read + a}", True, a
            elif depth:
                if depth == MESSAGE_DEPTH and self.message is not None:
                    self.part.append(text[last : a + 1])
                    self.end_message()
                elif depth == CHAT_DEPTH and self.chat is not None:
                    self.own.append(text[last : a + 1])
                    self.end_chat()
                depth -= 1
                on_path = min(on_path, depth)
                last = a + 1
        if self.message is not None:
            self.part.append(text[last:])
        elif self.chat is not None and depth == CHAT_DEPTH:
            self.own.append(text[last:])
        self.depth, self.on_path = int(after[-1]) if len(after) else self.depth, on_path
        self.inside = piece.ends_inside(self.inside)
        self.read += len(text)

    def end_message(self) -> None:
        if self.whole_message:
            self.texts.append(b"".join(self.part))
            self.held += len(self.texts[-1])
            self.part = []
            if self.held > HELD_BYTES:
                self.whole_chat = False
                self.release()
        else:
            self.release_part()
        self.message = None

    def end_chat(self) -> None:
        if not self.whole_chat:
            self.release()
            self.release_own()
        elif self.texts:
            self.rows.append((None, None, None, None, b"".join(self.own), self.texts))
        self.chat, self.own, self.texts, self.held = None, [], [], 0

    def end_range(self) -> None:
        """What is held of a message or a chat that goes on in the next range."""
        self.release_part()
        self.release()
        self.release_own()

    def release(self) -> None:
        if self.texts:
            self.rows.append((self.chat, None, None, None, None, self.texts))
        self.texts, self.held = [], 0

    def release_part(self) -> None:
        if text := b"".join(self.part):
            self.rows.append((self.chat, self.message, self.start, text, None, None))
        self.part = []

    def release_own(self) -> None:
        if text := b"".join(self.own):
            self.rows.append((self.chat, None, self.start, text, None, None))
        self.own = []


def _ranges(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, value): what stands before each closing brace, in order within a range."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _several_to_a_task(ranges: DataFrame, range_bytes: int, task_bytes: int) -> DataFrame:
    """Small ranges in order, up to ``task_bytes`` to a task, as a task each costs more than it reads."""
    number = ranges.rdd.getNumPartitions()
    cores = ranges.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-number * range_bytes // task_bytes), TASKS_PER_CORE * cores)
    return ranges.coalesce(tasks) if tasks < number else ranges


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """(file, start, text): runs of records of one range, braces put back."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, starts, values = batch.columns
        other = [np.asarray(pc.not_equal(x[1:], x[:-1])) for x in (files, starts)]
        borders = np.flatnonzero(other[0] | other[1]) + 1
        runs = pa.ListArray.from_arrays(pa.array([0, *borders, len(values)], pa.int32()), values.cast(pa.binary()))
        for at, text in zip([0, *borders.tolist()], pc.binary_join(runs, b"}")):
            yield files[at].as_py(), starts[at].as_py(), text.as_py() + b"}"


def _columns(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    """The rows as a batch; the list is emptied."""
    columns = list(zip(*rows)) or [()] * len(kinds)
    rows.clear()
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds)], names=[n for n, _ in kinds])


def _summaries(ranges: DataFrame) -> DataFrame:
    container = pa.struct([("key", pa.string()), ("kind", pa.string()), ("at", pa.string())])
    kinds = [
        ("file", pa.string()), ("start", pa.int64()), ("assumed", pa.bool_()), ("ends_inside", pa.bool_()),
        ("closed", pa.int32()), ("opened", pa.list_(container)),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, scans, rows = None, [], []

        def end_range() -> None:
            for assumed, scan in enumerate(scans):
                opened = [dict(zip(("key", "kind", "at"), x)) for x in scan.opened]
                rows.append((*at, bool(assumed), scan.inside, scan.closed, opened))

        for file, start, text in _pieces(batches):
            if (file, start) != at:
                end_range()
                if len(rows) >= ROWS:
                    yield _columns(rows, kinds)
                at, scans = (file, start), [Scan(False, start), Scan(True, start)]
            piece = Text(text)
            for scan in scans:
                scan.add(piece)
        end_range()
        yield _columns(rows, kinds)

    return ranges.mapInArrow(run, SUMMARY)


def _beginnings(summaries: DataFrame) -> DataFrame:
    """(file, start, inside, depth, on_path, chat, message) of every range: one small row per range of a file, in order."""
    kinds = [
        ("file", pa.string()), ("start", pa.int64()), ("inside", pa.bool_()), ("depth", pa.int32()), ("on_path", pa.int32()),
        ("chat", pa.string()), ("message", pa.string()),
    ]

    def run(rows: pa.Table) -> pa.Table:
        inside, opened, out = False, [], []
        ordered = rows.sort_by([("start", "ascending"), ("assumed", "ascending")]).to_pylist()
        for both in zip(ordered[::2], ordered[1::2], strict=True):
            on_path = next((i for i, ((k, s, _), p) in enumerate(zip(opened, PATH)) if (k, s) != p), min(len(opened), len(PATH)))
            chat = opened[CHAT_DEPTH - 1][2] if on_path >= CHAT_DEPTH else None
            message = opened[MESSAGE_DEPTH - 1][2] if on_path >= MESSAGE_DEPTH else None
            out.append((both[0]["file"], both[0]["start"], inside, len(opened), on_path, chat, message))
            row = both[inside]
            opened = _after(0, opened, row["closed"], [tuple(x.values()) for x in row["opened"]])[1]
            inside = row["ends_inside"]
        return pa.Table.from_batches([_columns(out, kinds)])

    return summaries.groupBy("file").applyInArrow(run, BEGINNING)


def _cut_out(ranges: DataFrame, beginnings: DataFrame) -> DataFrame:
    """Rows of PIECES: whole messages, and what borders of ranges cut of messages and of chats' own fields."""
    # One row per range: sent to all tasks, as a shuffle of the text would lose its order.
    known: dict[str, dict[int, tuple]] = {}
    for file, start, *beginning in beginnings.collect():
        known.setdefault(file, {})[start] = tuple(beginning)
    shared = ranges.sparkSession.sparkContext.broadcast(known)
    strings = ("file", "chat", "message")
    kinds = [*((n, pa.string()) for n in strings), ("start", pa.int64()), ("text", pa.string()), ("own", pa.string()), ("texts", pa.list_(pa.string()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cutter, rows, read = None, None, [], 0

        def end_range() -> None:
            if cutter:
                cutter.end_range()
                take()

        def take() -> None:
            rows.extend((at[0], *row) for row in cutter.rows)
            cutter.rows.clear()

        for file, start, text in _pieces(batches):
            if (file, start) != at:
                end_range()
                at, cutter = (file, start), Cutter(start, *shared.value[file][start])
            cutter.add(Text(text))
            take()
            read += len(text)
            if read > HELD_BYTES:
                yield _columns(rows, kinds)
                read = 0
        end_range()
        yield _columns(rows, kinds)

    return ranges.mapInArrow(run, PIECES)


def read_messages_split(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``messages_of(chats_of(read_export(path)))`` of valid multi-line documents, each read by many tasks.

    For few large documents: the text is read twice, and the driver keeps one small row per
    range. A text that is no string is kept as compact JSON.
    """
    task_bytes = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    # Ranges of exactly this size, so that both readings have the same ones whatever the cluster.
    fixed = {"spark.sql.files.maxPartitionBytes": str(range_bytes), "spark.sql.files.openCostInBytes": str(range_bytes)}
    with settings(spark, fixed):
        ranges = _several_to_a_task(_ranges(spark, path), range_bytes, task_bytes)
        pieces = cut(_cut_out(ranges, _beginnings(_summaries(ranges))), "export-pieces")
    own_fields = "id bigint, name string"
    whole = pieces.filter(F.col("own").isNotNull()).select(F.from_json("own", own_fields).alias("c"), "texts")
    # Pieces of one message or of a chat's own fields, in order.
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "text"))), lambda x: x["text"]), "")
    joined = pieces.filter(F.col("text").isNotNull()).groupBy("file", "chat", "message").agg(text.alias("text"))
    chats = joined.filter(F.col("message").isNull()).select("file", "chat", F.from_json("text", own_fields).alias("c"))
    loose = pieces.filter(F.col("own").isNull() & F.col("texts").isNotNull()).select("file", "chat", "texts")
    cut_apart = joined.filter(F.col("message").isNotNull()).select("file", "chat", F.array("text").alias("texts"))
    others = loose.unionByName(cut_apart).join(chats, ["file", "chat"]).select("c", "texts")
    messages = whole.unionByName(others).select(F.col("c.id").alias("chat_id"), F.col("c.name").alias("chat_name"), F.explode("texts").alias("text"))
    return messages.select("chat_id", "chat_name", F.from_json("text", RAW_MESSAGE).alias("m")).select("chat_id", "chat_name", "m.*")
