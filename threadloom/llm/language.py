"""Language identification with string kernels.

A text is cut into segments; a segment is the set of its hashed byte n-grams of
1 to 4 bytes (the blended spectrum, presence only). The kernel of two segments
is the size of the common part over the root of both sizes. Segments drawn per
language serve as training set and, some of them, as Nyström landmarks; one
ridge regression per language is solved in the landmark features. As the kernel
is linear in normalised presence vectors, landmarks and coefficients fold into
one matrix (buckets x languages), and a batch of segments is scored by one
matrix product. A document's score is the mean over all its segments.

Defined cases: a NULL text, or one without a letter, is ``und`` with score 0.
Rows with NULL language train nothing; without any training row all texts are
``und``. Ties go to the language that sorts first. A NULL id is never held out
and never trains. An empty table gives no rows. Only id, text and language are
read, and the language only for training.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import astuple, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.lineage import cut

LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"
# Bytes that are no letter become a blank; bytes above 127 stay.
_BLANK = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))


@dataclass(frozen=True)
class LanguageParams:
    """``per_label``: training segments drawn per language at most, and ``most`` in all;
    ``landmarks`` of them are Nyström landmarks. ``segment``: bytes. ``buckets``: hash range of the
    n-grams. ``ridge``: regularisation. ``sharpness``: of the score, which is the
    softmax of the regression values."""

    per_label: int = 600
    most: int = 6000
    landmarks: int = 512
    segment: int = 1024
    buckets: int = 1 << 14
    longest: int = 4
    ridge: float = 0.1
    sharpness: float = 8.0


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in LETTER.finditer(text))


def letters_only(text: str) -> bytes:
    return text.lower().encode().translate(_BLANK)


def segments(data: bytes, size: int) -> list[bytes]:
    """Whole text in even pieces of at most ``size`` bytes."""
    n = max(1, -(-len(data) // size))
    step = -(-len(data) // n) if data else 0
    return [data[i * step:(i + 1) * step] for i in range(n)] if data else [b""]


def presence(parts: list[bytes], p: LanguageParams) -> np.ndarray:
    """0/1 rows over the hash buckets; runs of blanks count once at most."""
    out = np.zeros((len(parts), p.buckets), bool)
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
    row = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    code = np.zeros(len(data), np.uint32)
    for n in range(1, p.longest + 1):
        if len(data) < n:
            break
        code = code[: len(data) - n + 1] * np.uint32(257) + data[n - 1:]
        last = code[: len(code)]
        inside = row[: len(last)] == row[n - 1:]
        double = (data[: len(last)] == 32) & (data[n - 1:] == 32)  # says nothing about the language
        keep = inside & ~double
        hashed = (last[keep] * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(32 - p.buckets.bit_length() + 1)
        out[row[: len(last)][keep], hashed] = True
    return out


def normalised(rows: np.ndarray) -> np.ndarray:
    x = rows.astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1.0))


@dataclass(frozen=True)
class Model:
    labels: list[str]
    weights: np.ndarray  # buckets x labels
    bias: np.ndarray
    params: LanguageParams
    known: np.ndarray  # buckets that a landmark holds
    reached: float = 1.0  # least share of known n-grams in a training segment
    shuffled: float = 0.0  # mean share in training segments of shuffled letters
    floors: tuple[tuple[int, float], ...] = ()  # bytes, and the least best value of held-out segments of so many

    def best(self, parts: list[bytes]) -> float:
        """Regression value of the best language of each segment, on average."""
        return float(self.values(parts).max(axis=1).mean())

    def shares(self, parts: list[bytes]) -> np.ndarray:
        """Share of known n-grams of each segment."""
        held = [presence(parts[i:i + 64], self.params) for i in range(0, len(parts), 64)]
        return np.concatenate([x[:, self.known].sum(axis=1) / np.maximum(x.sum(axis=1), 1) for x in held])

    def share(self, parts: list[bytes]) -> tuple[float, int]:
        """Share of known n-grams over all segments, and how many n-grams there are."""
        n = k = 0
        for i in range(0, len(parts), 64):
            held = presence(parts[i:i + 64], self.params)
            n += int(held.sum())
            k += int(held[:, self.known].sum())
        return k / max(n, 1), n

    def fits(self, texts: list[str | None], chance: float = 1.8444397270569681) -> list[bool]:
        """Whether some language fits; False without a letter.

        One fits whose value reaches what held-out segments of a known language as long
        reach, segment by segment, so texts in several languages fit. Below that, as
        where languages change from word to word, n-grams decide: the text goes if its share
        of known ones is, by Hoeffding bounds, below that of every training segment and
        nearer to that of shuffled letters. Very short texts pass in doubt.
        """
        out = []
        for text in texts:
            if text is None or not has_letter(text):
                out.append(False)
                continue
            data = letters_only(text)
            parts = segments(data, self.params.segment)
            floor = max((v for size, v in self.floors if size <= len(data)), default=-np.inf) if self.labels else -np.inf
            if floor == -np.inf or self.best(parts) >= floor:
                out.append(True)
                continue
            share, n = self.share(parts)
            margin = float(np.sqrt(chance / max(n, 1)))
            out.append(not (share + margin < self.reached and share - margin <= (self.reached + self.shuffled) / 2))
        return out

    def values(self, parts: list[bytes]) -> np.ndarray:
        """Regression value of every label for every segment: one product per block."""
        blocks = [
            normalised(presence(parts[i:i + 64], self.params)) @ self.weights for i in range(0, len(parts), 64)
        ]
        return np.concatenate(blocks) + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        known = [t is not None and len(self.labels) > 0 and has_letter(t) for t in texts]
        parts, owner = [], []
        for i, t in enumerate(texts):
            if known[i]:
                mine = segments(letters_only(t), self.params.segment)
                parts += mine
                owner += [i] * len(mine)
        total = np.zeros((len(texts), max(1, len(self.labels))))
        if parts:
            np.add.at(total, np.array(owner), self.values(parts))
            total /= np.maximum(np.bincount(owner, minlength=len(texts)), 1)[:, None]
        e = np.exp(self.params.sharpness * (total - total.max(axis=1, keepdims=True)))
        best = total.argmax(axis=1)
        score = e[np.arange(len(texts)), best] / e.sum(axis=1)
        return (
            [self.labels[b] if k else UNKNOWN for b, k in zip(best, known)],
            [float(s) if k else 0.0 for s, k in zip(score, known)],
        )


def packed(model: Model) -> tuple:
    """Plain values of a model: workers need no installed copy of this package to read them."""
    rest = (model.known, model.reached, model.shuffled, model.floors)
    return model.labels, model.weights, model.bias, astuple(model.params), *rest


def unpacked(values: tuple) -> Model:
    return Model(*values[:3], LanguageParams(*values[3]), *values[4:])


def _solved(samples: list[tuple[str, bytes]], labels: list[str], p: LanguageParams) -> tuple[Model, np.ndarray]:
    """Model by kernel ridge regression over Nyström features, and its landmarks."""
    y = np.where(np.array([label for label, _ in samples])[:, None] == np.array(labels), 1.0, -1.0)
    spread = np.argsort(np.arange(len(samples)) * 0.6180339887498949 % 1.0, kind="stable")
    marks = normalised(presence([samples[i][1] for i in np.sort(spread[: p.landmarks])], p))
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = value > 1e-6 * value.max()
    project = vector[:, good] / np.sqrt(value[good])  # kernel values to Nyström features
    kernel = [normalised(presence([s for _, s in samples[i:i + 64]], p)) @ marks.T for i in range(0, len(samples), 64)]
    z = np.concatenate(kernel).astype(np.float64) @ project
    mean, bias = z.mean(axis=0), y.mean(axis=0)
    z0 = z - mean
    w = np.linalg.solve(z0.T @ z0 + p.ridge * np.eye(z.shape[1]), z0.T @ (y - bias))
    return Model(labels, (marks.T @ (project @ w)).astype(np.float32), bias - mean @ w, p, marks.any(axis=0)), marks


FLOOR_SIZES = (32, 64, 128, 256, 512, 1024)  # bytes


def fit(samples: list[tuple[str, bytes]], p: LanguageParams) -> Model:
    """Model from (label, segment) pairs, taken in the given order.

    What a language reaches is measured on a fifth of the segments by a model of the others.
    """
    labels = sorted({label for label, _ in samples})
    if not labels:
        return Model([], np.zeros((p.buckets, 0), np.float32), np.zeros(0), p, np.zeros(p.buckets, bool))
    model, _ = _solved(samples, labels, p)
    parts = [part for _, part in samples]
    rng = np.random.default_rng(0)
    mixed = [bytes(rng.permutation(np.frombuffer(part, np.uint8))) for part in parts[:: max(1, len(parts) // 200)]]
    held, rest = samples[4::5], [x for i, x in enumerate(samples) if i % 5 != 4]
    floors = []
    if held and {label for label, _ in rest} == set(labels):
        other, _ = _solved(rest, labels, p)
        for size in FLOOR_SIZES:
            long = [part[:size] for _, part in held if len(part) >= size]
            if long:
                floors.append((size, float(other.values(long).max(axis=1).min())))
    return replace(model, reached=float(model.shares(parts).min()), shuffled=float(model.shares(mixed).mean()), floors=tuple(floors))


# ---- Spark side

def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))


def train(docs: DataFrame, p: LanguageParams, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model from a bounded draw: one segment each of ``per_label`` rows per language, in
    the order of a hash of the id; the rows are cut to segments on the executors."""

    def cut_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for label, turn, text in zip(*(c.to_pylist() for c in (batch.column(i) for i in range(3)))):
                if text and has_letter(text):
                    mine = segments(letters_only(text), p.segment)
                    rows.append((label, turn, mine[int(turn[:8], 16) % len(mine)]))
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.binary()))], names=["label", "turn", "part"]
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("label"))
    rows = training_rows(rows, "id", "text", "label").withColumn("turn", F.md5(F.concat(F.lit("lang:"), F.col("id").cast("string"))))
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    each = max(1, min(p.per_label, p.most // max(1, len(counts))))
    # A share of each language that holds twice the draw, so that few texts move.
    limits = docs.sparkSession.createDataFrame(
        [(label, f"{int(min(2 * each / n, 1.0) * (16**8 - 1)):08x}") for label, n in counts.items()], "label string, upto string"
    )
    # Written, so that the planner knows its size and leaves the texts in place.
    drawn = rows.join(cut(limits, "language-shares"), "label").filter(F.substring("turn", 1, 8) <= F.col("upto")).select("label", "turn", "text")
    parts = drawn.mapInArrow(cut_segments, "label string, turn string, part binary")
    first = Window.partitionBy("label").orderBy("turn", "part")
    picked = parts.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= each)
    samples = sorted((r.turn, r.label, bytes(r.part)) for r in picked.select("turn", "label", "part").collect())
    return fit([(label, part) for _, label, part in samples], p)


def predict(docs: DataFrame, model: Model, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """Adds the predicted language and its score; all other columns pass through."""
    names = docs.columns
    at = names.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(packed(model))  # buckets x labels, a fixed size per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unpacked(shared.value)
        for whole in batches:
            for batch in (whole.slice(i, 256) for i in range(0, len(whole), 256)):
                label, score = known.predict(batch.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(label, pa.string()), pa.array(score, pa.float64())],
                    names=[*names, pred_col, score_col],
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, `{pred_col}` string, `{score_col}` double")


def with_language(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows whose text has a letter and is not foreign to all languages of the model."""
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(packed(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unpacked(shared.value)
        for batch in batches:
            yield batch.filter(pa.array(known.fits(batch.column(at).to_pylist()), pa.bool_()))

    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))


def identify(docs: DataFrame, p: LanguageParams | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score) for every document."""
    model = train(docs, p or LanguageParams(), id_col, text_col, lang_col)
    narrow = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return predict(narrow, model).select(id_col, "held_out", "lang_pred", "score")
