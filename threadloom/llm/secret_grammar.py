"""Secret scan by grammar inference.

Three patterns give the base findings, which are labelled credentials. From a
bounded draw of them, one probabilistic automaton per kind is inferred: the
prefix tree of their formats (strings of character classes), in which states
with statistically compatible futures are merged. A background model of class
pairs is counted over all other tokens of all documents. Every token that base
findings do not cover is a candidate, whole and what they leave of it; it is added if its likelihood as a credential exceeds
that as an ordinary token by the odds that nearly all labelled credentials reach.

Defined cases: NULL text is empty and has no findings; without labelled
credentials nothing is added. Repeated rows are scanned and labelled repeatedly,
but a credential is drawn once. An empty table gives no rows. Other columns are
not read by ``scan`` and pass through ``redact`` unchanged.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed patterns of the base findings.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "grammar")
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")

# Character classes of a format: digit, a-f, other lower case, upper case, and every sign for itself.
_CLASS = {c: "d" for c in "0123456789"} | {c: "x" for c in "abcdef"} | {c: "l" for c in "ghijklmnopqrstuvwxyz"}
SIGNS = "+/_.=-"
_CLASS |= {c: "U" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {c: c for c in SIGNS}
_FORMAT = str.maketrans(_CLASS)
SYMBOLS = sorted(set(_CLASS.values()))
END = "$"


@dataclass(frozen=True)
class GrammarParams:
    """``per_kind``: labelled credentials drawn per kind, of ``longest`` characters at
    most. ``alpha``: chance of splitting equal states. ``odds``: least log-odds;
    ``share`` of the labelled ones must pass the limit that is used. ``known``: formats
    whose verdict a task remembers."""

    per_kind: int = 400
    longest: int = 128
    alpha: float = 0.05
    odds: float = 8.0
    share: float = 0.99
    known: int = 100_000


# ---- base findings

def base_findings(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, credential) by start, then kind."""
    found = [(m.start(), 0, m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    found += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.group()) for m in HEX.finditer(text)]
    return sorted(found)


def tokens(text: str, base: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(start, end, parts) of every token; ``parts`` lie outside the base findings."""
    at, open_ = 0, []  # findings that may reach into this token or a later one
    for m in TOKEN.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            open_.append((base[at][0], base[at][2]))
            at += 1
        parts, free = [], m.start()
        for start, end in open_:
            if start > free:
                parts.append((free, start))
            free = max(free, end)
        if free < m.end():
            parts.append((free, m.end()))
        open_ = [x for x in open_ if x[1] > m.end()]
        yield m.start(), m.end(), parts


def other_tokens(text: str, base: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """Tokens that no base finding touches."""
    for start, end, parts in tokens(text, base):
        if parts == [(start, end)]:
            yield start, end, text[start:end]


# ---- automata

class Automaton:
    """Deterministic, with counts of passing, ending and each step."""

    def __init__(self):
        self.step: list[dict[str, int]] = [{}]
        self.passes: list[dict[str, int]] = [{}]
        self.ends: list[int] = [0]

    @classmethod
    def prefix_tree(cls, formats: list[str]) -> Automaton:
        a = cls()
        for f in formats:
            s = 0
            for c in f:
                if c not in a.step[s]:
                    a.step[s][c] = len(a.step)
                    a.step.append({})
                    a.passes.append({})
                    a.ends.append(0)
                a.passes[s][c] = a.passes[s].get(c, 0) + 1
                s = a.step[s][c]
            a.ends[s] += 1
        return a

    def total(self, s: int) -> int:
        return self.ends[s] + sum(self.passes[s].values())

    def compatible(self, a: int, b: int, alpha: float) -> bool:
        """Hoeffding test on endings and steps of both states and of all that follow."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.total(a), self.total(b)
            if n == 0 or m == 0:
                continue
            bound = math.sqrt(math.log(2 / alpha) / 2) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            for c in self.passes[a].keys() | self.passes[b].keys():
                if abs(self.passes[a].get(c, 0) / n - self.passes[b].get(c, 0) / m) > bound:
                    return False
                if c in self.step[a] and c in self.step[b]:
                    todo.append((self.step[a][c], self.step[b][c]))
        return True

    def fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to state ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.ends[a] += self.ends[b]
            for c, n in self.passes[b].items():
                self.passes[a][c] = self.passes[a].get(c, 0) + n
                if c in self.step[a]:
                    todo.append((self.step[a][c], self.step[b][c]))
                else:
                    self.step[a][c] = self.step[b][c]

    def merge_states(self, alpha: float) -> None:
        """Merge each frontier state with the first compatible settled one, or settle it."""
        settled = [0]
        while True:
            inside = set(settled)
            frontier = [(s, c) for s in settled for c, t in self.step[s].items() if t not in inside]
            if not frontier:
                return
            s, c = max(frontier, key=lambda x: (self.total(self.step[x[0]][x[1]]), -x[0], x[1]))
            t = self.step[s][c]
            for r in settled:
                if self.compatible(r, t, alpha):
                    self.step[s][c] = r
                    self.fold(r, t)
                    break
            else:
                settled.append(t)

    def log_likelihood(self, f: str) -> float:
        """Of a whole format; unseen steps have a small chance and stay in the state."""
        s, total = 0, 0.0
        for c in f:
            total += math.log((self.passes[s].get(c, 0) + 0.01) / (self.total(s) + 0.01 * (len(SYMBOLS) + 1)))
            s = self.step[s].get(c, s)
        return total + math.log((self.ends[s] + 0.01) / (self.total(s) + 0.01 * (len(SYMBOLS) + 1)))


def infer(formats: list[str], alpha: float) -> Automaton:
    a = Automaton.prefix_tree(formats)
    a.merge_states(alpha)
    return a


class Grammar:
    """Automata of the kinds, background model and limit."""

    def __init__(self, labelled: dict[str, list[str]], pairs: dict[tuple[str, str], int], p: GrammarParams):
        self.params = p
        formats = {k: sorted(v) for k, v in labelled.items()}
        self.automata = [infer(f, p.alpha) for _, f in sorted(formats.items()) if f]
        from_ = Counter()
        for (a, _), n in pairs.items():
            from_[a] += n
        k = len(SYMBOLS) + 1
        self.pair = {
            (a, b): math.log((pairs.get((a, b), 0) + 1) / (from_[a] + k)) for a in [*SYMBOLS, ""] for b in [*SYMBOLS, END]
        }
        scores = np.sort([self.odds(f) for v in formats.values() for f in v])
        self.limit = max(p.odds, float(scores[int(len(scores) * (1 - p.share))])) if len(scores) else math.inf
        self.verdicts: dict[str, bool] = {}

    def odds(self, f: str) -> float:
        """Log-odds of a format: best automaton against background."""
        background = sum(self.pair[a, b] for a, b in zip(["", *f], [*f, END]))
        return max(a.log_likelihood(f) for a in self.automata) - background

    def likely(self, token: str) -> bool:
        """Whether the format reaches the limit; formats recur, so verdicts are kept."""
        f = token.translate(_FORMAT)
        if len(f) > self.params.longest:
            return self.odds(f) >= self.limit
        if f not in self.verdicts:
            if len(self.verdicts) >= self.params.known:
                self.verdicts.clear()
            self.verdicts[f] = self.odds(f) >= self.limit
        return self.verdicts[f]

    def added(self, text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
        if not self.automata:
            return []
        found = []
        for start, end, parts in tokens(text, base):
            # What base findings leave of a token is a candidate too, with and without the signs that join it to them.
            if parts and self.likely(text[start:end]):
                found.append((start, 3, end, text[start:end]))
            elif parts != [(start, end)]:
                for a, b in parts:
                    rest = text[a:b]
                    if self.likely(rest) or ((bare := rest.strip(SIGNS)) != rest and self.likely(bare)):
                        found.append((a, 3, b, rest))
        return found


# ---- Spark side

def learn(docs: DataFrame, p: GrammarParams, text_col: str = "text") -> Grammar:
    """Labelled credentials and background counts from all documents.

    Distinct credentials are drawn per kind in the order of their hash; at most
    ``per_kind`` of each kind and one count per pair of classes reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: Counter = Counter()
        for batch in batches:
            labelled = set()
            for text in batch.column(0):
                text = text.as_py()
                if text:
                    base = base_findings(text)
                    labelled.update((KINDS[k], v) for _, k, _, v in base if len(v) <= p.longest)
                    for _, _, token in other_tokens(text, base):
                        f = token.translate(_FORMAT)
                        pairs.update(zip(["", *f], [*f, END]))
            kinds, values = zip(*labelled) if labelled else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(values, pa.string()), pa.array([0] * len(kinds), pa.int64())], names=["kind", "value", "n"]
            )
        yield pa.RecordBatch.from_arrays(
            [pa.array([""] * len(pairs), pa.string()), pa.array(["\t".join(x) for x in pairs], pa.string()), pa.array(list(pairs.values()), pa.int64())],
            names=["kind", "value", "n"],
        )

    found = docs.select(text_col).mapInArrow(run, "kind string, value string, n long").groupBy("kind", "value").agg(F.sum("n").alias("n"))
    first = Window.partitionBy("kind").orderBy(F.md5("value"), "value")
    # Pairs number at most (classes + 1) squared, which is below the draw of each kind.
    rows = found.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= max(p.per_kind, (len(SYMBOLS) + 1) ** 2)).collect()
    labelled = {k: [r.value.translate(_FORMAT) for r in rows if r.kind == k and r.r <= p.per_kind] for k in KINDS[:3]}
    return Grammar(labelled, {tuple(r.value.split("\t")): r.n for r in rows if r.kind == ""}, p)


def written(findings: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in sorted(findings))


def scan(docs: DataFrame, p: GrammarParams | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_added, base_sha256, spans) per document."""
    grammar = learn(docs, p or GrammarParams(), text_col)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_findings(text)
                added = grammar.added(text, base)
                counts = [sum(k == n for _, k, _, _ in base) for n in range(3)]
                rows.append((*counts, len(added), hashlib.sha256(written(base).encode()).hexdigest(), written(base + added)))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string()] * 2)],
                names=[id_col, "n_assign", "n_access", "n_hex", "n_added", "base_sha256", "spans"],
            )

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, n_added long, base_sha256 string, spans string"
    )


def masked(text: str, findings: list[tuple[int, int, int, str]], mark: str) -> str:
    """Text with every finding (overlapping ones together) replaced by ``mark``."""
    out, at = [], 0
    for start, _, end, _ in sorted(findings):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, p: GrammarParams | None = None, text_col: str = "text", mark: str = "[secret]", length_col: str | None = None) -> DataFrame:
    """``docs`` with all findings masked; ``length_col`` is set anew where the text changes."""
    grammar = learn(docs, p or GrammarParams(), text_col)
    at = docs.columns.index(text_col)
    length = docs.columns.index(length_col) if length_col else None
    kinds = [f.dataType.simpleString() for f in docs.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column(at):
                text = text.as_py()
                if text:
                    base = base_findings(text)
                    text = masked(text, base + grammar.added(text, base), mark)
                texts.append(text)
            columns = list(batch.columns)
            if length is not None:
                old = batch.column(at).to_pylist()
                sizes = [n if t == o else len(t) for n, t, o in zip(columns[length].to_pylist(), texts, old)]
                columns[length] = pa.array(sizes, columns[length].type)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=docs_columns)

    docs_columns = docs.columns
    return docs.mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in zip(docs_columns, kinds)))
