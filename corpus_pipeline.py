"""The corpus pipeline: language, near duplicates, secrets, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written and read again as the next one's docs. All
but the last return the columns of ``documents``. A stage works on every row its
predecessor kept: rows may repeat, ids may be NULL or repeat, texts may be NULL.
"""

from __future__ import annotations

import sys
from functools import wraps
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark import cloudpickle  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import threadloom  # noqa: E402
from threadloom.lineage import cut, drop, recorded  # noqa: E402
from threadloom.llm.common import ROW, numbered, table  # noqa: E402
from threadloom.llm.curriculum import mixed_documents  # noqa: E402
from threadloom.llm.language import LanguageParams, train, with_language  # noqa: E402
from threadloom.llm.minhash import near_duplicates  # noqa: E402
from threadloom.llm.packing import PackParams, pack_documents  # noqa: E402
from threadloom.llm.queries import TOKENIZER  # noqa: E402
from threadloom.llm.secret_grammar import redact  # noqa: E402

cloudpickle.register_pickle_by_value(threadloom)


#: Tables that stages made for themselves, by data folder and stage, where a caller writes between them.
_made: dict[tuple[str, int], list[str]] = {}


def stage(fn):
    """A stage for callers that write each result and read it as the next one's docs.

    It first deletes what earlier stages over the same data folder made for themselves,
    as their results are written by then; tables that ``docs`` still reads stay. ``run`` and
    whoever uses ``stage.plain`` keep their own tables.
    """

    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        at = [name for name, _ in STAGES].index(fn.__name__)
        done = {k: paths for k, paths in _made.items() if k[0] == sf_dir and k[1] < at}
        if done:
            read = {part for f in docs.inputFiles() for part in f.split("/")[-3:]}
            for key, paths in done.items():
                gone = [p for p in paths if p.rsplit("/", 1)[1] not in read]
                drop(spark, gone)
                _made[key] = [p for p in paths if p not in gone]
        with recorded() as paths:
            out = fn(spark, docs, sf_dir)
        _made.setdefault((sf_dir, at), []).extend(paths)
        return out

    run_stage.plain = fn
    return run_stage


@stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those that the classifier knows no language for.

    The model learns from the labelled documents at hand; what languages reach is
    measured on held-out ones (``Model.fits``). NULL and empty texts have no letter. Long
    texts are judged segment by segment, repeated rows alike, other columns pass through.
    """
    return with_language(docs, train(docs, LanguageParams()))


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: the one with the smallest id."""
    stored = numbered(docs, "dedup-documents")
    groups = near_duplicates(stored, id_col=ROW).select(ROW, "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", ROW))[ROW]
    kept = groups.join(stored.select(ROW, "doc_id"), ROW).groupBy("component_id").agg(first.alias(ROW)).select(ROW)
    return stored.join(kept, ROW, "left_semi").select(*docs.columns)


@stage
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret; the length column follows."""
    return redact(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


@stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Brings sources to their target weights and puts copies in training order."""
    return mixed_documents(docs)


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every token piece in a sequence."""
    return pack_documents(docs, PackParams(TOKENIZER))


STAGES = [
    ("language", language), ("near_dedup", near_dedup), ("secrets", secrets), ("mixing", mixing), ("packing", packing),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    Every stage's own tables go when its result is written, and a result when the next
    one is; what the last stage reads stays. Runs share no tables.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    for name, step in STAGES[:-1]:
        with recorded() as made:
            out = step.plain(spark, docs, sf_dir)
        with recorded() as result:
            docs = cut(out, f"pipeline-{name}")
        drop(spark, made + before)
        before = result
    return STAGES[-1][1].plain(spark, docs, sf_dir)
