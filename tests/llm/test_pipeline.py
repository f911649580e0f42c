import os
import random
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
from test_minhash import brute
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as cp
from threadloom.lineage import cut
from threadloom.llm.secret_grammar import base_findings

ROOT = Path(__file__).resolve().parents[2]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the cat sat on that mat and then it was over with all of them there".split(),
         "es": "el gato se sienta sobre la alfombra y entonces todo esto ya ha terminado".split()}


def documents():
    rng = random.Random(8)
    rows = []
    for i in range(120):
        lang = ("en", "es")[i % 3 == 0]
        text = " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "s", "a", "er"]) for _ in range(rng.randint(8, 120)))
        if i % 10 == 4:
            text += ' token = "' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '"'
        rows.append((i, text, lang, f"src{i % 4}"))
    copy = rows[7][1]
    rows += [(200, copy, "en", "src1"), (201, copy.upper(), "en", "src2"), (202, copy + " end", "en", None), (203, copy, "en", "src1")]
    rows += [(300, None, "en", "src0"), (301, "", None, None), (302, "123 456 $$", "en", "src3")]
    rows += [(None, "a text without any id that is kept as the others are", None, "src1"), (5, rows[5][1], "en", "src1")]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows]


def test_stages(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    stages = dict(cp.STAGES)
    assert [n for n, _ in cp.STAGES] == ["language", "near_dedup", "secrets", "mixing", "packing"]

    def step(name, df):
        out = cut(stages[name](spark, df, ""), f"test-{name}")
        assert name == "packing" or out.dtypes == docs.dtypes
        return out, out.collect()

    kept, rows = step("language", docs)
    assert {r[0] for r in documents()} - {r.doc_id for r in rows} == {300, 301, 302}
    assert len(rows) == len(documents()) - 3

    single, left = step("near_dedup", kept)
    groups = brute([r.text for r in rows], 5)
    first = {}
    for r, (_, g) in zip(rows, groups):
        at = (r.doc_id is None, r.doc_id or 0)
        first[g] = min(first.get(g, at), at)
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in left) == Counter(first.values())

    clean, masked = step("secrets", single)
    before = {r.doc_id: r.text for r in left}
    for r in masked:
        assert not base_findings(r.text) and r.n_chars == len(r.text)
        assert (r.text == before[r.doc_id]) == (not base_findings(before[r.doc_id]))

    mixed, taken = step("mixing", clean)
    sizes, words, each = Counter(), Counter(), Counter()
    for r in masked:
        sizes[r.source] += len(r.text.split())
    for r in taken:
        words[r.source] += len(r.text.split())
        each[r.doc_id] += 1
    assert abs(sum(words.values()) - 1.5 * sum(sizes.values())) <= len(sizes)
    assert all(words[s] <= 2 * sizes[s] for s in sizes) and max(each.values()) <= 2

    _, pieces = step("packing", mixed)
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    tokens = sum(len(encode(r.text, add_special_tokens=False).ids) + 1 for r in taken)
    assert sum(r.length for r in pieces) == tokens
    fill = Counter()
    for r in pieces:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 4096 and len(fill) == int(np.ceil(tokens / 4096))


def test_language_keeps_short_mixed_and_many(spark):
    rng = random.Random(9)

    def prose(words, n):
        return " ".join(rng.choice(words) for _ in range(n))

    langs = {f"l{i:02d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(40)] for i in range(12)}
    rows = [(i * 12 + j, prose(w, 80), lang, "s", 0) for i in range(20) for j, (lang, w) in enumerate(langs.items())]
    three = [prose(langs[f"l{i:02d}"], 300) for i in range(3)]
    keep = [max(langs["l00"], key=len), langs["l05"][3], " ".join(three), " ".join(" ".join(x) for x in zip(*(t.split() for t in three)))]
    drop = ["\u041f\u0440\u0438\u0432\u0435\u0442 \u043c\u0438\u0440 \u043a\u0430\u043a \u0434\u0435\u043b\u0430 \u0441\u0435\u0433\u043e\u0434\u043d\u044f " * 3, "12 34", None]
    rows += [(1000 + i, t, None, "s", 0) for i, t in enumerate(keep)] + [(2000 + i, t, None, "s", 0) for i, t in enumerate(drop)]
    left = {r.doc_id for r in dict(cp.STAGES)["language"](spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert left == {r[0] for r in rows if r[0] < 2000}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    for _, stage in cp.STAGES:
        df = cut(stage(spark, df, ""), "test-empty")
        assert df.count() == 0


def test_run_is_registered():
    assert entry.queries()["pipeline"] is cp.run
    assert {n.split("_")[0] for n in entry.queries() if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}


def test_two_runs_share_nothing(spark, tmp_path):
    spark.createDataFrame(documents(), SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    first, second = cp.run(spark, str(tmp_path)), cp.run(spark, str(tmp_path))
    assert first.count() == second.count() > 0


def test_workers_need_no_copy_of_the_package(tmp_path):
    """From another folder, with a bare search path."""
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
q = e.queries()
assert q["op3_string_kernels"](spark, "/root/testdata/sf0.001").count() == 200
import corpus_pipeline as cp
docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
assert cp.STAGES[0][1](spark, docs, "").count() > 100
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.returncode == 0, done.stderr[-1500:]


def test_rest_works_where_a_dependency_is_missing(tmp_path):
    """The other queries stay, and a warning says what is left out."""
    (tmp_path / "xxhash.py").write_text("raise ImportError('no xxhash here')")
    code = f"""
import sys; sys.path[:0] = [{str(tmp_path)!r}, {str(ROOT)!r}]
import __spark_entry__ as e
q = e.queries(); assert "thread_rollup" in q and "pipeline" not in q and not any(n.startswith("op1") for n in q)
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0 and "no xxhash here" in done.stderr, done.stderr[-1500:]


def test_rest_works_without_the_subpackage(tmp_path):
    rest = tmp_path / "rest"
    shutil.copytree(ROOT, rest, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'thread_rollup' in q and 'pipeline' not in q; print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=rest, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-500:]
