import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from threadloom.llm.quality_rules import Threshold, judge

SCHEMA = "doc_id long, text string, words string, n_words string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if times[g] > 1 for j in range(5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
    )


def judged(spark, texts):
    out = judge(spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], SCHEMA)).collect()
    assert len(out) == len(texts)
    return [r for r in sorted(out, key=lambda r: r.doc_id)]


def check(spark, texts):
    for text, r in zip(texts, judged(spark, texts)):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(text), (text or "")[:200]
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and not r.broken_rules)


def test_counts_against_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", " \t\n", "a", "a b c d e", "a b c d e a b c d e", "a a a a a a", "a a a a a", "x\n\nx\n y\nx", "\x0b\x0c|#é ü| 😀😀 \x00b"]
    for _ in range(60):
        alphabet = rng.choice(["ab", "abcdefgh", "aé#| "])
        texts.append("".join(rng.choice(alphabet + "  \n\t") for _ in range(rng.randrange(400))))
    check(spark, texts)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab \n#", max_size=80), max_size=20))
def test_any_text(spark, texts):
    if texts:
        check(spark, texts)


def test_very_long_text(spark):
    rng = random.Random(1)
    check(spark, [" ".join(f"w{rng.randrange(40)}" for _ in range(300_000)), "\n".join(["the same line"] * 50_000)])


GOOD = "The house on the hill was built by two brothers, and it is known for the view of the lake that lies below."


def test_rules(spark):
    texts = [
        GOOD, "Der Garten ist für die Kinder und das Haus ist mit dem Hof von der Straße zu sehen.",
        " ".join(w + "%%%" for w in GOOD.split()), "HOME | " * 3 + " | ".join(GOOD.split()),
        " ".join(w + "!" for w in GOOD.split()), "Home Contact Imprint Search Basket Login Register Offers News Blog Archive Jobs",
        "1 2 3 4 5 6 7 8 the of and 9 10 11", "\n".join(f"- the {c * 6} of reading" for c in "abcdefghij"),
        "\n".join(f"the {c * 6} of reading ..." for c in "abcdefghij"), "a b c d e f g h i of the a",
        "x" * 500 + " the of and to in is it that was for", "\n".join(["this is the end of pages"] * 2 + [f"and it was written for {x}" for x in ("them", "others", "readers", "us")]),
    ]
    rules = [r.broken_rules for r in judged(spark, texts)]
    assert rules[:2] == ["", ""]
    assert rules[2] == "symbols" and "symbols" in rules[3] and rules[4] == "exclamations" and rules[5] == "stop_words"
    assert "letters" in rules[6] and rules[7] == "bullets" and rules[8] == "ellipses"
    assert rules[9] == "word_length" and rules[10] == "word_length" and rules[11] == ""


def test_table_is_a_parameter(spark):
    docs = spark.createDataFrame([(1, GOOD)], "doc_id long, text string")
    out = judge(docs, table=(Threshold("long", "n_words", "n_lines", high=5),)).first()
    assert out.broken_rules == "long" and not out.kept


def test_one_projection_without_user_functions(spark):
    docs = spark.createDataFrame([(1, GOOD)], "doc_id long, text string")
    plan = judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_empty_and_repeated(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert judge(docs).count() == 0
    docs = spark.createDataFrame([(None, GOOD), (1, GOOD), (1, GOOD), (1, None)], "doc_id long, text string")
    out = judge(docs).collect()
    assert Counter((r.doc_id, r.kept) for r in out) == {(None, True): 1, (1, True): 2, (1, False): 1}
