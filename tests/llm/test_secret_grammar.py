import hashlib
import random
import re

from threadloom.llm import secret_grammar as sg

SCHEMA = "doc_id long, text string, n_chars long, spans string"


def slow_base(text):
    """The patterns as stated, then the drops."""
    found = []
    a = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for n, (pattern, keep) in enumerate([
        (a, lambda m: len(m.group(2)) >= 12), (r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 18), (r"[0-9a-f]+", lambda m: len(m.group()) >= 16),
    ]):
        found += [(m.start(), n, m.end()) for m in re.finditer(pattern, text) if keep(m)]
    return sorted(found)


def noisy(rng):
    pieces = ["token", "api_key", "APIKEY", "Secret", " ", "=", ":", '"', "'", "AKIA", "ABCD1234EFGH5678", "0123456789abcdef", "deadbeef", "é", "\n", "short", "passwd", "ſecret", "x" * 12]
    return "".join(rng.choice(pieces) for _ in range(rng.randint(0, 40)))


def hexes(rng, n):
    return "".join(rng.choice("0123456789abcdef") for _ in range(n))


def mixed(rng, n=24):
    return "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))


def test_base_is_as_stated():
    rng = random.Random(0)
    for _ in range(3000):
        text = noisy(rng)
        assert [x[:3] for x in sg.base_findings(text)] == slow_base(text)


def test_merging_keeps_counts_and_generalises():
    rng = random.Random(1)
    formats = ["".join(rng.choice("dx") for _ in range(rng.randint(10, 30))) for _ in range(300)]
    tree = sg.Automaton.prefix_tree(formats)
    a = sg.infer(formats, 0.05)

    def reachable(a):
        seen, todo = {0}, [0]
        while todo:
            for t in a.step[todo.pop()].values():
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return seen

    states = reachable(a)
    assert len(states) < len(tree.step) / 20
    assert sum(a.ends[s] for s in states) == 300
    assert sum(sum(a.passes[s].values()) for s in states) == sum(map(len, formats))
    assert a.log_likelihood("dx" * 10) > a.log_likelihood("lU" * 10) + 20


def texts(rng):
    words = ["ordinary", "conversation", "extraordinarily", "mail7.example.com", "understanding", "10.20.30.40", "path/to/somewhere1"]
    rows = [f'{rng.choice(words)} token = "{mixed(rng)}" {rng.choice(words)}' for _ in range(60)]
    rows += [" ".join(rng.choice(words) for _ in range(30)) for _ in range(100)]
    return rows


def test_scan(spark):
    rng = random.Random(2)
    rows = texts(rng) + [f"see {mixed(rng)} here" for _ in range(20)] + [None, "", "key " * 50000 + "token=" + hexes(rng, 40)]
    df = spark.createDataFrame([(i, t, 0, "clash") for i, t in enumerate(rows)], SCHEMA)
    out = {r.doc_id: r for r in sg.scan(df).collect()}
    assert len(out) == len(rows)
    for i, t in enumerate(rows):
        base = slow_base(t or "")
        joined = ",".join(f"{sg.KINDS[k]}:{a}:{b}" for a, k, b in base)
        r = out[i]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for _, k, _ in base) for n in range(3)]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
    assert sum(out[i].n_added for i in range(160)) == 0
    assert sum(out[i].spans == "grammar:4:28" for i in range(160, 180)) >= 18


def test_edge_cases(spark):
    assert sg.scan(spark.createDataFrame([], SCHEMA)).count() == 0
    plain = sg.scan(spark.createDataFrame([(None, "no secrets at all 1234567890abcdeg", 1, "x")] * 3, SCHEMA)).collect()
    assert [r.spans for r in plain] == [""] * 3


def test_redact(spark):
    rng = random.Random(3)
    rows = texts(rng) + [None, f"a AKIA{'A' * 20} b {hexes(rng, 40)} c"]
    df = spark.createDataFrame([(i, t, len(t or ""), "kept") for i, t in enumerate(rows)], SCHEMA)
    out = {r.doc_id: r for r in sg.redact(df, length_col="n_chars").collect()}
    assert out[161].text == "a [secret] b [secret] c" and out[161].n_chars == len(out[161].text)
    assert out[160].text is None and out[160].n_chars == 0
    for i, t in enumerate(rows[:160]):
        assert (out[i].text == t) == (not slow_base(t)) and not slow_base(out[i].text) and out[i].spans == "kept"


def test_short_and_plain_formats_are_scored(spark):
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") for _ in range(n))
    rows = texts(rng) + [f"password={letters(rng.randint(12, 15))}" for _ in range(100)] + [f"see {letters(15)} here" for _ in range(5)]
    df = spark.createDataFrame([(i, t, len(t), "kept") for i, t in enumerate(rows)], SCHEMA)
    out = {r.doc_id: r.spans for r in sg.scan(df).collect()}
    assert sum(out[i] == "grammar:4:19" for i in range(260, 265)) >= 4
    assert not any("grammar" in out[i] for i in range(160))


def test_rest_of_a_partly_covered_token(spark):
    rng = random.Random(5)
    rest = [mixed(rng, 40) for _ in range(30)]
    rows = texts(rng) + [f"id AKIA{'ABCDEFGHIJKLMNOP'}{'/='[i % 2]}{x} end" for i, x in enumerate(rest[:20])]
    rows += [f"id xoxb-{hexes(rng, 16)}-{x} end" for x in rest[20:]]
    df = spark.createDataFrame([(i, t, len(t), "kept") for i, t in enumerate(rows)], SCHEMA)
    out = {r.doc_id: r.text for r in sg.redact(df, length_col="n_chars").collect()}
    assert sum(x in out[160 + i] for i, x in enumerate(rest)) <= 1
    found = {r.doc_id: r for r in sg.scan(df).collect()}
    assert all(found[i].n_access == 1 for i in range(160, 180)) and all(found[i].n_hex == 1 for i in range(180, 190))


def test_recall_and_precision_of_learned_formats():
    """Tokens without a label: of the lengths that were learned, of others, and of prose with paths, names and dates."""
    rng = random.Random(7)
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"

    def some(alphabet, n):
        return "".join(rng.choice(alphabet) for _ in range(n))

    kinds = [
        lambda n=None: "ghp_" + some(upper + lower + digits, n or rng.randint(30, 40)),
        lambda n=None: "-".join(some(digits + lower, 8) for _ in range((n or 32) // 8)),
        lambda n=None: some(upper + lower + digits, n or rng.randint(20, 32)),
        lambda n=None: some(upper + lower, n or rng.randint(16, 24)),
        lambda n=None: some(upper + lower + digits + "+/", n or 40),
    ]
    words = (
        "ordinary conversation extraordinarily mail7.example.com understanding 10.20.30.40 path/to/somewhere1 /usr/lib/python3 "
        "2024-05-06T10:11:12 internationalisation http://www.example.com/a/b.html some_function_name CamelCaseIdentifier version-1.2.3-beta"
    ).split()
    candidates = [t for _ in range(300) for _, _, t in sg.other_tokens(" ".join(rng.choice(words) for _ in range(30)), [])]
    pairs = sg.Counter()
    for t in candidates:
        f = t.translate(sg._FORMAT)
        pairs.update(zip(["", *f], [*f, sg.END]))
    grammar = sg.Grammar({"assign": [make().translate(sg._FORMAT) for make in kinds for _ in range(80)]}, pairs, sg.GrammarParams())
    for make in kinds:
        for length in (None, 56):
            assert sum(grammar.likely(make(length)) for _ in range(200)) >= 180
    assert not any(grammar.likely(t) for t in candidates)
