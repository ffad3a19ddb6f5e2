import hashlib
import random
import re
import string

import pytest

from lexmill.llm import credentials as c

SCHEMA = "doc_id long, text string, kind string, spans string, start int"
PATTERNS = [
    (re.compile(r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 6),
    (re.compile(r"(AKIA[A-Z0-9]+)"), 20),
    (re.compile(r"([0-9a-f]+)"), 24),
]


def plain(text):
    found = [(m.start(), k, m.end()) for k, (p, least) in enumerate(PATTERNS) for m in p.finditer(text or "") if len(m[1]) >= least]
    return sorted(found)


def hexes(r, n):
    return "".join(r.choice("0123456789abcdef") for _ in range(n))


def key(r):
    return "AKIA" + "".join(r.choice(string.ascii_uppercase + string.digits) for _ in range(16))


def prose(r, n):
    return " ".join("".join(r.choice("aeioustnrlé") for _ in range(r.randint(2, 9))) for _ in range(n))


def corpus():
    r = random.Random(3)
    rows = []
    for i in range(400):
        kind = i % 4
        secret = [f'token = "{hexes(r, 40)}"', f"PassWord={hexes(r, 18)}", key(r), str(r.randrange(10**15, 10**16))][kind]
        rows.append((i, f"{prose(r, 30)} {secret} {prose(r, 20)}{'' if i % 7 else ' electroencephalographically/interchangeable'}", None, "x", 1))
    bare = [(1000 + i, f"é {prose(r, 10)} {hexes(r, 20)} {prose(r, 5)}", None, "x", 1) for i in range(20)]
    clean = [(2000 + i, f"{prose(r, 10)} {r.randrange(10**15, 10**16)} uncharacteristically_reinterpretation", "k", None, 2) for i in range(50)]
    odd = [
        (3000, None, None, None, None), (3001, "", None, None, None), (None, key(r), None, None, 3), (3002, "token: 'short' SECRET=abc", "k", "", 0),
        (3003, "ſecret=abcdefgh toKen=abcdefgh", "", "", 0), (3004, "AKIA" * 6 + " " + "ab" * 11 + " " + "0" * 24, "", "", 0),
        (3005, 'apikey="api_key=abcdef" password = password=aaaaaaa', "", "", 0), (3006, f"{prose(r, 40_000)} secret:{hexes(r, 6)}", "", "", 0),
        (3007, "f" * 300_000, "", "", 0), (0, rows[0][1], "repeated", None, None),
    ]
    return rows + bare + clean + odd


@pytest.fixture(scope="module")
def found(spark):
    rows = spark.createDataFrame(corpus(), SCHEMA)
    return [(r["doc_id"], r["spans"]) for r in c.scan(rows).collect()]


def test_base_spans_against_a_plain_version(found):
    got = [(i, [(s["start"], c.KINDS.index(s["kind"]), s["end"]) for s in spans if s["base"]]) for i, spans in found]
    want = [(i, plain(t)) for i, t, *_ in corpus()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_formats_find_what_no_pattern_names_and_leave_the_rest(found):
    texts = {i: t for i, t, *_ in corpus()}
    added = {i: [s for s in spans if not s["base"]] for i, spans in found}
    assert sum(len(added[1000 + i]) == 1 for i in range(20)) >= 17  # nearly all digits look like a number
    for i, spans in added.items():
        for s in spans:
            assert texts[i][s["start"] : s["end"]] == s["value"] and re.fullmatch(r"[0-9a-f]{16,23}", s["value"])
    assert not any(added[2000 + i] for i in range(50))


def test_digest_and_order(spark, found):
    rows = spark.createDataFrame(corpus(), SCHEMA)
    got = {r["doc_id"]: r for r in c.digest(c.scan(rows)).collect()}
    for i, text, *_ in corpus():
        base = plain(text)
        written = ",".join(f"{c.KINDS[k]}:{s}:{e}" for s, k, e in base)
        r = got[i]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert set(written.split(",")) - {""} <= set(r["spans"].split(","))


def test_merging_keeps_what_differs():
    r = random.Random(5)
    automaton = c.infer([key(r) for _ in range(300)])
    assert 4 <= len(automaton.steps) <= 8  # four fixed letters, then one loop
    seen = [automaton.log_likelihood(key(r)) for _ in range(50)]
    other = [automaton.log_likelihood("".join(r.choice(string.ascii_uppercase) for _ in range(20))) for _ in range(50)]
    assert min(seen) > max(other)
    assert c.infer(["ab"] * 30).log_likelihood("ab") > c.infer(["ab"] * 30).log_likelihood("ba") + 5


def test_an_automaton_is_a_distribution():
    automaton = c.infer(["a", "ab", "abb", "b"] * 10)
    import itertools
    import math

    # Seen characters, the end, and the rest of the alphabet as one outcome.
    for steps, unseen in zip(automaton.steps, automaton.unseen, strict=True):
        assert math.isclose(sum(math.exp(p) for _, p in steps.values()) + (c.ALPHABET - len(steps)) * math.exp(unseen), 1.0)
    total = sum(math.exp(automaton.log_likelihood("".join(x))) for n in range(12) for x in itertools.product("ab", repeat=n))
    assert 0.5 < total <= 1


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(1, "word", None, None, None)]])
def test_nothing_to_learn_from(spark, rows):
    got = c.digest(c.scan(spark.createDataFrame(rows, SCHEMA))).collect()
    assert [r["spans"] for r in got] == [""] * len(rows)
