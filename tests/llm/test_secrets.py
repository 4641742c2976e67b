import hashlib
import math
import random
import re

from textloom.llm import secrets

from .helpers import ODD, docs

KINDS = ("assign", "access", "hex")


def brute(text):
    text = text or ""
    out = [("assign", m) for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    out += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(((k, m.start(), m.end()) for k, m in out), key=lambda x: (x[1], KINDS.index(x[0])))


def test_base_spans_and_grammar(spark):
    rng = random.Random(3)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    key = lambda n: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(n))
    rows = list(ODD)
    for k in range(200):
        rows.append((100 + k, f"ünï {rng.choice(['Token', 'api_key', 'PASSWORD', 'apikey'])} {rng.choice('=:')} \"{hexes(40)}\" then {key(16)} or {hexes(40)}"))
    rows += [
        (1000, "token=secret=abcdef token: api password=abc passwd:'a.b/c=d+'"),
        (1001, "token=token:abcdef"),
        (1002, "ſecret=abcdefgh toKen=abcdefgh"),
        (1003, key(15) + " " + key(16) + "AKIA" + " " + "é" * 30 + hexes(24) + "G" + hexes(23)),
        (1004, "plain ordinarylongwordwithoutdigits here, mail-server.example.com and another-one-like-that"),
    ]
    got = {r.doc_id: r for r in secrets.scan(docs(spark, rows)).collect()}
    for i, t in rows:
        base = brute(t)
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, _, _ in base) for x in KINDS)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("grammar")] == [s for s in line.split(",") if s]
    assert "grammar" not in got[1004].spans


def test_grammar_finds_what_the_rules_miss(spark):
    rng = random.Random(4)
    rows = [(k, f"token = {''.join(rng.choice('0123456789abcdef') for _ in range(20))}") for k in range(300)]
    rows.append((900, "left bare: 0f3c9a71be55d204c81e in a log, and thisisoneordinaryword"))
    r = next(r for r in secrets.scan(docs(spark, rows)).collect() if r.doc_id == 900)
    assert r.n_assign == r.n_hex == 0 and r.spans == "grammar-assign:11:31"


def test_automaton_keeps_a_fixed_prefix_and_merges_the_rest():
    rng = random.Random(2)
    a = secrets.Automaton(["XY" + "".join(rng.choice("01") for _ in range(12)) for _ in range(400)])
    assert 3 <= a.states < 20
    assert a.likelihood("XY010101010101") > a.likelihood("010101010101XY")
    assert secrets.learn(["a"]) is None


def test_empty(spark):
    assert secrets.scan(docs(spark, [])).count() == 0


def test_distributions_add_up():
    """What a state gives to all characters and to the end is one, before and after a character that it never saw."""
    rng = random.Random(5)
    a = secrets.learn(["XY" + "".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(8, 20))) for _ in range(300)])
    for s in a.moves:
        assert abs(sum(math.exp(x) for _, x in a.moves[s].values()) + math.exp(a.stops[s]) - 1) < 1e-9
    o = secrets.Ordinary(secrets.pair_counts("some words, and more-of them: 12345 x").reshape(secrets.SYMBOLS, -1))
    signs = " " + secrets.ALPHABET
    for before in signs:
        assert abs(sum(math.exp(o.log[before + c]) for c in signs) - 1) < 1e-9


def test_runs_and_blanks():
    text = "é key==ab+c/d== x=y token=abcdef.rest -a"
    want = [(m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9+/_.-]+=*", text)]
    assert secrets.runs(text) == want and secrets.runs(text, 6) == [w for w in want if w[1] - w[0] >= 6]
    assert secrets.blanked("abcdefghij", [("x", 2, 5, ""), ("y", 3, 6, ""), ("z", 8, 9, "")]) == "ab    gh j"
    assert secrets.blanked("abc", []) == "abc" and secrets.runs("") == []


def test_planted_credentials(spark):
    """Bare credentials of every length are found, and words, numbers, addresses and dates are not."""
    rng = random.Random(6)
    syllables = ["ta", "re", "mo", "ni", "sel", "dor", "an", "thi", "que", "st"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 6)))
    other = lambda: rng.choice(
        [
            "".join(rng.choice("0123456789") for _ in range(rng.choice([8, 12, 16, 20]))),
            f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
            f"{word()}.{word()}@mail{rng.randint(1, 9)}.example.com",
            ".".join(str(rng.randint(0, 255)) for _ in range(4)),
            f"www.{word()}.org/{word()}/{word()}-{word()}.html",
        ]
    )
    mixed = lambda n: "".join(rng.choice(secrets.ALPHABET[:62]) for _ in range(n))
    rows, bare = [], {}
    for k in range(600):
        text = [word() if rng.random() < 0.9 else other() for _ in range(60)]
        if k % 3 == 0:
            text.insert(rng.randint(0, 59), f"api_key: {mixed(rng.choice([20, 24, 32, 40]))}")
        elif k % 3 == 1:
            at, secret = rng.randint(0, 59), mixed(rng.choice([12, 16, 20, 28, 48, 64]))
            text.insert(at, secret)
            bare[k] = len(" ".join(text[:at])) + (at > 0), len(secret)
        rows.append((k, " ".join(text)))
    found = {r.doc_id: [s for s in r.spans.split(",") if s.startswith("grammar")] for r in secrets.scan(docs(spark, rows)).collect()}
    right = sum(f"grammar-assign:{s}:{s + n}" in found[k] for k, (s, n) in bare.items())
    assert right >= 0.97 * len(bare)  # recall
    assert right >= 0.97 * sum(map(len, found.values()))  # precision
