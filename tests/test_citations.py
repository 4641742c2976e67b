"""Citations in context against a reader that goes from word to word."""

import random

from textloom.operators import controls as C
from textloom.operators import model as M
from textloom.operators.matching import citations_in_context

RENAMED = {("fence", "gate"), ("glas", "pane"), ("window", "pane"), ("rose", "bush")}


def read(ws, name, motifs):
    out, i = [], 0
    by_length = sorted(motifs, key=len, reverse=True)
    while i < len(ws):
        for m in by_length:
            k = len(m)
            if tuple(ws[i : i + k]) != m or (name and i == 0 and k == len(ws)):
                continue
            if i and ws[i - 1] == "light" and m[0] in ("blue", "gray"):
                continue
            if i + k < len(ws) and (m[-1], ws[i + k]) in RENAMED:
                continue
            out.append((i, m))
            if i >= 2 and ws[i - 1] in ("or", "and"):
                tries = [tuple(ws[i - 1 - j : i - 1]) + m[g:] for g in range(1, k) for j in (2, 1) if i - 1 - j >= 0]
                out += [(i, x) for x in tries if x in motifs][:1]
            i += k
            break
        else:
            i += 1
    return sorted(out)


def test_against_a_reader(spark):
    draw = random.Random(11)
    words = ["oak", "dark", "birch", "plank", "fence", "gate", "or", "and", "light", "blue", "wool", "umbra", "glas", "pane"]
    motifs = {tuple(draw.choice(words) for _ in range(draw.randint(1, 3))) for _ in range(60)} | {("oak", "fence"), ("blue", "wool"), ("dark", "oak", "plank"), ("oak", "plank"), ("birch", "plank")}
    texts = [(f"t{i}", [draw.choice(words) for _ in range(draw.randint(0, 14))], i % 3 == 0) for i in range(800)]
    texts += [("x1", "umbra or light blue wool".split(), False), ("x2", "dark oak and birch plank".split(), False), ("x3", "oak fence gate".split(), False), ("x4", "oak plank".split(), True)]
    df = spark.createDataFrame(texts, "key string, ws array<string>, name boolean").repartition(4)
    names = spark.createDataFrame([(list(m),) for m in motifs], "motif array<string>")
    got = {}
    for r in citations_in_context(df, names).collect():
        got.setdefault(r.key, []).append((r.pos, tuple(r.motif)))
    for key, ws, name in texts:
        assert sorted(got.get(key, [])) == read(ws, name, motifs), (key, ws)
    assert (3, ("dark", "oak", "plank")) in got["x2"] and "x3" not in got or ("oak", "fence") not in [m for _, m in got.get("x3", [])]


def test_no_names_no_texts(spark):
    texts = spark.createDataFrame([("a", ["x"], False), ("b", [], True)], "key string, ws array<string>, name boolean")
    none = spark.createDataFrame([], "motif array<string>")
    assert citations_in_context(texts, none).count() == 0
    assert citations_in_context(texts.limit(0), spark.createDataFrame([(["x"],)], "motif array<string>")).count() == 0


def test_references_find_what_is_implied(spark):
    rows = [
        ("item.m.umbra_wool", "Umbra Wool", "Laine d'ombre"),
        ("item.m.highland_wool", "Highland Wool", "Laine des hautes terres"),
        ("text.both", "Bring Umbra or Highland Wool", "Apporte de la laine d'ombre ou des hautes terres"),
        ("text.one", "Bring Umbra or Highland Wool", "Apporte de la laine d'ombre ou de la laine des hautes terres"),
        ("text.none", "Bring Umbra or Highland Wool", "Apporte de la laine des hautes terres"),
    ]
    texts = spark.createDataFrame([(k, en, "project", fr, "project", "m", None, en) for k, en, fr in rows], "key string, en string, origin_en string, fr string, origin_fr string, ns_project string, en_rebuilt string, english string")
    none = lambda s: spark.createDataFrame([], s)
    got = C.reference_control(texts, M.registry(texts), none("key string, object_id string"), none("key string, object string")).collect()
    assert {(r.key, r.object[0]) for r in got} == {("text.both", "item.m.highland_wool"), ("text.none", "item.m.umbra_wool")}


def meant(cited, names, links, pins):
    """resolved(), pair by pair."""
    out = {}
    for key, ns, motif in cited:
        rows = []
        for m, name, fr, identifier in names:
            if m == motif and name != key:
                linked = sum(link == (key, identifier) for link in links)
                pinned = sum(pin == (key, name) for pin in pins)
                rows += [(name, fr, bool(linked), identifier is not None and identifier.split(":")[0] == ns, bool(pinned))] * (max(linked, 1) * max(pinned, 1))
        if rows and len({tuple(r[1]) for r in rows}) == 1:
            out[key, tuple(motif)] = min([r[0] for r in rows if r[4]] or [r[0] for r in rows])
        elif rows:
            ranked = [[r[0] for r in rows if r[flag]] for flag in (2, 3, 4)]
            out[key, tuple(motif)] = next((r[0] for r in ranked if len(r) == 1), None)
    return out


def test_which_name_is_meant(spark):
    import random

    rnd = random.Random(4)
    keys = [f"k{i}" for i in range(40)] + [f"n{i}" for i in range(12)]
    motifs = [["a"], ["a", "b"], ["c"], ["d"]]
    names = [(rnd.choice(motifs), f"n{rnd.randrange(14)}", [rnd.choice("xy")], rnd.choice([None, f"{rnd.choice('st')}:{rnd.randrange(6)}"])) for _ in range(16)] + [(["e"], "n1", ["x"], "s:1"), (["f"], "n2", ["x"], "s:2"), (["f"], "n3", ["y"], "s:3")]
    cited = [(k, "st"[len(k) % 2], m) for k in keys for m in [*motifs, ["e"], ["f"]] if rnd.random() < 0.8]
    links = [(rnd.choice(keys), f"{rnd.choice('st')}:{rnd.randrange(6)}") for _ in range(60)]
    pins = [(rnd.choice(keys), f"n{rnd.randrange(14)}") for _ in range(60)]
    got = C.resolved(
        spark.createDataFrame(cited, "key string, ns string, motif array<string>"),
        spark.createDataFrame(names, "motif array<string>, name_key string, fr_tokens array<string>, identifier string"),
        spark.createDataFrame(links + links[:5], "key string, object_id string"),
        spark.createDataFrame(pins + pins[:5], "key string, object string"),
    ).collect()
    want = meant(cited, names, links + links[:5], pins + pins[:5])
    assert {(r.key, tuple(r.motif)): r.target for r in got} == want and len(got) == len(want)
    assert None in want.values() and len(set(want.values())) > 5


def test_many_names_of_one_kind(spark):
    """Texts and names by the ten thousands with the same words: their pairs, 900 million, aren't looked at."""
    n = 30_000
    cited = spark.range(n).selectExpr("concat('k', id) as key", "concat('s', id) as ns", "array('a', 'b') as motif")
    names = spark.range(n).selectExpr("array('a', 'b') as motif", "concat('n', id) as name_key", "array(concat('x', id % 9)) as fr_tokens", "concat('s', id, ':', id) as identifier")
    none = spark.createDataFrame([], "key string, object_id string, object string")
    got = C.resolved(cited, names, none, none).selectExpr("count(*) as n", "count_if(substring(key, 2) = substring(target, 2)) as near").first()
    assert (got.n, got.near) == (n, n)
