import json
import random

import pytest
from textloom.sources.json_edits import set_pointers, taken_apart


def put(value, pointer, new):
    """The text at the pointer replaced, or None if it isn't there."""
    parts, at = pointer.strip("/").split("/"), value
    try:
        for p in parts[:-1]:
            at = at[int(p)] if isinstance(at, list) else at[p]
        last = int(parts[-1]) if isinstance(at, list) else parts[-1]
        if not isinstance(at[last], str):
            return None
        at[last] = new
    except (KeyError, IndexError, ValueError, TypeError):
        return None
    return value


def grown(draw, depth):
    kind = draw.randint(0, 6 if depth else 3)
    if kind < 2:
        return draw.choice(["x", "é \"q\" \\ \n\t", "", "/a~b", "Ünï 🙂"])
    if kind < 4:
        return draw.choice([1, 2.5, True, False, None, -3])
    names = draw.sample(["title", "b", "a~", "x/y", "pages", "zz", "é", "0"], draw.randint(0, 4))
    return {n: grown(draw, depth - 1) for n in names} if kind < 6 else [grown(draw, depth - 1) for _ in range(draw.randint(0, 3))]


def pointers(value, at=""):
    if isinstance(value, dict):
        for k, v in value.items():
            if "/" not in k:
                yield from pointers(v, f"{at}/{k}")
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from pointers(v, f"{at}/{i}")
    else:
        yield at, isinstance(value, str)


def run(spark, files, edits, **more):
    f = spark.createDataFrame(files, "file string, text string")
    e = spark.createDataFrame(edits, "file string, pointer string, value string, ord int")
    return {r.file: (r.text, r.problem) for r in set_pointers(f, e, **more).collect()}


def test_against_plain_python(spark):
    draw = random.Random(4)
    values = {f"f{i}": {"top": grown(draw, 4), "z": "always", "a": [grown(draw, 2), "here"]} for i in range(120)}
    edits, expected = [], {}
    for i, (file, value) in enumerate(values.items()):
        spots = [p for p, text in pointers(value) if text]
        chosen = draw.sample(spots, min(len(spots), draw.randint(1, 3)))
        if i % 10 == 3:
            chosen.append(draw.choice(["/nowhere", "/a/9", "/top/x/y", "/z/0", "/a", "/a/x"]))
        want = json.loads(json.dumps(value))
        for k, p in enumerate(chosen):
            edits.append((file, p, f"new {k} \"é\"", 1))
            want = put(want, p, f"new {k} \"é\"") if want is not None else None
        expected[file] = want
    got = run(spark, [(f, json.dumps(v, ensure_ascii=draw.random() < 0.5)) for f, v in values.items()], edits)
    assert set(got) == set(expected)
    for file, want in expected.items():
        text, problem = got[file]
        if want is None:
            assert text is None and problem.startswith("no text at /")
        else:
            assert problem is None
            # The same text that a plain writer gives: the order of fields, the indents, the last line's end.
            assert text == json.dumps(want, ensure_ascii=False, indent=4) + "\n", file


def test_deep(spark):
    value = "old"
    for i in range(50):
        value = [1, value, "beside"] if i % 2 else {"a": value, "b": None}
    pointer = "".join("/1" if i % 2 else "/a" for i in reversed(range(50)))
    got = run(spark, [("f", json.dumps(value))], [("f", pointer, "new", 1)], indent=1)
    assert got["f"] == (json.dumps(put(value, pointer, "new"), indent=1) + "\n", None)


@pytest.mark.parametrize("text, pointer, problem", [("{", "/a", "unreadable"), ('{"a": "x"} y', "/a", "unreadable"), ("7", "/a", "no text at /a"), ('"x"', "/", "no text at /"), ("{}", "/a", "no text at /a"), ("[]", "/0", "no text at /0")])
def test_refused(spark, text, pointer, problem):
    assert run(spark, [("f", text)], [("f", pointer, "n", 1)]) == {"f": (None, problem)}


def test_last_edit_counts_and_other_files_stay_out(spark):
    got = run(spark, [("f", '{"a": "x"}'), ("g", '{"a": "x"}')], [("f", "a", "one", 1), ("f", "/a/", "two", 2), ("h", "/a", "n", 1)])
    assert got == {"f": ('{\n    "a": "two"\n}\n', None), "h": (None, "no such file")}
    assert run(spark, [], []) == {}


def test_files_are_dealt_to_all_tasks(spark):
    """Texts that lie in one file aren't taken apart in one task."""
    files = spark.createDataFrame([(f"f{i}", f'{{"a": ["{i}", {{"b": "x"}}]}}') for i in range(64)], "file string, text string").coalesce(1)
    levels = taken_apart(files)
    assert [x.count() for x in levels] == [64, 64, 128, 64] and min(len(x.inputFiles()) for x in levels) > 1


def test_no_level_is_written_in_vain(spark, monkeypatch):
    """A level is counted as it is written, so that nothing is written or read to see that there is no deeper one."""
    from textloom.sources import json_edits as J

    written, kept = [], J.stage
    monkeypatch.setattr(J, "stage", lambda df, name: written.append(name) or kept(df, name))
    files = lambda *texts: spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "file string, text string")
    for texts, rows in (([], [0]), (["7", "{"], [1]), (['{"a": 1}'], [1, 1]), (['{"a": {"b": []}}', "[]"], [2, 1, 1])):
        written.clear()
        assert [x.count() for x in taken_apart(files(*texts))] == rows
        assert len(written) == len(rows) + (rows == [2, 1, 1])  # the list that holds nothing is looked into


def test_containers_travel_without_their_text(spark):
    """Only what a level's containers hold is joined to them, by one join a level; their own text isn't sent again."""
    levels = taken_apart(spark.createDataFrame([("f", '{"a": [{"b": "x"}, 2]}')], "file string, text string"))
    edits = spark.createDataFrame([("f", "/a/0/b", "y")], "file string, at string, value string")
    from textloom.sources.json_edits import put_together

    df = put_together(levels, edits, 1)
    assert df.first().json == '{\n "a": [\n  {\n   "b": "y"\n  },\n  2\n ]\n}'
    joins = [x for x in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join " in x]
    assert len(joins) == 2 * len(levels) - 1 and not any("list" in x for x in joins)


def test_odd_files_and_edits(spark):
    files = [("f", '{"a": "x", "": "e", "b": [null, {}, [], {"c": "d"}], "n": null}'), ("g", None), ("i", '{"a": "x", "": "e", "b": [null, {}, [], {"c": "d"}], "n": null}'), (None, '{"a": "x"}'), ("t", '{"a": ["x"]}'), ("t", '{"a": ["y"]}')]
    edits = [("f", "/a", None, 1), ("f", "/b/0", "n", 1), ("f", "/b/3/c", "n", 1), ("g", "/a", "x", 1), (None, "/a", "n", 1), ("i", "/", "root", 1), ("i", "/b/3/c", "n", 1), ("i", None, "q", 1), ("t", "/a/0", "n", 1)]
    f = spark.createDataFrame(files, "file string, text string")
    e = spark.createDataFrame(edits, "file string, pointer string, value string, ord int")
    got = sorted((str(r.file), str(r.text), str(r.problem)) for r in set_pointers(f, e).collect())
    whole = json.dumps({"a": "x", "": "root", "b": [None, {}, [], {"c": "n"}], "n": None}, indent=4) + "\n"
    # A file that stands there twice: both texts, each with what both hold, and a list's cells once for each list.
    held = '"a": [\n        ' + ",\n        ".join(['"n"'] * 4) + "\n    ]"
    twice = "{\n    " + held + ",\n    " + held + "\n}\n"
    assert got == [("None", "None", "no such file"), ("f", "None", "no text at /b/0"), ("g", "None", "unreadable"), ("i", whole, "None")] + [("t", twice, "None")] * 4
