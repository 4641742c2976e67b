import json

from textloom.sources import settings as S

GOOD = {
    "exceptions": [{"controle": "codes", "cle": "k", "objet": ["a"], "motif": "", "epingle": True}, {"controle": "c", "cle": "k", "objet": "a"}],
    "dette": [{"controle": "codes", "cle": "k", "empreinte": "0" * 12, "objet": []}],
    "familles": {"familles": [{"nom": "n", "motif": "m", "gabarit": "g", "source": ["a"], "cles_source": {}}], "accords": {"k": {"genre": "f"}, "l": {}}},
    "gabarits": {"k": [["nom_objet"], ["saison", "autre"]], "none": []},
    "largeurs": [{"cle": "k", "limite": 10, "motif": "("}, {"limite": 9, "comportement": "cut", "mod": "m", "preuve": "p", "motif": "^a", "lignes": 2}],
    "scripts_patches": {"a.js": {"base": "sha", "motif": "x"}},
    "mots_generiques": {"pierre": ""},
    "mods_retires": {},
    "formes_interdites": [{"forme": "f", "juste": "j", "casse": False}],
    "noms_propres": {"A": "b"},
    "majuscules": {"A": "b"},
    "termes_imposes": [{"anglais": "a|b", "francais": "x", "portee": "noms"}, {"anglais": "c", "francais": ["x"], "interdits": []}],
    "regles": {"casse_textes": True, "pourcentages": "", "nombres": False, "largeurs_mods": False, "terminologie_interdits": False},
    "double_sens": [{"anglais": "a", "motif": "m", "justes": ["x"]}],
    "homographes": {"a": "b"},
    "renvois": [{"controle": "c", "cle": "k", "motif": "m"}],
}
#: table -> entries that break a rule, each with the rule that it breaks.
BAD = {
    "exceptions": [({"controle": " ", "cle": "k"}, "controle: needed, said"), ({"controle": "c", "cle": "k", "epingle": "yes"}, "epingle: flag"), ("x", "a record"), ({"controle": "c", "cle": "k", "objet": [1]}, "objet: either")],
    "dette": [({"controle": "c", "cle": "k"}, "empreinte: needed, said")],
    "gabarits": [([["other"]], "types of arguments"), ([[]], "types of arguments"), ("x", "types of arguments"), (["autre"], "types of arguments")],
    "largeurs": [
        ({"cle": "k", "motif": "m"}, "limite: needed, count"),
        ({"cle": "k", "motif": "m", "limite": 0}, "limite: needed, count"),
        ({"limite": 5, "motif": "m"}, "what an own limit needs: cle, motif"),
        ({"limite": 5, "preuve": "p", "mod": "m", "cle": "k"}, "what a mod's limit needs: comportement, mod, preuve"),
        ({"limite": 5, "preuve": "p", "mod": "m", "comportement": "c", "motif": "("}, "a mod's cle, cles, motif, lignes"),
        ({"limite": 5, "preuve": "p", "mod": "m", "comportement": "c", "cles": []}, "a mod's limit aims at something"),
    ],
    "scripts_patches": [({"base": ""}, "base: needed, said"), ("x", "base: needed, said")],
    "mots_generiques": [(1, "$: needed, text")],
    "mods_retires": [(None, "$: needed, text")],
    "formes_interdites": [({"forme": "f"}, "juste: needed, said")],
    "noms_propres": [(["a"], "$: needed, text")],
    "majuscules": [({}, "$: needed, text")],
    "termes_imposes": [({"anglais": "(", "francais": "x"}, "anglais: needed, pattern"), ({"anglais": "a"}, "francais: needed, either"), ({"anglais": "a", "francais": "x", "portee": "all"}, "portee: one_of")],
    "double_sens": [({"anglais": "a", "motif": "m", "justes": []}, "justes: needed, some_texts")],
    "homographes": [(True, "$: needed, text")],
    "renvois": [({"controle": "c", "cle": "k"}, "motif: needed, said")],
}


def run(spark, values):
    rows = [(f"dir/{n}.json", v if isinstance(v, str) else json.dumps(v)) for n, v in values.items()]
    good, bad = S.settings(spark.createDataFrame(rows, "file string, text string"))
    return {(r.table, r.entry) for r in good.select("table", "entry").collect()}, {tuple(r) for r in bad.collect()}


def test_good_files(spark):
    good, bad = run(spark, GOOD | {"unknown": [1]})
    assert bad == set() and ("familles/accords", "l") in good and ("regles", "") in good
    assert len(good) == sum(len(v) for n, v in GOOD.items() if n not in ("familles", "regles")) + 4


def test_every_table_has_entries_that_fail(spark):
    values, want = dict(GOOD), set()
    for table, entries in BAD.items():
        if isinstance(GOOD[table], list):
            values[table] = GOOD[table] + [e for e, _ in entries]
            want |= {(f"dir/{table}.json", str(len(GOOD[table]) + i), rule) for i, (_, rule) in enumerate(entries)}
        else:
            values[table] = GOOD[table] | {f"bad{i}": e for i, (e, _) in enumerate(entries)}
            want |= {(f"dir/{table}.json", f"bad{i}", rule) for i, (_, rule) in enumerate(entries)}
    values["regles"] = GOOD["regles"] | {"pourcentages": "all", "more": True}
    values["familles"] = {"familles": [{"nom": "n", "motif": "m"}], "accords": {"k": {"genre": "x"}, "l": 1}}
    want |= {("dir/regles.json", "", "pourcentages: needed, one_of"), ("dir/regles.json", "", "no other rules"), ("dir/familles.json", "0", "gabarit: needed, said"), ("dir/familles.json", "k", "genre: one_of"), ("dir/familles.json", "l", "$: needed, record")}
    good, bad = run(spark, values)
    assert want <= bad
    assert {(f, e) for f, e, _ in bad} == {(f, e) for f, e, _ in want}
    # What is right in the same files is accepted.
    assert ("exceptions", "0") in good and ("gabarits", "k") in good and not any(t == "regles" for t, _ in good)


def test_whole_files(spark):
    values = {n: v for n, v in GOOD.items() if n != "dette"} | {"renvois": "[", "regles": "[]", "largeurs": "{}", "familles": {"familles": []}}
    _, bad = run(spark, values)
    assert bad == {("dir/dette.json", None, "missing"), ("dir/renvois.json", None, "unreadable"), ("dir/regles.json", None, "not one record"), ("dir/largeurs.json", None, "not a list of records"), ("dir/familles.json", None, "not an object of entries")}


def test_written(spark):
    rows = [(n, json.dumps(v)) for n, v in GOOD.items()]
    got = {r.file: r.text for r in S.written(spark.createDataFrame(rows, "file string, text string")).collect()}
    assert got == {n: json.dumps(v, ensure_ascii=False, indent=1) + "\n" for n, v in GOOD.items()}
