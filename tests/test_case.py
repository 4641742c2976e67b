"""Titles of works and generic terms of places; the cases are those that the rule was written for."""

import pytest
from textloom.operators import controls as C
from textloom.operators import model as M

TEXTS = "key string, en string, origin_en string, fr string, origin_fr string, ns_project string, en_rebuilt string, english string"


def table(spark, rows):
    return spark.createDataFrame([(k, "x", "project", fr, "project", "project", None, "x") for k, fr in rows], TEXTS)


PLACES = [
    ("Explore les Grottes de Camuy", "Explore les grottes de Camuy"),
    ("Nage dans la Mer du Nord et le Lac d'Annecy", "Nage dans la mer du Nord et le lac d'Annecy"),
    ("Grottes de Camuy", None),
    ("§6Grottes de Camuy", None),
    ("Va. Grottes de Camuy !", None),
    ("Va là\\nGrottes de Camuy", None),
    ("I - Grottes de Camuy", None),
    ("Lire « Grottes de Camuy »", None),
    ("L'entrée de la Caverne du Crâne", None),
    ("L'entrée de la Caverne du Crâne et la Caverne du Roi", "L'entrée de la Caverne du Crâne et la caverne du Roi"),
    ("Dans la Forêt de Roche", None),
    ("Dans la Forêt de Rochers", "Dans la forêt de Rochers"),
    ("Les Grottes de cristal", None),
    ("La MontGrotte de Camuy", None),
    ("Le Marais des Ombres, les Marais du Sud", "Le marais des Ombres, les marais du Sud"),
]


def test_places(spark):
    texts = table(spark, [(f"text.t{i}", fr) for i, (fr, _) in enumerate(PLACES)] + [("biome.base.rock", "Forêt de Roche"), ("quests.a.title", "Les Grottes de Camuy"), ("item.m.x", "Clé des Grottes de Camuy")])
    books = spark.createDataFrame([("b/f.json#/name", "x", "Les Grottes de Camuy"), ("b/f.json#/pages/0/text", "x", "Vers les Grottes de Camuy")], "key string, en string, fr string")
    declared = spark.createDataFrame([("Caverne du Crâne",), ("Seul",)], "name string")
    got = {r.key: r.expected for r in C.toponym_control(texts, books, M.registry(texts), declared).collect()}
    want = {f"text.t{i}": fixed for i, (_, fixed) in enumerate(PLACES) if fixed} | {"b/f.json#/pages/0/text": "Vers les grottes de Camuy"}
    assert got == want


@pytest.mark.parametrize("fr, fixed, inner", [("La Qualité de la terre", None, None), ("La phénoménologie du trésor", "La Phénoménologie du trésor", None), ("L'Art de la Pêche", None, "L'Art de la pêche"), ("Le Grand Livre", None, "Le Grand livre"), ("Livre de pêche", None, None), ("§6Les étoiles", "§6Les Étoiles", None)])
def test_works(spark, fr, fixed, inner):
    texts = table(spark, [("item.farm.soil", fr), ("farm_skills.books.soil.title", "Sol"), ("item.farm.other", "La phénoménologie")])
    assert [r.expected for r in C.work_title_control(texts).collect()] == ([fixed] if fixed else [])
    assert [r.expected for r in C.case_control(texts, []).collect()] == ([inner] if inner else [])
