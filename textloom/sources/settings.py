"""The verifier's settings: what each file has to hold is declared, all of it is checked in one pass, and what breaks a rule is set aside.

A file is a list of records, an object whose fields are records, or one record. Entries become rows; each row is tried against all the
rules of its table at once, and comes out accepted, or in the quarantine with the names of the rules that it breaks.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import stage
from ..functions.text import blank
from ..operators.model import parsed_json
from .json_edits import put_together, taken_apart

LIST, MAP, ONE = "a list of records", "an object of entries", "one record"
Test = Callable[[Column, str], Column]


def at(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def held(v: Column, path: str) -> Column:
    """The type of what stands there, as VARIANT's schema; null if nothing does."""
    return F.schema_of_variant(at(v, path))


def text(v: Column, path: str) -> Column:
    return held(v, path) == "STRING"


def said(v: Column, path: str) -> Column:
    """A text that isn't blank."""
    return text(v, path) & ~blank(at(v, path, "string"))


def flag(v: Column, path: str) -> Column:
    return held(v, path) == "BOOLEAN"


def count(v: Column, path: str) -> Column:
    """A whole number above zero."""
    return (held(v, path) == "BIGINT") & (at(v, path, "bigint") > 0)


def texts(v: Column, path: str) -> Column:
    return (held(v, path) == "ARRAY<STRING>") | (F.size(at(v, path, "array<variant>")) == 0)


def some_texts(v: Column, path: str) -> Column:
    return held(v, path) == "ARRAY<STRING>"


def record(v: Column, path: str) -> Column:
    return held(v, path).startswith("OBJECT")


def any_of(*tests: Test) -> Test:
    def either(v: Column, path: str) -> Column:
        out = F.lit(False)
        for t in tests:
            out = out | F.coalesce(t(v, path), F.lit(False))
        return out

    return either


def among(*values: str) -> Test:
    def one_of(v: Column, path: str) -> Column:
        return text(v, path) & at(v, path, "string").isin(*values)

    return one_of


def compiles(c: Column) -> Column:
    """Whether a text is a regular expression, as Python's re has it."""

    @F.pandas_udf("boolean")
    def all_of(patterns: pd.Series) -> pd.Series:
        return patterns.map(_compiles).astype(bool)

    return all_of(c)


def _compiles(pattern: str | None) -> bool:
    try:
        re.compile(pattern)
    except (re.error, TypeError):
        return False
    return True


def pattern(v: Column, path: str) -> Column:
    """A regular expression."""
    return text(v, path) & compiles(at(v, path, "string"))


@dataclass(frozen=True)
class Table:
    """A settings file: its shape, what each entry must have, what it may have, and further rules by name. under: a part of the file."""

    shape: str = LIST
    must: dict[str, Test] = field(default_factory=dict)
    may: dict[str, Test] = field(default_factory=dict)
    rules: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    under: str = ""

    def broken(self, v: Column) -> Column:
        """array<string>: the rules that an entry breaks."""
        # Records of a map may be plain values; then `$` is tested.
        tried = [(f"{name}: needed, {getattr(t, '__name__', 'value')}", t(v, _path(name))) for name, t in self.must.items()]
        tried += [(f"{name}: {getattr(t, '__name__', 'value')}", held(v, _path(name)).isNull() | t(v, _path(name))) for name, t in self.may.items()]
        tried += [(name, rule(v)) for name, rule in self.rules.items()]
        if self.shape != MAP:
            tried.insert(0, ("a record", record(v, "$")))
        return F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in tried)))


def _path(name: str) -> str:
    return name if name.startswith("$") else f"$.{name}"


OBJECT = any_of(text, texts)
REASONS = Table(MAP, {"$": text})


def _from_mod(v: Column) -> Column:
    return held(v, "$.preuve").isNotNull()


def _types(v: Column) -> Column:
    kinds = F.filter(at(v, "$", "array<array<string>>"), lambda p: (F.size(p) > 0) & F.forall(p, lambda t: t.isin(*ARGUMENT_TYPES)))
    return held(v, "$").startswith("ARRAY") & (F.size(kinds) == F.size(at(v, "$", "array<variant>")))


# The names of the files and of their fields, and the values that these take.
ARGUMENT_TYPES = ("nom_objet", "saison", "autre")
SCOPES = ("tout", "noms", "textes")
PERCENTAGES = ("", "espace", "colle")
RULES = ("casse_textes", "pourcentages", "nombres", "largeurs_mods", "terminologie_interdits")
TABLES: dict[str, Table] = {
    "exceptions": Table(must={"controle": said, "cle": said}, may={"objet": OBJECT, "motif": text, "epingle": flag, "date": text, "empreinte": text, "question": text}),
    "dette": Table(must={"controle": said, "cle": said, "empreinte": said}, may={"objet": OBJECT, "en_attente_de_decision": flag}),
    "familles": Table(must={"nom": said, "motif": said, "gabarit": said}, may={"source": texts, "anglais": text, "cles_source": record, "noms_source": record}, under="familles"),
    "familles/accords": Table(MAP, {"$": record}, {"genre": among("m", "f"), "nombre": among("s", "p")}, under="accords"),
    "gabarits": Table(MAP, rules={"types of arguments": _types}),
    "largeurs": Table(
        must={"limite": count},
        rules={
            "what an own limit needs: cle, motif": lambda v: _from_mod(v) | said(v, "$.cle") & said(v, "$.motif"),
            "what a mod's limit needs: comportement, mod, preuve": lambda v: ~_from_mod(v) | said(v, "$.comportement") & said(v, "$.mod") & said(v, "$.preuve"),
            "a mod's cle, cles, motif, lignes": lambda v: ~_from_mod(v)
            | (held(v, "$.cle").isNull() | text(v, "$.cle")) & (held(v, "$.cles").isNull() | texts(v, "$.cles")) & (held(v, "$.motif").isNull() | pattern(v, "$.motif")) & (held(v, "$.lignes").isNull() | count(v, "$.lignes")),
            "a mod's limit aims at something": lambda v: ~_from_mod(v) | F.coalesce(F.length(at(v, "$.cle", "string")) > 0, F.lit(False)) | F.coalesce(some_texts(v, "$.cles"), F.lit(False)) | F.coalesce(F.length(at(v, "$.motif", "string")) > 0, F.lit(False)),
        },
    ),
    "scripts_patches": Table(MAP, {"$": record, "base": said}),
    "mots_generiques": REASONS,
    "mods_retires": REASONS,
    "formes_interdites": Table(must={"forme": said, "juste": said}, may={"casse": flag, "source": text}),
    "noms_propres": REASONS,
    "majuscules": REASONS,
    "termes_imposes": Table(must={"anglais": pattern, "francais": any_of(said, some_texts)}, may={"portee": among(*SCOPES), "cles": pattern, "interdits": texts, "motif": text}),
    "regles": Table(
        ONE,
        {r: among(*PERCENTAGES) if r == "pourcentages" else flag for r in RULES},
        rules={"no other rules": lambda v: F.size(F.array_except(F.map_keys(at(v, "$", "map<string,variant>")), F.array(*map(F.lit, RULES)))) == 0},
    ),
    "double_sens": Table(must={"anglais": pattern, "motif": said, "justes": some_texts}),
    "homographes": REASONS,
    "renvois": Table(must={"controle": said, "cle": said, "motif": said}, may={"objet": OBJECT}),
}


def settings(files: DataFrame, tables: dict[str, Table] = TABLES) -> tuple[DataFrame, DataFrame]:
    """(accepted: folder, table, entry, value; quarantine: file, entry, rule). files: file, text; a table's file is <table>.json, one in each folder.

    entry is a place in a list, a field of an object, or empty. A file that is missing, unreadable or of another shape is in the
    quarantine as a whole (entry null); files that no table has are left out.
    """
    path = r"^(.*?)([^/]+)\.json$"
    found = files.select(F.regexp_extract("file", path, 1).alias("folder"), F.regexp_extract("file", path, 2).alias("name"), "text").filter("name != ''")
    known = found.filter(F.col("name").isin(*(t.split("/")[0] for t in tables))).select("folder", "name", parsed_json(F.col("text")).alias("whole"), F.lit(True).alias("there"))
    declared = files.sparkSession.createDataFrame([(t, t.split("/")[0], x.shape, x.under) for t, x in tables.items()], "table string, name string, shape string, under string")
    # The declarations are as many as there are tables.
    rows = found.select("folder").distinct().crossJoin(F.broadcast(declared)).join(known, ["folder", "name"], "left")
    part = F.when(F.col("under") == "", F.col("whole"))
    for under in sorted({x.under for x in tables.values()} - {""}):
        part = F.when(F.col("under") == under, at(F.col("whole"), f"$.{under}")).otherwise(part)
    rows = rows.withColumn("part", part).withColumn("kind", F.schema_of_variant("part"))
    fits = F.when(F.col("shape") == LIST, F.col("kind").startswith("ARRAY")).otherwise(F.col("kind").startswith("OBJECT"))
    rows = stage(rows.withColumn("fits", F.coalesce(fits, F.lit(False))), "settings")
    file = F.concat("folder", "name", F.lit(".json")).alias("file")
    problem = F.when(F.col("there").isNull(), "missing").when(F.col("whole").isNull(), "unreadable").otherwise(F.concat(F.lit("not "), "shape"))
    whole = rows.filter("not fits").select(file, F.lit(None).cast("string").alias("entry"), problem.alias("rule"))
    many = rows.filter(F.col("fits") & (F.col("shape") != ONE)).select("folder", "table", "name", "part")
    each = many.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("part").outer()).toDF("pos", "field", "value"))
    each = each.select("folder", "table", "name", F.coalesce("field", F.col("pos").cast("string")).alias("entry"), "value")
    each = each.unionByName(rows.filter(F.col("fits") & (F.col("shape") == ONE)).select("folder", "table", "name", F.lit("").alias("entry"), F.col("part").alias("value")))
    broken = F.array().cast("array<string>")
    for table, x in tables.items():
        broken = F.when(F.col("table") == table, x.broken(F.col("value"))).otherwise(broken)
    tried = stage(each.withColumn("broken", broken), "tried")
    bad = tried.select(file, "entry", F.explode("broken").alias("rule"))
    return tried.filter(F.size("broken") == 0).select("folder", "table", "entry", "value"), whole.unionByName(bad)


def written(files: DataFrame, indent: int = 1) -> DataFrame:
    """(file, text): settings files as they are kept, fields in order, one level indented by one blank, a line's end at the end."""
    none = files.sparkSession.createDataFrame([], "file string, at string, value string")
    return put_together(taken_apart(files.select("file", "text")), none, indent).select("file", F.concat("json", F.lit("\n")).alias("text"))
