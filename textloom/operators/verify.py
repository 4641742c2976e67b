"""The controls by name over one set of tables, and their findings reconciled with the ledgers."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import MOST_KEYS, stage
from . import controls as C
from . import ledger as L
from . import model as M

EMPTY = {
    "books": "key string, en string, fr string",
    "journal": "key string, en string, fr string",
    "witnesses": "ns string, key string, texts map<string,string>",
    "duplicates": "key string, n_values bigint, definitions map<string,string>",
    "essences": "essence string",
    "glossary": "en string, fr string, sense string, ord bigint",
    "terms": "english string, french array<string>, scope string, keys string, banned array<string>, reason string, ord int",
    "sold": "id string",
    "limits": "key string, keys array<string>, pattern string, limit int, lines int, behaviour string, mod string, proof string, ord int",
    "vocabulary": "folded string, form string",
    "decisions": "key string, fr string, seq bigint",
    "patches": "key string, base string",
    "families": "family string, pattern string, template string, sources array<string>, ord int",
    "agreements": "key string, gender string, number string, proper boolean, plural string",
    "arguments": "key string, types array<array<string>>",
    "forms": "form string, right string, exact boolean, source string",
    "links": "key string, object_id string",
    "pins": "key string, object string",
    "sheets": "key string, file string, pointer string, en string, fr string, objects array<string>",
    "exceptions": "control string, key string, object array<string>, reason string, pin boolean, fingerprint string, question string, ord bigint",
    "debt": "control string, key string, object array<string>, fingerprint string",
}


@dataclass
class Tables:
    """What the controls read: effective texts, and every other table, which is empty where it isn't given.

    upstream None means that the scripts upstream can't be read, which isn't the same as none. nouns: proper nouns. kept: words that
    stay English. off: rules that are switched off (RULES).
    """

    texts: DataFrame
    spark: SparkSession
    upstream: DataFrame | None = None
    nouns: list[str] = field(default_factory=list)
    kept: list[str] = field(default_factory=list)
    off: frozenset[str] = frozenset()

    def __getattr__(self, name: str) -> DataFrame:
        """Tables that weren't given. registry, members and lexicon are worked out from the others unless they are set."""
        if name in ("registry", "members", "lexicon"):
            return None
        if name not in EMPTY:
            raise AttributeError(name)
        return self.spark.createDataFrame([], EMPTY[name])

    def said(self) -> DataFrame:
        """(key, fr) of language keys, book fields and the change log alike."""
        return self.texts.select("key", "fr").unionByName(self.books.select("key", "fr")).unionByName(self.journal.select("key", "fr"))

    def names(self) -> DataFrame:
        return M.registry(self.texts) if self.registry is None else self.registry

    def labels(self) -> DataFrame:
        """(key, label, rendering): what stands before a colon in English names, and before one in French."""
        head = lambda c: F.regexp_extract(c, r"^([^:]+):", 1)
        rows = self.texts.filter(M.is_name(F.col("key"))).select("key", head(F.col("english")).alias("label"), head(F.coalesce("fr", F.lit(""))).alias("rendering"))
        return rows.filter("label != '' and rendering != ''")


def _references(t: Tables) -> DataFrame:
    names = C.aliases(t.names())
    return C.united([C.reference_control(t.texts, names, t.links, t.pins), C.title_control(t.texts, names, t.links), C.sheet_control(t.sheets, names), C.family_noun_control(t.texts, names, t.links)])


def _families(t: Tables) -> DataFrame:
    members = C.family_members(t.texts.select("key"), t.families) if t.members is None else t.members
    return C.family_control(C.family_names(members, t.texts.select("key", "fr"), t.agreements), t.texts)


def _case(t: Tables) -> DataFrame:
    parts = [C.case_control(t.texts, t.nouns, t.kept), C.work_title_control(t.texts)]
    if "case in texts" not in t.off:
        declared = t.spark.createDataFrame([(n,) for n in [*t.nouns, *t.kept]], "name string")
        parts.append(C.toponym_control(t.texts, t.books, t.names(), declared))
    return C.united(parts)


#: Rules that may wait, and then are switched on to measure what they would find.
RULES = ("forbidden renderings", "widths of mods", "numbers", "case in texts")

CONTROLS: dict[str, Callable[[Tables], DataFrame]] = {
    "coverage": lambda t: C.coverage(t.texts, t.witnesses, t.duplicates, t.books),
    "codes": lambda t: C.code_control(t.texts, t.books, t.journal),
    "essences": lambda t: C.essence_control(t.texts, t.essences),
    "glossary": lambda t: C.glossary_control(t.texts, t.books, t.glossary),
    "numbers": lambda t: C.number_control(t.texts, t.books) if "numbers" not in t.off else C.number_control(t.texts.limit(0), t.books.limit(0)),
    "homonyms": lambda t: C.homonym_control(M.homonym_groups(t.names()), t.labels()),
    "terms": lambda t: C.term_control(t.texts, t.books, t.terms, forbidden="forbidden renderings" not in t.off),
    "width": lambda t: C.width_control(t.texts, t.sold, t.limits, mods="widths of mods" not in t.off),
    "conventions": lambda t: C.convention_control(t.texts, t.books, t.journal),
    "residual": lambda t: C.residual_control(t.texts, t.books, t.kept, lexicon=t.lexicon),
    "accents": lambda t: C.accent_control(t.texts, t.books, t.journal, t.vocabulary),
    "decisions": lambda t: C.decision_control(t.said(), t.decisions),
    "patches": lambda t: C.patch_control(t.patches, t.upstream),
    "families": _families,
    "templates": lambda t: C.template_control(t.texts, t.arguments),
    "spelling": lambda t: C.spelling_control(t.texts, t.books, t.journal, t.forms),
    "case": _case,
    "references": _references,
}


def findings(tables: Tables, controls: Iterable[str] | None = None) -> DataFrame:
    """The findings of the named controls (all, if none is named); an unknown name is an error."""
    names = list(controls) if controls is not None else list(CONTROLS)
    if unknown := [n for n in names if n not in CONTROLS]:
        raise ValueError(f"no such control: {', '.join(unknown)}")
    return C.united([CONTROLS[n](tables) for n in names])


def verify(tables: Tables, controls: Iterable[str] | None = None) -> DataFrame:
    """The findings of the named controls with their bucket (blocking, flagged, debt, covered), by the tables' exceptions and debt.

    Findings are staged: they are looked at for what covers them and again for the result, and the rules run once. Up to MOST_KEYS rows
    of the ledgers, only findings and texts of the ledgers' keys are matched with them; the others keep their status as it is.
    """
    found, said = stage(findings(tables, controls), "findings"), tables.said().filter("fr is not null")
    value = F.max("fr").alias("value")
    keys = tables.exceptions.select("key").unionByName(tables.debt.select("key"))
    if keys.limit(MOST_KEYS + 1).count() > MOST_KEYS:
        return L.reconcile(found, tables.exceptions, tables.debt, said.groupBy("key").agg(value))
    keys = F.broadcast(keys)
    ruled = L.reconcile(found.join(keys, "key", "left_semi").select(*found.columns), tables.exceptions, tables.debt, said.join(keys, "key", "left_semi").groupBy("key").agg(value))
    return ruled.unionByName(L.unruled(found.join(keys, "key", "left_anti").select(*found.columns), ruled))


def measured(before: DataFrame, after: DataFrame) -> DataFrame:
    """(control, gone, new, same): what a change set does to the findings, by control. before and after: findings."""
    triple = ["control", "key", "object", "detail"]
    a, b = before.select(*triple, F.lit(1).alias("a")).distinct(), after.select(*triple, F.lit(1).alias("b")).distinct()
    rows = a.join(b, triple, "full")
    return rows.groupBy("control").agg(F.count_if(F.col("b").isNull()).alias("gone"), F.count_if(F.col("a").isNull()).alias("new"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("same"))
