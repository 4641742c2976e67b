"""What a change set does to the findings, without judging the whole corpus again; and the skeleton of a lot from what was found.

Most rules judge a text by itself. Some tie texts together: names of one English, words that other texts show to be French, families,
citations of a name. For each rule there is a scope: the keys that have to be judged again so that every group with a changed member is
there whole. The rule then runs over the scope before and after the change. A group that is only partly there has no changed member, so
it reads the same on both sides, and falls out of the difference.

What the ties are found by is worked out once for a corpus (Prepared), and serves any number of change sets.
"""

from __future__ import annotations

import copy
from collections.abc import Iterable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lineage import cut, listed, stage
from . import apply as A
from . import changes as K
from . import controls as C
from . import model as M
from .verify import CONTROLS, RULES, Tables, findings

KEYED = ("texts", "books", "journal", "witnesses", "duplicates", "decisions", "arguments", "pins", "sheets")
PLANKS = r"^block\.([^.]+)\.([a-z0-9_]+)_planks$"
SLAB = r"^block\.([^.]+)\.([a-z0-9_]+?)(?:_vertical)?_slab$"


def union(*keys: DataFrame) -> DataFrame:
    """(key) of all, staged: it is asked for once for each table."""
    return stage(reduce(DataFrame.unionByName, (k.select("key") for k in keys)).distinct(), "keys")


def within(tables: Tables, keys: DataFrame) -> Tables:
    """The tables with the rows of the keys alone, where rows have one."""
    out, keys = copy.copy(tables), listed(keys)
    for name in KEYED:
        if name in tables.__dict__:
            setattr(out, name, getattr(tables, name).join(keys, "key", "left_semi"))
    return out


def changed(tables: Tables, changes: DataFrame) -> Tables:
    """The tables after the changes (key, fr; a row a key). A changed text is the project's; a key that is nowhere becomes one of its texts."""
    new = listed(changes.select("key", F.col("fr").alias("new"), F.lit(True).alias("touched")))
    out = copy.copy(tables)
    columns = tables.texts.columns
    elsewhere = [getattr(tables, n) for n in ("books", "journal", "sheets") if n in tables.__dict__]
    added = new.join(tables.texts.select("key"), "key", "left_anti")
    for rows in elsewhere:
        added = added.join(rows.select("key"), "key", "left_anti")
    texts = tables.texts.join(new, "key", "left")
    texts = texts.withColumn("fr", F.coalesce("new", "fr")).withColumn("origin_fr", F.when(F.col("touched"), "project").otherwise(F.col("origin_fr"))).select(columns)
    fresh = added.select("key", F.col("new").alias("fr"), F.lit("project").alias("origin_fr"), F.lit("").alias("english"))
    out.texts = texts.unionByName(fresh, allowMissingColumns=True)
    for name in ("books", "journal", "sheets"):
        if name in tables.__dict__:
            rows = getattr(tables, name)
            setattr(out, name, rows.join(new, "key", "left").withColumn("fr", F.coalesce("new", "fr")).select(rows.columns))
    return out


class Prepared:
    """A corpus with what its texts are tied by, each table staged when it is first needed."""

    def __init__(self, tables: Tables):
        self.tables = tables

    @cached_property
    def names(self) -> DataFrame:
        return stage(self.tables.names(), "names")

    @cached_property
    def labels(self) -> DataFrame:
        return stage(self.tables.labels(), "labels")

    @cached_property
    def french(self) -> DataFrame:
        """(key, word) of the words that each text shows to be French."""
        return stage(C.french_words(self.tables.texts, self.tables.books), "french")

    @cached_property
    def copied(self) -> DataFrame:
        """(key, word) of the words that may have been copied from English."""
        return stage(C.copied_words(C.shown_texts(self.tables.texts, self.tables.books), self.tables.kept).select("key", "word"), "copied")

    @cached_property
    def english(self) -> DataFrame:
        """(key, en): what each text and book field says in English, without blanks at its ends."""
        rows = self.tables.texts.select("key", F.col("english").alias("en")).unionByName(self.tables.books.select("key", "en"))
        return stage(rows.select("key", T.strip(F.coalesce("en", F.lit(""))).alias("en")).filter("en != ''"), "english")

    @cached_property
    def words(self) -> DataFrame:
        """(word, key) of the distinct words of each English text."""
        rows = M.project_texts(self.tables.texts).select("key", F.explode(F.array_distinct(T.words(F.col("english")))).alias("word"))
        return stage(rows, "words")

    @cached_property
    def members(self) -> DataFrame:
        return stage(C.family_members(self.tables.texts.select("key"), self.tables.families), "members")

    @cached_property
    def aims(self) -> DataFrame:
        """(key, source) of what each family member may be named after."""
        return stage(self.members.select("key", F.explode("sources").alias("source"), "ident").select("key", F.replace("source", F.lit("{id}"), F.col("ident")).alias("source")), "aims")


def _twins(p: Prepared, before: Tables, after: Tables, touched: DataFrame) -> tuple[Tables, Tables]:
    """Names of one English, and labels before a colon."""
    own = within(after, touched)
    english = own.names().select("en_tokens").unionByName(p.names.join(touched, "key", "left_semi").select("en_tokens")).distinct()
    same = p.names.select("key", "en_tokens").join(english, "en_tokens", "left_semi")
    heads = own.labels().unionByName(p.labels.join(touched, "key", "left_semi")).select("label").distinct()
    keys = union(touched, same, p.labels.join(heads, "label", "left_semi"))
    return within(before, keys), within(after, keys)


def _terms(p: Prepared, before: Tables, after: Tables, touched: DataFrame) -> tuple[Tables, Tables]:
    """Texts of one English, and the glossary's entries for it."""
    own = within(after, touched)
    said = own.texts.select(F.col("english").alias("en")).unionByName(own.books.select("en")).select(T.strip(F.coalesce("en", F.lit(""))).alias("en")).distinct()
    keys = union(touched, p.english.join(said, "en", "left_semi"))
    sides = within(before, keys), within(after, keys)
    for t in sides:
        t.glossary = before.glossary.join(said.select(F.col("en").alias("said")), T.strip(F.col("en")) == F.col("said"), "left_semi")
    return sides


def _residual(p: Prepared, before: Tables, after: Tables, touched: DataFrame) -> tuple[Tables, Tables]:
    """Texts with a word that only changed texts show, or have ceased to show, to be French."""
    own = within(after, touched)
    now = C.french_words(own.texts, own.books)
    old = p.french.join(touched, "key", "left_semi")
    of = stage(old.select("word", F.lit(1).alias("old"), F.lit(0).alias("now")).unionByName(now.select("word", F.lit(0).alias("old"), F.lit(1).alias("now"))).groupBy("word").agg(F.max("old").alias("old"), F.max("now").alias("now")), "words")
    others = p.french.join(touched, "key", "left_anti").join(listed(of.select("word")), "word", "left_semi").select("word").distinct()
    turned = of.filter("old != now").join(others, "word", "left_anti").select("word")
    keys = union(touched, p.copied.join(turned, "word", "left_semi"))
    # The words in question, and which of them are French before and after.
    asked = p.copied.join(keys, "key", "left_semi").select("word").unionByName(C.copied_words(C.shown_texts(own.texts, own.books), after.kept).select("word")).distinct()
    lasting = p.french.join(touched, "key", "left_anti").select("word").join(asked, "word", "left_semi").distinct()
    sides = within(before, keys), within(after, keys)
    sides[0].lexicon, sides[1].lexicon = lasting.unionByName(old.select("word")).distinct(), lasting.unionByName(now.select("word")).distinct()
    return sides


def _families(p: Prepared, before: Tables, after: Tables, touched: DataFrame) -> tuple[Tables, Tables]:
    """Members named after what has changed, down the chains, and what they are named after, up the chains."""
    fresh = C.family_members(touched.join(p.tables.texts.select("key"), "key", "left_anti"), p.tables.families)
    members = stage(p.members.unionByName(fresh), "members")
    aims = stage(p.aims.unionByName(fresh.select("key", F.explode("sources").alias("source"), "ident").select("key", F.replace("source", F.lit("{id}"), F.col("ident")).alias("source"))), "aims")

    def closed(keys: DataFrame, start: str, end: str) -> DataFrame:
        """keys and all that is reached from them by steps from `start` to `end` of the aims."""
        seen = last = cut(keys.select("key").distinct())
        while True:
            step = aims.select(F.col(start).alias("key"), F.col(end).alias("next")).join(last, "key", "left_semi").select(F.col("next").alias("key")).distinct()
            last = cut(step.join(seen, "key", "left_anti"))
            if last.isEmpty():
                return seen
            seen = cut(seen.unionByName(last))

    down = closed(touched, "source", "key").join(members.select("key"), "key", "left_semi")
    keys = closed(down, "key", "source")
    sides = within(before, keys), within(after, keys)
    inside = members.join(keys, "key", "left_semi")
    sides[0].members, sides[1].members = inside.join(before.texts.select("key"), "key", "left_semi"), inside
    return sides


def _references(p: Prepared, before: Tables, after: Tables, touched: DataFrame) -> tuple[Tables, Tables]:
    """Texts that hold all words of a changed name, or are linked to its object or to one of its family."""
    old, new = p.names, stage(p.names.join(touched, "key", "left_anti").unionByName(within(after, touched).names()), "names")
    turned = stage(old.join(touched, "key", "left_semi").unionByName(new.join(touched, "key", "left_semi")), "turned")
    turned = stage(C.aliases(turned).select("key", "identifier", "en_tokens").distinct(), "turned")
    # Each changed name by its rarest word: the texts that hold it are looked through for the other words.
    sought = turned.filter(F.size("en_tokens") > 0).select("en_tokens").distinct()
    each = sought.select("en_tokens", F.explode(F.array_distinct("en_tokens")).alias("word"))
    found = p.words.join(listed(each.select("word").distinct()), "word", "left_semi")
    counts = found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    rarest = each.join(counts, "word").groupBy("en_tokens").agg(F.min_by("word", F.struct("n", "word")).alias("word"), F.count(F.lit(1)).alias("m"))
    near = found.join(rarest.filter(F.col("m") == F.size(F.array_distinct("en_tokens"))), "word").select("key", "en_tokens")
    rest = near.select("key", "en_tokens", F.explode(F.array_distinct("en_tokens")).alias("word")).join(found, ["key", "word"])
    holding = rest.groupBy("key", "en_tokens").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == F.size(F.array_distinct("en_tokens")))
    ends = lambda d: d.filter("size(en_tokens) > 2").select("identifier", F.explode(F.transform(F.sequence(F.lit(2), F.size("en_tokens") - 1), lambda n: F.slice("en_tokens", F.size("en_tokens") - n + 1, n))).alias("ending"))
    kin = ends(old.unionByName(new)).join(ends(turned).select("ending").distinct(), "ending", "left_semi").select("identifier").filter("identifier is not null")
    objects = turned.select("identifier").filter("identifier is not null").unionByName(kin).distinct()
    aimed = before.links.join(objects, before.links.object_id == objects.identifier, "left_semi")
    shown = before.sheets.select("key", F.explode("objects").alias("identifier")).join(objects, "identifier", "left_semi")
    keys = union(touched, holding, aimed, shown)
    sides = within(before, keys), within(after, keys)
    sides[0].registry, sides[1].registry = old, new
    return sides


def _conventions(p: Prepared, before: Tables, after: Tables, touched: DataFrame) -> tuple[Tables, Tables]:
    """Slabs are wooden if there are planks of their name: all planks, and the slabs of new ones."""
    planks = before.texts.filter(F.col("key").rlike(PLANKS)).select("key")
    woods = touched.filter(F.col("key").rlike(PLANKS)).select(F.regexp_extract("key", PLANKS, 2).alias("wood"))
    slabs = before.texts.filter(F.col("key").rlike(SLAB)).select("key", F.regexp_extract("key", SLAB, 2).alias("wood")).join(woods, "wood", "left_semi")
    keys = union(touched, planks, slabs)
    return within(before, keys), within(after, keys)


def _accents(p: Prepared, before: Tables, after: Tables, touched: DataFrame) -> tuple[Tables, Tables]:
    """The base game's words decide which ones are unsure."""
    keys = union(touched, before.texts.filter("origin_fr = 'vanilla'"))
    return within(before, keys), within(after, keys)


def _width(p: Prepared, before: Tables, after: Tables, touched: DataFrame) -> tuple[Tables, Tables]:
    """An item and a block of one id are one thing in a shop."""
    other = F.when(F.col("key").startswith("item."), F.concat(F.lit("block."), F.substring("key", 6, 2**31 - 1))).when(F.col("key").startswith("block."), F.concat(F.lit("item."), F.substring("key", 7, 2**31 - 1)))
    keys = union(touched, touched.select(other.alias("key")).filter("key is not null"))
    return within(before, keys), within(after, keys)


def _alone(p: Prepared, before: Tables, after: Tables, touched: DataFrame) -> tuple[Tables, Tables]:
    return within(before, touched), within(after, touched)


SCOPES = {"homonyms": _twins, "glossary": _terms, "residual": _residual, "families": _families, "references": _references, "conventions": _conventions, "accents": _accents, "width": _width}
#: Rules that no text has a part in.
UNMOVED = ("patches",)


def differential(prepared: Prepared, changes: DataFrame, controls: Iterable[str] | None = None) -> DataFrame:
    """The findings that changes (key, fr; a row a key) make or take away: COLUMNS and side, "new" or "gone".

    The same as what two runs over everything differ by, but for repeats of one finding. Texts of the base game can't be changed: an error.
    """
    names = list(CONTROLS) if controls is None else list(controls)
    if unknown := [n for n in names if n not in CONTROLS]:
        raise ValueError(f"no such control: {', '.join(unknown)}")
    changes = stage(changes.select("key", "fr"), "changes")
    before = prepared.tables
    touched = changes.select("key")
    if not before.texts.filter("origin_fr = 'vanilla'").join(touched, "key", "left_semi").isEmpty():
        raise ValueError("texts of the base game can't be changed")
    after = changed(before, changes)
    sides = [SCOPES.get(n, _alone)(prepared, before, after, touched) + (n,) for n in names if n not in UNMOVED]
    old = stage(C.united([CONTROLS[n](a) for a, _, n in sides]).distinct(), "old") if sides else findings(before, names).limit(0)
    new = stage(C.united([CONTROLS[n](b) for _, b, n in sides]).distinct(), "new") if sides else old
    gone, come = old.exceptAll(new), new.exceptAll(old)
    return come.withColumn("side", F.lit("new")).unionByName(gone.withColumn("side", F.lit("gone")))


# --- lots -----------------------------------------------------------------------------------------------------------------------


def first_findings(found: DataFrame, size: int, by_object: bool = False) -> DataFrame:
    """The first findings by object or by key: whole groups until one doesn't fit; only the first group of all is cut to the size.

    Groups stand together in that order, so whether they fit is seen from size + 1 findings.
    """
    group = F.to_json("object") if by_object else F.col("key")
    order = ["group", "key", "control", "detail"]
    top = found.withColumn("group", group).orderBy(*order).limit(size + 1)
    rows = top.withColumn("n", F.row_number().over(Window.orderBy(*order))).withColumn("last", F.max("n").over(Window.partitionBy("group"))).withColumn("first", F.min("n").over(Window.partitionBy("group")))
    return rows.filter((F.col("last") <= size) | ((F.col("first") == 1) & (F.col("n") <= size))).select(*found.columns)


#: Rules whose expected text is the whole text, put right.
WHOLE = ("accents", "case", "decisions", "families")


def prefilled(packet: DataFrame, said: DataFrame, lot: str, forms: DataFrame | None = None) -> DataFrame:
    """Corrections (apply.ACTION) that findings give in full: the only one of its key, of a rule that gives whole texts.

    A convention's expected text counts where there is one, and a known mistake's, if its form is among `forms` (form). said: key, fr.
    """
    sure = F.col("control").isin(*WHOLE, "conventions")
    if forms is not None:
        packet = packet.join(forms.select(F.array("form").alias("object"), F.lit(True).alias("known")).distinct(), "object", "left")
        sure = sure | ((F.col("control") == "spelling") & F.coalesce("known", F.lit(False)))
    n = F.count(F.lit(1)).over(Window.partitionBy("key"))
    rows = packet.withColumn("n", n).filter((F.col("n") == 1) & sure & (F.col("expected") != "")).join(said.select("key", "fr"), "key").filter("fr is not null and fr != expected")
    rows = rows.withColumn("i", F.row_number().over(Window.orderBy("key")) - 1)  # a packet is as long as its lot may be
    values = {"lot": F.lit(lot), "i": F.col("i"), "type": F.lit("correction"), "key": F.col("key"), "before": F.col("fr"), "after": F.col("expected"), "reason": F.trim(F.concat(F.lit("["), "control", F.lit("] "), "detail"))}
    return rows.select(*(values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in (c.split() for c in A.ACTION.split(", "))))


def measure_lot(
    tables: Tables, lot: str, controls: Iterable[str] = (), keys: DataFrame | None = None, size: int = K.MOST_ACTIONS, rules: Iterable[str] = (), blocking: bool = False, by_object: bool = False, fill: bool = False
) -> dict[str, DataFrame]:
    """The skeleton of a lot: findings (the first packet of what was asked for), perimeter (key), actions (prefilled, or none), and
    measure (lot, found, kept, debt).

    Findings of the controls and of the keys are taken, with the waiting rules in `rules` switched on; exceptions cover as in verify().
    """
    from .verify import verify

    rules = set(rules)
    if unknown := rules - set(RULES):
        raise ValueError(f"no such rule: {', '.join(sorted(unknown))}")
    asked = copy.copy(tables)
    asked.off = frozenset(tables.off) - rules
    judged = verify(asked, list(controls) if keys is None else None).filter("bucket != 'covered'")
    wanted = stage(K.selected(judged.withColumn("status", F.when(F.col("bucket") == "blocking", "blocking").otherwise(F.col("bucket"))), list(controls), keys, blocking).select(*C.COLUMNS), "found")
    packet = stage(first_findings(wanted, size, by_object), "packet")
    perimeter = union(packet, keys) if keys is not None else union(packet)
    actions = prefilled(packet, tables.said(), lot, tables.forms)
    counts = wanted.agg(F.count(F.lit(1)).alias("found")).crossJoin(packet.agg(F.count(F.lit(1)).alias("kept"))).crossJoin(tables.debt.agg(F.count(F.lit(1)).alias("debt")))
    return {"findings": packet, "perimeter": perimeter, "actions": actions if fill else actions.limit(0), "measure": counts.select(F.lit(lot).alias("lot"), "found", "kept", "debt")}
