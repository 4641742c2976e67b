"""Stratified sampling, double review, confidence bounds, components and packing."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import text as T
from ..functions.lineage import attach, listed, stage

MINIMUM = 5
#: Upper bound that a zone's share of major defects has to stay below.
CRITERION = 0.005
# The thresholds by which a reviewing net is kept, tightened or dropped.
LEAST_RECALL, LEAST_GAIN, MOST_FALSE = 0.60, 0.05, 0.15


def quotas(strata: DataFrame, n: int, minimum: int = MINIMUM) -> DataFrame:
    """(stratum, size, quota): min(minimum, size) each, the rest in proportion to the room left, by largest remainders, ties by id.

    strata: stratum, size. Whole-number arithmetic: no remainder is a float. Totals are one row, attached to the strata.
    """
    total, base = strata.agg(F.sum("size"), F.sum(F.least("size", F.lit(minimum)))).first()
    if total is None or not 0 < n <= total or n < base:
        raise ValueError(f"can't draw {n} of {total} with {minimum} a stratum ({base} needed)")
    rest, room = n - base, total - base
    rows = strata.withColumn("base", F.least("size", F.lit(minimum)).cast("decimal(38,0)"))
    share = (F.col("size") - F.col("base")) * F.lit(rest).cast("decimal(20,0)")
    rows = rows.withColumn("whole", F.floor(share / F.lit(max(room, 1))).cast("bigint")).withColumn("left", (share - F.col("whole") * F.lit(max(room, 1))).cast("decimal(38,0)"))
    short = rest - (rows.agg(F.sum("whole")).first()[0] or 0)
    # Strata are few beside their members, and only the largest remainders are looked at.
    more = rows.orderBy(F.desc("left"), "stratum").limit(int(short)).select("stratum", F.lit(1).alias("one")) if room and short > 0 else None
    out = rows if more is None else rows.join(more, "stratum", "left")
    extra = F.lit(0) if more is None else F.coalesce("one", F.lit(0))
    return out.select("stratum", F.col("size").cast("bigint").alias("size"), (F.col("base").cast("bigint") + F.col("whole") + extra).alias("quota"))


def draw(members: DataFrame, quota: DataFrame, seed: str) -> DataFrame:
    """(stratum, id): the quota of each stratum without replacement, in the order of a hash of seed and id, so that it can be repeated.

    members: stratum, id. A stratum's hashes are spread evenly, so nearly all of the drawn ids lie below a limit that follows from its
    size and quota, with four standard deviations to spare; only what lies below is ranked. A stratum with too little below it (by
    chance, or as it has few ids) is ranked whole.
    """
    rows = members.select("stratum", "id", F.sha1(F.concat_ws("|", F.lit(seed), F.col("id").cast("string")).cast("binary")).alias("hash"))
    wanted = quota.select("stratum", "size", "quota")
    share = (F.col("quota") + 4 * F.sqrt("quota") + 8) / F.col("size")
    at = F.conv(F.substring("hash", 1, 8), 16, 10).cast("double") / float(1 << 32)
    near = rows.join(listed(wanted), "stratum").withColumn("below", at < share)
    enough = near.filter("below").groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).join(wanted, "stratum").filter("n >= quota").select("stratum", F.lit(True).alias("enough"))
    kept = near.join(listed(enough), "stratum", "left").filter("below or enough is null")
    by = Window.partitionBy("stratum").orderBy("hash", "id")
    return kept.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= F.col("quota")).select("stratum", "id")


#: What Stirling's formula lacks of log(i!), for i below 16; from there on its series gives all digits.
_LACKING = [0.0] + [math.lgamma(i + 1) - (i + 0.5) * math.log(i) + i - math.log(2 * math.pi) / 2 for i in range(1, 16)]
#: Terms of the binomial sum that are added at once.
TERMS = 512


def _log_binomial(k: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """log of the binomial probability of k < n, by the saddle point: no digits are lost for large n, as with differences of log(n!)."""

    def lacking(x):
        large = np.maximum(x, 16)
        return np.where(x < 16, np.take(_LACKING, np.minimum(x, 15).astype(int)), (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / large**2) / large**2) / large**2) / large)

    def apart(x, mean):
        d = (x - mean) / mean
        return mean * ((1 + d) * np.log1p(d) - d)

    some = np.maximum(k, 1)
    rest = n - some
    with np.errstate(divide="ignore", invalid="ignore"):
        out = lacking(n) - lacking(some) - lacking(rest) - apart(some, n * p) - apart(rest, n * (1 - p)) + np.log(n / (2 * np.pi * some * rest)) / 2
        return np.where(k > 0, out, n * np.log1p(-p))


def _at_most(k: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Binomial probability of at most k of n, where p > k / n: from the term of k downwards, until what follows is lost in rounding.

    The terms fall ever faster; those that matter are a few times the square root of n, whatever k is.
    """
    last, total = np.ones(len(k)), np.ones(len(k))
    at, left = k.copy(), np.arange(len(k))
    while len(left):
        i = np.maximum(at[left, None] - np.arange(min(TERMS, max(at[left].max(), 1))), 0)
        terms = last[left, None] * np.cumprod(i * ((1 - p) / p)[left, None] / (n[left, None] - i + 1), axis=1)
        total[left] += terms.sum(axis=1)
        last[left], at[left] = terms[:, -1], at[left] - i.shape[1]
        left = left[(at[left] > 0) & (last[left] * at[left] > 1e-17 * total[left])]
    return np.exp(_log_binomial(k, n, p)) * total


@F.pandas_udf(DoubleType())
def upper_bound(k: pd.Series, n: pd.Series) -> pd.Series:
    """One-sided 95 % Clopper-Pearson bound of k defects among n, by bisection of the exact binomial sum, over all rows at once."""
    k, n = k.to_numpy(dtype=float), n.to_numpy(dtype=float)
    out = np.ones(len(k))
    some = np.flatnonzero((n > 0) & (k < n))
    k, n = k[some], n[some]
    low, high = k / n, np.ones(len(k))
    for _ in range(60):
        p = (low + high) / 2
        inside = np.flatnonzero((p > low) & (p < high))  # where doubles lie between the two
        above = np.zeros(len(k), dtype=bool)
        above[inside] = _at_most(k[inside], n[inside], p[inside]) > 0.05
        low, high = np.where(above, p, low), np.where(above, high, p)
    out[some] = high
    return pd.Series(out)


def bound_without_defects(n: Column, alpha: float = 0.05) -> Column:
    """The bound for k = 0, in closed form."""
    return F.lit(1.0) - F.pow(F.lit(alpha), F.lit(1.0) / n)


def is_dead(reason: Column) -> Column:
    return F.coalesce(T.strip(reason).startswith("never displayed:"), F.lit(False))


def quality(drawn: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(zone, n, major, minor, correct, dead, bound, holds): per zone, and in all where zone is null. verdicts: id, class, reason."""
    rows = drawn.join(verdicts, "id")
    dead = (F.col("class") == "correct") & is_dead(F.col("reason"))
    alive = lambda c: F.count_if(~dead & (F.col("class") == c))
    out = rows.withColumn("dead", dead).rollup("zone").agg(
        F.count_if(~dead).alias("n"), alive("major").alias("major"), alive("minor").alias("minor"), alive("correct").alias("correct"), F.count_if(dead).alias("dead")
    )
    return out.withColumn("bound", upper_bound(F.col("major").cast("double"), F.col("n").cast("double"))).withColumn("holds", F.col("bound") < CRITERION)


def undecided(drawn: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Drawn texts without a settled verdict."""
    return drawn.join(verdicts.filter(F.col("class").isin("major", "minor", "correct")), "id", "left_anti")


def bench(verdicts: DataFrame, seed: str) -> DataFrame:
    """(id, class): all defects, and as many correct texts in the order of a hash of seed and id."""
    defects = verdicts.filter(F.col("class").isin("major", "minor"))
    n = defects.count()
    order = F.sha1(F.concat_ws("|", F.lit(seed), F.col("id").cast("string")).cast("binary"))
    correct = verdicts.filter((F.col("class") == "correct") & ~is_dead(F.col("reason"))).orderBy(order, "id").limit(n)
    return defects.select("id", "class").unionByName(correct.select("id", "class"))


def net_yield(alerts: DataFrame, labelled: DataFrame) -> DataFrame:
    """(net, alerts, true, precision, recall, major_recall, false_alarms) of each net on a labelled bench. alerts: net, id."""
    truth = labelled.agg(F.count_if(F.col("class") != "correct").alias("d"), F.count_if(F.col("class") == "major").alias("m"), F.count_if(F.col("class") == "correct").alias("c"))
    hits = alerts.select("net", "id").distinct().join(labelled, "id").groupBy("net").agg(
        F.count(F.lit(1)).alias("alerts"), F.count_if(F.col("class") != "correct").alias("true"), F.count_if(F.col("class") == "major").alias("majors")
    )
    part = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    rows = hits.crossJoin(F.broadcast(truth)).withColumn("false", F.col("alerts") - F.col("true"))  # truth is one row
    return rows.select("net", "alerts", "true", part("true", "alerts").alias("precision"), part("true", "d").alias("recall"), part("majors", "m").alias("major_recall"), part("false", "c").alias("false_alarms"))


def decide(wide: Column, wide_false: Column) -> Column:
    """What becomes of the wide net by its recall of majors and false alarms."""
    return F.when((wide < LEAST_RECALL) | (wide_false > MOST_FALSE), "tighten").otherwise("keep")


def decide_narrow(gain: Column, own_majors: Column, false: Column) -> Column:
    return F.when((gain < LEAST_GAIN) & (own_majors == 0), "drop").when(false > MOST_FALSE, "tighten").otherwise("keep")


def projection(false_alarms: Column, recall: Column, texts: Column, share: Column) -> Column:
    """Alerts to expect over all texts; halves are rounded to even."""
    return F.bround(false_alarms * texts * (1 - share) + recall * texts * share, 0).cast("bigint")


def pack_yield(alerts: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(net, alerts, confirmed, majors, precision) of F1, F2 and both. alerts: id, nets (array)."""
    rows = alerts.join(verdicts.select("id", "class"), "id", "left").select("class", F.explode(F.array_union("nets", F.array(F.lit("F1 + F2")))).alias("net"))
    out = rows.groupBy("net").agg(F.count(F.lit(1)).alias("alerts"), F.count_if(F.col("class").isin("major", "minor")).alias("confirmed"), F.count_if(F.col("class") == "major").alias("majors"))
    return out.withColumn("precision", F.col("confirmed") / F.col("alerts"))


# --- reviews ---------------------------------------------------------------------------------------------------------------


def merged_nets(f1: DataFrame, f2: DataFrame) -> DataFrame:
    """(id, nets, notes): alerts of either net. f1, f2: id, note."""
    rows = f1.select("id", F.col("note").alias("n1"), F.lit("F1").alias("a")).join(f2.select("id", F.col("note").alias("n2"), F.lit("F2").alias("b")), "id", "full")
    return rows.select("id", F.array_compact(F.array("a", "b")).alias("nets"), F.array_compact(F.array("n1", "n2")).alias("notes"))


def unmatched(a: DataFrame, b: DataFrame) -> DataFrame:
    """(id, side): ids that only one reviewer judged."""
    return a.join(b, "id", "left_anti").select("id", F.lit("a").alias("side")).unionByName(b.join(a, "id", "left_anti").select("id", F.lit("b").alias("side")))


def verdicts(a: DataFrame, b: DataFrame, third: DataFrame) -> DataFrame:
    """(id, class, state, variant, questions): agreed, settled by a third opinion, or pending. Opinions: id, class, correction, question."""
    side = lambda d, s: d.select("id", *(F.col(c).alias(f"{c}_{s}") for c in ("class", "correction", "question")))
    rows = side(a, "a").join(side(b, "b"), "id").join(side(third, "c"), "id", "left")
    agree = F.col("class_a") == F.col("class_b")
    return rows.select(
        "id",
        F.when(agree, F.col("class_a")).otherwise(F.col("class_c")).alias("class"),
        F.when(agree, "agreed").when(F.col("class_c").isNotNull(), "third").otherwise("pending").alias("state"),
        F.when(agree & (F.col("correction_a") != F.col("correction_b")), F.col("correction_b")).alias("variant"),
        F.array_distinct(F.array_compact(F.array("question_a", "question_b", "question_c"))).alias("questions"),
    )


def verdict_totals(rows: DataFrame) -> DataFrame:
    """(class, n, questions)."""
    return rows.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("questions")).alias("questions"))


# --- zones -----------------------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of edges (a, b) is linked with. Nulls link nothing.

    Stars by turns, until nothing changes: what is linked to a node and above it goes to its smallest neighbour, then what is linked to it and
    below it. A neighbourhood is known by its smallest node, never as a list, and a hub's is broadcast. After each round, nodes whose only
    neighbour is smaller are set aside until that one's root is known, so later rounds see only what isn't a star yet. Each round is staged
    in the shared folder.
    """
    edges = stage(edges.select("a", "b").filter("a is not null and b is not null"), "edges")
    links = stage(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).unionByName(edges.filter("a = b").select(F.col("a").alias("node"))).distinct()
    both_ways = lambda x: x.unionByName(x.select(F.col("b").alias("a"), F.col("a").alias("b")))
    leaves = []
    while n := links.count():
        both = both_ways(links)
        least = both.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("n"))
        above = attach(both, least, "a", "n", 2 * n).filter("b > a").select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        above = stage(above.distinct(), "above")
        least = above.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("n"))
        below = attach(above, least, "a", "n", n).select(F.col("b").alias("a"), F.col("least").alias("b"))
        links = stage(below.unionByName(least.select("a", F.col("least").alias("b"))).filter("a != b").distinct(), "links")
        alone = both_ways(links).groupBy("a").agg(F.min("b").alias("b"), F.count(F.lit(1)).alias("n")).filter("n = 1 and b < a").select("a", "b")
        leaves.append(stage(alone, "leaves"))
        links = stage(links.join(leaves[-1].select("a"), "a", "left_anti"), "links")
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for alone in reversed(leaves):
        groups = alone.groupBy("b").agg(F.count(F.lit(1)).alias("n")).join(roots, F.col("b") == F.col("node"), "left").select("b", "n", F.coalesce("root", "b").alias("root"))
        roots = stage(roots.unionByName(attach(alone, groups, "b", "n", alone.count()).select(F.col("a").alias("node"), "root")), "roots")
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def family_links(members: DataFrame) -> DataFrame:
    """(a, b): a star around the first member of each family."""
    first = members.groupBy("family").agg(F.min("key").alias("a"))
    return members.join(first, "family").filter("key != a").select("a", F.col("key").alias("b"))


class _Rooms:
    """The free room of zones, with the first zone that has enough of it, and the first that has the most, by a tree of largest rooms."""

    def __init__(self):
        self.size, self.n, self.most = 1, 0, [-math.inf, -math.inf]

    def add(self, room: float) -> int:
        if self.n == self.size:
            leaves = self.most[self.size :]
            self.size *= 2
            self.most = [-math.inf] * self.size + leaves + [-math.inf] * len(leaves)
            for i in reversed(range(1, self.size)):
                self.most[i] = max(self.most[2 * i], self.most[2 * i + 1])
        self.n += 1
        self.put(self.n - 1, room)
        return self.n - 1

    def put(self, zone: int, room: float) -> None:
        i = self.size + zone
        self.most[i] = room
        while i > 1:
            i //= 2
            self.most[i] = max(self.most[2 * i], self.most[2 * i + 1])

    def room(self, zone: int) -> float:
        return self.most[self.size + zone]

    def first(self, need: float) -> int | None:
        """The first zone with so much room."""
        if not self.n or self.most[1] < need:
            return None
        i = 1
        while i < self.size:
            i = 2 * i if self.most[2 * i] >= need else 2 * i + 1
        return i - self.size

    def emptiest(self) -> int:
        return self.first(self.most[1])


def packed(sizes: list[tuple[int, int]], cap: int, tolerance: int) -> list[tuple[int, int, int, int, bool]]:
    """(size, from, to, zone, indivisible): where the blocks of each size go, by their rank within it, from 0. sizes: (size, how many), falling."""
    rooms, whole, out = _Rooms(), [], []
    for size, n in sizes:
        done = 0
        while done < n:
            at = rooms.first(size)
            if at is not None:
                # Blocks of one size go on into the first zone until it has no more room for them; those of size 0 all go there.
                some = n - done if size <= 0 else min(n - done, int(rooms.room(at) // size))
            else:
                some, at = 1, None
                if size <= tolerance and rooms.n:
                    low = rooms.emptiest()
                    at = low if whole[low] or cap - rooms.room(low) + size <= cap + tolerance else None
                if at is None:
                    at = rooms.add(cap)
                    whole.append(size > cap)
            rooms.put(at, rooms.room(at) - some * size)
            out.append((size, done, done + some, at + 1, whole[at]))
            done += some
    return out


def pack(blocks: DataFrame, cap: int = 1500, tolerance: int = 100) -> DataFrame:
    """(theme, block, size, zone, indivisible): first-fit decreasing within each theme. blocks: theme, block, size.

    A block goes to the first zone of its theme with room; a small one that fits nowhere joins the smallest zone, within the tolerance;
    a larger one than the cap has a zone of its own. What goes where depends on sizes alone, so only a theme's counts of each size are walked
    in one group; the blocks are placed by their rank within theme and size.
    """

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = sorted(zip(pdf["size"].tolist(), pdf["n"].tolist()), reverse=True)
        out = pd.DataFrame(packed(sizes, cap, tolerance), columns=["size", "from", "to", "zone", "indivisible"])
        out.insert(0, "theme", pdf["theme"].iloc[0])
        return out

    counts = blocks.groupBy("theme", "size").agg(F.count(F.lit(1)).alias("n"))
    places = stage(counts.groupBy("theme").applyInPandas(walk, "theme string, size bigint, from bigint, to bigint, zone int, indivisible boolean"), "places")
    each = places.select("theme", "size", "zone", "indivisible", F.explode(F.sequence("from", F.col("to") - 1)).alias("rank"))
    ranked = blocks.select("theme", "block", "size", (F.row_number().over(Window.partitionBy("theme", "size").orderBy("block")) - 1).cast("bigint").alias("rank"))
    rows = ranked.join(each, ["theme", "size", "rank"]).select("theme", "block", "size", "zone", "indivisible")
    several = rows.groupBy("theme").agg(F.max("zone").alias("zones"))
    named = rows.join(several, "theme").withColumn("zone", F.when(F.col("zones") == 1, F.col("theme")).otherwise(F.concat_ws("-", "theme", "zone")))
    return named.select("theme", "block", "size", F.translate("zone", ":_", "--").alias("zone"), "indivisible")


def cover_problems(members: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, problem): ids in no zone, in several, or unknown. members: zone, id."""
    n = members.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    rows = ids.select("id", F.lit(True).alias("known")).distinct().join(n, "id", "full")
    why = F.when(F.col("n").isNull(), "in no zone").when(F.col("known").isNull(), "unknown").when(F.col("n") > 1, "in several zones")
    return rows.select("id", why.alias("problem")).filter("problem is not null")


def complete(members: DataFrame, inventory: DataFrame, links: DataFrame) -> DataFrame:
    """(id, zone, how): where texts go when the inventory has changed. members: zone, id. inventory: id, unit, theme. links: a, b.

    Known texts stay; new ones join the zone of a family member, else that of their unit, else the smallest of their theme, else a
    new zone of their theme's name. Vanished texts are left out.
    """
    stay = members.join(inventory.select("id"), "id", "left_semi").select("id", "zone")
    new = inventory.join(stay, "id", "left_anti")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    kin = new.select("id").join(both, F.col("id") == F.col("a")).join(stay.select(F.col("id").alias("b"), F.col("zone").alias("z1")), "b").groupBy("id").agg(F.min_by("z1", "b").alias("z1"))
    units = stay.join(inventory, "id").groupBy("unit").agg(F.max_by("zone", "id").alias("z2"))
    sizes = stay.join(inventory, "id").groupBy("theme", "zone").agg(F.count(F.lit(1)).alias("n"))
    least = sizes.groupBy("theme").agg(F.min_by("zone", F.struct("n", "zone")).alias("z3"))
    rows = new.join(kin, "id", "left").join(units, "unit", "left").join(least, "theme", "left")
    how = F.when(F.col("z1").isNotNull(), "family").when(F.col("z2").isNotNull(), "unit").when(F.col("z3").isNotNull(), "theme").otherwise("new")
    return stay.withColumn("how", F.lit("kept")).unionByName(rows.select("id", F.coalesce("z1", "z2", "z3", "theme").alias("zone"), how.alias("how")))


def progress(zones: DataFrame, done: DataFrame) -> DataFrame:
    """(zone, texts, judged, state)."""
    rows = zones.join(done.select("id").distinct().withColumn("ok", F.lit(1)), "id", "left").groupBy("zone").agg(F.count(F.lit(1)).alias("texts"), F.count("ok").alias("judged"))
    return rows.withColumn("state", F.when(F.col("judged") == 0, "to do").when(F.col("judged") < F.col("texts"), "begun").otherwise("done"))
