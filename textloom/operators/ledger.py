"""Reconciliation of findings with the ledgers: exceptions, debt and deferrals.

Every ledger row is identified by control, key and object; no row of either side is collected, and ledgers are joined by the triple.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

TRIPLE = ["control", "key", "object"]


def finding_print(control: Column, value: Column, actual: Column) -> Column:
    """The fingerprint that debt keeps of a finding: of the key's text, and of the variants as well where a group is judged."""
    text = F.coalesce(value, F.lit(""))
    return T.fingerprint(F.when(control == "homonyms", F.concat(text, F.lit("\n"), F.coalesce(actual, F.lit("")))).otherwise(text))


def reconcile(findings: DataFrame, exceptions: DataFrame, debt: DataFrame, values: DataFrame) -> DataFrame:
    """findings with bucket (covered, debt, blocking, flagged), the exception that covers (ordinal) and the final status.

    exceptions: control, key, object, reason, pin, fingerprint, ord. debt: control, key, object, fingerprint. values: key, value.
    The first exception, by ord, of the finding's control and key covers it if its object is empty or the same and its fingerprint is
    absent or that of the text; reasonless ones and pins never cover. Debt of the same triple tolerates a finding as long as the text
    is unchanged; if it has changed, the finding blocks.
    """
    rows = findings.withColumn("fid", F.xxhash64(*(F.col(c) for c in findings.columns))).join(values, "key", "left")
    rows = rows.withColumn("print", finding_print(F.col("control"), F.col("value"), F.col("actual"))).withColumn("text_print", T.fingerprint(F.col("value")))
    valid = exceptions.filter(~T.blank(F.col("reason")) & ~F.coalesce("pin", F.lit(False)))
    valid = valid.select(F.col("control").alias("ec"), F.col("key").alias("ek"), F.col("object").alias("eo"), F.col("fingerprint").alias("ep"), F.col("ord").alias("exception"))
    covers = (F.size(F.coalesce("eo", F.array())) <= 0) | (F.col("eo") == F.col("object"))
    fresh = F.coalesce(F.col("ep"), F.lit("")).isin("") | (F.col("ep") == F.col("text_print"))
    first = rows.join(valid, (F.col("control") == F.col("ec")) & (F.col("key") == F.col("ek"))).filter(covers & fresh).groupBy("fid").agg(F.min("exception").alias("exception"))
    owed = debt.groupBy(*TRIPLE).agg(F.collect_set("fingerprint").alias("prints"))
    out = rows.join(first, "fid", "left").join(owed, TRIPLE, "left")
    same = F.array_contains("prints", F.col("print"))
    bucket = (
        F.when(F.col("exception").isNotNull(), "covered")
        .when(same, "debt")
        .when(F.col("prints").isNotNull(), "blocking")
        .otherwise(F.when(F.col("status") == "blocking", "blocking").otherwise("flagged"))
    )
    return out.select(*findings.columns, bucket.alias("bucket"), "exception", (F.coalesce(~same, F.lit(False)) & F.col("exception").isNull()).alias("escalated"))


def unruled(findings: DataFrame, reconciled: DataFrame) -> DataFrame:
    """Findings whose keys stand in no ledger, in the columns of reconciled ones."""
    bucket = F.when(F.col("status") == "blocking", "blocking").otherwise("flagged")
    return findings.select(*findings.columns, bucket.alias("bucket"), F.lit(None).cast(reconciled.schema["exception"].dataType).alias("exception"), F.lit(False).alias("escalated"))


def orphan_exceptions(exceptions: DataFrame, reconciled: DataFrame, ran: list[str]) -> DataFrame:
    """Valid exceptions of executed controls that covered nothing."""
    valid = exceptions.filter(~T.blank(F.col("reason")) & ~F.coalesce("pin", F.lit(False)) & F.col("control").isin(*ran))
    return valid.join(reconciled.filter("bucket = 'covered'").select(F.col("exception").alias("ord")).distinct(), "ord", "left_anti")


def resolved_debt(debt: DataFrame, reconciled: DataFrame, ran: list[str]) -> DataFrame:
    """Debt of executed controls that no uncovered finding matches."""
    met = reconciled.filter("bucket != 'covered'").select(*TRIPLE).distinct()
    return debt.filter(F.col("control").isin(*ran)).join(met, TRIPLE, "left_anti")


def reasonless(exceptions: DataFrame) -> DataFrame:
    return exceptions.filter(T.blank(F.col("reason")))


def provisional(exceptions: DataFrame) -> DataFrame:
    """Valid exceptions that wait for an answer."""
    return exceptions.filter(~T.blank(F.col("reason")) & ~F.coalesce("pin", F.lit(False)) & ~T.blank(F.col("question")))


def deferred(deferrals: DataFrame, debt: DataFrame) -> DataFrame:
    """deferrals with `known`: whether a debt row of the same triple exists."""
    return deferrals.join(debt.select(*TRIPLE).distinct().withColumn("known", F.lit(True)), TRIPLE, "left").withColumn("known", F.coalesce("known", F.lit(False)))


def increased_debt(debt: DataFrame, baseline: DataFrame) -> DataFrame:
    """Rows whose triple the baseline hasn't: debt may only fall."""
    return debt.join(baseline.select(*TRIPLE).distinct(), TRIPLE, "left_anti")


def modified_debt(debt: DataFrame, baseline: DataFrame) -> DataFrame:
    """Rows whose triple the baseline has, with another fingerprint."""
    known = debt.join(baseline.select(*TRIPLE).distinct(), TRIPLE, "left_semi")
    return known.join(baseline.select(*TRIPLE, "fingerprint").distinct(), [*TRIPLE, "fingerprint"], "left_anti")


def report(reconciled: DataFrame) -> DataFrame:
    """Counts of each control by bucket."""
    return reconciled.groupBy("control").pivot("bucket", ["blocking", "flagged", "debt", "covered"]).count().na.fill(0)


def first_flagged(reconciled: DataFrame, n: int = 20) -> DataFrame:
    """The first n flagged findings of each control, by key."""
    from pyspark.sql import Window

    by = Window.partitionBy("control").orderBy("key", "detail")
    return reconciled.filter("bucket = 'flagged'").withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= n)


def obstacles(reconciled: DataFrame, exceptions: DataFrame, debt: DataFrame, deferrals: DataFrame, ran: list[str]) -> DataFrame:
    """(obstacle, n): what keeps the work from being closed; only what isn't zero."""
    left = debt.join(deferrals.select(*TRIPLE).distinct(), TRIPLE, "left_anti")
    parts = [
        ("blocking", reconciled.filter("bucket = 'blocking'")),
        ("reasonless exceptions", reasonless(exceptions)),
        ("debt without deferral", left),
        ("provisional exceptions", provisional(exceptions)),
        ("orphan exceptions", orphan_exceptions(exceptions, reconciled, ran)),
        ("orphan deferrals", deferred(deferrals, debt).filter("not known")),
        ("flagged", reconciled.filter("bucket = 'flagged'")),
    ]
    out = None
    for name, df in parts:
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("obstacle"), "n")
        out = row if out is None else out.unionByName(row)
    return out.filter("n > 0")


def exit_code(reconciled: DataFrame, exceptions: DataFrame) -> int:
    return int(not reconciled.filter("bucket = 'blocking'").isEmpty() or not reasonless(exceptions).isEmpty())
