"""Payees across documents: class propagation and the counterparty registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.functions.money import MONEY
from obolus.functions.text import normalise_name
from obolus.operators.classify import is_natural_person, mask_person
from obolus.operators.shape import group_digest, lookup_left


def class_targets(payments: DataFrame, share: float = fv.PROPAGATION_SHARE) -> DataFrame:
    """(counterparty_afm, target_class) of ids whose counted euros are at least ``share``
    non-supplier and who still have supplier euros. Only published, non-suspect, non-zero lines
    vote; among equal classes the fixed order decides."""
    c = F.col
    votes = payments.filter(c("counterparty_afm").isNotNull() & (c("act_status") == "PUBLISHED")
                            & ~c("amount_suspect") & (c("amount") != 0))
    zero = F.lit(0).cast(MONEY)
    per_class = lambda k: F.sum(F.when(c("payee_class") == k, c("amount")).otherwise(zero)).alias(f"_{k}")
    sums = votes.groupBy("counterparty_afm").agg(F.sum("amount").alias("_total"),
                                                 *[per_class(k) for k in (*fv.NON_SUPPLIER, "supplier")])
    non_supplier = sum((c(f"_{k}") for k in fv.NON_SUPPLIER[1:]), c(f"_{fv.NON_SUPPLIER[0]}"))
    best = F.greatest(*[c(f"_{k}") for k in fv.NON_SUPPLIER])
    target = F.coalesce(*[F.when(c(f"_{k}") == best, F.lit(k)) for k in fv.NON_SUPPLIER])
    enough = non_supplier >= c("_total") * F.lit(share).cast("decimal(5,4)")
    return sums.filter((c("_total") > 0) & enough & (c("_supplier") > 0)).select("counterparty_afm", target.alias("target_class"))


def propagate_payee_class(payments: DataFrame, share: float = fv.PROPAGATION_SHARE) -> DataFrame:
    """Every supplier line of a target id, of whatever status, takes the target class."""
    out = lookup_left(payments, class_targets(payments, share), "counterparty_afm", "source_ada")
    moved = (F.col("payee_class") == "supplier") & F.col("target_class").isNotNull()
    return out.withColumns({
        "payee_class_rule": F.when(moved, F.lit("afm_propagation")).otherwise(F.col("payee_class_rule")),
        "payee_class": F.when(moved, F.col("target_class")).otherwise(F.col("payee_class")),
    }).drop("target_class")


def _identified(payments: DataFrame) -> DataFrame:
    return payments.filter(~F.col("is_payroll") & F.col("counterparty_afm").isNotNull())


def counterparty_names(payments: DataFrame) -> DataFrame:
    """(afm, name, n, first): the name variants in long form, with their first line."""
    first = F.struct("date", "source_ada", "line_no")
    return (_identified(payments).filter(F.length("counterparty_name_raw") > 0)
            .groupBy(F.col("counterparty_afm").alias("afm"), F.col("counterparty_name_raw").alias("name"))
            .agg(F.count("*").alias("n"), F.min(first).alias("first")))


def counterparty_sources(payments: DataFrame) -> DataFrame:
    """(afm, source_ada): every document of an id, in long form."""
    return _identified(payments).select(F.col("counterparty_afm").alias("afm"), "source_ada").distinct()


def counterparties(payments: DataFrame) -> DataFrame:
    """One row per tax id over non-payroll lines; names are never merged by likeness.

    One pass: lines are summed per id, class, entity and name; each such row gives one per facet
    (class, entity, name), counted per (id, facet, value), and the modal values are chosen among the
    counts, ties by first line. The variants and documents of an id may be many, so they stay in long form
    (``counterparty_names``, ``counterparty_sources``); their number and digest are here. The only
    array is ``entities``, at most as long as the registry."""
    c = F.col
    counted = (c("act_status") == "PUBLISHED") & ~c("amount_suspect")
    amount = F.coalesce(c("amount"), F.lit(0).cast(MONEY))
    facet = lambda name, value: F.struct(F.lit(name).alias("k"), value.alias("v"))
    name = F.when(F.length("counterparty_name_raw") > 0, c("counterparty_name_raw"))
    lines = _identified(payments).select(
        c("counterparty_afm").alias("afm"), c("counterparty_afm_type").alias("t"), F.struct("date", "source_ada", "line_no").alias("line"),
        counted.alias("ok"), (c("act_status") != "PUBLISHED").alias("revoked"), c("amount_suspect").alias("suspect"), "is_remittance", amount.alias("amount"),
        c("payee_class").alias("class"), "entity", name.alias("name"))
    zero = F.lit(0).cast(MONEY)
    # lines of one id, class, entity and name are one row before a row becomes three
    kinds = lines.groupBy("afm", "class", "entity", "name").agg(
        F.count("*").alias("n"), F.max("line.date").alias("last_date"), F.min("t").alias("t"), F.min(F.struct("line", "t")).alias("first_line"),
        F.min(F.when(c("ok"), F.struct((-c("amount")).alias("a"), c("line.date").alias("d"), c("line.source_ada").alias("ada")))).alias("largest"),
        F.sum(F.when(c("ok"), c("amount")).otherwise(zero)).alias("eur"), F.count_if("ok").alias("n_ok"), F.count_if("revoked").alias("n_revoked"), F.count_if("suspect").alias("n_suspect"),
        F.bool_and("is_remittance").alias("remittance"))
    facets = kinds.withColumn("f", F.explode(F.array(facet("class", c("class")), facet("entity", c("entity")), facet("name", c("name")))))
    main = c("f.k") == "class"  # money and dates are taken from one facet only
    cells = facets.filter(c("f.v").isNotNull() | main).groupBy("afm", c("f.k").alias("k"), c("f.v").alias("v")).agg(
        F.sum("n").alias("n"), F.max("last_date").alias("last_date"), F.min("t").alias("t"), F.min("first_line").alias("first_line"),
        F.min(F.when(main, c("largest"))).alias("largest"), F.sum(F.when(main, c("eur")).otherwise(zero)).alias("eur"),
        F.sum(F.when(main & (c("class") == "supplier"), c("eur")).otherwise(zero)).alias("supplier_eur"),
        *[F.sum(F.when(main, c(x)).otherwise(F.lit(0).cast("bigint"))).alias(x) for x in ("n_ok", "n_revoked", "n_suspect")], F.bool_and("remittance").alias("remittance"))
    is_name = c("k") == "name"
    cells = cells.withColumns({
        "norm": F.when(is_name, normalise_name(c("v"))),
        "greek_person": is_name & is_natural_person(c("v"), c("afm"), F.lit("EL")),
        "other_person": is_name & is_natural_person(c("v"), c("afm"), F.lit("-")),
    })
    order = F.struct(-c("n"), c("first_line.line"))
    out = cells.groupBy("afm").agg(
        F.min("t").alias("afm_type"), F.min("first_line").alias("_first"), F.min("largest").alias("_largest"),
        F.min("first_line.line.date").alias("first_seen"), F.max("last_date").alias("last_seen"),
        F.sum("eur").cast(MONEY).alias("total_received"), F.sum("supplier_eur").cast(MONEY).alias("total_received_supplier"),
        F.sum("n_ok").alias("n_payments"), F.sum("n_revoked").alias("n_payments_revoked"), F.sum("n_suspect").alias("n_payments_suspect"),
        F.bool_and("remittance").alias("is_remittance_payee"),
        F.min_by("v", F.when(c("k") == "class", order)).alias("payee_class"),
        F.min_by("v", F.when(is_name, order)).alias("canonical_name"),
        F.array_sort(F.collect_set(F.when(c("k") == "entity", c("v")))).alias("entities"),
        F.count_if(is_name).alias("n_name_variants"), F.count_distinct("norm").alias("n_name_variants_normalised"),
        F.bool_or("greek_person").alias("_greek"), F.bool_or("other_person").alias("_other"))
    greek = F.coalesce(c("_first.t"), F.lit("")).isin("", "EL")
    reasons = F.array_compact(F.array(F.when(~c("afm").rlike(fv.TAX_ID), F.lit("afm_format")),
                                      F.when(c("n_name_variants_normalised") > 1, F.lit("name_variants"))))
    out = out.withColumns({
        "largest_payment_ada": c("_largest.ada"),
        "is_natural_person": F.when(greek, c("_greek")).otherwise(c("_other")),
        "n_entities": F.size("entities"),
        "needs_review": F.size(reasons) > 0,
        "review_reason": F.when(F.size(reasons) > 0, F.array_join(reasons, ",")),
    }).withColumn("display_name", mask_person(c("canonical_name"), c("is_natural_person")))
    out = out.drop("_first", "_largest", "_greek", "_other")
    if "source_sha256" in payments.columns:
        digest = group_digest(_identified(payments).withColumnRenamed("counterparty_afm", "afm"), ["afm"], "source_sha256", "source_digest")
        out = out.join(digest, "afm")
    return out
