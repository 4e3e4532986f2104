"""The report's queries over the release views. Each returns a small frame: rankings are cut
to k before they travel, totals are aggregates of aggregates, pivots have fixed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obolus.operators.shape import lookup_left
from obolus.plans.views import EY, Release, ratio, total, v_grant_line

c = F.col


def corpus_by_entity(r: Release) -> DataFrame:
    return r.act.groupBy("entity").agg(F.count("*").alias("n"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def status_counts(r: Release) -> DataFrame:
    return r.act.groupBy("status").agg(F.count("*").alias("n")).orderBy(c("n").desc(), "status")


def types_by_year(r: Release, k: int = 3) -> DataFrame:
    """Year x the k commonest types, the rest as 'other' = total - known. Types are renamed
    t1..tk by rank, so the pivot's columns are fixed and nothing is looked up first."""
    counts = r.act.groupBy("year", "type").agg(F.count("*").alias("n"))
    top = counts.groupBy("type").agg(F.sum("n").alias("n")).orderBy(c("n").desc(), "type").limit(k)
    ranked = top.select("type", F.expr("row_number() OVER (ORDER BY n DESC, type)").alias("rk"))  # k rows
    labelled = counts.join(ranked, "type", "left")
    cols = [F.coalesce(F.sum(F.when(c("rk") == i, c("n"))), F.lit(0)).alias(f"t{i}") for i in range(1, k + 1)]
    return labelled.groupBy("year").agg(F.sum("n").alias("total"), *cols, F.coalesce(F.sum(F.when(c("rk").isNull(), c("n"))), F.lit(0)).alias("other"))


YEARLY = ("n_acts n_payment_acts payment_eur supplier_eur remittance_eur internal_transfer_eur other_nonsupplier_eur n_payroll_acts payroll_eur "
          "n_commitment_acts commitment_eur reversal_eur n_award_acts award_eur").split()


def yearly_money(r: Release, entity: str | None = None) -> DataFrame:
    y = r.view("v_yearly")
    y = y if entity is None else y.filter(c("entity") == entity)
    return y.groupBy("year").agg(*[F.sum(k).alias(k) for k in YEARLY])


def payee_classes(r: Release) -> DataFrame:
    return (r.view("v_payee_class_year").groupBy("payee_class")
            .agg(F.sum("n_lines").alias("n_lines"), F.sum("n_acts").alias("n_acts"), F.sum("eur").alias("eur")).orderBy(c("eur").desc_nulls_last()))


def largest_internal_transfers(r: Release, k: int = 6) -> DataFrame:
    return (r.view("v_internal_transfer").groupBy("counterparty_display").agg(F.count("*").alias("n"), F.sum("amount").alias("eur"))
            .orderBy(c("eur").desc_nulls_last(), "counterparty_display").limit(k))


def supplier_series(r: Release) -> DataFrame:
    both = r.view("v_supplier_year_combined")
    own = r.view("v_counterparty_year").select(*EY, c("n_suppliers").alias("n_own"))
    return both.join(own, EY, "left").select(*EY, "n_own", "n_suppliers", "n_only_procurement", "supplier_eur", "top10_share", "top1_share")


def registry_review(r: Release) -> DataFrame:
    return r.counterparty.agg(F.count("*").alias("n"), F.count_if(c("needs_review")).alias("n_review"), F.sum("total_received").alias("total_received"))


def top_payees(r: Release, k: int = 15) -> DataFrame:
    """The largest suppliers; natural persons are never ranked."""
    return (r.counterparty.filter((c("total_received_supplier") > 0) & ~c("is_natural_person"))
            .select("afm", "display_name", "total_received_supplier", "n_payments", "first_seen", "last_seen", "largest_payment_ada")
            .orderBy(c("total_received_supplier").desc(), "afm").limit(k))


def natural_persons_line(r: Release) -> DataFrame:
    """One line for every natural person together, and their share of supplier euros."""
    people = r.counterparty.filter(c("is_natural_person")).select(c("afm").alias("counterparty_afm"), F.lit(True).alias("_p"))
    lines = lookup_left(r.view("v_supplier_payment"), people, "counterparty_afm", "source_ada")
    per_id = lines.groupBy("counterparty_afm", c("_p").isNotNull().alias("p")).agg(F.count("*").alias("n"), F.sum("amount").alias("eur"))
    sums = per_id.agg(F.count_if(c("p")).alias("n_persons"), F.coalesce(F.sum(F.when(c("p"), c("n"))), F.lit(0)).alias("n_lines"),
                      total("eur", c("p")).alias("eur"), F.sum("eur").alias("_all"))
    return sums.select("n_persons", "n_lines", "eur", ratio(c("eur"), c("_all")).alias("share"))


def suspect_lines(r: Release) -> DataFrame:
    acts = r.act.select(c("ada").alias("source_ada"), F.substring("subject", 1, 70).alias("subject"))
    return (r.view("v_payment_suspect").join(acts, "source_ada")
            .select("entity", "date", "source_ada", "amount", "suspect_reason", F.substring("counterparty_display", 1, 40).alias("payee"), "subject"))


def largest_lines(r: Release, k: int = 8) -> DataFrame:
    """The k largest supplier lines, cut before the subjects are fetched."""
    top = (r.view("v_supplier_payment").select("entity", "date", "source_ada", "line_no", "amount", F.substring("counterparty_display", 1, 40).alias("payee"), "kae")
           .orderBy(c("amount").desc_nulls_last(), "source_ada", "line_no", "payee", "kae").limit(k))
    acts = r.act.select(c("ada").alias("source_ada"), F.substring("subject", 1, 70).alias("subject"))
    return top.join(acts, "source_ada").drop("line_no")


def reversals(r: Release) -> DataFrame:
    per_doc = r.view("v_commitment_reversal").groupBy("source_ada").agg(F.sum("amount").alias("eur"))
    return per_doc.agg(F.count("source_ada").alias("n_acts"), F.sum("eur").alias("eur"))


def gap_counters(r: Release, act_type: str, year: int, entity: str) -> DataFrame:
    """What the data lack, one row: one pass over each table."""
    acts = r.act.agg(F.count_if(c("status") == "PENDING_REVOCATION").alias("pending"), F.count_if(c("status") == "REVOKED").alias("revoked"),
                     F.count_if((c("type") == act_type) & (c("year") == year) & (c("entity") == entity)).alias("awards_of_type"))
    payroll = r.payment.agg(F.count_if((c("act_status") == "PUBLISHED") & c("is_payroll")).alias("payroll_lines"))
    awards = r.award.agg(F.count_if((c("act_status") == "PUBLISHED") & c("amount").isNull()).alias("awards_without_amount"))
    bare = r.commitment.agg(F.count_if((c("act_status") == "PUBLISHED") & ~c("is_reversal") & ~c("has_kae_lines")).alias("commitments_without_lines"))
    parts = (acts, payroll, awards, bare)
    out = acts
    for one in parts[1:]:
        out = out.unionByName(one, allowMissingColumns=True)
    return out.agg(*[F.sum(x).alias(x) for part in parts for x in part.columns])


def reversal_years(r: Release, entity: str, since: int) -> DataFrame:
    zero = F.lit(0)
    return (r.view("v_yearly").filter((c("entity") == entity) & (c("year") >= since)
                                      & (F.coalesce("reversal_eur", zero) > F.coalesce("commitment_eur", zero)))
            .select("year", "reversal_eur", "commitment_eur"))


def payroll_kinds(r: Release) -> DataFrame:
    return r.payment.filter(c("is_payroll")).groupBy("payroll_kind").agg(F.count("*").alias("n"))


def acts_without_amount(r: Release, entity: str) -> DataFrame:
    """Per year: commitments with no usable amount, and whether the year is thin (> 5%)."""
    doc = (r.commitment.filter((c("entity") == entity) & (c("act_status") == "PUBLISHED")).groupBy("year", "source_ada")
           .agg(F.max(F.coalesce("amount", F.lit(0))).alias("m")))
    return doc.groupBy("year").agg(F.count_if(c("m") == 0).alias("n_empty"), F.count("*").alias("n")) \
        .withColumn("thin", c("n_empty") > 0.05 * c("n"))


def one_year_totals(r: Release, entity: str, year: int) -> DataFrame:
    cols = ("payment_eur", "n_payroll_acts", "commitment_eur", "n_payment_acts", "remittance_eur", "reversal_eur")
    return r.view("v_yearly").filter((c("entity") == entity) & (c("year") == year)).agg(*[F.sum(k).alias(k) for k in cols])


def coverage_by_year(r: Release, entity: str, without: str) -> DataFrame:
    rest = c("kae_group") != without
    return (r.view("v_payment_coverage").filter(c("entity") == entity).groupBy("year")
            .agg(F.sum("paid_per_statement").alias("paid_per_statement"), F.sum("paid_in_register").alias("paid_in_register"),
                 total("paid_in_register", rest).alias("_p"), total("paid_per_statement", rest).alias("_s"), F.min("statement_ada").alias("statement_ada"))
            .select("year", "paid_per_statement", "paid_in_register", ratio(c("_p"), c("_s")).alias("coverage_without"), "statement_ada"))


def grants_by_category(r: Release, grantor: str, groups: dict[str, tuple[str, ...]]) -> DataFrame:
    """Year x category groups, each a conditional sum of one scan."""
    g = r.view("v_grant_year").filter(c("grantor") == grantor)
    return g.groupBy("year").agg(F.sum("n_decisions").alias("n_decisions"), *[total("allocated", c("category").isin(*cats)).alias(name) for name, cats in groups.items()],
                                 F.sum("allocated").alias("allocated"))


def read_status_counts(r: Release, grantor: str) -> DataFrame:
    return r.grant_decision.filter(c("grantor") == grantor).groupBy("read_status").agg(F.count("*").alias("n"))


def found_counters(r: Release, grantor: str, term: str) -> DataFrame:
    """Decisions a term found, and those read though the index does not hold their text."""
    hidden = (c("read_status") == "read") & ~c("text_indexed") & ~F.array_contains("found_by", term)
    return r.grant_decision.filter(c("grantor") == grantor).agg(F.count_if(F.array_contains("found_by", term)).alias("named"), F.count_if(hidden).alias("hidden"))


def validated_lines(r: Release, grantor: str) -> DataFrame:
    lines = r.grant_line.filter(c("category").isNotNull() & (c("status") == "PUBLISHED") & c("duplicate_of").isNull() & (c("grantor") == grantor))
    return lines.agg(F.count("*").alias("n"), F.count("validation").alias("n_validated"))


def regional_money(r: Release, grantor: str, credit: str, fund: str, agreement: tuple[str, ...], utility: str) -> DataFrame:
    net = F.coalesce("net_paid", "amount")
    counted = c("category").isNotNull()
    lines = v_grant_line(r).filter(c("grantor") == grantor).withColumn("net", net)
    per_doc = lines.groupBy(c("budget_year").alias("year"), "ada").agg(
        F.max(F.when(counted, 1).otherwise(0)).alias("n"), total("amount", c("family") == credit).alias("credit"), total("amount", c("family") == fund).alias("fund"),
        total("net", c("family").isin(*agreement)).alias("agreement"), total("net", counted).alias("net"), total("amount", c("family") == utility).alias("utility"))
    return per_doc.groupBy("year").agg(F.sum("n").alias("n_decisions"), *[F.sum(k).alias(k) for k in ("credit", "fund", "agreement", "net", "utility")])


def families_of_ours(r: Release, grantor: str, body_pattern: str) -> DataFrame:
    """Family counts over decisions that name one of our bodies or that a number found."""
    by_number = F.exists("found_by", lambda t: t.rlike(r"^\d+$"))
    return (r.grant_decision.filter((c("grantor") == grantor) & c("duplicate_of").isNull() & (c("subject").rlike(body_pattern) | by_number))
            .groupBy("family").agg(F.count("*").alias("n")))


def statutory_vs_booked(r: Release, grantor: str, family: str, category: str) -> DataFrame:
    lines = v_grant_line(r).filter((c("grantor") == grantor) & (c("recipient_entity") == r.home) & (c("family") == family))
    given = (lines.groupBy("year", "ada").agg(F.sum("amount").alias("a"), total("amount", c("validation") == "words_and_figures").alias("w"))
             .groupBy("year").agg(F.count("*").alias("n"), F.sum("a").alias("eur"), F.sum("w").alias("spelled")))
    booked = r.view("v_revenue_grant_year").filter((c("entity") == r.home) & (c("category") == category)).select("year", "collected")
    return given.join(booked, "year", "left")


def decision_counters(r: Release, grantor: str, others: tuple[str, ...], water: str) -> DataFrame:
    d = r.grant_decision.filter((c("grantor") == grantor) & c("duplicate_of").isNull())
    return d.agg(F.count("*").alias("n"), F.count("pdf_sha256").alias("n_docs"),
                 F.count_if(c("family").isin(*others) | (c("read_status") == "absent")).alias("n_others"), F.count_if(c("family") == water).alias("n_water"))


def reconciliation_cell(allocated: Column, booked: Column) -> Column:
    """'=' to the cent, '≈0.15%' at the statutory withholding, else the signed difference."""
    diff = F.coalesce(allocated, F.lit(0)).cast("double") - F.coalesce(booked, F.lit(0)).cast("double")
    withheld = F.abs(F.try_divide(diff, allocated.cast("double")) - 0.0015) < 0.00002
    both = (F.coalesce(allocated, F.lit(0)) != 0) & (F.coalesce(booked, F.lit(0)) != 0)
    return F.when(F.abs(diff) < 0.005, F.lit("=")).when(both & F.coalesce(withheld, F.lit(False)), F.lit("≈0.15%")).otherwise(F.format_string("%+.2f", diff))


def reconciliation_matrix(r: Release, years: range) -> DataFrame:
    rec = r.view("v_grant_reconciliation").filter(c("year").between(years[0], years[-1]) & c("category").isNotNull())
    cells = rec.select("category", "year", reconciliation_cell(F.coalesce("net_paid", "allocated"), c("assessed")).alias("cell"))
    return cells.groupBy("category").pivot("year", list(years)).agg(F.min("cell"))


def other_grantors(r: Release, main: tuple[str, ...]) -> DataFrame:
    d = r.grant_decision.filter(~c("grantor").isin(*main) & c("duplicate_of").isNull())
    return d.groupBy("grantor").agg(F.count("*").alias("n"), F.count("pdf_sha256").alias("n_docs"))


def other_grantor_lines(r: Release, main: tuple[str, ...]) -> DataFrame:
    keys = ["grantor", "budget_year", "recipient_entity", "family"]
    lines = v_grant_line(r).filter(~c("grantor").isin(*main) & c("category").isNotNull())
    return (lines.groupBy(*keys, "ada").agg(F.sum("amount").alias("a")).groupBy(*keys).agg(F.count("*").alias("n_decisions"), F.sum("a").alias("eur")))


def subsidiaries_coverage(r: Release) -> DataFrame:
    s = r.view("v_payment_coverage").filter(c("entity") != r.home).groupBy(*EY).agg(F.sum("paid_per_statement").alias("paid"))
    p = r.counted.filter(c("amount").isNotNull()).groupBy(*EY).agg(F.sum("amount").alias("pub"))
    published = F.coalesce("pub", F.lit(0))
    return s.join(p, EY, "left").select(*EY, "paid", published.alias("published"), ratio(published, c("paid")).alias("coverage"))


def double_posted_lines(r: Release, keys: list[str] | None = None) -> DataFrame:
    """The same entity, date, code, amount and payee under two documents or more."""
    keys = keys or ["entity", "date", "kae", "amount", "counterparty_afm"]
    per_doc = r.payment.filter((c("act_status") == "PUBLISHED") & c("amount").isNotNull() & c("counterparty_afm").isNotNull()).groupBy(*keys, "source_ada").agg(F.count("*").alias("n"))
    return per_doc.groupBy(*keys).agg(F.count("*").alias("n_acts"), F.sum("n").alias("n_lines")).filter(c("n_acts") > 1)
