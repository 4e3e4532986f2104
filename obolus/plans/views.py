"""The 29 release views over the 12 tables, each DataFrame -> DataFrame.

``Release`` holds the tables by name. Rules the views encode: published acts only; payroll and
suspect amounts kept apart; payments, commitments and awards are three measures of the same
euro and are never added together; a document's amount counts only when validated.

At scale: distinct counts are taken by grouping on the counted key first (partial sums combine
map-side) instead of ``count(distinct)`` over expanded rows; the latest statement is a hash
aggregate; shares rank only the ten largest members of a group; registry lookups are left to
Catalyst, which broadcasts them by measured size."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.functions.codes import four_digit_code
from obolus.operators.shape import latest_per_key, lookup_left, once, top_share, without_nearby
from obolus.session import written

TABLES = ("act", "payment", "commitment", "award", "counterparty", "entity", "budget_line", "procurement",
          "procurement_party", "grant_decision", "grant_line", "acceptance")
EY = ["entity", "year"]
c = F.col


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def total(amount: str, when: Column | None = None) -> Column:
    return F.sum(c(amount) if when is None else F.when(when, c(amount)))


class Release:
    """The tables of one release (attribute access) and the views over them (``view(name)``).
    ``table`` gives a table by name when a view first asks for it. ``derived``: what it gives is not a
    table but work, so the statements that a view reads several times are written first."""

    def __init__(self, table: Callable[[str], DataFrame], home: str = "1", derived: bool = False):
        self._table = table
        self.home = home  # uid of the body whose revenue the grants are set against
        self._derived = derived
        self._statements: dict[str | None, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self._table(name)

    def view(self, name: str) -> DataFrame:
        return VIEWS[name](self)

    def statements(self, entity: str | None = None) -> DataFrame:
        """The budget lines of all bodies or of one."""
        if entity not in self._statements:
            lines = self.budget_line if entity is None else self.budget_line.filter(c("entity") == entity)
            self._statements[entity] = written(lines) if self._derived else lines
        return self._statements[entity]

    @cached_property
    def counted(self) -> DataFrame:
        """Published, non-suspect payment lines."""
        return self.payment.filter((c("act_status") == "PUBLISHED") & ~c("amount_suspect"))


def v_act(r: Release) -> DataFrame:
    return r.act


def v_payment(r: Release) -> DataFrame:
    return r.counted.filter(~c("is_payroll"))


def v_supplier_payment(r: Release) -> DataFrame:
    return r.counted.filter(c("payee_class") == "supplier")


def v_internal_transfer(r: Release) -> DataFrame:
    return r.counted.filter(c("payee_class") == "internal_transfer")


def v_payee_class_year(r: Release) -> DataFrame:
    keys = [*EY, "payee_class"]
    per_doc = r.counted.groupBy(*keys, "source_ada").agg(F.count("*").alias("n"), total("amount").alias("eur"))
    return per_doc.groupBy(*keys).agg(F.sum("n").alias("n_lines"), F.count("source_ada").alias("n_acts"), F.sum("eur").alias("eur"))


def v_payment_suspect(r: Release) -> DataFrame:
    return r.payment.filter(c("amount_suspect"))


def v_payroll(r: Release) -> DataFrame:
    return r.payment.filter((c("act_status") == "PUBLISHED") & c("is_payroll"))


def v_commitment(r: Release) -> DataFrame:
    return r.commitment.filter((c("act_status") == "PUBLISHED") & ~c("is_reversal"))


def v_commitment_reversal(r: Release) -> DataFrame:
    return r.commitment.filter((c("act_status") == "PUBLISHED") & c("is_reversal"))


def v_award(r: Release) -> DataFrame:
    return r.award.filter(c("act_status") == "PUBLISHED")


def v_revoked(r: Release) -> DataFrame:
    return r.act.filter(c("status").isin("REVOKED", "PENDING_REVOCATION"))


def yearly_payments(payment: DataFrame) -> DataFrame:
    """Ten payment measures per entity and year. Documents and suppliers are each grouped on
    their own key, so both distinct counts are plain sums over pre-aggregated rows."""
    p = payment.filter(c("act_status") == "PUBLISHED")
    ok, line = ~c("amount_suspect"), ~c("is_payroll") & ~c("amount_suspect")
    supplier = ok & (c("payee_class") == "supplier")
    flag = lambda cond: F.max(F.when(cond, 1).otherwise(0))
    per_doc = p.groupBy(*EY, "source_ada").agg(
        flag(line).alias("_line"), flag(c("is_payroll")).alias("_payroll"),
        total("amount", line).alias("payment_eur"),
        total("amount", line & c("is_remittance")).alias("remittance_eur"),
        total("amount", supplier).alias("supplier_eur"),
        total("amount", ok & (c("payee_class") == "internal_transfer")).alias("internal_transfer_eur"),
        total("amount", ok & c("payee_class").isin("tax", "debt_service", "other_public_body")).alias("other_nonsupplier_eur"),
        total("amount", c("is_payroll")).alias("payroll_eur"),
        F.sum(F.when(c("amount_suspect"), 1).otherwise(0)).alias("n_suspect_lines"))
    docs = per_doc.groupBy(*EY).agg(
        F.sum(F.when(c("source_ada").isNotNull(), c("_line")).otherwise(0)).alias("n_payment_acts"),
        F.sum("payment_eur").alias("payment_eur"), F.sum("remittance_eur").alias("remittance_eur"),
        F.sum("supplier_eur").alias("supplier_eur"), F.sum("internal_transfer_eur").alias("internal_transfer_eur"),
        F.sum("other_nonsupplier_eur").alias("other_nonsupplier_eur"),
        F.sum(F.when(c("source_ada").isNotNull(), c("_payroll")).otherwise(0)).alias("n_payroll_acts"),
        F.sum("payroll_eur").alias("payroll_eur"), F.sum("n_suspect_lines").alias("n_suspect_lines"))
    suppliers = (p.filter(supplier & c("counterparty_afm").isNotNull()).select(*EY, "counterparty_afm").distinct()
                 .groupBy(*EY).agg(F.count("*").alias("n_suppliers")))
    return docs.join(suppliers, EY, "left").withColumn("n_suppliers", F.coalesce("n_suppliers", F.lit(0)))


def v_yearly(r: Release) -> DataFrame:
    acts = r.act.groupBy(*EY).agg(F.count("*").alias("n_acts"))
    payments = yearly_payments(r.payment)
    commitments = (r.commitment.filter(c("act_status") == "PUBLISHED").groupBy(*EY, "source_ada")
                   .agg(F.max(F.when(~c("is_reversal"), 1).otherwise(0)).alias("_n"),
                        total("amount", ~c("is_reversal")).alias("c"), total("amount", c("is_reversal")).alias("v"))
                   .groupBy(*EY).agg(F.sum("_n").alias("n_commitment_acts"), F.sum("c").alias("commitment_eur"),
                                     F.sum("v").alias("reversal_eur")))
    # an award's amount repeats on each awardee's row: one row per document and amount first
    awards = (v_award(r).select("source_ada", *EY, "amount").distinct().groupBy(*EY, "source_ada")
              .agg(F.sum("amount").alias("a")).groupBy(*EY)
              .agg(F.count("source_ada").alias("n_award_acts"), F.sum("a").alias("award_eur")))
    names = r.entity.select(c("uid").alias("entity"), c("name").alias("entity_name"))
    return (acts.join(payments, EY, "left").join(commitments, EY, "left").join(awards, EY, "left")
            .join(names, "entity", "left")
            .select("entity", "entity_name", "year", "n_acts", "n_payment_acts", "payment_eur", "remittance_eur",
                    "supplier_eur", "internal_transfer_eur", "other_nonsupplier_eur", "n_payroll_acts", "payroll_eur",
                    "n_suppliers", "n_suspect_lines", "n_commitment_acts", "commitment_eur", "reversal_eur",
                    "n_award_acts", "award_eur"))


def v_counterparty_year(r: Release) -> DataFrame:
    totals = (v_supplier_payment(r).filter(c("counterparty_afm").isNotNull())
              .groupBy(*EY, "counterparty_afm").agg(total("amount").alias("eur")))
    return top_share(totals, EY, "eur", "counterparty_afm")


def v_type_year(r: Release) -> DataFrame:
    return r.act.groupBy("year", "type", "status").agg(F.count("*").alias("n"))


def year_end_statements(r: Release, entity: str | None = None) -> DataFrame:
    """(entity, statement_ada): the latest year-end statement of each entity and period."""
    s = r.statements(entity).filter(c("is_year_end")).select("entity", "statement_ada", "period_end", "statement_date").distinct()
    order = F.struct(-F.unix_date("statement_date"), "statement_ada")
    return latest_per_key(s, ["entity", "period_end"], order, largest=False).select("entity", "statement_ada")


def _year_end_lines(r: Release, entity: str | None = None) -> DataFrame:
    return r.statements(entity).join(year_end_statements(r, entity), ["entity", "statement_ada"], "left_semi")


def v_budget_year(r: Release) -> DataFrame:
    return (_year_end_lines(r).groupBy("entity", c("period_year").alias("year"), "side", "kae_group")
            .agg(F.min("statement_ada").alias("statement_ada"), F.sum("budgeted").alias("budgeted"),
                 F.sum("assessed_or_warranted").alias("assessed_or_warranted"),
                 F.sum("collected_or_paid").alias("collected_or_paid")))


def _published_by_code(r: Release) -> DataFrame:
    return r.counted.filter(c("amount").isNotNull()).withColumn("code", four_digit_code(c("kae")))


def v_payment_coverage(r: Release) -> DataFrame:
    stmt = v_budget_year(r).filter(c("side") == "spending").select(
        *EY, "kae_group", c("collected_or_paid").alias("paid_per_statement"), "statement_ada")
    pub = (_published_by_code(r).groupBy(*EY, F.substring("code", 1, 2).alias("kae_group"))
           .agg(F.sum("amount").alias("paid_in_register")))
    paid = F.coalesce("paid_in_register", F.lit(0))
    return (stmt.join(pub, [*EY, "kae_group"], "left")
            .select(*EY, "kae_group", "paid_per_statement", paid.alias("paid_in_register"),
                    ratio(paid, c("paid_per_statement")).alias("coverage"), "statement_ada"))


def v_kae_reconciliation(r: Release) -> DataFrame:
    picked = _year_end_lines(r).select("entity", c("period_year").alias("year"), "side", "kae", "collected_or_paid")
    # every year with a statement is there, also one that has no spending line
    lines = picked.groupBy(*EY, F.when(c("side") == "spending", c("kae")).alias("kae")).agg(F.sum("collected_or_paid").alias("paid_per_statement"))
    years = lines.select(*EY).distinct()
    stmt = lines.filter(c("kae").isNotNull())
    pub = (_published_by_code(r).join(years, EY, "left_semi")
           .groupBy(*EY, c("code").alias("kae"))
           .agg(F.sum("amount").alias("paid_in_register"),
                F.max_by("source_ada", F.struct("amount", "source_ada")).alias("largest_ada"),
                F.max("amount").alias("largest_amount")))
    s, p = stmt.alias("s"), pub.alias("p")
    on = (c("s.entity") == c("p.entity")) & (c("s.year") == c("p.year")) & (c("s.kae") == c("p.kae"))
    stated, paid = F.coalesce("s.paid_per_statement", F.lit(0)), F.coalesce("p.paid_in_register", F.lit(0))
    return s.join(p, on, "full").select(
        *[F.coalesce(f"s.{k}", f"p.{k}").alias(k) for k in (*EY, "kae")], stated.alias("paid_per_statement"),
        paid.alias("paid_in_register"), (paid - stated).alias("excess_in_register"), "p.largest_ada", "p.largest_amount")


def v_procurement(r: Release) -> DataFrame:
    return r.procurement.filter(~c("cancelled"))


def v_grant_line(r: Release) -> DataFrame:
    lines = r.grant_line.filter((c("status") == "PUBLISHED") & c("validation").isNotNull() & c("amount").isNotNull()
                                & c("duplicate_of").isNull())
    return lines.join(r.grant_decision.select("ada", "subject", "decision_type", "issuer_label"), "ada")


def v_grant_year(r: Release) -> DataFrame:
    keys = ["year", "grantor", "recipient_entity", "category", "family"]
    per_doc = (v_grant_line(r).filter(c("category").isNotNull()).withColumn("year", c("budget_year"))
               .groupBy(*keys, "ada").agg(F.count("*").alias("n"), F.sum("amount").alias("a"), F.sum("net_paid").alias("p")))
    return per_doc.groupBy(*keys).agg(F.count("*").alias("n_decisions"), F.sum("n").alias("n_lines"),
                                      F.sum("a").alias("allocated"), F.sum("p").alias("net_paid"))


def v_revenue_grant_year(r: Release, entity: str | None = None) -> DataFrame:
    return (_year_end_lines(r, entity).filter((c("side") == "revenue") & c("grant_category").isNotNull())
            .groupBy("entity", c("period_year").alias("year"), c("grant_category").alias("category"))
            # the codes of one statement: as many as the chart of accounts has, no more
            .agg(F.min("statement_ada").alias("statement_ada"),
                 F.array_join(F.array_sort(F.collect_list("kae")), ", ").alias("kae_lines"),
                 F.sum("budgeted").alias("budgeted"), F.sum("assessed_or_warranted").alias("assessed"),
                 F.sum("collected_or_paid").alias("collected")))


def v_budget_month(r: Release, entity: str | None = None) -> DataFrame:
    """What each line moved in each month, from cumulative figures. A line a later statement of
    the year no longer prints stands at zero there (``absent``)."""
    keys = ["entity", "side", "year"]
    m = (r.statements(entity).withColumns({"year": c("period_year"), "month": c("period_month")})
         .groupBy(*keys, "month", "kae")
         .agg(F.min("description").alias("description"), F.min("statement_ada").alias("statement_ada"),
              F.sum("assessed_or_warranted").alias("assessed_to_date"), F.sum("collected_or_paid").alias("collected_to_date")))
    # a year's statements and a line's months: twelve at most, so both stay inside a row
    stmt = (m.groupBy(*keys, "month").agg(F.min("statement_ada").alias("stmt_ada")).groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct("month", "stmt_ada"))).alias("_months")))
    item = F.struct("month", "description", "statement_ada", "assessed_to_date", "collected_to_date")
    lines = m.groupBy(*keys, "kae").agg(F.array_sort(F.collect_list(item)).alias("_items"))
    first, last = F.get("_items", F.lit(0))["month"], F.element_at("_items", -1)["description"]
    found = lambda x: F.get(F.filter("_items", lambda i: i["month"] == x["month"]), F.lit(0))
    cells = F.transform(F.filter("_months", lambda x: x["month"] >= first), lambda x: F.struct(x["month"].alias("month"), x["stmt_ada"].alias("stmt"), found(x).alias("f")))
    grid = once(lines.join(stmt, keys), "_cells", cells)
    zero = F.lit(0)

    def row(x: Column, i: Column) -> Column:
        before = F.get("_cells", i - 1)
        collected = F.coalesce(x["f"]["collected_to_date"], zero)
        return F.struct(
            x["month"].alias("month"), F.coalesce(x["f"]["description"], last).alias("description"), F.coalesce(x["f"]["statement_ada"], x["stmt"]).alias("statement_ada"),
            F.coalesce(x["f"]["assessed_to_date"], zero).alias("assessed_to_date"), collected.alias("collected_to_date"),
            (collected - F.coalesce(before["f"]["collected_to_date"], zero)).alias("collected_in_period"),
            (x["month"] - F.coalesce(before["month"], zero)).alias("months"), x["f"].isNull().alias("absent"))

    return grid.select(*keys, "kae", F.explode(F.transform("_cells", row)).alias("r")).select(
        *keys, "r.month", "kae", "r.description", "r.statement_ada", "r.assessed_to_date", "r.collected_to_date", "r.collected_in_period", "r.months", "r.absent")


def v_revenue_grant_month(r: Release, entity: str | None = None) -> DataFrame:
    cats = (r.statements(entity).filter((c("side") == "revenue") & c("grant_category").isNotNull())
            .groupBy("entity", c("period_year").alias("year"), "kae").agg(F.min("grant_category").alias("category")))
    return (v_budget_month(r, entity).filter(c("side") == "revenue").join(cats, [*EY, "kae"])
            .groupBy(*EY, "month", "category")
            .agg(F.max("months").alias("months"),
                 F.array_join(F.array_sort(F.collect_set("kae")), ", ").alias("kae_lines"),  # a chart's codes at most
                 F.sum("collected_in_period").alias("collected_in_period"), F.sum("collected_to_date").alias("collected_to_date")))


def v_grant_to_date(r: Release) -> DataFrame:
    months = v_revenue_grant_month(r, r.home)
    # a year of the home body: twelve months of its categories
    rev = (months.withColumn("last_month", F.max("month").over(Window.partitionBy("year"))).filter(c("month") == c("last_month"))
           .groupBy("year", "category").agg(F.max("month").alias("through_month"), F.sum("collected_to_date").alias("collected_to_date")))
    last = rev.select("year", c("through_month").alias("last_month")).distinct()
    lines = v_grant_line(r).filter((c("recipient_entity") == r.home) & c("category").isNotNull())
    until = F.last_day(F.make_date(last["year"], c("last_month"), F.lit(1)))
    given = (lines.drop("year").join(last, (c("budget_year") == last["year"]) & (c("date") <= until))
             .groupBy("year", "category", "ada").agg(F.sum("amount").alias("a"))
             .groupBy("year", "category").agg(F.count("*").alias("n_decisions"), F.sum("a").alias("allocated_to_date")))
    a, b = rev.alias("r"), given.alias("g")
    zero = F.lit(0)
    allocated = F.coalesce("g.allocated_to_date", zero)
    return a.join(b, (c("r.year") == c("g.year")) & (c("r.category") == c("g.category")), "full").select(
        F.coalesce("r.year", "g.year").alias("year"), F.coalesce("r.category", "g.category").alias("category"),
        "r.through_month", F.coalesce("g.n_decisions", zero).alias("n_decisions"), allocated.alias("allocated_to_date"),
        "r.collected_to_date", (allocated - F.coalesce("r.collected_to_date", zero)).alias("allocated_minus_collected"))


def v_grant_reconciliation(r: Release) -> DataFrame:
    given = (v_grant_year(r).filter(c("recipient_entity") == r.home).groupBy("year", "category")
             .agg(F.sum("n_decisions").alias("n_decisions"), F.sum("allocated").alias("allocated"), F.sum("net_paid").alias("net_paid")))
    booked = v_revenue_grant_year(r, r.home)
    g, b = given.alias("g"), booked.alias("b")
    zero = F.lit(0)
    allocated, assessed = F.coalesce("g.allocated", zero), F.coalesce("b.assessed", zero)
    return g.join(b, (c("g.year") == c("b.year")) & (c("g.category") == c("b.category")), "full").select(
        F.coalesce("g.year", "b.year").alias("year"), F.coalesce("g.category", "b.category").alias("category"),
        F.coalesce("g.n_decisions", zero).alias("n_decisions"), allocated.alias("allocated"), "b.assessed", "b.collected",
        "b.kae_lines", "b.statement_ada", (allocated - assessed).alias("allocated_minus_assessed"), "g.net_paid",
        (F.coalesce("g.net_paid", zero) - assessed).alias("net_minus_assessed"))


def v_acceptance_year(r: Release) -> DataFrame:
    """Acceptances by entity, year and grantor; ``distinct_stated`` adds each stated amount once
    per group, over every kind."""
    keys = [*EY, "grantor"]
    accepted = c("kind") == "acceptance"
    per_amount = r.acceptance.filter(c("status") == "PUBLISHED").groupBy(*keys, "amount_stated").agg(
        F.count("*").alias("n"), F.count_if(accepted).alias("a"), F.count_if(~accepted).alias("o"),
        total("amount_stated", accepted).alias("s"))
    return per_amount.groupBy(*keys).agg(
        F.sum("n").alias("n_acts"), F.sum("a").alias("n_acceptances"), F.sum("o").alias("n_proposals_and_amendments"),
        F.sum("s").alias("stated"), F.sum("amount_stated").alias("distinct_stated"))


def v_direct_award_year(r: Release) -> DataFrame:
    return (r.procurement.filter((c("endpoint") == "auction") & ~c("cancelled")
                                 & c("procedure_type").startswith(fv.DIRECT_AWARD_PREFIX))
            .groupBy(*EY).agg(F.count("*").alias("n_awards"), F.sum("total_cost_without_vat").alias("value_without_vat")))


def v_payment_combined(r: Release) -> DataFrame:
    """Both registers: every payment line with an amount, and every procurement payment whose
    payee has no payment line within 60 days."""
    own = v_payment(r).filter(c("amount").isNotNull()).select(
        "entity", "date", "year", c("counterparty_afm").alias("afm"), c("counterparty_display").alias("display_name"),
        "payee_class", "amount", F.lit("register").alias("source"), c("source_ada").alias("ref"))
    family = r.entity.filter(c("afm").isNotNull()).select("afm").distinct().withColumn("_family", F.lit(True))
    paid = r.procurement_party.filter((c("role") == "payee") & ~c("cancelled") & c("amount_with_vat").isNotNull())
    fresh = without_nearby(paid, own, ["entity", "afm"], "date", "submission_date", fv.NEARBY_DAYS)
    other = lookup_left(fresh, family, "afm", "ref").select(
        "entity", c("submission_date").alias("date"), "year", "afm", "display_name",
        F.when(c("_family"), F.lit("internal_transfer")).otherwise(F.lit("supplier")).alias("payee_class"),
        c("amount_with_vat").alias("amount"), F.lit("procurement").alias("source"), "ref")
    return own.unionByName(other)


def v_supplier_year_combined(r: Release) -> DataFrame:
    totals = (v_payment_combined(r).filter((c("payee_class") == "supplier") & c("afm").isNotNull())
              .groupBy(*EY, "afm").agg(F.sum("amount").alias("eur"), F.bool_and(c("source") == "procurement").alias("only_other")))
    return top_share(totals, EY, "eur", "afm", [F.count_if(c("only_other")).alias("n_only_procurement")])


VIEWS: dict[str, Callable[[Release], DataFrame]] = {
    f.__name__: f for f in (
        v_act, v_payment, v_supplier_payment, v_internal_transfer, v_payee_class_year, v_payment_suspect, v_payroll,
        v_commitment, v_commitment_reversal, v_award, v_revoked, v_yearly, v_counterparty_year, v_type_year, v_budget_year,
        v_payment_coverage, v_kae_reconciliation, v_procurement, v_grant_line, v_grant_year, v_revenue_grant_year,
        v_budget_month, v_revenue_grant_month, v_grant_to_date, v_grant_reconciliation, v_acceptance_year,
        v_direct_award_year, v_payment_combined, v_supplier_year_combined)
}
