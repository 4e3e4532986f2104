"""CL10-CL14 with the shipped rule tables, on titles made of the orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from obolus import grant_rules as gr
from obolus.catalog.registry import query
from obolus.plans.bindings import by_value

c = F.col
# five titles and five issuers' kinds
TITLES = {"AUTOMOBILE": "Απόδοση από τους Κεντρικούς Αυτοτελείς Πόρους για λειτουργικές δαπάνες σχολείων", "BUILDING": "Έγκριση πίστωσης 70.000,00 € σε βάρος του έργου ΣΑΕ 055",
          "FURNITURE": "Επιχορήγηση για ληξιπρόθεσμες οφειλές", "MACHINERY": "Αίτημα χρηματοδότησης για ΣΚΑΠΑΝΗ", "HOUSEHOLD": "ENTAΛMA ΠΛΗΡΩΜΗΣ"}
KINDS = {"1-URGENT": "interior", "2-HIGH": "region", "3-MEDIUM": "union", "4-NOT SPECIFIED": "administration", "5-LOW": "culture"}
FAMILY = {
    ("AUTOMOBILE", "interior"): "school_operating", ("AUTOMOBILE", "administration"): "school_operating", ("BUILDING", "interior"): "pde_financing", ("BUILDING", "administration"): "pde_financing",
    ("FURNITURE", "interior"): "arrears", ("FURNITURE", "administration"): "arrears", ("FURNITURE", "culture"): "culture_grant", ("MACHINERY", "interior"): "pde_financing",
    ("MACHINERY", "administration"): "pde_financing", ("MACHINERY", "union"): "ped_grant", ("BUILDING", "region"): "region_credit", ("HOUSEHOLD", "region"): "region_payment", ("HOUSEHOLD", "union"): "ped_payment",
}
KIND_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in KINDS.items()) + " END"
FAMILY_SQL = "CASE " + " ".join(f"WHEN c_mktsegment = '{s}' AND kind = '{k}' THEN '{f}'" for (s, k), f in FAMILY.items()) + " ELSE 'other' END"
FAM = {"fams": f"SELECT ada, year + 20 AS year, {FAMILY_SQL} AS family FROM (SELECT *, {KIND_SQL} AS kind FROM decisions)"}


def families(b):
    d = b.decisions.select("ada", (c("year") + 20).alias("year"), by_value(c("c_mktsegment"), TITLES).alias("subject"), by_value(c("o_orderpriority"), KINDS).alias("kind"))
    return d.withColumn("family", gr.family_of(c("subject"), c("kind"), "ΝΗΣΙΔΟΣ"))


@query("cl10_family_of", "SELECT ada, family FROM fams", FAM)
def _(b):
    return families(b).select("ada", "family")


@query("cl11_refine_family", "SELECT ada, CASE WHEN family = 'arrears' AND year < 2018 THEN 'arrears_ceiling' ELSE family END AS family FROM fams", FAM)
def _(b):
    text = F.when(c("year") < 2018, F.lit("με  Εντολές\nΕξόφλησης")).otherwise(F.lit("στους Δήμους"))
    return families(b).select("ada", gr.refine_family(c("family"), text).alias("family"))


@query("cl12_category_by_year", "SELECT ada, CASE family WHEN 'school_operating' THEN 'kap_schools' WHEN 'pde_financing' THEN 'investment_programmes' WHEN 'arrears' THEN 'state_grants' WHEN 'ped_grant' THEN 'state_grants' WHEN 'ped_payment' THEN 'state_grants' WHEN 'region_credit' THEN 'investment_programmes' END AS category FROM fams", FAM)
def _(b):
    return families(b).select("ada", gr.category_of(c("family"), c("year")).alias("category"))


@query("cl13_revenue_category", """SELECT p_partkey, CASE WHEN p_size = 1 THEN 'foundation_contribution' WHEN p_size = 2 THEN 'programme_agreements' WHEN p_size = 3 THEN 'state_grants' WHEN p_size < 20 THEN CASE p_type WHEN 'ECONOMY' THEN 'kap_general'
    WHEN 'PROMO' THEN 'fire_protection' WHEN 'LARGE' THEN 'recovery_fund' END END AS category FROM part""")
def _(b):
    code = F.when(c("p_size") == 1, F.lit("2119")).when(c("p_size") == 2, F.lit("1310489")).when(c("p_size") == 3, F.lit("1219")).when(c("p_size") < 20, F.lit("0611")).otherwise(F.lit("3211"))
    name = F.when(c("p_type") == "ECONOMY", F.lit("ΚΑΠ για την  κάλυψη γενικών αναγκών")).when(c("p_type") == "PROMO", F.lit("Πυροπροστασία")).when(c("p_type") == "LARGE", F.lit("Ταμείο Ανάκαμψης")).otherwise(F.lit("Λοιπά"))
    return b.star.part.select("p_partkey", gr.revenue_category(code, name).alias("category"))


@query("cl14_recipient_of", "SELECT ada, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '2' WHEN 'BUILDING' THEN '3' ELSE '1' END AS recipient FROM decisions")
def _(b):
    subject = F.when(c("c_mktsegment") == "AUTOMOBILE", F.lit("στη Σχολική Επιτροπή")).when(c("c_mktsegment") == "BUILDING", F.lit("στο Λιμενικό  Ταμείο Νησίδος")).otherwise(F.lit("στο Δήμο"))
    bodies = (("2", "ΣΧΟΛΙΚ[Α-Ω]* ΕΠΙΤΡΟΠ"), ("3", "ΛΙΜΕΝΙΚ[Α-Ω]* ΤΑΜΕΙ[Α-Ω]* ΝΗΣΙΔΟΣ"))
    return b.decisions.select("ada", gr.recipient_of(subject, bodies, "1").alias("recipient"))
