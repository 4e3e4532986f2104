"""The 12 tables bound to a star schema (orders, lineitem, customer, supplier, part, nation):
each civic role is a projection of the fact tables, so every view runs on them as it would on
a release. Joins are on the fact tables' own keys; dimension sizes are left to Catalyst."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obolus.functions.money import MONEY, format_amount_eu
from obolus.plans.views import Release
from obolus.session import written

c = F.col


def by_value(key: Column, table: dict[object, str | None], default: str | None = None) -> Column:
    out = None
    for k, v in table.items():
        out = (F.when if out is None else out.when)(key == k, F.lit(v))
    return out.otherwise(F.lit(default))


# roles of the star schema's values
ACT_TYPE = {"1-URGENT": "Β.2.2", "2-HIGH": "Β.1.3", "3-MEDIUM": "Δ.1", "4-NOT SPECIFIED": "Δ.2.2", "5-LOW": "Β.3"}
ACT_STATUS = {"F": "PUBLISHED", "P": "REVOKED", "O": "PENDING_REVOCATION"}
PAYEE_CLASS = {0: "internal_transfer", 1: "remittance", 2: "tax", 3: "debt_service", 4: "other_public_body"}
GRANTORS = {0: "interior", 1: "region", 2: "foundation", 3: "ped", 4: "green_fund"}
GRANT_FAMILY = {"1-URGENT": "kap_general", "2-HIGH": "region_credit", "3-MEDIUM": "region_fund_payment",
                "4-NOT SPECIFIED": "foundation_statutory_grant", "5-LOW": "ped_grant"}
GRANT_CATEGORY = {"1-URGENT": "kap_general", "2-HIGH": "investment_programmes", "3-MEDIUM": "kap_investment",
                  "4-NOT SPECIFIED": "state_grants", "5-LOW": None}
READ_STATUS = {"1-URGENT": "read", "2-HIGH": "read", "3-MEDIUM": "absent", "4-NOT SPECIFIED": "listed", "5-LOW": "no_pdf"}
FOUND_BY = {"1-URGENT": ["ΝΗΣΙΔΟΣ", "58000"], "2-HIGH": ["ΝΗΣΙΔΟΣ"], "3-MEDIUM": ["999000111"],
            "4-NOT SPECIFIED": ["58000", "999000111"], "5-LOW": []}
VALIDATION = {"A": "column_totals", "N": "words_and_figures", "R": None}
ENDPOINT = {"1-URGENT": "request", "2-HIGH": "notice", "3-MEDIUM": "auction", "4-NOT SPECIFIED": "contract", "5-LOW": "payment"}
PROCEDURE = {"AUTOMOBILE": "Απευθείας ανάθεση", "BUILDING": "Ανοικτή διαδικασία", "FURNITURE": "Απευθείας ανάθεση λόγω ποσού",
             "MACHINERY": "Διαπραγμάτευση", "HOUSEHOLD": None}
ACCEPTANCE_KIND = {"1-URGENT": "acceptance", "2-HIGH": "acceptance", "3-MEDIUM": "proposal", "4-NOT SPECIFIED": "amendment",
                   "5-LOW": "acceptance"}
SUSPECT_OVER = 90_000
HOME = "7"


def money(col: Column) -> Column:
    return col.cast(MONEY)


def line_amount(factor: Column) -> Column:
    return F.round(money(c("l_extendedprice")) * factor, 2).cast(MONEY)


# declared schemas: no footer is read to plan a query
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


FACT_KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey", "events": "event_id", "documents": "doc_id", "pages": "page_id",
             "conversations": "conv_id"}


def spread(df: DataFrame, key: str) -> DataFrame:
    """The table as it is, or, where the session sets ``obolus.spread``, dealt out by its key to so many
    partitions: for tables of one file with one row group, as on one machine. A cluster leaves it unset."""
    parts = df.sparkSession.conf.get("obolus.spread", None)
    return df.repartition(int(parts), key) if parts else df


class Star:
    """The parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in SCHEMAS:
            raise AttributeError(name)
        df = self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")
        return spread(df, FACT_KEYS[name]) if name in FACT_KEYS else df


class Bound:
    """Role tables over the star schema, built when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.star = Star(spark, folder)

    @cached_property
    def release(self) -> Release:
        return Release(lambda name: getattr(self, name), home=HOME, derived=True)

    def stored(self) -> Bound:
        """This binding with what several of its tables are made of written to the shared folder: acts, line items
        with their acts, and payments are derived once. The other tables are projections or sums of these."""
        for name in ("decisions", "lines", "payment"):
            setattr(self, name, written(getattr(self, name)))  # in the place of the cached property
        return self

    @cached_property
    def customer(self) -> DataFrame:
        return self.star.customer.select(c("c_custkey").alias("o_custkey"), c("c_nationkey").cast("string").alias("entity"),
                                         "c_mktsegment", c("c_nationkey"))

    @cached_property
    def decisions(self) -> DataFrame:
        """Orders as acts of an entity."""
        date = c("o_orderdate").cast("date")
        return (self.star.orders.join(self.customer, "o_custkey")
                .select(c("o_orderkey"), F.concat(F.lit("A"), c("o_orderkey").cast("string")).alias("ada"), "entity",
                        "c_mktsegment", "o_custkey", "o_orderpriority", "o_orderstatus", "c_nationkey",
                        money(c("o_totalprice")).alias("price"), date.alias("date"), F.year(date).alias("year")))

    @cached_property
    def lines(self) -> DataFrame:
        """Line items with the act they belong to."""
        keep = self.decisions.select("o_orderkey", "ada", "entity", "date", "year", "o_orderpriority", "c_mktsegment", "o_orderstatus", "price")
        return self.star.lineitem.join(keep, c("l_orderkey") == c("o_orderkey"))

    @cached_property
    def keyed_act(self) -> DataFrame:
        """Acts with the key of the order that they are made of."""
        d = self.decisions
        amount = format_amount_eu((c("price") * 100).cast("bigint"))
        subject = (F.when(c("c_mktsegment") == "AUTOMOBILE", F.concat(F.lit("Αποδοχή χρηματοδότησης ποσού "), amount, F.lit(" € από το Πράσινο Ταμείο έτους "), c("year").cast("string")))
                   .when(c("c_mktsegment") == "BUILDING", F.concat(F.lit("Ανατροπή ανάληψης  υποχρέωσης, απόδοση κρατήσεων "), c("ada")))
                   .when(c("c_mktsegment") == "FURNITURE", F.lit("Μισθοδοσία μηνός και υπερωρίες προσωπικού"))
                   .when(c("c_mktsegment") == "MACHINERY", F.concat(F.lit("Εισήγηση για αποδοχή επιχορήγησης ποσού "), amount, F.lit(" € από το ΥΠΕΣ")))
                   .otherwise(F.lit("ΔΗΜΟΣΙΕΥΣΗ ΣΤΟΙΧΕΙΩΝ EΚΤΕΛΕΣΗΣ ΠΡOΫΠΟΛΟΓΙΣΜΟΥ, ΕΝΦΙΑ")))
        return d.select("o_orderkey", "ada", "entity", by_value(c("o_orderpriority"), ACT_TYPE).alias("type"), "date", "year",
                        subject.alias("subject"), by_value(c("o_orderstatus"), ACT_STATUS).alias("status"))

    @cached_property
    def act(self) -> DataFrame:
        return self.keyed_act.drop("o_orderkey")

    @cached_property
    def supplier_name(self) -> DataFrame:
        n, name = c("s_nationkey"), c("s_name")
        raw = (F.when(n == 0, F.concat(F.lit("ΔΗΜΟΣ "), name)).when(n == 1, F.concat(F.lit("Τράπεζα "), name))
               .when(n == 2, F.concat(F.lit("Υπουργείο Οικονομικών "), name)).when(n == 3, F.concat(F.lit("ΕΠΩΝΥΜΟ,,ΟΝΟΜΑ "), name))
               .when(n == 4, F.concat(F.lit("Αφοί "), name, F.lit(" Ο.Ε."))).when(n == 5, F.concat(F.lit("Υπόλογος εντάλματος "), name))
               .when(n == 6, F.concat(name, F.lit(" & Λοιποί"))).otherwise(name))
        return self.star.supplier.select(c("s_suppkey").alias("l_suppkey"), n.alias("s_nationkey"), raw.alias("s_raw_name"),
                                         F.concat(F.lpad((n * 4).cast("string"), 2, "0"), F.lpad(c("s_suppkey").cast("string"), 7, "0")).alias("s_afm"))

    @cached_property
    def part_code(self) -> DataFrame:
        n = F.substring("p_brand", 7, 2).cast("int")
        two = F.lpad(n.cast("string"), 2, "0")
        four = F.concat(F.lpad((F.lit(40) + c("p_size")).cast("string"), 2, "0"), two)
        raw = (F.when(n <= 10, F.concat(two, F.lit("."), four)).when(n <= 15, four)
               .when(n <= 20, F.concat(F.lit("0"), two, F.lit("."), four, F.lit("001")))
               .when(n <= 23, F.concat(F.lit("K"), four)).when(n == 24, F.lit("")))
        code = F.concat(F.lit("6"), two, F.lit("1"))
        return self.star.part.select(c("p_partkey").alias("l_partkey"), "p_type", n.alias("brand_no"), raw.alias("raw_code"), code.alias("code"))

    @cached_property
    def raw_payment(self) -> DataFrame:
        """Payment lines as they are flattened, before any classification. Items meet parts and suppliers while they
        are narrow and their acts last, by the order's key, so that they are not dealt out again with an act's
        columns and the lines of an act lie together."""
        items = self.star.lineitem.select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", (c("l_linestatus") == "F").alias("published"),
            (c("l_quantity") != 50).alias("identified"), line_amount(1 - c("l_discount").cast("decimal(4,2)")).alias("amount"))
        coded = items.join(self.part_code.select("l_partkey", "raw_code"), "l_partkey").drop("l_partkey")
        name = (F.when(c("l_returnflag") == "A", F.upper("s_raw_name")).when(c("l_returnflag") == "R", F.regexp_replace("s_raw_name", "#", ". "))
                .otherwise(c("s_raw_name")))
        paid = coded.join(self.supplier_name, "l_suppkey").select(
            "l_orderkey", "l_linenumber", "published", F.when(c("identified"), c("s_afm")).alias("afm"), (c("l_returnflag") == "R").alias("greek"), name.alias("name"), "raw_code", "amount")
        acts = self.decisions.select("o_orderkey", "ada", "entity", "date", "year").join(self.keyed_act.select("o_orderkey", "subject"), "o_orderkey")
        return paid.join(acts, c("l_orderkey") == c("o_orderkey")).select(
            c("ada").alias("source_ada"), c("l_linenumber").alias("line_no"), "entity", "date", "year",
            F.when(c("published"), F.lit("PUBLISHED")).otherwise(F.lit("REVOKED")).alias("act_status"),
            "afm", F.when(c("greek"), F.lit("EL")).alias("afm_type"), "name", "subject",
            c("raw_code").alias("kae"), "amount", F.sha2(c("ada"), 256).alias("source_sha256"))

    @cached_property
    def payment(self) -> DataFrame:
        payroll = (c("l_returnflag") == "N") & (c("l_quantity") == 1)
        amount = F.when(~((c("l_linenumber") == 7) & (c("l_tax") == 0.08)),
                        line_amount(1 - c("l_discount").cast("decimal(4,2)")))
        sup = self.star.supplier.select(c("s_suppkey").alias("l_suppkey"), "s_nationkey", "s_name")
        afm = F.when(~payroll & (c("l_quantity") != 50), F.lpad(c("l_suppkey").cast("string"), 9, "0"))
        klass = F.when(payroll, F.lit("payroll")).otherwise(by_value(c("s_nationkey"), PAYEE_CLASS, "supplier"))
        reason = F.when(amount > SUSPECT_OVER, F.lit("threshold")).when((c("l_returnflag") == "R") & (c("l_quantity") == 2), F.lit("duplicate_posting"))
        return (self.lines.join(sup, "l_suppkey").join(self.part_code.select("l_partkey", "code"), "l_partkey")
                .select(c("ada").alias("source_ada"), c("l_linenumber").alias("line_no"), "entity", "date", "year",
                        F.when(c("l_linestatus") == "F", F.lit("PUBLISHED")).otherwise(F.lit("REVOKED")).alias("act_status"),
                        payroll.alias("is_payroll"), F.when(payroll, F.lit("batch")).alias("payroll_kind"), klass.alias("payee_class"),
                        (klass == "internal_transfer").alias("is_internal_transfer"), afm.alias("counterparty_afm"),
                        F.lit(None).cast("string").alias("counterparty_afm_type"),
                        F.when(~payroll, c("s_name")).alias("counterparty_display"), F.when(~payroll, c("s_name")).alias("counterparty_name_raw"),
                        amount.alias("amount"), F.concat(F.lit("20."), c("code")).alias("kae"),
                        (klass == "remittance").alias("is_remittance"), reason.isNotNull().alias("amount_suspect"),
                        reason.alias("suspect_reason"), F.sha2(c("ada"), 256).alias("source_sha256")))

    @cached_property
    def commitment(self) -> DataFrame:
        return self.lines.select(
            c("ada").alias("source_ada"), c("l_linenumber").alias("line_no"), "entity", "date", "year",
            F.when(c("l_linestatus") == "F", F.lit("PUBLISHED")).otherwise(F.lit("REVOKED")).alias("act_status"),
            F.when(c("l_quantity") != 13, money(c("l_extendedprice"))).alias("amount"), (c("l_linenumber") == 7).alias("is_reversal"),
            (c("l_quantity") > 1).alias("has_kae_lines"))

    @cached_property
    def award(self) -> DataFrame:
        return self.lines.select(
            c("ada").alias("source_ada"), "entity", "date", "year",
            F.when(c("o_orderstatus") == "F", F.lit("PUBLISHED")).otherwise(F.lit("REVOKED")).alias("act_status"),
            F.when(c("o_orderpriority") != "5-LOW", c("price")).alias("amount"),
            F.lpad(c("l_suppkey").cast("string"), 9, "0").alias("person_afm"))

    @cached_property
    def entity(self) -> DataFrame:
        return self.star.nation.select(
            c("n_nationkey").cast("string").alias("uid"), c("n_name").alias("name"),
            F.when(c("n_regionkey") != 4, F.lpad(c("n_nationkey").cast("string"), 9, "0")).alias("afm"),
            c("n_regionkey").cast("string").alias("category"))

    @cached_property
    def counterparty(self) -> DataFrame:
        from obolus.operators.resolve import counterparties
        return counterparties(self.payment)

    @cached_property
    def budget_line(self) -> DataFrame:
        """Monthly cumulative statements by brand; December's is posted a second time, corrected."""
        side = F.when(c("l_returnflag") == "A", F.lit("revenue")).otherwise(F.lit("spending"))
        keys = ["entity", "side", "year", "kae"]
        n = c("brand_no")
        kae = F.when(c("l_returnflag") == "A", F.concat(F.lit("1"), F.lpad(n.cast("string"), 2, "0"), F.lit("1"))).otherwise(c("code"))
        monthly = (self.lines.join(self.part_code.select("l_partkey", "code", "brand_no"), "l_partkey")
                   .groupBy("entity", side.alias("side"), "year", F.month("date").alias("month"), kae.alias("kae"), n.alias("brand_no"))
                   .agg(F.sum(money(c("l_extendedprice"))).alias("b"), F.sum(line_amount(1 - c("l_discount").cast("decimal(4,2)"))).alias("a"),
                        F.sum(line_amount(1 - c("l_tax").cast("decimal(4,2)"))).alias("p")))
        run = Window.partitionBy(*keys).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
        cum = monthly.withColumns({k: F.sum(k).over(run) for k in ("b", "a", "p")})
        end = F.last_day(F.make_date("year", "month", F.lit(1)))
        cat = (F.when(n <= 5, F.lit("kap_general")).when(n <= 10, F.lit("kap_investment")).when(n <= 15, F.lit("state_grants"))
               .when(n <= 18, F.lit("investment_programmes")))
        sid = F.concat_ws("-", F.lit("S"), c("entity"), c("year").cast("string"), c("month").cast("string"))
        again = F.when(c("month") == 12, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
        posted = cum.select("*", F.explode(again).alias("corrected"))
        late, one = c("corrected"), F.when(c("corrected"), F.lit(1)).otherwise(F.lit(0))
        return posted.select(
            F.when(late, F.concat(sid, F.lit("b"))).otherwise(sid).alias("statement_ada"), "entity", F.date_add(end, F.when(late, 25).otherwise(15)).alias("statement_date"), end.alias("period_end"),
            c("year").alias("period_year"), c("month").alias("period_month"), (c("month") == 12).alias("is_year_end"), "side", "kae",
            F.substring("kae", 1, 2).alias("kae_group"),
            F.concat(F.lit("Γραμμή "), n.cast("string"), F.lit(" τρίμηνο "), F.quarter(end).cast("string")).alias("description"),
            F.when(c("side") == "revenue", cat).alias("grant_category"), (c("b") + one).alias("budgeted"), c("a").alias("assessed_or_warranted"),
            c("p").alias("collected_or_paid"))

    @cached_property
    def grant_decision(self) -> DataFrame:
        p = c("o_orderpriority")
        found = F.array().cast("array<string>")
        for k, v in FOUND_BY.items():
            found = F.when(p == k, F.array(*[F.lit(x) for x in v]).cast("array<string>")).otherwise(found)
        region = self.star.nation.select(c("n_nationkey").alias("c_nationkey"), "n_regionkey")
        return (self.decisions.join(region, "c_nationkey").select(
            "ada", c("entity").alias("issuer"), by_value(c("n_regionkey"), GRANTORS).alias("grantor"), c("entity").alias("issuer_label"),
            "date", "year", F.when(F.month("date") == 12, c("year") + 1).otherwise(c("year")).alias("budget_year"),
            by_value(p, ACT_TYPE).alias("decision_type"), by_value(c("o_orderstatus"), ACT_STATUS).alias("status"),
            F.concat(F.lit("Απόδοση "), c("c_mktsegment"), F.lit(" Δήμου Νησίδος")).alias("subject"), by_value(p, GRANT_FAMILY).alias("family"),
            by_value(p, GRANT_CATEGORY).alias("category"), c("o_custkey").cast("string").alias("protocol_number"),
            F.concat(c("date").cast("string"), F.lit("T"), F.lpad(c("o_orderkey").cast("string"), 12, "0")).alias("submission_ts"),
            found.alias("found_by"), (c("o_orderstatus") == "F").alias("text_indexed"), by_value(p, READ_STATUS).alias("read_status"),
            F.when(p == "5-LOW", 0).otherwise(1).alias("n_amounts"), F.when(p != "5-LOW", c("ada")).alias("pdf_sha256"),
            F.when((c("c_mktsegment") == "HOUSEHOLD") & (p == "5-LOW"), F.lit("A0")).alias("duplicate_of")))

    @cached_property
    def grant_line(self) -> DataFrame:
        p = c("o_orderpriority")
        region = self.star.nation.select(c("n_nationkey").cast("string").alias("entity"), "n_regionkey")
        amount = line_amount(F.lit(1).cast("decimal(4,2)"))
        return (self.lines.join(region, "entity").select(
            "ada", by_value(c("n_regionkey"), GRANTORS).alias("grantor"), c("entity").alias("recipient_entity"), "date", "year",
            F.when(F.month("date") == 12, c("year") + 1).otherwise(c("year")).alias("budget_year"),
            F.when(c("l_linestatus") == "F", F.lit("PUBLISHED")).otherwise(F.lit("REVOKED")).alias("status"),
            by_value(p, GRANT_FAMILY).alias("family"), by_value(p, GRANT_CATEGORY).alias("category"), amount.alias("amount"),
            F.when(c("l_returnflag") == "N", line_amount(1 - c("l_tax").cast("decimal(4,2)"))).alias("net_paid"),
            by_value(c("l_returnflag"), VALIDATION).alias("validation"), F.when(c("l_linenumber") == 7, F.lit("A0")).alias("duplicate_of")))

    @cached_property
    def acceptance(self) -> DataFrame:
        return self.decisions.select(
            "ada", "entity", "date", "year", by_value(c("o_orderstatus"), ACT_STATUS).alias("status"),
            F.lower("c_mktsegment").alias("grantor"), by_value(c("o_orderpriority"), ACCEPTANCE_KIND).alias("kind"),
            F.when(c("o_orderpriority") != "5-LOW", money(F.floor(c("price") / 10000) * 10000)).alias("amount_stated"))

    @cached_property
    def procurement(self) -> DataFrame:
        return self.decisions.select(
            c("ada").alias("ref"), by_value(c("o_orderpriority"), ENDPOINT).alias("endpoint"), "entity", c("date").alias("submission_date"),
            "year", (c("o_orderstatus") == "P").alias("cancelled"), by_value(c("c_mktsegment"), PROCEDURE).alias("procedure_type"),
            c("price").alias("total_cost_without_vat"))

    @cached_property
    def procurement_party(self) -> DataFrame:
        date = c("l_shipdate").cast("date")
        return self.lines.select(
            F.concat_ws("-", F.lit("R"), c("l_orderkey").cast("string"), c("l_linenumber").cast("string")).alias("ref"), "entity",
            date.alias("submission_date"), F.year(date).alias("year"), ((c("l_returnflag") == "N") & (c("l_quantity") == 3)).alias("cancelled"),
            F.when(c("l_quantity") == 4, F.lit("contractor")).otherwise(F.lit("payee")).alias("role"),
            F.when(c("l_quantity") != 5, F.lpad(c("l_suppkey").cast("string"), 9, "0")).alias("afm"),
            F.lpad(c("l_suppkey").cast("string"), 9, "0").alias("display_name"),
            line_amount(1 + c("l_tax").cast("decimal(4,2)")).alias("amount_with_vat"))
