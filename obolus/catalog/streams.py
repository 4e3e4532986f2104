"""ST1-ST6 on the event and order tables read as streams, run to their end and compared with the
batch answer."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obolus.catalog.registry import query
from obolus.operators.shape import latest_per_key
from obolus.plans.bindings import SCHEMAS
from obolus.streaming import streams as st

c = F.col


def scratch(b) -> str:
    """A new folder below the session's shared checkpoint folder; on one machine a local one where
    the session names none."""
    shared = b.spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.fullmatch(r"local(\[.*\])?", b.spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="run-")


def stream(b, table: str) -> DataFrame:
    return b.spark.readStream.schema(SCHEMAS[table]).option("pathGlobFilter", f"{table}.parquet").parquet(b.star.folder)


def drained(b, df: DataFrame, mode: str) -> DataFrame:
    """Run a stream to its end into a table and read it."""
    base = scratch(b)
    out = f"{base}/out"
    if mode == "append":
        q = df.writeStream.outputMode("append").option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).format("parquet").start(out)
    else:
        q = (df.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/cp").trigger(availableNow=True)
             .foreachBatch(lambda d, n: d.withColumn("_batch", F.lit(n)).write.mode("append").parquet(out)).start())
    q.awaitTermination()
    return b.spark.read.schema(df.schema if mode == "append" else df.schema.add("_batch", "long")).parquet(out)


@query("st01_land_stream", "SELECT CAST(user_id AS VARCHAR) AS key, sha256(event_type) AS digest, min(event_id) AS seq FROM events GROUP BY 1, 2")
def _(b):
    base = scratch(b)
    e = stream(b, "events").select(c("user_id").cast("string").alias("key"), F.sha2("event_type", 256).alias("digest"), c("event_id").alias("seq"))
    for run in ("cp1", "cp2"):  # the second run sees everything again and lands nothing
        st.land_stream(e, f"{base}/landed", f"{base}/{run}").start().awaitTermination()
    return b.spark.read.schema("key string, digest string, seq bigint, bucket int").parquet(f"{base}/landed").select("key", "digest", "seq")


@query("st02_dedupe_stream", "SELECT count(DISTINCT user_id || '/' || event_type || '/' || CAST(ts AS DATE)) AS n FROM events")
def _(b):
    """A sighting is repeated within its day."""
    e = stream(b, "events").select(F.concat_ws("/", c("user_id").cast("string"), "event_type", c("ts").cast("date").cast("string")).alias("key"), c("ts").cast("timestamp").alias("at"))
    return drained(b, st.dedupe_stream(e, "key", "at", "2 days"), "append").agg(F.count("*").alias("n"))


@query("st03_gate_stream", "SELECT event_type <> 'error' AND value < 100 AS accepted, count(*) AS n FROM events GROUP BY 1")
def _(b):
    from obolus.operators.gates import reasons
    base = scratch(b)
    e = stream(b, "events").select("event_id", "event_type", "value")
    check = lambda df: df.withColumn("problems", reasons((c("event_type") == "error", "error"), (c("value") >= 100, "value")))
    st.gate_stream(e, f"{base}/ok", f"{base}/bad", f"{base}/cp", check).start().awaitTermination()
    ok = b.spark.read.schema("event_id bigint").parquet(f"{base}/ok").agg(F.count("*").alias("n")).select(F.lit(True).alias("accepted"), "n")
    bad = b.spark.read.schema("event_id bigint").parquet(f"{base}/bad").agg(F.count("*").alias("n")).select(F.lit(False).alias("accepted"), "n")
    return ok.unionByName(bad)


@query("st04_classify_stream", """SELECT payee_class, count(*) AS n FROM (SELECT CASE WHEN o_custkey < 5 THEN 'internal_transfer' WHEN o_orderpriority = '1-URGENT' THEN 'remittance' WHEN o_orderpriority = '2-HIGH' THEN 'tax'
    WHEN o_orderpriority = '3-MEDIUM' THEN 'debt_service' ELSE 'supplier' END AS payee_class FROM orders) GROUP BY 1""")
def _(b):
    p = c("o_orderpriority")
    lines = stream(b, "orders").select(F.lpad(c("o_custkey").cast("string"), 9, "0").alias("afm"), F.when(p == "3-MEDIUM", F.lit("Τράπεζα")).otherwise(F.lit("Εταιρεία")).alias("name"),
                                       F.when(p == "2-HIGH", F.lit("Πληρωμή ΕΝΦΙΑ")).otherwise(F.lit("Προμήθεια")).alias("subject"), F.when(p == "1-URGENT", F.lit("00.8211")).otherwise(F.lit("00.6111")).alias("kae"))
    family = b.star.customer.filter(c("c_custkey") < 5).select(F.lpad(c("c_custkey").cast("string"), 9, "0").alias("afm"))
    return drained(b, st.classify_stream(lines, family), "append").groupBy("payee_class").agg(F.count("*").alias("n"))


@query("st05_month_totals_stream", "SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus AS status, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1, 2")
def _(b):
    lines = stream(b, "orders").select(c("o_orderdate").cast("timestamp").alias("at"), c("o_orderstatus").alias("status"), c("o_totalprice").cast("decimal(18,2)").alias("amount"))
    changed = drained(b, st.month_totals_stream(lines, ["status"], "at", "amount", "5 days"), "update")
    daily = latest_per_key(changed, ["day", "status"], c("_batch"))
    return daily.groupBy("month", "status").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


@query("st06_without_nearby_stream", """SELECT r.o_orderkey, r.o_custkey, strftime(r.o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed FROM orders r
    WHERE NOT EXISTS (SELECT 1 FROM orders l WHERE l.o_orderstatus = 'F' AND l.o_custkey = r.o_custkey AND abs(date_diff('day', l.o_orderdate, r.o_orderdate)) <= 10)""")
def _(b):
    """Orders with no published order of their customer within ten days."""
    o = stream(b, "orders").select("o_orderkey", "o_custkey", c("o_orderdate").cast("timestamp").alias("placed"))
    paid = o.join(b.star.orders.filter(c("o_orderstatus") == "F").select(c("o_orderkey").alias("_k")), c("o_orderkey") == c("_k"), "left_semi") \
        .select("o_custkey", c("placed").alias("paid"))
    out = st.without_nearby_stream(o, paid, ["o_custkey"], "paid", "placed", 10, "5 days")
    given = drained(b, out, "append")
    batch = b.star.orders.select("o_orderkey", "o_custkey", c("o_orderdate").cast("timestamp").alias("placed"), "o_orderstatus")
    left = batch.filter(c("o_orderstatus") == "F").select("o_custkey", c("placed").alias("paid"))
    return st.finish_without_nearby(given, batch.drop("o_orderstatus"), left, ["o_custkey"], "paid", "placed", 10, 5)
