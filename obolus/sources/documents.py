"""Landed documents: bytes, their hash and typed content.

Many small files are a poor table at scale, so every function takes a frame of (path, content)
and does not care whether it comes from files (``binary_files``) or from a Parquet table the
files were compacted into. Schemas are declared; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.operators.shape import once

c = F.col

PARTY = "struct<afm:string,afmType:string,name:string>"
MONEY_JSON = "struct<amount:decimal(18,2),currency:string>"
SPONSOR = f"struct<sponsorAFMName:{PARTY},expenseAmount:{MONEY_JSON},kae:string,cpv:string>"
KAE_LINE = (f"struct<kae:string,amountWithVAT:decimal(18,2),kaeBudgetRemainder:double,kaeCreditRemainder:double,"
            f"sponsorAFMName:{PARTY}>")
# fields that arrive as null, one object or a list are kept as text and read by codes.as_list
ACT_SCHEMA = (
    "ada string, organizationId string, decisionTypeId string, status string, issueDate bigint, submissionTimestamp bigint, "
    "publishTimestamp bigint, subject string, protocolNumber string, documentUrl string, versionId string, "
    "correctedVersionId string, signerIds string, unitIds string, thematicCategoryIds string, "
    f"extraFieldValues struct<documentType:string,skipVatReason:string,financialYear:int,budgettype:string,partialead:boolean,"
    "recalledExpenseDecision:boolean,relatedPartialADA:string,entryNumber:string,assignmentType:string,textRelatedADA:string,"
    "relatedEkgrisiDapanis:string,relatedDecisions:string,sponsor:string,"
    f"amountWithVAT:{MONEY_JSON},amountWithKae:string,awardAmount:{MONEY_JSON},cpv:string,person:string>"
)
CODE = "struct<key:string,value:string>"
RECORD_SCHEMA = (
    f"referenceNumber string, organization {CODE}, submissionDate string, contractSignedDate string, signedDate string, cancelled boolean, "
    f"title string, procedureType {CODE}, contractType {CODE}, contractTypes array<struct<contractType:{CODE}>>, "
    "totalCostWithoutVAT decimal(18,2), totalCostWithVAT decimal(18,2), contractRefNo string, auctionRefNo string, "
    "auctionReferenceNumber string, noticeRefNo string, noticeReferenceNumber string, requestRefNo string, paymentRefNo string, "
    "diavgeiaADA string, decisionRelatedAda string, paymentRelatedAda string, approvalADA string, contractRelatedADA string, "
    f"objectDetails array<struct<cpvs:array<{CODE}>,vatNo:string,greekVatNo:boolean,name:string,costWithoutVAT:decimal(18,2)>>, "
    f"objectDetailsList array<struct<cpvs:array<{CODE}>,vatNo:string,greekVatNo:boolean,name:string,costWithoutVAT:decimal(18,2)>>, "
    "contractingDataDetails struct<contractingMembersDataList:array<struct<vatNumber:string,greekVatNumber:boolean,name:string>>>"
)
ORG = "struct<uid:string,label:string>"
DECISION = (f"struct<ada:string,issueDate:string,status:string,subject:string,protocolNumber:string,submissionTimestamp:string,"
            f"decisionType:{ORG},organization:{ORG},cooperatingOrganizations:array<struct<uid:string>>,documentUrl:string,redacted:boolean>")
SEARCH_PAGE_SCHEMA = (f"decisions array<{DECISION}>, highlighting map<string,struct<documentText:array<string>>>, "
                      "info struct<query:string,page:int,size:int,actualSize:int,total:bigint>")
RECORD_PAGE_SCHEMA = ("content array<struct<referenceNumber:string,organization:struct<key:string>,submissionDate:string>>, "
                      "totalElements bigint, totalPages int, number int, size int")


def binary_files(spark: SparkSession, folder: str, glob: str = "*.json") -> DataFrame:
    """(path, content) of every file below ``folder``."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
            .select("path", "content"))


def typed(files: DataFrame, schema: str) -> DataFrame:
    """(path, sha256 of the exact bytes, doc). Bytes that are no such document give a null doc."""
    doc = F.from_json(F.decode("content", "UTF-8"), schema)
    return once(files, "doc", doc).select("path", F.sha2("content", 256).alias("sha256"), "doc")


def scan_documents(files: DataFrame) -> DataFrame:
    """Every stored act with the hash of its bytes."""
    return typed(files, ACT_SCHEMA)


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)\.json$", 1)


def is_first_capture(path: Column) -> Column:
    """A later capture carries its digest in the name, after a dot."""
    return ~file_stem(path).contains(".")


def scan_records_first_capture(files: DataFrame) -> DataFrame:
    """First captures of procurement records; endpoint and organisation are the two last folders."""
    place = r"/([^/]+)/([^/]+)/[^/]+\.json$"
    return (typed(files.filter(is_first_capture(c("path"))), RECORD_SCHEMA)
            .withColumns({"endpoint": F.regexp_extract("path", place, 1), "org": F.regexp_extract("path", place, 2)})
            .filter(c("endpoint").isin(*fv.ENDPOINTS)))


def scan_decisions_first_capture(files: DataFrame) -> DataFrame:
    """First captures of third-party decisions; the issuer is the last folder."""
    kept = files.filter(is_first_capture(c("path")))
    return typed(kept, DECISION).withColumn("issuer", F.regexp_extract("path", r"/([^/]+)/[^/]+\.json$", 1))


def search_pages(files: DataFrame) -> DataFrame:
    """Search pages with the issuer and the term of their folders."""
    place = r"/([^/]+)/([^/]+)/[^/]+\.json$"
    return typed(files, SEARCH_PAGE_SCHEMA).withColumns({"issuer": F.regexp_extract("path", place, 1), "term": F.regexp_extract("path", place, 2)})


def search_hits(pages: DataFrame) -> DataFrame:
    """(ada, term, issuer) of every record a search kept, in long form; a page is read once."""
    recs = pages.select("issuer", "term", F.explode("doc.decisions").alias("r"))
    return recs.filter(~F.coalesce(c("r.redacted"), F.lit(False))).select(c("r.ada").alias("ada"), "term", "issuer").distinct()


def indexed_keys(pages: DataFrame) -> DataFrame:
    """Keys whose text some page highlights: their text was indexed."""
    marks = pages.select(F.explode(F.map_entries("doc.highlighting")).alias("h"))
    return marks.filter(F.size("h.value.documentText") > 0).select(c("h.key").alias("ada")).distinct()


def search_page_index(pages: DataFrame) -> DataFrame:
    """(ada, terms, issuers, text_indexed). The sets hold search terms and searched issuers, both
    lists we keep ourselves, so they are short whatever the number of pages."""
    hits = search_hits(pages)
    sets = hits.groupBy("ada").agg(F.array_sort(F.collect_set("term")).alias("terms"), F.array_sort(F.collect_set("issuer")).alias("issuers"))
    return (sets.join(indexed_keys(pages).withColumn("_i", F.lit(True)), "ada", "full")
            .select("ada", F.coalesce("terms", F.array().cast("array<string>")).alias("terms"),
                    F.coalesce("issuers", F.array().cast("array<string>")).alias("issuers"), c("_i").isNotNull().alias("text_indexed")))
