"""The registry of bodies, grantors and anchors, and the hand-kept corrections, as frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obolus import fixed_values as fv

ENTITY = ("uid string, name string, afm string, category string, parent string, active_from int, active_to int, approx_acts bigint, "
          "role string, note string, in_scope boolean, reason string")
GRANTOR = "uid string, name string, latin_name string, keep array<string>, grantor_group string, active_from int, active_to int, note string"


def _s(v):
    return None if v is None else str(v)


def _years(raw):
    y = raw.get("active_years") or (None, None)
    return (None, None) if y[0] is None else (int(y[0]), int(y[1]))


def registry(spark: SparkSession, doc: dict) -> dict[str, DataFrame]:
    """Frames ``entity``, ``grantor`` and ``anchor`` of a registry document. An unknown keep rule
    is an error; a grantor without rules or group gets the defaults. ``anchor`` holds the search
    terms whose every hit is about a body of ours: its id, or a code of one of its projects."""
    entities = [(str(e["uid"]), str(e["name"]), _s(e.get("afm")), e.get("category"), _s(e.get("parent")), *_years(e), e.get("approx_acts"),
                 e.get("role"), e.get("note"), scope, e.get("reason"))
                for part, scope in (("in_scope", True), ("out_of_scope", False)) for e in doc.get(part) or []]
    grantors = []
    for g in doc.get("grantors") or []:
        keep = list(g.get("keep") or fv.KEEP_DEFAULT)
        unknown = sorted(set(keep) - set(fv.KEEP_RULES))
        if unknown:
            raise ValueError(f"grantor {g['uid']}: unknown keep rule(s) {unknown}")
        grantors.append((str(g["uid"]), str(g["name"]), g.get("latin_name"), keep, str(g.get("group") or fv.GROUP_DEFAULT), *_years(g), g.get("note")))
    own = [(e[2], e[0]) for e in entities if e[10] and e[2]]
    anchors = own + [(str(a["code"]), str(a["uid"])) for a in doc.get("anchor_codes") or []]
    return {"entity": spark.createDataFrame(entities, ENTITY), "grantor": spark.createDataFrame(grantors, GRANTOR),
            "anchor": spark.createDataFrame(anchors, "term string, uid string")}


def corrections(spark: SparkSession, doc: dict) -> dict[str, DataFrame]:
    """Frames ``mismatch`` (doc, corr_line, corr_amount, corr_kae) and ``duplicate`` (doc, duplicate_of),
    one row per document: of several entries for one the last holds."""
    from decimal import Decimal
    last = lambda part: list({str(e["ada"]): e for e in doc.get(part) or []}.values())
    mismatch = [(str(e["ada"]), e.get("line_no"), None if e.get("metadata_amount") is None else Decimal(str(e["metadata_amount"])), _s(e.get("kae")))
                for e in last("mismatch")]
    duplicate = [(str(e["ada"]), str(e["duplicate_of"])) for e in last("duplicate")]
    return {"mismatch": spark.createDataFrame(mismatch, "doc string, corr_line int, corr_amount decimal(18,2), corr_kae string"),
            "duplicate": spark.createDataFrame(duplicate, "doc string, duplicate_of string")}
