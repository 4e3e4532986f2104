"""Which decision is which: fixed rule tables of grant families, and the categories they land in.

The tables are fixed values on folded subjects, specific before general. Patterns that name the
home body take its folded name (in the genitive) as a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from obolus.fixed_values import W, E
from obolus.functions.text import flat_fold, fold
from obolus.operators.rules import first_match, lookup

_X = r"[\p{L}\p{N}_]*"

# ---- fixed values: families of the ministry's decisions --------------------------------------------
FAMILIES = (
    ("to_regions", "ΕΠΙΧΟΡΗΓΗΣΗ ΤΩΝ ΠΕΡΙΦΕΡΕΙΩΝ|ΣΤΙΣ ΠΕΡΙΦΕΡΕΙΕΣ"),
    ("in_kind", "ΚΕΝΤΡΙΚΗΣ ΕΝΩΣΗΣ ΔΗΜΩΝ"),
    ("kap_transfer_order", "ΕΝΤΟΛΗ ΜΕΤΑΦΟΡΑΣ ΠΙΣΤΩΣΕΩΝ.*ΑΥΤΟΤΕΛ(?:ΕΙΣ|ΩΝ) ΠΟΡ"),
    ("rrf_payment", r"ΕΚΚΑΘΑΡΙΣΗ\s*-\s*ΕΝΤΟΛΗ ΠΛΗΡΩΜΗΣ"),
    ("pde_approval", "^ΧΡΗΜΑΤΟΔΟΤΗΣΗ ΤΟΥ ΔΗΜΟΥ|ΑΠΟΦΑΣΗΣ? ΧΡΗΜΑΤΟΔΟΤΗΣΗΣ|ΑΠΟΦΑΣΗΣ ΕΠΙΧΟΡΗΓΗΣΗΣ|ΑΠΟΡΡΙΜΜΑΤΟΦΟΡ"),
    ("pde_financing", "ΜΕΤΑΦΟΡΑΣ ΠΙΣΤΩΣΕΩΝ|ΚΑΤΑΝΟΜΗ ΧΡΗΜΑΤΟΔΟΤΗΣΗΣ|ΕΝΤΟΛΗ ΧΡΗΜΑΤΟΔΟΤΗΣΗΣ|ΑΙΤΗΜΑ ΧΡΗΜΑΤΟΔΟΤΗΣΗΣ|"
                      f"ΧΡΗΜΑΤΟΔΟΤΗΣΗΣ? ΤΟΥ ΔΗΜΟΥ|{W}(ΣΑΕ|ΣΑΝΑ|ΝΑ ?255){E}"),
    ("programme", "ΦΙΛΟΔΗΜ|ΤΡΙΤΣΗ|ΕΝΤΑΞ|ΠΡΟΣΚΛΗΣ|ΠΡΟΘΕΣΗΣ ΧΡΗΜΑΤΟΔΟΤΗΣΗΣ|ΕΝΤΑΓΜΕΝΩΝ"),
    ("school_cleaners", "ΠΡΟΣΩΠΙΚΟΥ ΚΑΘΑΡΙΟΤΗΤΑΣ"), ("welfare_benefits", "ΠΡΟΝΟΙΑΚ"),
    ("citizen_centres", f"ΚΕΝΤΡΩΝ ΕΞΥΠΗΡΕΤΗΣΗΣ ΠΟΛΙΤΩΝ|{W}ΚΕΠ{E}"), ("school_meals", "ΣΙΤΙΣΗ"),
    ("shore_rents", "ΜΙΣΘΩΜΑΤΑ .*ΚΑΤΕΒΛΗΘΗΣΑΝ|ΑΙΓΙΑΛ"), ("school_rents", "ΚΑΤΑΒΟΛΗ ΜΙΣΘΩΜΑΤΩΝ|ΜΙΣΘΩΜΑΤΩΝ ΤΩΝ ΣΧΟΛΙΚ"),
    ("school_repairs", f"ΣΥΝΤΗΡΗΣΗ{_X} ΣΧΟΛΙΚ"), ("school_operating", "ΣΧΟΛΙΚ|ΣΧΟΛΕΙ"),
    ("home_help", "ΒΟΗΘΕΙΑ ΣΤΟ ΣΠΙΤΙ|ΣΤΗΡΙΞΗΣ ΗΛΙΚΙΩΜΕΝΩΝ"), ("fire_protection", "ΠΥΡΟΠΡΟΣΤΑΣ|ΠΥΡΚΑΓΙ"),
    ("desalination", "ΑΦΑΛΑΤΩΣ"), ("lifeguards", "ΝΑΥΑΓΟΣΩΣΤ"), ("stray_animals", "ΑΔΕΣΠΟΤ"),
    ("road_waste", "ΑΠΟΚΟΜΙΔΗΣ ΑΠΟΡΡΙΜΜΑΤΩΝ ΤΟΥ ΟΔΙΚΟΥ"), ("covid", "ΚΟΡΟΝΟΙ|COVID"),
    ("property_tax", f"ΤΕΛΟΣ ΑΚΙΝΗΤΗΣ ΠΕΡΙΟΥΣΙΑΣ|{W}ΤΑΠ{E}"), ("advertising_fee", "ΤΕΛΟΣ ΔΙΑΦΗΜΙΣΗΣ"), ("beer_tax", "ΖΥΘΟΥ"),
    ("cruise_levy", "ΚΡΟΥΑΖΙΕΡ"), ("election_costs", "ΕΚΛΟΓΙΚ|ΕΚΛΟΓΕΣ|ΕΚΛΟΓΩΝ|ΔΗΜΟΨΗΦΙΣΜ"),
    ("state_debts", "ΠΑΣΗΣ ΦΥΣΕΩΣ ΟΦΕΙΛΩΝ|3756/2009"), ("advance_settlement", "ΣΥΜΨΗΦΙΣΤΙΚ|ΤΑΚΤΟΠΟΙΗΣΗ ΠΡΟΚΑΤΑΒΟΛ"),
    ("arrears", "ΛΗΞΙΠΡΟΘΕΣΜ|ΔΙΑΤΑΓΕΣ ΠΛΗΡΩΜΗΣ|ΔΙΚΑΣΤΙΚ"),
    ("kap_general", "ΑΥΤΟΤΕΛ.*ΛΕΙΤΟΥΡΓΙΚΩΝ ΚΑΙ ΛΟΙΠΩΝ ΓΕΝΙΚΩΝ ΔΑΠΑΝΩΝ"),
    ("kap_investment", f"ΕΠΕΝΔΥΤΙΚ|ΕΚΤΕΛΕΣΗΣ ΕΡΓΩΝ|{W}ΣΑΤΑ{E}"), ("kap_general", f"ΑΥΤΟΤΕΛΕΙΣ ΠΟΡΟΥΣ|ΑΥΤΟΤΕΛΩΝ ΠΟΡΩΝ|{W}ΚΑΠ{E}"),
    ("extraordinary", "ΕΠΙΧΟΡΗΓ"),
)
# ---- fixed values: the region, its fund, and the kinds of other issuers ------------------------------
REGION_FAMILIES = (
    ("region_payment", "^ΕΝΤΑΛΜΑ ΠΛΗΡΩΜΗΣ"), ("region_credit", r"^(?:ΕΓΚΡΙΣΗ|ΔΙΑΘΕΣΗ) ΠΙΣΤΩΣΗΣ [\d.,]+ ?€ ΣΕ ΒΑΡΟΣ"),
    ("region_allocation", r"^ΚΑΤΑΝΟΜΗ ΠΟΣΟΥ [\d.,]+ ?€ (?:ΓΙΑ|ΣΕ ΒΑΡΟΣ)"), ("region_fine", "ΠΡΟΣΤΙΜ|ΚΥΡΩΣΕ"),
    ("region_agreement", f"ΠΡΟΓΡΑΜΜΑΤΙΚ|ΔΙΑΒΑΘΜΙΔΙΚ|{W}ΠΣ (?:ΠΝΑ|ΜΕΤΑΞΥ){E}"),
    ("programme", "ΕΝΤΑΞ|ΕΝΤΑΓΜΕΝ|ΠΡΑΞΗΣ|ΠΡΟΣΚΛΗΣ|ΑΠΟΡΡΙΨ"), ("region_licence", "ΑΔΕΙ|ΥΠΑΓΩΓΗ|ΓΝΩΜΟΔΟΤ|ΠΕΡΙΒΑΛΛΟΝΤΙΚ|ΧΩΡΟΘΕΤΗΣ"),
)
FUND_FAMILIES = (("region_fund_payment", "^ΕΝΤΟΛΗ ΠΛΗΡΩΜΗΣ|ΕΓΚΡΙΣΗΣ ΔΑΠΑΝΗΣ.*ΧΡΗΜΑΤΟΔΟΤΗΣΗ|^ΧΡΗΜΑΤΟΔΟΤΗΣΗ ΤΟΥ ΔΗΜΟΥ"),)
KIND_FAMILIES = {
    "administration": (
        ("supervision", "ΑΠΟΔΟΧΗ (?:ΤΗΣ )?(?:ΧΡΗΜΑΤΟΔΟΤ|ΕΠΙΧΟΡΗΓ)|ΕΠΙΚΥΡΩΣ|ΕΛΕΓΧΟΣ ΝΟΜΙΜΟΤΗΤΑΣ|ΔΙΑΠΙΣΤΩΤΙΚΗ|ΑΝΑΜΟΡΦΩΣΗ|ΚΑΘΙΕΡΩΣΗ"),
        ("own_spending", "ΔΕΣΜΕΥΣΗΣ ΠΙΣΤΩΣΗΣ|ΔΕΣΜΕΥΣΗ ΠΙΣΤΩΣΗΣ"), ("port_fund_balance", f"ΛΙΜΕΝΙΚ{_X} ΤΑΜΕΙ{_X} ΚΥΚΛΑΔΩΝ")),
    "education": (("school_books", "ΞΕΝΟΓΛΩΣΣ"), ("pde_financing", rf"ΧΡΗΜΑΤΟΔΟΤΗΣΗ ΕΡΓΟΥ|{W}ΣΑΕ \d"), ("commitment", "ΑΝΑΛΗΨΗ"), ("programme", "ΠΡΟΘΕΣΗΣ|ΕΝΤΑΞ")),
    "culture": (("commitment", "^ΑΑΥ|ΑΝΑΛΗΨΗ|ΔΕΣΜΕΥΣΗ"), ("culture_grant", "ΕΠΙΧΟΡΗΓ"), ("programme", "ΕΝΤΑΞ")),
    "union": (("ped_payment", "ΕΝΤΑΛΜΑ ΠΛΗΡΩΜΗΣ|^ΠΟΛΙΤΙΣΤΙΚΗ ΧΟΡΗΓΙΑ|^ΧΡΗΜΑΤΟΔΟΤΗΣΗ ΤΟΥ ΔΗΜΟΥ"), ("ped_grant", "ΑΙΤΗΜΑ|ΣΥΝΔΙΟΡΓΑΝΩΣΗ|ΧΟΡΗΓΙΑ")),
    "green_fund": (("green_fund_payment", "ΕΓΚΡΙΣΗ ΔΑΠΑΝΗΣ|ΟΡΙΣΤΙΚΟΥ ΔΙΚΑΙΟΥΧΟΥ|ΑΠΟΔΕΣΜΕΥΣΗΣ ΠΟΣΟΥ"), ("programme", "ΕΝΤΑΞ|ΠΡΟΣΚΛΗΣ|ΧΡΗΜΑΤΟΔΟΤΙΚΟΥ ΠΡΟΓΡΑΜΜΑΤΟΣ|ΠΡΑΚΤΙΚΟΥ")),
    "shipping": (("shipping_payment", r"^ΕΓΚΡΙΣΗ(?!\p{L}).{0,40}ΠΛΗΡΩΜ"), ("pde_authorisation", f"ΕΞΟΥΣΙΟΔΟΤΗΣ{_X} ΠΛΗΡΩΜΗΣ|ΕΝΤΟΛΗ ΚΑΤΑΝΟΜΗΣ ΣΑΕ"), ("shipping_grant", "ΕΠΙΧΟΡΗΓΗΣ"),
                 ("programme", "ΠΡΟΓΡΑΜΜΑΤΙΚ|ΚΛΕΙΣΙΜΟ|ΑΔΕΙΑ|ΣΧΕΔΙΟ ΠΑΡΑΛΑΒΗΣ|ΠΡΑΚΤΙΚΟ|ΜΙΣΘΩΣΗΣ|ΧΑΡΑΚΤΗΡΙΣΜΟΣ")),
    "economy": (("espa_financing", "ΕΡΓΩΝ ΕΣΠΑ$"), ("pde_financing", "ΚΑΤΑΝΟΜΗ ΧΡΗΜΑΤΟΔΟΤΗΣΗΣ|ΧΡΗΜΑΤΟΔΟΤΗΣΗ (?:KAI|ΚΑΙ) (?:KATANOMH|ΚΑΤΑΝΟΜΗ)|^ΚΑΤΑΝΟΜΗ ΣΕ ΒΑΡΟΣ"),
                ("water_bill", f"ΛΟΓΑΡΙΑΣΜ{_X} ΥΔΡΕΥΣΗΣ"), ("commitment", "ΔΕΣΜΕΥΣΗ"), ("programme", "ΕΝΤΑΞ|ΤΡΟΠΟΠΟΙΗΣΗ|ΟΛΟΚΛΗΡΩΣΗ|ΚΑΤΑΝΟΜΗ ΕΡΓΩΝ|ΠΡΑΓΜΑΤΟΓΝΩΜΟΣΥΝ")),
    "infrastructure": (("pde_authorisation", f"ΕΞΟΥΣΙΟΔΟΤΗΣ{_X} ΠΛΗΡΩΜΗΣ|ΑΝΑΚΑΤΑΝΟΜΗ ΠΙΣΤΩΣΕΩΝ"), ("commitment", "ΔΕΣΜΕΥΣΗΣ"), ("programme", "ΕΝΤΑΞ|ΠΡΟΓΡΑΜΜΑΤΙΚ|ΠΡΟΣΚΛΗΣ|ΠΡΟΘΕΣΗΣ")),
    "digital": (("rrf_payment", "ΕΚΚΑΘΑΡΙΣΗ|ΕΝΤΟΛΗ ΠΛΗΡΩΜΗΣ"),),
    "tourism_organisation": (("eot_payment", "ΕΞΟΦΛΗΣΗ|ΟΦΕΙΛΕΣ ΠΡΟΗΓΟΥΜΕΝΩΝ ΕΤΩΝ"), ("commitment", "ΟΦΕΙΛΗ|ΔΕΣΜΕΥΣΗ")),
    "tourism": (("tourism_grant", "ΧΡΗΜΑΤΟΔΟΤΗΣ|ΕΠΙΧΟΡΗΓ|ΕΝΤΑΞ"),),
}


#: Kinds of bodies a foundation also gives to; a registry adds their own names.
FOUNDATION_OTHERS = ("ΜΗΤΡΟΠΟΛ", "ΜΟΝΑΔΑ ΦΡΟΝΤΙΔΑΣ", "ΚΑΛΩΝ ΤΕΧΝΩΝ", "ΑΠΟΣΤΟΛΙΚΗ")


def foundation_families(home: str, others: tuple[str, ...] = FOUNDATION_OTHERS) -> tuple[tuple[str, str], ...]:
    """A foundation's families; ``home`` is the home body's name as its subjects decline it, ``others`` patterns
    of the other bodies it gives to."""
    return (
        ("foundation_water_bill", "ΥΔΡΕΥΣ|ΝΕΡΟΥ|ΑΠΟΧΕΤΕΥΣ|ΚΟΙΝΟΧΡΗΣΤ|ΤΕΛ(?:Η|ΩΝ) ΑΚΙΝΗΤΟΥ"),
        # its grants to other bodies stand before its statutory one to the home body
        ("foundation_to_others", rf"^(?!.*ΔΗΜΟ)(?=.*(?:{'|'.join(others)}))"),
        ("foundation_statutory_grant", rf"ΤΑΚΤΙΚ{_X} (?:ΕΤΗΣΙΑΣ )?ΕΠΙΧΟΡΗΓ|ΘΕΣΜΟΘΕΤΗΜΕΝ|ΝΟΜΟΘΕΤΗΜΕΝ|ΕΤΗΣΙΑΣ ΕΠΙΧΟΡΗΓ|10% ΕΠΙ|ΕΠΙΧΟΡΗΓΗΣ{_X} ΔΗΜΟΥ {home} ΓΙΑ ΕΤΟΣ"),
        ("foundation_grant", "ΕΠΙΧΟΡΗΓ|ΚΑΤΑΒΟΛΗΣ? ΠΟΣ|ΕΙΣΦΟΡ"), ("in_kind", "ΧΡΗΣΙΔΑΝΕΙ"),
    )


# ---- fixed values: the revenue line each family arrives in (none: listed, not counted) -----------------
CATEGORY_OF_FAMILY = {
    "kap_general": "kap_general", "kap_investment": "kap_investment", "school_operating": "kap_schools", "school_rents": "school_rents",
    "school_repairs": "school_repairs", "fire_protection": "fire_protection", "school_cleaners": "school_cleaners", "home_help": "home_help",
    "desalination": "kap_other", "road_waste": "kap_other", "covid": "kap_other", "citizen_centres": "kap_other", "school_meals": "kap_other",
    "welfare_benefits": "welfare", "extraordinary": "state_grants", "arrears": "state_grants", "state_debts": "kap_other", "kap_supplementary": "kap_other",
    "lifeguards": "state_grants", "stray_animals": "kap_other", "election_costs": "state_grants", "cruise_levy": "state_grants",
    "pde_financing": "investment_programmes", "advertising_fee": "advertising_fee", "property_tax": "property_tax", "region_credit": "investment_programmes",
    "region_agreement_payment": "programme_agreements", "region_agreement_commitment": "programme_agreements", "region_fund_agreement_payment": "programme_agreements",
    "region_fund_payment": "investment_programmes", "foundation_statutory_grant": "foundation_contribution", "school_books": "state_grants",
    "ped_payment": "state_grants", "ped_grant": "state_grants", "green_fund_payment": "investment_programmes", "shipping_payment": "investment_programmes",
    "pde_authorisation": "investment_programmes", "rrf_payment": "recovery_fund", "eot_payment": "state_grants",
}
CATEGORY_BY_YEAR = {
    ("home_help", 2015): "kap_other", ("home_help", 2016): "kap_other", ("desalination", 2015): "state_grants", ("covid", 2020): "state_grants",
    ("covid", 2021): "state_grants", ("stray_animals", 2020): "state_grants", ("school_cleaners", 2020): "state_grants",
    ("school_cleaners", 2021): "state_grants", ("school_cleaners", 2022): "state_grants",
}
# ---- fixed values: what a document's text says of its family -------------------------------------------
REGION_PURPOSE = r"ΓΙΑ:\s*(.{3,240}?)\s+ΕΝΤΕΛΛΟΜΕΝΟ ΠΟΣΟ"
UTILITY = "ΥΔΡΕΥΣ|ΑΡΔΕΥΣ|ΑΔΡΕΥΣ|ΑΠΟΧΕΤΕΥΣ|ΥΔΡΟΜΕΤΡ|ΚΑΤΑΝΑΛΩΣΗ ΝΕΡΟΥ"
TRANSFERRED_TO = "ΜΕΤΑΒΙΒΑΣΤΕΙ ΣΤΟ[ΝΙ]? (.{0,200})"
DEVELOPMENT_FUND = r"^(?:Π\.? ?Τ\.? ?Α\.?|ΠΕΡΙΦΕΡΕΙΑΚΟ ΤΑΜΕΙΟ ΑΝΑΠΤΥΞΗΣ)"
UNION_OWN_SPENDING = rf"ΣΥΝΔΙΟΡΓΑΝΩΣ|ΠΡΩΤΟΓΕΝ{_X} ΑΙΤΗΜΑ"
ARREARS_CEILING = f"ΕΝΤΟΛ{_X} ΕΞΟΦΛΗΣΗΣ|ΚΑΘΑΡΟΥ ΠΟΣΟΥ ΠΡΟΣ ΤΟΥΣ ΤΕΛΙΚΟΥΣ ΔΙΚΑΙΟΥΧΟΥΣ"
REVENUE_CATEGORIES = (
    ("kap_general", "ΚΑΠ ΓΙΑ (?:ΤΗΝ )?ΚΑΛΥΨΗ ΓΕΝΙΚΩΝ"), ("kap_investment", "ΚΑΠ ΕΠΕΝΔΥΤΙΚΩΝ|ΚΑΠ ΓΙΑ ΕΠΕΝΔΥΤΙΚΕΣ"), ("kap_schools", "ΚΑΠ ΓΙΑ ΤΗΝ ΚΑΛΥΨΗ ΤΩΝ ΛΕΙΤΟΥΡΓΙΚΩΝ"),
    ("school_rents", "ΚΑΠ ΓΙΑ ΤΗΝ ΚΑΤΑΒΟΛΗ ΜΙΣΘΩΜΑΤΩΝ"), ("school_repairs", "ΕΠΙΣΚΕΥΗ ΚΑΙ ΣΥΝΤΗΡΗΣΗ ΣΧΟΛΙΚΩΝ"), ("fire_protection", "ΠΥΡΟΠΡΟΣΤΑΣΙΑ"),
    ("school_cleaners", "ΜΙΣΘΟΔΟΣΙΑΣ ΠΡΟΣΩΠΙΚΟΥ ΚΑΘΑΡΙΟΤΗΤΑΣ"), ("home_help", "ΒΟΗΘΕΙΑ ΣΤΟ ΣΠΙΤΙ"), ("kap_other", "ΚΑΠ ΓΙΑ ΛΟΙΠΟΥΣ ΣΚΟΠΟΥΣ"), ("welfare", "ΠΡΟΝΟΙΑΚ"),
    ("investment_programmes", "ΘΗΣΕΑΣ|ΦΙΛΟΔΗΜΟΣ|ΕΙΔΙΚΑ ΠΡΟΓΡΑΜΜΑΤΑ|ΚΕΝΤΡΙΚΟΥΣ ΦΟΡΕΙΣ|ΛΟΙΠΕΣ ΕΠΙΧΟΡΗΓΗΣΕΙΣ ΓΙΑ ΕΠΕΝΔΥΣΕΙΣ|ΕΘΝΙΚΟΥ ΤΜΗΜΑΤΟΣ ΤΟΥ ΠΔΕ"),
    ("advertising_fee", "^ΤΕΛΟΣ ΔΙΑΦΗΜΙΣΗΣ.*ΚΑΤΗΓΟΡΙΑΣ Δ|^ΔΗΜΟΤΙΚΑ ΤΕΛΗ ΔΙΑΦΗΜΙΣΗΣ"), ("property_tax", "^(?:ΔΗΜΟΤΙΚΟ )?ΤΕΛΟΣ ΑΚΙΝΗΤΗΣ ΠΕΡΙΟΥΣΙΑΣ"),
    ("programme_agreements", "ΠΡΟΓΡΑΜΜΑΤΙΚΕΣ ΣΥΜΒΑΣΕΙΣ"), ("recovery_fund", "ΤΑΜΕΙΟ ΑΝΑΚΑΜΨΗΣ"),
)
STATE_GRANT_CODES = ("1211", "1215", "1219")
FIXED_CODES = {"2119": "foundation_contribution"}
NEW_CHART_CATEGORIES = {"1310114": "state_grants", "1310189": "state_grants", "1310489": "programme_agreements", "1340101": "investment_programmes",
                        "1340102": "investment_programmes", "1340105": "investment_programmes", "1340189": "investment_programmes"}


def family_of(subject: Column, kind: Column, home: str = "", others: tuple[str, ...] = FOUNDATION_OTHERS) -> Column:
    """Family of a decision by the kind of its issuer: the fund and the region have their own sets and
    nothing else; other kinds try their own set first, and only the administration and the
    ministry (any other kind) fall back on the ministry's."""
    return family_of_folded(fold(subject), kind, home, others)


def family_of_folded(s: Column, kind: Column, home: str = "", others: tuple[str, ...] = FOUNDATION_OTHERS) -> Column:
    """``family_of`` of a subject that is folded already, and computed once."""
    ministry = first_match(s, FAMILIES, "other")
    out = F.when(kind == "region_fund", first_match(s, FUND_FAMILIES, "other")).when(kind == "region", first_match(s, REGION_FAMILIES, "other"))
    for name, rules in {**KIND_FAMILIES, "foundation": foundation_families(home, others)}.items():
        own = first_match(s, rules)
        out = out.when(kind == name, F.coalesce(own, ministry if name == "administration" else F.lit("other")))
    return out.otherwise(ministry)


def refine_family(family: Column, text: Column) -> Column:
    """An arrears grant its document pays to the creditors is a ceiling."""
    return F.when((family == "arrears") & flat_fold(text).rlike(ARREARS_CEILING), F.lit("arrears_ceiling")).otherwise(family)


def refine_region(family: Column, text: Column, fund_id: str | None = None) -> Column:
    """What a region's document says of its family. A payment order's purpose: a utility bill is a sale
    of the home body's, a payment under a programme agreement counts as one. A credit transferred
    to the development fund (by name, or its id ``fund_id``) is counted where the fund pays."""
    return refine_region_flat(family, flat_fold(text), fund_id)


def refine_region_flat(family: Column, flat: Column, fund_id: str | None = None) -> Column:
    """``refine_region`` of a text that is folded already."""
    purpose, to = F.regexp_extract(flat, REGION_PURPOSE, 1), F.regexp_extract(flat, TRANSFERRED_TO, 1)
    fund = DEVELOPMENT_FUND + (f"|{fund_id}" if fund_id else "")
    return (F.when((family == "region_payment") & purpose.rlike(UTILITY), F.lit("region_utility_payment"))
            .when((family == "region_payment") & purpose.contains("ΠΡΟΓΡΑΜΜΑΤΙΚ"), F.lit("region_agreement_payment"))
            .when((family == "region_credit") & to.rlike(fund), F.lit("region_credit_via_fund")).otherwise(family))


def refine_union(family: Column, subject: Column) -> Column:
    """A union's grant for what it co-organises or procures itself is its own spending."""
    return F.when((family == "ped_grant") & fold(subject).rlike(UNION_OWN_SPENDING), F.lit("ped_own_spending")).otherwise(family)


def own_credit(family: Column, own: Column, read_as: Column, has_document: Column) -> Column:
    """A credit for the region's own project (``own``: no body of ours is named or found) is not ours unless
    its document, read, still says it is. ``read_as``: the family after reading."""
    return F.when(own & (~has_document | (read_as != "region_credit")), F.lit("region_own_credit")).otherwise(read_as)


def category_of(family: Column, year: Column) -> Column:
    """The revenue category of a family's money in a budget year; null when it is only listed."""
    by_year = lookup(F.concat_ws("/", family, year.cast("string")), {f"{f}/{y}": v for (f, y), v in CATEGORY_BY_YEAR.items()})
    return F.coalesce(by_year, lookup(family, CATEGORY_OF_FAMILY))


def revenue_category(code: Column, description: Column) -> Column:
    from obolus.plans.documents import revenue_category as of
    return of(code, description, NEW_CHART_CATEGORIES, REVENUE_CATEGORIES, STATE_GRANT_CODES, FIXED_CODES)


def recipient_of(subject: Column, bodies: tuple[tuple[str, str], ...], home: str) -> Column:
    """The body a grant goes to: the first whose pattern the subject meets, else the home body."""
    return first_match(fold(subject), bodies, home)
