"""Word lists, patterns, codes and thresholds that decide results.

Patterns run on folded text unless a comment says otherwise. ``{W}`` marks a letter
boundary on the left, ``{E}`` one on the right. Nothing in here is logic.
"""

from __future__ import annotations

from obolus.functions.text import LETTER_END, LETTER_START, word

W, E = LETTER_START, LETTER_END

# ---- fixed values: the registers -------------------------------------------------------
PAYMENT_TYPES = ("Β.2.2",)
COMMITMENT_TYPES = ("Β.1.3",)
AWARD_TYPES = ("Δ.1", "Δ.2.2")
STATEMENT_TYPE = "Β.3"
MEASURE_STATUSES = ("PUBLISHED", "REVOKED")
MASK = "φυσικό πρόσωπο"
CIVIL_ZONE = "Europe/Athens"
ENDPOINTS = ("request", "notice", "auction", "contract", "payment")
DIRECT_AWARD_PREFIX = "Απευθείας"

# ---- fixed values: shapes of identifiers -------------------------------------------------
KEY_SHAPES = {
    "decision": r"^[0-9Α-Ω]+-[0-9Α-Ω]+$",
    "organisation": r"^\d+$",
    "procurement": r"^[0-9A-Z]{6,40}$",
    "term": r"^[0-9Α-ΩA-Z]{2,40}$",
}
CITED_KEY = r"(?<![0-9Α-Ω])[0-9Α-Ω]{4,10}-[0-9Α-Ω]{3}(?![0-9Α-Ω])"
TAX_ID = r"^\d{9}$"

# ---- fixed values: echoed query of a search ----------------------------------------------
ECHO_BOUNDS = r"issueDate:\[DT\(([^)]*)\) TO DT\(([^)]*)\)\]"
ECHO_ORG = r'organizationUid:"([^"]*)"'
ECHO_STATUS = r'status:"([^"]*)"'
ECHO_PUBLISHED = "Αναρτημένη"

# ---- fixed values: budget codes ---------------------------------------------------------
CODE_OLD = r"^(\d{2})[.\-](\d{4})"
CODE_BARE = r"^(\d{4})(\.\d+)?$"
CODE_NEW = r"^\d{3}\.(\d{7})"
REMITTANCE_MAJOR = "82"
REMITTANCE_MAJOR_NEW = "59"
PERSONNEL_MAJOR = {"old": "60", "bare": "60", "new": "21"}
TAX_MAJOR, DEBT_MAJOR = "63", "65"

# ---- fixed values: payments --------------------------------------------------------------
SUSPECT_ABOVE = 10_000_000
PROPAGATION_SHARE = 0.8
NON_SUPPLIER = ("remittance", "tax", "debt_service", "other_public_body")
PAYEE_CLASSES = ("payroll", "internal_transfer", "remittance", "tax", "debt_service", "other_public_body", "supplier")
NEARBY_DAYS = 60

# on text without accents, upper case
REVERSAL = "ΑΝΑΤΡΟΠ|ΑΝΑΚΛΗΣ"
WITHHOLDING = "ΚΡΑΤΗΣ"
PAYROLL_SUBJECT = "ΜΙΣΘΟΔΟΣ|ΑΠΟΔΟΧ|ΥΠΕΡΩΡΙ"
BATCH_NAME = rf"(&|(?<![\p{{L}}\p{{N}}_])ΚΑΙ)\s*ΛΟΙΠ(ΟΙ|ΕΣ|ΩΝ)"
PERSON_FORM = ",,"
IMPREST = "ΥΠΟΛΟΓΟΣ"
LEGAL_FORM = (
    word(r"ΟΕ|Ο\.Ε\.?|ΕΕ|Ε\.Ε\.?|ΑΕ|Α\.Ε\.?|ΑΕΒΕ|ΑΒΕΕ|ΑΤΕ|ΟΕΕ|ΕΠΕ|Ε\.Π\.Ε\.?|ΙΚΕ|Ι\.Κ\.Ε\.?|ΜΕΠΕ|ΝΕ|ΝΕΠΑ|"
         r"LTD|LIMITED|INC|GMBH|SA|S\.A\.?|A\.E\.?|PLC|LLC|ΑΦΟΙ|ΣΙΑ|ΜΟΝΗ|ΝΑΟΣ|ΔΗΜΟΣ|ΤΑΜΕΙΟ|ΕΝΩΣΗ|ΚΕΝΤΡΟ|ΟΜΙΛΟΣ")
    + r"|ΜΟΝΟΠΡΟΣΩΠ|ΕΤΑΙΡ|ΣΥΝΕΤΑΙΡ|ΕΠΙΧΕΙΡΗΣ|ΟΡΓΑΝΙΣΜ|ΙΔΡΥΜΑ|ΣΩΜΑΤΕΙ|ΣΥΛΛΟΓ|ΥΠΟΥΡΓΕΙ|ΚΟΙΝΟΠΡΑΞ|ΚΟΙΝΩΝΙΑ|ΑΣΤΙΚΗ|"
      r"ΕΚΚΛΗΣ|ΣΥΝΔΕΣΜ|ΙΝΣΤΙΤΟΥΤ|ΣΥΝΔΙΚ|ΕΠΙΜΕΛΗΤ|ΤΡΑΠΕΖ|BANK|ΤΕΧΝΙΚ|ΚΑΤΑΣΚΕΥ|ΕΜΠΟΡ|ΒΙΟΤΕΧΝ|ΒΙΟΜΗΧΑΝ|SOLUTIONS|"
      r"SERVICES?|CONSULT|SYSTEMS?|GROUP|ΠΑΝΕΠΙΣΤΗΜ|UNIVERSIT|ΕΠΙΤΡΟΠ|ΣΧΟΛ|ΔΙΚΤΥΟ|ΕΡΓΑΣΤΗΡ|ΞΕΝΟΔΟΧ|ΓΡΑΦΕΙ|ΦΑΡΜΑΚΕΙ"
)
TAX_PAYEE = r"ΥΠΟΥΡΓΕΙΟ ΟΙΚΟΝΟΜ|ΑΑΔΕ|ΑΝΕΞΑΡΤΗΤΗ ΑΡΧΗ ΔΗΜΟΣΙΩΝ ΕΣΟΔΩΝ|ΦΟΡΟΛΟΓ|ΤΕΛΩΝΕΙ|" + word(r"Δ\.?Ο\.?Υ")
TAX_SUBJECT = "ΕΝΦΙΑ|ΦΟΡΟΣ ΕΙΣΟΔ|ΦΟΡΟΥ? ΤΟΚΩΝ"
DEBT_PAYEE = "ΤΡΑΠΕΖ|" + word("BANK") + "|ΠΑΡΑΚΑΤΑΘΗΚ|" + word("ALPHA") + "|EUROBANK"
PUBLIC_BODY = (
    r"ΔΗΜΟΣ |ΔΗΜΟΤΙΚ|ΠΕΡΙΦΕΡΕΙ|ΥΠΟΥΡΓΕΙ|ΦΟΔΣΑ|ΦΟ\.Δ\.Σ\.Α|ΛΙΜΕΝΙΚΟ ΤΑΜΕΙΟ|ΟΡΓΑΝΙΣΜΟΣ ΛΙΜΕΝ|ΡΥΘΜΙΣΤΙΚΗ ΑΡΧΗ|"
    rf"ΕΦΚΑ|ΕΘΝΙΚΟΣ ΦΟΡΕΑΣ ΚΟΙΝ|{word('ΙΚΑ')}|ΤΑΜΕΙΟ ΠΡΟΝΟΙΑΣ|ΟΠΑΔ|ΤΕΑΔΥ|ΤΑΔΚΥ|ΤΥΔΚΥ|ΤΠΔΥ|ΤΠΔΚΥ|ΜΤΠΥ|"
    r"ΕΤΑΑ|ΤΜΕΔΕ|ΤΣΜΕΔΕ|ΕΑΔΗΣΥ|Ε\.Α\.ΔΗ\.ΣΥ|ΕΝΙΑΙΑ ΑΡΧΗ ΔΗΜΟΣΙΩΝ ΣΥΜΒΑΣΕΩΝ|ΟΑΕΔ|ΔΥΠΑ|ΕΟΠΥΥ|"
    r"ΚΕΔΕ|ΕΕΤΑΑ|ΑΠΟΚΕΝΤΡΩΜΕΝ|ΕΛΛΗΝΙΚΟ ΔΗΜΟΣΙΟ|ΟΡΓΑΝΙΣΜΟΣ ΠΕΡΙΘΑΛΨ|ΝΟΣΟΚΟΜΕΙ|ΚΕΝΤΡΟ ΥΓΕΙΑΣ|ΠΑΝΕΠΙΣΤΗΜΙ|"
    r"ΣΧΟΛΙΚΗ ΕΠΙΤΡΟΠ|ΚΟΙΝΩΦΕΛΗΣ ΕΠΙΧΕΙΡΗΣΗ|ΑΝΑΠΤΥΞΙΑΚ[\p{L}\p{N}_]* ΟΡΓΑΝΙΣΜ|ΠΟΛΕΜΙΚΟΥ ΝΑΥΤΙΚΟΥ|ΕΠΙΜΕΛΗΤΗΡΙ|ΕΝΩΣΗ ΛΙΜΕΝΩΝ|"
    rf"ΚΤΗΜΑΤΟΛΟΓ|ΕΛ\.?Γ\.?Α{E}|ΑΣΦΑΛΙΣΤΙΚ[\p{{L}}\p{{N}}_]* ΤΑΜΕΙ|ΤΑΜΕΙΟ [\p{{L}}\p{{N}}_]*ΑΣΦΑΛ|ΕΘΝΙΚΟ ΚΕΝΤΡΟ|ΓΕΝΙΚΟ ΛΟΓΙΣΤΗΡΙΟ|"
    r"ΕΛΛΗΝΙΚΗ ΑΣΤΥΝΟΜ|ΠΥΡΟΣΒΕΣΤΙΚ|ΛΙΜΕΝΑΡΧΕΙ|ΕΙΡΗΝΟΔΙΚΕΙ|ΠΡΩΤΟΔΙΚΕΙ|ΔΙΚΑΣΤΗΡΙ"
)

# ---- fixed values: amounts and number words ------------------------------------------------
AMOUNT_EU = r"-?\d{1,3}(?:\.\d{3})*,\d{2}"
AMOUNT_EN = r"-?(?:\d{1,3}(?:,\d{3})*)?\.\d{2}"
AMOUNT_IN_STATEMENT = rf"(?<!\d){AMOUNT_EU}(?![\d%])"
AMOUNT_IN_LINE = rf"(?<![\d.,]){AMOUNT_EU}(?![\d%])"
AMOUNT_IN_LINE_EN = rf"(?<![\d.,]){AMOUNT_EN}(?![\d%])"
COLUMN_TOKEN = rf"(?<![\d.,])(?:{AMOUNT_EU}(?![\d%])|\d[\d.]*,\d{{2}}(?![\d%])|-(?=\s*€))"
NUMBER_UNITS = {
    "ΜΗΔΕΝ": 0, "ΕΝΑ": 1, "ΕΝΑΣ": 1, "ΕΝΟΣ": 1, "ΜΙΑ": 1, "ΜΙΑΣ": 1, "ΜΙΑΝ": 1, "ΔΥΟ": 2,
    "ΤΡΙΑ": 3, "ΤΡΕΙΣ": 3, "ΤΡΙΩΝ": 3, "ΤΕΣΣΕΡΑ": 4, "ΤΕΣΣΕΡΙΣ": 4, "ΤΕΣΣΑΡΩΝ": 4, "ΠΕΝΤΕ": 5,
    "ΕΞΙ": 6, "ΕΞ": 6, "ΕΠΤΑ": 7, "ΕΦΤΑ": 7, "ΟΚΤΩ": 8, "ΟΧΤΩ": 8, "ΕΝΝΕΑ": 9, "ΕΝΝΙΑ": 9,
    "ΔΕΚΑ": 10, "ΕΝΤΕΚΑ": 11, "ΔΩΔΕΚΑ": 12, "ΔΕΚΑΤΡΙΑ": 13, "ΔΕΚΑΤΡΙΩΝ": 13, "ΔΕΚΑΤΡΕΙΣ": 13,
    "ΔΕΚΑΤΕΣΣΕΡΑ": 14, "ΔΕΚΑΤΕΣΣΑΡΩΝ": 14, "ΔΕΚΑΤΕΣΣΕΡΙΣ": 14, "ΔΕΚΑΠΕΝΤΕ": 15, "ΔΕΚΑΕΞΙ": 16,
    "ΔΕΚΑΕΞ": 16, "ΔΕΚΑΞΙ": 16, "ΔΕΚΑΕΠΤΑ": 17, "ΔΕΚΑΕΦΤΑ": 17, "ΔΕΚΑΟΚΤΩ": 18, "ΔΕΚΑΟΧΤΩ": 18,
    "ΔΕΚΑΕΝΝΕΑ": 19, "ΔΕΚΑΕΝΝΙΑ": 19, "ΕΙΚΟΣΙ": 20, "ΤΡΙΑΝΤΑ": 30, "ΣΑΡΑΝΤΑ": 40, "ΠΕΝΗΝΤΑ": 50,
    "ΕΞΗΝΤΑ": 60, "ΕΒΔΟΜΗΝΤΑ": 70, "ΟΓΔΟΝΤΑ": 80, "ΕΝΕΝΗΝΤΑ": 90, "ΕΚΑΤΟ": 100, "ΕΚΑΤΟΝ": 100,
}
NUMBER_HUNDREDS = {
    "ΔΙΑΚΟΣΙ": 200, "ΤΡΙΑΚΟΣΙ": 300, "ΤΕΤΡΑΚΟΣΙ": 400, "ΠΕΝΤΑΚΟΣΙ": 500, "ΕΞΑΚΟΣΙ": 600, "ΕΠΤΑΚΟΣΙ": 700,
    "ΕΦΤΑΚΟΣΙ": 700, "ΟΚΤΑΚΟΣΙ": 800, "ΟΧΤΑΚΟΣΙ": 800, "ΕΝΝΙΑΚΟΣΙ": 900, "ΕΝΝΕΑΚΟΣΙ": 900,
}
NUMBER_OTHER = ("ΧΙΛΙΑΔΕΣ", "ΧΙΛΙΑΔΩΝ", "ΧΙΛΙΑ", "ΧΙΛΙΩΝ", "ΕΥΡΩ", "ΛΕΠΤΑ", "ΛΕΠΤΩΝ", "ΛΕΠΤΟ", "ΚΑΙ",
                "ΕΚΑΤΟΜΜΥΡΙΟ", "ΕΚΑΤΟΜΜΥΡΙΑ", "ΕΚΑΤΟΜΜΥΡΙΩΝ")
HUNDRED_ENDINGS = ("Α", "ΕΣ", "ΩΝ", "ΟΙ", "ΟΥΣ")
# a shifted font prints Τ as Η, Σ as Ζ or Ρ, Ρ as Π
FONT_SHIFT = {"Η": "ΗΤ", "Ζ": "ΖΣ", "Π": "ΠΡ", "Ρ": "ΡΣ"}
MONTHS = ("Ιανουάριος", "Φεβρουάριος", "Μάρτιος", "Απρίλιος", "Μάιος", "Ιούνιος",
          "Ιούλιος", "Αύγουστος", "Σεπτέμβριος", "Οκτώβριος", "Νοέμβριος", "Δεκέμβριος")
ROUNDING_CENTS = 10
BUDGET_YEAR = r"(?:ΕΤΟΥΣ|ΕΤΟΣ|ΚΑΠ)\s+(20[12]\d)(?!\s*[-–/]\s*(?:20)?\d\d)"

# ---- fixed values: acceptances of other bodies' money ----------------------------------------
ACCEPT = r"ΑΠΟΔΟΧ(?:Η|ΗΣ)(?![Α-Ω])"
ACCEPT_MONEY = "ΧΡΗΜΑΤΟΔΟΤ|ΕΠΙΧΟΡΗΓ|ΠΟΣΟΥ|ΠΙΣΤΩΣ|ΚΑΤΑΝΟΜ|ΧΡΗΜΑΤΙΚ"
ACCEPT_DONATION = r"ΔΩΡΕΑ[\p{L}\p{N}_]* (?:ΠΟΣΟΥ|ΧΡΗΜΑΤ)|ΧΡΗΜΑΤΙΚΗΣ ΔΩΡΕΑΣ"
ACCEPT_NOT_MONEY = (r"ΟΡΩΝ ΣΥΜΜΕΤΟΧΗΣ|ΟΡΟΥ 10|ΔΑΝΕΙ|ΠΑΡΑΙΤΗΣ|ΚΛΗΡΟΝΟΜ|ΤΜΗΜΑΤΙΚΗΣ ΚΑΤΑΒΟΛΗΣ|"
                    r"ΑΠΟΔΟΧΗ (?:ΤΗΣ )?(?:ΑΠΟΦΑΣΗΣ |1ΗΣ ΤΡΟΠΟΙΗΣΗΣ ΤΗΣ ΠΡΑΞΗΣ )?ΕΝΤΑΞΗΣ")
ACCEPT_AMOUNT = r"(?<![\d.,])\d{1,3}(?:\.\d{3})*,\d{2}(?!\d)"
ACCEPT_AMENDMENT = (r"^(?:ΕΓΚΡΙΣΗ|ΕΙΣΗΓΗΣΗ ΣΧΕΔΙΟΥ) (?:ΤΗΣ )?\d+[\p{L}\p{N}_]* ΑΝΑΜΟΡΦΩΣ|^ΕΓΚΡΙΣΗ ΤΗΣ ΜΕ ΑΡΙΘΜΟ|"
                    r"^ΤΡΟΠΟΠΟΙΗΣΗ")
ACCEPT_PROPOSAL = "^ΕΙΣΗΓΗΣΗ"
ACCEPT_GRANTORS = (
    ("ped", r"ΠΕΡΙΦΕΡΕΙΑΚΗ ΕΝΩΣΗ ΔΗΜΩΝ|ΠΕΡΙΦΕΡΕΙΑ ΕΝΩΣΗΣ ΔΗΜΩΝ|(?<![Α-Ω])ΠΕΔ(?![Α-Ω])"),
    ("green_fund", "ΠΡΑΣΙΝΟ ΤΑΜΕΙΟ|ΠΡΑΣΙΝΟΥ ΤΑΜΕΙΟΥ|ΠΕΡΙΒΑΛΛΟΝΤΙΚΟΥ ΙΣΟΖΥΓΙΟΥ|ΑΣΤΙΚΗ ΑΝΑΖΩΟΓΟΝΗΣΗ"),
    ("shipping", "ΝΑΥΤΙΛΙΑΣ|ΝΗΣΙΩΤΙΚΗΣ ΠΟΛΙΤΙΚΗΣ"),
    ("infrastructure", "ΥΠΟΔΟΜΩΝ ΚΑΙ ΜΕΤΑΦΟΡΩΝ"),
    ("digital", "ΨΗΦΙΑΚΗΣ ΔΙΑΚΥΒΕΡΝΗΣΗΣ"),
    ("tourism", "ΥΠΟΥΡΓΕΙΟ ΤΟΥΡΙΣΜΟΥ"),
    ("economy", "ΟΙΚΟΝΟΜΙΑΣ|ΑΝΑΠΤΥΞΙΑΚΟ ΠΡΟΓΡΑΜΜΑ ΕΙΔΙΚΟΥ ΣΚΟΠΟΥ|ΕΥΡΩΠΑΙΚΟ ΤΑΜΕΙΟ ΠΕΡΙΦΕΡΕΙΑΚΗΣ"),
    ("education", "ΠΑΙΔΕΙΑΣ"),
    ("culture", "ΥΠΟΥΡΓΕΙΟ ΠΟΛΙΤΙΣΜΟΥ"),
    ("region", r"ΠΕΡΙΦΕΡΕΙΑΣ ΝΟΤΙΟΥ ΑΙΓΑΙΟΥ|ΠΕΡΙΦΕΡΕΙΑ Ν\.? ?ΑΙΓΑΙΟΥ|ΠΕΡΙΦΕΡΕΙΑ ΝΟΤΙΟΥ|ΝΟΤΙΟ ΑΙΓΑΙΟ"),
    ("interior", r"ΥΠΕΣ|ΥΠΟΥΡΓΕΙΟ ΕΣΩΤΕΡΙΚΩΝ|(?<![Α-Ω])Κ\.?Α\.?Π(?![Α-Ω])|ΦΙΛΟΔΗΜΟΣ|ΤΡΙΤΣΗΣ|ΕΚΛΟΓΙΚ|ΝΑΥΑΓΟΣΩΣΤ|"
                 r"ΒΟΗΘΕΙΑ ΣΤΟ ΣΠΙΤΙ|ΣΑΕ ?055|ΘΕΟΜΗΝΙ|ΚΟΡΟΝΟΙ|ΑΔΕΣΠΟΤ|ΣΤΗΡΙΞΗΣ ΗΛΙΚΙΩΜΕΝΩΝ|ΙΔΟΧ|ΞΕΝΟΓΛΩΣΣ"),
    ("eu", r"HORIZON|ΟΡΙΖΟΝΤΑΣ 2020|(?<![Α-Ω])LIFE(?![Α-Ω])|WIFI4EU|ΣΥΝΔΕΟΝΤΑΣ ΤΗΝ ΕΥΡ"),
    ("kede", "(?<![Α-Ω])ΚΕΔΕ(?![Α-Ω])"),
    ("private", r"ΟΜΙΛΟ ΕΤΑΙΡΕΙΩΝ|ΣΩΜΑΤΕΙ|ΚΛΗΡΟΔΟΤΗΜ|(?<![Α-Ω])Κ\.Κ\.|ΣΥΛΛΟΓΟΥ"),
)

# ---- fixed values: what a search may keep ------------------------------------------------------
KEEP_RULES = ("grant_words", "investment_acts", "own_body", "statutory_grant")
KEEP_DEFAULT = ("grant_words", "investment_acts", "own_body")
GROUP_DEFAULT = "interior"
GRANT_ACT_TYPES = ("Β.1.1",)
GRANT_WORDS = "|".join([
    "ΚΑΤΑΝΟΜ", "ΑΠΟΔΟΣ[ΗΕ]", "ΕΠΙΧΟΡΗΓ", "ΧΡΗΜΑΤΟΔΟΤ", "ΑΥΤΟΤΕΛ(?:ΕΙΣ|ΩΝ) ΠΟΡ", word("ΚΑΠ|ΣΑΤΑ"),
    "ΦΙΛΟΔΗΜ", "ΤΡΙΤΣΗ", "ΕΝΤΑΞ", "ΠΙΣΤΩΣ", "ΒΟΗΘΕΙΑ ΣΤΟ ΣΠΙΤΙ",
])
STATUTORY_GRANT = (r"ΤΑΚΤΙΚ[\p{L}\p{N}_]* (?:ΕΤΗΣΙΑΣ )?(?:ΟΙΚΟΝΟΜΙΚ[\p{L}\p{N}_]* )?ΕΠΙΧΟΡΗΓ|"
                   r"ΘΕΣΜΟΘΕΤΗΜΕΝ[\p{L}\p{N}_]* (?:ΤΑΚΤΙΚ[\p{L}\p{N}_]* )?ΕΠΙΧΟΡΗΓ|"
                   r"ΝΟΜΟΘΕΤΗΜΕΝ[\p{L}\p{N}_]* (?:ΟΙΚ[\p{L}\p{N}_]*\.? )?(?:ΕΠΙΧΟΡΗΓ|ΕΙΣΦΟΡ)|"
                   r"ΕΤΗΣΙΑΣ (?:ΤΑΚΤΙΚ[\p{L}\p{N}_]* )?ΕΠΙΧΟΡΗΓ")
_X = r"[\p{L}\p{N}_]*"
PERSONAL = "|".join([
    "ΙΘΑΓΕΝ", "ΠΟΛΙΤΟΓΡΑΦ",
    "ΚΑΤΑΝΟΜΗ ΠΡΟΣΩΠΙΚΟΥ", "ΠΡΟΣΛΗΨ", "ΔΙΟΡΙΣ", "ΜΕΤΑΤΑΞ", "ΑΠΟΣΠΑΣ", "ΑΠΟΛΥΣ", "ΛΥΣΗ ΣΥΜΒΑΣΗΣ", "ΠΕΙΘΑΡΧ",
    word("ΘΕΣ(?:Η|ΗΣ|ΕΙΣ|ΕΩΝ)"), word("ΥΠΟΛΟΓ(?:ΟΣ|ΟΥ|Ο|ΟΙ|ΩΝ|ΟΥΣ)"),
    "ΣΥΓΚΡΟΤΗΣ", "ΣΥΝΕΡΓΕΙ", "ΑΝΤΙΔΗΜΑΡΧ", "ΑΝΤΙΠΕΡΙΦΕΡΕΙΑΡΧ", "ΚΡΑΤΟΥΜΕΝ", "ΑΛΛΟΔΑΠ", "ΔΩΡΕΑ", "ΕΝΑΡΜΟΝΙΣ",
    "ΕΚΤΟΣ ΕΔΡΑΣ", "ΠΡΟΙΣΤΑΜΕΝ", f"ΥΠΗΡΕΣΙΑΚ{_X} ΜΕΤΑΚΙΝΗΣ", f"ΜΕΤΑΚΙΝΟΥΜΕΝ{_X} (?:ΤΩΝ )?(?:ΥΠΑΛΛΗΛ|ΣΤΕΛΕΧ)",
    word("ΥΠΑΛΛΗΛ(?:ΟΣ|ΟΥ|Ο)"), "ΣΤΟ ΟΝΟΜΑ Τ(?:ΟΥ|ΗΣ)", "ΜΕΤΑΚΙΝΗΣΗΣ? Τ(?:ΟΥ|ΗΣ) ",
    "ΜΕΤΑΚΙΝΗΣ(?:Η|ΗΣ|ΕΩΝ) (?!ΜΑΘΗΤ|ΤΩΝ ΜΑΘΗΤ|ΑΤΟΜΩΝ|ΑΜΕΑ|ΥΛΙΚ|ΟΧΗΜ|ΑΠΟΡΡΙΜ|ΕΠΙΒΑΤ)",
    word("ΕΠΑΡΧ(?:ΟΣ|ΟΥ|Ο|ΟΙ|ΩΝ)"), word("ΑΜΚΑ"), r"Α\.Δ\.Τ\.", "@", "ΔΙΚΗΓΟΡ",
    word("ΣΥΓΓΡΑΦΕ(?:Α|ΑΣ|ΩΝ|ΙΣ)"), W + r"ΔΡ\. ?[Α-Ω]", word("ΙΔΙΩΤ(?:Η|ΗΣ|ΩΝ|ΕΣ)"), f"ΕΠΕΝΔΥΤΙΚ{_X} ΣΧΕΔΙ",
    r"(?:^|(?<=[\s,(]))(?:Κ|ΚΚ|Κ\.Κ)\. [Α-Ω]{3,}",
    f"ΣΥΜΒΑΣ{_X} ΑΝΑΘΕΣΗΣ", "ΑΝΑΘΕΣΗ ΣΤ(?:ΗΝ|ΟΝ|Ο|Η) ", f"ΑΤΟΜΙΚ{_X} ΕΠΙΧΕΙΡΗΣ",
    f"ΑΙΤΗΣ{_X} (?:ΑΚΥΡΩΣΗΣ|ΑΝΑΣΤΟΛΗΣ|ΑΝΑΙΡΕΣΗΣ)", "ΚΑΤΑ ΤΗΣ ΠΡΟΣΒΑΛΛΟΜΕΝΗΣ", "ΔΙΚΑΙΩΜΑΤΟΣ ΠΑΡΕΜΒΑΣΗΣ",
    f"ΑΔΕΙ{_X} ΑΛΙΕΙΑΣ", f"ΑΛΙΕΥΤΙΚ{_X} (?:ΕΡΓΑΛΕΙ|ΣΚΑΦ)", "ΥΠΟΤΡΟΦ", "ΒΟΗΘΗΜ", "ΠΡΟΙΚ",
    "(?<!ΤΑΜΕΙΟ ΕΥΡΩΠΑΙΚΗΣ ΒΟΗΘΕΙΑΣ ΠΡΟΣ ΤΟΥΣ )(?<!ΤΑΜΕΙΟ ΓΙΑ ΤΟΥΣ )" + word("ΑΠΟΡ(?:ΟΣ|ΟΥ|Ο|ΟΙ|ΩΝ|ΟΥΣ|ΕΣ|Η|ΗΣ)"),
    rf"ΤΟΠΟΘΕΤΗΣ{_X}[- ]+(?:ΔΙΑΘΕΣ{_X} )?(?:ΑΝΑΠΛΗΡΩΤ|ΕΚΠΑΙΔΕΥΤΙΚ|ΜΕΛΩΝ|ΠΡΟΣΩΡΙΝ|ΥΠΑΛΛΗΛ|ΠΡΟΣΩΠΙΚ)",
    rf"ΑΝΑΠΛΗΡΩΤ{_X} (?:ΕΚΠΑΙΔΕΥΤΙΚ|ΕΙΔΙΚΟΥ|ΜΕΛ[ΩΟΗ]|ΓΕΝΙΚΗΣ|Ε\.?Ε\.?Π|Ε\.?Β\.?Π)", "ΔΕΥΤΕΡΗΣ ΕΙΔΙΚΟΤΗΤΑΣ",
    "ΣΥΝΑΦΕΙΑΣ .{0,60}ΤΙΤΛ",
    r"ΙΔΙΟΚΤΗΣΙΑΣ (?!(?:ΤΟΥ |ΤΗΣ |ΤΩΝ )?(?:ΔΗΜΟΥ|ΔΗΜΟΣΙΟΥ|ΙΕΡ|Ι\.|ΕΚΚΛΗΣΙ|ΜΟΝΗΣ|ΠΕΡΙΦΕΡΕΙΑΣ|ΚΟΙΝΟΤΗΤ|ΕΛΛΗΝΙΚΟΥ|"
    r"ΠΑΝΕΛΛΗΝΙΟΥ|ΥΠΟΥΡΓΕΙΟΥ|ΠΙΙΕΤ|Π\.Ι\.Ι\.Ε\.Τ|ΙΔΡΥΜΑΤΟΣ|Ν\.?Π\.?Δ\.?Δ))",
    rf"(?:ΕΠΙΣΚΕΥΗΣ|ΑΝΕΓΕΡΣΗΣ|ΠΡΟΣΘΗΚΗΣ|ΑΝΑΚΑΙΝΙΣΗΣ|ΑΠΟΚΑΤΑΣΤΑΣΗΣ){_X} (?:[Α-Ω]+ ){{0,3}}?(?:ΚΑΤΟΙΚΙ|ΟΙΚΙΑΣ)",
    "ΚΑΤΑΣΤΗΜΑΤΟΣ (?:ΥΓΕΙΟΝΟΜΙΚΟΥ|ΜΑΖΙΚΗΣ|ΛΙΑΝΙΚΗΣ)", "ΑΥΘΑΙΡΕΤ", "4495/2017",
    word("ΟΡΙΣΜΟΣ|ΟΡΙΣΜΟΥ") + " (?:ΤΟΥ |ΤΗΣ |ΤΩΝ )?(?:ΕΠΟΠΤ|ΕΚΠΡΟΣΩΠ|ΜΕΛ[ΩΟΗ]|ΥΠΕΥΘΥΝ|ΑΝΑΠΛΗΡΩ|ΓΡΑΜΜΑΤΕ|ΠΡΟΕΔΡ|"
    "ΧΕΙΡΙΣΤ|ΣΥΝΤΟΝΙΣΤ|ΕΛΕΓΚΤ|ΔΙΑΧΕΙΡΙΣΤ|ΕΠΙΒΛΕΠ|ΑΞΙΟΛΟΓΗΤ|ΥΠΑΛΛΗΛ|ΥΠΟΛΟΓ)",
    word(r"(?:ΤΟΥ|ΤΗΣ|ΤΩΝ|ΤΟΝ|ΤΗΝ|ΤΟΥΣ|ΤΙΣ|ΣΤΟΝ|ΣΤΗΝ|ΣΤΟΥΣ|ΣΤΙΣ) (?:Κ\.|Κ\.Κ\.|ΚΟΥ|ΚΑΣ|ΚΥΡΙΟΥ|ΚΥΡΙΑΣ)") + " ?[Α-Ω]{2}",
])

# ---- fixed values: privacy ----------------------------------------------------------------------
NOT_A_NAME = ("ΥΠΟΛΟΓΟΣ", "ΕΝΤΑΛΜΑΤΟΣ", "ΠΡΟΠΛΗΡΩΜΗΣ", "ΚΑΙ", "ΛΟΙΠΟΙ", "ΛΟΙΠΕΣ", "ΤΟΥ", "ΤΗΣ")
FORM_LEAK = r"(\p{L}+)\s*,,\s*\p{L}"
FORM_PLACEHOLDER = "SURNAME"
ID_IN_TEXT = r"(?<![0-9A-Za-z])\d{9}(?![0-9A-Za-z])"
NEVER_CARRIED = ("authorEmail", "signers", "addressForDelivery", "postalCode", "city")
