"""Fixed values that results depend on: names, abbreviations, patterns, code lists."""

#: Official abbreviations of acts and their titles.
ABBREVIATIONS = {
    "KarS": "Karistusseadustik",
    "VÕS": "Võlaõigusseadus",
    "TsÜS": "Tsiviilseadustiku üldosa seadus",
    "AÕS": "Asjaõigusseadus",
    "PKS": "Perekonnaseadus",
    "ÄS": "Äriseadustik",
    "HMS": "Haldusmenetluse seadus",
    "TsMS": "Tsiviilkohtumenetluse seadustik",
    "KrMS": "Kriminaalmenetluse seadustik",
    "TMS": "Täitemenetluse seadustik",
    "KOKS": "Kohaliku omavalitsuse korralduse seadus",
    "PS": "Põhiseadus",
    "PankrS": "Pankrotiseadus",
    "MKS": "Maksukorralduse seadus",
    "TLS": "Töölepingu seadus",
    "RLS": "Riigilõivuseadus",
    "TTKS": "Töötervishoiu ja tööohutuse seadus",
    "TKS": "Tolliseadus",
    "TPTS": "Tööturuteenuste ja -toetuste seadus",
    "IKS": "Isikuandmete kaitse seadus",
    "RahaPTS": "Rahapesu ja terrorismi rahastamise tõkestamise seadus",
    "KELS": "Kõrgharidusseadus",
    "PPVS": "Planeerimisseadus",
    "AVVKHS": "Avaliku teenistuse seadus",
    "RHS": "Riigihangete seadus",
    "SHS": "Sotsiaalhoolekande seadus",
    "ELTS": "Elektrituruseadus",
    "EhS": "Ehitusseadus",
    "KVS": "Korruptsioonivastane seadus",
    "MSVS": "Meresõiduvahendite seadus",
    "RSVS": "Relvaseadus",
    "EKS": "Elektroonilise side seadus",
    "KES": "Keskkonnaseadustiku eriosa seadus",
    "LKS": "Looduskaitseseadus",
    "KeÜS": "Keskkonnaseadustiku üldosa seadus",
    "MaaRS": "Maareformi seadus",
    "KOS": "Kinnisasja omandamise kitsendamise seadus",
    "RavS": "Ravimiseadus",
    "AVTS": "Avaliku teabe seadus",
    "KLS": "Kalapüügiseadus",
    "KAVS": "Kaitseväeteenistuse seadus",
    "TTÜKS": "Tööstusomandi kaitse seadus",
    "KMS": "Käibemaksuseadus",
    "TuMS": "Tulumaksuseadus",
    "SMMS": "Sotsiaalmaksuseadus",
    "KindlTS": "Kindlustustegevuse seadus",
}

#: Genitive full names and the abbreviation they stand for.
GENITIVES = {
    "karistusseadustiku": "KarS",
    "võlaõigusseaduse": "VÕS",
    "tsiviilseadustiku üldosa seaduse": "TsÜS",
    "asjaõigusseaduse": "AÕS",
    "perekonnaseaduse": "PKS",
    "äriseadustiku": "ÄS",
    "haldusmenetluse seaduse": "HMS",
    "tsiviilkohtumenetluse seadustiku": "TsMS",
    "kriminaalmenetluse seadustiku": "KrMS",
    "täitemenetluse seadustiku": "TMS",
    "kohaliku omavalitsuse korralduse seaduse": "KOKS",
    "põhiseaduse": "PS",
    "pankrotiseaduse": "PankrS",
    "maksukorralduse seaduse": "MKS",
    "töölepingu seaduse": "TLS",
    "riigilõivuseaduse": "RLS",
}

#: The section sign in all its cases, and a number or range after it.
SECTION = "§(?:§|[\\-‑](?:de(?:s)?|d|s|st|le|i|ga))?"
NUMBERS = "(\\d+(?:\\s*[\\-–]\\s*\\d+)?)"

#: Words that say nothing about a provision.
STOPWORDS = (
    "ja", "ning", "või", "on", "ei", "see", "mis", "kes", "mille", "kelle", "selle", "tema", "oma", "kui", "et", "ka", "nii", "aga", "kuid", "vaid",
    "siis", "juba", "veel", "väga", "kogu", "iga", "kõik", "üks", "mõni", "ole", "olema", "saab", "saama", "teha", "tegema", "olla", "mitte", "nende",
    "neid", "need", "seda", "sellest", "sellele", "teda", "talle", "temast", "ise", "enda", "endale", "muu", "muud", "muude", "muudest", "teise",
    "teiste", "teistest", "sama", "samu", "samade", "samadest", "käesoleva", "käesolev", "seaduse", "seadus", "seadusega", "seaduses", "paragrahv",
    "lõige", "punkt", "lõikes", "punktis", "alusel", "korral", "juhul", "kohta", "kohaldatakse", "sätestatud", "kehtestatud", "määratud", "vastavalt",
    "järgi", "kohaselt", "tähenduses",
)

#: Provisions without content of their own.
BOILERPLATE = (
    "välja jäetud", "valja jaetud", "^Kehtetu", "jõustub.*riigi teatajas", "jõustub.*avaldamisele", "käesolev seadus jõustub",
    "seadus jõustub", "tunnistatakse kehtetuks", "rakendatakse.*jõustumisest",
)

#: Weighted signals of normative types, in the order that settles ties.
NORMS = {
    "Obligation": (("\\bon kohustatud\\b", 3), ("\\bpeab\\b", 2), ("\\btuleb\\b", 2), ("\\bon kohustus\\b", 3), ("\\bkohustub\\b", 3), ("\\bon sunnitud\\b", 2)),
    "Right": (("\\bon õigus\\b", 3), ("\\bõigus on\\b", 3), ("\\bon õigustatud\\b", 3), ("\\bon lubatud nõuda\\b", 3), ("\\bvõib\\b", 1)),
    "Permission": (("\\bon lubatud\\b", 3), ("\\btohib\\b", 3), ("\\bon vaba\\b", 2), ("\\bvõib\\b", 1)),
    "Prohibition": (("\\bon keelatud\\b", 4), ("\\bei tohi\\b", 4), ("\\bei ole lubatud\\b", 3), ("\\bpole lubatud\\b", 3), ("\\bon karistatav\\b", 3)),
}
#: Who has a duty - a capitalised phrase before a modal verb, and heads that are nobody.
HOLDER = "(\\b[A-ZÄÖÜÕŠŽ][a-zäöüõšž]+(?:\\s+[a-zäöüõšž]+){0,3})\\s+(?:peab|on kohustatud|kohustub|on sunnitud|tuleb)"
NOBODY = ("Käesolev", "Käesoleva", "Paragrahv", "Seadus", "Lõige", "Punkt")

#: Kinds of change named in a draft's title, first match wins.
CHANGES = (("muutmi", "amends"), ("kehtetuks\\s+tunnistami", "repeals"), ("täiendami", "supplements"), ("kehtestami", "enacts"))

#: Competence types, first match wins, else general.
COMPETENCES = (
    ("järelevalvet\\s+teostab", "supervision"), ("teostab\\s+järelevalvet", "supervision"), ("järelevalve", "supervision"),
    ("\\bon\\s+pädev\\b", "general"), ("\\bannab\\s+loa\\b", "licensing"), ("\\bväljastab\\s+luba\\b", "licensing"),
    ("\\bkehtestab\\b", "regulation"), ("\\bkontrollib\\b", "enforcement"), ("\\bkorraldab\\b", "enforcement"), ("\\bteostab\\b", "enforcement"),
)

#: Number words of penalty clauses.
NUMBER_WORDS = {
    "ühe": 1, "kahe": 2, "kolme": 3, "nelja": 4, "viie": 5, "kuue": 6, "seitsme": 7, "kaheksa": 8, "üheksa": 9, "kümne": 10,
    "üheteist": 11, "kaheteist": 12, "kolmeteist": 13, "neljateist": 14, "viieteist": 15, "kuueteist": 16, "seitsmeteist": 17,
    "kaheksateist": 18, "üheksateist": 19, "kahekümne": 20, "kahekümneviie": 25, "kolmkümmend": 30,
    "kolmsada": 300, "kolmesada": 300, "kakssada": 200, "viissada": 500, "sada": 100, "tuhat": 1000,
}

#: Titles and phrases of definition sections, and the form of a numbered definition.
DEFINITION_TITLES = ("mõisted", "seaduses kasutatavad mõisted", "põhimõisted", "mõistete selgitus", "terminid", "terminid ja mõisted", "mõisted ja lühendid")
DEFINITION_INTROS = (
    "käesolevas\\s+seaduses\\s+kasutatakse\\s+järgmises\\s+tähenduses", "käesoleva\\s+seaduse\\s+tähenduses", "käesolevas\\s+seaduses\\s+tähendab",
    "käesolevas\\s+seaduses\\s+mõistetakse", "käesolevas\\s+seadustikus\\s+kasutatakse", "käesoleva\\s+seadustiku\\s+tähenduses", "käesoleva\\s+seaduse\\s+mõistes",
)
DEFINITION = "(\\d+)\\)\\s*([\\wäöüõšžÄÖÜÕŠŽ]+(?:\\s+[\\wäöüõšžÄÖÜÕŠŽ-]+)*?)\\s*[–\\-—]\\s*(.+?)(?:;|$)"

#: Named institutions in order of precedence (name, key, type), and keys that stand for others.
INSTITUTIONS = (
    ("Vabariigi Valitsus", "vabariigivalitsus", "government"), ("Riigikogu", "riigikogu", "parliament"),
    ("Vabariigi President", "vabariigipresident", "head_of_state"), ("Andmekaitse Inspektsioon", "andmekaitseinspektsioon", "agency"),
    ("Tarbijakaitse ja Tehnilise Järelevalve Amet", "ttja", "agency"), ("Maksu- ja Tolliamet", "maksu__ja_tolliamet", "agency"),
    ("Politsei- ja Piirivalveamet", "politsei__ja_piirivalveamet", "agency"), ("Keskkonnaamet", "keskkonnaamet", "agency"),
    ("Terviseamet", "terviseamet", "agency"), ("Haridus- ja Noorteamet", "haridus__ja_noorteamet", "agency"),
    ("MTA", "mta", "agency"), ("PPA", "ppa", "agency"), ("Riigikohus", "riigikohus", "court"), ("ringkonnakohus", "ringkonnakohus", "court"),
    ("halduskohus", "halduskohus", "court"), ("maakohus", "maakohus", "court"),
)
INSTITUTION_KEYS = {
    "mta": "maksu__ja_tolliamet", "ppa": "politsei__ja_piirivalveamet", "ttja": "tarbijakaitse_ja_tehnilise_jarelevalve_amet",
    "harno": "haridus__ja_noorteamet", "kohaliku_omavalitsus": "kohalik_omavalitsus", "kohaliku_omavalitsuse": "kohalik_omavalitsus",
    "kohalik_omavalitsuse": "kohalik_omavalitsus", "andmekaitsinspektsioon": "andmekaitseinspektsioon",
}
INSTITUTION_PATTERNS = (
    ("(?U)\\b([A-ZÄÖÜÕŠŽ][a-zäöüõšž]+(?:\\s*-\\s*ja\\s+[A-ZÄÖÜÕŠŽ]?[a-zäöüõšž]+)*ministeerium)\\b", "ministry"),
    ("(?iU)\\b([a-zäöüõšž]+minister)\\b", "ministry"),
    ("(?U)\\b([A-ZÄÖÜÕŠŽ][a-zäöüõšž]+(?:\\s*-\\s*ja\\s+[A-ZÄÖÜÕŠŽ]?[a-zäöüõšž]+)*amet)\\b", "agency"),
    ("(?U)\\b([A-ZÄÖÜÕŠŽ][a-zäöüõšž]+inspektsioon)\\b", "agency"),
    ("(?iU)\\b(kohus)\\b", "court"),
    ("(?iU)\\b(kohalik(?:u)?\\s+omavalitsus(?:e)?)\\b", "local_government"),
    ("(?iU)\\b(vald|linn)\\b", "local_government"),
)

#: Case types by first character, decision types by label.
CASE_TYPES = {"1": "Criminal", "2": "Civil", "3": "Administrative", "4": "Misdemeanor", "5": "ConstitutionalReview"}
DECISION_TYPES = {"Kohtuotsus": "Judgment", "Kohtumäärus": "Ruling", "Kohtu resolutsioon": "Resolution", "Määrus": "OrderRuling"}

#: Case-law document numbers - code, decision type, court.
CELEX_CODES = (
    ("CJ", "Judgment", "CourtOfJustice"), ("TJ", "Judgment", "GeneralCourt"), ("FJ", "Judgment", "CivilServiceTribunal"),
    ("CO", "Order", "CourtOfJustice"), ("TO", "Order", "GeneralCourt"), ("FO", "Order", "CivilServiceTribunal"),
    ("CC", "AGOpinion", "CourtOfJustice"), ("CA", "AGOpinion", "CourtOfJustice"), ("CN", "AGOpinion", "CourtOfJustice"),
    ("TA", "AGOpinion", "GeneralCourt"), ("CV", "CourtOpinion", "CourtOfJustice"), ("CP", "Order", "CourtOfJustice"),
    ("TC", "AGOpinion", "GeneralCourt"), ("CS", "Order", "CourtOfJustice"), ("CT", "Order", "CourtOfJustice"),
)
CELEX_CATEGORIES = {"Judgment": "judgments", "Order": "orders", "AGOpinion": "ag_opinions", "CourtOpinion": "court_opinions"}

#: Words left out of derived abbreviations, and marks of treaties.
ACRONYM_STOPS = ("seadus", "seaduse", "seadustik", "aasta", "ja", "ning", "kohta", "vahel", "vahelise", "rakendamise")
TREATY_MARKS = ("konventsiooni", "lepingu", "protokolli")

#: Severity and English labels of sanction types.
SEVERITY = {"coercive_payment": 1, "fine": 2, "pecuniary_punishment": 3, "arrest": 4, "imprisonment": 5}
SANCTION_LABELS = {
    "imprisonment": "Imprisonment", "pecuniary_punishment": "Pecuniary punishment", "fine": "Fine", "arrest": "Arrest",
    "coercive_payment": "Coercive payment",
}

#: Patterns of sanctions, gazette references and law names.
LIFE_IMPRISONMENT = r"(?iU)eluaeg\w*\s+vangistus"
YEARS_IN_WORDS_RANGE = r"(?iU)(\w+)-?\s+kuni\s+(\w+)aasta(?:se)?\s+vangistus"
YEARS_IN_WORDS = r"(?iU)kuni\s+(\w+)aasta(?:se)?\s+vangistus"
YEARS_NEAR_PUNISHED = r"(?iUd)karistatakse.*?(\d+).*?aasta(?:se)?\s+vangistus"
IMPRISONMENT_NUMBER = r"(?iU)vangistus(?:ega)?\s+(\d+)"
PECUNIARY = r"(?iU)rahalise?\s+karistus"
FINE_IN_EUROS = r"(?iU)rahatrahv(?:iga)?\s+(?:kuni\s+)?(\d[\d\s]*)\s*eurot"
COERCIVE_IN_EUROS = r"(?iU)sunniraha\s+kuni\s+(\d[\d\s]*)\s*eurot"
COERCIVE = r"(?iU)\bsunniraha\b"
ARREST_DAYS = r"(?iU)aresti?\w*\s+(?:kuni\s+)?(\d+)\s*(?:päeva|ööpäeva)"
ARREST_DAYS_IN_WORDS = r"(?iU)aresti?\w*\s+(?:kuni\s+)?(\w+)\s+(?:päeva|ööpäeva)"
ARREST = r"(?iU)\barest"
ANY_YEARS = r"(?iU)(\d+)\s*aasta"
ANY_YEARS_IN_WORDS = r"(?iU)(\w+)aasta"
ANY_AMOUNT = r"(?iU)(\d[\d\s]*)\s*(?:eurot|trahviühiku)"
ANY_ARREST_DAYS = r"(?iU)arest\w*\s+(?:kuni\s+)?(\d+)\s*(?:päeva|ööpäeva)"
ANY_COERCIVE = r"(?iU)sunniraha\w*\s+(?:kuni\s+)?(\d[\d\s]*)\s*eurot"
GAZETTE = r"(?U)RT\s+I{1,2}\s*,\s*(?:\d{2}\.\d{2}\.)?\d{4}\s*,\s*\d+(?:\s*,\s*\d+)?"
LAW_BEFORE_SECTION = r"(?iU)(\w+seaduse?(?:tiku?)?)\s*§\s*[\d\-]+\s*(?:lg\s*[\d]+)?"
