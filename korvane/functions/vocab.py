"""Abbreviations of names and addresses that matching results depend on."""

# Legal suffixes and other closing words of names, as written -> canonical.
LEGAL_SUFFIXES = {
    "corp": "corporation", "corp.": "corporation", "corpn": "corporation",
    "inc": "incorporated", "inc.": "incorporated", "incorp": "incorporated",
    "ltd": "limited", "ltd.": "limited", "ltda": "limited",
    "llc": "llc", "l.l.c.": "llc", "l.l.c": "llc",
    "pvt": "private", "pvt.": "private", "pvt.ltd": "private limited", "pvt.ltd.": "private limited", "pvtltd": "private limited", "private limited": "private limited", "privatelimited": "private limited",
    "plc": "plc", "p.l.c.": "plc",
    "co": "company", "co.": "company", "comp": "company",
    "grp": "group", "grp.": "group",
    "assoc": "associates", "assocs": "associates",
    "bros": "brothers", "bros.": "brothers",
    "intl": "international", "int'l": "international", "intl.": "international",
    "svcs": "services", "svc": "service", "svcs.": "services",
    "ind": "industries", "inds": "industries",
    "ent": "enterprise", "ent.": "enterprise", "enterp": "enterprise",
    "fdn": "foundation", "fdn.": "foundation", "fndn": "foundation",
    "dept": "department", "dept.": "department",
    "mfg": "manufacturing", "mfg.": "manufacturing",
    "soln": "solutions", "solns": "solutions",
    "tech": "technologies", "techn": "technologies",
    "lab": "laboratories", "labs": "laboratories",
    "sarl": "sarl", "s.a.r.l.": "sarl", "s.a.r.l": "sarl",
    "sa": "sa", "s.a.": "sa", "s.a": "sa",
    "sas": "sas", "s.a.s.": "sas", "s.a.s": "sas",
    "eurl": "eurl", "e.u.r.l.": "eurl",
    "gie": "gie", "g.i.e.": "gie",
    "sci": "sci", "s.c.i.": "sci",
}

# Tokens of names that stand for a word.
NAME_TOKENS = {"&": "and", "n": "and", "+": "and", "@": "at"}

# Address abbreviations, later groups win over earlier ones.
ADDRESS_US = {
    "rd": "road", "rd.": "road", "st": "street", "st.": "street", "ave": "avenue", "ave.": "avenue", "blvd": "boulevard", "blvd.": "boulevard", "dr": "drive", "dr.": "drive",
    "ct": "court", "ct.": "court", "cir": "circle", "cir.": "circle", "ln": "lane", "ln.": "lane", "pl": "place", "pl.": "place", "pkwy": "parkway", "pky": "parkway",
    "hwy": "highway", "hwy.": "highway", "trl": "trail", "trl.": "trail", "ter": "terrace", "terr": "terrace", "cres": "crescent", "expy": "expressway", "exp": "expressway",
    "fwy": "freeway", "mt": "mount", "mt.": "mount", "ste": "suite", "ste.": "suite", "apt": "apartment", "apt.": "apartment", "bldg": "building", "bldg.": "building",
    "fl": "floor", "fl.": "floor", "flr": "floor", "rm": "room", "rm.": "room", "dept": "department",
    "n": "north", "n.": "north", "s": "south", "s.": "south", "e": "east", "e.": "east", "w": "west", "w.": "west", "ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest",
    "po": "po", "p.o.": "po", "box": "box",
}
ADDRESS_INDIA = {
    "rd": "road", "rd.": "road", "st": "street", "st.": "street", "marg": "marg", "nagar": "nagar", "ngr": "nagar", "gali": "gali", "mohalla": "mohalla", "moh": "mohalla",
    "chowk": "chowk", "chwk": "chowk", "colony": "colony", "col": "colony", "sector": "sector", "sec": "sector", "block": "block", "blk": "block", "phase": "phase", "ph": "phase",
    "dist": "district", "distt": "district", "vill": "village", "vill.": "village", "kh": "khasra", "kh.": "khasra", "h.no": "house number", "hno": "house number", "h.no.": "house number",
    "opp": "opposite", "opp.": "opposite", "nr": "near", "nr.": "near",
}
ADDRESS_FRANCE = {
    "rue": "rue", "av": "avenue", "av.": "avenue", "bd": "boulevard", "bd.": "boulevard", "pl": "place", "pl.": "place", "imp": "impasse", "imp.": "impasse", "chem": "chemin", "ch": "chemin",
    "rte": "route", "rte.": "route", "allée": "allee", "all": "allee", "sq": "square", "quai": "quai", "fbg": "faubourg", "esc": "escalier", "bat": "batiment", "bât": "batiment",
    "appt": "appartement", "apt": "appartement", "rez-de-chaussée": "rdc", "rdc": "rdc", "cedex": "cedex", "cs": "cs", "bp": "bp",
}
ADDRESS_TOKENS = ADDRESS_US | ADDRESS_INDIA | ADDRESS_FRANCE

# Marks of a second trading name, tried in this order.
DBA_MARKS = (r"\bdba\b", r"\bd/b/a\b", r"\bdoing business as\b", r"\baka\b", r"\ba\.k\.a\.\b", r"\btrading as\b", r"\bt/a\b")
# Patterns of what is taken out of names, of separators, quotes and brackets, and of numbers.
WEBSITES = (r"https?://\S+", r"www\.\S+", r"\b\w+\.(com|org|net|co\.in|in|edu)\b")
NAME_SEPARATORS, NAME_QUOTES = r"[/\\|,;:]+", r"[\"'\[\]{}()*#]+"
ADDRESS_QUOTES, ADDRESS_HASHES, ADDRESS_COMMAS = r"[\"'\[\]{}()*]+", "#+", "[,;]+"
NUMBER = r"\b\d+(?:[/-]\d+)*\b"
PIN, ZIP = r"\b(\d{6})\b", r"\b(\d{5})(?:-\d{4})?\b"
# Words that open a landmark.
LANDMARK_WORDS = "near|opp|opposite|behind|beside|next to|adjacent to|in front of"
# Texts that a missing value is written as in delimited files.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
