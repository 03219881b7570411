"""Fixed values that results depend on: word lists, abbreviation tables and patterns."""

# Legal forms, variant to canonical.
LEGAL = {
    "pvt": "private", "prv": "private", "pvtltd": "private limited", "ltd": "limited",
    "ltda": "limited", "inc": "incorporated", "corp": "corporation", "co": "company",
    "cos": "company", "llc": "llc", "llp": "llp", "lp": "lp", "plc": "plc", "opc": "opc",
    "pllc": "pllc", "pc": "pc", "pa": "pa", "ltee": "limited", "sarl": "sarl", "sas": "sas",
    "sasu": "sasu", "sa": "sa", "eurl": "eurl", "sci": "sci", "snc": "snc", "gmbh": "gmbh",
    "ag": "ag", "bv": "bv", "nv": "nv", "spa": "spa", "srl": "srl",
}

# What the second version of the rules adds for names.
LEGAL_2 = {"cie": "company", "compagnie": "company"}
NAME_2 = {"ets": "etablissements", "st": "saint", "ste": "sainte"}
COUNTRY_WORDS_2 = ("france",)

# Words of a legal form (the last five also stand alone).
LEGAL_WORDS = tuple(sorted({*LEGAL.values(), "private", "limited", "incorporated", "corporation", "company"}))

# Words that carry no identity.
NOISE_WORDS = (
    "the", "and", "of", "a", "an", "ms", "m", "s", "mr", "mrs", "smt", "shri", "sri", "shree", "dr",
    "india", "le", "la", "les", "de", "du", "des", "et", "l", "d",
)

# Address words, variant to canonical.
ADDRESS = {
    "rd": "road", "st": "street", "str": "street", "ave": "avenue", "av": "avenue",
    "blvd": "boulevard", "bd": "boulevard", "bld": "boulevard", "ln": "lane", "dr": "drive",
    "hwy": "highway", "pkwy": "parkway", "ct": "court", "pl": "place", "cir": "circle",
    "sq": "square", "ste": "suite", "apt": "apartment", "fl": "floor", "flr": "floor",
    "bldg": "building", "blk": "block", "sec": "sector", "ph": "phase", "nr": "near",
    "opp": "opposite", "mkt": "market", "ngr": "nagar", "clny": "colony", "col": "colony",
    "no": "number", "num": "number", "unit": "unit", "pmb": "pmb", "ft": "fort", "mt": "mount",
    "trl": "trail", "ter": "terrace", "pt": "point",
}

# What the second version of the rules adds for addresses.
ADDRESS_2 = {
    "r": "rue", "all": "allee", "imp": "impasse", "rte": "route", "ch": "chemin", "che": "chemin",
    "chem": "chemin", "crs": "cours", "q": "quai", "qu": "quai", "pas": "passage", "fbg": "faubourg",
    "res": "residence", "ndeg": "number", "saint": "street", "sainte": "suite",
}

# Patterns of the normalization.
NULL_WORDS = r"<null>|\b(?:null|none|nan|n/a)\b"
ALIAS = r"\b(?:a/k/a|f/k/a|d/b/a|t/a|aka|fka|dba|formerly|trading as|also known as)\b:?"
WEB = r"^(?:www\.)?([a-z0-9][a-z0-9-]*)\.(?:com|net|org|in|co|biz|info|fr|us|io|co\.in)$"

# Letters that sound alike, and letters whose runs are told once.
SOUNDS = (("cq", "k"), ("vw", "b"), ("zg", "j"))
RUNS = "bdfjklmnprst"
PHONETIC_EXTRA = ("pvt", "ltd", "pte")

# Fixed values of the older views: legal forms, legal phrases, address words, stop and landmark words.
VIEW_LEGAL = {
    "pvt": "private", "private": "private", "prv": "private", "ltd": "limited", "limited": "limited",
    "ltda": "limited", "inc": "incorporated", "incorporated": "incorporated", "corp": "corporation",
    "corporation": "corporation", "co": "company", "company": "company", "cos": "company", "llc": "llc",
    "llp": "llp", "lp": "lp", "plc": "plc", "opc": "opc", "pllc": "pllc", "pc": "pc", "sarl": "sarl",
    "sas": "sas", "sasu": "sasu", "sa": "sa", "eurl": "eurl", "sci": "sci", "snc": "snc", "gmbh": "gmbh",
    "ag": "ag", "bv": "bv",
}
VIEW_PHRASES = ((r"\bl\s*l\s*c\b", "llc"), (r"\bl\s*l\s*p\b", "llp"), (r"\bs\s*a\s*r\s*l\b", "sarl"), (r"\bs\s*a\s*s\b", "sas"), (r"\bprivate\s+limited\b", "private limited"))
VIEW_ADDRESS = {
    "rd": "road", "st": "street", "str": "street", "ave": "avenue", "av": "avenue", "blvd": "boulevard",
    "bd": "boulevard", "ln": "lane", "dr": "drive", "hwy": "highway", "pkwy": "parkway", "ct": "court",
    "pl": "place", "sq": "square", "ste": "suite", "apt": "apartment", "fl": "floor", "flr": "floor",
    "bldg": "building", "blk": "block", "sec": "sector", "ph": "phase", "nr": "near", "opp": "opposite",
    "mkt": "market", "ngr": "nagar", "clny": "colony", "no": "number", "num": "number", "n": "north",
    "s": "south", "e": "east", "w": "west",
}
VIEW_STOP = ("the", "and", "of")
LANDMARKS = ("near", "opposite", "behind", "beside", "next", "adjacent", "facing")
