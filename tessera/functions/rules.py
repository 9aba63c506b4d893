"""Abbreviation rules of business names and addresses."""

from __future__ import annotations

# Fixed values, in their order: abbreviation, expansion.
BUSINESS: dict[str, str] = {
    "corp": "corporation",
    "inc": "incorporated",
    "ltd": "limited",
    "co": "company",
    "llc": "limited liability company",
    "llp": "limited liability partnership",
    "plc": "public limited company",
    "pvt": "private",
    "pvt ltd": "private limited",
    "intl": "international",
    "natl": "national",
    "svcs": "services",
    "svc": "service",
    "mfg": "manufacturing",
    "assoc": "associates",
    "assn": "association",
    "grp": "group",
    "hldgs": "holdings",
    "holdings": "holdings",
    "entr": "enterprise",
    "enterprises": "enterprises",
    "tech": "technology",
    "technol": "technology",
    "soln": "solutions",
    "solns": "solutions",
    "sys": "systems",
    "mgmt": "management",
    "comm": "communications",
    "dist": "distribution",
    "indus": "industries",
    "pharm": "pharmaceuticals",
    "pharma": "pharmaceuticals",
    "lab": "laboratory",
    "labs": "laboratories",
    "fin": "financial",
    "finl": "financial",
    "consult": "consulting",
    "constr": "construction",
    "dba": "",
    "&": "and",
}

# Fixed values, in their order: abbreviation, expansion.
ADDRESS: dict[str, str] = {
    "st": "street",
    "rd": "road",
    "ave": "avenue",
    "blvd": "boulevard",
    "dr": "drive",
    "ln": "lane",
    "ct": "court",
    "pl": "place",
    "pkwy": "parkway",
    "hwy": "highway",
    "fl": "floor",
    "ste": "suite",
    "apt": "apartment",
    "bldg": "building",
    "no": "number",
    "n": "north",
    "s": "south",
    "e": "east",
    "w": "west",
    "nr": "near",
    "opp": "opposite",
    "dist": "district",
    "taluka": "taluka",
    "vill": "village",
    "nagar": "nagar",
}


def token_map(rules: dict[str, str]) -> dict[str, str]:
    """The rules for text of word characters and single spaces: no expansion is another rule's abbreviation, so one look per token is enough.

    The two-word rule can fire only where nothing stands between its words, since its halves are rules before it.
    """
    return {k.replace(" ", ""): v for k, v in rules.items() if k != "&" and k != v}
