"""Predefined searches: weather hazards, electric utilities, and the groups of a folder of keyword files.

The long keyword lists of utilities and of sectors are parameters: files in the format of :func:`parse_group_file`, or
blocks of OR-terms. What is fixed here are short lists that results depend on.
"""

from __future__ import annotations

from pathlib import Path

from quarry.plans.keyword import parse_group_file

# Terms of the weather search. A document must hold a hazard and a context.
HAZARDS = (
    ("extreme heat", "heat mortality", "wet-bulb temperature", "extreme temperature", "heat wave", "heatwave", "heat stress", "hot temperature", "high temperature", "temperature extreme", "heat index", "urban heat island", "urban warming"),
    ("extreme cold", "cold wave", "cold spell", "freeze event", "winter storm", "frost", "snowstorm", "hard freeze", "ice storm", "blizzard"),
    ("flood", "flash flood", "river flood", "urban flooding", "coastal flooding", "compound flooding", "inundation", "storm surge", "heavy precipitation", "pluvial flooding", "riverine flooding", "extreme rainfall"),
    ("drought", "water scarcity", "hydrologic drought", "agricultural drought", "meteorological drought", "snow drought"),
    ("wildfire", "forest fire", "bushfire", "fire weather", "wildland fire", "wildfire smoke", "smoke exposure"),
    ("tropical cyclone", "hurricane", "typhoon", "cyclonic storm"),
    ("convective storm", "severe convective storm", "thunderstorm", "severe thunderstorm", "hail", "straight-line wind", "downburst", "microburst", "tornado", "extreme wind"),
    ("sea level rise", "coastal erosion", "salinization", "saltwater intrusion", "ocean warming", "rising ocean temperature", "marine heatwave", "ocean acidification"),
    ("sea ice loss", "glacial melt", "permafrost thaw", "snowmelt timing", "arctic sea ice"),
    ("carbon dioxide fertilization", "CO2 fertilization"),
    ("crop failure", "crop yield", "ecosystem services"),
)
CONTEXTS = ("climate", "weather", "hazard", "resilience", "adaptation", "vulnerability", "mitigation", "preparedness", "forecast", "recovery", "response", "exposure", "risk", "infrastructure", "community", "ecosystem", "public health", "planning", "disaster", "policy", "governance", "sustainability")

# Sector and subsectors of each (file, group); groups of file 7 are tags instead.
SECTORS = {
    **{(1, g): ("Energy", ["Electricity"]) for g in range(1, 9)},
    (1, 9): ("Energy", ["Natural Gas", "Petroleum"]),
    (1, 10): ("Transportation", ["Pipeline Systems"]),
    (1, 11): ("Energy", ["Natural Gas", "Petroleum"]),
    (1, 12): ("Nuclear", ["Nuclear Facility Subsector"]),
    (1, 13): ("Dams", ["Electricity Generation"]),
    **{(2, g): ("Water", ["Water"]) for g in (1, 2, 3)},
    (2, 4): ("Water", ["Wastewater"]),
    (2, 5): ("Water", ["Wastewater"]),
    (2, 6): ("Dams", ["Water Supply and Flood Control"]),
    (2, 7): ("Water", []),
    (3, 1): ("Transportation", ["Aviation"]),
    (3, 2): ("Transportation", ["Highways and Motor Carriers"]),
    (3, 3): ("Transportation", ["Maritime"]),
    (3, 4): ("Transportation", ["Mass Transit and Passenger Rail"]),
    (3, 5): ("Transportation", ["Freight Rail"]),
    (3, 6): ("Transportation", ["Pipeline Systems"]),
    (3, 7): ("Transportation", ["Postal and Shipping"]),
    (4, 1): ("Communications", ["Wireline"]),
    (4, 2): ("Communications", ["Wireless"]),
    (4, 3): ("Communications", ["Satellite"]),
    (4, 4): ("Communications", ["Cable"]),
    (4, 5): ("Communications", ["Broadcasting"]),
    (4, 6): ("Information Technology", []),
    (5, 1): ("Chemical", []),
    (5, 2): ("Critical Manufacturing", []),
    (6, 1): ("Commercial Facilities", []),
    (6, 2): ("Defense Industrial Base", []),
    (6, 3): ("Emergency Services", []),
    (6, 4): ("Financial Services", []),
    (6, 5): ("Food and Agriculture", []),
    (6, 6): ("Government Facilities", []),
    (6, 7): ("Healthcare and Public Health", []),
}
TAGGED = 7


def any_of(terms) -> str:
    """A query for any of the terms."""
    return "(" + " OR ".join(f'"{t}"' for t in terms) + ")"


def weather() -> str:
    return "(" + " OR ".join(map(any_of, HAZARDS)) + ") AND " + any_of(CONTEXTS)


def anchored(blocks: list[str], anchor: str, exclusions: str) -> str:
    """One query for any of the blocks (queries), with the anchor and without the exclusions: the utility search."""
    return f"({' OR '.join(f'({b})' for b in blocks)}) AND ({anchor}) AND NOT ({exclusions})"


def load_groups(folder: str) -> list[dict]:
    """file, group, name, query and either tag or sector and subsectors of each group of the files ``File <n>...txt`` of a folder, by file and place."""
    out = []
    for path in sorted(Path(folder).glob("File *.txt"), key=lambda p: int("".join(c for c in p.name.split()[1] if c.isdigit()) or 0)):
        number = int("".join(c for c in path.name.split()[1].split("_")[0] if c.isdigit()))
        for g in parse_group_file(path.read_text(encoding="utf-8")):
            sector, parts = SECTORS.get((number, g["group"]), (None, []))
            of = {"tag": g["name"]} if number == TAGGED else {"sector": sector, "subsectors": parts}
            out.append({"file": number, "group": g["group"], "name": g["name"], "query": g["query"]} | of)
    return out


def any_group(groups: list[dict]) -> str:
    """One query for any of the groups."""
    return " OR ".join(f"({g['query']})" for g in groups)


def one_search(source: str | None = None, weather_terms: bool = False, utility: str | None = None, groups: list[dict] | None = None, query: str | None = None, with_tags: bool = False) -> str | None:
    """The query of the one search that is asked for (None for a lookup of the ids in ``source``); any other number is an error."""
    asked = [x for x in (source, weather_terms, utility, groups, query) if x]
    if len(asked) != 1:
        raise ValueError("ask for exactly one of source, weather_terms, utility, groups and query")
    if with_tags and not groups:
        raise ValueError("tags need groups")
    return None if source else weather() if weather_terms else any_group(groups) if groups else utility or query
