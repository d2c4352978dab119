"""The classification in SQL, with patterns of its own: written from the survey for DuckDB's expressions, not taken from the rules."""

from __future__ import annotations


def number(codes: str) -> str:
    """One of these numbers, touched by no digit."""
    return f"(^|[^0-9])({'|'.join(codes.split())})([^0-9]|$)"


def word(*alternatives: str) -> str:
    return rf"\b({'|'.join(alternatives)})\b"


_END = "([^0-9]|$)"

# For each brand, what its manufacturer and models match, are left out for, are trusted for, and are too large for.
BRANDS = {
    "cessna": (
        [word("CESSNA", "REIMS")],
        [number("120 140 145 150 152 162 165 170 172 175 177 180 182 185 190 195 205 206 207 210 240 310 320 335 336 337 340 400 401 402 404 411 414 421")],
        ["CITATION", "CARAVAN", "CONQUEST", "CORSAIR", "BOBCAT", "BIRD ?DOG", "MUSTANG", "SOVEREIGN", "ENCORE", "EXCEL", "AGWAGON", "AGTRUCK", "AG ?HUSKY", "AGPICKUP",
         word("XLS", "T-?37", "T-?41", "O-?1A?", "O-?2A?", "L-19"), number("188 208 406 425 441 500 501 510 525 526 530 550 551 560 650 680 700 750")],
        [number("150 152 172 177 180 182 185 206 207 210")],
        [number("401 402 404 411 414 421")],
    ),
    "piper": (
        [word("PIPER")],
        [r"PA[.\-\s]?(11|12|14|15|16|17|18|19|20|22|23|24|28|29|30|31|32|34|38|39|44|46|60)" + _END, r"\bJ-?[2-5][A-Z]{0,3}(-[0-9]+)?", word("E-2", "L-?4[A-Z]?", "L-?18[A-Z]?", "L-?21[A-Z]?", "CUB", "PACER", "COLT", "ARROW"),
         "AEROSTAR", "CHEROKEE", "COMANCHE", "ARCHER", "WARRIOR", "TOMAHAWK", "SARATOGA", "SENECA", "MALIBU", "MIRAGE", "MATRIX", "NAVAJO", "CHIEFTAIN", "AZTEC", "APACHE", "VAGABOND", "CLIPPER", "SEMINOLE", "DAKOTA"],
        ["CHEYENNE", "JETPROP", "MERIDIAN", word("M500", "M600"), "500TP", "600TP", "PAWNEE", r"PA[.\-\s]?(25|36|42)\b", "PA-?31T"],
        [r"PA[.\-\s]?(28|32|34|38|44)" + _END],
        ["PA-?31", "NAVAJO", "CHIEFTAIN"],
    ),
    "beech": (
        [word("BEECH", "BEECHCRAFT", "RAYTHEON")],
        [number("19 23 24 33 35 36 55 56 58 60 65 70 76 77 80 95"), "BONANZA", "DEBONAIR", word("BARON", "SIERRA", "DUKE"), "MUSKETEER", "SUNDOWNER", "DUCHESS", "SKIPPER", "QUEEN ?AIR", "TRAVEL ?AIR", "TWIN BONANZA"],
        [word("A90", "UTE", "1900", "SNB", "T-?6[A-Z]?"), "65-?90", "U-?21", "RC-?12", "JC-?12", "QU-?22", "RU-?21", "GU-?21", r"L-?23[A-Z]?\b", "KING ?AIR", "HAWKER", "PREMIER", "BEECHJET", "NEXTANT", "T-?34", "MENTOR", "TEXAN",
         "T-?1A", "JAYHAWK", "T-?44", "PEGASUS", "C-?12", "HURON", "EXPEDITOR", "C-?45", "D-?18", "D18S", "STAGGERWING", "KANSAN", "AT-?11", r"AT-?7\b", "VOLPAR", "TRADEWIND", "SHADOW", "AVENGER", "LIBERTY"],
        ["BONANZA", "MUSKETEER", "SUNDOWNER", "DUCHESS", "SKIPPER", word("BARON", "SIERRA")],
        [word("DUKE", "B60", "A60"), number("60"), "QUEEN ?AIR", number("65 70 80 88")],
    ),
    "cirrus": ([word("CIRRUS")], ["SR-?20", "SR-?22"], ["VISION", word("SF-?50", "JET")], ["SR-?20", "SR-?22"], []),
    "mooney": ([word("MOONEY")], [r"M[.\-]?(10|18|20|22)"], [], [r"M[.\-]?20"], []),
    "socata": ([word("SOCATA")], ["RALLYE", r"\bST[.\-]?10\b", r"TB[.\-\s]?(200|21|20|10|9)" + _END], [], [r"TB[.\-\s]?(9|10|20|21)" + _END], []),
    "robin": (
        [word("ROBIN")],
        [r"\bDR[.\-\s]?(300|315|340|360|380|400|500)" + _END, r"\bHR[.\-\s]?(100|200)" + _END, r"\bR[.\-\s]?(1180|2160|2112|2100|2120|3000)" + _END, word("ATL")],
        [], [r"\bDR[.\-\s]?400" + _END], [],
    ),
    "diamond": (
        [word("DIAMOND")],
        [r"\bDA[.\-\s]?(20|40|42|50|62)" + _END, r"\bDV[.\-\s]?20" + _END, "KATANA", "TWIN ?STAR", "DIAMOND STAR"],
        [r"HK[.\-\s]?36", "DIMONA"], [r"\bDA[.\-\s]?(20|40|42)" + _END], [],
    ),
    "bellanca": (
        [word("BELLANCA", "CHAMPION")],
        [word("7[A-Z]{1,5}", "8[GK][A-Z]{1,5}", "SCOUT", "CHAMP", "SEDAN"), "14-[0-9]{1,2}", "17-30", "17-31", "CITABRIA", "DECATHLON", "VIKING", "CHIEF", "CRUISAIR", "CRUISEMASTER", "PACEMAKER", "SKYROCKET", "CH-?300", "CH-?400", "TRAVELER", "TRAVELLER"],
        ["KITFOX", word("RANS"), "VANS", "VAN'S", r"\bRV-?[0-9]", "GLASAIR", "LANCAIR"], [], [],
    ),
    "aeronca": (
        [word("AERONCA")],
        [word("7[A-Z]{1,4}", "11[A-Z]{1,3}", "15AC", "K[A-Z]{0,2}", "C-?2", "C-?3", "LC", "LB", "SEDAN", "SCOUT"), r"65-?[A-Z]{1,3}\b", "CHAMP", "CHIEF", "DEFENDER"],
        [word("PT-?19", "PT-?23", "O-?58[A-Z]?", "L-?3[BC]?", "L-?16[A-Z]?"), "GRASSHOPPER"], [], [],
    ),
    "taylorcraft": (
        [word("TAYLORCRAFT")],
        [word("BC", "BL", "BF"), r"\bBC-?12[A-Z0-9-]*", r"\b(BL|BF|DC|DCO|DF|DL)-?[0-9]+[A-Z0-9-]*", r"\bBCS-?[0-9]*[A-Z0-9-]*", word("F-?19", "F-?21[A-Z]?", "F-?22[A-Z]?", "19", "20"), "PLUS ?D", "SPORTSMAN", "TWOSOME"],
        ["AUSTER"], [], [],
    ),
    "luscombe": ([word("LUSCOMBE")], [word("8[A-Z]{0,2}X?", "11A", "11E"), "SILVAIRE", "PHANTOM"], [], [], []),
    "stinson": (
        [word("STINSON"), "VULTEE"],
        [number("108 10"), "VOYAGER", "RELIANT", "HW-?75", "SR-?[0-9]"],
        ["VALIANT", word("BT-?13", "BT-?15", "SNV", "PBY", "L-?1[3F]?", "AT-?19"), "CONVAIR"], [], [],
    ),
}
_NEVER = ["HELICOPTER", "ROTORCRAFT", "GYROCOPTER", "GYROPLANE", "SAILPLANE", "MOTORGLIDER", "BALLOON", "AIRSHIP", word("GLIDER")]
_MILITARY = [word("L-?4[A-Z]?", "L-?18[A-Z]?", "L-?21[A-Z]?", "C-?145")]


def _any(column: str, patterns: list[str]) -> str:
    return "(" + (" OR ".join(f"regexp_matches({column}, '{p.replace(chr(39), chr(39) * 2)}')" for p in patterns) or "false") + ")"


_OWN = {name: _any("maker", makers) for name, (makers, *_) in BRANDS.items()}
BASE = "(" + " OR ".join(f"({_OWN[n]} AND {_any('mdl', b[1])} AND NOT {_any('mdl', b[2])})" for n, b in BRANDS.items()) + f") AND NOT {_any('mdl', _NEVER)}"
_TRUSTED = "(" + " OR ".join(f"({_OWN[n]} AND {_any('mdl', b[3])})" for n, b in BRANDS.items() if b[3]) + ")"
_LARGE = "(" + " OR ".join(f"({_OWN[n]} AND {_any('mdl', b[4])})" for n, b in BRANDS.items() if b[4]) + ")"
STRICT = f"{_any('mdl', _MILITARY)} OR ((typ LIKE 'H%' OR typ LIKE '%J' OR typ LIKE '%T') AND NOT {_TRUSTED}) OR {_LARGE}"
HEX = "length(trim(coalesce(icao24, ''))) = 6 AND NOT regexp_matches(trim(coalesce(icao24, '')), '[^0-9a-fA-F]')"
