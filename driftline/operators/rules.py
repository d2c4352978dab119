"""Which aircraft are conventional light ones: rules by manufacturer and model, as data."""

from __future__ import annotations

from dataclasses import dataclass


def codes(*numbers: int) -> str:
    """A pattern for model numbers that no digit touches."""
    return "|".join(f"(?<![0-9]){n}(?![0-9])" for n in numbers)


def words(text: str) -> str:
    """A pattern for whole words."""
    return "|".join(rf"\b{w}\b" for w in text.split())


def numbered(prefix: str, *numbers: int, between: str = r"[.\-\s]?", end: str = "(?![0-9])") -> str:
    """A pattern for letters and one of some numbers, what may stand between them, and what may not follow."""
    return rf"{prefix}{between}({'|'.join(map(str, numbers))}){end}"


def any_of(*patterns: str) -> str:
    return "|".join(patterns)


@dataclass(frozen=True)
class Rule:
    """Kept are models of the brand that ``keep`` finds and ``drop`` doesn't; ``trusted`` ones outweigh a wrong type code."""

    name: str
    brand: str
    keep: str
    drop: str = ""
    trusted: str = ""
    too_large: str = ""


# Names, model numbers and patterns of the classification.
NEVER = any_of("HELICOPTER|ROTORCRAFT|GYROCOPTER|GYROPLANE|SAILPLANE|MOTORGLIDER|BALLOON|AIRSHIP", words("GLIDER"))
MILITARY = words("L-?4[A-Z]? L-?18[A-Z]? L-?21[A-Z]? C-?145")
TYPE_CODE = "^H|[JT]$"
HEX_ID = "^[0-9a-fA-F]{6}$"
RULES = (
    Rule(
        "CESSNA",
        words("CESSNA REIMS"),
        codes(120, 140, 145, 150, 152, 162, 165, 170, 172, 175, 177, 180, 182, 185, 190, 195, 205, 206, 207, 210, 240, 310, 320, 335, 336, 337, 340, 400, 401, 402, 404, 411, 414, 421),
        any_of(
            "CITATION|CARAVAN|CONQUEST|CORSAIR|BOBCAT|BIRD ?DOG|MUSTANG|SOVEREIGN|ENCORE|EXCEL|AGWAGON|AGTRUCK|AG ?HUSKY|AGPICKUP",
            words("XLS T-?37 T-?41 O-?1A? O-?2A? L-19"),
            codes(188, 208, 406, 425, 441, 500, 501, 510, 525, 526, 530, 550, 551, 560, 650, 680, 700, 750),
        ),
        trusted=codes(150, 152, 172, 177, 180, 182, 185, 206, 207, 210),
        too_large=codes(401, 402, 404, 411, 414, 421),
    ),
    Rule(
        "PIPER",
        words("PIPER"),
        any_of(
            numbered("PA", 11, 12, 14, 15, 16, 17, 18, 19, 20, 22, 23, 24, 28, 29, 30, 31, 32, 34, 38, 39, 44, 46, 60),
            r"\bJ-?[2345][A-Z]{0,3}(-[0-9]+)?",
            words("E-2 L-?4[A-Z]? L-?18[A-Z]? L-?21[A-Z]? CUB PACER COLT ARROW"),
            "AEROSTAR|CHEROKEE|COMANCHE|ARCHER|WARRIOR|TOMAHAWK|SARATOGA|SENECA|MALIBU|MIRAGE|MATRIX|NAVAJO|CHIEFTAIN|AZTEC|APACHE|VAGABOND|CLIPPER|SEMINOLE|DAKOTA",
        ),
        any_of("CHEYENNE|JETPROP|MERIDIAN|500TP|600TP|PAWNEE|PA-?31T", words("M500 M600"), numbered("PA", 25, 36, 42, end=r"\b")),
        trusted=numbered("PA", 28, 32, 34, 38, 44),
        too_large="PA-?31|NAVAJO|CHIEFTAIN",
    ),
    Rule(
        "BEECH",
        words("BEECH BEECHCRAFT RAYTHEON"),
        any_of(
            codes(19, 23, 24, 33, 35, 36, 55, 56, 58, 60, 65, 70, 76, 77, 80, 95),
            "BONANZA|DEBONAIR|MUSKETEER|SUNDOWNER|DUCHESS|SKIPPER|QUEEN ?AIR|TRAVEL ?AIR|TWIN BONANZA",
            words("BARON SIERRA DUKE"),
        ),
        any_of(
            words("A90 UTE 1900 SNB T-?6[A-Z]?"),
            r"65-?90|U-?21|RC-?12|JC-?12|QU-?22|RU-?21|GU-?21|L-?23[A-Z]?\b|KING ?AIR|HAWKER|PREMIER|BEECHJET|NEXTANT|T-?34|MENTOR|TEXAN|T-?1A|JAYHAWK|T-?44|PEGASUS|C-?12",
            r"HURON|EXPEDITOR|C-?45|D-?18|D18S|STAGGERWING|KANSAN|AT-?11|AT-?7\b|VOLPAR|TRADEWIND|SHADOW|AVENGER|LIBERTY",
        ),
        trusted=any_of("BONANZA|MUSKETEER|SUNDOWNER|DUCHESS|SKIPPER", words("BARON SIERRA")),
        too_large=any_of(words("DUKE B60 A60"), codes(60), "QUEEN ?AIR", codes(65, 70, 80, 88)),
    ),
    Rule("CIRRUS", words("CIRRUS"), numbered("SR", 20, 22, between="-?", end=""), any_of("VISION", words("SF-?50 JET")), trusted=numbered("SR", 20, 22, between="-?", end="")),
    Rule("MOONEY", words("MOONEY"), numbered("M", 10, 18, 20, 22, between=r"[.\-]?", end=""), trusted=numbered("M", 20, between=r"[.\-]?", end="")),
    Rule("SOCATA", words("SOCATA"), any_of("RALLYE", numbered(r"\bST", 10, between=r"[.\-]?", end=r"\b"), numbered("TB", 9, 10, 20, 21, 200)), trusted=numbered("TB", 9, 10, 20, 21)),
    Rule(
        "ROBIN",
        words("ROBIN"),
        any_of(numbered(r"\bDR", 300, 315, 340, 360, 380, 400, 500), numbered(r"\bHR", 100, 200), numbered(r"\bR", 1180, 2100, 2112, 2120, 2160, 3000), words("ATL")),
        trusted=numbered(r"\bDR", 400),
    ),
    Rule(
        "DIAMOND",
        words("DIAMOND"),
        any_of(numbered(r"\bDA", 20, 40, 42, 50, 62), numbered(r"\bDV", 20), "KATANA|TWIN ?STAR|DIAMOND STAR"),
        any_of(numbered("HK", 36, end=""), "DIMONA"),
        trusted=numbered(r"\bDA", 20, 40, 42),
    ),
    Rule(
        "BELLANCA_CHAMPION",
        words("BELLANCA CHAMPION"),
        any_of(
            words("7[A-Z]{1,5} 8[GK][A-Z]{1,5} SCOUT CHAMP SEDAN"),
            "14-[0-9]{1,2}|17-3[01]|CITABRIA|DECATHLON|VIKING|CHIEF|CRUISAIR|CRUISEMASTER|PACEMAKER|SKYROCKET|CH-?300|CH-?400|TRAVELL?ER",
        ),
        any_of("KITFOX|VAN'?S|GLASAIR|LANCAIR", words("RANS"), r"\bRV-?[0-9]"),
    ),
    Rule(
        "AERONCA",
        words("AERONCA"),
        any_of(words("7[A-Z]{1,4} 11[A-Z]{1,3} 15AC K[A-Z]{0,2} C-?[23] LC LB SEDAN SCOUT"), r"65-?[A-Z]{1,3}\b", "CHAMP|CHIEF|DEFENDER"),
        any_of(words("PT-?19 PT-?23 O-?58[A-Z]? L-?3[BC]? L-?16[A-Z]?"), "GRASSHOPPER"),
    ),
    Rule(
        "TAYLORCRAFT",
        words("TAYLORCRAFT"),
        any_of(
            words("BC BL BF F-?19 F-?2[12][A-Z]? 19 20"),
            r"\bBC-?12",
            any_of(*[rf"\b{letters}-?[0-9]" for letters in "BL BF DC DCO DF DL".split()]),
            r"\bBCS",
            "PLUS ?D|SPORTSMAN|TWOSOME",
        ),
        "AUSTER",
    ),
    Rule("LUSCOMBE", words("LUSCOMBE"), any_of(words("8[A-Z]{0,2}X? 11[AE]"), "SILVAIRE|PHANTOM")),
    Rule(
        "STINSON",
        any_of(words("STINSON"), "VULTEE"),
        any_of(codes(108, 10), "VOYAGER|RELIANT|HW-?75|SR-?[0-9]"),
        any_of("VALIANT|CONVAIR", words("BT-?1[35] SNV PBY L-?1[3F]? AT-?19")),
    ),
)
