"""Units of measure: spellings, sizes, and where a record states the unit of its value.

Pure Python on single values; tessella.operators.units runs it in Arrow batches.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from functools import lru_cache

#: Size of each unit in the common unit of its dimension, and its spellings in the form of `spelling()`.
#: Metric and international sizes; fanegada, plaza, cuadra, vara, legua, arroba, quintal, carga and libra are the legal
#: sizes in Colombia.
UNITS = {
    "area": {
        1.0: "ha has hectarea hectareas hm2",
        100.0: "km2 kms2|kilometro cuadrado|kilometros cuadrados",
        1e-4: "m2 mts2 mt2|metro cuadrado|metros cuadrados",
        0.40468564224: "ac acre acres",
        0.64: "fg fanegada fanegadas plaza plazas",
        1e-8: "cm2|centimetros cuadrados",
        0.01: "dam2|decametros cuadrados",
        258.9988110336: "mi2|milla cuadrada|millas cuadradas",
    },
    "length": {
        1.0: "km kms kilometro kilometros",
        1e-3: "m mt mts ml metro metros|metro lineal|metros lineales",
        0.1: "hm hectometro hectometros",
        1e-2: "dam decametro decametros",
        1e-5: "cm cms centimetro centimetros",
        1e-6: "mm milimetro milimetros",
        1.609344: "mi milla millas",
        1.852: "nmi|milla nautica|millas nauticas",
        5.0: "legua leguas",
        8e-4: "vara varas",
        0.08: "cuadra cuadras",
        3.048e-4: "ft pie pies",
    },
    "population": {1.0: "hab habs habitante habitantes persona personas poblador pobladores"},
    "money": {1.0: "$ cop peso pesos|col$|peso colombiano|pesos colombianos|pesos m/cte"},
    "flow": {
        1.0: "l/s lps lt/seg lt/s lts/s lts/seg l/seg|l s-1|l s⁻¹|litro por segundo|litros por segundo",
        1e3: "m3/s m3/seg|metro cubico por segundo|metros cubicos por segundo",
        1 / 60: "l/min|litros por minuto",
        1 / 3600: "l/h l/hora|litros por hora",
        1 / 86400: "l/d l/dia|litros por dia",
        1e3 / 60: "m3/min|metros cubicos por minuto",
        1e3 / 3600: "m3/h m3/hora|metros cubicos por hora",
        1e3 / 86400: "m3/d m3/dia|metros cubicos por dia",
    },
    "volume": {
        1.0: "m3 mts3 mt3|metro cubico|metros cubicos",
        1e-3: "l lt lts litro litros dm3",
        1e-6: "ml mililitro mililitros cm3",
        1e3: "dam3|decametros cubicos",
        1e6: "hm3|hectometro cubico|hectometros cubicos",
        1e9: "km3|kilometros cubicos",
    },
    "share": {
        1.0: "% pct porcentaje|por ciento|por cien|por 100",
        0.1: "‰|por mil|por cada mil|por 1000",
        100.0: "fraccion proporcion|tanto por uno|proporcion (0-1)",
    },
    "density": {
        1.0: "hab/km2|hab por km2|habitantes/km2|habitantes por km2|personas/km2|personas por km2|hab por kilometro cuadrado|habitantes por kilometro cuadrado",
        100.0: "hab/ha hab/has|hab por ha|habitantes/ha|habitantes por ha|personas por ha|hab por hectarea|habitantes por hectarea",
        1e6: "hab/m2|hab por m2|habitantes por m2|habitantes por metro cuadrado",
    },
    "rain": {
        1.0: "mm milimetro milimetros mm/año mm/a l/m2|mm anuales|mm al año|litros por metro cuadrado",
        10.0: "cm centimetro centimetros cm/año|cm anuales|cm al año",
        1e3: "m mt mts metro metros m/año",
        25.4: "in pulgada pulgadas",
    },
    "temperature": {"c": "°c c celsius|grado celsius|grados celsius|grado centigrado|grados centigrados", "f": "°f f fahrenheit|grado fahrenheit|grados fahrenheit", "k": "k °k kelvin kelvins|grados kelvin"},
    "energy": {
        1.0: "mwh|mw h|megavatio hora|megavatios hora",
        1e3: "gwh|gw h|gigavatio hora|gigavatios hora",
        1e-3: "kwh|kw h|kilovatio hora|kilovatios hora",
        1e6: "twh|teravatios hora",
        1e-6: "wh|vatios hora",
    },
    "mass": {
        1.0: "t tn ton tons tm tonelada toneladas|tonelada metrica|toneladas metricas",
        1e-3: "kg kgs kilo kilos kilogramo kilogramos",
        1e3: "kt kilotonelada kilotoneladas",
        1e-6: "g gr grs gramo gramos",
        0.0125: "arroba arrobas",
        0.05: "quintal quintales",
        0.125: "carga cargas",
        5e-4: "lb lbs libra libras",
    },
}
#: Number words before a unit. A Spanish billón is a million millions.
SCALES = {"mil": 1e3, "miles": 1e3, "millon": 1e6, "millones": 1e6, "mill": 1e6, "mm": 1e6, "mil millones": 1e9, "miles de millones": 1e9, "billon": 1e12, "billones": 1e12}
#: Fixed values: °C = value * a + b.
TEMPERATURES = {"c": (1.0, 0.0), "f": (5 / 9, -160 / 9), "k": (1.0, -273.15)}


def spelling(text: str | None) -> str:
    """A unit's spelling without case, accents, dots, double spaces, raised digits and damage by a wrong decoding."""
    text = (text or "").replace("Â", "").replace("º", "°").replace("˚", "°").lower().replace("ñ", "\0")
    text = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn").replace("\0", "ñ")
    text = text.replace("²", "2").replace("³", "3").replace("⁻¹", "-1").replace("^", "").replace(".", " ")
    text = re.sub(r"\s+", " ", text.replace(" ", " ")).strip(" ,;:")
    return re.sub(r"\s*/\s*", "/", text)


def _by_spelling() -> dict[str, dict[str, tuple[float, float]]]:
    out: dict[str, dict[str, tuple[float, float]]] = {}
    for dimension, sizes in UNITS.items():
        own = out[dimension] = {}
        for size, said in sizes.items():
            linear = TEMPERATURES[size] if isinstance(size, str) else (size, 0.0)
            first, *rest = said.split("|")
            for name in [*(first.split() if all(x in said for x in first.split()) else [first]), *rest]:
                own[name] = linear
    return out


#: By dimension and spelling: (a, b) of amount = value * a + b.
BY_SPELLING = _by_spelling()
#: Dimensions whose units number words go with, and up to which.
SCALED_BY = {"money": 1e12, "population": 1e6, "area": 1e6, "volume": 1e6, "mass": 1e6, "energy": 1e6, "length": 1e3}


def all_units(dimension: str) -> list[tuple[float, float]]:
    """Every (a, b) that a value of the dimension may have, number words included."""
    own = set(BY_SPELLING[dimension].values())
    words = [1.0, *(w for w in (1e3, 1e6, 1e9, 1e12) if w <= SCALED_BY.get(dimension, 1.0))]
    return sorted({(a * w, b) for a, b in own for w in words if w == 1.0 or b == 0})


_SCALED = re.compile(r"(mil millones|miles de millones|millones|millon|mill|miles|mil|billones|billon)(?: de)? (.+)")


@lru_cache(maxsize=65536)
def unit(dimension: str, text: str) -> tuple[float, float] | None:
    """(a, b) of the unit that `text` spells in a dimension, number words included; null if it spells none."""
    said = spelling(text)
    known = BY_SPELLING.get(dimension, {})
    if said in known:
        return known[said]
    if m := _SCALED.fullmatch(said):
        base = known.get(m[2])
        if base and base[1] == 0:
            return base[0] * SCALES[m[1]], 0.0
    return None


_YEAR = re.compile(r"\s+(?:19|20)\d\d\s*$")
_TAIL = re.compile(r"\(((?:[^()]|\([^()]*\))*)\)\s*$|\[([^\[\]]*)\]\s*$|\s[-–—]\s+(.+)$|:\s+(.+)$|,\s*en\s+(.+)$")


@lru_cache(maxsize=65536)
def label_statement(dimension: str, label: str) -> tuple[tuple[float, float] | None, float]:
    """The unit that a label states at its end, and a bare number word like `(en miles)` (1 if none)."""
    text = _YEAR.sub("", label.strip())
    for m in _TAIL.finditer(text):
        said = next(x for x in m.groups() if x is not None).strip()
        if found := unit(dimension, said):
            return found, 1.0
        bare = re.sub(r"^en\s+", "", spelling(said))
        if bare in SCALES:
            return None, SCALES[bare]
        if found := unit(dimension, re.sub(r"(?i)^en\s+", "", said)):
            return found, 1.0
    return None, 1.0


_HEAD = re.compile(r"^\s*\(?\s*(?i:(?:valores|cifras|datos|montos)\s+(?:expresad[oa]s\s+)?en|unidad(?:es)?(?:\s+de\s+medida)?:)\s+")
#: Where a heading may end; a dot before lower case belongs to an abbreviation like `hab. por km2`.
_HEAD_END = re.compile(r"\)(?=[\s.])|\.(?=\s+[A-ZÁÉÍÓÚÑ])")
_NUMBER = re.compile(r"[-−]?\d(?:[\d.,'’   ]*\d)?")


def readings(text: str) -> set[float]:
    """The numbers that digits with separators may mean: points or commas for thousands or decimals, spaces between."""
    sign = -1.0 if text[:1] in "-−" else 1.0
    text = re.sub(r"[-−'’   ]", "", text)
    out = set()
    for thousands, decimal in ((".", ","), (",", ".")):
        whole, *rest = text.replace(thousands, "").split(decimal)
        if len(rest) < 2:
            out.add(sign * float(f"{whole or 0}.{rest[0] if rest else 0}"))
    return out


_NO_DIGITS = {c: None for c in range(0x250) if not chr(c).isdigit()} | {0x2212: None, 0x2019: None, 0x202F: None}


def _digits(number: str) -> str:
    """The digits of a number between its first and last that are not zero: a quick test before readings()."""
    return number.partition("e")[0].translate(_NO_DIGITS).strip("0")


def _near(a: float, b: float) -> bool:
    return abs(a - b) <= 1e-9 * max(abs(a), abs(b), 1e-30)


def context_statement(dimension: str, value: float | None, context: str) -> tuple[float, float] | None:
    """The unit that a context states for the value: right after (for money also before) the number that is the value, in
    brackets or after `expresado en` in the rest of its clause, or in a heading like `Valores en ha` before the text. Units of other numbers in the context do not count."""
    if value is not None:
        digits = _digits(f"{abs(value):.15g}") if abs(value) < 1e15 else _digits(str(int(abs(value))))
        at = 0
        while m := _NUMBER.search(context, at):
            said, begin = m.group(), m.start()
            hit = _digits(said) == digits and any(_near(x, value) for x in readings(said))
            if not hit and " " in said:  # spaces may part numbers as well as thousands
                said = said.split(" ")[0]
                hit = _digits(said) == digits and any(_near(x, value) for x in readings(said))
            at = end = begin + len(said)
            if hit:
                if found := _after(dimension, context, end) or _in_clause(dimension, context, end):
                    return found
                if dimension == "money" and re.search(r"(?:\$|COP)\s*$", context[max(0, begin - 5) : begin]):
                    return 1.0, 0.0
    if m := _HEAD.match(context):
        return _heading(dimension, context, m.end())
    return None


def _heading(dimension: str, context: str, at: int) -> tuple[float, float] | None:
    """The unit that the longest heading at a place of a text spells; a closing bracket at its end may be the unit's."""
    words = list(itertools.islice(_WORDS.finditer(context, at), MOST_WORDS + 1))
    text = context[at : words[-1].end() + 2] if words else ""
    for end in reversed([m for m in _HEAD_END.finditer(text) if m.start()]):
        for part in (text[: end.end()], text[: end.start()]):
            if found := unit(dimension, part):
                return found
    return None


_WORDS = re.compile(r"\S+")
#: No spelling of a unit has more words, number words before it included.
MOST_WORDS = 4 + max(len(x.split(" ")) for own in BY_SPELLING.values() for x in own)
#: Words with which a unit may begin, by dimension.
_BEGIN = {dimension: {x.split(" ")[0] for x in own} | {x.split(" ")[0] for x in SCALES} for dimension, own in BY_SPELLING.items()}


@lru_cache(maxsize=65536)
def _begins(dimension: str, word: str) -> bool:
    return spelling(word).split(" ")[0] in _BEGIN.get(dimension, ())


def _after(dimension: str, context: str, at: int) -> tuple[float, float] | None:
    """The unit with the most words right at a place of a text, after any white space."""
    words = list(itertools.islice(_WORDS.finditer(context, at), MOST_WORDS))
    if not words or not _begins(dimension, words[0].group()):
        return None
    for m in reversed(words):
        if found := unit(dimension, context[at : m.end()].rstrip(",;:)")):
            return found
    return None


#: The rest of a clause: up to a stop, a semicolon or the next number, in which case units are that number's.
_CLAUSE = re.compile(r"(?:[^.;\d]|\.(?!\s|$)|(?<=[^\W\d_])[23])*")
_SAID = re.compile(r"[(\[]\s*([^()\[\]]+?)\s*[)\]]|(?i:\b(?:expresad[oa]s?|medid[oa]s?|dad[oa]s?|calculad[oa]s?)\s+en)\s+")


def _in_clause(dimension: str, context: str, at: int) -> tuple[float, float] | None:
    """The unit that the clause after a number states in brackets or after words like `expresado en`, however far on."""
    clause = _CLAUSE.match(context, at)
    for m in _SAID.finditer(context, at, clause.end()):
        found = unit(dimension, m[1]) if m[1] else _after(dimension, context, m.end())
        if found:
            return found
    return None
