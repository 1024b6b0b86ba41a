"""Addresses: known ones of a row, US addresses in general, recognised places."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from scrubline import resources as R
from scrubline.functions.hashing import keyed_index
from scrubline.functions.spans import FINDINGS, MARK, find_spans, joined, let, none_found

KNOWN, GENERAL = "deid-location-knownaddr", "deid-location-general"
TYPE = "location"

_STATE = "|".join(sorted((x.replace(" ", r"\s") for pair in R.STATES.items() for x in pair), key=lambda s: (-len(s), s)))
US_ADDRESS = rf"(?i)\b(p\.?\s?o\.?\b|post office|\d{{1,6}})\s*([^(\[\]]{{0,40}}?)\b({_STATE})\s+(\d{{5}}(?:-\d{{4}})?)"


_TYPE = "|".join(sorted((x for full, short in R.STREET_TYPES.items() for x in (full, *short)), key=lambda s: (-len(s), s)))
_SIDE = "|".join(sorted(R.COMPASS, key=lambda s: (-len(s), s)))
_UNIT = "|".join(sorted(R.UNITS, key=lambda s: (-len(s), s)))
_WORD = r"[\p{L}\p{Nd}'’.-]+"
_NUMBER = r"\d{1,6}[A-Za-z]?"
#: Codes only in capitals, since some are words; names in any case.
_CODE = "|".join(sorted(R.STATES.values()))
_STATE_PART = f"(?:{_CODE})|(?i:" + "|".join(sorted((x.replace(" ", r"\s+") for x in R.STATES), key=lambda s: (-len(s), s))) + ")"

#: An address as a whole, from what may stand first to what may stand last; every part may be missing.
_GRAMMAR = (
    rf"^\s*(?:(?:({_NUMBER})\s+)?(?:(?i:({_SIDE}))\.?\s+)?({_WORD}(?:\s+{_WORD}){{0,4}}?)\s+(?i:({_TYPE}))\b\.?(?=[\s,]|$)"
    rf"|({_NUMBER})\s+(?:(?i:({_SIDE}))\.?\s+)?({_WORD}(?:\s+{_WORD}){{0,4}}?)(?=\s*,)"
    rf"|((?i:p\.?\s*o\.?\s*box)\s+\d+))?"
    rf"(?:[\s,]*((?i:{_UNIT})\.?\s*#?\s*(?=[^\s,]*\d)[\p{{L}}\p{{Nd}}-]+))?"
    rf"(?:[\s,]*(?!(?:{_CODE})(?:[\s,]+\d{{5}}(?:-\d{{4}})?)?[\s.,]*$)(\p{{L}}[\p{{L}}.'’ -]*?))?(?:(?:^|[\s,]+)({_STATE_PART}))?(?:(?:^|[\s,]+)(\d{{5}}(?:-\d{{4}})?))?[\s.,]*$"
)
#: The groups of the grammar that a part is in.
_GROUPS = {"number": (1, 5), "compass": (2, 6), "street": (3, 7), "kind": (4,), "box": (8,), "unit": (9,), "city": (10,), "state": (11,), "zip": (12,)}
PARTS = tuple(_GROUPS)


#: What takes an address' place to be cut into its groups; a mark ends the last one, since a line end may follow.
_AS_GROUPS = MARK + MARK.join(f"${g}" for g in range(1, 13)) + MARK


def parts_of(address: Column) -> Column:
    """A struct of an address' parts (PARTS), those that are missing null; all null where it is none.

    The grammar is matched once; no group of it takes a mark, and an address that holds one is none.
    """
    def named(found: Column) -> Column:  # where nothing matched there is one piece, and no group in its place
        each = {name: [F.get(found, F.lit(g)) for g in groups] for name, groups in _GROUPS.items()}
        return F.struct(*[(F.coalesce(*x) if len(x) > 1 else x[0]).alias(name) for name, x in each.items()])

    known = F.when(~F.contains(address, F.lit(MARK)), address)
    found = F.split(F.regexp_replace(known, _GRAMMAR, _AS_GROUPS), MARK, -1)
    return let(F.transform(found, lambda x: F.when(x != "", x)), named)


def surrogate_like(word: Column, person: Column, salt: str) -> Column:
    """A surrogate with the parts that an address has; where it has none, a city."""
    listed = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(("street", "kind", "city", "code", "zip"), a, strict=True)]) for a in R.ADDRESSES])
    names = F.create_map(*[F.lit(x) for name, code in R.STATES.items() for x in (code, name)])
    keyed = lambda mark, n: keyed_index(salt + mark, person, word, n).cast("string")
    sides = F.array(*[F.lit(x) for x in R.COMPASS[-4:]])

    def rendered(a: Column) -> Column:
        p, new = a["parts"], a["new"]
        there = lambda c, value: F.when(c.isNotNull(), value)
        line = F.concat_ws(" ", there(p["number"], keyed("#", 1000)), there(p["compass"], F.element_at(sides, (keyed_index(salt + "#side", person, word, 4) + 1).cast("int"))),
                           there(p["street"], new["street"]), there(p["kind"], new["kind"]), there(p["box"], F.concat(F.lit("PO Box "), keyed("#box", 10_000))))
        unit = there(p["unit"], F.concat(F.trim(F.regexp_extract(p["unit"], r"^(?i:" + _UNIT + r")\.?", 0)), F.lit(" "), keyed("#unit", 90)))
        state = F.when(F.length(p["state"]) == 2, new["code"]).when(p["state"].isNotNull(), F.element_at(names, new["code"]))
        code = F.when(F.length(p["zip"]) > 5, F.concat(new["zip"], F.lit("-"), F.lpad(keyed("#zip", 10_000), 4, "0"))).when(p["zip"].isNotNull(), new["zip"])
        filled = lambda c: let(c, lambda x: F.when(x != "", x))
        whole = F.concat_ws(", ", filled(line), unit, there(p["city"], new["city"]), filled(F.concat_ws(" ", state, code)))
        return F.coalesce(filled(whole), new["city"])

    at = (keyed_index(salt, person, word, len(R.ADDRESSES)) + 1).cast("int")
    return let(F.struct(parts_of(word).alias("parts"), F.element_at(listed, at).alias("new")), rendered)


@dataclass(frozen=True)
class Known:
    """Columns of a known address; those that are None are left out."""

    line1: Column | None = None
    line2: Column | None = None
    city: Column | None = None
    zip: Column | None = None
    state: Column | None = None


def surrogate(word: Column, person: Column, salt: str, parts: str = "full") -> Column:
    """An address of the dictionary: ``full``, or ``city`` for the city alone."""
    listed = F.array(*[F.lit(f"{s} {t}, {c} {st} {z} " if parts == "full" else c) for s, t, c, st, z in R.ADDRESSES])
    at = keyed_index(salt, person, word, len(R.ADDRESSES)) + 1
    out = F.element_at(listed, at.cast("int"))
    if parts != "full":
        return out
    return F.concat(keyed_index(salt + "#", person, word, 1000).cast("string"), F.lit(" "), out)


def _loose(value: Column) -> Column:
    """A pattern for a value: what is no letter or digit stands for any character."""
    return F.regexp_replace(F.trim(value), r"[^\p{L}\p{N}]", ".")


def _or_empty(value: Column | None) -> Column:
    return F.coalesce(value.cast("string"), F.lit("")) if value is not None else F.lit("")


def known(text: Column, address: Known, person: Column, salt: str, city_only: bool = False) -> Column:
    """A row's known address: from house number and street on (with or without a compass letter
    and the type), or city with state or zip."""
    line1, line2, city, code, state = (_or_empty(x) for x in (address.line1, address.line2, address.city, address.zip, address.state))
    gap = r"[\s.,]+"
    zip5 = F.substring(code, 1, 5)
    optional = lambda value, before: F.when(F.trim(value) != "", F.concat(F.lit(f"(?:{before}"), _loose(value), F.lit(")?"))).otherwise(F.lit(""))
    tail = F.concat(optional(city, gap), optional(state, gap))
    zip_part = F.when(zip5 != "", F.concat(F.lit(f"(?:{gap}"), zip5, F.lit(r"(?:-\d{4})?)?"))).otherwise(F.lit(""))
    line = F.trim(line1)
    number = F.regexp_extract(line, rf"^({_NUMBER})\s+\S", 1)
    bare = F.regexp_replace(F.regexp_replace(line, rf"^{_NUMBER}\s+(?:(?i:{_SIDE})\.?\s+)?", ""), rf"(?i)\s+(?:{_TYPE})\.?$", "")
    # a compass letter and the street's type, in any form, may be in the text or not
    street = F.when((number != "") & (bare != ""), F.concat(
        F.lit(r"(?iu)\b"), number, F.lit(rf"\s+(?:(?:{_SIDE})\.?\s+)?"), _loose(bare), F.lit(rf"(?![\p{{L}}\p{{N}}])(?:\s+(?:{_TYPE})\b)?"), optional(line2, gap), tail, zip_part))
    place = F.when(F.length(F.trim(city)) > 2, F.concat(F.lit(r"(?iu)\b"), _loose(city), optional(state, gap), zip_part, F.lit(r"\b")))
    find = lambda pattern, kind: let(pattern, lambda p: F.when(
        p.isNotNull(), find_spans(text, p, TYPE, None, KNOWN, lambda w: surrogate(w, person, salt, kind))).otherwise(none_found()))
    return find(place, "city") if city_only else joined(find(street, "full"), find(place, "city")).cast(FINDINGS)


def general(text: Column, person: Column, salt: str) -> Column:
    """US addresses: a number or post office box, up to 40 characters, state and zip."""
    return find_spans(text, US_ADDRESS, TYPE, None, GENERAL, lambda w: surrogate(w, person, salt))


@cache
def country_names() -> tuple[str, ...]:
    """The countries' English names that the JVM knows (some 250), and the library's own short forms."""
    locale = SparkSession.active()._jvm.java.util.Locale
    known = {locale("", code).getDisplayCountry(locale.ENGLISH) for code in locale.getISOCountries()}
    return tuple(sorted({*known, *R.COUNTRIES}))


def recognised(ner: Column, person: Column, salt: str) -> Column:
    """Surrogates for recognised places other than states and countries, with the parts that
    a place has: a city for a city, and for an address its number, street, zip and so on."""
    fixed = F.array(*[F.lit(x.lower()) for x in [*R.STATES, *R.STATES.values(), *country_names()]])
    new = F.filter(ner, lambda n: ~F.array_contains(fixed, F.lower(n["word"])))
    return F.transform(new, lambda n: n.withField("replacement", surrogate_like(n["word"], person, salt))).cast(FINDINGS)
