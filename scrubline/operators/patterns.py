"""Pattern detectors: contact data, identifiers, numbers, ages."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubline.functions.spans import Kept, cut, find_spans, findings_of, joined, none_found

# The patterns, types and detector names of the supported rules.
PHONE = r"\b(\+\d{1,2}\s)?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]\d{4}(\sext\s\d{1,5})?"
EMAIL = r"\b\S+@\S+\.\S+\b"
IPV4 = r"\b((25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)(\.|\b)){4}\b"
IPV6 = r"(?i)\b([A-F0-9]{1,4}:){7}[A-F0-9]{1,4}\b"
URL = r"(?i)(https?:\/\/)(www\.)?[-a-zA-Z0-9@:%._\+~#=]{2,256}\.[a-z]{2,6}\b([-a-zA-Z0-9@:%_\+.~#?&//=]*)"
SSN = r"\b\d{3}[\s.-]\d{2}[\s.-]\d{4}\b"
DIGITS = r"\b\d{6,}\b"
ACCOUNT = r"(?i)\b((Acc\.|Acct\.|Acct|Account)\s*(Number|Num|No|#)?\s*(is|:)?\s*)(\d[\d -]*\d)\b"
ORDER = r"(?i)\b((Order|Ord\.)\s*(Number|Num|No|#)?\s*(is|:)?\s*)(\d[\d -]*\d)\b"
ACCESSION = r"(?i)\b((ACCESSION|ACCE\.)\s*(Number|Num|No|#)?\s*(is|:)?\s*)([a-zA-Z-]{0,5}\d[\d -]*\d)\b"
MRN_LABELLED = (
    r"(?i:MR|MRN|Medical\s+Record|Medical\s+Rec|MED\s+REC)(?:\s+(?i:Number|Num|No))?(?:\s*(?i:is|:|#|#:))?\s*"
    r"([\d\(\)]*[\d -\(\)]*\d)\b"
)
MRN = [r"\b\d{3}-\d{2}-\d{2}(?:-\d)?\b", r"\b\d{3}-\d{2}-\d{4}(?:-\d)?\b", r"\b\d{7}-\d\b", r"\b\d{8}\b", r"\b\d{2}-\d{2}-\d{2}\b",
       MRN_LABELLED, r"\b\d{10}\b"]
HAR = r"(?i)\b(\bHAR[ ]{0,}?:[ ]{0,}?\b\d+)\b"
AGE = r"(?i)\b(?:1\d{2}|9\d)(?:\s*-?\s*)?(?:year[-|\s]+old|yr[-|\s]+old|y[/]?o|Y[,]?|years)\b"

GENERAL = [("general-phone", PHONE), ("general-email", EMAIL), ("general-ip", IPV4), ("general-ip", IPV6), ("general-url", URL),
           ("general-ssn", SSN), ("000000", DIGITS)]
NUMBERS = [("general-account", ACCOUNT), ("general-order", ORDER), ("general-accession", ACCESSION)]
HAR_REPLACEMENT = "[HAR : 00000000000]"
AGE_REPLACEMENT = "[90 year old]"


_WORD = r"[\p{L}\p{Nd}_]"
#: EMAIL in linear time.  A run without blanks holds at most one match, from its first word character
#: to its last (with marks on it), if there is an @ behind the first and a dot, not right behind the
#: first such @, before the last.  So each run is looked at once, from the blank before it; the second group is the match.
EMAIL_BY_RUN = rf"((?:\s|^)[^\s\p{{L}}\p{{Nd}}_]*+)({_WORD}[^\s@]*+@\S[^\s.]*+\.\S*(?:[\p{{L}}\p{{Nd}}]\p{{Mn}}*+|_))"

#: What a text must have for a pattern to match, cheaper to look for than the pattern itself:
#: a text without it costs no more.  A plain string is looked for as it is.
_NUMBER = "[0-9][0-9 -]*[0-9]"
GUARDS = {
    PHONE: r"[0-9]{3}[\s.-][0-9]{4}", EMAIL: "@", IPV4: r"[0-9]\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]", IPV6: "(?i):(?:[a-f0-9]{1,4}:){6}[a-f0-9]", URL: "://",
    SSN: r"[0-9]{2}[\s.-][0-9]{4}", DIGITS: "[0-9]{6}", ACCOUNT: _NUMBER, ORDER: _NUMBER, ACCESSION: _NUMBER, MRN_LABELLED: "[Mm](?:[Rr]|[Ee][Dd])", HAR: ":",
    AGE: r"[0-9][0-9][\s-]*[Yy]",
} | dict(zip((p for p in MRN if p != MRN_LABELLED), (
    "[0-9]{3}-[0-9]{2}-[0-9]{2}", "[0-9]{3}-[0-9]{2}-[0-9]{4}", "[0-9]{7}-[0-9]", "(?<![0-9])[0-9]{8}(?![0-9])", "[0-9]{2}-[0-9]{2}-[0-9]{2}", "[0-9]{10}"), strict=True))


#: What a pattern's first character is, looked at before all else: a boundary costs more than a class.
_FIRST = {PHONE: "[0-9(+]", MRN_LABELLED: "[Mm]", HAR: "[Hh]", AGE: "[19]", ACCOUNT: "[Aa]", ORDER: "[Oo]", ACCESSION: "[Aa]"} | {
    p: "[0-9]" for p in (IPV4, SSN, DIGITS, *MRN) if p != MRN_LABELLED}
#: What a text with 0 for each digit holds if the pattern's guard can match: looked for in bytes.
_SHAPES = {DIGITS: "000000"} | dict(zip((p for p in MRN if p != MRN_LABELLED), (
    "000-00-00", "000-00-0000", "0000000-0", "00000000", "00-00-00", "0000000000"), strict=True))


def find(text: Column, pattern: str, type_: str, replacement: str, found_by: str, keep: Kept | None = None) -> Column:
    """Findings of one pattern.  keep: projections that take what is computed once (see ``Kept``)."""
    guard = GUARDS[pattern]
    if keep is not None and pattern in _SHAPES:
        here = F.contains(keep(0, F.translate(text, "123456789", "000000000")), F.lit(_SHAPES[pattern]))
    else:
        here = F.contains(text, F.lit(guard)) if guard in ("@", "://", ":") else text.rlike(guard)
    by_run = pattern == EMAIL
    whole = EMAIL_BY_RUN if by_run else f"(?={_FIRST[pattern]}){pattern}" if pattern in _FIRST else pattern
    if keep is not None:
        return findings_of(*cut(text, whole, here, keep, behind=by_run), text, type_, replacement, found_by)
    return F.when(here, find_spans(text, whole, type_, replacement, found_by, behind=by_run)).otherwise(none_found())


def _listed(text: Column, rules: Iterable[tuple[str, str]], found_by: str, replacements: dict[str, str], only_mapped: bool, keep: Kept | None) -> Column:
    return joined(*[
        find(text, pattern, kind, replacements.get(kind, f"[{kind}]"), found_by, keep)
        for kind, pattern in rules
        if not only_mapped or kind in replacements
    ])


def general(text: Column, replacements: dict[str, str] | None = None, only_mapped: bool = False, keep: Kept | None = None) -> Column:
    """Phones, e-mails, IP addresses, URLs, social security numbers and long numbers.

    replacements by type, else ``[type]``; only_mapped: just the types that have one.
    """
    return _listed(text, GENERAL, "deid-general", replacements or {}, only_mapped, keep)


#: Wider patterns first: what one of them has replaced is gone for the others.
WIDE_FIRST = [("general-url", URL), ("general-email", EMAIL), ("general-phone", PHONE), ("general-ip", IPV6), ("general-ip", IPV4),
              ("general-ssn", SSN), ("000000", DIGITS)]


def rewritten(text: Column, replacements: dict[str, str] | None = None) -> Column:
    """The text with one pattern replaced after the other, each in what the wider ones have left.

    Where findings overlap, the part of a narrower one that sticks out stays; ``merge.splice`` leaves none.
    """
    for kind, pattern in WIDE_FIRST:
        new = re.sub(r"([\\$])", r"\\\1", (replacements or {}).get(kind, f"[{kind}]"))
        text = F.regexp_replace(text, EMAIL_BY_RUN, f"$1{new}") if pattern == EMAIL else F.regexp_replace(text, pattern, new)
    return text


def numbers(text: Column, replacements: dict[str, str] | None = None, only_mapped: bool = False, keep: Kept | None = None) -> Column:
    """Account, order and accession numbers with their labels."""
    return _listed(text, NUMBERS, "deid-number-general", replacements or {}, only_mapped, keep)


def mrn(text: Column, item: str = "mrn", replacement: str = "[MRN]", keep: Kept | None = None) -> Column:
    """Medical record numbers, bare or labelled."""
    return joined(*[find(text, p, item, replacement, "deid-mrn", keep) for p in MRN])


def har(text: Column, item: str = "har", replacement: str = HAR_REPLACEMENT, keep: Kept | None = None) -> Column:
    """Hospital account numbers behind their label."""
    return find(text, HAR, item, replacement, "deid-harNum", keep)


def age(text: Column, item: str = "age", replacement: str = AGE_REPLACEMENT, keep: Kept | None = None) -> Column:
    """Ages of 90 and over."""
    return find(text, AGE, item, replacement, "deid-age", keep)
