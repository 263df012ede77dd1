"""Detector definitions: what counts as an identifier, and how sure we are.

A detector is data: an entity name, a regular expression that is valid in both
Java and Python, a score, context terms and an optional check on the matched
text. ``hint`` is a cheap test that every text with a match passes; texts that
fail it skip the expensive work, and most texts do.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from .text import WORD_END, WORD_START, python_pattern


@dataclass(frozen=True)
class Detector:
    entity: str
    pattern: str
    score: float
    hint: str | None = None
    context: tuple[str, ...] = field(default_factory=tuple)
    check: str | None = None  # None or "luhn"
    name: str = ""
    language: str | None = None  # only for texts in this language; None: for all

    def __post_init__(self) -> None:
        if not self.entity:
            raise ValueError("a detector needs an entity name")
        if not 0.0 <= self.score <= 1.0:
            raise ValueError(f"score of {self.entity} must be in [0, 1]")
        if self.check not in (None, "luhn"):
            raise ValueError(f"unknown check {self.check!r}")
        if re.compile(python_pattern(self.pattern)).match(""):
            raise ValueError(f"pattern of {self.entity} must not match the empty text")

    @property
    def label(self) -> str:
        return self.name or self.entity.lower()

    def scored(self, score: float) -> "Detector":
        return replace(self, score=score)


def is_plain(hint: str | None) -> bool:
    """Is the hint a text to look for, rather than a pattern?"""
    return hint is not None and not set(hint) & set(r"\[](){}.*+?^$|")


_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"

EMAIL = Detector(
    "EMAIL_ADDRESS",
    r"(?<![A-Za-z0-9_.%+\-])"
    + r"[A-Za-z0-9_.%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    1.0,
    hint="@",
)

PHONE = Detector(
    "PHONE_NUMBER",
    WORD_START
    + r"(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{3}\)[ .\-]?|[0-9]{3}[.\-])[0-9]{3}[ .\-][0-9]{4}"
    + WORD_END,
    0.75,
    hint=r"[0-9]{3}[ .\-][0-9]{4}",
)

IP = Detector(
    "IP_ADDRESS",
    WORD_START + r"(?<![0-9]\.)" + rf"{_OCTET}(?:\.{_OCTET}){{3}}" + WORD_END + r"(?!\.[0-9])",
    0.95,
    hint=r"[0-9]\.[0-9]",
)

CARD = Detector(
    "CREDIT_CARD",
    WORD_START + r"[0-9]{4}(?:[ \-]?[0-9]{4}){3}" + WORD_END,
    1.0,
    hint=r"[0-9]{4}[ \-]?[0-9]{4}[ \-]?[0-9]{4}",
    check="luhn",
)

URL = Detector("URL", WORD_START + r"https?://[!#-;=?-~]++", 0.6, hint="://")

# The three custom detectors of the workload, with their
# patterns, scores, context terms and placeholders.
#   badge    \b\d{6}\b                                     0.8
#   ticket   (?i)\b(?:INC|REQ)\d+\b                        0.8
#   machine  \b[A-Z0-9]+(?:[_-][A-Z0-9]+)*\b               0.5
# They are written below with explicit Unicode boundaries. A word run ends
# where the boundary is, so the possessive forms match the same text without
# backtracking. Python ignores case for the dotted and dotless i as well.
BADGE = Detector(
    "BADGE_NUMBER",
    WORD_START + r"\p{Nd}{6}" + WORD_END,
    0.8,
    hint=r"\p{Nd}{6}",
    context=("badge number", "employee ID", "ID number"),
)

TICKET = Detector(
    "TICKET_NUMBER",
    WORD_START + "(?:[Iiİı][Nn][Cc]|[Rr][Ee][Qq])" + r"\p{Nd}++" + WORD_END,
    0.8,
    hint=r"[CcQq]\p{Nd}",
    context=("ticket", "incident", "request"),
)

_RUN = r"[A-Z0-9]++(?:_[A-Z0-9]++)*+" + WORD_END
MACHINE = Detector(
    "MACHINE_NAME",
    WORD_START + _RUN + rf"(?:-{_RUN})*+",
    0.5,
    hint=r"[A-Z0-9]",
    context=("machine", "hostname", "computer", "PC"),
)

DEFAULT_DETECTORS: tuple[Detector, ...] = (EMAIL, PHONE, IP, CARD, URL)
CONTACT_DETECTORS: tuple[Detector, ...] = (EMAIL, PHONE, IP)
CUSTOM_DETECTORS: tuple[Detector, ...] = (BADGE, TICKET, MACHINE)
WITH_CUSTOM: tuple[Detector, ...] = DEFAULT_DETECTORS + CUSTOM_DETECTORS

# Entity -> replacement, and the fallback for any other entity.
DEFAULT_OPERATORS: dict[str, str] = {
    "DEFAULT": "<REDACTED>",
    "PERSON": "<PERSON>",
    "EMAIL_ADDRESS": "<EMAIL_ADDRESS>",
    "PHONE_NUMBER": "<PHONE_NUMBER>",
    "IP_ADDRESS": "<IP_ADDRESS>",
    "BADGE_NUMBER": "<BADGE_NUMBER>",
    "TICKET_NUMBER": "<TICKET_NUMBER>",
    "MACHINE_NAME": "<MACHINE_NAME>",
}


def operators_for(overrides: dict[str, str] | None = None) -> dict[str, str]:
    """The replacement map, with a fallback that is always present."""
    merged = {**DEFAULT_OPERATORS, **(overrides or {})}
    if "DEFAULT" not in merged:
        raise ValueError("a DEFAULT replacement is required")
    return merged
