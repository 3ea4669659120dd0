"""Search patterns of the filter queries: their dialect, and what a match must contain.

Patterns are those of the common Perl-like library, searched without anchors and without
regard to case. Java's engine reads most of them alike; what it reads differently is rewritten
here or refused, never silently taken in its own sense.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import product
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Case-insensitive for all letters, and `.` and `$` know only the line feed as a line's end.
FLAGS = "(?iud)"
#: Literals that are pushed to the scan: letters in every case, so only a few of them.
MOST_VARIANTS, MOST_PARTS = 16, 8

# Class names that Java spells differently.
_POSIX = {
    "alpha": r"\p{Alpha}", "digit": r"\p{Digit}", "alnum": r"\p{Alnum}", "upper": r"\p{Upper}",
    "lower": r"\p{Lower}", "punct": r"\p{Punct}", "space": r"\s", "blank": r"\p{Blank}",
    "cntrl": r"\p{Cntrl}", "xdigit": r"\p{XDigit}", "graph": r"\p{Graph}", "print": r"\p{Print}",
    "word": r"\w", "ascii": r"\p{ASCII}",
}
_REFUSED = (
    (r"\(\?(?:R|[+-]?\d|&|P>)", "recursion"),
    (r"\(\?\(", "conditions"),
    (r"\(\?\|", "branch reset"),
    (r"\(\*", "verbs"),
    (r"\(\?C", "callouts"),
    (r"\(\?#", "comments"),
)
_ESCAPES_REFUSED = {"K": "match reset", "C": "single bytes", "g": "relative references", "N": "not a line feed", "o": "octal codes"}
# Letters that more than two characters fold to.
_FOLDS = {"k": "kK\u212a", "s": "sS\u017f"}


class UnsupportedPattern(ValueError):
    """The pattern has a meaning that this engine cannot give it."""


def translated(pattern: str) -> str:
    """The pattern as Java reads it, with FLAGS in front."""
    out: list[str] = []
    at, n = 0, len(pattern)
    while at < n:
        char = pattern[at]
        if char == "\\":
            following = pattern[at + 1 : at + 2]
            if following in _ESCAPES_REFUSED:
                raise UnsupportedPattern(f"{_ESCAPES_REFUSED[following]} in {pattern!r}")
            if following == "Q":
                end = pattern.find("\\E", at + 2)
                literal = pattern[at + 2 : end if end >= 0 else n]
                out.append(re.sub(r"([^\w\s])", r"\\\1", literal, flags=re.ASCII))
                at = end + 2 if end >= 0 else n
                continue
            out.append(pattern[at : at + 2])
            at += 2
        elif char == "[":
            text, at = _class(pattern, at)
            out.append(text)
        elif char == "(":
            for shape, what in _REFUSED:
                if re.match(shape, pattern[at:]):
                    raise UnsupportedPattern(f"{what} in {pattern!r}")
            text, at = _group(pattern, at)
            out.append(text)
        else:
            out.append(char)
            at += 1
    found = FLAGS + "".join(out)
    return found


def _group(pattern: str, at: int) -> tuple[str, int]:
    named = re.match(r"\(\?P?<([A-Za-z_]\w*)>", pattern[at:])
    if named:
        return f"(?<{_name(named.group(1))}>", at + named.end()
    quoted = re.match(r"\(\?'([A-Za-z_]\w*)'", pattern[at:])
    if quoted:
        return f"(?<{_name(quoted.group(1))}>", at + quoted.end()
    again = re.match(r"\(\?P=([A-Za-z_]\w*)\)", pattern[at:])
    if again:
        return f"\\k<{_name(again.group(1))}>", at + again.end()
    return "(", at + 1


def _name(name: str) -> str:
    """Java's group names have no underscores."""
    return "g" + name.replace("_", "U")


def _class(pattern: str, start: int) -> tuple[str, int]:
    """A bracket class: brackets and doubled ampersands in it are plain characters."""
    out, at = ["["], start + 1
    if pattern[at : at + 1] == "^":
        out.append("^")
        at += 1
    first = True
    while at < len(pattern):
        char = pattern[at]
        posix = re.match(r"\[:(\^?)(\w+):\]", pattern[at:])
        if char == "]" and not first:
            return "".join([*out, "]"]), at + 1
        if posix:
            if posix.group(2) not in _POSIX:
                raise UnsupportedPattern(f"class {posix.group(2)!r} in {pattern!r}")
            name = _POSIX[posix.group(2)]
            out.append(f"[^{name}]" if posix.group(1) else name)
            at += posix.end()
        elif char == "\\":
            out.append(pattern[at : at + 2])
            at += 2
        else:
            out.append("\\" + char if char in "[]&" else char)
            at += 1
        first = False
    raise UnsupportedPattern(f"open class in {pattern!r}")


def literals(pattern: str) -> list[str] | None:
    """Texts of which every match holds one, in some case; None if nothing is known.

    Only what is surely needed counts: plain characters outside groups and classes that no
    quantifier makes optional, the longest run of them in each alternative.
    """
    alternatives: list[list[str]] = [[""]]
    at, n = 0, len(pattern)
    while at < n:
        char = pattern[at]
        runs = alternatives[-1]
        plain: str | None = None
        if char == "\\":
            following = pattern[at + 1 : at + 2]
            if following == "Q" or not following:
                return None
            # Digits are references and codes, letters are classes, anchors and codes.
            plain = None if following.isalnum() else following
            if following in "xpPuckN0123456789":
                return None
            at += 2
        elif char == "(":
            # Flags in a pattern change the meaning of the rest of it.
            if re.match(r"\(\?[a-zA-Z^-]", pattern[at:]) and not re.match(r"\(\?P?<", pattern[at:]):
                return None
            end = _closing(pattern, at)
            if end is None:
                return None
            at = end + 1
        elif char == "[":
            at = _class(pattern, at)[1]
        elif char == "|":
            alternatives.append([""])
            at += 1
            continue
        elif char in "^$":
            at += 1
            continue
        elif char == ".":
            at += 1
        else:
            plain = char
            at += 1
        quantifier = re.match(r"(?:[*+?]|\{\d+(?:,\d*)?\})[+?]?", pattern[at:])
        if quantifier:
            # A repeated character ends a run; it may be missing altogether.
            at += quantifier.end()
            runs.append("")
        elif plain is None:
            runs.append("")
        else:
            runs[-1] += plain
    found = [max(runs, key=len) for runs in alternatives]
    return found if all(found) and len(found) <= MOST_PARTS else None


def _closing(pattern: str, at: int) -> int | None:
    depth = 0
    while at < len(pattern):
        char = pattern[at]
        if char == "\\":
            at += 2
            continue
        if char == "[":
            at = _class(pattern, at)[1]
            continue
        depth += (char == "(") - (char == ")")
        if depth == 0:
            return at
        at += 1
    return None


def variants(text: str) -> list[str]:
    """A part of the text in every case: as many characters as give MOST_VARIANTS at most."""
    best: list[str] = []
    for start in range(len(text)):
        found = [""]
        for char in text[start:]:
            cases = sorted(set(_FOLDS.get(char.lower(), char.lower() + char.upper())))
            # Characters that change their length or fold otherwise are left to the pattern.
            if not char.isascii() or len(found) * len(cases) > MOST_VARIANTS:
                break
            found = ["".join(p) for p in product(found, cases)]
        if found != [""] and len(found[0]) > len(best[0] if best else ""):
            best = found
    return best


def any_matches(columns: list[Column], pattern: str) -> list[Column]:
    """Conditions that together say that the pattern is found in one of the columns.

    The first of two is what its literals let a scan decide, the other the pattern itself.
    """
    found = reduce(or_, [column.rlike(translated(pattern)) for column in columns])
    known = literals(pattern)
    parts = [variants(text) for text in known] if known else []
    if not parts or not all(parts):
        return [found]
    held = [column.contains(F.lit(v)) for column in columns for part in parts for v in part]
    return [reduce(or_, held), found]
