"""Regular expressions of queries, which have RE2's syntax, as patterns of the JVM."""

from __future__ import annotations

import re

from spanloom.plans.ast import QueryError

#: What only one of the two engines knows: group openings that RE2 refuses.
_REFUSED = ("(?=", "(?!", "(?<=", "(?<!", "(?>")
_POSIX = {
    "alnum": r"\p{Alnum}", "alpha": r"\p{Alpha}", "ascii": r"\p{ASCII}", "blank": r"\p{Blank}", "cntrl": r"\p{Cntrl}",
    "digit": r"\p{Digit}", "graph": r"\p{Graph}", "lower": r"\p{Lower}", "print": r"\p{Print}", "punct": r"\p{Punct}",
    "space": r"\p{Space}", "upper": r"\p{Upper}", "word": r"\w", "xdigit": r"\p{XDigit}",
}


def jvm_pattern(text: str) -> str:
    """The same expression for the JVM: group names go, classes such as [[:alpha:]] are spelt out, ``[`` within a class
    stands for itself. Raises QueryError for what RE2 refuses: look-around, back references and unclosed groups."""
    out: list[str] = []
    at, depth, inside = 0, 0, False
    while at < len(text):
        c = text[at]
        if c == "\\":
            if at + 1 == len(text):
                raise QueryError(f"a regular expression ends with a backslash: {text!r}")
            if text[at + 1] == "Q" and not inside:
                end = text.find("\\E", at)
                quoted, at = (text[at + 2 :], len(text)) if end < 0 else (text[at + 2 : end], end + 2)
                out.append("".join(c if c.isalnum() else "\\" + c for c in quoted))
                continue
            if text[at + 1] in "123456789k":
                raise QueryError(f"back references aren't supported: {text!r}")
            out.append(text[at : at + 2])
            at += 2
            continue
        if inside:
            if c == "[" and (found := re.match(r"\[:(\^?)(\w+):\]", text[at:])) and found[2] in _POSIX:
                spelt = _POSIX[found[2]]
                out.append(spelt.upper() if found[1] and spelt == r"\w" else spelt.replace(r"\p", r"\P") if found[1] else spelt)
                at += found.end()
                continue
            if c == "[" or text.startswith("&&", at):
                out.append("\\")
            elif c == "]":
                inside = False
        elif c == "[":
            inside = True
            taken = 2 if text.startswith("[^", at) else 1
            if text.startswith("]", at + taken):  # a bracket that comes first stands for itself
                out.append(text[at : at + taken] + "\\]")
                at += taken + 1
                continue
            out.append(text[at : at + taken])
            at += taken
            continue
        elif c == "(":
            depth += 1
            if text.startswith(_REFUSED, at):
                raise QueryError(f"look-around isn't supported: {text!r}")
            if found := re.match(r"\(\?P?<\w+>", text[at:]):
                out.append("(?:")
                at += found.end()
                continue
        elif c == ")":
            depth -= 1
            if depth < 0:
                raise QueryError(f"a group isn't opened: {text!r}")
        out.append(c)
        at += 1
    if depth or inside:
        raise QueryError(f"a group or class isn't closed: {text!r}")
    return "".join(out)
