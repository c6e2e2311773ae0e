"""Licence scan: an Aho-Corasick automaton finds tags and notice phrases, a shunting-yard parser
evaluates the licence expressions behind the tags.

An expression is read where the automaton has found a tag and a sign of assignment follows. It goes on
over line breaks and comment marks while a bracket is open. Operators are in capitals, or in small letters
where a known identifier follows; prose behind an identifier thus ends the expression.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame, functions as F

from eventlake.llm.common import beside, on_texts, prepare_python

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notice phrases of the method's own, as words of the lower-cased text.
NOTICES = {
    "apache license": "apache", "mit license": "mit", "bsd license": "bsd", "mozilla public license": "mpl",
    "lesser general public license": "lgpl", "affero general public license": "agpl", "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc0": "cc0", "public domain": "public-domain",
    "creative commons": "cc", "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd", "boost software license": "boost",
    "isc license": "isc", "the unlicense": "unlicense", "eclipse public license": "epl",
    "gplv2": "gpl", "gplv3": "gpl", "lgplv2": "lgpl", "lgplv3": "lgpl", "agplv3": "agpl", "zlib license": "zlib",
    "artistic license": "artistic", "european union public license": "eupl", "open font license": "ofl",
    "postgresql license": "postgresql", "python software foundation license": "psf", "microsoft public license": "ms-pl",
    "common development and distribution license": "cddl", "open database license": "odbl",
    "gnu free documentation license": "gfdl",
}
# The other spelling counts as well, though not for the base.
NOTICES |= {phrase.replace("license", "licence"): label for phrase, label in
            [*NOTICES.items(), ("general public license", "gpl")] if "license" in phrase}
# Tags, and whether an identifier that is not known counts behind them. A field of a package file may hold anything.
TAGS = {"spdx license identifier": True, "spdx licence identifier": True, "license": False, "licence": False}
# How freely text under a label may be used, 0 to 1. Expression identifiers map to labels by prefix.
FREEDOM = {
    "cc0": 1.0, "public-domain": 1.0, "unlicense": 1.0, "mit": 0.9, "bsd": 0.9, "apache": 0.9, "isc": 0.9, "boost": 0.9,
    "zlib": 0.9, "cc-by": 0.8, "cc": 0.6, "mpl": 0.6, "epl": 0.6, "lgpl": 0.5, "cc-by-sa": 0.5, "gpl": 0.4, "agpl": 0.3,
    "cc-by-nd": 0.3, "cc-by-nc": 0.2, "other": 0.2, "reserved": 0.0, "wtfpl": 1.0, "postgresql": 0.9, "psf": 0.9,
    "ncsa": 0.9, "ofl": 0.8, "afl": 0.8, "artistic": 0.7, "ms-pl": 0.7, "eupl": 0.5, "cddl": 0.5, "odbl": 0.5, "gfdl": 0.4,
    "osl": 0.3,
}
IDENTIFIERS = [
    ("cc-by-nc", "cc-by-nc"), ("cc-by-sa", "cc-by-sa"), ("cc-by-nd", "cc-by-nd"), ("cc-by", "cc-by"), ("cc0", "cc0"),
    ("agpl", "agpl"), ("lgpl", "lgpl"), ("gpl", "gpl"), ("apache", "apache"), ("mit", "mit"), ("bsd", "bsd"),
    ("0bsd", "bsd"), ("isc", "isc"), ("mpl", "mpl"), ("epl", "epl"), ("bsl", "boost"), ("zlib", "zlib"),
    ("unlicense", "unlicense"), ("wtfpl", "wtfpl"), ("postgresql", "postgresql"), ("psf", "psf"), ("python", "psf"),
    ("ncsa", "ncsa"), ("x11", "mit"), ("ofl", "ofl"), ("afl", "afl"), ("artistic", "artistic"), ("ms-pl", "ms-pl"),
    ("eupl", "eupl"), ("cddl", "cddl"), ("odbl", "odbl"), ("gfdl", "gfdl"), ("osl", "osl"), ("gplv2", "gpl"), ("gplv3", "gpl"),
    ("lgplv2", "lgpl"), ("lgplv3", "lgpl"), ("agplv3", "agpl"),
]
UNKNOWN, SILENT_SCORE, EXCEPTION_GAIN = "other", 0.5, 0.1

GAPS = bytes(32 if b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
ASSIGNED = re.compile(rb"[\"']?[ \t]*[:=][ \t]*[\"'\[]*")
SIGN = re.compile(rb"[ \t]*(\(|\)|[A-Za-z0-9.+-]+)")
SIGN_IN_BRACKETS = re.compile(rb"[\s*#;!/]*(\(|\)|[A-Za-z0-9.+-]+)")
PART = re.compile(r"\(|\)|[a-z0-9.+-]+")
STRENGTH = {"or": 1, "and": 2, "with": 3}


def _automaton() -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, *TAGS]:
        built.add_word(f" {phrase} ", phrase)
    built.make_automaton()
    return built


_FINDER = _automaton()


def label_of(identifier: str) -> str:
    return next((label for start, label in IDENTIFIERS if identifier == start or identifier.startswith(start + "-")
                 or identifier.startswith(start) and identifier[len(start):len(start) + 1].isdigit()), UNKNOWN)


def parse(expression: str) -> list[str] | None:
    """The longest valid expression at the start of a text, in postfix order; None if there is none.

    Shunting-yard: operands go to the output, an operator first moves stronger or equal ones there,
    and a bracket keeps its own operators. ``best`` is a length of the output and the operators held
    then (three at most outside brackets), so a long expression is not copied for each operand.
    """
    out: list[str] = []
    held: list[str] = []
    operand_next, best, brackets = True, None, 0
    for match in PART.finditer(expression):
        part = match.group()
        if part == "(" or part not in STRENGTH and part != ")":
            if not operand_next:
                break
            if part == "(":
                held.append(part)
                brackets += 1
                continue
            out.append(part)
            operand_next = False
        elif operand_next:
            break
        elif part == ")":
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                break
            held.pop()
            brackets -= 1
        else:
            while held and held[-1] != "(" and STRENGTH[held[-1]] >= STRENGTH[part]:
                out.append(held.pop())
            held.append(part)
            operand_next = True
        if not operand_next and not brackets:
            best = len(out), held[::-1]
    return best and out[:best[0]] + best[1]


def evaluate(postfix: list[str]) -> tuple[float, set[str]]:
    """Freedom and labels: ``or`` lets one choose the freer side, ``and`` binds to the stricter,
    ``with`` an exception frees a little."""
    stack: list[tuple[float, set[str], str]] = []
    for part in postfix:
        if part in STRENGTH:
            right, left = stack.pop(), stack.pop()
            if part == "with":
                stack.append((min(1.0, left[0] + EXCEPTION_GAIN), left[1], ""))
            else:
                pick = max if part == "or" else min
                stack.append((pick(left[0], right[0]), left[1] | right[1], ""))
        else:
            label = label_of(part)
            stack.append((FREEDOM[label], {label}, part))
    return stack[-1][0], stack[-1][1]


def expression_at(raw: bytes, at: int, any_identifier: bool) -> list[str] | None:
    """The expression that begins at ``at``, in postfix order; None if there is none.

    ``any_identifier`` also takes identifiers that are not known.
    """
    parts, brackets, after_operator, loose = [], 0, False, False
    while sign := (SIGN_IN_BRACKETS if brackets else SIGN).match(raw, at):
        part, at = sign[1].decode(), sign.end()
        small = part.lower().rstrip(".") if not part.startswith("(") else part
        if part in ("(", ")"):
            brackets += 1 if part == "(" else -1
            if brackets < 0:
                break
        elif small in STRENGTH and parts and not after_operator:
            if part not in (small, small.upper()):
                break
            loose = part == small
            parts.append(small)
            after_operator = True
            continue
        elif parts and parts[-1] != "(" and not after_operator or (loose or not any_identifier) and label_of(small) == UNKNOWN \
                and not (parts and parts[-1] == "with"):
            break
        parts.append(small)
        after_operator = False
        loose = loose and part == "("
    return parse(" ".join(parts))


def scan(text: str | None) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score) of one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    data = raw.lower()
    words = data.translate(GAPS).split()
    joined = " " + b" ".join(words).decode("utf-8", "surrogatepass") + " "
    found = [(end + 1 - len(phrase) - 2, phrase) for end, phrase in _FINDER.iter(joined)] if words else []
    base = sorted(at for at, phrase in found if phrase in BASE)
    base_labels = {BASE[phrase] for _, phrase in found if phrase in BASE}
    labels = base_labels | {NOTICES[phrase] for _, phrase in found if phrase in NOTICES}
    scores = [FREEDOM[label] for label in labels]
    tags = sorted((at, phrase) for at, phrase in found if phrase in TAGS)
    if tags:
        ends, number, upto = [w.end() for w in WORD.finditer(data)], 0, 0
        for at, phrase in tags:
            number, upto = number + joined.count(" ", upto, at + 1), at + 1     # words before the tag, and one
            assigned = ASSIGNED.match(raw, ends[number - 1 + phrase.count(" ")])
            postfix = assigned and expression_at(raw, assigned.end(), TAGS[phrase])
            if postfix:
                freedom, own = evaluate(postfix)
                scores.append(freedom)
                labels |= own
    first = joined.count(" ", 0, base[0] + 1) - 1 if base else None
    last = joined.count(" ", 0, base[-1] + 1) - 1 if base else None
    return (len(words), len(base), first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels)),
            min(scores) if scores else SILENT_SCORE)


RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double")


def scan_licences(docs: DataFrame) -> DataFrame:
    """``docs`` with word counts, places of base phrases, labels and a score.

    The score is the freedom of the strictest notice or expression found, and 0.5 without any. Null
    and empty texts have no words, labels or places. Repeated rows get equal results, result columns
    replace columns of their names, and an empty table gives an empty result.
    """
    prepare_python(docs.sparkSession)

    def rows(texts: list) -> list[tuple]:
        return [scan(t) for t in texts]

    return beside(docs, on_texts(rows, RESULT)(F.col("text")), [p.split()[0] for p in RESULT.split(", ")])
