"""Licence notices and licence expressions in texts.

One Aho-Corasick automaton reads the words of a text and reports every notice phrase, wherever it stands.  A second one
reads its characters and reports identifier tags; what follows a tag is parsed by a shunting-yard parser as an expression
of licence ids with ``and``, ``or``, ``with`` and parentheses, and evaluated: ``or`` leaves the choice, so the
mildest side counts; under ``and`` both bind, so the strictest does; ``with`` an exception eases a copyleft.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleworks.llm.shared import once, only

#: The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Phrases of notices besides the base ones, as words, with the label of each.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "general public licence": "gpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "common development and distribution license": "cddl",
    "boost software license": "bsl",
    "academic free license": "afl",
    "open software license": "osl",
    "artistic license": "artistic",
    "sil open font license": "ofl",
    "isc license": "isc",
    "zlib license": "zlib",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "licensed under the apache": "apache",
    "licensed under the mit": "mit",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "cc0": "cc0",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution noderivatives": "cc-by-nd",
}

#: Characters after which an expression follows, white space and quotes aside.
TAGS = ("spdx-license-identifier:", "license-expression:", "license:", "licence:", 'license":', 'licence":', "license =", "licence =")

#: How much each label binds, from 0 (nothing asked) to 4 (use itself restricted).
FREE, NOTICE, WEAK, COPYLEFT, RESTRICTED = range(5)
BINDS = {
    "0bsd": FREE, "cc0": FREE, "unlicense": FREE, "wtfpl": FREE,
    "afl": NOTICE, "apache": NOTICE, "artistic": NOTICE, "bsd": NOTICE, "bsl": NOTICE, "cc-by": NOTICE, "isc": NOTICE,
    "mit": NOTICE, "ofl": NOTICE, "psf": NOTICE, "python": NOTICE, "zlib": NOTICE,
    "cddl": WEAK, "epl": WEAK, "lgpl": WEAK, "mpl": WEAK,
    "agpl": COPYLEFT, "cc-by-sa": COPYLEFT, "eupl": COPYLEFT, "gfdl": COPYLEFT, "gpl": COPYLEFT, "osl": COPYLEFT,
    "cc-by-nc": RESTRICTED, "cc-by-nc-nd": RESTRICTED, "cc-by-nc-sa": RESTRICTED, "cc-by-nd": RESTRICTED,
    "other": RESTRICTED,
}

#: What a single notice or expression of a licence leaves of the doubt that there is one.
NOTICE_DOUBT, EXPRESSION_DOUBT = 0.2, 0.05

# ASCII letters in lower case; other ASCII but digits parts words, as does nothing else.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c > 127 else 32 for c in range(256))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

_TOKEN = re.compile(r"[ \t\"']*(\(|\)|[0-9a-z](?:[0-9a-z.:+-]*[0-9a-z+])?)", re.IGNORECASE)
_VERSION = re.compile(r"(?:-?v?\d[0-9a-z.-]*|-.*)?\+?", re.IGNORECASE)
_FAMILIES = sorted(BINDS, key=len, reverse=True)
_RANK = {"or": 1, "and": 2, "with": 3}


def family(identifier: str) -> str | None:
    """The label of a licence id, whatever its version and suffix; None if it is none.

    >>> [family(i) for i in ("GPL-2.0-or-later", "Apache-2.0", "BSD-3-Clause", "CC-BY-NC-4.0", "LicenseRef-ours", "others")]
    ['gpl', 'apache', 'bsd', 'cc-by-nc', 'other', None]
    """
    name = identifier.lower()
    if name.startswith(("licenseref-", "documentref-")):
        return "other"
    for label in _FAMILIES:
        if name.startswith(label) and _VERSION.fullmatch(name, len(label)):
            return label
    return None


def _operands_and_marks(text: str, at: int) -> Iterator[tuple[str, int]]:
    """Tokens from ``at`` to the end of the line, each with its end."""
    while found := _TOKEN.match(text, at):
        at = found.end()
        yield found[1], at


def parse_expression(text: str, at: int = 0) -> tuple[list[str], int]:
    """(postfix, end) of the longest licence expression that begins at ``at``; an empty list if none does.

    Shunting-yard: ids go out, operators wait until one of lower rank comes, a closing parenthesis lets out
    what waits since the opening one.  The expression ends before the first token that cannot go on with
    it, and an operator that nothing follows is no part of it; open parentheses are closed there.

    >>> parse_expression("MIT OR (GPL-2.0+ WITH Classpath-exception-2.0 AND Apache-2.0) is the licence")[0]
    ['mit', 'gpl', '!Classpath-exception-2.0', 'with', 'apache', 'and', 'or']
    >>> parse_expression("mit and others")
    (['mit'], 3)
    """
    out: list[str] = []
    waiting: list[str] = []
    pending: list[str] = []  # operator and opening marks that only count if an id follows
    end, operand, single, depth = at, True, False, 0
    for token, stop in _operands_and_marks(text, at):
        word = token.lower()
        if not operand:
            if word in ("and", "or"):
                pending, operand = [word], True
                continue
            if word == "with" and single:
                pending, operand = [word], True
                continue
            if word == ")" and depth:
                while (top := waiting.pop()) != "(":
                    out.append(top)
                end, single, depth = stop, False, depth - 1
                continue
            break
        if pending[:1] == ["with"]:
            if word in ("(", ")", "and", "or", "with") or "exception" not in word:
                break
            out += ["!" + token, "with"]
            end, operand, single, pending = stop, False, False, []
            continue
        if word == "(":
            pending.append("(")
            continue
        label = family(token) if word not in (")", "and", "or", "with") else None
        if label is None:
            break
        for mark in pending:
            if mark != "(":
                while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[mark]:
                    out.append(waiting.pop())
            waiting.append(mark)
            depth += mark == "("
        out.append(label)
        end, operand, single, pending = stop, False, True, []
    out += [mark for mark in reversed(waiting) if mark != "("]
    return out, end


def evaluate(postfix: list[str]) -> tuple[list[str], int | None]:
    """(labels named, how much the whole binds); None binds where there is no expression.

    >>> evaluate(["gpl", "mit", "or"]), evaluate(["gpl", "mit", "and"]), evaluate(["gpl", "!Classpath-exception-2.0", "with"])
    ((['gpl', 'mit'], 1), (['gpl', 'mit'], 3), (['gpl'], 2))
    """
    labels, values = set(), []
    for token in postfix:
        if token == "or":
            values[-2:] = [min(values[-2:])]
        elif token == "and":
            values[-2:] = [max(values[-2:])]
        elif token == "with":
            values[-1] = WEAK if values[-1] == COPYLEFT else values[-1]
        elif not token.startswith("!"):
            labels.add(token)
            values.append(BINDS[token])
    return sorted(labels), values[0] if values else None


def _automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    notices, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, label in {**NOTICES, **BASE}.items():
        notices.add_word(f" {phrase} ", (label, len(phrase.split()), phrase in BASE))
    for tag in TAGS:
        tags.add_word(tag, len(tag))
    notices.make_automaton()
    tags.make_automaton()
    return notices, tags


def scan_text(text: str, notices: ahocorasick.Automaton, tags: ahocorasick.Automaton) -> tuple[int, list, list]:
    """(words, notices as (label, word, words, base), expressions as (at, text, labels, binds)), in linear time.

    Both automata read bytes, one character each, so that no other alphabet changes their work.
    """
    data = text.encode("utf-8", "surrogatepass")
    words = data.translate(_WORDS).split()
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
    found, counted, passed = [], 0, 0
    for end, (label, size, base) in notices.iter(joined):
        counted, passed = counted + joined.count(" ", passed, end), end  # spaces before the one that ends the phrase
        found.append((label, counted - size, size, base))
    raw = data.decode("latin-1")
    expressions, past, seen, points = [], 0, 0, 0
    for end, _ in tags.iter(data.translate(_LOWER).decode("latin-1")):
        if end < past:
            continue
        postfix, stop = parse_expression(raw, end + 1)
        if postfix:
            points, seen = points + len(data[seen : end + 1].decode("utf-8", "replace")), end + 1
            past = stop
            expressions.append((points, raw[end + 1 : stop].strip(" \t\"'"), *evaluate(postfix)))
    return len(words), found, expressions


_FOUND = (
    "n_words long, notices array<struct<label:string,word:bigint,words:int,base:boolean>>, "
    "expressions array<struct<at:bigint,text:string,labels:array<string>,binds:int>>"
)


def _scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    notices, tags = once("licence automata", _automata)
    for texts in batches:
        rows = [scan_text(text, notices, tags) for text in texts]
        yield pd.DataFrame(rows, columns=["n_words", "notices", "expressions"])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, notices, expressions) of every row of ``docs``.

    ``notices`` has a row (label, word, words, base) for each place where the words of a phrase stand, from word 0, in the
    order of their ends; ``expressions`` one (at, text, labels, binds) for each licence expression after a
    tag: the code points before it, the expression, its labels and how much it binds (0 to 4).

    A NULL text counts as empty.  Places may overlap and all count; a text of nothing but phrases is read in time and
    memory proportional to its length.  Rows that repeat stay, other columns are ignored and an empty
    table gives an empty result.
    """
    rows = only(docs, doc_id="long", text="string")
    found = F.pandas_udf(_scanned, _FOUND)(F.coalesce("text", F.lit("")))
    return rows.select("doc_id", found.alias("found")).select("doc_id", "found.*")


def license_digest(docs: DataFrame) -> DataFrame:
    """One row per document: places and labels of the base phrases, all labels, a score, and how much they bind.

    ``score`` is the chance that a text has a licence notice: each different label that a phrase names leaves a fifth of
    the doubt, each that an expression names a twentieth; without any it is 0.  ``binds`` is the most that
    any notice or expression asks, from 0 to 4, NULL without any.
    """
    notices, expressions = F.col("notices"), F.col("expressions")
    base = F.filter(notices, lambda notice: notice["base"])
    named, tagged = F.array_distinct(notices["label"]), F.array_distinct(F.flatten(expressions["labels"]))
    doubt = F.pow(F.lit(NOTICE_DOUBT), F.size(named)) * F.pow(F.lit(EXPRESSION_DOUBT), F.size(tagged))
    level = F.create_map(*(F.lit(part) for pair in BINDS.items() for part in pair))
    notice_binds = F.array_max(F.transform(named, lambda label: level[label]))
    return scan(docs).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base["word"]).alias("first_word"),
        F.array_max(base["word"]).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base["label"])), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(named, tagged)), ",").alias("labels"),
        (1.0 - doubt).alias("score"),
        F.greatest(notice_binds, F.array_max(expressions["binds"])).cast("int").alias("binds"),
        F.array_join(expressions["text"], "\n").alias("expressions"),
    )
