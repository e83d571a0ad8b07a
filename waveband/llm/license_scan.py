"""Licence recognition by sentence rules.

Texts are cut into sentences (at line ends, and at ``.``, ``;`` or ``:`` before a blank) and each is
normalised: A-Z to lower case, everything but letters and digits to single blanks. Sentences that
are known licence sentences become their identifiers; all other sentences are forgotten. A rule is
an ordered sequence of identifiers: it fits where its identifiers stand one after the other among
the text's identifiers. The longest rule at a position wins, and matching goes on behind it.
Sentences of licences that are wrapped over several lines are joined: from each line on, the longest
run of lines of a paragraph that is a known sentence counts as that one sentence.
A holder's own name, of up to twelve words, stands for "the copyright holder" in the sentence that begins
"Neither the name of"; all other sentences must be equal.

Defined cases: null and empty texts have no sentences and match nothing; the same licence found
twice counts twice in ``n_matches`` and is named once; rows are judged one by one, so repeated
rows and ids make no difference. Whole texts are read, one at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Licence sentences by identifier, normalised as the texts are.
SENTENCES = {
    "this work is licensed under the gnu general public license version 3": "gpl3-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-grant",
    "licensed under cc by nc 4 0": "cc-by-nc-4-short",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4-notice",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4-notice",
    "released under the mit license": "mit-short",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit-grant",
    "the software is provided as is without warranty of any kind": "mit-warranty",
    "licensed under the apache license version 2 0": "apache2-notice",
    "you may not use this file except in compliance with the license": "apache2-compliance",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd-grant",
    "neither the name of the copyright holder nor the names of its contributors may be used": "bsd-names",
}
#: Ordered rules, and the licence that each names.
RULES = (
    (("gpl3-notice",), "GPL-3.0"),
    (("gpl-grant",), "GPL"),
    (("cc-by-nc-4-short",), "CC-BY-NC-4.0"),
    (("cc-by-nc-4-notice",), "CC-BY-NC-4.0"),
    (("cc-by-4-notice",), "CC-BY-4.0"),
    (("mit-short",), "MIT"),
    (("mit-grant", "mit-warranty"), "MIT"),
    (("mit-grant",), "MIT"),
    (("apache2-notice",), "Apache-2.0"),
    (("apache2-notice", "apache2-compliance"), "Apache-2.0"),
    (("bsd-grant",), "BSD-2-Clause"),
    (("bsd-grant", "bsd-names"), "BSD-3-Clause"),
)
#: Licences that forbid some use, so that a pipeline may drop their documents.
RESTRICTED = ("CC-BY-NC-4.0", "GPL", "GPL-3.0")

_FSF = " as published by the free software foundation"
_LATER = "either version {} of the license or at your option any later version"
_GNU = {"GPL": "general", "LGPL": "lesser general", "AGPL": "affero general"}
_DATES = {"GPL-2.0": "2 june 1991", "GPL-3.0": "3 29 june 2007", "LGPL-2.1": "2 1 february 1999", "LGPL-3.0": "3 29 june 2007", "AGPL-3.0": "3 19 november 2007"}
_CC = {
    "BY": "", "BY-SA": " sharealike", "BY-ND": " noderivatives", "BY-NC": " noncommercial", "BY-NC-SA": " noncommercial sharealike", "BY-NC-ND": " noncommercial noderivatives",
}


def _gnu() -> Iterator[tuple[str, tuple[str, ...]]]:
    """Names and sentences of GNU headers and titles."""
    for name, date in _DATES.items():
        short, _, version = name.partition("-")
        kind = _GNU[short]
        number = version.removesuffix(".0").replace(".", " ")
        terms = f"you can redistribute it and or modify it under the terms of the gnu {kind} public license"
        yield name, (f"gnu {kind} public license version {date}",)
        yield name, (f"{terms}{_FSF}", _LATER.format(number))  # cut at ';'
        yield name, (f"{terms}{_FSF} {_LATER.format(number)}",)
        yield name, (f"{terms}{_FSF}", f"version {number} of the license")
        yield name, (f"{terms}{_FSF} version {number} of the license",)
        yield name, (f"{terms} version {number}{_FSF}",)
    for short, kind in _GNU.items():
        yield short, (f"you can redistribute it and or modify it under the terms of the gnu {kind} public license{_FSF}",)


def _creative_commons() -> Iterator[tuple[str, tuple[str, ...]]]:
    for short, more in _CC.items():
        for version, port in (("4.0", "international"), ("3.0", "unported")):
            number, code = version.replace(".", " "), short.lower().replace("-", " ")
            yield f"CC-{short}-{version}", (f"licensed under cc {code} {number}",)
            yield f"CC-{short}-{version}", (f"this work is licensed under cc {code} {number}",)
            for article in ("a", "the"):
                yield f"CC-{short}-{version}", (f"this work is licensed under {article} creative commons attribution{more} {number} {port} license",)


_MIT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
    "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
    "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
    "merchantability fitness for a particular purpose and noninfringement",
)
_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
    "in the documentation and or other materials provided with the distribution",
)
_ADVERTISING = "all advertising materials mentioning features or use of this software must display the following acknowledgement"
_ENDORSE = "may be used to endorse or promote products derived from this software without specific prior written permission"
_NAMES = (
    f"neither the name of the copyright holder nor the names of its contributors {_ENDORSE}",
    f"nor the names of its contributors {_ENDORSE}",  # behind a name that ends in "Inc."
)
_APACHE = "licensed under the apache license version 2 0 the license"
_ISC = "permission to use copy modify and {}distribute this software for any purpose with or without fee is hereby granted " \
    "provided that the above copyright notice and this permission notice appear in all copies"


def _canonical() -> Iterator[tuple[str, tuple[str, ...]]]:
    """Names of common licences and their sentences, as they are cut."""
    yield from _gnu()
    yield from _creative_commons()
    yield "MIT", _MIT
    yield "MIT", (_MIT[0], _MIT[2])
    yield "MIT", _MIT[:1]
    yield "MIT", ("licensed under the mit license",)
    yield "BSD-2-Clause", _BSD
    yield "BSD-2-Clause", _BSD[:1]
    for names in _NAMES:
        yield "BSD-3-Clause", (*_BSD, names)
        yield "BSD-4-Clause", (*_BSD, _ADVERTISING, names)
    yield "Apache-2.0", (_APACHE,)
    yield "Apache-2.0", (_APACHE, "you may not use this file except in compliance with the license")
    yield "Apache-2.0", ("apache license version 2 0 january 2004",)
    yield "MPL-2.0", ("this source code form is subject to the terms of the mozilla public license v",)  # cut in "v. 2.0"
    yield "MPL-2.0", ("mozilla public license version 2 0",)
    yield "ISC", (_ISC.format("or "),)
    yield "ISC", (_ISC.format(""),)
    yield "BSL-1.0", ("distributed under the boost software license version 1 0",)
    yield "BSL-1.0", ("boost software license version 1 0 august 17th 2003",)
    yield "Unlicense", ("this is free and unencumbered software released into the public domain",)


def _with_canonical() -> tuple[dict[str, str], tuple[tuple[tuple[str, ...], str], ...]]:
    """:data:`SENTENCES` and :data:`RULES` with those of the common licences, whose identifiers are numbered by licence."""
    sentences, rules = dict(SENTENCES), dict(RULES)
    for name, parts in _canonical():
        for part in parts:
            sentences.setdefault(part, f"{name.lower().replace('.', '-')}-{len(sentences)}")
        rules.setdefault(tuple(sentences[p] for p in parts), name)
    return sentences, tuple(rules.items())


ALL_SENTENCES, ALL_RULES = _with_canonical()
ALL_RESTRICTED = tuple(sorted({*RESTRICTED, *(n for _, n in ALL_RULES if n.startswith(("GPL", "LGPL", "AGPL")) or "-NC" in n or "-ND" in n)}))

RESULT = T.StructType([
    T.StructField("n_sentences", T.LongType()), T.StructField("n_matches", T.LongType()), T.StructField("sentence_ids", T.StringType()),
    T.StructField("licenses", T.StringType()), T.StructField("restricted", T.BooleanType()),
])
_CUT = re.compile(r"\n|[.;:](?=[\x20\t\r\n]|\Z)")
#: where a sentence ends for good: at punctuation, and at lines without letters and digits
_END = re.compile(r"\n(?:[^0-9A-Za-z\x80-\U0010FFFF\n]*\n)+|[.;:](?=[\x20\t\r\n]|\Z)")
_OTHER = re.compile(r"[^0-9A-Za-z\x80-\U0010FFFF]+")
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def _plain(part: str) -> str:
    return _OTHER.sub(" ", part).strip(" ").translate(_LOWER)


def _sentences(text: str) -> list[str]:
    return [s for part in _CUT.split(text) if (s := _plain(part))]


#: What a sentence with a holder's name says around it, and the name it is known by.
NAMED, NAMED_BY, HOLDER = "neither the name of ", " nor the names of its contributors", "the copyright holder"
HOLDER_WORDS = 12


def parts_pattern(sentences: Iterable[str]) -> str:
    """A pattern for the sentences of a paragraph, whose plain lines stand between line feeds of their own: known ones over any lines, else a line."""
    blank = "(?: |\n\n)"
    named = f"{NAMED}{HOLDER}{NAMED_BY}"
    gap = f"{NAMED}{{0}}{NAMED_BY[1:]}".replace(" ", blank).format(f"(?:[^ \n]+{blank}){{1,{HOLDER_WORDS}}}")
    known = [x.replace(named, "{0}").replace(" ", blank).replace("{0}", gap) for x in sorted(sentences, key=lambda x: (-x.count(" "), x))]
    return "\n(?:" + "|".join(known) + ")\n|\n[^\n]*\n"


GAP = re.compile(f"{NAMED}(?:[^ ]+ ){{1,{HOLDER_WORDS}}}{NAMED_BY[1:]}")


def _joined(text: str, parts: re.Pattern) -> list[str]:
    """As :func:`_sentences`, with known sentences joined that go over several lines of a paragraph."""
    found = []
    for unit in _END.split(text):
        lines = [line for part in unit.split("\n") if (line := _plain(part))]
        if lines:
            found += [x[1:-1].replace("\n\n", " ") for x in parts.findall("\n" + "\n\n".join(lines) + "\n")]
    return [GAP.sub(f"{NAMED}{HOLDER}{NAMED_BY}", x) if x.startswith(NAMED) else x for x in found]


def _matches(ids: list[str], rules: tuple[tuple[tuple[str, ...], str], ...] = RULES) -> list[str]:
    """The licences of the rules that fit, from left to right."""
    found, at = [], 0
    while at < len(ids):
        rule, name = max(((r, n) for r, n in rules if tuple(ids[at : at + len(r)]) == r), key=lambda x: len(x[0]), default=((ids[at],), None))
        if name is not None:
            found.append(name)
        at += len(rule)
    return found


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", sentences: dict[str, str] = ALL_SENTENCES,
         rules: tuple[tuple[tuple[str, ...], str], ...] = ALL_RULES, restricted: tuple[str, ...] = ALL_RESTRICTED) -> DataFrame:
    """Columns ``keep`` of every row with :data:`RESULT`."""
    pattern = parts_pattern(sentences)
    source = docs.select(text, *keep)
    schema = T.StructType([*source.schema.fields[1:], *RESULT.fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = re.compile(pattern)
        for batch in batches:
            rows = []
            for value in pc.fill_null(batch.column(0), ""):
                parts = _joined(value.as_py(), known)
                ids = [sentences[s] for s in parts if s in sentences]
                found = _matches(ids, rules)
                rows.append((len(parts), len(found), ",".join(ids), ",".join(sorted(set(found))), any(n in restricted for n in found)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))], names=schema.names)

    return source.mapInArrow(run, schema)
