"""Licence scan by canonical digests, in DataFrame functions only.

A text is brought to a canonical form: lower case, equivalent spellings, copyright lines,
list marks and punctuation taken out, white space collapsed. The SHA-256 digest of the
canonical form of a whole text is joined to the digests of known licence texts, which go
through the same expressions. Full texts lie in ``licence_texts``, one file a text, named by
licence and, after an @, edition.

Defined cases: null and empty texts, and texts of copyright lines only, have no digest and
match nothing; a text known under several ids matches the smallest; repeated documents
are judged one by one; extra columns are ignored; no known texts, no match.
"""

from __future__ import annotations

import re
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings, and what licence texts write for the same, as they stand after
# punctuation is taken out.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "authorisation": "authorization",
    "copyright holder s": "copyright holders",
    "favour": "favor",
    "fulfil ": "fulfill ",
    "https": "http",
    "initialise": "initialize",
    "judgement": "judgment",
    "licence": "license",
    "non commercial": "noncommercial",
    "non infringement": "noninfringement",
    "organisation": "organization",
    "per cent": "percent",
    "recognise": "recognize",
    "sub license": "sublicense",
    "utilisation": "utilization",
}

# Texts of short licences and notices; the longer ones are files.
KNOWN = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "MIT-notice": "Released under the MIT License.",
    "MIT": """MIT License
Copyright (c) <year> <copyright holders>
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """ISC License
Copyright (c) <year> <owner>
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "Zlib": """zlib License
Copyright (C) <year> <owner>
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>""",
}


#: Words after ``copyright`` at the start of a line that make it a line of the terms.
PROSE = "notices?|holders?|owners?|licen[sc]es?|laws?|and|or|interests?|in|is|to|of|on|act|treaty|protection|disclaimer|statements?|does|rights?|permission|status|under|material|works?|control|ownership"
#: A line that names who holds the rights: it starts with the word or a sign, possibly after
#: comment marks. ``(c)`` is a sign only before a year or the word; it also numbers clauses.
COPYRIGHT_LINE = (
    r"(?m)^[^\p{L}\p{N}\n©(]*+(?:copyright\b(?![ \t]+(?:" + PROSE + r")\b)|©|\(c\)[ \t]*+(?:copyright\b|[0-9]{4}|[<\[]))[^\n]*+$"
)
RESERVED_LINE = r"(?m)^[^\p{L}\p{N}\n]*+all rights reserved\b[^\p{L}\p{N}\n]*+$"


def canonical(text: Column) -> Column:
    """The same for texts that differ in case, punctuation, copyright lines or spelling."""
    out = F.lower(text)
    for line in (COPYRIGHT_LINE, RESERVED_LINE):
        out = F.regexp_replace(out, line, " ")
    out = F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]++", " "))
    for spelling, same in SPELLINGS.items():
        out = F.replace(out, F.lit(spelling), F.lit(same))
    return out


def digest(text: Column) -> Column:
    """Null where nothing is left."""
    return F.nullif(F.sha2(canonical(text), 256), F.sha2(F.lit(""), 256))


#: Where the terms end and advice on applying them may follow.
TERMS_END = r"(?m)^[ \t]*END OF TERMS AND CONDITIONS[ \t]*$"
ADVICE = r"(?m)^[ \t]*(?:ADDENDUM: How to use this License|(?:Appendix: )?How to Apply These Terms)"
TITLE = r"\A\s*(?:MIT|ISC|zlib|BSD [23]-Clause) License[ \t]*\n"


def editions(text: str) -> set[str]:
    """A whole licence text as it is usually given: with and without title, reserved rights,
    numbers of clauses, and advice after the terms."""
    out = {text}
    for stop in (TERMS_END, ADVICE):
        found = re.search(stop, text)
        if found:
            out |= {text[: found.start()], text[: found.end()] if stop == TERMS_END else text[: found.start()]}
    out |= {re.sub(TITLE, "", t) for t in out}
    out |= {t.replace("Redistribution and use in source", "All rights reserved.\n\nRedistribution and use in source", 1) for t in out}
    if "Redistribution and use in source" in text:
        out |= {re.sub(r"(?m)^[ \t]*All rights reserved\.[ \t]*$", "", t) for t in out}
        out |= {re.sub(r"(?m)^[ \t]*[1-3]\.[ \t]+", "* ", t) for t in out}
    return out


def known_texts() -> list[tuple[str, str]]:
    """``licence_id, text`` of all known licences and notices in their editions."""
    stored = [(f.name.removesuffix(".txt").split("@")[0], f.read_text(encoding="utf-8")) for f in files("tillforge.llm").joinpath("licence_texts").iterdir()]
    return sorted({(name, t) for name, text in [*KNOWN.items(), *stored] for t in editions(text)})


def known_digests(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """``digest, licence_id``; one row a digest."""
    rows = known_texts() if texts is None else list(texts.items())
    known = spark.createDataFrame(rows, "licence_id string, text string").select(digest(F.col("text")).alias("digest"), "licence_id")
    return known.filter("digest is not null").groupBy("digest").agg(F.min("licence_id").alias("licence_id"))


def scan(documents: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id, digest, licence_id, is_licence``: a row per document."""
    digests = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest(F.col("text")).alias("digest"))
    return digests.join(known, "digest", "left").select(
        "doc_id", "digest", "licence_id", F.col("licence_id").isNotNull().alias("is_licence")
    )
