"""License scans by sentences: known sentences become identifiers, ordered rules over identifiers name licenses.

DataFrame functions only. Identifiers of a text are those of its known sentences, in order; other sentences don't count.
A rule holds where its identifiers follow each other.

SENTENCES, RULES, SIGN and BOUNDARY are also those of the SQL. What scan() knows besides is in FURTHER_SENTENCES and
ALL_RULES; on texts that hold any of it the SQL finds less.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licenses as normalised (lower case, letters and digits only), and what they are.
SENTENCES = {
    "all rights reserved": "reserved",
    "licensed under the apache license version 2 0": "apache2",
    "licensed under the apache license version 2 0 the license": "apache2-notice",
    "you may not use this file except in compliance with the license": "apache-comply",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache-copy",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "this software is released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "this work is licensed under the gnu general public license version 3": "gpl3",
    "licensed under the gnu general public license version 3": "gpl3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "licensed under cc by 4 0": "ccby4",
    "licensed under cc by sa 4 0": "ccbysa4",
    "licensed under cc by nc 4 0": "ccbync4",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccby4",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "ccbysa4",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "ccbync4",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2",
}
# License and the identifiers it needs, in order.
RULES = (
    ("LicenseRef-all-rights-reserved", ("reserved",)),
    ("Apache-2.0", ("apache2",)),
    ("Apache-2.0", ("apache2-notice", "apache-comply")),
    ("MIT", ("mit",)),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("ISC", ("isc-grant",)),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL-3.0-only", ("gpl3",)),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-warranty")),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-warranty")),
    ("CC-BY-4.0", ("ccby4",)),
    ("CC-BY-SA-4.0", ("ccbysa4",)),
    ("CC-BY-NC-4.0", ("ccbync4",)),
    ("MPL-2.0", ("mpl2",)),
)
# Every known sentence has one of these, so sentences without them need not be looked up (a test asserts it).
SIGNS = ("licen", "rights reserved", "permi", "copyright", "warrant")
SIGN = "(?i)licen|rights[^a-z0-9]+reserved|permi|copyright|warrant"
BOUNDARY = r"[.!?]+(?:[ \t\r\n\f]+|\z)|\n[ \t\r\f]*\n"

# One to sixteen words in place of this name a holder or an organisation.
NAME = "<name>"
_ENDORSE = "may {}be used to endorse or promote products derived from this software without specific prior written permission"
FURTHER_SENTENCES = {
    "this source code form is subject to the terms of the mozilla public license version 2 0": "mpl2",
    "licensed under the mozilla public license v 2 0": "mpl2",
    "licensed under the mozilla public license version 2 0": "mpl2",
    f"neither the name of {NAME} nor the names of its contributors " + _ENDORSE.format(""): "bsd-endorse",
    f"neither the name of {NAME} nor the names of his contributors " + _ENDORSE.format(""): "bsd-endorse",
    f"neither the name of {NAME} nor the names of their contributors " + _ENDORSE.format(""): "bsd-endorse",
    f"neither the name {NAME} nor the names of its contributors " + _ENDORSE.format(""): "bsd-endorse",
    f"neither the names of {NAME} nor the names of its contributors " + _ENDORSE.format(""): "bsd-endorse",
    f"the name of {NAME} " + _ENDORSE.format("not "): "bsd-endorse",
    f"the names of {NAME} " + _ENDORSE.format("not "): "bsd-endorse",
    "all advertising materials mentioning features or use of this software must display the following acknowledgement": "bsd-advertise",
    "all advertising materials mentioning features or use of this software must display the following acknowledgment": "bsd-advertise",
}
_BSD = ("bsd-grant", "bsd-source", "bsd-binary")
ALL_RULES = (
    ("BSD-4-Clause", (*_BSD, "bsd-advertise", "bsd-endorse")),
    ("BSD-3-Clause", (*_BSD, "bsd-endorse")),
    *RULES,
)
_ALL_SIGN = SIGN + "|advertising[^a-z0-9]+materials"
# Ends of sentences, but not the dot of `v. 2.0`; parts of a sentence end at semicolons, colons and lines.
_ALL_BOUNDARY = r"(?<!(?<![A-Za-z0-9])[vV](?=\.))[.!?]+(?:[ \t\r\n\f]+|\z)|\n[ \t\r\f]*\n"
_BULLET = r"(^|[;:\n])[^a-z0-9;:\n]*\(?(?:[a-z]|[0-9]{1,2})\)"
_PART = "[^a-z0-9]*[;:\n][^a-z0-9]*"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def _pattern(sentence: str) -> str:
    """The words of a sentence, with ends of parts between any of them."""
    gap = r" (?:\| )?"
    return gap.join(rf"[a-z0-9]+(?:{gap}[a-z0-9]+){{0,15}}?" if w == NAME else re.escape(w) for w in sentence.split())


def scan(
    docs: DataFrame,
    sentences: Mapping[str, str] = SENTENCES | FURTHER_SENTENCES,
    rules: Sequence[tuple[str, tuple[str, ...]]] = ALL_RULES,
    sign: str = _ALL_SIGN,
) -> DataFrame:
    """(doc_id, identifiers, licenses, n_known), one row per input row.

    Sentences end at . ! ? before white space (but for `v.`), at blank lines and at the end. Their parts end at semicolons,
    colons and lines, and begin behind marks like (a) or 1); one or more parts in a row that are a known sentence are found, the longest first. `sign` is a pattern
    that every known sentence holds. `identifiers` are joined by spaces in text order, `licenses` by commas, each once, in the
    order of the rules; where a rule holds, rules of its leading identifiers, later in the order, don't. A NULL or empty text
    has none. Other columns are not read; an empty table gives an empty one.
    """
    known = F.create_map(*[F.lit(x) for s, i in sentences.items() if NAME not in s.split() for x in (s, i)])
    named = [(s, i) for s, i in sentences.items() if NAME in s.split()]
    longest = sorted(sentences, key=lambda s: (-len(s.split()), s))
    pattern = rf"(?:(?<=^)|(?<=\| ))(?:{'|'.join(map(_pattern, longest))})(?= \||$)"
    parts = F.filter(F.split(F.col("text"), _ALL_BOUNDARY), lambda s: s.rlike(sign))

    def identifier(sentence: Column) -> Column:
        exact = F.try_element_at(known, sentence)
        return F.coalesce(exact, *[F.when(sentence.rlike(f"^{_pattern(s)}$"), F.lit(i)) for s, i in named])

    def look_up(sentence: Column) -> Column:
        line = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(sentence), _BULLET, "$1\n"), _PART, " | "), "[^a-z0-9|]+|(?<! )\\||\\|(?! )", " "))
        found = F.regexp_extract_all(F.regexp_replace(line, r"^(?:\| ?)+", ""), F.lit(pattern), F.lit(0))
        return F.transform(found, lambda x: identifier(F.replace(x, F.lit(" |"), F.lit(""))))

    found = F.when(F.col("text").rlike(sign), F.flatten(F.transform(parts, look_up)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.concat_ws(" ", found).alias("identifiers"))
    whole = F.concat(F.lit(" "), F.regexp_replace("identifiers", " ", "  "), F.lit(" "))
    holds = []
    for at, (name, ids) in enumerate(rules):
        # Places where a longer rule holds that begins with these identifiers don't count.
        line = whole
        for _, other in rules[:at]:
            if len(other) > len(ids) and other[: len(ids)] == ids:
                line = F.replace(line, F.lit(_run(other)), F.lit(" - "))
        holds.append(F.when(F.contains(line, F.lit(_run(ids))), name))
    n_known = F.when(F.col("identifiers") == "", 0).otherwise(F.size(F.split("identifiers", " "))).cast("long")
    licenses = F.array_join(F.array_distinct(F.filter(F.array(*holds), lambda n: n.isNotNull())), ",")
    return rows.select("doc_id", "identifiers", licenses.alias("licenses"), n_known.alias("n_known"))


def _run(ids: Sequence[str]) -> str:
    return "".join(f" {i} " for i in ids)
