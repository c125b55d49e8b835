"""License scans by sentences and rules.

A text is cut into sentences, which are normalised (lower case, letters and digits, single blanks). Known
license sentences have identifiers; the identifiers of a document in order form a sequence, and a license
is found where a rule's identifiers stand in the sequence one after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Sentences of public licenses and notices, normalised, by identifier.
SENTENCES = {
    "mit-notice": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-work": "this work is licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software without restriction including "
                 "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                 "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                 "the following conditions",
    "mit-include": "the above copyright notice and this permission notice shall be included in all copies or "
                   "substantial portions of the software",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-released": "released under the apache license version 2 0",
    "apache-the": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-obtain": "you may obtain a copy of the license at",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl3-notice": "licensed under the gnu general public license version 3",
    "gpl3-released": "released under the gnu general public license version 3",
    "gpl2-work": "this work is licensed under the gnu general public license version 2",
    "gpl2-notice": "licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                "general public license as published by the free software foundation either version 3 of the license "
                "or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                 "general public license as published by the free software foundation either version 2 of the license "
                 "or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even "
                "the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-notice": "licensed under the gnu lesser general public license version 3",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted "
                 "provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and "
                  "the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions "
                  "and the following disclaimer in the documentation and or other materials provided with the "
                  "distribution",
    "bsd-notice": "licensed under the bsd license",
    "bsd3-notice": "licensed under the bsd 3 clause license",
    "cc-by-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-notice": "this work is licensed under the creative commons attribution 4 0 international license",
    "cc-by-sa-work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
                 "hereby granted provided that the above copyright notice and this permission notice appear in all "
                 "copies",
    "reserved": "all rights reserved",
    # Notices with marks inside, as the splitter cuts them.
    "gpl-program": "this program is free software",
    "gpl3-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published "
                  "by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published "
                  "by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-useful": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl-implied": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "mpl-form": "this source code form is subject to the terms of the mozilla public license v",
}
# Ordered rules: (license, identifiers that follow one another). All that hold are reported, each license once.
RULES = (
    ("MIT", ("mit-grant", "mit-include")), ("MIT", ("mit-notice",)), ("MIT", ("mit-licensed",)), ("MIT", ("mit-work",)),
    ("Apache-2.0", ("apache-the", "apache-use")), ("Apache-2.0", ("apache-notice",)), ("Apache-2.0", ("apache-released",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")), ("GPL-2.0-or-later", ("gpl2-free", "gpl-hope")),
    ("GPL-3.0", ("gpl3-work",)), ("GPL-3.0", ("gpl3-notice",)), ("GPL-3.0", ("gpl3-released",)),
    ("GPL-2.0", ("gpl2-work",)), ("GPL-2.0", ("gpl2-notice",)), ("LGPL-3.0", ("lgpl-notice",)), ("MPL-2.0", ("mpl-notice",)),
    ("BSD", ("bsd-grant", "bsd-source", "bsd-binary")), ("BSD", ("bsd-notice",)), ("BSD-3-Clause", ("bsd3-notice",)),
    ("CC-BY-4.0", ("cc-by-work",)), ("CC-BY-4.0", ("cc-by-notice",)), ("CC-BY-SA-4.0", ("cc-by-sa-work",)),
    ("Unlicense", ("unlicense",)), ("ISC", ("isc-grant",)),
    ("GPL-3.0-or-later", ("gpl-program", "gpl3-terms", "gpl-useful", "gpl-implied")),
    ("GPL-2.0-or-later", ("gpl-program", "gpl2-terms", "gpl-useful", "gpl-implied")), ("MPL-2.0", ("mpl-form",)),
)
# Short notices: an opening, a verb and the name of a license; the identifier is the notice itself with hyphens.
OPENINGS = ("", "this project is ", "this work is ", "this file is ")
VERBS = ("released under ", "licensed under ", "distributed under ")


def _names() -> dict[str, str]:
    """License by the words that name it in a short notice."""
    found = {"the apache license version 2 0": "Apache-2.0", "apache 2 0": "Apache-2.0", "cc0": "CC0-1.0", "cc0 1 0": "CC0-1.0",
             "cc0 1 0 universal": "CC0-1.0", "the creative commons zero v1 0 universal license": "CC0-1.0",
             "the unlicense": "Unlicense"}
    for words, name in (("mit", "MIT"), ("isc", "ISC"), ("bsd", "BSD"), ("bsd 2 clause", "BSD-2-Clause"),
                        ("bsd 3 clause", "BSD-3-Clause")):
        found |= {f"the {words} license": name, words: name}
    for short, long, n in (("gpl", "gnu general", 2), ("gpl", "gnu general", 3), ("agpl", "gnu affero general", 3),
                           ("lgpl", "gnu lesser general", 3), ("mpl", "mozilla", 2)):
        found |= {words: f"{short.upper()}-{n}.0" for words in (
            f"the {long} public license version {n}", f"the {long} public license version {n} 0",
            f"the {long} public license v{n} 0", f"{short} {n} 0", f"{short}v{n}", f"the {short}v{n}")}
    long = {"by": "attribution", "nc": "noncommercial", "nd": "noderivatives", "sa": "sharealike"}
    for kind in ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"):
        name, words = f"CC-{kind.upper().replace(' ', '-')}", " ".join(long[k] for k in kind.split())
        found |= {f"cc {kind}": name, f"cc {kind} 4 0": f"{name}-4.0", f"cc {kind} 3 0": f"{name}-3.0"}
        found |= {f"{the} creative commons {words} 4 0 international license": f"{name}-4.0" for the in ("a", "the")}
    return found


NAMES = _names()
# What code looks up in one map; SENTENCES and RULES also list all short notices.
KNOWN, ORDERED = dict(SENTENCES), RULES
_LISTED = {o + v + n: name for o in OPENINGS for v in VERBS for n, name in NAMES.items()}
_LISTED = {words: name for words, name in _LISTED.items() if words not in set(KNOWN.values())}
SENTENCES |= {words.replace(" ", "-"): words for words in _LISTED}
RULES += tuple((name, (words.replace(" ", "-"),)) for words, name in _LISTED.items())
_OPENING = f"^({'|'.join(o for o in OPENINGS if o)})?({'|'.join(VERBS)})"
# Every known sentence has one of these words, so texts without them have no sentence to look for.
MARKERS = r"(?i)licen|permission|copyright|redistribut|warrant|free[^a-z0-9]+software|(releas|distribut)ed[^a-z0-9]+under|public[^a-z0-9]+domain|rights[^a-z0-9]+reserved"
# A sentence ends at marks before white space or the end, or at an empty line.
_END, _CUT = r"[.;:!?]+([ \t\r\n]|$)", "\x1e|\n[ \t\r]*\n"
_GLUE = r"[^a-z0-9]+"


def _normal(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), _GLUE, " "))


def _named() -> Column:
    return F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])


def identifiers(text: Column) -> Column:
    """The identifiers of the known sentences of a text in order.

    Sentences may run over line ends; one that is not known is looked at line by line.
    """
    known = F.create_map(*[F.lit(x) for name, words in KNOWN.items() for x in (words, name)])
    short = lambda n: F.when(n.rlike(_OPENING) & F.try_element_at(_named(), F.regexp_replace(n, _OPENING, "")).isNotNull(),
                             F.replace(n, F.lit(" "), F.lit("-")))
    look = lambda s: F.coalesce(F.try_element_at(known, _normal(s)), short(_normal(s)))
    sentences = F.split(F.regexp_replace(text, _END, "\x1e$1"), _CUT, -1)
    found = F.transform(sentences, lambda s: F.transform(F.array(look(s)), lambda whole: F.when(
        whole.isNotNull(), F.array(whole)).otherwise(F.transform(F.split(s, "\n", -1), look)))[0])
    none = F.array().cast("array<string>")
    return F.when(text.rlike(MARKERS), F.filter(F.flatten(found), lambda i: i.isNotNull())).otherwise(none)


def license_scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``sentence_ids`` (identifiers in order) and ``licenses`` (sorted, each once).

    Whole texts are scanned row by row, with no shuffle; a null or empty text has neither. Columns
    of these names are replaced, all others and repeated rows stay.
    """
    out = docs.withColumn("sentence_ids", identifiers(F.coalesce(F.col(text), F.lit(""))))
    line = F.concat(F.lit(","), F.array_join("sentence_ids", ","), F.lit(","))
    rules = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(f",{','.join(ids)},").alias("ids"))
                      for name, ids in ORDERED])
    held = F.transform(F.array(line), lambda l: F.transform(
        F.filter(rules, lambda r: F.contains(l, r["ids"])), lambda r: r["license"]))[0]
    brief = F.filter(F.transform("sentence_ids", lambda i: F.try_element_at(_named(), F.regexp_replace(
        F.replace(i, F.lit("-"), F.lit(" ")), _OPENING, ""))), lambda i: i.isNotNull())
    held = F.concat(held, brief)
    none = F.array().cast("array<string>")
    return out.withColumn("licenses", F.when(F.size("sentence_ids") > 0, F.array_sort(F.array_distinct(held)))
                          .otherwise(none))
