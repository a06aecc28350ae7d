"""Licence recognition by sentences and rules, in DataFrame functions only.

A text is cut into sentences, these are normalised and looked up among known licence
sentences, and the identifiers a text is left with, in order, are matched against ordered rules. A
rule is a run of identifiers; what an earlier rule has matched is taken away from later ones.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Identifiers of licence sentences, as normalised by `normalised`.
SENTENCES = [
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "licensed under the apache license version 2 0 the license"),
    ("apache-2-compliance", "you may not use this file except in compliance with the license"),
    ("apache-2-copy", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("as-is-basis", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("see-license", "see the license for the specific language governing permissions and limitations under the license"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "this project is licensed under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit-notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-warranty", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("isc-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("gpl-free", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2-free", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-warranty", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("lgpl-3", "this work is licensed under the gnu lesser general public license version 3"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc-4", "licensed under cc by nc 4 0"),
    ("cc-by-nc-4", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa-4", "licensed under cc by sa 4 0"),
    ("cc-by-4", "licensed under cc by 4 0"),
    ("cc-by-4", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "this work is dedicated to the public domain"),
    ("cc0", "licensed under cc0 1 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("reserved", "all rights reserved"),
    ("copyright", "copyright notice"),
]

# Licence rules in the order in which they are tried.
RULES = [
    ("Apache-2.0", ["apache-2", "apache-2-compliance", "apache-2-copy", "as-is-basis", "see-license"]),
    ("Apache-2.0", ["apache-2", "apache-2-compliance"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-warranty"]),
    ("GPL-2.0-or-later", ["gpl-2-free", "gpl-warranty"]),
    ("Proprietary", ["copyright", "reserved"]),
    ("Apache-2.0", ["apache-2"]),
    ("MIT", ["mit"]),
    ("MIT", ["mit-grant"]),
    ("ISC", ["isc-grant"]),
    ("GPL-3.0-only", ["gpl-3"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-2.0-only", ["gpl-2"]),
    ("GPL-2.0-or-later", ["gpl-2-free"]),
    ("LGPL-3.0-only", ["lgpl-3"]),
    ("MPL-2.0", ["mpl-2"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    ("Proprietary", ["reserved"]),
]

# Sentences as the cutter leaves them where a stop parts a known text: the notices of the GNU licences and of Apache.
# Families of the GNU licences: name, words, versions with the dates of their titles.
GNU = [
    ("GPL", "gnu general public license", [("1", "february 1989"), ("2", "june 1991"), ("3", "29 june 2007")]),
    ("LGPL", "gnu library general public license", [("2", "june 1991")]),
    ("LGPL", "gnu lesser general public license", [("2.1", "february 1999"), ("3", "29 june 2007")]),
    ("AGPL", "gnu affero general public license", [("3", "19 november 2007")]),
]
NAMED = ("licensed under", "released under", "this work is licensed under", "this project is licensed under")
LATER = ["or at your option any later version", "or any later version"]


def _spdx(family: str, version: str, how: str) -> str:
    return f"{family}-{version if '.' in version else version + '.0'}-{how}"


def _gnu() -> tuple[list[tuple[str, str]], list[tuple[str, list[str]]]]:
    """Sentences and rules of the notices of the GNU licences, whether a comma or a semicolon stands before the version."""
    things = ("program", "library", "file", "software")
    known = [("gnu-free", f"this {x} is free software") for x in things]
    known += [("gnu-hope", f"this {x} is distributed in the hope that it will be useful but without any warranty") for x in things]
    known.append(("gnu-fitness", "without even the implied warranty of merchantability or fitness for a particular purpose"))
    runs = []
    for family, name, versions in GNU:
        terms = f"you can redistribute it and or modify it under the terms of the {name}"
        published = f"{terms} as published by the free software foundation"
        key = name.split()[1]
        known += [(f"{key}-terms", published), (f"{key}-details", f"see the {name} for more details")]
        for version, date in versions:
            v = version.replace(".", " ")
            later, only = f"{key}-{version}-later", f"{key}-{version}-only"
            known += [(later, f"{published} either version {v} of the license {end}") for end in LATER]
            known += [(f"version-{version}-later", f"either version {v} of the license {end}") for end in LATER]
            known += [(only, f"{published} version {v}{end}") for end in ("", " of the license")]
            known += [(only, f"{terms} version {v} as published by the free software foundation")]
            known += [(f"version-{version}-only", f"version {v}{end}") for end in ("", " of the license")]
            runs += [(_spdx(family, version, "or-later"), [f"{key}-terms", f"version-{version}-later"]), (_spdx(family, version, "or-later"), [later])]
            known += [(f"{key}-{version}-title", f"{name} version {v} {date}")]
            runs.append((_spdx(family, version, "only"), [f"{key}-{version}-title"]))
            for how, ends in (("only", ("",)), ("or-later", (" or later", " or any later version"))):
                known += [(f"{key}-{version}-{how}-named", f"{a} the {name} {b}{v}{end}") for a in NAMED for b in ("version ", "v") for end in ends]
                runs.append((_spdx(family, version, how), [f"{key}-{version}-{how}-named"]))
            runs += [(_spdx(family, version, "only"), [f"{key}-terms", f"version-{version}-only"]), (_spdx(family, version, "only"), [only])]
    held = {x for _, x in SENTENCES}
    return [x for x in dict.fromkeys(known) if x[1] not in held], runs


CUT_SENTENCES = _gnu()[0] + [
    ("apache-2-copy-at", "you may obtain a copy of the license at"),
    ("apache-2-url", "http www apache org licenses license 2 0"),
    ("apache-2-url", "https www apache org licenses license 2 0"),
    ("apache-2-title", "apache license version 2 0 january 2004"),
    ("apache-2-title", "apache license version 2 0 january 2004 http www apache org licenses"),
    ("mit-notice", "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software"),
    ("bsd-names", "neither the name nor the names of contributors may be used"),
    ("bsd-neither", "neither the name of somebody"),
    ("bsd-nor", "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-advertising", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("mpl-2-notice", "this source code form is subject to the terms of the mozilla public license v"),
    ("mpl-2-notice", "this source code form is subject to the terms of the mozilla public license version 2 0"),
    ("mpl-2-title", "mozilla public license version 2 0"),
    ("mpl-1.1-notice", "the contents of this file are subject to the mozilla public license version 1 1 the license"),
    ("mpl-1.1-title", "mozilla public license version 1 1"),
    ("epl-2-notice", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("epl-1-notice", "this program and the accompanying materials are made available under the terms of the eclipse public license 1 0"),
    ("epl-notice", "this program and the accompanying materials are made available under the terms of the eclipse public license v"),
    ("epl-2-at", "2 0 which is available at http www eclipse org legal epl 2 0"),
    ("epl-2-at", "2 0 which is available at https www eclipse org legal epl 2 0"),
    ("epl-2-title", "eclipse public license v 2 0"),
    ("epl-1-title", "eclipse public license v 1 0"),
]
CUT_SENTENCES += [("mpl-2-named", f"{a} the mozilla public license {b}2 0") for a in NAMED for b in ("version ", "v")]
CUT_SENTENCES += [(f"epl-{k}-named", f"{a} the eclipse public license {b}{k} 0") for a in NAMED for b in ("version ", "v", "") for k in (1, 2)]

# Rules tried before RULES, and numbered after them, so that known numbers stay.
CUT_RULES = _gnu()[1] + [
    ("Apache-2.0", ["apache-2", "apache-2-compliance", "apache-2-copy-at", "apache-2-url", "as-is-basis", "see-license"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-neither", "bsd-nor"]),
    ("MPL-2.0", ["mpl-2-notice"]),
    ("MPL-1.1", ["mpl-1.1-notice"]),
    ("EPL-2.0", ["epl-2-notice"]),
    ("EPL-2.0", ["epl-notice", "epl-2-at"]),
    ("EPL-1.0", ["epl-1-notice"]),
    ("MPL-2.0", ["mpl-2-named"]),
    ("EPL-2.0", ["epl-2-named"]),
    ("EPL-1.0", ["epl-1-named"]),
    ("Apache-2.0", ["apache-2-title"]),
    ("MPL-2.0", ["mpl-2-title"]),
    ("MPL-1.1", ["mpl-1.1-title"]),
    ("EPL-2.0", ["epl-2-title"]),
    ("EPL-1.0", ["epl-1-title"]),
]
CUT_SENTENCES += [("apache-2", f"{a} the apache license version 2 0") for a in NAMED[1:]] + [("mit", "this work is licensed under the mit license")]

# The licence tag of source files, and licences that are known by their tag alone.
TAG = "SPDX-License-Identifier"
TAG_WORDS = "spdx license identifier"
TAGGED = ["0BSD", "BSL-1.0", "MIT-0", "PostgreSQL", "Python-2.0", "WTFPL", "Zlib"]
# A tag with its expression: identifiers between OR, AND and WITH, in brackets or not.
TAG_LINE = rf"{TAG}:[ \t]*(\(*[A-Za-z0-9.+-]+\)*(?:[ \t]+(?:OR|AND|WITH|or|and|with)[ \t]+\(*[A-Za-z0-9.+-]+\)*)*)"


def _tags() -> tuple[list[tuple[str, str]], list[tuple[str, list[str]]]]:
    """A sentence and a rule for the tag of each licence; the GNU licences also have tags without "only" and with a plus."""
    names = [x for x in dict.fromkeys([name for name, _ in RULES + CUT_RULES] + TAGGED) if x != "Proprietary"]
    known = []
    for name in names:
        forms = [name]
        if name.endswith("-only"):
            forms.append(name.removesuffix("-only"))
        if name.endswith("-or-later"):
            forms.append(name.removesuffix("-or-later") + "+")
        known += [(f"tag-{name}", f"{TAG_WORDS} " + re.sub("[^a-z0-9+]+", " ", form.lower())) for form in forms]
    return known, [(name, [f"tag-{name}"]) for name in names]


CUT_SENTENCES += _tags()[0]
CUT_RULES += _tags()[1]

# Sentences that only name a licence, of which a document may hold several beside a reservation of its own.
NAMES = {"apache-2", "mit", "gpl-3", "gpl-2", "lgpl-3", "cc-by-nc-4", "cc-by-sa-4", "cc-by-4", "cc0"}
TEXT, TITLE, NAME, RESERVED = range(4)


def _kind(name: str, run: list[str]) -> int:
    """A title counts where no licence's own words do, Proprietary where neither does."""
    if name == "Proprietary":
        return RESERVED
    if all(i.endswith("-title") for i in run):
        return TITLE
    return NAME if all(i in NAMES or i.endswith("-named") for i in run) else TEXT


KNOWN = SENTENCES + CUT_SENTENCES

# Comment marks at the start of lines, line ends inside a sentence, ends of sentences.
COMMENT = r"(^|\n)[ \t]*(?://+|/?\*+/?|#+|;+|--+|%+)[ \t]*"
COPYRIGHT = r"^copyright (?:c )?[0-9]{4} .*$"
VARIED = [
    (COPYRIGHT, "copyright notice"),
    (
        "^neither the names? of .* nor the names of (?:its |the |their |any )?contributors may be used to endorse or promote products "
        "derived from this software without (?:specific )?prior written permission$",
        "neither the name nor the names of contributors may be used",
    ),
    ("^neither the name of (?!.* nor ).*$", "neither the name of somebody"),
    ("^(this program and the accompanying materials are made available under the terms of the eclipse public license) (?:v|v |version )?([12]) 0(?: .*)?$", "$1 $2 0"),
    (
        "^((?:this (?:work|project) is )?(?:licensed|released) under the (?:mit license|apache license version 2 0|mozilla public license (?:version |v)2 0"
        "|gnu (?:lesser |affero )?general public license (?:version |v)[123](?: 1)?(?: or later| or any later version)?)) (?:see|which|you|for|a copy|please|and|with) .*$",
        "$1",
    ),
]
# A list number at the start of a line, and one that follows a stop; a year after (c) makes it no list number.
NUMBER = r"\(?(?:[0-9]{1,2}|[A-Za-z]|[ivx]{2,4})[.)][ \t]+(?![0-9])"
LIST = rf"(^|\n)[ \t]*{NUMBER}"
# A line that goes on in lower case or with a bracket.
GOES_ON = r"(?<![.!?:;\s])[ \t]*\n[ \t]*(?=[a-z(])"
# Ends of sentences that nothing joins again: a stop and blanks, or an empty line. An end begins where blanks do, or at the
# line end itself, so a run of blanks is not gone through again from each of them.
HARD = rf"(?<=[.!?:;])[ \t\n]+(?:{NUMBER})?|(?<![ \t])[ \t]+\n[ \t]*\n[ \t\n]*|\n[ \t]*\n[ \t\n]*"
# What has no letter and no number of three digits is no sentence: rules of dashes, list numbers, versions cut off.
HAS_WORDS = r"\p{L}|[0-9]{3}"


def fragments(text: Column) -> Column:
    """Parts of a text between stops and empty lines, without empty ones and list numbers; other line ends stay in them."""
    # A tag becomes a part of its own, without the stop in it.
    tagged = F.when(F.contains(text, F.lit(TAG)), F.regexp_replace(text, TAG_LINE, f"\n\n{TAG} $1\n\n")).otherwise(text)
    lines = F.regexp_replace(F.regexp_replace(tagged, r"\r\n?", "\n"), COMMENT, "$1")
    lines =F.regexp_replace(F.regexp_replace(lines, LIST, "$1\n"), GOES_ON, " ")
    return F.filter(F.split(lines, HARD), lambda x: F.rlike(x, F.lit(HAS_WORDS)))


def normalised(fragment: Column) -> Column:
    """Lower-cased words of a-z, 0-9 and + with single blanks; a line end between words stays a line end."""
    plain = F.regexp_replace(F.translate(fragment, UPPER, UPPER.lower()), r"[^a-z0-9+\n]+", " ")
    return F.when(F.contains(plain, F.lit("\n")), F.trim(F.regexp_replace(F.trim(plain, F.lit(" \n")), r" ?\n[ \n]*", "\n"))).otherwise(F.trim(plain))


def _begins(known: list[str], blank: str) -> str:
    """Pattern of the first three words of the known sentences, with ``blank`` between words."""
    starts = sorted({tuple(x.split()[:3]) for x in known})
    words = [blank.join(w.replace("+", r"\+") for w in x) for x in starts]
    return "(?:" + "|".join([*words, f"copyright{blank}(?:c{blank})?[0-9]{{4}}"]) + r")(?![a-z0-9+])"


def promising(fragment: Column, known: list[str]) -> Column:
    """Does a line of the fragment begin as a known sentence does? Of the others no word needs to be looked at."""
    return F.rlike(fragment, F.lit(r"(?i)(?:^|\n)[^a-z0-9+\n]*" + _begins(known, "[^a-z0-9+]+")))


def sentences(plain: Column, known: list[str], lead: list[str]) -> Column:
    """Sentences of a normalised fragment.

    Lines are one sentence whatever their case, unless a line begins as a sentence of ``lead`` does. Where lines follow
    a known sentence that has no stop of its own, the longest known beginning is one sentence, the rest another.
    """
    begins = _begins(known, "[ \\n]")
    longest = max(map(len, known))
    whole = lambda x: F.replace(x, F.lit("\n"), F.lit(" "))
    fixed = F.array(*map(F.lit, known))

    def cut(unit: Column) -> Column:
        # Between words stands one character, so no known sentence is longer than the longest one here.
        lines = F.split(F.left(unit, F.lit(longest + 1)), "\n")
        heads = F.transform(lines, lambda _, i: F.array_join(F.slice(lines, 1, i + 1), " "))
        head = F.try_element_at(F.filter(heads, lambda x: F.array_contains(fixed, x)), F.lit(-1))
        head = F.when(F.rlike(unit, F.lit("^" + begins)), head)
        rest = F.substring(whole(unit), F.length(head) + 2, F.length(unit))
        return F.when(head.isNull() | (F.length(head) == F.length(unit)), F.array(whole(unit))).otherwise(F.array(head, rest))

    units = F.split(plain, r"\n(?=" + _begins(lead, "[ \\n]") + ")")
    several = F.flatten(F.transform(units, lambda u: F.when(F.contains(u, F.lit("\n")), cut(u)).otherwise(F.array(u))))
    one = F.when(F.startswith(plain, F.lit(f"{TAG_WORDS} ")), tags(plain)).otherwise(F.array(plain))
    return F.when(F.contains(plain, F.lit("\n")), several).otherwise(one)


def tags(plain: Column) -> Column:
    """A tag's expression as one sentence for each licence in it, without the exceptions after WITH."""
    ids = F.split(F.substring(plain, F.lit(len(TAG_WORDS) + 2), F.length(plain)), " (?:or(?! later)|and) ")
    return F.transform(ids, lambda x: F.concat(F.lit(f"{TAG_WORDS} "), F.regexp_replace(x, " with .*", "")))


def canonical(sentence: Column) -> Column:
    """Sentences with names in them: a copyright line with a year is ``copyright notice``; the third BSD clause and the Eclipse notice lose what differs."""
    for pattern, fixed in VARIED:
        sentence = F.regexp_replace(sentence, pattern, fixed)
    return sentence


def _leads(known: list[tuple[str, str]]) -> list[str]:
    """Sentences whose beginning begins a sentence; a title, a version or the rest of a clause may well begin a line in the middle of a notice."""
    return [x for i, x in known if not i.endswith("-title") and not i.startswith("version-") and i not in ("bsd-nor", "epl-2-at")]


def _token(identifier: str) -> str:
    return f"<{identifier}>"


def licenses(
    docs: DataFrame, known: list[tuple[str, str]] = KNOWN, rules: list[tuple[str, list[str]]] = RULES, first: list[tuple[str, list[str]]] = CUT_RULES
) -> DataFrame:
    """(doc_id, license, rule, n_sentences): each rule that a document's sentences match.

    ``rules`` are numbered from 0, those of ``first`` after them, though they are tried before them. A rule needs
    its identifiers side by side: a sentence that is not known breaks a run, a list number or an
    empty piece does not. Rules are tried in order, and each takes all its matches away from the rest; a rule that matches several times in
    a document gives one row. A title of a licence counts where no notice or text of one does, Proprietary where
    neither does. ``n_sentences`` is the number of known sentences of the document. Null and empty
    texts and texts without a match give no row; repeated rows give theirs each. Only sentences that are known are shuffled.
    """
    spark = docs.sparkSession
    table = spark.createDataFrame(known, "_id string, _sentence string")
    # Rows are numbered first: beside a generator the number would be that of the sentence.
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text")
    cut = rows.select("_row", "doc_id", F.posexplode(fragments(F.col("text"))).alias("_part", "_raw"))
    texts = [x for _, x in known]
    lead = _leads(known)
    plain = cut.filter(promising(F.col("_raw"), texts)).select("_row", "doc_id", "_part", normalised(F.col("_raw")).alias("_plain"))
    own = plain.select("_row", "doc_id", "_part", sentences(F.col("_plain"), texts, lead).alias("_own"))
    single = own.select("_row", "doc_id", "_part", F.posexplode("_own").alias("_sub", "_cut"), F.size("_own").alias("_of"))
    # The list of known sentences is fixed, so it goes to every executor.
    found = single.withColumn("_sentence", canonical(F.col("_cut"))).join(F.broadcast(table), "_sentence")
    found = found.select("_row", "doc_id", F.struct("_part", "_sub", "_of").alias("_at"), "_id")
    runs = found.groupBy("_row").agg(
        F.any_value("doc_id").alias("doc_id"),
        F.count("*").cast("int").alias("n_sentences"),
        F.array_sort(F.collect_list(F.struct(F.col("_at").alias("at"), F.concat(F.lit("<"), "_id", F.lit(">")).alias("t")))).alias("_ids"),
    )
    previous = lambda i: F.when(i > 0, F.get("_ids", i - 1)["at"])

    def follows(at: Column, last: Column) -> Column:
        inside = (at["_part"] == last["_part"]) & (at["_sub"] == last["_sub"] + 1)
        return inside | ((at["_part"] == last["_part"] + 1) & (at["_sub"] == 0) & (last["_sub"] + 1 == last["_of"]))

    parts = F.transform("_ids", lambda x, i: F.concat(F.when(~follows(x["at"], previous(i)), "|").otherwise(""), x["t"]))
    left = F.array_join(parts, "")
    patterns = F.array(
        *[
            F.struct(F.lit(k).alias("rule"), F.lit(name).alias("license"), F.lit(_kind(name, own)).alias("kind"), F.lit("".join(map(_token, own))).alias("run"))
            for k, (name, own) in [*enumerate(first, len(rules)), *enumerate(rules)]
        ]
    )
    none = F.array().cast("array<struct<rule:int,license:string,kind:int>>")

    def step(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["run"])
        took = F.concat(state["hits"], F.array(F.struct(rule["rule"].alias("rule"), rule["license"].alias("license"), rule["kind"].alias("kind"))))
        return F.struct(
            F.when(hit, F.replace(state["left"], rule["run"], F.lit("|"))).otherwise(state["left"]).alias("left"),
            F.when(hit, took).otherwise(state["hits"]).alias("hits"),
        )

    matched = F.aggregate(patterns, F.struct(left.alias("left"), none.alias("hits")), step)["hits"]
    hits = runs.select("doc_id", "n_sentences", matched.alias("_hits"))
    least = F.array_min(F.transform("_hits", lambda x: x["kind"]))
    counts = F.filter("_hits", lambda x: (x["kind"] == NAME) | (x["kind"] == least) | ((x["kind"] == RESERVED) & (least == NAME)))
    return hits.select("doc_id", "n_sentences", F.explode(counts).alias("_hit")).select(
        "doc_id", F.col("_hit.license").alias("license"), F.col("_hit.rule").alias("rule"), "n_sentences"
    )


def duck_sql() -> str:
    """The same in DuckDB SQL, for all sentences and rules.

    DuckDB's patterns have no look-around, so what stands beside a match is matched and put back, twice where two
    matches can touch. Sentences are numbered through a text; a run is broken where numbers are not successive.
    """
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    texts = [x for _, x in KNOWN]
    plainly = lambda begins: begins.removesuffix("(?![a-z0-9+])")
    ends = "(?:[^a-z0-9+]|$)"
    number = r"\(?(?:[0-9]{1,2}|[A-Za-z]|[ivx]{2,4})[.)][ \t]+"
    goes_on = r"([^.!?:;\s])[ \t]*\n[ \t]*([a-z(])"
    lead = rf"\n({plainly(_begins(_leads(KNOWN), '[ \n]'))})([^a-z0-9+]|$)"
    rules = [(k, name, _kind(name, own), "".join(map(_token, own))) for k, (name, own) in [*enumerate(CUT_RULES, len(RULES)), *enumerate(RULES)]]
    steps = ", ".join(quote(f"{k}={run}") for k, _, _, run in rules)
    sentence = "cut"
    for pattern, fixed in VARIED:
        if "(?!" in pattern:
            begin = pattern[1 : pattern.index("(?!")]
            sentence = f"CASE WHEN starts_with({sentence}, {quote(begin)}) AND NOT contains(substr({sentence}, {len(begin) + 1}), ' nor ') THEN {quote(fixed)} ELSE {sentence} END"
        else:
            sentence = f"regexp_replace({sentence}, {quote(pattern)}, {quote(fixed.replace('$', chr(92)))})"
    return rf"""
        WITH known(id, sentence) AS (VALUES {", ".join(f"({quote(i)}, {quote(x)})" for i, x in KNOWN)}),
        rules(rule, license, kind) AS (VALUES {", ".join(f"({k}, {quote(name)}, {kind})" for k, name, kind, _ in rules)}),
        tagged AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_replace(regexp_replace(text, '{TAG_LINE}',
                chr(10) || chr(10) || '{TAG} \1' || chr(10) || chr(10), 'g'), '\r\n?', chr(10), 'g') AS t FROM documents),
        listed AS (
            SELECT doc_id, r, regexp_replace(regexp_replace(regexp_replace(t, '{COMMENT}', '\1', 'g'),
                '(^|\n)[ \t]*{number}([^0-9]|$)', '\1' || chr(10) || '\2', 'g'),
                '(^|\n)[ \t]*{number}([^0-9]|$)', '\1' || chr(10) || '\2', 'g') AS t FROM tagged),
        lines AS (
            SELECT doc_id, r, list_filter(string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                t, '{goes_on}', '\1 \2', 'g'), '{goes_on}', '\1 \2', 'g'),
                '([.!?:;])[ \t\n]+(?:{number}([^0-9 \t\n]))?', '\1' || chr(30) || '\2', 'g'),
                '[ \t]*\n[ \t]*\n[ \t\n]*', chr(30), 'g'), chr(30)), lambda x: regexp_matches(x, '{HAS_WORDS}')) AS s FROM listed),
        parts AS (SELECT doc_id, r, generate_subscripts(s, 1) AS p, unnest(s) AS raw FROM lines),
        plain AS (
            SELECT doc_id, r, p, CASE WHEN NOT regexp_matches(raw, '(?i)(?:^|\n)[^a-z0-9+\n]*{plainly(_begins(texts, "[^a-z0-9+]+"))}{ends}') THEN ''
                ELSE regexp_replace(trim(regexp_replace(translate(raw, '{UPPER}', '{UPPER.lower()}'), '[^a-z0-9+\n]+', ' ', 'g'), ' ' || chr(10)),
                ' ?\n[ \n]*', chr(10), 'g') END AS s FROM parts),
        units AS (
            SELECT doc_id, r, p, s, string_split(CASE WHEN NOT contains(s, chr(10)) THEN s ELSE regexp_replace(regexp_replace(
                s, '{lead}', chr(30) || '\1\2', 'g'), '{lead}', chr(30) || '\1\2', 'g') END, chr(30)) AS u FROM plain),
        unit AS (SELECT doc_id, r, p, contains(s, chr(10)) AS wrapped, generate_subscripts(u, 1) AS k, unnest(u) AS unit FROM units),
        heads AS (
            SELECT *, CASE WHEN wrapped AND contains(unit, chr(10)) AND regexp_matches(unit, '^{plainly(_begins(texts, "[ \n]"))}{ends}') THEN list_filter(
                list_transform(range(1, len(string_split(unit, chr(10))) + 1), lambda i: array_to_string(string_split(unit, chr(10))[1:i], ' ')),
                lambda x: list_contains([{", ".join(map(quote, texts))}], x))[-1] END AS head FROM unit),
        own AS (
            SELECT doc_id, r, p, k, CASE
                WHEN NOT wrapped AND starts_with(unit, '{TAG_WORDS} ') THEN list_transform(
                    string_split(replace(replace(replace(replace(substr(unit, {len(TAG_WORDS) + 2}), ' or later', chr(29)), ' or ', chr(30)), ' and ', chr(30)),
                        chr(29), ' or later'), chr(30)), lambda x: '{TAG_WORDS} ' || regexp_replace(x, ' with .*', ''))
                WHEN head IS NULL OR len(head) = len(unit) THEN [replace(unit, chr(10), ' ')]
                ELSE [head, substr(replace(unit, chr(10), ' '), len(head) + 2)] END AS o FROM heads),
        single AS (SELECT doc_id, r, p, k, generate_subscripts(o, 1) AS j, unnest(o) AS cut FROM own),
        numbered AS (SELECT doc_id, r, row_number() OVER (PARTITION BY r ORDER BY p, k, j) AS n, {sentence} AS sentence FROM single),
        found AS (SELECT doc_id, r, n, id, n - lag(n) OVER (PARTITION BY r ORDER BY n) AS gap FROM numbered JOIN known USING (sentence)),
        runs AS (
            SELECT any_value(doc_id) AS doc_id, r, CAST(count(*) AS INTEGER) AS n_sentences, string_agg(
                CASE WHEN gap > 1 THEN '|' ELSE '' END || '<' || id || '>', '' ORDER BY n) AS run FROM found GROUP BY r),
        matched AS (
            SELECT doc_id, r, n_sentences, list_reduce([run, {steps}], lambda s, x: CASE WHEN contains(s, split_part(x, '=', 2))
                THEN replace(s, split_part(x, '=', 2), '|') || '#' || split_part(x, '=', 1) || ';' ELSE s END) AS state FROM runs),
        hits AS (SELECT doc_id, r, n_sentences, CAST(unnest(regexp_extract_all(state, '#([0-9]+);', 1)) AS INTEGER) AS rule FROM matched),
        counted AS (SELECT *, min(kind) OVER (PARTITION BY r) AS least FROM hits JOIN rules USING (rule))
        SELECT doc_id, license, CAST(rule AS INTEGER) AS rule, n_sentences FROM counted
        WHERE kind = {NAME} OR kind = least OR (kind = {RESERVED} AND least = {NAME})
    """
