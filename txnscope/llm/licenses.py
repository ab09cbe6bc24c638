"""Licence scans by sentence rules, in DataFrame functions only.

A text is normalised (lower case, runs of other characters than letters and digits as one
space) with marks where a sentence can start and end: sentence ends and blank lines, which no
sentence crosses, and single line breaks (with leading comment marks) and ':' or ';', which a
known sentence may cross, so hard-wrapped headers are read as their sentences.  From mark to
mark it is searched for known licence sentences, some with a free tail (a year, a holder),
which may be empty, some with a version.  The identifiers of a text's licence sentences, in order,
are matched against ordered rules: the first rule of each licence whose identifiers occur as
a run names the licence.  All is within a row: no shuffle, no join, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.llm.tables import with_columns

# fixed values: licence sentences, normalised; a last word of "*" stands for any tail
SENTENCES = {
    "mit-notice": "released under the mit license",
    "mit-notice-2": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy *",
    "mit-condition": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind *",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-notice-2": "licensed under the apache license version 2 0 *",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at *",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl3-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license *",
    "gpl-hope": "this program is distributed in the hope that it will be useful *",
    "lgpl-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license *",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted *",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license *",
    "cc-by-notice": "licensed under cc by 4 0",
    "cc-by-sa-notice": "licensed under cc by sa 4 0",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "cc-by-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc0-notice": "this work is dedicated to the public domain under cc0 1 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "reserved": "all rights reserved",
    "copyright": "copyright *",
}
# fixed values: licences and the runs of identifiers that name them, tried in this order
RULES = [
    ("MIT", ["mit-grant", "mit-condition", "as-is"]),
    ("MIT", ["mit-grant", "mit-condition"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-notice-2"]),
    ("Apache-2.0", ["apache-notice-2", "apache-use", "apache-copy"]),
    ("Apache-2.0", ["apache-notice", "apache-use"]),
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-notice-2"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("GPL", ["gpl3-free", "gpl-hope"]),
    ("GPL", ["gpl3-free"]),
    ("LGPL", ["lgpl-free"]),
    ("BSD", ["bsd-grant", "as-is"]),
    ("BSD", ["bsd-grant"]),
    ("MPL-2.0", ["mpl-notice"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("CC-BY-4.0", ["cc-by-work"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-work"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("CC0-1.0", ["cc0-notice"]),
    ("Unlicense", ["unlicense"]),
    ("proprietary", ["copyright", "reserved"]),
    ("proprietary", ["reserved"]),
]
# fixed values: further sentences and their licences, "#" stands for a version (one or two numbers, then any tail);
# the sentences above go first, so these name the versions that they do not
VERSIONED = {
    "apache-version": ("licensed under the apache license version #", "Apache"),
    "gpl-version": ("this work is licensed under the gnu general public license version #", "GPL"),
    "lgpl-version": ("this work is licensed under the gnu lesser general public license version #", "LGPL"),
    "mpl-version": ("the contents of this file are subject to the mozilla public license version #", "MPL"),
    "cc-by-version": ("licensed under cc by #", "CC-BY"),
    "cc-by-sa-version": ("licensed under cc by sa #", "CC-BY-SA"),
    "cc-by-nc-version": ("licensed under cc by nc #", "CC-BY-NC"),
    "cc-by-work-version": ("this work is licensed under a creative commons attribution # international license", "CC-BY"),
    "cc-by-sa-work-version": ("this work is licensed under a creative commons attribution sharealike # international license", "CC-BY-SA"),
}
# fixed values: other wordings of a known sentence
VARIANTS = {
    "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license *": "lgpl-free",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu library general public license *": "lgpl-free",
    "this library is distributed in the hope that it will be useful *": "gpl-hope",
}
# every known sentence has one of these, so a text or sentence without them has no licence sentence
HINT = "(?i)licen[sc]e|copyright|rights reserved|public domain|permission|warrant|redistribut|hope that it will|under cc"
SENTENCE_END = r"[\n\r]+|[.!?:;]+[ \t\f]+"  # of the oracle, which knows sentences on one line only
WRAPPED_HINT = HINT.replace(" ", "[^a-z0-9]+")
# in lower-case text: H, which no sentence crosses, and S, where one can start, end or go on
MARKS = [
    (r"\r\n?", "\n"),
    (r"\n[ \t]*(?:dnl|rem)\b", "\n"),
    (r"\bv(?:er|ersion)?\.[ \t\f\n]+(?=[0-9])", "v "),
    (r"[.!?:;]*[.!?][.!?:;]*[ \t\f\n]", " H\n"),
    (r"\n[^a-zA-Z0-9\n]*(?=\n)", " H"),
    (r"\n|[:;]+[ \t\f]", " S "),
    (r"[^a-z0-9HS]+", " "),
]


def marked(text: Column) -> Column:
    """The normalised words of ``text`` with marks between them and around all."""
    text = F.concat(F.lit("\n"), F.lower(text))
    for pattern, by in MARKS:
        text = F.regexp_replace(text, pattern, by)
    return F.concat(F.lit("H "), F.trim(text), F.lit(" H"))


def _known() -> str:
    """Pattern of all known sentences between marks: a whole sentence takes its closing mark and goes before a free tail."""
    def words(text: str) -> str:
        return " (?:S )*".join("[0-9]+(?: [0-9]+)?" if w == "#" else w for w in text.split())

    whole = [f"{words(t)} [HS]" for t in SENTENCES.values() if not t.endswith(" *")]
    tails = [f"{words(t[:-2])}(?= )" for t in (*SENTENCES.values(), *VARIANTS) if t.endswith(" *")]
    return f"(?<=[HS] )(?:{'|'.join(whole + tails + [words(t) + '(?= )' for t, _ in VERSIONED.values()])})"


def sentence_id(found: Column) -> Column:
    """Identifier of a match of ``_known()``; a version is part of it."""
    plain = F.regexp_replace(F.regexp_replace(found, " [HS]$", " ."), " S(?= )", "")
    names = {t[:-2] if t.endswith(" *") else f"{t} .": name for name, t in SENTENCES.items()} | {t[:-2]: name for t, name in VARIANTS.items()}
    out = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), plain)
    version = F.regexp_replace(F.regexp_extract(plain, "([0-9]+(?: [0-9]+)?)", 1), " ", ".")
    version = F.when(version.contains("."), version).otherwise(F.concat(version, F.lit(".0")))
    of = [F.when(plain.rlike(f"^{t.replace('#', '[0-9]+(?: [0-9]+)?')}$"), F.concat(F.lit(f"{name}-"), version)) for name, (t, _) in VERSIONED.items()]
    return F.coalesce(out, *of)


def _versions(run: Column, sentence: str, name: str) -> Column:
    """The licence ``name`` in each version that the run's identifiers of ``sentence`` bear."""
    return F.transform(F.regexp_extract_all(run, F.lit(f" {sentence}-([0-9.]+)(?= )"), F.lit(1)), lambda n: F.concat(F.lit(f"{name}-"), n))


def scan_licenses(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with sentence_ids (of licence sentences, in order), n_license_sentences, licenses (in the order of the rules).

    The names of versions come last.  A null or empty text has none; rows are independent, so nulls in other columns and repeated rows do not matter;
    columns of ``df`` that bear a result's name are replaced by it.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    sentences = F.transform(F.regexp_extract_all(marked(text), F.lit(_known()), F.lit(0)), sentence_id)
    ids = F.when(text.rlike(WRAPPED_HINT), sentences).otherwise(F.array().cast("array<string>"))
    found = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), ids.alias("ids"))
    run = F.concat(F.lit(" "), F.array_join("ids", " "), F.lit(" "))
    names = F.array(*[F.when(run.contains(f" {' '.join(rule)} "), F.lit(name)) for name, rule in RULES])
    versions = F.flatten(F.array(*[_versions(run, v, name) for v, (_, name) in VERSIONED.items()]))
    return with_columns(found, df.columns, sentence_ids=F.col("ids"), n_license_sentences=F.size("ids"),
                        licenses=F.when(F.size("ids") > 0, F.array_distinct(F.concat(F.array_compact(names), versions))).otherwise(F.array().cast("array<string>")))


def oracle_sql() -> str:
    """The scan of ``documents`` for DuckDB, by lines: the same where every licence sentence lies on one line, without ':' or ';' in it,
    its tail is not empty and it has none of ``VERSIONED`` or ``VARIANTS``."""
    lines = [(name, text[:-1] if text.endswith(" *") else text, text.endswith(" *")) for name, text in SENTENCES.items()]
    known = ", ".join(f"('{name}', '{text}', {str(tail).lower()}, {k})" for k, (name, text, tail) in enumerate(lines))
    rules = ", ".join(f"('{name}', ' {' '.join(rule)} ', {k})" for k, (name, rule) in enumerate(RULES))
    return f"""
WITH known(id, line, tail, place) AS (VALUES {known}),
rules(name, run, place) AS (VALUES {rules}),
cut AS (SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '{SENTENCE_END}')) AS s,
               generate_subscripts(regexp_split_to_array(coalesce(text, ''), '{SENTENCE_END}'), 1) AS n FROM documents),
plain AS (SELECT doc_id, n, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) AS s FROM cut
          WHERE regexp_matches(s, '{HINT}')),
matched AS (SELECT doc_id, n, arg_min(id, place + CASE WHEN tail THEN 1000 ELSE 0 END) AS id FROM plain JOIN known ON s = line OR (tail AND starts_with(s, line)) GROUP BY doc_id, n),
runs AS (SELECT doc_id, count(*) AS n_license_sentences, string_agg(id, ' ' ORDER BY n) AS sentence_ids FROM matched GROUP BY doc_id),
named AS (SELECT doc_id, name, min(place) AS place FROM runs JOIN rules ON contains(' ' || sentence_ids || ' ', run) GROUP BY doc_id, name),
listed AS (SELECT doc_id, string_agg(name, ',' ORDER BY place) AS licenses FROM named GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_license_sentences, 0) AS INTEGER) AS n_license_sentences, coalesce(sentence_ids, '') AS sentence_ids, coalesce(licenses, '') AS licenses
FROM documents d LEFT JOIN runs USING (doc_id) LEFT JOIN listed USING (doc_id)
"""
