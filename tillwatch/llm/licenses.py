"""License scans; DataFrame functions only.

Base: places where the words of a phrase stand one after another. Words are runs of ASCII
letters, digits and characters beyond ASCII; A-Z count as a-z.

Templates: an exact set-similarity join of text blocks with license notices. A block is any run of words within a sentence (or between blank lines)
that is at most half as long again as the template; it meets the template if it holds at least ``threshold`` of the template's
different words. Tokens are ordered by how often they occur in the whole corpus, rarest first.
The prefix filter looks at the rarest tokens only: two sets that share the needed number
``need`` of tokens also share one among the first ``|set| - need + 1`` of each. The length filter
drops texts with fewer than ``need`` tokens, the positional filter those whose tokens after the
shared one are too few; for what is left the best block is found exactly. The templates' prefixes are a small map within the plan, looked
up where a text is read: no text and no token is shuffled, so frequent tokens gather nowhere. Only words of some template matter
for containment, so a text's set is at most as large as the vocabulary of the templates, however long.

Labels are those of all templates that a sentence meets, without variants: a template whose words in its best
block are all words of one that is met with a larger share ("CC BY-NC" beside "CC BY"), and of equally
good ones a template that is part of another ("CC BY" in "CC BY-NC"). ``blocks`` has every template met. Null and empty texts have
no words, labels or places. Every row is judged by itself, so null and repeated ids and rows do no harm.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

PHRASES = {
    "gpl": ("gnu", "general", "public", "license"),
    "apache": ("apache", "license"),
    "cc-by": ("cc", "by"),
    "mit": ("mit", "license"),
}

#: Wordings of common license notices.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd-3-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-2-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0-1.0", "this work is dedicated to the public domain under creative commons cc0 1 0 universal"),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl-3.0", "this library is licensed under the gnu lesser general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)

#: What stands between words of a text whose capitals are still there.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Between texts: the end of a sentence or clause with white space behind it, or a blank line.
BETWEEN_TEXTS = r"[.!?;][\x20\x09-\x0D]+|\n[ \t\r]*\n"


@dataclass(frozen=True)
class Template:
    label: str
    tokens: tuple[str, ...]
    need: int

    #: words of the longest block
    longest: int

    @property
    def prefix(self) -> int:
        return len(self.tokens) - self.need + 1


def count_words(text: Column) -> Column:
    parts = F.split(text, BETWEEN, -1)
    return F.size(parts) - (F.element_at(parts, 1) == "").cast("int") - ((F.element_at(parts, -1) == "") & (F.size(parts) > 1)).cast("int")


def word_list(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), BETWEEN, -1), lambda w: w != "")


def places(words: Column, phrase: tuple[str, ...]) -> Column:
    """Starts of a phrase in a word list."""

    def here(i: Column) -> Column:
        found = F.get(words, i) == phrase[0]
        for k, word in enumerate(phrase[1:], 1):
            found = found & (F.get(words, i + k) == word)
        return F.coalesce(found, F.lit(False))

    at = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(at, here)


def corpus_order(docs: DataFrame, vocabulary: list[str]) -> list[str]:
    """The words, rarest in the corpus first. One count for each of them reaches the driver."""
    tokens = docs.select(F.explode(F.split(F.lower("text"), BETWEEN, -1)).alias("token")).where(F.col("token").isin(vocabulary))
    often = {r["token"]: r["count"] for r in tokens.groupBy("token").count().collect()}
    return sorted(vocabulary, key=lambda w: (often.get(w, 0), w))


def template_sets(docs: DataFrame, templates, threshold: float) -> tuple[list[str], list[Template]]:
    """(all words of the templates, rarest in the corpus first; the templates' words in this order)."""
    order = corpus_order(docs, sorted({w for _, text in templates for w in text.split()}))
    rank = {w: i for i, w in enumerate(order)}
    sets = []
    for label, text in templates:
        own = tuple(sorted(set(text.split()), key=rank.__getitem__))
        sets.append(Template(label, own, math.ceil(threshold * len(own) - 1e-9), -(-3 * len(text.split()) // 2)))
    return order, sets


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _strings(words: Iterable[str]) -> Column:
    return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")


def met_in(words: Column, order: list[str], sets: list[Template]) -> Column:
    """Templates met by a word list: template (its number), n (its different words in the best block), own (these)."""
    heads: dict[str, list[Column]] = {}
    for i, t in enumerate(sets):
        for at in range(t.prefix):
            entry = F.struct(F.lit(i).alias("template"), F.lit(len(t.tokens) - at).alias("left"), F.lit(t.need).alias("need"))
            heads.setdefault(t.tokens[at], []).append(entry)
    by_token = F.create_map(*(c for token, entries in heads.items() for c in (F.lit(token), F.array(*entries))))
    least = min(t.need for t in sets)
    tokens, needs, longest = F.array(*(_strings(t.tokens) for t in sets)), F.array(*(F.lit(t.need) for t in sets)), F.array(*(F.lit(t.longest) for t in sets))

    def near(own: Column) -> Column:
        """Templates that pass the filters; ``own``: the text's words of templates, rarest first."""

        def of(token: Column, at: Column) -> Column:
            left = F.size(own) - at
            # the shared token is in the prefix of the text, and enough tokens follow on either side
            fits = F.filter(F.element_at(by_token, token), lambda e: (left >= e["need"]) & (e["left"] >= e["need"]))
            return F.coalesce(F.transform(fits, lambda e: e["template"]), F.array().cast("array<int>"))

        first = F.slice(own, 1, F.greatest(F.size(own) - least + 1, F.lit(0)))
        passed = F.array_distinct(F.flatten(F.transform(first, of)))
        return F.filter(passed, lambda i: F.size(F.array_intersect(F.get(tokens, i), own)) >= F.get(needs, i))

    def best(i: Column) -> Column:
        """The block with most of the template's words; of equal ones the first."""
        places = F.filter(F.transform(words, lambda w, p: F.struct(p.alias("p"), w.alias("w"))), lambda h: F.array_contains(F.get(tokens, i), h["w"]))
        length = F.get(longest, i)

        def block(hits: Column, h: Column, k: Column) -> Column:
            own = F.array_distinct(F.transform(F.filter(F.slice(hits, k + 1, length), lambda g: g["p"] < h["p"] + length), lambda g: g["w"]))
            return let(own, lambda own: F.struct(F.size(own).alias("n"), (-h["p"]).alias("at"), own.alias("own")))

        found = let(places, lambda hits: F.array_max(F.transform(hits, lambda h, k: block(hits, h, k))))
        return let(found, lambda f: F.struct(i.alias("template"), f["n"].alias("n"), f["own"].alias("own")))

    own = F.array_intersect(_strings(order), words)
    met = let(own, lambda own: F.transform(near(own), best))
    return F.filter(met, lambda m: m["n"] >= F.get(needs, m["template"]))


def texts_between(text: Column) -> Column:
    """Word lists of sentences."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), BETWEEN_TEXTS, -1), word_list)


def without_variants(met: Column, sets: list[Template]) -> Column:
    """Labels of the templates met, but for variants of better ones."""
    both = {}
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            common = sorted(set(a.tokens) & set(b.tokens))
            if a.label != b.label and len(common) >= a.need:
                both[i * len(sets) + j] = common
    sizes, labels = F.array(*(F.lit(len(t.tokens)) for t in sets)), F.array(*(F.lit(t.label) for t in sets))
    size = lambda m: F.get(sizes, m["template"])
    if both:
        common = F.create_map(*(c for k, words in both.items() for c in (F.lit(k), _strings(words))))

        def explained(x: Column, y: Column) -> Column:
            words = F.element_at(common, x["template"] * len(sets) + y["template"])
            # shares as whole numbers
            mine, other = x["n"] * size(y), y["n"] * size(x)
            better = (other > mine) & (F.size(F.array_intersect(x["own"], words)) == x["n"])
            part = (other == mine) & (F.size(words) == size(x)) & (size(y) > size(x))
            return words.isNotNull() & (better | part)

        kept = F.filter(met, lambda x: ~F.exists(met, lambda y: F.coalesce(explained(x, y), F.lit(False))))
    else:
        kept = met
    return F.transform(kept, lambda m: F.get(labels, m["template"]))


def blocks(docs: DataFrame, templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """One row per row of ``docs``, sentence and template that it meets: content (SHA-256), part (number of the sentence), own (the template's words in the best block), template (its number), label, share."""
    order, sets = template_sets(docs, templates, threshold)
    rows = docs.select(content(F.col("text")).alias("content"), F.posexplode(F.transform(texts_between(F.col("text")), lambda words: met_in(words, order, sets))).alias("part", "met"))
    rows = rows.select("content", "part", F.inline("met"))
    labels, sizes = F.array(*(F.lit(t.label) for t in sets)), F.array(*(F.lit(len(t.tokens)) for t in sets))
    return rows.select("content", "part", "own", "template", F.get(labels, F.col("template")).alias("label"), (F.col("n") / F.get(sizes, F.col("template"))).alias("share"))


def content(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """One row per document: doc_id, n_words, places (phrase label to starts), labels of templates, containment (0 without any)."""
    text = F.coalesce("text", F.lit(""))
    probe = "|".join(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+".join(p) for p in PHRASES.values())
    none = F.struct(*(F.array().cast("array<int>").alias(label) for label in PHRASES))
    # the one-element array binds the word list, which would else be split again for every place
    found = F.element_at(F.transform(F.array(word_list(text)), lambda words: F.struct(*(places(words, phrase).alias(label) for label, phrase in PHRASES.items()))), 1)
    order, sets = template_sets(docs, templates, threshold)
    sizes = F.array(*(F.lit(len(t.tokens)) for t in sets))
    met = F.transform(texts_between(text), lambda words: met_in(words, order, sets))
    rows = docs.select("doc_id", count_words(text).cast("long").alias("n_words"), F.when(text.rlike(f"(?i){probe}"), found).otherwise(none).alias("places"), met.alias("met"))
    labels = F.array_sort(F.array_distinct(F.flatten(F.transform("met", lambda m: without_variants(m, sets)))))
    shares = F.transform(F.flatten("met"), lambda m: m["n"] / F.get(sizes, m["template"]))
    return rows.select("doc_id", "n_words", "places", labels.alias("labels"), F.coalesce(F.array_max(shares), F.lit(0.0)).alias("share"))
