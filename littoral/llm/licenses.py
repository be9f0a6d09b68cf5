"""License scans by diagonal voting, in DataFrame operations alone.

Every document becomes its rolling word k-gram hashes, each joined to the
template positions that have the same k-gram. A hit votes for a diagonal (word
position in the document less position in the template). Hits on diagonals that
differ by a few words (insertions and deletions) are merged into spans. Each span
is then verified: only hits in the order of the template count, each position of
the template once, within a span of at most twice the template's words; they have
to cover enough of the template, and the words that decide the license (its name
and version number, ``DECIDES``) have to stand there.
Templates of two or three words count only whole. The templates are fixed and
few, so theirs is the side that is broadcast; documents meet no other document
and are read once.

A document's own row travels through the join as one more gram with a position
of its own, which also one template row has: no second pass over the texts.

Defined results: null and empty texts have no words and no labels; rows are
told apart by an id of their own, so repeated rows and null ``doc_id``s stay
rows; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Grams of the templates that are longer than a phrase.
GRAM = 3
#: Words by which diagonals of one span may differ, and the share of a template's grams that a span needs.
SHIFT, SHARE = 4, 0.6

# The phrases of the base rule and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Sentences by which works state their license, from the public texts of these licenses.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mit-notice": "released under the mit license",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-text": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc-text": "this work is licensed under a creative commons attribution 4 0 international license",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
}

# A version number after a name: at once, or after the first "version" of the next words.
_SKIP = r"(?:(?!(?:version|ver|v) |v?\d+ )[^ ]+ ){0,10}"
_NO_VERSION = rf"(?!{_SKIP}(?:version|ver|v) v?\d+ |v?\d+ )"


def _version(major: str, minor: str | None = None) -> str:
    """A minor number of 0 may be left out, another one may not stand there."""
    return rf"(?:{_SKIP}(?:(?:version|ver|v) |v)|v)?{major} " + ("" if minor is None else rf"(?:{minor} |(?!\d{{1,2}} ))")


def _cc(name: str, *others: str) -> str:
    """The name with version 4.0 or none, and none of the elements that make it another license."""
    return rf"{name} (?!(?:{'|'.join(others)}) )(?:{_version('4', '0')}|{_NO_VERSION})"


# What has to stand in a span for its label, by regular expressions over words that each end in a space.
DECIDES = {
    "apache-2.0": "apache license " + _version("2", "0"),
    "mit-text": "this software ",
    "mit-notice": "mit (?!0 )",
    "gpl-3.0": "(?:gnu|the) general public license " + _version("3"),
    "gpl-text": "(?:gnu|the) general public license ",
    "cc-by": _cc("cc by", "nc", "nd", "sa"),
    "cc-by-nc": _cc("cc by nc", "nd", "sa"),
    "cc-by-sa": _cc("cc by sa", "nc", "nd"),
    "cc-text": _cc("creative commons attribution", "noncommercial", "non", "sharealike", "share", "noderivs", "noderivatives", "no"),
    "bsd-text": "(?:are|is) permitted ",
    "mpl-2.0": "mozilla public license " + _version("2", "0"),
}
#: Words behind a hit that can matter to DECIDES: the name begins in the gram or up to SHIFT words after it, four words of a name, the skipped ones, a version.
NEAR = GRAM + SHIFT + 4 + 10 + 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str) -> Column:
    """Words of the text with A-Z in lower case; never null."""
    low = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(low, _BREAK), lambda w: w != "")


def _templates(spark: SparkSession, phrases: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """``first2, third, name, at, grams, size, decides``: hashes of each gram's first two words and of its third (null in phrases of two)."""
    rows = []
    for name, text in [*((f"phrase:{p}", p) for p in phrases), *templates.items()]:
        w = text.split()
        size = 2 if len(w) == 2 else GRAM
        rows += [(w[i], w[i + 1], w[i + 2] if size > 2 else None, name, i, len(w) - size + 1, len(w), rf"^(?:[^ ]+ ){{0,{GRAM + SHIFT - 1}}}(?:{DECIDES.get(name, '')})") for i in range(len(w) - size + 1)]
    table = spark.createDataFrame(rows, "a string, b string, c string, name string, at int, grams int, size int, decides string")
    own = spark.createDataFrame([("", -1, 0, 0, "")], "name string, at int, grams int, size int, decides string").select(F.lit(0).cast("long").alias("first2"), F.lit(None).cast("long").alias("third"), "name", "at", "grams", "size", "decides")
    hashed = table.select(F.xxhash64("a", "b").alias("first2"), F.when(F.col("c").isNotNull(), F.xxhash64("c")).alias("third"), "name", "at", "grams", "size", "decides")
    return hashed.union(own)


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Per row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``."""
    # The id is fixed beside the scan, before anything can move the row.
    cut = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), words("text").alias("w"))
    n = F.size("w")
    # Only grams whose first two words some template has can hit; these alone carry the words after them.
    pairs = sorted({" ".join(w[i : i + 2]) for w in (t.split() for t in (*phrases, *templates.values())) for i in range(len(w) - 1)})
    grams = F.transform(
        F.filter(F.sequence(F.lit(0), n - 2), lambda i: F.concat_ws(" ", F.get("w", i), F.get("w", i + 1)).isin(pairs)),
        lambda i: F.struct(
            i.alias("pos"),
            F.xxhash64(F.get("w", i), F.get("w", i + 1)).alias("first2"),
            F.xxhash64(F.get("w", i + 2)).alias("third"),
            F.concat(F.array_join(F.slice("w", i + 1, NEAR), " "), F.lit(" ")).alias("near"),
        ),
    )
    # Position -1 is the row itself, its number of words in place of a hash of a third word.
    own = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(0).cast("long").alias("first2"), n.cast("long").alias("third"), F.lit("").alias("near")))
    exploded = cut.select("row", "doc_id", F.explode(F.when(n >= 2, F.concat(own, grams)).otherwise(own)).alias("g")).select("row", "doc_id", "g.*")
    known = _templates(docs.sparkSession, phrases, templates).withColumnRenamed("third", "t_third").withColumnRenamed("first2", "t_first2")
    hits = exploded.join(F.broadcast(known), (F.col("first2") == F.col("t_first2")) & ((F.col("pos") == -1) == (F.col("at") == -1)) & (F.col("t_third").isNull() | (F.col("t_third") == F.col("third"))))
    # Votes of each diagonal, and the hits that gave them.
    hit = F.struct("name", "pos", "at", F.rlike("near", F.col("decides")).alias("decided"), "grams", "size")
    of_template = ~F.col("name").startswith("phrase:") & (F.col("name") != "")
    votes = hits.groupBy("row", "doc_id", "name", "grams", "size", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.count("*").alias("votes"), F.collect_list(F.when(of_template, hit)).alias("hits"), F.max(F.when(F.col("pos") == -1, F.col("third"))).alias("n_words")
    )
    # A phrase stands where its diagonal has all votes; its start is the diagonal.
    whole = (F.col("votes") == F.col("grams")) & F.col("name").startswith("phrase:")
    by_row = votes.groupBy("row", "doc_id").agg(
        F.max("n_words").alias("n_words"),
        F.count_if(whole).alias("n_base"),
        F.min(F.when(whole, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(whole, F.col("diagonal"))).cast("long").alias("last_word"),
        F.array_sort(F.collect_set(F.when(whole, _label(phrases)))).alias("base"),
        F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"),
    )
    merged = by_row.withColumn("spans", _verified("hits"))
    labels = F.array_sort(F.array_union("base", F.array_distinct(F.transform("spans", lambda s: s["name"]))))
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(best)
    return merged.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"), "spans")


def _label(phrases: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for p, label in phrases.items():
        out = F.when(F.col("name") == f"phrase:{p}", label).otherwise(out)
    return out


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _verified(hits: str) -> Column:
    """Verified spans of the hits, which are sorted by name and position: places of their first and last word, votes and share of the template.

    For each hit the best chain that ends there is found, and the best one that has
    the deciding words. A chain's hits are in order in document and template and
    neighbours differ by at most SHIFT words, so no position of the template counts
    twice. Of spans that share words the one with the most votes counts.
    """
    chain = "struct<votes:int,start:int,decided:boolean,name:string,last:int,at:int>"
    span = "struct<name:string,start:int,last:int,votes:bigint,share:double,size:int>"
    empty = F.struct(F.array().cast(f"array<{chain}>").alias("live"), F.array().cast(f"array<{span}>").alias("spans"))

    def at_hit(h: Column, votes: Column, start: Column, decided: Column) -> Column:
        return F.struct(votes.alias("votes"), start.alias("start"), decided.alias("decided"), h["name"].alias("name"), h["pos"].alias("last"), h["at"].alias("at"))

    def add(done: Column, h: Column) -> Column:
        width = h["size"] - h["grams"] + 1
        live = F.filter(done["live"], lambda c: (c["name"] == h["name"]) & (h["pos"] + width - c["start"] <= 2 * h["size"]))
        return _let(live, lambda live: ended(done["spans"], h, width, live))

    def ended(spans: Column, h: Column, width: Column, live: Column) -> Column:
        before = F.filter(live, lambda c: (c["last"] < h["pos"]) & (c["at"] < h["at"]) & (F.abs(h["pos"] - h["at"] - c["last"] + c["at"]) <= SHIFT))
        fresh = at_hit(h, F.lit(1), h["pos"], h["decided"])
        ends = F.concat(F.array(fresh), F.transform(before, lambda c: at_hit(h, c["votes"] + 1, c["start"], c["decided"] | h["decided"])))
        # The best chain and the best decided one; of equals the shorter.
        two = _let(ends, lambda e: F.array_distinct(F.array_compact(F.array(F.array_max(e), F.array_max(F.filter(e, lambda c: c["decided"]))))))
        return _let(two, lambda t: F.struct(F.concat(live, t).alias("live"), F.aggregate(F.filter(t, lambda c: c["decided"] & (c["votes"] / h["grams"] >= SHARE)), spans, lambda s, c: kept(s, h, width, c)).alias("spans")))

    def kept(spans: Column, h: Column, width: Column, c: Column) -> Column:
        new = F.struct(c["name"].alias("name"), c["start"].alias("start"), (c["last"] + width - 1).alias("last"), c["votes"].cast("long").alias("votes"), (c["votes"] / h["grams"]).alias("share"), h["size"].alias("size"))
        last = F.try_element_at(spans, F.lit(-1))
        meets = F.coalesce((last["name"] == c["name"]) & (last["last"] >= c["start"]), F.lit(False))
        better = F.concat(F.slice(spans, 1, F.greatest(F.size(spans) - 1, F.lit(0))), F.array(new))
        return F.when(~meets, F.concat(spans, F.array(new))).when(c["votes"] > last["votes"], better).otherwise(spans)

    return F.aggregate(hits, empty, add, lambda done: done["spans"])


def strip_words(text: str) -> list[str]:
    """The same words, for tests and for reading spans."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(_UPPER, _LOWER)))
