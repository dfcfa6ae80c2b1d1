"""License notices in texts, by an exact set-similarity join with license templates.

A block is a line. It meets a template when it holds nine tenths of the template's words, in any
order. The join is exact: words are put in one order, the rarest among all blocks first, and

* length: a block needs as many template words as the overlap that the template asks for;
* prefix: of that overlap at least one word is among the first words of both sides;
* position: from a shared word on, both sides have to have enough words left.

What passes is verified by its overlap. Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.linededup import LOWER, UPPER
from plumbline.llm.registry import query, table
from plumbline.session import materialize

# Phrases and their labels: fixed values of the result.
PHRASES = {
    "cc-by": ["cc", "by"],
    "gpl": ["general", "public", "license"],
    "reserved": ["all", "rights", "reserved"],
}

TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "gpl-3.0": "licensed under the gnu general public license version 3",
    "mit": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of "
    "this software and associated documentation files",
    "mpl-2.0": "subject to the terms of the mozilla public license v 2 0",
}
# Of a template's words, in tenths.
CONTAINED = 9

# What is no word, but for the line break.
_GAP = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(template: str) -> list[str]:
    return sorted(set(template.split()))


def _needed(size: int) -> int:
    return -(-CONTAINED * size // 10)


VOCABULARY = sorted({word for text in TEMPLATES.values() for word in _words(text)})
SHORTEST = min(_needed(len(_words(text))) for text in TEMPLATES.values())


def _has(plain: Column, phrase: list[str]) -> Column:
    return F.contains(F.concat(F.lit(" "), plain, F.lit(" ")), F.lit(f" {' '.join(phrase)} "))


def _places(words: Column, plain: Column, phrase: list[str]) -> Column:
    """Where the phrase's words stand one after the other. ``words`` has to be a stored column: an
    expression would be worked out anew at every place."""
    last = F.size(words) - len(phrase)
    here = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: reduce(
            Column.__and__, [F.get(words, i + k) == word for k, word in enumerate(phrase)]
        ),
    )
    none = F.array().cast("array<int>")
    return F.when(_has(plain, phrase), here).otherwise(none)


def _scanned(documents: DataFrame) -> DataFrame:
    """One row per document: a row number, the phrases, and the template words of each block that
    has enough of them for the shortest overlap."""
    known = F.array(*[F.lit(word) for word in VOCABULARY])
    # Case beyond A-Z changes no result: such letters are in no phrase or template, and part of
    # words in either case. Only these two have an ASCII letter for their lower case.
    text = F.coalesce("text", F.lit(""))
    for letter in "\u212a\u0130":
        text = F.replace(text, F.lit(letter), F.lit("\u00e9"))
    lines = F.transform(F.split(F.regexp_replace(F.lower(text), _GAP, " "), "\n"), lambda x: F.trim(x))
    return (
        documents.select("doc_id", F.filter(lines, lambda x: x != "").alias("lines"))
        .withColumn("tokens", F.transform("lines", lambda x: F.split(x, " ")))
        .withColumn("plain", F.array_join("lines", " "))
        .withColumn(
            "words",
            F.when(
                reduce(Column.__or__, [_has(F.col("plain"), x) for x in PHRASES.values()]),
                F.split("plain", " "),
            ),
        )
        .select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.aggregate(
                "tokens", F.lit(0).cast("bigint"), lambda n, x: n + F.size(x).cast("bigint")
            ).alias("n_words"),
            F.array(
                *[_places(F.col("words"), F.col("plain"), phrase) for phrase in PHRASES.values()]
            ).alias("places"),
            F.filter(
                F.transform("tokens", lambda x: F.array_intersect(known, x)),
                lambda x: F.size(x) >= SHORTEST,
            ).alias("blocks"),
        )
    )


def matches(blocks: DataFrame) -> DataFrame:
    """(row, block, label, overlap, size) for every block (row, block, tokens) and template that
    meet; ``tokens`` are the block's different template words."""
    spark = blocks.sparkSession
    # At most as many rows as VOCABULARY has words.
    counted = blocks.select(F.explode("tokens").alias("word")).groupBy("word").count().collect()
    count = {row["word"]: row["count"] for row in counted}
    order = sorted(VOCABULARY, key=lambda word: (count.get(word, 0), word))
    rank = {word: place for place, word in enumerate(order)}
    ranks = F.create_map(*[F.lit(x) for word in order for x in (word, rank[word])])

    postings = []  # a row for each word of a template's prefix
    for label, text in TEMPLATES.items():
        own = sorted(rank[word] for word in _words(text))
        needed = _needed(len(own))
        for place, word in enumerate(own[: len(own) - needed + 1]):
            postings.append((word, label, place, own, needed))
    index = spark.createDataFrame(
        postings, "word int, label string, place int, template array<int>, needed int"
    )
    ranked = blocks.select(
        "row",
        "block",
        F.array_sort(F.transform("tokens", lambda x: F.element_at(ranks, x))).alias("own"),
    )
    size, left = F.size("own"), F.size("template") - F.col("place")
    prefix = F.slice("own", F.lit(1), F.size("own") - SHORTEST + 1)
    pairs = (
        ranked.select("row", "block", "own", F.posexplode(prefix).alias("at", "word"))
        .join(F.broadcast(index), "word")  # bounded by the templates above
        .filter(size >= F.col("needed"))
        .filter(F.col("at") <= size - F.col("needed"))
        .filter(F.least(size - F.col("at"), left) >= F.col("needed"))
        .withColumn("overlap", F.size(F.array_intersect("own", "template")))
        .filter(F.col("overlap") >= F.col("needed"))
    )
    return pairs.select(
        "row", "block", "label", "overlap", F.size("template").alias("size")
    ).distinct()


def scan(documents: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks`` of
    every row of ``documents``; ``blocks`` lists the matches as (block, label, overlap, size).

    The score is the largest share of a template that a block holds, 1 where a phrase is found,
    and 0 where nothing is. Null and empty texts have no words and no labels. Rows with one doc_id
    are answered one by one. A long line is one block, whole. An empty table gives no rows. Only
    ``doc_id`` and ``text`` are read.
    """
    rows = materialize(_scanned(documents), "license-blocks")
    blocks = rows.select("row", F.posexplode("blocks").alias("block", "tokens"))
    found = (
        matches(blocks)
        .groupBy("row")
        .agg(
            F.collect_set("label").alias("found"),
            F.max(F.col("overlap") / F.col("size")).alias("share"),
            F.sort_array(F.collect_list(F.struct("block", "label", "overlap", "size"))).alias(
                "matched"
            ),
        )
    )
    everywhere = F.flatten("places")
    base = F.filter(
        F.array(
            *[
                F.when(F.size(F.get("places", F.lit(k))) > 0, F.lit(label))
                for k, label in enumerate(PHRASES)
            ]
        ),
        lambda x: x.isNotNull(),
    )
    none = F.array().cast("array<string>")
    return (
        rows.join(found, "row", "left")
        .withColumn("base", base)
        .select(
            "doc_id",
            "n_words",
            F.size(everywhere).cast("bigint").alias("n_base"),
            F.array_min(everywhere).cast("bigint").alias("first_word"),
            F.array_max(everywhere).cast("bigint").alias("last_word"),
            F.array_join(F.array_sort("base"), ",").alias("base_labels"),
            F.array_join(
                F.array_sort(F.array_union("base", F.coalesce("found", none))), ","
            ).alias("labels"),
            F.when(F.size("base") > 0, F.lit(1.0))
            .otherwise(F.coalesce("share", F.lit(0.0)))
            .alias("score"),
            F.col("matched").alias("blocks"),
        )
    )


_SQL_GAP = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"
_SQL_TEMPLATES = ", ".join(
    f"('{label}', [{', '.join(repr(w) for w in _words(text))}])" for label, text in TEMPLATES.items()
)
_SQL_PHRASES = " UNION ALL ".join(
    f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(0, CAST(len(words) AS BIGINT)), "
    "lambda i: "
    + " AND ".join(f"words[i + {k + 1}] = '{word}'" for k, word in enumerate(phrase))
    + ")) AS place FROM texts"
    for label, phrase in PHRASES.items()
)

OP2_SQL = f"""
WITH lowered AS (
    SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS low FROM documents
),
texts AS (SELECT doc_id, regexp_extract_all(low, {_SQL_GAP}) AS words FROM lowered),
places AS ({_SQL_PHRASES}),
base AS (
    SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM places GROUP BY doc_id
),
templates AS (SELECT * FROM (VALUES {_SQL_TEMPLATES}) AS t(label, template)),
lines AS (
    SELECT doc_id, list_distinct(regexp_extract_all(line, {_SQL_GAP})) AS words
    FROM (SELECT doc_id, unnest(string_split(low, chr(10))) AS line FROM lowered)
),
shared AS (
    SELECT doc_id, label, len(list_intersect(words, template)) AS n, len(template) AS size
    FROM lines, templates
),
found AS (
    SELECT doc_id, label, max(n / size) AS share FROM shared
    WHERE 10 * n >= {CONTAINED} * size GROUP BY doc_id, label
),
named AS (
    SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (
        SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM found
    ) GROUP BY doc_id
),
best AS (SELECT doc_id, max(share) AS share FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word,
    last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END :: DOUBLE AS score
FROM texts LEFT JOIN base USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN best USING (doc_id)
"""


@query("op2_license_scan_set_join", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("blocks")
