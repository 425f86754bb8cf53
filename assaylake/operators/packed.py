"""Several values packed in one field: one row per value, with its position.

A field may hold `a;b`, `"a, x"|b`, a JSON or Python list, bracketed or blank-separated
values. Names that themselves contain a delimiter or a quote are given as ``names``; where
they occur whole they are one value, quoted or not.

The text is split on its quote marks: odd pieces are literals, even pieces are split on the
delimiters, and one array fold puts the pieces together into places, so quoted delimiters
never split. No character is set aside for marks.

Defined results: a null, empty or missing-marker field gives no row; an empty place between
two delimiters counts as a position and gives no row; a field with fewer than ``least``
values gives no row; repeated values keep their positions. Double quotes pair up first, single
ones within what is left, in the order they stand. A single quote counts only at the edge of a
value, so the apostrophe of `O'Brien`, or one after a backslash, is text. Two double quotes in
a row inside a pair are one double quote. A last mark without a partner is left out and quotes
nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.text import strip

DELIMITERS = ";,|/+&\t\n\r_"
IN_ONE_PATTERN = 500  # names that are looked for in every text; more are joined to the texts that can hold them


def protected(names: DataFrame, column: str, delimiters: str = DELIMITERS) -> DataFrame:
    """(name): the names of a reference list that contain a delimiter, a quote, a bracket or a blank.

    A name without any letter or digit can't be told from delimiters and is left out.
    """
    special = "[" + re.escape(delimiters) + r"\s\"'\[\](){}]"
    named = names.select(F.col(column).cast("string").alias("name"))
    return named.where(F.col("name").rlike(special) & F.col("name").rlike(r"[\p{L}\p{N}]")).distinct()


def protected_names(names: DataFrame, column: str, delimiters: str = DELIMITERS, at_most: int = 20_000) -> list[str]:
    """The same as a list, longest names first, for short reference lists."""
    found = protected(names, column, delimiters).limit(at_most + 1).collect()
    if len(found) > at_most:
        raise ValueError(f"more than {at_most} names hold a delimiter; give them to unpack as a table")
    return sorted((r[0] for r in found), key=lambda n: (-len(n), n))


def _alternatives(names: list[str]) -> str:
    """Pattern of the names; an apostrophe may have a backslash before it."""
    return "|".join(re.sub(r"([^A-Za-z0-9 '])", r"\\\1", n).replace("'", "\\\\?'") for n in names)


def _alternatives_of(names: Column) -> Column:
    """The same pattern from an array of names."""
    quoted = F.transform(names, lambda n: F.replace(F.regexp_replace(n, r"([^A-Za-z0-9 '])", r"\\$1"), F.lit("'"), F.lit("\\\\?'")))
    return F.array_join(quoted, "|")


def _piece(text: Column, literal: Column) -> Column:
    return F.struct(text.alias("text"), literal.alias("literal"))


def _quoted(text: Column, mark: str, doubled: str | None = None) -> Column:
    """Pieces between the marks of a text; every second one is literal, but for one without an end.

    doubled: the mark, where two of them within a pair stand for itself.
    """
    n = F.size(F.split(text, mark))

    def piece(p, i):
        out = F.when((i % 2 == 1) & (i < n - 1), _piece(p, F.lit(True)))
        if doubled:
            out = out.when((i % 2 == 0) & (i > 0) & (i < n - 1) & (p == ""), _piece(F.lit(doubled), F.lit(True)))
        return out.otherwise(_piece(p, F.lit(False)))

    return F.transform(F.split(text, mark), piece)


def _within(pieces: Column, split) -> Column:
    """Splits the pieces that are not literal further."""
    return F.flatten(F.transform(pieces, lambda x: F.when(x["literal"], F.array(x)).otherwise(split(x["text"]))))


def split_packed(c: Column, names: list[str] | Column, delimiters: str = DELIMITERS) -> Column:
    """Array of the places of a packed field, trimmed; empty places are empty texts.

    names: those that may occur in the text, longest first, as a list or an array column.
    """
    inner = c
    for left, right in (("\\[", "\\]"), ("\\(", "\\)"), ("\\{", "\\}")):
        inner = F.regexp_replace(inner, rf"(?s)^\s*{left}(.*){right}\s*$", "$1")
    cuts = "[" + "".join("\\" + d if not d.isspace() and d != "_" else d for d in delimiters) + "]"
    edge = r"[\s\[\](){}" + cuts[1:]
    single = rf"(?<!\\)'(?=$|{edge})|(?<=^|{edge})'"
    pieces = _within(_quoted(inner, r'(?<!\\)"', '"'), lambda t: _quoted(t, single))
    if not isinstance(names, list) or names:
        held = F.lit(_alternatives(names)) if isinstance(names, list) else F.nullif(_alternatives_of(names), F.lit(""))
        whole = F.concat(F.lit(r"(?<![\p{L}\p{N}])("), held, F.lit(r")(?![\p{L}\p{N}])"))

        def by_name(t):
            both = F.transform(
                F.split(t, whole), lambda p, i: F.array(_piece(p, F.lit(False)), _piece(F.get(F.regexp_extract_all(t, whole, F.lit(1)), i), F.lit(True)))
            )
            named = F.filter(F.flatten(both), lambda x: x["text"].isNotNull())
            return F.when(F.coalesce(F.rlike(t, whole), F.lit(False)), named).otherwise(F.array(_piece(t, F.lit(False))))

        pieces = _within(pieces, by_name)
    start = F.expr("named_struct('done', cast(array() as array<string>), 'now', '')")

    def step(acc, x):
        parts = F.split(x["text"], cuts)
        last = F.size(parts) - 1
        whole_piece = x["literal"] | (last == 0)
        ended = F.concat(acc["done"], F.array(F.concat(acc["now"], F.get(parts, F.lit(0)))), F.slice(parts, F.lit(2), F.greatest(last - 1, F.lit(0))))
        return F.struct(
            F.when(whole_piece, acc["done"]).otherwise(ended).alias("done"),
            F.when(whole_piece, F.concat(acc["now"], x["text"])).otherwise(F.get(parts, last)).alias("now")
        )

    places = F.aggregate(pieces, start, step, lambda acc: F.concat(acc["done"], F.array(acc["now"])))
    return F.transform(places, lambda p: F.replace(strip(p), F.lit("\\'"), F.lit("'")))


def _names_in(df: DataFrame, field: str, names: DataFrame) -> DataFrame:
    """Adds __names: the names that each text holds, found by a join of their first word."""
    texts = df.select(F.col(field).alias("__text")).where("__text is not null").distinct()
    words = lambda c: F.regexp_extract_all(c, F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    seen = texts.select("__text", F.explode(F.array_distinct(words("__text"))).alias("__word"))
    keyed = names.select(F.col(names.columns[0]).alias("__name")).select("__name", F.get(words("__name"), F.lit(0)).alias("__word"))
    found = seen.join(keyed, "__word").where(F.replace("__text", F.lit("\\'"), F.lit("'")).contains(F.col("__name")))
    ordered = F.array_sort(F.collect_set(F.struct((-F.length("__name")).alias("n"), F.col("__name").alias("name"))))
    by = found.groupBy("__text").agg(F.transform(ordered, lambda x: x["name"]).alias("__names"))
    out = df.join(by, F.col(field) == F.col("__text"), "left").drop("__text")
    return out.withColumn("__names", F.coalesce("__names", F.array().cast("array<string>")))


def unpack(df: DataFrame, key: str, field: str, names: list[str] | DataFrame, least: int = 2, delimiters: str = DELIMITERS) -> DataFrame:
    """(row_key, item_no, item) of every packed field of ``df`` with at least ``least`` values.

    names: names that hold delimiters, as a list or as a table of one column. Up to
    IN_ONE_PATTERN of them are looked for in every text at once; of longer tables each text is
    joined to those that it can hold.
    """
    rows = df.select(F.col(key).cast("string").alias("__key"), F.col(field).cast("string").alias("__field"))
    if isinstance(names, DataFrame):
        few = [r[0] for r in names.limit(IN_ONE_PATTERN + 1).collect()]
        if len(few) <= IN_ONE_PATTERN:
            names = sorted(few, key=lambda n: (-len(n), n))
        else:
            rows, names = _names_in(rows, "__field", names), F.col("__names")
    # bound once: a filter on the places, or one that explode infers, would split every text again
    bound = F.transform(
        F.array(split_packed(F.col("__field"), names, delimiters)), lambda places: F.when(F.size(F.filter(places, lambda p: p != "")) >= least, places)
    )
    return (
        rows.select(F.col("__key").alias("row_key"), F.posexplode_outer(F.get(bound, F.lit(0))).alias("__at", "item"))
        .where(F.col("item") != "")
        .select("row_key", (F.col("__at") + 1).cast("bigint").alias("item_no"), "item")
    )
