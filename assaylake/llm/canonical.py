"""Mapping freely typed values to the entries of a reference list.

Token-level repair: values are folded to plain letters (width, look-alike letters, accents,
invisible signs, case), cut into tokens, and each distinct token is joined to the vocabulary
of the reference list by edit distance, through keys that leave out up to two letters. The
corrected tokens are combined by soft TF-IDF, which ranks the complete entries:

    score = sum(idf^2 * similarity) / (norm of the entry * norm of the value)

The norm of a value counts all of its words, those that correct to no word of the entry too.
A word of the reference list weighs by how few entries have it; any other word weighs at most
as much as the rarest of those, and the less the more typed values have it, so common additions
such as `lot 12` matter little and a sentence around a name matters much. An entry is found if
its score is at least ``least_score`` and at least ``least_covered`` of its weight is there, so
entries typed in part are found too.

Weights, candidates and sums are joins and aggregations. An entry is looked up only by its
heaviest words: those that are left have less than ``least_covered`` of its weight together, so
no entry that could be found is missed, and words that many entries share look up none of them.

A token is a word of the value, or neighbouring words written together up to the length of the
longest reference token and its slips, so that `Temq uiraxamine` and `B R C A 1` are found; a
prefix of a guide construct (``sg``, ``sh``, ``si``) may be left off.

Defined results: missing values (null, blank, marker texts) and values equal to an entry
letter for letter are no cases and give no row; a value that stands for no entry has
``entry_id`` -1; entries that rank equally are decided by the smaller edit distance, then by
the smaller entry id; rows given twice give the same row twice; an empty table or an empty
reference list gives no entry; entries without a name or a field can't be found.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.functions.text import is_missing_qc
from assaylake.session import cut, shuffle_width

# Letters of other scripts that look like Latin ones.
LOOK_ALIKE = str.maketrans("асеорхукнмтвіјѕАСЕОРХУКНМТВІЈЅαορνικτΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aceopxykhmtbijsACEOPXYKHMTBIJSaopviktABEZHIKMNOPTYX")
# Constructs named before a gene.
PREFIXES = ("sg", "sh", "si")
LONG = 9  # letters from which a token may be two edits away
LEAST_PREFIX = 5  # letters that an abbreviation must keep


def fold(text: str) -> str:
    """Plain lower-case letters of a text, whatever it was typed with."""
    t = unicodedata.normalize("NFD", unicodedata.normalize("NFKC", text).translate(LOOK_ALIKE))
    return "".join(c for c in t if unicodedata.category(c) not in ("Mn", "Cf")).lower()


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", fold(text))


def allowed(length: int) -> int:
    """Edits by which a token may differ from a reference token of this length."""
    return 0 if length <= 3 else 1 if length < LONG else 2


def edits(a: str, b: str) -> int:
    """Edit distance in which two neighbours that changed places are one edit."""
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, two[j - 2] + 1)
            row.append(best)
        two, one = one, row
    return one[-1]


def _tokens(longest: int):
    """Tokens of each value of up to so many letters, with the words they are made of."""
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r, value in enumerate(b["value"].to_pylist()):
                w = words_of(value)
                short = value.rstrip().endswith(".")
                for i in range(len(w)):
                    t = ""
                    for j in range(i + 1, len(w) + 1):
                        t += w[j - 1]
                        if len(t) > longest and j > i + 1:
                            break
                        rows.append((r, i, j, t, short and j == len(w) and len(t) >= LEAST_PREFIX))
                        if t[:2] in PREFIXES and len(t) > 5:
                            rows.append((r, i, j, t[2:], False))
            cols = list(zip(*rows)) or [[]] * 5
            at = pa.array(cols[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b["id"].take(at), b["field"].take(at), *[pa.array(c, k) for c, k in zip(cols[1:], kinds)]],
                names=["id", "field", "start", "stop", "token", "cut_short"]
            )

    return run


def _entry_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield b.append_column("words", pa.array([words_of(n) for n in b["name"].to_pylist()], pa.list_(pa.string())))


def deletions(c: Column) -> Column:
    """The token, and the token without one letter, or two if it is long."""
    one = lambda t: F.transform(
        F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(t.substr(F.lit(1), i - 1), t.substr(i + 1, F.length(t)))
    )
    first = F.when(F.length(c) >= 3, one(c)).otherwise(F.array().cast("array<string>"))
    # a value's token may be two letters shorter than the reference token
    second = F.when(F.length(c) >= LONG - 2, F.flatten(F.transform(first, one))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(c), first, second))


def _edits(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([edits(x, y) for x, y in zip(a, b)], dtype="int32")


def repair_tokens(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(token, ref, dist) of each distinct token and the reference tokens it may be a slip of."""
    near = F.pandas_udf(_edits, "int")
    longest = F.col("longest") + F.when(F.col("longest") <= 3, 0).when(F.col("longest") < LONG, 1).otherwise(2)
    # nothing longer than the longest reference token and its edits can be a slip of one
    within = tokens.join(F.broadcast(vocabulary.agg(F.max(F.length("ref")).alias("longest"))), F.length("token") <= longest)
    left = within.select("token", F.explode(deletions(F.col("token"))).alias("key"))
    right = vocabulary.select("ref", F.explode(deletions(F.col("ref"))).alias("key"))
    most = F.when(F.length("ref") <= 3, 0).when(F.length("ref") < LONG, 1).otherwise(2)
    # two letters that changed places are one slip, and two plain edits at most
    pairs = left.join(right, "key").select("token", "ref").distinct().where(F.levenshtein("token", "ref") <= 2 * most)
    pairs = pairs.repartition(shuffle_width(tokens.sparkSession), "token", "ref")
    return pairs.withColumn("dist", near("token", "ref")).where(F.col("dist") <= most)


class Reference:
    """The entries as tables: their words with weights, and the words that look an entry up."""

    def __init__(self, reference: DataFrame, least_covered: float):
        named = reference.select(
            F.col("entry_id").cast("bigint").alias("entry_id"), F.col("entry_field").alias("field"), F.col("entry_name").cast("string").alias("name")
        ).where("field is not null and name is not null and entry_id is not null")
        entries = cut(named.mapInArrow(_entry_words, "entry_id bigint, field string, name string, words array<string>").where(F.size("words") > 0))
        parts = entries.select("field", "entry_id", F.explode(F.array_distinct("words")).alias("ref")).distinct()
        size = entries.groupBy("field").agg(F.count_distinct("entry_id").alias("entries"))
        often = parts.groupBy("field", "ref").agg(F.count("*").alias("n"))
        idf = often.join(size, "field").select("field", "ref", F.log1p(F.col("entries") / F.col("n")).alias("idf"))
        weighed = parts.join(idf, ["field", "ref"]).withColumn("idf2", F.col("idf") * F.col("idf")).drop("idf")
        norms = weighed.groupBy("field", "entry_id").agg(F.sum("idf2").alias("norm2"), F.count("*").alias("n_words"))
        whole = entries.select("field", "entry_id", F.array_join("words", "").alias("ref")).distinct().join(norms, ["field", "entry_id"])
        whole = whole.select("field", "entry_id", "ref", F.col("norm2").alias("idf2"), "norm2", F.lit(True).alias("whole"))
        # an entry of one word is that word written together
        several = weighed.join(norms.where("n_words > 1"), ["field", "entry_id"]).drop("n_words").withColumn("whole", F.lit(False))
        self.idf = idf
        self.words = cut(whole.unionByName(several))
        ahead = Window.partitionBy("field", "entry_id", "whole").orderBy(F.col("idf2").desc(), "ref").rowsBetween(Window.unboundedPreceding, -1)
        left = F.col("norm2") - F.coalesce(F.sum("idf2").over(ahead), F.lit(0.0))
        self.index = self.words.withColumn("left", left).where(F.col("left") >= least_covered * F.col("norm2") - 1e-9).select("field", "ref", "entry_id")
        self.vocabulary = cut(self.words.select("field", "ref").unionByName(idf.select("field", "ref")).distinct())


def map_values(values: DataFrame, reference: DataFrame, least_score: float = 0.4, least_covered: float = 0.6) -> DataFrame:
    """(field, value, entry_id, score) of each distinct (field, value).

    ``reference`` has entry_id, entry_field and entry_name. Nothing of it is held by the driver.
    """
    held = Reference(reference, least_covered)
    most = held.vocabulary.agg(F.max(F.length("ref"))).first()[0] or 0
    distinct = values.select("field", "value").distinct().withColumn("id", F.md5(F.concat_ws("\n", "field", "value")))
    distinct = cut(distinct)
    shape = "id string, field string, start int, stop int, token string, cut_short boolean"
    tokens = cut(distinct.mapInArrow(_tokens(most + allowed(most)), shape))
    repaired = repair_tokens(tokens.select("token").distinct(), held.vocabulary.select("ref").distinct())
    sim = (1 - F.col("dist") / F.greatest(F.length("ref"), F.length("token"))).cast("double")
    span = ["id", "field", "start", "stop", "ref", "sim"]
    own = tokens.join(repaired, "token").join(held.vocabulary, ["field", "ref"]).select(*span[:-1], sim.alias("sim"))
    # abbreviations: the start of a reference token, closed by a full stop
    starts = held.vocabulary.where(F.length("ref") > LEAST_PREFIX).select(
        "field",
        "ref",
        F.explode(
            F.transform(F.sequence(F.lit(LEAST_PREFIX), F.length("ref") - 1), lambda n: F.col("ref").substr(F.lit(1), n))
        ).alias("token")
    )
    cuts = tokens.where("cut_short").join(starts, ["field", "token"]).select(*span[:-1], (F.length("token") / F.length("ref")).cast("double").alias("sim"))
    spans = cut(own.unionByName(cuts).groupBy(*span[:-1]).agg(F.max("sim").alias("sim")))
    # what each word of a value weighs: as the reference word it corrects to, or by how rare it is among the values
    single = tokens.where("stop = start + 1").groupBy("id", "field", "start").agg(F.max_by("token", F.length("token")).alias("token"))
    sizes = distinct.groupBy("field").agg(F.count("*").alias("n_values"))
    top = held.idf.groupBy("field").agg(F.max("idf").alias("top"))
    rare = single.groupBy("field", "token").agg(F.count("*").alias("n")).join(sizes, "field").join(top, "field").select(
        "field", "token", (F.col("top") * F.log1p(F.col("n_values") / F.col("n")) / F.log1p(F.col("n_values").cast("double"))).alias("unknown")
    )
    known = spans.where("stop = start + 1").join(held.idf, ["field", "ref"]).groupBy("id", "start").agg(F.max(F.col("sim") * F.col("idf")).alias("known"))
    worth = single.join(rare, ["field", "token"]).join(known, ["id", "start"], "left").select(
        "id", "start", F.pow(F.coalesce("known", "unknown"), F.lit(2.0)).alias("w2")
    )
    worth = cut(
        worth.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("start", "w2"))).alias("w")).select("id", F.transform("w", lambda x: x["w2"]).alias("w"))
    )
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    # entries that share one of their heavy words with the value, and all that they share with it
    candidates = spans.join(held.index, ["field", "ref"]).select("id", "field", "entry_id").distinct()
    shared = candidates.join(held.words, ["field", "entry_id"]).join(spans.drop("field"), ["id", "ref"])
    shared = shared.where("whole or stop = start + 1").join(worth, "id")
    shared = shared.withColumn("used", total(F.slice("w", F.col("start") + 1, F.col("stop") - F.col("start"))))
    key = ["id", "field", "entry_id", "norm2"]
    written = shared.where("whole").select(
        *key, (F.col("idf2") * F.col("sim")).alias("mass"), F.col("idf2").alias("matched"), "used", "sim", total(F.col("w")).alias("all")
    )
    # a word of the value stands for one word of the entry, and the other way round
    of_word = lambda c: Window.partitionBy("id", "entry_id", c).orderBy(F.col("sim").desc(), F.col("idf2").desc(), "ref", "start")
    one = shared.where("not whole").withColumn("i", F.row_number().over(of_word("start"))).where("i = 1")
    one = one.withColumn("i", F.row_number().over(of_word("ref"))).where("i = 1")
    apart = one.groupBy(*key).agg(
        F.sum(F.col("idf2") * F.col("sim")).alias("mass"),
        F.sum("idf2").alias("matched"),
        F.sum("used").alias("used"),
        F.min("sim").alias("sim"),
        F.max(total(F.col("w"))).alias("all")
    )
    rest = F.greatest(F.col("all") - F.col("used"), F.lit(0.0))
    scored = written.unionByName(apart).withColumn("score", F.round(F.col("mass") / F.sqrt(F.col("norm2") * (F.col("matched") + rest)), 9))
    scored = scored.where((F.col("score") >= least_score) & (F.col("mass") >= least_covered * F.col("norm2") - 1e-9))
    best = scored.groupBy("id").agg(F.max(F.struct("score", "sim", (-F.col("entry_id")).alias("minus"))).alias("best"))
    return distinct.join(best, "id", "left").select(
        "field", "value", F.coalesce(-F.col("best.minus"), F.lit(-1)).cast("bigint").alias("entry_id"), F.coalesce("best.score", F.lit(0.0)).alias("score")
    )


def map_typed(df: DataFrame, key: str, fields: list[str], reference: DataFrame) -> DataFrame:
    """(key, field_name, typed, entry_id, score) of every value that is not an entry as it stands."""
    long = df.select(
        F.col(key).alias("__key"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("x")
    ).select("__key", "x.*")
    exact = reference.select(F.col("entry_field").alias("field"), F.col("entry_name").alias("value")).distinct()
    cases = long.where(~is_missing_qc(F.col("value"))).join(exact, ["field", "value"], "left_anti")
    return cases.join(map_values(cases, reference), ["field", "value"]).select(
        F.col("__key").alias(key), F.col("field").alias("field_name"), F.col("value").alias("typed"), "entry_id", "score"
    )
