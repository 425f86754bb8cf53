"""Schemas that drift between files: a catalogue of column lifespans, and one table of all files.

Records are JSON objects. Their fields are exploded once into (file, key, field, type, value);
the catalogue has one row per file and field, with the field's type there. Within a producer
series, lag and lead over the files give the lifespans (islands of neighbouring files) of each
field and of each type of it: where a field's island starts or ends, a field was added or
dropped; where only the type's does, it was given another type. A field that ends where another
one starts is a renaming if the keys that both files share carry the same values. The casts of
the unified table come from an alias table, extended by the renamings found.

Inner fields are named ``outer.inner``, however deep they lie; an object without fields is no
field. The key field is left out. Types are integer, decimal, text, boolean and list; a field
without any value in a file keeps its type.

Defined results: a line that is no JSON object, or null, has no fields, but its file counts;
repeated lines count once; a line of a kind without a key field, or without a value in it, has a
null key: it takes part in the catalogue, and is a row of its own in the unified table; a field
of several types within one file has the widest of them (text over list over decimal over
integer; text if boolean is mixed with others); if several new fields carry an old one's values,
the one with most agreeing keys is its new name, then the first by name; a series of one file
reports nothing; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.session import cut

# The key field of each kind of record.
KEYS = {"obs": "cell_id", "var": "feature_id"}
ORDER = ["delivered_at", "line_no", "record_id"]  # which of two lines came later, as far as the table tells
LINE = ["series_id", "file_id", "file_seq", "kind", "key", "line", "at"]


def type_class(variant_type: Column) -> Column:
    """One of the five type names for the type of a JSON value; null for null."""
    t = F.upper(variant_type)
    return (
        F.when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "integer")
        .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "decimal")
        .when(t == "STRING", "text")
        .when(t == "BOOLEAN", "boolean")
        .when(t.startswith("ARRAY"), "list")
        .when(t.startswith("OBJECT"), "text")
    )


def comparable(text: Column) -> Column:
    """Form in which numbers and texts that read the same are equal, as is a list of one value."""
    one = F.regexp_replace(text, r'(?s)^\[\s*([^\[\],{}"]*|"(?:[^"\\]|\\.)*")\s*\]$', "$1")
    bare = F.regexp_replace(F.regexp_replace(one, r'(?s)^"(.*)"$', "$1"), r'\\(["\\/])', "$1")
    n = F.regexp_replace(bare, r"^(-?(?:0|[1-9][0-9]*)\.[0-9]*?)0+$", "$1")
    return F.regexp_replace(n, r"^(-?(?:0|[1-9][0-9]*))\.$", "$1")


def _values(rows: DataFrame) -> DataFrame:
    """Type and text of each value; an object with fields is kept for the next level."""
    shape = F.expr("schema_of_variant(value)")
    rows = rows.withColumn("shape", F.when(F.col("field").isNotNull(), shape))
    inner = F.col("shape").startswith("OBJECT") & (F.col("shape") != "OBJECT<>")
    none = F.col("shape") == "OBJECT<>"
    return rows.select(
        *LINE,
        F.when(~none, F.col("field")).alias("field"),
        F.when(~none, type_class(F.col("shape"))).alias("type"),
        F.when(~none & ~inner & (F.col("shape") != "VOID"), F.col("value").cast("string")).alias("value"),
        F.when(inner, F.col("value")).alias("inner")
    )


def explode_fields(records: DataFrame) -> DataFrame:
    """(series_id, file_id, file_seq, kind, key, line, at, field, type, value) of every field of every line.

    A line without fields has one row with a null field, so no file is lost. ``line`` tells
    lines without a key apart, ``at`` is the order in which the lines came. The result is
    written once; each further level is read from the objects of the level above it only.
    """
    order = [F.col(c) for c in ORDER if c in records.columns]
    keyed = reduce(lambda c, k: c.when(F.col("kind") == k, F.expr(f"try_variant_get(v, '$.{KEYS[k]}', 'string')")), KEYS, F.when(F.lit(False), None))
    name = reduce(lambda c, k: c.when(F.col("kind") == k, KEYS[k]), KEYS, F.when(F.lit(False), None))
    parsed = records.select(
        "series_id",
        "file_id",
        "file_seq",
        "kind",
        F.struct(*order, F.lit(0).alias("none")).alias("at"),
        "payload",
        F.when(F.ltrim("payload").startswith("{"), F.try_parse_json("payload")).alias("v")
    ).select("*", keyed.alias("key"), name.alias("key_field"))
    parsed = parsed.withColumn("line", F.when(F.col("key").isNull(), F.md5("payload")))
    spark, cols = records.sparkSession, ", ".join(f"t.{c}" for c in LINE)
    # the key is no field; its place marks that the line, and so its file, is there
    rows = spark.sql(
        f"select {cols}, if(x.key = t.key_field, null, x.key) as field, x.value as value from {{t}} t, lateral variant_explode_outer(t.v) x", t=parsed
    )
    levels = [cut(_values(rows))]
    while not (nested := levels[-1].where("inner is not null")).isEmpty():
        rows = spark.sql(f"select {cols}, concat(t.field, '.', x.key) as field, x.value from {{t}} t, lateral variant_explode(t.inner) x", t=nested)
        levels.append(cut(_values(rows)))
    return reduce(DataFrame.unionByName, [level.where("inner is null").drop("inner") for level in levels])


def catalogue(fields: DataFrame) -> DataFrame:
    """One row per file and field: its place in the series, its type, and its lifespans there.

    first, last: the field's island of neighbouring files begins or ends with this one;
    type_first: the island of its type begins. island and type_island number them.
    """
    wide = (
        F.when(F.size("types") == 0, None)
        .when(F.size("types") == 1, F.get("types", F.lit(0)))
        .when(F.array_contains("types", "text") | F.array_contains("types", "boolean"), "text")
        .when(F.array_contains("types", "list"), "list")
        .otherwise("decimal")
    )
    each = cut(
        fields.groupBy("series_id", "file_id", "field").agg(
            F.min("file_seq").alias("file_seq"), F.collect_set("type").alias("types"), F.count("value").alias("filled")
        ).withColumn("type", wide)
    )
    # a series is a chain of files: one short row per file, not per line
    chain = Window.partitionBy("series_id").orderBy("file_seq", "file_id")
    files = each.groupBy("series_id", "file_id").agg(F.min("file_seq").alias("file_seq"))
    files = files.select("series_id", "file_id", F.row_number().over(chain).alias("place"), F.lead("file_id").over(chain).alias("next_file"))
    life = Window.partitionBy("series_id", "field").orderBy("place")
    past = life.rowsBetween(Window.unboundedPreceding, 0)
    out = each.where("field is not null").join(files, ["series_id", "file_id"]).select(
        "series_id", "file_id", "place", "next_file", "field", "type", "filled",
        (F.coalesce(F.lag("place").over(life), F.lit(-1)) != F.col("place") - 1).alias("first"),
        (F.coalesce(F.lead("place").over(life), F.lit(-1)) != F.col("place") + 1).alias("last"),
    )
    out = out.withColumn("island", F.sum(F.col("first").cast("int")).over(past))
    known = F.last(F.when(F.col("type").isNotNull(), F.struct("island", "type")), True).over(past)
    out = out.withColumn("known", known).withColumn("type", F.when(F.col("known.island") == F.col("island"), F.col("known.type"))).drop("known")
    other = F.col("type") != F.lag("type").over(life)
    out = out.withColumn("type_first", F.col("first") | F.coalesce(other, F.lit(False)))
    return out.withColumn("type_island", F.sum(F.col("type_first").cast("int")).over(past))


def lifespans(cat: DataFrame) -> DataFrame:
    """(series_id, field, type, first_file, last_file, files): one row per field, type and stretch of files."""
    return cat.groupBy("series_id", "field", "type_island").agg(
        F.max("type").alias("type"),
        F.min_by("file_id", "place").alias("first_file"),
        F.max_by("file_id", "place").alias("last_file"),
        F.count("*").alias("files")
    ).drop("type_island")


def schema_changes(fields: DataFrame, cat: DataFrame | None = None) -> DataFrame:
    """(file_id, change_kind, old_name, new_name) of each file against the one before it.

    fields: as ``explode_fields`` gives them; cat: their catalogue, if it is there already.
    """
    cat = cut(catalogue(fields)) if cat is None else cat
    ended = cat.where(F.col("last") & F.col("next_file").isNotNull()).select(
        "series_id", F.col("next_file").alias("file_id"), F.col("field").alias("old_name"), F.col("type").alias("old_type")
    )
    begun = cat.where(F.col("first") & (F.col("place") > 1)).select(
        "series_id", "file_id", F.col("field").alias("new_name"), F.col("type").alias("new_type")
    )
    # values of dropped and of new fields only, brought to the file where they go or come
    side = lambda old, at: F.struct(F.lit(old).alias("old"), at.alias("to_file"))
    sides = F.array(
        F.when(F.col("last") & F.col("next_file").isNotNull(), side(True, F.col("next_file"))),
        F.when(F.col("first") & (F.col("place") > 1), side(False, F.col("file_id")))
    )
    edges = cat.where("first or last").select("series_id", "file_id", "field", "type", F.filter(sides, lambda x: x.isNotNull()).alias("sides"))
    edges = edges.where(F.size("sides") > 0)
    values = (
        fields.where("value is not null and key is not null and field is not null")
        .select("series_id", "file_id", "field", "key", "value")
        .join(edges, ["series_id", "file_id", "field"])
        .select("series_id", F.explode("sides").alias("s"), "field", "type", "key", comparable(F.col("value")).alias("v"))
        .select("series_id", F.col("s.to_file").alias("file_id"), "s.old", "field", "type", "key", "v")
        .distinct()
    )
    key = ["series_id", "file_id", "key"]
    old = values.where("old").select(*key, F.col("field").alias("old_name"), F.col("type").alias("old_type"), F.col("v").alias("old_value"))
    new = values.where("not old").select(*key, F.col("field").alias("new_name"), F.col("type").alias("new_type"), F.col("v").alias("new_value"))
    same = F.col("old_value") == F.col("new_value")
    pairs = old.join(new, key).groupBy("series_id", "file_id", "old_name", "new_name", "old_type", "new_type").agg(
        F.count("*").alias("n"), F.sum(same.cast("int")).alias("equal")
    )
    fit = pairs.where("n = equal")
    best = lambda a, b: F.row_number().over(Window.partitionBy("series_id", "file_id", a).orderBy(F.col("n").desc(), b))
    renamed = cut(fit.withColumns({"i": best("old_name", "new_name"), "j": best("new_name", "old_name")}).where("i = 1 and j = 1").drop("i", "j"))
    row = lambda kind, a, b: [F.col("file_id"), F.lit(kind).alias("change_kind"), a.alias("old_name"), b.alias("new_name")]
    empty = F.lit("")
    added = begun.join(renamed, ["series_id", "file_id", "new_name"], "left_anti").select(row("added", empty, F.col("new_name")))
    removed = ended.join(renamed, ["series_id", "file_id", "old_name"], "left_anti").select(row("removed", F.col("old_name"), empty))
    # the type's island begins, but not the field's
    kept = cat.where("type_first and not first").select(row("retyped", F.col("field"), F.col("field")))
    moved = renamed.where("old_type <> new_type").select(row("retyped", F.col("old_name"), F.col("new_name")))
    return renamed.select(
        row("renamed", F.col("old_name"), F.col("new_name"))
    ).unionByName(added).unionByName(removed).unionByName(kept).unionByName(moved)


# Names under which the canonical fields are delivered, and the canonical types.
ALIASES = {
    "batch_id": ("string", ["batch_id", "batch", "Batch_ID", "gem_group", "gem_group_2", "gemgroup", "lane.batch", "plate", "run_batch"]),
    "n_counts": ("bigint", ["n_counts", "ncounts", "nCounts", "UMI_count", "UMI count", "total_umis", "total_counts", "qc.n_counts"]),
    "n_genes": ("bigint", ["n_genes", "ngenes", "n_genes_by_counts", "qc.n_genes"]),
    "percent_mito": ("double", ["percent_mito", "percent_mt", "pct_mt", "percent.mt", "qc.percent_mito"]),
    "perturbation_id": ("string", ["perturbation_id", "perturbation", "condition", "target"]),
    "gene_symbol": ("string", ["gene_symbol", "gene_name", "symbol", "Gene_Symbol", "symbol_v2", "annot.symbol"]),
    "gene_type": ("string", ["gene_type", "class", "biotype"]),
    "chromosome": ("string", ["chromosome", "chrom", "chr"]),
    "start": ("bigint", ["start", "pos.start", "start_pos"]),
}


def canonical_names(fields: DataFrame, changes: DataFrame | None, aliases: dict[str, tuple[str, list[str]]] = ALIASES) -> DataFrame:
    """(series_id, field, canon, place): the canonical field that each name of a series stands for.

    A name outside the alias table has the canonical field of the name that it was renamed
    from, or to, over as many renamings as there are; place is its order among the names of the
    canonical field, those of the alias table first.
    """
    table = [(a, c, i) for c, (_, names) in aliases.items() for i, a in enumerate(names)]
    spark = fields.sparkSession
    listed = spark.createDataFrame(table, "field string, canon string, place int")
    names = fields.where("field is not null").select("series_id", "field").distinct()
    known = names.join(listed, "field").select("series_id", "field", "canon", "place")
    if changes is None:
        return known
    known = cut(known)
    files = fields.select("series_id", "file_id").distinct()
    moves = changes.where("change_kind = 'renamed'").join(files, "file_id")
    links = cut(
        moves.select("series_id", F.col("old_name").alias("a"), F.col("new_name").alias("b"))
        .unionByName(moves.select("series_id", F.col("new_name").alias("a"), F.col("old_name").alias("b")))
        .distinct()
    )
    while True:
        reached = links.join(known.withColumnRenamed("field", "a"), ["series_id", "a"]).select(
            "series_id", F.col("b").alias("field"), F.struct(F.col("place") + len(table), "canon").alias("by")
        ).join(known, ["series_id", "field"], "left_anti").groupBy("series_id", "field").agg(F.min("by").alias("by"))
        more = cut(reached.select("series_id", "field", F.col("by.canon").alias("canon"), F.col("by.col1").alias("place")))
        if more.isEmpty():
            return known
        known = known.unionByName(more)


ROW = ["series_id", "file_id", "kind", "key", "line"]


def typed_values(fields: DataFrame, changes: DataFrame | None = None, aliases: dict[str, tuple[str, list[str]]] = ALIASES) -> DataFrame:
    """Every distinct value of every line with its canonical field, its cast, and whether it is taken.

    Of several values of a field in the lines of one key, the one that came last is taken; of
    several names of a canonical field, the first in the alias table whose value can be cast.
    state: ``taken``, ``superseded`` (another value of the field came later, or another name
    goes before), ``failed`` (the cast gives nothing) or ``spare`` (a field outside the table).
    """
    filled = fields.where("field is not null and value is not null")
    each = filled.groupBy(*ROW, "field", "value").agg(F.max("at").alias("at"))
    each = each.join(canonical_names(fields, changes, aliases), ["series_id", "field"], "left")
    text = comparable(F.col("value"))
    casts = {"bigint": F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,6)").try_cast("bigint"))}
    cast = reduce(
        lambda c, x: c.when(F.col("canon") == x[0], casts.get(x[1][0], text.try_cast(x[1][0])).cast("string")), aliases.items(), F.when(F.lit(False), None)
    )
    each = each.withColumn("cast", cast)
    latest = F.row_number().over(Window.partitionBy(*ROW, "field").orderBy(F.col("at").desc(), F.col("value").desc()))
    each = each.withColumn("age", latest)
    usable = F.when((F.col("age") == 1) & F.col("cast").isNotNull(), F.struct("place", "field"))
    first = F.min(usable).over(Window.partitionBy(*ROW, "canon"))
    state = (
        F.when(F.col("age") > 1, "superseded")
        .when(F.col("canon").isNull(), "spare")
        .when(F.col("cast").isNull(), "failed")
        .when(first == F.struct("place", "field"), "taken")
        .otherwise("superseded")
    )
    return each.withColumn("state", state).drop("place")


def unified_table(fields: DataFrame, aliases: dict[str, tuple[str, list[str]]] = ALIASES, changes: DataFrame | None = None) -> DataFrame:
    """All files as one table: one row per file and key (or line without a key), a typed column per canonical field.

    Nothing is dropped: fields outside the alias table, values whose cast fails, and values
    under a further name are kept as they came in the map column ``others``; ``failed`` names
    the fields whose cast failed; ``superseded`` counts the older values of repeated lines, which
    ``typed_values`` gives in full. changes: renamings found extend the alias table.
    """
    values = typed_values(fields, changes, aliases)
    taken = F.col("state") == "taken"
    cols = [F.max(F.when(taken & (F.col("canon") == c), F.col("cast"))).cast(kind).alias(c) for c, (kind, _) in aliases.items()]
    # one entry for each field at most, as the latest value of each is kept
    left = F.when(~taken & (F.col("age") == 1), F.struct("field", "value"))
    out = values.groupBy(*ROW).agg(
        *cols,
        F.map_from_entries(F.array_sort(F.collect_list(left))).alias("others"),
        F.array_sort(F.collect_list(F.when(F.col("state") == "failed", F.col("field")))).alias("failed"),
        F.count(F.when(F.col("age") > 1, 1)).alias("superseded")
    )
    # lines without any value are rows too
    lines = fields.select(*ROW).distinct()
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ROW]
    bare = lines.alias("a").join(out.select(*ROW).alias("b"), same, "left_anti").where("key is not null or line is not null")
    return out.unionByName(bare, allowMissingColumns=True)


def cast_report(values: DataFrame) -> DataFrame:
    """(file_id, field, canon, n_values, taken, failed, superseded, spare): what became of each file's fields."""
    states = [F.count(F.when(F.col("state") == s, 1)).alias(s) for s in ("taken", "failed", "superseded", "spare")]
    return values.groupBy("file_id", "field", "canon").agg(F.count("*").alias("n_values"), *states)
