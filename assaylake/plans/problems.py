"""Queries of the core problems over the project's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.operators import drift, packed, quality, units
from assaylake.session import cut, read


def _deliveries(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {t: read(spark, d, t) for t in ("dataset_qc", "profile_index")}


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.findings(quality.profile_loads(_deliveries(spark, d), quality.JUDGED))


def p1_profile(spark: SparkSession, d: str) -> DataFrame:
    """The whole profile: counts, exact quantiles, distincts and KS distance of every column in every load."""
    tables = _deliveries(spark, d)
    judged = {(j.table, j.column): j for j in quality.JUDGED}
    every = [judged.get((j.table, j.column), j) for t, df in tables.items() for j in quality.every_column(t, df)]
    rounded = {c: F.round(c, 6) for c in ("least", "most", "p25", "p50", "p75", "median_nonzero", "ks")}
    return quality.profile_loads(tables, every).withColumns(rounded).select(
        "table_name",
        "column_name",
        "load_no",
        "rows",
        "missing",
        "distinct_values",
        "wrong_form",
        "out_of_range",
        *rounded,
        "least_text",
        "median_text",
        "most_text"
    )


def _fields(spark: SparkSession, d: str) -> DataFrame:
    return drift.explode_fields(read(spark, d, "raw_records"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.schema_changes(_fields(spark, d)).distinct()


def p4_lifespans(spark: SparkSession, d: str) -> DataFrame:
    """The stretches of files over which each field had one type."""
    return drift.lifespans(drift.catalogue(_fields(spark, d)))


def p4_unified(spark: SparkSession, d: str) -> DataFrame:
    """All files of all series as one table with canonical, typed columns; the casts follow the renamings found."""
    fields = _fields(spark, d)
    changes = cut(drift.schema_changes(fields))
    return drift.unified_table(fields, changes=changes).withColumns({"others": F.to_json("others"), "failed": F.array_join("failed", ",")})


def p4_casts(spark: SparkSession, d: str) -> DataFrame:
    """How many values of each field of each file were taken, failed their cast or gave way to another."""
    return drift.cast_report(drift.typed_values(_fields(spark, d)))


def _converted(spark: SparkSession, d: str) -> DataFrame:
    compounds = read(spark, d, "canonical_values").where("entry_field = 'perturbation_id'")
    return units.convert_conditions(read(spark, d, "conditions"), read(spark, d, "dataset_ref"), compounds)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return units.converted_cases(_converted(spark, d))


def p5_guessed(spark: SparkSession, d: str) -> DataFrame:
    """Doses and times without any known unit: the likeliest unit, its posterior, and whether it is unsure.

    guessed_common is in picomolar for a dose and in seconds for a time.
    """
    return units.guess_units(cut(_converted(spark, d).distinct())).select(
        "condition_id",
        "quantity",
        "written",
        "guessed_unit",
        F.round("guessed_common", 3).alias("guessed_common"),
        F.round("posterior", 4).alias("posterior"),
        "uncertain"
    )


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    names = packed.protected(read(spark, d, "dataset_ref"), "dataset_id")
    entries = packed.protected(read(spark, d, "canonical_values").where("entry_field = 'perturbation_id'"), "entry_name")
    meta = packed.unpack(read(spark, d, "meta_summary"), "summary_row_id", "datasets", names)
    doses = packed.unpack(read(spark, d, "interventions"), "intervention_id", "perturbation_id", entries)
    tag = lambda df, t: df.select(F.lit(t).alias("source_table"), "row_key", "item_no", "item")
    return tag(meta, "meta_summary").unionByName(tag(doses, "interventions").distinct())


QUERIES = {
    "p1_found": p1_found,
    "p1_profile": p1_profile,
    "p4_found": p4_found,
    "p4_lifespans": p4_lifespans,
    "p4_casts": p4_casts,
    "p4_unified": p4_unified,
    "p5_found": p5_found,
    "p5_guessed": p5_guessed,
    "p6_found": p6_found,
}

_JUDGED = """
WITH long AS (
  SELECT 'dataset_qc' AS table_name, 'missing_perturbation_cells' AS column_name, 1 AS kind, load_no, missing_perturbation_cells AS v, n_obs FROM dataset_qc
  UNION ALL SELECT 'dataset_qc', 'matrix_integer_like_sample', 2, load_no, matrix_integer_like_sample, NULL FROM dataset_qc
  UNION ALL SELECT 'profile_index', 'warnings', 3, load_no, warnings, NULL FROM profile_index
), flagged AS (
  SELECT *, v IS NULL OR lower(trim(v)) IN ('', 'nan', 'none', 'null', 'na', '<missing>') AS missing,
    CASE kind WHEN 1 THEN regexp_full_match(v, '-?[0-9]+') WHEN 2 THEN v IN ('True', 'False')
      ELSE json_valid(v) AND starts_with(v, '[') AND json_type(CASE WHEN json_valid(v) THEN v END) = 'ARRAY'
        AND len(list_filter(CASE WHEN json_valid(v) AND starts_with(v, '[') THEN json_transform(v, '["JSON"]') ELSE [] END, lambda x: x IS NULL OR json_type(x) <> 'VARCHAR')) = 0 END AS form
  FROM long
), numbered AS (
  SELECT *, CASE WHEN missing OR NOT coalesce(form, false) THEN NULL WHEN kind = 1 THEN TRY_CAST(v AS DOUBLE)
    WHEN kind = 2 THEN CASE WHEN v = 'True' THEN 1.0 ELSE 0.0 END ELSE CASE WHEN json_array_length(v) > 0 THEN 1.0 ELSE 0.0 END END AS num
  FROM flagged
), loads AS (
  SELECT table_name, column_name, kind, load_no, count(*) AS n, count(*) FILTER (WHERE missing) AS n_missing,
    count(DISTINCT v) FILTER (WHERE NOT missing) AS n_distinct, count(*) FILTER (WHERE NOT missing AND NOT coalesce(form, false)) AS wrong,
    count(*) FILTER (WHERE kind = 1 AND (num < 0 OR num > n_obs)) AS outside,
    avg(CASE WHEN num <> 0 THEN 1.0 WHEN num = 0 THEN 0.0 END) AS share, median(num) FILTER (WHERE kind = 1 AND num <> 0) AS med
  FROM numbered GROUP BY ALL
), compared AS (
  SELECT *, lag(share) OVER w AS p_share, lag(med) OVER w AS p_med FROM loads WINDOW w AS (PARTITION BY table_name, column_name ORDER BY load_no)
)
"""

_P4 = r"""
WITH lines AS (
  SELECT DISTINCT series_id, file_id, file_seq, CASE kind WHEN 'obs' THEN 'cell_id' WHEN 'var' THEN 'feature_id' END AS kf, CAST(payload AS JSON) AS j
  FROM raw_records WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'
), f1 AS (
  SELECT series_id, file_id, file_seq, kf, j->>kf AS key, k AS field, json_extract(j, '$."' || k || '"') AS v FROM (SELECT *, unnest(json_keys(j)) AS k FROM lines)
), f2 AS (
  SELECT series_id, file_id, file_seq, kf, key, field || '.' || k AS field, json_extract(v, '$."' || k || '"') AS v
  FROM (SELECT *, unnest(json_keys(v)) AS k FROM f1 WHERE json_type(v) = 'OBJECT')
), every AS (SELECT * FROM f1 WHERE json_type(v) <> 'OBJECT' UNION ALL SELECT * FROM f2),
typed AS (
  SELECT series_id, file_id, file_seq, key, field,
    CASE WHEN json_type(v) IN ('BIGINT', 'UBIGINT', 'HUGEINT') THEN 'integer' WHEN json_type(v) = 'DOUBLE' THEN 'decimal' WHEN json_type(v) = 'VARCHAR' THEN 'text'
      WHEN json_type(v) = 'BOOLEAN' THEN 'boolean' WHEN json_type(v) = 'ARRAY' THEN 'list' END AS type,
    CASE WHEN json_type(v) = 'NULL' THEN NULL WHEN json_type(v) = 'ARRAY' AND json_array_length(v) = 1 THEN json_extract_string(v, '$[0]') ELSE json_extract_string(v, '$') END AS raw
  FROM every WHERE field <> kf
), fields AS (
  SELECT * EXCLUDE (raw), CASE WHEN regexp_full_match(raw, '-?(0|[1-9][0-9]*)\.[0-9]+') THEN rtrim(rtrim(raw, '0'), '.') ELSE raw END AS value FROM typed
), files AS (
  SELECT series_id, file_id, row_number() OVER (PARTITION BY series_id ORDER BY file_seq, file_id) AS place, count(*) OVER (PARTITION BY series_id) AS n_files
  FROM (SELECT DISTINCT series_id, file_id, file_seq FROM fields)
), cat AS (
  SELECT series_id, file_id, place, n_files, field, max(type) AS type FROM fields JOIN files USING (series_id, file_id) GROUP BY ALL
), life AS (
  SELECT *, lag(place) OVER w IS DISTINCT FROM place - 1 AS first, lead(place) OVER w IS DISTINCT FROM place + 1 AS last FROM cat WINDOW w AS (PARTITION BY series_id, field ORDER BY place)
), marked AS (SELECT *, sum(CAST(first AS INTEGER)) OVER (PARTITION BY series_id, field ORDER BY place) AS island FROM life),
span AS (
  SELECT * EXCLUDE (type), last_value(type IGNORE NULLS) OVER (PARTITION BY series_id, field, island ORDER BY place ROWS UNBOUNDED PRECEDING) AS type FROM marked
)"""

_P4_CHANGES = r""", ended AS (SELECT series_id, file_id AS old_file, place + 1 AS place, field AS old_name, type AS old_type FROM span WHERE last AND place < n_files),
begun AS (SELECT series_id, file_id, place, field AS new_name, type AS new_type FROM span WHERE first AND place > 1),
filled AS (SELECT DISTINCT series_id, file_id, field, key, value FROM fields WHERE value IS NOT NULL AND key IS NOT NULL),
pairs AS (
  SELECT e.series_id, b.file_id, old_name, new_name, old_type, new_type, count(*) AS n, count(*) FILTER (WHERE o.value = w.value) AS same
  FROM ended e JOIN begun b USING (series_id, place) JOIN filled o ON o.series_id = e.series_id AND o.file_id = e.old_file AND o.field = old_name
  JOIN filled w ON w.series_id = e.series_id AND w.file_id = b.file_id AND w.field = new_name AND w.key = o.key GROUP BY ALL
), renamed AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id, file_id, old_name ORDER BY n DESC, new_name) AS i,
    row_number() OVER (PARTITION BY series_id, file_id, new_name ORDER BY n DESC, old_name) AS k FROM pairs WHERE n = same) WHERE i = 1 AND k = 1
), next_file AS (SELECT series_id, place, file_id FROM files),
changes AS (
  SELECT file_id, 'renamed' AS change_kind, old_name, new_name FROM renamed
  UNION ALL SELECT file_id, 'retyped', old_name, new_name FROM renamed WHERE old_type <> new_type
  UNION ALL SELECT b.file_id, 'added', '', new_name FROM begun b ANTI JOIN renamed r ON r.series_id = b.series_id AND r.file_id = b.file_id AND r.new_name = b.new_name
  UNION ALL SELECT f.file_id, 'removed', old_name, '' FROM (SELECT e.*, f.file_id FROM ended e JOIN next_file f USING (series_id, place)) f
    ANTI JOIN renamed r ON r.series_id = f.series_id AND r.file_id = f.file_id AND r.old_name = f.old_name
  UNION ALL SELECT file_id, 'retyped', field, field FROM (SELECT *, lag(type) OVER (PARTITION BY series_id, field, island ORDER BY place) AS before FROM span) WHERE before <> type
)
SELECT DISTINCT file_id, change_kind, old_name, new_name FROM changes
"""

_P5 = r"""
WITH notes AS (
  SELECT dataset_id, replace(replace(any_value(protocol_note), 'µ', 'u'), 'μ', 'u') AS note FROM dataset_ref WHERE protocol_note IS NOT NULL GROUP BY 1
), defaults AS (
  SELECT dataset_id, lower(regexp_extract(note, '(?i)(?:doses?|concentrations?)\b[^.]*?(?:: | is in | are | as )(umol per litre|[a-z]+)', 1)) AS dose_default,
    lower(regexp_extract(note, '(?i)(?:counted in|without a unit are|for time, it is) (whole days|[a-z]+)', 1)) AS time_default FROM notes
), masses AS (SELECT entry_name AS perturbation_id, any_value(molar_mass) AS mass FROM canonical_values WHERE entry_field = 'perturbation_id' AND molar_mass IS NOT NULL GROUP BY 1),
long AS (
  SELECT condition_id, 'dose' AS quantity, dose AS v, dose_unit AS u, nullif(dose_default, '') AS said, mass FROM conditions LEFT JOIN defaults USING (dataset_id) LEFT JOIN masses USING (perturbation_id)
  UNION ALL SELECT condition_id, 'time', time, time_unit, nullif(time_default, ''), NULL FROM conditions LEFT JOIN defaults USING (dataset_id)
), bare AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(trim(v), '^(?:~|@|ca\. ?|dose=|t=)', ''), '\s*(?:final|\(nominal\)|post)$', ''), CASE quantity WHEN 'time' THEN '^T' ELSE '^\z\A' END, '') AS t FROM long WHERE v IS NOT NULL
), parsed AS (
  SELECT *, regexp_extract(t, '^([+-]?[0-9][0-9,]*(?:\.[0-9]+)?)(?:\s*[x*]\s*10\^([+-]?[0-9]+)|[eE]([+-]?[0-9]+))?\s*([A-Za-zµμ][^0-9]*)?$', ['n', 'p1', 'p2', 'w']) AS m FROM bare
), read AS (
  SELECT *, TRY_CAST(CASE WHEN m.n = '' THEN NULL WHEN regexp_full_match(m.n, '[0-9]+(,[0-9]{3})+(\.[0-9]+)?') AND NOT regexp_matches(m.n, '^0+,') THEN replace(m.n, ',', '')
      WHEN regexp_full_match(m.n, '[+-]?[0-9]+,[0-9]+') THEN replace(m.n, ',', '.') WHEN NOT contains(m.n, ',') THEN m.n END || 'e' || CASE WHEN m.p1 || m.p2 = '' THEN '0' ELSE m.p1 || m.p2 END AS DOUBLE) AS n,
    nullif(lower(replace(replace(trim(m.w), 'µ', 'u'), 'μ', 'u')), '') AS inside,
    CASE WHEN u IS NOT NULL AND lower(trim(u)) NOT IN ('', 'nan', 'none', 'null', 'na', '<missing>') THEN lower(replace(replace(trim(u), 'µ', 'u'), 'μ', 'u')) END AS beside FROM parsed
), named AS (SELECT *, coalesce(inside, beside, said) AS unit, lower(t) AS lt FROM read),
hms AS (
  SELECT *, coalesce(TRY_CAST(regexp_extract(lt, '(\d+(?:\.\d+)?)w', 1) AS DOUBLE), 0) * 604800 + coalesce(TRY_CAST(regexp_extract(lt, '(\d+(?:\.\d+)?)\s*d', 1) AS DOUBLE), 0) * 86400
    + coalesce(TRY_CAST(regexp_extract(lt, '(\d+(?:\.\d+)?)\s*h', 1) AS DOUBLE), 0) * 3600 + coalesce(TRY_CAST(regexp_extract(lt, '(\d+(?:\.\d+)?)\s*m', 1) AS DOUBLE), 0) * 60
    + coalesce(TRY_CAST(regexp_extract(lt, '(\d+(?:\.\d+)?)\s*s', 1) AS DOUBLE), 0) AS parts FROM named
), common AS (
  SELECT condition_id, quantity, v, u, CASE WHEN quantity = 'dose' THEN CASE
      WHEN unit IN ('log m', 'log10 m', 'log10(m)') THEN pow(10.0, n + 12)
      WHEN n < 0 THEN NULL
      WHEN unit IN ('pm', 'picomolar', 'pmol/l') THEN n
      WHEN unit IN ('nm', 'nanomolar', 'nmol/l', 'nmol l-1', 'pmol/ml', 'fmol/ul') THEN n * 1e3
      WHEN unit IN ('um', 'micromolar', 'umol/l', 'umol per litre', 'nmol/ml') THEN n * 1e6
      WHEN unit IN ('mm', 'millimolar', 'mmol/l', 'mol/m3') THEN n * 1e9
      WHEN unit IN ('molar', 'mol/l') OR (unit = 'm' AND (trim(m.w) = 'M' OR (inside IS NULL AND trim(u) = 'M'))) THEN n * 1e12
      WHEN unit = 'mg/ml' THEN n * 1e12 / mass WHEN unit IN ('ug/ml', 'mg/l') THEN n * 1e9 / mass WHEN unit IN ('ng/ml', 'ug/l') THEN n * 1e6 / mass END
    ELSE CASE
      WHEN regexp_full_match(t, 'P(\d+D)?(T(\d+H)?(\d+M)?(\d+S)?)?') AND regexp_matches(t, '\d') THEN parts
      WHEN regexp_full_match(lt, '(\d+\s*[dh]\s*)\d+\s*(h|min)') THEN parts
      WHEN regexp_full_match(t, '\d{1,3}:[0-5]\d') AND beside IN ('h:mm', 'hh:mm') THEN CAST(split_part(t, ':', 1) AS DOUBLE) * 3600 + CAST(split_part(t, ':', 2) AS DOUBLE) * 60
      WHEN regexp_full_match(lt, 'd(ay)?\s*\d+') THEN CAST(regexp_extract(lt, '\d+') AS DOUBLE) * 86400
      WHEN n < 0 THEN NULL
      WHEN unit IN ('s', 'sec', 'seconds') THEN n WHEN unit IN ('min', 'mins', 'min.', 'minutes') THEN n * 60 WHEN unit IN ('h', 'hr', 'hrs', 'hour', 'hours') THEN n * 3600
      WHEN unit IN ('d', 'day', 'days', 'whole days') THEN n * 86400 WHEN unit IN ('wk', 'week', 'weeks') THEN n * 604800 END END AS c FROM hms
)
SELECT DISTINCT condition_id, quantity, CAST(round(round(c, 6)) AS BIGINT) AS common_value FROM common
WHERE c IS NOT NULL AND NOT (regexp_full_match(v, '[0-9]+(\.[0-9]+)?') AND coalesce(u, '') = CASE quantity WHEN 'dose' THEN 'nM' ELSE 'h' END)
"""

_P6 = r"""
WITH special AS (SELECT '[;,|/+&_\s''"()\[\]{}]' AS re),
names AS (
  SELECT 'meta_summary' AS t, list(n ORDER BY length(n) DESC, n) AS l FROM (SELECT DISTINCT dataset_id AS n FROM dataset_ref, special WHERE regexp_matches(dataset_id, re))
  UNION ALL
  SELECT 'interventions', list(n ORDER BY length(n) DESC, n)
  FROM (SELECT DISTINCT entry_name AS n FROM canonical_values, special WHERE entry_field = 'perturbation_id' AND regexp_matches(entry_name, re))
), rows AS (
  SELECT 'meta_summary' AS source_table, CAST(summary_row_id AS VARCHAR) AS row_key, datasets AS v FROM meta_summary WHERE datasets IS NOT NULL
  UNION ALL SELECT DISTINCT 'interventions', intervention_id, perturbation_id FROM interventions WHERE perturbation_id IS NOT NULL
), held AS (
  SELECT source_table, row_key, l, list_reduce(l, lambda t, n, i: replace(t, n, chr(CAST(57344 + list_position(l, n) AS INTEGER))), replace(v, '\''', '''')) AS v
  FROM rows JOIN names ON t = source_table
), bare AS (
  SELECT source_table, row_key, l,
    regexp_replace(regexp_replace(regexp_replace(v, '^\s*\[(.*)\]\s*$', '\1', 's'), '^\s*\((.*)\)\s*$', '\1', 's'), '^\s*\{(.*)\}\s*$', '\1', 's') AS v FROM held
), places AS (
  SELECT source_table, row_key, l,
    list_transform(string_split_regex(regexp_replace(v, '["'']', '', 'g'), '[;,|/+&\t\n\r_]'), lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')) AS ps FROM bare
), kept AS (SELECT source_table, row_key, l, ps FROM places WHERE len(list_filter(ps, lambda p: p <> '')) >= 2),
each AS (SELECT source_table, row_key, l, unnest(ps) AS p, CAST(unnest(range(1, len(ps) + 1)) AS BIGINT) AS item_no FROM kept)
SELECT source_table, row_key, item_no, CASE WHEN unicode(p) BETWEEN 57345 AND 63743 THEN l[unicode(p) - 57344] ELSE p END AS item FROM each WHERE p <> ''
"""

SQL = {
    "p1_found": _JUDGED
    + """
SELECT table_name, column_name, load_no, 'missing' AS finding FROM compared WHERE n_missing > 0.15 * n
UNION ALL SELECT table_name, column_name, load_no, 'constant' FROM compared WHERE n_distinct = 1
UNION ALL SELECT table_name, column_name, load_no, 'pattern' FROM compared WHERE wrong > 0
UNION ALL SELECT table_name, column_name, load_no, 'range' FROM compared WHERE outside > 0
UNION ALL SELECT table_name, column_name, load_no, 'drift' FROM compared
  WHERE abs(share - p_share) > 0.2503 OR (kind = 1 AND (med > 3 * p_med OR med * 3 < p_med))
""",
    "p4_found": _P4 + _P4_CHANGES,
    "p4_lifespans": _P4
    + """, steps AS (SELECT *, type <> lag(type) OVER (PARTITION BY series_id, field, island ORDER BY place) AS changed FROM span),
numbered AS (SELECT *, sum(CASE WHEN first OR coalesce(changed, false) THEN 1 ELSE 0 END) OVER (PARTITION BY series_id, field ORDER BY place) AS stretch FROM steps)
SELECT series_id, field, max(type) AS type, arg_min(file_id, place) AS first_file, arg_max(file_id, place) AS last_file, count(*) AS files
FROM numbered GROUP BY series_id, field, stretch
""",
    "p5_found": _P5,
    "p6_found": _P6,
}
