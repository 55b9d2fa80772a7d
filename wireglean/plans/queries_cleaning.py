"""Cleaning, sampling, weighting and fitted preprocessing."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.operators import cleaning, preprocessing, sampling
from wireglean.operators.features import feature_columns, with_derived_features
from wireglean.operators.order_statistics import quantile_table, quantiles
from wireglean.plans import oracle as O
from wireglean.plans.catalog import query, rounded
from wireglean.plans.fixtures import raw_flows
from wireglean.plans.queries_rows import labelled

_cleaned: dict = {}


def cleaned(spark, sf_dir):
    """The cleaned table with its report, once per session: many queries start from it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _cleaned:
        _cleaned[key] = cleaning.clean(raw_flows(spark, sf_dir))
    return _cleaned[key]


def clean_rows(spark, sf_dir):
    return cleaned(spark, sf_dir)[0]


@query("c1_labelled_rows", O.LABELLED + """SELECT CAST((SELECT count(*) FROM raw_flows) AS BIGINT) AS rows_in,
  CAST((SELECT count(*) FROM raw_flows) - count(*) AS BIGINT) AS null_label_rows FROM labelled""")
def c1(spark, sf_dir):
    table = cleaning.with_families(raw_flows(spark, sf_dir))
    return table.agg(F.count("*").alias("rows_in"), F.count_if(F.col("label") == "").alias("null_label_rows"))


_PLAIN = [c for c in tax.CORE_FEATURES if c not in ("destination_port", "protocol")]


@query("c2_without_leakage", O.LABELLED + "SELECT destination_port, protocol, label, "
       + ", ".join(f"round({c}, 3) AS {c}" for c in _PLAIN) + " FROM labelled")
def c2(spark, sf_dir):
    table = labelled(spark, sf_dir)
    return rounded(table.drop(*cleaning.leakage_columns(table)), 3)


@query("c3_infinity_count", O.LABELLED + """SELECT CAST(sum(CAST(isinf(flow_bytes_s) AS INT)
  + CAST(isinf(flow_packets_s) AS INT)) AS BIGINT) AS infinities FROM labelled""")
def c3(spark, sf_dir):
    table = labelled(spark, sf_dir)
    return table.agg(F.sum(cleaning.infinities_in_row(table)).alias("infinities"))


MIXED = {
    "mostly_number": "CASE WHEN flow_id % 20 = 0 THEN 'broken' ELSE CAST(destination_port AS {text}) END",
    "half_number": "CASE WHEN flow_id % 2 = 0 THEN 'text' ELSE CAST(destination_port AS {text}) END",
    "rate_text": "CASE WHEN flow_id % 50 = 0 THEN 'Infinity' WHEN flow_id % 30 = 0 THEN NULL "
                 "ELSE CAST(destination_port AS {text}) END",
}
_mixed_sql = ", ".join(f"{sql.format(text='VARCHAR')} AS {c}" for c, sql in MIXED.items())


@query("c4_numeric_coercion", O.LABELLED + f", t AS (SELECT flow_id, {_mixed_sql} FROM labelled) "
       "SELECT flow_id, try_cast(mostly_number AS DOUBLE) AS mostly_number, half_number, "
       "CASE WHEN isinf(try_cast(rate_text AS DOUBLE)) THEN NULL ELSE try_cast(rate_text AS DOUBLE) END AS rate_text "
       "FROM t")
def c4(spark, sf_dir):
    table = labelled(spark, sf_dir).select(
        "flow_id", *[F.expr(sql.format(text="STRING")).alias(c) for c, sql in MIXED.items()], "label")
    return cleaning.coerced(table, cleaning.profile(table).types).drop("label")


@query("c5_all_null_columns", O.LABELLED + "SELECT flow_id, flow_duration FROM labelled")
def c5(spark, sf_dir):
    table = labelled(spark, sf_dir).select("flow_id", "flow_duration", "label").withColumns(
        {"empty_text": F.lit(None).cast("string"), "empty_number": F.lit(None).cast("double")})
    return cleaning.without_useless_columns(table, cleaning.profile(table)).drop("label")


@query("c6_constant_columns", O.LABELLED + "SELECT flow_id, 'fixed' AS constant_text, rst_flag_count FROM labelled")
def c6(spark, sf_dir):
    table = labelled(spark, sf_dir).select("flow_id", "rst_flag_count", "urg_flag_count", "label").withColumns(
        {"constant_text": F.lit("fixed"), "constant_number": F.lit(7)})
    return cleaning.without_useless_columns(table, cleaning.profile(table)).drop("label")


_TOTALS = """count(*) AS n, round(sum(flow_duration) / 1e6, 4) AS seconds,
  CAST(count(flow_bytes_s) AS BIGINT) AS with_rate, CAST(sum(total_fwd_packets) AS BIGINT) AS packets"""


def totals(df, *keys):
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.round(F.sum("flow_duration") / 1e6, 4).alias("seconds"),
        F.count("flow_bytes_s").alias("with_rate"), F.sum("total_fwd_packets").cast("bigint").alias("packets"),
    )


@query("c7_distinct_rows", O.DISTINCT + f"SELECT label, {_TOTALS} FROM distinct_rows GROUP BY label")
def c7(spark, sf_dir):
    table, _, _ = cleaning.prepared(raw_flows(spark, sf_dir))
    return totals(table.dropDuplicates(), "label")


@query("c8_rare_classes", O.DISTINCT + "SELECT label, n FROM class_sizes WHERE n >= 50")
def c8(spark, sf_dir):
    table, _, _ = cleaning.prepared(raw_flows(spark, sf_dir))
    distinct = table.dropDuplicates()
    kept = cleaning.without_rare_classes(distinct, sampling.class_counts(distinct))
    return kept.groupBy("label").agg(F.count("*").alias("n"))


@query("c9_cleaning_report", O.DISTINCT + """SELECT
  (SELECT count(*) FROM raw_flows) AS rows_in, (SELECT count(*) FROM cleaned) AS rows_out,
  (SELECT count(*) FROM labelled) - (SELECT count(*) FROM distinct_rows) AS duplicates_removed,
  (SELECT count(*) FROM raw_flows) - (SELECT count(*) FROM labelled) AS null_label_rows_removed,
  (SELECT CAST(sum(CAST(isinf(flow_bytes_s) AS INT) + CAST(isinf(flow_packets_s) AS INT)) AS BIGINT) FROM labelled)
    AS infinite_values_replaced,
  'flow_id,source_ip,destination_ip,timestamp' AS leakage, '' AS all_null, 'urg_flag_count' AS constant,
  coalesce((SELECT string_agg(label || '=' || n, ',' ORDER BY label) FROM class_sizes WHERE n < 50), '') AS rare,
  (SELECT string_agg(label || '=' || n, ',' ORDER BY label) FROM class_sizes WHERE n >= 50) AS classes""")
def c9(spark, sf_dir):
    report = cleaned(spark, sf_dir)[1].to_frame(spark)

    def listed(column):
        entries = F.array_sort(F.map_entries(column))
        return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")

    return report.select(
        "rows_in", "rows_out", "duplicates_removed", "null_label_rows_removed", "infinite_values_replaced",
        F.array_join("leakage_columns_dropped", ",").alias("leakage"),
        F.array_join("all_null_columns_dropped", ",").alias("all_null"),
        F.array_join("constant_columns_dropped", ",").alias("constant"),
        listed("rare_classes_dropped").alias("rare"), listed("class_counts").alias("classes"),
    )


@query("c0_cleaned_table", O.DISTINCT + "SELECT label, destination_port, protocol, "
       + ", ".join(f"round({c}, 3) AS {c}" for c in O.KEPT if c not in ("destination_port", "protocol"))
       + " FROM cleaned")
def c0(spark, sf_dir):
    return rounded(clean_rows(spark, sf_dir), 3)


@query("c10_class_shares", O.DISTINCT + """SELECT label, n, round(n * 100.0 / (SELECT sum(n) FROM class_sizes WHERE n >= 50), 6)
  AS percent, round((SELECT max(n) FROM class_sizes) * 1.0 / n, 6) AS times_rarer FROM class_sizes WHERE n >= 50""")
def c10(spark, sf_dir):
    return rounded(cleaning.class_shares(clean_rows(spark, sf_dir)))


# Largest remainders: floor of the share, then one more row for the classes with the largest rest.
_SPLIT = O.DISTINCT + """, ok AS (SELECT label, n FROM class_sizes WHERE n >= 50),
  t AS (SELECT CAST(sum(n) AS BIGINT) AS total, CAST(ceil(sum(n) * 0.2::DOUBLE) AS BIGINT) AS n_test FROM ok),
  sa AS (SELECT label, n, (n * (total - n_test)) // total AS base, (n * (total - n_test)) % total AS rest,
        total - n_test AS goal FROM ok, t),
  sb AS (SELECT *, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= goal - sum(base) OVER ()
        THEN 1 ELSE 0 END AS m FROM sa),
  t2 AS (SELECT CAST(sum(m) AS BIGINT) AS total, CAST(ceil(sum(m) * 0.2::DOUBLE) AS BIGINT) AS n_val FROM sb),
  sc AS (SELECT label, n, m, (m * (total - n_val)) // total AS base2, (m * (total - n_val)) % total AS rest2,
        total - n_val AS goal2 FROM sb, t2),
  sd AS (SELECT *, base2 + CASE WHEN row_number() OVER (ORDER BY rest2 DESC, label) <= goal2 - sum(base2) OVER ()
        THEN 1 ELSE 0 END AS n_train FROM sc)
"""


@query("d1_stratified_split", _SPLIT + """SELECT label, 'train' AS split, CAST(n_train AS BIGINT) AS n FROM sd
  UNION ALL SELECT label, 'validation', CAST(m - n_train AS BIGINT) FROM sd
  UNION ALL SELECT label, 'test', CAST(n - m AS BIGINT) FROM sd""")
def d1(spark, sf_dir):
    return sampling.stratified_split(clean_rows(spark, sf_dir)).groupBy("label", "split").agg(
        F.count("*").alias("n"))


CAP = 700


@query("d2_capped_classes", O.DISTINCT + f"SELECT label, least(n, {CAP}) AS n FROM class_sizes WHERE n >= 50")
def d2(spark, sf_dir):
    return sampling.capped_classes(clean_rows(spark, sf_dir), cap=CAP).groupBy("label").agg(
        F.count("*").alias("n"))


@query("d3_balanced_weights", O.DISTINCT + """, ok AS (SELECT label, n FROM class_sizes WHERE n >= 50)
  SELECT label, n, round((SELECT sum(n) FROM ok) * 1.0 / ((SELECT count(*) FROM ok) * n), 6) AS weight FROM ok""")
def d3(spark, sf_dir):
    weighted = sampling.balanced_weights(clean_rows(spark, sf_dir))
    return rounded(weighted.groupBy("label").agg(F.count("*").alias("n"), F.max("weight").alias("weight")))


@query("d4_stratified_folds", O.DISTINCT + """, ok AS (SELECT label, n, sum(n) OVER (ORDER BY label) AS stop
    FROM class_sizes WHERE n >= 50),
  places AS (SELECT label, unnest(range(CAST(stop - n AS BIGINT), CAST(stop AS BIGINT))) AS place FROM ok)
  SELECT label, place % 3 AS fold, count(*) AS n FROM places GROUP BY ALL""")
def d4(spark, sf_dir):
    folds = sampling.with_folds(clean_rows(spark, sf_dir))
    return rounded(folds.groupBy("label", "fold").agg(F.count("*").alias("n")))


@query("d5_calibration_sample", O.DISTINCT + "SELECT least(count(*), 5000) AS n FROM cleaned")
def d5(spark, sf_dir):
    return sampling.hash_sample(clean_rows(spark, sf_dir), 5000).agg(F.count("*").alias("n"))


# The fit reads one row per row of the table; the SQL repeats it with interpolated quantiles.
_NUMERIC = [c for c in dict.fromkeys([*tax.CORE_FEATURES, *tax.DERIVED_FEATURES])
            if c not in ("protocol", "urg_flag_count")]


def fitted(spark, sf_dir):
    table = clean_rows(spark, sf_dir)
    return preprocessing.fit_preprocessor(table, feature_columns(table))


_MEDIANS = O.DISTINCT + ", med AS (SELECT " + ", ".join(
    f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}" for c in _NUMERIC) + " FROM cleaned_derived)"
_RANGES = _MEDIANS + ", filled AS (SELECT " + ", ".join(
    f"coalesce(CAST(t.{c} AS DOUBLE), m.{c}) AS {c}" for c in _NUMERIC) + " FROM cleaned_derived t, med m), rng AS (SELECT " \
    + ", ".join(f"quantile_cont({c}, 0.95) - quantile_cont({c}, 0.05) AS {c}" for c in _NUMERIC) + " FROM filled)"


@query("e1_medians", _MEDIANS + " UNION ALL ".join(
    f" SELECT '{c}' AS feature, round({c}, 4) AS median FROM med" for c in _NUMERIC))
def e1(spark, sf_dir):
    return rounded(fitted(spark, sf_dir).parameter_table(spark).select("feature", "median"), 4)


@query("e2_robust_scales", _RANGES + " UNION ALL ".join(
    f" SELECT '{c}' AS feature, round(CASE WHEN {c} = 0 THEN 1 ELSE {c} END, 4) AS scale FROM rng" for c in _NUMERIC))
def e2(spark, sf_dir):
    return rounded(fitted(spark, sf_dir).parameter_table(spark).select("feature", "scale"), 4)


@query("e3_vocabulary", O.DISTINCT + """, v AS (
    SELECT 'port_category' AS feature, port_category AS category FROM cleaned_derived
    UNION ALL SELECT 'protocol', protocol FROM cleaned_derived)
  SELECT feature, category, count(*) < 0.001 * (SELECT count(*) FROM cleaned) AS rare, count(*) AS n FROM v GROUP BY ALL""")
def e3(spark, sf_dir):
    table = clean_rows(spark, sf_dir)
    counts = preprocessing.category_counts(with_derived_features(table))
    return fitted(spark, sf_dir).vocabulary_table(spark).join(counts, ["feature", "category"])


# All features: the numbers one by one, a one-hot group as the name of the entry that is set.
@query("e4_feature_matrix", _RANGES + """, v AS (SELECT 'port_category' AS feature, port_category AS category FROM cleaned_derived
    UNION ALL SELECT 'protocol', protocol FROM cleaned_derived),
  rare AS (SELECT feature, category FROM v GROUP BY ALL HAVING count(*) < 0.001 * (SELECT count(*) FROM cleaned))
  SELECT label, """ + ", ".join(
    f"CASE WHEN t.{c} IN (SELECT category FROM rare WHERE feature = '{c}') THEN 'infrequent' ELSE t.{c} END AS {c}"
    for c in ("port_category", "protocol")) + ", " + ", ".join(
    f"round((coalesce(CAST(t.{c} AS DOUBLE), m.{c}) - m.{c}) / CASE WHEN r.{c} = 0 THEN 1 ELSE r.{c} END, 5) AS {c}"
    for c in _NUMERIC) + " FROM cleaned_derived t, med m, rng r")
def e4(spark, sf_dir):
    model = fitted(spark, sf_dir)
    names = model.feature_names()
    rows = model.transform(clean_rows(spark, sf_dir), keep=["label"]).select(
        "label", vector_to_array("features").alias("x"))

    def hot(column):
        places = [(i, n.removeprefix(f"{column}_")) for i, n in enumerate(names) if n.startswith(f"{column}_")]
        found = F.filter(F.array(*[F.when(F.get("x", F.lit(i)) == 1, F.lit(n)) for i, n in places]), lambda v: v.isNotNull())
        return F.array_join(found, "+").alias(column)

    numbers = [n for n in names if n in _NUMERIC]
    return rows.select("label", hot("port_category"), hot("protocol"),
                       *[F.round(F.get("x", F.lit(names.index(c))), 5).alias(c) for c in numbers])


@query("e5_fit_on_train_only", _SPLIT + """, parts AS (SELECT 'train' AS split, CAST(sum(n_train) AS BIGINT) AS n FROM sd
    UNION ALL SELECT 'validation', CAST(sum(m - n_train) AS BIGINT) FROM sd
    UNION ALL SELECT 'test', CAST(sum(n - m) AS BIGINT) FROM sd)
  SELECT split, n, CAST(1 AS BIGINT) AS widths, CAST(0 AS BIGINT) AS rows_not_finite FROM parts""")
def e5(spark, sf_dir):
    """Learn on the training part, replay on the other two."""
    parts = sampling.stratified_split(clean_rows(spark, sf_dir))
    train = parts.where("split = 'train'").drop("split")
    model = preprocessing.fit_preprocessor(train, feature_columns(train))
    rows = model.transform(parts, keep=["split"]).select("split", vector_to_array("features").alias("x"))
    return rows.groupBy("split").agg(
        F.count("*").alias("n"), F.count_distinct(F.size("x")).alias("widths"),
        F.count_if(F.exists("x", lambda v: v.isNull() | F.isnan(v))).alias("rows_not_finite"),
    )


_NARROWED = O.LABELLED + " UNION ALL ".join(
    f" SELECT label, '{c}' AS feature, {q}::DOUBLE AS share, round(quantile_cont({c}, {q}), 4) AS value "
    f"FROM labelled GROUP BY label" for c in ("flow_duration", "flow_iat_mean") for q in (0.05, 0.5, 0.95))


@query("x2_quantiles_by_narrowing", _NARROWED)
def x2(spark, sf_dir):
    """The values as a dictionary on the driver, one per class, column and share."""
    columns, shares = ["flow_duration", "flow_iat_mean"], [0.05, 0.5, 0.95]
    found = quantiles(labelled(spark, sf_dir), columns, shares, by="label")
    rows = [(g, c, s, v) for (g, c), vs in found.items() for s, v in zip(shares, vs)]
    return rounded(spark.createDataFrame(rows, "label string, feature string, share double, value double"), 4)


@query("x1_exact_quantiles", _NARROWED)
def x1(spark, sf_dir):
    """Per class, which shows the order statistics on a group that holds half the rows."""
    table = labelled(spark, sf_dir)
    found = quantile_table(table, ["flow_duration", "flow_iat_mean"], [0.05, 0.5, 0.95], by="label")
    return rounded(found.withColumnRenamed("grp", "label"), 4)
