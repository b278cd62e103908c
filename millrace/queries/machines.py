"""Telemetry: profile, imputation, outliers, failure modes and streamed flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.machine import (
    FAILURE, NORMAL, heat_dissipation_failure, overstrain_failure, power_failure, temperature_difference,
)
from millrace.functions.numeric import percent, round_half_even
from millrace.operators.cleaning import (
    fit_imputation, fit_outlier_fences, fit_quartile_fences,
)
from millrace.operators.codes import dense_codes
from millrace.operators.profile import (
    box_outliers, box_statistics, column_means, describe, describe_numbers, describe_text, flag_counts,
    quantile_table, true_counts, value_counts,
)
from millrace.operators.reports import danger_zones
from millrace.plans.scoring_batch import literal_batch
from millrace.plans.stand_ins import telemetry_extract
from millrace.plans.telemetry import (
    FAILURE_MODES, MEASURES, fit_telemetry_cleaner, telemetry_names,
)
from millrace.queries.registry import query
from millrace.sources.staging import new_location
from millrace.streaming.queue import open_queue, start_queue
from millrace.streaming.scoring import arriving_rows, score_available


def _rounded(rows, digits: int, *columns: str):
    return rows.withColumns({c: round_half_even(F.col(c), digits) for c in columns})


def _r(expression: str, digits: int = 6) -> str:
    return f"round_even(({expression}) * 1e{digits}::DOUBLE, 0) / 1e{digits}::DOUBLE"


def _per_measure(template: str, table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {template.format(c=f'{c}::DOUBLE')} FROM {{{{{table}}}}}" for c in MEASURES)


@query("s6_literal_batch", """
SELECT b.machine_id, (b.process_temperature_k - b.air_temperature_k)::DOUBLE AS temp_difference_k,
  CASE WHEN b.rotational_speed_rpm < s1 - 1.5 * (s3 - s1) OR b.rotational_speed_rpm > s3 + 1 THEN 1 ELSE 0 END
    AS rotational_speed_rpm_outlier,
  CASE WHEN b.torque_nm < t1 - 1.5 * (t3 - t1) OR b.torque_nm > t3 + 1 THEN 1 ELSE 0 END AS torque_nm_outlier
FROM (VALUES
  ('CNC_001', 298.1::DOUBLE, 308.6::DOUBLE, 1540, 42.5::DOUBLE), ('CNC_002', 298.2, 308.7, 1565, 41.2),
  ('CNC_003', 292.9, 308.5, 2542, 58.1), ('CNC_004', 298.5, 309.1, 1600, 39.5),
  ('CNC_005', 299.1, 310.2, 1180, 68.5), ('CNC_006', 297.5, 308.2, 1555, 42.0),
  ('CNC_007', 298.0, 308.5, 1570, 41.5), ('CNC_008', 298.1, 308.6, 1545, 42.8),
  ('CNC_009', 298.4, 308.8, 1580, 40.2), ('CNC_010', 297.8, 308.4, 1560, 41.8),
  ('CNC_011', 298.2, 308.7, 1550, 42.4), ('CNC_012', 303.5, 314.1, 1350, 58.2),
  ('CNC_013', 298.0, 308.5, 1565, 41.9), ('CNC_014', 297.9, 308.4, 1555, 42.1),
  ('CNC_015', 298.1, 308.6, 1540, 43.0), ('CNC_016', 298.3, 308.9, 1575, 40.5),
  ('CNC_017', 298.1, 308.5, 1550, 42.2), ('CNC_018', 298.5, 309.2, 1100, 72.1),
  ('CNC_019', 298.2, 308.8, 1560, 41.6), ('CNC_020', 298.0, 308.5, 1555, 69.2)
) b(machine_id, air_temperature_k, process_temperature_k, rotational_speed_rpm, torque_nm)
CROSS JOIN (SELECT quantile_cont(rotational_speed_rpm::DOUBLE, 0.25) AS s1,
  quantile_cont(rotational_speed_rpm::DOUBLE, 0.75) AS s3, quantile_cont(torque_nm, 0.25) AS t1,
  quantile_cont(torque_nm, 0.75) AS t3 FROM {{readings}})""")
def literal_machines(w):
    fences = fit_outlier_fences(w.readings, ["rotational_speed_rpm", "torque_nm"])
    return fences.apply(literal_batch(w.spark)).select(
        "machine_id", "temp_difference_k", "rotational_speed_rpm_outlier", "torque_nm_outlier")


@query("p11_machine_types", """
SELECT machine_type, dense_rank() OVER (ORDER BY machine_type)::INT - 1 AS type_code, rows FROM (
  SELECT machine_type, count(*) AS rows FROM {{readings}} GROUP BY ALL)""")
def type_codes(w):
    # A category is kept as text; its code is the place in sorted order among the distinct values.
    counts = value_counts(w.readings, "machine_type")
    return dense_codes(counts, "machine_type", code="type_code").join(counts, "machine_type").select(
        "machine_type", F.col("type_code").cast("int").alias("type_code"), F.col("n").alias("rows"))


@query("f11_temperature_difference", """
SELECT udi, process_temperature_k - air_temperature_k AS temp_difference_k FROM {{readings}}""")
def stress(w):
    return w.readings.select("udi", temperature_difference(
        F.col("process_temperature_k"), F.col("air_temperature_k")).alias("temp_difference_k"))


@query("f14_mean_imputation", "SELECT udi, " + ", ".join(
    f"{_r(f'{c}::DOUBLE')} AS {c}" for c in MEASURES) + " FROM {{imputed}}")
def imputed_by_mean(w):
    rows = telemetry_names(w.telemetry_raw).select("udi", *MEASURES)
    return _rounded(fit_imputation(rows, MEASURES).apply(rows), 6, *MEASURES)


@query("f14_median_imputation", "SELECT udi, " + ", ".join(
    f"coalesce({c}::DOUBLE, (SELECT quantile_cont({c}::DOUBLE, 0.5) FROM {{{{recorded}}}})) AS {c}"
    for c in MEASURES) + " FROM {{recorded}}")
def imputed_by_median(w):
    rows = telemetry_names(w.telemetry_raw).select("udi", *MEASURES)
    return fit_imputation(rows, MEASURES, "median").apply(rows)


def _fence_sql(upper: str) -> str:
    bounds = ", ".join(f"quantile_cont({c}::DOUBLE, 0.25) AS {c}_1, quantile_cont({c}::DOUBLE, 0.75) AS {c}_3"
                       for c in MEASURES)
    flags = ", ".join(
        f"CASE WHEN {c} < {c}_1 - 1.5 * ({c}_3 - {c}_1) OR {c} > {c}_3 + {upper.format(c=c)} THEN 1 ELSE 0 END "
        f"AS {c}_outlier" for c in MEASURES)
    return f"SELECT udi, {flags} FROM {{{{imputed}}}} CROSS JOIN (SELECT {bounds} FROM {{{{imputed}}}})"


@query("f15_outlier_flags", _fence_sql("1"))
def outlier_flags(w):
    return w.telemetry.select("udi", *[f"{c}_outlier" for c in MEASURES])


@query("f15_outlier_flags_tukey", _fence_sql("1.5 * ({c}_3 - {c}_1)"))
def tukey_flags(w):
    rows = w.telemetry.select("udi", *MEASURES)
    return fit_outlier_fences(rows, MEASURES, upper="tukey").apply(rows).drop(*MEASURES)


@query("f16_quartile_fences", """
SELECT udi, rotational_speed_rpm > s3 AS speed_beyond, torque_nm < t1 OR torque_nm > t3 AS torque_beyond
FROM {{readings}} CROSS JOIN (SELECT quantile_cont(rotational_speed_rpm::DOUBLE, 0.75) AS s3,
  quantile_cont(torque_nm, 0.25) AS t1, quantile_cont(torque_nm, 0.75) AS t3 FROM {{readings}})""")
def quartile_flags(w):
    return fit_quartile_fences(w.readings).apply(w.readings).select("udi", "speed_beyond", "torque_beyond")


@query("f18_failure_modes", """
SELECT udi, hdf, pwf, osf, greatest(hdf, pwf, osf) AS machine_failure FROM {{readings}}""")
def failure_modes(w):
    air, process = F.col("air_temperature_k"), F.col("process_temperature_k")
    rpm, torque, wear = F.col("rotational_speed_rpm"), F.col("torque_nm"), F.col("tool_wear_min")
    modes = w.readings.select(
        "udi", heat_dissipation_failure(process, air, rpm).alias("hdf"),
        power_failure(torque, rpm).alias("pwf"),
        overstrain_failure(wear, torque, F.col("machine_type")).alias("osf"))
    return modes.withColumn("machine_failure", F.greatest("hdf", "pwf", "osf"))


@query("a5_quartiles", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {p}::DOUBLE AS probability, "
    f"{_r(f'quantile_cont({c}::DOUBLE, {p})')} AS value FROM {{{{recorded}}}}"
    for c in MEASURES for p in (0.25, 0.5, 0.75)))
def quartiles(w):
    rows = telemetry_names(w.telemetry_raw)
    return _rounded(quantile_table(rows, MEASURES, [0.25, 0.5, 0.75]), 6, "value")


@query("a6_describe_numbers", _per_measure(
    "count({c}) AS count, " + _r("avg({c})") + " AS mean, " + _r("stddev_samp({c})") + " AS std, "
    "min({c}) AS min, " + _r("quantile_cont({c}, 0.25)") + " AS q25, " + _r("quantile_cont({c}, 0.5)")
    + " AS q50, " + _r("quantile_cont({c}, 0.75)") + " AS q75, max({c}) AS max", "recorded"))
def summary(w):
    rows = telemetry_names(w.telemetry_raw)
    return _rounded(describe_numbers(rows, MEASURES), 6, "mean", "std", "q25", "q50", "q75")


@query("a6_describe_text", """
SELECT 'machine_type' AS column_name, count(machine_type) AS count, count(DISTINCT machine_type) AS "unique",
  (SELECT machine_type FROM {{readings}} GROUP BY ALL ORDER BY count(*) DESC, machine_type LIMIT 1) AS top,
  (SELECT count(*) FROM {{readings}} GROUP BY machine_type ORDER BY count(*) DESC, machine_type LIMIT 1) AS freq
FROM {{readings}}
UNION ALL SELECT 'machine_id', count(machine_id), count(DISTINCT machine_id),
  (SELECT machine_id FROM {{readings}} GROUP BY ALL ORDER BY count(*) DESC, machine_id LIMIT 1),
  (SELECT count(*) FROM {{readings}} GROUP BY machine_id ORDER BY count(*) DESC, machine_id LIMIT 1)
FROM {{readings}}""")
def text_summary(w):
    return describe_text(w.readings, ["machine_type", "machine_id"])


_ALL_NUMBERS = ["udi", *MEASURES, "machine_failure", *FAILURE_MODES]
_ALL_TEXTS = ["machine_id", "machine_type", "ts"]


@query("a6_describe_table", " UNION ALL ".join(
    [f"""SELECT '{c}' AS column_name, count({c}) AS count, {_r(f"avg({c})")} AS mean, {_r(f"stddev_samp({c})")} AS std,
  min({c})::DOUBLE AS min, {_r(f"quantile_cont({c}::DOUBLE, 0.25)")} AS q25, {_r(f"quantile_cont({c}::DOUBLE, 0.5)")} AS q50,
  {_r(f"quantile_cont({c}::DOUBLE, 0.75)")} AS q75, max({c})::DOUBLE AS max, NULL::BIGINT AS "unique", NULL AS top,
  NULL::BIGINT AS freq FROM {{{{recorded}}}}""" for c in _ALL_NUMBERS]
    + [f"""SELECT '{c}', count({c}), NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(DISTINCT {c}),
  (SELECT {c}::VARCHAR FROM {{{{recorded}}}} GROUP BY {c} ORDER BY count(*) DESC, {c}::VARCHAR LIMIT 1),
  (SELECT count(*) FROM {{{{recorded}}}} GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) FROM {{{{recorded}}}}""" for c in _ALL_TEXTS]))
def table_summary(w):
    return _rounded(describe(telemetry_names(w.telemetry_raw)), 6, "mean", "std", "q25", "q50", "q75")


@query("a8_type_counts", """
SELECT machine_type, count(*) AS n FROM {{readings}} GROUP BY ALL""")
def type_counts(w):
    return value_counts(w.readings, "machine_type")


@query("a9_failure_counts", " UNION ALL ".join(
    f"SELECT '{m}' AS column_name, count_if({m} = 0)::BIGINT AS non_failure, count_if({m} = 1)::BIGINT AS failure "
    f"FROM {{{{readings}}}}" for m in FAILURE_MODES))
def failure_counts(w):
    return flag_counts(w.readings, FAILURE_MODES)


@query("a10_outlier_counts", """
SELECT 'speed_beyond' AS column_name, count_if(rotational_speed_rpm > s3)::BIGINT AS n
FROM {{readings}} CROSS JOIN (SELECT quantile_cont(rotational_speed_rpm::DOUBLE, 0.75) AS s3 FROM {{readings}})
UNION ALL SELECT 'torque_beyond', count_if(torque_nm < t1 OR torque_nm > t3)::BIGINT FROM {{readings}}
CROSS JOIN (SELECT quantile_cont(torque_nm, 0.25) AS t1, quantile_cont(torque_nm, 0.75) AS t3 FROM {{readings}})""")
def outlier_counts(w):
    rows = fit_quartile_fences(w.readings).apply(w.readings)
    return true_counts(rows, ["speed_beyond", "torque_beyond"])


@query("a11_column_means", _per_measure(_r("avg({c})") + " AS mean", "recorded"))
def means(w):
    return _rounded(column_means(telemetry_names(w.telemetry_raw), MEASURES), 6, "mean")


def _box_sql(c: str) -> str:
    v = f"{c}::DOUBLE"
    inside = f"{v} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return f"""SELECT '{c}' AS column_name, min({v}) AS min, {_r('any_value(q1)')} AS q1, {_r('any_value(q2)')} AS median,
  {_r('any_value(q3)')} AS q3, max({v}) AS max, min(CASE WHEN {inside} THEN {v} END) AS whisker_low,
  max(CASE WHEN {inside} THEN {v} END) AS whisker_high, count_if(NOT ({inside}))::BIGINT AS outliers
FROM {{{{readings}}}} CROSS JOIN (SELECT quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS q2,
  quantile_cont({v}, 0.75) AS q3 FROM {{{{readings}}}})"""


@query("a12_box_statistics", " UNION ALL ".join(_box_sql(c) for c in MEASURES))
def boxes(w):
    return _rounded(box_statistics(w.readings, MEASURES), 6, "q1", "median", "q3")


@query("a12_box_outliers", " UNION ALL ".join(
    f"""SELECT udi, '{c}' AS column_name, {c}::DOUBLE AS value FROM {{{{readings}}}} CROSS JOIN (
  SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM {{{{readings}}}})
WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)""" for c in MEASURES))
def outlier_points(w):
    return box_outliers(w.readings, MEASURES, ["udi"])


@query("a23_danger_zones", """
SELECT (floor(rotational_speed_rpm / 200) * 200)::INT AS speed_from,
  (floor(torque_nm / 5) * 5)::INT AS torque_from, count(*) AS readings,
  sum(greatest(hdf, pwf, osf))::BIGINT AS failures,
  round_even(avg(greatest(hdf, pwf, osf)) * 1000000, 0) / 1000000 AS failure_share
FROM {{readings}} GROUP BY ALL""")
def zones(w):
    return _rounded(danger_zones(w.readings), 6, "failure_share")


@query("st1_streamed_flags", """
SELECT udi, machine_id, machine_failure, """ + _r("process_temperature_k - air_temperature_k") + """
  AS temp_difference_k, CASE WHEN rotational_speed_rpm < q1 - 1.5 * (q3 - q1) OR rotational_speed_rpm > q3 + 1
    THEN 1 ELSE 0 END AS rotational_speed_rpm_outlier
FROM {{imputed}} CROSS JOIN (SELECT quantile_cont(rotational_speed_rpm::DOUBLE, 0.25) AS q1,
  quantile_cont(rotational_speed_rpm::DOUBLE, 0.75) AS q3 FROM {{imputed}})""")
def streamed_flags(w):
    cleaner = fit_telemetry_cleaner(w.telemetry_raw)
    events = w.table("events")
    scored = score_available(
        w.spark, f"{w.folder}/events.parquet*", events.schema,
        lambda rows: cleaner.apply(telemetry_extract(rows)).select(
            "udi", "machine_id", "machine_failure",
            round_half_even(F.col("temp_difference_k"), 6).alias("temp_difference_k"),
            "rotational_speed_rpm_outlier"))
    return scored


@query("st1_kept_queue", """
WITH r AS (SELECT 'M' || user_id AS machine_id, failure_probability, ts, event_id,
    CASE WHEN predicted_failure_flag = 1 THEN 'Failure' ELSE 'Normal operation' END AS status
  FROM events JOIN {{scored}} ON udi = event_id + 1),
latest AS (SELECT DISTINCT ON (machine_id) * FROM r WHERE machine_id IS NOT NULL ORDER BY machine_id, ts DESC, event_id DESC)
SELECT machine_id, failure_probability, status, event_id AS reading,
  (rank() OVER (ORDER BY failure_probability DESC))::BIGINT AS queue_rank
FROM latest WHERE status = 'Failure' OR failure_probability > 40""")
def kept_queue(w):
    """A queue kept by a stream of all readings, each user's events taken for one machine's."""
    event = F.col("event_id")
    wear, torque = ((event * 31) % 254).cast("int"), 28 + ((event * 7919) % 241).cast("double") / 10
    load = F.least(F.lit(1.0), wear * torque / 13000)
    readings = arriving_rows(w.spark, f"{w.folder}/events.parquet*", w.table("events").schema).select(
        F.concat(F.lit("M"), "user_id").alias("machine_id"), percent(load).alias("failure_probability"),
        F.when(load > 0.5, FAILURE).otherwise(NORMAL).alias("status"), F.col("ts").cast("timestamp").alias("seen"),
        event.alias("reading"))
    output = new_location(w.spark, "queue")
    start_queue(readings, output, new_location(w.spark, "queue-progress"), keep="36500 days", lateness="365 days").awaitTermination()
    return open_queue(w.spark, output).select("machine_id", "failure_probability", "status", "reading", "queue_rank")
