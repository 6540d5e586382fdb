"""The same results as SQL over the test tables, written on their own.

``WITH`` blocks that several queries need are named here and put together per query.
"""

from __future__ import annotations

BLOCKS = {
    "points": """
        SELECT event_id AS seq, event_type AS kind, user_id AS sensor,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS reading,
               CASE user_id % 3 WHEN 0 THEN 'JFK' WHEN 1 THEN 'LAX' ELSE 'ORD' END AS airport,
               date_trunc('second', ts) AS t,
               CAST(CASE user_id % 3 WHEN 0 THEN 40.6413 WHEN 1 THEN 33.9416 ELSE 41.9742 END AS DOUBLE)
                   AS latitude,
               CAST(CASE user_id % 3 WHEN 0 THEN -73.7781 WHEN 1 THEN -118.4085 ELSE -87.9073 END AS DOUBLE)
                   AS longitude,
               CAST(263.15 AS DOUBLE) + user_id % 40 AS temperature_k,
               value / CAST(10 AS DOUBLE) AS wind_u_ms,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) / 10 AS wind_v_ms,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) / 8000 AS precipitation_m,
               CAST(100000 AS DOUBLE) + user_id AS surface_pressure_pa,
               value * 20 AS cape_j_kg
        FROM events""",
    "records": """
        SELECT *, airport || '_' || strftime(t, '%Y-%m-%dT%H:%M:%S') AS event_id,
               temperature_k - CAST(273.15 AS DOUBLE) AS temperature_c,
               sqrt(wind_u_ms * wind_u_ms + wind_v_ms * wind_v_ms) AS wind_speed_ms,
               sqrt(wind_u_ms * wind_u_ms + wind_v_ms * wind_v_ms) * CAST(1.94384 AS DOUBLE) AS wind_speed_kts,
               precipitation_m * CAST(1000 AS DOUBLE) AS precipitation_mm
        FROM points""",
    "raw_weather": """
        SELECT CASE WHEN kind = 'error' AND reading < 10 THEN NULL ELSE event_id END AS event_id,
               airport, t, strftime(t, '%Y-%m-%d %H:%M:%S') AS timestamp_utc, latitude, longitude,
               temperature_k, temperature_c, wind_u_ms, wind_v_ms, wind_speed_ms, wind_speed_kts,
               precipitation_m, precipitation_mm, surface_pressure_pa, cape_j_kg,
               'weather.raw' AS _kafka_topic, CAST(sensor % 4 AS INTEGER) AS _kafka_partition,
               seq + c.nth * 1000000000000 AS _kafka_offset,
               strftime(t, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS _ingested_at_utc,
               CASE WHEN c.nth = 0
                    THEN 'part-' || lpad(CAST(seq // 10 AS VARCHAR), 8, '0') || '.jsonl'
                    ELSE 'part-replay.jsonl' END AS _source_object
        FROM records JOIN (VALUES (0), (1), (2)) c(nth) ON c.nth = 0 OR kind = 'error'""",
    "bronze": """
        SELECT event_id, airport, t AS timestamp_utc, CAST(t AS DATE) AS event_date, latitude, longitude,
               temperature_c, wind_speed_kts, precipitation_mm, surface_pressure_pa, cape_j_kg,
               _kafka_topic, _kafka_partition, _kafka_offset, _ingested_at_utc, _source_object
        FROM raw_weather
        WHERE event_id IS NOT NULL AND airport IS NOT NULL AND timestamp_utc IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY event_id
                                   ORDER BY _kafka_partition, _kafka_offset, _source_object) = 1""",
    "silver": """
        SELECT *, CAST(CASE WHEN wind_speed_kts > 25 OR precipitation_mm > 10 THEN 1 ELSE 0 END AS DOUBLE)
                      AS weather_rule_label,
               wind_speed_kts / 25 + precipitation_mm / 10 + cape_j_kg / 1000 AS risk_score_proxy
        FROM bronze""",
    "labeled": """
        SELECT *, weather_rule_label AS label, 'WEATHER_RULE' AS label_source FROM silver""",
    "gold": """
        SELECT event_id, airport, timestamp_utc, temperature_c, wind_speed_kts,
               max(wind_speed_kts) OVER w AS wind_speed_max_3h, avg(wind_speed_kts) OVER w AS wind_speed_avg_3h,
               precipitation_mm, sum(precipitation_mm) OVER w AS precipitation_sum_3h,
               surface_pressure_pa, cape_j_kg, avg(cape_j_kg) OVER w AS cape_avg_3h,
               CAST(hour(timestamp_utc) AS INTEGER) AS hour_of_day,
               CAST(dayofweek(timestamp_utc) + 1 AS INTEGER) AS day_of_week,
               CAST(month(timestamp_utc) AS INTEGER) AS month, label, label_source
        FROM labeled
        WINDOW w AS (PARTITION BY airport ORDER BY CAST(floor(epoch(timestamp_utc)) AS BIGINT), event_id
                     ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "sides": """
        SELECT *, CASE WHEN CAST('0x' || substr(md5(event_id), 1, 8) AS BIGINT) % 100 < 80
                       THEN 'train' ELSE 'test' END AS side
        FROM labeled""",
    "grid": """
        SELECT l_shipdate AS time, 33.0 + CAST(l_partkey % 40 AS DOUBLE) * 0.25 AS latitude,
               240.0 + CAST(l_orderkey % 64 AS DOUBLE) * 0.75 AS longitude,
               CAST(270 AS DOUBLE) + l_quantity / 10 AS t2m, l_discount * 100 AS u10, l_tax * 100 AS v10,
               l_quantity / 8000 AS tp, CAST(100000 AS DOUBLE) + l_linenumber AS sp,
               l_extendedprice / 100 AS cape
        FROM lineitem""",
    "stations": """
        SELECT code, lat, lon, CASE WHEN lon < 0 THEN lon + 360 ELSE lon END AS lon360
        FROM (VALUES ('JFK', CAST(40.6413 AS DOUBLE), CAST(-73.7781 AS DOUBLE)),
                     ('LAX', CAST(33.9416 AS DOUBLE), CAST(-118.4085 AS DOUBLE)),
                     ('ORD', CAST(41.9742 AS DOUBLE), CAST(-87.9073 AS DOUBLE))) s(code, lat, lon)""",
    "nearest": """
        SELECT code,
               (SELECT g.latitude FROM (SELECT DISTINCT latitude FROM grid) g
                ORDER BY abs(g.latitude - s.lat), g.latitude DESC LIMIT 1) AS latitude,
               (SELECT g.longitude FROM (SELECT DISTINCT longitude FROM grid) g
                ORDER BY abs(g.longitude - s.lon360), g.longitude DESC LIMIT 1) AS longitude
        FROM stations s""",
    "rule_runs": """
        SELECT run_name, label, CAST(CASE WHEN hit THEN 1 ELSE 0 END AS DOUBLE) AS prediction
        FROM labeled,
             LATERAL (VALUES ('wind_over_10', wind_speed_kts > 10), ('wind_over_15', wind_speed_kts > 15),
                             ('wind_over_20', wind_speed_kts > 20), ('wind_over_25', wind_speed_kts > 25),
                             ('wind_over_25_again', wind_speed_kts > 25), ('wind_over_30', wind_speed_kts > 30),
                             ('precipitation_over_10', precipitation_mm > 10),
                             ('score_over_2', risk_score_proxy > 2)) r(run_name, hit)""",
    "rule_counts": """
        SELECT run_name, sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp,
               sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS fp,
               sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS fn,
               sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS tn, count(*) AS n
        FROM rule_runs GROUP BY run_name""",
    "rule_metrics": """
        SELECT run_name, (tp + tn) / CAST(n AS DOUBLE) AS accuracy,
               (CASE WHEN tp = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END * (tp + fn)
                + CASE WHEN tn = 0 THEN 0 ELSE 2.0 * tn / (2 * tn + fp + fn) END * (tn + fp)) / n AS f1
        FROM rule_counts""",
}

#: Which blocks a block reads.
NEEDS = {
    "points": (),
    "records": ("points",),
    "raw_weather": ("records",),
    "bronze": ("raw_weather",),
    "silver": ("bronze",),
    "labeled": ("silver",),
    "gold": ("labeled",),
    "sides": ("labeled",),
    "grid": (),
    "stations": (),
    "nearest": ("grid", "stations"),
    "rule_runs": ("labeled",),
    "rule_counts": ("rule_runs",),
    "rule_metrics": ("rule_counts",),
}


def with_blocks(needed: tuple[str, ...], select: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS[name]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in needed:
        add(name)
    blocks = ",\n".join(f"{name} AS ({BLOCKS[name]})" for name in ordered)
    return f"WITH {blocks}\n{select}" if ordered else select


def rounded(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


_EVENT = ("latitude", "longitude", "temperature_k", "temperature_c", "wind_u_ms", "wind_v_ms",
          "wind_speed_ms", "wind_speed_kts", "precipitation_m", "precipitation_mm",
          "surface_pressure_pa", "cape_j_kg")
_BRONZE = ("latitude", "longitude", "temperature_c", "wind_speed_kts", "precipitation_mm",
           "surface_pressure_pa", "cape_j_kg")
_DELIVERY = "_kafka_topic, _kafka_partition, _kafka_offset, _ingested_at_utc"
_BRONZE_SELECT = (f"SELECT event_id, airport, timestamp_utc, event_date, {', '.join(_BRONZE)}, {_DELIVERY}, "
                  "_source_object FROM bronze")
_GOLD_SELECT = ("SELECT * REPLACE (round(wind_speed_avg_3h, 6) AS wind_speed_avg_3h, "
                "round(precipitation_sum_3h, 6) AS precipitation_sum_3h, round(cape_avg_3h, 6) AS cape_avg_3h) "
                "FROM gold")
_VALID = "event_id IS NOT NULL AND airport IS NOT NULL AND timestamp_utc IS NOT NULL"


def statements() -> dict[str, str]:
    sql = {
        # sources
        "grid_nearest_point": (("nearest",), "SELECT code, latitude, longitude FROM nearest"),
        "grid_extract": (("grid", "nearest"), f"""
            SELECT n.code AS airport, g.time, g.latitude, g.longitude,
                   g.t2m, g.u10, g.v10, g.tp, g.sp, g.cape
            FROM grid g JOIN nearest n ON g.latitude = n.latitude AND g.longitude = n.longitude
            WHERE g.time BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '2001-12-31'"""),
        "raw_scan": (("raw_weather",), f"""
            SELECT event_id, airport, timestamp_utc, {', '.join(_EVENT)}, {_DELIVERY} FROM raw_weather"""),
        "raw_manifest": (("records",), """
            SELECT DISTINCT 'airport=' || airport || '/year=' || strftime(t, '%Y')
                            || '/month=' || strftime(t, '%m') AS directory, true AS has_bytes
            FROM records"""),
        "read_fallback": (("bronze",), _BRONZE_SELECT),
        "kafka_decode": (("raw_weather",), f"""
            SELECT event_id, airport, timestamp_utc, {', '.join(_EVENT)}, _kafka_topic, _kafka_partition,
                   _kafka_offset
            FROM raw_weather"""),
        # sinks
        "bronze_roundtrip": (("bronze",), _BRONZE_SELECT),
        "sample_partitioned": (("records",), f"""
            SELECT event_id, airport, t AS timestamp_utc, {', '.join(_EVENT)},
                   CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month
            FROM records"""),
        "kafka_encode": (("raw_weather",), """
            SELECT coalesce(airport, 'UNKNOWN') AS key,
                   CASE WHEN event_id IS NULL THEN '{' ELSE '{"event_id":"' || event_id || '",' END
                   || '"airport":"' || airport || '","timestamp_utc":"' || timestamp_utc
                   || '","_kafka_offset":' || CAST(_kafka_offset AS VARCHAR) || '}' AS value
            FROM raw_weather"""),
        # projections and filters
        "unit_conversion": (("records",), f"""
            SELECT event_id, airport, t AS timestamp_utc, {', '.join(_EVENT)} FROM records"""),
        "event_id_key": (("records",), "SELECT event_id, airport, t AS timestamp_utc FROM records"),
        "raw_valid": (("raw_weather",), f"""
            SELECT event_id, airport, timestamp_utc, _kafka_offset, _source_object FROM raw_weather
            WHERE {_VALID}"""),
        "bronze_typed": (("raw_weather",), f"""
            SELECT event_id, airport, t AS timestamp_utc, CAST(t AS DATE) AS event_date,
                   {', '.join(_BRONZE)}, {_DELIVERY}, _source_object
            FROM raw_weather"""),
        "flatten_nested": (("raw_weather",), """
            SELECT event_id, '{"airport":"' || airport || '","offset":' || CAST(_kafka_offset AS VARCHAR) || '}'
                       AS origin,
                   '["' || _kafka_topic || '","' || _source_object || '"]' AS tags,
                   '{"' || airport || '":' || CAST(_kafka_partition AS VARCHAR) || '}' AS partitions,
                   timestamp_utc
            FROM raw_weather"""),
        "required_columns": (("raw_weather",), " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, true AS present, count({c}) AS filled_rows FROM raw_weather"
            for c in ("event_id", "airport", "timestamp_utc", "temperature_c", "wind_speed_kts",
                      "precipitation_mm", "surface_pressure_pa", "cape_j_kg", "_kafka_topic",
                      "_kafka_partition", "_kafka_offset", "_ingested_at_utc"))
            + " UNION ALL SELECT 'wind_gust_kts', false, CAST(0 AS BIGINT)"),
        "peek_latest": (("bronze",), """
            SELECT event_id, airport, timestamp_utc, wind_speed_kts FROM bronze
            ORDER BY timestamp_utc DESC, event_id LIMIT 10"""),
        # aggregates
        "smoke_avg": (("raw_weather",), """
            SELECT round(avg(wind_speed_kts), 6) AS avg_wind_speed_kts FROM raw_weather"""),
        "raw_by_airport": (("raw_weather",), f"""
            SELECT airport, count(*) AS row_count FROM raw_weather WHERE {_VALID} GROUP BY airport"""),
        "raw_time_bounds": (("raw_weather",), f"""
            SELECT min(timestamp_utc) AS min_timestamp, max(timestamp_utc) AS max_timestamp,
                   count(*) AS row_count
            FROM raw_weather WHERE {_VALID}"""),
        "storage_summary": (("raw_weather",), """
            SELECT count(*) AS total_rows, count(DISTINCT airport) AS unique_airports,
                   (SELECT string_agg(airport, ', ' ORDER BY airport)
                    FROM (SELECT DISTINCT airport FROM raw_weather)) AS airport_list,
                   min(timestamp_utc) AS min_timestamp, max(timestamp_utc) AS max_timestamp,
                   min(_kafka_offset) AS min_kafka_offset, max(_kafka_offset) AS max_kafka_offset,
                   count(DISTINCT _source_object) AS stored_objects
            FROM raw_weather"""),
        "flush_parts": (("raw_weather",), """
            SELECT _source_object, count(*) AS row_count FROM raw_weather GROUP BY _source_object"""),
        "bronze_dedup": (("raw_weather",), """
            SELECT event_id, _kafka_partition, _kafka_offset, _source_object FROM raw_weather
            WHERE event_id IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY event_id
                                       ORDER BY _kafka_partition, _kafka_offset, _source_object) = 1"""),
        "bronze_table": (("bronze",), _BRONZE_SELECT),
        "silver_rule_label": (("silver",), "SELECT event_id, weather_rule_label FROM silver"),
        "silver_risk_score": (("silver",),
                              "SELECT event_id, risk_score_proxy FROM silver"),
        "class_count": (("labeled",), "SELECT count(DISTINCT label) AS class_count FROM labeled"),
        "quantile_threshold": (("silver",), """
            SELECT quantile_disc(risk_score_proxy, 0.75) AS threshold FROM silver"""),
        "silver_labeled": (("labeled",), """
            SELECT event_id, airport, timestamp_utc, weather_rule_label,
                   risk_score_proxy, label, label_source
            FROM labeled"""),
        "silver_fallback": (("silver",), """
            SELECT event_id, CAST(0 AS DOUBLE) AS weather_rule_label,
                   CAST(CASE WHEN risk_score_proxy >= (SELECT quantile_disc(risk_score_proxy, 0.75) FROM silver)
                             THEN 1 ELSE 0 END AS DOUBLE) AS label,
                   'PR2_QUANTILE_FALLBACK' AS label_source
            FROM silver"""),
        "label_distribution": (("labeled",), "SELECT label, count(*) AS row_count FROM labeled GROUP BY label"),
        "label_source_distribution": (("labeled",), """
            SELECT label, label_source, count(*) AS row_count FROM labeled GROUP BY label, label_source"""),
        # gold
        "gold_calendar": (("gold",), "SELECT event_id, hour_of_day, day_of_week, month FROM gold"),
        "gold_rolling": (("gold",), f"""
            SELECT event_id, wind_speed_max_3h,
                   {rounded('wind_speed_avg_3h', 'precipitation_sum_3h', 'cape_avg_3h')} FROM gold"""),
        "gold_dropna": (("labeled",), f"""
            SELECT event_id, cape_j_kg, {rounded('wind_speed_avg_3h', 'cape_avg_3h')}
            FROM (SELECT event_id, gappy AS cape_j_kg, avg(wind_speed_kts) OVER w AS wind_speed_avg_3h,
                         avg(gappy) OVER w AS cape_avg_3h
                  FROM (SELECT *, CASE WHEN precipitation_mm < 1 THEN NULL ELSE cape_j_kg END AS gappy
                        FROM labeled)
                  WINDOW w AS (PARTITION BY airport
                               ORDER BY CAST(floor(epoch(timestamp_utc)) AS BIGINT), event_id
                               ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
            WHERE cape_j_kg IS NOT NULL"""),
        "gold_training_features": (("gold",), _GOLD_SELECT),
        # model rows, metrics, runs
        "feature_vector": (("gold",), f"""
            SELECT event_id, temperature_c, wind_speed_max_3h, {rounded('cape_avg_3h')},
                   CAST(month AS DOUBLE) AS month, CAST(12 AS INTEGER) AS vector_size, label
            FROM gold"""),
        "train_test_split": (("sides",), "SELECT event_id, side FROM sides"),
        "split_fallback": (("labeled",), """
            SELECT side, count(*) AS row_count
            FROM (SELECT 'train' AS side FROM labeled UNION ALL SELECT 'test' FROM labeled) GROUP BY side"""),
        "metrics_accuracy_f1": (("rule_metrics",), """
            SELECT round(accuracy, 6) AS accuracy, round(f1, 6) AS f1 FROM rule_metrics
            WHERE run_name = 'wind_over_20'"""),
        "metrics_auc": (("labeled",), """
            SELECT round((sum(CASE WHEN label = 1 THEN r ELSE 0 END) - p * (p + 1) / 2) / (p * q), 6) AS auc
            FROM (SELECT label, sum(label) OVER () AS p, sum(1 - label) OVER () AS q,
                         rank() OVER (ORDER BY risk_score_proxy)
                         + (count(*) OVER (PARTITION BY risk_score_proxy) - 1) / 2.0 AS r
                  FROM labeled)
            GROUP BY p, q"""),
        "best_run": (("rule_metrics",), """
            SELECT run_name, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1 FROM rule_metrics
            ORDER BY rule_metrics.f1 DESC, rule_metrics.accuracy DESC, run_name LIMIT 1"""),
        "top_runs": (("rule_metrics",), """
            SELECT run_name, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1 FROM rule_metrics
            ORDER BY rule_metrics.f1 DESC, run_name LIMIT 5"""),
        # the same operators over other tables
        "rolling_by_supplier": ((), """
            SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_partkey, l_quantity,
                   max(l_quantity) OVER w AS quantity_max, round(avg(l_quantity) OVER w, 6) AS quantity_avg,
                   round(sum(l_extendedprice) OVER w, 6) AS price_sum
            FROM lineitem
            WINDOW w AS (PARTITION BY l_suppkey
                         ORDER BY CAST(floor(epoch(l_shipdate)) AS BIGINT), l_orderkey, l_linenumber, l_partkey,
                                  l_quantity, l_extendedprice
                         ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""),
        "price_quantile": ((), """
            SELECT quantile_disc(l_extendedprice, 0.75) AS threshold FROM lineitem"""),
    }
    sql["model_roundtrip"] = (("gold",), "SELECT true AS same, count(*) AS row_count FROM gold")
    sql["stream_score"] = (("gold",), "SELECT event_id, airport, timestamp_utc, true AS same FROM gold")
    sql["runs_table"] = (("sides",), """
        SELECT run_name, count(*) FILTER (WHERE side = 'train') AS train_rows,
               count(*) FILTER (WHERE side = 'test') AS test_rows, true AS has_f1, true AS has_auc
        FROM sides, (VALUES ('rf_trees_5_depth_3'), ('logistic_regression_baseline')) r(run_name)
        GROUP BY run_name""")
    for name in ("rf_by_tables", "lr_by_tables"):
        sql[name] = (("gold", "sides"), """
        SELECT side, count(*) AS row_count, count(*) AS same_prediction, count(*) AS same_score
        FROM gold JOIN sides USING (event_id) GROUP BY side""")
    sql["grid_extract_tiled"] = sql["grid_extract"]
    sql["raw_write"] = sql["raw_scan"]
    sql["gold_rolling_sliced"] = sql["gold_rolling"]
    sql["rolling_by_supplier_sliced"] = sql["rolling_by_supplier"]
    sql["stream_raw_to_bronze"] = (("bronze",), f"""
        SELECT event_id, airport, timestamp_utc, event_date, {', '.join(_BRONZE)} FROM bronze""")
    sql["raw_lineage"] = (("raw_weather",), """
        SELECT left(_ingested_at_utc, 10) AS day, count(*) AS row_count, count(*) AS same_day FROM raw_weather GROUP BY day""")
    sql["raw_last_objects"] = (("raw_weather",), """
        SELECT DISTINCT left(_ingested_at_utc, 10) AS day, true AS has_bytes FROM raw_weather ORDER BY day DESC LIMIT 10""")
    sql["kafka_default_key"] = (("raw_weather",), """
        SELECT CASE airport WHEN 'LAX' THEN 'UNKNOWN' ELSE airport END AS key, count(*) AS row_count,
          min(_kafka_offset) AS first_offset
        FROM raw_weather GROUP BY key""")
    sql["stream_numbered_parts"] = (("raw_weather",), """
        SELECT airport, count(*) AS row_count, 1::BIGINT AS stations_of_part, (SELECT count(DISTINCT airport) FROM raw_weather) AS numbers
        FROM raw_weather GROUP BY airport""")
    sql["stream_stops"] = (("raw_weather",), """
        SELECT count(*) AS row_count, count(DISTINCT _kafka_offset) AS offset_count, true AS stopped_with_rows FROM raw_weather""")
    sql["stream_bronze_merged"] = (("bronze",), "SELECT event_id, airport, timestamp_utc, event_date FROM bronze")
    sql["stream_score_versions"] = (("gold",), """
        SELECT version::BIGINT AS version, count(*) AS row_count, count(DISTINCT event_id) AS event_count, count(*) AS same_score
        FROM gold, (VALUES (1), (2)) v(version) GROUP BY version""")
    sql["stream_dual_sink"] = (("raw_weather",), """
        SELECT store, count(*) AS row_count, count(event_id) AS with_id, min(timestamp_utc) AS min_timestamp
        FROM raw_weather, (VALUES ('raw'), ('table')) s(store) GROUP BY store""")
    sql["raw_whole_record"] = (("raw_weather",), """
        SELECT event_id, _kafka_offset, CAST(_kafka_offset AS VARCHAR) AS gust, airport AS origin_airport,
               2::INTEGER AS unknown_fields
        FROM raw_weather""")
    sql["kafka_new_fields"] = (("raw_weather",), """
        SELECT field_name, field_type, count(*) AS record_count, min(spot).p AS first_partition, min(spot).o AS first_offset,
          max(spot).p AS last_partition, max(spot).o AS last_offset
        FROM (
          SELECT CASE airport WHEN 'ORD' THEN 'origin' ELSE 'gust' END AS field_name,
            CASE airport WHEN 'JFK' THEN 'BIGINT' WHEN 'LAX' THEN 'STRING' ELSE 'OBJECT<sensor: ARRAY<BIGINT>>' END AS field_type,
            {'p': _kafka_partition, 'o': _kafka_offset} AS spot
          FROM raw_weather)
        GROUP BY field_name, field_type""")
    sql["stream_raw_restart"] = (("raw_weather",), """
        SELECT store, event_id, _kafka_offset FROM raw_weather, (VALUES ('raw'), ('table')) s(store)""")
    return {name: with_blocks(needed, select) for name, (needed, select) in sql.items()}
