"""DuckDB SQL twins of the driver-contract queries (same column names and types).

Landed files are keyed by (event type, UTC day, event_id div 2000), as in
``queries.landing_frame``."""

from __future__ import annotations

_FILE_KEY = "CAST(CAST(ts AS DATE) AS VARCHAR) || ':' || CAST(event_id // 2000 AS VARCHAR)"
_COLL = "'events_' || event_type"
# files a batch: the tier's cap
_CAP = "CASE WHEN event_type = 'purchase' THEN 500 ELSE 3000 END"

ORACLE_SQL = {
    "raw_rows_by_collection": f"""
        SELECT {_COLL} AS collection, count(*) AS n FROM events GROUP BY 1""",

    "drain_outcomes": f"""
        SELECT {_COLL} AS collection, 'ok' AS status,
               CAST(ceil(count(DISTINCT {_FILE_KEY}) /
                    CASE WHEN event_type = 'purchase' THEN 500 ELSE 3000 END) AS BIGINT) AS batches,
               count(DISTINCT {_FILE_KEY}) AS files
        FROM events GROUP BY event_type""",

    "drain_outcome_counts": """
        SELECT count(DISTINCT event_type) AS ok, CAST(0 AS BIGINT) AS failed FROM events""",

    "raw_content": f"""
        SELECT {_COLL} AS collection, event_id, user_id, epoch_us(ts) AS ts_us, value, props,
               min(epoch_us(ts) // 1000) OVER (PARTITION BY event_type, CAST(ts AS DATE), event_id // 2000)
                 AS file_epoch_ms
        FROM events""",

    "csv_header_drift": f"""
        SELECT {_COLL} AS collection, event_id, user_id, epoch_us(ts) AS ts_us, value, props
        FROM events""",

    "evolved_columns": f"""
        SELECT {_COLL} AS collection, event_id, value, CASE WHEN day(ts) > 15 THEN props END AS props
        FROM events""",

    "frozen_schema_rescue": f"""
        SELECT {_COLL} AS collection, event_id,
               CASE WHEN day(ts) > 15 THEN '{{"props":' || CAST(to_json(props) AS VARCHAR) || '}}' END
                 AS _rescued_data
        FROM events""",

    "rescued_values": f"""
        SELECT {_COLL} AS collection, event_id,
               CASE WHEN day(ts) % 2 = 1 THEN value END AS value,
               CASE WHEN day(ts) % 2 = 0
                    THEN '{{"value":"n/a:' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || '"}}'
               END AS _rescued_data
        FROM events""",

    "late_files": f"""
        SELECT {_COLL} AS collection, event_id, epoch_us(ts) AS ts_us,
               CASE WHEN day(ts) <= 5 THEN CAST(user_id AS BIGINT) + 1 END AS batch_id
        FROM events""",

    "rescued_type_pairs": f"""
        SELECT {_COLL} AS collection, event_id,
               CASE WHEN day(ts) % 2 = 1 THEN epoch_us(ts)
                    WHEN event_type = 'error' THEN CAST(value > 50 AS BIGINT) END AS ts_us,
               CASE WHEN day(ts) % 2 = 0 THEN
                 CASE WHEN event_type IN ('click', 'view') THEN '{{"ts_us":"' || CAST(CAST(ts AS DATE) AS VARCHAR) || '"}}'
                      WHEN event_type = 'purchase'
                      THEN '{{"ts_us":"' || base64(encode(CAST(event_id AS VARCHAR))) || '"}}'
                      WHEN event_type = 'signup'
                      THEN '{{"ts_us":"at ' || CAST(epoch_us(ts) AS VARCHAR) || '"}}' END END AS _rescued_data
        FROM events""",

    "ingest_batches": f"""
        SELECT {_COLL} AS collection,
               CAST(ceil(count(DISTINCT CASE WHEN day(ts) % 2 = 1 THEN {_FILE_KEY} END) / {_CAP}) +
                    ceil(count(DISTINCT CASE WHEN day(ts) % 2 = 0 THEN {_FILE_KEY} END) / {_CAP}) AS BIGINT) AS batches,
               count(*) AS rows, count_if(day(ts) % 2 = 0)::BIGINT AS rescued_rows, CAST(0 AS BIGINT) AS malformed_lines
        FROM events GROUP BY event_type""",

    "drain_wave_log": f"""
        SELECT CAST(1 AS INTEGER) AS wave, {_COLL} AS collection, 'ok' AS status, 'ok' AS kind,
               CAST(ceil(count(DISTINCT {_FILE_KEY}) / {_CAP}) AS BIGINT) AS batches,
               count(DISTINCT {_FILE_KEY}) AS files, count(*) AS rows
        FROM events GROUP BY event_type
        UNION ALL SELECT DISTINCT 2, {_COLL}, 'ok', 'ok', 0, 0, 0 FROM events""",

    "compacted_content": f"""
        WITH b AS (SELECT event_type,
                 CAST(ceil(count(DISTINCT CASE WHEN day(ts) > 10 THEN {_FILE_KEY} END) / {_CAP}) +
                      ceil(count(DISTINCT CASE WHEN day(ts) <= 10 THEN {_FILE_KEY} END) / {_CAP}) AS BIGINT) AS batches
          FROM events GROUP BY event_type)
        SELECT {_COLL} AS collection, event_id, epoch_us(ts) AS ts_us, value, batches, CAST(1 AS BIGINT) AS folders
        FROM events JOIN b USING (event_type)""",

    "hostile_tree": f"""
        SELECT {_COLL} AS collection, CASE WHEN event_type = 'purchase' THEN 'events_purchase' ELSE 'events' END AS owner,
               CASE WHEN event_type IN ('signup', 'view') THEN 'csv' ELSE 'parquet' END AS drained_as,
               CASE WHEN event_type IN ('signup', 'view') THEN 'csv' ELSE 'parquet' END AS listed_as,
               count(DISTINCT {_FILE_KEY}) + CAST(event_type = 'view' AS BIGINT) AS file_count,
               CASE WHEN event_type = 'click' THEN count(DISTINCT CASE WHEN user_id % 2 = 0 THEN CAST(ts AS DATE) END)
                    ELSE 0 END AS mixed_dirs,
               count(*) AS rows
        FROM events GROUP BY event_type
        UNION ALL SELECT 'events_viewers', 'events', 'parquet', 'parquet', count(DISTINCT {_FILE_KEY}), 0, count(*)
        FROM events WHERE event_type = 'view'
        UNION ALL SELECT 'events_notes', 'events', NULL, NULL, 0, 0, 0""",

    "resolution_split": """
        WITH c AS (SELECT DISTINCT event_type AS t FROM events)
        SELECT count(*) + 1 AS selected, count_if(t IN ('purchase', 'view'))::BIGINT AS parents,
               count_if(t NOT IN ('purchase', 'view'))::BIGINT + 1 AS children, count(*) AS present,
               CAST(1 AS BIGINT) AS skipped, count_if(t NOT IN ('signup', 'error'))::BIGINT AS parquet,
               count_if(t IN ('signup', 'error'))::BIGINT AS csv FROM c""",

    "measured_times": f"""
        SELECT DISTINCT {_COLL} AS collection, true AS total_is_sum, true AS drained, true AS same_time,
               true AS run_token FROM events""",

    "lineage": f"""
        SELECT event_id, printf('%013d_%s_%02d_%02d.%s',
                 min(epoch_us(ts) // 1000) OVER (PARTITION BY event_type, CAST(ts AS DATE), event_id // 2000),
                 {_COLL}, day(ts), event_id // 2000, CASE WHEN event_type = 'signup' THEN 'csv' ELSE 'parquet' END) AS file_name,
               true AS recent
        FROM events""",

    "priority_and_shard": f"""
        WITH c AS (SELECT DISTINCT {_COLL} AS collection, event_type FROM events)
        SELECT 'all' AS view, collection,
               CASE WHEN event_type IN ('purchase', 'view') THEN collection ELSE 'events' END AS owner,
               CASE event_type WHEN 'purchase' THEN 'medium' WHEN 'view' THEN 'low' ELSE 'high' END AS tier FROM c
        UNION ALL SELECT 'high', collection, 'events', 'high' FROM c
        UNION ALL SELECT 'low', collection, collection, 'low' FROM c WHERE event_type = 'view'
        UNION ALL SELECT 'shard', collection, collection, 'medium' FROM c WHERE event_type = 'purchase'""",

    "measured_fallback": """
        SELECT p AS collection, 'NO_FILES' AS status, CAST(0 AS BIGINT) AS file_count, CAST(0 AS BIGINT) AS micro_batches,
               CAST(0 AS BIGINT) AS rows_seen, CAST(0 AS DOUBLE) AS total_drain_wall_seconds, '[]' AS batch_details_json
        FROM (VALUES ('orders'), ('refunds')) t(p)
        WHERE NOT EXISTS (SELECT 1 FROM events WHERE starts_with('events_' || event_type, p || '_'))""",

    "listing_tree": f"""
        WITH t AS (SELECT count(DISTINCT year(ts)) AS y, count(DISTINCT strftime(ts, '%Y-%m')) AS m,
                          count(DISTINCT CAST(ts AS DATE)) AS d FROM events)
        SELECT {_COLL} AS collection, max(y) AS year_dirs_walked, max(m) AS month_dirs_walked, max(d) AS day_dirs_walked,
               CAST(3 AS BIGINT) AS partition_tree_depth, count(*) AS rows, true AS bytes_match
        FROM events, t GROUP BY 1""",

    "results_append": f"""
        SELECT {_COLL} AS collection, 'LISTED' AS status, CAST(2 AS BIGINT) AS runs,
               CAST(2 * count(DISTINCT {_FILE_KEY}) AS BIGINT) AS files
        FROM events GROUP BY event_type""",

    "steady_state_increment": f"""
        SELECT {_COLL} AS collection, count(*) AS rows_seen
        FROM events WHERE day(ts) > 15 GROUP BY 1""",

    "rate_limited_batches": f"""
        SELECT collection, files AS file_count, CAST(ceil(files / 7) AS BIGINT) AS micro_batches,
               n AS rows_seen
        FROM (SELECT {_COLL} AS collection, count(DISTINCT {_FILE_KEY}) AS files, count(*) AS n
              FROM events GROUP BY 1)""",

    "batch_rows_json": f"""
        WITH f AS (SELECT {_COLL} AS collection, CAST(ts AS DATE) AS d, event_id // 2000 AS b,
                          count(*) AS n
                   FROM events GROUP BY 1, 2, 3),
             r AS (SELECT collection, n,
                          (row_number() OVER (PARTITION BY collection ORDER BY d, b) - 1) // 7 AS batch_id
                   FROM f),
             g AS (SELECT collection, CAST(batch_id AS BIGINT) AS batch_id, CAST(sum(n) AS BIGINT) AS rows
                   FROM r GROUP BY 1, 2)
        SELECT collection, count(*) AS micro_batches, CAST(sum(rows) AS BIGINT) AS rows_seen,
               CAST(to_json(list({{'batch_id': batch_id, 'rows': rows}} ORDER BY batch_id)) AS VARCHAR)
                 AS batch_rows_json
        FROM g GROUP BY collection""",

    "listing_stats": f"""
        SELECT {_COLL} AS collection,
               CASE WHEN event_type = 'signup' THEN 'csv' ELSE 'parquet' END AS format,
               count(DISTINCT {_FILE_KEY}) AS file_count,
               count(DISTINCT CAST(ts AS DATE)) AS collection_dirs_checked,
               'LISTED' AS status
        FROM events GROUP BY event_type""",

    "run_summary": f"""
        WITH c AS (SELECT {_COLL} AS collection, count(DISTINCT {_FILE_KEY}) AS files
                   FROM events GROUP BY 1)
        SELECT count(*) FILTER (WHERE collection = 'events_purchase') AS parents_present,
               count(*) FILTER (WHERE collection <> 'events_purchase') AS children_discovered,
               count(*) AS collections_measured,
               CAST(0 AS BIGINT) AS errored_collections,
               CAST(sum(files) AS BIGINT) AS visible_files
        FROM c""",

    "results_cast": f"""
        SELECT {_COLL} AS collection, 'OK' AS listing_status, 'LISTED' AS status,
               count(DISTINCT {_FILE_KEY}) AS file_count, CAST(NULL AS DOUBLE) AS drain_seconds
        FROM events GROUP BY event_type""",

    "format_detection": f"""
        SELECT {_COLL} AS collection,
               CASE WHEN event_type = 'signup' THEN 'csv' ELSE 'parquet' END AS format,
               CAST(CASE WHEN event_type = 'view'
                         THEN count(DISTINCT CAST(ts AS DATE)) FILTER (WHERE day(ts) <= 3)
                         ELSE 0 END AS BIGINT) AS mixed_dirs
        FROM events GROUP BY event_type""",

    "resolve_collections": f"""
        SELECT {_COLL} AS collection, {_COLL} AS name,
               CASE WHEN event_type = 'purchase' THEN 'events_purchase' ELSE 'events' END AS owner,
               CASE WHEN event_type = 'purchase' THEN 'medium' ELSE 'high' END AS tier,
               CASE WHEN event_type = 'signup' THEN 'csv' ELSE 'parquet' END AS format,
               event_type = 'purchase' AS is_parent,
               CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS INTEGER) AS shard_index,
               CAST(CASE WHEN event_type = 'purchase' THEN 500 ELSE 3000 END AS INTEGER) AS max_files,
               CAST(90 AS INTEGER) AS interval_seconds
        FROM (SELECT DISTINCT event_type FROM events)""",

    "backlog_anti": f"""
        SELECT {_COLL} AS collection, count(DISTINCT {_FILE_KEY}) AS backlog_files
        FROM events WHERE day(ts) > 15 GROUP BY 1""",

    "file_epoch": r"""
        SELECT o_orderkey, path,
               TRY_CAST(nullif(regexp_extract(path, '/(\d{13})_', 1), '') AS BIGINT) AS file_epoch_ms
        FROM (SELECT o_orderkey,
                     CASE o_orderkey % 3
                       WHEN 0 THEN printf('/landing/collection=orders/%013d_orders_%s.parquet',
                                          epoch_ms(o_orderdate), o_orderstatus)
                       WHEN 1 THEN printf('/landing/collection=orders/%d_orders.parquet',
                                          epoch_ms(o_orderdate))
                       ELSE printf('/landing/%013d_day/part-%d.parquet', epoch_ms(o_orderdate), o_orderkey)
                     END AS path
              FROM orders)""",

    "landing_names": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
               strftime(o_orderdate, '%d') AS day_of_month, epoch_ms(date_trunc('day', o_orderdate)::TIMESTAMP) AS midnight_ms,
               printf('%013d_%s_%02d_%02d.%s', epoch_ms(date_trunc('day', o_orderdate)::TIMESTAMP), lower(o_orderstatus),
                      dayofyear(o_orderdate), o_orderkey % 120,
                      CASE WHEN o_totalprice > 100000 THEN 'csv' ELSE 'parquet' END) AS file_name
        FROM orders""",

    "error_texts": """
        SELECT doc_id, substr(concat_ws(' | ', source, text, CASE WHEN lang <> 'en' THEN lang END), 1, 2000) AS joined,
               regexp_replace(coalesce(CASE WHEN doc_id % 2 = 0 THEN text END, '') || '; ' || source, '^[; ]+', '')
                 AS appended
        FROM documents""",

    "longest_prefix_owner": """
        WITH n AS (SELECT p_partkey, lower(p_type) || '_' || replace(lower(p_brand), 'brand#', 'b')
                          || '_' || CAST(p_size AS VARCHAR) AS name FROM part),
             par AS (SELECT DISTINCT lower(p_type) AS p FROM part WHERE p_type <> 'PROMO'
                     UNION SELECT DISTINCT lower(p_type) || '_b1' FROM part)
        SELECT n.p_partkey, n.name, arg_max(par.p, length(par.p)) AS owner
        FROM n LEFT JOIN par ON n.name = par.p OR starts_with(n.name, par.p || '_')
        GROUP BY n.p_partkey, n.name""",

    "tier_lookup": """
        WITH n AS (SELECT p_partkey, lower(p_type) || '_' || replace(lower(p_brand), 'brand#', 'b')
                          || '_' || CAST(p_size AS VARCHAR) AS name FROM part),
             par AS (SELECT DISTINCT lower(p_type) AS p, 'low' AS tier FROM part WHERE p_type <> 'PROMO'
                     UNION SELECT DISTINCT lower(p_type) || '_b1', 'high' FROM part),
             o AS (SELECT n.p_partkey, arg_max(par.p, length(par.p)) AS owner,
                          arg_max(par.tier, length(par.p)) AS tier
                   FROM n LEFT JOIN par ON n.name = par.p OR starts_with(n.name, par.p || '_')
                   GROUP BY n.p_partkey),
             t AS (SELECT * FROM (VALUES ('high', 3000, 90), ('medium', 500, 90), ('low', 100, 90))
                   AS t(tier, max_files, interval_seconds))
        SELECT o.p_partkey, o.owner, o.tier, CAST(t.max_files AS INTEGER) AS max_files,
               CAST(t.interval_seconds AS INTEGER) AS interval_seconds
        FROM o LEFT JOIN t ON o.tier = t.tier""",

    "shard_membership": """
        WITH c AS (SELECT c_custkey, lower(n_name) AS owner
                   FROM customer JOIN nation ON c_nationkey = n_nationkey),
             r AS (SELECT owner, CAST((row_number() OVER (ORDER BY owner) - 1) % 3 AS INTEGER) AS shard_index
                   FROM (SELECT DISTINCT owner FROM c))
        SELECT c.c_custkey, c.owner, r.shard_index FROM c JOIN r USING (owner)""",

    "topic_conflicts": """
        WITH t AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'shop.' || source ELSE source END AS topic,
                          CASE lang WHEN 'en' THEN 'high' WHEN 'de' THEN 'medium' ELSE 'low' END AS tier
                   FROM documents),
             c AS (SELECT CASE WHEN strpos(topic, '.') > 0 THEN substr(topic, strpos(topic, '.') + 1)
                               ELSE topic END AS collection, tier FROM t)
        SELECT collection, array_to_string(list_sort(list_distinct(list(tier))), ',') AS tiers,
               CAST(count(DISTINCT tier) AS INTEGER) AS n_tiers
        FROM c GROUP BY collection HAVING count(DISTINCT tier) > 1""",

    "failed_outcomes": """
        SELECT 'events_' || event_type AS collection,
               CASE event_type WHEN 'error' THEN 'failed' ELSE 'ok' END AS status,
               CASE event_type WHEN 'error' THEN 'genuine' ELSE 'ok' END AS kind,
               CASE WHEN event_type <> 'error' THEN count(*) END AS rows,
               (SELECT count(DISTINCT event_type) FROM events WHERE event_type <> 'error') AS ok,
               CAST(1 AS BIGINT) AS failed, 'events_error' AS failed_names, true AS stops_the_job
        FROM events GROUP BY event_type""",

    "topic_dedupe": """
        WITH t AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'shop.' || source ELSE source END AS topic,
                          CASE lang WHEN 'en' THEN 'high' WHEN 'de' THEN 'medium' ELSE 'low' END AS tier,
                          CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 ELSE 2 END AS tier_rank,
                          doc_id AS position
                   FROM documents),
             c AS (SELECT *, CASE WHEN strpos(topic, '.') > 0 THEN substr(topic, strpos(topic, '.') + 1)
                                  ELSE topic END AS collection FROM t)
        SELECT collection, topic, tier, position FROM (
          SELECT *, row_number() OVER (PARTITION BY collection ORDER BY tier_rank, position) AS rn FROM c)
        WHERE rn = 1""",

    "name_normalise": """
        SELECT page_id, collection, translate(collection, '-.', '__') AS table_name,
               regexp_replace(collection, '[^A-Za-z0-9_]', '_', 'g') AS safe_name,
               regexp_replace('  ' || url || chr(9), '^\\s+|\\s+$', '', 'g') AS trimmed
        FROM (SELECT page_id, url,
                     CASE WHEN strpos(url, '.') > 0 THEN substr(url, strpos(url, '.') + 1) ELSE url END
                       AS collection
              FROM pages)""",

    "makespan": """
        WITH RECURSIVE d AS (
            SELECT o_orderpriority, date_trunc('month', o_orderdate) AS m,
                   CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) / CAST(100.0 AS DOUBLE)
                     AS duration
            FROM orders GROUP BY 1, 2),
        r AS (SELECT o_orderpriority, duration,
                     row_number() OVER (PARTITION BY o_orderpriority ORDER BY duration DESC) AS i,
                     count(*) OVER (PARTITION BY o_orderpriority) AS n
              FROM d),
        w AS (SELECT unnest([4, 6, 8, 12, 16]) AS max_workers),
        s AS (
            SELECT g.o_orderpriority, w.max_workers, 0 AS i,
                   list_transform(range(w.max_workers), lambda x: CAST(0.0 AS DOUBLE)) AS slots
            FROM (SELECT DISTINCT o_orderpriority FROM r) g, w
            UNION ALL
            SELECT s.o_orderpriority, s.max_workers, s.i + 1,
                   list_transform(s.slots, lambda v, j: CASE WHEN j = list_position(s.slots, list_min(s.slots))
                                                           THEN v + r.duration ELSE v END)
            FROM s JOIN r ON r.o_orderpriority = s.o_orderpriority AND r.i = s.i + 1)
        SELECT s.o_orderpriority, CAST(s.max_workers AS INTEGER) AS max_workers,
               CAST(CASE WHEN c.n = 0 THEN 0 ELSE ceil(c.n / s.max_workers) END AS INTEGER)
                 AS simple_ceil_collection_rounds,
               list_max(s.slots) AS lpt_projected_full_drain_seconds
        FROM s JOIN (SELECT o_orderpriority, max(n) AS n FROM r GROUP BY 1) c
             ON c.o_orderpriority = s.o_orderpriority
        WHERE s.i = c.n""",

    "ceil_rounds": """
        WITH g AS (SELECT n_name, count(*) AS collections
                   FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name),
             w AS (SELECT unnest([4, 6, 8, 12, 16]) AS max_workers)
        SELECT n_name, CAST(max_workers AS INTEGER) AS max_workers, collections,
               CAST(ceil(collections / max_workers) AS INTEGER) AS simple_ceil_collection_rounds
        FROM g, w""",

    "restart_verdict": """
        WITH a AS (
            SELECT 'stream_' || CAST(user_id AS VARCHAR) AS collection, event_id AS attempt,
                   CASE WHEN event_type = 'purchase' AND value >= 250 THEN 'ok'
                        WHEN event_type IN ('error', 'view') THEN 'genuine'
                        ELSE 'schema_evolution' END AS kind,
                   value AS ran_seconds
            FROM events),
        b AS (SELECT *, CASE WHEN kind NOT IN ('ok', 'schema_evolution') THEN 1 ELSE 0 END AS g,
                        CASE WHEN kind = 'schema_evolution' THEN 1 ELSE 0 END AS sc,
                        kind <> 'ok' AND ran_seconds >= 300 AS reset
              FROM a),
        c AS (SELECT *, sum(g) OVER w AS cg, sum(sc) OVER w AS cs FROM b
              WINDOW w AS (PARTITION BY collection ORDER BY attempt
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        e AS (SELECT *, cg - coalesce(max(CASE WHEN reset THEN cg - g END) OVER w, 0) AS gc,
                        cs - coalesce(max(CASE WHEN reset THEN cs - sc END) OVER w, 0) AS scc
              FROM c
              WINDOW w AS (PARTITION BY collection ORDER BY attempt
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        f AS (SELECT *, kind = 'ok' OR (g = 1 AND gc > 5) OR (sc = 1 AND scc > 50) AS term FROM e)
        SELECT collection,
               CASE WHEN min(attempt) FILTER (WHERE term) IS NULL THEN 'running'
                    ELSE arg_min(CASE WHEN kind = 'ok' THEN 'ok' ELSE 'failed' END, attempt)
                           FILTER (WHERE term) END AS verdict,
               min(attempt) FILTER (WHERE term) AS decided_at,
               CAST(arg_min(gc, attempt) FILTER (WHERE term) AS BIGINT) AS genuine_restarts,
               CAST(arg_min(scc, attempt) FILTER (WHERE term) AS BIGINT) AS schema_restarts,
               count(*) AS attempts_logged
        FROM f GROUP BY collection""",

    "failure_kind": """
        SELECT doc_id,
               CASE WHEN msg IS NULL THEN NULL
                    WHEN contains(msg, 'UnknownFieldException')
                      OR contains(upper(msg), 'NEW_FIELDS_IN_RECORD_WITH_FILE_PATH')
                    THEN 'schema_evolution' ELSE 'genuine' END AS kind,
               substr(replace(msg, chr(10), ' '), 1, 160) AS message,
               replace(msg, chr(10), ' ') AS whole_message
        FROM (SELECT doc_id,
                     CASE doc_id % 4
                       WHEN 0 THEN text || ' [UnknownFieldException]'
                       WHEN 1 THEN 'error: new_fields_in_record_with_file_path ' || text
                       WHEN 2 THEN 'unknownfieldexception ' || text
                       ELSE text END AS msg
              FROM documents)""",
}
