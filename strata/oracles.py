"""DuckDB SQL equivalents of the registered queries (correctness oracles).

The test tables are views in DuckDB. Type conventions follow Spark's
results: ``year()`` and ``rank()`` are cast to INTEGER, sums of integers to
BIGINT; every division that could hit zero is guarded by CASE. The figures of
the domain (bands, labels, factors, thresholds, check names) are written out
here and not taken from the implementation, so a change there shows.
"""

from __future__ import annotations

from .sources.fixtures import LANDING_HEADERS, READINGS_SQL

ROW_CAP, PARTITION_YEAR, TOP_K = 15_000, 1996, 3

E, S = "total_energie_soutiree_wh", "nb_points_soutirage"


def R(x: str, d: int) -> str:
    """Spark's round: half-up on the decimal form of the double."""
    return f"CAST(round(CAST(({x}) AS DECIMAL(38,10)), {d}) AS DOUBLE)"


def RE(x: str, d: int) -> str:
    """Spark's bround: half-even on the decimal form of the double."""
    return f"CAST(round_even(CAST(({x}) AS DECIMAL(38,10)), {d}) AS DOUBLE)"

READING_COLS = ["region", "horodate", "profil", E, S]

MIN_SITES = 5
CATEGORY = (f"CASE WHEN {E} IS NULL THEN 'INCONNU' WHEN {E} < 1000 THEN 'TRES FAIBLE' "
            f"WHEN {E} < 5000 THEN 'FAIBLE' WHEN {E} < 20000 THEN 'MODEREE' "
            f"WHEN {E} < 100000 THEN 'ELEVEE' ELSE 'TRES ELEVEE' END")
SCORE = (f"CASE WHEN {E} IS NOT NULL AND {S} IS NOT NULL AND {S} <> 0 THEN "
         f"least(100.0, "
         f"{RE(f'{E} / {S} / 50.0 * 10.0', 0)} / 10.0) END")
EMISSION = (f"CASE WHEN {E} IS NOT NULL AND {S} IS NOT NULL AND {S} <> 0 THEN "
            f"{R(f'{E} / 1000.0 * 0.0571 / {S}', 2)} END")
YEAR = "CAST(year(horodate) AS INTEGER)"

READINGS = f"readings AS ({READINGS_SQL})"
READINGS_TEXT = ("readings_text AS (SELECT region, strftime(horodate, '%Y-%m-%d %H:%M:%S') AS horodate,"
                 f" profil, {E}, {S} FROM readings)")


def _silver(source: str = "readings", name: str = "silver") -> str:
    return (f"{name} AS (SELECT region, horodate, profil, {E}, {S}, "
            f"CAST(year(CAST(horodate AS TIMESTAMP)) AS INTEGER) AS annee, "
            f"{CATEGORY} AS consumption_category, {SCORE} AS carbon_score, "
            f"CAST({MIN_SITES} AS INTEGER) AS _min_sites "
            f"FROM (SELECT DISTINCT * FROM {source}) d WHERE {S} IS NOT NULL AND {S} >= {MIN_SITES})")


SILVER = _silver()


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- quality report ------------------------------------------------------------

def _dq(rel: str, columns: list[str], numeric: list[str], rows_are_distinct: bool = False,
        checks: tuple[str, ...] = ("null_check", "duplicate_check", "negative_check")
        ) -> str:
    parts = []
    if "null_check" in checks:
        parts += [f"SELECT 'null_check' AS check_name, '{c}' AS column_name, "
                  f"count(*) FILTER (WHERE \"{c}\" IS NULL) AS metric_count FROM {rel}" for c in columns]
    if "duplicate_check" in checks:
        dup = "0" if rows_are_distinct else \
            f"(SELECT count(*) FROM {rel}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {rel}))"
        parts.append(f"SELECT 'duplicate_check' AS check_name, 'ALL' AS column_name, "
                     f"{dup} AS metric_count")
    if "negative_check" in checks:
        parts += [f"SELECT 'negative_check' AS check_name, '{c}' AS column_name, "
                  f"count(*) FILTER (WHERE \"{c}\" < 0) AS metric_count FROM {rel}"
                  for c in numeric]
    total = f"(SELECT count(*) FROM {rel})"
    pct = f"CASE WHEN {total} > 0 THEN metric_count / {total} * 100.0 ELSE 0.0 END"
    return (f"SELECT check_name, column_name, CAST(metric_count AS BIGINT) AS metric_count, "
            f"CASE WHEN check_name = 'null_check' THEN {RE(pct, 2)} END AS metric_pct, "
            f"CASE WHEN check_name = 'null_check' THEN "
            f"  CASE WHEN {pct} = 0 THEN 'PASS' WHEN {pct} < 5.0 THEN 'WARNING' ELSE 'FAIL' END "
            f" WHEN check_name = 'duplicate_check' THEN "
            f"  CASE WHEN metric_count = 0 THEN 'PASS' ELSE 'WARNING' END "
            f" ELSE CASE WHEN metric_count = 0 THEN 'PASS' ELSE 'FAIL' END END AS status "
            f"FROM ({' UNION ALL '.join(parts)}) checks")


# --- KPI building blocks ---------------------------------------------------------

K1 = (f"k1 AS (SELECT region, annee, {R(f'sum({E})', 2)} AS energy_total, {R(f'avg({E})', 2)} AS energy_mean, "
      f"count(*) AS n_records, CAST(sum({S}) AS BIGINT) AS sites_total, "
      f"{R(f'CASE WHEN sum({S}) > 0 THEN {R(f'sum({E})', 2)} / sum({S}) END', 2)} AS energy_per_site "
      f"FROM silver GROUP BY region, annee)")
K2 = (f"k2g AS (SELECT annee, sum({E}) AS t, count(*) AS n_records FROM silver GROUP BY annee),\n"
      f"k2s AS (SELECT annee, {R('t', 2)} AS energy_total, n_records, {R('t / 1000000.0', 4)} AS energy_scaled FROM k2g),\n"
      f"k2l AS (SELECT *, lag(energy_scaled) OVER (ORDER BY annee) AS prev FROM k2s),\n"
      f"k2 AS (SELECT annee, energy_total, n_records, energy_scaled, "
      f"{R('CASE WHEN prev IS NOT NULL AND prev <> 0 THEN (energy_scaled - prev) / prev * 100.0 END', 2)} AS yoy_pct "
      f"FROM k2l)")


def _k3(cat: str) -> str:
    share = R("CASE WHEN sum(energy_total) OVER () <> 0 THEN energy_total / sum(energy_total) OVER () * 100.0 END", 2)
    return (f"k3g AS (SELECT {cat}, count(*) AS n_records, {R(f'sum({E})', 2)} AS energy_total FROM silver GROUP BY {cat}),\n"
            f"k3 AS (SELECT *, {share} AS pct_of_total FROM k3g)")


K4 = (f"k4g AS (SELECT region, {R(f'sum({E})', 2)} AS energy_total, CAST(sum({S}) AS BIGINT) AS sites_total "
      f"FROM silver WHERE annee = (SELECT max(annee) FROM silver) GROUP BY region),\n"
      f"k4 AS (SELECT *, CAST(rank() OVER (ORDER BY energy_total DESC NULLS LAST) AS INTEGER) AS ranking FROM k4g)")


def _fixed(x: str, d: int) -> str:
    return f"CAST(CAST({R(x, d)} AS DECIMAL(38,{d})) AS VARCHAR)"


def _totals(by: str) -> str:
    return f"t AS (SELECT {by}, {R(f'sum({E})', 2)} AS energy_total FROM (SELECT *, {YEAR} AS annee FROM readings) r GROUP BY {by})"


BN = "energy_total / 1000000000.0"
YEARS = range(1995, 2002)


def oracle_sql() -> dict[str, str]:
    r = _with(READINGS)
    rs = _with(READINGS, SILVER)
    text_silver = _with(READINGS, READINGS_TEXT, _silver("readings_text"))
    sql = {
        # sources and sinks
        "csv_scan_semicolon": r + "SELECT * FROM readings",
        "row_cap": f"SELECT CAST(least(count(*), {ROW_CAP}) AS BIGINT) AS n_rows FROM lineitem",
        "ingest_audit_columns": r + "SELECT *, 'readings' AS source_dataset, "
            "'Energy readings per region and period (test tables)' AS source_description FROM readings",
        "ingest_stream_available_now": r + "SELECT *, 'readings' AS source_dataset, "
            "'Energy readings per region and period (test tables)' AS source_description FROM readings",
        "table_overwrite_roundtrip": "SELECT *, 'v2' AS version FROM customer",
        "partitioned_write_pruned_read": f"SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year "
            f"FROM orders WHERE year(o_orderdate) = {PARTITION_YEAR}",
        "ingestion_run_log":
            "SELECT 'readings' AS dataset, 'bronze_readings' AS table_name, "
            "(SELECT count(*) FROM lineitem) AS rows, CAST(5 AS INTEGER) AS columns, "
            "'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_class "
            "UNION ALL SELECT 'customer', 'bronze_customer', (SELECT count(*) FROM customer), 5, 'SUCCESS', NULL "
            "UNION ALL SELECT 'missing', NULL, NULL, NULL, 'FAILED', 'PATH_NOT_FOUND'",
        "ingestion_report":
            "SELECT 'readings' AS dataset, 'SUCCESS' AS status, format('{:,}', (SELECT count(*) FROM lineitem)) AS rows_text "
            "UNION ALL SELECT 'customer', 'SUCCESS', format('{:,}', (SELECT count(*) FROM customer)) "
            "UNION ALL SELECT 'missing', 'FAILED', 'N/A'",
        "table_profile":
            "SELECT 'bronze_readings' AS table_name, (SELECT count(*) FROM lineitem) AS rows, "
            f"CAST(10 AS INTEGER) AS n_columns, '{','.join(LANDING_HEADERS.values())},"
            "_ingestion_timestamp,_ingestion_date,_source_dataset,_source_url,_source_description' AS column_names, "
            "'OK' AS status "
            "UNION ALL SELECT 'bronze_customer', (SELECT count(*) FROM customer), 10, "
            "'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment,"
            "_ingestion_timestamp,_ingestion_date,_source_dataset,_source_url,_source_description', 'OK' "
            "UNION ALL SELECT 'bronze_missing', NULL, NULL, NULL, 'ERROR: AnalysisException'",
        "gold_write_log": rs +
            "SELECT 'gold_region_year' AS table_name, 'OK' AS status, "
            "(SELECT count(*) FROM (SELECT DISTINCT region, annee FROM silver)) AS rows "
            "UNION ALL SELECT 'gold_national_trend', 'OK', (SELECT count(*) FROM (SELECT DISTINCT annee FROM silver)) "
            "UNION ALL SELECT 'gold_category_share', 'SKIP', NULL "
            "UNION ALL SELECT 'gold_top_regions', 'OK', (SELECT count(*) FROM (SELECT DISTINCT region FROM silver "
            "WHERE annee = (SELECT max(annee) FROM silver))) "
            "UNION ALL SELECT 'gold_without_region', 'SKIP', NULL "
            "UNION ALL SELECT 'gold_failing', 'FAILED', NULL",
        "silver_pipeline": text_silver + "SELECT * FROM silver",
        "silver_quality_report": _with(READINGS, READINGS_TEXT,
                                       "d AS (SELECT DISTINCT * FROM readings_text)")
            + _dq("d", READING_COLS, [E, S], rows_are_distinct=True),
        "silver_pipeline_metrics": text_silver +
            "SELECT (SELECT count(*) FROM readings_text) AS rows_in, "
            "(SELECT count(*) FROM (SELECT DISTINCT * FROM readings_text)) AS rows_distinct, "
            "(SELECT count(*) FROM readings_text) - (SELECT count(*) FROM (SELECT DISTINCT * FROM readings_text)) AS rows_deduplicated, "
            "(SELECT count(*) FROM silver) AS rows_out, "
            "(SELECT count(*) FROM (SELECT DISTINCT * FROM readings_text)) - (SELECT count(*) FROM silver) AS rows_suppressed",
        # projection, expressions
        "drop_audit_columns": r + "SELECT * FROM readings",
        "standardize_column_names": r + "SELECT * FROM readings",
        "cast_measures": "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity, "
                         "l_extendedprice FROM lineitem",
        "detect_column": r + f"SELECT {E} AS measure, {S} AS sites, region AS area, horodate AS period FROM readings",
        "derive_year": r + f"SELECT *, {YEAR} AS annee FROM readings",
        "latest_year": r + "SELECT CAST(max(year(horodate)) AS INTEGER) AS latest_year FROM readings",
        "latest_year_filter": r + f"SELECT *, {YEAR} AS annee FROM readings "
            "WHERE year(horodate) = (SELECT max(year(horodate)) FROM readings)",
        # dedupe, quality, privacy
        "dedup_full_row": r + "SELECT DISTINCT * FROM readings",
        "dedup_metrics": r + "SELECT (SELECT count(*) FROM readings) AS rows_before, "
            "(SELECT count(*) FROM (SELECT DISTINCT * FROM readings)) AS rows_after, "
            "(SELECT count(*) FROM readings) - (SELECT count(*) FROM (SELECT DISTINCT * FROM readings)) AS rows_removed",
        "dq_null_check": r + _dq("readings", READING_COLS, [E, S], checks=("null_check",)),
        "dq_duplicate_check": r + _dq("readings", READING_COLS, [E, S], checks=("duplicate_check",)),
        "dq_negative_check": _dq("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
                                 ["c_custkey", "c_nationkey", "c_acctbal"], checks=("negative_check",)),
        "dq_summary": r + "SELECT count(*) AS n_checks, count(*) FILTER (WHERE status = 'FAIL') AS n_fail, "
            "count(*) FILTER (WHERE status = 'WARNING') AS n_warning FROM ("
            + _dq("readings", READING_COLS, [E, S]) + ") rep",
        "small_count_suppression": r + f"SELECT *, CAST({MIN_SITES} AS INTEGER) AS _min_sites FROM readings "
            f"WHERE {S} IS NOT NULL AND {S} >= {MIN_SITES}",
        "suppression_metrics": r + f"SELECT count(*) AS rows_before, "
            f"count(*) FILTER (WHERE {S} >= {MIN_SITES}) AS rows_after, "
            f"count(*) FILTER (WHERE {S} IS NULL OR {S} < {MIN_SITES}) AS rows_removed FROM readings",
        # scoring
        "categorize_consumption": r + f"SELECT {E}, {CATEGORY} AS consumption_category FROM readings",
        "sql_function_categorize": r + f"SELECT {E}, {CATEGORY} AS consumption_category, "
            f"{SCORE} AS carbon_score FROM readings",
        "carbon_score_normalised": r + f"SELECT {E}, {S}, {SCORE} AS carbon_score FROM readings",
        "carbon_score_emission": r + f"SELECT {E}, {S}, {EMISSION} AS emission_score FROM readings",
        # windows
        "lag_previous_period": _with(READINGS, _totals("annee"))
            + "SELECT annee, energy_total, lag(energy_total) OVER (ORDER BY annee) AS previous_total FROM t",
        "share_of_total": _with(READINGS, _totals("region"))
            + "SELECT region, energy_total, " + R("CASE WHEN sum(energy_total) OVER () <> 0 THEN "
              "energy_total / sum(energy_total) OVER () * 100.0 END", 2) + " AS pct_of_total FROM t",
        "rank_desc": _with(READINGS, _totals("region"))
            + "SELECT region, energy_total, CAST(rank() OVER (ORDER BY energy_total DESC NULLS LAST) AS INTEGER)"
              " AS ranking FROM t",
        "top_k_by_rank": _with(READINGS, _totals("region"))
            + f"SELECT *, coalesce(ranking <= {TOP_K}, false) AS is_top_k FROM (SELECT region, energy_total, "
              "CAST(rank() OVER (ORDER BY energy_total DESC NULLS LAST) AS INTEGER) AS ranking FROM t) x",
        "top_k_per_year": _with(READINGS, _totals("region, annee"))
            + "SELECT * FROM (SELECT region, annee, energy_total, CAST(rank() OVER (PARTITION BY annee "
              f"ORDER BY energy_total DESC NULLS LAST) AS INTEGER) AS ranking FROM t) x WHERE ranking <= {TOP_K}",
        "rank_desc_unbounded": "SELECT l_orderkey, l_linenumber, l_extendedprice, "
            "rank() OVER (ORDER BY l_extendedprice DESC NULLS LAST) AS ranking FROM lineitem",
        "rank_desc_large_keys": "SELECT l_linenumber, big_key, "
            "rank() OVER (ORDER BY big_key DESC NULLS LAST) AS ranking "
            "FROM (SELECT l_linenumber, l_orderkey + 1152921504606846976 AS big_key FROM lineitem) x",
        "rank_desc_null_third": "SELECT l_orderkey, l_linenumber, ship_date, "
            "rank() OVER (ORDER BY ship_date DESC NULLS LAST) AS ranking FROM (SELECT l_orderkey, l_linenumber, "
            "CASE WHEN l_orderkey % 3 <> 0 THEN CAST(l_shipdate AS DATE) END AS ship_date FROM lineitem) x",
        "lag_previous_unbounded": "SELECT o_orderkey, o_totalprice, lag(o_totalprice) OVER "
            "(ORDER BY o_orderkey NULLS FIRST) AS previous_totalprice FROM orders",
        "lag_previous_dates": "SELECT order_date, previous_date, count(*) AS n_rows FROM (SELECT order_date, "
            "lag(order_date) OVER (ORDER BY order_date) AS previous_date FROM "
            "(SELECT CAST(o_orderdate AS DATE) AS order_date FROM orders) x) y GROUP BY ALL",
        "share_of_total_unbounded": "SELECT o_orderkey, o_totalprice, "
            + R("o_totalprice / (SELECT sum(o_totalprice) FROM orders) * 100.0", 4) + " AS pct_of_total FROM orders",
        # KPIs
        "kpi_region_year": _with(READINGS, SILVER, K1) + "SELECT * FROM k1",
        "kpi_national_trend": _with(READINGS, SILVER, K2) + "SELECT * FROM k2",
        "kpi_category_share": _with(READINGS, SILVER, _k3("consumption_category")) + "SELECT * FROM k3",
        "category_fallback_share": _with(READINGS, SILVER, _k3("profil")) + "SELECT * FROM k3",
        "kpi_top_regions": _with(READINGS, SILVER, K4) + "SELECT * FROM k4",
        # chart data
        "chart_region_year_matrix": _with(READINGS, SILVER, K1)
            + "SELECT region, " + ", ".join(
                f"avg(CASE WHEN annee = {y} THEN energy_total END) / 1000000000.0 AS \"{y}\"" for y in YEARS)
            + " FROM k1 WHERE region IS NOT NULL AND annee IS NOT NULL GROUP BY region",
        "chart_trend_series": _with(READINGS, SILVER, K2)
            + f"SELECT annee, {BN} AS energy_bn, {_fixed(BN, 1)} || ' bn Wh' AS energy_label, yoy_pct, "
              "CASE WHEN yoy_pct > 0 THEN 'up' WHEN yoy_pct IS NOT NULL THEN 'down' END AS change_class, "
              "CASE WHEN yoy_pct IS NOT NULL THEN (CASE WHEN yoy_pct > 0 THEN '+' ELSE '' END) || "
              f"{_fixed('yoy_pct', 1)} || '%' END AS change_label, max({BN}) OVER () * 1.3 AS axis_max FROM k2",
        "chart_category_share": _with(READINGS, SILVER, _k3("consumption_category"))
            + f"SELECT consumption_category, {BN} AS energy_bn, pct_of_total, "
              f"{_fixed(BN, 1)} || ' bn Wh  (' || {_fixed('pct_of_total', 2)} || '%)' AS label, "
              "CASE consumption_category WHEN 'TRES ELEVEE' THEN '#003189' WHEN 'ELEVEE' THEN '#0070C0' "
              "WHEN 'MODEREE' THEN '#00AEEF' ELSE '#AAAAAA' END AS colour, "
              f"max({BN}) OVER () * 1.5 AS axis_max FROM k3 WHERE consumption_category IS DISTINCT FROM 'INCONNU'",
        "chart_region_ranking": _with(READINGS, SILVER, K4)
            + f"SELECT region, {BN} AS energy_bn, ranking, coalesce(ranking <= 3, false) AS is_top_k, "
              "CASE WHEN coalesce(ranking <= 3, false) THEN '#003189' ELSE '#00AEEF' END AS colour, "
              f"{_fixed(BN, 2)} || ' bn Wh  (rank ' || CAST(ranking AS VARCHAR) || ')' AS label, "
              f"avg({BN}) OVER () AS mean_bn, max({BN}) OVER () * 1.4 AS axis_max FROM k4",
    }
    # the same rows, whatever awkward form they landed in
    sql["csv_quoted_cells"] = ("SELECT c_custkey, '\"' || c_name || '\";' || chr(10) || c_mktsegment AS c_quoted, "
                               "c_nationkey FROM customer")
    sql["csv_ragged_rows"] = ("SELECT c_custkey, CASE WHEN c_nationkey % 3 <> 0 THEN c_name END AS c_name, "
                              "CASE WHEN c_nationkey % 3 = 1 THEN 1 ELSE 0 END AS bad_cells FROM customer")
    sql["csv_long_cells"] = (
        "SELECT s_suppkey, CAST(length(note) AS BIGINT) AS note_chars, md5(note) AS note_md5, "
        "CASE WHEN s_suppkey % 3 <> 0 THEN s_name END AS s_name, "
        "CASE WHEN s_suppkey % 3 = 1 THEN 1 ELSE 0 END AS bad_cells "
        "FROM (SELECT *, repeat('x\"; ', 20000) AS note FROM supplier) s")
    clash = ("l_linestatus AS _p, l_tax AS _r, l_linenumber AS _s, l_discount AS _o, l_suppkey AS \"row\", "
             "l_partkey AS key, l_quantity AS \"range\", l_returnflag AS spread")
    sql["rank_desc_unbounded_clash"] = (
        f"SELECT l_orderkey, l_extendedprice, {clash}, "
        "rank() OVER (ORDER BY l_extendedprice DESC NULLS LAST) AS ranking FROM lineitem")
    sql["lag_previous_unbounded_clash"] = (
        "SELECT \"row\", count(*) AS n_rows, sum(_s)::BIGINT AS sum_s, min(_p) AS min_p, "
        "max(spread) AS max_spread, min(previous) AS least_previous "
        f"FROM (SELECT {clash}, lag(l_suppkey) OVER (ORDER BY l_suppkey) AS previous "
        "FROM lineitem) x GROUP BY ALL")
    sql["csv_header_order"] = ("SELECT 'swapped' AS dataset, 'FAILED' AS status, CAST(NULL AS BIGINT) AS rows "
                               "UNION ALL SELECT 'same', 'SUCCESS', (SELECT count(*) FROM customer)")
    late, again = "year(horodate) = 1996", f"{S} % 3 = 0"
    both = (f"b AS (SELECT * FROM readings WHERE NOT ({late}) "
            f"UNION ALL SELECT * FROM readings WHERE {late} OR {again})")
    sql["dedup_against_history"] = rs + "SELECT * FROM silver"
    sql["dedup_history_metrics"] = _with(READINGS, SILVER, both) + (
        "SELECT rows_in, rows_distinct, rows_in - rows_distinct AS rows_deduplicated, rows_out, "
        "rows_distinct - rows_out AS rows_suppressed FROM (SELECT (SELECT count(*) FROM b) AS rows_in, "
        "(SELECT count(*) FROM (SELECT DISTINCT * FROM b)) AS rows_distinct, "
        "(SELECT count(*) FROM silver) AS rows_out) x")
    sql["quality_report_merged"] = _with(READINGS, both) + _dq("b", READING_COLS, [E, S])
    for key in ("kpi_region_year", "kpi_national_trend", "kpi_category_share", "kpi_top_regions"):
        sql[f"{key}_incremental"] = sql[key]
    sql["partition_overwrite_one_year"] = (
        "SELECT * REPLACE (CASE WHEN o_year = 1996 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice) "
        "FROM (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders) o")
    sql["compaction_files_per_year"] = (
        "SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, count(*) AS n_rows, "
        "CAST(sum(o_orderkey) AS BIGINT) AS sum_keys, true AS bounded FROM orders GROUP BY 1")
    sql["csv_rejects"] = (
        "SELECT CASE c_custkey % 4 WHEN 0 THEN 'kept' WHEN 1 THEN 'surplus fields' "
        "WHEN 2 THEN 'unparsable cells' ELSE 'open quote' END AS outcome, "
        "c_custkey || ';' || CASE WHEN c_custkey % 4 = 3 THEN '\"' ELSE '' END || c_name || "
        "CASE c_custkey % 4 WHEN 0 THEN ';' || c_nationkey WHEN 1 THEN ';7;surplus' "
        "WHEN 2 THEN ';none of ' || c_custkey ELSE '' END AS text FROM customer")
    sql["csv_reject_summary"] = (
        "SELECT 'unparsable cells' AS reason, 'c_nationkey' AS column_name, count(*) AS n_records "
        "FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'unparsable cells', 'c_acctbal', count(*) "
        "FROM customer WHERE c_custkey % 6 = 0")
    sql["schema_drift"] = (
        "SELECT CAST(2 AS INTEGER) AS version, * FROM (VALUES ('c_name', 'removed', 'string', NULL), "
        "('c_acctbal', 'moved', 'double', 'double'), ('c_nationkey', 'added', NULL, 'bigint')) "
        "AS t(column_name, change, old_type, new_type)")
    sql["schema_store_scan"] = ("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, "
                                "c_mktsegment FROM customer")
    sql["run_log_durable"] = (
        "SELECT run_id, 'bronze' AS layer, x.* FROM (VALUES ('run-1'), ('run-2')) AS r(run_id), "
        "(SELECT 'customer' AS dataset, 'bronze_customer' AS table_name, 'SUCCESS' AS status, "
        "(SELECT count(*) FROM customer) AS rows, CAST(NULL AS VARCHAR) AS error_class "
        "UNION ALL SELECT 'missing', NULL, 'FAILED', NULL, 'PATH_NOT_FOUND') x")
    sql["row_cap_first_rows"] = ("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem "
                                 "ORDER BY l_orderkey, l_linenumber, l_partkey LIMIT 1000")
    first = ("f AS (SELECT region, annee FROM k1 WHERE sites_total = (SELECT min(sites_total) FROM k1)),\n"
             "p AS (SELECT k1.region, k1.annee FROM k1 JOIN f ON k1.annee = f.annee AND k1.region <> f.region "
             "QUALIFY row_number() OVER (ORDER BY k1.sites_total, k1.region) = 1)")
    why = ("CASE WHEN EXISTS (SELECT 1 FROM f WHERE f.region = k1.region AND f.annee = k1.annee) THEN 'primary' "
           "WHEN EXISTS (SELECT 1 FROM p WHERE p.region = k1.region AND p.annee = k1.annee) THEN 'secondary' END")
    shown = ", ".join(f"CASE WHEN hidden IS NULL THEN {c} END AS {c}" for c in (
        "energy_total", "energy_mean", "n_records", "sites_total", "energy_per_site"))
    sql["kpi_cells_suppressed"] = _with(READINGS, SILVER, K1, first) + (
        f"SELECT region, annee, {shown}, hidden FROM (SELECT *, {why} AS hidden FROM k1) x")
    sql["kpi_cells_rectangles"] = _with(READINGS, SILVER, K1, first.split(",\n")[0]) + (
        "SELECT region, annee, hidden, false AS hide_totals FROM ("
        "SELECT f.region, f.annee, 'primary' AS hidden FROM f UNION ALL SELECT unnest([f.region, b.region, b.region]), "
        "unnest([a.annee, f.annee, a.annee]), 'secondary' FROM (SELECT a.annee AS c2, b.region AS r2 FROM f "
        "JOIN k1 a ON a.region = f.region AND a.annee <> f.annee JOIN k1 b ON b.annee = f.annee AND b.region <> f.region "
        "JOIN k1 d ON d.region = b.region AND d.annee = a.annee "
        "QUALIFY row_number() OVER (ORDER BY a.sites_total + b.sites_total + d.sites_total, b.region, a.annee) = 1) c, "
        "f, k1 a, k1 b WHERE a.region = f.region AND a.annee = c2 AND b.annee = f.annee AND b.region = r2) y")
    sql["silver_detected_roles"] = sql["silver_pipeline"]
    sql["ingest_stream_second_batch"] = sql["ingest_stream_available_now"]
    return sql
