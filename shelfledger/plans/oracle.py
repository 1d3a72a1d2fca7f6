"""The queries stated once more as SQL over the driver tables, for another engine to run.

Each statement repeats the whole way from the raw tables, so it shares nothing with the Spark
plans but the definitions.
"""

from __future__ import annotations


def _mean(total: str, n: str, unit: int = 1) -> str:
    """Average of integers in whole cents, halves up; ``unit`` integers make one cent."""
    return f"CAST((2 * {total} + {n} * {unit}) // (2 * {n} * {unit}) AS DOUBLE) / 100"


def _percent(num: str, den: str, digits: int) -> str:
    """Halves away from zero, for either sign."""
    scale = 10 ** digits
    size = f"((abs({num}) * {200 * scale} + {den}) // (2 * {den}))"
    return (f"CASE WHEN {den} = 0 THEN NULL "
            f"ELSE sign({num}) * CAST({size} AS DOUBLE) / {scale} END")


_LABEL = """array_to_string([upper(w[1]) || w[2:] FOR w IN
    regexp_extract_all(lower(replace(regexp_replace({0}, '^[a-z]{{2}}:', ''), '-', ' ')),
                       '[a-z0-9]+|[^a-z0-9]+')], '')"""
_STATUS_LABEL = """array_to_string([upper(w[1]) || w[2:] FOR w IN
    regexp_extract_all(lower(replace({0}, '_', ' ')), '[a-z0-9]+|[^a-z0-9]+')], '')"""

_RULED = """{name} AS (
    SELECT *, trim(product_name) AS name, [r FOR r IN [
        CASE WHEN code = '' THEN 'Missing barcode' END,
        CASE WHEN trim(product_name) = '' THEN 'Missing product name' END,
        CASE WHEN lower(trim(product_name)) = lower(code)
             THEN 'Product name is identical to barcode' END,
        CASE WHEN regexp_full_match(trim(product_name), '[0-9\\s-]+')
             THEN 'Product name contains no descriptive text' END] IF r IS NOT NULL] AS reasons
    FROM {raw})"""

_PRODUCTS = """
stores AS (
    SELECT CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name, n_name AS city,
           r_name AS region
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
raw_products AS (
    SELECT p_partkey AS row_pos, concat(1995 + p_partkey % 7, '-H1') AS pipeline_run_id,
           CAST(p_partkey AS VARCHAR) AS code,
           CASE p_partkey % 25 WHEN 0 THEN CAST(p_partkey AS VARCHAR) WHEN 1 THEN ''
                WHEN 2 THEN '123-45' ELSE p_name END AS product_name,
           p_brand AS brands, ['en:' || lower(p_type)] AS categories_tags,
           '  ' || p_type || chr(9) AS ingredients_text,
           CASE WHEN p_partkey % 10 <> 3 THEN CAST(p_size * 10 AS VARCHAR) END AS energy_kcal_100g,
           CAST(1700000000 + p_partkey AS VARCHAR) AS last_modified_t
    FROM part),"""

_SILVER_PRODUCTS = """
decided_products AS (
    SELECT *, len(reasons) = 0 AS accepted,
           CASE WHEN len(reasons) > 0 THEN array_to_string(reasons, '; ') END AS failure_reason
    FROM ruled),
products AS (
    SELECT pipeline_run_id, code AS barcode, name AS product_name, brands AS brand,
           categories_tags[1] AS category, trim(ingredients_text, ' ' || chr(9)) AS ingredients_text,
           CAST(energy_kcal_100g AS DOUBLE) AS energy_kcal_100g,
           to_timestamp(CAST(last_modified_t AS BIGINT)) AT TIME ZONE 'UTC' AS source_modified_at
    FROM decided_products WHERE accepted)"""

_PRICES = """
faulty AS (
    SELECT *, (l_orderkey * 7 + l_partkey * 3 + l_linenumber) % 50 AS f,
           md5(concat(l_orderkey, '-', l_linenumber)) AS h,
           (CAST(round(l_extendedprice * 100) AS BIGINT) + 2000) // 4000 AS c,
           row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
                              l_extendedprice) AS row_pos
    FROM lineitem),
raw_prices AS (
    SELECT row_pos,
           concat(year(l_shipdate), '-H', CASE WHEN month(l_shipdate) <= 6 THEN 1 ELSE 2 END)
               AS pipeline_run_id,
           CASE WHEN f <> 7 THEN concat(h[1:8], '-', h[9:12], '-', h[13:16], '-', h[17:20], '-',
                                        h[21:32]) END AS event_id,
           CASE WHEN f = 3 THEN 'unknown_barcode' ELSE CAST(l_partkey AS VARCHAR) END AS barcode,
           CASE WHEN f = 2 THEN 'unknown_store' ELSE CAST(l_suppkey AS VARCHAR) END AS store_id,
           CASE f WHEN 0 THEN '-1' WHEN 1 THEN NULL WHEN 4 THEN '900'
                ELSE concat(c // 100, '.', lpad(CAST(c % 100 AS VARCHAR), 2, '0')) END AS price,
           CASE WHEN l_discount > 0.08 THEN 'True' ELSE 'False' END AS promotion,
           CASE WHEN l_linestatus = 'O' THEN 'in_stock' ELSE 'low_stock' END AS stock_status,
           CASE f WHEN 5 THEN 'bad' WHEN 6 THEN '2999-01-01T00:00:00Z'
                ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') END AS event_timestamp,
           TRY_CAST(price AS DOUBLE) AS p,
           CASE f WHEN 5 THEN NULL WHEN 6 THEN TIMESTAMP '2999-01-01' ELSE l_shipdate END AS t
    FROM faulty),
own AS (
    SELECT r.*, [x FOR x IN [
        CASE WHEN event_id IS NULL THEN 'Missing event ID' END,
        CASE WHEN barcode NOT IN (SELECT barcode FROM products) THEN 'Unknown product barcode' END,
        CASE WHEN store_id NOT IN (SELECT store_id FROM stores) THEN 'Unknown store' END,
        CASE WHEN p IS NULL THEN 'Missing or invalid price'
             WHEN p <= 0 THEN 'Price must be greater than zero'
             WHEN p > 500 THEN 'Price exceeds reasonable limit' END,
        CASE WHEN t IS NULL THEN 'Invalid event timestamp'
             WHEN t > TIMESTAMP '2026-01-01 00:05:00' THEN 'Timestamp is in the future' END]
        IF x IS NOT NULL] AS own_reasons
    FROM raw_prices AS r),
seen AS (
    SELECT *, min(CASE WHEN len(own_reasons) = 0 THEN row_pos END)
                  OVER (PARTITION BY event_id) AS first_ok
    FROM own),
decided_prices AS (
    SELECT *, CASE WHEN event_id IS NOT NULL AND row_pos > first_ok
                   THEN list_concat(['Duplicate event ID in source file'], own_reasons)
                   ELSE own_reasons END AS failures,
           len(failures) = 0 AS accepted, nullif(array_to_string(failures, '; '), '') AS failure_reason
    FROM seen),
prices AS (
    SELECT pipeline_run_id, event_id, barcode, store_id, p AS price,
           CAST(round(p * 100) AS BIGINT) AS c, promotion = 'True' AS promotion, stock_status,
           t AS event_timestamp
    FROM decided_prices WHERE accepted)"""

_AUDIT = """
per_dataset AS (
    SELECT pipeline_run_id, 'products' AS dataset_name, count(*) AS source_records,
           count(*) FILTER (accepted) AS valid_records,
           count(*) FILTER (NOT accepted) AS rejected_records
    FROM decided_products GROUP BY 1
    UNION ALL
    SELECT pipeline_run_id, 'prices', count(*), count(*) FILTER (accepted),
           count(*) FILTER (NOT accepted)
    FROM decided_prices GROUP BY 1),
runs AS (
    SELECT pipeline_run_id, CAST(sum(source_records) AS BIGINT) AS source_records,
           CAST(sum(valid_records) AS BIGINT) AS valid_records,
           CAST(sum(rejected_records) AS BIGINT) AS rejected_records,
           CAST(pipeline_run_id[1:4] AS INTEGER) AS y, pipeline_run_id[7:7] AS half,
           CAST(CASE WHEN half = '1' THEN make_date(y, 7, 1) ELSE make_date(y + 1, 1, 1) END
                AS TIMESTAMP) AS started_at,
           CASE WHEN y % 4 = 1 AND half = '2' THEN 'RUNNING'
                WHEN y % 4 = 2 AND half = '1' THEN 'FAILED' ELSE 'SUCCESS' END AS status
    FROM per_dataset GROUP BY 1),
quarantine AS (
    SELECT pipeline_run_id, 'products' AS dataset_name, failure_reason,
           CAST(to_json(struct_pack(code := code, product_name := product_name, brands := brands,
                categories_tags := categories_tags, ingredients_text := ingredients_text,
                energy_kcal_100g := energy_kcal_100g, last_modified_t := last_modified_t))
                AS VARCHAR) AS raw_record
    FROM decided_products WHERE NOT accepted
    UNION ALL
    SELECT pipeline_run_id, 'prices', failure_reason,
           CAST(to_json(struct_pack(event_id := event_id, barcode := barcode, store_id := store_id,
                price := price, promotion := promotion, stock_status := stock_status,
                event_timestamp := event_timestamp)) AS VARCHAR)
    FROM decided_prices WHERE NOT accepted)"""

_STREAM = """
lake AS (
    SELECT CASE WHEN e.event_id % 100 <> 37 THEN CAST(e.event_id AS VARCHAR) END AS event_id,
           CAST(user_id AS VARCHAR) AS barcode,
           event_type AS store_id, value AS price, 'EUR' AS currency, FALSE AS promotion,
           'in_stock' AS stock_status, ts AS event_time,
           CASE WHEN e.event_id % 100 = 37 THEN 'missing event_id'
                WHEN event_type NOT IN ('view', 'click', 'signup', 'purchase') THEN 'unknown store'
                WHEN value IS NULL THEN 'missing price'
                WHEN value <= 0 OR value >= 200 THEN 'invalid price' END AS validation_error,
           CAST(round(value * 1000000) AS BIGINT) AS u
    FROM events AS e),
valid AS (SELECT * FROM lake WHERE validation_error IS NULL),
stream_stores AS (
    SELECT * FROM stores UNION ALL
    SELECT DISTINCT event_type, 'Channel ' || event_type, 'Online', 'Online'
    FROM events WHERE event_type NOT IN ('error', 'view')),
latest AS (
    SELECT barcode, store_id, price AS latest_price, event_time AS latest_event_time
    FROM valid QUALIFY row_number() OVER (PARTITION BY barcode, store_id
                                          ORDER BY event_time DESC, event_id DESC, price DESC) = 1),
batch AS (
    SELECT barcode, (2 * sum(c) + count(*)) // (2 * count(*)) AS b FROM prices GROUP BY 1),
streamed AS (
    SELECT barcode, (2 * sum(u) + count(*) * 10000) // (2 * count(*) * 10000) AS s
    FROM valid GROUP BY 1),
versus AS (
    SELECT s.barcode, product_name, CAST(s AS BIGINT) AS s, CAST(b AS BIGINT) AS b,
           CAST(s - b AS BIGINT) AS d
    FROM streamed AS s JOIN batch USING (barcode) LEFT JOIN products USING (barcode))"""

_SUMMARY = f"""
    SELECT count(*) AS both_routes, count(*) FILTER (abs(d) <= 100) AS within_one,
           count(*) FILTER (d < 0) AS cheaper, round(median(abs(d))) / 100 AS median_gap,
           {_mean('sum(b)', 'count(*)')} AS avg_batch, {_mean('sum(s)', 'count(*)')} AS avg_stream
    FROM versus"""
_BY_PRODUCT = f"""
    SELECT barcode, product_name, brand, count(*) AS event_count,
           {_mean('sum(u)', 'count(*)', 10000)} AS average_streamed_price,
           min(price) AS lowest_streamed_price, max(price) AS highest_streamed_price
    FROM valid LEFT JOIN products USING (barcode) GROUP BY 1, 2, 3"""
_BY_STORE = f"""
    SELECT store_id, store_name, city, count(*) AS event_count,
           {_mean('sum(u)', 'count(*)', 10000)} AS average_streamed_price
    FROM valid LEFT JOIN stream_stores USING (store_id) GROUP BY 1, 2, 3"""
_WIDEST = """
    SELECT product_name, CAST(s AS DOUBLE) / 100 AS stream_price, CAST(b AS DOUBLE) / 100 AS batch_price,
           CAST(d AS DOUBLE) / 100 AS difference
    FROM versus ORDER BY {0}, barcode LIMIT 5"""
_LATEST_RUN = f"""
    SELECT source_records, valid_records, rejected_records,
           {_percent('rejected_records', 'source_records', 1)} AS rejected_pct
    FROM runs {{0}} ORDER BY started_at DESC LIMIT 1"""
_DAILY = f"""
    SELECT date_trunc('day', event_timestamp)::TIMESTAMP AS price_date, barcode, product_name, brand,
           category, count(DISTINCT store_id) AS stores_reporting,
           {_mean('sum(c)', 'count(*)')} AS average_price, min(price) AS minimum_price,
           max(price) AS maximum_price
    FROM prices JOIN products USING (barcode) GROUP BY 1, 2, 3, 4, 5"""
_AVERAGE = f"SELECT {_mean('sum(c)', 'count(*)')} AS average_price FROM prices"

_LAYERS = """
    SELECT 'bronze.raw_products' AS layer, count(*) AS row_count FROM raw_products
    UNION ALL SELECT 'bronze.raw_prices', count(*) FROM raw_prices
    UNION ALL SELECT 'silver.products', count(*) FROM products
    UNION ALL SELECT 'silver.prices', count(*) FROM prices
    UNION ALL SELECT 'silver.stores', count(*) FROM stores
    UNION ALL SELECT 'audit.runs', count(*) FROM runs
    UNION ALL SELECT 'audit.quarantine', count(*) FROM quarantine"""
_FIGURES = f"""
n AS ({_LAYERS}),
w AS (SELECT layer, row_count, format('{{:,}} rows', row_count) AS shown FROM n),
run AS ({_LATEST_RUN.format("WHERE status = 'SUCCESS'")}),
figures AS (
    SELECT layer AS metric, shown AS value FROM w WHERE layer <> 'audit.runs'
    UNION ALL SELECT 'bronze.total', format('{{:,}} rows', CAST(sum(row_count) AS BIGINT)) FROM w
        WHERE layer LIKE 'bronze.%'
    UNION ALL SELECT 'silver.total', format('{{:,}} rows', CAST(sum(row_count) AS BIGINT)) FROM w
        WHERE layer LIKE 'silver.%'
    UNION ALL SELECT 'audit.runs', row_count || ' runs' FROM w WHERE layer = 'audit.runs'
    UNION ALL SELECT 'runs.count', CAST(row_count AS VARCHAR) FROM w WHERE layer = 'audit.runs'
    UNION ALL SELECT 'quarantine.total', CAST(row_count AS VARCHAR) FROM w
        WHERE layer = 'audit.quarantine'
    UNION ALL SELECT 'silver.prices.count', format('{{:,}}', row_count) FROM w
        WHERE layer = 'silver.prices'
    UNION ALL SELECT 'run.source', CAST(source_records AS VARCHAR) FROM run
    UNION ALL SELECT 'run.valid', CAST(valid_records AS VARCHAR) FROM run
    UNION ALL SELECT 'run.rejected', CAST(rejected_records AS VARCHAR) FROM run
    UNION ALL SELECT 'run.reject_pct', CAST(CAST(rejected_pct AS DECIMAL(10, 1)) AS VARCHAR) FROM run)"""

_VERDICTS = """
verdicts AS (
    SELECT CAST(doc_id AS VARCHAR) AS code, CASE WHEN quality = 0 THEN 'reject' ELSE 'pass' END
           AS answer, CASE WHEN toxic = 1 THEN 0.95::DOUBLE ELSE 0.80::DOUBLE END AS sure
    FROM labels),
gated AS (
    SELECT r.* EXCLUDE (reasons), reasons, len(reasons) = 0 AND answer IS NOT NULL AS reviewed,
           CASE WHEN reviewed THEN answer WHEN len(reasons) > 0 THEN 'reject' ELSE 'pass' END AS status,
           CASE WHEN reviewed THEN sure WHEN len(reasons) > 0 THEN 0.99::DOUBLE ELSE 0.95::DOUBLE END
               AS confidence,
           CASE WHEN reviewed THEN 'reviewer' ELSE 'deterministic-semantic-rules' END AS validator,
           (status = 'pass' OR confidence < 0.9) AND name <> '' AND name <> code AS accepted,
           CASE WHEN NOT accepted THEN coalesce(nullif(CASE WHEN reviewed THEN ''
                ELSE array_to_string(reasons, '; ') END, ''), 'Product failed semantic validation') END
               AS failure_reason
    FROM ruled AS r LEFT JOIN verdicts USING (code))"""
_LATER = """
later AS (
    SELECT * FROM raw_products WHERE row_pos % 11 <> 5
    UNION ALL
    SELECT row_pos + 1000000000000, pipeline_run_id, code,
           CASE row_pos % 3 WHEN 0 THEN 'Renamed ' || brands WHEN 1 THEN '' ELSE product_name END,
           brands, categories_tags, ingredients_text, energy_kcal_100g, last_modified_t
    FROM raw_products WHERE row_pos % 11 <> 5)"""
_EFFECT = """
effect AS (
    SELECT code AS barcode, bool_or(NOT accepted) AS removed, arg_max(accepted, row_pos) AS present,
           arg_max(name, row_pos) AS product_name, any_value(brands) AS brand,
           any_value(categories_tags[1]) AS category,
           any_value(trim(ingredients_text, ' ' || chr(9))) AS ingredients_text,
           any_value(CAST(energy_kcal_100g AS DOUBLE)) AS energy_kcal_100g,
           any_value(to_timestamp(CAST(last_modified_t AS BIGINT)) AT TIME ZONE 'UTC')
               AS source_modified_at
    FROM gated GROUP BY 1)"""


def _expect(dataset: str, rows: list[tuple[str, str]], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{name}' AS expectation, count(*) FILTER ({broken}) = 0 "
        f"AS success, count(*) FILTER ({broken}) AS unexpected_count, count(*) AS element_count "
        f"FROM {source}" for name, broken in rows)


def _statements() -> dict[str, str]:
    ruled = _RULED.replace("{name}", "ruled").replace("{raw}", "raw_products")
    products = f"{_PRODUCTS} {ruled}, {_SILVER_PRODUCTS}"
    base = f"WITH {products}, {_PRICES}"
    audited = f"{base}, {_AUDIT}"
    tiers = f"{base}, {_STREAM}"
    gate = f"WITH {products}, {_VERDICTS}"
    # the gate looks at the later file, while prices keep the products of the first load
    ruled_later = _RULED.replace("{name}", "ruled_later").replace("{raw}", "later")
    gate_later = _VERDICTS.replace("FROM ruled AS r", "FROM ruled_later AS r")
    effect = f"{base}, {_LATER}, {ruled_later}, {gate_later}, {_EFFECT}"
    label, status_label = _LABEL.format("category"), _STATUS_LABEL.format("stock_status")
    by_name = f"{base} SELECT product_name AS product, "
    s = {}
    s["daily_price_summary"] = base + _DAILY
    s["streamed_price_by_product"] = tiers + _BY_PRODUCT
    s["streamed_events_by_store"] = tiers + _BY_STORE
    s["stream_versus_batch"] = tiers + """
        SELECT barcode, product_name, CAST(s AS DOUBLE) / 100 AS stream_price,
               CAST(b AS DOUBLE) / 100 AS batch_price, CAST(d AS DOUBLE) / 100 AS difference
        FROM versus"""
    s["reconcile_summary"] = tiers + _SUMMARY
    s["reconcile_widest"] = tiers + _WIDEST.format("d")
    s["reconcile_widest_abs"] = tiers + _WIDEST.format("abs(d) DESC")
    s["cross_tier_sql"] = tiers + """
        SELECT v.barcode, product_name, category, count(*) AS event_count,
               max(v.price) AS highest_price,
               (SELECT min(latest_price) FROM latest WHERE latest.barcode = v.barcode)
                   AS lowest_latest_price
        FROM valid AS v LEFT JOIN products USING (barcode) GROUP BY 1, 2, 3"""
    s["gold_row_counts"] = tiers + f"""
        SELECT 'daily_price_summary' AS model, count(*) AS row_count FROM ({_DAILY})
        UNION ALL SELECT 'streamed_price_by_product', count(*) FROM ({_BY_PRODUCT})
        UNION ALL SELECT 'streamed_events_by_store', count(*) FROM ({_BY_STORE})
        UNION ALL SELECT 'stream_versus_batch', count(*) FROM versus"""
    s["latest_run_summary"] = audited + _LATEST_RUN.format("")
    s["latest_successful_run"] = audited + _LATEST_RUN.format("WHERE status = 'SUCCESS'")
    outcome = audited + """
        SELECT started_at AS run_started, valid_records AS valid, rejected_records AS rejected
        FROM runs"""
    s["run_outcomes"] = outcome + " WHERE status <> 'RUNNING'"
    s["run_timeline"] = outcome
    s["top_rejection_reasons"] = audited + """,
        counted AS (
            SELECT failure_reason, count(*) AS rejected_records
            FROM quarantine WHERE pipeline_run_id IN (SELECT pipeline_run_id FROM runs) GROUP BY 1),
        head AS (FROM counted ORDER BY rejected_records DESC, failure_reason LIMIT 7)
        FROM head
        UNION ALL
        SELECT 'Other', CAST(sum(rejected_records) AS BIGINT)
        FROM counted ANTI JOIN head USING (failure_reason) HAVING count(*) > 0"""
    s["rejections_by_dataset"] = audited + """
        SELECT upper(dataset_name[1]) || dataset_name[2:] AS dataset, count(*) AS rejected_records
        FROM quarantine JOIN runs USING (pipeline_run_id) GROUP BY 1"""
    s["average_price"] = f"{base} {_AVERAGE}"
    s["promotion_share"] = f"""{base}
        SELECT {_percent('count(*) FILTER (promotion)', 'count(*)', 1)} AS promotion_share
        FROM prices"""
    s["promotion_saving"] = f"""{base},
        t AS (SELECT sum(c) FILTER (NOT promotion) AS a, count(*) FILTER (NOT promotion) AS m,
                     sum(c) FILTER (promotion) AS b, count(*) FILTER (promotion) AS n FROM prices),
        u AS (SELECT CAST(a AS HUGEINT) * n AS whole, CAST(b AS HUGEINT) * m AS part FROM t)
        SELECT {_percent('(whole - part)', 'whole', 1)} AS promotion_saving FROM u"""
    s["widest_spread"] = f"""{base}
        SELECT CAST(max(spread) AS DOUBLE) / 100 AS widest_spread
        FROM (SELECT max(c) - min(c) AS spread FROM prices GROUP BY barcode
              HAVING count(DISTINCT store_id) > 1)"""
    s["price_distribution"] = f"""{base},
        banded AS (SELECT CASE WHEN c < 0 THEN 0 WHEN c >= 2500 THEN 11 ELSE c * 10 // 2500 + 1 END
                          AS bucket FROM prices)
        SELECT concat(CAST(CAST((bucket - 1) * 2.5 AS DECIMAL(6, 1)) AS VARCHAR), ' - ',
                      CAST(CAST(bucket * 2.5 AS DECIMAL(6, 1)) AS VARCHAR)) AS price_band,
               count(*) AS price_records
        FROM banded GROUP BY bucket"""
    s["price_histogram_auto"] = f"""{base},
        bounds AS (SELECT min(c) AS lo, max(c) AS hi FROM prices),
        banded AS (SELECT CASE WHEN hi = lo THEN 1 WHEN c >= hi THEN 11
                               ELSE (c - lo) * 10 // nullif(hi - lo, 0) + 1 END AS band, lo, hi
                   FROM prices, bounds)
        SELECT band, min((lo + CAST((band - 1) * (hi - lo) AS DOUBLE) / 10) / 100) AS floor,
               count(*) AS price_records
        FROM banded GROUP BY band"""
    s["price_by_store"] = f"""{base}
        SELECT store_name || ' (' || city || ')' AS store,
               {_mean('sum(c)', 'count(*)')} AS average_price, min(price) AS minimum_price,
               max(price) AS maximum_price, count(*) AS price_records
        FROM prices JOIN stores USING (store_id) GROUP BY store_name, city"""
    s["promotion_vs_normal"] = f"""{base}
        SELECT CASE WHEN promotion THEN 'Promotion' ELSE 'Normal' END AS price_type,
               {_mean('sum(c)', 'count(*)')} AS average_price, count(*) AS price_records
        FROM prices GROUP BY promotion"""
    s["shopping_around"] = by_name + f"""
               min(price) AS cheapest_price, max(price) AS highest_price,
               CAST(max(c) - min(c) AS DOUBLE) / 100 AS spread,
               {_percent('(max(c) - min(c))', 'max(c)', 0)} AS saving_pct
        FROM prices JOIN products USING (barcode) GROUP BY product_name
        HAVING count(DISTINCT store_id) > 1 ORDER BY 4 DESC, 1 LIMIT 15"""
    s["cheapest_products"] = by_name + f"""
               brand, {label} AS category, min(price) AS cheapest_price
        FROM prices JOIN products USING (barcode) GROUP BY product_name, brand, products.category
        ORDER BY 4, 1, 2, 3 LIMIT 20"""
    s["most_expensive_products"] = by_name + """
               brand, max(price) AS highest_price
        FROM prices JOIN products USING (barcode) GROUP BY product_name, brand
        ORDER BY 3 DESC, 1, 2 LIMIT 20"""
    s["stock_status"] = f"""{base}
        SELECT {status_label} AS stock_status, count(*) AS price_records,
               {_mean('sum(c)', 'count(*)')} AS average_price
        FROM prices GROUP BY prices.stock_status"""
    s["price_by_category"] = f"""{base}
        SELECT {label} AS category, {_mean('sum(c)', 'count(*)')} AS average_price,
               count(*) AS price_records
        FROM prices JOIN products USING (barcode) GROUP BY products.category"""
    s["price_by_brand"] = f"""{base}
        SELECT brand, {_mean('sum(c)', 'count(*)')} AS average_price, count(*) AS price_records
        FROM prices JOIN products ON brand IS NOT NULL AND prices.barcode = products.barcode
        GROUP BY brand HAVING count(*) >= 5 ORDER BY 2 DESC, 1 LIMIT 15"""
    s["missing_nutrition"] = f"""{base}
        SELECT barcode, product_name AS product, brand, {label} AS category
        FROM products WHERE energy_kcal_100g IS NULL"""
    s["date_filtered_prices"] = f"""{base}
        SELECT event_id, barcode, store_id, price, event_timestamp FROM prices
        WHERE event_timestamp >= TIMESTAMP '1999-01-01' AND event_timestamp < TIMESTAMP '2000-01-01'"""
    s["average_price_last_days"] = f"""{base} {_AVERAGE}
        WHERE event_timestamp >= TIMESTAMP '2001-06-15' - INTERVAL 400 DAY
          AND event_timestamp < TIMESTAMP '2001-06-15'"""
    s["clean_products"] = f"""WITH {products}
        SELECT code AS barcode, name AS product_name, brands AS brand, categories_tags[1] AS category,
               trim(ingredients_text, ' ' || chr(9)) AS ingredients_text,
               CAST(energy_kcal_100g AS DOUBLE) AS energy_kcal_100g,
               to_timestamp(CAST(last_modified_t AS BIGINT)) AT TIME ZONE 'UTC' AS source_modified_at
        FROM ruled WHERE code <> '' AND name <> '' AND name <> code"""
    s["semantic_verdicts"] = f"""WITH {products}
        SELECT row_pos, code AS barcode, CASE WHEN accepted THEN 'pass' ELSE 'reject' END AS status,
               CASE WHEN accepted THEN 0.95::DOUBLE ELSE 0.99::DOUBLE END AS confidence,
               array_to_string(reasons, '; ') AS reasons,
               'deterministic-semantic-rules' AS validator
        FROM decided_products"""
    s["gated_products"] = gate + """
        SELECT row_pos, code AS barcode, status, confidence, validator, accepted, failure_reason
        FROM gated"""
    s["upsert_products"] = effect + """,
        earlier AS (
            SELECT code AS barcode, TIMESTAMP '2020-01-01' AS created_at
            FROM ruled WHERE name <> '' AND name <> code),
        next AS (
            SELECT barcode, e.product_name, e.brand, e.category, e.ingredients_text,
                   e.energy_kcal_100g, e.source_modified_at,
                   CASE WHEN NOT removed AND o.created_at IS NOT NULL THEN o.created_at
                        ELSE TIMESTAMP '2026-01-01' END AS created_at,
                   TIMESTAMP '2026-01-01' AS updated_at
            FROM effect AS e LEFT JOIN earlier AS o USING (barcode) WHERE present)
        SELECT * FROM next
        UNION ALL
        SELECT CAST(p_partkey AS VARCHAR), 'Old ' || p_brand, p_brand, 'unknown', NULL, NULL, NULL,
               TIMESTAMP '2020-01-01', TIMESTAMP '2020-01-01'
        FROM part WHERE p_partkey % 11 = 5 AND p_partkey % 25 NOT IN (0, 1)"""
    s["retract_products"] = effect + """
        SELECT event_id, barcode, store_id, price FROM prices
        WHERE barcode NOT IN (SELECT barcode FROM effect WHERE removed)"""
    raw = ", ".join(("event_id", "barcode", "store_id", "price", "promotion", "stock_status",
                     "event_timestamp"))
    s["validate_prices"] = f"""{base}
        SELECT pipeline_run_id, {raw}, CAST(len(failures) AS INTEGER) AS failure_count,
               failure_reason, accepted
        FROM decided_prices"""
    started = "CAST(CASE WHEN pipeline_run_id[7:7] = '1' " \
              "THEN make_date(CAST(pipeline_run_id[1:4] AS INTEGER), 7, 1) " \
              "ELSE make_date(CAST(pipeline_run_id[1:4] AS INTEGER) + 1, 1, 1) END AS TIMESTAMP)"
    s["accepted_prices"] = f"""{base}
        SELECT event_id, barcode, store_id, price, promotion, stock_status, event_timestamp,
               {started} AS loaded_at
        FROM prices WHERE NOT event_timestamp < TIMESTAMP '1998-01-01'"""
    s["quarantine_rows"] = f"""{audited}
        SELECT pipeline_run_id, dataset_name, failure_reason, raw_record, {started} AS quarantined_at
        FROM quarantine"""
    s["run_reconciliation"] = audited + """
        SELECT *, source_records = valid_records + rejected_records AS reconciled FROM per_dataset"""
    s["batch_run"] = audited + """
        SELECT 'SUCCESS' AS status, CAST(sum(source_records) AS BIGINT) AS source_records,
               CAST(sum(valid_records) AS BIGINT) AS valid_records,
               CAST(sum(rejected_records) AS BIGINT) AS rejected_records,
               CAST(0 AS BIGINT) AS already_loaded
        FROM per_dataset"""
    s["batch_silver_prices"] = f"""{base}
        SELECT event_id, barcode, store_id, price, promotion, stock_status, event_timestamp,
               TIMESTAMP '2026-01-01' AS loaded_at
        FROM prices"""
    s["batch_silver_products"] = f"""WITH {products}
        SELECT * EXCLUDE (pipeline_run_id), TIMESTAMP '2026-01-01' AS created_at,
               TIMESTAMP '2026-01-01' AS updated_at
        FROM products"""
    s |= _load_statements(base)
    s["prices_of_barcode"] = f"""{base}
        SELECT event_id, barcode, store_id, price, event_timestamp FROM prices WHERE barcode = '5'
        AND event_timestamp >= TIMESTAMP '1993-01-01' AND event_timestamp < TIMESTAMP '1998-01-01'"""
    s["prices_of_store"] = f"""{base}
        SELECT event_id, barcode, store_id, price, event_timestamp FROM prices WHERE store_id = '3'
        AND event_timestamp >= TIMESTAMP '1995-01-01' AND event_timestamp < TIMESTAMP '1996-01-01'"""
    s["batch_quarantine"] = audited + """
        SELECT dataset_name, failure_reason, count(*) AS rejected_records
        FROM quarantine GROUP BY 1, 2"""
    s["verdict_report"] = f"""WITH {products},
        told AS (SELECT code, CASE WHEN row_pos % 25 IN (0, 1, 2) THEN 'reject' ELSE 'pass' END AS status FROM raw_products)
        SELECT status, 'deterministic-semantic-rules' AS validator, count(*) AS verdicts, count(DISTINCT code) AS barcodes,
               CASE WHEN status = 'pass' THEN 0.95::DOUBLE ELSE 0.99::DOUBLE END AS least_confidence,
               count(*) FILTER (status = 'reject') AS with_reasons, CAST(0 AS BIGINT) AS without_time
        FROM told GROUP BY status"""
    s["product_expectations"] = f"WITH {products} " + _expect("products", [
        ("barcode_not_null", "code IS NULL"),
        ("product_name_not_null", "product_name IS NULL"),
        ("energy_kcal_100g_in_range", "TRY_CAST(energy_kcal_100g AS DOUBLE) NOT BETWEEN 0 AND 1000"),
    ], "raw_products")
    copies = "event_id IS NOT NULL AND n > 1"
    counted = "(SELECT *, count(*) OVER (PARTITION BY event_id) AS n FROM raw_prices)"
    s["price_expectations"] = f"{base} " + _expect("prices", [
        ("event_id_not_null", "event_id IS NULL"), ("event_id_unique", copies),
        ("price_in_range", "p <= 0 OR p >= 500"), ("price_positive", "p <= 0"),
        ("price_below_limit", "p >= 500"),
        ("store_id_known", "store_id NOT IN (SELECT store_id FROM stores)"),
        ("event_timestamp_not_null", "event_timestamp IS NULL")], counted)
    s["gold_not_null_tests"] = f"{base}, daily AS ({_DAILY}) " + _expect("daily_price_summary", [
        (f"{c}_not_null", f"{c} IS NULL")
        for c in ("price_date", "barcode", "product_name", "minimum_price")], "daily")
    s["constraint_violations"] = f"{base} " + _expect("prices", [
        ("event_id_primary_key", copies), ("event_id_not_null", "event_id IS NULL"),
        ("event_id_uuid", "NOT regexp_full_match(event_id, '[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}')"),
        ("barcode_not_null", "barcode IS NULL"),
        ("barcode_references_products", "barcode NOT IN (SELECT barcode FROM products)"),
        ("store_id_not_null", "store_id IS NULL"),
        ("store_id_references_stores", "store_id NOT IN (SELECT store_id FROM stores)"),
        ("price_not_null", "p IS NULL"), ("price_positive", "p <= 0"),
        ("stock_status_not_null", "stock_status IS NULL"),
        ("event_timestamp_not_null", "t IS NULL")], counted) + " UNION ALL " + _expect("products", [
            ("barcode_primary_key", "barcode IS NOT NULL AND n > 1"), ("barcode_not_null", "barcode IS NULL"),
            ("product_name_not_null", "product_name IS NULL")],
            """(SELECT *, count(*) OVER (PARTITION BY barcode) AS n FROM (
                SELECT CASE WHEN k % 50 <> 11 THEN barcode END AS barcode,
                       CASE WHEN k % 50 <> 9 THEN product_name END AS product_name
                FROM (SELECT *, CAST(barcode AS BIGINT) AS k FROM products)
                UNION ALL SELECT barcode, product_name FROM products WHERE CAST(barcode AS BIGINT) % 50 = 7))""") \
        + " UNION ALL " + _expect("verdicts", [
            ("status_enum", "m = 3"), ("confidence_range", "m = 5"),
            ("validator_not_null", "m = 7")], "(SELECT row_pos % 40 AS m FROM decided_products)")
    s["source_freshness"] = tiers + f""",
        newest AS (
            SELECT 'silver.prices' AS source, max({started}) AS max_loaded_at FROM prices
            UNION ALL SELECT 'silver.products', max({started}) FROM products
            UNION ALL SELECT 'audit.quarantine', greatest(
                (SELECT max({started}) FROM decided_prices WHERE NOT accepted),
                (SELECT max({started}) FROM decided_products WHERE NOT accepted))
            UNION ALL SELECT 'lake.price_events', max(event_time) FROM valid)
        SELECT source, max_loaded_at, CAST(epoch(TIMESTAMP '2026-01-01') AS BIGINT)
               - CAST(floor(epoch(max_loaded_at)) AS BIGINT) AS age_seconds
        FROM newest"""
    event = "event_id, barcode, store_id, price, currency, promotion, stock_status, event_time"
    s["stream_valid"] = f"{tiers} SELECT {event} FROM valid"
    s["stream_invalid"] = f"""{tiers}
        SELECT {event}, validation_error FROM lake WHERE validation_error IS NOT NULL"""
    s["stream_latest_price"] = f"{tiers} SELECT * FROM latest"
    again = "(SELECT *, event_time <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES AS late FROM lake WHERE event_id::BIGINT % 20 = 0)"
    s["stream_late"] = f"{tiers} SELECT {event}, 'late event' AS validation_error FROM {again} WHERE late"
    s["stream_accounting"] = f"""{tiers},
        again AS (SELECT count(*) FILTER (late) AS late, count(*) FILTER (NOT late) AS copies FROM {again})
        SELECT count(*) + any_value(late + copies) AS input_rows,
               count(*) FILTER (validation_error IS NULL) AS valid_rows,
               count(*) FILTER (validation_error IS NOT NULL) AS invalid_rows,
               CAST(any_value(late) AS BIGINT) AS late_rows, CAST(any_value(copies) AS BIGINT) AS duplicate_rows, TRUE AS reconciled
        FROM lake, again"""
    s["layer_counts"] = f"""{audited}, {_STREAM} {_LAYERS}
        UNION ALL SELECT 'lake.price_events', count(*) FROM valid
        UNION ALL SELECT 'lake.latest_price', count(*) FROM latest"""
    s["warehouse_figures"] = f"{audited}, {_FIGURES} SELECT * FROM figures"
    s["figure_drift"] = f"""{audited}, {_FIGURES}
        SELECT 'silver.prices' AS metric, '0 rows' AS published, value AS recomputed, 'stale' AS state
        FROM figures WHERE metric = 'silver.prices'
        UNION ALL SELECT metric, NULL, value, 'missing' FROM figures WHERE metric = 'audit.runs'
        UNION ALL SELECT 'retired.figure', value, NULL, 'extra' FROM figures
        WHERE metric = 'audit.runs'"""
    s["stream_figures"] = f"""{tiers}, summary AS ({_SUMMARY})
        SELECT 'stream.events' AS metric, CAST(count(*) AS VARCHAR) AS value FROM valid
        UNION ALL SELECT 'stream.latest_rows', CAST(count(*) AS VARCHAR) FROM latest
        UNION ALL SELECT 'stream.products', CAST(count(*) AS VARCHAR) FROM ({_BY_PRODUCT})
        UNION ALL SELECT 'stream.stores', CAST(count(*) AS VARCHAR) FROM ({_BY_STORE})
        UNION ALL SELECT 'stream.both_routes', CAST(both_routes AS VARCHAR) FROM summary
        UNION ALL SELECT 'stream.within_dollar', CAST(within_one AS VARCHAR) FROM summary
        UNION ALL SELECT 'stream.cheaper', CAST(cheaper AS VARCHAR) FROM summary
        UNION ALL SELECT 'stream.median_gap', CAST(CAST(median_gap AS DECIMAL(20, 2)) AS VARCHAR) FROM summary
        UNION ALL SELECT 'stream.avg_batch', CAST(CAST(avg_batch AS DECIMAL(20, 2)) AS VARCHAR) FROM summary
        UNION ALL SELECT 'stream.avg_stream', CAST(CAST(avg_stream AS DECIMAL(20, 2)) AS VARCHAR) FROM summary"""
    return s


def _load_statements(base: str) -> dict[str, str]:
    """Three loads into one root: what each accepts by itself, and what is left of it in the end."""
    def accepted(k: int, quarters: str, at: str) -> str:
        return f"""
        own{k} AS (
            SELECT *, coalesce(event_id IS NOT NULL AND barcode IN (SELECT barcode FROM known{k})
                   AND store_id IN (SELECT store_id FROM stores) AND p > 0 AND p <= 500
                   AND t <= TIMESTAMP '{at}' + INTERVAL 5 MINUTE, FALSE) AS ok
            FROM files WHERE quarter IN ({quarters})),
        accepted{k} AS (
            SELECT *, TIMESTAMP '{at}' AS loaded_at FROM own{k} WHERE ok
            QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY row_pos) = 1)"""
    loads = f"""{base},
        files AS (
            SELECT r.*, k.l_orderkey % 4 AS quarter
            FROM raw_prices AS r JOIN (SELECT row_pos, l_orderkey FROM faulty) AS k USING (row_pos)),
        known1 AS (SELECT barcode FROM products),
        known2 AS (SELECT barcode FROM products WHERE CAST(barcode AS BIGINT) % 14 <> 3),
        known3 AS (SELECT barcode FROM known2 UNION ALL SELECT code FROM raw_products WHERE row_pos % 14 = 3),
        {accepted(1, "0, 1", "2026-01-01")}, {accepted(2, "1, 2", "2026-01-01")}, {accepted(3, "2, 3, 0", "2025-06-01")},
        left1 AS (SELECT * FROM accepted1 WHERE CAST(barcode AS BIGINT) % 14 <> 3),
        new2 AS (SELECT * FROM accepted2 WHERE event_id NOT IN (SELECT event_id FROM left1)),
        left2 AS (SELECT * FROM left1 UNION ALL SELECT * FROM new2),
        new3 AS (SELECT * FROM accepted3 WHERE event_id NOT IN (SELECT event_id FROM left2)),
        odd AS (SELECT *, row_pos % 25 IN (0, 1, 2) OR row_pos % 14 = 3 AS bad FROM raw_products WHERE row_pos % 2 = 1)"""

    def totals(k: int, products: str, bad: str, new: str) -> str:
        return f"""
        SELECT CAST({k} AS BIGINT) AS commit_seq, 'SUCCESS' AS status, n + (SELECT count(*) FROM own{k}) AS source_records,
               n - bad + (SELECT count(*) FROM {new}) AS valid_records,
               bad + (SELECT count(*) FROM own{k}) - (SELECT count(*) FROM accepted{k}) AS rejected_records,
               (SELECT count(*) FROM accepted{k}) - (SELECT count(*) FROM {new}) AS already_loaded
        FROM (SELECT count(*) AS n, count(*) FILTER ({bad}) AS bad FROM {products})"""
    return {
        "batch_runs_totals": loads + totals(1, "raw_products", "row_pos % 25 IN (0, 1, 2)", "accepted1") + " UNION ALL "
        + totals(2, "odd", "bad", "new2") + " UNION ALL "
        + totals(3, "(SELECT * FROM raw_products WHERE row_pos % 14 = 3)", "FALSE", "new3"),
        "batch_runs_silver_prices": loads + """
            SELECT event_id, barcode, store_id, p AS price, promotion = 'True' AS promotion, stock_status,
                   t AS event_timestamp, loaded_at
            FROM (SELECT * FROM left2 UNION ALL SELECT * FROM new3)""",
        "batch_runs_silver_products": loads + """
            SELECT barcode, product_name, TIMESTAMP '2026-01-01' AS created_at
            FROM products WHERE CAST(barcode AS BIGINT) % 14 <> 3
            UNION ALL SELECT code, 'Back again', TIMESTAMP '2025-06-01' FROM raw_products WHERE row_pos % 14 = 3""",
        "batch_landed_prices": loads + """
            SELECT count(*) AS landed_rows, count(barcode) AS with_barcode, CAST(3 AS BIGINT) AS runs
            FROM (SELECT barcode FROM own1 UNION ALL SELECT barcode FROM own2 UNION ALL SELECT barcode FROM own3)""",
        "batch_verdicts": loads + """
            SELECT CASE WHEN bad THEN 'reject' ELSE 'pass' END AS status, count(*) AS verdicts,
                   count(DISTINCT code) AS barcodes
            FROM (SELECT code, row_pos % 25 IN (0, 1, 2) AS bad FROM raw_products
                  UNION ALL SELECT code, bad FROM odd
                  UNION ALL SELECT code, FALSE FROM raw_products WHERE row_pos % 14 = 3) GROUP BY 1""",
    }


def oracle_sql() -> dict[str, str]:
    return _statements()
