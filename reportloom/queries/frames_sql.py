"""The report-shaped frames of ``reportloom.frames`` as SQL, for the checks."""

from __future__ import annotations

FEED_OF_EVENT = """CASE event_id % 4 WHEN 0 THEN 'app_version' WHEN 1 THEN 'device'
    WHEN 2 THEN 'os_version' ELSE 'overview' END"""
TENANT_OF_USER = "CASE WHEN user_id % 2 = 0 THEN 'tenant_a' ELSE 'tenant_b' END"

SALES_RAW = """sales_raw AS (
  SELECT 'GPA.' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '-' || CAST(o_orderkey % 10 AS VARCHAR) AS c0,
    strftime(o_orderdate, '%Y-%m-%d') AS c1,
    format('{:,}', o_orderkey * 1000 + 7) AS c2,
    o_orderstatus AS c3,
    'Item, ' || o_orderpriority AS c4,
    CAST(o_orderkey % 100 AS VARCHAR) || '% off' AS c5,
    CASE WHEN o_orderkey % 3 = 0 THEN 'com.example.keep' ELSE 'com.example.other' END AS c6,
    CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '  ' ELSE 'x ' END AS c7,
    'sku-' || CAST(o_custkey AS VARCHAR) AS c8,
    'USD' AS c9,
    format('{:,}', CAST(round(o_totalprice * 100) AS BIGINT)) AS c10,
    '1,234.50' AS c11,
    CAST(o_orderkey % 20 AS VARCHAR) || '%' AS c12,
    'City, ' || CAST(o_orderkey % 7 AS VARCHAR) AS c13,
    'ST%' AS c14,
    lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS c15,
    '50% Land, North' AS c16,
    'beyond' AS c17,
    'the width' AS c18,
    CASE WHEN o_orderkey % 2 = 0 THEN 'tenant_a' ELSE 'tenant_b' END AS tenant,
    o_orderkey
  FROM orders)"""

_SALES_NUMBER = "replace(replace({0}, ',', ''), '%', '')"
_SALES_TEXT = "CASE WHEN regexp_matches({0}, '^\\s*$') THEN NULL ELSE replace({0}, '%', '') END"

SALES_COOKED = (
    SALES_RAW
    + f""", sales_cooked AS (
  SELECT md5(replace(c0, '-', '') || c3) AS sale_key,
    c0 AS order_number, CAST(c1 AS DATE) AS order_date,
    CAST({_SALES_NUMBER.format('c2')} AS BIGINT) AS order_timestamp,
    c3 AS financial_status,
    {_SALES_TEXT.format('c4')} AS device_model,
    {_SALES_TEXT.format('c5')} AS product_title,
    {_SALES_TEXT.format('c6')} AS product_id,
    {_SALES_TEXT.format('c7')} AS product_type,
    {_SALES_TEXT.format('c8')} AS sku_id,
    {_SALES_TEXT.format('c9')} AS currency,
    CAST({_SALES_NUMBER.format('c10')} AS DECIMAL(18,2)) AS item_price,
    CAST({_SALES_NUMBER.format('c11')} AS DECIMAL(18,2)) AS taxes,
    CAST({_SALES_NUMBER.format('c12')} AS DECIMAL(18,2)) AS charged_amount,
    {_SALES_TEXT.format('c13')} AS buyer_city,
    {_SALES_TEXT.format('c14')} AS buyer_state,
    {_SALES_TEXT.format('c15')} AS buyer_postal_code,
    {_SALES_TEXT.format('c16')} AS buyer_country,
    tenant
  FROM sales_raw)"""
)

CRASH_RAW = f"""crash_events AS (
  SELECT strftime(ts, '%Y-%m-%d') AS c0, 'com.example.' || event_type AS c1,
    'Model, ' || CAST(user_id % 20 AS VARCHAR) || '%' AS dimension,
    format('{{:,}}', event_id * 1000 + user_id) AS crashes,
    CAST(event_id % 100 AS VARCHAR) || '%' AS anrs,
    {FEED_OF_EVENT} AS feed, {TENANT_OF_USER} AS tenant, event_id, event_type
  FROM events),
crash_raw AS (
  SELECT c0, c1,
    CASE WHEN feed = 'overview' THEN crashes ELSE dimension END AS c2,
    CASE WHEN feed = 'overview' THEN anrs ELSE crashes END AS c3,
    CASE WHEN feed = 'overview' THEN NULL ELSE anrs END AS c4,
    feed, tenant, event_id, event_type
  FROM crash_events)"""

CRASH_COOKED = (
    CRASH_RAW
    + """, crash_cooked AS (
  SELECT CAST(c0 AS DATE) AS crash_date, c1 AS package_name,
    CASE WHEN feed <> 'overview' THEN replace(dimension, '%', '') END AS dimension,
    CAST(replace(crashes, ',', '') AS BIGINT) AS daily_crashes,
    CAST(replace(anrs, '%', '') AS DECIMAL(18,2)) AS daily_anrs,
    tenant, feed
  FROM crash_events)"""
)

CRASH_KEYS = f"""crash_keys AS (
  SELECT DISTINCT {FEED_OF_EVENT} AS feed, CAST(ts AS DATE) AS report_date,
    {TENANT_OF_USER} AS tenant
  FROM events)"""

PUBLISHED = (
    CRASH_KEYS
    + """, published AS (
  SELECT * FROM crash_keys
  WHERE report_date <= DATE '2024-01-20'
    AND NOT (feed = 'device' AND report_date = DATE '2024-01-20' AND tenant = 'tenant_b'))"""
)

INSTALLS_RAW = f"""installs_raw AS (
  SELECT strftime(ts, '%Y-%m-%d') AS c0,
    CASE WHEN event_id % 2 = 0 THEN 'com.example.KEEP' ELSE 'com.example.other' END AS c1,
    'Land, ' || CAST(user_id % 30 AS VARCHAR) AS c2,
    format('{{:,}}', event_id * 10) AS c3,
    CAST(user_id AS VARCHAR) AS c4,
    {TENANT_OF_USER} AS tenant, event_type
  FROM events)"""

EARNINGS_RAW = """earnings_raw AS (
  SELECT 'GPA.' || CAST(o_orderkey AS VARCHAR) AS description,
    strftime(o_orderdate, '%b %-d, %Y') AS transaction_date,
    '1:02:03 AM PST' AS transaction_time,
    CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '  ' ELSE 'VAT' END AS tax_type,
    CASE WHEN o_orderstatus = 'F' THEN 'Charge' ELSE 'Charge refund' END AS transaction_type,
    '' AS refund_type,
    'The "best", ' || o_orderpriority AS product_title,
    CASE WHEN o_orderkey % 3 = 0 THEN 'com.example.keep' ELSE 'com.example.other' END AS product_id,
    'inapp' AS product_type,
    'sku-' || CAST(o_custkey AS VARCHAR) AS sku_id,
    'pixel' AS hardware, 'US' AS buyer_country, 'CA' AS buyer_state,
    lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS buyer_postal_code,
    'USD' AS buyer_currency,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount_buyer_currency,
    '1.250000' AS currency_conversion_rate,
    'EUR' AS merchant_currency,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount_merchant_currency,
    CASE WHEN o_orderkey % 2 = 0 THEN 'tenant_a' ELSE 'tenant_b' END AS tenant,
    o_orderkey, strftime(o_orderdate, '%Y%m') AS month
  FROM orders)"""

DEVICES = """devices AS (
  SELECT p_brand AS retail_branding, p_name || ', ' || p_type AS marketing_name,
    '"' || p_type || '"' AS device, CAST(p_partkey AS VARCHAR) AS model
  FROM part)"""

OBJECT_NAMES = f"""object_names AS (
  SELECT event_id, CASE event_id % 7
    WHEN 0 THEN 'stats/crashes/crashes_com.example.' || event_type || '_' || strftime(ts, '%Y%m') || '_'
      || CASE (event_id // 7) % 4 WHEN 0 THEN 'app_version' WHEN 1 THEN 'device'
           WHEN 2 THEN 'os_version' ELSE 'overview' END || '.csv'
    WHEN 1 THEN 'stats/installs/installs_com.example.' || event_type || '_' || strftime(ts, '%Y%m') || '_country.csv'
    WHEN 2 THEN 'stats/installs/installs_com.example.' || event_type || '_' || strftime(ts, '%Y%m') || '_device.csv'
    WHEN 3 THEN 'sales/salesreport_' || strftime(ts, '%Y%m') || '.zip'
    WHEN 4 THEN 'earnings/earnings_' || strftime(ts, '%Y%m') || '_' || CAST(user_id AS VARCHAR) || '-'
      || CAST(event_id AS VARCHAR) || '.zip'
    WHEN 5 THEN 'old/earnings/earnings_' || strftime(ts, '%Y%m') || '_1-2.zip'
    ELSE 'sales/salesreport_190001.zip' END AS name
  FROM events)"""

LOCAL_NAMES = """local_names AS (
  SELECT event_id, '/device/work/crashes_'
    || CASE (event_id // 5) % 6 WHEN 0 THEN 'app_version' WHEN 1 THEN 'device' WHEN 2 THEN 'os_version'
         WHEN 3 THEN 'overview' WHEN 4 THEN 'os_version_device' ELSE 'other' END
    || '_' || CASE event_id % 5 WHEN 0 THEN 'tenant_a' WHEN 1 THEN 'tenant_b'
         WHEN 2 THEN 'tenant_b_tenant_a' WHEN 3 THEN 'nobody' ELSE 'tenant_a' END
    || '_' || strftime(ts, '%Y%m') || '_' || strftime(ts, '%Y-%m-%d') || '.csv' AS name
  FROM events)"""


def with_frames(frames: str, select: str) -> str:
    return f"WITH {frames}\n{select}"
