"""Source-shaped views over the test tables, in SQL that Spark and DuckDB both understand.

Every view keeps all rows of its table, so all queries built on them grow with the data. A third of
the customers share one mailbox, some ids are blank or known to one side only, some dates are
malformed, padded or written without hyphens.
"""

from __future__ import annotations

import re
from datetime import date, datetime

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SALT = "workload-salt"
BATCH_ID = "batch-1"
AS_OF = date(2025, 1, 1)
RUN_TS = datetime(2025, 1, 1)

_KEY = "CAST(c_custkey AS STRING)"
_SERIAL = f"LPAD({_KEY}, 6, '0')"
_BIRTH = (
    "CONCAT(CAST(1950 + c_custkey % 50 AS STRING), '-', "
    "LPAD(CAST(1 + c_custkey % 12 AS STRING), 2, '0'), '-', "
    "LPAD(CAST(1 + c_custkey % 28 AS STRING), 2, '0'))"
)
_EVENT = """CASE WHEN c_custkey % 37 = 0 THEN 'not-a-date'
    WHEN c_custkey % 31 = 0 THEN NULL
    WHEN c_custkey % 41 = 0 THEN '20190704'
    WHEN c_custkey % 43 = 0 THEN '  2019-12-31T05:00:00Z '
    WHEN c_custkey % 47 = 0 THEN '2016'
    WHEN c_custkey % 5 = 0 THEN '2018-03-01T08:00:00Z'
    WHEN c_custkey % 5 = 1 THEN '2020-01-03'
    ELSE '2024-11-30T23:30:00Z' END"""
_ARRIVED = """CASE WHEN c_custkey % 17 = 0 THEN '2015-01-01T00:00:00Z'
    ELSE '2024-06-01T00:00:00Z' END"""

VIEWS = {
    "crm": f"""
SELECT CASE WHEN c_custkey % 29 = 0 THEN '  ' ELSE CONCAT('CRM-', {_KEY}) END AS crm_customer_id,
  CONCAT('  Odo', CAST(c_custkey % 97 AS STRING)) AS first_name,
  CASE c_custkey % 7 WHEN 0 THEN CONCAT('Krämer  ', {_KEY})
    WHEN 1 THEN CONCAT('Łoś-', {_KEY}) ELSE CONCAT('Vrba  ', {_KEY}) END AS last_name,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN '  '
    WHEN c_custkey % 3 = 2 THEN ' Office@Example.COM'
    ELSE CONCAT(' User', {_KEY}, '@Example.COM ') END AS email,
  CASE c_custkey % 5 WHEN 0 THEN CONCAT('+48 733 ', {_SERIAL})
    WHEN 1 THEN CONCAT('733', {_SERIAL}) WHEN 2 THEN CONCAT('0048 733', {_SERIAL}, REPEAT('7', c_custkey % 3 * 60))
    WHEN 3 THEN 'n/a' ELSE NULL END AS phone,
  {_BIRTH} AS date_of_birth,
  CONCAT('Lipová tř. ', CAST(c_custkey % 40 AS STRING)) AS street,
  CONCAT(LPAD(CAST(c_nationkey AS STRING), 2, '0'), '-',
    LPAD(CAST(c_custkey % 1000 AS STRING), 3, '0')) AS postal_code,
  'PL' AS country,
  {_ARRIVED} AS created_at,
  {_EVENT} AS updated_at
FROM customer""",
    "erp": f"""
SELECT CONCAT(CASE c_custkey % 2 WHEN 0 THEN 'ERP-' ELSE 'ERP-X' END, {_KEY}) AS erp_client_id,
  CONCAT('ODO', CAST(c_custkey % 97 AS STRING), ' VRBA ', {_KEY}) AS client_name,
  CASE WHEN c_custkey % 3 = 2 THEN 'OFFICE@EXAMPLE.COM'
    ELSE CONCAT('USER', {_KEY}, '@EXAMPLE.COM') END AS email_address,
  CONCAT('+48733', {_SERIAL}) AS mobile_number,
  {_BIRTH} AS birth_date,
  CONCAT('Lipová ', CAST(c_custkey % 40 AS STRING)) AS street_address,
  CONCAT(LPAD(CAST(c_nationkey AS STRING), 2, '0'),
    LPAD(CAST(c_custkey % 1000 AS STRING), 3, '0')) AS zip_code,
  'PL' AS country_code,
  {_ARRIVED} AS registered_at,
  {_EVENT} AS last_invoice_at
FROM customer""",
    "consents_raw": f"""
SELECT 'CRM' AS source_system,
  CONCAT(CASE WHEN c_custkey % 23 = 0 THEN 'CRM-unknown-' ELSE 'CRM-' END, {_KEY})
    AS source_customer_id,
  CASE c_custkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN '1' WHEN 2 THEN ' YES ' WHEN 3 THEN 'no'
    WHEN 4 THEN 'maybe' ELSE NULL END AS analytics_consent,
  CASE c_custkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'false' ELSE 'true' END AS marketing_consent,
  CASE WHEN c_custkey % 19 = 0 THEN 'not-a-date' ELSE '2024-12-01T10:00:00Z' END
    AS consent_updated_at
FROM customer
UNION ALL
SELECT ' erp ' AS source_system,
  CONCAT(CASE c_custkey % 2 WHEN 0 THEN 'ERP-' ELSE 'ERP-Y' END, {_KEY}) AS source_customer_id,
  CASE WHEN c_custkey % 10 = 0 THEN 'N' ELSE 'true' END AS analytics_consent,
  CASE WHEN c_custkey % 8 = 0 THEN '0' ELSE 'yes' END AS marketing_consent,
  '2024-12-02T10:00:00Z' AS consent_updated_at
FROM customer""",
    "consents_repeated": """
SELECT CASE WHEN event_id % 8 = 0 THEN 'erp' ELSE 'CRM' END AS source_system,
  CONCAT(CASE WHEN event_id % 8 = 0 THEN 'ERP-' ELSE 'CRM-' END, CAST(user_id AS STRING))
    AS source_customer_id,
  CASE event_type WHEN 'purchase' THEN 'true' ELSE 'false' END AS analytics_consent,
  CASE event_type WHEN 'click' THEN 'true' ELSE 'false' END AS marketing_consent,
  CAST(ts AS STRING) AS consent_updated_at
FROM events""",
    "deletions_raw": """
SELECT CONCAT('DEL-', CAST(o_orderkey AS STRING)) AS request_id,
  CASE WHEN o_orderkey % 9 = 0 THEN ' erp' ELSE 'CRM' END AS source_system,
  CONCAT(CASE WHEN o_orderkey % 9 = 0 THEN 'ERP-' ELSE 'CRM-' END, CAST(o_custkey AS STRING))
    AS source_customer_id,
  CASE WHEN o_orderkey % 7 = 0 THEN 'soon' ELSE CAST(o_orderdate AS STRING) END AS requested_at,
  CASE WHEN o_orderkey % 4 <> 0 THEN 'Rejected' WHEN o_orderstatus = 'F' THEN ' approved '
    WHEN o_orderstatus = 'P' THEN 'Active' ELSE 'PENDING' END AS status
FROM orders""",
    "policies_raw": """
SELECT CASE s_suppkey % 2 WHEN 0 THEN 'CRM' ELSE ' Erp' END AS source_system,
  CASE s_suppkey WHEN 0 THEN 'CRM_Customers' WHEN 1 THEN 'erp_clients '
    ELSE CONCAT('archive_', CAST(s_suppkey AS STRING)) END AS dataset_name,
  CASE s_suppkey % 2 WHEN 0 THEN 'updated_at' ELSE 'last_invoice_at' END AS date_column,
  CASE WHEN s_suppkey % 7 = 6 THEN 'forever' ELSE CAST(1825 + s_suppkey AS STRING) END
    AS retention_days,
  s_name AS policy_owner
FROM supplier""",
    "concepts": """
SELECT concept_id, concept_name, canonical_field_name, pii_category, description
FROM (VALUES
  ('act', 'last invoice at', 'invoice_day', 'ACTIVITY', 'latest bill'),
  ('bir', 'birth date', 'date_of_birth', 'PERSON', 'when somebody was born'),
  ('cou', 'country', 'nation', 'PLACE', 'state of residence'),
  ('mai', 'email', 'email', 'REACH', 'electronic mailbox'),
  ('nam', 'client', 'full_name', 'PERSON', 'what somebody is called'),
  ('reg', 'created at', 'registered_at', 'ACTIVITY', 'first seen'),
  ('str', 'street address', 'address', 'PLACE', 'road and door'),
  ('tel', 'mobile', 'phone', 'REACH', 'number to call'),
  ('zip', 'zip', 'postal_code', 'PLACE', 'delivery area')
) AS base (concept_id, concept_name, canonical_field_name, pii_category, description)
UNION ALL
SELECT DISTINCT CONCAT(CASE WHEN p_size > 25 THEN 'Q-' ELSE 'P-' END, REPLACE(p_name, ' ', '-'))
    AS concept_id, p_name AS concept_name,
  CONCAT(REPLACE(p_name, ' ', '_'), CASE WHEN p_size > 25 THEN '_id' ELSE '' END)
    AS canonical_field_name,
  'NONE' AS pii_category, 'goods' AS description
FROM part""",
    "column_catalog": """
SELECT LOWER(p_brand) AS source_system, LOWER(p_type) AS table_name,
  CASE WHEN p_partkey % 16 = 0 THEN 'email' WHEN p_partkey % 16 = 1 THEN 'Client Full-Name'
    WHEN p_partkey % 16 = 2 THEN 'birth_date' WHEN p_partkey % 16 = 3 THEN 'date_of_birth'
    WHEN p_partkey % 16 = 4 THEN CONCAT('created at ', CAST(p_size AS STRING))
    WHEN p_partkey % 16 = 5 THEN 'ZIP' WHEN p_partkey % 16 = 6 THEN ' postal code '
    WHEN p_partkey % 16 = 7 THEN '_batch' WHEN p_partkey % 16 = 8 THEN 'mobile_no'
    WHEN p_partkey % 16 = 9 THEN CONCAT('email_address_', CAST(p_size AS STRING))
    WHEN p_partkey % 16 = 10 THEN '%%' WHEN p_partkey % 16 = 11 THEN 'addr'
    WHEN p_partkey % 16 = 12 THEN p_name WHEN p_partkey % 16 = 13 THEN CONCAT(p_name, ' id')
    WHEN p_partkey % 16 = 14 THEN 'id'
    ELSE CONCAT('phone ', CAST(p_partkey AS STRING)) END AS column_name,
  p_partkey AS row_count, p_retailprice / 4096 AS null_rate, p_partkey % 1000 AS distinct_count,
  p_retailprice / 8192 AS distinct_rate
FROM part""",
    "labelled_pairs": f"""
SELECT 'crm' AS left_source_system, CONCAT('CRM-', {_KEY}) AS left_source_record_id,
  'erp' AS right_source_system,
  CONCAT(CASE c_custkey % 2 WHEN 0 THEN 'ERP-' ELSE 'ERP-X' END, {_KEY}) AS right_source_record_id,
  'MATCH' AS expected_decision
FROM customer
UNION ALL
SELECT 'crm' AS left_source_system, CONCAT('CRM-', {_KEY}) AS left_source_record_id,
  'erp' AS right_source_system,
  CASE c_custkey % 3 WHEN 0 THEN 'ERP-2' ELSE CONCAT('ERP-gone-', {_KEY}) END
    AS right_source_record_id,
  'NO_MATCH' AS expected_decision
FROM customer""",
}


def used_names(sql: str, names) -> list[str]:
    """Names that occur as identifiers in the text."""
    return [name for name in names if re.search(rf"\b{name}\b", sql)]
