"""The registered queries again as plain SQL for DuckDB, written independently of the package."""

from __future__ import annotations

from workloads.adapter import AS_OF, BATCH_ID, RUN_TS, SALT, VIEWS, used_names

RUN = str(RUN_TS)

# --- scalar expressions -------------------------------------------------------------------------

SPACES = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def blank(x):
    return f"NULLIF(TRIM({x}), '')"


def email(x):
    return f"LOWER({blank(x)})"


def phone(x, country="48"):
    digits = f"REGEXP_REPLACE({x}, '\\D+', '', 'g')"
    return f"""CASE WHEN LENGTH({digits}) = 0 THEN NULL
    WHEN TRIM({x}) LIKE '+%' THEN '+' || {digits}
    WHEN LENGTH({digits}) = 9 THEN '+{country}' || {digits}
    WHEN {digits} LIKE '00%' THEN '+' || SUBSTRING({digits}, 3)
    ELSE '+' || {digits} END"""


def text(x):
    return f"NULLIF(LOWER(REGEXP_REPLACE(TRIM({x}), '\\s+', ' ', 'g')), '')"


def postal(x):
    return f"NULLIF(UPPER(REGEXP_REPLACE(TRIM({x}), '\\s+', '', 'g')), '')"


def iso_day(x):
    """Day of an ISO text in extended or basic form, with or without a time of day."""
    clock = "([01][0-9]|2[0-3])(:[0-5][0-9](:[0-5][0-9]([.,][0-9]+)?)?)?"
    zone = "(Z|[+-]([01][0-9]|2[0-3])(:?[0-5][0-9])?)?"
    day = f"LEFT(REPLACE(TRIM({x}), '-', ''), 8)"
    form = f"([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{8}})([T ]{clock}{zone})?"
    return f"""CASE WHEN REGEXP_FULL_MATCH(TRIM({x}), '{form}') THEN
    TRY_CAST(LEFT({day}, 4) || '-' || {day}[5:6] || '-' || {day}[7:8] AS DATE) END"""


def collapsed(x):
    return f"NULLIF(TRIM(REGEXP_REPLACE({x}, '{SPACES}', ' ', 'g')), '')"


def name_key(x):
    plain = f"REGEXP_REPLACE(STRIP_ACCENTS({collapsed(x)}), '[^A-Za-z0-9 -]', '', 'g')"
    return collapsed(f"UPPER({plain})")


def canonical(x):
    return f"NULLIF(LOWER(TRIM({x})), '')"


def hashed(x):
    return f"SHA256('{SALT}||' || {canonical(x)})"


def pseudo(*xs):
    parts = " || '||' || ".join(f"COALESCE({canonical(x)}, '')" for x in xs)
    known = " OR ".join(f"{canonical(x)} IS NOT NULL" for x in xs)
    return f"CASE WHEN {known} THEN 'cust_' || LEFT(SHA256('{SALT}||' || {parts}), 24) END"


def fingerprint(columns):
    parts = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"SHA256(CONCAT_WS('||', {parts}))"


def yes(x):
    return f"COALESCE(LOWER(TRIM({x})) IN ('true', '1', 'yes', 'y'), FALSE)"


def slug(x):
    return f"LOWER(REGEXP_REPLACE(TRIM({x}), '[^a-zA-Z0-9]+', '_', 'g'))"


def type_of(x):
    def has(word):
        return f"CONTAINS(LOWER({x}), '{word}')"

    return f"""CASE WHEN {has("email")} THEN 'email'
    WHEN {has("phone")} OR {has("mobile")} THEN 'phone'
    WHEN {has("birth")} OR {has("dob")} THEN 'date'
    WHEN {has("postal")} OR {has("zip")} THEN 'postal_code'
    WHEN {has("name")} THEN 'name' WHEN {has("address")} THEN 'address'
    WHEN ENDS_WITH(LOWER({x}), '_id') OR LOWER({x}) = 'id' THEN 'identifier'
    ELSE 'unknown' END"""


def tokens(x):
    return f"ARRAY_TO_STRING(LIST_SORT(STRING_SPLIT({collapsed(x)}, ' ')), ' ')"


def similarity(a, b):
    """Longest common subsequence by dynamic programming over lists."""
    left, right = tokens(a), tokens(b)
    return f"""COALESCE(1.0::DOUBLE - (LENGTH({left}) + LENGTH({right}) - 2 * LIST_LAST(LIST_REDUCE(
      LIST_TRANSFORM(STRING_SPLIT({right}, ''), lambda c: [UNICODE(c)]),
      lambda above, c: LIST_REDUCE(
        LIST_TRANSFORM(RANGE(1, LENGTH({left}) + 1), lambda p: [p::INTEGER]),
        lambda done, p: LIST_APPEND(done, GREATEST(
          LIST_LAST(done), above[p[1] + 1],
          above[p[1]] + CASE WHEN UNICODE({left}[p[1]]) = c[1] THEN 1 ELSE 0 END)::INTEGER),
        [0::INTEGER]),
      LIST_TRANSFORM(RANGE(0, LENGTH({left}) + 1), lambda p: 0::INTEGER))))::DOUBLE
      / (LENGTH({left}) + LENGTH({right})), 0.0)"""


def rounded(x, scale=10000.0):
    """Half-even on the exact binary value; the two-product error term settles printed ties."""
    big, sbig = f"({x} * 134217729.0::DOUBLE)", f"({scale}::DOUBLE * 134217729.0::DOUBLE)"
    vh, sh = f"({big} - ({big} - {x}))", f"({sbig} - ({sbig} - {scale}::DOUBLE))"
    vl, sl = f"({x} - {vh})", f"({scale}::DOUBLE - {sh})"
    s = f"({x} * {scale}::DOUBLE)"
    err = f"((({vh} * {sh} - {s}) + {vh} * {sl} + {vl} * {sh}) + {vl} * {sl})"
    over = f"(({s} - FLOOR({s}) - 0.5::DOUBLE) + {err})"
    return f"""(FLOOR({s}) + CASE WHEN {over} > 0 OR ({over} = 0 AND FLOOR({s}) % 2 = 1)
      THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) / {scale}::DOUBLE"""


# --- shared relations ---------------------------------------------------------------------------

CRM = (
    "crm_customer_id first_name last_name email phone date_of_birth street postal_code country "
    "created_at updated_at"
).split()
ERP = (
    "erp_client_id client_name email_address mobile_number birth_date street_address zip_code "
    "country_code registered_at last_invoice_at"
).split()
LINEAGE = ["_source_system", "_source_file", "_ingested_at", "_batch_id", "_record_hash"]


def bronze_sql(view, system, file, columns, arrived):
    return f"""SELECT *, '{system}' AS _source_system, '/landing/{file}' AS _source_file,
    {arrived} AS _ingested_at, '{BATCH_ID}' AS _batch_id, {fingerprint(columns)} AS _record_hash
    FROM {view}"""


def identity_sql(source, system, dataset, key, name, mail, tel, born, code, place):
    std_name, std_mail, std_tel = text(name), email(mail), phone(tel)
    return f"""SELECT '{system}' AS source_system, '{dataset}' AS source_dataset_name,
    {blank(key)} AS source_record_id, {std_name} AS standard_name, {std_mail} AS standard_email,
    {std_tel} AS standard_phone, {blank(born)} AS date_of_birth, {postal(code)} AS postal_code,
    {text(place)} AS address_text, {hashed(std_mail)} AS email_hash,
    {hashed(f"({std_tel})")} AS phone_hash,
    {pseudo(std_mail, f"({std_tel})", std_name, blank(born))} AS customer_pseudo_id,
    _record_hash AS source_record_hash, _source_file, _ingested_at, _batch_id FROM {source}"""


def profile_sql(source, system, table, columns):
    """One global aggregate per column."""

    def one(column):
        c = f'"{column}"'
        s = f"CAST({c} AS VARCHAR)"
        return f"""SELECT '{system}' AS source_system, '{table}' AS table_name,
    '{column}' AS column_name, COUNT(*) AS row_count,
    CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count,
    SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)::DOUBLE / COUNT(*) AS null_rate,
    COUNT(DISTINCT {c}) AS distinct_count, COUNT(DISTINCT {c})::DOUBLE / COUNT(*) AS distinct_rate,
    CAST(MIN(LENGTH({s})) AS INTEGER) AS min_length,
    CAST(MAX(LENGTH({s})) AS INTEGER) AS max_length, AVG(LENGTH({s})) AS avg_length,
    COALESCE((SELECT STRING_AGG(v, ' | ' ORDER BY v) FROM (SELECT DISTINCT {s} AS v FROM {source}
      WHERE {c} IS NOT NULL ORDER BY v LIMIT 5)), '') AS sample_values,
    {type_of(f"'{column}'")} AS inferred_type, '{RUN}' AS profiled_at, '{BATCH_ID}' AS batch_id
    FROM {source}"""

    return "\nUNION ALL ".join(one(c) for c in columns)


def candidates_sql(profile):
    """Every profile row against every concept; the score decides."""
    a, b, c = slug("column_name"), slug("canonical_field_name"), slug("concept_name")
    kind, field = "LOWER(COALESCE(inferred_type, ''))", "LOWER(canonical_field_name)"
    return f"""SELECT p.*, k.*, {a} = {b} AS canonical_exact_match, {a} = {c} AS concept_exact_match,
    CONTAINS({a}, {b}) OR CONTAINS({b}, {a}) AS canonical_partial_match,
    CONTAINS({a}, {c}) OR CONTAINS({c}, {a}) AS concept_partial_match,
    {kind} = {field} OR ({kind} = 'name' AND {field} = 'full_name')
      OR ({kind} = 'date' AND {field} = 'date_of_birth') AS inferred_type_match
    FROM {profile} p CROSS JOIN concepts k WHERE NOT STARTS_WITH(column_name, '_')"""


def scored_sql(flags):
    weights = (
        ("canonical_exact_match", "0.65", "CANONICAL_EXACT"),
        ("concept_exact_match", "0.55", "CONCEPT_EXACT"),
        ("canonical_partial_match", "0.25", "CANONICAL_PARTIAL"),
        ("concept_partial_match", "0.15", "CONCEPT_PARTIAL"),
        ("inferred_type_match", "0.20", "INFERRED_TYPE_MATCH"),
    )
    score = " + ".join(
        f"CASE WHEN {f} THEN {w}::DOUBLE ELSE 0.0::DOUBLE END" for f, w, _ in weights
    )
    why = ", ".join(f"CASE WHEN {f} THEN '{r}' END" for f, _, r in weights)
    return f"""SELECT source_system, table_name, column_name, row_count, null_rate, distinct_count,
    distinct_rate, inferred_type, concept_id, concept_name, canonical_field_name, pii_category,
    description, LEAST(1.0::DOUBLE, {score}) AS mapping_score,
    CONCAT_WS(',', {why}) AS mapping_reason, '{RUN}' AS created_at, '{BATCH_ID}' AS batch_id
    FROM {flags} WHERE LEAST(1.0::DOUBLE, {score}) >= 0.30"""


def decisions_sql(candidates):
    return f"""SELECT source_system, table_name, column_name, concept_id, concept_name,
    canonical_field_name, pii_category, description, mapping_score, mapping_reason,
    CASE WHEN mapping_score >= 0.75 THEN 'AUTO_ACCEPT' WHEN mapping_score >= 0.50
      THEN 'REVIEW_REQUIRED' ELSE 'LOW_CONFIDENCE' END AS decision, created_at, batch_id
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source_system, table_name, column_name
      ORDER BY mapping_score DESC, concept_id) AS place FROM {candidates}) WHERE place = 1"""


def joined_sql(identities):
    return f"""SELECT i.*, c.raw_analytics_consent AS a, c.raw_marketing_consent AS m,
    c.consent_updated_at, d.* EXCLUDE (source_system, source_record_id), r.date_column,
    r.retention_days AS days, r.policy_owner
    FROM {identities} i
    LEFT JOIN consent_status c USING (source_system, source_record_id)
    LEFT JOIN active_deletions d USING (source_system, source_record_id)
    LEFT JOIN retention_policy r ON i.source_system = r.source_system
      AND i.source_dataset_name = r.dataset_name"""


def eligibility_sql(joined):
    valid = "(source_record_id IS NOT NULL AND linked)"
    reasons = """CONCAT_WS(',', CASE WHEN deleted THEN 'DELETION_REQUESTED' END,
      CASE WHEN expired THEN 'RETENTION_EXPIRED' END,
      CASE WHEN NOT valid THEN 'INVALID_IDENTIFIER' END,
      CASE WHEN NOT a1 THEN 'NO_ANALYTICS_CONSENT' END,
      CASE WHEN NOT m1 THEN 'NO_MARKETING_CONSENT' END)"""
    return f"""SELECT source_system, source_dataset_name, source_record_id, customer_pseudo_id,
    email_hash, phone_hash, standard_email, standard_phone, standard_name, date_of_birth,
    postal_code, address_text, a1 AS raw_analytics_consent, m1 AS raw_marketing_consent,
    a1 AND NOT (deleted OR expired OR NOT valid) AS can_process_for_analytics,
    m1 AND NOT (deleted OR expired OR NOT valid) AS can_process_for_marketing,
    deleted AS has_deletion_request, deletion_request_id,
    CAST(deletion_requested_at AS VARCHAR) AS deletion_requested_at, deletion_status,
    retention_days, date_column AS retention_date_column, policy_owner AS retention_policy_owner,
    expired AS retention_expired, source_record_id IS NOT NULL AS has_valid_source_record_id,
    linked AS has_match_identifier, valid AS has_valid_identifier,
    {reasons} AS suppression_reasons,
    NULLIF(SPLIT_PART({reasons}, ',', 1), '') AS suppression_reason,
    a1 AND NOT (deleted OR expired OR NOT valid) AS can_process_for_entity_resolution,
    CAST(consent_updated_at AS VARCHAR) AS consent_updated_at, source_record_hash, _source_file,
    CAST(_ingested_at AS VARCHAR) AS _ingested_at, _batch_id AS batch_id, '{RUN}' AS evaluated_at
    FROM (SELECT *, {valid} AS valid FROM (SELECT *, COALESCE(a, FALSE) AS a1,
      COALESCE(m, FALSE) AS m1, COALESCE(has_deletion_request, FALSE) AS deleted,
      COALESCE(days, 3650) AS retention_days,
      DATE_DIFF('day', CAST(_ingested_at AS DATE), DATE '{AS_OF}') > COALESCE(days, 3650)
        AS expired,
      email_hash IS NOT NULL OR phone_hash IS NOT NULL OR customer_pseudo_id IS NOT NULL AS linked
      FROM {joined}))"""


def events_sql(eligibility):
    return f"""SELECT source_system, source_dataset_name, source_record_id, customer_pseudo_id,
    event_type, 'SUPPRESSION' AS event_category,
    CASE WHEN event_type = 'DELETION_REQUESTED' THEN deletion_request_id END AS related_request_id,
    '{RUN}' AS event_timestamp, batch_id
    FROM (SELECT *, UNNEST(STRING_SPLIT(suppression_reasons, ',')) AS event_type
      FROM {eligibility} WHERE suppression_reasons <> '')"""


CARRIED = (
    "source_system source_record_id standard_name date_of_birth postal_code address_text "
    "email_hash phone_hash"
).split()


APART = """(left_source_system <> right_source_system
    OR left_source_record_id <> right_source_record_id)"""


def packed(x):
    return f"NULLIF(UPPER(REPLACE({collapsed(x)}, ' ', '')), '')"


def both(left, right):
    """The columns of two records side by side."""
    return ", ".join(
        f"{alias}.{c} AS {side}_{c}" for side, alias in (("left", left), ("right", right)) for c in CARRIED
    )


def before(left, right):
    key = "({0}.source_system, {0}.source_record_id)"
    return f"{key.format(left)} < {key.format(right)}"


def links_sql(key):
    """Each record with the smallest record of its group; ties on the id break on the rest."""
    order = ", ".join(f"{c} NULLS FIRST" for c in CARRIED)
    left = ", ".join(
        f"FIRST_VALUE({c}) OVER (PARTITION BY {key} ORDER BY {order}) AS left_{c}" for c in CARRIED
    )
    right = ", ".join(f"{c} AS right_{c}" for c in CARRIED)
    return f"""SELECT {left}, {right} FROM eligibility
    WHERE can_process_for_entity_resolution AND {key} IS NOT NULL"""


PAIR = (
    "left_source_system, left_source_record_id, right_source_system, right_source_record_id"
)


def features_sql(pairs):
    name_l, name_r = name_key("left_standard_name"), name_key("right_standard_name")
    exact = "CASE WHEN {} = {} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    codes = [
        f"NULLIF(UPPER(REPLACE({collapsed(f'{side}_postal_code')}, ' ', '')), '')"
        for side in ("left", "right")
    ]
    days = [collapsed(f"{side}_date_of_birth") for side in ("left", "right")]
    return f"""SELECT p.*, n.similarity AS name_score, {exact.format(*days)} AS date_of_birth_score,
    {exact.format(*codes)} AS postal_code_score, s.similarity AS address_score,
    COALESCE(left_email_hash = right_email_hash, FALSE) AS deterministic_match
    FROM (SELECT *, {name_l} AS nl, {name_r} AS nr FROM {pairs}) p
    LEFT JOIN (SELECT nl, nr, {similarity("nl", "nr")} AS similarity
      FROM (SELECT DISTINCT {name_l} AS nl, {name_r} AS nr FROM {pairs})) n
      ON n.nl IS NOT DISTINCT FROM p.nl AND n.nr IS NOT DISTINCT FROM p.nr
    LEFT JOIN (SELECT al, ar, {similarity("al", "ar")} AS similarity
      FROM (SELECT DISTINCT left_address_text AS al, right_address_text AS ar FROM {pairs})) s
      ON s.al IS NOT DISTINCT FROM left_address_text AND s.ar IS NOT DISTINCT FROM right_address_text"""


def scores_sql(features):
    raw = """LEAST(1.0::DOUBLE, name_score * 0.45::DOUBLE + date_of_birth_score * 0.25::DOUBLE
      + postal_code_score * 0.15::DOUBLE + address_score * 0.15::DOUBLE)"""
    return f"""SELECT *, CASE WHEN score >= 0.92::DOUBLE THEN 'MATCH'
    WHEN score >= 0.75::DOUBLE THEN 'REVIEW_REQUIRED' ELSE 'NO_MATCH' END AS match_class
    FROM (SELECT *, {rounded("raw")} AS score FROM (SELECT *, {raw} AS raw FROM {features}))"""


RELATIONS = {
    **VIEWS,
    "crm_bronze": bronze_sql(
        "crm", "crm", "crm_customers.csv", CRM, "CAST(created_at AS TIMESTAMP)"
    ),
    "erp_bronze": bronze_sql(
        "erp", "erp", "erp_clients.csv", ERP, "CAST(registered_at AS TIMESTAMP)"
    ),
    "crm_loaded": bronze_sql("crm", "crm", "crm_customers.csv", CRM, f"TIMESTAMP '{RUN}'"),
    "erp_loaded": bronze_sql("erp", "erp", "erp_clients.csv", ERP, f"TIMESTAMP '{RUN}'"),
}
for _kind in ("bronze", "loaded"):
    RELATIONS[f"crm_identity_{_kind}"] = identity_sql(
        f"crm_{_kind}", "crm", "crm_customers", "crm_customer_id",
        "(COALESCE(first_name, '') || ' ' || COALESCE(last_name, ''))", "email", "phone",
        "date_of_birth", "postal_code", "(street || ' ' || country)",
    )
    RELATIONS[f"erp_identity_{_kind}"] = identity_sql(
        f"erp_{_kind}", "erp", "erp_clients", "erp_client_id", "client_name", "email_address",
        "mobile_number", "birth_date", "zip_code", "street_address",
    )
    RELATIONS[f"identities_{_kind}"] = (
        f"SELECT * FROM crm_identity_{_kind} UNION ALL SELECT * FROM erp_identity_{_kind}"
    )
    RELATIONS[f"joined_{_kind}"] = joined_sql(f"identities_{_kind}")
RELATIONS |= {
    "consent_status": f"""SELECT LOWER(TRIM(source_system)) AS source_system,
    source_customer_id AS source_record_id, {yes("analytics_consent")} AS raw_analytics_consent,
    {yes("marketing_consent")} AS raw_marketing_consent,
    TRY_CAST(consent_updated_at AS TIMESTAMP) AS consent_updated_at FROM consents_raw""",
    "deletion_requests": """SELECT request_id, LOWER(TRIM(source_system)) AS source_system,
    source_customer_id AS source_record_id, TRY_CAST(requested_at AS TIMESTAMP) AS requested_at,
    UPPER(TRIM(status)) AS status FROM deletions_raw""",
    "retention_policy": """SELECT LOWER(TRIM(source_system)) AS source_system,
    LOWER(TRIM(dataset_name)) AS dataset_name, date_column,
    TRY_CAST(retention_days AS INTEGER) AS retention_days, policy_owner FROM policies_raw""",
    "active_deletions": """SELECT source_system, source_record_id, request_id AS deletion_request_id,
    TRUE AS has_deletion_request, requested_at AS deletion_requested_at, status AS deletion_status
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source_system, source_record_id
      ORDER BY requested_at NULLS LAST, request_id) AS place FROM deletion_requests
      WHERE status IN ('APPROVED', 'ACTIVE', 'COMPLETED')) WHERE place = 1""",
    "eligibility": eligibility_sql("joined_bronze"),
    "eligibility_loaded": eligibility_sql("joined_loaded"),
    "events_log": events_sql("eligibility"),
    "catalog_profile": f"SELECT *, {type_of('column_name')} AS inferred_type FROM column_catalog",
    "flags": candidates_sql("catalog_profile"),
    "candidates": scored_sql("flags"),
    "decisions": decisions_sql("candidates"),
    "crm_profile": profile_sql("crm_bronze", "crm", "crm_customers_raw", CRM + LINEAGE),
    "erp_profile": profile_sql("erp_bronze", "erp", "erp_clients_raw", ERP + LINEAGE),
    "source_profile": "SELECT * FROM crm_profile UNION ALL SELECT * FROM erp_profile",
    "source_flags": candidates_sql("source_profile"),
    "source_candidates": scored_sql("source_flags"),
    "links": " UNION ".join(f"({links_sql(key)})" for key in ("email_hash", "phone_hash")),
    "identifier_pairs": f"SELECT * FROM links WHERE {APART}",
    "people": f"""SELECT *, dense_rank() OVER (ORDER BY n, d, p, a) AS class FROM (
    SELECT DISTINCT {", ".join(CARRIED)}, {tokens(name_key("standard_name"))} AS n,
    {collapsed("date_of_birth")} AS d, {packed("postal_code")} AS p, {tokens("address_text")} AS a
    FROM eligibility WHERE can_process_for_entity_resolution)""",
    "firsts": f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY class
    ORDER BY {", ".join(f"{c} NULLS FIRST" for c in CARRIED)}) AS place FROM people) WHERE place = 1""",
    # Two records score .75 only with one birth date, or with all else alike: .45 + .15 + .15.
    "may_reach": f"""SELECT DISTINCT {both("l", "r")} FROM firsts l JOIN firsts r
      ON l.class <> r.class AND (l.d = r.d OR (l.n = r.n AND l.p = r.p AND l.a = r.a))
      WHERE {before("l", "r")}
    UNION SELECT {both("l", "r")} FROM firsts l JOIN people r USING (class)
      WHERE {before("l", "r")}""",
    "may_features": features_sql("may_reach"),
    "may_scores": scores_sql("may_features"),
    "pairs": f"""SELECT {", ".join(f"left_{c}" for c in CARRIED)},
      {", ".join(f"right_{c}" for c in CARRIED)} FROM may_scores WHERE score >= 0.75::DOUBLE
    """ + " ".join(f"""UNION SELECT {both("l", "r")} FROM holders_{key} l JOIN holders_{key} r
      ON l.{key} = r.{key} AND l.class <> r.class AND (l.d = r.d OR l.n = r.n)
      WHERE {before("l", "r")}""" for key in ("email_hash", "phone_hash")),
    **{f"holders_{key}": f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key}, class
    ORDER BY {", ".join(f"{c} NULLS FIRST" for c in CARRIED)}) AS place FROM people
    WHERE {key} IS NOT NULL) WHERE place = 1""" for key in ("email_hash", "phone_hash")},
    "pair_features": features_sql("pairs"),
    # Every record with every other, not only those that stand for a class.
    "all_may_reach": f"""SELECT {both("l", "r")} FROM people l JOIN people r ON l.d = r.d WHERE {before("l", "r")}
    UNION SELECT {both("l", "r")} FROM people l JOIN people r ON l.n = r.n AND l.p = r.p AND l.a = r.a
      WHERE {before("l", "r")}""",
    "all_may_features": features_sql("all_may_reach"),
    "all_may_scores": scores_sql("all_may_features"),
    "all_pairs": f"""SELECT {", ".join(f"left_{c}" for c in CARRIED)},
      {", ".join(f"right_{c}" for c in CARRIED)} FROM all_may_scores WHERE score >= 0.75::DOUBLE
    """ + " ".join(f"""UNION SELECT {both("l", "r")} FROM people l JOIN people r
      ON l.{key} = r.{key} AND (l.d = r.d OR l.n = r.n)
      WHERE {before("l", "r")}""" for key in ("email_hash", "phone_hash")),
    "all_pair_features": features_sql("all_pairs"),
    "all_pair_scores": scores_sql("all_pair_features"),
    "given_pairs": "SELECT g.*, "
    + ", ".join(f"l.{c} AS left_{c}, r.{c} AS right_{c}" for c in CARRIED[2:])
    + """ FROM labelled_pairs g
    LEFT JOIN identities_bronze l ON l.source_system = left_source_system
      AND l.source_record_id = left_source_record_id
    LEFT JOIN identities_bronze r ON r.source_system = right_source_system
      AND r.source_record_id = right_source_record_id""",
    "given_features": features_sql("given_pairs"),
    "given_scores": scores_sql("given_features"),
}

LINEAGE_TEXT = f"'{RUN}' AS _ingested_at, '{BATCH_ID}' AS _batch_id"


def control_sql(relation, file, *columns):
    shown = ", ".join(columns)
    return f"""SELECT {shown}, '/landing/{file}' AS _source_file, {LINEAGE_TEXT},
    '{RUN}' AS processed_at FROM {relation}"""


STAMP = "CAST({0} AS VARCHAR) AS {0}"
IDENTITY_TEXT = "* REPLACE (CAST(_ingested_at AS VARCHAR) AS _ingested_at)"
LINES = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()
ORDERS = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()
DOCUMENTS = "doc_id text lang source n_chars".split()
REPORT = """source_system, table_name, column_name, row_count, null_count,
    ROUND(null_rate, 4) AS null_rate, distinct_count, ROUND(distinct_rate, 4) AS distinct_rate,
    min_length, max_length, ROUND(avg_length, 2) AS avg_length, inferred_type, sample_values"""
COUNTS = """SELECT 'crm_customers_raw' AS table_name, COUNT(*) AS row_count FROM crm
    UNION ALL SELECT 'erp_clients_raw' AS table_name, COUNT(*) AS row_count FROM erp"""

FINAL = {
    "bronze_ingest": f"""SELECT * REPLACE ('{RUN}' AS _ingested_at,
    'crm_customers.csv' AS _source_file) FROM crm_bronze""",
    "bronze_metadata": f"SELECT {IDENTITY_TEXT} FROM crm_bronze",
    "record_hash": f"""SELECT l_orderkey, l_linenumber, l_partkey, {fingerprint(LINES)} AS hash
    FROM lineitem""",
    "ingest_csv_roundtrip": "SELECT * FROM erp",
    "table_overwrite_roundtrip": "SELECT * FROM crm",
    "catalog_inventory": COUNTS,
    "bronze_counts": COUNTS,
    "std_empty_to_null": f"""SELECT last_name, {blank("crm_customer_id")} AS record_id,
    {blank("email")} AS email FROM crm""",
    "std_email": f"SELECT last_name, {email('email')} AS standard_email FROM crm",
    "std_phone": f"""SELECT last_name, phone, {phone("phone")} AS standard_phone,
    {phone("phone", "49")} AS german_phone FROM crm""",
    "std_text": f"SELECT doc_id, {text('text')} AS standard_text FROM documents",
    "std_postal": f"""SELECT last_name, {postal("postal_code")} AS postal_code,
    {postal("street")} AS packed_street FROM crm""",
    "parse_boolean": f"""SELECT source_customer_id, {yes("analytics_consent")} AS analytics,
    {yes("marketing_consent")} AS marketing FROM consents_raw""",
    "infer_type": f"""SELECT row_count, column_name, {type_of("column_name")} AS inferred_type
    FROM column_catalog""",
    "normalize_identifier": f"""SELECT name, {slug("name")} AS slug FROM (
    SELECT column_name AS name FROM column_catalog UNION ALL SELECT text FROM documents)""",
    "match_name": f"""SELECT id, {name_key("text")} AS match_name FROM (
    SELECT doc_id AS id, text FROM documents UNION ALL
    SELECT CAST(-1 AS BIGINT), last_name FROM crm)""",
    "mask_email": f"""SELECT owner, CASE WHEN p > 0 THEN CASE WHEN p > 2 THEN SUBSTRING(e, 1, 2)
    ELSE '*' END || '***@' || SUBSTRING(e, p + 1) END AS masked
    FROM (SELECT owner, e, STRPOS(e, '@') AS p FROM (
      SELECT last_name AS owner, LOWER({collapsed("email")}) AS e FROM crm UNION ALL
      SELECT url, LOWER({collapsed("REPLACE(url, '.', '@')")}) FROM pages))""",
    "hash_identifiers": f"""SELECT last_name, {hashed(email("email"))} AS email_hash,
    {hashed(f"({phone('phone')})")} AS phone_hash, {hashed("last_name")} AS name_hash FROM crm""",
    "pseudo_id": f"""SELECT last_name, {pseudo("email", "phone", "crm_customer_id")} AS pseudo_id
    FROM crm""",
    "pseudo_id_first_available": f"""SELECT last_name, 'cust_' || LEFT(SHA256('{SALT}||' ||
    COALESCE(LOWER({collapsed("email")}), LOWER({collapsed("phone")}),
      LOWER({collapsed("last_name")}))), 24) AS pseudo_id FROM crm""",
    "first_existing_column": """SELECT last_name, COALESCE(email, phone, country) AS first,
    CAST(NULL AS VARCHAR) AS "none" FROM crm""",
    "profile_null_stats": f"""SELECT column_name, row_count, null_count, null_rate
    FROM ({profile_sql("crm_bronze", "test", "crm", CRM + LINEAGE)})""",
    "profile_distinct_stats": " UNION ALL ".join(
        f"""SELECT table_name, column_name, distinct_count, distinct_rate
    FROM ({profile_sql(name, "test", name, columns)})"""
        for name, columns in (
            ("lineitem", LINES),
            ("embeddings", ["vec_id", "embedding", "label"]),
            ("events", ["event_id", "ts", "user_id", "event_type", "value", "props"]),
        )
    ),
    "profile_length_stats": f"""SELECT column_name, min_length, max_length, avg_length
    FROM ({profile_sql("documents", "test", "documents", DOCUMENTS)})""",
    "profile_sample_values": f"""SELECT column_name, sample_values
    FROM ({profile_sql("orders", "test", "orders", ORDERS)})""",
    "profile_column": profile_sql("documents", "test", "documents", ["text"]),
    "profile_table": "SELECT * FROM crm_profile",
    "profile_sources": "SELECT * FROM source_profile",
    "profile_summary": """SELECT source_system, table_name, COUNT(*) AS profiled_columns
    FROM source_profile GROUP BY source_system, table_name ORDER BY 1, 2""",
    "profile_report": f"SELECT {REPORT} FROM source_profile ORDER BY 1, 2, 3",
    "mapping_match_flags": """SELECT source_system, table_name, column_name, row_count, null_rate,
    distinct_count, distinct_rate, inferred_type, concept_id, concept_name, canonical_field_name,
    pii_category, description, canonical_exact_match, concept_exact_match, canonical_partial_match,
    concept_partial_match, inferred_type_match FROM flags
    WHERE canonical_partial_match OR concept_partial_match""",
    "mapping_candidates": "SELECT * FROM candidates",
    "mapping_decisions": "SELECT * FROM decisions",
    "semantic_mapping_stage": decisions_sql("source_candidates"),
    "concept_dump": "SELECT * FROM concepts",
    "decision_report": """SELECT source_system, table_name, column_name, concept_id, concept_name,
    canonical_field_name, pii_category, mapping_score, mapping_reason, decision FROM decisions
    ORDER BY 1, 2, 3""",
    "standardize_customers": f"SELECT {IDENTITY_TEXT} FROM crm_identity_bronze",
    "identity_candidates": f"SELECT {IDENTITY_TEXT} FROM identities_bronze",
    "prepare_identity_derived_dataset": f"SELECT {IDENTITY_TEXT} FROM identities_bronze",
    "consent_status": control_sql(
        "consent_status", "consents.csv", "source_system", "source_record_id",
        "raw_analytics_consent", "raw_marketing_consent", STAMP.format("consent_updated_at"),
    ),
    "deletion_requests": control_sql(
        "deletion_requests", "deletions.csv", "request_id", "source_system", "source_record_id",
        STAMP.format("requested_at"), "status",
    ),
    "retention_policy": control_sql(
        "retention_policy", "policies.csv", "source_system", "dataset_name", "date_column",
        "retention_days", "policy_owner",
    ),
    "active_deletions": """SELECT * REPLACE (CAST(deletion_requested_at AS VARCHAR)
    AS deletion_requested_at) FROM active_deletions""",
    "identifier_validity": """SELECT source_record_hash, has_valid_source_record_id,
    has_match_identifier, has_valid_identifier FROM eligibility""",
    "consent_left_join": f"""SELECT i.source_system, i.source_record_id, source_record_hash,
    raw_analytics_consent, raw_marketing_consent,
    CAST(consent_updated_at AS VARCHAR) AS consent_updated_at
    FROM identities_bronze i LEFT JOIN (SELECT LOWER(TRIM(source_system)) AS source_system,
      source_customer_id, {yes("analytics_consent")} AS raw_analytics_consent,
      {yes("marketing_consent")} AS raw_marketing_consent,
      TRY_CAST(consent_updated_at AS TIMESTAMP) AS consent_updated_at FROM consents_repeated) c
    ON i.source_system = c.source_system AND i.source_record_id = c.source_customer_id""",
    "deletion_left_join": """SELECT source_system, source_record_id, source_record_hash,
    deletion_request_id, has_deletion_request,
    CAST(deletion_requested_at AS VARCHAR) AS deletion_requested_at, deletion_status
    FROM identities_bronze LEFT JOIN active_deletions USING (source_system, source_record_id)""",
    "retention_left_join": """SELECT i.source_system, source_dataset_name, source_record_hash,
    date_column, retention_days, policy_owner FROM identities_bronze i LEFT JOIN retention_policy r
    ON i.source_system = r.source_system AND source_dataset_name = dataset_name""",
    "retention_expired_ingest": "SELECT source_record_hash, retention_expired FROM eligibility",
    "retention_expired_event_date": f"""SELECT t.* EXCLUDE (event_text), p.date_column,
    COALESCE(p.retention_days, 3650) AS retention_days,
    CAST({iso_day("event_text")} AS VARCHAR) AS event_date,
    COALESCE(DATE_DIFF('day', {iso_day("event_text")}, DATE '{AS_OF}')
      > COALESCE(p.retention_days, 3650), FALSE) AS retention_expired
    FROM (SELECT 'crm' AS source_system, 'crm_customers' AS source_dataset_name, last_name AS owner,
        created_at, updated_at, NULL AS last_invoice_at, updated_at AS event_text FROM crm
      UNION ALL SELECT 'erp', 'erp_clients', erp_client_id, NULL, NULL, last_invoice_at,
        last_invoice_at FROM erp) t
    LEFT JOIN retention_policy p ON t.source_system = p.source_system
      AND t.source_dataset_name = p.dataset_name""",
    "eligibility_flags": """SELECT source_record_hash, raw_analytics_consent, raw_marketing_consent,
    has_deletion_request, retention_expired, has_valid_identifier, can_process_for_analytics,
    can_process_for_marketing, can_process_for_entity_resolution FROM eligibility""",
    "suppression_reasons": """SELECT source_record_hash, suppression_reasons, suppression_reason
    FROM eligibility""",
    "processing_eligibility": "SELECT * FROM eligibility",
    "compliance_events": "SELECT * FROM events_log",
    "compliance_stage": "SELECT * FROM events_log",
    "eligibility_report": "SELECT * FROM eligibility ORDER BY source_system, source_record_id",
    "all_stages": "SELECT * EXCLUDE (_source_file) FROM eligibility_loaded",
    "identifier_links": "SELECT * FROM identifier_pairs",
    "block_pairs": "SELECT * FROM pairs",
    "pair_text_similarity": f"SELECT {PAIR}, name_score, address_score FROM pair_features",
    "pair_exact_features": f"""SELECT {PAIR}, date_of_birth_score, postal_code_score
    FROM all_pair_features""",
    "pair_weighted_score": f"SELECT {PAIR}, score FROM all_pair_scores",
    "pair_classification": f"SELECT {PAIR}, match_class, deterministic_match FROM all_pair_scores",
    "labelled_pair_scores": f"""SELECT {PAIR}, expected_decision, score, match_class,
    deterministic_match FROM given_scores""",
}


FINAL["consent_join_cut_keys"] = FINAL["consent_left_join"]
FINAL["retention_join_large_lookup"] = FINAL["retention_left_join"]


def with_relations(sql: str) -> str:
    """Put the relations that a query uses, directly or not, in front of it."""
    needed: list[str] = []

    def visit(body: str, own: str | None) -> None:
        for name in used_names(body, RELATIONS):
            if name != own and name not in needed:
                visit(RELATIONS[name], name)
                needed.append(name)

    visit(sql, None)
    ctes = ",\n".join(f"{name} AS ({RELATIONS[name]})" for name in needed)
    return f"WITH {ctes}\n{sql}" if ctes else sql


def oracle_sql() -> dict[str, str]:
    return {name: with_relations(sql) for name, sql in FINAL.items()}
