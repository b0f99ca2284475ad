"""The five stages on small landing files with hand-derived results."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pseudora.plans import stages
from pseudora.sources import landing, tables

# The file names and their header lines. All rows are our own.
FILES = {
    "crm_customers": """\
crm_customer_id,first_name,last_name,email,phone,date_of_birth,address_line,postal_code,country,created_at,updated_at
10,Tereza,Nováková,tereza@posta.test,+420 777 010 203,1964-05-30,Dlouhá 12/4,110 00,cz,1999-03-02,
20,Vít,Černý, VIT@POSTA.TEST ,777 040 506,1958-12-24,"U Mlýna 3, dvůr",602 00,cz,2001-07-19,2001-07-20
30,,Dvořák,,00420 777070809,,,,sk,2003-11-11,2029-01-31
40,,,,,,,,,2004-02-29,
50,Eva,Malá,eva@posta.test,,2001-01-15,Nad Vodou 8,779 00,cz,2010-10-10,2030-05-05
""",
    "erp_clients": """\
erp_client_id,client_full_name,email_address,mobile_number,birth_date,street_address,zip_code,country_code,registered_at,last_invoice_at
A7,V. Černý,vit@posta.test,+48777040506,1958-12-24,U  Mlýna 3,60200,cz,2002-01-01,2028-08-08
B8,Malá s.r.o.,faktury@firma.test,n/a,,Nad Vodou 8,779-00,cz,2011-11-11,2012-12-12
""",
    "semantic_concepts": """\
concept_id,concept_name,canonical_field_name,pii_category,description
act,last invoice at,invoice_day,ACTIVITY,latest bill
bir,birth date,date_of_birth,PERSON,when somebody was born
cou,country,nation,PLACE,state of residence
mai,email,email,REACH,electronic mailbox
nam,client,full_name,PERSON,what somebody is called
reg,registered,registered_at,ACTIVITY,first seen
str,street address,address,PLACE,road and door
tel,phone,phone,REACH,number to call
zip,zip,postal_code,PLACE,delivery area
""",
    "consent_preferences": """\
source_system,source_customer_id,analytics_consent,marketing_consent,consent_updated_at
crm,10,Y,no,2030-01-01
crm,20,true,TRUE,2030-01-02
Crm,30,1,yes,never
crm,50,maybe,y,2030-01-04
erp,A7,yes,1,2030-01-05
erp,B8,0,off,2030-01-06
""",
    "deletion_requests": """\
request_id,source_system,source_customer_id,requested_at,status
r-1,crm,20,2030-05-01,Completed
r-2,crm,50,2030-05-02,open
r-3, ERP,B8,2030-05-03, active
""",
    "data_retention_policy": """\
source_system,dataset_name,date_column,retention_days,policy_owner
crm,CRM_CUSTOMERS,updated_at,30,archive
Erp,erp_clients,last_invoice_at,10,archive
""",
}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    layout = stages.Layout(bronze="t_bronze", metadata="t_meta", silver="t_silver", compliance="t_comp")
    layout.create_schemas(spark)
    run = stages.Run(
        layout=layout, batch_id="b7", run_ts=datetime(2030, 6, 1), as_of=date(2030, 6, 15)
    )
    paths = {system: f"{folder}/" for system, _ in stages.LANDING_FILES}
    for _ in range(2):  # a second run replaces every table
        stages.run_all(spark, run, paths, salt="s")
    return run


def table(spark, run, schema, name):
    return spark.table(run.layout.table(schema, name))


def test_bronze(spark, run):
    crm = table(spark, run, "bronze", "crm_customers_raw")
    assert crm.count() == 5
    assert len(crm.columns) == 16
    row = crm.where("crm_customer_id = '20'").first()
    assert (row.address_line, row.email) == ("U Mlýna 3, dvůr", " VIT@POSTA.TEST ")
    assert (row._source_system, row._batch_id) == ("crm", "b7")
    assert row._source_file.endswith("/crm_customers.csv")
    assert "//" not in row._source_file


def test_profile_and_decisions(spark, run):
    profile = table(spark, run, "metadata", "source_column_profile")
    assert profile.count() == 16 + 15
    phone = profile.where("column_name = 'phone'").first()
    assert (phone.row_count, phone.null_count, phone.distinct_count) == (5, 2, 3)
    candidates = table(spark, run, "metadata", "semantic_mapping_candidates")
    decisions = table(spark, run, "metadata", "mapping_decisions")
    assert (candidates.count(), decisions.count()) == (13, 13)
    got = {
        f"{r.source_system}.{r.column_name}": (r.concept_id, round(r.mapping_score, 2), r.decision)
        for r in decisions.collect()
    }
    assert got == {
        "crm.email": ("mai", 1.00, "AUTO_ACCEPT"),
        "crm.phone": ("tel", 1.00, "AUTO_ACCEPT"),
        "crm.date_of_birth": ("bir", 1.00, "AUTO_ACCEPT"),
        "crm.address_line": ("str", 0.45, "LOW_CONFIDENCE"),
        "crm.postal_code": ("zip", 1.00, "AUTO_ACCEPT"),
        "crm.country": ("cou", 0.70, "REVIEW_REQUIRED"),
        "erp.client_full_name": ("nam", 0.60, "REVIEW_REQUIRED"),
        "erp.email_address": ("mai", 0.60, "REVIEW_REQUIRED"),
        "erp.birth_date": ("bir", 0.90, "AUTO_ACCEPT"),
        "erp.street_address": ("str", 1.00, "AUTO_ACCEPT"),
        "erp.zip_code": ("zip", 0.35, "LOW_CONFIDENCE"),
        "erp.registered_at": ("reg", 1.00, "AUTO_ACCEPT"),
        "erp.last_invoice_at": ("act", 0.70, "REVIEW_REQUIRED"),
    }


def test_identities(spark, run):
    got = {
        r.source_record_id: r
        for r in table(spark, run, "silver", "customer_identity_candidates").collect()
    }
    assert got.keys() == {"10", "20", "30", "40", "50", "A7", "B8"}
    assert got["10"].standard_name == "tereza nováková"
    assert got["30"].standard_name == "dvořák"
    assert got["A7"].standard_name is None  # client_full_name is no name candidate
    assert got["10"].address_text == "cz"
    assert got["A7"].address_text == "u mlýna 3"
    assert got["20"].standard_phone == got["A7"].standard_phone == "+48777040506"
    assert got["30"].standard_phone == "+420777070809"
    assert got["20"].email_hash == got["A7"].email_hash
    assert got["50"].email_hash != got["B8"].email_hash
    assert (got["20"].postal_code, got["B8"].postal_code) == ("60200", "779-00")
    assert got["40"].email_hash is None and got["40"].phone_hash is None


def test_compliance(spark, run):
    rows = table(spark, run, "compliance", "processing_eligibility").collect()
    got = {
        r.source_record_id: (
            r.can_process_for_analytics,
            r.can_process_for_marketing,
            r.can_process_for_entity_resolution,
            r.suppression_reasons,
        )
        for r in rows
    }
    deleted, expired = "DELETION_REQUESTED", "RETENTION_EXPIRED"
    analytics, marketing = "NO_ANALYTICS_CONSENT", "NO_MARKETING_CONSENT"
    assert len(rows) == 7
    assert got["10"] == (True, False, True, [marketing])
    assert got["20"] == (False, False, False, [deleted])
    assert got["30"] == (True, True, True, [])
    assert got["40"][:3] == (False, False, False) and got["40"][3][-2:] == [analytics, marketing]
    assert got["50"] == (False, True, False, [analytics])
    assert got["A7"] == (False, False, False, [expired])
    assert got["B8"] == (False, False, False, [deleted, expired, analytics, marketing])
    assert {(r.source_system, r.retention_days) for r in rows} == {("crm", 30), ("erp", 10)}
    assert all(r.suppression_reason == next(iter(r.suppression_reasons), None) for r in rows)
    events = table(spark, run, "compliance", "compliance_events").collect()
    assert len(events) == sum(len(r.suppression_reasons) for r in rows)
    requests = {(e.event_type, e.source_record_id, e.related_request_id) for e in events if e.related_request_id}
    assert requests == {(deleted, "20", "r-1"), (deleted, "B8", "r-3")}


def test_inventory_lists_the_tables(spark, run):
    listed = tables.table_inventory(spark, f"spark_catalog.{run.layout.compliance}")
    assert {r.table_name for r in listed.collect()} == {
        "consent_status", "deletion_requests", "retention_policy", "processing_eligibility",
        "compliance_events",
    }


def test_inventory_lists_the_schemas(spark, run):
    listed = {r.namespace for r in tables.schema_inventory(spark, "spark_catalog").collect()}
    assert {"t_bronze", "t_meta", "t_silver", "t_comp"} <= listed


def test_salt_is_needed(spark, run):
    with pytest.raises(ValueError, match="salt"):
        stages.run_standardization(spark, run, salt=None)


def test_short_and_long_csv_rows(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b,c\n1\n1,"",3,4\n', encoding="utf-8")
    spec = landing.BronzeIngestSpec("x", f"{tmp_path}//", "f.csv", "t")
    assert spec.source_file_path == f"{tmp_path}/f.csv"
    got = [tuple(r) for r in landing.read_landing_csv(spark, spec.source_file_path).collect()]
    assert got == [("1", None, None), ("1", None, "3")]


class FakeContext:
    applicationId = "app-1"

    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):  # noqa: N802 - Spark's name
        return self.folder

    def setCheckpointDir(self, folder):  # noqa: N802 - Spark's name
        self.folder = folder


class FakeSession:
    def __init__(self, master, configured):
        self.sparkContext = FakeContext(master)
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}


def test_shared_folder_is_the_one_the_cluster_names():
    session = FakeSession("yarn", "hdfs:///shared/place/")
    assert tables.shared_folder(session) == "hdfs:///shared/place/app-1"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.shared_folder(FakeSession("yarn", None))
    local = FakeSession("local[2]", None)
    assert tables.shared_folder(local) == tables.shared_folder(local)


def test_a_failing_write_leaves_the_old_table(spark, run):
    target = run.layout.table("bronze", "kept")
    tables.write_table(spark.range(3).toDF("a"), target)
    broken = spark.range(5).select(F.raise_error(F.lit("broken")).cast("string").alias("b"))
    with pytest.raises(Exception, match="broken"):
        tables.write_table(broken, target)
    assert spark.table(target).columns == ["a"] and spark.table(target).count() == 3
    assert tables.write_table(spark.range(2).toDF("c"), target).columns == ["c"]


def test_independent_writes_overlap_and_a_failure_stops_the_rest(spark):
    import threading
    import time

    order, together, lock = [], threading.Barrier(3, timeout=20), threading.Lock()

    def job(name, meet=False):
        def write():
            if meet:
                together.wait()  # passes only if three jobs run at the same time
            with lock:
                order.append(name)
            return spark.range(1)

        return write

    graph = {
        "a": ((), job("a", meet=True)),
        "b": ((), job("b", meet=True)),
        "c": ((), job("c", meet=True)),
        "d": (("a", "b"), job("d")),
        "e": (("d", "c"), job("e")),
    }
    assert set(stages.run_graph(spark, graph)) == set(graph)
    assert set(order[:3]) == {"a", "b", "c"} and order[-2:] == ["d", "e"]

    def fails():
        time.sleep(0.1)
        raise RuntimeError("broken")

    order.clear()
    with pytest.raises(RuntimeError, match="broken"):
        stages.run_graph(spark, {"x": ((), fails), "y": (("x",), job("y"))})
    assert order == []


def test_what_each_table_waits_for(spark, run):
    specs = stages.landing_specs(run, dict.fromkeys(("crm", "erp", "reference", "compliance"), "/x"))
    ingests = stages.ingest_graph(spark, run, specs)
    assert len(ingests) == 6 and not any(needs for needs, _ in ingests.values())
    controls = stages.compliance_graph(spark, run)
    first = [name for name, (needs, _) in controls.items() if not set(needs) & set(controls)]
    assert first == ["consent_status", "deletion_requests", "retention_policy"]


def test_key_counts_are_noted_at_tables(spark, run):
    counts = run.counts(spark, "compliance", "consent_status")
    assert len(counts) == 6 and set(counts.values()) == {1}
    assert len(run.counts(spark, "silver", "customer_identity_candidates")) == 7


def test_a_write_that_fails_leaves_a_table(spark, monkeypatch, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS t_atomic")
    name = "spark_catalog.t_atomic.t"
    old = spark.range(3).selectExpr("id", "'old' AS v")
    new = spark.range(5).selectExpr("id", "'new' AS v")
    wider = spark.range(4).selectExpr("id", "'wide' AS v", "1 AS more")
    tables.write_table(old, name)
    boom = new.selectExpr("id", "IF(id > 3, raise_error('no'), v) AS v")
    with pytest.raises(Exception, match="no"):
        tables.write_table(boom, name)
    assert tables.read_table(spark, name).where("v = 'old'").count() == 3

    def stop(point):
        """Interrupt the next write where it runs the given command."""
        plain = type(spark).sql

        def sql(self, text, *args, **kwargs):
            if text.startswith(point):
                monkeypatch.undo()
                raise KeyboardInterrupt(point)
            return plain(self, text, *args, **kwargs)

        monkeypatch.setattr(type(spark), "sql", sql)

    stop("ALTER TABLE")  # before the switch: the old version stands
    with pytest.raises(KeyboardInterrupt):
        tables.write_table(new, name)
    assert tables.read_table(spark, name).where("v = 'old'").count() == 3
    monkeypatch.setattr(tables, "_removed", lambda *args: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):  # after the switch: the new one does
        tables.write_table(new, name)
    monkeypatch.undo()
    assert tables.read_table(spark, name).where("v = 'new'").count() == 5
    for point in ("ALTER TABLE", "DROP TABLE", "SHOW TBLPROPERTIES"):  # a change of schema
        stop(point)
        with pytest.raises(KeyboardInterrupt):
            tables.write_table(wider, name)
        assert tables.read_table(spark, name).count() in (4, 5)
        tables.write_table(new, name)
    assert tables.write_table(wider, name).columns == ["id", "v", "more"]
    assert tables.write_table(old, name).count() == 3
    spark.sql("DROP TABLE spark_catalog.t_atomic.t")


def test_unreadable_policies_are_reported(spark):
    from pseudora.operators import controls

    raw = spark.createDataFrame(
        [("crm", "a", "30", "x"), ("crm", "b", "forever", "x"), ("erp", "c", None, "y")],
        "source_system string, dataset_name string, retention_days string, policy_owner string",
    )
    assert [r.dataset_name for r in controls.unreadable_policies(raw).collect()] == ["b"]
