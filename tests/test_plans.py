import datetime as dt

import pytest
from pyspark.sql import functions as F

from medloom import schema
from medloom.operators import harmonize as h
from medloom.operators import merge, metrics as m, runlog
from medloom.operators.vocabulary import Vocabulary
from medloom.plans import merging, pipeline, report, tasks

RUN = dt.datetime(2024, 5, 6, 7, 8, 9)
DAY = dt.date(2024, 5, 6)

CONCEPTS = [
    # id, domain, standard
    (0, None, None), (1, "Condition", None), (2, "Condition", "S"), (3, "Measurement", "S"), (4, "Meas Value", "S"),
    (5, "Condition", None), (6, "Condition", "S"), (7, "Visit", "S"), (32, "Type Concept", "S"),
]
RELATIONS = [
    (1, 2, "Maps to"), (1, 3, "Maps to"), (1, 4, "Maps to value"), (2, 2, "Maps to"), (5, 6, "Concept replaced by"),
    (1, 7, "Is a"),
]


def vocabulary_tables(spark):
    concept = spark.createDataFrame(
        [(i, d, s, f"concept {i}", "SNOMED", "C") for i, d, s in CONCEPTS],
        "concept_id bigint, domain_id string, standard_concept string, concept_name string, vocabulary_id string,"
        " concept_class_id string")
    relation = spark.createDataFrame(RELATIONS, "concept_id_1 bigint, concept_id_2 bigint, relationship_id string")
    ancestor = spark.createDataFrame([], "ancestor_concept_id bigint, descendant_concept_id bigint")
    return {"concept": concept, "concept_relationship": relation, "concept_ancestor": ancestor}


@pytest.fixture(scope="module")
def codes(spark, tmp_path_factory):
    t = vocabulary_tables(spark)
    return Vocabulary.build(t["concept"], t["concept_relationship"]).store(str(tmp_path_factory.mktemp("v")))


def conditions(spark, rows):
    return spark.createDataFrame(rows, "condition_occurrence_id bigint, condition_concept_id bigint, condition_source_concept_id bigint")


def run(spark, codes, rows, **options):
    out = h.harmonize(conditions(spark, rows), "condition_occurrence", codes, **options).collect()
    return sorted((r.condition_occurrence_id, r.condition_concept_id, r.vocab_harmonization_status, r.target_table,
                   r.vh_value_as_concept_id) for r in out)


def test_steps_and_fan_out(spark, codes):
    S = h.STATUS
    assert run(spark, codes, [(10, 0, 1)]) == [
        (10, 2, S[h.SOURCE_TARGET], "condition_occurrence", 4), (10, 3, S[h.SOURCE_TARGET], "measurement", 4)]
    # A target the row already has is not given again.
    assert run(spark, codes, [(10, 2, 1)]) == [(10, 3, S[h.SOURCE_TARGET], "measurement", 4)]
    assert run(spark, codes, [(10, 1, 0)])[0][2] == S[h.TARGET_REMAP]
    assert run(spark, codes, [(10, 0, 6)]) == [(10, 6, S[h.SOURCE_BACKFILL], "condition_occurrence", None)]
    assert run(spark, codes, [(10, 99, 0)]) == [(10, 99, S[h.DOMAIN_CHECK], "condition_occurrence", None)]
    assert run(spark, codes, [(10, 7, 7)]) == [(10, 7, S[h.DOMAIN_CHECK], "visit_occurrence", None)]
    assert run(spark, codes, [(10, 5, 0)])[0][2] == S[h.DOMAIN_CHECK]
    assert run(spark, codes, [(10, 5, 0)], steps=h.STEPS) == [
        (10, 6, S[h.TARGET_REPLACEMENT], "condition_occurrence", None)]
    assert run(spark, codes, [(10, 99, 0)], steps=[h.SOURCE_TARGET]) == []


def test_unknown_steps_are_refused(spark, codes):
    with pytest.raises(ValueError):
        run(spark, codes, [(10, 0, 1)], steps=["guess"])


def test_target_remap_moves_the_old_target_to_the_source(spark, codes):
    row = h.harmonize(conditions(spark, [(10, 1, 0)]), "condition_occurrence", codes).first()
    assert row.condition_source_concept_id == 1 and row.source_concept_id == 0 and row.previous_target_concept_id == 1


def test_tables_without_source_concepts(spark, codes):
    note = spark.createDataFrame([(1, 1), (2, 0)], "note_id bigint, note_class_concept_id bigint")
    rows = {(r.note_id, r.note_class_concept_id, r.target_table, r.source_concept_id)
            for r in h.harmonize(note, "note", codes).collect()}
    assert rows == {(1, 2, "condition_occurrence", 0), (1, 3, "measurement", 0), (2, 0, "note", 0)}


def test_shared_keys_are_settled_together(spark, codes):
    rows = [(10, 0, 1), (10, 99, 0), (11, 99, 0)]
    alone = run(spark, codes, rows)
    assert len(alone) == 4
    together = run(spark, codes, rows, repeated_key="condition_occurrence_id")
    # The unmapped row shares its key with a mapped one, which settles the key.
    assert [r[:2] for r in together] == [(10, 2), (10, 3), (11, 99)]


def test_every_key_is_settled_once(spark, codes):
    df = spark.range(0, 500).select(
        F.col("id").alias("condition_occurrence_id"), (F.col("id") % 9).alias("condition_concept_id"),
        (F.col("id") % 7).alias("condition_source_concept_id"))
    out = h.harmonize(df, "condition_occurrence", codes, h.STEPS)
    per_key = out.groupBy("condition_occurrence_id").agg(F.countDistinct("vocab_harmonization_status").alias("n"))
    assert per_key.count() == 500 and per_key.filter("n > 1").isEmpty()


def test_secondary_backfill(spark, codes):
    df = spark.createDataFrame([(0, 3), (0, 99), (0, 0), (5, 3), (None, 3)], "unit_concept_id bigint, unit_source_concept_id bigint")
    pairs = [("unit_concept_id", "unit_source_concept_id")]
    assert [r[0] for r in h.backfill_secondary(df, pairs, codes).collect()] == [3, 0, 0, 5, None]
    assert h.secondary_backfill_counts(df, pairs, codes).first().row_count == 1


# ---- tasks, merge, log ----


def test_task_guards(spark):
    tables = {"concept": spark.range(1), "death": spark.range(1)}
    for statements in ({"concept": "SELECT 1"}, {"optimized_vocab_file": "SELECT 1"}, {"nothing": "SELECT 1"}, {}):
        with pytest.raises(ValueError):
            tasks.run_task("t", tables, statements)


def test_task_metrics_and_dropped_table(spark):
    measurement = spark.createDataFrame([(1, "a"), (2, "b")], "measurement_id bigint, v string")
    death = spark.createDataFrame([(1,), (1,)], "person_id bigint")
    tables = {"measurement": measurement, "death": death}
    result = tasks.run_task("t", tables, {"measurement": "SELECT * FROM {measurement} WHERE v = 'a'", "death": None})
    assert "death" not in result.tables and result.tables["measurement"].count() == 1
    found = {(r.name, r.value_as_string): r.value_as_number for r in result.metrics().collect()}
    assert found[("Post-processing task t: rows removed", "death")] == 2
    assert found[("Post-processing task t: rows removed", "measurement")] == 1
    assert found[("Post-processing task t: table affected", "measurement")] is None
    same = tasks.run_task("t", tables, {"death": "SELECT * FROM {death}"}).metrics().collect()
    assert sorted((r.name, r.value_as_string, r.value_as_number) for r in same) == [
        ("Post-processing task t: rows added", None, 0.0), ("Post-processing task t: rows removed", None, 0.0)]


def test_task_repairs_keys(spark):
    measurement = spark.createDataFrame([(1, "a")], "measurement_id bigint, v string")
    result = tasks.run_task("t", {"measurement": measurement}, {
        "measurement": "SELECT * FROM {measurement} UNION ALL SELECT measurement_id, 'b' FROM {measurement}"})
    assert result.tables["measurement"].select("measurement_id").distinct().count() == 2


def test_text_mapped(spark):
    rows = [(5, 0, "glucose", False), (4020553, 0, "glucose", True), (5, 9, "glucose", True), (0, 0, "glucose", True),
            (5, 0, "short", True), (5, 0, None, True), (5, None, "glucose", False), (5, None, "abc", True)]
    df = spark.createDataFrame(rows, "measurement_concept_id bigint, measurement_source_concept_id bigint,"
                               " measurement_source_value string, kept boolean")
    assert tasks.drop_text_mapped(df).count() == 6 and tasks.drop_text_mapped(df).filter("NOT kept").isEmpty()


def test_merge(spark):
    a = spark.createDataFrame([(1, 101, "5.0"), (2, 102, "6.0")], "measurement_id int, person_id int, value string")
    b = spark.createDataFrame([(10, 201, "7.0", "x"), (11, 202, "8.0", "y"), (12, 203, "9.0", "z")],
                              "measurement_id int, person_id int, value string, extra_col string")
    chunks = merge.unite_chunks([merge.extract_chunk(a, "measurement", "siteA", DAY), merge.extract_chunk(b, "measurement", "siteB", DAY)])
    merged = merge.reconcile(chunks)
    assert merged.count() == 5 and merged.filter("extra_col IS NULL").count() == 2
    assert merged.columns == ["measurement_id", "person_id", "value", "extra_col"]
    person = merge.extract_chunk(spark.createDataFrame([(101, 999), (102, 999)], "person_id bigint, care_site_id bigint"),
                                 "person", "siteA", DAY, "Site A")
    site = merge.care_sites(spark, ["Site A", "Site B", "Site A"])
    assert site.count() == 2 and site.columns == schema.layout("care_site").names
    known = {r.care_site_name: r.care_site_id for r in site.collect()}
    assert {r.care_site_id for r in person.collect()} == {known["Site A"]}
    rows = {(r.name, r.value_as_string): r.value_as_number for r in report.merge(spark, merge.delivery_counts(chunks)).collect()}
    assert rows[("Merge source delivery row count", "siteB__2024-05-06")] == 3
    assert rows[("Merge total row count", None)] == 5 and ("Merge source site", "siteA") in rows
    for empty in (lambda: merge.unite_chunks([]), lambda: merge.care_sites(spark, [])):
        with pytest.raises(ValueError):
            empty()
    sources = spark.createDataFrame([(dt.date(2024, 6, 1),), (dt.date(2025, 3, 15),)], "source_release_date date")
    facts = {"cdm_source_name": "all", "source_description": "{site_count} sites"}
    row = merge.merged_source(sources, facts, 2, "5.4", "v5", DAY).first()
    assert row.source_release_date == dt.date(2025, 3, 15) and row.source_description == "2 sites"
    assert merge.merged_source(sources.limit(0), facts, 2, "5.4", "v5", DAY).first().source_release_date == DAY


def test_merged_instance(spark, tmp_path):
    def person(*ids):
        return spark.createDataFrame([(i, None) for i in ids], "person_id bigint, care_site_id bigint")

    source = spark.createDataFrame([(dt.date(2024, 2, 3),)], "source_release_date date")
    deliveries = [
        merging.Source("a", "Site A", DAY, {"person": person(1, 2), "cdm_source": source}),
        merging.Source("007", "Site B", DAY, {"person": person(3).withColumn("extra", F.lit("x"))}),
    ]
    done = merging.merge_deliveries(
        spark, deliveries, str(tmp_path / "m"), DAY, {"cdm_source_name": "all"}, "v5", run_at=RUN)
    assert done.tables["person"].count() == 3 and done.tables["person"].filter("extra IS NULL").count() == 2
    assert done.tables["person"].select("care_site_id").distinct().count() == 2 == done.tables["care_site"].count()
    assert done.tables["cdm_source"].first().source_release_date == dt.date(2024, 2, 3)
    rows = {(r.name, r.value_as_string): r.value_as_number for r in done.report.collect()}
    assert rows[("Merge source delivery row count", "a__2024-05-06")] == 3
    assert rows[("Merge source delivery row count", "007__2024-05-06")] == 1
    assert rows[("Merge total row count", None)] == 4
    with pytest.raises(ValueError):
        merging.merge_deliveries(spark, [], str(tmp_path / "m"), DAY, {}, "v5")


def test_run_log(spark):
    start = spark.createDataFrame([("a", DAY, RUN, "csv", "5.3", "r1")],
                                  "site_name string, delivery_date date, pipeline_start_datetime timestamp_ntz,"
                                  " file_format string, cdm_version string, run_id string")
    log = runlog.log_started(spark.createDataFrame([], runlog.LOG_SCHEMA), start)
    assert (log.first().status, log.first().message) == ("started", None)
    error = spark.createDataFrame([("r1", RUN, "disk full")], "run_id string, pipeline_end_datetime timestamp_ntz, message string")
    log = runlog.log_failed(log, error)
    log = runlog.log_failed(log, error.withColumn("message", F.lit("DAG failed")))
    assert (log.first().status, log.first().message) == ("error", "disk full")
    key = start.select("site_name", "delivery_date")
    log = runlog.log_running(log, key)
    assert (log.first().status, log.first().message, log.first().pipeline_end_datetime) == ("running", None, None)
    assert runlog.latest_completed(log).isEmpty()
    log = runlog.log_completed(log, key.withColumn("pipeline_end_datetime", F.lit(RUN).cast("timestamp_ntz")))
    assert runlog.latest_completed(log).first().delivery_date == DAY
    assert runlog.log_rows(log, "a", DAY).count() == 1 and runlog.log_rows(log, "b", DAY).isEmpty()
    log = runlog.log_started(log, start.withColumn("message", F.lit("again")))
    assert log.count() == 1 and (log.first().status, log.first().message) == ("started", "again")


# ---- report and the whole ----


def test_large_counts_survive_the_file(spark, tmp_path):
    from medloom.sources import publish

    rows = m.finish_report(m.metric_frame(spark, [m.Metric("n", value_as_number=98159833.0)]), RUN)
    assert len(rows.columns) == 9
    publish.write_csv(rows, str(tmp_path / "r"))
    back = spark.read.option("header", True).csv(str(tmp_path / "r")).first()
    assert float(back.value_as_number) == 98159833 and int(back.metadata_type_concept_id) == 32880


def test_breakdown_metrics(spark):
    tables = {"person": spark.createDataFrame([(1, 8507, 3), (2, 8507, None)],
                                              "person_id bigint, gender_concept_id bigint, gender_source_concept_id bigint"),
              "death": spark.createDataFrame([(1, 32, dt.date(1970, 1, 1)), (9, 77, DAY), (9, None, DAY)],
                                             "person_id bigint, death_type_concept_id bigint, death_date date")}
    about = report.Delivery(spark, tables, vocabulary_tables(spark)["concept"], DAY, {"Delivered CDM version": "5.3"})
    rows = {(r.name, r.value_as_string): r for r in report.generate(about, [], RUN).collect()}
    assert rows[("Type concept breakdown: death", "concept 32")].value_as_number == 1
    assert rows[("Target vocabulary breakdown: person.gender_concept_id", "No matching concept")].value_as_number == 2
    assert rows[("Source vocabulary breakdown: person.gender_concept_id", "SNOMED")].value_as_number == 1
    assert rows[("Invalid concept_id count: person.gender_concept_id", "person.gender_concept_id")].value_as_number == 2
    assert rows[("Invalid concept_id count: death.death_type_concept_id", "death.death_type_concept_id")].value_as_number == 1
    assert rows[("Date/datetime default value count: death.death_date", None)].value_as_number == 1
    assert rows[("Person_id referential integrity violation count: death", "death")].value_as_number == 2
    assert rows[("Final row count: note", "note")].value_as_number == 0
    assert rows[("Final row count: death", "death")].value_as_number == 3
    assert rows[("Delivered CDM version", "5.3")].value_as_concept_id == 1147543
    assert {r.metadata_datetime for r in rows.values()} == {RUN}
    with pytest.raises(ValueError):
        report.artifact(about, "nonsense")


def test_whole_delivery(spark, tmp_path):
    from tests.test_people import REGISTRY, entry

    delivered = {
        "person": spark.createDataFrame([("1", "8507", "1980"), ("2", "8507", "1990"), ("x", "8507", "1990")],
                                        "person_id string, gender_concept_id string, year_of_birth string"),
        "condition_occurrence": spark.createDataFrame([
            ("1", "1", "0", "1", "2024-01-05", "32"), ("2", "1", "0", "1", "2024-01-05", "32"),
            ("3", "2", "6", "6", "2024-01-09", "32"), ("4", "3", "6", "6", "2024-01-09", "32")],
            "condition_occurrence_id string, person_id string, condition_concept_id string,"
            " condition_source_concept_id string, condition_start_date string, condition_type_concept_id string"),
        "visit_occurrence": spark.createDataFrame(
            [("10", "1", "7", "2024-01-05", "2024-01-06", "32")], "visit_occurrence_id string, person_id string,"
            " visit_concept_id string, visit_start_date string, visit_end_date string, visit_type_concept_id string"),
        "unknown_table": spark.createDataFrame([("1",)], "a string"),
    }
    registry = spark.createDataFrame([entry("1"), entry("2"), entry("3", consent="353358909"), entry("8")], REGISTRY)
    site = pipeline.Site(
        "site a", DAY, version="5.3", facts={"cdm_source_name": "A"}, vocabulary_version="v5",
        tasks={"no late rows": {"measurement": "SELECT * FROM {measurement} WHERE measurement_date < DATE'2025-01-01'"}})
    done = pipeline.process(spark, delivered, site, vocabulary_tables(spark), str(tmp_path / "out"), registry, run_at=RUN)
    condition = done.tables["condition_occurrence"]
    # Two equal rows of person 1 were re-coded to a condition and a measurement each.
    assert sorted((r.person_id, r.condition_concept_id) for r in condition.collect()) == [(1, 2), (1, 2), (2, 6)]
    assert condition.select("condition_occurrence_id").distinct().count() == 3
    assert sorted((r.person_id, r.measurement_concept_id, r.value_as_concept_id) for r in done.tables["measurement"].collect()) == [
        (1, 3, 4), (1, 3, 4)]
    assert done.tables["condition_era"].count() == 2 and done.tables["observation_period"].count() == 2
    assert [r.person_id for r in done.invalid["person"].collect()] == ["x"]
    rows = {r.name: r.value_as_number for r in done.report.collect()}
    assert rows["Valid row count: person"] == 2 and rows["Invalid row count: person"] == 1
    assert rows["Number of rows removed due to exclusion rules: condition_occurrence"] == 1
    assert rows["Vocab harmonization table transition: condition_occurrence to measurement"] == 2
    assert rows["Final row count: condition_occurrence"] == 3
    assert rows["Invalid table name: unknown_table"] is None
    assert rows["Post-processing task no late rows: rows removed"] == 0
    assert done.tables["cdm_source"].first().vocabulary_version == "v5"
    texts = {r.name: r.value_as_string for r in done.report.collect()}
    assert texts["Source system extraction date"] == "2024-05-06" and texts["Delivered vocabulary version"] is None
    text = "".join(f.read_text() for f in (tmp_path / "out" / "artifacts/delivery_report/study_summary").glob("*.txt"))
    assert "Person record count: 2" in text and "Study status - Verified: 2" in text
    assert "Eligible participants not in delivery (1):\n    8\n" in text and "Delivered study ids not found in registry (1):" in text
    assert "  person (1):\n    x\n" in text
    assert {r.value_as_concept_id is None or r.metadata_concept_id is None for r in done.report.collect()} == {False}


def test_delivery_of_header_only_tables(spark, tmp_path):
    from tests.test_people import REGISTRY, entry

    (tmp_path / "death.csv").write_text("person_id,death_date,death_type_concept_id\n")
    (tmp_path / "person.csv").write_text("person_id,gender_concept_id,year_of_birth\n")
    (tmp_path / "condition_occurrence.csv").write_text("condition_occurrence_id,person_id,condition_concept_id\n")
    from medloom.sources import ingest

    delivered = {t: ingest.read_delivery_file(spark, str(tmp_path / f"{t}.csv")) for t in ("death", "person", "condition_occurrence")}
    registry = spark.createDataFrame([entry("1")], REGISTRY)
    site = pipeline.Site("site a", DAY, facts={"cdm_source_name": "A"}, vocabulary_version="v5")
    done = pipeline.process(spark, delivered, site, vocabulary_tables(spark), str(tmp_path / "out"), registry, run_at=RUN)
    assert all(done.tables[t].count() == 0 for t in delivered)
    rows = {r.name: r.value_as_number for r in done.report.collect()}
    assert rows["Valid row count: death"] == 0 and rows["Invalid row count: death"] == 0
    assert rows["Number of eligible registered people not in delivery"] == 1


def test_merge_reads_its_own_chunks(spark, tmp_path):
    def source(site, *ids):
        death = spark.createDataFrame([], "person_id bigint, death_date date")
        people = spark.createDataFrame([(i, None) for i in ids], "person_id bigint, care_site_id bigint")
        return merging.Source(site, site, DAY, {"person": people, "death": death})

    def merged(*sources):
        return merging.merge_deliveries(spark, list(sources), str(tmp_path / "m"), DAY, {"cdm_source_name": "all"}, "v5", run_at=RUN)

    assert merged(source("a", 1, 2), source("b", 3)).tables["person"].count() == 3
    done = merged(source("a", 1))
    assert done.tables["person"].count() == 1 == done.tables["care_site"].count() and done.tables["death"].count() == 0
    assert merged(source("a")).tables["person"].count() == 0


def test_run_log_takes_one_update_a_delivery(spark):
    start = spark.createDataFrame(
        [("a", DAY, RUN, "csv", "5.3", "r1"), ("a", DAY, RUN + dt.timedelta(hours=1), "csv", "5.3", "r2")],
        "site_name string, delivery_date date, pipeline_start_datetime timestamp_ntz, file_format string, cdm_version string, run_id string")
    log = runlog.log_started(spark.createDataFrame([], runlog.LOG_SCHEMA), start)
    assert [r.run_id for r in log.collect()] == ["r2"]
    ends = start.select("site_name", "delivery_date", F.col("pipeline_start_datetime").alias("pipeline_end_datetime"))
    done = runlog.log_completed(log, ends).collect()
    assert [r.pipeline_end_datetime for r in done] == [RUN + dt.timedelta(hours=1)]
    errors = spark.createDataFrame([("r2", RUN, "x"), ("r2", RUN, "y")], "run_id string, pipeline_end_datetime timestamp_ntz, message string")
    assert [r.message for r in runlog.log_failed(log, errors).collect()] == ["y"]


def test_report_reads_each_table_twice(spark, tmp_path):
    """One aggregate over the concepts and people of a table, one over its days."""
    path = str(tmp_path / "death")
    spark.createDataFrame([(1, 32, DAY)], "person_id bigint, death_type_concept_id bigint, death_date date").write.parquet(path)
    about = report.Delivery(spark, {"death": spark.read.parquet(path)}, vocabulary_tables(spark)["concept"], DAY)
    found = report.survey(about)
    scans = [f._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") for f in (found.concepts, found.days)]
    assert scans == [1, 1]
    plan = report.generate(about, [], RUN)._jdf.queryExecution().executedPlan().toString()
    assert path not in plan and "report-concepts" in plan


def test_rows_that_are_settled_do_not_shuffle(spark, codes):
    """With a vocabulary that may be broadcast no row of the table is exchanged."""
    rows = conditions(spark, [(10, 0, 1), (11, 99, 0)])
    plan = h.harmonize(rows, "condition_occurrence", codes)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(condition" not in plan and "SortMergeJoin" not in plan


def _vocabulary(spark, domain="Drug"):
    concept = spark.createDataFrame([(1, "S", "Drug"), (2, None, domain), (3, "S", "Measurement")],
                                    "concept_id bigint, standard_concept string, domain_id string")
    relationship = spark.createDataFrame([(2, 1, "Maps to"), (2, 3, "Maps to"), (1, 2, "Is a")],
                                         "concept_id_1 bigint, concept_id_2 bigint, relationship_id string")
    return concept, relationship


def test_lookups_are_made_once(spark, tmp_path, monkeypatch):
    """The same rows in any order and files are found again; a changed row makes new ones; half-written ones are no use."""
    built = []
    build = Vocabulary.build
    monkeypatch.setattr(Vocabulary, "build", staticmethod(lambda *a: built.append(1) or build(*a)))
    concept, relationship = _vocabulary(spark)
    root = str(tmp_path)
    one = Vocabulary.prepared(concept, relationship, root)
    two = Vocabulary.prepared(concept.repartition(5), relationship.orderBy(F.rand()).withColumn("odd", F.lit(1)), root)
    assert len(built) == 1 and one.profiles.inputFiles() == two.profiles.inputFiles()
    changed = Vocabulary.prepared(*_vocabulary(spark, "Device"), root)
    assert len(built) == 2 and changed.profiles.filter("concept_id = 2").first().domain == "Device"
    # A repeated row is another vocabulary as well.
    Vocabulary.prepared(concept.unionAll(concept.limit(1)), relationship, root)
    assert len(built) == 3
    # Without its manifest a folder is not taken up.
    fresh = tmp_path / "cut"
    Vocabulary.build(concept, relationship).store(f"{fresh}/lookups/x")
    Vocabulary.prepared(concept, relationship, str(fresh))
    assert len(built) == 5
    # A folder that lost rows is refused.
    spark.createDataFrame([], one.lookup.schema).write.mode("overwrite").parquet(one.lookup.inputFiles()[0].rsplit("/", 1)[0])
    with pytest.raises(Exception):
        Vocabulary.prepared(concept, relationship, root)


def test_the_summary_reads_rows_once(spark, codes, tmp_path):
    rows = spark.createDataFrame(
        [("a", "drug_exposure", "source_concept_id backfill", 1), ("a", "drug_exposure", "domain check", 1),
         ("a", "drug_exposure", "domain check", 2), ("b", "drug_exposure", "domain check", None), ("b", "note", "domain check", 2),
         ("c", "note", "domain check", 2), (None, "note", "domain check", 2)],
        "k string, target_table string, vocab_harmonization_status string, target_concept_id int")
    rows.write.parquet(str(tmp_path / "h"))
    rows = spark.read.parquet(str(tmp_path / "h"))
    summary = h.summary(rows, "drug_exposure", "k")
    got = {(r.kind, r.label): r.row_count for r in summary.collect()}
    parts = {h.TRANSITION: h.transitions(rows), h.STATUS_COUNT: h.status_counts(rows),
             h.CARDINALITY: h.mapping_cardinality(rows, "drug_exposure", "k"), h.DISPOSITION: h.row_disposition(rows, "drug_exposure", "k")}
    assert got == {(kind, str(r[0])): r[1] for kind, df in parts.items() for r in df.collect()}
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1


def test_two_writers_of_the_run_log(spark, tmp_path):
    """Who commits second applies the change to what the first has written."""
    def start(site):
        starts = spark.createDataFrame([(site, dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), "csv", "5.3", site)],
                                       "site_name string, delivery_date date, pipeline_start_datetime timestamp_ntz,"
                                       " file_format string, cdm_version string, run_id string")
        return lambda log: runlog.log_started(log, starts)

    root, tried = str(tmp_path / "log"), []

    def slow(log):
        if not tried:
            tried.append(runlog.RunLog(spark, root).commit(start("b")))
        return start("a")(log)

    assert runlog.RunLog(spark, root).read().isEmpty()
    assert runlog.RunLog(spark, root).commit(slow) == 2 and tried == [1]
    log = runlog.RunLog(spark, root)
    assert {r.site_name for r in log.read().collect()} == {"a", "b"} and log.version() == 2
    assert {r.site_name for r in log.read(1).collect()} == {"b"}
    ends = spark.createDataFrame([("a", dt.date(2024, 1, 1), dt.datetime(2024, 1, 2))],
                                 "site_name string, delivery_date date, pipeline_end_datetime timestamp_ntz")
    log.commit(lambda rows: runlog.log_completed(rows, ends))
    assert {r.site_name: r.status for r in log.read().collect()} == {"a": "completed", "b": "started"}
    # One who never gets through says so.
    with pytest.raises(RuntimeError, match="changed by others"):
        runlog.RunLog(spark, root, attempts=1).commit(lambda rows: (log.commit(lambda r: r), rows)[1])


def test_types_of_united_columns():
    from pyspark.sql import types as T

    pairs = [("int", "bigint", "bigint"), ("bigint", "double", "double"), ("float", "int", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
             ("date", "bigint", "string"), ("string", "double", "string"), ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"),
             ("decimal(5,2)", "bigint", "decimal(21,2)"), ("decimal(5,2)", "double", "double"), ("boolean", "int", "string"),
             ("void", "date", "date"), ("string", "string", "string"), ("decimal(5,2)", "date", "string")]
    for one, two, found in pairs:
        a, b, c = (T.StructType.fromDDL(f"x {k}")["x"].dataType if k != "void" else T.NullType() for k in (one, two, found))
        assert merge.common_type(a, b) == merge.common_type(b, a) == c


def test_an_unchanged_table_is_not_joined(spark):
    from medloom.operators import diff

    table = spark.range(2000).select((F.col("id") % 900).alias("k"))
    assert tuple(diff.diff_by_key(table, table.repartition(3), "k").first()) == (0, 0)
    sides = [diff._keys(df, "k") for df in (table, table.filter("k <> 5").unionAll(spark.createDataFrame([(7,), (5000,), (None,)], "k bigint")))]
    assert diff.differing_buckets(sides[0], sides[0]).isEmpty()
    assert 0 < diff.differing_buckets(*sides).count() <= 3
    after = table.filter("k <> 5").unionAll(spark.createDataFrame([(7,), (5000,), (5000,), (None,)], "k bigint"))
    assert tuple(diff.diff_by_key(table, after, "k").first()) == (2, 3)
    assert tuple(diff.diff_by_content(table, after).first()) == (3, 3)
    empty = table.limit(0)
    assert tuple(diff.diff_by_key(empty, table, "k").first()) == (2000, 0) and tuple(diff.diff_by_key(empty, empty, "k").first()) == (0, 0)
