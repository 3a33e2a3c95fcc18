import datetime as dt
import gzip
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from medloom import schema
from medloom.sources import encoding, ingest, publish, storage

CSV = 'Person ID,"Offset",Note\n1,2,plain\n3,4\n5,6,7,8\n9,"a\nb","say ""hi"""\nNULL,null,Null\n11,12,\n'


def test_csv_with_quoted_newlines(spark, tmp_path):
    path = tmp_path / "note.csv"
    path.write_text(CSV)
    good, bad = ingest.read_csv(spark, str(path))
    assert good.columns == ["personid", "offset", "note"]
    assert sorted((tuple(r) for r in good.collect()), key=str) == sorted([
        ("1", "2", "plain"), ("3", "4", None), ("9", "a\nb", 'say "hi"'), (None, None, "Null"), ("11", "12", None)], key=str)
    assert [tuple(r) for r in bad.collect()] == [("5,6,7,8", "too many values")]
    assert [r.line for r in bad.select("line").collect()] == ["5,6,7,8"]
    assert good.select("note").count() == 5


def read(spark, path, text, **options):
    path.write_text(text)
    good, bad = ingest.read_csv(spark, str(path), **options)
    return sorted((tuple(r) for r in good.collect()), key=str), sorted(tuple(r) for r in bad.collect())


def test_a_stray_quote_costs_one_line(spark, tmp_path):
    lines = [f"{i},plain {i},x" for i in range(100_000)]
    lines[40_000] = '40000,"open,x'
    good, bad = ingest.read_csv(spark, _written(tmp_path / "a.csv", "a,b,c\n" + "\n".join(lines) + "\n"))
    assert good.count() == 99_999
    assert [tuple(r) for r in bad.collect()] == [('40000,"open,x', "open quote")]


def _written(path, text):
    path.write_text(text)
    return str(path)


def test_two_stray_quotes_swallow_nothing(spark, tmp_path):
    good, bad = read(spark, tmp_path / "a.csv", 'a,b\n1,"x\n2,y\n3,"z\n4,w\n5,"p\n6,"q\n')
    assert good == [("2", "y"), ("4", "w")]
    assert [b for _, b in bad] == ["open quote"] * 4


def test_quotes_within_values_are_text(spark, tmp_path):
    good, bad = read(spark, tmp_path / "a.csv", 'a,b\n1,5" tall\n2,6" tall\n3,y\n')
    assert good == [("1", '5" tall'), ("2", '6" tall'), ("3", "y")] and not bad


@pytest.mark.parametrize("block", ["64", "300", "134217728"])
def test_records_over_many_lines_and_blocks(spark, tmp_path, block):
    """Records that cross the border of two blocks, with blank and short lines inside."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    rows = [(str(i), f"line one\n\nli, ne ""two"" {i}\nend" if i % 3 else f"plain {i}", str(i * i)) for i in range(60)]
    text = "a,b,c\n" + "".join(f'{a},"{b}",{c}\n' if i % 3 else f"{a},{b},{c}\n" for i, (a, b, c) in enumerate(rows))
    good, bad = read(spark, tmp_path / "a.csv", text)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert good == sorted(rows, key=str) and not bad


def test_long_values(spark, tmp_path):
    long = "word " * 200_000
    quoted = 'say ""hi"", ' * 3000
    text = f'a,b,c\n1,"{long}",x\n2,"{quoted}\n{quoted}",y\n3,"{quoted}"\n4,"{quoted}",a,b\n'
    good, bad = read(spark, tmp_path / "a.csv", text)
    plain = quoted.replace('""', '"')
    assert good == sorted([("1", long, "x"), ("2", plain + "\n" + plain, "y"), ("3", plain, None)], key=str)
    assert [r for _, r in bad] == ["too many values"]


def test_records_of_any_length(spark, tmp_path):
    body = "2,y\n" * 60_000
    good, bad = read(spark, tmp_path / "a.csv", 'a,b\n1,"x\n' + body + 'z"\n2,w\n')
    assert good == [("1", "x\n" + body + "z"), ("2", "w")] and not bad


def test_lines_like_records_within_a_value(spark, tmp_path):
    good, bad = read(spark, tmp_path / "a.csv", 'a,b\n1,"x\n2,y\nz"\n3,w\n')
    assert good == [("1", "x\n2,y\nz"), ("3", "w")] and not bad


def test_header_over_lines_and_rows_like_it(spark, tmp_path):
    good, bad = read(spark, tmp_path / "a.csv", 'a,"b\nc",d\n1,"x\ny",2\n3,4\n')
    assert good == [("1", "x\ny", "2"), ("3", "4", None)] and not bad
    assert ingest.read_csv(spark, str(tmp_path / "a.csv"))[0].columns == ["a", "bc", "d"]
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(3):
        (folder / f"{i}.csv").write_text('a,b\na,b\n' + (f'{i},"p\na,b\nq"\n' if i else "0,x\n"))
    for chosen, expected in [("*.csv", [("0", "x"), ("1", "p\na,b\nq"), ("2", "p\na,b\nq")]), ("0.csv", [("0", "x")])]:
        good, bad = ingest.read_csv(spark, str(folder if chosen == "*.csv" else folder / chosen))
        rows = sorted(tuple(r) for r in good.collect())
        assert rows == expected + [("a", "b")] * len(expected) and bad.isEmpty()


def test_line_ends(spark, tmp_path):
    for end in ("\r\n", "\r", "\n"):
        path = tmp_path / "a.csv"
        path.write_bytes(f'a,b{end}1,"x{end}{end}y"{end}{end}2,w {end}'.encode())
        good, bad = ingest.read_csv(spark, str(path))
        assert sorted(tuple(r) for r in good.collect()) == [("1", f"x{end}{end}y"), ("2", "w ")] and bad.isEmpty()
        path.write_bytes(f"a,b{end} 1,5\" tall{end}{end}2,w {end}".encode())
        good, bad = ingest.read_csv(spark, str(path))
        assert sorted(tuple(r) for r in good.collect()) == [(" 1", '5" tall'), ("2", "w ")] and bad.isEmpty()


def strict(text, width):
    """Records by a parser that goes line by line, trying each open quote to its end."""
    lines, out, rejected, i = text.split("\n"), [], [], 0

    def fields(body):
        """Values of a record and whether a quote is left open; None if it is malformed."""
        found, at = [], 0
        while True:
            if body[at:at + 1] == '"':
                end, value = at + 1, ""
                while True:
                    stop = body.find('"', end)
                    if stop < 0:
                        return found, True
                    value += body[end:stop]
                    if body[stop + 1:stop + 2] == '"':
                        value, end = value + '"', stop + 2
                        continue
                    break
                if body[stop + 1:stop + 2] not in ("", ","):
                    return None, False
                at = stop + 1
            else:
                stop = body.find(",", at)
                value, at = (body[at:], len(body)) if stop < 0 else (body[at:stop], stop)
            found.append(value)
            if at >= len(body):
                return found, False
            at += 1

    while i < len(lines):
        if not lines[i].strip(" "):
            i += 1
            continue
        for j in range(i, len(lines)):
            found, open_ = fields("\n".join(lines[i:j + 1]))
            if not open_:
                break
        if found is None or open_ or len(found) > width:
            rejected.append(lines[i])
            i += 1
        else:
            out.append(tuple([v or None for v in found] + [None] * (width - len(found))))
            i = j + 1
    return out, rejected


@pytest.mark.parametrize("seed", range(3))
def test_random_files_against_a_parser(spark, tmp_path, seed):
    """Quotes, separators and line breaks in any order, over blocks of a few bytes."""
    rng = random.Random(seed)
    pieces = ['"', '"', '""', ",", ",", "\n", "\n", "a", "b", '",', ',"', '"\n', '\n"']
    text = "".join(rng.choice(pieces) for _ in range(500)) + "\n"
    spark.conf.set("spark.sql.files.maxPartitionBytes", str([100_000, 128, 50][seed]))
    try:
        good, bad = ingest.read_csv(spark, _written(tmp_path / "a.csv", text), names=["x", "y", "z"])
        found = Counter(tuple(r) for r in good.collect()), Counter(r.line for r in bad.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected, rejected = strict(text, 3)
    over_lines = Counter(r for r in expected if any("\n" in (v or "") for v in r))
    assert Counter({r: n for r, n in found[0].items() if any("\n" in (v or "") for v in r)}) == over_lines
    assert sum(found[0].values()) + sum(found[1].values()) == len(expected) + len(rejected)
    assert not Counter(expected) - found[0] - over_lines


def test_encodings_are_found(spark, tmp_path):
    text = 'näme,b\n1,"dé\njà 東"\n2,€\n' + "".join(f"{i},plain\n" for i in range(3, 40))
    for name, raw in [("UTF-8", text.encode()), ("UTF-8", b"\xef\xbb\xbf" + text.encode()), ("UTF-16LE", text.encode("utf-16-le")),
                      ("UTF-16BE", text.encode("utf-16-be")), ("UTF-16LE", b"\xff\xfe" + text.encode("utf-16-le")),
                      ("UTF-16BE", b"\xfe\xff" + text.encode("utf-16-be"))]:
        path = tmp_path / "a.csv"
        path.write_bytes(raw)
        assert encoding.encoding_of(spark, str(path)).name == name
        for given in (None, name):
            good, bad = ingest.read_csv(spark, str(path), encoding=given)
            rows = {r[0]: r[1] for r in good.collect()}
            assert good.columns == ["näme", "b"] and len(rows) == 39 and bad.isEmpty()
            assert rows["1"] == "dé\njà 東" and rows["2"] == "€"
    for name, two in (("ISO-8859-1", "\xa3"), ("windows-1252", "€")):
        path.write_bytes('a,b\n1,"dé\njà"\n2,'.encode("latin-1") + (b"\x80" if two == "€" else b"\xa3") + b"\n")
        assert encoding.encoding_of(spark, str(path)).name == name
        assert sorted(tuple(r) for r in ingest.read_csv(spark, str(path))[0].collect()) == [("1", "dé\njà"), ("2", two)]
    zipped = tmp_path / "z.csv.gz"
    zipped.write_bytes(gzip.compress(text.encode("utf-16-le")))
    assert ingest.read_csv(spark, str(zipped))[0].count() == 39
    (tmp_path / "e.csv").write_text("")
    assert encoding.encoding_of(spark, str(tmp_path / "e.csv")).name == "UTF-8"


def test_csv_strict_fails(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a,b\n1,2\n3\n")
    assert ingest.read_csv(spark, str(path), strict=True)[0].count() == 2
    path = tmp_path / "b.csv"
    path.write_text("a,b\n1,2,3\n")
    with pytest.raises(Exception, match="too many values"):
        ingest.read_csv(spark, str(path), strict=True)[0].collect()


def test_gzip_and_encoding(spark, tmp_path):
    zipped, latin = tmp_path / "a.csv.gz", tmp_path / "b.csv"
    zipped.write_bytes(gzip.compress(b"a,b\n1,2\n"))
    latin.write_bytes("a,b\nd\xe9j\xe0,2\n".encode("latin-1"))
    assert ingest.read_delivery_file(spark, str(zipped)).collect()[0].a == "1"
    assert ingest.read_delivery_file(spark, str(latin), encoding="ISO-8859-1").collect()[0].a == "d\xe9j\xe0"
    with pytest.raises(ValueError):
        ingest.read_delivery_file(spark, "a.xlsx")


def test_parquet_becomes_text(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    spark.createDataFrame([(1, "NULL", 2.5)], "`Person-ID` bigint, `A b` string, offset double").write.parquet(path)
    df = ingest.read_delivery_file(spark, path)
    assert df.columns == ["personid", "ab", "offset"] and tuple(df.first()) == ("1", None, "2.5")


def test_vocabulary_file(spark, tmp_path):
    path = tmp_path / "CONCEPT.csv"
    path.write_text('concept_id\tconcept_name\tvalid_start_date\tinvalid_reason\n7\ta "quoted name\t20200131\t\n')
    row = ingest.read_vocabulary(spark, str(path), "concept").first()
    assert (row.concept_id, row.concept_name, row.valid_start_date, row.invalid_reason) == (
        7, 'a "quoted name', dt.date(2020, 1, 31), None)


def test_names():
    assert ingest.clean_name(' "Person ID" ') == "personid"
    assert ingest.clean_name("a-b_c.D") == "ab_cd"


def test_shared_folder_is_the_clusters(spark):
    assert storage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = storage.materialize(spark.range(3), "x")
    assert df.count() == 3 and df.inputFiles()[0].removeprefix("file:").lstrip("/").startswith(
        storage.shared_folder(spark).lstrip("/"))


def test_publish_replaces_and_skips(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS pub")
    visits = spark.createDataFrame([(1, "2020-01-01")], "visit_occurrence_id bigint, visit_start_date string")
    delivery = {"visit_occurrence": visits, "person": spark.createDataFrame([(1,)], "person_id bigint")}
    assert publish.publish_harmonized(delivery, "pub") == ["visit_occurrence"]
    assert publish.publish_derived(delivery, "pub") == []
    assert publish.publish_harmonized({**delivery, "visit_occurrence": visits.limit(0)}, "pub") == ["visit_occurrence"]
    table = spark.table("pub.visit_occurrence")
    assert table.isEmpty() and dict(table.dtypes)["visit_start_date"] == "date"
    assert not publish.publish(None, "pub.nothing")


def test_missing_tables_are_made_and_others_conformed(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS made")
    spark.createDataFrame([(5, "2020-01-01")], "person_id bigint, death_date string").write.saveAsTable("made.death")
    made = publish.create_missing(spark, "made")
    assert set(made) == set(schema.tables()) - {"death"}
    assert spark.table("made.death").first().death_date == dt.date(2020, 1, 1)
    assert [(f.name, f.dataType) for f in spark.table("made.note").schema] == [
        (f.name, f.dataType) for f in schema.layout("note")]
    assert publish.create_missing(spark, "made") == []


def test_a_swap_that_was_cut_off_is_finished(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS cut")
    def table(name, n):
        spark.createDataFrame([(n, dt.date(2020, 1, n))], "person_id bigint, death_date date").write.mode("overwrite").saveAsTable(f"cut.{name}")
    table("death", 1)
    table("death_conformed", 2)
    publish._recover(spark, "cut.death")
    assert spark.table("cut.death").first().person_id == 1 and not spark.catalog.tableExists("cut.death_conformed")
    spark.sql("ALTER TABLE cut.death RENAME TO cut.death_former")
    table("death_conformed", 2)
    publish._recover(spark, "cut.death")
    assert spark.table("cut.death").first().person_id == 2 and not spark.catalog.tableExists("cut.death_former")


def test_files(spark, tmp_path):
    df = spark.range(5).withColumn("line", F.concat(F.lit("line "), F.col("id").cast("string")))
    publish.write_csv(df, str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("*.csv"))) == 1
    publish.write_lines(df, ["id"], str(tmp_path / "t"))
    text = "".join(f.read_text() for f in sorted((tmp_path / "t").glob("*.txt")))
    assert text.split("\n")[:5] == [f"line {i}" for i in range(5)]
    empty = publish.write_parquet(df.limit(0), str(tmp_path / "e"), partition_by=["line"])
    assert empty.columns == ["id", "line"] and empty.isEmpty()
    assert publish.read_if_present(spark, str(tmp_path / "none")) is None
    back = publish.write_parquet(df, str(tmp_path / "p"))
    with pytest.raises(Exception):
        publish.write_parquet(back, str(tmp_path / "p"))
    assert publish.folder_of("note") == publish.ROUTED and publish.folder_of("drug_era") == publish.DERIVED


def test_a_failed_publish_leaves_the_former_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS safe")
    good = spark.createDataFrame([(1,), (2,)], "person_id bigint")
    assert publish.publish(good, "safe.person")
    bad = spark.range(1000).select(F.when(F.col("id") == 999, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("bigint").alias("person_id"))
    with pytest.raises(Exception, match="broken"):
        publish.publish(bad, "safe.person")
    assert sorted(r.person_id for r in spark.table("safe.person").collect()) == [1, 2]
    assert publish.published_versions(spark, "safe.person").count() == 1
    # One who still reads the former version is not disturbed by the next.
    before = spark.table("safe.person")
    files = before.inputFiles()
    assert publish.publish(good.limit(0), "safe.person")
    assert spark.read.parquet(*files).count() == 2 and spark.table("safe.person").isEmpty()
    assert [(r.number, r.row_count) for r in publish.published_versions(spark, "safe.person").orderBy("number").collect()] == [(1, 2), (2, 0)]


def test_publish_with_another_layout(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS safe")
    spark.createDataFrame([(1,)], "a int").write.mode("overwrite").saveAsTable("safe.note")
    assert publish.publish(spark.createDataFrame([("x", 2.5)], "a string, `b c` double"), "safe.note")
    assert [tuple(r) for r in spark.table("safe.note").collect()] == [("x", 2.5)]
    assert publish.published_versions(spark, "safe.none").count() == 0


def test_only_one_creates_a_folder(spark, tmp_path):
    one, two = (spark.createDataFrame([(i,)], "i int") for i in (1, 2))
    assert storage.create_once(one, str(tmp_path / "x")) and not storage.create_once(two, str(tmp_path / "x"))
    assert storage.read_completed(spark, str(tmp_path / "x")).first().i == 1
    assert [p.name for p in tmp_path.iterdir()] == ["x"]
    # What was cut off counts as not there.
    (tmp_path / "half").mkdir()
    assert storage.read_completed(spark, str(tmp_path / "half")) is None
    assert storage.numbered(spark, str(tmp_path)) == ["x"] and storage.numbered(spark, str(tmp_path / "no")) == []


def test_create_once_leaves_the_work_in_several_tasks(spark, tmp_path):
    from pyspark import TaskContext

    from medloom.sources.storage import create_once

    task = F.udf(lambda x: TaskContext.get().taskAttemptId(), "long")
    rows = spark.range(0, 64, 1, 8).select("id", task("id").alias("task"))
    assert create_once(rows, f"{tmp_path}/made")
    made = spark.read.parquet(f"{tmp_path}/made")
    assert made.count() == 64 and made.select("task").distinct().count() == 8
    assert len(list((tmp_path / "made").glob("part-*"))) == 1


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_records_over_runs_of_lines(spark, tmp_path, monkeypatch, bits):
    from medloom.sources import records

    # One file that one task reads; its lines are judged run by run, and a run's lines sorted by a task of their own.
    values = [(str(i), 'a"\n' * (i % 4) + "x", '"' if i % 5 == 0 else "e,f") for i in range(40)]
    text = "id,note,more\n" + "".join(
        ",".join('"' + v.replace('"', '""') + '"' for v in row) + "\n" for row in values) + '41,"open,1\n42,5" tall,z\n'
    (tmp_path / "t.csv").write_text(text)
    monkeypatch.setattr(ingest, "BLOCK_BITS", bits)
    monkeypatch.setattr(records, "EVENTS_PER_TASK", 10)
    lines = ingest._lines(spark, str(tmp_path / "t.csv"), encoding.encoding_of(spark, str(tmp_path / "t.csv")))
    assert max(r["count"] for r in lines.groupBy("block").count().collect()) == 1 << bits
    good, bad = ingest.read_csv(spark, str(tmp_path / "t.csv"))
    assert sorted(map(tuple, good.collect())) == sorted([*values, ("42", '5" tall', "z")])
    assert [tuple(r) for r in bad.collect()] == [('41,"open,1', "open quote")]


def test_a_line_is_judged_once(spark):
    lines = spark.createDataFrame([('1,"a",b',)], "line string")
    reason = ingest.rejection(F.col("line"), F.lit(False), 3)
    told = lines.select(reason.alias("reason")).filter("reason IS NOT NULL")
    plan = told._jdf.queryExecution().executedPlan().toString()
    # The expression that takes values off stands once in the filter and once beside it.
    assert plan.split("Filter")[1].count("regexp_replace(replace") <= 1
