import random

import pytest
from pyspark.sql import functions as F

from lakemart.sources import landing, multiline

TABLE = "raw_order_reviews"
COLUMNS = landing.BRONZE_COLUMNS[TABLE]
HEADER = ",".join(COLUMNS)


def field(rng):
    text = "".join(rng.choice(['a', 'b', ' ', '\n', '\n', ',', '"', 'é']) for _ in range(rng.randrange(9)))
    if rng.random() < 0.6 or any(c in text for c in '\n,') or text.startswith('"'):
        return '"' + text.replace('"', '""') + '"'
    return text  # quotes within an unquoted field are plain characters


def drop(rng, n, ending="\n"):
    rows = []
    for k in range(n):
        row = [str(k)] + [field(rng) for _ in COLUMNS[1:]]
        if rng.random() < 0.1:
            row.append("extra")
        rows.append(",".join(row))
        if rng.random() < 0.1:
            rows.append("")
    return (HEADER + "\n" + "\n".join(rows) + "\n").replace("\n", ending)


def whole_files(spark, path):
    """Spark's own reader, one task a file."""
    parsed = spark.read.schema(landing.landing_schema(TABLE)).options(**landing.csv_options(TABLE)).csv(path)
    return landing.with_audit(parsed, TABLE, "2024-01-07 00:00:00")


def rows_of(df):
    """Rows as texts; of a rejected record the text with one kind of line break and none at its end."""
    bad = F.regexp_replace(F.regexp_replace(landing.CORRUPT, "\r\n", "\n"), r"\n+\z", "")
    out = df.select(*COLUMNS, "_file_name", bad.alias("bad"))
    return sorted(map(str, out.collect()))


@pytest.fixture()
def small_splits(spark):
    """Files of a few hundred bytes are cut into many splits."""
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "97")
    yield
    spark.conf.set(key, old)


def test_lines_that_end_inside_quotes(spark):
    cases = ['a,b', '"a', 'a,"b', '', '"a"', '""', '"""', 'a"b', '"a""', 'a"', '",', 'x,"",y', '"a"b,"c',
             '"a"b"c,d', ',', ',"', '"",""', '"a,""b', 'é,"é']
    df = spark.createDataFrame([(k,) for k in cases], "v string").select(
        "v", F.col("v").rlike(multiline._ENDS_INSIDE).alias("o"),
        F.concat(F.lit('"'), "v").rlike(multiline._ENDS_INSIDE).alias("i"))
    assert {r.v: (r.o, r.i) for r in df.collect()} == {k: (walk(k), walk('"' + k)) for k in cases}


def walk(line):
    """Whether a line ends inside quotes, character by character."""
    state = "start"
    for c in line:
        if state == "quoted":
            state = "closing" if c == '"' else "quoted"
        elif state == "closing" and c == '"':
            state = "quoted"
        elif c == ",":
            state = "start"
        else:
            state = "quoted" if state == "start" and c == '"' else "plain"
    return state == "quoted"


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_records_equal_those_of_whole_files(spark, tmp, small_splits, ending):
    rng = random.Random(ending)
    for n in (0, 1, 12, 60):
        with open(f"{tmp}/r{n}.csv", "w", newline="") as f:
            f.write(drop(rng, n, ending))
    want = rows_of(whole_files(spark, tmp))
    assert len(want) > 60
    for block_lines in (1, 3, 1000):
        got = landing.read_landing(spark, tmp, TABLE, "2024-01-07 00:00:00", block_lines)
        assert rows_of(got) == want
    lines = multiline.read_lines(spark.read, f"{tmp}/r60.csv")
    assert lines.rdd.getNumPartitions() > 10  # one file, many tasks


def test_field_longer_than_blocks_and_first_error(spark, tmp, small_splits):
    long = "\n".join(f"line {k}, of \"\"many\"\"" for k in range(200))
    text = f'{HEADER}\nr1,o1,5,t,"{long}",d,d\nbad,1\nr2,o2,5,t,"x\n\ny",d,d\nbad,2\nr3,o3,5,t,never "closed,d,"d'
    with open(f"{tmp}/a.csv", "w") as f:
        f.write(text)
    got = landing.read_landing(spark, tmp, TABLE, "2024-01-07 00:00:00", 7)
    assert rows_of(got) == rows_of(whole_files(spark, tmp))
    good = {r.review_id: r for r in landing.split_quarantine(got)[0].collect()}
    assert good["r1"].review_comment_message == long.replace('""', '"')
    assert good["r2"].review_comment_message == "x\n\ny"
    report = landing.file_report(landing.numbered(got)).first()
    assert (report.rows_rejected, report.first_error) == (2, "bad,1")


def test_empty_folder_and_files(spark, tmp):
    for name, text in {"a.csv": "", "b.csv": "\n\n", "c.csv": HEADER, "d.csv": "\n" + HEADER + "\n\n"}.items():
        with open(f"{tmp}/{name}", "w") as f:
            f.write(text)
    assert landing.read_landing(spark, tmp, TABLE).count() == 0


def test_only_longer_records_are_shuffled_by_record(spark, tmp):
    with open(f"{tmp}/a.csv", "w") as f:
        f.write(drop(random.Random(1), 20))
    found = multiline.records(spark, multiline.read_lines(spark.read, tmp))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 3  # the blocks in either branch, and the longer records
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()
