from datetime import datetime

import pytest
from pyspark.sql.utils import AnalysisException

from riskframe.operators import quality
from riskframe.operators.quality import SchemaError
from riskframe.sources import payload, runs, tables
from riskframe.sources.schemas import APPLICANT_HEADERS, CARD_HEADERS
from riskframe.streaming import scoring


def test_card_csv_is_typed_renamed_and_checked(spark, tmp_path):
    good = tmp_path / "card.csv"
    good.write_text(",".join(CARD_HEADERS) + "\n" + ",".join(["1.5"] * 30 + ["1"]) + "\n")
    row = tables.read_card_transactions(spark, str(good)).first()
    assert row["time_s"] == 1.5 and row["amount"] == 1.5 and row["class"] == 1
    bad = tmp_path / "bad.csv"
    bad.write_text("Time,V1\n1,2\n")
    with pytest.raises(SchemaError, match="Amount, Class"):
        tables.read_card_transactions(spark, str(bad))
    with pytest.raises(AnalysisException):
        tables.read_card_transactions(spark, str(tmp_path / "none.csv"))


def test_retail_csv_is_latin1_and_pruned(spark, tmp_path):
    path = tmp_path / "retail.csv"
    head = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    lines = "C1,x,caf\xe9,2,2010-12-01 08:26:00,1.5,12345.0,UK\n2,x,y,3,2010-12-01 09:00:00,2.5,,UK\n"
    path.write_bytes((head + lines).encode("latin-1"))
    rows = tables.read_retail(spark, str(path)).orderBy("invoice").collect()
    assert [r["customer_id"] for r in rows] == [None, 12345]
    assert rows[1]["invoice_ts"] == datetime(2010, 12, 1, 8, 26)
    assert "description" not in rows[0].asDict()


def test_applicant_csv_ignores_the_index_column(spark, tmp_path):
    path = tmp_path / "cs.csv"
    path.write_text("," + ",".join(APPLICANT_HEADERS) + "\n1,0,0.5,40,0,0.3,NA,3,0,1,0,2\n")
    row = tables.read_applicants(spark, str(path)).first()
    assert row["age"] == 40 and row["monthly_income"] is None and "_c0" not in row.asDict()


def test_splits_read_back_one_partition(spark, tmp_path):
    df = spark.createDataFrame([(1, "train", 0), (2, "test", 1), (3, "test", 0)], "id int, split string, y int")
    path = str(tmp_path / "splits")
    tables.write_split(df, path, "y")
    test = tables.read_split(spark, path, "test", df.schema)
    assert sorted(r["id"] for r in test.collect()) == [2, 3]
    plan = test._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_run_log_keeps_the_latest_and_the_best(spark, tmp_path):
    path = str(tmp_path / "runs")
    for day, ap in ((1, 0.7), (3, 0.9), (2, 0.8)):
        runs.append_run(spark, path, f"r{day}", datetime(2024, 1, day), "fraud", {"ap": ap})
    for step, loss in ((1, 0.5), (2, 0.3), (3, 0.3)):
        runs.append_run(spark, path, "r9", datetime(2024, 2, 1), "fraud", {"val_loss": loss}, step)
    log = runs.read_runs(spark, path)
    last = {r["metric"]: r["value"] for r in runs.latest(log).collect()}
    assert last["ap"] == 0.9
    assert runs.best_step(log, "val_loss").first()["step"] == 2


def test_coefficients_survive_a_round_trip(spark, tmp_path):
    path = str(tmp_path / "cox")
    table = spark.createDataFrame([("a", 0.5), ("b", -1.25)], "feature string, coef double")
    tables.save_coefficients(table, path)
    assert tables.load_coefficients(spark, path, "feature", "coef") == {"a": 0.5, "b": -1.25}


def test_payload_types_ids_and_grades(spark):
    doc = (
        '{"loans":[{"loan_id":"L1","grade":"c","dti":"18.5","open_acc":10},'
        '{"grade":"B","dti":"oops"}]}'
    )
    df = spark.createDataFrame([(7, doc)], "request int, body string")
    rows = payload.explode_payload(df, "body", "loans", "loan_id", payload.LOAN_FIELDS).collect()
    assert [(r["loan_id"], r["grade"], r["dti"], r["open_acc"]) for r in rows] == [
        ("L1", "C", 18.5, 10), ("unknown", "B", None, None),
    ]
    scored = spark.createDataFrame([("L1", 0.25)], "loan_id string, pd double")
    assert payload.to_response(scored, "loan_id").first()["response"] == '{"loan_id":"L1","pd":0.25}'


def events(spark, path, rows):
    spark.createDataFrame(rows, "id long, ts timestamp, p double").coalesce(1).write.mode("append").parquet(path)


def test_a_drained_stream_equals_the_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    events(spark, path, [(1, datetime(2024, 1, 1, 0, 5), 0.95), (2, datetime(2024, 1, 1, 0, 6), None)])
    events(spark, path, [(3, datetime(2024, 1, 1, 0, 7), 0.6), (4, datetime(2024, 1, 1, 0, 8), 1.5)])
    rules = {"p": quality.within("p", 0.0, 1.0)}
    schema = spark.read.parquet(path).schema
    stream = scoring.read_stream(spark, path, schema, maxFilesPerTrigger=1)
    out = scoring.run_to_table(scoring.score_stream(stream, rules, scoring.label_scores), "s")
    batch = scoring.score_stream(spark.read.parquet(path), rules, scoring.label_scores)
    key = lambda r: r["id"]
    assert sorted(out.collect(), key=key) == sorted(batch.collect(), key=key)
    assert out.count() == 2


def test_windows_close_behind_the_watermark(spark, tmp_path):
    path = str(tmp_path / "in")
    events(spark, path, [(1, datetime(2024, 1, 1, 0, 5), 0.95), (2, datetime(2024, 1, 1, 0, 50), 0.95),
                         (3, datetime(2024, 1, 1, 1, 20), 0.1)])
    stream = scoring.label_scores(scoring.read_stream(spark, path, spark.read.parquet(path).schema))
    out = scoring.run_to_table(scoring.windowed_summary(stream, "ts", "risk_label"), "w").collect()
    assert [(r["risk_label"], r["n"]) for r in out] == [("HIGH", 2)]


def test_repeated_ids_pass_once(spark, tmp_path):
    path = str(tmp_path / "in")
    events(spark, path, [(1, datetime(2024, 1, 1, 0, 5), 0.9), (1, datetime(2024, 1, 1, 0, 6), 0.8),
                         (2, datetime(2024, 1, 1, 0, 7), 0.7)])
    stream = scoring.read_stream(spark, path, spark.read.parquet(path).schema)
    out = scoring.run_to_table(scoring.first_per_id(stream, "ts", "id"), "d")
    assert sorted(r["id"] for r in out.collect()) == [1, 2]


def test_rejected_rows_of_a_stream_are_kept(spark, tmp_path):
    path = str(tmp_path / "in")
    events(spark, path, [(1, datetime(2024, 1, 1, 0, 5), 0.95), (2, datetime(2024, 1, 1, 0, 6), None)])
    events(spark, path, [(3, datetime(2024, 1, 1, 0, 7), 0.6), (4, datetime(2024, 1, 1, 0, 8), 1.5)])
    stream = scoring.read_stream(spark, path, spark.read.parquet(path).schema, maxFilesPerTrigger=1)
    rules = {"p": quality.within("p", 0.0, 1.0)}
    valid, rejected = scoring.split_stream(stream, rules, scoring.label_scores, "split")
    assert sorted(r["id"] for r in valid.collect()) == [1, 3]
    assert sorted((r["id"], r["violations"]) for r in rejected.collect()) == [(2, ["p"]), (4, ["p"])]


def test_a_summary_holds_open_windows(spark, tmp_path):
    path = str(tmp_path / "in")
    for day in (1, 2, 3):
        events(spark, path, [(day, datetime(2024, 1, day, 0, m), 0.95) for m in range(4)])
    stream = scoring.read_stream(spark, path, spark.read.parquet(path).schema, maxFilesPerTrigger=1)
    out = scoring.summary_to_table(scoring.windowed_summary(scoring.label_scores(stream), "ts", "risk_label"), "open")
    assert sorted(r["n"] for r in out.collect()) == [4, 4, 4]


def test_row_ids_depend_on_values_alone(spark, monkeypatch):
    monkeypatch.setattr(tables, "EQUAL_ROWS", 3)
    rows = [(1, 0.5, None)] * 10 + [(2, None, "a"), (2, None, "b")]
    df = spark.createDataFrame(rows, "a int, b double, c string")
    once, again = (tables.with_row_id(df.repartition(n), "row_id").collect() for n in (1, 5))
    assert len({r["row_id"] for r in once}) == 12 and once[0].asDict().keys() == {"row_id", "a", "b", "c"}
    assert {r["row_id"] for r in once} == {r["row_id"] for r in again}


def test_files_without_ids_reach_the_operators(spark, tmp_path):
    from riskframe.operators import loans

    path = tmp_path / "loans.csv"
    values = {
        "loan_status": "Charged Off", "issue_d": "Jan-2015", "last_pymnt_d": "Jan-2016", "term": " 36 months",
        "int_rate": "12.5%", "grade": "B", "emp_length": "3 years", "revol_util": "30%",
    }
    lines = [",".join(values.get(c, "100") for c in loans.RAW_COLUMNS)] * 2
    path.write_text("\n".join([",".join(loans.RAW_COLUMNS), *lines]) + "\n")
    read = tables.read_loans(spark, str(path))
    assert read.select("loan_id").distinct().count() == 2
    assert loans.survival_table(read).count() == 2
