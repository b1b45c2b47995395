import datetime as dt
import os

from lakemart.plans import catalog
from lakemart.sources import landing
from lakemart.streaming import file_ledger

HEADER = "review_id,order_id,review_score,review_comment_title,review_comment_message," \
         "review_creation_date,review_answer_timestamp\n"


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_csv_quoting_quarantine_and_tokens(spark, tmp):
    folder = f"{tmp}/reviews"
    write(folder, "w1.csv", HEADER
          + 'r1,o1,5,"say ""hi""","two\nlines",2018-01-01,2018-01-02\n'
          + "r2,o1,NULL,None,,2018-01-01,2018-01-02\n"
          + "r3,o1,5\n"
          + "r4,o1,5,a,b,c,d,e,f\n")
    loaded = landing.read_landing(spark, folder, "raw_order_reviews", "2024-01-07 00:00:00")
    good, bad = landing.split_quarantine(loaded)
    g = {r.review_id: r for r in good.collect()}
    assert set(g) == {"r1", "r2"}
    assert g["r1"].review_comment_title == 'say "hi"' and g["r1"].review_comment_message == "two\nlines"
    assert g["r2"].review_score is None and g["r2"].review_comment_title is None
    assert g["r1"]._file_name.endswith("/w1.csv") and g["r1"]._loaded_at == dt.datetime(2024, 1, 7)
    assert bad.count() == 2
    files = landing.file_report(landing.numbered(loaded))
    rep = landing.load_report({"raw_order_reviews": files}).first()
    assert (rep.files_loaded, rep.files_errored, rep.rows_loaded, rep.rows_rejected) == (0, 1, 2, 2)
    assert rep.first_error.strip() == "r3,o1,5"


def test_incremental_ledger(spark, tmp):
    landing_root, bronze, ckpt = f"{tmp}/landing", f"{tmp}/bronze", f"{tmp}/ckpt"
    folder = f"{landing_root}/payments"
    head = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    write(folder, "p1.csv", head + "o1,1,credit_card,1,10\no2,1,boleto,1,5\n")
    t = ["raw_order_payments"]
    r1 = file_ledger.load_incremental(spark, landing_root, bronze, ckpt, t, "2024-01-07 00:00:00").first()
    assert (r1.files_loaded, r1.rows_loaded) == (1, 2)
    r2 = file_ledger.load_incremental(spark, landing_root, bronze, ckpt, t, "2024-01-14 00:00:00").first()
    assert (r2.files_loaded, r2.rows_loaded) == (0, 0)
    write(folder, "p2.csv", head + "o3,1,voucher,1,7\n")
    r3 = file_ledger.load_incremental(spark, landing_root, bronze, ckpt, t, "2024-01-21 00:00:00").first()
    assert (r3.files_loaded, r3.rows_loaded) == (1, 1)
    assert landing.bronze_table(spark, f"{bronze}/raw_order_payments").count() == 3
    hist = spark.read.parquet(f"{bronze}/{file_ledger.HISTORY}")
    assert hist.count() == 2


def test_forced_and_incremental_loads_share_one_layout(spark, tmp):
    landing_root, bronze, ckpt = f"{tmp}/landing", f"{tmp}/bronze", f"{tmp}/ckpt"
    head = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    write(f"{landing_root}/payments", "p1.csv", head + "o1,1,credit_card,1,10\n")
    t = ["raw_order_payments"]
    file_ledger.load_incremental(spark, landing_root, bronze, ckpt, t, "2024-01-07 00:00:00")
    rep = file_ledger.full_reload(spark, landing_root, bronze, ckpt, t, dt.datetime(2024, 1, 8)).first()
    assert rep.rows_loaded == 1
    root = f"{bronze}/raw_order_payments"
    assert landing.bronze_table(spark, root).count() == 2          # forced load re-appends
    assert landing.bronze_table(spark, root, dt.datetime(2024, 1, 8)).count() == 1   # pruned
    file_ledger.full_reload(spark, landing_root, bronze, ckpt, t, dt.datetime(2024, 1, 9), truncate=True)
    assert landing.bronze_table(spark, root).count() == 1


def test_one_failing_table_does_not_stop_the_others(spark, tmp):
    import pytest
    landing_root, bronze, ckpt = f"{tmp}/landing", f"{tmp}/bronze", f"{tmp}/ckpt"
    write(f"{landing_root}/payments", "p1.csv",
          "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,x,1,1\n")
    write(f"{landing_root}/sellers", "s1.csv", "seller_id,zip,city,state\ns1,1,a,b\n")
    os.makedirs(bronze, exist_ok=True)
    with open(f"{bronze}/raw_order_payments", "w") as f:   # a file where a folder must go
        f.write("blocked")
    with pytest.raises(file_ledger.LoadFailed, match="raw_order_payments") as failed:
        file_ledger.load_incremental(spark, landing_root, bronze, ckpt,
                                     ["raw_order_payments", "raw_sellers"], "2024-01-07 00:00:00")
    assert landing.bronze_table(spark, f"{bronze}/raw_sellers").count() == 1
    report = failed.value.report.collect()
    assert [(r.table, r.files_loaded, r.rows_loaded) for r in report] == [("raw_sellers", 1, 1)]


HEAD = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
PAYMENTS = ["raw_order_payments"]


def loaded(spark, bronze):
    return sorted((r.order_id, str(r._loaded_at)) for r in landing.bronze_table(
        spark, f"{bronze}/raw_order_payments").collect())


def test_failed_load_is_tried_again_under_a_new_stamp(spark, tmp):
    import pytest
    land, bronze, ckpt = f"{tmp}/landing", f"{tmp}/bronze", f"{tmp}/ckpt"
    write(f"{land}/payments", "p1.csv", HEAD + "o1,1,card,1,10\no2,1,card,1,5\n")

    def stop(batch):
        raise OSError(batch)

    with pytest.raises(file_ledger.LoadFailed):
        file_ledger.load_incremental(spark, land, bronze, ckpt, PAYMENTS, "2024-01-07", after_land=stop)
    rep = file_ledger.load_incremental(spark, land, bronze, ckpt, PAYMENTS, "2024-01-14").first()
    assert rep.rows_loaded == 2
    assert loaded(spark, bronze) == [("o1", "2024-01-07 00:00:00"), ("o2", "2024-01-07 00:00:00")]
    with pytest.raises(file_ledger.LoadFailed):
        file_ledger.full_reload(spark, land, bronze, ckpt, PAYMENTS, "2024-01-15", after_land=stop)
    file_ledger.full_reload(spark, land, bronze, ckpt, PAYMENTS, "2024-01-16")
    assert len(loaded(spark, bronze)) == 4


def test_forced_then_incremental_then_forced(spark, tmp):
    land, bronze, ckpt = f"{tmp}/landing", f"{tmp}/bronze", f"{tmp}/ckpt"
    write(f"{land}/payments", "p1.csv", HEAD + "o1,1,card,1,10\no2,1,card,1,5\n")
    file_ledger.full_reload(spark, land, bronze, ckpt, PAYMENTS)
    rep = file_ledger.load_incremental(spark, land, bronze, ckpt, PAYMENTS).first()
    assert (rep.files_loaded, rep.files_skipped, rep.rows_loaded) == (0, 1, 0)
    assert len(loaded(spark, bronze)) == 2
    write(f"{land}/payments", "p2.csv", HEAD + "o3,1,card,1,7\n")
    # two forced loads in quick succession are two loads; new files land once in the first
    file_ledger.full_reload(spark, land, bronze, ckpt, PAYMENTS)
    assert [o for o, _ in loaded(spark, bronze)] == ["o1", "o1", "o2", "o2", "o3"]
    file_ledger.full_reload(spark, land, bronze, ckpt, PAYMENTS)
    assert len(loaded(spark, bronze)) == 8


def test_files_without_rows_count_as_loaded(spark, tmp):
    land, bronze, ckpt = f"{tmp}/landing", f"{tmp}/bronze", f"{tmp}/ckpt"
    write(f"{land}/payments", "p1.csv", HEAD)
    rep = file_ledger.load_incremental(spark, land, bronze, ckpt, PAYMENTS, "2024-01-07").first()
    assert (rep.files_loaded, rep.rows_loaded) == (1, 0) and loaded(spark, bronze) == []
    write(f"{land}/payments", "p2.csv", HEAD + "o3,1,card,1,7\n")
    write(f"{land}/payments", "p3.csv", HEAD)
    rep = file_ledger.load_incremental(spark, land, bronze, ckpt, PAYMENTS, "2024-01-14").first()
    assert (rep.files_loaded, rep.files_skipped, rep.rows_loaded) == (2, 1, 1)


def test_load_time_must_go_forward(spark, tmp):
    import pytest
    land, bronze, ckpt = f"{tmp}/landing", f"{tmp}/bronze", f"{tmp}/ckpt"
    write(f"{land}/payments", "p1.csv", HEAD + "o1,1,card,1,10\n")
    file_ledger.load_incremental(spark, land, bronze, ckpt, PAYMENTS, "2024-01-07")
    for stamp in ("2024-01-07", "2024-01-06"):
        with pytest.raises(ValueError, match="not after"):
            file_ledger.load_incremental(spark, land, bronze, ckpt, PAYMENTS, stamp)


def test_files_with_audit_columns(spark, tmp):
    folder = f"{tmp}/payments"
    head = HEAD.strip() + ",_file_name,_loaded_at\n"
    write(folder, "p1.csv", head + "o1,1,card,1,10,old.csv,2020-01-01 00:00:00\n"
          + 'o2,1,"a, ""b""",1,5,old.csv,2020-01-01T00:00:00.5\n'
          + "o3,1,card,1,7,x,y\n" + "o4,1,card,1,7,x\n")
    good, bad = landing.split_quarantine(
        landing.read_landing(spark, folder, "raw_order_payments", "2024-01-07 00:00:00"))
    rows = {r.order_id: r for r in good.collect()}
    assert set(rows) == {"o1", "o2"} and rows["o2"].payment_type == 'a, "b"'
    assert rows["o1"]._file_name.endswith("p1.csv") and rows["o1"]._loaded_at == dt.datetime(2024, 1, 7)
    assert bad.count() == 2


def stop(batch):
    raise OSError(batch)


def test_rows_of_a_failed_load_are_not_seen(spark, tmp):
    import pytest
    land, bronze, ckpt = f"{tmp}/landing", f"{tmp}/bronze", f"{tmp}/ckpt"
    root = f"{bronze}/raw_order_payments"
    write(f"{land}/payments", "p1.csv", HEAD + "o1,1,card,1,10\no2,1\n")
    file_ledger.load_incremental(spark, land, bronze, ckpt, PAYMENTS, "2024-01-01")
    with pytest.raises(file_ledger.LoadFailed):
        file_ledger.full_reload(spark, land, bronze, ckpt, PAYMENTS, "2024-01-02", after_land=stop)
    assert landing.landed(spark, root, complete_only=False).count() == 4
    assert loaded(spark, bronze) == [("o1", "2024-01-01 00:00:00")] and landing.quarantine(spark, root).count() == 1
    write(f"{land}/payments", "p2.csv", HEAD + "o3,1,card,1,7\n")
    file_ledger.load_incremental(spark, land, bronze, ckpt, PAYMENTS, "2024-01-09")
    file_ledger.full_reload(spark, land, bronze, ckpt, PAYMENTS, "2024-01-16")
    assert loaded(spark, bronze) == [  # nothing under the time of the attempt: a watermark has passed it
        ("o1", "2024-01-01 00:00:00"), ("o1", "2024-01-16 00:00:00"),
        ("o3", "2024-01-09 00:00:00"), ("o3", "2024-01-16 00:00:00")]
    assert landing.landed(spark, root, complete_only=False).count() == 6


def test_a_load_is_repeated_under_its_own_time(spark, tmp):
    import pytest
    land, bronze, ckpt = f"{tmp}/landing", f"{tmp}/bronze", f"{tmp}/ckpt"
    both = ["raw_sellers", "raw_order_payments"]
    write(f"{land}/sellers", "s1.csv", "seller_id,zip,city,state\ns1,1,a,b\n")
    write(f"{land}/payments", "p1.csv", HEAD + "o1,1,card,1,10\n")

    def second_fails(batch):
        if landing.begun_batches(spark, bronze, "raw_order_payments"):
            raise OSError(batch)

    for forced in (False, True):
        how = file_ledger.full_reload if forced else file_ledger.load_incremental
        at = "2024-01-14" if forced else "2024-01-07"

        def fails(batch, forced=forced):
            if forced and "f000000000" in landing.complete_batches(spark, bronze, "raw_sellers"):
                raise OSError(batch)
            if not forced:
                second_fails(batch)

        with pytest.raises(file_ledger.LoadFailed):
            how(spark, land, bronze, ckpt, both, at, after_land=fails)
        rep = {r.table: r.rows_loaded for r in how(spark, land, bronze, ckpt, both, at, again=True).collect()}
        assert rep == {"raw_sellers": 1, "raw_order_payments": 1}
        again = {r.table: r.rows_loaded for r in how(spark, land, bronze, ckpt, both, at, again=True).collect()}
        assert again == rep
        n = 2 if forced else 1
        assert len(loaded(spark, bronze)) == n
        assert landing.bronze_table(spark, f"{bronze}/raw_sellers").count() == n


def test_batches_bounded_by_bytes(spark, tmp):
    land, bronze, ckpt = f"{tmp}/landing", f"{tmp}/bronze", f"{tmp}/ckpt"
    for i in range(6):
        write(f"{land}/payments", f"p{i}.csv", HEAD + f"o{i},1,card,1,10\n" * 10)
    rep = file_ledger.load_incremental(spark, land, bronze, ckpt, PAYMENTS, "2024-01-07",
                                       max_bytes_per_batch=500).first()
    assert (rep.files_loaded, rep.rows_loaded) == (6, 60)
    assert len(landing.complete_batches(spark, bronze, "raw_order_payments")) > 1


def test_listing_batches_runs_no_job(spark, tmp):
    land, bronze, ckpt = f"{tmp}/landing", f"{tmp}/bronze", f"{tmp}/ckpt"
    for week in range(3):
        write(f"{land}/payments", f"p{week}.csv", HEAD + "o1,1,card,1,10\n")
        file_ledger.load_incremental(spark, land, bronze, ckpt, PAYMENTS, f"2024-01-{7 * week + 1:02d}")
    spark.sparkContext.setJobGroup("listing", "")
    log = file_ledger.LoadLog(spark, bronze, "raw_order_payments")
    assert len(log.complete()) == 3 and file_ledger.load_time([log], "2024-02-01") == dt.datetime(2024, 2, 1)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("listing")) == []


def test_landing_files_stand_in_folders_of_their_groups_alone(spark, tmp_path):
    lines = spark.createDataFrame(
        [(g, b, o, k, f"{g}-{b}-{o}-{k}") for g in (1996, 1997) for b in range(5)
         for o, k in ((0, 0), (1, 2), (1, 1))],
        "file_group int, bucket long, _ord int, _key long, value string")
    catalog.write_landing(lines, str(tmp_path / "drop"))
    folders = sorted(p.name for p in (tmp_path / "drop").iterdir() if p.is_dir())
    assert folders == ["file_group=1996", "file_group=1997"]
    files = [p.read_text().splitlines() for p in (tmp_path / "drop").glob("*/part-*")]
    assert sorted(files) == sorted([f"{g}-{b}-0-0", f"{g}-{b}-1-1", f"{g}-{b}-1-2"]
                                   for g in (1996, 1997) for b in range(5))


def test_number_of_landing_files_does_not_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(catalog, "ROWS_PER_FILE", 10)
    sf = "/root/testdata/sf0.001"
    few = catalog.landing_lines(spark, sf, "raw_orders", most_files=3)
    counted = catalog.landing_lines(spark, sf, "raw_orders", most_files=None)
    n = counted.where("_ord = 1").count()
    assert few.where("_ord = 1").count() == n
    assert few.select("bucket").distinct().count() == 3
    assert counted.select("bucket").distinct().count() > 100
