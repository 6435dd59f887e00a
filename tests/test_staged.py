"""Staged-file loader semantics on handwritten files."""
import json
import os

import pytest
from pyspark.sql import functions as F

from hostlake.operators import sinks as SK


def put(folder, name, payload, raw=None):
    path = os.path.join(folder.replace("file:", ""), name)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(raw if raw is not None else json.dumps(payload, indent=2))
    return path


def rows(spark, lake, table, *cols):
    return sorted(tuple(r) for r in SK.read_table(spark, lake, table).select(*cols).collect())


HIST_META = {"table": "h", "method": "copy", "conflict_target": ["itemid", "clock", "ns"],
             "column_types": {"itemid": "BIGINT", "clock": "BIGINT", "ns": "INTEGER"}, "add_updated_at": False}


def test_copy_with_key_first_wins_and_replay(spark, scratch):
    p, lake = scratch("pending"), scratch("lake")
    put(p, "a.json", {"meta": HIST_META, "data": [
        {"itemid": "1", "clock": "10", "ns": "0", "value": "first"},
        {"itemid": "1", "clock": "10", "ns": "0", "value": "dup in file"},
        {"itemid": "2", "clock": "10", "ns": "0", "value": "x"}]})
    put(p, "b.json", {"meta": HIST_META, "data": [
        {"itemid": "1", "clock": "10", "ns": "0", "value": "dup across files"},
        {"itemid": "3", "clock": "11", "ns": "5", "value": "tab\there \"q\" back\\slash\nnl"}]})
    put(p, ".hidden.json", {"meta": HIST_META, "data": [{"itemid": "9", "clock": "1", "ns": "0", "value": "no"}]})
    put(p, "c.json.tmp", {"meta": HIST_META, "data": [{"itemid": "9", "clock": "1", "ns": "0", "value": "no"}]})
    led = SK.load_pending(spark, p, lake)
    assert sorted(r.status for r in led.collect()) == ["ok", "ok"]
    assert rows(spark, lake, "h", "itemid", "value") == [
        (1, "first"), (2, "x"), (3, "tab\there \"q\" back\\slash\nnl")]
    # same files again: ledger skips them, table unchanged
    assert SK.load_pending(spark, p, lake).count() == 0
    assert SK.read_table(spark, lake, "h").count() == 3
    assert dict(SK.read_table(spark, lake, "h").dtypes)["itemid"] == "bigint"


def test_upsert_last_wins_and_updates(spark, scratch):
    p1, p2, lake = scratch("p"), scratch("p"), scratch("lake")
    meta = {"table": "inv", "method": "UPSERT", "conflict_target": ["hostid"], "json_columns": ["groups"]}
    put(p1, "1.json", {"meta": meta, "data": [{"hostid": "1", "name": "a", "groups": ["g1"]},
                                              {"hostid": "1", "name": "a2", "groups": ["g2"]},
                                              {"hostid": "2", "name": "b", "groups": []}]})
    SK.load_pending(spark, p1, lake)
    assert rows(spark, lake, "inv", "hostid", "name", "groups") == [("1", "a2", '["g2"]'), ("2", "b", "[]")]
    put(p2, "2.json", {"meta": meta, "data": [{"hostid": "2", "name": "b2", "groups": "solo"},
                                              {"hostid": "3", "name": "c", "groups": None}]})
    SK.load_pending(spark, p2, lake)
    assert rows(spark, lake, "inv", "hostid", "name") == [("1", "a2"), ("2", "b2"), ("3", "c")]
    # JSON columns keep JSON text: a string keeps its quotes, JSON null is SQL NULL
    assert dict((r[0], r[1]) for r in rows(spark, lake, "inv", "hostid", "groups"))["2"] == '"solo"'
    assert dict((r[0], r[1]) for r in rows(spark, lake, "inv", "hostid", "groups"))["3"] is None
    assert SK.read_table(spark, lake, "inv").where(F.col("updated_at").isNull()).count() == 0


def test_insert_conflict_fails_whole_document(spark, scratch):
    p1, p2, lake = scratch("p"), scratch("p"), scratch("lake")
    meta = {"table": "it", "method": "insert", "conflict_target": ["itemid"], "add_updated_at": False}
    put(p1, "1.json", {"meta": meta, "data": [{"itemid": "1", "v": "a"}, {"itemid": "2", "v": "b"}]})
    SK.load_pending(spark, p1, lake)
    put(p2, "2.json", {"meta": meta, "data": [{"itemid": "3", "v": "c"}, {"itemid": "1", "v": "conflict"}]})
    put(p2, "3.json", {"meta": meta, "data": [{"itemid": "4", "v": "d"}]})
    led = {os.path.basename(r.file_path): (r.status, r.error) for r in SK.load_pending(spark, p2, lake).collect()}
    assert led["2.json"][0] == "error" and "duplicate key" in led["2.json"][1]
    assert led["3.json"] == ("ok", None)
    assert rows(spark, lake, "it", "itemid", "v") == [("1", "a"), ("2", "b"), ("4", "d")]


def test_validation_errors_and_skips(spark, scratch):
    p, lake = scratch("p"), scratch("lake")
    put(p, "a.json", {"meta": {"method": "copy"}, "data": [{"x": "1"}]})
    put(p, "b.json", {"meta": {"table": "t", "method": "merge"}, "data": [{"x": "1"}]})
    put(p, "c.json", {"meta": {"table": "t", "method": "upsert"}, "data": [{"x": "1"}]})
    put(p, "d.json", {"meta": {"table": "t", "method": "copy"}, "data": {"x": "1"}})
    put(p, "e.json", {"meta": {"table": "t", "method": "copy"}, "data": []})
    put(p, "f.json", None, raw='{"meta": {"table": "t", "method": "copy"}, "data": [{"x": ')
    put(p, "g.json", {"meta": {"table": "t"}, "data": [{"x": "1"}]})  # default upsert needs a key
    led = {os.path.basename(r.file_path): (r.status, r.error) for r in SK.load_pending(spark, p, lake).collect()}
    assert led["a.json"] == ("error", "meta.table missing")
    assert led["b.json"] == ("error", "invalid method: merge")
    assert led["c.json"] == ("error", "upsert requires meta.conflict_target")
    assert led["d.json"] == ("error", "data must be a list")
    assert led["e.json"] == ("skipped", None)
    assert led["f.json"] == ("error", "invalid JSON document")
    assert led["g.json"] == ("error", "upsert requires meta.conflict_target")
    # errors are retried next run (not in the ledger as done); skipped ones are not
    again = {os.path.basename(r.file_path) for r in SK.load_pending(spark, p, lake).collect()}
    assert again == {"a.json", "b.json", "c.json", "d.json", "f.json", "g.json"}


def test_schema_from_first_record_and_deferral(spark, scratch):
    p, lake = scratch("p"), scratch("lake")
    meta = {"table": "s", "method": "copy", "add_updated_at": False}
    put(p, "1.json", {"meta": meta, "data": [{"a": "1"}, {"a": "2", "b": "dropped"}]})
    put(p, "2.json", {"meta": meta, "data": [{"a": "3"}]})
    led = SK.load_pending(spark, p, lake, max_files=1)
    assert [os.path.basename(r.file_path) for r in led.collect()] == ["1.json"]
    assert SK.load_summary(led).first().deferred == 1
    assert SK.read_table(spark, lake, "s").columns == ["a"]
    SK.load_pending(spark, p, lake, max_files=1)
    assert rows(spark, lake, "s", "a") == [("1",), ("2",), ("3",)]


def test_write_staged_roundtrip_and_summary(spark, scratch):
    p, lake = scratch("p"), scratch("lake")
    df = spark.range(2500).select(F.col("id").cast("string").alias("itemid"), (F.col("id") % 3).alias("g"),
                                  F.lit("v").alias("value"))
    SK.write_staged(df, p, "w", "copy", key=["itemid"], add_updated_at=False, group_cols=["g"], max_records=400)
    led = SK.load_pending(spark, p, lake)
    s = SK.load_summary(led).first()
    assert (s.errors, s.skipped, s.rows) == (0, 0, 2500) and s.processed >= 3
    # every group of ~833 rows is split into ceil(833 / 400) = 3 hash chunks
    assert s.processed == 9 and led.agg(F.max("rows")).first()[0] < 2 * 400
    assert SK.read_table(spark, lake, "w").count() == 2500


def test_done_dir_moves_finished_files_only(spark, scratch):
    p, lake, done = scratch("p"), scratch("lake"), scratch("done")
    put(p, "ok.json", {"meta": {"table": "m", "method": "copy", "add_updated_at": False}, "data": [{"a": "1"}]})
    put(p, "bad.json", {"meta": {"method": "copy"}, "data": [{"a": "1"}]})
    SK.load_pending(spark, p, lake, done_dir=done)
    assert sorted(os.listdir(p.replace("file:", ""))) == ["bad.json"]
    assert sorted(os.listdir(done.replace("file:", ""))) == ["ok.json"]


def test_duplicate_keys_in_records(spark, scratch):
    p, lake = scratch("p"), scratch("lake")
    put(p, "d.json", None, raw='{"meta": {"table": "d", "method": "copy", "add_updated_at": false}, '
                               '"data": [{"a": "1", "b": "x", "a": "2"}]}')
    SK.load_pending(spark, p, lake)
    t = SK.read_table(spark, lake, "d")
    assert t.columns == ["a", "b"] and [tuple(r) for r in t.collect()] == [("2", "x")]


def test_clean_copy_text_option(spark, scratch):
    p, lake = scratch("p"), scratch("lake")
    put(p, "t.json", {"meta": {"table": "t", "method": "copy", "add_updated_at": False},
                      "data": [{"a": "x\ty\nz"}]})
    SK.load_pending(spark, p, lake, clean_copy_text=True)
    assert SK.read_table(spark, lake, "t").first().a == "x y z"


def test_time_budget_defers_remaining_files(spark, scratch):
    p, lake = scratch("p"), scratch("lake")
    meta = {"table": "b", "method": "copy", "add_updated_at": False}
    for i in range(5):
        put(p, f"{i}.json", {"meta": meta, "data": [{"a": str(i)}]})
    led = SK.load_pending_budgeted(spark, p, lake, time_budget_s=0, files_per_batch=2)
    s = SK.load_summary(led).first()
    assert (s.processed, s.deferred) == (2, 3)  # budget spent after the first batch
    led = SK.load_pending_budgeted(spark, p, lake, time_budget_s=3600, files_per_batch=2)
    assert SK.load_summary(led).first().processed == 3
    assert rows(spark, lake, "b", "a") == [(str(i),) for i in range(5)]


def ledger(led):
    return {(os.path.basename(r.file_path), r.doc_pos): (r.status, r.error, r.rows, r.inserted) for r in led.collect()}


def put_lines(folder, name, docs):
    return put(folder, name, None, raw="\n".join(json.dumps(d) for d in docs))


UP = {"table": "u", "method": "upsert", "conflict_target": ["k"], "add_updated_at": False}


def test_documents_with_other_columns_are_all_applied(spark, scratch):
    p, lake = scratch("p"), scratch("lake")
    put(p, "1.json", {"meta": UP, "data": [{"k": "1", "a": "a1", "b": "b1"}, {"k": "2", "a": "a2", "b": "b2"}]})
    put(p, "2.json", {"meta": UP, "data": [{"k": "1", "a": "a1x"}]})
    put(p, "3.json", {"meta": UP, "data": [{"b": "b3", "k": "3"}, {"k": "2", "a": "dropped"}]})
    led = ledger(SK.load_pending(spark, p, lake))
    assert {v[:2] for v in led.values()} == {("ok", None)}
    # each document writes its own columns; a key missing in a later record is NULL
    assert sorted(map(tuple, SK.read_table(spark, lake, "u").select("k", "a", "b").collect())) == [
        ("1", "a1x", "b1"), ("2", "a2", None), ("3", None, "b3")]


def test_groups_with_other_json_columns_are_loaded_once(spark, scratch):
    p, lake = scratch("p"), scratch("lake")
    plain = {"table": "t", "method": "copy", "add_updated_at": False}
    put(p, "1.json", {"meta": plain, "data": [{"a": "x"}]})
    put(p, "2.json", {"meta": {**plain, "json_columns": ["a"]}, "data": [{"a": "x"}]})
    put(p, "3.json", {"meta": {**plain, "add_updated_at": True}, "data": [{"a": "y"}]})
    SK.load_pending(spark, p, lake)
    assert rows(spark, lake, "t", "a") == [('"x"',), ("x",), ("y",)]


def test_one_bad_document_does_not_stop_or_double_others(spark, scratch):
    p, lake = scratch("p"), scratch("lake")
    put(p, "a.json", {"meta": {"table": "app", "method": "copy", "add_updated_at": False}, "data": [{"v": "1"}]})
    put(p, "b.json", {"meta": {**UP, "conflict_target": ["nope"]}, "data": [{"k": "1"}]})
    put(p, "c.json", {"meta": {"table": "app", "method": "copy"}, "data": [{"other": "1"}]})
    put(p, "d.json", {"meta": {"table": "app", "method": "copy"}, "data": ["text"]})
    led = ledger(SK.load_pending(spark, p, lake))
    assert led[("a.json", 0)] == ("ok", None, 1, 1)
    assert led[("b.json", 0)][:2] == ("error", "conflict_target column not in data: nope")
    assert led[("c.json", 0)][:2] == ("error", "column other does not exist")
    assert led[("d.json", 0)][:2] == ("error", "records must be objects")
    again = ledger(SK.load_pending(spark, p, lake))
    assert sorted(k[0] for k in again) == ["b.json", "c.json", "d.json"]
    assert rows(spark, lake, "app", "v") == [("1",)]


def test_bad_values_and_null_keys_are_errors(spark, scratch):
    p, lake = scratch("p"), scratch("lake")
    meta = {**HIST_META, "column_types": {**HIST_META["column_types"], "at": "TIMESTAMPTZ"}}
    row = {"itemid": "1", "clock": "10", "ns": "0", "at": "2024-01-01T00:00:00Z", "value": "x"}
    put(p, "a.json", {"meta": meta, "data": [row, {**row, "clock": "12x"}]})
    put(p, "b.json", {"meta": meta, "data": [{**row, "clock": "11"}, {**row, "clock": "13", "at": None}]})
    put(p, "c.json", {"meta": meta, "data": [{**row, "at": "soon"}]})
    put(p, "d.json", {"meta": meta, "data": [row, {**row, "ns": None}]})
    led = ledger(SK.load_pending(spark, p, lake))
    assert led[("a.json", 0)][:2] == ("error", "invalid value for column clock (bigint)")
    assert led[("b.json", 0)] == ("ok", None, 2, 2)
    assert led[("c.json", 0)][:2] == ("error", "invalid value for column at (timestamp)")
    assert led[("d.json", 0)][:2] == ("error", "null value in key column ns")
    assert rows(spark, lake, "h", "clock") == [(11,), (13,)]


def test_failed_documents_of_a_mixed_file_are_tried_again(spark, scratch):
    p, lake, done = scratch("p"), scratch("lake"), scratch("done")
    good, bad = {"meta": UP, "data": [{"k": "1", "a": "x"}]}, {"meta": {"method": "copy"}, "data": [{"a": "1"}]}
    put_lines(p, "m.json", [good, bad])
    assert sorted(v[0] for v in ledger(SK.load_pending(spark, p, lake, done_dir=done)).values()) == ["error", "ok"]
    assert os.listdir(p.replace("file:", "")) == ["m.json"]
    again = ledger(SK.load_pending(spark, p, lake, done_dir=done))
    assert list(again) == [("m.json", 1)]
    put_lines(p, "m.json", [good, {"meta": UP, "data": [{"k": "2", "a": "mended"}]}])
    assert ledger(SK.load_pending(spark, p, lake, done_dir=done))[("m.json", 1)][0] == "ok"
    assert rows(spark, lake, "u", "k", "a") == [("1", "x"), ("2", "mended")]
    assert os.listdir(p.replace("file:", "")) == [] and os.listdir(done.replace("file:", "")) == ["m.json"]


def test_crashed_run_is_repeated_under_its_id(spark, scratch, monkeypatch):
    p, lake = scratch("p"), scratch("lake")
    put(p, "a.json", {"meta": {"table": "app", "method": "copy", "add_updated_at": False}, "data": [{"v": "1"}]})
    put(p, "b.json", {"meta": UP, "data": [{"k": "1", "a": "x"}]})
    put(p, "c.json", {"meta": HIST_META, "data": [{"itemid": "1", "clock": "10", "ns": "0", "value": "x"}]})

    def crash(*a, **k):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(SK, "write_if_absent", crash)  # the third document's write, after the others
        with pytest.raises(KeyboardInterrupt):
            SK.load_pending(spark, p, lake)
    assert rows(spark, lake, "app", "v") == [("1",)] and SK.read_ledger(spark, lake).count() == 0
    put(p, "d.json", {"meta": UP, "data": [{"k": "1", "a": "later"}]})
    led = SK.load_pending(spark, p, lake)
    assert led.select("batch_id").distinct().count() == 2
    assert rows(spark, lake, "app", "v") == [("1",)] and rows(spark, lake, "h", "itemid") == [(1,)]
    assert rows(spark, lake, "u", "k", "a") == [("1", "later")]
    assert SK.load_pending(spark, p, lake).count() == 0
    assert SK._started(spark, lake) == []


def test_missing_folder_and_lost_data(spark, scratch):
    lake = scratch("lake")
    assert SK.load_pending(spark, lake + "/none", lake).count() == 0
    assert SK.load_pending_budgeted(spark, lake + "/none", lake, 1).count() == 0
    df = spark.createDataFrame([("f", 0, 0, "1", "x")], "_file string, _doc int, _pos int, k string, a string")
    SK.ensure_table(spark, lake, "u", ["k", "a"], {}, key=["k"], add_updated_at=False)
    for i in range(6):
        SK.write_upsert(spark, df.withColumn("a", F.lit(str(i))), lake, "u", ["k"], batch_id=str(i))
        SK.write_upsert(spark, df.withColumn("a", F.lit("again")), lake, "u", ["k"], batch_id=str(i))
    assert rows(spark, lake, "u", "k", "a") == [("1", "5")]
    assert os.listdir(f"{lake}/u/_merge".replace("file:", "")) == []


def test_ordered_documents_keep_the_last_row(spark, scratch):
    p, lake = scratch("p"), scratch("lake")
    df = spark.range(3000).select((F.col("id") % 7).cast("string").alias("k"), F.col("id").cast("string").alias("a"), "id")
    SK.write_staged(df.repartition(9), p, "u", "upsert", key=["k"], add_updated_at=False, order_cols=["id"], max_records=100)
    SK.load_pending(spark, p, lake)
    want = sorted((str(k), str(max(i for i in range(3000) if i % 7 == k))) for k in range(7))
    assert rows(spark, lake, "u", "k", "a") == want
    q, lake2 = scratch("p"), scratch("lake")
    SK.write_staged(df.withColumn("g", F.col("id") % 2).repartition(9), q, "u", "upsert", key=["k", "id"],
                    add_updated_at=False, group_cols=["g"], order_cols=["id"], max_records=400)
    led = SK.load_pending(spark, q, lake2)
    assert led.count() == 8 and SK.read_table(spark, lake2, "u").count() == 3000


def test_copies_that_are_there_are_counted(spark, scratch):
    p, lake = scratch("p"), scratch("lake")
    row = {"itemid": "1", "clock": "10", "ns": "0", "value": "x"}
    put(p, "1.json", {"meta": HIST_META, "data": [row, row, {**row, "ns": "1"}]})
    assert ledger(SK.load_pending(spark, p, lake))[("1.json", 0)] == ("ok", None, 3, 2)
    put(p, "2.json", {"meta": HIST_META, "data": [row]})
    assert ledger(SK.load_pending(spark, p, lake))[("2.json", 0)] == ("ok", None, 1, 0)


def frame(spark, rows):
    return spark.createDataFrame([("f", 0, i, k, a) for i, (k, a) in enumerate(rows)], "_file string, _doc int, _pos int, k string, a string")


def test_an_upsert_rewrites_touched_buckets_only(spark, scratch, monkeypatch):
    lake = scratch("lake")
    home = f"{lake}/u".replace("file:", "")
    SK.ensure_table(spark, lake, "u", ["k", "a"], {}, key=["k"], add_updated_at=False, buckets=8)
    SK.write_upsert(spark, frame(spark, [(str(i), "old") for i in range(200)]), lake, "u", ["k"], "first")

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{home}/rows") for f in fs if f.endswith(".parquet")}
    before = files()
    assert len({os.path.dirname(f) for f in before}) == 8
    SK.write_upsert(spark, frame(spark, [("7", "new")]), lake, "u", ["k"], "second")
    after = files()
    assert len({os.path.dirname(f) for f, _ in set(before.items()) ^ set(after.items())}) == 1
    want = sorted((str(i), "new" if i == 7 else "old") for i in range(200))
    assert rows(spark, lake, "u", "k", "a") == want
    # a repeated batch is read (a stateful stream needs it) and changes nothing
    seen = spark.sparkContext.accumulator(0)
    again = frame(spark, [("7", "again")])
    watched = spark.createDataFrame(again.rdd.map(lambda r: (seen.add(1), r)[1]), again.schema)
    assert SK.write_upsert(spark, watched, lake, "u", ["k"], "second") is False
    assert seen.value == 1 and files() == after
    # a run that stopped while it replaced buckets is completed from what it had merged
    real = SK.FS.write_text

    def crash(spark, path, text):
        if "/_applied/" in path:
            raise KeyboardInterrupt
        return real(spark, path, text)
    with monkeypatch.context() as m:
        m.setattr(SK.FS, "write_text", crash)
        with pytest.raises(KeyboardInterrupt):
            SK.write_upsert(spark, frame(spark, [("8", "third"), ("900", "third")]), lake, "u", ["k"], "third")
    import shutil
    gone = next(d for d in os.listdir(f"{home}/rows") if d in os.listdir(f"{home}/_merge/third"))
    shutil.move(f"{home}/rows/{gone}", scratch("away").replace("file:", ""))
    SK.write_upsert(spark, frame(spark, [("8", "third"), ("900", "third")]), lake, "u", ["k"], "third")
    assert dict(rows(spark, lake, "u", "k", "a")) == {**dict(want), "8": "third", "900": "third"}


def test_rows_that_were_appended_are_upserted(spark, scratch):
    lake = scratch("lake")
    SK.ensure_table(spark, lake, "u", ["k", "a"], {}, key=["k"], add_updated_at=False)
    SK.write_append(spark, frame(spark, [("1", "a"), ("2", "b")]), lake, "u", "x")
    SK.write_upsert(spark, frame(spark, [("2", "B"), ("3", "c")]), lake, "u", ["k"], "y")
    assert rows(spark, lake, "u", "k", "a") == [("1", "a"), ("2", "B"), ("3", "c")]
    SK.write_append(spark, frame(spark, [("4", "d")]), lake, "u", "z")
    assert rows(spark, lake, "u", "k", "a") == [("1", "a"), ("2", "B"), ("3", "c"), ("4", "d")]
    SK.write_upsert(spark, frame(spark, [("4", "D")]), lake, "u", ["k"], "w")
    assert rows(spark, lake, "u", "k", "a") == [("1", "a"), ("2", "B"), ("3", "c"), ("4", "D")]


def test_a_late_failure_leaves_no_rows_and_doubles_none(spark, scratch, monkeypatch):
    from hostlake.operators import latest as LV
    p, lake = scratch("p"), scratch("lake")
    plain = {k: v for k, v in HIST_META.items() if k != "conflict_target"}
    row = {"itemid": "1", "clock": "10", "ns": "0", "value": "x", "hostid": "1", "value_type": "0"}
    put(p, "a.json", {"meta": plain, "data": [row]})
    with monkeypatch.context() as m:
        def down(*a, **k):
            raise RuntimeError("latest is down")
        m.setattr(LV, "update_latest", down)
        for _ in range(2):
            led = ledger(SK.load_pending(spark, p, lake, latest_tables=["h"]))
            assert led[("a.json", 0)][0] == "error" and "latest is down" in led[("a.json", 0)][1]
            assert SK.read_table(spark, lake, "h").count() == 0
    assert ledger(SK.load_pending(spark, p, lake, latest_tables=["h"]))[("a.json", 0)] == ("ok", None, 1, 1)
    assert SK.read_table(spark, lake, "h").count() == 1 and LV.latest_rows(spark, lake).count() == 1


def test_failing_files_keep_no_others_waiting(spark, scratch):
    p, lake = scratch("p"), scratch("lake")
    for n in "ab":
        put(p, f"{n}.json", {"meta": {"method": "copy"}, "data": [{"a": "1"}]})
    for n in "cde":
        put(p, f"{n}.json", {"meta": {"table": "t", "method": "copy", "add_updated_at": False}, "data": [{"a": n}]})
    led = SK.load_pending_budgeted(spark, p, lake, 3600, files_per_batch=2)
    assert SK.load_summary(led).first()[:3] == (3, 2, 0) and rows(spark, lake, "t", "a") == [("c",), ("d",), ("e",)]
    # with a run's time spent after one batch, files that failed come last
    put(p, "z.json", {"meta": {"table": "t", "method": "copy", "add_updated_at": False}, "data": [{"a": "z"}]})
    led = SK.load_pending_budgeted(spark, p, lake, 0, files_per_batch=1)
    assert [os.path.basename(r.file_path) for r in led.collect()] == ["z.json"]
    rates = SK.load_rates(SK.read_ledger(spark, lake)).collect()
    assert {(r.table, r.documents, r.rows) for r in rates} == {("t", 4, 4), (None, 4, 4)} and all(r.rows_per_s > 0 for r in rates)


def test_a_large_file_is_read_by_many_tasks(spark, scratch):
    from hostlake.sources import staged as S
    p = scratch("p")
    docs = [{"meta": {"table": "t"}, "data": [{"n": i, "pad": "x" * (i % 50)}]} for i in range(4000)]
    lines = [json.dumps(d) for d in docs]
    lines[7:7] = ["", "  "]
    put(p, "big.json", None, raw="\n".join(lines) + "\n")
    put(p, "one.json", {"meta": {"table": "t"}, "data": []})
    put(p, "line.json", None, raw=json.dumps(docs[5]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        tasks = S.read_lines(spark, [f"{p}/big.json"]).rdd.getNumPartitions()
        found = S.read_staged(spark, p).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tasks > 10
    big = sorted((r.doc_pos, json.loads(r.doc)["data"][0]["n"]) for r in found if r.file_path.endswith("big.json"))
    assert big == [(i, i) for i in range(4000)]
    assert sorted((os.path.basename(r.file_path), r.doc_pos) for r in found if not r.file_path.endswith("big.json")) == [("line.json", 0), ("one.json", 0)]
    assert sorted((r.doc_pos, r.doc) for r in S.read_staged(spark, p, [f"{p}/big.json"]).collect()) == sorted(
        (r.doc_pos, r.doc) for r in found if r.file_path.endswith("big.json"))


def test_stored_keys_are_read_within_the_bounds_of_the_batch(spark, scratch):
    lake = scratch("lake")
    cols = "itemid bigint, clock bigint, value string"
    SK.ensure_table(spark, lake, "h", ["itemid", "clock", "value"], {"itemid": "bigint", "clock": "bigint"}, key=["itemid", "clock"], add_updated_at=False)
    stored = spark.range(1000).selectExpr("id AS itemid", "id AS clock", "'s' AS value", "'f' AS _file", "0 AS _doc", "int(id) AS _pos")
    SK.write_if_absent(spark, stored, lake, "h", ["itemid", "clock"], "one")
    batch = spark.createDataFrame([(5, 5, "n"), (2000, 2000, "n")], cols).selectExpr("*", "'f' AS _file", "1 AS _doc", "0 AS _pos")
    near = SK._near_keys(SK.read_table(spark, lake, "h"), batch, ["itemid", "clock"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = near._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(itemid,5)" in pushed and "LessThanOrEqual(clock,2000)" in pushed
    assert "In(itemid, [2000,5])" in pushed or "In(itemid, [5,2000])" in pushed
    done = SK.write_if_absent(spark, batch, lake, "h", ["itemid", "clock"], "two")
    assert [r.inserted for r in done.collect()] == [1]
    failed = SK.write_insert(spark, batch.withColumn("_doc", F.lit(2)), lake, "h", ["itemid", "clock"], "three")
    assert failed.count() == 1 and SK.read_table(spark, lake, "h").count() == 1001
    assert SK._near_keys(SK.read_table(spark, lake, "h"), batch.limit(0), ["itemid"]).count() == 0


def test_a_refused_move_keeps_all_rows(spark, scratch, monkeypatch):
    from hostlake.operators import maintenance as MT
    path = scratch("hist")
    h = spark.range(400).selectExpr("id AS itemid", "id * 1000 AS clock").repartition(6)
    MT.with_event_date(h).write.mode("overwrite").partitionBy("event_date").parquet(path)
    real = MT.FS.rename

    def refuse(spark, src, dst):
        if "-compaction/new/" in src:
            raise OSError("refused")
        return real(spark, src, dst)
    with monkeypatch.context() as m:
        m.setattr(MT.FS, "rename", refuse)
        with pytest.raises(OSError):
            MT.compact(spark, path, as_of=10_000_000, older_than_days=1)
    assert spark.read.parquet(path).count() == 400
    assert MT.compact(spark, path, as_of=10_000_000, older_than_days=1) > 0 and spark.read.parquet(path).count() == 400


def test_documents_and_records_are_parsed_once(spark):
    """One use of a parsed document or record must not be one more parse of its text."""
    from hostlake.sources import staged as S

    def parses(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("from_json")
    docs = spark.createDataFrame([("f", 0, json.dumps({"meta": {"table": "t", "method": "copy"}, "data": [{"a": "1", "b": 2, "a2": None}]}))],
                                 "file_path string, doc_pos int, doc string")
    parsed = S.parse_envelope(docs)
    assert parses(parsed) <= 2  # the document, and its list
    records = S.records_frame(parsed, {"a": "int", "b": "bigint", "a2": "string"}, key=["a"])
    assert parses(records) <= 4
    assert records.select("a", "b", "a2", "_bad").collect() == [(1, 2, None, None)]


def test_documents_of_one_group_are_dealt_over_files(spark, scratch):
    """A group's documents lie in several files, of a given number, and no row is lost."""
    import glob
    from hostlake.sources import staged as SG
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.lit("w").alias("window_id"))
    folder = scratch()
    SK.write_staged(rows, folder, "t", "copy", group_cols=["window_id"], max_records=500, add_updated_at=False, files=4)
    found = glob.glob(f"{folder.removeprefix('file:')}/*.json")
    assert 1 < len(found) <= 4
    docs = SG.parse_envelope(SG.read_staged(spark, folder))
    assert docs.agg(F.sum(F.size("records"))).first()[0] == 20_000
