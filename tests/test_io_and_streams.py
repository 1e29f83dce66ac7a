"""Files, tables and streaming jobs."""

import os

import pytest
from pyspark.sql import functions as F

from loamwork.operators import features as FE
from loamwork.sources import readers, writers
from loamwork.streaming import samples as ST


def test_text_files_of_several_encodings(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("čaká žena".encode("utf-8"))
    (tmp_path / "b.md").write_bytes("čaká žena".encode("cp1250"))
    (tmp_path / "c.txt").write_bytes(b"  ")
    (tmp_path / "d.pdf").write_bytes(b"no")
    got = {os.path.basename(r.path): r.text for r in readers.read_text_files(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": "čaká žena", "b.md": "čaká žena"}


def test_missing_header_raises(spark):
    df = spark.createDataFrame([("x",)], "`Názov` string")
    with pytest.raises(ValueError, match="job_title, requirement_text"):
        readers.apply_header_aliases(df)


def test_dated_versions(spark, tmp_path):
    df = spark.range(3)
    first = writers.write_csv_dated(df, str(tmp_path), "2024-02-01")
    second = writers.write_csv_dated(df, str(tmp_path), "2024-02-01")
    assert first.endswith("run_date=2024-02-01/v=1") and second.endswith("v=2")


def test_index_and_byte_order_mark(spark, tmp_path):
    df = spark.createDataFrame([(30, "c"), (10, "a")], "k bigint, s string")
    writers.write_csv(df, str(tmp_path / "x"), index="i", order="k", bom=True)
    parts = [p.read_bytes() for p in (tmp_path / "x").glob("*.csv")]
    assert any(p.startswith("\ufeffi,k,s".encode()) for p in parts)
    back = readers.read_csv(spark, str(tmp_path / "x"), "i bigint, k bigint, s string")
    assert sorted(map(tuple, back.collect())) == [(0, 10, "a"), (1, 30, "c")]
    with pytest.raises(ValueError):
        writers.write_csv(df, str(tmp_path / "y"), index="i")


def test_feature_group_refuses_other_types(spark, tmp_path):
    good = spark.createDataFrame([(1, 2.0)], "id bigint, x double").withColumn("t", F.current_timestamp())
    bad = good.withColumn("x", F.lit("text"))
    with pytest.raises(ValueError):
        FE.feature_group_write(bad, str(tmp_path / "g"), good.schema, "id", "t")


def land(spark, folder, rows):
    spark.createDataFrame(rows, "host string, n bigint, v string").coalesce(1).write.mode("append").parquet(folder)


def test_restart_adds_only_new_rows(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / p) for p in ("in", "out", "ck"))
    land(spark, source, [("a", 1, "x"), ("b", 2, None)])
    schema = spark.read.parquet(source).schema

    def run():
        ST.start_flush(ST.read_samples(spark, source, schema), ST.append_flush(out), checkpoint, every=None).awaitTermination()
        return spark.read.parquet(out).count()

    assert run() == 2
    assert run() == 2
    land(spark, source, [("c", 3, "y")])
    assert run() == 3


def test_failed_flush_is_written_once_after_restart(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / p) for p in ("in", "out", "ck"))
    land(spark, source, [("a", 1, "x"), ("b", 2, "y")])
    schema = spark.read.parquet(source).schema
    write = ST.append_flush(out)

    def breaks_after_writing(batch, batch_id):
        write(batch, batch_id)
        raise RuntimeError("flush failed")

    query = ST.start_flush(ST.read_samples(spark, source, schema), breaks_after_writing, checkpoint, every=None)
    with pytest.raises(Exception, match="flush failed"):
        query.awaitTermination()
    ST.start_flush(ST.read_samples(spark, source, schema), write, checkpoint, every=None).awaitTermination()
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == [1, 2]


def test_latest_across_batches_and_compaction(spark, tmp_path):
    source, off, on, ck = (str(tmp_path / p) for p in ("in", "off", "on", "ck"))
    for rows in ([("a", 1, "old"), ("b", 5, "b5")], [("a", 4, "new"), ("b", 2, "late")]):
        land(spark, source, rows)
        schema = spark.read.parquet(source).schema
        ST.start_flush(ST.read_samples(spark, source, schema), ST.upsert_flush(off, on, "host", "n", "n"), ck, every=None).awaitTermination()
    want = [("a", 4, "new"), ("b", 5, "b5")]
    assert sorted(map(tuple, ST.online_view(spark, on, "host", "n", "n").collect())) == want
    ST.compact_online(spark, on, str(tmp_path / "on2"), "host", "n", "n")
    assert sorted(map(tuple, ST.online_view(spark, str(tmp_path / "on2"), "host", "n", "n").collect())) == want
    assert spark.read.parquet(off).count() == 4


def test_dead_hosts(spark):
    samples = spark.createDataFrame([("c1", "a", 5), ("c2", "b", None)], "cycle string, host string, m int")
    hosts = spark.createDataFrame([("a",), ("b",)], "host string")
    got = sorted(map(tuple, ST.with_dead_rows(samples, hosts, "host", "cycle", ["m"]).collect()), key=str)
    assert got == [("c1", "a", "5", None), ("c1", "b", "NO_DATA", "unreachable"), ("c2", "a", "NO_DATA", "unreachable"), ("c2", "b", "NO_DATA", None)]


def test_one_text_file_per_owner(spark, tmp_path):
    from loamwork.sources import writers

    rows = [(u, s, p, f"{u} {s} {p}") for p in range(20) for s in (2, 0, 1) for u in ("ann", "bob")]
    writers.write_texts(spark.createDataFrame(rows, "who string, section int, place int, text string").repartition(6), str(tmp_path / "r"), "who", ["section", "place"])
    files = list((tmp_path / "r" / "owner=ann").glob("part-*"))
    assert len(files) == 1 and files[0].read_text().splitlines() == [f"ann {s} {p}" for s in (0, 1, 2) for p in range(20)]


# --- silent hosts -----------------------------------------------------------------------------------


def land_samples(spark, folder, rows):
    """rows: (host, second)."""
    import datetime as dt

    start = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
    data = [(h, None if s is None else start + dt.timedelta(seconds=s), 1) for h, s in rows]
    spark.createDataFrame(data, "host string, ts timestamp, ram int").coalesce(1).write.mode("append").parquet(folder)


def test_a_host_that_stops_and_returns(spark, tmp_path):
    """Rows for the silent cycles only, each once, over three runs from one checkpoint; late and NULL rows change nothing."""
    from loamwork.streaming import silence as SL

    source, out, checkpoint = (str(tmp_path / p) for p in ("in", "out", "ck"))
    own = SL.timed_session(spark)

    def run():
        land_schema = spark.read.parquet(source).schema
        stream = SL.dead_rows(ST.read_samples(own, source, land_schema), "host", "ts", 10, ["ram", "cpu"])
        ST.start_flush(stream, ST.append_flush(out), checkpoint, every=None).awaitTermination()
        rows = spark.read.parquet(out).drop("batch_id").collect()
        assert all((r.ram, r.cpu, r.error) == ("NO_DATA", "NO_DATA", "unreachable") for r in rows)
        found = [(r.host, int((r.cycle.timestamp() - 1714521600) // 10)) for r in rows]
        assert len(found) == len(set(found))
        return sorted(found)

    land_samples(spark, source, [("a", s) for s in (1, 11, 21, 31, 41)] + [("b", 2), ("b", 13)] + [("c", 44), (None, 3), ("a", None)])
    assert run() == [("b", 2), ("b", 3)]  # b is silent from cycle 2 on; cycle 4 has not ended
    land_samples(spark, source, [("a", s) for s in (51, 61)] + [("b", 65), ("b", 24)])  # b is back in cycle 6, its sample of cycle 2 comes too late
    assert run() == [("b", 2), ("b", 3), ("b", 4), ("b", 5), ("c", 5)]
    land_samples(spark, source, [("a", 95), ("b", 71)])
    assert run() == [("a", 7), ("a", 8), ("b", 2), ("b", 3), ("b", 4), ("b", 5), ("b", 8), ("c", 5), ("c", 6), ("c", 7), ("c", 8)]
    assert run()[-1] == ("c", 8)


def test_timers_need_their_state_store(spark, tmp_path):
    from loamwork.streaming import silence as SL

    land_samples(spark, str(tmp_path / "in"), [("a", 1)])
    stream = ST.read_samples(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    with pytest.raises(ValueError, match="stateStore"):
        SL.dead_rows(stream, "host", "ts", 10, [])


def test_indicator_file_in_its_published_form(spark, tmp_path):
    """Header and cells as they come: joined dimensions, periods of any kind, flags, colons, blanks, odd cells."""
    from loamwork.sources import readers

    lines = [
        "freq,unit,geo\\TIME_PERIOD\t2007 \t2008-Q1 \t2009-M02", "A,CP_MEUR,SK\t12.3 bp\t: \t-4", "A,CP_MEUR,CZ\t: c\t5e3\t 7.25 e ", "A,PC, EA\t.5p\t\tn/a", "Q,X,U2\t:z\t1 234\t0",
    ]
    (tmp_path / "x.tsv").write_text("\n".join(lines) + "\n")
    wide = readers.read_indicator_file(spark, str(tmp_path))
    assert wide.columns == ["freq", "unit", "geo\\TIME_PERIOD", "2007", "2007_flag", "2008-Q1", "2008-Q1_flag", "2009-M02", "2009-M02_flag"]
    assert [tuple(r) for r in wide.collect()] == [
        ("A", "CP_MEUR", "SK", 12.3, "bp", None, None, -4.0, None), ("A", "CP_MEUR", "CZ", None, "c", 5000.0, None, 7.25, "e"),
        ("A", "PC", "EA", 0.5, "p", None, None, None, "n/a"), ("Q", "X", "U2", None, "z", None, "1 234", 0.0, None),
    ]
    long = readers.indicator_long(wide)
    assert long.columns == ["freq", "unit", "geo\\TIME_PERIOD", "period", "value", "flag"] and long.count() == 10
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.tsv").write_text(lines[0] + "\n")
    assert readers.indicator_long(readers.read_indicator_file(spark, str(tmp_path / "none"))).count() == 0


def test_next_version_and_a_model_that_cannot_be_read(spark, tmp_path):
    from loamwork.operators import models as ML
    from loamwork.sources import writers

    df, folder = spark.range(3).toDF("a"), str(tmp_path / "dated")
    assert [writers.write_csv_dated(df, folder, "2024-05-01")[-3:] for _ in range(3)] == ["v=1", "v=2", "v=3"]
    assert writers.next_version(df, folder, "2024-05-02") == 1
    (tmp_path / "broken" / "metadata").mkdir(parents=True)
    (tmp_path / "broken" / "metadata" / "part-0").write_text("no model")
    with pytest.raises(Exception):  # noqa: B017
        ML.load_or_train(spark, str(tmp_path / "broken"), lambda: pytest.fail("trained over a broken model"))


def test_repeated_evidences_and_limits(spark):
    from loamwork.functions import jsons
    from loamwork.operators import reports

    many = [f" Text  {i % 7000} " if i % 2 else f"TEXT {i % 7000}" for i in range(20_000)]
    df = spark.createDataFrame([(1, many), (2, None), (3, ["b", " ", "a", "B", "A "])], "d int, x array<string>")
    got = {r.d: r.y for r in df.select("d", jsons.dedupe_texts(F.col("x")).alias("y")).collect()}
    want = {}
    for t in many:
        want.setdefault(" ".join(t.split()).lower(), " ".join(t.split()))
    assert got[1] == list(want.values()) and got[2] == [] and got[3] == ["b", "a"]
    assert df.select(jsons.dedupe_texts(F.col("x"), 1).alias("y")).collect()[2].y == ["b"]
    record = jsons.validate_evaluation(F.lit("{}"), F.array(F.lit("x"), F.lit("y"), F.lit("z")), found=2)
    assert spark.range(1).select(record.alias("r")).first().r.evidence_used == ["x", "y"]
    evals = spark.createDataFrame([("c", 1, "job", "R1", "req", "splnene", 90.0, 1.0, "must", "why", None, ["one " * 300, "two", "three", "four"])], "c string, o int, job_title string, requirement_id string, requirement string, status string, score double, weight double, priority string, explanation string, risk_note string, evidence_used array<string>")
    note = [r.text for r in reports.report_blocks(evals, "c", "o").collect() if r.section == 2][0]
    assert note.count("\n- ") == 4 and "one " * 299 in note
    short = [r.text for r in reports.report_blocks(evals, "c", "o", evidences=2, characters=10).collect() if r.section == 2][0]
    assert short.endswith("\n- one one on\n- two")


def test_documents_in_few_text_files_come_back_whole(spark, tmp_path, monkeypatch):
    """Blank texts and breaks at the end stay, and files are as many as the bytes need, not one per document."""
    from loamwork.plans import tabular

    texts = {1: "a\nb\n", 2: "", 3: "  ", 4: 'x "y" \\ \r\n\tč', 5: None, **{i: f"row {i} " for i in range(6, 400)}}
    spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(tabular, "scratch_folder", lambda *_: str(tmp_path / "texts"))
    monkeypatch.setattr(tabular, "TEXT_FILE_BYTES", 1000)
    got = {r.doc_id: r.text for r in tabular.scan_text_files(spark, str(tmp_path)).collect()}
    assert got == {k: v for k, v in texts.items() if v is not None}
    assert 2 <= len(list((tmp_path / "texts").rglob("*.txt"))) <= 5


def test_silent_cycles_need_one_look_at_the_state():
    """However many cycles a host has, a call reads its state once and writes it once."""
    from loamwork.streaming.silence import Silence

    class Value:
        held, looks = None, 0

        def get(self):
            self.looks += 1
            return self.held

        def update(self, value):
            self.looks, self.held = self.looks + 1, value

    class Handle:
        value, timers = Value(), []

        def getValueState(self, *_):
            return self.value

        def registerTimer(self, at):
            self.timers.append(at)

    class Now:
        def getCurrentWatermarkInMs(self):
            return 59_999

    handle, host = Handle(), Silence(1000, ["m"], "gone")
    host.init(handle)
    assert list(host.handleInputRows(("h",), iter([{"_cycle": c} for c in (2, 5, 5, 40, 59, 70)]), None)) == []
    silent = [r.cycle for r in host.handleExpiredTimer(("h",), Now(), None)]
    assert silent == [c for c in range(2, 59) if c not in (2, 5, 40)] and handle.value.held == (58, [59, 70])
    assert handle.value.looks == 4 and handle.timers == [3000, 60_000]
    list(host.handleInputRows(("h",), iter([{"_cycle": 3}, {"_cycle": 59}]), None))  # late, and known
    assert handle.value.held == (58, [59, 70]) and handle.value.looks == 5
