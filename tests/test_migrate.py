"""Sources and operators of the migration on small fixtures."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tabaudit.operators import availability, mapping, payloads, progress, schema
from tabaudit.plans.migrate import fold_batch, key_plan, plan_batch
from tabaudit.sources import pages, progress_log, reports, tables

ALIASES = {"kab_kota": "kabupaten_kota", "jml": "jumlah", "thn": "tahun", "ket": "keterangan"}


def ready_of(spark, *rows):
    data = [(d, t, json.dumps(r) if not isinstance(r, str) else r, i) for i, (d, t, r) in enumerate(rows)]
    return spark.createDataFrame(data, "Dataset_Id string, Judul_Tabel string, Row_Data_JSON string, row_no long")


def targets_of(spark, *titles):
    return spark.createDataFrame([(i, name, title) for i, (name, title) in enumerate(titles)], "ord long, id string, judul string")


def log_of(spark, *lines):
    return spark.createDataFrame([(*line, i) for i, line in enumerate(lines)], "new_id string, status string, rows_sent long, batch_number int, seq long")


def page(count, data):
    return json.dumps({"_meta": {"pageCount": count}, "data": data})


def test_pages(spark, tmp_path):
    docs = [
        ("c", 1, page(2, [{"id": 1, "judul": "Padi"}, "noise", 7, "{x"]), True), ("c", 2, page(9, [{"id": "3", "judul": "PADI b", "k": 2.50}]), True),
        ("c", 3, page(2, [{"id": 4, "judul": "beyond"}]), True), ("d", 1, page("x", [{"a": 1}]), True), ("d", 2, page(2, [{"a": 2}]), True),
        ("e", 1, page(3, [{"a": 1}]), True), ("e", 2, "<html>", True), ("e", 3, page(3, [{"a": 3}]), True),
    ]
    for name, number, body, _ in docs:
        folder = tmp_path / "pages" / f"dataset_id={name}" / f"page={number}"
        folder.mkdir(parents=True)
        (folder / "body.json").write_text(body)
    landed = pages.read_landed_pages(spark, str(tmp_path / "pages"))
    found = pages.catalog_from_pages(landed.where("dataset_id = 'c'")).orderBy("ord").collect()
    assert [(r.id, r.judul) for r in found] == [("1", "Padi"), ("3", "PADI b")] and set(found[1].extra) == {"k"}
    assert pages.catalog_from_pages(landed.where("dataset_id = 'c'"), max_pages=1).count() == 1
    rows = pages.records_from_pages(landed.where("dataset_id <> 'c'"), fail_fast=False).collect()
    assert sorted((r.dataset_id, r.row["a"]) for r in rows) == [("d", "1"), ("e", "1")]
    with pytest.raises(Exception, match="unusable page 2"):
        pages.records_from_pages(landed.where("dataset_id = 'e'")).collect()
    status = {r.dataset_id: r.ok for r in pages.fetch_status(landed).collect()}
    assert status == {"c": True, "d": True, "e": False}
    assert pages.target_catalog(landed.where("dataset_id = 'x'")).count() == 0


def test_ready_csv_round_trip(spark, tmp_path):
    ready = ready_of(spark, ("007", 'Padi, "A"', {"tahun": "2021", "x": 'say "hi"\nthere'}))
    path = str(tmp_path / "ready")
    assert reports.write_csv(ready, path)
    back = tables.read_ready_csv(spark, path)
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in ready.collect()]
    assert not reports.write_csv(ready.where("false"), str(tmp_path / "none"))
    with pytest.raises(ValueError):
        tables.check_ready(ready.drop("Judul_Tabel"))


def test_ready_csv_keeps_line_breaks_in_cells(spark, tmp_path):
    ready = ready_of(spark, ("007", 'Padi\n"A", sawah\n\nladang', {"x": "a"}), ("008", "Jagung", {"x": "b\nc"}))
    path = str(tmp_path / "ready")
    assert reports.write_csv(ready, path)
    assert sorted(tuple(r) for r in tables.read_ready_csv(spark, path).collect()) == sorted(tuple(r) for r in ready.collect())
    (tmp_path / "own.csv").write_text('Dataset_Id,Judul_Tabel,Row_Data_JSON\n7,"Padi\nA","{""x"": 1}"\n8,Jagung,"{}"\n')
    back = tables.read_ready_csv(spark, str(tmp_path / "own.csv")).orderBy("row_no").collect()
    assert [tuple(r)[:3] for r in back] == [("7", "Padi\nA", '{"x": 1}'), ("8", "Jagung", "{}")]


def test_aliases(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"column_aliases": {" KAB ": "Nama "}, "fuzzy_threshold": 70}')
    assert tables.read_aliases(spark, str(tmp_path / "a.json")) == ({"kab": "nama"}, 70)
    assert tables.read_aliases(spark, str(tmp_path / "none.json")) == ({}, None)
    assert tables.parse_aliases("{") == ({}, None)


def test_key_normalisation(spark):
    ready = ready_of(spark, ("a", "t", {"Kab_Kota": "Solo", "Kecamatan": "x", "kabupaten_kta": "typo", "THN": "2020", "jumlah": 1}))
    plan = {r.old: (r.new, r.method, r.score) for r in key_plan(ready, ALIASES, 80).collect()}
    assert plan == {
        "Kab_Kota": ("kabupaten_kota", "explicit_alias", 100), "Kecamatan": ("kecamatan", "lowercase_fallback", 0),
        "kabupaten_kta": ("kabupaten_kota", "fuzzy_alias_target", 96), "THN": ("tahun", "explicit_alias", 100), "jumlah": ("jumlah", None, None),
    }
    rows = schema.apply_plan(payloads.unpack_rows(ready), key_plan(ready, ALIASES, 80)).first().row
    assert rows == {"kecamatan": "x", "kabupaten_kota": "typo", "tahun": "2020", "jumlah": "1"}


def test_automap(spark):
    ready = ready_of(spark, ("A1", "Jawa Tengah Data Padi", {}), ("A1", "Jawa Tengah Data Padi", {}), ("A2", "Data Kemiskinan", {}),
                     ("A3", "Data Padi Jateng 2020", {}), ("A4", "Data Padi Jateng 2021", {}))
    targets = targets_of(spark, ("9", "data padi jawa tengah"), ("10", "Data Padi Jawa Tengah"), ("11", "Data Padi Jateng"), ("12", "Produksi Ikan Laut"))
    found = mapping.automap(ready, targets)
    got = {r.old_id: (r.new_id, r.match_score) for r in found.collect()}
    assert got == {"A1": ("9", 100), "A3": ("11", 86), "A4": ("11", 86)}
    assert {r.old_id for r in mapping.collisions(found).collect()} == {"A3", "A4"}
    unmapped = mapping.automap_unmapped(ready, targets, found).collect()
    assert [(r.old_id, r.highest_score > 0) for r in unmapped] == [("A2", True)]
    done = spark.createDataFrame([("9",)], "new_id string")
    open_only = mapping.automap(ready, targets, 85, done)
    assert {r.old_id: r.new_id for r in open_only.collect()}["A1"] == "10"
    marked = mapping.with_best_is_done(open_only, ready, targets, done).collect()
    assert {r.old_id: r.best_is_done for r in marked} == {"A1": True, "A3": False, "A4": False}


def test_payloads(spark):
    ready = ready_of(
        spark, ("A1", "t", {"tahun": 2021, "n": 1}), ("A1", "t", {"tahun": "2021.0", "n": 2}), ("A1", "t", {"tahun": "2022", "n": 3}), ("A1", "t", {"n": 4}),
        ("A1", "t", {"tahun": "tidak_tau"}), ("A1", "t", {"tahun": 0}), ("A1", "t", {"tahun": None}), ("A1", "t", "{bad"), ("B", "t", {"tahun": 2021}),
        ("A1", "t", {"tahun": "inf"}), ("A1", "t", {"tahun": True}),
    )
    targets = spark.createDataFrame([("A1", "10")], "old_id string, new_id string")
    classified = payloads.classify_rows(ready, targets)
    documents = payloads.payload_documents(payloads.payload_rows(classified), None).collect()
    got = {(r.target_id, r.body.tahun_data): [{k: v.toPython() for k, v in d.items()} for d in r.body.data] for r in documents}
    assert got == {("10", 2021): [{"n": 1}, {"n": 2}], ("10", 2022): [{"n": 3}]}
    rejects = {r.row_no: r.reject_reason for r in payloads.payload_rejects(classified).collect()}
    assert rejects == {3: "missing_year", 4: "invalid_year", 5: "invalid_year", 6: "missing_year", 7: "invalid_json", 8: "unmapped_dataset", 9: "invalid_year", 10: "invalid_year"}
    chunks = payloads.payload_documents(payloads.payload_rows(classified), 1).collect()
    assert sorted(len(r.body.data) for r in chunks) == [1, 1, 1]


def test_payloads_are_cut_by_position(spark):
    """Paged row numbers have large gaps; only the position in the payload decides the cut."""
    rows = [(f"{k % 2}", "a", 2021, ((k // 7) << 32) + k % 7, {"n": str(k)}) for k in range(50)]
    frame = spark.createDataFrame(rows, "target_id string, old_id string, tahun_data int, row_no long, record map<string,string>").repartition(5)
    found = {(r.target_id, r.chunk): [d["n"].toPython() for d in r.body.data] for r in payloads.payload_documents(frame, 10).collect()}
    for target in "01":
        own = [n for t, _, _, _, record in sorted(rows, key=lambda r: r[3]) for n in [record["n"]] if t == target]
        assert [found[(target, chunk)] for chunk in range(3)] == [own[:10], own[10:20], own[20:]]
    assert len(found) == 6


def test_one_chunk_fails_alone(spark):
    rows = [("10", "a", 2021, k, {"n": str(k)}) for k in range(5)]
    frame = spark.createDataFrame(rows, "target_id string, old_id string, tahun_data int, row_no long, record map<string,string>")
    documents = payloads.payload_documents(frame, 2)
    outcomes = documents.select("target_id", "old_id", F.col("body.tahun_data").alias("tahun_data"), "chunk", (F.col("chunk") != 1).alias("ok"), F.size("body.data").alias("n_rows"))
    assert [(r.status, r.rows_sent, r.n_failed) for r in payloads.outcome_fold(outcomes).collect()] == [("partial", 3, 1)]
    failed = payloads.failed_payloads(documents, outcomes).collect()
    assert [(r.chunk, [d["n"].toPython() for d in r.body.data]) for r in failed] == [(1, ["2", "3"])]


def test_payload_values_keep_their_types(spark):
    text = '{"tahun":2021,"n":100.50,"big":12345678901234567890.10,"b":true,"o":{"k":1},"s":"NaN","z":null,"q":"say \\"NaN\\", NaN","x":NaN}'
    ready = spark.createDataFrame([("A", "t", text, 1)], "Dataset_Id string, Judul_Tabel string, Row_Data_JSON string, row_no long")
    targets = spark.createDataFrame([("A", "10")], "old_id string, new_id string")
    documents = payloads.payload_documents(payloads.payload_rows(payloads.classify_rows(ready, targets)), None)
    body = documents.select(F.to_json("body")).first()[0]
    assert '"n":100.5,' in body and '"big":12345678901234567890.1,' in body
    assert json.loads(body)["data"] == [{"n": 100.5, "big": 12345678901234567890.10, "b": True, "o": {"k": 1}, "s": "NaN", "z": None, "q": 'say "NaN", NaN', "x": None}]


def test_text_nan_is_data(spark):
    ready = spark.createDataFrame([("a", 1, '{"x": NaN, "y": "NaN"}')], "Dataset_Id string, row_no long, Row_Data_JSON string")
    assert payloads.unpack_rows(ready).first().row == {"x": None, "y": "NaN"}


def test_titles_without_tokens_map_to_each_other(spark):
    ready = ready_of(spark, ("A", "---", {"tahun": 1}), ("B", "Ikan", {"tahun": 1}))
    found = mapping.automap(ready, targets_of(spark, ("10", "..."), ("20", "Padi")))
    assert [(r.old_id, r.new_id, r.match_score) for r in found.collect()] == [("A", "10", 100)]
    rest = mapping.automap_unmapped(ready, targets_of(spark, ("10", "..."), ("20", "Padi")), found).collect()
    assert [r.old_id for r in rest] == ["B"]


def test_sinks(spark, tmp_path):
    routed = spark.createDataFrame([("a", "ready_for_load"), ("b", "manager_review_required"), ("c", "ready_for_load")], "Dataset_Id string, Load_Decision string")
    reports.write_routed(routed, str(tmp_path / "routed"))
    back = spark.read.parquet(str(tmp_path / "routed"))
    assert {r.Dataset_Id for r in back.where("Load_Decision = 'ready_for_load'").collect()} == {"a", "c"}
    none = routed.where("false")
    assert reports.write_reports({"routed": routed, "none": none}, str(tmp_path / "reports"), ("none",)) == ["routed"]
    rows = spark.createDataFrame([("10", "a", 2021, 0, {"n": "1"}), ("10", "a", 2022, 1, {"n": "2"})], "target_id string, old_id string, tahun_data int, row_no long, record map<string,string>")
    documents = payloads.payload_documents(rows, 100)
    reports.write_payloads(documents, str(tmp_path / "payloads"))
    sent = spark.read.json(str(tmp_path / "payloads")).collect()
    assert sorted((r.target_id, r.body.tahun_data, r.body.data[0].n) for r in sent) == [("10", 2021, "1"), ("10", 2022, "2")]
    outcomes = spark.createDataFrame([("10", "a", 2021, 0, False, 1), ("10", "a", 2022, 0, True, 1)], "target_id string, old_id string, tahun_data int, chunk long, ok boolean, n_rows long")
    failed = payloads.failed_payloads(documents, outcomes)
    assert reports.write_failed(failed, str(tmp_path / "failed"), 3) and not reports.write_failed(failed.where("false"), str(tmp_path / "failed"), 4)
    again = spark.read.json(str(tmp_path / "failed")).collect()
    assert [(r.batch_number, r.body.tahun_data) for r in again] == [(3, 2021)]


def documents_of(spark, *rows):
    frame = spark.createDataFrame([(t, o, y, n, {"n": v}) for n, (t, o, y, v) in enumerate(rows)], "target_id string, old_id string, tahun_data int, row_no long, record map<string,string>")
    return payloads.payload_documents(frame, 2)


def test_stopped_batch_resumes_without_doubles_or_gaps(spark, tmp_path, monkeypatch):
    rows = [("10", "a", 2021, "1"), ("10", "a", 2021, "2"), ("10", "a", 2021, "3"), ("10", "a", 2020, "4"), ("20", "b", 2022, "5"), ("30", "c", 2022, "6")]
    documents, path = documents_of(spark, *rows), str(tmp_path / "out")
    with pytest.raises(ValueError):
        reports.handed_over(spark, path)
    some = documents.where("target_id = '10'")
    assert reports.hand_over(some, path, "first") == 3  # two chunks of 2021 and one of 2020
    # The second run stops after its documents are written and before the manifest has its line.
    real = spark.createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        reports.hand_over(documents, path, "second")
    monkeypatch.undo()
    assert real is not None and reports.handed_over(spark, path).count() == 3
    assert reports.hand_over(documents, path, "third") == 2
    assert reports.hand_over(documents, path) == 0
    out = reports.handed_over(spark, path).where("run <> ''").selectExpr("run", "target_id", "old_id", "tahun_data", "chunk", "to_json(body.data) AS data").collect()
    assert sorted((r.run, r.target_id, r.old_id or "", r.tahun_data or 0, r.chunk, r.data) for r in out) == [
        ("first", "10", "a", 2020, 0, '[{"n":"4"}]'), ("first", "10", "a", 2021, 0, '[{"n":"1"},{"n":"2"}]'), ("first", "10", "a", 2021, 1, '[{"n":"3"}]'),
        ("third", "20", "b", 2022, 0, '[{"n":"5"}]'), ("third", "30", "c", 2022, 0, '[{"n":"6"}]'),
    ]


def test_years_of_the_matrix_come_from_the_data(spark):
    rows = spark.createDataFrame([("A", "1", 2019), ("A", "1", 2019), ("A", "1", None), ("B", "2", 1875), ("B", "2", 2025)], "Judul_Tabel string, Dataset_Id string, tahun int")
    found = availability.availability_matrix(rows)
    assert found.columns[2:] == ["tahun_1875", "tahun_2019", "tahun_2025"]
    yes, no = availability.AVAILABLE, availability.NOT_AVAILABLE
    assert {tuple(r) for r in found.collect()} == {("A", "1", no, yes, no), ("B", "2", yes, no, yes)}
    assert availability.availability_matrix(rows.where("false")).collect() == []
    many = spark.range(200).selectExpr("'A' AS Judul_Tabel", "'1' AS Dataset_Id", "cast(id AS int) AS tahun")
    assert set(availability.availability_matrix(many).first()[2:]) == {yes}
    with pytest.raises(ValueError):
        availability.years_of(spark.range(2000).selectExpr("cast(id AS int) AS tahun"))


def test_snapshots_of_the_log_give_the_answers_of_the_whole_log(spark, tmp_path):
    path, rng, whole = str(tmp_path / "log"), random.Random(4), []
    assert progress_log.read(spark, path).count() == 0 and progress_log.compact(spark, path) == 0
    for number in range(1, 8):
        # Lines of earlier batches may come late; seq tells the lines of a batch apart.
        lines = [(str(rng.randrange(12)), "t", "o", rng.choice(["done", "failed", "partial"]), rng.randrange(9), None, rng.randrange(max(1, number - 3), number + 1), 100 * number + k) for k in range(6)]
        whole += lines
        assert progress_log.append(spark.createDataFrame(lines, progress.PROGRESS_SCHEMA), path) == number
        if number in (3, 6):
            assert progress_log.compact(spark, path) == number and progress_log.compact(spark, path) == 0
    full = spark.createDataFrame(whole, progress.PROGRESS_SCHEMA)
    read = progress_log.read(spark, path)
    assert len(progress_log.folders(spark, path)) == 2 and read.count() < full.count()
    assert sorted(map(tuple, progress.latest(read).collect())) == sorted(map(tuple, progress.latest(full).collect()))
    assert progress.next_batch(read).first() == progress.next_batch(full).first()
    # An addition that wasn't finished is never read, and its number isn't used again.
    (tmp_path / "log" / "additions" / "n=7" / "_SUCCESS").unlink()
    assert progress_log.folders(spark, path) == [f"{path}/snapshots/n=6"]
    assert progress_log.append(full.limit(1), path) == 8


def test_nothing_left_to_do(spark):
    ready, targets = ready_of(spark, ("A", "Data Padi", {"thn": "2021"})), targets_of(spark, ("10", "Padi Data"))
    log = tables.complete_progress(log_of(spark, ("10", "done", 5, 1)))
    assert list(plan_batch(ready, targets, log, ALIASES)) == ["remaining"]
    assert list(plan_batch(ready, targets.where("false"), log, ALIASES)) == ["remaining"]
    assert list(plan_batch(ready.where("false"), targets, log.where("false"), ALIASES)) == ["remaining"]


def test_progress(spark, tmp_path):
    log = log_of(spark, ("1", "failed", 0, 1), ("1", "done", 80, 1), ("2", "failed", 0, 1), ("3", "done", 50, 1), ("4", "partial", 20, 1))
    assert {r.new_id for r in progress.done_ids(log).collect()} == {"1", "3"}
    assert progress.next_batch(log).first()[0] == 2 and progress.next_batch(log.where("false")).first()[0] == 1
    assert tuple(progress.progress_summary(log).first()) == (4, 2, 1, 1)
    targets = targets_of(spark, *[(str(i), f"t{i}") for i in range(1, 6)])
    assert {r.id for r in progress.remaining_catalog(targets, log).collect()} == {"2", "4", "5"}
    assert {r.id: r.status for r in progress.catalog_status(targets, log).collect()} == {"1": "DONE", "2": "FAILED", "3": "DONE", "4": "PARTIAL", "5": "NEW"}
    old = tables.complete_progress(log.drop("batch_number"))
    assert progress.next_batch(old).first()[0] == 1 and progress.done_ids(old).count() == 2
    path = str(tmp_path / "log")
    assert tables.read_progress(spark, path).count() == 0
    reports.append_progress(tables.complete_progress(log), path)
    reports.append_progress(tables.complete_progress(log_of(spark, ("2", "done", 5, 2))), path)
    assert progress.progress_summary(tables.read_progress(spark, path)).first().done == 3


def test_batch_resumes(spark):
    ready = ready_of(spark, ("A", "Data Padi", {"thn": "2021", "x": 1}), ("A", "Data Padi", {"thn": "2022", "x": 2}), ("B", "Ikan Laut", {"thn": "2021"}))
    targets = targets_of(spark, ("10", "Padi Data"), ("20", "Laut Ikan"))
    empty = spark.createDataFrame([], progress.PROGRESS_SCHEMA)
    batch = plan_batch(ready, targets, empty, ALIASES)
    assert {(r.target_id, r.body.tahun_data) for r in batch["payloads"].collect()} == {("10", 2021), ("10", 2022), ("20", 2021)}
    sent = batch["payload_groups"].select("target_id", "old_id", "tahun_data", F.lit(0).alias("chunk"), (F.col("tahun_data") == 2021).alias("ok"), "n_rows")
    folded = fold_batch(sent, batch["payloads"], targets, 1)
    assert {r.new_id: (r.status, r.rows_sent) for r in folded["progress"].collect()} == {"10": ("partial", 1), "20": ("done", 1)}
    assert [(r.target_id, r.tahun_data) for r in folded["failed"].collect()] == [("10", 2022)]
    again = plan_batch(ready, targets, tables.complete_progress(folded["progress"]), ALIASES)
    assert {r.target_id for r in again["payloads"].collect()} == {"10"}


def test_availability(spark):
    ready = ready_of(spark, ("a", "A", {"tahun": "2024"}), ("a", "A", {"tahun": "2025"}), ("b", "B", {"tahun": "2019"}), ("b", "B", {"tahun": "x"}))
    rows = availability.json_unpack(ready)
    assert [tuple(r) for r in availability.year_counts(rows).collect()] == [(2019, 1), (2024, 1), (2025, 1)]
    matrix = {r.Dataset_Id: (r.tahun_2019, r.tahun_2025) for r in availability.availability_matrix(rows, [2019, 2025]).collect()}
    assert matrix == {"a": ("Tidak Tersedia", "Tersedia"), "b": ("Tersedia", "Tidak Tersedia")}
    assert {r.Dataset_Id: r.tahun for r in availability.keep_last(availability.year_range(rows, 2024)).collect()} == {"a": 2025}
