"""Operators of the audit on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from tabaudit.functions import text as text_functions
from tabaudit.operators import catalog, cleaning, routing, rules, schema
from tabaudit.plans.audit import assess, audit, clean, model_plan, rename_plan
from tabaudit.settings import Settings
from tabaudit.sources import pages
from tabaudit.sources.tables import parse_aliases

ALIASES, _ = parse_aliases(json.dumps({"column_aliases": {
    "jml": "jumlah", "kod_wil": "kode_wilayah", "thn": "tahun", "tahun_data": "tahun", "kab_kota": "nama_wilayah", "ket": "keterangan"}}))


def records(spark, rows):
    # Through JSON text: a Python dict loses its key order on the way into a map column.
    documents = [(name, n, json.dumps(row)) for name, n, row in rows]
    frame = spark.createDataFrame(documents, "dataset_id string, row_no long, document string")
    return frame.select("dataset_id", "row_no", F.from_json("document", "map<string,string>").alias("row"))


def catalog_of(spark, *titles):
    return spark.createDataFrame([(i, name, title) for i, (name, title) in enumerate(titles)], "ord long, id string, judul string")


def rows_of(df):
    return {r.row_no: r for r in df.collect()}


def sequential_plan(columns):
    """The claims of one dataset, column by column."""
    years, used, out = schema.YEAR_FALLBACKS, set(), {}
    for name in columns:
        low, target, blocked = name.strip().lower(), None, False
        if low in ALIASES:
            target, blocked = ALIASES[low], ALIASES[low] in columns
        elif low in years:
            target, blocked = "tahun", "tahun" in columns
        else:
            target = low
        if target != name and not blocked and target not in used:
            used.add(target)
            out[name] = target
    return out


def test_rename_plan_equals_sequential_claims(spark):
    lists = [
        ["kod_wil", "kode_wilayah", "THN", "Year"], ["Tahun", "thn", "jml"], ["thn", "Tahun", "Jml", "JML"], ["Nama", "nama", "NAMA"],
        ["tahundata", "tahun_pembuatan"], ["kab_kota", "Kabupaten", "X y"], ["tahun", "year", "PROV", "prov"],
    ]
    rows = [(f"d{i}", 0, {name: "1" for name in names}) for i, names in enumerate(lists)]
    plan = schema.audit_rename_plan(schema.dataset_columns(records(spark, rows)), ALIASES).where("method is not null").collect()
    for i, names in enumerate(lists):
        assert {r.old: r.new for r in plan if r.dataset_id == f"d{i}"} == sequential_plan(names), names


def test_columns_in_first_seen_order(spark):
    rows = [("d", 1, {"b": "1", "c": "1"}), ("d", 0, {"b": "1", "a": "1"})]
    found = schema.dataset_columns(records(spark, rows)).orderBy("ord").collect()
    assert [r.col for r in found] == ["b", "a", "c"]


def test_clean_chain(spark):
    rows = [("d", 0, {"Kab_Kota": "  Kota \t  Semarang  ", "kod_wil": "3320", "thn": "2022", "jumlah": "100"})]
    frame = records(spark, rows)
    row = clean(frame, rename_plan(frame, ALIASES)).first().row
    assert row == {"nama_wilayah": "Kota Semarang", "kode_wilayah": "33.20", "tahun": "2022", "jumlah": "100"}


RAGGED = [
    ("a", 0, {"kod_wil": "3320", "thn": "2022"}), ("a", 1, {"kod_wil": "3321", "thn": None}),
    ("b", 0, {"kod_wil": "3320", "thn": "2022"}), ("b", 1, {"tahun": "2021"}),  # here thn isn't the year
    ("c", 0, {"thn": "2020", "kod_wil": "3320"}), ("c", 1, {"kod_wil": ""}), ("c", 2, {"KOD_WIL": "1", "kod_wil": "2"}),
    ("d", 0, {"tahun": "2021"}), ("d", 1, {}), ("e", 0, None),
]


def test_rows_meet_the_plan_by_key_list(spark):
    """The same rows as by dataset, also where a key list fares differently in several datasets."""
    frame = records(spark, RAGGED)
    found = schema.layouts(frame)
    plan = rename_plan(frame, ALIASES, found)
    by_dataset = {(r.dataset_id, r.row_no): r.row for r in schema.apply_plan(frame, plan).collect()}
    assert {(r.dataset_id, r.row_no): r.row for r in schema.apply_plan(frame, plan, found).collect()} == by_dataset
    assert by_dataset["a", 0]["tahun"] == "2022" and by_dataset["b", 0]["thn"] == "2022" and len(by_dataset) == len(RAGGED)
    alike, apart = schema.layout_changes(found, plan)
    assert {tuple(r["keys"]) for r in apart.collect()} == {("kod_wil", "thn")} and alike.where(F.array_contains("keys", "tahun")).count() == 1
    for required in (["tahun", "kode_wilayah"], []):
        by_columns = rules.flag_missing(rules.start_audit(clean(frame, plan)), required, schema.final_columns(plan))
        by_layout = rules.flag_missing(rules.start_audit(clean(frame, plan, found, required)), required)
        assert by_layout.columns == by_columns.columns
        assert {(r.dataset_id, r.row_no): r.flag_reason for r in by_layout.collect()} == {(r.dataset_id, r.row_no): r.flag_reason for r in by_columns.collect()}
    with pytest.raises(ValueError):
        schema.apply_plan(frame, plan, required=["tahun"])


def test_rows_of_like_datasets_are_not_exchanged(spark):
    frame = records(spark, [(f"d{i}", n, {"kod_wil": "3320", "thn": "2022", "jumlah": "1"}) for i in range(20) for n in range(3)])
    found = schema.layouts(frame)
    applied = schema.apply_plan(frame, rename_plan(frame, ALIASES, found), found, ["tahun"])
    assert "hashpartitioning" not in applied._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r.row) for r in applied.collect()} == {("kode_wilayah", "tahun", "jumlah")} and applied.first().present == ["tahun"]


@pytest.mark.parametrize("code,want", [
    ("3320", "33.20"), ("332001", "33.20.01"), ("33200107", "33.20.01.07"), ("3320010007", "33.20.01.0007"),
    ("33.20", "33.20"), ("abc", "abc"), (None, None), ("33", "33"), ("33201", "33.20"),
])
def test_region_codes(spark, code, want):
    fixed = cleaning.fix_region_codes(records(spark, [("d", 0, {"kode_wilayah": code})]))
    assert fixed.first().row == {"kode_wilayah": want}


def test_rules_accumulate_reasons(spark):
    rows = [
        ("d", 0, {"province": "A", "year": "2020"}), ("d", 1, {"province": "A", "year": "2020"}),
        ("d", 2, {"province": "B", "year": "1999"}), ("d", 3, {"province": None, "year": "2020"}),
    ]
    frame = records(spark, rows)
    columns = schema.dataset_columns(frame)
    audited = rules.flag_missing(rules.start_audit(frame), ["province", "absent"], columns)
    audited = rules.flag_duplicates(audited, ["province", "year"], columns)
    audited = rules.flag_where(audited, F.col("row")["year"] == "2020", "odd")
    got = rows_of(rules.mark_ready(rules.warn_year(audited, 2000, 2025, "year")))
    assert got[0].flag_reason == "Duplicate subset: ['province', 'year'] | odd" and got[0].migration_status == "flagged"
    assert got[2].flag_reason == "WARNING: tahun di luar range [2000-2025]" and got[2].migration_status == "ready"
    assert got[3].flag_reason == "Missing 'province' | odd"
    issues = schema.schema_issues(columns, ["absent"]).first().Schema_Issues
    assert issues == "Missing required columns: ['absent']"
    assert rules.duplicate_check_issues(columns, ["x", "year"]).first().issue == "Duplicate check skipped, missing columns: ['x']"
    with pytest.raises(TypeError):
        rules.flag_where(audited, True, "no column")


def test_status_brought_by_the_rows(spark):
    rows = [("d", 0, {"migration_status": "REJECTED", "flag_reason": None, "x": "1"}), ("d", 1, {"x": "2"})]
    got = rows_of(rules.mark_ready(rules.start_audit(records(spark, rows))))
    assert (got[0].migration_status, got[0].flag_reason, got[0].row) == ("rejected", "", {"x": "1"})
    assert got[1].migration_status == "ready"


def test_gate(spark):
    frame = spark.createDataFrame([(1, "ready"), (2, "flagged"), (3, "READY"), (4, None)], "id int, migration_status string")
    assert {r.id for r in routing.gate_select(frame).collect()} == {1, 3}
    assert tuple(routing.gate_summary(frame).first()) == (4, 2, 2)
    with pytest.raises(ValueError):
        routing.gate_select(frame, [" "])
    with pytest.raises(ValueError):
        routing.gate_select(frame.drop("migration_status"))


def sequential_groups(titles, threshold):
    from tabaudit.functions.similarity import ratio

    keys = [" ".join(sorted(t.split())) for t in titles]
    free, groups = list(range(len(keys))), []
    while free:
        head, rest = free[0], free[1:]
        group = [head] + [i for i in rest if ratio(keys[head], keys[i]) >= threshold]
        free = [i for i in rest if i not in group]
        if len(group) > 1:
            groups.append(group)
    return groups


def test_title_groups_follow_catalog_order(spark):
    titles = ["produksi padi jawa tengah", "jawa tengah produksi padi", "data kemiskinan", "kemiskinan data", "produksi padi jawa tengan",
              "produksi padu jawi tengan", "produksi padu jawi tongan", "prodaksi padu jawi tongan", "data kemiskinen", "lain sekali"]
    frame = catalog_of(spark, *[(f"i{n}", t) for n, t in enumerate(titles)])
    for threshold in (60, 85, 92, 96):
        found = catalog.title_groups(frame, threshold).collect()
        got = sorted(sorted(r.ord for r in found if r.group_ord == g) for g in {r.group_ord for r in found})
        assert got == sequential_groups(titles, threshold), threshold
    assert {r.group_ord for r in catalog.title_groups(frame, 0).collect()} == {0}
    with pytest.raises(ValueError):
        catalog.title_groups(frame.drop("judul"))


def test_duplicates_by_content(spark):
    rows = []
    for name, places in {"A": ["Semarang", "Solo", "Kudus"], "B": ["Semerang", "Solo", "Kudus"], "C": ["Kudus", "Solo", "Semarang"], "D": ["x", "y", "z"]}.items():
        rows += [(name, i, {"kabupaten": place, "jumlah_miskin": str(100 + len(place))}) for i, place in enumerate(places)]
    rows += [("E", 0, {"a": " "})]
    frame = catalog_of(spark, *[(name, "Data Kemiskinan") for name in "ABCDEF"])
    groups = catalog.title_groups(frame)
    classes = catalog.sample_classes(groups, records(spark, rows))
    pairs = catalog.class_pairs(classes, 98)
    report = {(r.ID_Tabel_A, r.ID_Tabel_B): (r.Skor_Kemiripan, r.Alasan_Duplikat) for r in catalog.duplicate_report(classes, pairs, groups).collect()}
    assert report == {
        ("A", "B"): (99.0, "Isi data hampir identik (99.0%)"), ("A", "C"): (100.0, "Isi data identik (100%)"),
        ("B", "C"): (99.0, "Isi data hampir identik (99.0%)"),
    }
    assert {r.dataset_id for r in catalog.suspect_ids(classes, pairs).collect()} == {"A", "B", "C"}
    assert {r.dataset_id for r in catalog.suspect_ids(classes, catalog.class_pairs(classes, 100)).collect()} == {"A", "C"}
    status = spark.createDataFrame([("A", False, "timeout")], "dataset_id string, ok boolean, message string")
    skipped = {r.Dataset_ID_Gagal: r.Kategori_Error for r in catalog.skipped_report(groups, records(spark, rows), status).collect()}
    assert skipped == {"A": catalog.FETCH_ERROR, "E": catalog.EMPTY_FINGERPRINT, "F": catalog.EMPTY_DETAIL}


def test_audit_end_to_end(spark):
    frame = catalog_of(spark, ("1", "Data Padi Semarang"), ("2", "Semarang Data Padi"), ("3", "Ikan Laut"), ("4", "Kosong"), ("5", "Gagal"), ("6", "Cabai Rawit"))
    rows = [("1", i, {"tahun": "2022", "jumlah": str(i)}) for i in range(3)] + [("2", i, {"tahun": "2022", "jumlah": str(i)}) for i in range(3)]
    rows += [("3", 0, {"Tahun": "2021", "jml": "5"}), ("3", 1, {"Tahun": "2021", "jml": "6"}), ("6", 0, {"tahun": "2020", "jumlah": None})]
    status = spark.createDataFrame([("5", False, "boom")], "dataset_id string, ok boolean, message string")
    settings = Settings(max_datasets=10, require_columns=("tahun", "jumlah"))
    tables = audit(frame, records(spark, rows), ALIASES, settings, status)
    quality = {r.Dataset_Id: (r.Load_Decision, r.Total_Rows, r.Schema_Issues) for r in tables["quality"].collect()}
    assert quality == {
        "1": (routing.REVIEW, 3, ""), "2": (routing.REVIEW, 3, ""), "3": (routing.READY_FOR_LOAD, 2, ""),
        "4": (routing.SKIPPED, 0, "Tabel Kosong (0 baris)"), "5": (routing.SKIPPED, 0, "API Error: boom"), "6": (routing.REVIEW, 1, ""),
    }
    ready = [json.loads(r.Row_Data_JSON) for r in tables["load_ready"].orderBy("row_no").collect()]
    assert ready == [{"tahun": "2021", "jumlah": "5"}, {"tahun": "2021", "jumlah": "6"}]
    review = tables["manager_review"].collect()
    assert len(review) == 7 and {r.Dataset_Id for r in review if r.Catalog_Suspect} == {"1", "2"}
    assert tables["summary"].first().asDict() == {"Total_Dataset_Dinilai": 6, "Total_Baris_Dinilai": 9, "Total_Baris_Siap_Load": 8, "Total_Baris_Bermasalah": 1}
    assert tables["routed"].count() == 9
    few = audit(frame, records(spark, rows), ALIASES, Settings(max_datasets=1), check_duplicates=False)
    assert [r.Dataset_Id for r in few["quality"].collect()] == ["1"]
    empty = audit(frame.where("false"), records(spark, []), ALIASES, settings, check_duplicates=False)
    assert empty["summary"].count() == 0


def test_settings_fall_back():
    found = Settings.from_mapping({"dup_threshold": "150", "year_min": "1990", "max_pages": "x", "require_columns": " Tahun , Jumlah", "allowed_load_statuses": " , "})
    assert (found.dup_threshold, found.year_min, found.max_pages) == (85, 1990, None)
    assert found.require_columns == ("tahun", "jumlah") and found.allowed_load_statuses == ("ready",)


def test_values_keep_their_type_from_page_to_packed_row(spark):
    item = {"Jml": 2500, "nilai": 1250.50, "aktif": True, "kod_wil": 3320, "kode": "0012", "Kab_Kota": " Kota  X ", "sub": {"a": "x  y"}, "kosong": None, "thn": 2021, "q\"k": 1}
    body = json.dumps({"_meta": {"pageCount": 1}, "data": [item]})
    landed = spark.createDataFrame([("d", 1, body, True)], "dataset_id string, page int, body string, ok boolean")
    found = pages.records_from_pages(landed)
    assert sorted(found.first().bare) == sorted(["Jml", "nilai", "aktif", "kod_wil", "sub", "thn", "q\"k"])
    tables = audit(catalog_of(spark, ("d", "Data")), found, ALIASES, Settings(require_columns=("jumlah",)), check_duplicates=False)
    (row,) = tables["load_ready"].collect()
    assert json.loads(row.Row_Data_JSON) == {
        "jumlah": 2500, "nilai": 1250.5, "aktif": True, "kode_wilayah": "33.20", "kode": "0012", "nama_wilayah": "Kota X", "sub": {"a": "x  y"}, "kosong": None, "tahun": 2021, "q\"k": 1,
    }


def test_gate_does_not_work_out_the_rules_again(spark):
    rows = records(spark, [("d", 1, {"tahun": "1990", "kode_wilayah": " 3320 "}), ("d", 2, {"tahun": "", "kode_wilayah": "11"})])
    found = schema.layouts(rows)
    plan = rename_plan(rows, {}, found)
    audited = assess(clean(rows, plan, found, ["tahun"]), plan, Settings(require_columns=("tahun",)))

    def mentions(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("transform_values")

    chosen = routing.gate_select(audited)
    assert mentions(chosen) <= mentions(audited)
    assert [row.row_no for row in chosen.collect()] == [1]


def test_renames_are_planned_once_for_like_datasets(spark):
    """The plan doesn't grow with the datasets, and every dataset has the renames that it would get by itself."""
    rows = [(f"{name}{i}", n, row) for i in range(6) for name, n, row in RAGGED] + [(None, 0, {"tahun": "2021", "thn": "1"}), (None, 1, {"KOD_WIL": "1"})]
    frame = records(spark, rows)
    found = schema.layouts(frame)
    models, plan = model_plan(found, ALIASES)
    assert plan.select("dataset_id").distinct().count() == 5  # a to d, and the rows without an id
    alone = schema.settle_duplicates(schema.with_year_rename(schema.audit_rename_plan(schema.dataset_columns(frame), ALIASES)))
    assert sorted(map(str, schema.of_all(plan, models).select(*alone.columns).collect())) == sorted(map(str, alone.collect()))

    def rows_by(applied):
        return sorted(str((r.dataset_id, r.row_no, r.row)) for r in applied.where("dataset_id is not null").collect())

    assert rows_by(schema.apply_plan(frame, plan, found, ["tahun"], models)) == rows_by(schema.apply_plan(frame, alone))


def test_finding_key_lists_makes_each_row_once(spark):
    found = schema.layouts(records(spark, RAGGED))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert {(r.dataset_id, tuple(r["keys"])) for r in found.collect()} == {(name, tuple(row)) for name, _, row in RAGGED if row is not None}


def test_texts_without_escapes_need_no_json_writer(spark):
    texts = ["", "plain", "q\"", "b\\", "n\n", "\x1f", "\x7f", "é😀", None]
    frame = records(spark, [("d", n, {"k\"": text, "n": "1.50"}) for n, text in enumerate(texts)])
    document = text_functions.typed_json(F.col("row"), F.array(F.lit("n")))
    for (found,), text in zip(frame.orderBy("row_no").select(document).collect(), texts, strict=True):
        assert json.loads(found) == {"k\"": text, "n": 1.5} and "1.50" in found
    assert str(document).count("is_valid_utf8") > 0


@pytest.mark.parametrize("code,want", [(" 3320\t", "33.20"), ("3320010\x85", "33.20.01"), ("٣٣٢٠", "٣٣.٢٠"), (" 332 ", " 332 "), ("33 20", "33 20"), ("", "")])
def test_region_codes_in_three_passes(spark, code, want):
    frame = spark.createDataFrame([(code,)], "code string")
    fixed = frame.select(text_functions.format_region_code(F.col("code")).alias("fixed"), text_functions.is_undotted_code(F.col("code")).alias("undotted"))
    assert tuple(fixed.first()) == (want, want != code)
    assert fixed.select("fixed")._jdf.queryExecution().analyzed().toString().count("regexp_replace") == 3
