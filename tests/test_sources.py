"""Ingest, workbooks, landing folder and stream."""

from pyspark.sql import functions as F

from ledgerloom.sources import ingest, xlsx
from ledgerloom.streaming import landing


def test_workbook_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a & <b>", None, 2.5), (2, None, "é", None)], "id long, x string, y string, z double")
    xlsx.write_workbook({"One": rows, "Two & more": rows.limit(0)}, str(tmp_path / "w.xlsx"))
    grid = xlsx.read_grid(spark, str(tmp_path))
    got = {(r.sheet, r.row_idx): r.cells for r in grid.collect()}
    assert got == {("One", 0): ["id", "x", "y", "z"], ("One", 1): ["1", "a & <b>", None, "2.5"], ("One", 2): ["2", None, "é", None], ("Two & more", 0): ["id", "x", "y", "z"]}
    body = ingest.body(grid.where("sheet = 'One'"), 0, ["id", "x", "y", "z"])
    assert body.count() == 2


def test_headers(spark):
    rows = [("a", 0, ["Report", None, None, None]), ("a", 1, ["Placing No.", "Client Name", "Policy No", "Amount"]), ("a", 2, ["P1", "N", "1", "2"]), ("b", 0, ["1", None, None, None]), ("c", 25, ["Placing No.", "Client Name", "Policy No", "Amount"]), ("c", 3, [None, None, None, None])]
    got = {r.sheet: r.header_row for r in ingest.header_rows(spark.createDataFrame(rows, "sheet string, row_idx int, cells array<string>")).collect()}
    assert got == {"a": 1, "b": 0, "c": 0}


def test_sheets_and_mappings(spark):
    assert ingest.group_sheets({"a": ["x", "y"], "b": ["X ", "y"], "c": ["z"]}) == [["a", "b"], ["c"]]
    assert not ingest.alike([], [])
    assert ingest.parse_mapping('{"a": "b", }') == {"a": "b"}
    assert spark.range(1).select(ingest.mapping(F.lit('{"a": "b", }'))).first()[0] == {"a": "b"}
    df = spark.createDataFrame([("p", None, "q", "u")], "REF string, Placing string, x string, `Unnamed: 3` string")
    chosen = ingest.column_mapping(df.columns, ingest.LEFT_NAMES, {"Placing": "PlacingNo", "REF": "PlacingNo", "gone": "Amount"})
    assert ingest.apply_mapping(df, chosen, "_INSURER").first().asDict() == {"PlacingNo_INSURER": "p", "x_INSURER": "q"}
    assert ingest.check_columns(ingest.fill_missing(df, ["Amount"]), ["Amount", "ClientName"]) == ["ClientName"]


def test_landing_folder(spark, tmp_path):
    status = str(tmp_path / "status")
    for folder, s in (("/in/a", "Pending"), ("/in/b", "pending"), ("/in/c", "Manual Review")):
        landing.mark(spark, status, folder, s)
    files = spark.createDataFrame([("/in/a/CBL x.xlsx",), ("/in/a/ins.xlsx",), ("/in/b/cbl.xlsx",), ("/in/c/cbl.xlsx",), ("/in/c/i.xlsx",)], "path string")
    seen = []
    assert landing.run_pending(spark, status, files, lambda *x: seen.append(x)) == ["/in/a"]
    assert seen == [("/in/a", "/in/a/CBL x.xlsx", "/in/a/ins.xlsx")]
    assert {r.folder: r.status for r in landing.latest(spark.read.parquet(status)).collect()} == {"/in/a": "Manual Review", "/in/b": "pending", "/in/c": "Manual Review"}


def test_landing_folder_goes_on_after_a_failure(spark, tmp_path):
    status = str(tmp_path / "status")
    for folder in ("a", "b/c"):
        (tmp_path / "in" / folder).mkdir(parents=True)
        for name in ("CBL.xlsx", "ins.xlsx", "notes.txt"):
            (tmp_path / "in" / folder / name).write_bytes(b"x")
    files = landing.crawl(spark, str(tmp_path / "in"))
    folders = sorted(r.folder for r in landing.ledger_files(files).collect())
    assert [f.rsplit("/in/", 1)[1] for f in folders] == ["a", "b/c"]
    for folder in folders:
        landing.mark(spark, status, folder, "pending")

    def work(folder, left, right):
        if folder == folders[0]:
            raise ValueError("no sheet with rows")

    assert landing.run_pending(spark, status, files, work) == folders[1:]
    assert {r.folder: r.status for r in landing.latest(spark.read.parquet(status)).collect()} == {folders[0]: "Failed", folders[1]: "Manual Review"}
    assert landing.run_pending(spark, status, files, work) == []


def test_mappings_fall_back(spark):
    assert ingest.custom_mapping('{"a": "b",}') == {"a": "b"} and ingest.custom_mapping("{broken") == ingest.custom_mapping("[1]") == ingest.custom_mapping(None) == {}
    items = spark.createDataFrame([("Acme", 3, "a|x"), ("ACME", 1, "b|y"), ("Other", 2, "c|z"), ("acme", 4, " "), ("acme", 5, None)], "folder string, position long, matrix_key string")
    assert {tuple(r) for r in ingest.matrix_list(items, "acme").collect()} == {(3, "a|x"), (1, "b|y")}


def test_workbook_rows_keep_their_order_and_rules_apply(spark, tmp_path):
    from ledgerloom.plans import workbooks

    left = spark.createDataFrame([("Z9", "zed", "-10"), ("A1", "ann", "-20"), ("M5", "max", "-7")], "PlacingNo string, ClientName string, Amount string").coalesce(1)
    more = spark.createDataFrame([("B2", "bob", "-1")], "PlacingNo string, ClientName string, Amount string")
    right = spark.createDataFrame([("Q", "other", "30")], "PlacingNo string, ClientName string, Amount string")
    xlsx.write_workbook({"Zulu": left, "Alpha": more}, str(tmp_path / "l.xlsx"))
    xlsx.write_workbook({"S": right}, str(tmp_path / "r.xlsx"))
    rows = workbooks.read_ledger(spark, str(tmp_path / "l.xlsx")).orderBy(ingest.PLACE).collect()
    assert [r.PlacingNo for r in rows] == ["Z9", "A1", "M5", "B2"] and [r[ingest.PLACE] for r in rows][:3] == [0, 1, 2]
    rules = spark.createDataFrame([(1, "Z9#zed,A1#ann|Q#other")], "rule_id long, rule string")
    tables = workbooks.run(spark, str(tmp_path / "l.xlsx"), str(tmp_path / "r.xlsx"), rules=rules, key_columns=(["PlacingNo", "ClientName"], ["PlacingNo", "ClientName"]))
    assert sorted(r.PlacingNo for r in tables["exact match cbl"].collect()) == ["A1", "Z9"]


def test_stream(spark, tmp_path):
    schema = "l_id long, r_id long, l_amount decimal(18,2), r_amount decimal(18,2)"
    spark.sql("select 1L l_id, 2L r_id, cast(-5 as decimal(18,2)) l_amount, cast(5 as decimal(18,2)) r_amount").write.parquet(str(tmp_path / "in"))
    landing.stream_tiers(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert [r.tier for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["PERFECT_MATCH"]


def test_workbooks_to_report(spark, tmp_path):
    from ledgerloom.operators import report
    from ledgerloom.plans import workbooks

    left = spark.createDataFrame([("Placing No.", "Client Name", "Policy No.", "Net Amount"), ("PL/0000000001", "Ann", "10001", "-100"), ("PL/0000000002", "Bob", "x", "bad")], "`Broker statement` string, `_1` string, `_2` string, `_3` string")
    right = spark.createDataFrame([("PL/0000000001", "Ann", "10001", 100.0)], "BRKREF string, NAME string, POLNO string, Amount double")
    xlsx.write_workbook({"S": left}, str(tmp_path / "l.xlsx"))
    xlsx.write_workbook({"S": right}, str(tmp_path / "r.xlsx"))
    maps = {"Placing No.": "PlacingNo", "Client Name": "ClientName", "Policy No.": "PolicyNo", "Net Amount": "Amount"}, {"BRKREF": "PlacingNo", "NAME": "ClientName", "POLNO": "PolicyNo_1"}
    tables = workbooks.run(spark, str(tmp_path / "l.xlsx"), str(tmp_path / "r.xlsx"), *maps)
    assert list(tables) == report.SHEETS
    assert [(r.PlacingNo, r.r_id) for r in tables["Exact Matches"].collect()] == [("PL/0000000001", 0)]
    assert [r.ClientName for r in tables["not found cbl"].collect()] == ["Bob"]
    xlsx.write_workbook(tables, str(tmp_path / "report.xlsx"))
    assert xlsx.read_grid(spark, str(tmp_path / "report.xlsx")).select("sheet").distinct().count() == 10
