from datetime import datetime
from decimal import Decimal


from frames import product_rows
from shelfledger.operators import products
from shelfledger.schemas import PRODUCTS

NOW = "2026-01-01T00:00:00Z"


def decided(spark, rows, verdicts=None, **options):
    df = products.decide_products(product_rows(spark, rows), verdicts, **options)
    return {r["row_pos"]: r for r in df.collect()}


def test_product_without_code_is_rejected(spark):
    assert products.clean_products(product_rows(spark, [{"code": None}, {"code": " \t"}])).count() == 0


def test_product_named_as_its_code_is_rejected(spark):
    row = decided(spark, [{"code": "40170725", "product_name": "40170725"}])[0]
    assert not row["accepted"]
    assert "identical to barcode" in row["failure_reason"]


def test_full_product_is_kept(spark):
    raw = product_rows(spark, [{
        "code": " 7610200337\n", "product_name": "Rye crispbread", "brands": "Nordhavn",
        "categories_tags": ["en:breads", "en:rye"], "ingredients_text": " rye flour, salt ",
        "energy_kcal_100g": "331", "last_modified_t": "1688169600"}])
    row = products.clean_products(raw).first()
    assert row.asDict() == {
        "barcode": "7610200337", "product_name": "Rye crispbread", "brand": "Nordhavn",
        "category": "en:breads", "ingredients_text": "rye flour, salt", "energy_kcal_100g": 331.0,
        "source_modified_at": row["source_modified_at"]}
    assert row["source_modified_at"] is not None


def test_caps_and_defaults(spark):
    raw = product_rows(spark, [{"product_name": "n" * 501, "brands": "b" * 301, "categories_tags": [],
                                "energy_kcal_100g": "much", "ingredients_text": "",
                                "last_modified_t": "0"}])
    row = products.clean_products(raw).first()
    assert (len(row["product_name"]), len(row["brand"]), row["category"]) == (500, 300, "unknown")
    assert row["energy_kcal_100g"] is None
    assert row["ingredients_text"] is None and row["source_modified_at"] is None


def test_verdict_reasons_in_order(spark):
    rows = [{"code": "123", "product_name": "Sparkling water"},
            {"code": None, "product_name": " "},
            {"code": "12-3", "product_name": "12-3"},
            {"code": "AB", "product_name": "ab"},
            {"code": "9", "product_name": "12 - 45"}]
    got = {r["row_pos"]: r for r in products.semantic_verdicts(product_rows(spark, rows), ["row_pos"]).collect()}
    assert [got[i]["reasons"] for i in range(5)] == [
        [], ["Missing barcode", "Missing product name"],
        ["Product name is identical to barcode", "Product name contains no descriptive text"],
        ["Product name is identical to barcode"], ["Product name contains no descriptive text"]]
    assert (got[0]["status"], got[0]["confidence"]) == ("pass", Decimal("0.9500"))
    assert (got[1]["status"], got[1]["confidence"]) == ("reject", Decimal("0.9900"))


def answers(spark, *rows):
    return spark.createDataFrame(list(rows), "barcode string, status string, confidence string, reasons array<string>")


def test_reviewer_gate(spark):
    rows = [{"code": c, "product_name": n} for c, n in (
        ("a", "Tea"), ("b", "Tea"), ("c", "Tea"), ("d", "Tea"), ("e", "5"), ("f", "Tea"))]
    reviewer = answers(spark, ("a", "reject", "0.95", ["odd"]), ("b", "reject", "0.89999", []),
                       ("c", "maybe", "7", []), ("d", "reject", None, []),
                       ("e", "pass", "1", []), ("f", "pass", "0.1", []))
    got = decided(spark, rows, reviewer)
    assert [got[i]["accepted"] for i in range(6)] == [False, True, False, True, False, True]
    assert got[0]["failure_reason"] == "odd"
    assert got[2]["failure_reason"] == "Product failed semantic validation"
    assert got[2]["verdict"]["confidence"] == 1.0 and got[2]["verdict"]["status"] == "reject"
    assert got[3]["verdict"]["confidence"] == 0.5
    # the rules' reject is not up for review
    assert got[4]["verdict"]["validator"] == "deterministic-semantic-rules"


def test_advisory_reviewer_blocks_nothing(spark):
    reviewer = answers(spark, ("1", "reject", "0.99", ["odd"]))
    row = decided(spark, [{}], reviewer, advisory=True)[0]
    assert row["accepted"] and row["verdict"]["status"] == "reject"


def test_energy_that_does_not_fit_is_rejected(spark):
    row = decided(spark, [{"energy_kcal_100g": "1e12"}])[0]
    assert not row["accepted"] and row["failure_reason"] == products.ENERGY_OUT_OF_RANGE


def test_rows_of_a_barcode_apply_in_order(spark):
    bad = {"product_name": ""}
    rows = [{"code": "x", "product_name": "First"}, {"code": "x", "product_name": "Second"},
            {"code": "y", "product_name": "Kept"}, {"code": "y", **bad},
            {"code": "z", **bad}, {"code": "z", "product_name": "Back"},
            {"code": None, "product_name": "Nameless"}]
    old = datetime(2020, 1, 1)
    base = spark.createDataFrame([(c, "Old", None, None, None, None, None, old, old)
                                  for c in ("x", "y", "z", "w")], PRODUCTS)
    decided_rows = products.decide_products(product_rows(spark, rows))
    effect = products.product_effect(decided_rows)
    got = {r["barcode"]: r for r in products.apply_products(base, effect, NOW).collect()}
    assert {b: r["product_name"] for b, r in got.items()} == {"x": "Second", "z": "Back", "w": "Old"}
    assert got["x"]["created_at"] == old and got["x"]["updated_at"] > old
    assert got["z"]["created_at"] > old  # deleted and created anew
    assert got["w"]["updated_at"] == old
    assert {r[0] for r in products.rejected_barcodes(effect).collect()} == {"y", "z"}
    kept = products.product_effect(decided_rows, retract=False)
    assert {r["barcode"] for r in products.apply_products(base, kept, NOW).collect()} == set("wxyz")
    assert products.rejected_barcodes(kept).count() == 0


def test_gate_result_does_not_depend_on_join_strategy(spark):
    rows = [{"code": str(i % 3), "product_name": "Tea"} for i in range(60)]
    reviewer = answers(spark, ("0", "reject", "0.95", ["odd"]))
    small = decided(spark, rows, reviewer)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = decided(spark, rows, reviewer)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert small == salted and sum(not r["accepted"] for r in small.values()) == 20
