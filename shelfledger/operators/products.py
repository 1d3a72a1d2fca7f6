"""Product cleaning, semantic verdicts, the reviewer gate and the effect on the product table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfledger.functions.numbers import safe_double
from shelfledger.functions.text import joined, reasons, stripped
from shelfledger.functions.times import from_epoch, instant
from shelfledger.operators.skew import join_lookup
from shelfledger.schemas import MONEY

RULES_VALIDATOR = "deterministic-semantic-rules"
UNEXPLAINED = "Product failed semantic validation"
ENERGY_OUT_OF_RANGE = "Energy value does not fit numeric(10,2)"
GATE = 0.90

CLEAN_COLUMNS = ("barcode", "product_name", "brand", "category", "ingredients_text",
                 "energy_kcal_100g", "source_modified_at")


def _stripped(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "_barcode": stripped(F.col("code")), "_name": stripped(F.col("product_name")),
        "_energy": stripped(F.col("energy_kcal_100g"))})


def _is_clean() -> Column:
    """A product loads only with a barcode, a name, and the two different."""
    return F.coalesce(F.col("_name") != F.col("_barcode"), F.lit(False))


def _cleaned() -> dict[str, Column]:
    tag = F.coalesce(F.get("categories_tags", F.lit(0)), F.lit("unknown"))
    return {
        "barcode": F.col("_barcode"),
        "product_name": F.substring(F.col("_name"), 1, 500),
        "brand": F.substring(stripped(F.col("brands")), 1, 300),
        "category": F.substring(tag, 1, 300),
        "ingredients_text": stripped(F.col("ingredients_text")),
        "energy_kcal_100g": safe_double(F.col("_energy")),
        "source_modified_at": from_epoch(F.col("last_modified_t")),
    }


def clean_products(raw: DataFrame) -> DataFrame:
    """Cleaned records of the products that can be loaded."""
    return (_stripped(raw).filter(_is_clean())
            .select(*[c.alias(n) for n, c in _cleaned().items()]))


def _rule_reasons() -> Column:
    barcode, name = F.col("_barcode"), F.col("_name")
    return reasons(
        (barcode.isNull(), "Missing barcode"),
        (name.isNull(), "Missing product name"),
        (F.lower(name) == F.lower(barcode), "Product name is identical to barcode"),
        (name.rlike(r"(?U)^[0-9\s-]+\z"), "Product name contains no descriptive text"),
    )


def semantic_verdicts(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One verdict per product row: barcode, status, confidence, reasons, validator."""
    failed = F.size("reasons") > 0
    return (_stripped(raw).withColumn("reasons", _rule_reasons())
            .select(*keep,
                    F.col("_barcode").alias("barcode"),
                    F.when(failed, "reject").otherwise("pass").alias("status"),
                    F.when(failed, 0.99).otherwise(0.95).cast("decimal(5,4)").alias("confidence"),
                    "reasons",
                    F.lit(RULES_VALIDATOR).alias("validator")))


def review_answers(answers: DataFrame) -> DataFrame:
    """Reviewer answers as verdicts, one per barcode.

    Anything but pass or reject counts as reject, confidence is held within [0, 1] and is 0.5
    when absent. Of several answers the latest stands, then a reject, then the most confident.
    """
    kind = dict(answers.dtypes)
    reason_list = F.col("reasons") if "reasons" in kind else F.array().cast("array<string>")
    validator = F.col("validator") if "validator" in kind else F.lit("reviewer")
    at = F.col("validated_at") if "validated_at" in kind else F.lit(None).cast("timestamp")
    confidence = F.coalesce(F.nanvl(F.col("confidence").try_cast("double"), F.lit(0.0)), F.lit(0.5))
    status = F.when(F.col("status").isin("pass", "reject"), F.col("status")).otherwise("reject")
    return (answers.select(
                stripped(F.col("barcode")).alias("barcode"),
                F.struct(
                    at.alias("at"),
                    status.alias("status"),
                    F.greatest(F.lit(0.0), F.least(F.lit(1.0), confidence)).alias("confidence"),
                    F.coalesce(reason_list, F.array().cast("array<string>")).alias("reasons"),
                    validator.alias("validator")).alias("answer"))
            .filter(F.col("barcode").isNotNull())
            .groupBy("barcode").agg(F.max("answer").alias("answer")))


def decide_products(raw: DataFrame, verdicts: DataFrame | None = None, threshold: float = GATE,
                    advisory: bool = False, spread: Sequence[str] = ("row_pos",)) -> DataFrame:
    """Every raw product row with its verdict, its cleaned record and whether it is accepted.

    A reviewer's answer replaces the rules' pass, never their reject. A row is accepted when the
    verdict is a pass or is held with less than ``threshold`` confidence, and the record is clean.
    With ``advisory`` a reviewer's reject is recorded and blocks nothing.
    """
    columns = raw.columns
    ruled = (_stripped(raw).withColumn("_reasons", _rule_reasons())
             .withColumn("_failed", F.size("_reasons") > 0))
    if verdicts is None:
        ruled = ruled.withColumn("_answer", F.lit(None).cast(
            "struct<status:string,confidence:double,reasons:array<string>,validator:string>"))
    else:
        answers = review_answers(verdicts).select(
            F.col("barcode").alias("_barcode"), F.col("answer").alias("_answer"))
        ruled = join_lookup(ruled, answers, "_barcode", "left", spread)

    reviewed = ~F.col("_failed") & F.col("_answer").isNotNull()
    by_rules = F.when(F.col("_failed"), F.lit(0.99)).otherwise(F.lit(0.95))
    status, confidence = F.col("_status"), F.col("_confidence")
    passes = (status == "pass") | (confidence < threshold)
    if advisory:
        passes = passes | ~F.col("_failed")
    fits = F.coalesce(F.abs("_kcal") < 99_999_999.995, F.lit(True))
    told = (F.when(F.col("_passes") & ~F.col("_fits"), F.array(F.lit(ENERGY_OUT_OF_RANGE)))
            .otherwise(F.col("verdict.reasons")))
    reason = F.coalesce(F.nullif(joined(told), F.lit("")), F.lit(UNEXPLAINED))
    cleaned = _cleaned() | {"energy_kcal_100g": F.col("_kcal").try_cast(MONEY)}
    return (ruled
            .withColumns({
                "_status": F.when(reviewed, F.col("_answer.status"))
                            .otherwise(F.when(F.col("_failed"), "reject").otherwise("pass")),
                "_confidence": F.when(reviewed, F.col("_answer.confidence")).otherwise(by_rules),
                "_kcal": safe_double(F.col("_energy"))})
            .withColumns({
                "verdict": F.struct(
                    status.alias("status"), confidence.alias("confidence"),
                    F.when(reviewed, F.col("_answer.reasons")).otherwise(F.col("_reasons"))
                     .alias("reasons"),
                    F.when(reviewed, F.col("_answer.validator"))
                     .otherwise(F.lit(RULES_VALIDATOR)).alias("validator")),
                "product": F.struct(*[c.alias(n) for n, c in cleaned.items()]),
                "_passes": passes & _is_clean(),
                "_fits": fits})
            .withColumn("accepted", F.col("_passes") & F.col("_fits"))
            .withColumn("failure_reason", F.when(~F.col("accepted"), reason))
            .select(*columns, F.col("_barcode").alias("decided_barcode"), "verdict", "product",
                    "accepted", "failure_reason"))


def verdict_rows(decided: DataFrame, run_id: Column | str, at) -> DataFrame:
    """Verdicts of a decided batch in the audit layout."""
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    return decided.select(run.alias("pipeline_run_id"), F.col("decided_barcode").alias("barcode"),
                          "verdict.status",
                          F.col("verdict.confidence").cast("decimal(5,4)").alias("confidence"),
                          "verdict.reasons", "verdict.validator", instant(at).alias("validated_at"))


def product_effect(decided: DataFrame, order: str = "row_pos", retract: bool = True) -> DataFrame:
    """What a batch does to each barcode when its rows apply in order.

    ``product`` is the record to upsert, null when the barcode ends up absent; ``removed`` tells
    whether any row took the barcode out, which ends its creation time and its prices.
    """
    rows = decided.filter(F.col("decided_barcode").isNotNull())
    if not retract:
        rows = rows.filter("accepted")
    last = F.max(F.struct(F.col(order), F.when(F.col("accepted"), F.col("product")).alias("product")))
    return (rows.groupBy(F.col("decided_barcode").alias("barcode"))
            .agg(last.alias("last"), F.max(~F.col("accepted")).alias("removed"))
            .select("barcode", F.col("last.product").alias("product"), "removed"))


def rejected_barcodes(effect: DataFrame) -> DataFrame:
    return effect.filter("removed").select("barcode")


def apply_products(base: DataFrame, effect: DataFrame, now) -> DataFrame:
    """Next product table: upserts keep the creation time, retractions drop the row."""
    at = instant(now)
    old = base.select("barcode", F.struct(*base.columns).alias("old"))
    touched = F.col("effect_removed").isNotNull()
    both = old.join(effect.select("barcode", F.col("product").alias("new"),
                                  F.col("removed").alias("effect_removed")), "barcode", "full_outer")
    kept = F.coalesce(F.when(~F.col("effect_removed"), F.col("old.created_at")), at)
    return (both.filter(~touched | F.col("new").isNotNull())
            .select("barcode",
                    *[F.when(touched, F.col(f"new.{n}")).otherwise(F.col(f"old.{n}")).alias(n)
                      for n in CLEAN_COLUMNS[1:]],
                    F.when(touched, kept).otherwise(F.col("old.created_at")).alias("created_at"),
                    F.when(touched, at).otherwise(F.col("old.updated_at")).alias("updated_at")))
