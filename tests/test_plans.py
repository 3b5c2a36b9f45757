"""The gated build, the training flow, and the shape of query plans."""

import contextlib
import io
import re
from pathlib import Path

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from creditweave.operators import histogram_boosting, ordering
from creditweave.operators.checks import CheckFailed
from creditweave.plans import build, registry, training
from creditweave.session import checkpoint_dir
from creditweave.settings import ID, Policy
from creditweave.sources import fixtures, schemas, tables


@pytest.fixture(scope="module")
def bronze(spark):
    return {name: make(spark, SMALL) for name, make in fixtures.BRONZE_BUILDERS.items()}


@pytest.fixture(scope="module")
def built(spark, bronze, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("gold"))
    return root, build.build_features(spark, bronze, root)


def test_build_end_to_end(spark, built):
    root, gold = built
    assert gold["applications"].read().count() == 1500
    assert gold["payments"].read().count() == 6000
    decided = build.build_decisions(spark, registry.linear_top_drivers(spark, SMALL), root, Policy(decline_sample_size=50))
    assert decided["scored"].read().count() == 1500
    declines = decided["declines"].read()
    assert [r[0] for r in declines.select("decline_rank").orderBy("decline_rank").collect()] == list(range(1, 51))
    assert decided["declines"].history().count() == 1


def test_bad_application_stops_the_build(spark, bronze, folder):
    broken = bronze["application_train"].withColumn("target", F.when(F.col("sk_id_curr") == 7, 3).otherwise(F.col("target")))
    with pytest.raises(CheckFailed, match="applications is_default accepted: 1 "):
        build.build_features(spark, {**bronze, "application_train": broken}, folder)
    with pytest.raises(ValueError, match="no version"):
        build.gold_tables(spark, folder)["applications"].read()


def test_bronze_tables_are_scanned_with_declared_types(spark, bronze, folder):
    for name, df in bronze.items():
        df.write.parquet(f"{folder}/{name}")
    raw = build.bronze_tables(spark, folder)
    assert {n: df.schema.simpleString() for n, df in raw.items()} == {
        n: df.schema.simpleString() for n, df in bronze.items()
    }
    assert raw["bureau"].count() == 6000


def test_missing_label_stops_the_build(spark, built):
    labels = tables.label_dictionary(spark).where("feature_name <> 'max_days_overdue'")
    predictions = registry.linear_top_drivers(spark, SMALL)
    with pytest.raises(CheckFailed, match="drivers top"):
        build.build_decisions(spark, predictions, built[0], labels=labels)


def test_orphan_prediction_stops_the_build(spark, built):
    stray = registry.linear_top_drivers(spark, SMALL).withColumn(ID, F.col(ID) + 1)
    with pytest.raises(CheckFailed, match="predictions without application: 1 "):
        build.build_decisions(spark, stray, built[0])


def test_ungrounded_writer_publishes_nothing(spark, built, folder):
    root, _ = built
    before = build.gold_tables(spark, root)["declines"].latest_version()
    predictions = registry.linear_top_drivers(spark, SMALL)
    with pytest.raises(CheckFailed, match="foreign factors"):
        build.build_decisions(
            spark, predictions, root, write_reason=lambda prompts: prompts + tables.LABELS["age_years"]
        )
    assert build.gold_tables(spark, root)["declines"].latest_version() == before


def test_training_flow(spark, built, folder):
    mart = built[1]["applications"].read()
    trained = training.train(mart, params=histogram_boosting.Params(max_trees=3, depth=3))
    log = training.evaluation(trained, "run-a")
    tables.append_metrics(log, f"{folder}/log")
    tables.append_metrics(training.evaluation(trained, "run-b"), f"{folder}/log")
    stored = spark.read.parquet(f"{folder}/log")
    names = {r["metric"] for r in stored.where("stage <> 'params'").collect()}
    assert names == {"auc", "ks", "best_iteration", "auc_eval", "brier_raw", "brier_calibrated"}
    by_run = {(r["run_id"], r["metric"]): r["value"] for r in stored.collect()}
    assert by_run["run-a", "auc"] == by_run["run-b", "auc"]
    assert by_run["run-a", "learning_rate"] == 0.05
    assert training.reliability_table(trained).agg(F.sum("n")).first()[0] == 150
    assert training.fairness_slices(trained).agg(F.sum("n")).first()[0] == 150
    predicted = training.predictions(mart, trained)
    decided = build.build_decisions(spark, predictions=predicted, root=built[0], policy=Policy(0.0, 20))
    assert decided["declines"].read().count() == 20


def plan_of(df, mode="formatted"):
    """The plan as text; formatted: operator tree first, details after."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@pytest.mark.parametrize("name", ["linear_scores", "linear_top_drivers", "declined_drivers", "draft_sql_audit"])
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_generated_methods_are_small_enough_to_compile(spark, name, threshold):
    """The JVM leaves methods beyond 8,000 bytes uncompiled."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": threshold}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        code = plan_of(registry.QUERIES[name](spark, SMALL), "codegen")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(registry.credit_rollup(spark, SMALL))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    columns = {c.split(":")[0] for c in schema.split(",")}
    assert columns == {
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus",
    }
    tree = plan.split("\n\n(1)")[0]
    assert tree.count("HashAggregate") == 2 and tree.count("Exchange") == 1


def test_decline_filter_reaches_the_files(spark, built):
    root, _ = built
    scored = registry.scored_applicants(spark, SMALL)
    stored = tables.write_table(scored, f"{root}/clustered", "scored", ["predicted_pd", ID])
    plan = plan_of(stored.where(F.col("predicted_pd") >= 0.3).select(ID))
    assert "GreaterThanOrEqual(predicted_pd,0.3)" in plan


def test_rank_is_numbered_by_ranges(spark):
    plan = plan_of(registry._declined(spark, SMALL))
    assert "TakeOrdered" not in plan and "SinglePartition" not in plan.split("\n\n(1)")[0]


def test_rows_below_the_top_are_not_shuffled(spark, monkeypatch):
    """The bound of a top-N stands below the exchange, at the scan."""
    monkeypatch.setattr(ordering, "RANGE_ROWS", 100)
    df = spark.range(20_000).select("id", (F.xxhash64("id") % 1000 / 7.0).alias("risk"))
    monkeypatch.setattr(ordering, "numbered", lambda rows, order, name, limit: rows)
    rivals = ordering.top_numbered(df, ["risk", "id"], "n", 500)
    assert 500 <= rivals.count() < 700
    assert "GreaterThanOrEqual(risk," in plan_of(rivals) and "Exchange" not in plan_of(rivals)


def test_running_totals_shuffle_rows_once(spark, monkeypatch):
    """One exchange of the rows, one of a row per range and task, one of a row per range."""
    monkeypatch.setattr(ordering, "RANGE_ROWS", 100)
    df = spark.range(1000).select("id", F.lit(1).alias("one"))
    totals = ordering.running_totals(df, ["id"], {"upto": "one"})
    assert totals.where("upto <> id + 1").isEmpty()
    tree = plan_of(totals).split("\n\n(1)")[0]
    assert "rangepartitioning" not in plan_of(totals)
    assert len(re.findall(r"[:+-] Exchange \(", tree)) <= 3


def test_predictions_are_attributed_once_per_build(spark, built):
    """The build writes what it is given and reads that: a second evaluation would count rows twice."""
    seen = spark.sparkContext.accumulator(0)

    def tally(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    predictions = registry.linear_top_drivers(spark, SMALL)
    build.build_decisions(spark, predictions.mapInPandas(tally, predictions.schema), built[0])
    assert seen.value == 1500


def test_every_published_column_has_a_text():
    assert set(schemas.TABLE_DESCRIPTIONS) == set(schemas.CONTRACTS)
    for name in schemas.CONTRACTS:
        assert list(schemas.DESCRIPTIONS[name]) == schemas.contract(name).names


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES if not n.startswith("boosted")))
def test_no_query_builds_a_product(spark, name):
    plan = plan_of(registry.QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_scoring_stays_out_of_python(spark):
    for name in ("linear_top_drivers", "decline_reasons", "ungrounded_citations", "hash_split", "draft_sql_audit"):
        plan = plan_of(registry.QUERIES[name](spark, SMALL))
        assert not re.search("Python|Pandas|Arrow", plan)


def test_corrections_leave_one_table_behind(spark):
    """the landing and the file-by-file load go once their content is compared."""
    scratch = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = set(scratch.iterdir())
    loaded = registry.payment_feed_corrections(spark, SMALL)
    assert sorted(p.name.split("-")[0] for p in set(scratch.iterdir()) - before) == ["payments", "progress"]
    assert loaded.count() == 6000 and loaded.where("not same_file_by_file").isEmpty()
