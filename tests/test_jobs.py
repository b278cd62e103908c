"""Both jobs from delimited files to reports and models."""

from pyspark.sql import functions as F

from millrace.operators.integrity import duplicate_keys
from millrace.operators.metrics import BOOSTED, FOREST
from millrace.plans import jobs
from millrace.plans.scoring_batch import literal_batch
from millrace.plans.stand_ins import ACCENTED_COUNTRY, order_extract, telemetry_extract
from millrace.plans.warehouse import Warehouse
from millrace.sources.delimited import LATIN_1, write_delimited

FOLDER = "/root/testdata/sf0.001"


def test_orders_job(spark, tmp_path):
    source, output = str(tmp_path / "orders"), str(tmp_path / "out")
    extract = order_extract(Warehouse(spark, FOLDER).table)
    write_delimited(extract, source, LATIN_1)
    star = jobs.load_orders(spark, source, output, ACCENTED_COUNTRY)
    kept = extract.filter(F.col("`Order Country`") == ACCENTED_COUNTRY).count()
    steps = {r.step: r.rows for r in spark.read.json(f"{output}/row_counts").collect()}
    assert steps["extract"] == extract.count() and steps["country"] == steps["cleaned"] == kept
    assert spark.read.csv(f"{output}/fact_orders", header=True).count() == steps["fact_orders"]
    assert steps["fact_orders"] == star.orders.count() and steps["dim_customers"] == star.customers.count()
    assert spark.read.json(f"{output}/reject_counts").isEmpty()
    checks = {(r.check, r.table, r.key): (r["keys"], r["rows"]) for r in spark.read.json(f"{output}/key_checks").collect()}
    twice = duplicate_keys(star.orders, ["order_id", "order_item_id"])
    assert checks.pop(("duplicate", "fact_orders", "order_id, order_item_id")) == (
        twice.count(), twice.agg(F.sum("rows")).first()[0])
    assert len(checks) == 6 and set(checks.values()) == {(0, 0)}
    jobs.report_orders(star, output)
    assert spark.read.csv(f"{output}/state_rollup", header=True).count() > 0
    champion = jobs.train_orders(
        star, output, "temporal", "indexed", {"maxIter": [3], "maxDepth": [3]}, {"numTrees": [3], "maxDepth": [3]}, 2)
    assert champion.first().winner in (BOOSTED, FOREST)
    assert {r.model for r in spark.read.json(f"{output}/metrics").collect()} == {BOOSTED, FOREST}


def test_machines_job(spark, tmp_path):
    source, output = str(tmp_path / "machines"), str(tmp_path / "out")
    write_delimited(telemetry_extract(spark.read.parquet(f"{FOLDER}/events.parquet")).drop("ts"), source)
    raw = jobs.read_telemetry(spark, source, output)
    assert dict(raw.dtypes) == jobs.TELEMETRY_TYPES
    cleaned = jobs.clean_machines(raw, output)
    grid = {"maxIter": [5], "maxDepth": [4], "stepSize": [0.3]}
    assert jobs.train_machines(cleaned, output, grid, 2).count() == 3
    report = {r["class"]: r for r in spark.read.json(f"{output}/classification_report").collect()}
    assert report["0.0"].support + report["1.0"].support == -(-cleaned.count() // 5)
    assert sum(r.n for r in spark.read.json(f"{output}/confusion_matrix").collect()) == -(-cleaned.count() // 5)
    counts = {r.labels: r for r in jobs.validate_machines(raw, output, grid, 2).collect()}
    total = sum(counts["model"][c] for c in ("true_p", "true_n", "false_p", "false_n"))
    assert total == spark.read.csv(f"{output}/vault_results", header=True).count()
    parts = [spark.read.csv(f"{output}/{name}", header=True).count() for name in ("history", "vault")]
    assert parts == [raw.count() - total, total]
    assert counts["revised"].true_p >= counts["model"].true_p
    from pyspark.ml.classification import GBTClassificationModel
    from millrace.operators.models import load_model
    model = load_model(f"{output}/failure_model", GBTClassificationModel)
    queue = jobs.score_file(model, literal_batch(spark), output)
    assert spark.read.csv(f"{output}/results", header=True).count() == 20 and queue.count() <= 20


def test_bad_lines_and_keys_are_reported(spark, tmp_path):
    source, output = str(tmp_path / "orders"), str(tmp_path / "out")
    extract = order_extract(Warehouse(spark, FOLDER).table).limit(300)
    write_delimited(extract.coalesce(1), source, LATIN_1)
    (part,) = (tmp_path / "orders").glob("part-*.csv")
    lines = part.read_text("latin-1").splitlines()
    header = lines[0].split(",")
    at = header.index("Product Price")
    price = [h.strip('"') for h in header].index("Product Price") if at < 0 else at
    for crc in (tmp_path / "orders").glob(".*.crc"):
        crc.unlink()
    cells = lines[1].split(",")
    cells[price] = "abc"
    part.write_text("\n".join([lines[0], ",".join(cells), *lines[2:], "1,2,3"]) + "\n", "latin-1")
    jobs.load_orders(spark, source, output)
    counts = {(r.column, r.cause): r.n for r in spark.read.json(f"{output}/reject_counts").collect()}
    assert counts == {("Product Price", "no double"): 1, ("", "fields"): 1}
    steps = {r.step: r.rows for r in spark.read.json(f"{output}/row_counts").collect()}
    assert steps["extract"] == 301 and steps["cleaned"] == 300


def test_lineage_costs_no_job_of_its_own(spark):
    from millrace.operators.lineage import Lineage
    from millrace.sources.staging import stage

    lineage = Lineage()
    rows = lineage.watch("all", spark.range(100).withColumn("x", F.when(F.col("id") % 10 == 0, F.col("id"))), nulls=True)
    spark.sparkContext.setJobGroup("lineage", "")
    stored = stage(lineage.watch("even", rows.where("id % 2 = 0")), "even")
    assert [tuple(r) for r in lineage.table(spark).collect()] == [("all", 100, 2), ("even", 50, 2)]
    assert {r.column_name: r.null_count for r in lineage.nulls(spark).collect()} == {"id": 0, "x": 90}
    assert lineage.mostly_null("all") == ["x"] and stored.count() == 50
