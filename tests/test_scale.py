"""Plans and files at scale: skew, staged folders, values that must not be lost."""

import math

import pytest
from pyspark.sql import functions as F

from carebasin.functions import columns as fx
from carebasin.operators import clinical
from carebasin.operators.quantile import exact_quantile
from carebasin.plans import clinical as clinical_plan
from carebasin.session import work_root
from carebasin.sources.readers import read_bundles
from carebasin.sources.writers import matching_folders, stage, stages_removed, well_dealt
from checks.measure import shuffled


@pytest.fixture
def skewed(spark):
    """No broadcast, and small bounds for a skewed partition."""
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_code_is_split_and_missing_codes_are_spread(skewed):
    rows = skewed.range(60_000, numPartitions=8).select(
        "id", F.when(F.col("id") % 10 < 8, F.lit("hot")).when(F.col("id") % 10 == 8, F.col("id").cast("string")).alias("code"),
        F.sha2(F.col("id").cast("string"), 256).alias("filler"),
    )
    lookup = skewed.createDataFrame([("hot", "Hot"), ("8", "Eight"), ("hot", "Hot"), (None, "None")], "key string, label string")
    joined = clinical.enrich(rows, "code", lookup, "key", {"label": "label"})
    joined.write.format("noop").mode("overwrite").save()
    counted = joined.groupBy("label").count().collect()
    assert {r.label: r["count"] for r in counted} == {"Hot": 48_000, "Eight": 1, None: 11_999}
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.columns == ["id", "code", "filler", "label"]


def test_staged_folders_go_after_success_and_stay_after_failure(spark):
    folders = lambda: len(matching_folders(spark, f"{work_root(spark)}/carebasin/scale-test-*"))
    with stages_removed(spark):
        assert stage(spark.range(5).toDF("n"), "scale-test").count() == 5
        assert folders() == 1
    assert folders() == 0
    with pytest.raises(ValueError), stages_removed(spark):
        stage(spark.range(5).toDF("n"), "scale-test")
        raise ValueError
    assert folders() == 1


def test_files_of_staged_resources_do_not_follow_the_tasks(spark):
    kinds = F.array(*[F.lit(f'{{"resourceType":"{k}","id":"1"}}') for k in ("Patient", "Encounter", "Condition")])
    bundles = lambda tasks: spark.range(200, numPartitions=tasks).select(
        F.col("id").cast("string").alias("id"), F.lit("2024-01-01T00:00:00Z").alias("timestamp"),
        F.transform(kinds, lambda x: F.struct(x.alias("resource"))).alias("entry"),
    )
    for tasks in (2, 40):
        staged = clinical_plan.stage_resources(bundles(tasks))
        assert staged.count() == 600
        assert len(staged.inputFiles()) <= 12


def test_no_double_is_left_out_of_sums(spark):
    rows = spark.createDataFrame(
        [("a", 0.1), ("a", 0.2), ("a", None), ("b", 1e18), ("b", 2.5), ("c", float("nan")), ("c", 1.0), ("d", 4e-7), ("d", 4e-7),
         ("e", float("inf")), ("f", None), ("g", 1e-25), ("g", 1.0), ("h", -0.005)],
        "k string, v double",
    )
    got = {
        r.k: (r.total, r.mean)
        for r in rows.groupBy("k").agg(fx.double_total(F.col("v"), 7).alias("total"), fx.double_mean(F.col("v"), 7).alias("mean")).collect()
    }
    assert got["a"] == (0.3, 0.15) and got["d"] == (8e-7, 4e-7) and got["f"] == (None, None)
    assert got["b"] == (1e18 + 2.5, 5e17 + 1.25) and got["g"] == (1.0, 0.5) and got["h"] == (-0.005, -0.005)
    assert math.isnan(got["c"][0]) and math.isnan(got["c"][1]) and got["e"] == (math.inf, math.inf)


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_quantiles_reach_both_ends_of_bigint(spark, fraction):
    values = sorted([-(2**63), -(2**63) + 1, -1, 0, 1, 10**18, 2**63 - 2, 2**63 - 1])
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    place = max(1, math.ceil(fraction * len(values)))
    assert exact_quantile(frame, "v", fraction).first()[0] == values[place - 1]


def test_well_dealt_bundles_are_staged_without_a_shuffle(spark, tmp_path):
    # files of more than a MB each: their tasks write the resources where they are
    filler = F.sha2(F.col("id").cast("string"), 512)
    resource = lambda kind: F.concat(F.lit(f'{{"resource":{{"resourceType":"{kind}","id":"'), "id", F.lit('","note":"'), filler, F.lit('"}}'))
    text = spark.range(0, 32_000, 1, 8).select(F.concat(
        F.lit('{"resourceType":"Bundle","id":"'), "id", F.lit('","timestamp":"2024-01-01T00:00:00Z","entry":['),
        resource("Patient"), F.lit(","), resource("Encounter"), F.lit("]}"),
    ))
    text.write.text(str(tmp_path / "large"))
    text.limit(20).repartition(8).write.text(str(tmp_path / "small"))
    large, small = (read_bundles(spark, str(tmp_path / n), one_per_line=True) for n in ("large", "small"))
    assert well_dealt(large) and not well_dealt(small) and not well_dealt(large.repartition(1))
    before = set(shuffled(spark))
    staged = clinical_plan.stage_resources(large)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    assert sum(n for stage_, n in shuffled(spark).items() if stage_ not in before) == 0
    assert staged.count() == 64_000
    assert staged.select("resource").distinct().count() == 64_000
    assert all(".zstd." in f for f in staged.inputFiles())


def test_landed_files_are_compressed_and_bounded(spark, monkeypatch, tmp_path):
    from checks import standins, tables

    monkeypatch.setattr(tables, "RECORDS_PER_FILE", 40)
    monkeypatch.setattr(tables, "BUNDLES_PER_FILE", 30)
    folder = str(tmp_path / "sf")
    sf = "/root/testdata/sf0.001"
    for name, n in (("events", 100), ("supplier", 10)):
        standins.given(spark, sf, name).limit(n).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    bundles = read_bundles(spark, tables.landed_bundles(spark, folder), one_per_line=True)
    assert len(bundles.inputFiles()) == 4 and all(f.endswith(".gz") for f in bundles.inputFiles())
    assert bundles.select("id").distinct().count() == 100
    providers = tables.raw(spark, folder, "providers")
    assert all(f.endswith(".gz") for f in providers.inputFiles()) and providers.count() == 12
