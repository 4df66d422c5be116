import datetime as dt

import pytest
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from demandtide import session
from demandtide.operators import features as ft
from demandtide.operators import lagmodels
from demandtide.plans import end_to_end
from demandtide.plans.queries import by_type, overall
from demandtide.session import scratch_dir
from demandtide.sources import tables as tb
from demandtide.streaming.hourly import closed_hours, run_once
from tests.conftest import SF, season


def test_absent_months_and_columns(spark, tmp_path):
    a = spark.createDataFrame([(1, "x")], "id long, a string")
    a.write.parquet(f"{tmp_path}/trips_2023-01.parquet")
    a.drop("a").write.parquet(f"{tmp_path}/trips_2023-03.parquet")
    template = f"{tmp_path}/trips_{{year}}-{{month:02d}}.parquet"
    got = tb.read_months(spark, template, tb.month_range((2022, 11), (2023, 3)), a.schema)
    assert {(r.id, r.a) for r in got.collect()} == {(1, None), (1, "x")} and got.count() == 2
    nothing = tb.read_months(spark, template, [(1999, 1)], a.schema)
    assert nothing.count() == 0 and nothing.schema == a.schema
    elsewhere = tb.read_months(spark, f"{tmp_path}/none/{{year}}-{{month}}", [(1999, 1)], a.schema)
    assert elsewhere.count() == 0


def test_month_range():
    assert tb.month_range((2022, 11), (2023, 2)) == [(2022, 11), (2022, 12), (2023, 1), (2023, 2)]


def test_ingest_adds_only_new_months(spark, tmp_path):
    target = str(tmp_path / "t")
    first = spark.createDataFrame([(1, dt.datetime(2023, 1, 5))], "id long, ts timestamp_ntz")
    second = spark.createDataFrame([(9, dt.datetime(2023, 1, 6)), (2, dt.datetime(2023, 2, 1))], "id long, ts timestamp_ntz")
    tb.ingest_months(first, target, "ts")
    tb.ingest_months(second, target, "ts")
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2]
    tb.write_months(second.where("id = 9"), target, "ts")
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [2, 9]


def test_an_application_clears_its_own_scratch_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_shared", lambda _: str(tmp_path))
    (tmp_path / "demandtide-other").mkdir()
    path = scratch_dir(spark, "mine")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    session.clear_scratch(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["demandtide-other"]
    session.clear_scratch(spark)


def test_a_failed_ingest_is_made_good(spark, tmp_path, monkeypatch):
    """Months half written by a run that failed, before or after their files came, are written again as a whole."""
    target = str(tmp_path / "t")
    rows = [(i, dt.datetime(2023, 1 + i % 3, 1 + i % 25)) for i in range(90)]
    log = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
    tb.ingest_months(log.where("month(ts) = 1"), target, "ts")

    def fails(months, where):
        entries(months, where)
        # The files of February come in part, then the run ends.
        half = log.where("month(ts) = 2 AND id < 45").select("*", *tb.months_of("ts"))
        half.write.mode("append").partitionBy("year", "month").parquet(where)
        raise RuntimeError("lost")

    entries = tb._note
    monkeypatch.setattr(tb, "_note", fails)
    with pytest.raises(RuntimeError):
        tb.ingest_months(log, target, "ts")
    monkeypatch.setattr(tb, "_note", entries)
    assert {(r.month, r.rows) for r in tb.complete_months(spark, target).collect()} == {(1, 30)}
    schema = log.select("*", *tb.months_of("ts")).schema
    assert tb.read_complete_months(spark, target, schema).count() == 30
    tb.ingest_months(log, target, "ts")
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(90))
    assert {(r.month, r.rows) for r in tb.complete_months(spark, target).collect()} == {(1, 30), (2, 30), (3, 30)}
    tb.ingest_months(log, target, "ts")
    assert tb.read_complete_months(spark, target, schema).count() == 90


def test_series_csv(spark, tmp_path):
    s = overall(spark, SF).select(F.col("ts").alias("timestamp"), F.col("y").cast("bigint").alias("trip_count"))
    tb.write_csv(s, str(tmp_path / "s"))
    assert sorted(tb.read_series_csv(spark, str(tmp_path / "s")).collect()) == sorted(s.collect())
    spark.createDataFrame([("05/01/2024 07h", 3)], "timestamp string, trip_count long").write.option("header", True).csv(str(tmp_path / "f"))
    got = tb.read_series_csv(spark, str(tmp_path / "f"), timestamp_format="dd/MM/yyyy HH'h'").collect()
    assert got[0].timestamp == dt.datetime(2024, 1, 5, 7)


def test_processed_and_norm_params(spark, tmp_path):
    s = ft.with_split(by_type(spark, SF))
    tb.write_processed(s, str(tmp_path / "p"))
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.where("split = 'train'").count() == s.where("split = 'train'").count()
    params = ft.norm_params(s, ["event_type"])
    tb.write_norm_params(params, str(tmp_path / "n"))
    read = tb.read_norm_params(spark, str(tmp_path / "n"), ["event_type"])
    assert sorted(read.collect()) == sorted(params.select(*read.columns).collect())


def test_model_is_kept_with_its_history(spark, make_series, tmp_path):
    s = make_series(season(200)).drop("cut")
    frame, _ = lagmodels.lag_frame(s)
    model = lagmodels.learner("lr").fit(frame)
    history = spark.createDataFrame([("lr", "train", 0, 1.0)], "model string, split string, iteration int, loss double")
    lagmodels.save_model(model, str(tmp_path / "m"), history)
    lagmodels.save_model(model, str(tmp_path / "m"), history)
    assert LinearRegressionModel.load(str(tmp_path / "m/model")).coefficients == model.coefficients
    assert spark.read.parquet(str(tmp_path / "m/history")).count() == 1


class _Session:
    """The two things ``scratch_dir`` looks at."""

    def __init__(self, master, folder):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: {"spark.checkpoint.dir": folder}.get(key) or default)})


def test_scratch_folder_follows_the_cluster():
    a, b = (scratch_dir(_Session("spark://x", "hdfs://shared/tmp"), "x") for _ in range(2))
    assert a.startswith("hdfs://shared/tmp/demandtide-app/x-") and a != b
    with pytest.raises(RuntimeError):
        scratch_dir(_Session("spark://x", None), "x")
    assert scratch_dir(_Session("local[2]", None), "x")


def test_stream_counts_each_closed_hour_once(spark, tmp_path):
    schema = "ts timestamp_ntz, k string"
    day = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)

    def arrive(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{name}")

    def take():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
        return sorted(tuple(r) for r in run_once(closed_hours(stream, keys=["k"], delay="30 minutes"), f"{tmp_path}/out").collect())

    arrive("a", [(day(1, 5), "a"), (day(1, 50), "a"), (day(2, 10), "b"), (day(3, 31), "a")])
    closed = [("a", day(1), 2), ("b", day(2), 1)]
    assert take() == closed
    # An hour that has been given out takes in no more; an open one does.
    arrive("b", [(day(1, 30), "a"), (day(3, 40), "a"), (day(5), "a")])
    assert take() == sorted(closed + [("a", day(3), 2)])
    assert take() == sorted(closed + [("a", day(3), 2)])


def test_stream_hours_do_not_depend_on_the_zone(spark, tmp_path):
    """02:30 does not exist on this day in Berlin."""
    rows = [(dt.datetime(2024, 3, 31, h, 30),) for h in (1, 2, 3, 6)]
    spark.createDataFrame(rows, "ts timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp_ntz").parquet(f"{tmp_path}/in")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        got = run_once(closed_hours(stream, delay="30 minutes"), f"{tmp_path}/out").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted((r.ts.hour, r.trip_count) for r in got) == [(1, 1), (2, 1), (3, 1)]


def test_end_to_end(spark, tmp_path):
    out = str(tmp_path / "run")
    got = end_to_end.run(tb.table(spark, SF, "events"), out)
    metrics = {r.model: r for r in got["metrics"].collect()}
    assert set(metrics) == set(end_to_end.MODELS) and all(0 < r.RMSE < 2 for r in metrics.values())
    found = {r.method: (r.n, r.n_anom) for r in got["anomalies"].collect()}
    assert set(found) == set(end_to_end.DETECTORS) and all(n == 697 and 30 <= a <= 35 for n, a in found.values())
    wide = spark.read.parquet(f"{out}/scores_wide")
    assert wide.count() == 720 and "anomaly_score_patterns" in wide.columns
    assert spark.read.parquet(f"{out}/predictions").where("model = 'lag_linear'").count() == 120
    assert spark.read.parquet(f"{out}/ranking").count() == 7 * 4
