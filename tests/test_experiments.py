import pytest

from broadsheet.operators.features import TfidfOptions
from broadsheet.operators.model import FitOptions
from broadsheet.plans import experiments as E
from broadsheet.sources import writers

OPTIONS = FitOptions(max_iter=50, tfidf=TfidfOptions(max_features=500))


@pytest.fixture(scope="module")
def data(spark):
    rows = [
        (i, f"https://h/{'sport' if i % 2 else 'news'}/item-{i}", f"{'goal match' if i % 2 else 'vote senate'} story number {i}", i % 2)
        for i in range(120)
    ]
    return E.experiment_data(spark.createDataFrame(rows, "ord long, url string, headline string, label int"))


@pytest.fixture(scope="module")
def grid(data):
    fits = []
    original = E.fit_model

    def counting(*args, **kwargs):
        fits.append(1)
        return original(*args, **kwargs)

    E.fit_model = counting
    try:
        return E.run_grid(data, options=OPTIONS), fits
    finally:
        E.fit_model = original


def test_sizes(data):
    assert data.sizes == {"train_rows_raw": 96, "test_rows_raw": 24, "test_rows_strict": 24, "stress_rows_raw": 144}
    assert data.train_rows == {"loose": 96, "strict": 96, "stress_loose": 144, "stress_strict": 96}
    record = E.run_metadata(data, "in-memory", seed=42, test_size=0.2, stress_frac=0.5)
    assert record["stress_rows_strict"] == record["train_rows_strict"] == 96 and "run_date_local" in record


def test_grid_has_nine_rows_from_six_fits(grid):
    results, fits = grid
    rows = results.collect()
    assert [r.scenario for r in rows] == [s.name for s in E.SCENARIOS]
    assert len(fits) == 6
    by_name = {r.scenario: r for r in rows}
    assert by_name["url_to_url"].accuracy == by_name["headline_to_headline"].accuracy == 1.0
    assert by_name["stress_data_strict_clean"].accuracy == by_name["real_data_strict_clean"].accuracy
    assert by_name["stress_data_loose_clean"].train_rows == 144
    assert all(r.test_rows == 24 and r.avg_infer_ms > 0 for r in rows)


def test_report_order_and_deltas(spark, grid, tmp_path):
    results, _ = grid
    report = E.ordered_report(results, ["url_to_url", "missing", "url_to_headline"]).collect()
    assert [(r.position, r.scenario, r.accuracy is None) for r in report] == [
        (0, "url_to_url", False), (1, "missing", True), (2, "url_to_headline", False),
    ]
    deltas = {r.delta: r for r in E.scenario_deltas(results).collect()}
    assert set(deltas) == {d for d, _, _ in E.DELTAS}
    assert deltas["url_shortcut"].change == pytest.approx(deltas["url_shortcut"].after - 1.0)
    path = str(tmp_path / "results")
    writers.write_results(results, path)
    assert spark.read.csv(path, header=True).count() == 9


def test_published_baseline_margin(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("full", 0.9334735734946095), ("low", 0.5)], "setting string, accuracy double")
    got = {r.setting: r for r in E.baseline_margin(rows, F.lit(0.6649)).collect()}
    assert got["full"].margin == pytest.approx(0.2685735734946094) and got["full"].beats_baseline
    assert not got["low"].beats_baseline
