import pytest

from broadsheet.operators import metrics as M


def expand(counts):
    return [(t, p) for (t, p), n in counts.items() for _ in range(n)]


def test_published_report(spark):
    df = spark.createDataFrame(expand({(0, 0): 334, (0, 1): 66, (1, 0): 86, (1, 1): 275}), "label int, prediction int")
    report = {r["class"]: r for r in M.classification_report(df).collect()}
    rounded = lambda r: tuple(None if r[m] is None else round(r[m], 4) for m in ("precision", "recall", "f1")) + (r["support"],)
    assert rounded(report["0"]) == (0.7952, 0.8350, 0.8146, 400)
    assert rounded(report["1"]) == (0.8065, 0.7618, 0.7835, 361)
    assert rounded(report["accuracy"]) == (None, None, 0.8003, 761)
    assert rounded(report["macro avg"]) == (0.8008, 0.7984, 0.7991, 761)
    assert rounded(report["weighted avg"]) == (0.8006, 0.8003, 0.7999, 761)
    summary = M.summary(df).first()
    assert [round(summary[c], 6) for c in ("accuracy", "macro_f1")] == [0.800263, 0.799055]
    assert round(M.accuracy(df).first()["accuracy"], 6) == 0.800263
    text = M.format_report(M.classification_report(df)).splitlines()
    assert text[0].split() == ["precision", "recall", "f1-score", "support"]
    assert text[2].split() == ["0", "0.7952", "0.8350", "0.8146", "400"]
    assert text[-1].split() == ["weighted", "avg", "0.8006", "0.8003", "0.7999", "761"]


def test_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 0)], "label int, prediction int")
    report = {r["class"]: r for r in M.classification_report(df).collect()}
    assert (report["1"]["precision"], report["1"]["recall"], report["1"]["f1"]) == (0, 0, 0)


@pytest.mark.parametrize("rows, schema, expected", [
    ([(0, "B"), (0, "B"), (1, "A"), (1, "A")], "prediction int, target string", 1.0),
    ([(0, "A"), (0, "B"), (1, "A"), (1, "B")], "prediction int, target string", 0.5),
    ([(0, "A"), (1, "B"), (1, "C")], "prediction int, target string", 0.0),
    ([(0, "0"), (1, "1"), (1, "2")], "prediction int, target string", 2 / 3),
    ([("x", 1), ("y", 0), ("y", 1)], "prediction string, target int", 2 / 3),
    ([("a", "a"), ("b", "a")], "prediction string, target string", 0.5),
    ([(1, 1), (0, 1)], "prediction int, target long", 0.5),
    ([(1, "A")], "prediction int, target string", 0.0),
    ([], "prediction int, target string", 0.0),
])
def test_aligned_accuracy(spark, rows, schema, expected):
    got = M.aligned_accuracy(spark.createDataFrame(rows, schema)).first()["accuracy"]
    assert got == pytest.approx(expected)
