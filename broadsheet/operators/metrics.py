"""Classification metrics. One pass folds predictions into confusion counts; every
number below comes from those few rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("rows"))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", by: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(
        *by, F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def _ratio(part: Column, whole: Column) -> Column:
    """Zero when undefined."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def per_class(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class seen in labels or predictions."""
    hit = F.col("label") == F.col("prediction")
    sides = F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("truth"), F.lit(0).cast("bigint").alias("called"),
                 F.when(hit, F.col("n")).otherwise(F.lit(0).cast("bigint")).alias("right")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("bigint").alias("truth"), F.col("n").alias("called"),
                 F.lit(0).cast("bigint").alias("right")),
    )
    folded = (
        counts.select(*by, F.explode(sides).alias("side"))
        .groupBy(*by, F.col("side.cls").alias("class"))
        .agg(F.sum("side.truth").alias("support"), F.sum("side.called").alias("called"), F.sum("side.right").alias("right"))
    )
    return folded.select(
        *by,
        "class",
        _ratio(F.col("right"), F.col("called")).alias("precision"),
        _ratio(F.col("right"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("right"), F.col("called") + F.col("support")).alias("f1"),
        "support",
        "right",
    )


def summary(df: DataFrame, label: str = "label", prediction: str = "prediction", by: tuple[str, ...] = ()) -> DataFrame:
    """Accuracy, macro F1, weighted F1 and row count, per group or overall."""
    classes = per_class(confusion(df, label, prediction, by), by)
    return classes.groupBy(*by).agg(
        (F.sum("right") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
        F.sum("support").alias("rows"),
    )


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows: every class, ``accuracy``, ``macro avg``, ``weighted avg``."""
    classes = per_class(confusion(df, label, prediction))
    measures = ("precision", "recall", "f1")
    support = F.sum("support")
    totals = classes.agg(
        support.alias("support"),
        (F.sum("right") / support).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[(F.sum(F.col(m) * F.col("support")) / support).alias(f"weighted_{m}") for m in measures],
    )

    def line(position: int, name: str, p: Column, r: Column, f1: Column) -> Column:
        return F.struct(
            F.lit(position).alias("position"), F.lit(name).alias("class"), p.alias("precision"),
            r.alias("recall"), f1.alias("f1"), F.col("support").alias("support"),
        )

    nothing = F.lit(None).cast("double")
    lines = F.array(
        line(1, "accuracy", nothing, nothing, F.col("accuracy")),
        line(2, "macro avg", *[F.col(f"macro_{m}") for m in measures]),
        line(3, "weighted avg", *[F.col(f"weighted_{m}") for m in measures]),
    )
    per = classes.select(F.lit(0).alias("position"), F.col("class").cast("string").alias("class"), *measures, "support")
    return per.unionByName(totals.select(F.inline(lines)))


def format_report(report: DataFrame, digits: int = 4) -> str:
    """The report as aligned text, a row per class and three summary rows."""
    rows = sorted(report.collect(), key=lambda r: (r["position"], r["class"]))
    width = max(len("weighted avg"), *(len(r["class"]) for r in rows))

    def cell(value) -> str:
        return f"{'' if value is None else format(value, f'.{digits}f'):>10}"

    out = [f"{'':>{width}} {'precision':>10}{'recall':>10}{'f1-score':>10}{'support':>10}", ""]
    for previous, r in zip([None, *rows], rows):
        if previous is not None and previous["position"] == 0 and r["position"] == 1:
            out.append("")
        cells = "".join(cell(r[m]) for m in ("precision", "recall", "f1"))
        out.append(f"{r['class']:>{width}} {cells}{r['support']:>10}")
    return "\n".join(out)


def aligned_accuracy(df: DataFrame, prediction: str = "prediction", target: str = "target") -> DataFrame:
    """Accuracy when predictions are class ids and targets may be names, or the reverse.

    Equal types compare directly. Ids against exactly two names take the better of
    the two possible codings. Anything else compares as strings. No rows give 0.
    """
    kinds = {c: df.schema[c].dataType.typeName() for c in (prediction, target)}
    integral = {c: k in ("byte", "short", "integer", "long") for c, k in kinds.items()}
    text = lambda c: F.col(c).cast("string")
    counted = df.groupBy(text(prediction).alias("p"), text(target).alias("t")).agg(F.count(F.lit(1)).alias("n"))
    equal = F.sum(F.when(F.col("p") == F.col("t"), F.col("n")).otherwise(F.lit(0)))
    rows = F.sum("n")
    if integral[prediction] == integral[target]:
        return counted.agg(F.coalesce(equal / rows, F.lit(0.0)).alias("accuracy"))
    ids, names = ("p", "t") if integral[prediction] else ("t", "p")
    per_name = counted.groupBy(names).agg(
        rows.alias("n"),
        equal.alias("equal"),
        F.sum(F.when(F.col(ids) == "0", F.col("n")).otherwise(F.lit(0))).alias("zero"),
        F.sum(F.when(F.col(ids) == "1", F.col("n")).otherwise(F.lit(0))).alias("one"),
    )
    low, high = lambda c: F.min_by(c, names), lambda c: F.max_by(c, names)
    best = F.greatest(low("zero") + high("one"), low("one") + high("zero"))
    right = F.when(F.count(F.lit(1)) == 2, best).otherwise(F.sum("equal"))
    return per_name.agg(F.coalesce(right / F.sum("n"), F.lit(0.0)).alias("accuracy"))
