"""Language identification with more labels than the sample has room for in full."""

from pyspark.sql import functions as F

from loomsift.llm import language


def _rows(spark, labels, each):
    letters = F.translate(F.format_string("%03d", (F.col("id") % labels).cast("int")), "0123456789", "abcdefghij")
    word = F.concat(F.substring(letters, 1, 1), letters, F.reverse(letters))
    text = F.concat_ws(" ", word, F.repeat(F.concat(word, F.lit(" ")), 3), (F.col("id") / labels).cast("int").cast("string"))
    return spark.range(labels * each).select("id", text.alias("text"), letters.alias("lang"))


def test_more_than_256_labels_are_learned(spark):
    rows = _rows(spark, 300, 5)
    model = language.fit(rows, "id")
    assert len(model.labels) == 300 and model.scores.shape == (1 << 16, 16)
    found = language.predict(rows, model).collect()
    assert len(found) == 1500
    assert sum(r.lang == r.lang_pred for r in found) >= 0.9 * 1500


def test_the_sample_shrinks_but_leaves_no_label_out(spark):
    numbers = spark.range(40).select((F.col("id") + 10_000).alias("id"), F.lit("1 2").alias("text"), F.lit("aaa").alias("lang"))
    settings = language.Settings(sample=100, per_label=20, folded=4, cells=50)
    model = language.fit(_rows(spark, 60, 30).union(numbers), "id", settings=settings)
    assert len(model.labels) == 60


def test_layers_apart_score_as_folded_ones(spark):
    rows = _rows(spark, 7, 30)
    one, two = (language.fit(rows, "id", settings=language.Settings(folded=n, cells=c)) for n, c in ((256, 1 << 22), (4, 20)))
    assert one.layer is None and two.layer is not None and one.temperature == two.temperature
    a, b = ({r.id: r for r in language.predict(rows, m).collect()} for m in (one, two))
    assert all(a[i].lang_pred == b[i].lang_pred and abs(a[i].score - b[i].score) < 1e-4 for i in a)
