"""§2.9 SQL-ML and text queries.

Stand-ins: the bike-hire regression becomes ``events.value`` explained by
event type (station), day of week and hour; text classification trains on
``labels.quality`` and scores every document.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.functions import dialect
from tickframe.operators import ml
from tickframe.plans.registry import register
from tickframe.sources.tables import table

T = table


def _trips(spark, d):
    e = T(spark, d, "events")
    return e.select(F.col("value").alias("duration"), F.col("event_type").alias("start_station_name"),
                    F.col("ts").alias("start_date"), F.col("event_id").alias("trip_id"))


def _features(trips):
    return trips.select(
        "duration", "start_station_name",
        F.dayofweek("start_date").cast("string").alias("dayofweek"),
        F.hour("start_date").cast("string").alias("hourofday"),
        F.when(F.dayofweek("start_date").between(2, 6), "weekday").otherwise("weekend").alias("daytype"),
        dialect.bucketize(F.hour("start_date"), [5, 10, 17]).alias("hourbin"))


@register("ml.features", """
SELECT value AS duration, event_type AS start_station_name, CAST(dayofweek(ts) + 1 AS VARCHAR) AS dayofweek,
       CAST(hour(ts) AS VARCHAR) AS hourofday,
       IF(dayofweek(ts) + 1 BETWEEN 2 AND 6, 'weekday', 'weekend') AS daytype,
       CASE WHEN hour(ts) < 5 THEN 'bin_1' WHEN hour(ts) < 10 THEN 'bin_2' WHEN hour(ts) < 17 THEN 'bin_3'
            ELSE 'bin_4' END AS hourbin
FROM events""")
def ml_features(spark, d):
    return _features(_trips(spark, d))


#: Rows held out for evaluation: one in five by a hash of the trip's id.
HELD_OUT = 5


def _held(id_col):
    return F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 4), 16, 10).cast("long") % HELD_OUT == 0


def _split(rows, id_col="trip_id"):
    return rows.filter(~_held(id_col)), rows.filter(_held(id_col))


def _linreg_sql(name, day, hour, cycles=10):
    """Least squares on three factors by refitting one at a time until nothing moves; cells are
    their combinations, so the rows are read twice however many cycles there are."""
    steps, last = [], "f0"
    for k in range(3 * cycles):
        by = ("st", "dy", "hr")[k % 3]
        steps.append(f"f{k + 1} AS (SELECT st, dy, hr, n, s, f + coalesce(sum(s - n * f) OVER (PARTITION BY {by}) / nullif(sum(n) OVER (PARTITION BY {by}), 0), 0)"
                     f" AS f FROM {last})")
        last = f"f{k + 1}"
    return f"""
WITH e AS (
  SELECT value AS y, event_type AS st, {day} AS dy, {hour} AS hr, ('0x' || substr(md5(event_id::VARCHAR), 1, 4))::BIGINT % {HELD_OUT} = 0 AS held
  FROM events),
f0 AS MATERIALIZED (
  SELECT st, dy, hr, count(*) FILTER (WHERE NOT held) AS n, coalesce(sum(y) FILTER (WHERE NOT held), 0) AS s, 0.0::DOUBLE AS f FROM e GROUP BY 1, 2, 3),
{", ".join(steps)},
t AS (SELECT y, y - f AS r FROM e JOIN {last} USING (st, dy, hr) WHERE held)
SELECT '{name}' AS model, round(sqrt(avg(r * r)), 6) AS rmse, round(avg(abs(r)), 6) AS mae, round(1 - sum(r * r) / (var_pop(y) * count(*)), 6) AS r2,
       (SELECT count(DISTINCT st) + count(DISTINCT dy) + count(DISTINCT hr) - 3 FROM e WHERE NOT held) AS n_coefficients,
       (SELECT count(*) FROM e WHERE NOT held) AS n_train, count(*) AS n_test
FROM t"""


def _evaluated(model, train, test, name):
    out = ml.evaluate_regression(model, train, test, name)
    return out.withColumns({c: F.round(c, 6) for c in ("rmse", "mae", "r2")})


SQL_DAYTYPE = "IF(dayofweek(ts) + 1 BETWEEN 2 AND 6, 'weekday', 'weekend')"


@register("ml.linreg_cat", _linreg_sql("model", "dayofweek(ts)", "hour(ts)"))
def ml_linreg_cat(spark, d):
    """duration ~ station + day of week + hour, all categorical; scored on held-out trips."""
    train, test = map(_features, _split(_trips(spark, d)))
    m = ml.linreg(train, "duration", ["start_station_name", "dayofweek", "hourofday"])
    return _evaluated(m, train, test, "model")


@register("ml.linreg_weekday", _linreg_sql("model_weekday", SQL_DAYTYPE, "hour(ts)"))
def ml_linreg_weekday(spark, d):
    """duration ~ station + weekday/weekend + hour."""
    train, test = map(_features, _split(_trips(spark, d)))
    m = ml.linreg(train, "duration", ["start_station_name", "daytype", "hourofday"])
    return _evaluated(m, train, test, "model_weekday")


BUCKET_TRANSFORM = """
SELECT duration, start_station_name,
       IF(dayofweek(start_date) BETWEEN 2 AND 6, 'weekday', 'weekend') AS dayofweek,
       CASE WHEN hour(start_date) < 5 THEN 'bin_1' WHEN hour(start_date) < 10 THEN 'bin_2'
            WHEN hour(start_date) < 17 THEN 'bin_3' ELSE 'bin_4' END AS hourofday
FROM __THIS__"""


@register("ml.linreg_bucket", _linreg_sql(
    "model_bucketized", SQL_DAYTYPE, "CASE WHEN hour(ts) < 5 THEN 1 WHEN hour(ts) < 10 THEN 2 WHEN hour(ts) < 17 THEN 3 ELSE 4 END"))
def ml_linreg_bucket(spark, d):
    """The transform lives inside the model: fitting and scoring take the raw columns."""
    train, test = _split(_trips(spark, d))
    m = ml.linreg(train, "duration", ["start_station_name", "dayofweek", "hourofday"], BUCKET_TRANSFORM)
    return _evaluated(m, train, test, "model_bucketized")


CATEGORIES = ["poor", "good"]


def _classified(spark, d):
    """Every document with a token, scored by a classifier that saw no held-out document's label."""
    docs, lab = T(spark, d, "documents"), T(spark, d, "labels")
    train, _ = _split(docs.join(lab, "doc_id").select("doc_id", "text", F.col("quality").cast("double").alias("label")), "doc_id")
    model = ml.text_classifier(train.select("text", "label"), "text", "label")
    return ml.classify(model, docs.select("doc_id", "text"), "text", CATEGORIES)


@register("ml.text_classify", """
SELECT doc_id, text, true AS category_known, true AS confidence_in_range FROM documents WHERE regexp_matches(text, '[A-Za-z0-9_]')""")
def ml_text_classify(spark, d):
    """Each document with text gets one of the categories, with a confidence between even odds and 1."""
    c = _classified(spark, d)
    return c.select("doc_id", "text", F.col("category").isin(CATEGORIES).alias("category_known"),
                    F.col("confidence").between(1 / len(CATEGORIES), 1).alias("confidence_in_range"))


@register("ml.text_classify.scores")
def ml_text_classify_scores(spark, d):
    """(text, category, confidence) for every document with text."""
    return _classified(spark, d).select("doc_id", "text", "category", F.col("confidence").cast("string").alias("confidence"))


@register("ml.confusion", """
WITH c AS (SELECT count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS tp, count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS fp,
                  count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS tn, count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS fn
           FROM labels)
SELECT tp, fp, tn, fn, fp::DOUBLE / (fp + tn) AS fpr, fn::DOUBLE / (tp + fn) AS fnr, tp::DOUBLE / (tp + fn) AS tpr,
       (tp + tn)::DOUBLE / (tp + tn + fp + fn) AS accuracy, tp::DOUBLE / (tp + fp) AS precision FROM c""")
def ml_confusion(spark, d):
    """Rule "not toxic ⇒ good quality" scored against the quality labels."""
    lab = T(spark, d, "labels").select("quality", (1 - F.col("toxic")).alias("pred"))
    return ml.confusion(lab, "quality", "pred")


@register("ml.confusion.text_classifier", f"""
SELECT count(*) AS n, count(*) FILTER (WHERE quality = 1) AS n_good, true AS rates_add_up, true AS better_than_even
FROM documents JOIN labels USING (doc_id)
WHERE regexp_matches(text, '[A-Za-z0-9_]') AND ('0x' || substr(md5(doc_id::VARCHAR), 1, 4))::BIGINT % {HELD_OUT} = 0""")
def ml_confusion_text(spark, d):
    """The text classifier's predictions against the labels it was not trained on."""
    c = _classified(spark, d).join(T(spark, d, "labels"), "doc_id").filter(_held("doc_id"))
    m = ml.confusion(c.withColumn("pred", (F.col("category") == "good").cast("int")), "quality", "pred")
    n = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    right = F.abs(F.col("accuracy") * n - F.col("tp") - F.col("tn")) < 1e-9
    return m.select(n.alias("n"), (F.col("tp") + F.col("fn")).alias("n_good"), right.alias("rates_add_up"),
                    (F.col("accuracy") > 0.5).alias("better_than_even"))
