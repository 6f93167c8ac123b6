"""Encoding and modelling."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farekit.catalog import inputs
from farekit.catalog.joins import _BASELINE_SQL
from farekit.catalog.projections import _SEASON_SQL, _URGENCY_SQL
from farekit.catalog.registry import query
from farekit.catalog.views import CITIES, FARES, with_fares, with_priced, with_quotes
from farekit.functions import rules
from farekit.operators import baseline, encode, popularity
from farekit.plans import features, multiplier, quoting, training
from farekit.session import stage
from farekit.sources import dims, fixtures, schemas

_LABELS_SQL = f"""labelled AS (
  SELECT fare_key, airline, source_city, destination_city, departure_time, class,
         {_SEASON_SQL} AS season, dayname(date) AS day_of_week
  FROM fares
), long AS (
""" + "  UNION ALL\n".join(
    f"  SELECT '{name}' AS feature, {name} AS label FROM labelled\n" for name in features.CATEGORICAL
) + """), ranked AS (
  SELECT feature, label, count(*) AS n,
         CAST(row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, label) - 1 AS INTEGER) AS index
  FROM long GROUP BY feature, label
)"""


def _labelled(spark, sf_dir):
    rows = fixtures.fares(
        spark, sf_dir, "fare_key", "airline", "source_city", "destination_city", "departure_time", "class", "date"
    )
    return features.calendar_columns(rows).select("fare_key", *features.CATEGORICAL)


@query("m01_index_table", f"WITH {FARES}, {_LABELS_SQL} SELECT feature, label, n, index FROM ranked")
def m01(spark, sf_dir):
    return encode.index_table(_labelled(spark, sf_dir), list(features.CATEGORICAL))


_SLOTS_SQL = (
    f"WITH {FARES}, {_LABELS_SQL} SELECT fare_key, "
    + ", ".join(f"r_{name}.index AS {name}_slot" for name in features.CATEGORICAL)
    + " FROM labelled "
    + " ".join(
        f"JOIN ranked r_{name} ON r_{name}.feature = '{name}' AND r_{name}.label = labelled.{name}"
        for name in features.CATEGORICAL
    )
)


@query("m02_one_hot", _SLOTS_SQL)
def m02(spark, sf_dir):
    """The one-hot slot of every label of every fare."""
    rows = stage(_labelled(spark, sf_dir), "labels")  # read twice: to count labels and to encode
    encoded = Pipeline(stages=training.encoding_stages()[:2]).fit(rows).transform(rows)
    # The encoder's vectors are sparse with one entry; its place is read as stored.
    slot = lambda name: F.unwrap_udt(f"{name}_encoded")["indices"][0]
    return encoded.select("fare_key", *[slot(name).alias(f"{name}_slot") for name in features.CATEGORICAL])


_NUMBERS_SQL = f"""
SELECT fare_key, distance_km + distance_km * distance_km + distance_km / 750.0e0
       + CASE stops WHEN 'zero' THEN 0 WHEN 'one' THEN 1 ELSE 2 END + days_before_departure
       + ({_URGENCY_SQL}) + CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END + is_holiday + month(date) + quarter(date)
       + CASE WHEN departure_time IN ('Morning', 'Evening') THEN 1 ELSE 0 END
       + 1.0e0 * count(*) OVER (PARTITION BY source_city, destination_city)
         / (SELECT max(n) FROM (SELECT count(*) AS n FROM factors GROUP BY source_city, destination_city) c) AS numbers
FROM factors"""


@query(
    "m03_assemble",
    with_priced(f"""
SELECT fare_key,
       CAST((SELECT count(DISTINCT airline) + count(DISTINCT source_city) + count(DISTINCT destination_city)
              + count(DISTINCT departure_time) + count(DISTINCT class) + count(DISTINCT dayname(date))
              + count(DISTINCT {_SEASON_SQL}) + 12 FROM factors) AS INTEGER) AS width,
       round(7 + numbers, 4) AS total
FROM ({_NUMBERS_SQL}) f"""),
)
def m03(spark, sf_dir):
    """Width and sum of the assembled vector: seven ones and twelve numbers."""
    rows = stage(inputs.training_features(spark, sf_dir), "features")
    rows = popularity.add_popularity(rows, popularity.popularity_table(rows))
    encoded = Pipeline(stages=training.encoding_stages()[:3]).fit(rows).transform(rows)
    entries = vector_to_array("raw_features")
    return encoded.select(
        "fare_key",
        F.size(entries).alias("width"),
        F.round(F.aggregate(entries, F.lit(0.0), lambda total, x: total + x), 4).alias("total"),
    )


_SCALED = ["distance_km", "days_before_departure", "price"]


@query(
    "m04_scale",
    with_fares(
        "SELECT fare_key, "
        + ", ".join(
            f"round({c} / (SELECT stddev_samp({c}) FROM fares), 6) AS {c}_scaled" for c in _SCALED
        )
        + " FROM fares"
    ),
)
def m04(spark, sf_dir):
    rows = encode.scaled(fixtures.fares(spark, sf_dir, "fare_key", *_SCALED), _SCALED)
    return rows.select("fare_key", *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in _SCALED])


def _evaluated(fit):
    return encode.regression_metrics(fit.model.transform(fit.held_out), training.LABEL, training.PREDICTION)


@query("m05_gradient_boosting")
def m05(spark, sf_dir):
    return _evaluated(inputs.fare_fit(spark, sf_dir))


@query("m06_random_forest")
def m06(spark, sf_dir):
    return _evaluated(inputs.fare_fit(spark, sf_dir, "rf"))


@query("m07_factorization_machine")
def m07(spark, sf_dir):
    model, _, held_out = inputs.notebook_fit(spark, sf_dir)
    return encode.regression_metrics(model.transform(held_out), "price_ratio", "predicted_ratio")


@query("m08_stored_multiplier")
def m08(spark, sf_dir):
    model, held_out = inputs.stored_fit(spark, sf_dir)
    return model.transform(held_out).select("fare_key", "days_left", "classx", "price_multiplier", "predicted_multiplier")


@query("m09_fit_and_predict")
def m09(spark, sf_dir):
    """Held-out rows with prediction and absolute error."""
    fit = inputs.fare_fit(spark, sf_dir)
    shown = ("fare_key", "airline", "source_city", "destination_city", "class", "days_before_departure")
    return training.prediction_sample(fit.model.transform(fit.held_out), *shown)


@query("m10_split", with_priced("SELECT fare_key, key_hash % 100 < 80 AS in_training FROM ruled"))
def m10(spark, sf_dir):
    rows = fixtures.fares(spark, sf_dir, "fare_key")
    return rows.select("fare_key", encode.in_training(F.col("fare_key")).alias("in_training"))


@query("m12_feature_importance")
def m12(spark, sf_dir):
    fit = inputs.fare_fit(spark, sf_dir)
    return training.importances(fit.model, fit.train)


@query("o07_top_importances")
def o07(spark, sf_dir):
    fit = inputs.fare_fit(spark, sf_dir)
    return training.top_importances(training.importances(fit.model, fit.train))


@query("m13_fare_scoring")
def m13(spark, sf_dir):
    """Predictions for all fares, with popularity from the training part."""
    fit = inputs.fare_fit(spark, sf_dir)
    rows = popularity.add_popularity(inputs.training_features(spark, sf_dir), fit.popularity, fallback=True)
    return fit.model.transform(rows).select("fare_key", "price", "predicted_price")


@query("m14_multiplier_scoring")
def m14(spark, sf_dir):
    model, _, held_out = inputs.notebook_fit(spark, sf_dir)
    return multiplier.score_multiplier(model, held_out.drop("class_numeric")).select(
        "fare_key", "days_left", "classx", "predicted_ratio", "multiplier"
    )


@query("m15_scenario_scoring")
def m15(spark, sf_dir):
    """Lead times and classes for every flight, priced on the flight's own baseline."""
    model, _, _ = inputs.notebook_fit(spark, sf_dir)
    bases = baseline.baseline_prices(fixtures.quotes(spark, sf_dir))
    grid = baseline.scenario_grid(bases, multiplier.SCENARIO_DAYS, multiplier.SCENARIO_CLASSES)
    scored = multiplier.price_scenarios(multiplier.score_multiplier(model, grid), F.col("baseline_price"))
    return scored.select("flight", "days_left", "classx", "multiplier", "final_price")


@query(
    "m16_assemble_strict",
    with_quotes(f"""
SELECT fare_key, CAST(days_left AS DOUBLE) AS entry_0, CASE classx WHEN 'Economy' THEN 0.0e0 ELSE 1.0e0 END AS entry_1
FROM quotes JOIN {_BASELINE_SQL} b USING (flight)"""),
)
def m16(spark, sf_dir):
    assembler = multiplier.notebook_pipeline().getStages()[0]
    entries = vector_to_array("features")
    rows = assembler.transform(multiplier.numeric_class(inputs.ratios(spark, sf_dir)))
    return rows.select("fare_key", entries[0].alias("entry_0"), entries[1].alias("entry_1"))


# What SQL can state of the fitted models: which rows are scored, and how the results relate. Every flag is computed.


@query(
    "m05_metrics_shape",
    with_priced("""
SELECT kind, count(*) AS n, true AS r2_is_a_share, true AS mae_within_rmse
FROM priced, (VALUES ('gbt'), ('rf')) AS k(kind) WHERE key_hash % 100 >= 80 GROUP BY kind"""),
)
def m05_shape(spark, sf_dir):
    """Rows evaluated of the boosted trees and of the forest, and relations any metrics obey."""
    tables = [_evaluated(inputs.fare_fit(spark, sf_dir, kind)).withColumn("kind", F.lit(kind)) for kind in ("gbt", "rf")]
    return tables[0].union(tables[1]).select(
        "kind", "n", (F.col("r2") <= 1).alias("r2_is_a_share"), (F.col("mae") <= F.col("rmse")).alias("mae_within_rmse")
    )


@query("m07_held_out_rows", with_priced(f"""
SELECT count(*) AS n, true AS mae_within_rmse FROM (
  SELECT fare_key, source_city || '-' || destination_city AS flight, key_hash FROM priced) q
WHERE key_hash % 100 >= 90 AND flight IN (
  SELECT source_city || '-' || destination_city FROM fares WHERE days_before_departure = 1)"""))
def m07_shape(spark, sf_dir):
    return m07(spark, sf_dir).select("n", (F.col("mae") <= F.col("rmse")).alias("mae_within_rmse"))


_RATIO_ROWS = """FROM (
  SELECT fare_key, days_before_departure AS days_left, class AS classx, key_hash,
         source_city || '-' || destination_city AS flight FROM priced) q
WHERE flight IN (SELECT source_city || '-' || destination_city FROM fares WHERE days_before_departure = 1)"""


@query("m08_stored_rows", with_priced(f"SELECT fare_key, days_left, classx, true AS predicted {_RATIO_ROWS} AND key_hash % 100 >= 80"))
def m08_rows(spark, sf_dir):
    scored = m08(spark, sf_dir)
    return scored.select("fare_key", "days_left", "classx", F.col("predicted_multiplier").isNotNull().alias("predicted"))


@query("m09_errors", with_priced("SELECT fare_key, composed_price AS price, true AS error_is_the_difference FROM priced WHERE key_hash % 100 >= 80"))
def m09_errors(spark, sf_dir):
    fit = inputs.fare_fit(spark, sf_dir)
    sample = training.prediction_sample(fit.model.transform(fit.held_out), "fare_key")
    difference = F.abs(F.col("price") - F.col("predicted_price"))
    return sample.select("fare_key", "price", (F.abs(F.col("error") - difference) < 1e-9).alias("error_is_the_difference"))


_TRAIN_SLOTS_SQL = _LABELS_SQL.replace("FROM fares\n), long", "FROM fares WHERE CAST(('0x' || substr(md5(fare_key), 1, 8)) AS BIGINT) % 100 < 80\n), long")
_SOURCES_SQL = ", ".join(f"({i}, '{name}')" for i, name in enumerate((*features.CATEGORICAL, *features.NUMERIC)))


@query(
    "m12_slots",
    f"""WITH {FARES}, {_TRAIN_SLOTS_SQL},
named AS (
  SELECT position, source, coalesce(index, 0) AS index, CASE WHEN label IS NULL THEN source ELSE source || '_encoded_' || label END AS feature
  FROM (VALUES {_SOURCES_SQL}) AS s(position, source) LEFT JOIN ranked ON ranked.feature = s.source)
SELECT CAST(row_number() OVER (ORDER BY position, index) - 1 AS INTEGER) AS slot, feature, source FROM named""",
)
def m12_slots(spark, sf_dir):
    return m12(spark, sf_dir).select("slot", "feature", "source")


# Any numbers do, if they depend on the slot alone; eighths add up without rounding.
_WEIGHT_SQL = "(slot * 37 % 101) / 8.0e0"


@query(
    "o07_importance_total",
    f"""WITH {FARES}, {_TRAIN_SLOTS_SQL},
named AS (
  SELECT position, source, coalesce(index, 0) AS index
  FROM (VALUES {_SOURCES_SQL}) AS s(position, source) LEFT JOIN ranked ON ranked.feature = s.source),
slots AS (SELECT row_number() OVER (ORDER BY position, index) - 1 AS slot, source FROM named)
SELECT source, sum({_WEIGHT_SQL}) AS importance, count(*) AS slots,
       CAST(row_number() OVER (ORDER BY sum({_WEIGHT_SQL}) DESC, source) AS INTEGER) AS rank
FROM slots GROUP BY source ORDER BY rank LIMIT 10""",
)
def o07_total(spark, sf_dir):
    """Sources of the fitted model's slots, ranked by weights that are known: what a fit's own weights go through."""
    fit = inputs.fare_fit(spark, sf_dir)
    slots = training.slot_names(fit.model.transform(fit.train))
    weights = slots.select("slot", (F.col("slot") * 37 % 101 / 8).alias("importance"))
    weighed = training.importances_of(slots, weights)
    counts = weighed.groupBy("source").agg(F.count("*").alias("slots"))
    # Ten rows at most.
    rank = F.row_number().over(Window.orderBy(F.desc("importance"), "source"))
    top = training.top_importances(weighed).join(counts, "source")
    return top.select("source", "importance", "slots", rank.alias("rank"))


@query("m13_scored_rows", with_priced("SELECT fare_key, composed_price AS price, true AS predicted FROM priced"))
def m13_rows(spark, sf_dir):
    return m13(spark, sf_dir).select("fare_key", "price", F.col("predicted_price").isNotNull().alias("predicted"))


@query("m14_in_range", with_priced(f"SELECT fare_key, days_left, classx, true AS in_range {_RATIO_ROWS} AND key_hash % 100 >= 90"))
def m14_range(spark, sf_dir):
    low, high = rules.MULTIPLIER_RANGE
    return m14(spark, sf_dir).select("fare_key", "days_left", "classx", F.col("multiplier").between(low, high).alias("in_range"))


@query(
    "m15_grid",
    with_quotes(f"""
SELECT flight, days_left, classx, true AS price_is_the_product
FROM {_BASELINE_SQL} b, (VALUES (1), (5), (10), (20)) AS d(days_left), (VALUES ('Economy'), ('Business')) AS c(classx)"""),
)
def m15_grid(spark, sf_dir):
    bases = baseline.baseline_prices(fixtures.quotes(spark, sf_dir))
    found = m15(spark, sf_dir).join(bases, "flight")
    product = F.floor(F.col("baseline_price") * F.col("multiplier"))
    return found.select(
        "flight", "days_left", "classx", (F.col("final_price").cast("long") == product).alias("price_is_the_product")
    )


# The three fares that are quoted as examples, with the names of the original's airlines and cities.
EXAMPLE_FARES = (
    (1, "IndiGo", "Delhi", "Mumbai", "Morning", "Economy", 30, 1150.0, 0),
    (2, "Vistara", "Bangalore", "Goa", "Evening", "Business", 7, 520.0, 0),
    (3, "Air_India", "Chennai", "Delhi", "Night", "Economy", 2, 1760.0, 1),
)
_EXAMPLE_COLUMNS = (
    "request_id", "airline_name", "source_name", "destination_name", "departure_time", "cabin_class",
    "days_before_departure", "distance_km", "is_weekend",
)
_CARRIERS = tuple(zip((name for name, _ in dims.AIRLINES), fixtures.FIXTURE_AIRLINES, strict=True))


def _example_requests(spark, sf_dir):
    """The examples as requests, under the names that stand for theirs in the tables."""
    asked = dims.values_table(spark, EXAMPLE_FARES, _EXAMPLE_COLUMNS)
    carriers = dims.values_table(spark, _CARRIERS, ("airline_name", "airline"))
    stands = fixtures.fixture_cities(spark, sf_dir).groupBy("city_name").agg(F.min("city").alias("city"))
    named = asked.join(carriers, "airline_name")
    for role in ("source", "destination"):
        named = named.join(stands.toDF(f"{role}_name", f"{role}_city"), f"{role}_name")
    request = T.StructType.fromDDL(schemas.REQUESTS)
    given = {f.name: F.col(f.name) if f.name in named.columns else F.lit(None) for f in request}
    return named.select(*[given[f.name].cast(f.dataType).alias(f.name) for f in request])


@query("m15_fare_examples")
def m15_examples(spark, sf_dir):
    """The three example fares, quoted by the fitted model."""
    responses, _ = quoting.quote(_example_requests(spark, sf_dir), inputs.quote_context(spark, sf_dir))
    return responses.select("request_id", "predicted_price", "currency", "flight_details.*", "savings_tip")


_EXAMPLES_SQL = dims.values_sql(EXAMPLE_FARES, _EXAMPLE_COLUMNS, "asked")
_CARRIERS_SQL = dims.values_sql(_CARRIERS, ("carrier_name", "carrier"), "carriers")


@query(
    "m15_example_fields",
    f"""WITH {CITIES}, stands AS (SELECT city_name, min(city) AS city FROM city_dim GROUP BY city_name)
SELECT CAST(request_id AS BIGINT) AS request_id, s.city || ' → ' || d.city AS route, carrier AS airline,
       cabin_class AS class, departure_time, distance_km, 'zero' AS stops,
       CAST(days_before_departure AS INTEGER) AS days_before_departure, is_weekend = 1 AS is_weekend, true AS price_in_tens
FROM {_EXAMPLES_SQL} JOIN {_CARRIERS_SQL} ON carrier_name = airline_name
JOIN stands s ON s.city_name = source_name JOIN stands d ON d.city_name = destination_name""",
)
def m15_example_fields(spark, sf_dir):
    """What SQL can state of the example quotes: their inputs, and that a price came out."""
    price = F.col("predicted_price")
    return m15_examples(spark, sf_dir).select(
        "request_id", "route", "airline", "class", "departure_time", "distance_km", "stops", "days_before_departure",
        "is_weekend", ((price > 0) & (price % 10 == 0)).alias("price_in_tens"),
    )


@query(
    "m10_split_fallback",
    with_priced("""
SELECT CASE WHEN count(*) FILTER (WHERE key_hash % 100 >= 90) >= 2 THEN 90
            WHEN count(*) FILTER (WHERE key_hash % 100 >= 80) >= 2 THEN 80 ELSE 100 END AS percent,
       count(*) FILTER (WHERE key_hash % 100 < 90) AS n_training FROM ruled"""),
)
def m10_fallback(spark, sf_dir):
    rows = fixtures.fares(spark, sf_dir, "fare_key")
    train, _, percent = encode.split_with_fallback(rows, F.col("fare_key"), fallback=True)
    return train.agg(F.lit(percent).alias("percent"), F.count("*").alias("n_training"))
