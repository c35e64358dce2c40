
from __future__ import annotations

import importlib.util
from collections.abc import Callable
from datetime import datetime, timezone
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewatch import schema
from tidewatch.functions import values
from tidewatch.functions.values import instant
from tidewatch.operators import boosting, counters, model, predictions, profile, quality, rolling, validation
from tidewatch.plans.jobs import run_incremental_feature_job, run_stream_job
from tidewatch.session import scratch_path
from tidewatch.sources import events as source, relational, tables
from tidewatch.streaming import consumer, features as stream_features_of, newest, sinks

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF = "2024-01-31"
INACTIVE_DAYS = 1  # a 30-day label has no positives in 30 days of events
EVERYONE = {"busy_rows": 0, "busy_parts": 10 ** 15}  # any customer with an event is a busy one
ONE_CUSTOMER = "1"
Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function name; all run with UTC dates and hours."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    _QUERIES[function.__name__] = run
    return run


# --- inputs -----------------------------------------------------------------

def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _events(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return source.from_activity_log(_log(spark, sf_dir), keep)


def _raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that keep the log's own event types, most of which are not accepted."""
    return source.encode(source.from_activity_log(_log(spark, sf_dir), map_types=False))


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule score of every five-minute window as a stored prediction."""
    scores = stream_features_of.with_rule_score(
        stream_features_of.window_features(_events(spark, sf_dir)))
    return scores.select("customer_id", F.col("churn_score").alias("churn_probability"),
                         F.col("window.end").alias("prediction_date"),
                         F.lit(schema.MODEL_VERSION).alias("model_version"),
                         F.lit(None).cast("string").alias("features"))


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.customer_profile(_events(spark, sf_dir), AS_OF)


def _training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles and their labels, stored: training reads them many times."""
    path = scratch_path(spark, "training-set")
    features = _profile(spark, sf_dir)
    features.withColumn(model.LABEL, model.churn_label(INACTIVE_DAYS)).write.parquet(path)
    return spark.read.parquet(path)


def _plain(moment: str) -> Column:
    return F.col(moment).cast("timestamp_ntz").alias(moment.split(".")[-1])


def _rounded(frame: DataFrame, *exact: str) -> DataFrame:
    """Comparable output: doubles to six places, timestamps without a zone."""
    columns = []
    for field in frame.schema:
        kind = field.dataType.typeName()
        if kind == "double" and field.name not in exact:
            columns.append(F.round(field.name, 6).alias(field.name))
        else:
            columns.append(_plain(field.name) if kind == "timestamp" else F.col(field.name))
    return frame.select(columns)


def _flat(events: DataFrame, *keep: str) -> DataFrame:
    """Events with the parts of `event_data` as columns."""
    return events.select(*keep, "customer_id", _plain("timestamp"), "event_type",
                         F.col("event_data")["amount"].alias("amount"),
                         F.col("event_data")["k"].alias("k"), "schema_version")


# --- features ---------------------------------------------------------------

@query
def customer_features(spark, sf_dir):
    return _rounded(profile.customer_features(_events(spark, sf_dir), AS_OF))


@query
def time_features(spark, sf_dir):
    return _rounded(profile.time_features(_events(spark, sf_dir), AS_OF, 7))


@query
def behavioral_features(spark, sf_dir):
    return _rounded(profile.behavioral_features(_events(spark, sf_dir)))


@query
def customer_profile(spark, sf_dir):
    return _rounded(_profile(spark, sf_dir))


@query
def incremental_profile(spark, sf_dir):
    """Profiles from stored counters: two batches of events, of which the first comes twice."""
    state, table = scratch_path(spark, "counters"), scratch_path(spark, "profiles")
    first = F.dayofmonth("timestamp") % 3 == 1
    for number, part in [(0, first), (0, first), (1, ~first)]:
        run_incremental_feature_job(_events(spark, sf_dir).where(part), state, table, AS_OF, ("daily", number))
    return _rounded(tables.read_table(spark, table))


@query
def rolling_aggregations(spark, sf_dir):
    result = rolling.rolling_aggregations(_events(spark, sf_dir, "event_id"))
    return _rounded(result.drop("event_data", "schema_version"))


@query
def rolling_by_slice(spark, sf_dir):
    """The same values with every customer treated as a busy one."""
    result = rolling.rolling_aggregations(_events(spark, sf_dir, "event_id"), **EVERYONE)
    return _rounded(result.drop("event_data", "schema_version"))


@query
def first_purchase(spark, sf_dir):
    return _rounded(rolling.first_purchase(_events(spark, sf_dir)))


@query
def cohort_features(spark, sf_dir):
    result = rolling.cohort_features(_events(spark, sf_dir, "event_id"))
    return _rounded(result.drop("event_data", "schema_version"))


@query
def cohort_by_broadcast(spark, sf_dir):
    """The same values with every customer treated as a busy one."""
    result = rolling.cohort_features(_events(spark, sf_dir, "event_id"), **EVERYONE)
    return _rounded(result.drop("event_data", "schema_version"))


# --- messages and validation --------------------------------------------------

@query
def event_envelope(spark, sf_dir):
    return source.encode(_events(spark, sf_dir))


@query
def key_decode(spark, sf_dir):
    """Message keys back from the bytes in which a topic delivers them."""
    messages = source.encode(_events(spark, sf_dir))
    return source.keys(messages.withColumn("key", F.col("key").cast("binary")))


@query
def decode_events(spark, sf_dir):
    return _flat(source.decode(source.encode(_events(spark, sf_dir))))


@query
def valid_events(spark, sf_dir):
    return _flat(validation.valid_events(validation.check_messages(_raw_messages(spark, sf_dir))))


@query
def rejected_events(spark, sf_dir):
    rejected = validation.rejected_messages(
        validation.check_messages(_raw_messages(spark, sf_dir)))
    return rejected.select("value", F.array_join("reasons", ",").alias("reasons"))


@query
def validation_stats(spark, sf_dir):
    return validation.validation_stats(validation.check_messages(_raw_messages(spark, sf_dir)))


@query
def dq_report(spark, sf_dir):
    raw = source.from_activity_log(_log(spark, sf_dir), map_types=False)
    return quality.quality_report(raw, quality.EVENT_SUITE)


@query
def dq_summary(spark, sf_dir):
    raw = source.from_activity_log(_log(spark, sf_dir), map_types=False)
    return _rounded(quality.quality_summary(quality.quality_report(raw, quality.EVENT_SUITE)))


@query
def scoring_input_report(spark, sf_dir):
    return quality.scoring_input_report(
        profile.customer_features(_events(spark, sf_dir), AS_OF))


# --- windows and streams -------------------------------------------------------

def _window_columns(frame: DataFrame) -> DataFrame:
    return _rounded(frame.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "customer_id", "event_count", "purchase_count", "page_view_count",
        "avg_purchase_amount",
        *[c for c in ["churn_score", "scored_in_run"] if c in frame.columns]))


@query
def tumbling_features(spark, sf_dir):
    return _window_columns(stream_features_of.window_features(_events(spark, sf_dir)))


@query
def rule_score(spark, sf_dir):
    """Day windows, in which all three scores occur."""
    return _window_columns(stream_features_of.with_rule_score(
        stream_features_of.window_features(_events(spark, sf_dir), "1 day")))


def _stream_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream, whether it is one file or a folder of files.

    Spark follows plain paths only if they are folders; a pattern may name a file as well.
    """
    shape = spark.read.parquet(f"{sf_dir}/{name}").schema
    return spark.readStream.schema(shape).parquet(f"{sf_dir}/{name[:-1]}[{name[-1]}]")


def _add_messages(events: DataFrame, path: str) -> None:
    source.encode(events).select("value").write.mode("append").text(path)


def _message_folder(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "messages")
    _add_messages(_events(spark, sf_dir), path)
    return path


@query
def stream_features(spark, sf_dir):
    path, checkpoint = scratch_path(spark, "scores"), scratch_path(spark, "checkpoint")
    events = source.from_activity_log(_stream_of(spark, sf_dir, "events.parquet"))
    sinks.append_to_table(stream_features_of.window_scores(events), path, checkpoint,
                          available_now=True).awaitTermination()
    return _window_columns(spark.read.parquet(path))


@query
def stream_source(spark, sf_dir):
    """Messages followed as a stream, decoded and appended to a table."""
    path, checkpoint = scratch_path(spark, "events"), scratch_path(spark, "checkpoint")
    messages = source.follow_messages(spark, _message_folder(spark, sf_dir))
    sinks.append_to_table(source.decode(messages), path, checkpoint,
                          available_now=True).awaitTermination()
    return _flat(spark.read.parquet(path))


@query
def stream_append(spark, sf_dir):
    """The whole stream job: messages to window scores in a table."""
    path, checkpoint = scratch_path(spark, "scores"), scratch_path(spark, "checkpoint")
    messages = source.follow_messages(spark, _message_folder(spark, sf_dir))
    run_stream_job(messages, path, checkpoint, available_now=True).awaitTermination()
    return _window_columns(spark.read.parquet(path))


@query
def stream_restart(spark, sf_dir):
    """The stream job stopped halfway and started again from its checkpoint."""
    folder, path, checkpoint = (scratch_path(spark, name) for name in ("messages", "scores", "checkpoint"))
    later = F.col("timestamp") >= F.lit("2024-01-16").cast("timestamp")
    began = datetime.now(timezone.utc)
    for part in (~later, later):
        _add_messages(_events(spark, sf_dir).where(part), folder)
        messages = source.follow_messages(spark, folder)
        run_stream_job(messages, path, checkpoint, available_now=True).awaitTermination()
    ended = datetime.now(timezone.utc)
    scored = F.col("prediction_timestamp").between(instant(began), instant(ended))
    rows = spark.read.parquet(path)
    return _window_columns(rows.withColumn("scored_in_run", scored))


@query
def stream_versions(spark, sf_dir):
    """The stream job into a versioned table, in two runs; then its last micro-batch comes again,
    as after a crash before Spark noted it."""
    folder, path, checkpoint = (scratch_path(spark, name) for name in ("messages", "scores", "checkpoint"))
    later = F.col("timestamp") >= F.lit("2024-01-16").cast("timestamp")
    for part in (~later, later):
        _add_messages(_events(spark, sf_dir).where(part), folder)
        messages = source.follow_messages(spark, folder)
        run_stream_job(messages, path, checkpoint, available_now=True,
                       table_format="versions").awaitTermination()
    rows = tables.read_table(spark, path)
    name = tables.stream_name(spark, checkpoint)
    tables.append(rows, path, (name, tables.last_batch(spark, path, name)))
    return _window_columns(tables.read_table(spark, path))


@query
def stream_latest_prediction(spark, sf_dir):
    """Newest predictions kept by a stream that is stopped and started again; the second part has
    older predictions, too."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    folder, path, checkpoint = (scratch_path(spark, name) for name in ("scores", "newest", "checkpoint"))
    second = F.dayofmonth("prediction_date") % 3 == 0
    for part in (~second, second):
        _predictions(spark, sf_dir).where(part).write.mode("append").parquet(folder)
        followed = spark.readStream.schema(schema.PREDICTION).parquet(folder)
        newest.keep_newest(followed, path, checkpoint, available_now=True).awaitTermination()
    return _rounded(tables.read_table(spark, path))


@query
def kafka_payload(spark, sf_dir):
    scores = stream_features_of.with_rule_score(
        stream_features_of.window_features(_events(spark, sf_dir)))
    return stream_features_of.score_messages(
        scores.withColumn("prediction_timestamp", F.col("window.end")))


@query
def foreach_batch(spark, sf_dir):
    def refuse_large_amounts(message: dict) -> None:
        if float(message["event_data"]["amount"]) > 100:
            raise ValueError("amount too large")

    outcomes, checkpoint = scratch_path(spark, "outcomes"), scratch_path(spark, "checkpoint")
    messages = source.follow_messages(spark, _message_folder(spark, sf_dir))
    consumer.consume(messages, refuse_large_amounts, checkpoint, outcomes,
                     available_now=True).awaitTermination()
    return consumer.dead_letters(spark, outcomes).select("value", "error")


# --- stored predictions and features ---------------------------------------------

@query
def latest_prediction(spark, sf_dir):
    return _rounded(predictions.latest_predictions(_predictions(spark, sf_dir)))


@query
def latest_prediction_of(spark, sf_dir):
    """The newest prediction of one customer; the customer is the query's argument."""
    return _rounded(predictions.latest_prediction(_predictions(spark, sf_dir), ONE_CUSTOMER))


@query
def prediction_metrics(spark, sf_dir):
    return _rounded(predictions.prediction_metrics(
        _predictions(spark, sf_dir), "2024-01-30 12:00:00"))


@query
def risk_band(spark, sf_dir):
    return _rounded(predictions.with_risk_level(_predictions(spark, sf_dir)).drop("features"))


@query
def feature_lookup(spark, sf_dir):
    """Features of the customers with a support ticket in the last two days."""
    events = _events(spark, sf_dir)
    asked = events.where((F.col("event_type") == "support_ticket")
                         & (F.col("timestamp") >= F.lit("2024-01-29").cast("timestamp")))
    return _rounded(predictions.feature_lookup(_profile(spark, sf_dir), asked))


@query
def param_query(spark, sf_dir):
    return _rounded(relational.run_query(spark, """
        SELECT customer_id, count(*) AS predictions, avg(churn_probability) AS mean_probability
        FROM {predictions}
        WHERE prediction_date >= CAST(:since AS TIMESTAMP) AND churn_probability >= :floor
        GROUP BY customer_id""", {"since": "2024-01-15 00:00:00", "floor": 0.5},
        predictions=_predictions(spark, sf_dir)))


@query
def with_defaults(spark, sf_dir):
    rows = _predictions(spark, sf_dir).select(
        "customer_id", "churn_probability",
        F.when(F.col("churn_probability") < 0.7, F.col("prediction_date")).alias("prediction_date"))
    return _rounded(predictions.with_prediction_defaults(rows, AS_OF))


@query
def feature_row_defaults(spark, sf_dir):
    rows = profile.customer_features(_events(spark, sf_dir), AS_OF).select(
        "customer_id", "total_events", "purchase_count", "total_purchase_amount",
        F.when(F.col("page_view_count") > 10, F.col("page_view_count")).alias("page_view_count"))
    return _rounded(predictions.with_feature_defaults(rows, AS_OF))


# --- tables ---------------------------------------------------------------------

def _day_totals(spark: SparkSession, sf_dir: str, condition: Column) -> DataFrame:
    return (_events(spark, sf_dir).where(condition)
            .groupBy("customer_id", F.to_date("timestamp").alias("day"))
            .agg(F.count("*").alias("events"), F.max("timestamp").alias("last_seen")))


def _shown_days(frame: DataFrame) -> DataFrame:
    return _rounded(frame.withColumn("day", F.col("day").cast("string")))


def _upserted(spark: SparkSession, sf_dir: str) -> str:
    """Days up to the 20th, merged with the days from the 10th on: every event counts in one
    of them, some days are in both."""
    path = scratch_path(spark, "table")
    early = F.col("timestamp") < F.lit("2024-01-21").cast("timestamp")
    late = F.col("timestamp") >= F.lit("2024-01-10").cast("timestamp")
    keys = ["customer_id", "day"]
    tables.create_if_absent(_day_totals(spark, sf_dir, early), path, keys=keys)
    tables.upsert(_day_totals(spark, sf_dir, late), path, keys, {"events": "target.events + source.events"})
    return path


@query
def create_if_absent(spark, sf_dir):
    path = scratch_path(spark, "table")
    tables.create_if_absent(_events(spark, sf_dir), path, ["event_type"])
    tables.create_if_absent(_events(spark, sf_dir).limit(0), path, ["event_type"])
    return _flat(tables.read_table(spark, path))


@query
def table_upsert(spark, sf_dir):
    return _shown_days(tables.read_table(spark, _upserted(spark, sf_dir)))


@query
def snapshot_read(spark, sf_dir):
    return _shown_days(tables.read_table(spark, _upserted(spark, sf_dir), version=0))


@query
def remove_old(spark, sf_dir):
    """The merged table after its first version is gone, with the data that only that one read."""
    path = _upserted(spark, sf_dir)
    tables.remove_old(spark, path, keep=1, older_than_hours=-1)
    return _shown_days(tables.read_table(spark, path))


@query
def table_lookup(spark, sf_dir):
    """Rows of the customers with a purchase of more than 200, from their slices of a table."""
    path = scratch_path(spark, "table")
    profiles = profile.customer_features(_events(spark, sf_dir), AS_OF).select(
        "customer_id", "total_events", "purchase_count", "last_event_date")
    tables.create_if_absent(profiles, path, keys=["customer_id"], slices=64)
    asked = _log(spark, sf_dir).where("event_type = 'purchase' AND value > 200")
    return _rounded(tables.lookup(spark, path, asked.select(F.col("user_id").cast("string"))))


@query
def compact(spark, sf_dir):
    """A table partitioned by type, a few files each, in fewer files."""
    path = scratch_path(spark, "table")
    tables.create_if_absent(_events(spark, sf_dir), path, ["event_type"])
    tables.compact(spark, path)
    return _flat(tables.read_table(spark, path))


# --- model ------------------------------------------------------------------------

@query
def churn_labels(spark, sf_dir):
    return model.churn_labels(_profile(spark, sf_dir), INACTIVE_DAYS)


@query
def training_set(spark, sf_dir):
    path = scratch_path(spark, "training-set")
    features = _training_rows(spark, sf_dir).drop(model.LABEL)
    labels = model.churn_labels(features, INACTIVE_DAYS)
    model.training_set(features, labels).write.parquet(path)
    return _rounded(spark.read.parquet(path).select("customer_id", *schema.FEATURES, model.LABEL))


@query
def asof_training_set(spark, sf_dir):
    """Each support ticket as a dated label, with the customer's newest day of totals before it."""
    days = _day_totals(spark, sf_dir, F.lit(True)).select(
        "customer_id", F.date_add("day", 1).cast("timestamp").alias("known_at"), "events", "last_seen")
    labels = _events(spark, sf_dir, "event_id").where("event_type = 'support_ticket'").select(
        "event_id", "customer_id", F.col("timestamp").alias("labelled_at"))
    return _rounded(model.training_set_as_of(days, labels, "known_at", "labelled_at"))


@query
def model_features(spark, sf_dir):
    """Stored features only: the recent columns come out as 0."""
    return _rounded(model.model_features(
        profile.customer_features(_events(spark, sf_dir), AS_OF)))


@query
def stratified_split(spark, sf_dir):
    return model.with_split(model.churn_labels(_profile(spark, sf_dir), INACTIVE_DAYS))


@query
def exact_split(spark, sf_dir):
    return model.with_exact_split(model.churn_labels(_profile(spark, sf_dir), INACTIVE_DAYS))


@query
def roc_areas(spark, sf_dir):
    """How well single inputs rank customers by their label: the exact area for each of them."""
    rows = _training_rows(spark, sf_dir)
    inputs = F.array(*[F.col(name).cast("double") for name in schema.FEATURES])
    areas = boosting.areas_under_curve(rows.select(
        F.posexplode(inputs).alias("round", "score"), F.col(model.LABEL).alias("label")))
    return _rounded(areas)


@query
def scaled_features(spark, sf_dir):
    rows = model.with_split(model.model_features(_profile(spark, sf_dir)))
    return _rounded(model.standardise(rows))


@query
def classifier_metrics(spark, sf_dir):
    """A guess by recent purchases, measured against the label."""
    events = _events(spark, sf_dir)
    recent = profile.time_features(events, AS_OF, 2).select("customer_id", "purchases_last_2d")
    labels = model.churn_labels(profile.customer_features(events, AS_OF), INACTIVE_DAYS)
    guesses = labels.join(recent, "customer_id", "left").withColumn(
        "prediction", (F.coalesce("purchases_last_2d", F.lit(0)) == 0).cast("int"))
    return _rounded(model.classifier_metrics(guesses))


@query
def train_model(spark, sf_dir):
    """How many customers validate the model, how many of them left, and that it has learned."""
    rows = _training_rows(spark, sf_dir)
    metrics = model.evaluate(model.train(rows), rows)
    positives = F.col("true_positives") + F.col("false_negatives")
    return metrics.select(
        (positives + F.col("false_positives") + F.col("true_negatives")).alias("validation_rows"),
        positives.alias("validation_positives"), (F.col("accuracy") > 0.5).alias("above_floor"))


@query
def batch_score(spark, sf_dir):
    """Stored prediction rows, and whether each probability, class and band agree."""
    rows = _training_rows(spark, sf_dir)
    scored = model.score(model.train(rows), rows, AS_OF)
    probability = F.col("churn_probability")
    checks = scored.select(
        "customer_id", probability.between(0, 1).alias("is_probability"),
        ((probability > 0.5).cast("int") == F.col("prediction")).alias("class_agrees"),
        (values.risk_band(probability) == F.col("risk_level")).alias("band_agrees"))
    stored = predictions.prediction_rows(scored).drop("churn_probability")
    return _rounded(stored.join(checks, "customer_id"))


@query
def feature_importance(spark, sf_dir):
    """The model's inputs, whether their weights are none below 0 and sum to 1."""
    fitted = model.train(_training_rows(spark, sf_dir))
    weights = model.feature_importance(spark, fitted)
    total = F.sum("importance").over(Window.partitionBy(F.lit(0)))
    return weights.select("feature", (F.col("importance") >= 0).alias("is_weight"),
                          (F.round(total, 6) == 1).alias("sums_to_one"))


@query
def model_roundtrip(spark, sf_dir):
    """Customers whose class or probability changes when the model is stored and loaded."""
    path = scratch_path(spark, "model")
    rows = _training_rows(spark, sf_dir)
    fitted = model.train(rows)
    model.save_model(fitted, path)
    before = model.score(fitted, rows, AS_OF)
    after = model.score(model.load_model(path), rows, AS_OF).select(
        "customer_id", F.col("churn_probability").alias("loaded_probability"))
    return before.join(after, "customer_id").agg(
        F.count("*").alias("customers"),
        F.count(F.when(F.col("churn_probability") != F.col("loaded_probability"), 1))
        .alias("changed"))


def entry(spark: SparkSession) -> DataFrame:
    """The customer profile at the smallest scale."""
    return _QUERIES["customer_profile"](spark, SMOKE_DIR)


def _extension(part: str) -> dict:
    """Queries or SQL of the training-data operators, where those are installed."""
    if not all(map(importlib.util.find_spec, ("tidewatch.llm", "corpus_pipeline"))):
        return {}
    from tidewatch.llm import queries as extension
    return getattr(extension, part)


def queries() -> dict[str, Query]:
    return {**_QUERIES, **_extension("QUERIES")}


# --- SQL counterparts ---------------------------------------------------------------

_CANONICAL = """
e AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS customer_id, ts,
         CASE event_type WHEN 'view' THEN 'page_view' WHEN 'error' THEN 'support_ticket'
              WHEN 'signup' THEN 'login' WHEN 'click' THEN 'logout' ELSE event_type END AS event_type,
         CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END AS paid,
         event_type AS log_type, CAST(value AS VARCHAR) AS amount,
         json_extract_string(props, '$.k') AS k
  FROM events
)"""

_CUSTOMERS = """
c AS (
  SELECT customer_id, count(*) AS total_events, count(DISTINCT event_type) AS unique_event_types,
         min(ts) AS first_event_date, max(ts) AS last_event_date,
         count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count,
         count(*) FILTER (WHERE event_type = 'page_view') AS page_view_count,
         count(*) FILTER (WHERE event_type = 'support_ticket') AS support_ticket_count,
         CAST(sum(paid) AS DOUBLE) / count(paid) AS avg_purchase_amount,
         CAST(sum(paid) AS DOUBLE) AS total_purchase_amount,
         CAST(datediff('day', max(ts), TIMESTAMP '2024-01-31') AS INTEGER) AS days_since_last_activity,
         CAST(datediff('day', min(ts), max(ts)) + 1 AS INTEGER) AS customer_lifetime_days,
         count(*) / (datediff('day', min(ts), max(ts)) + 1) AS events_per_day,
         count(*) FILTER (WHERE event_type = 'purchase')
           / (datediff('day', min(ts), max(ts)) + 1) AS purchase_frequency
  FROM e GROUP BY customer_id
)"""


def _recent_sql(days: int) -> str:
    return f"""
t{days} AS (
  SELECT customer_id, count(*) AS events_last_{days}d,
         count(*) FILTER (WHERE event_type = 'purchase') AS purchases_last_{days}d,
         count(*) FILTER (WHERE event_type = 'page_view') AS page_views_last_{days}d,
         count(DISTINCT CAST(ts AS DATE)) AS active_days_last_{days}d,
         CAST(sum(paid) AS DOUBLE) / count(paid) AS avg_purchase_amount_last_{days}d
  FROM e WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL {days} DAY GROUP BY customer_id
)"""


def _favourite_sql(name: str, expression: str) -> str:
    return f"""
{name} AS (
  SELECT customer_id, value FROM (
    SELECT customer_id, {expression} AS value,
           row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, {expression}) AS place
    FROM e GROUP BY customer_id, {expression}) WHERE place = 1
)"""


_CLOCK = _favourite_sql("ph", "hour(ts)") + "," + _favourite_sql("pd", "dayofweek(ts) + 1") + """,
b AS (
  SELECT x.customer_id, CAST(ph.value AS INTEGER) AS preferred_hour,
         CAST(pd.value AS INTEGER) AS preferred_day, x.activity_time_variance,
         x.business_hours_activity, x.evening_activity, x.weekend_activity
  FROM (SELECT customer_id, stddev_samp(hour(ts)) AS activity_time_variance,
               count(*) FILTER (WHERE hour(ts) BETWEEN 9 AND 17) AS business_hours_activity,
               count(*) FILTER (WHERE hour(ts) BETWEEN 18 AND 23) AS evening_activity,
               count(*) FILTER (WHERE dayofweek(ts) IN (0, 6)) AS weekend_activity
        FROM e GROUP BY customer_id) x
  JOIN ph USING (customer_id) JOIN pd USING (customer_id)
)"""

_WINDOWS = """
w AS (
  SELECT time_bucket(INTERVAL {width}, ts) AS window_start,
         time_bucket(INTERVAL {width}, ts) + INTERVAL {width} AS window_end, customer_id,
         count(*) AS event_count,
         count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count,
         count(*) FILTER (WHERE event_type = 'page_view') AS page_view_count,
         round(CAST(sum(paid) AS DOUBLE) / count(paid), 6) AS avg_purchase_amount,
         CASE WHEN count(*) < 2 THEN 0.8::DOUBLE
              WHEN count(*) FILTER (WHERE event_type = 'purchase') = 0 THEN 0.6::DOUBLE
              ELSE 0.2::DOUBLE END AS churn_score
  FROM e GROUP BY ALL
)"""

_FIVE_MINUTES = _CANONICAL + "," + _WINDOWS.format(width="5 MINUTE")
_STORED = _FIVE_MINUTES + """,
p AS (
  SELECT customer_id, churn_score AS churn_probability, window_end AS prediction_date,
         '1.0' AS model_version FROM w
)"""
_CLOSED = "window_end <= (SELECT max(ts) FROM e) - INTERVAL 10 MINUTE"

_ISO = """strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
  CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END"""


def _envelope(type_column: str) -> str:
    return f"""'{{"customer_id":"' || customer_id || '","timestamp":"' || {_ISO} ||
  '","event_type":"' || {type_column} || '","event_data":{{"amount":"' || amount ||
  '","k":"' || k || '"}},"schema_version":"1.0"}}'"""


_FLAT = "customer_id, ts AS timestamp, event_type, amount, k, '1.0' AS schema_version"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _names(columns: list[str]) -> str:
    return ", ".join(columns)


_DOUBLES = {"avg_purchase_amount", "total_purchase_amount", "events_per_day",
            "purchase_frequency", "avg_purchase_amount_last_30d"}
_LIFETIME = ["total_events", "unique_event_types", "first_event_date", "last_event_date",
             *schema.STORED_FEATURES[2:]]


def _show(columns: list[str]) -> str:
    return _names([f"round({name}, 6) AS {name}" if name in _DOUBLES else name for name in columns])


def _show_filled(columns: list[str]) -> str:
    return _names([f"round(coalesce({name}, 0), 6) AS {name}" if name in _DOUBLES
                   else f"coalesce({name}, 0) AS {name}" for name in columns])


_TIMES = ["first_event_date", "last_event_date"]
_CLOCK_COLUMNS = """preferred_hour, preferred_day,
  round(coalesce(activity_time_variance, 0), 6) AS activity_time_variance,
  business_hours_activity, evening_activity, weekend_activity"""

_ROLLING = _with(_CANONICAL) + """
SELECT event_id, customer_id, ts AS timestamp, event_type, """ + ", ".join(
    f"count(*) OVER d{n} AS rolling_events_{n}d, "
    f"count(*) FILTER (WHERE event_type = 'purchase') OVER d{n} AS rolling_purchases_{n}d, "
    f"round(CAST(sum(paid) OVER d{n} AS DOUBLE), 6) AS rolling_revenue_{n}d"
    for n in schema.ROLLING_DAYS) + " FROM e WINDOW " + ", ".join(
    f"d{n} AS (PARTITION BY customer_id ORDER BY ts "
    f"RANGE BETWEEN INTERVAL {n} DAY PRECEDING AND CURRENT ROW)" for n in schema.ROLLING_DAYS)

_QUALITY = """
r AS (
  SELECT * FROM (VALUES
    (0, 'column_exists', 'customer_id', 0, 0), (1, 'column_exists', 'timestamp', 0, 0),
    (2, 'column_exists', 'event_type', 0, 0)) v(position, rule, "column", evaluated, unexpected)
  UNION ALL SELECT 3, 'not_null', 'customer_id', count(*), count(*) FILTER (WHERE customer_id IS NULL) FROM e
  UNION ALL SELECT 4, 'not_null', 'timestamp', count(*), count(*) FILTER (WHERE ts IS NULL) FROM e
  UNION ALL SELECT 5, 'in_set', 'event_type', count(log_type), count(*) FILTER (WHERE log_type NOT IN
    ('page_view', 'purchase', 'support_ticket', 'login', 'logout')) FROM e
  UNION ALL SELECT 6, 'length_between', 'customer_id', count(customer_id),
    count(*) FILTER (WHERE length(customer_id) NOT BETWEEN 1 AND 50) FROM e
)"""


def _scoring_rules_sql() -> str:
    """One line per rule of the scoring suite, over the customers' features."""
    rules, place = [], 0
    for name in ["customer_id", *schema.STORED_FEATURES]:
        rules.append(f"SELECT {place}, 'column_exists', '{name}', 0, 0")
        rules.append(f"SELECT {place + 1}, 'not_null', '{name}', count(*), "
                     f"count(*) FILTER (WHERE {name} IS NULL) FROM c")
        place += 2
    for name in schema.FEATURES:
        low = 1 if name == "customer_lifetime_days" else 0
        value = name if name in schema.STORED_FEATURES else "0"
        rules.append(f"SELECT {place}, 'at_least', '{name}', count({value}), "
                     f"count(*) FILTER (WHERE {value} < {low}) FROM c")
        place += 1
    return "q(position, rule, \"column\", evaluated, unexpected) AS (" + " UNION ALL ".join(rules) + ")"


_REPORT = """SELECT CAST(position AS INTEGER) AS position, rule, "column",
  CAST(evaluated AS BIGINT) AS evaluated, CAST(unexpected AS BIGINT) AS unexpected,
  unexpected = 0 AS success FROM """

_LABEL = "CAST(days_since_last_activity > 1 AS INTEGER) AS is_churned"
_BUCKET = "CAST('0x' || substr(md5(customer_id || ':42'), 1, 8) AS BIGINT) % 100 < 20"
_FILLED = """
f AS (
  SELECT customer_id, """ + _names([f"coalesce({name}, 0) AS {name}" for name in schema.FEATURES]) + """
  FROM c LEFT JOIN t30 USING (customer_id)
)"""
_MERGE_SIDES = """
a AS (SELECT customer_id, CAST(ts AS DATE) AS day, count(*) AS events, max(ts) AS last_seen FROM e
      WHERE ts < TIMESTAMP '2024-01-21' GROUP BY ALL),
s AS (SELECT customer_id, CAST(ts AS DATE) AS day, count(*) AS events, max(ts) AS last_seen FROM e
      WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY ALL)"""
_MERGED = """
SELECT customer_id, CAST(day AS VARCHAR) AS day, coalesce(a.events + s.events, a.events, s.events) AS events,
       coalesce(a.last_seen, s.last_seen) AS last_seen
FROM a FULL JOIN s USING (customer_id, day)"""


def _own_sql() -> dict[str, str]:
    recent = _recent_sql(30)
    closed_windows = _with(_FIVE_MINUTES) + f" SELECT * FROM w WHERE {_CLOSED}"
    flat_events = _with(_CANONICAL) + f" SELECT {_FLAT} FROM e"
    cohort = _with(_CANONICAL) + """
        SELECT event_id, customer_id, ts AS timestamp, event_type, first_purchase_date,
               CAST(datediff('day', first_purchase_date, ts) AS INTEGER) AS days_since_first_purchase,
               strftime(first_purchase_date, '%Y-%m') AS cohort_month
        FROM e LEFT JOIN (SELECT customer_id, min(ts) AS first_purchase_date FROM e
                          WHERE event_type = 'purchase' GROUP BY customer_id)
        USING (customer_id)"""
    profiles = _with(_CANONICAL, _CUSTOMERS, recent, _CLOCK) + f"""
        SELECT customer_id, {_names(_TIMES)}, {_show_filled(schema.FEATURES)}, {_CLOCK_COLUMNS}
        FROM c FULL JOIN t30 USING (customer_id) FULL JOIN b USING (customer_id)"""
    newest_predictions = _with(_STORED) + """
        SELECT customer_id, churn_probability, prediction_date, model_version FROM p
        QUALIFY row_number() OVER (PARTITION BY customer_id
          ORDER BY prediction_date DESC, churn_probability DESC) = 1"""
    return {
        "customer_features": _with(_CANONICAL, _CUSTOMERS)
        + f" SELECT customer_id, {_show(_LIFETIME)} FROM c",
        "time_features": _with(_CANONICAL, _recent_sql(7)) + """
            SELECT customer_id, events_last_7d, purchases_last_7d, page_views_last_7d,
                   active_days_last_7d,
                   round(avg_purchase_amount_last_7d, 6) AS avg_purchase_amount_last_7d FROM t7""",
        "behavioral_features": _with(_CANONICAL, _CLOCK) + """
            SELECT customer_id, preferred_hour, preferred_day,
                   round(activity_time_variance, 6) AS activity_time_variance,
                   business_hours_activity, evening_activity, weekend_activity FROM b""",
        "customer_profile": profiles,
        "incremental_profile": profiles,
        "rolling_aggregations": _ROLLING,
        "rolling_by_slice": _ROLLING,
        "first_purchase": _with(_CANONICAL) + """
            SELECT customer_id, min(ts) AS first_purchase_date FROM e
            WHERE event_type = 'purchase' GROUP BY customer_id""",
        "cohort_features": cohort,
        "cohort_by_broadcast": cohort,
        "event_envelope": _with(_CANONICAL)
        + f" SELECT customer_id AS key, {_envelope('event_type')} AS value FROM e",
        "key_decode": _with(_CANONICAL)
        + f" SELECT customer_id AS key, {_envelope('event_type')} AS value FROM e",
        "decode_events": flat_events,
        "valid_events": flat_events + " WHERE log_type = 'purchase'",
        "rejected_events": _with(_CANONICAL)
        + f" SELECT {_envelope('log_type')} AS value, 'bad_event_type' AS reasons"
          " FROM e WHERE log_type <> 'purchase'",
        "validation_stats": _with(_CANONICAL) + """
            SELECT count(*) FILTER (WHERE log_type = 'purchase') AS valid_events,
                   count(*) FILTER (WHERE log_type <> 'purchase') AS validation_errors,
                   count(*) AS total_processed FROM e""",
        "dq_report": _with(_CANONICAL, _QUALITY) + " " + _REPORT + "r",
        "dq_summary": _with(_CANONICAL, _QUALITY) + """
            SELECT count(*) FILTER (WHERE unexpected = 0) = count(*) AS success,
                   count(*) AS evaluated_rules,
                   count(*) FILTER (WHERE unexpected = 0) AS successful_rules,
                   count(*) FILTER (WHERE unexpected <> 0) AS unsuccessful_rules,
                   round(count(*) FILTER (WHERE unexpected = 0) * 100 / count(*), 6)
                     AS success_percent FROM r""",
        "scoring_input_report": _with(_CANONICAL, _CUSTOMERS, _scoring_rules_sql())
        + " " + _REPORT + "q",
        "tumbling_features": _with(_FIVE_MINUTES) + " SELECT * EXCLUDE (churn_score) FROM w",
        "rule_score": _with(_CANONICAL, _WINDOWS.format(width="1 DAY")) + " SELECT * FROM w",
        "stream_features": closed_windows,
        "stream_source": flat_events,
        "stream_restart": _with(_FIVE_MINUTES) + f" SELECT *, true AS scored_in_run FROM w WHERE {_CLOSED}",
        "stream_append": closed_windows,
        "stream_versions": closed_windows,
        "kafka_payload": _with(_FIVE_MINUTES) + """
            SELECT customer_id AS key, '{"customer_id":"' || customer_id || '","churn_score":' ||
                   CAST(churn_score AS VARCHAR) || ',"prediction_timestamp":"' ||
                   strftime(window_end, '%Y-%m-%dT%H:%M:%S.000Z') || '"}' AS value FROM w""",
        "foreach_batch": _with(_CANONICAL)
        + f" SELECT {_envelope('event_type')} AS value, 'ValueError: amount too large' AS error"
          " FROM e WHERE CAST(amount AS DOUBLE) > 100",
        "latest_prediction": newest_predictions,
        "stream_latest_prediction": newest_predictions,
        "latest_prediction_of": _with(_STORED) + f"""
            SELECT customer_id, churn_probability, prediction_date, model_version FROM p
            WHERE customer_id = '{ONE_CUSTOMER}'
            ORDER BY prediction_date DESC, churn_probability DESC LIMIT 1""",
        "prediction_metrics": _with(_STORED) + """
            SELECT count(*) AS total_predictions, round(avg(churn_probability), 6) AS avg_churn_score,
                   CAST(sum(CASE WHEN churn_probability > 0.7 THEN 1 ELSE 0 END) AS BIGINT)
                     AS high_risk_count
            FROM p WHERE prediction_date >= TIMESTAMP '2024-01-30 11:00:00'""",
        "risk_band": _with(_STORED) + """
            SELECT *, CASE WHEN churn_probability >= 0.7 THEN 'HIGH'
                           WHEN churn_probability >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
            FROM p""",
        "feature_lookup": _with(_CANONICAL, _CUSTOMERS) + f"""
            SELECT customer_id, {_show_filled(schema.STORED_FEATURES)} FROM c
            WHERE customer_id IN (SELECT customer_id FROM e WHERE event_type = 'support_ticket'
                                  AND ts >= TIMESTAMP '2024-01-29')""",
        "param_query": _with(_STORED) + """
            SELECT customer_id, count(*) AS predictions,
                   round(avg(churn_probability), 6) AS mean_probability
            FROM p WHERE prediction_date >= TIMESTAMP '2024-01-15' AND churn_probability >= 0.5
            GROUP BY customer_id""",
        "with_defaults": _with(_STORED) + """
            SELECT customer_id, churn_probability,
                   CASE WHEN churn_probability < 0.7 THEN prediction_date
                        ELSE TIMESTAMP '2024-01-31' END AS prediction_date,
                   model_version, CAST(NULL AS VARCHAR) AS features FROM p""",
        "feature_row_defaults": _with(_CANONICAL, _CUSTOMERS) + """
            SELECT customer_id, CAST(total_events AS INTEGER) AS total_events,
                   0 AS unique_event_types, CAST(purchase_count AS INTEGER) AS purchase_count,
                   CAST(CASE WHEN page_view_count > 10 THEN page_view_count ELSE 0 END AS INTEGER)
                     AS page_view_count,
                   0 AS support_ticket_count, 0::DOUBLE AS avg_purchase_amount,
                   round(total_purchase_amount, 6) AS total_purchase_amount,
                   0 AS days_since_last_activity, 0 AS customer_lifetime_days,
                   0::DOUBLE AS events_per_day, 0::DOUBLE AS purchase_frequency,
                   TIMESTAMP '2024-01-31' AS last_updated FROM c""",
        "create_if_absent": flat_events,
        "table_upsert": _with(_CANONICAL, _MERGE_SIDES) + _MERGED,
        "remove_old": _with(_CANONICAL, _MERGE_SIDES) + _MERGED,
        "table_lookup": _with(_CANONICAL, _CUSTOMERS) + """
            SELECT customer_id, total_events, purchase_count, last_event_date FROM c
            WHERE customer_id IN (SELECT CAST(user_id AS VARCHAR) FROM events
                                  WHERE event_type = 'purchase' AND value > 200)""",
        "snapshot_read": _with(_CANONICAL, _MERGE_SIDES)
        + " SELECT customer_id, CAST(day AS VARCHAR) AS day, events, last_seen FROM a",
        "compact": flat_events,
        "churn_labels": _with(_CANONICAL, _CUSTOMERS) + f" SELECT customer_id, {_LABEL} FROM c",
        "training_set": _with(_CANONICAL, _CUSTOMERS, recent) + f"""
            SELECT customer_id, {_show_filled(schema.FEATURES)}, {_LABEL}
            FROM c LEFT JOIN t30 USING (customer_id)""",
        "model_features": _with(_CANONICAL, _CUSTOMERS)
        + f" SELECT customer_id, {_show_filled(schema.STORED_FEATURES)}, "
        + _names([f"0::DOUBLE AS {name}" for name in schema.RECENT_FEATURES]) + " FROM c",
        "stratified_split": _with(_CANONICAL, _CUSTOMERS)
        + f" SELECT customer_id, {_LABEL}, {_BUCKET} AS is_validation FROM c",
        "exact_split": _with(_CANONICAL, _CUSTOMERS) + f"""
            SELECT customer_id, is_churned,
                   row_number() OVER (PARTITION BY is_churned ORDER BY digest)
                     <= floor(count(*) OVER (PARTITION BY is_churned) * 0.2 + 0.5) AS is_validation
            FROM (SELECT customer_id, {_LABEL},
                         CAST('0x' || substr(md5(customer_id || ':42'), 1, 15) AS BIGINT) AS digest FROM c)""",
        "asof_training_set": _with(_CANONICAL) + """
            , d AS (SELECT customer_id, CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS known_at, count(*) AS events,
                           max(ts) AS last_seen FROM e GROUP BY ALL)
            SELECT event_id, e.customer_id, ts AS labelled_at, known_at, events, last_seen
            FROM (SELECT * FROM e WHERE event_type = 'support_ticket') e
            ASOF JOIN d ON e.customer_id = d.customer_id AND ts >= known_at""",
        "roc_areas": _with(_CANONICAL, _CUSTOMERS, recent, _FILLED) + " , s AS (" + " UNION ALL ".join(
            f"SELECT {k} AS round, CAST({name} AS DOUBLE) AS score, {_LABEL} FROM f"
            for k, name in enumerate(schema.FEATURES)) + """),
            r AS (SELECT round, is_churned, rank() OVER (PARTITION BY round ORDER BY score)
                         + (count(*) OVER (PARTITION BY round, score) - 1) / 2 AS place FROM s),
            n AS (SELECT round, sum(is_churned) AS ones, sum(1 - is_churned) AS zeros,
                         sum(place) FILTER (WHERE is_churned = 1) AS places FROM r GROUP BY round)
            SELECT CAST(round AS INTEGER) AS round, CAST(ones AS BIGINT) AS ones, CAST(zeros AS BIGINT) AS zeros,
                   CASE WHEN ones > 0 AND zeros > 0
                        THEN round((places - ones * (ones + 1) / 2) / (ones * zeros), 6) END AS area FROM n""",
        "scaled_features": _with(_CANONICAL, _CUSTOMERS, recent, _FILLED, f"""
            v AS (SELECT *, {_BUCKET} AS is_validation FROM f),
            m AS (SELECT """ + _names([
            f"avg({name}) AS m_{name}, stddev_pop({name}) AS s_{name}"
            for name in schema.FEATURES]) + " FROM v WHERE NOT is_validation)")
        + " SELECT customer_id, is_validation, " + _names([
            f"round(({name} - m_{name}) / CASE WHEN s_{name} = 0 THEN 1 ELSE s_{name} END, 6) AS {name}"
            for name in schema.FEATURES]) + " FROM v, m",
        "train_model": _with(_CANONICAL, _CUSTOMERS) + f"""
            SELECT count(*) AS validation_rows, count(*) FILTER (WHERE is_churned = 1) AS validation_positives,
                   true AS above_floor
            FROM (SELECT customer_id, {_LABEL} FROM c) WHERE {_BUCKET}""",
        "batch_score": _with(_CANONICAL, _CUSTOMERS) + f"""
            SELECT customer_id, TIMESTAMP '{AS_OF}' AS prediction_date,
                   '{schema.MODEL_VERSION}' AS model_version, CAST(NULL AS VARCHAR) AS features,
                   true AS is_probability, true AS class_agrees, true AS band_agrees FROM c""",
        "feature_importance": "SELECT unnest([" + _names([f"'{name}'" for name in schema.FEATURES])
        + "]) AS feature, true AS is_weight, true AS sums_to_one",
        "model_roundtrip": _with(_CANONICAL)
        + " SELECT count(DISTINCT customer_id) AS customers, CAST(0 AS BIGINT) AS changed FROM e",
        "classifier_metrics": _with(_CANONICAL, _CUSTOMERS, _recent_sql(2), f"""
            g AS (SELECT {_LABEL}, CAST(coalesce(purchases_last_2d, 0) = 0 AS INTEGER) AS prediction
                  FROM c LEFT JOIN t2 USING (customer_id)),
            n AS (SELECT count(*) FILTER (WHERE is_churned = 1 AND prediction = 1) AS tp,
                         count(*) FILTER (WHERE is_churned = 0 AND prediction = 1) AS fp,
                         count(*) FILTER (WHERE is_churned = 1 AND prediction = 0) AS fn,
                         count(*) FILTER (WHERE is_churned = 0 AND prediction = 0) AS tn FROM g)""") + """
            SELECT tp AS true_positives, fp AS false_positives, fn AS false_negatives,
                   tn AS true_negatives,
                   round(coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0), 6) AS accuracy,
                   round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
                   round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
                   round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1_score
            FROM n""",
    }


def oracle_sql() -> dict[str, str]:
    return {**_own_sql(), **_extension("SQL")}
