"""The stage tables the registered queries share, each built once per session."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislecast.functions.numeric import round_even
from aislecast.functions.text import lexicon_score
from aislecast.operators import anomalies, baseline, curate, features, forecast, graph, sentiment
from aislecast.session import stage
from aislecast.sources import views


def sample_scorer(text: Column) -> Column:
    return lexicon_score(text, views.TEST_POSITIVE, views.TEST_NEGATIVE)


class Tables:
    """Views are lazy; curated, anomalies, features and forecasts are written
    once to the shared folder, as the stages of the batch job are."""

    _known: dict[tuple[str, str], Tables] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Tables:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._known:
            cls._known[key] = cls(spark, sf_dir)
        return cls._known[key]

    def table(self, name: str) -> DataFrame:
        return views.table(self.spark, self.sf_dir, name)

    @property
    def sales(self) -> DataFrame:
        return views.sales_raw(self.spark, self.sf_dir)

    @property
    def iot(self) -> DataFrame:
        return views.iot_raw(self.spark, self.sf_dir)

    @property
    def reviews(self) -> DataFrame:
        return views.reviews(self.spark, self.sf_dir)

    @property
    def truth(self) -> DataFrame:
        return views.truth(self.spark)

    @property
    def sentiment(self) -> DataFrame:
        return sentiment.sentiment_by_sku(self.reviews, sample_scorer)

    @cached_property
    def curated(self) -> DataFrame:
        return curate.stage_curated(curate.curate(self.sales, self.iot, self.sentiment))

    @cached_property
    def anomalies(self) -> DataFrame:
        return stage(anomalies.detect_anomalies(self.curated), "anomalies")

    @cached_property
    def forecasts(self) -> DataFrame:
        return stage(baseline.mean_forecast(self.curated), "forecasts")

    @cached_property
    def features(self) -> DataFrame:
        return curate.stage_curated(features.build_features(self.curated), "features")

    @cached_property
    def products(self) -> DataFrame:
        return stage(graph.products(self.curated, "#"), "products")

    @property
    def stores(self) -> DataFrame:
        return graph.stores(self.curated)

    @property
    def suppliers(self) -> DataFrame:
        return graph.suppliers(self.spark)

    @property
    def substitutes(self) -> DataFrame:
        return graph.substitutes(self.products)

    @cached_property
    def neighbours(self) -> DataFrame:
        return stage(graph.neighbours(self.substitutes), "neighbours")

    @cached_property
    def enriched(self) -> DataFrame:
        """Curated rows with both graph features; frequencies rounded, as equal shares must stay equal."""
        out = graph.point_in_time_features(self.curated, self.neighbours)
        return stage(out.withColumn("graph_co_stock_freq", round_even(F.col("graph_co_stock_freq"), 6)), "enriched")

    @property
    def categories(self) -> DataFrame:
        return self.products.select("sku", "category")

    @property
    def acks(self) -> DataFrame:
        """A log of acknowledged ids: all stockouts of high severity."""
        return self.anomalies.filter(
            (F.col("severity") == "high") & (F.col("anomaly_type") == "stockout_risk")
        ).select("id")

    @property
    def naive(self) -> DataFrame:
        """Holdout days with last week's value and the weekly mean as predictions."""
        scored = features.with_rolling(features.with_lags(self.curated, [7]), [7])
        _, test = features.split_holdout(scored)
        return test.filter(F.col("qty_lag_7").isNotNull()).select(
            "store_id", "sku", "date", "qty_sold",
            F.col("qty_lag_7").cast("double").alias("baseline_pred"),
            F.col("rolling_mean_7").alias("champion_pred"),
        )

    @cached_property
    def model(self):
        """The demand model with its validation errors."""
        columns = features.feature_columns(self.features)
        train, valid = forecast.training_split(self.features, columns)
        return forecast.train_demand_model(train, columns, max_rows=TRAIN_ROWS), columns, valid


# The registered queries fit the full number of trees on about so many labelled
# rows; features, predictions and scores are of all rows.
TRAIN_ROWS = 20_000
