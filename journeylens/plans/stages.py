"""Stage tables over the benchmark inputs, each written once per session and reused.

They play the part of the materialised models between the steps of a daily run.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import ltv, markov, models
from ..operators.classify import classify, source_dictionary
from ..operators.journeys import LAYOUT, per_window, touches_once
from ..runtime import materialize, materialize_by, tune
from ..sources import sample
from ..sources.tables import of_type, recent_ltv
from .attribution import windowed_visits

AS_OF = date(2024, 1, 31)


class Stages:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tune(spark), folder

    @cached_property
    def visits(self) -> DataFrame:
        return materialize(sample.visits(self.spark, self.folder))

    @cached_property
    def app_events(self) -> DataFrame:
        return materialize(sample.app_events(self.spark, self.folder))

    @cached_property
    def user_ltv(self) -> DataFrame:
        return materialize(sample.user_ltv(self.spark, self.folder))

    @cached_property
    def recent_ltv(self) -> DataFrame:
        return recent_ltv(self.user_ltv, AS_OF)

    @cached_property
    def dictionary(self) -> DataFrame:
        return materialize(source_dictionary(self.visits))

    @cached_property
    def classified(self) -> DataFrame:
        return materialize(classify(self.visits))

    @cached_property
    def subscriptions(self) -> DataFrame:
        # The other types need no dropping of copies and no labels.
        return materialize(of_type(classify(self.visits), "Subscription"))

    @cached_property
    def _windowed(self) -> tuple[DataFrame, int | None]:
        return windowed_visits(self.visits, AS_OF)

    @property
    def windowed(self) -> DataFrame:
        return self._windowed[0]

    @property
    def tasks(self) -> int | None:
        return self._windowed[1]

    @cached_property
    def placed(self) -> DataFrame:
        return materialize_by(touches_once(self.windowed, laid_out=True, layout=self.tasks), LAYOUT, self.tasks)

    @cached_property
    def touches(self) -> DataFrame:
        return per_window(self.placed)

    @cached_property
    def step_counts(self) -> DataFrame:
        return materialize(markov.step_counts(self.placed))

    @cached_property
    def steps(self) -> DataFrame:
        return markov.per_window_steps(self.step_counts)

    @cached_property
    def raw_effects(self) -> DataFrame:
        return materialize(markov.removal_effects_raw(self.step_counts))

    @cached_property
    def credited(self) -> DataFrame:
        return models.with_credits(markov.with_markov_credit(self.touches, self.raw_effects))

    @cached_property
    def totals(self) -> DataFrame:
        return models.channel_totals(self.credited)

    @cached_property
    def scores(self) -> DataFrame:
        return models.journey_scores(self.credited)

    @cached_property
    def valued(self) -> DataFrame:
        return materialize(ltv.journey_ltv(models.journeys(self.touches), self.windowed, self.recent_ltv))

    @cached_property
    def averages(self) -> DataFrame:
        return ltv.average_ltv(self.credited, self.valued)

    @cached_property
    def effects(self) -> DataFrame:
        return ltv.join_average_ltv(markov.removal_effects(self.raw_effects), self.averages)


_stages: dict[tuple[str, str], Stages] = {}


def stages(spark: SparkSession, folder: str) -> Stages:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _stages:
        _stages[key] = Stages(spark, folder)
    return _stages[key]
