"""The warehouse over the derived inputs: plans from raw rows, and tables stored by a first load."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.operators import clean, dims, facts, marts
from funnelspark.plans import derived
from funnelspark.session import COMPRESSION, new_scratch

# (session, inputs, label) → what was loaded: a job's root folder, or a table's path and schema.
_STORED: dict[tuple, str | tuple] = {}


def _fingerprint(spark: SparkSession, folder: str) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return (folder, *sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


class Inputs:
    """Tables of one test directory. ``loaded`` and ``reloaded`` are the times of its two loads."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @staticmethod
    def at(text: str) -> Column:
        return F.lit(text).cast("timestamp")

    @property
    def loaded(self) -> Column:
        return self.at("2024-01-10 00:00:00")

    @property
    def reloaded(self) -> Column:
        return self.at("2024-01-20 12:00:00")

    @property
    def as_of(self) -> Column:
        return self.at("2024-01-30 00:00:00")

    def table(self, name: str) -> DataFrame:
        return derived.table(self.spark, self.sf_dir, name)

    def raw(self, sql: str) -> DataFrame:
        return derived.derive(self.spark, self.sf_dir, sql)

    def routed(self, entity: str, sql: str) -> DataFrame:
        return clean.route(self.raw(sql), entity, ["pos"])

    def clean(self, entity: str, sql: str) -> DataFrame:
        return clean.clean_rows(self.routed(entity, sql))

    @cached_property
    def events(self) -> DataFrame:
        return self.clean("events", derived.RAW_EVENTS)

    @cached_property
    def tiers(self) -> DataFrame:
        return dims.account_tiers(self.spark)

    @cached_property
    def calendar(self) -> DataFrame:
        return dims.calendar(self.spark)

    @cached_property
    def agents(self) -> DataFrame:
        merged = dims.merge_agents(
            dims.empty(self.spark, "dim_agent"), self.clean("agents", derived.RAW_AGENTS_1), self.tiers, self.loaded
        )
        return merged.drop("_action")

    @cached_property
    def agents_reloaded(self) -> DataFrame:
        return dims.merge_agents(self.agents, self.clean("agents", derived.RAW_AGENTS_2), self.tiers, self.reloaded)

    @cached_property
    def leads(self) -> DataFrame:
        merged = dims.merge_leads(
            dims.empty(self.spark, "dim_lead"), self.clean("leads", derived.RAW_LEADS_1), self.loaded
        )
        return merged.drop("_action")

    @cached_property
    def leads_reloaded(self) -> DataFrame:
        return dims.merge_leads(self.leads, self.clean("leads", derived.RAW_LEADS_2), self.reloaded)

    @cached_property
    def campaigns(self) -> DataFrame:
        return dims.merge_campaigns(
            dims.empty(self.spark, "dim_campaign"), self.clean("campaigns", derived.RAW_CAMPAIGNS_1)
        ).drop("_action")

    @cached_property
    def templates(self) -> DataFrame:
        return dims.merge_templates(
            dims.empty(self.spark, "dim_message_template"), self.clean("templates", derived.RAW_TEMPLATES)
        ).drop("_action")

    def dimension(self, table: str) -> DataFrame:
        owner = {
            "dim_agent": "agents", "dim_lead": "leads", "dim_campaign": "campaigns", "dim_message_template": "templates",
        }
        return getattr(self, owner[table])

    def resolved(self, *tables: str) -> DataFrame:
        """Clean events with the keys of the named dimensions; only what a query needs is joined.

        Events and dimensions are stored first, as in a batch run: the lookup of leads reads the events twice, and
        the stored size of a dimension lets Catalyst decide on a broadcast.
        """
        return facts.resolve_keys(self.stored("clean_events"), {t: self.stored(t) for t in tables})

    def _build(self, name: str) -> DataFrame:
        if name in facts.DIMENSIONS:
            return self.dimension(name)
        if name == "clean_events":
            return self.events
        if name == "fact_outreach_event":
            return facts.as_fact(self.resolved(*facts.DIMENSIONS), F.col("event_timestamp"))
        if name == "fact_daily_agent_activity":
            days = marts.daily_agent_activity(self.fact)
            return marts.with_utilisation(days, self.stored("dim_agent"), self.tiers)
        if name == "fact_campaign_performance":
            return marts.campaign_performance(self.fact)
        raise ValueError(f"unknown table {name!r}")

    def stored(self, name: str) -> DataFrame:
        """A warehouse table, loaded into the shared folder the first time a session asks for it.

        Measures, checks and scores read stored tables, as they would after a nightly load; the load itself is
        what the cleaning, dimension and fact queries run. The key covers size and time of every
        input file, so changed inputs are loaded anew.
        """
        key = (self.spark.sparkContext.applicationId, _fingerprint(self.spark, self.sf_dir), name)
        if key not in _STORED:
            path = new_scratch(self.spark, name)
            built = self._build(name)
            built.write.option("compression", COMPRESSION).parquet(path)
            _STORED[key] = (path, built.schema)
        path, schema = _STORED[key]
        return self.spark.read.schema(schema).parquet(path)

    def once(self, label: str, run: Callable[[str], None]) -> str:
        """Root folder of a job that ran into the shared folder, at most once per session and inputs."""
        key = (self.spark.sparkContext.applicationId, _fingerprint(self.spark, self.sf_dir), label)
        if key not in _STORED:
            root = new_scratch(self.spark, label)
            run(root)
            _STORED[key] = root
        return _STORED[key]

    @property
    def fact(self) -> DataFrame:
        return self.stored("fact_outreach_event")

    @property
    def activity(self) -> DataFrame:
        return self.stored("fact_daily_agent_activity")

    @property
    def performance(self) -> DataFrame:
        return self.stored("fact_campaign_performance")

    def named(self, df: DataFrame, table: str = "dim_agent") -> DataFrame:
        """Surrogate keys → natural ids, for results that leave the engine."""
        natural, surrogate, _, _ = facts.DIMENSIONS[table]
        return df.join(self.stored(table).select(surrogate, natural), surrogate).drop(surrogate)

    @cached_property
    def warehouse(self) -> dict[str, DataFrame]:
        stored = [*facts.DIMENSIONS, "fact_outreach_event", "fact_daily_agent_activity", "fact_campaign_performance"]
        return {**{t: self.stored(t) for t in stored}, "dim_account_tier": self.tiers, "dim_date": self.calendar}

    @cached_property
    def runs(self) -> DataFrame:
        return self.raw(derived.PIPELINE_RUNS)
